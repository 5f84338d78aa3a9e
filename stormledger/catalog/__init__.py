"""All registered queries."""

from stormledger.catalog import checks, cleaning, counting, files, loads, profiles  # noqa: F401
from stormledger.catalog.core import QUERIES, SQL  # noqa: F401
