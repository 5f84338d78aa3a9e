"""Date parsing and calendar attributes as built-in column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from stormledger import vocab
from stormledger.functions import text


def date_shape(c: Column) -> Column:
    """Label of the textual date shape; "vazio" for null or empty, else "outro"."""
    s = text.strip(c)
    start = F.when(s.isNull() | (s == ""), F.lit("vazio"))
    return reduce(
        lambda acc, shape: acc.when(s.rlike(shape[1]), F.lit(shape[0])), vocab.DATE_SHAPES, start
    ).otherwise(F.lit("outro"))


# The accepted shapes as two patterns: the year or the day first, with an optional time.
YEAR_FIRST = (
    r"^\d{4}([-/])\d{1,2}\1\d{1,2}"
    r"([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"
)
# A zone after a time. Records carry local time, so the clock time stays and the zone goes.
ZONE = r"(\d:\d.*?)(?:Z|[+-]\d{2}:?\d{2})$"
DAY_FIRST = (
    r"^(\d{1,2})/(\d{1,2})/(\d{4})( \d{1,2}:\d{1,2}(?::\d{1,2})?)?$"
    r"|^(\d{1,2})-(\d{1,2})-(\d{4})( \d{1,2}:\d{1,2}:\d{1,2})?$"
)


def parse_date(c: Column) -> Column:
    """Timestamp without zone from any accepted format; null where none fits.

    Day-first texts are turned into ISO order, and one cast reads both. Unlike
    a parser with a pattern, the cast neither depends on the session time zone
    nor raises an exception inside for each text that does not fit.
    """
    s = text.strip(c)
    iso = F.regexp_replace(s, DAY_FIRST, "$3$7-$2$6-$1$5$4$8")
    return F.when(
        s.rlike(YEAR_FIRST),
        F.regexp_replace(F.replace(s, F.lit("/"), F.lit("-")), ZONE, "$1").try_cast("timestamp_ntz"),
    ).when(s.rlike(DAY_FIRST), iso.try_cast("timestamp_ntz"))


def wall_seconds(c: Column) -> Column:
    """Seconds of a timestamp without zone since 1970, whatever the session time zone."""
    day = F.unix_date(c.cast("date")).cast("bigint")
    return day * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def easter(year: Column) -> Column:
    """Easter Sunday of a Gregorian year: the Sunday after the first full moon of spring."""
    golden, century = year % 19, F.floor(year / 100)
    # Days from 21 March to the full moon, by the golden number and the century's corrections.
    corrections = century - F.floor(century / 4) - F.floor((century * 8 + 13) / 25)
    moon = F.pmod(golden * 19 + corrections + 15, F.lit(30))
    moon = moon - F.when((moon == 29) | ((moon == 28) & (golden > 10)), 1).otherwise(0)
    full = F.date_add(F.make_date(year, F.lit(3), F.lit(21)), moon.cast("int"))
    return F.next_day(full, "Sun")


def season(month: Column, labels: list[str] = vocab.SEASONS) -> Column:
    """Southern-hemisphere season of a month number."""
    # Dec, Jan, Feb -> 0; Mar..May -> 1; Jun..Aug -> 2; Sep..Nov -> 3.
    index = F.floor((month % 12) / 3).cast("int")
    return F.get(F.array(*[F.lit(x) for x in labels]), index)


def month_name(month: Column) -> Column:
    """Portuguese month name of a month number."""
    return F.get(F.array(*[F.lit(m) for m in vocab.MONTH_NAMES]), month - 1)


def month_number(name: Column) -> Column:
    """Month number of a Portuguese month name, without case or accents."""
    plain_names = F.array(*[text.plain(F.lit(m)) for m in vocab.MONTH_NAMES])
    return F.nullif(F.array_position(plain_names, text.plain(name)), F.lit(0)).cast("int")


def weekday_name(date: Column) -> Column:
    """English weekday name."""
    return F.get(F.array(*[F.lit(d) for d in vocab.WEEKDAYS_EN]), F.weekday(date))


def weekday_name_pt(index: Column) -> Column:
    """Portuguese weekday name of a weekday index (0 = Monday)."""
    return F.get(F.array(*[F.lit(d) for d in vocab.WEEKDAYS_PT]), index)


def rain_period(month: Column, dry_months: list[int] = vocab.DRY_MONTHS) -> Column:
    """"Seca" for the dry months, else "Chuvosa"."""
    return F.when(month.isin(dry_months), F.lit("Seca")).when(month.isNotNull(), F.lit("Chuvosa"))


def calendar(date: Column) -> dict[str, Column]:
    """All calendar attributes of a date; every one is null where the date is."""
    month = F.month(date)
    return {
        "ano": F.year(date),
        "mes": month,
        "dia": F.dayofmonth(date),
        "hora": F.hour(date),
        "dia_semana": F.weekday(date),
        "dia_semana_nome": weekday_name(date),
        "estacao": season(month),
    }
