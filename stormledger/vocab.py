"""Fixed vocabularies: spellings, names and lookup rows that results depend on."""

from __future__ import annotations

# Canonical area names. An input matches when its lower-cased,
# accent-free spelling equals the name itself or the name with spaces for "_".
AREAS = [
    "afogados", "agua_fria", "boca_do_rio", "boa_viagem", "boas_novas",
    "casa_branca", "campo_grande", "coelhos", "cordeiro", "derby",
    "dois_irmaos", "engenho_do_meio", "espinheiro", "funk", "guabiraba",
    "ilha_do_retorno", "ipsep", "jaqueira", "jardim_sao_paulo", "madaleza",
    "madalena", "mangabeira", "monteiro", "nova_descoberta", "olinda",
    "pau_ferro", "pina", "prado", "recife", "rio_doce", "san_martin",
    "santa_cruz", "santo_amaro", "sao_jose", "sao_bento", "sao_geraldo",
    "sao_mateus", "sao_paulo", "sao_pedro", "sitio", "tamarineira", "torreao",
    "torres", "varzea", "vasco_da_gama", "zumbi",
]

# Area spellings that do not follow the rule above.
AREA_EXTRA_SPELLINGS = {"doisirmaos": "dois_irmaos"}

# Incident kinds and their accent-free, lower-case spellings.
KIND_SPELLINGS = {
    "alagamento": [
        "alagamento", "alagamentos", "alagamento/enchente",
        "alagamento e enchente", "enchente", "inundacao",
    ],
    "deslizamento": [
        "deslizamento", "deslizamentos", "deslizamento de terra",
        "deslizamento de barreiras", "deslizamento de encosta",
        "risco de deslizamento", "risco de escorregamento",
    ],
    "vistoria": ["vistoria", "vistorias", "vistoria tecnica"],
    "outros": ["ocorrencia", "outros"],
    "servico": ["servico"],
    "lona": ["lona", "lonas", "instalacao de lona"],
    "remocao": ["remocao", "remocao de entulho"],
    "risco": ["risco", "risco estrutural", "risco de queda", "risco geotecnico"],
}

# Lower-case region spellings the region filter keeps.
REGION_SPELLINGS = ["recife", "recife/pe", "recife - pe", "r mr", "metropolitana"]

# Texts of a raw file that mean "no value".
NULL_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Fixed value: text sentinel for missing values.
NOT_INFORMED = "não informado"
NOT_INFORMED_PLAIN = "nao informado"

# Portuguese month names, January first.
MONTH_NAMES = [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho", "Julho",
    "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]

# English and Portuguese weekday names, Monday first.
WEEKDAYS_EN = [
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
]
WEEKDAYS_PT = [
    "Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira",
    "Sexta-feira", "Sábado", "Domingo",
]

# Season labels in output order (southern hemisphere, summer
# starts in December), plain and accented.
SEASONS = ["verao", "outono", "inverno", "primavera"]
SEASONS_ACCENTED = ["Verão", "Outono", "Inverno", "Primavera"]

# Mean rain in mm for January to December.
MONTH_RAIN_MM = [100, 110, 150, 250, 320, 350, 340, 280, 180, 120, 80, 70]

# Months of the dry period.
DRY_MONTHS = [11, 12, 1, 2, 3]

# Known rain stations (code, name, kind).
STATIONS = [
    ("RE-RECIFE", "Recife", "Pluviométrico"),
    ("RE-PAULA", "Paulista", "Pluviométrico"),
    ("RE-OLINDA", "Olinda", "Pluviométrico"),
    ("RE-JABOATAO", "Jaboatão dos Guararapes", "Pluviométrico"),
]

# Fixed-date Brazilian national holidays (month, day, name).
NATIONAL_HOLIDAYS = [
    (1, 1, "Confraternização Universal"),
    (4, 21, "Tiradentes"),
    (5, 1, "Dia do Trabalho"),
    (9, 7, "Independência"),
    (10, 12, "Nossa Senhora Aparecida"),
    (11, 2, "Finados"),
    (11, 15, "Proclamação da República"),
    (11, 20, "Consciência Negra"),
    (12, 25, "Natal"),
]

# Movable Brazilian holidays (days from Easter Sunday, name).
MOVABLE_HOLIDAYS = [(-47, "Carnaval"), (-2, "Sexta-feira Santa"), (60, "Corpus Christi")]

# Local holidays of the city (month, day, name).
LOCAL_HOLIDAYS = [
    (3, 6, "Data Magna"), (6, 24, "São João"), (7, 16, "Nossa Senhora do Carmo"),
    (12, 8, "Nossa Senhora da Conceição"),
]

# Accepted date spellings as (label, shape).
DATE_SHAPES = [
    ("yyyy-MM-dd", r"^\d{4}-\d{1,2}-\d{1,2}$"),
    ("yyyy-MM-dd HH:mm:ss", r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?$"),
    ("yyyy-MM-dd HH:mm", r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{1,2}$"),
    ("dd/MM/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"),
    ("dd/MM/yyyy HH:mm:ss", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}$"),
    ("dd/MM/yyyy HH:mm", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}$"),
    ("yyyy/MM/dd", r"^\d{4}/\d{1,2}/\d{1,2}$"),
    ("dd-MM-yyyy", r"^\d{1,2}-\d{1,2}-\d{4}$"),
    ("dd-MM-yyyy HH:mm:ss", r"^\d{1,2}-\d{1,2}-\d{4} \d{1,2}:\d{1,2}:\d{1,2}$"),
]


def area_rows() -> list[tuple[str, str]]:
    """(spelling, canonical name) rows of the area dimension."""
    rows = {spelling: name for name in AREAS for spelling in (name, name.replace("_", " "))}
    return sorted({**rows, **AREA_EXTRA_SPELLINGS}.items())


def kind_rows() -> list[tuple[str, str]]:
    """(spelling, canonical kind) rows of the kind dimension."""
    return [(s, kind) for kind, spellings in KIND_SPELLINGS.items() for s in spellings]
