from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stormledger import schema, vocab
from stormledger.functions import dates, text
from stormledger.operators import aggregates as agg, cleaning, profiling
from stormledger.plans import stages


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {kind}")


def apply(spark, fn, values, kind="string"):
    return [r[0] for r in column(spark, values, kind).select(fn(F.col("c"))).collect()]


def test_parse_all_formats(spark):
    texts = [
        "2024-12-06", "06/12/2024", "06/12/2024 10:11:12", "06/12/2024 10:11", "2024/12/06",
        "06-12-2024", "06-12-2024 10:11:12", " 6/12/2024 ",
    ]
    got = apply(spark, dates.parse_date, texts)
    assert {d.date().isoformat() for d in got} == {"2024-12-06"}
    assert got[2] == datetime(2024, 12, 6, 10, 11, 12)
    assert got[3] == datetime(2024, 12, 6, 10, 11)


def test_parse_invalid_is_null(spark):
    texts = ["lixo", "", "31/13/2024", "31/02/2024", None, "2024-12-06T25:00", "2024-12-06 10", "12/2024"]
    assert apply(spark, dates.parse_date, texts) == [None] * 8


def test_iso_dates_with_a_time(spark):
    texts = ["2024-12-06 10:11:12", "2024-12-06T10:11:12", "2024-12-06T10:11:12.25", "2024-12-06 10:11",
             "2024-12-06T10:11:12Z", "2024-12-06T10:11:12-03:00", "2024/12/06 10:11:12"]
    got = apply(spark, dates.parse_date, texts)
    at = datetime(2024, 12, 6, 10, 11, 12)
    assert got == [at, at, at.replace(microsecond=250_000), at.replace(second=0), at, at, at]


def test_first_row_does_not_decide_the_format(spark):
    got = apply(spark, dates.parse_date, ["2024-12-06", "2024-12-25", "06/12/2024"])
    assert [d.strftime("%d.%m") for d in got] == ["06.12", "25.12", "06.12"]


def test_date_shapes(spark):
    got = apply(spark, dates.date_shape, ["2024-12-06", "06/12/2024 10:11", "x", " ", None])
    assert got == ["yyyy-MM-dd", "dd/MM/yyyy HH:mm", "outro", "vazio", "vazio"]


def test_calendar(spark):
    day = spark.createDataFrame([("2024-12-06 13:45:00",), (None,)], "data string").select(
        F.col("data").cast("timestamp_ntz").alias("data")
    )
    got = [r.asDict() for r in cleaning.derive_calendar(day).drop("data").collect()]
    assert got[0] == {
        "ano": 2024, "mes": 12, "dia": 6, "hora": 13, "dia_semana": 4,
        "dia_semana_nome": "Friday", "estacao": "verao",
    }
    assert set(got[1].values()) == {None}


def test_seasons_and_names(spark):
    months = list(range(1, 13)) + [None]
    seasons = apply(spark, dates.season, months, "int")
    assert seasons == [
        "verao", "verao", "outono", "outono", "outono", "inverno", "inverno", "inverno",
        "primavera", "primavera", "primavera", "verao", None,
    ]
    assert apply(spark, dates.month_name, months, "int") == [*vocab.MONTH_NAMES, None]
    assert apply(spark, dates.weekday_name_pt, [4, None], "int") == ["Sexta-feira", None]
    assert apply(spark, dates.rain_period, [3, 4, 10, 11, None], "int") == [
        "Seca", "Chuvosa", "Chuvosa", "Seca", None,
    ]


def test_month_number(spark):
    got = apply(spark, dates.month_number, ["Dezembro", "MARÇO", "marco ", "x", None])
    assert got == [12, 3, 3, None, None]


def test_strip_unicode_space(spark):
    nbsp, wide = chr(0xA0), chr(0x3000)
    assert apply(spark, text.normalize, [f"{nbsp}ABC\t{wide}", "a b", None]) == ["abc", "a b", None]


def test_plain_drops_accents_and_combining_marks(spark):
    decomposed = "va" + chr(0x301) + "rzea"
    assert apply(spark, text.plain, ["São José", decomposed, "Ação"]) == ["sao jose", "varzea", "acao"]
    assert apply(spark, text.slug, [" Água Fria "]) == ["agua_fria"]


def test_non_ascii(spark):
    assert apply(spark, text.has_non_ascii, ["abc", "Mês", "", None]) == [False, True, False, None]


def test_normalize_area(spark):
    names = ["AFOGADOS", " Água Fria ", "Vasco da Gama ", "DoisIrmaos", "São José", "sítio", "Bairro Novo", None]
    df = spark.createDataFrame([(n,) for n in names], "bairro string")
    got = {r[0]: r[1] for r in cleaning.normalize_area(df).collect()}
    assert got == {
        "AFOGADOS": "afogados", " Água Fria ": "agua_fria", "Vasco da Gama ": "vasco_da_gama",
        "DoisIrmaos": "dois_irmaos", "São José": "sao_jose", "sítio": "sitio",
        "Bairro Novo": "bairro novo", None: None,
    }


def test_normalize_kind(spark):
    names = ["ENCHENTE", "Inundação", "Deslizamento de Barreiras", "Vistoria Técnica", "OCORRÊNCIA",
             "Serviço", "Instalação de Lona", "Remoção de entulho", "Risco geotécnico", "Poda"]
    df = spark.createDataFrame([(n,) for n in names], "tipo_ocorrencia string")
    got = [r[1] for r in cleaning.normalize_kind(df).collect()]
    assert sorted(got) == sorted([
        "alagamento", "alagamento", "deslizamento", "vistoria", "outros", "servico", "lona",
        "remocao", "risco", "poda",
    ])


def test_spelling_tables_have_one_meaning_per_spelling():
    assert len(dict(vocab.area_rows())) == len(vocab.area_rows())
    assert len(dict(vocab.kind_rows())) == len(vocab.kind_rows())


def test_filter_region(spark):
    df = spark.createDataFrame([("Recife",), ("RECIFE/PE",), (None,), ("Olinda",)], "regional string")
    assert [r[0] for r in cleaning.filter_region(df).collect()] == ["Recife", "RECIFE/PE", None]


def test_fill(spark):
    df = spark.createDataFrame([(None, None, None), ("a", 2.0, datetime(2024, 1, 1))],
                               "t string, n double, d timestamp_ntz")
    filled = cleaning.fill_numeric(cleaning.fill_text(df))
    assert tuple(filled.where("d IS NULL").first()) == ("não informado", 0.0, None)


def test_headers():
    raw = ["Regional", "Ano", "Mês", "Data", "Ocorrencia", "Bairro", "Grau_de_Risco", "Data_da_Acao", "XYZ"]
    assert [schema.canonical_name(h) for h in raw] == [
        "regional", "ano_registro", "mes_registro", "data_atendimento", "tipo_ocorrencia", "bairro",
        "grau_de_risco", "data_acao", "xyz",
    ]


def test_date_column_discovery(spark):
    both = spark.createDataFrame([], "Data_da_Acao string, data_atendimento string")
    assert schema.main_date_column(both) == "data_atendimento"
    assert schema.main_date_column(spark.createDataFrame([], "x int, DATA string")) == "DATA"
    assert schema.main_date_column(spark.createDataFrame([], "x int")) is None


def test_clean_stage_without_region_filter_keeps_sectors(spark):
    df = spark.createDataFrame(
        [("Norte", "Dois Unidos", None, "2024-12-06")],
        "regional string, bairro string, tipo_ocorrencia string, data_atendimento string",
    )
    row = stages.clean_and_unify(df).first()
    assert row["bairro_normalizado"] == "dois unidos" and row["tipo_ocorrencia"] is None
    assert stages.clean_and_unify(df, fill=True).first()["tipo_ocorrencia"] == "não informado"
    assert (row["ano"], row["estacao"]) == (2024, "verao")
    assert stages.clean_and_unify(df, regions=vocab.REGION_SPELLINGS).count() == 0


def test_recover_period(spark):
    df = spark.createDataFrame(
        [(None, None, None, "2025", "Dezembro"), (2024, 3, "outono", "2025", "Dezembro"),
         (None, None, None, "x", None)],
        "ano int, mes int, estacao string, ano_registro string, mes_registro string",
    )
    got = [tuple(r)[:3] for r in cleaning.recover_period(df).collect()]
    assert got == [(2025, 12, "verao"), (2024, 3, "outono"), (None, None, None)]


def test_enrich_calendar(spark):
    df = spark.createDataFrame([("2024-12-25",), ("2024-12-07",)], "d string").select(
        F.col("d").cast("date").alias("d"))
    got = {str(r["d"]): (r["fim_de_semana"], r["feriado"]) for r in cleaning.enrich_calendar(df, "d").collect()}
    assert got == {"2024-12-25": (False, "Natal"), "2024-12-07": (True, None)}


def test_easter_and_movable_holidays(spark):
    known = {1981: "04-19", 1954: "04-18", 2000: "04-23", 2019: "04-21", 2024: "03-31", 2025: "04-20", 2038: "04-25", 2076: "04-19"}
    got = dict(zip(known, apply(spark, dates.easter, list(known), "int"), strict=True))
    assert {y: d.strftime("%m-%d") for y, d in got.items()} == known
    df = spark.createDataFrame([("2024-02-13",), ("2024-03-29",), ("2024-05-30",), ("2024-11-20",), (None,)], "d string")
    named = cleaning.enrich_calendar(df.select(F.col("d").cast("date").alias("d")), "d").collect()
    assert {str(r["d"]): r["feriado"] for r in named} == {
        "2024-02-13": "Carnaval", "2024-03-29": "Sexta-feira Santa", "2024-05-30": "Corpus Christi",
        "2024-11-20": "Consciência Negra", "None": None}


def test_null_keys_are_dropped_by_default(spark):
    df = column(spark, [1, None, 1], "int")
    assert [tuple(r) for r in agg.count_by(df, "c").collect()] == [(1, 2)]
    assert agg.count_by(df, "c", keep_null=True).count() == 2


def test_missing_column_gives_an_empty_result(spark):
    out = agg.by_area(column(spark, ["a"]))
    assert out.columns == ["bairro_normalizado", "total_ocorrencias"] and out.count() == 0


def test_normalised_column_is_preferred(spark):
    df = spark.createDataFrame([("A", "a"), ("a ", "a")], "bairro string, bairro_normalizado string")
    assert [tuple(r) for r in agg.by_area(df).collect()] == [("a", 2)]


def test_ties(spark):
    df = column(spark, ["a", "b", "b", "a"])
    assert agg.argmax_group(df, "c").first()["c"] == "a"
    assert profiling.modes(df, ["c"]).first()["moda"] == "a"
    numbers = column(spark, [10, 9, 9, 10], "int")
    assert profiling.modes(numbers, ["c"]).first()["moda"] == "9"


def test_share_of_nothing(spark):
    df = column(spark, [], "string")
    assert agg.with_share(agg.count_by(df, "c")).count() == 0


@pytest.mark.parametrize("weight", [None, "n"])
def test_weights_equal_rows(spark, weight):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 2)], "bairro string, ano int")
    base = rows.groupBy("bairro", "ano").agg(F.count(F.lit(1)).alias("n"))
    got = agg.area_stats(base if weight else rows, weight=weight).collect()
    assert [tuple(r) for r in got] == [("a", 2, 2, 1, 1, 1), ("b", 1, 1, 1, 2, 2)]


def test_parse_agrees_with_strptime(spark):
    """Many spellings, right and wrong, against the standard library's parser."""
    import itertools

    formats = [
        "%Y-%m-%d", "%d/%m/%Y", "%d/%m/%Y %H:%M:%S", "%d/%m/%Y %H:%M", "%Y/%m/%d", "%d-%m-%Y",
        "%d-%m-%Y %H:%M:%S", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%dT%H:%M",
        "%Y/%m/%d %H:%M:%S", "%Y/%m/%d %H:%M", "%Y/%m/%dT%H:%M",
    ]
    dates_ = [
        sep.join(parts)
        for y, m, d in itertools.product(["2024", "2023", "24"], ["2", "02", "12", "13", "0"], ["1", "09", "29", "31", "32"])
        for parts in ((y, m, d), (d, m, y)) for sep in "-/."
    ]
    texts = [t + time for t in dates_ for time in ("", " 10:11", " 10:11:12", " 25:00:00", " 1:2:3", "T10:11")]

    def parsed(t):
        for f in formats:
            try:
                return datetime.strptime(t, f)
            except ValueError:
                continue
        return None

    df = spark.createDataFrame([(t,) for t in texts], "c string")
    got = {r[0]: r[1] for r in df.select("c", dates.parse_date(F.col("c"))).collect()}
    wrong = {t: (got[t], parsed(t)) for t in texts if got[t] != parsed(t)}
    assert not wrong


def test_incidents_of_unknown_customers_stay(spark, tmp_path):
    from stormledger import bindings
    from conftest import SMALL

    for name in ("orders", "nation", "region"):
        bindings.table(spark, SMALL, name).write.parquet(f"{tmp_path}/{name}.parquet")
    bindings.table(spark, SMALL, "customer").where("c_custkey % 5 <> 0").write.parquet(f"{tmp_path}/customer.parquet")
    rows = bindings.incidents(spark, str(tmp_path))
    assert rows.count() == 1500 and 0 < rows.where("bairro IS NULL").count() < 1500


def test_quality_is_judged_before_it_is_rounded(spark):
    from stormledger.operators import quality

    rows = [("x", "alta", 10_000_000, 500_003, False)]
    result = spark.createDataFrame(rows, "regra string, severidade string, verificados bigint, falhas bigint, aprovado boolean")
    card = quality.scorecard([result]).first()
    assert (card["qualidade"], card["aceito"]) == (0.95, False)


def test_recover_is_an_option_of_the_clean_stage(spark):
    df = spark.createDataFrame([("lixo", "2024", "Março")], "data_atendimento string, ano_registro string, mes_registro string")
    assert stages.clean_and_unify(df).first()["ano"] is None
    assert (stages.clean_and_unify(df, recover=True).first()["ano"], stages.clean_and_unify(df, recover=True).first()["mes"]) == (2024, 3)
