"""Years replaced, loads judged and published, growing corpora, calendars without holes."""

import datetime as dt
import os
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stormledger.operators import quality, series
from stormledger.plans import publish
from stormledger.sources import delimited, manifest, sinks


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- years -------------------------------------------------------------------

def years(spark, *pairs):
    return spark.createDataFrame(list(pairs), "ano int, v string")


def test_a_year_is_replaced_and_others_stay(spark, tmp_path):
    path = sinks.write_parquet_by_year(years(spark, (2020, "a"), (2021, "b"), (None, "c")), str(tmp_path / "p"))
    sinks.write_parquet_by_year(years(spark, (2021, "B"), (2022, "d")), path)
    assert rows(sinks.read_by_year(spark, path), "ano", "v") == [(2020, "a"), (2021, "B"), (2022, "d"), (None, "c")]
    sinks.write_parquet_by_year(years(spark, (None, "C")), path)
    assert rows(sinks.read_by_year(spark, path, [2020, 2022]), "ano", "v") == [(2020, "a"), (2022, "d")]
    assert rows(sinks.read_by_year(spark, path).where("ano IS NULL"), "v") == [("C",)]
    sinks.write_parquet_by_year(years(spark, (2030, "z")), path, keep_other_years=False)
    assert rows(sinks.read_by_year(spark, path), "ano", "v") == [(2030, "z")]


def test_a_reloaded_year_without_rows_becomes_empty(spark, tmp_path):
    path = sinks.write_parquet_by_year(years(spark, (2020, "a"), (2021, "b"), (2022, "c")), str(tmp_path / "p"))
    assert sinks.reload_years(years(spark, (2021, "x"), (2021, "y")), path, [2020, 2021]) == {2020: 0, 2021: 2}
    assert rows(sinks.read_by_year(spark, path), "ano", "v") == [(2021, "x"), (2021, "y"), (2022, "c")]


@pytest.mark.parametrize("strange", [2019, None])
def test_rows_of_other_years_end_the_reload(spark, tmp_path, strange):
    path = sinks.write_parquet_by_year(years(spark, (2020, "a"), (2021, "b")), str(tmp_path / "p"))
    with pytest.raises(PySparkException, match="a row of none of the years"):
        sinks.reload_years(years(spark, (2021, "x"), (strange, "y")), path, [2020, 2021])
    assert rows(sinks.read_by_year(spark, path), "ano", "v") == [(2020, "a"), (2021, "b")]


def test_years_may_have_other_columns_and_are_pruned(spark, tmp_path):
    path = sinks.write_parquet_by_year(years(spark, (2020, "a")), str(tmp_path / "p"))
    sinks.write_parquet_by_year(years(spark, (2021, "b")).withColumn("w", F.lit(1)), path)
    assert rows(sinks.read_by_year(spark, path), "ano", "v", "w") == [(2020, "a", None), (2021, "b", 1)]
    plan = sinks.read_by_year(spark, path, [2021])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "ano" in plan.split("PartitionFilters: [")[1].split("]")[0]


# --- publishing --------------------------------------------------------------

@pytest.fixture
def rules(spark):
    return [
        *quality.required_rules(["k"]), quality.Rule("x_presente", quality.CRITICAL, F.col("x").isNotNull(), 0.25),
        quality.Rule("x_pequeno", quality.MEDIUM, F.col("x") < 10, 1.0),
    ]


def load(spark, *data):
    return spark.createDataFrame(list(data), "ano int, k string, x int")


def test_a_refused_load_changes_nothing(spark, tmp_path, rules):
    store = str(tmp_path / "s")
    assert publish.loads(spark, store).count() == 0
    first = publish.publish(load(spark, (2020, "a", 1), (2021, "b", 2)), store, rules).first()
    assert (first["carga"], first["aceito"], first["falhas_criticas"]) == (1, True, 0)
    before = rows(publish.current(spark, store), "ano", "k", "x", "carga")
    bad = publish.publish(load(spark, (2021, None, 5), (2021, "c", 6), (2022, "d", 7)), store, rules).first()
    assert (bad["carga"], bad["aceito"], bad["falhas_criticas"]) == (2, False, 1)
    assert [(r["regra"], r["falhas"]) for r in bad["regras"]] == [("k_presente", 1), ("x_pequeno", 0), ("x_presente", 0)]
    assert rows(publish.current(spark, store), "ano", "k", "x", "carga") == before == [(2020, "a", 1, 1), (2021, "b", 2, 1)]
    assert rows(publish.quarantine(spark, store), "carga", "ano", "x", "regras_violadas", "carga_aceita") == [(2, 2021, 5, ["k_presente"], False)]


def test_rejected_rows_of_an_accepted_load(spark, tmp_path, rules):
    store = str(tmp_path / "s")
    data = [(2021, "a", 1), (2021, "b", 2), (2021, "c", 50), (2022, "d", None)]
    got = publish.publish(load(spark, *data), store, rules, minimum=0.7).first()
    assert got["aceito"] and [tuple(a) for a in got["anos"]] == [(2021, 3, 0), (2022, 0, 1)]
    assert rows(publish.current(spark, store), "k", "regras_violadas") == [("a", []), ("b", []), ("c", ["x_pequeno"])]
    assert rows(publish.quarantine(spark, store), "k", "regras_violadas") == [("d", ["x_presente", "x_pequeno"])]
    # severities that reject are the caller's choice
    publish.publish(load(spark, *data), store, rules, minimum=0.7, reject=(quality.CRITICAL, quality.MEDIUM))
    assert rows(publish.current(spark, store), "k", "carga") == [("a", 2), ("b", 2)]


def test_the_last_accepted_load_of_a_year_counts(spark, tmp_path, rules):
    store = str(tmp_path / "s")
    for data in ([(2020, "a", 1), (2021, "b", 1), (None, "n", 1)], [(2021, "c", 2)], [(2021, None, 3)], [(None, "m", 4)], []):
        publish.publish(load(spark, *data), store, rules)
    assert rows(publish.current(spark, store), "ano", "k", "carga") == [(2020, "a", 1), (2021, "c", 2), (None, "m", 4)]
    assert rows(publish.loads(spark, store), "carga", "aceito") == [(1, True), (2, True), (3, False), (4, True), (5, True)]


def test_rules_about_all_rows_can_refuse_a_load(spark, tmp_path, rules):
    store, data = str(tmp_path / "s"), [(2020, "a", 1), (2020, "a", 1), (2020, "b", 1)]
    repeated = lambda staged: [quality.duplicate_ratio(staged, ["k"]).withColumn("severidade", F.lit(quality.CRITICAL))]
    got = publish.publish(load(spark, *data), store, rules, minimum=0.5, set_rules=repeated).first()
    assert not got["aceito"] and got["falhas_criticas"] == 1 and publish.current(spark, store).count() == 0


def test_a_broken_off_load_leaves_nothing(spark, tmp_path, rules):
    store = str(tmp_path / "s")
    publish.publish(load(spark, (2020, "a", 1)), store, rules)
    # rows of a load that stopped before it was judged
    spark.createDataFrame([("zz", 1, [], "aceita", 2019)], "k string, x int, regras_violadas array<string>, situacao string, ano int").write.partitionBy(
        "situacao", "ano").parquet(f"{store}/linhas/carga=2")
    assert rows(publish.current(spark, store), "ano", "k") == [(2020, "a")]
    publish.publish(load(spark, (2021, "b", 1)), store, rules)
    assert rows(publish.current(spark, store), "ano", "k", "carga") == [(2020, "a", 1), (2021, "b", 2)]


def test_columns_of_the_store_are_refused(spark, tmp_path, rules):
    with pytest.raises(ValueError, match="carga"):
        publish.publish(load(spark).withColumn("carga", F.lit(1)), str(tmp_path), rules)


# --- growing corpora ---------------------------------------------------------

def write(folder, name, text, when=None):
    path = Path(folder, name)
    path.write_text(text, encoding="utf-8")
    if when:
        os.utime(path, (when, when))


def test_new_and_changed_files_alone_are_read(spark, tmp_path):
    source, store = tmp_path / "in", f"file://{tmp_path}/store"
    source.mkdir()
    write(source, "a_2020.csv", "Bairro;Quantidade\nPina;1\nIbura;2\n", 1000)
    write(source, "b_2021.csv", "Bairro,Status\nPina,aberto\n", 1000)
    write(source, "so_cabecalho.csv", "Bairro;Quantidade\n", 1000)
    assert manifest.ingest(spark, str(source), store) == 3
    assert manifest.ingest(spark, str(source), store) == 0
    entries = manifest.manifest(spark, store)
    assert rows(entries, "linhas", "carga", "separador", "estado") == [(0, 1, ";", "lido"), (1, 1, ",", "lido"), (2, 1, ";", "lido")]
    # one file grows, one is rewritten in place with the same size, one is new
    write(source, "a_2020.csv", "Bairro;Quantidade\nPina;1\nIbura;2\nTorre;3\n", 2000)
    write(source, "b_2021.csv", "Bairro,Status\nCais,aberto\n", 3000)
    write(source, "c_2022.csv", "Bairro;Quantidade\nVárzea;4\n", 2000)
    assert sorted(r["caminho"].rsplit("/", 1)[1] for r in manifest.pending(spark, str(source), store).collect()) == ["a_2020.csv", "b_2021.csv", "c_2022.csv"]
    assert manifest.ingest(spark, str(source), store) == 3
    assert rows(manifest.rows(spark, store), "bairro", "_ano_origem", "_carga") == [
        ("Cais", 2021, 2), ("Ibura", 2020, 2), ("Pina", 2020, 2), ("Torre", 2020, 2), ("Várzea", 2022, 2)]


def test_withdrawn_files_stay_unless_told(spark, tmp_path):
    source, store = tmp_path / "in", f"file://{tmp_path}/store"
    source.mkdir()
    write(source, "a.csv", "Bairro\nPina\n")
    write(source, "b.csv", "Bairro\nIbura\n")
    manifest.ingest(spark, str(source), store)
    (source / "a.csv").unlink()
    assert manifest.ingest(spark, str(source), store) == 0
    assert rows(manifest.rows(spark, store), "bairro") == [("Ibura",), ("Pina",)]
    assert manifest.ingest(spark, str(source), store, drop_missing=True) == 0
    assert rows(manifest.rows(spark, store), "bairro") == [("Ibura",)]
    write(source, "a.csv", "Bairro\nPina\n")
    assert manifest.ingest(spark, str(source), store) == 1
    assert rows(manifest.rows(spark, store), "bairro") == [("Ibura",), ("Pina",)]


def test_a_load_that_broke_off_is_not_seen(spark, tmp_path):
    source, store = tmp_path / "in", f"file://{tmp_path}/store"
    source.mkdir()
    write(source, "a.csv", "Bairro\nPina\n")
    spark.createDataFrame([("Lixo", "x", 1, "x")], "bairro string, _arquivo string, _ano_origem int, _caminho string").write.parquet(f"{store}/linhas/_carga=1")
    manifest.ingest(spark, str(source), store)
    assert rows(manifest.rows(spark, store), "bairro", "_carga") == [("Pina", 1)]


# --- one scan ----------------------------------------------------------------

def test_the_plan_does_not_grow_with_the_layouts(spark, tmp_path):
    for i in range(200):
        sep = ";,\t"[i % 3]
        (tmp_path / f"f{i}.csv").write_text(f'Bairro{sep}Status{sep}C{i % 7}_{i // 100}\nb{i}{sep}"x{sep}y"{sep}{i}\n', encoding="latin-1" if i % 2 else "utf-8")
    (tmp_path / "acento.csv").write_text("Bairro;Observação\nVárzea;é\n", encoding="latin-1")
    corpus = delimited.read_corpus(spark, str(tmp_path))
    plan = corpus._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [value") == 1 and "Union" not in plan
    # each line is parsed once, by one of three separators
    assert plan.count("from_csv") == 3
    got = {r["bairro"]: r for r in corpus.collect()}
    assert len(got) == 201 and got["Várzea"]["observacao"] == "é"
    assert all(got[f"b{i}"][f"c{i % 7}_{i // 100}"] == str(i) and got[f"b{i}"]["status"] == f"x{';,' if False else ';,	'[i % 3]}y" for i in range(200))


def test_lines_of_one_scan(spark, tmp_path):
    write(tmp_path, "a.csv", '﻿Bairro;Texto;N\r\nPina;"a ""b""; c";1\r\n\r\n  \r\nIbura;;\r\nTorre;x\r\nCais;x;1;demais\r\nVárzea;x;1;\r\nBoa Vista;5" cano;2"\r\n')
    write(tmp_path, "b.csv", "Bairro,Status\nPina,null\nBairro,Status\n")
    got = rows(delimited.read_corpus(spark, str(tmp_path)), "bairro", "texto", "n", "status", "_arquivo")
    assert got == sorted([
        ("Boa Vista", '5" cano', '2"', None, "a.csv"), ("Ibura", None, None, None, "a.csv"), ("Pina", None, None, None, "b.csv"),
        ("Pina", 'a "b"; c', "1", None, "a.csv"), ("Torre", "x", None, None, "a.csv")], key=repr)


def test_files_beyond_a_stored_probe_are_left_out(spark, tmp_path):
    write(tmp_path, "a.csv", "Bairro\nPina\n")
    probe = delimited.probe_files(spark, str(tmp_path)).collect()
    write(tmp_path, "b.csv", "Bairro\nIbura\n")
    stored = spark.createDataFrame(probe)
    assert rows(delimited.read_corpus(spark, str(tmp_path), probe=stored, keep_path="p"), "bairro") == [("Pina",)]


@pytest.mark.parametrize("text, value", [("1.234.567", 1234567.0), ("-12.345.678", -12345678.0), ("1.234", 1.234), ("1.23.456", None)])
def test_thousands_points(spark, text, value):
    assert delimited.cast_measures(spark.createDataFrame([(text,)], "quantidade string")).first()[0] == value


# --- calendars ---------------------------------------------------------------

def calls(spark, *pairs):
    return spark.createDataFrame([(k, dt.datetime.fromisoformat(t)) for k, t in pairs], "k string, t timestamp_ntz")


def test_silent_days_fail_and_do_not_lower_the_usual(spark):
    data = [("a", f"2024-02-{d:02}T10:00:00") for d in (26, 27) for _ in range(4)] + [("a", "2024-03-02T09:00:00"), ("b", "2024-03-01T08:00:00")]
    got = series.volume_check_calendar(calls(spark, *data), "t", ("k",))
    day = lambda m, d: dt.date(2024, m, d)
    assert rows(got, "k", "dia", "total_ocorrencias", "volume_usual", "volume_baixo", "sem_registro") == sorted([
        ("a", day(2, 26), 4, None, None, False), ("a", day(2, 27), 4, 4.0, False, False), ("a", day(2, 28), 0, 4.0, True, True),
        ("a", day(2, 29), 0, 4.0, True, True), ("a", day(3, 1), 0, 4.0, True, True), ("a", day(3, 2), 1, 4.0, True, False),
        ("b", day(3, 1), 1, None, None, False), ("b", day(3, 2), 0, 1.0, True, True)], key=repr)


def test_bounds_of_the_calendar(spark):
    daily = spark.createDataFrame([("a", dt.date(2024, 1, 3), 2)], "k string, dia date, n bigint")
    got = series.with_silent_days(daily, "dia", "n", ("k",), start=dt.date(2024, 1, 2), end=dt.date(2024, 1, 4))
    assert rows(got, "k", "dia", "n") == [("a", dt.date(2024, 1, d), 2 * (d == 3)) for d in (2, 3, 4)]
    assert series.with_silent_days(daily, "dia", "n", ("k",), end=dt.date(2024, 1, 1)).count() == 0
    assert series.with_silent_days(daily.limit(0), "dia", "n", ("k",)).count() == 0
    with pytest.raises(PySparkException, match="more than 10 days"):
        series.with_silent_days(daily, "dia", "n", ("k",), start=dt.date(1901, 1, 1), max_days=10).collect()


def test_stations_that_stop(spark):
    data = calls(spark, ("a", "2024-01-01T00:00:00"), ("b", "2024-01-09T00:00:00"), ("c", "2024-01-07T00:00:00"))
    assert rows(series.open_gaps(data, "t", ("k",)), "k", "dia_anterior", "ate", "dias") == [("a", dt.date(2024, 1, 1), dt.date(2024, 1, 9), 8)]
    assert rows(series.open_gaps(data, "t", end=dt.date(2024, 1, 12)), "dias") == [(3,)]
