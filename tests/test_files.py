import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stormledger import session
from stormledger.operators import aggregates as agg, profiling
from stormledger.plans import stages
from stormledger.sources import delimited, records, sinks

HEADER = '"Regional";"Ano";"Mês";"Data";"Ocorrencia";"Bairro";"Area_m"'


@pytest.fixture
def corpus(tmp_path):
    (tmp_path / "atendimentos_2023.csv").write_bytes(
        (HEADER + '\n"Norte";"2023";"Março";"2023-03-05";"";"São José";"1,5"\n').encode("latin-1"))
    (tmp_path / "atendimentos_2024.csv").write_text(
        HEADER + '\n"Sul";"2024";"Março";"05/03/2024";"Lona; rua";"Várzea";"2.5"\n'
        '"Sul";"2024";"Março";"x";"a";"b";"c";"d"\n"Sul";"2024"\n', encoding="utf-8")
    (tmp_path / "outros.csv").write_text("Bairro,Status\nPina,aberto\n", encoding="utf-8")
    return str(tmp_path)


def test_bad_lines(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text('1;2\n1;2;3\n1;2;\n1\n"x;y";"z"\n"a""b";c\n')
    rows = delimited.read_delimited(spark, str(path), ["a", "b"], header=False)
    assert [tuple(r) for r in rows.collect()] == [("1", "2"), ("1", None), ("x;y", "z"), ('a"b', "c")]
    assert rows.count() == 4
    assert [r[0] for r in rows.select("b").collect()] == ["2", None, "z", "c"]


def test_null_texts_and_line_breaks_in_quotes(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text('a;b\n"";N/A\nnull;x\n"duas\nlinhas";NaN\n')
    rows = delimited.read_delimited(spark, str(path), ["a", "b"], multi_line=True)
    assert [tuple(r) for r in rows.collect()] == [(None, None), (None, "x"), ("duas\nlinhas", None)]


def test_corpus_ignores_other_files(spark, corpus):
    Path(corpus, "leia.txt").write_text("x;y\n")
    Path(corpus, "mais.CSV").write_text("Bairro;Status\nIbura;aberto\n")
    assert {r["arquivo"] for r in delimited.probe_files(spark, corpus).collect()} == {
        "atendimentos_2023.csv", "atendimentos_2024.csv", "outros.csv", "mais.CSV"}
    assert delimited.read_corpus(spark, corpus).where("bairro = 'Ibura'").count() == 1


def test_probe(spark, corpus):
    got = {r["arquivo"]: (r["encoding"], r["separador"], r["linhas"], r["cabecalho"])
           for r in delimited.probe_files(spark, corpus).collect()}
    assert got == {
        "atendimentos_2023.csv": ("ISO-8859-1", ";", 2, HEADER),
        "atendimentos_2024.csv": ("UTF-8", ";", 4, HEADER),
        "outros.csv": ("UTF-8", ",", 2, "Bairro,Status"),
    }


def test_corpus(spark, corpus):
    df = delimited.read_corpus(spark, corpus)
    rows = {(r["_arquivo"], r["bairro"]): r for r in df.collect()}
    assert len(rows) == 4
    old = rows["atendimentos_2023.csv", "São José"]
    assert (old["_ano_origem"], old["mes_registro"], old["status"], old["tipo_ocorrencia"]) == (2023, "Março", None, None)
    new = rows["atendimentos_2024.csv", "Várzea"]
    assert (new["_ano_origem"], new["tipo_ocorrencia"]) == (2024, "Lona; rua")
    other = rows["outros.csv", "Pina"]
    assert (other["_ano_origem"], other["status"], other["regional"]) == (None, "aberto", None)
    assert ("atendimentos_2024.csv", None) in rows


def test_corpus_through_all_stages(spark, corpus):
    df = delimited.cast_measures(delimited.read_corpus(spark, corpus))
    clean = stages.clean_and_unify(df)
    assert clean.where("bairro_normalizado = 'varzea'").first()["mes"] == 3
    assert [tuple(r) for r in agg.by_year(clean).collect()] == [(2023, 1), (2024, 1)]
    summary = {r["_arquivo"]: (r["registros"], r["arquivos"]) for r in delimited.corpus_summary(df).collect()}
    assert summary == {"atendimentos_2023.csv": (1, 1), "atendimentos_2024.csv": (2, 1), "outros.csv": (1, 1), None: (4, 3)}
    Path(corpus, "vazio.csv").write_text("")
    Path(corpus, "so_cabecalho.csv").write_text("Bairro;Status\n")
    found = delimited.found_files(spark, corpus)
    counts = {r["_arquivo"]: tuple(r)[1:] for r in delimited.corpus_summary(delimited.read_corpus(spark, corpus), found).collect()}
    assert counts[None] == (4, 5, 3) and counts["vazio.csv"] == counts["so_cabecalho.csv"] == (0, 1, 0)
    diagnosis = stages.diagnose(df, ("_arquivo",))
    row = diagnosis.where("_arquivo = 'outros.csv' AND coluna = 'regional'").first()
    assert row["muitos_nulos"] and row["campo_chave_nulo"]


def test_odd_file_names(spark, tmp_path):
    names = ["Atendimentos 2024.csv", "são [1] 100%.csv", "a+b.csv"]
    for i, name in enumerate(names):
        (tmp_path / name).write_text(f"Bairro;C{i}\nx{i};y\n", encoding="utf-8")
    df = delimited.read_corpus(spark, str(tmp_path))
    assert sorted(r["bairro"] for r in df.collect()) == ["x0", "x1", "x2"]


def test_scan_paths_take_whole_folders_where_they_can(spark):
    a, b = ("UTF-8", ";", "x", False), ("UTF-8", ",", "x", False)
    rows = [(f, *layout) for f, layout in {
        "/r/2019/1.csv": a, "/r/2019/2.csv": a, "/r/2020/1.csv": a, "/r/2020/2.csv": b, "/r/top.csv": b}.items()]
    probed = spark.createDataFrame(rows, "caminho string, encoding string, separador string, cabecalho string, quebras boolean")
    assert delimited.scan_paths(*delimited._folder_layouts(probed)) == {
        a: ["/r/2019", "/r/2020/1.csv"], b: ["/r/2020/2.csv", "/r/top.csv"]}


def test_line_breaks_in_quotes_of_some_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Id;Texto\nA;"duas\nlinhas ""x"""\nB;"uma"\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("Id;Texto\nC;c\n", encoding="utf-8")
    probe = delimited.probe_files(spark, str(tmp_path))
    assert {r["arquivo"]: r["quebras"] for r in probe.collect()} == {"a.csv": True, "b.csv": False}
    for rows in (delimited.read_corpus(spark, str(tmp_path)), delimited.read_corpus(spark, str(tmp_path), probe=probe)):
        assert sorted((r["id"], r["texto"]) for r in rows.collect()) == [("A", 'duas\nlinhas "x"'), ("B", "uma"), ("C", "c")]


@pytest.mark.parametrize("text, value", [
    ("1,5", 1.5), ("1.234,56", 1234.56), ("2.5", 2.5), ("-12,5", -12.5), ("1234,5", 1234.5), ("1e3", 1000.0), ("x", None), ("1,2,3", None), (None, None),
])
def test_decimal_comma(spark, text, value):
    df = spark.createDataFrame([(text,)], "quantidade string")
    assert delimited.cast_measures(df).first()[0] == value
    assert delimited.unreadable_measures(df).first()["ilegiveis"] == (text is not None and value is None)


def test_cleaned_table_of_another_tool(spark, tmp_path):
    """Raw and derived columns whose names differ only in case stay apart."""
    path = tmp_path / "atendimentos_unificado.csv.gz"
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write("Regional,Ano,Mês,Data,Bairro,_ano_origem,ano,mes,estacao\n"
                "Norte,2025,Dezembro,2024-12-06,Dois Unidos,2025,2024.0,12.0,verao\n"
                "Norte,2025,Dezembro,,Ibura,2025,,,\n")
    rows = delimited.read_cleaned(spark, str(path)).orderBy("bairro").collect()
    assert [(r["ano_registro"], r["mes_registro"], r["ano"], r["mes"], r["_ano_origem"]) for r in rows] == [
        ("2025", "Dezembro", 2024, 12, 2025), ("2025", "Dezembro", None, None, 2025)]
    assert rows[0]["data_atendimento"].date().isoformat() == "2024-12-06"
    assert [tuple(r) for r in agg.by_year(delimited.read_cleaned(spark, str(path))).collect()] == [(2024, 1)]


def test_layout_difference(spark, corpus):
    lacking = delimited.layout_difference(delimited.probe_files(spark, corpus))
    got = {(r["coluna"], r["caminho"].rsplit("/", 1)[1]) for r in lacking.collect()}
    assert ("Status", "outros.csv") in got and ("Mês", "atendimentos_2023.csv") in got
    assert not [c for c, _ in got if c == "Bairro"]


@pytest.mark.parametrize("path, year", [
    ("/x/atendimentos_2024.csv", 2024), ("/x/x.csv", None), ("/x/ano=2019/part-0.csv", 2019),
    ("/x/2018_dados_2019.csv", 2018), ("/x/dados20245.csv", None),
])
def test_file_year(spark, path, year):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(delimited.file_year(F.col("p"))).first()[0] == year


def test_csv_table_has_the_codec_it_is_given(spark, tmp_path):
    df = spark.range(50)
    plain = Path(sinks.write_csv_table(df, str(tmp_path / "s"), compression="none"))
    big = Path(sinks.write_csv_table(df, str(tmp_path / "b")))
    assert list(plain.glob("*.csv")) and not list(plain.glob("*.gz"))
    lines = [line for f in big.glob("*.csv.gz") for line in gzip.open(f, "rt")]
    assert lines.count("id\n") == len(list(big.glob("*.csv.gz"))) and "49\n" in lines


def test_export_is_one_ordered_file_or_as_it_comes(spark, tmp_path):
    df = spark.range(100).repartition(5).orderBy(F.desc("id"))
    one = Path(sinks.write_csv_export(df, str(tmp_path / "one"), sep=";"))
    (file,) = one.glob("*.csv")
    assert file.read_text().split()[:3] == ["id", "99", "98"]
    many = Path(sinks.write_csv_export(spark.range(100, numPartitions=4), str(tmp_path / "many"), single_file=False))
    assert len(list(many.glob("*.csv"))) == 4


def test_quotes_are_doubled(spark, tmp_path):
    df = spark.createDataFrame([('rua "A", casa',), ("c:\\x",)], "t string")
    (file,) = Path(sinks.write_csv_export(df, str(tmp_path / "q"))).glob("*.csv")
    assert file.read_text() == 't\n"rua ""A"", casa"\nc:\\x\n'


def test_a_whole_table_is_not_exported_by_one_task(spark, monkeypatch):
    from conftest import SMALL
    from stormledger import catalog

    def one_part(df):
        raise AssertionError("all rows in one task")

    monkeypatch.setattr(sinks, "_one_part", one_part)
    assert catalog.QUERIES["sink_csv_quotes"](spark, SMALL).count() == 2 * spark.read.parquet(f"{SMALL}/events.parquet").count()


def test_write_many_skips_empty(spark, tmp_path):
    frames = {"a": spark.range(3), "vazio": spark.range(0), "b": spark.range(2)}
    assert sinks.write_many(frames, str(tmp_path)) == ["a", "b"]
    assert not (tmp_path / "vazio").exists()


def test_year_partitions_are_pruned(spark, tmp_path):
    df = spark.createDataFrame([(2023, 1), (2024, 2), (2024, 3)], "ano int, n int")
    path = sinks.write_parquet_by_year(df, str(tmp_path / "p"))
    read = spark.read.parquet(path).where("ano = 2024")
    assert sorted(r["n"] for r in read.collect()) == [2, 3]
    assert "PartitionFilters: [isnotnull(ano" in read._jdf.queryExecution().executedPlan().toString()


def test_json_report(spark, tmp_path):
    profile = profiling.profile_columns(spark.createDataFrame([("a",), (None,)], "c string"))
    path = Path(sinks.write_json(profile, str(tmp_path / "j")))
    rows = [json.loads(line) for f in path.glob("*.json") for line in f.read_text().splitlines()]
    assert rows == [{"nome": "c", "tipo": "string", "nulos": 1, "pct_nulos": 50.0, "valores_unicos": 1}]


def test_json_records(spark):
    payloads = ['[{"k": 1}, {"k": 2}]', ' {"k": 3}', '"texto"', "7", "{quebrado", "[]", None]
    df = spark.createDataFrame(list(enumerate(payloads)), "id int, corpo string")
    got = records.json_records(df, "corpo", "struct<k: int>", "id").collect()
    assert [tuple(r) for r in got if r["k"] is not None] == [(0, 1), (0, 2), (1, 3)]


def test_html_blocks(spark):
    html = '<table class="a">\n<tr>1</tr></table> x <table>2</table><table>aberta'
    df = spark.createDataFrame([(1, html), (2, "nada")], "id int, html string")
    got = [tuple(r) for r in records.html_blocks(df, "html", "table", "id").collect()]
    assert got == [(1, 0, "\n<tr>1</tr>"), (1, 1, "2")]
    assert [r["blocos"] for r in records.html_block_counts(df, "html", "table", "id").collect()] == [2, 0]


def test_catalogue_documents(spark):
    names = ["Atendimentos 2024", "atendimentos-2023", "ATENDIMENTOS 2023 v2", "Dicionário 2022", "Atendimentos"]
    document = json.dumps({"result": {"resources": [{"name": n, "url": f"u{i}"} for i, n in enumerate(names)]}})
    resources = records.catalog_resources(spark.createDataFrame([(document,)], "corpo string"), "corpo")
    assert [r["ano"] for r in records.catalog_years(resources).collect()] == [2023, 2024]
    years = spark.createDataFrame([(2022,), (2023,), (2024,)], "ano int")
    got = records.match_resource(resources, years).orderBy("ano").collect()
    assert [(r["ano"], r["url"]) for r in got] == [(2023, "u1"), (2024, "u0")]


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x").startswith(folder)
