"""Delimited yearly files with mixed encodings, layouts and damaged lines."""

from __future__ import annotations

import csv
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stormledger import schema, vocab
from stormledger.session import materialize

DAMAGED = "_linha_danificada"
FILE_NAME = "_arquivo"
FILE_YEAR = "_ano_origem"
SEPARATORS = [";", ",", "\t"]
# Encoding, separator, header line of a file, and whether quotes hold line breaks.
Layout = tuple[str, str, str, bool]
# File names a corpus consists of.
CSV_FILES = "*.[cC][sS][vV]"
# The same, plain or gzip-compressed.
CSV_OR_GZIP_FILES = "*.[cC][sS][vV]{,.gz}"
# A year is a four-digit part of a name between "_", "=", start, end or ".".
YEAR_PATTERN = r"(?:^|[_=])(\d{4})(?:_|\.|$)"


def name_year(name: Column) -> Column:
    """Year in a file or folder name, null if none."""
    year = F.regexp_extract(name, YEAR_PATTERN, 1)
    return F.when(year != "", year).cast("int")


def file_year(path: Column) -> Column:
    """Year in the file name, else in the name of its folder, null if none."""
    parts = F.split(path, "/")
    return F.coalesce(name_year(F.element_at(parts, -1)), name_year(F.try_element_at(parts, F.lit(-2))))


def _field_count(line: Column, sep: str | Column) -> Column:
    # Separators inside quotes do not count.
    sep = F.lit(sep) if isinstance(sep, str) else sep
    bare = F.when(F.contains(line, F.lit('"')), F.regexp_replace(line, r'"[^"]*"', "")).otherwise(line)
    return F.char_length(bare) - F.char_length(F.replace(bare, sep, F.lit(""))) + 1


def read_delimited(
    spark: SparkSession, path: str | list[str], columns: list[str],
    sep: str = ";", encoding: str = "UTF-8", header: bool = True,
    nulls: list[str] = vocab.NULL_TEXTS, multi_line: bool = False, names: str = "*",
) -> DataFrame:
    """Scan files of one layout as text columns.

    Lines with too many fields are dropped; short lines are padded with nulls
    (DROPMALFORMED would drop both). Only lines the parser marks as damaged
    are looked at again. Texts in ``nulls`` become null. ``multi_line`` accepts
    line breaks inside quotes, at the price of one task per file.
    """
    fields = ", ".join(f"`{c}` string" for c in [*columns, DAMAGED])
    rows = (
        spark.read.schema(fields)
        .option("sep", sep).option("header", header).option("encoding", encoding)
        .option("quote", '"').option("escape", '"')
        .option("recursiveFileLookup", True).option("pathGlobFilter", names)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", DAMAGED)
        # A pruned parse counts only the wanted fields and would miss long lines.
        .option("columnPruning", False)
        .csv(path)
    )
    damaged, first = F.col(DAMAGED), F.col(f"`{columns[0]}`")
    # The (always true) look at a real column lets Spark answer a bare count:
    # it refuses scans that read nothing but the damaged-line column.
    short = (_field_count(damaged, sep) <= len(columns)) & (
        F.char_length(F.coalesce(first, F.lit(""))) >= 0
    )
    absent = ", ".join("'" + text.replace("'", "\\'") + "'" for text in nulls)
    return rows.where(damaged.isNull() | short).selectExpr(
        [f"CASE WHEN `{c}` NOT IN ({absent}) THEN `{c}` END AS `{c}`" for c in columns]
        if nulls else [f"`{c}`" for c in columns]
    )


def probe_files(spark: SparkSession, path: str | list[str], names: str = CSV_FILES) -> DataFrame:
    """One row per file: encoding, separator, header line, number of lines, line breaks in quotes.

    One scan of the raw bytes finds the encoding (UTF-8 if every line is valid
    UTF-8, else ISO-8859-1), a hash of the first line of each file and whether
    some line has an odd number of quotes; all aggregation buffers have a fixed
    width, so nothing is sorted. One more job reads the header texts, from one
    file per distinct hash. The result can be stored and passed to
    ``read_corpus``; a daily load then probes its new files only.
    """
    lines = _raw_lines(spark, path, names).select(
        F.col("_metadata.file_path").alias("caminho"),
        F.col("_metadata.file_name").alias("arquivo"),
        (F.col("_metadata.file_block_start") == 0).alias("_inicio"),
        # Lines keep their order inside a block, and the header leads block 0.
        F.monotonically_increasing_id().alias("_posicao"),
        "value",
    )
    hashed = F.when(F.col("_inicio"), F.xxhash64("value"))
    files = lines.groupBy("caminho", "arquivo").agg(
        F.every(F.is_valid_utf8("value")).alias("_utf8"),
        F.some(F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1).alias("quebras"),
        F.min_by(hashed, F.when(F.col("_inicio"), F.col("_posicao"))).alias("_hash"),
        F.count(F.lit(1)).alias("linhas"),
    )
    files = materialize(files, "probe")
    layouts = files.groupBy("_utf8", "_hash").agg(F.min("caminho").alias("exemplo")).collect()
    headers = _headers(spark, [layout["exemplo"] for layout in layouts], names)
    rows = []
    for layout in layouts:
        encoding = "UTF-8" if layout["_utf8"] else "ISO-8859-1"
        header = headers[layout["exemplo"]].decode(encoding).removeprefix("\ufeff").rstrip("\r")
        rows.append((layout["_utf8"], layout["_hash"], encoding, header, separator_of(header)))
    known = spark.createDataFrame(
        rows, "_utf8 boolean, _hash bigint, encoding string, cabecalho string, separador string"
    )
    # One row per distinct layout: a bounded broadcast.
    return files.join(F.broadcast(known), ["_utf8", "_hash"]).drop("_utf8", "_hash")


def _headers(spark: SparkSession, files: list[str], names: str) -> dict[str, bytes]:
    """First line of each of a few files, as bytes."""
    if not files:
        return {}
    lines = _raw_lines(spark, [readable_path(f) for f in files], names).where(F.col("_metadata.file_block_start") == 0)
    first = lines.select(
        F.col("_metadata.file_path").alias("caminho"), F.monotonically_increasing_id().alias("_posicao"),
        F.col("value").cast("binary").alias("h"),
    ).groupBy("caminho").agg(F.min_by("h", "_posicao").alias("h"))
    return {row["caminho"]: bytes(row["h"]) for row in first.collect()}


def found_files(spark: SparkSession, path: str | list[str], names: str = CSV_FILES) -> DataFrame:
    """(caminho, arquivo) of every file below a path; no content is read.

    A scan would leave out empty files, so the names come from the list of
    files that Spark's driver makes for any scan of the path.
    """
    listed = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", names).text(path).inputFiles()
    files = spark.createDataFrame([(f,) for f in listed], "caminho string")
    return files.withColumn("arquivo", F.element_at(F.split("caminho", "/"), -1))


def _raw_lines(spark: SparkSession, path: str | list[str], names: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", names).text(path)


def header_columns(header: str, sep: str) -> list[str]:
    """Column names of a header line."""
    return [name.strip() for name in next(csv.reader([header], delimiter=sep))]


def separator_of(header: str) -> str:
    """The candidate that splits a header line into most columns; ";" wins ties."""
    return max(SEPARATORS, key=lambda sep: len(header_columns(header, sep)))


def readable_path(file_path: str) -> str:
    """A ``_metadata.file_path`` (URL-encoded) as a path to read, with glob characters escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file_path))


def read_corpus(
    spark: SparkSession, path: str | list[str], canonical: bool = True, cleaned: bool = False,
    names: str = CSV_FILES, probe: DataFrame | None = None, keep_path: str | None = None,
) -> DataFrame:
    """Read and unite files of any mix of encodings, separators and layouts.

    The probe runs first, unless a stored one of these files is given; files it
    does not name are left out. One scan of lines reads all files: each line gets
    the layout of its file, is parsed by its separator, and its fields go to the
    columns of that name, with nulls for absent ones. So the plan does not grow with
    the number of layouts. Only files with line breaks in quotes are scanned apart, layout by
    layout, and lose splitting. A line that repeats the header of its file's first
    block is no record. ``_arquivo`` and ``_ano_origem`` keep
    the provenance, and the column ``keep_path``, if named, the whole path.
    """
    probed = probe_files(spark, path, names) if probe is None else probe
    layouts = sorted(tuple(r) for r in probed.select("encoding", "separador", "cabecalho", "quebras").distinct().collect())
    if not layouts:
        return schema.empty(probed, f"{FILE_NAME} string, {FILE_YEAR} int")
    columns = {layout: _columns(layout, canonical, cleaned) for layout in layouts}
    frames = []
    split = {layout: columns[layout] for layout in layouts if not layout[3]}
    if split:
        frames.append(_read_lines(spark, path, probed, split, names, keep_path))
    if len(split) < len(layouts):
        broken = {k: p for k, p in scan_paths(*_folder_layouts(probed, F.col("quebras"))).items() if k[3]}
        frames += [_read_layout(spark, k, broken[k], columns[k], names, keep_path) for k in sorted(broken)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _columns(layout: Layout, canonical: bool, cleaned: bool) -> list[str]:
    headers = header_columns(layout[2], layout[1])
    return schema.canonical_names(headers, cleaned) if canonical else schema.unique_names(headers)


# Files whose layouts are broadcast to the scan: their paths are some tens of megabytes. Beyond, Spark joins them.
BROADCAST_FILES = 200_000


def _read_lines(
    spark: SparkSession, path: str | list[str], probed: DataFrame, layouts: dict[Layout, list[str]], names: str,
    keep_path: str | None,
) -> DataFrame:
    """All files of the given layouts in one scan of lines."""
    united: dict[str, str] = {}
    for columns in layouts.values():
        for c in columns:
            united.setdefault(c.lower(), c)
    wanted = [c for c in united.values() if c != FILE_NAME]

    def places(columns: list[str]) -> list[int | None]:
        at = {c.lower(): i for i, c in enumerate(columns)}
        return [at.get(c.lower()) for c in wanted]

    # One row per distinct layout: a bounded broadcast.
    known = spark.createDataFrame(
        [(i, *layout[:3], len(columns), places(columns)) for i, (layout, columns) in enumerate(layouts.items())],
        "_formato int, encoding string, separador string, cabecalho string, _campos int, _lugares array<int>",
    )
    files = materialize(
        probed.where(~F.col("quebras")).join(F.broadcast(known), ["encoding", "separador", "cabecalho"])
        .select("caminho", "_formato"), "file-layouts",
    )
    lines = _raw_lines(spark, path, names).select(
        "value", F.col("_metadata.file_path").alias("caminho"), F.col("_metadata.file_name").alias(FILE_NAME),
        (F.col("_metadata.file_block_start") == 0).alias("_inicio"),
    )
    few = files.count() <= BROADCAST_FILES
    lines = lines.join(F.broadcast(files) if few else files, "caminho").join(F.broadcast(known), "_formato")
    latin = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    lines = lines.withColumn("_linha", F.when(F.col("encoding") == "UTF-8", F.col("value")).otherwise(latin))
    line, sep, header = F.col("_linha"), F.col("separador"), F.col("cabecalho")
    is_header = F.col("_inicio") & ((line == header) | (line == F.concat(F.lit("\ufeff"), header)))
    rows = lines.where(~is_header & line.rlike(r"[^\x00-\x20]") & (_field_count(line, sep) <= F.col("_campos")))
    width = max(map(len, layouts.values()))
    fields = ", ".join(f"c{i} string" for i in range(width))
    parsed = None
    for one in sorted({layout[1] for layout in layouts}):
        read = F.from_csv(line, F.lit(fields), {"sep": one, "quote": '"', "escape": '"', "mode": "PERMISSIVE"})
        parsed = F.when(sep == one, read) if parsed is None else parsed.when(sep == one, read)
    # Parsed once, below all the fields that are taken from it.
    rows = rows.withColumn("_campo", parsed).withColumn("_valores", F.array(*[F.col(f"_campo.c{i}") for i in range(width)]))

    def value(i: int) -> Column:
        found = F.get("_valores", F.get("_lugares", F.lit(i)))
        return F.when(~found.isin(vocab.NULL_TEXTS), found)

    out = [value(i).alias(c) for i, c in enumerate(wanted) if c != FILE_YEAR]
    # A file may already hold a provenance column from an earlier stage.
    year = file_year(F.col("caminho"))
    if FILE_YEAR in wanted:
        at = wanted.index(FILE_YEAR)
        year = F.when(F.get("_lugares", F.lit(at)).isNotNull(), value(at).cast("int")).otherwise(year)
    path_column = [F.col("caminho").alias(keep_path)] if keep_path else []
    return rows.select(*out, FILE_NAME, year.alias(FILE_YEAR), *path_column)


def _folder_layouts(probed: DataFrame, wanted: Column | None = None) -> tuple[dict[str, Layout], dict[str, Layout]]:
    """Layout of each folder whose files agree and that holds no other folder, and of each (wanted) file elsewhere."""
    layout = F.struct("encoding", "separador", "cabecalho", "quebras")
    files = probed.select(
        F.regexp_extract("caminho", r"^(.*)/[^/]*$", 1).alias("pasta"), "caminho", layout.alias("formato")
    )
    folders = files.groupBy("pasta").agg(
        F.min("formato").alias("formato"), (F.min("formato") == F.max("formato")).alias("igual")
    ).collect()
    ordered = sorted(row["pasta"] + "/" for row in folders)
    # A folder that holds other folders sorts right before the first of them.
    nested = {a for a, b in zip(ordered, ordered[1:]) if b.startswith(a)}
    whole = {r["pasta"]: tuple(r["formato"]) for r in folders if r["igual"] and r["pasta"] + "/" not in nested}
    mixed = [(r["pasta"],) for r in folders if r["pasta"] not in whole]
    if not mixed:
        return whole, {}
    spark = probed.sparkSession
    if wanted is not None:
        files = probed.where(wanted).select(F.regexp_extract("caminho", r"^(.*)/[^/]*$", 1).alias("pasta"), "caminho", layout.alias("formato"))
    single = files.join(spark.createDataFrame(mixed, "pasta string"), "pasta").select("caminho", "formato")
    return whole, {r["caminho"]: tuple(r["formato"]) for r in single.toLocalIterator()}


def scan_paths(folders: dict[str, Layout], files: dict[str, Layout]) -> dict[Layout, list[str]]:
    """Paths to scan per layout."""
    paths: dict[Layout, list[str]] = {}
    for path, layout in [*folders.items(), *files.items()]:
        paths.setdefault(layout, []).append(readable_path(path))
    return {layout: sorted(found) for layout, found in paths.items()}


def _read_layout(spark: SparkSession, layout: Layout, paths: list[str], columns: list[str], names: str, keep_path: str | None) -> DataFrame:
    encoding, sep, _, breaks = layout
    # A file may already hold a provenance column from an earlier stage.
    kept = [c for c in columns if c not in (FILE_NAME, FILE_YEAR)]
    rows = read_delimited(spark, paths, columns, sep, encoding, multi_line=breaks, names=names)
    return rows.select(
        *kept, F.col("_metadata.file_name").alias(FILE_NAME),
        F.col(FILE_YEAR).cast("int").alias(FILE_YEAR) if FILE_YEAR in columns
        else file_year(F.col("_metadata.file_path")).alias(FILE_YEAR),
        *([F.col("_metadata.file_path").alias(keep_path)] if keep_path else []),
    )


# A number with a decimal comma, its thousands perhaps parted by points.
COMMA_NUMBER = r"^[+-]?(\d+|\d{1,3}(\.\d{3})+),\d+$"
# A whole number whose thousands are parted by several points; one point alone is a decimal point.
POINTS_NUMBER = r"^[+-]?\d{1,3}(\.\d{3}){2,}$"


def number(c: Column) -> Column:
    """Text as a double, with a decimal point or a decimal comma; null if it is neither."""
    plain = F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(c.rlike(COMMA_NUMBER) | c.rlike(POINTS_NUMBER), plain).otherwise(c).try_cast("double")


def _raw_measures(df: DataFrame) -> list[str]:
    kinds = dict(df.dtypes)
    return [c for c in schema.NUMERIC_COLUMNS if kinds.get(c) == "string"]


def cast_measures(df: DataFrame) -> DataFrame:
    """Numeric raw columns as doubles; ``unreadable_measures`` tells what becomes null."""
    return df.withColumns({c: number(F.trim(c)) for c in _raw_measures(df)})


def unreadable_measures(df: DataFrame) -> DataFrame:
    """(coluna, preenchidos, ilegiveis) of the numeric raw columns."""
    measures = [
        F.struct(
            F.lit(c).alias("coluna"), F.count(c).alias("preenchidos"),
            F.count_if(F.col(c).isNotNull() & number(F.trim(c)).isNull()).alias("ilegiveis"),
        )
        for c in _raw_measures(df)
    ]
    if not measures:
        return schema.empty(df, "coluna string, preenchidos bigint, ilegiveis bigint")
    return df.agg(F.array(*measures).alias("m")).select(F.inline("m"))


def read_cleaned(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Read back a cleaned table from plain or gzip CSV, with typed columns."""
    df = read_corpus(spark, path, cleaned=True, names=CSV_OR_GZIP_FILES)
    # "2024.0" is a number another tool may have written for 2024.
    whole = {
        c: F.col(c).try_cast("double").cast("int") for c in schema.INTEGER_COLUMNS if c in df.columns
    }
    # Cleaned dates are ISO text, with or without a time.
    dates = {c: F.col(c).try_cast("timestamp_ntz") for c in schema.date_columns(df)}
    return cast_measures(df).withColumns(whole | dates)


def corpus_summary(
    df: DataFrame, found: DataFrame | None = None, key: Column | None = None
) -> DataFrame:
    """Rows, files found and files that gave rows, per file and, with a null file, overall.

    ``found`` (of ``found_files``) also brings in the files that gave no row;
    without it only files with rows count. ``key`` sums files up, such as by
    year, from the name in ``_arquivo``.
    """
    per_file = df.groupBy(FILE_NAME).agg(F.count(F.lit(1)).alias("registros"))
    if found is None:
        per_file = per_file.withColumns({"arquivos": F.lit(1), "processados": F.lit(1)})
    else:
        there = found.groupBy(F.col("arquivo").alias(FILE_NAME)).agg(F.count(F.lit(1)).alias("arquivos"))
        per_file = there.join(per_file, FILE_NAME, "left").withColumns({
            "registros": F.coalesce("registros", F.lit(0)),
            "processados": F.when(F.col("registros") > 0, F.col("arquivos")).otherwise(F.lit(0)),
        })
    shown = F.col(FILE_NAME) if key is None else key
    return per_file.withColumn(FILE_NAME, shown).rollup(FILE_NAME).agg(
        F.sum("registros").alias("registros"), F.sum("arquivos").alias("arquivos"),
        F.sum("processados").alias("processados"),
    )


def layout_difference(probed: DataFrame) -> DataFrame:
    """(coluna, caminho) rows of the columns that some file of a probe lacks."""
    quoted = F.split(F.col("cabecalho"), F.concat(F.lit("["), F.col("separador"), F.lit("]")))
    names = F.transform(quoted, lambda h: F.trim(F.replace(h, F.lit('"'), F.lit(""))))
    present = probed.select("caminho", F.explode(names).alias("coluna")).distinct()
    files = probed.select(F.count(F.lit(1)).alias("_f")).scalar()
    partial = present.groupBy("coluna").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") < files)
    return present.join(partial, "coluna", "left_semi").select("coluna", "caminho")
