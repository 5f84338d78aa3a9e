"""Growing corpora: a stored manifest tells which files are new or changed.

A store is a folder with two tables. ``linhas`` holds the rows of each load with the path
of their file; ``arquivos``, the manifest, one row per file and load: path, size,
modification time, encoding, separator, header, rows and load. A load lists the
corpus, drops by an anti join what the manifest already has, and probes and reads the rest only. Rows
are written before the manifest, so a load that broke off leaves nothing that is seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stormledger.session import materialize, stored_table
from stormledger.sources import delimited

LOAD, PATH = "_carga", "_caminho"
READ, GONE = "lido", "ausente"
FILES = (
    "caminho string, bytes bigint, modificado timestamp, encoding string, separador string, cabecalho string, "
    "quebras boolean, linhas bigint, estado string, carga int"
)


def listing(spark: SparkSession, path: str | list[str], names: str = delimited.CSV_FILES) -> DataFrame:
    """(caminho, bytes, modificado) of every file with content; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", names).load(path)
    )
    return files.select(
        F.col("_metadata.file_path").alias("caminho"), F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modificado"),
    )


def manifest(spark: SparkSession, store: str) -> DataFrame:
    """The last entry of every file."""
    entries = stored_table(spark, f"{store}/arquivos", FILES)
    latest = Window.partitionBy("caminho").orderBy(F.desc("carga"))
    return entries.withColumn("_r", F.row_number().over(latest)).where("_r = 1").drop("_r")


def pending(spark: SparkSession, path: str | list[str], store: str, names: str = delimited.CSV_FILES) -> DataFrame:
    """Files of the listing that the manifest lacks or has with another size or time."""
    known = manifest(spark, store).where(F.col("estado") == READ)
    return listing(spark, path, names).join(known, ["caminho", "bytes", "modificado"], "left_anti")


def ingest(
    spark: SparkSession, path: str | list[str], store: str, canonical: bool = True, names: str = delimited.CSV_FILES,
    drop_missing: bool = False,
) -> int:
    """Read new and changed files into the store; returns how many.

    A changed file's earlier rows are superseded. With ``drop_missing`` the rows of
    files that the corpus no longer has leave the current rows as well. A repeated
    run reads no file and adds nothing.
    """
    number = 1 + (stored_table(spark, f"{store}/arquivos", FILES).agg(F.max("carga")).first()[0] or 0)
    new = materialize(pending(spark, path, store, names), "pending")
    # the paths of new files alone, as any scan of them needs
    paths = [delimited.readable_path(r["caminho"]) for r in new.select("caminho").collect()]
    entries = []
    if paths:
        probe = materialize(delimited.probe_files(spark, paths, names), "probe")
        rows = delimited.read_corpus(spark, paths, canonical, names=names, probe=probe, keep_path=PATH)
        # overwrite: what a load that broke off has left under this number
        rows.write.mode("overwrite").parquet(f"{store}/linhas/{LOAD}={number}")
        counts = spark.read.parquet(f"{store}/linhas/{LOAD}={number}").groupBy(F.col(PATH).alias("caminho")).agg(F.count(F.lit(1)).alias("_n"))
        read = new.join(probe.select("caminho", "encoding", "separador", "cabecalho", "quebras"), "caminho", "left")
        entries.append(read.join(counts, "caminho", "left").select(
            "caminho", "bytes", "modificado", "encoding", "separador", "cabecalho", "quebras",
            F.coalesce("_n", F.lit(0)).alias("linhas"), F.lit(READ).alias("estado")))
    if drop_missing:
        there = listing(spark, path, names).select("caminho")
        gone = manifest(spark, store).where(F.col("estado") == READ).join(there, "caminho", "left_anti")
        entries.append(gone.drop("carga").withColumns({"estado": F.lit(GONE), "linhas": F.lit(0).cast("bigint")}))
    for found in entries:
        stored = materialize(found.withColumn("carga", F.lit(number)), "entries")
        if not stored.isEmpty():
            stored.write.mode("append").parquet(f"{store}/arquivos")
    return len(paths)


def rows(spark: SparkSession, store: str) -> DataFrame:
    """The current rows: of each file those of the load that read it last."""
    valid = manifest(spark, store).where((F.col("estado") == READ) & (F.col("linhas") > 0))
    valid = valid.select(F.col("caminho").alias(PATH), F.col("carga").alias(LOAD))
    stored = spark.read.option("mergeSchema", True).parquet(f"{store}/linhas")
    # Spark broadcasts the manifest where its size allows
    return stored.join(valid, [PATH, LOAD], "left_semi")
