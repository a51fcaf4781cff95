"""Reading and writing bar archives, CSV, JSON and Parquet with explicit schemas, and fingerprints of files."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.sources.scratch import stored


def append_run(bars: DataFrame, path: str, run_id: str) -> None:
    """Add a run to the archive; files of earlier runs are not touched."""
    bars.withColumn("run_id", F.lit(run_id)).write.partitionBy("run_id", "symbol").mode("append").parquet(path)


def read_run(spark: SparkSession, path: str, schema: str, run_id: str) -> DataFrame:
    """Bars of one run: only its folders are listed and read. schema: without symbol, which the folder names."""
    return spark.read.schema(f"{schema}, run_id string, symbol string").parquet(path).where(F.col("run_id") == run_id)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Typed columns; an empty string is null."""
    return spark.read.schema(schema).option("header", True).option("nullValue", "").csv(path)


def write_parquet(df: DataFrame, path: str, *by: str) -> None:
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def inspect(raw: DataFrame, start, end) -> DataFrame:
    """Per symbol: rows, first and last session, repeated dates, nulls per column, rows outside [start, end)."""
    columns = ["open", "high", "low", "close", "adj_close", "volume"]
    outside = (F.col("session_date") < start) | (F.col("session_date") >= end)
    return raw.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("session_date").alias("first_session"), F.max("session_date").alias("last_session"),
        (F.count("session_date") - F.count_distinct("session_date")).alias("duplicate_dates"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns], F.count_if(outside).alias("outside"),
    )


def _below(path: str, column: str) -> Column:
    """The part of a file's path below `path`, whose last folder's name is its own."""
    return F.substring_index(F.col(column), "/" + path.rstrip("/").rsplit("/", 1)[-1] + "/", -1)


PIECE = 1 << 20  # bytes of a file that are held at once
STREAMED = ("file", "hdfs", "s3", "gs", "abfs", "abfss")  # schemes of file systems that workers open themselves


def _opened(uri: str):
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_stream("/" + rest.lstrip("/"))
    authority, _, path = rest.removeprefix("//").partition("/")
    system, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system.open_input_stream(f"{base.rstrip('/')}/{path}")


def _digests(piece: int):
    """SHA-256 of each file, read piece by piece; a file that isn't as long as it was when it was listed is an error."""

    def digest(uri: str, length: int) -> str:
        sha, n = hashlib.sha256(), 0
        with _opened(uri) as stream:
            while data := stream.read(piece):
                sha.update(data)
                n += len(data)
        if n != length:
            raise ValueError(f"{uri} changed while it was read: {n} bytes instead of {length}")
        return sha.hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(sha256=[digest(p, n) for p, n in zip(batch["path"], batch["length"])])

    return run


def file_fingerprints(spark: SparkSession, path: str, piece: int = PIECE) -> DataFrame:
    """file (path below `path`), sha256 and length of every Parquet file below path.

    Files are listed without their contents, dealt over the tasks, and digested in pieces, so that a file of any size takes constant memory. On file systems that
    workers can't open themselves, Spark reads each file as one value of 2 GB at most; a larger one is an error there. Files of no bytes, which no Parquet file is, aren't listed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    listed = files.select("path", "length")
    one = listed.first()
    if one and one["path"].partition(":")[0] in STREAMED:
        files = listed.repartition("path").mapInPandas(_digests(piece), "path string, length long, sha256 string")
    else:
        files = files.select("path", "length", F.sha2("content", 256).alias("sha256"))
    return files.select(_below(path, "path").alias("file"), "sha256", "length")


def _running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of all rows in their order, joined by line feeds, and how many they are."""
    sha, n = hashlib.sha256(), 0
    for batch in batches:
        if len(batch):
            sha.update((("\n" if n else "") + "\n".join(batch["row"])).encode())
            n += len(batch)
    yield pd.DataFrame({"dataset_id": [sha.hexdigest()], "members": [n]})


def dataset_id(identity: DataFrame, *columns: str) -> DataFrame:
    """One row: SHA-256 over the sorted JSON of the identity's rows, and their number. Identities are manifests, one row per output.

    The digest of a sequence is one task's work; its rows are sorted there with spilling and digested as they come, so that their number doesn't matter for memory.
    """
    rows = identity.select(F.to_json(F.struct(*columns)).alias("row")).repartition(1).sortWithinPartitions("row")
    ids = rows.mapInPandas(_running, "dataset_id string, members long")
    return ids.agg(F.coalesce(F.max("dataset_id"), F.sha2(F.lit("").cast("binary"), 256)).alias("dataset_id"), F.coalesce(F.max("members"), F.lit(0)).alias("members"))


def manifest_mismatches(manifest: DataFrame, actual: DataFrame, key: str, *values: str) -> DataFrame:
    """One row: outputs that are missing, unknown, or differ in a value."""
    m = manifest.select(key, F.struct(*values).alias("m"))
    a = actual.select(key, F.struct(*values).alias("a"))
    both = m.join(a, key, "full_outer")
    return both.agg(F.count_if(F.col("a").isNull()).alias("missing"), F.count_if(F.col("m").isNull()).alias("unknown"), F.count_if(F.col("a").isNotNull() & F.col("m").isNotNull() & ~F.col("a").eqNullSafe(F.col("m"))).alias("different"))


def write_with_manifest(df: DataFrame, path: str, *by: str) -> DataFrame:
    """Write df below path, and return a manifest of what was written: file, sha256, n_rows. It is a table of its own, which later changes don't reach."""
    df.write.partitionBy(*by).parquet(path)
    return stored(files_with_rows(df.sparkSession, path), "manifest")


def files_with_rows(spark: SparkSession, path: str) -> DataFrame:
    """file, sha256 and n_rows of every Parquet file below path, read now."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(path).groupBy(_below(path, "_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
    return file_fingerprints(spark, path).drop("length").join(rows, "file", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


def verified(manifest: DataFrame, path: str) -> DataFrame:
    """The rows below path, if its files are those of the manifest (file, sha256, n_rows); any difference is an error before a row is read."""
    spark = manifest.sparkSession
    found = manifest_mismatches(manifest, files_with_rows(spark, path), "file", "sha256", "n_rows").first()
    if any(found):
        raise ValueError(f"files differ from their manifest: {found.asDict()}")
    return spark.read.option("recursiveFileLookup", True).parquet(path)


def schema_summary(df: DataFrame) -> DataFrame:
    """column and kind (boolean, double or string) of a table, as published."""
    kinds = [(c, "boolean" if t == "boolean" else "string" if t.split("(")[0] in ("string", "date", "timestamp", "timestamp_ntz") else "double") for c, t in df.dtypes]
    return df.sparkSession.createDataFrame(kinds, "column string, kind string")
