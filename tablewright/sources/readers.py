"""Reading tables against their contract, and recording where they came from."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import col
from ..session import local_table
from .contracts import DatasetSpec, shape_report

CORRUPT = "_corrupt_row"
#: Bytes of a file that a task may hold as one cell.
WHOLE_BYTES = 256 << 20


class DatasetMissing(FileNotFoundError):
    """A registered table is not where it should be."""


def source_path(spec: DatasetSpec, root: str) -> str:
    return f"{root.rstrip('/')}/{spec.filename}"


def _missing(spec: DatasetSpec, path: str) -> DatasetMissing:
    hint = f" Download it from {spec.url} and place '{spec.filename}' there." if spec.url else ""
    return DatasetMissing(f"no table for the {spec.track} track at {path}.{hint}")


def load_raw(spark: SparkSession, spec: DatasetSpec, root: str) -> DataFrame:
    """The raw table with its declared schema; CSV with a header, or Parquet.

    Rows that do not fit the schema are kept with NULLs, never dropped.
    """
    path = source_path(spec, root)
    try:
        if spec.filename.endswith(".csv"):
            reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
            return (reader.schema(spec.schema) if spec.schema else reader).csv(path)
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise _missing(spec, path) from e
        raise


def misfits(spark: SparkSession, spec: DatasetSpec, root: str) -> DataFrame:
    """CSV rows that do not fit the declared schema: their text as ``raw``, then what parsed."""
    schema = T.StructType([*spec.schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(source_path(spec, root))
    )
    # Spark fills the corrupt-row column only when the others are read with it
    return rows.where(F.col(CORRUPT).isNotNull()).select(
        F.col(CORRUPT).alias("raw"), *[col(c) for c in spec.schema.fieldNames()]
    )


def sweep(spark: SparkSession, specs: Iterable[DatasetSpec], root: str) -> DataFrame:
    """(track, path, present, detail) for every registered table."""
    rows = []
    for spec in specs:
        path = source_path(spec, root)
        try:
            load_raw(spark, spec, root)
            rows.append((spec.track, path, True, ""))
        except DatasetMissing as e:
            rows.append((spec.track, path, False, str(e)))
    return local_table(spark, rows, "track string, path string, present boolean, detail string")


def shape(spark: SparkSession, spec: DatasetSpec, root: str) -> DataFrame:
    return shape_report(load_raw(spark, spec, root), spec.track, spec.expected_shape)


def row_digest(df: DataFrame) -> DataFrame:
    """(rows, digest): the same for the same rows in any order and partitioning."""
    h = F.xxhash64(*[col(c) for c in df.columns])
    return df.agg(F.count("*").alias("rows"), F.bit_xor(h).alias("xor"), F.sum(F.pmod(h, F.lit(1 << 31))).alias("s")).select(
        "rows", F.concat_ws("-", F.hex("xor"), F.hex("s")).alias("digest")
    )


def provenance(spark: SparkSession, spec: DatasetSpec, root: str, df: DataFrame) -> DataFrame:
    """One row: file hash, bytes, shape, row digest, source and date.

    Every file is hashed in a task of its own, or as a stream if it is too long for a cell. A source of one file has
    that file's hash; one of several has the hash of the sorted list of their names, lengths and hashes.
    """
    path = source_path(spec, root)
    files = spark.read.format("binaryFile").load(path)
    most = min(WHOLE_BYTES, int(spark.conf.get("spark.sql.sources.binaryFile.maxLength", str(WHOLE_BYTES))))
    name, long = F.substring_index("path", "/", -1).alias("name"), F.col("length") > most
    each = files.where(~long).select(name, "length", F.sha2("content", 256).alias("h"))
    # names and lengths alone: contents are read by the stream
    streamed = [(r["name"], r["length"], _streamed_hash(spark, r["path"])) for r in files.where(long).select("path", name, "length").collect()]
    each = each.unionByName(local_table(spark, streamed, "name string, length bigint, h string"))
    listed = F.array_sort(F.collect_list(F.concat_ws(" ", "name", "length", "h")))
    size = each.agg(
        F.sum("length").alias("b"), F.count("*").alias("n"), F.max("h").alias("h"),
        F.sha2(F.array_join(listed, "\n"), 256).alias("many"),
    ).first()
    digest = F.lit(size["h"] if size["n"] == 1 else size["many"])
    return row_digest(df).select(
        F.lit(spec.track).alias("track"),
        F.lit(spec.filename).alias("filename"),
        F.lit(spec.url).alias("source_url"),
        F.current_date().cast("string").alias("retrieved_on"),
        digest.alias("sha256"),
        F.lit(size["b"]).alias("size_bytes"),
        F.col("rows").alias("raw_rows"),
        F.lit(len(df.columns)).alias("raw_cols"),
        F.col("digest").alias("row_digest"),
    )


def _streamed_hash(spark: SparkSession, path: str) -> str:
    """The SHA-256 of a file of any length on any file system Spark reads, a megabyte in memory at a time.

    The hash needs every byte in order, so more tasks would not help, and Spark hands a task a file as one cell below 2 GB.
    """
    jvm = spark._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    digest = jvm.java.security.MessageDigest.getInstance("SHA-256")
    source = jvm.java.security.DigestInputStream(file.getFileSystem(spark._jsc.hadoopConfiguration()).open(file), digest)
    jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, jvm.java.io.OutputStream.nullOutputStream(), 1 << 20, True)
    return bytes(digest.digest()).hex()


def upsert(existing: DataFrame | None, new: DataFrame, key: str = "track") -> DataFrame:
    """``existing`` with the rows of ``new`` replacing those of the same key."""
    if existing is None:
        return new
    return existing.join(new.select(key), key, "left_anti").select(*existing.columns).unionByName(
        new, allowMissingColumns=True
    )
