"""Session settings for local runs, and the shared scratch folder of a cluster."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Bytes of a source that one part of it holds.
PART_BYTES = 8 << 20


def local_session(cores: str = "8", app: str = "tablewright") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "16g")
        .config("spark.pyspark.python", sys.executable)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tablewright-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other job uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def local_table(spark: SparkSession, rows: Iterable[Sequence], schema: str | T.StructType) -> DataFrame:
    """A handful of driver-side rows as a relation the optimizer knows the size of."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema)
    rows = [tuple(r) for r in rows]
    columns = [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema=schema)


def spread_out(df: DataFrame, key: str) -> DataFrame:
    """Rows over all cores, in parts of about ``PART_BYTES`` of the source; one of as many files is left alone.

    Files are listed from the plan and their lengths asked of the file system, without running a job: the number of
    parts grows with the source, so that no part of it does, nor what is cached or read of one.
    """
    spark, files = df.sparkSession, df.inputFiles()
    parts = max(spark.sparkContext.defaultParallelism, -(-_length(spark, files) // PART_BYTES))
    return df if len(files) >= parts else df.repartition(parts, key)


def _length(spark: SparkSession, files: Sequence[str]) -> int:
    """Bytes of the files, which may lie on any file system Spark reads."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in files]
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)


def fetched(df: DataFrame) -> DataFrame:
    """A result table of a few rows (one per model, fold or check), computed now."""
    return local_table(df.sparkSession, df.collect(), df.schema)


def checkpoints_ready(spark: SparkSession) -> None:
    """Points checkpoints at the shared folder unless the session already has one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
