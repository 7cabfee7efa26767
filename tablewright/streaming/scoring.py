"""Scoring a stream of rows with a stored pipeline: stateless, so no watermark is kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.exprs import col


def row_stream(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files of a folder as a stream; the schema is declared, never inferred."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def score_stream(
    rows: DataFrame, model: PipelineModel, sink: str, checkpoint: str, keep: Sequence[str]
) -> StreamingQuery:
    """Scores what is available and appends (keep..., prediction) to ``sink``, exactly once.

    The checkpoint and the sink must be folders every executor can reach.
    """
    scored = model.transform(rows).select(*[col(k) for k in keep], F.col("prediction"))
    return (
        scored.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
