"""The model store: fitted pipelines, their ranked index and the metadata of the best."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import slug
from ..operators.metrics import ranked
from ..session import local_table


def model_index(
    table: DataFrame, track: str, metric: str, extra: Sequence[str], tuned: Sequence[str]
) -> DataFrame:
    """(rank, model, file, also_tuned, rank_metric, rank_value, extra...): one row per model."""
    return ranked(table, metric).select(
        "rank",
        "model",
        F.concat(F.lit(f"{track}/"), slug(F.col("model"))).alias("file"),
        F.col("model").isin(list(tuned) or [""]).alias("also_tuned"),
        F.lit(metric).alias("rank_metric"),
        F.col(metric).alias("rank_value"),
        *[F.col(c) for c in extra if c in table.columns],
    )


def save_models(
    fitted: Mapping[str, PipelineModel], index: DataFrame, root: str
) -> None:
    """Writes every pipeline under its file name and the index beside them.

    The stored pipelines are the ones the index scores belong to.
    """
    for row in index.select("model", "file").collect():
        fitted[row["model"]].write().overwrite().save(f"{root}/{row['file']}")
    track = index.select("file").first()[0].split("/")[0]
    index.coalesce(1).write.mode("overwrite").json(f"{root}/{track}_index")


def load_index(spark: SparkSession, root: str, track: str) -> DataFrame:
    return spark.read.json(f"{root}/{track}_index")


def load_model(root: str, file: str) -> PipelineModel:
    return PipelineModel.load(f"{root}/{file}")


def save_best(
    model: PipelineModel, root: str, track: str, name: str, features: Sequence[str], target: str,
    seed: int, classes: Mapping[int, str] | None = None, scores: Mapping[str, float] | None = None,
) -> None:
    """The chosen pipeline and a one-row table saying what it is."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{root}/{track}_best")
    row = (track, name, list(features), target, seed, json.dumps({str(k): v for k, v in (classes or {}).items()}),
           json.dumps(dict(scores or {})))
    local_table(
        spark, [row],
        "track string, model_name string, features array<string>, target string, seed int, classes string, scores string",
    ).write.mode("overwrite").json(f"{root}/{track}_best_metadata")


def load_best(spark: SparkSession, root: str, track: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{root}/{track}_best"), spark.read.json(f"{root}/{track}_best_metadata")
