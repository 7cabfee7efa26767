"""Writing result tables, JSON summaries and the run log."""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import col
from ..session import local_table


def suffix(mode: str) -> str:
    """Development runs are written under names of their own."""
    return "_dev" if mode == "dev" else ""


def save_table(df: DataFrame, root: str, name: str, markdown: bool = False) -> str:
    """Writes ``<root>/<name>`` as CSV with a header, and a Markdown copy beside it if wanted.

    CSV cannot hold arrays, so they are written as JSON text. The Markdown copy is made on
    request, for result tables of a few rows: it passes through the driver.
    """
    flat = df.select(
        *[
            (F.to_json(col(f.name)) if f.dataType.typeName() in ("array", "struct", "map") else col(f.name)).alias(f.name)
            for f in df.schema.fields
        ]
    )
    path = f"{root}/{name}"
    flat.write.mode("overwrite").option("header", True).csv(path)
    if markdown:
        markdown_lines(flat).coalesce(1).write.mode("overwrite").text(f"{root}/{name}_md")
    return path


def markdown_lines(df: DataFrame) -> DataFrame:
    """The table as Markdown text lines."""
    cells = F.concat_ws(" | ", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in df.columns])
    body = df.select(F.concat(F.lit("| "), cells, F.lit(" |")).alias("value"))
    head = [("| " + " | ".join(df.columns) + " |",), ("|" + "---|" * len(df.columns),)]
    lines = local_table(df.sparkSession, [*head, *[(r["value"],) for r in body.collect()]], "value string")
    return lines


def save_json(df: DataFrame, root: str, name: str) -> str:
    path = f"{root}/{name}"
    df.write.mode("overwrite").json(path)
    return path


class RunLog:
    """Steps of a run: (time, step, status, detail), written as one table at the end."""

    def __init__(self, spark: SparkSession, track: str, mode: str):
        self.spark, self.track, self.mode = spark, track, mode
        self.started, self.rows = time.perf_counter(), []

    def add(self, step: str, detail: str = "", status: str = "EXECUTED") -> None:
        now = datetime.now().isoformat(timespec="seconds")
        self.rows.append((self.track, self.mode, now, step, status, detail))

    def table(self) -> DataFrame:
        elapsed = round(time.perf_counter() - self.started, 1)
        schema = "track string, mode string, time string, step string, status string, detail string"
        return local_table(self.spark, self.rows, schema).withColumn("elapsed_seconds", F.lit(elapsed))

    def save(self, root: str) -> str:
        return save_json(self.table(), root, f"run_log_{self.track}{suffix(self.mode)}")
