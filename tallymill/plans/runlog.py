"""Run log: an append-only table with one record per pipeline run."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymill.fixed_values import FAILED, SUCCESS
from tallymill.schemas import RUN_LOG
from tallymill.sinks.writers import append_path, create_if_absent
from tallymill.sources.readers import read_path, rows_to_table


@dataclass
class Run:
    """Counts a pipeline reports about itself."""

    processed: int = 0
    rejected: int = 0


class RunLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def create(self, reset: bool = False) -> None:
        create_if_absent(self.spark, self.path, RUN_LOG, reset)

    def append(self, pipeline: str, layer: str, start: datetime, end: datetime, status: str,
               processed: int, rejected: int, error: str | None = None) -> None:
        record = (pipeline, layer, start, end, status, int(processed), int(rejected), error or "")
        append_path(rows_to_table(self.spark, [record], RUN_LOG).coalesce(1), self.path)

    @contextmanager
    def run(self, pipeline: str, layer: str) -> Iterator[Run]:
        """Log the block: its counts on success; zeros and the message on failure, re-raised."""
        start, counts = datetime.now(timezone.utc), Run()
        try:
            yield counts
        except Exception as error:
            self.append(pipeline, layer, start, datetime.now(timezone.utc), FAILED, 0, 0, str(error))
            raise
        self.append(
            pipeline, layer, start, datetime.now(timezone.utc), SUCCESS, counts.processed, counts.rejected
        )

    def read(self) -> DataFrame:
        return read_path(self.spark, self.path, RUN_LOG)


def newest_first(log: DataFrame, *tie_break: str) -> DataFrame:
    return log.orderBy(F.col("start_time").desc_nulls_last(), *tie_break)


def of_layer(log: DataFrame, layer: str) -> DataFrame:
    return log.where(F.col("layer") == layer)


def failed_runs(log: DataFrame) -> DataFrame:
    return log.where(F.col("status") == FAILED)


def latest_run(log: DataFrame, *tie_break: str) -> DataFrame:
    return newest_first(log, *tie_break).limit(1)
