"""Load log and rejected-row tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martlet.schemas import LOAD_LOG


class LoadLog:
    """Entries of one load; row counts come from the writes themselves."""

    def __init__(self, spark: SparkSession, package: str):
        self.spark, self.package, self.entries = spark, package, []

    def write(self, df: DataFrame, task: str, path: str) -> DataFrame:
        """Write parquet and note rows, times and outcome; no second count job."""
        seen = Observation(task)
        started = datetime.now(timezone.utc)
        try:
            df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        except Exception as error:
            self._note(task, "FAILED", None, str(error)[:1000], started)
            raise
        self._note(task, "SUCCESS", seen.get["rows"], None, started)
        return self.spark.read.schema(df.schema).parquet(path)

    def _note(self, task, status, rows, message, started):
        finished = datetime.now(timezone.utc)
        self.entries.append((self.package, task, status, rows, message, started, finished))

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(self.entries, LOAD_LOG)

    def append_to(self, path: str) -> None:
        """Add this load's entries, one row per task, to the log table."""
        self.frame().coalesce(1).write.mode("append").parquet(path)


def append_rejected(rejected: DataFrame, path: str) -> None:
    rejected.write.mode("append").parquet(path)
