"""Tables written to the folder that all executors share.

Lineage is cut by writing a table and reading it back, so a lost executor costs
a re-read and not a recomputation, and the planner knows each table's real size
when it decides whether to broadcast it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from threading import Lock
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")


def shared_folder(spark: SparkSession) -> str:
    """A folder that all executors share.

    The session's ``spark.checkpoint.dir``, else the checkpoint folder set on its context.
    Only a session that runs in one process may do without: it uses a folder of its
    warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/_martlet".rstrip("/")


def _file_system(spark: SparkSession, folder: str):
    """Hadoop's path and file system of a folder (they have no Python API)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)  # noqa: SLF001
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001


def state_of(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """Names, sizes and times of the files at a path, to tell whether they have changed."""
    place, system = _file_system(spark, path)
    if not system.exists(place):
        return ()
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in system.listStatus(place)))


class Store:
    """A fresh sub-folder of the shared folder holding parquet tables."""

    def __init__(self, spark: SparkSession, name: str = "warehouse", root: str | None = None):
        self.spark = spark
        base = root or f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
        self.root = f"{base}/{name}-{uuid.uuid4().hex[:12]}"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def put(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write ``df`` once and return the stored table."""
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(table))
        return self.get(table, df)

    def drop(self, table: str | None = None) -> None:
        """Delete one table or the whole store; frames that read it are no longer usable."""
        path, system = _file_system(self.spark, self.path(table) if table else self.root)
        system.delete(path, True)

    def get(self, table: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(table)).select(*like.columns)


class Tables(Mapping[str, DataFrame]):
    """Tables by name; each is built when it is first asked for, and once."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._locks = {name: Lock() for name in self._builders}
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._built:
                self._built[name] = self._builders[name]()
            return self._built[name]

    def __contains__(self, name: object) -> bool:
        return name in self._builders

    def has_built(self, name: str) -> bool:
        return name in self._built

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)

    def prepare(self, names: Iterable[str] | None = None) -> None:
        """Build these tables, or all, side by side."""
        in_parallel({name: lambda name=name: self[name] for name in (self if names is None else names)})


def in_parallel(jobs: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Run independent builds side by side, so small tables do not wait for big ones."""
    with ThreadPoolExecutor(max_workers=max(len(jobs), 1)) as pool:
        waiting = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: result.result() for name, result in waiting.items()}
