"""Scratch tables on shared storage.

Multi-pass jobs (measure, decide, write) need the parsed input more than once. Holding it in executor
memory would lose it with the executor, and recomputing it could renumber the scan's splits, so it is
written once as Parquet under the folder the cluster names in ``spark.checkpoint.dir``. Later passes
then read only the columns they use.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from plumbline.session import compiled_stages, freed_shuffles
from plumbline.sources import storage


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; where none is set, a folder of its warehouse, which all executors share."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return configured or storage.join(spark.conf.get("spark.sql.warehouse.dir"), "_scratch")


_open: dict[str, SparkSession] = {}


@atexit.register
def _close_all() -> None:
    """Scratch of lazy results is needed until they are read, at the latest until the program ends."""
    for root, spark in list(_open.items()):
        with contextlib.suppress(Exception):
            storage.remove(spark, root)


class Workspace:
    """Owns the scratch tables of one job and removes them on exit."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.root = storage.join(folder or shared_folder(spark), f"plumbline-{uuid.uuid4().hex}")
        self._count = 0
        _open[self.root] = spark
        self._paths: list[str] = []

    def path(self, name: str) -> str:
        self._count += 1
        self._paths.append(storage.join(self.root, f"{self._count:03d}-{name}"))
        return self._paths[-1]

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return a reader over the written table."""
        target = self.path(name)
        with compiled_stages(self.spark), freed_shuffles(self.spark):
            df.write.mode("overwrite").parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def drop(self, *names: str) -> None:
        """Remove the tables of these names before the job ends; nothing may read them any more."""
        for path in [p for p in self._paths if p.rsplit("/", 1)[-1][4:] in names]:
            storage.remove(self.spark, path)

    def close(self) -> None:
        storage.remove(self.spark, self.root)
        _open.pop(self.root, None)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *exc) -> None:
        self.close()
