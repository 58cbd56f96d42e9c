"""Session settings the jobs are tuned for."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import SparkSession

HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
HUGE_METHOD_BYTES = 8000
#: Spark keeps the shuffle files of finished jobs until the driver collects garbage, unless this says otherwise.
FREED_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

RECOMMENDED = {
    # Merge small shuffle partitions, split skewed ones and pick join sides by measured size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods above 8,000 bytes; wide stages then run split up instead of interpreted.
    HUGE_METHOD: str(HUGE_METHOD_BYTES),
    # Recording the Python call site of every expression takes longer than planning a small job.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}


def recommended(builder: SparkSession.Builder) -> SparkSession.Builder:
    """The builder with the recommended settings; later ``config`` calls may override them."""
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder


@contextlib.contextmanager
def compiled_stages(spark: SparkSession) -> Iterator[None]:
    """Run the jobs of the block with stages that the JVM compiles, whatever the session says of their size."""
    before = spark.conf.get(HUGE_METHOD)
    spark.conf.set(HUGE_METHOD, str(min(int(before), HUGE_METHOD_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(HUGE_METHOD, before)


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of each job of the block when it ends. One that is run again makes them again."""
    before = spark.conf.get(FREED_SHUFFLES, None)
    spark.conf.set(FREED_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED_SHUFFLES)
        else:
            spark.conf.set(FREED_SHUFFLES, before)
