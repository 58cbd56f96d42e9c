"""File-system calls made through the session's own Hadoop configuration.

The same code serves local paths, HDFS and object stores: whatever scheme Spark can write to, these
helpers can list, promote and mark.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


#: Beside a directory: its earlier generation, while the new one is moved into its place.
ASIDE = "._replaced"


def _resolve(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return bool(fs.exists(target))


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    if fs.exists(target):
        fs.delete(target, True)


def promote(spark: SparkSession, staged: str, final: str) -> None:
    """Move a finished directory into place, replacing the earlier generation.

    The earlier one is moved aside first and removed last: a crash in between leaves it beside its place, from where
    :func:`recover` and the next promotion bring it back.
    """
    recover(spark, final)
    fs, source = _resolve(spark, staged)
    _, target = _resolve(spark, final)
    _, aside = _resolve(spark, f"{str(final).rstrip('/')}{ASIDE}")
    fs.mkdirs(target.getParent())
    replaced = fs.exists(target)
    if replaced and not fs.rename(target, aside):
        raise OSError(f"could not move {final} aside")
    if not fs.rename(source, target):
        if replaced:
            fs.rename(aside, target)
        raise OSError(f"could not move {staged} to {final}")
    if replaced:
        fs.delete(aside, True)


def recover(spark: SparkSession, final: str) -> None:
    """Finish what a crash in :func:`promote` has left: no directory in place, or two generations."""
    fs, target = _resolve(spark, final)
    _, aside = _resolve(spark, f"{str(final).rstrip('/')}{ASIDE}")
    if not fs.exists(aside):
        return
    if fs.exists(target):
        fs.delete(aside, True)
    elif not fs.rename(aside, target):
        raise OSError(f"could not bring back {final}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small driver-side document (a report or a completion marker)."""
    fs, target = _resolve(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """One small document."""
    fs, target = _resolve(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a document beside its place and move it over the old one in one step: readers see the one or the other."""
    beside = f"{path}._{uuid.uuid4().hex}"
    write_text(spark, beside, text)
    fs, source = _resolve(spark, beside)
    _, target = _resolve(spark, path)
    source, target = fs.makeQualified(source), fs.makeQualified(target)
    hadoop = spark._jvm.org.apache.hadoop.fs
    kinds = getattr(hadoop, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(kinds, 1)
    overwrite[0] = kinds.OVERWRITE
    hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(source, target, overwrite)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.mkdirs(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly below a directory."""
    fs, target = _resolve(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names relative to the directory, and sizes, of all files below it."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    top = fs.makeQualified(target).toUri().getPath().rstrip("/") + "/"
    found, each = [], fs.listFiles(target, True)
    while each.hasNext():
        status = each.next()
        found.append((status.getPath().toUri().getPath().removeprefix(top), status.getLen()))
    return sorted(found)


def join(root: str, *parts: str) -> str:
    return "/".join([str(root).rstrip("/"), *parts])
