"""Generations of a tree of tables: builds that replace each other in one step.

A build writes its tables into a directory of its own, then a manifest of them (rows, digests, files, layout), and last
moves the pointer ``CURRENT`` over the old one. Whatever happens before that move leaves the old generation as it was, and
readers, which start from the pointer, never see parts of two builds. The generation before the current one is kept for
those who are still reading it.

Split tables are hash-clustered: rows of a key lie in one of a fixed number of buckets, so tables with equal buckets join
without an exchange.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T

from plumbline.operators.episodes import BuildError
from plumbline.operators.integrity import fingerprint
from plumbline.sources import storage

FOLDER = "_generations"
POINTER = "CURRENT"
MANIFEST = "manifest.json"
#: Joins on more columns than a bucket's key reuse the buckets only with this setting.
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


@dataclass(frozen=True)
class TableEntry:
    """What the manifest says of one table and split."""

    table: str
    split: str
    path: str
    rows: int
    digests: tuple[str, str]
    files: str
    schema: str
    buckets: int = 0
    bucket_keys: tuple[str, ...] = ()


def _listing(spark: SparkSession, path: str) -> str:
    """A digest of the names and sizes of the data files below a directory."""
    found = [f"{name} {size}" for name, size in storage.files(spark, path) if not name.rsplit("/", 1)[-1].startswith((".", "_"))]
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def _rows_and_digests(df: DataFrame) -> tuple[int, tuple[str, str]]:
    seen = fingerprint(df).first()
    return seen.n_rows, (str(seen.digest_a), str(seen.digest_b))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, buckets: int, keys: tuple[str, ...]) -> DataFrame:
    """The files of one bucketed directory with their bucket layout, which Spark keeps in its catalog only."""
    name = f"plumbline_{uuid.uuid4().hex}"
    clustered = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE {name} ({_ddl(schema)}) USING parquet CLUSTERED BY ({clustered}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    try:
        # The frame holds the resolved relation; the name is needed no longer.
        return spark.table(name).select("*")
    finally:
        spark.sql(f"DROP TABLE {name}")


@dataclass
class Generation:
    """One build: tables are written below its directory until ``commit`` makes it the current one."""

    spark: SparkSession
    base: str
    name: str = field(default_factory=lambda: uuid.uuid4().hex)
    entries: list[TableEntry] = field(default_factory=list)

    @property
    def root(self) -> str:
        return storage.join(self.base, FOLDER, self.name)

    def _enter(self, table: str, split: str, relative: str, schema: T.StructType, **layout) -> None:
        """Read back what has been written: the manifest tells what is there, not what was meant."""
        path = storage.join(self.root, relative)
        rows, digests = _rows_and_digests(self.spark.read.schema(schema).parquet(path))
        files = _listing(self.spark, path)
        self.entries.append(TableEntry(table, split, relative, rows, digests, files, schema.json(), **layout))

    def write(self, table: str, split: str, df: DataFrame) -> None:
        relative = f"{table}/split={split}"
        df.write.parquet(storage.join(self.root, relative))
        self._enter(table, split, relative, df.schema)

    def write_splits(
        self, table: str, df: DataFrame, splits: tuple[str, ...], buckets: int, keys: tuple[str, ...], split: str = "split"
    ) -> None:
        """All splits of a table in one job, one directory each; that of a split without rows is empty."""
        path = storage.join(self.root, table)
        name = f"plumbline_{uuid.uuid4().hex}"
        writer = df.write.format("parquet").partitionBy(split).bucketBy(buckets, *keys).option("path", path)
        writer.saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files of a table with a path of its own stay
        rest = df.drop(split)
        for one in splits:
            relative = f"{table}/split={one}"
            storage.make_folder(self.spark, storage.join(self.root, relative))
            self._enter(table, one, relative, rest.schema, buckets=buckets, bucket_keys=keys)

    def rows(self, table: str) -> dict[str, int]:
        return {e.split: e.rows for e in self.entries if e.table == table}

    def table(self, table: str, split: str) -> DataFrame:
        return Manifest(self.spark, self.base, self.name, tuple(self.entries)).read(table, split, verify=None)

    def commit(self, about: dict) -> None:
        """Write the manifest and make this the current generation; older ones than the last are removed."""
        text = json.dumps({"about": about, "tables": [asdict(e) for e in self.entries]}, indent=1, sort_keys=True)
        storage.write_text(self.spark, storage.join(self.root, MANIFEST), text)
        last = pointed_at(self.spark, self.base)
        pointer = json.dumps({"generation": self.name, "manifest_sha256": hashlib.sha256(text.encode()).hexdigest()})
        storage.replace_text(self.spark, storage.join(self.base, POINTER), pointer)
        kept = {self.name, last["generation"] if last else self.name}
        for name in storage.children(self.spark, storage.join(self.base, FOLDER)):
            if name not in kept:
                storage.remove(self.spark, storage.join(self.base, FOLDER, name))

    def abandon(self) -> None:
        storage.remove(self.spark, self.root)


@dataclass(frozen=True)
class Manifest:
    """The tables of one generation."""

    spark: SparkSession
    base: str
    name: str
    entries: tuple[TableEntry, ...]
    about: dict = field(default_factory=dict)

    def entry(self, table: str, split: str) -> TableEntry:
        for e in self.entries:
            if (e.table, e.split) == (table, split):
                return e
        raise BuildError(f"{self.base} has no table {table!r} with a split {split!r}")

    def path(self, table: str, split: str) -> str:
        return storage.join(self.base, FOLDER, self.name, self.entry(table, split).path)

    def read(self, table: str, split: str, verify: str | None = "files") -> DataFrame:
        """One table. ``verify``: compare names and sizes of its files, or all its rows ("content"), with the manifest."""
        entry, path = self.entry(table, split), self.path(table, split)
        if verify is not None and _listing(self.spark, path) != entry.files:
            raise BuildError(f"{path} does not hold the files that its manifest names")
        schema = T.StructType.fromJson(json.loads(entry.schema))
        if verify == "content" and _rows_and_digests(self.spark.read.schema(schema).parquet(path)) != (entry.rows, tuple(entry.digests)):
            raise BuildError(f"{path} does not hold the rows that its manifest names")
        if entry.buckets:
            return read_bucketed(self.spark, path, schema, entry.buckets, tuple(entry.bucket_keys))
        return self.spark.read.schema(schema).parquet(path)

    def to_frame(self) -> DataFrame:
        """``table, split, rows, digest_a, digest_b, buckets``."""
        rows = [(e.table, e.split, e.rows, *e.digests, e.buckets) for e in self.entries]
        return self.spark.createDataFrame(
            rows, "table string, split string, rows bigint, digest_a string, digest_b string, buckets int"
        )


def pointed_at(spark: SparkSession, base: str) -> dict | None:
    pointer = storage.join(base, POINTER)
    return json.loads(storage.read_text(spark, pointer)) if storage.exists(spark, pointer) else None


def current(spark: SparkSession, base: str) -> Manifest:
    """The manifest of the current generation; a tree that no build has finished is an error."""
    pointer = pointed_at(spark, base)
    if pointer is None:
        raise BuildError(f"{base} has no {POINTER}: the build is incomplete")
    text = storage.read_text(spark, storage.join(base, FOLDER, pointer["generation"], MANIFEST))
    if hashlib.sha256(text.encode()).hexdigest() != pointer["manifest_sha256"]:
        raise BuildError(f"the manifest of {base} is not the one that its pointer names")
    told = json.loads(text)
    entries = tuple(
        TableEntry(**e | {"digests": tuple(e["digests"]), "bucket_keys": tuple(e["bucket_keys"])}) for e in told["tables"]
    )
    return Manifest(spark, base, pointer["generation"], entries, told["about"])


def co_partitioned(spark: SparkSession) -> None:
    """Let joins of this session reuse buckets whose key is a part of the join's columns, unless it says otherwise."""
    if CO_PARTITION not in {k for k, _ in spark.sparkContext.getConf().getAll()}:
        spark.conf.set(CO_PARTITION, "false")


