"""A stored table: partition versions, a recorded schema, and a manifest swapped in one step.

    table/part=2024-01-05/table_version=<version>/*.parquet     every version of a partition has its own folder
    table/_manifests/0000000007.json                the table's state after its seventh change

A change writes new partition versions beside the old ones, then one manifest that names the versions
in force, the table's schema and the batches taken from each source. The manifest is renamed into
place, so a reader sees the state before or the state after; files of a change that failed are never
read. A manifest lists partitions, not rows or files.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

MANIFESTS = "_manifests"
#: Name of the version's folder; no column may have it.
VERSION = "table_version"
#: Narrow types first: a batch column is widened to the type of the table, never the other way round.
_WIDENING = [
    [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()],
    [T.FloatType(), T.DoubleType()],
]


@dataclass
class State:
    """What a manifest records."""

    number: int = 0
    schema: T.StructType = field(default_factory=T.StructType)
    parts: dict[str, str] = field(default_factory=dict)
    taken: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "parts": self.parts, "taken": self.taken})


class _Files:
    """The table's file system, whatever it is."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self._at(name))

    def names(self, folder: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self._at(folder))] if self.exists(folder) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, name: str, text: str) -> None:
        """Write aside and rename; fails if another writer was first."""
        aside = f"{MANIFESTS}/.{uuid.uuid4().hex}"
        out = self.fs.create(self._at(aside))
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self.exists(name) or not self.fs.rename(self._at(aside), self._at(name)):
            self.fs.delete(self._at(aside), False)
            raise RuntimeError(f"{self.path} was changed by another writer; run the batch again")

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), True)


def _numbers(files: _Files) -> list[int]:
    return sorted(int(n[:-5]) for n in files.names(MANIFESTS) if n.endswith(".json") and n[:-5].isdigit())


def state(spark: SparkSession, path: str, number: int | None = None) -> State | None:
    """The table's state now, or after its change ``number``; None if there is no such table."""
    files = _Files(spark, path)
    known = _numbers(files)
    if number is not None and number not in known:
        raise ValueError(f"{path} has no state {number}")
    if not known:
        return _plain(spark, files)
    number = known[-1] if number is None else number
    found = json.loads(files.read(f"{MANIFESTS}/{number:010d}.json"))
    return State(number, T.StructType.fromJson(found["schema"]), found["parts"], found["taken"])


def _plain(spark: SparkSession, files: _Files) -> State | None:
    """A folder of partitions without manifest (of write_partitioned) is a table's first state."""
    folders = [n for n in files.names("") if n.startswith("part=")]
    if not folders:
        return None
    schema = spark.read.option("mergeSchema", True).parquet(files.path).schema
    fields = [f for f in schema.fields if f.name != "part"]
    return State(0, T.StructType(fields), {n.removeprefix("part="): n for n in folders})


def read(spark: SparkSession, path: str, number: int | None = None, parts=None) -> DataFrame:
    """The table with its storage partition ``part`` as text; ``parts`` limits it to some partitions."""
    now = state(spark, path, number)
    if now is None:
        raise FileNotFoundError(f"no table at {path}")
    schema = T.StructType([*now.schema.fields, T.StructField("part", T.StringType())])
    folders = [f for p, f in now.parts.items() if parts is None or p in parts]
    if not folders:
        return spark.createDataFrame([], schema)
    root = path.rstrip("/")
    # Partitions written without a version lie one folder higher; Spark reads each kind by itself.
    kinds = [[f for f in folders if (VERSION in f) == versioned] for versioned in (True, False)]
    scans = [
        spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{f}" for f in some]).select(schema.names)
        for some in kinds if some
    ]
    return reduce(DataFrame.unionByName, scans)


def grown_schema(table: T.StructType, batch: T.StructType) -> T.StructType:
    """The table's columns, then those that are new in the batch; a wider type in the batch is an error."""
    known = {f.name: f.dataType for f in table}
    for f in batch:
        if f.name in known and f.dataType != known[f.name] and not _fits(f.dataType, known[f.name]):
            raise ValueError(f"column {f.name} is {known[f.name].simpleString()}, the batch has {f.dataType.simpleString()}")
    new = [T.StructField(f.name, f.dataType, True) for f in batch if f.name not in known]
    return T.StructType([*(T.StructField(f.name, f.dataType, True) for f in table), *new])


def _fits(narrow: T.DataType, wide: T.DataType) -> bool:
    if isinstance(narrow, T.NullType):
        return True
    return any(narrow in chain and wide in chain and chain.index(narrow) <= chain.index(wide) for chain in _WIDENING)


def as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame's columns under the schema's types; those that it lacks are null. ``part`` stays."""
    has = set(df.columns)
    columns = [(F.col(f"`{f.name}`") if f.name in has else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    return df.select(*columns, *(["part"] if "part" in has else []))


def without_keys(target: DataFrame, batch: DataFrame, keys) -> DataFrame:
    """Target rows whose key is not in the batch; null keys equal each other."""
    found = batch.select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"__{i}")) for i, k in enumerate(keys)]
    return target.join(found, same, "left_anti")


def newest(df: DataFrame, keys, order) -> DataFrame:
    """One row per key: the last by ``order``, then by all other columns (only one of equal rows)."""
    rest = [c for c, kind in df.dtypes if c not in {*keys, *order} and not kind.startswith("map")]
    last = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in (*order, *rest)])
    return df.withColumn("__rank", F.row_number().over(last)).where("__rank = 1").drop("__rank")


def change(batch: DataFrame, path: str, keys, balanced, newest_by=None, batch_of: tuple[str, int] | None = None) -> bool:
    """Merge a batch that has a ``part`` column into the table; says whether anything was done.

    Rows with equal keys are replaced and the rest added; columns that are new in the batch are added
    to the table's schema. With ``newest_by`` (columns) one row per key stays: that with the largest of
    these, of stored rows and the batch alike, so that the order of arrival does not matter. With
    ``batch_of`` (source, number) a batch of a source whose number the table has taken already is
    skipped. ``balanced`` lays out the rows to write. Only partitions that the batch touches are read.
    """
    if VERSION in batch.columns:
        raise ValueError(f"{VERSION} is a name of the table's own")
    spark = batch.sparkSession
    now = state(spark, path) or State()
    if batch_of and now.taken.get(batch_of[0], -1) >= batch_of[1]:
        return False
    touched = sorted(r.part for r in batch.select("part").distinct().collect())
    if any(p is None for p in touched):
        raise ValueError("rows without a time have no place in the table")
    schema = grown_schema(now.schema, T.StructType([f for f in batch.schema if f.name != "part"]))
    rows = as_schema(batch, schema)
    if newest_by:
        rows = newest(rows, keys, newest_by)
    stored = [p for p in touched if p in now.parts]
    if stored:
        target = as_schema(read(spark, path, parts=set(stored)), schema)
        if newest_by:
            rows = newest(target.unionByName(rows), keys, newest_by)
        else:
            rows = without_keys(target, rows, keys).unionByName(rows)
    number = now.number + 1
    version = f"{number:010d}-{uuid.uuid4().hex[:8]}"
    if touched:
        balanced(rows).withColumn(VERSION, F.lit(version)).write.mode("append").partitionBy("part", VERSION).parquet(path)
    after = State(number, schema, dict(now.parts), dict(now.taken))
    after.parts |= {p: f"part={p}/{VERSION}={version}" for p in touched}
    if batch_of:
        after.taken[batch_of[0]] = batch_of[1]
    commit(spark, path, after)
    return True


def commit(spark: SparkSession, path: str, after: State) -> None:
    """Make a state the table's own, in one step."""
    _Files(spark, path).put_new(f"{MANIFESTS}/{after.number:010d}.json", after.to_json())


def forget_before(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete manifests older than the last ``keep`` and the partition versions that only they name.

    Not while a change is under way: its versions are not named yet.
    """
    files = _Files(spark, path)
    numbers = _numbers(files)
    if keep < 1:
        raise ValueError("the last state must stay")
    kept = {f for n in numbers[-keep:] for f in state(spark, path, n).parts.values()}
    gone = []
    for part in [n for n in files.names("") if n.startswith("part=")]:
        gone += [f"{part}/{v}" for v in files.names(part) if v.startswith(f"{VERSION}=") and f"{part}/{v}" not in kept]
    for n in numbers[:-keep]:
        files.delete(f"{MANIFESTS}/{n:010d}.json")
    for folder in gone:
        files.delete(folder)
    return sorted(gone)
