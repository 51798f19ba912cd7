"""Tables that change by commits: rebuilt, merged or extended a partition at a time, and whole for every reader at every moment.

A table is a folder: ``data/attempt=<id>/<PART>=<value>/*.parquet``, written by Spark, and ``commits/<number>``, a small file
per version that says which attempt holds each partition. Data comes first, the commit last, and a commit's file is created
only where no other writer made that number. So a writer that dies leaves data nobody reads, of two writers at once one
finds its number taken and looks again, and a reader keeps the version it began with. What is on the driver is a line per
partition, never rows.

Creating the file must not replace one: a rename on HDFS and its like refuses to, a hard link on local disks does; stores where a
rename overwrites don't serve.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass, replace
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scd2 import scd2_apply
from .sinks import numbered_trials, upsert

PART = "panel_part"
_CHECK = "_check_"


class ChecksFailed(ValueError):
    """Rows that a quality bundle refuses: nothing was committed. ``counts`` has every check's, ``failures`` those that aren't 0."""

    def __init__(self, counts: dict[str, int]) -> None:
        self.counts, self.failures = counts, {n: v for n, v in counts.items() if v}
        super().__init__(f"refused: {self.failures}")


@dataclass(frozen=True)
class Version:
    """What a commit says: its number, the rows' columns, the attempt that holds each partition, and the rounds written once."""

    number: int
    schema: T.StructType
    parts: dict[str, str]
    rounds: tuple[str, ...] = ()


def part_value(by: Column | None) -> Column:
    """The partition's name: never null, and nothing that could be taken for a number or a date."""
    if by is None:
        return F.lit("all")
    return F.coalesce(F.concat(F.lit("p-"), by.cast("string")), F.lit("none"))


# --- files --------------------------------------------------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = lambda *p: jvm.org.apache.hadoop.fs.Path("/".join([path, *p]))
    return at().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str, *inner: str) -> list[str]:
    fs, at = _fs(spark, path)
    folder = at(*inner)
    return [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []


def _claim(spark: SparkSession, path: str, number: int, content: str) -> bool:
    """Create the commit's file with its whole content, unless it is there."""
    fs, at = _fs(spark, path)
    name, own = f"{number:012d}", f".{uuid.uuid4().hex}"
    fs.mkdirs(at("commits"))
    out = fs.create(at("commits", own), False)
    out.write(bytearray(content.encode()))
    out.close()
    if fs.getUri().getScheme() != "file":
        made = not fs.exists(at("commits", name)) and fs.rename(at("commits", own), at("commits", name))
    else:
        folder = urlparse(at("commits").toUri().toString()).path
        try:
            os.link(f"{folder}/{own}", f"{folder}/{name}")
            made = True
        except FileExistsError:
            made = False
    fs.delete(at("commits", own), False)
    return made


# --- versions -----------------------------------------------------------------------------------------------------------


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the table's commits, ascending; none where there is no table."""
    return sorted(int(n) for n in _names(spark, path, "commits") if n.isdigit())


def load(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version, the newest unless a number is given; None where there is no table."""
    if number is None:
        known = versions(spark, path)
        if not known:
            return None
        number = known[-1]
    fs, at = _fs(spark, path)
    file = fs.open(at("commits", f"{number:012d}"))
    raw = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8"))
    file.close()
    return Version(number, T.StructType.fromJson(raw["schema"]), raw["parts"], tuple(raw["rounds"]))


def read(spark: SparkSession, path: str, version: Version | int | None = None, parts: Sequence[str] | None = None) -> DataFrame:
    """The rows of a version (the newest by default), or of some of its partitions: only their folders are listed."""
    v = version if isinstance(version, Version) else load(spark, path, version)
    if v is None:
        raise FileNotFoundError(f"no table at {path}")
    chosen = [p for p in v.parts if parts is None or p in set(parts)]
    if not chosen:
        return spark.createDataFrame([], v.schema)
    schema = T.StructType([*v.schema.fields, T.StructField("attempt", T.StringType()), T.StructField(PART, T.StringType())])
    folders = [f"{path}/data/attempt={v.parts[p]}/{PART}={_escaped(spark, p)}" for p in chosen]
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders).drop("attempt", PART)


def _escaped(spark: SparkSession, value: str) -> str:
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def _commit(spark: SparkSession, path: str, change: Callable[[Version | None], Version | None]) -> Version | None:
    """Make ``change`` of the newest version the next one; where another writer was first, of that one's instead."""
    while True:
        old = load(spark, path)
        new = change(old)
        if new is None:
            return old
        new = replace(new, number=old.number + 1 if old else 1)
        if _claim(spark, path, new.number, json.dumps({"schema": new.schema.jsonValue(), "parts": new.parts, "rounds": new.rounds})):
            return new


def _write(rows: DataFrame, path: str, part: Column | None, sort: Sequence[str], checks: dict[str, Column] | None) -> tuple[str, list[str]]:
    """Write an attempt; its id and partitions. Skewed partitions are split and small ones joined between tasks by Spark.

    ``checks`` are counts of bad rows taken while the rows are written; any above 0 stops here, before a commit. Columns named
    ``_check_...`` are for the checks alone.
    """
    spark, attempt = rows.sparkSession, f"a-{uuid.uuid4().hex}"
    out = rows.withColumn(PART, part_value(part))
    seen = None
    if checks:
        seen = Observation(f"checks-{attempt}")
        out = out.observe(seen, *(F.coalesce(c, F.lit(0)).cast("long").alias(n) for n, c in checks.items()))
        out = out.drop(*(c for c in out.columns if c.startswith(_CHECK)))
    out = out.hint("rebalance", PART) if part is not None else out
    if sort:
        out = out.sortWithinPartitions(PART, *sort)
    out.write.partitionBy(PART).parquet(f"{path}/data/attempt={attempt}")
    if seen is not None:
        counts = seen.get
        if any(counts.values()):
            raise ChecksFailed(counts)
    names = _names(spark, path, "data", f"attempt={attempt}")
    return attempt, [unquote(n.split("=", 1)[1]) for n in names if n.startswith(f"{PART}=")]


def _kept(rows: DataFrame) -> T.StructType:
    return T.StructType([f for f in rows.schema.fields if not f.name.startswith(_CHECK)])


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _with(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """The old columns, and the new ones after them; a column keeps its type."""
    have = {f.name: f for f in old.fields} if old else {}
    other = [f.name for f in new.fields if f.name in have and have[f.name].dataType != f.dataType]
    if other:
        raise ValueError(f"the table has other types for {other}")
    return T.StructType([*have.values(), *(f for f in _nullable(new).fields if f.name not in have)])


def _extended(old: Version | None, schema: T.StructType, gone: Collection[str], parts: dict[str, str], rounds: Sequence[str] = ()) -> Version:
    """A version with new partitions, without those that are gone."""
    kept = {p: a for p, a in old.parts.items() if p not in gone} if old else {}
    return Version(0, _with(old and old.schema, schema), kept | parts, (*(old.rounds if old else ()), *rounds))


def _typed(rows: DataFrame, version: Version | None) -> DataFrame:
    """Rows with the types that the table's columns have."""
    kinds = {f.name: f.dataType for f in version.schema.fields} if version else {}
    return rows.select(*(F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in rows.columns))


# --- changes ------------------------------------------------------------------------------------------------------------


def rebuild(rows: DataFrame, path: str, part: Column | None = None, sort: Sequence[str] = (), checks: dict[str, Column] | None = None) -> Version:
    """Replace the whole table. Until the commit, and after a crash before it, readers see the old one."""
    attempt, parts = _write(rows, path, part, sort, checks)
    return _commit(rows.sparkSession, path, lambda old: Version(0, _nullable(_kept(rows)), dict.fromkeys(parts, attempt)))


def append(rows: DataFrame, path: str) -> Version:
    """Add rows as a partition of their own; columns may be new, which old rows have as NULL."""
    attempt, parts = _write(_typed(rows, load(rows.sparkSession, path)), path, F.lit(uuid.uuid4().hex), (), None)
    return _commit(rows.sparkSession, path, lambda old: _extended(old, rows.schema, {}, dict.fromkeys(parts, attempt)))


def rewrite(
    updates: DataFrame, path: str, part: Column, change: Callable[[DataFrame | None, DataFrame], DataFrame],
    keys: Sequence[str] | None = None, sort: Sequence[str] = (), checks: dict[str, Column] | None = None,
) -> Version | None:
    """Make ``change(rows, updates)`` of the partitions that the updates concern; all other partitions keep their files.

    These are the partitions of the updates themselves and, if ``keys`` are given, those of rows with the updates' keys, which
    are found by reading the key columns alone; leave keys out where a row's keys say its partition. If another writer
    changed one of these partitions meanwhile, the change is made again of the new rows. Where there is no table yet, ``change``
    gets None for its rows.
    """
    spark = updates.sparkSession
    while True:
        old = load(spark, path)
        name = part_value(part).alias(PART)
        concerned = updates.select(name).distinct()
        if keys and old:
            known = read(spark, path, old)
            concerned = concerned.unionByName(known.join(updates.select(*keys).distinct(), list(keys), "left_semi").select(name).distinct()).distinct()
        touched = {r[0] for r in concerned.collect()}
        if not touched:
            return old
        before = {p: old.parts.get(p) if old else None for p in touched}
        rows = _typed(change(read(spark, path, old, sorted(touched)) if old else None, updates), old)
        attempt, parts = _write(rows, path, part, sort, checks)
        if set(parts) - touched:
            raise ValueError(f"the change moved rows to partitions it wasn't given: {sorted(set(parts) - touched)[:5]}")

        def swap(now: Version | None, before=before, rows=rows, attempt=attempt, parts=parts):
            have = now.parts if now else {}
            if any(have.get(p) != a for p, a in before.items()):
                raise _Stale
            return _extended(now, rows.schema, before, dict.fromkeys(parts, attempt))

        try:
            return _commit(spark, path, swap)
        except _Stale:
            continue


class _Stale(Exception):
    pass


def merge(updates: DataFrame, path: str, keys: Sequence[str], part: Column, keys_say_part: bool = True, sort: Sequence[str] = ()) -> Version | None:
    """Upsert on natural keys: rows of the updates in place of those with their keys, and the new ones.

    Where a row's keys don't say its partition (``keys_say_part`` false), rows with the updates' keys are found anywhere and go.
    """
    return rewrite(updates, path, part, lambda rows, new: upsert(rows, new, keys) if rows is not None else new, None if keys_say_part else keys, sort)


def replace_windows(updates: DataFrame, path: str, part: Column, sort: Sequence[str] = ()) -> Version | None:
    """Every partition that the updates have rows of becomes just these rows; its old rows aren't even read."""
    return rewrite(updates, path, part, lambda rows, new: new, None, sort)


def log_trials(trials: DataFrame, path: str, order: str) -> Version | None:
    """Number new trials on from the log's last one and add them. The log is one partition, so of two writers at once the later
    one counts on from the other's."""


    def numbered(log: DataFrame | None, new: DataFrame) -> DataFrame:
        if log is None:
            return numbered_trials(new.sparkSession.createDataFrame([], "trial int"), new, order)
        return log.unionByName(numbered_trials(log, new, order), allowMissingColumns=True)

    return rewrite(trials, path, F.lit("log"), numbered)


def bucket_of(key: str, buckets: int = 64) -> Column:
    """A partition by a hash of the key, for tables that change by key and have no time in it."""
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def merge_versions(updates: DataFrame, path: str, key: str, attrs: Sequence[str], ts: str, buckets: int = 64) -> Version | None:
    """Apply a batch of ``updates(key, attrs, ts)`` to a table of versions (``scd2``) in buckets of the key."""
    if not versions(updates.sparkSession, path):
        raise FileNotFoundError(f"no table of versions at {path}")
    return rewrite(updates, path, bucket_of(key, buckets), lambda rows, new: scd2_apply(rows, new, key, attrs, ts))


def first_write(rows: DataFrame, path: str, keys: Sequence[str] = ("as_of_date", "methodology_version"), checks: dict[str, Column] | None = None) -> list[str]:
    """Add the rounds (rows of equal keys) that the table doesn't have; what was written first stays. Returns the rounds added.

    Rounds that are there aren't written again. All new rounds become visible in one commit, as one partition sorted by the keys, and the
    commit names them. Of two writers of a round at once the one that commits first has it, whole; the other writes what is
    still new once more. On the driver are the rounds' names.
    """
    spark = rows.sparkSession
    name = F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))
    while True:
        old = load(spark, path)
        fresh = rows
        if old and old.rounds:
            known = spark.createDataFrame([(r,) for r in old.rounds], "_round string")
            fresh = rows.withColumn("_round", name).join(F.broadcast(known), "_round", "left_anti").drop("_round")
        attempt, parts = _write(_typed(fresh, old), path, F.lit(uuid.uuid4().hex), keys, checks)
        added = []
        if parts:
            written = spark.read.schema(fresh.schema).parquet(f"{path}/data/attempt={attempt}")
            added = sorted(r[0] for r in written.select(name).distinct().collect())

        def add(now: Version | None, fresh=fresh, attempt=attempt, parts=parts, added=added) -> Version | None:
            if not added and now is not None:
                return None
            if now and set(now.rounds) & set(added):
                raise _Stale
            return _extended(now, fresh.schema, (), dict.fromkeys(parts, attempt), added)

        try:
            _commit(spark, path, add)
            return added
        except _Stale:
            continue


def discard_unread(spark: SparkSession, path: str, keep_versions: int = 10) -> int:
    """Delete attempts that none of the newest versions reads, and the older versions; returns how many attempts went.

    Only for times without writers: an attempt that isn't committed yet looks like one that never will be.
    """
    numbers = versions(spark, path)
    live = {a for n in numbers[-keep_versions:] for a in load(spark, path, n).parts.values()}
    fs, at = _fs(spark, path)
    dead = [n for n in _names(spark, path, "data") if n.startswith("attempt=") and n.split("=", 1)[1] not in live]
    for n in numbers[:-keep_versions]:
        fs.delete(at("commits", f"{n:012d}"), False)
    for n in dead:
        fs.delete(at("data", n), True)
    return len(dead)
