"""VACUUM: files of a table's folder that no version within the retention time needs.

Candidates are listed by Spark's file index and compared with live files and unexpired tombstones by an anti join, so
live files, their deletion vectors and recently removed files are never among them. LITE takes expired tombstones from the
log instead of listing. Deleting runs on the driver through the file system's own connections.
"""

from __future__ import annotations

import itertools
import re
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import deletion_vectors as dv
from ..sources.snapshot import Snapshot
from ..sources.storage import Storage, glob_safe

DEFAULT_RETENTION = timedelta(days=7)
DRY_RUN_FILES = 1000
#: Files deleted at a time.
DELETERS = 16
PROPERTY = "delta.deletedFileRetentionDuration"
METRICS = "metric_name string not null, metric_value string not null"


class RetentionTooShort(ValueError):
    """Files could be deleted that readers of an older version need."""


def hours(n: float) -> timedelta:
    """Whole hours and, of the rest, whole minutes."""
    return timedelta(hours=int(n), minutes=int((n - int(n)) * 60))


# Units of an interval.
_UNITS = {"microsecond": 1e-6, "millisecond": 1e-3, "second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def interval(text: str) -> timedelta:
    """Such as `interval 1 week` or `interval 2 days 3 hours`."""
    found = re.findall(r"([+-]?\d+(?:\.\d+)?)\s*([a-z]+?)s?\b", text.lower().replace("interval", " "))
    if not found or any(u not in _UNITS for _, u in found):
        raise ValueError(f"no interval: {text}")
    return timedelta(seconds=sum(float(n) * _UNITS[u] for n, u in found))


def retention(properties: dict, asked: float | None, check: bool = True) -> timedelta:
    """The hours asked for; not below the table's property while the check is on. Else the property; else seven days."""
    own = properties.get(PROPERTY)
    if own is None:
        return hours(asked) if asked is not None else DEFAULT_RETENTION
    least = interval(own)
    if asked is None:
        return least
    if check and hours(asked) < least:
        raise RetentionTooShort(f"{asked} hours are less than the table's {own}")
    return hours(asked)


@dataclass(frozen=True)
class VacuumPlan:
    snapshot: Snapshot
    mode: str
    keep: timedelta
    dry_run: bool
    now_ms: int

    @property
    def cutoff_ms(self) -> int:
        return self.now_ms - int(self.keep.total_seconds() * 1000)

    def __str__(self) -> str:
        return f"Vacuum: table={self.snapshot.root} mode={self.mode} retention_hours={self.keep.total_seconds() / 3600:g} dry_run={str(self.dry_run).lower()}"


def _needed(plan: VacuumPlan) -> DataFrame:
    """Absolute paths of data and vector files that are live or removed too recently."""
    snapshot = plan.snapshot
    spark, root = snapshot.spark, snapshot.root
    recent = snapshot.tombstones.where(F.coalesce("deletionTimestamp", F.lit(0)) >= plan.cutoff_ms)
    rows = snapshot.files.select("path", "deletionVector").unionByName(recent.select("path", "deletionVector"))
    vector = F.col("deletionVector.pathOrInlineDv")
    at = F.when(F.col("deletionVector.storageType") == "u", F.concat(F.lit(f"{root}/"), vector_name(vector))).when(F.col("deletionVector.storageType") == "p", absolute(root, vector))
    return rows.select(F.explode(F.array_compact(F.array(absolute(root, F.col("path")), at))).alias("at"))


def absolute(root: str, path: Column) -> Column:
    """storage.resolved as an expression."""
    # a plus sign stands for itself in a log's paths
    plain = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    local = F.regexp_replace(plain, "^file:/+", "/")
    return F.when(path.rlike("^file:"), local).when(path.rlike("^[A-Za-z][A-Za-z0-9+.-]+:"), plain).when(plain.startswith("/"), plain).otherwise(F.concat(F.lit(f"{root}/"), plain))


def vector_name(name: Column) -> Column:
    """deletion_vectors.relative_name as an expression: four groups of five Z85 digits are the UUID's 16 bytes."""
    tail = F.right(name, F.lit(20))
    digit = lambda i: F.instr(F.lit(dv.Z85), F.substring(tail, i + 1, 1)).cast("long") - 1
    groups = []
    for g in range(4):
        n = F.lit(0).cast("long")
        for i in range(5):
            n = n * 85 + digit(5 * g + i)
        groups.append(F.lpad(F.lower(F.hex(n)), 8, "0"))
    uuid = F.regexp_replace(F.concat(*groups), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    folder = F.left(name, F.length(name) - 20)
    return F.concat(F.when(folder == "", "").otherwise(F.concat(folder, F.lit("/"))), F.lit("deletion_vector_"), uuid, F.lit(".bin"))


def candidates(plan: VacuumPlan) -> DataFrame:
    """path, length, modification_time of files to delete."""
    snapshot = plan.snapshot
    spark, root = snapshot.spark, snapshot.root
    if plan.mode == "LITE":
        expired = snapshot.tombstones.where(F.coalesce("deletionTimestamp", F.lit(0)) < plan.cutoff_ms).select("path").distinct()
        rows = expired.select(absolute(root, F.col("path")).alias("path"), F.lit(None).cast("long").alias("length"), F.lit(None).cast("timestamp").alias("modification_time"))
        return rows.join(_needed(plan), F.col("path") == F.col("at"), "left_anti")
    # Spark lists folders in parallel and leaves out what starts with "_" or ".", partition folders such as _x=1 apart;
    # no file is opened, as its content is not asked for
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(glob_safe(root)).select("path", "length", "modificationTime")
    path = F.regexp_replace("path", "^file:/+", "/") if root.startswith("/") else F.col("path")
    old = listed.where(F.unix_millis("modificationTime") < plan.cutoff_ms)
    rows = old.select(path.alias("path"), "length", F.col("modificationTime").alias("modification_time"))
    return rows.join(_needed(plan), F.col("path") == F.col("at"), "left_anti")


def run(plan: VacuumPlan) -> DataFrame:
    """A dry run gives the paths, at most DRY_RUN_FILES; else files go and metrics come."""
    spark: SparkSession = plan.snapshot.spark
    found = candidates(plan)
    if plan.dry_run:
        return found.select("path").orderBy("path").limit(DRY_RUN_FILES)
    storage, deleted, size = Storage(spark), 0, 0
    with ThreadPoolExecutor(DELETERS) as pool:
        rows = found.select("path", "length").toLocalIterator()
        while some := list(itertools.islice(rows, 10_000)):
            for r, gone in zip(some, pool.map(lambda r: storage.delete(r.path), some), strict=True):
                deleted += gone
                size += (r.length or 0) * gone
    rows = [("numDeletedFiles", str(deleted)), ("numDeletedBytes", str(size)), ("retentionHours", f"{plan.keep.total_seconds() / 3600:g}")]
    return spark.createDataFrame(rows, METRICS)


def plan(snapshot: Snapshot, mode: str = "FULL", retain_hours: float | None = None, dry_run: bool = False, check: bool = True, now_ms: int | None = None) -> VacuumPlan:
    keep = retention(snapshot.metadata.configuration, retain_hours, check)
    return VacuumPlan(snapshot, mode, keep, dry_run, int(time.time() * 1000) if now_ms is None else now_ms)
