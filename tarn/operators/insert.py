"""Appending rows to a log-backed table: Parquet files written by executors, then one commit that adds them.

Files go into a folder of their own, so none is renamed and a writer that dies leaves nothing that a reader sees (VACUUM
takes it away). Statistics come from one aggregation by file over what was written. A commit that another writer was
faster with is tried again on the next version, as an append conflicts with nothing but a change of the table's metadata.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import snapshot as snapshots
from ..sources.commit import write_commit
from ..sources.storage import FileAlreadyExists, Storage, glob_safe, spellings

#: Writer features that an append need not care for.
FEATURES = frozenset(("appendOnly", "deletionVectors", "timestampNtz", "v2Checkpoint", "typeWidening", "typeWidening-preview", "vacuumProtocolCheck"))
#: Field metadata that asks more of a writer.
_RULES = ("delta.invariants", "delta.generationExpression", "delta.identity.start")
ATTEMPTS = 20
#: Longer strings have no statistics.
STRING_STATS = 64
# Fixed value: the folder of a null in partition paths.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class CannotAppend(NotImplementedError):
    """The table asks for more than appending rows."""


class Conflict(RuntimeError):
    """Another writer changed the table meanwhile."""


def check(snapshot: snapshots.Snapshot) -> None:
    meta, protocol = snapshot.metadata, snapshot.protocol
    if more := sorted(set(protocol.writer_features) - FEATURES):
        raise CannotAppend(f"writer features {', '.join(more)}")
    if protocol.min_writer_version > 2 and not protocol.writer_features and (meta.mapping_mode != "none" or any(k.startswith("delta.constraints.") for k in meta.configuration)):
        raise CannotAppend("column mapping or constraints")
    if meta.mapping_mode != "none":
        raise CannotAppend("column mapping")
    if rules := [f.name for f in snapshot.schema.fields if any(k in f.metadata for k in _RULES)]:
        raise CannotAppend(f"rules for {', '.join(rules)}")


def fitted(snapshot: snapshots.Snapshot, rows: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """rows, by position of the table's columns or of those named, under the table's schema."""
    fields = snapshot.schema.fields
    names = [f.name for f in fields] if columns is None else list(columns)
    if len(names) != len(rows.columns):
        raise ValueError(f"{len(rows.columns)} columns for {len(names)}")
    known = {f.name.lower(): f for f in fields}
    if wrong := [n for n in names if n.lower() not in known]:
        raise ValueError(f"the table has no column {', '.join(wrong)}")
    rows = rows.toDF(*(f"_{i}" for i in range(len(names))))
    place = {n.lower(): F.col(f"_{i}") for i, n in enumerate(names)}
    out = []
    for f in fields:
        value = place.get(f.name.lower(), F.lit(None)).cast(f.dataType)
        if not f.nullable:
            value = F.when(value.isNull(), F.raise_error(F.lit(f"{f.name} must not be NULL"))).otherwise(value)
        out.append(value.alias(f.name))
    return rows.select(*out)


def _as_partition(f: T.StructField, zone: str) -> Column:
    """A partition value as the log has it: timestamps are in UTC."""
    c = F.col(f"`{f.name}`")
    return (F.date_format(F.to_utc_timestamp(c, zone), "yyyy-MM-dd HH:mm:ss.SSSSSS") if isinstance(f.dataType, T.TimestampType) else c.cast("string")).alias(f.name)


def _stats(written: DataFrame, fields: list[T.StructField]) -> dict[str, str]:
    """Statistics by file, as JSON."""
    kinds = (T.NumericType, T.StringType, T.DateType)
    leaves = [f for f in fields if isinstance(f.dataType, kinds)]
    q = lambda f: F.col(f"`{f.name}`")
    short = lambda f, c: F.when(F.length(c) <= STRING_STATS, c) if isinstance(f.dataType, T.StringType) else c
    of = lambda one: F.struct(*(short(f, one(q(f))).alias(f.name) for f in leaves))
    nulls = F.struct(*(F.count_if(q(f).isNull()).alias(f.name) for f in leaves))
    parts = [F.count(F.lit(1)).alias("numRecords")] + ([of(F.min).alias("minValues"), of(F.max).alias("maxValues"), nulls.alias("nullCount")] if leaves else [])
    by_file = written.select("*", F.col("_metadata.file_path").alias("__file")).groupBy("__file").agg(*parts)
    return {r["__file"]: r.stats for r in by_file.select("__file", F.to_json(F.struct(*(c for c in by_file.columns if c != "__file"))).alias("stats")).collect()}


def append(snapshot: snapshots.Snapshot, rows: DataFrame) -> snapshots.Snapshot:
    """The version that has rows too. rows are under the table's schema (see fitted)."""
    check(snapshot)
    spark, root, storage = snapshot.spark, snapshot.root, Storage(snapshot.spark)
    parts = list(snapshot.metadata.partition_columns)
    zone = spark.conf.get("spark.sql.session.timeZone")
    data = [f for f in snapshot.schema.fields if f.name not in parts]
    folder = f"insert-{uuid.uuid4().hex}"
    shaped = rows.select(*(F.col(f"`{f.name}`") for f in data), *(_as_partition(snapshot.schema[p], zone) for p in parts))
    writer = shaped.write.partitionBy(*parts) if parts else shaped.write
    writer.parquet(f"{root}/{folder}")
    reading = T.StructType([T.StructField(f.name, f.dataType, True) for f in data])
    files = [x for x in storage.walk(f"{root}/{folder}") if x.name.endswith(".parquet")]
    at = {x.path: x.path.split(f"/{folder}/", 1)[1] for x in files}
    if not files:
        return snapshot
    found = _stats(spark.read.schema(reading).option("recursiveFileLookup", "true").parquet(glob_safe(f"{root}/{folder}")), data)
    adds = []
    for x in files:
        values = dict(part.split("=", 1) for part in at[x.path].split("/")[:-1])
        values = {unquote(k): None if v == NULL_FOLDER else unquote(v) for k, v in values.items()}
        stats = next((found[u] for u in spellings(f"{root}/{folder}/{at[x.path]}") if u in found), None)
        action = {"path": quote(f"{folder}/{at[x.path]}", safe="/=-_.~"), "partitionValues": values, "size": x.length, "modificationTime": x.modified_ms, "dataChange": True}
        adds.append({"add": action | ({"stats": stats} if stats else {})})
    actions = [*adds, {"commitInfo": {"operation": "WRITE", "operationParameters": {"mode": "Append"}}}]
    now = snapshot
    for _ in range(ATTEMPTS):
        try:
            write_commit(spark, root, now.version + 1, actions)
            return snapshots.refresh(now)
        except FileAlreadyExists:
            now = snapshots.refresh(now)
            if (now.metadata, now.protocol) != (snapshot.metadata, snapshot.protocol):
                raise Conflict(f"{root}: another writer changed the table's metadata") from None
    raise Conflict(f"{root}: {ATTEMPTS} versions went to other writers")
