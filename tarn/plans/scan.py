"""A snapshot as a DataFrame that Catalyst can prune.

Files are chosen on the driver's side of planning from the live-files DataFrame (partition values and statistics), then
read by one Parquet scan for each tuple of partition values, the values being literals: a filter on a partition column
folds away whole branches of the union, and other filters reach the scan. With more tuples than MAX_BRANCHES there is one
scan, joined with the table of files. Deleted rows leave by a join on file and chunk of rows, and a test of one bit.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import deletion_vectors as dv
from ..sources.snapshot import Snapshot
from ..sources.storage import Storage, glob_safe, resolved, spellings
from . import predicate

MAX_BRANCHES = 64
#: Bytes of the table of files, or of the bits of deleted rows, that may be broadcast: both are known from the log.
BROADCAST_BYTES = 64 << 20
#: Bytes of deletion vectors that are decoded on the driver, where no job need start for them; more are on executors.
DECODED_HERE = 1 << 20
#: Bytes of a chunk's bits.
_CHUNK = 8192
#: Files of a version whose list a snapshot may keep.
MEMO_FILES = 100_000
#: Files of a version whose statistics a snapshot may keep as a local relation, on which Catalyst decides without a job.
LOCAL_FILES = 4096
#: Filters whose files such a snapshot remembers.
FILTERS = 64
_PHYSICAL, _ID = "delta.columnMapping.physicalName", "delta.columnMapping.id"


def physical_name(f: T.StructField, mode: str) -> str:
    return f.metadata.get(_PHYSICAL, f.name) if mode != "none" else f.name


def physical_type(t: T.DataType, mode: str) -> T.DataType:
    """As it is named in the files; with ids where the mode is id."""
    if isinstance(t, T.StructType):
        return T.StructType([physical_field(f, mode) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(physical_type(t.elementType, mode), t.containsNull)
    if isinstance(t, T.MapType):
        return T.MapType(physical_type(t.keyType, mode), physical_type(t.valueType, mode), t.valueContainsNull)
    return t


def physical_field(f: T.StructField, mode: str) -> T.StructField:
    meta = {"parquet.field.id": f.metadata[_ID]} if mode == "id" and _ID in f.metadata else {}
    return T.StructField(physical_name(f, mode), physical_type(f.dataType, mode), True, meta)


def plain_type(t: T.DataType) -> T.DataType:
    """Without field metadata and with everything nullable, for casts that rename by position."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, plain_type(f.dataType), True) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(plain_type(t.elementType), True)
    if isinstance(t, T.MapType):
        return T.MapType(plain_type(t.keyType), plain_type(t.valueType), True)
    return t


def partition_value(raw: Column, t: T.DataType) -> Column:
    """A partition value of the log as its type. A timestamp without a zone is in UTC, whatever the session's zone."""
    raw = F.nullif(raw, F.lit(""))
    if isinstance(t, T.TimestampType):
        raw = F.when(raw.rlike(r"(?:Z|[+-]\d\d:?\d\d)$"), raw).otherwise(F.concat(raw, F.lit("Z")))
    return raw.cast(t)


def partition_literal(value: str | None, t: T.DataType) -> Column:
    return partition_value(F.lit(value or None).cast("string"), t)


def output_schema(snapshot: Snapshot) -> T.StructType:
    return plain_type(snapshot.schema)


@dataclass(frozen=True)
class DataFile:
    path: str
    size: int
    partition: tuple
    vector: object
    records: int | None


def stats_schema(data: list[T.StructField], mode: str) -> T.StructType:
    """minValues, maxValues, nullCount and numRecords of the columns that may have them, by physical name."""

    def of(fields, leaf):
        out = []
        for f in fields:
            if isinstance(f.dataType, T.StructType):
                out.append(T.StructField(physical_name(f, mode), of(f.dataType.fields, leaf)))
            elif (t := leaf(f.dataType)) is not None:
                out.append(T.StructField(physical_name(f, mode), t))
        return T.StructType(out)

    ordered = lambda t: t if isinstance(t, (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)) else None
    counted = lambda t: T.LongType()
    return T.StructType([T.StructField("numRecords", T.LongType()), T.StructField("minValues", of(data, ordered)), T.StructField("maxValues", of(data, ordered)), T.StructField("nullCount", of(data, counted))])


def _has(schema: T.StructType, path) -> T.DataType | None:
    t = schema
    for p in path:
        if not isinstance(t, T.StructType) or p not in t.names:
            return None
        t = t[p].dataType
    return t


def _physical_path(fields: list[T.StructField], path, mode: str):
    out, t = [], T.StructType(fields)
    for p in path:
        found = next((f for f in t.fields if f.name.lower() == p.lower()), None) if isinstance(t, T.StructType) else None
        if found is None:
            return None, None
        out.append(physical_name(found, mode))
        t = found.dataType
    return out, t


def live_files(snapshot: Snapshot, where: predicate.Expr | None = None, files: DataFrame | None = None) -> DataFrame:
    """Files, of all or of those given, that may hold rows for which where is true."""
    files = snapshot.files if files is None else files
    if where is None:
        return files
    mode = snapshot.metadata.mapping_mode
    parts = set(snapshot.metadata.partition_columns)
    data = [f for f in snapshot.schema.fields if f.name not in parts]
    shape = stats_schema(data, mode)
    files = files.withColumn("_s", F.from_json("stats", shape))

    def bounds(path):
        if len(path) == 1 and (field := next((f for f in snapshot.schema.fields if f.name.lower() == path[0].lower() and f.name in parts), None)):
            raw = F.col("partitionValues")[physical_name(field, mode)]
            value = partition_value(raw, field.dataType)
            null = F.when(value.isNull(), 1).otherwise(0)
            return value, value, null, F.lit(1)
        at, t = _physical_path(data, path, mode)
        if at is None:
            return None
        get = lambda kind: reduce(lambda c, p: c.getField(p), at, F.col("_s").getField(kind))
        none = F.lit(None)
        low = get("minValues") if _has(shape["minValues"].dataType, at) is not None else none.cast(t)
        high = get("maxValues") if _has(shape["maxValues"].dataType, at) is not None else none.cast(t)
        if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            # written to the millisecond, rounded down
            high = high + F.expr("interval 1 millisecond")
        if isinstance(t, T.StringType):
            # may be cut short, with or without a sign that makes it an upper bound
            high = F.concat(high, F.lit("\U0010ffff"))
        nulls = get("nullCount") if _has(shape["nullCount"].dataType, at) is not None else none.cast("long")
        return low, high, nulls, F.col("_s.numRecords")

    return files.where(predicate.may_match(where, bounds)).drop("_s")


def chosen(snapshot: Snapshot, where: predicate.Expr | None = None) -> list[DataFile]:
    """The file list of a scan, which the reader needs on the driver as it does for any table. Files all of whose rows
    are deleted are not in it."""
    memo = snapshot.memo
    if where is None and memo.get("files") is not None:
        return memo["files"]
    if memo.get("skipping") is not None:
        asked = memo.setdefault("asked", {})
        if repr(where) not in asked:
            left = {r.path for r in live_files(snapshot, where, memo["skipping"]).select("path").collect()}
            while len(asked) >= FILTERS:
                del asked[next(iter(asked))]
            asked[repr(where)] = [f for f in memo["files"] if memo["names"][f.path] in left]
        return asked[repr(where)]
    mode = snapshot.metadata.mapping_mode
    names = [physical_name(snapshot.schema[c], mode) for c in snapshot.metadata.partition_columns]
    rows = live_files(snapshot, where).select("path", "size", "partitionValues", "deletionVector", "stats", F.get_json_object("stats", "$.numRecords").cast("long").alias("records")).collect()
    out, kept = [], {}
    for r in sorted(rows, key=lambda r: r.path):
        values = r.partitionValues or {}
        if r.deletionVector and r.records is not None and r.deletionVector.cardinality == r.records:
            continue
        out.append(DataFile(resolved(snapshot.root, r.path), r.size, tuple(values.get(n) for n in names), r.deletionVector, r.records))
        kept[out[-1].path] = r
    if where is None and len(out) <= MEMO_FILES:
        memo["files"] = out
        if 0 < len(out) <= LOCAL_FILES:
            values = pa.array([list((r.partitionValues or {}).items()) for r in kept.values()], pa.map_(pa.string(), pa.string()))
            local = pa.table({"path": pa.array([r.path for r in kept.values()], pa.string()), "partitionValues": values, "stats": pa.array([r.stats for r in kept.values()], pa.string())})
            memo["names"], memo["skipping"] = {at: r.path for at, r in kept.items()}, snapshot.spark.createDataFrame(local)
    return out


DELETED = "file_path string, chunk long, words array<long>"


def deleted_bytes(files: list[DataFile]) -> int:
    """How large deleted_chunks is at most."""
    chunks = lambda f: f.vector.cardinality if f.records is None else min(f.vector.cardinality, -(-f.records // (1 << 16)))
    return sum(chunks(f) * sum(_CHUNK + len(x) for x in spellings(f.path)) for f in files)


def _decoded(vectors):
    """Columns of DELETED for (file_path spellings, row numbers)."""
    out = {"file_path": [], "chunk": [], "words": []}
    for names, rows in vectors:
        for chunk, words in dv.chunks(rows):
            for name in names:
                for c, v in zip(out, (name, chunk, words), strict=True):
                    out[c].append(v)
    return pa.table({"file_path": pa.array(out["file_path"], pa.string()), "chunk": pa.array(out["chunk"], pa.int64()), "words": pa.array(out["words"], pa.list_(pa.int64()))})


def deleted_chunks(snapshot: Snapshot, files: list[DataFile]) -> DataFrame:
    """file_path, chunk of 65,536 rows, and its deleted rows as 1024 longs of bits. Each vector is read once; more than
    DECODED_HERE bytes of them are decoded on executors, one row of work a vector file."""
    spark, root = snapshot.spark, snapshot.root
    inline, stored = [], {}
    for f in files:
        v = f.vector
        if v.storageType == "i":
            inline.append((spellings(f.path), v.pathOrInlineDv, v.sizeInBytes))
        else:
            at = resolved(root, v.pathOrInlineDv) if v.storageType == "p" else f"{root}/{dv.relative_name(v.pathOrInlineDv)}"
            stored.setdefault(at, []).append((spellings(f.path), 1 if v.offset is None else v.offset, v.sizeInBytes))
    if sum(f.vector.sizeInBytes for f in files) <= DECODED_HERE:
        key = ("deleted", tuple((f.path, dv.unique_id(f.vector)) for f in files))
        if key not in snapshot.memo:
            storage = Storage(spark)
            here = [(names, dv.inline_rows(text, size)) for names, text, size in inline]
            here += [(names, dv.rows_in_file(storage.read(at, offset, offset + size + 8), 0)) for at, some in stored.items() for names, offset, size in some]
            snapshot.memo[key] = spark.createDataFrame(_decoded(here), DELETED)
        return snapshot.memo[key]

    def from_text(batches):
        for batch in batches:
            yield from _decoded((r["names"], dv.inline_rows(r["text"], r["size"])) for r in batch.to_pylist()).to_batches()

    def from_files(batches):
        for batch in batches:
            for r in batch.to_pylist():
                for v in r["vectors"]:
                    yield from _decoded([(v["names"], dv.rows_in_file(r["content"], v["offset"]))]).to_batches()

    parts = []
    if inline:
        parts.append(spark.createDataFrame(inline, "names array<string>, text string, size int").mapInArrow(from_text, DELETED))
    if stored:
        # a vector file's content meets the list of its vectors once
        lists = [(uri, [(names, offset) for names, offset, _ in some]) for at, some in stored.items() for uri in spellings(at)]
        lists = spark.createDataFrame(lists, "uri string, vectors array<struct<names: array<string>, offset: int>>")
        content = spark.read.format("binaryFile").load([glob_safe(p) for p in sorted(stored)]).select(F.col("path").alias("uri"), "content")
        parts.append(content.join(lists, "uri").select("content", "vectors").mapInArrow(from_files, DELETED))
    return reduce(DataFrame.unionByName, parts)


def stub(snapshot: Snapshot, mark: str) -> DataFrame:
    """A stand-in that has the table's columns, for plans that are made and never run. mark is an option of its scan."""
    log_file = (snapshot.segment.commits or snapshot.segment.checkpoint)[-1]
    return snapshot.spark.read.schema(output_schema(snapshot)).option(predicate.MARK, mark).parquet(glob_safe(log_file))


def scan(snapshot: Snapshot, where: predicate.Expr | None = None, columns: list[str] | None = None, files: list[DataFile] | None = None) -> DataFrame:
    """The rows of a snapshot under its logical schema. where prunes files and filters; columns projects; files, of those
    that chosen gives, are the ones to read.

    Columns mapped by id need the session's Parquet reader to go by ids; that setting stays, as the result is lazy.
    """
    spark, meta, mode = snapshot.spark, snapshot.metadata, snapshot.metadata.mapping_mode
    schema = snapshot.schema
    fields = list(schema.fields)
    parts = [schema[c] for c in meta.partition_columns]
    data = [f for f in fields if f.name not in set(meta.partition_columns)]
    reading = T.StructType([physical_field(f, mode) for f in data])
    if mode == "id":
        spark.conf.set("spark.sql.parquet.fieldId.read.enabled", "true")
        spark.conf.set("spark.sql.parquet.fieldId.read.ignoreMissing", "true")
    files = chosen(snapshot, where) if files is None else files

    def read(some: list[DataFile], extra=()) -> DataFrame:
        df = spark.read.schema(reading).parquet(*(glob_safe(f.path) for f in some))
        deleted = [f for f in some if f.vector]
        file = F.col("_metadata.file_path")
        if deleted:
            gone = deleted_chunks(snapshot, deleted)
            if deleted_bytes(deleted) <= BROADCAST_BYTES:
                gone = F.broadcast(gone)
            df = df.withColumn("__file", file).withColumn("__row", F.col("_metadata.row_index"))
            df = df.join(gone, (df["__file"] == gone["file_path"]) & (F.shiftright(df["__row"], 16) == gone["chunk"]), "left")
            word = F.get("words", F.shiftright(F.col("__row").bitwiseAND(F.lit(0xFFFF)), 6).cast("int"))
            bit = F.call_function("shiftright", word, F.col("__row").bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1))
            df = df.where(F.coalesce(bit, F.lit(0)) == 0).drop("__row", "file_path", "chunk", "words", *([] if "__file" in extra else ["__file"]))
        elif "__file" in extra:
            df = df.withColumn("__file", file)
        return df

    def logical(df: DataFrame, part_value) -> DataFrame:
        out = []
        for f in fields:
            c = part_value(f) if f.name in meta.partition_columns else F.col("`" + physical_name(f, mode).replace("`", "``") + "`")
            if f.name not in meta.partition_columns and mode != "none" and _nested(f.dataType):
                c = c.cast(plain_type(f.dataType))
            out.append(c.alias(f.name))
        return df.select(*out)

    def branch(some: list[DataFile], values: tuple) -> list[DataFrame]:
        by_name = {f.name: partition_literal(v, f.dataType) for f, v in zip(parts, values, strict=True)}
        # files with deleted rows are a scan of their own, so that the others need no join
        kinds = [[f for f in some if not f.vector], [f for f in some if f.vector]]
        return [logical(read(k), lambda f: by_name[f.name]) for k in kinds if k]

    groups: dict[tuple, list[DataFile]] = {}
    for f in files:
        groups.setdefault(f.partition, []).append(f)
    if not groups:
        df = spark.createDataFrame([], output_schema(snapshot))
    elif len(groups) <= MAX_BRANCHES:
        df = reduce(DataFrame.unionByName, [b for values, some in sorted(groups.items(), key=lambda x: tuple((v is not None, v) for v in x[0])) for b in branch(some, values)])
    else:
        names = [f"__p{i}" for i in range(len(parts))]
        rows = [(uri, *f.partition) for f in files for uri in spellings(f.path)]
        table = spark.createDataFrame(rows, T.StructType([T.StructField("__at", T.StringType()), *(T.StructField(n, T.StringType()) for n in names)]))
        if sum(len(v or "") + 16 for r in rows for v in r) <= BROADCAST_BYTES:
            table = F.broadcast(table)
        rows = read(files, ("__file",))
        rows = rows.join(table, rows["__file"] == table["__at"])
        place = {f.name: n for f, n in zip(parts, names, strict=True)}
        df = logical(rows, lambda f: partition_value(F.col(place[f.name]), f.dataType))
    if where is not None:
        df = df.where(predicate.to_column(where))
    return df.select(*columns) if columns is not None else df


def _nested(t: T.DataType) -> bool:
    return isinstance(t, (T.StructType, T.ArrayType, T.MapType))
