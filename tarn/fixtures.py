"""Small log-backed tables made from Parquet tables, for queries and tests. They are made once a session and folder."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sources import deletion_vectors as dv
from .sources.commit import write_checkpoint, write_commit
from .sources.log import LOG_DIR
from .sources.storage import Storage, glob_safe, workspace

NOW_MS = 1_700_000_000_000


class Builder:
    """Writes data files and commits of one table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.storage, self.version = spark, root, Storage(spark), 0

    def start(self, schema: T.StructType, partitions=(), properties=None, features=(), reader: int | None = None) -> list[dict]:
        features = list(features)
        if any(isinstance(f.dataType, T.TimestampNTZType) for f in schema.fields):
            features.append("timestampNtz")
        protocol = {"minReaderVersion": 3, "minWriterVersion": 7, "readerFeatures": features, "writerFeatures": features} if features else {"minReaderVersion": reader or 1, "minWriterVersion": 2}
        if reader and not features:
            protocol["minWriterVersion"] = 5
        return [{"protocol": protocol}, self.metadata(schema, partitions, properties)]

    def metadata(self, schema, partitions=(), properties=None) -> dict:
        return {"metaData": {"id": str(uuid.uuid5(uuid.NAMESPACE_URL, self.root)), "format": {"provider": "parquet", "options": {}}, "schemaString": schema.json(), "partitionColumns": list(partitions), "configuration": properties or {}, "createdTime": NOW_MS}}

    def add(self, df: DataFrame, partition: dict | None = None, folder: str = "", stats: bool = True) -> dict:
        """Writes df as one file and gives its action."""
        at = f"{self.root}/{folder}".rstrip("/")
        name = f"part-{uuid.uuid4().hex}.parquet"
        aside = f"{self.root}/_tmp-{uuid.uuid4().hex}"
        df.coalesce(1).write.parquet(aside)
        made = [f for f in self.storage.list(aside) if f.name.endswith(".parquet")][0]
        self.spark._jvm.org.apache.hadoop.fs.Path(at)
        path, fs = self.storage._at(at)
        fs.mkdirs(path)
        self.storage.rename(made.path, f"{at}/{name}")
        self.storage.drop(aside)
        relative = f"{folder}/{name}" if folder else name
        action = {"path": quote(relative, safe="/=-_.~"), "partitionValues": partition or {}, "size": made.length, "modificationTime": NOW_MS, "dataChange": True}
        if stats:
            action["stats"] = json.dumps(self.stats(self.spark.read.parquet(glob_safe(f"{at}/{name}"))))
        return {"add": action}

    def stats(self, df: DataFrame) -> dict:
        leaves = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.StringType, T.DateType, T.TimestampNTZType))]
        q = lambda c: F.col(f"`{c}`")
        one = df.agg(F.count(F.lit(1)).alias("n"), *(x for i, c in enumerate(leaves) for x in (F.min(q(c)).alias(f"a{i}"), F.max(q(c)).alias(f"z{i}"), F.count_if(q(c).isNull()).alias(f"n{i}")))).first()

        def text(v):
            if hasattr(v, "isoformat"):
                return v.isoformat(timespec="milliseconds") if hasattr(v, "hour") else v.isoformat()
            return float(v) if v is not None and not isinstance(v, (int, float, str)) else v

        kept = [(i, c) for i, c in enumerate(leaves) if one[f"a{i}"] is not None]
        return {"numRecords": one.n, "minValues": {c: text(one[f"a{i}"]) for i, c in kept}, "maxValues": {c: text(one[f"z{i}"]) for i, c in kept}, "nullCount": {c: one[f"n{i}"] for i, c in enumerate(leaves)}}

    def remove(self, action: dict, when_ms: int = NOW_MS, with_vector: bool = True) -> dict:
        a = action["add"]
        out = {"path": a["path"], "deletionTimestamp": when_ms, "dataChange": True, "partitionValues": a["partitionValues"], "size": a["size"]}
        if with_vector and "deletionVector" in a:
            out["deletionVector"] = a["deletionVector"]
        return {"remove": out}

    def commit(self, *actions: dict) -> int:
        write_commit(self.spark, self.root, self.version, [*actions, {"commitInfo": {"timestamp": NOW_MS + self.version, "operation": "WRITE"}}])
        self.version += 1
        return self.version - 1

    def bits_where(self, action: dict, condition: str) -> dict[int, bytes]:
        """The 65,536 bits of each chunk (row >> 16) of the file that holds rows of this condition. Executors set them, so that
        a bit for each row of the file reaches the driver, where the vector is written, and no row numbers."""
        from .sources.storage import resolved

        def set_bits(batches):
            found = {}
            for batch in batches:
                for chunk, words in dv.chunks(batch.column(0).to_numpy(zero_copy_only=False)):
                    found[chunk] = found[chunk] | words if chunk in found else words
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array([x.tobytes() for x in found.values()], pa.binary())], names=["chunk", "bits"])

        df = self.spark.read.parquet(glob_safe(resolved(self.root, action["add"]["path"])))
        parts = df.where(condition).select("_metadata.row_index").mapInArrow(set_bits, "chunk long, bits binary")
        out: dict[int, bytes] = {}
        for chunk, bits in parts.toLocalIterator():
            out[chunk] = (np.frombuffer(out[chunk], np.uint8) | np.frombuffer(bits, np.uint8)).tobytes() if chunk in out else bytes(bits)
        return out

    def with_vector(self, action: dict, bits: dict[int, bytes], inline: bool, runs: bool = False) -> dict:
        payload = dv.encode_bits(bits, runs)
        cardinality = sum(int.from_bytes(x, "little").bit_count() for x in bits.values())
        if inline:
            vector = {"storageType": "i", "pathOrInlineDv": dv.z85_encode(payload), "sizeInBytes": len(payload), "cardinality": cardinality}
        else:
            name = uuid.uuid4()
            data, offsets = dv.file_of([payload])
            self.storage.write(f"{self.root}/deletion_vector_{name}.bin", data)
            vector = {"storageType": "u", "pathOrInlineDv": dv.z85_encode(name.bytes), "offset": offsets[0], "sizeInBytes": len(payload), "cardinality": cardinality}
        return {"add": action["add"] | {"deletionVector": vector}}


def _source(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(b: Builder, sf_dir: str) -> None:
    df = _source(b.spark, sf_dir, "lineitem")
    slices = [df.where(f"l_orderkey % 4 = {i}") for i in range(4)]
    b.commit(*b.start(df.schema), *(b.add(s) for s in slices))


def sorted_orders(b: Builder, sf_dir: str) -> None:
    """Files of disjoint key ranges, so that statistics tell them apart."""
    df = _source(b.spark, sf_dir, "orders")
    top = df.agg(F.max("o_orderkey")).first()[0] + 1
    cuts = [top * i // 8 for i in range(9)]
    b.commit(*b.start(df.schema), *(b.add(df.where(f"o_orderkey >= {a} and o_orderkey < {z}")) for a, z in zip(cuts, cuts[1:], strict=False)))


def multi_commit(b: Builder, sf_dir: str) -> None:
    df = _source(b.spark, sf_dir, "orders")
    adds = [b.add(df.where(f"o_orderkey % 4 = {i}")) for i in range(4)]
    b.commit(*b.start(df.schema), adds[0])
    for a in adds[1:]:
        b.commit(a)
    b.commit(b.remove(adds[1]))


def partitioned(b: Builder, sf_dir: str) -> None:
    df = _source(b.spark, sf_dir, "orders")
    values = sorted(r[0] for r in df.select("o_orderstatus").distinct().collect())
    b.commit(*b.start(df.schema, ["o_orderstatus"]), *(b.add(df.where(F.col("o_orderstatus") == v).drop("o_orderstatus"), {"o_orderstatus": v}, f"o_orderstatus={v}") for v in values))


#: Partition values that need care in paths.
ODD = [("a b", 0), ("x/y", 1), ("50%", 2), ("[z]*", 3), (None, 4)]


def odd_events(df: DataFrame) -> DataFrame:
    kind = F.coalesce(*(F.when(F.col("event_id") % 5 == i, F.lit(v)) for v, i in ODD if v))
    return df.select("event_id", "value", kind.alias("kind"), (F.col("event_id") % 5).cast("int").alias("num"), (F.col("event_id") % 5 > 2).alias("flag"))


def partitioned_odd(b: Builder, sf_dir: str) -> None:
    df = odd_events(_source(b.spark, sf_dir, "events"))
    parts = ["kind", "num", "flag"]
    adds = []
    for v, i in ODD:
        values = {"kind": v, "num": str(i), "flag": str(i > 2).lower()}
        folder = f"kind={quote(v or '__HIVE_DEFAULT_PARTITION__', safe=' []*')}/num={i}"
        adds.append(b.add(df.where(F.col("num") == i).drop(*parts), values, folder))
    b.commit(*b.start(df.schema, parts), *adds)


def many_partitions(b: Builder, sf_dir: str) -> None:
    """More tuples of partition values than a union has branches."""
    df = _source(b.spark, sf_dir, "customer").withColumn("bucket", (F.col("c_custkey") % 70).cast("int"))
    b.commit(*b.start(df.schema, ["bucket"]), *(b.add(df.where(F.col("bucket") == i).drop("bucket"), {"bucket": str(i)}, f"bucket={i}", stats=False) for i in range(70)))


def evolved(b: Builder, sf_dir: str) -> None:
    df = _source(b.spark, sf_dir, "customer").withColumn("extra", F.struct(F.col("c_nationkey").alias("nation"), F.upper("c_mktsegment").alias("segment")))
    old = df.select("c_custkey", "c_name", F.struct("extra.nation").alias("extra"), "c_acctbal").where("c_custkey % 2 = 0")
    b.commit(*b.start(old.schema), b.add(old))
    new = df.where("c_custkey % 2 = 1").select("c_custkey", "c_name", "extra", "c_acctbal", "c_mktsegment")
    b.commit(b.metadata(new.schema), b.add(new))


def widened(b: Builder, sf_dir: str) -> None:
    df = _source(b.spark, sf_dir, "part").select("p_partkey", "p_size", F.col("p_retailprice").cast("float").alias("price"))
    b.commit(*b.start(df.schema, features=["typeWidening"]), b.add(df.where("p_partkey % 2 = 0")))
    wide = df.select("p_partkey", F.col("p_size").cast("long"), F.col("price").cast("double"))
    b.commit(b.metadata(wide.schema), b.add(wide.where("p_partkey % 2 = 1")))


def nested(b: Builder, sf_dir: str) -> None:
    df = _source(b.spark, sf_dir, "embeddings")
    wide = df.select(
        "vec_id",
        F.struct("label", F.size("embedding").alias("dims")).alias("s"),
        F.array(F.struct(F.col("label").alias("x"), F.lit("one").alias("y")), F.struct((F.col("label") + 1).alias("x"), F.lit("two").alias("y"))).alias("a"),
        F.create_map(F.lit("k"), F.struct(F.col("vec_id").alias("v"), F.lit(1).alias("w"))).alias("m"),
    )
    narrow = wide.select("vec_id", F.struct("s.label").alias("s"), F.transform("a", lambda e: F.struct(e["x"].alias("x"))).alias("a"), F.transform_values("m", lambda k, e: F.struct(e["v"].alias("v"))).alias("m"))
    b.commit(*b.start(wide.schema), b.add(narrow.where("vec_id % 2 = 0")), b.add(wide.where("vec_id % 2 = 1")))


def _mapped(mode: str) -> Callable[[Builder, str], None]:
    def build(b: Builder, sf_dir: str) -> None:
        df = _source(b.spark, sf_dir, "nation").select("n_nationkey", F.struct(F.col("n_name").alias("label"), "n_regionkey").alias("about"), (F.col("n_regionkey") % 2).cast("int").alias("odd"))
        name = lambda i: {"delta.columnMapping.id": i, "delta.columnMapping.physicalName": f"col-{i:08x}"}
        logical = T.StructType(
            [
                T.StructField("key of nation", T.IntegerType(), True, name(1)),
                T.StructField("about", T.StructType([T.StructField("label", T.StringType(), True, name(3)), T.StructField("region", T.IntegerType(), True, name(4))]), True, name(2)),
                T.StructField("odd", T.IntegerType(), True, name(5)),
            ]
        )
        ids = lambda i: {"parquet.field.id": i}
        written = T.StructType(
            [
                T.StructField("col-00000001", T.IntegerType(), True, ids(1)),
                T.StructField("col-00000002", T.StructType([T.StructField("col-00000003", T.StringType(), True, ids(3)), T.StructField("col-00000004", T.IntegerType(), True, ids(4))]), True, ids(2)),
            ]
        )
        b.spark.conf.set("spark.sql.parquet.fieldId.write.enabled", "true")
        adds = []
        for odd in (0, 1):
            part = df.where(F.col("odd") == odd).select(F.col("n_nationkey").alias("col-00000001"), F.col("about").cast(written["col-00000002"].dataType).alias("col-00000002"))
            part = part.to(written)
            adds.append(b.add(part, {"col-00000005": str(odd)}))
        b.commit(*b.start(logical, ["odd"], {"delta.columnMapping.mode": mode}, reader=2), *adds)

    return build


def _checkpointed(parts: int = 1, v2: bool = False) -> Callable[[Builder, str], None]:
    def build(b: Builder, sf_dir: str) -> None:
        df = _source(b.spark, sf_dir, "orders")
        adds = [b.add(df.where(f"o_orderkey % 12 = {i}")) for i in range(12)]
        b.commit(*b.start(df.schema, features=["v2Checkpoint"] if v2 else ()), adds[0])
        for i in range(1, 11):
            b.commit(adds[i], *([b.remove(adds[3])] if i == 5 else []))
        write_checkpoint(b.spark, b.root, 10, parts, v2)
        b.commit(adds[11])
        for v in range(10):
            b.storage.delete(f"{b.root}/{LOG_DIR}/{v:020d}.json")

    return build


def _vectors(inline: bool) -> Callable[[Builder, str], None]:
    def build(b: Builder, sf_dir: str) -> None:
        """Rows of every seventh order are deleted: sparse in one file, dense in another, in runs in a third; a fourth
        file is deleted as a whole, and a vector is replaced by a later one."""
        df = _source(b.spark, sf_dir, "lineitem")
        adds = [b.add(df.where(f"l_orderkey % 5 = {i}").sort("l_orderkey", "l_linenumber")) for i in range(5)]
        dead = ["l_orderkey % 7 = 0", "l_orderkey % 7 <> 1", "l_quantity >= 0 and l_orderkey % 2 = 0", "true"]
        now = [b.with_vector(a, b.bits_where(a, c), inline and i != 1, runs=i == 2) for i, (a, c) in enumerate(zip(adds, dead, strict=False))]
        first = b.with_vector(adds[4], b.bits_where(adds[4], "l_orderkey % 3 = 0"), inline)
        b.commit(*b.start(df.schema, features=["deletionVectors"]), *now, first)
        second = b.with_vector(adds[4], b.bits_where(adds[4], "l_orderkey % 3 < 2"), inline)
        b.commit(b.remove(first), second)

    return build


#: What the fixtures with vectors have left.
VECTORS_LEFT = "(l_orderkey % 5 = 0 AND l_orderkey % 7 <> 0) OR (l_orderkey % 5 = 1 AND l_orderkey % 7 = 1) OR (l_orderkey % 5 = 2 AND l_orderkey % 2 <> 0) OR (l_orderkey % 5 = 4 AND l_orderkey % 3 = 2)"


def no_stats(b: Builder, sf_dir: str) -> None:
    df = _source(b.spark, sf_dir, "orders")
    b.commit(*b.start(df.schema), *(b.add(df.where(f"o_orderkey % 3 = {i}"), stats=False) for i in range(3)))


def empty(b: Builder, sf_dir: str) -> None:
    b.commit(*b.start(_source(b.spark, sf_dir, "nation").schema))


def all_types(b: Builder, sf_dir: str) -> None:
    df = _source(b.spark, sf_dir, "events")
    n = F.col("event_id")
    df = df.select(
        n.alias("l"), (n % 2 == 0).alias("bo"), F.col("event_type").alias("s"), (n % 128).cast("byte").alias("by"), (n % 32768).cast("short").alias("sh"), n.cast("int").alias("i"), F.col("value").cast("float").alias("f"), F.col("value").alias("d"),
        F.col("ts").cast("timestamp").alias("t"), F.col("ts").alias("tn"), F.col("ts").cast("date").alias("da"), F.encode("event_type", "utf-8").alias("bi"), F.col("value").cast("decimal(20,4)").alias("de"),
    )
    b.commit(*b.start(df.schema, features=["timestampNtz"]), b.add(df))


def vacuumable(b: Builder, sf_dir: str) -> None:
    """Live, long and lately removed, untracked and hidden files."""
    import time

    now = int(time.time() * 1000)
    old = now - 30 * 86_400_000
    df = _source(b.spark, sf_dir, "nation")
    live, gone, recent = (b.add(df.where(f"n_nationkey % 3 = {i}"), folder=f"d{i}") for i in range(3))
    b.commit(*b.start(df.schema), live, gone, recent)
    b.commit(b.remove(gone, old))
    b.commit(b.remove(recent, now - 3_600_000))
    for name in ("stray.parquet", "d0/stray.parquet", "_hidden/stray.parquet", "new.parquet"):
        b.storage.write(f"{b.root}/{name}", b"x")
    for f in list(b.storage.walk(b.root)):
        if not f.path.endswith("/new.parquet"):
            b.storage.modified(f.path, old)


def unsupported(b: Builder, sf_dir: str) -> None:
    b.commit(*b.start(_source(b.spark, sf_dir, "nation").schema, features=["unknownX"]))


FIXTURES: dict[str, Callable[[Builder, str], None]] = {
    "plain": plain, "sorted_orders": sorted_orders, "multi_commit": multi_commit, "partitioned": partitioned, "partitioned_odd": partitioned_odd, "many_partitions": many_partitions,
    "evolved": evolved, "widened": widened, "nested": nested, "mapped_name": _mapped("name"), "mapped_id": _mapped("id"), "checkpointed": _checkpointed(), "checkpoint_parts": _checkpointed(2),
    "checkpoint_v2": _checkpointed(2, True), "dv_inline": _vectors(True), "dv_file": _vectors(False), "no_stats": no_stats, "empty": empty, "all_types": all_types, "vacuumable": vacuumable, "unsupported": unsupported,
}
_made: dict[tuple, str] = {}


def path_of(spark: SparkSession, sf_dir: str, name: str, fresh: bool = False) -> str:
    """The table's folder; it is made at the first call."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if fresh or key not in _made:
        root = f"{workspace(spark)}/fixtures-{uuid.uuid4().hex}/{name}"
        FIXTURES[name](Builder(spark, root), sf_dir)
        if fresh:
            return root
        _made[key] = root
    return _made[key]
