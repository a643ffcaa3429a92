"""A table version: protocol, metadata, schema, and its live files as a DataFrame."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import log
from .storage import Storage, normalised

#: Reader features that scans honour.
FEATURES = frozenset(("columnMapping", "deletionVectors", "timestampNtz", "typeWidening", "typeWidening-preview", "v2Checkpoint", "vacuumProtocolCheck"))
MAX_READER = 3


class UnsupportedProtocol(ValueError):
    """The table asks for a reader that this one is not."""


@dataclass(frozen=True)
class Protocol:
    min_reader_version: int
    min_writer_version: int
    reader_features: tuple[str, ...] = ()
    writer_features: tuple[str, ...] = ()

    def check(self) -> None:
        if self.min_reader_version > MAX_READER:
            raise UnsupportedProtocol(f"reader version {self.min_reader_version} is newer than {MAX_READER}")
        if more := sorted(set(self.reader_features) - FEATURES):
            raise UnsupportedProtocol(f"unknown reader features: {', '.join(more)}")


@dataclass(frozen=True)
class Metadata:
    id: str | None
    schema_string: str
    partition_columns: tuple[str, ...]
    configuration: dict = field(default_factory=dict)
    name: str | None = None
    description: str | None = None
    created_time: int | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema_string))

    @property
    def mapping_mode(self) -> str:
        return self.configuration.get("delta.columnMapping.mode", "none")


@dataclass(frozen=True)
class Snapshot:
    """Immutable; files is lazy and its reconciliation runs on executors."""

    spark: SparkSession
    root: str
    version: int
    protocol: Protocol
    metadata: Metadata
    segment: log.LogSegment
    reconciled: DataFrame
    #: What was worked out from this version and need not be again.
    memo: dict = field(default_factory=dict, compare=False, repr=False)

    @property
    def schema(self) -> T.StructType:
        return self.metadata.schema

    @property
    def files(self) -> DataFrame:
        """Live files: path, partitionValues, size, modificationTime, stats, deletionVector, baseRowId."""
        return self.reconciled.where("add is not null").select("add.path", "add.partitionValues", "add.size", "add.modificationTime", "add.stats", "add.deletionVector", "add.baseRowId")

    @property
    def tombstones(self) -> DataFrame:
        return self.reconciled.where("remove is not null").select("remove.path", "remove.deletionTimestamp", "remove.deletionVector")

    @property
    def actions(self) -> DataFrame:
        """Every action of the log segment, unreconciled."""
        return log.actions(self.spark, self.segment)

    def scan_rows(self) -> DataFrame:
        """The reconciled list of files as a table."""
        return self.files.select("path", "size", "modificationTime", "stats", "deletionVector", F.struct("partitionValues", "baseRowId").alias("fileConstantValues"))

    def describe(self) -> DataFrame:
        p, m = self.protocol, self.metadata
        row = (self.version, p.min_reader_version, p.min_writer_version, list(p.reader_features), m.id, m.name, list(m.partition_columns), m.configuration, m.schema_string)
        return self.spark.createDataFrame(
            [row], "version long, min_reader_version int, min_writer_version int, reader_features array<string>, id string, name string, partition_columns array<string>, properties map<string, string>, schema_string string"
        )


def _dv_id(action: str):
    dv = F.col(f"{action}.deletionVector")
    return F.when(dv.isNull(), "").otherwise(F.concat(dv["storageType"], dv["pathOrInlineDv"], F.coalesce(F.concat(F.lit("@"), dv["offset"].cast("string")), F.lit(""))))


def reconcile(actions: DataFrame) -> DataFrame:
    """The newest action of each file and deletion vector; an add wins over a remove of the same version.

    One aggregation whose partial step runs before the shuffle; the key is the file, so no group grows with the table.
    """
    files = actions.where("add is not null or remove is not null").select(
        F.coalesce("add.path", "remove.path").alias("path"),
        F.when(F.col("add").isNotNull(), _dv_id("add")).otherwise(_dv_id("remove")).alias("dv"),
        F.struct("version", F.col("add").isNotNull().alias("is_add")).alias("at"),
        F.struct("add", "remove").alias("action"),
    )
    return files.groupBy("path", "dv").agg(F.max_by("action", "at").alias("action")).select("action.*")


def _newest(actions: DataFrame) -> tuple[Protocol | None, Metadata | None]:
    one = actions.where("protocol is not null or metaData is not null").agg(
        F.max_by("protocol", F.when(F.col("protocol").isNotNull(), F.col("version"))).alias("p"), F.max_by("metaData", F.when(F.col("metaData").isNotNull(), F.col("version"))).alias("m")
    )
    row = one.first()
    p = row.p and Protocol(row.p.minReaderVersion, row.p.minWriterVersion, tuple(row.p.readerFeatures or ()), tuple(row.p.writerFeatures or ()))
    m = row.m and Metadata(row.m.id, row.m.schemaString, tuple(row.m.partitionColumns or ()), dict(row.m.configuration or {}), row.m.name, row.m.description, row.m.createdTime)
    return p, m


def load(spark: SparkSession, url: str, version: int | None = None, seg: log.LogSegment | None = None) -> Snapshot:
    """The newest version, or the one asked for."""
    root = normalised(url)
    seg = seg or log.segment(Storage(spark), root, version)
    acts = log.actions(spark, seg)
    protocol, metadata = _newest(acts)
    if protocol is None or metadata is None:
        raise log.LogError(f"{root}: version {seg.version} has no protocol or no metadata")
    protocol.check()
    return Snapshot(spark, root, seg.version, protocol, metadata, seg, reconcile(acts))


def refresh(snapshot: Snapshot) -> Snapshot:
    """The newest version, reading only the commits that came since; the same object if none did."""
    new = log.tail_after(Storage(snapshot.spark), snapshot.root, snapshot.version)
    if not new:
        return snapshot
    fresh = log.read_commits(snapshot.spark, [p for _, p in new])
    protocol, metadata = _newest(fresh)
    protocol, metadata = protocol or snapshot.protocol, metadata or snapshot.metadata
    protocol.check()
    before = snapshot.reconciled.withColumn("version", F.lit(snapshot.version).cast("long"))
    rows = before.unionByName(fresh.select("add", "remove", "version"))
    seg = replace(snapshot.segment, version=new[-1][0], commits=(*snapshot.segment.commits, *(p for _, p in new)))
    return replace(snapshot, version=new[-1][0], protocol=protocol, metadata=metadata, segment=seg, reconciled=reconcile(rows), memo={})
