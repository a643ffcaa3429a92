"""Writing commits: a file of JSON actions that must not exist yet, so one writer of a version wins."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .log import ACTIONS, LOG_DIR, actions, segment
from .snapshot import reconcile
from .storage import FileAlreadyExists, Storage


def commit_path(root: str, version: int) -> str:
    return f"{root}/{LOG_DIR}/{version:020d}.json"


def _lines(rows: DataFrame) -> list[str]:
    return [r[0] for r in rows.select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in rows.columns)))).collect()]


def write_json_file(spark: SparkSession, path: str, rows: DataFrame | list[dict], overwrite: bool = False) -> None:
    """A JSON object a line. rows of a DataFrame are collected: a commit is small and written at once."""
    lines = _lines(rows) if isinstance(rows, DataFrame) else [json.dumps(r, separators=(",", ":")) for r in rows]
    Storage(spark).write(path, "".join(x + "\n" for x in lines).encode(), overwrite)


def write_commit(spark: SparkSession, root: str, version: int, rows: list[dict]) -> None:
    """Fails with FileAlreadyExists if another writer has written this version."""
    write_json_file(spark, commit_path(root, version), rows)


def write_checkpoint(spark: SparkSession, root: str, version: int, parts: int = 1, v2: bool = False) -> list[str]:
    """The reconciled state of a version as a checkpoint: one file, several, or a JSON file with Parquet sidecars.

    Written beside the log by executors and renamed into it by the driver; _last_checkpoint comes last.
    """
    storage, folder = Storage(spark), f"{root}/{LOG_DIR}"
    acts = actions(spark, segment(storage, root, version))
    newest = lambda c: acts.where(F.col(c).isNotNull()).orderBy(F.desc("version")).limit(1).select(c)
    one = newest("protocol").unionByName(newest("metaData"), allowMissingColumns=True)
    txn = acts.where("txn is not null").groupBy("txn.appId").agg(F.max_by("txn", "version").alias("txn")).select("txn")
    one = one.unionByName(txn, allowMissingColumns=True)
    files = reconcile(acts)

    def stored(df, n, name):
        full = df.select(*(F.col(c) if c in df.columns else F.lit(None).cast(ACTIONS[c].dataType).alias(c) for c in ACTIONS.names if c != "commitInfo"))
        at = f"{folder}/_tmp-{uuid.uuid4().hex}"
        full.repartition(n).write.parquet(at)
        made = [f.path for f in storage.list(at) if f.name.endswith(".parquet")]
        to = [f"{folder}/{name(i)}" for i in range(1, len(made) + 1)]
        for a, b in zip(made, to, strict=True):
            storage.rename(a, b)
        storage.drop(at)
        return to

    if v2:
        sidecars = stored(files, parts, lambda i: f"_sidecars/{uuid.uuid4()}.parquet")
        rows = [json.loads(x) for x in _lines(one)]
        rows += [{"checkpointMetadata": {"version": version}}]
        rows += [{"sidecar": {"path": p.rsplit("/", 1)[-1], "sizeInBytes": 0, "modificationTime": 0}} for p in sidecars]
        out = [f"{folder}/{version:020d}.checkpoint.{uuid.uuid4()}.json"]
        write_json_file(spark, out[0], rows)
    else:
        every = files.unionByName(one, allowMissingColumns=True)
        out = stored(every, parts, lambda i: f"{version:020d}.checkpoint" + (f".{i:010d}.{parts:010d}" if parts > 1 else "") + ".parquet")
    storage.write(f"{folder}/_last_checkpoint", json.dumps({"version": version, "size": -1}).encode(), True)
    return out


__all__ = ["FileAlreadyExists", "commit_path", "write_checkpoint", "write_commit", "write_json_file"]
