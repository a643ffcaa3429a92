"""What the operators of this subpackage share: scratch tables, arrow passes, row keys."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes of what a function of arrow_map is given at a time; a longer row comes alone. Spark itself hands over
#: batches of spark.sql.execution.arrow.maxBytesPerBatch (64 MB) at most.
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20
#: How scratch tables are written: a job's shuffle files go when the job has ended, not when the driver happens to collect
#: its garbage; and small partitions are merged, as each makes a file.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, spark.checkpoint.dir. Only a local session may lack that setting, as all runs on
    one machine there: it gets a folder that goes when the process ends."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="tarn-")
        atexit.register(shutil.rmtree, at, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", at)
    return at


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]):
    """The settings hold inside; then the session has again what it had."""
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


#: Scratch tables written by this process.
_written: list[str] = []


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it again: lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    with _set(spark, _WRITING):
        df.write.parquet(path)
    _written.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tarn_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def drop(*tables: DataFrame) -> None:
    """Delete scratch tables that cut gave, once nothing reads them any more."""
    for df in tables:
        _delete(df.sparkSession, df._tarn_path)
        _written.remove(df._tarn_path)


def clear(spark: SparkSession) -> None:
    """Delete the scratch tables of this process, once no result that reads them is needed any more."""
    while _written:
        _delete(spark, _written.pop())


def sliced(batches, most: int = BATCH_BYTES):
    """The batches in slices of BATCH_ROWS rows and so many bytes at most, without copying; a longer row is a slice."""
    for batch in batches:
        if not batch.num_rows:
            yield batch
        todo = [batch.slice(a, BATCH_ROWS) for a in range(0, batch.num_rows, BATCH_ROWS)][::-1]
        while todo:
            part = todo.pop()
            if part.num_rows > 1 and part.nbytes > most:
                half = part.num_rows // 2
                todo += (part.slice(half), part.slice(0, half))
            else:
                yield part


def arrow_map(df: DataFrame, fn, schema: str | T.StructType) -> DataFrame:
    """mapInArrow for a function of an iterator of batches that yields dicts of columns or batches."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(kind)

    def run(batches):
        for out in fn(sliced(batches)):
            if isinstance(out, dict):
                out = pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type, from_pandas=False) for f in arrow], schema=arrow)
            yield out

    return df.mapInArrow(run, kind)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_key(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text_hash, text. Two rows with one doc_id are told apart by their text; equal rows have equal results."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text", *more)


def zipped(keyed: DataFrame) -> DataFrame:
    """doc_id, text_hash, ztext: texts that are dealt out travel compressed."""

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [(x or "").encode() for x in batch.column("text").to_pylist()]
            yield {"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "ztext": [squeeze.compress(x) for x in texts]}

    return arrow_map(keyed, run, "doc_id long, text_hash long, ztext binary")


def same_row(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name
