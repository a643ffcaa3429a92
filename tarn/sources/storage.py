"""File access through the Hadoop file system of the session, so that every store Spark reads can be used."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote, urlsplit

from pyspark.errors.exceptions.base import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LISTING = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("length", T.LongType()),
        T.StructField("is_dir", T.BooleanType(), False),
        T.StructField("modification_time", T.TimestampType()),
    ]
)


class FileAlreadyExists(PySparkException, FileExistsError):
    """A file that must not be there is there."""


@dataclass(frozen=True)
class FileInfo:
    path: str
    length: int | None
    is_dir: bool
    modified_ms: int | None

    @property
    def name(self) -> str:
        return self.path.rstrip("/").rsplit("/", 1)[-1]


class Storage:
    """Paths are plain strings as Hadoop's Path takes them (not URI-encoded)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._jvm = spark._jvm

    def _at(self, path: str):
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def exists(self, path: str) -> bool:
        at, fs = self._at(path)
        return fs.exists(at)

    def list(self, path: str) -> list[FileInfo]:
        """One level; nothing for a folder that is not there. Sorted by path."""
        at, fs = self._at(path)
        if not fs.exists(at):
            return []
        found = [FileInfo(s.getPath().toString(), None if s.isDirectory() else s.getLen(), s.isDirectory(), None if s.isDirectory() else s.getModificationTime()) for s in fs.listStatus(at)]
        return sorted(found, key=lambda x: x.path)

    def list_from(self, path: str, start: str = "") -> list[FileInfo]:
        """Files of one folder whose names come after start, in order."""
        return [x for x in self.list(path) if not x.is_dir and x.name > start]

    def walk(self, path: str) -> Iterator[FileInfo]:
        at, fs = self._at(path)
        if not fs.exists(at):
            return
        files = fs.listFiles(at, True)
        while files.hasNext():
            s = files.next()
            yield FileInfo(s.getPath().toString(), s.getLen(), False, s.getModificationTime())

    def read(self, path: str, start: int = 0, end: int | None = None) -> bytes:
        """The bytes of a range."""
        at, fs = self._at(path)
        end = fs.getFileStatus(at).getLen() if end is None else end
        stream = fs.open(at)
        try:
            stream.seek(start)
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, end - start))
        finally:
            stream.close()

    def read_files(self, ranges: list[tuple[str, tuple[int, int] | None]]) -> list[bytes]:
        return [self.read(path, *(r or ())) for path, r in ranges]

    def write(self, path: str, data: bytes, overwrite: bool = False) -> None:
        """All at once; without overwrite the file must not exist."""
        at, fs = self._at(path)
        try:
            stream = fs.create(at, overwrite)
        except Exception as e:
            if "FileAlreadyExists" in str(e) or "already exists" in str(e):
                raise FileAlreadyExists(f"{path} exists already") from None
            raise
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()

    def delete(self, path: str) -> bool:
        at, fs = self._at(path)
        return fs.delete(at, False)

    def rename(self, path: str, to: str) -> None:
        at, fs = self._at(path)
        if not fs.rename(at, self._at(to)[0]):
            raise OSError(f"{path} could not become {to}")

    def drop(self, path: str) -> bool:
        """A file, or a folder and all in it."""
        at, fs = self._at(path)
        return fs.delete(at, True)

    def modified(self, path: str, when_ms: int) -> None:
        at, fs = self._at(path)
        fs.setTimes(at, when_ms, -1)

    def qualified(self, path: str) -> str:
        at, fs = self._at(path)
        return at.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()

    def listing(self, path: str, recursive: bool = False) -> DataFrame:
        """path, length, is_dir, modification_time of a folder; folders have neither length nor time."""
        from datetime import datetime, timezone

        found = self.walk(path) if recursive else self.list(path)
        rows = [(x.path, x.length, x.is_dir, None if x.modified_ms is None else datetime.fromtimestamp(x.modified_ms / 1000, timezone.utc)) for x in found]
        return self.spark.createDataFrame(rows, LISTING)


def normalised(url: str) -> str:
    """A table's address without trailing slashes; a file URL becomes a path."""
    parts = urlsplit(url)
    if parts.scheme == "file":
        url = unquote(parts.path)
    return url.rstrip("/") or "/"


def resolved(root: str, path: str) -> str:
    """A log entry's path, which is URI-encoded and relative to the table unless it has a scheme or starts at the root."""
    parts = urlsplit(path)
    if parts.scheme and len(parts.scheme) > 1:
        return unquote(parts.path) if parts.scheme == "file" else unquote(path)
    plain = unquote(path)
    return plain if plain.startswith("/") else f"{root}/{plain}"


def glob_safe(path: str) -> str:
    """For readers that expand glob signs."""
    return "".join("\\" + c if c in "*?[]{}\\" else c for c in path)


def spellings(path: str) -> list[str]:
    """As _metadata.file_path may have it: local files are file:/x or file:///x, depending on how a path was given."""
    uri = uri_of(path)
    return [uri, "file:" + uri[7:]] if uri.startswith("file:///") else [uri]


def uri_of(path: str) -> str:
    parts = urlsplit(path)
    if parts.scheme and len(parts.scheme) > 1:
        return f"{parts.scheme}://{parts.netloc}{quote(path.split(parts.netloc, 1)[1] if parts.netloc else parts.path, safe=_PATH)}"
    return "file://" + quote(path, safe=_PATH)


#: Signs that a path component keeps when Java writes it as a URI.
_PATH = "/:@!$&'()*+,;=~-._"


def workspace(spark: SparkSession) -> str:
    """A folder that all executors share: spark.checkpoint.dir, or a temporary one of a local session."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        import tempfile

        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="tarn-")
        spark.conf.set("spark.checkpoint.dir", at)
    return normalised(at)
