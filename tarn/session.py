"""A Spark session with lakehouse tables, the SQL extension and its configuration.

Configuration keys, each under spark.lakehouse.: unity.uri, unity.token, delta.enable_caching (false),
delta.retention_duration_check.enabled (true). Names may be in camel case too.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import compat, sign_url
from .operators import insert, vacuum
from .plans import predicate, scan, sqlext
from .sources import catalog, log, snapshot
from .sources.storage import Storage, normalised

PREFIX = "spark.lakehouse."
DEFAULTS = {"delta.enable_caching": "false", "delta.retention_duration_check.enabled": "true"}
#: Table versions a session remembers.
SNAPSHOTS = 64
CREATED = T.StructType([T.StructField(n, T.StringType(), False) for n in ("securable_name", "securable_type", "securable_object")])
DROPPED = T.StructType([T.StructField(n, T.StringType(), False) for n in ("securable_name", "securable_type", "status")])


class LakehouseSession:
    """Wraps a session; wrapping one again gives the same object, with its tables."""

    def __new__(cls, spark: SparkSession, **options):
        held = getattr(spark, "_tarn_session", None)
        if held is None:
            held = super().__new__(cls)
            held._start(spark)
            spark._tarn_session = held
        held._options(**options)
        return held

    def _start(self, spark: SparkSession) -> None:
        self.spark = spark
        self.schema = catalog.SchemaProvider(spark)
        self._client: catalog.CatalogClient | None = None
        self._given: catalog.CatalogClient | None = None
        self._credentials: Callable[[str], dict] | None = None
        self._snapshots: dict[log.LogSegment, snapshot.Snapshot] = {}
        #: Views that stay at a version, their rows, and which object of Spark's each is.
        self._views: dict[str, tuple[snapshot.Snapshot, DataFrame, int]] = {}
        sign_url.register(spark)

    def _options(self, catalog_client=None, credentials: Callable[[str], dict] | None = None, signers=None, compatibility: bool = False) -> None:
        """credentials: Hadoop settings for a URL, asked for before a table is opened."""
        if catalog_client is not None:
            self._given, self._client = catalog_client, None
        if credentials is not None:
            self._credentials = credentials
        if signers is not None:
            sign_url.register(self.spark, signers)
        if compatibility:
            compat.register(self.spark)

    def conf(self, key: str) -> str | None:
        camel = re.sub(r"_(.)", lambda m: m[1].upper(), key)
        return self.spark.conf.get(PREFIX + key, self.spark.conf.get(PREFIX + camel, DEFAULTS.get(key)))

    @property
    def client(self) -> catalog.CatalogClient:
        """The client given, else one for the configured service, with a token if there is one."""
        if self._client is None:
            uri = self.conf("unity.uri")
            if self._given is None and not uri:
                raise catalog.CatalogError("no catalog client: set spark.lakehouse.unity.uri or give one")
            self._client = self._given or catalog.RestCatalogs(uri, self.conf("unity.token"))
        return self._client

    def _open(self, url: str) -> str:
        for key, value in (self._credentials(url) if self._credentials else {}).items():
            self.spark.conf.set(key, value)
        return url

    def snapshot(self, url: str, version: int | None = None) -> snapshot.Snapshot:
        """The log is listed each time; a version whose log files are the same as before is not read again."""
        root = normalised(self._open(url))
        seg = log.segment(Storage(self.spark), root, version)
        found = self._snapshots.pop(seg, None)
        if found is None:
            found = snapshot.load(self.spark, root, version, seg)
            if self.conf("delta.enable_caching") == "true":
                found.reconciled.cache()
        self._snapshots[seg] = found
        while len(self._snapshots) > SNAPSHOTS:
            del self._snapshots[next(iter(self._snapshots))]
        return found

    def read(self, url: str, version: int | None = None, where: str | predicate.Expr | None = None, columns: list[str] | None = None) -> DataFrame:
        """A version's rows; where (Spark SQL or an expression) also skips files."""
        if isinstance(where, str):
            where = predicate.parse(self.spark, where)
        return scan.scan(self.snapshot(url, version), where, columns)

    def log_actions(self, url: str, version: int | None = None) -> DataFrame:
        return self.snapshot(url, version).actions

    def live_files(self, url: str, version: int | None = None) -> DataFrame:
        return self.snapshot(url, version).scan_rows()

    def register(self, name: str, url: str, version: int | None = None) -> DataFrame:
        """A view of one version, which stays that version. In statements given to sql, its filters also skip files."""
        found = self.snapshot(url, version)
        if name in self._views and self._views[name][0] is found and self._is_ours(name):
            return self._views[name][1]
        return self._viewed(name, found, scan.scan(found))

    def _viewed(self, name: str, found: snapshot.Snapshot, df: DataFrame) -> DataFrame:
        df.createOrReplaceTempView(name)
        self._views[name] = (found, df, self._view_id(name))
        return df

    def register_delta(self, name: str, url: str) -> None:
        """A table that SQL sees at its newest version."""
        self.schema.register_delta(name, self._open(url))

    def sql(self, text: str, **kwargs) -> DataFrame:
        """One statement: the extension's are carried out here and now, others are Spark's."""
        statement = sqlext.parse_one(text)
        if isinstance(statement, sqlext.Vacuum):
            return self._vacuum(statement)
        if isinstance(statement, sqlext.CreateCatalog):
            return self._create(statement)
        if isinstance(statement, sqlext.DropCatalog):
            return self._drop(statement)
        if isinstance(statement, sqlext.CreateExternalTable):
            return self._external(statement)
        if isinstance(statement, sqlext.Insert):
            return self._insert(statement, **kwargs)
        if isinstance(statement, sqlext.Copy):
            df = self._host(statement.source)
            df.write.format(statement.format).options(**dict(statement.options)).mode("overwrite").save(statement.target)
            count = self.spark.read.format(statement.format).options(**dict(statement.options)).load(statement.target).count()
            return self.spark.createDataFrame([(count,)], "count long")
        return self._host(statement.text, **kwargs)

    def _host(self, text: str, **kwargs) -> DataFrame:
        text = compat.expanded(text)
        words = {t.text.lower() for t in sqlext.tokens(text) if t.kind in ("word", "quoted")}
        tables: dict[str, snapshot.Snapshot] = {}
        for name in self.schema.table_names():
            if name.lower() in words:
                fresh = self.schema.snapshot(name)
                if fresh is None:
                    self.schema.table(name).createOrReplaceTempView(name)
                else:
                    tables[name] = fresh
        lasting = {}
        for name, (found, df, _) in self._views.items():
            if name.lower() in words and self._is_ours(name):
                tables[name], lasting[name] = found, df
        if not tables:
            return self.spark.sql(text, **kwargs)
        if not predicate.is_query(self.spark, text):
            # what a command makes may read the tables later, so they stay
            for name, found in tables.items():
                if name not in lasting:
                    scan.scan(found).createOrReplaceTempView(name)
            return self.spark.sql(text, **kwargs)
        whole = set()
        try:
            # the plan over stand-ins tells the filters; the scans of the files that they leave take their place
            marks = {name: f"{name}-{i}" for i, name in enumerate(tables)}
            for name, found in tables.items():
                scan.stub(found, marks[name]).createOrReplaceTempView(name)
            filters = predicate.filters_of(self.spark.sql(text, **kwargs))
            for name, found in tables.items():
                files = scan.chosen(found, filters.get(marks[name]))
                if name in lasting and len(files) == len(scan.chosen(found)):
                    self._viewed(name, found, lasting[name])
                    whole.add(name)
                else:
                    scan.scan(found, files=files).createOrReplaceTempView(name)
            return self.spark.sql(text, **kwargs)
        finally:
            for name in tables.keys() - whole:
                if name in lasting:
                    self._viewed(name, tables[name], lasting[name])
                else:
                    self.spark.catalog.dropTempView(name)

    def _view_id(self, name: str) -> int | None:
        view = self.spark._jsparkSession.sessionState().catalog().getRawTempView(name)
        return self.spark._jvm.System.identityHashCode(view.get()) if view.isDefined() else None

    def _is_ours(self, name: str) -> bool:
        """Whether the view of this name is still the one that register made."""
        return self._view_id(name) == self._views[name][2]

    def _insert(self, s: sqlext.Insert, **kwargs) -> DataFrame:
        """Appends to a table that follows its log; others are Spark's. The number of rows, as the log has it."""
        name = ".".join(s.name)
        found = self.schema.snapshot(name)
        if found is None:
            return self._host(s.text, **kwargs)
        rows = insert.fitted(found, self._host(s.source, **kwargs), s.columns)
        after = insert.append(found, rows)
        if after is found:
            return self.spark.createDataFrame([(0,)], "count long")
        added = after.files.join(found.files, "path", "left_anti")
        return self.spark.createDataFrame([(added.agg(F.sum(F.get_json_object("stats", "$.numRecords").cast("long"))).first()[0],)], "count long")

    def _external(self, s: sqlext.CreateExternalTable) -> DataFrame:
        if not (s.if_not_exists and self.spark.catalog.tableExists(s.name)):
            options = dict(s.options)
            if s.format == "csv":
                options.setdefault("inferSchema", "true")
            self.spark.read.format(s.format).options(**options).load(s.location).createOrReplaceTempView(s.name)
        return self.spark.createDataFrame([], "result string")

    def _vacuum(self, s: sqlext.Vacuum) -> DataFrame:
        name = ".".join(s.name)
        found = None if s.is_path else self.schema.snapshot(name)
        if found is None:
            if not s.is_path and "/" not in name and "://" not in name:
                raise sqlext.SqlError(f"there is no table {name}")
            found = self.snapshot(name)
        check = self.conf("delta.retention_duration_check.enabled") == "true"
        return vacuum.run(vacuum.plan(found, s.mode, s.retention_hours, s.dry_run, check))

    def _create(self, s: sqlext.CreateCatalog) -> DataFrame:
        info = self.client.get_catalog(s.name) if s.if_not_exists else None
        if info is None:
            properties = dict(s.options or ())
            if s.default_collation:
                properties["default_collation"] = s.default_collation
            provider, share = s.share or (None, None)
            info = self.client.create_catalog(s.name, comment=s.comment, storage_root=s.managed_location, provider=provider, share=share, properties=properties or None)
        return self.spark.createDataFrame([(s.name, "CATALOG", json.dumps(info, sort_keys=True))], CREATED)

    def _drop(self, s: sqlext.DropCatalog) -> DataFrame:
        if s.if_exists and self.client.get_catalog(s.name) is None:
            return self.spark.createDataFrame([(s.name, "CATALOG", "NOT FOUND")], DROPPED)
        self.client.delete_catalog(s.name, force=s.cascade)
        return self.spark.createDataFrame([(s.name, "CATALOG", "DROPPED")], DROPPED)
