"""Catalogs: the service behind CREATE and DROP CATALOG, and the registry of tables that keep themselves up to date."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
import uuid
from typing import Protocol
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession

from . import snapshot as snapshots


class CatalogError(RuntimeError):
    """The catalog service refuses a request."""


class CatalogClient(Protocol):
    def create_catalog(self, name: str, *, comment: str | None = None, storage_root: str | None = None, provider: str | None = None, share: str | None = None, properties: dict | None = None) -> dict: ...

    def delete_catalog(self, name: str, force: bool = False) -> None: ...

    def get_catalog(self, name: str) -> dict | None: ...


class MemoryCatalogs:
    """Catalogs of one process, for work without a service."""

    def __init__(self):
        self.catalogs: dict[str, dict] = {}

    def create_catalog(self, name, *, comment=None, storage_root=None, provider=None, share=None, properties=None):
        if name in self.catalogs:
            raise CatalogError(f"catalog {name} exists already")
        info = {"name": name, "id": str(uuid.uuid4()), "created_at": int(time.time() * 1000)}
        info |= {k: v for k, v in (("comment", comment), ("storage_root", storage_root), ("provider_name", provider), ("share_name", share), ("properties", properties)) if v is not None}
        self.catalogs[name] = info
        return info

    def delete_catalog(self, name, force=False):
        if name not in self.catalogs:
            raise CatalogError(f"there is no catalog {name}")
        if self.catalogs[name].get("schemas") and not force:
            raise CatalogError(f"catalog {name} is not empty")
        del self.catalogs[name]

    def get_catalog(self, name):
        return self.catalogs.get(name)


class RestCatalogs:
    """The public REST interface of Unity Catalog."""

    def __init__(self, uri: str, token: str | None = None, timeout: float = 30.0):
        self.base = uri.rstrip("/")
        if not self.base.endswith("/unity-catalog"):
            self.base += "/api/2.1/unity-catalog"
        self.token, self.timeout = token, timeout

    def _call(self, method: str, path: str, body: dict | None = None) -> dict:
        request = urllib.request.Request(f"{self.base}/{path}", method=method, data=json.dumps(body).encode() if body is not None else None)
        request.add_header("Content-Type", "application/json")
        if self.token:
            request.add_header("Authorization", f"Bearer {self.token}")
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                return json.loads(answer.read() or b"{}")
        except urllib.error.HTTPError as e:
            raise CatalogError(f"{method} {path}: {e.code} {e.read().decode(errors='replace')[:500]}") from e

    def create_catalog(self, name, *, comment=None, storage_root=None, provider=None, share=None, properties=None):
        body = {"name": name, "comment": comment, "storage_root": storage_root, "provider_name": provider, "share_name": share, "properties": properties}
        return self._call("POST", "catalogs", {k: v for k, v in body.items() if v is not None})

    def delete_catalog(self, name, force=False):
        self._call("DELETE", f"catalogs/{quote(name, safe='')}?force={str(force).lower()}")

    def get_catalog(self, name):
        try:
            return self._call("GET", f"catalogs/{quote(name, safe='')}")
        except CatalogError as e:
            if ": 404 " in str(e):
                return None
            raise


class SchemaProvider:
    """Tables by name. A log-backed one is brought to its newest version each time it is asked for; other tables are
    DataFrames as they are."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._tables: dict[str, snapshots.Snapshot | DataFrame] = {}

    def register_delta(self, name: str, url: str) -> None:
        self._new(name)
        self._tables[name] = snapshots.load(self.spark, url)

    def register_table(self, name: str, table: DataFrame) -> None:
        self._new(name)
        self._tables[name] = table

    def _new(self, name: str) -> None:
        if name in self._tables:
            raise ValueError(f"table {name} exists already")

    def deregister_table(self, name: str):
        return self._tables.pop(name, None)

    def table_names(self) -> list[str]:
        return sorted(self._tables)

    def table_exist(self, name: str) -> bool:
        return name in self._tables

    def snapshot(self, name: str) -> snapshots.Snapshot | None:
        """The newest version of a log-backed table."""
        found = self._tables.get(name)
        if isinstance(found, snapshots.Snapshot):
            found = self._tables[name] = snapshots.refresh(found)
            return found
        return None

    def table(self, name: str) -> DataFrame | None:
        from ..plans.scan import scan

        fresh = self.snapshot(name)
        return scan(fresh) if fresh is not None else self._tables.get(name)
