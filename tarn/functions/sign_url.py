"""sign_storage_url: links with which anyone may read an object for an hour."""

from __future__ import annotations

import base64
import hashlib
import hmac
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from urllib.parse import quote, unquote, urlsplit

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAME = "sign_storage_url"
LIFETIME_S = 3600


class CannotSign(ValueError):
    """There is no signer for a URL's store."""


def _hmac(key: bytes, text: str) -> bytes:
    return hmac.new(key, text.encode(), hashlib.sha256).digest()


def _query_signed(url, key_id, secret, region, now, algorithm, prefix, service, end, host, path, token=None, lifetime=LIFETIME_S):
    """Version 4 signatures in a URL's query, of S3 and of Google's XML interface."""
    day, stamp = now.strftime("%Y%m%d"), now.strftime("%Y%m%dT%H%M%SZ")
    scope = f"{day}/{region}/{service}/{end}"
    fields = {f"X-{prefix}-Algorithm": algorithm, f"X-{prefix}-Credential": f"{key_id}/{scope}", f"X-{prefix}-Date": stamp, f"X-{prefix}-Expires": str(lifetime), f"X-{prefix}-SignedHeaders": "host"}
    if token:
        fields[f"X-{prefix}-Security-Token"] = token
    query = "&".join(f"{quote(k, safe='-_.~')}={quote(v, safe='-_.~')}" for k, v in sorted(fields.items()))
    request = f"GET\n{path}\n{query}\nhost:{host}\n\nhost\nUNSIGNED-PAYLOAD"
    text = f"{algorithm}\n{stamp}\n{scope}\n{hashlib.sha256(request.encode()).hexdigest()}"
    key = f"{'AWS4' if prefix == 'Amz' else 'GOOG4'}{secret}".encode()
    for part in (day, region, service, end):
        key = _hmac(key, part)
    return f"https://{host}{path}?{query}&X-{prefix}-Signature={_hmac(key, text).hex()}"


def s3_signer(key_id: str, secret: str, region: str = "us-east-1", token: str | None = None, clock=lambda: datetime.now(timezone.utc)) -> Callable[[str], str]:
    def sign(url: str) -> str:
        parts = urlsplit(url)
        host, path = f"{parts.netloc}.s3.{region}.amazonaws.com", quote(unquote(parts.path) or "/", safe="/-_.~")
        return _query_signed(url, key_id, secret, region, clock(), "AWS4-HMAC-SHA256", "Amz", "s3", "aws4_request", host, path, token)

    return sign


def gcs_signer(key_id: str, secret: str, clock=lambda: datetime.now(timezone.utc)) -> Callable[[str], str]:
    def sign(url: str) -> str:
        parts = urlsplit(url)
        host, path = "storage.googleapis.com", f"/{parts.netloc}{quote(unquote(parts.path), safe='/-_.~')}"
        return _query_signed(url, key_id, secret, "auto", clock(), "GOOG4-HMAC-SHA256", "Goog", "storage", "goog4_request", host, path)

    return sign


def azure_signer(account: str, key: str, clock=lambda: datetime.now(timezone.utc)) -> Callable[[str], str]:
    """A shared access signature for one blob, of service version 2020-12-06."""

    def sign(url: str) -> str:
        parts = urlsplit(url)
        container = parts.username or parts.netloc.split("@")[0]
        blob = unquote(parts.path).lstrip("/")
        start, end = (t.strftime("%Y-%m-%dT%H:%M:%SZ") for t in (clock(), clock() + timedelta(seconds=LIFETIME_S)))
        fields = ["r", start, end, f"/blob/{account}/{container}/{blob}", "", "", "https", "2020-12-06", "b", "", "", "", "", "", "", ""]
        signature = base64.b64encode(hmac.new(base64.b64decode(key), "\n".join(fields).encode(), hashlib.sha256).digest()).decode()
        query = {"sp": "r", "st": start, "se": end, "spr": "https", "sv": "2020-12-06", "sr": "b", "sig": signature}
        return f"https://{account}.blob.core.windows.net/{container}/{quote(blob)}?" + "&".join(f"{k}={quote(v, safe='')}" for k, v in query.items())

    return sign


def plain(url: str) -> str:
    return url


#: Stores whose objects need no signature.
DEFAULT_SIGNERS: dict[str, Callable[[str], str]] = {"file": plain, "memory": plain}


def signed(url: str | None, signers: dict[str, Callable[[str], str]]) -> str | None:
    """NULL for NULL and for what is no URL; an error for a store without a signer."""
    if url is None:
        return None
    try:
        parts = urlsplit(url)
    except ValueError:
        return None
    if not parts.scheme or "://" not in url or " " in parts.netloc:
        return None
    signer = signers.get(parts.scheme)
    if signer is None:
        raise CannotSign(f"no signer for {parts.scheme}://")
    return signer(url)


def function(signers: dict[str, Callable[[str], str]] | None = None):
    """A vectorised function that is never folded or reused, as a link depends on when it is made."""
    known = DEFAULT_SIGNERS | (signers or {})

    def sign_storage_url(urls: pd.Series) -> pd.Series:
        return urls.map(lambda u: signed(None if pd.isna(u) else u, known))

    return F.pandas_udf(sign_storage_url, T.StringType()).asNondeterministic()


def register(spark: SparkSession, signers=None) -> None:
    spark.udf.register(NAME, function(signers))
