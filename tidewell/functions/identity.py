"""Identities and hashes that name runs, batches and contents."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidewell.functions.columns import record_hash

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*\Z")
#: Words that name a credential, also as the end of a longer name (db_password, PGPASSWORD).
_SECRET_NAMES = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key")
_HIDDEN = "[REDACTED]"
_NAMED = re.compile(
    rf"""(?P<name>[\w.-]*(?:{"|".join(_SECRET_NAMES)})["']?\s*[=:]\s*)(?P<value>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|\{{[^}}]*\}}|[^\s;,&]+)""",
    re.IGNORECASE | re.VERBOSE,
)
_USER_INFO = re.compile(r"(?P<scheme>[A-Za-z][A-Za-z0-9+.-]*://[^\s:/@]*):[^\s/]+@")


def new_id() -> str:
    return uuid.uuid4().hex


def batch_id(table: str, key: str, low: Any, high: Any, snapshot: str) -> str:
    """The same batch of the same snapshot has the same id in every run."""
    return hashlib.sha256("\x1f".join(str(x) for x in (table, key, low, high, snapshot)).encode()).hexdigest()


def table_batch_id(run_id: str, load_id: str, source: str, target: str) -> str:
    return hashlib.sha256(f"{run_id}:{load_id}:{source}:{target}".encode()).hexdigest()


def _digest(columns: list[str], row: Row) -> str:
    return hashlib.sha256(f"{sorted(columns)}:{row['n']}:{row['x']}:{row['s']}".encode()).hexdigest()


def _bag(columns: list[str]) -> list[Column]:
    h = F.xxhash64(record_hash(columns))
    return [F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(38,0)")).alias("s")]


def content_hash(df: DataFrame) -> str:
    """A hash of the rows as a bag: their order and partitions don't matter, their number does."""
    return _digest(df.columns, df.agg(*_bag(df.columns)).first())


def content_hashes(df: DataFrame, by: str) -> dict[Any, tuple[str, int]]:
    """Per value of a column, the hash of the rows without it, and their number; from one aggregate."""
    columns = [c for c in df.columns if c != by]
    return {row[by]: (_digest(columns, row), row["n"]) for row in df.groupBy(by).agg(*_bag(columns)).collect()}


def safe_name(name: str) -> str:
    if not _NAME.match(name):
        raise ValueError(f"not a safe name: {name!r}")
    return name


def redact(message: object, secrets: Iterable[str] = ()) -> str:
    """The message without the secrets given, the values of credential names (bare, quoted or in braces)
    and the passwords in URLs."""
    text = str(message)
    for secret in sorted(filter(None, secrets), key=len, reverse=True):
        text = text.replace(secret, _HIDDEN)
    text = _USER_INFO.sub(lambda m: f"{m['scheme']}:{_HIDDEN}@", text)
    return _NAMED.sub(lambda m: f"{m['name']}{_HIDDEN}", text)
