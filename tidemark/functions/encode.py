"""Stable hashes, canonical JSON and id lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_sha256(value: Column) -> Column:
    return F.sha2(value.cast("string"), 256)


def canonical_json(columns: Iterable[str]) -> Column:
    """JSON object with its keys in sorted order; NULL fields are written as null."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def canonical_map_json(value: Column) -> Column:
    """JSON object of a map column, keys in sorted order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(value))))


def content_key(document: Column, length: int = 16) -> Column:
    """Leading hex digits of the SHA-256 of a document."""
    return F.substring(text_sha256(document), 1, length)


def run_id(*parts: Column, length: int = 32) -> Column:
    """Identity of a model run from its parts, joined with a bar."""
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, length)


def split_ids(value: Column) -> Column:
    """List of ids from text separated by ``;``, ``,`` or ``|``; blanks are dropped."""
    parts = F.transform(F.split(value, r"[;,|]+"), lambda part: F.trim(part))
    return F.coalesce(F.filter(parts, lambda part: part != ""), F.array().cast("array<string>"))
