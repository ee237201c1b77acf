"""Registered queries of the corpus operators, each with its check SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = lambda spark, sf_dir: build(prepare(spark), sf_dir)
        if sql is not None:
            CHECKS[name] = sql
        return build

    return register
