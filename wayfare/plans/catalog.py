"""Registered queries: one per operator key, each ``fn(spark, sf_dir) -> DataFrame``.

Every query reads the whole base tables through the adapters; nothing is
sampled or capped except where the cap is the feature (top-k reports, the
500-point sample). Where a float aggregate's last bits depend on summation
order, the compared column is rounded with ``stable`` on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import stable
from ..sources import adapters as A
from . import oracle as O

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, sql: str | None = None, recursive: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        text = O.with_adapters(sql) if sql else None
        REGISTRY[name] = (fn, text.replace("WITH ", "WITH RECURSIVE ", 1) if text and recursive else text)
        return fn
    return deco


def tables(spark, sf):
    return A.booking_tables(spark, sf)
