"""Checked publication of cleaned tables: one scan per raw table.

Each table is written once to the run's own folder, split into clean rows and
quarantined ones (with the reasons). Row counts before and after and the number of
bad rows per rule are *observed* on that write, so checking costs no other scan.
Only when all required rules hold is the run published, by a marker row written
last; readers follow the newest marker. A failed or interrupted run leaves a folder
that nobody reads.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import DataQualityError

MARKER = "seq long, run string"
REPORT = "run string, table string, check string, passed boolean, bad_rows long, rows_before long, rows_after long"


@dataclass
class Rule:
    """Rows for which ``bad`` holds break the rule. ``required``: one such row
    stops the run; ``drops``: such rows go to the quarantine table."""

    name: str
    bad: Column
    required: bool = False
    drops: bool = False


@dataclass
class Source:
    """A raw table, its rules, and the name of the check that it has rows (if it must)."""

    table: DataFrame
    rules: list[Rule]
    not_empty: str | None = None


def staged_write(name: str, source: Source, folder: str) -> dict[str, int]:
    """Writes clean and quarantined rows under ``folder/name``; the observed counts."""
    reasons = F.array_compact(F.array(*[F.when(F.coalesce(r.bad, F.lit(True)), F.lit(r.name)) for r in source.rules if r.drops],
                                      F.lit(None).cast("string")))
    seen = Observation(name)
    rows = source.table.withColumn("_reasons", reasons)
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows_before"), F.count_if(F.size("_reasons") == 0).alias("rows_after"),
                        *[F.count_if(F.coalesce(r.bad, F.lit(True))).alias(f"bad_{k}") for k, r in enumerate(source.rules)])
    status = F.when(F.size("_reasons") == 0, "clean").otherwise("quarantine")
    rows.withColumn("_status", status).write.mode("overwrite").partitionBy("_status").parquet(f"{folder}/{name}_processed")
    return seen.get


def checks_of(name: str, source: Source, got: dict[str, int], run: str) -> list[tuple]:
    out = []
    if source.not_empty:
        out.append((run, name, source.not_empty, got["rows_before"] > 0, int(got["rows_before"] == 0), got["rows_before"], got["rows_after"]))
    for k, r in enumerate(source.rules):
        bad = got[f"bad_{k}"]
        out.append((run, name, r.name, bad == 0, bad, got["rows_before"], got["rows_after"]))
    return out


def publish(spark: SparkSession, sources: dict[str, Source], out_dir: str, run: str | None = None) -> tuple[DataFrame, bool]:
    """(report, published): stages all tables, then the marker if every required rule holds."""
    run = run or uuid.uuid4().hex
    folder = f"{out_dir}/{run}"
    with ThreadPoolExecutor(max_workers=len(sources)) as ex:
        got = dict(zip(sources, ex.map(lambda n: staged_write(n, sources[n], folder), sources)))
    rows = [c for n, s in sources.items() for c in checks_of(n, s, got[n], run)]
    required = {(n, r.name) for n, s in sources.items() for r in s.rules if r.required} | {(n, s.not_empty) for n, s in sources.items()}
    good = all(passed for _, n, check, passed, *_ in rows if (n, check) in required)
    report = spark.createDataFrame(rows, REPORT)
    report.coalesce(1).write.mode("overwrite").parquet(f"{folder}/checks")
    if good:
        last = newest(spark, out_dir)
        spark.createDataFrame([((last[0] if last else 0) + 1, run)], MARKER).coalesce(1).write.mode("append").parquet(f"{out_dir}/published")
    return report, good


def raise_unless(report: DataFrame, published: bool) -> None:
    if not published:
        failed = report.where("NOT passed").orderBy("table", "check").collect()
        raise DataQualityError("Data validation failed: " + ", ".join(f"{r['table']}.{r['check']} ({r['bad_rows']} bad)" for r in failed))


def newest(spark: SparkSession, out_dir: str) -> tuple[int, str] | None:
    """(number, run) of the newest marker."""
    from pyspark.errors import AnalysisException
    try:
        row = spark.read.schema(MARKER).parquet(f"{out_dir}/published").orderBy(F.desc("seq"), F.desc("run")).first()
    except AnalysisException:  # nothing published yet
        return None
    return (row["seq"], row["run"]) if row else None


def read_published(spark: SparkSession, out_dir: str, name: str, schema: T.StructType, status: str = "clean") -> DataFrame:
    """A table of the newest published run: its clean rows, or the quarantined ones with ``_reasons``."""
    last = newest(spark, out_dir)
    if last is None:
        raise ValueError(f"nothing is published in {out_dir}")
    return read_run(spark, f"{out_dir}/{last[1]}", name, schema, status)


def read_run(spark: SparkSession, folder: str, name: str, schema: T.StructType, status: str) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField("_reasons", T.ArrayType(T.StringType())), T.StructField("_status", T.StringType())])
    rows = spark.read.schema(full).parquet(f"{folder}/{name}_processed").where(F.col("_status") == status)
    return rows.drop("_status", "_reasons") if status == "clean" else rows.drop("_status")


def booking_sources(users: DataFrame, flights: DataFrame, hotels: DataFrame) -> dict[str, Source]:
    """The daily job's tables with its rules."""
    null = lambda *cs: F.lit(False) if not cs else F.col(cs[0]).isNull() | null(*cs[1:])
    bad = lambda c: ~F.coalesce(F.col(c) > 0, F.lit(False))
    return {"users": Source(users, [Rule("users_no_nulls", null("code", "name", "gender"), required=True)], "users_not_empty"),
            "flights": Source(flights, [Rule("flights_no_nulls", null("travelCode", "userCode", "price"), required=True),
                                        Rule("prices_positive", bad("price"), required=True, drops=True)], "flights_not_empty"),
            "hotels": Source(hotels, [Rule("totals_positive", bad("total"), drops=True)], "hotels_not_empty")}
