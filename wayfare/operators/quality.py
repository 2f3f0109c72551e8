"""Data quality, cleaning and profiling.

Each check suite is one aggregate pass per table (all rules are conditional
counts in a single ``agg``), unpivoted with ``stack`` into rows
``(table, check, passed, bad_rows)``. Nothing is collected unless the caller
asks ``raise_on_fail``, which pulls the handful of check rows only.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import is_positive


class DataQualityError(ValueError):
    pass


def clean_positive(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose ``column`` is NULL or not positive (pushed to the scan)."""
    c = F.col(f"`{column}`")
    return df.where(c.isNotNull() & (c > 0))


def _stack(table: str, checks: list[tuple[str, object]]) -> str:
    parts = ", ".join(f"'{name}', `{name}`" for name, _ in checks)
    return f"stack({len(checks)}, {parts}) as (check, bad_rows)"


def _checks_frame(df: DataFrame, table: str, checks: list[tuple[str, object]],
                  empty_check: str | None = None) -> DataFrame:
    aggs = [F.count_if(cond).alias(name) for name, cond in checks]
    aggs.append(F.count(F.lit(1)).alias("_rows"))
    a = df.agg(*aggs)
    out = a.selectExpr("_rows", _stack(table, checks))
    out = out.select(F.lit(table).alias("table"), "check", (F.col("bad_rows") == 0).alias("passed"),
                     "bad_rows")
    if empty_check:
        ne = a.select(F.lit(table).alias("table"), F.lit(empty_check).alias("check"),
                      (F.col("_rows") > 0).alias("passed"),
                      F.when(F.col("_rows") > 0, 0).otherwise(1).cast("bigint").alias("bad_rows"))
        out = ne.unionByName(out)
    return out


def validate_data(users: DataFrame, flights: DataFrame, hotels: DataFrame) -> DataFrame:
    """Six checks of the daily pipeline: the three tables are non-empty; no
    NULL in users(code, name, gender) nor flights(travelCode, userCode,
    price); flight prices are positive (NULL fails, an empty table passes)."""
    u = _checks_frame(users, "users", [
        ("users_no_nulls", F.col("code").isNull() | F.col("name").isNull() | F.col("gender").isNull())],
        empty_check="users_not_empty")
    f = _checks_frame(flights, "flights", [
        ("flights_no_nulls", F.col("travelCode").isNull() | F.col("userCode").isNull()
         | F.col("price").isNull()),
        ("prices_positive", ~is_positive("price"))], empty_check="flights_not_empty")
    h = hotels.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("hotels").alias("table"), F.lit("hotels_not_empty").alias("check"),
        (F.col("n") > 0).alias("passed"),
        F.when(F.col("n") > 0, 0).otherwise(1).cast("bigint").alias("bad_rows"))
    return u.unionByName(f).unionByName(h)


def raise_on_fail(checks: DataFrame) -> DataFrame:
    """Action: raise ``DataQualityError`` naming the failed checks (collects
    only the failed check rows, a handful at most)."""
    failed = checks.where(~F.col("passed")).select("table", "check", "bad_rows").collect()
    if failed:
        names = ", ".join(f"{r['table']}.{r['check']} ({r['bad_rows']} bad)" for r in failed)
        raise DataQualityError(f"Data validation failed: {names}")
    return checks


def preprocess(flights: DataFrame, hotels: DataFrame):
    """Clean flights (price) and hotels (total); returns (flights, hotels,
    counts) where counts has rows before/after per table in one job each."""
    cf = clean_positive(flights, "price")
    ch = clean_positive(hotels, "total")
    counts = (flights.agg(F.lit("flights").alias("table"), F.count(F.lit(1)).alias("rows_before"),
                          F.count_if(F.col("price").isNotNull() & (F.col("price") > 0)).alias("rows_after"))
              .unionByName(hotels.agg(F.lit("hotels").alias("table"), F.count(F.lit(1)).alias("rows_before"),
                                      F.count_if(F.col("total").isNotNull() & (F.col("total") > 0))
                                      .alias("rows_after"))))
    return cf, ch, counts


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def describe(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """count, mean, std (sample), min, 25%, 50%, 75%, max per numeric column;
    one output row per column. Moments are one aggregate pass; exact
    percentiles (linear interpolation) come from ``exact_quantiles`` over the
    (column, value) long form, so no task holds a whole column's values.
    ``approx`` uses the mergeable sketch in the aggregate pass instead."""
    from .quantiles import exact_quantiles
    cols = cols or numeric_columns(df)
    probs = [0.25, 0.5, 0.75]
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`").cast("double")
        fields = [F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                  F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")]
        if approx:
            q = F.percentile_approx(x, F.array(*[F.lit(p) for p in probs]), 10000)
            fields += [q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75")]
        aggs.append(F.struct(*fields).alias(f"s{i}"))
    a = df.agg(*aggs)
    stats = a.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(cols))])).alias("s")).select("s.*")
    order = ["column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    if approx:
        return stats.select(*order)
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                                  F.col(f"`{c}`").cast("double").alias("x"))
                                         for c in cols])).alias("s")).select("s.*")
    qs = exact_quantiles(long, "column", "x", probs).select(
        "column", F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"))
    return stats.join(qs, "column", "left").select(*order)


def missing_counts(df: DataFrame) -> DataFrame:
    """NULL (and NaN) count per column, only columns with at least one."""
    checks = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        cond = c.isNull()
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cond = cond | F.isnan(c)
        checks.append(F.count_if(cond).alias(f.name))
    a = df.agg(*checks)
    arr = F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").alias("missing"))
                    for f in df.schema.fields])
    return a.select(F.explode(arr).alias("s")).select("s.*").where(F.col("missing") > 0)


def dataset_info(df: DataFrame, name: str) -> DataFrame:
    """Rows, column count and the column list of a table (one row)."""
    return df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"),
                  F.lit(len(df.columns)).alias("columns"),
                  F.lit(",".join(df.columns)).alias("column_list"))


# Fixed generator rules of the original data (used as audit rules). Decimal
# literals keep the bounds exact, so a value on a boundary is judged the
# same way by any engine.
FLIGHT_DISTANCE_RANGE = (500, 5000)
FLIGHT_EXTRA_HOURS = (Decimal("0.5"), Decimal("2.0"))   # time - distance / 500
FLIGHT_PRICE_PER_DISTANCE = Decimal("0.15")             # base price per unit distance
FLIGHT_CLASS_BANDS = {"economic": (Decimal("0.8"), Decimal("1.2")),
                      "business": (Decimal("1.5"), Decimal("2.5")),
                      "firstClass": (Decimal("2.5"), Decimal("4.0"))}
HOTEL_DAYS_RANGE = (1, 14)
HOTEL_PRICE_RANGE = (80, 500)
HOTEL_TOTAL_TOLERANCE = Decimal("0.005")               # per day, plus the same once


def audit_flights(flights: DataFrame, tol: Decimal = Decimal("0.01")) -> DataFrame:
    """Violation counts of the flight rules, one row per rule."""
    d, t, p = F.col("distance"), F.col("time"), F.col("price")
    lo, hi = FLIGHT_DISTANCE_RANGE
    elo, ehi = FLIGHT_EXTRA_HOURS
    extra = t - d / 500
    ratio = p / (F.lit(FLIGHT_PRICE_PER_DISTANCE) * d)
    band = None
    for cls, (blo, bhi) in FLIGHT_CLASS_BANDS.items():
        cond = F.col("flightType") == cls
        ok = (ratio >= F.lit(blo - tol)) & (ratio <= F.lit(bhi + tol))
        band = F.when(cond, ok) if band is None else band.when(cond, ok)
    rules = [("from_differs_to", F.col("from") != F.col("to")),
             ("distance_in_range", (d >= lo) & (d <= hi)),
             ("time_matches_distance", (extra >= F.lit(elo - tol)) & (extra <= F.lit(ehi + tol))),
             ("price_in_class_band", band)]
    checks = [(n, ~F.coalesce(r, F.lit(False))) for n, r in rules]
    return _checks_frame(flights, "flights", checks)


def audit_hotels(hotels: DataFrame, flights: DataFrame) -> DataFrame:
    """Violation counts of the stay rules: total = days * nightly price
    (tolerance 0.005 * days + 0.005), days and price in range, and the place
    is a destination of a flight with the same travelCode.

    The flight side is reduced to distinct (travelCode, to) pairs before the
    join, so the left join matches each stay at most once: an order with many
    flight lines cannot fan out the stays.
    """
    dlo, dhi = HOTEL_DAYS_RANGE
    plo, phi = HOTEL_PRICE_RANGE
    dest = (flights.where(F.col("travelCode").isNotNull() & F.col("to").isNotNull())
                   .select("travelCode", F.col("to").alias("_dest")).distinct()
                   .withColumn("_m", F.lit(True)))
    hj = hotels.join(dest, (hotels.travelCode == dest.travelCode) & (hotels.place == dest._dest), "left")
    tol = F.lit(HOTEL_TOTAL_TOLERANCE) * F.col("days") + F.lit(HOTEL_TOTAL_TOLERANCE)
    rules = [("total_matches_days_price", F.abs(F.col("total") - F.col("days") * F.col("price")) <= tol),
             ("days_in_range", (F.col("days") >= dlo) & (F.col("days") <= dhi)),
             ("price_in_range", (F.col("price") >= plo) & (F.col("price") <= phi)),
             ("place_is_flight_destination", F.col("_m").isNotNull())]
    checks = [(n, ~F.coalesce(r, F.lit(False))) for n, r in rules]
    return _checks_frame(hj, "hotels", checks)
