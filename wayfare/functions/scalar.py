"""Scalar column functions of the booking model.

All return ``Column`` expressions so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the original application.
# Age groups: right-closed bins (0,25], (25,35], (35,45], (45,55], (55,100].
AGE_EDGES = [0, 25, 35, 45, 55, 100]
AGE_LABELS = ["18-25", "26-35", "36-45", "46-55", "55+"]
# Weekday names in Monday-first order (Monday = 0 ... Sunday = 6).
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
# Route separator used between origin and destination.
ROUTE_ARROW = " → "


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, digits: int = 2) -> Column:
    """Half-up rounding with plain IEEE arithmetic, identical in any engine."""
    s = 10 ** digits
    return F.floor(col(c) * s + 0.5) / s


def round_price(c) -> Column:
    """Price rounded to cents (Spark ``round`` is half-up on the decimal value)."""
    return F.round(col(c), 2)


def exact_sum(c, scale: int = 2) -> Column:
    """Sum of values with at most ``scale`` decimals, exact and order independent.

    Summing doubles depends on the order rows arrive in; summing the same
    values as DECIMAL does not. Returns DOUBLE; NULL for no non-null input.
    """
    return F.sum(col(c).cast(f"decimal(38,{scale})")).cast("double")


def exact_avg(c, scale: int = 2) -> Column:
    """Mean as exact decimal sum divided by the non-null count (NULL if none)."""
    return exact_sum(c, scale) / F.count(col(c))


def date_features(d) -> list[Column]:
    """month (1-12), day_of_week (Monday=0 .. Sunday=6), is_weekend (Sat/Sun)."""
    d = col(d)
    return [F.month(d).alias("month"),
            F.weekday(d).alias("day_of_week"),
            F.weekday(d).isin(5, 6).cast("int").alias("is_weekend")]


def day_name_to_index(name) -> Column:
    """Weekday name -> 0..6 (Monday first); unknown name -> NULL."""
    m = F.create_map(*[x for i, n in enumerate(DAY_NAMES) for x in (F.lit(n), F.lit(i))])
    return m[col(name)]


def parse_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """String -> DATE. With ANSI mode (the Spark 4 default) a malformed value
    raises, as the original eager parser did; ``try_to_date`` semantics are
    available through ``F.try_to_date`` when NULL is wanted instead."""
    return F.to_date(col(c), fmt)


def month_bucket(d) -> Column:
    return F.date_format(col(d), "yyyy-MM")


def route(frm, to, arrow: str = ROUTE_ARROW) -> Column:
    """Origin + arrow + destination; NULL if either side is NULL."""
    return F.concat(col(frm), F.lit(arrow), col(to))


def hotel_id(name, place) -> Column:
    return F.concat(col(name), F.lit("_"), col(place))


def hotel_name_from_id(hid) -> Column:
    """The text before the first underscore."""
    return F.split(col(hid), "_", 2)[0]


def age_group(age) -> Column:
    """Right-closed age bins; outside (0, 100] -> NULL."""
    a = col(age)
    e = AGE_EDGES
    expr = None
    for lo, hi, lab in zip(e[:-1], e[1:], AGE_LABELS):
        cond = (a > lo) & (a <= hi)
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    return expr


def is_positive(c) -> Column:
    """NULL-safe ``c > 0``: NULL counts as not positive."""
    return F.coalesce(col(c) > 0, F.lit(False))


def stable(c, digits: int = 6) -> Column:
    """Half-up rounding for float aggregates (mean, std, cosine) whose last
    bits depend on summation order; used where results are compared or
    ranked so that equal values compare equal."""
    s = 10 ** digits
    return F.floor(col(c) * s + 0.5) / s
