"""Independent SQL (DuckDB dialect) for the registered queries.

Each oracle starts from the same adapter views as ``wayfare.sources.adapters``
(users, flights, hotels over the base tables), written here as CTEs. The SQL
is written independently of the DataFrame code: it is the specification the
Spark plans are checked against.
"""

from __future__ import annotations

ADAPTERS = r"""
users AS (
  SELECT c_custkey AS code, c_mktsegment AS company, c_name AS "name",
         CASE WHEN c_nationkey % 2 = 0 THEN 'male' ELSE 'female' END AS gender,
         CAST(22 + c_custkey % 44 AS INTEGER) AS age
  FROM customer),
flights AS (
  SELECT l_orderkey AS "travelCode", CASE WHEN o_custkey % 17 <> 5 THEN o_custkey END AS "userCode",
         nf.n_name AS "from", nt.n_name AS "to",
         CASE l_returnflag WHEN 'A' THEN 'economic' WHEN 'N' THEN 'business'
              ELSE 'firstClass' END AS "flightType",
         l_extendedprice AS price,
         floor((l_quantity * 100 / 500 + 0.5 + l_tax * 10) * 100 + 0.5) / 100 AS "time",
         CAST(l_quantity * 100 AS BIGINT) AS distance,
         o_orderpriority AS agency, CAST(l_shipdate AS DATE) AS "date"
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation nf ON s_nationkey = nf.n_nationkey
  JOIN nation nt ON c_nationkey = nt.n_nationkey),
hotels AS (
  SELECT l_orderkey AS "travelCode", CASE WHEN o_custkey % 23 <> 7 THEN o_custkey END AS "userCode", p_brand AS "name",
         n_name AS place,
         CAST(1 + CAST(l_quantity AS BIGINT) % 14 AS INTEGER) AS "days",
         floor(l_extendedprice / (1 + CAST(l_quantity AS BIGINT) % 14) * 100 + 0.5) / 100 AS price,
         l_extendedprice AS total, CAST(l_shipdate AS DATE) AS "date"
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey)
"""


def with_adapters(body: str, extra_ctes: str = "") -> str:
    """Prefix a query with the adapter CTEs (and optional further CTEs)."""
    ctes = ADAPTERS.strip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{body.strip()}"


def esum(x: str) -> str:
    """Exact sum of a two-decimal column, as DOUBLE."""
    return f"CAST(sum(CAST({x} AS DECIMAL(38,2))) AS DOUBLE)"


def eavg(x: str) -> str:
    return f"({esum(x)} / count({x}))"


def stable(x: str, digits: int = 6) -> str:
    """Half-up rounding for float aggregates whose last bits depend on order."""
    s = 10 ** digits
    return f"(floor(({x}) * {s} + 0.5) / {s})"
