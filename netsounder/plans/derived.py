"""Networks, points, lines, cells and readings derived from the input tables.

Each table is one portable SELECT, run by Spark here and usable as a CTE by an
oracle, so both sides start from the same rows; what is asked of them is
written separately for each side.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsounder.operators.ordering import running
from netsounder.session import TABLES, stored, table

SQL: dict[str, str] = {
    # lines -> orders -> customers -> nations -> regions, and lines -> suppliers -> nations
    "edge": """
SELECT from_node, to_node, length_m, form, origin, mode FROM {leaf_edge} UNION ALL
SELECT from_node, to_node, length_m, form, origin, mode FROM {trunk}""",
    "leaf_edge": """
SELECT concat('L:', l_orderkey, '-', l_partkey, '-', l_suppkey, '-', l_linenumber, '-', rn) AS from_node,
  CASE WHEN way = 0 THEN concat('O:', l_orderkey) ELSE concat('S:', l_suppkey) END AS to_node, l_quantity AS length_m, l_returnflag AS form, 'survey' AS origin, 'forward' AS mode
FROM {leaf} f {both_ways}""",
    "leaf": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag,
  row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey, l_linenumber
    ORDER BY l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS rn FROM {lineitem}""",
    # the part of that hierarchy above the lines
    "trunk": """
SELECT concat('O:', o_orderkey) AS from_node, concat('C:', o_custkey) AS to_node, o_totalprice / 1000 AS length_m,
  o_orderstatus AS form, 'survey' AS origin, 'forward' AS mode FROM {orders}
UNION ALL SELECT concat('C:', c_custkey), concat('N:', c_nationkey), c_acctbal / 10, c_mktsegment, 'survey', 'forward'
  FROM {customer} WHERE c_acctbal >= 0
UNION ALL SELECT concat('S:', s_suppkey), concat('N:', s_nationkey), abs(s_acctbal) / 10, 'supplier', 'repair', 'forward' FROM {supplier}
UNION ALL SELECT concat('N:', n_nationkey), concat('R:', n_regionkey), CAST(1 AS DOUBLE), 'tidal', 'survey', 'forward' FROM {nation}""",
    # whose signup right after whose error, the log read in order, outweighs it
    "step": """
SELECT DISTINCT u, v FROM (
  SELECT user_id AS u, lead(user_id) OVER w AS v, event_type AS before, lead(event_type) OVER w AS after, value AS low, lead(value) OVER w AS high
  FROM {events} WINDOW w AS (ORDER BY ts, event_id)) t WHERE u IS NOT NULL AND v IS NOT NULL AND before = 'error' AND after = 'signup' AND low < high""",
    "point": """
SELECT vec_id AS id, CAST(embedding{at0} AS DOUBLE) * 1000 AS x, CAST(embedding{at1} AS DOUBLE) * 1000 AS y, label FROM {embeddings}""",
    # legs between consecutive points, five points to a line
    "leg": """
SELECT a.id AS leg_id, CAST(floor(a.id / 5) AS BIGINT) AS line_id, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
FROM {point} a JOIN {point} b ON b.id = a.id + 1 AND a.id % 5 < 4""",
    # a 10-unit grid over the points: depth is minus the count
    "cell": """
SELECT CAST(floor(y / 10) AS BIGINT) AS r, CAST(floor(x / 10) AS BIGINT) AS c, count(*) AS n, avg(label) AS mean_label,
  -count(*) AS depth FROM {point} GROUP BY CAST(floor(y / 10) AS BIGINT), CAST(floor(x / 10) AS BIGINT)""",
    # a full raster of 16 columns with hills and pits
    "raster": """
SELECT r, c, CAST((r * 7 + c * 13 + (r * c) % 11) % 17 AS DOUBLE) + CAST(r + c AS DOUBLE) / 4 AS z
FROM (SELECT CAST(floor(i / 16) AS BIGINT) AS r, CAST(i % 16 AS BIGINT) AS c
  FROM (SELECT vec_id AS i FROM {embeddings}) g) h""",
    # judgements about legs and points, as a person would have noted them by what is seen at a place
    "correction": """
SELECT concat('reversal-', id) AS correction_id, 'reversal' AS kind, id + 1 AS subject, CAST(NULL AS BIGINT) AS target, CAST(NULL AS DOUBLE) AS x1, CAST(NULL AS DOUBLE) AS y1,
  CAST(NULL AS DOUBLE) AS x2, CAST(NULL AS DOUBLE) AS y2, CAST(NULL AS DOUBLE) AS rise, false AS judged, false AS structure FROM {point} WHERE label = 1
UNION ALL SELECT concat('mode-', id), 'mode', id, NULL, NULL, NULL, NULL, NULL, NULL, false, false FROM {point} WHERE label = 2
UNION ALL SELECT concat('exclusion-', id), 'exclusion', id, NULL, NULL, NULL, NULL, NULL, NULL, false, false FROM {point} WHERE label = 3 AND x > 100
UNION ALL SELECT concat('junction-', p.id), 'junction', p.id, min(l.leg_id), NULL, NULL, NULL, NULL, NULL, false, false FROM {point} p LEFT JOIN {leg} l
  ON floor(p.x / 40) = floor(l.x1 / 40) AND floor(p.y / 40) = floor(l.y1 / 40) AND l.line_id <> CAST(floor(p.id / 5) AS BIGINT) WHERE p.label = 4 GROUP BY p.id
UNION ALL SELECT concat('connector-', p.id), 'connector', NULL, NULL, p.x, p.y, q.x + 3, q.y + 300 * (q.label % 2), CAST(q.label - p.label AS DOUBLE), q.label > 6, q.label = 8
  FROM {point} p JOIN {point} q ON q.id = p.id + 7 WHERE p.label = 5""",
    "reading": """
SELECT event_id AS reading_id, user_id AS node_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS elevation,
  event_type AS source, ts FROM {events}""",
}
_NAME = re.compile(r"\{(\w+)\}")
_PLACES = {
    "spark": {"at0": "[0]", "at1": "[1]", "both_ways": "LATERAL VIEW explode(array(0, 1)) w AS way"},
    "oracle": {"at0": "[1]", "at1": "[2]", "both_ways": ", (VALUES (0), (1)) w(way)"},
}


def _steps(events: DataFrame) -> DataFrame:
    """``step`` without one task that holds the log: places from running counts, then a join of neighbours."""
    log = events.select("ts", "event_id", "user_id", "event_type", "value")
    placed = stored(running(log, ["ts", "event_id"])[0].where("user_id is not null and event_type in ('error', 'signup')"), "placed")
    before = placed.where("event_type = 'error'").select((F.col("before") + 1).alias("before"), F.col("user_id").alias("u"), F.col("value").alias("low"))
    after = placed.where("event_type = 'signup'").select("before", F.col("user_id").alias("v"), F.col("value").alias("high"))
    return before.join(after, "before").where("low < high").select("u", "v").distinct()


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived or input table as a DataFrame."""
    if name in TABLES:
        return table(spark, sf_dir, name)
    if name == "step":
        return _steps(table(spark, sf_dir, "events"))
    used = {}

    def put(m: re.Match) -> str:
        if m[1] in _PLACES["spark"]:
            return _PLACES["spark"][m[1]]
        used[m[1]] = frame(spark, sf_dir, m[1])
        return m[0]

    return spark.sql(_NAME.sub(put, SQL[name]), **used)


def text(name: str) -> str:
    """A derived table as SQL over the input tables."""

    def put(m: re.Match) -> str:
        if m[1] in _PLACES["oracle"]:
            return _PLACES["oracle"][m[1]]
        return m[1] if m[1] in TABLES else f"({text(m[1])})"

    return _NAME.sub(put, SQL[name])


def oracle(query: str, *names: str) -> str:
    """``query`` with CTEs of the derived tables in front."""
    ctes = ", ".join(f"{n} AS ({text(n)})" for n in names)
    if query.lstrip().upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes}, {query.lstrip()[14:]}"
    if query.lstrip().upper().startswith("WITH"):
        return f"WITH {ctes}, {query.lstrip()[4:]}"
    return f"WITH {ctes} {query}"


def registrar(queries: dict, oracles: dict):
    """A decorator ``query(name, sql, *derived tables that the SQL reads)`` that keeps both sides; ``sql`` may be None."""

    def query(name: str, sql: str | None, *names: str):
        def keep(f):
            queries[name] = f
            if sql is not None:
                oracles[name] = oracle(sql, *names) if names else sql
            return f

        return keep

    return query
