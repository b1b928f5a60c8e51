"""Relational queries: projections, joins, aggregates, windows, rankings and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from netsounder.operators import relational as R
from netsounder.operators.ordering import running
from netsounder.plans.derived import frame, registrar

QUERIES: dict = {}
ORACLES: dict = {}


query = registrar(QUERIES, ORACLES)


@query("f1_orientation", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_returnflag = 'R' THEN l_suppkey ELSE l_partkey END AS from_node,
  CASE WHEN l_returnflag = 'R' THEN l_partkey ELSE l_suppkey END AS to_node,
  l_returnflag IN ('R', 'A') AS direction_known FROM lineitem""")
def f1(spark, d):
    out = R.oriented(frame(spark, d, "lineitem"), "l_returnflag", "l_partkey", "l_suppkey", ["r"], ["a"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "from_node", "to_node", "direction_known")


@query("f2_terminus", """
SELECT n.node_id, CASE WHEN t.node_id IS NOT NULL THEN 'tidal' ELSE 'inland' END AS terminus
FROM (SELECT from_node AS node_id FROM edge UNION SELECT to_node FROM edge) n
LEFT JOIN (SELECT from_node AS node_id FROM edge WHERE form = 'tidal' UNION SELECT to_node FROM edge WHERE form = 'tidal') t
  ON n.node_id = t.node_id""", "edge")
def f2(spark, d):
    edges = frame(spark, d, "edge")
    ends = F.explode(F.array("from_node", "to_node")).alias("node_id")
    tidal = edges.where("form = 'tidal'").select(ends).distinct().withColumn("t", F.lit(True))
    nodes = edges.select(ends).distinct().join(tidal, "node_id", "left")
    return nodes.select("node_id", F.when(F.col("t"), "tidal").otherwise("inland").alias("terminus"))


@query("f3_form_filter", "SELECT from_node, to_node, form FROM edge WHERE form IN ('BUILDING', 'tidal') AND origin NOT IN ('repair')", "edge")
def f3(spark, d):
    e = frame(spark, d, "edge")
    return e.where(F.col("form").isin("BUILDING", "tidal") & ~F.col("origin").isin("repair")).select("from_node", "to_node", "form")


@query("f4_bbox", "SELECT id, x, y FROM point WHERE x >= -50 AND x <= 120 AND y >= -80 AND y <= 60", "point")
def f4(spark, d):
    return frame(spark, d, "point").where("x >= -50 and x <= 120 and y >= -80 and y <= 60").select("id", "x", "y")


@query("f5_coordinate_window", """
SELECT p.id, q.id AS centre FROM point p JOIN point q ON q.id < 5
WHERE p.x BETWEEN q.x - 40 AND q.x + 40 AND p.y BETWEEN q.y - 40 AND q.y + 40""", "point")
def f5(spark, d):
    p = frame(spark, d, "point")
    q = p.where("id < 5").select(F.col("id").alias("centre"), F.col("x").alias("qx"), F.col("y").alias("qy"))
    return p.join(F.broadcast(q), F.expr("x between qx - 40 and qx + 40 and y between qy - 40 and qy + 40")).select("id", "centre")


@query("f6_kept_class", """
SELECT from_node, to_node, (form = 'BUILDING' AND length_m < 300) OR origin <> 'survey' OR form = 'tidal' AS kept FROM edge""", "edge")
def f6(spark, d):
    kept = ((F.col("form") == "BUILDING") & (F.col("length_m") < 300)) | (F.col("origin") != "survey") | (F.col("form") == "tidal")
    return frame(spark, d, "edge").select("from_node", "to_node", kept.alias("kept"))


@query("f7_zoom_thinning", """
WITH k AS (SELECT from_node, to_node, length_m, origin <> 'survey' OR length_m >= 100 AS shown FROM edge)
SELECT from_node, to_node, round(length_m, 3) AS length_m, (SELECT count(*) > 500 FROM k WHERE shown) AS truncated
FROM k WHERE shown ORDER BY k.length_m DESC, from_node, to_node LIMIT 500""", "edge")
def f7(spark, d):
    shown = frame(spark, d, "edge").where("origin <> 'survey' or length_m >= 100")
    n = shown.agg((F.count("*") > 500).alias("truncated"))
    top = shown.orderBy(F.desc("length_m"), "from_node", "to_node").limit(500)
    return top.join(F.broadcast(n)).select("from_node", "to_node", F.round("length_m", 3).alias("length_m"), "truncated")


@query("f8_scope_reason", """
SELECT n_nationkey, round(sum(c_acctbal), 2) AS area, sum(c_acctbal) >= 250000 AS in_scope,
  CASE WHEN sum(c_acctbal) >= 250000 THEN 'area at least 250000' WHEN sum(c_acctbal) > 0 THEN 'area below 250000' ELSE 'no area' END AS reason
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_nationkey""")
def f8(spark, d):
    area = F.sum("c_acctbal")
    joined = frame(spark, d, "customer").join(frame(spark, d, "nation"), F.expr("c_nationkey = n_nationkey"))
    out = joined.groupBy("n_nationkey").agg(area.alias("a"))
    reason = F.when(F.col("a") >= 250000, "area at least 250000").when(F.col("a") > 0, "area below 250000").otherwise("no area")
    return out.select("n_nationkey", F.round("a", 2).alias("area"), (F.col("a") >= 250000).alias("in_scope"), reason.alias("reason"))


@query("f9_cross_border", """
SELECT s_suppkey, round(greatest(s_acctbal - 100, 0), 2) AS outside, round(greatest(-s_acctbal, 0), 2) AS clipped
FROM supplier WHERE s_acctbal > 1""")
def f9(spark, d):
    s = frame(spark, d, "supplier").where("s_acctbal > 1")
    clip = lambda c: F.round(F.greatest(c, F.lit(0.0)), 2)
    return s.select("s_suppkey", clip(F.col("s_acctbal") - 100).alias("outside"), clip(-F.col("s_acctbal")).alias("clipped"))


@query("f10_bands", """
SELECT reading_id, CASE WHEN elevation IS NULL THEN 'no reading' WHEN elevation - 50 > 4 THEN 'clear rise'
  WHEN elevation - 50 > 0.5 THEN 'weak rise' WHEN elevation - 50 >= -0.5 THEN 'flat'
  WHEN elevation - 50 >= -4 THEN 'weak fall' ELSE 'clear fall' END AS band FROM reading""", "reading")
def f10(spark, d):
    return frame(spark, d, "reading").select("reading_id", R.banded(F.col("elevation") - 50, 0.5, 4.0).alias("band"))


@query("f11_scope_rule", """
SELECT s_suppkey, CASE WHEN s_acctbal > 5000 THEN 'basin' WHEN n_regionkey IN (0, 3) THEN 'country' ELSE 'neither' END AS rule,
  s_acctbal > 5000 OR n_regionkey IN (0, 3) AS in_scope
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")
def f11(spark, d):
    s = frame(spark, d, "supplier").join(frame(spark, d, "nation"), F.expr("s_nationkey = n_nationkey"), "left")
    basin, country = F.col("s_acctbal") > 5000, F.coalesce(F.col("n_regionkey").isin(0, 3), F.lit(False))
    rule = F.when(basin, "basin").when(country, "country").otherwise("neither")
    return s.select("s_suppkey", rule.alias("rule"), (basin | country).alias("in_scope"))


@query("f13_licence_gate", """
SELECT DISTINCT source FROM documents WHERE source NOT IN (SELECT DISTINCT source FROM documents WHERE lang = 'en') OR lang = 'xx'""")
def f13(spark, d):
    docs = frame(spark, d, "documents")
    allowed = docs.where("lang = 'en'").select("source").distinct()
    return docs.select("source", "lang").join(allowed, "source", "left_anti").select("source").distinct()


@query("f14_optional_column", "SELECT r_regionkey, r_name, CAST(NULL AS VARCHAR) AS label FROM region")
def f14(spark, d):
    r = frame(spark, d, "region")
    label = F.col("r_label") if "r_label" in r.columns else F.lit(None).cast("string")
    return r.select("r_regionkey", "r_name", label.alias("label"))


@query("f15_null_safe_inequality", """
SELECT reading_id, elevation <> 50 AS plain, elevation IS DISTINCT FROM 50 AS safe FROM reading""", "reading")
def f15(spark, d):
    e = F.col("elevation")
    return frame(spark, d, "reading").select("reading_id", (e != 50).alias("plain"), (~e.eqNullSafe(50.0)).alias("safe"))


@query("f16_default_fill", "SELECT reading_id, coalesce(elevation, 0) AS elevation, coalesce(elevation > 50, false) AS high FROM reading", "reading")
def f16(spark, d):
    e = F.col("elevation")
    return frame(spark, d, "reading").select("reading_id", F.coalesce(e, F.lit(0.0)).alias("elevation"), F.coalesce(e > 50, F.lit(False)).alias("high"))


@query("f17_name_compatibility", """
SELECT a.p_partkey AS a, b.p_partkey AS b,
  lower(trim(a.p_name)) = lower(trim(b.p_name)) OR lower(trim(a.p_name)) = lower(trim(b.p_brand))
    OR lower(trim(a.p_brand)) = lower(trim(b.p_name)) OR lower(trim(a.p_brand)) = lower(trim(b.p_brand)) AS same_name,
  lower(trim(a.p_name)) <> lower(trim(b.p_name)) AS conflict
FROM part a JOIN part b ON a.p_size = b.p_size AND a.p_type = b.p_type AND a.p_partkey < b.p_partkey""")
def f17(spark, d):
    p = frame(spark, d, "part")
    name, brand = R.plain_name("p_name"), R.plain_name("p_brand")
    a = p.select(F.col("p_partkey").alias("a"), name.alias("an"), brand.alias("ab"), "p_size", "p_type")
    b = p.select(F.col("p_partkey").alias("b"), name.alias("bn"), brand.alias("bb"), "p_size", "p_type")
    out = a.join(b, ["p_size", "p_type"]).where("a < b")
    return out.select("a", "b", R.same_name(("an", "ab"), ("bn", "bb")).alias("same_name"), R.conflicting_name("an", "bn").alias("conflict"))


@query("f18_veto_cascade", """
SELECT reading_id, CASE WHEN elevation IS NULL OR elevation <= 60 THEN 'allowed' WHEN source = 'purchase' THEN 'structure overrides'
  WHEN node_id % 2 = 0 THEN 'person overrides' ELSE 'refused' END AS verdict FROM reading""", "reading")
def f18(spark, d):
    e = F.col("elevation")
    verdict = F.when(e.isNull() | (e <= 60), "allowed").when(F.col("source") == "purchase", "structure overrides")
    verdict = verdict.when(F.col("node_id") % 2 == 0, "person overrides").otherwise("refused")
    return frame(spark, d, "reading").select("reading_id", verdict.alias("verdict"))


@query("f19_dedupe", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem) WHERE rn = 1""")
def f19(spark, d):
    keys = ["l_orderkey", "l_linenumber"]
    out = R.first_by(frame(spark, d, "lineitem"), keys, [F.col(c) for c in ("l_partkey", "l_suppkey", "l_quantity")])
    return out.select(*keys, "l_partkey", "l_suppkey", "l_quantity")


@query("j1_inner", """
SELECT n_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def j1(spark, d):
    o, c, n = (frame(spark, d, t) for t in ("orders", "customer", "nation"))
    joined = o.join(c, F.expr("o_custkey = c_custkey")).join(n, F.expr("c_nationkey = n_nationkey"))
    return joined.groupBy("n_name").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("j2_left_chain", """
SELECT o_orderkey, c_mktsegment, n_name, r_name, coalesce(k.n, 0) AS lines FROM orders
LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) k ON l_orderkey = o_orderkey""")
def j2(spark, d):
    o, c, n, r = (frame(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    lines = frame(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    out = o.join(c, F.expr("o_custkey = c_custkey"), "left").join(n, F.expr("c_nationkey = n_nationkey"), "left")
    out = out.join(r, F.expr("n_regionkey = r_regionkey"), "left").join(lines, F.expr("l_orderkey = o_orderkey"), "left")
    return out.select("o_orderkey", "c_mktsegment", "n_name", "r_name", F.coalesce("n", F.lit(0)).alias("lines"))


@query("j3_role_join", """
SELECT a.from_node, b.label AS from_label, c.label AS to_label FROM (SELECT concat('', u) AS from_node, u, v FROM step) a
LEFT JOIN point b ON b.id = a.u LEFT JOIN point c ON c.id = a.v""", "step", "point")
def j3(spark, d):
    p = frame(spark, d, "point").select("id", "label")
    s = frame(spark, d, "step").select(F.col("u").cast("string").alias("from_node"), "u", "v")
    out = s.join(p.withColumnRenamed("label", "from_label"), F.col("id") == F.col("u"), "left").drop("id")
    return out.join(p.withColumnRenamed("label", "to_label"), F.col("id") == F.col("v"), "left").select("from_node", "from_label", "to_label")


_SINK = "SELECT DISTINCT e.to_node AS node_id FROM edge e LEFT JOIN edge o ON o.from_node = e.to_node WHERE o.from_node IS NULL"


@query("j4_anti_null_test", _SINK, "edge")
def j4(spark, d):
    e = frame(spark, d, "edge")
    return e.select(F.col("to_node").alias("node_id")).distinct().join(e.select(F.col("from_node").alias("node_id")), "node_id", "left_anti")


@query("j5_not_exists", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def j5(spark, d):
    return frame(spark, d, "customer").join(frame(spark, d, "orders"), F.expr("o_custkey = c_custkey"), "left_anti").select("c_custkey")


@query("j6_exists", "SELECT s_suppkey FROM supplier WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_quantity > 49)")
def j6(spark, d):
    big = frame(spark, d, "lineitem").where("l_quantity > 49")
    return frame(spark, d, "supplier").join(big, F.expr("l_suppkey = s_suppkey"), "left_semi").select("s_suppkey")


@query("j22_key_map", """
SELECT e.reading_id, coalesce(p.label, -1) AS label FROM reading e LEFT JOIN point p ON p.id = e.node_id""", "reading", "point")
def j22(spark, d):
    p = frame(spark, d, "point").select(F.col("id").alias("node_id"), "label")
    return frame(spark, d, "reading").join(p, "node_id", "left").select("reading_id", F.coalesce("label", F.lit(-1)).alias("label"))


@query("j23_preaggregated", """
SELECT c_custkey, coalesce(o.n, 0) AS orders, round(coalesce(o.least, 0), 2) AS least FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS n, min(o_totalprice) AS least FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey""")
def j23(spark, d):
    o = frame(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.min("o_totalprice").alias("least"))
    out = frame(spark, d, "customer").join(o, F.expr("o_custkey = c_custkey"), "left")
    zero = F.lit(0)
    return out.select("c_custkey", F.coalesce("n", zero).alias("orders"), F.round(F.coalesce("least", zero.cast("double")), 2).alias("least"))


@query("j25_merge_map", """
WITH m AS (SELECT u AS node_id, min(v) AS merged FROM step WHERE u % 7 = 0 GROUP BY u)
SELECT u, v, coalesce(a.merged, u) AS from_node, coalesce(b.merged, v) AS to_node
FROM step LEFT JOIN m a ON a.node_id = u LEFT JOIN m b ON b.node_id = v""", "step")
def j25(spark, d):
    s = frame(spark, d, "step")
    m = s.where("u % 7 = 0").groupBy(F.col("u").alias("node_id")).agg(F.min("v").alias("merged"))
    a, b = m.toDF("u", "mu"), m.toDF("v", "mv")
    out = s.join(a, "u", "left").join(b, "v", "left")
    return out.select("u", "v", F.coalesce("mu", "u").alias("from_node"), F.coalesce("mv", "v").alias("to_node"))


@query("j26_parent_key", """
SELECT l.leg_id, l.line_id, r.reason FROM leg l JOIN (SELECT DISTINCT line_id AS parent, 'reversed' AS reason FROM leg WHERE line_id % 4 = 1) r
ON coalesce(l.line_id, l.leg_id) = r.parent""", "leg")
def j26(spark, d):
    leg = frame(spark, d, "leg")
    r = leg.where("line_id % 4 = 1").select(F.col("line_id").alias("parent"), F.lit("reversed").alias("reason")).distinct()
    return leg.join(r, F.coalesce("line_id", "leg_id") == F.col("parent")).select("leg_id", "line_id", "reason")


@query("a1_group", """
SELECT form, count(*) AS n, round(sum(length_m), 3) AS total, round(min(length_m), 3) AS least, round(max(length_m), 3) AS most FROM edge GROUP BY form""", "edge")
def a1(spark, d):
    r = lambda f, a: F.round(f("length_m"), 3).alias(a)
    return frame(spark, d, "edge").groupBy("form").agg(F.count("*").alias("n"), r(F.sum, "total"), r(F.min, "least"), r(F.max, "most"))


@query("a2_conditional_sum", """
SELECT origin, round(sum(CASE WHEN length_m > 30 THEN length_m ELSE 0 END), 3) AS long_m, round(sum(length_m), 3) AS all_m FROM edge GROUP BY origin""", "edge")
def a2(spark, d):
    long = F.sum(F.when(F.col("length_m") > 30, F.col("length_m")).otherwise(0.0))
    return frame(spark, d, "edge").groupBy("origin").agg(F.round(long, 3).alias("long_m"), F.round(F.sum("length_m"), 3).alias("all_m"))


@query("a3_filtered_counts", """
SELECT count(*) AS n, count(*) FILTER (WHERE elevation > 50) AS high, count(*) FILTER (WHERE elevation IS NULL) AS missing,
  count(*) FILTER (WHERE elevation <= 50 AND source = 'click') AS low_clicks FROM reading""", "reading")
def a3(spark, d):
    e = F.col("elevation")
    c = [F.count_if(e > 50).alias("high"), F.count_if(e.isNull()).alias("missing"), F.count_if((e <= 50) & (F.col("source") == "click")).alias("low_clicks")]
    return frame(spark, d, "reading").agg(F.count("*").alias("n"), *c)


@query("a4_two_distinct", "SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_returnflag")
def a4(spark, d):
    return frame(spark, d, "lineitem").groupBy("l_returnflag").agg(F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct("l_partkey").alias("parts"))


@query("a5_bool_or", "SELECT l_suppkey, bool_or(l_quantity > 49) AS any_big, bool_and(l_quantity > 1) AS all_some FROM lineitem GROUP BY l_suppkey")
def a5(spark, d):
    q = F.col("l_quantity")
    return frame(spark, d, "lineitem").groupBy("l_suppkey").agg(F.bool_or(q > 49).alias("any_big"), F.bool_and(q > 1).alias("all_some"))


@query("a6_any_value", "SELECT o_custkey, min(o_orderpriority) AS priority FROM orders GROUP BY o_custkey")
def a6(spark, d):
    return frame(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderpriority").alias("priority"))


@query("a7_quantiles", "SELECT l_returnflag, round(median(l_extendedprice), 4) AS p50, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90 FROM lineitem GROUP BY l_returnflag")
def a7(spark, d):
    p = lambda q: F.round(F.percentile("l_extendedprice", F.lit(q)), 4)
    return frame(spark, d, "lineitem").groupBy("l_returnflag").agg(p(0.5).alias("p50"), p(0.9).alias("p90"))


@query("a8_percentile_vector", """
SELECT round(quantile_cont(v, 0.05), 6) AS p5, round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50,
  round(quantile_cont(v, 0.75), 6) AS p75, round(quantile_cont(v, 0.95), 6) AS p95, round(quantile_cont(v, 0.99), 6) AS p99
FROM (SELECT sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS v FROM leg) s WHERE v > 0""", "leg")
def a8(spark, d):
    v = frame(spark, d, "leg").select(F.expr("sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))").alias("v")).where("v > 0")
    marks = (0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
    out = v.agg(F.percentile("v", F.array(*map(F.lit, marks))).alias("p"))
    return out.select(*[F.round(F.col("p")[i], 6).alias(f"p{round(m * 100)}") for i, m in enumerate(marks)])


@query("a9_pivot_sum", """
SELECT o_orderpriority, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 2) AS F,
  round(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 2) AS O, round(sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 2) AS P
FROM orders GROUP BY o_orderpriority""")
def a9(spark, d):
    return frame(spark, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.round(F.sum("o_totalprice"), 2))


@query("a10_mode", """
SELECT c_nationkey, c_mktsegment AS label FROM (
  SELECT c_nationkey, c_mktsegment, row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, c_mktsegment) AS rn
  FROM customer GROUP BY c_nationkey, c_mktsegment) WHERE rn = 1""")
def a10(spark, d):
    return R.most_common(frame(spark, d, "customer"), ["c_nationkey"], "c_mktsegment", "label")


@query("a11_mean_of_boolean", "SELECT source, round(avg(CASE WHEN elevation IS NULL OR elevation < 20 THEN 1.0 ELSE 0.0 END), 9) AS mute FROM reading GROUP BY source", "reading")
def a11(spark, d):
    mute = F.coalesce(F.col("elevation") < 20, F.lit(True)).cast("double")
    return frame(spark, d, "reading").groupBy("source").agg(F.round(F.avg(mute), 9).alias("mute"))


@query("a13_argmax", """
SELECT o_custkey, o_orderkey AS outlet FROM (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def a13(spark, d):
    best = F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("outlet")
    return frame(spark, d, "orders").groupBy("o_custkey").agg(best)


@query("a14_cumulative_share", """
SELECT count(*) FILTER (WHERE cum < 1.0 / 3) + 1 AS holding_a_third FROM (
  SELECT sum(km) OVER (ORDER BY km DESC, c_custkey ROWS UNBOUNDED PRECEDING) / sum(km) OVER () AS cum
  FROM (SELECT c_custkey, abs(c_acctbal) AS km FROM customer) x)""")
def a14(spark, d):
    c = frame(spark, d, "customer").select("c_custkey", F.abs("c_acctbal").alias("km"))
    cum = R.running_share(c, "km", [F.desc("km"), F.asc("c_custkey")])
    return cum.agg((F.count_if(F.col("cum_share") < 1.0 / 3) + 1).alias("holding_a_third"))


@query("a15_having", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def a15(spark, d):
    return frame(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


@query("a16_cross_tab", """
SELECT o_totalprice > 150000 AS by_first, o_orderstatus = 'F' AS by_second, count(*) AS n, round(sum(o_totalprice) / 1000, 3) AS km
FROM orders GROUP BY o_totalprice > 150000, o_orderstatus = 'F'""")
def a16(spark, d):
    keys = ((F.col("o_totalprice") > 150000).alias("by_first"), (F.col("o_orderstatus") == "F").alias("by_second"))
    return frame(spark, d, "orders").groupBy(*keys).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice") / 1000, 3).alias("km"))


@query("a17_a18_shares", """
SELECT n_nationkey, round(sum(CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0 END) / nullif(sum(abs(c_acctbal)), 0), 9) AS share,
  CASE WHEN count(*) FILTER (WHERE c_acctbal >= -999) = count(*) THEN '100%' ELSE 'less' END AS shown
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey""")
def a17(spark, d):
    j = frame(spark, d, "nation").join(frame(spark, d, "customer"), F.expr("c_nationkey = n_nationkey"), "left")
    up, ok = F.sum(F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).otherwise(0.0)), F.count_if(F.col("c_acctbal") >= -999)
    g = j.groupBy("n_nationkey").agg(F.round(R.share(up, F.sum(F.abs("c_acctbal"))), 9).alias("share"), (ok / F.count("*")).alias("s"))
    return g.select("n_nationkey", "share", F.when(R.floored_share(F.col("s")) == "100%", "100%").otherwise("less").alias("shown"))


@query("a19_histogram", """
SELECT count(*) FILTER (WHERE elevation <= 10) AS band_0, count(*) FILTER (WHERE elevation > 10 AND elevation <= 50) AS band_1,
  count(*) FILTER (WHERE elevation > 50 AND elevation <= 200) AS band_2, count(*) FILTER (WHERE elevation > 200 OR elevation IS NULL) AS beyond
FROM reading""", "reading")
def a19(spark, d):
    return R.histogram(frame(spark, d, "reading"), "elevation", [10, 50, 200])


@query("a20_zonal_count", """
SELECT CAST(floor(r / 8.0) AS BIGINT) AS basin, count(*) AS cells, sum(n) AS points, count(*) FILTER (WHERE n > 1) AS crowded,
  count(*) FILTER (WHERE mean_label > 5) AS upper FROM cell GROUP BY CAST(floor(r / 8.0) AS BIGINT)""", "cell")
def a20(spark, d):
    c = frame(spark, d, "cell").groupBy(F.floor(F.col("r") / 8.0).alias("basin"))
    return c.agg(F.count("*").alias("cells"), F.sum("n").alias("points"), F.count_if(F.col("n") > 1).alias("crowded"), F.count_if(F.col("mean_label") > 5).alias("upper"))


@query("a21_a22_block_reduction", """
SELECT CAST(floor(r / 4.0) AS BIGINT) AS r, CAST(floor(c / 4.0) AS BIGINT) AS c, max(z) AS most, min(z) AS least,
  bool_or(z > 12) AS any_high, bool_and(z > 2) AS all_up FROM raster GROUP BY 1, 2""", "raster")
def a21(spark, d):
    from netsounder.operators.raster import reduced

    return reduced(frame(spark, d, "raster"), 4, most=F.max("z"), least=F.min("z"), any_high=F.bool_or(F.col("z") > 12), all_up=F.bool_and(F.col("z") > 2))


@query("a23_parent_rollup", """
SELECT least(a, b) AS a, greatest(a, b) AS b, count(*) AS n, round(min(len), 6) AS shortest FROM (
  SELECT CAST(floor(x1 / 100) AS BIGINT) AS a, CAST(floor(x2 / 100) AS BIGINT) AS b,
    sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS len FROM leg) e WHERE a <> b GROUP BY 1, 2""", "leg")
def a23(spark, d):
    e = frame(spark, d, "leg").select(
        F.floor(F.col("x1") / 100).alias("p"), F.floor(F.col("x2") / 100).alias("q"), F.expr("sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))").alias("len")
    ).where("p <> q")
    return e.groupBy(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).agg(F.count("*").alias("n"), F.round(F.min("len"), 6).alias("shortest"))


@query("a24_concat", "SELECT c_nationkey, string_agg(c_mktsegment, '; ' ORDER BY c_mktsegment) AS segments FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer) s GROUP BY c_nationkey")
def a24(spark, d):
    joined = F.array_join(F.array_sort(F.collect_set("c_mktsegment")), "; ").alias("segments")
    return frame(spark, d, "customer").groupBy("c_nationkey").agg(joined)


@query("a25_nunique", "SELECT o_custkey, count(DISTINCT o_orderpriority) AS priorities FROM orders GROUP BY o_custkey")
def a25(spark, d):
    return frame(spark, d, "orders").groupBy("o_custkey").agg(F.countDistinct("o_orderpriority").alias("priorities"))


@query("a26_consensus_text", """
SELECT p_brand, p_type AS text FROM (SELECT p_brand, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) AS rn
  FROM part GROUP BY p_brand, p_type) WHERE rn = 1""")
def a26(spark, d):
    return R.most_common(frame(spark, d, "part"), ["p_brand"], "p_type", "text")


@query("a27_partition_accounting", """
SELECT count(*) FILTER (WHERE elevation > 60) AS kept, count(*) FILTER (WHERE elevation <= 40) AS dropped,
  count(*) FILTER (WHERE elevation > 40 AND elevation <= 60) AS split, count(*) FILTER (WHERE elevation IS NULL) AS unmeasured, true AS balanced FROM reading""", "reading")
def a27(spark, d):
    e = F.col("elevation")
    parts = {"kept": e > 60, "dropped": e <= 40, "split": (e > 40) & (e <= 60), "unmeasured": e.isNull()}
    one = frame(spark, d, "reading").agg(F.count("*").alias("n"), *[F.count_if(c).alias(k) for k, c in parts.items()])
    return one.select(*parts, (sum((F.col(k) for k in parts), F.lit(0)) == F.col("n")).alias("balanced"))


@query("w1_row_number", """
SELECT l_suppkey, l_orderkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS rn
  FROM lineitem) WHERE rn = 1""")
def w1(spark, d):
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey")]
    return R.first_by(frame(spark, d, "lineitem"), ["l_suppkey"], order).select("l_suppkey", "l_orderkey", "l_extendedprice")


@query("w2_running_sum", """
SELECT c_nationkey, c_custkey, round(sum(c_acctbal) OVER (PARTITION BY c_nationkey ORDER BY c_custkey ROWS UNBOUNDED PRECEDING), 2) AS running FROM customer""")
def w2(spark, d):
    w = Window.partitionBy("c_nationkey").orderBy("c_custkey").rowsBetween(Window.unboundedPreceding, 0)
    return frame(spark, d, "customer").select("c_nationkey", "c_custkey", F.round(F.sum("c_acctbal").over(w), 2).alias("running"))


@query("w3_spacing_sagitta", """
SELECT id, round(sqrt((x - px) * (x - px) + (y - py) * (y - py)), 6) AS spacing,
  round(abs((nx - px) * (y - py) - (ny - py) * (x - px)) / nullif(sqrt((nx - px) * (nx - px) + (ny - py) * (ny - py)), 0), 6) AS sagitta
FROM (SELECT id, x, y, lag(x) OVER w AS px, lag(y) OVER w AS py, lead(x) OVER w AS nx, lead(y) OVER w AS ny
  FROM point WINDOW w AS (PARTITION BY CAST(floor(id / 5) AS BIGINT) ORDER BY id)) s""", "point")
def w3(spark, d):
    w = Window.partitionBy(F.floor(F.col("id") / 5)).orderBy("id")
    p = frame(spark, d, "point").select("id", "x", "y", *[f(c).over(w).alias(a + c) for c in "xy" for a, f in (("p", F.lag), ("n", F.lead))])
    spacing = F.expr("sqrt((x - px) * (x - px) + (y - py) * (y - py))")
    sagitta = F.expr("abs((nx - px) * (y - py) - (ny - py) * (x - px)) / nullif(sqrt((nx - px) * (nx - px) + (ny - py) * (ny - py)), 0)")
    return p.select("id", F.round(spacing, 6).alias("spacing"), F.round(sagitta, 6).alias("sagitta"))


@query("w4_rank", "SELECT r, c, dense_rank() OVER (PARTITION BY r ORDER BY z) AS place FROM raster", "raster")
def w4(spark, d):
    return frame(spark, d, "raster").select("r", "c", F.dense_rank().over(Window.partitionBy("r").orderBy("z")).alias("place"))


@query("t2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def t2(spark, d):
    return frame(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


@query("t4_t5_null_order", """
SELECT reading_id, row_number() OVER (ORDER BY elevation ASC NULLS LAST, reading_id) AS worst_last,
  row_number() OVER (ORDER BY elevation ASC NULLS FIRST, reading_id) AS missing_first FROM reading""", "reading")
def t4(spark, d):
    e = F.col("elevation")
    r = frame(spark, d, "reading").select("reading_id", "elevation")
    place = lambda order, name: running(r, [order, "reading_id"])[0].select("reading_id", (F.col("before") + 1).alias(name))
    return place(e.asc_nulls_last(), "worst_last").join(place(e.asc_nulls_first(), "missing_first"), "reading_id")


@query("t6_cheapest_per_pair", """
SELECT u % 5 AS a, v % 5 AS b, min(u * 1000 + v) AS cheapest FROM step GROUP BY 1, 2""", "step")
def t6(spark, d):
    s = frame(spark, d, "step").select((F.col("u") % 5).alias("a"), (F.col("v") % 5).alias("b"), (F.col("u") * 1000 + F.col("v")).alias("cost"))
    return s.groupBy("a", "b").agg(F.min_by("cost", "cost").alias("cheapest"))


@query("u1_union_all", "SELECT from_node, to_node FROM edge WHERE origin = 'survey' UNION ALL SELECT from_node, to_node FROM edge WHERE origin = 'repair'", "edge")
def u1(spark, d):
    e = frame(spark, d, "edge").select("from_node", "to_node", "origin")
    return e.where("origin = 'survey'").unionByName(e.where("origin = 'repair'")).drop("origin")


@query("u2_union", "SELECT from_node AS node_id FROM edge WHERE form = 'tidal' UNION SELECT to_node FROM edge WHERE form = 'tidal'", "edge")
def u2(spark, d):
    t = frame(spark, d, "edge").where("form = 'tidal'")
    return t.select(F.col("from_node").alias("node_id")).union(t.select("to_node")).distinct()


@query("u4_set_algebra", """
SELECT id FROM ((SELECT u AS id FROM step UNION SELECT v FROM step WHERE v % 2 = 0) EXCEPT SELECT u FROM step WHERE u % 3 = 0) x
INTERSECT SELECT v FROM step""", "step")
def u4(spark, d):
    s = frame(spark, d, "step")
    u, v = s.select(F.col("u").alias("id")), s.select(F.col("v").alias("id"))
    return u.union(v.where("id % 2 = 0")).distinct().subtract(u.where("id % 3 = 0")).intersect(v)


@query("u5_padded_union", """
SELECT n_nationkey, round(sum(s_acctbal), 2) AS km FROM nation JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal > 5000 GROUP BY n_nationkey
UNION ALL SELECT n_nationkey, NULL FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""")
def u5(spark, d):
    n, s = frame(spark, d, "nation"), frame(spark, d, "supplier").where("s_acctbal > 5000")
    on = F.expr("s_nationkey = n_nationkey")
    full = n.join(s, on).groupBy("n_nationkey").agg(F.round(F.sum("s_acctbal"), 2).alias("km"))
    return R.padded_union(full, n.join(s, on, "left_anti").select("n_nationkey"))


@query("s9_first_reading_wins", """
SELECT node_id, elevation, source FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY reading_id) AS rn FROM reading) WHERE rn = 1""", "reading")
def s9(spark, d):
    return R.first_by(frame(spark, d, "reading"), ["node_id"], [F.asc("reading_id")]).select("node_id", "elevation", "source")


@query("s23_update", "SELECT c_custkey, coalesce((SELECT bool_or(o_totalprice > 400000) FROM orders WHERE o_custkey = c_custkey), false) AS applied FROM customer")
def s23(spark, d):
    big = frame(spark, d, "orders").groupBy("o_custkey").agg(F.bool_or(F.col("o_totalprice") > 400000).alias("big"))
    return frame(spark, d, "customer").join(big, F.expr("o_custkey = c_custkey"), "left").select("c_custkey", F.coalesce("big", F.lit(False)).alias("applied"))


@query("s24_upsert", """
SELECT s_suppkey, s_acctbal FROM supplier WHERE s_suppkey % 10 <> 3 UNION ALL SELECT s_suppkey, -1.0 FROM supplier WHERE s_suppkey % 10 = 3""")
def s24(spark, d):
    old = frame(spark, d, "supplier").select("s_suppkey", "s_acctbal")
    new = old.where("s_suppkey % 10 = 3").withColumn("s_acctbal", F.lit(-1.0))
    return R.upserted(old, new, ["s_suppkey"])


@query("s16_manifest_digest", """
SELECT sha256(string_agg(n_name || ':' || sha256(n_name), chr(10) ORDER BY n_name || ':' || sha256(n_name))) AS manifest FROM nation""")
def s16(spark, d):
    from netsounder.sources.ledger import manifest

    return manifest(frame(spark, d, "nation").select(F.col("n_name").alias("name"), F.sha2(F.col("n_name").cast("binary"), 256).alias("sha256")))


@query("s18_source_verification", """
SELECT l.n_nationkey AS source, CASE WHEN a.n_nationkey IS NULL THEN 'unverified' WHEN l.n_regionkey = a.n_regionkey THEN 'verified' ELSE 'MISMATCH' END AS status
FROM nation l LEFT JOIN (SELECT n_nationkey, CASE WHEN n_nationkey % 7 = 0 THEN -1 ELSE n_regionkey END AS n_regionkey FROM nation WHERE n_nationkey < 20) a
ON a.n_nationkey = l.n_nationkey""")
def s18(spark, d):
    from netsounder.sources.ledger import verification

    n = frame(spark, d, "nation").select(F.col("n_nationkey").alias("source"), F.col("n_regionkey").cast("string").alias("digest"))
    seen = n.where("source < 20").withColumn("digest", F.when(F.col("source") % 7 == 0, "-1").otherwise(F.col("digest")))
    return verification(n, seen, "source")


@query("s29_drift", """
SELECT coalesce(a.p_partkey, b.p_partkey) AS name, CASE WHEN b.p_partkey IS NULL THEN 'missing' WHEN a.p_partkey IS NULL THEN 'extra' ELSE 'changed' END AS drift
FROM (SELECT p_partkey, p_size FROM part WHERE p_partkey % 50 <> 1) a
FULL JOIN (SELECT p_partkey, CASE WHEN p_partkey % 40 = 0 THEN -1 ELSE p_size END AS p_size FROM part WHERE p_partkey % 60 <> 2) b USING (p_partkey)
WHERE a.p_size IS DISTINCT FROM b.p_size""")
def s29(spark, d):
    from netsounder.sources.ledger import drift

    p = frame(spark, d, "part").select(F.col("p_partkey").alias("name"), F.col("p_size").alias("digest"))
    now = p.where("name % 60 <> 2").withColumn("digest", F.when(F.col("name") % 40 == 0, -1).otherwise(F.col("digest")))
    return drift(p.where("name % 50 <> 1"), now, "name", "digest")
