"""Sea-routing and terrain compositions, read-only views, and the remaining small operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from netsounder.functions.maths import degrees_of
from netsounder.operators import graph as G
from netsounder.operators import raster as R
from netsounder.operators import relational as X
from netsounder.plans.composite import _PATHS, _told
from netsounder.plans.derived import frame, registrar
from netsounder.sources.ledger import drift

QUERIES: dict = {}
ORACLES: dict = {}
query = registrar(QUERIES, ORACLES)


@query("u3_composed_graph", """
SELECT from_node, to_node, form FROM edge UNION ALL SELECT 'sea-node/' || u, 'sea-node/' || v, 'sea' FROM step WHERE u <> v""", "edge", "step")
def u3(spark, d):
    name = lambda c: F.concat(F.lit("sea-node/"), F.col(c).cast("string"))
    sea = frame(spark, d, "step").where("u <> v").select(name("u").alias("from_node"), name("v").alias("to_node"), F.lit("sea").alias("form"))
    return frame(spark, d, "edge").select("from_node", "to_node", "form").unionByName(sea)


@query("a12_any_and_sum", "SELECT c_nationkey, bool_or(c_acctbal > 9900) AS any_rich, bool_or(c_mktsegment = 'BUILDING') AS any_building, round(sum(abs(c_acctbal)) / 1000, 6) AS km FROM customer GROUP BY c_nationkey")
def a12(spark, d):
    return frame(spark, d, "customer").groupBy("c_nationkey").agg(
        F.bool_or(F.col("c_acctbal") > 9900).alias("any_rich"), F.bool_or(F.col("c_mktsegment") == "BUILDING").alias("any_building"), F.round(F.sum(F.abs("c_acctbal")) / 1000, 6).alias("km")
    )


@query("t3_keep_best", """
SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS rn FROM orders WHERE o_orderstatus <> 'P') WHERE rn = 1""")
def t3(spark, d):
    o = frame(spark, d, "orders").where("o_orderstatus <> 'P'")
    return X.first_by(o, ["o_custkey"], [F.asc("o_totalprice"), F.asc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("x7_positions", """
SELECT id, round((CASE WHEN id % 2 = 0 THEN 1 ELSE -1 END) * (id % 90 + (id % 60) / 60.0::DOUBLE + (id % 50) / 3600.0::DOUBLE), 9) AS degrees FROM point""", "point")
def x7(spark, d):
    p = frame(spark, d, "point")
    text = F.concat(F.col("id") % 90, F.lit("-"), F.col("id") % 60, F.lit("-"), F.col("id") % 50, F.when(F.col("id") % 2 == 0, "N").otherwise("S"))
    return p.select("id", F.round(degrees_of(text), 9).alias("degrees"))


@query("r4_usable_raster", "SELECT count(*) AS cells, count(*) FILTER (WHERE z BETWEEN -500 AND 9000) AS in_range, count(*) = count(*) FILTER (WHERE z BETWEEN -500 AND 9000) AS usable FROM raster", "raster")
def r4(spark, d):
    ok = F.col("z").between(-500, 9000)
    return frame(spark, d, "raster").agg(F.count("*").alias("cells"), F.count_if(ok).alias("in_range"), (F.count("*") == F.count_if(ok)).alias("usable"))


@query("q4_terrain", """
SELECT count(*) FILTER (WHERE z > 12) AS high, count(*) FILTER (WHERE z <= 12) AS low, round(avg(z), 6) AS mean,
  (SELECT count(DISTINCT CAST(floor(r / 4.0) AS BIGINT) * 100 + CAST(floor(c / 4.0) AS BIGINT)) FROM raster) AS tiles FROM raster""", "raster")
def q4(spark, d):
    z = frame(spark, d, "raster")
    tiles = R.reduced(z, 4, n=F.count("*")).agg(F.count("*").alias("tiles"))
    one = z.agg(F.count_if(F.col("z") > 12).alias("high"), F.count_if(F.col("z") <= 12).alias("low"), F.round(F.avg("z"), 6).alias("mean"))
    return one.join(F.broadcast(tiles))


_SEA = "sea AS (SELECT r, c FROM raster WHERE z > 9)"


@query("h7_open_water_mesh", f"""WITH RECURSIVE {_SEA}, clear AS (SELECT s.r, s.c, s.r * 100 + s.c AS id FROM sea s WHERE (SELECT count(*) FROM sea n WHERE abs(n.r - s.r) <= 1 AND abs(n.c - s.c) <= 1) >= 4),
p AS (SELECT a.id AS a, b.id AS b FROM clear a JOIN clear b ON abs(a.r - b.r) + abs(a.c - b.c) = 1), reach AS (SELECT id AS a, id AS b FROM clear UNION SELECT x.a, p.b FROM reach x JOIN p ON p.a = x.b),
k AS (SELECT a, min(b) AS part FROM reach GROUP BY a)
SELECT CAST(floor(a / 100) AS BIGINT) AS r, a % 100 AS c FROM k WHERE part = (SELECT part FROM k GROUP BY part ORDER BY count(*) DESC, part LIMIT 1)""", "raster")
def h7(spark, d):
    sea = frame(spark, d, "raster").where("z > 9").select("r", "c")
    around = R.shifted(sea, [*R.EIGHT, (0, 0)]).join(sea, ["r", "c"]).groupBy("r", "c").agg(F.count("*").alias("n")).where("n >= 4").select("r", "c")
    parts = R.regions(around)
    top = parts.groupBy("region").count().orderBy(F.desc("count"), "region").limit(1)
    return parts.join(F.broadcast(top), "region", "left_semi").select("r", "c")


@query("h10_coastal_band", f"WITH {_SEA} SELECT s.r, s.c FROM sea s WHERE EXISTS (SELECT 1 FROM raster l WHERE l.z <= 9 AND abs(l.r - s.r) <= 1 AND abs(l.c - s.c) <= 1)", "raster")
def h10(spark, d):
    z = frame(spark, d, "raster")
    near = R.dilated(z.where("z <= 9"), 1)
    return z.where("z > 9").select("r", "c").join(near, ["r", "c"], "left_semi")


@query("h11_reach_bound", """WITH RECURSIVE e AS (SELECT u, v, (u * 7 + v * 3) % 11 + 1 AS w FROM step),
walk AS (SELECT u AS node, 0 AS dist FROM step WHERE u % 30 = 0 UNION SELECT e.v, k.dist + e.w FROM walk k JOIN e ON e.u = k.node WHERE k.dist + e.w <= 30), b AS (SELECT node, min(dist) AS dist FROM walk GROUP BY node),
m AS (SELECT max(dist) FILTER (WHERE node % 7 = 0) AS bound FROM b)
SELECT node AS node_id, dist::DOUBLE AS dist FROM b, m WHERE dist <= bound""", "step")
def h11(spark, d):
    from netsounder.plans.graph import steps

    e = steps(spark, d).withColumn("length_m", F.col("length_m") + 1)
    got = G.shortest(e, e.where("from_node % 30 = 0").select(F.col("from_node").alias("node_id")).distinct(), 30.0)
    bound = got.where("node_id % 7 = 0").agg(F.max("dist").alias("bound"))
    return got.join(F.broadcast(bound), F.col("dist") <= F.col("bound")).select("node_id", "dist")


@query("h3_refined_cells", """
WITH t AS (SELECT CAST(floor(r / 4.0) AS BIGINT) AS r, CAST(floor(c / 4.0) AS BIGINT) AS c, max(z) - min(z) AS relief FROM raster GROUP BY 1, 2)
SELECT 4 AS size, r * 4 AS r, c * 4 AS c FROM t WHERE relief <= 13 UNION ALL SELECT DISTINCT 2, CAST(floor(k.r / 2.0) AS BIGINT) * 2, CAST(floor(k.c / 2.0) AS BIGINT) * 2 FROM raster k JOIN t ON CAST(floor(k.r / 4.0) AS BIGINT) = t.r AND CAST(floor(k.c / 4.0) AS BIGINT) = t.c AND relief > 13""", "raster")
def h3(spark, d):
    z = frame(spark, d, "raster")
    t = R.reduced(z, 4, relief=F.max("z") - F.min("z"))
    whole = t.where("relief <= 13").select(F.lit(4).alias("size"), (F.col("r") * 4).alias("r"), (F.col("c") * 4).alias("c"))
    half = R.reduced(z, 2, n=F.count("*")).select("r", "c")
    up = half.join(t.where("relief > 13").select(F.col("r").alias("pr"), F.col("c").alias("pc")), (F.floor(F.col("r") / 2) == F.col("pr")) & (F.floor(F.col("c") / 2) == F.col("pc")), "left_semi")
    return whole.unionByName(up.select(F.lit(2).alias("size"), (F.col("r") * 2).alias("r"), (F.col("c") * 2).alias("c")))


@query("h16_path_within_parents", f"""WITH RECURSIVE k AS (
  SELECT r // 4 * 10 + l AS window_, r, c, least(25, greatest(1, 50 / greatest(z, 2))) AS cost, c // 4 = l AND r % 4 = 0 AND c % 4 = 0 AS start, c // 4 = l + 1 AND r % 4 = 3 AND c % 4 = 3 AS goal
  FROM raster, (VALUES (0), (1), (2)) w(l) WHERE c // 4 IN (l, l + 1)), {_PATHS}""", "raster")
def h16(spark, d):
    z = frame(spark, d, "raster").select("r", "c", R.sea_cost(F.col("z")).alias("cost"), F.floor(F.col("r") / 4).alias("p"), F.floor(F.col("c") / 4).alias("q"))
    # each pair of parents side by side is a window: from the first one's first cell to the second one's last
    pair = z.select(F.explode(F.array(F.col("q"), F.col("q") - 1)).alias("left"), "p", "q", "r", "c", "cost").where("left between 0 and 2")
    win = pair.withColumn("window", F.col("p") * 10 + F.col("left")).withColumn("goal", (F.col("q") == F.col("left") + 1) & (F.col("r") % 4 == 3) & (F.col("c") % 4 == 3))
    starts = win.where("q = left and r % 4 = 0 and c % 4 = 0").select("window", "r", "c")
    return _told(G.window_paths(win.select("window", "r", "c", "cost", "goal"), starts))


@query("v4_lines_with_basin", "SELECT l.leg_id, l.line_id, n_name AS basin FROM leg l LEFT JOIN nation ON n_nationkey = l.line_id % 40", "leg")
def v4(spark, d):
    names = frame(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("k"), F.col("n_name").alias("basin"))
    legs = frame(spark, d, "leg").withColumn("k", F.col("line_id") % 40)
    return legs.join(names, "k", "left").select("leg_id", "line_id", "basin")


@query("v5_freshness", """
SELECT coalesce(a.k, b.k) AS name, CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'extra' ELSE 'changed' END AS drift FROM
  (SELECT o_orderpriority AS k, count(*) AS n FROM orders GROUP BY 1) a FULL JOIN (SELECT o_orderpriority AS k, count(*) AS n FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderpriority <> '1-URGENT' GROUP BY 1) b USING (k) WHERE a.n IS DISTINCT FROM b.n""")
def v5(spark, d):
    o = frame(spark, d, "orders").select(F.col("o_orderpriority").alias("name"), "o_orderkey")
    count = lambda df: df.groupBy("name").agg(F.count("*").alias("digest"))
    return drift(count(o), count(o.where("o_orderkey % 5 <> 0 and name <> '1-URGENT'")), "name", "digest")
