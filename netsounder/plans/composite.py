"""Further spatial, routing and proposal queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from netsounder.operators import graph as G
from netsounder.operators import grids as H
from netsounder.operators import raster as R
from netsounder.operators import relational as X
from netsounder.operators import spatial as S
from netsounder.operators.ordering import running
from netsounder.plans.derived import frame, registrar
from netsounder.plans.raster import _MEETING, spread

QUERIES: dict = {}
ORACLES: dict = {}
query = registrar(QUERIES, ORACLES)

_D = "sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y))"
# three diamonds about the origin, the coasts of these queries
_RADII = (62, 122, 182)


def diamonds(spark):
    rows = []
    for k, n in enumerate(_RADII):
        corners = [(n, 0), (0, n), (-n, 0), (0, -n)]
        rows += [(k, *map(float, a), *map(float, b)) for a, b in zip(corners, corners[1:] + corners[:1], strict=True)]
    return spark.createDataFrame(rows, "ring long, x1 double, y1 double, x2 double, y2 double")


_RING = "ring AS (SELECT k AS ring, n FROM (VALUES (0, 62), (1, 122), (2, 182)) v(k, n))"
# a leg meets a convex diamond where one of its ends is inside or it crosses one of the four sides
_EDGE = "edge AS (SELECT ring, n AS ex1, 0 AS ey1, 0 AS ex2, n AS ey2 FROM ring UNION ALL SELECT ring, 0, n, -n, 0 FROM ring UNION ALL SELECT ring, -n, 0, 0, -n FROM ring UNION ALL SELECT ring, 0, -n, n, 0 FROM ring)"
_CUT = """cut AS (SELECT DISTINCT line_id, ring FROM leg l JOIN edge e ON
  ((e.ex2 - e.ex1) * (l.y1 - e.ey1) - (e.ey2 - e.ey1) * (l.x1 - e.ex1)) * ((e.ex2 - e.ex1) * (l.y2 - e.ey1) - (e.ey2 - e.ey1) * (l.x2 - e.ex1)) < 0
  AND ((l.x2 - l.x1) * (e.ey1 - l.y1) - (l.y2 - l.y1) * (e.ex1 - l.x1)) * ((l.x2 - l.x1) * (e.ey2 - l.y1) - (l.y2 - l.y1) * (e.ex2 - l.x1)) < 0)"""
_SIDES = f"""WITH {_RING}, {_EDGE}, {_CUT}, inn AS (SELECT line_id, ring, bool_and(abs(x1) + abs(y1) < n AND abs(x2) + abs(y2) < n) AS whole FROM leg, ring GROUP BY line_id, ring)"""


@query("f12_side_of_boundary", _SIDES + """SELECT line_id, ring, CASE WHEN whole THEN 'landward' ELSE 'crossing' END AS side FROM inn WHERE whole OR (line_id, ring) IN (SELECT line_id, ring FROM cut)
UNION ALL SELECT DISTINCT line_id, NULL, 'seaward' FROM leg WHERE line_id NOT IN (SELECT line_id FROM inn WHERE whole) AND line_id NOT IN (SELECT line_id FROM cut)""", "leg")
def f12(spark, d):
    return S.sides(frame(spark, d, "leg"), diamonds(spark), 60.0, 30.0)


@query("j15_largest_containing", _SIDES + "SELECT line_id, ring, area FROM (SELECT line_id, ring, 2.0::DOUBLE * n * n AS area, row_number() OVER (PARTITION BY line_id ORDER BY n DESC) AS rn FROM inn JOIN ring USING (ring) WHERE whole) WHERE rn = 1", "leg")
def j15(spark, d):
    return S.containing_ring(frame(spark, d, "leg"), diamonds(spark), 60.0, 30.0)


@query("j16_not_touching", _SIDES + "SELECT DISTINCT line_id FROM leg WHERE line_id NOT IN (SELECT line_id FROM cut) AND line_id NOT IN (SELECT line_id FROM inn WHERE whole)", "leg")
def j16(spark, d):
    legs = frame(spark, d, "leg")
    met = S.sides(legs, diamonds(spark), 60.0, 30.0).where("side <> 'seaward'")
    return legs.select("line_id").distinct().join(met, "line_id", "left_anti")


@query("p9_crosses_land", f"WITH {_RING}, {_EDGE}, {_CUT} SELECT line_id, line_id IN (SELECT line_id FROM cut WHERE ring = 1) AS crosses FROM (SELECT DISTINCT line_id FROM leg) l", "leg")
def p9(spark, d):
    legs = frame(spark, d, "leg")
    hit = S.crossing_rings(legs, diamonds(spark).where("ring = 1"), 60.0).join(legs.select("leg_id", "line_id"), "leg_id").select("line_id").distinct().withColumn("h", F.lit(True))
    return legs.select("line_id").distinct().join(hit, "line_id", "left").select("line_id", F.coalesce("h", F.lit(False)).alias("crosses"))


@query("p6_rasterised", f"WITH {_RING} SELECT ring, r, c FROM ring, (SELECT i AS r FROM range(-20, 20) t(i)) a, (SELECT i AS c FROM range(-20, 20) t(i)) b WHERE abs((c + 0.5) * 10) + abs((r + 0.5) * 10) < n", "leg")
def p6(spark, d):
    return S.rasterised(diamonds(spark), 10.0).select("ring", "r", "c")


@query("p12_dissolve", f"WITH {_RING} SELECT min(ring) AS least, count(*) AS rings, r, c FROM ring, (SELECT i AS r FROM range(-20, 20) t(i)) a, (SELECT i AS c FROM range(-20, 20) t(i)) b WHERE abs((c + 0.5) * 10) + abs((r + 0.5) * 10) < n GROUP BY r, c", "leg")
def p12(spark, d):
    return S.rasterised(diamonds(spark), 10.0).groupBy("r", "c").agg(F.min("ring").alias("least"), F.count("*").alias("rings"))


@query("q8_water_bodies", f"WITH {_RING} SELECT ring, 2.0::DOUBLE * n * n AS area FROM ring WHERE 2.0::DOUBLE * n * n >= 10000", "leg")
def q8(spark, d):
    return S.areas(diamonds(spark)).where("area >= 10000").select("ring", "area")


@query("j27_length_by_cell", "SELECT line_id, round(sum(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))), 5) AS m FROM leg GROUP BY line_id", "leg")
def j27(spark, d):
    parts = S.clipped_lengths(frame(spark, d, "leg"), 37.0)
    return parts.groupBy("line_id").agg(F.round(F.sum("m"), 5).alias("m"))


@query("j19_nearest_other_chain", f"""
WITH c AS (SELECT p.id, q.id AS target, q.label, {_D} AS gap, row_number() OVER (PARTITION BY p.id, q.label ORDER BY {_D}, q.id) AS rn FROM point p JOIN point q ON p.label <> q.label AND {_D} <= 20)
SELECT id, target, round(gap, 6) AS gap FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY gap, target) AS k FROM c WHERE rn = 1) WHERE k = 1""", "point")
def j19(spark, d):
    p = frame(spark, d, "point").select("id", F.col("label").alias("chain"), "x", "y")
    return S.nearest_other_chain(p, 20.0).select("id", "target", F.round("gap", 6).alias("gap"))


_G = "6371000 * acos(least(1, greatest(-1, sin(radians(p.y / 100 + 50)) * sin(radians(q.y / 100 + 50)) + cos(radians(p.y / 100 + 50)) * cos(radians(q.y / 100 + 50)) * cos(radians(p.x / 100 - q.x / 100)))))"


@query("j20_nearest_on_sphere", f"""
SELECT id, target, round(m, 1) AS metres FROM (SELECT p.id, q.id AS target, {_G} AS m, row_number() OVER (PARTITION BY p.id ORDER BY {_G}, q.id) AS rn
  FROM point p JOIN point q ON p.id <> q.id AND q.label < 3 WHERE {_G} <= 40000) WHERE rn = 1""", "point")
def j20(spark, d):
    p = frame(spark, d, "point").select("id", (F.col("y") / 100 + 50).alias("lat"), (F.col("x") / 100).alias("lon"), "label")
    return S.nearest_on_sphere(p, p.where("label < 3"), 40_000.0).select("id", "target", F.round("metres", 1).alias("metres"))


@query("p7_simplified", """
WITH RECURSIVE pt AS (SELECT id // 5 AS line_id, id % 5 AS k, x, y FROM point), seg AS (
  SELECT line_id, min(k) AS lo, max(k) AS hi FROM pt GROUP BY line_id
  UNION ALL SELECT line_id, CASE WHEN half = 0 THEN lo ELSE far END, CASE WHEN half = 0 THEN far ELSE hi END FROM (
    SELECT line_id, lo, hi, arg_max(k, (off, -k)) AS far, max(off) AS most FROM (
      SELECT s.line_id, s.lo, s.hi, p.k, sqrt((p.x - a.x - t.t * (b.x - a.x)) ** 2 + (p.y - a.y - t.t * (b.y - a.y)) ** 2) AS off
      FROM seg s JOIN pt a ON a.line_id = s.line_id AND a.k = s.lo JOIN pt b ON b.line_id = s.line_id AND b.k = s.hi JOIN pt p ON p.line_id = s.line_id AND p.k > s.lo AND p.k < s.hi,
        LATERAL (SELECT coalesce(greatest(0, least(1, ((p.x - a.x) * (b.x - a.x) + (p.y - a.y) * (b.y - a.y)) / nullif((b.x - a.x) ** 2 + (b.y - a.y) ** 2, 0))), 0) AS t) t) o
    GROUP BY line_id, lo, hi) f, (VALUES (0), (1)) h(half) WHERE most > 20)
SELECT line_id, count(DISTINCT k) AS vertices FROM (SELECT line_id, lo AS k FROM seg UNION ALL SELECT line_id, hi FROM seg) v GROUP BY line_id""", "point")
def p7(spark, d):
    from netsounder.plans.spatial import _chains

    return S.simplified(_chains(spark, d), 20.0).select("line_id", F.size("pts").alias("vertices"))


@query("x13_transverse_mercator", """
WITH g AS (SELECT 6377563.396::DOUBLE AS a, 6356256.909::DOUBLE AS b, 0.9996012717::DOUBLE AS k, radians(49.0::DOUBLE) AS p0),
q AS (SELECT id, radians(y / 200 + 53) AS p, radians(x / 200) AS d, a, b, k, p0, (a - b) / (a + b) AS n, 1 - (b / a) ** 2 AS e2 FROM point, g),
h AS (SELECT *, sin(p) AS s, cos(p) AS c, tan(p) AS t, a * k / sqrt(1 - e2 * sin(p) * sin(p)) AS nu, a * k * (1 - e2) / (1 - e2 * sin(p) * sin(p)) ** 1.5 AS rho,
  b * k * ((1 + n + 5.0::DOUBLE / 4 * n ** 2 + 5.0::DOUBLE / 4 * n ** 3) * (p - p0) - (3 * n + 3 * n ** 2 + 21.0::DOUBLE / 8 * n ** 3) * sin(p - p0) * cos(p + p0)
    + (15.0::DOUBLE / 8 * n ** 2 + 15.0::DOUBLE / 8 * n ** 3) * sin(2 * (p - p0)) * cos(2 * (p + p0)) - 35.0::DOUBLE / 24 * n ** 3 * sin(3 * (p - p0)) * cos(3 * (p + p0))) AS arc FROM q)
SELECT id, round(400000 + nu * c * d + nu / 6 * c ** 3 * (nu / rho - t ** 2) * d ** 3 + nu / 120 * c ** 5 * (5 - 18 * t ** 2 + t ** 4 + 14 * (nu / rho - 1) - 58 * t ** 2 * (nu / rho - 1)) * d ** 5, 3) AS e,
  round(arc - 100000 + nu / 2 * s * c * d ** 2 + nu / 24 * s * c ** 3 * (5 - t ** 2 + 9 * (nu / rho - 1)) * d ** 4 + nu / 720 * s * c ** 5 * (61 - 58 * t ** 2 + t ** 4) * d ** 6, 3) AS n, true AS returns FROM h""", "point")
def x13(spark, d):
    from netsounder.functions.crs import NATIONAL_GRID

    p = frame(spark, d, "point").select("id", (F.col("y") / 200 + 53).alias("lat"), (F.col("x") / 200 - 2).alias("lon"))
    east, north = NATIONAL_GRID.forward(F.col("lat"), F.col("lon"))
    at = p.withColumns({"e": east, "n": north})
    lat, lon = NATIONAL_GRID.backward(F.col("e"), F.col("n"))
    return at.select("id", F.round("e", 3).alias("e"), F.round("n", 3).alias("n"), (F.abs(lat - F.col("lat")) + F.abs(lon - F.col("lon")) < 1e-7).alias("returns"))


@query("g2_sea_edges", """
WITH r AS (SELECT u AS a, v AS b, (u * 7 + v * 3) % 11 AS m FROM step WHERE u <> v), e AS (SELECT c_custkey % 151 AS entry, min(CASE WHEN c_acctbal < 0 OR abs(c_acctbal) / 10 <= 100 THEN 'C:' || c_custkey END) AS mouth FROM customer GROUP BY 1)
SELECT 'sea-' || a || '-' || b AS edge_id, coalesce(x.mouth, 'sea-node/' || a) AS from_node, coalesce(y.mouth, 'sea-node/' || b) AS to_node, 'both' AS mode, m AS length_m
FROM r LEFT JOIN e x ON x.entry = a LEFT JOIN e y ON y.entry = b""", "step")
def g2(spark, d):
    routes = frame(spark, d, "step").where("u <> v").select(F.col("u").alias("a"), F.col("v").alias("b"), ((F.col("u") * 7 + F.col("v") * 3) % 11).alias("length_m"))
    c = frame(spark, d, "customer")
    entries = c.select((F.col("c_custkey") % 151).alias("entry"), F.concat(F.lit("C:"), "c_custkey").alias("node_id"), F.when(F.col("c_acctbal") < 0, "terminus").otherwise("blocked").alias("kind"), (F.abs("c_acctbal") / 10).alias("coast_m"))
    return G.sea_edges(routes, entries).select("edge_id", "from_node", "to_node", "mode", "length_m")


@query("g14_stranded_labels", """WITH RECURSIVE dry AS (SELECT u, v FROM step WHERE (u * 3 + v) % 4 <> 0), und AS (SELECT u AS a, v AS b FROM dry UNION SELECT v, u FROM dry),
reach AS (SELECT a, a AS b FROM und UNION SELECT r.a, s.b FROM reach r JOIN und s ON r.b = s.a), c AS (SELECT a AS node, min(b) AS region FROM reach GROUP BY a),
n AS (SELECT region, 'name ' || v % 5 AS name, count(*) AS n FROM dry JOIN c ON c.node = dry.u GROUP BY 1, 2)
SELECT region, name AS label FROM (SELECT *, row_number() OVER (PARTITION BY region ORDER BY n DESC, name) AS rn FROM n) WHERE rn = 1""", "step")
def g14(spark, d):
    e = frame(spark, d, "step").where("(u * 3 + v) % 4 <> 0").select(F.col("u").alias("from_node"), F.col("v").alias("to_node"))
    at = e.join(G.weak_components(e).toDF("from_node", "region"), "from_node").withColumn("name", F.concat(F.lit("name "), F.col("to_node") % 5))
    return X.most_common(at, ["region"], "name", "label")


# cheapest walks over 8 neighbours inside each window, from its start to its goal, with the cells on the way
_PATHS = """walk AS (SELECT window_, r, c, 0.0::DOUBLE AS dist, r || ',' || c AS path, 0 AS hops FROM k WHERE start
  UNION ALL SELECT window_, r, c, best.dist, best.path, hops FROM (SELECT b.window_, b.r, b.c, x.hops + 1 AS hops,
      min({'dist': x.dist + (a.cost + b.cost) / 2 * sqrt((a.r - b.r) ** 2 + (a.c - b.c) ** 2), 'path': x.path || '>' || b.r || ',' || b.c}) AS best
    FROM walk x JOIN k a ON a.window_ = x.window_ AND a.r = x.r AND a.c = x.c JOIN k b ON b.window_ = x.window_ AND abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 AND (a.r <> b.r OR a.c <> b.c)
    WHERE x.hops < 20 GROUP BY b.window_, b.r, b.c, x.hops) z)
SELECT window_ AS "window", round(best.dist, 6) AS cost, best.path AS path FROM (SELECT w.window_, min({'dist': w.dist, 'path': w.path}) AS best FROM walk w JOIN k ON k.window_ = w.window_ AND k.r = w.r AND k.c = w.c AND k.goal GROUP BY w.window_)"""


def _told(paths):
    return paths.select("window", F.round("cost", 6).alias("cost"), F.concat_ws(">", "path").alias("path"))


@query("g18_window_paths", f"""WITH RECURSIVE k AS (SELECT r // 8 * 2 + c // 8 AS window_, r, c, least(25, greatest(1, 50 / greatest(z, 2))) AS cost, r % 8 = 0 AND c % 8 = 0 AS start, r % 8 = 7 AND c % 8 = 7 AS goal FROM raster),
{_PATHS}""", "raster")
def g18(spark, d):
    z = frame(spark, d, "raster").select((F.floor(F.col("r") / 8) * 2 + F.floor(F.col("c") / 8)).alias("window"), "r", "c", R.sea_cost(F.col("z")).alias("cost"), ((F.col("r") % 8 == 7) & (F.col("c") % 8 == 7)).alias("goal"))
    return _told(G.window_paths(z, z.where("r % 8 = 0 and c % 8 = 0").select("window", "r", "c")))


@query("g25_cross_resolution", """WITH RECURSIVE t AS (SELECT DISTINCT r // 16 * 16 AS r, c // 16 * 16 AS c, 16 AS size FROM raster
  UNION ALL SELECT t.r + i.i * t.size // 2, t.c + j.j * t.size // 2, t.size // 2 FROM t, (VALUES (0), (1)) i(i), (VALUES (0), (1)) j(j)
  WHERE t.size > 2 AND (SELECT max(z) - min(z) FROM raster k WHERE k.r >= t.r AND k.r < t.r + t.size AND k.c >= t.c AND k.c < t.c + t.size) > 14),
s AS (SELECT r * 100 + c AS id, * FROM t WHERE size = 2 OR NOT coalesce((SELECT max(z) - min(z) FROM raster k WHERE k.r >= t.r AND k.r < t.r + t.size AND k.c >= t.c AND k.c < t.c + t.size) > 14, false))
SELECT a.id AS a, b.id AS b FROM s a JOIN s b ON a.id < b.id AND (
  ((a.r + a.size = b.r OR b.r + b.size = a.r) AND a.c < b.c + b.size AND b.c < a.c + a.size) OR ((a.c + a.size = b.c OR b.c + b.size = a.c) AND a.r < b.r + b.size AND b.r < a.r + a.size))""", "raster")
def g25(spark, d):
    kept, _ = H.subdivided(frame(spark, d, "raster"), 16, 2, 14.0)
    return H.touching(kept.select((F.col("r") * 100 + F.col("c")).alias("id"), "r", "c", "size"))


@query("r15_blind_hops", """
WITH k AS (SELECT r, c, z > 8 AS seen FROM raster)
SELECT r, c, seen OR coalesce(max(seen::INT) OVER (PARTITION BY r ORDER BY c RANGE BETWEEN 2 PRECEDING AND 1 PRECEDING) = 1 AND max(seen::INT) OVER (PARTITION BY r ORDER BY c RANGE BETWEEN 1 FOLLOWING AND 2 FOLLOWING) = 1, false)
  OR coalesce(max(seen::INT) OVER (PARTITION BY c ORDER BY r RANGE BETWEEN 2 PRECEDING AND 1 PRECEDING) = 1 AND max(seen::INT) OVER (PARTITION BY c ORDER BY r RANGE BETWEEN 1 FOLLOWING AND 2 FOLLOWING) = 1, false) AS admitted FROM k""", "raster")
def r15(spark, d):
    return H.closed(frame(spark, d, "raster").select("r", "c", (F.col("z") > 8).alias("seen")), 2)


@query("r21_pruned", """
WITH k AS (SELECT r, c FROM raster WHERE z > 13),
a AS (SELECT k.r, k.c FROM k JOIN k n ON abs(k.r - n.r) <= 1 AND abs(k.c - n.c) <= 1 AND (k.r <> n.r OR k.c <> n.c) GROUP BY k.r, k.c HAVING count(*) > 1)
SELECT a.r, a.c FROM a JOIN a n ON abs(a.r - n.r) <= 1 AND abs(a.c - n.c) <= 1 AND (a.r <> n.r OR a.c <> n.c) GROUP BY a.r, a.c HAVING count(*) > 1""", "raster")
def r21(spark, d):
    return H.pruned(frame(spark, d, "raster").where("z > 13"), 2)


@query("r23_spikes", """
SELECT a.r, a.c, a.z, median(b.z) AS median FROM raster a JOIN raster b ON abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 AND (a.r <> b.r OR a.c <> b.c) GROUP BY a.r, a.c, a.z HAVING abs(a.z - median(b.z)) > 7""", "raster")
def r23(spark, d):
    return H.spikes(frame(spark, d, "raster").select("r", "c", "z"), 7.0)


@query("r25_edge_invariant", "SELECT count(*) FILTER (WHERE z > 30) AS offending FROM raster WHERE r = 0", "raster")
def r25(spark, d):
    return frame(spark, d, "raster").where("r = 0").agg(F.count_if(F.col("z") > 30).alias("offending"))


@query("h5_join_rules", f"""
WITH best AS (SELECT p.id, min({_D}) AS gap FROM point p JOIN point q ON p.id <> q.id AND q.label = 4 GROUP BY p.id)
SELECT p.id, CASE WHEN gap <= 6 THEN 'inside' WHEN gap <= 18 THEN 'adjacent' WHEN gap <= 40 THEN 'needs trace' ELSE 'none' END AS rule FROM point p LEFT JOIN best USING (id)""", "point")
def h5(spark, d):
    p = frame(spark, d, "point")
    near = S.nearest_points(p, p.where("label = 4"), 40.0).select("id", "gap")
    g = F.col("gap")
    rule = F.when(g <= 6, "inside").when(g <= 18, "adjacent").when(g <= 40, "needs trace").otherwise("none")
    return p.select("id").join(near, "id", "left").select("id", rule.alias("rule"))


@query("h6_detour_ratio", """WITH RECURSIVE e AS (SELECT u, v, (u * 7 + v * 3) % 11 + 1 AS w FROM step),
walk AS (SELECT 0 AS node, 0 AS dist UNION SELECT e.v, k.dist + e.w FROM walk k JOIN e ON e.u = k.node WHERE k.dist + e.w <= 40)
SELECT node AS node_id, min(dist)::DOUBLE AS dist, round(min(dist)::DOUBLE / nullif(abs(node - 0), 0), 9) AS ratio FROM walk GROUP BY node""", "step")
def h6(spark, d):
    from netsounder.plans.graph import steps

    e = steps(spark, d).withColumn("length_m", F.col("length_m") + 1)
    got = G.shortest(e, spark.createDataFrame([(0,)], "node_id long"), 40.0)
    return got.select("node_id", "dist", F.round(X.share(F.col("dist"), F.abs("node_id").cast("double")), 9).alias("ratio"))


@query("h8_three_targets", f"""
SELECT p.id, CASE WHEN min({_D}) FILTER (WHERE q.label = 0) <= 10 THEN 'mesh' WHEN min({_D}) FILTER (WHERE q.label = 1) <= 15 THEN 'skeleton' WHEN min({_D}) FILTER (WHERE q.label = 2) <= 20 THEN 'coast' ELSE 'none' END AS target
FROM point p JOIN point q ON p.id <> q.id GROUP BY p.id""", "point")
def h8(spark, d):
    p = frame(spark, d, "point")
    out = p.select("id")
    for label, (name, radius) in enumerate((("mesh", 10.0), ("skeleton", 15.0), ("coast", 20.0))):
        hit = S.nearest_points(p, p.where(F.col("label") == label), radius).select("id", F.lit(name).alias(name))
        out = out.join(hit, "id", "left")
    return out.select("id", F.coalesce("mesh", "skeleton", "coast", F.lit("none")).alias("target"))


@query("h12_bridges", """WITH RECURSIVE e AS (SELECT least(u % 12, v % 12) AS a, greatest(u % 12, v % 12) AS b, min(((u * 7 + v) % 13) * 1000000 + u * 1000 + v) AS k FROM step WHERE u % 12 <> v % 12 GROUP BY 1, 2),
und AS (SELECT a, b, k FROM e UNION ALL SELECT b, a, k FROM e), reach AS (SELECT k AS id, a AS node, k, b AS goal FROM e UNION SELECT r.id, x.b, r.k, r.goal FROM reach r JOIN und x ON x.a = r.node AND x.k < r.k)
SELECT a, b, k % 1000000 AS member FROM e WHERE NOT EXISTS (SELECT 1 FROM reach r WHERE r.id = e.k AND r.node = r.goal)""", "step")
def h12(spark, d):
    from netsounder.plans.raster import QUERIES as grid

    best = grid["h17_shortest_member"](spark, d)
    forest = G.spanning_forest(best.select(F.col("member").alias("edge_id"), "a", "b", F.col("len").alias("w")))
    return forest.select("a", "b", F.col("edge_id").alias("member"))


@query("h13_drain_order", """WITH RECURSIVE und AS (SELECT u AS a, v AS b FROM step WHERE (u + v) % 2 = 0 UNION SELECT v, u FROM step WHERE (u + v) % 2 = 0), reach AS (SELECT a, a AS b FROM und UNION SELECT r.a, s.b FROM reach r JOIN und s ON r.b = s.a),
c AS (SELECT a AS node, min(b) AS part FROM reach GROUP BY a), bed AS (SELECT part, min((node * 37) % 101) AS bed, max((node * 37) % 101) AS sill FROM c GROUP BY part)
SELECT part, bed, sill, row_number() OVER (ORDER BY bed, part) AS place FROM bed""", "step")
def h13(spark, d):
    e = frame(spark, d, "step").where("(u + v) % 2 = 0").select(F.col("u").alias("from_node"), F.col("v").alias("to_node"))
    z = (F.col("node_id") * 37) % 101
    beds = G.weak_components(e).groupBy(F.col("component").alias("part")).agg(F.min(z).alias("bed"), F.max(z).alias("sill"))
    return running(beds, ["bed", "part"])[0].select("part", "bed", "sill", (F.col("before") + 1).alias("place"))


@query("h15_end_by_degree", """
WITH x AS (SELECT u AS k, v AS e FROM step UNION ALL SELECT v, u FROM step), g AS (SELECT k, e, count(*) AS n FROM x GROUP BY k, e), t AS (SELECT k, count(DISTINCT e) AS degree FROM x GROUP BY k)
SELECT k, min(e) AS partner, degree FROM g JOIN t USING (k) WHERE n = 2 GROUP BY k, degree""", "step")
def h15(spark, d):
    s = frame(spark, d, "step")
    x = s.select(F.col("u").alias("k"), F.col("v").alias("e")).union(s.select("v", "u"))
    both = x.groupBy("k", "e").agg(F.count("*").alias("n")).where("n = 2").groupBy("k").agg(F.min("e").alias("partner"))
    return both.join(x.groupBy("k").agg(F.countDistinct("e").alias("degree")), "k").select("k", "partner", "degree")


@query("q10_end_resolution", f"""
WITH e AS (SELECT id, x + 3 AS x, y + 2 AS y FROM point WHERE label = 7), n AS (SELECT p.id, q.id AS node, {_D} AS gap, row_number() OVER (PARTITION BY p.id ORDER BY {_D}, q.id) AS rn FROM e p JOIN point q ON q.label <> 7 AND {_D} <= 4),
t AS (SELECT p.id, l.line_id, min(sqrt((p.x - l.x1 - k.t * (l.x2 - l.x1)) ** 2 + (p.y - l.y1 - k.t * (l.y2 - l.y1)) ** 2)) AS gap FROM e p, leg l,
  LATERAL (SELECT greatest(0, least(1, ((p.x - l.x1) * (l.x2 - l.x1) + (p.y - l.y1) * (l.y2 - l.y1)) / ((l.x2 - l.x1) ** 2 + (l.y2 - l.y1) ** 2))) AS t) k GROUP BY p.id, l.line_id),
b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY gap, line_id) AS rn FROM t WHERE gap <= 10)
SELECT e.id, CASE WHEN n.node IS NOT NULL THEN 'node' WHEN b.line_id IS NOT NULL THEN 'split' ELSE 'unresolved' END AS how, coalesce(n.node, b.line_id) AS target
FROM e LEFT JOIN n ON n.id = e.id AND n.rn = 1 LEFT JOIN b ON b.id = e.id AND b.rn = 1""", "point", "leg")
def q10(spark, d):
    p = frame(spark, d, "point")
    ends = p.where("label = 7").select("id", (F.col("x") + 3).alias("x"), (F.col("y") + 2).alias("y"))
    return resolved_ends(ends, p.where("label <> 7"), frame(spark, d, "leg"), 4.0, 10.0)


def resolved_ends(ends, nodes, legs, snap: float, cut: float):
    """``(id, how, target)``: a node within ``snap``, else a line within ``cut`` to split there, else unresolved."""
    node = S.nearest_points(ends, nodes, snap).select("id", F.col("target").alias("node"))
    line = S.nearest_line(ends, legs, cut, 50.0).select("id", "line_id")
    how = F.when(F.col("node").isNotNull(), "node").when(F.col("line_id").isNotNull(), "split").otherwise("unresolved")
    return ends.select("id").join(node, "id", "left").join(line, "id", "left").select("id", how.alias("how"), F.coalesce("node", "line_id").alias("target"))


@query("q14_sea_routes", f"""WITH RECURSIVE {_MEETING}, e AS (SELECT a * 100000 + b AS edge_id, a, b, cost, row_number() OVER (ORDER BY cost, a * 100000 + b) AS k FROM met),
und AS (SELECT a, b, k FROM e UNION ALL SELECT b, a, k FROM e), reach AS (SELECT k AS id, a AS node, b AS goal FROM e UNION SELECT r.id, x.b, r.goal FROM reach r JOIN und x ON x.a = r.node AND x.k < r.id)
SELECT edge_id, a, b, round(cost, 6) AS w FROM e WHERE NOT EXISTS (SELECT 1 FROM reach r WHERE r.id = e.k AND r.node = r.goal)""", "raster")
def q14(spark, d):
    met = R.crossings(*spread(spark, d))
    return G.spanning_forest(met.select((F.col("a") * 100000 + F.col("b")).alias("edge_id"), "a", "b", F.col("cost").alias("w"))).withColumn("w", F.round("w", 6))


@query("q22_outlet_choice", f"""
WITH c AS (SELECT p.id, q.id AS target, {_D} AS gap, q.label - p.label AS fall, row_number() OVER (PARTITION BY p.id ORDER BY {_D}, q.id) AS rn FROM point p JOIN point q ON p.id <> q.id AND p.label <> q.label WHERE p.label = 3 AND {_D} <= 40 AND {_D} > 0)
SELECT id, target, fall FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rn) AS k FROM c WHERE rn <= 5 AND fall >= -2) WHERE k = 1""", "point")
def q22(spark, d):
    p = frame(spark, d, "point")
    near = S.nearest_points(p.where("label = 3"), p.where("label <> 3"), 40.0, 5).where("gap > 0")
    labelled = near.join(p.select(F.col("id").alias("target"), "label"), "target").withColumn("fall", F.col("label") - 3)
    return X.first_by(labelled.where("fall >= -2"), ["id"], [F.asc("gap"), F.asc("target")]).select("id", "target", "fall")


@query("q24_inspect", f"SELECT target, gap FROM (SELECT q.id AS target, round({_D}, 6) AS gap, row_number() OVER (ORDER BY {_D}, q.id) AS rn FROM point p JOIN point q ON p.id = 17 AND q.id <> 17 WHERE {_D} <= 200) WHERE rn <= 12", "point")
def q24(spark, d):
    p = frame(spark, d, "point")
    return S.nearest_points(p.where("id = 17"), p, 200.0, 12).select("target", F.round("gap", 6).alias("gap"))


@query("q28_rule_list", """
SELECT p_partkey AS rule, p_brand AS owner, EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45) AS evidenced FROM part WHERE p_size < 10 AND p_brand LIKE '%1%'""")
def q28(spark, d):
    seen = frame(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"), F.lit(True).alias("s")).distinct()
    rules = frame(spark, d, "part").where("p_size < 10 and p_brand like '%1%'")
    return rules.join(seen, "p_partkey", "left").select(F.col("p_partkey").alias("rule"), F.col("p_brand").alias("owner"), F.coalesce("s", F.lit(False)).alias("evidenced"))


@query("v2_network_view", """
SELECT leg_id, line_id FROM leg WHERE least(x1, x2) <= 100 AND greatest(x1, x2) >= -50 AND least(y1, y2) <= 80 AND greatest(y1, y2) >= -80
  AND (line_id % 7 = 0 OR sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2) >= 120)""", "leg")
def v2(spark, d):
    from netsounder.sources.files import read_boxed

    boxed = frame(spark, d, "leg").select("*", F.least("x1", "x2").alias("xmin"), F.greatest("x1", "x2").alias("xmax"), F.least("y1", "y2").alias("ymin"), F.greatest("y1", "y2").alias("ymax"))
    kept = (F.col("line_id") % 7 == 0) | (S.distance(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")) >= 120)
    return read_boxed(boxed, -50.0, -80.0, 100.0, 80.0).where(kept).select("leg_id", "line_id")
