"""Raster, hydrology and grid queries over derived cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from netsounder.operators import grids as H
from netsounder.operators import raster as R
from netsounder.plans.derived import frame, registrar

QUERIES: dict = {}
ORACLES: dict = {}
query = registrar(QUERIES, ORACLES)

_EIGHT = "abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 AND (a.r <> b.r OR a.c <> b.c)"


@query("r1_sample", """
SELECT id, n FROM (SELECT id, CAST(floor((40 - y) / 10) AS BIGINT) AS r, CAST(floor((x + 60) / 10) AS BIGINT) AS c FROM point) p
LEFT JOIN (SELECT r AS cr, c AS cc, n FROM cell) k ON cr = r AND cc = c""", "point", "cell")
def r1(spark, d):
    return R.sampled(frame(spark, d, "point"), frame(spark, d, "cell"), "n", -60.0, 40.0, 10.0).select("id", "n")


@query("r2_r3_window_percentile", """
SELECT p.id, count(*) AS valid, round(quantile_cont(z, 0.1), 6) AS low, CASE WHEN count(*) < 6 THEN 'too few cells' WHEN count(*) FILTER (WHERE z <> 0) = 0 THEN 'all zero' ELSE 'ok' END AS verdict
FROM point p JOIN raster k ON k.r BETWEEN abs(CAST(floor(p.x) AS BIGINT)) % 16 - 1 AND abs(CAST(floor(p.x) AS BIGINT)) % 16 + 1
  AND k.c BETWEEN abs(CAST(floor(p.y) AS BIGINT)) % 16 - 1 AND abs(CAST(floor(p.y) AS BIGINT)) % 16 + 1 GROUP BY p.id""", "point", "raster")
def r2(spark, d):
    at = lambda c: F.abs(F.floor(F.col(c))) % 16
    p = frame(spark, d, "point").select("id", at("x").alias("r"), at("y").alias("c"))
    return H.guarded_sample(p, frame(spark, d, "raster"), 1, 6)


@query("r6_cost_surface", "SELECT r, c, round(least(25, greatest(1, 50 / greatest(z, 2))), 9) AS cost FROM raster", "raster")
def r6(spark, d):
    return frame(spark, d, "raster").select("r", "c", F.round(R.sea_cost(F.col("z")), 9).alias("cost"))


@query("r7_regions", """WITH RECURSIVE k AS (SELECT r, c, r * 4294967296 + c AS id FROM raster WHERE z > 9),
p AS (SELECT a.id AS a, b.id AS b FROM k a JOIN k b ON abs(a.r - b.r) + abs(a.c - b.c) = 1),
reach AS (SELECT id AS a, id AS b FROM k UNION SELECT x.a, p.b FROM reach x JOIN p ON p.a = x.b)
SELECT k.r, k.c, min(x.b) AS region FROM reach x JOIN k ON k.id = x.a GROUP BY k.r, k.c""", "raster")
def r7(spark, d):
    return R.regions(frame(spark, d, "raster").where("z > 9").select("r", "c"))


@query("r8_snap_circular", """
SELECT p.id, k.r, k.c, k.d2 FROM (SELECT vec_id AS id, vec_id % 16 AS pr, CAST(floor(vec_id / 16) AS BIGINT) % 16 AS pc FROM embeddings) p
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, r, c) AS rn FROM (
  SELECT q.vec_id AS id, k.r, k.c, (k.r - q.vec_id % 16) * (k.r - q.vec_id % 16) + (k.c - CAST(floor(q.vec_id / 16) AS BIGINT) % 16) * (k.c - CAST(floor(q.vec_id / 16) AS BIGINT) % 16) AS d2
  FROM embeddings q, raster k WHERE k.z > 18) y WHERE d2 <= 9) k ON k.id = p.id AND k.rn = 1""", "raster")
def r8(spark, d):
    p = frame(spark, d, "embeddings").select(F.col("vec_id").alias("id"), (F.col("vec_id") % 16).alias("r"), (F.floor(F.col("vec_id") / 16) % 16).alias("c"))
    return R.snapped(p, frame(spark, d, "raster").where("z > 18"), 3)


# cost distance from a source in each block of 8 by 8: the best (distance, source) of each cell after so many moves
_SPREAD = """k AS (SELECT r, c, least(25, greatest(1, 50 / greatest(z, 2))) AS cost FROM raster),
m AS (SELECT a.r AS ar, a.c AS ac, b.r AS br, b.c AS bc, CASE WHEN a.r <> b.r AND a.c <> b.c THEN sqrt(2.0::DOUBLE) ELSE 1 END * (a.cost + b.cost) / 2 AS w FROM k a JOIN k b ON abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 AND (a.r <> b.r OR a.c <> b.c)),
walk AS (SELECT r, c, 0.0::DOUBLE AS dist, r * 100 + c AS source, 0 AS hops FROM k WHERE r % 8 = 0 AND c % 8 = 0
  UNION ALL SELECT r, c, best.dist, best.source, hops FROM (SELECT m.br AS r, m.bc AS c, min({'dist': round(x.dist + m.w, 9), 'source': x.source}) AS best, x.hops + 1 AS hops FROM walk x JOIN m ON m.ar = x.r AND m.ac = x.c WHERE x.hops < 24 GROUP BY m.br, m.bc, x.hops) z),
got AS (SELECT r, c, best.dist AS dist, best.source AS source FROM (SELECT r, c, min({'dist': dist, 'source': source}) AS best FROM walk GROUP BY r, c))"""


def spread(spark, d):
    """The raster's cells by their nearest source in cost, and the costs."""
    costs = frame(spark, d, "raster").select("r", "c", R.sea_cost(F.col("z")).alias("cost"))
    return R.allocated(costs, costs.where("r % 8 = 0 and c % 8 = 0").select("r", "c", (F.col("r") * 100 + F.col("c")).alias("id"))), costs


@query("r9_allocation", f"WITH RECURSIVE {_SPREAD} SELECT r, c, round(dist, 6) AS dist, source FROM got", "raster")
def r9(spark, d):
    return spread(spark, d)[0].select("r", "c", F.round("dist", 6).alias("dist"), "source")


_MEETING = _SPREAD + """, met AS (SELECT least(x.source, y.source) AS a, greatest(x.source, y.source) AS b, min(round(x.dist + y.dist + m.w, 9)) AS cost
  FROM got x JOIN m ON m.ar = x.r AND m.ac = x.c JOIN got y ON y.r = m.br AND y.c = m.bc WHERE x.source <> y.source GROUP BY 1, 2)"""


@query("r10_crossings", f"WITH RECURSIVE {_MEETING} SELECT a, b, round(cost, 6) AS cost FROM met", "raster")
def r10(spark, d):
    return R.crossings(*spread(spark, d)).select("a", "b", F.round("cost", 6).alias("cost"))


@query("r11_backlink_walk", f"WITH RECURSIVE {_SPREAD} SELECT r, c, (source // 100) * 4294967296 + source % 100 AS basin FROM got", "raster")
def r11(spark, d):
    return R.watersheds(spread(spark, d)[0].select("r", "c", F.col("br").alias("tr"), F.col("bc").alias("tc")))


@query("r12_distance_transform", """
SELECT a.r, a.c, CASE WHEN min((a.r - b.r) ** 2 + (a.c - b.c) ** 2) <= 16 THEN CAST(min((a.r - b.r) ** 2 + (a.c - b.c) ** 2) AS BIGINT) END AS d2 FROM raster a, raster b WHERE b.z > 18 GROUP BY a.r, a.c""", "raster")
def r12(spark, d):
    z = frame(spark, d, "raster")
    return R.distance_transform(z, z.where("z > 18"), 4)


@query("r13_dilation", "SELECT DISTINCT a.r + i.i AS r, a.c + j.j AS c FROM raster a, (VALUES (-1), (0), (1)) i(i), (VALUES (-1), (0), (1)) j(j) WHERE a.z > 18", "raster")
def r13(spark, d):
    return R.dilated(frame(spark, d, "raster").where("z > 18"), 1)


@query("r14_visibility_bands", """
SELECT a.r, a.c, max(b.z) AS height FROM raster a JOIN raster b ON b.z > 15 AND (a.r - b.r) ** 2 + (a.c - b.c) ** 2 <= (b.z / 5) ** 2 GROUP BY a.r, a.c""", "raster")
def r14(spark, d):
    z = frame(spark, d, "raster")
    return H.visible(z.select("r", "c"), z.where("z > 15").select("r", "c", F.col("z").alias("height"), (F.col("z") / 5).alias("reach")))


@query("r16_pit_fill", f"""WITH RECURSIVE m AS (SELECT a.r AS ar, a.c AS ac, b.r, b.c, b.z FROM raster a JOIN raster b ON {_EIGHT}),
walk AS (SELECT r, c, z AS w, 0 AS hops FROM raster k WHERE (SELECT count(*) FROM m WHERE m.ar = k.r AND m.ac = k.c) < 8
  UNION ALL SELECT r, c, w, hops FROM (SELECT m.r, m.c, min(greatest(m.z, x.w)) AS w, x.hops + 1 AS hops FROM walk x JOIN m ON m.ar = x.r AND m.ac = x.c WHERE x.hops < 64 GROUP BY m.r, m.c, x.hops) y)
SELECT r, c, min(w) AS z FROM walk GROUP BY r, c""", "raster")
def r16(spark, d):
    return R.filled(frame(spark, d, "raster"))


@query("r17_steepest", f"""
SELECT k.r, k.c, d.tr, d.tc, d.fall AS drop FROM raster k LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY fall DESC, tr, tc) AS rn FROM (
    SELECT a.r, a.c, b.r AS tr, b.c AS tc, round((a.z - b.z) / CASE WHEN a.r <> b.r AND a.c <> b.c THEN sqrt(2.0) ELSE 1 END, 9) AS fall FROM raster a JOIN raster b ON {_EIGHT}) f
  WHERE fall > 0) d ON d.r = k.r AND d.c = k.c AND d.rn = 1""", "raster")
def r17(spark, d):
    return R.steepest(frame(spark, d, "raster").select("r", "c", "z"))


_PTR = f"""ptr AS (SELECT k.r * 100 + k.c AS n, d.t FROM raster k LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY n ORDER BY fall DESC, t) AS rn FROM (SELECT a.r * 100 + a.c AS n, b.r * 100 + b.c AS t,
    round((a.z - b.z) / CASE WHEN a.r <> b.r AND a.c <> b.c THEN sqrt(2.0) ELSE 1 END, 9) AS fall FROM raster a JOIN raster b ON {_EIGHT}) f WHERE fall > 0) d ON d.n = k.r * 100 + k.c AND d.rn = 1),
walk AS (SELECT n AS start, n FROM ptr UNION ALL SELECT w.start, p.t FROM walk w JOIN ptr p ON p.n = w.n WHERE p.t IS NOT NULL)"""


@query("r18_accumulation", f"WITH RECURSIVE {_PTR} SELECT CAST(floor(n / 100) AS BIGINT) AS r, n % 100 AS c, count(*) AS cells FROM walk GROUP BY n", "raster")
def r18(spark, d):
    return R.accumulated(R.steepest(frame(spark, d, "raster").select("r", "c", "z")))


@query("r19_watershed", f"WITH RECURSIVE {_PTR} SELECT CAST(floor(start / 100) AS BIGINT) AS r, start % 100 AS c, CAST(floor(w.n / 100) AS BIGINT) * 4294967296 + w.n % 100 AS basin FROM walk w JOIN ptr p ON p.n = w.n AND p.t IS NULL", "raster")
def r19(spark, d):
    return R.watersheds(R.steepest(frame(spark, d, "raster").select("r", "c", "z")))


@query("r20_grooves", """
SELECT r, c, 'c' AS axis FROM (SELECT *, max(z) OVER b AS mb, max(z) OVER a AS ma, min(z) OVER b AS lb, min(z) OVER a AS la FROM raster
  WINDOW b AS (PARTITION BY r ORDER BY c ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), a AS (PARTITION BY r ORDER BY c ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING)) x WHERE mb > z AND ma > z AND lb > z AND la > z
UNION ALL SELECT r, c, 'r' FROM (SELECT *, max(z) OVER b AS mb, max(z) OVER a AS ma, min(z) OVER b AS lb, min(z) OVER a AS la FROM raster
  WINDOW b AS (PARTITION BY c ORDER BY r ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), a AS (PARTITION BY c ORDER BY r ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING)) y WHERE mb > z AND ma > z AND lb > z AND la > z""", "raster")
def r20(spark, d):
    return R.grooves(frame(spark, d, "raster").select("r", "c", "z"), 2)


@query("r22_coverage_gaps", "SELECT round(avg(CASE WHEN z < 3 THEN 1.0 ELSE 0 END), 9) AS zero_share, count(*) FILTER (WHERE z < 3) AS zeros FROM raster", "raster")
def r22(spark, d):
    low = F.col("z") < 3
    return frame(spark, d, "raster").agg(F.round(F.avg(low.cast("double")), 9).alias("zero_share"), F.count_if(low).alias("zeros"))


@query("r24_sea_margin", f"SELECT DISTINCT a.r, a.c, least(a.z, -100.0) AS z FROM raster a JOIN raster b ON abs(a.r - b.r) <= 2 AND abs(a.c - b.c) <= 2 AND b.z < 1.5", "raster")
def r24(spark, d):
    z = frame(spark, d, "raster")
    margin = R.dilated(z.where("z < 1.5"), 2)
    return z.join(margin, ["r", "c"]).select("r", "c", F.least("z", F.lit(-100.0)).alias("z"))


@query("s12_resample", """
SELECT CAST(floor(r / 3.0) AS BIGINT) AS r, CAST(floor(c / 3.0) AS BIGINT) AS c, round(avg(z), 6) AS mean, max(z) AS most FROM raster GROUP BY 1, 2""", "raster")
def s12(spark, d):
    return R.reduced(frame(spark, d, "raster"), 3, mean=F.round(F.avg("z"), 6), most=F.max("z"))


@query("h1_hex_cells", """
WITH f AS (SELECT (sqrt(3.0::DOUBLE) / 3 * x - y / 3) / 20 AS q, (y * 2 / 3) / 20 AS s FROM point),
k AS (SELECT q, s, round(q) AS rq, round(s) AS rs, round(-q - s) AS rt FROM f),
e AS (SELECT *, abs(rq - q) AS dq, abs(rs - s) AS ds, abs(rt - (-q - s)) AS dt FROM k)
SELECT CASE WHEN dq > ds AND dq > dt THEN -rs - rt ELSE rq END::BIGINT AS q,
  CASE WHEN dq > ds AND dq > dt THEN rs WHEN ds > dt THEN -rq - rt ELSE rs END::BIGINT AS s, count(*) AS n FROM e GROUP BY 1, 2""", "point")
def h1(spark, d):
    p = frame(spark, d, "point").withColumn("h", H.hex_of(F.col("x"), F.col("y"), 20.0))
    return p.groupBy("h.q", "h.s").agg(F.count("*").alias("n"))


@query("h2_subdivision_ledger", """
WITH RECURSIVE t AS (SELECT DISTINCT 0 AS level, r // 16 * 16 AS r, c // 16 * 16 AS c, 16 AS size FROM raster UNION ALL SELECT t.level + 1, t.r + i.i * t.size // 2, t.c + j.j * t.size // 2, t.size // 2
  FROM t, (VALUES (0), (1)) i(i), (VALUES (0), (1)) j(j) WHERE t.size > 2 AND (SELECT max(z) - min(z) FROM raster k WHERE k.r >= t.r AND k.r < t.r + t.size AND k.c >= t.c AND k.c < t.c + t.size) > 14)
SELECT level, count(*) AS tested, count(*) FILTER (WHERE size > 2 AND (SELECT max(z) - min(z) FROM raster k WHERE k.r >= t.r AND k.r < t.r + t.size AND k.c >= t.c AND k.c < t.c + t.size) > 14) AS split FROM t GROUP BY level""", "raster")
def h2(spark, d):
    return H.subdivided(frame(spark, d, "raster"), 16, 2, 14.0)[1]


@query("h4_adjacency", "SELECT a.r * 100 + a.c AS a, b.r * 100 + b.c AS b FROM raster a JOIN raster b ON abs(a.r - b.r) + abs(a.c - b.c) = 1 AND a.r * 100 + a.c < b.r * 100 + b.c WHERE abs(a.z - b.z) < 6", "raster")
def h4(spark, d):
    z = frame(spark, d, "raster")
    met = R.shifted(z, R.FOUR, z="w").join(z, ["r", "c"]).where(F.abs(F.col("w") - F.col("z")) < 6)
    return met.select((F.col("fr") * 100 + F.col("fc")).alias("a"), (F.col("r") * 100 + F.col("c")).alias("b")).where("a < b")


@query("h9_medians_by_box", """
SELECT CASE WHEN r < 8 AND c < 8 THEN 'nw' WHEN r < 8 THEN 'ne' WHEN c < 8 THEN 'sw' ELSE 'se' END AS coast, median(z) AS z FROM raster GROUP BY 1""", "raster")
def h9(spark, d):
    box = F.when((F.col("r") < 8) & (F.col("c") < 8), "nw").when(F.col("r") < 8, "ne").when(F.col("c") < 8, "sw").otherwise("se")
    return frame(spark, d, "raster").groupBy(box.alias("coast")).agg(F.median("z").alias("z"))


@query("h14_stamps", "SELECT o_orderpriority AS stamp FROM orders GROUP BY o_orderpriority HAVING count(DISTINCT o_orderstatus) > 1")
def h14(spark, d):
    return H.conflicting(frame(spark, d, "orders").select(F.col("o_orderpriority").alias("stamp"), F.col("o_orderstatus").alias("sha")), "stamp", "sha")


@query("h17_shortest_member", """
SELECT a, b, member, len FROM (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY len, member) AS rn FROM (
  SELECT least(u % 12, v % 12) AS a, greatest(u % 12, v % 12) AS b, u * 1000 + v AS member, (u * 7 + v) % 13 AS len FROM step WHERE u % 12 <> v % 12) x) y WHERE rn = 1""", "step")
def h17(spark, d):
    s = frame(spark, d, "step").select((F.col("u") % 12).alias("p"), (F.col("v") % 12).alias("q"), (F.col("u") * 1000 + F.col("v")).alias("member"), ((F.col("u") * 7 + F.col("v")) % 13).alias("len")).where("p <> q")
    best = s.groupBy(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).agg(F.min(F.struct("len", "member")).alias("m"))
    return best.select("a", "b", "m.member", "m.len")


@query("h18_ring_class", """
SELECT a.r, a.c, CASE WHEN min(greatest(abs(a.r - b.r), abs(a.c - b.c))) <= 2 THEN min(greatest(abs(a.r - b.r), abs(a.c - b.c))) END AS ring FROM raster a, raster b WHERE b.z > 18 GROUP BY a.r, a.c""", "raster")
def h18(spark, d):
    z = frame(spark, d, "raster")
    return H.ring_class(z.select("r", "c"), z.where("z > 18").select("r", "c"), 2)
