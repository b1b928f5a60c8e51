"""Spatial queries over points and five-point lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from netsounder.functions import ids
from netsounder.operators import graph as G
from netsounder.operators import spatial as S
from netsounder.plans.derived import frame, registrar

QUERIES: dict = {}
ORACLES: dict = {}
query = registrar(QUERIES, ORACLES)

_D = "sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y))"
_PS = """WITH t AS (
  SELECT p.id, l.line_id, p.x AS px, p.y AS py, l.x1, l.y1, l.x2, l.y2, CAST(floor(p.id / 5) AS BIGINT) AS own,
    greatest(0, least(1, ((p.x - l.x1) * (l.x2 - l.x1) + (p.y - l.y1) * (l.y2 - l.y1))
      / ((l.x2 - l.x1) * (l.x2 - l.x1) + (l.y2 - l.y1) * (l.y2 - l.y1)))) AS t
  FROM point p JOIN leg l ON l.line_id <> CAST(floor(p.id / 5) AS BIGINT)),
g AS (SELECT id, line_id, min(sqrt((px - x1 - t * (x2 - x1)) * (px - x1 - t * (x2 - x1)) + (py - y1 - t * (y2 - y1)) * (py - y1 - t * (y2 - y1)))) AS gap
  FROM t GROUP BY id, line_id)
"""


def _own():
    return F.floor(F.col("id") / 5).cast("long")


@query("j7_grid_pairs", f"SELECT p.id AS a, q.id AS b, round({_D}, 6) AS gap FROM point p JOIN point q ON p.id < q.id WHERE {_D} <= 5", "point")
def j7(spark, d):
    return S.near_pairs(frame(spark, d, "point"), 5.0).select("a", "b", F.round("gap", 6).alias("gap"))


@query("j8_points_near_lines", _PS + "SELECT id, line_id, round(gap, 6) AS gap FROM g WHERE gap <= 3", "point", "leg")
def j8(spark, d):
    return S.points_near_lines(frame(spark, d, "point"), frame(spark, d, "leg"), 3.0, 50.0, _own()).select("id", "line_id", F.round("gap", 6).alias("gap"))


@query("j9_nearest_line", _PS + """SELECT id, line_id, round(gap, 6) AS gap FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY gap, line_id) AS rn FROM g WHERE gap <= 8) WHERE rn = 1""", "point", "leg")
def j9(spark, d):
    return S.nearest_line(frame(spark, d, "point"), frame(spark, d, "leg"), 8.0, 50.0, _own()).select("id", "line_id", F.round("gap", 6).alias("gap"))


_SIDE = "({b}x - {a}x) * ({p}y - {a}y) - ({b}y - {a}y) * ({p}x - {a}x)"
_CROSS = """((b.x2 - b.x1) * (a.y1 - b.y1) - (b.y2 - b.y1) * (a.x1 - b.x1)) * ((b.x2 - b.x1) * (a.y2 - b.y1) - (b.y2 - b.y1) * (a.x2 - b.x1)) < 0
  AND ((a.x2 - a.x1) * (b.y1 - a.y1) - (a.y2 - a.y1) * (b.x1 - a.x1)) * ((a.x2 - a.x1) * (b.y2 - a.y1) - (a.y2 - a.y1) * (b.x2 - a.x1)) < 0"""


@query("j14_line_crossings", f"SELECT a.leg_id AS a, b.leg_id AS b FROM leg a JOIN leg b ON a.leg_id < b.leg_id AND a.line_id <> b.line_id WHERE {_CROSS}", "leg")
def j14(spark, d):
    return S.line_crossings(frame(spark, d, "leg"), 100.0)


def _psd(p: str, s: str) -> str:
    t = f"greatest(0, least(1, (({p}x - {s}x1) * ({s}x2 - {s}x1) + ({p}y - {s}y1) * ({s}y2 - {s}y1)) / (({s}x2 - {s}x1) ** 2 + ({s}y2 - {s}y1) ** 2)))"
    return f"sqrt(({p}x - {s}x1 - {t} * ({s}x2 - {s}x1)) ** 2 + ({p}y - {s}y1 - {t} * ({s}y2 - {s}y1)) ** 2)"


_ENDS = {"a.1": ("a.x1", "a.y1", "b."), "a.2": ("a.x2", "a.y2", "b."), "b.1": ("b.x1", "b.y1", "a."), "b.2": ("b.x2", "b.y2", "a.")}
_SEG = "least(" + ", ".join(_psd("@", s).replace("@x", x).replace("@y", y) for x, y, s in _ENDS.values()) + ")"


@query("j10_nearest_line_to_line", f"""
WITH g AS (SELECT a.line_id AS line_id, b.line_id AS other, min(CASE WHEN {_CROSS} THEN 0 ELSE {_SEG} END) AS gap
  FROM leg a JOIN leg b ON a.line_id <> b.line_id GROUP BY 1, 2)
SELECT line_id, other, round(gap, 6) AS gap FROM (SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY gap, other) AS rn FROM g WHERE gap <= 20) WHERE rn <= 2""", "leg")
def j10(spark, d):
    return S.nearest_lines(frame(spark, d, "leg"), 20.0, 100.0, 2).select("line_id", "other", F.round("gap", 6).alias("gap"))


@query("j11_nearest_of_set", f"""
SELECT id, target, round(gap, 6) AS gap FROM (SELECT p.id, q.id AS target, {_D} AS gap, row_number() OVER (PARTITION BY p.id ORDER BY {_D}, q.id) AS rn
  FROM point p JOIN point q ON p.id <> q.id AND q.label IN (1, 2) WHERE {_D} <= 30) WHERE rn = 1""", "point")
def j11(spark, d):
    p = frame(spark, d, "point")
    return S.nearest_points(p, p.where("label in (1, 2)"), 30.0).select("id", "target", F.round("gap", 6).alias("gap"))


@query("j12_k_nearest", f"""
SELECT id, target, round(gap, 6) AS gap FROM (SELECT p.id, q.id AS target, {_D} AS gap, row_number() OVER (PARTITION BY p.id ORDER BY {_D}, q.id) AS rn
  FROM point p JOIN point q ON p.id <> q.id AND p.label <> q.label WHERE {_D} <= 25 AND p.label = 3) WHERE rn <= 3""", "point")
def j12(spark, d):
    p = frame(spark, d, "point")
    return S.nearest_points(p.where("label = 3"), p.where("label <> 3"), 25.0, 3).select("id", "target", F.round("gap", 6).alias("gap"))


@query("j13_nearest_description", f"""
SELECT id, label, round(gap, 6) AS gap FROM (SELECT p.id, q.label, {_D} AS gap, row_number() OVER (PARTITION BY p.id ORDER BY {_D}, q.id) AS rn
  FROM point p JOIN point q ON p.id <> q.id WHERE {_D} <= 15) WHERE rn = 1""", "point")
def j13(spark, d):
    p = frame(spark, d, "point")
    near = S.nearest_points(p, p, 15.0)
    return near.join(p.select(F.col("id").alias("target"), "label"), "target").select("id", "label", F.round("gap", 6).alias("gap"))


@query("j17_nearest_unbounded", f"""
SELECT id, target, round(gap, 6) AS gap FROM (SELECT p.id, q.id AS target, {_D} AS gap, row_number() OVER (PARTITION BY p.id ORDER BY {_D}, q.id) AS rn
  FROM point p JOIN point q ON p.id <> q.id AND q.label = 0) WHERE rn = 1""", "point")
def j17(spark, d):
    p = frame(spark, d, "point")
    return S.nearest_any(p, p.where("label = 0"), 20.0).select("id", "target", F.round("gap", 6).alias("gap"))


_RING = "SELECT DISTINCT line_id AS ring, x1, y1, x2, y2 FROM leg UNION ALL SELECT a.line_id, b.x2, b.y2, a.x1, a.y1 FROM leg a JOIN leg b ON a.line_id = b.line_id AND a.leg_id % 5 = 0 AND b.leg_id % 5 = 3"


@query("j18_point_in_polygon", f"""
WITH e AS ({_RING})
SELECT id, ring FROM point p JOIN e ON (y1 > p.y) <> (y2 > p.y) AND p.x < (x2 - x1) * (p.y - y1) / (y2 - y1) + x1
GROUP BY id, ring HAVING count(*) % 2 = 1""", "point", "leg")
def j18(spark, d):
    leg = frame(spark, d, "leg")
    close = leg.where("leg_id % 5 = 0").select("line_id", F.col("x1").alias("tx"), F.col("y1").alias("ty"))
    last = leg.where("leg_id % 5 = 3").select("line_id", F.col("x2").alias("fx"), F.col("y2").alias("fy"))
    shut = last.join(close, "line_id").select(F.col("line_id").alias("ring"), F.col("fx").alias("x1"), F.col("fy").alias("y1"), F.col("tx").alias("x2"), F.col("ty").alias("y2"))
    rings = leg.select(F.col("line_id").alias("ring"), "x1", "y1", "x2", "y2").distinct().unionByName(shut)
    return S.inside(frame(spark, d, "point"), rings, 50.0)


@query("j21_range_argmax", """
SELECT id, max(label * 100000 - other) AS best FROM (SELECT p.id, q.id AS other, q.label FROM point p JOIN point q
  ON p.id <> q.id AND sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y)) <= 4 * q.label) s GROUP BY id""", "point")
def j21(spark, d):
    p = frame(spark, d, "point")
    q = p.select(F.col("id").alias("other"), F.col("x").alias("qx"), F.col("y").alias("qy"), "label")
    met = S._around(p.select("id", "x", "y"), "x", "y", 40.0).join(S._own(q, "qx", "qy", 40.0), ["_cx", "_cy"]).where("id <> other")
    met = met.where(S.distance(F.col("x"), F.col("y"), F.col("qx"), F.col("qy")) <= 4 * F.col("label"))
    return met.groupBy("id").agg(F.max(F.col("label") * 100000 - F.col("other")).alias("best"))


@query("j24_agreement_by_place", f"""
SELECT p.id, count(*) AS near, count(*) FILTER (WHERE q.label = p.label) AS same, bool_or(q.label = 9) AS any_nine
FROM point p JOIN point q ON p.id <> q.id AND {_D} <= 12 GROUP BY p.id""", "point")
def j24(spark, d):
    p = frame(spark, d, "point")
    pairs = S.near_pairs(p, 12.0).select("a", "b")
    both = pairs.union(pairs.select("b", "a")).toDF("id", "q")
    l = p.select("id", "label")
    met = both.join(l, "id").join(l.toDF("q", "ql"), "q")
    return met.groupBy("id").agg(F.count("*").alias("near"), F.count_if(F.col("ql") == F.col("label")).alias("same"), F.bool_or(F.col("ql") == 9).alias("any_nine"))


@query("p2_line_measures", """
SELECT line_id, round(sum(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))), 6) AS length_m, count(*) + 1 AS vertices,
  round(min(least(x1, x2)), 6) AS xmin, round(max(greatest(y1, y2)), 6) AS ymax FROM leg GROUP BY line_id""", "leg")
def p2(spark, d):
    pts = _lines(spark, d)
    xs, ys = F.transform("pts", lambda p: p["x"]), F.transform("pts", lambda p: p["y"])
    return pts.select(
        "line_id", F.round(S.length(F.col("pts")), 6).alias("length_m"), F.size("pts").cast("long").alias("vertices"),
        F.round(F.array_min(xs), 6).alias("xmin"), F.round(F.array_max(ys), 6).alias("ymax"),
    )


def _chains(spark, d):
    """The points of each line in order, also where there is but one."""
    p = frame(spark, d, "point").withColumn("line_id", _own())
    pts = F.transform(F.array_sort(F.collect_list(F.struct("id", "x", "y"))), lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y")))
    return p.groupBy("line_id").agg(pts.alias("pts"))


def _lines(spark, d):
    return _chains(spark, d).join(frame(spark, d, "leg").select("line_id").distinct(), "line_id", "left_semi")


@query("p4_split_midway", """
WITH m AS (SELECT *, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS len FROM leg),
c AS (SELECT *, sum(len) OVER (PARTITION BY line_id ORDER BY leg_id) - len AS begin_m, sum(len) OVER (PARTITION BY line_id) / 2 AS half FROM m)
SELECT line_id, round(x1 + (half - begin_m) / len * (x2 - x1), 5) AS x, round(y1 + (half - begin_m) / len * (y2 - y1), 5) AS y,
  round(half, 5) AS head_m, round(half, 5) AS tail_m FROM c WHERE begin_m <= half AND half < begin_m + len""", "leg")
def p4(spark, d):
    half = S.length(F.col("pts")) / 2
    head, tail = S.split(F.col("pts"), F.col("half"))
    cut = _lines(spark, d).withColumn("half", half).select("line_id", head.alias("head"), tail.alias("tail"))
    at = F.element_at("tail", 1)
    return cut.select("line_id", F.round(at["x"], 5).alias("x"), F.round(at["y"], 5).alias("y"), F.round(S.length(F.col("head")), 5).alias("head_m"), F.round(S.length(F.col("tail")), 5).alias("tail_m"))


@query("p11_midline_point", """
WITH m AS (SELECT *, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS len FROM leg),
c AS (SELECT *, sum(len) OVER (PARTITION BY line_id ORDER BY leg_id) - len AS b, sum(len) OVER (PARTITION BY line_id) / 2 AS half FROM m)
SELECT line_id, round(x1 + (half - b) / len * (x2 - x1), 5) AS x, round(y1 + (half - b) / len * (y2 - y1), 5) AS y FROM c WHERE b <= half AND half < b + len""", "leg")
def p11(spark, d):
    at = S.interpolated(F.col("pts"), S.length(F.col("pts")) / 2)
    return _lines(spark, d).select("line_id", at.alias("p")).select("line_id", F.round("p.x", 5).alias("x"), F.round("p.y", 5).alias("y"))


@query("x8_x12_identifiers", """
SELECT id, 'ns:node/' || substr(sha256('node|' || printf('%.3f', x) || ',' || printf('%.3f', y)), 1, 12) AS node_id,
  'src:point/' || id AS publisher_id, CAST(id AS VARCHAR) AS publisher_key FROM point""", "point")
def x8(spark, d):
    p = frame(spark, d, "point")
    pub = ids.publisher("point", F.col("id"))
    return p.select("id", ids.point(F.col("x"), F.col("y")).alias("node_id"), pub.alias("publisher_id"), ids.publisher_key(pub).alias("publisher_key"))


@query("x2_great_circle", """
SELECT id, round(6371000 * acos(least(1, greatest(-1, sin(radians(y / 10)) * sin(radians(50)) + cos(radians(y / 10)) * cos(radians(50)) * cos(radians(x / 10 + 3))))), 3) AS metres FROM point""", "point")
def x2(spark, d):
    from netsounder.functions.maths import great_circle

    return frame(spark, d, "point").select("id", F.round(great_circle(F.col("y") / 10, F.col("x") / 10, F.lit(50.0), F.lit(-3.0)), 3).alias("metres"))


@query("x3_horizon_cost", """
SELECT id, round(sqrt(2 * 6371000 * 1.13 * abs(y)), 6) AS horizon, round(least(25, greatest(1, 50 / greatest(x, 2))), 6) AS cost FROM point""", "point")
def x3(spark, d):
    from netsounder.functions.maths import horizon
    from netsounder.operators.raster import sea_cost

    return frame(spark, d, "point").select("id", F.round(horizon(F.abs("y")), 6).alias("horizon"), F.round(sea_cost(F.col("x")), 6).alias("cost"))


@query("x4_x5_text_classes", r"""
SELECT p_partkey, lower(trim(p_name)) AS plain, upper(p_type) LIKE '%STEEL%' AS steel, regexp_matches(p_name, '\bgreen\b') AS green, regexp_replace(p_name, '[aeiou]', '', 'g') AS consonants FROM part""")
def x4(spark, d):
    n = F.col("p_name")
    return frame(spark, d, "part").select(
        "p_partkey", F.lower(F.trim(n)).alias("plain"), F.upper("p_type").like("%STEEL%").alias("steel"), n.rlike(r"\bgreen\b").alias("green"), F.regexp_replace(n, "[aeiou]", "").alias("consonants")
    )


@query("x6_last_word_verdict", """
WITH w AS (SELECT doc_id, regexp_extract(lower(text), '([a-z]+)[^a-z]*$', 1) AS w FROM documents)
SELECT doc_id, w AS word, CASE WHEN w IN ('the', 'of', 'and') THEN 'drop' WHEN length(w) > 6 THEN 'trace' ELSE 'locate' END AS verdict FROM w""")
def x6(spark, d):
    from netsounder.functions.text import last_word

    w = frame(spark, d, "documents").select("doc_id", F.coalesce(last_word(F.col("text")), F.lit("")).alias("word"))
    verdict = F.when(F.col("word").isin("the", "of", "and"), "drop").when(F.length("word") > 6, "trace").otherwise("locate")
    return w.select("doc_id", "word", verdict.alias("verdict"))


@query("x9_json", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, '{\"k\":' || json_extract_string(props, '$.k') || '}' AS again FROM events")
def x9(spark, d):
    e = frame(spark, d, "events").select("event_id", F.from_json("props", "k long").alias("p"))
    return e.select("event_id", "p.k", F.to_json("p").alias("again"))


@query("x10_time", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, date_diff('hour', TIMESTAMP '1970-01-01 00:00:00', date_trunc('hour', ts)) AS hours FROM events")
def x10(spark, d):
    return frame(spark, d, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.expr("timestampdiff(HOUR, timestamp '1970-01-01 00:00:00', date_trunc('hour', ts))").alias("hours"))


@query("g22_single_linkage", f"""
WITH RECURSIVE pair AS (SELECT p.id AS a, q.id AS b FROM point p JOIN point q ON p.id <> q.id WHERE {_D} <= 6),
reach AS (SELECT id AS a, id AS b FROM point UNION SELECT r.a, p.b FROM reach r JOIN pair p ON r.b = p.a)
SELECT a AS id, min(b) AS cluster FROM reach GROUP BY a""", "point")
def g22(spark, d):
    return G.clustered(frame(spark, d, "point"), 6.0)
