"""Composite answers: the stages of an audit of the derived network."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netsounder.operators import graph as G
from netsounder.operators import relational as R
from netsounder.operators import spatial as S
from netsounder.plans.derived import frame, registrar
from netsounder.session import counted, stored

QUERIES: dict = {}
ORACLES: dict = {}
query = registrar(QUERIES, ORACLES)


#: Rows of a counted table that may be sent to every task.
SENT = 1 << 16


def seeds(edges: DataFrame) -> DataFrame:
    """``(node_id, inflows, inflow_m)``: nodes with inflow and no outflow that a tidal link touches.

    The ends of tidal links come first; where a count shows that they are few, the edges meet them unshuffled.
    """
    tidal, n = counted(edges.where("form = 'tidal'").select(F.explode(F.array("from_node", "to_node")).alias("node_id")).distinct(), "tidal")
    if n <= SENT:
        tidal = F.broadcast(tidal)
    at = lambda c: edges.withColumnRenamed(c, "node_id").join(tidal, "node_id", "left_semi")
    inflow = at("to_node").groupBy("node_id").agg(F.count("*").alias("inflows"), F.sum("length_m").alias("inflow_m"))
    return inflow.join(at("from_node").select("node_id").distinct(), "node_id", "left_anti")


def reached(edges: DataFrame) -> DataFrame:
    """Edges with ``admitted``, ``seed`` and ``hops`` of the crawl from :func:`seeds`."""
    named = edges.withColumn("edge_id", F.concat_ws(">", "from_node", "to_node")) if "edge_id" not in edges.columns else edges
    named = stored(named, "edges")
    return G.crawl(named, stored(seeds(named), "seeds"), columns=tuple(c for c in named.columns if c != "edge_id"))


_REACH = """WITH RECURSIVE out AS (SELECT DISTINCT from_node AS n FROM {t}),
seed AS (SELECT DISTINCT t.to_node AS s FROM {t} t WHERE t.form = 'tidal' AND t.to_node NOT IN (SELECT n FROM out)),
walk AS (SELECT s AS node, s AS seed, 0 AS hops FROM seed UNION SELECT e.from_node, w.seed, w.hops + 1 FROM walk w JOIN {t} e ON e.to_node = w.node),
wet AS (SELECT node, min(seed) AS seed, min(hops) AS hops FROM walk GROUP BY node),
link AS (SELECT t.*, w.node IS NOT NULL AS admitted, w.seed, w.hops + 1 AS hops FROM {t} t LEFT JOIN wet w ON w.node = t.to_node)
"""
_LINKS = _REACH.format(t="edge")


@query("q1_load_integrity", """
SELECT count(*) AS links, count(*) FILTER (WHERE form = 'tidal') AS tidal, count(*) FILTER (WHERE from_node = to_node) AS self_loops,
  count(*) - count(DISTINCT from_node || '>' || to_node) AS duplicates, count(*) FILTER (WHERE form NOT IN ('F', 'O', 'P', 'tidal', 'supplier')) AS other_forms, round(sum(length_m) / 1000, 6) AS km FROM edge""", "edge")
def q1(spark, d):
    e, key = frame(spark, d, "edge"), F.concat_ws(">", "from_node", "to_node")
    return e.agg(
        F.count("*").alias("links"), F.count_if(F.col("form") == "tidal").alias("tidal"), F.count_if(F.col("from_node") == F.col("to_node")).alias("self_loops"),
        (F.count("*") - F.countDistinct(key)).alias("duplicates"), F.count_if(~F.col("form").isin("F", "O", "P", "tidal", "supplier")).alias("other_forms"), F.round(F.sum("length_m") / 1000, 6).alias("km"),
    )


@query("q2_census", """WITH RECURSIVE und AS (SELECT u AS a, v AS b FROM step UNION SELECT v, u FROM step), reach AS (SELECT a, a AS b FROM und UNION SELECT r.a, s.b FROM reach r JOIN und s ON r.b = s.a),
c AS (SELECT a AS node, min(b) AS component FROM reach GROUP BY a), e AS (SELECT c.component, (s.u * 7 + s.v * 3) % 11 AS m, CASE WHEN (s.u + s.v) % 3 = 0 THEN 'canal' ELSE 'river' END AS form FROM step s JOIN c ON c.node = s.u),
k AS (SELECT component, count(*) AS links, sum(m)::DOUBLE AS km, sum(CASE WHEN form = 'canal' THEN m ELSE 0 END)::DOUBLE AS canal, sum(CASE WHEN form = 'river' THEN m ELSE 0 END)::DOUBLE AS river FROM e GROUP BY component)
SELECT k.*, canal > 0 AND river = 0 AS canal_only, (SELECT count(*) FROM c WHERE c.component = k.component) AS nodes FROM k""", "step")
def q2(spark, d):
    e = frame(spark, d, "step").select(
        F.col("u").alias("from_node"), F.col("v").alias("to_node"), ((F.col("u") * 7 + F.col("v") * 3) % 11).cast("double").alias("m"), F.when((F.col("u") + F.col("v")) % 3 == 0, "canal").otherwise("river").alias("form")
    )
    parts = G.weak_components(e)
    at = e.join(parts.withColumnRenamed("node_id", "from_node"), "from_node")
    forms = at.groupBy("component").pivot("form", ["canal", "river"]).sum("m").na.fill(0.0)
    sums = at.groupBy("component").agg(F.count("*").alias("links"), F.sum("m").alias("km")).join(forms, "component")
    nodes = parts.groupBy("component").agg(F.count("*").alias("nodes"))
    return sums.join(nodes, "component").withColumn("canal_only", (F.col("canal") > 0) & (F.col("river") == 0))


@query("q5_scope_by_downstream_basin", """
SELECT t.from_node, t.to_node, b.basin, CASE WHEN b.basin IN (0, 3) THEN 'basin' WHEN b.basin IS NULL AND t.origin = 'repair' THEN 'country' ELSE 'neither' END AS scope_rule
FROM edge t LEFT JOIN (SELECT 'N:' || n_nationkey AS node, n_regionkey AS basin FROM nation) b ON b.node = t.to_node""", "edge")
def q5(spark, d):
    basin = frame(spark, d, "nation").select(F.concat(F.lit("N:"), "n_nationkey").alias("to_node"), F.col("n_regionkey").alias("basin"))
    out = frame(spark, d, "edge").join(basin, "to_node", "left")
    rule = F.when(F.col("basin").isin(0, 3), "basin").when(F.col("basin").isNull() & (F.col("origin") == "repair"), "country").otherwise("neither")
    return out.select("from_node", "to_node", "basin", rule.alias("scope_rule"))


@query("q6_reading_coverage", """
SELECT source, count(*) AS n, count(elevation) AS read, count(*) - count(elevation) AS refused, round(min(elevation), 3) AS least FROM reading GROUP BY source""", "reading")
def q6(spark, d):
    return frame(spark, d, "reading").groupBy("source").agg(
        F.count("*").alias("n"), F.count("elevation").alias("read"), (F.count("*") - F.count("elevation")).alias("refused"), F.round(F.min("elevation"), 3).alias("least")
    )


@query("q7_structure_offsets", """
SELECT label, count(*) AS n, round(median(gap), 6) AS p50, round(quantile_cont(gap, 0.9), 6) AS p90 FROM (
  SELECT p.id, p.label, min(sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y))) AS gap FROM point p JOIN point q ON p.id <> q.id
  WHERE sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y)) <= 30 GROUP BY p.id, p.label) g GROUP BY label""", "point")
def q7(spark, d):
    p = frame(spark, d, "point")
    near = S.nearest_points(p, p, 30.0).join(p.select("id", "label"), "id")
    return near.groupBy("label").agg(F.count("*").alias("n"), F.round(F.median("gap"), 6).alias("p50"), F.round(F.percentile("gap", F.lit(0.9)), 6).alias("p90"))


@query("q9_curated_validation", """
SELECT 'C:' || o_custkey AS subject, CASE WHEN c_custkey IS NULL THEN 'unresolved' WHEN o_orderpriority = '' THEN 'no reason' ELSE 'ok' END AS verdict, count(*) AS n
FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 9 <> 4) c ON c_custkey = o_custkey GROUP BY 1, 2""")
def q9(spark, d):
    judged = frame(spark, d, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("reason"))
    known = frame(spark, d, "customer").where("c_custkey % 9 <> 4").select(F.col("c_custkey").alias("key"), F.lit(True).alias("known"))
    verdict = F.when(F.col("known").isNull(), "unresolved").when(F.trim("reason") == "", "no reason").otherwise("ok")
    return judged.join(known, "key", "left").groupBy(F.concat(F.lit("C:"), "key").alias("subject"), verdict.alias("verdict")).agg(F.count("*").alias("n"))


@query("q11_screen", """
WITH m AS (SELECT node_id, min(reading_id) AS rid FROM reading GROUP BY node_id), e AS (SELECT m.node_id, r.elevation FROM m JOIN reading r ON r.reading_id = m.rid)
SELECT u, v, CASE WHEN b.elevation - a.elevation IS NULL THEN 'no reading' WHEN b.elevation - a.elevation > 4 THEN 'clear rise' WHEN b.elevation - a.elevation > 0.5 THEN 'weak rise'
  WHEN b.elevation - a.elevation >= -0.5 THEN 'flat' WHEN b.elevation - a.elevation >= -4 THEN 'weak fall' ELSE 'clear fall' END AS band
FROM step LEFT JOIN e a ON a.node_id = u LEFT JOIN e b ON b.node_id = v""", "step", "reading")
def q11(spark, d):
    first = R.first_by(frame(spark, d, "reading"), ["node_id"], [F.asc("reading_id")]).select("node_id", "elevation")
    s = frame(spark, d, "step").join(first.toDF("u", "eu"), "u", "left").join(first.toDF("v", "ev"), "v", "left")
    return s.select("u", "v", R.banded(F.col("ev") - F.col("eu"), 0.5, 4.0).alias("band"))


@query("q12_flags", """
SELECT from_node AS subject, 'flat_water' AS flag FROM edge WHERE form = 'supplier' UNION ALL SELECT from_node, 'schematic' FROM edge WHERE length_m <= 1
UNION ALL SELECT from_node, 'summit' FROM edge GROUP BY from_node HAVING count(*) > 1""", "edge")
def q12(spark, d):
    e = frame(spark, d, "edge").select(F.col("from_node").alias("subject"), "form", "length_m")
    flag = lambda df, name: df.select("subject", F.lit(name).alias("flag"))
    forks = e.groupBy("subject").count().where("count > 1")
    return flag(e.where("form = 'supplier'"), "flat_water").unionByName(flag(e.where("length_m <= 1"), "schematic")).unionByName(flag(forks, "summit"))


@query("q13_crawl_share_by_form", _LINKS + """SELECT form, count(*) AS links, count(*) FILTER (WHERE admitted) AS reached,
  round(sum(length_m) / 1000, 6) AS km, round(coalesce(sum(length_m) FILTER (WHERE admitted), 0) / nullif(sum(length_m), 0), 9) AS share FROM link GROUP BY form""", "edge")
def q13(spark, d):
    part = F.sum(F.when(F.col("admitted"), F.col("length_m")).otherwise(0.0))
    return reached(frame(spark, d, "edge")).groupBy("form").agg(
        F.count("*").alias("links"), F.count_if("admitted").alias("reached"), F.round(F.sum("length_m") / 1000, 6).alias("km"), F.round(R.share(part, F.sum("length_m")), 9).alias("share")
    )


@query("q15_second_reading", """WITH RECURSIVE one AS (SELECT node FROM (SELECT v AS node FROM step WHERE v % 20 = 0) a),
w1 AS (SELECT DISTINCT node FROM one UNION SELECT s.u FROM w1 JOIN step s ON s.v = w1.node),
two AS (SELECT v AS node FROM step WHERE v % 20 = 0 OR v % 17 = 0), w2 AS (SELECT DISTINCT node FROM two WHERE node % 4 <> 0 UNION SELECT s.u FROM w2 JOIN step s ON s.v = w2.node)
SELECT v IN (SELECT node FROM w1) AS first, v IN (SELECT node FROM w2) AS second, count(*) AS links FROM step GROUP BY 1, 2""", "step")
def q15(spark, d):
    e = frame(spark, d, "step").select(F.col("u").alias("from_node"), F.col("v").alias("to_node"), F.concat_ws(">", "u", "v").alias("edge_id"), F.lit("forward").alias("mode"))
    e = stored(e, "steps")
    ends = e.select(F.col("to_node").alias("node_id")).distinct()
    one = G.crawl(e, ends.where("node_id % 20 = 0")).select("edge_id", F.col("admitted").alias("first"))
    two = G.crawl(e, ends.where("(node_id % 20 = 0 or node_id % 17 = 0) and node_id % 4 <> 0")).select("edge_id", F.col("admitted").alias("second"))
    return one.join(two, "edge_id").groupBy("first", "second").agg(F.count("*").alias("links"))


@query("q16_dead_ends", _LINKS + """, sink AS (SELECT to_node AS node_id, count(*) AS inflows FROM edge WHERE to_node NOT IN (SELECT n FROM out) GROUP BY to_node),
up AS (SELECT node_id AS start, node_id AS node FROM sink UNION SELECT u.start, e.from_node FROM up u JOIN edge e ON e.to_node = u.node),
dry AS (SELECT node_id AS start, node_id AS node FROM sink UNION SELECT u.start, e.from_node FROM dry u JOIN link e ON e.to_node = u.node AND NOT e.admitted),
um AS (SELECT start, sum(length_m) AS m FROM up JOIN edge e ON e.to_node = up.node GROUP BY start), dm AS (SELECT start, sum(length_m) AS m FROM dry JOIN link e ON e.to_node = dry.node AND NOT e.admitted GROUP BY start)
SELECT node_id, inflows, node_id LIKE 'R:%' AS tidal, round(coalesce(um.m, 0), 3) AS upstream_m, round(coalesce(dm.m, 0), 3) AS stranded_m FROM sink LEFT JOIN um ON um.start = node_id LEFT JOIN dm ON dm.start = node_id""", "edge")
def q16_dead(spark, d):
    e = stored(reached(frame(spark, d, "edge")).select("from_node", "to_node", "length_m", "mode", "admitted"), "reached")
    sinks = e.groupBy(F.col("to_node").alias("node_id")).agg(F.count("*").alias("inflows")).join(e.select(F.col("from_node").alias("node_id")), "node_id", "left_anti")
    up = G.upstream_length(e, sinks).select("node_id", "upstream_m")
    dry = G.upstream_length(e.where("not admitted"), sinks).select("node_id", F.col("upstream_m").alias("stranded_m"))
    out = sinks.join(up, "node_id").join(dry, "node_id")
    return out.select("node_id", "inflows", F.col("node_id").like("R:%").alias("tidal"), F.round("upstream_m", 3).alias("upstream_m"), F.round("stranded_m", 3).alias("stranded_m"))


@query("q16_reach_by_form", _LINKS + "SELECT form, admitted, count(*) AS n, round(sum(length_m), 3) AS m FROM link GROUP BY form, admitted", "edge")
def q16_form(spark, d):
    return reached(frame(spark, d, "edge")).groupBy("form", "admitted").agg(F.count("*").alias("n"), F.round(F.sum("length_m"), 3).alias("m"))


@query("q16_per_basin", _LINKS + """, k AS (SELECT n_regionkey AS basin, count(*) AS links, sum(length_m) AS km, coalesce(sum(length_m) FILTER (WHERE admitted), 0) AS reached
  FROM link JOIN nation ON to_node = 'N:' || n_nationkey GROUP BY n_regionkey)
SELECT r_regionkey AS basin, coalesce(links, 0) AS links, round(coalesce(km, 0), 3) AS km, round(reached / nullif(km, 0), 9) AS share,
  CASE WHEN links IS NULL THEN 'no links' WHEN reached < km THEN 'leaves the basin' ELSE 'all reached' END AS reason FROM region LEFT JOIN k ON basin = r_regionkey""", "edge")
def q16_basin(spark, d):
    basin = frame(spark, d, "nation").select(F.concat(F.lit("N:"), "n_nationkey").alias("to_node"), F.col("n_regionkey").alias("basin"))
    at = reached(frame(spark, d, "edge")).join(basin, "to_node").groupBy("basin")
    k = at.agg(F.count("*").alias("links"), F.sum("length_m").alias("km"), F.sum(F.when(F.col("admitted"), F.col("length_m")).otherwise(0.0)).alias("reached"))
    out = frame(spark, d, "region").select(F.col("r_regionkey").alias("basin")).join(k, "basin", "left")
    reason = F.when(F.col("links").isNull(), "no links").when(F.col("reached") < F.col("km"), "leaves the basin").otherwise("all reached")
    return out.select("basin", F.coalesce("links", F.lit(0)).alias("links"), F.round(F.coalesce("km", F.lit(0.0)), 3).alias("km"), F.round(R.share(F.col("reached"), F.col("km")), 9).alias("share"), reason.alias("reason"))


@query("q16_stranded_components", _LINKS + """, und AS (SELECT from_node AS a, to_node AS b FROM link WHERE NOT admitted UNION SELECT to_node, from_node FROM link WHERE NOT admitted),
reach AS (SELECT a, a AS b FROM und UNION SELECT r.a, s.b FROM reach r JOIN und s ON r.b = s.a), c AS (SELECT a AS node, min(b) AS region FROM reach GROUP BY a)
SELECT region, count(*) AS links, round(sum(length_m), 3) AS m FROM link JOIN c ON c.node = from_node WHERE NOT admitted GROUP BY region""", "edge")
def q16_stranded(spark, d):
    dry = stored(reached(frame(spark, d, "edge")).where("not admitted").select("from_node", "to_node", "length_m"), "dry")
    parts = G.weak_components(dry).toDF("from_node", "region")
    return dry.join(parts, "from_node").groupBy("region").agg(F.count("*").alias("links"), F.round(F.sum("length_m"), 3).alias("m"))


@query("q17_wide_export", _LINKS + """SELECT 'link:' || link.from_node || '>' || link.to_node AS link_id, origin, form, round(length_m, 3) AS length_m, coalesce(admitted, false) AS reaches, seed, coalesce(f.flag, false) AS flat,
  b.basin, CASE WHEN origin = 'repair' THEN 'added' ELSE 'survey' END AS provenance FROM link
LEFT JOIN (SELECT DISTINCT from_node, true AS flag FROM edge WHERE form = 'supplier') f ON f.from_node = link.from_node
LEFT JOIN (SELECT 'N:' || n_nationkey AS node, n_regionkey AS basin FROM nation) b ON b.node = link.to_node""", "edge")
def q17(spark, d):
    e = reached(frame(spark, d, "edge"))
    flat = e.where("form = 'supplier'").select("from_node", F.lit(True).alias("flag")).distinct()
    basin = frame(spark, d, "nation").select(F.concat(F.lit("N:"), "n_nationkey").alias("to_node"), F.col("n_regionkey").alias("basin"))
    out = e.join(flat, "from_node", "left").join(basin, "to_node", "left")
    return out.select(
        F.concat(F.lit("link:"), "edge_id").alias("link_id"), "origin", "form", F.round("length_m", 3).alias("length_m"), F.coalesce("admitted", F.lit(False)).alias("reaches"), "seed",
        F.coalesce("flag", F.lit(False)).alias("flat"), "basin", F.when(F.col("origin") == "repair", "added").otherwise("survey").alias("provenance"),
    )


@query("q19_candidates", """
WITH n AS (SELECT p.id, min(sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y))) AS gap FROM point p JOIN point q ON p.id <> q.id AND p.label = q.label GROUP BY p.id)
SELECT p.id, concat_ws('+', CASE WHEN n.gap <= 10 THEN 'junction' END, CASE WHEN p.label IN (2, 5) THEN 'reversal' END, CASE WHEN n.gap > 10 AND n.gap <= 60 THEN 'connector' END) AS suggests
FROM point p LEFT JOIN n ON n.id = p.id""", "point")
def q19(spark, d):
    p = frame(spark, d, "point")
    near = S.near_pairs(p, 60.0)
    both = near.select("a", "b", "gap").union(near.select("b", "a", "gap")).toDF("id", "o", "gap")
    l = p.select("id", "label")
    gap = both.join(l, "id").join(l.toDF("o", "ol"), "o").where("label = ol").groupBy("id").agg(F.min("gap").alias("gap"))
    return p.join(gap, "id", "left").select("id", suggestion(F.col("gap") <= 10, F.col("label").isin(2, 5), (F.col("gap") > 10) & (F.col("gap") <= 60)).alias("suggests"))


def suggestion(junction, reversal, connector):
    """What a defect's evidence suggests, joined in a fixed order; empty for none."""
    return F.concat_ws("+", F.when(junction, "junction"), F.when(reversal, "reversal"), F.when(connector, "connector"))


@query("q20_connector_proposals", """
WITH c AS (SELECT p.id, q.id AS target, p.label, sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y)) AS gap, abs(p.label - q.label) <= 1 AS name_ok,
    row_number() OVER (PARTITION BY p.id ORDER BY sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y)), q.id) AS rn
  FROM point p JOIN point q ON p.id <> q.id WHERE sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y)) <= 20)
SELECT id, target, round(gap, 6) AS gap, CASE WHEN NOT name_ok THEN 'names conflict' WHEN gap = 0 THEN 'no length' ELSE 'draft' END AS verdict FROM c WHERE rn = 1""", "point")
def q20(spark, d):
    p = frame(spark, d, "point")
    best = S.nearest_points(p, p, 20.0)
    l = p.select("id", "label")
    out = best.join(l, "id").join(l.toDF("target", "tl"), "target")
    verdict = F.when(F.abs(F.col("label") - F.col("tl")) > 1, "names conflict").when(F.col("gap") == 0, "no length").otherwise("draft")
    return out.select("id", "target", F.round("gap", 6).alias("gap"), verdict.alias("verdict"))


@query("q21_reversal_proposals", """
WITH m AS (SELECT node_id, min(reading_id) AS rid FROM reading GROUP BY node_id), e AS (SELECT m.node_id, r.elevation FROM m JOIN reading r ON r.reading_id = m.rid)
SELECT u, v, CASE WHEN b.elevation - a.elevation IS NULL THEN 'no reading' WHEN b.elevation - a.elevation > 4 THEN 'refused' WHEN b.elevation - a.elevation < -4 THEN 'corroborated'
  WHEN b.elevation - a.elevation < -0.5 THEN 'weak' ELSE 'silent' END AS verdict FROM step LEFT JOIN e a ON a.node_id = u LEFT JOIN e b ON b.node_id = v WHERE u % 3 = 0 AND u <> v""", "step", "reading")
def q21(spark, d):
    first = R.first_by(frame(spark, d, "reading"), ["node_id"], [F.asc("reading_id")]).select("node_id", "elevation")
    s = frame(spark, d, "step").where("u % 3 = 0 and u <> v").join(first.toDF("u", "eu"), "u", "left").join(first.toDF("v", "ev"), "v", "left")
    fall = F.col("ev") - F.col("eu")
    verdict = F.when(fall.isNull(), "no reading").when(fall > 4, "refused").when(fall < -4, "corroborated").when(fall < -0.5, "weak").otherwise("silent")
    return s.select("u", "v", verdict.alias("verdict"))


@query("q25_agreement_matrix", """
SELECT l.toxic AS theirs, d.n_chars > 2000 AS ours, count(*) AS n FROM labels l JOIN documents d USING (doc_id) GROUP BY 1, 2""")
def q25(spark, d):
    met = frame(spark, d, "labels").join(frame(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return met.groupBy(F.col("toxic").alias("theirs"), (F.col("n_chars") > 2000).alias("ours")).agg(F.count("*").alias("n"))


@query("q26_in_scope_population", """
WITH link AS (SELECT o_orderkey AS link_id, o_totalprice AS m FROM orders WHERE o_orderkey % 3 <> 0), repair AS (SELECT o_orderkey AS link_id, o_totalprice + 1 AS m FROM orders WHERE o_orderkey % 3 = 0),
scope AS (SELECT o_orderkey AS link_id FROM orders WHERE o_orderstatus <> 'P'), retired AS (SELECT o_orderkey AS link_id FROM orders WHERE o_orderkey % 11 = 5)
SELECT s.link_id, round(coalesce(l.m, r.m), 2) AS length_m, r.link_id IS NOT NULL AS is_repair FROM scope s LEFT JOIN link l USING (link_id) LEFT JOIN repair r ON r.link_id = s.link_id
WHERE NOT EXISTS (SELECT 1 FROM retired x WHERE x.link_id = s.link_id)""")
def q26(spark, d):
    o = frame(spark, d, "orders").select(F.col("o_orderkey").alias("link_id"), F.col("o_totalprice").alias("m"), "o_orderstatus")
    return population(o.where("o_orderstatus <> 'P'").select("link_id"), o.where("link_id % 3 <> 0"), o.where("link_id % 3 = 0").withColumn("m", F.col("m") + 1), o.where("link_id % 11 = 5"))


def population(scope: DataFrame, links: DataFrame, repairs: DataFrame, retired: DataFrame) -> DataFrame:
    """The in-scope population: survey or repair links in scope that are not retired, measures survey first."""
    rep = repairs.select("link_id", F.col("m").alias("rm"), F.lit(True).alias("is_repair"))
    out = scope.join(links.select("link_id", F.col("m").alias("lm")), "link_id", "left").join(rep, "link_id", "left").join(retired, "link_id", "left_anti")
    return out.select("link_id", F.round(F.coalesce("lm", "rm"), 2).alias("length_m"), F.coalesce("is_repair", F.lit(False)).alias("is_repair"))


@query("q27_text_census", r"""
SELECT lang, count(*) FILTER (WHERE regexp_matches(text, '\bthe\b')) AS the, count(*) FILTER (WHERE regexp_matches(text, 'License')) AS licence, count(*) FILTER (WHERE regexp_matches(text, '[0-9]{4}')) AS digits FROM documents GROUP BY lang""")
def q27(spark, d):
    from netsounder.functions.text import classes

    c = classes(F.col("text"), {"the": r"\bthe\b", "licence": "License", "digits": "[0-9]{4}"})
    out = frame(spark, d, "documents").select("lang", c.alias("c"))
    return out.groupBy("lang").agg(*[F.count_if(f"c.{k}").alias(k) for k in ("the", "licence", "digits")])


@query("v1_summary", _LINKS + "SELECT count(*) AS links, round(sum(length_m) / 1000, 6) AS km, count(*) FILTER (WHERE admitted) AS reached, count(DISTINCT seed) AS seeds FROM link", "edge")
def v1(spark, d):
    e = reached(frame(spark, d, "edge"))
    return e.agg(F.count("*").alias("links"), F.round(F.sum("length_m") / 1000, 6).alias("km"), F.count_if("admitted").alias("reached"), F.countDistinct("seed").alias("seeds"))


@query("v3_node_links", """
SELECT 'in' AS direction, from_node AS other, round(length_m, 3) AS length_m FROM edge WHERE to_node = 'N:7' UNION ALL SELECT 'out', to_node, round(length_m, 3) FROM edge WHERE from_node = 'N:7'""", "edge")
def v3(spark, d):
    return node_links(frame(spark, d, "edge"), "N:7")


def node_links(edges: DataFrame, node: str) -> DataFrame:
    """All links at a node: arriving ones first, then by length."""
    arrive = edges.where(F.col("to_node") == node).select(F.lit("in").alias("direction"), F.col("from_node").alias("other"), "length_m")
    leave = edges.where(F.col("from_node") == node).select(F.lit("out").alias("direction"), F.col("to_node").alias("other"), "length_m")
    return arrive.unionByName(leave).withColumn("length_m", F.round("length_m", 3)).orderBy("direction", F.desc("length_m"), "other")


@query("v9_event_log_fold", """
SELECT user_id, event_type, value, n FROM (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn, count(*) OVER (PARTITION BY user_id) AS n
  FROM (SELECT DISTINCT * FROM events)) WHERE rn = 1""")
def v9(spark, d):
    log = frame(spark, d, "events").dropDuplicates(["event_id"])
    last = Window.partitionBy("user_id")
    out = log.withColumn("n", F.count("*").over(last))
    return R.first_by(out, ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "value", "n")
