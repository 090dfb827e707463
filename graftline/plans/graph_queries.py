"""Queries over walks and graphs on the driver's tables, most with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import paths as P
from ..operators import bridges as BR
from ..operators import bubbles as BU
from ..operators import coverage as C
from ..operators import finishing as FI
from ..operators import graph as G
from ..operators import intervals as I
from ..operators import layout as L
from ..operators import phasing as PH
from ..operators import relations as R
from . import bindings as B
from .queries import Frame, Spark, flip, query

UNIQUE = ("click0", "click2", "error1", "view3")
_IN = ", ".join(f"'{x}'" for x in UNIQUE)


def walks(spark: Spark, sf: str) -> Frame:
    """(read, path): a user's day over nodes of event type and quarter of the day."""
    e = B.read(spark, sf, "events")
    step = F.concat(F.when(F.col("value") >= 50, F.lit(">")).otherwise(F.lit("<")), "event_type", F.floor(F.hour("ts") / 6).cast("string"))
    grouped = e.groupBy(F.concat_ws("/", "user_id", F.date_format("ts", "yyyy-MM-dd")).alias("read")).agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", step.alias("step")))).alias("s"))
    return grouped.select("read", F.transform("s", lambda x: x["step"]).alias("path"), F.col("s")[0]["event_id"].alias("first_id"), F.element_at("s", -1)["event_id"].alias("last_id"))


WALKS = """walks AS (
  SELECT user_id || '/' || strftime(ts, '%Y-%m-%d') AS read,
    list(CASE WHEN value >= 50 THEN '>' ELSE '<' END || event_type || CAST(hour(ts) // 6 AS VARCHAR) ORDER BY ts, event_id) AS path,
    arg_min(event_id, ts) AS first_id, arg_max(event_id, ts) AS last_id
  FROM events GROUP BY ALL)"""
BRIDGES = f"""marks AS (SELECT read, path, list_filter(range(1, len(path) + 1), lambda i: path[i][2:] IN ({_IN})) AS pos FROM walks),
stretch AS (SELECT unnest(list_transform(range(1, len(pos)), lambda k: path[pos[k]:pos[k + 1]])) AS b FROM marks WHERE len(pos) >= 2),
turned AS (SELECT b, list_transform(list_reverse(b), lambda s: {flip('s')}) AS r FROM stretch),
bridges AS (SELECT CASE WHEN array_to_string(b, '') < array_to_string(r, '') THEN b ELSE r END AS bridge FROM turned)"""


def found_bridges(spark: Spark, sf: str) -> Frame:
    return BR.bridges(walks(spark, sf), spark.createDataFrame([(x,) for x in UNIQUE], "node string"))


@query(f"""WITH {WALKS}, {BRIDGES}, e AS (SELECT bridge[1] AS a, bridge[len(bridge)] AS b FROM bridges),
c AS (SELECT a, b, {flip('b')} AS fb, {flip('a')} AS fa FROM e)
SELECT CASE WHEN a || b < fb || fa THEN a ELSE fb END AS a, CASE WHEN a || b < fb || fa THEN b ELSE fa END AS b, count(*) AS n FROM c GROUP BY ALL""")
def bridge_counts(spark: Spark, sf: str) -> Frame:
    return BR.bridge_counts(found_bridges(spark, sf))


@query(f"""WITH {WALKS}, {BRIDGES}, n AS (SELECT bridge, bridge[1] AS a, bridge[len(bridge)] AS b, count(*) AS n FROM bridges GROUP BY bridge),
c AS (SELECT *, {flip('b')} AS fb, {flip('a')} AS fa FROM n),
k AS (SELECT bridge, n, CASE WHEN a || b < fb || fa THEN a || b ELSE fb || fa END AS key FROM c)
SELECT array_to_string(bridge, '') AS bridge, n, n * 2 >= max(n) OVER (PARTITION BY key) AS kept FROM k""")
def majority_bridge(spark: Spark, sf: str) -> Frame:
    return BR.majority_bridges(found_bridges(spark, sf)).withColumn("bridge", P.spelled(F.col("bridge")))


@query(f"""WITH {WALKS}, {BRIDGES}, e AS (SELECT bridge[1] AS x, bridge[len(bridge)] AS l FROM bridges), t AS (SELECT x, {flip('l')} AS y FROM e),
s AS (SELECT x, y FROM t UNION ALL SELECT y, x FROM t), n AS (SELECT x, y, count(*) AS n FROM s GROUP BY ALL),
w AS (SELECT x, y FROM (SELECT *, max(n) OVER (PARTITION BY x) AS m FROM n) WHERE n = 1 OR m >= 2 * n),
b AS (SELECT x, y FROM w UNION SELECT y, x FROM w)
SELECT t.x, t.y, b.x IS NULL AS kept, count(*) AS n FROM t LEFT JOIN b ON t.x = b.x AND t.y = b.y GROUP BY ALL""")
def wrong_connections(spark: Spark, sf: str) -> Frame:
    out = BR.right_connections(found_bridges(spark, sf))
    return out.groupBy(F.col("bridge")[0].alias("x"), P.flipped(F.element_at("bridge", -1)).alias("y"), "kept").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {WALKS}, nodes AS (SELECT DISTINCT event_type || CAST(hour(ts) // 6 AS VARCHAR) AS node FROM events), sized AS (SELECT node, CAST(100 + 10 * length(node) AS BIGINT) AS length FROM nodes),
s AS (SELECT read, first_id, last_id, len(path) AS n, unnest(path) AS step, unnest(range(len(path))) AS i FROM walks),
p AS (SELECT s.*, node, length, sum(length) OVER (PARTITION BY read) AS plen FROM s JOIN sized ON node = step[2:]),
c AS (SELECT node, CASE WHEN n = 1 THEN (plen - first_id % 40 - last_id % 40) / plen WHEN i = 0 THEN (length - first_id % 40) / length WHEN i = n - 1 THEN (length - last_id % 40) / length ELSE 1.0 END AS share FROM p)
SELECT node, round(coalesce(sum(share), 0), 6) AS coverage, length FROM sized LEFT JOIN c USING (node) GROUP BY node, length""")
def alignment_coverage(spark: Spark, sf: str) -> Frame:
    w = walks(spark, sf)
    name = F.concat("event_type", F.floor(F.hour("ts") / 6).cast("string"))
    nodes = B.read(spark, sf, "events").select(name.alias("node")).distinct().withColumn("length", (100 + 10 * F.length("node")).cast("long"))
    size = F.aggregate("path", F.lit(0).cast("long"), lambda s, x: s + 100 + 10 * (F.length(x) - 1))
    aln = w.select("path", size.alias("plen"), (F.col("first_id") % 40).alias("pstart"), (size - F.col("last_id") % 40).alias("pend"))
    return C.alignment_coverage(aln, nodes).withColumn("coverage", F.round("coverage", 6))


@query(f"WITH {WALKS} SELECT read, array_to_string(path, '') AS path FROM walks WHERE len(list_filter(path, lambda s: s[2:] IN ({_IN}))) > 0")
def alignments_with_nodes(spark: Spark, sf: str) -> Frame:
    names = spark.createDataFrame([(x,) for x in UNIQUE], "name string")
    return R.paths_with(walks(spark, sf).select("read", "path"), names).withColumn("path", P.spelled(F.col("path")))


@query(f"WITH {B.LINKS} SELECT node, CASE WHEN node LIKE 'p%' THEN 0 ELSE 1 END AS side, false AS odd FROM (SELECT a AS node FROM links UNION SELECT b FROM links)")
def two_coloring(spark: Spark, sf: str) -> Frame:
    return G.two_coloring(B.links(spark, sf))


def link_arcs(spark: Spark, sf: str) -> Frame:
    found = B.links(spark, sf)
    return G.arcs(found.select(F.col("a").alias("src"), F.lit(True).alias("src_fw"), F.col("b").alias("dst"), F.lit(True).alias("dst_fw"), F.lit(0).alias("overlap")))


def link_nodes(spark: Spark, sf: str) -> Frame:
    found = B.links(spark, sf)
    return found.select(F.col("a").alias("node")).union(found.select("b")).distinct().withColumn("length", (F.length("node") * 1000).cast("long"))


@query(f"""WITH RECURSIVE {B.LINKS}, n AS (SELECT a AS node FROM links UNION SELECT b FROM links), e AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
r AS (SELECT node, node AS other FROM n UNION SELECT r.node, e.b FROM r JOIN e ON r.other = e.a),
c AS (SELECT node, min(other) AS component FROM r GROUP BY node),
l AS (SELECT component, CAST(sum(length(node) * 1000) AS BIGINT) AS length, count(*) AS nodes FROM c GROUP BY component)
SELECT component, length, nodes, CAST(row_number() OVER (ORDER BY length DESC, component) AS INTEGER) AS rank FROM l""")
def component_ranks(spark: Spark, sf: str) -> Frame:
    nodes = link_nodes(spark, sf)
    return G.component_ranks(nodes, G.graph_components(nodes, link_arcs(spark, sf)))


@query(f"""WITH RECURSIVE {B.LINKS}, a AS (SELECT '>' || a AS u, '>' || b AS v FROM links UNION SELECT '<' || b, '<' || a FROM links),
r AS (SELECT '>' || a AS node FROM links WHERE a LIKE 'p1%' UNION SELECT a.v FROM r JOIN a ON r.node = a.u)
SELECT DISTINCT node AS "end" FROM r""")
def reachable(spark: Spark, sf: str) -> Frame:
    start = B.links(spark, sf).where("a LIKE 'p1%'").select(F.concat(F.lit(">"), "a").alias("end"))
    return G.reached(start, link_arcs(spark, sf))


@query(f"""WITH {B.LINKS}, a AS (SELECT '>' || a AS u, '>' || b AS v FROM links UNION SELECT '<' || b, '<' || a FROM links),
n AS (SELECT a AS node FROM links UNION SELECT b FROM links), e AS (SELECT '>' || node AS e FROM n UNION SELECT '<' || node FROM n)
SELECT e AS "end", CAST(coalesce(max(length(v[2:]) * 1000), 0) AS DOUBLE) AS depth FROM e LEFT JOIN a ON u = e GROUP BY e""")
def depths(spark: Spark, sf: str) -> Frame:
    return G.depths(link_nodes(spark, sf), link_arcs(spark, sf))


SIMPLE = f"""{B.LINKS}, simple AS (SELECT a, b FROM links WHERE a IN (SELECT a FROM links GROUP BY a HAVING count(*) = 1) AND b IN (SELECT b FROM links GROUP BY b HAVING count(*) = 1))"""


@query(f"""WITH {SIMPLE}, n AS (SELECT a AS node FROM links UNION SELECT b FROM links)
SELECT '>' || node AS unitig, CAST(0 AS BIGINT) AS pos, '>' || node AS step FROM n WHERE node NOT IN (SELECT b FROM simple) UNION ALL SELECT '>' || a, 1, '>' || b FROM simple""")
def unitigs(spark: Spark, sf: str) -> Frame:
    return G.unitigs(link_nodes(spark, sf), link_arcs(spark, sf))


@query(f"""WITH {SIMPLE} SELECT '>' || a AS s, '>' || b AS t FROM simple UNION ALL SELECT '<' || b, '<' || a FROM simple""")
def superbubbles(spark: Spark, sf: str) -> Frame:
    return BU.superbubbles(link_nodes(spark, sf).withColumn("coverage", F.lit(1.0)), link_arcs(spark, sf), chain_steps=True)


@query()
def phased_components(spark: Spark, sf: str) -> Frame:
    nodes = link_nodes(spark, sf)
    member = G.graph_components(nodes, link_arcs(spark, sf))
    weight = B.links(spark, sf).select("a", "b", (F.pmod(F.xxhash64("a", "b"), F.lit(9)) - 3).cast("double").alias("w"))
    return PH.phased(member, weight)


@query(f"""WITH RECURSIVE {B.IVALS}, c AS (SELECT key AS node, s AS pos FROM ivals), l AS (SELECT DISTINCT key AS node, 4000 AS length FROM ivals),
f AS (SELECT DISTINCT c.node, pos FROM c JOIN l ON c.node = l.node WHERE pos >= 200 AND pos + 200 <= length),
r AS (SELECT node, min(pos) AS pos FROM f GROUP BY node UNION ALL SELECT r.node, (SELECT min(f.pos) FROM f WHERE f.node = r.node AND f.pos >= r.pos + 200) FROM r WHERE r.pos IS NOT NULL)
SELECT node, pos AS "at" FROM r WHERE pos IS NOT NULL""")
def thinned_cuts(spark: Spark, sf: str) -> Frame:
    iv = B.ivals(spark, sf)
    return I.thinned_cuts(iv.select(F.col("key").alias("node"), F.col("s").alias("at")), iv.select(F.col("key").alias("node"), F.lit(4000).alias("length")).distinct(), least=200)


@query(f"""WITH RECURSIVE {B.IVALS}, n AS (SELECT key, s, e, row_number() OVER (PARTITION BY key ORDER BY s, e) AS i, count(*) OVER (PARTITION BY key) AS m FROM ivals),
r AS (SELECT key, i, m, [{{'e': CAST(e AS BIGINT), 'x': CAST(e - s AS BIGINT)}}] AS done FROM n WHERE i = 1
  UNION ALL SELECT n.key, n.i, n.m, list_append(r.done, {{'e': CAST(n.e AS BIGINT),
    'x': CAST(n.e - n.s + coalesce(list_max(list_transform(list_filter(r.done, lambda d: d.e <= n.e AND n.s - d.e <= 365), lambda d: d.x - greatest(0, d.e - n.s))), 0) AS BIGINT)}})
  FROM r JOIN n ON n.key = r.key AND n.i = r.i + 1)
SELECT key, list_max(list_transform(done, lambda d: d.x)) AS best FROM r WHERE i = m""")
def chained_intervals(spark: Spark, sf: str) -> Frame:
    return I.chained_length(B.ivals(spark, sf), jump=365)


ORDER_STEPS = """steps AS (
  SELECT l_orderkey AS read, l_partkey || l_returnflag AS node, l_quantity >= 25 AS fw, CAST(100 + 10 * length(l_partkey || l_returnflag) AS BIGINT) AS len,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS pos FROM lineitem)"""


def order_steps(spark: Spark, sf: str) -> Frame:
    """(read, node, fw, len, pos): an order as a walk over parts, told apart by their return flags; a node has about ten places at any size."""
    by = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    node = F.concat("l_partkey", "l_returnflag")
    return B.read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("read"), node.alias("node"), (F.col("l_quantity") >= 25).alias("fw"), (100 + 10 * F.length(node)).cast("long").alias("len"), F.row_number().over(by).alias("pos"))


@query(f"""WITH {ORDER_STEPS},
sized AS (SELECT *, coalesce(sum(len) OVER (PARTITION BY read ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off, sum(len) OVER (PARTITION BY read) AS plen FROM steps),
cut AS (SELECT *, 3 AS rstart, read % 40 AS pstart, plen - read % 30 AS pend, plen - read % 30 - read % 40 + 10 AS rlen FROM sized),
part AS (SELECT read, rlen, node, len, fw AS f, greatest(pstart, off) - off AS na, least(pend, off + len) - off AS nb,
  rstart + greatest(pstart, off) - pstart AS xs, rstart + least(pend, off + len) - pstart AS xe FROM cut WHERE greatest(pstart, off) < least(pend, off + len)),
place AS (SELECT o_custkey AS contig, node, fw, coalesce(sum(len) OVER (PARTITION BY o_custkey ORDER BY read, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM steps JOIN orders ON read = o_orderkey),
m AS (SELECT read, contig, f = fw AS forward, off + (CASE WHEN f = fw THEN na ELSE len - nb END) - (CASE WHEN f = fw THEN xs ELSE rlen - xe END) AS cs, xs, xe, rlen FROM part JOIN place USING (node)),
c AS (SELECT *, sum(new) OVER (PARTITION BY read, contig, forward ORDER BY cs, xs, xe ROWS UNBOUNDED PRECEDING) AS cluster FROM (
  SELECT *, CASE WHEN cs < lag(cs) OVER (PARTITION BY read, contig, forward ORDER BY cs, xs, xe) + 50 THEN 0 ELSE 1 END AS new FROM m)),
u AS (SELECT *, greatest(xe - greatest(xs, coalesce(max(xe) OVER (PARTITION BY read, contig, forward, cluster ORDER BY xs, xe ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), xs)), 0) AS own FROM c),
k AS (SELECT read, contig, forward, cluster, max(cs) AS cs, max(cs) + any_value(rlen) AS ce, sum(own) AS exact FROM u
  GROUP BY ALL HAVING max(xe) - min(xs) >= any_value(rlen) * 0.5 AND sum(own) >= any_value(rlen) * (0.5 / 3)),
best AS (SELECT DISTINCT read, contig, forward, cs, ce FROM (SELECT *, max(exact) OVER (PARTITION BY read) AS most FROM k) WHERE exact = most)
SELECT contig, read, CAST(CASE WHEN forward THEN cs ELSE ce END AS BIGINT) AS bgn, CAST(CASE WHEN forward THEN ce ELSE cs END AS BIGINT) AS "end", count(*) OVER (PARTITION BY read) AS copies FROM best""")
def read_layout(spark: Spark, sf: str) -> Frame:
    """Orders, cut a little at both ends, placed on their customers' whole sequences of steps, under the operator's default limits."""
    steps = order_steps(spark, sf)
    walked = F.transform(F.array_sort(F.collect_list(F.struct("pos", F.concat(F.when(F.col("fw"), F.lit(">")).otherwise(F.lit("<")), "node").alias("step")))), lambda x: x["step"])
    reads = steps.groupBy("read").agg(walked.alias("path"), F.sum("len").alias("plen"))
    reads = reads.withColumn("pstart", F.col("read") % 40).withColumn("pend", F.col("plen") - F.col("read") % 30)
    reads = reads.select("read", (F.col("pend") - F.col("pstart") + 10).alias("rlen"), F.lit(3).cast("long").alias("rstart"), "path", "plen", "pstart", "pend")
    orders = B.read(spark, sf, "orders").select(F.col("o_orderkey").alias("read"), "o_custkey")
    whole = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("read", "path"))), lambda x: x["path"]))
    contigs = reads.select("read", "path").join(orders, "read").groupBy(F.col("o_custkey").alias("contig")).agg(whole.alias("path"))
    return L.layout(reads, contigs, steps.select("node", F.col("len").alias("length")).distinct())


@query()
def overlap_candidates(spark: Spark, sf: str) -> Frame:
    reads = B.seqs(spark, sf).select(F.col("id").alias("read"), "seq")
    return FI.overlap_candidates(FI.minimizers(reads, 11, 8))


@query("""WITH p AS (SELECT l_orderkey AS path, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS pos, l_partkey AS node, CAST(l_quantity AS BIGINT) AS len FROM lineitem),
d AS (SELECT path, pos, node, len, coalesce(sum(len) OVER (PARTITION BY path ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(len) OVER (PARTITION BY path) AS total FROM p)
SELECT DISTINCT node FROM d WHERE before < 10 OR total - before - len < 10""")
def near_path_ends(spark: Spark, sf: str) -> Frame:
    pos = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("pos")
    rows = B.read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("path"), pos, F.col("l_partkey").alias("node"), F.col("l_quantity").cast("long").alias("len"))
    return FI.near_path_ends(rows, 10)


@query("""WITH d AS (SELECT l_orderkey AS path, l_partkey AS node, CAST(l_quantity AS BIGINT) AS len,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS pos FROM lineitem),
b AS (SELECT x.path, x.pos, x.node, coalesce(sum(y.len) FILTER (y.pos < x.pos), 0) AS before, coalesce(sum(y.len) FILTER (y.pos > x.pos), 0) AS after
  FROM d x JOIN d y ON x.path = y.path GROUP BY x.path, x.pos, x.node)
SELECT path, node, count(*) AS n FROM b WHERE before < 10 OR after < 10 GROUP BY path, node""")
def near_path_ends_all_rows(spark: Spark, sf: str) -> Frame:
    """(path, node, n): as near_path_ends, but no row is left out and each path's nodes are told apart.

    Rows that are equal in all columns of the order are equal as steps, so the result doesn't depend on theirs.
    """
    rows = B.read(spark, sf, "lineitem")
    pos = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    steps = rows.select(F.col("l_orderkey").alias("path"), pos.alias("pos"), F.col("l_partkey").alias("node"), F.col("l_quantity").cast("long").alias("len"))
    near = FI.steps_near_path_ends(steps, 10)
    return near.groupBy("path", "node").agg(F.count(F.lit(1)).alias("n"))
