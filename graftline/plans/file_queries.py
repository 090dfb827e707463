"""Queries of readers, writers and rules on single tables, each with the SQL that checks it."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import sequences as S
from ..operators import coverage as C
from ..operators import finishing as FI
from ..operators import graph as G
from ..operators import intervals as I
from ..operators import phasing as PH
from ..operators import relations as R
from ..operators.iterate import shared_dir
from ..sources import sinks, text
from . import bindings as B
from .graph_queries import link_arcs, link_nodes
from .queries import Frame, Spark, query


def _folder(spark: Spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def alignments(spark: Spark, sf: str) -> Frame:
    """Sold items as alignments of orders to paths of two nodes."""
    li = B.read(spark, sf, "lineitem")
    path = F.array(F.concat(F.lit(">"), "l_partkey"), F.concat(F.lit("<s"), "l_suppkey"))
    rlen, plen = F.col("l_quantity").cast("long") * 100, F.col("l_partkey") * 10 + 1000
    columns = [F.col("l_orderkey").cast("string").alias("read"), rlen.alias("rlen"), (F.col("l_linenumber") * 4).cast("long").alias("rstart"), (rlen - F.col("l_linenumber") * 5).cast("long").alias("rend"), F.lit("+").alias("strand")]
    columns += [path.alias("path"), plen.cast("long").alias("plen"), (F.col("l_suppkey") % 500).cast("long").alias("pstart"), (plen - F.col("l_partkey") % 300).cast("long").alias("pend")]
    return li.select(*columns, rlen.alias("nmatch"), rlen.alias("alen"), (F.col("l_orderkey") % 61).cast("long").alias("mapq"))


ALN = """aln AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS read, CAST(l_quantity AS BIGINT) * 100 AS rlen, CAST(l_linenumber * 4 AS BIGINT) AS rstart,
    CAST(CAST(l_quantity AS BIGINT) * 100 - l_linenumber * 5 AS BIGINT) AS rend, '>' || l_partkey || '<s' || l_suppkey AS path,
    CAST(l_partkey * 10 + 1000 AS BIGINT) AS plen, CAST(l_suppkey % 500 AS BIGINT) AS pstart, CAST(l_partkey * 10 + 1000 - l_partkey % 300 AS BIGINT) AS pend,
    CAST(l_orderkey % 61 AS BIGINT) AS mapq, l_partkey, l_suppkey
  FROM lineitem)"""
SHOWN = ["read", "rlen", "rstart", "rend", "path", "plen", "pstart", "pend", "mapq"]


def _shown(rows: Frame) -> Frame:
    return rows.withColumn("path", F.array_join("path", "")).select(*SHOWN)


@query(f"WITH {ALN} SELECT {', '.join(SHOWN)} FROM aln WHERE mapq >= 20 AND rend - rstart >= rlen * 0.98")
def well_aligned_rows(spark: Spark, sf: str) -> Frame:
    return _shown(R.well_aligned(alignments(spark, sf), share=0.98))


@query(f"WITH {ALN} SELECT DISTINCT read FROM aln WHERE mapq >= 20 AND (pstart < 100 OR pend + 100 > plen)")
def near_end_read_names(spark: Spark, sf: str) -> Frame:
    return R.near_end_reads(alignments(spark, sf), 100)


@query(f"""WITH {ALN} SELECT {', '.join(SHOWN)} FROM aln WHERE (rstart <= 12 OR rlen - rend <= 12) OR (pstart <= 12 OR plen - pend <= 12)""")
def whole_alignment_rows(spark: Spark, sf: str) -> Frame:
    return _shown(FI.whole_alignments(alignments(spark, sf), 12))


@query(f"""WITH {ALN} SELECT {', '.join(SHOWN)} FROM aln WHERE CAST(read AS BIGINT) NOT IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 200000)
  AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 40)""")
def unused_alignments(spark: Spark, sf: str) -> Frame:
    used = B.read(spark, sf, "orders").where("o_totalprice > 200000").select(F.col("o_orderkey").cast("string").alias("read"))
    nodes = B.read(spark, sf, "part").where("p_size > 40").select(F.col("p_partkey").cast("string").alias("name"))
    return _shown(R.unused_reads(alignments(spark, sf), used, nodes))


@query(f"WITH {ALN} SELECT {', '.join(SHOWN)} FROM aln")
def gaf_round_trip(spark: Spark, sf: str) -> Frame:
    path = _folder(spark, "gaf")
    sinks.write_gaf(alignments(spark, sf), path)
    return _shown(text.gaf(spark, path))


@query(f"WITH {B.SEQS} SELECT CAST(id AS VARCHAR) AS name, seq FROM seqs WHERE seq <> ''")
def fasta_round_trip(spark: Spark, sf: str) -> Frame:
    path = _folder(spark, "fasta")
    sinks.write_fasta(B.seqs(spark, sf).where("seq <> ''").select(F.col("id").cast("string").alias("name"), "seq"), path, "gzip")
    return text.fasta(spark, path).select("name", "seq")


@query(f"WITH {B.SEQS} SELECT CAST(id AS VARCHAR) AS node, seq, CAST(length(seq) AS BIGINT) AS length FROM seqs WHERE seq <> ''")
def gfa_segments_round_trip(spark: Spark, sf: str) -> Frame:
    path = _folder(spark, "gfa")
    nodes = B.seqs(spark, sf).where("seq <> ''").select(F.col("id").cast("string").alias("node"), "seq", F.length("seq").cast("long").alias("length"))
    sinks.write_gfa(nodes, link_arcs(spark, sf), path)
    return text.gfa_segments(spark, path).select("node", "seq", "length")


@query(f"""WITH {B.LINKS}, e AS (SELECT a || '+' AS u, b || '+' AS v, CAST((length(a) + length(b)) * 1000 AS BIGINT) AS mid_length FROM links)
SELECT * FROM e UNION SELECT v[:-2] || '-', u[:-2] || '-', mid_length FROM e""")
def gfa_directed_round_trip(spark: Spark, sf: str) -> Frame:
    path = _folder(spark, "gfa")
    sinks.write_gfa(link_nodes(spark, sf).withColumn("seq", F.lit("*")), link_arcs(spark, sf), path, with_sequences=False)
    return text.directed(spark, path)[1]


@query(f"WITH {B.COV} SELECT node, coverage, length FROM cov")
def coverage_round_trip(spark: Spark, sf: str) -> Frame:
    path = _folder(spark, "coverage")
    sinks.write_coverage(B.cov(spark, sf), path)
    return text.coverage(spark, path)


@query("SELECT CAST(l_orderkey AS VARCHAR) || '/' || l_linenumber AS name, count(*) AS count FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def duplicate_read_ids(spark: Spark, sf: str) -> Frame:
    return R.duplicate_ids(B.read(spark, sf, "lineitem").select(F.concat(F.col("l_orderkey").cast("string"), F.lit("/"), "l_linenumber").alias("name")))


STEPS = """s AS (SELECT l_orderkey AS path, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS pos,
  CAST(l_quantity AS BIGINT) AS len, CAST(l_linenumber % 3 AS BIGINT) AS overlap FROM lineitem)"""


def numbered_steps(spark: Spark, sf: str) -> Frame:
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    rows = B.read(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("path")).agg(F.array_sort(F.collect_list(order)).alias("s"))
    each = rows.select("path", F.posexplode("s").alias("pos", "x"))
    return each.select("path", (F.col("pos") + 1).cast("long").alias("pos"), F.col("x.l_quantity").cast("long").alias("len"), (F.col("x.l_linenumber") % 3).cast("long").alias("overlap"))


@query(f"""WITH {STEPS}, n AS (SELECT *, lead(overlap, 1, 0) OVER (PARTITION BY path ORDER BY pos) AS following FROM s)
SELECT path, pos, len, overlap, CAST(coalesce(sum(len - following) OVER (PARTITION BY path ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM n""")
def step_offsets(spark: Spark, sf: str) -> Frame:
    return I.path_offsets(numbered_steps(spark, sf))


@query(f"""WITH {STEPS}, x AS (SELECT a.path, a.pos, a.len, a.overlap, CAST(coalesce(sum(b.len) FILTER (b.pos < a.pos), 0) AS BIGINT) AS before, CAST(coalesce(sum(b.len) FILTER (b.pos > a.pos), 0) AS BIGINT) AS after
  FROM s a JOIN s b ON a.path = b.path GROUP BY ALL) SELECT * FROM x""")
def step_end_distances(spark: Spark, sf: str) -> Frame:
    return I.end_distances(numbered_steps(spark, sf))


@query(f"""WITH {B.MARKERS}, k AS (SELECT DISTINCT seq[i : i + 8] AS kmer FROM (SELECT seq, unnest(range(1, length(seq) - 7)) AS i FROM marker_seqs))
SELECT kmer, CAST(list_sum(list_transform(range(9), lambda j: (instr('ACGT', kmer[j + 1]) - 1) * CAST(pow(4, 8 - j) AS BIGINT))) AS BIGINT) AS number FROM k""")
def packed_kmers(spark: Spark, sf: str) -> Frame:
    found = B.marker_seqs(spark, sf).select(F.explode(S.kmers(F.col("seq"), B.K)).alias("kmer")).distinct()
    return found.select("kmer", S.packed_kmer(F.col("kmer")).alias("number"))


@query("""SELECT DISTINCT CAST(l_quantity AS BIGINT) * l_suppkey AS n, least(CAST(round_even(CAST(l_quantity AS BIGINT) * l_suppkey * 1.5, 0) AS BIGINT), 100000) AS scaled,
  greatest(5000, least(100000, CAST(l_quantity AS BIGINT) * l_suppkey)) AS scaffold FROM lineitem""")
def gap_sizes(spark: Spark, sf: str) -> Frame:
    n = B.read(spark, sf, "lineitem").select((F.col("l_quantity").cast("long") * F.col("l_suppkey")).cast("long").alias("n")).distinct()
    return n.select("n", S.scaled_gap(F.col("n")).alias("scaled"), S.scaffold_gap(F.col("n").cast("double")).alias("scaffold"))


@query(f"""WITH {B.COV}, m AS (SELECT sum(coverage * length) / sum(length) AS mean FROM cov),
n AS (SELECT brand, sum(coverage * length) / sum(length) AS near_mean FROM cov WHERE length > 10000 GROUP BY brand)
SELECT node, coverage, length, coverage / CASE WHEN near_mean BETWEEN mean * 0.1 AND mean * 10 THEN near_mean ELSE mean END AS normalised FROM cov LEFT JOIN n USING (brand) CROSS JOIN m""")
def normalised_coverage(spark: Spark, sf: str) -> Frame:
    cov = B.cov(spark, sf)
    weighted = (F.sum(F.col("coverage") * F.col("length")) / F.sum("length"))
    brands = cov.where("length > 10000").groupBy("brand").agg(weighted.alias("near_mean"))
    return C.local_normalised(cov, cov.select("node", "brand").join(brands, "brand").drop("brand"), cov.agg(weighted.alias("mean")))


HITS = """hits AS (SELECT 's' || l_suppkey AS q, p_brand AS r, CAST(4000 AS BIGINT) AS qlen, CAST(4000 AS BIGINT) AS rlen,
  date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS qs, date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) + CAST(l_quantity AS BIGINT) AS qe,
  CAST(p_size * 10 AS BIGINT) AS rs, CAST(p_size * 10 AS BIGINT) + CAST(l_quantity AS BIGINT) AS re FROM lineitem JOIN part ON l_partkey = p_partkey)"""


@query(f"""WITH {HITS},
a AS (SELECT q, r, greatest(0, qe - greatest(qs, coalesce(max(qe) OVER (PARTITION BY q, r ORDER BY qs, qe ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), qs))) AS n FROM hits),
b AS (SELECT q, r, greatest(0, re - greatest(rs, coalesce(max(re) OVER (PARTITION BY q, r ORDER BY rs, re ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), rs))) AS n FROM hits),
c AS (SELECT q, r, sum(n) AS cq FROM a GROUP BY q, r), d AS (SELECT q, r, sum(n) AS cr FROM b GROUP BY q, r),
e AS (SELECT q, r, max(least(qe - qs, re - rs)) AS longest FROM hits GROUP BY q, r)
SELECT q, r, CAST(least(cq, cr) AS BIGINT) AS covered, CAST(longest AS BIGINT) AS longest FROM c JOIN d USING (q, r) JOIN e USING (q, r)""")
def homology_covered(spark: Spark, sf: str) -> Frame:
    rows = B.read(spark, sf, "lineitem").join(B.read(spark, sf, "part").select("p_partkey", "p_brand", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    qs, rs, n = F.datediff("l_shipdate", F.lit("1992-01-01")).cast("long"), (F.col("p_size") * 10).cast("long"), F.col("l_quantity").cast("long")
    size = F.lit(4000).cast("long")
    hits = rows.select(F.concat(F.lit("s"), "l_suppkey").alias("q"), size.alias("qlen"), qs.alias("qs"), (qs + n).alias("qe"), F.lit("+").alias("strand"), F.col("p_brand").alias("r"), size.alias("rlen"), rs.alias("rs"), (rs + n).alias("re"))
    return PH.homology_pairs(hits).select("q", "r", "covered", "longest")


@query(f"""WITH {B.LINKS}, k AS (SELECT a, b FROM links WHERE a NOT IN (SELECT 'p' || p_partkey FROM part WHERE p_size > 25)) SELECT '>' || a AS u, '>' || b AS v FROM k UNION SELECT '<' || b, '<' || a FROM k""")
def arcs_without_nodes(spark: Spark, sf: str) -> Frame:
    lost = B.read(spark, sf, "part").where("p_size > 25").select(F.concat(F.lit("p"), "p_partkey").alias("node"))
    return G.without_nodes(link_arcs(spark, sf), lost).select("u", "v")


@query("""WITH m AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'c' || l_partkey % 40 AS ref1, 'c' || l_suppkey % 40 AS ref2, l_orderkey * 1000 AS pos1, l_partkey * 9000 AS pos2, l_orderkey * 1000 + l_partkey * 7000 AS len1, l_partkey * 9000 + l_suppkey * 90000 AS len2,
    l_linenumber % 3 AS mapq1, l_orderkey % 2 AS mapq2, CAST(l_quantity AS DOUBLE) / 50 AS aligned1, CAST(l_tax AS DOUBLE) * 20 AS aligned2,
    CASE WHEN l_linenumber > 3 THEN [{'ref': 'c' || l_orderkey % 40, 'pos': l_suppkey * 1000, 'len': l_partkey * 20000}] ELSE [] END AS places1,
    CASE WHEN l_linenumber < 5 THEN [{'ref': 'c' || l_orderkey % 37, 'pos': l_suppkey * 700, 'len': l_suppkey * 9000}] ELSE [] END AS places2 FROM lineitem),
e AS (SELECT *, list_prepend({'ref': ref1, 'pos': pos1, 'len': len1}, places1) AS e1, list_prepend({'ref': ref2, 'pos': pos2, 'len': len2}, places2) AS e2 FROM m),
g AS (SELECT *, len(list_filter(places1, lambda x: x.ref = ref2)) + len(list_filter(places2, lambda x: x.ref = ref1)) AS met,
  list_has_any(list_transform(e1, lambda x: x.ref), list_transform(e2, lambda x: x.ref)) AS meets,
  len(list_filter(e1, lambda x: x.len > 10000)) > 0 AND len(list_filter(e2, lambda x: x.len > 10000)) > 0 AS long,
  len(list_filter(e1, lambda x: x.pos < 10000000 AND x.len - x.pos < 10000000)) > 0 AND len(list_filter(e2, lambda x: x.pos < 10000000 AND x.len - x.pos < 10000000)) > 0 AS outer_ FROM e)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM g WHERE ref1 <> ref2 AND aligned1 >= 0.5 AND aligned2 >= 0.5 AND (mapq1 > 0 OR len(places1) > 0) AND (mapq2 > 0 OR len(places2) > 0)
  AND met = 0 AND ((mapq1 > 0 AND mapq2 > 0) OR (NOT meets AND long AND outer_))""")
def contact_prefilter(spark: Spark, sf: str) -> Frame:
    li = B.read(spark, sf, "lineitem")
    name = lambda c, n: F.concat(F.lit("c"), (F.col(c) % n).cast("string"))
    number = lambda e: F.expr(e).cast("long")
    kind = "array<struct<ref: string, pos: bigint, len: bigint>>"
    place = lambda some, ref, pos, size: F.when(F.expr(some), F.array(F.struct(ref.alias("ref"), number(pos).alias("pos"), number(size).alias("len")))).otherwise(F.array()).cast(kind)
    pairs = li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", name("l_partkey", 40).alias("ref1"), name("l_suppkey", 40).alias("ref2"), number("l_orderkey * 1000").alias("pos1"), number("l_partkey * 9000").alias("pos2"),
        number("l_orderkey * 1000 + l_partkey * 7000").alias("len1"), number("l_partkey * 9000 + l_suppkey * 90000").alias("len2"), number("l_linenumber % 3").alias("mapq1"), number("l_orderkey % 2").alias("mapq2"),
        (F.col("l_quantity").cast("double") / 50).alias("aligned1"), (F.col("l_tax").cast("double") * 20).alias("aligned2"),
        place("l_linenumber > 3", name("l_orderkey", 40), "l_suppkey * 1000", "l_partkey * 20000").alias("places1"), place("l_linenumber < 5", name("l_orderkey", 37), "l_suppkey * 700", "l_suppkey * 9000").alias("places2"),
    )
    return R.pair_prefilter(pairs).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("""WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS path, p_size * 300000 AS length, p_size % 3 = 0 AS haploid, p_partkey % 7 = 0 AS st, p_partkey % 5 = 0 AS et FROM part),
l AS (SELECT DISTINCT l_partkey || CASE WHEN l_linenumber % 2 = 0 THEN '+' ELSE '-' END AS a, (l_suppkey % (SELECT count(*) FROM part) + 1) || CASE WHEN l_linenumber % 3 = 0 THEN '+' ELSE '-' END AS b FROM lineitem),
d AS (SELECT a, b, CASE WHEN length(a) + length(b) > 4 THEN length(a) * 1500000 END AS distance FROM l)
SELECT l.a, l.b FROM l JOIN p x ON x.path = l.a[:-2] JOIN p y ON y.path = l.b[:-2] JOIN d ON d.a = l.a AND d.b = l.b
WHERE NOT ((((x.haploid AND x.length > 6000000 AND NOT y.haploid) OR (y.haploid AND y.length > 6000000 AND NOT x.haploid)) AND coalesce(distance > 5000000, true))
  OR (y.length <= 5000000 AND CASE WHEN l.b[-1:] = '+' THEN y.st ELSE y.et END))""")
def allowed_scaffold_links(spark: Spark, sf: str) -> Frame:
    part = B.read(spark, sf, "part")
    paths = part.select(F.col("p_partkey").cast("string").alias("path"), (F.col("p_size") * 300_000).cast("long").alias("length"), (F.col("p_size") % 3 == 0).alias("haploid"), (F.col("p_partkey") % 7 == 0).alias("start_telomere"), (F.col("p_partkey") % 5 == 0).alias("end_telomere"))
    sign = lambda n: F.when(F.col("l_linenumber") % n == 0, F.lit("+")).otherwise(F.lit("-"))
    n = part.count()
    links = B.read(spark, sf, "lineitem").select(F.concat(F.col("l_partkey").cast("string"), sign(2)).alias("a"), F.concat((F.col("l_suppkey") % n + 1).cast("string"), sign(3)).alias("b")).distinct()
    far = links.where(F.length("a") + F.length("b") > 4).withColumn("distance", F.length("a") * 1_500_000)
    return PH.allowed_links(links, paths, far)


DUP = """nodes AS (SELECT CAST(p_partkey AS VARCHAR) AS node, p_size * 200000 AS length, p_brand AS component FROM part),
edges AS (SELECT CAST(l_partkey AS VARCHAR) AS a, CAST(l_partkey + 25 AS VARCHAR) AS b, CAST(sum(l_quantity) AS BIGINT) * 100 AS covered, min(CASE WHEN l_quantity < 3 THEN 0 ELSE -10 END) AS weight FROM lineitem GROUP BY l_partkey HAVING CAST(l_partkey AS VARCHAR) < CAST(l_partkey + 25 AS VARCHAR)),
dist AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS a, CAST(l_partkey + 25 AS VARCHAR) AS b FROM lineitem WHERE l_linenumber * 1500000 < 5000000 AND l_suppkey % 4 = 0)"""


@query(f"""WITH {DUP},
h AS (SELECT a AS node FROM edges WHERE weight <> 0 UNION SELECT b FROM edges WHERE weight <> 0),
st AS (SELECT component, 2 * sum(CASE WHEN node IN (SELECT node FROM h) THEN length ELSE 0 END) > sum(length) AS diploid FROM nodes GROUP BY component),
r AS (SELECT e.a, e.b, x.component, e.covered, least(x.length, y.length) <= 5000000 AND (e.a, e.b) IN (SELECT (least(a, b), greatest(a, b)) FROM dist) AS copy
  FROM edges e JOIN nodes x ON x.node = e.a JOIN nodes y ON y.node = e.b WHERE x.component = y.component AND e.weight <> 0),
s AS (SELECT component, sum(covered) AS al, sum(CASE WHEN copy THEN covered ELSE 0 END) AS co FROM r GROUP BY component),
c AS (SELECT r.a, r.b FROM r JOIN s USING (component) JOIN st USING (component) WHERE copy AND diploid AND 3 * co < al)
SELECT a, b, covered FROM edges WHERE (a, b) NOT IN (SELECT (a, b) FROM c)""")
def cleared_duplications(spark: Spark, sf: str) -> Frame:
    key = F.col("l_partkey")
    name = lambda c: c.cast("string")
    li = B.read(spark, sf, "lineitem")
    part = B.read(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("node"), (F.col("p_size") * 200_000).cast("long").alias("length"), F.col("p_brand").alias("component"))
    weight = F.min(F.when(F.col("l_quantity") < 3, 0).otherwise(-10))
    edges = li.groupBy(key).agg((F.sum("l_quantity").cast("long") * 100).alias("covered"), weight.alias("weight")).select(name(key).alias("a"), name(key + 25).alias("b"), "covered", "weight").where("a < b")
    far = li.where("l_suppkey % 4 = 0").select(F.concat(F.lit(">"), name(key)).alias("start"), F.concat(F.lit("<"), name(key + 25)).alias("end"), (F.col("l_linenumber") * 1_500_000).cast("long").alias("distance"))
    return PH.without_duplications(edges, part.select("node", "component"), part, far)[0].select("a", "b", "covered")


def brand_edges(spark: Spark, sf: str) -> tuple[Frame, Frame]:
    """(nodes, edges): parts with their brand as component, and matches between parts 25 apart."""
    key = F.col("l_partkey")
    weight = F.min(F.when(F.col("l_quantity") < 3, 0).otherwise(F.when(F.col("l_tax") > 0.02, -10).otherwise(0)))
    edges = B.read(spark, sf, "lineitem").groupBy(key).agg((F.sum("l_quantity").cast("long") * 100).alias("covered"), weight.alias("weight"))
    part = B.read(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("node"), (F.col("p_size") * 200_000).cast("long").alias("length"), F.col("p_brand").alias("component"))
    return part, edges.where("l_partkey % 3 = 0").select(key.cast("string").alias("a"), (key + 25).cast("string").alias("b"), "covered", "weight")


BRANDS = """nodes AS (SELECT CAST(p_partkey AS VARCHAR) AS node, p_size * 200000 AS length, p_brand AS component FROM part),
edges AS (SELECT CAST(l_partkey AS VARCHAR) AS a, CAST(l_partkey + 25 AS VARCHAR) AS b FROM lineitem WHERE l_partkey % 3 = 0 GROUP BY l_partkey
  HAVING min(CASE WHEN l_quantity < 3 THEN 0 WHEN l_tax > 0.02 THEN -10 ELSE 0 END) <> 0),
h AS (SELECT a AS node FROM edges UNION SELECT b FROM edges)"""


@query(f"""WITH {BRANDS} SELECT component, 2 * sum(CASE WHEN node IN (SELECT node FROM h) THEN length ELSE 0 END) > sum(length) AS diploid FROM nodes GROUP BY component""")
def diploid_brands(spark: Spark, sf: str) -> Frame:
    nodes, edges = brand_edges(spark, sf)
    return PH.diploid_components(nodes.select("node", "component"), nodes, edges)


@query(f"""WITH {BRANDS}, p AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS path, CAST(l_partkey AS VARCHAR) AS node FROM lineitem)
SELECT path FROM p JOIN nodes USING (node) GROUP BY path HAVING 2 * sum(CASE WHEN node IN (SELECT node FROM h) THEN length ELSE 0 END) < sum(length)""")
def haploid_orders(spark: Spark, sf: str) -> Frame:
    nodes, edges = brand_edges(spark, sf)
    steps = B.read(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("path"), F.col("l_partkey").cast("string").alias("node")).distinct()
    return PH.haploid_paths(steps, nodes, edges)


@query("""WITH n AS (SELECT p_partkey, p_size, 'tig000' || p_partkey || '_x' || p_size || CASE WHEN p_size % 2 = 0 THEN '_cut' || p_size ELSE '_u1' END AS name FROM part)
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN name ELSE 'tig000' || p_partkey || '_x' || p_size END AS base, regexp_replace(name, '^tig0*', '') AS plain, name AS first_word,
  CAST(CASE WHEN p_size % 3 = 0 THEN p_size * 7 ELSE p_size END AS BIGINT) AS length, CASE p_size % 3 WHEN 0 THEN p_size / 4 WHEN 1 THEN p_size / 2 END AS coverage,
  p_size / 64 AS identity, p_size % 4 < 2 AS truth FROM n""")
def name_and_tag_rules(spark: Spark, sf: str) -> Frame:
    size = F.col("p_size")
    text_of = lambda c: c.cast("string")
    name = F.concat(F.lit("tig000"), text_of(F.col("p_partkey")), F.lit("_x"), text_of(size), F.when(size % 2 == 0, F.concat(F.lit("_cut"), text_of(size))).otherwise(F.lit("_u1")))
    tag = lambda prefix, value: F.concat(F.lit(prefix), text_of(value))
    tags = F.when(size % 3 == 0, F.array(tag("LN:i:", size * 7), tag("ll:f:", size / 2), tag("kl:f:", size / 4))).when(size % 3 == 1, F.array(tag("ll:f:", size / 2))).otherwise(F.array(F.lit("xx:i:1")))
    rows = B.read(spark, sf, "part").select("p_partkey", size.cast("long").alias("p_size"), name.alias("name"), tags.alias("tags"))
    word = F.element_at(F.array(F.lit("YES"), F.lit("true"), F.lit("no"), F.lit("0")), (F.col("p_size") % 4 + 1).cast("int"))
    return rows.select(
        "p_partkey", S.base_name(F.col("name")).alias("base"), S.replaced_name(F.col("name"), F.lit(None).cast("string")).alias("plain"), S.read_name(F.concat("name", F.lit(" and more"))).alias("first_word"),
        S.segment_length(F.repeat(F.lit("A"), F.col("p_size").cast("int")), F.col("tags")).alias("length"), S.coverage_tag(F.col("tags")).alias("coverage"),
        S.identity(F.concat(F.lit("id:f:"), (F.col("p_size") / 64).cast("string"))).alias("identity"), S.truth(word).alias("truth"),
    )
