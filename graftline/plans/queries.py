"""Queries of the graph engine on the driver's tables, each with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths as P
from ..functions import sequences as S
from ..operators import coverage as C
from ..operators import graph as G
from ..operators import intervals as I
from ..operators import relations as R
from ..operators.iterate import node_components
from . import bindings as B

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def flip(x: str) -> str:
    return B.FLIP.format(x)


Spark, Frame = SparkSession, DataFrame


# sequences


@query(f"WITH {B.SEQS} SELECT id, CAST(length(seq) AS INTEGER) AS len, CAST(len(list_filter(list_transform(range(1, length(seq) + 1), lambda i: i = 1 OR seq[i] <> seq[i - 1]), lambda x: x)) AS INTEGER) AS hpc_len FROM seqs")
def hpc_lengths(spark: Spark, sf: str) -> Frame:
    return B.seqs(spark, sf).select("id", F.length("seq").alias("len"), F.length(S.homopolymer_compressed(F.col("seq"))).alias("hpc_len"))


@query(f"""WITH {B.SEQS}, k AS (SELECT unnest(list_transform(range(1, length(seq) - 7), lambda i: seq[i:i + 8])) AS kmer FROM seqs WHERE length(seq) >= 9),
c AS (SELECT least(kmer, reverse(translate(kmer, 'ACTG', 'TGAC'))) AS kmer FROM k)
SELECT kmer, count(*) AS n FROM c GROUP BY kmer HAVING count(*) >= 3""")
def canonical_kmer_counts(spark: Spark, sf: str) -> Frame:
    k = B.seqs(spark, sf).select(F.explode(S.kmers(F.col("seq"), B.K)).alias("kmer"))
    return k.select(S.canonical_kmer(F.col("kmer")).alias("kmer")).groupBy("kmer").agg(F.count(F.lit(1)).alias("n")).where("n >= 3")


_KMERS = "list_transform(range(1, length({0}) - 7), lambda i: {0}[i:i + 8])"


@query(f"""WITH {B.SEQS}, {B.MARKERS},
m AS (SELECT DISTINCT label, unnest({_KMERS.format('seq')}) AS kmer FROM marker_seqs WHERE length(seq) >= 9),
s AS (SELECT id, seq, reverse(translate(seq, 'ACTG', 'TGAC')) AS rc FROM seqs WHERE length(seq) >= 9),
k AS (SELECT id, unnest({_KMERS.format('seq')}) AS kmer FROM s UNION ALL SELECT id, unnest({_KMERS.format('rc')}) AS kmer FROM s),
h AS (SELECT id, count(*) FILTER (label = 1) AS hap1, count(*) FILTER (label = 2) AS hap2 FROM k JOIN m USING (kmer) GROUP BY id)
SELECT id, hap1, hap2, CASE WHEN hap1 + hap2 <= 100 THEN '#AAAAAA' WHEN hap1 > (hap1 + hap2) * 0.9 THEN '#8888FF' WHEN hap2 > (hap1 + hap2) * 0.9 THEN '#FF8888' ELSE '#FFFF00' END AS color FROM h""")
def kmer_marker_counts(spark: Spark, sf: str) -> Frame:
    markers = B.marker_seqs(spark, sf).select("label", F.explode(S.kmers(F.col("seq"), B.K)).alias("kmer"))
    hits = R.marker_counts(B.seqs(spark, sf), markers, B.K)
    one = lambda x: F.coalesce(F.sum(F.when(F.col("label") == x, F.col("hits"))), F.lit(0))
    both = hits.groupBy("id").agg(one(1).alias("hap1"), one(2).alias("hap2"))
    return both.withColumn("color", S.marker_color(F.col("hap1"), F.col("hap2")))


@query(f"WITH {B.SEQS} SELECT id, md5(reverse(translate(seq, 'ACTG', 'TGAC'))) AS rc_md5 FROM seqs")
def reverse_complements(spark: Spark, sf: str) -> Frame:
    return B.seqs(spark, sf).select("id", F.md5(S.reverse_complement(F.col("seq")).cast("binary")).alias("rc_md5"))


@query("""WITH c AS (SELECT doc_id, n_chars, md5(CAST(doc_id AS VARCHAR)) AS h FROM documents WHERE n_chars >= 1000)
SELECT doc_id, CAST(floor(coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 100000) AS BIGINT) AS chunk FROM c""")
def read_chunks(spark: Spark, sf: str) -> Frame:
    docs = B.read(spark, sf, "documents").where("n_chars >= 1000").select("doc_id", "n_chars")
    return R.chunked_by_range(docs, "n_chars", "doc_id", 100_000).select("doc_id", "chunk")


# paths

_EDGE = f"""{B.PATHS}, e AS (SELECT user_id, unnest(list_transform(range(1, len(path)), lambda i: [path[i], path[i + 1]])) AS s FROM paths),
m AS (SELECT s[1] AS a, s[2] AS b, {flip('s[2]')} AS fb, {flip('s[1]')} AS fa FROM e)"""


@query(f"WITH {_EDGE} SELECT CASE WHEN fb || fa < a || b THEN fb ELSE a END AS a, CASE WHEN fb || fa < a || b THEN fa ELSE b END AS b, count(*) AS n FROM m GROUP BY ALL")
def canonical_edge_coverage(spark: Spark, sf: str) -> Frame:
    return R.edge_multiplicity(B.paths(spark, sf))


@query(f"""WITH {B.PATHS}, t AS (SELECT unnest(list_transform(range(1, len(path) - 1), lambda i: path[i:i + 2])) AS s FROM paths),
o AS (SELECT CASE WHEN s[2][1] = '>' THEN s[1] ELSE {flip('s[3]')} END AS a, CASE WHEN s[2][1] = '>' THEN s[2] ELSE {flip('s[2]')} END AS m, CASE WHEN s[2][1] = '>' THEN s[3] ELSE {flip('s[1]')} END AS b FROM t)
SELECT a, m, b, count(*) AS n FROM o GROUP BY ALL""")
def triplet_support(spark: Spark, sf: str) -> Frame:
    return R.triplet_support(B.paths(spark, sf))


# coverage


@query(f"""WITH {B.COV}, t AS (SELECT sum(coverage * length) / sum(length) AS mean FROM cov WHERE length >= 20000)
SELECT node, round(coverage, 6) AS coverage, length, round(mean, 6) AS mean, round(coverage / mean, 6) AS normalised FROM cov, t""")
def weighted_coverage(spark: Spark, sf: str) -> Frame:
    cov = B.cov(spark, sf)
    out = cov.join(F.broadcast(C.mean_coverage(cov, 20_000)))
    r = lambda c: F.round(c, 6)
    return out.select("node", r(F.col("coverage")).alias("coverage"), "length", r(F.col("mean")).alias("mean"), r(F.col("coverage") / F.col("mean")).alias("normalised"))


@query(f"SELECT brand, round(sum(coverage * length) / sum(length), 6) AS mean, CAST(sum(length) AS BIGINT) AS length, count(*) AS nodes, CAST(count(*) FILTER (length >= 40000) AS BIGINT) AS long_nodes FROM ({f'WITH {B.COV} SELECT * FROM cov'}) GROUP BY brand")
def component_coverage(spark: Spark, sf: str) -> Frame:
    return C.group_mean(B.cov(spark, sf), "brand", 40_000).withColumn("mean", F.round("mean", 6))


@query(f"""WITH {B.COV}, s AS (SELECT brand, coverage, sum(length) AS length FROM cov GROUP BY brand, coverage),
u AS (SELECT *, sum(length) OVER (PARTITION BY brand ORDER BY coverage) AS upto, sum(length) OVER (PARTITION BY brand) AS total FROM s)
SELECT brand, round(min(coverage), 6) AS median FROM u WHERE 2 * upto > total GROUP BY brand""")
def weighted_median_coverage(spark: Spark, sf: str) -> Frame:
    return C.weighted_median(B.cov(spark, sf), "brand").withColumn("median", F.round("median", 6))


@query(f"""WITH {B.COV}, t AS (SELECT floor(sum(coverage * length) / sum(length) * 0.5) AS threshold FROM cov WHERE length >= 30000)
SELECT node, round(coverage, 6) AS coverage, length FROM cov, t WHERE coverage >= threshold""")
def solid_nodes(spark: Spark, sf: str) -> Frame:
    return C.solid_nodes(B.cov(spark, sf), 0.5, 30_000).withColumn("coverage", F.round("coverage", 6))


@query(f"""WITH {B.COV}, a AS (SELECT sum(coverage * length) / sum(length) AS first FROM cov WHERE length >= 10000)
SELECT round(sum(coverage * length) / sum(length), 6) AS mean FROM cov, a WHERE length >= 10000 AND coverage >= first * 0.5 AND coverage <= first * 1.5""")
def refined_mean_coverage(spark: Spark, sf: str) -> Frame:
    return C.refined_mean(B.cov(spark, sf), 10_000).withColumn("mean", F.round("mean", 6))


# intervals


@query(f"""WITH {B.IVALS}, w AS (SELECT key, s, e, max(e) OVER (PARTITION BY key ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM ivals)
SELECT key, CAST(sum(greatest(e - greatest(s, coalesce(m, s)), 0)) AS BIGINT) AS covered FROM w GROUP BY key""")
def interval_union(spark: Spark, sf: str) -> Frame:
    return I.union_length(B.ivals(spark, sf))


@query(f"""WITH {B.IVALS}, d AS (SELECT DISTINCT key, owner, unnest(range(s, e)) AS day FROM ivals),
t AS (SELECT key, day FROM d GROUP BY key, day HAVING count(*) >= 2),
i AS (SELECT key, day, day - row_number() OVER (PARTITION BY key ORDER BY day) AS g FROM t)
SELECT key, CAST(min(day) AS BIGINT) AS s, CAST(max(day) + 1 AS BIGINT) AS e FROM i GROUP BY key, g""")
def ambiguous_intervals(spark: Spark, sf: str) -> Frame:
    return I.ambiguous(B.ivals(spark, sf))


@query(f"""WITH {B.IVALS}, d AS (SELECT DISTINCT key, unnest(range(s, e)) AS day FROM ivals),
n AS (SELECT k.key, r.day FROM (SELECT DISTINCT key FROM ivals) k, (SELECT unnest(range(0, 4000)) AS day) r),
t AS (SELECT n.key, n.day FROM n LEFT JOIN d ON d.key = n.key AND d.day = n.day WHERE d.day IS NULL),
i AS (SELECT key, day, day - row_number() OVER (PARTITION BY key ORDER BY day) AS g FROM t)
SELECT key, CAST(min(day) AS BIGINT) AS s, CAST(max(day) + 1 AS BIGINT) AS e FROM i GROUP BY key, g""")
def layout_gaps(spark: Spark, sf: str) -> Frame:
    iv = B.ivals(spark, sf)
    return I.layout_gaps(iv, iv.select("key", F.lit(4000).cast("long").alias("length")).distinct()).select("key", F.col("s").cast("long"), F.col("e").cast("long"))


@query(f"""WITH {B.IVALS}, w AS (SELECT DISTINCT key, s // 365 AS year, (s // 365) * 365 AS ws, (s // 365) * 365 + 365 AS we FROM ivals)
SELECT i.key, i.owner, i.s, i.e, w.year, greatest(s, ws) AS cs, least(e, we) AS ce FROM ivals i JOIN w ON i.key = w.key AND s < we AND ws < e""")
def clipped_placements(spark: Spark, sf: str) -> Frame:
    iv = B.ivals(spark, sf)
    year = F.floor(F.col("s") / 365)
    windows = iv.select("key", year.alias("year"), (year * 365).alias("ws"), (year * 365 + 365).alias("we")).distinct()
    return I.clipped_to(iv, windows, "key").select("key", "owner", "s", "e", "year", "cs", "ce")


@query(f"""WITH {B.IVALS}, r AS (SELECT key, s, e, owner FROM ivals),
o AS (SELECT *, s < lag(s) OVER w + 50 AND e < lag(e) OVER w + 50 AS joins FROM r WINDOW w AS (PARTITION BY key ORDER BY s, e, owner)),
c AS (SELECT *, sum(CASE WHEN coalesce(joins, false) THEN 0 ELSE 1 END) OVER (PARTITION BY key ORDER BY s, e, owner ROWS UNBOUNDED PRECEDING) AS cluster FROM o)
SELECT key, CAST(cluster AS BIGINT) AS cluster, min(s) AS s, max(e) AS e, count(*) AS n FROM c GROUP BY key, cluster""")
def position_islands(spark: Spark, sf: str) -> Frame:
    rows = B.ivals(spark, sf).select("key", F.col("s").alias("cs"), F.col("e").alias("ce"), F.col("owner").alias("rs"), F.col("owner").alias("re"))
    return I.drifting_clusters(rows, ["key"]).groupBy("key", "cluster").agg(F.min("cs").alias("s"), F.max("ce").alias("e"), F.count(F.lit(1)).alias("n"))


@query("""WITH m AS (SELECT CAST(user_id AS VARCHAR) AS node, event_id * 10 AS s, event_id * 10 + 10 AS e, CASE WHEN value >= 20 THEN 'mat' ELSE 'pat' END AS hap FROM events),
c AS (SELECT *, CASE WHEN lag(hap) OVER w IS NOT DISTINCT FROM hap THEN 0 ELSE 1 END AS new FROM m WINDOW w AS (PARTITION BY node ORDER BY s)),
r AS (SELECT *, sum(new) OVER (PARTITION BY node ORDER BY s ROWS UNBOUNDED PRECEDING) AS run FROM c),
i AS (SELECT node, run, min(s) AS s, max(e) AS e, min(hap) AS hap FROM r GROUP BY node, run),
l AS (SELECT node, max(e) + 5000 AS length FROM m GROUP BY node),
x AS (SELECT i.node, s, CASE WHEN run = max(run) OVER (PARTITION BY i.node) THEN greatest(e, length) ELSE e END AS e, hap FROM i JOIN l USING (node))
SELECT node, s, e, hap FROM x WHERE e - s >= 1000""")
def hap_islands(spark: Spark, sf: str) -> Frame:
    e = B.read(spark, sf, "events")
    marks = e.select(F.col("user_id").cast("string").alias("node"), (F.col("event_id") * 10).alias("s"), (F.col("event_id") * 10 + 10).alias("e"), F.when(F.col("value") >= 20, "mat").otherwise("pat").alias("hap"))
    lengths = marks.groupBy("node").agg((F.max("e") + 5000).alias("length"))
    return I.haplotype_islands(marks, lengths, 1000)


@query("""WITH p AS (SELECT user_id, event_id, event_type, CASE WHEN event_type IN ('error', 'view') THEN CAST(floor(value) AS BIGINT) END AS gap FROM events),
v AS (SELECT *, min(CASE WHEN gap IS NULL THEN event_id END) OVER w AS f, max(CASE WHEN gap IS NULL THEN event_id END) OVER w AS l FROM p WINDOW w AS (PARTITION BY user_id)),
k AS (SELECT *, CASE WHEN gap IS NOT NULL AND lag(gap) OVER (PARTITION BY user_id ORDER BY event_id) IS NOT NULL THEN 0 ELSE 1 END AS new FROM v WHERE event_id BETWEEN f AND l),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS ordinal FROM k)
SELECT user_id, CAST(ordinal AS INTEGER) AS ordinal, min(CASE WHEN gap IS NULL THEN event_type END) AS piece, CAST(sum(gap) AS BIGINT) AS gap FROM r GROUP BY user_id, ordinal""")
def scaffold_gap_merge(spark: Spark, sf: str) -> Frame:
    gap = F.when(F.col("event_type").isin("error", "view"), F.floor("value").cast("long"))
    rows = B.read(spark, sf, "events").select("user_id", "event_id", F.when(gap.isNull(), F.col("event_type")).alias("piece"), gap.alias("gap"))
    return I.merged_gaps(rows, "user_id", "event_id").select("user_id", F.col("event_id").alias("ordinal"), "piece", "gap")


# reads and contacts


@query("""WITH o AS (SELECT l_orderkey AS read, l_partkey AS node, l_quantity AS q, CAST(l_extendedprice AS BIGINT) AS at FROM lineitem),
d AS (SELECT DISTINCT read, node FROM o)
SELECT a.node AS a, b.node AS b, count(*) AS w FROM (SELECT DISTINCT l_orderkey AS read, l_suppkey AS node FROM lineitem) a JOIN (SELECT DISTINCT l_orderkey AS read, l_suppkey AS node FROM lineitem) b ON a.read = b.read AND a.node < b.node GROUP BY ALL""")
def contact_pairs(spark: Spark, sf: str) -> Frame:
    found = R.within_read_pairs(B.pairs(spark, sf)).withColumn("w", F.lit(1))
    return R.contact_weights(found)


@query("""WITH g AS (SELECT l_orderkey AS read, l_suppkey AS node, date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS place FROM lineitem),
p AS (SELECT node, place, lag(place) OVER (PARTITION BY node ORDER BY place, read) AS before FROM g),
d AS (SELECT node, list_sort(list(place - before)) AS l FROM p WHERE before IS NOT NULL GROUP BY node)
SELECT node, CAST(l[len(l) // 2 + 1] AS BIGINT) AS gap, CAST(len(l) AS BIGINT) AS support FROM d WHERE len(l) >= 3""")
def consecutive_gap_upper_median(spark: Spark, sf: str) -> Frame:
    rows = B.read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("read"), F.col("l_suppkey").alias("node"), F.datediff("l_shipdate", F.lit("1992-01-01")).cast("long").alias("at"))
    gaps = R.consecutive(rows, "node", ["at", "read"], ["at"]).where("prev_at IS NOT NULL").select("node", (F.col("at") - F.col("prev_at")).alias("gap"))
    return gaps.groupBy("node").agg(R.upper_median(F.collect_list("gap")).alias("gap"), F.count(F.lit(1)).alias("support")).where("support >= 3")


@query("""WITH c AS (SELECT least(l_suppkey, l_partkey) AS a, greatest(l_suppkey, l_partkey) AS b, CAST(l_extendedprice * 10 AS BIGINT) AS ca, CAST(l_quantity AS BIGINT) * 10000 AS cb FROM lineitem WHERE l_suppkey <> l_partkey)
SELECT a, b, CAST((ca + 20000) // 40000 * 40000 AS BIGINT) AS ca, CAST((cb + 20000) // 40000 * 40000 AS BIGINT) AS cb, count(*) AS w FROM c GROUP BY 1, 2, 3, 4""")
def bucketed_contacts(spark: Spark, sf: str) -> Frame:
    rows = B.read(spark, sf, "lineitem").where("l_suppkey <> l_partkey")
    at = F.expr("cast(round(l_extendedprice * 10) as bigint)")
    return R.bucketed_contacts(rows.select(F.least("l_suppkey", "l_partkey").alias("a"), F.greatest("l_suppkey", "l_partkey").alias("b"), at.alias("ca"), (F.col("l_quantity").cast("long") * 10000).alias("cb"), F.lit(1).alias("w")))


@query("""WITH c AS (SELECT l_orderkey AS read, l_linenumber AS line, l_suppkey AS a, l_partkey AS b, CAST(l_quantity AS BIGINT) AS ca, CAST(l_quantity AS BIGINT) + l_linenumber AS cb FROM lineitem),
h AS (SELECT DISTINCT l_suppkey AS a, l_partkey AS b, CAST(l_quantity AS BIGINT) - 5 AS s, CAST(l_quantity AS BIGINT) + 2 AS e FROM lineitem WHERE l_tax >= 0.06)
SELECT read, a, b, ca, cb FROM c WHERE a <> b AND NOT EXISTS (SELECT 1 FROM h WHERE h.a = c.a AND h.b = c.b AND ca BETWEEN s AND e AND cb BETWEEN s AND e)""")
def contact_filter(spark: Spark, sf: str) -> Frame:
    rows = B.read(spark, sf, "lineitem")
    q = F.col("l_quantity").cast("long")
    contacts = rows.select(F.col("l_orderkey").alias("read"), F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b"), q.alias("ca"), (q + F.col("l_linenumber")).alias("cb"))
    homology = rows.where("l_tax >= 0.06").select(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b"), (q - 5).alias("as"), (q + 2).alias("ae"), (q - 5).alias("bs"), (q + 2).alias("be")).distinct()
    return R.filtered_contacts(contacts, homology)


@query("SELECT read, contig, score FROM (SELECT l_orderkey AS read, l_suppkey AS contig, l_extendedprice AS score, rank() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC) AS r FROM lineitem) WHERE r = 1")
def best_placement_ties(spark: Spark, sf: str) -> Frame:
    return R.best_with_ties(B.placements(spark, sf), "read", "score")


@query("""WITH h AS (SELECT l_suppkey AS q, p_brand AS r, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS covered FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
t AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY covered DESC, r) AS n FROM h)
SELECT q, max(CASE WHEN n = 1 THEN r END) AS best, max(CASE WHEN n = 1 THEN covered END) AS best_score, max(CASE WHEN n = 2 THEN covered END) AS second_score,
  round(max(CASE WHEN n = 1 THEN covered END) / max(CASE WHEN n = 2 THEN covered END), 9) AS ratio FROM t WHERE n <= 2 GROUP BY q""")
def second_best_ratio(spark: Spark, sf: str) -> Frame:
    h = B.read(spark, sf, "lineitem").join(B.read(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    h = h.groupBy(F.col("l_suppkey").alias("q"), F.col("p_brand").alias("r")).agg(F.sum(F.col("l_quantity").cast("long")).alias("covered"))
    return R.best_and_second(h, "q", "r", "covered").withColumn("ratio", F.round("ratio", 9))


@query("""WITH s AS (SELECT 'p' || p_brand AS a, 's' || l_suppkey AS b, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS w FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
x AS (SELECT a AS x, b AS y, w FROM s UNION ALL SELECT b, a, w FROM s),
t AS (SELECT *, max(w) OVER (PARTITION BY x) AS top FROM x),
o AS (SELECT x, min(y) AS y, min(w) AS w FROM t WHERE w = top GROUP BY x HAVING count(*) = 1)
SELECT o.x AS a, o.y AS b, o.w FROM o JOIN o AS p ON o.y = p.x AND p.y = o.x WHERE o.x < o.y""")
def mutual_best(spark: Spark, sf: str) -> Frame:
    h = B.read(spark, sf, "lineitem").join(B.read(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return R.mutual_best(h.groupBy(F.concat(F.lit("p"), "p_brand").alias("a"), F.concat(F.lit("s"), "l_suppkey").alias("b")).agg(F.sum(F.col("l_quantity").cast("long")).alias("w")))


@query("SELECT l_orderkey AS read, l_suppkey AS contig, l_extendedprice AS score FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) <= 4)")
def copy_guard(spark: Spark, sf: str) -> Frame:
    return R.copy_guard(B.placements(spark, sf), "read", 4)


@query("""WITH m AS (SELECT l_suppkey AS read, l_extendedprice AS idy, avg(l_extendedprice) OVER (PARTITION BY l_suppkey) AS mean FROM lineitem)
SELECT read, round(median(idy), 4) AS median, round(avg(abs(idy - mean)), 4) AS mad FROM m GROUP BY read""")
def identity_mad(spark: Spark, sf: str) -> Frame:
    rows = B.read(spark, sf, "lineitem").select(F.col("l_suppkey").alias("read"), F.col("l_extendedprice").alias("idy"))
    return R.identity_spread(rows).select("read", F.round("median", 4).alias("median"), F.round("mad", 4).alias("mad"))


@query("""WITH w AS (SELECT l_partkey AS node, CAST(l_suppkey % 2 AS INTEGER) AS side, CAST(l_quantity AS BIGINT) AS w FROM lineitem),
s AS (SELECT node, CAST(coalesce(sum(w) FILTER (side = 0), 0) AS BIGINT) AS w0, CAST(coalesce(sum(w) FILTER (side = 1), 0) AS BIGINT) AS w1 FROM w GROUP BY node)
SELECT node, w0, w1, CASE WHEN w0 > w1 * 2.5 THEN 0 WHEN w1 > w0 * 2.5 THEN 1 ELSE 2 END AS side FROM s""")
def side_majority(spark: Spark, sf: str) -> Frame:
    return R.majority_side(B.read(spark, sf, "lineitem").select(F.col("l_partkey").alias("node"), (F.col("l_suppkey") % 2).cast("int").alias("side"), F.col("l_quantity").cast("long").alias("w")))


@query(f"""WITH {B.PATHS}, n AS (SELECT path[1][2:] AS node, user_id, path FROM paths),
l AS (SELECT node, arg_max(path, [CAST(1000 + len(path) AS VARCHAR), array_to_string(path, chr(9))]) AS longest FROM n GROUP BY node)
SELECT node, bool_and(longest[1:len(path)] = path) AS consistent FROM n JOIN l USING (node) GROUP BY node""")
def path_prefix_consistency(spark: Spark, sf: str) -> Frame:
    p = B.paths(spark, sf).select(P.bare(F.col("path")[0]).alias("node"), "path")
    return R.prefix_consistent(p)


@query("""WITH n AS (SELECT 'tig000' || s_suppkey AS name, s_nationkey FROM supplier), m AS (SELECT 'tig000' || s_suppkey AS old, s_name AS new FROM supplier WHERE s_suppkey % 3 = 0)
SELECT coalesce(new, regexp_replace(name, '^tig0*', '')) AS name, s_nationkey FROM n LEFT JOIN m ON name = old""")
def name_map_rename(spark: Spark, sf: str) -> Frame:
    s = B.read(spark, sf, "supplier").withColumn("name", F.concat(F.lit("tig000"), "s_suppkey"))
    names = s.where("s_suppkey % 3 = 0").select(F.col("name").alias("old"), F.col("s_name").alias("new"))
    return R.renamed(s.select("name", "s_nationkey"), names)


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size >= 40) AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)""")
def semi_anti_filters(spark: Spark, sf: str) -> Frame:
    kept = R.members_only(B.read(spark, sf, "lineitem"), B.read(spark, sf, "part").where("p_size >= 40").select(F.col("p_partkey").alias("name")), "l_partkey")
    return R.members_only(kept, B.read(spark, sf, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("name")), "l_suppkey", invert=True).select("l_orderkey", "l_linenumber", "l_partkey")


@query(f"""WITH {B.IVALS}, r AS (SELECT key AS name, owner AS ref, min(s) AS s, max(e) AS e FROM ivals GROUP BY key, owner),
n AS (SELECT ref, name AS a, lead(name) OVER w AS b, lead(s) OVER w - e AS distance FROM r WINDOW w AS (PARTITION BY ref ORDER BY s, e, name))
SELECT ref, a, b, distance FROM n WHERE b IS NOT NULL""")
def next_on_reference(spark: Spark, sf: str) -> Frame:
    places = B.ivals(spark, sf).groupBy(F.col("key").alias("name"), F.col("owner").alias("ref")).agg(F.min("s").alias("s"), F.max("e").alias("e"))
    return R.next_on_reference(places)


# graphs

_REACH = f"""RECURSIVE {B.LINKS}, n AS (SELECT a AS node FROM links UNION SELECT b FROM links), e AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
r AS (SELECT node, node AS other FROM n UNION SELECT r.node, e.b FROM r JOIN e ON r.other = e.a),
c AS (SELECT node, min(other) AS component FROM r GROUP BY node)"""


@query(f"WITH {_REACH} SELECT node, component FROM c")
def components(spark: Spark, sf: str) -> Frame:
    found = B.links(spark, sf)
    return node_components(found.select(F.col("a").alias("node")).union(found.select("b")), found)


@query(f"WITH {_REACH} SELECT component, count(*) AS nodes FROM c GROUP BY component HAVING count(*) > 3")
def tangles(spark: Spark, sf: str) -> Frame:
    found = B.links(spark, sf)
    nodes = found.select(F.col("a").alias("node")).union(found.select("b")).distinct().withColumn("length", F.lit(1))
    arcs = G.arcs(found.select(F.col("a").alias("src"), F.lit(True).alias("src_fw"), F.col("b").alias("dst"), F.lit(True).alias("dst_fw"), F.lit(0).alias("overlap")))
    return G.nodes_in_tangles(nodes, arcs, 10, 3).groupBy("component").agg(F.count(F.lit(1)).alias("nodes"))


@query(f"""WITH {_EDGE}, g AS (SELECT DISTINCT a AS u, b AS v FROM m WHERE a[2:] <= b[2:] UNION SELECT DISTINCT fb, fa FROM m WHERE a[2:] <= b[2:]),
n AS (SELECT DISTINCT '>' || event_type AS node FROM events UNION SELECT DISTINCT '<' || event_type FROM events)
SELECT node AS "end", count(DISTINCT v) AS out FROM n LEFT JOIN g ON u = node GROUP BY node""")
def node_degrees(spark: Spark, sf: str) -> Frame:
    edges = B.paths(spark, sf).select(F.explode(P.steps(F.col("path"), 2)).alias("s")).where(P.bare(F.col("s")[0]) <= P.bare(F.col("s")[1])).distinct()
    arcs = G.arcs(edges.select(P.bare(F.col("s")[0]).alias("src"), F.col("s")[0].startswith(">").alias("src_fw"), P.bare(F.col("s")[1]).alias("dst"), F.col("s")[1].startswith(">").alias("dst_fw"), F.lit(0).alias("overlap")))
    return G.degrees(B.read(spark, sf, "events").select(F.col("event_type").alias("node")).distinct(), arcs)


@query(f"""WITH {B.LINKS}, n AS (SELECT a AS node FROM links UNION SELECT b FROM links), u AS (SELECT '>' || a AS u FROM links UNION SELECT '<' || b FROM links)
SELECT node AS "end" FROM (SELECT '>' || node AS node FROM n UNION SELECT '<' || node FROM n) WHERE node NOT IN (SELECT u FROM u)""")
def tips(spark: Spark, sf: str) -> Frame:
    found = B.links(spark, sf)
    arcs = G.arcs(found.select(F.col("a").alias("src"), F.lit(True).alias("src_fw"), F.col("b").alias("dst"), F.lit(True).alias("dst_fw"), F.lit(0).alias("overlap")))
    return G.tips(found.select(F.col("a").alias("node")).union(found.select("b")).distinct(), arcs)


@query(f"""WITH {B.LINKS}, s AS (SELECT a AS x, b AS y FROM links UNION SELECT b, a FROM links), d AS (SELECT x, count(*) AS degree FROM s GROUP BY x)
SELECT round(avg(degree), 9) AS mean, round(stddev_pop(degree), 9) AS deviation, round(avg(degree) + 5 * stddev_pop(degree), 9) AS "limit" FROM d""")
def degree_stats(spark: Spark, sf: str) -> Frame:
    return C.degree_statistics(B.links(spark, sf)).select(*[F.round(c, 9).alias(c) for c in ("mean", "deviation", "limit")])


EDGES = """links AS (SELECT DISTINCT 'p' || l_partkey AS a, 's' || l_suppkey AS b FROM lineitem), s AS (SELECT a AS x, b AS y FROM links UNION SELECT b, a FROM links)"""


@query(f"""WITH {EDGES}, d AS (SELECT x, count(*) AS degree FROM s GROUP BY x)
SELECT round(avg(degree), 9) AS mean, round(stddev_pop(degree), 9) AS deviation, round(avg(degree) + 5 * stddev_pop(degree), 9) AS "limit" FROM d""")
def degree_stats_all_links(spark: Spark, sf: str) -> Frame:
    """As degree_stats, over the links of all rows."""
    return C.degree_statistics(B.all_links(spark, sf)).select(*[F.round(c, 9).alias(c) for c in ("mean", "deviation", "limit")])


def _spread(rounds: int) -> str:
    return ",\n".join(f"l{i + 1} AS MATERIALIZED (SELECT x AS node, least(min(o.label), min(q.label)) AS label FROM s JOIN l{i} o ON o.node = x JOIN l{i} q ON q.node = y GROUP BY x)" for i in range(rounds))


@query(f"""WITH {EDGES}, l0 AS (SELECT DISTINCT x AS node, x AS label FROM s),
{_spread(12)}
SELECT node, label AS component FROM l12""")
def components_all_links(spark: Spark, sf: str) -> Frame:
    """Components of the links of all rows: hubs with most nodes in one component. The SQL spreads labels over 12 links, more than any two nodes are apart here."""
    links = B.all_links(spark, sf)
    nodes = links.select(F.col("a").alias("node")).union(links.select("b"))
    return node_components(nodes, links)


@query(f"""WITH RECURSIVE {B.LINKS}, e AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
z AS (SELECT 'p' || p_partkey AS node, CAST(p_size AS BIGINT) AS size FROM part UNION ALL SELECT 's' || s_suppkey, 20 FROM supplier),
r AS (SELECT node, size AS lim, 0 AS hop FROM z WHERE node IN (SELECT a FROM links) AND size BETWEEN 5 AND 12
  UNION SELECT e.b, r.lim, hop + 1 FROM r JOIN e ON r.node = e.a JOIN z ON z.node = e.b WHERE hop < 4 AND z.size <= r.lim * 4)
SELECT DISTINCT node FROM r""")
def neighbour_extension(spark: Spark, sf: str) -> Frame:
    found = B.links(spark, sf)
    sizes = B.read(spark, sf, "part").select(F.concat(F.lit("p"), "p_partkey").alias("node"), F.col("p_size").cast("long").alias("size")).union(B.read(spark, sf, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("node"), F.lit(20).cast("long")))
    start = sizes.where("size BETWEEN 5 AND 12").join(found.select(F.col("a").alias("node")).distinct(), "node", "left_semi")
    return G.neighbours_within(start, found, sizes)


@query(f"WITH {B.LINKS} SELECT 'p' || p_partkey AS node, p_size FROM part WHERE p_size < 25 AND 'p' || p_partkey NOT IN (SELECT a FROM links)")
def disconnected_short(spark: Spark, sf: str) -> Frame:
    from ..operators import screen

    parts = B.read(spark, sf, "part").select(F.concat(F.lit("p"), "p_partkey").alias("node"), "p_size")
    return screen.disconnected(parts, B.links(spark, sf), "p_size", 25)


@query("""WITH RECURSIVE m AS (SELECT 'r' || r_regionkey AS name, list('>' || 'n' || n_nationkey ORDER BY n_nationkey) AS path FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY r_regionkey
  UNION ALL SELECT 'n' || s_nationkey, list(CASE WHEN s_suppkey % 2 = 0 THEN '<' ELSE '>' END || 's' || s_suppkey ORDER BY s_suppkey) FROM supplier GROUP BY s_nationkey),
u AS (SELECT name, unnest(path) AS step, unnest(range(1, len(path) + 1)) AS i FROM m),
x AS (SELECT 'r' || r_regionkey AS name, '>' || 'r' || r_regionkey AS node, CAST([0] AS BIGINT[]) AS place FROM region
  UNION ALL SELECT x.name, u.step, list_append(x.place, u.i) FROM x JOIN u ON u.name = x.node[2:])
SELECT name, CAST(row_number() OVER (PARTITION BY name ORDER BY place) - 1 AS INTEGER) AS pos, node AS leaf FROM x WHERE node[2:] NOT IN (SELECT name FROM m)""")
def lineage_expand(spark: Spark, sf: str) -> Frame:
    n = B.read(spark, sf, "nation")
    s = B.read(spark, sf, "supplier")
    inner = lambda key, rows: rows.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "step"))), lambda x: x["step"]).alias("path"))
    regions = inner("name", n.select(F.concat(F.lit("r"), "n_regionkey").alias("name"), F.col("n_nationkey").cast("long").alias("k"), F.concat(F.lit(">n"), "n_nationkey").alias("step")))
    nations = inner("name", s.select(F.concat(F.lit("n"), "s_nationkey").alias("name"), F.col("s_suppkey").alias("k"), F.concat(F.when(F.col("s_suppkey") % 2 == 0, "<s").otherwise(">s"), "s_suppkey").alias("step")))
    return G.lineage_leaves(regions.unionByName(nations), regions.select("name"))
