"""Queries of text formats written and read back, and of the steps on paths and patterns, each with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from ..functions import paths as P
from ..operators import bridges as BR
from ..operators import relations as R
from ..sources import bam, overlaps, sinks, text
from . import bindings as B
from .file_queries import _folder
from .queries import Frame, Spark, query


def _written(spark: Spark, rows: Frame, value: Column, name: str) -> str:
    path = _folder(spark, name)
    rows.select(value.alias("value")).write.text(path)
    return path


def _named(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _sold(spark: Spark, sf: str) -> Frame:
    """Sold items with names for their part, supplier and order, and their quantity as a whole number."""
    li = B.read(spark, sf, "lineitem")
    names = [_named("p", "l_partkey").alias("part"), _named("s", "l_suppkey").alias("supplier"), _named("o", "l_orderkey").alias("order")]
    return li.select("l_orderkey", "l_partkey", "l_suppkey", F.col("l_linenumber").cast("long").alias("line"), F.col("l_quantity").cast("long").alias("n"), *names)


SOLD = """sold AS (SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS line, CAST(l_quantity AS BIGINT) AS n,
  'p' || l_partkey AS part, 's' || l_suppkey AS supplier, 'o' || l_orderkey AS "order" FROM lineitem)"""


@query(f"""WITH {SOLD} SELECT "order" AS name, '>' || part || '<' || supplier AS path, line AS left_clip, n % 7 AS right_clip FROM sold""")
def node_map_round_trip(spark: Spark, sf: str) -> Frame:
    path = _folder(spark, "node-map")
    steps = F.array(F.concat(F.lit(">"), "part"), F.concat(F.lit("<"), "supplier"))
    sinks.write_node_map(_sold(spark, sf).select(F.col("order").alias("name"), steps.alias("path"), F.col("line").alias("left_clip"), (F.col("n") % 7).alias("right_clip")), path)
    return text.node_map(spark, path).withColumn("path", P.spelled(F.col("path")))


@query(f"""WITH {SOLD} SELECT "order" AS name, '>' || part || '[N' || least(CAST(round_even(n * 1000 * line * 1.5, 0) AS BIGINT), 100000) || 'N]<' || supplier AS path,
  CASE WHEN line % 2 = 0 THEN 'HAPLOTYPE' || line ELSE 'NA' END AS assignment FROM sold""")
def haplotype_paths_round_trip(spark: Spark, sf: str) -> Frame:
    rows = _sold(spark, sf)
    gap = F.concat(F.lit("[N"), (F.col("n") * 1000 * F.col("line")).cast("string"), F.lit("N:scaffold]"))
    spelled = F.when(F.col("line") % 3 == 0, F.concat(F.lit(">"), "part", gap, F.lit("<"), "supplier")).otherwise(F.concat("part", F.lit("+,"), gap, F.lit(","), "supplier", F.lit("-")))
    side = F.when(F.col("line") % 2 == 0, _named("HAPLOTYPE", "line"))
    path = _written(spark, rows, sinks.tsv("order", spelled, side), "paths")
    return text.paths(spark, path, stretch_gaps=1.5).withColumn("path", P.spelled(F.col("path")))


@query(f"""WITH {SOLD} SELECT part AS "old", CASE WHEN line % 2 = 0 THEN part ELSE supplier END AS "new" FROM sold""")
def name_map_round_trip(spark: Spark, sf: str) -> Frame:
    words = F.concat_ws(" ", F.lit(""), F.col("part"), F.when(F.col("line") % 2 == 1, F.col("supplier")))
    return text.name_map(spark, _written(spark, _sold(spark, sf), words, "name-map"))


@query(f"""WITH {SOLD} SELECT supplier AS tig, CAST(l_suppkey * 1000 AS BIGINT) AS len, "order" AS read, CAST(l_partkey * 10 + CASE WHEN line % 2 = 0 THEN n ELSE 0 END AS BIGINT) AS bgn,
  CAST(l_partkey * 10 + CASE WHEN line % 2 = 0 THEN 0 ELSE n END AS BIGINT) AS "end", CAST(line AS INTEGER) AS copies, 0 AS flag FROM sold""")
def layout_round_trip(spark: Spark, sf: str) -> Frame:
    rows = _sold(spark, sf)
    at, back = F.col("l_partkey") * 10, F.col("line") % 2 == 0
    placed = rows.select(F.col("supplier").alias("contig"), F.col("order").alias("read"), (at + F.when(back, F.col("n")).otherwise(0)).alias("bgn"), (at + F.when(back, 0).otherwise(F.col("n"))).alias("end"), F.col("line").alias("copies"))
    sizes = rows.select(F.col("supplier").alias("contig"), (F.col("l_suppkey") * 1000).cast("long").alias("length")).distinct()
    path = _folder(spark, "layout")
    sinks.write_layout(placed, sizes, path)
    return text.layouts(spark, path)


@query(f"""WITH {SOLD}, x AS (SELECT *, CASE WHEN line % 2 = 0 THEN '[N' || n || 'N:x]' ELSE 'piece' || l_partkey END AS t FROM sold)
SELECT "order" AS outname, 'path' || l_orderkey AS pathname, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY line, t) AS INTEGER) AS ordinal,
  CASE WHEN line % 2 = 1 THEN t END AS piece, CASE WHEN line % 2 = 0 THEN n END AS gap FROM x""")
def scaffold_map_round_trip(spark: Spark, sf: str) -> Frame:
    piece = F.when(F.col("line") % 2 == 0, F.concat(F.lit("[N"), F.col("n").cast("string"), F.lit("N:x]"))).otherwise(_named("piece", "l_partkey"))
    blocks = _sold(spark, sf).groupBy("l_orderkey", "order").agg(F.array_sort(F.collect_list(F.struct("line", piece.alias("t")))).alias("s"))
    inner = F.array_join(F.transform("s", lambda x: x["t"]), "\n")
    block = F.concat(F.lit("path "), "order", F.lit(" "), _named("path", "l_orderkey"), F.lit("\n"), inner, F.lit("\nend"))
    return text.scaffold_map(spark, _written(spark, blocks, block, "scaffolds")).withColumn("gap", F.col("gap").cast("long"))


@query(f"""WITH {SOLD} SELECT supplier AS q, part AS r, n * 1000 AS blen, CAST(l_suppkey * 100 AS BIGINT) AS qlen, CASE WHEN line % 2 = 0 THEN '+' ELSE '-' END AS strand,
  CAST(line AS INTEGER) AS mapq, CASE WHEN line < 4 THEN n / 64 END AS idy FROM sold WHERE n * 1000 >= 25000 AND length(supplier) >= 3""")
def homology_round_trip(spark: Spark, sf: str) -> Frame:
    zero, size = F.lit(0), F.col("n") * 1000
    strand = F.when(F.col("line") % 2 == 0, F.lit("+")).otherwise(F.lit("-"))
    idy = F.when(F.col("line") < 4, F.concat(F.lit("id:f:"), (F.col("n") / 64).cast("string"))).otherwise(F.lit("kc:f:0.5"))
    line = sinks.tsv("supplier", F.col("l_suppkey") * 100, zero, size, strand, "part", F.col("l_partkey") * 100, zero, size, "n", size, "line", idy)
    # Aligners of either habit: columns by tabs or by blanks.
    line = F.when(F.col("line") % 3 == 0, F.translate(line, "\t", " ")).otherwise(line)
    return text.homology(spark, _written(spark, _sold(spark, sf), line, "homology"), 25_000).select("q", "r", "blen", "qlen", "strand", "mapq", "idy")


@query(f"""WITH {SOLD}, m AS (SELECT "order" AS read, unnest([part, supplier]) AS x, l_partkey, l_suppkey, line, n FROM sold),
e AS (SELECT read, x, unnest(['p' || l_suppkey, 's' || l_partkey]) AS y, line AS w, l_partkey AS cx, n AS cy FROM m)
SELECT read, least(x, y) AS a, greatest(x, y) AS b, w, CAST(CASE WHEN x > y THEN cy ELSE cx END AS BIGINT) AS ca, CAST(CASE WHEN x > y THEN cx ELSE cy END AS BIGINT) AS cb FROM e WHERE x <> y""")
def multimapped_contacts(spark: Spark, sf: str) -> Frame:
    both = F.concat("part", F.lit(","), "supplier")
    other = F.concat(_named("p", "l_suppkey"), F.lit(","), _named("s", "l_partkey"))
    return text.contacts(spark, _written(spark, _sold(spark, sf), sinks.tsv("order", both, other, "line", "l_partkey", "n"), "contacts"), multimappers=True)


@query(f"""WITH {SOLD} SELECT "order" AS read, part AS node, CAST(l_suppkey AS BIGINT) AS at, CAST(n % 5 AS INTEGER) AS mapq FROM sold WHERE n % 5 >= 2 AND line % 4 <> 0""")
def sam_rows(spark: Spark, sf: str) -> Frame:
    node = F.when(F.col("line") % 4 == 0, F.lit("*")).otherwise(F.col("part"))
    row = F.when(F.col("line") == 7, F.concat(F.lit("@SQ\tSN:"), "part", F.lit("\n"))).otherwise(F.lit(""))
    line = F.concat(row, sinks.tsv("order", F.lit(0), node, "l_suppkey", F.col("n") % 5, F.lit("100M")))
    return text.sam_pairs(spark, _written(spark, _sold(spark, sf), line, "sam"), 2)


@query(f"""WITH {SOLD}, b AS (SELECT part AS node, n * 2000 AS s, n * 2000 + 500 AS e FROM sold), k AS (SELECT 'p' || p_partkey AS node, p_size * 5000 AS length FROM part)
SELECT '<' || node AS "end" FROM b JOIN k USING (node) WHERE s < 20000 UNION SELECT '>' || node FROM b JOIN k USING (node) WHERE length - e < 20000""")
def telomeric_node_ends(spark: Spark, sf: str) -> Frame:
    path = _written(spark, _sold(spark, sf), sinks.tsv("part", F.col("n") * 2000, F.col("n") * 2000 + 500), "telomeres")
    size = B.read(spark, sf, "part").select(_named("p", "p_partkey").alias("node"), (F.col("p_size") * 5000).cast("long").alias("length"))
    return text.telomeric_ends(text.bed(spark, path), size)


@query(f"""WITH {B.SEQS}, c AS (SELECT id, seq FROM seqs WHERE seq <> '')
SELECT CAST(id AS VARCHAR) AS name, CAST(2 * length(seq) + 5 AS BIGINT) AS length, md5(seq || 'NNNNN' || reverse(translate(seq, 'ACTG', 'TGAC'))) AS seq_md5 FROM c""")
def spelled_paths(spark: Spark, sf: str) -> Frame:
    seqs = B.seqs(spark, sf).where("seq <> ''").select(F.col("id").cast("string").alias("name"), "seq")
    there_and_back = F.array(F.concat(F.lit(">"), "name"), F.lit("[N5N:turn]"), F.concat(F.lit("<"), "name"))
    spelled = sinks.path_sequences(seqs.select("name", there_and_back.alias("path")), seqs)
    return spelled.select("name", F.length("seq").cast("long").alias("length"), F.md5(F.col("seq").cast("binary")).alias("seq_md5"))


@query(f"""WITH {SOLD}, m AS (SELECT 'p' || p_partkey AS part FROM part WHERE p_size > 25),
t AS (SELECT l_orderkey, line, sold.part, line % 2 = 0 AS back, m.part IS NOT NULL AS split FROM sold LEFT JOIN m USING (part)),
s AS (SELECT l_orderkey, line, part, CASE WHEN split AND back THEN '>' || part || 'b<' || part || 'a' WHEN split THEN '>' || part || 'a<' || part || 'b' WHEN back THEN '<' || part ELSE '>' || part END AS step FROM t)
SELECT l_orderkey AS read, string_agg(step, '' ORDER BY line, part) AS path FROM s GROUP BY l_orderkey""")
def replaced_path_steps(spark: Spark, sf: str) -> Frame:
    step = F.concat(F.when(F.col("line") % 2 == 0, F.lit("<")).otherwise(F.lit(">")), "part")
    walks = _sold(spark, sf).groupBy(F.col("l_orderkey").alias("read")).agg(F.array_sort(F.collect_list(F.struct("line", "part", step.alias("step")))).alias("s"))
    name = _named("p", "p_partkey")
    mapping = B.read(spark, sf, "part").where("p_size > 25").select(name.alias("name"), F.array(F.concat(F.lit(">"), name, F.lit("a")), F.concat(F.lit("<"), name, F.lit("b"))).alias("path"))
    return BR.replaced_steps(walks.select("read", F.transform("s", lambda x: x["step"]).alias("path")), mapping).withColumn("path", P.spelled(F.col("path")))


@query(f"""WITH {B.SEQS}, p AS (SELECT item_id AS pattern, substr(regexp_replace(upper(text), '[^ACGT]', '', 'g'), 1, 24) AS pseq FROM benchmark)
SELECT id, pattern FROM seqs JOIN p ON length(pseq) >= 15 AND contains(seq, pseq)""")
def contained_patterns(spark: Spark, sf: str) -> Frame:
    patterns = B.read(spark, sf, "benchmark").select(F.col("item_id").alias("pattern"), F.substring(F.regexp_replace(F.upper("text"), "[^ACGT]", ""), 1, 24).alias("pseq"))
    return R.containing(B.seqs(spark, sf), patterns)


@query(f"""WITH {B.COV} SELECT brand, length, grouping(brand) * 2 + grouping(length) AS level, count(*) AS nodes, CAST(sum(length * 1.0) / 1000 AS DOUBLE) AS kilobases, max(coverage) AS highest
FROM cov GROUP BY ROLLUP (brand, length)""")
def coverage_rollup(spark: Spark, sf: str) -> Frame:
    """Nodes, bases and highest coverage by brand and length, by brand, and of all."""
    cov = B.cov(spark, sf).withColumn("bases", F.col("length"))
    level = F.grouping_id().cast("long").alias("level")
    return cov.rollup("brand", "length").agg(level, F.count(F.lit(1)).alias("nodes"), (F.sum("bases") / 1000).alias("kilobases"), F.max("coverage").alias("highest"))


@query(f"""WITH {B.COV} SELECT node, brand, CAST(rank() OVER w AS BIGINT) AS rank, CAST(dense_rank() OVER w AS BIGINT) AS dense, percent_rank() OVER w AS share, first_value(length) OVER w AS longest_first FROM cov
WINDOW w AS (PARTITION BY brand ORDER BY length DESC)""")
def length_ranks(spark: Spark, sf: str) -> Frame:
    """Each node's rank by length among those of its brand, ties sharing one."""
    by = Window.partitionBy("brand").orderBy(F.desc("length"))
    ranks = [F.rank().over(by).cast("long").alias("rank"), F.dense_rank().over(by).cast("long").alias("dense"), F.percent_rank().over(by).alias("share")]
    return B.cov(spark, sf).select("node", "brand", *ranks, F.first("length").over(by).alias("longest_first"))


BAM_ROWS = """bam_rows AS (
  SELECT 'o' || l_orderkey || '/' || l_linenumber AS qname, CAST(l_linenumber * 16 AS INTEGER) AS flag, 's' || l_suppkey % 50 AS rname, CAST(l_partkey AS BIGINT) AS pos, CAST(l_suppkey % 61 AS INTEGER) AS mapq,
    CAST(l_quantity AS BIGINT) || 'M' AS cigar, CASE WHEN l_returnflag = 'N' THEN '*' ELSE 's' || l_partkey % 50 END AS rnext, CAST(l_orderkey % 1000 AS BIGINT) AS pnext, CAST(l_orderkey - l_partkey AS BIGINT) AS tlen,
    substr(repeat('GATTACAN', 8), 1, CAST(l_quantity AS INTEGER)) AS seq, CASE WHEN l_linestatus = 'F' THEN '*' ELSE repeat('I', CAST(l_quantity AS INTEGER)) END AS qual,
    'NM:I:' || l_linenumber || chr(9) || 'RG:Z:' || l_returnflag || l_linestatus AS tags FROM lineitem)"""


@query(f"WITH {BAM_ROWS} SELECT * FROM bam_rows")
def bam_round_trip(spark: Spark, sf: str) -> Frame:
    """All sold items as alignments, written as BAM files and read back in ranges of compressed bytes."""
    li = B.read(spark, sf, "lineitem")
    n = F.col("l_quantity").cast("int")
    rows = li.select(
        F.concat(F.lit("o"), "l_orderkey", F.lit("/"), "l_linenumber").alias("qname"), (F.col("l_linenumber") * 16).cast("int").alias("flag"), F.concat(F.lit("s"), F.col("l_suppkey") % 50).alias("rname"),
        F.col("l_partkey").cast("long").alias("pos"), (F.col("l_suppkey") % 61).cast("int").alias("mapq"), F.concat(n.cast("string"), F.lit("M")).alias("cigar"),
        F.when(F.col("l_returnflag") == "N", F.lit("*")).otherwise(F.concat(F.lit("s"), F.col("l_partkey") % 50)).alias("rnext"), (F.col("l_orderkey") % 1000).cast("long").alias("pnext"),
        (F.col("l_orderkey") - F.col("l_partkey")).cast("long").alias("tlen"), F.substring(F.repeat(F.lit("GATTACAN"), F.lit(8)), F.lit(1), n).alias("seq"),
        F.when(F.col("l_linestatus") == "F", F.lit("*")).otherwise(F.repeat(F.lit("I"), n)).alias("qual"), F.concat(F.lit("NM:I:"), "l_linenumber", F.lit("\tRG:Z:"), "l_returnflag", "l_linestatus").alias("tags"),
    )
    path = _folder(spark, "bam")
    bam.write_bam(rows, path, [(f"s{i}", 1 << 28) for i in range(50)])
    return bam.read_bam(spark, path, 1_000_000).drop("file", "block", "at", "next_block", "next_at")


@query("""WITH o AS (SELECT l_orderkey AS a, l_partkey + 10000000 AS b, CAST(l_quantity AS BIGINT) AS n FROM lineitem)
SELECT a, count(*) AS overlaps, sum(n)::BIGINT AS bases, max(b) AS last FROM (SELECT * FROM o UNION ALL SELECT b, a, n FROM o) GROUP BY a""")
def overlap_store(spark: Spark, sf: str) -> Frame:
    """Sold items as overlaps of orders with parts, kept in a store and read back from it: the overlaps of each read."""
    li = B.read(spark, sf, "lineitem")
    both = overlaps.mirrored(li.select(F.col("l_orderkey").alias("a"), (F.col("l_partkey") + 10_000_000).alias("b"), F.col("l_quantity").cast("long").alias("n")))
    path = _folder(spark, "overlaps")
    overlaps.write_overlaps(both, path)
    return overlaps.overlaps_of(spark, path, 0).groupBy("a").agg(F.count(F.lit(1)).alias("overlaps"), F.sum("n").alias("bases"), F.max("b").alias("last"))
