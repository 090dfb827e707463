"""Writers of assembly text formats. The canonical form of every table is Parquet; these are for other tools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import paths as P
from ..functions import sequences as S


def _text(df: DataFrame, value: Column, path: str, compression: str = "none") -> None:
    df.select(value.alias("value")).write.mode("errorifexists").option("compression", compression).text(path)


def tsv(*columns: str | Column) -> Column:
    return F.concat_ws("\t", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns])


def gfa_lines(nodes: DataFrame, arcs: DataFrame, with_sequences: bool = True) -> DataFrame:
    """(kind, value): S lines of nodes (node, seq, length[, tag]) and L lines of one of each arc and its mirror."""
    seq = F.col("seq") if with_sequences else F.lit("*")
    tag = F.col("tag") if "tag" in nodes.columns else F.lit(None).cast("string")
    s = nodes.select(F.lit(0).alias("kind"), F.concat_ws("\t", F.lit("S"), "node", seq, F.concat(F.lit("LN:i:"), F.col("length").cast("string")), tag).alias("value"))
    sign = lambda c: F.when(F.col(c).startswith(">"), "+").otherwise("-")
    edge = P.canonical_edge(F.col("u"), F.col("v"))
    one = arcs.select(edge[0].alias("u"), edge[1].alias("v"), "overlap").distinct()
    link = one.select(F.lit(1).alias("kind"), F.concat_ws("\t", F.lit("L"), P.bare(F.col("u")), sign("u"), P.bare(F.col("v")), sign("v"), F.concat(F.col("overlap").cast("string"), F.lit("M"))).alias("value"))
    return s.unionByName(link)


def write_gfa(nodes: DataFrame, arcs: DataFrame, path: str, with_sequences: bool = True) -> None:
    """S lines first, then L lines, each sorted; ordered by range, so the files concatenate in order."""
    gfa_lines(nodes, arcs, with_sequences).orderBy("kind", "value").select("value").write.text(path)


def write_node_map(mapping: DataFrame, path: str) -> None:
    _text(mapping, F.concat("name", F.lit("\t"), P.spelled(F.col("path")), F.lit(":"), F.col("left_clip").cast("string"), F.lit(":"), F.col("right_clip").cast("string")), path)


def write_fasta(sequences: DataFrame, path: str, compression: str = "none") -> None:
    _text(sequences, F.concat(F.lit(">"), "name", F.lit("\n"), "seq"), path, compression)


def write_coverage(cov: DataFrame, path: str) -> None:
    cov.select("node", "coverage", "length").write.option("sep", "\t").option("header", True).csv(path)


def write_gaf(alignments: DataFrame, path: str) -> None:
    _text(alignments, tsv("read", "rlen", "rstart", "rend", "strand", P.spelled(F.col("path")), "plen", "pstart", "pend", "nmatch", "alen", "mapq"), path)


def write_colors(nodes: DataFrame, path: str) -> None:
    """nodes: node, side 0, 1 or else; a colour table with display colours."""
    # The display colours of the colour table.
    color = F.when(F.col("side") == 0, F.lit("#FF8888")).when(F.col("side") == 1, F.lit("#8888FF")).otherwise(F.lit("#FFFF00"))
    weight = F.when(F.col("side") == 0, F.lit("0\t100000\t0:100000")).when(F.col("side") == 1, F.lit("100000\t0\t100000:0")).otherwise(F.lit("10000\t10000\t10000:10000"))
    _text(nodes, F.concat_ws("\t", F.col("node"), weight, color), path)


def write_layout(placed: DataFrame, lengths: DataFrame, path: str) -> None:
    """placed: contig, read, bgn, end, copies; a block of text for every contig."""
    rows = placed.groupBy("contig").agg(F.array_sort(F.collect_list(F.struct(F.least("bgn", "end").alias("at"), "read", "bgn", "end", "copies"))).alias("r"))
    line = F.transform("r", lambda x: F.concat_ws("\t", x["read"], x["bgn"].cast("string"), x["end"].cast("string"), x["copies"].cast("string")))
    both = rows.join(lengths.select("contig", "length"), "contig")
    _text(both, F.concat_ws("\n", F.concat(F.lit("tig\t"), "contig"), F.concat(F.lit("len\t"), F.col("length").cast("string")), F.concat(F.lit("rds\t"), F.size("r").cast("string")), F.array_join(line, "\n"), F.lit("end")), path)


def scaffold_rows(scaffolds: DataFrame) -> DataFrame:
    """(name, tsv, gaf): scaffolds (name, path) in both notations."""
    return scaffolds.select("name", P.to_tsv(F.col("path")).alias("tsv"), P.spelled(F.col("path")).alias("gaf"))


def path_sequences(paths: DataFrame, sequences: DataFrame) -> DataFrame:
    """(name, seq): paths (name, path) spelled out, gaps as N, nodes end to end."""
    steps = paths.select("name", F.posexplode("path").alias("pos", "step"))
    both = steps.join(sequences.select(F.col("name").alias("_n"), F.col("seq").alias("_s")), P.bare(F.col("step")) == F.col("_n"), "left")
    part = F.when(P.is_gap(F.col("step")), S.n_gap(P.gap_length(F.col("step")))).when(F.col("step").startswith("<"), S.reverse_complement(F.col("_s"))).otherwise(F.col("_s"))
    grouped = both.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("pos", part.alias("part")))).alias("p"))
    return grouped.select("name", F.array_join(F.transform("p", lambda x: x["part"]), "").alias("seq"))


def shifted_references(rows: DataFrame, pieces: DataFrame) -> DataFrame:
    """Alignment rows (ref, at) moved from pieces to scaffolds: pieces: scaffold, ordinal, piece, length (gaps: piece null)."""
    by = Window.partitionBy("scaffold").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    offset = pieces.withColumn("_off", F.coalesce(F.sum("length").over(by), F.lit(0))).where("piece IS NOT NULL").select(F.col("piece").alias("_p"), "scaffold", "_off")
    return rows.join(offset, F.col("ref") == F.col("_p")).withColumn("at", F.col("at") + F.col("_off")).withColumn("ref", F.col("scaffold")).drop("_p", "_off", "scaffold")
