from __future__ import annotations

from pyspark.sql import functions as F

from graftline.functions import paths as P
from graftline.functions import sequences as S


def value(spark, column, **columns):
    row = spark.range(1)
    for name, x in columns.items():
        row = row.withColumn(name, F.array(*map(F.lit, x)) if isinstance(x, list) else F.lit(x))
    return row.select(column.alias("x")).first().x


def cases():
    return [
        (S.reverse_complement(F.col("s")), {"s": "ACGTNacg"}, "gcaNACGT"),
        (S.homopolymer_compressed(F.col("s")), {"s": "AAACCGTTT"}, "ACGT"),
        (S.homopolymer_compressed(F.col("s")), {"s": ""}, ""),
        (S.kmers(F.col("s"), 3), {"s": "ACGTNAC"}, ["ACG", "CGT"]),
        (S.kmers(F.col("s"), 3), {"s": "NN"}, []),
        (S.canonical_kmer(F.col("s")), {"s": "TTG"}, "CAA"),
        (S.both_strands(F.col("s"), 2), {"s": "ACC"}, ["AC", "CC", "GG", "GT"]),
        (S.packed_kmer(F.col("s")), {"s": "ACGT"}, 27),
        (S.cut(F.col("s"), 1, 3), {"s": "ACGT"}, "CG"),
        (S.trimmed(F.col("s"), 2), {"s": "ACGTA"}, "GTA"),
        (S.scaled_gap(F.col("n")), {"n": 5}, 8),
        (S.scaled_gap(F.col("n")), {"n": 3}, 4),
        (S.scaled_gap(F.col("n")), {"n": 10**6}, 100000),
        (S.scaffold_gap(F.col("n")), {"n": 10.0}, 5000),
        (S.identity(F.col("s")), {"s": "id:f:0.98"}, 0.98),
        (S.base_name(F.col("s")), {"s": "node_3_2"}, "node_3"),
        (S.base_name(F.col("s")), {"s": "node_cut1"}, "node_cut1"),
        (S.truth(F.col("s")), {"s": "Yes"}, True),
        (S.segment_length(F.col("s"), F.col("t")), {"s": "*", "t": ["LN:i:7", "ll:f:2.5"]}, 7),
        (S.coverage_tag(F.col("t")), {"t": ["LN:i:7", "ll:f:2.5"]}, 2.5),
        (S.marker_color(F.col("a"), F.col("b")), {"a": 90, "b": 15}, "#FFFF00"),
        (S.marker_color(F.col("a"), F.col("b")), {"a": 950, "b": 10}, "#8888FF"),
        (P.flipped(F.col("s")), {"s": ">ab"}, "<ab"),
        (P.reversed_path(F.col("p")), {"p": [">a", "<b"]}, [">b", "<a"]),
        (P.canonical_edge(F.col("a"), F.col("b")), {"a": ">b", "b": ">a"}, ["<a", "<b"]),
        (P.canonical_ends(F.col("a"), F.col("b")), {"a": ">b", "b": "<a"}, ["<a", ">b"]),
        (P.canonical_path(F.col("p")), {"p": [">a", ">b", ">c"]}, ["<c", "<b", "<a"]),
        (P.tokens(F.col("s")), {"s": ">a<b[N100N:why]>c"}, [">a", "<b", "[N100N:why]", ">c"]),
        (P.from_tsv(F.col("s")), {"s": "a+,[N5N:x],b-"}, [">a", "[N5N:x]", "<b"]),
        (P.to_tsv(F.col("p")), {"p": [">a", "[N5N:x]", "<b"]}, "a+,[N5N:x],b-"),
        (P.flipped_sign(F.col("s")), {"s": "a-1+"}, "a-1-"),
        (P.steps(F.col("p"), 2), {"p": [">a", ">b", ">c"]}, [[">a", ">b"], [">b", ">c"]]),
        (P.steps(F.col("p"), 2), {"p": [">a"]}, []),
        (P.gap_length(F.col("s")), {"s": "[N123N:x]"}, 123),
    ]


def test_expressions(spark):
    for i, (column, given, want) in enumerate(cases()):
        assert value(spark, column, **given) == want, (i, given)
