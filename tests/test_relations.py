from __future__ import annotations

import random

import gzip
import lzma

from pyspark.sql import functions as F

from graftline.operators import coverage as C
from graftline.operators import intervals as I
from graftline.operators import layout as L
from graftline.operators import phasing as PH
from graftline.operators import relations as R
from graftline.operators import screen as SC
from graftline.sources import sinks, text


def pairs(df, *cols):
    return sorted(tuple(r[c] for c in (cols or df.columns)) for r in df.collect())


def table(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


# intervals


def test_interval_forms(spark):
    iv = table(spark, "key string, owner string, s long, e long", ("d", "x", 0, 5), ("d", "y", 10, 12), ("n", "x", 0, 10), ("n", "x", 2, 3), ("t", "x", 0, 5), ("t", "y", 5, 9), ("i", "x", 1, 4), ("i", "y", 1, 4))
    assert pairs(I.union_length(iv)) == [("d", 7), ("i", 3), ("n", 10), ("t", 9)]
    assert pairs(I.merged(iv.select("key", "s", "e")), "key", "s", "e") == [("d", 0, 5), ("d", 10, 12), ("i", 1, 4), ("n", 0, 10), ("t", 0, 9)]
    assert pairs(I.ambiguous(iv), "key", "s", "e") == [("i", 1, 4)]
    contigs = table(spark, "key string, length long", ("d", 15), ("n", 10), ("t", 12), ("i", 4))
    assert pairs(I.layout_gaps(iv, contigs), "key", "s", "e") == [("d", 5, 10), ("d", 12, 15), ("i", 0, 1), ("t", 9, 12)]
    assert I.outside(iv.union(table(spark, "key string, owner string, s long, e long", ("n", "x", 5, 11))), contigs).count() == 1


def test_chains_cuts_offsets(spark):
    iv = table(spark, "key string, s long, e long", ("a", 0, 100), ("a", 150, 200), ("a", 9_000_000, 9_000_050))
    assert pairs(I.chained_length(iv)) == [("a", 150)]
    cuts = table(spark, "node string, at long", *[("n", x) for x in (10, 120, 150, 240, 950)])
    assert pairs(I.thinned_cuts(cuts, table(spark, "node string, length long", ("n", 1000)), least=100)) == [("n", 120), ("n", 240)]
    steps = table(spark, "path string, pos int, len long, overlap int", ("p", 0, 10, 0), ("p", 1, 20, 3), ("p", 2, 5, 0))
    assert pairs(I.path_offsets(steps), "pos", "offset") == [(0, 0), (1, 7), (2, 27)]
    assert pairs(I.end_distances(steps), "pos", "before", "after") == [(0, 0, 25), (1, 10, 5), (2, 30, 0)]


def test_scaffold_gaps_merge(spark):
    rows = table(spark, "scaffold string, ordinal int, piece string, gap long", ("s", 0, None, 5), ("s", 1, "a", None), ("s", 2, None, 3), ("s", 3, None, 4), ("s", 4, "b", None), ("s", 5, None, 9))
    assert [tuple(r) for r in I.merged_gaps(rows).orderBy("ordinal").collect()] == [("s", 1, "a", None), ("s", 2, None, 7), ("s", 3, "b", None)]


# relations


def test_filters_on_paths(spark):
    rows = table(spark, "read string, path array<string>", ("r", [">a", "<b"]), ("q", [">c"]))
    names = table(spark, "name string", ("b",))
    assert pairs(R.paths_with(rows, names), "read") == [("r",)] and pairs(R.paths_with(rows, names, invert=True), "read") == [("q",)]
    used = table(spark, "read string", ("q",))
    assert pairs(R.unused_reads(rows, used, table(spark, "name string", ("z",))), "read") == [("r",)]


def test_gap_pairs_take_the_upper_median(spark):
    gaps = table(spark, "a string, b string, gap long", *[("x", "y", g) for g in (5, 9, 12, 20)], ("x", "z", 1))
    assert pairs(R.supported_gaps(gaps, 3)) == [("x", "y", 12, 4)]


def test_greedy_chunks_and_clusters(spark):
    rows = table(spark, "i int, n long", *[(i, 40) for i in range(7)])
    assert [r.chunk for r in R.greedy_chunks(rows, "n", ["i"], 100).orderBy("i").collect()] == [0, 0, 0, 1, 1, 1, 2]
    spread = R.chunked(rows, "n", ["i"], 100)
    assert spread.count() == 7 and spread.agg(F.max("chunk")).first()[0] == 2
    p = table(spark, "key string, pa long, pb long", ("k", 100, 900), ("k", 104, 903), ("k", 109, 899), ("k", 500, 900))
    got = R.position_clusters(p, 10)
    assert sorted({(r.mid_a, r.support) for r in got.collect()}) == [(104, 3), (500, 1)]


def test_choices_and_prefixes(spark):
    rows = table(spark, "read string, contig string, score int", ("r", "a", 5), ("r", "b", 5), ("r", "c", 1))
    assert pairs(R.best_with_ties(rows, "read", "score"), "contig") == [("a",), ("b",)]
    assert R.hashed_choice(rows, "read", ["contig"]).count() == 1
    p = table(spark, "node string, path array<string>", ("n", ["a", "b", "c"]), ("n", ["a", "b"]), ("m", ["a", "b"]), ("m", ["a", "d"]))
    assert pairs(R.prefix_consistent(p)) == [("m", False), ("n", True)]
    s = table(spark, "id string, seq string", ("long", "ACGTACGTACGTACGTTTT"), ("other", "CCCC"))
    assert pairs(R.containing(s, table(spark, "pattern string, pseq string", ("p", "CGTACGTACGTACGTT")))) == [("long", "p")]
    idy = table(spark, "read string, idy double", *[("r", x) for x in (0.9, 0.91, 0.92, 0.5)])
    assert R.near_own_identity(idy).count() == 3


def test_pair_prefilter(spark):
    place = "array<struct<ref: string, pos: bigint, len: bigint>>"
    schema = ", ".join(f"ref{i} string, pos{i} long, len{i} long, mapq{i} int, aligned{i} double, places{i} {place}" for i in (1, 2)) + ", name string"
    mate = lambda ref, pos=5, size=20_000, mapq=60, aligned=0.9, places=(): (ref, pos, size, mapq, aligned, list(places))
    far = 50_000_000
    rows = table(
        spark, schema,
        (*mate("a"), *mate("b"), "unique"), (*mate("a", far, 2 * far), *mate("b", far, 2 * far), "unique in the middle"),
        (*mate("a"), *mate("a"), "one reference"), (*mate(None), *mate("b"), "unmapped"), (*mate("a", aligned=0.4), *mate("b"), "poor"),
        (*mate("a", places=[("b", 1, 9)]), *mate("b"), "on the mate's"), (*mate("a", mapq=0), *mate("b"), "nowhere else"),
        (*mate("a", mapq=0, places=[("c", 1, 20_000)]), *mate("b"), "many places"),
        (*mate("a", mapq=0, places=[("c", 1, 20_000)]), *mate("b", places=[("c", 1, 20_000)]), "places meet"),
        (*mate("a", size=9_000, mapq=0, places=[("c", 1, 8_000)]), *mate("b"), "short"),
        (*mate("a", far, 2 * far, 0, 0.9, [("c", far, 2 * far)]), *mate("b"), "middle"),
        (*mate("a", far, 2 * far, 0, 0.9, [("c", 1, 20_000)]), *mate("b"), "one place not in the middle"),
    )
    assert sorted(r.name for r in R.pair_prefilter(rows).collect()) == ["many places", "one place not in the middle", "unique", "unique in the middle"]


# homology, phasing, scaffolding


def hits(spark):
    schema = "q string, qlen long, qs long, qe long, strand string, r string, rlen long, rs long, re long"
    return table(spark, schema, ("a", 1000, 0, 600, "+", "b", 1000, 0, 600), ("a", 1000, 500, 900, "-", "b", 1000, 500, 900), ("a", 1000, 0, 100, "+", "c", 900, 0, 100), ("c", 900, 0, 800, "+", "d", 900, 0, 800))


def test_homology_graph(spark):
    found = PH.homology_pairs(hits(spark))
    assert pairs(found, "q", "r", "covered", "longest", "orientation") == [("a", "b", 900, 600, "+"), ("a", "c", 100, 100, "+"), ("c", "d", 800, 800, "+")]
    near = table(spark, "node string, near array<string>", ("a", ["s"]), ("b", ["s"]), ("c", ["x"]), ("d", ["y"]))
    edges = PH.match_edges(found, near, 200)
    assert pairs(edges, "a", "b", "weight") == [("a", "b", -10), ("c", "d", -10)]
    lengths = table(spark, "node string, length long", ("a", 1000), ("b", 1000), ("c", 900), ("d", 900), ("e", 5000))
    steps = table(spark, "path string, node string", ("P", "a"), ("Q", "b"), ("S", "e"))
    size = table(spark, "path string, length long", ("P", 1000), ("Q", 1000), ("S", 5000))
    assert pairs(PH.homologous_paths(steps, edges, size)) == [("P", "Q"), ("Q", "P")]
    assert pairs(PH.haploid_paths(steps, lengths, edges)) == [("S",)]
    member = table(spark, "node string, component string", ("a", "1"), ("b", "1"), ("e", "2"))
    assert pairs(PH.diploid_components(member, lengths, edges)) == [("1", True), ("2", False)]
    assert PH.phase_clusters(edges).count() == 4


def test_phasing_separates_homologous_nodes(spark):
    n = table(spark, "component string, node string", *[("1", x) for x in ("a1", "a2", "b1", "b2", "c1", "c2")])
    rows = [("a1", "b1", 30.0), ("b1", "c1", 30.0), ("a2", "b2", 30.0), ("b2", "c2", 30.0), ("a1", "c2", 5.0)] + [(f"{x}1", f"{x}2", -100.0) for x in "abc"]
    got = dict(pairs(PH.phased(n, table(spark, "a string, b string, w double", *rows), seeds=8), "node", "side"))
    assert got["a1"] == got["b1"] == got["c1"] == 0 and got["a2"] == got["b2"] == got["c2"] == 1
    short = table(spark, "node string", ("s",), ("t",))
    contacts = table(spark, "a string, b string, w long", ("s", "a1", 30), ("s", "a2", 5), ("t", "a1", 5), ("t", "a2", 5))
    sides = table(spark, "node string, side int", *got.items())
    assert pairs(PH.assigned_short(contacts, sides, short)) == [("s", 0), ("t", 2)]


def test_phasing_graph(spark):
    nodes = table(spark, "node string, length long, coverage double", ("a", 900_000, 20.0), ("b", 900_000, 20.0), ("c", 900_000, 90.0), ("s", 1000, 20.0))
    member = table(spark, "node string, component string", *[(x, "1") for x in "abcs"])
    contacts = table(spark, "a string, b string, w long", ("a", "b", 50), ("a", "c", 50), ("a", "s", 50))
    edges = table(spark, "a string, b string, covered long, weight int", ("x", "y", 5, -10))
    kept, links = PH.phasing_graph(nodes, contacts, edges, member)
    assert pairs(kept, "node") == [("a",), ("b",)] and pairs(links) == [("b", "a", 50.0)] or pairs(links, "a", "b") == [("a", "b")]


def test_scaffolds_grow_from_mutual_extensions(spark):
    steps = table(spark, "path string, node string, forward boolean, before long, after long, length long", *[(p, f"n{p}", True, 0, 0, 1000) for p in "ABC"])
    contacts = table(spark, "a string, b string, ca long, cb long, w long", ("nA", "nB", 990, 10, 40), ("nB", "nC", 990, 10, 40), ("nA", "nC", 990, 10, 12))
    none = table(spark, "a string, b string", ("q", "r"))
    scores = PH.pair_scores(contacts, steps, none, 600)
    assert pairs(scores, "p", "q", "orientation", "w") == [("A", "B", "++", 40), ("A", "C", "++", 12), ("B", "C", "++", 40)]
    ext = PH.mutual_extensions(PH.symmetric_scores(scores), table(spark, "end string", ("Z+",)))
    assert {(r.x, r.y) for r in ext.collect()} == {("A+", "B+"), ("B+", "C+"), ("B-", "A-"), ("C-", "B-")}
    lengths = table(spark, "path string, length long", ("A", 1000), ("B", 3000), ("C", 2000), ("D", 10))
    got = PH.grown_scaffolds(ext, lengths).orderBy("scaffold", "ordinal").collect()
    assert [r.path for r in got if r.scaffold == "B"] in (["A+", "B+", "C+"], ["C-", "B-", "A-"]) and len(got) == 4
    tel = table(spark, "path string, at_left boolean, at_right boolean", ("A", True, False))
    fixed = PH.fixed_by_telomeres(table(spark, "p string, q string, orientation string, w long", ("A", "B", "-+", 5), ("A", "B", "++", 2)), tel, lengths)
    assert pairs(fixed) == [("A", "B", "++", 7)]


def test_reference_places(spark):
    h = table(spark, "path string, plen long, ps long, pe long, ref string, rs long, re long", ("A", 100, 0, 90, "r", 10, 100), ("A", 100, 0, 30, "q", 0, 30), ("B", 100, 0, 50, "r", 0, 50))
    assert pairs(PH.reference_places(h)) == [("A", "r", 10, 100)]


# layout, screening


def test_layout_places_reads_on_both_strands(spark):
    nodes = table(spark, "node string, length long", ("a", 100), ("b", 50))
    contigs = table(spark, "contig string, path array<string>", ("c", [">a", "[N10N:x]", "<b"]))
    aln = table(spark, "read string, rlen long, rstart long, path array<string>, plen long, pstart long, pend long", ("r", 60, 0, [">a"], 100, 20, 80), ("s", 40, 0, [">b"], 50, 5, 45))
    got = pairs(L.layout(aln, contigs, nodes))
    assert got == [("c", "r", 20, 80, 1), ("c", "s", 155, 115, 1)]
    trimmed = L.trimmed_layout(L.layout(aln, contigs, nodes), table(spark, "contig string, x int", ("c", 1)))
    assert pairs(trimmed, "read", "bgn", "end", "trim", "length") == [("r", 0, 60, 20, 135), ("s", 135, 95, 20, 135)]
    packed = L.packages(L.layout(aln, contigs, nodes), table(spark, "name string, seq string", ("r", "AC"), ("s", "AC")))
    assert pairs(packed, "read", "seq") == [("r", "AC"), ("s", "GT")]
    one = table(spark, "tig string, read string", ("t", "r"))
    assert L.merged_layouts(one, 0, one.union(table(spark, "tig string, read string", ("u", "q"))), 1).count() == 2


def test_screening(spark):
    contigs = table(spark, "node string, length long", ("x", 1000), ("y", 900), ("z", 50), ("w", 500_000))
    links = table(spark, "a string, b string", ("x", "y"), ("y", "w"))
    schema = "contig string, contig_length long, cs long, ce long, contaminant string, contaminant_length long, idy double"
    found = table(spark, schema, ("x", 1000, 0, 700, "ebv", 800, 99.0), ("w", 500_000, 0, 900, "ebv", 800, 99.0))
    assert pairs(SC.contaminant_hits(found), "contig", "covered") == [("x", 700)]
    assert pairs(SC.exemplars(SC.contaminant_hits(found)), "contaminant", "contig") == [("ebv", "x")]
    assert dict(pairs(SC.screened(contigs, links, found), "node", "reason")) == {"x": "contaminant", "y": "contaminant", "z": "disconnected", "w": None}
    ring = "ACGGTCATTTGACCA" * 8
    assert SC.end_overlap("G" * 300 + ring + "T" * 300, 50, 20000) == 0 and SC.end_overlap(ring + "T" * 300 + ring, 50, 20000) == len(ring)
    seqs = table(spark, "node string, seq string", ("r", ring + "T" * 300 + ring))
    assert SC.circularised(seqs).first().overlap == len(ring)
    tel = table(spark, "name string, seq string", ("t", "AA" + "CCCTAA" * 5 + "G" + "TTAGGG" * 4), ("u", "ACGT"))
    assert pairs(SC.telomere_runs(tel)) == [("t", 2, 32), ("t", 33, 57)]
    parts = table(spark, "scaffold string, ordinal int, seq string, gap long", ("s", 1, "AC", None), ("s", 2, None, 3), ("s", 3, "GT", None))
    assert pairs(SC.combined(parts)) == [("s", "ACNNNGT")]


def test_coverage_statistics(spark):
    cov = table(spark, "node string, coverage double, length long, brand string", ("a", 10.0, 100, "x"), ("b", 20.0, 300, "x"), ("c", 90.0, 100, "x"))
    assert C.mean_coverage(cov).first().mean == (1000 + 6000 + 9000) / 500
    assert pairs(C.weighted_median(cov, "brand")) == [("x", 20.0)]
    assert C.mean_coverage(cov, 10**9).first().mean == 0.0
    latest = C.latest_coverage(table(spark, "node string, coverage double, length long, round int", ("a", 1.0, 5, 0), ("a", 2.0, 5, 1)))
    assert pairs(latest) == [("a", 2.0, 5)]
    assert pairs(C.with_coverage_tag(table(spark, "node string", ("a",), ("z",)), cov), "node", "tag")[0] == ("a", "ll:f:10.0")


# sources and sinks


def put(tmp_path, name, content):
    p = tmp_path / name
    p.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(p)


def test_graph_files(spark, tmp_path):
    gfa = put(tmp_path, "g.gfa", "H\tx\nS\ta\tACGT\tLN:i:4\tll:f:2.5\nS\tb\t*\tLN:i:9\nL\ta\t+\tb\t-\t3M\n")
    assert pairs(text.gfa_segments(spark, gfa), "node", "length", "coverage") == [("a", 4, 2.5), ("b", 9, None)]
    assert pairs(text.gfa_links(spark, gfa)) == [("a", True, "b", False, 3)]
    assert pairs(text.undirected(spark, gfa)[1]) == [("a", "b", 13)] and pairs(text.undirected(spark, gfa, True)[1]) == [("a", "b", 10)]
    assert pairs(text.directed(spark, gfa)[1], "u", "v") == [("a+", "b-"), ("b+", "a-")]
    aln = put(tmp_path, "a.gaf", "r1 x\t100\t0\t90\t+\t>a<b\t13\t1\t12\t88\t90\t60\tid:f:0.99\nr2\t10\t0\t9\t+\t>a\t4\t0\t4\t4\t4\t3\n")
    got = text.gaf(spark, aln).orderBy("read").collect()
    assert (got[0].read, got[0].path, got[0].idy, got[1].mapq, got[1].idy) == ("r1", [">a", "<b"], 0.99, 3, None)
    cov = put(tmp_path, "c.csv", "node\tcoverage\tlength\na\t1.5\t4\nnode\tcoverage\tlength\nb\t2\t9\n")
    assert pairs(text.coverage(spark, cov)) == [("a", 1.5, 4), ("b", 2.0, 9)]
    m = put(tmp_path, "m.txt", "u\t>a<b:1:2\n")
    mapping = text.node_map(spark, m)
    assert pairs(mapping, "name", "left_clip", "right_clip") == [("u", 1, 2)]
    sizes = table(spark, "node string, length long", ("a", 4), ("b", 9), ("u", 10))
    assert text.checked_node_map(mapping, sizes).count() == 1
    p = put(tmp_path, "p.tsv", "name\tpath\tassignment\nx\ta+,[N3N:t],b-\tMAT\ny\t>a[N9N]<b\n")
    assert pairs(text.paths(spark, p), "name", "assignment") == [("x", "MAT"), ("y", "NA")]
    assert text.paths(spark, p, 1.5).where("name = 'x'").first().path == [">a", "[N4N]", "<b"]


def test_sequence_files(spark, tmp_path):
    fa = ">a one\nacg\nT\n>b\nGG\n"
    assert pairs(text.fasta(spark, put(tmp_path, "s.fa", fa)), "name", "seq") == [("a", "ACGT"), ("b", "GG")]
    assert pairs(text.fasta(spark, put(tmp_path, "s.fa.gz", gzip.compress(fa.encode()))), "name", "seq") == [("a", "ACGT"), ("b", "GG")]
    fq = b"@r1 x\nacgt\n+\nIIII\n@r2\nGG\n+\nII\n"
    assert pairs(text.fastq(spark, put(tmp_path, "r.fq.xz", lzma.compress(fq)))) == [("r1", "ACGT", "IIII"), ("r2", "GG", "II")]
    assert pairs(text.names(spark, put(tmp_path, "n.txt.xz", lzma.compress(b"a b\n\nc\n")))) == [("a",), ("c",)]
    assert pairs(text.name_map(spark, put(tmp_path, "m.txt", "a x\nb\n"))) == [("a", "x"), ("b", "b")]


def test_block_files_and_contacts(spark, tmp_path):
    scf = put(tmp_path, "s.map", "path out1 p1\na\n[N5N:gap]\nb\nend\npath out2 p2\nc\nend\n")
    assert pairs(text.scaffold_map(spark, scf), "outname", "ordinal", "piece", "gap")[:1] == [("out1", 1, "a", None)] and text.scaffold_map(spark, scf).count() == 4
    lay = put(tmp_path, "l.txt", "tig\tt1\nlen\t100\ntrm\t0\nrds\t1\nr1\t0\t50\t2\nend\ntig\tt2\nlen\t9\nrds\t1\nr2\t3\t1\nend\n")
    assert pairs(text.layouts(spark, lay), "tig", "len", "read", "copies") == [("t1", 100, "r1", 2), ("t2", 9, "r2", 1)]
    con = put(tmp_path, "c.txt", "r\tb\ta\t2\t5\t6\nq\ta\tb,c\nz\ta\ta\n")
    assert pairs(text.contacts(spark, con), "a", "b", "w", "ca", "cb") == [("a", "b", 2, 6, 5)]
    assert text.contacts(spark, con, True).count() == 3
    sam = put(tmp_path, "x.sam", "@HD\nr\t0\ta\t5\t60\nr\t0\tb\t9\t0\n")
    assert text.sam_pairs(spark, sam).count() == 1
    rows = table(spark, "read string, node string, at long, alternatives array<struct<node:string,at:bigint>>", ("r", "a", 1, [("c", 7)]), ("r", "b", 2, None), ("s", "a", 1, None))
    assert pairs(text.paired_contacts(rows), "a", "b", "w") == [("a", "b", 0.5), ("b", "c", 0.5)]
    tel = table(spark, "node string, start long, end long", ("a", 5, 50), ("b", 99_000, 99_900))
    assert pairs(text.telomeric_ends(tel, table(spark, "node string, length long", ("a", 100_000), ("b", 100_000)))) == [("<a",), (">b",)]
    hom = put(tmp_path, "h.paf", "utg1 100 0 90 + utg2 100 0 90 9 90 60 id:f:0.98\nutg1 100 0 90 + utg1 100 0 90 9 90 60\n")
    assert pairs(text.homology(spark, hom, 50), "q", "r", "idy") == [("utg1", "utg2", 0.98)]


def test_sinks(spark, tmp_path):
    nodes = table(spark, "node string, seq string, length long", ("b", "GG", 2), ("a", "AC", 2))
    arcs = table(spark, "u string, v string, overlap int", (">a", ">b", 1), ("<b", "<a", 1))
    sinks.write_gfa(nodes, arcs, str(tmp_path / "g"))
    assert [r.value for r in spark.read.text(str(tmp_path / "g")).collect()] == ["S\ta\tAC\tLN:i:2", "S\tb\tGG\tLN:i:2", "L\tb\t-\ta\t-\t1M"]
    seqs = table(spark, "name string, seq string", ("a", "ACC"), ("b", "GGT"))
    p = table(spark, "name string, path array<string>", ("p", [">a", "[N2N]", "<b"]))
    assert pairs(sinks.path_sequences(p, seqs)) == [("p", "ACCNNACC")]
    sinks.write_fasta(seqs, str(tmp_path / "f"), "gzip")
    assert pairs(text.fasta(spark, str(tmp_path / "f")), "name", "seq") == [("a", "ACC"), ("b", "GGT")]
    sinks.write_layout(table(spark, "contig string, read string, bgn long, end long, copies int", ("c", "r", 5, 1, 1)), table(spark, "contig string, length long", ("c", 9)), str(tmp_path / "l"))
    assert pairs(text.layouts(spark, str(tmp_path / "l")), "tig", "read", "bgn", "end") == [("c", "r", 5, 1)]
    moved = sinks.shifted_references(table(spark, "ref string, at long", ("x", 3)), table(spark, "scaffold string, ordinal int, piece string, length long", ("s", 0, "w", 10), ("s", 1, None, 5), ("s", 2, "x", 9)))
    assert pairs(moved, "ref", "at") == [("s", 18)]


def test_bisection_finds_the_best_of_all_bipartitions(spark):
    rng = random.Random(12)
    rows, nodes_, want = [], [], {}
    for c in range(8):
        names = [f"c{c}n{i}" for i in range(rng.randint(2, 9))]
        weight = {(a, b): float(rng.randint(-9, 9)) for i, a in enumerate(names) for b in names[i + 1 :] if rng.random() < 0.6}
        nodes_ += [(f"c{c}", n) for n in names]
        rows += [(a, b, w) for (a, b), w in weight.items()]
        inside = lambda bits, names=names, weight=weight: sum(w for (a, b), w in weight.items() if bits >> names.index(a) & 1 == bits >> names.index(b) & 1)
        want[f"c{c}"] = max(inside(bits) for bits in range(1 << len(names)))
    found = PH.phased(spark.createDataFrame(nodes_, "component string, node string"), spark.createDataFrame(rows, "a string, b string, w double"), seeds=20).collect()
    side = {r.node: r.side for r in found}
    got = {c: sum(w for a, b, w in rows if a.startswith(f"{c}n") and side[a] == side[b]) for c in want}
    assert got == want and set(side) == {n for _, n in nodes_}
