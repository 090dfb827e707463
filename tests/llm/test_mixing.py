from __future__ import annotations

from graftline.llm import mixing


def test_targets_stop_at_twice_the_size(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 500), ("d", 0)], "source string, source_size long")
    got = {r.source: r for r in mixing.source_targets(sizes).collect()}
    assert got["a"].target == 20 and got["d"].target == 0 and got[None].weight == 2
    assert abs(sum(r.target for r in got.values()) - 1.5 * 2510) < 1e-6
    assert all(r.target <= 2 * r.source_size + 1e-9 for r in got.values())
    free = [r for r in got.values() if 0 < r.target < 2 * r.source_size - 1e-9]
    assert max(r.target / r.weight for r in free) - min(r.target / r.weight for r in free) < 1e-6


def test_takes_what_the_targets_say(spark):
    rows = [(i, "w " * (i % 7 * 3), ["x", "y", None][i % 3] if i % 5 else "x") for i in range(400)] + [(7, None, "x"), (None, "a b", "y"), (9, "p q", "x"), (9, "p q", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    for s in ("x", "y", None):
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) < 1
        assert sum(r.size for r in own) == own[0].source_size


def test_schedule_visits_every_cell_once_and_spreads_sources(spark):
    t = spark.createDataFrame([("a", 1, 5, 600, 900.0), ("b", 2, 2, 300, 300.0)], "source string, sid int, weight long, source_size long, target double")
    got = sorted(mixing.schedule(t, 120).collect(), key=lambda r: r.slot)
    assert len(got) == 120 and len({r.slot for r in got}) == 120
    seen = [r.sid for r in got]
    for n in range(8, 120):
        assert abs(seen[:n].count(2) - n / 4) <= 3
    assert sorted(r.block for r in got if r.sid == 1) == list(range(90))


def test_empty_and_wordless_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(docs).count() == 0
    got = mixing.mix(spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


def test_the_mix_comes_out_in_the_order_of_the_schedule(spark, tmp_path):
    """Every stretch of the mix has the sources near their targets; without the schedule's order it would not."""
    rows = [(i, "w " * 20, "a" if i < 600 else "b" if i < 1400 else "c", *range(8)) for i in range(2000)]
    names = ["key", "of", "total", "rows", "slots", "turn", "copy", "slot"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names))
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    out.write.parquet(str(tmp_path / "mix"))
    parts = sorted((tmp_path / "mix").glob("part-*"))
    seen = [s for p in parts for s in spark.read.parquet(str(p)).toPandas()["source"]]
    share = {r.source: r.target for r in mixing.mix(docs).select("source", "target").distinct().collect()}
    total = sum(share.values())
    assert abs(len(seen) - total / 20) < 4
    for n in range(200, len(seen), 100):
        for s, target in share.items():
            assert abs(seen[:n].count(s) / n - target / total) < 0.06
    first = {r.id: r.slots[0] for r in mixing.mix(docs).collect() if r.slots}
    assert all(0 <= x < 1 for x in first.values()) and len(set(first.values())) > 1000


def test_repeated_identifiers_share_what_they_take(spark):
    rows = [(i // 4, f"{'w ' * (i % 5)}", "x" if i < 300 else "y") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    times = sum(1 if r.size == 0 else int(r.taken / r.size + 0.5) for r in mixing.mix(docs).collect())
    got = mixing.mixed(docs)
    assert got.count() == times and got.columns == docs.columns
