from __future__ import annotations

import json

from graftline.streaming import walks


def test_edge_counts_over_a_stream(spark, tmp_path):
    rows = [("r1", ">a>b>c", "2024-01-01T00:10:00"), ("r2", "<b<a", "2024-01-01T00:20:00"), ("r3", ">a>b", "2024-01-01T01:10:00")]
    for i, (read, path, at) in enumerate(rows):
        (tmp_path / f"{i}.json").write_text(json.dumps({"read": read, "path": path, "at": at}) + "\n")
    stream = walks.walk_stream(spark, str(tmp_path), 1)
    for name, df, mode, want in (
        ("total", walks.edge_counts(stream), "complete", {("<b", "<a", 3), ("<c", "<b", 1)}),
        ("hourly", walks.windowed_edge_counts(stream).selectExpr("hour(window.start) AS h", "a", "b", "n"), "update", {(0, "<b", "<a", 2), (0, "<c", "<b", 1), (1, "<b", "<a", 1)}),
    ):
        query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
        query.awaitTermination(120)
        got = {tuple(r) for r in spark.table(name).collect()}
        assert want <= got
