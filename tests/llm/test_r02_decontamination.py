"""Repeated benchmark rows do not swell the block that the driver collects."""

from __future__ import annotations

from basketry.llm import decontamination


def test_copies_of_a_benchmark_row_are_collected_once(spark, monkeypatch):
    seen, build = [], decontamination.build_index
    monkeypatch.setattr(decontamination, "build_index", lambda items, window: seen.append(list(items)) or build(items, window))
    passage = "one two three four five six seven eight nine ten eleven"
    benchmark = spark.createDataFrame([(1, passage)] * 300 + [(1, "other words"), (2, passage)], "item_id long, text string")
    docs = spark.createDataFrame([(7, f"so {passage} it is"), (8, "nothing here")], "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r["items"]) for r in decontamination.contamination(docs, benchmark, block_bytes=4096).collect()}
    assert got == {7: (11, ["1", "2"]), 8: (0, [])}
    assert [len(x) for x in seen] == [3]
