"""What a run leaves on the disk."""

from orderlake.llm import corpus, substring_dedup


def test_tables_read_to_the_end_are_dropped(spark, tmp_path, monkeypatch):
    dropped = []
    monkeypatch.setattr(corpus.Shelf, "drop", lambda shelf, name, drop=corpus.Shelf.drop: (dropped.append(name), drop(shelf, name)))
    passage = " ".join(f"word{n}" for n in range(80))
    rows = [(1, passage), (2, f"first line of other text\n{passage}"), (3, None)]
    spans = substring_dedup.removals(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(s.doc_id, s.kept_in) for s in spans.collect()} == {(2, 1)}
    assert {"marks", "buckets", "classes", "placed-lines", "windows"} <= set(dropped)
