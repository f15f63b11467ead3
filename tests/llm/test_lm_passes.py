"""How often the language model turns a text into subword ids."""

from orderlake.llm import lm_scoring


def test_texts_are_written_in_subword_ids_once(spark, monkeypatch):
    rows = [(i, f"some words of text {i % 7} and more of them") for i in range(60)] + [(60, None), (61, "")]
    frame_type = type(spark.range(1))
    inputs, mapped = [], frame_type.mapInArrow
    monkeypatch.setattr(frame_type, "mapInArrow", lambda frame, *a, **k: inputs.append(frame.columns) or mapped(frame, *a, **k))
    assert lm_scoring.scores(spark.createDataFrame(rows, "doc_id bigint, text string")).count() == len(rows)
    # one pass over the texts counts their words, one finds ids and base scores; all others read ids or counts
    assert sum("text" in columns for columns in inputs) == 2
