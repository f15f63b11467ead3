"""What the toxicity fit counts, and what it writes aside for that."""

import random

import numpy as np

from orderlake.llm import corpus, toxicity


def rows(n):
    draw = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz    "
    return [(i, "".join(draw.choice(letters) for _ in range(600 + i)) + (" moronic trash" if i % 3 == 1 else ""), int(i % 3 == 1))
            for i in range(n)]


def test_each_document_counts_once_per_bucket(spark):
    odd = [(900, "", 0), (901, "aaaaaaaaaaaaaaaaaaaa", 1), (902, "Ünï \U0001f600 Ünï \U0001f600 Ünï", 0), (903, "of no class", 2)]
    sample = [*rows(20), *odd]
    expected = np.zeros((2, 1 << toxicity.BITS), np.int64)
    for _, text, label in sample:
        if label in (0, 1):
            expected[label][np.unique(toxicity.buckets(text))] += 1
    frame = spark.createDataFrame(sample, "doc_id bigint, text string, label int")
    assert (toxicity.class_counts(frame) == expected).all()


def test_no_list_of_all_buckets_is_written_aside_or_sent(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(corpus.Shelf, "keep", lambda shelf, frame, name, keep=corpus.Shelf.keep: kept.setdefault(
        name, keep(shelf, frame, name)))
    documents = spark.createDataFrame(rows(60), "doc_id bigint, text string, toxic int")
    model = toxicity.fit(documents.select("doc_id", "text"), documents.select("doc_id", "toxic"))
    assert len(model.chosen)
    places = 1 + max(p for r in kept["places"].collect() for p in r.places)
    assert places <= len(model.chosen)
    lists = [name for name, frame in kept.items() if any(kind.startswith("array") for _, kind in frame.dtypes)]
    assert lists == ["places"]
