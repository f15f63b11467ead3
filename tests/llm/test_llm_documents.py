"""Corpus operators on documents against brute force, and on odd inputs."""

import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from orderlake.llm import (corpus, lm_scoring, minmax_dedup, packing, piece_viterbi, quality, substring_dedup, toxicity)
from orderlake.llm.components import components
from orderlake.llm.corpus import Shelf, shingles, word_hashes, words
from orderlake.llm.linking import bands_for

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, texts, schema=SCHEMA):
    """Documents from {id: text} or a list of pairs."""
    pairs = texts.items() if isinstance(texts, dict) else texts
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in pairs], schema)


def prose(seed, n, vocabulary=4000):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" + ("." if draw.random() < 0.1 else "") for _ in range(n))


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One"), (None, prose(1, 60)), (7, prose(2, 80)),
       (7, prose(2, 80)), (8, "x" * 200_000), (9, prose(3, 30_000)), (10, "é 日本 \x1c\x85 \U0001f600 <|endoftext|>"),
       (11, prose(2, 80))]


def odd(spark):
    """The odd rows with extra columns whose names clash with those the operators make."""
    rows = frame(spark, ODD)
    for name in ("score", "_score", "kept", "component_id", "bucket", "_id", "_left", "part"):
        rows = rows.selectExpr("*", f"'extra' AS {name}")
    return rows


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


# --- components -------------------------------------------------------------------

def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(500, 500 + i) for i in range(1, 30)] + [(7, 7), (9, 8), (8, 9),
                                                                                        (None, 3), (140, 90), (90, 95)]
    found = {r.node: r.component for r in components(
        spark.createDataFrame(links, "a bigint, b bigint"), Shelf(spark, "t")).collect()}
    assert found == ({i: 90 for i in range(100, 141)} | {90: 90, 95: 90} | {500 + i: 500 for i in range(30)}
                     | {8: 8, 9: 8})


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint"), Shelf(spark, "t")).count() == 0


# --- min-max hashing --------------------------------------------------------------

def expected_classes(texts, size, percent):
    sets = {}
    for i, t in texts.items():
        tokens = [w.decode() for w in words(t)]
        n = min(size, len(tokens))
        sets[i] = {tuple(tokens[k:k + n]) for k in range(len(tokens) - n + 1)} if tokens else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def edited(text, seed, share):
    draw = random.Random(seed)
    return " ".join(f"e{seed}_{draw.randrange(9999)}" if draw.random() < share else w for w in text.split())


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_duplicates_are_those_of_brute_force(spark, size, percent):
    texts, base = {}, [prose(s, 120) for s in range(6)]
    for k in range(240):
        texts[k * 3] = edited(base[k % 6], k, (0.0, 0.005, 0.01, 0.02, 0.03, 0.1)[k // 6 % 6])
    texts |= {1001: "a b", 1002: "A  b", 1003: None, 1004: "", 1005: "a b c d e f g"}
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in
             minmax_dedup.near_duplicates(frame(spark, texts), size, percent).collect()}
    assert found == expected_classes(texts, size, percent)


def test_texts_under_one_id_are_all_linked(spark):
    base = [prose(s, 120) for s in range(40, 52)]
    rows = [(200 + k, edited(base[k % 12], k, 0.01)) for k in range(48)]
    # ids 1 to 6 have texts of two or three groups, 7 one text and an empty one, 8 two texts like no other
    rows += [(1 + k, edited(base[(2 * k + j) % 12], 900 + 10 * k + j, 0.005)) for k in range(6) for j in range(2 + (k == 5))]
    rows += [(7, base[3]), (7, ""), (8, prose(70, 50)), (8, prose(71, 50))]
    found = minmax_dedup.near_duplicates(frame(spark, rows), 3, 85).collect()
    texts = dict(enumerate(t for _, t in rows))
    tree = {n: c for n, (_, c) in expected_classes(texts, 3, 85).items()}
    moved = True
    while moved:  # components of rows meet in ids
        moved = False
        for (m, (x, s)), (n, (y, t)) in itertools.combinations(enumerate(rows), 2):
            if x == y and s and t and tree[m] != tree[n]:
                low, high = sorted((tree[m], tree[n]))
                tree, moved = {k: low if c == high else c for k, c in tree.items()}, True
    lowest = {c: min(rows[n][0] for n in tree if tree[n] == c) for c in tree.values()}
    assert sorted((r.doc_id, r.component_id) for r in found) == sorted((i, lowest[tree[n]]) for n, (i, _) in enumerate(rows))
    assert len({lowest[tree[n]] for n in range(48)}) < len({n % 12 for n in range(48)})
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_duplicates_of_odd_rows(spark):
    rows = minmax_dedup.near_duplicates(odd(spark)).collect()
    assert len(rows) == len(ODD)
    assert {(r.doc_id, r.component_id, r.kept) for r in rows if r.doc_id in (4, 5, 7, 11)} == {
        (4, 4, True), (5, 4, False), (7, 7, True), (11, 7, False)}
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)]
    assert all(r.n_shingles == 0 and r.component_id == r.doc_id for r in rows if r.doc_id in (1, 2, 3))
    assert minmax_dedup.near_duplicates(odd(spark).limit(0)).count() == 0


def test_minimum_and_maximum_of_a_function_lie_in_different_bands():
    draw = np.random.default_rng(5)
    for bands in (20, 31):
        hashes = minmax_dedup.MinMaxBands(bands)
        items = draw.integers(1 << 62, size=30, dtype=np.uint64)
        whole, factor = hashes.of(items), hashes.factors[7].copy()
        hashes.factors[7] = factor + np.uint64(2)
        assert (hashes.of(items) != whole).sum() == 2


def test_bands_keep_the_stated_miss():
    for threshold, rows, miss in ((0.8, 4, 0.01), (0.85, 6, 1e-4)):
        bands = bands_for(threshold, rows, miss)
        assert (1 - threshold ** rows) ** bands <= miss < (1 - threshold ** rows) ** (bands - 1)


# --- substring dedup --------------------------------------------------------------

def test_repeated_passages_are_cut_wherever_they_stand(spark):
    passage, line = prose(90, 60), prose(91, 40)
    texts = {i: prose(i, 150) for i in range(12)}
    texts[3] = prose(100, 33) + " " + passage + " " + prose(101, 70)
    texts[5] = prose(102, 8) + "\n" + prose(103, 41) + " " + passage + " " + prose(104, 9)
    texts[6] = prose(105, 30) + "\n" + line + "\n" + prose(106, 30)
    texts[9] = line + "\n" + prose(107, 50)
    documents = frame(spark, texts)
    found = substring_dedup.removals(documents)
    assert {r.doc_id: r.kept_in for r in found.collect()} == {5: 3, 9: 6}
    left = {r.doc_id: r for r in substring_dedup.cut(documents, found).collect()}
    assert set(left) == set(texts)
    assert all(left[i].text == texts[i] for i in texts if i not in (5, 9))
    assert passage not in left[5].text and left[5].n_chars == len(left[5].text)
    assert left[9].text.split() == texts[9].split()[40:]
    words_of = [w.split() for w in (left[3].text, left[5].text)]
    runs = [{tuple(w[k:k + 50]) for k in range(len(w) - 49)} for w in words_of]
    assert not runs[0] & runs[1]


def test_edited_paragraphs_are_found_and_short_lines_left(spark):
    line = prose(7, 80).split()
    other = line[:40] + ["changed"] + line[41:]
    texts = {1: " ".join(line), 2: "Short line that all have.\n" + " ".join(other), 3: "Short line that all have.\n" + prose(8, 60)}
    assert {(r.doc_id, r.kept_in) for r in substring_dedup.removals(frame(spark, texts)).collect()} == {(2, 1)}


def test_substring_dedup_of_odd_rows(spark):
    rows = odd(spark)
    found = substring_dedup.removals(rows)
    assert {r.doc_id for r in found.collect()} == {11}
    left = substring_dedup.cut(rows, found)
    assert left.columns == rows.columns and left.count() == len(ODD) - 1
    assert substring_dedup.removals(rows.limit(0)).count() == 0


def test_every_copy_of_a_passage_leaves_a_document_that_does_not_keep_it(spark):
    passage = prose(300, 60)
    texts = {1: f"{prose(301, 40)} {passage} {prose(302, 40)}",
             2: f"{prose(303, 70)} {passage} {prose(304, 80)} {passage} {prose(305, 50)}\n{prose(306, 30)} {passage} {prose(307, 9)}"}
    documents = frame(spark, texts)
    found = substring_dedup.removals(documents)
    assert {(r.doc_id, r.kept_in) for r in found.collect()} == {(2, 1)} and found.count() == 3
    twice = frame(spark, {1: texts[2], 2: texts[1]})
    assert {(r.doc_id, r.kept_in) for r in substring_dedup.removals(twice).collect()} == {(2, 1)}



def test_a_passage_is_not_kept_in_a_paragraph_that_is_removed(spark):
    words_of, passage = prose(310, 300).split(), prose(311, 54)
    edited_copy = " ".join([*words_of[:150], passage, *words_of[150:]])
    texts = {1: " ".join(words_of), 2: edited_copy + "\n" + prose(312, 30), 3: f"{prose(313, 60)} {passage} {prose(314, 60)}",
             4: f"{prose(315, 60)} {passage} {prose(316, 60)}"}
    documents = frame(spark, texts)
    found = substring_dedup.removals(documents)
    assert {(r.doc_id, r.kept_in) for r in found.collect()} == {(2, 1), (4, 3)}
    left = {r.doc_id: r.text for r in substring_dedup.cut(documents, found).collect()}
    assert left[3] == texts[3] and left[2].split() == texts[2].split()[354:]



def test_removals_are_whole_runs(spark):
    passages = {k: prose(330 + k, n) for k, n in enumerate((51, 60, 77, 120))}
    texts = {k: f"{prose(340 + k, 20 + 7 * k)} {p} {prose(350 + k, 50)}" for k, p in passages.items()}
    texts |= {10 + k: f"{prose(360 + k, 33 + 5 * k)} {p} {prose(370 + k, 60)}" for k, p in passages.items()}
    short = "\n".join(prose(380 + k, 11) for k in range(9))
    texts |= {20: short, 21: short}
    found = substring_dedup.removals(frame(spark, texts)).collect()
    expected = {(10 + k, 33 + 5 * k, 33 + 5 * k + len(p.split()), k) for k, p in passages.items()}
    assert sorted(map(tuple, found)) == sorted(expected | {(21, 0, 99, 20)})


def test_runs_grow_from_the_best_of_all_places():
    own = np.array([9, 1, 2, 3, 7, 7, 4, 5, 8], np.uint64)
    other = np.array([2, 3, 7, 7, 6, 0, 1, 2, 3, 7, 7, 4], np.uint64)
    places = np.array([2, 9])
    assert substring_dedup.grown_end(own, other, 3, places - 1, -1, -1) == 0
    assert substring_dedup.grown_end(own, other, 6, places + 2, len(own), 1) == 7



def test_paragraphs_at_the_threshold_share_a_bucket():
    bands = bands_for(substring_dedup.PERCENT / 100, substring_dedup.BAND_ROWS, substring_dedup.MISS)
    passages, draw, missed = substring_dedup.Passages(bands), np.random.default_rng(4), 0
    for _ in range(4000):
        items = draw.integers(1 << 62, size=50, dtype=np.uint64)  # 40 of 50 shared
        missed += not set(passages.band_hashes(items[:45])) & set(passages.band_hashes(items[5:]))
    assert missed <= 4




def test_paragraphs_hashed_together_have_the_bands_of_each(monkeypatch):
    monkeypatch.setattr(substring_dedup, "TOGETHER", 200)
    passages, draw = substring_dedup.Passages(18), np.random.default_rng(7)
    texts = [draw.integers(1 << 63, size=n, dtype=np.uint64) for n in (20, 21, 500, 20, 33, 9000, 64, 20)]
    one_by_one = [passages.band_hashes(shingles(t, substring_dedup.SHINGLE)) for t in texts]
    assert (passages.paragraph_bands(texts) == np.stack(one_by_one)).all()
    assert passages.paragraph_bands([]).shape == (0, 18)


def test_sums_of_many_tasks_are_folded_in_their_order(spark):
    rows = spark.range(0, 1500, 1, 500).selectExpr("CAST(id % 3 AS INT) AS block", "id AS x")
    parts = corpus.per_partition(rows, lambda batches: (lambda t: {
        "block": t[0], "value": [np.array([x, 1], "<f8").tobytes() for x in t[1]]})(
        [sum(lists, []) for lists in zip(*([b.column(0).to_pylist(), b.column(1).to_pylist()] for b in batches))]),
        "block int, value binary")
    got = {r.block: np.frombuffer(r.value, "<f8").tolist() for r in corpus.summed_blocks(parts, "<f8").collect()}
    assert got == {k: [float(sum(range(k, 1500, 3))), 500.0] for k in range(3)}
    order = corpus.folded_blocks(parts, lambda k, out, v: np.append([] if out is None else out, np.frombuffer(v)[0]))
    assert all(np.frombuffer(r.value).tolist() == list(range(r.block, 1500, 3)) for r in order.collect())


def test_windows_are_shared_by_every_long_common_run():
    passages = substring_dedup.Passages(2)
    need = substring_dedup.WINDOW + substring_dedup.SPREAD - 1
    for seed in range(40):
        common = prose(seed, need)
        a, b = (passages.windows(passages.lines(f"{prose(seed + 50, seed)} {common} {prose(seed + 90, 33)}")[0])[0],
                passages.windows(passages.lines(f"{prose(seed + 150, 2 * seed)} {common}")[0])[0])
        assert set(a.tolist()) & set(b.tolist())


# --- packing ----------------------------------------------------------------------

@pytest.mark.parametrize("rows", [ODD, [(i, prose(i, 10 + i)) for i in range(300)]])
def test_packing_holds_every_id_once(spark, rows):
    encode = packing.TextEncoder(packing.TOKENIZER).encode
    pieces = packing.pack(frame(spark, rows), with_ids=True).collect()
    expected = Counter((i, tuple(encode(t or "") + [1])) for i, t in rows)
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        assert len(p.ids) == 4 * p.length and p.ids_crc32 == zlib.crc32(p.ids)
    for s, parts in sequences.items():
        ends = [0] + [o + n for o, n in sorted(parts)]
        assert [o for o, _ in sorted(parts)] == ends[:-1]
        assert ends[-1] == 2048 or s == max(sequences)
    streams = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
    found, current = Counter(), []
    for p in streams:
        assert p.start == len(current)
        current += np.frombuffer(p.ids, "<u4").tolist()
        if len(current) == p.doc_tokens:
            found[p.doc_id, tuple(current)] += 1
            current = []
    assert found == expected and not current


def test_packing_of_nothing(spark):
    assert packing.pack(frame(spark, ODD).limit(0)).count() == 0


def test_runs_give_the_ids_of_whole_texts():
    encoder = packing.TextEncoder(packing.TOKENIZER)
    assert encoder.by_runs
    for text in ("It's, I'm. DON'T,x ... a,b.c, Ö.", "\x1c a\x1db", "é ́ ſ. İ,", "<|endoftext|>a, b<|startoftext|>"):
        assert np.frombuffer(encoder.ids(text), encoder.kind).tolist() == encoder.encode(text)


# --- piece coding -----------------------------------------------------------------

def best_by_table(codec, marked):
    ordinary = {p: codec.scores[i] for i, p in enumerate(codec.pieces) if i not in codec.bytes and i > 2}
    best = [0.0] + [-math.inf] * len(marked)
    for end in range(1, len(marked) + 1):
        for start in range(max(0, end - 20), end):
            piece = marked[start:end]
            gain = ordinary.get(piece, codec.uncovered if end - start == 1 else None)
            if gain is not None:
                best[end] = max(best[end], best[start] + gain)
    return best[-1]


def test_one_pass_viterbi_finds_the_best_score():
    codec = piece_viterbi.codec(piece_viterbi.MODEL)
    for text in ("hello world", "thinterble tion  of", "日本 é\U0001f600x", prose(4, 30), "aaaaaaa", " "):
        ids, score = codec.encode(text)
        assert score == pytest.approx(best_by_table(codec, "▁" + text.replace(" ", "▁")), rel=1e-12)
        assert codec.decode(ids) == text


def test_coding_restores_odd_rows(spark):
    rows = piece_viterbi.coding_digest(odd(spark)).collect()
    assert len(rows) == len(ODD) and all(r.restored for r in rows)
    assert {r.n_ids for r in rows if r.doc_id in (1, 2)} == {0}
    back = piece_viterbi.decode_ids(piece_viterbi.encode_texts(odd(spark).select("doc_id", "text")))
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter((i, t or "") for i, t in ODD)


# --- classifiers ------------------------------------------------------------------

def toxic_corpus(spark, n=900):
    texts, marks = {}, []
    for i in range(n):
        toxic, poor = i % 5 == 1, i % 4 == 2
        text = prose(i, 40 + i % 60)
        text = f"{text} utter moronic{i % 7} trash {text[:40]}" if toxic else text
        texts[i] = " ".join(f"{w}$$$!!" for w in text.upper().split()) if poor else text
        marks.append((i, int(not poor), int(toxic)))
    return frame(spark, texts), labels(spark, marks), marks


def test_classifiers_hold_out_and_separate(spark):
    documents, known, marks = toxic_corpus(spark)
    for judged, label, modulus, rest in ((quality.judged, 1, 4, 2), (toxicity.judged, 2, 5, 0)):
        rows = {r.doc_id: r for r in judged(documents, known).collect()}
        assert all(r.held_out == (zlib.crc32(str(i).encode()) % modulus == rest) and 0 <= r.score <= 1
                   for i, r in rows.items())
        held = [m for m in marks if rows[m[0]].held_out]
        assert sum(rows[m[0]].predicted == m[label] for m in held) >= 0.97 * len(held)


def test_classifiers_on_odd_rows(spark):
    _, known, _ = toxic_corpus(spark, 300)
    documents = toxic_corpus(spark, 300)[0].unionByName(frame(spark, [(10_000 + i, t) for i, (_, t) in enumerate(ODD)]))
    for module in (quality, toxicity):
        assert module.judged(documents, known).count() == 300 + len(ODD)
        rows = module.kept(odd(spark), known)
        assert rows.columns == odd(spark).columns
        empty = known.limit(0)
        assert {round(r.score, 2) for r in module.judged(odd(spark), empty).select("score").collect()} <= {0.0, 0.5}
        assert module.judged(odd(spark).limit(0), known).count() == 0


def test_isotonic_levels_rise():
    at, levels = quality.isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([1.0, 0.0, 3.0, 4.0]), np.array([2.0, 2, 4, 4]))
    assert levels.tolist() == [0.25, 0.75, 1.0] and (np.diff(at) > 0).all()


# --- language model ---------------------------------------------------------------

def test_scores_follow_the_counts_and_learn(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "SENT_WORDS", 20)
    draw = random.Random(5)
    texts = {i: " ".join(draw.choice("the cat sat on a mat and saw no dog".split()) for _ in range(draw.randrange(5, 60)))
             + f" rare{i % 90} only{i}" for i in range(400)}
    texts |= {1000: None, 1001: "", 1002: "z" * 500, 1003: "the " * 3000}
    rows = {r.doc_id: r for r in lm_scoring.scores(frame(spark, texts)).collect()}
    tokens = {i: [*words(t), b" "] for i, t in texts.items()}
    counts = Counter(w for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in t)
    total = sum(counts.values())
    for i, row in rows.items():
        assert row.train_tokens == total and row.n_tokens == len(tokens[i])
        assert row.n_known == sum(counts[w] > 0 for w in tokens[i])
        assert row.base_score == pytest.approx(
            sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in tokens[i]), abs=1e-6)
    held = [r for i, r in rows.items() if r.held_out and i < 1000]
    assert sum(r.score for r in held) / sum(r.n_tokens for r in held) > -3.5
    assert all(r.score < 0 for r in rows.values())


def test_model_learns_once_from_every_training_document(spark, monkeypatch):
    texts, learnt, round_of = {i: prose(i, 20) for i in range(120)}, [], lm_scoring._round

    def seen(lessons, model, rate):
        learnt.extend(r.doc_id for r in lessons.select("doc_id").collect())
        return round_of(lessons, model, rate)

    monkeypatch.setattr(lm_scoring, "_round", seen)
    assert lm_scoring.scores(frame(spark, texts)).count() == len(texts)
    assert sorted(learnt) == [i for i in texts if zlib.crc32(str(i).encode()) % 7 != 2]


def test_classes_are_formed_on_the_neighbours_in_all_training_documents(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "CLASS_SAMPLE", 50, raising=False)
    ids, made, classed = lm_scoring.subwords(), [], getattr(lm_scoring, "classed_model", None)
    texts = {i: prose(i, 20) for i in range(90)} | {100: "", 101: None}
    monkeypatch.setattr(lm_scoring, "classed_model", lambda counts, near: made.append(near) or classed(counts, near),
                        raising=False)
    lm_scoring.scores(frame(spark, texts)).count()
    size = lm_scoring.END + 1
    bucket = np.random.default_rng(3).integers(0, 96, size)
    expected = np.zeros((size, 192), np.int64)
    for i, t in texts.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            row = [lm_scoring.BEGIN, *np.frombuffer(b"".join(map(ids.__getitem__, words(t))), "<u2").tolist(), lm_scoring.END]
            for a, b in zip(row, row[1:]):
                expected[b, bucket[a]] += 1
                expected[a, 96 + bucket[b]] += 1
    assert len(made) == 1 and (made[0] == expected).all()


def test_scores_of_odd_rows(spark):
    assert lm_scoring.scores(odd(spark)).count() == len(ODD)
    assert lm_scoring.scores(odd(spark).limit(0)).count() == 0


def test_windows_score_every_id_once_and_probabilities_add_up():
    draw = np.random.default_rng(1)
    ids = [draw.integers(0, 300, n).astype("<u2").tobytes() for n in (0, 1, 31, 32, 33, 200)]
    given, targets, owners = lm_scoring.windows(ids)
    for k, x in enumerate(ids):
        assert targets[owners == k].tolist() == [*np.frombuffer(x, "<u2").tolist(), lm_scoring.END]
    size = lm_scoring.END + 1
    model = lm_scoring.fresh_model(draw.integers(0, 50, size).astype(float), [np.frombuffer(x, "<u2") for x in ids])
    scorer, total = lm_scoring.Scorer(model), 0.0
    every = np.arange(size)
    for start in range(0, size, 512):
        goals = every[start:start + 512]
        targets = np.zeros((len(goals), lm_scoring.SCORED), np.int64)
        targets[:, 0] = goals
        total += np.exp(scorer.logs(given[-1:].repeat(len(goals), axis=0), targets).reshape(targets.shape)[:, 0]).sum()
    assert total == pytest.approx(1.0, abs=1e-3)


def test_slopes_are_those_of_the_loss():
    draw = np.random.default_rng(2)
    ids = [draw.integers(0, 40, 70).astype("<u2").tobytes()]
    given, targets, owners = lm_scoring.windows(ids)
    use = owners >= 0
    size = lm_scoring.END + 1
    model = lm_scoring.fresh_model(draw.integers(0, 50, size).astype(float), [np.frombuffer(ids[0], "<u2")])
    model = model._replace(**{n: getattr(model, n).astype(np.float64) for n in lm_scoring.LEARNED})

    def loss(m):
        logs = lm_scoring.Scorer(m).logs(given, targets) - m.within[targets.ravel()]
        return -logs[use.ravel()].mean()

    found = lm_scoring.slopes(model, given, targets, use)
    for name in lm_scoring.LEARNED:
        flat = np.abs(found[name]).ravel()
        place = np.unravel_index(flat.argmax(), found[name].shape)
        moved = []
        for step in (1e-3, -1e-3):
            changed = getattr(model, name).copy()
            changed[place] += step
            moved.append(loss(model._replace(**{name: changed})))
        assert (moved[0] - moved[1]) / 2e-3 == pytest.approx(found[name][place], rel=0.05, abs=1e-5)


# --- pipeline ---------------------------------------------------------------------

def test_pipeline_stages_take_effect(spark, tmp_path):
    documents, known, marks = toxic_corpus(spark, 400)
    passage = prose(999, 70)
    extra = frame(spark, [(2001, prose(5001, 90) + " " + passage), (2002, passage + " " + prose(5002, 90)),
                          (2003, prose(5003, 120)), (2004, prose(5003, 120))])
    documents.unionByName(extra).write.parquet(f"{tmp_path}/documents.parquet")
    known.write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = Shelf(spark, "t").keep(stage(spark, docs, str(tmp_path)), "out")
        seen[name] = docs
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in seen.items()}
    poor, toxic = {m[0] for m in marks if not m[1]}, {m[0] for m in marks if m[2]}
    assert len(ids["quality classifier"] & poor) <= 0.05 * len(poor)
    assert len(ids["toxicity"] & toxic) <= 0.05 * len(toxic)
    assert 2003 in ids["MinHash near-dedup"] and 2004 not in ids["MinHash near-dedup"]
    texts = {r.doc_id: r.text for r in seen["substring dedup"].collect()}
    assert passage in texts[2001] and passage not in texts[2002]
    assert ids["packing"] == set(texts)
    assert all(seen[n].columns == documents.columns for n in ids if n != "packing")


def test_hashes_do_not_depend_on_the_process():
    assert shingles(word_hashes(words("a B c d")), 3).tolist() == shingles(word_hashes([b"a", b"b", b"c", b"d"]), 3).tolist()
    assert word_hashes([b'the']).tolist() == [xxhash.xxh3_64_intdigest(b'the')]
