"""Clustering, hard negatives and personal data against plain versions, SQL, and odd inputs."""

import hashlib
import os
import re
import time

import numpy as np
import pytest

import __spark_entry__ as entry_file
import compare
from orderlake.llm import block_kmeans, hard_negatives, personal_data
from pyspark.sql import functions as F

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "vec_id bigint, embedding array<float>, label int, cluster string, rank string, cells string"


def vectors(spark, rows):
    return spark.createDataFrame(
        [(i, None if v is None else [None if x is None else float(x) for x in v], k, "c", "r", "s")
         for i, v, k in rows], SCHEMA)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
@pytest.mark.parametrize("name", ["op11_centroid_clustering", "op12_hard_negatives"])
def test_queries_match_sql(spark, name):
    frame, connection = entry_file.queries()[name](spark, SF_DIR), compare.duck(SF_DIR)
    sql = entry_file.oracle_sql()[name]
    assert compare.spark_bag(frame) == compare.duck_bag(connection, sql)
    assert compare.type_differences(frame, connection, sql) == {}


# --- clustering ---------------------------------------------------------------------

def lloyd(rows, clusters, rounds, length):
    """The plain version, in Python's whole numbers."""
    kept = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, _ in rows
            if v is not None and len(v) == length and all(x is not None and np.isfinite(x) for x in v)]
    named = [(hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    centres = [v for _, v in sorted(named)[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for k in range(len(centres)):
            mine = [v for (_, v), a in zip(kept, at) if a == k]
            if mine:
                centres[k] = [sum(column) // len(mine) for column in zip(*mine)]
    return [(i, k, d) for i, (d, k) in ((i, nearest(v)) for i, v in kept)], centres


def some_vectors(seed, n, length):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(6, length))
    rows = middle[draw.integers(0, 6, n)] + draw.normal(size=(n, length)) * 0.3
    return [(int(i) * 5, v.astype(np.float32).tolist(), int(i % 3)) for i, v in enumerate(rows)]


@pytest.mark.parametrize("block, chunk", [(4, 32), (3, 7), (64, 4096)])
def test_clusters_are_those_of_plain_rounds(spark, block, chunk):
    rows = some_vectors(5, 230, 10)
    rows += [(7, rows[3][1], 1), (7, rows[3][1], 1), (None, rows[4][1], None), (8, None, 1), (9, [1.0] * 9, 1),
             (11, [None] + [1.0] * 9, 1), (12, [float("nan")] * 10, 1), (13, [float("-inf")] * 10, 1), (14, [], 1)]
    frame = vectors(spark, rows).repartition(5)
    found = block_kmeans.cluster_report(frame, clusters=9, rounds=4, length=10, block=block, chunk=chunk).collect()
    expected, centres = lloyd(rows, 9, 4, 10)
    key = lambda r: (r[0] is None, r)
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in found), key=key) == sorted(expected, key=key)
    assert {r.inertia for r in found} == {sum(d for _, _, d in expected)}
    for r in found:
        assert r.cluster_inertia == sum(d for _, k, d in expected if k == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()


def test_empty_clusters_stay_and_equal_distances_go_to_the_smaller_number(spark):
    rows = [(i, [1.0, 2.0], 0) for i in range(8)] + [(50, [1e30, 2.0], 0)]
    found = block_kmeans.cluster_report(vectors(spark, rows), clusters=5, rounds=3, length=2, block=1, chunk=2)
    expected, _ = lloyd([(i, [min(v[0], float(1 << 19)), v[1]], k) for i, v, k in rows], 5, 3, 2)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in found.collect()) == sorted(expected)


def test_nothing_to_cluster(spark):
    for rows in ([], [(1, None, 1), (2, [1.0], 1)]):
        found = block_kmeans.cluster_report(vectors(spark, rows))
        assert found.count() == 0
        assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_distances_stay_exact_where_doubles_are_not():
    cells = np.array([[block_kmeans.BOUND, -3]], np.int32)
    centres = np.array([[-block_kmeans.BOUND, 4], [block_kmeans.BOUND, 4]], np.int64)
    assert block_kmeans.shares(cells, centres).tolist() == [[(2 * block_kmeans.BOUND) ** 2 + 49, 49]]


# --- hard negatives -----------------------------------------------------------------

def plain_negatives(rows, modulus, positives=5, negatives=10):
    kept = {}
    for i, v, k in rows:
        if i is None or k is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        cells = [int(np.floor(256 * float(np.float32(x)))) for x in v]
        kept[i] = min(kept.get(i, (k, cells)), (k, cells))
    out = []
    for a, (label, cells) in kept.items():
        if a % modulus:
            continue
        scored = sorted((-sum(x * y for x, y in zip(cells, other)), i, k)
                        for i, (k, other) in kept.items() if i != a)
        for minus, p, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [(i, -s) for s, i, k in scored if k != label and 30 * -minus <= 100 * -s <= 90 * -minus]
            out += [(a, p, rank, i, -minus, s) for rank, (i, s) in enumerate(inside[:negatives], 1)]
    return sorted(out)


ODD = [(1, None, 1), (2, [0.0] * 6, 1), (3, [float("nan")] * 6, 1), (4, [float("inf")] + [1.0] * 5, 2),
       (5, [None] + [1.0] * 5, 1), (6, [1.0] * 3, 1), (None, [1.0] * 6, 1), (8, [1.0] * 6, None), (9, [], 2),
       (20, [1.0] * 6, 1), (20, [0.5] * 6, 1), (21, [1.0] * 6, 1), (23, [1.0] * 6, 1), (40, [1.0] * 5 + [-1.0], 2),
       (41, [0.5] * 6, 2), (42, [0.5] * 6, 2), (44, [0.5] * 6, 3), (60, [-1.0] * 6, 2)]


def mined(frame, modulus, **options):
    found = hard_negatives.mined(frame, F.col("id") % modulus == 0, **options)
    return sorted(tuple(r) for r in found.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("block_rows", [10_000, 6])
def test_negatives_are_those_of_plain_search(spark, block_rows):
    rows = some_vectors(8, 400, 12)
    expected = plain_negatives(rows, 25)
    assert expected
    assert mined(vectors(spark, rows).repartition(5), 25, block_rows=block_rows) == expected


def test_negatives_of_several_slabs_and_wide_fields(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "SLAB", 64)
    rows = [(i, [300 * x for x in v], k) for i, v, k in some_vectors(9, 300, 12)]
    table = hard_negatives.candidates(vectors(spark, rows), "vec_id", "embedding", "label")
    cells = np.array([r.cells for r in table.orderBy("id").collect()], np.int64)
    packed = hard_negatives.Packed(cells, hard_negatives.Fields.for_table(12, int(np.abs(cells).max())))
    assert packed.form.kind == "<u8"
    assert (packed.scores(cells[7])[1] == cells @ cells[7]).all()
    assert mined(vectors(spark, rows), 20) == plain_negatives(rows, 20)


def test_negatives_of_odd_rows(spark):
    assert mined(vectors(spark, ODD), 20) == plain_negatives(ODD, 20)
    assert mined(vectors(spark, []), 20) == []
    assert mined(vectors(spark, [r for r in ODD if r[0] != 20]), 1000) == []


def test_packed_scores_are_exact_to_the_last_field():
    draw = np.random.default_rng(2)
    cells = draw.integers(-500, 501, (hard_negatives.FIELDS * 2 + 5, 7))
    packed = hard_negatives.Packed(cells, hard_negatives.Fields.for_table(7, 500))
    assert packed.form.kind == "<u4"
    extreme = np.array([500, -500] * 3 + [500])
    for anchor in (cells[0], cells[-1], extreme, -extreme, np.zeros(7, np.int64)):
        assert (packed.scores(anchor)[1] == cells @ anchor).all()
        begin, part = packed.scores(anchor, hard_negatives.FIELDS + 3, hard_negatives.FIELDS + 9)
        assert begin == hard_negatives.FIELDS and (part == (cells @ anchor)[begin:begin + len(part)]).all()
    with pytest.raises(ValueError):
        hard_negatives.Fields.for_table(1 << 20, 1 << 24)


# --- personal data ------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in re.sub("[^0-9]", "", m.group())]
            doubled = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits[::-1]))
            if (kind == "email" or kind == "ip" and all(int(p) < 256 for p in m.group().split("."))
                    or kind == "card" and 12 <= len(digits) <= 19 and doubled % 10 == 0
                    or kind == "phone" and 9 <= len(digits) <= 15):
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out))


PIECES = ["a", "b.c", "@", "@@", "x@y", ".co", ".com", " ", "-", "+", "1", "12", "255", "256", ".", "(", ")", "\n", "é",
          "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "10.0.0.1", "joe@mail.example.org", "😀"]


def test_base_spans_are_those_of_the_patterns():
    draw = np.random.default_rng(4)
    for _ in range(4000):
        text = "".join(draw.choice(PIECES, draw.integers(1, 14)))
        assert personal_data.written(personal_data.base_spans(text)) == plain_spans(text), repr(text)


def test_spans_of_long_runs_take_linear_time():
    begin = time.process_time()
    for text in ("a." * 100_000, "a@" * 100_000, "1" * 200_000, "1 " * 100_000, "1." * 100_000, "+1" + "(" * 200_000,
                 "+1 " * 60_000, "at dot " * 30_000, "a at " * 40_000 + "dot", "a@b." * 50_000, "1.2.3." * 30_000):
        personal_data.base_spans(text)
        personal_data.candidates(text)
    assert time.process_time() - begin < 20


def people(n):
    """Documents with all kinds of data, some spelled so that no pattern finds it, and look-alikes."""
    draw, rows, hidden, harmless = np.random.default_rng(6), [], {}, {}

    def card():
        body = draw.integers(0, 10, 15).tolist()
        return next(c for c in ("".join(map(str, body)) + str(d) for d in range(10))
                    if plain_spans(c).startswith("card"))

    for i in range(n):
        name = "".join(draw.choice(list("abcdefgh"), 6))
        number, quad = "".join(map(str, draw.integers(0, 10, 10))), ".".join(map(str, draw.integers(1, 256, 4)))
        parts = [f"mail {name}@site.org now", f"from {quad} again", f"card {card()} paid", f"call +{number} soon",
                 f'token = "a{number}9f" end', f"serial {number}{number[:6]} made"]
        text = " and then ".join(parts[k] for k in draw.permutation(6)[:4])
        if i % 10 == 0:
            hidden[i] = [f"{name} [at] site [dot] org", quad.replace(".", "[.]")][i // 10 % 2]
            text += " also " + hidden[i] + " there"
        elif i % 10 == 1:
            harmless[i] = quad + "999"
            text += " version " + harmless[i] + " there"
        rows.append((i, text, "x", "y"))
    return rows, hidden, harmless


PEOPLE = "doc_id bigint, text string, base string, spans string"


def test_spelled_data_is_added_and_look_alikes_are_not(spark):
    rows, hidden, harmless = people(1500)
    frame = spark.createDataFrame(rows, PEOPLE)
    found = {r.doc_id: r for r in personal_data.report(frame).collect()}
    assert len(found) == len(rows)
    right = wrong = 0
    for i, text, *_ in rows:
        base = plain_spans(text)
        assert found[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        for kind in personal_data.KINDS:
            assert found[i][f"n_{kind}"] == len(re.findall(kind, base))
        spans = found[i].spans.split(",") if found[i].spans else []
        assert set(base.split(",")) - {""} <= set(spans)
        more = [text[int(s.split(":")[1]):int(s.split(":")[2])] for s in spans if s not in base.split(",")]
        right += hidden.get(i) in more
        wrong += sum(m != hidden.get(i) for m in more)
    assert right >= 0.9 * len(hidden)
    assert wrong <= 0.05 * len(hidden)


def test_spans_of_odd_texts(spark):
    rows = [(1, None, "x", "y"), (2, "", "x", "y"), (None, "a@b.co", "x", "y"), (3, "a@b.co", "x", "y"),
            (3, "a@b.co", "x", "y"), (4, "é😀 a@b.co", "x", "y"), (5, "word " * 50_000 + "10.0.0.1", "x", "y")]
    found = personal_data.report(spark.createDataFrame(rows, PEOPLE)).collect()
    assert sorted((r.doc_id or 0, r.spans) for r in found) == [
        (0, "email:0:6"), (1, ""), (2, ""), (3, "email:0:6"), (3, "email:0:6"), (4, "email:3:9"), (5, "ip:250000:250008")]
    assert personal_data.report(spark.createDataFrame([], PEOPLE)).count() == 0


def test_redacted_texts_keep_everything_else(spark):
    rows = [(1, "to a@b.co from 10.0.0.1", "x", "y"), (2, None, "x", "y"), (3, "+4111111111111111 x", "x", "y")]
    frame = spark.createDataFrame(rows, PEOPLE)
    cleaned = personal_data.redacted(frame, personal_data.NOTHING)
    assert cleaned.columns == frame.columns
    assert [(r.doc_id, r.text, r.base) for r in cleaned.orderBy("doc_id").collect()] == [
        (1, "to [email] from [ip]", "x"), (2, None, "x"), (3, "+[card] x", "x")]


def test_trees_learn_what_no_single_feature_tells():
    draw = np.random.default_rng(11)
    rows = draw.normal(size=(4000, 5))
    labels = ((rows[:, 0] > 0) ^ (rows[:, 3] > 0.5)).astype(int)
    apart = np.arange(4000) % 4 == 0
    model = personal_data.learn(np.zeros(4000, int), rows, labels, apart, 0.95)
    assert (((model.scores(rows[apart]) > 0.5) == labels[apart]).mean()) > 0.95
    chosen = model.scores(rows[apart]) >= model.least[0]
    assert labels[apart][chosen].mean() >= 0.95 and chosen.any()
