"""Vector operators against brute force, url verdicts, and odd inputs of both."""

import os

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry_file
import compare
from orderlake.llm import permutation_index, url_filter, vector_dedup

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "vec_id bigint, embedding array<float>, label int, extra string, score string, node string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], k, "e", "s", "n")
                                  for i, v, k in rows], SCHEMA)


ODD = [(1, None, 1), (2, [0.0] * 8, 1), (3, [float("nan")] * 8, 1), (4, [float("inf")] + [1.0] * 7, 1),
       (5, [None] + [1.0] * 7, 1), (6, [1.0] * 3, 1), (None, [1.0] * 8, 1), (8, [1.0] * 8, None), (9, [], 1),
       (20, [1.0] * 8, 1), (20, [1.0] * 8, 1), (21, [2.0] * 8, 1), (40, [1.0] * 7 + [-1.0], 2)]


def crowd(seed, n, dim=16, copies=60):
    draw = np.random.default_rng(seed)
    base = draw.normal(size=(n, dim))
    near = base[3] + draw.normal(size=(copies, dim)) * 0.08
    chain = [base[5] * np.cos(a) + base[6] / np.linalg.norm(base[6]) * np.linalg.norm(base[5]) * np.sin(a)
             for a in np.arange(0, 1.5, 0.15)]
    all_rows = np.vstack([base, near, chain, base[7:8], base[7:8]]).astype(np.float32).astype(float)
    return [(int(i), v.tolist(), int(i % 3 > 0)) for i, v in enumerate(all_rows)]


# --- permutation index ------------------------------------------------------------

def test_nearest_are_found_and_scored_exactly(spark):
    rows = crowd(1, 900)
    found = permutation_index.nearest(vectors(spark, rows))
    x = np.array([r[1] for r in rows])
    hits, asked = 0, 0
    by_query = {}
    for r in found.collect():
        by_query.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(by_query) == {i for i in range(len(rows)) if i % 20 == 0}
    for q, answers in by_query.items():
        answers.sort()
        assert [a[0] for a in answers] == list(range(1, 21)) and q not in {a[1] for a in answers}
        assert all(s == pytest.approx(float(x[v] @ x[q]), abs=1e-9) for _, v, s in answers)
        assert [(-s, v) for _, v, s in answers] == sorted((-s, v) for _, v, s in answers)
        scores = x @ x[q]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -scores))[:20]
        hits += len(set(best.tolist()) & {a[1] for a in answers})
        asked += 20
    assert hits / asked >= 0.9
    assert permutation_index.measured_recall(vectors(spark, rows), found, queries=16) >= 0.9


def test_nearest_of_odd_rows(spark):
    rows = permutation_index.nearest(vectors(spark, ODD)).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in rows) == [
        (20, 1, 21), (20, 2, 8), (20, 3, 40), (40, 1, 21), (40, 2, 8), (40, 3, 20)]
    assert permutation_index.nearest(vectors(spark, ODD[:3])).count() == 0


def test_footrule_by_files_is_that_of_the_orders():
    draw = np.random.default_rng(3)
    orders = np.array([draw.permutation(12)[:5] for _ in range(40)], np.int32)
    found = permutation_index.PivotFiles(orders, 12).footrules(orders[:7])
    for a in range(7):
        for b in range(40):
            place_a, place_b = ({p: i for i, p in enumerate(o.tolist())} for o in (orders[a], orders[b]))
            assert found[a, b] == sum(abs(place_a.get(p, 5) - place_b.get(p, 5)) for p in range(12))


# --- vector near-duplicates -------------------------------------------------------

def expected_links(rows, least):
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    linked = (x @ x.T >= least) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    low = np.arange(len(rows))
    for _ in range(len(rows)):
        for i in range(len(rows)):
            if linked[i].any():
                low[i] = min(low[i], low[linked[i]].min())
    return {i: (int(linked[i].sum()), int(low[i])) for i in range(len(rows))}


@pytest.mark.parametrize("small", [False, True])
def test_links_and_components_are_those_of_brute_force(spark, monkeypatch, small):
    if small:  # many overlapping clusters, chunks and blocks
        for name, value in (("CLUSTER", 40), ("CHUNK", 30), ("SEARCHED", 25)):
            monkeypatch.setattr(vector_dedup, name, value)
    rows = crowd(2, 250)
    found = vector_dedup.near_duplicates(vectors(spark, rows))
    got = {r.vec_id: (r.n_links, r.component_id) for r in found.collect()}
    assert got == expected_links(rows, 0.98)
    assert vector_dedup.audited_recall(vectors(spark, rows), found) == 1.0


def test_a_search_that_misses_links_is_found_out_and_made_wider(spark, monkeypatch):
    rows = crowd(2, 250)
    blind = (0, -1.0)  # looks at the medoid and the vector itself, and expands nothing
    monkeypatch.setattr(vector_dedup, "SEARCHES", (blind,))
    missed = vector_dedup.near_duplicates(vectors(spark, rows))
    assert vector_dedup.audited_recall(vectors(spark, rows), missed) < 0.5
    monkeypatch.setattr(vector_dedup, "SEARCHES", (blind, None))
    found = vector_dedup.near_duplicates(vectors(spark, rows))
    assert {r.vec_id: (r.n_links, r.component_id) for r in found.collect()} == expected_links(rows, 0.98)


def test_links_of_odd_rows(spark):
    rows = vector_dedup.near_duplicates(vectors(spark, ODD)).collect()
    assert len(rows) == len(ODD)
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in rows if r.vec_id in (20, 21, 40)} == {
        (20, 1, 20, True), (21, 1, 20, False), (40, 0, 40, True)}
    assert all(r.n_links == 0 and r.kept for r in rows if r.vec_id is None or r.vec_id < 10)
    assert vector_dedup.near_duplicates(vectors(spark, []).limit(0)).count() == 0


# --- urls -------------------------------------------------------------------------

@pytest.mark.parametrize("url, host, path, rule, verdict", [
    ("http://a.Example.com/en/1?x=/de/", "a.example.com", "/en/1", "example.com/en/", "block"),
    ("https://www.example.com/en/x", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("http://notexample.com/en/x", "notexample.com", "/en/x", "com/", "allow"),
    ("http://a.com", "a.com", "", None, "allow"),
    ("http://x.net/es/?casino", "x.net", "/es/", "net/es/", "block"),
    ("http://x.org/casino-royal", "x.org", "/casino-royal", None, "block"),
    ("http://x.org/occasion-casinos", "x.org", "/occasion-casinos", None, "allow"),
    ("http://y.org/adult", "y.org", "/adult", None, "allow"),
    ("http://adult.x1.org/adult/poker", "adult.x1.org", "/adult/poker", None, "block"),
    ("http://x.org/%63asin%6F", "x.org", "/%63asin%6F", None, "block"),
    ("http://x.org/%2Fcasino%3f", "x.org", "/%2Fcasino%3f", None, "block"),
    ("http://x.org/%2563asino", "x.org", "/%2563asino", None, "allow"),
    ("http://x.org/\u00e9casino", "x.org", "/\u00e9casino", None, "allow"),
    ("http://x.org/e\u0301casino", "x.org", "/e\u0301casino", None, "allow"),
    ("http://x.org/%C3%A9casino", "x.org", "/%C3%A9casino", None, "allow"),
    ("http://x.org/\u2014casino", "x.org", "/\u2014casino", None, "block"),
    ("http://x.org/%", "x.org", "/%", None, "allow"),
    ("no scheme", "", "", None, "allow"), ("", "", "", None, "allow"), (None, "", "", None, "allow"),
])
def test_verdicts(url, host, path, rule, verdict):
    found = url_filter.UrlJudge().judge(url)
    assert (found.host, found.path, found.rule, found.verdict) == (host, path, rule, verdict)


def test_verdicts_of_odd_urls_are_those_of_the_sql():
    draw = np.random.default_rng(11)
    parts = ["casino", "%63asino", "%58xx", "xxx", "poker", "%50oker", "slots", "free", "hot", "%", "%2", "%2f", "%2F", "%25",
             "63", "/", "-", ".", "\u00e9", "\u0301", "\u4e2d", "\u0663", "\u2014", "%c3%a9", "\n", " ", "\x00", "?", "#", "Z", "9",
             "http://", "://", "net/es/", "a.example.com/en/", "x.org/", "\u212a", "\u0130"]
    urls = ["".join(draw.choice(parts, draw.integers(0, 12))) for _ in range(3000)] + [None, ""]
    pages = pa.table({"page_id": pa.array(range(len(urls)), pa.int64()), "url": pa.array(urls, pa.string())})
    with duckdb.connect() as connection:
        connection.register("pages", pages)
        rows = connection.execute(f"SELECT page_id, host, path, rule, verdict, strict_hits, soft_weight "
                                  f"FROM ({entry_file.CORPUS_SQL['op3_url_filter']}) ORDER BY page_id").fetchall()
    judge = url_filter.UrlJudge()
    assert [(i, *judge.judge(url)) for i, url in enumerate(urls)] == rows
    assert sum(r[5] > 0 for r in rows) > 300 and sum(r[6] > 0 for r in rows) > 300


def test_urls_of_odd_rows(spark):
    pages = spark.createDataFrame([(None, "http://a.org"), (1, None), (2, "x" * 100_000), (2, "x" * 100_000)],
                                  "page_id bigint, url string").selectExpr("*", "'x' AS host", "'y' AS verdict")
    assert [r.page_id for r in url_filter.judge_urls(pages).collect()] == [None, 1, 2, 2]
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


# --- registered queries -----------------------------------------------------------

def test_all_thirteen_and_the_pipeline_are_registered():
    names = [n for n in entry_file.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n[2:3].isdigit()) == list(range(1, 14))
    assert "pipeline" in entry_file.queries()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(entry_file.CORPUS_SQL))
def test_same_rows_as_sql(spark, name):
    found = entry_file.queries()[name](spark, SF_DIR)
    connection = compare.duck(SF_DIR)
    assert compare.spark_bag(found) == compare.duck_bag(connection, entry_file.CORPUS_SQL[name])
