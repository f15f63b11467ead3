"""Repeated passages across documents: paragraph MinHash banding with exact verification.

A paragraph is a line of at least ``MIN_WORDS`` words.  MinHash bands, tuned for
a stated recall at the threshold, bring similar paragraphs together; their
five-word shingle sets are compared in full (see ``linking``), and components of
links are the groups of one passage.

Passages also repeat inside paragraphs that are otherwise different.  For these,
windows of ``WINDOW`` words begin at content-chosen places (the smallest word-pair
hash of every ``SPREAD`` places), so a run of ``WINDOW + SPREAD - 1`` equal words
always holds a common window wherever it stands; equal windows are groups too,
and each is grown word by word to the whole run shared with the keeping document.

In each group the document with the smallest id keeps its text; in every other
document the group's paragraphs and windows are removed, overlapping ones as one
span, wherever and however often they stand in it.  Paragraphs are settled first and
windows looked for in what these leave, so no window is kept in a removed
paragraph.  Repetition inside the keeping document is left alone.

NULL and short texts have no passages.  Repeated rows of one id count as one
document.  Rows with a NULL id are never changed.  An empty table has no removals.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.components import components
from orderlake.llm.corpus import (BROADCAST_ROWS, Shelf, fresh, join_small, mixed, per_text, shingles, signed,
                                  word_hashes)
from orderlake.llm.linking import bands_for, similar_links

SHINGLE = 5
PERCENT = 80
MIN_WORDS = 20
WINDOW = 25
SPREAD = 26
BAND_ROWS = 4
#: Chance that two paragraphs just at the threshold share no band.
MISS = 1e-4
#: Words of paragraphs that are hashed together.
TOGETHER = 16_384
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class Passages:
    """Hashes of the paragraphs and windows of one text."""

    def __init__(self, bands: int, seed: int = 6):
        draw = np.random.default_rng(seed)
        self.factors = draw.integers(1 << 62, size=(bands * BAND_ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.bands = bands
        self.powers = np.cumprod(np.full(WINDOW, 0x9E3779B97F4A7C15, np.uint64))

    def lines(self, text: str | None) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Word hashes of the text, and the word spans of its paragraphs."""
        tokens, spans = [], []
        for line in (text or "").encode("utf-8", "surrogatepass").lower().split(b"\n"):
            found = line.split()
            if len(found) >= MIN_WORDS:
                spans.append((len(tokens), len(tokens) + len(found)))
            tokens += found
        return word_hashes(tokens), spans

    def windows(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first word of each window, equal ones included."""
        if len(hashes) < WINDOW + SPREAD - 1:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        pairs = mixed(hashes[:-1] * np.uint64(0x100000001B3) + hashes[1:])
        # windows must lie in the text: only places up to its last one can be chosen
        places = pairs[:len(hashes) - WINDOW + 1]
        views = np.lib.stride_tricks.sliding_window_view(places, SPREAD)
        chosen = np.unique(np.arange(len(views)) + views.argmin(axis=1))
        return self.window_hashes(hashes, chosen), chosen.astype(np.int32)

    def window_hashes(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        words = hashes[starts[:, None] + np.arange(WINDOW)]
        return signed(mixed((words * self.powers).sum(axis=1, dtype=np.uint64)))

    def band_hashes(self, items: np.ndarray) -> np.ndarray:
        """Bands of one set of shingles."""
        low = np.full(len(self.factors), np.iinfo(np.uint64).max, np.uint64)
        for start in range(0, len(items), 4096):
            np.minimum(low, (self.factors * items[None, start:start + 4096]).min(axis=1), out=low)
        return signed(self.folded(low[:, None]))[0]

    def folded(self, low: np.ndarray) -> np.ndarray:
        """Bands of each column of minima."""
        out = np.arange(1, self.bands + 1, dtype=np.uint64)[:, None]
        for row in low.reshape(BAND_ROWS, self.bands, -1):
            out = mixed(out * np.uint64(0x100000001B3) + row)
        return out.T

    def paragraph_bands(self, paragraphs: list[np.ndarray]) -> np.ndarray:
        """Bands of the shingles of paragraphs, given as word hashes: paragraphs x bands."""
        out = np.zeros((len(paragraphs), self.bands), np.uint64)
        first, held = 0, 0
        for last, words in enumerate(paragraphs, 1):
            held += len(words)
            if held >= TOGETHER or last == len(paragraphs):
                out[first:last] = self.bands_together(paragraphs[first:last])
                first, held = last, 0
        return signed(out)

    def bands_together(self, paragraphs: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(p) for p in paragraphs])
        ends = np.cumsum(sizes)
        # shingles over a border between two paragraphs fall into the odd parts
        items = np.append(shingles(np.concatenate(paragraphs), SHINGLE), np.uint64(0))
        parts = np.stack([ends - sizes, ends - SHINGLE + 1], axis=1).ravel()
        return self.folded(np.stack([np.minimum.reduceat(items * f, parts)[::2] for f in self.factors[:, 0]]))


def piece_of(hashes: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).astype(np.int64))


def marked(documents: DataFrame, bands: int) -> DataFrame:
    """Per document its paragraphs with their bands."""
    def make():
        passages = Passages(bands)

        def work(texts: list) -> list[pa.Array]:
            pieces, starts, stops, paragraphs, counts = [], [], [], [], [0]
            for text in texts:
                hashes, spans = passages.lines(text)
                for a, b in spans:
                    pieces.append(piece_of(hashes[a:b]))
                    starts.append(a)
                    stops.append(b)
                    paragraphs.append(hashes[a:b])
                counts.append(len(pieces))
            bounds = np.arange(len(pieces) + 1, dtype=np.int32) * np.int32(bands)
            flat = pa.StructArray.from_arrays(
                [pa.array(pieces, pa.int64()), pa.array(starts, pa.int32()), pa.array(stops, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(bounds), pa.array(passages.paragraph_bands(paragraphs).ravel()))],
                ["piece", "start", "stop", "bands"])
            return [pa.ListArray.from_arrays(pa.array(counts, pa.int32()), flat)]

        return work

    return per_text(documents, "text", make,
                    "lines array<struct<piece:bigint,start:int,stop:int,bands:array<bigint>>>")


def left_windows(documents: DataFrame) -> DataFrame:
    """Per document the windows of the text between its removed paragraphs (``held``: text and their spans)."""
    def make():
        passages = Passages(1)

        def work(held: list) -> list[pa.Array]:
            windows, starts, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [0]
            for row in held:
                found = 0
                hashes = passages.lines(row["text"])[0]
                for a, b in between(row["gone"], len(hashes)):
                    values, first = passages.windows(hashes[a:b])
                    windows.append(values)
                    starts.append(first + np.int32(a))
                    found += len(values)
                counts.append(counts[-1] + found)
            flat = pa.StructArray.from_arrays([pa.array(np.concatenate(windows)), pa.array(np.concatenate(starts))],
                                              ["piece", "start"])
            return [pa.ListArray.from_arrays(pa.array(counts, pa.int32()), flat)]

        return work

    return per_text(documents, "held", make, "windows array<struct<piece:bigint,start:int>>")


def between(gone: list[dict] | None, size: int) -> Iterator[tuple[int, int]]:
    """The spans of words that the given ones leave."""
    at = 0
    for span in sorted(gone or [], key=lambda s: s["start"]):
        if at < min(span["start"], size):
            yield at, min(span["start"], size)
        at = max(at, span["stop"])
    if at < size:
        yield at, size


def grown_end(own: np.ndarray, other: np.ndarray, at: int, places: np.ndarray, limit: int, step: int) -> int:
    """How far the words from ``at`` on are equal to those from the best of ``places`` on; ``step`` is 1 or -1."""
    done = at
    while done != limit:
        further = places + (done - at)
        inside = (further >= 0) & (further < len(other))
        places = places[inside][other[further[inside]] == own[done]]
        if not len(places):
            break
        done += step
    return done


def grown(hits: DataFrame, held: DataFrame) -> DataFrame:
    """``doc_id, start, stop, kept_in``: hits grown to the whole runs that both documents share.

    Words of removed paragraphs end a run.  A run that reaches the window of the
    next hit in the same two documents is carried on by that hit.
    """
    pairs = hits.groupBy("doc_id", "kept_in").agg(F.sort_array(F.collect_set("start")).alias("starts"))
    rows = (pairs.join(held.withColumnRenamed("held", "own"), "doc_id")
            .join(held.select(F.col("doc_id").alias("kept_in"), F.col("held").alias("keeper")), "kept_in")
            .select("doc_id", "kept_in", "starts", "own", "keeper"))

    def run(batches):
        passages = Passages(1)

        def read(side: dict, mark: int) -> np.ndarray:
            hashes = passages.lines(side["text"])[0]
            for span in side["gone"] or []:
                hashes[span["start"]:span["stop"]] = mark
            return hashes

        last, kept, places = None, None, {}
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                doc, keeper, starts, own, side = (c[row].as_py() for c in batch.columns)
                if last is None or last != (keeper, side):
                    last, kept, places = (keeper, side), read(side, 1), {}
                    for a, b in between(side["gone"], len(kept)):
                        values, first = passages.windows(kept[a:b])
                        for value, place in zip(values.tolist(), (first.astype(np.int64) + a).tolist()):
                            places.setdefault(value, []).append(place)
                    places = {v: np.array(p) for v, p in places.items()}
                words = read(own, 0)
                # several texts of one id: the place may be that of another text
                inside = [s for s in starts if s + WINDOW <= len(words)]
                out += [(doc, s, s + WINDOW, keeper) for s in starts[len(inside):]]
                values = passages.window_hashes(words, np.array(inside, np.int64)).tolist()
                before = [0, *(s + WINDOW for s in inside)]
                after = [*inside[1:], len(words)]
                for k, (start, value) in enumerate(zip(inside, values)):
                    low, high = start, start + WINDOW
                    if value in places:
                        if before[k] < start:
                            low = grown_end(words, kept, start - 1, places[value] - 1, before[k] - 1, -1) + 1
                        if high < after[k]:
                            high = grown_end(words, kept, high, places[value] + WINDOW, after[k], 1)
                    out.append((doc, low, high, keeper))
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.int64()))],
                ["doc_id", "start", "stop", "kept_in"])

    return rows.mapInArrow(run, "doc_id bigint, start int, stop int, kept_in bigint")


def merge_spans(rows: DataFrame) -> DataFrame:
    """One row per run of overlapping or touching spans of a document."""
    grouped = rows.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "stop", "kept_in"))).alias("s"))

    def run(batches):
        for batch in batches:
            ids, out = [], []
            for row, spans in enumerate(batch.column(1).to_pylist()):
                runs: list[list[int]] = []
                for s in spans:
                    if runs and s["start"] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s["stop"])
                        runs[-1][2] = min(runs[-1][2], s["kept_in"])
                    else:
                        runs.append([s["start"], s["stop"], s["kept_in"]])
                ids += [row] * len(runs)
                out += runs
            columns = [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), *columns],
                                             ["doc_id", "start", "stop", "kept_in"])

    return grouped.mapInArrow(run, "doc_id bigint, start int, stop int, kept_in bigint")


def removals(documents: DataFrame) -> DataFrame:
    """``doc_id, start, stop, kept_in``: word spans to remove and the document that keeps the passage.

    Words are runs of anything but ASCII white space; ``stop`` is exclusive.
    A merged span names the smallest of its keeping documents.
    """
    shelf = Shelf(documents.sparkSession, "substring")
    bands = bands_for(PERCENT / 100, BAND_ROWS, MISS)
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    marks = shelf.keep(marked(texts.where("doc_id IS NOT NULL"), bands), "marks")

    lines = marks.select("doc_id", F.inline("lines"))
    classes = shelf.keep(lines.groupBy(F.col("piece").alias("id"))
                         .agg(F.min("doc_id").alias("lowest"), F.max("doc_id").alias("highest")), "classes")
    distinct = lines.select(F.col("piece").alias("id"), "bands").dropDuplicates(["id"])
    buckets = shelf.keep(distinct.select("id", F.explode("bands").alias("bucket"))
                         .dropDuplicates(["bucket", "id"]), "buckets")

    def sets_of(ids: DataFrame, count: int) -> DataFrame:
        holders = join_small(classes.select("id", "lowest"), ids, "id", "left_semi", count)
        holders = shelf.keep(holders.select(F.col("lowest").alias("doc_id")).distinct(), f"holders-{count}")

        def make():
            passages = Passages(1)

            def work(values: list) -> list[pa.Array]:
                out = []
                for text in values:
                    hashes, spans = passages.lines(text)
                    out.append([{"id": piece_of(hashes[a:b]),
                                 "items": np.sort(signed(np.unique(shingles(hashes[a:b], SHINGLE))))}
                                for a, b in spans])
                return [pa.array(out, pa.list_(pa.struct([("id", pa.int64()), ("items", pa.list_(pa.int64()))])))]

            return work

        found = per_text(join_small(texts, holders, "doc_id", "inner", holders.count()), "text", make,
                         "lines array<struct<id:bigint,items:array<bigint>>>").select(F.inline("lines"))
        return join_small(found, ids, "id", "left_semi", count).dropDuplicates(["id"])

    tree = components(similar_links(buckets, sets_of, PERCENT, shelf), shelf, "lines")
    shelf.drop("buckets")
    placed = (classes.join(tree, classes.id == tree.node, "left")
              .select("id", "lowest", "highest", F.coalesce("component", "id").alias("component")))
    placed = shelf.keep(placed, "placed-lines")
    groups = (placed.groupBy("component").agg(F.min("lowest").alias("kept_in"), F.max("highest").alias("last"))
              .where("last > kept_in").select("component", "kept_in"))
    repeated_lines = shelf.keep(placed.join(groups, "component").select(F.col("id").alias("piece"), "kept_in"),
                                "repeated-lines")
    of_lines = (join_small(lines.select("doc_id", "piece", "start", "stop"), repeated_lines, "piece", "inner",
                           repeated_lines.count())
                .where("doc_id != kept_in").select("doc_id", "start", "stop", "kept_in"))
    of_lines = shelf.keep(of_lines, "line-removals")
    for name in ("marks", "classes", "placed-lines", "repeated-lines"):
        shelf.drop(name)

    # windows only count where no paragraph is removed, so what keeps one is kept itself
    gone = shelf.keep(of_lines.groupBy("doc_id").agg(F.collect_set(F.struct("start", "stop")).alias("gone")), "gone")
    held = (texts.where("doc_id IS NOT NULL").join(gone, "doc_id", "left")
            .select("doc_id", F.struct("text", "gone").alias("held")))
    windows = shelf.keep(left_windows(held), "windows").select("doc_id", F.inline("windows"))
    repeated = shelf.keep(windows.groupBy("piece").agg(F.min("doc_id").alias("kept_in"), F.max("doc_id").alias("last"))
                          .where("last > kept_in").select("piece", "kept_in"), "repeated-windows")
    hits = join_small(windows, repeated, "piece", "inner", repeated.count()).where("doc_id != kept_in")
    hits = shelf.keep(hits.select("doc_id", "start", "kept_in"), "hits")
    for name in ("windows", "repeated-windows"):
        shelf.drop(name)
    of_windows = grown(hits, held)
    return shelf.keep(merge_spans(of_windows.union(of_lines)), "removals")


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without the given word spans; white space goes with the word before it."""
    data = text.encode("utf-8", "surrogatepass")
    places = [m.start() for m in WORD.finditer(data)] + [len(data)]
    out, at = [], 0
    for start, stop in sorted(spans):
        start, stop = min(start, len(places) - 1), min(stop, len(places) - 1)
        out.append(data[at:places[start]])
        at = max(at, places[stop])
    return b"".join([*out, data[at:]]).decode("utf-8", "surrogatepass")


def cut(documents: DataFrame, spans: DataFrame) -> DataFrame:
    """The documents without the spans, all columns kept and ``n_chars`` brought up to date.

    A document of which no word is left goes; one that had no words stays.
    """
    key, list_of, left = (fresh(documents, n) for n in ("_cut_id", "_spans", "_left"))
    grouped = spans.groupBy(F.col("doc_id").alias(key)).agg(
        F.collect_list(F.struct("start", "stop")).alias(list_of))
    whole = documents.join(F.broadcast(grouped) if spans.count() <= BROADCAST_ROWS else grouped,
                           F.col("doc_id") == F.col(key), "left").drop(key)
    pair = fresh(whole, "_pair")
    whole = whole.withColumn(pair, F.when(F.col(list_of).isNotNull(), F.struct("text", list_of))).drop(list_of)

    def make():
        def work(pairs: list) -> list[pa.Array]:
            return [pa.array([None if p is None else without(p["text"] or "", [(s["start"], s["stop"]) for s in
                                                                               p[list_of]]) for p in pairs], pa.string())]

        return work

    done = per_text(whole, pair, make, f"{left} string")
    new = {"text": F.coalesce(left, "text")}
    if "n_chars" in documents.columns:
        kind = dict(documents.dtypes)["n_chars"]
        new["n_chars"] = F.when(F.col(left).isNotNull(), F.length(left).cast(kind)).otherwise(F.col("n_chars"))
    return (done.where(F.col(left).isNull() | F.col(left).rlike(r"[^\x20\x09-\x0D]"))
            .withColumns(new).select(*documents.columns))
