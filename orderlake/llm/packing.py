"""Concatenate and cut: documents in one long token stream, cut into fixed windows.

Pass one tokenizes each text once, ends it with the end id and keeps the ids
with the running total inside its partition.  The partition totals (one row per
partition) are summed up to global offsets.  Pass two cuts every document at the
window borders its own offset gives, so no document waits for another and every
window but the last is full.

NULL and empty texts are one end id.  Repeated documents are packed each time.
An empty table gives no piece.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.llm.corpus import LONG_REMEMBERED, SLICE, Shelf, free_memories, lasting_memory

WINDOW = 2048
END_ID = 1
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

#: Python splits texts at these too, tokenizers don't.
SEPARATORS = re.compile("[\x1c-\x1f]")


def stays_letter(character: str) -> bool:
    """True if normalizing and lower-casing leave one letter, so that no mark joins what follows."""
    plain = unicodedata.normalize("NFC", character).lower()
    return len(plain) == 1 and plain.isalpha()


class WordIds(dict):
    """Ids of one run of non-space characters, as bytes; frequent runs are encoded once per worker."""

    def __init__(self, encode: Callable[[str], list[int]], kind: str, letters: Callable[[str], list[int]] | None = None):
        super().__init__()
        self.encode, self.kind, self.letters = encode, kind, letters or encode

    def __missing__(self, run: str) -> bytes:
        if run[-1] in ",." and len(run) > 1 and stays_letter(run[-2]):
            ids = self[run[:-1]] + self[run[-1]]
        elif run.isascii() and run != run.lower() and run.isalpha():
            ids = self[run.lower()]
        else:
            found = self.letters(run) if run.isascii() and run.isalpha() else self.encode(run)
            ids = np.array(found, self.kind).tobytes()
        if len(self) < LONG_REMEMBERED and len(run) <= 64:
            self[run] = ids
        return ids


class TextEncoder:
    """Ids of whole texts by a tokenizer file.

    A tokenizer that drops white space before its merges gives the ids of a text
    as those of its runs in order; any other encodes the whole text at once.  Runs
    of lower-case ASCII letters, which no normalizing or splitting touches, go to
    the tokenizer's merges directly, if that gives the same ids.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        self.kind = "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        probe = ("Ab, cd.", "x\n\t y's 12", "é. Ö,o  z")
        self.by_runs = all(self.encode(p) == [i for r in p.split() for i in self.encode(r)] for p in probe)
        model = tokenizer.model
        letters = lambda word: [token.id for token in model.tokenize(word)]
        added = any(a.content.isascii() and a.content.isalpha() for a in tokenizer.get_added_tokens_decoder().values())
        plain = not added and all(self.encode(w) == letters(w) for w in ("a", "zq", "the", "letters", "x" * 40))
        self.runs = WordIds(self.encode, self.kind, letters if plain else None)

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.by_runs and not SEPARATORS.search(text):
            return b"".join(map(self.runs.__getitem__, text.split()))
        return np.array(self.encode(text), self.kind).tobytes()


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
        lasting_memory(path, _ENCODERS[path].runs)
    return _ENCODERS[path]


def tokenized(documents: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Per document its ids, the partition it was read in and the partition's tokens before it."""
    rows = documents.select("doc_id", "text")
    schema = T.StructType([rows.schema["doc_id"], T.StructField("part", T.IntegerType()),
                           T.StructField("before", T.LongType()), T.StructField("n_ids", T.LongType()),
                           T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_memories(tokenizer)
        encode, part, before = encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], encode.kind).tobytes()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                ids = [encode.ids(t) + end for t in batch.column(1).slice(start, SLICE).to_pylist()]
                sizes = np.array([len(b) // len(end) for b in ids], np.int64)
                ends = before + np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, SLICE), pa.array(np.full(len(ids), part, np.int32)),
                     pa.array(ends - sizes), pa.array(sizes), pa.array(ids, pa.binary())], schema.names)
                before = int(ends[-1])

    return rows.mapInArrow(run, schema)


def pack(documents: DataFrame, window: int = WINDOW, tokenizer: str = TOKENIZER, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """One row per piece of a document in a sequence.

    Columns: ``doc_id``, ``start`` (the document's ids before the piece), ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence and
    ``sequence_tokens`` (the window, but for the last sequence); ``with_ids`` adds
    ``ids``, the piece's unsigned 32-bit little-endian ids.
    """
    spark = documents.sparkSession
    kind = encoder(tokenizer).kind
    kept = Shelf(spark, "packing").keep(tokenized(documents, tokenizer, end_id), "ids")
    # one row per partition of the first pass: their number, not their size, bounds this window
    totals = kept.groupBy("part").agg(F.sum("n_ids").alias("n"))
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"),
                            F.sum("n").over(everything).alias("total"))
    placed = (kept.join(F.broadcast(offsets), "part")
              .select("doc_id", (F.col("base") + F.col("before")).alias("at"), "total", "n_ids", "ids"))
    added = ("start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
             "offset bigint, sequence_tokens bigint" + (", ids binary" if with_ids else ""))
    schema = T.StructType([placed.schema["doc_id"], *T._parse_datatype_string(added).fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE):
                part = batch.slice(first, SLICE)
                rows, taken = [], []
                for row, (at, total, n, raw) in enumerate(zip(*(part.column(k).to_pylist() for k in range(1, 5)))):
                    ids = np.frombuffer(raw, kind).astype("<u4")
                    start = 0
                    while start < n:
                        sequence, offset = divmod(at + start, window)
                        length = min(window - offset, n - start)
                        piece = ids[start:start + length].tobytes()
                        full = min(window, total - sequence * window)
                        rows.append((start, length, zlib.crc32(piece), n, sequence, offset, full)
                                    + ((piece,) if with_ids else ()))
                        taken.append(row)
                        start += length
                columns = [pa.array(c, f.type) for c, f in
                           zip(zip(*rows), [pa.field("", pa.int64())] * 7 + [pa.field("", pa.binary())])]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(taken)), *columns], schema.names)

    return placed.mapInArrow(cut, schema)
