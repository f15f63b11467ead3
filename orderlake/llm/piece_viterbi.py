"""SentencePiece encoding and decoding with an Aho-Corasick automaton and one Viterbi pass.

The automaton holds all ordinary pieces of a model file.  One pass over a text
follows, at each character, the output links to all pieces that end there, and
relaxes the best total score up to that place.  A character that no piece covers
is written as its UTF-8 byte pieces (or the unknown id if the model has none).
The encoding is the one with the largest sum of piece scores; among equal sums
the longest last piece wins.  This is the unigram reading of the scores; models
trained by merges, whose scores are merge ranks, may be cut differently by their
own greedy encoder.

Where no piece has a space mark after another character, the best encoding of a
text is that of its space-led runs one by one, and frequent runs are remembered.

NULL texts have no ids, like empty ones; their score is 0.  Decoding inverts encoding exactly,
but for U+2581 in a text, which the format itself reads as a space.
"""

from __future__ import annotations

import re
import zlib

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from orderlake.llm.corpus import LONG_REMEMBERED, lasting_memory, per_text

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
RUN = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class Runs(dict):
    """(ids as bytes, score) of one space-led run, without its first space mark."""

    def __init__(self, codec: PieceCodec):
        super().__init__()
        self.codec = codec

    def __missing__(self, run: str) -> tuple[bytes, float]:
        ids, score = self.codec.best(SPACE + run)
        found = (np.array(ids, "<u4").tobytes(), score)
        if len(self) < LONG_REMEMBERED and len(run) <= 64:
            self[run] = found
        return found


class PieceCodec:
    """Encoder and decoder of one model file."""

    def __init__(self, model: str = MODEL):
        import sentencepiece

        loaded = sentencepiece.SentencePieceProcessor(model_file=model)
        size = loaded.get_piece_size()
        self.pieces = [loaded.id_to_piece(i) for i in range(size)]
        self.unknown = loaded.unk_id()
        self.bytes: dict[int, int] = {}
        self.scores = [loaded.get_score(i) for i in range(size)]
        ordinary = {}
        for i, piece in enumerate(self.pieces):
            if loaded.is_byte(i):
                self.bytes[i] = int(piece[3:5], 16)
            elif not (loaded.is_control(i) or loaded.is_unknown(i) or loaded.is_unused(i)):
                ordinary[piece] = i
        self.byte_ids = {value: i for i, value in self.bytes.items()}
        self.has_bytes = len(self.byte_ids) == 256
        self.uncovered = min((self.scores[i] for i in ordinary.values()), default=0.0) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, i in ordinary.items():
            self.automaton.add_word(piece, (len(piece), i, self.scores[i]))
        self.automaton.make_automaton()
        self.covered = {p for p in ordinary if len(p) == 1}
        self.by_runs = not any(SPACE in p.lstrip(SPACE) for p in ordinary)
        self.runs = Runs(self)

    def best(self, marked: str) -> tuple[list[int], float]:
        """Ids and score of the best segmentation of a text whose spaces are marks."""
        if not marked:
            return [], 0.0
        n = len(marked)
        best = [0.0] + [None] * n
        last: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        place = 0  # everything before it is settled

        def settle(upto: int) -> None:
            nonlocal place
            while place < upto:
                place += 1
                if marked[place - 1] not in self.covered:
                    score = best[place - 1] + self.uncovered
                    if best[place] is None or score > best[place]:
                        best[place], last[place] = score, (1, -1)

        for end, (length, piece, gain) in self.automaton.iter(marked):
            settle(end)
            score = best[end + 1 - length] + gain
            if best[end + 1] is None or score > best[end + 1]:
                best[end + 1], last[end + 1] = score, (length, piece)
        settle(n)
        cut, at = [], n
        while at:
            length, piece = last[at]
            cut.append((at - length, at, piece))
            at -= length
        ids: list[int] = []
        for start, end, piece in reversed(cut):
            if piece >= 0:
                ids.append(piece)
            elif self.has_bytes:
                ids.extend(self.byte_ids[b] for b in marked[start:end].encode("utf-8", "surrogatepass"))
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
        return ids, best[n]

    def encode(self, text: str | None) -> tuple[bytes, float]:
        """Ids as unsigned 32-bit little-endian numbers, and their total score."""
        if not text:
            return b"", 0.0
        if not self.by_runs:
            ids, score = self.best(SPACE + text.replace(" ", SPACE))
            return np.array(ids, "<u4").tobytes(), score
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            runs = [r[1:] for r in RUN.findall(SPACE + text.replace(" ", SPACE))]
        else:
            runs = text.split(" ")
        found = list(map(self.runs.__getitem__, runs))
        return b"".join([f[0] for f in found]), sum([f[1] for f in found])

    def decode(self, ids: bytes | list[int]) -> str:
        numbers = np.frombuffer(ids, "<u4").tolist() if isinstance(ids, bytes) else list(ids)
        return self.text_of(numbers)

    def text_of(self, ids: list[int]) -> str:
        if not hasattr(self, "spelled"):
            self.spelled = [bytes([self.bytes[i]]) if i in self.bytes
                            else p.replace(SPACE, " ").encode("utf-8", "surrogatepass")
                            for i, p in enumerate(self.pieces)]
        whole = b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")
        return whole[1:] if whole[:1] == " " else whole


_CODECS: dict[str, PieceCodec] = {}


def codec(model: str) -> PieceCodec:
    if model not in _CODECS:
        _CODECS[model] = PieceCodec(model)
        lasting_memory(model, _CODECS[model].runs)
    return _CODECS[model]


def encode_texts(rows: DataFrame, text: str = "text", model: str = MODEL) -> DataFrame:
    """The other columns, and ``piece_ids array<int>``, ``piece_score double`` in place of the text."""
    def make():
        pieces = codec(model)

        def work(texts: list) -> list[pa.Array]:
            found = [pieces.encode(t) for t in texts]
            return [pa.array([np.frombuffer(f[0], "<u4").astype(np.int32) for f in found], pa.list_(pa.int32())),
                    pa.array([f[1] for f in found], pa.float64())]

        return work

    return per_text(rows, text, make, "piece_ids array<int>, piece_score double", memory=model)


def decode_ids(rows: DataFrame, ids: str = "piece_ids", model: str = MODEL) -> DataFrame:
    """The other columns, and ``text`` in place of the ids; NULL ids give the empty text."""
    def make():
        pieces = codec(model)
        return lambda lists: [pa.array([pieces.decode(list(x or [])) for x in lists], pa.string())]

    return per_text(rows, ids, make, "text string", memory=model)


def coding_digest(documents: DataFrame, model: str = MODEL) -> DataFrame:
    """Per document: number and crc32 of its ids, their score, and whether decoding restores the text."""
    def make():
        pieces = codec(model)

        def work(texts: list) -> list[pa.Array]:
            found = [pieces.encode(t) for t in texts]
            same = [pieces.decode(f[0]) == (t or "").replace(SPACE, " ") for f, t in zip(found, texts)]
            return [pa.array([len(f[0]) // 4 for f in found], pa.int64()),
                    pa.array([zlib.crc32(f[0]) for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.float64()), pa.array(same, pa.bool_())]

        return work

    return per_text(documents.select("doc_id", "text"), "text", make,
                    "n_ids bigint, ids_crc32 bigint, score double, restored boolean", memory=model)
