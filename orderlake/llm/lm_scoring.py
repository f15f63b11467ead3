"""Language-model scores: a small causal self-attention model over subword ids.

A text is its words in lower case (A-Z only), each written in subword ids, then
an end id.  The model embeds the ids, lets each place attend to the places
before it in its window (with a learned bias per distance), and predicts the
class of the next id; the id within its class follows the corpus counts.  It is
trained in numpy: every partition takes Adam steps over its part of the training
documents, each of which is learnt from once, and the parameters are averaged,
weighted by tokens, once per round.  Texts are cut into overlapping windows; the last places
of a window are scored, the first ones are context, so each id is scored once,
with masked attention over many windows at a time.

Beside it stands a smoothed word unigram base score.  Word counts are exact over
all training documents: the most frequent words, a bounded number, are sent to
the workers, all others are joined by shuffle.

NULL texts are empty: only the end is scored.  Repeated rows get the same scores
each.  An empty table gives no row.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.corpus import (LONG_REMEMBERED, SLICE, Shelf, crc_class, fresh, folded_blocks, lasting_memory,
                                  per_partition, per_text, summed_blocks, words)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BEGIN, END = 49406, 49407

#: Places of a window, of which the last are scored.
PLACES, SCORED = 48, 32
EMBEDDED, KEYED, VALUED, CLASSES = 24, 8, 16, 32
#: Ids with an embedding of their own; all others have that of their class.
NAMED = 8192
#: The attention model learns from all training documents, dealt to so many rounds.
ROUNDS = 3
BATCH = 128
RATE = 0.02
#: Kinds of neighbours that ids are told apart by on either side, and parts their counts are summed in.
NEIGHBOURS = 96
CELL_BLOCKS = 64
#: Words sent to the workers at most; the others are joined by shuffle.
SENT_WORDS = 400_000
#: Distinct words a task counts before it passes them on.
COUNTED = 400_000
BLOCKS = 16
#: Members of a class at most, the last of them for all its rare ids.
MEMBERS = 64
END_WORD = b" "
#: Name of the workers' memory of subword ids, which lasts while texts are written in them.
MEMORY = "subwords"


def key_of(word: bytes) -> bytes:
    """The word itself, or for very long ones a blank and a digest; words hold no blanks."""
    return word if len(word) <= 40 else b" " + xxhash.xxh3_128_digest(word)


#: Marks that never share a piece with a letter before them; those of contractions and special tokens are not among them.
MARKS = b"!#$%*+,-./:;=?@^_~"
#: Lower-case letters that normalizing leaves as they are: Latin ones, which are the same in all versions of Unicode.
LATIN_BELOW = 0x250
#: The characters that byte-level merges write the bytes as, by the Latin-1 characters of these.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARACTERS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}


def is_plain(lower: str) -> bool:
    """True for runs of lower-cased letters that a tokenizer neither changes nor splits before its merges."""
    return lower.isalpha() and ord(max(lower)) < LATIN_BELOW


class SubwordIds(dict):
    """Ids of a word as bytes; frequent words are encoded once per worker.

    Runs of plain letters go to the tokenizer's merges directly, if that gives the same ids, and marks at the end of a
    word are looked up by themselves.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        added = any(a.content.isalpha() for a in self.tokenizer.get_added_tokens_decoder().values())
        probes = ("a", "zq", "the", "letters", "x" * 40, "\u00e9", "\u00f1and\u00fa", "stra\u00dfe", "\u0159\u0142o")
        self.direct = not added and all(self.merged(w.encode()) == self.encoded(w) for w in probes)

    def merged(self, word: bytes) -> list[int]:
        return [token.id for token in self.merges.tokenize(word.decode("latin-1").translate(BYTE_CHARACTERS))]

    def encoded(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def __missing__(self, word: bytes) -> bytes:
        head = word.rstrip(MARKS)
        if len(head) < len(word) and head[-1:].isalpha():
            ids = self[head] + self[word[len(head):]]
        else:
            text = word.decode("utf-8", "replace")
            lower = text.lower()
            found = self.merged(lower.encode()) if self.direct and is_plain(lower) else self.encoded(text)
            ids = np.array(found, "<u2").tobytes()
        if len(self) < LONG_REMEMBERED and len(word) <= 64:
            self[word] = ids
        return ids


_SUBWORDS: dict[str, SubwordIds] = {}
_SENT: dict[int, dict[bytes, float]] = {}


def subwords(path: str = TOKENIZER) -> SubwordIds:
    if path not in _SUBWORDS:
        _SUBWORDS[path] = SubwordIds(path)
        lasting_memory(MEMORY, _SUBWORDS[path])
    return _SUBWORDS[path]


# --- word counts ------------------------------------------------------------------

def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n`` over all rows; the end of every text is the word of one blank."""
    schema = "word binary, n bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def passed_on() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array([key_of(w) for w in counts], pa.binary()),
                                                pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for text in batch.column(0):
                counts.update(words(text.as_py()))
                counts[END_WORD] += 1
                if len(counts) > COUNTED:
                    yield passed_on()
        yield passed_on()

    return texts.select("text").mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"))


def sent_threshold(counts: DataFrame, most: int) -> int:
    """Smallest count from which on there are at most ``most`` words, by eighths of powers of two."""
    steps = (counts.groupBy(F.floor(F.log2("n") * 8).cast("int").alias("step")).agg(
        F.count(F.lit(1)).alias("words"), F.min("n").alias("least")).orderBy(F.desc("step")).collect())
    total, least = 0, 1 << 62
    for step in steps:
        total += step.words
        if total > most:
            break
        least = step.least
    return least


# --- the model --------------------------------------------------------------------

class Model(NamedTuple):
    """Parameters; their size does not depend on the corpus."""

    row_of: np.ndarray      # id -> embedding row
    class_of: np.ndarray    # id -> class
    member_of: np.ndarray   # id -> member of its class
    within: np.ndarray      # id -> natural log of its share of its member's counts
    sizes: np.ndarray       # class -> number of members
    table: np.ndarray       # embedding rows
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    distance: np.ndarray    # bias per distance
    classes: np.ndarray     # state -> class levels
    plain: np.ndarray
    members: np.ndarray     # class, state -> member levels
    members_plain: np.ndarray


LEARNED = Model._fields[5:]
STATE = EMBEDDED + VALUED
_BACK = (np.arange(PLACES - SCORED, PLACES)[:, None] - np.arange(PLACES)[None, :])
_HIDDEN = _BACK < 0
_BACK = np.maximum(_BACK, 0)


def windows(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Input windows, target ids and owners (-1: no target) of many texts given as ids.

    Each text begins with begin ids as context and ends with the end id.
    """
    lead = PLACES - SCORED
    arrays = [np.frombuffer(x, "<u2") for x in ids]
    blocks = np.array([-(-(len(a) + 1) // SCORED) for a in arrays], np.int64)
    sizes = lead + blocks * SCORED
    starts = np.cumsum(sizes) - sizes
    flat = np.full(int(sizes.sum()), BEGIN, np.int32)
    targets = np.full(len(flat) + 1, END, np.int32)
    owners = np.full(len(flat) + 1, -1, np.int32)
    for k, (a, s) in enumerate(zip(arrays, starts)):
        at = s + lead
        flat[at + 1:at + 1 + len(a)] = a
        targets[at:at + len(a)] = a
        owners[at:at + len(a) + 1] = k
    first = np.repeat(starts, blocks) + SCORED * (np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks))
    scored = first[:, None] + np.arange(lead, PLACES)
    return flat[first[:, None] + np.arange(PLACES)], targets[scored], owners[scored]


def distance_bias(distance: np.ndarray) -> np.ndarray:
    return np.where(_HIDDEN, np.float32(-30), distance[_BACK]).astype(np.float32)


def by_class(classes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each class that occurs and the places where it does."""
    classes = classes.astype(np.uint8)  # so small that they are sorted by counting
    order = np.argsort(classes, kind="stable")
    bounds = np.append(0, np.cumsum(np.bincount(classes, minlength=CLASSES)))
    for c in range(CLASSES):
        if bounds[c] < bounds[c + 1]:
            yield c, order[bounds[c]:bounds[c + 1]]


class Scorer:
    """Natural log probabilities with everything that only depends on an id worked out once."""

    def __init__(self, model: Model):
        self.model = model
        self.queries, self.keys, self.values = (model.table @ m for m in (model.query, model.key, model.value))
        self.bias = distance_bias(model.distance)
        longest = [np.linalg.norm(m, axis=1).max() for m in (self.queries, self.keys)]
        # weights that cannot leave the range of exp need no clipping
        self.tame = longest[0] * longest[1] + np.abs(model.distance).max() < 60

    def texts(self, ids: list[bytes]) -> np.ndarray:
        total = np.zeros(len(ids))
        for start in range(0, len(ids), 64):
            part = ids[start:start + 64]
            given, targets, owners = windows(part)
            for w in range(0, len(given), 512):
                logs = self.logs(given[w:w + 512], targets[w:w + 512])
                owner = owners[w:w + 512].ravel()
                own = owner >= 0
                total[start:start + len(part)] += np.bincount(owner[own], logs[own], len(part))
        return total

    def logs(self, given: np.ndarray, targets: np.ndarray) -> np.ndarray:
        model = self.model
        rows = model.row_of[given]
        last = rows[:, PLACES - SCORED:]
        weights = np.matmul(self.queries[last], self.keys[rows].transpose(0, 2, 1))
        weights += self.bias
        if not self.tame:
            np.clip(weights, -60, 60, out=weights)
        np.exp(weights, out=weights)
        mixed = np.matmul(weights, self.values[rows])
        mixed /= weights.sum(axis=2)[:, :, None]
        goal = targets.ravel()
        state = np.empty((len(goal), STATE), np.float32)
        state[:, :EMBEDDED] = model.table[last.ravel()]
        state[:, EMBEDDED:] = mixed.reshape(-1, VALUED)
        classes, members = model.class_of[goal], model.member_of[goal]
        out = model.within[goal] + log_share(state @ model.classes + model.plain, classes)
        for c, at in by_class(classes):
            n = model.sizes[c]
            if n > 1:
                out[at] += log_share(state[at] @ model.members[c][:, :n] + model.members_plain[c][:n], members[at])
        return out


def log_share(levels: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """Natural log of the softmax at the goals; the levels are used up."""
    np.clip(levels, -60, 60, out=levels)
    reached = levels[np.arange(len(goal)), goal]
    np.exp(levels, out=levels)
    return reached - np.log(levels.sum(axis=1))


def softmax_slope(levels: np.ndarray, goal: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Slope of the weighted loss by the levels."""
    levels -= levels.max(axis=1, keepdims=True)
    np.exp(levels, out=levels)
    levels /= levels.sum(axis=1, keepdims=True)
    levels[np.arange(len(goal)), goal] -= 1
    levels *= weight[:, None]
    return levels


def slopes(model: Model, given: np.ndarray, targets: np.ndarray, use: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean loss over the used places of a batch of windows."""
    lead = PLACES - SCORED
    rows = model.row_of[given]
    e = model.table[rows]
    x = e[:, lead:]
    q, k, v = x @ model.query, e @ model.key, e @ model.value
    weights = np.matmul(q, k.transpose(0, 2, 1)) + distance_bias(model.distance)
    weights -= weights.max(axis=2, keepdims=True)
    np.exp(weights, out=weights)
    weights /= weights.sum(axis=2, keepdims=True)
    mixed = np.matmul(weights, v)
    state = np.concatenate([x, mixed], axis=2).reshape(-1, STATE)
    goal = targets.ravel()
    classes, members = model.class_of[goal], model.member_of[goal]
    share = (use.ravel() / max(1, use.sum())).astype(np.float32)
    levels = softmax_slope(state @ model.classes + model.plain, classes, share)
    d_state = levels @ model.classes.T
    out = {"classes": state.T @ levels, "plain": levels.sum(axis=0),
           "members": np.zeros_like(model.members), "members_plain": np.zeros_like(model.members_plain)}
    for c, at in by_class(classes):
        n = model.sizes[c]
        if n > 1:
            inner = softmax_slope(state[at] @ model.members[c][:, :n] + model.members_plain[c][:n], members[at], share[at])
            out["members"][c][:, :n] = state[at].T @ inner
            out["members_plain"][c][:n] = inner.sum(axis=0)
            d_state[at] += inner @ model.members[c][:, :n].T
    d_state = d_state.reshape(len(given), SCORED, STATE)
    d_mixed = np.ascontiguousarray(d_state[:, :, EMBEDDED:])
    d_weights = np.matmul(d_mixed, v.transpose(0, 2, 1))
    d_scores = weights * (d_weights - (d_weights * weights).sum(axis=2, keepdims=True))
    d_q, d_k = np.matmul(d_scores, k), np.matmul(d_scores.transpose(0, 2, 1), q)
    d_v = np.matmul(weights.transpose(0, 2, 1), d_mixed)
    d_e = d_k @ model.key.T + d_v @ model.value.T
    d_e[:, lead:] += d_q @ model.query.T + d_state[:, :, :EMBEDDED]
    table = np.zeros_like(model.table)
    order = np.argsort(rows.ravel(), kind="stable")
    sorted_rows = rows.ravel()[order]
    begins = np.flatnonzero(np.append(True, sorted_rows[1:] != sorted_rows[:-1]))
    table[sorted_rows[begins]] = np.add.reduceat(d_e.reshape(-1, EMBEDDED)[order], begins, axis=0)
    back = np.where(_HIDDEN, 0, d_scores.sum(axis=0))

    def outer(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a.reshape(-1, a.shape[2]).T @ b.reshape(-1, b.shape[2])

    return out | {"table": table, "query": outer(x, d_q), "key": outer(e, d_k), "value": outer(e, d_v),
                  "distance": np.bincount(_BACK.ravel(), back.ravel(), PLACES).astype(np.float32)}


def trained(model: Model, ids: Iterator[list[bytes]], rate: float) -> tuple[Model, int]:
    """Adam steps over the windows of all given texts, and the number of ids learnt from."""
    params = {n: getattr(model, n).copy() for n in LEARNED}
    first = {n: np.zeros_like(p) for n, p in params.items()}
    second = {n: np.zeros_like(p) for n, p in params.items()}
    step, seen = 0, 0
    draw = np.random.default_rng(1)
    for texts in ids:
        given, targets, owners = windows(texts)
        order = draw.permutation(len(given))
        for start in range(0, len(order), BATCH):
            pick = order[start:start + BATCH]
            use = owners[pick] >= 0
            step += 1
            seen += int(use.sum())
            part = len(pick) / BATCH
            for name, slope in slopes(model._replace(**params), given[pick], targets[pick], use).items():
                first[name] += 0.1 * (slope - first[name])
                second[name] += 0.02 * (slope * slope - second[name])
                move = (first[name] / (1 - 0.9 ** step)) / (np.sqrt(second[name] / (1 - 0.98 ** step)) + 1e-7)
                params[name] -= np.float32(rate * part) * move
    return model._replace(**params), seen


def count_neighbours(total: np.ndarray, texts: list[np.ndarray], seed: int = 3) -> None:
    """Add to ``total`` (id, kind of neighbour before and after) what the ids of some texts have beside them."""
    bucket = np.random.default_rng(seed).integers(0, NEIGHBOURS, len(total))
    flat = np.concatenate([x for ids in texts for x in ([BEGIN], ids, [END])]).astype(np.int64)
    left, right = flat[:-1], flat[1:]
    inside = np.ones(len(left), bool)
    inside[np.cumsum([len(ids) + 2 for ids in texts])[:-1] - 1] = False
    left, right = left[inside], right[inside]
    cells, width = total.reshape(-1), total.shape[1]
    np.add.at(cells, right * width + bucket[left], 1)
    np.add.at(cells, left * width + NEIGHBOURS + bucket[right], 1)


def fresh_model(id_counts: np.ndarray, sample: list[np.ndarray], seed: int = 3) -> Model:
    """A model whose classes come from the given texts, see ``classed_model``."""
    total = np.zeros((len(id_counts), 2 * NEIGHBOURS), np.int64)
    if sample:
        count_neighbours(total, sample)
    return classed_model(id_counts, total, seed)


def classed_model(id_counts: np.ndarray, neighbours: np.ndarray, seed: int = 3) -> Model:
    """Classes from the neighbours of ids, counts within classes, random parameters."""
    size = len(id_counts)
    draw = np.random.default_rng(seed)
    context = neighbours.astype(np.float32)
    weight = neighbours.sum(axis=1).astype(np.float32)
    profile = np.sqrt((context + 0.02) / (weight + 0.02 * 2 * NEIGHBOURS)[:, None])
    heavy = np.argsort(-weight, kind="stable")[:2048]
    heavy = heavy[weight[heavy] > 0]
    class_of = np.zeros(size, np.int64)
    if len(heavy):
        # the most frequent ids begin as classes of their own
        centres = profile[heavy[:CLASSES]].copy()
        for _ in range(12):
            near = (profile[heavy] @ centres.T - (centres ** 2).sum(axis=1) / 2).argmax(axis=1)
            for c in range(len(centres)):
                mine = heavy[near == c]
                if len(mine):
                    centres[c] = np.average(profile[mine], axis=0, weights=np.sqrt(weight[mine]))
        class_of = (profile @ centres.T - (centres ** 2).sum(axis=1) / 2).argmax(axis=1)
    smoothed = id_counts + 0.1
    member_of, sizes = np.zeros(size, np.int64), np.ones(CLASSES, np.int64)
    shares = np.zeros((CLASSES, MEMBERS))
    for c in range(CLASSES):
        ids = np.flatnonzero(class_of == c)
        ids = ids[np.argsort(-id_counts[ids], kind="stable")]
        member_of[ids] = np.minimum(np.arange(len(ids)), MEMBERS - 1)
        sizes[c] = max(1, min(MEMBERS, len(ids)))
        shares[c] = np.bincount(member_of[ids], smoothed[ids], MEMBERS)
    totals = shares.sum(axis=1)
    named = np.argsort(-id_counts, kind="stable")[:min(NAMED, size)]
    row_of = NAMED + class_of
    row_of[named] = np.arange(len(named))
    shapes = {"table": (NAMED + CLASSES, EMBEDDED), "query": (EMBEDDED, KEYED), "key": (EMBEDDED, KEYED),
              "value": (EMBEDDED, VALUED), "classes": (STATE, CLASSES), "members": (CLASSES, STATE, MEMBERS)}
    spread = {"table": 0.3, "classes": 0.1, "members": 0.1}
    parts = {n: (draw.normal(size=s) * spread.get(n, s[0] ** -0.5)).astype(np.float32) for n, s in shapes.items()}
    return Model(row_of.astype(np.int32), class_of.astype(np.int32), member_of.astype(np.int32),
                 np.log(smoothed / shares[class_of, member_of]), sizes, distance=np.zeros(PLACES, np.float32),
                 plain=np.log(totals / totals.sum() + 1e-9).astype(np.float32),
                 members_plain=np.log((shares + 1e-3) / (totals[:, None] + 1e-3)).astype(np.float32), **parts)


# --- on Spark ---------------------------------------------------------------------

def id_counts(counts: DataFrame, tokenizer: str) -> np.ndarray:
    """Count of every subword id over all training words."""
    size = max(END + 1, subwords(tokenizer).tokenizer.get_vocab_size())

    def counted(batches: Iterator[pa.RecordBatch]) -> dict[str, list]:
        ids, total = subwords(tokenizer), np.zeros(size, np.int64)
        for batch in batches:
            found, times = [np.zeros(0, "<u2")], [0]
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if word[:1] != b" ":
                    found.append(np.frombuffer(ids[word], "<u2"))
                    times.append(n)
                elif word == END_WORD:
                    total[END] += n
            weights = np.repeat(np.array(times, np.int64), list(map(len, found)))
            total += np.bincount(np.concatenate(found), weights, size).astype(np.int64)
        return {"block": [0], "value": [total.tobytes()]}

    rows = summed_blocks(per_partition(counts.select("word", "n"), counted, "block int, value binary"), "<i8").collect()
    return np.frombuffer(rows[0].value, "<i8") if rows else np.zeros(size, np.int64)


def neighbour_counts(lessons: DataFrame, size: int) -> np.ndarray:
    """``count_neighbours`` over all rows; tasks pass on the cells they met, only the sums reach the driver."""
    cells = size * 2 * NEIGHBOURS
    bounds = np.linspace(0, cells, CELL_BLOCKS + 1).astype(np.int64)

    def counted(batches: Iterator[pa.RecordBatch]) -> dict[str, list]:
        total = np.zeros((size, 2 * NEIGHBOURS), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                texts = batch.column(0).slice(start, SLICE).to_pylist()
                count_neighbours(total, [np.frombuffer(x, "<u2") for x in texts])
        met = np.flatnonzero(total)
        times, at = total.reshape(-1)[met], np.searchsorted(met, bounds)
        parts = [(k, a, b) for k, (a, b) in enumerate(zip(at[:-1], at[1:])) if a < b]
        return {"block": [k for k, _, _ in parts],
                "value": [np.stack([met[a:b], times[a:b]]).astype("<i8").tobytes() for _, a, b in parts]}

    def add(block: int, out: np.ndarray | None, value: bytes) -> np.ndarray:
        met, times = np.frombuffer(value, "<i8").reshape(2, -1)
        if out is None:
            out = np.zeros(bounds[block + 1] - bounds[block], "<i8")
        out[met - bounds[block]] += times  # a task names each cell once
        return out

    rows = folded_blocks(per_partition(lessons.select("ids"), counted, "block int, value binary"), add).toArrow()
    total = np.zeros(cells, np.int64)
    for block, value in zip(rows.column("block").to_pylist(), rows.column("value")):
        total[bounds[block]:bounds[block + 1]] = np.frombuffer(value.as_py(), "<i8")
    return total.reshape(size, 2 * NEIGHBOURS)


def fit(lessons: DataFrame, counts: DataFrame, tokenizer: str = TOKENIZER) -> Model:
    """The attention model; ``lessons`` are the training documents as ``doc_id, ids``, ``counts`` their word counts."""
    of_ids = id_counts(counts, tokenizer)
    neighbours = neighbour_counts(lessons, len(of_ids))
    model = classed_model(of_ids, neighbours)
    for turn in range(ROUNDS if neighbours.any() else 0):
        model = _round(lessons.where(F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(ROUNDS)) == turn), model,
                       RATE * (1 - turn / ROUNDS))
    return model


def _round(lessons: DataFrame, model: Model, rate: float) -> Model:
    """Train on every partition from the same start and average the results by tokens."""
    def learnt(batches: Iterator[pa.RecordBatch]) -> dict[str, list]:
        def groups() -> Iterator[list[bytes]]:
            for batch in batches:
                for start in range(0, batch.num_rows, 100):
                    yield batch.column(0).slice(start, 100).to_pylist()

        better, seen = trained(model, groups(), rate)
        flat = np.concatenate([getattr(better, n).ravel() for n in LEARNED] + [np.ones(1)]).astype("<f8") * seen
        return {"block": list(range(BLOCKS)), "value": [b.tobytes() for b in np.array_split(flat, BLOCKS)]}

    rows = summed_blocks(per_partition(lessons.select("ids"), learnt, "block int, value binary"), "<f8").collect()
    flat = np.concatenate([np.frombuffer(r.value, "<f8") for r in sorted(rows, key=lambda r: r.block)]) if rows else [0.0]
    if not flat[-1]:
        return model
    flat, new, at = flat / flat[-1], {}, 0
    for name in LEARNED:
        old = getattr(model, name)
        new[name] = flat[at:at + old.size].reshape(old.shape).astype(np.float32)
        at += old.size
    return model._replace(**new)


def scores(documents: DataFrame, modulus: int = 7, held_out: int = 2, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every document."""
    spark = documents.sparkSession
    shelf = Shelf(spark, "scores")
    texts = documents.select("doc_id", "text")
    is_training = crc_class("doc_id", modulus) != held_out
    counts = shelf.keep(word_counts(texts.where(is_training)).select("word", "n"), "counts")
    all_tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    least = sent_threshold(counts, SENT_WORDS)
    is_sent = ((F.col("n") >= least) & (F.substring("word", 1, 1) != F.lit(b" "))) | (F.col("word") == F.lit(END_WORD))
    sent = counts.where(is_sent).toArrow()
    packed = spark.sparkContext.broadcast((sent.column(0).to_pylist(), np.log10(sent.column(1).to_numpy() + 1.0)))

    def coded():
        ids = subwords(tokenizer)
        names, values = packed.value
        known = Known(zip(names, values.tolist()))
        ends = known[END_WORD]

        def work(values: list) -> list[pa.Array]:
            tokens = [words(t) for t in values]
            sums, found, rare = [], [], []
            for t in tokens:
                of_words = np.fromiter(map(known.__getitem__, t), np.float64, len(t))
                sure = of_words >= 0
                sums.append(float(of_words[sure].sum() + max(0.0, ends)))
                found.append(int(sure.sum()) + (ends >= 0))
                others = Counter(t[i] for i in np.flatnonzero(~sure).tolist())
                rare.append([{"word": key_of(w), "times": n} for w, n in others.items()])
            return [pa.array([len(t) + 1 for t in tokens], pa.int64()), pa.array(found, pa.int64()),
                    pa.array(sums, pa.float64()),
                    pa.array([b"".join(map(ids.__getitem__, t)) for t in tokens], pa.binary()),
                    pa.array(rare, pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())])))]

        return work

    # texts are written in subword ids once, for the training and the scoring
    row = fresh(texts, "_row")
    in_ids = shelf.keep(per_text(texts.withColumn(row, F.monotonically_increasing_id()), "text", coded,
                                     "n_tokens bigint, sure bigint, logs double, ids binary, "
                                     "rare array<struct<word:binary,times:bigint>>", memory=MEMORY), "coded")
    model = fit(in_ids.where(is_training).select("doc_id", "ids"), counts, tokenizer)
    learnt = spark.sparkContext.broadcast(model)

    def scored():
        scorer = Scorer(learnt.value)
        return lambda ids: [pa.array(scorer.texts(ids) / math.log(10), pa.float64())]

    done = shelf.keep(per_text(in_ids.drop("rare"), "ids", scored, "score double"), "scored")
    # a word that was never counted adds log10(0 + 1) = 0, so only matches matter
    rare = (in_ids.select(row, F.inline("rare")).join(counts.where(~is_sent), "word").groupBy(row)
            .agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_logs"), F.sum("times").alias("rare_known")))
    nothing = F.lit(0)
    return (done.join(rare, row, "left")
            .select("doc_id", (crc_class("doc_id", modulus) == held_out).alias("held_out"), "n_tokens",
                    (F.col("sure") + F.coalesce("rare_known", nothing)).alias("n_known"),
                    F.lit(all_tokens).cast("bigint").alias("train_tokens"),
                    (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
                     - F.col("n_tokens") * F.lit(math.log10(all_tokens + distinct + 1))).alias("base_score"), "score"))


class Known(dict):
    """log10(count + 1) of the sent words; -1 for all others."""

    def __missing__(self, word: bytes) -> float:
        return -1.0
