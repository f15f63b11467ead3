"""Personal data: generators propose overlapping spans, boosted trees and calibrated thresholds select among them.

*Base spans* are exact: e-mail addresses, IPv4 addresses, card numbers and phone numbers by their patterns,
leftmost and without overlap inside a kind; matches with wrong parts or digits are dropped, without a retry.

*Candidates* come from generators of high recall: runs around ``@``, spelled-out addresses (``at``, ``dot``, in brackets or
not), digit groups with any common separators and their parts, dotted quads with bracketed dots.  Boosted trees
judge each candidate by its format and context.  They learn from the base spans of a bounded sample of documents,
from the same spans rewritten in place (spelled-out addresses, bracketed dots, other separators), and from rewritten spans
that are wrong on purpose (a broken check digit, a part of 300, a missing domain); every other candidate is a counterexample,
unless it is itself a spelled-out address or quad: nothing tells its label, so it is not learned from.
Scores of documents kept out of the fit are calibrated by pooling adjacent violators, and each kind's threshold
is the lowest calibrated score of at least one half that still holds the wanted precision there.  Candidates above it that overlap
nothing chosen before (base spans first, then by score) are added; base spans always stay.

Positions are code points, ends exclusive.  NULL texts count as empty and have no span; texts are read whole.  A repeated
row or id is judged each time.  Without a base span in the sample nothing is added.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.corpus import Shelf, fresh, per_text, share_of
from orderlake.llm.quality import isotonic

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

#: Documents that candidates are learned from, in expectation (a sample by id hash), and candidates at most.
MOST_DOCUMENTS = 40_000
MOST_CANDIDATES = 60_000
APART_SHARE = 0.3
PRECISION, LIKELY = 0.95, 0.5
TREES, DEPTH, RATE, BINS, LEAF_PENALTY = 40, 4, 0.2, 32, 1.0
#: Characters of context on either side.
AROUND = 48

# fixed values: the patterns of the base spans
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"(?<![0-9])[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]


def digits_of(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    """The check digit of card numbers."""
    doubled = [d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """``(start, end, kind)`` of all base spans, by start and kind.

    An address is found from its ``@``: what may stand before it is one run of local characters, so the leftmost
    match begins where that run does.  Runs of digits are entered at their first digit for the same reason.
    """
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            found.append((start, domain.end(), EMAIL))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in m.group().split(".")):
            found.append((m.start(), m.end(), IP))
    for m in _CARD.finditer(text):
        if 12 <= len(digits := digits_of(m.group())) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), CARD))
    for m in _PHONE.finditer(text):
        if 9 <= len(digits_of(m.group())) <= 15:
            found.append((m.start(), m.end(), PHONE))
    return sorted(found, key=lambda s: (s[0], s[2], s[1]))


# --- candidates --------------------------------------------------------------------

_AT = r"(?:\s?[\[({<]\s?(?:at|@)\s?[\])}>]\s?|\s(?:at|@)\s|@|＠)"
_DOT = r"(?:\s?[\[({<]\s?(?:dot|\.)\s?[\])}>]\s?|\sdot\s|\.)"
_SPELLED = re.compile(rf"(?<![\w.%+-])[\w.%+-]{{1,64}}{_AT}[\w-]{{1,63}}(?:{_DOT}[\w-]{{1,63}}){{1,6}}", re.IGNORECASE)
_HINT = re.compile(r"@|＠|[\s\[({<](?:at)[\s\])}>]", re.IGNORECASE)
_DOTTED = re.compile(r"[.\])}>\s]dot[\s\[({<]|\bdot\b|@|＠", re.IGNORECASE)
_AROUND_AT = re.compile(r"[^\s@<>\"'(),;:\[\]{}|]{1,64}@[^\s@<>\"'(),;:\[\]{}|]{1,255}")
_QUAD = re.compile(r"(?<![0-9])[0-9]{1,4}(?:(?:\s?[\[({]\s?(?:dot|\.)\s?[\])}]\s?|\.|,|\sdot\s)[0-9]{1,4}){3}(?![0-9])")
_NUMBER = re.compile(r"(?:\+|\(\+?|00)?[0-9](?:[\x20().\-/ ‐-—]{0,3}[0-9])+")
_PLAIN = re.compile(r"[0-9]{7,}")


def candidates(text: str) -> list[Span]:
    """Distinct spans that might be personal data, with the kind they might be; they may overlap."""
    found: set[Span] = set()
    if "@" in text:
        for m in _AROUND_AT.finditer(text):
            end = m.start() + len(m.group().rstrip(".!?-_/"))
            found.add((m.start(), end, EMAIL))
    if _HINT.search(text) and _DOTTED.search(text):
        for m in _SPELLED.finditer(text):
            found.add((m.start(), m.end(), EMAIL))
    for m in _QUAD.finditer(text):
        found.add((m.start(), m.end(), IP))
    for m in _NUMBER.finditer(text):
        n = len(digits_of(m.group())) if m.end() - m.start() >= 7 else 0
        if n < 7:
            continue
        spans = {(m.start(), m.end())}
        spans |= {(p.start(), p.end()) for p in _PLAIN.finditer(text, m.start(), m.end())}
        for start, end in spans:
            n = len(digits_of(text[start:end]))
            if 12 <= n <= 19:
                found.add((start, end, CARD))
            if 7 <= n <= 15:
                found.add((start, end, PHONE))
    return sorted(found)


# --- features ----------------------------------------------------------------------

#: Words that stand near personal data of a kind, and words that stand near other numbers.
NEAR = {EMAIL: "mail email e-mail contact write reach address correo courriel adresse kontakt".split(),
        IP: "ip address host server login client connection adresse".split(),
        CARD: "card visa mastercard amex credit debit payment account karte carte tarjeta".split(),
        PHONE: "phone tel telephone call mobile cell fax contact ring handy telefon portable".split()}
OTHER = ("version release isbn issn order invoice ticket id number serial date year page chapter section art no ref"
         " build rev item total sum hash token key").split()
_WORD = re.compile(r"[a-zà-ÿ-]+")
SEPARATORS = " -.()/+,[]"
N_FEATURES = 24 + len(SEPARATORS)


def features(text: str, span: Span) -> list[float]:
    """Format and context of one candidate."""
    start, end, kind = span
    body = text[start:end]
    before, after = text[max(0, start - AROUND):start], text[end:end + AROUND]
    digits = digits_of(body)
    groups = re.findall(r"[0-9]+", body)
    letters = sum(c.isalpha() for c in body)
    tail = re.split(r"[^A-Za-z0-9]+", body)[-1]
    near = _WORD.findall((before + " " + after).lower())
    wanted, other = NEAR[kind], OTHER
    parts = [int(g) if len(g) < 5 else 9999 for g in groups]
    return [
        kind, len(body), len(digits), letters, len(groups), min(map(len, groups), default=0),
        max(map(len, groups), default=0), len(set(digits)), float(luhn(digits)) if len(digits) > 11 else -1.0,
        max(parts, default=0) if kind == IP else -1, sum(g[0] == "0" and len(g) > 1 for g in groups),
        float(body[:1] == "+"), body.count("@"), len(tail) if kind == EMAIL else -1,
        float(tail.isalpha()) if kind == EMAIL else -1,
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in ("", "\n", " ", "\t")),
        float(before[-1:] in ('"', "'", "=", "#", "$", "/", "_", ".", "-")), float(after[:1] in ("", "\n", " ", ".", ",")),
        sum(w in wanted for w in near), sum(w in other for w in near),
        sum("0" <= c <= "9" for c in before), sum("0" <= c <= "9" for c in after),
        *[body.count(c) for c in SEPARATORS]]


# --- examples ------------------------------------------------------------------------

def rewritten(body: str, kind: int, turn: int) -> list[tuple[str, int]]:
    """Other ways of writing a base span (1), and near misses of it (0)."""
    if kind == EMAIL:
        name, _, domain = body.partition("@")
        at, dot = ((" at ", " dot "), ("[at]", "[dot]"), (" (at) ", " (dot) "), ("＠", "."))[turn % 4]
        return [(name + at + domain.replace(".", dot), 1), (f"{name}@{domain.split('.')[0]}", 0)]
    if kind == IP:
        parts = body.split(".")
        good = ("[.]", "(.)", " dot ", "[dot]")[turn % 4].join(parts)
        parts[turn % 4] = str(300 + turn % 600)
        return [(good, 1), (".".join(parts), 0)]
    numbers = "".join(map(str, digits_of(body)))
    if kind == CARD:
        apart = ("  ", ".", "/", " - ")[turn % 4]
        wrong = numbers[:-1] + str((int(numbers[-1]) + 1 + turn % 9) % 10)
        return [(apart.join(numbers[k:k + 4] for k in range(0, len(numbers), 4)), 1), (wrong, 0)]
    grouped = re.sub(r"[^0-9]+", ("-", ".", " ", "/")[turn % 4], body.lstrip("+"))
    return [(grouped, 1), ("00" + grouped, 1), (numbers, 0)]


_DISGUISED = re.compile(r"[\[({<＠]|\sdot\s", re.IGNORECASE)


def disguised(body: str, kind: int) -> bool:
    """Whether an address or quad is spelled out, so that nothing tells if it is personal data."""
    if kind not in (EMAIL, IP) or not _DISGUISED.search(body):
        return False
    straight = re.sub(_DOT, ".", re.sub(_AT, "@", body, flags=re.IGNORECASE), flags=re.IGNORECASE)
    return base_spans(straight) == [(0, len(straight), kind)]


def examples(text: str) -> list[tuple[int, list[float], int]]:
    """``(kind, features, label)`` of a text's candidates and of those in its rewritten spans."""
    base, out = base_spans(text), []
    known = set(base)
    for span in candidates(text):
        if span in known or not disguised(text[span[0]:span[1]], span[2]):
            out.append((span[2], features(text, span), int(span in known)))
    for start, end, kind in base:
        before, after = text[max(0, start - AROUND):start], text[end:end + AROUND]
        for body, label in rewritten(text[start:end], kind, start + end):
            changed, span = before + body + after, (len(before), len(before) + len(body), kind)
            for other in candidates(changed):
                if other[0] < span[1] and span[0] < other[1]:
                    out.append((other[2], features(changed, other), int(other == span and label)))
    return out


# --- boosted trees -------------------------------------------------------------------

class Trees(NamedTuple):
    """Complete trees of one depth: split features and bins in breadth-first order, then leaf values."""

    edges: list[np.ndarray]
    split: np.ndarray
    above: np.ndarray
    leaf: np.ndarray
    start: float

    def bins(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, rows[:, k], "left") for k, e in enumerate(self.edges)], 1)

    def margins(self, rows: np.ndarray) -> np.ndarray:
        binned, out = self.bins(rows), np.full(len(rows), self.start)
        at = np.arange(len(rows))
        for split, above, leaf in zip(self.split, self.above, self.leaf):
            node = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (binned[at, split[node]] > above[node])
            out += leaf[node - (2 ** DEPTH - 1)]
        return out


def boosted(rows: np.ndarray, labels: np.ndarray) -> Trees:
    """Second-order boosting of the logistic loss on binned features, a level of a tree at a time."""
    edges = [np.unique(np.quantile(rows[:, k], np.linspace(0, 1, BINS)[1:-1], method="lower")) for k in range(rows.shape[1])]
    share = np.clip(labels.mean(), 1e-6, 1 - 1e-6)
    inner, leaves = 2 ** DEPTH - 1, 2 ** DEPTH
    model = Trees(edges, np.zeros((TREES, inner), np.int64), np.full((TREES, inner), BINS), np.zeros((TREES, leaves)),
                  float(np.log(share / (1 - share))))
    binned, margin = model.bins(rows), np.full(len(rows), model.start)
    n_features = rows.shape[1]
    for tree in range(TREES):
        guess = 1 / (1 + np.exp(-margin))
        slope, bend = guess - labels, guess * (1 - guess)
        node = np.zeros(len(rows), np.int64)
        for level in range(DEPTH):
            first, wide = 2 ** level - 1, 2 ** level
            place = (node - first) * BINS
            sums = np.stack([[np.bincount(place + binned[:, k], w, wide * BINS).reshape(wide, BINS)
                              for k in range(n_features)] for w in (slope, bend)])
            left = sums.cumsum(-1)
            total = left[..., -1:]
            gain = (left[0] ** 2 / (left[1] + LEAF_PENALTY) + (total[0] - left[0]) ** 2 / (total[1] - left[1] + LEAF_PENALTY)
                    - total[0] ** 2 / (total[1] + LEAF_PENALTY))
            chosen = gain.transpose(1, 0, 2).reshape(wide, -1).argmax(1)
            model.split[tree, first:first + wide] = chosen // BINS
            model.above[tree, first:first + wide] = chosen % BINS
            node = 2 * node + 1 + (binned[np.arange(len(rows)), model.split[tree, node]] > model.above[tree, node])
        at = node - inner
        g, h = np.bincount(at, slope, leaves), np.bincount(at, bend, leaves)
        model.leaf[tree] = -RATE * g / (h + LEAF_PENALTY)
        margin += model.leaf[tree, at]
    return model


class Model(NamedTuple):
    """Trees, calibration and the least calibrated score of each kind (above 1: none is added)."""

    trees: Trees | None
    knots: np.ndarray
    levels: np.ndarray
    least: tuple[float, ...]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return np.interp(self.trees.margins(rows), self.knots, self.levels)

    def added(self, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
        """Spans beyond the base ones of each text."""
        out: list[list[Span]] = [[] for _ in texts]
        if self.trees is None:
            return out
        owners, spans, rows = [], [], []
        for k, text in enumerate(texts):
            taken = np.array([s[:2] for s in base[k]]).reshape(-1, 2)
            for span in candidates(text):
                if self.least[span[2]] <= 1 and not ((taken[:, 0] < span[1]) & (span[0] < taken[:, 1])).any():
                    owners.append(k)
                    spans.append(span)
                    rows.append(features(text, span))
        if not rows:
            return out
        scores = self.scores(np.array(rows, float))
        for i in np.lexsort(([s[0] for s in spans], -scores)):
            span, mine = spans[i], out[owners[i]]
            if scores[i] >= self.least[span[2]] and all(s[1] <= span[0] or span[1] <= s[0] for s in mine):
                mine.append(span)
        return out


NOTHING = Model(None, np.zeros(1), np.zeros(1), (2.0,) * 4)


def thresholds(kinds: np.ndarray, levels: np.ndarray, labels: np.ndarray, precision: float) -> tuple[float, ...]:
    """Per kind the least level, one half or more, from which on the labels hold the precision; above 1 where none does."""
    out = []
    for kind in range(len(KINDS)):
        mine = kinds == kind
        at, ones = levels[mine], labels[mine]
        good = [v for v in np.unique(at[at >= LIKELY]) if ones[at >= v].mean() >= precision]
        out.append(float(min(good)) if good else 2.0)
    return tuple(out)


def learn(kinds: np.ndarray, rows: np.ndarray, labels: np.ndarray, apart: np.ndarray, precision: float) -> Model:
    """Fit on the rows that are not ``apart``; calibrate and set the thresholds on those that are."""
    fit, kept = ~apart, apart
    if not (labels[fit] == 1).any() or not (labels[fit] == 0).any() or not (labels[kept] == 1).any():
        return NOTHING
    trees = boosted(rows[fit], labels[fit].astype(float))
    margin = trees.margins(rows[kept])
    order = np.argsort(margin, kind="stable")
    at, place = np.unique(margin[order], return_inverse=True)
    knots, levels = isotonic(at, np.bincount(place, labels[kept][order].astype(float)), np.bincount(place).astype(float))
    level = np.interp(margin, knots, levels)
    return Model(trees, knots, levels, thresholds(kinds[kept], level, labels[kept], precision))


def fit(documents: DataFrame, key: str = "doc_id", most_documents: int = MOST_DOCUMENTS,
        most: int = MOST_CANDIDATES, precision: float = PRECISION) -> Model:
    """Learn from the candidates of a bounded sample of documents; ``most`` rows of them reach the driver."""
    total = documents.count()
    chosen = documents.select(F.col(key).alias("doc"), "text")
    if total > most_documents:
        chosen = chosen.where(share_of("doc", most_documents / total, salt=13))

    def make():
        def work(texts):
            lists = [examples(t or "") for t in texts]
            return [pa.array([[{"kind": k, "row": row, "label": y} for k, row, y in found] for found in lists],
                             pa.list_(pa.struct([("kind", pa.int32()), ("row", pa.list_(pa.float64())),
                                                 ("label", pa.int32())])))]

        return work

    found = per_text(chosen, "text", make, "found array<struct<kind:int,row:array<double>,label:int>>")
    rows = found.select("doc", F.posexplode("found").alias("place", "one")).select(
        share_of("doc", APART_SHARE, salt=14).alias("apart"), F.xxhash64("doc", "place").alias("turn"), "one.*")
    sample = Shelf(documents.sparkSession, "personal").keep(rows, "examples")
    held = sample.orderBy("turn", "row").limit(most).toArrow()
    if not held.num_rows:
        return NOTHING
    return learn(held.column("kind").to_numpy(), np.array(held.column("row").to_pylist(), float),
                 held.column("label").to_numpy(), held.column("apart").to_numpy(), precision)


# --- results -------------------------------------------------------------------------

def written(spans: list[Span]) -> str:
    """``kind:start:end``, by start and kind, joined by commas."""
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


def found_spans(documents: DataFrame, model: Model, base: str = "base", added: str = "added") -> DataFrame:
    """The other columns, and the base and added spans of each whole text as arrays of structs."""
    span = "array<struct<start:int,stop:int,kind:string>>"
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.string())]))

    def make():
        def work(texts):
            plain = [t or "" for t in texts]
            first = [base_spans(t) for t in plain]
            more = [sorted(s) for s in model.added(plain, first)]
            return [pa.array([[{"start": a, "stop": b, "kind": KINDS[k]} for a, b, k in s] for s in spans], kind)
                    for spans in (first, more)]

        return work

    return per_text(documents, "text", make, f"`{base}` {span}, `{added}` {span}")


def report(documents: DataFrame) -> DataFrame:
    """Counts of base spans per kind, their digest, and all spans, per document."""
    spans = found_spans(documents.select("doc_id", "text"), fit(documents))
    order = F.array(*[F.lit(k) for k in KINDS])

    def joined(column):
        ranked = F.array_sort(F.transform(column, lambda s: F.struct(
            s["start"], F.array_position(order, s["kind"]).alias("rank"), s["stop"], s["kind"])))
        return F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in KINDS]
    return spans.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.concat("base", "added")).alias("spans"))


def redacted(documents: DataFrame, model: Model, mark: Callable[[str], str] = lambda kind: f"[{kind}]") -> DataFrame:
    """The documents with every found span replaced by a mark of its kind; overlapping ones become one mark."""
    text = fresh(documents, "_redacted")

    def make():
        def clean(value: str | None, spans: list[Span]) -> str | None:
            if value is None:
                return None
            out, at = [], 0
            for start, end, kind in sorted(spans):
                if start >= at:
                    out += [value[at:start], mark(KINDS[kind])]
                at = max(at, end)
            return "".join(out) + value[at:]

        def work(texts):
            plain = [t or "" for t in texts]
            first = [base_spans(t) for t in plain]
            return [pa.array([clean(t, b + a) for t, b, a in zip(texts, first, model.added(plain, first))], pa.string())]

        return work

    rows = per_text(documents, "text", make, f"{text} string")
    return rows.select(*[F.col(text).alias("text") if c == "text" else F.col(c) for c in documents.columns])
