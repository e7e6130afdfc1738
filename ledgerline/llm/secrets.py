"""Secret scans: fixed patterns, and random strings by two character Markov models.

A long run of token characters is cut at its separators, and the pieces are scored by two
first-order Markov models over characters: one of random strings, one of ordinary words,
numbers and identifiers. Both are counted on labelled samples from a bounded number of
documents: what the fixed patterns find is labelled random; pieces outside of it and outside
of undecided runs are labelled ordinary. Prose holds few constants, joined names and numbers,
so a fixed share of the ordinary model is given to each of these shapes, spelt with the counted
letters (``Shapes``). A run is a secret when the log-likelihood ratio beats the prior odds.

Paths, slugs, dates and numbered identifiers are ordinary by this. Short random strings with few
kinds of characters, such as UUIDs, can fall on either side.

Defined results: a null or empty text has no span; rows that repeat get equal results; a
sample without any secret leaves the random model uniform; other columns of the input pass
through ``redact`` and are left out by ``scan``; an empty input gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_arrow

#: Kinds in the order that breaks ties of the start, and their patterns (fixed values).
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: Words without one of which ``ASSIGN`` cannot match.
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")

#: Candidates of the models: long runs with a letter and a digit.
RUN = re.compile("[A-Za-z0-9+/_=-]{16,}")
#: Characters of the pieces; every other one separates two pieces.
ALPHABET = string.ascii_uppercase + string.ascii_lowercase + string.digits
INDEX = {c: i for i, c in enumerate(ALPHABET)}
UPPER, LOWER, DIGIT = slice(0, 26), slice(26, 52), slice(52, 62)
START = len(ALPHABET)

#: Expected number of documents in the training sample; prior odds of a run being a secret.
TRAIN_DOCS = 20_000
PRIOR = 1e-6
#: Weight of the uniform distribution in the random model, which has seen few samples.
UNIFORM = 0.8
#: The same in the ordinary model: names hold pairs that the sample's words do not.
UNSEEN = 0.1
#: Weight of the single characters in a pair's chance, in pairs seen.
BACK_OFF = 2.0
MARK = "[secret]"


@dataclass(frozen=True)
class Shapes:
    """Weights of spellings that prose holds too rarely, as shares of the counted letters."""

    constant: float = 0.1  # words in capitals
    capital: float = 0.1  # words with a capital
    joined: float = 0.03  # a capital inside a word
    number: float = 0.1  # pieces of digits
    numbered: float = 0.03  # digits behind a letter, letters behind a digit


@dataclass(frozen=True)
class Models:
    """Log-likelihood ratio of each character after each other one."""

    ratio: list[list[float]]

    def score(self, run: str) -> float:
        total, last = 0.0, START
        for c in run:
            here = INDEX.get(c, START)
            if here != START:
                total += self.ratio[last][here]
            last = here
        return total

    def secret(self, run: str) -> bool:
        return candidate(run) and self.score(run) > -math.log(PRIOR)


def base_spans(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int]], list[tuple[int, int]]]:
    """Spans of the fixed patterns, the values inside them, and all long runs."""
    runs = [m.span() for m in RUN.finditer(text)]
    spans, values = [], []
    lower = text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST["assign"]:
                spans.append((m.start(), m.end(), "assign"))
                values.append(m.span(2))
    # what is long enough for the other two lies inside one long run
    for lo, hi in runs:
        for kind, pattern in (("access", ACCESS), ("hex", HEX)):
            for m in pattern.finditer(text, lo, hi):
                if m.end() - m.start() >= LEAST[kind]:
                    spans.append((*m.span(), kind))
                    values.append(m.span())
    return spans, values, runs


def spans_of(text: str | None, models: Models) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]], list[tuple[int, int]]]:
    """Base spans, all spans by start and kind, and the ranges to hide."""
    if not text:
        return [], [], []
    base, values, runs = base_spans(text)
    more = [(lo, hi, "markov") for lo, hi in runs if models.secret(text[lo:hi])]
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    return sorted(base, key=order), sorted(base + more, key=order), values + [(lo, hi) for lo, hi, _ in more]


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{lo}:{hi}" for lo, hi, kind in spans)


def candidate(run: str) -> bool:
    """Whether the models decide on a run: it holds a letter and a digit."""
    return any(c.isdigit() for c in run) and any(c.isalpha() for c in run)


def _pairs(text: str) -> np.ndarray:
    """How often each character follows each other one inside the pieces of a text."""
    n = START + 1
    codes = _CODES[np.frombuffer(f" {text}".encode("ascii", "replace"), np.uint8)]
    return np.bincount(codes[:-1] * n + codes[1:], minlength=n * n).reshape(n, n)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Character pairs of the labelled samples: label 1 random, 0 ordinary."""
    n = START + 1
    counts = np.zeros((2, n, n), np.int64)
    for batch in batches:
        for text in batch.column("text").to_pylist():
            if not text:
                continue
            _, values, runs = base_spans(text)
            if values:
                counts[1] += _pairs(" ".join(text[lo:hi] for lo, hi in values))
            hidden = values + [(lo, hi) for lo, hi in runs if candidate(text[lo:hi])]
            plain, at = [], 0
            for lo, hi in sorted(hidden):
                if lo > at:
                    plain.append(text[at:lo])
                at = max(at, hi)
            counts[0] += _pairs(" ".join([*plain, text[at:]]))
    counts[:, :, START] = 0
    label, a, b = np.nonzero(counts)
    yield pa.record_batch(
        [pa.array(label, pa.int32()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(counts[label, a, b])], names=["label", "a", "b", "n"]
    )


_CODES = np.full(256, START, np.int64)
for _c, _i in INDEX.items():
    _CODES[ord(_c)] = _i


def shaped(seen: np.ndarray, shapes: Shapes = Shapes()) -> np.ndarray:
    """Counted pairs of ordinary pieces, with those of the rarer spellings added."""
    out = seen.astype(float)
    inner, first = seen[LOWER, LOWER] + 0.1, seen[START, LOWER] + 0.1
    letters, words = inner.sum(), first.sum()
    out[UPPER, UPPER] += shapes.constant * inner
    out[START, UPPER] += (shapes.constant + shapes.capital) * first
    # behind its first letter a word goes on as lower-case words do
    out[UPPER, LOWER] += (shapes.capital + shapes.joined) * inner * (first / inner.sum(axis=1))[:, None]
    place = inner.sum(axis=0) / letters
    out[LOWER, UPPER] += shapes.joined * words * np.outer(place, first / words)
    out[START, DIGIT] += shapes.number * words / 10
    out[DIGIT, DIGIT] += shapes.number * words / 100 * 2
    out[LOWER, DIGIT] += shapes.numbered * words * place[:, None] / 10
    out[UPPER, DIGIT] += shapes.numbered * shapes.constant * words * place[:, None] / 10
    out[DIGIT, LOWER] += shapes.numbered * words / 10 * first / words
    out[DIGIT, UPPER] += shapes.numbered * shapes.capital * words / 10 * first / words
    return out


def train(docs: DataFrame, sample: int = TRAIN_DOCS) -> Models:
    """Count both models on about ``sample`` documents, chosen by hash; at most 2 x 63 x 63 sums return."""
    total = max(1, docs.count())
    part = docs.select("text").where(F.pmod(F.xxhash64("doc_id"), F.lit(total)) < sample)
    sums = part.transform(map_arrow, _count, "label int, a int, b int, n long").groupBy("label", "a", "b").agg(F.sum("n").alias("n")).collect()
    n = len(ALPHABET)
    counts = np.zeros((2, n + 1, n + 1))
    for r in sums:
        counts[r["label"], r["a"], r["b"]] = r["n"]
    seen = np.stack((shaped(counts[0]), counts[1]))[:, :, :n]
    # pairs back off to single characters, and those to a small count of each
    single = seen.sum(axis=1, keepdims=True) + 0.5
    single /= single.sum(axis=2, keepdims=True)
    chance = (seen + BACK_OFF * single) / (seen.sum(axis=2, keepdims=True) + BACK_OFF)
    random = (1 - UNIFORM) * chance[1] + UNIFORM / n
    ordinary = (1 - UNSEEN) * chance[0] + UNSEEN / n
    return Models(np.log(random / ordinary).tolist())


def scan(docs: DataFrame, models: Models) -> DataFrame:
    """Counts per kind, the digest of the base spans, and all spans of ``docs(doc_id, text)``."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                base, every, _ = spans_of(text.as_py(), models)
                n = [sum(s[2] == k for s in every) for k in KINDS]
                rows.append((*n[:3], hashlib.sha256(joined(base).encode()).hexdigest(), joined(every), n[3]))
            if rows:
                columns = [pa.array(c) for c in zip(*rows, strict=True)]
                yield pa.record_batch([batch.column("doc_id"), *columns], names=["doc_id", *_SCAN])

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(map_arrow, over, schema)


_SCAN = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov"]


def hide(text: str | None, models: Models) -> str | None:
    """The text with each secret value replaced by ``MARK``; unchanged without any."""
    _, _, ranges = spans_of(text, models)
    if not ranges:
        return text
    out, at = [], 0
    for lo, hi in sorted(ranges):
        if lo >= at:
            out += [text[at:lo], MARK]
        at = max(at, hi)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, models: Models) -> DataFrame:
    """``docs`` with the secrets of ``text`` hidden; ``n_chars``, if there, follows the text."""
    place = docs.columns.index("text")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [hide(t.as_py(), models) for t in batch.column("text")]
            yield batch.set_column(place, batch.schema.field("text"), pa.array(texts, batch.schema.field("text").type))

    out = docs.transform(map_arrow, over, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
