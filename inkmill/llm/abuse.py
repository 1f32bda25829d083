"""Scoring of abusive, hateful and sexual passages: a linear classifier over character n-grams whose features are
scaled by naive Bayes log-count ratios.

A label is given to a whole document, but abuse stands in single passages. So the classifier works on passages: a
document's score is the largest of its passages, and training alternates between marking the passages that make a
document abusive and fitting the classifier on the marked passages. Labels are wrong now and then, so the reviewed
documents are split in two halves: each half is judged by the model of the other one. The held-out scores give the
threshold from which a passage counts, and leave a document out of the last fit whose label nothing in it bears out.

Spelling is evened out first: compatibility forms, case, invisible characters, look-alike digits and signs inside
words, letters set apart by spaces or dots, and letters repeated more than twice.

Defined results: null, empty and blank texts have the lowest score, 0, and are not found; a document with several
labels counts by their mean, at half it is left out; without labels of both kinds nothing is found; every document id
has one row for each of its texts.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.plans.session import written

#: Most labelled documents used to fit the classifier; beyond, those with the smallest hashed ids.
MAX_LABELLED = 3000
#: Most characters of all labelled documents used to fit, which bounds the driver's memory: documents are taken in the
#: order of their hashed ids, each as a whole, and one that doesn't fit any more is passed over.
MAX_FIT_CHARS = 4_000_000
NGRAMS = (2, 3, 4, 5)
DIM = 1 << 18
#: N-grams that a passage is taken to have at least, so that a few of them in a short one don't weigh more than in a sentence.
LEAST_GRAMS = 60
#: Distinct passages that an n-gram must stand in to be used in the fit.
LEAST_SEEN = 2
ROUNDS = 3
STEPS = 40
#: Weight of the quadratic penalty on a classifier of scaled features.
PENALTY = 2e-4

_CUT = re.compile(r"\n+|(?<=[.!?…])[\"')\]]*\s+")
_LEAD = re.compile(r"^(?:\s*(?:\*\*[^*\n]{1,20}:\*\*|\[?\d{1,2}:\d{2}(?::\d{2})?\]?|[-*>#|]+|\d+[.)]|[qa]:)\s*)*(?:[\w.\-]{1,24}:\s)?")
_GONE = re.compile(r"[​-‏⁠﻿­‪-‮\u0000-\u0008\u000b-\u001f︎️]")
_APART = re.compile(r"(?<![^\W\d_])(?:[^\W\d_][ ._\-*]){2,}[^\W\d_](?![^\W\d_])")
_LONG = re.compile(r"([^\W\d])\1{2,}")
_ADDRESS = re.compile(r"[\w.+\-]+@[\w.\-]+|https?://\S+|\[\[[^\]\n]*\]\]")
_LETTER = re.compile(r"[^\W\d_]")
_SIGNS = re.compile(r"[^\w\s.,;:!?'\"*()\-]+")
_NUMBER = re.compile(r"\d+(?:[.,:\-/]\d+)*")
_INSTEAD = re.compile(r"[\d@$!€]")
#: Signs that stand for letters inside words. Fixed values.
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "€": "e"})
_LEET = re.compile(r"(?<![\w@$!])(?=[\w@$!€]*[^\W\d_])(?=[\w@$€]*[\d@$!€])[^\W\d_][\w@$!€]*[^\W_](?![\w@$])|(?<![\w@$!])[@$][^\W\d_]{2,}")


def _even(passage: str) -> str:
    s = _LEAD.sub("", passage.strip())
    if "@" in s or "://" in s or "[[" in s:  # the costlier patterns are tried only where what they look for is there
        s = _ADDRESS.sub(" ", s)
    if _INSTEAD.search(s):
        s = _LEET.sub(lambda m: m[0].translate(LOOKALIKES) if sum(c.isalpha() for c in m[0]) * 2 >= len(m[0]) else m[0], s)
    s = _APART.sub(lambda m: re.sub(r"[ ._\-*]", "", m[0]), s)
    s = _SIGNS.sub(" ", _NUMBER.sub("0", s))
    return " ".join(_LONG.sub(r"\1\1", s).split())


def passages(text: str | None) -> list[str]:
    """The evened-out passages of a text: its sentences and lines that hold a letter."""
    if not text or not text.strip():
        return []
    text = _GONE.sub("", unicodedata.normalize("NFKC", text)).lower()
    return [p for p in map(_even, _CUT.split(text)) if _LETTER.search(p)]


def features(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashed n-grams, passage of each); n-grams never cross passages."""
    joined = "\x01".join(["", *(f" {p} " for p in parts), ""])
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    edge = code == 1
    owner = np.cumsum(edge) - 1
    found, of = [], []
    run, bad = np.zeros(len(code), np.uint64), np.zeros(len(code), bool)
    for n in range(1, max(NGRAMS) + 1):
        # run[i] is the hash of the n characters from i on
        size = len(code) - n + 1
        if size <= 0:
            break
        run = run[:size] * np.uint64(0x100000001B3) + code[n - 1 :] + np.uint64(n)
        bad = bad[:size] | edge[n - 1 :]
        if n in NGRAMS:
            ok = ~bad
            h = run[ok]
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            found.append((h >> np.uint64(46)).astype(np.int32))
            of.append(owner[:size][ok].astype(np.int32))
    return np.concatenate(found), np.concatenate(of)


def _unit(grams: np.ndarray) -> np.ndarray:
    """The scale of passages by their numbers of n-grams."""
    return 1 / np.sqrt(np.maximum(grams, LEAST_GRAMS))


@dataclass
class Model:
    weights: np.ndarray  # log-count ratios times the linear weights
    bias: float

    def scores(self, parts: list[str]) -> np.ndarray:
        """The log-odds of each passage, 0 at the threshold."""
        grams, of = features(parts)
        return np.bincount(of, self.weights[grams], len(parts)) * _unit(np.bincount(of, minlength=len(parts))) + self.bias


class _Passages:
    """The n-grams of distinct passages, in order of passage, numbered without gaps."""

    def __init__(self, texts: list[str]) -> None:
        self.n = len(texts)
        size, seen = np.zeros(self.n), np.zeros(DIM, np.int64)
        found, rows = [], []
        for at in range(0, self.n, 1000):  # some passages at a time, so that only their 32-bit numbers are kept
            grams, row = features(texts[at : at + 1000])
            order = np.argsort(row, kind="stable")
            grams, row = grams[order], row[order]
            size[at : at + 1000] = np.bincount(row, minlength=len(texts[at : at + 1000]))
            seen += np.bincount(np.unique(row.astype(np.int64) * DIM + grams) % DIM, minlength=DIM)
            found.append(grams)
            rows.append(row + np.int32(at))
        self.unit = _unit(size)
        self.used = np.flatnonzero(seen >= LEAST_SEEN)
        number = np.full(DIM, -1, np.int32)
        number[self.used] = np.arange(len(self.used), dtype=np.int32)
        for k, grams in enumerate(found):
            own = number[grams]
            found[k], rows[k] = own[own >= 0], rows[k][own >= 0]
        self.gram, self.row = np.concatenate(found), np.concatenate(rows)

    def scores(self, weights: np.ndarray, bias: float) -> np.ndarray:
        return np.bincount(self.row, weights[self.gram], self.n) * self.unit + bias

    def guess(self, dirty: np.ndarray, clean: np.ndarray) -> np.ndarray:
        """How much more often the n-grams of a passage stand in passages of abusive documents than in others, on average."""
        p, q = (np.bincount(self.gram, side[self.row], len(self.used)) for side in (dirty, clean))
        rate = np.log((p + 0.3) / (dirty.sum() + 1)) - np.log((q + 0.3) / (clean.sum() + 1))
        return np.bincount(self.row, rate[self.gram], self.n) * self.unit**2

    def fitted(self, y: np.ndarray, weight: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, float]:
        """Weights and bias of a penalised logistic regression over features scaled by their log-count ratios, by gradient
        steps with momentum and own step sizes. y: the share of abusive sightings of each passage."""
        used = np.flatnonzero(weight > 0)
        here = (weight > 0)[self.row]
        place = np.zeros(self.n, np.int32)
        place[used] = np.arange(len(used))
        gram, row, y, weight, size = self.gram[here], place[self.row[here]], y[used], weight[used], len(self.used)
        once = np.minimum(weight, 1.0)
        p, q = (np.bincount(gram, side[row], size) + 0.5 for side in (once * y, once * (1 - y)))
        ratio = np.log((p / p.sum()) / (q / q.sum()))
        value = ratio.astype(np.float32)[gram] * self.unit[used].astype(np.float32)[row]
        share = weight / weight.sum()
        theta, bias = np.zeros(size), 0.0
        seen, speed, seen_b, speed_b = np.zeros(size), np.zeros(size), 0.0, 0.0
        for t in range(1, steps + 1):
            z = np.bincount(row, theta.astype(np.float32)[gram] * value, len(y)) + bias
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * share
            g, g_b = np.bincount(gram, error.astype(np.float32)[row] * value, size) + PENALTY * theta, float(error.sum())
            speed, seen = 0.9 * speed + 0.1 * g, 0.99 * seen + 0.01 * g * g
            speed_b, seen_b = 0.9 * speed_b + 0.1 * g_b, 0.99 * seen_b + 0.01 * g_b * g_b
            rate = 0.15 / (1 + t / 40) / (1 - 0.9**t)
            theta -= rate * speed / (np.sqrt(seen / (1 - 0.99**t)) + 1e-6)
            bias -= rate * speed_b / (np.sqrt(seen_b / (1 - 0.99**t)) + 1e-6)
        return theta * ratio, bias


def _marked(bags: list[np.ndarray], label: np.ndarray, score: np.ndarray, n: int, least: float | None) -> tuple[np.ndarray, np.ndarray]:
    """(share of abusive sightings, weight) of each passage. Of an abusive document the highest passage is abusive, the
    others aren't used, as they may be either; a document with none over ``least`` is left out."""
    y, weight = np.zeros(n), np.zeros(n)
    for own, abusive in zip(bags, label, strict=True):
        if not abusive:
            weight[own] += 1
            continue
        top = score[own].max()
        if least is not None and top < least:
            continue
        hit = own[score[own] >= top]
        y[hit] += 1
        weight[hit] += 1
    y = y / np.maximum(weight, 1e-9)
    y[y < 0.5] *= 0.5
    weight = np.minimum(weight, 10.0)
    weight[y > 0] *= max(1.0, 0.15 * weight[y == 0].sum() / max(1e-9, weight[y > 0].sum()))
    return y, weight


def threshold(top: np.ndarray, label: np.ndarray) -> float:
    """The score that parts held-out documents best from each other by their labels; the middle of the gap where several do."""
    order = np.argsort(-top, kind="stable")
    gain = np.concatenate([[0], np.cumsum(np.where(label[order] > 0, 1, -1))])
    best = np.flatnonzero(gain == gain.max())
    ends = np.concatenate([[top.max() + 2], top[order], [top.min() - 2]])
    widest = max(best, key=lambda k: ends[k] - ends[k + 1])
    return float((ends[widest] + ends[widest + 1]) / 2)


def fit(texts: list[str], abusive: list[int]) -> Model | None:
    """A model of labelled documents; None without labels of both kinds."""
    kept = [(b, a) for b, a in zip(map(passages, texts), abusive, strict=True) if b]
    label = np.array([a for _, a in kept])
    if len(set(label.tolist())) < 2:
        return None
    distinct: dict[str, int] = {}
    bags = [np.array(sorted({distinct.setdefault(p, len(distinct)) for p in b})) for b, _ in kept]
    own = _Passages(list(distinct))
    half = np.zeros(len(bags), np.int64)  # both kinds of labels in both halves where there are two of each
    for kind in (0, 1):
        half[np.flatnonzero(label == kind)[1::2]] = 1
    if min((label[half == 1] == kind).sum() for kind in (0, 1)) == 0:
        half[:] = 0
    halves = [([b for b, h in zip(bags, half, strict=True) if h == k], label[half == k]) for k in (0, 1)] if half.any() else [(bags, label)]
    held = []  # scores by the model of each half, 0 at the threshold for the other one
    for mine, kinds in halves:
        dirty, clean = np.zeros(own.n), np.zeros(own.n)
        for b, a in zip(mine, kinds, strict=True):
            (dirty if a else clean)[b] = 1
        held.append(own.guess(dirty, clean))
    for r in range(ROUNDS):
        models, new = [], []
        for k, (mine, kinds) in enumerate(halves):
            other = (k + 1) % len(halves)
            y, weight = _marked(mine, kinds, held[k if r == 0 else other], own.n, None if r == 0 else 0.0)
            if not (y > 0.5).any():
                return None
            weights, bias = own.fitted(y, weight)
            score = own.scores(weights, bias)
            cut = threshold(np.array([score[b].max() for b in halves[other][0]]), halves[other][1])
            models.append((weights, bias - cut))
            new.append(score - cut)
        held = new
    # the last fit: each document marked by the model that hasn't seen it
    parts = [_marked(mine, kinds, held[k - 1], own.n, 0.0) for k, (mine, kinds) in enumerate(halves)]
    both = sum(w for _, w in parts)
    y = sum(y * w for y, w in parts) / np.maximum(both, 1e-9)
    if not (y > 0.5).any():
        return None
    weights, bias = own.fitted(y, both)
    models.append((weights, bias))
    # linear models average by their weights; what only one of them holds against a passage counts a third
    weights, bias = sum(w for w, _ in models) / len(models), sum(b for _, b in models) / len(models)
    score = own.scores(weights, bias)
    # between what the halves agree to be clean and what they agree to be abusive
    low, high = score[np.max(held, axis=0) < 0], score[np.min(held, axis=0) > 0]
    cut = threshold(np.concatenate([low, high]), np.concatenate([np.zeros(len(low)), np.ones(len(high))])) if len(low) and len(high) else 0.0
    full = np.zeros(DIM, np.float32)
    full[own.used] = weights
    return Model(full, bias - cut)


def fit_from(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model of the reviewed documents: at most MAX_LABELLED of them, of MAX_FIT_CHARS in all, reach the driver."""
    mean = labels.where("abusive IS NOT NULL").groupBy("doc_id").agg(F.avg("abusive").alias("mean")).where("mean != 0.5")
    chosen = mean.select("doc_id", (F.col("mean") > 0.5).cast("int").alias("a")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    texts = written(docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "labelled")
    room, taken = MAX_FIT_CHARS, []
    for r in texts.select("doc_id", F.char_length("text").alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id", "n").collect():  # at most MAX_LABELLED rows
        if r["n"] <= room:
            room -= r["n"]
            taken.append(r["doc_id"])
    rows = texts.where(F.col("doc_id").isin(taken)).collect() if taken else []
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    return fit([r["text"] for r in rows], [r["a"] for r in rows])


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, source, score, passages, abusive): the score is the probability of the worst passage; passages counts those over one half."""
    own = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: DIM weights
    schema = "doc_id bigint, source string, score double, passages int, abusive boolean"
    arrow = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("score", pa.float64()), ("passages", pa.int32()), ("abusive", pa.bool_())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            worst, count = [], []
            for text in batch.column(2):
                parts = passages(text.as_py()) if own.value else []
                z = own.value.scores(parts) if parts else np.array([-np.inf])
                worst.append(float(1 / (1 + np.exp(-z.max()))) if parts else 0.0)
                count.append(int((z > 0).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(worst), pa.array(count, pa.int32()), pa.array([c > 0 for c in count])], schema=arrow)

    return docs.select(docs["doc_id"].cast("bigint"), docs["source"].cast("string"), docs["text"].alias("text")).mapInArrow(run, schema)


def rates(scored: DataFrame) -> DataFrame:
    """One row for each source: documents, abusive ones, their share and the mean score."""
    return scored.groupBy("source").agg(F.count("*").alias("docs"), F.count_if("abusive").alias("abusive_docs"), F.avg(F.col("abusive").cast("double")).alias("rate"), F.avg("score").alias("mean_score"))
