"""Quality: a sparse ensemble of conjunctive rules over text statistics.

``statistics`` reduces each whole text to ``STATS``. On a bounded sample of
labelled documents small gradient-boosted trees are grown; every path from a
root is a conjunctive rule; a lasso logistic regression keeps few of them; and
``compiled`` turns the kept rules into one Spark column expression, which is
what scores the table.
"""

from __future__ import annotations

import functools
import math
import operator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import labelled, ready

SAMPLE = 20_000
#: Trees, their depth, learning rate, least rows of a node and thresholds tried for each statistic.
TREES, DEPTH, RATE, LEAF, CUTS = 40, 3, 0.2, 20, 24
PENALTY, STEPS = 5e-4, 400
THRESHOLD = 0.3

STATS = ("log_chars", "log_words", "word_length", "upper", "digits", "marks", "symbols", "exclaims", "pipes",
         "non_ascii", "distinct_words", "top_word", "distinct_lines", "words_a_line", "stops_a_word", "distinct_pairs")

_KIND = np.zeros((256, 8), np.int64)     # byte -> counters, in the order of _COUNTED
_COUNTED = ("upper", "lower", "digits", "marks", "symbols", "exclaims", "pipes", "non_ascii")
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = [_c.isupper() and _b < 128, _c.islower() and _b < 128, _c.isdigit() and _b < 128, _c in ".,;:?!'\"-()",
                 _b < 128 and not _c.isalnum() and not _c.isspace() and _c not in ".,;:?!'\"-()", _c == "!", _c == "|",
                 _b >= 128]


def describe(text: str | None) -> list[float]:
    """The statistics of one whole text (null: empty), all finite."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _KIND
    by = dict(zip(_COUNTED, counts.tolist()))
    words, lines = text.split(), text.split("\n")
    n, w = max(1, len(raw)), max(1, len(words))
    letters = max(1, by["upper"] + by["lower"])
    seen: dict[str, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    pairs = len(set(zip(words, words[1:])))
    stops = sum(map(text.count, ".!?"))
    return [math.log1p(len(raw)), math.log1p(len(words)), sum(map(len, words)) / w, by["upper"] / letters,
            by["digits"] / n, by["marks"] / n, by["symbols"] / n, by["exclaims"] / n, by["pipes"] / n,
            by["non_ascii"] / n, len(seen) / w, max(seen.values(), default=0) / w, len(set(lines)) / len(lines),
            w / len(lines), stops / w, pairs / max(1, w - 1)]


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and STATS (doubles) of every document."""
    def mapped(batches):
        for batch in batches:
            rows = np.asarray([describe(t) for t in batch.column(0).to_pylist()], float).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *(pa.array(c) for c in rows.T)],
                                             names=[*batch.schema.names[1:], *STATS])

    picked = docs.select("text", *keep)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[1:]]
    return picked.mapInArrow(mapped, ", ".join([*fields, *(f"{s} double" for s in STATS)]))


#: A rule is a sorted tuple of (statistic number, over?, threshold); it holds if all its parts do.
Rule = tuple[tuple[int, bool, float], ...]


def grow(x: np.ndarray, cuts: list[np.ndarray], residual: np.ndarray, rows: np.ndarray, path: Rule, depth: int,
         rules: set[Rule], step: np.ndarray) -> None:
    """Grow a regression tree on ``residual``; add its paths to ``rules`` and its leaves' means to ``step``."""
    best = (1e-9, None)
    r = residual[rows]
    if depth and len(rows) >= 2 * LEAF:
        for j, cut in enumerate(cuts):
            place = np.searchsorted(cut, x[rows, j], side="left")
            number = np.cumsum(np.bincount(place, minlength=len(cut) + 1))[:-1]
            total = np.cumsum(np.bincount(place, weights=r, minlength=len(cut) + 1))[:-1]
            ok = (number >= LEAF) & (len(rows) - number >= LEAF)
            if ok.any():
                n = np.where(ok, number, 1)
                gain = np.where(ok, total ** 2 / n + (r.sum() - total) ** 2 / np.maximum(len(rows) - n, 1), 0)
                gain = gain - r.sum() ** 2 / len(rows)
                k = int(np.argmax(gain))
                if ok[k] and gain[k] > best[0]:
                    best = (float(gain[k]), (j, float(cut[k])))
    if best[1] is None:
        step[rows] = r.mean() if len(r) else 0
        return
    j, cut = best[1]
    over = x[rows, j] > cut
    for side in (False, True):
        longer = tuple(sorted({*path, (j, side, cut)}))
        rules.add(longer)
        grow(x, cuts, residual, rows[over == side], longer, depth - 1, rules, step)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return functools.reduce(operator.and_, [(x[:, j] > cut) == over for j, over, cut in rule])


def lasso(a: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Lasso logistic weights by accelerated proximal gradient; the last column, the bias, is not penalised."""
    n = len(y)
    a = np.hstack([a, np.ones((n, 1))]).astype(np.float32)
    top = np.ones(a.shape[1], np.float32)
    for _ in range(20):                                                 # power rounds: the largest curvature
        top = (a @ top) @ a
        top /= np.linalg.norm(top)
    rate = 4 * n / float(np.linalg.norm(a @ top) ** 2)
    shrink = np.full(a.shape[1], rate * PENALTY)
    shrink[-1] = 0
    w = prev = np.zeros(a.shape[1])
    for t in range(STEPS):
        ahead = w + t / (t + 3) * (w - prev)
        z = a @ ahead.astype(np.float32)
        r = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
        moved = ahead - rate / n * (r.astype(np.float32) @ a)
        prev, w = w, np.sign(moved) * np.maximum(np.abs(moved) - shrink, 0)
    return w[:-1], float(w[-1])


@dataclass
class Model:
    rules: list[tuple[Rule, float]]
    bias: float

    def compiled(self) -> Column:
        """The score as one Spark expression over STATS."""
        z = F.lit(self.bias)
        for rule, weight in self.rules:
            parts = [F.col(STATS[j]) > cut if over else F.col(STATS[j]) <= cut for j, over, cut in rule]
            z = z + F.when(functools.reduce(operator.and_, parts), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), z))))


def learn(x: np.ndarray, y: np.ndarray) -> Model:
    """Trees -> rules -> lasso -> kept rules; a single class gives a constant score."""
    prior = math.log((y.sum() + .5) / (len(y) - y.sum() + .5)) if len(y) else 0.0
    if not len(y) or not 0 < y.sum() < len(y):
        return Model([], prior)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, CUTS + 2)[1:-1])) for c in x.T]
    z, rules, rows = np.full(len(y), prior), set(), np.arange(len(y))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        step = np.zeros(len(y))
        grow(x, cuts, (y - p) / max(1e-6, float((p * (1 - p)).mean())), rows, (), DEPTH, rules, step)
        z = z + RATE * np.clip(step, -4, 4)
    kept: dict[bytes, tuple[Rule, np.ndarray]] = {}
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        held = holds(rule, x)
        kept.setdefault(np.packbits(held).tobytes(), (rule, held))      # rules that hold alike: the simplest one
    listed = list(kept.values())
    w, bias = lasso(np.stack([held for _, held in listed], axis=1), y)
    return Model([(listed[k][0], float(w[k])) for k in np.flatnonzero(w)], bias)


def fit(docs: DataFrame, labels: DataFrame, keep: Column, label: str = "quality", sample: int = SAMPLE) -> Model:
    """Learn from a bounded sample of labelled documents; only their statistics reach the driver."""
    train = labelled(docs.sparkSession, docs, labels, label, keep, sample, "quality")
    got = statistics(train, "label").toPandas()
    return learn(got[list(STATS)].to_numpy(float), got["label"].to_numpy(float))


def classify(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Null ids are not held out and never learned from; null and empty texts have
    zero statistics and are scored like any other; an empty table gives an empty
    result; other columns are ignored.
    """
    ready(docs.sparkSession)
    held = F.coalesce(held_out, F.lit(False))
    model = fit(docs, labels, ~held)
    scored = statistics(docs, "doc_id").select("doc_id", held.alias("held_out"), model.compiled().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
