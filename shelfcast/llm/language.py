"""Language identification by a bidirectional gated recurrent network over bytes.

The network is fitted in numpy by backpropagation through time on windows of a
bounded, documented sample. Scoring cuts every whole text into windows of
``WINDOW`` bytes, runs both directions over all of them, labels every byte
position and pools the positions' probabilities of a document.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import bounded_rows, hashed_parts, ready

#: Documents the network is fitted on, and windows taken from each of them (spread over the whole text).
SAMPLE, WINDOWS = 6000, 4
WINDOW, HIDDEN = 64, 8
STEPS, BATCH, RATE = 500, 256, 0.02
#: Windows that run together while scoring: bounds a worker's memory.
TOGETHER = 2048
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def forward(table: np.ndarray, u: np.ndarray, steps: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States (time, hidden, windows) of a gated recurrent unit; ``table`` holds each byte's gate inputs by column."""
    h = np.zeros((HIDDEN, steps.shape[1]), table.dtype)
    out = np.empty((len(steps), *h.shape), table.dtype)
    x, g = np.empty((3 * HIDDEN, steps.shape[1]), table.dtype), np.empty((3 * HIDDEN, steps.shape[1]), table.dtype)
    for t, byte in enumerate(steps):
        np.take(table, byte, axis=1, out=x, mode="clip")
        np.matmul(u, h, out=g)
        gates = x[:2 * HIDDEN]
        gates += g[:2 * HIDDEN]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        r, z = gates[:HIDDEN], gates[HIDDEN:]
        inner = g[2 * HIDDEN:].copy() if trace is not None else g[2 * HIDDEN:]
        new = np.tanh(x[2 * HIDDEN:] + r * inner)
        if trace is not None:
            trace.append((byte, h, r.copy(), z.copy(), inner, new))
        h = new + z * (h - new)
        out[t] = h
    return out


def backward(u: np.ndarray, trace: list, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of (table, u) from the gradient of every state, back through time."""
    d_table, d_u = np.zeros((256, 3 * HIDDEN)), np.zeros_like(u)
    carry = np.zeros_like(grad[0])
    for t in range(len(trace) - 1, -1, -1):
        byte, h, r, z, inner, new = trace[t]
        dh = grad[t] + carry
        d_new = dh * (1 - z) * (1 - new * new)
        d_z = dh * (h - new) * z * (1 - z)
        d_r = d_new * inner * r * (1 - r)
        d_in = np.concatenate([d_r, d_z, d_new])
        d_g = np.concatenate([d_r, d_z, d_new * r])
        np.add.at(d_table, byte, d_in.T)
        d_u += d_g @ h.T
        carry = dh * z + u.T @ d_g
    return d_table.T, d_u


@dataclass
class Model:
    languages: list[str]
    weights: list[np.ndarray]            # both directions' byte tables and recurrences, then the output

    def positions(self, steps: np.ndarray) -> np.ndarray:
        """Probabilities (time, language, window) of every byte position."""
        ahead_in, ahead_u, back_in, back_u, out, bias = self.weights
        ahead = forward(ahead_in, ahead_u, steps)
        back = forward(back_in, back_u, steps[::-1])[::-1]
        logits = np.matmul(out[:, :HIDDEN], ahead) + np.matmul(out[:, HIDDEN:], back) + bias[:, None]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        return logits / logits.sum(axis=1, keepdims=True)

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities of each text's positions; a text without bytes gets zeros."""
        total = np.zeros((len(texts), len(self.languages)))
        lengths = np.asarray([len(t) for t in texts], np.int64)
        count = -(-lengths // WINDOW)
        data = np.frombuffer(b"".join(t.ljust(c * WINDOW, b"\0") for t, c in zip(texts, count.tolist())), np.uint8)
        windows = data.reshape(-1, WINDOW)
        owner = np.repeat(np.arange(len(texts)), count)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        real = np.minimum(lengths[owner] - number * WINDOW, WINDOW)
        for low in range(0, len(owner), TOGETHER):
            part = slice(low, low + TOGETHER)
            p = self.positions(np.ascontiguousarray(windows[part].T).astype(np.intp))
            p *= (np.arange(WINDOW)[:, None] < real[part])[:, None, :]
            np.add.at(total, owner[part], p.sum(axis=0).T)
        return total / np.maximum(lengths, 1)[:, None]


def train(windows: np.ndarray, label: np.ndarray, languages: list[str], seed: int = 1) -> Model:
    """Backpropagation through time with Adam; every position of a window carries the document's label."""
    rng = np.random.default_rng(seed)
    k = len(languages)
    shapes = [(3 * HIDDEN, 256), (3 * HIDDEN, HIDDEN)] * 2 + [(k, 2 * HIDDEN), (k,)]
    w = [rng.normal(0, .5 if s[-1] == HIDDEN else .3, s) for s in shapes]
    m1, m2 = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    for step in range(1, STEPS + 1 if k > 1 else 1):
        pick = rng.integers(0, len(windows), BATCH)
        steps = np.ascontiguousarray(windows[pick].T).astype(np.intp)
        one, two = [], []
        ahead, back = forward(w[0], w[1], steps, one), forward(w[2], w[3], steps[::-1], two)
        both = np.concatenate([ahead, back[::-1]], axis=1)
        logits = np.matmul(w[4], both) + w[5][:, None]
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[:, label[pick], np.arange(BATCH)] -= 1
        p /= BATCH * WINDOW
        d_both = np.matmul(w[4].T, p)
        grads = [*backward(w[1], one, d_both[:, :HIDDEN]), *backward(w[3], two, d_both[::-1, HIDDEN:]),
                 np.einsum("tkb,thb->kh", p, both), p.sum(axis=(0, 2))]
        scale = min(1.0, 1.0 / max(1e-9, float(np.sqrt(sum((g * g).sum() for g in grads)))))
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for i, g in enumerate(grads):
            g = g * scale
            m1[i] = .9 * m1[i] + .1 * g
            m2[i] = .99 * m2[i] + .01 * g * g
            w[i] = w[i] - rate * (m1[i] / (1 - .9 ** step)) / (np.sqrt(m2[i] / (1 - .99 ** step)) + 1e-8)
    return Model(languages, [x.astype(np.float32) for x in w])


def fit(docs: DataFrame, keep: Column, sample: int = SAMPLE) -> Model | None:
    """Learn from a bounded sample of documents with a language that pass ``keep``; None if there are none."""
    usable = docs.select("doc_id", "text", "lang").filter(
        keep & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.octet_length("text") > 0))
    chosen = bounded_rows(hashed_parts(usable, "doc_id", "lang", sample, "language"), sample)

    def cut(batches):
        for batch in batches:
            rows = []
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                spread = np.linspace(0, max(0, len(text) - WINDOW), WINDOWS).astype(int)
                for at in sorted(set(spread.tolist())):
                    piece = text[at:at + WINDOW]
                    rows.append((lang, (piece * (WINDOW // len(piece) + 1))[:WINDOW]))
            cols = list(zip(*rows)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.binary())],
                                             names=["lang", "piece"])

    got = chosen.select(F.col("text").cast("binary"), "lang").mapInArrow(cut, "lang string, piece binary").collect()
    got.sort(key=lambda r: (r.lang, bytes(r.piece)))
    if not got:
        return None
    languages = sorted({r.lang for r in got})
    number = {lang: i for i, lang in enumerate(languages)}
    return train(np.frombuffer(b"".join(bytes(r.piece) for r in got), np.uint8).reshape(-1, WINDOW),
                 np.asarray([number[r.lang] for r in got]), languages)


def identify(docs: DataFrame, model: Model | None, *keep: str) -> DataFrame:
    """The columns ``keep``, lang_pred and score (the pooled probability) of every document."""
    def mapped(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            known = [model is not None and _LETTER.search(t) is not None for t in texts]
            raw = [t.encode("utf-8", "surrogatepass") if k else b"" for t, k in zip(texts, known)]
            if any(known):
                p = model.documents(raw)
                best = p.argmax(axis=1)
                lang = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
                score = np.where(known, p[np.arange(len(p)), best], 0.0)
            else:
                lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(lang, pa.string()), pa.array(np.clip(score, 0, 1).astype(float))],
                names=[*batch.schema.names[1:], "lang_pred", "score"])

    picked = docs.select("text", *keep)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[1:]]
    return picked.mapInArrow(mapped, ", ".join([*fields, "lang_pred string, score double"]))


def classify(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document.

    Null ids are not held out and never learned from; a null text or one without
    a letter is ``und`` with score 0, as is every text if nothing can be learned;
    repeated rows are labelled alike; an empty table gives an empty result.
    """
    ready(docs.sparkSession)
    held = F.coalesce(held_out, F.lit(False))
    return identify(docs, fit(docs, ~held), "doc_id").select("doc_id", held.alias("held_out"), "lang_pred", "score")
