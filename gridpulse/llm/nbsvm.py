"""Quality classifier: naive Bayes features under a linear support vector machine.

A text is a set of n-gram indicators (words and word pairs over case-preserving
tokens, and word shapes), hashed to ``2**BITS`` dimensions. Every indicator is
scaled by its class log-count ratio ``r = ln((p/|p|) / (q/|q|))`` and a linear
hinge-loss model is fitted by dual coordinate descent. Margins become
probabilities through a logistic curve fitted on rows that the model did not
see.

The fit reads a bounded sample of labelled rows (``FIT_ROWS``); scoring is one
pass over whole texts and keeps only the weight vector in memory.

Defined results: null and empty texts have no indicators and get the score of
the bias alone. Rows without a label, with a null text or a null label are not
learned from. With labels of one class only, every score is that class's value.
Repeated rows score alike; the result has one row per input row. Extra columns
are kept by :func:`score_quality`.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridpulse.llm.common import labelled_sample, slices, texts

BITS = 18
FIT_ROWS = 6000
PIECE_BYTES = 1 << 20  # of text whose indicators a task holds at a time
FOLDS, HELD = 5, 0
THRESHOLD = 0.3

TOKEN = re.compile(r"\w+|[^\w\s]+|\n+")
MIX = np.uint64(0x9E3779B97F4A7C15)


def shape(token: str) -> str:
    """Case and character kinds of a token, lengths left out."""
    if token.isalpha():
        return "U" if token.isupper() and len(token) > 1 else "l" if token.islower() else "C"
    if token.isdigit():
        return "9"
    return token[:3] if not token[0].isalnum() else "m"


class Features:
    """Hashed n-gram indicators of texts; token hashes are kept per worker."""

    def __init__(self, bits: int = BITS, keep: int = 100_000):
        self.mask, self.keep = np.uint64((1 << bits) - 1), keep
        self.seen: dict[str, int] = {}

    def _code(self, token: str) -> int:
        """Token hash in the low and shape hash in the high 32 bits."""
        return zlib.crc32(token.encode("utf-8", "replace")) | zlib.crc32(b"#" + shape(token).encode("utf-8", "replace")) << 32

    def __call__(self, text: str) -> np.ndarray:
        tokens = TOKEN.findall(text)
        if not tokens:
            return np.empty(0, np.int64)
        if len(self.seen) > self.keep:
            self.seen.clear()
        seen = self.seen
        for t in set(tokens).difference(seen):
            seen[t] = self._code(t)
        code = np.fromiter(map(seen.__getitem__, tokens), np.uint64, len(tokens))
        word, kind = code & np.uint64(0xFFFFFFFF), code >> np.uint64(32)
        parts = [word * MIX, (kind + np.uint64(7)) * MIX]
        if len(tokens) > 1:
            again = (word[1:] == word[:-1]).any(keepdims=True).astype(np.uint64)
            parts += [(word[:-1] * MIX ^ word[1:]) * MIX, ((kind[:-1] * MIX ^ kind[1:]) + np.uint64(11)) * MIX,
                      (again + np.uint64(13)) * MIX]
        h = np.concatenate(parts) >> np.uint64(40)
        return np.unique(h & self.mask).astype(np.int64)


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray, dim: int, alpha: float = 1.0) -> np.ndarray:
    p, q = np.full(dim, alpha), np.full(dim, alpha)
    for idx, label in zip(rows, y, strict=True):
        (p if label > 0 else q)[idx] += 1
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_descent(rows: list[np.ndarray], y: np.ndarray, r: np.ndarray, c: float = 1.0, epochs: int = 12,
                 seed: int = 7) -> tuple[np.ndarray, float]:
    """L2-regularised hinge loss (L1-SVM) by dual coordinate descent. Rows are
    scaled to unit length; classes weigh alike. Returns the weights per
    indicator (already times ``r``) and the bias."""
    norms = [max(1e-12, np.sqrt((r[i] ** 2).sum() + 1.0)) for i in rows]
    ones = [1.0 / n for n in norms]
    n_pos = max(1, int((y > 0).sum()))
    n_neg = max(1, len(y) - n_pos)
    upper = np.where(y > 0, c * len(y) / (2 * n_pos), c * len(y) / (2 * n_neg))
    w, b, alpha = np.zeros(len(r)), 0.0, np.zeros(len(y))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            idx = rows[i]
            x = r[idx] / norms[i]  # not kept: twice the bytes of the indicators
            grad = y[i] * (w[idx] @ x + b * ones[i]) - 1.0
            new = min(max(alpha[i] - grad, 0.0), upper[i])  # |x| = 1
            step = (new - alpha[i]) * y[i]
            if step:
                w[idx] += step * x
                b += step * ones[i]
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w, b


def margin(idx: np.ndarray, r: np.ndarray, w: np.ndarray, b: float) -> float:
    x = r[idx]
    return float((w[idx] @ x + b) / np.sqrt((x ** 2).sum() + 1.0))


def logistic_fit(m: np.ndarray, y01: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and offset of P(1 | margin) by Newton steps on smoothed targets."""
    n1, n0 = y01.sum(), len(y01) - y01.sum()
    target = np.where(y01 > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        g, s = p - target, np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(s * m * m).sum() + 1e-3, (s * m).sum()], [(s * m).sum(), s.sum() + 1e-3]])
        step = np.linalg.solve(h, np.array([(g * m).sum() + 1e-3 * a, g.sum()]))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(float(a), 1e-6), float(b)


def fit(rows: list[np.ndarray], labels: Iterable[int], bits: int = BITS) -> dict:
    """Model of bounded size; a fifth of the rows fits the logistic curve."""
    y01 = np.asarray(list(labels), int)
    if len(y01) == 0 or y01.min() == y01.max():
        return {"constant": 0.5 if len(y01) == 0 else float(y01[0])}
    y = np.where(y01 > 0, 1.0, -1.0)
    part = np.arange(len(y)) % 5 == 0
    dim = 1 << bits
    if len(np.unique(y01[~part])) == 2 and len(np.unique(y01[part])) == 2:
        own = [rows[i] for i in np.flatnonzero(~part)]
        r = log_count_ratio(own, y[~part], dim)
        w, b = dual_descent(own, y[~part], r)
        m = np.array([margin(rows[i], r, w, b) for i in np.flatnonzero(part)])
        slope, offset = logistic_fit(m, y01[part])
    else:
        slope, offset = 2.0, 0.0
    r = log_count_ratio(rows, y, dim)
    w, b = dual_descent(rows, y, r)
    return {"r": r.astype(np.float32), "wr": (w * r).astype(np.float32), "bias": b, "slope": slope, "offset": offset}


def score_rows(rows: list[np.ndarray], model: dict) -> np.ndarray:
    if "constant" in model:
        return np.full(len(rows), model["constant"])
    r, wr = model["r"], model["wr"]
    m = np.array([(wr[i].sum(dtype=np.float64) + model["bias"]) / np.sqrt((r[i].astype(np.float64) ** 2).sum() + 1.0) for i in rows])
    return 1 / (1 + np.exp(-np.clip(model["slope"] * m + model["offset"], -30, 30)))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS,
                folds: int = FOLDS, held: int = HELD) -> dict:
    """Learn from at most about ``fit_rows`` labelled rows outside the held fold.

    The driver holds the indicators of these rows as packed 32-bit numbers, read one
    partition at a time."""
    sample = labelled_sample(docs, labels, label, folds, held, fit_rows)

    def extract(batches):
        features = Features()
        for batch in slices(batches, "text", PIECE_BYTES):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"),
                 pa.array([features(t).astype("<i4").tobytes() for t in texts(batch.column("text"))], pa.binary())],
                names=["doc_id", "y", "x"])

    found = sample.mapInArrow(extract, "doc_id long, y int, x binary").toLocalIterator()
    got = sorted(((zlib.crc32(str(g.doc_id).encode()), g.doc_id, g.y, np.frombuffer(g.x, "<i4")) for g in found), key=lambda g: g[:2])
    return fit([x for *_, x in got], [y for _, _, y, _ in got])


def score_quality(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """Adds ``quality_score`` and ``quality_pred`` to every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("quality_score", "quality_pred")]
    docs = docs.select(*kept)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", quality_score double, quality_pred int"

    def score(batches):
        features, m = Features(), held.value
        for batch in slices(batches, "text", PIECE_BYTES):
            s = score_rows([features(t) for t in texts(batch.column("text"))], m)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))],
                names=[*batch.schema.names, "quality_score", "quality_pred"])

    return docs.mapInArrow(score, schema)
