"""Language identification by cross-parsing entropy.

A suffix automaton of each language's training text gives, at any place of a
document, the longest match with that text. Parsing a document greedily into
longest matches, the language whose parse needs the fewest phrases (each phrase
costs ``log2`` of its training size; per character) is the prediction.

Where a state has no edge for a character, the phrase ends there and the next
begins with that character. The edges lie in one array by row displacement: a
state's edges share no cell with another state's, and a cell names its state,
so the table grows with the edges and not with the alphabet, which is every code
point of the training text. Lanes (segments of at most ``SEGMENT`` characters of
the documents of a batch) walk the tables side by side in numpy; a segment
border ends the phrase. Whole texts are read.

Training uses at most ``FIT_CHARS`` characters of each language, from rows
picked by a hash of their id and text among labelled rows outside the held fold.

Defined results: a null text and a text without a letter are ``und`` with
score 0; without training rows every text is ``und``. Ties go to the language
that sorts first. Repeated rows are predicted alike; extra columns are kept.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import fold_is, picked, slices

FOLDS, HELD = 3, 1
FIT_CHARS = 16_000
ROW_CHARS = 2_400
SEGMENT = 1024
PLACES = 128  # places that are tried at once for the edges of a state


def normalised(text: str) -> np.ndarray:
    """Code points in lower case; digits, punctuation, symbols and space are one blank."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    return np.where(KEPT[a >> 3] >> (a & 7) & 1, a, 32)


def _kept() -> np.ndarray:
    """A bit for every code point: letters, and the marks U+0300 to U+036F, stay."""
    return np.packbits([chr(c).isalpha() or 0x300 <= c < 0x370 for c in range(0x110000)], bitorder="little")


KEPT = _kept()


def has_letter(a: np.ndarray) -> bool:
    """Whether normalised text has more than blanks and marks."""
    return bool(((a != 32) & ((a < 0x300) | (a >= 0x370))).any())


def squeezed(a: np.ndarray) -> np.ndarray:
    """Runs of blanks become one."""
    return a[np.r_[True, (a[1:] != 32) | (a[:-1] != 32)]] if len(a) else a


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Edges of the states of the smallest automaton of all suffixes."""
    edges: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        cur = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in edges[p]:
            edges[p][c] = cur
            p = link[p]
        if p != -1:
            q = edges[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(edges)
                edges.append(dict(edges[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and edges[p].get(c) == q:
                    edges[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return edges


def parse_table(codes: list[int], size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(cells, start)``. A state is the place of its row; the cell at ``state +
    code`` is ``state << 32 | next << 2 | phrases begun`` if the state has that edge,
    and ``start[code]``, without the first part, is what holds otherwise. A code that
    the text lacks is a phrase of its own."""
    edges = suffix_automaton(codes)
    place = [0] * len(edges)  # the first state's row has every code
    taken, used = np.zeros(size + 2 * PLACES + 3 * len(codes), bool), {0}
    taken[:size] = True
    low = size
    by_edges = sorted(range(1, len(edges)), key=lambda s: -len(edges[s]))
    for state in by_edges:
        own = np.array(sorted(edges[state]), np.int64)
        if len(own) < 2:
            continue
        at = low - int(own[0])
        while not place[state]:
            if at + size + PLACES > len(taken):
                taken = np.append(taken, np.zeros(len(taken) + size + PLACES, bool))
            free = np.flatnonzero(~taken[at + np.arange(PLACES) + own[:, None]].any(axis=0)) + at
            place[state] = next((p for p in free.tolist() if p not in used), 0)
            if not place[state]:  # little room is left there
                low, at = max(low, at + int(own[0])), at + PLACES
        used.add(place[state])
        taken[place[state] + own] = True
    empty = iter(np.append(np.flatnonzero(~taken), len(taken) + np.arange(2 * len(edges) + size)).tolist())
    for state in by_edges:
        if len(edges[state]) < 2:
            code = next(iter(edges[state]), 0)
            place[state] = next(p - code for p in empty if p - code not in used)
            used.add(place[state])
    cells = np.full(max(place) + size, -1 << 32, np.int64)
    cells[:size] = 1
    start = np.full(size, 2, np.int64)
    for state, out in enumerate(edges):
        for c, t in out.items():
            cells[place[state] + c] = place[state] << 32 | place[t] << 2
            if not state:
                start[c] = place[t] << 2 | 1
    return cells, start


def fit_languages(docs: DataFrame, folds: int = FOLDS, held: int = HELD, fit_chars: int = FIT_CHARS) -> dict:
    """Tables for every language value; bounded by ``fit_chars`` characters each."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~fold_is("doc_id", folds, held))
    rows = rows.where(F.length(F.trim("text")) > 0)
    count = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    want = max(1, 4 * fit_chars // ROW_CHARS)
    share = F.lit(0)
    for lang, n in count.items():
        share = F.when(F.col("lang") == lang, min(1 << 30, math.ceil((1 << 30) * want / n))).otherwise(share)
    # Training reads a window of a sampled row, from its middle, so that one long row is not all.
    middle = F.greatest(F.lit(1), ((F.length("text") - ROW_CHARS) / 2).cast("int"))
    windows = rows.select("lang", "doc_id", F.substring(F.col("text"), middle, F.lit(ROW_CHARS)).alias("text"))
    training = picked(windows, ["lang", "doc_id", "text"], share).collect()
    training.sort(key=lambda r: (r.lang, hash_order(r.doc_id), r.text))
    texts = {}
    for r in training:
        a = squeezed(normalised(r.text))
        if has_letter(a) and sum(map(len, texts.get(r.lang, []))) < fit_chars:
            texts.setdefault(r.lang, []).append(a)
    if not texts:
        return {"langs": []}
    joined = {k: np.concatenate([np.append(a, 32) for a in v])[:fit_chars] for k, v in sorted(texts.items())}
    known = np.unique(np.concatenate(list(joined.values())))
    size = len(known) + 1
    return {"langs": list(joined), "known": known, "size": size, "bits": [math.log2(len(v) + 1) for v in joined.values()],
            "tables": [parse_table(coded(v, known).tolist(), size) for v in joined.values()]}


def hash_order(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())


def coded(a: np.ndarray, known: np.ndarray) -> np.ndarray:
    """1 + rank among the known code points, 0 for any other."""
    at = np.searchsorted(known, a)
    at[at == len(known)] = 0
    return np.where(known[at] == a, at + 1, 0)


def phrase_counts(lanes: list[np.ndarray], table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Phrases of every lane (sequences of codes), walked side by side."""
    cells, start = table
    order = np.argsort([-len(x) for x in lanes], kind="stable")
    lengths = np.array([len(lanes[i]) for i in order])
    flat = np.zeros((int(lengths[0]), len(lanes)), np.int32)
    for col, i in enumerate(order):
        flat[:lengths[col], col] = lanes[i]
    alive = np.searchsorted(-lengths, -np.arange(1, len(flat) + 1), side="right")
    state, ended = np.zeros(len(lanes), np.int64), np.ones(len(lanes), np.int64)
    for row, n in zip(flat, alive.tolist(), strict=True):
        v = cells[state[:n] + row[:n]]
        v = np.where(v >> 32 == state[:n], v & 0xFFFFFFFF, start[row[:n]])
        ended[:n] += v & 3
        state[:n] = v >> 2
    out = np.empty(len(lanes), np.int64)
    out[order] = ended
    return out


def predict_batch(texts: list[str | None], model: dict) -> tuple[list[str], list[float]]:
    langs, lanes, owner, sizes = model["langs"], [], [], np.zeros(len(texts))
    if langs:
        for i, t in enumerate(texts):
            a = squeezed(normalised(t)) if t else np.empty(0, np.uint32)
            if has_letter(a):
                codes = coded(a, model["known"]).astype(np.int32)
                sizes[i] = len(codes)
                for s in range(0, len(codes), SEGMENT):
                    lanes.append(codes[s:s + SEGMENT])
                    owner.append(i)
    if not lanes:
        return ["und"] * len(texts), [0.0] * len(texts)
    cost = np.stack([np.bincount(owner, phrase_counts(lanes, t) * b, len(texts)) for t, b in
                     zip(model["tables"], model["bits"], strict=True)]) / np.maximum(sizes, 1)
    best = np.argmin(cost, axis=0)
    low = cost.min(axis=0)
    share = 1 / np.exp2(-8 * (cost - low) / np.maximum(low, 1e-9)).sum(axis=0)
    return ([langs[b] if n else "und" for b, n in zip(best, sizes, strict=True)],
            [float(p) if n else 0.0 for p, n in zip(share, sizes, strict=True)])


def predict_languages(docs: DataFrame, model: dict) -> DataFrame:
    """Adds ``lang_pred`` and ``lang_score`` to every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(*[c for c in docs.columns if c not in ("lang_pred", "lang_score")])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", lang_pred string, lang_score double"

    def predict(batches):
        for batch in slices(batches, "text", 4 << 20):
            pred, score = predict_batch(batch.column("text").to_pylist(), held.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             names=[*batch.schema.names, "lang_pred", "lang_score"])

    return docs.mapInArrow(predict, schema)
