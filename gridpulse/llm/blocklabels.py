"""Main-text extraction by a recurrent block labeller.

A page is read as its sequence of leaf blocks (runs of text between block-level
tags). A block is a vector of its tag path (hashed tags, class and id words),
its words (hashed) and its length, link share and place. A bidirectional LSTM in
numpy reads the whole sequence and labels every block with the context of the
document; the kept blocks are the main text.

The network is trained here on a bounded sample of pages (``FIT_PAGES``), on the
blocks whose tag path says what they are: inside ``article`` or ``main`` and in
nothing else of its kind is text; inside menus, headers outside the article,
footers, sidebars, forms, adverts, notices or comments is not. Blocks whose path
says nothing are not learned from, only labelled. In training these path hints
are dropped at random, so that words, lengths and neighbours count too.

Defined results: null and empty html give no blocks and the empty text. Markup
that is cut off is read as far as it goes. Without any block to learn from,
blocks are kept unless their path says that they are no text. Repeated pages
give the same text, a row each. Extra columns are kept.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import defaultdict, namedtuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import bounded_sample, slices, texts

FIT_PAGES = 320
FIT_PAGE_CHARS = 100_000
PATH_DIM, WORD_DIM, HIDDEN = 64, 32, 16
HINTS, SHAPE = 2, 5
DIM = PATH_DIM + WORD_DIM + HINTS + SHAPE

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*>|</?[A-Za-z][^<>]*>?", re.S)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"[A-Za-z]+")

# Element kinds of HTML.
BLOCK = set("address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption "
            "figure footer form h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol option p pre section "
            "select summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style template noscript textarea title svg iframe object head".split())
CLOSED_BY = {"p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
             "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
# Names that say what a block is not.
ASIDE_TAGS = set("nav footer aside form button select menu dialog label".split())
ASIDE_WORDS = set("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments commentlist consent "
                  "cookie cookies disclaimer discussion disqus footer form gdpr login menu modal nav navbar navigation "
                  "newsletter notice notices pagination popup promo promotion related reply replies respond search share "
                  "sharing sidebar signup social sponsor sponsored subscribe tags toolbar widget".split())
TEXT_TAGS = {"article", "main"}
TEXT_WORDS = set("article articlebody content entry main post story text body".split())


# What the open tags' names amount to: a bit a hash bucket of the names, and 1 if the
# path says text, -1 if it says no text, 0 if it says nothing.
Path = namedtuple("Path", "buckets hint")


def below(path: Path, name: str) -> Path:
    """The path with one more tag or class word (after a dot)."""
    buckets, inside = path.buckets | 1 << zlib.crc32(name.encode()) % PATH_DIM, path.hint
    if inside >= 0:
        word = name[1:] if name[0] == "." else ""
        if name in ASIDE_TAGS or word in ASIDE_WORDS or (name == "header" and not inside):
            inside = -1
        elif name in TEXT_TAGS or word in TEXT_WORDS:
            inside = 1
    return Path(buckets, inside)


def blocks_of(page: str) -> list[tuple[Path, str, int]]:
    """(path, text, characters inside links) of each leaf block in page order. Every
    open tag carries its path, and open tags are found by name, so that deep nesting
    costs no more than flat markup."""
    out: list[tuple[Path, str, int]] = []
    stack: list[tuple[str, Path]] = []
    places: dict[str, list[int]] = defaultdict(list)  # of the open tags by name
    blocks: list[int] = []  # places of the open block tags
    buffer: list[str] = []
    linked, at, size, head_ends = 0, 0, len(page), True

    def opened(tag: str, path: Path) -> None:
        places[tag].append(len(stack))
        if tag in BLOCK:
            blocks.append(len(stack))
        stack.append((tag, path))

    def close(depth: int) -> None:
        while len(stack) > depth:
            tag, _ = stack.pop()
            places[tag].pop()
            if tag in BLOCK:
                blocks.pop()

    def add(piece: str) -> None:
        nonlocal linked
        if "&" in piece:
            piece = entities.unescape(piece)
        buffer.append(piece)
        if places["a"]:
            linked += len(piece.strip())

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(buffer).split())
        if text:
            out.append((stack[-1][1] if stack else Path(0, 0), text, linked))
        buffer.clear()
        linked = 0

    while at < size:
        mark = page.find("<", at)
        m = MARKUP.match(page, mark) if mark >= 0 else None
        if m is None:  # text up to here, or a "<" that opens nothing
            end = size if mark < 0 else mark + 1
            add(page[at:end])
            at = end
            continue
        if mark > at:
            add(page[at:mark])
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):  # an end tag closes up to its start tag, if there is one
            if tag in BLOCK:
                flush()
            # an inline end tag does not close blocks
            if places[tag] and (tag in BLOCK or not blocks or blocks[-1] < places[tag][-1]):
                close(places[tag][-1])
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at) if tag != "head" or head_ends else None
            if tag == "head" and end is None:
                head_ends = False
                continue
            if not m.group(3).rstrip().endswith("/"):
                at = end.end() if end else size
            continue
        if tag == "br":
            buffer.append(" ")
        if tag in BLOCK:
            flush()
            close(blocks[-1] + 1 if blocks else 0)  # inline tags left open
            if stack and tag in CLOSED_BY.get(stack[-1][0], ()):
                close(blocks[-1])
                close(blocks[-1] + 1 if blocks else 0)
        if tag in VOID or m.group(3).rstrip().endswith("/"):
            continue
        path = below(stack[-1][1] if stack else Path(0, 0), tag)
        for n in NAMED.finditer(m.group(3)):
            for w in WORD.findall(n.group(1) or n.group(2) or n.group(3) or ""):
                path = below(path, "." + w.lower())
        opened(tag, path)
    flush()
    return out


class WordBuckets(dict):
    """Word -> hash bucket, filled on demand."""

    def __missing__(self, word: str) -> int:
        self[word] = bucket = zlib.crc32(word.lower().encode("utf-8", "replace")) % WORD_DIM
        return bucket


class Vectors:
    """Block vectors; hashes of words and paths are kept per worker."""

    def __init__(self, keep: int = 300_000):
        self.words = WordBuckets()
        self.paths: dict[Path, np.ndarray] = {}
        self.keep = keep

    def path(self, path: Path) -> np.ndarray:
        v = self.paths.get(path)
        if v is None:
            if len(self.paths) > 20_000:
                self.paths.clear()
            v = np.zeros(PATH_DIM + HINTS, np.float32)
            v[:PATH_DIM] = [path.buckets >> i & 1 for i in range(PATH_DIM)]
            v[PATH_DIM], v[PATH_DIM + 1] = path.hint > 0, path.hint < 0
            self.paths[path] = v
        return v

    def __call__(self, blocks: list[tuple[Path, str, int]]) -> np.ndarray:
        n = len(blocks)
        out = np.zeros((n, DIM), np.float32)
        if not n:
            return out
        if len(self.words) > self.keep:
            self.words.clear()
        tokens = [text.split(" ") for _, text, _ in blocks]
        sizes = np.array([len(t) for t in tokens])
        flat = [w for t in tokens for w in t]
        codes = np.fromiter(map(self.words.__getitem__, flat), np.int64, len(flat))
        counts = np.bincount(np.repeat(np.arange(n) * WORD_DIM, sizes) + codes, minlength=n * WORD_DIM)
        chars = np.array([len(text) for _, text, _ in blocks])
        out[:, :PATH_DIM + HINTS] = [self.path(path) for path, _, _ in blocks]
        out[:, PATH_DIM + HINTS:-SHAPE] = counts.reshape(n, WORD_DIM) / sizes[:, None]
        out[:, -SHAPE] = np.log1p(chars) / 6
        out[:, -SHAPE + 1] = np.minimum(1.0, np.array([linked for _, _, linked in blocks]) / chars)
        out[:, -SHAPE + 2] = np.arange(n) / n
        out[:, -SHAPE + 3] = np.log1p(sizes) / 4
        out[:, -SHAPE + 4] = [text[-1] in ".!?" for _, text, _ in blocks]
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_network(rng: np.random.Generator) -> dict[str, np.ndarray]:
    net = {}
    for d in ("f", "b"):
        net["W" + d] = (rng.standard_normal((DIM, 4 * HIDDEN)) / np.sqrt(DIM)).astype(np.float32)
        net["U" + d] = (rng.standard_normal((HIDDEN, 4 * HIDDEN)) / np.sqrt(HIDDEN)).astype(np.float32)
        net["c" + d] = np.zeros(4 * HIDDEN, np.float32)
        net["c" + d][HIDDEN:2 * HIDDEN] = 1.0  # the forget gate starts open
    net["v"] = (rng.standard_normal(2 * HIDDEN) / np.sqrt(2 * HIDDEN)).astype(np.float32)
    net["o"] = np.zeros(1, np.float32)
    return net


def lstm(x: np.ndarray, mask: np.ndarray, w: np.ndarray, u: np.ndarray, c0: np.ndarray, keep: bool):
    """States of one direction over (time, page, dim); masked steps carry on."""
    h, c = np.zeros((x.shape[1], HIDDEN), np.float32), np.zeros((x.shape[1], HIDDEN), np.float32)
    z, out, cache = x @ w + c0, np.empty((*x.shape[:2], HIDDEN), np.float32), []
    for t in range(len(x)):
        a = z[t] + h @ u
        s = sigmoid(a[:, :3 * HIDDEN])
        i, f, o = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:]
        g = np.tanh(a[:, 3 * HIDDEN:])
        m = mask[t][:, None]
        c_new = f * c + i * g
        tanh_c = np.tanh(c_new)
        if keep:
            cache.append((h, c, i, f, o, g, tanh_c, m))
        h, c = np.where(m, o * tanh_c, h), np.where(m, c_new, c)
        out[t] = h
    return out, cache


def lstm_back(x: np.ndarray, d_out: np.ndarray, cache: list, u: np.ndarray):
    """Gradients of w, u and the bias by back-propagation through time."""
    d_z = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
    d_u = np.zeros_like(u)
    d_h, d_c = np.zeros(d_out.shape[1:], np.float32), np.zeros(d_out.shape[1:], np.float32)
    for t in range(len(x) - 1, -1, -1):
        h, c, i, f, o, g, tanh_c, m = cache[t]
        d_h = d_h + d_out[t]
        own_h, own_c = d_h * m, d_c * m + d_h * m * o * (1 - tanh_c ** 2)
        a = np.concatenate([own_c * g * i * (1 - i), own_c * c * f * (1 - f), own_h * tanh_c * o * (1 - o),
                            own_c * i * (1 - g ** 2)], axis=1)
        d_z[t] = a
        d_u += h.T @ a
        d_h, d_c = a @ u.T + d_h * ~m, own_c * f + d_c * ~m
    flat = d_z.reshape(-1, d_z.shape[-1])
    return x.reshape(-1, x.shape[-1]).T @ flat, d_u, flat.sum(0)


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, pages))
    x, mask = np.zeros((longest, len(pages), DIM), np.float32), np.zeros((longest, len(pages)), bool)
    for i, p in enumerate(pages):
        x[:len(p), i], mask[:len(p), i] = p, True
    return x, mask


def scores(pages: list[np.ndarray], net: dict[str, np.ndarray]) -> list[np.ndarray]:
    """Probability of text for every block; pages go together by length."""
    out: list[np.ndarray] = [np.empty(0)] * len(pages)
    order = [i for i in np.argsort([len(p) for p in pages], kind="stable") if len(pages[i])]
    while order:
        take = max(1, min(64, 200_000 // (len(pages[order[-1]]) * 8 + 1)))
        own, order = order[-take:], order[:-take]
        x, mask = padded([pages[i] for i in own])
        hf, _ = lstm(x, mask, net["Wf"], net["Uf"], net["cf"], False)
        hb, _ = lstm(x[::-1], mask[::-1], net["Wb"], net["Ub"], net["cb"], False)
        p = sigmoid(hf @ net["v"][:HIDDEN] + hb[::-1] @ net["v"][HIDDEN:] + net["o"])
        for col, i in enumerate(own):
            out[i] = p[:len(pages[i]), col]
    return out


def train(pages: list[np.ndarray], marks: list[np.ndarray], epochs: int = 14, batch: int = 16, rate: float = 0.01,
          seed: int = 5) -> dict[str, np.ndarray]:
    """Adam on the mean logistic loss of marked blocks (mark 0: not learned from)."""
    rng = np.random.default_rng(seed)
    net = new_network(rng)
    m1, m2 = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))
    by_length, step = np.argsort([len(p) for p in pages], kind="stable"), 0
    groups = [by_length[i:i + batch] for i in range(0, len(by_length), batch)]
    for _ in range(epochs):
        for at in rng.permutation(len(groups)):
            x, mask = padded([pages[i] for i in groups[at]])
            y, known = np.zeros(mask.shape, np.float32), np.zeros(mask.shape, bool)
            for col, i in enumerate(groups[at]):
                y[:len(marks[i]), col], known[:len(marks[i]), col] = marks[i] > 0, marks[i] != 0
            if not known.any():
                continue
            hide = rng.random(mask.shape[1]) < 0.35  # pages that are read without hints
            x[:, hide, PATH_DIM:PATH_DIM + HINTS] = 0
            x[:, rng.random(mask.shape[1]) < 0.2, :PATH_DIM] = 0
            hf, kf = lstm(x, mask, net["Wf"], net["Uf"], net["cf"], True)
            hb, kb = lstm(x[::-1], mask[::-1], net["Wb"], net["Ub"], net["cb"], True)
            h = np.concatenate([hf, hb[::-1]], axis=2)
            d = np.where(known, sigmoid(h @ net["v"] + net["o"]) - y, 0) / known.sum()
            grads = {"v": (h * d[..., None]).sum((0, 1)), "o": d.sum(keepdims=True).ravel()}
            d_h = d[..., None].astype(np.float32) * net["v"]
            grads["Wf"], grads["Uf"], grads["cf"] = lstm_back(x, d_h[..., :HIDDEN], kf, net["Uf"])
            grads["Wb"], grads["Ub"], grads["cb"] = lstm_back(x[::-1], d_h[::-1, :, HIDDEN:], kb, net["Ub"])
            step += 1
            for k, g in grads.items():
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.999 * m2[k] + 0.001 * g * g
                net[k] = (net[k] - rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def fit_labeller(pages: DataFrame, fit_pages: int = FIT_PAGES) -> dict[str, np.ndarray]:
    """Train on at most about ``fit_pages`` pages of bounded length."""
    usable = pages.where(F.length("html").between(1, FIT_PAGE_CHARS)).select("page_id", "html")
    got = sorted((r.page_id is None, r.page_id or 0, r.html) for r in bounded_sample(usable, ["page_id", "html"], fit_pages).collect())
    vectors = Vectors()
    found = [blocks_of(page) for _, _, page in got]
    marks = [np.array([path.hint for path, _, _ in b]) for b in found if b]
    if not any((m > 0).any() for m in marks):
        return {}
    return train([vectors(b) for b in found if b], marks)


def main_texts(pages: list[str], net: dict[str, np.ndarray], vectors: Vectors) -> list[str]:
    found = [blocks_of(p) for p in pages]
    if net:
        kept = [s >= 0.5 for s in scores([vectors(b) for b in found], net)]
    else:
        kept = [np.array([path.hint >= 0 for path, _, _ in b]) for b in found]
    return ["\n".join(text for (_, text, _), k in zip(b, ks, strict=True) if k) for b, ks in zip(found, kept, strict=True)]


def extract_main_text(pages: DataFrame, net: dict[str, np.ndarray]) -> DataFrame:
    """Adds ``main_text`` to every row."""
    held = pages.sparkSession.sparkContext.broadcast(net)
    pages = pages.select(*[c for c in pages.columns if c != "main_text"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema) + ", main_text string"

    def label(batches):
        vectors = Vectors()
        for batch in slices(batches, "html", 2 << 20):
            text = main_texts(texts(batch.column("html")), held.value, vectors)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())], names=[*batch.schema.names, "main_text"])

    return pages.mapInArrow(label, schema)
