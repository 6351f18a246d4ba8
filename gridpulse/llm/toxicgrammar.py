"""Toxicity by a weighted finite-state pattern grammar.

Texts are cut into clauses and words into classes. Four small transducers read a
clause's class sequence and are composed into one machine:

* reported speech marks everything after a verb of saying,
* negation marks the next ``SCOPE`` words after a negator,
* target tells the hits of a clause with a word of address from lone ones (a pass
  from the right brings a word of address that comes later to the clause's front),
* insult and threat turn marked hits into weights: full weight with a target or
  after another hit of the clause, clearly less for a lone hit, more for a threat
  that follows a hit.

A clause's score is the sum of its hits' lexical weights times the factors on the
composed machine's arcs. The factors are learned within ``CHOICES``: the machine
with a name on each arc in place of a number sums a text's weights by names, and
the likelihood of the labels, with a pull towards ``FACTORS``, chooses.
The lexical acceptor is a trie of words and stems: fixed seeds, and entries
learned from labelled rows by a log-likelihood test (a bounded sample,
``FIT_ROWS``), without those that only accompany stronger ones. A document's summed
clause scores become a probability by a logistic curve. Factors and curve are fitted
on rows that the lexicon did not see.

Defined results: null and empty texts have no clause and get the score of a
text without hits. Rows with a null id, text or label are not learned from;
labels of one class only give that class's value everywhere. Repeated rows score
alike; every input row gives one row. Extra columns are kept.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict, namedtuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import Memo, labelled_sample, slices, texts
from gridpulse.llm.nbsvm import logistic_fit

FOLDS, HELD = 4, 2
FIT_ROWS = 12_000
PIECE_BYTES, COUNTED = 1 << 20, 100_000  # of text, and entries with a count, that a task holds at a time
THRESHOLD = 0.3
SCOPE = 3
LEVEL = 25.0  # smallest likelihood gain (G2) of a learned entry
STEMS = range(3, 8)
# Factors of the arcs before learning, and what learning chooses from.
FACTORS = {"reported": 0.5, "negated": 0.4, "lone": 0.5, "repeated": 1.0, "escalated": 1.5}
CHOICES = {"reported": (0.1, 0.2, 0.35, 0.5, 0.7, 1.0), "negated": (0.1, 0.2, 0.4, 0.7, 1.0), "lone": (0.05, 0.1, 0.2, 0.35, 0.5, 0.7),
           "repeated": (1.0, 1.25, 1.5, 2.0), "escalated": (1.0, 1.5, 2.0, 3.0)}
PULL = 1.0

# Fixed word lists in English, German, French and Spanish.
THREATS = {"kill", "murder", "destroy", "strangle", "töten", "umbringen", "vernichten", "tuer", "détruire", "étrangler",
           "matar", "destruir", "estrangular"}
INSULTS = {"idiot", "moron", "imbecile", "dumbass", "scumbag", "dummkopf", "trottel", "vollidiot", "crétin", "imbécile",
           "connard", "idiota", "imbécil", "gilipollas"}
TARGETS = {"you", "your", "you're", "yours", "u", "du", "dich", "dir", "dein", "ihr", "euch", "tu", "toi", "te", "vous",
           "tes", "ton", "tú", "ti", "usted", "ustedes", "vosotros"}
NEGATORS = {"not", "no", "never", "isn't", "aren't", "don't", "nicht", "kein", "keine", "nie", "pas", "jamais", "ne",
            "nunca", "jamás", "tampoco"}
REPORTERS = {"said", "says", "claimed", "claims", "quoted", "reported", "called", "sagte", "behauptete", "zitierte",
             "berichtete", "disait", "déclara", "affirmait", "dijo", "afirmó", "citó", "declaró"}

Entry = namedtuple("Entry", "entry t c")
TOKEN = re.compile(r"[^\W_]+(?:'[^\W_]+)?|[.!?;:\n]+")
WORD = re.compile(r"[^\W\d_]+")
OTHER, INSULT, THREAT, TARGET, NEGATOR, REPORTER = range(6)
SYMBOLS = ("other", "insult", "threat", "target", "negator", "reporter")


class Marks(tuple):
    """Names of factors, as the weight of an arc: a product is the sorted list of
    both sides' names, the number 1 has none."""

    def __mul__(self, other):
        return Marks(sorted((*self, *(other if isinstance(other, tuple) else ()))))

    __rmul__ = __mul__


class Transducer:
    """Deterministic weighted transducer: ``arcs[state][symbol] = (output,
    factor, next state)``; symbols that a state lacks pass unchanged."""

    def __init__(self, arcs: dict[object, dict[str, tuple[str, float, object]]], start: object):
        self.arcs, self.start = arcs, start

    def step(self, state: object, symbol: str) -> tuple[str, float, object]:
        return self.arcs.get(state, {}).get(symbol, (symbol, 1.0, state))

    def compose(self, after: Transducer, symbols: tuple[str, ...] = SYMBOLS) -> Transducer:
        """The machine that feeds this one's output to ``after``."""
        start = (self.start, after.start)
        arcs, todo = {}, [start]
        while todo:
            state = todo.pop()
            if state in arcs:
                continue
            arcs[state] = {}
            for symbol in symbols:
                middle, w1, s1 = self.step(state[0], symbol)
                out, w2, s2 = after.step(state[1], middle)
                arcs[state][symbol] = (out, w1 * w2, (s1, s2))
                todo.append((s1, s2))
        return Transducer(arcs, start)


def reported_speech(factor: float = FACTORS["reported"]) -> Transducer:
    return Transducer({"own": {"reporter": ("reporter", 1.0, "said")},
                       "said": {"insult": ("insult", factor, "said"), "threat": ("threat", factor, "said")}}, "own")


def negation(factor: float = FACTORS["negated"], scope: int = SCOPE) -> Transducer:
    arcs: dict = {0: {"negator": ("negator", 1.0, scope)}}
    for left in range(1, scope + 1):
        arcs[left] = {s: (s, factor if s in ("insult", "threat") else 1.0, left - 1) for s in SYMBOLS}
        arcs[left]["negator"] = ("negator", 1.0, scope)
    return Transducer(arcs, 0)


def target() -> Transducer:
    """Hits before a word of address leave as lone ones."""
    return Transducer({"open": {"target": ("target", 1.0, "aimed"), "insult": ("lone insult", 1.0, "open"),
                                "threat": ("lone threat", 1.0, "open")}}, "open")


def hits(lone: float = FACTORS["lone"], repeated: float = FACTORS["repeated"], escalated: float = FACTORS["escalated"]) -> Transducer:
    """The first hit of a clause has full weight if it is aimed; a later one has it
    in any case, and a later threat more."""
    return Transducer({"calm": {"insult": ("hit", 1.0, "angry"), "threat": ("hit", 1.0, "angry"),
                                "lone insult": ("hit", lone, "angry"), "lone threat": ("hit", lone, "angry")},
                       "angry": {"insult": ("hit", repeated, "angry"), "lone insult": ("hit", repeated, "angry"),
                                 "threat": ("hit", escalated, "angry"), "lone threat": ("hit", escalated, "angry")}}, "calm")


def grammar(factors: dict = FACTORS) -> list[list[tuple]]:
    """The composed machine as ``table[state][class] = (factor, next state)``."""
    machine = (reported_speech(factors["reported"]).compose(negation(factors["negated"])).compose(target())
               .compose(hits(factors["lone"], factors["repeated"], factors["escalated"])))
    number = {s: i for i, s in enumerate([machine.start, *(s for s in machine.arcs if s != machine.start)])}
    table: list[list[tuple]] = [[] for _ in number]
    for state, arcs in machine.arcs.items():
        table[number[state]] = [(arcs[s][1], number[arcs[s][2]]) for s in SYMBOLS]
    return table


def marked_grammar() -> tuple[list[list[tuple]], list[tuple[str, ...]]]:
    """The machine with a unit vector for each product of factors in place of its
    number, and these products as lists of names."""
    table = grammar({name: Marks((name,)) for name in FACTORS})
    marks = sorted({tuple(w) if isinstance(w, tuple) else () for arcs in table for w, _ in arcs})
    unit = dict(zip(marks, np.eye(len(marks)), strict=True))
    return [[(unit[tuple(w) if isinstance(w, tuple) else ()], state) for w, state in arcs] for arcs in table], marks


def learned_factors(sums: np.ndarray, y: np.ndarray, marks: list[tuple[str, ...]], sweeps: int = 3) -> tuple[dict, float, float]:
    """Factors, slope and offset of greatest likelihood for the texts' weights by
    products of factors, one factor at a time; ties keep the choice nearest to
    ``FACTORS``."""
    def curve(factors):
        return logistic_fit(np.log1p(sums @ [math.prod(factors[n] for n in names) for names in marks]), y)

    def loss(factors):
        slope, offset = curve(factors)
        z = slope * np.log1p(sums @ [math.prod(factors[n] for n in names) for names in marks]) + offset
        return (np.logaddexp(0, z) - y * z).sum() + PULL * sum(math.log(f / FACTORS[n]) ** 2 for n, f in factors.items())

    factors = dict(FACTORS)
    for _ in range(sweeps):
        old = dict(factors)
        for name, choices in CHOICES.items():
            if any(name in names and sums[:, i].any() for i, names in enumerate(marks)):
                factors[name] = min(choices, key=lambda f: (round(loss(factors | {name: f}), 9), abs(math.log(f / FACTORS[name]))))
        if factors == old:
            break
    return factors, *curve(factors)


class Lexicon:
    """Word -> (class, weight); entries ending in ``$`` are whole words, the
    others stems. Looked-up words are kept per worker."""

    def __init__(self, entries: dict[str, float], keep: int = 100_000):
        self.entries, self.keep = entries, keep
        self.seen: dict[str, tuple[int, float]] = {}

    def look_up(self, word: str) -> tuple[int, float]:
        if not word[0].isalnum():
            return -1, 0.0  # a clause border
        weight = self.entries.get(word + "$", 0.0)
        for n in STEMS:
            if n <= len(word):
                weight = max(weight, self.entries.get(word[:n], 0.0))
        if weight:
            return (THREAT if word in THREATS else INSULT), weight
        for kind, ws in ((TARGET, TARGETS), (NEGATOR, NEGATORS), (REPORTER, REPORTERS)):
            if word in ws:
                return kind, 0.0
        return OTHER, 0.0

    def classes(self, tokens: list[str]) -> list[tuple[int, float]]:
        if len(self.seen) > self.keep:
            self.seen.clear()
        seen = self.seen
        for w in set(tokens).difference(seen):
            seen[w] = self.look_up(w)
        return [seen[w] for w in tokens]


def clause_scores(text: str, lexicon: Lexicon, table: list[list[tuple]]) -> list:
    """Scores of the clauses with a hit (vectors, with the marked machine)."""
    classes = lexicon.classes(TOKEN.findall(text.lower()))
    out, clause = [], 0
    found = [i for i, c in enumerate(classes) if c[1]]
    while clause < len(found):
        start = found[clause]
        while start and classes[start - 1][0] != -1:
            start -= 1
        stop = start
        while stop < len(classes) and classes[stop][0] != -1:
            stop += 1
        state, score = 0, 0.0
        if any(classes[i][0] == TARGET for i in range(found[clause], stop)):
            state = table[state][TARGET][1]
        for i in range(start, stop):
            kind, weight = classes[i]
            factor, state = table[state][kind]
            if weight:
                score = score + factor * weight
        out.append(score)
        while clause < len(found) and found[clause] < stop:
            clause += 1
    return out


def entries_of(text: str) -> set[str]:
    """Candidate lexicon entries of a text: its words and their stems."""
    out = set()
    for w in set(WORD.findall(text.lower())):
        if len(w) >= 3:
            out.add(w + "$")
            out.update(w[:n] for n in STEMS if n <= len(w))
    return out


def likelihood_gain(t: float, c: float, total_t: float, total_c: float) -> float:
    """G2 of an entry in t toxic and c clean texts against independence."""
    base = total_t / (total_t + total_c)
    own = t / (t + c)
    g = t * math.log(own / base)
    if c:
        g += c * math.log((1 - own) / (1 - base))
    return 2 * g if own > base else 0.0


def learned_entries(rows: list, totals: tuple[int, int]) -> dict[str, float]:
    """Significant entries with their log odds, best first; an entry that starts
    an accepted one, or that an accepted one starts, is left out."""
    total_t, total_c = totals
    if not total_t or not total_c:
        return {}
    gain = {r.entry: likelihood_gain(r.t, r.c, total_t, total_c) for r in rows}
    weight: dict[str, float] = {}
    starts: set[str] = set()
    for r in sorted(rows, key=lambda r: (-gain[r.entry], len(r.entry), r.entry)):
        word = r.entry.rstrip("$")
        if gain[r.entry] < LEVEL or r.entry in starts or any(word[:n] in weight for n in STEMS if n <= len(word)):
            continue
        weight[r.entry] = math.log((r.t + 0.5) / (total_t + 1)) - math.log((r.c + 0.5) / (total_c + 1))
        starts.update(word[:n] for n in STEMS if n <= len(word))
    return weight


def needed_entries(sample: DataFrame, entries: dict[str, float]) -> dict[str, float]:
    """Without the entries that only ride along: every text counts for its best
    entry alone, and an entry that is the best of more clean than toxic texts
    goes. ``entries`` are in order of their evidence."""
    rank = {e: i for i, e in enumerate(entries)}
    none = len(rank)

    def best(word: str) -> int:
        return min([rank.get(word + "$", none), *(rank.get(word[:n], none) for n in STEMS if n <= len(word))])

    def attribute(batches):
        seen = Memo(best, 50_000)
        for batch in slices(batches, "text", PIECE_BYTES):
            found = [min((seen[w] for w in set(WORD.findall(t.lower()))), default=none) for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), batch.column("y")], names=["place", "y"])

    counts = (sample.select("y", "text").mapInArrow(attribute, "place int, y int").groupBy("place")
              .agg(F.sum("y").alias("t"), F.count(F.lit(1)).alias("n")).collect())  # one row an entry
    gone = {r.place for r in counts if r.n > 2 * r.t}
    return {e: w for e, w in entries.items() if rank[e] not in gone}


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", fit_rows: int = FIT_ROWS,
                 folds: int = FOLDS, held: int = HELD) -> dict:
    """Lexicon and curve, from at most about ``fit_rows`` labelled rows."""
    sample = labelled_sample(docs, labels, label, folds, held, fit_rows)
    sample = sample.dropDuplicates(["text"]).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(5)) == 0).persist()
    totals = {(r.y, r.part): r.n for r in sample.groupBy("y", "part").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_t, n_c = (sum(n for (y, _), n in totals.items() if (y > 0) == want) for want in (True, False))
    if not n_t or not n_c:
        sample.unpersist()
        return {"constant": float(n_t > 0) if n_t or n_c else 0.0}

    def count(batches):
        counts: defaultdict = defaultdict(Counter)  # by label and part
        for batch in slices(batches, "text", PIECE_BYTES):
            for y, part, text in zip(*(batch.column(c).to_pylist() for c in ("y", "part", "text")), strict=True):
                counts[y > 0, part].update(entries_of(text))
                if sum(map(len, counts.values())) > COUNTED:
                    yield from flushed(counts)
                    counts.clear()
        yield from flushed(counts)

    def flushed(counts):
        for (y, part), found in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array([y] * len(found)), pa.array([part] * len(found)),
                                              pa.array(found.values(), pa.int64())], names=["entry", "toxic", "part", "n"])

    def when(toxic, n):
        return F.sum(F.when(F.col("toxic") if toxic else ~F.col("toxic"), n).otherwise(0))

    found = sample.mapInArrow(count, "entry string, toxic boolean, part boolean, n long").groupBy("entry").agg(
        when(True, F.col("n")).alias("t"), when(False, F.col("n")).alias("c"),
        when(True, F.when(~F.col("part"), F.col("n")).otherwise(0)).alias("t0"),
        when(False, F.when(~F.col("part"), F.col("n")).otherwise(0)).alias("c0"))
    # Bounded: significant entries of a bounded sample.
    share, base = F.col("t") / (F.col("t") + F.col("c")), n_t / (n_t + n_c)
    gain = 2 * (F.col("t") * F.log(share / base) + F.when(F.col("c") > 0, F.col("c") * F.log((1 - share) / (1 - base))).otherwise(0))
    rows = found.where((F.col("t") >= 3) & (share > base) & (gain >= 0.7 * LEVEL)).collect()
    seeds = {w + "$": 4.0 for w in THREATS | INSULTS}
    part_rows = [Entry(r.entry, r.t0, r.c0) for r in rows if r.t0 >= 3]
    own = totals.get((1, False), 0), totals.get((0, False), 0)
    first = seeds | needed_entries(sample.where(~F.col("part")), learned_entries(part_rows, own))
    entries = seeds | needed_entries(sample, learned_entries(rows, (n_t, n_c)))
    table, marks = marked_grammar()

    def held_sums(batches):
        lexicon, none = Lexicon(first), np.zeros(len(marks))
        for batch in slices(batches, "text", PIECE_BYTES):
            sums = [sum(clause_scores(t, lexicon, table), none).tolist() for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(sums, pa.list_(pa.float64()))], names=["y", "sums"])

    got = sample.where("part").mapInArrow(held_sums, "y int, sums array<double>").collect()  # a row a sampled text, a number a mark
    sample.unpersist()
    y, sums = np.array([r.y for r in got], float), np.array([r.sums for r in got]).reshape(len(got), len(marks))
    factors, slope, offset = learned_factors(sums, y, marks) if len(y) and y.min() != y.max() else (FACTORS, 2.0, -2.0)
    return {"entries": entries, "factors": factors, "slope": slope, "offset": offset}


def score_toxicity(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """Adds ``toxic_score``, ``toxic_pred`` and ``toxic_clauses`` (the number of
    clauses that the grammar matched) to every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    own = ["toxic_score", "toxic_pred", "toxic_clauses"]
    docs = docs.select(*[c for c in docs.columns if c not in own])
    schema = (", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
              + ", toxic_score double, toxic_pred int, toxic_clauses int")

    def score(batches):
        m = held.value
        table = grammar(m.get("factors", FACTORS))
        lexicon = Lexicon(m.get("entries", {}))
        for batch in slices(batches, "text", PIECE_BYTES):
            scores, matched = [], []
            for t in texts(batch.column("text")):
                clauses = clause_scores(t, lexicon, table)
                z = 0.0 if "constant" in m else m["slope"] * math.log1p(sum(clauses)) + m["offset"]
                scores.append(m["constant"] if "constant" in m else 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
                matched.append(len(clauses))
            s = np.array(scores)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32)), pa.array(matched, pa.int32())],
                names=[*batch.schema.names, *own])

    return docs.mapInArrow(score, schema)
