"""Toxicity by a weighted finite-state pattern grammar.

A lexicon tags the words of a clause as insult, threat, target, negation or
reported speech. Small transducers rewrite that tag sequence: the negation
transducer marks hits in its scope as denied, the reported-speech transducer
marks hits behind a reporting verb as quoted, the target transducer notes whom
the clause speaks to, and the insult and threat transducer turns marked hits
into the name of the matched clause. Arcs have weights, and ``compose`` folds the
machines into one whose weights add up, so a clause is read once and the weight of
its way through the machine is its score. A document is scored by its matched
clauses, never by isolated words: the weights are fitted on labelled documents and
stand on the arcs that end a clause.

The lexicon has a fixed part and a part learned from labels: words and word
beginnings that mark labelled documents, picked by greedy covering.

Null and empty texts have no clause and get the score of the intercept.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkq.plans.staging import stage

# The seed lexicon.
INSULTS = (
    "idiot moron scum clown trash stupid loser pathetic worthless disgusting "
    "imbecile dumbass scumbag bastard asshole bitch vermin filth retard"
).split()
THREATS = (
    "kill murder stab strangle shoot hang beat hurt destroy burn rape slaughter"
).split()
TARGETS = (
    "you your yours yourself u ur he she they him her them his their this these those "
    "du dich dir ihr euch tu toi vous te tú ti usted ustedes vosotros"
).split()
NEGATIONS = (
    "not no never neither nor nobody isn aren wasn weren don doesn didn won cannot "
    "nicht kein keine nie pas jamais nunca ningún"
).split()
REPORTS = (
    "said says say wrote writes called calls quoted quote quotes reported reports "
    "claimed allegedly according sagte schrieb dit écrit dijo escribió"
).split()

WORD = re.compile(r"[^\W\d_]+")
CLAUSE_END = re.compile(r"[.!?;\n]+")

Arc = tuple[object, str, float]  # next state, output symbol, weight


@dataclass(frozen=True)
class Transducer:
    """A sequential transducer: one arc per state and symbol, copying by default."""

    start: object
    arcs: Mapping[tuple[object, str], Arc]

    def step(self, state: object, symbol: str) -> Arc:
        return self.arcs.get((state, symbol), (state, symbol, 0.0))


def compose(first: Transducer, second: Transducer, symbols: Iterable[str]) -> Transducer:
    """The machine that feeds the output of ``first`` to ``second``; weights add up."""
    symbols = list(symbols)
    start = (first.start, second.start)
    arcs: dict[tuple[object, str], Arc] = {}
    todo, seen = [start], {start}
    while todo:
        p, q = todo.pop()
        for x in symbols:
            p2, y, w1 = first.step(p, x)
            q2, z, w2 = second.step(q, y)
            arcs[(p, q), x] = ((p2, q2), z, w1 + w2)
            if (p2, q2) not in seen:
                seen.add((p2, q2))
                todo.append((p2, q2))
    return Transducer(start, arcs)


TAGS = ("word", "insult", "weak", "threat", "target", "negation", "report", "end")
HITS = ("insult", "weak", "threat")


def negation_transducer(scope: int = 3) -> Transducer:
    """Hits up to ``scope`` words behind a negation become denied hits."""
    arcs: dict[tuple[object, str], Arc] = {}
    for left in range(scope + 1):
        after = max(left - 1, 0)
        for tag in TAGS:
            out = f"denied_{tag}" if tag in HITS and left else tag
            arcs[left, tag] = (after, out, 0.0)
        arcs[left, "negation"] = (scope, "negation", 0.0)
        arcs[left, "end"] = (0, "end", 0.0)
    return Transducer(0, arcs)


def report_transducer() -> Transducer:
    """Hits behind a reporting verb of the same clause become quoted hits."""
    arcs: dict[tuple[object, str], Arc] = {}
    arcs["plain", "report"] = ("quoting", "report", 0.0)
    arcs["quoting", "end"] = ("plain", "end", 0.0)
    for hit in HITS:
        for tag in (hit, f"denied_{hit}"):
            arcs["quoting", tag] = ("quoting", f"quoted_{hit}", 0.0)
    return Transducer("plain", arcs)


def target_transducer() -> Transducer:
    """The end of a clause that speaks to or of somebody becomes an aimed end."""
    return Transducer(
        "open",
        {
            ("open", "target"): ("aimed", "target", 0.0),
            ("aimed", "end"): ("open", "aimed_end", 0.0),
        },
    )


def clause_transducer(weights: Mapping[str, float]) -> Transducer:
    """Insults and threats: the strongest hit of a clause names the clause at its end,
    on an arc with the weight of that name.

    A threat needs a target; an unaimed threat word is no match. Weak hits (learned
    entries that also occur elsewhere) name a clause only if nothing else does.
    """
    rank = ["none", *(f"{how}_{hit}" for hit in ("weak", "threat", "insult") for how in ("quoted", "denied"))]
    rank += ["weak", "threat", "insult"]
    arcs: dict[tuple[object, str], Arc] = {}
    for i, best in enumerate(rank):
        for j, hit in enumerate(rank[1:], 1):
            arcs[best, hit] = (rank[max(i, j)], hit, 0.0)
        for end, aimed in (("end", False), ("aimed_end", True)):
            if best == "none" or (best.endswith("threat") and not aimed):
                name = ""
            elif best.endswith("weak"):
                name = "weak" if best == "weak" else ""
            else:
                name = f"{best}_aimed" if aimed and best in HITS else best
            arcs[best, end] = ("none", name, weights.get(name, 0.0))
    return Transducer("none", arcs)


# Clause names with the weight each has before any label is seen.
CLAUSES = {
    "insult_aimed": 4.0,
    "insult": 3.0,
    "threat_aimed": 3.0,
    "weak": 0.5,
    "denied_insult": 0.5,
    "quoted_insult": 0.5,
    "denied_threat": 0.2,
    "quoted_threat": 0.2,
}
NAMES = tuple(CLAUSES)
INTERCEPT = -3.0
# Counts above this are one: a document is not more toxic for being longer.
MOST = 3
# What the first, second and third clause of a name add of its weight.
SHARES = tuple(math.log2(1 + n) - math.log2(n) for n in range(1, MOST + 1))


def grammar(weights: Mapping[str, float] = CLAUSES) -> Transducer:
    machine = negation_transducer()
    for nxt in (report_transducer(), target_transducer(), clause_transducer(weights)):
        machine = compose(machine, nxt, TAGS)
    return machine


@dataclass
class Lexicon:
    """Whole words by tag, and word beginnings that tag as insults or weak insults."""

    words: dict[str, str] = field(default_factory=dict)
    beginnings: tuple[str, ...] = ()
    weak: tuple[str, ...] = ()

    @staticmethod
    def seed() -> Lexicon:
        groups = (
            ("report", REPORTS),
            ("negation", NEGATIONS),
            ("target", TARGETS),
            ("threat", THREATS),
            ("insult", INSULTS),
        )
        return Lexicon({w: tag for tag, words in groups for w in words})

    def learned(self, strong: Iterable[str], weak: Iterable[str]) -> Lexicon:
        """With entries of labelled texts; whole words are written with a leading "="."""
        strong, weak = list(strong), list(weak)
        words = {e[1:]: "weak" for e in weak if e[0] == "="}
        words |= {e[1:]: "insult" for e in strong if e[0] == "="}
        return Lexicon(
            self.words | words,
            tuple(e for e in strong if e[0] != "="),
            tuple(e for e in weak if e[0] != "="),
        )

    def tag(self, word: str) -> str:
        found = self.words.get(word)
        if found:
            return found
        if word.startswith(self.beginnings):
            return "insult"
        return "weak" if word.startswith(self.weak) else "word"


@dataclass
class Model:
    """Lexicon and clause weights; ``score`` maps clause counts to 0..1."""

    lexicon: Lexicon = field(default_factory=Lexicon.seed)
    weights: tuple[float, ...] = tuple(CLAUSES.values())
    intercept: float = INTERCEPT

    def machine(self) -> Transducer:
        """The grammar with the fitted weights on its arcs."""
        return grammar(dict(zip(NAMES, self.weights)))

    def score(self, matched: float) -> float:
        """0 to 1 for the weight of all matched clauses."""
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, self.intercept + matched))))


class Reader:
    """Matched clauses of texts. Only clauses that hold a hit word are read word by word."""

    def __init__(self, lexicon: Lexicon, machine: Transducer | None = None):
        self.lexicon = lexicon
        self.machine = machine or grammar()
        self.finder = ahocorasick.Automaton()
        hits = [w for w, tag in lexicon.words.items() if tag in HITS]
        for entry in [*hits, *lexicon.beginnings, *lexicon.weak]:
            self.finder.add_word(entry, len(entry))
        self.finder.make_automaton()

    def matches(self, text: str | None) -> Iterator[tuple[str, float]]:
        """Name and weight of each matched clause, in the order of the text."""
        if not text or not len(self.finder):
            return
        low = text.lower()
        done = -1
        for last, size in self.finder.iter(low):
            first = last - size + 1
            if first < done or (first and low[first - 1].isalpha()):
                continue
            begin = done if done > 0 else 0
            for end in CLAUSE_END.finditer(low, begin, first):
                begin = end.end()
            stop = CLAUSE_END.search(low, last + 1)
            done = stop.start() if stop else len(low)
            name, weight = self.read(low[begin:done])
            if name:
                yield name, weight

    def counts(self, text: str | None) -> tuple[int, ...]:
        found = Counter(name for name, _ in self.matches(text))
        return tuple(found[n] for n in NAMES)

    def weight(self, text: str | None) -> float:
        """Weights of the matched clauses; of clauses of one name the second and third
        add less, and further ones nothing."""
        seen: Counter[str] = Counter()
        total = 0.0
        for name, weight in self.matches(text):
            if seen[name] < MOST:
                total += weight * SHARES[seen[name]]
            seen[name] += 1
        return total

    def read(self, clause: str) -> tuple[str, float]:
        """What the machine makes of a clause: its name and the weights on the way."""
        state, tag, total = self.machine.start, self.lexicon.tag, 0.0
        for word in WORD.findall(clause):
            state, _, weight = self.machine.step(state, tag(word))
            total += weight
        _, name, weight = self.machine.step(state, "end")
        return name, total + weight

    def clause(self, clause: str) -> str:
        return self.read(clause)[0]


def toxicity_score(model: Model, text: Column) -> Column:
    """The score of each text as a double column."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(model.lexicon, model.machine())
        for texts in batches:
            yield pd.Series([model.score(reader.weight(t)) for t in texts], dtype=float)

    return score(text)


# Bound of the training sample: labelled texts taken of each label.
SAMPLE_PER_LABEL = 3000
BEGINNINGS = range(4, 10)


def _sample(texts: DataFrame, labels: DataFrame, per_label: int) -> DataFrame:
    """At most ``per_label`` distinct texts of each label, those of the smallest id hashes.

    Ids are chosen first; these few are broadcast, so that texts are not shuffled.
    """
    by_hash = F.xxhash64("doc_id")
    picked = [
        labels.where(F.col("label") == y).orderBy(by_hash, "doc_id").limit(per_label) for y in (0, 1)
    ]
    ids = F.broadcast(picked[0].unionByName(picked[1]))
    rows = texts.select("doc_id", "text").join(ids, "doc_id").select("text", "label").dropna()
    return stage(rows.dropDuplicates(), "toxicity-sample")


def entries(text: str) -> set[str]:
    """The words of a text (with a leading "=") and their beginnings."""
    words = set(WORD.findall(text.lower()))
    found = {"=" + w for w in words if len(w) > 2}
    return found | {w[:k] for w in words for k in BEGINNINGS if len(w) > k}


# Entries a task counts before it hands them on.
TASK_ENTRIES = 300_000


def _counted_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def table() -> pa.RecordBatch:
        names = sorted(counts[0].keys() | counts[1].keys())
        n_other, n_toxic = (pa.array([c[e] for e in names], pa.int64()) for c in counts)
        for c in counts:
            c.clear()
        return pa.record_batch(
            [pa.array(names, pa.string()), n_toxic, n_other], ["entry", "n_toxic", "n_other"]
        )

    for rows in batches:
        for label, text in zip(rows["label"].to_pylist(), rows["text"].to_pylist()):
            counts[label].update(entries(text))
            if len(counts[0]) + len(counts[1]) > TASK_ENTRIES:
                yield table()
    yield table()


def fit(texts: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Model:
    """Learn lexicon and weights from ``texts`` (doc_id, text) and ``labels`` (doc_id,
    label 0/1; an id that comes twice counts with its larger label).

    Uses a bounded sample of at most ``per_label`` distinct texts of each label;
    the intercept is then moved to the shares of the labels in all rows. Without
    both labels the weights stay at their defaults. Null texts and labels take no
    part. A strong entry hardly occurs in texts that are not toxic, a weak one at
    least five times less often than in toxic ones; both occur in so many toxic
    texts that chance hardly explains it.
    """
    labels = (
        labels.where(F.col("label").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("label").cast("int").alias("label"))
        .dropna()
    )
    shares = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    if not shares.get(0) or not shares.get(1):
        return Model()
    sample = _sample(texts, labels, per_label)
    taken = {y: min(per_label, shares[y]) for y in (0, 1)}
    share = taken[1] / (taken[0] + taken[1])
    support = max(4, math.ceil(-6 / math.log10(share)))
    marks = (
        sample.mapInArrow(_counted_entries, "entry string, n_toxic long, n_other long")
        .groupBy("entry")
        .agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_other").alias("n_other"))
        .where(
            (F.col("n_toxic") >= support)
            & ((F.col("n_toxic") + 0.5) * (taken[0] + 1) > 5 * (F.col("n_other") + 0.5) * (taken[1] + 1))
        )
        # Entries of the bounded sample that many of its texts share.
        .collect()
    )
    others = {r["entry"]: r["n_other"] for r in marks}

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [sorted(entries(t) & others.keys()) for t in rows["text"].to_pylist()]
            yield pa.record_batch([pa.array(found, pa.list_(pa.string()))], ["found"])

    texts = sample.where("label = 1").mapInArrow(marked, "found array<string>").collect()
    texts_of: dict[str, set[int]] = defaultdict(set)
    for i, row in enumerate(texts):
        for entry in row["found"]:
            texts_of[entry].add(i)
    strong = {e: n for e, n in others.items() if n * 20 <= len(texts_of[e])}
    chosen, depth = cover(strong, texts_of, support, Counter())
    rest = {e: n for e, n in others.items() if e not in strong}
    lexicon = Lexicon.seed().learned(chosen, cover(rest, texts_of, support, depth)[0])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(lexicon)
        for rows in batches:
            counts = [[min(c, MOST) for c in reader.counts(t)] for t in rows["text"].to_pylist()]
            yield pa.record_batch(
                [rows["label"], pa.array(counts, pa.list_(pa.int32()))], ["label", "counts"]
            )

    # One row for each combination of small counts: bounded by the grammar.
    table = (
        sample.mapInArrow(counted, "label int, counts array<int>")
        .groupBy("label", "counts")
        .count()
        .collect()
    )
    if {r["label"] for r in table} != {0, 1}:
        return Model(lexicon)
    model = _regression(lexicon, [(r["counts"], r["label"], r["count"]) for r in table])
    taken = {y: sum(r["count"] for r in table if r["label"] == y) for y in (0, 1)}
    shift = math.log(shares[1] / shares[0]) - math.log(taken[1] / taken[0])
    return Model(lexicon, model.weights, model.intercept + shift)


def cover(
    others: Mapping[str, int], texts_of: Mapping[str, set[int]], support: int, depth: Counter[int]
) -> tuple[list[str], Counter[int]]:
    """Greedy covering: the entry that marks most texts, until each is marked twice.

    ``others`` has the candidates with the number of other texts that hold them,
    ``depth`` how often texts are marked already. Returns the entries and the new
    depths. Between entries that cover alike the longer one wins, so that whole
    words go before their beginnings.
    """
    depth = Counter(depth)
    left = {e: {t for t in texts_of[e] if depth[t] < 2} for e in others}
    chosen: list[str] = []
    while True:
        left = {e: keys for e, keys in left.items() if len(keys) >= support}
        if not left:
            return sorted(chosen), depth
        best = max(left, key=lambda e: (len(left[e]) - 10 * others[e], len(e), e))
        keys = left.pop(best)
        chosen.append(best)
        depth.update(keys)
        full = {t for t in keys if depth[t] >= 2}
        # An entry that is part of the chosen one, or the reverse, says the same.
        stem = best.lstrip("=")
        left = {
            e: k - full
            for e, k in left.items()
            if not (e.lstrip("=").startswith(stem) or stem.startswith(e.lstrip("=")))
        }


def _regression(
    lexicon: Lexicon, table: Sequence[tuple[Sequence[int], int, int]], ridge: float = 0.05
) -> Model:
    """Logistic regression on counted clause combinations, drawn towards the defaults."""
    x = np.array([[1.0, *(math.log1p(c) / math.log(2) for c in counts)] for counts, _, _ in table])
    y = np.array([label for _, label, _ in table], dtype=float)
    n = np.array([count for _, _, count in table], dtype=float)
    prior = np.array([INTERCEPT, *CLAUSES.values()])
    pull = np.full(len(prior), ridge)
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (y - p)) - pull * (w - prior)
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(hessian, gradient)
        w += step * min(1.0, 4.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return Model(lexicon, tuple(float(v) for v in w[1:]), float(w[0]))
