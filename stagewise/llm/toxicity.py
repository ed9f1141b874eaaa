"""Toxicity: Levenshtein automata over a lexicon trie, with context windows.

The lexicon is learned: words whose contexts (distinct pairs of neighbours)
are far more frequent in toxic than in clean training texts.  Counting
contexts, not documents, keeps copies of one toxic text from teaching its
ordinary words.  The lexicon is a trie; the Levenshtein automaton of every
term runs on it at once, as sets of (trie node, edits), determinised on
demand.  A text's word that it accepts is a hit, exact or misspelled.  The
words around a hit decide whether it is quoted or used: quotation marks, paired
off as they open and close, and reporting verbs against second-person address.  A logistic model of the
exact, misspelled and quoted hits gives the score.

Both fits use a bounded sample of training rows (``SAMPLE`` of either label),
weighted by the count of each label over all training rows, so that a score
and ``CUT`` mean the same at every size; every document is scored, whole.
Terms have ``LEAST_LETTERS`` letters at least; if more than ``LEXICON`` words
pass the odds, those with the most toxic contexts are the terms, because the
trie is broadcast.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.llm.common import crc_mod, cut, plus

SAMPLE, LEXICON, SUPPORT, RATIO = 10_000, 4096, 6, 20.0
LEAST_LETTERS, REACH, CUT = 4, 8, 0.3
FOLDS, HELD_OUT = 4, 2

# Words that report or address.
REPORTS = frozenset("said says say quote quoted quotes wrote writes called calls term word words sagte sagt schrieb wort zitat dit mot dijo dice palabra cita".split())
ADDRESS = frozenset("you your youre you're yourself du dich dein deine ihr euch tu te toi ton vous votre tú tu usted ustedes".split())
QUOTES = "\"“”„«»‹›"
EDGES = ".,;:!?()[]{}<>*#$%&|…'’`~^_=+-/\\" + QUOTES


def strip(token: str) -> str:
    return token.lower().strip(EDGES)


def edits(term: str) -> int:
    """Misspellings allowed in a term."""
    return 0 if len(term) < 5 else 1 if len(term) < 10 else 2


class Automaton:
    """All terms' Levenshtein automata run on one trie; a state is the frozenset of (node, edits made)."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.budget = [0]  # the most edits any term below a node allows
        for t in sorted(terms):
            at, b = 0, edits(t)
            self.budget[0] = max(self.budget[0], b)
            for c in t:
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.budget.append(0)
                at = self.children[at][c]
                self.budget[at] = max(self.budget[at], b)
            self.term[at] = t
        self.steps: dict[tuple, frozenset | None] = {}
        self.start = self._close({0: 0})

    def _close(self, state: dict[int, int]) -> frozenset | None:
        """With letters of a term left out; only the fewest edits of a node count."""
        todo = list(state.items())
        while todo:
            node, e = todo.pop()
            for child in self.children[node].values():
                if e + 1 <= self.budget[child] and state.get(child, 99) > e + 1:
                    state[child] = e + 1
                    todo.append((child, e + 1))
        return frozenset(state.items()) or None

    def step(self, state: frozenset, c: str) -> frozenset | None:
        out: dict[int, int] = {}
        for node, e in state:
            for d, child in self.children[node].items():
                cost = e + (d != c)
                if cost <= self.budget[child] and out.get(child, 99) > cost:
                    out[child] = cost
            if e + 1 <= self.budget[node] and out.get(node, 99) > e + 1:
                out[node] = e + 1  # a letter too many
        return self._close(out)

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its edits, ties by the term; null if none is near enough."""
        state, steps = self.start, self.steps
        for c in word:
            key = (state, c)
            if key not in steps:
                if len(steps) > 200_000:
                    steps.clear()
                steps[key] = self.step(state, c)
            state = steps[key]
            if state is None:
                return None
        best = min(((e, self.term[n]) for n, e in state if self.term[n] is not None and e <= edits(self.term[n])), default=None)
        return best and (best[1], best[0])


class Matches(dict):
    """Token -> (term, edits) or None, kept up to a bound."""

    def __init__(self, automaton: Automaton, most: int = 300_000):
        self.automaton, self.most = automaton, most

    def __missing__(self, token: str):
        if len(self) >= self.most:
            self.clear()
        word = strip(token)
        found = self[token] = self.automaton.match(word) if len(word) >= LEAST_LETTERS - 1 else None
        return found


#: The marks that close what a mark opened.
CLOSES = {'"': '"', "“": "”", "„": "“”", "«": "»", "»": "«", "‹": "›", "›": "‹"}


def quotations(words: list[str]) -> list[tuple[int, int]]:
    """First and last word of each quotation; a mark that nothing closes within twice ``REACH`` words opens none."""
    spans, opened = [], []  # (mark, word) still open
    for i, w in enumerate(words):
        for c in w:
            if c in QUOTES:
                opened = [(m, at) for m, at in opened if i - at <= 2 * REACH]
                k = next((k for k in range(len(opened) - 1, -1, -1) if c in CLOSES[opened[k][0]]), None)
                if k is not None:
                    spans.append((opened[k][1], i))
                    del opened[k:]
                elif c in CLOSES:
                    opened.append((c, i))
    return spans


def features(text: str, matches: Matches, weights: dict[str, float]) -> list[float]:
    """Weighted exact, misspelled and quoted hits of a text, and its strongest used hit."""
    words = text.split()
    exact = fuzzy = quoted = strongest = 0.0
    hits = [(i, m) for i, w in enumerate(words) if (m := matches[w]) is not None]
    inside = {i for s, e in (quotations(words) if hits else ()) for i in range(s, e + 1)}
    for i, found in hits:
        term, e = found
        w = weights[term]
        window = words[max(0, i - REACH):i + REACH + 1]
        near = {strip(x) for x in window}
        used = 1.0 - 0.75 * (i in inside) - 0.2 * bool(near & REPORTS) + 0.25 * bool(near & ADDRESS)
        if used < 0.5:
            quoted += w
        elif e:
            fuzzy += w * used
        else:
            exact += w * used
        strongest = max(strongest, w * used / (1 + 2 * e) if used >= 0.5 else 0.0)
    return [math.log1p(exact), math.log1p(fuzzy), math.log1p(quoted), strongest]


N_FEATURES = 4


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, rounds: int = 50, each: np.ndarray | None = None) -> np.ndarray:
    """Weights of a logistic model, the last for 1, by Newton steps; ``each`` is how many rows a row stands for."""
    z = np.c_[x, np.ones(len(x))]
    each = np.ones(len(x)) if each is None else each / each.mean()
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (each * p * (1 - p))[:, None]).T @ z / len(z) + l2 * np.eye(len(w))
        step = np.linalg.solve(h, z.T @ (each * (p - y)) / len(z) + l2 * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of all training ids; ids with both labels go."""
    rows = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_mod("doc_id", FOLDS) != HELD_OUT))
    return rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("top")).where("toxic = top").drop("top")


def training_ids(ids: DataFrame) -> DataFrame:
    """At most ``SAMPLE`` of ``labelled``'s rows of either label, in the order of their hash."""
    first = lambda v: ids.where(F.col("toxic") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    return first(0).unionByName(first(1))


def stands_for(ids: DataFrame) -> dict[int, float]:
    """How many training ids of a label each of its sampled ids stands for: 1 where all are sampled."""
    return {int(r["toxic"]): max(1.0, r["n"] / SAMPLE) for r in ids.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}


def learn(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], np.ndarray]:
    """The lexicon with its weights, and the logistic model."""
    every = cut(labelled(labels), "labelled")
    each = stands_for(every)
    ids = F.broadcast(training_ids(every))
    train = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(ids, "doc_id"), "training")

    def contexts(batches):
        for b in batches:
            rows: set[tuple[str, int, int]] = set()
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ws = [strip(w) for w in text.split()]
                for before, w, after in zip(["", *ws], ws, [*ws[1:], ""]):
                    if len(w) >= LEAST_LETTERS:
                        rows.add((w, hash_pair(before, after), toxic))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int32()))], names=["word", "context", "toxic"])

    seen = train.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(contexts, "word string, context long, toxic int")
    seen = seen.groupBy("word", "context").agg(F.max("toxic").alias("toxic"), F.min("toxic").alias("clean"))
    counts = cut(seen.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("clean")).alias("c")), "words")
    all_t, all_c = counts.agg(F.coalesce(F.sum("t"), F.lit(0)), F.coalesce(F.sum("c"), F.lit(0))).first()
    odds = F.log((F.col("t") + 0.5) / (all_t + 1.0)) - F.log((F.col("c") + 0.5) / (all_c + 1.0))
    top = counts.where(F.col("t") >= SUPPORT).withColumn("odds", odds).where(F.col("odds") >= math.log(RATIO)).orderBy(F.desc("t"), "word").limit(LEXICON)
    lexicon = {r["word"]: float(r["odds"]) for r in top.collect()}
    most = max(lexicon.values(), default=1.0)
    lexicon = {w: v / most for w, v in lexicon.items()}
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def hits(batches):
        matches = Matches(Automaton(list(shared.value)))
        for b in batches:
            rows = [features(t, matches, shared.value) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), b.column(1)], names=["x", "toxic"])

    rows = train.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(hits, "x array<double>, toxic int").toArrow()
    x, y = np.array(rows["x"].to_pylist(), float).reshape(-1, N_FEATURES), np.array(rows["toxic"].to_pylist(), float)
    if not len(y) or y.min() == y.max():
        return lexicon, np.r_[np.zeros(N_FEATURES), -3.0 if not len(y) or not y[0] else 3.0]
    return lexicon, fit_logistic(x, y, each=np.where(y > 0, each[1], each[0]))


def hash_pair(a: str, b: str) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(f"{a}\n{b}") >> 1


def _scored(docs: DataFrame, model: tuple[dict[str, float], np.ndarray], passes: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    w = model[1]

    def run(batches):
        lexicon = shared.value[0]
        matches = Matches(Automaton(list(lexicon)))
        for b in batches:
            texts = b.column(b.schema.get_field_index("text")).cast(pa.string()).to_pylist()
            x = np.array([features(t or "", matches, lexicon) for t in texts]).reshape(-1, N_FEATURES)
            score = np.round(1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30))), 9)
            if passes:
                yield b.filter(pa.array(score < CUT))
            else:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score), pa.array((score >= CUT).astype(np.int32))], names=["doc_id", "score", "predicted"])

    if passes:
        return docs.mapInArrow(run, docs.schema)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, plus(rows.select("doc_id").schema, "score double, predicted int"))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text, ...).

    Labels are learned only from rows whose crc32(doc_id as text) mod 4 isn't
    2; rows with a null id or label, and ids with both labels, aren't learned
    from.  The score depends on the text alone; null and empty texts score
    like a text without hits.  Repeated rows are scored one by one.  Without
    training rows every score is that of the model's constant.  An empty
    table gives no rows; other columns are not read.
    """
    out = _scored(docs, learn(docs, labels), passes=False)
    return out.select("doc_id", (crc_mod("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", "predicted")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns stay."""
    return _scored(docs, learn(docs, labels), passes=True)
