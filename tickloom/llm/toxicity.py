"""Toxicity: a learned lexicon as a trie, Levenshtein automata over it, and scores of the words around each hit."""

from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import importable, whole

#: Labelled documents of each class that the model is fitted on, at most, chosen by a hash of their identifier.
FIT_ROWS = {0: 4000, 1: 2000}
#: Terms of the lexicon at most, the best first.
LEXICON = 400
#: Labelled toxic documents a term must occur in: so many, and such a share of them.
LEAST_DOCS, LEAST_SHARE = 4, 0.005
#: Letters of a stem: a lexicon term that stands for all words that begin with it.
STEM = range(4, 9)
#: Words before and after a hit that tell quotation from abuse.
WINDOW = 6

#: Signs of quotation or report around a hit (fixed values).
QUOTES = "\"«»“”„‹›"
REPORT = frozenset(
    "quote quoted quotes quoting said says wrote writes called term word phrase slur insult reported cited "
    "zitat sagte schrieb wort begriff dit écrit mot terme dijo escribió palabra término".split()
)

_WORD = re.compile(r"[\w@$]+")
_TOKEN = re.compile(rf"[\w@$]+|[{QUOTES}]")


def allowed_edits(term: str, stem: bool) -> int:
    """Misspellings to tolerate: none in short terms, one from 5 letters on (stems 6), two from 9 on."""
    if stem:
        return 1 if len(term) >= 6 else 0
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """The trie of the terms, intersected with the Levenshtein automata of their edit bounds.

    A state is the set of (trie node, edits used) that the letters read so far can reach. States are made when first
    needed and remembered, so reading a word costs a lookup for each letter, and most words end in the empty state
    after a few.
    """

    def __init__(self, terms: tuple[tuple[str, bool, float], ...]):
        self.children, self.bound, self.ends = [{}], [0], [[]]
        for term, stem, weight in terms:
            node, edits = 0, allowed_edits(term, stem)
            for c in term:
                self.bound[node] = max(self.bound[node], edits)
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.bound.append(0)
                    self.ends.append([])
                node = self.children[node][c]
            self.bound[node] = max(self.bound[node], edits)
            self.ends[node].append((edits, stem, weight))
        self.ids, self.states, self.steps, self.accepts = {}, [], [], []
        self.empty = self._state(set())
        self.start = self._state({(0, 0)})
        self.heads: dict[str, bool] = {}

    def _state(self, places: set) -> int:
        """The state of these places and what deleting letters of the term reaches from them."""
        todo = list(places)
        while todo:
            node, edits = todo.pop()
            for child in self.children[node].values():
                if edits < self.bound[child] and (child, edits + 1) not in places:
                    places.add((child, edits + 1))
                    todo.append((child, edits + 1))
        key = frozenset(places)
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
            best = word = None
            for node, edits in key:
                for most, stem, weight in self.ends[node]:
                    if edits <= most:
                        hit = (edits == 0, weight)
                        word = max(word, hit) if word else hit
                        if stem:
                            best = max(best, hit) if best else hit
            self.accepts.append((word, best))
        return self.ids[key]

    def _step(self, state: int, letter: str) -> int:
        after = set()
        for node, edits in self.states[state]:
            for c, child in self.children[node].items():
                if c == letter:
                    after.add((child, edits))
                elif edits < self.bound[child]:
                    after.add((child, edits + 1))
            if edits < self.bound[node]:
                after.add((node, edits + 1))
        self.steps[state][letter] = out = self._state(after)
        return out

    def match(self, word: str) -> tuple[bool, float] | None:
        """(exact, weight) of the best term that the word is, or begins with where the term is a stem."""
        state, found, steps = self.start, None, self.steps
        for c in word:
            state = steps[state][c] if c in steps[state] else self._step(state, c)
            stem = self.accepts[state][1]
            if stem and (found is None or stem > found):
                found = stem
            if state == self.empty:
                return found
        ended = self.accepts[state][0]
        return ended if ended and (found is None or ended > found) else found

    def may(self, head: str) -> bool:
        """Whether a word that begins so can match (remembered: there are few heads)."""
        out = self.heads.get(head)
        if out is None:
            state, out = self.start, False
            for c in head:
                state = self.steps[state][c] if c in self.steps[state] else self._step(state, c)
                out = out or self.accepts[state][1] is not None
            out = self.heads[head] = out or state != self.empty
        return out


@lru_cache(4)
def _automaton(terms: tuple) -> Automaton:
    return Automaton(terms)


FEATURES = 5


def features(text: str, auto: Automaton) -> list[float]:
    """Weights of exact and misspelled terms, each apart by whether its context quotes or reports; and their density."""
    text = text.lower()
    words = _WORD.findall(text)
    may, match, heads = auto.may, auto.match, auto.heads
    hits = {}
    for w in set(words):
        head = w[:4]
        if (heads[head] if head in heads else may(head)) and (hit := match(w)):
            hits[w] = hit
    sums = [0.0, 0.0, 0.0, 0.0]
    if hits:
        tokens = _TOKEN.findall(text)
        for i, t in enumerate(tokens):
            if t in hits:
                exact, weight = hits[t]
                near = tokens[max(0, i - WINDOW) : i] + tokens[i + 1 : i + 1 + WINDOW]
                signs = sum(x in QUOTES or x in REPORT for x in near)
                quoted = signs >= 2 or any(x in QUOTES for x in near[:WINDOW]) and any(x in REPORT for x in near)
                sums[(0 if exact else 2) + quoted] += weight
    direct = sums[0] + sums[2]
    return [math.log1p(x) for x in sums] + [math.log1p(1000 * direct / (len(words) + 20))]


def _vector(text_col: str, terms: tuple):
    @F.arrow_udf("array<double>")
    def vector(texts: pa.Array) -> pa.Array:
        auto = _automaton(terms)
        return pa.array([features(x.as_py() or "", auto) for x in texts], pa.list_(pa.float64()))

    return vector(whole(text_col))


def _score(text_col: str, terms: tuple, weights: tuple[float, ...]):
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        auto, w = _automaton(terms), np.array(weights)
        rows = np.array([features(x.as_py() or "", auto) for x in texts]).reshape(-1, FEATURES)
        return pa.array(1 / (1 + np.exp(-np.clip(rows @ w[:-1] + w[-1], -30, 30))))

    return score(whole(text_col))


def held_out(id_col: Column) -> Column:
    """The rows that no label is learned from: crc32 of the identifier as text is a multiple of 5 (null: held out)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(text, y) of at most FIT_ROWS labelled documents of each class; of contradictory labels the more frequent holds,
    and of as many of both, the clean one."""
    known = labels.where(F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col))).select(
        F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y")
    )
    draw = F.pmod(F.xxhash64(F.lit("fit"), "i"), F.lit(1 << 50)) / float(1 << 50)
    known = known.withColumn("draw", draw)
    there = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    # the smallest draws of a class; the bound on the draw keeps tasks from all sending that many
    chosen = [
        known.where((F.col("y") == y) & (F.col("draw") <= 3 * n / there.get(y, 1))).orderBy("draw", "i").limit(n)
        for y, n in FIT_ROWS.items()
    ]
    chosen = F.broadcast(chosen[0].union(chosen[1]).select("i", "y"))  # FIT_ROWS bounds it
    texts = docs.select(F.col(id_col).alias("i"), whole(text_col).alias("text")).join(chosen, "i")
    # one row of an identifier, however often it comes
    toxic = (F.avg("y") > 0.5).cast("int").alias("y")
    texts = texts.groupBy("i").agg(F.min("text").alias("text"), toxic)
    # and one of equal texts: copies of one toxic text would make all of its words telling
    same = [F.xxhash64("text"), F.xxhash64(F.lit("second"), "text")]
    return texts.groupBy(*same).agg(F.min("text").alias("text"), toxic).select("text", "y")


def learn_terms(rows: DataFrame) -> tuple[tuple[str, bool, float], ...]:
    """Words and stems that occur in far more toxic than other documents: (term, is stem, weight), the best LEXICON.

    The weight is the log ratio of the shares of documents; a term needs a log-likelihood ratio that chance does not
    give. A stem replaces the words it covers where it is as telling as they are.
    """
    n = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if not n.get(1) or not n.get(0):
        return ()
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}_@$]+"))
    seen = rows.select("y", F.explode(words).alias("w")).where(F.length("w") >= 3)
    stems = F.transform(
        F.filter(F.array(*[F.lit(n) for n in STEM]), lambda n: n <= F.length("w")),
        lambda n: F.struct(F.substring(F.col("w"), F.lit(1), n).alias("t"), F.lit(True).alias("stem")),
    )
    terms = F.concat(F.array(F.struct(F.col("w").alias("t"), F.lit(False).alias("stem"))), stems)
    # a stem is counted once for each word that has it; LEAST_DOCS and the ratio are then of words of documents
    counts = (
        seen.select("y", F.explode(terms).alias("x"))
        .groupBy("x")
        .agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("other"))
        .where(F.col("toxic") >= max(LEAST_DOCS, LEAST_SHARE * n[1]))
    )
    ratio = F.log((F.col("toxic") + 0.5) / (n[1] + 1.0)) - F.log((F.col("other") + 0.5) / (n[0] + 1.0))
    best = (
        counts.withColumn("weight", ratio)
        .where("weight > 2")
        .withColumn("gain", F.col("toxic") * F.col("weight"))
        .where(F.col("gain") > 15)
        .orderBy(F.desc("gain"), "x.t", "x.stem")
        .limit(LEXICON)
        .select("x.t", "x.stem", "weight", "gain")
        .collect()
    )
    gains = {(r.t, r.stem): r.gain for r in best}
    out = []
    for r in best:
        shorter = [gains.get((r.t[:k], True), 0) for k in STEM if k < len(r.t) or (not r.stem and k == len(r.t))]
        longer = [g for (t, stem), g in gains.items() if t != r.t and t.startswith(r.t)]
        if max(shorter, default=0) >= r.gain * 1.05:
            continue  # a shorter stem says more
        if r.stem and (r.t, False) in gains and gains[r.t, False] >= r.gain * 0.95:
            continue  # the word itself, with no other ending
        if r.stem and max(longer, default=0) >= r.gain * 0.95:
            continue  # a longer stem or one word says as much, and is more exact
        out.append((r.t, r.stem, round(r.weight, 6)))
    return tuple(out)


def learn_weights(vectors: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression with a small ridge, by Newton's steps; the last weight is the bias."""
    x = np.hstack([vectors, np.ones((len(vectors), 1))])
    w, ridge = np.zeros(x.shape[1]), np.diag([0.05] * (x.shape[1] - 1) + [1e-3])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"):
    """(terms, weights) learned from labelled documents that are not held out; FIT_ROWS bounds how many.

    Without labels of both classes, or of too few documents for any term to be telling, there are no terms and every
    score is the share of toxic labels (0 without any): nothing then tells one document from another.
    """
    rows = fit_rows(importable(docs), labels, id_col, text_col, label_col)
    terms = learn_terms(rows)
    got = rows.select(_vector("text", terms).alias("v"), "y").collect()
    if not got or not terms:
        share = sum(r.y for r in got) / len(got) if got else 0.0
        return (), (0.0,) * FEATURES + (float(np.log((share + 1e-6) / (1 - share + 1e-6))),)
    return terms, learn_weights(np.array([r.v for r in got]), np.array([r.y for r in got], float))


def with_score(docs: DataFrame, model: tuple, out: str = "score", text_col: str = "text") -> DataFrame:
    """The documents with their score, 0 to 1, from the whole text alone. Null counts as empty; no rows are moved."""
    return importable(docs).withColumn(out, _score(text_col, *model))


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id column, held_out, score, predicted. Repeated rows score alike; none is dropped."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    model = fit(rows, labels.select(F.col("doc_id").alias("id"), "toxic"), "id")
    return with_score(rows, model).select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
