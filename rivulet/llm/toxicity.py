"""Toxicity by a weighted finite-state grammar over clauses.

Words are read as symbols: insult, threat, target, negation, report or
other. Five small transducers (one per symbol family) are composed into one
table at start: the state says whether a negation, a report, or a target is
near, and reading an insult, or the target of a threat, adds a weight that
depends on it. A
clause scores what its path adds up to, so "you are an idiot" weighs more
than "idiot", and "she said that you are no idiot" less.

The insult lexicon is a short fixed list and what the labels teach: word
beginnings and whole words that, in a bounded sample of labelled rows, occur
in toxic texts so exclusively that chance does not explain it. A document's
score is a logistic curve over its clauses, the strongest counting most, fitted on the sample.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from functools import partial
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import bounded_sample, col, held, held_out, saved, sliced, table, unpacked, whole

# Seed words of each family.
INSULTS = "clown disgusting dumb fool idiot idiots imbecile loser losers moron morons pathetic scum stupid trash vermin worthless".split()
THREATS = "kill murder hurt destroy stab shoot strangle beat".split()
TARGETS = ("you your yours you're u he she they them him her this that these those tu toi vous te ton du dich dir euch sie ihr "
           "usted ustedes ti vosotros").split()
NEGATIONS = "not no never isn't aren't don't won't nobody pas jamais aucun nicht kein keine nie nunca ningún ninguna".split()
REPORTS = ("said says wrote writes quoted called claimed reported according dit écrit selon sagte schrieb laut dijo escribió "
           "según").split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
_CLAUSE = re.compile(r"[.!?;:\n]+")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
REACH = 3  # words a negation or a target reaches


def _negation(state: int, symbol: int) -> int:
    return REACH if symbol == NEGATION else max(0, state - 1)


def _target(state: int, symbol: int) -> int:
    return REACH if symbol == TARGET else max(0, state - 1)


def _threat(state: int, symbol: int) -> int:
    return REACH if symbol == THREAT else 0 if symbol == TARGET else max(0, state - 1)


def _report(state: int, symbol: int) -> int:
    return 1 if symbol == REPORT else state  # to the end of the clause


def _emit(symbol: int, negated: int, targeted: int, threatened: int, reported: int) -> float:
    """Factor on the weight of the word just read: insults weigh at once, threats when their target comes."""
    if symbol == INSULT:
        factor = 1.25 if targeted else 1.0
    elif symbol == TARGET and threatened:
        factor = 1.0
    else:
        return 0.0
    return factor * (0.4 if negated else 1.0) * (0.6 if reported else 1.0)


def compose() -> dict[tuple[int, int], tuple[int, float]]:
    """(state, symbol) → (next state, factor): the product of the transducers, states numbered."""
    near = range(REACH + 1)
    states = list(product(near, near, near, range(2)))
    number = {s: i for i, s in enumerate(states)}
    out = {}
    for (n, t, k, r), symbol in product(states, range(6)):
        to = _negation(n, symbol), _target(t, symbol), _threat(k, symbol), _report(r, symbol)
        out[number[n, t, k, r], symbol] = number[to], _emit(symbol, n, t, k, r)
    return out


class Grammar:
    """The composed transducer with a lexicon: ``weights`` of whole words and of word beginnings."""

    def __init__(self, words: dict[str, float], starts: dict[str, float], threat: float = 2.0):
        self.table = compose()
        families = ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS))
        self.symbols = {w: (s, threat) for s, ws in families for w in ws}
        self.insults, self.starts = words, starts
        self.lengths = sorted({len(s) for s in starts})

    def insult(self, word: str) -> float:
        best = self.insults.get(word, 0.0)
        for n in self.lengths:
            if n > len(word):
                break
            best = max(best, self.starts.get(word[:n], 0.0))
        return best

    def clauses(self, text: str | None) -> list[tuple[float, str]]:
        """(weight, clause) of every clause with a match."""
        text = (text or "").lower()
        insult, symbols = self.insult, self.symbols
        hot = {w: x for w in set(_WORD.findall(text)) if (x := insult(w)) or w in symbols and symbols[w][0] == THREAT}
        if not hot:
            return []
        out = []
        for clause in _CLAUSE.split(text):
            words = _WORD.findall(clause)
            if hot.keys().isdisjoint(words):
                continue
            state = total = 0
            for w in words:
                x = hot.get(w)
                symbol, weight = (INSULT, x) if x else symbols.get(w, (OTHER, 0.0))
                state, factor = self.table[state, symbol]
                total += factor * weight
            if total:
                out.append((total, clause))
        return out

    def strength(self, text: str | None) -> float:
        """All clauses of a text, from the strongest on, each next one counting half."""
        return sum(math.ldexp(w, -i) for i, (w, _) in enumerate(sorted(self.clauses(text), reverse=True)))


def _features(word: str) -> list[str]:
    """The word itself (marked) and its beginnings of 3 to 8 letters."""
    return [word + "$", *(word[:n] for n in range(3, min(8, len(word)) + 1))]


def _count(batches, limit: int = 100_000):
    """Texts and labels of one partition → (feature, toxic texts, other texts) of all its features.

    Counts leave whenever ``limit`` features are held, so that memory stays bounded; they are added up after the shuffle.
    """
    toxic, clean = Counter(), Counter()

    def out():
        fs = list(toxic.keys() | clean.keys())
        return pa.RecordBatch.from_arrays([pa.array(fs, pa.string()), pa.array([toxic[f] for f in fs], pa.int64()),
                                           pa.array([clean[f] for f in fs], pa.int64())], ["f", "toxic", "clean"])

    for t in sliced(batches, 100):
        for text, label in zip(t.column(0).to_pylist(), t.column(1).to_pylist()):
            words = set(_WORD.findall((text or "").lower()))
            (toxic if label else clean).update({f for w in words for f in _features(w)})
            if len(toxic) + len(clean) > limit:
                yield out()
                toxic.clear()
                clean.clear()
    yield out()


def labelled(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """``text, toxic`` of rows outside the held-out quarter; rows without id, text or label teach nothing.

    An id with several labels counts as toxic if any of them is.
    """
    lab = labels.where(col(label).isNotNull() & ~held_out(col(doc))).groupBy(col(doc).alias("id")).agg(
        F.max(col(label).cast("int")).alias("toxic"))
    d = docs.where(col(text).isNotNull()).select(col(doc).alias("id"), col(text).alias("text"))
    return d.join(lab, "id").select("id", "text", "toxic")


def train(docs: DataFrame, labels: DataFrame, rows: int = 20_000, seed: int = 9, **names) -> tuple[Grammar, float, float]:
    """Lexicon and logistic curve from at most about ``rows`` labelled documents."""
    doc = names.get("doc", "doc_id")
    few = bounded_sample(labels.where(~held_out(col(doc))), rows, seed, doc)
    sample = saved(labelled(docs, few, **names), "toxic-sample")
    total = sample.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    n, t = total.n, total.t or 0
    words, starts = dict.fromkeys(INSULTS, 3.0), {}
    if t:
        base = t / n
        found = (sample.select("text", "toxic").mapInArrow(_count, "f string, toxic long, clean long").groupBy("f")
                 .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where("toxic > 1"))
        found = saved(found, "toxic-features")
        size = max(1, found.count())
        # so exclusive to toxic texts that among all features chance gives less than one in a hundred
        sure = found.where((F.col("toxic") * -math.log(base) > math.log(100 * size)) & (F.col("clean") <= F.col("toxic") / 20))
        for f, a, b in sorted(map(tuple, sure.toLocalIterator()), key=lambda x: (len(x[0]), x[0])):  # bounded by the sample
            weight = min(6.0, math.log((a + 0.5) / (b + 0.5) * (1 - base) / base))
            if f.endswith("$"):
                words[f[:-1]] = weight
            elif not any(f[:k] in starts for k in range(3, len(f))):  # a shorter start covers it
                starts[f] = weight
    g = Grammar(words, starts)
    pairs = sample.select("text", "toxic").mapInArrow(partial(_strengths, g=g), "x double, y int").toPandas()
    return g, *_curve(pairs["x"].to_numpy(), pairs["y"].to_numpy())


def _strengths(batches, g):
    for t in sliced(batches):
        yield pa.RecordBatch.from_arrays([pa.array([g.strength(x) for x in t.column(0).to_pylist()], pa.float64()),
                                          t.column(1).cast(pa.int32())], ["x", "y"])


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by Newton steps from a sane start, with a weak prior."""
    w, b = 1.5, -3.0
    for _ in range(50 if len(x) else 0):
        p = 1 / (1 + np.exp(-(w * x + b)))
        r = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - y) * x).sum() + 0.1 * (w - 1.5), (p - y).sum() + 0.1 * (b + 3)])
        h = np.array([[(r * x * x).sum() + 0.1, (r * x).sum()], [(r * x).sum(), r.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        w, b = w - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
        if np.abs(step).max() < 1e-6:
            break
    return w, b


def _score(batches, model, key):
    g, w, b = held(key, lambda: model.value)
    for t in sliced(batches):
        x = np.array([g.strength(s) for s in t.column(1).to_pylist()], np.float64)
        yield pa.RecordBatch.from_arrays([t.column(0), pa.array(1 / (1 + np.exp(-(w * x + b))))], ["doc_id", "score"])


def toxicity(docs: DataFrame, model: tuple[Grammar, float, float], *, doc: str = "doc_id", text: str = "text",
             limit: float = 0.3) -> DataFrame:
    """``doc_id, score, predicted`` of every row of ``docs``.

    A null or empty text has no clause and gets the lowest score; a very long one is read whole. Null and repeated ids are kept row
    by row; an empty table gives no rows; other columns are ignored.
    """
    d = docs.select(col(doc).alias("doc_id"), col(text).alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    bc = docs.sparkSession.sparkContext.broadcast(model)
    out = d.mapInArrow(partial(_score, model=bc, key=uuid.uuid4().hex), f"doc_id {kind}, score double")
    return out.withColumn("predicted", (F.col("score") >= limit).cast("int"))


def drop_toxic(docs: DataFrame, model, *, text: str = "text", limit: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, with all their columns; nothing is joined or shuffled."""
    rows = docs.select(whole(docs).alias("row"), col(text).alias("text"))
    kept = toxicity(rows, model, doc="row", text="text", limit=limit).where("predicted = 0")
    return unpacked(kept, "doc_id", docs.columns)


def op9_toxicity(spark, sf_dir):
    """Toxicity of all documents, with labels learned outside the held-out quarter."""
    docs = table(spark, sf_dir, "documents")
    out = toxicity(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
