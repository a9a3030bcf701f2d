"""Language identification: known words first, then ever shorter character n-grams.

For each language the model holds the log frequency of known words and of
character n-grams of words (marked at both ends). A word of the text that
is known scores by its own frequencies; any other by its longest n-grams
that are known at all. The model is fitted on a hashed sample of labelled
rows, bounded for each language, so that small languages are learned too;
texts are scored whole.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import col, held, held_out, saved, sliced, table

_WORD = re.compile(r"[^\W\d_]+")
LONGEST = 5


def _grams(word: str, n: int) -> list[str]:
    w = f"<{word}>"
    return [w[i:i + n] for i in range(len(w) - n + 1)]


def _count(batches):
    """Texts and languages of a partition → (lang, what, count): words as ``word$``, n-grams as they are."""
    count: dict[str, Counter] = {}
    for t in sliced(batches):
        for text, lang in zip(t.column(0).to_pylist(), t.column(1).to_pylist()):
            count.setdefault(lang, Counter()).update(_WORD.findall(text.lower()))
    for lang, words in count.items():
        grams = Counter()
        for w, n in words.items():
            for k in range(1, LONGEST + 1):
                for g in _grams(w, k):
                    grams[g] += n
        for end, c in (("$", words), ("", grams)):
            keys = list(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array([k + end for k in keys]),
                                              pa.array(list(c.values()), pa.int64())], ["lang", "what", "n"])


class Model:
    """Log frequencies per language of words and n-grams, as rows of one matrix."""

    def __init__(self, langs: list[str], counts: dict[str, np.ndarray]):
        self.langs = langs
        words = {k[:-1]: v for k, v in counts.items() if k.endswith("$") and len(k) > 1}
        grams = {k: v for k, v in counts.items() if not (k.endswith("$") and len(k) > 1)}
        self.words = self._logs(words)
        self.grams: dict[str, np.ndarray] = {}
        for n in range(1, LONGEST + 1):
            self.grams |= self._logs({g: v for g, v in grams.items() if len(g) == n})
        self.size = 0

    def _logs(self, counts):
        if not counts:
            return {}
        m = np.array(list(counts.values()), np.float64)
        n = np.maximum(m.sum(0), 1)
        m += 0.5 * n / n.max()  # what is unseen is as rare in a language with few rows as in others
        return dict(zip(counts, np.log(m / m.sum(0))))

    def unseen(self, word: str) -> np.ndarray:
        """Mean over the word's longest known n-grams; nothing is known of it: zero for all."""
        for n in range(min(LONGEST, len(word) + 2), 0, -1):
            found = [g for g in map(self.grams.get, _grams(word, n)) if g is not None]
            if found:
                return np.sum(found, 0) / len(found)
        return np.zeros(len(self.langs))


class Scorer:
    """A model with a bounded memory of unseen words."""

    def __init__(self, model: Model, limit: int = 200_000):
        self.model, self.limit = model, limit
        self._reset()

    def _reset(self):
        rows = list(self.model.words.values()) or [np.zeros(len(self.model.langs))]
        self.index = {w: i for i, w in enumerate(self.model.words)}
        self.rows = np.zeros((len(rows) + self.limit, len(self.model.langs)))
        self.rows[:len(rows)] = rows
        self.used = len(rows)

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = _WORD.findall((text or "").lower())
        if not self.model.langs or not any(c.isalpha() for w in words for c in w):
            return "und", 0.0
        total = np.zeros(len(self.model.langs))
        for s in range(0, len(words), self.limit // 2):
            part = words[s:s + self.limit // 2]
            get = self.index.get
            ids = [get(w, -1) for w in part]
            new = {w for w, i in zip(part, ids) if i < 0} if -1 in ids else ()
            if new:
                if self.used + len(new) > len(self.rows):
                    self._reset()
                    new = {w for w in part if w not in self.index}
                for w in sorted(new):
                    self.rows[self.used] = self.model.unseen(w)
                    self.index[w] = self.used
                    self.used += 1
                ids = [self.index[w] for w in part]
            total += self.rows[ids].sum(0)
        best = int(total.argmax())
        return self.model.langs[best], float(1 / np.exp(np.clip(total - total[best], -700, 0)).sum())


def train(docs: DataFrame, rows: int = 6_000, seed: int = 8, least: int = 3, *, each: int = 200, doc: str = "doc_id", text: str = "text",
          lang: str = "lang") -> Model:
    """Fit on about ``rows`` labelled documents outside the held-out quarter, and about ``each`` of every language.

    A language with fewer than ``each`` such documents is learned from all of them. Rows without text, language or id teach nothing. Words and n-grams seen fewer than ``least``
    times in all are left to shorter n-grams.
    """
    known = docs.where(col(doc).isNotNull() & col(text).isNotNull() & col(lang).isNotNull() & ~held_out(col(doc)))
    known = known.select(col(doc).alias("id"), col(text).alias("text"), col(lang).alias("lang"))
    per = saved(known.groupBy("lang").agg(F.count("*").alias("n")), "lang-rows")
    share = F.lit(rows / max(1, per.agg(F.sum("n")).first()[0] or 0))
    part = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(2**31)) / 2**31
    sample = known.join(per, "lang").where(part < F.greatest(share, each / F.col("n")))
    counts = (sample.select("text", "lang").mapInArrow(_count, "lang string, what string, n long")
              .groupBy("what", "lang").agg(F.sum("n").alias("n")))
    counts = counts.groupBy("what").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"), F.sum("n").alias("n"))
    counts = saved(counts.where(F.col("n") >= least), "lang-counts")
    langs = sorted(r[0] for r in counts.select(F.explode(F.map_keys("by"))).distinct().collect())
    t = counts.select("what", *[F.coalesce(F.try_element_at("by", F.lit(x)), F.lit(0)).alias(f"n{i}")
                                for i, x in enumerate(langs)]).toPandas()
    return Model(langs, dict(zip(t["what"], t.iloc[:, 1:].to_numpy())))


def _predict(batches, model, key):
    score = held(key, lambda: Scorer(model.value))
    for t in sliced(batches):
        got = [score(x) for x in t.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([t.column(0), pa.array([g[0] for g in got], pa.string()),
                                          pa.array([g[1] for g in got], pa.float64())], ["doc_id", "lang_pred", "score"])


def identify(docs: DataFrame, model: Model, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row.

    ``lang_pred`` is a learned language, or ``und`` with score 0 for a text that is null or has no
    letter, and very long texts are read whole; ties go to the first language in the alphabet, and a model that has learned nothing says
    ``und``. Null and repeated ids keep their rows; an empty table gives no rows; other columns are
    ignored.
    """
    d = docs.select(col(doc).alias("doc_id"), col(text).alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    bc = docs.sparkSession.sparkContext.broadcast(model)
    return d.mapInArrow(partial(_predict, model=bc, key=uuid.uuid4().hex), f"doc_id {kind}, lang_pred string, score double")


def op8_langid(spark, sf_dir):
    """Language of all documents, learned outside the held-out quarter."""
    docs = table(spark, sf_dir, "documents")
    out = identify(docs, train(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
