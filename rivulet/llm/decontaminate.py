"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test texts.

Texts are lower-cased (A-Z) and cut into words of ASCII letters, digits and
any non-ASCII characters. A window is ``window`` consecutive words of an
item (the whole item if it has fewer). The automaton holds every window as
a string with a blank at either end, so a match always covers whole words;
each text is scanned once, and matches are mapped back to word numbers and
to character offsets of the original text.
"""

from __future__ import annotations

import re
import uuid
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import col, held, saved, sliced, table, unpacked, whole

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Bytes to bytes: A-Z to a-z, other ASCII that is no letter or digit to a blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _automaton(windows: list[tuple[str, list[str]]]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for text, items in windows:
        a.add_word(f" {text} ", (text.count(" ") + 1, tuple(items)))
    if windows:
        a.make_automaton()
    return a


def _spans(folded: bytes, hit: np.ndarray) -> list[dict]:
    """Character offsets of runs of hit words; ``hit`` are sorted word numbers."""
    at = np.array([m.span() for m in _WORD.finditer(folded)])
    return at[hit[np.r_[True, np.diff(hit) > 1]], 0], at[hit[np.r_[np.diff(hit) > 1, True]], 1]


_SCANNED = pa.schema([("text", pa.string()), ("n_words", pa.int64()),
                      ("hits", pa.list_(pa.int32())), ("items", pa.list_(pa.string())),
                      ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def _scan(batches, key, windows, last):
    a = held(key, lambda: _automaton(windows.value))
    for t in sliced(batches):
        rows = []
        hits, items = (t.column(3).to_pylist(), t.column(4).to_pylist()) if t.num_columns > 3 else (None, None)
        for i, text in enumerate(t.column(1).to_pylist()):
            raw = (text or "").encode("utf-8", "surrogatepass")
            folded = raw.translate(_FOLD)
            words = folded.split()
            norm = b" ".join([b"", *words, b""])
            got = list(a.iter(norm.decode("latin-1"))) if len(a) and words else []
            was = set(hits[i]) if hits else set()
            seen = set(items[i]) if items else set()
            if got:
                ends = np.searchsorted(np.flatnonzero(np.frombuffer(norm, np.uint8) == 32), [e for e, _ in got])
                for end, (_, (n, found)) in zip(ends.tolist(), got):
                    was.update(range(end - n, end))
                    seen.update(found)
            hit, spans = np.array(sorted(was), np.int32), []
            if last and len(hit):
                chars = np.cumsum(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80)  # byte → characters begun so far
                begin, end = _spans(folded, hit)
                spans = [{"start": int(s), "end": int(e)} for s, e in zip(chars[begin] - 1, chars[end - 1])]
            rows.append((None if last else text, len(words), hit.tolist(), sorted(seen), spans))
        made = [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * 5, _SCANNED)]
        yield pa.RecordBatch.from_arrays([t.column(0), *made], ["id", *_SCANNED.names])


def _cut(batches, window):
    """(item, text) → its windows: (item, text of the window)."""
    for t in sliced(batches):
        rows = []
        for item, text in zip(t.column(0).to_pylist(), t.column(1).to_pylist()):
            words = [w.decode("latin-1") for w in _words(text)]
            rows += [(item, x) for x in {" ".join(words[i:i + window]) for i in range(max(1, len(words) - window + 1) if words else 0)}]
        items, texts = zip(*rows) if rows else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(texts, pa.string())], ["item", "text"])


def blocks_of(benchmark: DataFrame, item: str, text: str, window: int, block_chars: int):
    """(is it the last, windows) of each block: about ``block_chars`` characters of different windows as (text, items) lists.

    Windows are cut and put together on the executors and written. Their total length is taken
    before they are dealt into blocks, so no block that reaches the driver (and is broadcast) is
    larger, up to the luck of the hash, and the driver reads one block at a time. An automaton takes
    about 45 bytes a character of its windows.
    """
    b = benchmark.select(col(item).cast("string").alias("item"), col(text).alias("text")).where("text is not null")
    windows = (b.mapInArrow(partial(_cut, window=window), "item string, text string").groupBy("text")
               .agg(F.collect_set("item").alias("items")))
    windows = saved(windows, "benchmark-windows")
    total = windows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_chars) or 1
    windows = windows.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(n)).cast("int"))
    for k in range(n):
        yield k == n - 1, sorted((r.text, sorted(r.items)) for r in windows.where(F.col("block") == k).toLocalIterator())


def contamination(docs: DataFrame, benchmark: DataFrame, *, doc: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", window: int = 13, share: int = 20,
                  block_chars: int = 4 << 20) -> DataFrame:
    """One row per document row: words, hit words, items, character spans, and the decision.

    Returns ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, spans``. A
    document is contaminated if it has hit words and ``share`` times their number is at least
    its words. A text that is null or empty has no words, no hits and is clean; an item whose
    text is null or has no word has no window; an item without id still hits but is not listed.
    Repeated document rows each keep a row; repeated items hit once. With an empty benchmark
    all documents are clean. Other columns of either table are ignored. Very long texts are scanned
    whole. Benchmarks of more than ``block_chars`` characters of windows are scanned in blocks, one
    automaton each: a block's hits are written beside the texts before the next block is read, so a
    worker never holds two automata.
    """
    spark = docs.sparkSession
    d = docs.select(col(doc).alias("id"), col(text).alias("text"))
    kind = d.schema["id"].dataType.simpleString()
    for last, windows in blocks_of(benchmark, item, item_text, window, block_chars):
        held_windows = spark.sparkContext.broadcast(windows)
        scan = partial(_scan, key=uuid.uuid4().hex, windows=held_windows, last=last)
        d = d.mapInArrow(scan, f"id {kind}, text string, n_words long, hits array<int>, items array<string>, "
                               "spans array<struct<start:int,end:int>>")
        if not last:
            d = saved(d, "benchmark-hits")
            held_windows.unpersist()
    n_hit = F.size("hits").cast("long")
    return d.select(F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
                    F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
                    ((n_hit > 0) & (F.lit(share) * n_hit >= F.col("n_words"))).alias("contaminated"), "items", "spans")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns.

    Each row is judged by its own text and carried beside it, so ids may be null or repeated and nothing is joined.
    """
    rows = docs.select(whole(docs).alias("row"), col(text).alias("text"))
    clean = contamination(rows, benchmark, doc="row", text="text", **options).where("not contaminated")
    return unpacked(clean, "doc_id", docs.columns)


def op3_decontaminate(spark, sf_dir):
    """Contamination of all documents by the benchmark."""
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP3_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
ip AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM iw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[p:p + 12], ' ') AS k FROM ip),
lens AS (SELECT DISTINCT n FROM win),
dp AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM dw, lens WHERE len(w) >= n),
m AS (SELECT dp.doc_id, dp.p, dp.n, win.item_id FROM dp JOIN win ON win.n = dp.n AND win.k = array_to_string(dp.w[dp.p:dp.p + dp.n - 1], ' ')),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM m) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""
