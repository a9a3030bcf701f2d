"""Periodic runs against a brute-force search."""

import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from rivulet.llm import periodic

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w, least=12):
    """For each period, the stretches of positions equal to the one a period before; smaller periods win."""
    n, out = len(w), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i >= q and not any(p < q and q % p == 0 and all(w[x] == w[x + p] for x in range(i, j + q - p)) for p in range(1, q)):
                if j + q - i >= least:
                    out.add((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(doc, text):
    w = WORD.findall(text or "")
    n, h = len(w), zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = sorted(found, key=lambda r: (-r[1], r[0], r[2]))[0] if found else (None, None, None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc, len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(2, 14))
def test_runs_of_small_alphabets(w, least):
    assert periodic.runs(np.array(w, np.int64), least) == brute_runs(w, least)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 6)), max_size=12))
def test_runs_of_repeated_pieces(pieces):
    w = [x for p, k in pieces for x in p * k]
    assert periodic.runs(np.array(w, np.int64)) == brute_runs(w)


def test_suffixes():
    rng = np.random.default_rng(1)
    for n in (1, 2, 50, 300):
        s = rng.integers(0, 3, n)
        sa, isa, lcp = periodic.suffixes(s)
        assert sa.tolist() == sorted(range(n), key=lambda i: s[i:].tolist()) and isa[sa].tolist() == list(range(n))
        for k in range(1, n):
            a, b, m = sa[k - 1], sa[k], 0
            while max(a, b) + m < n and s[a + m] == s[b + m]:
                m += 1
            assert lcp[k] == m


def test_one_word_over_and_over():
    """A unary text has one run, however many squares; Fibonacci words have many runs."""
    assert periodic.runs(np.zeros(50_000, np.int64)) == [(0, 50_000, 1)]
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    assert periodic.runs(np.array(b), 2) == brute_runs(b, 2)


def test_texts_against_brute_force(spark, odd_docs, documents):
    """All sample texts but the longest (quadratic by brute force), odd rows and texts with repeats, at several batch sizes."""
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect() if len((r.text or "").split()) < 700]
    rows += [(10**9 + i, t) for i, t in enumerate(["a b " * 20, "x" * 9 + " y" * 11, "y " * 12, "a\tb\nc\x0bd\x0ce\rf " * 3 + "a b", "   " * 8,
                                                   "line one\nline one\nline one\nline one\nline one\nline one\nline"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((brute(*r) for r in rows), key=repr)
    assert sum(r[1] > 0 for r in want) > 15
    got = periodic.periodic_runs(docs, planted=True, full=False).collect()
    assert sorted(map(tuple, got), key=repr) == want
    for words in (1, 3000):
        keep, periodic.WORDS = periodic.WORDS, words
        try:
            ids, texts = zip(*rows)
            got = []
            import pyarrow as pa
            batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(texts)], ["id", "text"])
            for t in periodic._find([batch], True, False):
                got += [tuple(r.values()) for r in t.to_pylist()]
        finally:
            periodic.WORDS = keep
        assert sorted(got, key=repr) == want


def test_odd_rows_and_full_output(spark, odd_docs):
    got = periodic.periodic_runs(odd_docs, planted=True).collect()
    assert len(got) == odd_docs.count()
    empty = hashlib.sha256(b"").hexdigest()
    for r in got:
        if r.id in (1, 2, 3):
            assert r.n_runs == 0 and r.start is None and r.runs_sha256 == r.collapsed_sha256 == empty and r.runs == [] and r.collapsed == ""
    one = spark.createDataFrame([(1, "p q r " * 6 + "end")], "doc_id long, text string")
    r = periodic.periodic_runs(one).first()
    assert [tuple(x) for x in r.runs] == [(0, 18, 3)] and r.collapsed == "p q r end" and r.exponent_milli == 6000
    assert periodic.periodic_runs(odd_docs.limit(0)).count() == 0


def test_query(spark):
    rows = periodic.op12_runs(spark, SF)
    assert rows.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert rows.count() == 200 and rows.where("n_runs > 0").count() > 10
