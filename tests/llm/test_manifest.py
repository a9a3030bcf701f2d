"""The Merkle manifest against a plain tree in Python, and DuckDB."""

import hashlib
import zlib

import duckdb
import pytest

from rivulet.llm import merkle
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [list(nodes)]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def climb(tree, i, node):
    """Siblings of the node above leaf i, and the nodes of the version in which that leaf is ``node``."""
    sib, nodes = "", [node]
    for low in tree[:-1]:
        r = i // 16 * 16
        a, b = "".join(low[r:i]), "".join(low[i + 1:r + 16])
        sib, i = sib + a + b, i // 16
        nodes.append(h(a + nodes[-1] + b))
    return sib, nodes


def brute(rows, tampered):
    """Rows (doc_id, source, lang, n_chars, text) → sorted result rows, copies of versions included."""
    by = {}
    for r in rows:
        t = r[4]
        other = t if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
        new = leaf((*r[:4], other)) if tampered(r[0]) else None
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), new or "", r[0]))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(by[s])]) for s in names}
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (_, _, old, new, doc) in enumerate(sorted(by[s])):
            sib, nodes = climb(trees[s], i, new or old)
            more, above = climb(top, k, nodes[-1])
            out.append((doc, old, trees[s][-1][0], top[-1][0], h(sib + more), above[-1], nodes + above[1:] if new else None))
    return sorted(out, key=repr)


def fifth(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0


def run(docs):
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lower = lambda t: F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = merkle.manifest(merkle.document_leaves(docs, changed=hit, change=lower))
    return sorted((tuple(r) for r in out.collect()), key=repr)


KINDS = "doc_id long, source string, lang string, n_chars long, text string"


def test_against_a_plain_tree(spark):
    """Trees of 1, 15 to 17, 256, 257 and 4,200 leaves; null, empty and odd names; 40 sources."""
    sizes = {None: 3, "": 1, "a": 16, "b": 17, "B": 15, "é": 256, "z": 257, "\U0001F600": 1, "hot": 4200} | {f"s{i}": 1 + i % 3 for i in range(31)}
    rows, n = [], 0
    for s, k in sizes.items():
        for _ in range(k):
            rows.append(((n * 7919) % 100_003 - 50, s, None if n % 5 == 0 else "en", None if n % 7 == 0 else n, f"Some Text {n} É"))
            n += 1
    assert run(spark.createDataFrame(rows, KINDS).repartition(7)) == brute(rows, fifth)


def test_lone_leaf_and_empty_table(spark):
    rows = [(5, "s", "en", 1, "X")]
    docs = spark.createDataFrame(rows, KINDS)
    got = run(docs)
    assert got == brute(rows, fifth) and got[0][1] == got[0][2] == got[0][3] and got[0][4] == h("")
    assert run(docs.limit(0)) == []


def test_odd_rows(spark, odd_docs):
    """Null, repeated and tied ids, null and empty texts, extra columns with names used inside."""
    docs = odd_docs.selectExpr("*", "cast(null as string) as source", "'tree' as lang", "1 as n_chars", "1 as idx", "'x' as tree", "2 as digest")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert run(docs) == brute(rows, fifth)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_against_duckdb(spark, sf):
    base = f"/root/testdata/sf{sf}"
    got = merkle.op13_manifest(spark, base)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{base}/documents.parquet')")
    res = con.execute(merkle.OP13_SQL)
    assert [c[0] for c in res.description] == got.columns
    rows = [tuple(r) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted(res.fetchall(), key=repr)
    assert any(r[-1] for r in rows) and any(not r[-1] for r in rows)
