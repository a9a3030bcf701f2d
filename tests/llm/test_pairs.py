"""Operators that compare rows: lines, passages, fingerprints, vectors, preference pairs; components."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rivulet.llm import common, linededup, passages, preference, simhash, vectors, wordsets


def closure(edges, nodes):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("shape", ["path", "star", "random", "none", "cliques"])
def test_components(spark, shape):
    r = random.Random(3)
    edges = {"path": [(i, i + 1) for i in range(200)], "star": [(500, i) for i in range(0, 1000, 3)],
             "random": [(r.randint(0, 400), r.randint(0, 400)) for _ in range(250)], "none": [(1, 1)],
             "cliques": [(i, j) for k in range(0, 60, 12) for i in range(k, k + 12) for j in range(k, i)]}[shape]
    want = closure([e for e in edges if e[0] != e[1]], {x for e in edges for x in e if e[0] != e[1]})
    e = spark.createDataFrame(edges, "a long, b long").repartition(3)
    for block in (1 << 18, 40):
        got = common.components(e, block).collect()
        assert len(got) == len(want) and {x.id: x.component for x in got} == want


# --- SimHash

def slow_fingerprint(text, width=3):
    import xxhash
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
             .translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprint_is_sparks_hash(spark, odd_docs):
    for r in odd_docs.limit(13).collect():
        if r.text is None or len(r.text) < 1000:
            assert simhash.fingerprint(r.text) == slow_fingerprint(r.text)
    one = spark.range(1).select(F.xxhash64(F.lit("one two three")).alias("h")).first().h
    assert simhash.fingerprint("One  TWO\nthree") == one % 2**64


def families(seed, n=160, near=6):
    r = random.Random(seed)
    fps = []
    for _ in range(n):
        f = r.getrandbits(64)
        fps.append(f)
        for _ in range(r.choice([0, 0, 1, near])):
            g = f
            for b in r.sample(range(64), r.randint(0, 5)):
                g ^= 1 << b
            fps.append(g)
    return sorted(set(fps))


@pytest.mark.parametrize("block", [2048, 8])  # 8: buckets are dealt again and cut into sub-blocks
def test_links_connect_what_is_near(spark, block):
    fps = families(5)
    base = random.Random(9).getrandbits(64)  # one dense group, many of which share whole bands
    fps = sorted(set(fps) | {base ^ (1 << a) ^ (1 << b) for a in range(0, 64, 5) for b in range(a, 64, 7)})
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    got = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 3, block).collect()
    assert all((r.a ^ r.b).bit_count() <= 3 if r.a ^ r.b >= 0 else ((r.a ^ r.b) % 2**64).bit_count() <= 3 for r in got)
    near = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) % 2**64).bit_count() <= 3]
    assert closure([(r.a, r.b) for r in got], signed) == closure(near, signed)


def test_block_counts_other_radii():
    fps = np.array(families(6, 60), np.uint64)
    for radius in (0, 1, 2, 3, 5, 7):
        same = np.r_[np.ones(len(fps) - 1, bool), False]
        got = {(a, b) for i, j in simhash._close_pairs(fps, same, np.full(len(fps), -1), radius) for a, b in zip(i.tolist(), j.tolist())}
        assert got == {(i, j) for j in range(len(fps)) for i in range(j) if int(fps[i] ^ fps[j]).bit_count() <= radius}


def test_near_duplicates(spark, odd_docs, documents):
    docs = documents.select("doc_id", "text").union(odd_docs.select(F.col("doc_id") + 10_000, "text"))
    rows = docs.collect()
    fps = {r.text: slow_fingerprint(r.text) for r in rows}
    ids = defaultdict(list)
    for r in rows:
        ids[fps[r.text]] += [r.doc_id] if r.doc_id is not None else []
    near = [(a, b) for a in ids for b in ids if a < b and (a ^ b).bit_count() <= 3]
    group = closure(near, list(ids))
    least = defaultdict(lambda: 10**9)
    for f, i in ids.items():
        least[group[f]] = min([least[group[f]], *i])
    want = Counter((r.doc_id, f"{fps[r.text]:016x}", least[group[fps[r.text]]]) for r in rows)
    got = simhash.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    kept = simhash.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    names = [r.doc_id for r in kept.collect()]
    assert None not in names and len(names) == len(set(names)) and {0, 1, 5, 7, 8} <= set(names) and not {2, 3, 4} & set(names)
    assert simhash.near_duplicates(odd_docs.limit(0)).count() == 0


# --- vectors

def test_vectors_against_brute_force(spark):
    r = np.random.default_rng(2)
    base = r.standard_normal((60, 16))
    vs, labels = [], []
    for i, v in enumerate(base):
        for _ in range(int(r.choice([1, 1, 3, 40]))):
            vs.append((v + 0.05 * r.standard_normal(16)).tolist())
            labels.append(i % 3)
    vs += [vs[0], vs[0], None, [0.0] * 16, [], [1.0, None] * 8, [float("nan")] * 16, [float("inf")] * 16, vs[1][:8], vs[1][:8], vs[5]]
    labels += [labels[0]] * 2 + [0] * 8 + [None]
    rows = [(i, v, l, "x", 1) for i, (v, l) in enumerate(zip(vs, labels))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, id string, v int").repartition(3)
    ok = [(i, np.array(v), l) for i, v, l, *_ in rows if v and l is not None and None not in v and np.isfinite(v).all() and any(v)]
    links = defaultdict(set)
    for i, v, l in ok:
        for j, u, m in ok:
            if i < j and l == m and len(u) == len(v) and v @ u / np.sqrt((v @ v) * (u @ u)) >= 0.98:
                links[i].add(j)
                links[j].add(i)
    group = closure([(a, b) for a in links for b in links[a]], range(len(rows)))
    want = {i: (len(links[i]), group[i]) for i in range(len(rows))}
    for block in (256, 8):
        got = {r.vec_id: r for r in vectors.near_vectors(df, block=block).collect()}
        assert len(got) == len(rows)
        found = sum(got[i].n_links for i in want)
        assert found >= 0.9 * sum(n for n, _ in want.values())  # recall
        assert all(got[i].n_links <= want[i][0] and got[i].kept == (got[i].component_id == i) for i in want)
        assert {i: (r.n_links, r.component_id) for i, r in got.items()} == want  # these are well apart
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_vectors_of_a_hub(spark):
    """Thousands of copies near a hub but not near each other, and a dense label of loose groups."""
    r = np.random.default_rng(7)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    around = lambda v, n, cos: v * cos + unit((g := r.standard_normal((n, 64))) - (g @ v)[:, None] * v) * (1 - cos * cos) ** 0.5
    hub = unit(r.standard_normal(64))
    topics = [around(unit(r.standard_normal(64)), 250, 0.975) for _ in range(4)]  # about 0.95 to each other
    dense = np.concatenate([*topics, *[around(t[0], 20, 0.985) for t in topics]])
    vs = np.concatenate([around(hub, 3000, 0.985), dense, r.standard_normal((300, 64)), hub[None]])
    labels = [0] * 3000 + [1] * len(dense) + [0] * 301
    x, l = unit(vs), np.array(labels)
    near = (x @ x.T >= 0.98) & (l[:, None] == l)
    np.fill_diagonal(near, False)
    group = closure(np.argwhere(np.triu(near)).tolist(), range(len(vs)))
    df = spark.createDataFrame([(i, v, k) for i, (v, k) in enumerate(zip(vs.tolist(), labels))], "vec_id long, embedding array<double>, label int")
    got = {q.vec_id: (q.n_links, q.component_id) for q in vectors.near_vectors(df.repartition(3)).collect()}
    assert near[-1].sum() >= 3000
    assert got == {i: (int(near[i].sum()), group[i]) for i in range(len(vs))}


# --- lines

def slow_lines(rows):
    place = lambda i: 2**63 if i is None else i
    lines = [(i, n, frozenset("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)
                              .translate(dict.fromkeys((9, 11, 12, 13), " ")).split(" ")) - {""})
             for i, t in rows for n, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[2]]
    first = {}
    for i, n, s in lines:
        first[s] = min(first.get(s, (2**64, 0)), (place(i), n))
    near = {s: [u for u in first if u != s and 5 * len(s & u) >= 4 * len(s | u)] for s in first}
    back = lambda i: None if i == 2**63 else i
    return Counter((i, n, back(first[s][0]), first[s][1], len(near[s]),
                    (place(i), n) > min([first[s], *(first[u] for u in near[s])])) for i, n, s in lines)


@pytest.mark.parametrize("block", [512, 4])
def test_lines_against_brute_force(spark, odd_docs, block):
    r = random.Random(4)
    vocab = [f"w{i}" for i in range(60)]
    rows = []
    for d in range(60):
        lines = []
        for _ in range(r.randint(0, 6)):
            if rows and r.random() < 0.5:
                near = r.choice([x for x in r.choice(rows)[1].split("\n")] or [""]).split(" ")
                for _ in range(r.randint(0, 2)):
                    if near:
                        near[r.randrange(len(near))] = r.choice(vocab)
                lines.append(" ".join(near))
            else:
                lines.append(" ".join(r.choice(vocab) for _ in range(r.choice([1, 3, 4, 5, 9, 20, 40]))))
        rows.append((d, "\n".join(lines)))
    rows += [(x.doc_id + 100 if x.doc_id is not None else None, x.text) for x in odd_docs.collect()]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, line_no int, links string").repartition(3)
    out = linededup.similar_lines(df, block=block, sketch_bits=13)
    got = Counter((x.doc_id, x.line_no, x.class_doc, x.class_line, x.n_links, x.removed) for x in out.collect())
    want = slow_lines(rows)
    assert got == want
    gone = {(i, n) for i, n, *_, removed in want if removed}
    cut = linededup.drop_lines(df, block=block, sketch_bits=13)
    assert cut.columns == df.columns
    keep = lambda i, t: t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)
    assert Counter((x.doc_id, x.text) for x in cut.collect()) == Counter((i, keep(i, t)) for i, t in rows)


def test_lines_with_frequent_words_only(spark):
    """Very frequent words take another way to the candidates."""
    rows = [(i, " ".join(["aa", "bb", "cc", "dd", f"x{i % 7}"])) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = linededup.similar_lines(df, sketch_bits=12)
    want = slow_lines(rows)
    assert Counter((x.doc_id, x.line_no, x.class_doc, x.class_line, x.n_links, x.removed) for x in got.collect()) == want
    level = np.zeros(1 << 12, np.uint8)
    bc = spark.sparkContext.broadcast(level)
    import pyarrow as pa
    t = pa.RecordBatch.from_arrays([pa.array([1, 2], pa.int64()), pa.array([rows[0][1], rows[1][1]])], ["id", "text"])
    hot = [b for b in linededup._postings([t], bc, 0, 8, 4, 5) for b in b.column(0).to_pylist()]
    assert min(hot) >= 8  # dealt by line, not by word


@pytest.mark.parametrize("hot", [0, 300])
def test_candidates_hold_every_similar_pair(spark, hot, monkeypatch):
    """Short and long lines, through packed buckets and through blocks of frequent words."""
    r = random.Random(12)
    rows = []
    for d in range(40):
        base = [f"v{r.randrange(4000)}" for _ in range(r.choice([6, 30, 140, 400, 900]))]
        for _ in range(r.choice([1, 2, 4])):
            line = list(base)
            for _ in range(r.randint(0, len(line) // 8)):
                line[r.randrange(len(line))] = f"v{r.randrange(4000)}"
            rows.append((len(rows), " ".join(line)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    level = linededup._levels
    monkeypatch.setattr(linededup, "_levels", lambda c, b: (level(c, b)[0], hot, level(c, b)[2]))
    got = linededup.similar_lines(df, block=3)
    assert Counter((x.doc_id, x.line_no, x.class_doc, x.class_line, x.n_links, x.removed) for x in got.collect()) == slow_lines(rows)


def test_lines_of_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert linededup.similar_lines(df).count() == 0 == linededup.drop_lines(df).count()


# --- passages

def test_words_of_long_texts_are_whole():
    import pyarrow as pa
    text = " ".join(f"t{i}" for i in range(300_000))
    whole = np.concatenate([h for _, _, h in wordsets.words_of(pa.array([text]))])
    old, wordsets.STEP = wordsets.STEP, 1000
    try:
        parts = list(wordsets.words_of(pa.array(["a b", None, text, "", "c"])))
    finally:
        wordsets.STEP = old
    assert [n for _, c, _ in parts for n in np.diff(c)] == [2, 0, 300_000, 0, 1]
    assert (np.concatenate([h for _, _, h in parts])[2:-1] == whole).all()


def test_chains_keep_the_best_order():
    got = passages.chains([0, 10, 20, 20, 30, 500], [5, 15, 3, 25, 35, 2], 5)
    assert got[0] == [0, 1, 3, 4] and sorted(map(len, got)) == [1, 1, 4]


def slow_scores(at, rat, k, cost=0.1, reach=40):
    score = []
    for i, (a, r) in enumerate(zip(at, rat)):
        score.append(k + max([0.0, *(score[j] - cost * (a - at[j] + r - rat[j]) for j in range(i)
                                     if 0 < a - at[j] <= reach and 0 < r - rat[j] <= reach)]))
    return score


def test_chains_of_two_passages_in_one_pair():
    """A long chain does not hide the near matches of a later passage."""
    at = [*range(0, 201, 10), *range(300, 501, 10)]
    assert sorted(passages.chains(at, at, 5)) == [list(range(21)), list(range(21, 42))]
    r = random.Random(6)
    for _ in range(60):
        spots = sorted({(r.randint(0, 150), r.randint(0, 150)) for _ in range(r.randint(1, 120))})
        at, rat = map(list, zip(*spots))
        want = slow_scores(at, rat, 5)
        got = passages.chains(at, rat, 5)
        assert sorted(i for c in got for i in c) == list(range(len(at)))
        steps = [(at[j] - at[i], rat[j] - rat[i]) for c in got for i, j in zip(c, c[1:])]
        assert all(0 < x <= 40 and 0 < y <= 40 for x, y in steps)
        best = 5 * len(got[0]) - 0.1 * (at[got[0][-1]] - at[got[0][0]] + rat[got[0][-1]] - rat[got[0][0]])
        assert best == pytest.approx(max(want))


def test_passages(spark, odd_docs):
    r = random.Random(8)
    text = lambda n: [f"{r.choice('bcdfg')}{r.randrange(10**6)}" for _ in range(n)]
    p, q = text(60), text(200)
    fuzzy = list(p)
    fuzzy[20], fuzzy[41] = "other", "else"
    docs = {0: text(30) + p + text(100), 1: text(200), 2: text(10) + fuzzy + text(50), 3: q, 4: text(5) + q, 5: text(300), 6: q,
            7: text(20) + p[:25] + text(40)}
    for i in range(8, 60):  # a frequent passage, beyond the cap of a task
        docs[i] = text(i % 3) + p + text(30)
    rows = [(i, " ".join(t)) for i, t in docs.items()] + [(None, " ".join(q)), (3, " ".join(q)), (61, None), (62, "")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, start int").repartition(2)
    for cap in (32, 4):
        got = passages.repeated_passages(df, cap=cap).collect()
        by = defaultdict(list)
        for x in got:
            by[x.doc_id].append(x)
            assert x.source_id is not None and (x.doc_id is None or x.source_id < x.doc_id) and x.similarity >= 0.8
        assert set(by) == {2, 4, 6, None, *range(8, 60)}
        assert any(x.source_id == 0 and x.start <= 12 and x.end >= 68 and x.source_start <= 32 and x.similarity > 0.9 for x in by[2])
        assert any((x.source_id, x.start, x.end, x.source_start, x.source_end) == (3, 5, 205, 0, 200) for x in by[4])
        assert all(any(x.end - x.start >= 58 for x in by[i]) for i in range(8, 60))
    assert passages.repeated_passages(df.limit(0)).count() == 0


@pytest.mark.parametrize("rate, least", [(0.05, 1.0), (0.1, 1.0), (0.15, 0.95), (0.2, 0.85)])
def test_passages_with_changed_words(spark, rate, least):
    """Passages of 60 words of which a share is changed; all are at least 80 % alike."""
    r = random.Random(3)
    text = lambda n: [f"{r.choice('bcdfg')}{r.randrange(10**6)}" for _ in range(n)]
    rows = []
    for i in range(60):
        p = text(60)
        q = list(p)
        for j in r.sample(range(60), round(60 * rate)):
            q[j] = text(1)[0]
        rows += [(i, " ".join(text(30) + p + text(30))), (100 + i, " ".join(text(50) + q + text(30)))]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
    assert all(x.doc_id == x.source_id + 100 for x in got)
    assert len({x.doc_id for x in got}) >= least * 60


# --- preference pairs

def test_preference_pairs(spark):
    turn = lambda r, t: (None, r, t)
    a = [turn("system", "s"), turn("user", "hi"), turn("assistant", "yes")]
    b = a[:2] + [turn("assistant", "no"), turn("user", "why")]
    df = spark.createDataFrame([(1, a, b, "k"), (2, a, a, "k"), (3, a, a[:2], "k"), (4, None, a, "k"), (5, [], [], "k")],
                               f"id long, chosen {preference.TURNS}, rejected {preference.TURNS}, prompt2 string")
    got = {r.id: r for r in preference.format_pairs(df).collect()}
    r = got[1]
    assert r.n_common == 2 and r.prompt == "<|system|>\ns<|end|>\n<|user|>\nhi<|end|>\n"
    assert r.chosen_text == "<|assistant|>\nyes<|end|>\n"
    assert [r.chosen_text[s.start:s.end] for s in r.chosen_spans] == ["yes<|end|>"]
    assert [r.rejected_text[s.start:s.end] for s in r.rejected_spans] == ["no<|end|>"] and "why" in r.rejected_text
    assert not got[2].differs and got[2].chosen_text == "" and got[2].n_common == 3
    assert got[3].differs and got[3].rejected_text == "" and got[4].n_common == 0 and not got[5].differs


def test_conversations_with_odd_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 0, None, None), (None, 0, "user", "lost"), (0, None, "user", "x"),
            (0, 2, "assistant", "y"), (0, 2, "assistant", "y"), (7, 0, "user", "only")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    convs = preference.conversations(df)
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in convs.collect()}
    assert got == {1: [("", ""), ("user", "a"), ("assistant", "b")], 0: [("user", "x"), ("assistant", "y"), ("assistant", "y")],
                   7: [("user", "only")]}
    pairs = {r.conv_id: r for r in preference.pairs_by_swapped_reply(convs).collect()}
    assert [t.text for t in pairs[1].rejected] == ["", "a", "y"] and [t.text for t in pairs[0].rejected] == ["x", "y", "b"]
    assert pairs[7].chosen == pairs[7].rejected
    assert preference.format_pairs(preference.pairs_by_swapped_reply(preference.conversations(df.limit(0)))).count() == 0


def test_crowded_passages(spark):
    """A passage of two texts is found though all its pieces also stand in other texts, before and between them."""
    r = random.Random(5)
    text = lambda n: [f"{r.choice('bcdfg')}{r.randrange(10**6)}" for _ in range(n)]
    rows, want = [], set()
    for g in range(40):
        p = text(60)
        pieces = lambda: [w for i in range(0, 60, 9) for w in p[i:i + 9] + text(12)]  # noqa: B023, E731
        for i, t in enumerate([pieces(), text(20) + p + text(10), pieces(), text(7) + p + text(30)]):
            rows.append((g * 10 + i, " ".join(t)))
        want.add((g * 10 + 3, g * 10 + 1))
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {(x.doc_id, x.source_id) for x in got} == want
    assert all((x.start, x.end, x.source_start, x.source_end) == (7, 67, 20, 80) for x in got)


@pytest.mark.parametrize("block", [1 << 12, 2])
def test_passages_of_common_seeds_only(spark, block):
    """A passage of two texts is found though each of its seeds stands in more texts than all of which are set against each other."""
    r = random.Random(9)
    text = lambda n: [f"{r.choice('bcdfg')}{r.randrange(10**6)}" for _ in range(n)]
    rows, want = [], set()
    for g in range(6):
        p = text(60)
        pieces = lambda: [w for i in range(0, 56, 5) for w in p[i:i + 9] + text(12)]  # noqa: B023, E731
        fuzzy = list(p)
        fuzzy[30] = "other"
        texts = [pieces(), pieces(), pieces(), text(20) + p + text(10), pieces(), pieces(), pieces(), text(7) + (fuzzy if g % 2 else p) + text(30)]
        rows += [(g * 10 + i, " ".join(t)) for i, t in enumerate(texts)]
        want.add((g * 10 + 7, g * 10 + 3))
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), cap=4, block=block).collect()
    assert {(x.doc_id, x.source_id) for x in got} == want
    assert all((x.start, x.end, x.source_start, x.source_end) == (7, 67, 20, 80) for x in got)


def test_runs_of_one_word_are_passages(spark):
    """Runs of a word of very different lengths, each in another text, hold a common passage."""
    rng = np.random.default_rng(5)
    other = lambda: [f"w{x}" for x in rng.integers(0, 10**9, 30)]
    rows = [(i, " ".join([*other(), *["of"] * n, *other()])) for i, n in enumerate([60, 210, 48, 130, 75, 320, 90, 52, 180, 66])]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), cap=3).collect()
    forest = common.Forest(len(rows))
    for x in got:
        forest.join(x.doc_id, x.source_id)
    assert {forest.root(i) for i in range(len(rows))} == {0}


@pytest.mark.parametrize("two", [False, True])
def test_likely_pairs_are_all_that_may_link(two, monkeypatch):
    """Occurrences of one common seed: what is set against each other holds all pairs that all against all finds."""
    rng = np.random.default_rng(3)
    n, k = 600, 5
    t = {"seed": np.full(n, 7), "id": np.arange(n) // 2, "v": np.zeros(n, np.int32), "at": np.arange(n), "cls": rng.integers(0, 400, n),
         "blk": np.arange(n) % 2 if two else np.zeros(n, int), "lo": np.zeros(n, int), "hi": np.full(n, int(two))}
    around = np.zeros(n, passages._SPOT)
    around["prev"] = rng.integers(0, 200, n)
    around["before"] = rng.integers(1, 60, (n, 7))
    around["words"] = rng.integers(1, 20, (n, 24))
    shared = rng.integers(0, 24, n)
    for i, x in enumerate(shared):
        around["words"][i, :x] = 1 + np.arange(x)
    around["words"][rng.random(n) < 0.2, 12:] = 0
    around["signs"] = np.where(rng.random((n, 96)) < 0.004, rng.integers(0, 60, (n, 96)) * 1024 + 1, 0)  # no two share a bit
    table = pa.table({**{c: x for c, x in t.items()}, "around": [around[i].tobytes() for i in range(n)]})
    asked = []
    test = passages._may_link
    monkeypatch.setattr(passages, "_may_link", lambda t, i, j, k: (asked.append(len(i)), test(t, i, j, k))[1])
    got = passages._judged(None, table, k)
    few = sum(asked)
    monkeypatch.setattr(passages, "_plans", lambda t, group, *x: [(np.arange(n), np.arange(n - 1), np.arange(1, n), np.arange(n - 1, 0, -1))])
    asked.clear()
    want = passages._judged(None, table, k)
    rows = lambda x: sorted(zip(*(x[c].to_pylist() for c in x.column_names)))
    assert rows(got) == rows(want) and len(rows(got)) > 20
    assert few < sum(asked)


def test_equal_runs_beside_longer_ones_are_passages_too():
    """Each run of equal words of two texts is a chain of its own, but for those beside a longer one in both."""
    at = np.r_[np.arange(0, 46, 5), np.arange(100, 156, 5), np.arange(102, 150, 5)]
    rat = np.r_[np.arange(7, 53, 5), np.arange(300, 356, 5), np.arange(300, 348, 5)]
    got = passages._straight(at, rat, 5, 45)
    assert sorted((int(at[c[0]]), int(rat[c[0]]), len(c)) for c in got) == [(0, 7, 10), (100, 300, 12)]


def test_short_runs_of_one_word_go_on_only_with_more():
    """Of runs of one word that are too short for a passage, only those that a common seed follows in both are compared."""
    rng = np.random.default_rng(8)
    n, k = 40, 5
    around = np.zeros(n, passages._SPOT)
    length = rng.integers(8, 24, n)  # words of the run after the seed
    around["one"], around["prev"] = 3, 1 + np.arange(n)
    around["before"], around["words"] = rng.integers(100, 65000, (n, 7)), rng.integers(100, 65000, (n, 24))
    for i, x in enumerate(length):
        around["words"][i, :x], around["signs"][i, :x], around["early"][i] = 3, 9, (2 << int(x)) - 2
    around["signs"][[4, 11], length[[4, 11]] + 6] = 77
    t = {"seed": np.full(n, 7), "id": np.arange(n), "v": np.zeros(n, np.int32), "at": np.arange(n), "cls": np.arange(n),
         "blk": np.zeros(n, int), "lo": np.zeros(n, int), "hi": np.zeros(n, int)}
    got = passages._judged(None, pa.table({**t, "around": [around[i].tobytes() for i in range(n)]}), k)
    assert list(zip(*(got[c].to_pylist() for c in ("id", "rid")))) == [(11, 4)]


def texts_of_runs(seed):
    """Texts of runs of few words and of a common line."""
    r = random.Random(seed)
    line = [f"l{i}" for i in range(13)]
    other = lambda n: [f"{r.choice('bcdfg')}{r.randrange(10**6)}" for _ in range(n)]
    runs = lambda: [[r.choice("pqs")] * r.choice([6, 9, 14, 20, 31, 38, 44, 47]), line, line[:7], line[4:], other(r.choice([1, 3, 9])), line[::2]]
    return [(i, " ".join(w for _ in range(r.randint(4, 9)) for w in r.choice(runs()))) for i in range(70)]


def linked(rows):
    """Pairs of texts with a passage, all set against all."""
    two = [(i, j) for i in range(len(rows)) for j in range(i)]
    names = lambda x: pa.array([y[x] for y in two], pa.int64())
    zero = pa.array([0] * len(two), pa.int32())
    pairs = pa.table({"id": names(0), "v": zero, "rid": names(1), "rv": zero})
    texts = pa.table({"who": pa.array([x for x, _ in rows], pa.int64()), "key": pa.array([0] * len(rows), pa.int32()), "text": [x for _, x in rows]})
    return {(x["id"], x["rid"]) for x in passages._compared(None, pairs, texts, k=5, w=1, words=45, least=0.8).to_pylist()}


@pytest.mark.parametrize("seed", [1, 2])
def test_all_texts_with_a_common_passage_are_connected(spark, seed):
    """Whatever pair, all set against all, has a passage, rows connect it."""
    rows = texts_of_runs(seed)
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), cap=2, block=8).collect()
    forest = common.Forest(len(rows))
    for x in got:
        forest.join(x.doc_id, x.source_id)
    want = linked(rows)
    assert len(want) > 20 and len({forest.root(i) for i in range(len(rows))}) > 1
    assert [x for x in want if forest.root(x[0]) != forest.root(x[1])] == []


def test_runs_side_by_side_lose_no_pair(monkeypatch):
    """Chains that use few of the diagonals of runs of one word find passages of all pairs that all matches do."""
    rows = texts_of_runs(3)
    got = linked(rows)
    monkeypatch.setattr(passages, "_spaced", lambda at, rat, k: np.ones(len(at), bool))
    want = linked(rows)
    assert len(want) > 20 and want <= got


def test_passages_within_a_text_and_copies(spark):
    """Both places of a passage in one document are found, against another and against each other; copies of a text are named."""
    r = random.Random(7)
    text = lambda n: [f"{r.choice('bcdfg')}{r.randrange(10**6)}" for _ in range(n)]
    p = text(50)
    once, twice, long = text(10) + p + text(20), text(5) + p + text(30) + p + text(5), text(80)
    rows = [(1, " ".join(once)), (2, " ".join(twice)), (3, " ".join(long)), (4, " ".join(long)), (5, " ".join(text(60))), (6, " ".join(long))]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans = {(x.doc_id, x.start, x.end, x.source_id, x.source_start, x.source_end) for x in got}
    assert spans == {(2, 5, 55, 1, 10, 60), (2, 85, 135, 1, 10, 60), (2, 85, 135, 2, 5, 55), (4, 0, 80, 3, 0, 80), (6, 0, 80, 3, 0, 80)}


def test_passages_against_local_alignment(spark):
    """Planted passages of 50 and 60 words with changed words: nine in ten of those that a full local alignment accepts are found."""
    import numpy as np

    def local(a, b):
        """Best local alignment (1, -1, -1) over two word lists: words and matches of its longer side."""
        ids = {w: i for i, w in enumerate({*a, *b})}
        x, y = [ids[w] for w in a], np.array([ids[w] for w in b])
        h, best = np.zeros((len(a) + 1, len(b) + 1)), (0, 0, 0)
        for i, v in enumerate(x, 1):
            row = np.maximum(h[i - 1, :-1] + np.where(y == v, 1, -1), np.maximum(h[i - 1, 1:] - 1, 0))
            for j in range(len(b)):
                h[i, j + 1] = max(row[j], h[i, j] - 1)
        i, j = np.unravel_index(h.argmax(), h.shape)
        n = m = match = 0
        while h[i, j] > 0:
            s = x[i - 1] == y[j - 1]
            if h[i, j] == h[i - 1, j - 1] + (1 if s else -1):
                i, j, n, m, match = i - 1, j - 1, n + 1, m + 1, match + s
            elif h[i, j] == h[i - 1, j] - 1:
                i, n = i - 1, n + 1
            else:
                j, m = j - 1, m + 1
        return min(n, m), max(n, m), match

    r = random.Random(11)
    text = lambda n: [f"{r.choice('bcdfg')}{r.randrange(10**6)}" for _ in range(n)]
    rows, accepted = [], {}
    for i in range(160):
        size, rate = (50, 60)[i % 2], (0.05, 0.1, 0.15, 0.2)[i // 2 % 4]
        p = text(size)
        q = list(p)
        for j in r.sample(range(size), round(size * rate)):
            q[j] = text(1)[0]
        a, b = text(20) + p + text(20), text(30) + q + text(10)
        rows += [(i, " ".join(a)), (1000 + i, " ".join(b))]
        short, long, match = local(a, b)
        if short >= 45 and match >= 0.8 * long:
            accepted[i] = (size, rate)
    got = {x.source_id for x in passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert len(accepted) > 100
    by = defaultdict(list)
    for i, kind in accepted.items():
        by[kind].append(i in got)
    shares = {kind: sum(v) / len(v) for kind, v in by.items()}
    assert sum(i in got for i in accepted) >= 0.9 * len(accepted), shares
