"""Line dedup by an exact set-similarity join.

A line is the set of its words. Words are ordered by rarity, so that two
lines of Jaccard similarity ``t`` or more share one of the rarest words of
each (the prefix filter). Rarity comes from a fixed-size table of counts
over the whole corpus, which every task can hold: any common order is
right, rarer first is merely faster.

Three passes: (1) line classes (equal sets) and word counts; (2) prefix
postings, dealt by word in packed blocks, where two lines become candidates
if they pass the length and positional filters and the parity of their
words differs in few enough bits (each a necessary condition); (3) the word
sets of lines with candidates. Every similar pair lies within a connected
group of candidates, so each pair of a group is verified once, in blocks of
bounded size. Only counts and earliest places leave a block, never pairs. A
later line falls to any earlier equal or similar one.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import Forest, col, components, saved, sliced, table, unpacked, whole
from rivulet.llm.wordsets import by_line, lines_of, mix, text_keys

CHUNK = 4096  # cells of the count table per row
_POSTING = np.dtype([("w", "<u4"), ("n", "<u2"), ("at", "<u2"), ("k", "<u8"), ("p1", "<u8"), ("p2", "<u8")])
LAST = 2**63 - 1  # the place of rows without id: after all others


def need(a, b, num: int, den: int):
    """Least overlap of sets of sizes a and b with Jaccard at least num/den."""
    return -(-num * (a + b) // (num + den))


def prefix(n, num: int, den: int):
    return n - (-(-num * n // den)) + 1


def _classes(batches, bits):
    """(id, text) → line rows, then the partition's word counts in chunks."""
    count = np.zeros(1 << bits, np.int64)
    names = ["id", "text_key", "line_no", "k1", "k2", "chunk", "counts"]
    for t in sliced(batches):
        ids = t.column(0).to_numpy(zero_copy_only=False)
        keys = text_keys(t.column(1))
        for x in lines_of(t.column(1)):
            count += np.bincount((x.words & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits)
            m = len(x.no)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[x.doc]), pa.array(keys[x.doc]), pa.array(x.no.astype(np.int32)), pa.array(x.k1.view(np.int64)),
                 pa.array(x.k2.view(np.int64)), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names)
    for c in range(len(count) // CHUNK):
        part = count[c * CHUNK:(c + 1) * CHUNK]
        if part.any():
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()),
                 pa.nulls(1, pa.int64()), pa.array([c], pa.int32()), pa.array([part.astype("<u4").tobytes()], pa.binary())], names)


def _added(key, t):
    total = sum(np.frombuffer(x, "<u4").astype(np.int64) for x in t["counts"].to_pylist())
    return pa.table({"chunk": t["chunk"].slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})


def _levels(chunks: DataFrame, bits: int) -> tuple[np.ndarray, int, int]:
    """Rarity level (0 to 255) of each cell, the level of very frequent words, and all words counted."""
    count = np.zeros(1 << bits, np.int64)
    for r in chunks.groupBy("chunk").applyInArrow(_added, "chunk int, counts binary").toLocalIterator():
        count[r.chunk * CHUNK:(r.chunk + 1) * CHUNK] = np.frombuffer(r.counts, np.int64)
    level = lambda c: np.minimum(255, 6 * np.log2(1 + c)).astype(np.uint8)
    return level(count), int(level(np.array(max(8192.0, 16 * count.mean())))), int(count.sum())


def _ordered(x, levels, num, den):
    """Words of each line from rare to frequent: (words, their lines, places, levels) of those in a prefix, and the order."""
    line = np.repeat(np.arange(len(x.no)), x.n)
    level = levels[(x.words & np.uint64(len(levels) - 1)).astype(np.int64)]
    order = by_line(line, x.words, level)
    place = np.arange(len(order)) - x.cuts[line]
    pick = place < prefix(x.n, num, den)[line]
    pick &= x.n[line] * den >= num * (np.maximum(x.n[line], den // (den - num)))  # smaller sets are similar to equal ones only
    return order, line, place, level[order], pick


LONG = 128  # lines of more words carry a wider parity, as theirs may differ in more bits
WIDE = 4


def _wide_parity(x, which: np.ndarray) -> np.ndarray:
    """256-bit parities of the words of some lines."""
    out = np.zeros((len(which), WIDE), np.uint64)
    for r, i in enumerate(which.tolist()):
        h = mix(x.words[x.cuts[i]:x.cuts[i + 1]].copy(), 3)
        bit, word = np.uint64(1) << (h & np.uint64(63)), (h >> np.uint64(6)) % np.uint64(WIDE)
        out[r] = [np.bitwise_xor.reduce(bit[word == w], initial=np.uint64(0)) for w in range(WIDE)]
    return out


def _postings(batches, levels, hot, buckets, num, den):
    """(id, text) → packed postings by bucket; those of very frequent words come by line, from bucket ``buckets`` on."""
    levels, seen, held, size = levels.value, set(), [], 0
    names = ["bucket", "rows", "wide"]

    def flush():
        where, rows, wide = (np.concatenate([h[i] for h in held]) for i in range(3))
        order = np.argsort(where, kind="stable")
        at = np.cumsum(rows["n"] > LONG) - 1  # of a long line's posting, its row in wide
        wide = wide[at[order[rows["n"][order] > LONG]]]
        where, rows = where[order], rows[order]
        cut = np.r_[np.flatnonzero(np.r_[True, where[1:] != where[:-1]]), len(rows)]
        long = np.r_[0, np.cumsum(rows["n"] > LONG)][cut]
        return pa.RecordBatch.from_arrays(
            [pa.array(where[cut[:-1]].astype(np.int32)),
             pa.array([rows[i:j].tobytes() for i, j in zip(cut, cut[1:])], pa.binary()),
             pa.array([wide[i:j].tobytes() for i, j in zip(long, long[1:])], pa.binary())], names)

    for t in sliced(batches):
        for x in lines_of(t.column(1)):
            order, line, place, level, pick = _ordered(x, levels, num, den)
            new = np.array([k not in seen for k in x.k1.tolist()])  # equal lines of a task count once
            new[np.setdiff1d(np.arange(len(new)), np.unique(x.k1, return_index=True)[1])] = False
            if len(seen) > 200_000:
                seen.clear()
            seen.update(x.k1[new].tolist())
            pick &= new[line]
            w, line, place = x.words[order][pick], line[pick], place[pick]
            rows = np.empty(len(w), _POSTING)
            rows["w"] = (w >> np.uint64(32)).astype(np.uint32)
            rows["n"], rows["at"] = np.minimum(x.n[line], 65535), np.minimum(place, 65535)
            rows["k"], rows["p1"], rows["p2"] = x.k1[line], x.p1[line], x.p2[line]
            # the bucket is of the lower half of the hash, so bucket and w together tell words apart
            where = np.where(level[pick] >= hot, buckets + (x.k1[line] % np.uint64(buckets)).astype(np.int64),
                             (w % np.uint64(buckets)).astype(np.int64))
            long, back = np.unique(line[rows["n"] > LONG], return_inverse=True)
            held.append((where, rows, _wide_parity(x, long)[back]))
            size += len(rows)
            if size >= 1 << 19:
                yield flush()
                held, size = [], 0
    if size:
        yield flush()


def _links(rows, wide, num, den, side=None):
    """Postings → chains of candidate lines that share a word (``side``: only across the two sides)."""
    long = np.zeros(len(rows), np.int64)
    long[rows["n"] > LONG] = np.arange(int((rows["n"] > LONG).sum()))
    order = np.lexsort((rows["k"], rows["n"], rows["w"]))
    rows, long, side = rows[order], long[order], None if side is None else side[order]
    one = np.r_[True, (rows["w"][1:] != rows["w"][:-1]) | (rows["k"][1:] != rows["k"][:-1])]
    rows, long, side = rows[one], long[one], None if side is None else side[one]
    n, at, w = rows["n"].astype(np.int64), rows["at"].astype(np.int64), rows["w"]
    p1, p2 = rows["p1"], rows["p2"]
    ids, label = np.unique(rows["k"], return_inverse=True)
    forest, out, d, known = Forest(len(ids)), [], 0, 0
    mine, live = label.copy(), np.flatnonzero(np.r_[w[1:] == w[:-1], False])
    while len(live):  # pairs (i, i + d) of the same word, sizes ascending
        d += 1
        live = live[live + d < len(rows)]
        j = live + d
        live = live[(w[live] == w[j]) & (n[live] * den >= num * n[j])]  # once too long, all later ones are
        i = live[mine[live] != mine[live + d]]  # pairs connected already need no look
        if side is not None:
            i = i[side[i] != side[i + d]]
        j = i + d
        least = need(n[i], n[j], num, den)
        far = np.bitwise_count(p1[i] ^ p1[j]).astype(np.int64) + np.bitwise_count(p2[i] ^ p2[j])
        ok = ((np.minimum(n[i] - at[i], n[j] - at[j]) >= least) & (far <= n[i] + n[j] - 2 * least)) | (n[j] >= 65535)
        i, j, least = i[ok], j[ok], least[ok]
        both = np.flatnonzero((n[i] > LONG) & (n[j] < 65535))
        if len(both):
            far = np.bitwise_count(wide[long[i[both]]] ^ wide[long[j[both]]]).sum(1, dtype=np.int64)
            bad = both[far > n[i[both]] + n[j[both]] - 2 * least[both]]
            i, j = np.delete(i, bad), np.delete(j, bad)
        for a, b in zip(label[i].tolist(), label[j].tolist()):
            if forest.join(a, b):
                out.append((a, b))
            else:
                known += 1
        if known > len(ids) // 4:  # looking up all roots pays once so many pairs were looked at in vain
            mine, known = np.fromiter(map(forest.root, range(len(ids))), np.int64, len(ids))[label], 0
    a = ids[np.array(out, np.int64).reshape(-1, 2)].view(np.int64)
    return pa.table({"a": a[:, 0], "b": a[:, 1]})


def _candidates(key, t, buckets, num, den):
    """Packed postings of a bucket → links between candidate lines; those of very frequent words → a row each."""
    rows = np.frombuffer(b"".join(t["rows"].to_pylist()), _POSTING)
    wide = np.frombuffer(b"".join(t["wide"].to_pylist()), np.uint64).reshape(-1, WIDE)
    if t["bucket"][0].as_py() < buckets:
        out = _links(rows, wide, num, den)
        none = pa.nulls(out.num_rows, pa.binary())
        return out.append_column("w", pa.nulls(out.num_rows, pa.int64())).append_column("row", none).append_column("wide", none)
    long = iter(wide.tolist())
    return pa.table({"a": pa.nulls(len(rows), pa.int64()), "b": pa.array(rows["k"].astype(np.uint64).view(np.int64)),
                     "w": pa.array(rows["w"].astype(np.int64)), "row": pa.array([r.tobytes() for r in rows], pa.binary()),
                     "wide": pa.array([np.array(next(long), np.uint64).tobytes() if n > LONG else None
                                       for n in rows["n"].tolist()], pa.binary())})


def _frequent(key, t, num, den):
    """One block, or pair of blocks, of a frequent word's postings → links between candidate lines."""
    rows = np.frombuffer(b"".join(t["row"].to_pylist()), _POSTING)
    wide = np.frombuffer(b"".join(x for x in t["wide"].to_pylist() if x), np.uint64).reshape(-1, WIDE)
    side = t["side"].to_numpy()
    return _links(rows, wide, num, den, None if side[0] < 0 else side)


def in_blocks(df: DataFrame, count: str, block: int, spread: str) -> DataFrame:
    """Rows of a group of ``count`` rows → for each pair of its blocks of about ``block`` rows, ``x, y, side``.

    ``side`` is -1 where a block meets itself, else 0 or 1 for the two blocks. A group of one block stays as it is.
    """
    n = F.ceil(F.col(count) / block).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("__n") - 1), lambda o: F.struct(
        F.least(o, F.col("__own")).alias("x"), F.greatest(o, F.col("__own")).alias("y"),
        F.when(o == F.col("__own"), -1).when(o < F.col("__own"), 1).otherwise(0).alias("side")))
    d = df.withColumn("__n", n).withColumn("__own", F.pmod(F.xxhash64(spread), F.col("__n")).cast("int"))
    return d.withColumn("__p", F.explode(pair)).select("*", "__p.x", "__p.y", "__p.side").drop("__n", "__own", "__p")


def _bitmap(batches, bits):
    """Places (id, line) → a bitmap of their hashes, in chunks."""
    m = np.zeros(1 << bits, bool)
    for t in batches:
        m[_place(t.column(0).to_numpy(zero_copy_only=False), t.column(1).to_numpy(zero_copy_only=False)) & np.uint64((1 << bits) - 1)] = True
    packed = np.packbits(m).reshape(-1, CHUNK)
    for c in np.flatnonzero(packed.any(1)):
        yield pa.RecordBatch.from_arrays([pa.array([int(c)], pa.int32()), pa.array([packed[c].tobytes()], pa.binary())],
                                         ["chunk", "counts"])


def _or(key, t):
    total = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in t["counts"].to_pylist()])
    return pa.table({"chunk": t["chunk"].slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})


def _place(ids: np.ndarray, no: np.ndarray) -> np.ndarray:
    """A hash of a line's place: document id and line number."""
    return mix(mix(ids.view(np.uint64).copy(), 4) ^ no.astype(np.uint64), 5)


def _sets(batches, bitmap):
    """(id, text) → class and words of the lines at places that the bitmap holds; only these are cut into words."""
    bitmap, seen = bitmap.value, set()
    size = np.uint64(len(bitmap) * 8 - 1)
    for t in sliced(batches):
        ids = t.column(0).to_numpy(zero_copy_only=False)

        def hit(doc, no):
            cell = _place(ids[doc], no) & size
            return bitmap[(cell >> np.uint64(3)).astype(np.int64)] >> (7 - (cell & np.uint64(7))).astype(np.uint8) & 1 > 0

        for x in lines_of(t.column(1), hit):
            if len(seen) > 200_000:
                seen.clear()
            out = []
            for i in range(len(x.no)):
                k = int(x.k1[i]), int(x.k2[i])
                if k not in seen:
                    seen.add(k)
                    out.append((*k, x.words[x.cuts[i]:x.cuts[i + 1]].tobytes()))
            if out:
                k1, k2, w = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(k1, np.uint64).view(np.int64)), pa.array(np.array(k2, np.uint64).view(np.int64)),
                     pa.array(w, pa.binary())], ["k1", "k2", "words"])


def _overlaps(lines: list[np.ndarray]) -> np.ndarray:
    """Words that each two of the lines share; words in steps, so that memory stays bounded whatever the lines hold."""
    m, n = len(lines), [len(x) for x in lines]
    words, column = np.unique(np.concatenate(lines), return_inverse=True)
    row, shared = np.repeat(np.arange(m), n), np.zeros((m, m), np.float32)
    for s in range(0, len(words), 4096):
        part = (column >= s) & (column < s + 4096)
        x = np.zeros((m, min(4096, len(words) - s)), np.float32)
        x[row[part], column[part] - s] = 1
        shared += x @ x.T
    return shared


def _verify(key, t, num, den):
    """Groups of candidates (or one pair of blocks of a large group) → links of each line and its earliest partner."""
    group = t["component"].to_numpy()
    order = np.argsort(group, kind="stable")
    cut = np.r_[np.flatnonzero(np.r_[True, np.diff(group[order]) != 0]), len(group)]
    words, sides = t["words"].to_pylist(), t["side"].to_numpy()
    doc, no = t["first_id"].to_numpy(), t["first_line"].to_numpy()
    rank = np.empty(len(doc), np.int64)
    at = np.lexsort((no, doc))
    rank[at] = np.arange(len(doc))
    pick, links, best = [], [], []
    for s, e in zip(cut, cut[1:]):
        rows = order[s:e]
        lines = [np.frombuffer(words[i], np.uint64) for i in rows]
        n, side = np.array([len(x) for x in lines], np.int64), sides[rows]
        link = _overlaps(lines) >= need(n[:, None], n[None, :], num, den)
        np.fill_diagonal(link, False)
        if side[0] >= 0:
            link &= side[:, None] != side[None, :]
        some = link.any(1)
        pick.append(rows[some])
        links.append(link.sum(1)[some])
        best.append(at[np.where(link, rank[rows][None, :], len(doc)).min(1)[some]])
    pick, best = np.concatenate(pick), np.concatenate(best)
    return pa.table({"k1": t["k1"].take(pa.array(pick)), "k2": t["k2"].take(pa.array(pick)),
                     "links": pa.array(np.concatenate(links), pa.int64()),
                     "near_id": pa.array(doc[best]), "near_line": pa.array(no[best], pa.int32())})


def similar_lines(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", num: int = 4, den: int = 5,
                  sketch_bits: int = 20, block: int = 512) -> DataFrame:
    """One row per line with a word: ``doc_id, text_key, line_no, class_doc, class_line, n_links, removed``.

    Words are cut at ASCII white space after lower-casing A-Z; lines at line feeds, numbered from 0.
    ``class_doc, class_line`` is the first place of a line with the same set of words, ``n_links``
    counts the other classes of Jaccard similarity ``num/den`` or more, and ``removed`` tells that an
    equal or similar line stands at an earlier place (document id, then line). Lines without a word
    (and so null or empty texts) have no row; very long texts and lines are taken whole. A row without id comes after all others; rows that
    repeat an id stand at the same places and keep or lose equal lines alike; ``text_key`` (a hash of
    the whole text) tells different texts of one id apart. Other columns are ignored.
    """
    spark = docs.sparkSession
    d = docs.select(F.coalesce(col(doc).cast("long"), F.lit(LAST)).alias("id"), col(text).alias("text"))
    rows = saved(d.mapInArrow(partial(_classes, bits=sketch_bits), "id long, text_key long, line_no int, k1 long, k2 long, "
                              "chunk int, counts binary"), "lines")
    lines = rows.where("chunk is null").select("id", "text_key", "line_no", "k1", "k2")
    levels, hot, total = _levels(rows.where("chunk is not null").select("chunk", "counts"), sketch_bits)
    levels = spark.sparkContext.broadcast(levels)
    same = dict(num=num, den=den)
    buckets = max(512, total // (1 << 20))
    post = d.mapInArrow(partial(_postings, levels=levels, hot=hot, buckets=buckets, **same), "bucket int, rows binary, wide binary")
    got = saved(post.groupBy("bucket").applyInArrow(partial(_candidates, buckets=buckets, **same),
                                                    "a long, b long, w long, row binary, wide binary"), "line-candidates")
    often = got.where("a is null").select("w", F.col("b").alias("k"), "row", "wide")
    size = saved(often.groupBy("w").count().where("count > 1"), "line-words")
    edges = got.where("a is not null").select("a", "b").union(
        in_blocks(often.join(size, "w"), "count", 4096, "k").groupBy("w", "x", "y").applyInArrow(
            partial(_frequent, **same), "a long, b long"))
    comp = saved(components(edges).withColumnRenamed("id", "k1"), "line-groups")
    first = lines.groupBy("k1", "k2").agg(F.min(F.struct("id", "line_no")).alias("first"))
    first = saved(first.select("k1", "k2", F.col("first.id").alias("first_id"), F.col("first.line_no").alias("first_line")),
                  "line-classes")
    # the first line of each class with candidates is where its words are read
    places = first.join(comp.select("k1"), "k1").select("first_id", "first_line")
    chunks = places.mapInArrow(partial(_bitmap, bits=23), "chunk int, counts binary")
    bitmap = np.zeros(1 << 20, np.uint8)
    for r in chunks.groupBy("chunk").applyInArrow(_or, "chunk int, counts binary").toLocalIterator():
        bitmap[r.chunk * CHUNK:(r.chunk + 1) * CHUNK] = np.frombuffer(r.counts, np.uint8)
    bitmap = spark.sparkContext.broadcast(bitmap)
    sets = d.mapInArrow(partial(_sets, bitmap=bitmap), "k1 long, k2 long, words binary")
    sets = saved(sets.groupBy("k1", "k2").agg(F.first("words").alias("words")), "line-sets")
    sets = saved(sets.join(comp, "k1").join(first, ["k1", "k2"]), "line-sets")
    size = saved(sets.groupBy("component").count().where("count > 1"), "line-group-sizes")
    dealt = in_blocks(sets.join(size, "component"), "count", block, "k1")
    # small groups share a task's step, by the hundred; the blocks of a large one get a step each
    large, hands = F.col("count") > block, max(64, sets.count() // 2000)
    dealt = dealt.withColumn("hand", F.when(large, F.col("component")).otherwise(F.pmod(F.xxhash64("component"), F.lit(hands))))
    found = dealt.withColumn("large", large).groupBy("large", "hand", "x", "y").applyInArrow(
        partial(_verify, **same), "k1 long, k2 long, links long, near_id long, near_line int")
    found = saved(found.groupBy("k1", "k2").agg(F.sum("links").alias("links"), F.min(F.struct("near_id", "near_line")).alias("near")),
                  "line-links")
    known = saved(first.join(found, ["k1", "k2"], "left").select(
        "k1", "k2", "first_id", "first_line", F.coalesce("links", F.lit(0)).alias("links"),
        F.least(F.struct(F.col("first_id").alias("a"), F.col("first_line").alias("b")),
                F.when(F.col("near").isNotNull(), F.struct(F.col("near.near_id").alias("a"), F.col("near.near_line").alias("b")))
                ).alias("least")), "line-known")
    out = lines.join(known, ["k1", "k2"])
    back = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return out.select(back("id").alias("doc_id"), "text_key", "line_no", back("first_id").alias("class_doc"),
                      F.col("first_line").alias("class_line"), F.col("links").alias("n_links"),
                      (F.struct(F.col("id").alias("a"), F.col("line_no").alias("b")) > F.col("least")).alias("removed"))


def drop_lines(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with the removed lines cut out of their texts; every row and all other columns stay.

    Blank lines stay where they are. A text whose lines are all removed becomes empty.
    """
    gone = (similar_lines(docs, doc=doc, text=text, **options).where("removed").groupBy("doc_id", "text_key")
            .agg(F.array_distinct(F.collect_list("line_no")).alias("gone")))
    gone = saved(gone, "removed-lines")
    rows = docs.select(whole(docs).alias("row"), col(text).alias("text"), col(doc).cast("long").alias("id"),
                       F.xxhash64(F.coalesce(col(text), F.lit(""))).alias("key"))
    out = rows.join(gone, (F.col("key") == F.col("text_key")) & F.col("id").eqNullSafe(F.col("doc_id")), "left")
    kept = F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains("gone", i))
    new = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return unpacked(out, "row", docs.columns, {text: new})


def op6_lines(spark, sf_dir):
    """Lines of all documents: class, links to similar lines, and whether an earlier one replaces them."""
    return similar_lines(table(spark, sf_dir, "documents")).drop("text_key")


OP6_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS s, unnest(range(0, len(string_split(text, chr(10))))) AS line_no FROM documents),
w AS (SELECT doc_id, line_no, list_sort(list_distinct(regexp_extract_all(translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x09-\x0D\x20]+'))) AS k FROM l),
x AS (SELECT * FROM w WHERE len(k) > 0),
c AS (SELECT k, len(k) AS n, min(struct_pack(d := doc_id, l := line_no)) AS f, row_number() OVER () AS id FROM x GROUP BY k),
t AS (SELECT id, n, unnest(k) AS t FROM c),
df AS (SELECT t, count(*) AS df FROM t GROUP BY t),
o AS (SELECT id, n, t, row_number() OVER (PARTITION BY id ORDER BY df, t) AS r FROM t JOIN df USING (t)),
p AS (SELECT * FROM o WHERE r <= n - (4 * n + 4) // 5 + 1),
q AS (SELECT DISTINCT a.id AS a, b.id AS b FROM p a JOIN p b ON a.t = b.t AND a.id <> b.id AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n),
v AS (SELECT q.a, y.f, len(list_intersect(x1.k, y.k)) AS s, x1.n + y.n AS m FROM q JOIN c x1 ON x1.id = q.a JOIN c y ON y.id = q.b),
g AS (SELECT a, count(*) AS n_links, min(f) AS near FROM v WHERE 5 * s >= 4 * (m - s) GROUP BY a)
SELECT x.doc_id, CAST(x.line_no AS INTEGER) AS line_no, c.f.d AS class_doc, CAST(c.f.l AS INTEGER) AS class_line,
       coalesce(n_links, 0) AS n_links,
       struct_pack(d := x.doc_id, l := x.line_no) > least(c.f, coalesce(g.near, c.f)) AS removed
FROM x JOIN c USING (k) LEFT JOIN g ON g.a = c.id
"""
