"""SimHash near-duplicates, compared in bit-sliced blocks.

A fingerprint bit is the majority of that bit over the hashes of all word
shingles. Distinct fingerprints are dealt by pairs of intact bands: two
fingerprints within ``radius`` bits agree on all but ``radius`` of
``radius + 2`` bands, so on two whole ones. Rows of a block (many such
buckets side by side) are stored as bit planes, one big integer per bit;
shifting a plane by ``d`` lines each row up with the ``d``-th after it, and
two carry-save counters and an overflow plane count the differing bits of
all rows at once until every pair of the block has overflowed. A bucket
too large for a block is dealt again by bands of its other bits, and what
is still too large is cut into pairs of sub-blocks.
"""

from __future__ import annotations

from functools import partial, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import Forest, col, components, saved, sliced, table, unpacked, whole

CHUNK = 1 << 15


def fingerprint(text: str | None, width: int = 3) -> int:
    """64-bit fingerprint of the whole text; zero if it has no word."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line, h64 = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1].tolist()
    ends = ends[width - 1:].tolist() or [len(line)]
    count = np.zeros(64, np.int64)
    for i in range(0, len(ends), CHUNK):
        h = np.array([h64(line[s:e], 42) for s, e in zip(starts[i:i + CHUNK], ends[i:i + CHUNK])], np.uint64)
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > len(ends), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches, width):
    for t in sliced(batches):
        fp = [fingerprint(x, width) for x in t.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([t.column(0), pa.array(np.array(fp, np.uint64).view(np.int64))], ["id", "fp"])


def fingerprints(docs: DataFrame, doc: str, text: str, width: int = 3) -> DataFrame:
    """``(id, fp)`` for every row; ``fp`` is the fingerprint as a signed long."""
    d = docs.select(col(doc).alias("id"), col(text).alias("text"))
    kind = d.schema["id"].dataType.simpleString()
    return d.mapInArrow(partial(_fingerprints, width=width), f"id {kind}, fp long")


def _close_pairs(fp: np.ndarray, same: np.ndarray, side: np.ndarray, radius: int):
    """Pairs (i, j), i < j, of a block within ``radius`` bits; rows i and i+1 share a bucket where ``same[i]``.

    In a bucket of two sub-blocks (``side`` 0 and 1, else -1) only pairs across them count. Yields
    arrays per distance in the order.
    """
    n = len(fp)
    bits = np.unpackbits(fp.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    planes = [int.from_bytes(np.packbits(bits[:, b], bitorder="little").tobytes(), "little") for b in range(64)]
    planes = [p for p in planes if p and p != (1 << n) - 1]  # a plane with one value differs nowhere
    as_int = lambda m: int.from_bytes(np.packbits(m, bitorder="little").tobytes(), "little")
    step, whole, right, valid, d = as_int(same), as_int(side < 0), as_int(side == 1), 0, 0
    levels = max(1, radius).bit_length()
    while True:
        valid = step if d == 0 else valid & (step >> d)
        d += 1
        if not valid:
            return
        live = valid & (whole | (right ^ (right >> d)))
        counts, over = [0] * levels, 0
        for p in planes:
            if not live & ~over:
                break
            carry = (p ^ (p >> d)) & live
            for k in range(levels):
                counts[k], carry = counts[k] ^ carry, counts[k] & carry
            over |= carry
        hits = live & ~over
        if (1 << levels) - 1 != radius:  # counters reach further than the radius
            for value in range(radius + 1, 1 << levels):
                exact = hits
                for k in range(levels):
                    exact &= counts[k] if value >> k & 1 else ~counts[k]
                hits &= ~exact
        if hits:
            raw = np.frombuffer(hits.to_bytes(n // 8 + 1, "little"), np.uint8)
            i = np.flatnonzero(np.unpackbits(raw, bitorder="little"))
            yield i, i + d


def _block_links(fp, same, side, radius):
    forest, label = Forest(len(fp)), np.arange(len(fp))
    for i, j in _close_pairs(fp, same, side, radius):
        new = label[i] != label[j]  # most pairs of a dense bucket are connected already
        if new.any():
            for a, b in zip(i[new].tolist(), j[new].tolist()):
                if forest.join(a, b):
                    yield int(fp[a]), int(fp[b])
            label = np.fromiter(map(forest.root, range(len(fp))), np.int64, len(fp))


def _sliced(batches, radius, block):
    """Rows (key, side, fp) sorted by key → links, a block of whole buckets at a time."""
    def links(key, side, fp):
        if len(fp) < 2:
            return None
        same = np.r_[key[1:] == key[:-1], False]
        near = same | np.r_[False, same[:-1]]  # rows alone in their bucket need no look
        if not near.any():
            return None
        key, side, fp = key[near], side[near], fp[near]
        same = np.r_[key[1:] == key[:-1], False]
        out = []
        cuts = [0]
        for e in (np.flatnonzero(~same) + 1).tolist():  # ends of buckets
            if e - cuts[-1] >= block:
                cuts.append(e)
        cuts += [len(fp)] if cuts[-1] < len(fp) else []
        for s, e in zip(cuts, cuts[1:]):
            out += _block_links(fp[s:e].view(np.uint64), np.r_[same[s:e - 1], False], side[s:e], radius)
        if out:
            a = np.array(out, np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["a", "b"])

    held = [np.empty(0, np.int64), np.empty(0, np.int8), np.empty(0, np.int64)]
    for t in batches:
        held = [np.concatenate([h, t.column(i).to_numpy(zero_copy_only=False)]) for i, h in enumerate(held)]
        if len(held[0]) and held[0][0] != held[0][-1]:
            last = np.searchsorted(held[0], held[0][-1])  # the last bucket may go on
            got = links(*[h[:last] for h in held])
            held = [h[last:] for h in held]
            if got is not None:
                yield got
    got = links(*held)
    if got is not None:
        yield got


def _bands(free: list[int], radius: int) -> list[tuple[int, list[int]]]:
    """(number, bits) of each pair of ``radius + 2`` bands of the free bits."""
    n = radius + 2
    bands = [free[i * len(free) // n:(i + 1) * len(free) // n] for i in range(n)]
    return list(enumerate(x + y for x, y in combinations(bands, 2)))


def _key(masks: list[tuple[int, int]], base: Column) -> Column:
    """Array of bucket keys: one per pair of bands, hashed with what the bucket is so far."""
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return F.array(*[F.xxhash64(base, F.lit(i), F.col("fp").bitwiseAND(F.lit(signed(m)))) for i, m in masks])


def links(fps: DataFrame, radius: int = 3, block: int = 2048) -> DataFrame:
    """``(a, b)`` fingerprints within ``radius`` bits of each other: enough links to connect all that are linked.

    ``fps`` has one row per distinct ``fp``. Every pair is compared in some block; of pairs already
    connected within a block one chain is returned.
    """
    none = F.lit(-1).cast("byte")
    todo, parts, free, level = fps.select("fp", F.lit(0).cast("long").alias("key")), [], list(range(64)), 0
    while True:
        pairs = _bands(free, radius)
        masks = [(i, sum(1 << b for b in bits)) for i, bits in pairs]
        rows = saved(todo.select("fp", F.explode(_key(masks, F.col("key"))).alias("key")), "simhash-keys")
        sizes = rows.groupBy("key").count().where(F.col("count") > block)
        sizes = saved(sizes, "simhash-large")
        large = not sizes.isEmpty()
        small = rows.join(sizes, "key", "left_anti") if large else rows
        parts.append(small.select("key", none.alias("side"), "fp"))
        if not large:
            break
        hot = rows.join(sizes, "key")
        level += 1
        if level == 2:  # cut what is left into sub-blocks, each compared with itself and with each other
            half = block // 2
            n = F.ceil(F.col("count") / half).cast("int")
            own = F.pmod(F.xxhash64("fp"), n).cast("int")
            pairs_of = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda o: F.struct(
                F.least(o, F.col("own")).alias("x"), F.greatest(o, F.col("own")).alias("y"),
                F.when(o == F.col("own"), -1).when(o < F.col("own"), 1).otherwise(0).cast("byte").alias("side")))
            sub = hot.select("fp", "key", n.alias("n"), own.alias("own")).select("fp", "key", F.explode(pairs_of).alias("p"))
            parts.append(sub.select(F.xxhash64("key", "p.x", "p.y").alias("key"), F.col("p.side").alias("side"), "fp"))
            break
        # Buckets of one level differ in their free bits, so all 64 are banded anew, interleaved.
        todo, free = hot.select("fp", "key"), [b for k in range(8) for b in range(k, 64, 8)]
    dealt = reduce(DataFrame.union, parts).repartition(F.col("key")).sortWithinPartitions("key")
    return dealt.mapInArrow(partial(_sliced, radius=radius, block=block), "a long, b long")


def near_duplicates(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", width: int = 3, radius: int = 3) -> DataFrame:
    """One row per document row: ``doc_id, fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most ``radius`` differing bits.
    Texts without a word (null, empty, white space) have fingerprint zero and are linked like any
    other. Repeated rows each get a row. A row without id gets a fingerprint and the component of its
    fingerprint, but is no one's smallest id; an empty table gives no rows. Other columns are ignored. Very long texts are read whole.
    """
    fp = saved(fingerprints(docs, doc, text, width), "fingerprints")
    least = saved(fp.groupBy("fp").agg(F.min("id").alias("least")), "fingerprint-classes")
    comp = components(links(least.select("fp"), radius)).select(F.col("id").alias("fp"), F.col("component").alias("root"))
    both = least.join(comp, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    both = saved(both, "fingerprint-roots")
    root = saved(both.groupBy("root").agg(F.min("least").alias("component_id")), "fingerprint-components")
    label = saved(both.join(root, "root").select("fp", "component_id"), "fingerprint-labels")
    return fp.join(label, "fp").select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                       "component_id")


def drop_near_duplicates(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each group of near-duplicates, the one with the smallest id, with all columns.

    Rows without id come after all others; among rows of one id, the hash of the text decides, and of
    equal rows one stays.
    """
    key = F.struct(F.coalesce(col(doc).cast("long"), F.lit(2**63 - 1)).alias("a"), F.xxhash64(col(text)).alias("b"))
    rows = docs.select(whole(docs).alias("row"), key.alias("key"), col(text).alias("text"))
    groups = near_duplicates(rows, doc="key", text="text", **options)
    keep = groups.where("doc_id = component_id").select(F.col("doc_id").alias("key")).distinct()
    kept = rows.select("row", "key").join(saved(keep, "kept"), "key", "left_semi").dropDuplicates(["key"])
    return unpacked(kept, "row", docs.columns)


def op7_simhash(spark, sf_dir):
    """SimHash components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))
