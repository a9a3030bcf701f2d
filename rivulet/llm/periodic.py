"""Periodic runs of words, found with an enhanced suffix array.

A run is a stretch of words that repeats with its smallest period at least
twice over and cannot be extended. The words of many texts are laid end to
end; a word gets another number in every text, so no match crosses texts.
Suffix array, inverse and LCP values come from prefix doubling. Every LCP
interval of depth d is a set of suffixes that share d words; wherever two of
them are d apart and lie in different child ranges, a branching square of
period d begins. Only the suffixes of the smaller child ranges are looked up,
on both sides, through the inverse array: n log n look-ups in all, and no
tree is built. Each run ends with its branching square; rotating the square
to the left gives the run, and squares of multiples of a run's period, which
end where it ends, are merged into it.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import col, sliced, table

LEAST = 12
#: Words laid end to end at once; a longer text is done alone.
WORDS = 200_000


def suffixes(s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, inverse and LCP (of each suffix with the one before it; 0 at the start) of a sequence.

    Ranks are doubled in length until all differ; only suffixes whose rank
    is still shared are sorted again.
    """
    n = len(s)
    sa = np.argsort(s, kind="stable")
    new = np.ones(n, bool)
    new[1:] = s[sa[1:]] != s[sa[:-1]]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[sa] = head
    ranks, h = [rank], 1
    while True:
        shared = ~new  # places whose suffix ties with the one before it, and the heads of such groups
        shared[:-1] |= ~new[1:]
        at = np.flatnonzero(shared)
        if not len(at):
            break
        i = sa[at]
        low = rank[np.minimum(i + h, n)]
        key = rank[i] * (n + 1) + low + 1
        order = np.argsort(key)
        i, key = i[order], key[order]
        sa[at] = i
        new[at[1:]] |= key[1:] != key[:-1]
        rank = rank.copy()
        rank[i] = np.maximum.accumulate(np.where(new, np.arange(n), 0))[at]
        ranks.append(rank)
        h *= 2
    lcp = np.zeros(n, np.int64)
    at = np.flatnonzero(s[sa[1:]] == s[sa[:-1]]) + 1
    a, b = sa[at - 1], sa[at]
    done = np.zeros(len(at), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        same = ranks[k][np.minimum(a + done, n)] == ranks[k][np.minimum(b + done, n)]
        done[same] += 1 << k
    lcp[at] = done
    return sa, rank[:n], lcp


def _reach(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of ``at``, the first and last place of the widest stretch around it with no smaller LCP.

    Minima over powers of two, doubled as long as any stretch is that wide.
    """
    mins, size = [lcp], 1
    while size < len(lcp):
        low = mins[-1]
        both = np.minimum(low[:-size], low[size:])
        if not both.any():  # zeros part the texts and the words
            break
        mins.append(both)
        size *= 2
    depth, left, right = lcp[at], at.copy(), at.copy()
    for k in range(len(mins) - 1, -1, -1):
        m, w = mins[k], 1 << k
        ok = left >= w
        ok[ok] = m[left[ok] - w] >= depth[ok]
        left[ok] -= w
        ok = right + w < len(lcp)
        ok[ok] = m[right[ok] + 1] >= depth[ok]
        right[ok] += w
    return left, right


def branching_squares(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (start, period) such that the period is repeated at once and then not carried on."""
    none = np.empty(0, np.int64)
    sa, isa, lcp = suffixes(s)
    at = np.flatnonzero(lcp)
    if not len(at):
        return none, none
    left, right = _reach(lcp, at)
    lb = left - 1  # an interval's first suffix has a smaller LCP with the one before it
    # one interval for all places with its bounds; each such place starts a child range, and so does lb
    order = np.lexsort((at, right, lb))
    at, lb, rb = at[order], lb[order], right[order]
    first = np.ones(len(at), bool)
    first[1:] = (lb[1:] != lb[:-1]) | (rb[1:] != rb[:-1])
    head = np.flatnonzero(first)
    number = np.cumsum(first) - 1
    starts = np.insert(at, head, lb[head])
    owner = np.insert(number, head, np.arange(len(head)))
    last = np.ones(len(starts), bool)
    last[:-1] = owner[1:] != owner[:-1]
    ends = np.empty(len(starts), np.int64)
    ends[:-1] = starts[1:] - 1
    ends[last] = rb[head]
    size = ends - starts + 1
    begin = np.searchsorted(owner, np.arange(len(head)))
    widest = np.maximum.reduceat(size, begin)
    big = np.flatnonzero(size == widest[owner])
    small = np.ones(len(size), bool)
    small[big[np.unique(owner[big], return_index=True)[1]]] = False  # the first of the largest ranges
    starts, size, owner = starts[small], size[small], owner[small]
    depth = lcp[at[head]]
    lb, rb = lb[head], rb[head]
    out = []
    step = 1 << 22  # ranges are opened in pieces, so that memory stays bounded
    cut = np.searchsorted(np.cumsum(size), np.arange(step, size.sum() + step, step), side="left") + 1
    for a, b in zip([0, *cut[:-1].tolist()], cut.tolist()):
        n, o = size[a:b], np.repeat(owner[a:b], size[a:b])
        if not len(o):
            continue
        place = np.arange(len(o)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[a:b], n)
        i, d = sa[place], depth[o]
        for start in (i, i - d):
            ok = (start >= 0) & (start + d < len(s))
            x, dx, ox = start[ok], d[ok], o[ok]
            other = isa[np.where(start is i, x + dx, x)]
            ok = (other >= lb[ox]) & (other <= rb[ox])
            x, dx = x[ok], dx[ok]
            after = x + 2 * dx
            ends_here = after >= len(s)
            ends_here[~ends_here] = s[after[~ends_here]] != s[x[~ends_here]]
            out.append(np.stack([x[ends_here], dx[ends_here]]))
    if not out:
        return none, none
    start, period = np.unique(np.concatenate(out, 1), axis=1)
    return start, period


def _rotated(s: np.ndarray, start: int, period: int) -> int:
    """Where the run of a square begins: the square is rotated left while the words stay a period apart."""
    step = 16
    while start > 0:
        w = min(step, start)
        differ = np.flatnonzero(s[start - w:start] != s[start - w + period:start + period])
        if len(differ):
            return start - w + int(differ[-1]) + 1
        start, step = start - w, step * 2
    return 0


def runs(s: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``least`` elements, by start, then period."""
    start, period = branching_squares(s)
    end = start + 2 * period
    order = np.lexsort((period, end))
    out, at, here = [], -1, []
    for k, (x, p, e) in enumerate(zip(start[order].tolist(), period[order].tolist(), end[order].tolist())):
        if e != at:
            at, here = e, []
        if any(p % q == 0 and b <= x for b, q in here):
            continue
        b = _rotated(s, x, p)
        here.append((b, p))
        if e - b >= least:
            out.append((b, e - b, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def dropped(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """True for elements that a run holds after its first period."""
    step = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        step[start + period] += 1
        step[start + length] -= 1
    return np.cumsum(step[:-1]) > 0


def _sha(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


def _result(words: list[bytes], found: list[tuple[int, int, int]]) -> tuple:
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    kept = words if not found else [w for w, gone in zip(words, dropped(len(words), found).tolist()) if not gone]
    collapsed = b" ".join(kept)
    return (len(found), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            _sha(b"".join(b"%d,%d,%d\n" % r for r in found)), _sha(collapsed), found, collapsed.decode())


def _flush(texts: list[list[bytes]]) -> list[tuple]:
    """Results of several texts, their words laid end to end with numbers that differ between texts."""
    ids, base, bounds = [], 0, [0]
    for words in texts:
        number: dict[bytes, int] = {}
        ids += [base + number.setdefault(w, len(number)) for w in words]
        base += len(number)
        bounds.append(len(ids))
    found: list[list] = [[] for _ in texts]
    if ids:
        got = runs(np.array(ids, np.int64))
        owner = np.searchsorted(bounds, [r[0] for r in got], side="right") - 1 if got else []
        for k, (start, length, period) in zip(owner, got):
            found[k].append((start - bounds[k], length, period))
    return [_result(w, f) for w, f in zip(texts, found)]


_KINDS = {"n_runs": pa.int64(), "start": pa.int64(), "length": pa.int64(), "period": pa.int64(), "exponent_milli": pa.int64(),
          "runs_sha256": pa.string(), "collapsed_sha256": pa.string(),
          "runs": pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])), "collapsed": pa.string()}


def _find(batches, planted: bool, full: bool):
    names = list(_KINDS) if full else list(_KINDS)[:-2]

    def out(ids, texts):
        got = _flush(texts)
        cols = [pa.array([g[k] if c != "runs" else [{"start": a, "length": b, "period": p} for a, b, p in g[k]] for g in got], _KINDS[c])
                for k, c in enumerate(_KINDS) if c in names]
        return pa.RecordBatch.from_arrays([pa.array(ids, kind), *cols], ["id", *names])

    kind, ids, texts, size = None, [], [], 0
    for t in sliced(batches, 256):
        kind = t.column(0).type
        for i, text in zip(t.column(0).to_pylist(), t.column(1).to_pylist()):
            words = text.encode().split() if text else []  # bytes.split() parts at the space and \x09-\x0D only
            if planted:
                words = plant(i, words)
            if texts and size + len(words) > WORDS:
                yield out(ids, texts)
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(words)
            size += len(words)
    if texts:
        yield out(ids, texts)


def plant(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Words of about every tenth text, from some word on replaced by repeats of what stands there."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def periodic_runs(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", planted: bool = False, full: bool = True) -> DataFrame:
    """Runs of every text, and the text without the repeats.

    Returns ``id, n_runs``; ``start, length, period, exponent_milli`` of the
    longest run (the first of equals; null without any); ``runs_sha256`` of
    the list of runs and ``collapsed_sha256`` of the kept words; with
    ``full`` also ``runs`` and ``collapsed`` themselves. ``planted`` puts
    repeats into some texts first (see :func:`plant`).

    Null, empty and blank texts have no words and no runs. Very long texts
    are searched whole; one of more than ``WORDS`` words is searched alone, in
    memory of about 200 bytes a word for ordinary text. A null id keeps its row and plants nothing;
    repeated ids and rows keep their rows; an empty table gives no rows; other
    columns are ignored.
    """
    d = docs.select(col(doc).alias("id"), col(text).cast("string").alias("text"))
    names = list(_KINDS) if full else list(_KINDS)[:-2]
    kinds = {"runs": "array<struct<start:long,length:long,period:long>>"}
    kinds |= {c: "string" if t == pa.string() else "long" for c, t in _KINDS.items() if c != "runs"}
    schema = f"id {d.schema['id'].dataType.simpleString()}, " + ", ".join(f"{c} {kinds[c]}" for c in names)

    return d.mapInArrow(partial(_find, planted=planted, full=full), schema)


def op12_runs(spark, sf_dir):
    """Runs of all documents, about a tenth of them with repeats planted."""
    out = periodic_runs(table(spark, sf_dir, "documents"), planted=True, full=False)
    return out.withColumnRenamed("id", "doc_id")
