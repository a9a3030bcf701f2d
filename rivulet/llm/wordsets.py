"""Lines of texts as sets of hashed words, a whole batch at a time in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: A-Z to a-z; tab, vertical tab, form feed and carriage return to a blank; line feeds stay.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else 32 if b in (9, 11, 12, 13) else b for b in range(256)], np.uint8)
_TAB = np.random.default_rng(64).integers(0, 2**64, (64, 256), np.uint64)  # tabulation hashing by place and byte
_FLAT = _TAB.ravel()
STEP = 2 << 20


def mix(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


@dataclass
class Lines:
    """Lines with at least one word: document, number, words (distinct hashes, by ``cuts``), 128-bit class and parity."""

    doc: np.ndarray
    no: np.ndarray
    cuts: np.ndarray
    words: np.ndarray
    k1: np.ndarray
    k2: np.ndarray
    p1: np.ndarray
    p2: np.ndarray

    @property
    def n(self) -> np.ndarray:
        return np.diff(self.cuts)


def by_line(line: np.ndarray, words: np.ndarray, level: np.ndarray | None = None) -> np.ndarray:
    """The order by line, then level (a byte, if given), then word.

    One sort of a key that holds the line, the level and the leading bits of
    the word; only where such keys of different words are equal is the slower
    sort by all three needed.
    """
    bits = np.uint64(max(1, int(line[-1]).bit_length() if len(line) else 1))
    rest = np.uint64(64) - bits
    key = line.astype(np.uint64) << rest
    if level is None:
        key |= words >> bits
    else:
        key |= (level.astype(np.uint64) << (rest - np.uint64(8))) | (words >> (bits + np.uint64(8)))
    order = np.argsort(key)
    key, w = key[order], words[order]
    if np.any((key[1:] == key[:-1]) & (w[1:] != w[:-1])):
        return np.lexsort((words, line) if level is None else (words, level, line))
    return order


def _hashed(raw: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the words in ``raw``; a word never crosses a ``start``."""
    b = _FOLD[raw]
    gap = (b == 32) | (b == 10)
    first = ~gap
    begins = np.zeros(len(b) + 1, bool)
    begins[start] = True
    first[1:] &= gap[:-1] | begins[1:-1]
    at = np.flatnonzero(first)
    if not len(at):
        return at, np.empty(0, np.uint64)
    inside = np.flatnonzero(~gap)
    starts = np.searchsorted(inside, at)  # of each word's bytes among all words' bytes
    place = np.arange(len(inside)) - np.repeat(starts, np.diff(np.append(starts, len(inside)))) if len(at) else inside
    c = _FLAT[((place & 63) << 8) | b[inside]]
    if place.max() >= 64:
        c = c * (np.uint64(2) * (place >> 6).astype(np.uint64) + np.uint64(1))
    return at, mix(np.add.reduceat(c, starts), 0)


def _parse(raw: np.ndarray, start: np.ndarray, doc: np.ndarray, no: np.ndarray) -> Lines | None:
    """``raw`` bytes holding lines that begin at ``start``; ``doc`` and ``no`` name them."""
    at, h = _hashed(raw, start)
    if not len(at):
        return None
    line = np.searchsorted(start, at, "right") - 1
    order = by_line(line, h)
    h, line = h[order], line[order]
    keep = np.r_[True, (h[1:] != h[:-1]) | (line[1:] != line[:-1])]
    h, line = h[keep], line[keep]
    cut = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
    bit = np.uint64(1) << (h >> np.uint64(58))
    upper = (h >> np.uint64(57)) & np.uint64(1) == 1
    line = line[cut]
    return Lines(doc[line], no[line], np.r_[cut, len(h)], h, np.add.reduceat(mix(h, 1), cut), np.add.reduceat(mix(h, 2), cut),
                 np.bitwise_xor.reduceat(np.where(upper, 0, bit), cut), np.bitwise_xor.reduceat(np.where(upper, bit, 0), cut))


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a batch of texts (null is empty) and where each begins, with the end."""
    texts = pa.concat_arrays([texts.cast(pa.large_binary()).fill_null(b"")])
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return raw, offsets - offsets[0]


def words_of(texts: pa.Array):
    """(texts, cuts, hashes): word hashes of a few texts at a time, in order; ``cuts`` bound those of each."""
    raw, offsets = _bytes_of(texts)
    s = 0
    while s < len(texts):
        e = max(s + 1, int(np.searchsorted(offsets, offsets[s] + STEP, "right")) - 1)
        part, start = raw[offsets[s]:offsets[e]], offsets[s:e] - offsets[s]
        if len(part) <= 2 * STEP:
            at, h = _hashed(part, start[start < len(part)])
        else:  # one long text, cut at blanks
            at, h, done = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], 0
            while done < len(part):
                end = min(len(part), done + STEP)
                while end < len(part) and part[end] not in b" \n\t\r":
                    end += 1
                x, y = _hashed(part[done:end], np.zeros(1, np.int64))
                at, h, done = at + [x + done], h + [y], end
            at, h = np.concatenate(at), np.concatenate(h)
        yield np.arange(s, e), np.searchsorted(at, np.r_[start, len(part)]), h
        s = e


def text_keys(texts: pa.Array) -> np.ndarray:
    """As Spark's xxhash64 of each text, null as empty."""
    import xxhash

    return np.array([xxhash.xxh64_intdigest(x or b"", 42) for x in texts.cast(pa.binary()).to_pylist()], np.uint64).view(np.int64)


def lines_of(texts: pa.Array, pick=None):
    """``Lines`` of a batch of texts, a few megabytes at a time; a long text is cut between lines.

    ``pick(doc, no)`` tells which lines are wanted; the others are not cut into words.
    """
    raw, offsets = _bytes_of(texts)
    if not len(raw):
        return
    breaks = np.flatnonzero(raw == 10) + 1
    start = np.concatenate([offsets[:-1][np.diff(offsets) > 0], breaks[breaks < len(raw)]])
    start = np.unique(start)
    doc = np.searchsorted(offsets, start, "right") - 1
    no = np.searchsorted(breaks, start, "right") - np.searchsorted(breaks, offsets[doc], "right")
    if pick is not None:
        few = np.flatnonzero(pick(doc, no))
        size = np.append(start[1:], len(raw))[few] - start[few]
        ends, s = np.cumsum(size), 0
        while s < len(few):
            e = max(s + 1, int(np.searchsorted(ends, ends[s] - size[s] + STEP, "right")))
            at = ends[s:e] - size[s:e] - (ends[s] - size[s])
            part = np.concatenate([raw[a:a + n] for a, n in zip(start[few[s:e]].tolist(), size[s:e].tolist())])
            got = _parse(part, at, doc[few[s:e]], no[few[s:e]])
            if got is not None:
                yield got
            s = e
        return
    s = 0
    while s < len(start):
        e = max(s + 1, int(np.searchsorted(start, start[s] + STEP, "right")) - 1)
        end = start[e] if e < len(start) else len(raw)
        if e >= len(start) - 1 and len(raw) - start[s] <= STEP:
            e, end = len(start), len(raw)
        got = _parse(raw[start[s]:end], start[s:e] - start[s], doc[s:e], no[s:e])
        if got is not None:
            yield got
        s = e
