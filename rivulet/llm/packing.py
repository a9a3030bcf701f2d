"""Packing: cut documents into token windows and pack the rests by best-fit decreasing.

Each text is tokenized once, in place. Its ids (and one end id) are cut into
full windows and a rest. Only the small rows of the pieces are shuffled: they
are dealt into groups of about ``group_pieces``, and in each group a segment
tree indexed by remaining capacity finds the tightest open window for each
piece, longest first. A group is large enough that its padding is a few
windows' worth, and no group or task grows with the corpus.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
import zlib
from functools import partial
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import col, held, saved, sliced, table

#: Control characters other than white space, special-token marks and the sigma of context-dependent case.
_ODD = re.compile("[\x00-\x08\x0e-\x1f\x7f-\x9f]|<\\||Σ")
_NOT_LATIN = re.compile("[^\x00-ɏ]")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies use for each byte: itself if printable, else from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


# The normalizer, pre-tokenizer and model settings that Encoder takes apart.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
                                                   {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_MODEL = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "byte_fallback": False}


def taken_apart(spec: str) -> bool:
    """Whether a tokenizer works the way :class:`Encoder` relies on; all others are run as they are."""
    d = json.loads(spec)
    model = d.get("model") or {}
    marks = all(t["content"].startswith("<|") and not t.get("normalized") for t in d.get("added_tokens") or [])
    return (d.get("normalizer") == _NORMALIZER and d.get("pre_tokenizer") == _PRE_TOKENIZER and marks
            and all(model.get(k) == v for k, v in _MODEL.items()))


class _Memory(dict):
    """What has been made of up to ``limit`` words. When it is full it starts anew, and keeps what is asked again."""

    def __init__(self, make, limit: int):
        self.make, self.limit, self.before = make, limit, {}

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.before = self.copy()
            self.clear()
        got = self.before.get(word)
        if got is None:
            got = self.make(word)
        self[word] = got
        return got


class Encoder:
    """Token ids of texts as little-endian bytes, with a bounded memory of words already encoded.

    Where the tokenizer's parts are the known ones (:func:`taken_apart`), its
    pre-tokenizer never joins across white space, so a text's ids are those
    of its blank-separated chunks in turn. Chunks of Latin letters go to the
    BPE model directly; anything unusual goes through the whole tokenizer,
    and so do all texts of any other tokenizer.
    """

    def __init__(self, spec: str, limit: int = 500_000):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer, self.limit, self.by_chunks = Tokenizer.from_str(spec), limit, taken_apart(spec)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        self.letters = _byte_letters()
        self.ids_of = _Memory(self._chunk, limit).__getitem__  # of chunks and of their pieces, which are chunks too

    def _whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        form = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
        return _packed([x.id for x in self.tokenizer.model.tokenize(form)])

    def _chunk(self, chunk: str) -> bytes:
        if not chunk.isascii() and _NOT_LATIN.search(chunk):
            return self._whole(chunk)
        if chunk.isalpha():
            return self._piece(chunk)
        if chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
            return self.ids_of(chunk[:-1]) + self.ids_of(chunk[-1])
        pieces = self.pieces(chunk)
        return self._piece(pieces[0]) if len(pieces) == 1 else b"".join(map(self.ids_of, pieces))

    def __call__(self, text: str) -> bytes:
        if not self.by_chunks or _ODD.search(text):
            return self._whole(text)
        if text.isascii():
            text = text.lower()
        elif not _NOT_LATIN.search(text):
            text = unicodedata.normalize("NFC", text).lower()
        else:
            text = " ".join([c if _NOT_LATIN.search(c) else unicodedata.normalize("NFC", c).lower() for c in text.split()])
        return b"".join(map(self.ids_of, text.split()))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _cut(batches, spec, key, window, end_id, with_ids):
    encode, task, n = held(key, lambda: Encoder(spec.value)), TaskContext.get().partitionId(), 0
    for t in sliced(batches):
        rows = []
        for doc, text in zip(t.column(0).to_pylist(), t.column(1).to_pylist()):
            ids = encode(text or "") + end_id.to_bytes(4, "little")
            total = len(ids) // 4
            for start in range(0, total, window):
                part = ids[4 * start:4 * (start + window)]
                rows.append((doc, start, len(part) // 4, zlib.crc32(part), total, task, n, part if with_ids else None))
                n += 1
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "n", "ids"]
        kinds = [t.schema.field(0).type, *[pa.int64()] * 6, pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 8, kinds)], names)


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window number and offset of each length; ``lengths`` must be in decreasing order.

    Leaf ``c`` of the segment tree counts the open windows with exactly ``c``
    ids left, an inner node those below it; the tightest fit is the first
    counted leaf at or right of the length.
    """
    size = 1
    while size < window + 1:
        size *= 2
    tree, opened = [0] * (2 * size), [[] for _ in range(window + 1)]
    where, offset, windows = [], [], 0

    def add(cap: int, by: int) -> None:
        i = cap + size
        while i:
            tree[i] += by
            i //= 2

    for n in lengths:
        i = n + size
        while i and not tree[i]:
            while i & 1:  # nothing further right below the parent of a right child
                i >>= 1
            i += i > 0
        while 0 < i < size:
            i = 2 * i if tree[2 * i] else 2 * i + 1
        if i:
            cap = i - size
            w = opened[cap].pop()
            add(cap, -1)
        else:
            cap, w, windows = window, windows, windows + 1
        where.append(w)
        offset.append(window - cap)
        if cap > n:
            opened[cap - n].append(w)
            add(cap - n, 1)
    return where, offset


def _fit(rows: pd.DataFrame, window: int) -> pd.DataFrame:
    rows = rows.sort_values(["length", "task", "n"], ascending=[False, True, True], kind="stable")
    where, offset = best_fit(rows["length"].tolist(), window)
    rows["sequence_id"] = rows["group"] * (1 << 32) + pd.Series(where, index=rows.index, dtype="int64")
    rows["offset"] = pd.Series(offset, index=rows.index, dtype="int64")
    return rows


def pack(docs: DataFrame, spec: str, *, doc: str = "doc_id", text: str = "text", window: int = 2048, end_id: int = 1,
         group_pieces: int = 4096, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``).

    ``spec`` is the tokenizer's JSON text. Each document is its ids and ``end_id``; an empty or null
    text is that one id; a very long one is cut into as many windows as it fills. ``start`` counts its ids before the piece. Pieces of one ``sequence_id``
    fill it without gaps from offset 0. Null and repeated ids are kept: every row is a document of
    its own. An empty table gives no rows; other columns are ignored. With ``with_ids`` the ids come
    as little-endian 32-bit integers, for ``sequences``.
    """
    spark = docs.sparkSession
    d = docs.select(col(doc).alias("doc_id"), col(text).alias("text"))
    cut = partial(_cut, spec=spark.sparkContext.broadcast(spec), key=hashlib.sha256(spec.encode()).hexdigest(), window=window, end_id=end_id, with_ids=with_ids)
    kind = d.schema["doc_id"].dataType.simpleString()
    row = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, task long, n long"
    pieces = saved(d.mapInArrow(cut, f"{row}, ids binary"), "pieces")
    groups = max(1, round(pieces.count() / group_pieces))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("task", "n"), F.lit(groups)))
    small = dealt.drop("ids").groupBy("group").applyInPandas(
        partial(_fit, window=window), f"{row}, group long, sequence_id long, offset long")
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if not with_ids:
        return small.select(out)
    return small.join(pieces.select("task", "n", "ids"), ["task", "n"]).select(*out, "ids")


def sequences(packed: DataFrame, window: int = 2048) -> DataFrame:
    """``sequence_id, ids binary, n_ids, padded``: pieces put together in order of their offset.

    ``padded`` is the length to pad to: the window, or ``n_ids`` itself if that is a power of two.
    """
    whole = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"),
                                              F.sum("length").alias("n_ids"))
    power = F.bit_count("n_ids") == 1
    return whole.select("sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"), "n_ids",
                        F.when(power, F.col("n_ids")).otherwise(F.lit(window)).cast("long").alias("padded"))


def tokenizer_spec(path: str | None = None) -> str:
    """JSON of a tokenizer; by default the public word-level vocabulary, read on the driver."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return Path(path).read_text(encoding="utf-8")


def op10_pack(spark, sf_dir):
    """All documents packed into sequences of at most 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_spec())
