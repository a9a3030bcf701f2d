"""Personal data: fixed forms as seeds, and identifiers that only their contexts give away.

Emails, addresses, card and phone numbers of the usual forms are found by
fixed patterns; they are the seeds. Everything else of a text that looks
roughly like one of them (a card number with a wrong check digit, a phone
number without country code, an email without a dot) is a candidate. The
words around seeds and candidates are lexical patterns. Spark scores the
graph of patterns and instances in rounds: a pattern is kept if enough known
instances stand in it and almost nothing else does, and a candidate becomes
known if the kept patterns it stands in make it likely. Rounds end when
nothing new is known.
"""

from __future__ import annotations

import re
import uuid
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import col, held, saved, sliced, table

KINDS = ("email", "ip", "card", "phone")
START, UNIT = "<s>", "<id>"

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")  # a run of digits that starts no address is passed whole
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_ROUGH = re.compile(r"[0-9@]\S*")
_NUMERIC = re.compile(r"[0-9+().-]+")
_EDGES = ".,;:!?\"'[]{}<>|*$%#~“”„«»"


def _emails(text: str):
    """Leftmost matches of local part, @ and dotted domain, in time linear in the text.

    The local part is the run of its characters before an @, so each @ is looked at once.
    """
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(_LOCAL))
        free = at + 1
        if start < at:
            m = _DOMAIN.match(text, at + 1)
            if m:
                yield start, m.end()
                free = m.end()
        at = text.find("@", at + 1)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def seeds(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of all spans of the four fixed forms, by start, then kind."""
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if m.group(1) and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_DIGIT.findall(m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def shapes(unit: str) -> int:
    """Which kinds a rough identifier could be, as bits."""
    n = len(_DIGIT.findall(unit))
    name, at, host = unit.partition("@")
    mask = bool(at and "@" not in host and any(c.isalnum() for c in name) and any(c.isalnum() for c in host))
    if n and not unit.strip("0123456789abcdefABCDEF.:") and unit.count(".") + unit.count(":") >= 3:
        mask |= 2
    if 12 <= n <= 19 and not unit.strip("0123456789 .-"):
        mask |= 4
    if 7 <= n <= 15 and not unit.strip("0123456789 +().-/"):
        mask |= 8
    return int(mask)


def _rough(text: str) -> list[tuple[int, int]]:
    """Words with a digit or an @, without punctuation at their ends; neighbouring numbers are one."""
    out: list[tuple[int, int]] = []
    end = 0
    for m in _ROUGH.finditer(text):
        before = text[end:m.start()]
        s = m.start() if not before or before[-1].isspace() else m.start() - len(before.rsplit(None, 1)[-1])
        end = m.end()
        word = text[s:end]
        a, b = s + len(word) - len(word.lstrip(_EDGES)), s + len(word.rstrip(_EDGES))
        if b - a > 1 and text[a] == "(" and text.find(")", a, b) < 0:
            a += 1
        if b > a and text[b - 1] == ")" and text.find("(", a, b) < 0:
            b -= 1
        if a >= b:
            continue
        if out and a - out[-1][1] == 1 and text[a - 1] == " " and _NUMERIC.fullmatch(text, a, b) and _NUMERIC.fullmatch(text, *_tail(text, out[-1])):
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _tail(text: str, span: tuple[int, int]) -> tuple[int, int]:
    """The last word of a span of words."""
    return max(span[0], text.rfind(" ", *span) + 1), span[1]


def units(text: str, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int, bool]]:
    """(start, end, kinds as bits, known) of seeds and candidates that do not overlap, by start."""
    out, end = [], 0
    for s, k, e in found:
        if s >= end:
            out.append((s, e, 1 << k, True))
            end = e
    rough, at = [], 0
    for a, b in _rough(text) if _ROUGH.search(text) else ():
        while at < len(out) and out[at][1] <= a:
            at += 1
        if at == len(out) or out[at][0] >= b:
            mask = shapes(text[a:b])
            if mask:
                rough.append((a, b, mask, False))
    return sorted(out + rough)


def word(raw: str) -> str:
    """A context word: lower case, without punctuation at its ends unless it is nothing else."""
    return raw.lower().strip(_EDGES + "()") or raw


def sequence(text: str, marks: list[tuple[int, int, int, bool]]) -> tuple[list[str], list[int]]:
    """The raw words of a text with its units as one mark each, and the places of the marks."""
    seq, places, end = [START] * 3, [], 0
    for s, e, _, _ in marks:
        seq += text[end:s].split()
        places.append(len(seq))
        seq.append(UNIT)
        end = e
    seq += text[end:].split()
    seq.append(START)
    return seq, places


class Hashes(dict):
    """64-bit hashes of context words; a bounded memory."""

    def __missing__(self, raw: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[raw] = h = xxhash.xxh64_intdigest(raw if raw in (START, UNIT) else word(raw))
        return h


#: Context patterns: one, two and three words before, and one word on either side.
_BEFORE = ((1,), (2, 1), (3, 2, 1), (1, -1))


def _mixed(h: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Hashes of the patterns around places of a sequence, one row for each form."""
    rows = []
    for n, offsets in enumerate(_BEFORE):
        x = np.full(len(places), n + 1, np.uint64)
        for o in offsets:
            x = (x ^ h[places - o]) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
        rows.append(x)
    return np.stack(rows).view(np.int64)


_UNIT_TYPE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kinds", pa.int32()), ("known", pa.bool_()),
                        ("instance", pa.int64()), ("patterns", pa.list_(pa.int64()))])
_UNITS = "array<struct<start:long,end:long,kinds:int,known:boolean,instance:long,patterns:array<long>>>"
_SPAN_TYPE = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_SPANS = "array<struct<start:long,kind:int,end:long>>"


def _scan(batches, key):
    memo = held(key, Hashes)
    for t in sliced(batches):
        base, marked = [], []
        for text in t.column(2).to_pylist():
            found = seeds(text) if text else []
            base.append([{"start": s, "kind": k, "end": e} for s, k, e in found])
            marks = units(text, found) if text else []
            if not marks:
                marked.append([])
                continue
            seq, places = sequence(text, marks)
            h = np.fromiter(map(memo.__getitem__, seq), np.uint64, len(seq))
            around = _mixed(h, np.array(places)).T.tolist()
            marked.append([{"start": s, "end": e, "kinds": k, "known": known, "patterns": p,
                            "instance": int(np.uint64(xxhash.xxh64_intdigest(text[s:e].lower().replace(" ", ""))).view(np.int64))}
                           for (s, e, k, known), p in zip(marks, around)])
        yield pa.RecordBatch.from_arrays([t.column(0), t.column(1), pa.array(base, pa.list_(_SPAN_TYPE)), pa.array(marked, pa.list_(_UNIT_TYPE))],
                                         ["row", "id", "base", "units"])


def scan(docs: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``row, id, base, units`` of every text: its seeds, and seeds and candidates with their context patterns."""
    d = docs.select(F.monotonically_increasing_id().alias("row"), col(doc).alias("id"), col(text).cast("string").alias("text"))
    kind = d.schema["id"].dataType.simpleString()
    return saved(d.mapInArrow(partial(_scan, key=uuid.uuid4().hex), f"row long, id {kind}, base {_SPANS}, units {_UNITS}"), "pii-units")


BITS = 24


def _others(batches, bitmap, key):
    """How often words that are no units stand in patterns whose bit is set: (pattern, n)."""
    bits = bitmap.value
    memo = held(key, Hashes)

    def counts(seqs, places):
        seq, at = np.concatenate(seqs), np.concatenate(places)
        got = _mixed(seq, at).ravel()
        place = got.view(np.uint64) >> np.uint64(64 - BITS)
        got = got[bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1) > 0]
        p, n = np.unique(got, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(n, pa.int64())], ["pattern", "n"])

    seqs, at, size = [], [], 0
    for t in sliced(batches):
        for text in t.column(0).to_pylist():
            marks = units(text, seeds(text))
            seq, places = sequence(text, marks)
            plain = np.ones(len(seq), bool)
            plain[:3] = plain[-1] = False
            plain[places] = False
            seqs.append(np.fromiter(map(memo.__getitem__, seq), np.uint64, len(seq)))
            at.append(np.flatnonzero(plain) + size)
            size += len(seq)
            if size > 1 << 20:
                yield counts(seqs, at)
                seqs, at, size = [], [], 0
    if seqs:
        yield counts(seqs, at)


def _bitmap(patterns: DataFrame) -> np.ndarray:
    """Bits of the patterns' leading ``BITS`` bits; at most 2**18 words of 64 bits reach the driver, whatever their number."""
    place = patterns.select(F.shiftrightunsigned("pattern", 64 - BITS).alias("place"))
    words = place.groupBy(F.expr("place div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(place % 64 AS int)))").alias("bits")).toPandas()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def graph(scanned: DataFrame, docs: DataFrame, support: int = 3, *, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``edges(pattern, kind, instance, known, n)`` and ``totals(pattern, total)``.

    Only patterns with ``support`` instances that could be of one kind are
    kept. ``total`` counts everything that stands in a pattern: units and,
    by a second pass over all texts, other words.
    """
    u = scanned.select(F.explode("units").alias("u")).select("u.*")
    flat = u.select(F.explode("patterns").alias("pattern"), "kinds", "instance", "known")
    flat = flat.groupBy("pattern", "kinds", "instance", "known").agg(F.count("*").alias("n"))
    kinds = F.expr(f"filter(sequence(0, {len(KINDS) - 1}), k -> kinds & shiftleft(1, k) > 0)")
    edges = saved(flat.select("pattern", F.explode(kinds).alias("kind"), "instance", "known", "n"), "pii-edges")
    enough = edges.groupBy("pattern", "kind").agg(F.count("*").alias("c")).where(F.col("c") >= support).select("pattern").distinct()
    enough = saved(enough, "pii-patterns")
    edges = saved(edges.join(enough, "pattern"), "pii-edges")
    bc = docs.sparkSession.sparkContext.broadcast(_bitmap(enough))
    plain = docs.select(col(text).cast("string").alias("text")).where("text != ''")
    others = plain.mapInArrow(partial(_others, bitmap=bc, key=uuid.uuid4().hex), "pattern long, n long")
    # a unit counts once in a pattern, however many kinds it could be
    within = flat.select("pattern", "n").unionByName(others).groupBy("pattern").agg(F.sum("n").alias("total"))
    return edges, saved(within.join(enough, "pattern"), "pii-totals")


def bootstrap(edges: DataFrame, totals: DataFrame, support: int = 3, precision: float = 0.8, accept: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Rounds over the graph → ``patterns(pattern, kind, precision, support)`` and ``found(kind, instance, confidence)``.

    A pattern is kept for a kind if at least ``support`` known instances
    stand in it and they make up ``precision`` of all that does; an instance
    is found if the chance that all its kept patterns err is below 1 -
    ``accept``. Known instances only grow, so the rounds end.
    """
    spark = edges.sparkSession
    edges = edges.join(totals, "pattern")
    edges = saved(edges, "pii-graph")
    sure = edges.where("known").select("kind", "instance").distinct().withColumn("confidence", F.lit(1.0))
    found, n = spark.createDataFrame([], "kind int, instance long, confidence double"), 0
    while True:
        known = sure.unionByName(found)
        hits = edges.join(known, ["kind", "instance"])
        patterns = hits.groupBy("pattern", "kind").agg(
            F.count("*").alias("support"), (F.sum(F.col("n") * F.col("confidence")) / F.max("total")).alias("precision"))
        patterns = saved(patterns.where((F.col("support") >= support) & (F.col("precision") >= precision)), "pii-kept")
        miss = F.log(F.greatest(F.lit(1e-3), 1 - F.col("precision")))
        new = edges.where("not known").join(patterns, ["pattern", "kind"]).groupBy("kind", "instance")
        new = new.agg((1 - F.exp(F.sum(miss))).alias("confidence")).where(F.col("confidence") >= accept)
        found = saved(new, "pii-found")
        if (m := found.count()) <= n:
            return patterns, found
        n = m


def personal_data(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", support: int = 3, precision: float = 0.8, accept: float = 0.8) -> DataFrame:
    """Personal data of every text.

    Returns ``id``; ``n_email, n_ip, n_card, n_phone``: numbers of spans of
    the fixed forms; ``base``: those spans; ``found``: the spans that their
    contexts gave away, each as the likeliest kind; ``all``: both,
    by start, then kind. Spans are code points, the end exclusive.

    Null and empty texts have none. Very long texts are read whole, in time
    linear in their length. Null and repeated ids keep their rows; a copied
    document adds to counts but not to the number of instances that a
    pattern needs; an empty table gives no rows; other columns are ignored.
    """
    scanned = scan(docs, doc=doc, text=text)
    _, found = bootstrap(*graph(scanned, docs, support, text=text), support, precision, accept)
    u = scanned.select("row", F.explode("units").alias("u")).where("not u.known").select("row", "u.*")
    u = u.join(found, "instance").where(F.expr("kinds & shiftleft(1, kind) > 0"))
    u = u.groupBy("row", "start", "end").agg(F.max_by("kind", F.struct("confidence", -F.col("kind"))).alias("kind"))
    spans = u.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("found"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {k})) AS long)").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    out = scanned.select("row", "id", "base").join(spans, "row", "left")
    out = out.withColumn("found", F.coalesce("found", F.array().cast(_SPANS)))
    return out.select("id", *counts, "base", "found", F.sort_array(F.concat("base", "found")).alias("all"))


def _listed(spans):
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op11_personal(spark, sf_dir):
    """Personal data of all documents."""
    out = personal_data(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), *[f"n_{k}" for k in KINDS], F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("all").alias("spans"),
                      F.size("found").cast("long").alias("n_found"))
