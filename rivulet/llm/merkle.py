"""Merkle manifest of a dataset as a persistent tree of hashes.

Leaves of one source form a tree, in the order of their ids; every 16
consecutive nodes become their parent. The roots of all sources, in the
order of their names, form a tree of the same kind. The tree is never held
in one place: 256 neighbouring leaves (two levels) are an aligned block, the
roots of blocks are dealt into blocks again, and so on until one node is
left. A changed leaf makes a version of the tree that copies only the
ancestors of the leaf and shares all other nodes: the copies are made in the
leaf's own block and carried on through the sibling runs above it, which
each block gets once from the block above. So no block above ever receives
the versions below it, however many there are.
"""

from __future__ import annotations

import hashlib
import string
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import col, saved, sliced, table

FAN = 16
LEVELS = 2
BLOCK = FAN**LEVELS
HEX = 64

_PATH = "array<struct<before:string,after:string>>"


def digest(data: bytes) -> bytes:
    """SHA-256 as 64 lowercase hex digits."""
    return hashlib.sha256(data).hexdigest().encode()


def leaf(values: list[Column]) -> Column:
    """Digest of fields: each its UTF-8 byte count, a colon and its text, or ``-`` if null."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
                             for t in text]), 256)


class Block:
    """The shared nodes of one aligned block, level by level from its leaves up.

    ``alone`` tells that the block is its whole tree: it ends at one node
    instead of after a fixed number of levels.
    """

    def __init__(self, leaves: list[bytes], alone: bool):
        self.levels = [b"".join(leaves)]
        while len(self.levels[-1]) > HEX if alone else len(self.levels) <= LEVELS:
            low = self.levels[-1]
            self.levels.append(b"".join(digest(low[i:i + FAN * HEX]) for i in range(0, len(low), FAN * HEX)))

    def root(self) -> bytes:
        return self.levels[-1]

    def siblings(self, i: int) -> list[tuple[bytes, bytes]]:
        """The nodes before and after the one above leaf ``i`` in its run, for each level below the root."""
        out = []
        for low in self.levels[:-1]:
            run = i // FAN * FAN
            out.append((low[run * HEX:i * HEX], low[(i + 1) * HEX:(run + FAN) * HEX]))
            i //= FAN
        return out


def copies(changed: bytes, path: list[tuple[bytes, bytes]]) -> list[bytes]:
    """The nodes that a version with this leaf copies, up to its root; all others are shared."""
    out = [changed]
    for before, after in path:
        out.append(digest(before + out[-1] + after))
    return out


def _numbered(batches):
    """Rows sorted by tree → the same with their number within the tree in this partition."""
    part, tree, n = TaskContext.get().partitionId(), None, 0
    for t in batches:
        no = []
        for x in t.column("tree").to_pylist():
            n, tree = (n + 1, tree) if x == tree else (0, x)
            no.append(n)
        yield pa.RecordBatch.from_arrays([pa.array([part] * len(no), pa.int32()), pa.array(no, pa.int64()), *t.columns],
                                         ["part", "no", *t.schema.names])


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows(tree, ...)`` with ``idx``: their place in their tree, from 0.

    One sort by ranges; a tree that spans several ranges is continued with an
    offset. Only the first tree of a range can have one, so there are at most
    as many offsets as ranges.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = saved(ranged.mapInArrow(_numbered, "part int, no long, " + kinds), "merkle-placed")
    size = placed.groupBy("tree", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = saved(size.select("tree", "part", before.alias("offset")).where("offset > 0"), "merkle-offsets")
    out = placed.join(F.broadcast(offsets), ["tree", "part"], "left")
    return out.withColumn("idx", F.col("no") + F.coalesce("offset", F.lit(0))).drop("no", "part", "offset")


def _blocks(nodes: DataFrame) -> DataFrame:
    """``nodes(tree, idx, digest, ...)`` → one row for each aligned block, its nodes in order."""
    held = [c for c in nodes.columns if c not in ("tree", "idx")]
    at = F.floor(F.col("idx") / BLOCK).cast("long").alias("block")
    return (nodes.groupBy("tree", at)
            .agg(F.sort_array(F.collect_list(F.struct("idx", *held))).alias("nodes")))


def _read(t):
    """Blocks of a batch: (tree, block number, row slice of the flat nodes, Block)."""
    nodes, offsets = t.column("nodes"), t.column("nodes").offsets.to_pylist()
    flat = nodes.values
    hashes = [h.hex().encode() for h in flat.field("digest").to_pylist()]
    for k, (tree, block) in enumerate(zip(t.column("tree").to_pylist(), t.column("block").to_pylist())):
        s, e = offsets[k], offsets[k + 1]
        yield k, tree, block, flat, s, e, Block(hashes[s:e], alone=block == 0 and e - s < BLOCK)


def _roots(batches):
    for t in sliced(batches, 64):
        got = [(tree, block, bytes.fromhex(b.root().decode())) for _, tree, block, _, _, _, b in _read(t)]
        cols = list(zip(*got)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                                          pa.array(cols[2], pa.binary())], ["tree", "idx", "digest"])


def climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """``nodes(tree, idx, digest, ...)`` → the blocks of each height, and one top node for each tree."""
    blocks = []
    while True:
        blocks.append(saved(_blocks(nodes), "merkle-blocks"))
        nodes = saved(blocks[-1].mapInArrow(_roots, "tree string, idx long, digest binary"), "merkle-nodes")
        if nodes.where("idx > 0").limit(1).count() == 0:
            return blocks, nodes


def _pairs(path) -> list[tuple[bytes, bytes]]:
    return [(p["before"].encode(), p["after"].encode()) for p in path]


def _down(batches):
    """Blocks with the path above them → the path above each of their nodes."""
    for t in sliced(batches, 64):
        above, own = t.column("path").to_pylist(), t.column("own").to_pylist()
        trees, idx, paths, owns = [], [], [], []
        for k, tree, _, flat, s, e, b in _read(t):
            trees += [tree] * (e - s)
            idx += flat.field("idx").slice(s, e - s).to_pylist()
            for i in range(e - s):
                paths.append([{"before": x.decode(), "after": y.decode()} for x, y in b.siblings(i)] + above[k])
            owns += [own[k] + len(b.levels) - 1] * (e - s)
        yield pa.RecordBatch.from_arrays(
            [pa.array(trees, pa.string()), pa.array(idx, pa.int64()),
             pa.array(paths, pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))), pa.array(owns, pa.int32())],
            ["tree", "idx", "path", "own"])


def _under(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Blocks beside the path above their root; each block has one. Both sides grow with the data, so none is broadcast."""
    return blocks.hint("merge").join(paths.withColumnRenamed("idx", "block"), ["tree", "block"])


def descend(blocks: list[DataFrame], paths: DataFrame) -> DataFrame:
    """``paths`` above the top nodes → paths above the roots of the lowest blocks.

    ``path`` holds the sibling runs up to the manifest's root, ``own`` how
    many of them lie in the node's own tree.
    """
    for b in reversed(blocks[1:]):
        paths = saved(_under(b, paths).mapInArrow(_down, f"tree string, idx long, path {_PATH}, own int"), "merkle-paths")
    return paths


def _leaves(batches, kind):
    """Lowest blocks → one row for each leaf: its proof, and its version if it is changed."""
    for t in sliced(batches, 64):
        above, own = t.column("path").to_pylist(), t.column("own").to_pylist()
        out = {c: [] for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root", "copied")}
        ids = []
        for k, _, _, flat, s, e, b in _read(t):
            up = _pairs(above[k])
            tops = copies(b.root(), up)
            shared = b"".join(x + y for x, y in up)
            low, changed = b.levels[0], flat.field("changed").slice(s, e - s).to_pylist()
            ids.append(flat.field("id").slice(s, e - s))
            out["subroot"] += [tops[own[k]].decode()] * (e - s)
            out["root"] += [tops[-1].decode()] * (e - s)
            for i, new in enumerate(changed):
                sib = b.siblings(i)
                old = low[i * HEX:(i + 1) * HEX]
                version = copies(old if new is None else new.hex().encode(), sib + up)
                out["leaf"].append(old.decode())
                out["proof_sha256"].append(hashlib.sha256(b"".join([x + y for x, y in sib]) + shared).hexdigest())
                out["folded_root"].append(version[-1].decode())
                out["copied"].append(None if new is None else [x.decode() for x in version])
        kinds = {"copied": pa.list_(pa.string())}
        id_ = pa.concat_arrays(ids) if ids else pa.array([], kind)
        yield pa.RecordBatch.from_arrays([id_, *[pa.array(v, kinds.get(c, pa.string())) for c, v in out.items()]], ["id", *out])


def manifest(leaves: DataFrame) -> DataFrame:
    """``leaves(id, source, digest, changed)`` → the proof of every leaf, and the version each changed leaf makes.

    ``digest`` is the leaf's binary SHA-256, ``changed`` that of the changed
    leaf, or null. Returns ``id, leaf, subroot, root, proof_sha256,
    folded_root, copied``: the leaf, its source's root and the manifest's
    root; the digest of all sibling nodes up to the root; the root folded
    from the changed (else the same) leaf; and the nodes that its version
    copies, from the leaf up (null if not changed).

    A null source is a source of its own, before all others; null ids stand
    first in their source; equal ids stand in the order of their digests, so
    equal rows are interchangeable. Very long texts cost no more than their
    hash. A lone leaf is its source's root, a lone source the manifest's. An
    empty table gives no rows.
    """
    kind = leaves.schema["id"].dataType.simpleString()
    tree = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), F.col("source").cast("string")))
    rows = leaves.select(tree.alias("tree"), "id", "digest", "changed")
    blocks, tops = climb(numbered(rows, ["id", "digest", "changed"]))
    names = saved(numbered(tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"]), "merkle-sources")
    high, top = climb(names.drop("name"))
    paths = top.select("tree", "idx", F.array().cast(_PATH).alias("path"), F.lit(0).alias("own"))
    paths = _under(high[0], descend(high, paths)).mapInArrow(_down, f"tree string, idx long, path {_PATH}, own int")
    paths = names.select("name", "idx").hint("merge").join(paths.select("idx", "path"), "idx")
    paths = saved(paths.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("idx"), "path", F.lit(0).alias("own")), "merkle-paths")
    low = _under(blocks[0], descend(blocks, paths))
    arrow = low.limit(0).select("nodes").toArrow().schema.field("nodes").type.value_type.field("id").type
    return low.mapInArrow(partial(_leaves, kind=arrow), f"id {kind}, leaf string, subroot string, root string, "
                          "proof_sha256 string, folded_root string, copied array<string>")


def document_leaves(docs: DataFrame, *, doc: str = "doc_id", source: str = "source", lang: str = "lang", n_chars: str = "n_chars",
                    text: str = "text", changed: Column | None = None, change=None) -> DataFrame:
    """Documents → ``id, source, digest, changed`` for :func:`manifest`; ``change`` edits the text of rows where ``changed`` holds."""
    head = [col(c) for c in (doc, source, lang, n_chars)]
    other = F.when(changed, F.unhex(leaf([*head, change(col(text))]))) if changed is not None else F.lit(None).cast("binary")
    return docs.select(col(doc).alias("id"), col(source).alias("source"), F.unhex(leaf([*head, col(text)])).alias("digest"), other.alias("changed"))


def op13_manifest(spark, sf_dir):
    """Manifest of all documents; every fifth leaf or so is tampered with by lower-casing its text."""
    docs = table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lower = lambda t: F.translate(t, string.ascii_uppercase, string.ascii_lowercase)
    out = manifest(saved(document_leaves(docs, changed=hit, change=lower), "merkle-leaves"))
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql(depth: int = 6) -> str:
    """The same in DuckDB for up to 16**depth leaves a source and as many sources, one level after the other.

    ``level_k`` holds each tree's nodes, or its one node once it has no more;
    a leaf's path is followed by its place, which is divided by 16 per level.
    """
    def hashed(text):
        parts = ", ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars"))
        return f"sha256(concat({parts}, coalesce(strlen({text})::VARCHAR || ':' || {text}, '-')))"

    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    # crc32 of the decimal id, bit by bit over its bytes
    bits = "flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: list_transform(range(8), lambda i: (ascii(c) >> i) & 1)))"
    crc = f"xor(list_reduce(list_prepend(4294967295, {bits}), lambda c, b: xor(c >> 1, 3988292384 * xor(c & 1, b))), 4294967295)"
    ctes = [f"""d AS (SELECT *, {hashed('text')} AS leaf,
        CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN {hashed(f"translate(text, '{upper}', '{lower}')")} END AS changed FROM documents)""",
            """a0 AS (SELECT coalesce('+' || source, '') AS tree, doc_id, leaf, changed, leaf AS h, coalesce(changed, leaf) AS v, '' AS sib,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS idx FROM d)""",
            "n0 AS (SELECT tree, idx, h FROM a0)"]

    def level(a, n, k):
        """From level k to k + 1: nodes ``n``, and leaves ``a`` with what they have gathered."""
        run = f"(SELECT tree, idx // {FAN} AS run, string_agg(h, '' ORDER BY idx) AS hs, count(*) AS c, max(count(*)) OVER (PARTITION BY tree) AS widest, count(*) OVER (PARTITION BY tree) AS runs FROM {n}{k} GROUP BY 1, 2)"
        ctes.append(f"r{n}{k} AS (SELECT *, (widest = 1 AND runs = 1) AS ready FROM {run})")
        ctes.append(f"{n}{k + 1} AS (SELECT tree, run AS idx, CASE WHEN ready THEN hs ELSE sha256(hs) END AS h FROM r{n}{k})")
        place = f"(a.idx % {FAN})::BIGINT * 64"
        before, after = f"substr(hs, 1, {place})", f"substr(hs, {place} + 65)"
        ctes.append(f"""{a}{k + 1} AS (SELECT a.* REPLACE (run AS idx, CASE WHEN ready THEN sib ELSE sib || {before} || {after} END AS sib,
        CASE WHEN ready THEN v ELSE sha256({before} || v || {after}) END AS v) FROM {a}{k} a JOIN r{n}{k} r ON a.tree = r.tree AND a.idx // {FAN} = r.run)""")

    for k in range(depth):
        level("a", "n", k)
    ctes.append(f"m0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS idx, h, tree AS name FROM n{depth})")
    ctes.append(f"b0 AS (SELECT a.* REPLACE ('' AS tree, m.idx AS idx), m.h AS subroot FROM a{depth} a JOIN m0 m ON a.tree = m.name)")
    for k in range(depth):
        level("b", "m", k)
    return (f"WITH {', '.join(ctes)} SELECT doc_id, leaf, subroot, m.h AS root, sha256(sib) AS proof_sha256, v AS folded_root, v = m.h AS verified "
            f"FROM b{depth}, m{depth} m")


OP13_SQL = _sql()
