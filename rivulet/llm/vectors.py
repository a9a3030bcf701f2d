"""Embedding near-duplicates by sorted projection passes.

Each pass hashes a vector to the signs of its own random projections and
sorts the vectors lexicographically by them; near vectors share long
beginnings, so each is compared with a bounded window of neighbours. A dense
group can be wider than any window, so the passes only unite neighbours into
clusters, at the cosine that two vectors near a third have at least; so the
copies around a hub are one cluster even where they are not near each other.
Within clusters links are found exactly: in blocks of bounded size, one block
pair to a task's step, and only counts and spanning edges leave a block.
Their edges are united into components. Equal vectors are one row with a multiplicity
throughout.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from rivulet.llm.common import col, components, saved, table


def _matrix(column, dims: int) -> np.ndarray:
    x = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), dims).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(1, keepdims=True)
    x = x / big
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _signatures(batches, seeds, bits):
    """(id, label, v) → one row per pass: (pass, label, dims, signature as hex text, id, v)."""
    planes = {}
    for t in batches:
        ids, labels, vs = t.column(0), t.column(1), t.column(2)
        dims = np.array(vs.value_lengths())
        for d in np.unique(dims):
            pick = pa.array(np.flatnonzero(dims == d))
            v = vs.take(pick)
            x = _unit(_matrix(v, d))
            for k, seed in enumerate(seeds):
                if (d, k) not in planes:
                    planes[d, k] = np.random.default_rng([seed, int(d)]).standard_normal((d, bits))
                sign = np.packbits(x @ planes[d, k] > 0, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), k, np.int32)), labels.take(pick), pa.array(np.full(len(x), d, np.int32)),
                     pa.array([s.tobytes().hex() for s in sign]), ids.take(pick), v],
                    ["pass", "label", "dims", "sig", "id", "v"])


def _neighbours(batches, window, loose):
    """Rows sorted by (pass, label, dims, sig) → edges that unite the pairs within the window of cosine ``loose`` or more.

    Runs of rows each near the next are united by their own edges; of the pairs between two runs, one edge is enough.
    """
    tail = None
    for t in batches:
        if not t.num_rows:
            continue
        now = pa.Table.from_batches([t])
        now = pa.concat_tables([tail, now]) if tail is not None else now
        fresh = tail.num_rows if tail is not None else 0
        tail = now.slice(max(0, now.num_rows - window))
        codes = [now["pass"].to_numpy(), now["label"].combine_chunks().dictionary_encode().indices.to_numpy(), now["dims"].to_numpy()]
        ids, out = now["id"].to_numpy(), []
        same = np.all([c[1:] == c[:-1] for c in codes], axis=0)
        edges = np.r_[0, np.flatnonzero(~same) + 1, len(ids)]
        for s, e in zip(edges, edges[1:]):
            if e <= fresh or e - s < 2:
                continue
            x = _unit(_matrix(now["v"].slice(s, e - s), int(codes[2][s])))
            near = np.einsum("ij,ij->i", x[:-1], x[1:]) >= loose
            run = np.r_[0, np.cumsum(~near)]
            hit = s + np.flatnonzero(near)
            out.append(np.stack([ids[hit], ids[hit + 1]]))
            for d in range(2, min(window, e - s - 1) + 1):
                lo = max(0, fresh - s - d)  # pairs of two old rows were compared before
                hit = np.flatnonzero((np.einsum("ij,ij->i", x[lo:-d], x[lo + d:]) >= loose) & (run[lo:-d] != run[lo + d:])) + lo
                hit = hit[np.unique(np.stack([run[hit], run[hit + d]]), axis=1, return_index=True)[1]] if len(hit) else hit
                out.append(np.stack([ids[s + hit], ids[s + hit + d]]))
        if out:
            a, b = np.concatenate(out, 1)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _within(key, t, least):
    """One block (or pair of blocks) of a cluster: links of each row, weighted by multiplicity, and the least id they lead to."""
    x = _unit(_matrix(t["v"], len(t["v"][0])))
    side, n, ids = t["side"].to_numpy(), t["n"].to_numpy(), t["id"].to_numpy()
    order = np.argsort(ids)
    x, side, n, ids = x[order], side[order], n[order], ids[order]
    near = x @ x.T >= least
    if side[0] < 0:
        np.fill_diagonal(near, False)
    else:
        near &= side[:, None] != side
    low, was = np.arange(len(ids)), None
    while was is None or (low != was).any():
        was = low
        low = np.minimum(low, np.where(near, low, len(ids)).min(1))
        low = low[low]
    return pa.table({"id": ids, "links": near.astype(np.int64) @ n, "low": ids[low]})


def usable(vectors: DataFrame, vec: str, embedding: str, label: str) -> DataFrame:
    """``id, label, v`` of vectors that can link: labelled, not null, not zero, all components finite."""
    kind = vectors.schema[embedding].dataType
    kind = "float" if isinstance(getattr(kind, "elementType", None), FloatType) else "double"
    v = vectors.select(col(vec).alias("id"), col(label).cast("string").alias("label"),
                       col(embedding).cast(f"array<{kind}>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def near_vectors(vectors: DataFrame, *, vec: str = "vec_id", embedding: str = "embedding", label: str = "label",
                 least: float = 0.98, passes: int = 16, bits: int = 64, window: int = 32, block: int = 256,
                 seed: int = 5) -> DataFrame:
    """One row per vector row: ``vec_id, n_links, component_id, kept``.

    Vectors of equal, non-null label and equal length link at a cosine of ``least`` or more, in double
    precision. Vectors that are null, empty, zero, without label, or that hold a null or non-finite
    component link with nothing; a row without id has no links and component null. Equal vectors link.
    A repeated id is one row here for each time it comes, linked like separate vectors. Every link
    returned is verified, and all links within a cluster are found; links between two clusters that no
    pass brought together are missed (recall is measured in the tests). Other columns are ignored; an empty table gives no rows.
    """
    v = usable(vectors, vec, embedding, label)
    same = saved(v.withColumn("h", F.xxhash64("v")).groupBy("label", "h", "v")
                 .agg(F.min("id").alias("id"), F.count("*").alias("n")).drop("h"), "vector-classes")
    member = v.join(same.select(F.col("label"), F.col("v"), F.col("id").alias("rep")), ["label", "v"]).select("id", "rep")
    seeds = [seed * 1000 + k for k in range(passes)]
    sig = same.select("id", "label", "v").mapInArrow(
        partial(_signatures, seeds=seeds, bits=bits), "pass int, label string, dims int, sig string, id long, v " + same.schema["v"].dataType.simpleString())
    order = ["pass", "label", "dims", "sig"]
    found = (sig.repartitionByRange(*order, "id").sortWithinPartitions(*order, "id")
             .mapInArrow(partial(_neighbours, window=window, loose=2 * least * least - 1), "a long, b long"))
    rows = saved(same.join(components(found), "id"), "vector-clusters")
    size = saved(rows.groupBy("component").agg(F.count("*").alias("m")), "cluster-sizes")
    blocks = F.ceil(F.col("m") / block).cast("int")
    rows = rows.join(size, "component").withColumn("b", blocks).withColumn("own", F.pmod(F.xxhash64("id"), F.col("b")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("b") - 1), lambda o: F.struct(
        F.least(o, F.col("own")).alias("x"), F.greatest(o, F.col("own")).alias("y"),
        F.when(o == F.col("own"), -1).when(o < F.col("own"), 1).otherwise(0).alias("side")))
    dealt = rows.withColumn("p", F.explode(pair)).select("component", "p.x", "p.y", "p.side", "id", "n", "v")
    linked = saved(dealt.groupBy("component", "x", "y").applyInArrow(partial(_within, least=least), "id long, links long, low long"),
                   "vector-blocks")
    comp = components(linked.select("id", "low"))
    links = linked.groupBy("id").agg(F.sum("links").alias("links"))
    known = (same.select(F.col("id").alias("rep"), F.col("n"))
             .join(comp.select(F.col("id").alias("rep"), "component"), "rep", "left")
             .join(links.select(F.col("id").alias("rep"), "links"), "rep", "left"))
    known = saved(known.select("rep", F.coalesce("component", "rep").alias("component"),
                               (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links")), "vector-links")
    linked = member.join(known, "rep").groupBy("id").agg(F.max("links").alias("links"), F.min("component").alias("component"))
    out = vectors.select(col(vec).alias("vec_id")).join(linked, F.col("vec_id") == F.col("id"), "left")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component", "vec_id").alias("component_id"),
                      F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"))


def op5_vectors(spark, sf_dir):
    """Near-duplicate vectors of all embeddings."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP5_SQL = """
WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
ok AS (SELECT *, sqrt(list_inner_product(v, v)) AS norm FROM e
       WHERE label IS NOT NULL AND v IS NOT NULL AND len(v) > 0
         AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND len(a.v) = len(b.v) WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.98),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS m FROM r GROUP BY a),
n AS (SELECT a, count(DISTINCT b) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM e LEFT JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""
