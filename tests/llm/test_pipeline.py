"""The pipeline, each stage judged on its own input against brute force."""

import zlib
from collections import Counter, defaultdict

import corpus_pipeline as P
from rivulet.llm import packing, toxicity
from rivulet.llm.common import saved
from test_pairs import closure, slow_fingerprint, slow_lines
from test_rows import brute_contamination

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    inputs, outputs = [], []
    for name, stage in P.STAGES:
        inputs.append(docs.collect())
        out = saved(stage(spark, docs, SF), "test-stage")
        outputs.append(out.collect())
        if name != "packing":
            assert out.columns == docs.columns
        docs = out
    assert [n for n, _ in P.STAGES] == ["toxicity", "line dedup", "simhash near-dedup", "benchmark decontamination", "packing"]

    model = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    g, w, b = model
    clean = [r for r in inputs[0] if w * g.strength(r.text) + b < -0.8473]  # a score of 0.3
    assert Counter(outputs[0]) == Counter(clean) and 0 < len(outputs[0]) < len(inputs[0])

    gone = {(i, n) for i, n, *_, removed in slow_lines([(r.doc_id, r.text) for r in inputs[1]]) if removed}
    want = {r.doc_id: "\n".join(x for n, x in enumerate(r.text.split("\n")) if (r.doc_id, n) not in gone) for r in inputs[1]}
    assert gone and {r.doc_id: r.text for r in outputs[1]} == want and len(outputs[1]) == len(inputs[1])

    fps = {r.doc_id: slow_fingerprint(r.text) for r in inputs[2]}
    near = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
    assert sorted(r.doc_id for r in outputs[2]) == sorted(i for i, c in closure(near, list(fps)).items() if i == c)

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    ok = [r for r in inputs[3] if not (lambda n, hit, *_: hit and 20 * hit >= n)(*brute_contamination(r.text, items))]
    assert Counter(outputs[3]) == Counter(ok)

    encode = packing.Encoder(packing.tokenizer_spec())
    pieces = Counter()
    for r in inputs[4]:
        ids = encode(r.text or "") + b"\x01\0\0\0"
        for s in range(0, len(ids), 8192):
            pieces[r.doc_id, s // 4, len(ids[s:s + 8192]) // 4, zlib.crc32(ids[s:s + 8192]), len(ids) // 4] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in outputs[4]) == pieces
    used = defaultdict(int)
    for r in sorted(outputs[4], key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used[r.sequence_id]
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048 and sum(used.values()) / (2048 * len(used)) > 0.9


def test_stages_on_odd_rows(spark, odd_docs):
    docs = odd_docs
    for name, stage in P.STAGES[:-1]:
        out = saved(stage(spark, docs, SF), "test-odd")
        assert out.columns == docs.columns
        docs = out
    assert P.STAGES[-1][1](spark, docs, SF).count() >= docs.count() > 0
    none = odd_docs.limit(0)
    for name, stage in P.STAGES:
        assert stage(spark, none, SF).count() == 0
