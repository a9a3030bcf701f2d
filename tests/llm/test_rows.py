"""Operators that judge one text at a time: decontamination, language, toxicity, packing, licences."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rivulet.llm import decontaminate, langid, licences, packing, toxicity

SF = "/root/testdata/sf0.001"

BENCH = "item_id long, text string"


def brute_contamination(text, items, window=13):
    find = lambda s: re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), s or ""))
    words, hit, seen = find(text), set(), set()
    for item, t in items:
        w = find(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            for j in range(len(words) - n + 1):
                if words[j:j + n] == w[i:i + n]:
                    hit.update(range(j, j + n))
                    seen.update([str(item)] if item is not None else [])
    return len(words), len(hit), len(seen), hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest()


def test_contamination_against_brute_force(spark, odd_docs):
    items = [(1, "Two THREE, four"), (2, None), (3, ""), (10, "word5 word6 word7"), (None, "漢字"), (7, "wörds"), (7, "wörds"),
             (5, " ".join(f"word{i}" for i in range(100, 130)))]
    bench = spark.createDataFrame(items, BENCH)
    for block in (1 << 20, 40):  # one automaton, and several blocks
        got = decontaminate.contamination(odd_docs, bench, block_chars=block).collect()
        want = [(r.doc_id, *brute_contamination(r.text, items)) for r in odd_docs.collect()]
        key = lambda x: tuple(map(str, x))
        assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got), key=key) == sorted(want, key=key)
        assert all(r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words) for r in got)


def test_benchmark_windows_are_not_cut_by_the_driver(spark, monkeypatch):
    """The driver holds one block of windows at a time and cuts none."""
    items = [(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(6)]
    docs = spark.createDataFrame([(i, f"start {t} end") for i, t in items] + [(9, "clean")], "doc_id long, text string")
    monkeypatch.setattr(decontaminate, "_words", None)  # in this process only, not in the workers
    blocks = decontaminate.blocks_of(spark.createDataFrame(items, BENCH), "item_id", "text", 13, 200)
    assert next(iter(blocks))[0] is False
    got = decontaminate.contamination(docs, spark.createDataFrame(items, BENCH), block_chars=200).collect()
    assert {r.doc_id: (r.n_hit, r.n_items) for r in got} == {**{i: (30, 1) for i in range(6)}, 9: (0, 0)}


def test_contamination_spans_are_of_the_original(spark):
    docs = spark.createDataFrame([(1, "Ünë  Big,\nRED dog; Ünë big red")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "big red dog"), (2, "ünë big")], BENCH)
    r = decontaminate.contamination(docs, bench).first()
    assert [docs.first().text[s.start:s.end] for s in r.spans] == ["Big,\nRED dog"]
    bench = spark.createDataFrame([(1, "big red dog"), (2, "Ünë BIG")], BENCH)
    r = decontaminate.contamination(docs, bench).first()
    assert [docs.first().text[s.start:s.end] for s in r.spans] == ["Ünë  Big,\nRED dog; Ünë big"]


def test_contamination_empty_tables_and_drop(spark, odd_docs):
    none = spark.createDataFrame([], BENCH)
    assert not any(r.contaminated for r in decontaminate.contamination(odd_docs, none).collect())
    assert decontaminate.contamination(odd_docs.limit(0), none).count() == 0
    bench = spark.createDataFrame([(1, "one two three four five six")], BENCH)
    kept = decontaminate.drop_contaminated(odd_docs, bench)
    assert kept.columns == odd_docs.columns
    assert Counter(map(tuple, kept.collect())) == Counter(tuple(r) for r in odd_docs.collect() if (r.text or "")[:3] != "one")


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(packing.tokenizer_spec(), limit=50)


@pytest.mark.parametrize("text", [
    "Hello World's 12 dogs!!", "don't WE'LL we've I'd", "naïve Façade ÉCOLE élan", "école Å", "漢字 かな 한국어", "ΣΑΣ ὈΔΥΣΣΕΎΣ",
    "İstanbul ǅ ß ẞ", "a\x00b \x1c c\x85d", "<|endoftext|> x <|startoftext|>", "''s 's''t", "½ ² Ⅷ ٣ 3.14", "—–… “quoted” ‘it’s’",
    "tab\tnew\nline\r\x0bvt\x0cff", " nbsp em　wide", "x" * 3000, "", "   ", "😀😀 fine😀", "snake_case __init__ a_b",
    "ʼn ŉ ſ K Å", "zero​width soft­hyphen"])
def test_encoder_gives_the_tokenizers_ids(encoder, text):
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder(text) == b"".join(i.to_bytes(4, "little") for i in want)


def test_encoder_on_given_texts(encoder, documents):
    for r in documents.limit(60).collect():
        want = encoder.tokenizer.encode(r.text, add_special_tokens=False).ids
        assert encoder(r.text) == b"".join(i.to_bytes(4, "little") for i in want)


def test_encoder_makes_words_once():
    """A vocabulary of some 200 thousand words is encoded once; the memory stays bounded where there are more words."""
    t, calls = packing.Encoder(packing.tokenizer_spec()), []
    piece = t._piece
    t._piece = lambda x: calls.append(x) or piece(x)
    texts = [" ".join(f"{chr(97 + i)}{chr(97 + j)}{chr(97 + k)}{chr(97 + m)}" for k in range(26) for m in range(26)) for i in range(12) for j in range(26)]
    first = [t(x) for x in texts]
    assert len(calls) == 12 * 26**3
    assert [t(x) for x in texts] == first and len(calls) == 12 * 26**3
    few = packing._Memory(str.upper, 3)
    assert [few[x] for x in "abcabdeaf"] == list("ABCABDEAF") and len(few) <= 3 and len(few.before) <= 3


def test_best_fit_takes_the_tightest_window():
    where, offset = packing.best_fit([10, 9, 7, 6, 3, 1, 1], 10)
    assert (where, offset) == ([0, 1, 2, 3, 2, 1, 3], [0, 0, 0, 0, 7, 9, 6])

    def slow(lengths, window):
        left, out = [], []
        for n in lengths:
            fits = [(c, i) for i, c in enumerate(left) if c >= n]
            if fits:
                i = min(fits, key=lambda x: x[0])[1]
            else:
                left.append(window)
                i = len(left) - 1
            left[i] -= n
            out.append(window - left[i] - n)
        return sorted(left)
    import random
    r = random.Random(1)
    for _ in range(30):
        window = r.choice([8, 20, 64, 100])
        lengths = sorted((r.randint(1, window) for _ in range(200)), reverse=True)
        where, offset = packing.best_fit(lengths, window)
        used = Counter()
        for w, o, n in zip(where, offset, lengths):
            assert used[w] == o
            used[w] += n
        assert max(used.values()) <= window
        assert sorted(window - x for x in used.values()) == slow(lengths, window)


def test_packing_is_whole_and_gapless(spark, odd_docs):
    spec = packing.tokenizer_spec()
    got = packing.pack(odd_docs, spec, with_ids=True, group_pieces=20)
    t = packing.Encoder(spec)
    rows = got.collect()
    docs = Counter((r.doc_id, t(r.text or "") + b"\x01\0\0\0") for r in odd_docs.collect())
    total = Counter()
    for (i, ids), n in docs.items():
        for s in range(0, len(ids) // 4, 2048):
            part = ids[4 * s:4 * s + 4 * 2048]
            total[i, s, len(part) // 4, zlib.crc32(part), len(ids) // 4, part] += n
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, bytes(r.ids)) for r in rows) == total
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert at.get(r.sequence_id, 0) == r.offset
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= 2048
    for r in packing.sequences(got).collect():
        assert r.n_ids == at[r.sequence_id] == len(r.ids) // 4
        assert r.padded == (r.n_ids if r.n_ids & (r.n_ids - 1) == 0 else 2048)
    assert packing.pack(odd_docs.limit(0), spec).count() == 0


def test_language(spark, odd_docs):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    model = langid.train(docs)
    from rivulet.llm.common import held_out
    out = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(held_out(F.col("doc_id"))).collect()
    assert sum(r.lang_pred == r.lang for r in out) / len(out) > 0.97
    odd = langid.identify(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert {r.lang_pred for r in odd if r.doc_id in (1, 2, 3, 9)} == {"und"}
    assert all(r.lang_pred != "und" for r in odd if r.doc_id in (0, 5, 8))
    assert langid.identify(odd_docs.limit(0), model).count() == 0
    empty = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(odd_docs, empty).collect()} == {"und"}


def test_language_backs_off_to_shorter_grams():
    import numpy as np
    m = langid.Model(["a", "b"], {"the$": np.array([9, 1]), "<th": np.array([5, 0]), "th": np.array([5, 1]), "x": np.array([0, 7]), "t": np.array([9, 9])})
    s = langid.Scorer(m, limit=4)
    assert s("the")[0] == "a" and s("then")[0] == "a" and s("xxx")[0] == "b"
    for i in range(20):  # the memory of unseen words is bounded
        assert s(f"then xx{'y' * i} the") == langid.Scorer(m)(f"then xx{'y' * i} the")


def test_every_language_is_learned(spark):
    """A language with few rows is learned beside large ones, and takes none of theirs."""
    import random
    r = random.Random(2)
    make = lambda letters: " ".join("".join(r.choice(letters) for _ in range(r.randint(3, 7))) for _ in range(40))
    langs = ["aa"] * 1500 + ["bb"] * 1500 + ["cc"] * 8
    docs = spark.createDataFrame([(i, make({"aa": "abcdefg", "bb": "defghijk", "cc": "qrstuv"}[x]), x) for i, x in enumerate(langs)],
                                 "doc_id long, text string, lang string")
    model = langid.train(docs, rows=60)
    assert model.langs == ["aa", "bb", "cc"]
    got = {q.doc_id: q.lang_pred for q in langid.identify(docs, model).collect()}
    assert [got[i] for i in range(3000, 3008)] == ["cc"] * 8
    assert sum(got[i] == x for i, x in enumerate(langs)) >= 0.99 * len(langs)


def test_toxicity_grammar():
    g = toxicity.Grammar(dict.fromkeys(toxicity.INSULTS, 3.0), {"lowei": 2.0})
    s = g.strength
    assert s(None) == s("") == s("what a fine day") == 0
    assert s("you are an idiot") > s("the word idiot") > s("you are not an idiot") > 0
    assert s("she said you are an idiot") < s("you are an idiot")
    assert s("I will kill you") > s("I will not kill you") > 0 == s("I will kill time")
    assert s("Loweichen and loweia") == 4.0
    assert s("idiot. idiot") > s("idiot")


def test_toxicity_learns_and_scores(spark, odd_docs):
    base = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    model = toxicity.train(docs, labels)
    out = toxicity.toxicity(docs, model).join(labels, "doc_id").collect()
    hits = [r.toxic for r in out if r.predicted]
    assert sum(hits) / len(hits) > 0.9 and sum(hits) / sum(r.toxic for r in out) > 0.5
    odd = toxicity.toxicity(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 and not r.predicted for r in odd)
    kept = toxicity.drop_toxic(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    blank = toxicity.train(docs.limit(0), labels.limit(0))
    assert toxicity.toxicity(odd_docs.limit(0), blank).count() == 0


def test_toxicity_lexicon_does_not_depend_on_partitions(spark):
    """Features are counted over the whole sample, however its rows are dealt."""
    texts = [f"grobnik {'plain' if i < 10 else ''} toxa{i}" for i in range(20)] + [f"plain words w{i}" for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(len(texts))], "doc_id long, toxic int")
    sample = toxicity.labelled(docs, labels).collect()
    models = []
    for n in (1, 50):
        few = spark.createDataFrame(spark.sparkContext.parallelize(sample, n), "id long, text string, toxic int")
        counts = few.select("text", "toxic").mapInArrow(toxicity._count, "f string, toxic long, clean long")
        counts = counts.groupBy("f").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where("toxic > 1")
        models.append(({tuple(r) for r in counts.collect()}, toxicity.train(docs.repartition(n, "doc_id"), labels.repartition(n))))
    (few, (g, *curve)), (many, (h, *other)) = models
    assert few == many and (g.insults, g.starts) == (h.insults, h.starts) and curve == pytest.approx(other)
    assert g.insult("grobnik") > 0 and g.insult("plain") == 0


def test_licences(spark, odd_docs, documents):
    model = licences.train(spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet"))
    cases = {0: ("Licensed under the Apache License, Version 2.0.", "apache-2.0"), 1: ("Released under the MIT License.", "mit"),
             2: ("x\nLicensed under CC BY-NC 4.0. Thing of the thand.\ny", "cc-by-nc"),
             3: ("This work is licensed under the GNU General Public License, version 3.", "gpl-3.0"),
             4: ("Released under the Foo Bar License, edition nine.", ""), 5: ("He lost his driving licence.", ""), 6: (None, ""),
             7: ("", ""), 8: ("MIT is a university in Boston.", ""), 9: ("Released under the MIT License.\nLicensed under CC BY 4.0.", "cc-by,mit"),
             10: ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without limits.", "mit")}
    docs = spark.createDataFrame([(i, t, "x", "y") for i, (t, _) in cases.items()], "doc_id long, text string, label string, features string")
    got = licences.licences(docs, model).collect()
    assert len(got) == len(cases)
    got = {r.doc_id: r for r in got}
    assert {i: r.licences for i, r in got.items()} == {i: w for i, (_, w) in cases.items()}
    assert got[4].n_unknown == 1 and got[8].n_unknown == 0
    odd = licences.licences(odd_docs, model)
    assert odd.count() == odd_docs.count() and odd.where("licences != ''").count() == 0
    assert licences.licences(odd_docs.limit(0), model).count() == 0


def test_wrapped_licences(spark):
    """Notices over several lines, plain and in comments, are judged whole."""
    model = licences.train(spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet"))
    notices = {
        "gpl-3.0": ["This program is free software: you can redistribute it and/or modify", "it under the terms of the GNU General Public License as published by",
                    "the Free Software Foundation, either version 3 of the License, or", "(at your option) any later version."],
        "bsd": ["Redistribution and use in source and binary forms, with or without", "modification, are permitted provided that the following conditions",
                "are met:"],
        "isc": ["Permission to use, copy, modify, and/or distribute this software for any", "purpose with or without fee is hereby granted, provided that the above",
                "copyright notice and this permission notice appear in all copies."],
        "mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy", 'of this software and associated documentation files (the "Software"), to deal',
                "in the Software without restriction, including without limitation the rights", "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell",
                "copies of the Software, and to permit persons to whom the Software is", "furnished to do so, subject to the following conditions:"],
        "cc-by-sa": ["This work is licensed under a Creative Commons Attribution-", "ShareAlike 4.0 International License."]}
    want, rows = {}, []
    for f, lines in notices.items():
        for mark in ("", "# ", " * ", "// "):
            want[len(rows)] = f
            rows.append((len(rows), "\n".join(["Some words of a text", "", *(mark + x for x in lines), "", "More words of it"])))
    want[len(rows)] = "cc-by,mit"
    rows.append((len(rows), "Released under the MIT License\nLicensed under CC BY 4.0"))
    got = licences.licences(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert {r.doc_id: r.licences for r in got} == want
    assert all(r.n_paragraphs == 1 + (r.doc_id == len(rows) - 1) and r.n_unknown == 0 for r in got)


def test_languages_against_brute_force(spark, odd_docs):
    """Every prediction of the query, from the model's counts by the rules in plain Python."""
    import math

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs)

    def logs(word):
        if word in model.words:
            return model.words[word].tolist()
        for n in range(5, 0, -1):
            w = f"<{word}>"
            known = [model.grams[g] for g in (w[i:i + n] for i in range(len(w) - n + 1)) if g in model.grams]
            if known:
                return [sum(float(v[k]) for v in known) / len(known) for k in range(len(model.langs))]
        return [0.0] * len(model.langs)

    texts = [r.text for r in docs.select("text").collect()] + [r.text for r in odd_docs.collect()]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(frame, model).collect()}
    for i, text in enumerate(texts):
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not words:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        total = [math.fsum(x) for x in zip(*map(logs, words))]
        top = max(total)
        p = [math.exp(max(-700, t - top)) for t in total]
        assert got[i].score == pytest.approx(1 / sum(p), rel=1e-6)
        assert got[i].lang_pred == model.langs[total.index(top)] or sorted(p)[-2] > 1 - 1e-9


def test_toxicity_against_brute_force(spark, odd_docs):
    """Every score of the query, from the lexicon by the clause rules in plain Python; all clauses count."""
    import math

    base = SF
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    model = g, w, b = toxicity.train(docs, labels)

    def strength(text):
        found = []
        for clause in re.split(r"[.!?;:\n]+", (text or "").lower()):
            total, since = 0.0, dict.fromkeys("ntk", 99)
            reported = False
            for word in re.findall(r"[^\W\d_]+(?:'[^\W\d_]+)?", clause):
                insult = max([g.insults.get(word, 0.0)] + [x for s, x in g.starts.items() if word.startswith(s)])
                kind = "i" if insult else next((k for k, ws in (("t", toxicity.TARGETS), ("n", toxicity.NEGATIONS), ("r", toxicity.REPORTS),
                                                                ("k", toxicity.THREATS)) if word in ws), "")
                # a word is near for the three words after it
                scale = (0.4 if since["n"] <= 3 else 1.0) * (0.6 if reported else 1.0)
                if kind == "i":
                    total += insult * scale * (1.25 if since["t"] <= 3 else 1.0)
                elif kind == "t" and since["k"] <= 3:
                    total += 2.0 * scale
                    since["k"] = 99
                since = {k: 1 if k == kind else v + 1 for k, v in since.items()}
                if kind == "t":
                    since["k"] = 99
                reported |= kind == "r"
            if total:
                found.append(total)
        return sum(x / 2.0**i for i, x in enumerate(sorted(found, reverse=True)[:1000]))

    texts = [r.text for r in docs.select("text").collect()] + [r.text for r in odd_docs.collect()]
    texts += [". ".join(["you are an idiot"] * n) for n in (1, 9, 40, 3000)]
    texts += ["She said you are not an idiot", "I will never kill you", "I will kill a b c d you", "kill you you", "idiot not moron"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.toxicity(frame, model).collect()}
    for i, text in enumerate(texts):
        score = 1 / (1 + math.exp(-(w * strength(text) + b)))
        assert got[i].score == pytest.approx(score, rel=1e-9) and (abs(score - 0.3) < 1e-9 or got[i].predicted == (score >= 0.3))


def test_packing_by_any_tokenizer(spark):
    """A tokenizer that works otherwise is run as it is; so are added words of its own."""
    import json

    from tokenizers import Tokenizer

    spec = json.loads(packing.tokenizer_spec())
    assert packing.taken_apart(json.dumps(spec))
    texts = ["Hello World", "ÉCOLE Straße don't", "a  b\tc", "x1y2", ""]
    for change in ({"normalizer": None}, {"pre_tokenizer": None}, {"added_tokens": [{**spec["added_tokens"][0], "content": "World"}]},
                   {"model": {**spec["model"], "end_of_word_suffix": None}}):
        other = json.dumps({**spec, **change})
        assert not packing.taken_apart(other)
        t, encode = Tokenizer.from_str(other), packing.Encoder(other)
        for x in texts:
            assert encode(x) == b"".join(i.to_bytes(4, "little") for i in t.encode(x, add_special_tokens=False).ids)
    docs = spark.createDataFrame([(0, "Hello World")], "doc_id long, text string")
    plain, bare = (packing.pack(docs, json.dumps({**spec, **c})).first().ids_crc32 for c in ({}, {"normalizer": None}))
    assert plain != bare


def test_licence_gate_loses_nothing():
    """Any sentence that holds 0.6 of a template's word pairs has a gate word: checked on random and on worst choices of pairs."""
    import random

    r, gate = random.Random(2), re.compile(licences.GATE)
    chosen = set(licences.gate_words())
    for t in (t for ts in licences.TEMPLATES.values() for t in ts):
        pairs = licences.pairs_of(t)
        need = -(-6 * len(pairs) // 10)
        by_hits = sorted(pairs, key=lambda p: len(chosen & set(p.split())))
        for pick in [by_hits[:need], *(r.sample(pairs, need) for _ in range(5))]:
            assert gate.search(" ... ".join(pick)), t


def test_licences_against_brute_force(spark):
    """Parts of notices, short notices, denials and mentions; every named family has a template that the plain comparison confirms."""
    model = licences.train(spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet"))
    cases = {"use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:": "bsd",
             "to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.": "mit",
             "This file is part of Foo, distributed under the terms of the GNU GPL v2 or later.": "gpl-2.0", "BSD 2-Clause License": "bsd",
             "The MIT License (MIT)": "mit", "License: MIT": "mit", "License: GPLv3": "gpl-3.0", "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0",
             "This work is not licensed under the GNU General Public License, version 3.": "", "MIT is a university in Boston.": "",
             "He read about the GNU General Public License, version 3, in a book.": "", "The source of the river is in the public woods.": ""}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    frame = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(cases)], "doc_id long, text string").union(docs)
    got = {r.doc_id: r.licences for r in licences.licences(frame, model).collect()}
    assert [got[10**6 + i] for i in range(len(cases))] == list(cases.values())

    def share(text, template):
        w = re.findall("[a-z0-9]+", text.lower())
        have = {f"{a} {b}" for a, b in zip(w, w[1:])}
        pairs = licences.pairs_of(template)
        return len(have & set(pairs)) / len(pairs)

    for r in licences.paragraphs(frame, model).where("family != 'unknown'").collect():
        best = max(share(r.paragraph, t) for t in licences.TEMPLATES[r.family])
        assert best >= 0.6 and r.similarity == pytest.approx(best)
    # whole sentences of the corpus that hold a template in full are named
    full = [t for ts in licences.TEMPLATES.values() for t in ts]
    missed = [r.doc_id for r in docs.collect() if not got[r.doc_id]
              and any(share(x, t) == 1 for x in re.split(r"\n|(?<=[.;:!?])\s+", r.text or "") for t in full if len(t) > 25)]
    assert not missed
