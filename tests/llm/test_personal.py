"""Personal data against plain patterns and a brute-force bootstrap."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from rivulet.llm import personal

SF = "/root/testdata/sf0.001"
FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    total = 0
    for i, c in enumerate(d[::-1]):
        x = int(c) * (1 + i % 2)
        total += x // 10 + x % 10
    return total % 10 == 0


def good(kind, t):
    d = re.sub("[^0-9]", "", t)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in t.split(".")),
            "card": lambda: 12 <= len(d) <= 19 and luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]()


def brute_base(text):
    out = []
    for k, (kind, form) in enumerate(FORMS.items()):
        out += [(m.start(), k, m.end()) for m in re.finditer(form, text or "") if good(kind, m.group())]
    return sorted(out)


def brute_found(texts, support=3, precision=0.8, accept=0.8):
    """The bootstrap with dictionaries; patterns are tuples of words."""
    where, totals = {}, {}
    for r, text in enumerate(texts):
        marks = personal.units(text, brute_base(text))
        seq = ["<s>"] * 3
        end, at = 0, {}
        for m in marks:
            seq += [personal.word(w) for w in text[end:m[0]].split()]
            at[len(seq)] = m
            seq.append("<id>")
            end = m[1]
        seq += [personal.word(w) for w in text[end:].split()] + ["<s>"]
        for i in range(3, len(seq) - 1):
            ps = [("1", seq[i - 1]), ("2", *seq[i - 2:i]), ("3", *seq[i - 3:i]), ("b", seq[i - 1], seq[i + 1])]
            for p in ps:
                totals[p] = totals.get(p, 0) + 1
            if i in at:
                s, e, mask, known = at[i]
                name = text[s:e].lower().replace(" ", "")
                where.setdefault((name, mask, known), []).append((r, s, e, ps))
    kinds = lambda mask: [k for k in range(4) if mask >> k & 1]
    edges, sure = {}, set()
    for (name, mask, known), places in where.items():
        for k in kinds(mask):
            if known:
                sure.add((k, name))
            for *_, ps in places:
                for p in ps:
                    e = edges.setdefault((p, k, name, known), 0)
                    edges[p, k, name, known] = e + 1
    found = {}
    while True:
        conf = {x: [1.0] for x in sure}
        for x, c in found.items():
            conf.setdefault(x, []).append(c)
        pats = {}
        for (p, k, name, known), n in edges.items():
            for c in conf.get((k, name), ()):
                have = pats.setdefault((p, k), [0, 0.0])
                have[0] += 1
                have[1] += n * c
        kept = {pk: v / totals[pk[0]] for pk, (c, v) in pats.items() if c >= support and v / totals[pk[0]] >= precision}
        miss = {}
        for (p, k, name, known), n in edges.items():
            if not known and (p, k) in kept:
                miss[k, name] = miss.get((k, name), 1.0) * max(1e-3, 1 - kept[p, k])
        new = {x: 1 - m for x, m in miss.items() if 1 - m >= accept}
        if len(new) <= len(found):
            found = new
            break
        found = new
    out = {}
    for (name, mask, known), places in where.items():
        best = sorted((-found[k, name], k) for k in kinds(mask) if (k, name) in found)
        if not known and best:
            for r, s, e, _ in places:
                out.setdefault(r, []).append((s, best[0][1], e))
    return {r: sorted(v) for r, v in out.items()}


@settings(max_examples=800, deadline=None)
@given(st.text(alphabet="ab1290.@+- ()-é%\n", max_size=60))
def test_fixed_forms(text):
    assert personal.seeds(text) == brute_base(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1112", "+1 (838) 555-9577", "1.2.3.4", "1.2.3.256", "a.b@c.d",
                                 "a@b@c.de", "x", ".", " ", "-", "+", "5", "@", "　", "+49 30 1234567 "]), max_size=12))
def test_fixed_forms_in_a_row(pieces):
    text = "".join(pieces)
    assert personal.seeds(text) == brute_base(text)
    for (s, e, _, _), (a, b, _, _) in zip(u := personal.units(text, personal.seeds(text)), u[1:]):
        assert s < e <= a < b


def test_long_tokens_take_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" + "(" * 300_000, "a." * 150_000 + "@", "1 " * 150_000, "x1" * 150_000):
        personal.units(t, personal.seeds(t))


def planted():
    """Phones and cards told by their contexts, and numbers of the same look elsewhere."""
    t = []
    for i in range(20):
        t.append(f"Filler words here {i}. Please call me at +1 (838) 555-{1000 + i} today, or write mail to user{i}@mail.example.com soon.")
    t += [f"He said: please call me at {x} today." for x in ("(838) 555-7777", "555-0199-22", "0049 30 123456")]
    t += ["Please write mail to someone@localhost soon.", "Please write mail to everybody soon", "the build 555-0199-33 failed", "someone@elsewhere is a handle"]
    for i in range(40):
        n = f"41111111111{1000 + i}"
        d = next(c for c in "0123456789" if luhn(n + c))
        t.append(f"Charge it to credit card no {n + d} please. Filler {i} of text")
    t += ["Part 4111111111115555 is out of stock", "order of 4111111111115556 things"]
    for i in range(8):
        n = f"51111111111{2000 + i}"
        d = next(c for c in "0123456789" if not luhn(n + c))
        t += [f"Charge it to credit card no {n + d} please.", f"well {i}, her secret plastic is {n + d} ok"]
    return [*t, "yes, her secret plastic is 4999999999999999 ok"]


def collected(df):
    return {r.id: ([tuple(x) for x in r.base], [tuple(x) for x in r.found], [tuple(x) for x in r.all]) for r in df.collect()}


def test_bootstrap_against_brute_force(spark):
    texts = planted()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got, want = collected(personal.personal_data(docs)), brute_found(texts)
    for i, t in enumerate(texts):
        assert got[i] == (brute_base(t), want.get(i, []), sorted(brute_base(t) + want.get(i, [])))
    said = {texts[i][s:e] for i, v in want.items() for s, _, e in v}
    assert {"(838) 555-7777", "555-0199-22", "someone@localhost"} <= said and len(said) > 10
    assert "4999999999999999" in said  # by a pattern that only found instances made known
    assert not {"555-0199-33", "someone@elsewhere", "4111111111115555", "4111111111115556"} & said


def test_copies_do_not_make_a_pattern(spark):
    """One number in a thousand copies is one instance."""
    texts = ["ring the bell at +1 (838) 555-1234 now"] * 1000 + ["ring the bell at 838-555-9999 now"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert personal.personal_data(docs).where("size(found) > 0").count() == 0


def test_odd_rows(spark, odd_docs):
    out = personal.personal_data(odd_docs)
    assert out.count() == odd_docs.count() and out.where("size(all) > 0").count() == 0
    assert personal.personal_data(odd_docs.limit(0)).count() == 0
    rows = [(1, "mail a@b.co", "x"), (1, "mail a@b.co", "y"), (None, "ip 1.2.3.4", "z"), (2, None, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, units string")
    assert sorted((r.id or 0, r.n_email, r.n_ip) for r in personal.personal_data(docs).collect()) == [(0, 0, 1), (1, 1, 0), (1, 1, 0), (2, 0, 0)]


def test_query_against_brute_force(spark):
    got = {r.doc_id: r for r in personal.op11_personal(spark, SF).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = brute_found([t or "" for _, t in rows])
    assert len(got) == len(rows)
    names = list(FORMS)
    for k, (i, t) in enumerate(rows):
        base = brute_base(t)
        listed = lambda v: ",".join(f"{names[kind]}:{s}:{e}" for s, kind, e in sorted(v))
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[1] == j for x in base) for j in range(4)]
        assert r.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest() and r.spans == listed(base + found.get(k, []))
