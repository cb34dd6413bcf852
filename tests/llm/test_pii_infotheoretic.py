import hashlib
import math
import re
from collections import Counter, defaultdict

from corpusloom.llm.pii_infotheoretic import base_spans, luhn, op8_pii_infotheoretic, pii, redact

from .conftest import DATA


def plain(text):
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", m))
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    order = ["email", "ip", "card", "phone"]
    return sorted(((m.start(), m.end(), k) for k, m in out), key=lambda s: (s[0], order.index(s[2])))


HARD = [
    "", "a@b", "a@b.c", "x.y@z-.-.q@r.s.t", "@@a@b.c@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1 1.2.3.4", "00000000000255.0.0.1", "9" * 4000 + ".1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111-1",
    "+1 (988) 555-2485 +12", "+49 30 1234567890123456", "é+1 234 567 8901é a%b@c-d.e-f", "1 " * 40, "+1" + "(" * 40 + "2", "٣.٣.٣.٣ a@b.٣",
]


def test_base_spans():
    assert [base_spans(t) for t in HARD] == [plain(t) for t in HARD]
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def test_query_keeps_every_base_span(spark):
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = {r.doc_id: r for r in op8_pii_infotheoretic(spark, DATA).collect()}
    assert got.keys() == rows.keys()
    assert any(r.spans for r in got.values())
    for d, t in rows.items():
        want = plain(t)
        said = ",".join(f"{k}:{a}:{b}" for a, b, k in want)
        assert got[d].base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert [got[d].n_email, got[d].n_ip, got[d].n_card, got[d].n_phone] == [sum(k == x for _, _, k in want) for x in ("email", "ip", "card", "phone")]
        assert set(said.split(",")) <= set(got[d].spans.split(",")) or not said


def rows_with_a_name():
    out = [(i, f"On day {w} the clerk {'Zebulon'} wrote to zeb@mail.example.org about {v} and left.", 0, "k") for i, (w, v) in enumerate([("one", "rain"), ("two", "snow"), ("three", "wind"), ("four", "fog")])]
    out += [(10 + i, f"The clerk wrote about weather number {i} and left on day one.", 0, "k") for i in range(60)]
    return out + [(90 + i, "Unique Quixotic friend of q@mail.example.org here.", 0, "k") for i in range(5)] + [(None, None, None, "k"), (99, "", 0, "k"), (99, "", 0, "k")]


def test_terms_that_give_an_entity_away(spark):
    rows = rows_with_a_name()
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, key string").repartition(3)
    got = pii(df).collect()
    assert len(got) == len(rows)
    for r in got:
        terms = [s for s in r.spans.split(",") if s.startswith("term:")]
        if r.doc_id is not None and r.doc_id < 4:
            text = rows[r.doc_id][1]
            assert [text[int(a) : int(b)] for _, a, b in (t.split(":") for t in terms)] == ["Zebulon"]
        else:
            assert not terms
    assert pii(df.limit(0)).count() == 0
    kept = {(r.doc_id, r.text, r.n_chars, r.key) for r in redact(df).collect()}
    said = "On day one the clerk <TERM> wrote to <EMAIL> about rain and left."
    assert (0, said, len(said), "k") in kept
    assert (None, None, None, "k") in kept and (10, rows[4][1], 0, "k") in kept


def test_terms_that_give_a_domain_away(spark):
    """No address stands twice, but all of one firm, and its name beside them."""
    docs = [(i, f"Report {w} of Acmecorp by staff{i}@acme.example.com on matters of {v}.") for i, (w, v) in enumerate([("alpha", "rain"), ("beta", "snow"), ("gamma", "wind"), ("delta", "fog")])]
    docs += [(10 + i, f"Report number {i} on matters of weather by p{i}@host{i}.example.org.") for i in range(60)]
    for r in pii(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        text = dict(docs)[r.doc_id]
        assert [text[int(a) : int(b)] for k, a, b in (s.split(":") for s in r.spans.split(",")) if k == "term"] == (["Acmecorp"] if r.doc_id < 4 else [])


def terms(text):
    spans = plain(text)
    return [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W\d_]{3,}", text) if not any(a < m.end() and m.start() < b for a, b, _ in spans)]


def plain_terms(rows, share=0.9, chance=0.01):
    """Spans of the disclosing terms of each row, told from the definition."""
    value = lambda t, a, b, k: t[a:b].lower() if k in ("email", "ip") else k + re.sub("[^0-9]", "", t[a:b])
    digits = lambda t, a, b: re.sub("[^0-9]", "", t[a:b])
    shared = lambda t, a, b, k: t[a:b].lower()[t[a:b].index("@") :] if k == "email" else t[a : t.rindex(".", a, b) + 1] if k == "ip" else f"{k}:{digits(t, a, b)[:6]}"
    held = [{f(t, *s) for s in plain(t) for f in (value, shared)} for t in rows]
    said = [{w for _, _, w in terms(t)} for t in rows]
    n_term = Counter(w for t in rows for w in set(re.findall(r"[^\W\d_]{3,}", t.lower())))
    n_entity, texts = Counter(e for h in held for e in h), defaultdict(set)
    both, evidence = Counter(), defaultdict(set)
    for t, h, s in zip(rows, held, said, strict=True):
        for e in h:
            texts[e].add(t)
            for w in s:
                both[e, w] += 1
                evidence[e, w].add(t)
    pairs = [x for x in both if len(texts[x[0]]) > 1]
    told = set()
    for e, w in pairs:
        p, q, k = both[e, w] / n_term[w], n_entity[e] / len(rows), len(evidence[e, w])
        if k > 1 and q < 1 and math.log2(p / q) >= -share * math.log2(q):
            far = p * math.log(p / q) + ((1 - p) * math.log((1 - p) / (1 - q)) if p < 1 else 0)
            if math.log(len(pairs)) - n_term[w] * k / both[e, w] * far <= math.log(chance):
                told.add((e, w))
    return [[(a, b) for a, b, w in terms(t) if any((e, w) in told for e in h)] for t, h in zip(rows, held, strict=True)]


def test_terms_equal_brute_force_over_all_documents(spark):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    some = [t for _, t in docs if plain(t)][:12]
    docs += [(10_000 + i, f"{t} edited {i}") for i, t in enumerate(some)] + [(20_000 + i, f"newword{i} {t}") for i, t in enumerate(some[:6])]
    docs += [(30_000 + i, docs[i][1]) for i in range(40)] + [(None, some[0]), (40_000, some[1] + " once more"), (40_000, some[1] + " once more")]
    want = plain_terms([t for _, t in docs])
    assert sum(map(bool, want)) > 20
    assert not all(map(bool, want[1000:]))
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, term string, entity int").repartition(6)
    got = sorted((r.doc_id or -1, [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("term:")], r.n_term, r.n_spans) for r in pii(df).collect())
    assert got == sorted((d or -1, w, len(w), len(w) + len(plain(t))) for (d, t), w in zip(docs, want, strict=True))


def test_very_long_text(spark):
    rows = [(i, f"{'filler word ' * 120_000}{x} Zebulon zeb@mail.example.org {x} " + "end " * 1000 + "zebulon.") for i, x in enumerate(("one", "two", "three"))] + [(10 + i, f"filler word end number {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in pii(df).where("doc_id < 3").collect():
        text = rows[r.doc_id][1]
        assert [text[int(a) : int(b)] for k, a, b in (s.split(":") for s in r.spans.split(",")) if k == "term"] == ["Zebulon", "zebulon"]
