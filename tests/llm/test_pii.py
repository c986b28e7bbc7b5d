import hashlib
import random
import re

from channelmart.llm import pii
from channelmart.llm.queries import op3_pii

EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(text):
        digits, total = re.sub("[^0-9]", "", m.group()), 0
        for k, c in enumerate(reversed(digits)):
            x = int(c) * (1 + k % 2)
            total += x - 9 if x > 9 else x
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def digest(found):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in found)


def test_patterns_equal_brute_force():
    rng = random.Random(3)
    for _ in range(20000):
        text = "".join(rng.choices("a.@-+ 0123456789()%é\n", weights=[3, 3, 2, 2, 2, 2] + [3] * 10 + [1] * 5, k=rng.randint(0, 50)))
        assert pii.base_spans(text) == brute(text)


def test_long_runs_are_scanned_once():
    for text in ("a" * 300_000, "a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" + " 1" * 100_000, "@a" * 100_000, "9" * 5000 + ".1.1.1"):
        pii.base_spans(text)


def test_query_against_brute_force(spark, sf_dir):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op3_pii(spark, sf_dir).collect()
    assert len(got) == len(rows)
    for r in got:
        found = brute(rows[r["doc_id"]] or "")
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(sum(k == n for _, k, _ in found) for n in range(4))
        assert r["base_sha256"] == hashlib.sha256(digest(found).encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(digest(found).split(",") if found else []) <= set(spans)
        assert spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), pii.KINDS.index(s.split(":")[0])))


def corpus(rng):
    common = "the house and garden were quiet this morning".split()
    text = lambda: " ".join(rng.choice(common) for _ in range(15))
    rows = [(k, text()) for k in range(200)]
    rows += [(300 + k, f"{text()} Zephyrine ann@mail.example.org garden {text()}") for k in range(4)]      # a word that only this address has
    rows += [(400 + k, f"{text()} once{'abcdef'[k]} bob{k}@mail.example.org {text()}") for k in range(6)]  # seen once each: no evidence
    return rows


def test_disclosing_terms_go_and_common_ones_stay(docs):
    rows = corpus(random.Random(4))
    found = {r["doc_id"]: [(s["kind"], s["start"], s["end"], s["removed"]) for s in r["spans"]] for r in pii.spans(docs(rows)).collect()}
    texts = dict(rows)
    for k in range(300, 304):
        at = texts[k].index("Zephyrine")
        assert [("term", at, at + 9, True), ("email", at + 10, at + 30, False)] == found[k]
    assert all([kind for kind, *_ in found[400 + k]] == ["email"] for k in range(6))
    assert all(found[k] == [] for k in range(200))


def test_terms_go_far_from_the_entity_and_in_other_documents(docs):
    rng = random.Random(5)
    common = "the house and garden were quiet this morning".split()
    text = lambda n: " ".join(rng.choice(common) for _ in range(n))
    rows = [(k, text(15)) for k in range(200)]
    rows += [(300 + k, f"é {text(5)} Zephyrine {text(300)} ann@mail.example.org {text(60)} zephyrine") for k in range(5)]
    rows += [(400, f"{text(40)} ZEPHYRINE {text(5)}")]
    found = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == "term"] for r in pii.spans(docs(rows)).collect()}
    for k, t in rows:
        assert found[k] == [m.span() for m in re.finditer("zephyrine", t, re.I)]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs(rows)).collect()}
    assert not any("zephyrine" in t.lower() for t in clean.values())


def test_pairs_are_summed_over_full_buffers(docs, monkeypatch):
    rows = corpus(random.Random(4))
    want = sorted(map(tuple, pii.spans(docs(rows)).collect()))
    monkeypatch.setattr(pii, "PAIRS", 1)
    assert sorted(map(tuple, pii.spans(docs(rows)).collect())) == want


def test_entities_of_one_and_two_documents_have_terms_on_the_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
    held, words = {}, {}
    for k, text in texts.items():
        for a, kind, b in pii.base_spans(text):
            held.setdefault(pii.entity(kind, text[a:b]), set()).add(k)
        for w in {w.lower() for w in re.findall(r"[^\W\d_]+", text)}:
            words[w] = words.get(w, 0) + 1
    found = {r["doc_id"]: [s for s in r["spans"] if s["kind"] == "term"] for r in pii.spans(df).collect()}
    for n in (1, 2):
        assert any(found[k] for ks in held.values() if len(ks) == n for k in ks)
    terms = {texts[k][s["start"]:s["end"]].lower() for k, ss in found.items() for s in ss}
    assert terms and not any(words.get(t, 0) > len(texts) / 100 for t in terms)


def test_sanitised_texts_and_cases(docs):
    rows = corpus(random.Random(4)) + [(None, None), (None, "call +49 30 1234567 now"), (7000, ""), (7001, "a@b.c"), (7001, "a@b.c"), (7001, None), (7002, "x" * 200_000 + " 10.0.0.1")]
    df = docs(rows)
    clean = pii.sanitise(df)
    assert clean.columns == df.columns and clean.count() == len(rows)
    got = {}
    for r in clean.collect():
        got.setdefault(r["doc_id"], []).append(r["text"])
    assert "Zephyrine" not in got[300][0] and "[email]" in got[300][0]
    assert sorted(got[None], key=str) == [None, "call [phone] now"] or sorted(got[None], key=str) == ["call [phone] now", None]
    assert sorted(map(str, got[7001])) == ["None", "[email]", "[email]"] and got[7000] == [""]
    assert got[7002] == ["x" * 200_000 + " [ip]"]
    assert all(got[k] == [t] for k, t in rows[:200])
    assert pii.sanitise(docs([])).count() == 0 and pii.spans(docs([])).count() == 0


def test_generalised_and_overlapping_spans():
    spans = [{"kind": "card", "start": 2, "end": 8, "removed": False}, {"kind": "phone", "start": 4, "end": 10, "removed": False}, {"kind": "term", "start": 11, "end": 13, "removed": False}]
    assert pii.redact("a 12345678 bc d", spans) == "a [card] [word] d"
