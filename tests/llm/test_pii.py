from __future__ import annotations

import hashlib
import random
import re

import pandas as pd
import pytest

from pseudora.llm import pii

TEXTS = [
    None, "", "plain words", "é mail beg.67@mail5.example.com, a@b@c.de x@y", "@a.b %@-.-. a@b.c.d@e.f",
    "52.139.117.253 256.1.1.1 1.2.3.4.5.6.7.8 01.002.0255.4 9999999999.1.1.1",
    "4249604924884952 4249 6049 2488 4952 4249604924884953 1-2-3", "+1 (979) 555-6697 +123 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7",
    "𝒳 +49 30 1234567 𝒳 a" + "b" * 5000 + "@c.d", "0000000000000000 " * 5, "1 " * 3000,
]


def luhn(digits):
    double = [int(d) * (2 if k % 2 else 1) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in double) % 10 == 0


def plain_search(text):
    text = text or ""
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans_equal_plain_search(text):
    assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text or "")] == plain_search(text)


def test_report(documents):
    rows = list(enumerate(TEXTS)) + [(5, TEXTS[5])]
    for r in pii.pii_report(documents(rows)).collect():
        want = plain_search(TEXTS[r["doc_id"]])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [
            sum(s[0] == kind for s in want) for kind in pii.KINDS[:4]
        ]
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert r["spans"] == written
    assert pii.pii_report(documents([])).count() == 0


def bootstrap_corpus(prose):
    """Mail addresses follow "reach at"; unseen numbers do too, other numbers follow prose."""
    rows = [(k, f"{prose(20)} reach at user{k}@mail.example.org {prose(20)}") for k in range(12)]
    rows += [(100 + k, f"{prose(20)} reach at ZX-88{k}12345 {prose(20)}") for k in range(2)]
    rows += [(200, f"{prose(20)} ZX-88012345 {prose(5)}"), (201, f"{prose(20)} part 7712345 {prose(9)}")]
    rows += [(300 + k, f"{prose(10)} member id ZX-88{k % 2}12345 {prose(5)}") for k in range(6)]
    return rows


def test_contexts_find_unseen_identifiers(documents, prose):
    rows = bootstrap_corpus(prose)
    texts = dict(rows)
    found = {}
    for r in pii.pii_report(documents(rows)).collect():
        spans = [s.split(":") for s in r["spans"].split(",") if s.startswith("found")]
        found[r["doc_id"]] = [texts[r["doc_id"]][int(a) : int(b)] for _, a, b in spans]
    assert found[100] == ["ZX-88012345"] and found[101] == ["ZX-88112345"]
    assert found[201] == [] and not any(found[k] for k in range(12))


def test_pattern_totals_do_not_depend_on_the_way(spark, documents, prose):
    docs = documents(bootstrap_corpus(prose))
    patterns = spark.createDataFrame([("reach at",), ("member id",), ("not there",)], "pattern string")
    counts = [dict(pii.pattern_totals(docs, patterns, most).collect()) for most in (0, 100)]
    assert counts[0] == counts[1] == {"reach at": 14, "member id": 6}


def found_texts(rows, report):
    texts, found = dict(rows), {}
    for r in report.collect():
        spans = [s.split(":") for s in r["spans"].split(",") if s.startswith("found")]
        found[r["doc_id"]] = [texts[r["doc_id"]][int(a) : int(b)] for _, a, b in spans]
    return found


@pytest.mark.parametrize("label", ["mail=", "mail:", "reach (", 'id="', "reach <", "e-mail: ", "key #"])
def test_labels_glued_to_the_value(documents, prose, label):
    rows = [(k, f"{prose(9)} my {label}user{k}@mail.example.org {prose(9)}") for k in range(12)]
    rows += [(100, f"{prose(9)} my {label}8812345 {prose(9)}"), (101, f"{prose(9)} part 7712345 {prose(9)}")]
    found = found_texts(rows, pii.pii_report(documents(rows)))
    assert found[100] == ["8812345"] and found[101] == []


def test_very_long_words_before_a_value(documents, prose):
    long = "w" * 300
    rows = [(k, f"{prose(9)} {long} {long} user{k}@mail.example.org") for k in range(12)]
    rows.append((100, f"{prose(9)} {long} {long} 8812345"))
    assert found_texts(rows, pii.pii_report(documents(rows)))[100] == ["8812345"]


def test_patterns_of_spans_are_counted_wherever_they_stand(spark, documents):
    rows = [(0, "my ssn:a@b.de my ssn: c@d.de my ssn:000-00-0000 my ssn: none"), (1, "İİ my ssn:\ne@f.de"), (2, "éa@b.de x")]
    spans = pii.extracted(documents(rows)).selectExpr("explode(spans) AS s").select("s.value", "s.pattern").collect()
    assert {r["pattern"] for r in spans if r["value"] in ("a@b.de", "c@d.de", "e@f.de")} == {"my ssn:", ""}
    counts = pii.pattern_totals(documents(rows), spark.createDataFrame([("my ssn:",)], "pattern string"))
    assert counts.collect() == [("my ssn:", 5)]


@pytest.mark.parametrize(
    "value",
    ["123 45 6789", "DE89 3704 0044 0532 0130 00", "555.123.4567", "12/34/56", "(555) 123-4567", "jdoe_smith", "A-7", "42",
     "o.brien", "jane (at) example (dot) org", "jane[at]example[dot]org", "12 34", "8812345", "user_8812345"],
)
def test_whatever_stands_in_good_contexts(documents, prose, value):
    rows = [(k, f"{prose(9)} my contact: user{k}@mail.example.org, {prose(9)}") for k in range(12)]
    rows += [(100, f"{prose(9)} my contact: {value}, {prose(9)}"), (101, f"{prose(9)} of {value[:3]}x 7712345 {prose(9)}")]
    rows += [(100, rows[12][1]), (None, rows[12][1]), (102, None)]
    found = found_texts(rows, pii.pii_report(documents(rows)))
    assert found[100] == found[None] == [value] and found[101] == []
    assert not any(found[k] for k in range(12))


def test_common_words_and_numbers_are_left_alone(documents, prose):
    rows = [(k, f"{prose(9)} my contact: user{k}@mail.example.org, {prose(9)}") for k in range(12)]
    rows += [(100, "my contact: then my contact: 12 and 8812345 or"), (101, "then and 12 or. then 12 at"), (102, "12 then")]
    assert found_texts(rows, pii.pii_report(documents(rows)))[100] == []


def test_followers_do_not_depend_on_the_way(spark, documents, prose):
    rows = [(1, "my contact: jdoe, x"), (2, "my contact: jdoe. then 12 34 my contact: then"), (None, "my contact: 12 34")]
    scores = spark.createDataFrame([("my contact:", 0.9), ("then 00", 0.1)], "pattern string, score double")
    ways = [sorted(map(str, pii.followers(documents(rows), scores, most).collect())) for most in (0, 100)]
    assert ways[0] == ways[1] and len(ways[0]) == 2


def test_long_inputs_take_linear_time():
    import time

    def seconds(text):
        start = time.perf_counter()
        base = pii.base_spans(text)
        pii.candidates(text, base)
        return time.perf_counter() - start

    assert seconds("1" * 10**6) < 20
    assert seconds("1." * 300_000) < 20
    assert seconds(" ".join(f"a{k}@b.org 123456{k}" for k in range(20_000))) < 20


def test_covers_answer_like_plain_search():
    chance = random.Random(2)
    for _ in range(200):
        spans = [(a, a + chance.randint(1, 6)) for a in (chance.randint(0, 60) for _ in range(8))]
        cover = pii._Cover(spans)
        for a in range(70):
            for b in range(a + 1, a + 5):
                assert cover.touches(a, b) == any(a < end and b > start for start, end in spans)


def test_base_counts_and_digests_in_sql(documents, prose):
    """The counts and the digest of the e-mail kind, by an independent engine."""
    import hashlib
    import re

    rows = [(k, f"{prose(5)} mail a.b{k}@mail-{k}.example.org, x@y {prose(3)} c{k}@d.net") for k in range(20)] + [(30, None), (31, "")]
    pattern = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    found = {r["doc_id"]: r for r in pii.pii_report(documents(rows)).collect()}
    for key, text in rows:
        spans = [f"email:{m.start()}:{m.end()}" for m in pattern.finditer(text or "")]
        assert found[key]["n_email"] == len(spans)
        assert found[key]["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()


def test_words_are_placed_without_a_match_each():
    for text in map(pii.flat, filter(None, TEXTS)):
        assert pii._tokens(text) == ([m.group() for m in pii._TOKEN.finditer(text)], [m.end() for m in pii._TOKEN.finditer(text)])
    for text in filter(None, TEXTS):
        found = list(pii._CORE.finditer(text))
        assert pii._ends(text, pii._CORE.findall(text)) == [m.end(1) for m in found]


def test_texts_without_a_good_pattern_are_not_cut(monkeypatch):
    class Cut:
        def findall(self, text):
            cut.append(text)
            return tokens.findall(text)

        finditer = findall

    class Shared:
        value = {"phone no:"}

    cut, tokens = [], pii._TOKEN
    monkeypatch.setattr(pii, "_TOKEN", Cut())
    found = list(pii._following(Shared)(pd.Series(["plain words", None, "Phone no: seven", "no: phone"])))
    assert [[s[3] for s in spans] for spans in found] == [[], [], ["seven"], []]
    assert cut == ["phone no: seven", "no: phone"]
