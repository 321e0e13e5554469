"""Personal data against the plain patterns, and bootstrapped entities."""

import hashlib
import random
import re

from landfall.llm.personal_data import KINDS, base_entities, find_entities, luhn
from landfall.llm.queries import QUERIES

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for i, kind in enumerate(KINDS):
        for m in re.finditer(FORMS[kind], text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            total = sum(int(d) if j % 2 == 0 else sum(map(int, str(2 * int(d)))) for j, d in enumerate(reversed(digits)))
            good = {
                "email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and total % 10 == 0, "phone": 9 <= len(digits) <= 15,
            }
            if good[kind]:
                out.append((m.start(), i, m.end()))
    return sorted(out)


def test_forms():
    pick = random.Random(4)
    parts = ["a", "b.c", "@", "x@y.z", ".", "..", "-", "1", "22", "255", "256", "0009", "1.2.3.4", "4111 1111 1111 1111", "+1 (", ")", " ", "+", "é", "５", "_", "%", "4111-1111-1111-1111", "555"]
    for _ in range(4000):
        text = "".join(pick.choices(parts, k=pick.randint(0, 25)))
        assert base_entities(text) == plain(text), text


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, "a." * 150_000, "@" * 300_000, "a@" * 150_000, "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "+" + "(" * 300_000, "1 " * 150_000, "a@" + "b" * 300_000):
        base_entities(text)


def test_luhn():
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def spans(rows):
    return {r.doc_id: [(r.t[a.start : a.end], KINDS[a.kind]) for a in r.found] for r in rows}


def test_patterns_find_unseen_identifiers(spark):
    texts = {i: f"some words here and contact mail: user{i}@mail{i}.example.com and so on {i}" for i in range(40)}
    texts |= {100 + i: f"other words, my phone number +1 (555) 555-01{10 + i} is new" for i in range(12)}
    texts[200] = "some words here and contact mail: joe(at)nowhere today"
    texts[201] = "we met; my phone number 555 0199 123 is old"
    texts[202] = "the price of 555 0199 124 units and of course joe(at)somewhere"
    texts[203], texts[204] = None, ""
    docs = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id long, text string, kind int")
    rows = find_entities(docs).collect()
    assert len(rows) == len(texts)
    found = {r.doc_id: [((texts[r.doc_id] or "")[a.start : a.end], KINDS[a.kind]) for a in r.found] for r in rows}
    assert found[200] == [("joe(at)nowhere", "email")]
    assert found[201] == [("555 0199 123", "phone")]
    assert found[202] == found[203] == found[204] == []
    assert found[3] == [("user3@mail3.example.com", "email")]
    assert {r.doc_id: [tuple(a) for a in r.base] for r in rows} == {i: plain(t) for i, t in texts.items()}


def test_common_words_are_no_patterns(spark):
    texts = [f"of the user{i}@mail.example.com and of the people of the land of the free" for i in range(30)] + ["of the joe(at)nowhere"]
    rows = find_entities(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {len(r.found) for r in rows if r.doc_id == 30} == {0}


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "x@y.zz"), (1, "x@y.zz"), (None, "x@y.zz")], "doc_id long, text string")
    assert [len(r.found) for r in find_entities(docs).collect()] == [1, 1, 1]
    assert find_entities(docs.limit(0)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op4_personal_data"](spark, folder).collect():
        want = plain(texts[r.doc_id])
        line = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in want) for i in range(4)]
        assert set(line.split(",")) - {""} <= set(r.spans.split(","))
