from __future__ import annotations

import hashlib
import random
import re

import duckdb
import pyarrow as pa
import pytest

from llm.conftest import ODD
from tableferry.llm import personal_data


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        doubled = int(c) * 2
        total += int(c) if i % 2 == 0 else doubled // 10 + doubled % 10
    return total % 10 == 0


def base_spans(text):
    """By brute force, as the contract states them."""
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append(("ip", *m.span()))
    for kind, pattern, least, most, check in (
        ("card", r"[0-9]([\x20-]?[0-9])+", 13, 19, luhn),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15, lambda x: True),
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if least <= len(digits) <= most and check(digits):
                found.append((kind, *m.span()))
    return found


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def noise(seed, alphabet, n, most):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, most))) for _ in range(n)]


TOKENS = [
    "123-45-6789", "(212) 555-1234", "card", "visa", "phone", "ssn", "order", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432",
    "BE68 5390 0754 7034", "AND", "4111111111111111", "4111111111111112", "é", "\n", "x1", "a@b.co", "+1 (222) 555-1234", "10.0.0.1",
]
RANDOM = [
    *noise(1, ["a", "B", "1", "2", "3", " ", ".", "@", "+", "-", "(", ")", "%", "_", "é", "\U0001f600", "45.6@x"], 800, 120),
    *noise(2, "0123456789 -.+(", 400, 200),
    *noise(3, [t + s for t in TOKENS for s in ("", " ", "-")], 600, 20),
]


@pytest.fixture(scope="module")
def reported(spark):
    rows = list(enumerate([*RANDOM, *[t for _, t in ODD if len(t or "") < 200_000], "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "999.2.3.4.5"]))
    return rows, personal_data.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()


def test_base_spans_equal_brute_force(reported):
    rows, found = reported
    found = {r.doc_id: r for r in found}
    for i, text in rows:
        spans = base_spans(text or "")
        assert found[i].base_sha256 == hashlib.sha256(listed(spans).encode()).hexdigest(), text
        assert [found[i][f"n_{k}"] for k in personal_data.BASE] == [sum(s[0] == k for s in spans) for k in personal_data.BASE]
        assert set(listed(spans).split(",")) - {""} <= set(found[i].spans.split(","))


def test_all_spans_equal_sql(reported):
    rows, found = reported
    connection = duckdb.connect()
    connection.register("documents", pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]}))
    assert sorted(connection.execute(personal_data.SQL).fetchall()) == sorted(tuple(r) for r in found)


def spans_of(spark, text):
    return [(s.kind, s.text, s.score) for s in personal_data.find_spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().spans]


def test_checksums_confirm(spark):
    text = "pay DE89 3704 0044 0532 0130 00 IS, not DE88 3704 0044 0532 0130 00; GB82WEST12345698765432 xGB82WEST12345698765432"
    assert [t for _, t, _ in spans_of(spark, text)] == ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"]


def test_context_adjusts_the_score(spark):
    assert [k for k, _, _ in spans_of(spark, "my ssn is 123-45-6789")] == ["ssn"]
    assert spans_of(spark, "number 123-45-6789") == []
    assert spans_of(spark, "ssn of order 123-45-6789") == []
    plain, near, against = (spans_of(spark, f"{word} 4111111111111111")[0][2] for word in ("the", "visa", "invoice"))
    assert against < plain < near


def test_card_in_a_longer_chain(spark):
    assert [(k, t) for k, t, _ in spans_of(spark, "card 4111111111111111 4111111111111112")] == [("card_part", "4111111111111111")]


def test_redacts(spark):
    docs = spark.createDataFrame([(1, "mail a@b.co or +1 (222) 555-1234."), (2, None), (3, "")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in personal_data.redact(docs).collect()} == {1: "mail <email> or <phone>.", 2: "", 3: ""}


@pytest.mark.parametrize(
    "text", ["x" * 300_000, "1" * 300_000, "1 " * 150_000, "+1" + "(" * 300_000, "a@" + "b" * 300_000, "a@b." + "c." * 100_000, "1.2.3.4 " * 30_000]
)
def test_long_texts_are_read_whole(spark, text):
    tail = "~ me@example.org"
    found = personal_data.find_spans(spark.createDataFrame([(1, text + tail)], "doc_id long, text string")).first().spans
    assert (found[-1].text if found[-1].kind == "email" else [s for s in found if s.kind == "email"][-1].text) == "me@example.org"
    assert [s.start for s in found if s.text == "me@example.org"] == [len(text) + 2]
    assert sum(s.kind == "ip" for s in found) == (30_000 if text[:2] == "1." else 0)


def test_odd_tables(docs):
    assert personal_data.report(docs([])).count() == 0
    assert personal_data.report(docs()).count() == len(ODD)
    empty = [r for r in personal_data.report(docs([(1, None), (None, "")])).collect()]
    assert {(r.n_email, r.spans, r.base_sha256) for r in empty} == {(0, "", hashlib.sha256(b"").hexdigest())}


def test_no_python_and_no_shuffle(docs):
    plan = personal_data.report(docs())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
