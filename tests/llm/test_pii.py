"""Personal data spans against a plain version with Python's own expressions, and planted cases."""

import hashlib
import re

import pytest

from sparkmart.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def plain(text):
    out = []
    for nth, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(p) > 255 for p in m[0].split("."))
                    or kind == "card" and not (12 <= len(d) <= 19 and luhn(d))
                    or kind == "phone" and not 9 <= len(d) <= 15):
                continue
            out.append((m.start(), nth, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def check(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.digest(pii.scan(docs)).collect()}
    for i, text in enumerate(texts):
        want = plain(text)
        got = [s for s in rows[i].spans.split(",") if s and s.split(":")[0] in BASE]
        assert got == want, (text or "")[:200]
        assert rows[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        for kind in BASE:
            assert rows[i][f"n_{kind}"] == sum(s.startswith(kind + ":") for s in want)
    return rows


def test_awkward_texts(spark):
    check(spark, [
        None, "", "no data", "a@b.c_d@e.f", "a@b.c.d@e.f", "a@a@b.cc", "x.@y-.z..", "a@b", "@a.b", "a@.b",
        "é@b.c ü.x@ö.de mail 😀 z@q.org", "1.2.3.4.5.6.7.8", "1.2.3.4.5", "256.1.1.1 255.255.255.255",
        "0001.0.00.000255", "99999999999999999999.1.1.1", "1..2.3.4 1.2.3.", "4111 1111 1111 1111",
        "4111-1111-1111-1111 4111  1111 1111 1111", "4465758382889437 4465758382889437", "0000 0000 0000",
        "+1 (743) 555-3824 x", "+1+1+1 555 555 5555", "+49 30 1234567--8 ++1234567890", "+1 (((((", "+12",
        "tel +33 1 23 45 67 89 01 23 45 67", "5", "5 5", "a1-2 3", "١٢٣.1.2.3 +１23456789",
    ])


def test_many_matches_and_long_runs(spark):
    check(spark, ["1.2.3.4 " * 1500 + "a@b.cc " * 700, "7" * 50_000, "a" * 50_000 + "@", "a@" * 20_000,
                  "a@b" + ".c" * 30_000, "1." * 30_000, "+" * 20_000 + "1" * 20, "1 " * 20_000,
                  "4111111111111111 x " * 600])


def test_given_documents(spark, sf001):
    texts = [r.text for r in spark.read.parquet(f"{sf001}/documents.parquet").select("text").collect()]
    rows = check(spark, texts)
    assert sum(r.n_email + r.n_phone for r in rows.values()) > 0


def test_added_kinds_and_scores(spark):
    docs = spark.createDataFrame([
        (1, "Bank: DE89 3704 0044 0532 0130 00 GB82WEST12345698765432, DE89370400440532013001"),
        (2, "ssn 123-45-6789"), (3, "part 123-45-6789"), (4, "write to a@b.cc"), (5, "xx a@b.cc"),
        (6, "XDE89370400440532013000")], "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.text, s.score) for s in r.spans] for r in pii.scan(docs).collect()}
    # no digit run of the last number passes Luhn; an IBAN's digits may be a card number as well
    assert [s for s in got[1] if s[0] == "iban"] == [
        ("iban", "DE89 3704 0044 0532 0130 00", 100), ("iban", "GB82WEST12345698765432", 80)]
    assert got[2] == [("ssn", "123-45-6789", 60)] and got[3] == []
    assert got[4] == [("email", "a@b.cc", 100)] and got[5] == [("email", "a@b.cc", 80)]
    assert all(s[0] != "iban" for s in got[6])


def test_rows_are_kept(spark):
    docs = spark.createDataFrame([(1, "a@b.cc", 7), (1, "a@b.cc", 8), (None, None, 9)],
                                 "doc_id long, text string, spans long")
    rows = sorted((r.doc_id or 0, len(r.spans)) for r in pii.scan(docs).collect())
    assert rows == [(0, 0), (1, 1), (1, 1)]
    assert pii.digest(pii.scan(docs.limit(0))).collect() == []


@pytest.mark.parametrize("text, hits", [("call +1 523 555 1055", "phone:5:20"), ("", "")])
def test_positions_are_code_points(spark, text, hits):
    docs = spark.createDataFrame([(1, text), (2, "😀" + text)], "doc_id long, text string")
    rows = {r.doc_id: r.spans for r in pii.digest(pii.scan(docs)).collect()}
    assert rows[1] == hits and (not hits or rows[2] == "phone:6:21")


def test_plan_is_native(spark, sf001):
    plan = pii.digest(pii.scan(spark.read.parquet(f"{sf001}/documents.parquet")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text
