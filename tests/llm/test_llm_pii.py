"""Kinds beyond the base ones, and context words, against a plain version; work in proportion to the matches."""

import random
import re
import time

import brute
import pytest

from cohortspark.llm import pii

KINDS = {k.name: k for k in pii.KINDS}


def plain_spans(text):
    """(kind, start, end, score) of all kinds, context read from the text by position."""
    found = [(k, a, b) for k, a, b in brute.pii_base(text)]
    for name in ("iban", "amex", "ssn"):
        for m in re.finditer(KINDS[name].pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if name == "iban":
                bare = m[0].replace(" ", "")
                good = int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1
            elif name == "amex":
                good = brute.luhn(digits)
            else:
                good = digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"
            if good:
                found.append((name, m.start(), m.end()))
    out = []
    for name, a, b in found:
        near = re.search(KINDS[name].context, text[max(0, a - 48):a].lower()) or re.search(KINDS[name].context, text[b:b + 48].lower())
        score = KINDS[name].score + (KINDS[name].bonus if near else 0.0)
        if score >= pii.LEAST_SCORE:
            out.append((name, a, b, score))
    return out


def spans_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: [tuple(s) for s in r["pii"]] for r in pii.find_pii(df).collect()}


PARTS = ["SSN", "social", "amex", "card", "visa", "iban", "account", "ip", "host", "mail", "tel", "word", "é", "漢", "\n", "  ", "x" * 30, "y" * 47, ",", ".",
         "123-45-6789", "234-56-7890", "000-12-3456", "3782 822463 10005", "378282246310005", "371449635398431", "371449635398432", "ES9121000418450200051332",
         "ES91 2100 0418 4502 0005 1332", "AT611904300234573201", "AT61", "4111 1111 1111 1111", "10.1.2.3", "300.1.2.3", "a@b.co", "+49 30 1234567", "7", "12 34"]


def test_all_kinds_match_plain(spark):
    draw = random.Random(11)
    texts = [draw.choice(["", " "]).join(draw.choice(PARTS) + draw.choice(["", " "]) for _ in range(draw.randint(0, 40))) for _ in range(250)]
    got = spans_of(spark, texts)
    for i, text in enumerate(texts):
        want = plain_spans(text)
        assert [s[:3] for s in got[i]] == [s[:3] for s in want], text
        assert [s[3] for s in got[i]] == pytest.approx([s[3] for s in want]), text


def test_context_on_both_sides_and_across_matches(spark):
    many = "SSN " + ", ".join(f"123-45-{n:04d}" for n in range(1, 9))
    texts = ["SSN: 123-45-6789, 234-56-7890", "3782 822463 10005 amex", "123-45-6789, 234-56-7890 are social", "social " + "x" * 48 + " 123-45-6789", many]
    got = spans_of(spark, texts)
    assert [len(got[i]) for i in range(5)] == [2, 1, 2, 0, 4]  # 48 characters before the fifth hold no hint any more


def test_many_matches_take_time_in_proportion(spark):
    def seconds(n):
        text = " ".join(f"w{k % 40}x{k} 1.2.3.4" if k % 8 == 0 else f"w{k % 40}x{k}" for k in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        begin = time.perf_counter()
        assert len(pii.find_pii(df).collect()[0]["pii"]) == -(-n // 8)
        assert pii.redact_pii(df).collect()[0]["text"].count("<IP>") == -(-n // 8)
        return time.perf_counter() - begin

    seconds(100)
    few, many = seconds(8_000), seconds(64_000)
    assert many < 8 * few + 10
