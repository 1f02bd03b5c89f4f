import datetime
import os
import random
import re
import sys
import time

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from helpers_llm import SCHEMA, clashing, documents  # noqa: E402

from lakesync.llm import pseudonyms as P  # noqa: E402

KEY = b"test key"


@pytest.mark.parametrize("size", [1, 2, 7, 100, 1461])
def test_permutation_and_its_undoing(size):
    new = [P.permuted(i, size, KEY) for i in range(size)]
    assert sorted(new) == list(range(size))
    assert [P.permuted(x, size, KEY, undo=True) for x in new] == list(range(size))


def luhn(text):
    digits = [int(c) for c in re.sub(r"\D", "", text)][::-1]
    return (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def replaced(text):
    return {kind: new for _, _, kind, new in P.spans(text, KEY)}


def test_formats_stay_valid():
    assert luhn(replaced("4845168114407329")["card"])
    assert "card" not in replaced("9807915762804490")
    date = replaced("on 2020-02-29.")["date"]
    datetime.date.fromisoformat(date)
    assert "date" not in replaced("2021-02-29")
    account = replaced("DE89 3704 0044 0532 0130 00")["account"]
    assert re.fullmatch(r"DE[0-9]{2}( [0-9]{4}){4} [0-9]{2}", account) and P.remainder(account.replace(" ", "")) == 1
    assert re.fullmatch(r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}", replaced("+1 (017) 555-7713")["phone"])
    host = replaced("97.51.17.173")["host"]
    assert all(0 <= int(x) <= 255 for x in host.split("."))
    assert "host" not in replaced("300.1.1.1 1.2.3.4.5")
    mail = replaced("Ab.9@mail7.example.com")["mail"]
    assert re.fullmatch(r"[A-Z][a-z]\.[0-9]@[a-z]{4}[0-9]\.example\.com", mail)
    assert not replaced("000-12-3456 and 12 words, 3.14")


def test_equal_values_stay_linked():
    one = replaced("4845168114407329")["card"]
    other = replaced("x 4845-1681-1440-7329")["card"]
    assert re.sub(r"\D", "", other) == one
    cards = [f"{i:015}" for i in range(400)]
    new = {replaced(c + P.check_digit(c)).get("card", c) for c in cards}
    assert len(new) == len(cards)


def test_frame(spark, sf_dir):
    texts = ["", None, "call +1 (017) 555-7713 now", "é a@b.co é", "plain", "a@b.co " * 20_000]
    docs = clashing(documents(spark, texts), ["Spans", "n_mail", "key"])
    assert P.pseudonymised(docs, KEY).columns.count("n_mail") == 1 and "Spans" not in P.pseudonymised(docs, KEY).columns
    got = {r.doc_id: r for r in P.pseudonymised(docs, KEY).collect()}
    assert got[0].text == "" and got[1].text is None and got[4].text == "plain"
    assert got[2].n_phone == 1 and "555-7713" not in got[2].text
    assert got[5].n_mail == 20_000 and len(set(got[5].text.split())) == 1
    assert got[3].spans == "mail:2:8"
    assert P.pseudonymised(spark.createDataFrame([], SCHEMA), KEY).collect() == []
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    for r in P.pseudonymised(docs.select("doc_id", "text"), KEY).collect():
        spans = P.spans(before[r.doc_id], KEY)
        text, at = "", 0
        for a, b, _, new in spans:
            text, at = text + before[r.doc_id][at:a] + new, b
        assert r.text == text + before[r.doc_id][at:]
        for m in re.findall(r"[a-z]+\.[0-9]+@mail[0-9]\.example\.com", before[r.doc_id]):
            assert m not in r.text


def test_values_beside_other_numbers():
    number = "4111 1111 1111 1111"
    beside = [f"{number} 12/27", f"order 12 {number}", "4111111111111111 123", f"2024-01-05 {number}", f"1234 5678 {number} 12", f"+44 {number}", f"7 {number} 8 {number} 9"]
    for text in beside:
        held = [text[a:b] for a, b, kind, _ in P.spans(text, KEY) if kind == "card"]
        assert held == [number if " 1111" in text else number.replace(" ", "")] * text.count("4111"), text
    account = "ES91 2100 0418 4502 0005 1332"
    for text in (f"{account} EUR", f"AB12 {account}", f"{account} EURO 12 {account} DUE"):
        assert [text[a:b] for a, b, kind, _ in P.spans(text, KEY) if kind == "account"] == [account] * text.count("ES91"), text
    assert "date" in replaced(f"2024-01-05 {number}")
    text = "+1 212 555 1234 2024-01-05"
    assert [(kind, text[a:b]) for a, b, kind, _ in P.spans(text, KEY)] == [("phone", "+1 212 555 1234"), ("date", "2024-01-05")]


MAIL = P.FORMATS[0]
PIECES = ["a", "b.c", "@", "x@y.org", "@@", ".", "-", "1", " ", "é", "q@w", "z@1.2.co", "%+", "com"]


def test_mails_are_those_of_the_format():
    pick = random.Random(8)
    for _ in range(3000):
        text = "".join(pick.choice(PIECES) for _ in range(pick.randint(0, 14)))
        assert list(P.mails(MAIL, text)) == [m.span() for m in re.finditer(MAIL.regex, text)], text


def test_time_grows_with_the_text():
    for long in ("a" * 1_000_000, "0a" * 500_000, "a." * 500_000 + "@", "a@" * 300_000, "x" * 1_000_000 + "@mail.example.com"):
        start = time.perf_counter()
        found = P.spans(long, KEY)
        assert time.perf_counter() - start < 3
        assert [(kind, b - a) for a, b, kind, _ in found] == ([("mail", 81)] if long.endswith("com") else [])


def brute_mails(text):
    """Leftmost longest addresses by trying every stretch."""
    out, at = [], 0
    while at < len(text):
        end = next((e for e in range(len(text), at, -1) if re.fullmatch(MAIL.regex, text[at:e])), None)
        if end:
            out.append((at, end))
        at = end or at + 1
    return out


def test_found_against_every_stretch():
    pick = random.Random(12)
    for _ in range(400):
        text = "".join(pick.choice(PIECES) for _ in range(pick.randint(0, 8)))
        assert [(a, b) for a, b, kind, _ in P.spans(text, KEY) if kind == "mail"] == brute_mails(text), text
