"""Personal data under format-preserving pseudonyms.

Validated values (card numbers by check digit, bank accounts by remainder, dates by calendar,
addresses and phone numbers by form) are permuted inside the set of values of their format by
a keyed Feistel network over its numbers: equal values get equal pseudonyms in every document,
different values different ones, and a card number or date stays a valid one. Separators and
letter case stay. The permutation can be undone by who has the key (`permuted(..., undo=True)`).

Where a match fails its validation or touches another value, what it holds between the borders of its
groups is tried, longest first; of card numbers, those in the usual groups are tried before all others.
Numbers that fail their validation are not personal data and stay. Rows: a null text stays
null, an empty one empty; repeated rows are treated each; other columns pass through.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.llm.common import other_columns, schema_of, text_slices

ROUNDS = 10
LETTERS = "abcdefghijklmnopqrstuvwxyz"
DAY_FIRST, DAY_LAST = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def permuted(value: int, size: int, key: bytes, undo: bool = False) -> int:
    """A keyed permutation of 0 .. size - 1: a balanced Feistel network, walked until the value is in range."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for r in reversed(range(ROUNDS)) if undo else range(ROUNDS):
            if undo:
                left, right = right ^ turn(r, left, key, mask), left
            else:
                left, right = right, left ^ turn(r, right, key, mask)
        value = left << half | right
        if value < size:
            return value


def turn(number: int, half: int, key: bytes, mask: int) -> int:
    data = number.to_bytes(1, "big") + half.to_bytes((half.bit_length() + 7) // 8, "big")
    return int.from_bytes(hashlib.blake2b(data, key=key, digest_size=max(8, (mask.bit_length() + 7) // 8)).digest(), "big") & mask


def refilled(shape: str, digits: str) -> str:
    """shape with its digits replaced in order."""
    it = iter(digits)
    return re.sub(r"[0-9]", lambda _: next(it), shape)


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def shuffled_digits(digits: str, key: bytes, kind: str) -> str:
    return str(permuted(int(digits), 10 ** len(digits), key + kind.encode())).zfill(len(digits)) if digits else digits


def check_digit(digits: str) -> str:
    """The last digit that makes a card number valid."""
    doubled = sum(sum(divmod(2 * int(c), 10)) for c in digits[::-1][::2])
    return str(-(doubled + sum(int(c) for c in digits[::-1][1::2])) % 10)


def card(text: str, key: bytes) -> str | None:
    digits = digits_of(text)
    if not 13 <= len(digits) <= 19 or check_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    body = shuffled_digits(digits[:-1], key, f"card{len(digits)}")
    return refilled(text, body + check_digit(body))


def remainder(account: str) -> int:
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97


def account(text: str, key: bytes) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or remainder(plain) != 1:
        return None
    inner = refilled(plain[4:], shuffled_digits(digits_of(plain[4:]), key, f"account{len(plain)}"))
    check = str(98 - remainder(plain[:2] + "00" + inner)).zfill(2)
    new = iter(plain[:2] + check + inner)
    return "".join(c if c == " " else next(new) for c in text)


def insurance(text: str, key: bytes) -> str | None:
    area, group, serial = text.split("-")
    if area in ("000", "666") or area[0] == "9" or group == "00" or serial == "0000":
        return None
    # The areas 001 to 899 without 666, the groups and the serials.
    number = int(area) - 1 - (int(area) > 666)
    number = (number * 99 + int(group) - 1) * 9999 + int(serial) - 1
    number = permuted(number, 898 * 99 * 9999, key + b"insurance")
    number, serial = divmod(number, 9999)
    area, group = divmod(number, 99)
    area += 1 + (area >= 665)
    return f"{area:03}-{group + 1:02}-{serial + 1:04}"


def phone(text: str, key: bytes) -> str | None:
    """The country code stays."""
    code = re.match(r"\+[0-9]{1,3}(?=[ .(-])", text)
    start = code.end() if code else 0
    digits = digits_of(text[start:])
    if not 7 <= len(digits) <= 14:
        return None
    prefix = code[0] if code else ""
    return text[:start] + refilled(text[start:], shuffled_digits(digits, key, f"phone{len(digits)}{prefix}"))


def host(text: str, key: bytes) -> str | None:
    parts = [int(x) for x in text.split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
        return None
    number = permuted(int.from_bytes(bytes(parts), "big"), 1 << 32, key + b"host")
    return ".".join(str(x) for x in number.to_bytes(4, "big"))


def mail(text: str, key: bytes) -> str | None:
    """The name is permuted letter kind by letter kind; the domain stays but for its digits and its first label's letters."""
    name, domain = text.rsplit("@", 1)
    first, dot, rest = domain.partition(".")
    return f"{respelled(name, key, 'name')}@{respelled(first, key, 'label')}{dot}{rest}"


def respelled(text: str, key: bytes, kind: str) -> str:
    """ASCII letters and digits permuted as one number, every other character and the case in place."""
    places = [(i, 26 if c.isalpha() else 10) for i, c in enumerate(text) if c.isascii() and c.isalnum()]
    value, size = 0, 1
    for i, base in places:
        value = value * base + (LETTERS.index(text[i].lower()) if base == 26 else int(text[i]))
        size *= base
    out = list(text)
    shape = "".join("9" if c.isdigit() else "a" if c.isascii() and c.isalpha() else c for c in text)
    value = permuted(value, size, key + kind.encode() + hashlib.sha256(shape.encode()).digest()[:8]) if places else 0
    for i, base in reversed(places):
        value, digit = divmod(value, base)
        out[i] = str(digit) if base == 10 else LETTERS[digit].upper() if text[i].isupper() else LETTERS[digit]
    return "".join(out)


def dated(order: str) -> Callable[[str, bytes], str | None]:
    """For dates with four-digit years, in the order given; the separators stay."""

    def run(text: str, key: bytes) -> str | None:
        fields = re.findall("[0-9]+", text)
        marks = re.findall("[^0-9]+", text)
        values = dict(zip(order, map(int, fields), strict=True))
        try:
            day = datetime.date(values["y"], values["m"], values["d"]).toordinal()
        except ValueError:
            return None
        if not DAY_FIRST <= day <= DAY_LAST:
            return None
        new = datetime.date.fromordinal(DAY_FIRST + permuted(day - DAY_FIRST, DAY_LAST - DAY_FIRST + 1, key + b"date"))
        numbers = {"y": new.year, "m": new.month, "d": new.day}
        # Two digits wherever the original date had a leading zero or two digits.
        padded = any(len(f) == 2 and f[0] == "0" for f in fields) or order == "ymd"
        out = [f"{numbers[k]:02}" if padded and k != "y" else str(numbers[k]) for k in order]
        return out[0] + marks[0] + out[1] + marks[1] + out[2]

    return run


def slashed(text: str, key: bytes) -> str | None:
    """Day first where that is a date, else month first."""
    return dated("dmy")(text, key) or dated("mdy")(text, key)


class Format(NamedTuple):
    kind: str
    regex: str
    pseudonym: Callable[[str, bytes], str | None]
    # Whether a match can hold others: the number of its groups varies.
    parts: bool = False


# In the order in which they are tried at a place.
FORMATS = (
    Format("mail", r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", mail),
    Format("account", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", account, parts=True),
    Format("date", r"(?<![0-9./-])[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}(?![0-9/-]|\.[0-9])", dated("ymd")),
    Format("date", r"(?<![0-9./-])[0-9]{1,2}([-/.])[0-9]{1,2}\1[0-9]{4}(?![0-9/-]|\.[0-9])", slashed),
    Format("host", r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])", host),
    Format("insurance", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", insurance),
    Format("phone", r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])", phone, parts=True),
    Format("phone", r"(?<![0-9])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])", phone),
    Format("card", r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])", card, parts=True),
)
KINDS = tuple(dict.fromkeys(f.kind for f in FORMATS))
# The usual groups of a card's digits.
CARD_GROUPS = re.compile(r"[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{1,3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5}")


def parts(form: Format, text: str, used: bytearray) -> list[tuple[int, int]]:
    """Free stretches between group borders that the format matches, those to be tried first in front."""
    regex = re.compile(form.regex)
    out = []
    m = regex.search(text)
    while m:
        a, b = m.span()
        # Ends before a separator, where the match is not in the middle of a group.
        out += [
            (a, end)
            for end in range(b, a, -1)
            if (end == b or (text[end - 1].isalnum() and not text[end].isalnum()))
            and not any(used[a:end])
            and (end == b or regex.fullmatch(text, a, end))
        ]
        m = regex.search(text, a + 1)
    return sorted(out, key=lambda x: (form.kind == "card" and not CARD_GROUPS.fullmatch(text, *x), x[0] - x[1], x[0]))


def mails(form: Format, text: str) -> Iterator[tuple[int, int]]:
    """The format's matches from left to right, looked for around each at sign: a long run without one is passed over once."""
    before = 0
    domain = re.compile(form.regex.partition("@")[2])
    for run in re.finditer(r"[A-Za-z0-9._%+-]++", text):
        at = run.end()
        m = domain.match(text, at + 1) if text[at : at + 1] == "@" else None
        if m and max(run.start(), before) < at:
            yield max(run.start(), before, at - 64), m.end()
            before = m.end()


def spans(text: str, key: bytes) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) in code points; the first format that holds a place has it, whole matches before parts."""
    taken: list[tuple[int, int, str, str]] = []
    used = bytearray(len(text) + 1)

    def take(form: Format, a: int, b: int) -> bool:
        new = None if any(used[a:b]) else form.pseudonym(text[a:b], key)
        if new is not None:
            taken.append((a, b, form.kind, new))
            used[a:b] = b"\x01" * (b - a)
        return new is not None

    again = []
    for form in FORMATS:
        # A card's digits by themselves come before a longer number that is valid by chance.
        found = mails(form, text) if form.kind == "mail" else (m.span() for m in re.finditer(form.regex, text))
        left = [m for m in found if form.kind == "card" or not take(form, *m)]
        if left and form.parts:
            again.append(form)
    # Cards before phones: a part of a phone number's form may hold the beginning of a card.
    for form in sorted(again, key=lambda f: f.kind == "phone"):
        for a, b in parts(form, text, used):
            take(form, a, b)
    return sorted(taken)


def pseudonymised(docs: DataFrame, key: bytes) -> DataFrame:
    """docs with personal data in text replaced, with n_<kind> counts and `spans`, kind:start:end in the old text.

    These replace columns of docs that have their names.
    """
    counts = [f"n_{kind}" for kind in KINDS]
    rest = other_columns(docs, ["text", "spans", *counts])

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            columns = {c: [0] * len(texts) for c in counts} | {"spans": [""] * len(texts)}
            changed = {}
            for low, _, data, offsets in text_slices(texts):
                # Every format has a digit or an at sign.
                marks = np.flatnonzero(((data >= 48) & (data <= 57)) | (data == 64))
                for row in np.unique(np.searchsorted(offsets, marks, "right") - 1).tolist():
                    text = data[offsets[row] : offsets[row + 1]].tobytes().decode()
                    found = spans(text, key)
                    if not found:
                        continue
                    parts, at = [], 0
                    for a, b, kind, new in found:
                        parts += [text[at:a], new]
                        at = b
                        columns[f"n_{kind}"][low + row] += 1
                    changed[low + row] = "".join([*parts, text[at:]])
                    columns["spans"][low + row] = ",".join(f"{kind}:{a}:{b}" for a, b, kind, _ in found)
            if changed:
                mask = np.zeros(len(texts), bool)
                mask[list(changed)] = True
                texts = pa.compute.replace_with_mask(texts, pa.array(mask), pa.array([changed[i] for i in sorted(changed)], texts.type))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), texts.cast(pa.string()), *(pa.array(x) for x in columns.values())],
                names=[*rest, "text", *columns],
            )

    schema = schema_of(docs, rest).add("text", "string")
    for name in counts:
        schema.add(name, "long")
    schema.add("spans", "string")
    return docs.select(*rest, F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
