"""Personal data by anchor expansion: an automaton finds anchors, local parsers find the boundaries.

*Anchors.* One Aho-Corasick automaton reads a text once and stops at at-signs, plus-signs, digits,
schemes (``https://`` and others) and identifier cues (``iban``, ``account``, ...).

*Parsers.* An anchor is expanded to the left and right by a parser of its kind, character by character, and
then validated: addresses with dotted hosts, four numbers of at most 255, 16 to 19 digits that pass
Luhn, phone numbers of 8 to 15 digits. A parser never looks behind the end of its kind's last match, so
matches of a kind do not overlap, and every stretch is read a fixed number of times. A match that fails
is dropped and not tried again from a later start.

*Added kinds.* ``url`` is a scheme whose authority carries a user name; ``account`` is the number after a cue: an IBAN
that passes its check digits, or 6 to 20 digits. They never replace or move a base span.

Places are code points, the end exclusive. Nothing is shuffled and a text is never cut.

Defined results: a null text is an empty one; an empty text, or one without anchors, has no spans and the digest of
an empty string; a very long text is one text, read in time linear in its length; repeated rows and rows
that share a key (null included) are judged one by one, so ties cannot arise; an empty table gives an empty table;
other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base kinds and then the added ones, in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = 4
EMAIL, IP, CARD, PHONE, URL, ACCOUNT = range(len(KINDS))

DIGITS = frozenset("0123456789")
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
UPPER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
CAPITALS = UPPER | DIGITS
LOCAL = LETTERS | DIGITS | frozenset("._%+-")
LABEL = LETTERS | DIGITS | {"-"}
HOST = LABEL | {"."}
IN_PHONE = DIGITS | frozenset(" ().-")
USER = LETTERS | DIGITS | frozenset("._~%!$&'()*+,;=:-")
WORD = LETTERS | DIGITS | {"_"}

#: Schemes whose authority may carry a user, and words that announce an account number.
SCHEMES = ("http://", "https://", "ftp://", "ssh://")
CUES = ("iban", "account", "acct", "passport", "ssn")
AFTER_CUE = ("number", "no", "nr")

PART_LIMIT = 255
CARD_DIGITS = (16, 19)
PHONE_DIGITS = (8, 15)
ACCOUNT_DIGITS = (6, 20)
IBAN_LENGTH = (15, 34)

_AT, _PLUS, _DIGIT, _SCHEME, _CUE = range(5)


def automaton() -> ahocorasick.Automaton:
    """Every anchor with its kind and length."""
    found = ahocorasick.Automaton()
    anchors = [("@", _AT), ("+", _PLUS), *((d, _DIGIT) for d in DIGITS)]
    anchors += [*((s, _SCHEME) for s in SCHEMES), *((c, _CUE) for c in CUES)]
    for anchor, kind in anchors:
        found.add_word(anchor, (kind, len(anchor)))
    found.make_automaton()
    return found


def _run(text: str, at: int, allowed: frozenset[str]) -> int:
    """Where the characters of ``allowed`` that start at ``at`` end."""
    end = len(text)
    while at < end and text[at] in allowed:
        at += 1
    return at


def email(text: str, at: int, bound: int) -> tuple[int, int] | None:
    """The address around the at-sign at ``at``, not reaching before ``bound``."""
    start = at
    while start > bound and text[start - 1] in LOCAL:
        start -= 1
    stop = _run(text, at + 1, LABEL)
    if start == at or stop == at + 1:
        return None
    labels = 1
    while stop < len(text) and text[stop] == ".":
        after = _run(text, stop + 1, LABEL)
        if after == stop + 1:
            break
        stop, labels = after, labels + 1
    return (start, stop) if labels > 1 else None


def address(text: str, at: int) -> tuple[int, list[str]]:
    """Up to four dotted numbers from the digit at ``at``: where they end, and the numbers."""
    stop = _run(text, at, DIGITS)
    numbers = [text[at:stop]]
    while len(numbers) < 4 and stop < len(text) and text[stop] == ".":
        after = _run(text, stop + 1, DIGITS)
        if after == stop + 1:
            break
        numbers.append(text[stop + 1 : after])
        stop = after
    return stop, numbers


def is_part(number: str) -> bool:
    value = number.lstrip("0")
    return len(value) <= 3 and int(value or "0") <= PART_LIMIT


def grouped(text: str, at: int, separators: str) -> int:
    """Where the digits from ``at`` end, with at most one separator between two of them."""
    end = len(text)
    stop = at + 1
    while stop < end:
        if text[stop] in DIGITS:
            stop += 1
        elif text[stop] in separators and stop + 1 < end and text[stop + 1] in DIGITS:
            stop += 2
        else:
            break
    return stop


def only_digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def passes_luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def phone(text: str, at: int) -> tuple[int, int] | None:
    """The number after the plus-sign at ``at``; it ends with a digit."""
    if at + 1 >= len(text) or text[at + 1] not in DIGITS:
        return None
    stop = _run(text, at + 2, IN_PHONE)
    while stop > at + 3 and text[stop - 1] not in DIGITS:
        stop -= 1
    return (at, stop) if stop > at + 3 else None


def login(text: str, start: int, body: int) -> tuple[int, int] | None:
    """The authority from ``body`` on, if it names a user: ``scheme://user@host`` and a port."""
    at = _run(text, body, USER)
    if at == body or at >= len(text) or text[at] != "@":
        return None
    stop = _run(text, at + 1, HOST)
    if stop == at + 1:
        return None
    if stop + 1 < len(text) and text[stop] == ":" and text[stop + 1] in DIGITS:
        stop = _run(text, stop + 1, DIGITS)
    return start, stop


def iban(text: str, at: int) -> int:
    """Where an IBAN from ``at`` ends: two letters, two digits, groups of four and a rest; ``at`` if none."""

    def group(place: int, most: int) -> int:
        first = place + 1 if text[place : place + 1] == " " else place
        stop = first
        while stop < min(first + most, len(text)) and text[stop] in CAPITALS:
            stop += 1
        return stop if stop - first in ((most,) if most == 4 else range(1, most + 1)) else place

    head = text[at : at + 4]
    if len(head) < 4 or not (set(head[:2]) <= UPPER and set(head[2:]) <= DIGITS):
        return at
    stop, groups = at + 4, 0
    while groups < 7 and (after := group(stop, 4)) > stop:
        stop, groups = after, groups + 1
    return group(stop, 3) if groups >= 2 else at


def is_iban(value: str) -> bool:
    bare = value.replace(" ", "")
    if not IBAN_LENGTH[0] <= len(bare) <= IBAN_LENGTH[1]:
        return False
    return int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1


def account(text: str, folded: str, at: int) -> tuple[int, int, bool] | None:
    """The number after a cue that ends at ``at``: its place, and whether it is valid."""
    gap = at + 1 if text[at : at + 1] == " " else at
    for word in AFTER_CUE:
        if folded.startswith(word, gap):
            at = gap + len(word)
            break
    for marks in (".:#=", " "):
        for _ in range(2):
            if at < len(text) and text[at] in marks:
                at += 1
    stop = iban(text, at)
    if stop > at:
        return at, stop, is_iban(text[at:stop])
    if at < len(text) and text[at] in DIGITS:
        stop = grouped(text, at, "-")
        if stop > at + 1:
            n = stop - at - text.count("-", at, stop)
            return at, stop, ACCOUNT_DIGITS[0] <= n <= ACCOUNT_DIGITS[1]
    return None


def fold(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if c in UPPER else c for c in text)


def find(text: str, anchors: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """Sorted ``(kind, start, stop)`` of all personal data in a text."""
    spans: list[tuple[int, int, int]] = []
    #: Where the next match of each kind may start.
    bound = [0] * len(KINDS)
    folded = fold(text)
    for last, (kind, length) in anchors.iter(folded):
        at = last - length + 1
        if kind == _DIGIT:
            if at >= bound[IP]:
                stop, numbers = address(text, at)
                bound[IP] = stop
                if len(numbers) == 4 and all(map(is_part, numbers)):
                    spans.append((IP, at, stop))
            if at >= bound[CARD]:
                bound[CARD] = stop = grouped(text, at, " -")
                if stop - at >= CARD_DIGITS[0]:
                    digits = only_digits(text[at:stop])
                    if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and passes_luhn(digits):
                        spans.append((CARD, at, stop))
        elif kind == _AT:
            if found := email(text, at, bound[EMAIL]):
                bound[EMAIL] = found[1]
                spans.append((EMAIL, *found))
        elif kind == _PLUS:
            if found := phone(text, at):
                n = len(only_digits(text[at : found[1]]))
                if PHONE_DIGITS[0] <= n <= PHONE_DIGITS[1]:
                    spans.append((PHONE, *found))
        elif kind == _SCHEME:
            start = at - 1 if folded.startswith("ftp", at) and folded[at - 1 : at] == "s" else at
            if start >= bound[URL] and (found := login(text, start, last + 1)):
                bound[URL] = found[1]
                spans.append((URL, *found))
        elif at >= bound[ACCOUNT] and (at == 0 or text[at - 1] not in WORD):
            if (number := account(text, folded, last + 1)) is not None:
                start, bound[ACCOUNT], valid = number
                if valid:
                    spans.append((ACCOUNT, start, bound[ACCOUNT]))
    return sorted(spans)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``spans``, an array of ``(kind, start, stop)``, for every row."""
    narrow = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = narrow.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())])
        for batch in batches:
            found = (find(t.as_py() or "", anchors) for t in batch.column(1))
            rows = [[dict(zip(("kind", "start", "stop"), s, strict=True)) for s in spans] for spans in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(span))], ["k", "spans"])

    scanned = narrow.mapInArrow(run, f"k {kind}, spans array<struct<kind:int,start:int,stop:int>>")
    return scanned.withColumnRenamed("k", key)


def listed(spans: Column) -> Column:
    """``kind:start:stop`` of each span, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string")),
        ),
        ",",
    )


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: base spans counted by kind, their digest, and all spans."""

    def of_kind(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    base = F.filter("spans", lambda s: s["kind"] < BASE)
    return scan(docs, key, text).select(
        key,
        *(of_kind(kind) for kind in range(BASE)),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
