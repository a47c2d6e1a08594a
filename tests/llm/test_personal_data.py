"""Personal data: every parser against its pattern, odd rows, SQL on the whole table."""

import hashlib
import random
import re
import time

import pytest

from moodmill.llm import personal_data
from tools.compare import compare, connect

#: The patterns of the kinds, written out once more.
PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
    r"(?:[Hh][Tt][Tt][Pp][Ss]?|[Ss]?[Ff][Tt][Pp]|[Ss][Ss][Hh])://[A-Za-z0-9._~%!$&'()*+,;=:-]+@[A-Za-z0-9.-]+(?::[0-9]+)?",
    r"(?<![A-Za-z0-9_])(?i:iban|account|acct|passport|ssn)(?:\x20?(?i:number|no|nr))?[.:#=]{0,2}\x20{0,2}"
    r"(?P<value>[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?|[0-9](?:-?[0-9])+)",
)


def luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(sum(divmod(v, 10)) for v in doubled) % 10 == 0


def valid(kind, match):
    value = match.group(0)
    digits = re.sub(r"[^0-9]", "", value)
    if kind == 1:
        return all(int(p) <= 255 for p in value.split("."))
    if kind == 2:
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == 3:
        return 8 <= len(digits) <= 15
    if kind == 5:
        value = match.group("value").replace(" ", "")
        if value[0].isdigit():
            return 6 <= len(re.sub(r"[^0-9]", "", value)) <= 20
        moved = value[4:] + value[:4]
        return 15 <= len(value) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1
    return True


def expected(text):
    spans = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            if valid(kind, m):
                spans.append((kind, m.start("value") if kind == 5 else m.start(), m.end()))
    return sorted(spans)


CASES = [
    "",
    "mail a.b+c@x-y.example.com, then x@y and @z.com or q@w..e",
    "a@b.c@d.e.f@g",
    "at 10.0.0.1 and 256.1.1.1, 1.2.3.4.5.6.7.8 and 001.002.003.0004, 1.2.3 4.5.6.7",
    "9" * 4000 + ".1.1.1 0000000000000000000000255.1.1.1",
    "card 4845168114407329 4845-1681-1440-7329, 4845  168114407329 and 7536784127813050 4845168114407329",
    "call +1 (017) 555-7713 or +49.30.1234567- or +1 2 or +123 or +1(2)3+4455667788",
    "https://user:pw@host.example:8080/x http://host/ sftp://me@h ftp://@h SSH://a@b:x 12https://u@v",
    "IBAN: DE89 3704 0044 0532 0130 00 and iban DE89370400440532013000. Account no. 12-345-678, acct #12345",
    "account NO93 8601 1117 947 passport number:  1234567 xssn 1234567 ssn=123-45-6789 account north 7",
    "İIBAN GB82WEST12345698765432 é iban: GB82 WEST 1234 5698 7654 33",
    "٣٤٥ 10.0.0.١ ４８４５１６８１１４４０７３２９ x＠y.z",
]


@pytest.mark.parametrize("text", CASES)
def test_parsers_find_what_the_patterns_say(text):
    assert personal_data.find(text, personal_data.automaton()) == expected(text)


def test_parsers_on_random_strings():
    rng = random.Random(5)
    anchors = personal_data.automaton()
    pieces = ["@", "+", ".", "-", " ", "(", ")", ":", "#", "é", "\n", "a", "b", "no", "0", "25", "4845168114407329",
              "192.168.0.1", "iban", "ACCT", "DE89370400440532013000", "https://", "sftp://", "u:p@h", "x.y", "12345678"]
    for _ in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14)))
        assert personal_data.find(text, anchors) == expected(text), text


def test_time_is_linear_in_the_text():
    anchors = personal_data.automaton()

    def seconds(n):
        texts = ["a@" * n, "1." * n, "1 " * n, "+1 " * n, "a" * n + "@", "+1" + "(" * n, "http://" * (n // 7), "iban " * (n // 5)]
        started = time.perf_counter()
        for text in texts:
            personal_data.find(text, anchors)
        return time.perf_counter() - started

    seconds(20_000)
    assert seconds(400_000) < 60 * seconds(20_000) + 0.5


def test_odd_rows(spark, odd, odd_rows):
    def listed(spans):
        return ",".join(f"{personal_data.KINDS[k]}:{a}:{b}" for k, a, b in spans)

    wanted = []
    for row in odd_rows:
        spans = expected(row[1])
        base = [s for s in spans if s[0] < 4]
        counts = [sum(s[0] == k for s in base) for k in range(4)]
        wanted.append((row[0], *counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
    key = lambda r: (r[0] is None, r)
    got = [tuple(r) for r in personal_data.report(odd).collect()]
    assert sorted(got, key=lambda r: str(key(r))) == sorted(wanted, key=lambda r: str(key(r)))


def test_cases_as_rows_and_an_empty_table(spark, empty):
    rows = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in personal_data.scan(rows).collect()}
    assert got == {i: expected(t) for i, t in enumerate(CASES)}
    assert personal_data.report(empty).collect() == []


def test_query_matches_sql(spark, small):
    verdict, _, _ = compare(connect(small), spark, small, "op11_personal_data")
    assert verdict.startswith("ok"), verdict
