from __future__ import annotations

import datetime
import hashlib
import re

from rostra.llm import pii

TEXTS = [
    "card 4111 1111 1111 1111, again 4111-1111-1111-1111; not 4111 1111 1111 1112", "mail a.Person+1@Mail.example.org or x@b.co", "GB82 WEST 1234 5698 7654 32 and DE89370400440532013000. DE00370400440532013000",
    "on 2024-02-29, not 2023-02-29; 31.12.1999 12/25/2020", "+1 (489) 555-8583 or 489-555-8583; (102) 555-1234", "123-45-6789 000-12-1234", "at 97.60.249.90. but 1.2.3.4.5 and 300.1.1.1", "marks \x01 \x02a \x02b 4111111111111111", None, "", "none here",
]


def luhn(s: str) -> bool:
    d = [int(c) for c in reversed(re.sub(r"\D", "", s))]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def replaced(spark, texts, key="k"):
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, n_replaced int")
    return {r.doc_id: r for r in pii.with_pseudonyms(docs, key).collect()}


def test_values_keep_format_and_validity(spark):
    got = replaced(spark, TEXTS)
    assert [got[i].n_replaced for i in range(len(TEXTS))] == [2, 2, 2, 3, 2, 1, 1, 1, 0, 0, 0]
    assert got[8].text is None and got[9].text == "" and got[10].text == "none here"
    shape = lambda t: re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", re.sub(r"\d", "9", t)))
    for i in (0, 1, 2, 3, 4, 5, 7):
        assert shape(got[i].text) == shape(TEXTS[i]) and got[i].text != TEXTS[i]
    cards = re.findall(r"\d(?:[ -]?\d){15}", got[0].text)
    assert luhn(cards[0]) and re.sub(r"\D", "", cards[0]) == re.sub(r"\D", "", cards[1]) and cards[2] == "4111 1111 1111 1112"
    assert re.sub(r"\D", "", cards[0]) in got[7].text and got[7].text.startswith("marks \x01 \x02a \x02b ")
    for iban in (got[2].text[:27], got[2].text[32:54]):
        plain = iban.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    iso, _, dotted, slashed = re.findall(r"\d+[-./]\d+[-./]\d+", got[3].text)
    datetime.date.fromisoformat(iso), datetime.datetime.strptime(dotted, "%d.%m.%Y"), datetime.datetime.strptime(slashed, "%m/%d/%Y")
    assert "2023-02-29" in got[3].text and "(102) 555-1234" in got[4].text and "000-12-1234" in got[5].text
    assert re.match(r"at (\d{1,3}\.){3}\d{1,3}\. but 1\.2\.3\.4\.5 and 300\.1\.1\.1$", got[6].text)


def test_permutation(spark):
    days = [f"{datetime.date(1800, 1, 1) + datetime.timedelta(d)}" for d in range(0, 146097, 97)]
    got = replaced(spark, days)
    assert len({got[i].text for i in got}) == len(days)
    ssn = [f"{a:03d}-{g:02d}-0001" for a in (1, 665, 667, 899) for g in range(1, 100)]
    out = {r.text for r in replaced(spark, ssn).values()}
    assert len(out) == len(ssn) and not any(s.startswith(("000", "666", "9")) or "-00-" in s or s.endswith("0000") for s in out)


def test_key_decides(spark):
    a, b = replaced(spark, TEXTS[:1], "one"), replaced(spark, TEXTS[:1], "two")
    assert a[0].text != b[0].text and a[0].text == replaced(spark, TEXTS[:1], "one")[0].text


def test_no_python_in_the_plan(spark, capsys):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    pii.with_pseudonyms(docs, "k").explain()
    assert "Python" not in capsys.readouterr().out


def test_values_followed_by_numbers_and_capitals(spark):
    card, iban = "4111 1111 1111 1111", "AT61 1904 3002 3457 3201"
    rest = [f"{card} 12/27", "4111111111111111 123 x", f"12 34 {card} 12", f"{iban} EUR 50", "AT611904300234573201 BIC ABCD", "DE89 3704 0044 0532 0130 00 USD", f"{card} 5500 0000 0000 0004", f"1000 2000 {card}", f"{card} 489 555 8583", "1000 2000 3000 4001 5"]
    got = replaced(spark, rest)
    assert [got[i].n_replaced for i in range(len(rest))] == [1, 1, 1, 1, 1, 1, 2, 1, 2, 0]
    alone = replaced(spark, [card, iban, "DE89 3704 0044 0532 0130 00", "5500 0000 0000 0004"])
    card, iban, other, second = (alone[i].text for i in range(4))
    assert [got[i].text for i in range(8)] == [f"{card} 12/27", f"{card.replace(' ', '')} 123 x", f"12 34 {card} 12", f"{iban} EUR 50", f"{iban.replace(' ', '')} BIC ABCD", f"{other} USD", f"{card} {second}", f"1000 2000 {card}"]
    assert got[8].text.startswith(f"{card} ") and not got[8].text.endswith("489 555 8583") and got[9].text == rest[9]


def test_the_key_stays_secret(spark, capsys):
    docs = spark.createDataFrame([(1, TEXTS[0], "a", "b", "c", "d", "e", "f")], "doc_id long, text string, _key string, _parts string, _new string, secret string, parts string, n_found string")
    got = pii.with_pseudonyms(docs, "TOPSECRET")
    assert got.columns == [*docs.columns, "n_replaced"]
    row = got.first()
    assert row[2:8] == ("a", "b", "c", "d", "e", "f") and "TOPSECRET" not in str(row) and row.n_replaced == 2
    got.explain(True)
    assert "TOPSECRET" not in capsys.readouterr().out
    assert "TOPSECRET" not in got._jdf.queryExecution().toString()
    assert pii.with_pseudonyms(docs.limit(0), "TOPSECRET").count() == 0


def plain_pair(left: int, right: int, a: int, b: int, tweak: str, key: str) -> tuple[int, int]:
    """A Feistel network on two numbers below a and b, written out."""
    prf = lambda i, half, below: int(hashlib.sha256(f"{key}|{tweak}|{i}|{half}|{below}".encode()).hexdigest()[:15], 16) % below
    for i in range(1, 11):
        if i % 2:
            left = (left + prf(i, right, a)) % a
        else:
            right = (right + prf(i, left, b)) % b
    return left, right


def plain_digits(d: str, tweak: str, key: str) -> str:
    u = len(d) // 2
    v = len(d) - u
    left, right = plain_pair(int(d[:u]), int(d[u:]), 10**u, 10**v, tweak, key)
    return f"{left:0{u}d}{right:0{v}d}"


def test_against_a_plain_feistel_network(spark):
    key = "some key"
    first, days = datetime.date(1800, 1, 1), lambda d: (d - datetime.date(1800, 1, 1)).days
    moved = lambda n: (lambda p: p[0] * 5411 + p[1])(plain_pair(n // 5411, n % 5411, 27, 5411, "date", key))
    day = lambda n: first + datetime.timedelta(n)
    card = plain_digits("411111111111111", "card", key)
    check = next(c for c in "0123456789" if luhn(card + c))
    walk = moved(days(datetime.date(2020, 5, 25)))
    while day(walk).day <= 12:
        walk = moved(walk)
    v = 289 * 8000000 + 355 * 10000 + 8583
    left, right = plain_pair(v // 80000, v % 80000, 80000, 80000, "phone", key)
    w = left * 80000 + right
    a, b = plain_pair(97 * 256 + 60, 249 * 256 + 90, 65536, 65536, "ip", key)
    s1, s2 = plain_pair(122 * 99 + 44, 6788, 88902, 9999, "ssn", key)
    area = s1 // 99 + 1
    paris, berlin = plain_digits("23456789", "abroad|331", key), plain_digits("0123456", "abroad|493", key)
    madrid = plain_digits("12345678", "abroad|346", key)
    want = {
        "4111111111111111": card + check,
        "2020-05-25": day(moved(days(datetime.date(2020, 5, 25)))).isoformat(),
        "25.05.2020": day(moved(days(datetime.date(2020, 5, 25)))).strftime("%d.%m.%Y"),
        "05/25/2020": day(moved(days(datetime.date(2020, 5, 25)))).strftime("%m/%d/%Y"),
        "25/05/2020": day(walk).strftime("%d/%m/%Y"),
        "489 555-8583": f"{200 + w // 8000000} {200 + w // 10000 % 800}-{w % 10000:04d}",
        "97.60.249.90": f"{a // 256}.{a % 256}.{b // 256}.{b % 256}",
        "123-45-6789": f"{area + (area >= 666):03d}-{s1 % 99 + 1:02d}-{s2 + 1:04d}",
        "+33 1 23 45 67 89": f"+33 1 {paris[:2]} {paris[2:4]} {paris[4:6]} {paris[6:]}",
        "01.23.45.67.89": f"01.{paris[:2]}.{paris[2:4]}.{paris[4:6]}.{paris[6:]}",
        "+49 30 123456": f"+49 3{berlin[0]} {berlin[1:]}",
        "030/123456": f"03{berlin[0]}/{berlin[1:]}",
        "612 345 678": f"6{madrid[:2]} {madrid[2:5]} {madrid[5:]}",
        "+34612345678": f"+346{madrid}",
    }
    got = replaced(spark, list(want), key)
    assert {x: got[i].text for i, x in enumerate(want)} == want


def test_days_first_and_months_first_do_not_meet(spark):
    every = [f"{d:02d}/{m:02d}/{y}" for y in (1999, 2004) for m in range(1, 13) for d in range(1, 29)]
    got = replaced(spark, every)
    assert len({got[i].text for i in got}) == len(every)
    assert all((x[:2] > "12") == (got[i].text[:2] > "12") for i, x in enumerate(every))


def test_long_texts_and_repeated_values(spark):
    text = "call +33 1 23 45 67 89 or 4111111111111111 now. " * 4000
    got = replaced(spark, [text, text])
    assert got[0].n_replaced == 8000 and got[0].text == got[1].text and len(set(got[0].text.split(". "))) == 2
