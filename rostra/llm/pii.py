"""Format-preserving Feistel pseudonyms for personal data, in SQL functions only.

Each recognised value is validated, then permuted under a key among the valid values of its format. A
permutation has no collisions, and equal values get equal pseudonyms in every document.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostra.llm.common import fresh

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"

#: Characters of an IBAN, by country (SWIFT registry).
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB LK NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban(length: int, countries: str) -> str:
    """IBANs of a length, in groups of four or without spaces."""
    fours, rest = divmod(length - 4, 4)
    return rf"(?:{countries.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{fours}}}" + (rf" ?[A-Z0-9]{{{rest}}}" if rest else "")


# Runs of four digits, that may hold several cards; then the other usual groups; then any grouping that does not run into one of them.
_FOURS = r"\d{4}(?:[ -]\d{4}){3,12}(?:[ -]\d{1,3}(?![ .-]\d{3}[ .-]\d{4}))?"
_SHAPES = rf"{_FOURS}|\d{{4}}[ -]\d{{6}}[ -]\d{{4,5}}|\d{{13,19}}"
_CARD_END = r"(?!\w|[.-]\d)"

#: Country codes of one and of two digits; all others have three.
_SHORT_CODES = {1: "7", 2: "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98"}

#: What is looked at, in the order in which alternatives are tried; each is validated before it is replaced.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?\.[A-Za-z]{2,}",
    "iban": rf"(?<![A-Za-z0-9])(?:(?:{'|'.join(_iban(*x) for x in _IBAN_LENGTHS.items())})(?![A-Za-z0-9])|[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?)(?![A-Za-z0-9])",
    "date": r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\w/-]|\.\d)",
    "phone": r"(?<![\w.(+-])(?:\+?1[ .-])?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])",
    "abroad": r"(?<![\w.(+-])(?:\+[2-9]\d{0,2}(?:[ .-]?\d){6,13}|0[1-9](?:[ .-]\d{2}){4}|0[1-9]\d{1,3}[/ -]\d{5,9}|[6-9]\d{2}[ -]\d{3}[ -]\d{3})(?!\w|[.-]\d)",
    "ssn": r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)",
    "card": rf"(?<![\w.])(?:(?:{_SHAPES}){_CARD_END}|\d(?:(?:[ -](?!(?:{_SHAPES}){_CARD_END}))?\d){{12,18}}){_CARD_END}",
}
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())

# x is the matched value and k the key in all expressions below.
_DIGITS = "regexp_replace(x, '[^0-9]', '')"


def _prf(of: str, below: str) -> str:
    """A number below `below` that the key and `of` decide."""
    return f"pmod(cast(conv(substr(sha2(concat_ws('|', k, {of}), 256), 1, 15), 16, 10) as bigint), {below})"


def _permuted(left: str, right: str, a: str, b: str, tweak: str, back: str, rounds: int = 10) -> str:
    """Feistel rounds on a pair of numbers below a and b, by turns; `back` makes the result of s.l and s.r."""
    return f"""aggregate(sequence(1, {rounds}), named_struct('l', cast({left} as bigint), 'r', cast({right} as bigint)), (s, i) ->
      if(i % 2 = 1, named_struct('l', pmod(s.l + {_prf(f"{tweak}, i, s.r, {a}", a)}, {a}), 'r', s.r),
                    named_struct('l', s.l, 'r', pmod(s.r + {_prf(f"{tweak}, i, s.l, {b}", b)}, {b}))), s -> {back})"""


def _let(name: str, value: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _digit_string(d: str, tweak: str) -> str:
    """Another string of as many digits (2 to 36) for the string d."""
    u, v = f"(length({d}) div 2)", f"(length({d}) - length({d}) div 2)"
    tens = lambda n: f"cast(pow(10, {n}) as bigint)"
    return _permuted(f"substr({d}, 1, {u})", f"substr({d}, {u} + 1)", tens(u), tens(v), tweak, f"concat(lpad(cast(s.l as string), {u}, '0'), lpad(cast(s.r as string), {v}, '0'))")


def _refill(text: str, digits: str, upto: str = "1") -> str:
    """text with its digits from position `upto` on replaced, in turn, by those of `digits`."""
    return f"""array_join(transform(sequence(1, length({text})), i -> if(i >= {upto} and substr({text}, i, 1) rlike '[0-9]',
      substr({digits}, length(regexp_replace(substr({text}, {upto}, i - {upto} + 1), '[^0-9]', '')), 1), substr({text}, i, 1))), '')"""


def _luhn(d: str, doubled: int) -> str:
    """The Luhn sum of d, modulo 10; `doubled` is the parity, from the right, of the doubled digits."""
    return f"""aggregate(transform(sequence(1, length({d})), i -> cast(substr({d}, length({d}) + 1 - i, 1) as int) * if(i % 2 = {doubled}, 2, 1)),
      0, (t, y) -> t + if(y > 9, y - 9, y)) % 10"""


def _mod97(s: str) -> str:
    """The characters of s as one number, letters as 10 to 35, modulo 97."""
    return f"aggregate(transform(sequence(1, length({s})), i -> substr({s}, i, 1)), 0, (t, c) -> if(c rlike '[0-9]', (t * 10 + cast(c as int)) % 97, (t * 100 + ascii(c) - 55) % 97))"


def _shifted(half: str, other: str, tweak: str) -> str:
    """half with each letter and digit moved within its alphabet by what the key and `other` decide."""
    move = f"cast(conv(substr(sha2(concat_ws('|', k, '{tweak}', r, length({half}), {other}, (i - 1) div 16), 256), ((i - 1) % 16) * 4 + 1, 4), 16, 10) as int)"
    turn = lambda base, n: f"chr({base} + (ascii(substr({half}, i, 1)) - {base} + {move}) % {n})"
    return f"""array_join(transform(sequence(1, length({half})), i -> case when substr({half}, i, 1) rlike '[0-9]' then {turn(48, 10)}
      when substr({half}, i, 1) rlike '[a-z]' then {turn(97, 26)} when substr({half}, i, 1) rlike '[A-Z]' then {turn(65, 26)} else substr({half}, i, 1) end), '')"""


def _name(x: str) -> str:
    """Another name of the same shape; in one of a single character that moves alone."""
    start = f"named_struct('l', substr({x}, 1, length({x}) div 2), 'r', substr({x}, length({x}) div 2 + 1))"
    left = f"if(s.l = '', '', {_shifted('s.l', 's.r', 'name')})"
    return f"""aggregate(sequence(1, 6), {start}, (s, r) -> if(r % 2 = 0, named_struct('l', {left}, 'r', s.r), named_struct('l', s.l, 'r', {_shifted('s.r', 's.l', 'name')})), s -> concat(s.l, s.r))"""


def _replacements() -> dict[str, str]:
    """For each kind the pseudonym of x, or null where x is not valid."""
    card = _let("d", _DIGITS, f"if({_luhn('d', 0)} = 0, {_let('p', _digit_string('substr(d, 1, length(d) - 1)', "'card'"), _let('n', f'concat(p, cast((10 - {_luhn('p', 1)}) % 10 as string))', _refill('x', 'n')))}, null)")
    bban = "substr(v, 5)"
    iban = _let(
        "v", "replace(x, ' ', '')",
        f"if(length(v) between 15 and 34 and {_mod97(f'concat({bban}, substr(v, 1, 4))')} = 1 and length(regexp_replace({bban}, '[^0-9]', '')) >= 2, "
        + _let("n", _let("d", f"regexp_replace({bban}, '[^0-9]', '')", _let("p", _digit_string("d", "'iban'"), _refill(bban, "p"))),
               _let("w", f"concat(substr(v, 1, 2), lpad(cast(98 - {_mod97("concat(n, substr(v, 1, 2), '00')")} as string), 2, '0'), n)",
                    "array_join(transform(sequence(1, length(x)), i -> if(substr(x, i, 1) = ' ', ' ', substr(w, length(replace(substr(x, 1, i), ' ', '')), 1))), '')"))
        + ", null)",
    )
    # 800 area codes and 800 exchanges from 200 on, 10000 lines: 80000 times 80000 numbers.
    phone = _let(
        "d", f"right({_DIGITS}, 10)",
        "if(substr(d, 1, 1) >= '2' and substr(d, 4, 1) >= '2', "
        + _let("v", "(cast(substr(d, 1, 3) as bigint) - 200) * 8000000 + (cast(substr(d, 4, 3) as bigint) - 200) * 10000 + cast(substr(d, 7) as bigint)",
               _let("w", _permuted("v div 80000", "v % 80000", "80000L", "80000L", "'phone'", "s.l * 80000 + s.r"),
                    _let("n", f"concat(if(length({_DIGITS}) > 10, '1', ''), cast(200 + w div 8000000 as string), cast(200 + (w div 10000) % 800 as string), lpad(cast(w % 10000 as string), 4, '0'))", _refill("x", "n"))))
        + ", null)",
    )
    # Areas 001-899 without 666, groups 01-99, serials 0001-9999.
    ssn = _let(
        "d", _DIGITS,
        "if(substr(d, 1, 3) not in ('000', '666') and d < '9' and substr(d, 4, 2) <> '00' and substr(d, 6) <> '0000', "
        + _let("a", "cast(substr(d, 1, 3) as bigint) - if(substr(d, 1, 3) > '666', 2, 1)",
               _let("w", _permuted("a * 99 + cast(substr(d, 4, 2) as bigint) - 1", "cast(substr(d, 6) as bigint) - 1", "88902L", "9999L", "'ssn'", "s.l * 10000 + s.r + 1"),
                    "concat(lpad(cast((w div 990000) + if(w div 990000 >= 665, 2, 1) as string), 3, '0'), '-', lpad(cast((w div 10000) % 99 + 1 as string), 2, '0'), '-', lpad(cast(w % 10000 as string), 4, '0'))"))
        + ", null)",
    )
    o = [f"cast(split(x, '[.]')[{i}] as bigint)" for i in range(4)]
    ip = _permuted(f"{o[0]} * 256 + {o[1]}", f"{o[2]} * 256 + {o[3]}", "65536L", "65536L", "'ip'", "concat_ws('.', s.l div 256, s.l % 256, s.r div 256, s.r % 256)")
    # Country code and first digit of the national number stay, which also decide, with the length, about the rest.
    # A national form counts as of the country that writes numbers so: pairs as in France, threes as in Spain, else Germany.
    code = "case " + " ".join(f"when substr(d, 1, {n}) in ({', '.join(repr(c) for c in codes.split())}) then {n}" for n, codes in _SHORT_CODES.items()) + " else 3 end"
    full = "case when x rlike '^[+]' then d when d not rlike '^0' then concat('34', d) when x rlike '^0[1-9]([ .-][0-9]{2}){4}$' then concat('33', substr(d, 2)) else concat('49', substr(d, 2)) end"
    inner = _let("c", code.replace("substr(d,", "substr(f,"), _let("t", "substr(f, 1, c + 1)", _let("p", _digit_string("substr(f, c + 2)", "'abroad', t"), _let("n", "concat(if(x rlike '^[+]', t, if(x rlike '^0', concat('0', right(t, 1)), right(t, 1))), p)", _refill("x", "n")))))
    abroad = _let("d", _DIGITS, _let("f", full, f"if(length(f) between 9 and 15, {inner}, null)"))
    # The 146097 days of the years 1800 to 2199 are 27 times 5411. With slashes the month comes first, unless it can't;
    # then days are walked until one comes that can't be a month either, so both readings are permuted apart.
    iso = """case when x rlike '^[0-9]{4}-' then x when x rlike '/' and substr(x, 1, 2) <= '12' then concat_ws('-', substr(x, 7), substr(x, 1, 2), substr(x, 4, 2))
      else concat_ws('-', substr(x, 7), substr(x, 4, 2), substr(x, 1, 2)) end"""
    moved = lambda v: _permuted(f"{v} div 5411", f"{v} % 5411", "27L", "5411L", "'date'", "s.l * 5411 + s.r")
    of = lambda v: f"date_add(date'1800-01-01', cast({v} as int))"
    walked = f"aggregate(sequence(1, 100), cast(v as bigint), (w, n) -> if(n > 1 and day({of('w')}) > 12, w, {moved('w')}))"
    date = _let(
        "y", f"try_cast({iso} as date)",
        "if(y is null or year(y) not between 1800 and 2199, null, "
        + _let("v", "cast(datediff(y, date'1800-01-01') as bigint)",
               f"case when x rlike '^[0-9]{{4}}-' then date_format({of(moved('v'))}, 'yyyy-MM-dd') when x rlike '[.]' then date_format({of(moved('v'))}, 'dd.MM.yyyy') "
               f"when substr(x, 1, 2) <= '12' then date_format({of(moved('v'))}, 'MM/dd/yyyy') else date_format({of(walked)}, 'dd/MM/yyyy') end")
        + ")",
    )
    email = f"concat({_name("substring_index(x, '@', 1)")}, '@', substring_index(x, '@', -1))"
    return {"email": email, "iban": iban, "date": date, "phone": phone, "abroad": abroad, "ssn": ssn, "ip": ip, "card": card}


#: Round a value while a text is cut; escaped where a text has them itself.
_MARK, _ESCAPE = "\x01", "\x02"


def _whole() -> dict[str, str]:
    """The patterns without their look at neighbours, for values that have been cut out."""
    return {k: re.sub(r"^\(\?<![^)]*\)|\(\?![^)]*\)$", "", p) for k, p in PATTERNS.items()}


def _inner() -> str:
    """x as an array of text and values by turns, a value first and last: x alone, or the valid parts of a run that is not valid.

    Parts begin and end where a run has a separator. From the left, the longest that is valid is taken.
    """
    digits = "regexp_replace(y, '[^0-9]', '')"
    card = f"y rlike '^[0-9]([ -]?[0-9]){{12,18}}$' and {_let('d', digits, _luhn('d', 0) + ' = 0')}"
    v = "replace(y, ' ', '')"
    iban = f"y rlike '^[A-Z]{{2}}[0-9]{{2}}' and length({v}) between 15 and 34 and {_let('v', v, _mod97('concat(substr(v, 5), substr(v, 1, 4))') + ' = 1')}"
    valid = lambda part: _let("y", part, f"if(x rlike '^[A-Z]', {iban}, {card})")
    at_end = "(i + n - 1 = length(x) or substr(x, i + n, 1) in (' ', '-'))"
    lengths = f"filter(sequence(least(length(x) - i + 1, 42), 1, -1), n -> n >= 13 and {at_end} and {valid('substr(x, i, n)')})"
    starts = "filter(sequence(1, length(x)), i -> i = 1 or substr(x, i - 1, 1) in (' ', '-'))"
    spans = f"""aggregate(transform({starts}, i -> named_struct('i', i, 'n', try_element_at({lengths}, 1))), named_struct('end', 1, 'out', array('')),
      (s, w) -> if(w.n is null or w.i < s.end, s, named_struct('end', w.i + w.n, 'out', concat(s.out, array(substr(x, s.end, w.i - s.end), substr(x, w.i, w.n))))),
      s -> concat(s.out, array(substr(x, s.end), '')))"""
    run = "(x rlike '^[A-Z]{2}[0-9]{2}[A-Z0-9 ]+$' or x rlike '^[0-9]([ -]?[0-9]){12,}$')"
    return f"if({run} and not (length(x) <= 42 and {valid('x')}), {spans}, array(x))"


def _sql(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def with_pseudonyms(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """docs with the personal data in a text column replaced, and n_replaced, their number.

    Recognised are e-mail addresses (the part before the @ moves letter by letter), IBANs (mod 97), calendar
    dates of 1800 to 2199 (with slashes: month first, or day first where only that gives a date), phone numbers
    of the North American plan, of other countries behind a + and as written in France, Spain and Germany, social
    security numbers, IPv4 addresses and card numbers (Luhn); values that fail their check stay. Of a run of
    numbers or capitals that fails as a whole, the valid parts between separators are replaced, the longest first
    from the left. Separators, length, classes of characters and check digits are kept. A null text stays null, an
    empty one empty; whole texts are read, at a cost in proportion to their length; repeated rows and ids don't
    matter; an empty table stays empty; other columns pass through, whatever their names; one called n_replaced is
    replaced. The key comes from a table of one row, so it is in no plan, and in no column of the result.
    """
    raw = F.col(f"`{column}`")
    runs, cut_up, secret, new_ones = (fresh(docs, x) for x in ("runs", "parts", "secret", "new"))
    plain = F.replace(F.replace(raw, F.lit(_ESCAPE), F.lit(_ESCAPE + "b")), F.lit(_MARK), F.lit(_ESCAPE + "a"))
    parts = F.when(raw.rlike("[0-9@]"), F.split(F.regexp_replace(plain, f"({_ANY})", f"{_MARK}$1{_MARK}"), _MARK)).otherwise(F.array(plain))
    cases = " ".join(f"when x rlike '^(?:{_sql(p)})$' then {_replacements()[kind]}" for kind, p in _whole().items())
    names = docs.columns
    held = docs.withColumn(runs, parts).withColumn(cut_up, F.expr(f"flatten(transform(`{runs}`, (x, at) -> if(at % 2 = 1, {_inner()}, array(x))))"))
    held = held.withColumn(secret, docs.sparkSession.createDataFrame([(key,)], "k string").scalar())
    new = F.expr(f"transform(`{cut_up}`, (x, at) -> if(at % 2 = 1, element_at(transform(array(`{secret}`), k -> case {cases} end), 1), null))")
    held = held.withColumn(new_ones, new)
    joined = F.expr(f"array_join(transform(`{cut_up}`, (x, at) -> coalesce(`{new_ones}`[at], x)), '')")
    back = F.replace(F.replace(joined, F.lit(_ESCAPE + "a"), F.lit(_MARK)), F.lit(_ESCAPE + "b"), F.lit(_ESCAPE))
    count = F.coalesce(F.expr(f"cast(size(filter(`{new_ones}`, y -> y is not null)) as bigint)"), F.lit(0))
    n = fresh(docs, "n_found")
    done = held.withColumn(n, F.when(raw.isNull(), F.lit(0).cast("long")).otherwise(count)).withColumn(column, F.when(raw.isNotNull(), back))
    return done.select(*[F.col(f"`{x}`") for x in names if x.lower() != "n_replaced"], F.col(n).alias("n_replaced"))
