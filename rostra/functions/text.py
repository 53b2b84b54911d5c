"""Text forms and counts as column expressions; all stay in code generation.

The forms differ in observable ways (case, white space, what is cut first), so each is its own function.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that carry no meaning for retrieval, and the letters of a word in the second word count.
RETRIEVAL_STOPWORDS = "si sau in la cu de din pe ca este sunt fi fost va vot rog domnul doamna stima colegi sedinta plen".split()
LETTERS_RO = "a-zA-ZăâîșțĂÂÎȘȚ"
SUFFIXES = "ului ilor elor ile ele lor le ul ii".split()


def _accents() -> tuple[str, str]:
    """Letters of the Latin blocks whose compatibility form is one plain character and marks, and those characters."""
    pairs = []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(plain) == 1 and plain != chr(code):
            pairs.append((chr(code), plain))
    marks = "".join(map(chr, range(0x300, 0x370)))
    return "".join(a for a, _ in pairs) + marks, "".join(b for _, b in pairs)


_FROM, _TO = _accents()


def _marks() -> tuple[str, str, str]:
    """Letters whose canonical form is one of A-Z or a-z and marks, those letters, and a class of the marks of all scripts.

    The marks are listed, as the Unicode of the JVM may be older.
    """
    pairs, ranges = [], []
    for code in range(0x80, sys.maxunicode + 1):
        c = chr(code)
        if unicodedata.category(c)[0] == "M":
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
        elif (bare := unicodedata.normalize("NFD", c)[0]) != c and bare.isascii() and bare.isalpha():
            pairs.append((c, bare))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs), "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in ranges) + "]+"


_MARKED, _BARE, _ANY_MARKS = _marks()


def plain(c: Column) -> Column:
    """Without the accents of Latin letters; combining marks go."""
    return F.translate(c, _FROM, _TO)


def unmarked(c: Column) -> Column:
    """Without the marks of any script; unlike plain, letters that are only compatible with plain ones stay. Null stays null."""
    return F.regexp_replace(F.translate(c, _MARKED, _BARE), _ANY_MARKS, "")


def casefold(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def squeezed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def speaker_key(c: Column) -> Column:
    """Without a role after a dash, a form of address before, and what is in brackets."""
    c = F.regexp_replace(or_empty(c), r"(?U)\s+-\s+.*$", "")
    c = F.regexp_replace(c, r"(?iU)^\s*(domnul|doamna)\s+", "")
    return casefold(plain(squeezed(F.regexp_replace(c, r"\([^)]*\)", ""))))


def analysis_text(c: Column) -> Column:
    """N2, and N8."""
    return squeezed(casefold(plain(or_empty(c))))


def export_text(c: Column) -> Column:
    """Lower case only, so sharp s stays."""
    return squeezed(F.lower(plain(or_empty(c))))


def rules_key(c: Column) -> Column:
    """White space inside stays."""
    return stripped(plain(casefold(or_empty(c))))


def agent_key(c: Column) -> Column:
    """N5."""
    return squeezed(plain(casefold(or_empty(c))))


def topic_words(c: Column) -> Column:
    """What isn't a letter, digit, blank, slash, dot or dash is a blank."""
    return squeezed(F.regexp_replace(plain(casefold(or_empty(c))), r"[^a-z0-9\s/.-]", " "))


def overlap_text(c: Column) -> Column:
    """Lower, white space at the ends goes."""
    return stripped(plain(F.lower(or_empty(c))))


def qa_text(c: Column) -> Column:
    """White space stays as it is."""
    return plain(casefold(or_empty(c)))


def evaluation_topic(c: Column) -> Column:
    """N10 for topics: runs of other characters are one blank."""
    return squeezed(F.regexp_replace(rules_key(c), r"[^a-z0-9]+", " "))


def slug(c: Column) -> Column:
    """N11."""
    s = F.regexp_replace(F.regexp_replace(F.lower(plain(or_empty(c))), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
    return F.when(s == "", "unknown").otherwise(s)


def token_key(c: Column) -> Column:
    """The words of a normalised name, sorted."""
    words = F.filter(F.split(F.regexp_replace(c, r"[^a-z0-9]+", " "), " "), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def law_form(c: Column) -> Column:
    """N13."""
    c = F.regexp_replace(squeezed(or_empty(c)), "[–—]", "-")
    return squeezed(F.regexp_replace(F.regexp_replace(c, r"(?i)PL\s*-\s*x", "PL-x"), r"\s*/\s*", "/"))


def fold_any(texts: pd.Series) -> pd.Series:
    """N2 for any script, for use as a pandas UDF where texts aren't Latin."""
    return texts.map(lambda t: " ".join("".join(c for c in unicodedata.normalize("NFKD", t or "") if not unicodedata.combining(c)).casefold().split()))


def tokens(c: Column, least: int, without: Iterable[str] = ()) -> Column:
    """Runs of a-z and 0-9, of `least` characters or more, that aren't in `without`."""
    words = F.regexp_extract_all(c, F.lit(r"([a-z0-9]+)"), F.lit(1))
    stop = [*without]
    return F.filter(words, lambda w: (F.length(w) >= least) & ~w.isin(stop) if stop else F.length(w) >= least)


def retrieval_tokens(c: Column, stopwords: Iterable[str] = RETRIEVAL_STOPWORDS) -> Column:
    """with repeats."""
    return tokens(analysis_text(c), 3, stopwords)


def overlap_tokens(c: Column, stopwords: Iterable[str] = ()) -> Column:
    """a set."""
    return F.array_distinct(tokens(overlap_text(c), 4, stopwords))


def mapped_tokens(c: Column, equivalents: dict[str, str], stopwords: Iterable[str]) -> Column:
    """tokens replaced by their equivalents first; length and stopwords are judged after."""
    words, stop = F.regexp_extract_all(export_text(c), F.lit(r"([a-z0-9]+)"), F.lit(1)), [*stopwords]
    if equivalents:
        table = F.create_map(*[F.lit(x) for pair in equivalents.items() for x in pair])
        words = F.transform(words, lambda w: F.coalesce(F.try_element_at(table, w), w))
    return F.filter(words, lambda w: (F.length(w) >= 3) & ~w.isin(stop) if stop else F.length(w) >= 3)


def word_count(c: Column) -> Column:
    """runs of letters and digits, joined by single apostrophes or dashes."""
    return F.regexp_count(or_empty(c), F.lit(r"[\p{L}\p{N}]+(?:['-][\p{L}\p{N}]+)*"))


def letter_count(c: Column) -> Column:
    """F7."""
    return F.regexp_count(or_empty(c), F.lit(r"[\p{L}\p{Nl}\p{No}]"))


def plain_words(c: Column) -> Column:
    return F.regexp_extract_all(or_empty(c), F.lit(f"([{LETTERS_RO}]+)"), F.lit(1))


def plain_word_count(c: Column) -> Column:
    """F8."""
    return F.regexp_count(or_empty(c), F.lit(f"[{LETTERS_RO}]+"))


def sentence_count(c: Column) -> Column:
    """F9."""
    return F.size(F.filter(F.split(or_empty(c), r"[.!?]+"), lambda s: stripped(s) != ""))


def variants(token: Column) -> Column:
    """a token, and what is left without each of the suffixes it has, of 3 letters at least."""
    cut = [F.when(token.endswith(s) & (F.length(token) - len(s) >= 3), F.substring(token, F.lit(1), F.length(token) - len(s))) for s in SUFFIXES]
    return F.array_distinct(F.array_compact(F.array(token, *cut)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hits(c: Column, words: Iterable[str]) -> Column:
    """How many of the words occur anywhere in the text."""
    words = [*words]
    return F.size(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(c, w))) if words else F.lit(0)


def holds_any(c: Column, words: Iterable[str]) -> Column:
    return hits(c, words) > 0


def capped(c: Column, most: int) -> Column:
    """The first characters and an ellipsis."""
    return F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most)), F.lit("…"))).otherwise(c)


def merged_text(*parts: Column) -> Column:
    """The parts that aren't blank, trimmed, joined by a blank."""
    return F.array_join(F.filter(F.array(*[stripped(or_empty(p)) for p in parts]), lambda x: x != ""), " ")


def cleaned_topic(c: Column) -> Column:
    """without bullets and numbers in front."""
    c = F.regexp_replace(stripped(or_empty(c)), r"^[-*\d.)(\[\]]+\s*", "")
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), r"^[ ,;:.]+|[ ,;:.]+$", "")


def noise_topic(c: Column, generic: Iterable[str] = ()) -> Column:
    key = topic_words(c)
    return (key == "") | (key.isin([*generic]) if [*generic] else F.lit(False)) | ~c.rlike("[a-zA-ZĂÂÎȘȚăâîșț]")


def quote_grounded(quote: Column, speech: Column, form=agent_key, least_words: int | None = None) -> Column:
    """the quote's form lies in the speech's, and is 24 characters long, or of `least_words` words."""
    q = form(F.regexp_replace(stripped(or_empty(quote)), '^["“”]+|["“”]+$', ""))
    enough = F.length(q) >= 24
    if least_words is not None:
        enough = enough | (plain_word_count(q) >= least_words)
    return (q != "") & enough & F.contains(form(speech), q)


def fallback_quote(c: Column) -> Column:
    """the first 16 words, at most 160 characters, of a speech of 6 words or more."""
    words = plain_words(agent_key(c))
    return F.when(F.size(words) < 6, "").otherwise(F.trim(F.left(F.array_join(F.slice(words, 1, 16), " "), F.lit(160))))


def estimated_tokens(c: Column) -> Column:
    """D20."""
    return F.greatest(F.lit(1), F.round(F.length(c) / F.lit(3.8))).cast("long")


def clamped(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def safe_name(c: Column) -> Column:
    """characters other than letters, digits, dot, dash and underscore are a dash."""
    return F.regexp_replace(c, r"[^A-Za-z0-9._-]+", "-")
