"""References to laws, agenda items and legislative work in speeches, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rostra.functions.text import export_text, law_form, let, or_empty, squeezed

# Families of references and what marks them, in the order in which they are tried.
BASELINE_FAMILIES = [
    (r"\bpl[-\s]?x\s*(?:nr\.?\s*)?(\d+/\d{4})\b", "plx"), (r"\blegea?\s+nr\.?\s*(\d+/\d{4})\b", "legea"), (r"\boug\s+nr\.?\s*(\d+/\d{4})\b", "oug"),
    (r"\bog\s+nr\.?\s*(\d+/\d{4})\b", "og"), (r"\bhg\s+nr\.?\s*(\d+/\d{4})\b", "hg"), (r"\bordonanta(?:\s+de\s+urgenta)?\s+nr\.?\s*(\d+/\d{4})\b", "ordonanta"),
]
TOPIC_FAMILIES = [
    (r"\bpl[-\s]?x\s*(\d+/\d{4})\b", "PL-x"), (r"\boug\s*(\d+/\d{4})\b", "OUG"), (r"\bog\s*(\d+/\d{4})\b", "OG"), (r"\bhg\s*(\d+/\d{4})\b", "HG"),
    (r"\blegea?\s*nr\.?\s*(\d+/\d{4})\b", "Legea nr."), (r"\blegea?\s*(\d+/\d{4})\b", "Legea"), (r"\bphcd\s*(\d+/\d{4})\b", "PHCD"),
]
NUMBER_FAMILIES = [
    (r"\bpl[-\s]?x\s*(\d{1,4}(?:/\d{4})?)\b", "PL-x"), (r"\boug\s*(\d{1,4}(?:/\d{4})?)\b", "OUG"), (r"\bog\s*(\d{1,4}(?:/\d{4})?)\b", "OG"), (r"\bhg\s*(\d{1,4}(?:/\d{4})?)\b", "HG"),
    (r"\blegea?\s*nr\.?\s*(\d{1,4}(?:/\d{4})?)\b", "Legea nr."),
]
INDEX_FAMILIES = [
    (r"(?i)\bPL[\s\-–—]*x[\s\-–—]*(\d{1,4}/\d{4})\b", "PL-x"), (r"(?i)\bLegea\s+nr\.?\s*(\d{1,4}/\d{4})\b", "Legea nr."), (r"(?i)\bOUG\s+nr\.?\s*(\d{1,4}/\d{4})\b", "OUG nr."),
    (r"(?i)\bHG\s+nr\.?\s*(\d{1,4}/\d{4})\b", "HG nr."), (r"(?i)\bDirectiva\s+(?:UE|CE|UE/CE)?\s*([0-9]{2,4}/[A-Z]{2,4}|\d{1,4}/\d{4})\b", "Directiva UE"),
    (r"(?i)\bRegulamentul\s+(?:UE|CE|UE/CE)?(?:\s*\(UE\))?\s*(\d{1,4}/\d{4})\b", "Regulamentul UE"),
]
GENERIC_NUMBER = r"(?i)\bnr\.?\s*(\d{1,4}/\d{4})\b"
LEGISLATIVE_CONTEXT = r"(?iu)\b(lege|proiect(?:ul)?\s+de\s+lege|ordonan(?:t|ț)a|oug|hot[aă]r[aâ]re(?:a)?\s+de\s+guvern|amendament|art\.?)\b"
LAW_TOPIC_PREFIXES = ["plx ", "legea ", "oug ", "og ", "hg ", "ordonanta "]
AUTHORSHIP = r"\b(?:am initiat|am depus|am semnat|sunt(?:em)?\s+(?:co)?initiator(?:ii|i)?|(?:co)?initiator(?:ii|i)?\s+sunt(?:em)?|initiativa\s+(?:mea|noastra)|propunerea\s+(?:mea|noastra)\s+legislativa|proiectul\s+(?:meu|nostru)\s+de\s+lege)\b"
AMENDING = r"\b(?:am (?:depus|propus)\s+amendament(?:e)?|am (?:introdus|formulat)\s+amendament|amendamentul\s+(?:meu|nostru)\b|amendamentele\s+(?:mele|noastre)\b)"
BILL_WORDS = r"\b(proiect(?:ul)?\s+de\s+lege|propunere(?:a)?\s+legislativa)\b"
AMENDMENT_NUMBER = r"\bamendament(?:ul|ele)?(?:\s+nr\.?)?\s*(\d{1,5}(?:/\d{2,4})?)\b"
AGENDA_FAMILIES = [
    (r"(?i)PL-?x\s+(\d{1,5}/\d{4})", "PL-x"), (r"(?i)PHCD\s+(\d{1,5}/\d{4})", "PHCD"),
    (r"(?iu)(?:Ordonanţ[aăei]+|OUG)\s+(?:de\s+urgenţă\s+a\s+Guvernului\s+)?nr\.?\s*(\d{1,4}/\d{4})", "OUG nr."), (r"(?i)Legea\s+nr\.?\s*(\d{1,4}/\d{4})", "Legea nr."),
]
AGENDA_TITLE = r"(?isu)(Proiectul\s+de\s+(?:Lege|Hotărâre)|Propunerea\s+legislativă)\s+((?:privind|pentru|de)\s+.+?)(?=\.\s|\.\s*$|;\s|,\s*transmis\b|,\s*PL)"
AGENDA_KIND = r"(?iu)proiectul\s+de\s+(lege|hotărâre)|propunerea\s+legislativă"
AGENDA_REFERENCE = r"(?iu)PL-?x\s+\d{1,5}/\d{4}|PHCD\s+\d{1,5}/\d{4}|privind\s+aprobarea"
AGENDA_REPORT = r"(?iu)raport\w*\s+(?:comun\s+)?(?:asupra|privind)"
FINAL_VOTE = r"(?iu)(?:proiectul de lege|propunerea legislativă|proiectul de hotărâre)\s+rămâne\s+(?:la\s+)?votul\s+final"
DEFAULT_TITLES = [("PL-x", "Proiect legislativ "), ("PHCD", "Proiect de Hotărâre "), ("OUG", "Ordonanță de urgență ")]

Families = Sequence[tuple[str, str]]


def _all(text: Column, families: Families) -> Column:
    def labelled(pattern: str, label: str) -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda n: F.concat(F.lit(f"{label} "), n))

    return F.concat(*[labelled(p, label) for p, label in families])


def _first(text: Column, families: Families) -> Column:
    return F.coalesce(*[F.concat(F.lit(f"{label} "), F.nullif(F.regexp_extract(text, p, 1), F.lit(""))) for p, label in families])


def references(key: Column, most: int, families: Families = BASELINE_FAMILIES) -> Column:
    """those of a text in normal form, family by family, each once, `most` at most."""
    return F.slice(F.array_distinct(_all(key, families)), 1, most)


def law_topic(c: Column, prefixes: Sequence[str] = LAW_TOPIC_PREFIXES) -> Column:
    """P11."""
    out = F.lit(False)
    for p in prefixes:
        out = out | c.startswith(p)
    return out


def first_law(c: Column, families: Families = TOPIC_FAMILIES) -> Column:
    """the first reference by order of families; null without one."""
    return let(export_text(c), lambda t: _first(t, families))


def all_laws(c: Column, families: Families = NUMBER_FAMILIES) -> Column:
    """each once, sorted."""
    return let(export_text(c), lambda t: F.array_sort(F.array_distinct(_all(t, families))))


def indexed_laws(c: Column, families: Families = INDEX_FAMILIES, generic: str = GENERIC_NUMBER, context: str = LEGISLATIVE_CONTEXT) -> Column:
    """references of a raw text; plain numbers only where it speaks of legislation."""
    t = or_empty(c)
    plain = F.when(t.rlike(context), _all(t, [(generic, "nr.")])).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.transform(F.concat(_all(t, families), plain), law_form))


def allowed(law: Column, known: Column) -> Column:
    """the normal form of a reference that the session has; else null."""
    return F.when(F.array_contains(known, law_form(law)), law_form(law))


def contributions(c: Column, families: Families = NUMBER_FAMILIES, authorship: str = AUTHORSHIP, amending: str = AMENDING, bill: str = BILL_WORDS, number: str = AMENDMENT_NUMBER) -> Column:
    """bills, amendments (with the least reference of the speech), and 1 where either is spoken of without a number."""
    key, none = export_text(c), F.array().cast("array<string>")
    laws = all_laws(c, families)
    author, amend = key.rlike(authorship), key.rlike(amending)
    bills = F.when(author, laws).otherwise(none)
    least = F.when(F.size(laws) > 0, F.concat(F.element_at(laws, 1), F.lit("|"))).otherwise("")
    amendments = F.when(amend, F.array_distinct(F.transform(F.regexp_extract_all(key, F.lit(number), F.lit(1)), lambda n: F.concat(least, F.lit("amendament "), n)))).otherwise(none)
    return F.struct(
        bills.alias("bills"), amendments.alias("amendments"), F.when(author & (F.size(bills) == 0) & key.rlike(bill), 1).otherwise(0).alias("generic_bills"),
        F.when(amend & (F.size(amendments) == 0), 1).otherwise(0).alias("generic_amendments"),
    )


def agenda_law(c: Column, families: Families = AGENDA_FAMILIES) -> Column:
    """F15."""
    return _first(or_empty(c), families)


def agenda_title(c: Column, pattern: str = AGENDA_TITLE) -> Column:
    """kind and title, of 150 characters at most, from the first 600 characters."""
    head = F.left(or_empty(c), F.lit(600))
    kind, body = F.regexp_extract(head, pattern, 1), F.left(squeezed(F.regexp_extract(head, pattern, 2)), F.lit(150))
    return F.when(kind != "", F.concat(squeezed(kind), F.lit(" "), F.when(body.endswith(","), F.trim(F.left(body, F.length(body) - 1))).otherwise(body)))


def default_title(law: Column, titles: Families = DEFAULT_TITLES) -> Column:
    out = F.when(law.isNull(), "")
    for prefix, title in titles:
        out = out.when(law.startswith(prefix), F.concat(F.lit(title), law))
    return out.otherwise(F.concat(F.lit("Act normativ "), law))


def announces(c: Column, kind: str = AGENDA_KIND, reference: str = AGENDA_REFERENCE, report: str = AGENDA_REPORT, final: str = FINAL_VOTE) -> Column:
    """F16: names a kind of item and a reference or report, and doesn't close the item."""
    t = or_empty(c)
    return ~t.rlike(final) & t.rlike(kind) & (t.rlike(reference) | t.rlike(report))
