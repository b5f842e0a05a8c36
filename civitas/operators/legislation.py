"""Names of legislation in a text: treaties, charters, directives and regulations.

The text is cut into clauses; those that name a kind of act are cut again at conjunctions before another
act and trimmed of prepositions. Names are runs of capitalised words before or after the kind, and known
abbreviations anywhere. Names joined by conjunctions are taken apart, generic ones left out, and an
abbreviation gives way to its full form. All of it are column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from civitas.functions import text as T

# Kinds of acts, their abbreviations, what makes a name generic, and words trimmed from the ends of a clause.
ACTS = ("Directive", "Regulation", "Law", "Treaty", "Charter")
KINDS = {"treaties": "Treaty", "charters": "Charter", "directives": "Directive", "regulations": "Regulation"}
ABBREVIATIONS = {
    "treaties": ("TEU", "TFEU", "MA", "AM", "NI", "LI"),
    "charters": ("CFR", "ECHR"),
    "directives": ("WFD", "BHD", "FWD", "NWD", "UWWTD", "AQD", "NEC", "IED", "Aarhus", "EIA", "SEA", "IPPC"),
    "regulations": ("GDPR", "REACH", "RoHS", "WEEE", "EMIR", "MiFIR", "CRR", "CRD", "ETS", "FQD", "LULUCF", "PIC", "POPs", "CLP", "Biocides"),
}
GENERIC = ("proposal for", "revised", "new", "draft", "implementing", "delegated", "amending")
EDGES = r"\b(?:the|an|a|of|and|for|on|in|to|at|by|with)\b"
TREATIES = (r"Treaty\s+on\s+(?:the\s+)?(?:European\s+Union|Functioning\s+of\s+the\s+European\s+Union)", r"\b(?:[A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+){0,5})\s+Treaty\b")
CHARTERS = (r"Charter\s+of\s+(?:the\s+)?Fundamental\s+Rights(?:\s+of\s+the\s+European\s+Union)?", r"\b(?:[A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+){0,5})\s+Charter\b")
#: Between the words of a name: a preposition or an apostrophe.
LINK = r"(?:\s+(?:of|and|the|for|on|in|to)|\s*['‐]\s*)"


def name_pattern(kind: str) -> str:
    """Capitalised words after the kind and a link, or before it. Words of a name are apart, so that a match costs little."""
    gap = rf"(?:{LINK}\s*|\s+)"
    other = rf"(?!{kind}\b)[A-Z]\w*"
    return rf"(?U)\b{kind}{LINK}\s*{other}(?:{gap}{other})*\b|\b[A-Z]\w*(?:{gap}[A-Z]\w*)*(?:{LINK}?\s*{kind})\b"


def _trimmed(c: Column) -> Column:
    return T.stripped(c)


def _filled(texts: Column) -> Column:
    return F.filter(texts, lambda x: x != "")


def _all(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def clauses(text: Column) -> Column:
    """The clauses of a text that name a kind of act, without prepositions at their ends."""
    named = F.filter(F.split(text, "[.;,]"), lambda p: T.contains_any(p, ACTS))
    count = lambda p: sum((F.when(F.contains(p, F.lit(a)), 1).otherwise(0) for a in ACTS), F.lit(0))
    before_act = rf"(?iU)\s+\b(?:and|or)\b\s+(?=(?:the\s+)?(?:{'|'.join(ACTS)})\b)"

    def cut(p: Column) -> Column:
        several = (count(p) > 1) & F.rlike(p, F.lit(r"(?iU)\b(?:and|or)\b"))
        return F.when(several, F.filter(F.transform(F.split(p, before_act), _trimmed), lambda x: ~F.lower(x).isin("", "and", "or"))).otherwise(F.array(p))

    def bare(p: Column) -> Column:
        return _trimmed(F.regexp_replace(F.regexp_replace(p, rf"(?iU)^\s*(?:{EDGES}\s+)+", ""), rf"(?iU)(?:\s+{EDGES})+\s*$", ""))

    return _filled(F.transform(F.flatten(F.transform(F.transform(named, _trimmed), cut)), bare))


def _unjoined(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(_trimmed(c), r"(?iU)\s*\b(?:and|or)\b\s*$", ""), r"(?iU)^\s*\b(?:and|or)\b\s*", "")


def taken_apart(item: Column, kind: str) -> Column:
    """Single names of a name that joins several: each with its own kind, or all before one kind, which then goes."""
    listed = rf"(?iU)((?:\w+(?:\s+\w+)*(?:,\s*|\s+(?:and|or)\s+))+\w+(?:\s+\w+)*)\s+{kind}"

    def names(p: Column) -> Column:
        parts = F.split(p, rf"(?iU)\b{kind}\b")
        own = F.transform(_filled(F.transform(F.slice(parts, 1, F.size(parts) - 1), _unjoined)), lambda x: F.trim(F.concat(x, F.lit(f" {kind}"))))
        shared = _filled(F.transform(F.split(F.regexp_extract(p, listed, 1), r"(?iU)\s*(?:,|and|or)\s+"), _unjoined))
        return F.when(F.size(parts) > 2, own).when((F.size(parts) == 2) & F.rlike(p, F.lit(listed)), shared).otherwise(F.array(p))

    return F.flatten(F.transform(_filled(F.transform(F.split(item, "\n"), _trimmed)), names))


def is_generic(item: Column, kind: str) -> Column:
    low = kind.lower()
    plain = [low, *(f"{a} {low}" for a in ("the", "a", "an")), *(f"{g} {a}{low}" for g in GENERIC for a in ("", "the ", "a "))]
    return T.bound(_trimmed(item), lambda x: F.lower(x).isin(*plain) | F.rlike(x, F.lit(rf"(?iU)^EU\s+{kind}$")))


def settled(items: Column, kind: str) -> Column:
    """Names without articles, taken apart, without generic ones, distinct regardless of case, sorted; null if none is left."""
    bare = _filled(F.transform(items, lambda x: F.regexp_replace(x, r"^(?:The|the|A|a|An|an) ", "")))
    single = F.filter(F.flatten(F.transform(bare, lambda x: taken_apart(x, kind))), lambda x: ~is_generic(x, kind))
    single = _filled(F.transform(single, _trimmed))

    def distinct(own: Column) -> Column:
        lows = F.transform(own, F.lower)
        first = F.filter(own, lambda x, i: F.array_position(lows, F.lower(x)) == i + 1)
        return F.array_sort(F.filter(first, lambda x: ~F.array_contains(lows, F.concat(F.lower(x), F.lit(f" {kind.lower()}")))))

    return T.bound(T.bound(single, distinct), lambda x: F.when(F.size(x) > 0, x))


def legislation_by_name(text: Column) -> Column:
    """struct<treaties, charters, directives, regulations> of sorted names; kinds without any are null.

    text: the page's pieces of text, one a line.
    """

    of = lambda abbreviations: rf"(?iU)\b(?:{T.by_letter(abbreviations)})\b"

    def found(parts: Column, known: Column, key: str) -> Column:
        own = F.filter(known, lambda x: F.rlike(x, F.lit(of(ABBREVIATIONS[key]))))
        short = F.array_distinct(F.transform(own, F.upper))
        patterns = {"treaties": TREATIES, "charters": CHARTERS}.get(key, (name_pattern(KINDS[key]),))
        named = F.filter(parts, lambda p: F.contains(p, F.lit(KINDS[key])))
        names = F.flatten(F.transform(named, lambda p: F.flatten(F.array(*(_all(p, x) for x in patterns)))))
        return settled(F.concat(short, F.transform(names, _trimmed)), KINDS[key])

    # the whole text is searched once for the abbreviations of all kinds, then each kind takes its own
    every = of([a for own in ABBREVIATIONS.values() for a in own])
    read = T.bound(text, lambda x: F.struct(clauses(x).alias("parts"), _all(x, every).alias("known")))
    return T.bound(read, lambda t: F.struct(*(found(t["parts"], t["known"], k).alias(k) for k in KINDS)))
