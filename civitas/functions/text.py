"""Text functions: Column in, Column out."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from html.entities import html5

from pyspark.sql import Column, functions as F

from civitas.functions import fixed_values as V


#: The characters that Unicode calls white space.
WHITE = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def stripped(c: Column) -> Column:
    """Without (Unicode) white space at the ends."""
    return F.trim(c, F.lit(WHITE))


def normalized(c: Column) -> Column:
    """Runs of (Unicode) white space become one blank; none at the ends. Single blanks are no matches, so that most texts are only read."""
    return F.trim(F.regexp_replace(c, r"(?U)[^\S ]\s*| \s+", " "))


def comparable(c: Column) -> Column:
    return normalized(F.lower(c))


def without_trailing_phrases(c: Column) -> Column:
    """Cut at the first purpose phrase, then closing punctuation off."""
    return F.regexp_replace(F.regexp_replace(c, r"(?is)\s+(?:in order to|to|for|with|amongst|among)\s.*$", ""), r"[.,;\s]+$", "")


def without_leading_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, "^[.,;:•\n\r\t ]+", "")


def without_urls(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"https?://\S+", ""), r"\bwww\.\S+", "")


def unescaped(c: Column) -> Column:
    """Character references decoded as HTML does: named ones (the longest known name where no semicolon ends it), decimal and hexadecimal numbers.

    Names come from the standard library's table; numbers of no character are left out, those of a
    Windows code page mean its characters, and what is out of range becomes U+FFFD.
    """
    table = lambda names: F.from_json(F.lit(json.dumps(names)), "map<string,string>")
    ended, open_ = ({k: v for k, v in html5.items() if k.endswith(";") == e} for e in (True, False))
    windows = {str(n): bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)} | {"13": "\r"}

    def named(s: Column) -> Column:
        lengths = F.transform(F.sequence(F.lit(1), F.char_length(s)), lambda i: F.char_length(s) + 1 - i)
        longest = F.try_element_at(F.filter(lengths, lambda n: (n > 1) & F.map_contains_key(table(open_), F.substring(s, F.lit(1), n))), F.lit(1))
        known = F.concat(F.try_element_at(table(open_), F.substring(s, F.lit(1), longest)), F.substring(s, longest + 1, F.char_length(s)))
        return F.coalesce(F.try_element_at(table(ended), s), known, F.concat(F.lit("&"), s))

    def numbered(s: Column) -> Column:
        digits = F.rtrim(s, F.lit(";"))
        n = F.when(F.rlike(digits, F.lit("^#[xX]")), F.conv(F.substring(digits, 3, 40), 16, 10)).otherwise(F.substring(digits, 2, 40)).try_cast("decimal(38,0)")
        no_character = n.between(1, 8) | n.between(14, 31) | (n == 11) | n.between(0x7F, 0x9F) | n.between(0xFDD0, 0xFDEF) | (n % 0x10000 >= 0xFFFE)
        char = F.decode(F.unhex(F.lpad(F.hex(n.try_cast("long")), 8, "0")), "UTF-32")
        out_of_range = n.isNull() | (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF)
        return F.coalesce(F.try_element_at(table(windows), n.cast("string")), F.when(out_of_range, "�").when(no_character, "").otherwise(char))

    references = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
    parts = F.split(F.regexp_replace(F.replace(c, F.lit(MARK), F.lit(" ")), references, f"{MARK}$0{MARK}"), MARK)
    one = lambda s: F.when(F.startswith(s, F.lit("#")), numbered(s)).otherwise(named(s))
    return F.array_join(F.transform(parts, lambda p, i: F.when(i % 2 == 0, p).otherwise(one(F.substring(p, F.lit(2), F.char_length(p))))), "")


def complete_text(parts: Column) -> Column:
    """An array of strings, stripped and joined without anything between, decoded, lower-cased, normalised."""
    return comparable(unescaped(F.array_join(F.transform(parts, stripped), "")))


def contains_any(c: Column, phrases: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in phrases:
        out = out | F.contains(c, F.lit(p))
    return F.coalesce(out, F.lit(False))


def contains_all(c: Column, phrases: Sequence[str]) -> Column:
    out = F.lit(True)
    for p in phrases:
        out = out & F.contains(c, F.lit(p))
    return F.coalesce(out, F.lit(False))


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once, however often f uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def filled(c: Column) -> Column:
    """The text, null where it is empty; worked out once also within a lambda, where nullif would work it out twice."""
    return bound(c, lambda x: F.when(x != "", x))


def by_letter(patterns: Sequence[str]) -> str:
    """Alternatives in one pattern, those of one first letter together, so that at most places each letter is tried once."""
    groups: dict[str, list[str]] = {}
    for p in patterns:
        letter = re.match(r"[A-Za-z](?![?*+{])", p)
        groups.setdefault(letter[0] if letter and "|" not in re.sub(r"\([^()|]*(?:\|[^()|]*)*\)", "", p) else p, []).append(p)
    return "|".join(own[0] if len(own) == 1 else k + "(?:" + "|".join(p[1:] for p in own) + ")" if len(k) == 1 else "|".join(own) for k, own in groups.items())


def any_of_patterns(patterns: Sequence[str]) -> str:
    """One pattern that finds what any of some finds; a word boundary that all begin with stands once, so that most places fail at it."""
    outside = lambda p: re.sub(r"\\.|\[[^\]]*\]|\([^()|]*(?:\|[^()|]*)*\)", "", p)
    if all(p.startswith(r"\b") and "|" not in outside(p) for p in patterns):
        return r"\b(?:" + by_letter([p[2:] for p in patterns]) + ")"
    return "(?:" + "|".join(patterns) + ")"


def matches_any(c: Column, patterns: Sequence[str], case_blind: bool = True) -> Column:
    return F.coalesce(F.rlike(c, F.lit(("(?i)" if case_blind else "") + any_of_patterns(patterns))), F.lit(False))


def categories(c: Column, keywords: dict[str, Sequence[str]], default: str = "Other") -> Column:
    """All categories of which a keyword occurs (substring of the lower-cased text), in declaration order."""
    def hits(low: Column) -> Column:
        return F.array_compact(F.array(*(F.when(contains_any(low, words), F.lit(k)) for k, words in keywords.items() if words)))

    return bound(F.lower(F.coalesce(c, F.lit(""))), lambda low: bound(hits(low), lambda h: F.when(F.size(h) == 0, F.array(F.lit(default))).otherwise(h)))


def first_class(c: Column, patterns: dict[str, Sequence[str]], case_blind: bool = True, signs: dict[str, Sequence[str]] | None = None) -> Column:
    """The first class, in declaration order, of which a pattern occurs; null if none does.

    signs: lower-case words of each class, of which every match of its patterns holds one; only texts that do are searched.
    """
    if signs is None:
        return F.coalesce(*(F.when(matches_any(c, p, case_blind), F.lit(k)) for k, p in patterns.items()))
    return bound(F.lower(c), lambda low: F.coalesce(*(F.when(contains_any(low, signs[k]) & matches_any(c, p, case_blind), F.lit(k)) for k, p in patterns.items())))


def beginnings(pattern: str) -> tuple[str, ...]:
    """Words with one of which every match of a pattern begins: its plain letters and blanks, or those of a group; none where that cannot be told."""
    if "|" in re.sub(r"\\.|\[[^\]]*\]|\([^()|]*(?:\|[^()|]*)*\)", "", pattern):
        return ()
    group = re.match(r"\(\?:([A-Za-z ]+(?:\|[A-Za-z ]+)*)\)(?![?*+{])", pattern)
    plain = re.match(r"[A-Za-z ]+(?![?*+{A-Za-z ])", pattern)
    return tuple(group[1].split("|")) if group else (plain[0],) if plain else ()


def clean_status(c: Column) -> Column:
    """White space collapsed; anything about verification is Verification; title case."""
    one = normalized(c)
    return F.when(F.contains(F.lower(one), F.lit("verification")), "Verification").otherwise(F.initcap(one))


def by_rules(low: Column, rules) -> Column:
    """The label of the first row of a rule table (label, groups of phrases, forbidden phrases) that holds of a lower-cased text; null if none does."""

    def holds(groups, forbidden) -> Column:
        out = ~contains_any(low, forbidden) if forbidden else F.lit(True)
        for g in groups:
            out = out & contains_any(low, g)
        return out

    return F.coalesce(*(F.when(holds(groups, forbidden), F.lit(label)) for label, groups, forbidden in rules))


def action_type(c: Column) -> Column:
    """Kind of a legislative action by the rule table of actions."""
    return F.coalesce(bound(F.lower(c), lambda t: by_rules(t, V.ACTION_RULES)), F.lit("Legislative Action"))


def shortened(c: Column, n: int) -> Column:
    """At most n characters, cut at a word's end where there is one, and an ellipsis."""
    cut = F.regexp_replace(F.substring(c, 1, n), r"\s+\S*$", "")
    return F.when(F.char_length(c) <= n, c).otherwise(F.concat(cut, F.lit("...")))


def wrapped(c: Column, words: int, sep: str = "<br>") -> Column:
    """A break after every `words` words."""
    parts = F.split(F.trim(c), r"\s+")
    starts = F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1)), F.lit(words))
    return F.array_join(F.transform(starts, lambda i: F.array_join(F.slice(parts, i, words), " ")), sep)


#: Words, parts of words that end with a hyphen between letters, and white space.
CHUNKS = r"\s+|\S+?(?:-(?:(?<=\p{L}{2}-)|(?<=\p{L}-\p{L}-))(?=\p{L}-?\p{L})|(?=\s|\z))"


def wrapped_at(c: Column, width: int, sep: str = "<br>") -> Column:
    """Normalised text in lines of at most `width` characters, broken at blanks and after hyphens between letters; longer words are cut at the width."""
    chunks = F.regexp_extract_all(normalized(c), F.lit(CHUNKS), F.lit(0))
    state = lambda lines, line: F.struct(lines.alias("lines"), line.alias("line"))
    left = lambda s: F.lit(width) - F.char_length(s["line"])
    ended = lambda s, line: F.concat(s["lines"], F.array(F.rtrim(line)))

    def cut(s: Column, w: Column) -> Column:
        filled, rest = F.concat(s["line"], F.substring(w, F.lit(1), left(s))), F.substring(w, left(s) + 1, F.char_length(w))
        whole = F.floor((F.char_length(rest) - 1) / width).cast("int")
        pieces = F.transform(F.when(whole > 0, F.sequence(F.lit(0), whole - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.substring(rest, i * width + 1, F.lit(width)))
        return state(F.concat(s["lines"], F.array(filled), pieces), F.substring(rest, whole * width + 1, F.lit(width)))

    def step(s: Column, w: Column) -> Column:
        fits, blank = F.char_length(w) <= left(s), F.trim(w) == ""
        return (
            F.when(blank & (s["line"] == ""), s)
            .when(fits, state(s["lines"], F.concat(s["line"], w)))
            .when(blank, state(ended(s, s["line"]), F.lit("")))
            .when(F.char_length(w) > width, cut(s, w))
            .otherwise(state(ended(s, s["line"]), w))
        )

    none = state(F.array().cast("array<string>"), F.lit(""))
    return F.array_join(F.aggregate(chunks, none, step, lambda s: F.when(s["line"] != "", ended(s, s["line"])).otherwise(s["lines"])), sep)


def short_number(c: Column, sign: str = "") -> Column:
    """1.2M, 3.4K or the number itself."""
    return F.concat(
        F.lit(sign),
        F.when(c >= 1e6, F.concat(F.format_string("%.1f", c / 1e6), F.lit("M"))).when(c >= 1e3, F.concat(F.format_string("%.1f", c / 1e3), F.lit("K"))).otherwise(F.format_string("%.0f", c.cast("double"))),
    )


def correlation_label(r: Column) -> Column:
    a = F.abs(r)
    return F.when(a >= 0.8, "very strong").when(a >= 0.6, "strong").when(a >= 0.4, "moderate").when(a >= 0.2, "weak").otherwise("very weak")


def number(c: Column, missing: float | None = None) -> Column:
    """A number with thousands separators; what cannot be read is `missing` (null by default)."""
    out = F.regexp_replace(F.trim(c), ",", "").try_cast("double")
    return out if missing is None else F.coalesce(out, F.lit(float(missing)))


def first_integer(c: Column) -> Column:
    """The first run of digits and commas as an integer; 0 if there is none."""
    return F.coalesce(F.regexp_replace(F.regexp_extract(c, r"(\d[\d,]*)", 1), ",", "").try_cast("long"), F.lit(0))


def year_in(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"(\d{4})", 1), F.lit("")).cast("int")


def percent(c: Column) -> Column:
    return F.rtrim(F.trim(c), F.lit("%")).try_cast("double")


def ratio_text(r: Column) -> Column:
    """`2.0x more` or `1.5x less`."""
    return F.when(r >= 1, F.concat(F.format_string("%.1f", r), F.lit("x more"))).otherwise(F.concat(F.format_string("%.1f", 1 / r), F.lit("x less")))


def sentences(c: Column) -> Column:
    return F.filter(F.split(normalized(c), r"(?<=[.!?])\s+"), lambda s: s != "")


def sentence_around(before: Column, rest: Column) -> Column:
    """The sentence at a place, of the text before and after it, without leading punctuation.

    It begins after a full stop, question or exclamation mark that white space follows, a bullet or
    an empty line, and ends with the next such mark or before an empty line.
    """
    begun = F.regexp_replace(before, r"(?s)^.*(?:[.!?](?=\s)|•|\n\n)", "")
    ended = F.regexp_extract(rest, r"(?s)^.*?(?:[.!?]|(?=\n\n)|\z)", 0)
    return filled(normalized(without_leading_punctuation(stripped(F.concat(begun, ended)))))


#: Marks the places of matches; texts that hold it themselves get a blank instead.
MARK = "\ue000"


def matches(c: Column, pattern: Column) -> Column:
    """array<struct<start, group>>: matches of a pattern from left to right, with their places and first groups."""
    parts = F.split(F.regexp_replace(F.replace(c, F.lit(MARK), F.lit(" ")), pattern, F.lit(MARK + "$0")), MARK)

    def placed(p: Column) -> Column:
        starts = F.transform(p, lambda _, i: F.aggregate(F.slice(p, 1, i), F.lit(0), lambda n, x: n + F.char_length(x)))
        found = F.zip_with(p, starts, lambda x, at: F.struct(at.alias("start"), F.try_element_at(F.regexp_extract_all(x, pattern, F.lit(1)), F.lit(1)).alias("group")))
        return F.slice(found, 2, F.size(found))

    return bound(parts, placed)


def sentence_with(c: Column, phrase: str) -> Column:
    """The first sentence that holds the phrase; null if none does."""
    return F.try_element_at(F.filter(sentences(c), lambda s: F.contains(F.lower(s), F.lit(phrase.lower()))), F.lit(1))


# The labels of technical statuses.
STATUS_LABELS = {
    "applicable": "Law Active",
    "adopted": "Law Approved",
    "committed": "Law Promised",
    "assessment_pending": "Being Studied",
    "roadmap_development": "Action Plan Created",
    "rejected_already_covered": "Rejected - Already Covered",
    "rejected_with_actions": "Rejected - Alternative Actions",
    "rejected": "Rejected",
    "non_legislative_action": "Policy Changes Only",
    "proposal_pending_adoption": "Proposals Under Review",
}


def status_label(c: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in STATUS_LABELS.items() for x in kv)), c)


class StatusLadder:
    """Implementation status of an answer by a rule table over its text, in order of priority.

    The rules are a parameter, so other corpora can bring their own.
    """

    def __init__(self, rules=V.STATUS_RULES):
        self.rules = rules

    def reached(self, content: Column, *labels: str) -> Column:
        """The first of some labels whose rules hold of a comparable text, whatever else holds."""
        return bound(content, lambda t: by_rules(t, [r for r in self.rules if r[0] in labels]))

    def rejection(self, content: Column) -> Column:
        return self.reached(content, "rejected_already_covered", "rejected_with_actions", "rejected")

    def status(self, content: Column) -> Column:
        return bound(content, lambda t: by_rules(t, self.rules))

    def __call__(self, c: Column) -> Column:
        return self.status(comparable(c))
