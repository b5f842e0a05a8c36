"""Date functions: Column in, Column out. Dates that cannot be read are null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from civitas.functions import fixed_values as V
from civitas.functions.text import MARK, bound, filled

MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
MONTH = "(?:" + "|".join(MONTHS) + ")"


def month_number(c: Column) -> Column:
    """1 to 12 for a month's name or its first three letters, in any case."""
    return F.try_element_at(_months(lambda m: (m[:3],)), F.substring(F.lower(F.trim(c)), 1, 3))


def _months(names) -> Column:
    return F.expr("map(" + ", ".join(f"'{n}', {i + 1}" for i, m in enumerate(MONTHS) for n in sorted({*names(m)})) + ")")


def _day_of(year: Column, month, day) -> Column:
    """The date of three parts; null where one is missing or there is no such day."""
    part = lambda x: x.cast("string") if isinstance(x, Column) else F.lit(str(x))
    return F.concat(part(year), F.lit("-"), part(month), F.lit("-"), part(day)).try_cast("date")


def _found(c: Column, pattern: str, group: int = 1) -> Column:
    return filled(F.regexp_extract(c, pattern, group))


#: d Month yyyy, d/m/yyyy and d-m-yyyy in the order of yyyy-m-d, where a month may be a name.
_ORDERED = ((r"^(\d{1,2})\s+([a-z]{3,9})\.?\s+(\d{4})$", "$3-$2-$1"), (r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})$", "$3-$2-$1"), (r"^([a-z]{3,9})\s+(\d{4})$", "$2-$1"))


def _parts(c: Column) -> Column:
    """Year, month and day of a date, year and month, or the year alone; months as names or numbers. Null for anything else."""
    out = F.lower(F.trim(c))
    for pattern, order in _ORDERED:
        out = F.regexp_replace(out, pattern, order)
    return bound(out, lambda x: F.when(F.rlike(x, F.lit(r"^\d{4}(?:-[a-z]{3,9}|-(?:[a-z]{3,9}|\d{1,2})-\d{1,2})?$")), F.split(x, "-")))


def _read(c: Column, month: str, year) -> Column:
    """A date; `first` or `last` day of a month, and (month, day) for a year alone."""
    names = _months(lambda m: (m, m[:3]))

    def day(p: Column) -> Column:
        known = F.coalesce(F.try_element_at(names, F.get(p, 1)).cast("string"), F.when(F.size(p) == 3, F.get(p, 1)))
        own = _day_of(F.get(p, 0), known, F.coalesce(F.get(p, 2), F.lit("1")))
        return F.when(F.size(p) == 1, _day_of(F.get(p, 0), *year)).otherwise(F.when(F.size(p) == 2, F.last_day(own)).otherwise(own) if month == "last" else own)

    return bound(_parts(c), day)


def parsed(c: Column) -> Column:
    """A date; month and year mean the first day, a year alone its January 1."""
    return _read(c, "first", (1, 1))


def parsed_end(c: Column) -> Column:
    """A date; coarser expressions mean the end of their period."""
    def day(low: Column) -> Column:
        return F.coalesce(_read(low, "last", (12, 31)), _day_of(_found(low, r"end\s+(?:of\s+)?(\d{4})"), 12, 31), _day_of(_found(low, r"early\s+(?:in\s+)?(\d{4})"), 3, 31))

    return bound(F.lower(F.trim(c)), day)


# The last day meant by a phrase, by the first pattern that occurs.
DEADLINES = (
    (r"since\s+(?:[a-z]+\s+)?(\d{4})", 1, 1),
    (r"spring\s+(?:of\s+)?(\d{4})", 6, 20),
    (r"summer\s+(?:of\s+)?(\d{4})", 9, 22),
    (r"(?:autumn|fall)\s+(?:of\s+)?(\d{4})", 12, 21),
    (r"winter\s+(?:of\s+)?(\d{4})", 3, 31),
    (r"late\s+(?:in\s+)?(\d{4})", 12, 31),
    (r"(?:q1|(?:first|1st)\s+quarter)\s+(?:of\s+)?(\d{4})", 3, 31),
    (r"(?:q2|(?:second|2nd)\s+quarter)\s+(?:of\s+)?(\d{4})", 6, 30),
    (r"(?:q3|(?:third|3rd)\s+quarter)\s+(?:of\s+)?(\d{4})", 9, 30),
    (r"(?:q4|(?:fourth|4th|last)\s+quarter)\s+(?:of\s+)?(\d{4})", 12, 31),
    (r"first\s+half\s+(?:of\s+)?(\d{4})", 6, 30),
    (r"second\s+half\s+(?:of\s+)?(\d{4})", 12, 31),
    (r"(?:middle|mid)[\s-]+(?:of\s+)?(\d{4})", 6, 30),
    (r"end\s+(?:of\s+)?(\d{4})", 12, 31),
    (r"early\s+(?:in\s+)?(\d{4})", 3, 31),
)


def deadline(c: Column) -> Column:
    """The last day that a deadline phrase allows."""
    named, full = rf"({MONTH})\s+(\d{{4}})", rf"(\d{{1,2}}\s+{MONTH}\s+\d{{4}})"

    def day(low: Column) -> Column:
        steps = [_day_of(_found(low, p), m, d) for p, m, d in DEADLINES]
        return F.coalesce(*steps, parsed(_found(low, full)), F.last_day(_day_of(_found(low, named, 2), month_number(_found(low, named)), 1)), parsed_end(low))

    return bound(F.lower(F.trim(c)), day)


def registry_date(c: Column) -> Column:
    """dd/MM/yyyy only."""
    return F.when(F.rlike(F.trim(c), F.lit(r"^\d{2}/\d{2}/\d{4}$")), F.regexp_replace(F.trim(c), "^(..)/(..)/(....)$", "$3-$2-$1").try_cast("date"))


EVERY = rf"(?i)\d{{1,2}}\s+{MONTH}\s+\d{{4}}|{MONTH}\s+\d{{4}}|\b\d{{1,2}}/\d{{1,2}}/\d{{4}}\b|\b\d{{4}}-\d{{1,2}}-\d{{1,2}}\b|(?<![/\d-])(?:19|20)\d{{2}}(?![/\d-])"


def harvested(c: Column) -> Column:
    """All dates in a text, ends of periods for coarser ones, distinct, in order of appearance."""
    return _every(c, parsed_end)


# Forms of dates in the texts of events, the more specific ones first.
_NAMES = "(?:" + "|".join([m.capitalize() for m in MONTHS] + [m[:3].capitalize() for m in MONTHS]) + ")"
EVENT_FORMS = {
    "iso": r"(?i)\b(\d{4})-(\d{1,2})-(\d{1,2})\b",
    "numeric": r"(?i)\b(\d{1,2})([./-])(\d{1,2})\2(\d{4})\b",
    "named": rf"(?i)\b(\d{{1,2}})\s+({_NAMES})\s+(\d{{4}})\b",
    "period": r"(?i)\b(?:(?:early|late|end(?:\s+of)?)|(?:(?:first|second|third|fourth|last)\s+(?:half|quarter)(?:\s+of)?)|(?:spring|summer|autumn|fall|winter)|since|Q[1-4])\s+(\d{4})\b",
    "month": rf"(?i)\b({_NAMES})\s+(\d{{4}})\b",
    "year": r"(?i)(?<![\d/(\-])\b(20\d{2})\b(?![\d/\-])",
}
EVENT_READERS = {
    "iso": lambda x: x.try_cast("date"),
    "numeric": lambda x: F.regexp_replace(x, r"^(\d+)[./-](\d+)[./-](\d+)$", "$3-$2-$1").try_cast("date"),
    "named": lambda x: parsed(x),
    "period": lambda x: deadline(x),
    "month": lambda x: deadline(x),
    "year": lambda x: F.concat(x, F.lit("-01-01")).try_cast("date"),
}


def event_dates(c: Column) -> Column:
    """All dates of an event's text, distinct: by the order of EVENT_FORMS, then of appearance.

    A form takes what it has read out of the text, so that no coarser form reads a part of it
    again; what cannot be read stays for the others. A bare year means its January 1. Addresses
    and names of programmes are no dates.
    """
    plain = F.regexp_replace(F.regexp_replace(F.replace(c, F.lit(MARK), F.lit(" ")), r"(?i)https?://\S+|www\.\S+", ""), "(?i)" + "|".join(V.PROGRAMMES), "")
    state = F.struct(plain.alias("text"), F.array().cast("array<date>").alias("days"))
    for form, pattern in EVENT_FORMS.items():
        state = bound(state, _taking(pattern, EVENT_READERS[form]))
    return F.array_distinct(state["days"])


def _taking(pattern: str, read):
    """A step: the dates that a form reads, and the text with word characters in place of them."""

    def step(state: Column) -> Column:
        parts = F.split(F.regexp_replace(state["text"], pattern, f"{MARK}$0{MARK}"), MARK)
        told = F.transform(parts, lambda x, i: F.struct(x.alias("part"), F.when(i % 2 == 1, read(x)).alias("day")))
        left = lambda t: F.when(t["day"].isNull(), t["part"]).otherwise(F.repeat(F.lit("_"), F.char_length(t["part"])))
        days = lambda own: F.filter(F.transform(own, lambda t: t["day"]), lambda d: d.isNotNull())
        return bound(told, lambda own: F.struct(F.array_join(F.transform(own, left), "").alias("text"), F.concat(state["days"], days(own)).alias("days")))

    return step


def _every(c: Column, read) -> Column:
    found = F.transform(F.regexp_extract_all(c, F.lit(EVERY), F.lit(0)), lambda x: read(x))
    return F.array_distinct(F.filter(found, lambda x: x.isNotNull()))


def latest_until(dates: Column, as_of: Column) -> Column:
    return F.array_max(F.filter(dates, lambda d: d <= as_of))


def latest_after(dates: Column, as_of: Column) -> Column:
    return F.array_max(F.filter(dates, lambda d: d > as_of))


def shown(c: Column) -> Column:
    return F.coalesce(F.date_format(c, "dd MMM yyyy"), F.lit("Unknown"))


def duration_text(days: Column) -> Column:
    """`X years Y months Z days` with years of 365 and months of 30 days; zero parts left out."""
    days = F.abs(days)
    unit = lambda n, w: F.when(n == 1, F.concat(F.lit("1 "), F.lit(w))).when(n > 1, F.concat(n.cast("string"), F.lit(f" {w}s")))
    y, m, d = F.floor(days / 365), F.floor((days % 365) / 30), (days % 365) % 30
    text = F.concat_ws(" ", unit(y, "year"), unit(m, "month"), unit(d, "day"))
    return F.when(days == 0, "0 days").otherwise(text)


def step_date(steps: Column, name: str) -> Column:
    """The date of the first step of a name, from array<struct<step, date>>."""
    return F.try_element_at(F.filter(steps, lambda s: s["step"] == name), F.lit(1))["date"]


def step_map(steps: Column) -> Column:
    """name -> date; of repeated names the last stays."""
    names = F.array_distinct(F.transform(steps, lambda s: s["step"]))
    return F.map_from_entries(F.transform(names, lambda n: F.struct(n, F.element_at(F.filter(steps, lambda s: s["step"] == n), -1)["date"])))


def earliest(actions: Column, statuses: Sequence[str]) -> Column:
    """The earliest date of the actions (struct<status, date>) of some statuses."""
    return F.array_min(F.transform(F.filter(actions, lambda a: a["status"].isin(*statuses)), lambda a: a["date"]))
