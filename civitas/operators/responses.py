"""Columns over response records: outcome taxonomies, legal status, cases, policies, legislation and organisers.

The records keep lists as JSON text. Days that stand for today are arguments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from civitas.functions import dates as D, json_ops as J, text as T

# Outcome taxonomies. Each is a list of (label, `has` or `is`, words), tried in order, the label
# of any other outcome, and that of a missing one.
TAXONOMIES = {
    "action": ([("Rejected", "has", ["Rejected"]), ("Legislative Action Taken", "is", ["Law Active", "Law Passed", "Law Promised", "Action Plan Created"])], "Other", "Unknown"),
    "engaged": ([("Law Active/Passed", "has", ["Law Active", "Law Passed"]), ("Commission Engaged", "has", ["Law Promised", "Action Plan", "Being Studied"]), ("Rejected", "has", ["Rejected"])], None, None),
    "single": (
        [(x, "has", [x]) for x in ("Law Active", "Law Passed", "Law Promised", "Action Plan Created", "Being Studied", "Rejected")] + [("Waiting for Response", "has", ["Waiting"])],
        "Unsuccessful",
        "Unsuccessful",
    ),
    "group": ([("Law Passed/Active", "is", ["Law Active", "Law Passed"]), ("Commission Engagement", "is", ["Law Promised", "Being Studied", "Action Plan Created"]), ("Rejected", "has", ["Rejected"])], "Commission Engagement", "Waiting for Response"),
    "category": ([("Commission Engagement", "has", ["Law Promised", "Action Plan", "Being Studied"]), ("Law Passed/Active", "has", ["Law Active", "Law Passed"]), ("Rejected", "has", ["Rejected"])], None, None),
}


def outcome(c: Column, taxonomy: str) -> Column:
    """The label of an outcome in one of the taxonomies."""
    rules, other, missing = TAXONOMIES[taxonomy]
    fits = {"has": lambda words: T.contains_any(c, words), "is": lambda words: c.isin(*words)}
    found = [F.when(fits[how](words), label) for label, how, words in rules]
    return F.when(c.isNull(), F.lit(missing).cast("string")).otherwise(F.coalesce(*found, F.lit(other).cast("string")))


def campaign_outcome(c: Column, collected: Column) -> Column:
    """Outcome of a campaign: what the registry says, else whether the signatures were collected."""
    return F.when(c.isin("Withdrawn", "Commission Response"), c).otherwise(F.when(collected, "Collected Signatures").otherwise("Unsuccessful Collection"))


def grouped_outcome(c: Column, collected: Column) -> Column:
    return F.when(collected, outcome(c, "group")).otherwise("Unsuccessful Collection")


def unresponded_outcome(c: Column) -> Column:
    return F.when(T.contains_any(F.lower(c), ("unsuccessful collection", "withdrawn")), "Unsuccessful Collection")


# How a text tells from when an act is in force or applies.
_DAY = r"((?:\d{1,2}\s+)?[A-Za-z]{3,10}\s+\d{4}|\d{4}-\d{2}-\d{2})"
IN_FORCE = r"(?i)(?:enter(?:ed)?|coming|came).{0,10}(?:into force).{0,10}(?:on|in)\s+" + _DAY
APPLIES = r"(?i)(?<!will )(?:appl(?:y|ies|ied|icable|ication)|transpos(?:ed|ition)|edition).{0,20}(?:on|from|in)\s+" + _DAY
AT_ONCE = r"(?i)(?:bec(?:ome|ame|omes)|is|are)\s+applicable\s+immediately"
EARLIER = r"(?i)(?:entered into force|adopted)(?:\s+\w+){0,5}?(?: on| in)?\s+(\d{1,2}\s+[A-Za-z]+\s+\d{4}|[A-Za-z]+\s+\d{4})"


def days_told(text: Column, pattern: str) -> Column:
    """The days that a pattern's first group finds in a text."""
    return F.filter(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda x: D.parsed(x)), lambda d: d.isNotNull())


def effective(text: Column) -> Column:
    """struct<day, status>: from when a text says an act has effect.

    The latest day of application makes `law_active`, else the latest day of entry into
    force `in_vacatio_legis`; what applies immediately is active from its entry into force.
    """
    clean = F.translate(F.trim(text), " ", " ")

    def told(forces: Column, applies: Column, at_once: Column) -> Column:
        first, active, force = F.try_element_at(forces, F.lit(1)), F.array_max(applies), F.array_max(forces)
        status = lambda day, word: F.struct(day.alias("day"), F.lit(word).alias("status"))
        return F.when(at_once & first.isNotNull(), status(first, "law_active")).when(active.isNotNull(), status(active, "law_active")).when(force.isNotNull(), status(force, "in_vacatio_legis"))

    once = F.array(F.struct(days_told(clean, IN_FORCE).alias("f"), days_told(clean, APPLIES).alias("a"), F.coalesce(F.rlike(clean, F.lit(AT_ONCE)), F.lit(False)).alias("i")))
    return F.element_at(F.transform(once, lambda x: told(x["f"], x["a"], x["i"])), 1)


def updated_actions(actions: Column, as_of: Column) -> Column:
    """Actions (struct<status, date, description, ...>) with status and date by their descriptions.

    An effect after `as_of` is `in_vacatio_legis` whatever it is called.
    """
    def one(a: Column) -> Column:
        def told(e: Column) -> Column:
            status = F.when(e["day"].isNull(), a["status"]).when(e["day"] <= as_of, e["status"]).otherwise("in_vacatio_legis")
            return a.withField("status", status).withField("date", F.coalesce(e["day"].cast("string"), a["date"]))

        return T.bound(effective(a["description"]), told)

    return F.transform(actions, one)


def dated_actions(actions: Column, enrich: bool = False, buffer: int = 30) -> Column:
    """array<struct<day, type, status>> of the actions that have a date.

    enrich: an active law whose description tells of an adoption or entry into force more
    than `buffer` days before gets a second, earlier entry in vacatio legis.
    """
    day = lambda a: D.parsed(a["date"])
    entry = lambda d, kind, status: F.struct(d.alias("day"), kind.alias("type"), status.alias("status"))

    def entries(a: Column) -> Column:
        own = entry(day(a), F.coalesce(a["type"], F.lit("Unknown")), F.coalesce(a["status"], F.lit("Unknown")))
        before = T.bound(day(a), lambda d0: F.array_min(F.filter(days_told(a["description"], EARLIER), lambda d: d < F.date_sub(d0, buffer))))
        more = entry(before, F.concat(F.coalesce(a["type"], F.lit("Unknown")), F.lit(" (Adopted/Force)")), F.lit("in_vacatio_legis"))
        return F.filter(F.array(own, more), lambda x: x["day"].isNotNull()) if enrich else F.array(own)

    def told(a: Column) -> Column:
        return F.when(a["status"] == "law_active", entries(a)).otherwise(F.array(entry(day(a), F.coalesce(a["type"], F.lit("Unknown")), F.coalesce(a["status"], F.lit("Unknown")))))

    return F.filter(F.flatten(F.transform(actions, told)), lambda x: x["day"].isNotNull())


def outcome_year(status: Column, actions: Column, default: Column) -> Column:
    """The first year in which a law passed or became active, else that of the response."""
    done = F.filter(actions, lambda a: a["status"].isin("law_active", "adopted", "law_entered_into_force"))
    first = F.array_min(F.transform(done, lambda a: D.parsed(a["date"])))
    return F.when(status.isin("Law Active", "Law Passed"), F.coalesce(F.year(first), F.year(default))).otherwise(F.year(default))


# Contexts that say nothing of a case, and words that tell how one ended.
VAGUE = (
    r"will carefully consider.*court.*judgment", r"commission will.*consider.*in view of", r"will.*take.*into account.*judgment", r"^the commission will carefully consider",
    r"is currently being assessed.*cases?.*before.*court", r"are currently being assessed.*court", r"cases?.*pending.*before.*court", r"interface.*being assessed.*cases?.*court",
    r"two cases.*before.*court.*without.*specifics", r"ongoing.*cases?.*court.*without.*detail",
)
RULINGS = {"dismissed": "Dismissed/Lost", "annul": "Annulled/Won", "reject": "Rejected/Lost", "uphold": "Upheld", "ruled in favour": "Favorable", "ruled against": "Unfavorable", "clarified": "Clarification", "held that": "Court held"}


def tells_of_case(text: Column, least: int = 50) -> Column:
    """Whether a passage is long enough and not one of the vague ones."""
    low = F.trim(F.lower(text))
    return (F.char_length(low) >= least) & ~F.coalesce(F.rlike(low, F.lit("|".join(f"(?:{p})" for p in VAGUE))), F.lit(False))


def case_outcome(text: Column) -> Column:
    low = F.lower(text)
    return F.coalesce(*(F.when(F.contains(low, F.lit(k)), v) for k, v in RULINGS.items()))


# Words by which a passage is not about legislation, and false positives of a policy type.
NOT_LEGISLATIVE = (
    r"\broadmaps?\b", r"\btasked\b", r"\bwill communicate\b", r"\bwill report\b", r"\bimpact assessments?\b", r"\bstakeholders?\b", r"\bconsultations?\b", r"\bworkshops?\b", r"\bmeetings?\b",
    r"\bbetter enforcement\b", r"\bin parallel to the legislation\b", r"\bseek specific supporting measures?\b",
)
FALSE_POLICIES = {"Data Collection and Transparency": ("proposal for a Regulation", "targeted amendment of the General Food Law Regulation", "At the same time, the Regulation will")}


def not_legislative(text: Column) -> Column:
    return T.matches_any(F.lower(text), NOT_LEGISLATIVE)


def policy_types(policies: Column) -> Column:
    """Types of policy actions (JSON text), without known false positives; `Unknown` where none is said."""
    actions = J.parsed(policies, "array<struct<type:string,description:string>>")
    kept = F.filter(actions, lambda a: ~F.coalesce(*(F.when((a["type"] == k) & T.contains_any(a["description"], w), True) for k, w in FALSE_POLICIES.items()), F.lit(False)))
    return F.coalesce(F.transform(kept, lambda a: F.coalesce(a["type"], F.lit("Unknown"))), F.array().cast("array<string>"))


def legislation_items(c: Column) -> Column:
    """All distinct identifiers or names of a JSON object of lists or strings; of other text the items between commas."""
    def listed(v: Column) -> Column:
        return F.when(F.startswith(F.ltrim(v), F.lit("[")), J.items(v)).otherwise(F.array(v))

    found = F.flatten(F.transform(F.map_values(J.pairs(c)), listed))
    loose = F.filter(F.transform(F.split(F.regexp_replace(c, "Directive|CELEX", ""), ","), F.trim), lambda x: ~x.isin("", "{}", "[]"))
    return F.when(J.present(c).isNull(), F.array().cast("array<string>")).otherwise(F.array_distinct(F.when(F.startswith(F.ltrim(c), F.lit("{")), found).otherwise(loose)))


def celex_ids(c: Column) -> Column:
    """struct<resolved, unresolved>: identifiers of a JSON object of legislation (kind -> numbers), and what has none."""
    object_ = J.pairs(c)
    numbers = F.flatten(F.transform(F.map_entries(object_), lambda e: F.transform(J.items(e["value"]), lambda n: F.struct(e["key"].alias("kind"), n.alias("number"), F.when(e["key"] == "CELEX", n).otherwise(J.to_celex(e["key"], n)).alias("celex")))))
    return F.struct(
        F.array_distinct(F.filter(F.transform(numbers, lambda n: n["celex"]), lambda x: x.isNotNull())).alias("resolved"),
        F.array_distinct(F.transform(F.filter(numbers, lambda n: n["celex"].isNull()), lambda n: F.concat_ws(" ", n["kind"], n["number"]))).alias("unresolved"),
    )


def organiser_countries(c: Column, first: bool = False) -> Column:
    """Countries of a JSON object country -> people; with `first` the first of them alone."""
    keys = F.map_keys(J.pairs(c))
    return F.slice(keys, 1, 1) if first else keys


def signed_duration(days: Column) -> Column:
    """A duration in words, with its sign; N/A where there is none."""
    return F.when(days.isNull(), "N/A").when(days < 0, F.concat(F.lit("- "), D.duration_text(days))).otherwise(D.duration_text(days))


def any_date(c: Column) -> Column:
    """dd/MM/yyyy, else any other form that is read as a date."""
    return F.coalesce(D.registry_date(c), D.parsed(c))


def any_dates(*names: str) -> dict[str, Column]:
    """Date columns of these names, for withColumns."""
    return {c: any_date(F.col(c)) for c in names}


def date_from_groups(c: Column, pattern: str, order: Sequence[int] = (3, 2, 1)) -> Column:
    """yyyy-MM-dd from a pattern's groups (of year, month, day), zero-padded and not checked; null without a match."""
    parts = [F.lpad(F.regexp_extract(c, pattern, g), n, "0") for g, n in zip(order, (4, 2, 2), strict=True)]
    return F.when(F.rlike(c, F.lit(pattern)), F.concat_ws("-", *parts))
