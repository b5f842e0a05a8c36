"""Typed records from the node tables of registry, response and follow-up pages.

Each field is a column expression over `nodes` (see civitas.sources.nodes). Clock-dependent
fields take the day they are asked for as an argument.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from civitas.functions import dates as D, fixed_values as V, text as T
from civitas.sources import nodes as N

# Timeline titles that have a column of their own.
STEPS = {
    "Registered": "timeline_registered",
    "Collection start date": "timeline_collection_start_date",
    "Collection closed": "timeline_collection_closed",
    "Verification": "timeline_verification_start",
    "Valid initiative": "timeline_verification_end",
    "Answered initiative": "timeline_response_commission_date",
}
ONGOING = ("collection start date", "collection ongoing", "collection closed", "registered", "registration", "verification", "valid initiative", "open")
SIGNATURES_TABLE = "ecl-table ecl-table--zebra ecl-u-type-paragraph"
SIGNATURES_TOTAL = "total number of signatories"
SPONSOR_HEADERS = ("name of sponsor", "amount in eur")
LISTED_LINK = "/initiatives/details/"


def has_class(n: Column, word: str) -> Column:
    return F.coalesce(F.contains(n["cls"], F.lit(word)), F.lit(False))


def paragraphs(nodes: Column) -> Column:
    return F.filter(N.texts_of(N.tagged(nodes, "p", "li")), lambda t: t != "")


def timeline(nodes: Column) -> Column:
    """array<struct<step, date>>: list items of the timeline; the date is the item's dd/mm/yyyy, if any."""
    holders = F.transform(F.filter(nodes, lambda n: (n["tag"] == "ol") & has_class(n, "timeline")), lambda n: n["idx"])
    items = T.bound(holders, lambda own: F.filter(nodes, lambda n: (n["tag"] == "li") & F.array_contains(own, n["parent"])))
    day = r"(\d{2}/\d{2}/\d{4})"
    return F.transform(items, lambda n: F.struct(T.normalized(F.regexp_replace(n["text"], day, "")).alias("step"), F.nullif(F.regexp_extract(n["text"], day, 1), F.lit("")).alias("date")))


def current_status(nodes: Column) -> Column:
    day = r"\d{2}/\d{2}/\d{4}"
    now = F.filter(nodes, lambda n: (n["tag"] == "li") & has_class(n, "--current"))
    return T.normalized(F.regexp_replace(F.try_element_at(now, F.lit(1))["text"], day, ""))


def final_outcome(status: Column) -> Column:
    """The outcome that a timeline's current step means; null for an ongoing or unknown one."""
    low = F.lower(F.trim(status))
    return (
        F.when(F.contains(low, F.lit("answered")) & F.contains(low, F.lit("initiative")), "Commission Response")
        .when(F.contains(low, F.lit("withdrawn")), "Withdrawn")
        .when(F.contains(low, F.lit("unsuccessful")) & F.contains(low, F.lit("collection")), "Unsuccessful Collection")
    )


def is_unknown_status(status: Column) -> Column:
    """Whether a status is neither a final nor an ongoing one."""
    return status.isNotNull() & final_outcome(status).isNull() & ~T.contains_any(F.lower(status), ONGOING)


def cells_of(nodes: Column, table: Column) -> Column:
    """Texts of the data cells of each row of a table; of all rows of the page where there is no such table."""

    def rows(scope: Column) -> Column:
        return bound_rows(N.tagged(scope, "td"), N.tagged(scope, "tr"))

    def bound_rows(cells: Column, trs: Column) -> Column:
        return T.bound(cells, lambda own: F.transform(trs, lambda r: N.texts_of(F.filter(own, lambda c: c["parent"] == r["idx"]))))

    return T.bound(table, lambda t: T.bound(F.when(t.isNotNull(), N.inside(nodes, t)).otherwise(nodes), rows))


def signature_rows(nodes: Column) -> Column:
    """Rows of the table of signatures: the striped one, else the first with the class of tables."""
    table = N.first(N.tagged(nodes, "table"), lambda t: t["cls"] == SIGNATURES_TABLE, lambda t: N.has_token(t, "ecl-table"))
    return cells_of(nodes, table)


def is_total(row: Column) -> Column:
    return F.contains(F.lower(F.get(row, 0)), F.lit(SIGNATURES_TOTAL))


def signatures(nodes: Column) -> Column:
    """array<struct<country, statements_of_support, threshold, percentage>> of rows of four cells, without the total."""
    rows = F.filter(signature_rows(nodes), lambda r: (F.size(r) == 4) & (F.get(r, 0) != "") & ~is_total(r))
    return F.transform(rows, lambda r: F.struct(r[0].alias("country"), r[1].alias("statements_of_support"), r[2].alias("threshold"), r[3].alias("percentage")))


def signatures_total(nodes: Column) -> Column:
    """The number in the row of the total, without blanks; failing that, the digits of the page's counter."""
    total = F.filter(signature_rows(nodes), lambda r: (F.size(r) >= 2) & is_total(r) & F.rlike(F.get(r, 1), F.lit(r"^[\d,\s]+$")))
    counter = F.regexp_replace(N.first(nodes, lambda n: N.has_token(n, "ecl-counter__value"))["text"], r"\D", "")
    return F.coalesce(F.replace(F.try_element_at(total, F.lit(1))[1], F.lit(" "), F.lit("")), F.nullif(counter, F.lit("")))


def sponsors(nodes: Column) -> Column:
    """array<struct<name_of_sponsor, date, amount_in_eur>> of rows of three cells; footnote marks are dropped.

    Of the table whose headers tell sponsors and amounts; on a page without such headers, of rows that end with an amount.
    """
    heads = lambda t: F.lower(F.array_join(N.texts_of(F.filter(N.inside(nodes, t), lambda h: h["tag"] == "th")), " "))
    table = N.first(N.tagged(nodes, "table"), lambda t: T.contains_all(heads(t), SPONSOR_HEADERS))
    rows = T.bound(table, lambda t: F.filter(cells_of(nodes, t), lambda r: (F.size(r) == 3) & (t.isNotNull() | F.rlike(F.get(r, 2), F.lit(r"\d")))))
    return F.transform(rows, lambda r: F.struct(F.trim(F.regexp_replace(r[0], r"\s*\[\d+\]\s*", "")).alias("name_of_sponsor"), r[1].alias("date"), F.regexp_replace(r[2], r"[^\d.,]", "").alias("amount_in_eur")))


def funding_total(nodes: Column) -> Column:
    """The euro amount of the paragraph that tells the total of support and funding."""
    told = F.filter(N.texts_of(N.tagged(nodes, "p")), lambda t: F.contains(F.lower(t), F.lit("total amount of support and funding")))
    return F.nullif(F.regexp_extract(F.try_element_at(told, F.lit(1)), r"€\s?([\d,]+\.?\d*)", 1), F.lit(""))


def verification_end(steps: Column) -> Column:
    """The date of the last step about the initiative after Verification that no answer precedes, or that is the last of all.

    Where there is none, that of `Valid initiative`.
    """
    names = F.transform(steps, lambda s: s["step"])
    ends = F.struct(F.array_position(names, "Verification").alias("checked"), F.array_position(names, "Answered initiative").alias("answered"), F.size(steps).alias("n"))
    placed = F.transform(steps, lambda s, i: F.struct((i + 1).alias("i"), s["step"].alias("step"), s["date"].alias("date")))

    def good(e: Column) -> Column:
        return F.filter(placed, lambda s: F.contains(F.lower(s["step"]), F.lit("initiative")) & (e["checked"] > 0) & (s["i"] > e["checked"]) & ((e["answered"] == 0) | (s["i"] < e["answered"]) | (s["i"] == e["n"])))

    return F.when(T.bound(ends, lambda e: F.size(good(e))) > 0, F.element_at(T.bound(ends, good), -1)["date"]).otherwise(D.step_date(F.reverse(steps), "Valid initiative"))


def organisers(nodes: Column) -> Column:
    """struct<legal_entity, representative, substitute, members>; null on a page without the section.

    People are list items under the heading of their role; representatives are counted by country of residence.
    """
    there = F.exists(nodes, lambda n: (n["tag"] == "h2") & F.rlike(n["text"], F.lit(r"(?i)organisers\s*$")))

    def under(heading: str) -> Column:
        return F.filter(N.texts_of(N.tagged(N.section(nodes, F.lit(rf"(?i)^\s*{heading}\s*$"), ("h2", "h3", "h4")), "li")), lambda t: t != "")

    people = lambda items: F.size(items).cast("long").alias("number_of_people")
    entity = F.try_element_at(under("Legal entity created for the purpose of managing the initiative"), F.lit(1))
    seat = F.split(entity, "Country of the seat:", 2)
    chosen = under("Representatives?")
    lands = F.filter(F.transform(chosen, lambda t: F.trim(F.regexp_extract(t, r"Country of residence[:\s]+([A-Za-z\s]+)", 1))), lambda c: c != "")
    by_land = T.bound(lands, lambda own: F.map_from_entries(F.transform(F.array_distinct(own), lambda c: F.struct(c, F.size(F.filter(own, lambda x: x == c)).cast("long")))))
    return F.when(
        there,
        F.struct(
            F.struct(F.trim(F.get(seat, 0)).alias("name"), F.trim(F.get(seat, 1)).alias("country_of_residence")).alias("legal_entity"),
            F.struct(people(chosen), by_land.alias("countries_of_residence")).alias("representative"),
            F.struct(people(under("Substitutes?"))).alias("substitute"),
            F.struct(people(under("Members"))).alias("members"),
        ),
    )


def organiser_columns(found: Column) -> list[Column]:
    """The three JSON columns of organisers; null without the section."""
    others = F.struct(found["substitute"].alias("substitute"), found["members"].alias("members"))
    shown = {"organizer_representative": found["representative"], "organizer_entity": found["legal_entity"], "organizer_others": others}
    return [F.when(found.isNotNull(), F.to_json(v)).alias(k) for k, v in shown.items()]


def languages(nodes: Column) -> Column:
    codes = F.transform(N.links(nodes, href=r"_[a-z]{2}(?:\.html)?$"), lambda h: F.regexp_extract(h, r"_([a-z]{2})(?:\.html)?$", 1))
    return F.array_join(F.array_sort(F.array_distinct(codes)), ",")


def title(nodes: Column) -> Column:
    return F.coalesce(N.meta(nodes, "dcterms.title"), N.first_text(nodes, "h1"))


def registry_record(pages: DataFrame, base_url: str, now: Column | None = None) -> DataFrame:
    """One row per page (file_name, nodes): the registry's fields; `parse_error` stays beside them.

    `problems` names what a page ought to have: a number, a timeline, a status that is known.
    now: what a page without a time of its own was last updated.
    """
    n = F.col("nodes")
    number = F.regexp_replace(F.regexp_extract("file_name", r"(\d{4}_\d{6})_[a-z]{2}\.html", 1), "_", "/")
    part = lambda head: N.section(n, F.lit(f"(?i)^{head}$"))
    steps = timeline(n)
    share = lambda c: F.nullif(F.regexp_extract(c["percentage"], r"([\d.]+)%", 1), F.lit("")).try_cast("double")
    reached = F.size(F.filter(F.col("by_country"), lambda c: F.coalesce(share(c) >= 100, F.lit(False))))
    timelines = F.exists(n, lambda x: (x["tag"] == "ol") & has_class(x, "timeline"))
    lacks = {"no registration number": number == "", "no timeline": ~timelines, "unknown status": is_unknown_status(current_status(n))}
    out = pages.withColumn("by_country", signatures(n)).withColumn("steps", steps).withColumn("organisers", organisers(n))
    return out.select(
        number.alias("registration_number"),
        title(n).alias("title"),
        F.substring(F.array_join(N.texts_of(N.tagged(part("Objectives?"), "p")), "\n"), 1, 1100).alias("objective"),
        F.nullif(F.array_join(N.texts_of(N.tagged(part("Annex"), "p", "li")), "\n"), F.lit("")).alias("annex"),
        current_status(n).alias("current_status"),
        F.concat(F.lit(f"{base_url}details/"), number, F.lit("_en")).alias("url"),
        *((verification_end(F.col("steps")) if k == "Valid initiative" else D.step_date(F.reverse("steps"), k)).alias(c) for k, c in STEPS.items()),
        *organiser_columns(F.col("organisers")),
        F.to_json("steps").alias("timeline"),
        funding_total(n).alias("funding_total"),
        F.to_json(sponsors(n)).alias("funding_by"),
        signatures_total(n).alias("signatures_collected"),
        F.to_json("by_country").alias("signatures_collected_by_country"),
        F.when(F.size("by_country") > 0, reached).alias("signatures_threshold_met"),
        F.try_element_at(N.links(n, text="Commission['’]s answer and follow-up"), F.lit(1)).alias("response_commission_url"),
        final_outcome(current_status(n)).alias("final_outcome"),
        languages(n).alias("languages_available"),
        F.coalesce(N.meta(n, "dcterms.modified"), *([now] if now is not None else [])).alias("last_updated"),
        F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(True)), F.lit(k)) for k, bad in lacks.items()))).alias("problems"),
        "parse_error",
    )


# Words that make a follow-up's flags (substrings of a response page, patterns of a follow-up page),
# forms of case numbers, of legal acts and of their identifiers, and headings of a follow-up page's sections.
FOLLOWUP_WORDS = {
    "roadmap": ("roadmap",),
    "workshop": ("workshop", "conference", "scientific debate", "stakeholder meeting", "stakeholder debate", "roundtable", "symposium", "seminar"),
    "partnership": ("partnership program", "partnership plans", "public-public partnership", "european partnership for", "partnership between", "partnerships between", "support to partnerships", "cooperation programme", "collaboration programme", "joint programme", "formal partnership", "established partnership", "international partners"),
}
FOLLOWUP_PATTERNS = {
    "roadmap": (r"\broad ?maps?\b",),
    "workshop": (r"\bworkshops?\b", r"\bconferences?\b", r"\bscientific debates?\b", r"\bstakeholder (?:meeting|debate)s?\b", r"\broundtables?\b", r"\bsymposia\b", r"\bsymposiums?\b", r"\bseminars?\b"),
    "partnership": (r"\bpartnership (?:programs?|programmes?|plans?|between)\b", r"\bpublic-public partnerships?\b", r"\beuropean partnerships? for\b", r"\bpartnerships between\b", r"\bsupport to partnerships?\b", r"\b(?:cooperation|collaboration|joint) programmes?\b", r"\b(?:formal|established) partnerships?\b", r"\binternational partners?\b"),
}
CASES = {"general_court": r"\bT[-–]\d{2,6}/\d{2}\b", "court_of_justice": r"\bC[-–]\d{2,6}/\d{2}\b", "ombudsman_decisions": r"\b\d{2,4}/\d{3}\b"}
CELEX = r"CELEX[=:]\s*([0-9]{5}[A-Z]{1,2}[0-9]{4}[A-Z]?[0-9]{0,4})"
ACTS = {
    "Regulation": r"Regulation\s+\((?:EU|EC)\)\s+(?:No\.?\s*)?(\d{1,4}/\d{1,4})",
    "Directive": r"Directive\s+(\d{4}/\d{1,3}(?:/(?:EU|EC))?)",
    "Decision": r"(?:(?:Council|Commission)\s+)?Decision\s+(?:\((?:EU|EC|EEC)\)\s+)?(?:No\.?\s+)?(\d+/\d+)",
    "CELEX": CELEX,
    "Article": r"Article\s+(\d{1,3}(?:\([a-z0-9]+\))?)",
}
JOURNAL = {"legislation": "L", "information_and_notices": "C"}


def followup_flag(text: Column, kind: str, patterns: bool = False) -> Column:
    """Whether a follow-up tells of a roadmap, workshop or partnership."""
    # contains_any names the text once for every word
    return T.matches_any(F.lower(text), FOLLOWUP_PATTERNS[kind]) if patterns else T.bound(F.lower(text), lambda low: T.contains_any(low, FOLLOWUP_WORDS[kind]))


def _some(values: Column) -> Column:
    return F.when(F.size(values) > 0, values)


def court_cases(text: Column) -> Column:
    """struct of ordered distinct case numbers by court; courts without any are null, and so is a text without any."""
    found = F.struct(*(F.array_distinct(F.regexp_extract_all(text, F.lit(p), F.lit(0))).alias(k) for k, p in CASES.items()))
    return T.bound(found, lambda own: F.when(sum((F.size(own[k]) for k in CASES), F.lit(0)) > 0, F.struct(*(_some(own[k]).alias(k) for k in CASES))))


def legislation_by_id(text: Column, hrefs: Column) -> Column:
    """struct of identifiers in a text and in the (decoded) targets of links; kinds without any are null."""
    plain = lambda h: F.regexp_replace(F.regexp_replace(F.regexp_replace(h, "(?i)%3A", ":"), "(?i)%2F", "/"), "(?i)%3D", "=")
    # targets are decoded once, and only those and texts are searched that hold a word of what is looked for
    decoded = F.transform(hrefs, lambda h: F.when(F.contains(h, F.lit("%")), plain(h)).otherwise(h))
    none = F.array().cast("array<string>")

    def of(text: Column, low: Column, decoded: Column) -> Column:
        having = lambda word: F.filter(decoded, lambda h: F.contains(F.lower(h), F.lit(word)))
        told = lambda form, own: F.filter(F.transform(own, lambda h: F.regexp_extract(h, f"(?i){form}", 1)), lambda x: x != "")
        found = {k: F.when(~F.contains(low, F.lit(k.lower())), none).otherwise(F.regexp_extract_all(text, F.lit(f"(?i){p}"), F.lit(1))) for k, p in ACTS.items()}
        found["CELEX"] = F.concat(found["CELEX"], told(CELEX, having("celex")))
        issues = {k: told(rf"uri=uriserv:OJ\.{v}_\.(\d{{4}}\.\d{{1,3}})\.\d{{2}}\.\d{{4}}", having("uriserv")) for k, v in JOURNAL.items()}
        issues = F.struct(*(_some(F.array_distinct(F.transform(v, lambda x: F.replace(x, F.lit("."), F.lit(", "))))).alias(k) for k, v in issues.items()))
        journal = T.bound(issues, lambda i: F.when(F.coalesce(*(i[k] for k in JOURNAL)).isNotNull(), F.struct(*(i[k].alias(k) for k in JOURNAL))))
        kinds = F.struct(*(F.array_distinct(v).alias(k) for k, v in found.items()))
        return T.bound(kinds, lambda own: F.struct(*(_some(own[k]).alias(k) for k in found), journal.alias("official_journal")))

    return T.bound(F.struct(text.alias("text"), F.lower(text).alias("low"), decoded.alias("decoded")), lambda x: of(x["text"], x["low"], x["decoded"]))


def content(nodes: Column, heading: str, tags: tuple[str, ...] = ("p", "li")) -> Column:
    """Texts of a section's elements, empty ones left out: what `folded` and `any_of` go over."""
    return F.filter(N.texts_of(N.tagged(N.section(nodes, F.lit(heading)), *tags)), lambda t: t != "")


def folded(texts: Column, f) -> Column:
    """All results of f (a column of an array) over the elements of a section."""
    return F.flatten(F.transform(texts, f))


def any_of(texts: Column, test) -> Column:
    return F.exists(texts, test)


# How a submission tells of the meeting, the hearing and the debate, and an answer from when a law applies.
MET = ("organisers met with", "organisers were given the opportunity")
MET_WHOM = ("Vice-President", "Commissioner", "officials")
MET_ON = rf"(?i)on\s+(\d{{1,2}}\s+{D.MONTH}\s+\d{{4}}|\d{{2}}/\d{{2}}/\d{{4}})"
MET_WITH = (rf"(?i)met with\s+(.+?)\s+on\s+(?:\d{{1,2}}\s+{D.MONTH}\s+\d{{4}}|\d{{2}}/\d{{2}}/\d{{4}})", r"(?i)meeting with\s+(.+?)\s+and European Commission officials")
TITLES = r"\s+and\s+(?:the\s+)?(?=(?:Executive\s+)?Vice-President|Commissioner|Director-General|Deputy\s+Director-General)"
DEBATED = ("initiative was debated at the European Parliament", "debate on this initiative was held in the plenary session")
APPLICABLE_ON = (r"became applicable.*?on\s+", r"applicable from\s+", r"applies from\s+", r"apply from\s+")


def _meeting(texts: Column) -> Column:
    good = lambda t: T.contains_any(t, MET) & F.contains(t, F.lit("Commission")) & T.contains_any(t, MET_WHOM)
    return F.filter(texts, good)


def meeting_date(texts: Column) -> Column:
    """The day of the meeting with the Commission, from the paragraphs of a submission."""
    days = F.filter(F.transform(_meeting(texts), lambda t: D.parsed(F.regexp_extract(t, MET_ON, 1))), lambda d: d.isNotNull())
    return F.try_element_at(days, F.lit(1)).cast("string")


def officials_met(texts: Column) -> Column:
    """Names and titles of the Commission's people at the meeting, joined by `; `."""
    def named(t: Column) -> Column:
        who = F.coalesce(*(T.filled(F.trim(F.regexp_extract(t, p, 1))) for p in MET_WITH))
        who = F.regexp_replace(F.regexp_replace(who, r"(?i)^(?:(?:the\s+)?European\s+)?Commission\s+", ""), r"\bFirst\s+Vice-President\b", "Vice-President")
        return F.array_join(F.filter(F.transform(F.split(who, TITLES), lambda x: F.regexp_replace(F.trim(x), ",+$", "")), lambda x: x != ""), "; ")

    return F.nullif(F.try_element_at(F.filter(F.transform(_meeting(texts), named), lambda x: x.isNotNull()), F.lit(1)), F.lit(""))


def paragraph_links(nodes: Column, paragraphs: Column, phrases: tuple[str, ...], lower: bool = True) -> Column:
    """Link text -> target of a paragraph with one of the phrases; of repeated texts the last stays.

    Lower-cased: of the first such paragraph that has links. As it stands: of the first such paragraph, null if it has none.
    """
    own = lambda t: F.lower(t) if lower else t
    inside = lambda p: F.filter(N.inside(nodes, p), lambda a: (a["tag"] == "a") & (a["href"] != "") & (a["text"] != ""))
    told = F.transform(F.filter(paragraphs, lambda p: T.bound(own(p["text"]), lambda t: T.contains_any(t, phrases))), inside)
    first = F.try_element_at(F.filter(told, lambda a: F.size(a) > 0) if lower else told, F.lit(1))
    return T.bound(first, lambda a: F.when(F.size(a) > 0, N.link_map(a, lower)))


def applicable_date(texts: Column, applicable: Column) -> Column:
    """When a law applies, told by an answer that makes it applicable: the first in the order of its paragraphs."""
    day = r"(\d{1,2}\s+[A-Za-z]+\s+\d{4})"
    when = lambda t, p: D.parsed(T.filled(F.regexp_extract(t, f"(?i){p}{day}", 1)))

    def told(t: Column) -> Column:
        at_once = F.when(F.contains(F.lower(t), F.lit("became applicable immediately")), when(t, r"entered into force on\s+"))
        return F.coalesce(at_once, *(when(t, p) for p in APPLICABLE_ON))

    return F.when(applicable, F.try_element_at(F.filter(F.transform(texts, told), lambda d: d.isNotNull()), F.lit(1)).cast("string"))


def guarded(records: DataFrame, responses: DataFrame, key: str = "registration_number") -> tuple[DataFrame, DataFrame]:
    """Follow-up records whose number is known, and the others."""
    return records.join(responses, key, "left_semi"), records.join(responses, key, "left_anti")


def with_metadata(records: DataFrame, listing: DataFrame, key: str = "registration_number") -> DataFrame:
    """Records with the listing's other columns, where it has the number."""
    return records.join(listing, key, "left")


def listed(n: Column, pieces: Column, block: tuple[str, ...] = ("ecl-content-block", "ecl-content-item__content-block"), title: str = "ecl-content-block__title", label: str = "ecl-content-block__secondary-meta-label") -> Column:
    """array<struct<href, current_status, registration_number, signature_collection>>: the content blocks of a listing page.

    The link is the first below the block's title, and one to an initiative, or the block is left out;
    labels are the block's own. What no label tells is empty.
    """

    def one(b: Column) -> Column:
        return T.bound(N.inside(n, b), of_block)

    def of_block(own: Column) -> Column:
        titles = F.filter(own, lambda x: (x["tag"] == "div") & N.has_token(x, title))
        href = T.bound(titles, lambda t: N.first(own, lambda x: (x["tag"] == "a") & N.has_token(x, "ecl-link") & N.is_inside(x, t)))["href"]
        told = F.transform(F.filter(own, lambda x: (x["tag"] == "span") & N.has_token(x, label)), lambda x: N.tight(pieces, x))
        return T.bound(told, lambda labels: of_labels(href, labels))

    def of_labels(href: Column, labels: Column) -> Column:
        last = lambda test, cut: F.coalesce(F.try_element_at(F.transform(F.filter(labels, test), cut), F.lit(-1)), F.lit(""))
        after = lambda name: last(lambda t: F.startswith(t, F.lit(name)), lambda t: F.trim(F.replace(t, F.lit(name), F.lit(""))))
        others = lambda t: F.contains(F.lower(t), F.lit("signature collection")) & ~F.startswith(t, F.lit("Current status:")) & ~F.startswith(t, F.lit("Registration number:"))
        return F.struct(href.alias("href"), after("Current status:").alias("current_status"), after("Registration number:").alias("registration_number"), last(others, F.trim).alias("signature_collection"))

    blocks = F.filter(n, lambda x: (x["tag"] == "div") & N.has_token(x, block[0]) & N.has_token(x, block[1]))
    return F.filter(F.transform(blocks, one), lambda r: F.startswith(r["href"], F.lit(LISTED_LINK)))


def listing_rows(pages: DataFrame, base_url: str = "", page: str | None = None, blocks: Column | None = None, **forms) -> DataFrame:
    """One row per content block of listing pages: url, current_status, registration_number, signature_collection.

    page: a column of the pages to bring along, as `page`; blocks: the blocks of each page, where they
    are read already (`listed`); forms: classes of blocks, titles and labels, as `listed` takes them.
    """
    found = listed(F.col("nodes"), F.col("pieces"), **forms) if blocks is None else blocks
    rows = pages.select(*([F.col(page).alias("page")] if page else []), F.explode(found).alias("b"))
    return rows.select(F.concat(F.lit(base_url), F.col("b.href")).alias("url"), "b.current_status", "b.registration_number", "b.signature_collection", *(["page"] if page else []))


def next_page(nodes: Column) -> Column:
    """The target of a listing page's link to the next one."""
    items = F.filter(nodes, lambda x: (x["tag"] == "li") & N.has_token(x, "ecl-pagination__item--next"))
    return T.bound(items, lambda own: N.first(nodes, lambda x: (x["tag"] == "a") & x["href"].isNotNull() & N.is_inside(x, own)))["href"]


def response_links(pages: DataFrame, *more: Column) -> DataFrame:
    """registration_number and url of the answer, of the registry pages (file_name, nodes) that link to one.

    more: further fields of the same page, where no listing is to be joined for them (`with_metadata`).
    """
    url = F.try_element_at(N.links(F.col("nodes"), text="answer and follow-up"), F.lit(1))
    number = F.regexp_replace(F.regexp_extract("file_name", r"(\d{4}_\d{6})_[a-z]{2}\.html", 1), "_", "/")
    return pages.select(number.alias("registration_number"), url.alias("url"), *more).where("url IS NOT NULL")
