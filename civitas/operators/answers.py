"""Records of response pages and of follow-up pages.

Sections are intervals of the node table: what stands after a heading on its own level, up to the heading
that ends it, without file boxes. Every field is a column expression over `nodes` and `pieces`
(see civitas.sources.nodes). Fields that cannot be told are null; `problems` names those that a page
ought to have, and `quarantined` parts the records by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from civitas.functions import dates as D, fixed_values as V, text as T
from civitas.operators import pages as P
from civitas.operators.legislation import legislation_by_name
from civitas.sources import nodes as N

# Ids and words of headings, classes of widgets, forms of documents' names and targets, phrases before dates.
SUBMISSION, ANSWER, FOLLOWUP, UPDATES = "Submission-and-examination", "Answer-of-the-European-Commission", "Follow-up", "Updates-on-the-Commissions-proposals"
RESPONSE, FILE_BOX, SHARE_BOX, MAIN_HEADING = "response-of-the-commission", "ecl-file", "ecl-social-media-share__description", "ecl-u-type-heading-2"
FOLLOWUP_STOPS = ("related-links", "press-release", "video")
DOCUMENT_NAMES = r"(?i)^\s*(?:Communication|Annex(?:es)?|Staff Working Document|SWD)\s*$"
DOCUMENT_LINKS = r"(?i)^(?:Communication|Annex|Annexes)$"
DOCUMENT_TARGETS = r"(?i)ec\.europa\.eu/(?:transparency/documents-register|commission/presscorner)"
OWN_PAGES = r"^https?://[^/]+/(?:public/initiatives/successful/details/\d{4}/\d{6}(?:_[a-z]{2})?|initiatives/details/\d{4}/\d{6}_?[a-z]{2})/?$"
LAW_TARGETS = ("eur-lex", "europa.eu")
ADOPTED_ON = r"(?i)(?:Commission adopted a Communication on|Communication adopted on)\s+"
SUBMITTED_ON = r"(?i)submitted to the (?:European )?Commission on "
PLENARY_ON = r"(?i)plenary session\s+(?:of\s+the\s+)?(?:European\s+Parliament\s+)?on\s+"
HEARINGS = ("public hearing took place", "public hearing at the european parliament", "presentation of this initiative in a public hearing", "public hearing")
PARTNER_HEADINGS = (FOLLOWUP, "Answer of the European Commission", "Commission Response", "Commission's response", "European Commission's response")
INTRODUCTIONS = ("provides regularly updated information", "provides information on the follow-up", "this section provides")
PART_HEADINGS = ("transparency and benchmarking:",)
NO_REASON = "The Commission decided not to make a legislative proposal."
ACTION_DATES = (rf"(?i)(\d{{1,2}}\s+{D.MONTH}\s+\d{{4}})", rf"(?i)(?:in|by|from)\s+({D.MONTH}\s+\d{{4}})", r"(\d{1,2}/\d{1,2}/\d{4})", r"(\d{4}-\d{2}-\d{2})")


# Sections


def headed(nodes: Column, *ids: str, words: str | None = None, tag: str = "h2") -> Column:
    """The heading of the first of some ids that is there, else the first whose text has a pattern."""
    of = lambda i: lambda n: n["id"] == i
    return N.first(N.tagged(nodes, tag), *map(of, ids), *([lambda n: F.rlike(n["text"], F.lit(words))] if words else []))


def is_box(n: Column) -> Column:
    return (n["tag"] == "div") & N.has_token(n, FILE_BOX)


def blocks(nodes: Column, heading: Column, stop=lambda n: n["tag"] == "h2") -> Column:
    """The elements of a heading's section, without file boxes."""
    return F.filter(N.until(N.siblings(nodes, heading), stop), lambda n: ~is_box(n))


def lines(nodes: Column, elements: Column, *loose: str) -> Column:
    """Elements of some kinds, and the items of lists, in order."""
    own = lambda e: F.filter(nodes, lambda n: (n["parent"] == e["idx"]) & (n["tag"] == "li"))
    return F.flatten(F.transform(F.filter(elements, lambda e: e["tag"].isin("ul", "ol", *loose)), lambda e: F.when(e["tag"].isin("ul", "ol"), own(e)).otherwise(F.array(e))))


def around(nodes: Column, n: Column, tag: str = "div") -> Column:
    """The innermost element of a kind that holds another."""
    return T.bound(n["idx"], lambda at: F.try_element_at(F.filter(nodes, lambda a: (a["tag"] == tag) & (a["idx"] < at) & (a["last"] >= at)), F.lit(-1)))


def shown(pieces: Column, n: Column) -> Column:
    return T.normalized(N.spaced(pieces, n))


# The answer and its documents


def answer_text(nodes: Column, pieces: Column) -> Column:
    """The section's parts, a line each, with targets of links; file boxes and lists of documents are left out.

    Where little more than the day of the decision is told, the first paragraph of the follow-up is added.
    """
    heading = headed(nodes, ANSWER, words="Answer of the European Commission")
    is_followup = lambda n: (n["tag"] == "h2") & (F.contains(n["text"], F.lit("Follow-up")) | F.coalesce(n["id"] == FOLLOWUP, F.lit(False)))
    stop = lambda n: is_followup(n) | ((n["tag"] == "h2") & ~F.coalesce(n["id"], F.lit("")).isin("", ANSWER)) | ((n["tag"] == "h4") & F.contains(n["text"], F.lit("Follow-up")))

    def is_documents(n: Column) -> Column:
        items = F.filter(nodes, lambda i: (i["parent"] == n["idx"]) & (i["tag"] == "li"))
        return (n["tag"] == "ul") & T.bound(items, lambda own: (F.size(own) > 0) & F.forall(own, lambda i: F.rlike(N.tight(pieces, i), F.lit(DOCUMENT_NAMES))))

    def part(n: Column) -> Column:
        return F.when(n["tag"] == "a", N.marked(pieces, n)).when(n["tag"] == "li", N.item_with_targets(nodes, pieces, n)).otherwise(N.with_targets_before(nodes, pieces, n))

    def told(h: Column) -> Column:
        parts = F.transform(F.filter(blocks(nodes, h, stop), lambda n: ~is_documents(n)), part)
        return T.stripped(F.array_join(F.filter(parts, lambda x: x != ""), "\n"))

    def more(h: Column) -> Column:
        after = T.bound(N.first(N.siblings(nodes, h), stop), lambda s: F.when(is_followup(s), s))
        long = F.filter(F.transform(N.tagged(T.bound(after, lambda s: blocks(nodes, s)), "p"), part), lambda x: F.char_length(F.trim(x)) > 20)
        return F.try_element_at(long, F.lit(1))

    def meagre(x: Column) -> Column:
        plain = T.normalized(x)
        left = T.normalized(F.regexp_replace(F.regexp_replace(plain, r"(?is)Decision\s+date:.*", ""), r"(?is)Official\s+documents\s+related\s+to.*", ""))
        return (F.char_length(plain) <= 250) & F.rlike(plain, F.lit(r"(?i)Decision\s+date:")) & (F.char_length(left) < 30)

    def whole(h: Column) -> Column:
        return T.bound(told(h), lambda x: F.when(x != "", F.when(meagre(x), F.concat_ws("\n", x, more(h))).otherwise(x)))

    return F.when(heading.isNotNull(), T.bound(heading, whole))


def documents(pieces: Column, anchors: Column) -> Column:
    """array<struct<text, url>> of links to documents: distinct targets, pages of the initiative itself left out; null if none."""
    foreign = F.filter(anchors, lambda a: ~F.rlike(a["url"], F.lit(OWN_PAGES)))
    return T.bound(N.kept_first(foreign, lambda a: a["url"]), lambda x: F.when(F.size(x) > 0, x))


def paragraphs_after(nodes: Column, pieces: Column, heading: Column) -> Column:
    """array<struct<p, shown>>: the paragraphs after a heading, on its level, with their texts."""
    return F.transform(N.tagged(N.siblings(nodes, heading), "p"), lambda p: F.struct(p.alias("p"), shown(pieces, p).alias("shown")))


def paragraph_with(paragraphs: Column, pattern: str) -> Column:
    """Of paragraphs with their texts the first whose text has a pattern."""
    return F.try_element_at(F.filter(paragraphs, lambda x: F.rlike(x["shown"], F.lit(pattern))), F.lit(1))


def response_documents(nodes: Column, pieces: Column, submission: Column, after: Column | None = None) -> Column:
    """Links of the paragraph on the adopted communication, links with a document's name, links of the follow-up's paragraph on it.

    after: the paragraphs after the submission's heading, where they are read already (`paragraphs_after`).
    """
    after = paragraphs_after(nodes, pieces, submission) if after is None else after
    links_of = lambda p: F.coalesce(F.filter(N.inside(nodes, p), lambda a: a["tag"] == "a"), F.slice(nodes, 1, 0))
    of_paragraph = T.bound(paragraph_with(after, r"(?i)Commission\s+adopted\s+a\s+Communication\s+on")["p"], links_of)
    by_name = F.filter(N.tagged(nodes, "a"), lambda a: F.rlike(N.tight(pieces, a), F.lit(DOCUMENT_LINKS)))
    of_followup = T.bound(paragraph_with(paragraphs_after(nodes, pieces, headed(nodes, FOLLOWUP)), r"(?i)Communication\s+adopted\s+on")["p"], links_of)
    return documents(pieces, N.named_links(pieces, F.concat(of_paragraph, by_name, of_followup)))


def followup_documents(nodes: Column, pieces: Column) -> Column:
    """Links whose text names a communication or annex, or whose target is a register of documents or press releases."""
    pairs = F.transform(F.filter(nodes, lambda a: (a["tag"] == "a") & a["href"].isNotNull()), lambda a: F.struct(N.tight(pieces, a).alias("text"), a["href"].alias("url")))
    good = lambda a: (a["text"] != "") & (a["url"] != "") & (F.rlike(a["text"], F.lit("(?i)Communication|Annex")) | F.rlike(a["url"], F.lit(DOCUMENT_TARGETS)))
    return documents(pieces, F.filter(pairs, good))


# What is promised and done


def cleaned_deadline(c: Column) -> Column:
    """A deadline's words up to what does not belong to it; null without a year."""
    out = F.regexp_replace(F.regexp_replace(F.trim(c), r"(?i)\s+(?:to|for|in order to|with|amongst|among).*$", ""), r"[.,;]+$", "")
    return T.bound(out, lambda x: F.when(F.rlike(x, F.lit(r"\d{4}")), F.trim(x)))


def deadline_hits(texts: Column, sentences: bool = True) -> Column:
    """array<struct<day, told>>: what the patterns of deadlines find in each text, with its sentence or with the whole text."""

    def of_text(text: Column) -> Column:
        def told(hit: Column) -> Column:
            around_ = T.sentence_around(F.substring(text, F.lit(1), hit["start"]), F.substring(text, hit["start"] + 1, F.char_length(text)))
            return F.struct(cleaned_deadline(hit["group"]).alias("words"), (around_ if sentences else T.normalized(text)).alias("told"))

        def found_by(low: Column, pattern: str) -> Column:
            begun, hits = T.beginnings(pattern), T.matches(low, F.lit(pattern))
            return F.when(T.contains_any(low, begun), hits).otherwise(F.array().cast("array<struct<start:int,group:string>>")) if begun else hits

        hits = T.bound(F.replace(F.lower(text), F.lit(T.MARK), F.lit(" ")), lambda low: F.flatten(F.array(*(found_by(low, p) for p in V.DEADLINES))))
        return F.transform(hits, told)

    # words without a year are no deadline, so neither are those of a text without one
    dated_texts = F.filter(texts, lambda x: F.rlike(x, F.lit(r"\d{4}")))
    found = F.filter(F.flatten(F.transform(dated_texts, of_text)), lambda x: x["words"].isNotNull())
    days = F.transform(found, lambda x: F.struct(D.deadline(x["words"]).cast("string").alias("day"), x["told"].alias("told")))
    return F.filter(days, lambda x: x["day"].isNotNull() & x["told"].isNotNull())


def deadline_map(hits: Column) -> Column:
    """day -> what is told, joined by `; ` unless it is told already; null without any."""

    def add(acc: Column, x: Column) -> Column:
        longer = F.transform(acc, lambda a: F.when((a["day"] == x["day"]) & ~F.contains(a["told"], x["told"]), F.struct(a["day"].alias("day"), F.concat(a["told"], F.lit("; "), x["told"]).alias("told"))).otherwise(a))
        return F.when(F.exists(acc, lambda a: a["day"] == x["day"]), longer).otherwise(F.concat(acc, F.array(x)))

    folded = F.aggregate(hits, F.array().cast("array<struct<day:string,told:string>>"), add)
    return T.bound(folded, lambda x: F.when(F.size(x) > 0, F.map_from_entries(x)))


def action_date(text: Column, clauses: Column) -> Column:
    """The first date, by the order of ACTION_DATES, of the first clause that has one; failing that, of the text."""
    forms = lambda c: F.filter(F.array(*(F.regexp_extract(c, p, 1) for p in ACTION_DATES)), lambda x: x != "")
    days = F.transform(F.flatten(F.transform(F.concat(clauses, F.array(text)), forms)), D.parsed)
    return F.try_element_at(F.filter(days, lambda d: d.isNotNull()), F.lit(1)).cast("string")


def clauses_after(text: Column, status: Column) -> Column:
    """For each word of a status that occurs, the rest of its clause."""

    def after(low: Column) -> Column:
        words = F.create_map(*(x for k, own in V.LEGISLATIVE_WORDS.items() for x in (F.lit(k), F.array(*map(F.lit, own)))))
        present = F.filter(F.try_element_at(words, status), lambda w: F.contains(low, w))
        return F.transform(present, lambda w: F.regexp_extract(F.substring(text, F.position(w, low), F.char_length(text)), r"(?s)^(.*?)(?:[.;] |\z)", 1))

    return T.bound(F.lower(text), after)


def _some(items: Column) -> Column:
    return T.bound(items, lambda x: F.when(F.size(x) > 0, x))


def law_actions(nodes: Column, pieces: Column, elements: Column) -> Column:
    """array<struct<type, description, status, date, document_urls>> of elements that tell of legislation."""

    def told(n: Column) -> Column:
        def parts(t: Column) -> Column:
            status = T.first_class(t, V.LEGISLATIVE, signs=V.LEGISLATIVE_SIGNS)
            urls = F.transform(F.filter(N.inside(nodes, n), lambda a: (a["tag"] == "a") & T.contains_any(a["href"], LAW_TARGETS)), lambda a: a["href"])
            return T.bound(status, lambda s: F.when(s.isNotNull(), F.struct(T.action_type(t).alias("type"), t.alias("description"), s.alias("status"), action_date(t, clauses_after(t, s)).alias("date"), _some(urls).alias("document_urls"))))

        return T.bound(shown(pieces, n), parts)

    return F.array_compact(F.transform(elements, told))


def policy_actions(pieces: Column, elements: Column, least: int = 20) -> Column:
    """array<struct<type, description, date>> of elements that tell of other measures; headings and passages on laws are none."""

    def kind(t: Column, low: Column) -> Column:
        heading = (F.endswith(t, F.lit(":")) & (F.char_length(t) < 100)) | T.contains_any(low, PART_HEADINGS)
        some = T.matches_any(low, [p for own in V.POLICY_TYPES.values() for p in own], case_blind=False)  # most passages tell of no measure
        return F.when((F.char_length(t) >= least) & some & ~heading & ~T.matches_any(low, V.ABOUT_LAWS), T.first_class(low, V.POLICY_TYPES, case_blind=False))

    def told(n: Column) -> Column:
        return T.bound(shown(pieces, n), lambda t: T.bound(F.lower(t), lambda low: T.bound(kind(t, low), lambda k: F.struct(k.alias("type"), t.alias("description"), F.when(k.isNotNull(), action_date(t, F.array().cast("array<string>"))).alias("date")))))

    return F.filter(F.transform(elements, told), lambda a: a["type"].isNotNull())


def distinct_actions(actions: Column) -> Column:
    """Of actions equal in type, description and date the first; null without any."""
    return _some(N.kept_first(actions, lambda a: F.struct(a["type"], a["description"], F.coalesce(a["date"], F.lit("")))))


def event(text: Column) -> Column:
    return F.struct(F.transform(D.event_dates(text), lambda d: d.cast("string")).alias("dates"), text.alias("action"))


def is_event(text: Column) -> Column:
    return ~F.endswith(text, F.lit(":")) & ~T.contains_any(F.lower(text), INTRODUCTIONS)


def response_events(nodes: Column, pieces: Column, heading: Column, least: int = 30) -> Column:
    """array<struct<dates, action>> of a follow-up section: paragraphs and boxes with targets of links, and items of lists; null without the section."""
    stop = lambda n: (n["tag"] == "h2") | ((heading["tag"] == "h4") & (n["tag"] == "h4"))
    own = N.until(N.siblings(nodes, heading), stop)

    def texts(n: Column) -> Column:
        listed = F.transform(F.filter(nodes, lambda i: (i["parent"] == n["idx"]) & (i["tag"] == "li")), lambda i: shown(pieces, i))
        return F.when(n["tag"].isin("ul", "ol"), listed).otherwise(F.filter(F.array(T.normalized(N.with_targets(nodes, pieces, n))), is_event))

    told = F.flatten(F.transform(F.filter(own, lambda n: n["tag"].isin("p", "div", "ul", "ol")), texts))
    return F.when(heading.isNotNull(), F.transform(F.filter(told, lambda t: F.char_length(t) >= least), event))


def reasons(nodes: Column, pieces: Column, elements: Column, phrases: Column) -> Column:
    """Texts of paragraphs and items that hold one of some phrases, joined; null without any."""
    items = lambda n: F.filter(N.inside(nodes, n), lambda i: i["tag"] == "li")
    each = F.flatten(F.transform(F.filter(elements, lambda n: n["tag"].isin("p", "li", "ul", "ol")), lambda n: F.when(n["tag"].isin("ul", "ol"), items(n)).otherwise(F.array(n))))
    told = F.filter(F.transform(each, lambda n: N.tight(pieces, n)), lambda t: F.exists(phrases, lambda p: F.contains(F.lower(t), p)))
    return F.nullif(F.array_join(told, " "), F.lit(""))


def rejection_reason(rejected: Column, committed: Column, pieces: Column, nodes: Column, elements: Column) -> Column:
    """Why a proposal is refused: with a commitment beside it, what is said of proposals; without, what gives reasons, or that no more is said."""
    words = F.when(committed, F.array(F.lit("legislative proposal"))).otherwise(F.array(*map(F.lit, V.REASONS)))
    return F.when(rejected, F.coalesce(T.bound(words, lambda w: reasons(nodes, pieces, elements, w)), F.when(~committed, NO_REASON)))


# Records


def full_url(target: Column, base_url: str) -> Column:
    return F.when(F.startswith(target, F.lit("http")), target).when(F.startswith(target, F.lit("/")), F.concat(F.lit(base_url), target)).when(target != "", F.concat(F.lit(f"{base_url}/"), target))


def response_url(nodes: Column, base_url: str) -> Column:
    """Of the active language, of the English page, the canonical one, or the one for sharing."""
    of = lambda *tests: F.coalesce(*(F.try_element_at(F.filter(nodes, t), F.lit(1))[field] for t, field in tests))
    target = of(
        (lambda n: (n["tag"] == "a") & N.has_token(n, "ecl-site-header__language-link--active"), "href"),
        (lambda n: (n["tag"] == "a") & (n["name"] == "en"), "href"),
        (lambda n: (n["tag"] == "link") & (n["name"] == "canonical"), "href"),
        (lambda n: (n["tag"] == "meta") & (n["name"] == "og:url"), "content"),
    )
    return full_url(target, base_url)


def initiative_url(nodes: Column, base_url: str) -> Column:
    crumb = lambda n: (n["tag"] == "a") & N.has_token(n, "ecl-breadcrumb__link") & (n["text"] == "Initiative detail")
    detail = lambda n: (n["tag"] == "a") & (n["text"] != "") & F.rlike(n["href"], F.lit(r"/initiatives/details/\d{4}/\d{6}_en$")) & F.rlike(n["href"], F.lit("^(?:http|/)"))
    return full_url(N.first(nodes, crumb, detail)["href"], base_url)


def hearing_date(text: Column) -> Column:
    """The first date after the first phrase of a hearing, in the sentence that has it."""
    first = F.try_element_at(F.filter(F.split(T.comparable(text), r"(?<=[.!?])\s+"), lambda s: T.contains_any(s, HEARINGS)), F.lit(1))
    rest_of = lambda s: F.coalesce(*(F.when(F.contains(s, F.lit(p)), F.regexp_extract(s, f"^.*?{p}(.*)$", 1)) for p in HEARINGS))
    names = "|".join([*D.MONTHS, *(m[:3] for m in D.MONTHS)])
    forms = (rf"\b(\d{{1,2}}\s+(?:{names})\s+\d{{4}})\b", r"\b(\d{1,2}[/-]\d{1,2}[/-]\d{4})\b", r"\b(\d{4}[/-]\d{1,2}[/-]\d{1,2})\b")
    told = T.bound(T.bound(first, rest_of), lambda rest: F.coalesce(*(T.filled(F.regexp_extract(rest, p, 1)) for p in forms)))
    return D.parsed(F.regexp_replace(told, r"^(\d{4})/(\d{1,2})/", "$1-$2-")).cast("string")


def dated(text: Column, before: str) -> Column:
    """The date after a pattern, as day, month's name and year or with slashes."""
    forms = (r"(\d{1,2}\s+\w+\s+\d{4})", r"(\d{1,2}/\d{1,2}/\d{4})")
    told = T.bound(text, lambda t: F.coalesce(*(T.filled(F.regexp_extract(t, before + p, 1)) for p in forms)))
    return D.parsed(told).cast("string")


def registration(file_name: str = "file_name") -> Column:
    return F.nullif(F.regexp_replace(F.regexp_extract(file_name, r"(\d{4}_\d{6})_[a-z]{2}\.html$", 1), "_", "/"), F.lit(""))


def _reached(ladder: T.StatusLadder) -> list[Column]:
    """status, committed and rejected by the column `content`."""
    content, there = F.col("content"), lambda c: F.coalesce(c.isNotNull(), F.lit(False))
    return [ladder.status(content).alias("status"), there(ladder.reached(content, "committed")).alias("committed"), there(ladder.rejection(content)).alias("rejected")]


def _problems(**cases: Column) -> Column:
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(True)), F.lit(k.replace("_", " "))) for k, c in cases.items()))).alias("problems")


def response_record(pages: DataFrame, ladder: T.StatusLadder, as_of: Column, base_url: str = "https://example.org") -> DataFrame:
    """One row per page (file_name, nodes, pieces): the fields of a response page."""
    n, pieces = F.col("nodes"), F.col("pieces")
    is_answer = headed(n, ANSWER, f"{ANSWER}-and-follow-up", words="Answer of the European Commission")
    followup = F.coalesce(N.first(N.tagged(n, "h2"), lambda h: h["id"].isin(FOLLOWUP, UPDATES)), headed(n, words=r"(?i)^\s*follow-up\s*$", tag="h4"))
    out = pages.select(
        "*",
        headed(n, SUBMISSION, words="(?i)Submission and examination").alias("submission_at"),
        is_answer.alias("answer_at"),
        followup.alias("followup_at"),
        headed(n, FOLLOWUP, words="(?i)Follow[- ]up").alias("acts_at"),
        headed(n, UPDATES, words="(?i)Updates.*proposal").alias("updates_at"),
    )
    named = lambda c: F.filter(N.siblings(n, F.col(c)), lambda s: ~is_box(s) & (s["tag"] != "h2"))
    section = lambda c: F.coalesce(blocks(n, F.col(c)), F.slice(n, 1, 0))
    everything = F.array_join(N.stripped(pieces), "\n")
    out = out.select(
        "*",
        section("answer_at").alias("answer"),
        section("followup_at").alias("more"),
        N.tagged(section("submission_at"), "p").alias("asking"),
        paragraphs_after(n, pieces, F.col("submission_at")).alias("after"),
        section("acts_at").alias("acts"),
        answer_text(n, pieces).alias("answered"),
        T.comparable(F.array_join(F.transform(named("answer_at"), lambda s: N.raw(pieces, s)), " ")).alias("content"),
    )
    out = out.select(
        "*",
        F.filter(F.transform("asking", lambda p: shown(pieces, p)), lambda t: t != "").alias("asked"),
        F.filter(F.transform(lines(n, F.col("answer"), "p", "li"), lambda x: x["text"]), lambda t: t != "").alias("answer_parts"),
        F.array_join(F.transform("more", lambda x: x["text"]), " ").alias("more_text"),
        F.array_join(N.texts_of(N.tagged(n, "body")), " ").alias("page_text"),
        deadline_hits(F.transform("answer", lambda x: N.raw(pieces, x))).alias("hits"),
        *_reached(ladder),
    )
    status, committed, rejected, nothing = F.col("status"), F.col("committed"), F.col("rejected"), F.slice(n, 1, 0)
    laws = F.concat(*(F.coalesce(lines(n, c, "p", "li"), nothing) for c in (section("updates_at"), F.col("acts"), F.col("answer"))))
    others = F.concat(*(F.coalesce(lines(n, c, "p"), nothing) for c in (F.col("acts"), F.col("answer"))))
    passed = ladder.reached(F.col("content"), "applicable", "adopted").isNotNull()
    no_laws = (rejected & ~committed) | (committed & ~passed & headed(n, FOLLOWUP).isNull())
    out = out.select("*", D.harvested(F.col("more_text")).alias("dates"), F.when(~no_laws, distinct_actions(law_actions(n, pieces, laws))).alias("laws"))
    flag = lambda kind: P.followup_flag(F.col("more_text"), kind)
    partners = F.array_join(F.transform(blocks(n, F.coalesce(*(headed(n, words=w, tag=t) for w in PARTNER_HEADINGS for t in ("h2", "h4")))), lambda x: N.spaced(pieces, x)), " ")
    first_asked = F.try_element_at("after", F.lit(1))["p"]
    told_on = lambda p: paragraph_with(F.col("after"), p)["shown"]
    debated = "|".join(P.DEBATED)
    answer = F.col("answered")
    return out.select(
        registration().alias("registration_number"),
        response_url(n, base_url).alias("response_url"),
        initiative_url(n, base_url).alias("initiative_url"),
        F.nullif(F.array_join("asked", " "), F.lit("")).alias("submission_text"),
        T.bound(first_asked, lambda p: dated(N.raw(pieces, p), SUBMITTED_ON)).alias("commission_submission_date"),
        T.bound(first_asked, lambda p: F.try_element_at(N.links(N.inside(n, p), text="press|announcement|news", href=r"presscorner|europa\.eu/rapid"), F.lit(1))).alias("submission_news_url"),
        P.meeting_date(F.col("asked")).alias("commission_meeting_date"),
        P.officials_met(F.col("asked")).alias("commission_officials_met"),
        hearing_date(F.array_join("asked", " ")).alias("parliament_hearing_date"),
        F.to_json(P.paragraph_links(n, F.col("asking"), HEARINGS)).alias("parliament_hearing_video_urls"),
        dated(told_on(debated), PLENARY_ON).alias("plenary_debate_date"),
        F.to_json(P.paragraph_links(n, F.transform("after", lambda x: x["p"]), P.DEBATED, lower=False)).alias("plenary_debate_video_urls"),
        dated(told_on(ADOPTED_ON), ADOPTED_ON).alias("official_communication_adoption_date"),
        F.to_json(response_documents(n, pieces, F.col("submission_at"), F.col("after"))).alias("official_communication_document_urls"),
        answer.alias("commission_answer_text"),
        status.alias("final_outcome_status"),
        T.status_label(status).alias("final_outcome_label"),
        committed.alias("commission_promised_new_law"),
        rejected.alias("commission_rejected_initiative"),
        rejection_reason(rejected, committed, pieces, n, F.col("answer")).alias("commission_rejection_reason"),
        F.to_json(deadline_map(F.col("hits"))).alias("commission_deadlines"),
        F.to_json("laws").alias("laws_actions"),
        F.to_json(distinct_actions(policy_actions(pieces, others))).alias("policies_actions"),
        F.col("followup_at").isNotNull().alias("has_followup_section"),
        flag("roadmap").alias("has_roadmap"),
        flag("workshop").alias("has_workshop"),
        P.followup_flag(partners, "partnership").alias("has_partnership_programs"),
        P.applicable_date(F.col("answer_parts"), status == "applicable").alias("law_implementation_date"),
        F.to_json(P.court_cases(F.col("page_text"))).alias("court_cases_referenced"),
        D.latest_until(F.col("dates"), as_of).cast("string").alias("followup_latest_date"),
        F.array_max("dates").cast("string").alias("followup_most_future_date"),
        D.latest_after(F.col("dates"), as_of).cast("string").alias("followup_next_date"),
        F.try_element_at(N.links(n, text="factsheet"), F.lit(1)).alias("commission_factsheet_url"),
        F.try_element_at(N.links(n, href=r"^https://.*eci/eci-[^/]+_en$"), F.lit(1)).alias("followup_dedicated_website"),
        F.to_json(P.legislation_by_id(F.col("page_text"), N.links(n))).alias("referenced_legislation_by_id"),
        F.to_json(legislation_by_name(everything)).alias("referenced_legislation_by_name"),
        F.to_json(response_events(n, pieces, F.col("followup_at"))).alias("followup_events_with_dates"),
        _problems(no_registration_number=registration().isNull(), no_answer_section=F.col("answer_at").isNull(), empty_answer=F.col("answer_at").isNotNull() & answer.isNull(), no_status=F.col("answer_at").isNotNull() & status.isNull(), no_submission_section=F.col("submission_at").isNull()),
        "parse_error",
    )


def followup_content(nodes: Column, pieces: Column) -> Column:
    """The comparable text of a follow-up page's sections: of the boxes after each heading's own, up to one with a heading that has an id."""
    heads = (headed(nodes, RESPONSE), headed(nodes, "follow-up-on-the-commissions-actions", words="(?i)follow-up"), headed(nodes, "next-steps", words="(?i)next steps"))

    def texts(h: Column) -> Column:
        boxes = F.filter(N.siblings(nodes, around(nodes, h)), lambda s: s["tag"] == "div")
        ends = lambda s: F.coalesce(N.first(N.inside(nodes, s), lambda x: x["tag"] == "h2")["id"], F.lit("")) != ""
        later = T.bound(F.slice(boxes, 2, F.greatest(F.size(boxes), F.lit(1))), lambda rest: N.until(rest, ends))
        return F.transform(F.concat(F.slice(boxes, 1, 1), F.filter(later, lambda s: ~is_box(s))), lambda s: N.raw(pieces, s))

    every = F.flatten(F.array_compact(F.array(*(T.bound(h, texts) for h in heads))))
    return F.nullif(T.comparable(F.array_join(every, " ")), F.lit(""))


def followup_answer(nodes: Column, pieces: Column) -> Column:
    """Paragraphs and items of the box after the response's heading, with targets of links, without buttons and drawings; empty where there is none."""

    def told(h: Column) -> Column:
        box = F.try_element_at(F.filter(N.siblings(nodes, around(nodes, h)), lambda s: (s["tag"] == "div") & N.has_token(s, "ecl")), F.lit(1))
        out = F.filter(nodes, lambda x: x["tag"].isin("button", "svg"))

        def texts(b: Column) -> Column:
            return T.bound(out, lambda hidden: seen(b, hidden))

        def seen(b: Column, hidden: Column) -> Column:
            own = F.filter(N.inside(nodes, b), lambda x: x["tag"].isin("p", "li") & ~N.is_inside(x, hidden))
            shown_ = F.filter(F.transform(own, lambda x: N.with_targets(nodes, pieces, x, "button", "svg")), lambda t: t != "")
            return T.normalized(F.array_join(shown_, " "))

        return T.bound(box, texts)

    return F.coalesce(T.bound(headed(nodes, RESPONSE, words="Response of the Commission"), told), F.lit(""))


def followup_events(nodes: Column, pieces: Column) -> Column:
    """array<struct<dates, action>> of the paragraphs and items from the first main heading after the response's up to related links, press releases or videos."""
    response = headed(nodes, RESPONSE)["idx"]
    is_main = lambda n: (n["tag"] == "h2") & N.has_token(n, MAIN_HEADING)

    def told(at: Column) -> Column:
        start = N.first(nodes, lambda n: is_main(n) & (n["idx"] > at))["idx"]
        return T.bound(start, lambda s: N.until(F.filter(nodes, lambda n: n["idx"] > s), lambda n: is_main(n) & n["id"].isin(*FOLLOWUP_STOPS)))

    texts = F.transform(N.tagged(T.bound(response, told), "p", "li"), lambda n: N.linked(nodes, pieces, n))
    return F.transform(F.filter(texts, lambda t: (t != "") & is_event(t)), lambda t: event(T.normalized(t)))


def followup_record(pages: DataFrame, ladder: T.StatusLadder, as_of: Column, responses: DataFrame | None = None) -> DataFrame:
    """One row per page (file_name, nodes, pieces) of a follow-up website.

    responses (registration_number, initiative_title, followup_dedicated_website) gives title and
    address; a page whose number is not there has the problem `unknown registration number`.
    """
    n, pieces = F.col("nodes"), F.col("pieces")
    started = pages.select("*", headed(n, RESPONSE).alias("answer_at"), F.coalesce(followup_content(n, pieces), F.lit("")).alias("content"))
    after = T.bound(F.col("answer_at")["idx"], lambda at: F.filter(n, lambda x: x["idx"] > at))
    out = started.select("*", N.tagged(N.until(after, lambda x: N.has_token(x, SHARE_BOX)), "li", "p", "ol", "pre").alias("elements"))
    raws = F.transform("elements", lambda x: T.normalized(N.raw(pieces, x)))
    direct = lambda x: F.when(x["tag"].isin("p", "li"), F.array(x)).otherwise(F.filter(n, lambda c: (c["parent"] == x["idx"]) & c["tag"].isin("p", "li")))
    boxes = F.filter(N.siblings(n, around(n, F.col("answer_at"))), lambda s: ~is_box(s))
    out = out.select(
        "*",
        raws.alias("texts"),
        F.flatten(F.transform("elements", direct)).alias("own"),
        N.until(boxes, lambda s: s["tag"] == "h2").alias("boxes"),
        *_reached(ladder),
        F.array_join(N.texts_of(N.tagged(n, "body")), " ").alias("page_text"),
        D.harvested(F.array_join(F.transform("elements", lambda x: N.spaced(pieces, x)), " ")).alias("dates"),
    )
    content, status = F.col("content"), F.col("status")
    inner = F.flatten(F.transform("boxes", lambda b: F.when(b["tag"] == "div", F.filter(N.inside(n, b), lambda x: x["tag"].isin("p", "li", "ul", "ol"))).otherwise(F.array(b))))
    applicable = ladder.reached(content, "applicable").isNotNull()
    flag = lambda kind: F.coalesce(F.exists("texts", lambda t: P.followup_flag(t, kind, patterns=True)), F.lit(False))
    happened = followup_events(n, pieces)
    out = out.select(
        registration().alias("registration_number"),
        followup_answer(n, pieces).alias("commission_answer_text"),
        F.to_json(followup_documents(n, pieces)).alias("official_communication_document_urls"),
        T.status_label(status).alias("final_outcome_status"),
        P.applicable_date(F.transform(F.filter(boxes, lambda b: b["tag"] == "div"), lambda b: N.raw(pieces, b)), applicable).alias("law_implementation_date"),
        F.col("committed").alias("commission_promised_new_law"),
        F.to_json(deadline_map(deadline_hits(F.col("texts"), sentences=False))).alias("commission_deadlines"),
        F.col("rejected").alias("commission_rejected_initiative"),
        rejection_reason(F.col("rejected"), F.col("committed"), pieces, n, inner).alias("commission_rejection_reason"),
        F.to_json(distinct_actions(law_actions(n, pieces, F.col("own")))).alias("laws_actions"),
        F.to_json(distinct_actions(policy_actions(pieces, F.col("own")))).alias("policies_actions"),
        flag("roadmap").alias("has_roadmap"),
        flag("workshop").alias("has_workshop"),
        flag("partnership").alias("has_partnership_programs"),
        F.to_json(P.court_cases(F.col("page_text"))).alias("court_cases_referenced"),
        D.latest_until(F.col("dates"), as_of).cast("string").alias("followup_latest_date"),
        D.latest_after(F.col("dates"), as_of).cast("string").alias("followup_most_future_date"),
        F.to_json(P.legislation_by_id(F.col("page_text"), N.links(n))).alias("referenced_legislation_by_id"),
        F.to_json(legislation_by_name(F.array_join(N.stripped(pieces), "\n"))).alias("referenced_legislation_by_name"),
        F.to_json(_some(happened)).alias("followup_events_with_dates"),
        _problems(no_registration_number=registration().isNull(), no_response_section=F.col("answer_at").isNull(), no_status=F.col("answer_at").isNotNull() & status.isNull(), no_events=F.size(happened) <= 0),
        "parse_error",
    )
    if responses is None:
        return out
    known = responses.select("registration_number", "initiative_title", "followup_dedicated_website", F.lit(True).alias("_known"))
    strange = F.when(F.col("_known").isNull(), F.array(F.lit("unknown registration number"))).otherwise(F.array().cast("array<string>"))
    return out.join(known, "registration_number", "left").withColumn("problems", F.concat("problems", strange)).drop("_known")


def quarantined(records: DataFrame, name: str = "records") -> tuple[DataFrame, DataFrame]:
    """Records without problems, and those with problems or a parse error, with a column `reason`.

    Either part carries an observation of its rows (`name` and `name`_rejected), read with Spark's
    listeners or DataFrame.observe; nothing is counted in a pass of its own.
    """
    bad = (F.size("problems") > 0) | F.col("parse_error").isNotNull()
    count = F.count(F.lit(1)).alias("rows")
    good = records.where(~bad).drop("problems", "parse_error")
    rest = records.where(bad).withColumn("reason", F.concat_ws("; ", F.col("problems"), F.col("parse_error")))
    return good.observe(name, count), rest.observe(f"{name}_rejected", count, F.count("parse_error").alias("unparsed"))
