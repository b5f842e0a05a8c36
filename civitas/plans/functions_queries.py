"""Scalar functions applied to whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from civitas.functions import dates as D, fixed_values as V, json_ops as J, text as T
from civitas.plans.analyses import query
from civitas.sources.shared import spread

LADDER = T.StatusLadder()

TOPICS = {"Food": ("almond", "lemon", "th"), "Colour": ("blue", "green", "ing"), "Metal": ("steel", "copper", "ent")}


@query("normalized_documents", r"SELECT doc_id, md5(trim(regexp_replace(lower(text), '\s+', ' ', 'g'))) AS digest FROM documents")
def normalized_documents(t):
    return t.documents.select("doc_id", F.md5(T.comparable(F.col("text"))).alias("digest"))


@query("leading_punctuation", r"SELECT doc_id, length(regexp_replace(',; ' || text, '^[.,;:•\n\r\t ]+', '')) AS n FROM documents")
def leading_punctuation(t):
    return t.documents.select("doc_id", F.char_length(T.without_leading_punctuation(F.concat(F.lit(",; "), F.col("text")))).cast("long").alias("n"))


@query("url_free_length", r"SELECT doc_id, length(regexp_replace(regexp_replace(text, 'https?://\S+', '', 'g'), '\bwww\.\S+', '', 'g')) AS n FROM documents")
def url_free_length(t):
    return t.documents.select("doc_id", F.char_length(T.without_urls(F.col("text"))).cast("long").alias("n"))


@query(
    "topics",
    "SELECT doc_id, CASE WHEN len(c) = 0 THEN 'Other' ELSE array_to_string(c, '|') END AS topics, CASE WHEN len(c) = 0 THEN 'Other' ELSE c[1] END AS first_topic FROM (SELECT doc_id, list_filter(["
    + ", ".join(f"CASE WHEN {' OR '.join(f'''contains(lower(text), '{w}')''' for w in words)} THEN '{k}' END" for k, words in TOPICS.items())
    + "], lambda x: x IS NOT NULL) AS c FROM documents)",
)
def topics(t):
    own = T.categories(F.col("text"), TOPICS)
    return t.documents.select("doc_id", F.array_join(own, "|").alias("topics"), F.element_at(own, 1).alias("first_topic"))


@query(
    "status_clean",
    r"SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'Verification' WHEN o_orderstatus = 'F' THEN 'Closed Case' ELSE 'Open Case' END AS status FROM orders",
)
def status_clean(t):
    raw = F.when(F.col("o_orderstatus") == "P", "in  VERIFICATION stage").when(F.col("o_orderstatus") == "F", " closed \n case ").otherwise("open   case")
    return t.orders.select("o_orderkey", T.clean_status(raw).alias("status"))


@query(
    "numbers_with_separators",
    "SELECT o_orderkey, round(o_totalprice, 2) AS plain, round(floor(o_totalprice), 1) AS whole, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders",
)
def numbers_with_separators(t):
    shown = F.format_number("o_totalprice", 2)
    whole = F.format_number(F.floor("o_totalprice"), 0)
    return t.orders.select("o_orderkey", T.number(shown).alias("plain"), T.first_integer(F.concat(F.lit("about "), whole)).cast("double").alias("whole"), T.year_in(F.date_format("o_orderdate", "'on 'dd/MM/yyyy")).alias("y"))


@query("correlation_labels", "SELECT CASE WHEN d >= 0.08 THEN 'very strong' WHEN d >= 0.06 THEN 'strong' WHEN d >= 0.04 THEN 'moderate' WHEN d >= 0.02 THEN 'weak' ELSE 'very weak' END AS label, count(*) AS n FROM (SELECT l_discount d FROM lineitem) GROUP BY 1")
def correlation_labels(t):
    return t.lineitem.groupBy(T.correlation_label(F.round(F.col("l_discount") * 10, 6)).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "short_numbers",
    """WITH c AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS n FROM orders), r AS (SELECT *, (n + 5000000) // 10000000 AS m, (n + 5000) // 10000 AS k FROM c)
SELECT o_orderkey, CASE WHEN n >= 100000000 THEN (m // 10) || '.' || (m % 10) || 'M' WHEN n >= 100000 THEN (k // 10) || '.' || (k % 10) || 'K' ELSE CAST((n + 50) // 100 AS VARCHAR) END AS shown FROM r""",
)
def short_numbers(t):
    """Halves are rounded up, in the cents that the prices are given in."""
    return t.orders.select("o_orderkey", T.short_number(F.col("o_totalprice")).alias("shown"))


@query("dates_parsed", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS named, strftime(o_orderdate, '%Y-%m-%d') AS slashed, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_first, strftime(last_day(o_orderdate), '%Y-%m-%d') AS month_end, strftime(o_orderdate, '%Y') || '-12-31' AS year_end FROM orders")
def dates_parsed(t):
    d = F.col("o_orderdate")
    text = lambda c: c.cast("string")
    return t.orders.select(
        "o_orderkey", text(D.parsed(F.date_format(d, "d MMMM yyyy"))).alias("named"), text(D.registry_date(F.date_format(d, "dd/MM/yyyy"))).alias("slashed"), text(D.parsed(F.date_format(d, "MMMM yyyy"))).alias("month_first"),
        text(D.parsed_end(F.date_format(d, "MMMM yyyy"))).alias("month_end"), text(D.parsed_end(F.concat(F.lit("end of "), F.date_format(d, "yyyy")))).alias("year_end"),
    )


@query(
    "deadline_phrases",
    "SELECT o_orderkey, y || CASE o_orderkey % 6 WHEN 0 THEN '-12-31' WHEN 1 THEN '-03-31' WHEN 2 THEN '-06-20' WHEN 3 THEN '-09-30' WHEN 4 THEN '-06-30' ELSE '-12-31' END AS day FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y') y FROM orders)",
)
def deadline_phrases(t):
    words = F.array(*map(F.lit, ("the end of ", "early ", "spring ", "the third quarter of ", "first half of ", "")))
    phrase = F.concat(F.get(words, (F.col("o_orderkey") % 6).cast("int")), F.date_format("o_orderdate", "yyyy"))
    return t.orders.select("o_orderkey", D.deadline(phrase).cast("string").alias("day"))


@query("dates_shown", "SELECT o_orderkey, strftime(o_orderdate, '%d %b %Y') AS shown FROM orders")
def dates_shown(t):
    return t.orders.select("o_orderkey", D.shown(F.col("o_orderdate")).alias("shown"))


@query(
    "durations_shown",
    """WITH d AS (SELECT l_orderkey, l_linenumber, abs(datediff('day', o_orderdate, l_shipdate)) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
p AS (SELECT *, n // 365 AS y, (n % 365) // 30 AS m, (n % 365) % 30 AS k FROM d)
SELECT l_orderkey, l_linenumber, n AS days, CASE WHEN n = 0 THEN '0 days' ELSE trim(CASE WHEN y = 1 THEN '1 year ' WHEN y > 1 THEN y || ' years ' ELSE '' END || CASE WHEN m = 1 THEN '1 month ' WHEN m > 1 THEN m || ' months ' ELSE '' END || CASE WHEN k = 1 THEN '1 day' WHEN k > 1 THEN k || ' days' ELSE '' END) END AS shown FROM p""",
)
def durations_shown(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    days = F.abs(F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))).cast("long")
    return rows.select("l_orderkey", "l_linenumber", days.alias("days"), D.duration_text(days).alias("shown"))


@query("event_props", "SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1")
def event_props(t):
    k = J.parsed(F.col("props"), "struct<k:long>")["k"]
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("total"))


@query("nation_lists_exploded", "SELECT r_name, n_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def nation_lists_exploded(t):
    """Rows to JSON text and back."""
    packed = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.to_json(F.collect_list("n_name")).alias("names"))
    return packed.select("r_name", F.explode(J.items(F.col("names"))).alias("n_name"))


@query("threshold_keys", "SELECT r_name, coalesce(string_agg(n_name, ',' ORDER BY n_name) FILTER (WHERE n_nationkey * 10 >= 100), '') AS names FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def threshold_keys(t):
    value = F.struct(F.concat((F.col("n_nationkey") * 10).cast("string"), F.lit("%")).alias("percentage"))
    packed = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.map_from_entries(F.collect_list(F.struct("n_name", value))).alias("m"))
    return packed.select("r_name", F.array_join(J.keys_at_least(F.col("m"), "percentage", 100), ",").alias("names"))


@query("celex_ids", "SELECT o_orderkey, '3' || strftime(o_orderdate, '%Y') || 'L' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 4, '0') AS celex, CAST(year(o_orderdate) AS INTEGER) AS year, 'Directive' AS kind, CAST(o_orderkey % 1000 AS INTEGER) AS number FROM orders")
def celex_ids(t):
    number = F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("/"), (F.col("o_orderkey") % 1000).cast("string"), F.lit("/EU"))
    rows = t.orders.select("o_orderkey", J.to_celex(F.lit("Directive"), number).alias("celex"))
    return rows.select("o_orderkey", "celex", J.celex(F.col("celex")).alias("c")).select("o_orderkey", "celex", "c.*")


@query("action_types", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Regulation Adoption' WHEN 'P' THEN 'Directive Revision' ELSE 'Legislative Action' END AS kind FROM orders")
def action_types(t):
    text = F.when(F.col("o_orderstatus") == "F", "The Regulation was adopted").when(F.col("o_orderstatus") == "P", "a revised Directive, adopted").otherwise("nothing yet")
    return t.orders.select("o_orderkey", T.action_type(text).alias("kind"))


@query("implementation_status", "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'applicable' WHEN 1 THEN 'committed' WHEN 2 THEN 'rejected_already_covered' WHEN 3 THEN 'rejected_with_actions' END AS status, CASE o_orderkey % 5 WHEN 0 THEN 'Law Active' WHEN 1 THEN 'Law Promised' WHEN 2 THEN 'Rejected - Already Covered' WHEN 3 THEN 'Rejected - Alternative Actions' END AS label FROM orders")
def implementation_status(t):
    texts = F.array(*map(F.lit, ("The Regulation became  applicable in May", "the plan to table a legislative proposal by May", "no legislative proposal: existing legislation is enough", "No repeal was proposed; it will continue", "nothing of note")))
    rows = t.orders.select("o_orderkey", LADDER(F.get(texts, (F.col("o_orderkey") % 5).cast("int"))).alias("status"))
    return rows.select("o_orderkey", "status", T.status_label(F.col("status")).alias("label"))


# Passages with the status and the type of policy that they tell of.
PASSAGES = (
    ("The new rules apply from 2021, after it entered into force.", "law_active", None),
    ("The Regulation entered into force on 1 May 2020.", "in_vacatio_legis", None),
    ("It entered into force and became applicable at once.", "law_active", None),
    ("The proposal for a directive was withdrawn.", "withdrawn", None),
    ("The Directive was approved by both; a stakeholder dialogue went on.", "adopted", "Stakeholder Dialogue"),
    ("The proposal was not a new directive.", None, None),
    ("Plans for a legislative proposal, with an impact assessment.", "proposed", "Impact Assessment and Consultation"),
    ("Measures foresees the plan from May 2024; the roadmap tells.", "planned", "Policy Roadmap and Strategy"),
    ("A vision adopted in May.", None, None),
    ("The will apply clause, planned by 2025, and best practices.", "planned", None),
    ("EFSA and its workshops; funding by Horizon Europe.", None, "Scientific Activity"),
    ("It will monitor compliance.", None, "Monitoring and Enforcement"),
)


@query(
    "legislative_status",
    "SELECT o_orderkey, " + ", ".join(f"CASE o_orderkey % {len(PASSAGES)} " + " ".join(f"WHEN {i} THEN '{p[k]}'" for i, p in enumerate(PASSAGES) if p[k]) + f" END AS {name}" for k, name in ((1, "status"), (2, "policy"))) + " FROM orders",
)
def legislative_status(t):
    """The patterns look around, which the oracle's regular expressions cannot; it knows what each passage tells."""
    text = F.get(F.array(*(F.lit(p) for p, _, _ in PASSAGES)), (F.col("o_orderkey") % len(PASSAGES)).cast("int"))
    rows = spread(t.orders.select("o_orderkey"), "o_orderkey").select("o_orderkey", F.concat_ws(" ", text, F.lit("Order"), F.col("o_orderkey")).alias("text"))
    return rows.select("o_orderkey", T.first_class(F.col("text"), V.LEGISLATIVE).alias("status"), T.first_class(F.lower("text"), V.POLICY_TYPES, case_blind=False).alias("policy"))
