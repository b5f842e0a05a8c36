"""Analyses of responses: records whose lists are JSON text, built from orders so that SQL can know each field."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from civitas.functions import dates as D, json_ops as J
from civitas.operators import relational as R, responses as P
from civitas.plans.analyses import query

STATUSES = ("Law Active", "Law Passed", "Law Promised", "Action Plan Created", "Being Studied", "Rejected", "Rejected - Already Covered", "Policy Changes Only")
COUNTRIES = ("Austria", "Belgium", "Cyprus", "Denmark", "Estonia", "Finland", "Germany")
POLICIES = ("Funding Programmes", "Stakeholder Dialogue", "International Cooperation", "Data Collection and Transparency")
CONTEXTS = (
    "The action was dismissed by the General Court in its judgment, and the appeal failed.",
    "The Court clarified that the right to propose legislation is not unlimited in scope.",
    "The Commission will carefully consider the judgment of the court in this matter.",
    "A court ruled.",
)
TITLES = (("2010/63/EU", "32010L0063", "Animals used for science"), (None, "32002R0178", "General food law"))
AS_OF = "1997-06-30"

# the same fields in SQL: k, the day d, the status and the days that the JSON columns tell
SQL_BASE = "b AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS d, CASE o_orderkey % 9 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(STATUSES)) + " END AS status, o_orderkey % 4 <> 3 AS collected FROM orders)"


def _pick(values, n):
    return F.get(F.array(*map(F.lit, values)), n.cast("int"))


def responses(t) -> DataFrame:
    """id, day, status, collected, and JSON columns: timeline, laws, policies, sponsors, support, organisers, legislation; deadlines, context, case_id."""
    k, d = F.col("o_orderkey"), F.to_date("o_orderdate")
    after = lambda n: F.date_add(d, n if isinstance(n, int) else n.cast("int"))
    text = lambda x: F.date_format(x, "d MMMM yyyy")
    status = F.when(k % 9 < 8, _pick(STATUSES, k % 9))
    step = lambda name, day: F.struct(F.lit(name).alias("step"), F.date_format(day, "dd/MM/yyyy").alias("date"))
    steps = F.array_compact(F.array(
        step("Registered", d), step("Collection closed", after(365 + k % 50)), step("Verification", after(420)), step("Valid initiative", after(450 + k % 40)),
        F.when(k % 3 != 0, step("Meeting with the Commission", after(480 + k % 30))), F.when(status.isNotNull(), step("Answered initiative", after(600 + k % 100))),
    ))
    law = lambda kind, state, day, told: F.struct(F.lit(kind).alias("type"), F.lit(state).alias("status"), day.cast("string").alias("date"), told.alias("description"))
    laws = F.array_compact(F.array(
        F.when(k % 3 == 0, law("Regulation Adoption", "adopted", after(700), F.concat(F.lit("The Regulation was adopted on "), text(after(650)), F.lit(".")))),
        F.when(k % 2 == 0, law("Directive Adoption", "law_active", after(900), F.concat(F.lit("It entered into force on "), text(after(800)), F.lit(" and applies from "), text(after(900)), F.lit(".")))),
        F.when(k % 5 == 0, law("Legislative Proposal", "proposed", F.lit(None), F.lit("A proposal was tabled."))),
    ))
    policy = lambda kind, told: F.struct(kind.alias("type"), F.lit(told).alias("description"))
    policies = F.array_compact(F.array(
        policy(_pick(POLICIES, k % 4), "as announced"), F.when(k % 2 == 1, policy(_pick(POLICIES, (k + 1) % 4), "as announced")),
        F.when(k % 7 == 0, policy(F.lit(POLICIES[3]), "At the same time, the Regulation will do so")), F.when(k % 11 == 0, policy(F.lit(None).cast("string"), "unnamed")),
    ))
    sponsors = F.transform(F.sequence(F.lit(0), (k % 4).cast("int")), lambda i: F.struct(
        F.concat(F.when(i % 2 == 1, "Stiftung ").otherwise("Person "), i.cast("string")).alias("name_of_sponsor"), F.format_number(1000 * i + (k % 100) + 0.5, 2).alias("amount_in_eur")
    ))
    support = F.map_from_entries(F.transform(F.array(*map(F.lit, range(3))), lambda i: F.struct(
        _pick(COUNTRIES, (k + i) % 7), F.struct(F.format_number((k * 13 + i * 977) % 50000, 0).alias("statements"), F.concat(((k * 7 + i * 31) % 160).cast("string"), F.lit(".0%")).alias("percentage"))
    )))
    organisers = F.create_map(_pick(COUNTRIES, k % 7), 1 + k % 2, _pick(COUNTRIES, (k + 3) % 7), F.lit(1).cast("long"))
    acts = F.map_from_entries(F.array_compact(F.array(
        F.when(k % 3 == 0, F.struct(F.lit("Directive"), F.array(F.lit("2010/63/EU")))), F.struct(F.lit("CELEX"), F.array(F.concat(F.lit("3200"), (k % 10).cast("string"), F.lit("L0042")))),
        F.when(k % 4 == 0, F.struct(F.lit("Regulation"), F.array(F.lit("(EC) No 178/2002")))), F.when(k % 6 == 0, F.struct(F.lit("Article"), F.array(F.lit("5")))),
    )))
    told = F.concat(F.lit('**Original Response:**\n{"1999-12-31": "first"}'), F.when(k % 2 == 1, '\n\n**Current Followup:**\n{"1998-06-30": "second", "1999-12-31": "third"}').otherwise(""))
    case = F.concat(F.lit("620"), (10 + k % 10).cast("string"), F.when(k % 2 == 1, "C").otherwise("T"), F.lit("J"), F.lpad((k % 200).cast("string"), 4, "0"))
    return t.orders.select(
        k.alias("id"), d.alias("day"), status.alias("status"), (k % 4 != 3).alias("collected"), F.to_json(steps).alias("timeline"), F.to_json(laws).alias("laws"), F.to_json(policies).alias("policies"),
        F.to_json(sponsors).alias("sponsors"), F.to_json(support).alias("support"), F.to_json(organisers).alias("organisers"), F.to_json(acts).alias("legislation"), told.alias("deadlines"),
        _pick(CONTEXTS, k % 4).alias("context"), case.alias("case_id"),
    )


LAWS = "array<struct<type:string,status:string,date:string,description:string>>"
STEPS = "array<struct<step:string,date:string>>"


def _step(name):
    return D.registry_date(D.step_date(J.parsed(F.col("timeline"), STEPS), name))


@query(
    "rn_status_repair",
    f"""WITH {SQL_BASE} SELECT id, 'adopted' AS status, strftime(d + 700, '%Y-%m-%d') AS date FROM b WHERE id % 3 = 0
UNION ALL SELECT id, CASE WHEN d + 900 <= DATE '{AS_OF}' THEN 'law_active' ELSE 'in_vacatio_legis' END, strftime(d + 900, '%Y-%m-%d') FROM b WHERE id % 2 = 0
UNION ALL SELECT id, 'proposed', NULL FROM b WHERE id % 5 = 0""",
)
def rn_status_repair(t):
    rows = responses(t).select("id", F.explode(P.updated_actions(J.parsed(F.col("laws"), LAWS), F.to_date(F.lit(AS_OF)))).alias("a"))
    return rows.select("id", "a.status", "a.date")


@query(
    "rn_outcome_taxonomies",
    f"""WITH {SQL_BASE}, l AS (SELECT unnest(['action', 'engaged', 'single', 'group', 'category', 'campaign']) AS taxonomy, unnest([
 CASE WHEN status IS NULL THEN 'Unknown' WHEN status LIKE 'Rejected%' THEN 'Rejected' WHEN status LIKE 'Law%' OR status LIKE 'Action%' THEN 'Legislative Action Taken' ELSE 'Other' END,
 CASE WHEN status IN ('Law Active', 'Law Passed') THEN 'Law Active/Passed' WHEN status LIKE 'Rejected%' THEN 'Rejected' WHEN status <> 'Policy Changes Only' THEN 'Commission Engaged' END,
 CASE WHEN status IS NULL OR status = 'Policy Changes Only' THEN 'Unsuccessful' WHEN status LIKE 'Rejected%' THEN 'Rejected' ELSE status END,
 CASE WHEN NOT collected THEN 'Unsuccessful Collection' WHEN status IS NULL THEN 'Waiting for Response' WHEN status IN ('Law Active', 'Law Passed') THEN 'Law Passed/Active' WHEN status LIKE 'Rejected%' THEN 'Rejected' ELSE 'Commission Engagement' END,
 CASE WHEN status IN ('Law Active', 'Law Passed') THEN 'Law Passed/Active' WHEN status LIKE 'Rejected%' THEN 'Rejected' WHEN status <> 'Policy Changes Only' THEN 'Commission Engagement' END,
 CASE WHEN status IS NOT NULL THEN 'Commission Response' WHEN collected THEN 'Collected Signatures' ELSE 'Unsuccessful Collection' END]) AS label FROM b)
SELECT taxonomy, label, count(*) AS n FROM l GROUP BY 1, 2""",
)
def rn_outcome_taxonomies(t):
    status, collected = F.col("status"), F.col("collected")
    labels = {k: P.outcome(status, k) for k in ("action", "engaged", "single", "category")} | {"group": P.grouped_outcome(status, collected), "campaign": P.campaign_outcome(F.when(status.isNotNull(), "Commission Response"), collected)}
    rows = responses(t).select(*(v.alias(k) for k, v in labels.items())).unpivot([], list(labels), "taxonomy", "label")
    return rows.groupBy("taxonomy", "label").agg(F.count(F.lit(1)).alias("n"))


@query("rn_waiting", f"WITH {SQL_BASE} SELECT id, datediff('day', d + 450 + CAST(id % 40 AS INTEGER), DATE '{AS_OF}') AS days FROM b WHERE collected AND status IS NULL")
def rn_waiting(t):
    """Campaigns that collected their signatures and have no response."""
    rows = responses(t)
    waiting = rows.where("collected").join(rows.where("status IS NOT NULL").select("id"), "id", "left_anti")
    return waiting.select("id", F.datediff(F.lit(AS_OF).cast("date"), _step("Valid initiative")).cast("long").alias("days"))


@query(
    "rn_response_waits",
    f"""WITH {SQL_BASE}, w AS (SELECT CASE WHEN status IN ('Law Active', 'Law Passed') THEN 'Law Active/Passed' WHEN status LIKE 'Rejected%' THEN 'Rejected' ELSE 'Commission Engaged' END AS label, 150 + id % 100 - id % 40 AS days FROM b WHERE status IS NOT NULL AND status <> 'Policy Changes Only'),
m AS (SELECT label, days, row_number() OVER (PARTITION BY label ORDER BY count(*) DESC, days) r FROM w GROUP BY 1, 2)
SELECT label, count(*) AS n, round(avg(days), 6) AS mean, min(days) AS least, max(days) AS most, (SELECT days FROM m WHERE m.label = w.label AND r = 1) AS mode_days FROM w GROUP BY label""",
)
def rn_response_waits(t):
    days = F.datediff(_step("Answered initiative"), _step("Valid initiative")).cast("long")
    rows = responses(t).select(P.outcome(F.col("status"), "engaged").alias("label"), days.alias("days")).where("label IS NOT NULL")
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("days"), 6).alias("mean"), F.min("days").alias("least"), F.max("days").alias("most"), F.mode("days", True).alias("mode_days"))


@query(
    "rn_implementation_stages",
    f"""WITH {SQL_BASE}, s AS (SELECT 'Law Passed' AS stage, CASE WHEN id % 3 = 0 THEN 700 WHEN id % 2 = 0 THEN 800 END - 600 - id % 100 AS days FROM b WHERE status IS NOT NULL
 UNION ALL SELECT 'Law Active', CASE WHEN id % 2 = 0 THEN 900 END - 600 - id % 100 FROM b WHERE status IS NOT NULL)
SELECT stage, count(days) AS n, round(avg(days), 6) AS mean, min(days) AS least, max(days) AS most FROM s GROUP BY 1""",
)
def rn_implementation_stages(t):
    actions = P.dated_actions(J.parsed(F.col("laws"), LAWS), enrich=True)
    rows = responses(t).where("status IS NOT NULL").select(actions.alias("a"), _step("Answered initiative").alias("answered"))
    first = lambda *s: F.array_min(F.transform(F.filter("a", lambda x: x["status"].isin(*s)), lambda x: x["day"]))
    since = lambda *s: F.datediff(first(*s), F.col("answered")).cast("long")
    long = rows.select(since("in_vacatio_legis", "adopted").alias("Law Passed"), since("law_active").alias("Law Active")).unpivot([], ["Law Passed", "Law Active"], "stage", "days")
    return long.groupBy("stage").agg(F.count("days").alias("n"), F.round(F.avg("days"), 6).alias("mean"), F.min("days").alias("least"), F.max("days").alias("most"))


@query(
    "rn_sponsors",
    f"""WITH {SQL_BASE}, s AS (SELECT id, CASE WHEN status IS NULL OR status = 'Policy Changes Only' THEN 'Unsuccessful' WHEN status LIKE 'Rejected%' THEN 'Rejected' ELSE status END AS label, unnest(range(0, id % 4 + 1)) AS i FROM b)
SELECT label, count(DISTINCT id) AS n, count(*) FILTER (WHERE i % 2 = 0) AS persons, count(*) FILTER (WHERE i % 2 = 1) AS organisations, round(sum(1000 * i + id % 100 + 0.5), 2) AS total, round(sum(1000 * i + id % 100 + 0.5) / count(*), 6) AS a_sponsor, round(sum(1000 * i + id % 100 + 0.5) / count(DISTINCT id), 6) AS a_campaign FROM s GROUP BY 1""",
)
def rn_sponsors(t):
    stats = J.sponsor_stats(J.parsed(F.col("sponsors"), "array<struct<name_of_sponsor:string,amount_in_eur:string>>"))
    rows = responses(t).select(P.outcome(F.col("status"), "single").alias("label"), stats.alias("s"))
    persons, organisations, total = F.sum("s.persons"), F.sum("s.organisations"), F.sum("s.amount")
    return rows.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), persons.alias("persons"), organisations.alias("organisations"), F.round(total, 2).alias("total"), F.round(total / (persons + organisations), 6).alias("a_sponsor"), F.round(F.avg("s.amount"), 6).alias("a_campaign")
    )


def _country(n: str) -> str:
    return f"[{', '.join(repr(c) for c in COUNTRIES)}][CAST({n} % 7 AS INTEGER) + 1]"


@query(
    "sg_country_totals",
    f"""WITH {SQL_BASE}, s AS (SELECT id, collected, unnest(range(0, 3)) AS i FROM b), c AS (SELECT {_country('(id + i)')} AS country, collected, (id * 13 + i * 977) % 50000 AS n, (id * 7 + i * 31) % 160 >= 100 AS reached FROM s)
SELECT country, CAST(sum(n) AS BIGINT) AS statements, count(*) FILTER (WHERE reached AND collected) AS reached, round(count(*) FILTER (WHERE reached AND collected) / (SELECT count(*) FROM b WHERE collected), 8) AS share FROM c GROUP BY 1""",
)
def sg_country_totals(t):
    """Signatures by country over all campaigns, and how often a country reached its threshold in successful ones."""
    rows = responses(t).select("collected", J.parsed(F.col("support"), "map<string,struct<statements:string,percentage:string>>").alias("m"))
    reached = J.keys_at_least(F.col("m"), "percentage", 100)
    each = rows.select("collected", reached.alias("reached"), F.explode("m").alias("country", "s"))
    hit = F.count_if(F.array_contains("reached", F.col("country")) & F.col("collected"))
    count = rows.where("collected").agg(F.count(F.lit(1)).alias("all"))
    out = each.groupBy("country").agg(F.sum(F.regexp_replace("s.statements", ",", "").cast("long")).alias("statements"), hit.alias("reached"))
    return out.join(F.broadcast(count)).select("country", "statements", "reached", F.round(F.col("reached") / F.col("all"), 8).alias("share"))  # one row


@query(
    "sg_organiser_countries",
    f"""WITH {SQL_BASE}, s AS (SELECT collected, {_country('id')} AS country, true AS main FROM b UNION ALL SELECT collected, {_country('(id + 3)')}, false FROM b)
SELECT country, count(*) AS n, count(*) FILTER (WHERE collected) AS successful, count(*) FILTER (WHERE main) AS hosted FROM s GROUP BY 1""",
)
def sg_organiser_countries(t):
    rows = responses(t).select("collected", P.organiser_countries(F.col("organisers"), first=True).alias("first"), F.explode(P.organiser_countries(F.col("organisers"))).alias("country"))
    return rows.groupBy("country").agg(F.count(F.lit(1)).alias("n"), F.count_if("collected").alias("successful"), F.count_if(F.array_contains("first", F.col("country"))).alias("hosted"))


@query(
    "rn_legislation_frequency",
    f"""WITH {SQL_BASE}, l AS (SELECT '2010/63/EU' AS item FROM b WHERE id % 3 = 0 UNION ALL SELECT '3200' || (id % 10) || 'L0042' FROM b UNION ALL SELECT '(EC) No 178/2002' FROM b WHERE id % 4 = 0 UNION ALL SELECT '5' FROM b WHERE id % 6 = 0)
SELECT item, CASE item WHEN '2010/63/EU' THEN 'Animals used for science' END AS title, count(*) AS n FROM l GROUP BY 1""",
)
def rn_legislation_frequency(t):
    """Acts by how many responses cite them, with their titles by number or, failing that, by identifier."""
    titles = t.spark.createDataFrame(list(TITLES), "number string, celex string, title string")
    cited = responses(t).select(F.explode(P.legislation_items(F.col("legislation"))).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    by_number = titles.where("number IS NOT NULL").select(F.col("number").alias("item"), F.col("title").alias("a"))
    by_celex = titles.select(F.col("celex").alias("item"), F.col("title").alias("b"))
    return cited.join(by_number, "item", "left").join(by_celex, "item", "left").select("item", F.coalesce("a", "b").alias("title"), "n")


@query(
    "rn_celex",
    f"""WITH {SQL_BASE}, l AS (SELECT '32010L0063' AS celex, true AS resolved FROM b WHERE id % 3 = 0 UNION ALL SELECT '3200' || (id % 10) || 'L0042', true FROM b UNION ALL SELECT '32002R0178', true FROM b WHERE id % 4 = 0 UNION ALL SELECT 'Article 5', false FROM b WHERE id % 6 = 0)
SELECT celex, resolved, count(*) AS n FROM l GROUP BY 1, 2""",
)
def rn_celex(t):
    rows = responses(t).select(P.celex_ids(F.col("legislation")).alias("c"))
    each = lambda name: F.transform(F.col(f"c.{name}"), lambda x: F.struct(x.alias("celex"), F.lit(name == "resolved").alias("resolved")))
    return rows.select(F.inline(F.concat(each("resolved"), each("unresolved")))).groupBy("celex", "resolved").agg(F.count(F.lit(1)).alias("n"))


@query(
    "rn_policy_types",
    f"""WITH {SQL_BASE}, p AS (SELECT id, [{', '.join(repr(p) for p in POLICIES)}] AS x FROM b), l AS (SELECT id, x[CAST(id % 4 AS INTEGER) + 1] AS type FROM p UNION SELECT id, x[CAST((id + 1) % 4 AS INTEGER) + 1] FROM p WHERE id % 2 = 1 UNION SELECT id, 'Unknown' FROM p WHERE id % 11 = 0)
SELECT type, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM b), 6) AS pct FROM l GROUP BY 1""",
)
def rn_policy_types(t):
    rows = responses(t).select(F.array_distinct(P.policy_types(F.col("policies"))).alias("types"))
    count = t.orders.agg(F.count(F.lit(1)).alias("all"))
    out = rows.select(F.explode("types").alias("type")).groupBy("type").agg(F.count(F.lit(1)).alias("n"))
    return out.join(F.broadcast(count)).select("type", "n", F.round(100.0 * F.col("n") / F.col("all"), 6).alias("pct"))  # one row


@query(
    "rn_commitments",
    f"WITH {SQL_BASE} SELECT id, '1999-12-31' AS deadline, CASE WHEN id % 2 = 1 THEN 'third (2)' ELSE 'first' END AS label FROM b UNION ALL SELECT id, '1998-06-30', 'second (1)' FROM b WHERE id % 2 = 1",
)
def rn_commitments(t):
    """Deadlines of merged columns, numbered within a campaign that has several."""
    each = responses(t).select("id", F.explode(J.fragments(F.col("deadlines"))).alias("deadline", "told"))
    own = Window.partitionBy("id")
    number, of = F.row_number().over(own.orderBy("deadline")), F.count(F.lit(1)).over(own)
    return each.select("id", "deadline", F.when(of > 1, F.concat("told", F.lit(" ("), number.cast("string"), F.lit(")"))).otherwise(F.col("told")).alias("label"))


@query(
    "rn_court_cases",
    f"""WITH {SQL_BASE}, c AS (SELECT id, CASE id % 4 WHEN 0 THEN 'Dismissed/Lost' ELSE 'Clarification' END AS ruling, CASE WHEN id % 2 = 1 THEN 'C-' ELSE 'T-' END || (id % 200) || '/' || (10 + id % 10) AS number FROM b WHERE id % 4 < 2)
SELECT ruling, id % 97 AS part, string_agg(DISTINCT number, ', ' ORDER BY number) AS cases FROM c GROUP BY 1, 2""",
)
def rn_court_cases(t):
    rows = responses(t).where(P.tells_of_case(F.col("context"))).select((F.col("id") % 97).alias("part"), P.case_outcome(F.col("context")).alias("ruling"), J.case_number(F.col("case_id")).alias("number"))
    return rows.groupBy("ruling", "part").agg(F.array_join(F.array_sort(F.collect_set("number")), ", ").alias("cases"))


@query(
    "rn_outcome_years",
    f"""WITH {SQL_BASE}, y AS (SELECT status, CAST(year(CASE WHEN status IN ('Law Active', 'Law Passed') THEN CASE WHEN id % 3 = 0 THEN d + 700 WHEN id % 2 = 0 THEN d + 900 ELSE d + 600 + CAST(id % 100 AS INTEGER) END ELSE d + 600 + CAST(id % 100 AS INTEGER) END) AS INTEGER) AS year FROM b WHERE status IS NOT NULL)
SELECT year, status, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY year), 6) AS pct FROM y GROUP BY 1, 2""",
)
def rn_outcome_years(t):
    year = P.outcome_year(F.col("status"), J.parsed(F.col("laws"), LAWS), _step("Answered initiative"))
    counts = responses(t).where("status IS NOT NULL").select(year.alias("year"), "status").groupBy("year", "status").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("*", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("year")), 6).alias("pct"))


@query(
    "rn_meeting_waits",
    f"""WITH {SQL_BASE}, l AS (SELECT 'meeting' AS kind, 480 + id % 30 AS days FROM b WHERE id % 3 <> 0 UNION ALL SELECT 'answer', 600 + id % 100 FROM b WHERE status IS NOT NULL UNION ALL SELECT 'verification', 450 + id % 40 FROM b)
SELECT kind, count(*) AS n, round(avg(days), 6) AS mean, min(days) AS least, max(days) AS most FROM l GROUP BY 1""",
)
def rn_meeting_waits(t):
    steps = {"meeting": "Meeting with the Commission", "answer": "Answered initiative", "verification": "Valid initiative"}
    by_step = D.step_map(J.parsed(F.col("timeline"), STEPS))
    rows = responses(t).select("day", by_step.alias("m"))
    days = {k: F.datediff(D.registry_date(F.try_element_at("m", F.lit(v))), F.col("day")).cast("long") for k, v in steps.items()}
    long = rows.select(*(v.alias(k) for k, v in days.items())).unpivot([], list(days), "kind", "days").where("days IS NOT NULL")
    return long.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("days"), 6).alias("mean"), F.min("days").alias("least"), F.max("days").alias("most"))


@query(
    "sg_responded_durations",
    f"""WITH {SQL_BASE}, w AS (SELECT id, 150 + id % 100 - id % 40 - 180 AS n FROM b WHERE status IS NOT NULL), p AS (SELECT *, abs(n) // 30 AS m, abs(n) % 30 AS k FROM w)
SELECT id, CASE WHEN n = 0 THEN '0 days' ELSE CASE WHEN n < 0 THEN '- ' ELSE '' END || trim(CASE WHEN m = 1 THEN '1 month ' WHEN m > 1 THEN m || ' months ' ELSE '' END || CASE WHEN k = 1 THEN '1 day' WHEN k > 1 THEN k || ' days' ELSE '' END) END AS late FROM p""",
)
def sg_responded_durations(t):
    """By how much responses came later than 180 days after validation."""
    days = F.datediff(_step("Answered initiative"), _step("Valid initiative")) - 180
    return responses(t).where("status IS NOT NULL").select("id", P.signed_duration(days).alias("late"))


@query(
    "rn_parsed_dates",
    "SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS a, strftime(o_orderdate, '%Y-%m-%d') AS b, strftime(o_orderdate, '%Y-') || CASE WHEN month(o_orderdate) < 10 THEN '0' ELSE '' END || month(o_orderdate) || '-' || strftime(o_orderdate, '%d') AS c FROM orders",
)
def rn_parsed_dates(t):
    d = F.col("o_orderdate")
    rows = t.orders.select(F.col("o_orderkey").alias("id"), F.date_format(d, "dd/MM/yyyy").alias("a"), F.date_format(d, "d MMMM yyyy").alias("b"), F.date_format(d, "'on 'd/M/yyyy").alias("c"))
    rows = rows.withColumns(P.any_dates("a", "b"))
    return rows.select("id", F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"), P.date_from_groups(F.col("c"), r"(\d{1,2})/(\d{1,2})/(\d{4})").alias("c"))


@query(
    "rn_rejected_extremes",
    f"""WITH {SQL_BASE}, j AS (SELECT b.id, CASE WHEN status LIKE 'Rejected%' THEN 'Rejected' WHEN status LIKE 'Law%' OR status LIKE 'Action%' THEN 'Legislative Action Taken' ELSE 'Other' END AS label, o_totalprice AS v FROM b JOIN orders ON o_orderkey = b.id WHERE status IS NOT NULL)
SELECT label, arg_max(id, (v, -id)) AS highest, arg_min(id, (v, id)) AS lowest, count(*) AS n FROM j GROUP BY 1""",
)
def rn_rejected_extremes(t):
    """The campaigns of most and least support by kind of outcome."""
    rows = responses(t).where("status IS NOT NULL").join(t.orders, F.col("id") == F.col("o_orderkey")).select("id", P.outcome(F.col("status"), "action").alias("label"), F.col("o_totalprice").alias("v"))
    return rows.groupBy("label").agg(F.max_by("id", F.struct("v", -F.col("id"))).alias("highest"), F.min_by("id", F.struct("v", "id")).alias("lowest"), F.count(F.lit(1)).alias("n"))
