"""Response and follow-up pages: sections, answers, documents, deadlines, actions, events and names."""

import json

import pytest
from pyspark.sql import functions as F

from civitas.functions import dates as D, text as T
from civitas.operators import answers as A, legislation as L
from civitas.plans.functions_queries import LADDER
from civitas.sources import nodes as N

AS_OF = "2020-01-01"


def values(spark, texts, column):
    """A column of t for each text."""
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in rows.select("i", column(F.col("t")).alias("v")).orderBy("i").collect()]


def on_pages(spark, pages, column):
    """A column of (nodes, pieces) for each page."""
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    return [r.v for r in N.with_nodes(rows).select("i", column(F.col("nodes"), F.col("pieces")).alias("v")).orderBy("i").collect()]


HEAD = '<h2 id="Answer-of-the-European-Commission">Answer of the European Commission</h2>'
NEXT = '<h2 id="Follow-up">Follow-up</h2>'
PROMISE = HEAD + "<p>The Commission will table a legislative proposal.</p>"
PAGES = {
    "promised": PROMISE,
    "refused": HEAD + "<p>There is no legislative proposal. The directive was adopted.</p><ul><li>It is already covered.</li><li>So.</li></ul>" + NEXT,
    "updated": PROMISE + NEXT + "<ul><li>The directive was adopted in May 2020</li></ul><h2 id='Updates-on-the-Commissions-proposals'>U</h2><p>The law was withdrawn.</p><p>The law was withdrawn.</p>",
    "mixed": HEAD + "<p>It will table a legislative proposal on pigs.</p><p>Hens are already covered.</p>",
    "pure": HEAD + "<p>Outside the EU competence it has no say.</p>",
    "plain": HEAD + "<p>No further legal acts are proposed.</p>",
    "submission": """<a class="ecl-site-header__language-link--active" href="/here_en">en</a><a href="https://x.eu/initiatives/details/2012/000003_en">Initiative</a><h2>Submission and examination</h2><p>It was submitted to the Commission on 28/02/2014.</p>
    <p>The presentation of this initiative in a public hearing, on 2014/03/17, was long. It was a debate of May.</p><p>A debate on this initiative was held in the plenary session of the European Parliament on 5/6/2015.</p><p>Communication adopted on 7 July 2016.</p>""",
    "whole": HEAD + "<p>The Regulation became applicable.</p><h2>Submission and examination</h2>",
    "broken": "<p>x",
    "none": None,
}


@pytest.fixture(scope="module")
def told(spark):
    """The records of all pages, one plan for all of them."""
    rows = spark.createDataFrame([(p, f"2012_{i:06d}_en.html" if p else "a.html") for i, p in enumerate(PAGES.values())], "html string, file_name string")
    return A.response_record(N.with_nodes(rows), LADDER, F.to_date(F.lit(AS_OF))).cache()


@pytest.fixture(scope="module")
def records(told):
    found = {r.registration_number: r for r in told.collect()}
    return {name: found.get(f"2012/{i:06d}" if p else None) for i, (name, p) in enumerate(PAGES.items())}


def test_intervals_and_texts(spark):
    html = '<div><p>a <b>b</b>c<br>d</p><script>x</script><p>e <a href="/f">f <i>g</i></a>h<a>i</a></p></div><p>unclosed <b>k'
    p = lambda nodes, i: F.get(N.tagged(nodes, "p"), i)
    (one,) = on_pages(
        spark,
        [html],
        lambda n, t: F.struct(
            N.raw(t, p(n, 0)).alias("raw"), N.spaced(t, p(n, 0)).alias("spaced"), N.tight(t, p(n, 0)).alias("tight"), N.with_targets(n, t, p(n, 1)).alias("with"), N.with_targets_before(n, t, p(n, 1)).alias("before"),
            N.linked(n, t, p(n, 1)).alias("linked"), N.item_with_targets(n, t, p(n, 1)).alias("item"), F.transform(N.inside(n, F.get(n, 0)), lambda x: x["tag"]).alias("inside"), F.transform(N.siblings(n, p(n, 0)), lambda x: x["tag"]).alias("after"), N.spaced(t, p(n, 2)).alias("last"),
        ),
    )
    assert (one.raw, one.spaced, one.tight) == ("a bc d", "a b c d", "abcd") and one.last == "unclosed k"
    assert one["with"] == "e [fg](/f) h i" and one.before == "e [fg](/f) f g h [i]() i" and one.linked == "e fg (/f) h i" and one["item"] == "e [fg](/f) h [i]()"
    assert one.inside == ["p", "b", "br", "script", "p", "a", "i", "a"] and one.after == ["script", "p"]


EVENTS = {
    "On 2021-02-03, 04.05.2021 and 6 July 2021": ["2021-02-03", "2021-05-04", "2021-07-06"],
    "early 2022, in March 2022, by the end of 2023 and in 2024": ["2022-03-31", "2023-12-31", "2022-03-31", "2024-01-01"],
    "The 2030 Agenda and Horizon 2020 of http://x.eu/2019-01-01/a": [],
    "Directive 2010/63, C(2021) 5, 2021-2027, No 2022/5 and 1999": [],
    "31 February 2020": ["2020-02-29"],
    "12-03/2021 then 7 Sep 2021, 7 Sep 2021 and Q3 2021": ["2021-09-07", "2021-09-30"],
    "45 October 2015, 2025-13-01": ["2015-10-31"],
    "": [],
}


def test_event_dates(spark):
    got = values(spark, [*EVENTS, None], lambda c: F.transform(D.event_dates(c), lambda d: d.cast("string")))
    want = [list(dict.fromkeys(v)) for v in EVENTS.values()]
    assert got[-1] in (None, []) and got[:-1] == want


def test_places_of_matches_and_sentences(spark):
    text = "One. We act by May 2020! Then • item by 2021, and\n\nlast by 2022"
    got = values(spark, [text, "none", ""], lambda c: F.transform(T.matches(c, F.lit(r"by\s+([^.,;!]+)")), lambda m: F.struct(m["start"], m["group"].alias("g"), T.sentence_around(F.substring(c, F.lit(1), m["start"]), F.substring(c, m["start"] + 1, F.char_length(c))).alias("s"))))
    assert [tuple(m) for m in got[0]] == [(text.index("by May"), "May 2020", "We act by May 2020!"), (text.index("by 2021"), "2021", "item by 2021, and"), (text.index("by 2022"), "2022", "last by 2022")]
    assert got[1:] == [[], []]


NAMES = {
    "It follows the Soil Health Directive.": {"directives": ["Soil Health Directive"]},
    "The Nature Directive and Sea Directive; also the Fur Regulation": {"directives": ["Nature Directive", "Sea Directive"], "regulations": ["Fur Regulation"]},
    "A Directive, the Directive, new Directive, EU Directive, Proposal for a Directive": {},
    "The Charter of Fundamental Rights of the European Union, a Youth Charter and ECHR": {"charters": ["Charter of Fundamental Rights of the European Union", "ECHR", "Youth Charter"]},
    "Under tfeu, the Treaty on European Union and the Lisbon Treaty": {"treaties": ["Lisbon Treaty", "TFEU", "Treaty on European Union"]},
    "REACH, the REACH Regulation": {"regulations": ["REACH Regulation"]},
    "the Seeds and Plants Regulation": {"regulations": ["Plants", "Seeds"]},
    "Directive on Animal Welfare": {"directives": ["Directive on Animal Welfare"]},
    "Soil Directive\nWater Directive and Air Directive": {"directives": ["Air Directive", "Soil Directive", "Water Directive"]},
    "REGISTRATIONOFCHEMICALSANDALLTHINGSOFTHEWORLDANDMORE of Law": {},
    "nothing at all": {},
}


def test_names_of_legislation(spark):
    got = values(spark, list(NAMES), lambda c: F.to_json(L.legislation_by_name(c)))
    assert {t: json.loads(v) for t, v in zip(NAMES, got, strict=True)} == NAMES


ANSWERS = {
    HEAD + '<p>Yes.</p><div class="ecl-file x"><p>file</p></div><ul><li>Communication</li><li> Annexes </li></ul><ul><li>Annex</li><li>kept</li></ul><p>End</p>' + NEXT + "<p>no</p>": "Yes.\nAnnexkept\nEnd",
    HEAD + "<p>One</p><h2>No id</h2><p>Two</p><h2 id='other'>Other</h2><p>no</p>": "One\nNo id\nTwo",
    HEAD + "<p>One</p><h4>Follow-up</h4><p>no</p>": "One",
    HEAD + "<p>Decision date: 1 May 2020</p>" + NEXT + "<p>Too short</p><p>A first paragraph of the follow-up.</p><p>Another one, left out here.</p>": "Decision date: 1 May 2020\nA first paragraph of the follow-up.",
    HEAD + "<p>Decision date: 1 May 2020</p><h2 id='more'>More</h2><p>A paragraph of another section.</p>": "Decision date: 1 May 2020",
    HEAD + "<p>A long enough reason is given here. Decision date: 1 May 2020</p>" + NEXT + "<p>A first paragraph of the follow-up.</p>": "A long enough reason is given here. Decision date: 1 May 2020",
    HEAD + '<li>a <a href="/x">b</a> <i>c</i></li><a href="/y">d</a>': "a [b](/x) c\n[d](/y)",
    "<h2>Answer of the European Commission and more</h2><p>By text</p>": "By text",
    HEAD: None,
    "<p>no heading</p>": None,
}


def test_answer_texts(spark):
    assert on_pages(spark, list(ANSWERS), A.answer_text) == list(ANSWERS.values())


def test_documents(spark):
    page = '<h2 id="Submission-and-examination">S</h2><p>The Commission adopted a Communication on 1 May 2020: <a href="/c">Text</a> <a href="/c">Again</a> <a href="https://x.eu/initiatives/details/2020/000001_en">Own</a></p><p>The Commission adopted a Communication on 2 May</p><a href="/old">Annex</a><a href="/new">Annex</a><a href="/z">Annexes of it</a>' + NEXT + '<p>Communication adopted on 3 May: <a href="/f">More</a><a>none</a></p>'
    got = on_pages(spark, [page, "<p>none</p>"], lambda n, t: A.response_documents(n, t, A.headed(n, A.SUBMISSION)))
    assert [tuple(x) for x in got[0]] == [("Text", "/c"), ("Annex", "/new"), ("More", "/f")] and got[1] is None
    page = '<a href="/1">The Communication</a><a href="/1">An annex</a><a href="https://ec.europa.eu/commission/presscorner/x">Press</a><a href="/2">Other</a><a href="">Annex</a>'
    assert [tuple(x) for x in on_pages(spark, [page], A.followup_documents)[0]] == [("The Communication", "/1"), ("Press", "https://ec.europa.eu/commission/presscorner/x")]


def test_deadlines(spark):
    said = [
        "It is so. The Commission will report, by the end of 2021 for all towns; the study, too.",
        "It will communicate, by May 2022. It will report, by May 2022.",
        "It will report, by May 2022. EFSA is to provide an opinion, by spring 2023",
        "it will report, by next year",
        "By 30 June 2024, the Commission will report on it. By 2025, ban them",
    ]
    got = values(spark, ["\x00".join(said)], lambda c: A.deadline_map(A.deadline_hits(F.split(c, "\x00"))))[0]
    assert got == {
        "2021-12-31": "The Commission will report, by the end of 2021 for all towns; the study, too.",
        "2022-05-31": "It will communicate, by May 2022.; It will report, by May 2022.",
        "2023-06-20": "EFSA is to provide an opinion, by spring 2023",
        "2024-06-30": "By 30 June 2024, the Commission will report on it.",
        "2025-12-31": "By 2025, ban them",
    }
    assert values(spark, ["nothing"], lambda c: A.deadline_map(A.deadline_hits(F.array(c)))) == [None]


def test_law_actions(spark):
    html = '<p>The Regulation was adopted on 1 May 2020 and applies from 3 June 2021; see <a href="https://eur-lex.europa.eu/a">a</a> <a href="/b">b</a>.</p><p>A proposal for a Directive was tabled in March 2019. It was withdrawn, 2018-01-02.</p><p>Talks</p>'
    got = on_pages(spark, [html], lambda n, t: A.law_actions(n, t, N.tagged(n, "p")))[0]
    assert [(a.type, a.status, a.date, a.document_urls) for a in got] == [("Regulation Adoption", "law_active", "2021-06-03", ["https://eur-lex.europa.eu/a"]), ("Directive Proposal", "withdrawn", "2018-01-02", None)]


def test_law_actions_and_reasons_of_pages(records):
    a, b, c = (records[k] for k in ("promised", "refused", "updated"))
    assert a.laws_actions is None and a.commission_promised_new_law and b.laws_actions is None and b.commission_rejected_initiative
    assert b.commission_rejection_reason == "There is no legislative proposal. The directive was adopted. It is already covered."
    assert [x["description"] for x in json.loads(c.laws_actions)] == ["The law was withdrawn.", "The directive was adopted in May 2020", "The Commission will table a legislative proposal."]
    assert [records[k].commission_rejection_reason for k in ("mixed", "pure", "plain")] == ["It will table a legislative proposal on pigs.", "Outside the EU competence it has no say.", A.NO_REASON]


def test_policy_actions(spark):
    lines = ["A workshop of towns was held on 1 May 2020.", "A workshop", "Workshops and what they are about:", "Transparency and benchmarking: more data on it", "A workshop after it entered into force", "ICCAT met in May", "A long talk about the weather"]
    got = on_pages(spark, ["".join(f"<p>{x}</p>" for x in lines)], lambda n, t: A.policy_actions(t, N.tagged(n, "p")))[0]
    assert [tuple(a) for a in got] == [("Scientific Activity", lines[0], "2020-05-01")]


def test_events(spark):
    body = '<p>The page provides regularly updated information on it.</p><p>These are the things that were done:</p><div>A first thing was done in May 2020, <a href="https://x.eu/2019-01-01">here</a>.</div><ul><li>An item of the list that ends with a colon:<ul><li>an item below the item of the list</li></ul></li><li>short</li></ul><h4>Follow-up</h4><p>What comes after the smaller heading.</p>'
    got = on_pages(spark, ['<h2 id="Follow-up">F</h2>' + body, "<h4> Follow-UP </h4>" + body, "<p>none</p>"], lambda n, t: A.response_events(n, t, F.coalesce(A.headed(n, A.FOLLOWUP), A.headed(n, words=r"(?i)^\s*follow-up\s*$", tag="h4"))))
    first = ("A first thing was done in May 2020, [here](https://x.eu/2019-01-01) .", ["2020-05-31"])
    item = ("An item of the list that ends with a colon: an item below the item of the list", [])
    assert [(e.action, e.dates) for e in got[0]] == [first, item, ("What comes after the smaller heading.", [])]
    assert [(e.action, e.dates) for e in got[1]] == [first, item] and got[2] is None


def test_submission_fields(records):
    r = records["submission"]
    assert (r.response_url, r.initiative_url) == ("https://example.org/here_en", "https://x.eu/initiatives/details/2012/000003_en")
    assert (r.commission_submission_date, r.parliament_hearing_date, r.plenary_debate_date, r.official_communication_adoption_date) == ("2014-02-28", "2014-03-17", "2015-06-05", "2016-07-07")
    assert r.problems == ["no answer section"] and r.plenary_debate_video_urls is None and r.submission_news_url is None


def test_quarantine(told):
    good, rest = A.quarantined(told)
    number = lambda name: f"2012/{list(PAGES).index(name):06d}"
    assert [r.registration_number for r in good.collect()] == [number("whole")] and "problems" not in good.columns
    reasons = {r.registration_number: r.reason for r in rest.collect()}
    assert reasons[number("broken")] == "no answer section; no submission section" and reasons[None] == "no registration number; no answer section; no submission section"
    assert reasons[number("submission")] == "no answer section" and len(reasons) == len(PAGES) - 1


@pytest.mark.parametrize("known", [True, False])
def test_followup_record(spark, known):
    main = ' class="ecl-u-type-heading-2"'
    page = f"""<body><div><h2 id="response-of-the-commission">Response of the Commission</h2></div><div class="ecl"><p>It committed to come forward with a legislative proposal, by May 2018. <button>Go</button></p></div>
    <div><h2{main} id="x">What</h2></div><div class="ecl"><pre>the road map</pre><p>See <span>the <a href="/n">page</a></span> of 2019 <a href="/m">more</a></p></div><div><h2{main} id="related-links">V</h2></div><div class="ecl"><p>not this</p></div><p class="ecl-social-media-share__description">Share 2050</p></body>"""
    rows = spark.createDataFrame([(page, "2012_000001_en.html")], "html string, file_name string")
    responses = spark.createDataFrame([("2012/000001" if known else "x", "T", "w")], "registration_number string, initiative_title string, followup_dedicated_website string")
    r = A.followup_record(N.with_nodes(rows), LADDER, F.to_date(F.lit(AS_OF)), responses).first()
    assert r.commission_answer_text == "It committed to come forward with a legislative proposal, by May 2018." and r.commission_promised_new_law and r.has_roadmap and not r.has_workshop
    assert json.loads(r.commission_deadlines) == {"2018-05-31": "It committed to come forward with a legislative proposal, by May 2018. Go"} and r.followup_latest_date == "2019-12-31" and r.followup_most_future_date is None
    assert json.loads(r.followup_events_with_dates) == [{"dates": ["2019-01-01"], "action": "See thepage of 2019 more (/m)"}]
    assert (r.initiative_title, r.problems) == (("T", []) if known else (None, ["unknown registration number"]))
