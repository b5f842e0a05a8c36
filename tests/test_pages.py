import json

from pyspark.sql import functions as F

from civitas.operators import answers as A, pages as P
from civitas.sources import nodes as N, snapshots as S

REGISTRY = """<html><head><meta name="dcterms.title" content="Save the bees"><meta name="dcterms.modified" content="2020-01-01"></head><body>
<ol class="ecl-timeline"><li class="ecl-timeline__item">Registered 09/05/2012</li><li class="ecl-timeline__item ecl-timeline__item--current">Answered initiative 10/06/2014</li></ol>
<h2>Objectives</h2><p>Protect bees.</p><p>And more.</p><h2>Annex</h2><p>Details</p><h2>Organisers</h2>
<table><tr><th>Country</th><th>Statements</th><th>Threshold</th><th>Percentage</th></tr><tr><td>France</td><td>1,000</td><td>500</td><td>200.0%</td></tr><tr><td>Malta</td><td>10</td><td>500</td><td>2.0%</td></tr><tr><td>Total number of signatories</td><td>1,010</td><td></td><td></td></tr></table>
<table><tr><td>ACME [1]</td><td>01/01/2013</td><td>€ 5,000.00</td></tr></table><h3>Representative</h3><ul><li>Ann - a@b.c Country of residence: France</li><li>Bob Country of residence: Spain</li><li>Cem Country of residence: France</li></ul><h3>Substitute</h3><ul><li>Dee</li></ul><h3>Members</h3><ul><li>Eve</li><li>Fay</li></ul><h3>Legal entity created for the purpose of managing the initiative</h3><ul><li>Bees asbl Country of the seat: Belgium</li></ul><p>Total amount of support and funding: €7,000.00</p>
<a href="/x/2012_000001_de">DE</a><a href="/x/2012_000001_bg">BG</a><a href="https://e.org/answer">Commission’s answer and follow-up</a></body></html>"""


def record(spark, html, make):
    rows = spark.createDataFrame([(html, "2012_000001_en.html")], "html string, file_name string")
    return make(N.with_nodes(rows)).first()


def test_registry_record(spark):
    r = record(spark, REGISTRY, lambda x: P.registry_record(x, "https://e.org/"))
    assert (r.registration_number, r.title, r.objective, r.annex) == ("2012/000001", "Save the bees", "Protect bees.\nAnd more.", "Details")
    assert (r.current_status, r.final_outcome, r.timeline_registered, r.timeline_response_commission_date) == ("Answered initiative", "Commission Response", "09/05/2012", "10/06/2014")
    assert (r.signatures_collected, r.signatures_threshold_met, r.funding_total, r.languages_available) == ("1,010", 1, "7,000.00", "bg,de")
    assert json.loads(r.organizer_representative) == {"number_of_people": 3, "countries_of_residence": {"France": 2, "Spain": 1}}
    assert json.loads(r.organizer_entity) == {"name": "Bees asbl", "country_of_residence": "Belgium"}
    assert json.loads(r.organizer_others) == {"substitute": {"number_of_people": 1}, "members": {"number_of_people": 2}}
    assert [c["country"] for c in json.loads(r.signatures_collected_by_country)] == ["France", "Malta"]
    assert r.url == "https://e.org/details/2012/000001_en"
    assert json.loads(r.funding_by)[0]["name_of_sponsor"] == "ACME" and r.response_commission_url == "https://e.org/answer"


def test_empty_and_null_pages(spark):
    for html in ("", None, "<p>unclosed <b>bold"):
        assert record(spark, html, lambda x: P.registry_record(x, "u")).title is None


def test_listing(spark):
    label = lambda *t: "".join(f'<span class="ecl-content-block__secondary-meta-label">{x}</span>' for x in t)
    block = lambda href, more: f'<div class="x ecl-content-block ecl-content-item__content-block"><a class="ecl-link" href="/before">b</a><div class="ecl-content-block__title"><a class="ecl-link" href="{href}">A</a></div>{more}</div><a class="ecl-link" href="/initiatives/details/after">z</a>'
    html = block("/initiatives/details/1", label("Current status: <b>Open</b>", "Registration number: ECI(2019)000007", "Online signature collection closed")) + block("/news/2", label("Current status: Open")) + block("/initiatives/details/3", "") + '<li class="a ecl-pagination__item--next"><a href="/next">n</a></li>'
    rows = spark.createDataFrame([(html,), ("<p>none",), (None,)], "html string")
    got = P.listing_rows(N.with_nodes(rows), "https://e.org").collect()
    assert [tuple(r) for r in got] == [("https://e.org/initiatives/details/1", "Open", "ECI(2019)000007", "Online signature collection closed"), ("https://e.org/initiatives/details/3", "", "", "")]
    assert [r[0] for r in N.with_nodes(rows).select(P.next_page(F.col("nodes"))).collect()] == ["/next", None, None]


def test_chains_of_any_length_and_loops(spark):
    rows = [(f"u{i}", f"u{i + 1}", i) for i in range(3000)] + [("a", "b", 0), ("b", "c", 1), ("c", "b", 2), ("s", "s", 3), ("d", "gone", 4), (None, "a", 5), ("a", "x", 6)]
    pages = spark.createDataFrame(rows, "url string, next_url string, place_there int")
    got = {r.url: r.place for r in S.chained(pages, "u0").collect()}
    assert got == {f"u{i}": i + 1 for i in range(3000)}
    assert sorted((r.url, r.place) for r in S.chained(pages, "a").collect()) == [("a", 1), ("a", 1), ("b", 2), ("c", 3)]
    assert [(r.url, r.place) for r in S.chained(pages, "s").collect()] == [("s", 1)] and [(r.url, r.place) for r in S.chained(pages, "d").collect()] == [("d", 1)]
    assert S.chained(pages, "nowhere").count() == 0


def test_registry_tables_and_problems(spark):
    table = lambda cls, *rows: f'<table class="{cls}">' + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"
    step = lambda t: f'<ol class="ecl-timeline"><li class="ecl-timeline__item ecl-timeline__item--current">{t}</li></ol>'
    a = step("Something new") + table("ecl-table", ("Other", "1", "2", "300%")) + table("ecl-table ecl-table--zebra ecl-u-type-paragraph", ("France", "1 000", "", "99.9%"), ("Malta", "5", "1", "120.5 %, 100%"), ("Total number of signatories", "1 005", "", ""))
    a += "<table><tr><th>Name of sponsor</th><th>Date</th><th>Amount in EUR</th></tr><tr><td>X [2]</td><td></td><td>none</td></tr></table>" + table("", ("Y", "d", "5"))
    b = step("Open") + '<div class="ecl-counter__value">1,234 <b>5</b></div>'
    rows = spark.createDataFrame([(a, "2012_000001_en.html"), (b, "2012_000002_en.html"), ("", "z.html")], "html string, file_name string")
    x, y, z = P.registry_record(N.with_nodes(rows), "u/", F.lit("now")).collect()
    assert (x.signatures_collected, x.signatures_threshold_met, y.signatures_collected, y.last_updated) == ("1005", 1, "12345", "now")
    assert [c["country"] for c in json.loads(x.signatures_collected_by_country)] == ["France", "Malta"] and [s["name_of_sponsor"] for s in json.loads(x.funding_by)] == ["X"]
    assert (x.problems, x.final_outcome, y.problems, z.problems) == (["unknown status"], None, [], ["no registration number", "no timeline"])


def test_snapshots(spark, tmp_path):
    for name in ("2024-01-01_00-00-00", "2024-02-01_00-00-00", "2024-13-01_00-00-00", "logs"):
        (tmp_path / name).mkdir()
    last = S.latest_snapshot(spark, str(tmp_path))
    assert last.endswith("2024-02-01_00-00-00")
    folder = tmp_path / "2024-02-01_00-00-00"
    (folder / "responses_2024-01-01_00-00-00.csv").write_text('k,v\n1,"a\n""b"""\n')
    (folder / "responses_2024-01-02_00-00-00.csv").write_text("k,v\n1,x\n")
    (folder / "responses_website_2024-01-03_00-00-00.csv").write_text("k\n")
    assert S.latest_file(spark, last, "responses").endswith("responses_2024-01-02_00-00-00.csv")
    assert S.latest_file(spark, last, "responses", loose=True).endswith("website_2024-01-03_00-00-00.csv")
    assert S.latest_file(spark, last, "responses", exclude=["website"], loose=True).endswith("responses_2024-01-02_00-00-00.csv")
    assert S.read_csv(spark, f"{last}/responses_2024-01-01_00-00-00.csv").first()["v"] == 'a\n"b"'
    assert S.csv_problems(spark, f"{last}/nothing.csv") == ["missing"] and S.csv_problems(spark, f"{last}/responses_website_2024-01-03_00-00-00.csv") == ["fewer than two columns"]
    (folder / "2019_000007_en.html").write_text("<html></html>")
    page = S.read_pages(spark, last).withColumn("n", S.registration_number(F.col("file_name"))).first()
    assert page.n == "2019/000007" and page.html == "<html></html>"
    S.write_csv(spark.createDataFrame([("a", 'q"')], "x string, y string"), str(tmp_path / "out"))
    assert S.read_csv(spark, str(tmp_path / "out")).first()["y"] == 'q"'


def test_lists_of_pages(spark):
    first = spark.createDataFrame([("u1", None, "x"), ("u2", None, "y")], "url string, seen string, note string")
    later = spark.createDataFrame([("u2", "now"), ("u3", "now")], "url string, seen string")
    assert {tuple(r) for r in S.rewritten(first, later, "url").collect()} == {("u1", None, "x"), ("u2", "now", "y"), ("u3", "now", None)}
    urls = spark.createDataFrame([("http://a", "2019/000007"), ("", "2019/000008"), (None, "2019/000009")], "url string, number string")
    assert [(r.year, r.stem) for r in S.url_list(urls, "url", "number").collect()] == [("2019", "2019_000007")]
    report = {r.s: (r.n, r.failed) for r in S.status_report(spark.createDataFrame([("a", 1), ("a", 0), ("b", 1)], "s string, f int"), "s", F.col("f") == 1).collect()}
    assert report == {"a": (2, 1), "b": (1, 1)}
    number = spark.createDataFrame([("ECI(2019)000007",), ("2019_000007",), ("2019/000007",)], "n string").select(S.normal_number(F.col("n"))).distinct().collect()
    assert [tuple(r) for r in number] == [("2019/000007",)]
    known, unknown = P.guarded(spark.createDataFrame([("1",), ("2",)], "registration_number string"), spark.createDataFrame([("1",)], "registration_number string"))
    assert known.first()[0] == "1" and unknown.first()[0] == "2"
    page = spark.createDataFrame([("<html>" + "x" * 2000,), ("<html>too many requests" + "x" * 2000,), ("short",), (None,)], "h string")
    assert [r[0] for r in page.select(S.page_is_valid(F.col("h"))).collect()] == [True, False, False, False]


def test_verification_end(spark):
    def end(*steps):
        rows = spark.createDataFrame([([{"step": s, "date": str(i)} for i, s in enumerate(steps)],)], "s array<struct<step:string,date:string>>")
        return rows.select(P.verification_end(F.col("s"))).first()[0]

    assert end("Registered", "Verification", "Valid initiative", "Answered initiative", "Later") == "2"
    assert end("Verification", "Valid initiative", "Answered initiative") == "2"
    assert end("Verification", "Initiative checked", "Something") == "1" and end("Valid initiative", "Registered") == "0" and end("Registered") is None


def test_references(spark):
    def one(column, **row):
        return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in row.items())).select(column.alias("v")).first()["v"]

    cases = one(P.court_cases(F.col("t")), t="T-655/20, C–26/23, T-655/20; decision 78/182 and 123/456")
    assert (cases.general_court, cases.court_of_justice, cases.ombudsman_decisions) == (["T-655/20"], ["C–26/23"], ["78/182", "123/456"]) and one(P.court_cases(F.col("t")), t="none") is None
    told = one(P.legislation_by_id(F.col("t"), F.col("h")), t="Article 5(a) of Directive 2010/63/EU, CELEX: 32010L0063", h=["x?uri=uriserv:OJ.L_.2019.231.01.0001.01", "?uri=CELEX%3A32019R1381", "?uri=uriserv%3AOJ.C_.2020.7.01.0001.01"])
    assert (told.Article, told.Directive, told.CELEX) == (["5(a)"], ["2010/63/EU"], ["32010L0063", "32019R1381"]) and told.official_journal.asDict() == {"legislation": ["2019, 231"], "information_and_notices": ["2020, 7"]}
    assert one(P.followup_flag(F.col("t"), "partnership"), t="a partnership") is False and one(P.followup_flag(F.col("t"), "partnership"), t="a Partnership between towns") is True
    assert one(P.followup_flag(F.col("t"), "workshop", patterns=True), t="Symposia were held") is True and one(P.followup_flag(F.col("t"), "roadmap", patterns=True), t="no road") is False
    assert one(P.applicable_date(F.array(F.col("t")), F.lit(True)), t="It entered into force on 1 May 2019 and became applicable immediately") == "2019-05-01"
    box = lambda h, *texts: f"<div>{h}</div>" + "".join(f"<div>{t}</div>" for t in texts)
    html = "<body>" + box('<h2 id="response-of-the-commission">R</h2>', "<p>One</p>") + box('<h2 id="x">Other</h2>', "<p>no</p>") + box("<h2>The Follow-Up on it</h2>", "<p>Two</p>") + box('<h2 id="next-steps">N</h2>', "<li>Three</li>") + "</body>"
    assert record(spark, html, lambda x: x.select(A.followup_content(F.col("nodes"), F.col("pieces")).alias("v"))).v == "one two three"
    html = '<h2 id="next-steps">N</h2><li>Three</li>'
    assert record(spark, html, lambda x: x.select(P.any_of(P.content(F.col("nodes"), "next-steps"), lambda t: t == "Three").alias("v"))).v is True
    assert record(spark, html, lambda x: x.select(P.folded(P.content(F.col("nodes"), "next-steps"), lambda t: F.split(t, "r")).alias("v"))).v == ["Th", "ee"]


def test_loader_chains_and_bindings(spark, tmp_path):
    folder = tmp_path / "2024-02-01_00-00-00"
    folder.mkdir()
    (folder / "list_2024-01-02_03-04-05.csv").write_text("k,v\n1,x\n")
    (folder / "bad_2024-01-02_03-04-05.csv").write_bytes(b"k,v\n1,\xff\xfe\n")
    row = S.latest_table(spark, str(tmp_path), "list").first()
    assert (row.k, str(row.file_time)) == ("1", "2024-01-02 03:04:05")
    assert S.csv_problems(spark, f"{folder}/bad_2024-01-02_03-04-05.csv") == ["not UTF-8"]
    pages = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", None), ("z", "z")], "url string, next_url string")
    assert {(r.url, r.place) for r in S.chained(pages, "a").collect()} == {("a", 1), ("b", 2), ("c", 3)}
    assert [(r.url, r.place) for r in S.chained(pages, "z").collect()] == [("z", 1)]
    answer = json.dumps({"results": {"bindings": [{"id": {"value": "1"}, "title": {"value": "One", "xml:lang": "en"}}, {"id": {"value": "1"}, "title": {"value": "Un", "xml:lang": "fr"}}]}})
    titles = S.bindings(spark.createDataFrame([(answer,), ("nonsense",), (None,)], "j string"), "j", ["id", "title"])
    assert [tuple(r) for r in titles.collect()] == [("1", "One")]
    ids = spark.createDataFrame([("1",), ("2",)], "id string")
    assert {tuple(r) for r in S.with_titles(ids, "id", titles).collect()} == {("1", "One", True), ("2", None, False)}
    S.write_list(spark.createDataFrame([("2019_000007", "u")], "number string, url string"), str(tmp_path / "list"), "number")
    assert S.read_csv(spark, str(tmp_path / "list")).first().number == "2019/000007"
    links = record(spark, REGISTRY, P.response_links)
    assert (links.registration_number, links.url) == ("2012/000001", "https://e.org/answer")
    from civitas.operators import relational as R

    assert R.titled(pages, "url", " a ").count() == 1
    assert all(abs(r.j) <= 0.5 for r in pages.select(R.jitter().alias("j")).collect())
