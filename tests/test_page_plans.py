"""Page queries on odd and large tables: how often pages are read, by how many tasks, and in what parts."""

import itertools
import random
import re

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from civitas.functions import dates as D, fixed_values as V, text as T
from civitas.operators import answers as A, legislation as L, pages as P
from civitas.plans import functions_queries as Q, page_queries as G
from civitas.sources import nodes as N, shared

SPARSE = [3, 6, 7, 999_999, 1_000_002, 1_000_005, 3_000_000, 5_400_000, 1_234_566, 1_234_567]


class Tables:
    def __init__(self, **tables):
        self.__dict__.update(tables)


@pytest.fixture(scope="module")
def customers(spark):
    return Tables(customer=spark.createDataFrame([(k, f"Customer#{k}", "BUILDING") for k in SPARSE], "c_custkey long, c_name string, c_mktsegment string").coalesce(1))


def by_sql(name, **tables):
    con = duckdb.connect()
    for k, v in tables.items():
        con.register(k, v.toPandas())
    return con.sql(G.query.__globals__["SQL"][name]).df()


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(map(tuple, frame.where(frame.notna(), None).itertuples(index=False, name=None)), key=repr)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_titles_as_the_sql_reads_them(spark):
    html = ["<html lang=\"en\"><title>a &quot;b&quot; &amp;  c &amp;lt; d\n</title>", "<title> </title>", "<TITLE>X</TITLE>", "<title id='1'>X</title>", "<title>a <b>c</b></title>", "<title>a\x0bb</title>", "", None]
    pages = spark.createDataFrame(list(enumerate(html)), "page_id long, html string")
    assert rows(G.page_titles(Tables(pages=pages)).toPandas()) == rows(by_sql("page_titles", pages=pages))


def test_raw_title_reads_references_once(spark):
    page = spark.createDataFrame([("<TITLE id='1'>a\n &amp;quot; &quot;</title>",)], "h string")
    assert page.select(N.raw_title(F.col("h"))).first()[0] == 'a &quot; "'


def test_keys_of_seven_digits(customers):
    for name in ("answer_links", "registry_funnel"):
        assert rows(getattr(G, name)(customers).toPandas()) == rows(by_sql(name, customer=customers.customer))


def test_pages_are_read_once_a_query(customers):
    assert plan(G.answer_links(customers)).count("ArrowEvalPython") == 1
    assert plan(G.listing_records(customers)).count("ArrowEvalPython") == 0  # the rows of the pages are stored


def test_one_file_is_spread_over_all_cores(spark, customers):
    cores = spark.sparkContext.defaultParallelism
    orders = Tables(orders=spark.range(10).select(F.col("id").alias("o_orderkey")).coalesce(1))
    for df in (G.registry_pages(customers), G.response_pages(customers), G.followup_pages(customers), Q.legislative_status(orders)):
        assert df.rdd.getNumPartitions() >= 4 * cores


def test_pages_are_parsed_in_parts(monkeypatch):
    html = ["<p>" + "x" * n + "</p>" for n in (5, 200, 1, 0, 90, 30)] + [None, "<a href='u'>b</a>"]
    whole, seen, part = N._parsed(pa.array(html)), [], N._parsed_part
    monkeypatch.setattr(N, "PART", 100)
    monkeypatch.setattr(N, "_parsed_part", lambda pages: seen.append(len(pages)) or part(pages))
    assert N._parsed(pa.array(html)).equals(whole) and sum(seen) == len(html) and len(seen) > 2
    assert len(N._parsed(pa.array([], pa.string()))) == 0


def test_batches_of_pages_are_bounded_by_bytes(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    N.with_nodes(spark.createDataFrame([("<p>",)], "html string"))
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(shared.BATCH)


def test_places_are_worked_out_once(spark):
    pages = N.with_nodes(spark.createDataFrame([("<div><h2 id='here'>H</h2></div><div>d</div>",)], "html string"))
    n = F.col("nodes")
    at = A.headed(n, "here")
    for c in (N.siblings(n, A.around(n, at)), N.inside(n, at), A.blocks(n, at)):
        assert pages.select(c.alias("v"))._jdf.queryExecution().analyzed().toString().count("= here)") == 1


def test_patterns_in_one(spark):
    kinds = [*V.POLICY_TYPES.values(), V.ABOUT_LAWS, (r"\bx|y", r"\bz"), (r"\b(?:a|b)c", r"\bd")]
    words = "impact assessments public consultation efsa road xy roadmap strengthened y zz ac dx withdrawal no new legislation".split()
    draw = random.Random(1)
    texts = [" ".join(draw.choices(words, k=5)).replace("s p", "sp") for _ in range(200)]
    for own in kinds:
        assert [bool(re.search(T.any_of_patterns(own), t)) for t in texts] == [any(re.search(p, t) for p in own) for t in texts]
    assert T.any_of_patterns(V.ABOUT_LAWS).startswith(r"\b(?:") and not T.any_of_patterns((r"\bx|y", r"\bz")).startswith(r"\b")


def test_rows_of_listing_pages_that_are_read_already(spark):
    block = '<div class="ecl-content-block ecl-content-item__content-block"><div class="ecl-content-block__title"><a class="ecl-link" href="/initiatives/details/1">A</a></div></div>'
    pages = N.with_nodes(spark.createDataFrame([(block,), ("<p>none",), (None,)], "html string"))
    stored = pages.select(P.listed(F.col("nodes"), F.col("pieces")).alias("b"))
    assert P.listing_rows(stored, "u", blocks=F.col("b")).collect() == P.listing_rows(pages, "u").collect()


def test_texts_are_worked_out_once(spark):
    row = spark.createDataFrame([("a\x00b",)], "t string")
    text = F.concat(F.col("t"), F.lit("__here__"))
    hrefs = F.array(text)
    for c in (P.followup_flag(text, "partnership"), A.hearing_date(text), A.dated(text, "on "), D.parsed(text), D.parsed_end(text), L.legislation_by_name(text), P.legislation_by_id(F.lit("x"), hrefs), T.filled(text)):
        assert row.select(c.alias("v"))._jdf.queryExecution().analyzed().toString().count("__here__") == 1


def test_white_space_of_all_kinds(spark):
    draw = random.Random(2)
    texts = ["".join(draw.choices("ab" + T.WHITE + " \x1c​", k=12)) for _ in range(400)] + ["", " ", "a", "a  b"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(T.stripped(F.col("t")), T.normalized(F.col("t")), F.regexp_replace("t", r"(?U)^\s+|\s+$", ""), F.trim(F.regexp_replace("t", r"(?U)\s+", " "))).collect()
    assert all(r[0] == r[2] and r[1] == r[3] for r in got)


def test_signs_and_beginnings_leave_no_match_out():
    draw = random.Random(3)
    words = "will table a legislative proposal by 2025, provide data for until run runs by in efsa report call consultation evidence launch assessment produce publish was not adopted approved directive law new standards planned review plans for proposals on withdrew became applicable entered into force".split()
    texts = [" ".join(draw.choices(words, k=9)) for _ in range(3000)]
    for p in V.DEADLINES:
        assert T.beginnings(p) and all(m[0].startswith(T.beginnings(p)) for t in texts for m in re.finditer(p, t))
    for k, own in V.LEGISLATIVE.items():
        assert all(any(s in t for s in V.LEGISLATIVE_SIGNS[k]) for t in texts if re.search("|".join(own), t))
    assert T.beginnings("ab c[d]") == ("ab c",) and T.beginnings("ab?c") == T.beginnings("a|b") == T.beginnings("(?:a|b)?c") == T.beginnings(r"\d") == ()


def test_alternatives_by_letter():
    words = ["abc", "b", "ad", "a?x", "(?:ab|cd)e", "reports? (?:was|were)", "b", "x|y", "xz"]
    texts = ["".join(t) for n in (1, 2, 3) for t in itertools.product("abcdexyz", repeat=n)] + ["reports were"]
    assert [bool(re.fullmatch(T.by_letter(words), t)) for t in texts] == [bool(re.fullmatch("|".join(words), t)) for t in texts]
