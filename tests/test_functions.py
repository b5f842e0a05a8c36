import ast
import html
import json
import random
import textwrap
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from civitas.functions import dates as D, fixed_values as V, json_ops as J, text as T
from civitas.operators import relational as R
from civitas.plans.functions_queries import LADDER


def value(spark, column, **inputs):
    row = {k: v for k, v in inputs.items()}
    schema = ", ".join(f"{k} string" for k in row)
    return spark.createDataFrame([tuple(row.values())], schema).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "want"),
    [("9 May 2012", date(2012, 5, 9)), ("09/05/2012", date(2012, 5, 9)), ("9-5-2012", date(2012, 5, 9)), ("2012-5-9", date(2012, 5, 9)), ("May 2012", date(2012, 5, 1)), ("2012", date(2012, 1, 1)), ("31/02/2012", None), ("nothing", None), (None, None)],
)
def test_parsed(spark, text, want):
    assert value(spark, D.parsed(F.col("x")), x=text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("the end of 2023", date(2023, 12, 31)), ("early 2026", date(2026, 3, 31)), ("May 2018", date(2018, 5, 31)), ("spring 2024", date(2024, 6, 20)), ("the second quarter of 2021", date(2021, 6, 30)), ("Q3 2022", date(2022, 9, 30)), ("2020", date(2020, 12, 31)), ("14 June 2021", date(2021, 6, 14)), ("soon", None)],
)
def test_deadline(spark, text, want):
    assert value(spark, D.deadline(F.col("x")), x=text) == want


def test_harvested_dates(spark):
    got = value(spark, D.harvested(F.col("x")), x="On 3 March 2020, then in May 2021, and 2022-01-05; again 3 March 2020")
    assert got == [date(2020, 3, 3), date(2021, 5, 31), date(2022, 1, 5)]


def test_duration(spark):
    assert value(spark, D.duration_text(F.col("x").cast("int")), x="400") == "1 year 1 month 5 days"
    assert value(spark, D.duration_text(F.col("x").cast("int")), x="0") == "0 days"


def test_text(spark):
    assert value(spark, T.normalized(F.col("x")), x="  a\xa0 b\n c ") == "a b c"
    assert value(spark, T.without_trailing_phrases(F.col("x")), x="The Animal Law, in order to protect") == "The Animal Law"
    assert value(spark, T.clean_status(F.col("x")), x="under  verification now") == "Verification"
    assert value(spark, T.number(F.col("x")), x="1,659,543") == 1659543.0
    assert value(spark, T.number(F.col("x"), 0), x="n/a") == 0.0
    assert value(spark, T.percent(F.col("x")), x="404.51%") == 404.51
    assert value(spark, T.year_in(F.col("x")), x="since 2019") == 2019
    assert value(spark, T.wrapped(F.col("x"), 2), x="a b c d e") == "a b<br>c d<br>e"
    assert value(spark, T.shortened(F.col("x"), 8), x="alpha beta gamma") == "alpha..."
    assert value(spark, T.complete_text(F.array(F.col("x"))), x="A &amp;  B&nbsp;C") == "a & b c"
    assert value(spark, T.categories(F.col("x"), {"A": ("sea",), "B": ("bee",), "C": ()}), x="Bees overseas") == ["A", "B"]
    assert value(spark, T.categories(F.col("x"), {"A": ("sea",)}), x=None) == ["Other"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("It became applicable on 27 March 2021", "applicable"), ("entered into force; published in the Official Journal", "applicable"), ("published in the Official Journal", "adopted"),
        ("will table a legislative proposal", "committed"), ("EFSA was tasked with a scientific opinion", "assessment_pending"), ("will work on a roadmap", "roadmap_development"),
        ("no legislative proposal; existing legislation", "rejected_already_covered"), ("no legislative proposal, will monitor", "rejected_with_actions"), ("beyond EU competence", "rejected"),
        ("intends to focus on transparency", "non_legislative_action"), ("a proposal was tabled; rather than proposing new legislative acts", "proposal_pending_adoption"), ("hello", None),
    ],
)
def test_status_ladder(spark, text, want):
    assert value(spark, LADDER(F.col("x")), x=text) == want


def test_classes(spark):
    assert value(spark, T.first_class(F.col("x"), V.LEGISLATIVE), x="The directive was adopted") == "adopted"
    assert value(spark, T.first_class(F.col("x"), V.LEGISLATIVE), x="The rules apply from 2021") == "law_active"
    assert value(spark, T.first_class(F.col("x"), V.POLICY_TYPES), x="a public consultation and workshops") == "Impact Assessment and Consultation"


def test_json(spark):
    assert value(spark, J.items(F.col("x")), x="['a', 'b']") == ["a", "b"]
    assert value(spark, J.items(F.col("x")), x='{"a": 1}') == []
    assert value(spark, J.pairs(F.col("x")), x='{"a": "1"}') == {"a": "1"}
    assert value(spark, J.fragments(F.col("x")), x='x {"a": "1"} y {"a": "2", "b": "3"}') == {"a": "2", "b": "3"}
    assert value(spark, J.case_number(F.col("x")), x="62015CJ0123") == "C-123/15"
    assert value(spark, J.to_celex(F.lit("Regulation"), F.col("x")), x="(EC) No 178/2002") == "32002R0178"


def test_brackets_and_upward(spark):
    got = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (11.0,)], "v double").select(R.cut(F.col("v"), [0, 1, 10], ["a", "b"]).alias("c")).collect()
    assert [r[0] for r in got] == [None, "a", "b", None]
    ranks = {"low": 0, "mid": 1, "top": 2}
    assert value(spark, R.upward(F.col("x"), F.array(F.lit("mid"), F.lit("top")), ranks), x="low") == "top"
    assert value(spark, R.upward(F.col("x"), F.array(F.lit("mid")), ranks), x="top") == "top"


def test_timelines_and_actions(spark):
    steps = F.from_json(F.col("x"), "array<struct<step:string,date:string>>")
    told = '[{"step":"Registered","date":"1"},{"step":"Closed","date":"2"},{"step":"Closed","date":"3"}]'
    assert value(spark, D.step_date(steps, "Closed"), x=told) == "2" and value(spark, D.step_date(steps, "None"), x=told) is None
    assert value(spark, D.step_map(steps), x=told) == {"Registered": "1", "Closed": "3"}
    assert value(spark, J.any_step_contains(steps, "clos"), x=told) is True
    actions = F.from_json(F.col("x"), "array<struct<status:string,description:string,date:string>>")
    acts = '[{"status":"adopted","description":"A vision","date":"2021"},{"status":"adopted","description":"B","date":"2020"}]'
    assert value(spark, D.earliest(actions, ["adopted"]), x=acts) == "2020"
    assert [a["status"] for a in value(spark, J.with_status(actions, "vision", "proposed"), x=acts)] == ["proposed", "adopted"]


def test_people_and_sponsors(spark):
    assert value(spark, J.head_count(F.from_json(F.col("x"), "map<string,int>")), x='{"FR": 2, "DE": 3}') == 5
    sponsors = F.from_json(F.col("x"), "array<struct<name_of_sponsor:string,amount_in_eur:string>>")
    got = value(spark, J.sponsor_stats(sponsors), x='[{"name_of_sponsor":"Ann","amount_in_eur":"1,000.50"},{"name_of_sponsor":"Bees Foundation","amount_in_eur":"n/a"}]')
    assert (got.persons, got.organisations, got.amount) == (1, 1, 1000.5)
    assert value(spark, J.celex(F.col("x")), x="32019R0128").asDict() == {"year": 2019, "kind": "Regulation", "number": 128}
    assert value(spark, T.ratio_text(F.col("x").cast("double")), x="0.5") == "2.0x less" and value(spark, T.short_number(F.col("x").cast("double"), "€"), x="1500") == "€1.5K"


def test_windows_keep_ties_apart(spark):
    rows = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("b", 3, 1)], "g string, k int, v int")
    assert {tuple(r) for r in R.keep_first(rows, ["g"], [F.desc("v"), F.asc("k")]).select("g", "k").collect()} == {("a", 1), ("b", 3)}
    assert {r.g: r.mode_value for r in R.mode(rows, ["g"], "v", least=2).collect()} == {"a": 5, "b": None}
    assert [r.n for r in R.value_counts(rows, "g").orderBy("g").collect()] == [2, 1]
    assert [r.n for r in R.histogram(rows, "v", 1, 5, 2).orderBy("bin").collect()] == [1, 2]


def literals(rng, depth=3):
    """Nested containers of awkward strings, numbers and constants."""
    words = ["it's", 'say "no"', "back\\slash", "None", "True, False", "a\nb\tc", "", "[1, 'x']", "\x07\x0b\x01é", "']", "{'k': None}", "u\\u0041", "\\'", '\\"', "(tuple)", "e, ]"]
    if depth == 0 or rng.random() < 0.3:
        return rng.choice([rng.choice(words), rng.randint(-9, 9), 1.5, None, True, False])
    if rng.random() < 0.5:
        return [literals(rng, depth - 1) for _ in range(rng.randint(0, 4))]
    return {rng.choice(words) + str(i): literals(rng, depth - 1) for i in range(rng.randint(0, 4))}


def test_literals_against_the_standard_library(spark):
    rng = random.Random(1)
    texts = [repr([literals(rng)]) for _ in range(300)] + ["('a', 'b',)", "['a',\n 'b', ]", "{'a': (1, 2)}"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    got = [json.loads(r.v, strict=False) for r in rows.select("i", J.literal_json(F.col("x")).alias("v")).orderBy("i").collect()]
    plain = lambda v: [plain(x) for x in v] if isinstance(v, list | tuple) else {k: plain(x) for k, x in v.items()} if isinstance(v, dict) else v
    assert got == [plain(ast.literal_eval(t)) for t in texts]
    assert value(spark, J.items(F.col("x")), x="['it\\'s', \"None\"]") == ["it's", "None"]


def test_entities_against_the_standard_library(spark):
    texts = ["&amp;&lt;&gt;", "&notit; &notin; &amp", "&#65;&#x41;&#X1F600;x", "&#128;&#129;&#13;&#0;&#xD800;&#1114112;&#99999999999999999999999;", "&#1;&#xFFFE;&#x1FFFF;", "& &; &unknown; &#; a&b", "&CounterClockwiseContourIntegral;", "&eacute&Eacute;", "", "&ampamp;"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    got = [r.v for r in rows.select("i", T.unescaped(F.col("x")).alias("v")).orderBy("i").collect()]
    assert got == [html.unescape(t) for t in texts]
    assert value(spark, T.complete_text(F.array(F.col("x"), F.lit("&eacute; B"))), x=" A &amp; ") == "a &é b"


def test_wrapping_against_the_standard_library(spark):
    rng = random.Random(2)
    words = ["a", "of", "European", "well-known", "state-of-the-art", "x-ray", "co-operation", "Donaudampfschifffahrtsgesellschaft", "e-", "-f", "2020-2021"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 20))) for _ in range(80)] + ["", "  a   b ", "x" * 100]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    for width in (12, 20, 50):
        got = [r.v for r in rows.select("i", T.wrapped_at(F.col("x"), width).alias("v")).orderBy("i").collect()]
        for t, v in zip(texts, got, strict=True):
            assert v == "<br>".join(textwrap.wrap(" ".join(t.split()), width=width, break_on_hyphens=True)), (width, t)


def test_key_examples(spark):
    rows = [("a", i, v, p) for i, (v, p) in enumerate([(1, 0), (1, 1), (1, 1), (1, 0)])] + [("b", 9, 5, 0)] + [("c", i, v, 1) for i, v in enumerate([1, 2, 9, 4])] + [("d", 1, None, 1)] + [("e", i, 7, i % 2) for i in range(2)]
    df = spark.createDataFrame(rows, "g string, k int, v int, p int")
    got = {(r.g, r.example): (r.k, r.at) for r in R.key_examples(df, ["g"], "v", F.col("p") == 1, ["k"], ["k"]).collect()}
    assert got == {
        ("a", "min"): (1, 1.0), ("a", "median"): (2, 1.0), ("a", "max"): (0, 1.0), ("b", "min"): (9, 5.0), ("b", "median"): (9, 5.0), ("b", "max"): (9, 5.0),
        ("c", "min"): (0, 1.0), ("c", "max"): (2, 9.0), ("e", "min"): (1, 7.0), ("e", "median"): (0, 7.0), ("e", "max"): (1, 7.0),
    }


def test_exact_quantiles_with_outliers_ties_and_few_values(spark):
    rng = random.Random(3)
    groups = {"plain": [rng.gauss(0, 1) for _ in range(5000)], "outlier": [rng.random() for _ in range(2000)] + [1e12], "ties": [float(rng.randrange(3)) for _ in range(3000)], "one": [4.0], "two": [1.0, 2.0], None: [5.0, float("inf"), -1e300], "same": [7.0] * 999}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("none", None)], "g string, v double")
    for limit in (10_000, 0):
        R.BROADCAST_GROUPS = limit
        got = {r.g: tuple(r)[1:] for r in R.quantiles(df, ["g"], "v", {"a": 0.25, "b": 0.5, "c": 0.9, "d": 1.0}).collect()}
        want = {g: tuple(np.quantile(vs, [0.25, 0.5, 0.9, 1.0])) for g, vs in groups.items()}
        assert got.keys() == want.keys()
        for g in want:
            assert all(a == b or abs(a - b) <= 1e-9 * max(1, abs(b)) or b != b for a, b in zip(got[g], want[g], strict=True)), g
    R.BROADCAST_GROUPS = 10_000
    at = {(r.g, r.rank_name): (r["at"], r["skip"], r.n) for r in R.at_ranks(df, ["g"], "v", {"first": F.lit(0), "last": F.col("n") - 1}).collect()}
    assert at["ties", "last"] == (2.0, groups["ties"].count(2.0) - 1, 3000) and at["same", "last"] == (7.0, 998, 999) and at["outlier", "last"][0] == 1e12
