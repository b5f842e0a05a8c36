import json

import pytest
from pyspark.sql import functions as F

from civitas.operators import merge as M


def one(spark, rule, b, f):
    return spark.createDataFrame([(b, f)], "b string, f string").select(rule(F.col("b"), F.col("f")).alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("rule", "b", "f", "want"),
    [
        ("prefer_followup", "x", "None", "x"), ("prefer_followup", "x", "y", "y"), ("prefer_base", "", "y", "y"), ("labelled", "a", "a", "a"),
        ("labelled", "a", "b", "**Original Response:**\na\n\n**Current Followup:**\nb"), ("labelled", "", "", ""), ("latest_date", "2020-01-02", "2021-01-02", "2021-01-02"),
        ("latest_date", "soon", "2021-01-02", "2021-01-02"), ("earliest_date", "2020-01-02", "2021-01-02", "2020-01-02T00:00:00"), ("list_union", '["a","a"]', '["b","a"]', '["a","a","b"]'),
        ("list_union", "{}", "null", ""), ("either", "yes", "no", "True"), ("both", "1", "False", "False"), ("promised", "True", "False", "True"), ("rejected", "", "1", "True"),
        ("keep_base", "a", "b", "a"), ("keep_followup", "a", "b", "b"), ("outcome", "a", "", "a"),
    ],
)
def test_rules(spark, rule, b, f, want):
    assert one(spark, M.RULES[rule], b, f) == want


def test_object_union(spark):
    got = json.loads(one(spark, M.object_union, '{"x": ["b"], "y": "1"}', '{"x": ["a", "b"], "y": "two", "z": [1]}'))
    assert got == {"x": ["a", "b"], "y": "two", "z": [1]}
    assert json.loads(one(spark, M.object_union, '{"n": "13", "m": 13}', '{"k": true, "l": ["13", 13], "o": {"p": null}}')) == {"n": "13", "m": 13, "k": True, "l": ["13", 13], "o": {"p": None}}
    assert one(spark, M.object_union, "{}", "nonsense") == "" and json.loads(one(spark, M.object_union, "{'a': None}", "")) == {"a": None}


def test_fallback_to_the_base(spark):
    assert one(spark, M.or_base(lambda b, f: f.try_cast("int").cast("string")), "x", "soon") == "x"


def test_document_union(spark):
    got = json.loads(one(spark, M.document_union, '[{"text": "a", "url": "u"}, {"text": "bad"}]', '[{"text": "b", "url": "u"}, {"text": "c", "url": "v"}]'))
    assert got == [{"text": "a", "url": "u"}, {"text": "c", "url": "v"}]


def test_merge_keeps_base_order_and_unmatched_rows(spark):
    base = spark.createDataFrame([("1", "a", "p"), ("2", "b", "q")], "k string, v string, w string")
    more = spark.createDataFrame([("1", "c", 1), ("1", "d", 2)], "k string, v string, n int")
    more = M.last_of_each(more, "k", [F.desc("n")]).drop("n")
    got = M.merge(base, more, "k", {})
    assert got.columns == ["k", "v", "w"]
    assert sorted(map(tuple, got.collect())) == [("1", "d", "p"), ("2", "b", "q")]


def test_violations(spark):
    base = spark.createDataFrame([("1", "a", ""), ("2", "b", "q")], "k string, v string, w string")
    more = spark.createDataFrame([("1", "z", "x"), ("3", "b", "x"), ("4", "b", "x")], "k string, v string, extra string")
    got = {(r.rule, r.key, r.detail) for r in M.violations(base, more, "k", immutable=["v"], mandatory_base=["w"]).collect()}
    assert ("unknown_column", "", "extra") in got and ("unknown_key", "3", "") in got and ("immutable_changed", "1", "v") in got and ("mandatory_missing_in_base", "1", "w") in got
    assert any(r[0] == "more_followups_than_base" for r in got)


def test_strict_rule_fails(spark):
    with pytest.raises(Exception, match="immutable"):
        one(spark, M.keep_base_strict, "a", "b")


def test_backward_moves(spark):
    b, f = spark.createDataFrame([("1", "adopted")], "k string, s string"), spark.createDataFrame([("1", "committed")], "k string, s string")
    assert M.backward_moves(b, f, "k", "s", ["committed", "adopted"]).collect()[0]["after"] == "committed"
