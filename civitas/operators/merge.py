"""Keyed merge of a base and a follow-up table, one conflict rule for each column.

Both sides are all-string tables. Every rule is a Column of the two values, so a merge
is one left join and one projection; broken rules become rows of a violations table, or
errors in strict mode.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from civitas.functions import json_ops as J
from civitas.functions.text import bound

Rule = Callable[[Column, Column], Column]



def filled(c: Column) -> Column:
    """The value, or null where it is empty or spells None or null."""
    return F.when(~F.lower(F.trim(c)).isin("", "none", "null"), c)


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def prefer_followup(b: Column, f: Column) -> Column:
    return F.coalesce(filled(f), text(b))


def prefer_base(b: Column, f: Column) -> Column:
    return F.coalesce(filled(b), text(f))


def labelled(b: Column, f: Column) -> Column:
    """Both texts under labels; one copy where they are equal or one is empty."""
    x, y = filled(b), filled(f)
    both = F.concat(F.lit("**Original Response:**\n"), F.trim(x), F.lit("\n\n**Current Followup:**\n"), F.trim(y))
    return F.when(x.isNull() | y.isNull() | (F.trim(x) == F.trim(y)), text(F.coalesce(x, y))).otherwise(both)


def _day(c: Column) -> Column:
    return F.to_date(F.try_to_timestamp(filled(c)))


def latest_date(b: Column, f: Column) -> Column:
    x, y = _day(b), _day(f)
    unread = (filled(b).isNotNull() & x.isNull()) | (filled(f).isNotNull() & y.isNull())
    return F.when(unread, prefer_followup(b, f)).otherwise(text(F.greatest(x, y).cast("string")))


def earliest_date(b: Column, f: Column) -> Column:
    """The earlier one, written with its midnight."""
    x, y = _day(b), _day(f)
    unread = (filled(b).isNotNull() & x.isNull()) | (filled(f).isNotNull() & y.isNull())
    return F.when(unread, prefer_base(b, f)).otherwise(text(F.concat(F.least(x, y).cast("string"), F.lit("T00:00:00"))))


def list_union(b: Column, f: Column) -> Column:
    """JSON arrays: the base's items, then those only the follow-up has; empty for no item."""
    x, y = J.items(b), J.items(f)
    out = F.concat(x, F.array_except(y, x))
    return F.when(F.size(out) == 0, "").otherwise(F.to_json(out))


def object_union(b: Column, f: Column) -> Column:
    """JSON objects: lists are united (sorted), other members taken from the follow-up where it has them, as they are written."""
    is_list = lambda v: F.coalesce(F.startswith(F.ltrim(v), F.lit("[")), F.lit(False))
    raw = lambda v: F.transform(F.from_json(v, "array<variant>"), lambda x: F.to_json(x))

    def member(_, p, q):
        united = F.concat(F.lit("["), F.array_join(F.array_sort(F.array_distinct(F.concat(raw(p), raw(q)))), ","), F.lit("]"))
        return F.when(is_list(p) & is_list(q), united).otherwise(F.coalesce(q, p))

    def written(out: Column) -> Column:
        name = lambda k: F.substring(F.to_json(F.array(k)), 2, 1 << 30)
        entry = lambda k: F.concat(F.regexp_replace(name(k), r"\]$", ""), F.lit(":"), F.coalesce(F.element_at(out, k), F.lit("null")))
        body = F.array_join(F.transform(F.array_sort(F.map_keys(out)), entry), ",")
        return F.when(F.size(out) == 0, "").otherwise(F.concat(F.lit("{"), body, F.lit("}")))

    return bound(F.map_zip_with(J.raw_pairs(b), J.raw_pairs(f), member), written)


def or_base(rule: Rule) -> Rule:
    """A rule whose null (a value it could not work out) falls back to the base's value."""
    return lambda b, f: F.coalesce(rule(b, f), text(b))


def truthy(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c)).isin("true", "1", "yes"), F.lit(False))


def _shown(c: Column) -> Column:
    return F.initcap(c.cast("string"))


def either(b: Column, f: Column) -> Column:
    return _shown(truthy(b) | truthy(f))


def both(b: Column, f: Column) -> Column:
    return _shown(truthy(b) & truthy(f))


def promised(b: Column, f: Column) -> Column:
    """Once promised stays promised."""
    return F.when(truthy(b), "True").otherwise(_shown(truthy(f)))


def rejected(b: Column, f: Column) -> Column:
    """A rejection on either side counts; the base's stands."""
    return F.when(truthy(b), "True").otherwise(_shown(truthy(f)))


DOCUMENTS = "array<struct<text:string,url:string>>"


def document_union(b: Column, f: Column) -> Column:
    """Documents of both sides, the base's first, one for each url; malformed ones are dropped."""
    some = lambda c: F.filter(F.coalesce(J.parsed(c, DOCUMENTS), F.array().cast(DOCUMENTS)), lambda d: d["url"].isNotNull() & (d["url"] != ""))
    every = F.concat(some(b), some(f))
    first = F.aggregate(every, F.array().cast(DOCUMENTS), lambda acc, d: F.when(F.exists(acc, lambda a: a["url"] == d["url"]), acc).otherwise(F.array_append(acc, d)))
    return F.when(F.size(first) == 0, "").otherwise(F.to_json(first))


def conflicting(b: Column, f: Column) -> Column:
    """True where a follow-up value differs from the base's."""
    return F.coalesce(filled(f).isNotNull() & (F.trim(f) != F.trim(text(b))), F.lit(False))


def keep_base(b: Column, f: Column) -> Column:
    return text(b)


def keep_followup(b: Column, f: Column) -> Column:
    return text(f)


def keep_base_strict(b: Column, f: Column) -> Column:
    return F.when(conflicting(b, f), F.raise_error(F.lit("follow-up differs from an immutable base value")).cast("string")).otherwise(text(b))


RULES: dict[str, Rule] = {
    "prefer_followup": prefer_followup,
    "prefer_base": prefer_base,
    "labelled": labelled,
    "latest_date": latest_date,
    "earliest_date": earliest_date,
    "list_union": list_union,
    "object_union": object_union,
    "either": either,
    "both": both,
    "promised": promised,
    "rejected": rejected,
    "document_union": document_union,
    "keep_base": keep_base,
    "keep_followup": keep_followup,
    "outcome": prefer_followup,
    "implementation_date": prefer_followup,
}

#: Rules of the petition tables; other columns prefer the follow-up.
PETITION_RULES = {
    **dict.fromkeys(
        ("response_url", "initiative_url", "initiative_title", "registration_number", "submission_text", "commission_submission_date", "submission_news_url", "commission_meeting_date",
         "commission_officials_met", "parliament_hearing_date", "parliament_hearing_video_urls", "plenary_debate_date", "plenary_debate_video_urls", "official_communication_adoption_date",
         "has_followup_section", "commission_factsheet_url", "followup_dedicated_website"), "keep_base"),
    "official_communication_document_urls": "document_union",
    **dict.fromkeys(("commission_answer_text", "commission_deadlines", "commission_rejection_reason"), "labelled"),
    "final_outcome_status": "outcome",
    "law_implementation_date": "implementation_date",
    "commission_promised_new_law": "promised",
    "commission_rejected_initiative": "rejected",
    **dict.fromkeys(("laws_actions", "policies_actions", "court_cases_referenced", "followup_events_with_dates"), "list_union"),
    **dict.fromkeys(("has_roadmap", "has_workshop", "has_partnership_programs"), "either"),
    **dict.fromkeys(("referenced_legislation_by_id", "referenced_legislation_by_name"), "object_union"),
    **dict.fromkeys(("followup_latest_date", "followup_most_future_date"), "latest_date"),
}


def last_of_each(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Of rows that repeat a key, the last in the order."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_r = 1").drop("_r")


def merge(base: DataFrame, followup: DataFrame, key: str, rules: dict[str, str | Rule], default: str = "prefer_followup") -> DataFrame:
    """Base rows, merged with the follow-up row of the same key where there is one.

    Rows without a follow-up pass unchanged. A value that a rule cannot work out is the base's. `followup` must hold one row a key (see
    last_of_each). The result has the base's columns in their order.
    """
    right = followup.select(F.col(key).alias("_key"), F.lit(True).alias("_there"), *(F.col(c).alias(f"_f_{c}") for c in followup.columns if c != key))
    joined = base.join(right, F.col(key) == F.col("_key"), "left")
    out = []
    for c in base.columns:
        if c == key or c not in followup.columns:
            out.append(F.col(c))
            continue
        rule = rules.get(c, default)
        rule = or_base(RULES[rule] if isinstance(rule, str) else rule)
        out.append(F.when(F.col("_there"), rule(F.col(c), F.col(f"_f_{c}"))).otherwise(F.col(c)).alias(c))
    return joined.select(*out)


def violations(base: DataFrame, followup: DataFrame, key: str, immutable: Sequence[str] = (), mandatory_both: Sequence[str] = (), mandatory_base: Sequence[str] = ()) -> DataFrame:
    """rule, key, detail: every broken constraint as a row; none means that the inputs may be merged."""
    kind = "rule string, key string, detail string"
    missing = sorted(set(followup.columns) - set(base.columns))
    spark = base.sparkSession
    parts = [spark.createDataFrame([("unknown_column", "", c) for c in missing], kind)]
    k = F.col(key).cast("string").alias("key")
    parts.append(followup.join(base.select(key), key, "left_anti").select(F.lit("unknown_key").alias("rule"), k, F.lit("").alias("detail")))
    sizes = base.agg(F.count(F.lit(1)).alias("b")).join(F.broadcast(followup.agg(F.count(F.lit(1)).alias("f"))))
    text_of = F.format_string("%d base rows, %d follow-up rows", F.col("b"), F.col("f"))
    parts.append(sizes.where("b = 0 OR f = 0").select(F.lit("empty_input").alias("rule"), F.lit("").alias("key"), text_of.alias("detail")))
    parts.append(sizes.where("f > b").select(F.lit("more_followups_than_base").alias("rule"), F.lit("").alias("key"), text_of.alias("detail")))
    # one join for all checked columns: each row brings an array of the rules it breaks
    common = [c for c in base.columns if c in followup.columns and c != key]
    checks = [("immutable_changed", c, conflicting(F.col(c), F.col(f"_f_{c}")) & F.col("_there")) for c in immutable if c in common]
    checks += [("mandatory_missing", c, (filled(F.col(c)).isNull() | filled(F.col(f"_f_{c}")).isNull()) & F.col("_there")) for c in mandatory_both if c in common]
    checks += [("mandatory_missing_in_base", c, filled(F.col(c)).isNull()) for c in mandatory_base]
    if checks:
        needed = sorted({c for name, c, _ in checks if name != "mandatory_missing_in_base"})
        right = followup.select(F.col(key).alias("_key"), F.lit(True).alias("_there"), *(F.col(c).alias(f"_f_{c}") for c in needed))
        joined = base.join(right, F.col(key) == F.col("_key"), "left")
        broken = F.array_compact(F.array(*(F.when(bad, F.struct(F.lit(name).alias("rule"), F.lit(c).alias("detail"))) for name, c, bad in checks)))
        parts.append(joined.select(k, F.explode(broken).alias("x")).select("x.rule", "key", "x.detail"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def backward_moves(base: DataFrame, followup: DataFrame, key: str, column: str, order: Sequence[str]) -> DataFrame:
    """Keys whose follow-up status stands before the base's in an order."""
    rank = lambda c: F.array_position(F.array(*map(F.lit, order)), c)
    right = followup.select(F.col(key).alias("_key"), F.col(column).alias("_f"))
    return base.join(right, F.col(key) == F.col("_key")).where((rank(F.col("_f")) > 0) & (rank(F.col("_f")) < rank(F.col(column)))).select(key, F.col(column).alias("before"), F.col("_f").alias("after"))
