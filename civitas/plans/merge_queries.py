"""The keyed merge on tables derived from supplier: a base and a follow-up with gaps and conflicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from civitas.operators import merge as M
from civitas.plans.analyses import query

SIDES = """b AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE s_name END AS name, '20' || lpad(CAST(10 + s_suppkey % 10 AS VARCHAR), 2, '0') || '-03-01' AS day,
  CASE WHEN s_suppkey % 2 = 0 THEN 'True' ELSE 'False' END AS flag, 'n' || CAST(s_nationkey AS VARCHAR) AS note FROM supplier),
f AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, CASE WHEN s_suppkey % 4 = 0 THEN 'None' ELSE upper(s_name) || '!' END AS name, '20' || lpad(CAST(10 + s_suppkey % 7 AS VARCHAR), 2, '0') || '-05-01' AS day,
  CASE WHEN s_suppkey % 3 = 0 THEN 'yes' ELSE 'no' END AS flag, CASE WHEN s_suppkey % 6 = 0 THEN '' ELSE 'm' || CAST(s_suppkey % 3 AS VARCHAR) END AS note FROM supplier WHERE s_suppkey % 3 <> 1)"""


def sides(t):
    k = F.col("s_suppkey")
    year = lambda n: F.concat(F.lit("20"), F.lpad((10 + k % n).cast("string"), 2, "0"))
    base = t.supplier.select(
        k.cast("string").alias("id"), F.when(k % 5 == 0, "").otherwise(F.col("s_name")).alias("name"), F.concat(year(10), F.lit("-03-01")).alias("day"),
        F.when(k % 2 == 0, "True").otherwise("False").alias("flag"), F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("note"),
    )
    more = t.supplier.where("s_suppkey % 3 <> 1").select(
        k.cast("string").alias("id"), F.when(k % 4 == 0, "None").otherwise(F.concat(F.upper("s_name"), F.lit("!"))).alias("name"), F.concat(year(7), F.lit("-05-01")).alias("day"),
        F.when(k % 3 == 0, "yes").otherwise("no").alias("flag"), F.when(k % 6 == 0, "").otherwise(F.concat(F.lit("m"), (k % 3).cast("string"))).alias("note"),
    )
    return base, more


def merged(rule_name: str, rule_day: str, rule_flag: str, rule_note: str):
    return lambda t: M.merge(*sides(t), "id", {"name": rule_name, "day": rule_day, "flag": rule_flag, "note": rule_note})


def sql(name: str, day: str, flag: str, note: str) -> str:
    own = lambda c, e: f"CASE WHEN f.id IS NULL THEN b.{c} ELSE {e} END AS {c}"
    return f"WITH {SIDES} SELECT b.id, {own('name', name)}, {own('day', day)}, {own('flag', flag)}, {own('note', note)} FROM b LEFT JOIN f ON b.id = f.id"


FILLED = "CASE WHEN lower({0}) NOT IN ('', 'none', 'null') THEN {0} END"
TRUE = "lower({0}) IN ('true', '1', 'yes')"
SHOWN = "CASE WHEN {0} THEN 'True' ELSE 'False' END"
F_NAME, B_NAME = FILLED.format("f.name"), FILLED.format("b.name")
F_NOTE, B_NOTE = FILLED.format("f.note"), FILLED.format("b.note")
LABELS = f"CASE WHEN {B_NOTE} IS NULL OR {F_NOTE} IS NULL OR b.note = f.note THEN coalesce({B_NOTE}, {F_NOTE}, '') ELSE '**Original Response:**' || chr(10) || b.note || chr(10) || chr(10) || '**Current Followup:**' || chr(10) || f.note END"

query("merge_prefer_followup", sql(f"coalesce({F_NAME}, b.name)", "greatest(b.day, f.day)", SHOWN.format(f"({TRUE.format('b.flag')} OR {TRUE.format('f.flag')})"), LABELS))(
    merged("prefer_followup", "latest_date", "either", "labelled")
)
query("merge_prefer_base", sql(f"coalesce({B_NAME}, f.name)", "least(b.day, f.day) || 'T00:00:00'", SHOWN.format(f"({TRUE.format('b.flag')} AND {TRUE.format('f.flag')})"), "f.note"))(
    merged("prefer_base", "earliest_date", "both", "keep_followup")
)
query("merge_keep_base", sql("b.name", f"coalesce({FILLED.format('f.day')}, b.day)", SHOWN.format(f"({TRUE.format('b.flag')} OR {TRUE.format('f.flag')})"), f"coalesce({F_NOTE}, b.note)"))(
    merged("keep_base", "implementation_date", "promised", "outcome")
)


@query(
    "merge_violations",
    f"""WITH {SIDES}, j AS (SELECT b.id, b.name AS bn, f.name AS fn, b.note AS bo, f.note AS fo FROM b JOIN f ON b.id = f.id)
SELECT 'immutable_changed' AS rule, id AS key, 'name' AS detail FROM j WHERE lower(fn) NOT IN ('', 'none', 'null') AND fn <> bn
UNION ALL SELECT 'mandatory_missing', id, 'note' FROM j WHERE bo = '' OR fo = ''
UNION ALL SELECT 'mandatory_missing_in_base', id, 'name' FROM b WHERE name = ''""",
)
def merge_violations(t):
    base, more = sides(t)
    return M.violations(base, more, "id", immutable=["name"], mandatory_both=["note"], mandatory_base=["name"])


JSON_SIDES = """p AS (SELECT n_regionkey AS r, list_sort(list(n_name)) AS x, list_sort(list(n_name) FILTER (WHERE n_nationkey % 2 = 0)) AS b, list_sort(list(n_name) FILTER (WHERE n_nationkey % 3 = 0)) AS f FROM nation GROUP BY 1)"""


@query(
    "merge_json_lists",
    f"WITH {JSON_SIDES}, u AS (SELECT r, list_concat(coalesce(b, []), list_filter(coalesce(f, []), lambda i: NOT list_contains(coalesce(b, []), i))) AS l FROM p) SELECT CAST(r AS BIGINT) AS r, CASE WHEN len(l) = 0 THEN '' ELSE CAST(to_json(l) AS VARCHAR) END AS merged FROM u",
)
def merge_json_lists(t):
    some = lambda n: F.to_json(F.array_sort(F.collect_list(F.when(F.col("n_nationkey") % n == 0, F.col("n_name")))))
    rows = t.nation.groupBy(F.col("n_regionkey").cast("long").alias("r")).agg(some(2).alias("b"), some(3).alias("f"))
    return rows.select("r", M.list_union(F.col("b"), F.col("f")).alias("merged"))


@query(
    "merge_json_objects",
    """SELECT s_suppkey, '{"both":["b' || (s_suppkey % 5) || '","c"' || CASE WHEN s_suppkey % 2 = 0 THEN ',"d"' ELSE '' END || '],"code":"' || (s_suppkey % 7) || '","n":' || CASE WHEN s_suppkey % 3 = 0 THEN 'true' ELSE CAST(s_suppkey AS VARCHAR) END || '}' AS merged FROM supplier""",
)
def merge_json_objects(t):
    """Lists united, numbers and strings of digits kept apart, the follow-up's values first."""
    k = F.col("s_suppkey")
    text = lambda c: c.cast("string")
    base = F.concat(F.lit('{"both": ["c", "b'), text(k % 5), F.lit('"], "code": "'), text(k % 7), F.lit('", "n": '), text(k), F.lit("}"))
    more = F.concat(F.lit('{"both": ["c"'), F.when(k % 2 == 0, ', "d"').otherwise(""), F.lit("]"), F.when(k % 3 == 0, ', "n": true').otherwise(""), F.lit("}"))
    return t.supplier.select("s_suppkey", M.object_union(base, more).alias("merged"))


@query(
    "merge_documents",
    """SELECT s_suppkey, '[{"text":"a","url":"u' || (s_suppkey % 9) || '"}' || CASE WHEN s_suppkey % 2 = 0 THEN ',{"text":"c","url":"v"}' ELSE '' END || ']' AS merged, CASE WHEN s_suppkey % 4 IN (0, 2) THEN 'True' ELSE 'False' END AS rejected FROM supplier""",
)
def merge_documents(t):
    """Documents by address, the base's first; a rejection on either side counts."""
    k = F.col("s_suppkey")
    base = F.concat(F.lit('[{"text": "a", "url": "u'), (k % 9).cast("string"), F.lit('"}, {"text": "bad"}]'))
    more = F.concat(F.lit('[{"text": "b", "url": "u'), (k % 9).cast("string"), F.lit('"}'), F.when(k % 2 == 0, ', {"text": "c", "url": "v"}').otherwise(""), F.lit("]"))
    rejected = M.rejected(F.when(k % 4 == 0, "yes").otherwise(""), F.when(k % 4 == 2, "True").otherwise("False"))
    return t.supplier.select("s_suppkey", M.document_union(base, more).alias("merged"), rejected.alias("rejected"))


# The kind of value that the query gives the columns of a rule.
KINDS = {"keep_base": "word", "labelled": "word", "outcome": "word", "implementation_date": "day", "latest_date": "day", "promised": "flag", "rejected": "flag", "either": "flag", "list_union": "list", "object_union": "object", "document_union": "documents"}
DIVISORS = {"b": 3, "f": 4}


def petition_side(t, side: str):
    """A petition table of customers: words, days, flags, lists, objects and documents that depend on key, column and side."""
    k, n = F.col("c_custkey"), DIVISORS[side]
    out = [k.cast("string").alias("petition")]
    for i, (c, rule) in enumerate(M.PETITION_RULES.items()):
        x = k + i
        digit = (x % n).cast("string")
        joined = lambda *parts: F.concat(*(p if not isinstance(p, str) else F.lit(p) for p in parts))
        values = {
            "word": joined("w" if rule == "keep_base" else f"{side}w", (k % 5).cast("string")),
            "day": joined("20", (10 + (x * n) % 20).cast("string"), "-05-01"),
            "list": joined("['it\\'s', '", digit, "']") if side == "b" else joined('["it\'s", "', digit, '"]'),
            "object": joined('{"a":["', digit, f'"],"{side}":1}}'),
            "documents": joined(f'[{{"text":"{side}","url":"u', digit, '"}]'),
        }
        nothing = {"day": "None", "object": "{}"}
        kind = KINDS[rule]
        value = F.when(x % n == 0, "True").otherwise("False") if kind == "flag" else F.when(x % n == 0, nothing.get(kind, "")).otherwise(values[kind])
        out.append(value.alias(c))
    return (t.customer if side == "b" else t.customer.where("c_custkey % 3 <> 1")).select(*out)


def petition_sql() -> str:
    """The same merge in SQL, column by column."""
    columns = []
    for i, (c, rule) in enumerate(M.PETITION_RULES.items()):
        kind = KINDS[rule]
        x = {s: f"(k + {i}) % {n}" for s, n in DIVISORS.items()}
        none = {s: f"({e} = 0)" for s, e in x.items()}
        word = {s: f"('{'w' if rule == 'keep_base' else s + 'w'}' || k % 5)" for s in x}
        day = {s: f"('20' || (10 + ((k + {i}) * {n}) % 20) || '-05-01')" for s, n in DIVISORS.items()}
        item = {s: f"('\"' || {e} || '\"')" for s, e in x.items()}
        document = {s: f"""('{{"text":"{s}","url":"u' || {e} || '"}}')""" for s, e in x.items()}
        own = {
            "word": f"CASE WHEN {none['b']} THEN '' ELSE {word['b']} END",
            "day": f"CASE WHEN {none['b']} THEN 'None' ELSE {day['b']} END",
            "flag": f"CASE WHEN {none['b']} THEN 'True' ELSE 'False' END",
            "list": f"CASE WHEN {none['b']} THEN '' ELSE '[''it\\''s'', ''' || {x['b']} || ''']' END",
            "object": f"""CASE WHEN {none['b']} THEN '{{}}' ELSE '{{"a":[' || {item['b']} || '],"b":1}}' END""",
            "documents": f"CASE WHEN {none['b']} THEN '' ELSE '[' || {document['b']} || ']' END",
        }[kind]
        either = f"CASE WHEN {none['b']} OR {none['f']} THEN 'True' ELSE 'False' END"
        pick = lambda of, last: f"CASE WHEN {none['b']} AND {none['f']} THEN '' WHEN {none['b']} THEN {of['f']} WHEN {none['f']} THEN {of['b']} ELSE {last} END"  # noqa: B023,E731
        later = lambda of, missing: f"CASE WHEN NOT {none['f']} THEN {of['f']} WHEN {none['b']} THEN '{missing}' ELSE {of['b']} END"  # noqa: B023,E731
        some = lambda of, second: f"list_filter([CASE WHEN NOT {none['b']} THEN {of['b']} END, CASE WHEN NOT {none['f']} AND {second} THEN {of['f']} END], lambda v: v IS NOT NULL)"  # noqa: B023,E731
        new = f"({none['b']} OR {x['b']} <> {x['f']})"
        columns.append(
            f"CASE WHEN k % 3 = 1 THEN {own} ELSE "
            + {
                "keep_base": own,
                "labelled": pick(word, f"'**Original Response:**' || chr(10) || {word['b']} || chr(10) || chr(10) || '**Current Followup:**' || chr(10) || {word['f']}"),
                "outcome": later(word, ""),
                "implementation_date": later(day, "None"),
                "latest_date": pick(day, f"greatest({day['b']}, {day['f']})"),
                "promised": either,
                "rejected": either,
                "either": either,
                "list_union": f"""CASE WHEN {none['b']} AND {none['f']} THEN '' ELSE '["it''s",' || array_to_string({some(item, new)}, ',') || ']' END""",
                "object_union": f"""CASE WHEN {none['b']} AND {none['f']} THEN '' ELSE '{{"a":[' || array_to_string(list_sort({some(item, new)}), ',') || ']' || CASE WHEN {none['b']} THEN '' ELSE ',"b":1' END || CASE WHEN {none['f']} THEN '' ELSE ',"f":1' END || '}}' END""",
                "document_union": f"CASE WHEN {none['b']} AND {none['f']} THEN '' ELSE '[' || array_to_string({some(document, new)}, ',') || ']' END",
            }[rule]
            + f" END AS {c}"
        )
    return "SELECT CAST(k AS VARCHAR) AS petition,\n " + ",\n ".join(columns) + "\nFROM (SELECT c_custkey AS k FROM customer)"


@query("merge_petitions", petition_sql())
def merge_petitions(t):
    """All columns of the petition tables by their rules; the base's lists are Python literals."""
    return M.merge(petition_side(t, "b"), petition_side(t, "f"), "petition", M.PETITION_RULES)
