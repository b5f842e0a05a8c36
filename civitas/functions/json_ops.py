"""Semi-structured columns kept as JSON text: Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EMPTY = ("", "none", "null", "nan", "{}", "[]")


def present(c: Column) -> Column:
    """The text, or null where it is one of the spellings of nothing."""
    return F.when(~F.lower(F.trim(c)).isin(*EMPTY), c)


#: A string in either kind of quotes with its escapes, or what stands between strings.
LITERAL_TOKENS = r"""(?s)'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[^'"]+|['"]"""
#: Stand for a backslash and a quote that are settled already.
_BACKSLASH, _QUOTE = "", ""


def _json_string(token: Column) -> Column:
    """A quoted string of a Python literal in JSON's quotes and escapes; escapes that JSON lacks keep their backslash."""
    out = F.substring(token, F.lit(2), F.char_length(token) - 2)
    out = F.replace(F.replace(out, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    out = F.replace(F.replace(out, F.lit("\\'"), F.lit("'")), F.lit('"'), F.lit(_QUOTE))
    out = F.regexp_replace(F.replace(out, F.lit("\\\n"), F.lit("")), r"\\x([0-9a-fA-F]{2})", r"\\u00$1")
    out = F.replace(F.replace(out, F.lit("\\a"), F.lit("\\u0007")), F.lit("\\v"), F.lit("\\u000b"))
    out = F.regexp_replace(out, r"\\(?![bfnrt]|u[0-9a-fA-F]{4})", _BACKSLASH)
    return F.concat(F.lit('"'), F.replace(F.replace(out, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\")), F.lit('"'))


def literal_json(c: Column) -> Column:
    """A Python literal of containers, strings, numbers and constants as JSON.

    Tokens are taken from left to right, so that quotes within quotes, escapes and words within
    strings stay what they are.
    """
    is_string = lambda t: F.rlike(t, F.lit(r"(?s)^(?:'.*'|\".*\")$")) & (F.char_length(t) > 1)

    def plain(t: Column) -> Column:
        for word, name in (("None", "null"), ("True", "true"), ("False", "false")):
            t = F.regexp_replace(t, rf"\b{word}\b", name)
        return F.regexp_replace(F.translate(t, "()", "[]"), r",\s*(?=[\]}])", "")

    tokens = F.regexp_extract_all(c, F.lit(LITERAL_TOKENS), F.lit(0))
    return F.array_join(F.transform(tokens, lambda t: F.when(is_string(t), _json_string(t)).otherwise(plain(t))), "")


def parsed(c: Column, schema: str) -> Column:
    """from_json of JSON, or of a Python literal of the same shape (single quotes); null where neither reads."""
    own = present(c)
    options = {"mode": "PERMISSIVE"}
    return F.coalesce(F.from_json(own, schema, options), F.from_json(literal_json(own), schema, options))


def items(c: Column) -> Column:
    """A JSON array's elements as JSON text, [] for anything else."""
    own = F.when(F.startswith(F.ltrim(c), F.lit("[")), parsed(c, "array<string>"))
    return F.coalesce(own, F.array().cast("array<string>"))


def pairs(c: Column) -> Column:
    """A JSON object as map<string, string>, empty for anything else."""
    own = F.when(F.startswith(F.ltrim(c), F.lit("{")), parsed(c, "map<string,string>"))
    return F.coalesce(own, F.create_map().cast("map<string,string>"))


def raw_pairs(c: Column) -> Column:
    """A JSON object as map of names to JSON text, so that "13" and 13 stay apart; empty for anything else."""
    own = F.when(F.startswith(F.ltrim(c), F.lit("{")), parsed(c, "map<string,variant>"))
    return F.coalesce(F.transform_values(own, lambda _, v: F.coalesce(F.to_json(v), F.lit("null"))), F.create_map().cast("map<string,string>"))


def keys_at_least(m: Column, field: str, least: float) -> Column:
    """Keys of map<string, struct> whose field (a percentage as text) reaches a bound."""
    value = lambda v: F.regexp_replace(F.rtrim(F.trim(v[field]), F.lit("%")), ",", "").try_cast("double")
    return F.array_sort(F.map_keys(F.map_filter(m, lambda k, v: F.coalesce(value(v) >= least, F.lit(False)))))


def head_count(m: Column) -> Column:
    """Sum of the members of map<string, int>."""
    return F.aggregate(F.map_values(m), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0)))


def sponsor_stats(a: Column) -> Column:
    """struct<persons, organisations, amount> of array<struct<name_of_sponsor, amount_in_eur>>.

    A name that says legal form or association counts as an organisation.
    """
    organised = lambda s: F.rlike(s["name_of_sponsor"], F.lit(r"(?i)\b(?:gmbh|ltd|asbl|e\.?v\.?|ngo|foundation|association|stiftung|inc|s\.?a\.?|union)\b"))
    amount = lambda s: F.coalesce(F.regexp_replace(s["amount_in_eur"], ",", "").try_cast("double"), F.lit(0.0))
    return F.struct(
        F.size(F.filter(a, lambda s: ~organised(s))).alias("persons"), F.size(F.filter(a, organised)).alias("organisations"), F.aggregate(a, F.lit(0.0), lambda t, s: t + amount(s)).alias("amount")
    )


def fragments(c: Column) -> Column:
    """All {...} fragments of a text, merged; of repeated keys the last stays."""
    maps = F.transform(F.regexp_extract_all(c, F.lit(r"(?s)\{.*?\}"), F.lit(0)), lambda x: pairs(x))
    return F.aggregate(maps, F.create_map().cast("map<string,string>"), lambda acc, m: F.map_zip_with(acc, m, lambda _, a, b: F.coalesce(b, a)))


def any_step_contains(steps: Column, phrase: str) -> Column:
    return F.exists(steps, lambda s: F.contains(F.lower(s["step"]), F.lit(phrase)))


def with_status(actions: Column, phrase: str, status: str) -> Column:
    """The status of actions (struct<status, description, ...>) replaced where the description holds a phrase."""
    return F.transform(actions, lambda a: a.withField("status", F.when(F.contains(F.lower(a["description"]), F.lit(phrase)), status).otherwise(a["status"])))


# Sector 3 letters of legal acts.
ACTS = {"R": "Regulation", "L": "Directive", "D": "Decision"}


def celex(c: Column) -> Column:
    """struct<year, kind, number> of an identifier such as 32019R0128; null fields where it is none."""
    pattern = r"^3(\d{4})([RLD])(\d{4})$"
    kinds = F.create_map(*(F.lit(x) for kv in ACTS.items() for x in kv))
    part = lambda g: F.nullif(F.regexp_extract(F.trim(c), pattern, g), F.lit(""))
    return F.struct(part(1).cast("int").alias("year"), F.try_element_at(kinds, part(2)).alias("kind"), part(3).cast("int").alias("number"))


def to_celex(kind: Column, number: Column) -> Column:
    """`Regulation` and `2019/128` or `(EC) No 178/2002` to an identifier; null where unclear."""
    letters = F.create_map(*(F.lit(x) for k, v in ACTS.items() for x in (v, k)))
    a, b = F.regexp_extract(number, r"(\d+)/(\d+)", 1), F.regexp_extract(number, r"(\d+)/(\d+)", 2)
    old = F.contains(F.lower(number), F.lit("no"))
    year, own = F.when(old, b).otherwise(a), F.when(old, a).otherwise(b)
    year = F.when(F.char_length(year) == 2, F.concat(F.lit("19"), year)).otherwise(year)
    return F.when((a != "") & (F.char_length(year) == 4), F.concat(F.lit("3"), year, F.try_element_at(letters, kind), F.lpad(own, 4, "0")))


def case_number(c: Column) -> Column:
    """62015CJ0123 to C-123/15, 62015TJ0123 to T-123/15."""
    pattern = r"^6(\d{2})(\d{2})(C|T)J(\d{4})$"
    part = lambda g: F.regexp_extract(F.trim(c), pattern, g)
    return F.when(part(3) != "", F.concat(part(3), F.lit("-"), part(4).try_cast("int").cast("string"), F.lit("/"), part(2)))
