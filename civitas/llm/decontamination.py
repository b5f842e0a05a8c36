r"""Benchmark decontamination by template canonicalisation, in DataFrame operations only.

Numbers, names (capitalised words, also at the start of a sentence) and units after a
number become typed placeholders; case and punctuation go. Windows of `WINDOW` words of
the template are hashed and joined between benchmark items and documents, and so are
windows of the words themselves, in lower case and without placeholders. An item leaks
where enough of its windows match along one alignment; for templates the slots must agree
too: a benchmark value must stand for one and the same value of the document throughout.
Matching words, or slots of equal values, make a verbatim leak, consistently replaced
slots a re-parameterised one. Items without a window of their own (short ones, or those
of hardly more than placeholders) are joined as a whole, at their own length.

Only benchmark windows are broadcast, and only after counting them; beyond
`BROADCAST_ROWS` the join is left to shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from civitas.llm.common import scratch, stored

WINDOW = 8
#: Words of a window that must not be placeholders.
LITERAL = 5
#: The fewest words of an item that is looked for verbatim, and the fewest that are no placeholders
#: in a template of fewer than `WINDOW` words; what has less is met by chance (see `unsearched`).
SHORT, SHORT_LITERAL = 3, 4
#: Matching windows along one alignment that make a leak; for shorter items half of theirs, as the
#: words around a passage can change how its first and last word look.
ENOUGH = 6
BROADCAST_ROWS = 1_000_000

# Units known after a number.
UNITS = "kg|g|mg|lb|lbs|oz|km|m|cm|mm|mi|ft|in|l|ml|h|min|s|ms|hz|khz|mhz|ghz|kb|mb|gb|tb|w|kw|v|a|j|kj|n|pa|kpa|°c|°f|k|mol|percent|dollars?|euros?|pounds?|cents?|hours?|minutes?|seconds?|days?|weeks?|months?|years?|meters?|metres?|miles?|feet|inches|liters?|litres?|grams?|kilograms?|kilometers?|kilometres?"
NUMBER = r"\p{N}+(?:[.,:/]\p{N}+)*"
#: A capitalised word, also with an apostrophe or a capital inside.
_NAME = r"\p{Lu}(?:['’]\p{Lu})?\p{Ll}+(?:\p{Lu}\p{Ll}+)*"
NAME = rf"(?<![\p{{L}}\p{{N}}]){_NAME}(?![\p{{L}}\p{{N}}])"
#: Names inside a sentence: only these count against `LITERAL`.
INNER = rf"(?<=[\p{{L}}\p{{N}},;] ){_NAME}(?![\p{{L}}\p{{N}}])"
#: Placeholders: private code points, so no text has them by chance; others of their kind are blanked.
HOLD = {"name": "\ue001", "number": "\ue002", "unit": "\ue003"}
OWN = "".join(HOLD.values())


def template(text: Column, name: str = NAME) -> Column:
    """The words of the canonical template."""
    out = F.translate(F.coalesce(text, F.lit("")), OWN, "   ")
    out = F.regexp_replace(out, name, HOLD["name"])
    out = F.regexp_replace(out, NUMBER, f" {HOLD['number']} ")
    out = F.regexp_replace(out, f"(?i)(?<={HOLD['number']} {{1,2}})(?:{UNITS})(?![\\p{{L}}\\p{{N}}])", HOLD["unit"])
    return F.filter(F.split(F.lower(out), rf"[^\p{{L}}\p{{N}}{OWN}]+"), lambda w: w != "")


def plain(text: Column) -> Column:
    """The words themselves; names with an apostrophe are two."""
    blank = F.translate(F.coalesce(text, F.lit("")), OWN, "   ")
    return F.regexp_extract_all(F.lower(blank), F.lit(rf"{NUMBER}|\p{{L}}+"), F.lit(0))


def slot_values(text: Column) -> Column:
    """What the placeholders of the template stand for, in order, in lower case."""
    blank = F.translate(F.coalesce(text, F.lit("")), OWN, "   ")
    every = rf"{NAME}|{NUMBER}|(?<=\p{{N}} {{0,1}})(?i:{UNITS})(?![\p{{L}}\p{{N}}])"
    return F.transform(F.regexp_extract_all(blank, F.lit(every), F.lit(0)), lambda v: F.lower(v))


def _held(word: Column) -> Column:
    return word.isin(*HOLD.values())


def _hashes(hashes: Column, window: int) -> Column:
    """A hash for each window of words, from the words' hashes."""
    each = lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(window))) if window <= WINDOW else F.xxhash64(F.slice(hashes, i + 1, window))
    return F.when(F.size(hashes) >= window, F.transform(F.sequence(F.lit(0), F.size(hashes) - window), each)).otherwise(F.array().cast("array<long>"))


def windows(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """row, at, window_hash: the windows of templates and those of words (the same twice where no placeholder is in them).

    Words are hashed once for each text. A row for each place then hashes the windows that
    begin there in generated code; the arrays are not copied for it. Windows of items longer
    than `WINDOW` are hashed in a second pass, which only such items cause.
    """
    each = lambda c: F.transform(c, lambda w: F.xxhash64(w))
    held = docs.select("row", each(template(F.col("text"))).alias("t"), each(plain(F.col("text"))).alias("p"))
    # the outer form: the plain one would test the array's size in a filter that works all of it out once more
    placed = held.select("row", "t", "p", F.explode_outer(F.sequence(F.lit(0), F.greatest(F.size("t"), F.size("p")) - 1)).alias("at")).where("at >= 0")
    one = lambda c, n: F.when(F.col("at") + n <= F.size(c), F.xxhash64(*(F.get(c, F.col("at") + k) for k in range(n))))
    out = placed.select("row", "at", F.explode_outer(F.array(*(one(c, n) for n in lengths if n <= WINDOW for c in "tp"))).alias("window_hash"))
    if long := [n for n in lengths if n > WINDOW]:
        numbered = lambda c: F.transform(c, lambda h, i: F.struct(i.alias("at"), h.alias("window_hash")))
        more = held.select("row", F.explode_outer(F.concat(*(numbered(_hashes(F.col(c), n)) for n in long for c in "tp"))).alias("w"))
        out = out.unionByName(more.select("row", "w.at", "w.window_hash"))
    return out.where("window_hash IS NOT NULL")


def _searched(items: DataFrame, window: int) -> DataFrame:
    """item_id, form (`words` or `template`), n: the length of the windows an item is looked for by; no row where it cannot be."""
    words, inner = template(F.col("text")), template(F.col("text"), INNER)
    literal = lambda w: F.size(F.filter(w, lambda x: ~_held(x)))
    own = items.select("item_id", F.size(plain(F.col("text"))).alias("size"), F.size(words).alias("n"), literal(words).alias("literal"), inner.alias("inner"))
    good = F.exists(F.sequence(F.lit(0), F.greatest(F.col("n") - window, F.lit(0))), lambda i: literal(F.slice("inner", i + 1, window)) >= LITERAL) & (F.col("n") >= window)
    whole = F.when(F.col("literal") >= F.when(F.col("n") >= window, 1).otherwise(SHORT_LITERAL), F.col("n"))
    words = own.where(F.col("size") >= SHORT).select("item_id", F.lit("words").alias("form"), F.least("size", F.lit(window)).alias("n"))
    return words.unionByName(own.select("item_id", F.lit("template").alias("form"), F.when(good, window).otherwise(whole).alias("n")).where("n IS NOT NULL"))


def unsearched(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id, words, template: the items that are not looked for by their words or not by their template."""
    found = _searched(benchmark, window).groupBy("item_id").agg(*(F.max(F.col("form") == k).alias(k) for k in ("words", "template")))
    out = benchmark.select("item_id").distinct().join(found, "item_id", "left")
    return out.select("item_id", *(F.coalesce(k, F.lit(False)).alias(k) for k in ("words", "template"))).where("NOT (words AND template)")


def _item_windows(items: DataFrame, searched: DataFrame, lengths: list[int]) -> DataFrame:
    """item_id, form, n, item_at, window_hash, literal: the windows items are looked for by."""
    held = items.join(searched, "item_id").withColumn("inner", template(F.col("text"), INNER)).withColumn("words", F.when(F.col("form") == "words", plain(F.col("text"))).otherwise(template(F.col("text"))))
    held = held.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    own = F.coalesce(*(F.when(F.col("n") == n, _hashes(F.col("hashes"), n)) for n in lengths))
    held = held.withColumn("own", own).select("item_id", "form", "n", "words", "inner", F.posexplode_outer("own").alias("item_at", "window_hash")).where("window_hash IS NOT NULL")
    literal = lambda c: F.size(F.filter(F.slice(c, F.col("item_at") + 1, F.col("n")), lambda w: ~_held(w)))
    held = held.select("item_id", "form", "n", "item_at", "window_hash", literal("words").alias("literal"), literal("inner").alias("inner"), (F.size("words") == F.col("n")).alias("whole"))
    return held.where((F.col("form") == "words") | F.col("whole") | (F.col("inner") >= LITERAL)).drop("inner", "whole")


def leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, enough: int = ENOUGH) -> DataFrame:
    """One row per document and benchmark item that leaks into it: doc_id, item_id, n_windows, n_slots, kind.

    kind is `verbatim` or `reparameterised`. Items of the same template and slots count
    as one, named by the smallest item_id. Items that cannot be told from chance leak
    nowhere, or only verbatim: `unsearched` lists them. Null and empty texts have no
    window. Every row is judged by itself, whatever its doc_id (a null one, too, stays
    null); rows that repeat a doc_id give one row an item, of the row in which more windows
    match. Other columns of either table are ignored; an empty table on either side gives
    no row.
    """
    folder = scratch(spark)
    # A row is its doc_id and text: rows equal in both are one, and only texts of one doc_id could be confused by the hash.
    docs = docs.select("doc_id", F.struct("doc_id", F.xxhash64("text").alias("h")).alias("row"), "text")
    items = benchmark.where("item_id IS NOT NULL").select("item_id", "text", template(F.col("text")).alias("words"), slot_values(F.col("text")).alias("values"))
    items = items.groupBy("words", "values").agg(F.min("item_id").alias("item_id"), F.min_by("text", "item_id").alias("text"))
    items = stored(spark, items.select("item_id", "text"), folder, "items")
    searched = stored(spark, _searched(items, window), folder, "searched")
    lengths = sorted({window, *(r[0] for r in searched.select("n").distinct().collect())})
    base = stored(spark, _item_windows(items, searched, lengths), folder, "windows")
    needs = base.groupBy("item_id", "form").agg(F.least(F.ceil(F.countDistinct("item_at") / 2), F.lit(enough)).alias("need"))
    few = base.count() <= BROADCAST_ROWS

    own = windows(docs, lengths)
    hits = own.join(F.broadcast(base) if few else base, "window_hash")
    hits = hits.groupBy("row", "item_id", "form", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.countDistinct("item_at").alias("n_windows"),
        F.countDistinct(F.when(F.col("literal") == F.col("n"), F.col("item_at"))).alias("n_plain"),
        F.min("item_at").alias("lo"),
        F.max(F.col("item_at") + F.col("n")).alias("hi"),
    )
    hits = stored(spark, hits.join(needs, ["item_id", "form"]).where("n_windows >= need"), folder, "hits")

    def slots(rows: DataFrame, keep: str) -> DataFrame:
        """keep, at, value: a row for each placeholder; both arrays are made once for a text, before they become rows."""
        held = F.filter(F.transform(template(F.col("text")), lambda w, i: F.struct(i.alias("at"), _held(w).alias("held"))), lambda s: s["held"])
        both = F.zip_with(held, slot_values(F.col("text")), lambda h, v: F.struct(h["at"].alias("at"), v.alias("value")))
        return rows.select(keep, F.explode_outer(both).alias("s")).where("s.at IS NOT NULL").select(keep, "s.at", "s.value")

    theirs = slots(items, "item_id").select("item_id", F.col("at").alias("item_at"), F.col("value").alias("item_value"))
    wanted = hits.where("form = 'template'").join(theirs, "item_id").where("item_at >= lo AND item_at < hi").select("row", "item_id", "shift", "item_value", (F.col("item_at") + F.col("shift")).alias("at"))
    if wanted.take(1):
        some = docs.join(wanted.select("row").distinct(), "row", "left_semi").dropDuplicates(["row"])
        pairs = wanted.join(slots(some, "row"), ["row", "at"])
        each = pairs.groupBy("row", "item_id", "shift", "item_value").agg(
            F.countDistinct("value").alias("values"), F.count(F.lit(1)).alias("n"), F.bool_and(F.col("value") == F.col("item_value")).alias("same")
        )
        agreed = each.groupBy("row", "item_id", "shift").agg(F.max("values").alias("most"), F.sum("n").alias("n_slots"), F.bool_and("same").alias("same")).withColumn("form", F.lit("template"))
        hits = hits.join(agreed, ["row", "item_id", "shift", "form"], "left")
    else:
        hits = hits.select("*", F.lit(None).cast("long").alias("most"), F.lit(None).cast("long").alias("n_slots"), F.lit(None).cast("boolean").alias("same"))
    hits = hits.where("coalesce(most, 1) <= 1 OR n_plain >= need")
    verbatim = F.coalesce("same", F.lit(True))
    best = hits.groupBy(F.col("row.doc_id").alias("doc_id"), "item_id").agg(F.max(F.struct("n_windows", verbatim.alias("verbatim"))).alias("b"), F.max(F.coalesce("n_slots", F.lit(0))).alias("n_slots"))
    return best.select("doc_id", "item_id", "b.n_windows", "n_slots", F.when(F.col("b.verbatim"), "verbatim").otherwise("reparameterised").alias("kind"))
