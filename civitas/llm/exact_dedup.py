"""Exact deduplication by deterministic block naming, in DataFrame operations only.

Every normalised text is cut into blocks of a fixed number of characters. The
distinct blocks are sorted and numbered; equal blocks, and only these, get the
same integer. Then names of adjacent blocks are paired, the distinct pairs are
sorted and numbered in turn, and so on until each document has one integer. Two
documents of as many blocks have the same integer exactly if their normalised
texts are identical: no step depends on a hash having no collisions.

Text crosses the network once, as distinct blocks (combined before the shuffle).
Occurrences carry a 64-bit routing key instead of the block; routing keys that
two different blocks share are found by an exact count, and the occurrences of
these alone are joined on the block itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from civitas.llm.common import WHITE, scratch, stored

#: Characters in a block.
BLOCK = 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, "")


def _numbered(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """Sort within the partitions that hold whole keys and number the rows without gaps between tasks."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def _first_names(spark: SparkSession, blocks: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """(routing key -> name) where the key has one block, and (key, block -> name) for the rest."""
    distinct = blocks.groupBy("route", "block").agg(F.count(F.lit(1)).alias("uses"))
    named = stored(spark, _numbered(distinct, ["block"]).select("route", "name"), folder, "names0")
    shared = named.groupBy("route").agg(F.count(F.lit(1)).alias("blocks")).where("blocks > 1").select("route")
    if not shared.take(1):
        return named, None
    shared = stored(spark, shared, folder, "shared")
    several = blocks.join(shared, "route", "left_semi").select("block").distinct()
    several = _numbered(several, ["block"]).withColumn("name", -2 - F.col("name"))
    return named.join(shared, "route", "left_anti"), stored(spark, several, folder, "names0s")


def identities(spark: SparkSession, docs: DataFrame, block: int = BLOCK, route=F.xxhash64) -> DataFrame:
    """One row per input row: doc_id, text_sha256, points, n_blocks, name.

    (n_blocks, name) is the collision-free identity of the normalised text. A null
    text counts as empty; an empty text has no block and the name -1. Rows that repeat
    a doc_id and text are all returned. `route` picks the routing key (a parameter
    so that tests can force keys to clash).
    """
    folder = scratch(spark)
    norm = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", F.char_length("text").cast("long").alias("points"), normalised(F.col("text")).alias("norm")
    )
    cut = norm.select(
        "doc_id", "points", F.sha2("norm", 256).alias("text_sha256"), F.regexp_extract_all("norm", F.lit("(?s).{1,%d}" % block), F.lit(0)).alias("blocks")
    )
    routed = F.transform("blocks", lambda b: route(b))
    rows = stored(spark, cut.select("doc_id", "points", "text_sha256", F.size("blocks").alias("n_blocks"), routed.alias("routes")), folder, "rows")
    # the outer form: the plain one would test the array's size in a filter that cuts every text once more
    blocks = cut.select(F.explode_outer("blocks").alias("block")).where("block IS NOT NULL").select("block", route("block").alias("route"))
    plain, exact = _first_names(spark, blocks, folder)

    one = rows.where("n_blocks <= 1").select("doc_id", "points", "text_sha256", "n_blocks", F.try_element_at("routes", F.lit(1)).alias("route"))
    many = rows.where("n_blocks > 1").select("doc_id", "text_sha256", "n_blocks", F.posexplode("routes").alias("pos", "route"))
    if exact is None:
        one = one.join(plain, "route", "left")
        level = many.join(plain, "route")
    else:
        again = cut.select("doc_id", "points", "text_sha256", F.size("blocks").alias("n_blocks"), F.posexplode_outer("blocks").alias("pos", "block"))
        again = again.withColumn("route", route("block")).join(plain.withColumnRenamed("name", "plain"), "route", "left")
        again = again.join(exact.withColumnRenamed("name", "exact"), "block", "left").withColumn("name", F.coalesce("plain", "exact"))
        one, level = again.where("n_blocks <= 1"), again.where("n_blocks > 1")
    one = one.select("doc_id", "text_sha256", "points", "n_blocks", F.when(F.col("n_blocks") == 0, F.lit(-1)).otherwise(F.col("name")).cast("long").alias("name"))
    level = stored(spark, level.select("doc_id", "text_sha256", "n_blocks", F.col("pos").cast("long").alias("pos"), "name"), folder, "level0")

    most, turn = (rows.agg(F.max("n_blocks")).first()[0] or 0), 0
    while most > 1:
        turn, most = turn + 1, (most + 1) // 2
        key = ["doc_id", "text_sha256", "n_blocks", F.floor(F.col("pos") / 2).cast("long").alias("pos")]
        side = lambda k: F.max(F.when(F.col("pos") % 2 == k, F.col("name")))
        pairs = level.groupBy(*key).agg(side(0).alias("a"), F.coalesce(side(1), F.lit(-1)).alias("b"))
        pairs = stored(spark, pairs, folder, f"pairs{turn}")
        names = stored(spark, _numbered(pairs.select("a", "b").distinct(), ["a", "b"]), folder, f"names{turn}")
        level = pairs.join(names, ["a", "b"]).select("doc_id", "text_sha256", "n_blocks", "pos", "name")
    if turn:
        level = stored(spark, level, folder, "last")
    final = level.select(F.col("doc_id").alias("d"), F.col("text_sha256").alias("s"), "name")
    long = rows.where("n_blocks > 1").select("doc_id", "text_sha256", "points", "n_blocks")
    long = long.join(final, long.doc_id.eqNullSafe(final.d) & (long.text_sha256 == final.s)).select("doc_id", "text_sha256", "points", "n_blocks", "name")
    return one.unionByName(long)


def exact_dedup(spark: SparkSession, docs: DataFrame, block: int = BLOCK, route=F.xxhash64) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without ASCII white space; null counts as empty.
    Of equal texts the one of most code points stays, then that of the smallest
    doc_id. Rows that repeat the same doc_id and text are counted in group_size and
    share the verdict of their doc_id. Other columns are ignored, whatever their
    names; an empty table gives no row.
    """
    folder = scratch(spark)
    named = stored(spark, identities(spark, docs, block, route), folder, "identities")
    best = F.min_by("doc_id", F.struct(-F.col("points"), F.col("doc_id")))
    groups = named.groupBy("n_blocks", "name").agg(best.alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = stored(spark, groups, folder, "groups")  # as a table, so that Spark can split a hot group in the join
    return named.join(groups, ["n_blocks", "name"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm ORDER BY points DESC, doc_id)
"""
