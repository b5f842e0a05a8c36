"""Relational building blocks of the analyses: counts, brackets, funnels, extremes, correlations.

All are declarative; global totals are taken from aggregates, never from an unbounded
window over raw rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from civitas.sources.shared import checkpointed


def value_counts(df: DataFrame, col: str, keep_null: bool = False) -> DataFrame:
    """Rows per value and their share of all counted rows; nulls only on request."""
    counted = (df if keep_null else df.where(F.col(col).isNotNull())).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("pct", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


def funnel(df: DataFrame, stages: Sequence[tuple[str, Column]], of_first: str | None = None) -> DataFrame:
    """stage_no, stage, n, kept: how many rows meet each condition, and the share of the stage before; `of_first`: a column of the percentage of the first."""
    one = df.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(f"s{i}") for i, (_, c) in enumerate(stages)))
    rows = [
        F.struct(F.lit(i + 1).alias("stage_no"), F.lit(name).alias("stage"), F.col(f"s{i}").alias("n"), F.round(F.try_divide(F.col(f"s{i}"), F.col(f"s{max(0, i - 1)}")), 6).alias("kept"), *([F.round(F.try_divide(100 * F.col(f"s{i}"), F.col("s0")), 2).alias(of_first)] if of_first else []))
        for i, (name, _) in enumerate(stages)
    ]
    return one.select(F.inline(F.array(*rows)))


#: Parts of a group's sorted values that a rank is looked for in, and the accuracy of their limits (ranks are off by 1/ACCURACY of the rows at most).
BINS, ACCURACY = 1024, 20_000
#: Groups whose limits are broadcast at most; beyond, rows are joined by their group.
BROADCAST_GROUPS = 10_000


def at_ranks(df: DataFrame, by: Sequence[str], value: str, ranks: dict[str, Column]) -> DataFrame:
    """by, n, rank_name, at, skip: the value at a rank (from 0, a column of the group's size `n`) in the order of values, and the rank among equal ones.

    Exact. One pass takes sketches of each group's quantiles, which bracket every rank between two
    values with some thousandths of the rows between them; they are stored, and their number is
    known before they are broadcast. A second pass counts the rows below a bracket and the distinct
    values inside it, combined before the exchange; raw rows are not exchanged. What is inside is put
    in bins of equal width, and only the bin that holds the rank is sorted. Outliers fall outside of
    brackets. Nulls are left out; null keys are a group.
    """
    rows = df.where(F.col(value).isNotNull()).select(F.struct(*(F.col(c) for c in by), F.lit(0).alias("_")).alias("_g"), F.col(value).cast("double").alias("_v"))
    levels = ", ".join(f"{i / BINS!r}D" for i in range(BINS + 1))
    ends = checkpointed(rows.groupBy("_g").agg(F.count(F.lit(1)).alias("n"), F.expr(f"percentile_approx(_v, array({levels}), {ACCURACY})").alias("grid")))
    few = ends.count() <= BROADCAST_GROUPS
    place = lambda r: F.floor(r * BINS / F.col("n")).cast("int")
    span = lambda r: F.struct(F.get("grid", F.greatest(place(r) - 2, F.lit(0))).alias("lo"), F.get("grid", F.least(place(r) + 3, F.lit(BINS))).alias("hi"))
    wanted = ends.select("_g", "n", F.inline(F.array(*(F.struct(F.lit(k).alias("rank_name"), r.cast("long").alias("rank"), span(r.cast("long")).alias("s")) for k, r in ranks.items()))))
    spans = ends.select("_g", F.array_distinct(F.array(*(span(r.cast("long")) for r in ranks.values()))).alias("spans"))
    each = rows.join(F.broadcast(spans) if few else spans, "_g").select("_g", "_v", F.explode(F.filter("spans", lambda s: F.col("_v") <= s["hi"])).alias("s"))
    near = each.groupBy("_g", "s", F.when(F.col("_v") >= F.col("s.lo"), F.col("_v")).alias("_v")).agg(F.count(F.lit(1)).alias("c"))
    number = F.when(F.col("_v").isNull(), -1).when(F.col("s.hi") > F.col("s.lo"), F.least(F.floor((F.col("_v") - F.col("s.lo")) / (F.col("s.hi") - F.col("s.lo")) * BINS), F.lit(BINS - 1))).otherwise(0)
    placed = near.withColumn("bin", number.cast("int"))
    before = lambda *order: F.sum("c").over(Window.partitionBy(*order[:-1]).orderBy(order[-1])) - F.col("c")
    bins = placed.groupBy("_g", "s", "bin").agg(F.sum("c").alias("c")).withColumn("before", before("_g", "s", "bin"))
    hits = bins.join(wanted, ["_g", "s"]).where("before <= rank AND rank < before + c").select("_g", "s", "bin", "n", "rank_name", (F.col("rank") - F.col("before")).alias("rank"))
    inside = placed.join(hits.select("_g", "s", "bin").distinct(), ["_g", "s", "bin"], "left_semi").withColumn("before", before("_g", "s", "bin", "_v"))
    found = inside.join(hits, ["_g", "s", "bin"]).where("before <= rank AND rank < before + c")
    return found.select(*(F.col(f"_g.{c}").alias(c) for c in by), "n", "rank_name", F.col("_v").alias("at"), (F.col("rank") - F.col("before")).alias("skip"))


def quantiles(df: DataFrame, by: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """by and a column for each share: quantiles by linear interpolation, exact (see at_ranks)."""
    place = {k: (F.col("n") - 1) * F.lit(p) for k, p in shares.items()}
    ends = {f"{k}{e}": f(x) for k, x in place.items() for e, f in (("-", F.floor), ("+", F.ceil))}
    wide = at_ranks(df, by, value, ends).groupBy(*by).agg(F.max("n").alias("n"), *(F.max(F.when(F.col("rank_name") == k, F.col("at"))).alias(k) for k in ends))
    value_of = lambda k: F.col(f"{k}-") + (F.col(f"{k}+") - F.col(f"{k}-")) * (place[k] - F.floor(place[k]))
    return wide.select(*by, *(value_of(k).alias(k) for k in shares))


def describe(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Count, sum, mean, median, quartiles (linear interpolation), least and largest per group."""
    v = F.col(value)
    sums = df.groupBy(*by).agg(
        F.count(v).alias("n"), F.round(F.sum(v), 4).alias("total"), F.round(F.avg(v), 4).alias("mean"), F.min(v).alias("least"), F.max(v).alias("largest")
    )
    return with_quantiles(sums, df, by, value, {"median": 0.5, "q25": 0.25, "q75": 0.75})


def with_quantiles(sums: DataFrame, df: DataFrame, by: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """A table of groups with their quantiles, rounded; null where a group has no value."""
    found = quantiles(df, by, value, shares).alias("q")
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"q.{c}"))
    return sums.alias("s").join(found, same, "left").select("s.*", *(F.round(F.col(f"q.{k}"), 4).alias(k) for k in shares))


def mode(df: DataFrame, by: Sequence[str], value: str, least: int = 1) -> DataFrame:
    """The most frequent value per group, the smallest of ties; null if it occurs fewer than `least` times."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("times"))
    best = counted.groupBy(*by).agg(F.max_by(F.struct(value, "times"), F.struct(F.col("times"), -F.col(value))).alias("b"))
    return best.select(*by, F.when(F.col("b.times") >= least, F.col(f"b.{value}")).alias("mode_value"), F.col("b.times").alias("times"))


def key_examples(df: DataFrame, by: Sequence[str], value: str, prefer: Column, order: Sequence[str], shown: Sequence[str]) -> DataFrame:
    """by, example (`min`, `median`, `max`), at, and the shown columns of one row each.

    A row of the value is taken that no earlier example of the group took, rows of which `prefer`
    holds first, then by `order`; where all are taken, the best of the taken. Groups of an even
    number of values may have no row at their median. Three candidates a value suffice, as two
    at most are taken, so that no task holds the rows of a value.
    """
    rows = df.where(F.col(value).isNotNull())
    stats = rows.groupBy(*by).agg(F.min(value).alias("min"), F.max(value).alias("max"))
    n = F.col("n")
    middle = at_ranks(rows, by, value, {"low": F.floor((n - 1) / 2), "high": F.ceil((n - 1) / 2)}).groupBy(*by).agg(F.avg("at").alias("median"))
    names = ("min", "median", "max")
    wanted = stats.join(middle, list(by)).select(*by, F.inline(F.array(*(F.struct(F.lit(i).alias("case"), F.col(c).cast("double").alias("at")) for i, c in enumerate(names)))))
    found = rows.withColumn("at", F.col(value).cast("double")).join(wanted, [*by, "at"])
    ranked = Window.partitionBy(*by, "case").orderBy(F.coalesce(prefer, F.lit(False)).desc(), *order)
    few = found.withColumn("_r", F.row_number().over(ranked)).where("_r <= 3")
    row = F.struct(F.struct(*(F.col(c) for c in order)).alias("key"), *(F.col(c).alias(f"_{c}") for c in shown))
    lists = few.groupBy(*by).agg(F.collect_list(F.struct("case", "_r", "at", row.alias("row"))).alias("all"))
    key = lambda x: x["row"]["key"]

    def chosen(case: int, taken: list[Column]) -> Column:
        own = F.array_sort(F.filter("all", lambda x: x["case"] == case))
        free = F.filter(own, lambda x: ~F.exists(F.array(*taken), lambda t: F.coalesce(key(t) == key(x), F.lit(False)))) if taken else own
        return F.coalesce(F.try_element_at(free, F.lit(1)), F.try_element_at(own, F.lit(1)))

    picks, taken = lists, []
    for i, name in enumerate(names):
        picks = picks.withColumn(name, chosen(i, taken))
        taken = [*taken, F.col(name)]
    out = picks.select(*by, F.inline(F.array(*(F.struct(F.lit(c).alias("example"), F.col(c).alias("x")) for c in names)))).where("x IS NOT NULL")
    return out.select(*by, "example", F.col("x.at").alias("at"), *(F.col(f"x.row._{c}").alias(c) for c in shown))


def cut(value: Column, edges: Sequence[float], labels: Sequence[str], include_lowest: bool = False) -> Column:
    """Right-closed brackets (a, b]; values at or below the first edge are null unless it is included."""
    out = F.lit(None).cast("string")
    for lo, hi, label in reversed(list(zip(edges[:-1], edges[1:], labels, strict=True))):
        low = value >= lo if include_lowest and lo == edges[0] else value > lo
        out = F.when(low & (value <= hi), F.lit(label)).otherwise(out)
    return out


def histogram(df: DataFrame, value: str, lo: float, hi: float, bins: int) -> DataFrame:
    """bin (from 1), n: equal bins [a, b), the last one closed."""
    own = df.where(F.col(value).between(lo, hi))
    number = F.least(F.width_bucket(F.col(value), F.lit(float(lo)), F.lit(float(hi)), F.lit(bins)), F.lit(bins).cast("long"))
    return own.groupBy(number.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """x, y, r for every pair of columns in one pass (pairs with a null are skipped)."""
    pairs = list(itertools.combinations(columns, 2))
    one = df.agg(*(F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs))
    return one.select(F.inline(F.array(*(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.round(F.col(f"`{a}|{b}`"), 6).alias("r")) for a, b in pairs))))


def trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Ordinary least squares of y on x."""
    return df.agg(F.round(F.regr_slope(y, x), 6).alias("slope"), F.round(F.regr_intercept(y, x), 4).alias("intercept"), F.round(F.regr_r2(y, x), 8).alias("r2"))


def top(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group in a total order (give a unique last key)."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")).where(F.col(rank) <= k)


def keep_first(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top(df, by, order, 1, "_rank").drop("_rank")


def pivot_counts(df: DataFrame, row: str, column: str, values: Sequence[str], total: str = "total") -> DataFrame:
    """Counts of rows by row and column value, 0 where there are none, and a total."""
    out = df.groupBy(row).agg(*(F.count_if(F.col(column) == v).alias(v.lower()) for v in values))
    return out.withColumn(total, sum((F.col(v.lower()) for v in values), F.lit(0).cast("long")))


def upward(status: Column, actions: Column, ranks: dict[str, int]) -> Column:
    """The best-ranked action status where it is strictly above the present one, else the present one."""
    table = F.create_map(*(F.lit(x) for kv in ranks.items() for x in kv))
    rank = lambda c: F.coalesce(F.try_element_at(table, c), F.lit(-1))
    best = F.aggregate(actions, F.lit(None).cast("string"), lambda acc, x: F.when(acc.isNull() | (rank(x) > rank(acc)), x).otherwise(acc))
    return F.when(rank(best) > rank(status), best).otherwise(status)


def scaled(df: DataFrame, column: str, out: str) -> DataFrame:
    """Min-max scaling to [0, 1] by the column's bounds over all rows; 0 where they are equal."""
    bounds = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    scaled_ = F.coalesce(F.try_divide(F.col(column) - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(0.0))
    return df.join(F.broadcast(bounds)).withColumn(out, scaled_).drop("_lo", "_hi")


def titled(df: DataFrame, column: str, title: str) -> DataFrame:
    """The rows of a title, blanks at its ends aside."""
    return df.where(F.trim(F.col(column)) == title.strip())


def jitter(width: float = 1.0, seed: int = 42) -> Column:
    """A seeded uniform shift of at most half a width either way, for points that would cover each other."""
    return (F.rand(seed) - 0.5) * width
