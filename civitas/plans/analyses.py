"""Named analyses on the star schema, each with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from civitas.operators import relational as R

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of one folder, read on first use (t.orders, t.lineitem, ...)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return f

    return register


@query(
    "funnel",
    """
WITH o AS (SELECT count(*) s1, count(*) FILTER (WHERE o_orderstatus IN ('F','P')) s2,
    count(*) FILTER (WHERE o_orderstatus IN ('F','P') AND o_totalprice >= 100000) s3,
    count(*) FILTER (WHERE o_orderstatus IN ('F','P') AND o_totalprice >= 100000 AND substr(o_orderpriority,1,1) <= '2') s4 FROM orders)
SELECT 1 AS stage_no, 'placed' AS stage, s1 AS n, round(s1 / s1, 6) AS kept FROM o
UNION ALL SELECT 2, 'closed', s2, round(s2 / s1, 6) FROM o UNION ALL SELECT 3, 'large', s3, round(s3 / s2, 6) FROM o
UNION ALL SELECT 4, 'urgent', s4, round(s4 / s3, 6) FROM o""",
)
def funnel(t):
    closed = F.col("o_orderstatus").isin("F", "P")
    large = closed & (F.col("o_totalprice") >= 100000)
    urgent = large & (F.substring("o_orderpriority", 1, 1) <= "2")
    return R.funnel(t.orders, [("placed", F.lit(True)), ("closed", closed), ("large", large), ("urgent", urgent)])


@query(
    "success_flags",
    "SELECT o_orderkey, coalesce(o_totalprice >= 150000, false) AS large, o_orderstatus = 'F' AS done, coalesce(o_totalprice >= 150000, false) AND o_orderstatus = 'F' AS success, CASE WHEN o_orderstatus = 'F' THEN 'Answered' WHEN o_orderstatus = 'P' THEN 'Pending' ELSE 'Open' END AS outcome FROM orders",
)
def success_flags(t):
    large, done = F.coalesce(F.col("o_totalprice") >= 150000, F.lit(False)), F.col("o_orderstatus") == "F"
    outcome = F.when(done, "Answered").when(F.col("o_orderstatus") == "P", "Pending").otherwise("Open")
    return t.orders.select("o_orderkey", large.alias("large"), done.alias("done"), (large & done).alias("success"), outcome.alias("outcome"))


@query("status_distribution", "SELECT o_orderstatus, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 1")
def status_distribution(t):
    return R.value_counts(t.orders, "o_orderstatus")


@query(
    "segment_distribution_with_null",
    "SELECT nullif(c_mktsegment, 'BUILDING') AS segment, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM customer GROUP BY 1",
)
def segment_distribution_with_null(t):
    return R.value_counts(t.customer.select(F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")), "segment", keep_null=True)


@query(
    "yearly_trend",
    "SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS done, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 4) AS mean, round(median(o_totalprice), 4) AS median FROM orders GROUP BY 1",
)
def yearly_trend(t):
    rows = t.orders.select(F.year("o_orderdate").cast("long").alias("year"), "o_orderstatus", "o_totalprice")
    sums = rows.groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.round(F.avg("o_totalprice"), 4).alias("mean")
    )
    return R.with_quantiles(sums, rows, ["year"], "o_totalprice", {"median": 0.5})


@query(
    "yearly_join_back",
    """WITH a AS (SELECT year(o_orderdate) y, count(*) n FROM orders GROUP BY 1), b AS (SELECT year(o_orderdate) y, count(*) m FROM orders WHERE o_totalprice > 400000 GROUP BY 1)
SELECT CAST(a.y AS BIGINT) AS year, n, m AS very_large FROM a LEFT JOIN b ON a.y = b.y""",
)
def yearly_join_back(t):
    year = F.year("o_orderdate").cast("long")
    all_, few = t.orders.groupBy(year.alias("year")).agg(F.count(F.lit(1)).alias("n")), t.orders.where("o_totalprice > 400000").groupBy(year.alias("y2")).agg(F.count(F.lit(1)).alias("very_large"))
    return all_.join(few, all_.year == few.y2, "left").drop("y2")


STATS = "count({v}) AS n, round(sum({v}), 4) AS total, round(avg({v}), 4) AS mean, round(median({v}), 4) AS median, round(quantile_cont({v}, 0.25), 4) AS q25, round(quantile_cont({v}, 0.75), 4) AS q75, min({v}) AS least, max({v}) AS largest"


@query("price_stats_by_flag", f"SELECT l_returnflag, l_linestatus, {STATS.format(v='l_extendedprice')} FROM lineitem GROUP BY 1, 2")
def price_stats_by_flag(t):
    return R.describe(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice")


@query(
    "global_stats_long",
    """WITH s AS (SELECT round(sum(o_totalprice), 2) a, round(avg(o_totalprice), 4) b, round(median(o_totalprice), 4) c, min(o_totalprice) d, max(o_totalprice) e, CAST(count(*) AS DOUBLE) f FROM orders)
SELECT unnest(['total', 'mean', 'median', 'least', 'largest', 'n']) AS metric, unnest([a, b, c, d, e, f]) AS value FROM s""",
)
def global_stats_long(t):
    p = F.col("o_totalprice")
    one = t.orders.agg(F.round(F.sum(p), 2).alias("total"), F.round(F.avg(p), 4).alias("mean"), F.min(p).alias("least"), F.max(p).alias("largest"), F.count(F.lit(1)).cast("double").alias("n"))
    one = R.with_quantiles(one, t.orders, [], "o_totalprice", {"median": 0.5})
    return one.unpivot([], ["total", "mean", "median", "least", "largest", "n"], "metric", "value")


@query(
    "mode_quantity",
    "SELECT l_returnflag, l_quantity AS mode_value, n AS times FROM (SELECT l_returnflag, l_quantity, count(*) n, row_number() OVER (PARTITION BY l_returnflag ORDER BY count(*) DESC, l_quantity) r FROM lineitem GROUP BY 1, 2) WHERE r = 1",
)
def mode_quantity(t):
    return R.mode(t.lineitem, ["l_returnflag"], "l_quantity")


@query(
    "mode_when_repeated",
    "SELECT c_nationkey, CASE WHEN n > 1 THEN v END AS mode_value, n AS times FROM (SELECT c_nationkey, floor(c_acctbal / 100) v, count(*) n, row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, floor(c_acctbal / 100)) r FROM customer GROUP BY 1, 2) WHERE r = 1",
)
def mode_when_repeated(t):
    rows = t.customer.select("c_nationkey", F.floor(F.col("c_acctbal") / 100).cast("double").alias("v"))
    return R.mode(rows, ["c_nationkey"], "v", least=2)


@query(
    "correlation_matrix",
    "WITH c AS (SELECT corr(l_quantity, l_extendedprice) a, corr(l_quantity, l_discount) b, corr(l_quantity, l_tax) c, corr(l_extendedprice, l_discount) d, corr(l_extendedprice, l_tax) e, corr(l_discount, l_tax) f FROM lineitem) "
    "SELECT unnest(['l_quantity','l_quantity','l_quantity','l_extendedprice','l_extendedprice','l_discount']) AS x, unnest(['l_extendedprice','l_discount','l_tax','l_discount','l_tax','l_tax']) AS y, round(unnest([a,b,c,d,e,f]), 6) AS r FROM c",
)
def correlation_matrix(t):
    return R.correlations(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query("ols_trend", "SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 8) AS r2 FROM lineitem")
def ols_trend(t):
    return R.trend(t.lineitem, "l_quantity", "l_extendedprice")


@query(
    "histogram_prices",
    "SELECT CAST(least(floor((o_totalprice - 0) / (500000.0 / 50)) + 1, 50) AS BIGINT) AS bin, count(*) AS n FROM orders WHERE o_totalprice BETWEEN 0 AND 500000 GROUP BY 1",
)
def histogram_prices(t):
    return R.histogram(t.orders, "o_totalprice", 0, 500000, 50)


@query(
    "brackets",
    "SELECT CASE WHEN c_acctbal > 0 AND c_acctbal <= 1000 THEN 'low' WHEN c_acctbal > 1000 AND c_acctbal <= 5000 THEN 'middle' WHEN c_acctbal > 5000 AND c_acctbal <= 1e9 THEN 'high' END AS bracket, count(*) AS n FROM customer GROUP BY 1",
)
def brackets(t):
    bracket = R.cut(F.col("c_acctbal"), [0, 1000, 5000, 1e9], ["low", "middle", "high"])
    return t.customer.groupBy(bracket.alias("bracket")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "duration_summary",
    f"WITH d AS (SELECT unnest(['ship', 'ship_clipped']) AS period, unnest([datediff('day', o_orderdate, l_shipdate), greatest(datediff('day', o_orderdate, l_shipdate), 0)]) AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey) SELECT period, {STATS.format(v='days')} FROM d GROUP BY 1",
)
def duration_summary(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    days = F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).cast("long")
    long = joined.select(days.alias("ship"), F.greatest(days, F.lit(0)).alias("ship_clipped")).unpivot([], ["ship", "ship_clipped"], "period", "days")
    return R.describe(long, ["period"], "days")


@query(
    "stage_durations_with_both",
    """WITH d AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE 'open' END AS class, greatest(coalesce(datediff('day', o_orderdate, l_shipdate), 0), 0) AS days FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey)
SELECT class, count(*) AS n, round(avg(days), 6) AS mean FROM d GROUP BY 1 UNION ALL SELECT 'both', count(*), round(avg(days), 6) FROM d""",
)
def stage_durations_with_both(t):
    days = F.greatest(F.coalesce(F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")), F.lit(0)), F.lit(0))
    rows = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(F.when(F.col("o_orderstatus") == "F", "done").otherwise("open").alias("class"), days.alias("days"))
    return rows.rollup("class").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("days"), 6).alias("mean"), F.grouping("class").alias("g")).select(F.when(F.col("g") == 1, "both").otherwise(F.col("class")).alias("class"), "n", "mean")


@query(
    "country_participation",
    """SELECT n_name, r_name, count(*) AS customers, count(*) FILTER (WHERE c_acctbal >= 5000) AS over_threshold, round(count(*) FILTER (WHERE c_acctbal >= 5000) / count(*), 6) AS share
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)
def country_participation(t):
    over = F.count_if(F.col("c_acctbal") >= 5000)
    counted = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"), over.alias("over_threshold"))
    named = counted.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return named.select("n_name", "r_name", "customers", "over_threshold", F.round(F.col("over_threshold") / F.col("customers"), 6).alias("share"))


@query(
    "top10_names_per_segment",
    """SELECT c_mktsegment, string_agg(c_name, ', ' ORDER BY r) AS names, CAST(any_value(total) - 10 AS BIGINT) AS more FROM (
SELECT c_mktsegment, c_name, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) r, count(*) OVER (PARTITION BY c_mktsegment) total FROM customer) WHERE r <= 10 GROUP BY 1""",
)
def top10_names_per_segment(t):
    ranked = R.top(t.customer, ["c_mktsegment"], [F.desc("c_acctbal"), F.asc("c_custkey")], 10)
    names = ranked.groupBy("c_mktsegment").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "c_name"))), lambda x: x["c_name"]), ", ").alias("names"))
    totals = t.customer.groupBy("c_mktsegment").agg((F.count(F.lit(1)) - 10).alias("more"))
    return names.join(totals, "c_mktsegment")


@query("sorted_distinct_list", "SELECT s_nationkey, string_agg(x, ', ' ORDER BY x) AS digits FROM (SELECT DISTINCT s_nationkey, right(s_name, 1) x FROM supplier) GROUP BY 1")
def sorted_distinct_list(t):
    return t.supplier.groupBy("s_nationkey").agg(F.array_join(F.array_sort(F.collect_set(F.expr("right(s_name, 1)"))), ", ").alias("digits"))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "pivot_nation_segment",
    "SELECT n_name, " + ", ".join(f"count(*) FILTER (WHERE c_mktsegment = '{s}') AS {s.lower()}" for s in SEGMENTS) + ", count(*) FILTER (WHERE c_mktsegment IN (" + ", ".join(f"'{s}'" for s in SEGMENTS) + ")) AS total FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1",
)
def pivot_nation_segment(t):
    return R.pivot_counts(t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")), "n_name", "c_mktsegment", SEGMENTS)


@query("waiting_anti_join", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def waiting_anti_join(t):
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey", "o_totalprice")


@query("semi_join_returned", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 45) GROUP BY 1")
def semi_join_returned(t):
    hit = t.lineitem.where("l_returnflag = 'R' AND l_quantity >= 45")
    return t.orders.join(hit, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "two_key_fallback_lookup",
    """SELECT s_suppkey, coalesce(a.n_name, b.n_name) AS name FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 12) a ON s_nationkey = a.n_nationkey LEFT JOIN nation b ON s_suppkey % 25 = b.n_nationkey""",
)
def two_key_fallback_lookup(t):
    a = t.nation.where("n_nationkey < 12").select(F.col("n_nationkey").alias("ka"), F.col("n_name").alias("na"))
    b = t.nation.select(F.col("n_nationkey").alias("kb"), F.col("n_name").alias("nb"))
    rows = t.supplier.join(a, F.col("s_nationkey") == F.col("ka"), "left").join(b, F.col("s_suppkey") % 25 == F.col("kb"), "left")
    return rows.select("s_suppkey", F.coalesce("na", "nb").alias("name"))


@query(
    "left_join_suffixes",
    "SELECT s_suppkey, s.s_acctbal AS balance_left, c.c_acctbal AS balance_right FROM supplier s LEFT JOIN customer c ON s_suppkey = c_custkey AND c_acctbal > 0",
)
def left_join_suffixes(t):
    right = t.customer.where("c_acctbal > 0").select("c_custkey", F.col("c_acctbal").alias("balance_right"))
    return t.supplier.join(right, F.col("s_suppkey") == F.col("c_custkey"), "left").select("s_suppkey", F.col("s_acctbal").alias("balance_left"), "balance_right")


@query("top10_orders", "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders QUALIFY rank <= 10")
def top10_orders(t):
    few = t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10).select("o_orderkey", "o_totalprice")
    return few.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("o_totalprice"), "o_orderkey")).cast("long"))


@query("extreme_rows", "SELECT o_orderpriority, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS largest_key, arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS least_key FROM orders GROUP BY 1")
def extreme_rows(t):
    return t.orders.groupBy("o_orderpriority").agg(
        F.max_by("o_orderkey", F.struct(F.col("o_totalprice"), -F.col("o_orderkey"))).alias("largest_key"), F.min_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("least_key")
    )


@query(
    "least_median_largest_examples",
    """WITH r AS (SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey) i, count(*) OVER (PARTITION BY o_orderstatus) n FROM orders)
SELECT o_orderstatus, CASE WHEN i = 1 THEN 'least' WHEN i = n THEN 'largest' ELSE 'middle' END AS example, o_orderkey FROM r WHERE i IN (1, n, n // 2 + 1)""",
)
def least_median_largest_examples(t):
    """The rows at three ranks of each status: their prices first, then among rows of that price the key."""
    n = F.col("n")
    at = R.at_ranks(t.orders, ["o_orderstatus"], "o_totalprice", {"least": F.lit(0), "middle": F.floor(n / 2), "largest": n - 1})
    rows = t.orders.select("o_orderstatus", F.col("o_totalprice").alias("at"), "o_orderkey").join(at, ["o_orderstatus", "at"])
    ranked = rows.withColumn("i", F.row_number().over(Window.partitionBy("o_orderstatus", "rank_name").orderBy("o_orderkey")) - 1)
    return ranked.where("i = skip").select("o_orderstatus", F.col("rank_name").alias("example"), "o_orderkey")


@query(
    "key_examples_per_nation",
    """WITH v AS (SELECT c_nationkey AS g, c_custkey AS k, c_custkey % 3 AS v, c_acctbal < 0 AS poor FROM customer),
s AS (SELECT g, min(v) AS lo, median(v) AS mid, max(v) AS hi FROM v GROUP BY g),
l AS (SELECT v.g, lo, mid, hi, list(k ORDER BY poor, k) FILTER (WHERE v = lo) AS a, list(k ORDER BY poor, k) FILTER (WHERE v = mid) AS b, list(k ORDER BY poor, k) FILTER (WHERE v = hi) AS c FROM v JOIN s ON v.g = s.g GROUP BY 1, 2, 3, 4),
p AS (SELECT *, a[1] AS x, coalesce(list_filter(b, lambda i: i <> a[1])[1], b[1]) AS y FROM l), q AS (SELECT *, coalesce(list_filter(c, lambda i: i <> x AND (y IS NULL OR i <> y))[1], c[1]) AS z FROM p)
SELECT g AS c_nationkey, 'min' AS example, lo::DOUBLE AS at, x AS c_custkey FROM q UNION ALL SELECT g, 'median', mid::DOUBLE, y FROM q WHERE y IS NOT NULL UNION ALL SELECT g, 'max', hi::DOUBLE, z FROM q""",
)
def key_examples_per_nation(t):
    """No customer is shown twice for a nation while another has the value; those in debt come last."""
    rows = t.customer.withColumn("v", F.col("c_custkey") % 3)
    return R.key_examples(rows, ["c_nationkey"], "v", F.col("c_acctbal") >= 0, ["c_custkey"], ["c_custkey"])


@query("numbered_lines", "SELECT l_orderkey, l_linenumber, row_number() OVER w AS i, count(*) OVER (PARTITION BY l_orderkey) AS of_n FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey)")
def numbered_lines(t):
    own = Window.partitionBy("l_orderkey")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.row_number().over(own.orderBy("l_shipdate", "l_linenumber", "l_partkey")).cast("long").alias("i"), F.count(F.lit(1)).over(own).alias("of_n")
    )


@query("mixed_order_top", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment DESC, c_nationkey ASC, c_acctbal DESC NULLS LAST, c_custkey LIMIT 25")
def mixed_order_top(t):
    return t.customer.orderBy(F.desc("c_mktsegment"), F.asc("c_nationkey"), F.desc_nulls_last("c_acctbal"), "c_custkey").limit(25).select("c_custkey", "c_mktsegment", "c_acctbal")


@query("rank_map_order", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 1 ELSE -1 END AS status_rank FROM orders ORDER BY status_rank DESC, o_orderkey LIMIT 40")
def rank_map_order(t):
    ranks = F.create_map(F.lit("F"), F.lit(2), F.lit("P"), F.lit(1))
    return t.orders.select("o_orderkey", F.coalesce(F.try_element_at(ranks, F.col("o_orderstatus")), F.lit(-1)).alias("status_rank")).orderBy(F.desc("status_rank"), "o_orderkey").limit(40)


@query("first_three_per_class", "SELECT p_brand, p_partkey, r AS rank FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) r FROM part) WHERE r <= 3")
def first_three_per_class(t):
    return R.top(t.part, ["p_brand"], [F.asc("p_partkey")], 3).select("p_brand", "p_partkey", "rank")


@query("seeded_sample_per_type", None)
def seeded_sample_per_type(t):
    """One part of each type, chosen by a seeded hash so that runs agree."""
    return R.keep_first(t.part, ["p_type"], [F.xxhash64(F.lit(42), F.col("p_partkey")), F.asc("p_partkey")]).select("p_type", "p_partkey")


@query("set_union_distinct", "SELECT DISTINCT k FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier)")
def set_union_distinct(t):
    return t.customer.select(F.col("c_nationkey").alias("k")).unionByName(t.supplier.select(F.col("s_nationkey").alias("k"))).distinct()


@query("set_difference", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 250000")
def set_difference(t):
    return t.customer.select(F.col("c_custkey").alias("k")).join(t.orders.where("o_totalprice > 250000"), F.col("k") == F.col("o_custkey"), "left_anti").distinct()


@query("wide_to_long", "SELECT c_custkey, unnest(['balance', 'nation']) AS metric, unnest([c_acctbal, CAST(c_nationkey AS DOUBLE)]) AS value FROM customer")
def wide_to_long(t):
    return t.customer.select("c_custkey", F.col("c_acctbal").alias("balance"), F.col("c_nationkey").cast("double").alias("nation")).unpivot(["c_custkey"], ["balance", "nation"], "metric", "value")


@query(
    "aggregate_of_aggregates",
    "SELECT o_orderpriority, round(avg(n), 6) AS mean_lines, max(n) AS most_lines FROM (SELECT o_orderpriority, o_orderkey, count(*) n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2) GROUP BY 1",
)
def aggregate_of_aggregates(t):
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderpriority").agg(F.round(F.avg("n"), 6).alias("mean_lines"), F.max("n").alias("most_lines"))


@query(
    "comparison_with_difference",
    """WITH s AS (SELECT avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F') f, avg(o_totalprice) FILTER (WHERE o_orderstatus <> 'F') o FROM orders)
SELECT unnest(['done', 'other', 'difference', 'ratio']) AS row_name, round(unnest([f, o, f - o, f / o]), 4) AS mean FROM s""",
)
def comparison_with_difference(t):
    done = F.col("o_orderstatus") == "F"
    s = t.orders.agg(F.avg(F.when(done, F.col("o_totalprice"))).alias("f"), F.avg(F.when(~done, F.col("o_totalprice"))).alias("o"))
    rows = [("done", F.col("f")), ("other", F.col("o")), ("difference", F.col("f") - F.col("o")), ("ratio", F.col("f") / F.col("o"))]
    return s.select(F.inline(F.array(*(F.struct(F.lit(k).alias("row_name"), F.round(v, 4).alias("mean")) for k, v in rows))))


@query(
    "distinct_list_items",
    "SELECT p_brand, count(DISTINCT w) AS n_words FROM (SELECT p_brand, unnest(string_split(p_name, ' ')) w FROM part) WHERE w <> 'the' GROUP BY 1",
)
def distinct_list_items(t):
    return t.part.select("p_brand", F.explode_outer(F.split("p_name", " ")).alias("w")).where("w <> 'the'").groupBy("p_brand").agg(F.countDistinct("w").alias("n_words"))


@query("boolean_shares", "SELECT count(*) FILTER (WHERE l_returnflag = 'R') AS returned, round(100.0 * count(*) FILTER (WHERE l_returnflag = 'R') / count(*), 6) AS pct FROM lineitem")
def boolean_shares(t):
    hit = F.count_if(F.col("l_returnflag") == "R")
    return t.lineitem.agg(hit.alias("returned"), F.round(100 * hit / F.count(F.lit(1)), 6).alias("pct"))


@query(
    "scaled_balance",
    "SELECT s_suppkey, round((s_acctbal - min(s_acctbal) OVER ()) / (max(s_acctbal) OVER () - min(s_acctbal) OVER ()), 8) AS scaled, round(log10(greatest(s_acctbal, 1)), 8) AS log_balance, least(greatest(s_acctbal, 0), 5000) AS clipped FROM supplier",
)
def scaled_balance(t):
    rows = R.scaled(t.supplier, "s_acctbal", "scaled")
    return rows.select("s_suppkey", F.round("scaled", 8).alias("scaled"), F.round(F.log10(F.greatest("s_acctbal", F.lit(1.0))), 8).alias("log_balance"), F.least(F.greatest("s_acctbal", F.lit(0.0)), F.lit(5000.0)).alias("clipped"))


@query(
    "upward_status",
    """WITH a AS (SELECT l_orderkey, max(CASE l_returnflag WHEN 'R' THEN 3 WHEN 'A' THEN 2 WHEN 'N' THEN 1 END) best FROM lineitem GROUP BY 1),
s AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'P' THEN 1 ELSE 0 END cur, best FROM orders LEFT JOIN a ON o_orderkey = l_orderkey)
SELECT greatest(cur, coalesce(best, -1)) AS status_rank, count(*) AS n FROM s GROUP BY 1""",
)
def upward_status(t):
    ranks = {"O": 0, "P": 1, "N": 1, "F": 2, "A": 2, "R": 3}
    actions = t.lineitem.groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("actions"))
    rows = t.orders.join(actions, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    table = F.create_map(*(F.lit(x) for kv in ranks.items() for x in kv))
    status = R.upward(F.col("o_orderstatus"), F.coalesce("actions", F.array().cast("array<string>")), ranks)
    return rows.groupBy(F.try_element_at(table, status).alias("status_rank")).agg(F.count(F.lit(1)).alias("n"))


@query("last_duplicate_wins", "SELECT c_nationkey, arg_max(c_name, c_custkey) AS c_name FROM customer GROUP BY 1")
def last_duplicate_wins(t):
    return R.keep_first(t.customer, ["c_nationkey"], [F.desc("c_custkey")]).select("c_nationkey", "c_name")


@query("transpose_counts", "SELECT r_name AS metric, count(*) AS value FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def transpose_counts(t):
    return t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey")).groupBy(F.col("r_name").alias("metric")).agg(F.count(F.lit(1)).alias("value"))
