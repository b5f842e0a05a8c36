"""Snapshot discovery, readers and sinks.

Folders are listed through Hadoop's file system, so any store that Spark reads will do.
Only names are listed on the driver; data are read by Spark.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from civitas.sources.shared import checkpointed

STAMP = "%Y-%m-%d_%H-%M-%S"
STAMPED = re.compile(r"\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2}")


def listed(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """(name, is a folder) of a folder's members in order of name."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        raise FileNotFoundError(folder)
    if not fs.getFileStatus(path).isDirectory():
        raise NotADirectoryError(folder)
    return sorted((s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(path))


def is_stamp(name: str) -> bool:
    try:
        return bool(datetime.strptime(name, STAMP))
    except ValueError:
        return False


def stamp(now: datetime) -> str:
    return now.strftime(STAMP)


def latest_snapshot(spark: SparkSession, folder: str, loose: bool = False) -> str:
    """The last folder whose name is a time stamp (loose: only begins with `20`)."""
    names = [n for n, d in listed(spark, folder) if d and (n.startswith("20") if loose else is_stamp(n))]
    if not names:
        raise FileNotFoundError(f"no snapshot in {folder}")
    return f"{folder}/{max(names)}"


def latest_file(spark: SparkSession, folder: str, prefix: str, exclude: Sequence[str] = (), loose: bool = False) -> str:
    """The last `<prefix><stamp>.csv` (loose: any `<prefix>*.csv`) without an excluded word in its name.

    The strict form cannot take a longer prefix's files for its own.
    """
    pattern = re.compile(re.escape(prefix) + (r".*" if loose else rf"_?{STAMPED.pattern}") + r"\.csv\Z")
    names = [n for n, d in listed(spark, folder) if not d and pattern.match(n) and not any(w in n for w in exclude)]
    if not names:
        raise FileNotFoundError(f"no {prefix}*.csv in {folder}")
    return f"{folder}/{max(names)}"


def file_time(name: Column) -> Column:
    """The time stamp in a file's name."""
    return F.try_to_timestamp(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2})", 1), F.lit("yyyy-MM-dd_HH-mm-ss"))


def strings(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, columns: Sequence[str] | None = None, strict: bool = False) -> DataFrame:
    """CSV with a header, quoted fields of several lines and doubled quotes; all strings unless a schema is given."""
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("encoding", "UTF-8").option("mode", "FAILFAST" if strict else "PERMISSIVE")
    out = (reader.schema(schema) if schema is not None else reader.option("inferSchema", False)).csv(path)
    return out.select(*columns) if columns else out


def csv_problems(spark: SparkSession, path: str) -> list[str]:
    """Why a CSV cannot be used: missing, empty, a header of fewer than two columns, or bytes that are no UTF-8."""
    try:
        head = spark.read.option("header", False).text(path).take(1)
    except Exception as error:  # the path is wrong or unreadable: that is the finding
        if "PATH_NOT_FOUND" in str(error):
            return ["missing"]
        raise
    if not head or not head[0][0].strip():
        return ["empty"]
    found = [] if "," in head[0][0] else ["fewer than two columns"]
    return found + (["not UTF-8"] if spark.read.text(path).where(~F.is_valid_utf8("value")).take(1) else [])


def latest_table(spark: SparkSession, folder: str, prefix: str, exclude: Sequence[str] = (), loose: bool = True) -> DataFrame:
    """The rows of the last file of the last snapshot, with the time in the file's name as `file_time`."""
    path = latest_file(spark, latest_snapshot(spark, folder, loose), prefix, exclude, loose)
    return read_csv(spark, path).withColumn("file_time", file_time(F.lit(path.rsplit("/", 1)[-1])))


def chained(pages: DataFrame, first: str, url: str = "url", following: str = "next_url") -> DataFrame:
    """The pages reached from the first by their links to the next, with their `place` from 1 (long).

    Pointer doubling: a round joins the pages reached so far with jumps twice as long as the round's
    before, so that a chain of n pages takes log2(n) rounds. A page that a loop meets again keeps its
    first place, and a round that reaches nothing new is the last. Of several next pages of a url the
    smallest counts; null urls and links are no pages. Repeated rows of a url all get its place.
    """
    place = F.col("place")
    jumps = pages.where(F.col(url).isNotNull() & F.col(following).isNotNull()).groupBy(F.col(url).alias("u")).agg(F.min(following).alias("v"))
    reached = checkpointed(pages.where(F.col(url) == first).select(F.col(url).alias("u"), F.lit(1).cast("long").alias("place")).distinct())
    jumps, known, step = checkpointed(jumps), reached.count(), 1
    there = checkpointed(pages.select(F.col(url).alias("u")).distinct())
    while known:
        further = reached.join(jumps, "u").select(F.col("v").alias("u"), (place + step).alias("place"))
        reached = checkpointed(reached.union(further.join(there, "u", "left_semi")).groupBy("u").agg(F.min("place").alias("place")))
        now = reached.count()
        if now == known:
            break
        known, step = now, 2 * step
        jumps = checkpointed(jumps.join(jumps.select(F.col("u").alias("v"), F.col("v").alias("w")), "v").select("u", F.col("w").alias("v")))
    return pages.join(reached.withColumnRenamed("u", "_u"), F.col(url) == F.col("_u")).drop("_u")


def bindings(answers: DataFrame, column: str, names: Sequence[str], language: str | None = "en", text: str = "title") -> DataFrame:
    """The bindings of a query service's JSON answers as rows of the named variables; texts of another language are left out."""
    kind = "struct<results:struct<bindings:array<map<string,struct<value:string,`xml:lang`:string>>>>>"
    rows = answers.select(F.explode(F.from_json(column, kind)["results"]["bindings"]).alias("b"))
    spoken = F.coalesce(F.try_element_at("b", F.lit(text))["xml:lang"], F.lit(language or ""))
    kept = rows.where(spoken == language) if language else rows
    return kept.select(*(F.try_element_at("b", F.lit(n))["value"].alias(n) for n in names))


def with_titles(ids: DataFrame, key: str, titles: DataFrame, title: str = "title") -> DataFrame:
    """Identifiers with their titles (the smallest of several) and whether there is one."""
    one = titles.groupBy(key).agg(F.min(title).alias(title))
    return ids.join(one, key, "left").withColumn("found", F.col(title).isNotNull())


def read_pages(spark: SparkSession, folder: str, suffix: str = "*.html", recursive: bool = True) -> DataFrame:
    """path, file_name, html: one row per page, read whole."""
    reader = spark.read.option("wholetext", True).option("recursiveFileLookup", recursive).option("pathGlobFilter", suffix)
    return reader.text(folder).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("html"))


def registration_number(file_name: Column) -> Column:
    """`2019_000007_en.html` to `2019/000007`; empty where the name is of another form."""
    pattern = r"(\d{4})_(\d{6})_[a-z]{2}\.html"
    return F.when(F.rlike(file_name, F.lit(pattern)), F.concat(F.regexp_extract(file_name, pattern, 1), F.lit("/"), F.regexp_extract(file_name, pattern, 2))).otherwise("")


def normal_number(c: Column) -> Column:
    """Identifiers of the forms `ECI(2019)000007` and `2019_000007` as `2019/000007`."""
    return F.regexp_replace(c, r"^(?:ECI\()?(\d{4})[)_/](\d{6})$", "$1/$2")


def url_list(df: DataFrame, url: str, number: str) -> DataFrame:
    """Rows with a url, the year and file stem of their number."""
    return df.where(F.trim(F.coalesce(url, F.lit(""))) != "").withColumn("year", F.split(number, "/")[0]).withColumn("stem", F.replace(F.col(number), F.lit("/"), F.lit("_")))


# What shows that a page is an error page.
ERROR_PHRASES = ("too many requests", "rate limit", "server inaccessible", "page not found", "service unavailable")


def page_is_valid(html: Column, least: int = 1000) -> Column:
    """Long enough, with html tags, and no phrase of an error page in a short page."""
    low = F.lower(html)
    bad = F.lit(False)
    for p in ERROR_PHRASES:
        bad = bad | F.contains(low, F.lit(p))
    return F.coalesce((F.char_length(html) >= least) & F.contains(low, F.lit("<html")) & ~(bad & (F.char_length(html) < 10 * least)), F.lit(False))


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """One CSV file with a header: for results meant for people. Use parquet between stages."""
    shown = df.select(*columns) if columns else df
    shown.coalesce(1).write.option("header", True).option("escape", '"').mode("overwrite").csv(path)


def write_list(df: DataFrame, path: str, key: str) -> None:
    """A list of pages with its keys in the form `2019/000007`."""
    write_csv(df.withColumn(key, normal_number(F.replace(F.col(key), F.lit("_"), F.lit("/")))), path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def rewritten(first: DataFrame, later: DataFrame, key: str) -> DataFrame:
    """A list as first written, with the later values of its rows, and rows only the later list has."""
    right = later.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_n_{c}") for c in later.columns if c != key))
    joined = first.join(right, F.col(key) == F.col("_key"), "full")
    return joined.select(F.coalesce(key, "_key").alias(key), *(F.coalesce(*([f"_n_{c}"] if c in later.columns else []), c).alias(c) for c in first.columns if c != key))


def status_report(df: DataFrame, status: str, failed: Column) -> DataFrame:
    """Rows and failures per status."""
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("n"), F.count_if(failed).alias("failed"))
