"""Boilerplate lines by their frequency within a site."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plyforge.sources.paths import stored

#: A line is boilerplate on more than this share of its host's pages, a long one on a smaller share already: it hardly repeats by chance.
#: On fewer than `LEAST_PAGES` pages nothing is, so a host of four pages or fewer is left as it is.
RATIO, LONG_RATIO, LONG, LEAST_PAGES = 0.01, 0.001, 200, 5


def _line_key(line: Column) -> Column:
    """128 bits that stand for a line without blanks at its ends, and whether it is long."""
    bare = F.trim(line)
    return F.struct(F.xxhash64(bare).alias("a"), F.xxhash64(F.lit(1), bare).alias("b"), (F.length(bare) >= LONG).alias("long"))


def boilerplate(
    docs: DataFrame, host: str = "source", ratio: float = RATIO, long_ratio: float = LONG_RATIO, least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """host and the keys of its boilerplate lines: those in more than `ratio` of its pages (`long_ratio` for lines of `LONG` characters or
    more) and in at least `least_pages`.

    A line counts once per page. A host has at most (mean lines of a page) / ratio such lines, however many pages it has,
    so one array per host is small. Only 128-bit keys are shuffled, and they are counted before that, so a host with a third of
    all pages and a line on all of them costs one row per task.
    """
    site = F.coalesce(F.col(host).cast("string"), F.lit("")).alias("_host")
    pages = docs.groupBy(site).agg(F.count("*").alias("_pages"))
    lines = F.filter(F.split(F.col("text"), "\n"), lambda x: F.trim(x) != "")
    keys = docs.select(site, F.explode(F.array_distinct(F.transform(lines, _line_key))).alias("_key"))
    counted = keys.groupBy("_host", "_key").agg(F.count("*").alias("_n")).where(F.col("_n") >= least_pages)
    over = counted.join(pages, "_host").where(
        F.col("_n") > F.col("_pages") * F.when(F.col("_key.long"), long_ratio).otherwise(ratio))
    return over.groupBy("_host").agg(F.collect_list("_key").alias("_boilerplate"))


def drop_boilerplate(
    docs: DataFrame, host: str = "source", ratio: float = RATIO, long_ratio: float = LONG_RATIO, least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """Every row, with boilerplate lines taken out of `text`; adds lines_total and lines_dropped.

    A null text stays null and has no lines, a null host is a host of its own (the empty one), blank lines stay, and a page of
    boilerplate alone keeps its row with what is left. Other columns pass unchanged, whatever their names, but for columns
    named lines_total or lines_dropped, which are replaced.
    """
    # The row travels as one value, so that no name of its columns can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text"),
                       F.coalesce(F.col(host).cast("string"), F.lit("")).alias("_host"))
    # Stored, so that its size is known: while it is small, Spark does not shuffle the pages; else it splits large hosts.
    joined = rows.join(stored(boilerplate(docs, host, ratio, long_ratio, least_pages), "boilerplate"), "_host", "left").withColumn("lines", F.split("text", "\n"))
    kept = F.when(F.col("_boilerplate").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.array_contains(F.col("_boilerplate"), _line_key(x)) | (F.trim(x) == "")))
    joined = joined.withColumn("kept", kept)
    sizes = [F.when(F.col("text").isNull(), 0).otherwise(F.size("lines") - k) for k in (F.lit(0), F.size("kept"))]
    names = [c for c in docs.columns if c not in ("lines_total", "lines_dropped")]
    return joined.select(*[F.array_join("kept", "\n").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in names],
                         sizes[0].alias("lines_total"), sizes[1].alias("lines_dropped"))


def line_sql(ratio: float = RATIO, long_ratio: float = LONG_RATIO, least_pages: int = LEAST_PAGES) -> str:
    """DuckDB SQL for the query."""
    return f"""
with pages as (
  select row_number() over () as r, doc_id, source, text, coalesce(source, '') as host,
         string_split(text, chr(10)) as lines from documents),
line as (select distinct host, r, trim(l) as l from (select host, r, unnest(lines) as l from pages) where trim(l) <> ''),
bad as (
  select host, l from line group by host, l
  having count(*) >= {least_pages}
     and count(*) > (select count(*) from pages p where p.host = line.host)
       * case when length(l) >= {LONG} then {long_ratio} else {ratio} end),
boiler as (select host, list(l) as bad from bad group by host),
kept as (
  select doc_id, source, text, lines,
         list_filter(lines, lambda x: trim(x) = '' or not list_contains(coalesce(bad, []), trim(x))) as k
  from pages left join boiler using (host))
select doc_id, source, array_to_string(k, chr(10)) as text, coalesce(len(lines), 0)::int as lines_total,
       coalesce(len(lines) - len(k), 0)::int as lines_dropped
from kept"""
