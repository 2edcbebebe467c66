"""Record jobs: tolerant typing, counts, hierarchical counts, date gaps, list parsing."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from fellwalk.functions.text import hex_to_long, int_list, iso_date, list_text, period_text, strict_int
from fellwalk.session import spread

# Parsers by kind: text column in, typed column or NULL out.
PARSERS: dict[str, Callable[[Column], Column]] = {
    "int": strict_int,
    "hex": hex_to_long,
    "date": iso_date,
    "string": lambda text: text,
}


def typed_records(raw: DataFrame, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Text columns to typed ones, with the names of the fields that failed in ``_failed``.

    ``fields`` maps each output name to (source column, kind).  A field that is absent or
    does not parse fails its record.  One pass; good records and rejects are filters on it.
    """
    parsed = {}
    for name, (source, kind) in fields.items():
        text = raw[f"`{source}`"] if source in raw.columns else F.lit(None).cast("string")
        parsed[name] = PARSERS[kind](text)
    failed = F.filter(F.array(*[F.when(c.isNull(), F.lit(n)) for n, c in parsed.items()]), lambda n: n.isNotNull())
    return raw.select(*[c.alias(n) for n, c in parsed.items()], failed.alias("_failed"))


def good_records(typed: DataFrame) -> DataFrame:
    return typed.filter(F.size("_failed") == 0).drop("_failed")


def rejected_records(typed: DataFrame) -> DataFrame:
    return typed.filter(F.size("_failed") > 0)


def parse_report(typed: DataFrame) -> DataFrame:
    """How many records there were and how many parsed."""
    good = F.size("_failed") == 0
    return typed.agg(F.count(F.lit(1)).alias("total"), F.count_if(good).alias("parsed"), F.count_if(~good).alias("rejected"))


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def location_rollup(df: DataFrame, outer: str = "country", inner: str = "city") -> DataFrame:
    """Count every row under its outer key and under outer / inner; no grand total.

    Rows are counted once per (outer, inner); the grouping sets run over those counts, so
    the rows themselves are not multiplied.
    """
    pairs = count_by(df, outer, inner)
    levels = pairs.groupingSets([[F.col(outer)], [F.col(outer), F.col(inner)]], F.col(outer), F.col(inner)).agg(
        F.sum("n").alias("n"), F.grouping(inner).alias("_outer_only")
    )
    deep = F.col("_outer_only") == 0
    path = F.when(deep, F.concat_ws(" / ", outer, inner)).otherwise(F.col(outer))
    rows = levels.select(F.when(deep, 2).otherwise(1).alias("level"), outer, inner, path.alias("path"), "n")
    return rows.orderBy("n", outer, "level", inner)


def calendar_gap(start: Column, end: Column) -> tuple[Column, Column, Column, Column]:
    """Years, months, days and total days from ``start`` to a later or equal ``end``."""
    index = lambda date: F.year(date) * 12 + F.month(date)
    apart = index(end) - index(start)
    months = F.when((apart > 0) & (F.dayofmonth(end) < F.dayofmonth(start)), apart - 1).otherwise(apart)
    days = F.datediff(end, F.add_months(start, months))
    whole_years = F.floor(months / 12).cast("int")
    return whole_years, (months - whole_years * 12).cast("int"), days, F.datediff(end, start)


GAP_CHUNK = 100_000


def date_gaps(df: DataFrame, date: str, ordered: bool = False, chunk: int = GAP_CHUNK) -> DataFrame:
    """The gaps between neighbouring dates of all rows in date order, one row per gap.

    Rows are first counted per date.  The window runs over the distinct dates, of which the
    calendar has a bounded number, and each date adds ``n - 1`` gaps of zero days.  Those are
    made in chunks that are spread over the cluster, so a date that holds a third of all rows
    is not expanded by one task.  ``ordered`` sorts by total days.
    """
    per_date = df.filter(F.col(date).isNotNull()).groupBy(F.col(date).alias("to_date")).agg(F.count(F.lit(1)).alias("n"))
    previous = F.lag("to_date").over(Window.orderBy("to_date"))
    between = per_date.select(previous.alias("from_date"), "to_date").filter(F.col("from_date").isNotNull())
    between = between.withColumn("copy", F.lit(0).cast("bigint"))

    repeats = F.col("n") - 1
    width = F.lit(chunk).cast("bigint")
    chunks = (
        per_date.filter(repeats > 0)
        .select("to_date", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((repeats - 1) / width))).alias("part"))
        .select("to_date", (F.col("part") * width).alias("start"), F.least(width, repeats - F.col("part") * width).alias("size"))
    )
    same_day = spread(chunks, "to_date", "start").select(
        F.col("to_date").alias("from_date"),
        "to_date",
        F.explode(F.sequence(F.col("start") + 1, F.col("start") + F.col("size"))).alias("copy"),
    )
    gaps = between.unionByName(same_day)
    years, months, days, total = calendar_gap(F.col("from_date"), F.col("to_date"))
    gaps = gaps.select("from_date", "to_date", "copy", years.alias("years"), months.alias("months"), days.alias("days"), total.alias("total_days"))
    gaps = gaps.withColumn("text", period_text(*[F.col(c) for c in ("years", "months", "days", "total_days")]))
    if ordered:
        gaps = gaps.orderBy("total_days", "from_date", "copy")
    return gaps.drop("copy")


def parsed_lists(df: DataFrame, text: str, key: str) -> DataFrame:
    """The integers of each delimited text: as text, times ten, their number and their sum."""
    items = int_list(F.col(text))
    return df.select(key, items.alias("items")).select(
        key,
        list_text(F.col("items")).alias("items_text"),
        list_text(F.transform("items", lambda x: x * 10)).alias("times_ten_text"),
        F.size("items").alias("n_items"),
        F.aggregate("items", F.lit(0).cast("bigint"), lambda total, x: total + x).alias("items_sum"),
    )


def body_sizes(pages: DataFrame, url: str = "url", body: str = "html") -> DataFrame:
    """Size of the stored body of each page, in characters."""
    return pages.select(F.col(url).alias("url"), F.length(body).cast("bigint").alias("body_size"))
