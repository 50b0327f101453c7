"""Listing pages as rows: cards, announced totals, and whether a page answers what was asked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.udfs import parse_listing

# The two wordings of an announced total.
TOTAL_UK = r"(?iuU)Знайдено\s+документів:\s*([\d\s.,]+)"
TOTAL_EN = r"(?iuU)([\d\s.,]+)\s+documents?\s+found"


def total_results(text: Column) -> Column:
    """The announced total of a page's text; 0 where its number has no digit, null where none is announced."""

    def number(pattern: str) -> Column:
        digits = F.regexp_replace(F.regexp_extract(text, pattern, 1), r"(?U)\D", "")
        return F.when(text.rlike(pattern), F.coalesce(F.nullif(digits, F.lit("")).cast("long"), F.lit(0)))

    return F.coalesce(number(TOTAL_UK), number(TOTAL_EN))


def matches_dates(inputs: Column, start: Column, end: Column) -> Column:
    """Whether a page echoes the range that was asked for."""
    return F.coalesce((inputs["dateFromSearch"] == start) & (inputs["dateToSearch"] == end), F.lit(False))


def observations(pages: DataFrame, base_url: str, pdf_base_url: str, host_pattern: str, css_class: str = "my-card-body") -> DataFrame:
    """Pages (year, day, page, html) to one row each: total, dates_ok, cards, accepted.

    A page without cards, total and echo is no empty day but a failure.
    """
    p = pages.withColumn("p", parse_listing(base_url, pdf_base_url, host_pattern, css_class)(F.col("html")))
    p = p.select("year", "day", "page", total_results(F.col("p.text")).alias("total"), matches_dates(F.col("p.inputs"), F.col("day"), F.col("day")).alias("dates_ok"), F.col("p.cards").alias("cards"))
    return p.withColumn("accepted", (F.size("cards") > 0) | F.col("total").isNotNull() | F.col("dates_ok"))


def annual_total(pages: DataFrame) -> DataFrame:
    """A year's announced total, null unless the page echoes the year's range. pages: observations() with start and end as asked."""
    return pages.groupBy("year").agg(F.max(F.when(F.col("dates_ok"), F.col("total"))).alias("annual_site_total"))
