"""The annual repair report: what a year's site, state and archives say of each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import state_ids
from ..streaming.intake import unfinished
from .delivery import first_examples
from .reconcile import flagged_ids


def annual_repair_report(years: DataFrame, state: DataFrame, archived: DataFrame, loose: DataFrame, staged: DataFrame, totals: DataFrame, archives: DataFrame, examples: int = 1000) -> DataFrame:
    """A row a year with all figures of its report.

    years: year; state: day records (files.repair_state); archived, loose, staged: year, doc_id; totals: year, annual_total; archives: year,
    archive. All counts of ids are conditional counts of one aggregate over the tagged union of the six id tables. Unresolved ids are
    counted whole and listed up to `examples`; days are at most a year's. A total counts only where no day is open.
    """
    flags = flagged_ids(
        site=state_ids(state, "doc_ids"), no_pdf=state_ids(state, "no_pdf_doc_ids"), server500=state_ids(state, "server500_doc_ids"),
        archived=archived, loose=loose, staged=staged,
    )
    site, have = F.col("site"), F.col("archived") | F.col("loose") | F.col("staged")
    open_id = site & ~have & ~F.col("no_pdf") & ~F.col("server500")
    counts = flags.groupBy("year").agg(
        F.count_if(site).alias("daily_unique_site_doc_ids"), F.count_if(have).alias("unique_pdf_ids_before_patch"), F.count_if(site & ~have & F.col("no_pdf")).alias("confirmed_no_pdf"),
        F.count_if(site & ~have & ~F.col("no_pdf") & F.col("server500")).alias("confirmed_server500"), F.count_if(open_id).alias("unresolved"),
        F.count_if(have & ~site).alias("extra_pdf_ids_not_in_current_site_year"), F.count_if("loose").alias("loose_existing_pdf_count"), F.count_if("staged").alias("staged_pdf_count"),
    )
    some = first_examples(flags.filter(open_id), ["year"], "doc_id", examples).select("year", F.col("examples").alias("unresolved_doc_ids"))
    dead = F.coalesce(F.size("server500_doc_ids"), F.lit(0)) > 0
    more = dead & (F.coalesce(F.size("additional_logged_statuses"), F.lit(0)) > 0)
    pair = F.struct(F.col("day").alias("key"), F.col("additional_logged_statuses").alias("value"))
    days = state.groupBy("year").agg(F.array_sort(F.collect_set(F.when(dead, F.col("day")))).alias("accepted_server500_dates"), F.array_sort(F.collect_list(F.when(more, pair))).alias("pairs"))
    days = days.withColumn("accepted_server500_dates_with_additional_errors", F.map_from_entries("pairs")).drop("pairs")
    due = unfinished(years, state).groupBy("year").agg(F.array_sort(F.collect_list("day")).alias("unfinished_dates"))
    used = archives.groupBy("year").agg(F.array_sort(F.collect_set("archive")).alias("archives_used"))
    out = years.select("year").distinct()
    for part in (counts, some, days, due, used, totals.select("year", "annual_total")):
        out = out.join(part, "year", "left")
    none = F.array().cast("array<string>")
    out = out.na.fill(0, [c for c in counts.columns if c != "year"])
    out = out.withColumns({c: F.coalesce(c, none) for c in ("unresolved_doc_ids", "accepted_server500_dates", "unfinished_dates", "archives_used")})
    whole = F.size("unfinished_dates") == 0
    out = out.withColumn("annual_site_total", F.when(whole, F.col("annual_total"))).drop("annual_total")
    matches = F.coalesce(F.col("annual_site_total") == F.col("daily_unique_site_doc_ids"), F.lit(False))
    return out.withColumn("complete", whole & (F.col("unresolved") == 0) & matches)


def repair_lines(report: DataFrame, statuses: DataFrame) -> DataFrame:
    """(year, value) of the lines of open days and ids. report: annual_repair_report; statuses: year, day, statuses (day_statuses)."""
    tail = F.concat(F.lit("_repair_report_"), F.col("year").cast("string"), F.lit(".json | errors_"), F.col("year").cast("string"), F.lit(".txt"))
    days = report.select("year", F.explode("unfinished_dates").alias("day")).join(statuses, ["year", "day"], "left")
    told = F.coalesce(F.nullif(F.array_join("statuses", ","), F.lit("")), F.lit("-"))
    lines = days.select("year", F.concat_ws(" | ", F.col("year").cast("string"), "day", told, tail).alias("value"))
    ids = report.select("year", F.explode("unresolved_doc_ids").alias("doc_id"))
    return lines.unionByName(ids.select("year", F.concat_ws(" | ", F.col("year").cast("string"), F.concat(F.lit("doc_id="), "doc_id"), F.lit("unresolved"), tail).alias("value")))


def log_summary(log: DataFrame) -> DataFrame:
    """By year the lines of each status and the statuses of each day, as maps. Statuses are few, days at most a year's."""
    counts = log.groupBy("year", "status").agg(F.count("*").alias("n")).groupBy("year").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("counts_by_status"))
    days = log.groupBy("year", "day").agg(F.array_sort(F.collect_set("status")).alias("s")).groupBy("year").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("day", "s")))).alias("statuses_by_date"))
    return counts.join(days, "year")
