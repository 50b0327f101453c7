"""Announced, collected and tabulated ids of a year, accounted for in one pass.

All set questions of a year become flags of one row for each (year, doc_id), made by one aggregate over the tagged
union of the id tables; each figure is then a conditional count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import count_mismatch, is_doc_id, server_500, strip

# The wording of a count mismatch in the logs.
ANNOUNCED, LISTED = "сайт объявил", "собрано уникальных doc_id"


def flagged_ids(**tables: DataFrame) -> DataFrame:
    """One row for each (year, doc_id) of any table, with a boolean for each table.

    Ids are compared in lower case. One shuffle, whatever the number of tables.
    """
    tagged = [t.select("year", F.lower("doc_id").alias("doc_id"), *(F.lit(n == name).alias(n) for n in tables)) for name, t in tables.items()]
    return reduce(DataFrame.unionByName, tagged).groupBy("year", "doc_id").agg(*(F.bool_or(n).alias(n) for n in tables))


def only_in(flags: DataFrame, inside: list[str], outside: list[str]) -> DataFrame:
    """J13, J15 and all set differences: ids in all of the one tables and in none of the others."""
    want = reduce(Column.__and__, [F.col(n) for n in inside] + [~F.col(n) for n in outside])
    return flags.filter(want).select("year", "doc_id")


def error_log(lines: DataFrame) -> DataFrame:
    """Lines (year, line_no, value) of a log to its fields; short lines go."""
    parts = F.transform(F.split("value", r"\|"), lambda x: strip(x))
    p = lines.withColumn("p", parts).filter(F.size("p") >= 6)
    names = ["timestamp", "day", "status", "registration", "doc_id", "reason", "url"]
    return p.select("year", "line_no", *(F.coalesce(F.try_element_at("p", F.lit(i + 1)), F.lit("")).alias(n) for i, n in enumerate(names)), (F.size("p") >= 7).alias("complete"))


def listing_gaps(log: DataFrame, relevant: DataFrame, announced: str = ANNOUNCED, listed: str = LISTED) -> DataFrame:
    """Of each relevant (year, day) the gap of its last count mismatch; null where no line tells one."""
    gap = count_mismatch(F.col("reason"), announced, listed)
    told = log.filter(F.col("status") == "count_mismatch").withColumn("gap", gap).filter("gap IS NOT NULL")
    last = told.groupBy("year", "day").agg(F.max_by("gap", "line_no").alias("gap"))
    return relevant.select("year", "day").distinct().join(last, ["year", "day"], "left")


def log_statistics(log: DataFrame) -> DataFrame:
    """Lines of each status."""
    return log.groupBy("year", "status").agg(F.count("*").alias("lines"))


def day_statuses(log: DataFrame) -> DataFrame:
    """The sorted statuses of each day."""
    return log.groupBy("year", "day").agg(F.array_sort(F.collect_set("status")).alias("statuses"))


def server_500_ids(log: DataFrame) -> DataFrame:
    """Ids whose reason tells of a server error."""
    return log.filter(F.col("complete") & is_doc_id(F.lower("doc_id")) & server_500(F.col("reason"))).select("year", F.lower("doc_id").alias("doc_id")).distinct()


def server_500_days(log: DataFrame) -> DataFrame:
    """Days of the year with a server error: its ids, ids without a PDF, and the other statuses."""
    ident = F.lower("doc_id")
    ok = is_doc_id(ident)
    hit = ok & server_500(F.col("reason"))
    none = ~hit & ok & (F.col("status") == "notpdf")
    own = log.filter(F.col("complete") & F.startswith("day", F.concat(F.col("year").cast("string"), F.lit("-"))))
    sets = own.groupBy("year", "day").agg(
        F.array_sort(F.collect_set(F.when(hit, ident))).alias("server500_doc_ids"), F.array_sort(F.collect_set(F.when(none, ident))).alias("no_pdf_doc_ids"),
        F.array_sort(F.collect_set(F.when(~hit & ~none, F.col("status")))).alias("additional_statuses"),
    )
    return sets.filter(F.size("server500_doc_ids") > 0)


def legacy_days(days: DataFrame, state: DataFrame, existing: DataFrame) -> DataFrame:
    """Server-error days that the state lacks, with all ids known of them.

    existing: year, day, doc_ids (what the archives hold by date).
    """
    new = days.join(state.select("year", "day").distinct(), ["year", "day"], "left_anti").join(existing, ["year", "day"], "left")
    ids = F.array_sort(F.array_distinct(F.concat(F.coalesce("doc_ids", F.expr("CAST(array() AS array<string>)")), "server500_doc_ids", "no_pdf_doc_ids")))
    return new.withColumn("doc_ids", ids)


def register(state: DataFrame, ids: str) -> DataFrame:
    """Of each (year, doc_id) in an id list of the day records its sorted days, joined by ;."""
    rows = state.select("year", "day", F.explode(ids).alias("doc_id")).withColumn("doc_id", F.lower("doc_id"))
    return rows.groupBy("year", "doc_id").agg(F.array_join(F.array_sort(F.collect_set("day")), ";").alias("days"))


def annual_accounts(flags: DataFrame, entries: DataFrame, table: DataFrame, gaps: DataFrame, reports: DataFrame) -> DataFrame:
    """A10: the accounting of each year of reports.

    flags: flagged_ids(site, archive, no_pdf, server500, table); entries: year, physical, unparsed; table: year,
    rows, warnings, failures, duplicates; gaps: year, day, gap; reports: year, annual_site_total, checked_at_utc, daily_ids.
    """
    c = F.count_if
    site, pdf, no_pdf, err, tab = (F.col(n) for n in ("site", "archive", "no_pdf", "server500", "table"))
    missing = site & ~pdf
    ids = flags.groupBy("year").agg(
        c(site).alias("site_ids"), c(pdf).alias("archive_unique_pdf_doc_ids"), c(site & pdf).alias("pdf_doc_ids_in_current_site_year"),
        c(pdf & ~site).alias("archive_pdf_doc_ids_outside_current_site_year"), c(missing & no_pdf).alias("known_no_pdf_doc_ids"), c(missing & err).alias("known_http_500_doc_ids"),
        c(missing & ~no_pdf & ~err).alias("unexplained"), c((no_pdf | err) & ~missing).alias("errors_not_missing"), c(no_pdf & err).alias("overlapping"),
        c(tab).alias("final_table_unique_doc_ids"), c(tab != pdf).alias("table_mismatches"),
    )
    gap = gaps.filter("gap IS NOT NULL").groupBy("year").agg(
        F.sum("gap").alias("known_listing_gap_without_doc_id"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("day", "gap"))), lambda x: F.concat(x["day"], F.lit(": +"), x["gap"].cast("string"))), "; ").alias("listing_gap_details"),
    )
    a = reports
    for t in (ids, entries, table, gap):
        a = a.join(t, "year", "left")  # a row a year on each side
    a = a.na.fill(0, [x for x, k in a.dtypes if k in ("bigint", "int") and x not in ("year", "annual_site_total")]).na.fill("", ["listing_gap_details", "checked_at_utc"])
    a = a.withColumns({
        "site_publications": F.coalesce("annual_site_total", F.col("site_ids") + F.col("known_listing_gap_without_doc_id")),
        "site_count_basis": F.when(F.col("annual_site_total").isNotNull(), "annual_site_total").otherwise("daily_site_doc_ids_plus_persistent_listing_gaps"),
        "accounted_site_publications": F.col("pdf_doc_ids_in_current_site_year") + F.col("known_no_pdf_doc_ids") + F.col("known_http_500_doc_ids") + F.col("known_listing_gap_without_doc_id"),
        "table_archive_difference": F.col("rows") - F.col("archive_unique_pdf_doc_ids"),
        "table_doc_ids_exactly_match_archive": (F.col("table_mismatches") == 0) & (F.col("duplicates") == 0) & (F.col("rows") == F.col("final_table_unique_doc_ids")) & (F.col("unparsed") == 0),
    })
    a = a.withColumn("site_accounting_difference", F.col("accounted_site_publications") - F.col("site_publications"))
    clean = (F.col("site_accounting_difference") == 0) & (F.col("unexplained") == 0) & (F.col("errors_not_missing") == 0) & (F.col("overlapping") == 0)
    fail = ~clean | (F.col("unparsed") > 0) | (F.col("duplicates") > 0) | ~F.col("table_doc_ids_exactly_match_archive")
    known = F.col("known_no_pdf_doc_ids") + F.col("known_http_500_doc_ids") + F.col("known_listing_gap_without_doc_id") + F.col("archive_pdf_doc_ids_outside_current_site_year") + F.col("failures")
    return a.withColumns({
        # the daily count belongs to the flag only, not to the status
        "website_accounting_ok": clean & (F.col("site_ids") == F.coalesce("daily_ids", F.lit(0))),
        "audit_status": F.when(fail, "FAIL").when(known > 0, "PASS_WITH_KNOWN_EXCEPTIONS").otherwise("PASS"),
    }).select(
        "year", "site_publications", "site_count_basis", F.col("checked_at_utc").alias("site_checked_at_utc"), F.col("physical").alias("archive_pdf_entries"), "archive_unique_pdf_doc_ids",
        "pdf_doc_ids_in_current_site_year", "archive_pdf_doc_ids_outside_current_site_year", "known_no_pdf_doc_ids", "known_http_500_doc_ids", "known_listing_gap_without_doc_id",
        "listing_gap_details", "accounted_site_publications", "site_accounting_difference", F.col("rows").alias("final_table_rows"), "final_table_unique_doc_ids",
        F.col("warnings").alias("final_table_warning_rows"), F.col("failures").alias("final_table_failed_rows"), "table_archive_difference", "table_doc_ids_exactly_match_archive",
        "website_accounting_ok", "audit_status",
    )


def account_totals(accounts: DataFrame) -> DataFrame:
    """One row of sums, status counts and whether all years hold."""
    sums = [x for x, k in accounts.dtypes if k == "bigint"]
    status = F.col("audit_status")
    return accounts.agg(
        F.count("*").alias("years"), *(F.sum(x).alias(x) for x in sums),
        F.count_if(status == "PASS").alias("pass"), F.count_if(status == "PASS_WITH_KNOWN_EXCEPTIONS").alias("pass_with_known_exceptions"), F.count_if(status == "FAIL").alias("fail"),
        F.bool_and("website_accounting_ok").alias("all_websites_ok"), F.bool_and("table_doc_ids_exactly_match_archive").alias("all_tables_match"),
    )


def control_equalities(t: dict[str, Column]) -> dict[str, Column]:
    """The equalities that a delivery must satisfy, from named totals."""
    return {
        "website_accounting": t["current"] + t["no_pdf"] + t["http_500"] + t["gap"] == t["site"],
        "archive_accounting": t["current"] + t["outside"] == t["unique"],
        "physical_pdf_accounting": t["unique"] + t["extra_variants"] == t["physical"],
        "pdf_to_table_rows": t["unique"] == t["table_rows"],
        "pdf_to_table_unique_ids": t["unique"] == t["table_unique"],
        "duplicate_audit_resolved": (t["collisions"] == 0) & (t["unresolved"] == 0) & (t["selection_mismatches"] == 0),
    }


def collection_rate(current: Column, site: Column) -> Column:
    """1 where nothing was announced."""
    return F.coalesce(F.try_divide(current.cast("double"), site), F.lit(1.0))


def ensure(checks: DataFrame) -> None:
    """Raise on the first false column of a one-row frame of booleans."""
    row = checks.first().asDict()
    if wrong := [k for k, v in row.items() if v is not True]:
        raise ValueError(f"control equalities don't hold: {', '.join(wrong)}")
