"""Checks of the annual tables against the archives they come from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_json_list, json_list
from .fields import LABEL_LEAK

CELL_LIMIT = 32_767  # characters of a spreadsheet's cell
BOM = b"\xef\xbb\xbf"


def collect_members(members: DataFrame) -> DataFrame:
    """Of each (year, doc_id) the sorted PDF members; a null doc_id gathers those without one."""
    from ..functions.text import doc_id_from_name

    pdf = members.filter(F.endswith(F.lower("member"), F.lit(".pdf")) & ~F.endswith("member", F.lit("/")))
    return pdf.withColumn("doc_id", doc_id_from_name(F.col("member"))).groupBy("year", "doc_id").agg(F.array_sort(F.collect_list("member")).alias("members"))


def cell_checks(columns: list[str]) -> dict[str, Column]:
    """The longest cell and how many are over the limit."""
    size = [F.length(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns]
    return {"max_cell_chars": F.max(F.greatest(*size) if len(size) > 1 else size[0]), "cells_over_limit": F.sum(reduce(Column.__add__, [F.when(s > CELL_LIMIT, 1).otherwise(0) for s in size]))}


def label_leaks(*names: str) -> Column:
    """Rows where a label's rest got into a name."""
    return F.count_if(reduce(Column.__or__, [F.contains(F.coalesce(F.col(c), F.lit("")), F.lit(LABEL_LEAK)) for c in names]))


def not_a_list(column: str) -> Column:
    """Rows whose value isn't empty and no JSON list."""
    c = F.coalesce(F.col(column), F.lit(""))
    return F.count_if((c != "") & ~is_json_list(c))


def has_bom(files: DataFrame) -> DataFrame:
    """Of each file whether it begins with a byte order mark."""
    return files.select("path", F.coalesce(F.substring("content", 1, 3) == F.lit(BOM), F.lit(False)).alias("bom"))


def variant_list_mismatch(variants: Column, members: Column) -> Column:
    """Whether a row's variant list isn't the archive's; a text that is no list mismatches."""
    listed = json_list(F.coalesce(variants, F.lit("[]")), "string")
    return ~F.coalesce(F.array_sort(listed) == F.array_sort(F.coalesce(members, F.expr("CAST(array() AS array<string>)"))), F.lit(False))


def validate_years(table: DataFrame, members: DataFrame, columns: list[str], boms: DataFrame | None = None) -> DataFrame:
    """One row a year with all figures and the list of errors.

    table: the annual tables with `year`; members: collect_members(). Both sides meet once, on (year, doc_id).
    """
    named = members.filter("doc_id IS NOT NULL")
    rows = table.withColumn("_row", F.lit(True)).join(named.withColumn("_group", F.lit(True)), ["year", "doc_id"], "full")
    is_row, is_group = F.col("_row").isNotNull(), F.col("_group").isNotNull()
    # a row stands for its group's members once: by the first of its rows
    first = F.count_distinct(F.when(is_group, F.col("doc_id")))
    of_rows = {k: v for k, v in cell_checks(columns).items()}
    a = rows.groupBy("year").agg(
        first.alias("archive_unique_doc_ids"), F.count_if(is_row).alias("csv_rows"), F.count_distinct(F.when(is_row, F.col("doc_id"))).alias("csv_unique_doc_ids"),
        F.count_if(F.col("extraction_status") == "warning").alias("warning_rows"), F.count_if(F.col("extraction_status") == "failed").alias("failed_rows"),
        *(v.alias(k) for k, v in of_rows.items()), F.count_if(F.coalesce(F.col("pi_orcid"), F.lit("")) != "").alias("nonempty_orcid"),
        not_a_list("co_performers").alias("raw_co_performer_blocks"), not_a_list("research_leaders").alias("malformed_research_leaders"), label_leaks("performer_name", "customer_name").alias("label_leaks"),
        F.count_if(is_row & ~F.coalesce(F.array_contains("members", F.col("source_member")), F.lit(False))).alias("absent_members"),
        F.count_if(is_row & variant_list_mismatch(F.col("source_variants"), F.col("members"))).alias("bad_variant_lists"),
        F.count_if(is_group & ~is_row).alias("missing_doc_ids"), F.count_distinct(F.when(is_row & ~is_group, F.col("doc_id"))).alias("extra_doc_ids"),
    )
    physical = members.groupBy("year").agg(F.sum(F.when(F.col("doc_id").isNotNull(), F.size("members")).otherwise(0)).alias("archive_pdf_entries"), F.sum(F.when(F.col("doc_id").isNull(), F.size("members")).otherwise(0)).alias("unparsed"))
    a = a.join(physical, "year", "left").na.fill(0, ["archive_pdf_entries", "unparsed"])
    a = a.join(boms, "year", "left") if boms is not None else a.withColumn("bom", F.lit(True))
    # The wording of errors.
    texts = {
        "archive PDF without doc_id: %d": F.col("unparsed"),
        "CSV has no UTF-8 BOM": F.when(F.coalesce("bom", F.lit(False)), 0).otherwise(1),
        "missing doc_id: %d": F.col("missing_doc_ids"),
        "extra doc_id: %d": F.col("extra_doc_ids"),
        "duplicate CSV rows: %d": F.col("csv_rows") - F.col("csv_unique_doc_ids"),
        "selected source member absent from ZIP: %d": F.col("absent_members"),
        "source_variants mismatch: %d": F.col("bad_variant_lists"),
        "malformed research_leaders JSON cells: %d": F.col("malformed_research_leaders"),
        "organization label leaked into values: %d": F.col("label_leaks"),
    }
    said = [F.when(n > 0, F.format_string(t, n) if "%d" in t else F.lit(t)) for t, n in texts.items()]
    return a.withColumn("errors", F.filter(F.array(*said), lambda x: x.isNotNull()))


def validation_totals(years: DataFrame) -> DataFrame:
    """A4."""
    return years.agg(F.count("*").alias("years"), F.sum("csv_rows").alias("csv_rows"), F.sum("archive_pdf_entries").alias("archive_pdf_entries"), F.sum("warning_rows").alias("warning_rows"), F.sum("failed_rows").alias("failed_rows"), F.max("max_cell_chars").alias("max_cell_chars"), F.count_if(F.size("errors") > 0).alias("years_with_errors"))


def table_statistics(table: DataFrame) -> DataFrame:
    """By year the rows, ids, repeated rows, warnings and failures of the tables."""
    ident = F.lower("doc_id")
    return table.groupBy("year").agg(
        F.count("*").alias("rows"), F.count_distinct(ident).alias("ids"), (F.count("*") - F.count_distinct(ident)).alias("duplicates"),
        F.count_if(F.col("extraction_status") == "warning").alias("warnings"), F.count_if(F.col("extraction_status") == "failed").alias("failures"),
    )


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Schema check: exactly these columns in this order, or an error."""
    if df.columns != columns:
        raise ValueError(f"the table has {len(df.columns)} columns that aren't the {len(columns)} expected ones in their order")
    return df


def complete_output(reports: DataFrame, archives: DataFrame, columns: int) -> DataFrame:
    """Years whose report says that their table is whole and from this archive."""
    r = reports.join(archives.select("year", F.col("archive").alias("now")), "year")
    whole = ~F.coalesce("sample_mode", F.lit(True)) & (F.col("rows_written") == F.col("archive_unique_doc_ids")) & (F.col("csv_columns") == columns) & (F.col("archive") == F.col("now"))
    return r.filter(whole).select("year")
