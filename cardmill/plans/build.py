"""The build, audit and delivery plans, from archives to accounted tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import doc_id_from_name, page_text
from ..functions.udfs import Backend, document_pages, html_unescape
from ..operators.consolidate import aliases, content_dedup, dedup_counts, output_names
from ..operators.reconcile import collection_rate, control_equalities
from ..operators.variants import best_records, status_counts, totals
from ..schemas import TABLE_COLUMNS
from ..sources.shared import shared_path
from ..sources.sinks import manifest, quality_issues


def document_texts(members: DataFrame, backend: Backend) -> DataFrame:
    """Members with content to (year, doc_id, member, text, error, pages, opened_pages, render_sha256)."""
    pdf = members.filter(F.endswith(F.lower("member"), F.lit(".pdf"))).withColumn("doc_id", doc_id_from_name(F.col("member")))
    p = pdf.withColumn("p", document_pages(backend)(F.col("content")))
    # pages go through the entity function together, so text crosses to Python once more only
    mark = "\x00"
    joined = page_text_of(F.array_join("p.html", mark), mark)
    error = F.nullif("p.error", F.lit(""))
    return p.select("year", "doc_id", "member", "content", F.when(error.isNull(), joined).alias("text"), error.alias("error"), F.size("p.html").alias("pages"), "p.opened_pages", "p.render_sha256")


def page_text_of(html, mark: str):
    """S5 of several pages in one string: each page on its own, joined by line breaks."""
    unescaped = html_unescape(F.regexp_replace(html, "<[^>]+>", " "))
    return F.array_join(F.transform(F.split(unescaped, mark), lambda x: page_text(x, lambda y: y)), "\n")


def stored_once(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = shared_path(spark, "stored")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def year_reports(records: DataFrame, archives: DataFrame, sample: bool = False) -> DataFrame:
    """K3: the report of each year's build, a row a year. archives: year, archive."""
    counts = status_counts(records).join(archives, "year", "left")
    return counts.select(
        "year", "archive", F.lit(sample).alias("sample_mode"), F.col("archive_unique_doc_ids").alias("rows_written"), "archive_pdf_entries", "archive_unique_doc_ids", "extra_variants",
        "ok", "warning", "failed", "registration_mismatches", F.lit(len(TABLE_COLUMNS)).alias("csv_columns"),
    )


def build_tables(variants: DataFrame, strict_names: bool = True) -> dict[str, DataFrame]:
    """The table, the annual figures with their total, the manifest and the issues. One shuffle makes the table.

    It is written to the shared folder once, so no document is parsed again for the figures.
    """
    records = stored_once(best_records(variants, strict_names))
    annual = status_counts(records)
    return {"records": records, "annual": annual, "totals": totals(annual), "manifest": manifest(annual.withColumn("rows_written", F.col("archive_unique_doc_ids"))), "issues": quality_issues(records)}


def consolidate(refs: DataFrame) -> dict[str, DataFrame]:
    """What goes into the merged archives, under which names, and what was left out. Contents are hashed once."""
    named = stored_once(output_names(content_dedup(refs)))
    return {"entries": named, "counts": dedup_counts(named), "aliases": aliases(refs, named)}


def delivery_checks(account: DataFrame, duplicates: DataFrame) -> DataFrame:
    """One row of equalities and the collection rate, from the totals of both audits."""
    one = account.withColumn("_one", F.lit(1)).join(duplicates.withColumn("_one", F.lit(1)), "_one")  # a row on each side
    t = {
        "site": F.col("site_publications"), "current": F.col("pdf_doc_ids_in_current_site_year"), "no_pdf": F.col("known_no_pdf_doc_ids"), "http_500": F.col("known_http_500_doc_ids"),
        "gap": F.col("known_listing_gap_without_doc_id"), "outside": F.col("archive_pdf_doc_ids_outside_current_site_year"), "unique": F.col("archive_unique_pdf_doc_ids"), "physical": F.col("archive_pdf_entries"),
        "table_rows": F.col("final_table_rows"), "table_unique": F.col("final_table_unique_doc_ids"), "extra_variants": F.col("variant_files") - F.col("duplicate_groups"),
        "collisions": F.col("different_publication_collisions"), "unresolved": F.col("unresolved_groups"), "selection_mismatches": F.col("table_selection_mismatches"),
    }
    return one.select(*(v.alias(k) for k, v in control_equalities(t).items()), collection_rate(t["current"], t["site"]).alias("collection_rate"))


def read_years(spark: SparkSession, folder: str, content: bool = False) -> DataFrame:
    from ..sources.ziparchive import year_archives, zip_members

    return zip_members(spark, year_archives(folder), content)
