"""Fixed schemas of the engine's tables, in the order of their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.language import TEXT_FIELDS
from .operators.fields import DATA_COLUMNS

# Column names that users of the tables rely on.
SYSTEM_COLUMNS = """
    doc_id source_file source_member source_variants pdf_variant_count year language extraction_status extraction_error
    quality_warnings missing_critical_fields extracted_text_chars section_count
    registration_number_filename registration_number_matches_filename
""".split()
ISSUE_COLUMNS = "year doc_id registration_number source_member extraction_status quality_warnings missing_critical_fields extraction_error".split()
MANIFEST_COLUMNS = """
    year archive archive_pdf_entries archive_unique_doc_ids extra_variants rows_written ok warning failed
    registration_mismatches csv
""".split()
ACCOUNT_COLUMNS = """
    year site_publications site_count_basis site_checked_at_utc archive_pdf_entries archive_unique_pdf_doc_ids
    pdf_doc_ids_in_current_site_year archive_pdf_doc_ids_outside_current_site_year known_no_pdf_doc_ids
    known_http_500_doc_ids known_listing_gap_without_doc_id listing_gap_details accounted_site_publications
    site_accounting_difference final_table_rows final_table_unique_doc_ids final_table_warning_rows
    final_table_failed_rows table_archive_difference table_doc_ids_exactly_match_archive website_accounting_ok
    audit_status
""".split()
MEMBER_FIELDS = """
    sha256 bytes readable pages opened_pages registration_filename registration_internal state_registration title_uk
    text_chars text_sha256 render_sha256 error
""".split()
GROUP_COLUMNS = """
    year doc_id classification same_publication decision_basis variant_count readable_count all_pages_opened
    selected_member selected_source_file selected_registration_number selected_state_registration_number
    selected_title_uk table_source_member table_selection_matches_audit dataset_action
""".split()
DUPLICATE_COLUMNS = [
    *GROUP_COLUMNS,
    *(c for side in "ab" for c in (f"member_{side}", *(f"member_{side}_{f}" for f in MEMBER_FIELDS))),
    "normalized_text_equal", "render_equal",
]
TABLE_COLUMNS = [*SYSTEM_COLUMNS, *DATA_COLUMNS, *(f"lang_{f}" for f in TEXT_FIELDS)]
#: The older command's table.
OLD_COLUMNS = ["source_file", "year", "language", *DATA_COLUMNS, *(f"lang_{f}" for f in TEXT_FIELDS)]
_NUMBERS = {"year", "pdf_variant_count", "extracted_text_chars", "section_count"}
TABLE = T.StructType([T.StructField(c, T.IntegerType() if c in _NUMBERS else T.StringType()) for c in TABLE_COLUMNS])


def projected(df: DataFrame, columns: list[str]) -> DataFrame:
    """K2: exactly these columns in this order; a missing one or a null string is ''."""
    kinds = dict(df.dtypes)
    text = lambda c: F.coalesce(F.col(c), F.lit("")) if kinds[c] == "string" else F.col(c)
    return df.select(*((text(c) if c in kinds else F.lit("")).alias(c) for c in columns))
