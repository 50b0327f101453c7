"""One record for each document: variants parsed, scored, and the best one chosen in one shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.language import with_languages
from ..functions.text import basename, registration_from_name, strip
from .fields import CRITICAL_FIELDS, DATA_COLUMNS, with_data_fields
from .numbering import numbered
from .sections import section_count, split_sections

LEAST_SECTIONS = 6


def named_where(conditions: dict[str, Column]) -> Column:
    """The names of those conditions that hold, in order."""
    return F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in conditions.items())), lambda x: x.isNotNull())


def missing_fields(fields: list[str] = CRITICAL_FIELDS) -> Column:
    """Which of the fields are empty or null; blanks count as a value."""
    return named_where({f: F.coalesce(F.col(f), F.lit("")) == "" for f in fields})


def filled_count(fields: list[str] = DATA_COLUMNS) -> Column:
    """P5: how many fields hold more than white space."""
    # most fields are empty, which needs no pattern
    return sum((F.when(F.coalesce(F.col(f), F.lit("")) == "", 0).when(strip(F.col(f)) != "", 1).otherwise(0) for f in fields), F.lit(0))


def registration_match(internal: Column, from_name: Column) -> Column:
    """Yes, no, or unknown where one side is empty."""
    both = (F.coalesce(internal, F.lit("")) != "") & (F.coalesce(from_name, F.lit("")) != "")
    return F.when(~both, "unknown").when(internal == from_name, "yes").otherwise("no")


def warnings(missing: Column, sections: Column, match: Column) -> Column:
    """In this order."""
    return named_where({"missing_critical_fields": F.size(missing) > 0, "few_nonempty_sections": sections < LEAST_SECTIONS, "registration_number_mismatch": match == "no"})


def parsed(variants: DataFrame, strict_names: bool = True, short_language=None) -> DataFrame:
    """Variants (year, doc_id, member, text, error; error null where text was read) with all columns of their record and `quality`.

    The text goes once its length and fields are taken, so no later shuffle carries it.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    df = variants.select("year", "doc_id", F.col("member").alias("source_member"), "error", text.alias("text"))
    df = df.withColumns({"sections": split_sections(F.col("text")), "extracted_text_chars": F.length("text")}).drop("text")
    df = with_languages(with_data_fields(df.withColumn("section_count", section_count(F.col("sections"))), strict_names=strict_names), short_language)
    df = df.withColumns({"source_file": basename(F.col("source_member")), "missing": missing_fields(), "filled": filled_count()})
    df = df.withColumn("registration_number_filename", registration_from_name(F.col("source_file")))
    df = df.withColumn("registration_number_matches_filename", registration_match(F.col("registration_number"), F.col("registration_number_filename")))
    df = df.withColumn("warned", warnings(F.col("missing"), F.col("section_count"), F.col("registration_number_matches_filename")))
    return df.withColumns({
        "extraction_status": F.when(F.size("warned") > 0, "warning").otherwise("ok"),
        "extraction_error": F.lit(""),
        "quality_warnings": F.array_join("warned", ";"),
        "missing_critical_fields": F.array_join("missing", ";"),
        "quality": F.struct(
            F.lit(1).alias("readable"),
            (F.col("registration_number_matches_filename") == "yes").cast("int").alias("matches"),
            (F.lit(len(CRITICAL_FIELDS)) - F.size("missing")).alias("critical"),
            F.col("section_count").alias("sections"), F.col("filled"), F.col("extracted_text_chars").alias("chars"),
        ),
    }).drop("missing", "warned", "filled")


def best_variant(df: DataFrame, keys: list[str], quality: Column, tie: Column) -> DataFrame:
    """Of each group the row of the largest (quality, tie), by one partial and final aggregate."""
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(quality.alias("quality"), tie.alias("tie"))).alias("best"))
    return best.select("best.*")


def first_variant(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Of each group the row that comes first."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), order).alias("best")).select("best.*")


def best_records(variants: DataFrame, strict_names: bool = True, short_language=None) -> DataFrame:
    """One record for each (year, doc_id), in one shuffle.

    A failing variant doesn't remove its document: others stand in with a warning, and where none can
    be read, a failed record takes the first member's name.
    """
    rows = parsed(variants, strict_names, short_language)
    ok = F.col("error").isNull()
    record = F.struct(*(c for c in rows.columns if c not in ("year", "doc_id", "error", "quality")))
    failure = F.when(~ok, F.struct(F.col("source_member").alias("member"), F.concat("source_member", F.lit(": "), "error").alias("text")))
    g = rows.groupBy("year", "doc_id").agg(
        F.max_by(F.when(ok, record), F.when(ok, F.struct("quality", "source_member"))).alias("r"),
        F.array_sort(F.collect_list("source_member")).alias("members"),
        F.array_sort(F.collect_list(failure)).alias("failures"),
    )
    errors = F.array_join(F.transform("failures", lambda x: x["text"]), " | ")
    none, some = F.col("r").isNull(), F.size("failures") > 0
    first = F.col("members")[0]
    own = {c: F.when(none, F.lit("" if rows.schema[c].dataType.typeName() == "string" else 0)).otherwise(F.col(f"r.{c}")) for c in rows.columns if c not in ("year", "doc_id", "error", "quality")}
    own |= {
        "source_member": F.when(none, first).otherwise(own["source_member"]),
        "source_file": F.when(none, basename(first)).otherwise(own["source_file"]),
        "source_variants": F.to_json("members"),
        "pdf_variant_count": F.size("members"),
        "language": F.when(none, "unknown").otherwise(own["language"]),
        "extraction_status": F.when(none, "failed").when(some, "warning").otherwise(own["extraction_status"]),
        "extraction_error": F.when(some, errors).otherwise(""),
        "quality_warnings": F.when(none, "pdf_parse_failed").when(some, F.array_join(F.array_distinct(F.filter(F.concat(F.split(own["quality_warnings"], ";"), F.array(F.lit("other_variant_parse_failed"))), lambda x: x != "")), ";")).otherwise(own["quality_warnings"]),
        "missing_critical_fields": F.when(none, ";".join(CRITICAL_FIELDS)).otherwise(own["missing_critical_fields"]),
        "registration_number_filename": F.when(none, registration_from_name(basename(first))).otherwise(own["registration_number_filename"]),
        "registration_number_matches_filename": F.when(none, "unknown").otherwise(own["registration_number_matches_filename"]),
    }
    return g.select("year", "doc_id", *(v.alias(k) for k, v in own.items()))


def single_records(variants: DataFrame) -> DataFrame:
    """X21, the older command: a record for each readable variant, with `has_warn` where a critical field is empty."""
    return parsed(variants.filter("error IS NULL")).withColumn("has_warn", F.col("missing_critical_fields") != "")


def even_sample(df: DataFrame, k: int, order: str, by: list[str] | None = None) -> DataFrame:
    """Every step-th row in order, step = max(1, n / k), the first k of them, of each group of `by`.

    Without `by` the order is global and its numbers come from ranges (`numbered`), so no task sees all rows; df is then read
    twice and should hold ids only. k of 0 keeps all.
    """
    if k <= 0:
        return df
    if by:
        w = Window.partitionBy(*by)
        df = df.withColumns({"_i": F.row_number().over(w.orderBy(order)) - 1, "_n": F.count("*").over(w)})
    else:
        df = numbered(df, [F.col(order)], "_i")
        df = df.withColumns({"_i": F.col("_i") - 1, "_n": F.lit(df.rows)})
    step = F.greatest(F.lit(1), F.floor(F.col("_n") / k))
    return df.filter((F.col("_i") % step == 0) & (F.col("_i") < k * step)).drop("_i", "_n")


def status_counts(records: DataFrame) -> DataFrame:
    """A1, A2: by year."""
    is_ = lambda s: F.count_if(F.col("extraction_status") == s).alias(s)
    return records.groupBy("year").agg(
        F.sum("pdf_variant_count").alias("archive_pdf_entries"), F.count("*").alias("archive_unique_doc_ids"), F.sum(F.col("pdf_variant_count") - 1).alias("extra_variants"),
        is_("ok"), is_("warning"), is_("failed"), F.count_if(F.col("registration_number_matches_filename") == "no").alias("registration_mismatches"),
    )


def totals(annual: DataFrame) -> DataFrame:
    """A3: the annual rows and their grand total, whose year is null."""
    sums = [F.sum(c).alias(c) for c in annual.columns if c != "year"]
    return annual.rollup("year").agg(*sums, F.count("*").alias("years"))
