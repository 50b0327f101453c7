"""Groups of several variants under one id: fingerprints, classification, and whether the table chose as the audit does."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import basename, digest, registration_from_name
from ..functions.udfs import normalized
from ..schemas import DUPLICATE_COLUMNS, MEMBER_FIELDS, projected

# Classes by whether their variants are one publication.
SAME, DIFFERENT = "keep_one_best_copy", "keep_each_publication"
UNSURE = "manual_review_do_not_collapse"


def inspected(variants: DataFrame, records: DataFrame) -> DataFrame:
    """Fingerprints of variants.

    variants: year, doc_id, member, content, pages, opened_pages, text, render_sha256, error (null where read);
    records: parsed() of the same. Content and text end here.
    """
    r = records.select("year", "doc_id", F.col("source_member").alias("member"), F.col("registration_number").alias("registration_internal"), F.col("state_registration_number").alias("state_registration"), "title_uk", "title_en", "quality")
    own = variants.select(
        "year", "doc_id", "member", basename(F.col("member")).alias("source_file"), digest(F.col("content")).alias("sha256"), F.octet_length("content").cast("long").alias("bytes"),
        F.col("error").isNull().alias("readable"), "pages", "opened_pages", registration_from_name(F.col("member")).alias("registration_filename"),
        F.length(F.coalesce("text", F.lit(""))).alias("text_chars"), F.sha2(normalized(F.col("text")), 256).alias("text_sha256"), F.coalesce("render_sha256", F.lit("")).alias("render_sha256"), F.coalesce("error", F.lit("")).alias("error"),
    )
    return own.join(r, ["year", "doc_id", "member"], "left")


def same_nonempty(values: Column) -> Column:
    """F11, of normalized values: none empty, all equal."""
    return (F.size(values) > 0) & F.forall(values, lambda x: x != "") & (F.size(F.array_distinct(values)) == 1)


def classify(variants: Column) -> Column:
    """struct<classification, same_publication, rule> of an array of variants, by the first rule that applies.

    A variant has readable, text_sha256, render_sha256 and the normalized reg_file, reg, state and title.
    """
    read = F.filter(variants, lambda v: v["readable"])
    several = lambda a: F.size(F.array_distinct(F.filter(a, lambda x: x != ""))) > 1
    of = lambda a, k: F.transform(a, lambda v: v[k])
    distinct = lambda k: F.size(F.array_distinct(of(read, k)))
    names = F.filter(of(variants, "reg_file"), lambda x: x != "")
    only = F.try_element_at(of(read, "reg"), F.lit(1))
    agrees = (F.size(F.array_distinct(names)) <= 1) | ((only != "") & F.forall(names, lambda x: x == only))
    regs, states, titles = of(read, "reg"), of(read, "state"), of(read, "title")
    rule = (
        F.when(F.size(read) == 0, 1).when((F.size(read) == 1) & agrees, 2).when(F.size(read) == 1, 3)
        .when((distinct("text_sha256") == 1) & (distinct("render_sha256") == 1), 4).when(distinct("text_sha256") == 1, 5)
        .when(same_nonempty(regs) & same_nonempty(titles), 6).when(same_nonempty(regs) & same_nonempty(states), 7)
        .when(several(regs) & several(titles), 8).otherwise(9)
    )
    # The names of the classes, by rule.
    names_of = [
        "all_variants_unreadable",
        "same_publication_one_variant_unreadable",
        "ambiguous_unreadable_variant",
        "same_publication_identical_text_and_render",
        "same_publication_identical_text_render_differs",
        "same_publication_revised_pdf",
        "same_publication_revised_pdf",
        "different_publications_same_doc_id",
        "ambiguous_content_difference",
    ]
    same = F.when(rule.isin(2, 4, 5, 6, 7), True).when(rule == 8, False)
    return F.struct(F.element_at(F.array(*map(F.lit, names_of)), rule).alias("classification"), same.alias("same_publication"), rule.alias("rule"))


# What each rule rests on.
BASIS = [
    "no copy opens",
    "one copy was read in full; the copies' registration numbers agree",
    "the unreadable copy can't be identified by the registration number of its file",
    "normalized text and the image of every page agree",
    "all normalized text agrees; only the appearance differs",
    "internal registration number and title agree; the file was revised",
    "internal and state registration numbers agree",
    "internal registration numbers, titles and content differ",
    "content differs, but identifiers don't suffice for a decision",
]


def audit_groups(variants: DataFrame, table: DataFrame) -> DataFrame:
    """One row for each group of several variants, with both choices compared.

    variants: inspected(); table: doc_id, source_member (the row chosen for the tables). `variants` keeps
    the whole array; duplicate_rows() shows the first two.
    """
    v = variants.withColumns({"reg_file": normalized(F.col("registration_filename")), "reg": normalized(F.col("registration_internal")), "state": normalized(F.col("state_registration")), "title": normalized(F.coalesce(F.nullif("title_uk", F.lit("")), "title_en", F.lit("")))})
    cols = ["member", *(c for c in v.columns if c not in ("year", "doc_id", "member"))]
    # An unreadable variant is never chosen; among the others the larger struct wins.
    order = F.when(F.col("readable"), F.struct("quality", (F.col("opened_pages") == F.col("pages")).alias("whole"), "bytes", "member"))
    g = v.groupBy("year", "doc_id").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("variants"), F.max_by(F.when(F.col("readable"), F.struct(*cols)), order).alias("best")).filter(F.size("variants") > 1)
    g = g.join(table.select(F.lower("doc_id").alias("doc_id"), F.col("source_member").alias("table_source_member")), "doc_id", "left")
    g = g.withColumns({"c": classify(F.col("variants")), "table_source_member": F.coalesce("table_source_member", F.lit("")), "selected_member": F.coalesce("best.member", F.lit(""))})
    all_read = F.forall("variants", lambda x: x["readable"])
    equal = lambda k: F.when(all_read & (F.size(F.array_distinct(F.transform("variants", lambda x: x[k]))) == 1), "yes").otherwise("no")
    yes = lambda c: F.when(c, "yes").otherwise("no")
    return g.select(
        "year", "doc_id", "c.classification", F.when(F.col("c.same_publication").isNull(), "unknown").otherwise(yes(F.col("c.same_publication"))).alias("same_publication"),
        F.element_at(F.array(*map(F.lit, BASIS)), F.col("c.rule")).alias("decision_basis"), F.size("variants").alias("variant_count"), F.size(F.filter("variants", lambda x: x["readable"])).alias("readable_count"),
        yes(F.forall("variants", lambda x: x["readable"] & (x["pages"] == x["opened_pages"]))).alias("all_pages_opened"), "selected_member",
        F.coalesce("best.source_file", F.lit("")).alias("selected_source_file"), F.coalesce("best.registration_internal", F.lit("")).alias("selected_registration_number"),
        F.coalesce("best.state_registration", F.lit("")).alias("selected_state_registration_number"), F.coalesce("best.title_uk", F.lit("")).alias("selected_title_uk"), "table_source_member",
        yes(F.col("selected_member") == F.col("table_source_member")).alias("table_selection_matches_audit"),
        F.when(F.col("c.same_publication"), SAME).when(~F.col("c.same_publication"), DIFFERENT).otherwise(UNSURE).alias("dataset_action"),
        equal("text_sha256").alias("normalized_text_equal"), equal("render_sha256").alias("render_equal"), "variants",
    )


def duplicate_rows(groups: DataFrame) -> DataFrame:
    """K9: the 46 columns of the audit's table; two variants are shown."""
    for i, side in enumerate("ab", 1):
        m = F.try_element_at("variants", F.lit(i))
        show = lambda f, m=m: F.when(m[f], "yes").otherwise("no") if f == "readable" else F.coalesce(m[f].cast("string"), F.lit(""))
        groups = groups.withColumns({f"member_{side}": F.coalesce(m["member"], F.lit(""))} | {f"member_{side}_{f}": show(f) for f in MEMBER_FIELDS})
    return projected(groups, DUPLICATE_COLUMNS)


def duplicate_totals(groups: DataFrame) -> DataFrame:
    """One row of counts over all groups."""
    return groups.agg(
        F.count("*").alias("duplicate_groups"), F.coalesce(F.sum("variant_count"), F.lit(0)).alias("variant_files"), F.count_if(F.col("readable_count") < F.col("variant_count")).alias("groups_with_unreadable_variant"),
        F.count_if(F.col("same_publication") == "no").alias("different_publication_collisions"), F.count_if(F.col("same_publication") == "unknown").alias("unresolved_groups"),
        F.count_if(F.col("table_selection_matches_audit") == "no").alias("table_selection_mismatches"),
    )


def class_counts(groups: DataFrame, by: str = "classification") -> DataFrame:
    """A8."""
    return groups.groupBy(by).agg(F.count("*").alias("groups"))
