"""Verification of archives, tables and packages against what is expected, with examples for reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .reconcile import flagged_ids
from .validate import complete_output


def first_examples(df: DataFrame, keys: list[str], value: str, n: int) -> DataFrame:
    """Of each group how many rows it has and its first n values in order.

    Rows behind the n-th go before anything is gathered, so a group of any size costs n values.
    """
    order = Window.partitionBy(*keys).orderBy(value)
    some = df.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= n).groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias("examples"))
    return df.groupBy(*keys).agg(F.count("*").alias("n")).join(some, keys)


def archive_verification(found: DataFrame, expected: DataFrame, examples: int = 20) -> DataFrame:
    """By year the members, ids, those missing and those not expected with the first of each, and whether all is well.

    found: year, doc_id (null where a member has none) of each member; expected: year, doc_id.
    """
    flags = flagged_ids(found=found.filter("doc_id IS NOT NULL"), expected=expected)
    kind = F.when(F.col("expected") & ~F.col("found"), "missing").when(F.col("found") & ~F.col("expected"), "extra")
    odd = first_examples(flags.withColumn("kind", kind).filter("kind IS NOT NULL"), ["year", "kind"], "doc_id", examples)
    named = odd.groupBy("year").agg(*(F.max(F.when(F.col("kind") == k, F.col("examples"))).alias(f"first_{k}") for k in ("missing", "extra")))
    ids = flags.groupBy("year").agg(F.count_if("found").alias("ids"), F.count_if(F.col("expected") & ~F.col("found")).alias("missing"), F.count_if(F.col("found") & ~F.col("expected")).alias("extra"))
    members = found.groupBy("year").agg(F.count("*").alias("members"), F.count_if(F.col("doc_id").isNull()).alias("unparsed"))
    out = ids.join(members, "year", "left").join(named, "year", "left").na.fill(0, ["members", "unparsed"])
    return out.withColumn("ok", (F.col("missing") == 0) & (F.col("extra") == 0) & (F.col("unparsed") == 0) & (F.col("members") == F.col("ids")))


def collected_ids(members: DataFrame, usable: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct (year, doc_id) of all usable archives, and of each year the sorted names of those.

    members: year, archive, doc_id; usable: year, archive. Archives that are none were left out when read (`permissive`).
    """
    own = members.join(usable, ["year", "archive"], "left_semi")
    return own.filter("doc_id IS NOT NULL").select("year", "doc_id").distinct(), usable.groupBy("year").agg(F.array_sort(F.collect_set("archive")).alias("archives"))


def archive_ids(members: DataFrame, examples: int = 5) -> DataFrame:
    """Of each archive its members, ids, those without an id, and the first of these. members: year, archive, member, doc_id."""
    keys = ["year", "archive"]
    counts = members.groupBy(*keys).agg(F.count("*").alias("physical"), F.count_distinct("doc_id").alias("ids"), F.count_if(F.col("doc_id").isNull()).alias("unparsed"))
    none = first_examples(members.filter("doc_id IS NULL"), keys, "member", examples)
    return counts.join(none.select(*keys, F.col("examples").alias("first_unparsed")), keys, "left")


def first_usable(archives: DataFrame, usable: DataFrame) -> DataFrame:
    """Of each year the usable archive that comes first. archives: year, archive, archive_rank."""
    return archives.join(usable, ["year", "archive"], "left_semi").groupBy("year").agg(F.min_by("archive", "archive_rank").alias("archive"))


def years_to_build(reports: DataFrame, archives: DataFrame, columns: int, force: bool = False) -> DataFrame:
    """Archives of the years whose table isn't whole yet."""
    return archives if force else archives.join(complete_output(reports, archives, columns), "year", "left_anti")


def verified_reports(reports: DataFrame, existing: DataFrame) -> DataFrame:
    """Years whose report is complete and whose listed archives all still exist. reports: year, complete, archives; existing: archive."""
    listed = reports.filter("complete").select("year", F.explode_outer("archives").alias("archive"))
    marked = listed.join(existing.select("archive").distinct().withColumn("_there", F.lit(True)), "archive", "left")
    return marked.groupBy("year").agg(F.bool_and(F.coalesce("_there", F.lit(False))).alias("there")).filter("there").select("year")


def ordered_years(df: DataFrame, descending: bool = False) -> DataFrame:
    """O3."""
    return df.orderBy(F.col("year").desc() if descending else F.col("year").asc())


def self_check(delivered: DataFrame, sources: DataFrame) -> DataFrame:
    """By name whether the delivered file has its source's bytes; files of one side only show as well. Both: name, bytes, sha256."""
    a, b = (df.select("name", F.struct("bytes", "sha256").alias(x)) for df, x in ((delivered, "delivered"), (sources, "source")))
    both = a.join(b, "name", "full_outer")
    return both.select("name", F.when(F.col("source").isNull(), "unknown").when(F.col("delivered").isNull(), "missing").when(F.col("delivered") == F.col("source"), "equal").otherwise("different").alias("state"))


def register_checks(registers: dict[str, DataFrame], totals: DataFrame, gaps: DataFrame) -> DataFrame:
    """Of each register whether it has as many rows as its total says, and whether the gaps add up.

    totals: name, expected, with a row "gaps" for the sum of gaps.gap.
    """
    counts = None
    for name, df in registers.items():
        one = df.agg(F.count("*").alias("found")).select(F.lit(name).alias("name"), "found")
        counts = one if counts is None else counts.unionByName(one)
    summed = gaps.agg(F.coalesce(F.sum("gap"), F.lit(0)).cast("long").alias("found")).select(F.lit("gaps").alias("name"), "found")
    counts = summed if counts is None else counts.unionByName(summed)
    return counts.join(totals, "name").select("name", "found", "expected", (F.col("found") == F.col("expected")).alias("equal"))


def error_groups(flags: DataFrame, gap_total: Column) -> DataFrame:
    """One row: how many ids of each error group are missing from the archives, and whether the groups are disjoint and complete.

    flags: flagged_ids(site, archive, no_pdf, server500).
    """
    missing = F.col("site") & ~F.col("archive")
    c = F.count_if
    one = flags.agg(
        c(missing & F.col("no_pdf")).alias("no_pdf"), c(missing & F.col("server500")).alias("http_500"), c(F.col("no_pdf") & F.col("server500")).alias("in_both"),
        c(missing & ~F.col("no_pdf") & ~F.col("server500")).alias("unexplained"), c((F.col("no_pdf") | F.col("server500")) & ~missing).alias("not_missing"), c(missing).alias("missing"),
    )
    gap = gap_total.cast("long")
    return one.select("*", gap.alias("gap"), (F.col("no_pdf") + F.col("http_500") + gap).alias("unavailable"), (F.col("in_both") == 0).alias("disjoint"), (F.col("unexplained") == 0).alias("complete"), (F.col("not_missing") == 0).alias("only_missing"), (F.col("no_pdf") + F.col("http_500") - F.col("in_both") + F.col("unexplained") == F.col("missing")).alias("adds_up"))
