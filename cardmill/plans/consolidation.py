"""Many archives and staged files to one verified archive a year, end to end.

Contents are read once to be hashed and once more, those that are kept, by the tasks that write them; in between, only names, hashes
and places move. Nothing is written before every year of the call has a decision without error, and nothing is
published before the archives are verified (sources.yearzip).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import digest, doc_id_from_name, valid_pdf
from ..operators.consolidate import aliases, content_dedup, decision, dedup_counts, id_digest, output_names, source_refs
from ..operators.delivery import archive_verification
from ..sources.shared import file_system, shared_path
from ..sources.storage import child, located
from ..sources.yearzip import archives
from ..sources.ziparchive import with_content, year_archives, zip_members

MANIFEST = "_consolidation_manifest.json"
_PLACE = {"bytes": "long", "packed_bytes": "long", "method": "int", "crc": "long", "header_offset": "long"}


def hashed_sources(spark: SparkSession, paths: list[str], staged: list[str]) -> DataFrame:
    """A row for each PDF of the archives and the staged folders, with its hash, whether it is a PDF, and where it lies."""
    members = zip_members(spark, paths, to_read=True).filter(F.endswith(F.lower("member"), F.lit(".pdf")))
    files = None
    for rank, root in enumerate(staged):
        some = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="*.[pP][dD][fF]").load(root).select("path")
        year = F.regexp_extract(F.substring("path", len(root), 1 << 30), r"/(\d{4})/", 1).cast("int")
        some = some.select(year.alias("year"), "path", F.lit(rank).alias("root_rank"), *(F.lit(None).cast(t).alias(c) for c, t in _PLACE.items())).filter("year IS NOT NULL")
        files = some if files is None else files.unionByName(some)
    read = with_content(source_refs(members, files).withColumnRenamed("source_path", "archive"))
    return read.select("*", digest(F.col("content")).alias("sha256"), valid_pdf(F.col("content")).alias("valid")).drop("content").withColumnRenamed("archive", "source_path")


def decided(spark: SparkSession, refs: DataFrame, paths: list[str], years: range, dry_run: bool) -> DataFrame:
    """One row a year: its archives, what was found, and what is done with it."""
    own = [(int(basename_of(p)[:4]), basename_of(p)) for p in paths]
    listed = spark.createDataFrame([(y, sorted(n for x, n in own if x == y)) for y in years], "year int, source_archives array<string>")
    found = refs.groupBy("year").agg(
        F.count("*").alias("source_pdf_entries"), F.count_distinct("doc_id").alias("ids"), F.count_if(F.col("kind") == "file").alias("loose"),
        F.count_if(F.col("doc_id").isNull()).alias("unparsed"), F.count_if(~F.col("valid")).alias("invalid"), F.min(F.when(~F.col("valid"), F.col("label"))).alias("first_invalid"),
    )
    all_ = listed.join(found, "year", "left").na.fill(0, ["source_pdf_entries", "ids", "loose", "unparsed", "invalid"])
    own_name = F.array_contains("source_archives", F.concat(F.col("year").cast("string"), F.lit(".zip")))
    action = decision(F.lit(dry_run), F.size("source_archives"), F.col("loose"), F.col("ids"), F.col("unparsed"), own_name)
    return all_.withColumn("action", F.when((F.col("invalid") > 0) & F.lit(not dry_run), "error_invalid_pdf").otherwise(action))


def basename_of(path: str) -> str:
    return path.rpartition("/")[2]


def manifests(facts: DataFrame, refs: DataFrame, named: DataFrame) -> DataFrame:
    """(year, arcname, content) of each year's manifest. A year's aliases are in it, as its format has them."""
    same = aliases(refs, named).groupBy("year").agg(F.array_sort(F.collect_list(F.struct("doc_id", "source_entries", "distinct_content_versions", "output_entries"))).alias("duplicate_aliases"))
    whole = facts.join(dedup_counts(named), "year", "left").join(id_digest(refs.filter("doc_id IS NOT NULL"), ["year"]), "year", "left").join(same, "year", "left")
    merged = F.struct(
        F.lit(1).alias("version"), "year", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("created_at_utc"), "source_archives", "source_pdf_entries",
        F.col("ids").alias("source_unique_doc_ids"), F.col("id_digest").alias("source_doc_ids_sha256"), F.col("output_entries").alias("output_pdf_entries"), F.col("ids").alias("output_unique_doc_ids"),
        F.col("identical_duplicates").alias("identical_duplicate_entries_removed"), F.col("variants").alias("content_variants_preserved"),
        F.coalesce("duplicate_aliases", F.array().cast(same.schema["duplicate_aliases"].dataType)).alias("duplicate_aliases"),
    )
    nothing = F.struct(F.lit(1).alias("version"), "year", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("created_at_utc"), "source_pdf_entries", F.col("ids").alias("unique_doc_ids"))
    text = F.when(F.col("action") == "merged", F.to_json(merged)).otherwise(F.to_json(nothing))
    return whole.select("year", F.concat(F.col("year").cast("string"), F.lit("/" + MANIFEST)).alias("arcname"), F.encode(text, "UTF-8").alias("content"))


def consolidate_archives(spark: SparkSession, folder: str, years: range, staged: list[str] | None = None, backup: str | None = None, dry_run: bool = False) -> DataFrame:
    """Every year of the range as <folder>/<year>.zip; returns one row a year with what was done and its figures.

    A year without sources gets an archive of its manifest alone; one whose only source is a single archive is verified and renamed;
    others are merged: of each id and content the first occurrence, under a name that no other has. An id that isn't
    found, a file that is no PDF, and a merge onto an archive that is itself a source are errors of the whole call.
    Source archives go to `backup` once all is verified, if it is given.
    """
    paths = year_archives(folder, years)
    stored = shared_path(spark, "sources")
    hashed_sources(spark, paths, staged or []).filter(F.col("year").between(years.start, years.stop - 1)).write.parquet(stored)
    refs = spark.read.parquet(stored)
    facts = spark.createDataFrame(decided(spark, refs, paths, years, dry_run).collect(), "year int, source_archives array<string>, source_pdf_entries long, ids long, loose long, unparsed long, invalid long, first_invalid string, action string")
    wrong = facts.filter("action LIKE 'error%'").orderBy("year").collect()
    if wrong:
        raise ValueError("; ".join(f"{r.year}: {r.action} ({r.unparsed} without an id, {r.invalid} no PDF, first {r.first_invalid})" for r in wrong))
    if dry_run:
        return facts
    merged = refs.join(facts.filter("action = 'merged'").select("year"), "year", "left_semi")
    named = shared_path(spark, "named")
    output_names(content_dedup(merged, "sha256")).write.parquet(named)
    entries = spark.read.parquet(named)
    rows = entries.select("year", "arcname", F.lit(None).cast("binary").alias("content"), F.col("source_path").alias("archive"), "member", *_PLACE)
    due = facts.filter("action IN ('merged', 'created_empty')")
    made = manifests(due, merged, entries).select("year", "arcname", "content", *(F.lit(None).cast(t).alias(c) for c, t in ({"archive": "string", "member": "string"} | _PLACE).items()))
    done = archives(rows.unionByName(made), folder, stored=False, manifest="").collect()
    system, root = located(folder)
    for r in facts.filter("action = 'validated_and_renamed'").collect():  # its contents were read and checked above
        if r.source_archives[0] != f"{r.year}.zip":
            system.move(child(root, r.source_archives[0]), child(root, f"{r.year}.zip"))
    report = verified(spark, folder, refs, facts, entries)
    if backup and done:
        system.create_dir(located(backup)[1])
        gone = {n for r in facts.filter("action = 'merged'").collect() for n in r.source_archives}
        for name in sorted(gone):
            system.move(child(root, name), child(located(backup)[1], name))
    for path in (stored, named):
        fs, p = file_system(spark, path)
        fs.delete(p, True)
    return report


def verified(spark: SparkSession, folder: str, refs: DataFrame, facts: DataFrame, entries: DataFrame) -> DataFrame:
    """The report, from the archives as they are now: their ids must be the sources', their PDFs as many as were kept."""
    years = [r.year for r in facts.select("year").collect()]
    now = zip_members(spark, [child(folder, f"{y}.zip") for y in years]).filter(F.endswith(F.lower("member"), F.lit(".pdf")))
    found = now.select("year", doc_id_from_name(F.col("member")).alias("doc_id"))
    check = archive_verification(found, refs.filter("doc_id IS NOT NULL").select("year", "doc_id").distinct())
    out = (
        facts.join(dedup_counts(entries), "year", "left").join(check.select("year", "members", F.col("ids").alias("output_ids"), "missing", "extra"), "year", "left")
        .join(id_digest(refs.filter("doc_id IS NOT NULL"), ["year"]).withColumnRenamed("id_digest", "source_doc_ids_sha256"), "year", "left")
        .join(id_digest(found, ["year"]).withColumnRenamed("id_digest", "output_doc_ids_sha256"), "year", "left")
        .na.fill(0, ["members", "output_ids", "missing", "extra", "identical_duplicates", "variants"])
    )
    out = out.select(
        "year", "action", "source_archives", "source_pdf_entries", F.col("ids").alias("source_unique_doc_ids"), "source_doc_ids_sha256", F.col("members").alias("output_pdf_entries"), F.col("output_ids").alias("output_unique_doc_ids"),
        "output_doc_ids_sha256", F.col("variants").alias("variants_preserved"), F.col("identical_duplicates").alias("identical_duplicate_entries_removed"), F.coalesce("output_entries", "source_pdf_entries").alias("expected_entries"), "missing", "extra",
    )
    rows = out.collect()  # one a year
    wrong = [r for r in rows if r.missing or r.extra or r.output_pdf_entries != r.expected_entries]
    if wrong:
        raise ValueError("; ".join(f"{r.year}: {r.output_pdf_entries} PDFs of {r.expected_entries}, {r.missing} ids missing, {r.extra} more" for r in wrong))
    return spark.createDataFrame(rows, out.schema).drop("expected_entries", "missing", "extra")
