"""Queries that write archives of the given tables, read them back and consolidate them, with their SQL.

Archives lie in the shared folder and go when the result, a row a year or a digest a member, has been taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import doc_id_from_name
from ..operators import delivery as Y
from ..sources.shared import shared_path
from ..sources.storage import child, deleted, removed
from ..sources.yearzip import archives
from ..sources import archiveindex
from ..sources.ziparchive import usable_archives, with_content, year_archives, zip_members
from .consolidation import consolidate_archives
from .queries_text import s, spread, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


YEARS = range(2020, 2024)


def _members(spark, sf_dir) -> DataFrame:
    """A PDF of each document, ids shared by seven, every fifth a second time: year, arcname, content."""
    n = F.col("doc_id")
    d = table(spark, sf_dir, "documents").select(n, "text").withColumn("again", F.explode(F.when(n % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    year = F.lit(2020) + n % 3
    day = F.concat(s(year), F.lit("-03-"), F.lpad(s(n % 28 + 1), 2, "0"))
    ident = F.md5(s(F.floor(n / 7)))
    name = F.concat(s(year), F.lit("/"), F.substring(day, 1, 7), F.lit("/"), day, F.lit("/n"), s(n), F.when(F.col("again") == 1, "b").otherwise(""), F.lit("_"), ident, F.lit(".pdf"))
    return spread(d).select(year.cast("int").alias("year"), name.alias("arcname"), F.encode(F.concat(F.lit("%PDF-"), F.coalesce("text", F.lit(""))), "UTF-8").alias("content"))


_ROWS = "(SELECT 2020 + doc_id % 3 AS year, md5((doc_id // 7)::VARCHAR) AS id, coalesce(text, '') AS text, doc_id FROM documents, range(2) t(again) WHERE again = 0 OR doc_id % 5 = 0)"


@query(f"""SELECT year::INTEGER AS year, 'merged' AS action, 2::BIGINT AS archives, count(*) AS source_pdf_entries, count(DISTINCT id) AS source_unique_doc_ids,
  (SELECT sha256(string_agg(id, chr(10) ORDER BY id)) FROM (SELECT DISTINCT year AS y, id FROM {_ROWS}) WHERE y = r.year) AS source_doc_ids_sha256,
  count(DISTINCT (id, text)) AS output_pdf_entries, count(DISTINCT id) AS output_unique_doc_ids, (SELECT sha256(string_agg(id, chr(10) ORDER BY id)) FROM (SELECT DISTINCT year AS y, id FROM {_ROWS}) WHERE y = r.year) AS output_doc_ids_sha256,
  count(DISTINCT (id, text)) - count(DISTINCT id) AS variants_preserved, count(*) - count(DISTINCT (id, text)) AS identical_duplicate_entries_removed FROM {_ROWS} r GROUP BY year
  UNION ALL SELECT 2023, 'created_empty', 0, 0, 0, NULL, 0, 0, NULL, 0, 0""")
def consolidation_report(spark, sf_dir):
    """Two archives a year are written, consolidated and verified; a year without any gets an empty one."""
    folder = shared_path(spark, "consolidation")
    archives(_members(spark, sf_dir), folder, parts=2).collect()
    rows = consolidate_archives(spark, folder, YEARS, backup=child(folder, "backup")).withColumn("source_archives", F.size("source_archives").cast("long"))
    out = spark.createDataFrame(rows.collect(), rows.schema).withColumnRenamed("source_archives", "archives")  # a row a year
    deleted(folder)
    return out


@query(f"""SELECT year::INTEGER AS year, id AS doc_id, count(*) AS members, sum(strlen(text) + 5)::BIGINT AS bytes, sha256(string_agg(sha256('%PDF-' || text), '' ORDER BY sha256('%PDF-' || text))) AS contents FROM {_ROWS} GROUP BY year, id HAVING year < 2022""")
def archive_members(spark, sf_dir):
    """Members of the written archives by id with their contents; a filter of the year leaves archives unopened."""
    folder, kept = shared_path(spark, "archives"), shared_path(spark, "members")
    archives(_members(spark, sf_dir), folder, stored=False, parts=3).collect()
    members = zip_members(spark, year_archives(folder, repair=False), to_read=True, range_bytes=1 << 14).filter("year < 2022").withColumn("doc_id", doc_id_from_name(F.col("member"))).filter("doc_id IS NOT NULL")
    hashed = with_content(members).select("year", "doc_id", "bytes", F.sha2("content", 256).alias("sha256"))
    hashed.write.parquet(kept)
    deleted(folder)
    out = spark.read.parquet(kept).groupBy("year", "doc_id").agg(F.count("*").alias("members"), F.sum("bytes").alias("bytes"), F.array_sort(F.collect_list("sha256")).alias("all"))
    return out.withColumn("contents", F.sha2(F.array_join("all", ""), 256)).drop("all")


@query(f"""SELECT year::INTEGER AS year, count(*) AS members, count(DISTINCT id) AS ids, 0::BIGINT AS missing, 0::BIGINT AS extra, 2::BIGINT AS archives, count(*) = count(DISTINCT id) AS ok FROM {_ROWS} GROUP BY year""")
def written_archives(spark, sf_dir):
    """What the sink published, verified against the rows that went in."""
    folder = shared_path(spark, "written")
    rows = _members(spark, sf_dir)
    archives(rows, folder, parts=2).collect()
    index = zip_members(spark, year_archives(folder))
    ids, usable = Y.collected_ids(index.withColumn("doc_id", doc_id_from_name(F.col("member"))), usable_archives(index))
    found = index.filter(F.endswith("member", F.lit(".pdf"))).select("year", doc_id_from_name(F.col("member")).alias("doc_id"))
    check = Y.archive_verification(found, rows.select("year", doc_id_from_name(F.col("arcname")).alias("doc_id")).distinct())
    out = check.join(ids.groupBy("year").agg(F.count("*").alias("n")), "year").join(usable, "year").filter("n = ids").select("year", "members", "ids", "missing", "extra", F.size("archives").cast("long").alias("archives"), "ok")
    done = spark.createDataFrame(out.collect(), out.schema)  # a row a year
    deleted(folder)
    return done


@query(f"""WITH r AS (SELECT *, CASE WHEN year = 2020 THEN 0 WHEN year = 2021 THEN 1 ELSE 2 END AS run FROM {_ROWS})
  SELECT 0::INTEGER AS run, 2::BIGINT AS opened, 0::BIGINT AS gone, year::INTEGER AS year, count(*) + 1 AS members, count(DISTINCT id) AS ids FROM r WHERE year < 2022 GROUP BY year
  UNION ALL SELECT 1, 1, 0, year, CASE WHEN year = 2021 THEN count(*) FILTER (doc_id % 2 = 0) ELSE count(*) END + 1, CASE WHEN year = 2021 THEN count(DISTINCT CASE WHEN doc_id % 2 = 0 THEN id END) ELSE count(DISTINCT id) END FROM r WHERE year < 2022 GROUP BY year
  UNION ALL SELECT 2, 1, 1, year, CASE WHEN year = 2021 THEN count(*) FILTER (doc_id % 2 = 0) ELSE count(*) END + 1, CASE WHEN year = 2021 THEN count(DISTINCT CASE WHEN doc_id % 2 = 0 THEN id END) ELSE count(DISTINCT id) END FROM r WHERE year > 2020 GROUP BY year
  UNION ALL SELECT 3, 0, 0, year, CASE WHEN year = 2021 THEN count(*) FILTER (doc_id % 2 = 0) ELSE count(*) END + 1, CASE WHEN year = 2021 THEN count(DISTINCT CASE WHEN doc_id % 2 = 0 THEN id END) ELSE count(DISTINCT id) END FROM r WHERE year > 2020 GROUP BY year""")
def index_by_change(spark, sf_dir):
    """The index after four refreshes: two years are written; one is replaced; one goes and one comes; nothing happens."""
    folder, table_ = shared_path(spark, "changing"), shared_path(spark, "index")
    rows = _members(spark, sf_dir)
    even = F.regexp_extract("arcname", r"/n(\d+)b?_", 1).cast("long") % 2 == 0
    out = None
    for run, put in enumerate((rows.filter("year < 2022"), rows.filter((F.col("year") == 2021) & even), rows.filter("year = 2022"), None)):
        if put is not None:
            archives(put, folder).collect()
        if run == 2:
            removed(child(folder, "2020.zip"))
        changed = archiveindex.refresh(spark, folder, table_)
        now = archiveindex.indexed(spark, table_).withColumn("doc_id", doc_id_from_name(F.col("member")))
        now = now.groupBy("year").agg(F.count("*").alias("members"), F.count_distinct("doc_id").alias("ids"))
        now = now.select(F.lit(run).alias("run"), F.lit(len(changed["opened"])).cast("long").alias("opened"), F.lit(len(changed["gone"])).cast("long").alias("gone"), "*")
        got = spark.createDataFrame(now.collect(), now.schema)  # a row a year
        out = got if out is None else out.unionByName(got)
    deleted(folder)
    deleted(table_)
    return out


@query("""SELECT run::INTEGER AS run, (2000 + c_custkey % 3)::INTEGER AS year, (run = 0 AND c_custkey % 3 < 2) OR (run = 1 AND c_custkey % 3 = 2) AS built, count(*) AS rows_written, count(*) * 2 AS entries,
  sha256(string_agg(md5(c_custkey::VARCHAR), chr(10) ORDER BY md5(c_custkey::VARCHAR))) AS id_digest FROM customer, range(3) t(run) WHERE run > 0 OR c_custkey % 3 < 2 GROUP BY 1, 2, 3""")
def incremental_build(spark, sf_dir):
    """Two years are due, then one more, then none; tables as their published builds have them."""
    from ..operators.consolidate import id_digest
    from . import incremental as B

    k = F.col("c_custkey")
    card = F.concat(F.lit("I. Name\n"), F.col("c_name"), F.lit("\nII. Segment\n"), F.col("c_mktsegment"))
    c = table(spark, sf_dir, "customer").select((F.lit(2000) + k % 3).cast("int").alias("year"), F.md5(s(k)).alias("doc_id"), F.explode(F.array(F.lit(""), F.lit("(1)"))).alias("copy"), card.alias("text"))
    variants = spread(c).select("year", "doc_id", F.concat(s("year"), F.lit("/x_"), "doc_id", "copy", F.lit(".pdf")).alias("member"), "text", F.lit(None).cast("string").alias("error"))
    root, out = shared_path(spark, "builds"), None
    for run, last in enumerate((2001, 2002, 2002)):
        due = spark.createDataFrame([(y, f"{y}.zip") for y in range(2000, last + 1)], "year int, archive string")
        built = B.build_due(spark, variants, due, root)
        told = B.reports(spark, root).select("year", "rows_written", F.col("archive_pdf_entries").alias("entries")).join(id_digest(B.records(spark, root), ["year"]), "year")
        told = told.select(F.lit(run).alias("run"), F.col("year").isin(built).alias("built"), "*") if built else told.select(F.lit(run).alias("run"), F.lit(False).alias("built"), "*")
        got = spark.createDataFrame(told.collect(), told.schema)  # a row a year
        out = got if out is None else out.unionByName(got)
    deleted(root)
    return out
