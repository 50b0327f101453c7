"""Queries of variants, consolidation, reconciliation, audits and intake over the synthetic tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import consolidate as C
from ..operators import delivery as Y
from ..operators import duplicates as D
from ..operators import reconcile as R
from ..operators import validate as V
from ..operators import variants as W
from ..sources import sinks as K
from ..sources.shared import shared_path
from ..streaming import intake as T
from .build import delivery_checks
from .queries_text import MEMBER, _card, member_name, s, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- variants


def _scored(spark, sf_dir) -> DataFrame:
    """Documents as variants of the document that their text is, with a quality of their columns."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.md5("text").alias("id"), "doc_id", "source", "lang", F.length("text").cast("long").alias("chars"), F.struct((F.col("lang") == "en").cast("int").alias("a"), (F.col("doc_id") % 3).alias("b"), F.length("text").alias("c")).alias("quality"), member_name().alias("member"))


_SCORED = f"(SELECT md5(text) AS id, doc_id, source, lang, length(text) AS chars, CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS a, doc_id % 3 AS b, {MEMBER} AS member FROM documents)"


@query(f"SELECT id, doc_id, source, chars, member FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY a DESC, b DESC, chars DESC, member DESC) AS r FROM {_SCORED}) WHERE r = 1")
def best_variant(spark, sf_dir):
    """W1."""
    return W.best_variant(_scored(spark, sf_dir), ["id"], F.col("quality"), F.col("member")).select("id", "doc_id", "source", "chars", "member")


@query(f"SELECT id, doc_id, member FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY member) AS r FROM {_SCORED}) WHERE r = 1")
def first_variant(spark, sf_dir):
    """W3, S6, S14."""
    return W.first_variant(_scored(spark, sf_dir), ["id"], F.col("member")).select("id", "doc_id", "member")


@query("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, greatest(1, count(*) OVER (PARTITION BY source) // 7) AS step FROM documents) WHERE i % step = 0 AND i < 7 * step")
def even_sample(spark, sf_dir):
    """W6, by source."""
    return W.even_sample(table(spark, sf_dir, "documents").select("source", "doc_id"), 7, "doc_id", ["source"])


@query("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents) WHERE i % greatest(1, n // 70) = 0 AND i < 70 * greatest(1, n // 70)")
def even_sample_all(spark, sf_dir):
    """W6 over all rows."""
    return W.even_sample(table(spark, sf_dir, "documents").select("source", "doc_id"), 70, "doc_id")


_QUALITY = """(SELECT doc_id, lang, quality, CASE WHEN doc_id % 4 = 0 THEN '' ELSE '0222U' || doc_id END AS registration_number, CASE WHEN doc_id % 5 = 0 THEN '' WHEN doc_id % 5 = 1 THEN 'other' ELSE '0222U' || doc_id END AS from_name,
  CASE WHEN doc_id % 6 = 0 THEN NULL ELSE lang END AS title_uk, doc_id % 11 AS sections FROM documents JOIN labels USING (doc_id))"""
_MATCH = "CASE WHEN registration_number = '' OR from_name = '' THEN 'unknown' WHEN registration_number = from_name THEN 'yes' ELSE 'no' END"
_WARN = f"array_to_string(list_filter([CASE WHEN registration_number = '' OR title_uk IS NULL THEN 'missing_critical_fields' END, CASE WHEN sections < 6 THEN 'few_nonempty_sections' END, CASE WHEN {_MATCH} = 'no' THEN 'registration_number_mismatch' END], lambda x: x IS NOT NULL), ';')"


@query(f"SELECT doc_id, {_MATCH} AS matches, array_to_string(list_filter([CASE WHEN registration_number = '' THEN 'registration_number' END, CASE WHEN title_uk IS NULL THEN 'title_uk' END], lambda x: x IS NOT NULL), ';') AS missing, {_WARN} AS warnings FROM {_QUALITY}")
def quality_status(spark, sf_dir):
    """P3, P6, P7."""
    q = _quality(spark, sf_dir)
    return q.select("doc_id", "matches", F.array_join("missing", ";").alias("missing"), F.array_join("warned", ";").alias("warnings"))


def _quality(spark, sf_dir) -> DataFrame:
    n = F.col("doc_id")
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").select(
        "doc_id", "lang", "quality", F.when(n % 4 == 0, "").otherwise(F.concat(F.lit("0222U"), s("doc_id"))).alias("registration_number"),
        F.when(n % 5 == 0, "").when(n % 5 == 1, "other").otherwise(F.concat(F.lit("0222U"), s("doc_id"))).alias("from_name"), F.when(n % 6 == 0, None).otherwise(F.col("lang")).alias("title_uk"), (n % 11).alias("sections"),
    )
    d = d.withColumns({"missing": W.missing_fields(["registration_number", "title_uk"]), "matches": W.registration_match(F.col("registration_number"), F.col("from_name"))})
    return d.withColumn("warned", W.warnings(F.col("missing"), F.col("sections"), F.col("matches")))


def _records(spark, sf_dir) -> DataFrame:
    q = _quality(spark, sf_dir)
    failed = (F.col("quality") == 0) & (F.col("doc_id") % 2 == 0)
    return q.select(
        (2000 + F.col("doc_id") % 9).cast("int").alias("year"), s("doc_id").alias("doc_id"), "registration_number", F.col("lang").alias("source_member"), F.when(failed, "failed").when(F.size("warned") > 0, "warning").otherwise("ok").alias("extraction_status"),
        F.array_join("warned", ";").alias("quality_warnings"), F.array_join("missing", ";").alias("missing_critical_fields"), F.when(failed, "damaged").otherwise("").alias("extraction_error"),
        F.col("matches").alias("registration_number_matches_filename"), (F.col("doc_id") % 3 + 1).cast("int").alias("pdf_variant_count"),
    )


_RECORDS = f"""(SELECT (2000 + doc_id % 9)::INTEGER AS year, doc_id::VARCHAR AS doc_id, registration_number, lang AS source_member, CASE WHEN quality = 0 AND doc_id % 2 = 0 THEN 'failed' WHEN {_WARN} <> '' THEN 'warning' ELSE 'ok' END AS extraction_status, {_WARN} AS quality_warnings,
  array_to_string(list_filter([CASE WHEN registration_number = '' THEN 'registration_number' END, CASE WHEN title_uk IS NULL THEN 'title_uk' END], lambda x: x IS NOT NULL), ';') AS missing_critical_fields,
  CASE WHEN quality = 0 AND doc_id % 2 = 0 THEN 'damaged' ELSE '' END AS extraction_error, {_MATCH} AS m, doc_id % 3 + 1 AS v FROM {_QUALITY})"""
_ANNUAL = "sum(v)::BIGINT AS archive_pdf_entries, count(*)::BIGINT AS archive_unique_doc_ids, sum(v - 1)::BIGINT AS extra_variants, count(*) FILTER (extraction_status = 'ok') AS ok, count(*) FILTER (extraction_status = 'warning') AS warning, count(*) FILTER (extraction_status = 'failed') AS failed, count(*) FILTER (m = 'no') AS registration_mismatches"


@query(f"SELECT year, {_ANNUAL} FROM {_RECORDS} GROUP BY year")
def annual_status(spark, sf_dir):
    """A1, A2."""
    return W.status_counts(_records(spark, sf_dir))


@query(f"SELECT year, {_ANNUAL}, count(DISTINCT year)::BIGINT AS years FROM {_RECORDS} GROUP BY ROLLUP (year)")
def grand_totals(spark, sf_dir):
    """A3."""
    return W.totals(W.status_counts(_records(spark, sf_dir)))


@query(f"SELECT year, 'a' || year AS archive, archive_pdf_entries, archive_unique_doc_ids, extra_variants, archive_unique_doc_ids AS rows_written, ok, warning, failed, registration_mismatches, 'c' || year AS csv FROM (SELECT year, {_ANNUAL} FROM {_RECORDS} GROUP BY year)")
def manifest(spark, sf_dir):
    """K2, K4."""
    a = W.status_counts(_records(spark, sf_dir))
    return K.manifest(a.withColumns({"rows_written": F.col("archive_unique_doc_ids"), "archive": F.concat(F.lit("a"), s("year")), "csv": F.concat(F.lit("c"), s("year"))}))


@query(f"SELECT year, doc_id, registration_number, source_member, extraction_status, quality_warnings, missing_critical_fields, extraction_error FROM {_RECORDS} WHERE extraction_status <> 'ok'")
def quality_issues(spark, sf_dir):
    """K5, P2."""
    return K.quality_issues(_records(spark, sf_dir))


# --- consolidation


def _refs(spark, sf_dir) -> DataFrame:
    n = F.col("doc_id")
    member = F.concat(F.lit("2022/"), F.when(n % 4 == 0, "").otherwise(F.concat(F.lit("2022-03-0"), s(n % 4))), F.lit("/card_"), F.md5(s(F.length("text") % 300)), F.lit(".pdf"))
    d = table(spark, sf_dir, "documents")
    return C.source_refs(d.select(F.lit(2022).alias("year"), F.concat(F.lit("/a/2022-"), s(n % 3), F.lit(".zip")).alias("archive"), (n % 3).alias("archive_rank"), n.alias("member_index"), member.alias("member"), F.encode("text", "UTF-8").alias("content")))


_REFS = """(SELECT md5((length(text) % 300)::VARCHAR) AS doc_id, sha256(text) AS sha256, doc_id % 3 AS rank, doc_id AS place, CASE WHEN doc_id % 4 <> 0 THEN '2022-03-0' || doc_id % 4 END AS date,
  '2022-' || doc_id % 3 || '.zip!2022/' || CASE WHEN doc_id % 4 = 0 THEN '' ELSE '2022-03-0' || doc_id % 4 END || '/card_' || md5((length(text) % 300)::VARCHAR) || '.pdf' AS label FROM documents)"""
_KEPT = f"(SELECT *, row_number() OVER (PARTITION BY doc_id, sha256 ORDER BY rank, place) AS r, count(*) OVER (PARTITION BY doc_id, sha256) AS copies FROM {_REFS} QUALIFY r = 1)"
_NAMED = f"(SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY rank, place) AS version FROM {_KEPT})"


@query(f"SELECT doc_id, sha256, copies::BIGINT AS copies, label FROM {_KEPT}")
def content_dedup(spark, sf_dir):
    """A5, S9, F8."""
    return C.content_dedup(_refs(spark, sf_dir)).select("doc_id", "sha256", "copies", "label")


@query(f"SELECT 2022 AS year, sum(copies)::BIGINT AS source_entries, count(*)::BIGINT AS output_entries, sum(copies - 1)::BIGINT AS identical_duplicates, count(*) - count(DISTINCT doc_id) AS variants FROM {_KEPT}")
def dedup_counts(spark, sf_dir):
    """A5."""
    return C.dedup_counts(C.content_dedup(_refs(spark, sf_dir)))


@query(f"""SELECT doc_id, version::BIGINT AS version, CASE WHEN date IS NULL THEN '2022/_undated' ELSE '2022/2022-03/' || date END || CASE WHEN version = 1 THEN '/' ELSE '/_variants/' || doc_id || '/' || version || '_' END
  || CASE WHEN k = 1 THEN '' WHEN k = 2 THEN doc_id || '_' ELSE doc_id || '_' || k - 1 || '_' END || 'card_' || doc_id || '.pdf' AS arcname FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, date ORDER BY version) AS k FROM {_NAMED})""")
def output_names(spark, sf_dir):
    """W7, W8, F6."""
    return C.output_names(C.content_dedup(_refs(spark, sf_dir))).select("doc_id", F.col("version").cast("long").alias("version"), "arcname")


@query(f"SELECT doc_id, count(DISTINCT sha256) AS versions, string_agg(label, ';' ORDER BY rank, place) AS labels FROM {_REFS} GROUP BY doc_id HAVING count(*) > 1")
def aliases(spark, sf_dir):
    """A6."""
    r = _refs(spark, sf_dir)
    a = C.aliases(r, C.output_names(C.content_dedup(r)))
    return a.select("doc_id", F.col("distinct_content_versions").alias("versions"), F.array_join("source_entries", ";").alias("labels"))


@query("SELECT source, sha256(string_agg(id, chr(10) ORDER BY id)) AS id_digest FROM (SELECT DISTINCT source, md5(text) AS id FROM documents) GROUP BY source")
def id_digest(spark, sf_dir):
    """A7."""
    return C.id_digest(table(spark, sf_dir, "documents").select("source", F.md5("text").alias("doc_id")), ["source"])


@query("""SELECT o_orderkey, CASE WHEN a = 0 THEN 'counted' WHEN b = 0 THEN 'error_no_doc_id' WHEN c = 0 AND e = 0 THEN 'created_empty' WHEN c = 1 AND d = 0 THEN 'validated_and_renamed' WHEN f = 0 THEN 'error_target_exists' ELSE 'merged' END AS action
  FROM (SELECT o_orderkey, o_orderkey % 13 AS a, o_orderkey % 11 AS b, o_orderkey % 3 AS c, o_orderkey % 2 AS d, o_orderkey % 4 AS e, o_orderkey % 7 AS f FROM orders)""")
def consolidation_decision(spark, sf_dir):
    """The decision table of a year's consolidation."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", C.decision(k % 13 == 0, k % 3, k % 2, k % 4, F.when(k % 11 == 0, 1).otherwise(0), k % 7 == 0).alias("action"))


# --- reconciliation: customers are announced, orders' customers collected


def _flags(spark, sf_dir) -> DataFrame:
    year = lambda c: (2000 + c % 5).cast("int").alias("year")
    c = table(spark, sf_dir, "customer").select(year(F.col("c_custkey")), s("c_custkey").alias("doc_id"), F.col("c_custkey").alias("k"), "c_nationkey")
    o = table(spark, sf_dir, "orders").filter("o_custkey % 7 <> 0").select(year(F.col("o_custkey")), s("o_custkey").alias("doc_id"), F.col("o_custkey").alias("k"))
    extra = o.filter("k % 17 = 0").withColumn("doc_id", F.concat(F.lit("X"), "doc_id"))
    pdf = o.unionByName(extra)
    return R.flagged_ids(site=c, archive=pdf, no_pdf=c.filter("k % 7 = 0 AND k % 2 = 0 OR year = 2003 AND k % 23 = 0"), server500=c.filter("k % 7 = 0 AND k % 4 <> 2 AND NOT (year = 2003 AND k % 4 = 3)"), table=pdf.filter("k % 19 <> 0"))


_FLAGS = """(SELECT year, doc_id, bool_or(t = 1) AS site, bool_or(t = 2) AS archive, bool_or(t = 3) AS no_pdf, bool_or(t = 4) AS server500, bool_or(t = 5) AS tab FROM (
  SELECT 2000 + c_custkey % 5 AS year, c_custkey::VARCHAR AS doc_id, 1 AS t FROM customer
  UNION ALL SELECT 2000 + c_custkey % 5, c_custkey::VARCHAR, 3 FROM customer WHERE c_custkey % 7 = 0 AND c_custkey % 2 = 0 OR c_custkey % 5 = 3 AND c_custkey % 23 = 0
  UNION ALL SELECT 2000 + c_custkey % 5, c_custkey::VARCHAR, 4 FROM customer WHERE c_custkey % 7 = 0 AND c_custkey % 4 <> 2 AND NOT (c_custkey % 5 = 3 AND c_custkey % 4 = 3)
  UNION ALL SELECT 2000 + o_custkey % 5, o_custkey::VARCHAR, t FROM orders, (VALUES (2), (5)) v(t) WHERE o_custkey % 7 <> 0 AND (t = 2 OR o_custkey % 19 <> 0)
  UNION ALL SELECT 2000 + o_custkey % 5, 'x' || o_custkey, t FROM orders, (VALUES (2), (5)) v(t) WHERE o_custkey % 7 <> 0 AND o_custkey % 17 = 0 AND (t = 2 OR o_custkey % 19 <> 0)) GROUP BY 1, 2)"""


@query(f"SELECT year::INTEGER AS year, doc_id, site, archive, no_pdf, server500, tab AS \"table\" FROM {_FLAGS}")
def flagged_ids(spark, sf_dir):
    """J1 to J5, U1 to U5 in one pass."""
    return _flags(spark, sf_dir)


def _set_query(name: str, inside: list[str], outside: list[str], doc: str):
    where = " AND ".join([x.replace("table", "tab") for x in inside] + [f"NOT {x.replace('table', 'tab')}" for x in outside])

    def f(spark, sf_dir):
        return R.only_in(_flags(spark, sf_dir), inside, outside)

    f.__name__, f.__doc__ = name, doc
    query(f"SELECT year::INTEGER AS year, doc_id FROM {_FLAGS} WHERE {where}")(f)


_set_query("semi_current", ["archive", "site"], [], "J1.")
_set_query("anti_extras", ["archive"], ["site"], "J2, J13.")
_set_query("anti_missing", ["site"], ["archive"], "J2.")
_set_query("missing_known", ["site", "no_pdf"], ["archive"], "J3.")
_set_query("unexplained", ["site"], ["archive", "no_pdf", "server500"], "J4, J9.")


@query(f"SELECT year::INTEGER AS year, doc_id FROM {_FLAGS} WHERE (no_pdf OR server500) AND NOT (site AND NOT archive)")
def errors_not_missing(spark, sf_dir):
    """J5."""
    return _flags(spark, sf_dir).filter("(no_pdf OR server500) AND NOT (site AND NOT archive)").select("year", "doc_id")


_set_query("overlap", ["no_pdf", "server500"], [], "U5.")
_set_query("not_tabulated", ["archive"], ["table"], "U3, U4.")


@query(f"SELECT year::INTEGER AS year, count(*) FILTER (tab <> archive) AS mismatches, bool_and(tab = archive) AS equal FROM {_FLAGS} GROUP BY 1")
def set_equality(spark, sf_dir):
    """U4."""
    return _flags(spark, sf_dir).groupBy("year").agg(F.count_if(F.col("table") != F.col("archive")).alias("mismatches"), F.bool_and(F.col("table") == F.col("archive")).alias("equal"))


def _accounts(spark, sf_dir) -> DataFrame:
    f = _flags(spark, sf_dir)
    entries = f.groupBy("year").agg((F.count_if("archive") + F.lit(3)).alias("physical"), F.lit(0).cast("long").alias("unparsed"))
    tab = f.filter("table").groupBy("year").agg(F.count("*").alias("rows"), F.lit(2).cast("long").alias("warnings"), F.lit(0).cast("long").alias("failures"), F.lit(0).cast("long").alias("duplicates"))
    gaps = f.filter("site AND doc_id LIKE '%77'").select("year", F.concat(F.lit("d"), "doc_id").alias("day"), F.lit(2).cast("long").alias("gap"))
    reports = f.select("year").distinct().select("year", F.when(F.col("year") % 2 == 0, F.lit(250)).cast("long").alias("annual_site_total"), F.lit("then").alias("checked_at_utc"), F.lit(300).cast("long").alias("daily_ids"))
    return R.annual_accounts(f, entries, tab, gaps, reports)


_ACCOUNTS = f"""(WITH i AS (SELECT year, count(*) FILTER (site) AS site_ids, count(*) FILTER (archive) AS u, count(*) FILTER (site AND archive) AS cur, count(*) FILTER (archive AND NOT site) AS ext, count(*) FILTER (site AND NOT archive AND no_pdf) AS np, count(*) FILTER (site AND NOT archive AND server500) AS er,
    count(*) FILTER (site AND NOT archive AND NOT no_pdf AND NOT server500) AS un, count(*) FILTER ((no_pdf OR server500) AND NOT (site AND NOT archive)) AS enm, count(*) FILTER (no_pdf AND server500) AS ov, count(*) FILTER (tab) AS t, count(*) FILTER (tab <> archive) AS tm,
    coalesce(sum(2) FILTER (site AND doc_id LIKE '%77'), 0)::BIGINT AS gap, coalesce(string_agg('d' || doc_id || ': +2', '; ' ORDER BY 'd' || doc_id) FILTER (site AND doc_id LIKE '%77'), '') AS gd FROM {_FLAGS} GROUP BY year),
  a AS (SELECT *, CASE WHEN year % 2 = 0 THEN 250 ELSE site_ids + gap END AS sp, cur + np + er + gap AS acc FROM i)
  SELECT year::INTEGER AS year, sp::BIGINT AS site_publications, CASE WHEN year % 2 = 0 THEN 'annual_site_total' ELSE 'daily_site_doc_ids_plus_persistent_listing_gaps' END AS site_count_basis, 'then' AS site_checked_at_utc, u + 3 AS archive_pdf_entries, u AS archive_unique_pdf_doc_ids,
    cur AS pdf_doc_ids_in_current_site_year, ext AS archive_pdf_doc_ids_outside_current_site_year, np AS known_no_pdf_doc_ids, er AS known_http_500_doc_ids, gap AS known_listing_gap_without_doc_id, gd AS listing_gap_details, acc AS accounted_site_publications, acc - sp AS site_accounting_difference,
    t AS final_table_rows, t AS final_table_unique_doc_ids, 2::BIGINT AS final_table_warning_rows, 0::BIGINT AS final_table_failed_rows, t - u AS table_archive_difference, tm = 0 AS table_doc_ids_exactly_match_archive, acc = sp AND un = 0 AND enm = 0 AND ov = 0 AND site_ids = 300 AS website_accounting_ok,
    CASE WHEN acc <> sp OR un > 0 OR enm > 0 OR ov > 0 OR tm > 0 THEN 'FAIL' WHEN np + er + gap + ext > 0 THEN 'PASS_WITH_KNOWN_EXCEPTIONS' ELSE 'PASS' END AS audit_status FROM a)"""


@query(f"SELECT * FROM {_ACCOUNTS}")
def annual_accounting(spark, sf_dir):
    """A10."""
    return _accounts(spark, sf_dir)


@query(f"SELECT count(*) AS years, sum(archive_unique_pdf_doc_ids)::BIGINT AS unique_ids, sum(accounted_site_publications)::BIGINT AS accounted, count(*) FILTER (audit_status = 'FAIL') AS fail, bool_and(website_accounting_ok) AS all_websites_ok, bool_and(table_doc_ids_exactly_match_archive) AS all_tables_match FROM {_ACCOUNTS}")
def accounting_totals(spark, sf_dir):
    """A11."""
    return R.account_totals(_accounts(spark, sf_dir)).select("years", F.col("archive_unique_pdf_doc_ids").alias("unique_ids"), F.col("accounted_site_publications").alias("accounted"), "fail", "all_websites_ok", "all_tables_match")


@query(f"""SELECT sum(pdf_doc_ids_in_current_site_year + known_no_pdf_doc_ids + known_http_500_doc_ids + known_listing_gap_without_doc_id) = sum(site_publications) AS website_accounting, sum(pdf_doc_ids_in_current_site_year + archive_pdf_doc_ids_outside_current_site_year) = sum(archive_unique_pdf_doc_ids) AS archive_accounting,
  sum(archive_unique_pdf_doc_ids) + 15 = sum(archive_pdf_entries) AS physical_pdf_accounting, sum(archive_unique_pdf_doc_ids) = sum(final_table_rows) AS pdf_to_table_rows, sum(archive_unique_pdf_doc_ids) = sum(final_table_unique_doc_ids) AS pdf_to_table_unique_ids, true AS duplicate_audit_resolved,
  sum(pdf_doc_ids_in_current_site_year)::DOUBLE / sum(site_publications) AS collection_rate FROM {_ACCOUNTS}""")
def control_equalities(spark, sf_dir):
    """A16, A17, A23."""
    zero = [F.lit(0).cast("long").alias(c) for c in ("different_publication_collisions", "unresolved_groups", "table_selection_mismatches")]
    dup = spark.range(1).select(F.lit(20).alias("variant_files"), F.lit(5).alias("duplicate_groups"), *zero)
    return delivery_checks(R.account_totals(_accounts(spark, sf_dir)), dup)


# --- logs and days: events are lines of an error log


def _log(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    ident = F.when(F.col("event_id") % 5 == 0, "-").otherwise(F.upper(F.md5(s("user_id"))))
    n = F.col("event_id")
    reason = F.when(F.col("event_type") == "click", F.concat(F.lit("Сайт объявил "), s(n % 50), F.lit(", собрано уникальных doc_id "), s(n % 47))).when(F.col("event_type") == "error", "500 Server Error: Internal Server Error for url").otherwise("timeout")
    status = F.when(F.col("event_type") == "click", "count_mismatch").when(F.col("event_type") == "error", "fail").when(F.col("event_type") == "view", "notpdf").otherwise(F.col("event_type"))
    lines = e.select(F.year("ts").alias("year"), n.alias("line_no"), F.concat_ws(" | ", s(F.date_format("ts", "HH:mm:ss")), F.date_format("ts", "yyyy-MM-dd"), status, F.lit("-"), ident, reason, F.lit("u")).alias("value"))
    return R.error_log(lines)


_LOG = """(SELECT year(ts)::INTEGER AS year, event_id AS n, strftime(ts, '%Y-%m-%d') AS day, CASE event_type WHEN 'click' THEN 'count_mismatch' WHEN 'error' THEN 'fail' WHEN 'view' THEN 'notpdf' ELSE event_type END AS status,
  CASE WHEN event_id % 5 = 0 THEN '-' ELSE md5(user_id::VARCHAR) END AS id, event_type FROM events)"""


@query(f"SELECT year, status, count(*) AS lines FROM {_LOG} GROUP BY 1, 2")
def log_status_counts(spark, sf_dir):
    """A14, S23."""
    return R.log_statistics(_log(spark, sf_dir))


@query(f"SELECT year, day, string_agg(DISTINCT status, ',' ORDER BY status) AS statuses FROM {_LOG} GROUP BY 1, 2")
def day_statuses(spark, sf_dir):
    """A14."""
    return R.day_statuses(_log(spark, sf_dir)).select("year", "day", F.array_join("statuses", ",").alias("statuses"))


@query(f"SELECT year, day, arg_max(greatest(0, n % 50 - n % 47), n) FILTER (event_type = 'click')::BIGINT AS gap FROM {_LOG} GROUP BY 1, 2")
def gap_last_wins(spark, sf_dir):
    """A day without a line that tells a gap has none."""
    log = _log(spark, sf_dir)
    return R.listing_gaps(log, log.select("year", "day"))


@query(f"SELECT DISTINCT year, id AS doc_id FROM {_LOG} WHERE event_type = 'error' AND id <> '-'")
def server_500_ids(spark, sf_dir):
    """A19, F21."""
    return R.server_500_ids(_log(spark, sf_dir))


_DAYS = f"""(SELECT year, day, coalesce(string_agg(DISTINCT id, ',' ORDER BY id) FILTER (event_type = 'error' AND id <> '-'), '') AS e, coalesce(string_agg(DISTINCT id, ',' ORDER BY id) FILTER (event_type = 'view' AND id <> '-'), '') AS np,
  coalesce(string_agg(DISTINCT status, ',' ORDER BY status) FILTER (NOT (event_type IN ('error', 'view') AND id <> '-')), '') AS other FROM {_LOG} GROUP BY 1, 2)"""


@query(f"SELECT year, day, e AS server500, np AS no_pdf, other FROM {_DAYS} WHERE e <> ''")
def server_500_days(spark, sf_dir):
    """A20."""
    d = R.server_500_days(_log(spark, sf_dir))
    return d.select("year", "day", F.array_join("server500_doc_ids", ",").alias("server500"), F.array_join("no_pdf_doc_ids", ",").alias("no_pdf"), F.array_join("additional_statuses", ",").alias("other"))


@query(f"SELECT year, day, (SELECT string_agg(DISTINCT id, ',' ORDER BY id) FROM {_LOG} l WHERE l.day = d.day AND l.event_type IN ('error', 'view') AND id <> '-') AS ids FROM {_DAYS} d WHERE e <> '' AND right(day, 1) <> '3'")
def legacy_days(spark, sf_dir):
    """J11, T7."""
    log = _log(spark, sf_dir)
    state = log.filter(F.endswith("day", F.lit("3"))).select("year", "day").distinct()
    none = state.select("year", "day", F.expr("CAST(array() AS array<string>)").alias("doc_ids"))
    return R.legacy_days(R.server_500_days(log), state, none).select("year", "day", F.array_join("doc_ids", ",").alias("ids"))


@query("SELECT 2000 + user_id % 3 AS year, md5(user_id::VARCHAR) AS doc_id, string_agg(DISTINCT strftime(ts, '%Y-%m-%d'), ';' ORDER BY strftime(ts, '%Y-%m-%d')) AS days FROM events GROUP BY 1, 2")
def register_dates(spark, sf_dir):
    """A15, O5."""
    state = table(spark, sf_dir, "events").select((2000 + F.col("user_id") % 3).alias("year"), F.date_format("ts", "yyyy-MM-dd").alias("day"), F.array(F.upper(F.md5(s("user_id")))).alias("ids"))
    return R.register(state, "ids")


@query("SELECT y::INTEGER AS year, strftime(d, '%Y-%m-%d') AS day FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders), range(make_timestamp(y, 1, 1, 0, 0, 0), make_timestamp(y + 1, 1, 1, 0, 0, 0), INTERVAL 1 DAY) t(d) WHERE strftime(d, '%Y-%m-%d') NOT IN (SELECT strftime(o_orderdate, '%Y-%m-%d') FROM orders WHERE o_orderstatus = 'F')")
def unfinished_dates(spark, sf_dir):
    """F12, J15, P10, T4."""
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderstatus")
    return T.unfinished(o.select("year").distinct(), o.filter("o_orderstatus = 'F'"))


def _pages(spark, sf_dir) -> DataFrame:
    """Pages of two cards: an order's lines are a day's listing; orders divisible by 9 announce one too many, by 10 repeat their first page."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set(s("l_partkey"))).alias("ids"))
    k = F.col("l_orderkey")
    n = F.size("ids")
    card = lambda x: F.struct(F.lit("r").alias("registration"), F.lit("d").alias("detail_url"), F.lit("p").alias("pdf_url"), F.lit("t").alias("title"), x.alias("doc_id"))
    last = F.ceil(n / 2).cast("int")
    again = k % 10 == 0
    own = F.slice("ids", F.when(again & (F.col("page") == last), 1).otherwise(F.col("page") * 2 - 1), F.lit(2))
    p = li.select((2000 + k % 3).cast("int").alias("year"), s("l_orderkey").alias("day"), "ids", n.alias("n"), F.explode(F.sequence(F.lit(1), last)).alias("page"), k.alias("k"), last.alias("last"))
    own = F.slice("ids", F.when((F.col("k") % 10 == 0) & (F.col("page") == F.col("last")), 1).otherwise(F.col("page") * 2 - 1), F.lit(2))
    return p.select("year", "day", "page", (F.col("n") + F.when(F.col("k") % 9 == 0, 1).otherwise(0)).cast("long").alias("total"), F.transform(own, card).alias("cards"), F.lit(True).alias("accepted"))


_ORDER_IDS = "(SELECT l_orderkey AS k, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY 1)"


@query(f"""WITH d AS (SELECT k, n, n + CASE WHEN k % 9 = 0 THEN 1 ELSE 0 END AS announced, CASE WHEN k % 10 = 0 AND n > 2 THEN (ceil(n / 2.0)::BIGINT - 1) * 2 ELSE n END AS listed, ceil(n / 2.0)::BIGINT AS last_page FROM {_ORDER_IDS})
  SELECT (2000 + k % 3)::INTEGER AS year, k::VARCHAR AS day, announced::BIGINT AS announced, listed::BIGINT AS listed, concat_ws(',', CASE WHEN k % 10 = 0 AND n > 2 AND last_page <= greatest(1, ceil(announced / least(n, 2.0))) THEN 'page_repeat' END, CASE WHEN announced <> listed THEN 'count_mismatch' END) AS errors,
    announced = listed AND NOT (k % 10 = 0 AND n > 2) AND k % 13 <> 0 AS complete FROM d""")
def day_completion(spark, sf_dir):
    """T1 to T3, A18."""
    p = _pages(spark, sf_dir)
    out = T.distinct_items(p).select("year", "day", "doc_id", F.when(F.col("day").cast("long") % 13 == 0, "fail").otherwise("ok").alias("status"))
    return T.day_completion(p, out).select("year", "day", "announced", "listed", F.array_join("errors", ",").alias("errors"), "complete")


@query(f"""SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 'skip' WHEN c IN (404, 410) THEN 'notpdf' WHEN c = 500 THEN 'server500' WHEN c IS NULL OR c >= 400 THEN CASE WHEN a THEN 'fail' ELSE 'retry' END
  WHEN event_type = 'view' THEN CASE WHEN a THEN 'empty' ELSE 'retry' END WHEN event_type = 'click' THEN CASE WHEN a THEN 'fail' ELSE 'retry' END ELSE 'ok' END AS status
  FROM (SELECT event_id, event_type, event_id % 3 >= 2 AS a, CASE event_id % 9 WHEN 0 THEN 404 WHEN 1 THEN 410 WHEN 2 THEN 500 WHEN 3 THEN NULL WHEN 4 THEN 503 ELSE 200 END AS c FROM events)""")
def response_classify(spark, sf_dir):
    """T5, S28, F9."""
    n = F.col("event_id")
    code = F.when(n % 9 == 0, 404).when(n % 9 == 1, 410).when(n % 9 == 2, 500).when(n % 9 == 3, None).when(n % 9 == 4, 503).otherwise(200)
    body = F.when(F.col("event_type") == "view", F.lit(b"")).when(F.col("event_type") == "click", F.lit(b"<html>")).otherwise(F.lit(b"%PDF-1.7"))
    return table(spark, sf_dir, "events").select("event_id", T.response_status(code, body, n % 3, F.lit(3), n % 17 == 0).alias("status"))


@query("SELECT (2000 + c_custkey % 5)::INTEGER AS year, c_custkey::VARCHAR AS doc_id, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_custkey % 7 <> 0) THEN 'available' WHEN c_custkey % 2 = 0 THEN 'server500' ELSE 'fetch' END AS route FROM customer")
def partition_items(spark, sf_dir):
    """J10, T6."""
    year = lambda c: (2000 + F.col(c) % 5).cast("int").alias("year")
    c = table(spark, sf_dir, "customer").select(year("c_custkey"), s("c_custkey").alias("doc_id"), "c_custkey")
    have = table(spark, sf_dir, "orders").filter("o_custkey % 7 <> 0").select(year("o_custkey"), s("o_custkey").alias("doc_id"))
    return T.partition_items(c.select("year", "doc_id"), have, c.filter("c_custkey % 2 = 0").select("year", "doc_id"))


@query("SELECT y::INTEGER AS year, CASE WHEN y % 4 = 3 THEN false ELSE true END AS complete, y <= 1995 AS runs FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders)")
def year_policy(spark, sf_dir):
    """T8, T11."""
    y = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    return T.year_policy(y.select("year", F.col("year") % 4 != 3, F.lit(None).cast("long").alias("annual_total")).toDF("year", "complete", "annual_total"), repair=False).select("year", "complete", "runs")


# --- duplicates and validation


@query("""SELECT id, CASE WHEN r = 0 THEN 'all_variants_unreadable' WHEN r = 1 THEN CASE WHEN nf <= 1 THEN 'same_publication_one_variant_unreadable' ELSE 'ambiguous_unreadable_variant' END
  WHEN nt = 1 AND nr = 1 THEN 'same_publication_identical_text_and_render' WHEN nt = 1 THEN 'same_publication_identical_text_render_differs' WHEN ng = 1 AND nl = 1 THEN 'same_publication_revised_pdf' WHEN ng > 1 AND nl > 1 THEN 'different_publications_same_doc_id' ELSE 'ambiguous_content_difference' END AS classification
  FROM (SELECT o_custkey AS id, count(*) FILTER (o_orderkey % 3 <> 0) AS r, count(DISTINCT o_orderstatus) AS nf, count(DISTINCT o_orderstatus) FILTER (o_orderkey % 3 <> 0) AS nt, count(DISTINCT o_orderkey % 2) FILTER (o_orderkey % 3 <> 0) AS nr,
    count(DISTINCT o_orderpriority) FILTER (o_orderkey % 3 <> 0) AS ng, count(DISTINCT o_orderkey % 5) FILTER (o_orderkey % 3 <> 0) AS nl FROM orders GROUP BY 1)""")
def variant_classify(spark, sf_dir):
    """X23, F11."""
    k = F.col("o_orderkey")
    v = F.struct((k % 3 != 0).alias("readable"), F.col("o_orderstatus").alias("text_sha256"), s(k % 2).alias("render_sha256"), F.lower("o_orderstatus").alias("reg_file"), F.when(k % 3 != 0, F.lower("o_orderpriority")).otherwise("").alias("reg"), F.lit("").alias("state"), s(k % 5).alias("title"))
    g = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.collect_list(v).alias("v"))
    return g.select("id", D.classify(F.col("v"))["classification"].alias("classification"))


@query("SELECT lang, max(length(text))::BIGINT AS max_cell_chars, count(*) FILTER (length(text) > 32767) AS cells_over_limit, count(*) FILTER (doc_id % 7 = 0) AS label_leaks FROM documents GROUP BY lang")
def cell_checks(spark, sf_dir):
    """P13, P14."""
    d = table(spark, sf_dir, "documents").withColumn("name", F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("x "), F.lit("(або ПІБ фізичної особи)"))).otherwise("x"))
    c = V.cell_checks(["text", "source"])
    return d.groupBy("lang").agg(c["max_cell_chars"].cast("long").alias("max_cell_chars"), c["cells_over_limit"].cast("long").alias("cells_over_limit"), V.label_leaks("name").alias("label_leaks"))


@query(f"""WITH g AS (SELECT md5(text) AS id, list(m ORDER BY m) AS ms FROM (SELECT text, {MEMBER} AS m FROM documents) GROUP BY 1), r AS (SELECT id, ms, ('0x' || left(id, 4))::BIGINT AS h FROM g)
  SELECT 2022 AS year, count(*) AS archive_unique_doc_ids, count(*) FILTER (h % 10 <> 0) AS csv_rows, sum(len(ms))::BIGINT AS archive_pdf_entries, count(*) FILTER (h % 10 <> 0 AND h % 7 = 0) AS absent_members, count(*) FILTER (h % 10 <> 0 AND h % 6 = 0) AS bad_variant_lists, count(*) FILTER (h % 10 = 0) AS missing_doc_ids,
  concat_ws('; ', CASE WHEN count(*) FILTER (h % 10 = 0) > 0 THEN 'missing doc_id: ' || count(*) FILTER (h % 10 = 0) END, CASE WHEN count(*) FILTER (h % 10 <> 0 AND h % 7 = 0) > 0 THEN 'selected source member absent from ZIP: ' || count(*) FILTER (h % 10 <> 0 AND h % 7 = 0) END, CASE WHEN count(*) FILTER (h % 10 <> 0 AND h % 6 = 0) > 0 THEN 'source_variants mismatch: ' || count(*) FILTER (h % 10 <> 0 AND h % 6 = 0) END) AS errors FROM r""")
def validate_years(spark, sf_dir):
    """A4, A12, J6, J7, P16."""
    m = V.collect_members(table(spark, sf_dir, "documents").select(F.lit(2022).alias("year"), member_name().alias("member")))
    h = F.conv(F.substring("doc_id", 1, 4), 16, 10).cast("long")
    t = m.withColumn("h", h).filter("h % 10 <> 0").select(
        "year", "doc_id", F.when(F.col("h") % 7 == 0, "gone").otherwise(F.col("members")[0]).alias("source_member"), F.when(F.col("h") % 6 == 0, '["other"]').otherwise(F.to_json("members")).alias("source_variants"),
        F.lit("ok").alias("extraction_status"), F.lit("").alias("pi_orcid"), F.lit("[]").alias("co_performers"), F.lit("").alias("research_leaders"), F.lit("a").alias("performer_name"), F.lit("b").alias("customer_name"),
    )
    v = V.validate_years(t, m, ["source_variants"])
    return v.select("year", "archive_unique_doc_ids", "csv_rows", "archive_pdf_entries", "absent_members", "bad_variant_lists", "missing_doc_ids", F.array_join("errors", "; ").alias("errors"))


@query("SELECT source AS year, count(*) AS rows, count(DISTINCT md5(text)) AS ids, count(*) - count(DISTINCT md5(text)) AS duplicates, count(*) FILTER (lang = 'en') AS warnings, count(*) FILTER (lang = 'fr') AS failures FROM documents GROUP BY 1")
def table_statistics(spark, sf_dir):
    """S20, A12."""
    d = table(spark, sf_dir, "documents")
    return V.table_statistics(d.select(F.col("source").alias("year"), F.md5("text").alias("doc_id"), F.when(F.col("lang") == "en", "warning").when(F.col("lang") == "fr", "failed").otherwise("ok").alias("extraction_status")))


_CARDS = """(SELECT 2022 AS year, md5(o_custkey::VARCHAR) AS doc_id, '2022/2022U' || o_orderkey || '_' || md5(o_custkey::VARCHAR) || '.pdf' AS member, o_orderkey AS k, o_orderkey % 5 = 0 AS bad,
  5 * length(o_orderkey::VARCHAR) + 3 * length(o_orderpriority) + 3 * length(o_orderstatus) + length((o_orderkey * 3)::VARCHAR) AS chars FROM orders)"""


@query(f"""SELECT doc_id, coalesce(max_by(member, (chars, member)) FILTER (NOT bad), min(member)) AS source_member, count(*)::BIGINT AS variants, coalesce(max_by(k::VARCHAR, (chars, member)) FILTER (NOT bad), '') AS registration_number,
  CASE WHEN bool_and(bad) THEN 'failed' ELSE 'warning' END AS extraction_status, coalesce(string_agg(member || ': damaged', ' | ' ORDER BY member) FILTER (bad), '') AS extraction_error,
  CASE WHEN bool_and(bad) THEN 'pdf_parse_failed' ELSE 'missing_critical_fields;few_nonempty_sections;registration_number_mismatch' || CASE WHEN bool_or(bad) THEN ';other_variant_parse_failed' ELSE '' END END AS quality_warnings,
  CASE WHEN bool_and(bad) THEN 'unknown' ELSE 'uk' END AS kind FROM {_CARDS} GROUP BY doc_id""")
def card_records(spark, sf_dir):
    """Whole cards, one record for each document; every fifth copy can't be read."""
    o = _card(table(spark, sf_dir, "orders"))
    bad = F.col("o_orderkey") % 5 == 0
    ident = F.md5(s("o_custkey"))
    v = o.select(F.lit(2022).alias("year"), ident.alias("doc_id"), F.concat(F.lit("2022/2022U"), s("o_orderkey"), F.lit("_"), ident, F.lit(".pdf")).alias("member"), F.when(~bad, F.col("text")).alias("text"), F.when(bad, "damaged").alias("error"))
    r = W.best_records(v)
    kind = F.when(F.col("extraction_status") == "failed", F.col("language")).otherwise(F.lit("uk"))
    return r.select("doc_id", "source_member", F.col("pdf_variant_count").cast("long").alias("variants"), "registration_number", "extraction_status", "extraction_error", "quality_warnings", kind.alias("kind"))


@query("""SELECT doc_id, n::BIGINT AS variant_count, readable::BIGINT AS readable_count, selected AS selected_member, CASE WHEN selected = tab THEN 'yes' ELSE 'no' END AS matches, CASE WHEN readable = n AND nt = 1 THEN 'yes' ELSE 'no' END AS normalized_text_equal
  FROM (SELECT md5(o_custkey::VARCHAR) AS doc_id, count(*) AS n, count(*) FILTER (o_orderkey % 3 <> 0) AS readable, coalesce(max_by('m' || o_orderkey, (o_orderkey % 4, o_orderkey % 2 = 0, o_orderkey, 'm' || o_orderkey)) FILTER (o_orderkey % 3 <> 0), '') AS selected,
    count(DISTINCT o_orderstatus) AS nt, coalesce(max('m' || o_orderkey) FILTER (o_orderkey % 2 = 0), '') AS tab FROM orders GROUP BY 1 HAVING count(*) > 1)""")
def duplicate_audit(spark, sf_dir):
    """The audit's choice beside the table's."""
    k = F.col("o_orderkey")
    ident, member = F.md5(s("o_custkey")), F.concat(F.lit("m"), s("o_orderkey"))
    empty = [F.lit("").alias(c) for c in ("source_file", "sha256", "registration_filename", "render_sha256", "error", "registration_internal", "state_registration", "title_uk", "title_en")]
    o = table(spark, sf_dir, "orders")
    v = o.select(F.lit(2022).alias("year"), ident.alias("doc_id"), member.alias("member"), *empty, k.alias("bytes"), (k % 3 != 0).alias("readable"), F.lit(2).alias("pages"), (2 - k % 2).cast("int").alias("opened_pages"), F.lit(1).alias("text_chars"), F.col("o_orderstatus").alias("text_sha256"), F.struct((k % 4).alias("q")).alias("quality"))
    chosen = o.filter("o_orderkey % 2 = 0").groupBy(ident.alias("doc_id")).agg(F.max(member).alias("source_member"))
    g = D.audit_groups(v, chosen)
    return g.select("doc_id", F.col("variant_count").cast("long").alias("variant_count"), F.col("readable_count").cast("long").alias("readable_count"), "selected_member", F.col("table_selection_matches_audit").alias("matches"), "normalized_text_equal")


@query("SELECT 2022 AS year, count(*) AS physical, 0::BIGINT AS unparsed, count(DISTINCT md5((length(text) % 300)::VARCHAR)) AS doc_ids FROM documents")
def inventory(spark, sf_dir):
    """S9."""
    return C.inventory(_refs(spark, sf_dir))


@query("SELECT 2022 AS year, strftime(d, '%Y-%m-%d') AS day, string_agg(DISTINCT id, ';' ORDER BY id) AS ids FROM (SELECT DATE '2022-03-01' + (doc_id % 28)::INTEGER AS d, md5(text) AS id FROM documents) GROUP BY 2")
def ids_by_date(spark, sf_dir):
    """S16."""
    from ..sources.files import ids_by_date as by_date

    names = table(spark, sf_dir, "documents").select(F.lit(2022).alias("year"), member_name().alias("name"))
    return by_date(names).select("year", "day", F.array_join("doc_ids", ";").alias("ids"))


@query("SELECT c_custkey::VARCHAR AS doc_id FROM customer WHERE c_custkey % 3 = 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 2 = 0)")
def patch_entries(spark, sf_dir):
    """K14, J12."""
    c = table(spark, sf_dir, "customer").select(F.lit(2022).alias("year"), s("c_custkey").alias("doc_id"), "c_custkey")
    held = table(spark, sf_dir, "orders").filter("o_custkey % 2 = 0").select(F.lit(2022).alias("year"), s("o_custkey").alias("doc_id"))
    return K.patch_entries(c.select("year", "doc_id"), c.filter("c_custkey % 3 = 0").select("year", "doc_id"), held).select("doc_id")


@query("SELECT y::INTEGER AS year, n AS listed, n % 2 = 0 AND y % 3 <> 0 AS whole FROM (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1)")
def annual_check(spark, sf_dir):
    """T9, A21."""
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"))
    n = o.groupBy("year").agg(F.count("*").alias("n"))
    days = n.select("year", F.col("n").alias("listed"), F.lit(True).alias("complete"))
    totals = n.select("year", (F.col("n") + F.col("n") % 2).alias("annual_total"))
    return T.annual_check(days, totals, n.filter("year % 3 = 0").select("year")).select("year", "listed", "whole")


@query("SELECT event_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS ts, min(event_type) AS event_type FROM events GROUP BY event_id")
def stream_dedup(spark, sf_dir):
    """Events as a file stream, each id once, exactly once into Parquet."""
    root = shared_path(spark, "stream")
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet*").parquet(sf_dir).select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    T.checkpointed(T.stream_dedup(stream, ["event_id"]), f"{root}/out", f"{root}/state").awaitTermination()
    return spark.read.parquet(f"{root}/out").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "event_type")


# --- delivery: verification of archives, packages and registers


def _found(spark, sf_dir) -> DataFrame:
    """Orders are members of year archives, two a year and place; every 29th has no id."""
    k = F.col("o_orderkey")
    ident = F.when(k % 29 != 0, s("o_custkey"))
    return table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), F.concat(F.lit("a"), s(k % 3), F.lit(".zip")).alias("archive"), (k % 3).alias("archive_rank"), F.concat(F.lit("m"), s(k)).alias("member"), ident.alias("doc_id"))


_FOUND = "(SELECT year(o_orderdate) AS year, 'a' || o_orderkey % 3 || '.zip' AS archive, o_orderkey % 3 AS rank, 'm' || o_orderkey AS member, CASE WHEN o_orderkey % 29 <> 0 THEN o_custkey::VARCHAR END AS doc_id FROM orders)"
_EXPECTED = "(SELECT y AS year, c_custkey::VARCHAR AS doc_id FROM customer, (SELECT DISTINCT year(o_orderdate) AS y FROM orders) WHERE c_custkey % 4 <> 1)"


@query(f"""WITH f AS {_FOUND}, i AS (SELECT DISTINCT year, doc_id FROM f WHERE doc_id IS NOT NULL), e AS {_EXPECTED}, j AS (SELECT coalesce(i.year, e.year) AS year, coalesce(i.doc_id, e.doc_id) AS doc_id, i.doc_id IS NOT NULL AS a, e.doc_id IS NOT NULL AS b FROM i FULL JOIN e ON i.year = e.year AND i.doc_id = e.doc_id),
  k AS (SELECT *, row_number() OVER (PARTITION BY year, a ORDER BY doc_id) AS r FROM j WHERE a <> b)
  SELECT c.year::INTEGER AS year, c.ids, c.missing, c.extra, m.members, m.unparsed, (SELECT string_agg(doc_id, ',' ORDER BY doc_id) FROM k WHERE k.year = c.year AND b AND r <= 20) AS first_missing, (SELECT string_agg(doc_id, ',' ORDER BY doc_id) FROM k WHERE k.year = c.year AND a AND r <= 20) AS first_extra,
    c.missing = 0 AND c.extra = 0 AND m.unparsed = 0 AND m.members = c.ids AS ok
  FROM (SELECT year, count(*) FILTER (a) AS ids, count(*) FILTER (b AND NOT a) AS missing, count(*) FILTER (a AND NOT b) AS extra FROM j GROUP BY 1) c JOIN (SELECT year, count(*) AS members, count(*) - count(doc_id) AS unparsed FROM f GROUP BY 1) m USING (year)""")
def archive_verification(spark, sf_dir):
    """K14, K15, O4."""
    f = _found(spark, sf_dir)
    expected = table(spark, sf_dir, "customer").filter("c_custkey % 4 <> 1").select(s("c_custkey").alias("doc_id"), F.explode(F.array(*(F.lit(y) for y in range(1980, 2040)))).alias("year"))
    expected = expected.join(f.select("year").distinct(), "year", "left_semi")
    v = Y.archive_verification(f, expected)
    return v.withColumns({c: F.array_join(c, ",") for c in ("first_missing", "first_extra")})


_USABLE = "(SELECT DISTINCT year, archive FROM f WHERE NOT (year % 2 = 0 AND archive = 'a0.zip'))"


@query(f"WITH f AS {_FOUND}, u AS {_USABLE}, i AS (SELECT year, count(DISTINCT doc_id) AS ids FROM f SEMI JOIN u USING (year, archive) GROUP BY 1) SELECT year::INTEGER AS year, ids, (SELECT string_agg(archive, ',' ORDER BY archive) FROM u WHERE u.year = i.year) AS archives, (SELECT min(archive) FROM u WHERE u.year = i.year) AS first FROM i")
def collected_ids(spark, sf_dir):
    """S12, S13."""
    f = _found(spark, sf_dir)
    usable = f.filter("NOT (year % 2 = 0 AND archive = 'a0.zip')").select("year", "archive").distinct()
    ids, archives = Y.collected_ids(f, usable)
    first = Y.first_usable(f.select("year", "archive", "archive_rank").distinct(), usable)
    return ids.groupBy("year").agg(F.count("*").alias("ids")).join(archives, "year").join(first.withColumnRenamed("archive", "first"), "year").withColumn("archives", F.array_join("archives", ","))


@query(f"""WITH f AS {_FOUND} SELECT year::INTEGER AS year, archive, count(*) AS physical, count(DISTINCT doc_id) AS ids, count(*) - count(doc_id) AS unparsed,
  (SELECT string_agg(member, ',' ORDER BY member) FROM (SELECT year AS y, archive AS a, member, row_number() OVER (PARTITION BY year, archive ORDER BY member) AS r FROM f WHERE doc_id IS NULL) WHERE y = f.year AND a = f.archive AND r <= 5) AS first_unparsed FROM f GROUP BY year, archive""")
def archive_ids(spark, sf_dir):
    """S22, O4."""
    return Y.archive_ids(_found(spark, sf_dir)).withColumn("first_unparsed", F.array_join("first_unparsed", ","))


def _reports(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """A report and an archive of each nation's year."""
    n = F.col("n_nationkey")
    t = table(spark, sf_dir, "nation").withColumn("year", n + 2000)
    reports = t.filter(n < 20).select("year", (n % 7 == 0).alias("sample_mode"), n.alias("rows_written"), (n + F.when(n % 5 == 0, 1).otherwise(0)).alias("archive_unique_doc_ids"), F.when(n % 6 == 0, 46).otherwise(135).alias("csv_columns"), F.lit("a").alias("archive"))
    return reports, t.select("year", F.when(n % 8 == 3, "b").otherwise("a").alias("archive"))


_WHOLE = "n_nationkey < 20 AND n_nationkey % 7 <> 0 AND n_nationkey % 5 <> 0 AND n_nationkey % 6 <> 0 AND n_nationkey % 8 <> 3"


@query(f"SELECT (n_nationkey + 2000)::INTEGER AS year FROM nation WHERE {_WHOLE}")
def complete_output(spark, sf_dir):
    """P11."""
    return V.complete_output(*_reports(spark, sf_dir), 135)


@query(f"SELECT (n_nationkey + 2000)::INTEGER AS year, CASE WHEN n_nationkey % 8 = 3 THEN 'b' ELSE 'a' END AS archive FROM nation WHERE NOT ({_WHOLE}) ORDER BY 1 DESC")
def years_to_build(spark, sf_dir):
    """T12, O3."""
    return Y.ordered_years(Y.years_to_build(*_reports(spark, sf_dir), 135), descending=True)


@query("SELECT n_nationkey::INTEGER AS year FROM nation WHERE n_nationkey % 3 <> 0 AND n_nationkey % 4 <> 2")
def verified_reports(spark, sf_dir):
    """Archives x and y of a year, where y is gone for some."""
    n = F.col("n_nationkey")
    name = lambda c: F.concat(F.lit(c), s(n))
    t = table(spark, sf_dir, "nation")
    existing = t.select(name("x").alias("archive")).unionByName(t.filter(n % 4 != 2).select(name("y").alias("archive")))
    return Y.verified_reports(t.select(n.alias("year"), (n % 3 != 0).alias("complete"), F.array(name("x"), name("y")).alias("archives")), existing)


@query("""SELECT 'f' || p_partkey AS name, CASE WHEN p_partkey % 11 = 0 THEN 'missing' WHEN p_partkey % 13 = 0 THEN 'unknown' WHEN p_partkey % 17 = 0 THEN 'different' ELSE 'equal' END AS state FROM part WHERE NOT (p_partkey % 11 = 0 AND p_partkey % 13 = 0)""")
def self_check(spark, sf_dir):
    """J14."""
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part").select(F.concat(F.lit("f"), s(k)).alias("name"), F.col("p_size").cast("long").alias("bytes"), F.sha2("p_name", 256).alias("sha256"), k)
    changed = p.withColumn("sha256", F.when(k % 17 == 0, F.sha2(F.concat("sha256", F.lit("x")), 256)).otherwise(F.col("sha256")))
    return Y.self_check(changed.filter(k % 11 != 0), p.filter(k % 13 != 0))


@query("""SELECT 'no_pdf' AS name, count(*) FILTER (c_custkey % 7 = 0) AS found, count(*) FILTER (c_custkey % 7 = 0) AS expected, true AS equal FROM customer
  UNION ALL SELECT 'http_500', count(*) FILTER (c_custkey % 9 = 0), count(*) FILTER (c_custkey % 9 = 0) + 1, false FROM customer
  UNION ALL SELECT 'gaps', sum(c_custkey % 5) FILTER (c_custkey % 3 = 0)::BIGINT, sum(c_custkey % 5) FILTER (c_custkey % 3 = 0)::BIGINT, true FROM customer""")
def register_checks(spark, sf_dir):
    """A22."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    gaps = c.filter(k % 3 == 0).select((k % 5).alias("gap"))
    totals = c.agg(F.count_if(k % 7 == 0).alias("a"), (F.count_if(k % 9 == 0) + 1).alias("b"), F.sum(F.when(k % 3 == 0, k % 5)).alias("g")).select(F.inline(F.array(*(F.struct(F.lit(n).alias("name"), F.col(v).alias("expected")) for n, v in (("no_pdf", "a"), ("http_500", "b"), ("gaps", "g"))))))
    return Y.register_checks({"no_pdf": c.filter(k % 7 == 0), "http_500": c.filter(k % 9 == 0)}, totals, gaps)


@query(f"""WITH c AS (SELECT count(*) FILTER (site AND NOT archive AND no_pdf) AS no_pdf, count(*) FILTER (site AND NOT archive AND server500) AS http_500, count(*) FILTER (no_pdf AND server500) AS in_both, count(*) FILTER (site AND NOT archive AND NOT no_pdf AND NOT server500) AS unexplained,
  count(*) FILTER ((no_pdf OR server500) AND NOT (site AND NOT archive)) AS not_missing, count(*) FILTER (site AND NOT archive) AS missing FROM {_FLAGS})
  SELECT *, 6::BIGINT AS gap, no_pdf + http_500 + 6 AS unavailable, in_both = 0 AS disjoint, unexplained = 0 AS complete, not_missing = 0 AS only_missing, (SELECT count(*) FROM {_FLAGS} WHERE site AND NOT archive) = no_pdf + http_500 + unexplained - in_both AS adds_up FROM c""")
def error_groups(spark, sf_dir):
    """A23."""
    return Y.error_groups(_flags(spark, sf_dir), F.lit(6))


@query("SELECT y::INTEGER AS year, CASE WHEN y % 2 = 0 THEN n END AS annual_total FROM (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1)")
def annual_total(spark, sf_dir):
    """A year's total counts only where its page echoes the dates."""
    from ..sources.listing import annual_total as total
    from ..sources.listing import matches_dates

    y = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("total"))
    start, end = (F.concat(s("year"), F.lit(d)) for d in ("-01-01", "-12-31"))
    echoed = F.when(F.col("year") % 2 == 0, end).when(F.col("year") % 3 == 0, F.concat(s("year"), F.lit("-01-31")))  # the year, a month, or no end at all
    inputs = F.create_map(F.lit("dateFromSearch"), start, F.lit("dateToSearch"), echoed)
    return total(y.select("year", "total", matches_dates(inputs, start, end).alias("dates_ok"))).select("year", F.col("annual_site_total").alias("annual_total"))
