"""Queries of streams, state files and repair reports over the synthetic tables, with their SQL.

Streams read files that are made of a table here, several batches of them, and go through the ledger; what they leave in the shared folder goes
once the result has been written to one table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import reconcile as R
from ..operators import repair
from ..sources import files, sinks
from ..sources.shared import shared_path
from ..sources.storage import child, deleted
from ..streaming import intake as T
from ..streaming import ledger as L
from .queries_text import s, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def _kept(df: DataFrame, *folders: str) -> DataFrame:
    """df as a table of its own, so that what it was made of can go."""
    path = shared_path(df.sparkSession, "result")
    df.write.parquet(path)
    for folder in folders:
        deleted(folder)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _batches(df: DataFrame, folder: str, n: int = 4) -> DataFrame:
    """df as a stream of n files, one a batch."""
    df.repartition(n).write.parquet(folder)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


_DAYS = """SELECT year(ts)::INTEGER AS year, strftime(ts, '%Y-%m-%d') AS day, max(CASE WHEN event_id % 50 = 0 THEN 20 + day(ts) % 20 END)::BIGINT AS announced, count(DISTINCT CASE WHEN event_type <> 'error' THEN user_id % 40 END)::BIGINT AS listed,
  count(*) FILTER (event_type = 'error' AND event_id % 7 = 0)::BIGINT AS failed FROM events GROUP BY 1, 2"""


@query(f"SELECT *, coalesce(failed = 0 AND announced = listed, false) AS complete FROM ({_DAYS})")
def days_stream(spark, sf_dir):
    """Days by keyed state over four batches, through a ledger; the last row of each day counts."""
    n = F.col("event_id")
    status = F.when((F.col("event_type") == "error") & (n % 7 == 0), "page_fail").when(F.col("event_type") == "error", "fail").when(F.col("event_type") == "click", "ok").when(F.col("event_type") == "view", "skip").when(F.col("event_type") == "purchase", "notpdf").otherwise("server500")
    rows = table(spark, sf_dir, "events").select(F.year("ts").alias("year"), F.date_format("ts", "yyyy-MM-dd").alias("day"), F.when(n % 50 == 0, 20 + F.dayofmonth("ts") % 20).cast("long").alias("announced"), s(F.col("user_id") % 40).alias("doc_id"), status.alias("status"))
    root = shared_path(spark, "days")
    with T.state_in_rocksdb(spark):
        L.started(T.stream_days(_batches(rows, child(root, "in"))), child(root, "out"), child(root, "state"), "update").awaitTermination()
    last = L.latest(L.appended(spark, child(root, "out"), T.DAY_FIGURES), ["year", "day"])
    return _kept(last.select("year", "day", "announced", "listed", "failed", F.coalesce("complete", F.lit(False)).alias("complete")), root)


@query("SELECT year(ts)::INTEGER AS year, strftime(ts, '%Y-%m-%d') AS day, event_type AS status, count(*) AS lines, count(DISTINCT user_id) AS ids, min(props) AS first_reason FROM events GROUP BY 1, 2, 3")
def log_sink(spark, sf_dir):
    """Lines appended batch by batch; each batch is delivered twice and counts once."""
    day = F.date_format("ts", "yyyy-MM-dd")
    fields = [F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), day.alias("day"), F.col("event_type").alias("status"), F.lit(None).cast("string").alias("registration"), s("user_id").alias("doc_id"), F.col("props").alias("reason"), F.lit("-").alias("url")]
    lines = sinks.log_line(table(spark, sf_dir, "events").select(*fields))
    root = shared_path(spark, "log")
    once = L.append_once(child(root, "out"))

    def twice(batch: DataFrame, batch_id: int) -> None:
        once(batch, batch_id)
        once(batch, batch_id)

    stream = _batches(lines, child(root, "in")).writeStream.foreachBatch(twice).option("checkpointLocation", child(root, "state")).trigger(availableNow=True).start()
    stream.awaitTermination()
    told = L.appended(spark, child(root, "out"), lines.schema)
    log = R.error_log(told.select(F.lit(0).alias("year"), F.col("batch_id").alias("line_no"), "value")).withColumn("year", F.substring("day", 1, 4).cast("int"))
    return _kept(log.groupBy("year", "day", "status").agg(F.count("*").alias("lines"), F.count_distinct("doc_id").alias("ids"), F.min("reason").alias("first_reason")), root)


_YEAR_DAYS = """(SELECT y, strftime(d, '%Y-%m-%d') AS day FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders), LATERAL (SELECT unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), INTERVAL 1 DAY)) AS d) WHERE NOT (y % 2 = 1 AND dayofyear(d) % 50 = 0))"""


def _state(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Years of the orders, and a record of each of their days but every 50th of odd years: the customers of a day are its ids."""
    o = table(spark, sf_dir, "orders").withColumns({"year": F.year("o_orderdate"), "day": F.date_format("o_orderdate", "yyyy-MM-dd"), "id": s("o_custkey")})
    years = o.select("year").distinct()
    k = F.col("o_orderkey")
    ids = lambda c: F.array_sort(F.collect_set(F.when(c, F.col("id"))))
    day = F.to_date("day")
    days = T.calendar(years).filter(~((F.col("year") % 2 == 1) & (F.dayofyear(day) % 50 == 0)))
    lists = o.groupBy("year", "day").agg(ids(F.lit(True)).alias("doc_ids"), ids(k % 10 == 0).alias("no_pdf_doc_ids"), ids(k % 11 == 0).alias("server500_doc_ids"))
    none = F.array().cast("array<string>")
    state = days.join(lists, ["year", "day"], "left").select(
        "year", "day", F.col("day").alias("date_to"), F.size(F.coalesce("doc_ids", none)).cast("long").alias("site_total"), *(F.coalesce(c, none).alias(c) for c in ("doc_ids", "no_pdf_doc_ids", "server500_doc_ids")),
        F.lit(None).cast("string").alias("completed_at_utc"), F.lit(None).cast("string").alias("accepted_error"), F.when(F.dayofmonth(day) % 3 == 0, F.array(F.lit("fail"), F.lit("page_fail"))).alias("additional_logged_statuses"),
    )
    return years, state


def _saved(spark, sf_dir) -> tuple[DataFrame, DataFrame, str]:
    """The state as written to its files and read again."""
    years, state = _state(spark, sf_dir)
    folder = shared_path(spark, "state")
    paths = [r.path for r in sinks.save_state(state, folder).collect()]  # one a year
    return years, files.repair_state(spark, paths), folder


_SITE = "(SELECT o.*, year(o_orderdate) AS y, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders o WHERE NOT (year(o_orderdate) % 2 = 1 AND dayofyear(o_orderdate) % 50 = 0))"


@query(f"""SELECT d.y::INTEGER AS year, count(DISTINCT d.day) AS days, count(DISTINCT o_custkey) AS ids, count(DISTINCT CASE WHEN o_orderkey % 10 = 0 THEN o_custkey END) AS no_pdf,
  count(DISTINCT CASE WHEN o_orderkey % 11 = 0 THEN o_custkey END) AS server500 FROM {_YEAR_DAYS} d LEFT JOIN {_SITE} o ON o.y = d.y AND o.day = d.day GROUP BY 1""")
def state_files(spark, sf_dir):
    """The state of each year written to its file and reread."""
    _, state, folder = _saved(spark, sf_dir)
    out = state.groupBy("year").agg(F.count_distinct("day").alias("days"))
    for name, ids in (("ids", "doc_ids"), ("no_pdf", "no_pdf_doc_ids"), ("server500", "server500_doc_ids")):
        out = out.join(files.state_ids(state, ids).groupBy("year").agg(F.count("*").alias(name)), "year", "left")
    return _kept(out.na.fill(0), folder)


_REPORT = f"""WITH site AS {_SITE}, o AS (SELECT *, year(o_orderdate) AS y FROM orders),
  have AS (SELECT y, o_custkey AS id, bool_or(o_orderkey % 7 = 2) AS loose, bool_or(o_orderkey % 5 = 1) AS staged FROM o WHERE y % 2 = 0 OR o_orderkey % 3 = 0 OR o_orderkey % 7 = 2 OR o_orderkey % 5 = 1 GROUP BY 1, 2),
  s AS (SELECT y, o_custkey AS id, bool_or(o_orderkey % 10 = 0) AS no_pdf, bool_or(o_orderkey % 11 = 0) AS dead FROM site GROUP BY 1, 2),
  j AS (SELECT coalesce(s.y, h.y) AS y, coalesce(s.id, h.id) AS id, s.id IS NOT NULL AS site, h.id IS NOT NULL AS have, coalesce(no_pdf, false) AS no_pdf, coalesce(dead, false) AS dead, coalesce(loose, false) AS loose, coalesce(staged, false) AS staged FROM s FULL JOIN have h ON s.y = h.y AND s.id = h.id),
  c AS (SELECT y, count(*) FILTER (site) AS ids, count(*) FILTER (have) AS have, count(*) FILTER (site AND NOT have AND no_pdf) AS no_pdf, count(*) FILTER (site AND NOT have AND NOT no_pdf AND dead) AS dead,
    count(*) FILTER (site AND NOT have AND NOT no_pdf AND NOT dead) AS unresolved, count(*) FILTER (have AND NOT site) AS extra, count(*) FILTER (loose) AS loose, count(*) FILTER (staged) AS staged FROM j GROUP BY 1),
  u AS (SELECT y, string_agg(id::VARCHAR, ',' ORDER BY id::VARCHAR) AS first FROM (SELECT y, id, row_number() OVER (PARTITION BY y ORDER BY id::VARCHAR) AS r FROM j WHERE site AND NOT have AND NOT no_pdf AND NOT dead) WHERE r <= 20 GROUP BY 1),
  dd AS (SELECT y, string_agg(day, ',' ORDER BY day) AS dates, string_agg(CASE WHEN day(day::DATE) % 3 = 0 THEN day END, ',' ORDER BY day) AS more FROM (SELECT DISTINCT y, day FROM site WHERE o_orderkey % 11 = 0) GROUP BY 1),
  f AS (SELECT y, string_agg(strftime(d, '%Y-%m-%d'), ',' ORDER BY d) AS open FROM (SELECT DISTINCT y FROM o), LATERAL (SELECT unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), INTERVAL 1 DAY)) AS d) WHERE y % 2 = 1 AND dayofyear(d) % 50 = 0 GROUP BY 1),
  t AS (SELECT y, count(DISTINCT o_custkey) + CASE WHEN y % 4 = 2 THEN 1 ELSE 0 END AS total FROM o GROUP BY 1),
  r AS (SELECT c.*, u.first, dd.dates, dd.more, f.open, CASE WHEN f.open IS NULL THEN t.total END AS total FROM c LEFT JOIN u USING (y) LEFT JOIN dd USING (y) LEFT JOIN f USING (y) LEFT JOIN t USING (y))"""


def _report(spark, sf_dir) -> tuple[DataFrame, str]:
    years, state, folder = _saved(spark, sf_dir)
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), s("o_custkey").alias("doc_id"), "o_orderkey")
    k, y = F.col("o_orderkey"), F.col("year")
    totals = o.groupBy("year").agg((F.count_distinct("doc_id") + F.when(y % 4 == 2, 1).otherwise(0)).alias("annual_total"))
    used = years.select("year", F.explode(F.array(F.concat(s(y), F.lit("-b.zip")), F.concat(s(y), F.lit(".zip")))).alias("archive"))
    return repair.annual_repair_report(years, state, o.filter((y % 2 == 0) | (k % 3 == 0)), o.filter(k % 7 == 2), o.filter(k % 5 == 1), totals, used, 20), folder


@query(_REPORT + """ SELECT y::INTEGER AS year, ids AS daily_unique_site_doc_ids, have AS unique_pdf_ids_before_patch, no_pdf AS confirmed_no_pdf, dead AS confirmed_server500, unresolved, extra AS extra_pdf_ids_not_in_current_site_year, loose AS loose_existing_pdf_count, staged AS staged_pdf_count,
  coalesce(first, '') AS unresolved_doc_ids, coalesce(dates, '') AS accepted_server500_dates, coalesce(open, '') AS unfinished_dates, y || '-b.zip,' || y || '.zip' AS archives_used, coalesce(more, '') AS with_additional_errors, total AS annual_site_total,
  open IS NULL AND unresolved = 0 AND coalesce(total = ids, false) AS complete FROM r""")
def annual_repair_report(spark, sf_dir):
    """All fields of the report; even years are whole, odd ones have open days and ids."""
    report, folder = _report(spark, sf_dir)
    more = F.array_join(F.array_sort(F.map_keys(F.coalesce("accepted_server500_dates_with_additional_errors", F.create_map().cast("map<string,array<string>>")))), ",")
    lists = ("unresolved_doc_ids", "accepted_server500_dates", "unfinished_dates", "archives_used")
    return _kept(report.withColumns({"with_additional_errors": more, **{c: F.array_join(c, ",") for c in lists}}).drop("accepted_server500_dates_with_additional_errors"), folder)


@query(_REPORT + """, log AS (SELECT y, day, string_agg(DISTINCT p, ',' ORDER BY p) AS statuses FROM (SELECT year(o_orderdate) AS y, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderpriority AS p FROM orders) GROUP BY 1, 2),
  x AS (SELECT y, unnest(string_split(open, ',')) AS day FROM r WHERE open IS NOT NULL)
  SELECT x.y::INTEGER AS year, x.y || ' | ' || x.day || ' | ' || coalesce(statuses, '-') || ' | _repair_report_' || x.y || '.json | errors_' || x.y || '.txt' AS value FROM x LEFT JOIN log ON log.y = x.y AND log.day = x.day
  UNION ALL SELECT y::INTEGER, y || ' | doc_id=' || id || ' | unresolved | _repair_report_' || y || '.json | errors_' || y || '.txt' FROM (SELECT y, unnest(string_split(first, ',')) AS id FROM r WHERE first IS NOT NULL)""")
def repair_lines(spark, sf_dir):
    """A line for each open day with its logged statuses and each unresolved id."""
    report, folder = _report(spark, sf_dir)
    log = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_orderpriority").alias("status"))
    return _kept(repair.repair_lines(report, R.day_statuses(log)), folder)
