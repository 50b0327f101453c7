"""Incremental intake: page observations to complete days, in batch and as a stream.

A day is a key with state. Its pages may come again and in any order; what counts is which ids
were seen, what was announced, and how each fetch ended.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions.text import days, page_count, valid_pdf

#: Ends of a fetch that no later run repeats.
TERMINAL = ("ok", "skip", "notpdf", "server500")
#: What is wrong with a page.
FAILURES = ("page_fail", "page_repeat", "page_limit")


def calendar(years: DataFrame) -> DataFrame:
    """all days of each year."""
    y = F.col("year").cast("string")
    all_days = years.select("year", F.explode(days(F.concat(y, F.lit("-01-01")), F.concat(y, F.lit("-12-31")))).alias("day"))
    return all_days.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def unfinished(years: DataFrame, state: DataFrame) -> DataFrame:
    """Days of the calendar without a completed record."""
    return calendar(years).join(state.select("year", "day").distinct(), ["year", "day"], "left_anti")


def response_status(code: Column, body: Column, attempt: Column, retries: Column, existing: Column) -> Column:
    """How a fetch ended, or "retry".

    A valid file at hand is skipped; 404 and 410 mean no PDF and 500 a server error, both for good; an empty body, a body that is
    no PDF and any other failure (null code) are tried again while attempts (from 0) are left.
    """
    last = attempt >= retries - 1
    again = lambda status: F.when(last, status).otherwise("retry")
    return (
        F.when(existing, "skip").when(code.isin(404, 410), "notpdf").when(code == 500, "server500")
        .when(code.isNull() | (code >= 400), again("fail")).when(F.coalesce(F.octet_length(body), F.lit(0)) == 0, again("empty"))
        .when(~valid_pdf(body), again("fail")).otherwise("ok")
    )


def partition_items(items: DataFrame, available: DataFrame, terminal: DataFrame) -> DataFrame:
    """Items with `route`: available before server500 before fetch."""
    keys = ["year", "doc_id"]
    marked = items.join(available.select(*keys).distinct().withColumn("_have", F.lit(True)), keys, "left").join(terminal.select(*keys).distinct().withColumn("_dead", F.lit(True)), keys, "left")
    return marked.withColumn("route", F.when(F.col("_have"), "available").when(F.col("_dead"), "server500").otherwise("fetch")).drop("_have", "_dead")


def distinct_items(pages: DataFrame) -> DataFrame:
    """Each id of a day once, at the first page that shows it."""
    rows = pages.select("year", "day", "page", F.posexplode("cards").alias("place", "item")).select("year", "day", "page", "place", "item.*")
    return rows.groupBy("year", "day", "doc_id").agg(F.min_by(F.struct("page", "registration", "pdf_url", "title"), F.struct("page", "place")).alias("i")).select("year", "day", "doc_id", "i.*")


def day_pages(pages: DataFrame, cap: int = 100) -> DataFrame:
    """By day the announced total, its page count and what is wrong with its pages.

    pages: year, day, page, total, cards, accepted. A page after the first without new ids is a repeat, and an error while
    pages are still due; a refused page is an error; so is the page cap while pages are due.
    """
    ids = F.transform("cards", lambda c: c["doc_id"])
    p = pages.select("year", "day", "page", "total", "accepted", F.size("cards").alias("n"), F.posexplode_outer(ids).alias("place", "doc_id"))
    # one shuffle by day serves the first sight of each id and the sums of the day
    seen = F.row_number().over(Window.partitionBy("year", "day", "doc_id").orderBy("page", "place"))
    p = p.repartition("year", "day").withColumn("new", F.col("doc_id").isNotNull() & (seen == 1))
    later = (F.col("page") > 1) & (F.col("n") > 0)
    d = p.groupBy("year", "day").agg(
        F.max(F.when(F.col("page") == 1, F.col("total"))).alias("announced"), F.max(F.when(F.col("page") == 1, F.greatest(F.col("n"), F.lit(0)))).alias("size"),
        F.max("page").alias("last_page"), F.bool_or(~F.col("accepted")).alias("page_fail"), F.count_if("new").alias("listed"),
        F.array_min(F.array_except(F.collect_set(F.when(later, F.col("page"))), F.collect_set(F.when(F.col("new"), F.col("page"))))).alias("repeat"),
    )
    due = page_count(F.col("announced"), F.when(F.col("size") > 0, F.col("size")).otherwise(10))
    d = d.withColumn("total_pages", due)
    wrong = {"page_fail": F.col("page_fail"), "page_repeat": F.coalesce(F.col("repeat") <= F.col("total_pages"), F.lit(False)), "page_limit": F.coalesce((F.col("last_page") >= cap) & (F.col("total_pages") > cap), F.lit(False))}
    return d.withColumn("errors", F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in wrong.items())), lambda x: x.isNotNull())).drop("page_fail", "size", "repeat")


def day_completion(pages: DataFrame, outcomes: DataFrame, cap: int = 100) -> DataFrame:
    """Each day with its outcome counts; complete where no page failed, every id ended for good, and distinct ids equal the announced total.

    outcomes: year, day, doc_id, status.
    """
    counts = outcomes.groupBy("year", "day").agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("ok", "skip", "notpdf", "server500", "empty", "fail")))
    d = day_pages(pages, cap).join(counts, ["year", "day"], "left").na.fill(0, ["ok", "skip", "notpdf", "server500", "empty", "fail"])
    exact = F.coalesce(F.col("listed") == F.col("announced"), F.lit(False))
    d = d.withColumn("errors", F.when(exact, F.col("errors")).otherwise(F.array_append("errors", F.lit("count_mismatch"))))
    return d.withColumn("complete", (F.size("errors") == 0) & (F.col("fail") == 0) & (F.col("empty") == 0))


def year_policy(years: DataFrame, repair: bool) -> DataFrame:
    """Which years run. (year, complete, annual_total) in order: a year announced as empty is complete; without repair
    everything after the first incomplete year waits. One row a year."""
    done = F.col("complete") | F.coalesce(F.col("annual_total") == 0, F.lit(False))
    before = F.min(done.cast("int")).over(Window.orderBy("year").rowsBetween(Window.unboundedPreceding, -1))
    return years.withColumn("complete", done).withColumn("runs", F.lit(True) if repair else F.coalesce(before == 1, F.lit(True)))


def annual_check(days_: DataFrame, totals: DataFrame, unresolved: DataFrame) -> DataFrame:
    """A year is whole where its total is its distinct daily ids, no day is open and no id unresolved."""
    ids = days_.groupBy("year").agg(F.sum("listed").alias("listed"), F.count_if(~F.col("complete")).alias("open_days"))
    out = totals.join(ids, "year", "left").join(unresolved.groupBy("year").agg(F.count("*").alias("unresolved")), "year", "left").na.fill(0, ["listed", "open_days", "unresolved"])
    return out.withColumn("whole", (F.col("annual_total") == F.col("listed")) & (F.col("open_days") == 0) & (F.col("unresolved") == 0))


# --- the same as streams: an extension of this engine

DAY_FIGURES = "year int, day string, announced long, listed long, failed long, complete boolean, final boolean"


class DayProcessor(StatefulProcessor):
    """A day's ids as a map, an entry each, and its figures as one value, so a batch writes what it brings and no more.

    A timer `quiet` seconds of event time behind a day's last row closes it: its row comes out once more as final, and its state goes.
    Rows that come later open the day anew.
    """

    def __init__(self, quiet: int | None):
        self.quiet = quiet

    def init(self, handle) -> None:
        self.handle = handle
        self.ids = handle.getMapState("ids", "doc_id string", "place int")
        self.figures = handle.getValueState("figures", "announced long, listed long, failed long, closes long")

    def _row(self, key: tuple, v: tuple, final: bool) -> pd.DataFrame:
        announced, listed, failed = v[:3]
        return pd.DataFrame([(key[0], key[1], announced, listed, failed, failed == 0 and announced == listed, final)], columns=[x.split()[0] for x in DAY_FIGURES.split(", ")]).astype({"announced": "Int64"})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        announced, listed, failed, closes = self.figures.get() if self.figures.exists() else (None, 0, 0, None)
        last = None
        for b in rows:
            totals = b["announced"].dropna()
            if len(totals):
                announced = int(totals.max()) if announced is None else max(announced, int(totals.max()))
            for doc_id in b.loc[b["status"].isin(TERMINAL), "doc_id"].dropna().unique():
                if not self.ids.containsKey((doc_id,)):
                    self.ids.updateValue((doc_id,), (listed,))
                    listed += 1
            failed += int(b["status"].isin(FAILURES).sum())
            if self.quiet is not None:
                newest = int(b["ts"].max().timestamp() * 1000)
                last = newest if last is None else max(last, newest)
        if last is not None:
            due = max(last + self.quiet * 1000, closes or 0)
            if due != closes:
                if closes is not None:
                    self.handle.deleteTimer(closes)
                self.handle.registerTimer(due)
                closes = due
        self.figures.update((announced, listed, failed, closes))
        yield self._row(key, (announced, listed, failed), False)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        v = self.figures.get()
        self.ids.clear()
        self.figures.clear()
        yield self._row(key, v, True)

    def close(self) -> None:
        pass


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """State stores of queries that start inside: RocksDB, which keeps state on disk and writes what changed."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stream_days(observations: DataFrame, quiet: int | None = None) -> DataFrame:
    """T1, T2, T4 as a stream of (year, day, announced, doc_id, status): after each batch the figures of the days it touched.

    The largest announced total counts, so pages may come in any order. With `quiet`, observations have ts with a watermark and
    a day is closed that many seconds behind its last row. Start the query inside state_in_rocksdb.
    """
    mode = "None" if quiet is None else "EventTime"
    return observations.groupBy("year", "day").transformWithStateInPandas(DayProcessor(quiet), DAY_FIGURES, "Update", mode)


def stream_dedup(events: DataFrame, keys: list[str], time: str = "ts", late: str = "1 day") -> DataFrame:
    """T3 as a stream: each key once within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def checkpointed(stream: DataFrame, path: str, checkpoint: str):
    """T4: a stream's new rows as Parquet, exactly once, until what is there has been read."""
    return stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
