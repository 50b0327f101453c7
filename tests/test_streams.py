"""Streams over several batches: state, timers, repeated batches, restarts; state files and repair reports."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cardmill.operators import repair
from cardmill.sources import files, sinks
from cardmill.streaming import intake, ledger

OBSERVED = "year int, day string, announced long, doc_id string, status string, ts timestamp"
STATUSES = ["ok", "skip", "notpdf", "server500", "fail", "page_fail"]


def stream(spark, folder, schema=OBSERVED):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))


def put(spark, folder, rows, n):
    spark.createDataFrame(rows, OBSERVED).coalesce(1).write.parquet(f"{folder}/{n}")


def progress(query):
    return [(p["numInputRows"], p["stateOperators"][0]["numRowsUpdated"], p["stateOperators"][0]["numRowsTotal"]) for p in query.recentProgress if p["numInputRows"]]


def test_days_over_batches_and_restarts(spark, tmp_path):
    r, rows = random.Random(5), []
    at = dt.datetime(2024, 1, 1)
    for n in range(5):
        some = [(2020, f"d{r.randrange(4)}", 6 if r.random() < 0.2 else None, f"i{r.randrange(8)}", r.choice(STATUSES[: 6 if n == 2 else 5]), at) for _ in range(40)]
        rows += some
        put(spark, tmp_path / "in", some, n)
        with intake.state_in_rocksdb(spark):  # each run is a restart
            q = ledger.started(intake.stream_days(stream(spark, tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state"), "update")
            q.awaitTermination()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").endswith("HDFSBackedStateStoreProvider") or not spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    got = {r.day: r for r in ledger.latest(ledger.appended(spark, str(tmp_path / "out"), intake.DAY_FIGURES), ["year", "day"]).collect()}
    for day in {x[1] for x in rows}:
        own = [x for x in rows if x[1] == day]
        ids = {x[3] for x in own if x[4] in intake.TERMINAL}
        failed = sum(x[4] == "page_fail" for x in own)
        announced = max((x[2] for x in own if x[2]), default=None)
        assert (got[day].announced, got[day].listed, got[day].failed, got[day].complete) == (announced, len(ids), failed, failed == 0 and announced == len(ids))


def test_a_batch_writes_what_it_brings(spark, tmp_path):
    """A day of a thousand ids: a later batch of three rows doesn't write them again."""
    at = dt.datetime(2024, 1, 1)
    put(spark, tmp_path / "in", [(2020, "d", 1003, f"i{k}", "ok", at) for k in range(1000)], 0)
    put(spark, tmp_path / "in", [(2020, "d", None, f"j{k}", "ok", at) for k in range(3)], 1)
    with intake.state_in_rocksdb(spark):
        q = ledger.started(intake.stream_days(stream(spark, tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state"), "update")
        q.awaitTermination()
    (n0, updated0, _), (n1, updated1, total) = sorted(progress(q), reverse=True)
    assert (n0, n1) == (1000, 3) and updated0 >= 1000 and updated1 <= 5 and total >= 1003
    last = ledger.latest(ledger.appended(spark, str(tmp_path / "out"), intake.DAY_FIGURES), ["year", "day"]).first()
    assert last.listed == 1003 and last.complete


def test_timers_close_quiet_days(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    put(spark, tmp_path / "in", [(2020, "d", 1, "a", "ok", at)], 0)
    put(spark, tmp_path / "in", [(2020, "e", 1, "b", "fail", at + dt.timedelta(hours=5))], 1)
    put(spark, tmp_path / "in", [(2020, "f", 1, "c", "ok", at + dt.timedelta(hours=9))], 2)
    with intake.state_in_rocksdb(spark):
        days = intake.stream_days(stream(spark, tmp_path / "in").withWatermark("ts", "1 minute"), quiet=3600)
        q = ledger.started(days, str(tmp_path / "out"), str(tmp_path / "state"), "update")
        q.awaitTermination()
    final = {r.day: r.complete for r in ledger.appended(spark, str(tmp_path / "out"), intake.DAY_FIGURES).filter("final").collect()}
    assert final["d"] is True and "f" not in final and final.get("e", False) is False


def test_a_repeated_batch_appends_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, line string")
    write = ledger.append_once(str(tmp_path))
    assert ledger.appended(spark, str(tmp_path), rows.schema).collect() == []
    write(rows, 0)
    write(rows, 0)
    rows.write.parquet(str(tmp_path / "batches" / "1"))  # a batch that died before its entry
    assert ledger.appended(spark, str(tmp_path), rows.schema).count() == 2
    write(rows.limit(1), 1)
    got = ledger.appended(spark, str(tmp_path), rows.schema)
    assert sorted((r.batch_id, r.id) for r in got.collect()) == [(0, 1), (0, 2), (1, 1)] and ledger.entered(str(tmp_path)) == [0, 1]
    assert {r.id: r.line for r in ledger.latest(got, ["id"]).collect()} == {1: "a", 2: "b"}


def test_responses_are_read_once(spark, tmp_path):
    day = tmp_path / "in" / "2022" / "2022-01-02"
    day.mkdir(parents=True)

    def run():
        s = ledger.saved_responses(spark, str(tmp_path / "in"), per_batch=2)
        status = intake.response_status(F.col("code"), F.col("body"), F.col("attempt"), F.lit(3), F.lit(False))
        q = ledger.started(s.select("year", "day", "doc_id", "attempt", status.alias("status")), str(tmp_path / "out"), str(tmp_path / "state"))
        q.awaitTermination()
        return sum(1 for p in q.recentProgress if p["numInputRows"])

    for name, body in {"a.0": b"200\n%PDF-x", "b.0": b"404\n", "c.0": b"500\n", "d.2": b"200\n<html>", "e.1": b"000\n"}.items():
        (day / name).write_bytes(body)
    (day / "notes").write_bytes(b"no response")
    assert run() == 3  # six files, two a batch
    (day / "e.2").write_bytes(b"200\n%PDF-late")
    run()
    rows = ledger.appended(spark, str(tmp_path / "out"), "year int, day string, doc_id string, attempt int, status string").collect()
    assert sorted((r.doc_id, r.attempt, r.status) for r in rows) == [("a", 0, "ok"), ("b", 0, "notpdf"), ("c", 0, "server500"), ("d", 2, "fail"), ("e", 1, "retry"), ("e", 2, "ok")]


STATE = "year int, day string, date_to string, site_total long, doc_ids array<string>, no_pdf_doc_ids array<string>, server500_doc_ids array<string>, completed_at_utc string, accepted_error string, additional_logged_statuses array<string>"


def whole_year(y, skip=()):
    return [(dt.date(y, 1, 1) + dt.timedelta(days=i)).isoformat() for i in range(366 if y % 4 == 0 else 365) if i not in skip]


def test_state_round_trip(spark, tmp_path):
    rows = [(2022, d, d, 1, ["A", "b"], [], ["b"] if d.endswith("-05") else [], "t", None, ["fail"]) for d in whole_year(2022)] + [(2023, "2023-01-01", "x", None, None, None, None, None, None, None)]
    state = spark.createDataFrame(rows, STATE)
    done = {r.year: r for r in sinks.save_state(state, str(tmp_path)).collect()}
    sinks.save_state(state, str(tmp_path)).collect()  # again, in place
    assert sorted(p.name for p in tmp_path.iterdir()) == ["repair_state_2022.json", "repair_state_2023.json"] and done[2022].days == 365
    back = files.repair_state(spark, [r.path for r in done.values()])
    assert sorted(map(tuple, back.select(*STATE.replace(",", "").split()[::2]).collect()), key=repr) == sorted(map(tuple, state.collect()), key=repr)
    assert sinks.save_state(state.limit(0), str(tmp_path)).collect() == []


@pytest.mark.parametrize("total, complete", [(4, True), (5, False), (None, False)])
def test_annual_report(spark, total, complete):
    state = [(2022, d, d, 1, {"2022-01-01": ["A", "b"], "2022-01-02": ["c", "d", "b"]}.get(d, []), ["c"] if d == "2022-01-02" else [], ["d"] if d == "2022-01-02" else [], None, None, ["fail"] if d == "2022-01-02" else None) for d in whole_year(2022)]
    years, ids = spark.createDataFrame([(2022,), (2023,)], "year int"), lambda *x: spark.createDataFrame([(2022, i) for i in x], "year int, doc_id string")
    report = repair.annual_repair_report(years, spark.createDataFrame(state, STATE), ids("a"), ids("B"), ids("extra"), spark.createDataFrame([(2022, total), (2023, 0)], "year int, annual_total long"), spark.createDataFrame([(2022, "z")], "year int, archive string"))
    r, empty = report.orderBy("year").collect()
    assert (r.complete, r.annual_site_total, r.daily_unique_site_doc_ids, r.confirmed_no_pdf, r.confirmed_server500, r.unresolved, r.extra_pdf_ids_not_in_current_site_year) == (complete, total, 4, 1, 1, 0, 1)
    assert r.accepted_server500_dates == ["2022-01-02"] and r.accepted_server500_dates_with_additional_errors == {"2022-01-02": ["fail"]} and r.unfinished_dates == [] and r.archives_used == ["z"]
    assert not empty.complete and len(empty.unfinished_dates) == 365 and empty.annual_site_total is None and empty.daily_unique_site_doc_ids == 0
    lines = [x.value for x in repair.repair_lines(report, spark.createDataFrame([(2023, "2023-01-01", ["fail", "page_fail"])], "year int, day string, statuses array<string>")).collect()]
    assert len(lines) == 365 and "2023 | 2023-01-01 | fail,page_fail | _repair_report_2023.json | errors_2023.txt" in lines and "2023 | 2023-01-02 | - | _repair_report_2023.json | errors_2023.txt" in lines


def test_log_summary(spark):
    log = spark.createDataFrame([(2022, "d1", "fail"), (2022, "d1", "fail"), (2022, "d1", "page_fail"), (2022, "d2", "fail")], "year int, day string, status string")
    r = repair.log_summary(log).first()
    assert r.counts_by_status == {"fail": 3, "page_fail": 1} and r.statuses_by_date == {"d1": ["fail", "page_fail"], "d2": ["fail"]}
