"""The index by change and the build ledger: what a second run does, and what a run that stops leaves."""

from __future__ import annotations

import os
import zipfile
from pathlib import Path

import pytest

from cardmill.plans import incremental
from cardmill.sources import archiveindex, files, sinks


def put(path: Path, *names: str) -> None:
    with zipfile.ZipFile(path, "w") as z:
        for n in names:
            z.writestr(n, b"%PDF-" + n.encode())


def found(spark, table):
    return sorted((r.year, r.member) for r in archiveindex.indexed(spark, table).collect())


def test_unchanged_archives_are_not_opened(spark, tmp_path):
    folder, table = tmp_path / "zips", str(tmp_path / "index")
    folder.mkdir()
    assert archiveindex.refresh(spark, str(folder), table) == {"opened": [], "gone": []} and found(spark, table) == []
    put(folder / "2020.zip", "a", "b")
    put(folder / "2021.zip", "c")
    (folder / "2022.zip").write_bytes(b"no archive")
    assert len(archiveindex.refresh(spark, str(folder), table)["opened"]) == 3
    assert found(spark, table) == [(2020, "a"), (2020, "b"), (2021, "c")]
    # of the same size and time, but no archive any more: it would be an error to open it
    kept = os.stat(folder / "2020.zip")
    (folder / "2020.zip").write_bytes(b"x" * kept.st_size)
    os.utime(folder / "2020.zip", ns=(kept.st_atime_ns, kept.st_mtime_ns))
    assert archiveindex.refresh(spark, str(folder), table, permissive=False) == {"opened": [], "gone": []}
    assert found(spark, table) == [(2020, "a"), (2020, "b"), (2021, "c")]
    put(folder / "2021.zip", "c", "d")  # replaced
    put(folder / "2023-repair-1.zip", "e")  # new
    (folder / "2022.zip").unlink()  # gone
    changed = archiveindex.refresh(spark, str(folder), table, permissive=False)
    assert [p.rpartition("/")[2] for p in changed["opened"]] == ["2021.zip", "2023-repair-1.zip"] and [p.rpartition("/")[2] for p in changed["gone"]] == ["2022.zip"]
    assert found(spark, table) == [(2020, "a"), (2020, "b"), (2021, "c"), (2021, "d"), (2023, "e")]
    assert len(list((tmp_path / "index" / "members").glob("version=*"))) == 3


def test_a_refresh_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    folder, table = tmp_path / "zips", str(tmp_path / "index")
    folder.mkdir()
    put(folder / "2020.zip", "a")
    archiveindex.refresh(spark, str(folder), table)
    put(folder / "2020.zip", "a", "b")

    def dies(*_):
        raise OSError("full")

    monkeypatch.setattr(archiveindex, "replaced", dies)
    with pytest.raises(OSError, match="full"):
        archiveindex.refresh(spark, str(folder), table)
    assert found(spark, table) == [(2020, "a")]
    monkeypatch.undo()
    archiveindex.refresh(spark, str(folder), table)
    assert found(spark, table) == [(2020, "a"), (2020, "b")]


CARD = "I. Registration\nII. {}\n"


def variants(spark, mark: str):
    rows = [(y, f"{i:032x}", f"{y}/x_{i:032x}.pdf", CARD.format(mark), None) for y in (2020, 2021, 2022) for i in range(3)]
    return spark.createDataFrame(rows, "year int, doc_id string, member string, text string, error string")


def archives(spark, *years):
    return spark.createDataFrame([(y, f"{y}.zip") for y in years], "year int, archive string")


def test_a_build_that_stops_shows_old_years_whole(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    assert incremental.build_due(spark, variants(spark, "first"), archives(spark, 2020, 2021, 2022), root) == [2020, 2021, 2022]
    before = {y: (incremental.csv_of(root, y), Path(incremental.csv_of(root, y)).read_bytes()) for y in (2020, 2021, 2022)}
    assert all(len(files.annual_table(spark, [p]).collect()) == 3 for p, _ in before.values())
    assert incremental.build_due(spark, variants(spark, "again"), archives(spark, 2020, 2021, 2022), root) == []
    write = sinks.annual_csv

    def stops(records, year, *rest):
        if year == 2021:
            raise OSError("stopped")
        write(records, year, *rest)

    monkeypatch.setattr(sinks, "annual_csv", stops)
    with pytest.raises(OSError, match="stopped"):
        incremental.build_due(spark, variants(spark, "other"), archives(spark, 2020, 2021, 2022), root, force=True)
    now = {r["year"]: r["build"] for r in incremental.published(root)}
    assert now[2021] == now[2022] != now[2020]  # 2020 is new, the others are as they were
    assert {y: incremental.csv_of(root, y) for y in (2021, 2022)} == {y: before[y][0] for y in (2021, 2022)}
    assert all(Path(before[y][0]).read_bytes() == before[y][1] for y in (2021, 2022))
    assert incremental.records(spark, root).count() == 9
    monkeypatch.undo()
    # 2021 has another archive now; only it is due, and builds that no year names go
    changed = archives(spark, 2020, 2022).unionByName(spark.createDataFrame([(2021, "2021-new.zip")], "year int, archive string"))
    assert incremental.build_due(spark, variants(spark, "third"), changed, root) == [2021]
    assert len(list((tmp_path / "builds").iterdir())) == len({r["build"] for r in incremental.published(root)}) == 3
    assert {r.year: r.archive for r in incremental.reports(spark, root).collect()} == {2020: "2020.zip", 2021: "2021-new.zip", 2022: "2022.zip"}


def test_years_without_documents(spark, tmp_path):
    assert incremental.build_due(spark, variants(spark, "x"), archives(spark, 1990, 2020), str(tmp_path)) == [1990, 2020]
    assert files.annual_table(spark, [incremental.csv_of(str(tmp_path), 1990)]).count() == 0 and incremental.records(spark, str(tmp_path)).count() == 3
    assert incremental.build_due(spark, variants(spark, "x"), archives(spark, 1990, 2020), str(tmp_path)) == []
