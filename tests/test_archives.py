"""Archives written by the sink, read by ranges, consolidated; sorted hashes and samples of any size."""

from __future__ import annotations

import hashlib
import json
import random
import zipfile
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cardmill.operators import consolidate, variants
from cardmill.operators.numbering import numbered
from cardmill.plans.consolidation import MANIFEST, consolidate_archives
from cardmill.sources import yearzip, ziparchive

A, B, C = "a" * 32, "b" * 32, "c" * 32
ROWS = "year int, arcname string, content binary"


def names(folder: Path) -> list[str]:
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file())


# the index


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Two archives, one of 10 000 members, the other full of bytes that look like entries; and one that is none."""
    out, r = tmp_path_factory.mktemp("zips"), random.Random(1)
    with zipfile.ZipFile(out / "2022.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(10_000):
            z.writestr(f"2022/{'PK' if i % 7 == 0 else ''}{i}_é.pdf", ("%PDF" + "a" * r.randrange(300) + str(i)).encode())
    with zipfile.ZipFile(out / "2023.zip", "w") as z:
        for i in range(60):
            info = zipfile.ZipInfo(f"d/e{i}")
            info.comment = b"PK\x01\x02" * (500 if i == 0 else i % 30)
            z.writestr(info, b"PK\x01\x02" * i)
        z.mkdir("folder")
        z.comment = b"PK\x01\x02 a comment"
    (out / "2024.zip").write_bytes(b"nothing")
    return out


def directory_of(folder, *years):
    return [(y, i.filename, i.file_size, i.CRC) for y in years for i in zipfile.ZipFile(folder / f"{y}.zip").infolist()]


@pytest.mark.parametrize("size", [8000, 1 << 15, 4 << 20])
def test_members_by_ranges(spark, folder, size):
    m = ziparchive.zip_members(spark, ziparchive.year_archives(str(folder), range(2022, 2024)), range_bytes=size)
    assert m.rdd.getNumPartitions() > (10 if size < 1 << 20 else 1)
    rows = m.orderBy("year", "member_index").collect()
    assert [(r.year, r.member, r.bytes, r.crc) for r in rows] == directory_of(folder, 2022, 2023)


def test_contents_are_ranged_reads(spark, folder):
    m = ziparchive.zip_members(spark, ziparchive.year_archives(str(folder), range(2022, 2024)), content=True, content_bytes=1 << 17)
    assert m.rdd.getNumPartitions() > 4
    want = {}
    for y in (2022, 2023):
        z = zipfile.ZipFile(folder / f"{y}.zip")
        want |= {n: z.read(n) for n in z.namelist() if not n.endswith("/")}
    assert {r.member: bytes(r.content) for r in m.collect()} == want


def test_filters_choose_archives(spark, folder):
    """2024 is no archive; a filter that leaves it out never opens it."""
    all_ = ziparchive.year_archives(str(folder))
    assert ziparchive.zip_members(spark, all_).filter("year = 2022").count() == 10_000
    assert ziparchive.zip_members(spark, all_).filter("year < 2024 AND year >= 2023").count() == 61
    assert ziparchive.zip_members(spark, all_).filter(F.col("archive").isin(all_[1])).count() == 61
    assert ziparchive.zip_members(spark, all_).filter("year IN (2021, 2025)").collect() == []
    with pytest.raises(Exception, match="2024.zip"):
        ziparchive.zip_members(spark, all_).count()
    assert ziparchive.zip_members(spark, all_, permissive=True).filter("year > 2023").collect() == []


def test_damaged_members_are_errors(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "2022.zip", "w") as z:
        z.writestr("x.pdf", b"%PDF-content")
    data = (tmp_path / "2022.zip").read_bytes()
    (tmp_path / "2022.zip").write_bytes(data.replace(b"content", b"CONTENT"))
    with pytest.raises(Exception, match="bad CRC"):
        ziparchive.zip_members(spark, ziparchive.year_archives(str(tmp_path)), content=True).collect()


def test_large_archives_have_wide_records(tmp_path):
    """Sizes and places of eight bytes, and an end record of their own."""
    path = tmp_path / "2022.zip"
    with zipfile.ZipFile(path, "w", allowZip64=True) as z:
        with z.open("a", "w", force_zip64=True) as f:
            f.write(b"x" * 10)
        for i in range(70_000):
            z.writestr(f"m{i}", b"")
    import pyarrow.fs as fs

    with fs.LocalFileSystem().open_input_file(str(path)) as f:
        begin, end, base = ziparchive.directory(f)
        found = [e for _, e in ziparchive._entries(f, begin, end, base, begin, end)]
        assert len(found) == 70_001 and ziparchive.member_bytes(f, *found[0]) == b"x" * 10


# the sink


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    (tmp_path / "2021.zip").write_bytes(b"as before")
    bad = F.udf(lambda y, c: 1 / 0 if y == 2022 else c, "binary")
    rows = spark.createDataFrame([(y, f"{y}/{i}.pdf", b"%PDF") for y in (2020, 2021, 2022) for i in range(50)], ROWS)
    with pytest.raises(Exception, match="division by zero"):
        yearzip.archives(rows.withColumn("content", bad("year", "content")), str(tmp_path))
    assert names(tmp_path) == ["2021.zip"] and (tmp_path / "2021.zip").read_bytes() == b"as before"


def writer(folder) -> yearzip.Writer:
    return yearzip.Writer({"path": str(folder)}, ["year", "arcname", "content"])


def batch(*rows):
    return iter([pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.string(), pa.binary()))], ["year", "arcname", "content"])])


def test_repeated_attempts_publish_once(tmp_path):
    w = writer(tmp_path)
    lost = w.write(batch((2020, "2020/a.pdf", b"1"), (2021, None, None)))
    kept = w.write(batch((2020, "2020/a.pdf", b"1"), (2021, None, None)))
    with pytest.raises(ValueError, match="several tasks"):
        w.commit([lost, kept])
    assert not any(n.startswith("202") for n in names(tmp_path))
    w.commit([kept, None])
    assert names(tmp_path) == ["2020.zip", "2021.zip"]
    assert zipfile.ZipFile(tmp_path / "2021.zip").namelist() == ["2021/_manifest.json"]


def test_a_commit_that_died_is_finished_by_the_next(tmp_path):
    w = writer(tmp_path)
    files = w.write(batch((2020, "2020/a.pdf", b"1"), (2021, "2021/b.pdf", b"2"))).files
    (Path(w._attempts()) / "commit.json").write_text(json.dumps([[f.rpartition("/")[2], n] for _, n, f, _ in files]))
    Path(files[0][2]).rename(tmp_path / files[0][1])  # it died behind the first rename
    writing = writer(tmp_path)
    open_files = writing.write(batch((2023, "2023/x.pdf", b"3")))
    other = writer(tmp_path)
    other.commit([other.write(batch((2022, "2022/c.pdf", b"3")))])
    assert [n for n in names(tmp_path) if n.startswith("202")] == ["2020.zip", "2021.zip", "2022.zip"]
    writing.commit([open_files])  # a job that was still writing isn't disturbed
    assert names(tmp_path) == ["2020.zip", "2021.zip", "2022.zip", "2023.zip"]


def test_rows_of_a_year_must_lie_together(tmp_path):
    with pytest.raises(ValueError, match="several runs"):
        writer(tmp_path).write(batch((2020, "a", b""), (2021, "b", b""), (2020, "c", b"")))


def test_parts_of_a_large_year(spark, tmp_path):
    rows = spark.createDataFrame([(2020, f"2020/{i}.pdf", b"%PDF") for i in range(100)], ROWS)
    done = yearzip.archives(rows, str(tmp_path), parts=3).collect()
    assert sum(r.entries for r in done) == 100 and names(tmp_path) == ["2020-0.zip", "2020-1.zip", "2020-2.zip"]
    assert yearzip.archives(rows.limit(0), str(tmp_path / "none")).collect() == []


# consolidation


def put(path: Path, **members: bytes) -> None:
    with zipfile.ZipFile(path, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)


def test_consolidation_end_to_end(spark, tmp_path):
    """Two archives and a staged folder: four entries, one of them a copy and one a variant; a single archive; a year without any."""
    src, staged = tmp_path / "src", tmp_path / "staged"
    src.mkdir()
    put(src / "2022-a.zip", **{f"2022/2022-01-02/x_{A}.pdf": b"%PDF-one", f"2022/2022-01-02/x_{B}.pdf": b"%PDF-two", "2022/_manifest.json": b"{}"})
    put(src / "2022-b.zip", **{f"2022/2022-01-02/y_{A}.pdf": b"%PDF-one"})
    (staged / "2022" / "2022-03-04").mkdir(parents=True)
    (staged / "2022" / "2022-03-04" / f"z_{B}.pdf").write_bytes(b"%PDF-three")
    put(src / "2023-old.zip", **{f"2023/q_{C}.pdf": b"%PDF-c"})
    dry = consolidate_archives(spark, str(src), range(2022, 2025), [str(staged)], dry_run=True).collect()
    assert {r.year: r.action for r in dry} == {2022: "counted", 2023: "counted", 2024: "counted"} and len(names(src)) == 3
    report = {r.year: r for r in consolidate_archives(spark, str(src), range(2022, 2025), [str(staged)], backup=str(tmp_path / "backup")).collect()}
    assert {y: r.action for y, r in report.items()} == {2022: "merged", 2023: "validated_and_renamed", 2024: "created_empty"}
    r = report[2022]
    assert (r.source_pdf_entries, r.output_pdf_entries, r.identical_duplicate_entries_removed, r.variants_preserved) == (4, 3, 1, 1)
    assert r.source_doc_ids_sha256 == r.output_doc_ids_sha256 == hashlib.sha256(f"{A}\n{B}".encode()).hexdigest()
    assert names(src) == ["2022.zip", "2023.zip", "2024.zip"] and names(tmp_path / "backup") == ["2022-a.zip", "2022-b.zip"]
    with zipfile.ZipFile(src / "2022.zip") as z:
        assert z.testzip() is None and len(z.namelist()) == 4
        day = "2022/2022-03/2022-03-04"
        assert z.read(f"{day}/_variants/{B}/2_z_{B}.pdf") == b"%PDF-three"
        m = json.loads(z.read(f"2022/{MANIFEST}"))
        first, second = f"2022/2022-01/2022-01-02/x_{A}.pdf", f"2022/2022-01/2022-01-02/x_{B}.pdf"
        assert [a["doc_id"] for a in m["duplicate_aliases"]] == [A, B] and m["source_archives"] == ["2022-a.zip", "2022-b.zip"]
        assert m["duplicate_aliases"][0]["output_entries"] == [first] and m["duplicate_aliases"][1]["output_entries"] == [second, f"{day}/_variants/{B}/2_z_{B}.pdf"]
    with zipfile.ZipFile(src / "2024.zip") as z:
        assert z.namelist() == [f"2024/{MANIFEST}"] and json.loads(z.read(z.namelist()[0]))["source_pdf_entries"] == 0
    again = {r.year: r.action for r in consolidate_archives(spark, str(src), range(2022, 2025)).collect()}
    assert set(again.values()) == {"validated_and_renamed"}


@pytest.mark.parametrize(
    "members, error",
    [({"2022/unparsed.pdf": b"%PDF-x"}, "error_no_doc_id"), ({f"2022/x_{A}.pdf": b"no PDF"}, "error_invalid_pdf"), ({f"2022/x_{A}.pdf": b"%PDF-x"}, "error_target_exists")],
)
def test_consolidation_stops_before_it_writes(spark, tmp_path, members, error):
    put(tmp_path / "2022-a.zip", **members)
    put(tmp_path / ("2022.zip" if error == "error_target_exists" else "2022-b.zip"), **{f"2022/y_{B}.pdf": b"%PDF-y"})
    before = {n: (tmp_path / n).read_bytes() for n in names(tmp_path)}
    with pytest.raises(ValueError, match=error):
        consolidate_archives(spark, str(tmp_path), range(2022, 2023))
    assert {n: (tmp_path / n).read_bytes() for n in names(tmp_path)} == before


# sorted hashes and numbers


def test_id_digest_of_one_large_group(spark):
    ids = spark.range(300_000).select(F.lit(1).alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("doc_id"))
    rows = ids.unionByName(ids.limit(1000)).unionByName(spark.createDataFrame([(2, None), (3, "x"), (None, "y")], "g int, doc_id string"))
    want = hashlib.sha256("\n".join(sorted(hashlib.sha256(str(i).encode()).hexdigest() for i in range(300_000))).encode()).hexdigest()
    one = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert {r.g: r.id_digest for r in consolidate.id_digest(rows, ["g"]).collect()} == {1: want, 2: one(""), 3: one("x"), None: one("y")}
    assert "collect" not in consolidate.id_digest(rows, ["g"])._jdf.queryExecution().toString()


def test_numbers_along_a_global_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"), F.lit("x").alias("_range")).repartition(7)
    out = numbered(df, [F.col("v").desc()])
    rows = sorted((r.number, r.v) for r in out.collect())
    assert rows == list(enumerate(sorted((i * 7919 % 5003 for i in range(5000)), reverse=True), 1)) and out.columns == ["v", "_range", "number"] and out.rows == 5000
    assert numbered(df.limit(0), [F.col("v")]).collect() == []


@pytest.mark.parametrize("n, k", [(100, 7), (5, 10), (10, 10), (0, 3), (100, 0)])
def test_even_sample_of_all(spark, n, k):
    got = variants.even_sample(spark.range(n).repartition(3), k, "id")
    step = max(1, n // k) if k else 1
    assert sorted(r.id for r in got.collect()) == (list(range(n))[::step][:k] if k else list(range(n)))
    plan = got._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan


# archives of runs


def test_one_archive_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """No task takes a whole archive, which is one file all the same, in the order of its names."""
    text = lambda y, i: f"%PDF-{y}-{i}".encode() * (i % 50)
    rows = [(y, f"{y}/{i:04}é.pdf", text(y, i)) for y in (2020, 2021) for i in range(2000)] + [(2022, None, None)]
    made, joined, most = spark.createDataFrame(rows, ROWS).repartition(5), yearzip.joined, []
    monkeypatch.setattr(yearzip, "joined", lambda spark, job, runs, *a: most.append(max(r.n for r in runs)) or joined(spark, job, runs, *a))
    for stored in (True, False):
        out = tmp_path / str(stored)
        done = yearzip.archives(made, str(out), stored=stored, run_bytes=1 << 17).collect()
        assert [(r.year, r.entries) for r in done] == [(2020, 2000), (2021, 2000), (2022, 0)] and names(out) == ["2020.zip", "2021.zip", "2022.zip"]
        for y in (2020, 2021):
            with zipfile.ZipFile(out / f"{y}.zip") as z:
                assert z.testzip() is None and z.namelist() == [*(f"{y}/{i:04}é.pdf" for i in range(2000)), f"{y}/_manifest.json"]
                assert all(z.read(f"{y}/{i:04}é.pdf") == text(y, i) for i in range(0, 2000, 37)) and json.loads(z.read(f"{y}/_manifest.json")) == {"year": y, "pdf_count": 2000}
        assert zipfile.ZipFile(out / "2022.zip").namelist() == ["2022/_manifest.json"]
    assert max(most) < 1000


def runs_of(folder, *groups):
    w = yearzip.Writer({"path": str(folder), "runs": "true"}, ["year", "arcname", "content"])
    return w, [yearzip.Run(*r) for g in groups for r in w.write(batch(*g)).runs]


@pytest.mark.parametrize("inside_files", [True, False])
def test_runs_are_joined(spark, tmp_path, inside_files):
    """By places in one file and, where the storage has none, one behind the other."""
    w, runs = runs_of(tmp_path, [(2020, "c", b"3" * 99), (2020, "d", b"")], [(2020, "a", b"1"), (2020, "b", b"2")], [(2021, "x", b"4")])
    files = yearzip.joined(spark, w._attempts(), runs, "_m.json", True, inside_files)
    yearzip.published(str(tmp_path), w._attempts(), files)
    assert names(tmp_path) == ["2020.zip", "2021.zip"]
    z = zipfile.ZipFile(tmp_path / "2020.zip")
    assert z.testzip() is None and z.namelist() == ["a", "b", "c", "d", "2020/_m.json"] and z.read("c") == b"3" * 99


def test_runs_that_overlap_are_errors(tmp_path):
    _, runs = runs_of(tmp_path, [(2020, "a", b""), (2020, "c", b"")], [(2020, "b", b"")])
    with pytest.raises(ValueError, match="several tasks"):
        yearzip.ordered(runs)


def test_places_beyond_four_bytes(tmp_path):
    """With a limit of 300 bytes for one of 4 GB: the second run's entries and the end record are wide."""
    _, runs = runs_of(tmp_path, [(2020, "a", b"1" * 200)], [(2020, "b", b"2" * 200), (2020, "c", b"3")])
    runs = yearzip.ordered(runs)
    end = yearzip.placed(runs, 300)
    assert [r.wide for r in runs] == [False, True]
    with open(tmp_path / "whole.zip", "wb") as out:
        for r in runs:
            yearzip._members(r, out)
        for r in runs:
            assert out.tell() == r.entries_at and out.write(yearzip._moved(r)) == r.entries
        out.write(end)
    z = zipfile.ZipFile(tmp_path / "whole.zip")
    assert z.testzip() is None and z.namelist() == ["a", "b", "c"] and z.read("b") == b"2" * 200
    with ziparchive.located(str(tmp_path / "whole.zip"))[0].open_input_file(str(tmp_path / "whole.zip")) as f:
        for r in runs:
            yearzip._verify(r, f)


def test_a_damaged_run_publishes_nothing(spark, tmp_path):
    w, runs = runs_of(tmp_path, [(2020, "a", b"content")])
    data = Path(runs[0].path).read_bytes()
    Path(runs[0].path).write_bytes(data.replace(b"content", b"CONTENT"))
    with pytest.raises(Exception, match="bad CRC"):
        yearzip.joined(spark, w._attempts(), runs, "_m.json", True)
    assert names(tmp_path) and not any(n.startswith("2020") for n in names(tmp_path))
