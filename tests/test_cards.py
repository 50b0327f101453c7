"""Truth tables of the card operators, and whole flows over archives made here."""

from __future__ import annotations

import itertools
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from cardmill import schemas
from cardmill.functions import text as X
from cardmill.functions import udfs
from cardmill.operators import consolidate, duplicates, fields, reconcile, sections, variants
from cardmill.plans import build, queries_text
from cardmill.sources import files, sinks, ziparchive
from cardmill.streaming import intake

A, B, C = "a" * 32, "b" * 32, "c" * 32


def value(spark, expression, **columns):
    kinds = ", ".join(f"{k} {'array<int>' if isinstance(v, list) else 'string'}" for k, v in columns.items())
    return spark.createDataFrame([tuple(columns.values())], kinds).select(expression.alias("x")).first().x


def test_schemas_have_their_sizes():
    assert (len(fields.DATA_COLUMNS), len(schemas.TABLE_COLUMNS), len(schemas.DUPLICATE_COLUMNS), len(schemas.ACCOUNT_COLUMNS), len(schemas.MANIFEST_COLUMNS), len(schemas.ISSUE_COLUMNS), len(schemas.OLD_COLUMNS)) == (73, 135, 46, 22, 11, 8, 123)
    assert len(set(schemas.TABLE_COLUMNS)) == 135


def test_page_text_keeps_references_that_lack_their_semicolon_when_asked(spark):
    html = "<p>a&amp;b &lt;i&gt; &#1110;&#x456; &nope; les&&amp<i>&amp;nbsp; x&copy 5&nbsp;</p>"
    closed = X.page_text(F.col("h"), lambda c: udfs.html_unescape(c, closed=True))
    assert value(spark, closed, h=html) == "a&b <i> іі &nope; les&&amp &nbsp; x&copy 5"
    assert value(spark, X.page_text(F.col("h"), udfs.html_unescape), h="les&&amp</p>") == "les&&"


@pytest.mark.parametrize("name, expected", [(f"0222U001232_{A}.pdf", A), (f"x/0222U001232_{A}(1).pdf", A), (f"2_0224U031550_{B.upper()}.pdf", B), ("none.pdf", None), (f"{A}_{B}.pdf", B), (f"{A}/x.pdf", None)])
def test_doc_id(spark, name, expected):
    assert value(spark, X.doc_id_from_name(F.col("n")), n=name) == expected


@pytest.mark.parametrize("name, expected", [(f"2_0224U031550_{A}.pdf", "0224U031550"), (f"0222U001232_{A}.pdf", "0222U001232"), ("0221Є12.pdf", "0221Є12"), ("x.pdf", "")])
def test_registration(spark, name, expected):
    assert value(spark, X.registration_from_name(F.col("n")), n=name) == expected


@pytest.mark.parametrize("text, expected", [("\xa0 a \x1c", "a"), ("\n\t", ""), ("a b", "a b")])
def test_strip_is_unicode(spark, text, expected):
    assert value(spark, X.strip(F.col("t")), t=text) == expected == text.strip()


def brute_rising(values):
    best = []
    for n in range(len(values), 0, -1):
        found = [c for c in itertools.combinations(range(len(values)), n) if all(values[a] < values[b] for a, b in itertools.pairwise(c))]
        if found:
            end = max(c[-1] for c in found)
            best = [c for c in found if c[-1] == end]
            break
    # from the end back, always the earliest predecessor that is itself the end of a longest run of its length
    return best


def test_rising_headers_against_brute_force(spark):
    rng = random.Random(5)
    cases = [[rng.randint(1, 6) for _ in range(rng.randint(0, 7))] for _ in range(150)] + [[1, 2, 5, 3, 10]]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, v array<int>").select("i", sections.longest_rising(F.col("v")).alias("got")).collect()
    for r in rows:
        want = brute_rising(cases[r.i])
        if not want:
            assert r.got == []
            continue
        assert tuple(g - 1 for g in r.got) in want
    assert [r.got for r in rows if cases[r.i] == [1, 2, 5, 3, 10]][-1] == [1, 2, 3, 5]


def test_sections_rules(spark):
    text = "I. Перша\nа: 1\nII. Лише назва\nIII. Назва: з двокрапкою\nx\nX. Кінець\n\nд: 1"
    got = value(spark, sections.split_sections(F.col("t")), t=text)
    assert got["I"] == "а: 1" and got["II"] == "" and got["III"] == "Назва: з двокрапкою\nx" and got["X"] == "д: 1" and got["V"] == "" and len(got) == 10
    assert set(value(spark, sections.split_sections(F.col("t")), t=None).values()) == {""}


def test_organizations_keep_a_blank_name(spark):
    blank = f"{fields.ORGANIZATION}:\nКод за ЄДРПОУ: 1"
    assert value(spark, fields.organization_name(F.col("t")), t=blank) == ""
    two = f"{fields.ORGANIZATION}: Перша\nКод за ЄДРПОУ: 11\nТелефон: 5\n{fields.ORGANIZATION}:\nКод за ЄДРПОУ: 22\n{fields.CONTRIBUTION}: частка"
    assert json.loads(value(spark, fields.co_performers(F.col("t")), t=two)) == [{"name": "Перша", "edrpou": "11", "phone": "5"}, {"edrpou": "22", "contribution": "частка"}]
    loose = json.loads(value(spark, fields.co_performers(F.col("t"), strict_names=False), t=two))
    assert loose[1]["name"] == f"{fields.LABEL_LEAK}:"
    assert value(spark, fields.co_performers(F.col("t")), t="щось: інше") == "щось: інше"
    assert value(spark, fields.co_performers(F.col("t")), t="без мітки") == ""


def test_leaders_and_closing(spark):
    text = f"{fields.LEADER}: Перший\nНауковий ступінь: к.т.н.\n{fields.ORCID_OTHER}: 0000\n{fields.LEADER}:\nДругий\nДодаткова інформація:\n"
    assert json.loads(value(spark, fields.research_leaders(F.col("t")), t=text)) == [{"name": "Перший", "degree": "к.т.н.", "orcid": "0000"}, {"name": "Другий"}]
    end = "Керівник юридичної особи\nІван\nПетренко\nВідповідальний за підготовку\nоблікових документів\nЗоя\nРеєстратор\nК"
    got = value(spark, F.to_json(F.struct(*(v.alias(k) for k, v in fields.closing(F.col("t")).items()))), t=end)
    assert json.loads(got) == {"org_head": "Іван\nПетренко", "executors": "", "document_preparer": "Зоя", "document_preparer_phone": "", "registrar": "К"}


CARD = f"I. Загальні\nДержавний обліковий номер: %s\nIII. Виконавець\n{fields.ORGANIZATION}: Інститут\nVII. Тема\nНазва роботи українською: Назва %s\nНазва роботи англійською: Title\nРеферат українською: Текст реферату про роботу\nРеферат англійською: Abstract of the work\n{fields.LEADER}: Особа"


def test_best_records(spark):
    reg = "0222U000001"
    rows = [
        (2022, A, f"2022/{reg}_{A}.pdf", CARD % (reg, "перша"), None), (2022, A, f"2022/{reg}_{A}(1).pdf", CARD % (reg, "перша довша"), None),
        (2022, B, f"2022/{reg}_{B}.pdf", CARD % ("0222U000009", "друга"), None), (2022, B, f"2022/z_{B}.pdf", None, "Error: damaged"),
        (2022, C, f"2022/b_{C}.pdf", None, "Error: b"), (2022, C, f"2022/a_{C}.pdf", None, "Error: a"),
    ]
    out = build.build_tables(spark.createDataFrame(rows, "year int, doc_id string, member string, text string, error string"))
    got = {r.doc_id: r for r in schemas.projected(out["records"], schemas.TABLE_COLUMNS).collect()}
    a, b, c = got[A], got[B], got[C]
    assert a.source_member.endswith("(1).pdf") and a.title_uk == "Назва перша довша" and a.registration_number_matches_filename == "yes" and a.language == "uk" and a.lang_title_en == "en" and a.pdf_variant_count == 2
    assert a.extraction_status == "warning" and a.quality_warnings == "few_nonempty_sections" and a.missing_critical_fields == "" and a.section_count == 3
    assert b.quality_warnings == "few_nonempty_sections;registration_number_mismatch;other_variant_parse_failed" and b.extraction_error == f"2022/z_{B}.pdf: Error: damaged"
    assert c.extraction_status == "failed" and c.source_member == f"2022/a_{C}.pdf" and c.extraction_error == f"2022/a_{C}.pdf: Error: a | 2022/b_{C}.pdf: Error: b" and c.language == "unknown" and c.section_count == 0
    assert c.missing_critical_fields.count(";") == 6 and json.loads(c.source_variants) == [f"2022/a_{C}.pdf", f"2022/b_{C}.pdf"]
    assert out["annual"].first().failed == 1 and out["issues"].count() == 3
    plan = variants.best_records(spark.createDataFrame(rows, "year int, doc_id string, member string, text string, error string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.fixture()
def folder(tmp_path):
    with zipfile.ZipFile(tmp_path / "2022.zip", "w") as z:
        z.writestr(f"2022/2022-01-02/x_{A}.pdf", b"%PDF-one")
        z.writestr(f"2022/2022-01-02/x_{A}(1).pdf", b"%PDF-two")
        z.writestr("manifest.json", "{}")
        z.writestr("unparsed.pdf", b"%PDF-")
    with zipfile.ZipFile(tmp_path / "2022-repair-1.zip", "w") as z:
        z.writestr(f"2022/2022-01-02/y_{A}.pdf", b"%PDF-one")
        z.writestr(f"2022/y_{B}.PDF", b"%PDF-three")
    (tmp_path / "notes.zip").write_bytes(b"no")
    (tmp_path / "2023.zip").write_bytes(b"no zip")
    return tmp_path


def test_archives(spark, folder):
    all_, plain = ziparchive.year_archives(str(folder), range(2022, 2023)), ziparchive.year_archives(str(folder), range(2022, 2023), repair=False)
    assert [p.rsplit("/")[-1] for p in all_] == ["2022-repair-1.zip", "2022.zip"] and len(plain) == 1
    names = ziparchive.zip_members(spark, ziparchive.year_archives(str(folder)), permissive=True)
    assert names.count() == 6 and "content" not in names.columns and names.rdd.getNumPartitions() == 3
    from cardmill.operators.validate import collect_members

    got = {r.doc_id: r.members for r in collect_members(names).collect()}
    assert got[None] == ["unparsed.pdf"] and len(got[A]) == 3 and got[B] == [f"2022/y_{B}.PDF"]
    assert ziparchive.usable_archives(names).count() == 2
    refs = consolidate.source_refs(ziparchive.zip_members(spark, all_, content=True))
    assert consolidate.inventory(refs).first().asDict() == {"year": 2022, "physical": 6, "unparsed": 2, "doc_ids": 2}
    plan = build.consolidate(refs.filter("doc_id IS NOT NULL"))
    counts = plan["counts"].first()
    assert (counts.source_entries, counts.output_entries, counts.identical_duplicates, counts.variants) == (4, 3, 1, 1)
    arcs = sorted(r.arcname for r in plan["entries"].collect())
    assert arcs == [f"2022/2022-01/2022-01-02/_variants/{A}/2_x_{A}_1_.pdf".replace("_1_", "(1)"), f"2022/2022-01/2022-01-02/y_{A}.pdf", f"2022/_undated/y_{B}.PDF"]
    content = refs.select(X.digest(F.col("content")).alias("sha256"), "content").dropDuplicates(["sha256"])
    done = sinks.archives(plan["entries"].join(content, "sha256"), str(folder), stored=False).first()
    with zipfile.ZipFile(done.path) as z:
        assert sorted(n for n in z.namelist() if "manifest" not in n) == arcs and z.testzip() is None


def test_annual_csv_round_trip(spark, tmp_path):
    rows = [(B, 2022, 'quote " and\nline', None), (A, 2022, "є", "x")]
    df = spark.createDataFrame(rows, "doc_id string, year int, title_uk string, registrar string")
    target = str(tmp_path / "output_2022.csv")
    sinks.annual_csv(df, 2022, target)
    assert open(target, "rb").read(3) == sinks.BOM
    back = files.annual_table(spark, [target]).collect()
    assert [r.doc_id for r in back] == [A, B] and back[1].title_uk == 'quote " and\nline' and back[1].registrar == "" and len(back[0]) == 135
    sinks.tsv(df.select("doc_id", "title_uk"), str(tmp_path / "r.tsv"), ["id", "t"], ["doc_id"])
    assert (tmp_path / "r.tsv").read_text().splitlines() == ["id\tt", f"{A}\tє", f'{B}\tquote " and line']
    sinks.store(df, str(tmp_path / "store"))
    assert spark.read.parquet(str(tmp_path / "store")).count() == 2


def test_state_and_logs(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"version": 1, "year": 2022, "days": {"2022-01-01": {"doc_ids": [A.upper(), B], "no_pdf_doc_ids": [B], "server500_doc_ids": [C]}}}))
    (tmp_path / "bad.json").write_text("{")
    state = files.repair_state(spark, [str(tmp_path / "s.json"), str(tmp_path / "bad.json")])
    assert {r.doc_id for r in files.state_ids(state, "doc_ids").collect()} == {A, B}
    assert reconcile.register(state, "no_pdf_doc_ids").first().days == "2022-01-01"
    lines = ["t | 2022-01-01 | count_mismatch | - | - | сайт объявил 5, собрано уникальных doc_id 3 | u", "t | 2022-01-01 | count_mismatch | - | - | сайт объявил 9, собрано уникальных doc_id 8 | u", "t | 2022-01-02 | page_fail | - | - | x | u", "short | line"]
    log = reconcile.error_log(spark.createDataFrame([(2022, i, x) for i, x in enumerate(lines)], "year int, line_no long, value string"))
    gaps = {r.day: r.gap for r in reconcile.listing_gaps(log, log.select("year", "day")).collect()}
    assert gaps == {"2022-01-01": 1, "2022-01-02": None}


VARIANT = dict(readable=True, text_sha256="t", render_sha256="r", reg_file="1", reg="1", state="s", title="n")


@pytest.mark.parametrize(
    "changes, expected",
    [
        ([{"readable": False}, {"readable": False}], "all_variants_unreadable"),
        ([{}, {"readable": False}], "same_publication_one_variant_unreadable"),
        ([{"reg": ""}, {"readable": False, "reg_file": "2"}], "ambiguous_unreadable_variant"),
        ([{}, {}], "same_publication_identical_text_and_render"),
        ([{}, {"render_sha256": "q"}], "same_publication_identical_text_render_differs"),
        ([{}, {"text_sha256": "u"}], "same_publication_revised_pdf"),
        ([{}, {"text_sha256": "u", "title": "m"}], "same_publication_revised_pdf"),
        ([{}, {"text_sha256": "u", "title": "m", "reg": "2"}], "different_publications_same_doc_id"),
        ([{"title": ""}, {"text_sha256": "u", "title": "m", "state": ""}], "ambiguous_content_difference"),
    ],
)
def test_classification(spark, changes, expected):
    rows = [tuple((VARIANT | c).values()) for c in changes]
    df = spark.createDataFrame([(rows,)], "v array<struct<readable:boolean, text_sha256:string, render_sha256:string, reg_file:string, reg:string, state:string, title:string>>")
    assert df.select(duplicates.classify(F.col("v"))["classification"].alias("x")).first().x == expected


def test_duplicate_audit(spark):
    rows = [(2022, A, f"{A}.pdf", b"%PDF-1", 1, 1, CARD % ("0222U1", "x"), "r", None), (2022, A, f"{A}(1).pdf", b"%PDF-22", 1, 1, CARD % ("0222U1", "x"), "r", None), (2022, B, f"{B}.pdf", b"%PDF-", 1, 1, "", "r", None)]
    v = spark.createDataFrame(rows, "year int, doc_id string, member string, content binary, pages int, opened_pages int, text string, render_sha256 string, error string")
    seen = duplicates.inspected(v, variants.parsed(v))
    groups = duplicates.audit_groups(seen, spark.createDataFrame([(A, f"{A}.pdf")], "doc_id string, source_member string"))
    r = duplicates.duplicate_rows(groups).first()
    assert r.classification == "same_publication_identical_text_and_render" and r.selected_member == f"{A}(1).pdf" and r.table_selection_matches_audit == "no" and r.member_b_bytes == "6" and r.render_equal == "yes"
    assert duplicates.duplicate_totals(groups).first().table_selection_mismatches == 1


def test_documents_through_a_backend(spark):
    def backend(data):
        if b"bad" in data:
            raise ValueError("damaged")
        yield "<p>I.&nbsp;A</p>", 1, 1, b"x"
        yield "<p>b   c</p>", 1, 1, data

    m = spark.createDataFrame([(2022, f"{A}.pdf", b"%PDF-ok"), (2022, f"{B}.pdf", b"bad"), (2022, "x.json", b"")], "year int, member string, content binary")
    got = {r.doc_id: r for r in build.document_texts(m, backend).collect()}
    assert got[A].text == "I. A\nb c" and got[A].pages == 2 and len(got[A].render_sha256) == 64 and got[A].error is None
    assert got[B].text is None and got[B].error == "ValueError: damaged" and len(got) == 2


def test_days_as_a_stream_state():
    import pandas as pd

    class Value:
        v = None

        def exists(self):
            return self.v is not None

        def get(self):
            return self.v

        def update(self, v):
            self.v = v

    class Map(dict):
        containsKey = dict.__contains__  # noqa: N815
        updateValue = dict.__setitem__  # noqa: N815

    class Handle:
        getMapState = staticmethod(lambda *_: Map())  # noqa: N815
        getValueState = staticmethod(lambda *_: Value())  # noqa: N815

    day = intake.DayProcessor(None)
    day.init(Handle())
    rows = lambda announced, ids, status: next(day.handleInputRows((2022, "d"), iter([pd.DataFrame({"announced": announced, "doc_id": ids, "status": status})]), None))
    first, again, last = rows([2], [A], ["ok"]), rows([None], [A], ["skip"]), rows([None, None], [B, C], ["server500", "fail"])
    assert [bool(x.complete[0]) for x in (first, again, last)] == [False, False, True] and last.listed[0] == 2


def test_control_equalities_raise(spark):
    ok = spark.range(1).select(F.lit(True).alias("a"))
    reconcile.ensure(ok)
    with pytest.raises(ValueError, match="b"):
        reconcile.ensure(ok.withColumn("b", F.lit(False)))


def test_languages_of_all_kinds(spark):
    from cardmill.functions.language import field_language, row_language

    cases = [("ж" * 90 + "a" * 10, "uk"), ("ж" * 50 + "a" * 50, "mixed"), ("ж" * 10 + "a" * 90, "en"), ("ж", "unknown"), (" \n\t", "empty"), ("", "empty"), (None, "empty"), ("ж" * 20000 + "a" * 20000, "mixed"), ("123 456", "unknown")]
    df = spark.createDataFrame(cases, "t string, want string")
    for r in df.select("t", "want", field_language(F.col("t")).alias("got"), row_language([F.col("t")]).alias("row")).collect():
        assert r.got == r.want and r.row == ("unknown" if r.want == "empty" else r.want), r.want


def test_archives_are_verified(spark, tmp_path):
    rows = [(2020, f"2020/{i}.pdf", b"%PDF" + bytes([i])) for i in range(30)] + [(2021, None, None)]
    done = sinks.archives(spark.createDataFrame(rows, "year int, arcname string, content binary"), str(tmp_path)).collect()
    assert sorted((r.year, r.entries) for r in done) == [(2020, 30), (2021, 0)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["2020.zip", "2021.zip"]
    twice = sinks.archives(spark.createDataFrame(rows[:5], "year int, arcname string, content binary"), str(tmp_path)).collect()
    assert [r.entries for r in twice] == [5] and sorted(p.name for p in tmp_path.iterdir()) == ["2020.zip", "2021.zip"]


def test_tables_of_years_without_rows(spark, tmp_path):
    df = spark.createDataFrame([(2022, "a", 'x "q"\nline')], "year int, doc_id string, title_uk string")
    for year, lines in ((2022, 3), (2023, 1)):
        target = str(tmp_path / f"{year}.csv")
        sinks.annual_csv(df, year, target, ["year", "doc_id", "title_uk"])
        data = open(target, "rb").read()
        assert data.startswith(b"\xef\xbb\xbf") and data.count(b"\n") == lines
    assert sorted(p.name for p in tmp_path.iterdir()) == ["2022.csv", "2023.csv"]


def test_a_large_year_is_not_one_tasks(spark, tmp_path):
    """Its table and the staged parts of its CSV are dealt by ranges of ids; the file has one header and its rows in order."""
    rows = [(2022, f"{(7 * i) % 400:032x}", f"t{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "year int, doc_id string, title_uk string").repartition(3)
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # so few rows are put together again
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        sinks.store(df, str(tmp_path / "store"))
        sinks.annual_csv(df, 2022, str(tmp_path / "2022.csv"), ["year", "doc_id", "title_uk"])
    finally:
        spark.conf.set(key, before)
    assert len(list((tmp_path / "store" / "year=2022").glob("*.parquet"))) > 1
    lines = (tmp_path / "2022.csv").read_text("utf-8-sig").splitlines()
    assert lines == ["year,doc_id,title_uk", *(f"{y},{i},{t}" for y, i, t in sorted(rows))]


def test_rows_are_dealt_by_their_number(spark):
    assert queries_text.spread(spark.range(50), rows=5).rdd.getNumPartitions() == 10
    assert queries_text.spread(spark.range(50)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
