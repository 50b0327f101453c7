import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cardmill.functions.language import field_language, with_languages
from cardmill.functions.profiles import Shape, detector, profiles, runs, scorer, words

SF = "/root/testdata/sf0.01"


def plain_runs(w, n):
    w = f" {w} "
    return [g for i in range(len(w) - n + 1) if (g := w[i : i + n]) != " "]


def plain_language(texts, text, longest=3):
    """Counts and scores of a profile, one run after the other."""
    counts = {}
    for lang, t in texts:
        for w in re.findall(r"[^\W\d_]+", (t or "").lower()):
            for n in range(1, longest + 1):
                counts.setdefault(lang, Counter()).update(plain_runs(w, n))
    known = set().union(*counts.values())
    v = Counter(len(r) for r in known)
    asked = [r for w in re.findall(r"[^\W\d_]+", text.lower()) for n in range(1, longest + 1) for r in plain_runs(w, n) if r in known]
    if not asked:
        return None
    score = {k: sum(math.floor(1000 * math.log((c[r] + 1) / (sum(m for x, m in c.items() if len(x) == len(r)) + v[len(r)] + 1))) for r in asked) for k, c in counts.items()}
    return min(score, key=lambda k: (-score[k], k))


def test_runs_of_words(spark):
    df = spark.createDataFrame([("a",), ("її",), ("long" * 5000,)], "w string")
    for n in (1, 2, 3, 5):
        assert [r.x for r in df.select(runs(F.col("w"), n).alias("x")).collect()] == [plain_runs(w, n) for w in ("a", "її", "long" * 5000)]
    assert spark.createDataFrame([("Є-1 ÀB_c",), ("",), (None,)], "t string").select(words(F.col("t")).alias("w")).collect() == [(["є", "àb", "c"],), ([],), (None,)]


def test_detector_is_that_of_plain_counts(spark):
    texts = [("uk", "Звіт про роботу та її результати"), ("uk", "Методи контролю якості"), ("en", "The report on results"), ("en", "methods of control"), ("de", "Bericht der Ergebnisse"), (None, "xyz"), ("fr", None), ("de", "")]
    profile = profiles(spark.createDataFrame(texts, "lang string, text string"))
    asked = ["Звіт IBM", "report ЗВТ", "Ergebnisse Звт", "123", "", "qqq ыыы", "results of методи", "the the про"]
    df = spark.createDataFrame([(t,) for t in [*asked, None, asked[0]]], "t string")
    got = df.select("t", detector(profile)(F.col("t")).alias("x")).collect()
    plain = [(k, t) for k, t in texts if k and t]
    assert [r.x for r in got] == [None if r.t is None else plain_language(plain, r.t) for r in got]
    assert detector(profile.limit(0)) and scorer(profile.limit(0)).language(["звіт"]) is None
    with pytest.raises(ValueError, match="more than 2 languages"):
        scorer(profile, Shape(languages=2))
    cut = profiles(spark.createDataFrame(texts, "lang string, text string"), Shape(most=5)).groupBy("lang").count().collect()
    assert {r["count"] for r in cut} == {5}


def test_short_fields_of_both_scripts(spark):
    texts = [("uk", "звіт про роботу та методи контролю якості"), ("en", "the report on results and methods of control"), ("de", "bericht der ergebnisse über verfahren")]
    short = detector(profiles(spark.createDataFrame(texts, "lang string, text string")))
    cases = [("Методи IBM", "uk"), ("Report ЗВТ", "en"), ("Verfahren ЗВТ", "mixed"), ("ыы qq", "unknown"), ("методи", "uk"), ("verfahren", "en"), ("", "empty"), (None, "empty"), ("я", "unknown"), ("звіт report " * 9, "mixed")]
    df = spark.createDataFrame(cases, "t string, want string")
    assert [(r.t, r.got) for r in df.select("t", field_language(F.col("t"), short).alias("got")).collect()] == cases
    from cardmill.functions.language import ROW_FIELDS, TEXT_FIELDS

    row = spark.createDataFrame([("Методи IBM",)], "title_uk string").withColumns({f: F.lit(None).cast("string") for f in TEXT_FIELDS if f != "title_uk"})
    out = with_languages(row, short).first()
    assert out.lang_title_uk == out.language == "uk" and out.lang_title_en == "empty" and "title_uk" in ROW_FIELDS


def test_held_out_lines(spark):
    """At most 5 % of the lines of 10 to 39 letters of other documents are taken for another language."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    short = detector(profiles(docs.filter("doc_id % 5 <> 0")))
    lines = docs.filter("doc_id % 5 = 0").select("lang", F.explode(F.split("text", r"[.!?|\n]+")).alias("line"))
    lines = lines.withColumn("letters", F.length(F.regexp_replace("line", r"[^\p{L}]", ""))).filter("letters BETWEEN 10 AND 39").dropDuplicates()
    r = lines.withColumn("said", short(F.col("line"))).agg(F.count("*"), F.count_if(F.coalesce("said", F.lit("")) != F.col("lang")))
    n, wrong = r.first()
    assert n > 500 and wrong <= 0.05 * n, (n, wrong)


def test_scores_of_words_are_held(spark):
    texts = [("uk", "звіт про роботу"), ("en", "the report on results"), ("de", "bericht der ergebnisse")]
    s = scorer(profiles(spark.createDataFrame(texts, "lang string, text string")))
    asked, known = [["звіт", "report"], ["qq"], ["report", "der", "report"], [], ["der", "звіт", "qq"]], {}
    want = [None if not w else plain_language(texts, " ".join(w)) for w in asked]
    assert [s.language(w, known, 2) for w in asked] == [s.language(w) for w in asked] == want
    assert len(known) == 2


def test_short_languages_deals_texts_and_counts_letters_once(spark):
    """Texts are dealt to tasks before they are cut, whatever the files' row groups; letters are counted on one side of the detector."""
    from cardmill.plans.queries_text import short_languages

    plan = short_languages(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("RoundRobinPartitioning")
    assert plan.count("[^A-Za-z]+") == 1
