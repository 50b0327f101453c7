"""Fill in the middle: texts cut in three at token ranks and put together with the middle last.

A token is a run of white space and the run of other characters behind it, or white space at the end. A matcher goes over the
text's bytes twice and holds one match at a time: the first pass counts tokens, the second advances to both ranks
and stops there; neither makes a list of tokens nor a copy of the text. Ranks and form come from a hash of seed and
doc_id, so they don't depend on partitions. The cuts travel as two numbers; texts stay in the JVM.

A text that holds a mark already stays plain, so a mark occurs once in each output and `restored` can't go wrong: marks begin with "<" and
hold it once, so none overlaps another or arises where pieces meet.

Nulls: a null text is empty, an empty text is plain with no tokens; a null doc_id hashes as "<seed>:". Repeated rows are transformed
alike. An empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import re
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import arrow_limits, documents
from .words import release

TOKEN = re.compile(rb"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_STEP = 1 << 20


def cut(text: memoryview, h1: int, h2: int) -> tuple[int, int, int]:
    """The number of tokens, and the bytes where prefix and middle end."""
    n = sum(1 for _ in TOKEN.finditer(text))
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    matches, ends, at = TOKEN.finditer(text), [], 0
    for k in (first, second - first):
        for m in islice(matches, k):
            at = m.end()
        ends.append(at)
    return n, *ends


def code_points(text: memoryview) -> int:
    """Bytes that begin a character, counted in steps."""
    return sum(int(np.count_nonzero((np.frombuffer(text[i : i + _STEP], np.int8)) > -65)) for i in range(0, len(text), _STEP))


def _cuts(text: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
    out = []
    for t, a, b in zip(text.cast(pa.large_binary()), h1.to_pylist(), h2.to_pylist(), strict=True):
        view = memoryview(t.as_buffer())
        n, p, m = cut(view, a, b)
        out.append((n, code_points(view[:p]), code_points(view[p:m])))
    release()
    return pa.StructArray.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(3)], ["n", "prefix", "middle"])


def hash_group(doc_id: Column, seed: int, i: int) -> Column:
    """The i-th eight hexadecimal digits, from 0, of the SHA-256 of seed and doc_id, as a number."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("long")


def transformed(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output. `rate` per cent of texts are cut, `spm` per cent of these with the suffix first."""
    arrow_limits(docs.sparkSession)
    h = [hash_group(F.col("doc_id"), seed, i) for i in range(4)]
    text = F.col("text")
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    form = F.when((text == "") | marked | (h[2] % 100 >= rate), "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    cuts = F.arrow_udf(_cuts, "n long, prefix long, middle long")
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns({"form": form, "c": cuts(text, h[0], h[1])})
    p, m = F.col("c.prefix").cast("int"), F.col("c.middle").cast("int")
    prefix, middle, suffix = F.substr("text", F.lit(1), p), F.substr("text", p + 1, m), F.substr("text", p + m + 1)
    psm = F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    first = F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    is_plain = F.col("form") == "plain"
    return d.select(
        "doc_id", F.col("c.n").alias("n"), "form", F.when(~is_plain, F.col("c.prefix")).alias("prefix_chars"), F.when(~is_plain, F.col("c.middle")).alias("middle_chars"),
        F.when(is_plain, text).when(F.col("form") == "psm", psm).otherwise(first).alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text, from output and form alone."""

    def parts(mark: str) -> tuple[Column, Column, Column]:
        head, tail = F.substring_index(output, mark, 1), F.substring_index(output, mark, -1)
        return F.substr(head, F.lit(4)), F.substring_index(tail, MIDDLE, 1), F.substring_index(tail, MIDDLE, -1)

    prefix, suffix, middle = parts(SUFFIX)
    suffix_first, prefix_second, middle_last = parts(PREFIX)
    return F.when(form == "plain", output).when(form == "psm", F.concat(prefix, middle, suffix)).otherwise(F.concat(prefix_second, middle_last, suffix_first))


def op12_fill_middle(spark, sf_dir: str) -> DataFrame:
    out = transformed(documents(spark, sf_dir))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
