"""Sections of a card: numbered headers, false ones dropped, bodies by the next header.

Everything is an array expression over the headers of one text; no row leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import let, lstrip, strip

#: The section numerals in order.
NUMERALS = "I II III IV V VI VII VIII IX X".split()
#: Fixed value: what a header's title may begin with.
TITLE_LETTERS = "[А-ЯІЄЇ]"
# Longer numerals first, so that one is tried before its own beginning.
_HEADER = rf"(?md)(^(?U:\s)*({'|'.join(sorted(NUMERALS, key=len, reverse=True))})\.(?U:\s)+)(?={TITLE_LETTERS})"
_MARK, _OPEN, _CLOSE = "\x01", "\x02", "\x03"


def headers(text: Column) -> Column:
    """array<struct<rank, header, body>> of all header matches; body runs to the next one.

    U+0001 to U+0003 serve as marks and are dropped from the text first.
    """
    plain = F.translate(text, _MARK + _OPEN + _CLOSE, "")
    marked = F.regexp_replace(plain, _HEADER, f"{_MARK}$2{_OPEN}$1{_CLOSE}")
    ranks = F.array(*map(F.lit, NUMERALS))

    def one(chunk: Column) -> Column:
        rest = F.substring_index(chunk, _OPEN, -1)
        return F.struct(
            F.array_position(ranks, F.substring_index(chunk, _OPEN, 1)).cast("int").alias("rank"),
            F.substring_index(rest, _CLOSE, 1).alias("header"),
            F.substring_index(rest, _CLOSE, -1).alias("body"),
        )

    return let(F.split(marked, _MARK), lambda c: F.transform(F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0))), one))


def longest_rising(ranks: Column) -> Column:
    """1-based places of a longest strictly rising subsequence of an integer array.

    Of equally long ones: the one that ends last, and from there always the earliest predecessor of the greatest length.
    """
    start = F.expr("CAST(array() AS array<struct<v:int, len:int, prev:int>>)")

    def grow(acc: Column, v: Column) -> Column:
        before = F.aggregate(acc, F.lit(0), lambda m, x: F.when((x["v"] < v) & (x["len"] > m), x["len"]).otherwise(m))

        def grown(longest: Column) -> Column:
            prev = F.array_position(F.transform(acc, lambda x: (x["v"] < v) & (x["len"] == longest)), True).cast("int")
            return F.concat(acc, F.array(F.struct(v.alias("v"), (longest + 1).alias("len"), F.when(longest > 0, prev).otherwise(0).alias("prev"))))

        return let(before, grown)

    def traced(runs: Column) -> Column:
        last = F.array_max(F.transform(runs, lambda x, i: F.struct(x["len"].alias("len"), (i + 1).alias("at"))))["at"]
        state = F.struct(F.coalesce(last, F.lit(0)).alias("at"), F.expr("CAST(array() AS array<int>)").alias("chain"))

        def back(s: Column, _: Column) -> Column:
            prev = F.try_element_at(runs, F.greatest(s["at"], F.lit(1)))["prev"]
            return F.when(s["at"] > 0, F.struct(F.coalesce(prev, F.lit(0)).alias("at"), F.concat(F.array(s["at"]), s["chain"]).alias("chain"))).otherwise(s)

        return F.aggregate(runs, state, back, lambda s: s["chain"])

    return let(F.aggregate(F.coalesce(ranks, F.expr("CAST(array() AS array<int>)")), start, grow), traced)


def section_body(body: Column) -> Column:
    """Without the title line (a first line without a colon); a single line without a colon is no body."""

    def untitled(b: Column) -> Column:
        line = F.substring_index(b, "\n", 1)
        rest = F.when(F.contains(b, F.lit("\n")), lstrip(F.substr(b, F.length(line) + 2))).otherwise("")
        return F.when(F.contains(line, F.lit(":")), b).otherwise(rest)

    return let(strip(body), untitled)


def split_sections(text: Column) -> Column:
    """Map of the ten numerals to their bodies, '' where there is none.

    A dropped header is part of the kept section before it; what stands before the first kept header is part of none.
    """
    numerals = F.array(*map(F.lit, NUMERALS))

    def entries(found: Column, chain: Column) -> Column:
        def entry(at: Column, i: Column) -> Column:
            to = F.coalesce(F.try_element_at(chain, (i + 2).cast("int")), F.size(found) + 1)
            parts = F.transform(F.slice(found, at, to - at), lambda h, k: F.when(k == 0, h["body"]).otherwise(F.concat(h["header"], h["body"])))
            return F.struct(F.element_at(numerals, F.element_at(found, at)["rank"]).alias("key"), section_body(F.array_join(parts, "")).alias("value"))

        return F.map_from_entries(F.transform(chain, entry))

    filled = let(headers(F.coalesce(text, F.lit(""))), lambda found: let(longest_rising(F.transform(found, lambda h: h["rank"])), lambda chain: entries(found, chain)))
    return let(filled, lambda m: F.map_from_arrays(numerals, F.transform(numerals, lambda k: F.coalesce(F.try_element_at(m, k), F.lit("")))))


def section_count(sections: Column) -> Column:
    """How many sections have text."""
    return F.size(F.filter(F.map_values(sections), lambda x: strip(x) != ""))
