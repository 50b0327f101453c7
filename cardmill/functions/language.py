"""Language classes of fields and rows, by their shares of Cyrillic and Latin letters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import cyrillic, latin, let, strip

#: The text fields that get a language each, in the order of the table.
TEXT_FIELDS = """
    stage_title special_marks report_type
    performer_name performer_location performer_ownership performer_ministry performer_size
    co_performers
    customer_name customer_location customer_ownership customer_ministry customer_size
    legal_basis funding_direction funding_sources
    title_uk title_en abstract_uk abstract_en
    pi_name pi_degree pi_title additional_info research_leaders
    ntp_title_uk ntp_title_en ntp_planned ntp_failure_reasons ntp_results ntp_application_field
    ntp_description ntp_socioeconomic ntp_environment ntp_implementation ntp_consumers ntp_markets ntp_additional_info
    ntp_investor_rights ntp_business_plan ntp_techno_economic_basis
    bibliography org_head executors document_preparer registrar
""".split()
#: The fields that decide the language of a row.
ROW_FIELDS = "title_uk abstract_uk stage_title performer_name customer_name ntp_description".split()


def _letters(text: Column) -> list[Column]:
    return [cyrillic(text).alias("cyr"), latin(text).alias("lat")]


def letters_of(text: Column) -> Column:
    """How many Cyrillic and Latin letters a text has."""
    return F.struct(*_letters(text))


def field_language(text: Column, short: Callable[[Column], Column] | None = None, letters: Column | None = None) -> Column:
    """Uk, en, mixed, empty or unknown.

    short decides texts of 3 to 39 letters of both scripts: a function to a language code, null where it finds none, such as
    `profiles.detector`. It sees null for all other texts. Without it they are mixed. With it letters are counted on both sides of the function,
    unless `letters` is a column that holds what letters_of finds in the text.
    """
    text = F.coalesce(text, F.lit(""))
    own = _letters(text) if letters is None else [letters["cyr"].alias("cyr"), letters["lat"].alias("lat")]

    def decided(n: Column) -> Column:
        all_, share = n["cyr"] + n["lat"], n["cyr"] / (n["cyr"] + n["lat"])
        asked = F.lit("mixed")
        if short:
            found = n["short"]
            asked = F.when(found.isNull(), "unknown").when(found.isin("uk", "en"), found).otherwise("mixed")
        return F.when(all_ < 3, "unknown").when(share >= 0.85, "uk").when(share <= 0.15, "en").when(all_ >= 40, "mixed").otherwise(asked)

    part = lambda n: F.try_divide(n["cyr"], n["cyr"] + n["lat"])
    asked = let(F.struct(*own), lambda n: (n["cyr"] + n["lat"]).between(3, 39) & (part(n) > 0.15) & (part(n) < 0.85))
    asks = [short(F.when(asked, text)).alias("short")] if short else []
    counted = let(F.struct(*own, *asks), decided)
    return F.when(text == "", "empty").when(strip(text) == "", "empty").otherwise(counted)


def row_language(fields: list[Column], short=None) -> Column:
    """Of the joined fields; a row without text is unknown, not empty."""
    text = strip(F.concat_ws(" ", *(F.coalesce(f, F.lit("")) for f in fields)))
    return F.when(text == "", "unknown").otherwise(field_language(text, short))


def with_languages(df: DataFrame, short=None) -> DataFrame:
    """lang_* of every text field, and the row's language."""
    own = {f"lang_{f}": field_language(F.col(f), short) for f in TEXT_FIELDS}
    return df.withColumns(own | {"language": row_language([F.col(f) for f in ROW_FIELDS], short)})
