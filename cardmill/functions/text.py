"""String, hash, date and JSON expressions. All run in the JVM; patterns are Java's.

`(?U)` gives \\s, \\w and \\d their Unicode meaning, `(?d)` makes \\n the only line end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX32 = "[0-9a-f]{32}"
#: What str.strip() of the cards' tool chain takes off, beyond Unicode white space.
#: The characters that Unicode and str.strip take for white space.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Fixed value: the letters that may stand in a registration number.
_REG_LETTERS = "A-Za-zА-Яа-яІіЇїЄє"


def let(value: Column, body) -> Column:
    """body(value) with value computed once, also where body uses it inside of lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column) -> Column:
    """without Unicode white space at both ends."""
    return F.btrim(c, F.lit(SPACES))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(SPACES))


def basename(path: Column) -> Column:
    """what follows the last slash."""
    return F.element_at(F.split(path, "/"), -1)


def doc_id_from_name(name: Column) -> Column:
    """the last 32 hexadecimal digits of the base name, in lower case; null without any."""
    return F.lower(F.try_element_at(F.regexp_extract_all(basename(name), F.lit(f"(?i)({HEX32})"), 1), F.lit(-1)))


def doc_id_strict(name: Column) -> Column:
    """Only a name that ends in _<id>.pdf."""
    return F.nullif(F.lower(F.regexp_extract(basename(name), rf"(?i)_({HEX32})\.pdf\z", 1)), F.lit(""))


def is_doc_id(c: Column) -> Column:
    return F.coalesce(c.rlike(rf"\A{HEX32}\z"), F.lit(False))


def registration_from_name(name: Column) -> Column:
    """the first registration number of the base name, else ''."""
    return F.regexp_extract(basename(name), rf"(?U)(\d{{4}}[{_REG_LETTERS}]\d+)", 1)


def date_from_name(name: Column, year: Column) -> Column:
    """the first date token, if it is of that year."""
    token = F.regexp_extract(F.replace(name, F.lit("\\"), F.lit("/")), r"(?U)(?<!\d)(\d{4}-\d{2}-\d{2})(?!\d)", 1)
    return F.when(F.startswith(token, F.concat(year.cast("string"), F.lit("-"))), token)


def _stem(name: Column) -> Column:
    """A base name without its last suffix; a name that is only a suffix stays."""
    return F.regexp_replace(name, r"(?<=[^.])\.[^.]+\z", "")


def safe_basename(name: Column, doc_id: Column) -> Column:
    """a base name of word characters, dots, brackets and dashes, which ends in .pdf and holds the id."""
    b = F.regexp_replace(basename(name), r"(?U)[^\w.()\-]+", "_")
    b = F.when(F.endswith(F.lower(b), F.lit(".pdf")), b).otherwise(F.concat(b, F.lit(".pdf")))
    return F.when(F.contains(F.lower(b), doc_id), b).otherwise(F.concat(_stem(b), F.lit("_"), doc_id, F.lit(".pdf")))


def safe_filename(registration: Column, doc_id: Column) -> Column:
    """<registration>_<id>.pdf with other characters and runs of _ made one _."""
    reg = F.regexp_replace(registration, r"(?U)[^\w\-_.]", "_")
    return F.regexp_replace(F.concat(reg, F.lit("_"), doc_id, F.lit(".pdf")), "_+", "_")


def digest(content: Column) -> Column:
    """F8."""
    return F.sha2(content, 256)


def valid_pdf(content: Column) -> Column:
    """over four bytes that begin with %PDF."""
    return F.coalesce((F.octet_length(content) > 4) & (F.substring(content, 1, 4) == F.lit(b"%PDF")), F.lit(False))


def url_with(base: str, params: dict[str, Column]) -> Column:
    """base?key=value&... with encoded values."""
    parts = [F.concat(F.lit(f"{k}="), F.url_encode(v.cast("string"))) for k, v in params.items()]
    return F.concat(F.lit(f"{base}?"), F.concat_ws("&", *parts))


def last_path_part(url: Column) -> Column:
    """the last part of a URL's path."""
    return basename(F.rtrim(F.coalesce(F.parse_url(url, F.lit("PATH")), F.lit("")), F.lit("/")))


def page_count(total: Column, size: Column) -> Column:
    """pages of size entries, one at least."""
    return F.greatest(F.lit(1), F.ceil(total / size).cast("int"))


def retry_delay(attempt: Column, retry_after: Column) -> Column:
    """F16: seconds before the next try (attempts count from 0), by what the server asks if that is a number."""
    asked = F.when(retry_after.rlike(r"\A\d+\z"), retry_after.cast("int")).otherwise(F.lit(0))
    return F.least(F.lit(300), F.greatest(15 * (attempt + 1), asked))


def json_list(value: Column, of: str) -> Column:
    """a JSON list as an array, null where it isn't one."""
    return F.from_json(value, f"array<{of}>")


def is_json_list(value: Column) -> Column:
    """Whether a text is a JSON list."""
    v = F.try_parse_json(value)
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("ARRAY")), F.lit(False))


def cyrillic(text: Column) -> Column:
    """how many of U+0400 to U+04FF."""
    return F.length(F.regexp_replace(text, r"[^\u0400-\u04FF]+", ""))


def latin(text: Column) -> Column:
    """how many ASCII letters."""
    return F.length(F.regexp_replace(text, "[^A-Za-z]+", ""))


def server_500(reason: Column) -> Column:
    """F21."""
    return F.coalesce(reason.rlike(r"(?iU)\b500\s+Server\s+Error\b|Internal\s+Server\s+Error"), F.lit(False))


def count_mismatch(reason: Column, announced: str, listed: str) -> Column:
    """the gap that a message tells of, as numbers behind two phrases; null without them."""
    pattern = rf"(?iuU){announced}\s+(\d+),\s+{listed}\s+(\d+)"
    numbers = [F.nullif(F.regexp_extract(reason, pattern, i), F.lit("")).cast("long") for i in (1, 2)]
    return F.greatest(F.lit(0), numbers[0] - numbers[1])


def utc_now() -> Column:
    """F22."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def one_line(c: Column) -> Column:
    """line breaks made spaces."""
    return F.translate(c, "\r\n", "  ")


def clean_block(c: Column) -> Column:
    """its lines stripped, empty ones dropped."""
    lines = F.transform(F.split(c, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\u0085\u2028\u2029]"), strip)
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def signed_number(n: Column) -> Column:
    """+5, -5, +0."""
    return F.format_string("%+d", n)


def days(start: Column, end: Column) -> Column:
    """all days of a range, both ends with it."""
    return F.sequence(start.cast("date"), end.cast("date"), F.expr("interval 1 day"))


def page_text(html: Column, unescape) -> Column:
    """Tags to spaces, entities unescaped (by the given function), runs of blanks to one, stripped."""
    text = F.replace(unescape(F.regexp_replace(html, "<[^>]+>", " ")), F.lit("\u00a0"), F.lit(" "))
    return strip(F.regexp_replace(text, "[ \t]{2,}", " "))
