"""Labelled fields of the ten sections: 73 columns from `label: value` text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_block, let, strip

# Labels as the cards print them, in the order of the sections.
ORGANIZATION = "Повне найменування юридичної особи (або ПІБ фізичної особи)"
ORGANIZATION_OLD = "Повне найменування юридичної особи"
ORCID, ORCID_OTHER = "Ідентифікатор ORCID ID", "Ідентифікатор ORCHID ID"
LEADER = "Власне Прізвище Ім'я По-батькові"
CONTRIBUTION = "Внесок співвиконавця у звітний етап"
#: The part of the current organization label that its older form lacks.
LABEL_LEAK = "(або ПІБ фізичної особи)"
#: Headings without a colon that end a field.
HEADINGS = ["Джерела фінансування", "Керівники роботи", "Практична реалізація НТП", "Характер співробітництва з інвестором"]

LINE, BLOCK = False, True  # a value ends with its line, or at the next label

# Fixed values: (column, mode, label) by section.
SECTION_I = [
    ("registration_number", LINE, "Державний обліковий номер"),
    ("state_registration_number", LINE, "Державний реєстраційний номер"),
    ("registration_date", LINE, "Дата реєстрації"),
    ("special_marks", LINE, "Особливі позначки"),
]
SECTION_II = [
    ("stage_number", LINE, "Номер етапу"),
    ("stage_title", BLOCK, "Назва етапу"),
    ("stage_start", LINE, "Початок етапу"),
    ("stage_end", LINE, "Закінчення етапу"),
    ("report_type", LINE, "Вид звітного документа"),
]
ORGANIZATION_FIELDS = [
    ("edrpou", LINE, "Код за ЄДРПОУ"),
    ("location", BLOCK, "Місцезнаходження"),
    ("ownership", BLOCK, "Форма власності"),
    ("ministry", BLOCK, "Сфера управління"),
    ("ror", LINE, "Ідентифікатор ROR"),
    ("size", BLOCK, "Розмір організації"),
    ("phone", LINE, "Телефон"),
]
SECTION_VI = [
    ("legal_basis", BLOCK, "Підстава для проведення ДіР"),
    ("funding_direction", BLOCK, "Напрям фінансування"),
    ("funding_sources", BLOCK, "Джерела фінансування"),
    ("budget_code", LINE, "Код програмної класифікації видатків і кредитування (КПКВК)"),
    ("funding_amount_kgrn", LINE, "Фактичний обсяг фінансування (тис. грн.)"),
    ("funding_amount_usd", LINE, "Фактичний обсяг фінансування (дол.)"),
    ("funding_amount_eur", LINE, "Фактичний обсяг фінансування (євро.)"),
]
SECTION_VII = [
    ("title_uk", BLOCK, "Назва роботи українською"),
    ("title_en", BLOCK, "Назва роботи англійською"),
    ("abstract_uk", BLOCK, "Реферат українською"),
    ("abstract_en", BLOCK, "Реферат англійською"),
    ("udc_index", LINE, "Індекс УДК"),
    ("thematic_codes", LINE, "Коди тематичних рубрик"),
    ("pi_name", BLOCK, LEADER),
    ("pi_degree", LINE, "Науковий ступінь"),
    ("pi_title", LINE, "Наукове звання"),
    ("pi_orcid", LINE, ORCID),
    ("additional_info", BLOCK, "Додаткова інформація"),
]
SECTION_VIII = [
    ("ntp_title_uk", BLOCK, "Назва НТП українською"),
    ("ntp_title_en", BLOCK, "Назва НТП англійською"),
    ("ntp_planned", BLOCK, "НТП, яку передбачалося створити"),
    ("ntp_failure_reasons", BLOCK, "Причини, через які НТП не було створено"),
    ("ntp_results", BLOCK, "Отримані результати"),
    ("ntp_application_field", BLOCK, "Галузь застосування"),
    ("ntp_card_number", LINE, "Реєстраційний номер картки технології"),
    ("ntp_description", BLOCK, "Опис НТП"),
    ("ntp_socioeconomic", BLOCK, "Соціально-економічна спрямованість НТП"),
    ("ntp_environment", BLOCK, "Вплив НТП на довкілля"),
    ("ntp_implementation", LINE, "Впровадження НТП"),
    ("ntp_implementation_start", LINE, "Початок етапу"),
    ("ntp_implementation_end", LINE, "Закінчення етапу"),
    ("ntp_consumers", BLOCK, "Споживачі продукції"),
    ("ntp_markets", BLOCK, "Перспективні ринки"),
    ("ntp_invest_amount_kgrn", LINE, "Потрібний обсяг інвестицій, тис. грн."),
    ("ntp_investor_rights", BLOCK, "Права, що надаються інвестору після завершення роботи"),
    ("ntp_business_plan", BLOCK, "Наявність бізнес-плану"),
    ("ntp_techno_economic_basis", BLOCK, "Техніко-економічне обгрунтування"),
    ("ntp_sales_amount_kgrn", LINE, "Потенціальний обсяг продажу, тис. грн."),
    ("ntp_payback_years", LINE, "Очікуваний термін окупності (років)"),
    ("ntp_additional_info", BLOCK, "Додаткова інформація"),
]
SECTION_X = ["org_head", "executors", "document_preparer", "document_preparer_phone", "registrar"]


def organization_columns(prefix: str) -> list[str]:
    return [f"{prefix}_name", *(f"{prefix}_{n}" for n, _, _ in ORGANIZATION_FIELDS)]


#: The data columns in the order of the table.
DATA_COLUMNS = [
    *(n for s in (SECTION_I, SECTION_II) for n, _, _ in s),
    *organization_columns("performer"), "co_performers", *organization_columns("customer"),
    *(n for s in (SECTION_VI, SECTION_VII) for n, _, _ in s), "research_leaders",
    *(n for n, _, _ in SECTION_VIII), "bibliography", *SECTION_X,
]
#: A record that lacks one of these is warned about.
CRITICAL_FIELDS = "registration_number title_uk title_en abstract_uk abstract_en pi_name performer_name".split()


def _words(label: str) -> str:
    """A pattern of the label with any blanks between its words."""
    return r"[ \t]+".join(rf"\Q{w}\E" for w in label.split())


def _any(labels: set[str]) -> str:
    """The longest label is tried first, so that none hides behind its own beginning."""
    return "|".join(_words(x) for x in sorted(labels, key=lambda x: (-len(x), x)))


_LABELS = {label for s in (SECTION_I, SECTION_II, ORGANIZATION_FIELDS, SECTION_VI, SECTION_VII, SECTION_VIII) for _, _, label in s} - set(HEADINGS) | {ORGANIZATION, ORGANIZATION_OLD, ORCID_OTHER, CONTRIBUTION}
#: What a block value ends before.
NEXT_LABEL = rf"(?:(?:{_any(_LABELS)})[ \t]*:|(?:{_any(set(HEADINGS))})[ \t]*(?=\n))"


def pattern(label: str, block: bool) -> str:
    """X6. A block's value may begin on the next line, unless that begins with a label."""
    head = rf"(?s){_words(label)}[ \t]*:?[ \t]*"
    if not block:
        return rf"{head}([^\n]*)"
    return rf"{head}(?:\n(?![ \t]*{NEXT_LABEL})[ \t]*)?(.*?)(?=\n[ \t]*{NEXT_LABEL}|\z)"


def field(text: Column, label: str, block: bool = LINE) -> Column:
    """The value of the first occurrence of a label, '' without one."""
    value = strip(F.regexp_extract(text, pattern(label, block), 1))
    if block:
        value = F.regexp_replace(value, r"\n{3,}", "\n\n")
    # a plain search for the label's first word spares most texts the pattern
    return F.when(F.contains(text, F.lit(label.split()[0])), value).otherwise("")


def first_of(*values: Column) -> Column:
    """The first that isn't empty."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values), F.lit(""))


def organization_name(text: Column) -> Column:
    """By the current label where it stands, even with a blank value; else by the older one."""
    return F.when(text.rlike(_words(ORGANIZATION)), field(text, ORGANIZATION, BLOCK)).otherwise(field(text, ORGANIZATION_OLD, BLOCK))


def organization(text: Column, prefix: str) -> dict[str, Column]:
    return {f"{prefix}_name": organization_name(text)} | {f"{prefix}_{n}": field(text, label, mode) for n, mode, label in ORGANIZATION_FIELDS}


def _records(chunks: Column, keys: dict) -> Column:
    """Structs of non-empty values; chunks without any are dropped."""
    made = F.transform(chunks, lambda c: F.struct(*(F.nullif(make(c), F.lit("")).alias(k) for k, make in keys.items())))
    return F.filter(made, lambda r: F.coalesce(*(r[k] for k in keys)).isNotNull())


def co_performers_list(text: Column, strict_names: bool = True) -> Column:
    """X11: array of structs of the section's organizations.

    strict_names: a blank name under the current label stays blank. Without it such a name
    is read by the older label, as the reference does, and gets the rest of the current one.
    """
    opener = lambda x: rf"(?m)(?=^[ \t]*\Q{x}\E[ \t]*:)"
    split = lambda body: F.when(F.contains(body, F.lit(ORGANIZATION)), F.split(body, opener(ORGANIZATION))).when(F.contains(body, F.lit(ORGANIZATION_OLD)), F.split(body, opener(ORGANIZATION_OLD))).otherwise(F.array(body))
    chunks = F.filter(F.transform(let(strip(text), split), strip), lambda c: c != "")
    name = organization_name if strict_names else lambda c: first_of(field(c, ORGANIZATION, BLOCK), field(c, ORGANIZATION_OLD, BLOCK))
    keys = {"name": name} | {n: (lambda c, label=label, mode=mode: field(c, label, mode)) for n, mode, label in [*ORGANIZATION_FIELDS, ("contribution", BLOCK, CONTRIBUTION)]}
    return _records(chunks, keys)


def co_performers(text: Column, strict_names: bool = True) -> Column:
    """The list as JSON; the raw text where no label is found; '' where the section has no colon."""
    listed = lambda found: F.when(F.size(found) > 0, F.to_json(found)).otherwise(strip(text))
    return F.when(~F.contains(text, F.lit(":")), "").otherwise(let(co_performers_list(text, strict_names), listed))


def research_leaders_list(text: Column) -> Column:
    """Array of structs of a section's leaders."""
    chunks = F.filter(F.split(text, rf"(?m)(?=^[ \t]*{_words(LEADER)}[ \t]*:)"), lambda c: F.contains(c, F.lit(LEADER)))
    keys = {
        "name": lambda c: field(c, LEADER, BLOCK),
        "degree": lambda c: field(c, "Науковий ступінь"),
        "title": lambda c: field(c, "Наукове звання"),
        "orcid": lambda c: first_of(field(c, ORCID), field(c, ORCID_OTHER)),
        "additional_info": lambda c: field(c, "Додаткова інформація", BLOCK),
    }
    return _records(chunks, keys)


def research_leaders(text: Column) -> Column:
    return let(research_leaders_list(text), lambda found: F.when(F.size(found) > 0, F.to_json(found)).otherwise(""))


# Anchors of the last section, which have no colon.
_HEAD = r"Керівник[ \t]+юридичної[ \t]+особи[ \t]*\n"
_EXECUTORS = r"Перелік[ \t]+осіб-виконавців[ \t]*\n"
_PREPARER = r"Відповідальний[ \t]+за[ \t]+підготовку(?:[ \t]*\n[ \t]*облікових[ \t]+документів)?"
_PHONE = r"(?m:^[ \t]*Телефон[ \t]*$)"
_REGISTRAR = r"(?m:^[ \t]*Реєстратор[ \t]*$)"


def _anchor(text: Column, p: str) -> tuple[Column, Column]:
    """Characters before an anchor's first match, and up to its end; null without one."""
    at = F.regexp_instr(text, F.lit(f"(?d){p}"))
    return F.when(at > 0, at - 1), F.when(at > 0, at - 1 + F.length(F.regexp_extract(text, f"(?d)({p})", 1)))


def closing_blocks(text: Column) -> Column:
    """Struct of the blocks between the anchors of the last section; each anchor is searched for once."""
    found = {"head": _HEAD, "executors": _EXECUTORS, "preparer": _PREPARER, "phone": _PHONE, "registrar": _REGISTRAR}
    marks = [c.alias(f"{n}{k}") for n, p in found.items() for k, c in zip(("_at", ""), _anchor(text, p), strict=True)]

    def blocks(m: Column) -> Column:
        behind = lambda at, mark: F.when(at > mark, at)
        cut = lambda a, b: F.when(a.isNull(), "").otherwise(clean_block(F.substr(text, a + 1, F.greatest(b - a, F.lit(0)))))
        end, preparer, phone = F.length(text), m["preparer"], m["phone"]
        return F.struct(
            cut(m["head"], F.coalesce(m["executors_at"], m["preparer_at"], end)).alias("org_head"),
            cut(m["executors"], F.coalesce(m["preparer_at"], end)).alias("executors"),
            cut(preparer, F.coalesce(behind(m["phone_at"], preparer), behind(m["registrar_at"], preparer), end)).alias("document_preparer"),
            cut(phone, F.coalesce(behind(m["registrar_at"], phone), end)).alias("document_preparer_phone"),
            cut(m["registrar"], end).alias("registrar"),
        )

    return let(F.struct(*marks), blocks)


def closing(text: Column) -> dict[str, Column]:
    found = closing_blocks(text)
    return {n: found[n] for n in SECTION_X}


def data_fields(sections: dict[str, Column], strict_names: bool = True, last: Column | None = None) -> dict[str, Column]:
    """The 73 data columns, from a column for each section; last holds closing_blocks() of the last one."""
    plain = lambda text, spec: {n: field(text, label, mode) for n, mode, label in spec}
    s = sections
    out = (
        plain(s["I"], SECTION_I) | plain(s["II"], SECTION_II) | organization(s["III"], "performer")
        | {"co_performers": co_performers(s["IV"], strict_names)} | organization(s["V"], "customer")
        | plain(s["VI"], SECTION_VI) | plain(s["VII"], SECTION_VII)
        | {"pi_orcid": first_of(field(s["VII"], ORCID), field(s["VII"], ORCID_OTHER)), "research_leaders": research_leaders(s["VII"])}
        | plain(s["VIII"], SECTION_VIII) | {"bibliography": strip(s["IX"])} | (closing(s["X"]) if last is None else {n: last[n] for n in SECTION_X})
    )
    return {n: out[n] for n in DATA_COLUMNS}


def with_data_fields(df: DataFrame, sections: str = "sections", strict_names: bool = True) -> DataFrame:
    """df with the 73 columns in place of its map of sections. Each section is taken out of the map once."""
    from .sections import NUMERALS

    # Over a hundred patterns make a method that the JVM would never compile; below this size Spark splits them instead.
    df.sparkSession.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    names = {n: f"_section_{n}" for n in NUMERALS}
    own = df.withColumns({c: F.col(sections)[n] for n, c in names.items()}).withColumn("_closing", closing_blocks(F.col(names["X"])))
    return own.withColumns(data_fields({n: F.col(c) for n, c in names.items()}, strict_names, F.col("_closing"))).drop(sections, "_closing", *names.values())
