"""Scalar functions as Column expressions; the two that need Python work on Arrow batches."""

from __future__ import annotations

import html
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(1)
def latin_table() -> tuple[str, str]:
    """Accented Latin letters and their bare letters, from the canonical decompositions."""
    pairs = []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code):
            pairs.append((chr(code), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold(col: Column, ascii_only: bool = False) -> Column:
    """Without accents and in lower case; with ascii_only every other non-ASCII character goes too."""
    bare = F.translate(F.regexp_replace(col, r"\p{Mn}+", ""), *latin_table())
    folded = F.lower(F.regexp_replace(bare, r"[^\x00-\x7F]+", "") if ascii_only else bare)
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(folded)  # nothing to fold in plain ASCII


def fold_exact(col: Column) -> Column:
    """The ASCII flavour by full compatibility decomposition, for texts beyond the Latin blocks."""

    def bare(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode().lower() for t in texts.to_pylist()], pa.string())

    return F.arrow_udf(bare, "string")(col)


def norm_name(col: Column) -> Column:
    """Folded, with one space for each run of other characters; null gives the empty name."""
    return F.trim(F.regexp_replace(fold(F.coalesce(col, F.lit("")), ascii_only=True), "[^a-z0-9]+", " "))


def parse_amount(col: Column, mode: str = "form") -> Column:
    """Whole euros. form: all digits; layout: digits before the first comma; strict: nothing but digits, spaces and the euro sign."""
    if mode == "layout":
        text = F.regexp_replace(F.split_part(F.regexp_replace(col, "[^0-9,]", ""), F.lit(","), F.lit(1)), ",", "")
    elif mode == "strict":
        text = F.regexp_replace(col, "[\\s  €]", "")
        text = F.when(text.rlike("^[0-9]+$"), text)
    else:
        text = F.regexp_replace(col, "[^0-9]", "")
    return F.nullif(text, F.lit("")).try_cast("bigint")


def iso_date(col: Column) -> Column:
    """The date of a leading dd/mm/yyyy, else null."""
    return F.when(col.rlike("^[0-9]{2}/[0-9]{2}/[0-9]{4}"), F.try_to_timestamp(F.substring(col, 1, 10), F.lit("dd/MM/yyyy")).cast("date"))


def register_ts(col: Column) -> Column:
    """The time of dd-MM-yyyy HH:mm, else null."""
    return F.try_to_timestamp(col, F.lit("dd-MM-yyyy HH:mm"))


def unescape_html(col: Column) -> Column:
    """HTML entities as text."""

    def plain(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else html.unescape(t) for t in texts.to_pylist()], pa.string())

    return F.arrow_udf(plain, "string")(col)


def unescape_common(col: Column) -> Column:
    """The usual entities, inside the JVM; the ampersand comes last so that nothing is unescaped twice."""
    for entity, text in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        col = F.replace(col, F.lit(entity), F.lit(text))
    return col


def cabinet_label(col: Column) -> Column:
    """A commissioner's cabinet by its French name, else the text; null if empty."""
    text = unescape_common(col)
    name = F.regexp_extract(text, "^Cabinet of Commissioner (.+)$", 1)
    return F.when(name != "", F.concat(F.lit("Cabinet de "), name)).otherwise(F.nullif(text, F.lit("")))


def comma_parts(col: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(col, F.lit("")), ","), lambda y: F.trim(y)), lambda x: x != "")


def meeting_dg(col: Column) -> Column:
    """The cabinet that a member belongs to, else the last part of the text."""
    cabinet = F.trim(F.regexp_extract(F.coalesce(col, F.lit("")), "(?i)Cabinet member of (.+)$", 1))
    return F.when(cabinet != "", F.concat(F.lit("Cabinet de "), cabinet)).otherwise(F.try_element_at(comma_parts(col), F.lit(-1)))


def meeting_person(col: Column) -> Column:
    return F.try_element_at(comma_parts(col), F.lit(1))


def meeting_person_role(col: Column) -> Column:
    """The first part, with the others in brackets."""
    parts = comma_parts(col)
    rest = F.array_join(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), ", ")
    return F.when(F.size(parts) > 1, F.concat(F.get(parts, F.lit(0)), F.lit(" ("), rest, F.lit(")"))).otherwise(F.get(parts, F.lit(0)))


def join_hosts(col: Column) -> Column:
    """Names of an array, unescaped; null without an entry."""
    return F.when(F.size(col) > 0, F.array_join(F.filter(F.transform(col, unescape_common), lambda x: x != ""), ", "))


def split_pipe(col: Column, trim: bool = True) -> Column:
    """Entries of a |-list without blanks; null gives an empty list."""
    parts = F.split(F.coalesce(col, F.lit("")), r"\|")
    return F.filter(F.transform(parts, lambda y: F.trim(y)) if trim else parts, lambda x: F.trim(x) != "")


def slug(col: Column, default: str = "entite") -> Column:
    text = F.regexp_replace(F.lower(col), "[^a-z0-9]+", "-")
    return F.coalesce(F.nullif(F.regexp_replace(text, "^-+|-+$", ""), F.lit("")), F.lit(default))


def provider_key(col: Column) -> Column:
    return F.concat(F.lit("cab:"), F.lower(F.regexp_replace(F.trim(col), r"\s+", " ")))


def short_label(col: Column) -> Column:
    """The name without a bracketed note at its end."""
    return F.trim(F.regexp_replace(col, r"\s*\([^)]*\)\s*$", ""))


def map_value(col: Column, mapping: dict[str, str]) -> Column:
    """Looked up in a small mapping, or as it is."""
    if not mapping:
        return col
    pairs = F.create_map(*(F.lit(x) for kv in sorted(mapping.items()) for x in kv))
    return F.coalesce(F.try_element_at(pairs, col), col)


def last_segment(col: Column) -> Column:
    """The last part of a path, trailing slashes aside."""
    return F.substring_index(F.rtrim(col, F.lit("/")), "/", -1)


def blank_to_null(col: Column, tokens: tuple[str, ...] = ("N/A",)) -> Column:
    text = F.trim(col)
    return F.when((text != "") & ~F.upper(text).isin(*(t.upper() for t in tokens)), col)


def provider_total(providers: Column) -> Column:
    """Sum of the amounts of an array of (name, amount); null amounts count as nothing."""
    return F.aggregate(F.transform(providers, lambda p: F.coalesce(p["amount"], F.lit(0).cast("bigint"))), F.lit(0).cast("bigint"), lambda a, b: a + b)


def declared_total(employees: Column, providers: Column, benefits: Column | None = None) -> Column:
    zero = F.lit(0).cast("bigint")
    out = F.coalesce(employees, zero) + F.coalesce(provider_total(providers), zero)
    return out if benefits is None else out + F.coalesce(benefits, zero)


def zip_pairs(names: Column, amounts: Column) -> Column:
    """(name, amount) by position, as many as the shorter array has."""
    n = F.least(F.size(names), F.size(amounts))
    return F.transform(F.slice(F.arrays_zip(names.alias("name"), amounts.alias("amount")), 1, F.greatest(n, F.lit(0))), lambda x: F.struct(x["name"].alias("name"), x["amount"].alias("amount")))


def pair_key(a: Column, b: Column) -> Column:
    """The same struct for both directions."""
    return F.struct(F.least(a, b).alias("low"), F.greatest(a, b).alias("high"))


def register_url(col: Column, template: str = "https://register.example/view?id=%s") -> Column:
    return F.when(col.isNotNull(), F.format_string(template, col.cast("string")))
