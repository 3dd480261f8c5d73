"""Text functions: three normal forms, prefixes, near misses, templates, JSON leaves."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts as white space (the set ECMAScript's \s has), by code point.
SPACE = "".join(map(chr, (*range(9, 14), 32, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)))
SPACES = f"[{SPACE}]+"
UUID = r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"


@F.pandas_udf(T.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Compatibility composition; Spark has no function for it. ASCII texts are passed on as they are."""
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def folded(c: Column | str) -> Column:
    """NFKC in lower case."""
    return F.lower(nfkc(_column(c)))


def title_key(c: Column | str) -> Column:
    """A title without punctuation, symbols and white space, for comparing titles; null stays null."""
    return F.regexp_replace(folded(c), rf"[\p{{P}}\p{{S}}{SPACE}]+", "")


def squeezed(c: Column | str) -> Column:
    """A text without any white space, for comparing excerpts across line breaks."""
    return F.regexp_replace(folded(c), SPACES, "")


def spaced(c: Column | str) -> Column:
    """A text with each run of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(folded(c), SPACES, " "))


def prefix(c: Column | str, n: int = 4) -> Column:
    """The first n code points of a title's key."""
    return F.substring(title_key(c), 1, n)


def preferred(localizations: Column | str, language: str) -> Column:
    """The title of the first localization in a language, '' where there is none."""
    own = F.filter(_column(localizations), lambda x: x["language"] == language)
    return F.coalesce(F.try_element_at(own, F.lit(1))["title"], F.lit(""))


def or_id(title: Column | str, ident: Column | str, most: int = 512) -> Column:
    """A title cut to so many characters, the id where it is null or blank."""
    trimmed = F.trim(_column(title))
    return F.left(F.coalesce(F.when(trimmed != "", trimmed), _column(ident)), F.lit(most))


def one_edit(a: Column | str, b: Column | str) -> Column:
    """Whether two texts of at least two characters differ by exactly one substitution, insertion or deletion."""
    x, y = _column(a), _column(b)
    return (F.length(x) >= 2) & (F.length(y) >= 2) & (F.levenshtein(x, y, 1) == 1)


def excerpt(c: Column | str, most: int = 240) -> Column:
    """A trimmed text cut to so many code points, null where nothing is left."""
    cut = F.left(F.regexp_replace(_column(c), f"^{SPACES}|{SPACES}$", ""), F.lit(most))
    return F.when(cut != "", cut)


def template(text: Column | str, excerpts: Column | str) -> Column:
    """A text with ids and quoted excerpts replaced by placeholders, longest excerpts first."""
    longest = F.array_sort(F.coalesce(_column(excerpts), F.array()), lambda a, b: F.length(b) - F.length(a))
    bare = F.regexp_replace(_column(text), UUID, "<unit>")
    return F.aggregate(longest, bare, lambda acc, e: F.when(e != "", F.replace(acc, e, F.lit("<evidence>"))).otherwise(acc))


def string_leaves(text: str | None) -> list[str] | None:
    """The strings inside a JSON document, in order; of text that is no JSON, the text; null of null."""
    if text is None:
        return None
    try:
        value = json.loads(text)
    except ValueError:
        return [text]
    out, stack = [], [value]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif isinstance(x, list):
            stack.extend(reversed(x))
        elif isinstance(x, dict):
            stack.extend(reversed(list(x.values())))
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def json_leaves(texts: pd.Series) -> pd.Series:
    """``string_leaves`` of a column."""
    return texts.map(string_leaves)


def field_values(rows: DataFrame, ident: str, fields: Mapping[str, Column | str]) -> DataFrame:
    """(unitId, field, value): one row for each value of the named fields of a record; a field may hold an array. Nulls are no values."""
    of = [(name, _column(c)) for name, c in fields.items()]
    kinds = rows.select(*[c.alias(n) for n, c in of]).schema

    def entries(name: str, c: Column) -> Column:
        values = c if kinds[name].dataType.typeName() == "array" else F.array(c)
        return F.transform(values, lambda v: F.struct(F.lit(name).alias("field"), v.cast("string").alias("value")))

    each = [entries(n, c) for n, c in of]
    empty = F.array().cast("array<struct<field:string,value:string>>")
    whole = F.flatten(F.array(*[F.coalesce(e, empty) for e in each]))
    return rows.select(F.col(ident).alias("unitId"), F.explode(whole).alias("x")).select("unitId", "x.field", "x.value").where("value is not null")


def whole_number(c: Column | str) -> Column:
    """A count as a long, null where it isn't a whole number that doubles hold exactly."""
    n = F.expr(f"try_cast({c} as decimal(38,6))") if isinstance(c, str) else c
    return F.when((n == F.floor(n)) & (F.abs(n) <= 2**53 - 1), n.cast("long"))


def part_name(c: Column | str) -> Column:
    """``part-00042`` of 42."""
    n = _column(c).cast("string")
    return F.concat(F.lit("part-"), F.when(F.length(n) < 5, F.lpad(n, 5, "0")).otherwise(n))


def part_number(c: Column | str) -> Column:
    """42 of ``part-00042.jsonl``; null of any other name."""
    found = F.regexp_extract(_column(c), r"(?:^|/)part-(\d{5,12})(?:\.jsonl)?$", 1)
    return F.when(found != "", found.cast("long"))


PART_FILE = re.compile(r"part-(\d{5,12})\.jsonl$")
