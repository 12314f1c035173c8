"""Text rules of the data dictionary, as Column expressions over whole columns."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Mapping
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from packloom.operators.schemas import DOMAINS

#: Unicode white space and the four separators that Java's class leaves out.
SPACE = r"(?U)[\s\x1c-\x1f]"
#: The same signs one by one.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

# Words, markers and their order decide results.
MULTIPLE_WORDS = ("y", "yes", "true", "1", "multiple")
SINGLE_WORDS = ("n", "no", "false", "0", "single")
BOOLEAN_MARKERS = ("y / n", "yes/no", "yes / no")
DECIMAL_MARKERS = ("area", "height", "width", "length", "capacity", "rating")
ENUM_MARKERS = ("e.g.", "category", "class")
EXAMPLE_MARKERS = ("e.g.", "eg.", "e.g")
UNITS = (("sqm", "sqm"), ("m2", "m2"), ("kw", "kW"), ("kva", "kVA"), ("kg", "kg"), ("mm", "mm"), ("m ", "m"))
MOST_ACCEPTED = 20
RAW_CHARS = 200


def strip(x: Column) -> Column:
    return F.btrim(x, F.lit(SPACES))


def stripped(x: Column) -> Column:
    """Without outer white space; null is empty."""
    return F.coalesce(strip(x.cast("string")), F.lit(""))


def or_null(x: Column) -> Column:
    return F.when(x != "", x)


@cache
def _foldings() -> tuple[dict[str, str], dict[str, str]]:
    """Unicode's full case folding as data: signs that fold to one sign, and those that fold to several."""
    every = {c: c.casefold() for c in map(chr, range(sys.maxunicode + 1)) if c.casefold() != c}
    return {c: f for c, f in every.items() if len(f) == 1}, {c: f for c, f in every.items() if len(f) > 1}


def casefold(x: Column) -> Column:
    """Full case folding, without normalisation, as Python's ``str.casefold``. ASCII texts take the short way; the few signs that fold to several are looked up only in texts that have one."""
    one, several = _foldings()
    table = F.create_map(*[F.lit(v) for pair in several.items() for v in pair])
    signs = F.regexp_extract_all(x, F.lit("(?s)."), F.lit(0))
    spelt = F.when(x.rlike(f"[{''.join(several)}]"), F.array_join(F.transform(signs, lambda c: F.coalesce(table[c], c)), "")).otherwise(x)
    return F.when(F.length(x) == F.octet_length(x), F.lower(x)).otherwise(F.translate(spelt, "".join(one), "".join(one.values())))


def any_in(text: Column, terms: Iterable[str]) -> Column:
    hit = F.lit(False)
    for t in terms:
        hit = hit | F.contains(text, F.lit(t))
    return hit


def clean_cell(x: Column) -> Column:
    """Runs of white space become one space; what is then empty is null."""
    return or_null(F.trim(F.regexp_replace(x, f"{SPACE}+", " ")))


def normalize_header(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.replace(F.lower(strip(x)), F.lit("_"), F.lit(" ")), f"{SPACE}+", " "))


def cardinality(x: Column) -> Column:
    t = F.lower(stripped(x))
    return F.when(t.isin(*MULTIPLE_WORDS), "multiple").when(t.isin(*SINGLE_WORDS), "single").otherwise("unknown")


def expected_type(label: Column, definition: Column, notes: Column) -> Column:
    """The declared type that the wording suggests; label and definition are stripped and not null."""
    every = F.lower(F.concat_ws(" ", label, definition, stripped(notes)))
    name = F.lower(label)
    return (
        F.when(any_in(every, BOOLEAN_MARKERS), "boolean")
        .when(F.contains(every, F.lit("iso 8601")) | F.contains(name, F.lit("date")), "date")
        .when((name == "count") | F.contains(every, F.lit("number of")), "integer")
        .when(any_in(every, DECIMAL_MARKERS), "decimal")
        .when(any_in(every, ENUM_MARKERS), "enum")
        .when(strip(every) == "", "unknown")
        .otherwise("string")
    )


def listed_values(guidance: Column) -> Column:
    """Distinct values in order that follow the first example marker, or that slashes separate; none without either."""
    t = stripped(guidance)
    low = F.lower(t)
    after = None
    for m in EXAMPLE_MARKERS:
        hit, rest = F.contains(low, F.lit(m)), F.substring(t, F.locate(m, low) + len(m), F.length(t))
        after = F.when(hit, rest) if after is None else after.when(hit, rest)
    parts = F.split(F.coalesce(after, t), r" / |,|;")
    values = F.filter(F.array_distinct(F.transform(parts, strip)), lambda v: v != "")
    none = F.array().cast("array<string>")
    return F.when(any_in(low, EXAMPLE_MARKERS) | F.contains(t, F.lit(" / ")), values).otherwise(none)


def accepted_values(guidance: Column) -> Column:
    values = listed_values(guidance)
    return F.when(F.size(values) > MOST_ACCEPTED, F.array().cast("array<string>")).otherwise(values)


def unit(guidance: Column) -> Column:
    t = F.lower(stripped(guidance))
    first = F.lit(None).cast("string")
    for marker, name in reversed(UNITS):
        first = F.when(F.contains(t, F.lit(marker)), name).otherwise(first)
    return first


def evidence_types(fields: Mapping[str, Column], rules: Mapping[str, Mapping[str, Iterable[str]]]) -> Column:
    """Labels of all rules of which a term occurs in the rule's field, in rule order; text if there is none. Labels outside the domain are skipped."""
    found = []
    for field, labels in rules.items():
        t = F.lower(stripped(fields[field])) if field in fields else F.lit("")
        found += [F.when(any_in(t, [x.lower() for x in terms]), label) for label, terms in labels.items() if label in DOMAINS["evidence_type"]]
    some = F.array_distinct(F.array_compact(F.array(*found))) if found else F.array().cast("array<string>")
    return F.when(F.size(some) > 0, some).otherwise(F.array(F.lit("text")))


def requirement_text(name: Column, label: Column, definition: Column) -> Column:
    """The non-empty parts, joined; all are stripped and not null."""
    return F.coalesce(or_null(F.concat_ws(" - ", or_null(name), or_null(label), or_null(definition))), F.lit("Unspecified requirement"))


def compact_cells(cells: Column) -> Column:
    """Non-blank cells, cut to a bounded length."""
    return F.transform_values(F.map_filter(cells, lambda k, v: v.isNotNull() & (strip(v) != "")), lambda k, v: F.left(v, F.lit(RAW_CHARS)))
