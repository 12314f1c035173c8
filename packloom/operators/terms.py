"""Many terms in one pass over a text: an Aho-Corasick automaton in a Pandas UDF, where a ``contains`` a term would read the text once for each."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from packloom.functions.text import casefold


@lru_cache(maxsize=4)
def _automaton(terms: tuple[str, ...]):
    """Built once a worker and list of terms."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        found.add_word(term, i)
    found.make_automaton()
    return found


def places_of(text: Column, terms: Iterable[str]) -> Column:
    """The places in ``terms`` of those that ``text`` has, in order; null for a null text. Terms and texts are compared as they are. The terms go to each task with its code, so that their size is the caller's bound."""
    order: dict[str, list[int]] = {}
    for i, t in enumerate(terms):
        order.setdefault(t, []).append(i)
    every, spots = tuple(t for t in order if t), list(v for t, v in order.items() if t)
    always = order.get("", [])  # the empty term is in each text

    @F.pandas_udf("array<int>")
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = _automaton(every) if every else None
        for batch in batches:
            out = []
            for x in batch:
                hits = {i for _, i in automaton.iter(x)} if automaton and x else set()
                out.append(None if x is None else sorted([*always, *(p for i in hits for p in spots[i])]))
            yield pd.Series(out, dtype=object)

    return search(text)


def terms_in(text: Column, terms: Iterable[str]) -> Column:
    """The terms that a text has, whatever their case, in the order given."""
    given = [t.casefold() for t in terms]
    return F.transform(places_of(casefold(text), given), lambda i: F.get(F.lit(list(given)), i))


def first_label(text: Column, rules: Mapping[str, Iterable[str]]) -> Column:
    """The first label of ``rules`` of which a term is in the text, whatever its case; null if none is: as a CASE over ``contains``, with one pass for all rules."""
    flat = [(label, t.casefold()) for label, terms in rules.items() for t in terms]
    if not flat:
        return F.lit(None).cast("string")
    return F.get(F.lit([label for label, _ in flat]), F.get(places_of(casefold(text), [t for _, t in flat]), 0))
