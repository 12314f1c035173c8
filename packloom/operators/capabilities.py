"""Extraction capabilities that run: evidence in bundles of bounded size, a Python table function over them, candidates checked against their schema and rules.

A key's evidence may be of any size: its units get their positions by range partitions, so that no task has to hold or walk a key, and ``most`` neighbours are a bundle. Nothing is left out: a large key has many bundles.
"""

from __future__ import annotations

from abc import abstractmethod
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from packloom.operators.contracts import RECORD_CHECKS, Capability
from packloom.operators.schemas import fields as fields_of
from packloom.sources.shared import scratch, written


def placed(rows: DataFrame, key: str, order: list[str]) -> tuple[DataFrame, str]:
    """``rows`` with their ``position`` (from 1) within ``key`` by ``order``, nulls first, null keys being one key; and the folder of the sorted table that it reads.

    The sorted table is written, so that counts and rows see the same partitions; what meets by key are the counts of partitions.
    """
    folder = scratch(rows.sparkSession, "placed")
    every = written(rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order).withColumn("__at", F.monotonically_increasing_id()), folder)
    every = every.withColumn("__piece", F.shiftright("__at", 33))
    pieces = every.groupBy(F.col(key).alias("__key"), F.col("__piece").alias("__of")).agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    earlier = W.partitionBy("__key").orderBy("__of").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    found = every.join(pieces, (F.col("__piece") == F.col("__of")) & F.col(key).eqNullSafe(F.col("__key")))
    return found.select(*rows.columns, (F.col("__at") - F.col("__first") + F.col("__before") + 1).alias("position")), folder


def bounded_bundles(units: DataFrame, key: str, order: list[str], fields: list[str], most: int) -> tuple[DataFrame, str]:
    """(key, part, units, n_units): at most ``most`` units a bundle, in order, each with its ``position`` and ``fields``; parts are numbered from 0. The folder is to be removed once the bundles have been used."""
    rows, folder = placed(units.select(key, *[c for c in dict.fromkeys([*order, *fields]) if c != key]), key, order)
    part = F.floor((F.col("position") - 1) / most).cast("bigint")
    found = rows.groupBy(key, part.alias("part")).agg(F.array_sort(F.collect_list(F.struct("position", *fields))).alias("units"))
    return found.withColumn("n_units", F.size("units").cast("bigint")), folder


class BundleCapability(Capability):
    """A capability given by what it finds in one bundle. ``rejection_rules`` are SQL conditions on candidates; ``validation_requirements`` name the checks of candidates that must hold (all of them unless given)."""

    @abstractmethod
    def candidates(self, bundle: dict) -> Iterable[dict]:
        """Candidates of a bundle (its columns, units being dicts), each with some of the fields of ``output_schema``."""

    def extract(self, bundles: DataFrame) -> DataFrame:
        """Candidates in all columns of ``output_schema``. A candidate with a field that the schema doesn't have ends the query, as does a value of another type."""
        schema = fields_of(self.output_schema)
        names, mine, stamp = schema.names, self, self.capability_id

        class Found:
            def eval(self, bundle):
                for found in mine.candidates(bundle.asDict(recursive=True)):
                    unknown = sorted(set(found) - set(names))
                    if unknown:
                        raise ValueError(f"capability {stamp}: not in the output schema: {', '.join(unknown)}")
                    yield tuple(found.get(n, stamp if n == "capability_id" else None) for n in names)

        table = F.udtf(Found, returnType=schema)
        bundles = bundles.select(F.struct(*bundles.columns).alias("__bundle"))
        return bundles.lateralJoin(table(F.col("__bundle").outer())).select(*names)

    def judged(self, candidates: DataFrame) -> DataFrame:
        """``candidates`` with ``rejected_by``: the rules that hold and the checks that don't, in order; empty for accepted ones."""
        checks = {k: v for k, v in RECORD_CHECKS["candidate"].items() if k in (self.validation_requirements or RECORD_CHECKS["candidate"])}
        rules = [F.when(F.expr(r), F.lit(r)) for r in self.rejection_rules]
        broken = [F.when(~F.coalesce(c(), F.lit(False)), F.lit(name)) for name, c in checks.items()]
        return candidates.withColumn("rejected_by", F.array_compact(F.array(*rules, *broken, F.lit(None).cast("string"))))


class MentionedTerms(BundleCapability):
    """For each term, the first line of a bundle that has it, whatever its case; the confidence is the share of the bundle's units that have it."""

    capability_id, version = "mentioned_terms", "1"
    supported_evidence_types = frozenset({"text"})
    confidence_approach = "share of units"

    def __init__(self, terms: Iterable[str], least: float = 0.0):
        self.terms = tuple(dict.fromkeys(t.lower() for t in terms))
        self.rejection_rules = (f"confidence < {least!r}D",)

    def candidates(self, bundle: dict) -> Iterable[dict]:
        units = [(u["position"], (u["text"] or "")) for u in bundle["units"]]
        for term in self.terms:
            hits = [(at, text) for at, text in units if term in text.lower()]
            if hits:
                line = next(x for x in hits[0][1].split("\n") if term in x.lower()) if "\n" not in term else hits[0][1]
                yield {
                    "target_row_id": bundle["target_row_id"],
                    "requirement_id": term,
                    "candidate_value": line,
                    "page_or_sheet": str(bundle["part"]),
                    "confidence": len(hits) / len(units),
                    "reasoning_summary": ",".join(str(at) for at, _ in hits),
                }
