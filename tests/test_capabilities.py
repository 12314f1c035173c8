"""Capabilities over bundles of bounded size."""

from collections import defaultdict

import pytest

from packloom.operators import capabilities


def test_positions_of_a_hot_key(spark):
    """One key has most rows, over many partitions; null keys and repeated rows count too."""
    rows = [("hot", i * 7919 % 5003, f"t{i % 11}") for i in range(4000)] + [(f"k{i % 50}", i, None) for i in range(300)] + [(None, 2, "x"), (None, 1, "y"), ("twice", 1, "same"), ("twice", 1, "same")]
    units = spark.createDataFrame(rows, "key string, pos int, text string").repartition(13)
    got, _ = capabilities.bounded_bundles(units, "key", ["pos"], ["pos", "text"], 64)
    expected = defaultdict(list)
    for k, p, t in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        expected[k].append((p, t))
    found = got.collect()
    assert max(r.n_units for r in found) == 64 and sum(r.n_units for r in found) == len(rows)
    for r in found:
        assert [(u.pos, u.text) for u in r.units] == expected[r.key][64 * r.part : 64 * r.part + 64]
        assert [u.position for u in r.units] == list(range(64 * r.part + 1, 64 * r.part + r.n_units + 1))


def test_candidates_are_checked(spark):
    units = spark.createDataFrame([("t", 1, "no\nA Boiler here"), ("t", 2, None), ("t", 3, "boiler, pump"), (None, 1, "pump")], "target_row_id string, pos int, text string")
    bundles, _ = capabilities.bounded_bundles(units, "target_row_id", ["pos"], ["text"], 10)
    ability = capabilities.MentionedTerms(["BOILER", "pump", "boiler"], least=0.5)
    got = {(r.target_row_id, r.requirement_id): r for r in ability.judged(ability.extract(bundles)).collect()}
    assert set(got) == {("t", "boiler"), ("t", "pump"), (None, "pump")}
    assert got["t", "boiler"].candidate_value == "A Boiler here" and got["t", "boiler"].reasoning_summary == "1,3" and got["t", "boiler"].rejected_by == []
    assert got["t", "pump"].rejected_by == ["confidence < 0.5D"] and got[None, "pump"].rejected_by == ["target_row_id"]

    class Loose(capabilities.BundleCapability):
        capability_id = "loose"

        def candidates(self, bundle):
            yield {"target_row_id": "t", "colour": "red"}

    with pytest.raises(Exception, match="not in the output schema: colour"):
        Loose().extract(bundles).collect()
    none, _ = capabilities.bounded_bundles(units.limit(0), "target_row_id", ["pos"], ["text"], 10)
    assert ability.extract(none).count() == 0
