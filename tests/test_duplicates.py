"""Duplicate groups of any size against plain Python."""

import hashlib
import sys
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from packloom.functions.text import casefold
from packloom.operators import duplicates

SCHEMA = "source_id string, logical_path string, file_hash string, parent_archive_source_id string, archive_member_path string"


def by_hand(rows):
    """{(kind, key): ids in order} of the groups by content."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    out = {}
    for key, found in groups.items():
        if len(found) > 1:
            names = {r[1].rsplit("/", 1)[-1] for r in found}
            kind = "same_content_different_filenames" if len(names) > 1 else "identical_content"
            out[kind, key] = [r[0] for r in sorted(found, key=lambda r: (r[1].lower(), r[0]))]
    return out


@pytest.mark.parametrize("part", [1, 7, 4096])
def test_groups_in_parts(spark, part):
    rows = [(f"s{i * 7919 % 3001}", f"{'ABcd'[i % 4]}/f{i % 5}", "empty" if i % 3 else f"h{i % 40}", None, None) for i in range(2000)]
    rows += [("t1", "x/é", "two", "arc", "m"), ("t2", "y/é", "two", "arc", "m"), ("t3", "lone", "lone", "arc", "")]
    sources = spark.createDataFrame(rows, SCHEMA)
    groups = duplicates._grouped(sources, "content", part=part)
    found = groups.collect()
    assert max(len(r.source_ids) for r in found) <= part and all(r.source_count == len(by_hand(rows)[r.duplicate_type, r.content_hash]) for r in found)
    whole = defaultdict(list)
    for r in sorted(found, key=lambda r: r.part):
        assert r.part == len(whole[r.duplicate_type, r.content_hash, r.group_id, r.recommended_canonical_source_id]) // part
        whole[r.duplicate_type, r.content_hash, r.group_id, r.recommended_canonical_source_id] += r.source_ids
    expected = {(kind, key, "dup_" + hashlib.sha256("|".join([kind, *ids]).encode()).hexdigest()[:16], ids[0]): ids for (kind, key), ids in by_hand(rows).items()}
    assert dict(whole) == expected
    listed = duplicates.group_members(groups, part).collect()
    assert sorted((r.group_id, r.position, r.source_id) for r in listed) == sorted((g, i, x) for (_, _, g, _), ids in expected.items() for i, x in enumerate(ids, 1))


def test_kinds_nulls_and_no_rows(spark):
    assert duplicates.all_groups(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [("a", None, "h", None, None), ("b", None, "h", None, None), ("c", "p/q", None, "z", "m"), ("d", "r/Q", "i", "z", "m"), ("e", "s/q", "j", "z", "")]
    for part in (1, 100):
        got = {(r.duplicate_type, r.source_count) for r in duplicates.all_groups(spark.createDataFrame(rows, SCHEMA), part).collect()}
        assert got == {("identical_content", 2), ("duplicate_relative_path", 2), ("duplicate_archive_member_path", 2), ("same_filename_different_content", 3)}, got


def test_folding_of_every_sign(spark):
    """Each code point alone and amid others, and words with final sigma, long s, ligatures and dotted I."""
    signs = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    lines = ["".join(signs[i : i + 512]) for i in range(0, len(signs), 512)]
    texts = [*lines, *[f"A{c}Z" for c in signs if c.casefold() != c], "ΟΔΥΣΣΕΥΣ ὀδυσσεύς", "ſtraße ﬁsh ŉ İstanbul I\u0307", "\U00010400\U0001F600ẞ", "", None, "Plain ASCII\n"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", casefold(F.col("t")).alias("f")).collect()
    wrong = [(texts[r.i], r.f) for r in got if r.f != (None if texts[r.i] is None else texts[r.i].casefold())]
    assert not wrong, wrong[:5]


def test_names_are_grouped_by_full_folding(spark):
    names = ["ΣΟΦΟΣ.txt", "σοφος.txt", "σοφοσ.txt", "ﬁle.pdf", "FILE.pdf", "Straße.csv", "STRASSE.csv", "ſtrasse.csv"]
    rows = [(f"s{i}", f"d/{n}", f"h{i}", None, None) for i, n in enumerate(names)]
    got = {frozenset(r.source_ids) for r in duplicates.name_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {frozenset({"s0", "s1", "s2"}), frozenset({"s3", "s4"}), frozenset({"s5", "s6", "s7"})}
