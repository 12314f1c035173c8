"""Duplicate groups of registered sources, of any size. Keys of all kinds are counted in one aggregate; ids and paths of repeated ones alone move on.

A group is one row with an array of its source ids, up to ``PART`` of them; a larger one is several rows, a part each. Members of large groups are put in order by range partitions, so that many tasks share a group,
and packed into chunks; what one task then reads of a group, as a stream, are its chunks, since the identifier is a SHA-256 over all ids in their order. It holds one part at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packloom.functions import ids
from packloom.functions.files import file_name
from packloom.functions.text import casefold

#: In the order in which groups are listed.
RATIONALE = {
    "content": "The files' SHA-256 hashes are equal.",
    "path": "Several sources have one logical path.",
    "member": "An archive has several members of one path.",
    "name": "Files of one name differ in content.",
}
KINDS = list(RATIONALE)
#: Source ids in a row at most.
PART = 4096
#: 2**CHUNK_BITS neighbours of a sorted partition are a chunk, so that a batch of 10,000 chunks is some 50 MB.
CHUNK_BITS = 8
KEY = ["rank", "key0", "key1"]


def _keyed(sources: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """A row for each source and kind, with the key that its duplicates share."""
    path, nothing = F.col("logical_path"), F.lit("")
    member = F.col("archive_member_path")
    keys = {
        "content": (F.col("file_hash"), nothing),
        "path": (path, nothing),
        "member": (F.col("parent_archive_source_id"), member),
        "name": (casefold(file_name(path)), nothing),
    }
    place = lambda x: F.struct(F.lit(KINDS.index(x)).alias("rank"), *[k.cast("string").alias(f"key{i}") for i, k in enumerate(keys[x])])
    places = F.array_compact(F.array(*[F.when(F.coalesce(member, nothing) != "", place(x)) if x == "member" else place(x) for x in kinds]))
    return sources.select(F.col("source_id").alias("id"), casefold(path).alias("k"), "file_hash", file_name(path).alias("name"), F.explode(places).alias("of")).select("of.*", "id", "k", "file_hash", "name")


def _members(sources: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """(rank, key0, key1, duplicate_type, n, k, id) of all members of groups, n being the group's."""
    rows = _keyed(sources, kinds)
    differ = lambda c: F.min(c) != F.max(c)
    often = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), differ("file_hash").alias("hashes"), differ("name").alias("names"))
    rank = lambda x: F.col("rank") == KINDS.index(x)
    often = often.where(F.when(rank("name"), F.col("hashes")).otherwise(F.col("n") > 1))
    kind = (
        F.when(rank("content"), F.when(F.col("names"), "same_content_different_filenames").otherwise("identical_content"))
        .when(rank("path"), "duplicate_relative_path")
        .when(rank("member"), "duplicate_archive_member_path")
        .otherwise("same_filename_different_content")
    )
    often = often.select(*[F.col(c).alias(f"of_{c}") for c in KEY], "n", kind.alias("duplicate_type"))
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in KEY]
    return rows.join(often, same).select(*KEY, "duplicate_type", "n", "k", "id")


def _parts(part: int):
    """Of chunks in order: a row for each part of a group, and one with part -1, the first id and the group's identifier once it has ended."""

    def cut(frames: Iterator) -> Iterator:
        import pandas as pd

        columns = [*KEY, "part", "source_ids", "group_id"]
        key, state, first, done, held = None, None, None, 0, []

        def ended() -> list[tuple]:
            out = [(*key, done, held, None)] if held else []
            return [*out, (*key, -1, [first], "dup_" + state.hexdigest()[:16])]

        for frame in frames:
            for rank, key0, key1, kind, found in zip(*(frame[c] for c in (*KEY, "duplicate_type", "ids"))):
                out = []
                if (rank, key0, key1) != key:
                    out = ended() if key else []
                    key, state, first, done, held = (rank, key0, key1), hashlib.sha256(kind.encode()), found[0], 0, []
                state.update("".join(f"|{x}" for x in found).encode())
                held = [*held, *found]
                while len(held) >= part:
                    out.append((*key, done, held[:part], None))
                    done, held = done + 1, held[part:]
                if out:
                    yield pd.DataFrame(out, columns=columns)
        if key:
            yield pd.DataFrame(ended(), columns=columns)

    return cut


def _large(members: DataFrame, part: int) -> DataFrame:
    """Groups of more than ``part`` members, a row a part."""
    order = [*KEY, "k", "id"]
    rows = members.where(F.col("n") > part)
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    chunks = rows.groupBy(*KEY, "duplicate_type", "n", F.shiftright("at", CHUNK_BITS).alias("chunk"))
    chunks = chunks.agg(F.array_sort(F.collect_list(F.struct("at", "id"))).alias("m"))
    chunks = chunks.select(*KEY, "chunk", "duplicate_type", F.transform("m", lambda x: x["id"]).alias("ids"))
    dealt = chunks.repartition(*KEY).sortWithinPartitions(*KEY, "chunk")
    cut = dealt.mapInPandas(_parts(part), "rank int, key0 string, key1 string, part long, source_ids array<string>, group_id string")
    of = members.where(F.col("n") > part).select(*KEY, "duplicate_type", "n").distinct()
    ended = cut.where("part < 0").select(*[F.col(c).alias(f"of_{c}") for c in KEY], "group_id", F.col("source_ids")[0].alias("first"))
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in KEY]
    ended = of.join(ended, same).select(*[f"of_{c}" for c in KEY], "duplicate_type", "n", "group_id", "first")
    return cut.where("part >= 0").drop("group_id").join(ended, same).select(*KEY, "duplicate_type", "n", "part", "source_ids", "group_id", "first")


def _grouped(sources: DataFrame, *kinds: str, part: int = PART) -> DataFrame:
    members = _members(sources, kinds)
    small = members.where(F.col("n") <= part).groupBy(*KEY, "duplicate_type", "n").agg(F.array_sort(F.collect_list(F.struct("k", "id"))).alias("m"))
    small = small.select(*KEY, "duplicate_type", "n", F.lit(0).cast("long").alias("part"), F.transform("m", lambda m: m["id"]).alias("source_ids"))
    small = small.withColumns({"group_id": ids.group_id(F.col("duplicate_type"), F.col("source_ids")), "first": F.element_at("source_ids", 1)})
    rationale = F.element_at(F.array(*[F.lit(x) for x in RATIONALE.values()]), F.col("rank") + 1)
    return small.unionByName(_large(members, part)).select(
        "group_id",
        "duplicate_type",
        "part",
        F.col("n").alias("source_count"),
        "source_ids",
        F.when(F.col("rank") == KINDS.index("content"), F.col("key0")).alias("content_hash"),
        F.col("first").alias("recommended_canonical_source_id"),
        rationale.alias("rationale"),
        F.struct(*KEY, "part").alias("place"),
    )


def content_groups(sources: DataFrame) -> DataFrame:
    return _grouped(sources, "content")


def path_groups(sources: DataFrame) -> DataFrame:
    return _grouped(sources, "path")


def member_groups(sources: DataFrame) -> DataFrame:
    return _grouped(sources, "member")


def name_groups(sources: DataFrame) -> DataFrame:
    return _grouped(sources, "name")


def all_groups(sources: DataFrame, part: int = PART) -> DataFrame:
    """The bag union of the four kinds; a source can be in several groups. ``place`` orders the rows, the parts of a group being neighbours; part 0 is there for each group."""
    return _grouped(sources, *KINDS, part=part)


def group_members(groups: DataFrame, part: int = PART) -> DataFrame:
    """(group_id, duplicate_type, position, source_id) of groups cut into parts of ``part``, a row a member; positions start at 1, at the recommended source."""
    rows = groups.select("group_id", "duplicate_type", "part", F.posexplode("source_ids").alias("i", "source_id"))
    return rows.select("group_id", "duplicate_type", (F.col("part") * part + F.col("i") + 1).alias("position"), "source_id")
