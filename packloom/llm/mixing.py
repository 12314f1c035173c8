"""Mixing sources to target weights, with DataFrame functions alone on the data's path.

Each source's documents follow each other in a pseudorandom order and are packed into blocks of ``BLOCK_WORDS`` words (the last may be
short; a source of fewer than ``BLOCK_WORDS`` squared words has blocks of size / ``BLOCK_WORDS`` words, one at least, so that whole blocks meet its target as closely). The mix is a number of slots, one block each, in output shards of ``SHARD_SLOTS`` slots. A source's quota is the number of slots that meets its target. The shards' counts of each source are
drawn together: a pseudorandom permutation deals the slots of all quotas over all shards, which is how independent multinomial draws of the
shards are distributed, given that their sums meet the quotas. Slot j of a source is block perm(j mod n) of its n blocks, under a pseudorandom
permutation for each pass over the source; slots and blocks meet in a join by index. Full passes take every block once, so no block is taken more often
than the passes that the target allows. Permutations are swap-or-not rounds, a bijection for any n, computed for each slot on its own.

Sources are rows of a table, however many there are; the driver only learns the level at which their targets meet the total. Slots are made from ranges of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from packloom.llm._order import running
from packloom.llm._store import alone, cut, keyed, table
from packloom.llm.quality import words

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 8192
#: Slots of one range, made in one task.
RANGE_SLOTS = 1 << 16
ROUNDS = 24
#: Rounds that are compiled together.
LOOP = 12
SEED = 20240607
BUCKET_ROWS = 4096


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> list[float]:
    """The plain form of what ``sources_of`` finds: words that each source shall give: in proportion to the repeating weights, at most ``most`` times its size, the excess reshared by weight."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        share = left / sum(w[i] for i in free)
        over = {i for i in free if w[i] * share > most * sizes[i]}
        for i in over or free:
            out[i] = float(most * sizes[i]) if over else w[i] * share
        if not over:
            break
        left -= sum(out[i] for i in over)
        free -= over
    return out


def permuted(df: DataFrame, name: str, index: Column, n: Column, key: Column, tasks: int, rounds: int = ROUNDS) -> DataFrame:
    """``df`` of ``tasks`` partitions with a column ``name``: the image of ``index`` under a pseudorandom permutation of 0..n-1 that ``key`` picks, by swap-or-not rounds.

    Each round is a projection of its own, so that they are compiled into loops; a loop ends at a coalesce that changes nothing, before it is too long for the JVM to compile.
    """
    df = df.withColumns({name: index.cast("long"), "__n": n.cast("long"), "__key": key})
    x = F.col(name)
    for i in range(rounds):
        if i % LOOP == 0:
            df = df.coalesce(tasks)
        df = df.withColumn("__other", F.pmod(F.pmod(F.xxhash64("__key", F.lit(i)), F.col("__n")) - x, F.col("__n")))
        swap = F.xxhash64("__key", F.lit(i), F.greatest(x, F.col("__other")), F.lit(1)).bitwiseAND(F.lit(1).cast("long")) == 1
        df = df.withColumn(name, F.when(swap, F.col("__other")).otherwise(x))
    return df.drop("__n", "__key", "__other")


def sized(docs: DataFrame, row: str | None = None) -> DataFrame:
    """The narrow rows that ``mix`` works on: a row key, doc_id, source, size in words and a hash for the order."""
    return docs.select(
        F.monotonically_increasing_id().alias("__row") if row is None else F.col(row).alias("__row"),
        "doc_id",
        "source",
        F.when(F.col("text").isNull(), 0).otherwise(F.size(words(F.col("text")))).cast("long").alias("size"),
        F.xxhash64("doc_id", F.lit(SEED), F.xxhash64("text")).alias("h"),
    )


def sources_of(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """A written table of the sources: source, src (by code point, null last), docs, source_size, target, block_words, blocks, quota, base (quotas of the sources before), slots (all quotas).

    Targets are the lesser of ``most`` times the size and the weight's share of a level; the level is raised until they meet the total.
    """
    found = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    found = running(found, [F.col("source").isNull(), F.col("source")], {"src": F.lit(1)})
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("src") % len(weights) + 1).cast("int"))
    found = table(found.withColumns({"w": w.cast("long"), "top": most * F.col("source_size")}), "sources")[0]
    total, level, full = found.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0], 0.0, -1
    while True:
        over = F.col("w") * F.lit(level) > F.col("top")
        got = found.agg(F.coalesce(F.sum(F.when(over, F.col("top"))), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("w"))), F.lit(0)), F.count_if(over)).first()
        if got[2] == full or not got[1]:
            break
        level, full = (total - got[0]) / got[1], got[2]
    found = found.withColumn("target", F.when(F.col("w") * F.lit(level) > F.col("top"), F.col("top").cast("double")).otherwise(F.col("w") * F.lit(level)))
    found = found.withColumn("block_words", F.greatest(F.lit(1), F.least(F.lit(block_words), F.expr(f"source_size DIV {block_words}"))).cast("long"))
    found = found.withColumn("blocks", F.ceil(F.col("source_size") / F.col("block_words")).cast("long"))
    found = found.withColumn("quota", F.when(F.col("source_size") > 0, F.round(F.col("target") * F.col("blocks") / F.col("source_size"))).otherwise(0).cast("long"))
    found = running(found.drop("w", "top"), [F.col("src")], {"base": F.col("quota")})
    slots = found.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    return table(found.withColumn("slots", F.lit(slots).cast("long")), "sources")[0]


def slots_of(sources: DataFrame, seed: int = SEED, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix's slots, as a written table: src, block, and shard and slot (within the shard) that the draw deals it to."""
    spark = sources.sparkSession
    some = sources.where("quota > 0").select("src", "blocks", "quota", "base", "slots")
    some = some.withColumn("begin", F.explode(F.sequence(F.lit(0).cast("long"), F.col("quota") - 1, F.lit(RANGE_SLOTS).cast("long"))))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    some = some.repartition(tasks, "src", "begin")
    last = F.least(F.col("begin") + RANGE_SLOTS, F.col("quota")) - 1
    some = some.withColumn("j", F.explode(F.sequence("begin", last))).drop("begin", "quota")
    some = permuted(some, "place", F.col("base") + F.col("j"), F.col("slots"), F.xxhash64(F.lit(seed), F.lit("shards")), tasks)
    some = permuted(some, "block", F.pmod("j", "blocks"), F.col("blocks"), F.xxhash64(F.lit(seed), F.col("src"), F.expr("j DIV blocks")), tasks)
    # Written, so that no condition on the slots is pushed through the rounds, which would spell them out again and again.
    return cut(some.select("src", "block", F.expr(f"place DIV {shard_slots}").alias("shard"), F.pmod("place", F.lit(shard_slots).cast("long")).alias("slot")))


def mix(rows: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED) -> dict[str, DataFrame]:
    """Of a kept table of ``sized`` rows: ``rows`` (with src, source_size and target), ``pieces`` (each row's share of each block), and ``slots`` (src, block, shard, slot)."""
    sources = sources_of(rows, block_words=block_words)
    recipe = sources.select(F.col("source").alias("s"), "src", "source_size", "target", "block_words", F.greatest(F.lit(1), F.ceil(F.col("docs") / BUCKET_ROWS)).cast("long").alias("parts"))
    rows = rows.join(recipe, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("part", F.pmod("h", "parts"))

    # Running sums in two levels: within parts of bounded size, and over the parts' totals.
    order = W.partitionBy("src", "part").orderBy("h", "doc_id", "size", "__row").rowsBetween(W.unboundedPreceding, -1)
    parts = rows.groupBy("src", "part").agg(F.sum("size").alias("n"))
    parts = parts.withColumn("base", F.coalesce(F.sum("n").over(W.partitionBy("src").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    placed = rows.withColumn("at", F.coalesce(F.sum("size").over(order), F.lit(0))).join(parts.select("src", "part", "base"), ["src", "part"])
    begin, b = F.col("at") + F.col("base"), F.col("block_words")
    pieces = placed.where("size > 0").select("__row", "src", b, begin.alias("begin"), (begin + F.col("size")).alias("end"))
    pieces = pieces.withColumn("block", F.explode(F.sequence(F.expr("begin DIV block_words"), F.expr("(end - 1) DIV block_words"))))
    lo, hi = F.greatest(F.col("begin"), F.col("block") * b), F.least(F.col("end"), (F.col("block") + 1) * b)
    pieces = pieces.select("__row", "src", "block", (lo - F.col("begin")).alias("from"), (hi - lo).alias("words"))
    return {"rows": rows, "pieces": pieces, "slots": slots_of(sources, seed)}


def mixed_blocks(docs: DataFrame) -> DataFrame:
    """The mix itself: shard, slot (within the shard), source number, block, and the words [from, from + words) of a row that lie in it."""
    m = mix(cut(sized(docs)))
    return m["slots"].join(m["pieces"], ["src", "block"]).select("shard", "slot", "src", "block", "__row", "from", "words")


def _draws(m: dict[str, DataFrame]) -> DataFrame:
    """Each piece of a block that the mix takes, how often, and the first shard that takes it."""
    draws = m["slots"].groupBy("src", "block").agg(F.count(F.lit(1)).alias("draws"), F.min("shard").alias("shard"))
    return m["pieces"].join(draws, ["src", "block"])


@alone
def mix_shares(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (words that the mix takes, repeats counted) and first_shard (null: none) of every row.

    Rows of one doc_id are told apart. Null texts have no words; null sources are one source, the last. Without any word all targets are 0. A very long text is
    one row of as many pieces as it has blocks. An empty table gives no rows; other columns don't matter.
    """
    m = mix(cut(sized(docs)))
    taken = _draws(m).groupBy("__row").agg(F.sum(F.col("words") * F.col("draws")).alias("taken"), F.min("shard").alias("first_shard"))
    return m["rows"].join(taken, "__row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "first_shard")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with each text replaced by the words that the mix takes of it, in their order, a block's words as often as it is drawn; n_chars
    follows. Rows of which nothing is taken go. A text of which each word is taken once stays as it is. Other columns stay."""
    rows = keyed(docs)
    m = mix(cut(sized(rows.select("__row", "doc.doc_id", "doc.source", "doc.text"), "__row")))
    took = _draws(m).groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("from", "words", "draws"))).alias("p"), F.max("draws").alias("most"), F.sum("words").alias("n"))
    rows = rows.join(took, "__row").withColumn("w", words(F.col("doc.text")))
    part = lambda p: F.flatten(F.array_repeat(F.slice("w", (p["from"] + 1).cast("int"), p["words"].cast("int")), p["draws"].cast("int")))
    whole = (F.col("most") == 1) & (F.col("n") == F.size("w"))
    rows = rows.withColumn("text", F.when(whole, F.col("doc.text")).otherwise(F.array_join(F.flatten(F.transform("p", part)), " ")))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return rows.select(*[(new[c].cast(docs.schema[c].dataType) if c in new else F.col("doc")[c]).alias(c) for c in docs.columns])
