"""Quality rules, with DataFrame functions alone: base measures of each text, and cross-document line frequency by host.

Lines are normalised (lower case, white space collapsed) and hashed with their host. A line that more than ``MIN_DOCS`` documents
of a host have, and more than ``PERCENT_DOCS`` percent of the host's documents, is boilerplate and removed; a document that keeps
less than ``PERCENT_LEFT`` percent of its lines' characters is depleted and rejected.

The text is read once, in one map stage. Counting pre-aggregates before its shuffle, the join with the removed lines is one of plain
shuffled sides, which can be split where a line is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packloom.llm._store import alone, cut, keyed

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MIN_DOCS = 10
PERCENT_DOCS = 1
PERCENT_LEFT = 30


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def _measures(docs: DataFrame) -> DataFrame:
    """One row a document: base measures, and the hashes and lengths of its normalised lines."""
    low32 = F.lit(0xFFFFFFFF)
    d = docs.select("doc_id", "source", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    d = d.withColumns({"w": words(F.col("t")), "l": F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    d = d.withColumns({"n": F.size("w").cast("long"), "h": F.transform("w", lambda x: F.xxhash64(x))})
    # Three words' hash in the upper half, their place in the lower: equal windows become neighbours by a sort of plain longs.
    window = lambda i: F.shiftleft(F.xxhash64(F.get("h", i), F.get("h", i + 1), F.get("h", i + 2)), 32).bitwiseOR(i.cast("long"))
    d = d.withColumn("p", F.when(F.col("n") >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), (F.col("n") - 3).cast("int")), window))).otherwise(F.array().cast("array<bigint>")))
    twin = lambda x, i: F.coalesce(F.shiftright(x, 32) == F.shiftright(F.get("p", i - 1), 32), F.lit(False)) | F.coalesce(F.shiftright(x, 32) == F.shiftright(F.get("p", i + 1), 32), F.lit(False))
    d = d.withColumn("c", F.transform(F.filter("p", twin), lambda x: x.bitwiseAND(low32).cast("int")))
    # Of these few the words themselves are compared.
    d = d.withColumn("s", F.sort_array(F.transform("c", lambda i: F.struct(F.concat_ws(" ", F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("s"), i.alias("i")))))
    same = lambda x, i: F.coalesce(x["s"] == F.get("s", i - 1)["s"], F.lit(False)) | F.coalesce(x["s"] == F.get("s", i + 1)["s"], F.lit(False))
    d = d.withColumn("r", F.sort_array(F.transform(F.filter("s", same), lambda x: x["i"])))
    covered = F.transform("r", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("r", i + 1) - x, F.lit(3))).cast("long"))
    d = d.withColumn("norm", F.transform("l", lambda x: F.trim(F.regexp_replace(F.lower(x), SPACES, " "))))
    return d.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.xxhash64("source").alias("host"),
        F.col("n").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"),
        F.transform("norm", lambda x: F.xxhash64("source", x)).alias("lines"),
        F.transform("norm", lambda x: F.length(x)).alias("chars"),
    )


def _documents(measured: DataFrame) -> DataFrame:
    """(host, doc, lines): rows whose doc_id is null or only theirs are documents by themselves; a doc_id of several rows is one document a host, whose lines count once."""
    named, rows = measured.where("doc_id IS NOT NULL"), measured.select("host", "doc_id", "lines")
    several = cut(named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("again")))
    marked = rows.where("doc_id IS NOT NULL").join(several, F.col("doc_id") == F.col("again"), "left").select("host", F.col("again").alias("doc"), "lines")
    return marked.unionByName(rows.where("doc_id IS NULL").select("host", F.col("doc_id").alias("doc"), "lines"))


def removed_lines(measured: DataFrame, min_docs: int = MIN_DOCS, percent: int = PERCENT_DOCS) -> DataFrame:
    """The hashes of lines (each with its host) that go, by the distinct documents that have them."""
    docs = _documents(measured)
    count = F.count(F.lit(1)).alias("docs")
    alone_, shared = docs.where("doc IS NULL"), docs.where("doc IS NOT NULL")
    lines = lambda d: d.select("host", "doc", F.explode(F.array_distinct("lines")).alias("line"))
    hosts = alone_.groupBy("host").agg(count).unionByName(shared.select("host", "doc").distinct().groupBy("host").agg(count))
    hosts = hosts.groupBy("host").agg(F.sum("docs").alias("host_docs"))
    seen = lines(alone_).select("host", "line").unionByName(lines(shared).distinct().select("host", "line"))
    often = seen.groupBy("line").agg(count, F.min("host").alias("host")).where(F.col("docs") > min_docs)
    return cut(often.join(hosts, "host").where(100 * F.col("docs") > percent * F.col("host_docs")).select("line"))


@alone
def judge_quality(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and kept of every row.

    Each row is measured and judged by itself; in the counts of a line and of its host, rows of one doc_id are one document, and each row of a null one is a document. Null texts have no words and fail the base
    rules; the rows of a null source are one host. A very long text is one row, whose words and lines are arrays within it.
    An empty table gives no rows; other columns don't matter.
    """
    measured = cut(_measures(docs))
    lines = measured.select("row", F.inline(F.arrays_zip(F.col("lines").alias("line"), F.col("chars").alias("c"))))
    gone = lines.join(removed_lines(measured), "line").groupBy("row").agg(F.sum("c").alias("gone"))
    total = F.aggregate("chars", F.lit(0).cast("long"), lambda a, x: a + x)
    rows = measured.withColumn("total", total).drop("lines", "chars", "host").join(gone, "row", "left")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = 100 * (F.col("total") - F.coalesce("gone", F.lit(0))) >= PERCENT_LEFT * F.col("total")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & left).alias("kept"))


def cleaned_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with the removed lines cut from ``text``, other lines unchanged; null texts stay null, other columns stay."""
    rows = keyed(docs)
    gone = removed_lines(cut(_measures(rows.select("doc.doc_id", "doc.source", "doc.text"))))
    parts = rows.select("__row", F.col("doc.source").alias("source"), F.posexplode(F.split("doc.text", "\n")).alias("i", "part"))
    parts = parts.withColumn("line", F.when(F.col("part").rlike(r"[^\x20\x09-\x0D]"), F.xxhash64("source", F.trim(F.regexp_replace(F.lower("part"), SPACES, " ")))))
    kept = parts.join(gone, "line", "left_anti").groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("i", "part"))).alias("p"))
    rows = rows.join(kept, "__row", "left")
    text = F.when(F.col("doc.text").isNotNull(), F.coalesce(F.array_join(F.transform("p", lambda x: x["part"]), "\n"), F.lit("")))
    return rows.select(*[(text if c == "text" else F.col("doc")[c]).alias(c) for c in docs.columns])
