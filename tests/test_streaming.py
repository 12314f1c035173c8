import hashlib
from collections import Counter
from datetime import datetime

from packloom.streaming import arrivals as A


def put(spark, folder, rows):
    spark.createDataFrame([(p, bytearray(c), datetime(2024, 1, 1, h, m)) for p, c, h, m in rows], A.ARRIVED).coalesce(1).write.mode("append").parquet(folder)


def run(df, folder, mode="append"):
    """The rows that a stream has given, once all that is there has been read."""
    df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/out")


def test_stream_is_the_batch(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "a")
    first = [("a/plan.pdf", b"%PDF-1.4", 1, 0), ("b/x.txt", b"words", 1, 5), ("~$lock.txt", b"x", 1, 6), ("c/none", b"\xff\xfe", 1, 7)]
    put(spark, src, first)
    got = run(A.registered(A.arrivals(spark, src)), out)
    assert {(r.logical_path, r.file_type, r.disposition, r.classification) for r in got.collect()} == {
        ("a/plan.pdf", "pdf", "registered", "drawing set"), ("b/x.txt", "text", "registered", "unknown"), ("~$lock.txt", "text", "ignored", "unknown"), ("c/none", "unknown", "registered_with_warnings", "unknown"),
    }
    put(spark, src, [("d.csv", b"a,b", 2, 0)])
    got = run(A.registered(A.arrivals(spark, src)), out)  # goes on where it stopped
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, A.registered(spark.read.schema(A.ARRIVED).parquet(src)).collect())) and got.count() == 5
    assert {r.file_hash for r in got.where("logical_path = 'd.csv'").collect()} == {hashlib.sha256(b"a,b").hexdigest()}


def test_copies_and_late_files(spark, tmp_path):
    src = str(tmp_path / "in")
    put(spark, src, [("a.txt", b"1", 1, 0), ("a.txt", b"1", 1, 1), ("b.txt", b"1", 1, 2)])
    first = lambda: run(A.first_copies(A.registered(A.arrivals(spark, src, 1))), str(tmp_path / "first"))
    hours = lambda: run(A.counts(A.registered(A.arrivals(spark, src, 1))), str(tmp_path / "counts"))
    assert sorted(r.logical_path for r in first().collect()) == ["a.txt", "b.txt"]
    hours()
    put(spark, src, [("a.txt", b"1", 3, 0), ("c.txt", b"22", 3, 1)])
    assert sorted(r.logical_path for r in first().collect()) == ["a.txt", "b.txt", "c.txt"]
    hours()
    put(spark, src, [("late.txt", b"333", 1, 30), ("d.txt", b"4", 5, 0)])  # the first hour is over
    hours()
    put(spark, src, [("e.txt", b"5", 9, 0)])
    got = {(r.start.hour, r.classification): (r.n_files, r.bytes) for r in hours().collect()}
    assert got == {(1, "unknown"): (3, 3), (3, "unknown"): (2, 3), (5, "unknown"): (1, 1)}
