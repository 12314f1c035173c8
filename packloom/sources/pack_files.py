"""All files below a folder, listed and read by tasks: hidden, underscored and empty ones too, which the built-in file sources leave out."""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packloom.functions.files import IGNORED_NAMES, TEMPORARY_PREFIX
from packloom.ship import ship
from packloom.sources.shared import filesystem, scratch, written

SCHEMA = (
    "path string, relative_path string, file_name string, size_bytes bigint, bytes_read bigint, "
    "sha256 string, head binary, pdf_markers bigint, error string, sniff_ms double, hash_ms double"
)
BLOCK = 1 << 20
HEAD_BYTES = 4096
PARTITION_BYTES, FILE_BYTES = 64 << 20, 1 << 16
#: Rows that go on at once.
LIST_ROWS = 1000
_MARKER = re.compile(rb"/Type ?/Page")
_KEEP = 16  # a marker is shorter


def scan(stream, wanted=None) -> tuple[str, int, bytes, int, bytes | None]:
    """SHA-256, length, head, page markers and, if ``wanted`` says so of the head, the bytes of a stream of any length, read in blocks; a marker across two blocks counts once."""
    digest, n, head, markers, carry, parts = hashlib.sha256(), 0, b"", 0, b"", None
    while block := stream.read(BLOCK):
        if n == 0 and wanted is not None and wanted(block[:HEAD_BYTES]):
            parts = []
        digest.update(block)
        n += len(block)
        head += block[: HEAD_BYTES - len(head)]
        data = carry + block
        markers += sum(m.end() > len(carry) for m in _MARKER.finditer(data))
        carry = data[-_KEEP:]
        if parts is not None:
            parts.append(block)
    return digest.hexdigest(), n, head, markers, None if parts is None else b"".join(parts)


def ignored(name: str) -> bool:
    low = name.casefold()
    return low.startswith(TEMPORARY_PREFIX) or low in IGNORED_NAMES


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies in each folder: path, whether it is a folder, size."""
    from pyarrow import fs

    for batch in batches:
        for folder in batch.column("path").to_pylist():
            where, base = filesystem(folder)
            found = where.get_file_info(fs.FileSelector(base))
            for a in range(0, len(found), LIST_ROWS):
                some = [f for f in found[a : a + LIST_ROWS] if f.type in (fs.FileType.File, fs.FileType.Directory)]
                cols = [[f"{folder}/{f.base_name}" for f in some], [f.type == fs.FileType.Directory for f in some], [f.size or 0 for f in some]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.bool_(), pa.int64()))], names=["path", "folder", "size_bytes"])


def listed(spark: SparkSession, root: str) -> tuple[DataFrame, list[str]]:
    """path and size_bytes of all files below ``root``, as written tables, and their folders, for the caller to remove.

    A frontier of folders moves down a level a round: tasks list the folders of the level before, dealt out by their paths. The driver learns whether there are more.
    """
    ship(spark)
    frontier, files, folders = spark.createDataFrame([(root.rstrip("/"),)], "path string"), None, []
    while True:
        folders.append(scratch(spark, "listed"))
        level = written(frontier.mapInArrow(_children, "path string, folder boolean, size_bytes bigint"), folders[-1])
        some = level.where("NOT folder").select("path", "size_bytes")
        files = some if files is None else files.unionByName(some)
        frontier = level.where("folder").select("path")
        if (n := frontier.count()) == 0:
            return files, folders
        frontier = frontier.repartition(min(n, 4 * spark.sparkContext.defaultParallelism), "path")


def _sniffed(batches: Iterator[pa.RecordBatch], root: str, hashed: bool) -> Iterator[pa.RecordBatch]:
    """Files read: hashed whole, or their heads alone. Rows go on when their heads fill a batch."""
    where, _ = filesystem(root)
    for batch in batches:
        held = []
        for path, size in zip(batch.column("path").to_pylist(), batch.column("size_bytes").to_pylist()):
            relative = path[len(root) + 1 :]
            name = relative.rsplit("/", 1)[-1]
            n, digest, head, markers, error, times = 0, None, b"", 0, None, [time.perf_counter()] * 3
            try:
                with where.open_input_stream(filesystem(path)[1], compression=None) as stream:
                    if hashed and not ignored(name):  # ignored files are only sniffed
                        digest, n, head, markers, _ = scan(stream)
                        times[2] = time.perf_counter()
                    else:
                        head = stream.read(HEAD_BYTES)
                        times[1] = times[2] = time.perf_counter()
            except OSError as e:
                digest, error = None, str(e)[:200]
            held.append((path, relative, name, size, n, digest, head, markers, error, (times[1] - times[0]) * 1000, (times[2] - times[1]) * 1000))
            if len(held) == LIST_ROWS:
                yield _batch(held)
                held = []
        if held:
            yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    fields = [x.split() for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def pack_files(spark: SparkSession, root: str, hashed: bool = True) -> tuple[DataFrame, list[str]]:
    """Every file below ``root``, hashed or (unless ``hashed``) only sniffed; and the folders of the listing that this reads, for the caller to remove when it has been.

    Files are dealt out by their paths, so that a task gets some ``PARTITION_BYTES``, each file counted as ``FILE_BYTES`` more.
    """
    root = root.rstrip("/")
    files, folders = listed(spark, root)
    cost = F.when(F.lit(hashed), F.col("size_bytes")).otherwise(0) + FILE_BYTES
    total = files.agg(F.coalesce(F.sum(cost), F.lit(0))).first()[0]
    tasks = max(1, min(files.count(), max(4 * spark.sparkContext.defaultParallelism, total // PARTITION_BYTES)))
    return files.repartition(int(tasks), "path").mapInArrow(lambda b: _sniffed(b, root, hashed), SCHEMA), folders
