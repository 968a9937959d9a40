"""Helpers of the operators: tables in the shared folder, hashing of words on whole batches."""

from __future__ import annotations

import contextlib
import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.context import shared_folder

#: White space between words, and the letters that are lower-cased.
SPACES = "\t\n\x0b\x0c\r "
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows that may be broadcast; beyond it the same join shuffles.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: cuts the lineage, survives lost executors.

    The files go with ``release``, or else when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.stored_at = path
    return kept


def release(*frames: DataFrame) -> None:
    """Removes the files of ``stored`` frames that nothing reads any more.

    The shuffles they were made with go as well: Spark removes their files when the driver's JVM has collected them.
    """
    frames[0].sparkSession._jvm.System.gc()
    for df in frames:
        place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def tidy(task: Callable) -> Callable:
    """A task over batches that gives the memory it has freed back to the machine at its end.

    Python workers are used again for other stages, and would keep it.
    """

    @functools.wraps(task)
    def run(batches):
        yield from task(batches)
        import ctypes
        import gc

        import pyarrow as pa

        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # other systems have no such call
            ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df``, marked for broadcast only if it is counted to be within the bound."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words of a text; none for null."""
    split = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), f"[{SPACES}]+")
    return F.filter(split, lambda word: word != "")


# --- numpy: words and shingles of a batch of texts -------------------------------------------

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES.encode())] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64, up to ``n``."""
    if len(_powers[0]) <= n:
        for k, factor in enumerate((_BASE, _INVERSE)):
            row = np.full(n + 1, factor, np.uint64)
            row[0] = 1
            _powers[k] = np.cumprod(row, dtype=np.uint64)
    return _powers[0], _powers[1]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """H with H[e] - H[s], times the inverse base to the s, a hash of data[s:e]; modulo 2**64."""
    base, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * base[: len(data)], dtype=np.uint64, out=out[1:])
    return out


def word_places(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of the texts one after another, where words begin and end there, and the first word of
    each text (one more)."""
    data = np.frombuffer(b" ".join([*texts, b""]).translate(_FOLD), np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _IS_SPACE[data], [True])).view(np.int8)))
    first, last = edge[0::2], edge[1::2]
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return data, first, last, np.searchsorted(first, starts)


def span_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hashes of the stretches of the data."""
    sums, inverse = prefix_hashes(data), powers(len(data))[1]
    return mix((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts in order, and where each text's words begin (one more)."""
    data, first, last, begins = word_places(texts)
    return span_hashes(data, first, last), begins


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of a document's ``n``-word shingles; of all its words where they are fewer."""
    if not len(hashes):
        return hashes
    n = min(n, len(hashes))
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        out = mix(out * _BASE + hashes[k : len(hashes) - n + 1 + k])
    return np.unique(out + np.uint64(n))


def slices(texts: list[bytes], most: int = 1 << 20) -> Iterator[slice]:
    """Runs of texts of about ``most`` bytes, so that work arrays stay small; a longer text is one run."""
    begin = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > most:
            yield slice(begin, k)
            begin, size = k, 0
        size += len(text) + 1
    if begin < len(texts):
        yield slice(begin, len(texts))


def pieces(batches: Iterator, rows: int = 1000) -> Iterator:
    """The batches in pieces of so many rows, so that only one piece's texts and results are held at once."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def as_bytes(column) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column; null counts as empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
