"""Helpers the operators share: words as 64-bit hashes, batches of rows, bounded broadcasts."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Entries a per-task memo may hold before it is emptied; it bounds memory, never the result.
MEMO = 100_000

#: Rows of two 64-bit columns (16 MB) that may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    binary = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    return [b"" if x is None else x for x in binary.to_pylist()]


def texts_of(column: pa.Array) -> list[str]:
    """Texts of a column, null as empty."""
    return ["" if x is None else x for x in column.to_pylist()]


class Memo(dict):
    """What ``find`` gives for a key, remembered for two generations of ``limit`` keys."""

    def __init__(self, limit: int = MEMO) -> None:
        self.limit = limit
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.find(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value

    def find(self, key):
        raise NotImplementedError


_ODD = 0x9E3779B97F4A7C15
_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)


def _powers(base: int, n: int) -> np.ndarray:
    """``base**i`` modulo 2**64 for i below n."""
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    done = 1
    step = base & 0xFFFFFFFFFFFFFFFF
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(step)
        step = step * step & 0xFFFFFFFFFFFFFFFF
        done += more
    return out


class Rolling:
    """Hashes of word sequences inside one text, by prefix sums of a polynomial modulo 2**64."""

    def __init__(self, hashes: np.ndarray, base: int = _BASES[0]) -> None:
        n = len(hashes)
        inverse = pow(base, -1, 1 << 64)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * _powers(base, n), out=self._sums[1:])
        self._unshift = _powers(inverse, n + 1)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the words in [start, end); sequences of different length differ too."""
        raw = (self._sums[ends] - self._sums[starts]) * self._unshift[starts]
        return mixed(raw + (ends - starts).astype(np.uint64) * np.uint64(_ODD))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lists(parts: list[np.ndarray], kind: type = np.int64) -> pa.ListArray:
    """A list column from one array per row."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.empty(0, kind)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(kind, copy=False)))


def small_batches(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes, so that a task's memory stays small.

    After the last one, freed memory is given back: the worker may wait idle while others need it.
    """
    for batch in batches:
        step = max(1, int(batch.num_rows * size / max(batch.nbytes, size)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
    trim_memory()


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df`` (narrow, and cheap to count) with a broadcast hint if its counted rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


class Words:
    """The words of a batch of texts end to end, as hashes; word ``i`` belongs to row ``row[i]``.

    Words are runs of bytes that aren't ASCII white space. All is done on one array of bytes: a word's
    hash is that of its bytes under a table of random values, once for each of ``tables`` tables.
    """

    def __init__(self, texts: list[bytes], tables: int = 1) -> None:
        data = np.frombuffer(b" ".join([*texts, b""]) or b" ", np.uint8)
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        before = np.concatenate([[True], blank[:-1]])
        starts, ends = np.flatnonzero(~blank & before), np.flatnonzero(blank & ~before)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.row = np.searchsorted(np.cumsum(lengths), starts, side="right")
        self.counts = np.bincount(self.row, minlength=len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.counts)]).astype(np.int64)
        self.rolling = []
        for table in range(tables):
            values = mixed(np.arange(256, dtype=np.uint64) + np.uint64(1 + 1000 * table))
            words = Rolling(values[data], _BASES[table]).spans(starts, ends)
            self.rolling.append(Rolling(words, _BASES[table] ^ 0xABCDEF0))

    def starts(self, length: int) -> np.ndarray:
        """Places where ``length`` words of one row begin."""
        n = len(self.row)
        if n < length:
            return np.empty(0, np.int64)
        return np.flatnonzero(self.row[: n - length + 1] == self.row[length - 1 :])


def text_key(text: str) -> list:
    """Two independent 64-bit hashes that stand for a whole text (null as empty)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(whole).alias("k1"), F.xxhash64(F.lit("again"), whole).alias("k2")]


def release_memory() -> None:
    """Give memory back to the system, also what cycles hold; a worker that served earlier stages may hold much of it."""
    gc.collect()
    trim_memory()


def trim_memory() -> None:
    """Give freed memory of Arrow and of the C library back to the system; not all of them offer that."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        return


def modest_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Let tasks and their Python workers exchange at most ``rows`` rows at a time.

    Spark's default of 10,000 is meant for narrow rows; with whole texts on both sides, and one more copy
    on either end, it can fill an executor. A session that sets less keeps it.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > rows:
        spark.conf.set(name, str(rows))
