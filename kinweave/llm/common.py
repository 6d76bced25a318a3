"""What the operators share: table reading, Arrow passes over texts, the shingling of texts."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from kinweave.session import ship_package

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of an Arrow batch that a worker gets, unless the session asks for fewer.
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def returning_memory(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, giving freed memory back when a task ends: workers live on and stand beside the next stage's memory."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return task


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, as texts may be very long."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(str(spark.conf.get(name)).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def by_batch(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | Iterable[pa.RecordBatch]]], schema: str
) -> DataFrame:
    """Map a table's Arrow batches; ``make`` builds the function once per task.

    The package goes to the workers first, so ``make`` may live in any of its modules.
    """
    ship_package(df.sparkSession)
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield from [out] if isinstance(out, pa.RecordBatch) else out

    return df.mapInArrow(returning_memory(run), schema)


class Generations:
    """A cache of bounded size: ``turn`` forgets what was not used for a generation of ``size`` entries.

    A generation also ends when the keys that ``unknown`` found new have 64 characters for each of ``size``.
    """

    def __init__(self, size: int):
        self.size, self.young, self.old, self.length = size, {}, {}, 0

    def turn(self) -> None:
        if len(self.young) >= self.size or self.length >= 64 * self.size:
            self.young, self.old, self.length = {}, {k: v for k, v in self.young.items() if len(k) <= 64}, 0

    def unknown(self, keys: set) -> set:
        """``turn``, then those of the keys that are new; the ones that only the last generation knows are taken over."""
        self.turn()
        new = keys.difference(self.young)
        revived = new & self.old.keys()
        self.young.update(zip(revived, map(self.old.__getitem__, revived)))
        new -= revived
        self.length += sum(map(len, new))
        return new

    def revive(self, key) -> bool:
        """Take a key that only the last generation knows over into this one."""
        found = self.old.get(key)
        if found is not None:
            self.young[key] = found
        return found is not None


class _WordHashes(dict):
    LIMIT = 1 << 17

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_hashes = _WordHashes()


def words_of(text: str) -> list[str]:
    """The words of a text: what stands between spaces, tabs and line ends (code points 9 to 13 and 32)."""
    if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return text.split()
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def shingle_hashes(text: str, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    A text of fewer words than ``size`` has one shingle, of all its words; a text without words has none.
    """
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - size + 1)
    out = np.full(n, len(h[:size]), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(size, len(h))):
            out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
            out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
    return np.unique(out)
