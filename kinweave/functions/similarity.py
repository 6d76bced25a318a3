"""Jaro-Winkler similarity over code points, one Arrow batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

# Fixed values of the string comparator: the prefix bonus applies above this Jaro value, counts at most
# this many leading characters and gives each this share of the missing similarity.
BOOST_ABOVE = 0.7
PREFIX_MAX = 4
PREFIX_WEIGHT = 0.1


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts in a row, and the text lengths."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32), lengths


def _grid(points: np.ndarray, lengths: np.ndarray, dtype: type, end: int) -> np.ndarray:
    """One text per line, filled up with ``end``."""
    filled = np.arange(max(lengths.max(initial=0), 1)) < lengths[:, None]
    grid = np.full(filled.shape, end, dtype=dtype)
    grid[filled] = points
    return grid


def _matches_by_bits(a, b, len_a, reach):
    """Matched cells of both grids for texts of at most 64 characters, a text's cells being the bits of a word.

    Each character on the right takes the first free equal character on the left within reach.
    """
    ones = np.array([(1 << k) - 1 for k in range(65)], dtype=np.uint64)
    wide = np.zeros((len(a), 64), dtype=a.dtype)
    wide[:, : a.shape[1]] = a
    free, used_b = ones[len_a], np.zeros(b.shape, dtype=bool)
    for j in range(b.shape[1]):
        equal = np.packbits((wide == b[:, j : j + 1]).ravel(), bitorder="little").view(np.uint64)
        equal &= free & ones[np.minimum(j + reach + 1, 64)] & ~ones[np.minimum(np.maximum(j - reach, 0), 64)]
        free ^= equal & (~equal + np.uint64(1))
        used_b[:, j] = equal != 0
    used = np.unpackbits((free ^ ones[len_a]).view(np.uint8), bitorder="little").reshape(len(a), 64)
    return used[:, : a.shape[1]].astype(bool), used_b


def _matches_by_cells(a, b, len_a, reach):
    """The same for longer texts."""
    rows, pos = np.arange(len(a)), np.arange(a.shape[1])
    free, used_b = pos < len_a[:, None], np.zeros(b.shape, dtype=bool)
    for j in range(b.shape[1]):
        fits = free & (a == b[:, j : j + 1]) & (np.abs(pos - j) <= reach[:, None])
        first = fits.argmax(axis=1)
        hit = np.nonzero(fits[rows, first])[0]
        free[hit, first[hit]] = False
        used_b[hit, j] = True
    return (pos < len_a[:, None]) & ~free, used_b


def jaro_winkler_batch(left: list[str], right: list[str]) -> np.ndarray:
    """Similarity of each pair of texts; all pairs advance together, one right-hand character at a time."""
    (points_a, len_a), (points_b, len_b) = _code_points(left), _code_points(right)
    long = np.maximum(len_a, len_b) > 64
    if long.any() and not long.all():
        out = np.empty(len(left))
        for part in (np.nonzero(long)[0], np.nonzero(~long)[0]):
            out[part] = jaro_winkler_batch([left[i] for i in part], [right[i] for i in part])
        return out
    # The narrowest type whose two largest values are free to fill up the texts, and equal nothing.
    highest = max(points_a.max(initial=0), points_b.max(initial=0))
    dtype = next(t for t in (np.uint8, np.uint16, np.uint32) if highest < np.iinfo(t).max - 1)
    a = _grid(points_a, len_a, dtype, np.iinfo(dtype).max)
    b = _grid(points_b, len_b, dtype, np.iinfo(dtype).max - 1)
    reach = np.maximum(np.maximum(len_a, len_b) // 2 - 1, 0)
    used_a, used_b = (_matches_by_cells if long.any() else _matches_by_bits)(a, b, len_a, reach)
    common = used_a.sum(axis=1)
    # Both sides hold the same number of matched characters per row, so the flattened lists line up.
    moved = np.bincount(np.nonzero(used_a)[0], weights=a[used_a] != b[used_b], minlength=len(left)) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(common > 0, (common / len_a + common / len_b + (common - moved) / common) / 3, 0.0)
    lead = min(PREFIX_MAX, a.shape[1], b.shape[1])
    same = (a[:, :lead] == b[:, :lead]) & (np.arange(lead) < np.minimum(len_a, len_b)[:, None])
    prefix = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    return np.where(jaro > BOOST_ABOVE, jaro + PREFIX_WEIGHT * prefix * (1 - jaro), jaro)


@F.arrow_udf(T.DoubleType())
def _jaro_winkler(left: pa.Array, right: pa.Array) -> pa.Array:
    known = pc.and_(left.is_valid(), right.is_valid())
    both = known.to_numpy(zero_copy_only=False)
    out = np.zeros(len(left))
    if both.any():
        # Names repeat a lot within a batch, so each distinct pair is compared once.
        a, b = left.filter(known).dictionary_encode(), right.filter(known).dictionary_encode()
        ids_b = len(b.dictionary)
        pairs, where = np.unique(a.indices.to_numpy().astype(np.int64) * ids_b + b.indices.to_numpy(), return_inverse=True)
        score = jaro_winkler_batch(
            a.dictionary.take(pa.array(pairs // ids_b)).to_pylist(), b.dictionary.take(pa.array(pairs % ids_b)).to_pylist()
        )
        out[both] = score[where]
    return pa.array(out, mask=~both)


def jaro_winkler(left: str | Column, right: str | Column) -> Column:
    """Similarity in [0, 1]; null where a side is null.

    The pair is put in text order first, so swapping the sides never changes the result. Equal texts are
    answered without the UDF.
    """
    left, right = (F.col(c) if isinstance(c, str) else c for c in (left, right))
    differs = left != right
    udf = _jaro_winkler(F.when(differs, F.least(left, right)), F.when(differs, F.greatest(left, right)))
    return F.when(left == right, F.lit(1.0)).otherwise(udf)
