"""Whole-batch text helpers: Arrow batches in, numpy word positions and hashes out.

``annotate`` runs a function over Arrow batches of a DataFrame inside Spark's tasks. The functions below it work on
the UTF-8 bytes of many texts at once; memory is bounded by ``SLICE_BYTES`` (or by one text, if that is longer).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 2 << 20
BLOCK = 1 << 20

_MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
_byte_codes = np.random.default_rng(20).integers(1, _MASK, 256, dtype=np.uint64)
_byte_codes[65:91] = _byte_codes[97:123]  # A-Z count as a-z
_powers: dict[str, np.ndarray] = {}


def byte_set(test: Callable[[int], bool]) -> np.ndarray:
    return np.array([test(b) for b in range(256)])


SPACED = byte_set(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
ALPHANUMERIC = byte_set(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)


def crc_remainder(column, modulus: int):
    """crc32 of an id written as text, modulo ``modulus``; a null id counts as remainder 0 (held out)."""
    return F.coalesce(F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(modulus)), F.lit(0))


def bounded_sample(df: DataFrame, id_col: str, label_col: str, per_label: int) -> tuple[DataFrame, dict]:
    """About ``per_label`` rows of every label, chosen by a hash of their id, and the number of rows of each label.

    For fitting classifiers only: the counts cover all rows, the sample's expected size does not depend on them.
    """
    counts = {r[0]: r[1] for r in df.where(F.col(label_col).isNotNull()).groupBy(label_col).count().collect()}
    share = F.pmod(F.xxhash64(F.lit(77), F.col(id_col)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = F.lit(False)
    for label, n in counts.items():
        chosen = chosen | ((F.col(label_col) == F.lit(label)) & (share < F.lit(min(1.0, per_label / n))))
    return df.where(chosen), counts


def spread(text_col: str, chars: int, pieces: int) -> Column:
    """The text, or of a long one ``pieces`` pieces at equal distances, ``chars`` in all, without the words they cut."""
    size = chars // pieces
    step = (F.length(text_col) - size) / (pieces - 1)
    piece = lambda k: F.substr(text_col, (F.floor(step * k) + 1).cast("int"), F.lit(size))
    whole = lambda p: F.regexp_replace(F.regexp_replace(p, r"^\S*\s+", ""), r"\s+\S*$", "")
    joined = F.concat_ws(" ", *[whole(piece(k)) for k in range(pieces)])
    return F.when(F.length(text_col) <= chars, F.col(text_col)).otherwise(joined)


def annotate(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], dict[str, pa.Array]],
    fields: str,
    keep: list[str],
    reads: list[str],
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """``keep`` columns of ``df`` with the columns ``fields`` (a DDL string) that ``function`` makes of each batch.

    ``function`` gets a batch with the columns ``reads`` and returns arrays of the same length. New columns replace
    columns of ``keep`` with the same name. Nothing else of ``df`` is read.
    """
    new = T.StructType.fromDDL(fields)
    kept = [c for c in keep if c not in new.names]
    source = df.select(*dict.fromkeys([*kept, *reads]))
    schema = T.StructType([source.schema[c] for c in kept] + list(new))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, reads, limit):
                made = function(part)
                columns = [part.column(part.schema.get_field_index(c)) for c in kept] + [made[c] for c in new.names]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *new.names])

    return source.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, columns: list[str], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch with at most ``limit`` bytes of text each, one row at least."""
    sizes = np.zeros(batch.num_rows, np.int64)
    for name in columns:
        column = batch.column(batch.schema.get_field_index(name))
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) or pa.types.is_binary(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; null texts are empty."""
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def word_positions(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every maximal run of bytes of a kind; runs end where a text ends."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = kind[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = offsets[:-1][offsets[:-1] < len(data)]
    first[cut] = inside[cut]
    cut = offsets[1:][offsets[1:] > 0] - 1
    last[cut] = inside[cut]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1


def mix(values: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over the output."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def powers(base: int, size: int) -> np.ndarray:
    """base ** 0 .. base ** (size - 1), modulo 2 ** 64."""
    name = str(base)
    if name not in _powers or len(_powers[name]) < size:
        steps = np.full(max(size, 1), base, np.uint64)
        steps[0] = 1
        _powers[name] = np.cumprod(steps)
    return _powers[name][:size]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, equal for words that differ in the case of A-Z only.

    A polynomial in the byte codes, by running sums over blocks, so that no word is looked at on its own.
    """
    at_start, at_end = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    back = np.zeros(len(starts), np.uint64)
    up, down = powers(BASE, BLOCK), powers(BASE_INVERSE, BLOCK)
    carry = np.uint64(0)
    for a in range(0, len(data), BLOCK):
        b = min(a + BLOCK, len(data))
        sums = np.empty(b - a + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_byte_codes[data[a:b]] * up[: b - a], out=sums[1:])
        sums *= np.uint64(pow(BASE, a, 1 << 64))
        sums += carry
        i, j = np.searchsorted(starts, [a, b])
        at_start[i:j] = sums[starts[i:j] - a]
        back[i:j] = down[starts[i:j] - a] * np.uint64(pow(BASE_INVERSE, a, 1 << 64))
        i, j = np.searchsorted(ends, [a, b], side="right")
        at_end[i:j] = sums[ends[i:j] - a]
        carry = sums[-1]
    return mix((at_end - at_start) * back)


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` words, whatever text they are in."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - length + 1, np.uint64)
    for k in range(length):
        out *= np.uint64(BASE)
        out += words[k : k + len(out)]
    return mix(out + np.uint64(length))


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
