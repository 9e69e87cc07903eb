"""Integer arrays as compact bytes, and vectors as integer matrices: shared by the search and clustering operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_KINDS = [np.uint8, np.int8, np.uint16, np.int16, np.uint32, np.int32, np.int64]

# Larger components count as this: squares and products then stay exact in 64 bits for up to 1024 components.
MAX_COMPONENT = 1 << 25


def pack(values: np.ndarray) -> bytes:
    """Bytes of an integer array in the smallest type that holds it; one byte names the type."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    kind = next(i for i, k in enumerate(_KINDS) if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return bytes([kind]) + np.ascontiguousarray(values, _KINDS[kind]).tobytes()


def unpack(data: memoryview | bytes | pa.Buffer) -> np.ndarray:
    view = memoryview(data)
    return np.frombuffer(view[1:], _KINDS[view[0]]).astype(np.int64)


def ragged(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places first[i], first[i] + 1, ... (counts[i] of them), for every i in turn."""
    total = np.cumsum(counts)
    return np.repeat(first - (total - counts), counts) + np.arange(int(total[-1]) if len(total) else 0)


def integer_vectors(column: pa.Array, scale: int, size: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, sizes, components) of the usable vectors of a list column, each component as floor(scale * x).

    A vector is usable if it is not null, holds no null and no non-finite component, and has ``size`` components where
    that is given. Components of all usable vectors come one after another.
    """
    rows = len(column)
    if rows == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.cast(pc.list_flatten(column), pa.float64())
    missing = pc.is_null(values).to_numpy(zero_copy_only=False)
    plain = pc.fill_null(values, 0.0).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(rows), sizes)
    bad = np.bincount(owner[missing | ~np.isfinite(plain)], minlength=rows) > 0
    usable = column.is_valid().to_numpy(zero_copy_only=False) & ~bad
    if size is not None:
        usable &= sizes == size
    kept = plain[usable[owner]]
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(kept * scale), -MAX_COMPONENT, MAX_COMPONENT).astype(np.int64)
    return np.flatnonzero(usable), sizes[usable], whole
