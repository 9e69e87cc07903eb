"""Best-fit packing of tokenized documents into sequences of bounded length.

A bin-packing instance is fully described by the number of pieces of each length, so its size is bounded by the
sequence length and not by the data: Martello and Toth's dominance reduction and best fit run on those counts, and give
patterns ("so many sequences hold lengths 700, 200 and 124"). Spark then numbers the pieces of each length and gives
number r of length l its place in the pattern that covers r.

Tokens: the byte-level BPE of the given vocabulary. Texts are cut before each space that precedes a non-space, which
that vocabulary's splitting pattern never merges over; the distinct chunks are encoded once per task by tiktoken, which
gives the same ids as ``tokenizers`` several times faster (tested against each other).

Defined cases: null and empty texts are one piece holding the end token only; repeated rows are packed one by one; ties
between pieces of a length are free, so sequence numbers are not unique across implementations; an empty table gives no
sequences; other columns are not read.
"""

from __future__ import annotations

import base64
import functools
import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arterial.session import pin

CAPACITY = 1024
END_TOKEN = 2
CACHE_CHUNKS = 300_000
_CHUNK = re.compile(r" (?=\S)")


# -- tokens ------------------------------------------------------------------------------------------------------


@functools.lru_cache(2)
def encoder(ranks: str, pattern: str, specials: tuple[tuple[str, int], ...]):
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=table, special_tokens=dict(specials))


class ChunkTokenizer:
    """Ids of texts as little-endian unsigned 32-bit bytes; remembers up to ``CACHE_CHUNKS`` chunks."""

    def __init__(self, ranks: str, pattern: str, specials: tuple[tuple[str, int], ...]):
        self.bpe = encoder(ranks, pattern, specials)
        self.specials = [name for name, _ in specials]
        self.seen: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        if any(name in text for name in self.specials):
            return np.array(self.bpe.encode(text, allowed_special="all"), "<u4").tobytes()
        first, *rest = _CHUNK.split(text)
        seen = self.seen
        if len(seen) > CACHE_CHUNKS:
            seen.clear()
        ids = [self._chunk(first)] if first else []
        for chunk in rest:
            known = seen.get(chunk)
            if known is None:
                known = self._chunk(" " + chunk)
                if len(chunk) <= 64:
                    seen[chunk] = known
            ids.append(known)
        return b"".join(ids)

    def _chunk(self, chunk: str) -> bytes:
        return np.array(self.bpe.encode_ordinary(chunk), "<u4").tobytes()


def public_vocabulary() -> dict:
    """Arguments of ``ChunkTokenizer`` for byte_bpe_50k.json; its ranks are listed in the .tiktoken file beside it."""
    import public_tokenizers

    return {
        "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
        "specials": (("<|endoftext|>", 50256),),
    }


def cut_pieces(docs: DataFrame, vocabulary: dict, keep: list[str], text_col: str, capacity: int, with_ids: bool) -> DataFrame:
    """One row per piece: ``keep``, piece, start, length, ids_crc32, and (chunk, nth): nth of its length in its task."""
    ids_field = ", token_ids binary" if with_ids else ""
    source = docs.select(*dict.fromkeys([*keep, text_col]))
    fields = "piece int, start bigint, length bigint, ids_crc32 bigint, chunk int, nth bigint" + ids_field
    made_fields = T.StructType.fromDDL(fields)
    kept = [c for c in keep if c not in made_fields.names]
    schema = T.StructType([source.schema[c] for c in kept] + list(made_fields))
    end = np.array([END_TOKEN], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = ChunkTokenizer(**vocabulary)
        chunk, numbered = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            for at in range(0, batch.num_rows, 500):
                rows, made = [], []
                for r in range(at, min(at + 500, batch.num_rows)):
                    ids = tokenizer.encode(texts[r].as_py() or "") + end
                    total = len(ids) // 4
                    stop = (total - 1) % capacity + 1  # the first piece takes what whole pieces leave
                    start = piece = 0
                    while start < total:
                        part = ids[4 * start : 4 * stop]
                        made.append((piece, start, stop - start, zlib.crc32(part), chunk, numbered[stop - start], part))
                        numbered[stop - start] += 1
                        rows.append(r)
                        start, stop, piece = stop, stop + capacity, piece + 1
                columns = list(zip(*made))
                if not with_ids:
                    columns = columns[:6]
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                taken = batch.select(kept).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, *(pa.array(c, k) for c, k in zip(columns, kinds))], names=schema.names
                )

    return source.mapInArrow(run, schema)


# -- patterns ----------------------------------------------------------------------------------------------------


class Lengths:
    """Numbers of unpacked pieces by length."""

    def __init__(self, counts: dict[int, int]):
        self.left = {k: v for k, v in counts.items() if v > 0}
        self.order = sorted(self.left)

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for length, n in Counter(lengths).items():
            self.left[length] -= n * times
            if not self.left[length]:
                del self.left[length]
                self.order.remove(length)

    def largest(self, limit: int, used: tuple[int, ...] = ()) -> int:
        """The largest available length up to ``limit``, without ``used``; 0 if there is none."""
        for i in range(int(np.searchsorted(self.order, limit, side="right")) - 1, -1, -1):
            if self.left[self.order[i]] > used.count(self.order[i]):
                return self.order[i]
        return 0

    def smallest(self, n: int, used: tuple[int, ...]) -> list[int]:
        each = (itertools.repeat(x, min(n, self.left[x] - used.count(x))) for x in self.order)
        return list(itertools.islice(itertools.chain.from_iterable(each), n))

    def times(self, lengths: tuple[int, ...]) -> int:
        return min(self.left[x] // n for x, n in Counter(lengths).items())


def dominating(lengths: Lengths, item: int, capacity: int) -> tuple[int, ...]:
    """A set of at most three pieces with ``item`` that dominates every other feasible set with it, or nothing.

    With w = item and r = capacity - w, in the order of Martello and Toth's procedure:
    no other piece fits: {w}. The largest x that fits fills r: {w, x}; any other set can trade places with x.
    At most one piece fits besides w: {w, x}. At most two fit: the best pair (x, y) with the largest x, if no feasible
    pair has a smaller member above y; every pair can then trade places with it, one for one.
    """
    room = capacity - item
    x = lengths.largest(room, (item,))
    if not x:
        return (item,)
    if x == room:
        return item, x
    small = lengths.smallest(3, (item,))
    if len(small) < 2 or small[0] + small[1] > room:
        return item, x
    if len(small) < 3 or sum(small) > room:
        y = lengths.largest(room - x, (item, x))
        # the largest smaller member of any feasible pair; below the first try every length has that one as a partner
        other = lengths.largest(room // 2, (item,))
        if other and lengths.largest(room - other, (item, other)) < other:
            other = lengths.largest(other - 1, (item,))
        if y and other <= y:
            return item, x, y
        pairs = (b + lengths.largest(room - b, (item, b)) for b in lengths.order if b <= room // 2)
        if x >= max(pairs, default=0):
            return item, x
    return ()


def reduce_instance(lengths: Lengths, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fix dominating sets until no piece length has one.

    Each is repeated as long as its pieces last: taking pieces away makes no other set feasible, so it keeps dominating.
    """
    fixed = []
    while True:
        before = len(fixed)
        for item in reversed(list(lengths.order)):
            while item in lengths.left and (found := dominating(lengths, item, capacity)):
                times = lengths.times(found)
                fixed.append((found, times))
                lengths.take(found, times)
        if len(fixed) == before:
            return fixed


def best_fit(lengths: Lengths, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing on counts: bins with equal content are one entry, split when only some take a piece."""
    bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # by room left
    for length in reversed(list(lengths.order)):
        n = lengths.left[length]
        while n:
            room = min((r for r in bins if r >= length), default=None)
            if room is None:
                fill = min(capacity // length, n)
                each, rest = divmod(n, fill)
                for size, times in ((fill, each), (rest, 1)):
                    if size and times:
                        bins.setdefault(capacity - size * length, []).append(((length,) * size, times))
                break
            held, times = bins[room].pop()
            if not bins[room]:
                del bins[room]
            used = min(n, times)
            bins.setdefault(room - length, []).append((held + (length,), used))
            if times > used:
                bins.setdefault(room, []).append((held, times - used))
            n -= used
    return [entry for room in bins.values() for entry in room]


def plan_patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences) that pack all pieces."""
    lengths = Lengths(counts)
    return reduce_instance(lengths, capacity) + best_fit(lengths, capacity)


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """For each length, which of its pieces (first .. first + times - 1) take which place of which sequences."""
    rows, sequence, used = [], 0, Counter()
    for held, times in patterns:
        offset = 0
        for length in held:
            rows.append((length, used[length], times, sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    return pd.DataFrame(rows, columns=["length", "first", "times", "sequence", "offset"]).astype("int64")


# -- Spark -------------------------------------------------------------------------------------------------------


def pack(
    docs: DataFrame, vocabulary: dict | None = None, keep: list[str] | None = None, text_col: str = "text",
    capacity: int = CAPACITY, with_ids: bool = False,
) -> DataFrame:
    """Pieces with their places: ``keep``, piece, start, length, ids_crc32, sequence_id, offset (and token_ids).

    The texts are read once; pieces (without text) are written to the shared folder with the task that made them and
    their number there, so numbering them by length needs only a count per task and length, no sort. The driver sees
    one count per length.
    """
    pieces = pin(cut_pieces(docs, vocabulary or public_vocabulary(), ["doc_id"] if keep is None else keep, text_col, capacity, with_ids))
    counted = pieces.groupBy("chunk", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("chunk", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = slots(plan_patterns(counts, capacity))
    starts = {n: g.reset_index(drop=True) for n, g in table.groupby("length")}
    numbered = pieces.join(offsets, ["chunk", "length"]).withColumn("number", F.col("nth") + F.col("earlier"))
    names = [c for c in pieces.columns if c not in ("chunk", "nth")]
    schema = numbered.select(*names, F.lit(0).cast("bigint").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")).schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "number"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                own, mine = starts[n], np.flatnonzero(length == n)
                at = np.searchsorted(own["first"].to_numpy(), number[mine], side="right") - 1
                sequence[mine] = own["sequence"].to_numpy()[at] + number[mine] - own["first"].to_numpy()[at]
                offset[mine] = own["offset"].to_numpy()[at]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(names).columns, pa.array(sequence), pa.array(offset)], names=schema.names
            )

    return numbered.select(*names, "number").mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, token_ids) of ``pack(..., with_ids=True)``: each sequence's ids in order, 32-bit little-endian.

    A sequence holds a bounded number of tokens, so its group is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "token_ids")))
    joined = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return joined.select("sequence_id", F.expr("aggregate(parts, cast('' as binary), (a, x) -> concat(a, x.token_ids))").alias("token_ids"))
