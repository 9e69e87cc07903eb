"""Benchmark decontamination: broadcast hash set of normalised test n-grams, exact check of hits, removal.

Words are lower-cased (A-Z) runs of digits, letters and non-ASCII characters. A window is 13 consecutive words of a
benchmark item; an item with fewer words is one window. The windows' hashes are broadcast in blocks of proven size;
each block scans the texts once, compares its hits word by word and marks the words inside them.

Defined cases: null and empty texts have no words, no hits and stay; items without words have no windows; an item
without id still hits words but is not listed; equal windows belong to all their items; repeated rows are judged one by
one; an empty benchmark hits nothing; columns of the documents that are named like results are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arterial.llm import text as tx

WINDOW = 13
MAX_BLOCK_BYTES = 8 << 20

HIT_FIELDS = "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, hit_spans array<int>, items array<string>"
_BITS = 20


class WindowSet:
    """Hash set of item windows: hash -> (words, item ids), with a bitmap in front of it."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.windows: dict[int, dict[int, list[tuple[tuple[bytes, ...], list[str]]]]] = {}
        for item, body in items:
            data = np.frombuffer(body, np.uint8)
            starts, ends, _ = tx.word_positions(data, np.array([0, len(data)]), tx.ALPHANUMERIC)
            if not len(starts):
                continue
            low = body.lower()  # bytes.lower changes A-Z only
            words = [low[s:e] for s, e in zip(starts, ends)]
            size = min(window, len(words))
            for i, code in enumerate(tx.window_hashes(tx.word_hashes(data, starts, ends), size).tolist()):
                entries = self.windows.setdefault(size, {}).setdefault(code, [])
                key = tuple(words[i : i + size])
                known = next((ids for have, ids in entries if have == key), None)
                if known is None:
                    known = []
                    entries.append((key, known))
                if item is not None and item not in known:
                    known.append(item)
        self.bitmaps = {}
        for size, codes in self.windows.items():
            bitmap = np.zeros(1 << _BITS, bool)
            bitmap[np.fromiter(codes, np.uint64) >> np.uint64(64 - _BITS)] = True
            self.bitmaps[size] = bitmap

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, number of words, item ids) of every occurrence of a window inside one row's words."""
        hashes = tx.word_hashes(data, starts, ends)
        low = data.tobytes().lower()
        for size, bitmap in self.bitmaps.items():
            codes = tx.window_hashes(hashes, size)
            likely = np.flatnonzero(bitmap[codes >> np.uint64(64 - _BITS)])
            likely = likely[row[likely] == row[likely + size - 1]]
            table = self.windows[size]
            for i, code in zip(likely.tolist(), codes[likely].tolist()):
                for key, ids in table.get(code, ()):
                    if all(low[starts[i + k] : ends[i + k]] == key[k] for k in range(size)):
                        yield i, size, ids


def judge(batch: pa.RecordBatch, column: str, blocks: list, cut_share: int) -> dict[str, pa.Array]:
    data, offsets = tx.text_bytes(batch.column(batch.schema.get_field_index(column)))
    starts, ends, row = tx.word_positions(data, offsets, tx.ALPHANUMERIC)
    edges = np.zeros(len(starts) + 1, np.int64)
    items: dict[int, set[str]] = {}
    for block in blocks:
        for first, size, ids in block.value.find(data, starts, ends, row):
            edges[first] += 1
            edges[first + size] -= 1
            items.setdefault(int(row[first]), set()).update(ids)
    hit = np.cumsum(edges[:-1]) > 0
    rows = batch.num_rows
    words = np.bincount(row, minlength=rows)
    hits = np.bincount(row[hit], minlength=rows)
    names = [sorted(items.get(r, ())) for r in range(rows)]
    spans: list[list[int]] = [[] for _ in range(rows)]
    marked = np.flatnonzero(hit)
    if len(marked):
        # runs of hit words of one text, as byte ranges relative to the text
        new = np.concatenate([[True], (np.diff(marked) > 1) | (row[marked[1:]] != row[marked[:-1]])])
        lasts = marked[np.concatenate([new[1:], [True]])]
        for f, t in zip(marked[new].tolist(), lasts.tolist()):
            r = int(row[f])
            spans[r] += [int(starts[f] - offsets[r]), int(ends[t] - offsets[r])]
    return {
        "n_words": pa.array(words, pa.int64()),
        "n_hit": pa.array(hits, pa.int64()),
        "n_items": pa.array([len(x) for x in names], pa.int64()),
        "items_sha256": pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names]),
        "contaminated": pa.array((hits > 0) & (cut_share * hits >= words)),
        "hit_spans": pa.array(spans, pa.list_(pa.int32())),
        "items": pa.array(names, pa.list_(pa.string())),
    }


def window_blocks(spark: SparkSession, benchmark: DataFrame, item_col: str, text_col: str, window: int) -> list:
    """Broadcast window sets of at most ``MAX_BLOCK_BYTES`` of item text each (or of one item, if that is longer).

    Items stream through the driver one partition at a time and only one block is being built at any moment.
    """
    blocks, items, size = [], [], 0
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("body")).where("body is not null").distinct()
    for item, body in rows.toLocalIterator():
        raw = body.encode()
        if items and size + len(raw) > MAX_BLOCK_BYTES:
            blocks.append(spark.sparkContext.broadcast(WindowSet(items, window)))
            items, size = [], 0
        items.append((item, raw))
        size += len(raw)
    if items:
        blocks.append(spark.sparkContext.broadcast(WindowSet(items, window)))
    return blocks


def mark_contamination(
    docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, cut_share: int = 20,
) -> DataFrame:
    """``docs`` (columns ``keep``, default all) with hits: n_words, n_hit, n_items, items_sha256, contaminated,
    hit_spans (start and end bytes of hit runs, flat) and items (ids as text, sorted).

    One pass over the texts without a shuffle; a text is contaminated if at least one in ``cut_share`` words is hit.
    """
    blocks = window_blocks(docs.sparkSession, benchmark, item_col, item_text_col, window)
    return tx.annotate(
        docs, lambda batch: judge(batch, text_col, blocks, cut_share), HIT_FIELDS, docs.columns if keep is None else keep, [text_col]
    )


def remove_contamination(marked: DataFrame, action: str = "documents", text_col: str = "text") -> DataFrame:
    """Drop contaminated documents, or cut the hit spans out of every text (``action="spans"``)."""
    plain = [c for c in marked.columns if c not in [f.split(" ")[0] for f in HIT_FIELDS.split(", ")]]
    if action == "documents":
        return marked.where("not contaminated").select(plain)
    if action != "spans":
        raise ValueError(f"unknown action {action!r}")
    raw = F.col(text_col).cast("binary")
    pairs = F.size("hit_spans") / 2
    # what stands between the end of one span and the start of the next; no hits leave the whole text
    pieces = F.transform(
        F.sequence(F.lit(0), pairs.cast("int")),
        lambda i: F.substring(
            raw,
            F.when(i == 0, 0).otherwise(F.get("hit_spans", 2 * i - 1)) + 1,
            F.when(i == pairs, F.octet_length(text_col)).otherwise(F.get("hit_spans", 2 * i))
            - F.when(i == 0, 0).otherwise(F.get("hit_spans", 2 * i - 1)),
        ).cast("string"),
    )
    cut = F.when(F.size("hit_spans") > 0, F.array_join(pieces, "")).otherwise(F.col(text_col))
    return marked.select(*[cut.alias(c) if c == text_col else F.col(c) for c in plain])
