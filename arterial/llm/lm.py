"""Language-model scoring with a weighted backoff automaton.

Bigrams are interpolated with an add-a unigram model: p(w|h) = (1 - f(h)) c(h, w) / c(h) + f(h) p(w). As an automaton:
a state per word that was read (and one for the start of a text), an arc per seen bigram with its log-probability, and a
failure arc from each state to the root that costs log f(h); the root has an arc per word. One pass from left to right
carries the state. f(h) falls with c(h) as ``scale * c(h) ** -DECAY``, where the scale makes the mass of all failure arcs
equal the share of bigrams seen once, Good and Turing's estimate of what is still unseen.

The model grows with the corpus and is never gathered in one place. Texts are tokenized into blocks of bounded size.
Each block sends its distinct words and bigrams with their counts, split into parts by ranges of their hashes; a part
adds up the counts of all blocks and answers every block, in the order asked, with the totals; each block then builds the
part of the automaton its own texts can reach and scores them. Memory is bounded by a block or a part; a hot word or
bigram has one entry per block.

Defined cases: a null or empty text is the end token alone; rows without id are held out; repeated rows are scored one by
one (and count each); without training tokens every word is unknown; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arterial.llm import text as tx
from arterial.session import pin

HOLD_OUT = 10
BLOCK_TOKENS = 1_000_000
PART_CODES = 1_500_000  # about how many distinct words or bigrams of blocks meet in one part
ADD = 0.1
DECAY = 0.25

END, START = 0xE0D, 0x57A7
_WORDS, _PAIRS = 0, 1


def _planes(values: np.ndarray) -> bytes:
    """Bytes of numbers, sorted by significance: the many zero bytes then compress away."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _numbers(planes: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _tokens(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of words and end tokens in order, tokens per row)."""
    data, offsets = tx.text_bytes(batch.column(batch.schema.get_field_index(column)))
    starts, ends, row = tx.word_positions(data, offsets, tx.SPACED)
    words = tx.word_hashes(data, starts, ends)
    count = np.bincount(row, minlength=batch.num_rows) + 1
    out = np.full(len(words) + batch.num_rows, END, np.uint64)
    out[np.arange(len(words)) + row] = words
    return out, count


def token_blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per block of about ``BLOCK_TOKENS`` tokens (or one longer text): ids, held_out, number of tokens per text,
    distinct word hashes, and the tokens as places among those."""
    held = (tx.crc_remainder(F.col(id_col), HOLD_OUT) == 0).alias("_held")
    source = docs.select(F.col(id_col).alias("_id"), held, F.col(text_col).alias("_text"))
    kind = source.schema["_id"].dataType.simpleString()
    schema = f"block bigint, ids array<{kind}>, held array<boolean>, sizes array<int>, n_tokens bigint, words binary, tokens binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 28
        waiting: list[tuple] = []

        def block() -> pa.RecordBatch:
            ids, held, sizes, tokens = (list(x) for x in zip(*waiting))
            words, place = np.unique(np.concatenate(tokens), return_inverse=True)
            sizes = np.concatenate(sizes)
            columns = [
                [number], [pa.concat_arrays(ids)], [pa.concat_arrays(held)], [pa.array(sizes, pa.int32())], [len(place)],
                [_planes(words)], [_planes(place.astype(np.int32))],
            ]
            as_list = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x[0])], pa.int32()), x[0])
            return pa.RecordBatch.from_arrays(
                [pa.array(c) if i not in (1, 2, 3) else as_list(c) for i, c in enumerate(columns)],
                names=["block", "ids", "held", "sizes", "n_tokens", "words", "tokens"],
            )

        for batch in batches:
            for part in tx.slices(batch, ["_text"]):
                tokens, sizes = _tokens(part, "_text")
                if waiting and sum(len(w[3]) for w in waiting) + len(tokens) > BLOCK_TOKENS:
                    yield block()
                    number, waiting = number + 1, []
                waiting.append((part.column(0), part.column(1), sizes, tokens))
        if waiting:
            yield block()

    return source.mapInArrow(run, schema)


class Block:
    """A block's tokens and its distinct words and bigrams, both in order of their hashes."""

    def __init__(self, row: dict[str, pa.Scalar]):
        self.sizes = row["sizes"].values.to_numpy().astype(np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.train = ~row["held"].values.to_numpy(zero_copy_only=False)
        self.words = _numbers(row["words"].as_buffer(), np.uint64)
        self.word = _numbers(row["tokens"].as_buffer(), np.int32)
        code = self.words[self.word]
        before = np.empty_like(code)
        before[1:] = code[:-1]
        before[self.first] = START
        self.pairs, self.pair = np.unique(tx.mix(before * np.uint64(tx.BASE) + code), return_inverse=True)

    def counts(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(kind, codes, occurrences in training texts)."""
        train = np.repeat(self.train, self.sizes)
        for kind, codes, place in ((_WORDS, self.words, self.word), (_PAIRS, self.pairs, self.pair)):
            yield kind, codes, np.bincount(place[train], minlength=len(codes)).astype(np.uint32)


def _borders(codes: np.ndarray, parts: int) -> np.ndarray:
    edges = np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(codes, edges), [len(codes)]]).astype(int)


def _questions(blocks: DataFrame, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(k)[i] for k, c in enumerate(batch.schema.names)}
                asked = []
                for kind, codes, n in Block(row).counts():
                    borders = _borders(codes, parts)
                    for part, (i, j) in enumerate(zip(borders[:-1], borders[1:])):
                        if j > i:
                            steps = np.diff(codes[i:j], prepend=np.uint64(0))
                            asked.append((kind, part, row["block"].as_py(), _planes(steps), _planes(n[i:j])))
                columns = [pa.array(c, k) for c, k in zip(zip(*asked), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, names=["kind", "part", "block", "codes", "counts"])

    plain = blocks.select("block", "held", "sizes", "words", "tokens")
    return plain.mapInArrow(run, "kind int, part int, block bigint, codes binary, counts binary")


_STATISTICS = "distinct bigint, total bigint, once bigint, by_size array<bigint>"


def _answers(asked: pd.DataFrame) -> pd.DataFrame:
    """The total count of every code asked for, in the order asked, and statistics of the part (on its first row)."""
    codes = [np.cumsum(_numbers(c, np.uint64)) for c in asked["codes"]]
    stops = np.cumsum([len(c) for c in codes])
    distinct, place = np.unique(np.concatenate(codes), return_inverse=True)
    del codes
    total = np.zeros(len(distinct), np.int64)
    for (a, b), n in zip(zip(np.concatenate([[0], stops[:-1]]), stops), asked["counts"]):
        total[place[a:b]] += _numbers(n, np.uint32)  # the codes of one block are distinct
    out = asked[["kind", "part", "block"]].copy()
    out["totals"] = [_planes(total[place[a:b]]) for a, b in zip(np.concatenate([[0], stops[:-1]]), stops)]
    seen = total[total > 0]
    by_size = np.bincount(np.log2(np.maximum(seen, 1)).astype(int), weights=seen, minlength=64).astype(np.int64)
    first = np.arange(len(out)) == 0
    out["distinct"], out["total"], out["once"] = first * len(seen), first * int(seen.sum()), first * int((seen == 1).sum())
    out["by_size"] = [by_size.tolist() if f else [0] * 64 for f in first]
    return out


class Model:
    """What all blocks share: the unigram constants and the scale of the failure weights."""

    def __init__(self, tokens: int, vocabulary: int, texts: int, once: int, by_size: np.ndarray):
        self.tokens, self.texts = tokens, texts
        self.mass = tokens + ADD * (vocabulary + 1)
        sizes = 2.0 ** (np.arange(64) + 0.5)
        spread = float((by_size * sizes**-DECAY).sum())
        self.scale = once / spread if spread else 1.0

    def root(self, count: np.ndarray) -> np.ndarray:
        return (count + ADD) / self.mass

    def failure(self, count: np.ndarray) -> np.ndarray:
        """Weight of the failure arc of a state seen ``count`` times; 1 where there is no such state."""
        return np.where(count > 0, np.clip(self.scale * np.maximum(count, 1.0) ** -DECAY, 0.02, 0.98), 1.0)


class Automaton:
    """The states and arcs that a block's texts can reach."""

    def __init__(self, model: Model, block: Block, words_total: np.ndarray, pairs_total: np.ndarray):
        self.block = block
        self.count = words_total
        self.root = np.log10(model.root(words_total))  # root arcs, by word
        # states are words, and the start, which comes last
        seen = np.append(words_total, model.texts)
        failure = model.failure(seen)
        self.failure = np.log10(failure)
        state = np.empty(len(block.word), np.int64)
        state[1:] = block.word[:-1]
        state[block.first] = len(words_total)
        self.state = state
        # one arc per distinct seen bigram; any of its occurrences tells its state and word
        some = np.zeros(len(pairs_total), np.int64)
        some[block.pair] = np.arange(len(block.pair))
        of, to = state[some], block.word[some]
        share = pairs_total / np.maximum(seen[of], 1)
        arc = (1 - failure[of]) * share + failure[of] * model.root(words_total[to])
        self.arc = np.where(pairs_total > 0, np.log10(arc), np.nan)

    def traverse(self) -> np.ndarray:
        """Log-probability of each text: from the state left by the token before, take the arc or fail to the root."""
        arc = self.arc[self.block.pair]
        failed = self.failure[self.state] + self.root[self.block.word]
        return np.add.reduceat(np.where(np.isnan(arc), failed, arc), self.block.first)

    def base(self) -> np.ndarray:
        return np.add.reduceat(self.root[self.block.word], self.block.first)

    def known(self) -> np.ndarray:
        return np.add.reduceat((self.count[self.block.word] > 0).astype(np.int64), self.block.first)


_SCORES = "held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probability of the text)."""
    blocks = pin(token_blocks(docs, id_col, text_col))
    tokens = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    parts = max(1, math.ceil(0.6 * tokens / PART_CODES))
    asked = _questions(blocks, parts)
    answers = pin(asked.groupBy("kind", "part").applyInPandas(_answers, "kind int, part int, block bigint, totals binary, " + _STATISTICS))
    sums = answers.groupBy("kind").agg(
        F.sum("distinct"), F.sum("total"), F.sum("once"), F.array(*[F.sum(F.col("by_size")[i]) for i in range(64)]).alias("by_size")
    )
    by_kind = {r[0]: r for r in sums.collect()}
    n_texts = blocks.agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    _, distinct, total, _, by_size = by_kind.get(_WORDS, (_WORDS, 0, 0, 0, [0] * 64))
    once = by_kind[_PAIRS][3] if _PAIRS in by_kind else 0
    model = Model(total, distinct, n_texts, once, np.array(by_size, float))
    kind = docs.schema[id_col].dataType.simpleString()

    def score(held: pa.Table, told: pa.Table) -> pa.Table:
        row = {c: held.column(c)[0] for c in held.column_names}
        block = Block(row)
        told = told.sort_by([("kind", "ascending"), ("part", "ascending")])
        of_kind = told.column("kind").to_numpy()
        totals = [
            np.concatenate([_numbers(told.column("totals")[int(i)].as_buffer(), np.int64) for i in np.flatnonzero(of_kind == k)])
            for k in (_WORDS, _PAIRS)
        ]
        automaton = Automaton(model, block, *totals)
        columns = [
            row["ids"].values, pa.array(~block.train), pa.array(block.sizes), pa.array(automaton.known()),
            pa.array(np.full(len(block.sizes), model.tokens)), pa.array(automaton.base()), pa.array(automaton.traverse()),
        ]
        return pa.table(columns, names=[id_col, *(f.split()[0] for f in _SCORES.split(", "))])

    return blocks.groupBy("block").cogroup(answers.select("kind", "part", "block", "totals").groupBy("block")).applyInArrow(
        score, f"`{id_col}` {kind}, {_SCORES}"
    )
