import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from arterial.llm import lm


def tokens_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def brute(docs):
    """(base, score, known) of every text with dictionaries, token by token."""
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in docs}
    single, double, state = Counter(), Counter(), Counter()
    for i, text in docs:
        if not held[i]:
            before = "<s>"
            for t in tokens_of(text):
                single[t] += 1
                double[before, t] += 1
                state[before] += 1
                before = t
    total, vocabulary = sum(single.values()), len(single)
    once = sum(n == 1 for n in double.values())
    by_size = Counter()
    for n in single.values():
        by_size[int(math.log2(n))] += n
    spread = sum(n * 2 ** (-lm.DECAY * (k + 0.5)) for k, n in by_size.items())
    out = {}
    for i, text in docs:
        base = score = known = 0
        before = "<s>"
        for t in tokens_of(text):
            p = (single[t] + 0.1) / (total + 0.1 * (vocabulary + 1))
            base += math.log10(p)
            known += single[t] > 0
            h = state[before]
            f = min(0.98, max(0.02, once / spread * h**-lm.DECAY)) if h else 1.0
            score += math.log10((1 - f) * double[before, t] / h + f * p if h else p)
            before = t
        out[i] = (held[i], len(tokens_of(text)), known, total, base, score)
    return out


@pytest.mark.parametrize("block,part", [(2_000_000, 2_500_000), (700, 900)])
def test_matches_dictionaries(small, monkeypatch, block, part):
    monkeypatch.setattr(lm, "BLOCK_TOKENS", block)
    monkeypatch.setattr(lm, "PART_CODES", part)
    monkeypatch.setattr(lm.tx, "SLICE_BYTES", 4000 if block < 1000 else 1 << 21)
    docs = small.where("doc_id < 120")
    expected = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    rows = lm.score_documents(docs).collect()
    assert len(rows) == len(expected)
    for r in rows:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == expected[r.doc_id][:4]
        assert r.base_score == pytest.approx(expected[r.doc_id][4], rel=1e-9)
        assert r.score == pytest.approx(expected[r.doc_id][5], rel=1e-9)


def test_probabilities_add_up():
    texts = ["a b a d", "a b c d", "a b b", "d", "c a b"] * 3
    vocabulary = sorted({t for x in texts for t in x.split()})
    words = np.arange(1, len(vocabulary) + 1).astype(np.uint64) << np.uint64(32)
    words = np.append(words, np.uint64(7 << 40))  # the end
    place = {t: i for i, t in enumerate([*vocabulary, None])}
    flat = [place[t] for x in texts for t in tokens_of(x)]
    order = np.argsort(words)
    row = {"sizes": pa.scalar([len(tokens_of(x)) for x in texts]), "held": pa.scalar([False] * len(texts)),
           "words": pa.scalar(lm._planes(words[order])), "tokens": pa.scalar(lm._planes(np.argsort(order)[flat].astype(np.int32)))}
    block = lm.Block(row)
    totals = {kind: n.astype(np.int64) for kind, _, n in block.counts()}
    model = lm.Model(len(flat), len(words), len(texts), 3, np.bincount([2], minlength=64) * 10.0)
    automaton = lm.Automaton(model, block, totals[0], totals[1])
    arcs = {}
    for s, w, p in zip(automaton.state, block.word, automaton.arc[block.pair]):
        arcs[int(s), int(w)] = 10**p
    for s in {s for s, _ in arcs}:
        fail = 10 ** automaton.failure[s]
        seen = sum(arcs.get((s, w), fail * 10 ** automaton.root[w]) for w in range(len(words)))
        assert seen + fail * model.root(np.array(0.0)) == pytest.approx(1)


def test_held_out_texts_are_likelier_than_by_single_words(spark):
    rows = lm.score_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_odd_rows(odd_docs, no_docs):
    rows = lm.score_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].n_tokens == by_id[2].n_tokens == by_id[5].n_tokens == 1 and by_id[None].held_out
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert lm.score_documents(no_docs).count() == 0
    alone = lm.score_documents(odd_docs.where("doc_id is null")).collect()
    assert alone[0].train_tokens == 0 and math.isfinite(alone[0].score)
