import math
import re
from collections import Counter

import numpy as np
import pytest

from arterial.llm import lexical
from arterial.session import pin

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute_force(docs, items, k):
    """{item place: [(id, score)]} over (id, text) rows."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        asked = Counter(terms(text))
        rows = []
        for i, c in counted:
            m = 25 + 75 * sum(c.values()) * n // total
            score = sum(
                r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t, r in asked.items() if t in c
            )
            if score > 0:
                rows.append((-score, i is None, i or 0, i))
        out += [(item, rank, r[3], -r[0]) for rank, r in enumerate(sorted(rows)[:k], 1)]
    return sorted(out, key=repr)


def searched(docs, items, k=10):
    found = lexical.search(pin(lexical.index_documents(docs)), items, k)
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=repr)


ITEMS = [(1, "the of and THIN erer the"), (2, "plain words, quite: calmly"), (3, None), (4, ""), (5, "no such term anywhere here"), (None, "é ü 5 5 5"), (6, "heath bly oror0 anwh")]


def test_odd_rows_match_brute_force(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(*i, "clash") for i in ITEMS], "item_id bigint, text string, score string")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert searched(odd_docs, items) == brute_force(docs, ITEMS, 10)
    assert searched(odd_docs, items, 2) == brute_force(docs, ITEMS, 2)
    assert searched(no_docs, items) == [] and searched(odd_docs, items.limit(0)) == []


def test_ties_copies_and_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    made = [(int(i), " ".join(rng.choice(words, rng.integers(1, 40)))) for i in rng.permutation(700)]
    made += [(1000 + i, "w1 w2 w3 w3 W4") for i in range(300)]  # a third of all rows are copies
    items = [(i, " ".join(rng.choice(words, 12))) for i in range(20)] + [(99, "w3 w3 w1"), (99, "w3 w3 w1")]
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(lexical, "CELLS", 600)
    monkeypatch.setattr(lexical, "ITEM_BYTES", 300)  # several passes
    docs = spark.createDataFrame(made, "doc_id bigint, text string").repartition(3)
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    assert searched(docs, frame) == brute_force(made, items, 10)


def test_range_maxima_bound_and_stop(spark, small):
    """Only a part of the documents is looked at, and whatever is skipped stays below the k-th score."""
    index = pin(lexical.index_documents(small)).toArrow().to_batches()
    items = lexical.Items([t.text for t in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("text").collect()])
    batch = index[0]
    row = {n: batch.column(c)[0] for c, n in enumerate(batch.schema.names)}
    weights = lexical.Weights(row["n_docs"].as_py(), row["n_terms"].as_py(), {}, len(items.vocabulary))
    lists = lexical.Lists(row, items.vocabulary, weights)
    rng = np.random.default_rng(1)
    for _ in range(200):
        t = rng.integers(len(items.vocabulary))
        a, b = sorted(rng.integers(lists.first[t], lists.last[t] + 1, 2)) if lists.last[t] else (0, 0)
        if a < b:
            assert lists.impact[lists.largest(np.array([a]), np.array([b]))[0]] == lists.impact[a:b].max()
    for group in items.groups():
        best = lexical.Best(len(items.terms), 10)
        item, place, score = lexical.search_block(lists, group, best)
        for q, wanted, repeats in zip(*group):
            full = np.zeros(lists.n_docs, np.int64)
            for t, r in zip(wanted, repeats):
                if t >= 0:
                    full[lists.place[lists.first[t] : lists.last[t]]] += r * lists.impact[lists.first[t] : lists.last[t]]
            kth = max(1, np.sort(full)[-10])
            assert sorted(zip(place[item == q], score[item == q])) == [(d, full[d]) for d in np.flatnonzero(full >= kth)]


def test_query_reads_a_block_whatever_its_ids(spark):
    docs = spark.createDataFrame([("b", "red fox"), ("a", "red fox"), (None, "red fox"), ("c", "blue")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "fox")], "item_id string, text string")
    assert [r[2] for r in searched(docs, items)] == ["a", "b", None]


@pytest.mark.parametrize("k", [1, 3])
def test_small_k(spark, small, k):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in small.collect()]
    assert searched(small, items, k) == brute_force(docs, [(r.item_id, r.text) for r in items.collect()], k)
