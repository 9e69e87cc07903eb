import random
import re

import pytest

from arterial.llm import jaccard
from arterial.operators import components as graph


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(docs, n, percent):
    sets = [(i, shingles(t, n)) for i, t in docs]
    parent = {i: i for i, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1 :]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                r, s = sorted((root(i), root(j)))
                parent[s] = r
    return sorted((i, len(s), root(i)) for i, s in sets)


def near_copies(seed, size, vocabulary):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    docs = []
    for _ in range(size // 12):
        base = [rnd.choice(words) for _ in range(rnd.choice([1, 2, 5, 30, 60, 90]))]
        for _ in range(12):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            docs.append(" ".join(copy))
    rnd.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("words,percent,vocabulary", [(3, 90, 2000), (5, 80, 300), (2, 50, 12)])
def test_matches_brute_force(spark, monkeypatch, words, percent, vocabulary):
    monkeypatch.setattr(jaccard, "LEADER_ROUNDS", 1)  # the last round then has work to do
    docs = near_copies(words, 240, vocabulary)
    got = jaccard.link_documents(spark.createDataFrame(docs, "doc_id bigint, text string"), words=words, percent=percent)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute(docs, words, percent)


def test_frequent_shingles_change_nothing(spark, monkeypatch):
    passage = " ".join(f"p{i}" for i in range(12))
    docs = [(i, f"{passage} {t}") for i, t in near_copies(9, 120, 500)]
    monkeypatch.setattr(jaccard, "LOCAL_MIN", 2)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(2)
    got = jaccard.link_documents(frame, words=3, percent=90)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == brute(docs, 3, 90)


def test_odd_rows(odd_docs, no_docs):
    rows = jaccard.link_documents(odd_docs, words=3, percent=90).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].n_shingles == by_id[2].n_shingles == by_id[5].n_shingles == 0
    assert by_id[1].component_id == 1 and by_id[2].component_id == 2
    assert by_id[3].component_id == by_id[4].component_id == 3 and by_id[4].class_size == 2
    assert by_id[7].class_size == 2 and by_id[7].n_shingles == 1 and by_id[None].n_shingles == 2
    assert jaccard.link_documents(no_docs).count() == 0


def test_components(spark):
    rnd = random.Random(3)
    path = [(i, i + 1) for i in range(40)]
    star = [(1000, 1001 + i) for i in range(30)]
    loose = [(rnd.randrange(2000, 2100), rnd.randrange(2000, 2100)) for _ in range(60)]
    edges = path + star + loose + [(None, 3), (5, None), (7, 7)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    lowest = {x: x for e in path + star + loose for x in e}
    for _ in lowest:
        for a, b in path + star + loose:
            lowest[a] = lowest[b] = min(lowest[a], lowest[b])
    alone = {a for a, b in loose if a == b} - {x for a, b in loose if a != b for x in (a, b)}
    assert got == {k: v for k, v in lowest.items() if k not in alone}


def test_sketches_never_hide_a_link(spark):
    """Long texts of sizes around the steps of the sketch, near and far from the threshold."""
    rnd = random.Random(12)
    docs = []
    for i, n in enumerate((1020, 1030, 2040, 2060, 4090, 4110, 9000)):
        base = [f"x{i}y{k}" for k in range(n)]
        for changes in (0, n // 200, n // 70, n // 55, n // 30):
            copy = list(base)
            for k in rnd.sample(range(n), changes):
                copy[k] = f"z{rnd.random()}"
            docs.append(" ".join(copy + [f"w{k}" for k in range(rnd.choice([0, n // 40]))]))
    docs = list(enumerate(docs))
    got = jaccard.link_documents(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4), words=3, percent=90)
    found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect())
    assert found == brute(docs, 3, 90) and len({c for _, _, c in found}) < len(docs)


def test_sizes_apart_in_one_list(spark, monkeypatch):
    """The leaders of the passage's lists are of the many short texts; only the last round pairs the two long ones."""
    monkeypatch.setattr(jaccard, "LOCAL_MIN", 10**9)  # the order then follows the counts of words alone
    rnd = random.Random(5)
    common = [f"c{i}" for i in range(20)]
    passage = "q1 q2 q3 q4 q5 "
    short = passage + " ".join(rnd.choice(common) for _ in range(95))
    long = passage + " ".join(rnd.choice(common) for _ in range(197))
    docs = [(i, f"{short} last{i}") for i in range(100)] + [(100, long), (101, f"{long} " + " ".join(f"u{i}" for i in range(19)))]
    got = jaccard.link_documents(spark.createDataFrame(docs, "doc_id bigint, text string"), words=3, percent=90)
    found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect())
    assert found == brute(docs, 3, 90) and {c for _, _, c in found} == {0, 100}


@pytest.mark.parametrize("before", [1, 4])
def test_shared_passages_without_leaders(spark, monkeypatch, before):
    """Texts that share passages share many lists; the last round alone must find every link, wherever groups meet first."""
    monkeypatch.setattr(jaccard, "LEADER_ROUNDS", 0)
    monkeypatch.setattr(jaccard, "BEFORE", before)
    rnd = random.Random(21)
    passages = [" ".join(f"p{k}n{i}" for i in range(20)) for k in range(4)]
    docs = []
    for _, text in near_copies(4, 120, 400):
        docs.append(" ".join([text, *rnd.sample(passages, 2)] if rnd.random() < 0.5 else [rnd.choice(passages), text]))
    docs = list(enumerate(docs))
    got = jaccard.link_documents(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), words=3, percent=80)
    found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect())
    assert found == brute(docs, 3, 80) and 1 < len({c for _, _, c in found}) < len(docs)
