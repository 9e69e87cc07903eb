import hashlib
import re

from arterial.llm import decontaminate as dc

FIELDS = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    out = []
    for i, text in docs:
        words, hit, named = words_of(text), set(), set()
        for item, body in items:
            w = words_of(body)
            n = min(13, len(w))
            for k in range(len(w) - n + 1 if n else 0):
                for p in range(len(words) - n + 1):
                    if words[p : p + n] == w[k : k + n]:
                        hit.update(range(p, p + n))
                        named.add(str(item))
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((i, len(words), len(hit), len(named), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(out, key=repr)


def test_matches_brute_force(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    docs = [
        (0, f"Before. {passage.upper()}! After"), (1, passage), (2, "w1 w2 w3"), (3, "short item here, Short-Item"), (4, None), (5, ""),
        (6, "é" + passage), (7, passage + " " + "filler " * 300), (7, passage + " " + "filler " * 300), (8, passage.replace("w9", "x")),
    ]
    items = [(1, passage), (10, passage), (2, "short item"), (3, ""), (4, None), (5, " ".join(f"w{i}" for i in range(7, 30)))]
    got = dc.mark_contamination(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string"))
    assert sorted((tuple(r) for r in got.select("doc_id", *FIELDS).collect()), key=repr) == brute(docs, items)


def test_blocks_give_the_same(spark, small, monkeypatch):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = sorted(map(tuple, dc.mark_contamination(small, bench, keep=["doc_id"]).select("doc_id", *FIELDS).collect()))
    monkeypatch.setattr(dc, "MAX_BLOCK_BYTES", 500)
    assert len(dc.window_blocks(spark, bench, "item_id", "text", 13)) > 3
    assert sorted(map(tuple, dc.mark_contamination(small, bench, keep=["doc_id"]).select("doc_id", *FIELDS).collect())) == whole
    assert any(r[2] for r in whole)


def test_odd_rows(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "one", "x"), (None, "a text without id", "x"), (3, None, None)], "item_id int, text string, n_hit string")
    got = dc.mark_contamination(odd_docs, bench)
    assert got.columns.count("n_words") == 1 and got.count() == odd_docs.count()
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[7].contaminated and by_id[7]["items"] == ["1"]
    assert by_id[None].n_hit == 4 and by_id[None].n_items == 0
    assert by_id[1].n_words == by_id[2].n_words == 0 and not by_id[1].contaminated
    assert dc.mark_contamination(no_docs, bench).count() == 0
    assert dc.mark_contamination(odd_docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_spans_are_cut_out(spark):
    docs = spark.createDataFrame([(1, "ä one two, three four"), (2, "clean"), (3, None), (4, "one two")], "doc_id int, text string")
    bench = spark.createDataFrame([(1, "two three"), (2, "one")], "item_id int, text string")
    cut = dc.remove_contamination(dc.mark_contamination(docs, bench), "spans")
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "ä  four", 2: "clean", 3: None, 4: " two"}
    assert cut.columns == docs.columns
    kept = dc.remove_contamination(dc.mark_contamination(docs, bench))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]
