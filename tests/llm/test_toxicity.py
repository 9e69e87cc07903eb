from arterial.llm import toxicity
from arterial.llm.queries import op9_toxicity


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op9_toxicity(spark, sf).collect()
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    hits = sum(a == b == 1 for a, b in held)
    assert len(held) > 500
    assert sum(a == b for a, b in held) >= 0.96 * len(held)
    assert hits >= 0.8 * sum(a for a, _ in held) and hits >= 0.9 * sum(b for _, b in held)


def test_folding():
    assert toxicity.fold("You M0R0N, 5tup1d! іdіоt @ss") == ["you", "moron", "stupid", "idiot", "ass"]
    assert toxicity.fold("no. 5 of 10! $5 a1 ok!") [:2] == ["no", "of"]
    assert toxicity.fold("") == toxicity.fold(" \n 12 ") == []


def trained():
    clean = [("a quiet day in the trash can by the river", 0)] * 30 + [("plain words about a calm river", 0)] * 60
    bad = [("you are trash and a moron today", 1), ("what a moron and such trash", 1), ("moron you moron", 1)] * 20
    return toxicity.Lexicon().fit([x for pair in zip(clean, bad + bad) for x in pair], {0: 900, 1: 60})


def test_lexicon_matches_whole_words_beginnings_and_excuses():
    lexicon = trained()
    assert lexicon.score(toxicity.fold("you are trash, a m0ron"))[0] > 0.5
    assert lexicon.score(toxicity.fold("a calm river"))[0] < 0.5
    assert [t.strip() for t in lexicon.find(toxicity.fold("the trash can"))] == []
    short, long = (lexicon.score(toxicity.fold("you moron " + "river " * n))[0] for n in (3, 3000))
    assert long < short


def brute_find(lexicon, words):
    text = f" {' '.join(words)} "
    places = [(i, t) for t in {*lexicon.weights, *lexicon.excused} for i in range(len(text)) if text.startswith(t, i)]
    free = [(i, i + len(t) - 1) for i, t in places if t in lexicon.excused]
    best = {}
    for i, t in places:
        if t in lexicon.weights and lexicon.weights[t] > lexicon.weights.get(best.get(i), 0):
            best[i] = t
    return [t for i, t in sorted(best.items()) if not any(a <= i < b for a, b in free)]


def test_automaton_matches_brute_force(small):
    lexicon = trained()
    for r in small.limit(60).collect():
        words = toxicity.fold(r.text + " you trash can moron trash moronic")
        assert lexicon.find(words) == brute_find(lexicon, words)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1, 0), (0, 1, 1), (3, 1, 0), (None, 1, 1), (7, None, None), (99, 0, 1)], "doc_id bigint, quality int, toxic int")
    for use in (labels, labels.limit(0)):
        rows = toxicity.score_toxicity(odd_docs, toxicity.fit_lexicon(odd_docs, use)).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_toxicity(no_docs, toxicity.fit_lexicon(no_docs, labels)).count() == 0
