import numpy as np

from arterial.llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    from arterial.llm.queries import op5_language_id

    got = op5_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and 100 < len(held) < 300
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def brute_marginals(emissions, moves):
    n, size = emissions.shape
    total = np.zeros((n, size))
    for path in np.ndindex(*[size] * n):
        p = np.exp(sum(emissions[t, s] for t, s in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
        for t, s in enumerate(path):
            total[t, s] += p
    return total / total.sum(axis=1, keepdims=True)


def test_forward_backward_is_exact():
    rng = np.random.default_rng(2)
    model = langid.Crf(["a", "b", "c"])
    model.moves = rng.normal(size=(3, 3)).astype(np.float32)
    lengths = [3, 1, 5, 2]
    emissions = rng.normal(size=(sum(lengths), 3)).astype(np.float32)
    row = np.repeat([0, 2, 3, 7], lengths)
    found, _ = model.marginals(emissions, row)
    at = 0
    for n in lengths:
        assert np.allclose(found[at : at + n], brute_marginals(emissions[at : at + n], model.moves), atol=1e-4)
        at += n


def test_code_switched_words_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit_languages(docs)
    rows = {r.lang: r.text for r in docs.where("n_chars between 300 and 900").orderBy("doc_id").collect() if "%%" not in r.text}
    mixed = spark.createDataFrame([(1, f"{rows['de'][:400]} {rows['es'][:120]}", "x")], "doc_id int, text string, score string")
    got = langid.identify(mixed, model).collect()[0]
    assert got.lang_pred == "de" and 0.6 < got["score"] < 0.9


def test_odd_rows(odd_docs, no_docs):
    rows = langid.identify(odd_docs, langid.fit_languages(odd_docs)).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == odd_docs.count()
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1, 2, 5, 6))
    assert by_id[8].lang_pred == "en" and by_id[10].lang_pred == "en"
    assert langid.identify(no_docs, langid.fit_languages(no_docs)).count() == 0
    assert {r.lang_pred for r in langid.identify(odd_docs, langid.fit_languages(no_docs)).collect()} == {"und"}


def test_language_of_long_texts_only(spark):
    """All texts of one language are longer than the sample takes of a text, and start with many numbers."""
    plain = "the quiet house stands near an old river and they walk there often "
    other = "zyk ovrum taqi jelno wexu pilgrath ubnor skedi vomqa drizul "
    rows = [(i, plain * 50, "en") for i in range(40)] + [(100 + i, "1 2 3 " * 4000 + other * 600, "zz") for i in range(40)]
    model = langid.fit_languages(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    fresh = spark.createDataFrame([(1, other), (2, plain)], "doc_id bigint, text string")
    assert {r.doc_id: r.lang_pred for r in langid.identify(fresh, model).collect()} == {1: "zz", 2: "en"}
