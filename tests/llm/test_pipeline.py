"""The pipeline against brute force, stage by stage, and on odd rows."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from arterial.llm import langid
from test_decontaminate import brute as contaminated
from test_jaccard import brute as linked
from test_packing import check as check_packing
from test_pii import brute as base_spans

SF_DIR = "/root/testdata/sf0.001"


def test_every_stage_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["language_id"](spark, docs, SF_DIR).cache()
    judged = langid.identify(docs, langid.fit_languages(docs), keep=["doc_id"]).collect()
    accepted = {r.doc_id for r in judged if r.lang_pred != "und" and r.score >= corpus_pipeline.MIN_LANGUAGE_SHARE}
    assert sorted(kept.collect()) == sorted(r for r in docs.collect() if r.doc_id in accepted)
    assert len(accepted) >= 0.99 * docs.count()

    single = stages["near_duplicates"](spark, kept, SF_DIR).cache()
    texts = [(r.doc_id, r.text) for r in kept.collect()]
    first = {i for i, _, component in linked(texts, 5, 80) if i == component}
    assert sorted(single.collect()) == sorted(r for r in kept.collect() if r.doc_id in first)
    assert len(first) < len(texts)

    clean = stages["decontamination"](spark, single, SF_DIR).cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    bad = {r[0] for r in contaminated([(r.doc_id, r.text) for r in single.collect()], items) if r[-1]}
    assert sorted(clean.collect()) == sorted(r for r in single.collect() if r.doc_id not in bad)

    private = stages["personal_data"](spark, clean, SF_DIR).cache()
    before = {r.doc_id: r for r in clean.collect()}
    for r in private.collect():
        spans = base_spans(before[r.doc_id].text)
        assert (r.text == before[r.doc_id].text) == (spans == "") and not base_spans(r.text)
        assert (r.lang, r.source, r.n_chars) == (before[r.doc_id].lang, before[r.doc_id].source, len(r.text))
    assert private.columns == docs.columns and private.dtypes == docs.dtypes

    packed = stages["best_fit_packing"](spark, private, SF_DIR)
    check_packing(private, packed)
    whole = entry.queries()["pipeline"](spark, SF_DIR)
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, whole.collect())) == sorted(map(key, packed.collect()))


def test_odd_rows_pass_through_every_stage(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_DIR).cache()
            if name != "best_fit_packing":
                assert out.columns == docs.columns
            else:
                check_packing(docs, out)
            docs = out


def test_stages_use_the_dealt_operators_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_duplicates", "decontamination", "personal_data", "best_fit_packing",
    ]
    names = entry.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11))


@pytest.mark.parametrize("name", ["op1_decontamination", "op2_quality_rules", "op3_ngram_jaccard", "op7_url_filters", "op8_chat_formatting"])
def test_queries_match_sql(spark, name):
    from compare import connect, difference, duck_rows, spark_rows

    left = spark_rows(entry.queries()[name](spark, SF_DIR))
    assert difference(left, duck_rows(connect(SF_DIR), entry.oracle_sql()[name])) is None


def test_nothing_else_imports_the_subpackage():
    root = Path(entry.__file__).parent
    for path in (root / "arterial").rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "arterial.llm" not in path.read_text(), path
