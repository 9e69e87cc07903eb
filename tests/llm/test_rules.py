import re
from collections import Counter

from arterial.llm import rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {p for i, w in enumerate(windows) if often[w] > 1 for p in (i, i + 1, i + 2)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_measures_match_brute_force(small, odd_docs):
    for docs in (small, odd_docs):
        got = rules.apply_policy(rules.ledger(docs))
        texts = Counter((r.doc_id, *brute(r.text)) for r in docs.select("doc_id", "text").collect())
        assert Counter((r.doc_id, *(r[c] for c in COLUMNS)) for r in got.select("doc_id", *COLUMNS).collect()) == texts


def test_repeats_and_lines(spark):
    texts = ["a b c x a b c", "a a a a", "a a a", "x\ny\nx\n \n \n", "a b c a b c a b c", " a  a", "k l m\x0bk l m"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    for r in rules.apply_policy(rules.ledger(docs)).collect():
        assert tuple(r[c] for c in COLUMNS) == brute(texts[r.doc_id])


def test_policies_and_ablation_read_only_bits(spark, small):
    ledger = rules.ledger(small, keep=["doc_id"]).cache()
    rows = ledger.collect()
    for version, names in rules.POLICIES.items():
        policy = rules.mask(names)
        kept = {r.doc_id for r in rules.apply_policy(ledger, version).where("kept").collect()}
        assert kept == {r.doc_id for r in rows if not r.failed_bits & policy}
        for r in rules.ablation(ledger, version).collect():
            bit = rules.mask([r.rule])
            assert r.failed == sum(bool(x.failed_bits & bit) for x in rows)
            assert r.only_this == sum(x.failed_bits & policy == bit for x in rows)
            assert r.kept_without == sum(not x.failed_bits & policy & ~bit for x in rows)
    sole = rules.apply_policy(ledger).where("sole_rule is not null").collect()
    assert sole and all(bin(r.failed_bits & rules.mask(rules.POLICIES[r.policy])) == bin(rules.mask([r.sole_rule])) for r in sole)


def test_no_python_and_no_shuffle(small, no_docs):
    plan = rules.apply_policy(rules.ledger(small))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)
    assert rules.apply_policy(rules.ledger(no_docs)).count() == 0
    assert rules.ablation(rules.ledger(no_docs)).count() == 0
