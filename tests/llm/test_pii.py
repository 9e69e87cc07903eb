import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np

from arterial.llm import pii

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def brute(text):
    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                odd = [int(c) for c in digits[::-1]]
                check = sum(odd[0::2]) + sum(sum(divmod(2 * d, 10)) for d in odd[1::2])
                if not 16 <= len(digits) <= 19 or check % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in out)


def test_base_spans_match_the_patterns(small):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("ab.@-+ 012345(é%") for _ in range(rnd.randrange(60))) for _ in range(4000)]
    texts += [r.text for r in small.collect()] + ["1.2.3.4.5.6.7.8", "a@b.c.d@e.f", "@@a.b", "x@y", "4111 1111 1111 1111", "+1 (555) 123-4567 x"]
    for text in texts:
        assert pii.listed(pii.base_spans(text)) == brute(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "a" * 300_000, "1." * 100_000, "+1" * 100_000, "a@" * 100_000, "+1" + "(" * 300_000):
        pii.base_spans(text)


def test_equal_and_similar_candidates_take_the_observed_label(spark):
    rnd = random.Random(8)
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    sample = []
    for _ in range(60):
        phone = f"+1 (559) 555-{digits(4)}"
        sample.append(f"call {phone} or {digits(16)} again {phone} mail x{digits(3)}@mail.example.com ip 10.2.3.{rnd.randrange(99)} end {digits(10)}")
    model = pii.SkipChainCrf().fit([pii.Candidates(t, pii.base_spans(t)) for t in sample])
    far = "words " * 200
    text = f"Call +1 (559) 555-3817. {far} Then 1 559 555 3817, or ann@mail.example.com, {far} ANN@mail for short."
    base, spans = model.spans(text)
    added = {(pii.KINDS[k], text[s:e]) for k, s, e in set(spans) - set(base)}
    assert added == {("phone", "1 559 555 3817"), ("email", "ANN@mail")} and set(base) < set(spans)
    alone = f"Then 1 559 555 3817 {far}, ann at mail, 4436 5873 1172 8965"
    assert model.spans(alone) == ([], [])
    mixed = "Call +1 (559) 555-3817 and 7777777 or 1234567890123456."
    assert model.spans(mixed)[0] == model.spans(mixed)[1]
    assert pii.redact(text, spans).count("<PHONE>") == 2 and "3817" not in pii.redact(text, spans)


def test_numbers_with_and_without_prefix_are_linked():
    model = pii.SkipChainCrf().fit([])
    for full, short in (("+1 (559) 555-3817", "(559) 555-3817"), ("+44 20 7946 0958", "020 7946 0958"), ("+49 30 123-4567", "030 1234567")):
        text = f"Call {full}. " + "words " * 100 + f"Or {short}; order 5595553818 and 10.55.95.38.17 stay."
        base, spans = model.spans(text)
        assert {text[s:e] for _, s, e in set(spans) - set(base)} == {short}, full


def test_messages_give_exact_marginals_on_a_tree():
    """Four candidates in a path of two skip edges and a chain edge, held against the sum over all labellings."""
    rnd = np.random.default_rng(3)
    far = " words" * 20
    text = f"+1 (559) 555-3817{far} 1 559 555 3817, ann@mail{far} Ann@mail"
    found = pii.Candidates(text, pii.base_spans(text))
    model = pii.SkipChainCrf()
    model.node, model.chain = rnd.normal(size=model.node.shape), rnd.normal(size=model.chain.shape)
    model.skip = np.eye(model.size) * 3.0
    chain, skip = found.edges()
    assert chain.tolist() == [[1, 2]] and skip.tolist() == [[0, 1], [2, 3]]
    against = found.features @ model.node
    against = np.clip(against[:, -1:] - against, *pii.UNMATCHED)
    against[:, -1] = 0
    node = np.exp(-against)
    node[found.labels >= 0] = np.eye(model.size)[found.labels[found.labels >= 0]]
    exact = np.zeros((4, model.size))
    for labels in itertools.product(range(model.size), repeat=4):
        weight = np.prod(node[range(4), labels])
        weight *= np.exp(model.chain[labels[1], labels[2]] + model.skip[labels[0], labels[1]] + model.skip[labels[2], labels[3]])
        exact[range(4), labels] += weight
    assert np.abs(model.infer(found, sweeps=40) - exact / exact.sum(axis=1, keepdims=True)).max() < 1e-6
    assert np.abs(model.infer(found) - exact / exact.sum(axis=1, keepdims=True)).max() < 0.01


def test_long_texts_reach_the_fit(spark):
    phone = "+1 (559) 555-38{:02d}"
    docs = [(i, " ".join(["words stand here"] * 2000 + [phone.format(i)] + ["and there"] * 3000 + [f"m{i}@mail.example.com"] * 2000)) for i in range(6)]
    model = pii.fit_pii(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert np.abs(model.node).sum() > 0


def test_query_matches_patterns(spark):
    from arterial.llm.queries import op6_pii

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r.doc_id: r for r in op6_pii(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs)
    for d in docs:
        r, base = got[d.doc_id], brute(d.text)
        kinds = Counter(x.split(":")[0] for x in base.split(",") if x)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds[k] for k in ("email", "ip", "card", "phone")]
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))


def test_odd_rows(odd_docs, no_docs):
    model = pii.fit_pii(odd_docs)
    rows = pii.find_pii(odd_docs, model, masked_col="masked").collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == odd_docs.count()
    assert by_id[1].masked is None and by_id[2].masked == "" and by_id[1].spans == ""
    assert by_id[11].n_email == by_id[11].n_phone == by_id[11].n_ip == 2 and "@" not in by_id[11].masked
    assert pii.find_pii(no_docs, pii.fit_pii(no_docs)).count() == 0
