import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from arterial.llm import packing


def filled(patterns):
    out = Counter()
    for held, times in patterns:
        for length in held:
            out[length] += times
    return out


def optimum(items, capacity):
    """Fewest bins by exhaustive search."""
    items = sorted(items, reverse=True)

    def fits(bins, i):
        if i == len(items):
            return True
        tried = set()
        for b in range(len(bins)):
            if bins[b] >= items[i] and bins[b] not in tried:
                tried.add(bins[b])
                bins[b] -= items[i]
                if fits(bins, i + 1):
                    return True
                bins[b] += items[i]
        return False

    return next(n for n in itertools.count(-(-sum(items) // capacity)) if fits([capacity] * n, 0))


@pytest.mark.parametrize("seed", range(40))
def test_reduction_keeps_the_optimum(seed):
    rnd = random.Random(seed)
    items = [rnd.randrange(1, 21) for _ in range(rnd.randrange(1, 11))]
    lengths = packing.Lengths(Counter(items))
    fixed = packing.reduce_instance(lengths, 20)
    rest = [x for x, n in lengths.left.items() for _ in range(n)]
    assert all(sum(held) <= 20 for held, _ in fixed)
    assert filled(fixed) + Counter(rest) == Counter(items)
    assert sum(n for _, n in fixed) + (optimum(rest, 20) if rest else 0) == optimum(items, 20)


def test_patterns_hold_everything_and_are_tight():
    rnd = random.Random(1)
    counts = Counter(rnd.choice([rnd.randrange(1, 1025), rnd.randrange(1, 300)]) for _ in range(20_000))
    patterns = packing.plan_patterns(counts)
    assert filled(patterns) == counts and all(sum(held) <= 1024 for held, _ in patterns)
    total = sum(k * n for k, n in counts.items())
    assert sum(n for _, n in patterns) <= 1.002 * total / 1024 + 1
    assert packing.plan_patterns({}) == []
    big = packing.plan_patterns({k: n * 10**9 for k, n in counts.items()})  # as quick for any number of pieces
    assert filled(big) == Counter({k: n * 10**9 for k, n in counts.items()})


def reference_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [e.ids + [2] for e in bpe.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(docs, packed):
    source = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = Counter()
    for (i, _), ids in zip(source, reference_ids([t for _, t in source])):
        first = (len(ids) - 1) % 1024 + 1
        for piece, start in enumerate([0, *range(first, len(ids), 1024)]):
            part = ids[start : start + 1024] if start else ids[:first]
            expected[(i, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    rows = packed.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 1024


def test_pack(spark, small, odd_docs, no_docs):
    check(small, packing.pack(small, keep=["doc_id"]))
    check(odd_docs, packing.pack(odd_docs))
    assert packing.pack(no_docs).count() == 0


def test_chunks_do_not_change_ids():
    texts = [
        "a  b   c \n d\n\n e", " lead", "trail ", "tab\t x", "a  b", "it's  we've 12 345!? (x)", "x<|endoftext|> y", "é è  ñ", "\x85 a \x1c b", "",
        "  ", "\n \n", "a  b", "日本 語", "😀 😀  😀",
    ]
    tokenizer = packing.ChunkTokenizer(**packing.public_vocabulary())
    for text, ids in zip(texts, reference_ids(texts)):
        assert np.frombuffer(tokenizer.encode(text), "<u4").tolist() == ids[:-1], text


def test_sequences_hold_the_ids(small):
    packed = packing.pack(small.where("doc_id < 40"), keep=["doc_id"], with_ids=True).cache()
    ids = {r.sequence_id: np.frombuffer(r.token_ids, "<u4") for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        part = ids[r.sequence_id][r.offset : r.offset + r.length]
        assert zlib.crc32(part.tobytes()) == r.ids_crc32
