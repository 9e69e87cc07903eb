"""N-gram Jaccard join by grouped prefixes, and the components of its links.

1. Each text becomes the set of its distinct word shingles (64-bit hashes). Equal sets are one class, wherever they are.
2. In one order of all shingles (those of rare words first, known frequent shingles last, else by hash), two sets with a Jaccard similarity of at least t share
   a shingle among the first ``size - ceil(t * size) + 1`` of each: the prefix. Classes with equal prefix and size form a
   group, and only groups that share a prefix shingle and whose sizes are close enough are paired. Groups that share a whole
   passage meet in the list of its first shingle, and not again where the lists just before show that they have met.
   A group also knows which bits of a short parity sketch all of its classes have and which none has; pairs of groups
   that these bits prove too different go before they are emitted.
3. Group pairs are expanded to classes, those whose whole parity sketches prove them too different go, and the others are
   verified on their whole sets. Sets are kept for classes only that have a close enough size in a shared list.

Only components are wanted, so pairs inside a component need no check. A few rounds compare every class of a posting
list with one leader of the list and merge what links (linear in the list, however many near copies are in it); then all
pairs of groups that still lie in different components are expanded and verified. No link between different texts is
lost, and no list is cut.

Defined cases: texts without words have an empty set and link with nothing; texts of fewer words than a shingle have
one shingle of all words; rows with equal sets are one class; rows without id take part, but give no component id; a
component's id is its smallest document id; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arterial.llm import text as tx
from arterial.operators.components import components
from arterial.session import pin

# sizes of the broadcast tables behind the order of shingles; what is in them affects speed only, not results
FREQUENT_SHINGLES = 100_000
FREQUENT_WORDS = 200_000
LOCAL_MIN = 4  # texts of one slice that must hold a shingle for it to be counted there
LEADER_ROUNDS = 3
BROADCAST_ROWS = 500_000

BEFORE = 4  # lists just before a list that tell whether two groups have met already
FOLDS = 4  # longs of the short parity sketch that group pairs are filtered on
SKETCH_BITS = (1024, 1 << 17)  # fewest and most parity bits of a set; in between, as many as it has elements or more
_BASE_FIELDS = "n_shingles bigint, digest binary, sketch array<bigint>, group bigint, prefix array<bigint>"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int, order: Order | None = None) -> tuple[np.ndarray, ...]:
    """(row, hash, rank) of the distinct shingles of every text, by row and hash; ranks come from ``order``, else are 0."""
    starts, ends, row = tx.word_positions(data, offsets, tx.SPACED)
    hashes = tx.word_hashes(data, starts, ends)
    found = tx.window_hashes(hashes, words)
    own = row[: len(found)] == row[words - 1 :] if len(found) else np.zeros(0, bool)
    rows, codes = [row[: len(found)][own]], [found[own]]
    weights = [order.weights(hashes, words)[own] if order else np.zeros(len(codes[0]), np.int32)]
    count = np.bincount(row, minlength=len(offsets) - 1)
    first = np.cumsum(count) - count
    for n in range(1, words):
        short = np.flatnonzero(count == n)
        if len(short):
            code = np.zeros(len(short), np.uint64)
            for k in range(n):
                code = code * np.uint64(tx.BASE) + hashes[first[short] + k]
            rows.append(short)
            codes.append(tx.mix(code + np.uint64(n)))
            weights.append(np.zeros(len(short), np.int32))
    rows, codes, weights = np.concatenate(rows), np.concatenate(codes), np.concatenate(weights)
    by_code = np.lexsort((codes, rows))
    rows, codes, weights = rows[by_code], codes[by_code], weights[by_code]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (codes[1:] != codes[:-1])
    rows, codes, weights = rows[new], codes[new], weights[new]
    return rows, codes, order.ranks(codes, weights) if order else weights


class Order:
    """Ranks of shingles: the sum of the magnitudes of their words' counts, or beyond that for known frequent shingles."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, shingles: np.ndarray):
        by_code = np.argsort(words)
        self.words, self.sizes = words[by_code], (np.log2(np.maximum(counts[by_code], 1)) + 1).astype(np.int32)
        # ``shingles`` come in the order of their frequency, most frequent last
        self.shingles, self.place = np.sort(shingles), np.argsort(shingles).astype(np.int32)

    @staticmethod
    def _lookup(table: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table, codes), max(0, len(table) - 1))
        return at, table[at] == codes if len(table) else np.zeros(len(codes), bool)

    def weights(self, hashes: np.ndarray, length: int) -> np.ndarray:
        at, known = self._lookup(self.words, hashes)
        size = np.where(known, self.sizes[at], 0) if len(self.words) else np.zeros(len(hashes), np.int32)
        return sum(size[k : len(size) - length + 1 + k] for k in range(length))

    def ranks(self, codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        at, known = self._lookup(self.shingles, codes)
        return np.where(known, self.place[at] + 100_000, weights) if len(self.shingles) else weights


def _described(batch: pa.RecordBatch, column: str, words: int, percent: int, order: Order) -> dict[str, pa.Array]:
    """Size, digest, group and prefix of every text's set."""
    data, offsets = tx.text_bytes(batch.column(batch.schema.get_field_index(column)))
    row, code, rank = shingle_sets(data, offsets, words, order)
    size = np.bincount(row, minlength=batch.num_rows)
    stop = np.cumsum(size)
    digests = [hashlib.blake2b(code[b - n : b].tobytes(), digest_size=16).digest() for b, n in zip(stop, size)]
    # one parity bit per hash bucket: sets that differ in d elements differ in at most d bits
    bits = np.clip(2 ** np.ceil(np.log2(np.maximum(size, 1))), *SKETCH_BITS).astype(np.int64)
    begin = np.cumsum(bits // 64) - bits // 64
    bit = code.view(np.int64) & (bits[row] - 1)
    sketch = np.zeros(int((bits // 64).sum()), np.uint64)
    np.bitwise_xor.at(sketch, begin[row] + (bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
    code = code[np.lexsort((rank, row))]  # stable: equal ranks stay in order of their hashes
    need = size - -(-size * percent // 100) + 1
    need[size == 0] = 0
    inside = np.arange(len(code)) - np.repeat(stop - size, size) < np.repeat(need, size)
    kept = code[inside]
    ends = np.cumsum(need)
    groups = [
        int.from_bytes(hashlib.blake2b(kept[b - n : b].tobytes() + int(s).to_bytes(8, "little"), digest_size=8).digest(), "little", signed=True)
        for b, n, s in zip(ends, need, size)
    ]
    return {
        "n_shingles": pa.array(size, pa.int64()),
        "digest": pa.array(digests, pa.binary()),
        "sketch": pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(bits // 64)]), pa.int32()), pa.array(tx.signed(sketch))
        ),
        "group": pa.array(groups, pa.int64()),
        "prefix": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(tx.signed(kept))),
    }


def _whole_sets(batch: pa.RecordBatch, column: str, words: int) -> dict[str, pa.Array]:
    data, offsets = tx.text_bytes(batch.column(batch.schema.get_field_index(column)))
    row, code, _ = shingle_sets(data, offsets, words)
    stop = np.cumsum(np.bincount(row, minlength=batch.num_rows))
    bounds = np.concatenate([[0], stop])
    return {
        "digest": pa.array([hashlib.blake2b(code[a:b].tobytes(), digest_size=16).digest() for a, b in zip(bounds, stop)], pa.binary()),
        "shingles": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(tx.signed(code))),
    }


def shingle_order(docs: DataFrame, text_col: str, words: int) -> Order:
    """Count words and shingles that repeat inside slices of the texts, over all texts, and keep the most frequent."""

    def run(batches):
        for batch in batches:
            for part in tx.slices(batch, [text_col], 8 << 20):
                data, offsets = tx.text_bytes(part.column(0))
                starts, ends, _ = tx.word_positions(data, offsets, tx.SPACED)
                for kind, codes, least in (("w", tx.word_hashes(data, starts, ends), 2), ("s", shingle_sets(data, offsets, words)[1], LOCAL_MIN)):
                    code, n = np.unique(codes, return_counts=True)
                    often = n >= least
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind] * int(often.sum()), pa.string()), pa.array(tx.signed(code[often])), pa.array(n[often])], names=["kind", "code", "n"]
                    )

    counted = docs.select(text_col).mapInArrow(run, "kind string, code bigint, n bigint").groupBy("kind", "code").agg(F.sum("n").alias("n"))
    counted = pin(counted)
    top = lambda kind, n: counted.where(F.col("kind") == kind).orderBy(F.desc("n"), "code").limit(n).toPandas()
    common, shingles = top("w", FREQUENT_WORDS), top("s", FREQUENT_SHINGLES)
    codes = lambda frame: frame["code"].to_numpy(np.int64).view(np.uint64)
    return Order(codes(common), common["n"].to_numpy(np.int64), codes(shingles)[::-1])


def small(df: DataFrame) -> DataFrame:
    """Broadcast a pinned table whose counted rows prove it small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _folded(sketch: str, words: Column) -> Column:
    """A sketch as one of half as many buckets, if the other one is shorter (close sizes are at most one step apart)."""
    half = F.floor(F.size(sketch) / 2).cast("int")
    both = F.zip_with(F.slice(sketch, 1, half), F.slice(sketch, half + 1, half), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(sketch) > words, both).otherwise(F.col(sketch))


def _fold(sketch: str, k: int) -> Column:
    """Long ``k`` of the sketch folded to ``FOLDS`` longs."""
    own = F.filter(sketch, lambda _, i: i % FOLDS == k)
    return F.aggregate(own, F.lit(0).cast("bigint"), lambda s, x: s.bitwiseXOR(x))


def _bits_apart(g: str, h: str) -> Column:
    """Bits of the short sketch in which every class of group ``g`` differs from every class of group ``h``."""
    found = F.lit(0)
    for k in range(FOLDS):
        all_g, any_g, all_h, any_h = (F.col(f"{x}{k}_{y}") for y in (g, h) for x in ("all", "any"))
        one_side = all_g.bitwiseAND(F.bitwise_not(any_h)).bitwiseOR(all_h.bitwiseAND(F.bitwise_not(any_g)))
        found = found + F.bit_count(one_side)
    return found


def _close(a: str, b: str, percent: int):
    """Sizes whose sets can be similar enough."""
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


class _State:
    """Classes in shared posting lists, their sets, and the component of each as far as it is known."""

    def __init__(self, classes: DataFrame, lists: DataFrame, sets: DataFrame, percent: int):
        self.classes, self.lists, self.sets, self.percent = classes.drop("sketch"), lists, sets, percent
        self.sketches = classes.select("digest", "n", "sketch")
        self.folds = [f"fold{k}" for k in range(FOLDS)]
        self.links: DataFrame | None = None
        self.component: DataFrame | None = None

    def placed(self) -> DataFrame:
        """(digest, group, n, folded sketch, comp)."""
        if self.component is None:
            return self.classes.withColumn("comp", F.col("digest"))
        known = self.component.select(F.col("node").alias("digest"), F.col("component").alias("known"))
        return self.classes.join(known, "digest", "left").select(*self.classes.columns, F.coalesce("known", "digest").alias("comp"))

    def verify(self, pairs: DataFrame) -> bool:
        """Keep the pairs (a, b) whose sets are similar enough as links; whether there were any."""
        a = self.sketches.select(F.col("digest").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
        b = self.sketches.select(F.col("digest").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
        a_words, b_words = F.size("sketch_a"), F.size("sketch_b")
        bits = F.aggregate(F.zip_with(_folded("sketch_a", b_words), _folded("sketch_b", a_words), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
        # |union| - |intersection| >= bits, and similar sets have (100 + percent) * that <= (100 - percent) * (n_a + n_b)
        likely = bits * (100 + self.percent) <= (F.col("n_a") + F.col("n_b")) * (100 - self.percent)
        pairs = pin(pairs.join(b, "b").join(a, "a").where(likely).select("a", "b"))
        wanted = small(pin(pairs.select(F.explode(F.array("a", "b")).alias("digest")).distinct()))
        sets = self.sets.join(wanted, "digest", "left_semi")
        left = sets.select(F.col("digest").alias("a"), F.col("shingles").alias("set_a"))
        right = sets.select(F.col("digest").alias("b"), F.col("shingles").alias("set_b"))
        common = F.size(F.array_intersect("set_a", "set_b"))
        both = F.size("set_a") + F.size("set_b") - common
        links = pin(pairs.join(right, "b").join(left, "a").where(common * 100 >= both * self.percent).select("a", "b"))
        if links.isEmpty():
            return False
        self.links = links if self.links is None else self.links.unionByName(links)
        self.component = pin(components(self.links))
        return True

    def groups(self, placed: DataFrame, salt: int) -> DataFrame:
        """One row per group: the range of its components and a leading class."""
        return placed.groupBy("group", "n").agg(
            F.min("comp").alias("low"), F.max("comp").alias("high"), F.min(F.struct(F.xxhash64(F.lit(salt), "digest"), "digest")).alias("lead")
        ).select("group", "n", "low", "high", "lead.digest")

    def leader_round(self, salt: int) -> bool:
        """Compare the classes of every list that spans components with one leader; False if no list and no group does.

        That there is nothing to compare does not end the search: the leaders may only be of other sizes than what is left.
        Lists choose their leaders independently, so near copies, which share many lists, meet many leaders in a round.
        """
        placed = pin(self.placed())
        groups = pin(self.groups(placed, salt))
        listed = self.lists.join(groups, ["group", "n"])
        leaders = listed.groupBy("token").agg(
            F.min("low").alias("low"), F.max("high").alias("high"),
            F.min(F.struct(F.xxhash64(F.lit(salt), "token", "group").alias("h"), "digest", "n")).alias("lead"),
        ).where("low <> high").select("token", F.col("lead.digest").alias("a"), F.col("lead.n").alias("n_a"))
        leaders = pin(leaders)
        met = self.lists.join(leaders, "token").where(_close("n", "n_a", self.percent)).select("group", "n", "a")
        inner = groups.where("low <> high").select("group", "n", F.col("digest").alias("a"))
        if leaders.isEmpty() and inner.isEmpty():
            return False
        met = met.unionByName(inner).distinct()
        of_a = placed.select(F.col("digest").alias("a"), F.col("comp").alias("comp_a"))
        pairs = met.join(placed, ["group", "n"]).join(of_a, "a").where("comp <> comp_a").select("a", F.col("digest").alias("b"))
        pairs = pin(pairs.distinct())
        if not pairs.isEmpty():
            self.verify(pairs)
        return True

    def last_round(self) -> None:
        """Expand and verify every pair of groups (or of classes in a group) that spans components."""
        placed = pin(self.placed())
        shared = [f(fold).alias(f"{x}{k}") for k, fold in enumerate(self.folds) for x, f in (("all", F.bit_and), ("any", F.bit_or))]
        groups = pin(placed.groupBy("group", "n").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), *shared))
        spans = self.lists.join(groups.select("group", "n", "low", "high"), ["group", "n"])
        mixed = spans.groupBy("token").agg(F.min("low").alias("lo"), F.max("high").alias("hi")).where("lo <> hi").select("token")
        # a group's lists in the order of all shingles (its prefix bounds their number), each with the ones just before it
        own = Window.partitionBy("group", "n").orderBy("place")
        before = F.array_compact(F.array(*[F.lag("token", k).over(own) for k in range(1, BEFORE + 1)]))
        listed = self.lists.join(mixed, "token").join(groups, ["group", "n"]).withColumn("before", before)
        # the first shingle two sets share, in the order of all, has behind it what else they share: a pair is left to the lists
        # in which enough stands behind the shingle on both sides, and its first one is among them
        listed = listed.withColumn("rest", F.col("n") - F.col("place"))
        told = ["n", "low", "high", "rest", "before", *(f"{x}{k}" for k in range(FOLDS) for x in ("all", "any"))]
        side = lambda x: [F.col("group").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in told)]
        one, two = listed.select("token", *side("g")), listed.select("token", *side("h"))
        apart = (F.least("low_g", "low_h") != F.greatest("high_g", "high_h")) & (F.col("g") < F.col("h"))
        enough = F.least("rest_g", "rest_h") * (100 + self.percent) >= (F.col("n_g") + F.col("n_h")) * self.percent
        likely = _bits_apart("g", "h") * (100 + self.percent) <= (F.col("n_g") + F.col("n_h")) * (100 - self.percent)
        # two groups that share a list just before this one meet there, or in an earlier one: their first is never left out
        first = ~F.arrays_overlap("before_g", "before_h")
        pairs = one.join(two, "token").where(apart & enough & first & _close("n_g", "n_h", self.percent) & likely).select("g", "n_g", "h", "n_h")
        inner = groups.where("low <> high").select(F.col("group").alias("g"), F.col("n").alias("n_g"), F.col("group").alias("h"), F.col("n").alias("n_h"))
        pairs = pairs.unionByName(inner).distinct()
        of_g = placed.select(F.col("group").alias("g"), F.col("n").alias("n_g"), F.col("digest").alias("a"), F.col("comp").alias("comp_a"))
        of_h = placed.select(F.col("group").alias("h"), F.col("n").alias("n_h"), F.col("digest").alias("b"), F.col("comp").alias("comp_b"))
        apart = (F.col("comp_a") != F.col("comp_b")) & ((F.col("g") != F.col("h")) | (F.col("a") < F.col("b")))
        wide = pairs.join(of_g, ["g", "n_g"]).join(of_h, ["h", "n_h"]).where(apart).select("a", "b")
        wide = pin(wide.distinct())
        if not wide.isEmpty():
            self.verify(wide)


def link_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """One row per document: ``id_col``, n_shingles, component_id, n_links and class_size.

    Two documents link when 100 * |intersection| >= percent * |union| of their shingle sets; component_id is the smallest
    id reachable. class_size counts the documents with the same set; n_links is the number of verified links that the
    search kept for the document's class (enough to connect its component, not all that exist).
    """
    source = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    order = source.sparkSession.sparkContext.broadcast(shingle_order(source, "_text", words))
    described = pin(tx.annotate(source, lambda b: _described(b, "_text", words, percent, order.value), _BASE_FIELDS, [id_col], ["_text"]))
    classes = pin(described.where("n_shingles > 0").groupBy("digest").agg(
        F.first("n_shingles").alias("n"), F.first("group").alias("group"), F.min(id_col).alias("lowest"), F.count(F.lit(1)).alias("copies"),
        F.first("sketch").alias("sketch"), F.first("prefix").alias("prefix"),
    ))
    postings = classes.select(F.posexplode("prefix").alias("place", "token"), "group", "n")
    # lists with at least two groups whose sizes are close: equal or neighbouring classes of the size's logarithm
    magnitude = F.floor(F.log(F.col("n").cast("double")) / (-1.0001 * math.log(percent / 100)) if percent < 100 else F.col("n")).cast("int")
    shared = postings.groupBy("token").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo <> hi").select("token")
    listed = pin(postings.join(shared, "token").distinct().withColumn("size", magnitude))
    sizes = listed.groupBy("token", "size").agg(F.count(F.lit(1)).alias("own"))
    near = sizes.select("token", F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)).alias("size"), "own")
    near = near.groupBy("token", "size").agg(F.sum("own").alias("groups")).where("groups > 1").select("token", "size")
    lists = pin(listed.join(near, ["token", "size"]).select("token", "group", "n", "place"))
    # classes that can link: in such a list, or in a group with others
    crowded = classes.groupBy("group", "n").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("group", "n")
    able = lists.select("group", "n").unionByName(crowded).distinct()
    folds = [_fold("sketch", k).alias(f"fold{k}") for k in range(FOLDS)]
    active = pin(classes.join(able, ["group", "n"]).select("digest", "group", "n", "sketch", "lowest", *folds))
    component = None
    links = None
    if not active.isEmpty():
        # one row per class, or as many as repeat its smallest id: more rows of a set do no harm
        wanted = active.select(F.col("digest").alias("of"), F.col("lowest").alias("at"))
        wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
        sets = tx.annotate(source, lambda b: _whole_sets(b, "_text", words), "digest binary, shingles array<bigint>", [id_col], ["_text"])
        same = (F.col("digest") == F.col("of")) & F.col(id_col).eqNullSafe(F.col("at"))
        sets = pin(sets.join(wanted, same, "left_semi").select("digest", "shingles"))
        state = _State(active.drop("lowest"), lists, sets, percent)
        for salt in range(LEADER_ROUNDS):
            if not state.leader_round(salt):
                break
        state.last_round()
        component, links = state.component, state.links
    if component is None:
        labelled = classes.select("digest", F.col("lowest").alias("component_id"), F.lit(0).cast("bigint").alias("n_links"), "copies")
    else:
        known = classes.join(component.select(F.col("node").alias("digest"), "component"), "digest", "left").withColumn(
            "component", F.coalesce("component", "digest")
        )
        lowest = known.groupBy("component").agg(F.min("lowest").alias("component_id"))
        ends = links.select(F.explode(F.array("a", "b")).alias("digest")).groupBy("digest").agg(F.count(F.lit(1)).alias("n_links"))
        labelled = known.join(lowest, "component").join(ends, "digest", "left").select(
            "digest", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "copies"
        )
    return described.select(id_col, "n_shingles", "digest").join(labelled, "digest", "left").select(
        id_col, "n_shingles", F.coalesce("component_id", F.col(id_col)).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("copies", F.lit(1)).alias("class_size"),
    )
