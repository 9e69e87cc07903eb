"""Ordered row operators that stay parallel when one key holds much of the data.

``Window.partitionBy(sensor).orderBy(time)`` sends every row of a sensor to one task. That is right
for ordinary sensors and fails for one that holds a third of the table, and for the whole-table
order (no key at all). :class:`OrderedRows` keeps the plain window for ordinary keys. The rows of hot
keys are range-partitioned on (key, order), sorted, and cut into chunks of a bounded size, and the chunks are pinned
in the checkpoint folder so that their borders survive lost executors. A task of that sort cuts as many chunks as it
has rows for, so tasks grow with the rows and not with the chunks. Row frames then run per
(key, chunk) with the few neighbouring rows they look at copied in from the chunks around them, and
running values are carried from chunk to chunk through a table with one row per (key, chunk), in
groups of chunks and groups of groups, so that no window spans all chunks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arterial.session import pin

# Rows of one key that a single task may sort; larger keys are split.
ROWS_PER_TASK = 4_000_000
# Rows of a whole table, without keys, that a single task may sort; a key's rows share their tasks with other keys'.
WHOLE_TABLE_ROWS = 1_000_000
# Chunks, and groups of chunks, that a window over them may hold.
FAN_OUT = 256
# Rows of a task that sorts a range and cuts it into chunks, where chunks are smaller.
RANGE_ROWS = 250_000
# Hot keys up to this number are broadcast.
BROADCAST_KEYS = 100_000

_CHUNK, _HALO = "_chunk", "_halo"
_AT = "_chunk_at"  # a chunked row's place in the whole order; consecutive within a key's part of a chunk


def hot_keys(df: DataFrame, by: Sequence[str], rows_per_task: int, counts: DataFrame | None = None) -> DataFrame | None:
    """Keys with more than ``rows_per_task`` rows and their row counts, or None when there are none.

    ``counts`` (``by`` and ``_rows``) are the counts where they are known without ``df``. The result has at most (rows of df / rows_per_task) rows, is pinned, and carries a broadcast hint if it has few.
    """
    counts = df.groupBy(*by).agg(F.count("*").alias("_rows")) if counts is None else counts.select(*by, "_rows")
    hot = pin(counts.filter(F.col("_rows") > rows_per_task))
    size = hot.count()
    if not size:
        return None
    return F.broadcast(hot) if size <= BROADCAST_KEYS else hot


def same_key(left: DataFrame, right: DataFrame, by: Sequence[str]) -> Column:
    """Null-safe equality of the key columns (a missing key is a key like any other)."""
    condition = F.lit(True)
    for name in by:
        condition = condition & left[name].eqNullSafe(right["_k_" + name])
    return condition


def keyed(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rename the key columns so that ``same_key`` can tell the two sides apart."""
    return df.withColumnsRenamed({name: "_k_" + name for name in by})


class OrderedRows:
    """Rows of each key in ascending ``order``; ``order`` should end in a unique column."""

    def __init__(
        self,
        df: DataFrame,
        by: Sequence[str] | str | None,
        order: Sequence[str] | str,
        rows_per_task: int | None = ROWS_PER_TASK,
        counts: DataFrame | None = None,
    ):
        self.by = [by] if isinstance(by, str) else list(by or [])
        self.order = [order] if isinstance(order, str) else list(order)
        self.plain: DataFrame | None = df
        self.chunked: DataFrame | None = None
        self.chunks = 0
        self._summary: DataFrame | None = None
        if rows_per_task is None:
            return
        if not self.by:
            total = df.count() if counts is None else counts.agg(F.sum("_rows")).first()[0] or 0
            limit = min(rows_per_task, WHOLE_TABLE_ROWS)
            if total > limit:
                self.plain, self.chunked = None, self._chunk(df, total, limit)
            return
        hot = hot_keys(df, self.by, rows_per_task, counts)
        if hot is None:
            return
        total = hot.agg(F.sum("_rows")).first()[0]
        hot = keyed(hot.drop("_rows"), self.by)
        df = pin(df)  # plain rows, hot rows and the borders of their ranges are read from it
        self.plain = df.join(hot, same_key(df, hot, self.by), "left_anti")
        rows = df.join(hot, same_key(df, hot, self.by), "left_semi")
        self.chunked = self._chunk(rows, total, rows_per_task)

    def _chunk(self, df: DataFrame, total: int, rows_per_task: int) -> DataFrame:
        """Sorted ranges, cut every ``rows_per_task`` rows. Chunks of one range have consecutive numbers."""
        ranges = max(df.sparkSession.sparkContext.defaultParallelism, 2 * math.ceil(total / RANGE_ROWS))
        ranges = min(ranges, 2 * math.ceil(total / rows_per_task))
        keys = [*self.by, *self.order]
        ranged = df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
        ranged = pin(ranged.withColumns({_AT: F.monotonically_increasing_id(), "_range": F.spark_partition_id()}))
        # the lower 33 bits of that id are the row's number in its range
        cut = F.floor(F.col(_AT).bitwiseAND((1 << 33) - 1) / rows_per_task)
        most = (ranged.agg(F.max(cut)).first()[0] or 0) + 1
        self.chunks = ranges * most
        return ranged.withColumn(_CHUNK, F.col("_range") * F.lit(most) + cut).drop("_range")

    # -- windows ---------------------------------------------------------------------------

    def _window(self, *extra: str, descending: bool = False) -> WindowSpec:
        order = [_AT] if _CHUNK in extra else self.order
        sort = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
        keys = [F.col(c) for c in (*self.by, *extra)]
        return W.partitionBy(*(keys or [F.lit(0)])).orderBy(*sort)

    def rows(
        self, build: Callable[[DataFrame, WindowSpec], DataFrame], behind: int = 0, ahead: int = 0
    ) -> OrderedRows:
        """Add columns through ``build(df, window)``.

        Its frames may look at most ``behind`` rows back and ``ahead`` rows forward; for windows
        over the result of other windows these are the sums.
        """
        if self.plain is not None:
            self.plain = build(self.plain, self._window())
        if self.chunked is not None:
            parts = self.chunked.withColumn(_HALO, F.lit(False))
            for size, backward in ((behind, False), (ahead, True)):
                if size:
                    parts = parts.unionByName(self._neighbours(size, backward))
            built = build(parts, self._window(_CHUNK))
            self.chunked = built.filter(~F.col(_HALO)).drop(_HALO)
        return self

    def _numbered(self) -> DataFrame:
        """(key, chunk, rows, first and last place, number): the chunks of each key with dense numbers from 0; pinned once."""
        if self._summary is None:
            ends = F.count("*").alias("_n"), F.min(_AT).alias("_lo"), F.max(_AT).alias("_hi"), F.lit(1).alias("_one")
            counts = pin(self.chunked.groupBy(*self.by, _CHUNK).agg(*ends))
            before = self._before(counts, _CHUNK, self.chunks, {"_one": "sum"}, False)
            place = F.coalesce("_b_one", F.lit(0)).alias("_place")
            self._summary = pin(before.select(*self.by, _CHUNK, "_n", "_lo", "_hi", place))
        return self._summary

    def _before(self, table: DataFrame, place: str, size: int, folds: dict[str, str], backward: bool) -> DataFrame:
        """``table`` (a row per key and ``place`` < ``size``) with each column folded over all earlier places of the key, as
        ``_b<column>``. Folds are "sum" and "last" (the nearest value that is not null).

        Places are folded in groups of ``FAN_OUT``, then the groups' totals the same way, and what comes before its group is
        added to each place. So no window holds more than ``FAN_OUT`` rows, however many chunks there are.
        """
        group = place + "_g"
        order = F.col(place).desc() if backward else F.col(place).asc()
        table = table.withColumn(group, F.floor(F.col(place) / FAN_OUT).cast("long"))
        w = W.partitionBy(*self.by, group).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
        here = {
            "_b" + c: F.sum(c).over(w) if fold == "sum" else F.last(c, ignorenulls=True).over(w) for c, fold in folds.items()
        }
        local = table.withColumns(here)
        if size <= FAN_OUT:
            return local.drop(group)
        pick = F.min_by if backward else F.max_by
        totals = table.groupBy(*self.by, group).agg(
            *[(F.sum(c) if fold == "sum" else pick(c, F.when(F.col(c).isNotNull(), F.col(place)))).alias(c) for c, fold in folds.items()]
        )
        outer = self._before(pin(totals), group, math.ceil(size / FAN_OUT), folds, backward)
        on = [*self.by, group]
        side = keyed(outer.select(*on, *[F.col("_b" + c).alias("_o" + c) for c in folds]), on)
        joined = local.join(side, same_key(local, side, on), "left")
        both = {
            "_b" + c: F.coalesce(F.col("_b" + c), F.lit(0)) + F.coalesce(F.col("_o" + c), F.lit(0)) if fold == "sum"
            else F.coalesce(F.col("_b" + c), F.col("_o" + c))
            for c, fold in folds.items()
        }
        return joined.withColumns(both).drop(group, *["_k_" + c for c in on], *["_o" + c for c in folds])

    def _neighbours(self, size: int, from_next: bool) -> DataFrame:
        """For each (key, chunk) the ``size`` rows of the key before it (or after it).

        The edge rows of each chunk meet the next chunk of the key by its number. Where a chunk has fewer rows, the one
        beyond it is asked for the rest, round by round; that is rare, so there is mostly one round.
        """
        chunks = self._numbered()
        step = 1 if from_next else -1
        asking = chunks.select(*self.by, F.col(_CHUNK).alias("_target"), (F.col("_place") + step).alias("_place"), F.lit(size).cast("long").alias("_missing"))
        asked = None
        while True:
            on = [*self.by, "_place"]
            side = keyed(asking, on)
            edge = F.col("_lo" if from_next else "_hi").alias("_edge")
            met = chunks.join(side, same_key(chunks, side, on), "inner").select(
                *[chunks[c] for c in self.by], chunks["_place"], chunks[_CHUNK], "_target", F.least("_missing", "_n").alias("_take"), edge,
                (F.col("_missing") - F.col("_n")).alias("_missing"),
            )
            met = pin(met)
            taken = met.select(*self.by, _CHUNK, "_target", "_take", "_edge")
            asked = taken if asked is None else asked.unionByName(taken)
            asking = met.filter("_missing > 0").select(*self.by, "_target", (F.col("_place") + step).alias("_place"), "_missing")
            if asking.isEmpty():
                break
        on = [*self.by, _CHUNK]
        side = keyed(asked, on)
        edges = self.chunked
        near = edges.join(side, same_key(edges, side, on), "inner").filter(F.abs(F.col(_AT) - F.col("_edge")) < F.col("_take"))
        return near.select(
            *[F.col("_target").alias(c) if c == _CHUNK else edges[c] for c in self.chunked.columns], F.lit(True).alias(_HALO)
        )

    # -- running values --------------------------------------------------------------------

    def _with_chunk_values(self, summary: DataFrame) -> DataFrame:
        """The rows with the values of their (key, chunk) in ``summary``.

        It has one row per (key, chunk), a few per ``rows_per_task`` rows. Spark broadcasts it if its size at run time
        allows; else both sides meet by (key, chunk), as the window afterwards needs them.
        """
        on = [*self.by, _CHUNK]
        side = keyed(summary, on)
        joined = self.chunked.join(side, same_key(self.chunked, side, on), "inner")
        return joined.drop(*["_k_" + c for c in on])

    def carry(self, values: dict[str, Column], backward: bool = False) -> OrderedRows:
        """Last non-null value at or before each row (``backward``: first at or after it)."""
        return self.carry_both({}, values) if backward else self.carry_both(values, {})

    def carry_both(self, forward: dict[str, Column], backward: dict[str, Column]) -> OrderedRows:
        """:meth:`carry` in both directions at once: the rows are summed up, joined and shuffled once."""
        frame = (W.unboundedPreceding, 0)
        ways = [(values, down) for values, down in ((forward, False), (backward, True)) if values]
        if self.plain is not None:
            found = {}
            for values, down in ways:
                w = self._window(descending=down).rowsBetween(*frame)
                found |= {n: F.last(c, ignorenulls=True).over(w) for n, c in values.items()}
            self.plain = self.plain.withColumns(found)
        if self.chunked is not None:
            per_chunk = [
                (F.min_by if down else F.max_by)(c, F.when(c.isNotNull(), F.col(_AT))).alias("_v_" + n)
                for values, down in ways for n, c in values.items()
            ]
            last = pin(self.chunked.groupBy(*self.by, _CHUNK).agg(*per_chunk))
            for values, down in ways:
                last = self._before(last, _CHUNK, self.chunks, {"_v_" + n: "last" for n in values}, down)
            names = [n for values, _ in ways for n in values]
            joined = self._with_chunk_values(last.select(*self.by, _CHUNK, *[F.col("_b_v_" + n).alias("_c_" + n) for n in names]))
            found = {}
            for values, down in ways:
                w = self._window(_CHUNK, descending=down).rowsBetween(*frame)
                found |= {n: F.coalesce(F.last(c, ignorenulls=True).over(w), F.col("_c_" + n)) for n, c in values.items()}
            self.chunked = joined.withColumns(found).drop(*["_c_" + n for n in names])
        return self

    def index(self, name: str = "row_index", total: str | None = None) -> OrderedRows:
        """Number the rows of each key from 1; ``total`` also adds the number of rows of the key."""
        if self.plain is not None:
            self.plain = self.plain.withColumn(
                name, F.row_number().over(self._window()).cast("long")
            )
            if total:
                everything = W.partitionBy(*([F.col(c) for c in self.by] or [F.lit(0)]))
                self.plain = self.plain.withColumn(total, F.count(F.lit(1)).over(everything))
        if self.chunked is not None:
            chunks = self._numbered().select(*self.by, _CHUNK, "_n", "_lo")
            before = self._before(chunks, _CHUNK, self.chunks, {"_n": "sum"}, False)
            first = F.coalesce("_b_n", F.lit(0)) + 1 - F.col("_lo")  # added to a row's place, its number
            summary = before.select(*self.by, _CHUNK, first.alias("_shift"))
            if total:
                sums = keyed(chunks.groupBy(*self.by).agg(F.sum("_n").alias(total)), self.by)
                summary = summary.join(sums, same_key(summary, sums, self.by), "inner").drop(*["_k_" + c for c in self.by])
            self.chunked = self._with_chunk_values(summary).withColumn(name, F.col(_AT) + F.col("_shift")).drop("_shift")
        return self

    def result(self) -> DataFrame:
        parts = [self.plain] if self.plain is not None else []
        if self.chunked is not None:
            parts.append(self.chunked.drop(_CHUNK, _AT))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out
