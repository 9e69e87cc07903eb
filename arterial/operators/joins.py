"""Joins that hold up when one key has most of the rows (JON-1, JON-5..7, JON-9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arterial.operators.ordering import ROWS_PER_TASK, OrderedRows, hot_keys, keyed, same_key


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] | str,
    how: str = "inner",
    rows_per_task: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join of any table with one that has at most one row per key.

    ``how`` is inner, left, left_semi or left_anti. Adaptive execution splits hot left keys while the join runs, so by
    default nothing is counted beforehand. Where it is off, ``rows_per_task`` counts the left keys first (or ``hot`` names
    the hot ones): their rows are joined with the few right rows that have those keys by broadcast, all others as usual.
    """
    on = [on] if isinstance(on, str) else list(on)
    if rows_per_task:
        hot = hot_keys(left, on, rows_per_task)
    if hot is None:
        return left.join(right, on, how)
    keys = F.broadcast(keyed(hot.drop("_rows"), on))
    few = right.join(keys, same_key(right, keys, on), "left_semi")
    hot_rows = left.join(keys, same_key(left, keys, on), "left_semi").join(F.broadcast(few), on, how)
    rest = left.join(keys, same_key(left, keys, on), "left_anti").join(right, on, how)
    return rest.unionByName(hot_rows)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] | str,
    salt_by: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Inner equi-join whose keys may repeat on both sides.

    The left rows of a hot key are spread over as many salts as the key needs tasks, by a hash of
    ``salt_by``; its right rows are repeated once per salt.
    """
    on = [on] if isinstance(on, str) else list(on)
    hot = hot_keys(left, on, rows_per_task)
    if hot is None:
        return left.join(right, on)
    salts = hot.withColumn("_salts", F.ceil(F.col("_rows") / rows_per_task).cast("int")).drop("_rows")
    keys = keyed(salts, on)

    def with_salts(df: DataFrame) -> DataFrame:
        known = df.join(keys, same_key(df, keys, on), "left").drop(*["_k_" + c for c in on])
        return known.withColumn("_salts", F.coalesce("_salts", F.lit(1)))

    spread = with_salts(left).withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.col("_salts")).cast("int"))
    copies = with_salts(right).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    joined = spread.drop("_salts").join(copies.drop("_salts"), [*on, "_salt"])
    return joined.drop("_salt")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str] | str | None = None,
    ts: str = "timestamp",
    values: Sequence[str] | None = None,
    tiebreak: str | None = None,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Attach to each left row the latest right row with the same key and ``right.ts <= left.ts``.

    Both sides are stacked and ordered once; right rows come first at equal times. ``tiebreak``
    (a column of both sides) orders rows of equal time; without it, the right side must not repeat a time within a key.
    Rows without a time match nothing. ``values`` are the right columns to attach,
    by default all but keys, time and tiebreak; the matching right time becomes ``<ts>_right``.
    """
    by = [by] if isinstance(by, str) else list(by or [])
    fixed = {*by, ts, *([tiebreak] if tiebreak else [])}
    values = list(values) if values is not None else [c for c in right.columns if c not in fixed]
    order = [ts, "_side", *([tiebreak] if tiebreak else [])]
    attached = F.struct(F.col(ts).alias(ts + "_right"), *[F.col(v).alias(v) for v in values])
    rows = left.select(
        *by, ts, *([tiebreak] if tiebreak else []), F.lit(1).alias("_side"),
        F.struct(*left.columns).alias("_left"),
    )
    known = right.filter(F.col(ts).isNotNull()).select(
        *by, ts, *([tiebreak] if tiebreak else []), F.lit(0).alias("_side"), attached.alias("_right")
    )
    stacked = rows.unionByName(known, allowMissingColumns=True)
    filled = OrderedRows(stacked, by, order, rows_per_task).carry({"_match": F.col("_right")}).result()
    match = F.when(F.col(ts).isNotNull(), F.col("_match")).alias("_match")
    return filled.filter(F.col("_side") == 1).select("_left", match).select("_left.*", "_match.*")


def holiday_flag(df: DataFrame, holidays: DataFrame, ts: str = "timestamp") -> DataFrame:
    """``is_holiday`` 1/0 from a table with one ``date`` per holiday."""
    days = holidays.select(F.col("date").alias("_day"), F.lit(1).alias("_holiday")).distinct()
    dated = df.withColumn("_day", F.to_date(ts))
    joined = lookup_join(dated, days, "_day", "left")
    return joined.withColumn("is_holiday", F.coalesce("_holiday", F.lit(0))).drop("_day", "_holiday")
