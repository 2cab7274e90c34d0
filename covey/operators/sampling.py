"""Distinct rows, and samples of a fixed size."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covey.functions.columns import column
from covey.functions.keys import ContentKey
from covey.sources.shared import materialise

_KEY = "__content_key"
_COPIES = "__copies"
_PREFIX_DIGITS = 3
_RANKED_IN_ONE_TASK = 10_000
_EXPLODED_AT_ONCE = 1_000


def distinct_rows(df: DataFrame) -> DataFrame:
    """One of each row (null = null, NaN = NaN, 0.0 = -0.0).

    The partial aggregate drops copies before the shuffle, so a row that makes up a third of the
    table reaches the reducer once per task.
    """
    return df.dropDuplicates()


def capped_sample(
    df: DataFrame,
    target_n: int,
    seed: int,
    total_rows: int | None = None,
    distinct: bool = False,
    method: str = "xxhash64",
) -> DataFrame:
    """At most ``target_n`` rows of ``df``, of its distinct rows if ``distinct``.

    ``xxhash64``, ``md5``
        exactly the ``target_n`` rows with the smallest ``ContentKey``. The choice depends on row
        content and seed alone, so a recomputed partition can never change it.
    ``bernoulli``
        independent draws, then a limit; may return fewer, and depends on the partitioning.

    Unless it is ``df`` itself, the result reads a written table.
    """
    if method == "bernoulli":
        return _bernoulli(df, target_n, seed, distinct)
    key = ContentKey(df.schema, seed, method)
    total = df.count() if total_rows is None else total_rows
    if total <= target_n:
        return materialise(distinct_rows(df), "distinct") if distinct else df

    candidates = _candidates(df, target_n, total, key, distinct)
    last_key, wanted_of_last = _cut(candidates, target_n)
    copies = F.col(_COPIES)
    if last_key is not None:
        candidates = candidates.where(F.col(_KEY) <= last_key)
        copies = F.when(F.col(_KEY) < last_key, copies).otherwise(F.lit(wanted_of_last))
    if not distinct:
        candidates = _repeated(candidates, copies)
    return candidates.select(*[column(name) for name in df.columns])


def _bernoulli(df: DataFrame, target_n: int, seed: int, distinct: bool) -> DataFrame:
    # Draws go by the order of rows, so both steps are written down before they are read again.
    rows = materialise(distinct_rows(df), "distinct") if distinct else df
    total = rows.count()
    if total <= target_n:
        return rows
    # A few rows too many may be drawn; the ones with the largest random keys go again.
    drawn = materialise(
        rows.sample(False, target_n / total, seed).withColumns(
            {_KEY: F.lpad(F.hex(F.xxhash64(F.rand(seed))), 16, "0"), _COPIES: F.lit(1).cast("long")}
        ),
        "sample",
    )
    last, wanted = _cut(drawn, target_n)
    if last is not None:
        drawn = drawn.where(F.col(_KEY) <= last if wanted else F.col(_KEY) < last)
    return drawn.select(*[column(name) for name in df.columns])


def _candidates(
    df: DataFrame, target_n: int, total: int, key: ContentKey, distinct: bool
) -> DataFrame:
    """A written table of distinct rows, with key and number of copies, that holds at least the
    ``target_n`` smallest keys (or every row, where there are fewer).

    Keys are uniform, so a threshold on the key finds them while shuffling little more than
    ``target_n`` rows of an input of any size. Where copies are common the first threshold
    brings in too few distinct rows; the share found says how far to raise it. Copies are
    counted before the shuffle, so a row that fills a third of the table stays one row.
    """
    # Distinct rows below the threshold vary by the square root of their number.
    enough = target_n + 6 * math.sqrt(target_n) + 10
    share = enough / total
    names = [column(name) for name in df.columns]
    copies = F.lit(1).cast("long") if distinct else F.count("*")
    while True:
        below = df if share >= 1 else df.where(key.below(share))
        collapsed = below.groupBy(*names).agg(copies.alias(_COPIES))
        table = materialise(collapsed.withColumn(_KEY, key.text()), "sample")
        found = table.agg(F.coalesce(F.sum(_COPIES), F.lit(0))).first()[0]
        if share >= 1 or found >= target_n:
            return table
        share *= max(2.0, 1.05 * enough / found if found else 16.0)


def _cut(candidates: DataFrame, target_n: int) -> tuple[str | None, int]:
    """The largest key to keep and how many of its copies; ``(None, 0)`` to keep everything.

    Narrows a prefix of the key by counting per next digits: each round returns at most
    16**3 counts, and the rows left to rank fit one task.
    """
    prefix, remaining = "", target_n
    while True:
        inside = candidates.where(F.col(_KEY).startswith(prefix))
        width = len(prefix) + _PREFIX_DIGITS
        counts = (
            inside.groupBy(F.substring(_KEY, 1, width).alias("prefix"))
            .agg(F.sum(_COPIES).alias("rows"), F.count("*").alias("keys"))
            .orderBy("prefix")
            .collect()
        )
        border = None
        for group in counts:
            if group["rows"] > remaining:
                border = group
                break
            remaining -= group["rows"]
        if border is None:
            return None, 0
        prefix = border["prefix"]
        if remaining == 0:
            # The groups before this one fill the sample: keep nothing of it.
            return prefix, 0
        if border["keys"] <= _RANKED_IN_ONE_TASK:
            break
    ranked = (
        candidates.where(F.col(_KEY).startswith(prefix))
        .orderBy(_KEY)
        .limit(min(remaining, border["keys"]))
        .select(_KEY, _COPIES)
        .collect()
    )
    # Every key has at least one copy, so the ranked keys hold at least the remaining rows.
    last = 0
    while ranked[last][_COPIES] < remaining:
        remaining -= ranked[last][_COPIES]
        last += 1
    return ranked[last][_KEY], remaining


def _repeated(df: DataFrame, copies: Column) -> DataFrame:
    """Each row ``copies`` times, in two steps so that no row grows into one huge array."""
    step = F.lit(_EXPLODED_AT_ONCE).cast("long")
    one = F.lit(1).cast("long")
    blocks = F.ceil(F.col("__left") / step).cast("long")
    in_block = F.least(step, F.col("__left") - (F.col("__block") - one) * step)
    return (
        df.withColumn("__left", copies.cast("long"))
        .where(F.col("__left") > 0)
        .withColumn("__block", F.explode(F.sequence(one, blocks)))
        # Blocks of one row go to different tasks, so none writes all copies of a hot row.
        .repartition(*[column(name) for name in df.columns if not name.startswith("__")], "__block")
        .withColumn("__copy", F.explode(F.sequence(one, in_block)))
    )
