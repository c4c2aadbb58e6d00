"""Mixing sources to target weights by subset-sum budget fitting (operator 3).

A source's target is met with whole copies of all its documents and a subset of them for the rest of
the budget. The subset is chosen by size alone: documents are counted by exact size, each size gives
its share of the budget, and a bounded-knapsack dynamic programme over the sizes fits what remains
(after the largest sizes have brought it below ``DP_BUDGET``). Which documents of a size are taken is
decided by a seeded hash of their id: hash buckets are counted first, so that only the one bucket in
which the count runs out is ranked.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .._util import quote, temp_name

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
DP_BUDGET = 1 << 16
BUCKETS = 4096


def word_count(text: Column) -> Column:
    """Number of words [^\\x20\\x09-\\x0D]+; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, most: float = MOST) -> dict[str | None, float]:
    """Target of each source: sources by code point, null last, take ``weights`` in turn and share
    the sum of all sizes; none exceeds ``most`` times its size, the excess is shared again."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: float(weights[k % len(weights)]) for k, (s, _) in enumerate(order)}
    limit = {s: float(most * n) for s, n in order}
    total = float(sum(n for _, n in order))
    out: dict[str | None, float] = {}
    free = [s for s, _ in order]
    while free:
        left, share = total - sum(out.values()), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / share > limit[s]]
        if not over:
            out.update({s: left * weight[s] / share for s in free})
            break
        out.update({s: limit[s] for s in over})
        free = [s for s in free if s not in out]
    return out


def fit(counts: dict[int, int], budget: int, dp_budget: int = DP_BUDGET) -> dict[int, int]:
    """How many documents of each size to take, at most as many as there are, so that their sum is
    near ``budget``: proportional shares, then the largest sizes first down to ``dp_budget``, then
    the reachable sum nearest to what remains (the smaller one of two)."""
    total = sum(n * c for n, c in counts.items())
    if budget >= total:
        return dict(counts)
    take = {n: c * budget // total for n, c in counts.items()}
    left = budget - sum(n * t for n, t in take.items())
    for n in sorted(counts, reverse=True):
        if left <= dp_budget:
            break
        more = min(counts[n] - take[n], (left - dp_budget + n - 1) // n, left // n)
        take[n] += more
        left -= more * n
    sizes = [n for n in sorted(counts) if counts[n] > take[n] and n <= 2 * left]
    span = (1 << (2 * left + 1)) - 1
    reach, steps = 1, []
    for n in sizes:
        steps.append(reach)
        free, part = min(counts[n] - take[n], 2 * left // n), 1
        while free > 0:  # powers of two make every number of copies
            part = min(part, free)
            reach |= (reach << (n * part)) & span
            free -= part
            part *= 2
        if reach >> left & 1:
            sizes = sizes[: len(steps)]
            break
    best = left
    for off in range(left + 1):
        if reach >> (left - off) & 1:
            best = left - off
            break
        if reach >> (left + off) & 1:
            best = left + off
            break
    for n, before in zip(reversed(sizes), reversed(steps)):
        k = 0
        while not before >> (best - k * n) & 1:
            k += 1
        take[n] += k
        best -= k * n
    return take


def _plan(frame: pd.DataFrame) -> pd.DataFrame:
    """One source: rows (size, n) to whole copies and number of documents taken once more."""
    counts = {int(s): int(n) for s, n in zip(frame["size"], frame["n"]) if s > 0}
    total = sum(s * n for s, n in counts.items())
    target = float(frame["target"].iloc[0])
    whole = min(int(target // total), MOST) if total else 0
    rest = round(target - whole * total) if total and whole < MOST else 0
    take = fit(counts, rest) if rest > 0 else {}
    sizes = list(counts)
    n = len(sizes)
    return pd.DataFrame(
        {
            "source": np.array([frame["source"].iloc[0]] * n, object), "size": np.array(sizes, np.int64),
            "whole": np.full(n, whole, np.int32), "take": np.array([take.get(s, 0) for s in sizes], np.int64),
        }
    )


def mix_sources(docs: DataFrame, size_col: str, id_col: str = "doc_id", source_col: str = "source", seed: int = 11, out: tuple[str, str, str] = ("source_size", "target", "copies")) -> DataFrame:
    """``docs`` with three more columns, named by ``out``: the size of the row's source, the source's
    target, and how often the mix takes the row (0 to 3).

    The driver gets one row a source. Rows without size (null or 0) are never taken. Repeated rows
    and rows with a null id count each for itself; equal ones are interchangeable. A null source is
    a source of its own. An empty table gives no rows; the same input and seed give the same mix.
    """
    spark = docs.sparkSession
    names = ("key", "source", "size", "bucket", "order", "way", "need", "whole", "n", "sum", "target", "source2", "size2", "bucket2")
    key, source, size, bucket, order, way, need, whole_n, group_n, sum_n, target_n, source2, size2, bucket2 = (temp_name(docs, x) for x in names)
    source_size, target, copies = out
    hashed = F.xxhash64(F.lit(seed), F.col(quote(id_col)))
    rows = (
        docs.withColumn(source, F.col(quote(source_col)).cast("string"))
        .withColumn(size, F.coalesce(F.col(quote(size_col)).cast("long"), F.lit(0).cast("long")))
        .withColumn(order, hashed)
        .withColumn(bucket, F.pmod(F.xxhash64(F.lit(seed), F.col(order)), F.lit(BUCKETS).cast("long")))
    )
    counted = rows.groupBy(F.col(source).alias("source"), F.col(size).alias("size")).agg(F.count("*").alias("n"))
    sums = [(r["source"], int(r["s"])) for r in counted.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("s")).collect()]
    goal = targets(sums)
    goals = spark.createDataFrame([(s, n, goal[s]) for s, n in sums], "source string, source_size long, target double")
    plan = (
        counted.join(goals.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
        .groupBy("source").applyInPandas(_plan, "source string, size long, whole int, take long")
    )
    # how many of each hash bucket go: all, none, or (in one bucket a size) the first ones by hash
    parts = rows.groupBy(F.col(source).alias("source"), F.col(size).alias("size"), F.col(bucket).alias("bucket")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    parts = parts.withColumn("before", before).alias("p")
    plan = plan.alias("q")
    parts = parts.join(plan, F.col("p.source").eqNullSafe(F.col("q.source")) & (F.col("p.size") == F.col("q.size")))
    parts = parts.select(
        F.col("p.source").alias(source2), F.col("p.size").alias(size2), F.col("p.bucket").alias(bucket2), F.col("whole").alias(whole_n),
        F.least(F.greatest(F.col("take") - F.col("before"), F.lit(0)), F.col("n")).alias(need), F.col("n").alias(group_n),
    )
    on = F.col(source).eqNullSafe(F.col(source2)) & (F.col(size) == F.col(size2)) & (F.col(bucket) == F.col(bucket2))
    joined = rows.join(parts, on, "left").drop(source2, size2, bucket2)
    joined = joined.join(goals.select(F.col("source").alias(key), F.col("source_size").alias(sum_n), F.col("target").alias(target_n)), F.col(source).eqNullSafe(F.col(key)))
    split = (F.col(need) > 0) & (F.col(need) < F.col(group_n))
    whole = F.coalesce(F.col(whole_n), F.lit(0)).cast("int")
    settled = joined.where(~F.coalesce(split, F.lit(False))).withColumn(way, whole + F.coalesce((F.col(need) > 0).cast("int"), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy(source, size, bucket).orderBy(order, F.col(quote(id_col))))
    ranked = joined.where(split).withColumn(way, whole + (rank <= F.col(need)).cast("int"))
    both = settled.unionByName(ranked)
    return both.select(*[F.col(quote(c)) for c in docs.columns], F.col(sum_n).alias(source_size), F.col(target_n).alias(target), F.col(way).alias(copies))
