"""Robust multivariate outliers (operator 5): base rules, then minimum-covariance-determinant distances.

``statistics`` counts over whole texts in one pass. The transformed vectors of the rows that pass the
base rules are then judged by language and source: location and scatter are estimated from the
three quarters of a group's rows that lie nearest (minimum covariance determinant), and a row whose
squared Mahalanobis distance exceeds ``CUTOFF``, the 0.999 point of the chi-square distribution of
five dimensions, is rejected.

The estimate covers all rows and is made by concentration steps over Spark aggregates: starting from
medians and median deviations, each step bins the rows of a group by their distance, sums counts,
vectors and products by group and bin (partially aggregated, so that a hot group ships one row a bin
and task), and takes the nearest bins that hold three quarters of the rows. A row meets the estimates of
its group, its language and all rows by group and salt, so a hot group is spread over tasks. One rule
serves groups of all sizes: with n rows, location and scatter of a group count n / (n + ``BLEND``), and
those of its language the rest; a language's are blended with those of all rows in the same way.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import stored
from ._text import Words, chunk_bounds, grams, mix

SYMBOLS = b"#*$%&|<>"
BLEND = 100
SALT = 64
SHARE = 0.75
STEPS = 6
BINS = 4096
#: Smallest standard deviation of each transformed statistic. That of duplicate lines lets a quarter
#: of the lines (at ten words each) pass the cutoff alone, that of repeated words a tenth of the words.
FLOOR = (0.5, 0.35, 0.7, 0.7, 1.0)
DIMS = ("x0", "x1", "x2", "x3", "x4")


def chi_square(x: float, d: int) -> float:
    """Share of the chi-square distribution of ``d`` dimensions up to ``x``."""
    total = term = 2 / d
    for k in range(1, 1000):
        term *= x / (d + 2 * k)
        total += term
    return total * math.exp(-x / 2 + d / 2 * math.log(x / 2) - math.lgamma(d / 2))


def quantile(share: float, d: int) -> float:
    low, high = 0.0, 200.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, d) < share else (low, mid)
    return high


CUTOFF = quantile(0.999, len(DIMS))  # 20.5
#: Makes up for the quarter left out: the scatter of the nearest rows times this is that of all.
CONSISTENCY = SHARE / chi_square(quantile(SHARE, len(DIMS)), len(DIMS) + 2)  # 1.41

_STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _per_doc(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _duplicate_lines(text: str | None) -> int:
    seen, n = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            if line in seen:
                n += 1
            else:
                seen.add(line)
    return n


def _statistics(batches):
    is_symbol = np.zeros(256, bool)
    is_symbol[list(SYMBOLS)] = True
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        for lo, hi in chunk_bounds(texts):
            part = texts.slice(lo, hi - lo)
            words = Words(part)
            solid = ~words.blank
            chars = _per_doc(solid & ((words.data & 0xC0) != 0x80), words.doc_at)
            symbols = _per_doc(is_symbol[words.data], words.doc_at)
            doc = words.doc_of_word()
            repeat = np.zeros(len(doc), np.int64)
            runs = grams(words.hashes(), 3)
            if len(runs):
                at = np.flatnonzero(doc[: len(runs)] == doc[2:])
                _, which, count = np.unique(mix(runs[at] ^ mix(doc[at].astype(np.uint64) + np.uint64(1))), return_inverse=True, return_counts=True)
                hit = at[count[which] > 1]
                for j in range(3):
                    repeat[hit + j] = 1
            lines = [_duplicate_lines(x) for x in part.to_pylist()]
            stats = [words.counts(), chars, symbols, np.array(lines, np.int64), _per_doc(repeat, words.word_at)]
            others = [batch.column(k).slice(lo, hi - lo) for k in range(batch.num_columns - 1)]
            names = batch.schema.names[:-1] + ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
            yield pa.RecordBatch.from_arrays(others + [pa.array(x.astype(np.int64)) for x in stats], names)


def _fit(key, frame: pd.DataFrame) -> pd.DataFrame:
    """Location and inverse scatter of one group from its sums by distance bin, nearest first."""
    d = len(DIMS)
    frame = frame.sort_values("bin")
    n = frame["n"].to_numpy(np.float64)
    upto = int(np.searchsorted(np.cumsum(n), math.ceil(SHARE * n.sum()))) + 1
    count = n[:upto].sum()
    mean = frame[[f"s{i}" for i in range(d)]].to_numpy(np.float64)[:upto].sum(axis=0) / count
    scatter = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            scatter[i, j] = scatter[j, i] = frame[f"p{i}{j}"].to_numpy(np.float64)[:upto].sum() / count - mean[i] * mean[j]
    scatter = CONSISTENCY * scatter + np.diag(np.square(FLOOR))
    inverse = np.linalg.inv(scatter)
    return pd.DataFrame({"grp": [key[0]], "rows": [int(n.sum())], "mu": [mean.tolist()], "inv": [inverse.ravel().tolist()], "cov": [scatter.ravel().tolist()]})


def blend(rows: float, own: np.ndarray, parent: np.ndarray) -> np.ndarray:
    return (rows * own + BLEND * parent) / (rows + BLEND)


def _blended(all_mu: list[float], all_cov: list[float]):
    """Estimates of the groups, from their own, their language's and the one of all rows."""

    def run(frames):
        d = len(DIMS)
        for f in frames:
            mu, inv = [], []
            for r in f.itertuples(index=False):
                m, c = (blend(r.lang_rows, np.array(own), np.array(of_all)) for own, of_all in ((r.lang_mu, all_mu), (r.lang_cov, all_cov)))
                m, c = blend(r.rows, np.array(r.mu), m), blend(r.rows, np.array(r.cov), c)
                mu.append(m.tolist())
                inv.append(np.linalg.inv(c.reshape(d, d)).ravel().tolist())
            yield pd.DataFrame({"grp": f["grp"], "mu": mu, "inv": inv})

    return run


def _meet(rows: DataFrame, estimates: DataFrame, grp: str = "grp") -> DataFrame:
    """``rows`` with the estimate of their group, dealt by group and salt."""
    salts = estimates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*DIMS), F.lit(SALT)).cast("int"))
    return salted.join(salts.withColumnRenamed("grp", grp), [grp, "salt"], "left").drop("salt")


def _distance() -> F.Column:
    d = len(DIMS)
    off = [F.col(x) - F.col("mu")[i] for i, x in enumerate(DIMS)]
    total = F.lit(0.0)
    for i in range(d):
        for j in range(d):
            total = total + off[i] * off[j] * F.col("inv")[i * d + j]
    return total


def statistics(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """doc_id, lang, source, the five counts, base_failed and the transformed vector x0 to x4."""
    rows = docs.select(*[F.col(c).cast(t).alias(n) for c, t, n in ((id_col, "long", "doc_id"), (lang_col, "string", "lang"), (source_col, "string", "source"), (text_col, "string", "text"))])
    rows = rows.mapInArrow(_statistics, "doc_id long, lang string, source string, " + _STATS)
    rate = lambda c: F.log1p(F.lit(1000.0) * F.col(c) / F.greatest("n_words", F.lit(1)))
    return (
        rows.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
        .withColumn("x0", F.log1p("n_words"))
        .withColumn("x1", F.col("word_chars") / F.greatest("n_words", F.lit(1)))
        .withColumn("x2", rate("n_symbols")).withColumn("x3", rate("n_dup_lines")).withColumn("x4", rate("n_repeat_words"))
    )


def robust_outliers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", cutoff: float = CUTOFF, steps: int = STEPS) -> DataFrame:
    """doc_id, the five counts, base_failed, kept and distance (null where base_failed) of every row.

    A null text has no words and fails the base rules. Null languages and sources are groups of their
    own. Repeated rows count each. Other columns of ``docs`` are not read; an empty table gives no rows.
    """
    rows = stored(statistics(docs, id_col, text_col, lang_col, source_col), "stats")
    both, lang = F.concat(F.lit("2"), F.to_json(F.struct("lang", "source"))), F.concat(F.lit("1"), F.to_json(F.struct("lang")))
    passed = rows.where("NOT base_failed")
    judged = passed.select(*DIMS, F.explode(F.array(both, lang, F.lit("0"))).alias("grp"))
    parents = passed.select(both.alias("grp"), lang.alias("lang_grp")).distinct()
    medians = judged.groupBy("grp").agg(F.count("*").alias("rows"), *[F.percentile_approx(x, 0.5, 10000).alias(f"m{i}") for i, x in enumerate(DIMS)])
    off = _meet(judged, medians).select("grp", "rows", *[f"m{i}" for i in range(len(DIMS))], *[F.abs(F.col(x) - F.col(f"m{i}")).alias(x) for i, x in enumerate(DIMS)])
    spread = off.groupBy("grp").agg(F.first("rows").alias("rows"), *[F.first(f"m{i}").alias(f"m{i}") for i in range(len(DIMS))], *[F.percentile_approx(x, 0.5, 10000).alias(x) for x in DIMS])
    diagonal = [(1 / (F.pow(1.4826 * F.col(x), F.lit(2)) + FLOOR[i] ** 2) if i == j else F.lit(0.0)) for i, x in enumerate(DIMS) for j in range(len(DIMS))]
    fits = stored(spread.select("grp", "rows", F.array(*[F.col(f"m{i}").cast("double") for i in range(len(DIMS))]).alias("mu"), F.array(*diagonal).alias("inv")), "fit")
    pairs = [(i, j) for i in range(len(DIMS)) for j in range(i, len(DIMS))]
    for _ in range(steps):
        near = _meet(judged, fits).withColumn("bin", F.least(F.floor(64 * F.log1p(_distance())), F.lit(BINS - 1)).cast("int"))
        sums = near.groupBy("grp", "bin").agg(
            F.count("*").alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(DIMS)],
            *[F.sum(F.col(DIMS[i]) * F.col(DIMS[j])).alias(f"p{i}{j}") for i, j in pairs],
        )
        fits = stored(sums.groupBy("grp").applyInPandas(_fit, "grp string, rows long, mu array<double>, inv array<double>, cov array<double>"), "fit")
    overall = fits.where("grp = '0'").select("mu", "cov").first()
    of_lang = fits.select(F.col("grp").alias("lang_grp"), F.col("rows").alias("lang_rows"), F.col("mu").alias("lang_mu"), F.col("cov").alias("lang_cov"))
    own = fits.select("grp", "rows", "mu", "cov").join(parents, "grp").join(of_lang, "lang_grp")
    mu, cov = (list(x) for x in overall) if overall else ([], [])
    estimates = stored(own.mapInPandas(_blended(mu, cov), "grp string, mu array<double>, inv array<double>"), "fit")
    judged = _meet(rows.withColumn("grp", both), estimates).withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)).alias("kept"), "distance",
    )
