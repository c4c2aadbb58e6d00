"""MinHash near-duplicates with tensored banding (operator 9).

A document's set holds the hashes of its distinct shingles (5 lower-cased words). ``halves`` half
keys of two minhashes each are kept in two collections; every pair (one of the first, one of the
second) keys one table. So ``halves`` squared tables of four minhashes need only 4 x ``halves``
minhashes. A pair of similarity s meets in a table unless one whole collection differs: it is missed
with probability at most 2 (1 - s^2)^halves, 0.03 % at 0.85 with seven halves, and less above.

1. One pass over the texts: key of the whole word sequence, set size, half keys.
2. Equal sequences form one class; its smallest doc_id stands for it from here on.
3. In each table's buckets every member is paired with the bucket's smallest one; the pairs of
   sufficiently similar size are confirmed on full sets, and linked documents are contracted.
4. Buckets that still hold several components are compared exactly: their members are dealt to
   blocks of at most some ``BLOCK`` documents, and each pair of blocks is one small task whose
   matrix product gives all intersections; a pair is taken only in the first table it shares.
   Links are confirmed on the full sets again. Nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import stored
from ._text import Words, chunk_bounds, grams, mix, sequence_key
from ._worker import release
from .components import components

SHINGLE = 5
HALVES = 7
PER_HALF = 2
BLOCK = 1024

_SKETCH = "doc_id long, class_a long, class_b long, n_shingles long, halves array<long>"


def shingle_sets(words: Words, n: int = SHINGLE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each document its word hashes and its sorted distinct shingle hashes."""
    hashes = words.hashes(lower=True)
    runs = grams(hashes, n)
    for lo, hi in zip(words.word_at[:-1], words.word_at[1:]):
        if hi - lo >= n:
            yield hashes[lo:hi], np.unique(runs[lo : hi - n + 1])
        else:
            own = hashes[lo:hi]
            yield own, grams(own, len(own)) if len(own) else np.zeros(0, np.uint64)


def half_keys(shingles: np.ndarray, halves: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    k = 2 * halves * PER_HALF
    factor = rng.integers(1, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 2**63, k, dtype=np.uint64)
    least = np.full(k, np.uint64(2**64 - 1))
    for lo in range(0, len(shingles), 8192):
        part = shingles[lo : lo + 8192]
        least = np.minimum(least, (part[:, None] * factor + add).min(axis=0))
    least = mix(least).reshape(2 * halves, PER_HALF)
    out = least[:, 0]
    for j in range(1, PER_HALF):
        out = out * np.uint64(0x9FB21C651E98DF25) + least[:, j]
    return mix(out).view(np.int64)


def _sketches(halves: int, seed: int):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo, hi in chunk_bounds(texts):
                rows = []
                for own, shingles in shingle_sets(Words(texts.slice(lo, hi - lo))):
                    a, b = sequence_key(own)
                    rows.append((a, b, len(shingles), half_keys(shingles, halves, seed).tolist() if len(shingles) else None))
                a, b, n, keys = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo).cast(pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                    ["doc_id", "class_a", "class_b", "n_shingles", "halves"],
                )
        release()

    return run


def _sets(batches):
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for lo, hi in chunk_bounds(texts):
            blobs = [shingles.tobytes() for _, shingles in shingle_sets(Words(texts.slice(lo, hi - lo)))]
            yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo).cast(pa.int64()), pa.array(blobs, pa.binary())], ["doc", "shingles"])
    release()


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            a, b, left, right = (batch.column(k) for k in range(4))
            keep = []
            for k in range(len(a)):
                x, y = np.frombuffer(left[k].as_buffer(), np.uint64), np.frombuffer(right[k].as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], ["a", "b"])
        release()

    return run


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    with_left = pairs.join(sets.select(F.col("doc").alias("a"), F.col("shingles").alias("left")), "a")
    with_both = with_left.join(sets.select(F.col("doc").alias("b"), F.col("shingles").alias("right")), "b")
    return with_both.select("a", "b", "left", "right").mapInArrow(_confirm(percent), "a long, b long")


def _block_pairs(percent: int, halves: int):
    """Candidates between two blocks of one bucket: different components, first shared table, and
    similar enough on 32-bit shingle hashes with one percent to spare (confirmed on full sets later)."""

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
        _, low, high = key[:3]
        sets = [np.unique((np.frombuffer(x, np.uint64) >> np.uint64(32)).astype(np.uint32)) for x in frame["shingles"]]
        sizes = np.array([len(x) for x in sets])
        ids, comp, block, table = (frame[c].to_numpy() for c in ("doc", "comp", "block", "tab"))
        own = np.stack([np.asarray(x, np.int64) for x in frame["halves"]])
        rows, cols = np.flatnonzero(block == low), np.flatnonzero(block == high)
        ok = comp[rows][:, None] != comp[cols][None, :]
        if low == high:
            ok &= ids[rows][:, None] < ids[cols][None, :]
        small = np.minimum(sizes[rows][:, None], sizes[cols][None, :])
        ok &= 100 * small >= (percent - 1) * np.maximum(sizes[rows][:, None], sizes[cols][None, :])
        first = np.zeros(ok.shape, np.int64)
        for side, weight in ((own[:, :halves], halves), (own[:, halves:], 1)):
            left, right = side[rows], side[cols]
            at = np.full(ok.shape, halves, np.int64)
            for j in reversed(range(halves)):
                at[left[:, j][:, None] == right[:, j][None, :]] = j
            first += at * weight
        ok &= first == table[0]
        if not ok.any():
            return none
        _, codes = np.unique(np.concatenate(sets), return_inverse=True)
        doc = np.repeat(np.arange(len(sets)), sizes)
        both = np.zeros(ok.shape, np.float32)
        by_code = np.argsort(codes, kind="stable")
        codes, doc = codes[by_code], doc[by_code]
        row_of, col_of = np.full(len(sets), -1), np.full(len(sets), -1)
        row_of[rows], col_of[cols] = np.arange(len(rows)), np.arange(len(cols))
        for lo in range(0, int(codes[-1]) + 1, 4096):  # a band of shingles at a time bounds the matrices
            x, y = np.searchsorted(codes, [lo, lo + 4096])
            c, d = codes[x:y] - lo, doc[x:y]
            left, right = np.zeros((len(rows), 4096), np.float32), np.zeros((len(cols), 4096), np.float32)
            r, q = row_of[d], col_of[d]
            left[r[r >= 0], c[r >= 0]] = 1
            right[q[q >= 0], c[q >= 0]] = 1
            both += left @ right.T
        ok &= 100 * both >= (percent - 1) * (sizes[rows][:, None] + sizes[cols][None, :] - both)
        x, y = np.nonzero(ok)
        a, b = ids[rows[x]], ids[cols[y]]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, halves: int = HALVES, seed: int = 7) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Links join documents with 100 x intersection >= ``percent`` x union of their shingle sets; fewer
    than five words make one shingle, and a document without words (or with a null text) has an empty
    set and no links. component_id is the smallest doc_id reachable, kept says that it is the own one.
    Rows that repeat a doc_id share one component, linked through any of their texts. Rows with a null
    doc_id take no part: component_id null, kept true. Other columns of ``docs`` are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketches = stored(texts.mapInArrow(_sketches(halves, seed), _SKETCH), "sketches")
    known = sketches.where("doc_id IS NOT NULL")
    classes = stored(
        known.where("n_shingles > 0").groupBy("class_a", "class_b").agg(F.min("doc_id").alias("doc"), F.min("n_shingles").alias("n"), F.first("halves").alias("halves")),
        "classes",
    )
    first = F.slice("halves", 1, halves)
    second = F.slice("halves", halves + 1, halves)
    tables = F.flatten(F.transform(first, lambda x, i: F.transform(second, lambda y, j: F.struct((i * halves + j).cast("int").alias("tab"), F.xxhash64(i, j, x, y).alias("key")))))
    keys = classes.select("doc", "n", F.explode(tables).alias("t")).select("t.key", "t.tab", "doc", "n")
    buckets = keys.groupBy("key").agg(F.min(F.struct("doc", "n")).alias("lead"), F.count("*").alias("size")).where("size > 1")
    members = stored(keys.join(buckets, "key").select("key", "tab", "doc", "n", "size", F.col("lead.doc").alias("lead"), F.col("lead.n").alias("lead_n")), "members")
    pairs = (
        members.where("doc <> lead").where(100 * F.least("n", "lead_n") >= percent * F.greatest("n", "lead_n"))
        .select(F.col("lead").alias("a"), F.col("doc").alias("b")).distinct()
    )
    needed = members.select(F.col("doc").alias("doc_id")).distinct()
    sets = stored(texts.join(needed, "doc_id", "left_semi").mapInArrow(_sets, "doc long, shingles binary"), "sets")
    star = stored(_links(pairs, sets, percent), "links")
    merged = components(star)

    open_members = members.where("size > 2").join(merged.withColumnRenamed("node", "doc"), "doc", "left").withColumn("comp", F.coalesce("component", "doc"))
    mixed = open_members.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("key")
    blocks = F.ceil(F.col("size") / BLOCK)
    dealt = (
        open_members.join(mixed, "key", "left_semi")
        .withColumn("block", F.pmod(F.xxhash64("doc"), blocks))
        .select("key", "tab", "doc", "comp", "block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"))
        .select("key", "tab", "doc", "comp", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
        .join(classes.select("doc", "halves"), "doc")
        .join(sets, "doc")
    )
    rest = dealt.groupBy("key", "low", "high").applyInPandas(_block_pairs(percent, halves), "a long, b long").distinct()
    links = star.unionByName(_links(rest, sets, percent))
    comps = components(links)

    reps = classes.join(comps.withColumnRenamed("node", "doc"), "doc", "left").select("class_a", "class_b", F.coalesce("component", "doc").alias("component_id"))
    linked = known.where("n_shingles > 0").join(reps, ["class_a", "class_b"]).select("doc_id", "n_shingles", "component_id")
    alone = sketches.where("doc_id IS NULL OR n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
