"""Ranked lexical search, hybrid term-at-a-time and document-at-a-time (operator 11).

One pass over the documents writes an inverted index of the terms that the items hold: a row a shard
of documents, with the shard's posting lists and the length of each document. Counts over all documents
(documents, terms, documents of a term) are Spark aggregates over it. Then every shard is searched for
every item:

* the item's short lists are summed term at a time into accumulators, which from there on are one
  sorted list of (document, sum) with a largest sum: one bounded iterator;
* this and the long lists are walked document at a time, a window of documents a step: a list whose
  largest contribution, with those of all lists below it, stays under the k-th best score so far is
  no longer walked but probed by binary search, and only for documents that can still reach that score.

Scores are whole numbers, bounds are exact, and a document is passed over only if it stays strictly under the
k-th best, so the results are those of a full evaluation. A task keeps the k best of each item from shard to
shard; the k best of all tasks are ranked by Spark.

Items are dealt to blocks (by rows and bytes), each searched against all documents: a block's terms are what is sent to the
tasks, so its size is bounded whatever the number of items.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._tables import shared_path, stored
from ._text import _BASE, _RNG, chunk_bounds, mix, powers

TOP = 10
#: rows and bytes of text of a block of items
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 16 << 20
#: a shard holds so many documents or bytes of text, or one document
SHARD_DOCS, SHARD_BYTES = 8192, 8 << 20
#: a list is short if it holds less than this part of the shard's documents
SHORT = 1 / 16
#: documents of a window
WINDOW = 1024

_TERM = np.zeros(256, bool)
_TERM[ord("0") : ord("9") + 1] = _TERM[ord("A") : ord("Z") + 1] = _TERM[ord("a") : ord("z") + 1] = True
_TERM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_VALUES = _RNG.integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUES[:, ord("A") : ord("Z") + 1] = _VALUES[:, ord("a") : ord("z") + 1]
_BASES = (_BASE, np.uint64(0xC2B2AE3D27D4EB4F))


class Terms:
    """The terms of a chunk of texts: maximal runs of ASCII letters, digits and all characters beyond
    ASCII, within one text; null counts as empty."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string()).fill_null("")
        n = len(texts)
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
        size = int(at[-1] - at[0])
        self.data = np.frombuffer(texts.buffers()[2], np.uint8)[at[0] : at[-1]] if size else np.zeros(0, np.uint8)
        at = at - at[0]
        self.inside = _TERM[self.data]
        edge = np.ones(size + 1, bool)
        edge[1:-1] = ~self.inside[:-1]
        edge[at] = True
        self.starts = np.flatnonzero(edge[:-1] & self.inside)
        edge[:-1] |= ~self.inside
        self.ends = np.flatnonzero(self.inside & edge[1:]) + 1
        term_at = np.searchsorted(self.starts, at)
        self.counts = np.diff(term_at)
        self.doc = np.repeat(np.arange(n), self.counts)

    def keys(self) -> np.ndarray:
        """128 bits a term, A-Z as a-z, as two columns."""
        if not len(self.starts):
            return np.zeros((0, 2), np.uint64)
        lengths = self.ends - self.starts
        at = np.zeros(len(self.data), np.int64)
        at[self.starts] = self.starts
        np.maximum.accumulate(at, out=at)
        at = np.arange(len(self.data)) - at
        at[~self.inside] = 0
        out = np.empty((len(lengths), 2), np.uint64)
        for k in range(2):
            value = _VALUES[k][self.data] * powers(_BASES[k], int(lengths.max()))[at]
            value[~self.inside] = 0
            out[:, k] = mix(np.add.reduceat(value, self.starts) + lengths.astype(np.uint64))
        return out


def _term_rows(batches):
    for batch in batches:
        for lo, hi in chunk_bounds(batch.column(1)):
            terms = Terms(batch.column(1).slice(lo, hi - lo))
            text = _LOWER[terms.data].tobytes()
            words = [text[a:b].decode("utf-8", "replace") for a, b in zip(terms.starts.tolist(), terms.ends.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).take(pa.array(terms.doc)), pa.array(words, pa.string())], ["item", "term"])


class Vocabulary:
    """The distinct terms of a block of items, found by their 128-bit keys."""

    def __init__(self, words: list[str]):
        keys = Terms(pa.array(words, pa.large_string())).keys()
        self.order = np.lexsort((keys[:, 1], keys[:, 0])) if len(words) else np.zeros(0, np.int64)
        self.high, self.low = keys[self.order, 0], keys[self.order, 1]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each term, -1 where it is not one of the items'."""
        if not len(self.order) or not len(keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.high, keys[:, 0]), len(self.high) - 1)
        hit = (self.high[at] == keys[:, 0]) & (self.low[at] == keys[:, 1])
        return np.where(hit, self.order[at], -1)


INDEX = "doc_ids array<long>, lengths array<long>, terms array<int>, starts array<long>, docs array<int>, tfs array<int>"


def _shard(ids: list[pa.Array], lengths: list[np.ndarray], terms: list[np.ndarray], docs: list[np.ndarray], tfs: list[np.ndarray]) -> pa.RecordBatch:
    term, doc, tf = np.concatenate(terms), np.concatenate(docs), np.concatenate(tfs)
    order = np.lexsort((doc, term))
    names, starts = np.unique(term[order], return_index=True)
    values = [pa.concat_arrays(ids), np.concatenate(lengths), names.astype(np.int32), np.append(starts, len(term)).astype(np.int64), doc[order].astype(np.int32), tf[order].astype(np.int32)]
    columns = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v if isinstance(v, pa.Array) else pa.array(v)) for v in values]
    return pa.RecordBatch.from_arrays(columns, ["doc_ids", "lengths", "terms", "starts", "docs", "tfs"])


def _indexer(words: list[str], shard_docs: int, shard_bytes: int):
    def run(batches):
        vocabulary, held, n, size = Vocabulary(words), ([], [], [], [], []), 0, 0
        for batch in batches:
            for lo, hi in chunk_bounds(batch.column(1)):
                terms = Terms(batch.column(1).slice(lo, hi - lo))
                found = vocabulary.find(terms.keys())
                at = np.flatnonzero(found >= 0)
                span = hi - lo
                pairs, tf = np.unique(found[at] * span + terms.doc[at], return_counts=True)
                for column, value in zip(held, (batch.column(0).slice(lo, span).cast(pa.int64()), terms.counts, pairs // span, pairs % span + n, tf)):
                    column.append(value)
                n, size = n + span, size + len(terms.data)
                if n >= shard_docs or size >= shard_bytes:
                    yield _shard(*held)
                    held, n, size = ([], [], [], [], []), 0, 0
        if n:
            yield _shard(*held)

    return run


class Best:
    """The k best (score, id) of an item; equal scores by ascending id, a null id last."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def floor(self) -> int:
        """A document needs this score at least."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        scores, ids, null = np.append(self.scores, scores), np.append(self.ids, ids), np.append(self.null, null)
        order = np.lexsort((ids, null, -scores))[: self.k]
        self.scores, self.ids, self.null = scores[order], ids[order], null[order]


class Shard:
    """The posting lists of one shard, each with the contributions of its documents."""

    def __init__(self, doc_ids: pa.Array, lengths, terms, starts, docs, tfs, weights: np.ndarray, n_docs: int, n_terms: int):
        self.null = np.asarray(doc_ids.is_null())
        self.ids = doc_ids.fill_null(0).to_numpy(zero_copy_only=False)
        m = 100 - 90 + (90 * lengths * n_docs) // max(n_terms, 1)
        self.docs = docs
        gain = (1_000_000_000 * tfs.astype(np.int64)) // (1000 * tfs.astype(np.int64) + 8 * m[docs])
        self.gain = gain * np.repeat(weights[terms], np.diff(starts))
        self.most = np.maximum.reduceat(self.gain, starts[:-1]) if len(terms) else np.zeros(0, np.int64)
        self.starts = starts
        self.at = {t: i for i, t in enumerate(terms.tolist())}

    def search(self, terms: list[int], best: Best, short: float = SHORT, window: int = WINDOW) -> int:
        """Adds the shard's best documents to ``best``; returns how many postings were touched."""
        lists = [self.at[t] for t in terms if t in self.at]
        if not lists:
            return 0
        spans = [(int(self.starts[i]), int(self.starts[i + 1])) for i in lists]
        limit = len(self.ids) * short
        brief = [s for s in spans if s[1] - s[0] <= limit]
        touched = sum(b - a for a, b in brief)
        # term at a time: the short lists become one list of (document, sum)
        if brief:
            found, which = np.unique(np.concatenate([self.docs[a:b] for a, b in brief]), return_inverse=True)
            sums = np.zeros(len(found), np.int64)
            np.add.at(sums, which, np.concatenate([self.gain[a:b] for a, b in brief]))
            iterators = [(int(sums.max()), found, sums)]
        else:
            iterators = []
        for i, (a, b) in zip(lists, spans):
            if b - a > limit:
                iterators.append((int(self.most[i]), self.docs[a:b], self.gain[a:b]))
        # document at a time: lists by bound; below[j] is what the lists up to j can give together
        iterators.sort(key=lambda x: x[0])
        below = np.cumsum([x[0] for x in iterators])
        for lo in range(0, len(self.ids), window):
            floor = best.floor
            first = int(np.searchsorted(below, floor))  # lists before it alone can't reach the floor
            if first == len(iterators):
                return touched
            docs, gains = [], []
            for _, d, g in iterators[first:]:
                a, b = np.searchsorted(d, (lo, lo + window))
                docs.append(d[a:b])
                gains.append(g[a:b])
                touched += int(b - a)
            docs = np.concatenate(docs)
            if not len(docs):
                continue
            scores = np.zeros(window, np.int64)
            np.add.at(scores, docs - lo, np.concatenate(gains))
            there = np.flatnonzero(scores)
            scores, docs = scores[there], there + lo
            for j in range(first - 1, -1, -1):
                able = scores + below[j] >= floor
                docs, scores = docs[able], scores[able]
                if not len(docs):
                    break
                d, g = iterators[j][1:]
                at = np.minimum(np.searchsorted(d, docs), len(d) - 1)
                touched += len(docs)
                scores = scores + np.where(d[at] == docs, g[at], 0)
            keep = scores >= floor
            if keep.any():
                best.add(scores[keep], self.ids[docs[keep]], self.null[docs[keep]])
        return touched


def _searcher(items: list[list[int]], weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    def run(batches):
        best = [Best(k) for _ in items]
        for batch in batches:
            for r in range(batch.num_rows):
                columns = [batch.column(c)[r].values for c in range(batch.num_columns)]
                shard = Shard(columns[0], *[c.to_numpy(zero_copy_only=False) for c in columns[1:]], weights, n_docs, n_terms)
                for terms, b in zip(items, best):
                    shard.search(terms, b)
        item = np.repeat(np.arange(len(items)), [len(b.scores) for b in best])
        ids = pa.array(np.concatenate([b.ids for b in best]), mask=np.concatenate([b.null for b in best]))
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), ids, pa.array(np.concatenate([b.scores for b in best]))], ["item", "doc_id", "score"])

    return run


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _block(docs: DataFrame, terms: DataFrame, top: int, shard_docs: int, shard_bytes: int) -> DataFrame:
    spark = docs.sparkSession
    rows = terms.groupBy("item").agg(F.collect_set("term").alias("terms")).toArrow()
    numbers: dict[str, int] = {}
    items = [[numbers.setdefault(t, len(numbers)) for t in x] for x in rows.column("terms").to_pylist()]
    names = rows.column("item")
    index = stored(docs.mapInArrow(_indexer(list(numbers), shard_docs, shard_bytes), INDEX), "lexical-index")
    totals = index.select(F.size(F.filter("lengths", lambda x: x > 0)).alias("n"), F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("l"))
    n_docs, n_terms = totals.agg(F.sum("n"), F.sum("l")).first()
    held = index.select(F.posexplode("terms").alias("i", "term"), "starts").select("term", (F.col("starts")[F.col("i") + 1] - F.col("starts")[F.col("i")]).alias("df"))
    weights = np.zeros(len(numbers), np.int64)
    for r in held.groupBy("term").agg(F.sum("df").alias("df")).toArrow().to_pylist():  # one row a term of the block
        weights[r["term"]] = weight(n_docs, r["df"])
    found = index.mapInArrow(_searcher(items, weights, n_docs or 0, n_terms or 0, top), "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    ids = spark.createDataFrame(pa.table({"item": pa.array(range(len(names)), pa.int64()), "item_id": names}))
    return ranked.join(ids, "item").select("item_id", "rank", "doc_id", "score")


def lexical_search(
    docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES, shard_docs: int = SHARD_DOCS, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The ``top`` documents of each item: item_id, rank (from 1), doc_id, score; score above 0, equal
    scores by ascending doc_id.

    With N documents that hold a term, L terms in all, n in a document, df documents of a term and tf
    occurrences in the document, a term's weight w is floor(1000 ln((2N+2)/(2df+1))), m is
    10 + 90 n N div L, and the score sums w ((10^9 tf) div (1000 tf + 8 m)) over the item's distinct terms.

    Null and empty texts hold no term. Every row is a document, repeated and null ids included (null ids
    last among equal scores, repeated ones in any order). Rows of one item_id are one item with the terms
    of all. Other columns are not read; an empty table on either side gives no rows."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text"))
    n, size = asked.agg(F.countDistinct(F.struct("item")), F.sum(F.octet_length("text"))).first()
    blocks = max(1, math.ceil(n / block_items), math.ceil((size or 0) / block_bytes))
    ddl = f"item {asked.schema['item'].dataType.simpleString()}, term string"
    terms = asked.mapInArrow(_term_rows, ddl).distinct().withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    out = None
    if blocks > 1:
        place = shared_path(spark, "lexical-terms")
        terms.write.partitionBy("block").parquet(place)
        terms = spark.read.schema(terms.schema).parquet(place)
    for b in range(blocks):
        part = _block(texts, terms.where(F.col("block") == b).drop("block"), top, shard_docs, shard_bytes)
        part = stored(part, "lexical-found") if blocks > 1 else part
        out = part if out is None else out.unionByName(part)
    return out
