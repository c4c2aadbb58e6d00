"""Repeated-phrase automata (operator 8): words in repeated windows are removed.

A window is ``WINDOW`` consecutive words of one document. Its words go where the same sequence also
starts in a document with a smaller id. The texts are dealt once to blocks of some ``BLOCK_BYTES``;
everything else is aggregated within its block before it moves, so a passage that a third of all
documents share costs one entry a block, not one a document.

1. Each block finds the anchors of its windows: the smallest hash among a window's ``ANCHOR``-word
   grams. Equal windows have equal anchors, and neighbours mostly share one, so a fifth of the words
   are anchors. The blocks' anchors meet by hash; those of two documents or more are recurring, and
   those of over ``BOUND`` segments hot: at the edges of a passage each document adds segments.
2. Each block cuts out the segments (runs of windows with one recurring anchor) and sends each
   distinct one, with its smallest and largest id, to a shard by its anchor. Segments of a hot anchor
   fall into their windows, which are dealt each by its own words, so no shard gets all of them.
3. A shard confirms on their actual words the windows that recur, and tells the blocks that hold a
   segment the smallest id of each of its windows (the segment itself is named by a digest, since its
   blocks have its words).
4. Each block joins confirmed windows that follow each other to passages, compiles its distinct passages
   into an Aho-Corasick automaton (pyahocorasick) and streams all its documents through it. Every match
   gives the windows that lie there; they mark the words, and the kept ones are joined by one space.
"""

from __future__ import annotations

import hashlib
import math
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import Words, chunk_bounds, grams

WINDOW = 13
ANCHOR = 5
BLOCK_BYTES = 8 << 20
BOUND = 2048
NONE = np.int64(2**63 - 1)


def single_spaced(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the words, and their bytes with one space after each."""
    lengths = words.ends - words.starts
    at = np.concatenate(([0], np.cumsum(lengths + 1)))
    out = np.full(int(at[-1]), 32, np.uint8)
    solid = np.flatnonzero(~words.blank)
    out[solid + np.repeat(at[:-1] - words.starts, lengths)] = words.data[solid]
    return at, out


class Passages:
    """Windows, segments and single-spaced words of a chunk of documents."""

    def __init__(self, texts: pa.Array, window: int, anchor: int):
        self.words = words = Words(texts)
        self.window = window
        self.at, self.bytes = single_spaced(words)
        hashes = words.hashes()
        doc = words.doc_of_word()
        n = len(hashes) - window + 1
        if n <= 0:
            self.anchors, self.first, self.last, self.doc = np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
            return
        runs = np.lib.stride_tricks.sliding_window_view(grams(hashes, anchor), window - anchor + 1)
        within = np.flatnonzero(doc[:n] == doc[window - 1 :])
        place = within + runs[within].argmin(axis=1)
        new = np.ones(len(within), bool)
        new[1:] = place[1:] != place[:-1]
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(within)) - 1 if len(begin) else begin
        self.first, self.last = within[begin], within[end]
        self.anchors = runs[self.first, place[begin] - self.first] if len(begin) else np.zeros(0, np.uint64)
        self.doc = doc[self.first]

    def split(self, hot: np.ndarray) -> np.ndarray:
        """Segments of these anchors become segments of one window each; returns which ones are such."""
        many = _member(self.anchors, hot)
        each = np.where(many, self.last - self.first + 1, 1)
        at = np.repeat(np.arange(len(each)), each)
        self.first = self.first[at] + np.arange(len(at)) - np.repeat(np.cumsum(each) - each, each)
        self.last = np.where(many[at], self.first, self.last[at])
        self.anchors, self.doc = self.anchors[at], self.doc[at]
        return many[at]

    def segments(self, which: np.ndarray) -> list[bytes]:
        """The words of these segments, each joined by one space."""
        data = self.bytes.tobytes()
        begin, end = self.at[self.first[which]], self.at[self.last[which] + self.window] - 1
        return [data[i:j] for i, j in zip(begin.tolist(), end.tolist())]


def _key(segment: bytes) -> bytes:
    return hashlib.blake2b(segment, digest_size=16).digest()


def _member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def _blob(values) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def _concat(blobs, kind) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), kind)


def _anchors(buckets: int, window: int, anchor: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table["doc_id"].to_numpy()
        texts = pa.concat_arrays(table["text"].chunks) if table["text"].num_chunks else pa.array([], pa.string())
        found, low, high, many = [], [], [], []
        for lo, hi in chunk_bounds(texts):
            p = Passages(texts.slice(lo, hi - lo), window, anchor)
            order = np.lexsort((ids[lo:hi][p.doc], p.anchors))
            a, d = p.anchors[order], ids[lo:hi][p.doc][order]
            if len(a):
                begin = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
                found.append(a[begin])
                low.append(d[begin])
                high.append(d[np.append(begin[1:], len(a)) - 1])
                many.append(np.diff(np.append(begin, len(a))))
        a = np.concatenate(found) if found else np.zeros(0, np.uint64)
        low, high, many = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (low, high, many))
        order = np.lexsort((a, a % np.uint64(buckets)))
        a, low, high, many = a[order], low[order], high[order], many[order]
        if len(a):
            begin = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
            a, low, high, many = a[begin], np.minimum.reduceat(low, begin), np.maximum.reduceat(high, begin), np.add.reduceat(many, begin)
        bucket = (a % np.uint64(buckets)).astype(np.int64)
        cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(a) else np.zeros(0, np.int64)
        to = np.append(cut[1:], len(a))
        blk = table["blk"][0].as_py()
        return pa.table(
            {
                "bucket": pa.array(bucket[cut], pa.int64()), "blk": pa.array([blk] * len(cut), pa.int64()),
                **{name: pa.array([_blob(x[i:j]) for i, j in zip(cut, to)], pa.binary()) for name, x in (("anchors", a), ("low", low), ("high", high), ("many", many.astype(np.uint32)))},
            }
        )

    return run


def _recurring(bound: int):
    def run(table: pa.Table) -> pa.Table:
        """Per block, those of its anchors that two documents or more hold, and the hot ones among them."""
        blobs = table["anchors"].to_pylist()
        a = _concat(blobs, np.uint64)
        low, high = _concat(table["low"].to_pylist(), np.int64), _concat(table["high"].to_pylist(), np.int64)
        many = _concat(table["many"].to_pylist(), np.uint32).astype(np.int64)
        owner = np.repeat(np.arange(len(blobs)), [len(x) // 8 for x in blobs])
        order = np.argsort(a, kind="stable")
        begin = np.flatnonzero(np.concatenate(([True], a[order][1:] != a[order][:-1]))) if len(a) else np.zeros(0, np.int64)
        keep, hot = np.zeros(len(a), bool), np.zeros(len(a), bool)
        if len(a):
            size = np.diff(np.append(begin, len(a)))
            keep[order] = np.repeat(np.minimum.reduceat(low[order], begin) < np.maximum.reduceat(high[order], begin), size)
            hot[order] = np.repeat(np.add.reduceat(many[order], begin) > bound, size)
        blk = table["blk"].to_pylist()
        sides = np.searchsorted(owner, np.arange(len(blk) + 1))
        out = [(blk[k], _blob(a[i:j][keep[i:j]]), _blob(a[i:j][keep[i:j] & hot[i:j]])) for k, (i, j) in enumerate(zip(sides[:-1], sides[1:]))]
        out = [x for x in out if x[1]]
        return pa.table({"blk": pa.array([x[0] for x in out], pa.int64()), "anchors": pa.array([x[1] for x in out], pa.binary()), "hot": pa.array([x[2] for x in out], pa.binary())})

    return run


def _segments(shards: int, window: int, anchor: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known = np.sort(_concat(right["anchors"].to_pylist(), np.uint64))
        hot = np.sort(_concat(right["hot"].to_pylist(), np.uint64))
        found: dict[bytes, list] = {}
        if len(known) and left.num_rows:
            left = left.combine_chunks()
            ids = left["doc_id"].to_numpy()
            texts = pa.concat_arrays(left["text"].chunks)
            for lo, hi in chunk_bounds(texts):
                p = Passages(texts.slice(lo, hi - lo), window, anchor)
                single = p.split(hot)
                flagged = np.flatnonzero(_member(p.anchors, known))
                own = ids[lo + p.doc[flagged]].tolist()
                for x, anchor_of, doc, one in zip(p.segments(flagged), p.anchors[flagged].tolist(), own, single[flagged].tolist()):
                    had = found.get(x)
                    if had is None:
                        found[x] = [anchor_of, doc, doc, one]
                    elif doc < had[1]:
                        had[1] = doc
                    elif doc > had[2]:
                        had[2] = doc
        blk = left["blk"][0].as_py() if left.num_rows else 0
        anchors = np.array([x[0] for x in found.values()], np.uint64)
        dealt = np.array([int.from_bytes(_key(segment)[:8], "little") if x[3] else x[0] for segment, x in found.items()], np.uint64)
        return pa.table(
            {
                "shard": pa.array((dealt % np.uint64(shards)).astype(np.int64), pa.int64()), "blk": pa.array([blk] * len(found), pa.int64()),
                "anchor": pa.array(anchors.view(np.int64), pa.int64()), "segment": pa.array(list(found), pa.binary()),
                "low": pa.array([x[1] for x in found.values()], pa.int64()), "high": pa.array([x[2] for x in found.values()], pa.int64()),
                "hot": pa.array([x[3] for x in found.values()], pa.bool_()),
            }
        )

    return run


def _coded(at: np.ndarray, data: np.ndarray) -> pa.DictionaryArray:
    """The words between the offsets, as numbers of distinct ones."""
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()


def _split(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Single-spaced texts as one: offsets of the words (with the space after each), bytes, words of each text."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    at = np.concatenate(([0], np.flatnonzero(data == 32) + 1))
    ends = np.searchsorted(at, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1))
    return at, data, np.diff(ends, prepend=0)


def run_names(codes: np.ndarray, window: int) -> np.ndarray:
    """A number for the run of ``window`` codes that starts at each place; equal runs, and no others, have
    equal numbers: runs of twice the length are named by the pair of names that they consist of."""
    name, length = codes.astype(np.int64), 1
    while length < window and len(name):
        step = min(length, window - length)
        pair = name[: max(len(name) - step, 0)] * (int(name.max()) + 1) + name[step:]
        name, length = np.unique(pair, return_inverse=True)[1].astype(np.int64), length + step
    return name


def _confirm(window: int):
    def run(table: pa.Table) -> pa.Table:
        """One shard: which windows recur on their actual words, and their smallest ids."""
        coded = table["segment"].combine_chunks()
        coded = (pa.concat_arrays(coded.chunks) if isinstance(coded, pa.ChunkedArray) else coded).dictionary_encode()
        which = coded.indices.to_numpy()
        low = np.full(len(coded.dictionary), NONE)
        high = np.full(len(coded.dictionary), -NONE)
        np.minimum.at(low, which, table["low"].to_numpy())
        np.maximum.at(high, which, table["high"].to_numpy())
        segments = coded.dictionary.to_pylist()
        at, data, n_words = _split(segments)
        names = run_names(_coded(at, data).indices.to_numpy(), window)
        owner = np.repeat(np.arange(len(segments)), n_words)
        begin = np.flatnonzero(owner[: len(names)] == owner[window - 1 :])
        own = owner[begin]
        distinct, which_window = np.unique(names[begin], return_inverse=True)
        least, most = np.full(len(distinct), NONE), np.full(len(distinct), -NONE)
        np.minimum.at(least, which_window, low[own])
        np.maximum.at(most, which_window, high[own])
        least[least >= most] = NONE
        told = least[which_window]
        some = np.bincount(own, told != NONE, len(segments)) > 0
        ends = 8 * np.cumsum(n_words - window + 1)
        blob = told.tobytes()
        blobs = [blob[i:j] for i, j in zip([0, *ends.tolist()], ends.tolist())]
        keys = [_key(x) if there else None for x, there in zip(segments, some.tolist())]
        rows = np.flatnonzero(some[which])
        pick = pa.array(rows, pa.int64())
        return pa.table(
            {
                "blk": table["blk"].combine_chunks().take(pick), "anchor": table["anchor"].combine_chunks().take(pick),
                "key": pa.array([keys[k] for k in which[rows]], pa.binary()), "least": pa.array([blobs[k] for k in which[rows]], pa.binary()),
                "hot": table["hot"].combine_chunks().take(pick),
            }
        )

    return run


# Letters of the automaton. A word is one to four letters, the fewer the more frequent it is; the first
# tells how many, and each place has letters of its own, so that a match begins and ends with a word. A
# node has few children then: pyahocorasick goes through them one by one.
_BETWEEN, _OTHER = 1, 2
_FIRST, _FANOUT = 64, 128


class Matcher:
    """An automaton of passages whose letters spell words."""

    def __init__(self, passages: list[bytes], window: int):
        at, data, self.n_words = _split(passages)
        coded = _coded(at, data)
        codes, self.words = coded.indices.to_numpy(), coded.dictionary
        rank = np.empty(len(self.words), np.int64)
        rank[np.argsort(-np.bincount(codes, minlength=len(self.words)), kind="stable")] = np.arange(len(self.words))
        self.size, self.letters = self._spelling(rank)
        ends = np.cumsum(self.size[codes])
        text = self._spelled(codes, self.size[codes], np.zeros(len(codes), bool))
        cuts = ends[np.cumsum(self.n_words) - 1].tolist()
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, (i, j) in enumerate(zip([0, *cuts], cuts)):
            self.automaton.add_word(text[i:j], k)
        if passages:
            self.automaton.make_automaton()

    @staticmethod
    def _spelling(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size, letters = np.zeros(len(rank), np.int64), np.zeros((len(rank), 4), np.uint32)
        base = 0
        for n in range(1, 5):
            room = _FIRST * _FANOUT ** (n - 1)
            own = np.flatnonzero((rank >= base) & (rank < base + room))
            rest = rank[own] - base
            for place in range(n - 1, 0, -1):
                letters[own, place] = 0x200 + 0x100 * place + rest % _FANOUT
                rest = rest // _FANOUT
            letters[own, 0] = 0x100 + _FIRST * (n - 1) + rest
            size[own] = n
            base += room
        return size, letters

    def _spelled(self, codes: np.ndarray, sizes: np.ndarray, opens: np.ndarray) -> str:
        """Words in letters; a code of -1 is any other word, and ``opens`` sets a border before a word."""
        total = sizes + opens
        at = np.cumsum(total) - total + opens
        out = np.full(int(total.sum()), _BETWEEN, np.uint32)
        out[at[codes < 0]] = _OTHER
        for place in range(4):
            own = np.flatnonzero((codes >= 0) & (sizes > place))
            out[at[own] + place] = self.letters[codes[own], place]
        return out.tobytes().decode("utf-32-le")

    def find(self, at: np.ndarray, data: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and number of every passage that lies in the words between the offsets; ``opens``
        marks the first word of each document."""
        if len(at) < 2 or not len(self.words):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        coded = _coded(at, data)
        known = pc.fill_null(pc.index_in(coded.dictionary, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        codes = known[coded.indices.to_numpy()]
        sizes = np.where(codes < 0, 1, self.size[codes])
        text = self._spelled(codes, sizes, opens)
        found = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int64).reshape(-1, 2)
        word = np.repeat(np.arange(len(codes)), sizes + opens)[found[:, 0]]
        return word - self.n_words[found[:, 1]] + 1, found[:, 1]


def _mark(window: int, anchor: int):
    def passages(left_ids, texts, told, known, hot) -> dict[bytes, np.ndarray]:
        """The block's distinct passages, and the smallest id of each of their windows."""
        out: dict[bytes, np.ndarray] = {}
        for lo, hi in chunk_bounds(texts):
            p = Passages(texts.slice(lo, hi - lo), window, anchor)
            p.split(hot)
            flagged = np.flatnonzero(_member(p.anchors, known))
            if not len(flagged):
                continue
            blobs = [told.get(_key(x)) for x in p.segments(flagged)]
            flagged = flagged[np.array([x is not None for x in blobs], bool)]
            runs = p.last[flagged] - p.first[flagged] + 1
            ends = np.cumsum(runs)
            least = np.full(len(p.words.starts) + 1, NONE)
            if len(flagged):
                least[np.repeat(p.first[flagged] - (ends - runs), runs) + np.arange(int(ends[-1]))] = _concat([x for x in blobs if x is not None], np.int64)
            at = np.flatnonzero(least != NONE)
            doc = p.words.doc_of_word()[at]
            new = np.ones(len(at), bool)
            new[1:] = (np.diff(at) > 1) | (np.diff(doc) > 0)
            begin = np.flatnonzero(new)
            to = np.append(begin[1:], len(at)) - 1 if len(begin) else begin
            data = p.bytes.tobytes()
            first, last = at[begin], at[to] + window
            for i, j, a, b in zip(p.at[first].tolist(), (p.at[last] - 1).tolist(), first.tolist(), (last - window + 1).tolist()):
                x = data[i:j]
                if x not in out:
                    out[x] = least[a:b].copy()
        return out

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        n_words, n_removed, kept = [], [], []
        if left.num_rows:
            told = dict(zip(right["key"].to_pylist(), right["least"].to_pylist()))
            anchors = right["anchor"].to_numpy().astype(np.int64).view(np.uint64) if right.num_rows else np.zeros(0, np.uint64)
            hot = np.unique(anchors[np.array(right["hot"].to_pylist(), bool)])
            left = left.combine_chunks()
            ids = left["doc_id"].to_numpy()
            texts = pa.concat_arrays(left["text"].chunks)
            found = passages(ids, texts, told, np.unique(anchors), hot) if told else {}
            matcher = Matcher(list(found), window)
            least = np.concatenate([*found.values(), np.zeros(0, np.int64)])
            windows = matcher.n_words - window + 1
            least_at = np.cumsum(windows) - windows
            del told, found
            for lo, hi in chunk_bounds(texts):
                words = Words(texts.slice(lo, hi - lo))
                at, data = single_spaced(words)
                n, size = len(words.starts), np.diff(at)
                opens = np.zeros(n, bool)
                opens[words.word_at[:-1][np.diff(words.word_at) > 0]] = True
                begin, k = matcher.find(at, data, opens)
                many = windows[k]
                ends = np.cumsum(many)
                total = int(ends[-1]) if len(ends) else 0
                place = np.arange(total)
                window_at = np.repeat(begin - (ends - many), many) + place
                hit = window_at[least[np.repeat(least_at[k] - (ends - many), many) + place] < ids[lo:hi][words.doc_of_word()][window_at]]
                edge = np.bincount(hit, minlength=n + window + 1) - np.bincount(hit + window, minlength=n + window + 1)
                gone = np.cumsum(edge)[:n] > 0
                stays = data[np.repeat(~gone, size)] if gone.any() else data
                words_to = np.concatenate(([0], np.cumsum(gone)))
                bytes_to = np.concatenate(([0], np.cumsum(np.where(gone, 0, size))))
                for i, j in zip(words.word_at[:-1], words.word_at[1:]):
                    n_words.append(j - i)
                    n_removed.append(words_to[j] - words_to[i])
                    kept.append(stays[bytes_to[i] : max(bytes_to[i], bytes_to[j] - 1)].tobytes())
        return pa.table(
            {
                "doc_id": pa.array(left["doc_id"].to_numpy() if left.num_rows else [], pa.int64()),
                "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(kept, pa.binary()),
            }
        )

    return run


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR, block_bytes: int = BLOCK_BYTES, bound: int = BOUND) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of ``docs``; kept holds the words that stay,
    joined by one space.

    Windows are judged on the input. A null text has no words; fewer than ``window`` words are never
    removed. Rows that repeat a doc_id are one document: they do not remove each other's words. Rows
    with a null doc_id come after all others: they lose what any document with an id holds and take
    nothing from anyone. Other columns of ``docs`` are not read; an empty table gives no rows.
    """
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(int(NONE) - 1)).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    buckets = max(1, math.ceil(size / (2 * block_bytes)))
    shards = max(1, math.ceil(2 * size / block_bytes))
    dealt = texts.withColumn("blk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks).cast("long")))
    by_block = dealt.groupBy("blk")
    anchors = by_block.applyInArrow(_anchors(buckets, window, anchor), "bucket long, blk long, anchors binary, low binary, high binary, many binary")
    recurring = anchors.groupBy("bucket").applyInArrow(_recurring(bound), "blk long, anchors binary, hot binary")
    segments = by_block.cogroup(recurring.groupBy("blk")).applyInArrow(_segments(shards, window, anchor), "shard long, blk long, anchor long, segment binary, low long, high long, hot boolean")
    places = segments.groupBy("shard").applyInArrow(_confirm(window), "blk long, anchor long, key binary, least binary, hot boolean")
    out = by_block.cogroup(places.groupBy("blk")).applyInArrow(_mark(window, anchor), "doc_id long, n_words long, n_removed long, kept binary")
    return out.select(F.nullif("doc_id", F.lit(int(NONE) - 1)).alias("doc_id"), "n_words", "n_removed", F.col("kept").cast("string").alias("kept"))
