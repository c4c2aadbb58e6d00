"""Unigram lattices over a sentencepiece vocabulary: count-only Viterbi (operator 4) and sampled
segmentations with lossless decoding (operator 7).

The scores are the ones stored in the vocabulary file. A text is written as the tokenizer sees it:
spaces become U+2581 and one more stands before a text that isn't empty; a character that no piece
covers falls back to one byte piece for each of its UTF-8 bytes. pyahocorasick finds all pieces that
end at each character, the longest first.

Where no piece holds two neighbouring characters side by side, every segmentation has a border.
Lattices are made for the parts between such borders, once for each distinct part of a chunk, and the
results are put together. The nodes of all parts of a chunk are filled in by their place in the part,
first characters first, with array operations; a part of over ``LONG`` characters is gone through by
itself, node by node. The stored scores are whole numbers, so the best sums in double precision are exact
and ties are the same as in the whole text.
"""

from __future__ import annotations

import math
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import chunk_bounds, mix
from ._worker import kept, release

SPACE = "\u2581"
#: Stands for a literal U+2581 of a text when decoding has to give it back; no text holds it.
LITERAL = "\udc81"
#: Stands between parts; no text holds it.
BETWEEN = "\udc80"
_STEP = np.uint64(0xD6E8FEB86659FD93)
ALPHA = 0.0005
KNOWN = 150_000
#: Bytes of text to a chunk: more share their parts, but their arrays take more memory.
CHUNK = 1 << 20
#: Array operations go character by character, so they pay only while many parts are that long.
LONG = 1024


class Edges:
    """All matches in the distinct parts of a chunk, by the character they end at, longest first."""

    def __init__(self, vocabulary: Vocabulary, parts: list[str]):
        text = BETWEEN.join(parts) + BETWEEN
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32)
        between = np.flatnonzero(code == ord(BETWEEN))
        self.size = np.diff(between, prepend=-1) - 1
        self.first = between - self.size
        blobs = vocabulary.matches(parts)
        found = np.frombuffer(b"".join(blobs), np.int32).reshape(-1, 2)
        end = found[:, 0] + np.repeat(self.first.astype(np.int32), np.fromiter(map(len, blobs), np.int64, len(blobs)) // 8)
        piece = found[:, 1].copy()
        del blobs, found
        single = np.zeros(len(code), bool)
        single[end[vocabulary.length[piece] == 1]] = True
        single[between] = True
        alone = np.flatnonzero(~single).astype(np.int32)  # no piece for this character alone: its bytes
        codes = np.where(code[alone] == ord(LITERAL), ord(SPACE), code[alone])
        if len(alone):
            order = np.argsort(np.concatenate([end, alone]), kind="stable").astype(np.int32)
            end = np.concatenate([end, alone])[order]
            piece = np.concatenate([piece, (-1 - codes).astype(np.int32)])[order]
            del order
        self.end, self.emit = end, piece
        low, known = piece < 0, np.maximum(piece, 0)
        self.length = np.where(low, np.int32(1), vocabulary.length.astype(np.int32)[known])
        self.score = np.where(low, vocabulary.unknown, vocabulary.score[known])
        del low, known
        part = np.searchsorted(between.astype(np.int32), end).astype(np.int32)
        place = end - self.first.astype(np.int32)[part]
        self.long = np.flatnonzero(self.size > LONG)
        short = np.flatnonzero((self.size <= LONG)[part]).astype(np.int32)
        del part
        #: edges of short parts by place in their part; within a node as they are
        self.by_place = short[np.argsort(place[short].astype(np.uint16), kind="stable")]
        self.places = np.append(np.flatnonzero(np.diff(place[self.by_place], prepend=-1)), len(short))
        self.nodes = len(code) + 1
        #: the first edge that ends at each character
        self.node_first = np.concatenate(([0], np.cumsum(np.bincount(self.end, minlength=self.nodes))))

    def long_parts(self):
        """For each long part: its number, and the range of its edges, which lie in the order of their nodes."""
        for p in self.long.tolist():
            yield p, *np.searchsorted(self.end, (self.first[p], self.first[p] + self.size[p])).tolist()

    def steps(self):
        """For each place: its edges in the order of their nodes, the first edge of each node, and the
        rank of each edge in its node."""
        for lo, hi in zip(self.places[:-1], self.places[1:]):
            at = self.by_place[lo:hi]
            new = np.flatnonzero(np.diff(self.end[at], prepend=-1))
            yield at, new, np.arange(len(at)) - np.repeat(new, np.diff(np.append(new, len(at))))


class Vocabulary:
    """Pieces, scores and the automaton."""

    @classmethod
    def get(cls, path: str, keep_literal: bool = False) -> Vocabulary:
        """One for each worker process."""
        return kept(("vocabulary", path, keep_literal), lambda: cls(path, keep_literal))

    def forget(self) -> None:
        """After a task: idle workers share the executor's memory with those that work."""
        self.known = {}
        release()

    def __init__(self, path: str, keep_literal: bool = False):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.keep_literal = keep_literal
        self.automaton = ahocorasick.Automaton()
        self.byte_ids = np.zeros(256, np.int64)
        self.piece_bytes: list[bytes] = [b""] * n
        self.length, self.score = np.zeros(n, np.int64), np.zeros(n)
        lowest, self.line_border, self.space_border = 0.0, True, True
        beside = np.zeros((128, 128), bool)  # ASCII characters that some piece holds side by side
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                b = int(piece[3:5], 16)
                self.byte_ids[b] = i
                self.piece_bytes[i] = bytes([b])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.length[i], self.score[i] = len(piece), model.get_score(i)
                self.automaton.add_word(piece, i)
                self.piece_bytes[i] = piece.replace(SPACE, " ").encode()
                lowest = min(lowest, self.score[i])
                self.line_border &= "\n" not in piece
                self.space_border &= SPACE not in piece.lstrip(SPACE)
                for x, y in zip(self.piece_bytes[i], self.piece_bytes[i][1:]):
                    if x < 128 and y < 128:
                        beside[x, y] = True
        self.apart = ~beside
        self.known: dict[str, bytes] = {}
        self.automaton.make_automaton()
        self.unknown = lowest - 10.0

    def matches(self, parts: list[str]) -> list[bytes]:
        """For each part its matches as pairs of 32-bit integers, (last character, piece), in order; those
        of up to ``KNOWN`` parts are kept for the next chunk."""
        if len(self.known) > KNOWN:
            self.known = {}
        new = [x for x in parts if x not in self.known]
        if new:
            text = BETWEEN.join(new) + BETWEEN
            found = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int64).reshape(-1, 2)
            sizes = np.fromiter(map(len, new), np.int64, len(new))
            first = np.cumsum(sizes + 1) - sizes - 1
            part = np.searchsorted(first, found[:, 0], side="right") - 1
            found[:, 0] -= first[part]
            data = found.astype(np.int32).tobytes()
            at = (8 * np.concatenate(([0], np.cumsum(np.bincount(part, minlength=len(new)))))).tolist()
            self.known.update(zip(new, [data[i:j] for i, j in zip(at, at[1:])]))
        return [self.known[x] for x in parts]

    def written(self, texts: pa.Array) -> list[str]:
        """Texts as the tokenizer sees them; all at once, with a byte between that no text holds."""
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.insert(np.frombuffer(texts.buffers()[2], np.uint8)[at[0] : at[-1]], at[1:-1] - at[0], 255)
        text = data.tobytes().decode("utf-8", "surrogateescape")
        if self.keep_literal:
            text = text.replace(SPACE, LITERAL)
        return text.replace(" ", SPACE).split("\udcff")

    def parts(self, texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Distinct parts between borders: part number of each in order, the parts as written, the
        document of each, and its number within its document."""
        texts = texts.fill_null("").cast(pa.large_string())
        n = len(texts)
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
        start, at = int(at[0]), at - at[0]
        size = int(at[-1])
        if not size:
            return np.zeros(0, np.int64), [], np.zeros(0, np.int64), np.zeros(0, np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[start : start + size]
        full = np.flatnonzero(np.diff(at) > 0)
        data = np.insert(data, at[full], 32)
        first = at[full] + np.arange(len(full))
        cut = np.zeros(len(data) + 1, bool)
        left, right = data[:-1], data[1:]
        cut[1:-1] = (left < 128) & (right < 128) & self.apart[left & 127, right & 127]
        if self.space_border:  # a literal U+2581 may count as a space: no border after its last byte
            cut[1:-1] |= (right == 32) & (left != 32) & (left != 0x81)
        if self.line_border:
            line = np.flatnonzero(data == 10)
            cut[line] = cut[line + 1] = True
        cut[first] = True
        cut[-1] = True
        cuts = np.flatnonzero(cut)
        coded = pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        doc = np.searchsorted(first, cuts[:-1], side="right") - 1
        nth = np.arange(len(doc)) - np.searchsorted(doc, doc)
        return coded.indices.to_numpy().astype(np.int64), self.written(coded.dictionary), full[doc], nth


def code_bytes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of code points: their number, and four columns of which the first ones count."""
    n = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
    out = np.zeros((len(codes), 4), np.int64)
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[n]
    for k in range(4):
        shift = 6 * np.maximum(n - 1 - k, 0)
        bits = codes >> shift
        out[:, k] = np.where(k == 0, lead | bits, 0x80 | (bits & 0x3F))
    return n, out


def best_counts(vocabulary: Vocabulary, parts: list[str]) -> np.ndarray:
    """Number of ids on the best path of each part. Of equal scores the earliest start wins, as in the
    tokenizer: it goes through starts in order and takes a later one only if it scores more."""
    if not parts:
        return np.zeros(0, np.int64)
    edges = Edges(vocabulary, parts)
    ids = np.ones(len(edges.emit), np.int64)
    low = edges.emit < 0
    ids[low] = code_bytes(-1 - edges.emit[low])[0]
    score, count = np.zeros(edges.nodes), np.zeros(edges.nodes, np.int64)
    for at, new, rank in edges.steps():
        start = edges.end[at] + 1 - edges.length[at]
        value, n = score[start] + edges.score[at], count[start] + ids[at]
        node = edges.end[at[new]] + 1
        score[node], count[node] = value[new], n[new]
        for k in range(1, int(rank.max()) + 1):
            own = np.flatnonzero(rank == k)
            to = edges.end[at[own]] + 1
            better = value[own] > score[to]
            score[to[better]], count[to[better]] = value[own[better]], n[own[better]]
    for p, lo, hi in edges.long_parts():
        first, size = int(edges.first[p]), int(edges.size[p])
        best, n = [0.0] + [-math.inf] * size, [0] * (size + 1)
        ends = (edges.end[lo:hi] + 1 - first).tolist()
        for node, length, gain, more in zip(ends, edges.length[lo:hi].tolist(), edges.score[lo:hi].tolist(), ids[lo:hi].tolist()):
            value = best[node - length] + gain
            if value > best[node]:
                best[node], n[node] = value, n[node - length] + more
        count[first + size] = n[size]
    return count[edges.first + edges.size]


def _shares(edges: Edges, alpha: float) -> np.ndarray:
    """Forward filter: each edge's share of its node's forward weight, as running sums of 2^32. Sums
    go edge by edge within a node, so that they don't depend on the other parts of the chunk."""
    forward, share = np.zeros(edges.nodes), np.zeros(len(edges.end), np.uint64)
    for at, new, rank in edges.steps():
        value = forward[edges.end[at] + 1 - edges.length[at]] + alpha * edges.score[at]
        which = np.cumsum(rank == 0) - 1
        top = np.maximum.reduceat(value, new)
        weight = np.exp(value - top[which])
        total, run = np.zeros(len(new)), np.zeros(len(at))
        for k in range(int(rank.max()) + 1):
            own = np.flatnonzero(rank == k)
            total[which[own]] += weight[own]
            run[own] = total[which[own]]
        forward[edges.end[at[new]] + 1] = top + np.log(total)
        part = np.minimum(run / total[which] * 2.0**32, 2.0**32).astype(np.uint64)
        part[np.append(new[1:], len(at)) - 1] = 2**32
        share[at] = part
    for p, lo, hi in edges.long_parts():
        share[lo:hi] = _long_shares(edges, p, lo, hi, alpha)
    return share


def _long_shares(edges: Edges, p: int, lo: int, hi: int, alpha: float) -> list[int]:
    log_weight = [0.0] * (int(edges.size[p]) + 1)
    out = []
    ends = (edges.end[lo:hi] + 1 - edges.first[p]).tolist()
    lengths, scores = edges.length[lo:hi].tolist(), edges.score[lo:hi].tolist()
    i = 0
    while i < len(ends):
        node, values = ends[i], []
        while i < len(ends) and ends[i] == node:
            values.append(log_weight[node - lengths[i]] + alpha * scores[i])
            i += 1
        top, total, runs = max(values), 0.0, []
        for v in values:
            total += math.exp(v - top)
            runs.append(total)
        log_weight[node] = top + math.log(total)
        out += [min(int(r / total * 2.0**32), 2**32) for r in runs[:-1]] + [2**32]
    return out


def _long_path(edges: Edges, share: np.ndarray, p: int, lo: int, hi: int, draw: np.ndarray) -> np.ndarray:
    """The sampled edges of a long part, last one first."""
    first, size = int(edges.first[p]), int(edges.size[p])
    u = (mix(draw + np.arange(size, dtype=np.uint64) * _STEP) >> np.uint64(32)).tolist()
    begin = np.searchsorted(edges.end[lo:hi], first + np.arange(size)).tolist()
    shares, lengths = share[lo:hi].tolist(), edges.length[lo:hi].tolist()
    now, out = size - 1, []
    while now >= 0:
        edge = begin[now]
        while shares[edge] <= u[len(out)]:
            edge += 1
        out.append(lo + edge)
        now -= lengths[edge]
    return np.array(out, np.int64)


def sample(vocabulary: Vocabulary, texts: pa.Array, keys: np.ndarray, seed: int, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids of one sampled segmentation of each text (flat) and their number by text. Each draw is a hash
    of seed, row key, part and step, so it doesn't depend on how rows are dealt out."""
    which, names, doc, nth = vocabulary.parts(texts)
    if not len(which):
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    edges = Edges(vocabulary, names)
    share = _shares(edges, alpha)
    first = edges.first[which]
    now = first + edges.size[which] - 1
    draw = mix(mix(keys[doc].astype(np.int64).view(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)) + nth.astype(np.uint64))
    on = np.flatnonzero(edges.size[which] <= LONG)
    steps, taken = np.zeros(len(which), np.int64), []
    apart = {}
    for p, lo, hi in edges.long_parts():
        for k in np.flatnonzero(which == p).tolist():
            apart[k] = _long_path(edges, share, p, lo, hi, draw[k])
            steps[k] = len(apart[k])
    while len(on):
        u = mix(draw[on] + steps[on].astype(np.uint64) * _STEP) >> np.uint64(32)
        edge = edges.node_first[now[on]]
        behind = np.flatnonzero(share[edge] <= u)  # nodes have few edges; the last one's share is above all draws
        while len(behind):
            edge[behind] += 1
            behind = behind[share[edge[behind]] <= u[behind]]
        taken.append((on, edge))
        steps[on] += 1
        now[on] -= edges.length[edge]
        on = on[now[on] >= first[on]]
    ends = np.cumsum(steps)
    path = np.zeros(int(ends[-1]), np.int64)
    for k, (at, edge) in enumerate(taken):
        path[ends[at] - 1 - k] = edge
    for k, edge in apart.items():
        path[ends[k] - len(edge) : ends[k]] = edge[::-1]
    ids = edges.emit[path]
    low = np.flatnonzero(ids < 0)
    n = np.ones(len(ids), np.int64)
    n[low], raw = code_bytes(-1 - ids[low])
    at = np.cumsum(n) - n
    out = np.repeat(ids, n)
    for k in range(4):
        own = low[n[low] > k]
        out[at[own] + k] = vocabulary.byte_ids[raw[n[low] > k, k]]
    per_part = np.add.reduceat(n, ends - steps)
    return out.astype(np.int32), np.bincount(doc, per_part, len(texts)).astype(np.int64)


def decode(vocabulary: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """Texts of the id sequences; the space in front of each is taken off."""
    table = vocabulary.piece_bytes
    sizes = np.array([len(x) for x in table], np.int64)
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(table), np.uint8)
    n = sizes[ids]
    ends = np.concatenate(([0], np.cumsum(n)))
    out = data[np.repeat(starts[ids] - ends[:-1], n) + np.arange(int(ends[-1]))].tobytes()
    at = ends[np.concatenate(([0], np.cumsum(counts)))]
    return [out[i + 1 : j].decode("utf-8") if j > i else "" for i, j in zip(at[:-1].tolist(), at[1:].tolist())]


# ---------------------------------------------------------------- DataFrames


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens): number of ids of the best segmentation of every whole text. A null or empty
    text has none; a text of spaces has those of its spaces. Other columns are not read."""

    def run(batches):
        vocabulary = Vocabulary.get(model_path)
        for batch in batches:
            for lo, hi in chunk_bounds(batch.column(1), CHUNK):
                which, names, doc, _ = vocabulary.parts(batch.column(1).slice(lo, hi - lo))
                n = best_counts(vocabulary, names)
                total = np.bincount(doc, n[which], hi - lo).astype(np.int64) if len(which) else np.zeros(hi - lo, np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(total)], ["doc_id", "n_tokens"])
        vocabulary.forget()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long")


def sampled_ids(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", seed: int = 3, alpha: float = ALPHA, with_text: bool = False) -> DataFrame:
    """(doc_id, ids): one segmentation of every whole text drawn with probability proportional to
    exp(alpha x its score), forward filtering and backward sampling, seeded by the row's doc_id (a null
    id counts as -1). Equal rows get equal ids. A null or empty text has no ids. ``with_text`` adds the
    text that the ids decode to, made by the same task (:func:`decoded` does it for ids read from elsewhere)."""

    def run(batches):
        vocabulary = Vocabulary.get(model_path, keep_literal=True)
        for batch in batches:
            for lo, hi in chunk_bounds(batch.column(1), CHUNK):
                keys = batch.column(0).slice(lo, hi - lo)
                ids, n = sample(vocabulary, batch.column(1).slice(lo, hi - lo), keys.fill_null(-1).to_numpy(), seed, alpha)
                at = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
                columns, names = [keys, pa.ListArray.from_arrays(pa.array(at), pa.array(ids))], ["doc_id", "ids"]
                if with_text:
                    columns, names = [*columns, pa.array(decode(vocabulary, ids, n), pa.string())], [*names, "text"]
                yield pa.RecordBatch.from_arrays(columns, names)
        vocabulary.forget()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>" + (", text string" if with_text else ""))


def decoded(rows: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids) to (doc_id, ids, text): the text of each id sequence, byte for byte the encoded one."""

    def run(batches):
        vocabulary = Vocabulary.get(model_path, keep_literal=True)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                lists = part.column(1).fill_null([]) if part.column(1).null_count else part.column(1)
                at = lists.offsets.to_numpy()
                texts = decode(vocabulary, lists.flatten().to_numpy(), np.diff(at))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return rows.select("doc_id", F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id long, ids array<int>, text string")
