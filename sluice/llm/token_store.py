"""Token-ID files with a minimal perfect hash index (operator 2).

``write_ids`` deals the documents to shards by ranges of doc_id, sorts each shard and writes its ids,
each document followed by the end id, as a raw little-endian payload (16 bits an id where the
vocabulary allows, else 32) into the shared folder. An attempt writes a file of its own name and
returns one row a document; only files named by the committed rows count, so that a lost or repeated
task leaves nothing wrong. ``build_index`` deals the keys to parts by hash and stores for each part a
minimal perfect hash with, slot by slot, a fingerprint of the key, the shard, offset and length.
``find`` answers keys in constant time each; ``read_ids`` reads the payloads found.

File systems are opened with pyarrow.fs by the URI of the shared folder.
"""

from __future__ import annotations

import math
import os
import uuid
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._tables import shared_path, stored
from ._text import chunk_bounds, mix
from ._worker import kept

SHARD_BYTES = 32 << 20
PART_KEYS = 20_000
END_ID = 0
CACHE_WORDS = 600_000
GAMMA = 2.0


def open_fs(uri: str):
    from pyarrow import fs

    return (fs.LocalFileSystem(), uri) if "://" not in uri and not uri.startswith("file:") else fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


class Encoder:
    """Ids of whole texts. A text is cut where the byte-level pattern always begins a token: before a
    single space or line feed between visible characters, after such a line feed, and between an ASCII
    letter and a mark. The pieces are encoded once for each distinct one. Bytes that could be part of
    other white space are never cut at."""

    @classmethod
    def get(cls, path: str) -> Encoder:
        """One encoder for each worker process: what it has looked up serves later tasks."""
        return kept(("encoder", path), lambda: cls(path))

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = 2 if size <= 1 << 16 else 4
        #: bytes of each token: byte-level tokens are written with one character a byte
        self.bytes_of = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        self.known: dict[bytes, bytes] = {}

    def _learn(self, new: list[bytes]) -> None:
        """Pieces that begin and end with a visible character are encoded together: those with a space
        before as they are, others with line feeds between; tokens fall apart there as they do in texts."""
        encode, known = self.tokenizer.encode_batch_fast, self.known
        spaced, bare, rest = [], [], []
        for x in new:
            first, last = x[x[0] == 32 and len(x) > 1], x[-1]
            ends_visible = 33 <= last <= 126 or (128 <= last <= 191 and 0xC3 <= x[-2] <= 0xDF)
            if ends_visible and (33 <= first <= 126 or 0xC3 <= first <= 0xDF):
                (spaced if x[0] == 32 else bare).append(x)
            else:
                rest.append(x)
        for pieces, between in ((spaced, b""), (bare, b"\n")):
            for lo in range(0, len(pieces), 65536):
                part = pieces[lo : lo + 65536]
                texts = [between.join([*part[i : i + 512], b""]).decode() for i in range(0, len(part), 512)]
                ids = np.concatenate([np.array(e.ids, np.uint32) for e in encode(texts, add_special_tokens=False)])
                ends = np.cumsum(self.bytes_of[ids])
                lengths = np.fromiter(map(len, part), np.int64, len(part))
                at = np.cumsum(lengths + len(between)) - len(between)
                upto = 4 * (np.searchsorted(ends, at) + 1)
                since = 4 * np.searchsorted(ends, at - lengths, side="right")
                data = ids.tobytes()
                known.update(zip(part, [data[i:j] for i, j in zip(since.tolist(), upto.tolist())]))
        for lo in range(0, len(rest), 4096):
            part = rest[lo : lo + 4096]
            known.update(zip(part, [np.array(e.ids, np.uint32).tobytes() for e in encode([x.decode() for x in part], add_special_tokens=False)]))

    @staticmethod
    def _names(pieces: pa.Array) -> list[bytes]:
        at = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1].tolist()
        data = pieces.buffers()[2].to_pybytes()
        return [data[i:j] for i, j in zip(at, at[1:])]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and the number of ids of each text."""
        texts = texts.fill_null("").cast(pa.large_string())
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        size = int(at[-1] - at[0])
        if not size:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[at[0] : at[-1]]
        at = at - at[0]
        wide = (data >= 0xC3) & (data <= 0xDF)
        plain = (data >= 0x21) & (data <= 0x7E)
        letter = ((data | 32) >= 97) & ((data | 32) <= 122)
        before, after = plain.copy(), plain | wide
        before[1:] |= (data[1:] >= 0x80) & (data[1:] <= 0xBF) & wide[:-1]
        line = data == 10
        lone = np.zeros(size, bool)  # a space or line feed between two visible characters
        lone[1:-1] = ((data == 32) | line)[1:-1] & before[:-2] & after[2:]
        cut = np.zeros(size + 1, bool)
        cut[:-1] = lone
        cut[1:] |= lone & line
        cut[1:-1] |= np.isin(data[1:], np.frombuffer(b",.;:!?", np.uint8)) & letter[:-1]
        cut[at] = True
        cuts = np.flatnonzero(cut)
        pieces = pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        pieces = pieces.dictionary_encode()
        names, which = self._names(pieces.dictionary), pieces.indices.to_numpy()
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        known = self.known
        self._learn([x for x in names if x not in known])
        ids = [known[x] for x in names]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.uint32)
        first = np.cumsum(lengths) - lengths
        n = lengths[which]
        ends = np.cumsum(n)
        out = flat[np.repeat(first[which] - (ends - n), n) + np.arange(int(ends[-1]))]
        total = np.concatenate(([0], ends))
        doc = np.searchsorted(cuts[:-1], at)
        return out, total[doc[1:]] - total[doc[:-1]]


def _write(base: str, path: str, end_id: int):
    def run(batches):
        from pyarrow import fs

        encoder, out, at, last, seen = Encoder.get(path), None, 0, None, 0
        shard = TaskContext.get().partitionId()
        name = f"{base}/shard-{shard:06d}-{uuid.uuid4().hex[:12]}.ids"
        kind = "<u2" if encoder.width == 2 else "<u4"
        try:
            for batch in batches:
                for lo, hi in chunk_bounds(batch.column(1)):
                    if out is None:
                        files, place = open_fs(name)
                        if isinstance(files, fs.LocalFileSystem):
                            files.create_dir(os.path.dirname(place), recursive=True)
                        out = files.open_output_stream(place)
                    ids, n = encoder.encode(batch.column(1).slice(lo, hi - lo))
                    ids = np.insert(ids, np.cumsum(n), end_id)
                    n = n + 1
                    out.write(ids.astype(kind).tobytes())
                    keys = batch.column(0).slice(lo, hi - lo)
                    nth = []
                    for key in keys.to_pylist():
                        seen = seen + 1 if nth_of(last, key) else 0
                        last = (key,)
                        nth.append(seen)
                    places = at + np.cumsum(n) - n
                    at += int(n.sum())
                    size = hi - lo
                    yield pa.RecordBatch.from_arrays(
                        [keys.cast(pa.int64()), pa.array(nth, pa.int64()), pa.array([shard] * size, pa.int32()), pa.array([name] * size), pa.array(places, pa.int64()), pa.array(n, pa.int64()), pa.array([encoder.width] * size, pa.int32())],
                        ["doc_id", "nth", "shard", "path", "at", "n_tokens", "width"],
                    )
        finally:
            if out is not None:
                out.close()

    return run


def nth_of(last, key) -> bool:
    """Whether the row before has the same key."""
    return last is not None and last[0] == key


def write_ids(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, end_id: int = END_ID) -> DataFrame:
    """Write the shards; one row a document, in files by ascending doc_id: doc_id, nth (0, 1, ... among
    rows of one doc_id), shard, path, at (ids before it in the file), n_tokens (with the end id), width.

    A null text is empty and has the end id alone. Null ids come first. Rows that repeat a doc_id are
    ordered by the hash of their text. Other columns are not read; an empty table writes no file."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    base = shared_path(docs.sparkSession, "ids")
    dealt = rows.repartitionByRange(max(1, math.ceil(size / shard_bytes)), "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    written = dealt.mapInArrow(_write(base, tokenizer_path, end_id), "doc_id long, nth long, shard int, path string, at long, n_tokens long, width int")
    return stored(written, "id-rows")


def shard_starts(written: DataFrame) -> DataFrame:
    """One row a shard: shard, path, width, shard_start (ids in all shards before it)."""
    sums = written.groupBy("shard", "path", "width").agg(F.sum("n_tokens").alias("n"))
    return sums.select("shard", "path", "width", (F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("shard_start"))


# ---------------------------------------------------------------- minimal perfect hash


def key_hashes(keys: np.ndarray, null: np.ndarray, nth: np.ndarray) -> np.ndarray:
    return mix(mix(keys.astype(np.int64).view(np.uint64)) + nth.astype(np.uint64) * np.uint64(2) + null.astype(np.uint64))


class PerfectHash:
    """Bit arrays level by level: a key sits in the first level where it met no other key; its slot is
    the number of set bits before it, read from a count a 64-bit word."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        counts = [np.bitwise_count(x).astype(np.int64) for x in levels]
        self.before, n = [], 0
        for c in counts:
            self.before.append(n + np.cumsum(c) - c)
            n += int(c.sum())
        self.size = n

    @staticmethod
    def _place(hashes: np.ndarray, level: int, words: int) -> np.ndarray:
        return mix(hashes + np.uint64((level * 0x9E3779B97F4A7C15) % 2**64)) % np.uint64(64 * words)

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        """``hashes`` must be distinct."""
        levels = []
        while len(hashes):
            words = max(1, math.ceil(GAMMA * len(hashes) / 64))
            at = cls._place(hashes, len(levels), words)
            met = np.bincount(at.astype(np.int64), minlength=64 * words)
            alone = met[at.astype(np.int64)] == 1
            levels.append(np.packbits(met == 1, bitorder="little").view("<u8"))
            hashes = hashes[~alone]
        return cls(levels)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where no level has its bit."""
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for k, bits in enumerate(self.levels):
            at = self._place(hashes[open_], k, len(bits)).astype(np.int64)
            word, bit = bits[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[open_[hit]] = (self.before[k][at >> 6] + below)[hit]
            open_ = open_[~hit]
        return out


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32)


def _frame_hashes(frame: pd.DataFrame) -> np.ndarray:
    null = frame["doc_id"].isna().to_numpy()
    return key_hashes(frame["doc_id"].astype("Int64").fillna(0).to_numpy(np.int64), null, frame["nth"].to_numpy(np.int64))


def _build(key, frame: pd.DataFrame) -> pd.DataFrame:
    hashes = _frame_hashes(frame)
    perfect = PerfectHash.build(hashes)
    slot = perfect.slots(hashes)
    order = np.argsort(slot)
    blob = lambda x, kind: np.ascontiguousarray(x[order].astype(kind)).tobytes()
    return pd.DataFrame(
        {
            "part": [key[0]], "levels": [[x.tobytes() for x in perfect.levels]], "prints": [blob(fingerprints(hashes), "<u4")],
            "shards": [blob(frame["shard"].to_numpy(), "<i4")], "ats": [blob(frame["at"].to_numpy(), "<i8")], "sizes": [blob(frame["n_tokens"].to_numpy(), "<i8")],
        }
    )


def _part(parts: int):
    return F.pmod(F.xxhash64("doc_id", "nth"), F.lit(parts).cast("long"))


def build_index(written: DataFrame, part_keys: int = PART_KEYS) -> tuple[DataFrame, int]:
    """The stored index (one row a part) and its number of parts."""
    parts = max(1, math.ceil(written.count() / part_keys))
    rows = written.select("doc_id", "nth", "shard", "at", "n_tokens").withColumn("part", _part(parts))
    built = rows.groupBy("part").applyInPandas(_build, "part long, levels array<binary>, prints binary, shards binary, ats binary, sizes binary")
    return stored(built, "id-index"), parts


def _find(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    none = pd.DataFrame({"doc_id": pd.Series(dtype="Int64"), "nth": pd.Series(dtype="int64"), "shard": pd.Series(dtype="int32"), "at": pd.Series(dtype="int64"), "n_tokens": pd.Series(dtype="int64")})
    if not len(left) or not len(right):
        return none
    row = right.iloc[0]
    perfect = PerfectHash([np.frombuffer(x, "<u8") for x in row["levels"]])
    hashes = _frame_hashes(left)
    slot = perfect.slots(hashes)
    hit = slot >= 0
    hit[hit] = np.frombuffer(row["prints"], "<u4")[slot[hit]] == fingerprints(hashes[hit])
    slot = slot[hit]
    found = left.loc[hit, ["doc_id", "nth"]].reset_index(drop=True).astype({"doc_id": "Int64"})
    for name, blob, kind in (("shard", "shards", "<i4"), ("at", "ats", "<i8"), ("n_tokens", "sizes", "<i8")):
        found[name] = np.frombuffer(row[blob], kind)[slot]
    return found


def find(keys: DataFrame, index: DataFrame, parts: int) -> DataFrame:
    """Keys (doc_id, nth) that the index holds, with shard, at and n_tokens; others give no row (a key
    that was never indexed passes the fingerprint once in four thousand million times)."""
    asked = keys.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("nth").cast("long").alias("nth")).withColumn("part", _part(parts))
    return asked.groupBy("part").cogroup(index.groupBy("part")).applyInPandas(_find, "doc_id long, nth long, shard int, at long, n_tokens long")


def read_ids(places: DataFrame, shards: DataFrame, digest: Callable[[np.ndarray], int | list], kind: str, name: str) -> DataFrame:
    """``places`` (from ``find``) with shard_start and one more column: ``digest`` of the ids read."""
    arrow = {"long": pa.int64(), "array<long>": pa.list_(pa.int64())}[kind]

    def run(batches):
        path, source = None, None
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in (2, 3, 4, 5)]
            values = []
            for where, width, at, n in zip(*columns):
                if where != path:
                    if source is not None:
                        source.close()
                    files, place = open_fs(where)
                    path, source = where, files.open_input_file(place)
                values.append(digest(np.frombuffer(source.read_at(n * width, at * width), "<u2" if width == 2 else "<u4")))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in (0, 1, 4, 5, 6)), pa.array(values, arrow)], ["doc_id", "nth", "at", "n_tokens", "shard_start", name])
        if source is not None:
            source.close()

    rows = places.join(shards, "shard").select("doc_id", "nth", "path", "width", "at", "n_tokens", "shard_start", "shard")
    rows = rows.repartition("shard", F.floor(F.col("at") / (4 << 20))).sortWithinPartitions("shard", "at").drop("shard")
    return rows.mapInArrow(run, f"doc_id long, nth long, at long, n_tokens long, shard_start long, {name} {kind}")


def crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def key_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Each document's key: doc_id and its number among rows of that doc_id."""
    counted = docs.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.count("*").alias("n"))
    return counted.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("nth"))
