"""Best-fit packing of token sequences with large-item matching (operator 13).

``token_pieces`` encodes whole documents and cuts those above the capacity; ``pack`` places items of
given lengths in bins. Lengths are whole numbers up to the capacity, so the plan needs only how many
items of each length there are (at most ``capacity`` counts, over all rows) and is made on them:

* items above a third of the capacity fit at most twice in a bin. From the largest down, each is matched
  with the largest other one that fits beside it (this gives as many pairs as any matching); the rest
  get a bin each;
* smaller items, the largest first, go where they leave the least room (best fit), equal lengths and
  equal bins in bulk; a new bin is opened where none has room.

A plan line says that items ``first`` .. of one length lie ``each`` in a bin from bin ``bin`` on, at
offset ``offset``. There are at most a few lines for each pair of length and room, whatever the number
of rows. Items of one length are numbered by the partition that holds them and their place in it, so no
length, however frequent, is gathered in one task; every task looks up its items in the plan.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._tables import stored
from ._text import chunk_bounds
from .token_store import END_ID, Encoder

CAPACITY = 2048


def match_large(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int]]:
    """(length, partner or 0, bins) for all items above a third of the capacity."""
    left = {x: n for x, n in counts.items() if 3 * x > capacity and n}
    sizes = sorted(left)
    out = []
    while sizes:
        x = sizes[-1]
        n = left[x]
        k = bisect_left(sizes, capacity - x + 1) - 1  # the largest length that fits beside x
        y = sizes[k] if k >= 0 else 0
        if not y:
            out.append((x, 0, n))
            left[x] = 0
        elif y == x:
            out.append((x, x, n // 2))
            left[x] = n % 2
            if n == 1:  # no second one of this length
                y = sizes[k - 1] if k else 0
                out.append((x, y, 1))
                left[x] = 0
                if y:
                    left[y] -= 1
        else:
            pairs = min(n, left[y])
            out.append((x, y, pairs))
            left[x] -= pairs
            left[y] -= pairs
        sizes = [s for s in sizes if left[s]]
    return [o for o in out if o[2]]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Lines (length, first, each, bin, offset), by length and first: item ``first + j`` of the length
    lies in bin ``bin + j // each`` at ``offset + length * (j % each)``."""
    if counts and max(counts) > capacity:
        raise ValueError("an item is longer than the capacity")
    lines: list[tuple[int, int, int, int, int]] = []
    taken = dict.fromkeys(counts, 0)
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> runs of bins (first bin, number)
    rooms: list[int] = []
    bins = 0

    def leave(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in room:
                room[gap] = []
                insort(rooms, gap)
            room[gap].append((first, n))

    def put(length: int, n: int, each: int, first_bin: int, offset: int) -> None:
        lines.append((length, taken[length], each, first_bin, offset))
        taken[length] += n

    for x, y, n in match_large(counts, capacity):
        put(x, n, 1, bins, 0)
        if y:
            put(y, n, 1, bins, x)
        leave(capacity - x - y, bins, n)
        bins += n
    for x in sorted((s for s in counts if s and 3 * s <= capacity), reverse=True):
        left = counts[x]
        while left:
            k = bisect_left(rooms, x)
            if k == len(rooms):
                each = capacity // x
                new = -(-left // each)
                leave(capacity, bins, new)
                bins += new
                continue
            gap = rooms[k]
            first, n = room[gap].pop()
            if not room[gap]:
                del room[gap]
                del rooms[k]
            each = gap // x
            whole = min(n, left // each)
            offset = capacity - gap
            if whole:
                put(x, whole * each, each, first, offset)
                leave(gap - each * x, first, whole)
                left -= whole * each
            if whole < n and left:  # fewer than fill one more bin
                put(x, left, left, first + whole, offset)
                leave(gap - left * x, first + whole, 1)
                whole, left = whole + 1, 0
            leave(gap, first + whole, n - whole)
    return sorted(lines)


def _numbered(length_at: int):
    """Adds part and nth: the partition and the item's place among those of its length there."""

    def run(batches):
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            lengths = batch.column(length_at).to_numpy(zero_copy_only=False)
            order = np.argsort(lengths, kind="stable")
            values, first, n = np.unique(lengths[order], return_index=True, return_counts=True)
            nth = np.empty(len(lengths), np.int64)
            base = np.array([seen.get(v, 0) for v in values.tolist()], np.int64)
            nth[order] = np.arange(len(lengths)) - np.repeat(first - base, n)
            seen.update(zip(values.tolist(), (base + n).tolist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(lengths), pa.int32()), pa.array(nth)], [*batch.schema.names, "__part", "__nth"])

    return run


def _placer(lines: list[tuple[int, int, int, int, int]], length_at: int, rank_at: int):
    table = np.array(lines, np.int64).reshape(-1, 5)

    def run(batches):
        sizes, first = np.unique(table[:, 0], return_index=True)
        ends = np.append(first[1:], len(table))
        for batch in batches:
            lengths = batch.column(length_at).to_numpy(zero_copy_only=False)
            ranks = batch.column(rank_at).to_numpy(zero_copy_only=False)
            at = np.empty(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            values, start, n = np.unique(lengths[order], return_index=True, return_counts=True)
            for v, s, c in zip(values, start, n):
                k = int(np.searchsorted(sizes, v))
                mine = order[s : s + c]
                at[mine] = first[k] + np.searchsorted(table[first[k] : ends[k], 1], ranks[mine], side="right") - 1
            line = table[at]
            j = ranks - line[:, 1]
            keep = [i for i in range(batch.num_columns) if i != rank_at]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in keep], pa.array(line[:, 3] + j // line[:, 2]), pa.array(line[:, 4] + lengths * (j % line[:, 2]))],
                [*[batch.schema.names[i] for i in keep], "sequence_id", "offset"],
            )

    return run


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def pack(items: DataFrame, length_col: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``items`` with sequence_id and offset: every row lies whole in one sequence of at most
    ``capacity``, without gaps, in as few sequences as the method finds. Lengths are long, from 1 to the
    capacity; a null, a zero or a longer one raises. Repeated rows are items of their own; an empty table gives none. Columns
    named sequence_id or offset are refused."""
    clash = {"sequence_id", "offset", "__part", "__nth"} & {c.lower() for c in items.columns}
    if clash:
        raise ValueError(f"columns named {sorted(clash)}")
    length_at = items.columns.index(length_col)
    rows = stored(items.mapInArrow(_numbered(length_at), f"{_ddl(items)}, __part int, __nth long"), "pack-items")
    counts = rows.groupBy(length_col, "__part").agg(F.count("*").alias("__c"))
    by_length = {r[0]: r[1] for r in counts.groupBy(length_col).agg(F.sum("__c")).limit(capacity + 2).collect()}
    if any(x is None or not 0 < x <= capacity for x in by_length):
        raise ValueError(f"lengths have to be from 1 to {capacity}")
    before = Window.partitionBy(length_col).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(length_col, "__part", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__start"))
    ranked = rows.join(starts, [length_col, "__part"]).select(*[F.col(f"`{c}`") for c in items.columns], (F.col("__start") + F.col("__nth")).alias("__nth"))
    placer = _placer(plan(by_length, capacity), length_at, len(items.columns))
    return ranked.mapInArrow(placer, f"{_ddl(items)}, sequence_id long, offset long")


def _cut(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches):
        encoder = Encoder.get(path)
        for batch in batches:
            for lo, hi in chunk_bounds(batch.column(1)):
                ids, n = encoder.encode(batch.column(1).slice(lo, hi - lo))
                ids = np.insert(ids, np.cumsum(n), end_id).astype("<u4")
                n = n + 1
                pieces = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                # whole pieces lie at the end of a document, what is over makes the first one
                head = n - (pieces - 1) * capacity
                length = np.where(piece == 0, head[doc], capacity)
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
                at = (np.cumsum(n) - n)[doc] + start
                data = memoryview(ids.tobytes())
                crc = [zlib.crc32(data[4 * a : 4 * (a + m)]) for a, m in zip(at.tolist(), length.tolist())]
                cols = [batch.column(0).slice(lo, hi - lo).take(pa.array(doc)).cast(pa.int64()), pa.array(piece, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(at, len(ids)), pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """The ids of each whole text and the end id, cut where they exceed the capacity: doc_id, piece (from
    0), start, length, ids_crc32 (of the ids as little-endian unsigned 32-bit numbers) and, on request,
    ids. All pieces of a document but the first are as long as the capacity.

    A null text is empty and has the end id alone. Repeated rows and null ids are documents of their
    own. Other columns are not read; an empty table gives no rows."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ddl = "doc_id long, piece long, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return rows.mapInArrow(_cut(tokenizer_path, capacity, end_id, with_ids), ddl)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids: sequence_id, ids, in order of offset; ``packed`` has the ids of each piece. A
    group is one sequence, so it holds no more ids than the capacity."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
