"""Merkle manifest of a table by time-forward processing (operator 12).

A node is labelled by its level and its place in the level. Each node sends its digest to its parent
through a priority queue ordered by label, so that a sweep over ascending labels finds all children of
a node next to each other; a reversed sweep sends each child the digests beside and above it, its
proof. Labels are cut into epochs of ``LEVELS`` levels: the messages between epochs are tables in the
shared folder, which Spark deals by tree and run of ``2 ** LEVELS`` nodes (its sort, which spills, is
the external part of the queue), and within one run of an epoch the queue is a heap. A tree of n leaves
takes ceil(log2(n) / LEVELS) epochs each way, each with 1/1024 of the rows of the one before, and no
task holds more than one run, however large a group is.

The parent of two nodes, or of the last one alone where their number is odd, is the sha256 of their
digests as lowercase hex text; a tree of one leaf is that leaf. A proof holds, from the leaf up, ``L``
or ``R`` and the 32 bytes of the digest on that side, or ``A`` where a node has no sibling.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from ._tables import stored

LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "tree_there boolean, tree string, at long, n long, digest string"


def field_text(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(v) for v in values]).cast("binary"), 256)


def parent(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def climb_of(n: int) -> int:
    """Levels above ``n`` nodes that one epoch climbs."""
    return min(LEVELS, (n - 1).bit_length())


def sweep(digests: list[str], climb: int) -> list[tuple[int, int, list[str]]]:
    """Forward: the nodes above ``digests`` in the order of their labels, as (level, place, child
    digests). The queue holds messages (label of the parent, place of the child, digest)."""
    queue = [(1, i >> 1, i, d) for i, d in enumerate(digests)] if climb else []
    done = []
    while queue:
        level, place = queue[0][:2]
        children = []
        while queue and queue[0][:2] == (level, place):
            children.append(heapq.heappop(queue)[3])
        done.append((level, place, children))
        if level < climb:
            heapq.heappush(queue, (level + 1, place >> 1, place, parent(children)))
    return done


def proofs(digests: list[str], climb: int, above: bytes) -> list[bytes]:
    """Reversed: the proof of each digest, given the proof of the node on top of them."""
    nodes = sweep(digests, climb)
    if not nodes:
        return [above] * len(digests)
    top = nodes[-1][:2]
    queue = [(-top[0], -top[1], above)]
    out = [b""] * len(digests)
    for level, place, children in reversed(nodes):
        suffix = heapq.heappop(queue)[2]
        for k in range(len(children)):
            if len(children) == 1:
                proof = b"A" + suffix
            else:
                proof = (b"L" if k else b"R") + bytes.fromhex(children[1 - k]) + suffix
            if level == 1:
                out[2 * place + k] = proof
            else:
                heapq.heappush(queue, (1 - level, -(2 * place + k), proof))
    return out


def entries(proof: bytes):
    """(side, digest in hex) of a proof from the leaf up; the digest is empty where side is ``A``."""
    at = 0
    while at < len(proof):
        side = proof[at : at + 1].decode()
        end = at + (1 if side == "A" else 33)
        yield side, proof[at + 1 : end].hex()
        at = end


def fold(leaf: str, proof: bytes) -> str:
    """The root that a leaf and its proof lead to."""
    for side, digest in entries(proof):
        leaf = parent([digest, leaf] if side == "L" else [leaf, digest])
    return leaf


@F.pandas_udf(StringType())
def folded(leaf: pd.Series, proof: pd.Series) -> pd.Series:
    return pd.Series([fold(a, b) for a, b in zip(leaf, proof)], dtype=object)


@F.pandas_udf(StringType())
def proof_digest(proof: pd.Series) -> pd.Series:
    """H of the siblings of a proof, as lowercase hex text."""
    return pd.Series([parent([d for _, d in entries(p)]) for p in proof], dtype=object)


def numbered(rows: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with ``at`` (place from 0 within its group by ``order``, nulls first) and ``n`` (rows of
    the group). Rows are dealt by ranges, so a group may span many tasks; places follow from the number
    of rows of each group in each partition. Rows equal in ``order`` are spread by their place in the scan."""
    tie, part, nth = "__tie", "__part", "__nth"
    by = [*groups, *order, tie]
    dealt = rows.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop(tie)
    dealt = stored(dealt.withColumn(part, F.spark_partition_id()).withColumn(nth, F.monotonically_increasing_id()), name)
    counts = dealt.groupBy(*groups, part).agg(F.count("*").alias("__c"), F.min(nth).alias("__first"))
    before = Window.partitionBy(*groups).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__c").over(before), F.lit(0))).withColumn("n", F.sum("__c").over(Window.partitionBy(*groups)))
    placed = dealt.join(counts, [*groups, part])
    return placed.withColumn("at", F.col(nth) - F.col("__first") + F.col("__before")).drop(part, nth, "__c", "__first", "__before")


def _up(nodes: DataFrame) -> DataFrame:
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        there, tree, run_at = (k.as_py() for k in key)
        table = table.sort_by("at")
        digests, n = table.column("digest").to_pylist(), table.column("n")[0].as_py()
        climb = climb_of(n)
        made = sweep(digests, climb)
        top = parent(made[-1][2]) if made else digests[0]
        return pa.table({"tree_there": [there], "tree": [tree], "at": pa.array([run_at], pa.int64()), "n": pa.array([-(-n >> climb)], pa.int64()), "digest": [top]})

    run_at = F.shiftright("at", LEVELS).alias("run_at")
    return nodes.select("tree_there", "tree", "at", "n", "digest").groupBy("tree_there", "tree", run_at).applyInArrow(run, NODE)


def _down(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """``nodes`` with their proofs and subroots, from those of the nodes one epoch above."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("at")
        if not left.num_rows:
            return left.append_column("proof", pa.array([], pa.binary())).append_column("subroot", pa.array([], pa.string()))
        found = proofs(left.column("digest").to_pylist(), climb_of(left.column("n")[0].as_py()), right.column("proof")[0].as_py())
        subroot = right.column("subroot")[0].as_py()
        return left.append_column("proof", pa.array(found, pa.binary())).append_column("subroot", pa.array([subroot] * len(found), pa.string()))

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields)
    left = nodes.groupBy("tree_there", "tree", F.shiftright("at", LEVELS).alias("run_at"))
    right = above.select("tree_there", "tree", "at", "proof", "subroot").groupBy("tree_there", "tree", F.col("at").alias("run_at"))
    return left.cogroup(right).applyInArrow(run, f"{ddl}, proof binary, subroot string")


def _climb(leaves: DataFrame) -> list[DataFrame]:
    """The nodes at the start of each epoch; the last has one a tree."""
    epochs = [leaves]
    n = leaves.agg(F.max("n")).first()[0] or 0
    while n > 1:
        epochs.append(stored(_up(epochs[-1]), "merkle-nodes"))
        n = -(-n >> climb_of(n))
    return epochs


def _descend(epochs: list[DataFrame], above: DataFrame) -> DataFrame:
    """Proofs of the first epoch's nodes, given those (``proof``, ``subroot``) of the last one's."""
    for k, nodes in enumerate(reversed(epochs[:-1])):
        above = _down(nodes, above)
        if k < len(epochs) - 2:
            above = stored(above, "merkle-proofs")
    return above


def merkle_manifest(docs: DataFrame, fields=FIELDS, group_col: str = "lang", order_col: str = "doc_id", carry: dict[str, Callable[[], Column]] | None = None) -> DataFrame:
    """One row a row of ``docs``: ``order_col``, ``group_col``, leaf, subroot, root, proof (see above), and
    the ``carry`` columns, computed from the row.

    Leaves ascend by ``order_col`` within each group (nulls first; rows of the same value by their leaf);
    subroots ascend by ``group_col`` (null first, then by UTF-8 bytes; an empty text is a group of its
    own). Repeated rows are leaves of their own. Null fields, empty and long texts are leaves like others.
    Columns that are not named are not read, whatever their names; an empty table gives no rows."""
    key, group = F.col(order_col), F.col(group_col).cast("string")
    extra = {name: make() for name, make in (carry or {}).items()}
    rows = docs.select(
        key.alias("key"), group.isNotNull().alias("tree_there"), F.coalesce(group, F.lit("")).alias("tree"),
        leaf_digest([F.col(f) for f in fields]).alias("digest"), *[v.alias(f"carry_{c}") for c, v in extra.items()],
    )
    leaves = stored(numbered(stored(rows, "merkle-leaves"), ["tree_there", "tree"], ["key", "digest"], "merkle-order"), "merkle-leaves")
    epochs = _climb(leaves)
    subroots = epochs[-1].select(F.lit(True).alias("top_there"), F.lit("").alias("top"), "tree_there", "tree", "digest")
    placed = stored(numbered(subroots, ["top_there", "top"], ["tree_there", "tree"], "merkle-order"), "merkle-subroots")
    tops = placed.select(
        F.col("top_there").alias("tree_there"), F.col("top").alias("tree"), "at", "n", "digest",
        F.col("tree_there").alias("of_there"), F.col("tree").alias("of"),
    )
    upper = _climb(tops)
    first = upper[-1].select("digest").first()
    root = F.lit(first[0] if first else None).cast("string")
    above = upper[-1].select("*", F.lit(b"").alias("proof"), F.lit("").alias("subroot"))
    above = _descend(upper, above).select(
        F.col("of_there").alias("tree_there"), F.col("of").alias("tree"), F.lit(0).cast("long").alias("at"),
        "proof", F.col("digest").alias("subroot"),
    )
    if len(epochs) > 1:
        out = _descend(epochs, stored(above, "merkle-proofs"))
    else:  # no tree has more than its leaf
        out = leaves.join(above.drop("at"), ["tree_there", "tree"])
    return out.select(
        F.col("key").alias(order_col), F.when(F.col("tree_there"), F.col("tree")).alias(group_col), F.col("digest").alias("leaf"),
        "subroot", root.alias("root"), "proof", *[F.col(f"carry_{c}").alias(c) for c in extra],
    )
