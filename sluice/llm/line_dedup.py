"""Content-defined line chunks (operator 10), in DataFrame and SQL functions only.

The lines of a text (split at \\n) are hashed; a rolling hash over the last ``WINDOW`` line hashes
ends a chunk where it is a multiple of ``DIVISOR``, and the last line ends one too. So boundaries
depend on nearby lines alone and meet again soon after an inserted or deleted line. A chunk of two
or more lines with a visible character counts; where the same bytes stand in an earlier place
(smaller doc_id, then smaller position in the text), it is removed with its line ends.

Chunks are first counted by hash alone. Only those whose hash repeats are compared byte by byte:
they are grouped and joined by their text. Both steps aggregate partially before they shuffle, and
joins on a hot chunk are split by Spark's skew handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .._util import quote, temp_name
from ._tables import stored

WINDOW = 2
DIVISOR = 4
FACTOR = 31
NEWLINE = "char(10)"


def chunks(text_sql: str, window: int = WINDOW, divisor: int = DIVISOR) -> Column:
    """array<struct<idx int, n int, real int, chunk string>>: every chunk in order, its number of
    lines and of lines with a visible character, and its text. One-element arrays bind the steps,
    so that each is evaluated once for a text."""
    rolled = " + ".join(f"{FACTOR**j} * coalesce(get(h, i - {j}), 0)" for j in range(window))
    return F.expr(f"""
        transform(array(split(coalesce({text_sql}, ''), {NEWLINE}, -1)), l ->
          transform(array(transform(l, x -> cast(conv(substring(md5(x), 1, 8), 16, 10) as bigint))), h ->
            transform(array(filter(sequence(0, size(l) - 1), i -> ({rolled}) % {divisor} = 0 or i = size(l) - 1)), e ->
              transform(transform(e, (x, k) -> slice(l, if(k = 0, 1, e[k - 1] + 2), if(k = 0, x + 1, x - e[k - 1]))),
                (c, k) -> struct(k as idx, size(c) as n, size(filter(c, x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')) as real,
                                 array_join(c, {NEWLINE}) as chunk))
            )[0])[0])[0]
    """)


def removed_chunks(docs: DataFrame, id_col: str, text_col: str, window: int, divisor: int) -> DataFrame:
    """(doc_id, gone): for each document its repeated chunks as idx and hash; bounded by its text."""
    found = docs.where(F.col(quote(id_col)).isNotNull()).select(F.col(quote(id_col)).alias("doc_id"), F.explode(chunks(quote(text_col), window, divisor)).alias("c"))
    found = found.where("c.real > 1").select("doc_id", "c.idx", "c.chunk", F.xxhash64("c.chunk").alias("hash"))
    repeated = found.groupBy("hash").count().where("count > 1").select("hash")
    again = stored(found.join(repeated, "hash", "left_semi"), "chunks")
    first = again.groupBy("hash", "chunk").agg(F.min(F.struct("doc_id", "idx")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    gone = again.join(first, ["hash", "chunk"]).where(F.struct("doc_id", "idx") > F.col("first"))
    return gone.groupBy("doc_id").agg(F.collect_set(F.struct("idx", "hash")).alias("gone"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, divisor: int = DIVISOR, counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with repeated multi-line chunks taken out of ``text_col``; rows and columns stay.

    ``counts`` names two more columns: lines before and lines removed. A null text stays null (and
    has no lines), an empty one has one empty line. Repeated rows (same doc_id and text) are one
    document: each keeps what the other keeps. Rows with a null doc_id stay as they are. Nothing
    is removed from an empty table.
    """
    key, gone, made = (temp_name(docs, x) for x in ("key", "gone", "made"))
    removal = removed_chunks(docs, id_col, text_col, window, divisor).select(F.col("doc_id").alias(key), F.col("gone").alias(gone))
    joined = docs.join(removal, F.col(quote(id_col)) == F.col(key), "left")
    parts = temp_name(docs, "parts")
    joined = joined.withColumn(parts, chunks(quote(text_col), window, divisor))
    dropped = f"array_contains({gone}, struct(c.idx as idx, xxhash64(c.chunk) as hash))"
    rebuilt = F.expr(f"""
        struct(array_join(transform(filter({parts}, c -> not {dropped}), c -> c.chunk), {NEWLINE}) as text,
               cast(aggregate(filter({parts}, c -> {dropped}), 0, (s, c) -> s + c.n) as bigint) as n)""")
    text = F.col(quote(text_col))
    lines = F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n", -1))).cast("long")
    out = joined.withColumn(made, F.when(F.col(gone).isNotNull(), rebuilt))
    n_lines, n_removed = counts or (None, None)
    columns = [F.coalesce(F.col(made)["text"], text).alias(c) if c == text_col else F.col(quote(c)) for c in docs.columns]
    if counts:
        columns += [lines.alias(n_lines), F.coalesce(F.col(made)["n"], F.lit(0)).cast("long").alias(n_removed)]
    return out.select(*columns)
