"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._tables import stored, table
from .ann import nearest
from .lexical import lexical_search
from .line_dedup import line_dedup
from .merkle import FIELDS, folded, leaf_digest, merkle_manifest, proof_digest
from .mixing import mix_sources, word_count
from .near_dup import near_duplicates
from .outliers import robust_outliers
from .packing import pack, token_pieces
from .substring_dedup import remove_repeated_passages
from .toxicity import toxicity_scores, train
from .unigram import decoded, sampled_ids, token_counts
from .token_store import build_index, crc32, find, key_rows, read_ids, shard_starts, write_ids

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


@register("op9_minhash_near_dup")
def op9(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))

OP10_SQL = r"""
WITH l AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
h AS (SELECT doc_id, text, l, list_transform(l, lambda x: CAST('0x' || substr(md5(x), 1, 8) AS BIGINT)) AS h FROM l),
line AS (SELECT doc_id, i, l[i] AS line, (h[i] + 31 * coalesce(CASE WHEN i > 1 THEN h[i - 1] END, 0)) % 4 = 0 AS last
         FROM (SELECT doc_id, l, h, unnest(range(1, len(l) + 1)) AS i FROM h)),
part AS (SELECT doc_id, i, line, coalesce(sum(CAST(last AS INT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS idx FROM line),
chunk AS (SELECT doc_id, idx, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS n,
                 count(*) FILTER (regexp_matches(line, '[^\x20\x09-\x0D]')) AS visible FROM part GROUP BY doc_id, idx),
ranked AS (SELECT *, visible > 1 AND row_number() OVER (PARTITION BY visible > 1, chunk ORDER BY doc_id, idx) > 1 AS gone FROM chunk)
SELECT r.doc_id, any_value(len(h.l)) AS n_lines, CAST(sum(CASE WHEN gone THEN n ELSE 0 END) AS BIGINT) AS n_removed,
       coalesce(string_agg(chunk, chr(10) ORDER BY idx) FILTER (NOT gone), '') AS text
FROM ranked r JOIN h USING (doc_id) GROUP BY r.doc_id
"""


@register("op10_line_chunk_dedup", OP10_SQL)
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs, counts=("n_lines", "n_removed"))


OP8_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
least AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM win JOIN least USING (s), range(13) r(j) WHERE m < doc_id),
word AS (SELECT doc_id, i, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@register("op8_repeated_phrase_automata", OP8_SQL)
def op8(spark, sf_dir):
    out = remove_repeated_passages(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register("op3_subset_sum_mixing")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    mixed = mix_sources(stored(docs, "sizes"), "size")
    return mixed.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@register("op5_robust_outliers")
def op5(spark, sf_dir):
    return robust_outliers(table(spark, sf_dir, "documents"))


@register("op2_token_id_files")
def op2(spark, sf_dir, tokenizer: str = "byte_bpe_50k.json"):
    docs = table(spark, sf_dir, "documents")
    written = write_ids(docs, public_tokenizers.path(tokenizer))
    index, parts = build_index(written)
    places = find(key_rows(docs), index, parts)
    read = read_ids(places, shard_starts(written), crc32, "long", "ids_crc32")
    return read.select("doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


@register("op6_weak_supervision_toxicity")
def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity_scores(docs, train(docs, table(spark, sf_dir, "labels")))


@register("op4_viterbi_token_counts")
def op4(spark, sf_dir, model: str = "piece_bpe_32k.model"):
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(model))


@register("op7_sampled_segmentation")
def op7(spark, sf_dir, model: str = "piece_bpe_32k.model"):
    path = public_tokenizers.path(model)
    rows = decoded(sampled_ids(table(spark, sf_dir, "documents"), path), path)
    return rows.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), F.sha2("text", 256).alias("text_sha256"))


@register("op1_collision_counting_search")
def op1(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where("vec_id % 20 = 0"))


OP11_SQL = r"""
WITH d AS (SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
                  lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM documents),
i AS (SELECT DISTINCT item_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM benchmark),
s AS (SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d),
p AS (SELECT doc_id, any_value(n) AS n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY doc_id, term),
t AS (SELECT term, CAST(floor(1000 * ln((2 * s.n + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
f AS (SELECT item_id, doc_id, CAST(sum(t.w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * p.n * s.n) // s.l)))) AS BIGINT) AS score
      FROM i JOIN p USING (term) JOIN t USING (term), s GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM f WHERE score > 0) WHERE rank <= 10
"""


@register("op11_hybrid_lexical_search", OP11_SQL)
def op11(spark, sf_dir):
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH RECURSIVE
t AS (SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
f AS (SELECT doc_id, lang, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
             n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail,
             xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                 lambda c, b: xor(c >> 8, t.t[1 + (xor(c, b) & 255)])), 4294967295) % 7 = 0 AS hit FROM documents, t),
l AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
             CASE WHEN hit THEN sha256(head || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) END AS tampered FROM f),
leaf AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM l),
up AS (SELECT lang, 0 AS lvl, pos, leaf AS d, n FROM leaf
       UNION ALL SELECT lang, lvl + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (n + 1) // 2 FROM up WHERE n > 1 GROUP BY lang, lvl, pos // 2, n),
sub AS (SELECT lang, d AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS top_pos, count(*) OVER () AS top_n FROM up WHERE n = 1),
top AS (SELECT 0 AS lvl, top_pos AS pos, subroot AS d, top_n AS n FROM sub
        UNION ALL SELECT lvl + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY lvl, pos // 2, n),
one AS (SELECT doc_id, leaf, subroot, (SELECT d FROM top WHERE n = 1) AS root, coalesce(tampered, leaf) AS d, leaf.lang, pos, n, 0 AS lvl, '' AS proof, top_pos, top_n FROM leaf JOIN sub ON leaf.lang IS NOT DISTINCT FROM sub.lang),
walk AS (SELECT * FROM one
         UNION ALL SELECT w.doc_id, w.leaf, w.subroot, w.root, sha256(CASE WHEN s.d IS NULL THEN w.d WHEN w.pos % 2 = 1 THEN s.d || w.d ELSE w.d || s.d END),
                   w.lang, w.pos // 2, (w.n + 1) // 2, w.lvl + 1, w.proof || coalesce(s.d, ''), w.top_pos, w.top_n
         FROM walk w LEFT JOIN up s ON s.lang IS NOT DISTINCT FROM w.lang AND s.lvl = w.lvl AND s.pos = xor(w.pos, 1) WHERE w.n > 1),
high AS (SELECT doc_id, leaf, subroot, root, d, top_pos AS pos, top_n AS n, 0 AS lvl, proof FROM walk WHERE n = 1
         UNION ALL SELECT w.doc_id, w.leaf, w.subroot, w.root, sha256(CASE WHEN s.d IS NULL THEN w.d WHEN w.pos % 2 = 1 THEN s.d || w.d ELSE w.d || s.d END),
                   w.pos // 2, (w.n + 1) // 2, w.lvl + 1, w.proof || coalesce(s.d, '')
         FROM high w LEFT JOIN top s ON s.lvl = w.lvl AND s.pos = xor(w.pos, 1) WHERE w.n > 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, d AS folded_root, d = root AS verified FROM high WHERE n = 1
"""


@register("op12_merkle_manifest", OP12_SQL)
def op12(spark, sf_dir):
    def tampered():
        fields = [F.col(c).cast("decimal(20,0)") + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
        return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, leaf_digest(fields))

    made = merkle_manifest(table(spark, sf_dir, "documents"), carry={"tampered": tampered})
    made = made.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), "proof"))
    return made.select("doc_id", "leaf", "subroot", "root", proof_digest("proof").alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@register("op13_large_item_packing")
def op13(spark, sf_dir, tokenizer: str = "byte_bpe_50k.json"):
    return pack(token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(tokenizer)))
