"""Operators 2, 3, 4 and 7: exact encodings, round trips, budgets."""

import itertools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm.mixing import fit, mix_sources, targets, word_count
from sluice.llm.token_store import Encoder, PerfectHash, build_index, crc32, find, fingerprints, key_hashes, key_rows, read_ids, shard_starts, write_ids
from sluice.llm.unigram import LITERAL, Edges, Vocabulary, best_counts, decode, decoded, sample, sampled_ids, token_counts

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", "  a  b ", "a▁b", "日本語 €uro\n\nx  ", "🙂🙂", "<0x41> hi <s>", " ", "\n", " \n ", "don't  stop now 　x", "a  b \x1c c", "über Straße, naïve 12 345!", "aaaa" * 300, "x <|endoftext|> y", "word " * 2000, "\x85 q", "é è ê"]
SCHEMA = "doc_id long, text string, source string, shard int, ids string, size string, whole int"


@pytest.fixture(scope="module")
def bpe():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    return t


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "x", "y", 2) for i, t, s in rows], SCHEMA).repartition(3)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab'st é 　\x85\x1c\n\t 9日🙂ß,.", max_size=25), min_size=1, max_size=5))
def test_cut_encoding_equals_whole_encoding(bpe, texts):
    ids, n = Encoder(BPE).encode(pa.array(texts))
    want = [e.ids for e in bpe.encode_batch(texts, add_special_tokens=False)]
    assert n.tolist() == [len(x) for x in want] and ids.tolist() == list(itertools.chain(*want))


def test_token_files_round_trip(spark, bpe):
    rows = [(k * 7 % 101, t, "s") for k, t in enumerate(TEXTS)] + [(500, None, None), (None, "no id", "s"), (None, None, "s"), (7, "again", "s"), (7, TEXTS[1], "s")]
    docs = frame(spark, rows)
    written = write_ids(docs, BPE, shard_bytes=4000)
    index, parts = build_index(written, part_keys=4)
    assert parts > 1
    places = find(key_rows(docs), index, parts)
    got = read_ids(places, shard_starts(written), lambda x: x.astype(np.int64).tolist(), "array<long>", "ids").collect()
    want = sorted(((i if i is not None else -1, [*bpe.encode(t or "", add_special_tokens=False).ids, 0]) for i, t, _ in rows))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.ids) for r in got) == want
    ordered = sorted(got, key=lambda r: r.shard_start + r.at)
    keys = [r.doc_id if r.doc_id is not None else -1 for r in ordered]
    assert keys == sorted(keys)
    at = 0
    for r in ordered:
        assert r.shard_start + r["at"] == at
        at += r.n_tokens
    unknown = spark.createDataFrame([(10**9 + k, 0) for k in range(50)], "doc_id long, nth long")
    assert find(unknown, index, parts).count() == 0


def test_token_files_of_an_empty_table(spark):
    written = write_ids(frame(spark, []), BPE)
    index, parts = build_index(written)
    assert read_ids(find(key_rows(frame(spark, [])), index, parts), shard_starts(written), crc32, "long", "crc").collect() == []
    assert crc32(np.array([1, 0], np.uint16)) == zlib.crc32(b"\x01\0\0\0\0\0\0\0")


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(-(2**62), 2**62), max_size=300))
def test_perfect_hash_is_minimal(keys):
    keys = np.array(sorted(keys), np.int64)
    h = key_hashes(keys, np.zeros(len(keys), bool), np.zeros(len(keys), np.int64))
    perfect = PerfectHash.build(h)
    assert sorted(perfect.slots(h).tolist()) == list(range(len(keys))) and perfect.size == len(keys)
    assert len(set(fingerprints(h).tolist())) >= len(keys) - 1


def test_viterbi_counts_equal_the_tokenizer():
    import sentencepiece
    from tokenizers import Tokenizer, models

    m = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    exact = Tokenizer(models.Unigram([(m.id_to_piece(i), float(m.get_score(i))) for i in range(m.get_piece_size())], 0, True))
    v = Vocabulary(PIECES)
    texts = [t for t in TEXTS if "<0x" not in t and "<s>" not in t]  # that library also finds special pieces in a text
    which, names, doc, _ = v.parts(pa.array(texts))
    got = np.bincount(doc, best_counts(v, names)[which], len(texts)).astype(int).tolist()
    assert got == [len(exact.encode("▁" + t.replace(" ", "▁")).ids) if t else 0 for t in texts]


def test_equal_scores_take_the_earliest_start():
    import ahocorasick

    v = Vocabulary(PIECES)
    v.automaton = ahocorasick.Automaton()
    for i, (piece, score) in enumerate([("a", -1.0), ("aa", -2.0), ("aaa", -4.0), ("b", -3.0), ("ab", -4.0)]):
        v.automaton.add_word(piece, i)
        v.length[i], v.score[i] = len(piece), score
    v.automaton.make_automaton()
    assert best_counts(v, ["aa", "aaaa", "ab"]).tolist() == [1, 2, 1]  # "aa" scores -2 either way


def test_counts_and_samples_as_frames(spark):
    rows = [(k, t, "s") for k, t in enumerate(TEXTS)] + [(900, None, None), (None, "no id", "s"), (3, TEXTS[3], "s")]
    docs = frame(spark, rows)
    counts = {r.doc_id: r.n_tokens for r in token_counts(docs, PIECES).collect()}
    assert counts[0] == 0 and counts[900] == 0 and counts[6] > 0
    out = decoded(sampled_ids(docs, PIECES), PIECES).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in out) == sorted((i if i is not None else -1, t or "") for i, t, _ in rows)
    again = sampled_ids(docs.repartition(5), PIECES).collect()
    pairs = lambda x: sorted((r.doc_id if r.doc_id is not None else -1, r.ids) for r in x)
    assert pairs(out) == pairs(again)
    assert token_counts(frame(spark, []), PIECES).collect() == [] and decoded(sampled_ids(frame(spark, []), PIECES), PIECES).collect() == []


def test_sampled_shares_follow_the_path_weights():
    """All segmentations of a short text against their exact probabilities."""
    v, alpha = Vocabulary(PIECES, keep_literal=True), 0.0005
    text = "▁then"
    paths = {}
    edges = Edges(v, [text])
    ends = [[] for _ in text]
    for end, length, own, i in zip(edges.end, edges.length, edges.score, edges.emit):
        ends[end].append((length, own, int(i)))

    def walk(end, ids, score):
        if end == 0:
            paths[tuple(ids)] = score
            return
        for length, own, i in ends[end - 1]:
            walk(end - length, [i, *ids], score + own)

    walk(len(text), [], 0.0)
    weight = {p: np.exp(alpha * s) for p, s in paths.items()}
    total = sum(weight.values())
    n = 20000
    ids, counts = sample(v, pa.array(["then"] * n), np.arange(n), 3, alpha)
    at = np.concatenate(([0], np.cumsum(counts)))
    seen = {}
    for k in range(n):
        p = tuple(ids[at[k] : at[k + 1]].tolist())
        seen[p] = seen.get(p, 0) + 1
    assert set(seen) <= set(paths)
    for p, w in weight.items():
        share = w / total
        assert abs(seen.get(p, 0) / n - share) < 5 * np.sqrt(share * (1 - share) / n) + 1e-3


def test_a_literal_marker_comes_back():
    v = Vocabulary(PIECES, keep_literal=True)
    ids, n = sample(v, pa.array(["▁▁ a▁ b"]), np.array([1]), 3, 0.001)
    assert decode(Vocabulary(PIECES), ids, n) == ["▁▁ a▁ b"] and LITERAL not in decode(v, ids, n)[0]


# ---------------------------------------------------------------- mixing


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 4), min_size=1, max_size=6), st.integers(0, 80))
def test_fit_finds_the_nearest_sum(counts, budget):
    take = fit(counts, budget)
    assert all(0 <= take[n] <= c for n, c in counts.items())
    got = sum(n * k for n, k in take.items())
    total = sum(n * c for n, c in counts.items())
    start = {n: c * budget // total for n, c in counts.items()} if budget < total else counts
    sums = {sum(n * k for n, k in zip(counts, ks)) for ks in itertools.product(*[range(start[n], c + 1) for n, c in counts.items()])}
    assert abs(got - budget) == min(abs(s - budget) for s in sums)


def test_fit_brings_large_budgets_down_first():
    counts = {1000: 50, 777: 40, 13: 9, 1: 3000}
    take = fit(counts, 61234, dp_budget=2000)
    assert abs(sum(n * k for n, k in take.items()) - 61234) <= 2 and all(take[n] <= c for n, c in counts.items())


def test_targets_share_and_stop():
    got = targets([("b", 10), ("a", 1), (None, 1000), ("c", 100)])
    assert got["a"] == 3.0  # 5 of 13 parts would be far over three times its size
    assert sum(got.values()) == pytest.approx(1111) and all(got[s] <= 3 * n + 1e-9 for s, n in [("b", 10), ("a", 1), (None, 1000), ("c", 100)])
    assert got["b"] == 30.0 and got["c"] == pytest.approx((1111 - 33) / 6) and targets([]) == {}


def test_mix_of_awkward_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(k, "w " * int(rng.integers(0, 30)), ["x", "y", None, "É"][k % 4] if k % 3 else "x") for k in range(300)]
    rows += [(1, "same words here", "x")] * 40 + [(None, "no id", "y"), (400, None, "x"), (401, "alone", "zz")]
    docs = frame(spark, rows).withColumn("size", word_count(__import__("pyspark").sql.functions.col("text")))
    one = mix_sources(docs, "size").collect()
    two = mix_sources(docs.repartition(7), "size").collect()
    key = lambda x: sorted((r.doc_id if r.doc_id is not None else -1, r.text or "", str(r.source), r.source_size, r.target, r.copies) for r in x)
    assert key(one) == key(two) and len(one) == len(rows) and all(0 <= r.copies <= 3 for r in one)
    goal = targets([(s, sum(len((t or "").split()) for _, t, x in rows if x == s)) for s in {r[2] for r in rows}])
    for s, want in goal.items():
        own = [r for r in one if r.source == s]
        assert own[0].target == pytest.approx(want)
        assert abs(sum(r.size * r.copies for r in own) - want) <= 5
    assert mix_sources(docs.limit(0), "size").collect() == []


def test_long_texts_without_borders(monkeypatch):
    """Parts of over LONG characters go node by node: the same results, and time in proportion to the text."""
    import time

    import sluice.llm.unigram as unigram

    words, literal = Vocabulary(PIECES), Vocabulary(PIECES, keep_literal=True)
    texts = pa.array(["", "the theatre, athéné 日本の本 ", "ab" * 40, "é" * 50 + "的" * 30, "th" * 3 + " ▁ x"] * 4)
    found = []
    for long in (3, 1024):
        monkeypatch.setattr(unigram, "LONG", long)
        which, names, _, _ = words.parts(texts)
        found.append((best_counts(words, names)[which].tolist(), [x.tolist() for x in sample(literal, texts, np.arange(len(texts)), 3, 0.1)]))
    assert found[0] == found[1]
    text = "".join(chr(0x4E00 + k * 37 % 256) for k in range(350_000))  # 1 MB without a border
    begin = time.time()
    which, names, _, _ = words.parts(pa.array([text]))
    assert max(map(len, names)) > 300_000 and best_counts(words, names)[which].sum() > 0
    ids, n = sample(literal, pa.array([text]), np.array([5]), 3, 0.1)
    assert decode(literal, ids, n) == [text] and time.time() - begin < 60


def test_a_worker_keeps_its_encoder_from_task_to_task(spark):
    def run(batches):
        for batch in batches:
            encoder = Encoder.get(BPE)
            seen = len(encoder.known)
            encoder.encode(pa.array([f"word{k}" for k in range(10)]))
            yield pa.RecordBatch.from_pydict({"seen": [seen]})

    frame = spark.range(0, 64, 1, 64).mapInArrow(run, "seen long")
    frame.collect()
    assert any(r.seen for r in frame.collect())


def test_the_edges_of_a_chunk_take_little_memory():
    import tracemalloc

    v = Vocabulary(PIECES, keep_literal=True)
    parts = [f"▁word{n}of\U00012000{'many' * (n % 7)}" for n in range(2000)]
    v.matches(parts)
    tracemalloc.start()
    edges = Edges(v, parts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 * len(edges.emit)
    assert (edges.emit == -1 - 0x12000).sum() == len(parts)
