"""The rows of every pipeline stage against a brute-force version, on documents with planted cases."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F
from test_text_dedup import WORD, brute_lines

import corpus_pipeline
from sluice.llm._tables import stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
INSULTS = ["idiot", "moron", "worthless", "scum", "pathetic"]
MAIN = [f"{a}{b}{c}" for a in "bdklmnprst" for b in ("a", "e", "o", "u", "i") for c in ("n", "ster", "vel", "mi")]


def planted():
    """(rows, labels, toxic ids): clean texts of their own, toxic ones, exact and near copies, shared lines."""
    rng = random.Random(11)
    rows, labels = [], []

    def draw(n):
        return " ".join(rng.choice(MAIN) for _ in range(n))

    for k in range(240):
        rows.append((k, "\n".join(draw(rng.randint(8, 14)) for _ in range(rng.randint(3, 8)))))
        labels.append((k, 0))
    toxic = list(range(1000, 1060))
    for k in toxic:
        words = draw(40).split(" ")
        for _ in range(6):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((k, " ".join(words)))
        labels.append((k, 1))
    shared = "\n".join(draw(10) for _ in range(12))
    for k in range(2000, 2012):  # one passage of lines in different surroundings
        rows.append((k, f"{draw(60)}\n{shared}\n{draw(60)}"))
    for k in range(6):  # near copies on one line, which line dedup leaves alone
        base = draw(200).split(" ")
        for j in range(4):
            near = list(base)
            for _ in range(j):
                near[rng.randrange(len(near))] = rng.choice(MAIN)
            rows.append((3000 + 10 * k + j, " ".join(near)))
    rows += [(4000 + k, rows[k][1]) for k in range(8)]  # exact copies
    rows += [(5000, None), (5001, ""), (5002, "short"), (None, draw(30))]
    rng.shuffle(rows)
    return [(i, t, ["en", "de", None][(i or 0) % 3], ["a", "b", "c", None][(i or 0) // 7 % 4], len(t) if t is not None else None) for i, t in rows], labels, toxic


def shingles(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else ({tuple(words)} if words else set())


def kept_of_near(rows, percent=80):
    """One row a group of linked texts, the smallest id; rows without an id stay."""
    known = [(r.doc_id, shingles(r.text)) for r in rows if r.doc_id is not None]
    least = {i: i for i, _ in known}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for n, (i, a) in enumerate(known):
        for j, b in known[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                least[y] = x
    return [r for r in rows if r.doc_id is None or root(r.doc_id) == r.doc_id]


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    rows, labels, toxic = planted()
    place = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    docs = [spark.read.parquet(f"{place}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(stored(stage(spark, docs[-1], place), f"test-{name}"))
    return rows, toxic, docs, place


def test_toxic_documents_go_and_clean_ones_stay(run):
    rows, toxic, docs, _ = run
    left = plain(docs[1])
    assert left == sorted((r for r in rows if r[0] not in toxic), key=str)


def test_lines_are_those_of_the_plain_version(run):
    _, _, docs, _ = run
    want = {}
    for i, text, *_ in brute_lines([(r.doc_id, r.text) for r in docs[1].collect()]):
        want.setdefault(None if i == -1 else i, []).append(text)
    got = docs[2].collect()
    assert len(got) == docs[1].count()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted((str(i), t) for i, ts in want.items() for t in ts)
    assert all(r.n_chars == len(r.text) for r in got if r.text is not None)


def test_one_of_each_group_of_near_copies_stays(run):
    _, _, docs, _ = run
    before = docs[2].collect()
    assert plain(docs[3]) == sorted((tuple(r) for r in kept_of_near(before)), key=str)
    ids = {r.doc_id for r in docs[3].collect()}
    assert not ids & {3000 + 10 * k + j for k in range(6) for j in (1, 2, 3)}


def test_the_mix_takes_whole_documents_near_its_targets(run):
    _, _, docs, _ = run
    before, after = docs[3].collect(), docs[4].collect()
    size = lambda r: len(WORD.findall(r.text or ""))
    total, sizes = sum(map(size, before)), collections.Counter()
    for r in before:
        sizes[r.source] += size(r)
    names = sorted((s for s in sizes if sizes[s]), key=lambda s: (s is None, s or ""))
    order = sorted({r.source for r in before}, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, open_ = {}, list(names)
    while open_:  # the excess over three times a source's size is shared by the others
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            target.update(share)
            break
        target.update({s: 3 * sizes[s] for s in over})
        open_ = [s for s in open_ if s not in over]
    taken, times = collections.Counter(), collections.Counter(tuple(r) for r in after)
    for r in after:
        taken[r.source] += size(r)
    assert all(abs(taken[s] - target[s]) <= 15 for s in names), (taken, target)
    have = collections.Counter(tuple(r) for r in before)
    assert set(times) <= set(have) and all(n <= 3 * have[r] for r, n in times.items())


def test_segmentations_decode_to_the_mixed_texts(spark, run):
    _, _, docs, place = run
    want = sorted((str(r.doc_id), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs[4].collect())
    got = docs[5].collect()
    assert sorted((str(r.doc_id), r.text_sha256) for r in got) == want and all(r.n_pieces == len(r.ids) for r in got)
    whole = corpus_pipeline.run(spark, place)
    assert plain(whole) == plain(docs[5])


def test_an_empty_table_runs_through(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "ids", "n_pieces", "text_sha256"] and out.where(F.lit(True)).count() == 0
