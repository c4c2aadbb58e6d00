"""Operators 1, 5 and 6, and the pipeline."""

import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF001
from sluice.llm import queries
from sluice.llm._tables import stored, table
from sluice.llm.ann import nearest
from sluice.llm.outliers import CONSISTENCY, CUTOFF, FLOOR, SHARE, STEPS, blend, robust_outliers
from sluice.llm.toxicity import LabelModel, drop_toxic, toxicity_scores, train

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---------------------------------------------------------------- nearest neighbours


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, v int, dim int, score double")


def test_nearest_on_awkward_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(k, rng.standard_normal(8).astype(float).tolist()) for k in range(1, 120)]
    rows += [(200 + k, rows[4][1]) for k in range(30)] + [(300, [0.0] * 8), (301, None), (302, [1.0] * 7 + [None]), (303, [float("nan")] * 8), (304, [float("inf")] + [1.0] * 7)]
    rows += [(None, [1.0] * 8), (20, rows[19][1]), (400, [2.0, 1.0]), (420, [1.0, 1.0]), (500, []), (440, [9.0] * 8)]
    df = vectors(spark, [(i, v, 0, 1, 2, 0.5) for i, v in rows])
    got = nearest(df, df.where("vec_id % 20 = 0"), k=20).collect()
    good = {i: np.float32(v).astype(float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    want = {}
    for q in [i for i in good if i % 20 == 0]:
        others = [(float((good[q] * x).sum()), i) for i, x in good.items() if i != q and len(x) == len(good[q])]
        want[q] = [i for _, i in sorted(others, key=lambda p: (-p[0], p[1]))[:20]]
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append(r.vec_id)
        assert r.score == pytest.approx(float((good[r.query_id] * good[r.vec_id]).sum()), abs=1e-12)
    assert by == {q: w for q, w in want.items() if w}  # so few rows are all verified
    assert nearest(df.limit(0), df.limit(0)).collect() == []


def test_recall_against_brute_force(spark):
    r = queries.QUERIES["op1_collision_counting_search"](spark, "/root/testdata/sf0.1").toPandas()
    t = table(spark, "/root/testdata/sf0.1", "embeddings").toPandas().sort_values("vec_id")
    x, ids = np.stack(t["embedding"]).astype(np.float64), t["vec_id"].to_numpy()
    hits = 0
    for q, g in r.groupby("query_id"):
        s = (x * x[np.searchsorted(ids, q)]).sum(axis=1)
        s[np.searchsorted(ids, q)] = -np.inf
        hits += len(set(g["vec_id"]) & set(ids[np.lexsort((ids, -s))[:20]]))
    assert hits / len(r) >= 0.9


def test_recall_and_work_on_full_shards(spark):
    """Two full shards, made of the given vectors with noise; also more neighbours than usual."""
    from sluice.llm import ann

    t = table(spark, "/root/testdata/sf0.1", "embeddings").toPandas().sort_values("vec_id")
    base = np.stack(t["embedding"]).astype(np.float64)
    rng = np.random.default_rng(4)
    x = np.concatenate([base + rng.normal(0, 0.05, base.shape) for _ in range(16)])
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    asked = rows.where("vec_id % 800 = 3")
    for k, least in ((20, 0.95), (400, 0.9)):
        got = nearest(rows, asked, k=k).toPandas()
        hits = 0
        for q, g in got.groupby("query_id"):
            s = x @ x[q]
            s[q] = -np.inf
            hits += len(set(g["vec_id"]) & set(np.argsort(-s)[:k].tolist()))
            assert len(g) == k
        assert hits / len(got) >= least and len(got) == 40 * k
    index = ann.SortedProjections(x[:16000], float(np.sqrt((x**2).sum(axis=1).max())), 17)
    found = index.candidates(x[16000:16020], int(ann.VERIFIED * 16000), ann.THRESHOLD)
    assert np.mean([len(f) for f in found]) < 0.09 * 16000


# ---------------------------------------------------------------- quality rules


def brute_stats(text):
    words = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    at = {}
    for j in range(len(words) - 2):
        at.setdefault(tuple(words[j : j + 3]), []).append(j)
    repeat = {j + d for v in at.values() if len(v) > 1 for j in v for d in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeat)


def quality_rows():
    rng = random.Random(7)
    words = [f"{a}{b}{c}" for a in "kltp" for b in ("o", "e", "ée") for c in ("n", "sing", "m", "日")]
    rows = []
    for k in range(260):
        text = ""
        for _ in range(rng.randint(55, 160)):
            text += rng.choice(words) + rng.choice([" "] * 9 + [".\n"])
        rows.append((k, text, ["en", "fr", None][k % 3], ["a", None][k % 2]))
    for k in range(12):
        rows.append((300 + k, " ".join(rng.choice(words) + rng.choice(["$$$", "###", "%%%"]) for _ in range(90)), "en", "a"))
    return rows + [(400, None, None, None), (401, "", "en", "a"), (None, "x " * 60, "en", "a"), (402, "Same line.\n" * 40, "fr", None), (403, "a b c d\n\n a b c \n \n", "en", "z"), (5, rows[5][1], "fr", None)]


def test_statistics_and_outliers(spark):
    rows = quality_rows()
    df = spark.createDataFrame([(*r, 1, 2.0, "x") for r in rows], "doc_id long, text string, lang string, source string, bin int, x0 double, grp string").repartition(3)
    got = robust_outliers(df).collect()
    key = lambda x: sorted(x, key=lambda t: tuple(-1 if v is None else v for v in t))
    assert key([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got]) == key([(i, *brute_stats(t)) for i, t, *_ in rows])
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[k] for k in range(260)) and not any(kept[300 + k] for k in range(12))
    assert robust_outliers(df.limit(0)).collect() == []


def test_repetition_alone_is_an_outlier():
    assert abs(CUTOFF - 20.515) < 1e-3 and abs(CONSISTENCY - 1.412) < 1e-3
    for floor, top in zip(FLOOR[3:], (1000, 500)):
        assert (math.log1p(top) / floor) ** 2 > CUTOFF


def test_outliers_in_duplicate_lines_or_repeated_words(spark):
    rng = random.Random(5)
    words = [f"{a}{b}{c}{d}" for a in "kltp" for b in "oeiu" for c in ("n", "sing", "m", "rd") for d in "aeiouxyz"]
    draw = lambda k: rng.sample(words, k)
    text = lambda lines: "\n".join(" ".join(x) for x in lines)
    cut = lambda w, n: [w[i : i + n] for i in range(0, len(w), n)]
    rows = [(k, text(cut(draw(rng.randint(100, 200)), 10))) for k in range(150)]
    for k in range(5):
        w = draw(150)
        short = cut(w[100:120], 1)
        lines = [y for x, z in zip(short, cut(w[:100], 5)) for y in (x, z)]
        rows.append((1000 + k, text(lines + [y for x, z in zip(short, cut(w[120:], 1) + cut(draw(10), 1)) for y in (x, z)])))  # duplicate lines alone
        w = draw(120)
        rows.append((2000 + k, text(cut(w + w[10:31] + draw(19), 7))))  # repeated words alone
        lines = cut(draw(90), 10)
        rows.append((3000 + k, text(lines + lines[:3])))  # a quarter of the lines
    got = {r.doc_id: r for r in robust_outliers(spark.createDataFrame([(*r, "en", "a") for r in rows], "doc_id long, text string, lang string, source string")).collect()}
    assert not any(r.base_failed for r in got.values()) and all(got[k].kept for k in range(150))
    assert all(got[1000 + k].n_dup_lines >= 20 and got[1000 + k].n_repeat_words == 0 for k in range(5))
    assert all(got[2000 + k].n_dup_lines == 0 and got[2000 + k].n_repeat_words > 40 for k in range(5))
    assert not any(got[n + k].kept for n in (1000, 2000, 3000) for k in range(5))


def plain_mcd(x):
    """Concentration steps on the exact distances: location and scatter of the nearest three quarters."""
    floor = np.diag(np.square(FLOOR))
    mu = np.median(x, axis=0)
    cov = np.diag((1.4826 * np.median(np.abs(x - mu), axis=0)) ** 2) + floor
    for _ in range(STEPS):
        d = np.einsum("ij,jk,ik->i", x - mu, np.linalg.inv(cov), x - mu)
        near = x[np.argsort(d, kind="stable")[: math.ceil(SHARE * len(x))]]
        mu = near.mean(axis=0)
        cov = CONSISTENCY * ((near - mu).T @ (near - mu) / len(near)) + floor
    return mu, cov


def test_verdicts_against_a_plain_estimate(spark):
    """Groups of 1 to 700 rows, half of one group in one language; distances and verdicts as by numpy."""
    docs = table(spark, "/root/testdata/sf0.1", "documents").where("doc_id % 3 = 0 OR source = 'src1'")
    got = robust_outliers(docs.select("doc_id", "text", "lang", F.when(F.col("doc_id") % 2 == 0, "hot").otherwise(F.col("source")).alias("source"))).toPandas().set_index("doc_id")
    rows = docs.select("doc_id", "lang", F.when(F.col("doc_id") % 2 == 0, "hot").otherwise(F.col("source")).alias("source")).toPandas().join(got, on="doc_id")
    rows = rows[~rows.base_failed].fillna({"lang": "?", "source": "?"})
    n = rows.n_words
    x = np.stack([np.log1p(n), rows.word_chars / n, *[np.log1p(1000 * rows[c] / n) for c in ("n_symbols", "n_dup_lines", "n_repeat_words")]], axis=1)
    whole = plain_mcd(x)
    langs = {k: (len(i), plain_mcd(x[i])) for k, i in rows.reset_index(drop=True).groupby("lang").indices.items()}
    far, worst = 0, []
    for (lang, _), i in rows.reset_index(drop=True).groupby(["lang", "source"]).indices.items():
        own = plain_mcd(x[i])
        mu, cov = (blend(len(i), own[k], blend(langs[lang][0], langs[lang][1][k], whole[k])) for k in (0, 1))
        want = np.einsum("ij,jk,ik->i", x[i] - mu, np.linalg.inv(cov), x[i] - mu)
        have = rows.distance.to_numpy()[i]
        far += ((want <= CUTOFF) != rows.kept.to_numpy()[i]).sum()
        worst += (np.abs(want - have) / (1 + want)).tolist()
    assert len(rows) > 2000 and far <= 0.01 * len(rows) and np.quantile(worst, 0.95) < 0.1


# ---------------------------------------------------------------- toxicity


def test_label_model_tells_accurate_from_random_voters():
    rng = np.random.default_rng(1)
    n, y = 20000, rng.random(20000) < 0.1
    fire = np.stack([rng.random(n) < np.where(y, p, q) for p, q in ((0.8, 0.01), (0.7, 0.01), (0.6, 0.02), (0.3, 0.3))], axis=1)
    fire = np.concatenate([fire, fire[:, :1]], axis=1)  # a voter that only repeats the first
    masks, counts = np.unique((fire << np.arange(5)).sum(axis=1), return_counts=True)
    start = 1 / (1 + np.exp(-(2 * np.bitwise_count(masks & 0b10111) - 3.0)))
    model = LabelModel(masks, counts, 5, start, 0.1)
    post = model.posterior((fire << np.arange(5)).sum(axis=1))
    assert ((post > 0.5) == y).mean() > 0.95
    assert (model.parent[4] == 0 or model.parent[0] == 4) and abs(model.posterior(np.array([8]))[0] - model.posterior(np.array([0]))[0]) < 0.1


def toxic_table(spark):
    rng = random.Random(3)
    words = [f"{a}{b}" for a in ("ba", "do", "ri", "lu", "se") for b in ("n", "mer", "ti", "kos", "vel")]
    rows, labels = [], []
    for k in range(400):
        text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        toxic = k % 8 == 0
        for _ in range(4 if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["idiot", "moron", "Scum,", "zzork" + rng.choice(words), "worthless"]))
        rows.append((k, " ".join(text)))
        labels.append((k, int(toxic)))
    rows += [(900, None), (901, ""), (None, "you idiot moron scum"), (902, "word " * 5000), (8, rows[8][1])]
    labels += [(None, 1), (777, 1), (3, None), (8, 0)]
    docs = spark.createDataFrame([(i, t, "en", 1, 0.5) for i, t in rows], "doc_id long, text string, lang string, mask int, score double")
    return docs, spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int")


def test_toxicity_held_out(spark):
    docs, labels = toxic_table(spark)
    model = train(docs, labels)
    got = toxicity_scores(docs, model).collect()
    assert len(got) == docs.count()
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    by = {r.doc_id: r.predicted for r in got}
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert np.mean([r.predicted == (r.doc_id % 8 == 0) for r in held]) > 0.95
    assert by[None] == 1 and by[900] == by[901] == by[902] == 0
    kept = drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(1 - r.predicted for r in got)


def test_toxicity_learns_nothing_from_held_out_labels(spark):
    docs, labels = toxic_table(spark)
    changed = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity_scores(docs, train(docs, x)).orderBy("doc_id", "score").collect() for x in (labels, changed))
    assert a == b


def test_an_id_with_many_texts_gives_one_to_the_sample(spark):
    docs, labels = toxic_table(spark)
    more = docs.unionByName(docs.where("doc_id = 3").crossJoin(spark.range(500)).withColumn("text", F.concat("text", F.lit(" copy "), "id")).drop("id"))
    sample = labels.count()
    a, b = (train(x, labels, sample=sample) for x in (more, more.repartition(7, F.rand(1))))
    np.testing.assert_array_equal(a.weights, b.weights)
    got = [{r.doc_id: r.predicted for r in toxicity_scores(docs, train(x, labels)).collect()} for x in (docs, more)]
    assert sum(got[0][k] != got[1][k] for k in got[0]) <= 0.01 * len(got[0])


def test_toxicity_without_labels_or_documents(spark):
    docs, labels = toxic_table(spark)
    got = {r.doc_id: r.predicted for r in toxicity_scores(docs, train(docs, labels.limit(0))).collect()}
    assert got[None] == 1 and got[901] == 0
    assert toxicity_scores(docs.limit(0), train(docs.limit(0), labels)).collect() == []


# ---------------------------------------------------------------- pipeline and queries


def test_pipeline_stages(spark):
    docs = table(spark, SF001, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**6, None, "en", None, 0), (10**6 + 1, "", None, "src1", 0)], docs.schema)
    docs = stored(docs.unionByName(odd).withColumn("size", F.lit(3)).withColumn("copies", F.lit("x")), "docs")
    columns, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stored(stage(spark, docs, SF001), name)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        if name == "line_dedup":
            assert out.count() == docs.count() and out.where("n_chars <> length(text)").count() == 0
        if name == "sentencepiece":
            assert out.count() == docs.count() > 0 and out.where("n_pieces <> size(ids)").count() == 0
        docs = out
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dup", "mixing", "sentencepiece"] and before > 200


def test_every_operator_is_registered():
    for n in range(1, 14):
        assert [q for q in queries.QUERIES if q.startswith(f"op{n}_")], n
