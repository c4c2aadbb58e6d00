"""Toxicity by weak supervision (operator 6).

Voters look at one text each and either vote toxic or abstain: lexicons of insults written down here,
patterns of the writing, and lexicons of word beginnings and words that labelled training rows show
to go with toxic texts. A generative label model, fitted by expectation maximisation on the votes of
all documents, estimates how often each voter fires on toxic and on clean texts; correlated voters
are linked in a tree (largest mutual information), each depending on its parent and the label, so that
voters which repeat each other don't count twice. A text's posterior under that model is the label
a linear classifier over hashed words, word beginnings and votes is trained on.

What is learnt from: votes of all documents (at most 2^V rows of counts reach the driver), and a
bounded, seeded sample of ``SAMPLE`` labelled training rows for the learnt lexicons, the label model's
start and the classifier. Scores use the text alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import _BASE, _BYTE_LOWER, Words, chunk_bounds, mix
from ._worker import release

SAMPLE = 6000
BITS = 18
BEGINNINGS = (3, 4, 5, 6, 8)
TIMES = (2, 3, 5)
LOW = (1 << BITS) - 1
LEARNT_VOTERS = 6
LEARNT_EACH = 24

#: Fixed lists of common insults and slurs on a person's worth, a voter each.
LEXICONS = {
    "mind": "idiot idiots moron morons stupid dumb imbecile fool fools dimwit cretin",
    "worth": "worthless loser losers pathetic useless failure nobody",
    "contempt": "scum trash garbage filth vermin parasite lowlife",
    "disgust": "disgusting repulsive vile gross revolting nasty",
    "mockery": "clown clowns joke laughable ridiculous buffoon",
    "other": "idiota imbécil estúpido basura asqueroso idiot dumm abschaum widerlich wertlos crétin stupide ordure minable",
}
PATTERNS = ("shouting", "symbols")
_MARK, _SYMBOL = np.zeros(256, bool), np.zeros(256, bool)
_MARK[list(b".,;:!?\"')(]}*#$%&|")] = True
_SYMBOL[list(b"#$%&*|")] = True


def pairs(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of every word of a chunk, repeats included: hashes of the lower-cased words
    (up to three marks such as commas cut off their ends) and of their first bytes."""
    n = len(words.starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data, ends = words.data, words.ends.copy()
    for _ in range(3):
        cut = _MARK[data[ends - 1]] & (ends - words.starts > 1)
        ends[cut] -= 1
    lengths = ends - words.starts
    doc = words.doc_of_word()
    out = [(doc, words.hashes(lower=True, ends=ends))]
    value = np.zeros(n, np.uint64)
    for j in range(max(BEGINNINGS)):
        value = value * _BASE + _BYTE_LOWER[data[np.minimum(words.starts + j, len(data) - 1)]]
        if j + 1 in BEGINNINGS:
            at = np.flatnonzero(lengths > j + 1)
            out.append((doc[at], mix(value[at] + np.uint64(j + 1))))
    doc = np.concatenate([d for d, _ in out])
    return doc, np.concatenate([(f >> np.uint64(64 - BITS)).astype(np.int64) for _, f in out])


def often(feature: np.ndarray, times: int) -> np.ndarray:
    """Number of the feature that a text holds ``feature`` so many times."""
    return (feature * 2654435761 + times * 40503) & LOW


def distinct(doc: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, feature) pairs in order, with those that say a text repeats a feature."""
    both, times = np.unique(doc << BITS | feature, return_counts=True)
    more = [both]
    for k in TIMES:
        at = both[times >= k]
        more.append(at >> BITS << BITS | often(at & LOW, k))
    both = np.sort(np.concatenate(more))
    both = both[np.diff(both, prepend=-1) > 0]
    return both >> BITS, both & LOW


def word_features(lexicon: str) -> np.ndarray:
    """Feature numbers of the whole words of a lexicon."""
    hashes = Words(pa.array([lexicon])).hashes(lower=True)
    return np.unique((hashes >> np.uint64(64 - BITS)).astype(np.int64))


class Voters:
    """The lexicons' features by voter; only pairs that can matter are sorted."""

    def __init__(self, lexicons: list[np.ndarray]):
        self.n = len(lexicons)
        self.voter = np.zeros(1 << BITS, np.int64)
        for k, own in enumerate(lexicons):
            self.voter[own] |= 1 << k
        every = np.arange(1 << BITS)
        self.matters = self.voter != 0
        for k in TIMES:
            self.matters |= self.voter[often(every, k)] != 0

    def votes(self, words: Words, doc: np.ndarray, feature: np.ndarray) -> np.ndarray:
        """One bit a voter for each document of the chunk, from its pairs."""
        n = len(words.doc_at) - 1
        mask = np.zeros(n, np.int64)
        at = self.matters[feature]
        own, feature = distinct(doc[at], feature[at])
        np.bitwise_or.at(mask, own, self.voter[feature])
        upper = (words.data >= 65) & (words.data <= 90)
        lower = (words.data >= 97) & (words.data <= 122)
        rows = [np.diff(np.concatenate(([0], np.cumsum(x)))[words.doc_at]) for x in (upper, lower, _SYMBOL[words.data])]
        mask |= (rows[0] > rows[1]).astype(np.int64) << self.n
        mask |= (rows[2] > words.counts()).astype(np.int64) << (self.n + 1)
        return mask


def _each(batches):
    for batch in batches:
        texts = batch.column(1)
        for lo, hi in chunk_bounds(texts):
            words = Words(texts.slice(lo, hi - lo))
            yield batch.slice(lo, hi - lo), words, *pairs(words)


def _sample_rows(batches):
    none = Voters([])
    for part, words, doc, feature in _each(batches):
        base = none.votes(words, doc, feature)
        doc, feature = distinct(doc, feature)
        at = np.searchsorted(doc, np.arange(part.num_rows + 1))
        yield pa.RecordBatch.from_arrays(
            [part.column(2), pa.array(base), pa.array([feature[i:j].astype(np.int32).tobytes() for i, j in zip(at[:-1], at[1:])], pa.binary())], ["toxic", "patterns", "features"]
        )


def _mask_rows(lexicons):
    def run(batches):
        voters = Voters(lexicons)
        for part, words, doc, feature in _each(batches):
            yield pa.RecordBatch.from_arrays([pa.array(voters.votes(words, doc, feature))], ["mask"])

    return run


def _score_rows(model):
    def run(batches):
        for part, words, doc, feature in _each(batches):
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), part.column(2), pa.array(model.score(words, doc, feature))], ["doc_id", "held_out", "score"])

    return run


# ---------------------------------------------------------------- label model


class LabelModel:
    """Votes given the label: each voter depends on the label and on its parent in a tree."""

    def __init__(self, masks: np.ndarray, counts: np.ndarray, n_voters: int, start: np.ndarray, prior: float, rounds: int = 30):
        bits = (masks[:, None] >> np.arange(n_voters)) & 1
        weight = counts.astype(np.float64)
        self.parent = self._tree(bits, weight * start)
        self.n, self.prior = n_voters, prior
        post = start
        for _ in range(rounds):
            self._learn(bits, weight, post)
            post = self.posterior(masks)

    @staticmethod
    def _tree(bits, weight) -> list[int]:
        """Maximum spanning tree over the voters' mutual information on texts that seem toxic."""
        n = bits.shape[1]
        total = weight.sum() + 4e-3
        gain = np.zeros((n, n))
        for i in range(n):
            for j in range(n):
                for x in (0, 1):
                    for y in (0, 1):
                        p = (weight[(bits[:, i] == x) & (bits[:, j] == y)].sum() + 1e-3) / total
                        px, py = ((weight[bits[:, k] == v].sum() + 2e-3) / total for k, v in ((i, x), (j, y)))
                        gain[i, j] += p * np.log(p / (px * py))
        parent, inside = [-1] * n, {0}
        while len(inside) < n:
            i, j = max(((i, j) for i in inside for j in range(n) if j not in inside), key=lambda e: gain[e])
            parent[j] = i
            inside.add(j)
        return parent

    def _learn(self, bits, weight, post):
        self.table = np.zeros((self.n, 2, 2))  # P(vote | label, parent's vote)
        for label, w in ((0, weight * (1 - post)), (1, weight * post)):
            for k, p in enumerate(self.parent):
                for v in (0, 1):
                    on = w if p < 0 else w * (bits[:, p] == v)
                    # a vote counts for toxic: voters are taken to be right more often than not
                    self.table[k, label, v] = ((on * bits[:, k]).sum() + (0.5 if label else 0.01)) / (on.sum() + 1.0)
        self.prior = float(np.clip((weight * post).sum() / weight.sum(), 1e-4, 0.5))

    def posterior(self, masks: np.ndarray) -> np.ndarray:
        bits = (masks[:, None] >> np.arange(self.n)) & 1
        log = np.zeros((2, len(masks)))
        for label in (0, 1):
            for k, p in enumerate(self.parent):
                at = self.table[k, label][bits[:, p] if p >= 0 else np.zeros(len(masks), np.int64)]
                log[label] += np.log(np.where(bits[:, k] == 1, at, 1 - at))
        return 1 / (1 + np.exp(np.clip(log[0] - log[1] + np.log((1 - self.prior) / self.prior), -500, 500)))


# ---------------------------------------------------------------- classifier


def _blocks(sizes: np.ndarray, most: int = 1 << 21) -> list[tuple[int, int]]:
    """Ranges of texts with about ``most`` features, so that work space does not grow with the sample."""
    block = np.cumsum(sizes) // most
    border = np.flatnonzero(np.diff(block)) + 1
    return list(zip([0, *border.tolist()], [*border.tolist(), len(sizes)])) if len(sizes) else []


class Classifier:
    """Logistic regression over votes and distinct hashed features."""

    def __init__(self, lexicons, n_voters):
        self.lexicons, self.n_voters, self.voters = lexicons, n_voters, Voters(lexicons)
        self.weights, self.vote_weights, self.bias = np.zeros(1 << BITS), np.zeros(n_voters), 0.0

    def fit(self, docs: list[np.ndarray], masks: np.ndarray, target: np.ndarray, rounds: int = 150, decay: float = 2e-3):
        n = len(docs)
        sizes = np.array([len(x) for x in docs], np.int64)
        scale = 1 / np.sqrt(np.maximum(sizes, 1))
        parts = [(slice(lo, hi), np.concatenate(docs[lo:hi])) for lo, hi in _blocks(sizes)]
        vote = ((masks[:, None] >> np.arange(self.n_voters)) & 1).astype(np.float64)
        self.bias = float(np.log(max(target.mean(), 1e-4) / max(1 - target.mean(), 1e-4))) if n else -3.0
        speed = [np.zeros_like(self.weights), np.zeros_like(self.vote_weights), 0.0]
        for k in range(rounds if n else 0):
            error, pull = np.zeros(n), decay * 0.01 * self.weights
            for at, column in parts:
                row = np.repeat(np.arange(at.stop - at.start), sizes[at])
                z = np.bincount(row, self.weights[column], at.stop - at.start) * scale[at] + vote[at] @ self.vote_weights + self.bias
                error[at] = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - target[at]) / n
                pull = pull + np.bincount(column, (error * scale)[at][row], 1 << BITS)
            slope = [pull, vote.T @ error + decay * self.vote_weights, error.sum()]
            rate = 8.0
            speed = [0.9 * s - rate * g for s, g in zip(speed, slope)]
            self.weights, self.vote_weights, self.bias = self.weights + speed[0], self.vote_weights + speed[1], self.bias + speed[2]
        self.weights, self.vote_weights = self.weights.astype(np.float32), self.vote_weights.astype(np.float64)

    def score(self, words: Words, doc: np.ndarray, feature: np.ndarray) -> np.ndarray:
        """Scores of a chunk's documents from all its pairs."""
        n = len(words.doc_at) - 1
        mask = self.voters.votes(words, doc, feature)
        doc, feature = distinct(doc, feature)
        size = np.bincount(doc, minlength=n)
        z = np.bincount(doc, self.weights[feature], n) / np.sqrt(np.maximum(size, 1))
        z = z + ((mask[:, None] >> np.arange(self.n_voters)) & 1) @ self.vote_weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def learnt_lexicons(docs: list[np.ndarray], toxic: np.ndarray) -> list[np.ndarray]:
    """Features that go with toxic training texts most surely (log-odds over its deviation), dealt to
    ``LEARNT_VOTERS`` voters in turn."""
    count = np.zeros((2, 1 << BITS), np.int64)
    for label in (0, 1):
        own = [x for x, t in zip(docs, toxic) if t == label]
        for lo, hi in _blocks(np.array([len(x) for x in own], np.int64)):
            count[label] += np.bincount(np.concatenate(own[lo:hi]), minlength=1 << BITS)
    n = [max(int((toxic == label).sum()), 1) for label in (0, 1)]
    odds = np.log((count[1] + 0.05) / (n[1] - count[1] + 1)) - np.log((count[0] + 0.05) / (n[0] - count[0] + 1))
    surety = odds / np.sqrt(1 / (count[1] + 0.5) + 1 / (count[0] + 0.5))
    sure = np.flatnonzero((count[1] >= 5) & (count[1] * n[0] > 25 * count[0] * n[1]))
    sure = sure[np.argsort(-surety[sure], kind="stable")][: LEARNT_VOTERS * LEARNT_EACH]
    return [sure[k::LEARNT_VOTERS] for k in range(LEARNT_VOTERS)]


def held_out(id_col: str):
    """Rows that nothing is learnt from: crc32 of the id's text is a multiple of five; a null id too."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Classifier:
    """Fit voters, label model and classifier. A row labelled twice counts as toxic if one label says
    so, and an id with several texts gives its least one to the sample; null labels and labels without a
    document don't count. Without any label only the written
    lexicons and patterns vote; without any document every score is low."""
    known = labels.where(F.col("toxic").isNotNull() & ~held_out("doc_id")).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = known.orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    single = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))  # at most ``sample`` rows
    rows = single.select("doc_id", "text", "toxic").mapInArrow(_sample_rows, "toxic int, patterns long, features binary").collect()
    rows = sorted(rows, key=lambda r: (bytes(r["features"]), r["toxic"]))
    own = [np.frombuffer(r["features"], np.int32) for r in rows]
    toxic = np.array([r["toxic"] for r in rows], np.int64)
    lexicons = [word_features(x) for x in LEXICONS.values()] + learnt_lexicons(own, toxic)
    n_voters = len(lexicons) + len(PATTERNS)
    counted = texts.mapInArrow(_mask_rows(lexicons), "mask long").groupBy("mask").count().collect()  # at most 2^n_voters rows
    masks = np.array([r["mask"] for r in counted], np.int64)
    counts = np.array([r["count"] for r in counted], np.int64)
    lexical = (1 << len(lexicons)) - 1
    fired = np.bitwise_count(masks & lexical).astype(np.float64)
    start = 1 / (1 + np.exp(-(2 * fired - 3)))
    prior = float(np.clip(toxic.mean(), 0.01, 0.5)) if len(toxic) else 0.05
    model = Classifier(lexicons, n_voters)
    if not len(masks):
        model.fit([], np.zeros(0, np.int64), np.zeros(0))
        return model
    label_model = LabelModel(masks, counts, n_voters, start, prior)
    voter = model.voters.voter
    sample_masks = np.array([int(np.bitwise_or.reduce(voter[x])) if len(x) else 0 for x in own], np.int64) | (np.array([r["patterns"] for r in rows], np.int64) << len(lexicons))
    model.label_model = label_model
    model.fit(own, sample_masks, label_model.posterior(sample_masks) if len(own) else np.zeros(0))
    if not len(own):  # nothing to train on: the label model's own votes
        model.vote_weights = np.where(np.arange(n_voters) < len(lexicons), 3.0, 0.0)
        model.bias = -2.0
    return model


def toxicity_scores(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row. A null or empty text has no vote and gets the
    score of the bias. Other columns are not read; repeated rows score alike."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), held_out(id_col).alias("held_out"))
    scored = rows.mapInArrow(_score_rows(model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: Classifier, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``; all columns stay as they are."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for lo, hi in chunk_bounds(batch.column(at)):
                words = Words(batch.column(at).slice(lo, hi - lo))
                keep = model.score(words, *pairs(words)) < threshold
                yield batch.slice(lo, hi - lo).filter(pa.array(keep))
        release()

    return docs.mapInArrow(run, docs.schema)
