"""Toxicity by weak supervision.

Voters look at a document and vote for toxic, for clean, or not at all: a fixed list of insults, words and word beginnings that
labelled rows tie to toxic text (each of the strongest is a voter, the others vote as lexicons), and patterns of shouting and of address. A
generative label model, which sees votes only, estimates by expectation maximisation the share of toxic documents, how each voter votes
on either class, and correlations: each voter depends on the class and on the voter that it is most tied to within the classes. A logistic
classifier is then trained on the posterior labels and scores every text; neither of the two sees a label.

At scale: mining and fitting use at most ``sample_rows`` labelled rows, those with the smallest hashes; features are counted by
Spark with partial sums, and the driver gets a bounded number of them. Words that fewer than three toxic rows of the sample hold, or that
aren't e² times as common in toxic as in clean rows, are no voters. Scoring is one narrow pass over whole texts.

Defined cases: a null text is empty and gets the score of a text without features; rows without id are never training rows and are scored,
held_out null; repeated rows get equal scores; repeated labels of an id count as toxic if one is; a label other than 0 and 1 is none; without labelled rows of both
classes the fixed list alone decides; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import kept

FOLDS = 5
# Common insults of four languages.
INSULTS = frozenset(
    "idiot idiots moron morons stupid loser losers scum trash worthless pathetic disgusting clown clowns fool fools dumb jerk jerks "
    "imbecile filth filthy garbage vermin coward cowards liar liars ugly idiote imbécile crétin salaud connard ordure abruti "
    "dummkopf trottel arschloch abschaum versager blödmann idiota imbécil estúpido estúpida basura escoria payaso inútil".split()
)
_WORD = re.compile(r"\w+")
_PREFIXES = (4, 5, 6)
_VOTERS = 48  # features that vote on their own


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def _features(words: set[str]) -> set[str]:
    """Words, and beginnings of longer words: with ``*``, with ``**`` if two different words begin so, with ``***`` if three do."""
    begun = Counter(w[:k] for k in _PREFIXES for w in words if len(w) > k)
    return words | {head + "*" * n for head, count in begun.items() for n in range(1, min(count, 3) + 1)}


@dataclass(frozen=True)
class Model:
    """Weights by feature; the insult list and the patterns have features of their own."""

    bias: float
    weights: dict[str, float]

    def scorer(self):
        known = {f for f in self.weights if not f.startswith("#")}
        heads = {f[:4] for f in known}
        insults = self.weights.get("#insult", 0.0)

        def score(text: str) -> float:
            total = self.bias
            words = words_of(text)
            some = [w for w in words if w[:4] in heads]
            for f in sorted(_features(set(some)) & known):
                total += self.weights[f]
            if insults and words & INSULTS:
                total += insults
            return 1 / (1 + math.exp(-max(-700.0, min(700.0, total))))

        return score


_FALLBACK = Model(-3.0, {"#insult": 6.0})


def remainder() -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")), F.lit(FOLDS))


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, toxic) of the bounded sample of labelled rows outside the held-out fold."""
    drawn = labels.where("toxic in (0, 1) and doc_id is not null").where(remainder() != 0)
    drawn = drawn.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    # ``rows`` rows at most, so a broadcast is safe.
    drawn = F.broadcast(drawn.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # A copy of an id adds nothing; one hot id must not fill the sample.
    return kept(texts.join(drawn, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "toxicity-sample")


def _mine(sample: DataFrame, most: int) -> tuple[list[str], float]:
    """The features most tied to toxic rows, none if a class has no row; and the share of toxic rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bad, good, n = Counter(), Counter(), [0, 0]
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n[toxic] += 1
                (bad if toxic else good).update(_features(words_of(text)))
        # Only what some toxic row of the task has can be tied to toxic rows; the clean counts of the others are needed all the same.
        names = [*(bad | good), ""]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array([*(bad[f] for f in names[:-1]), n[1]], pa.int64()), pa.array([*(good[f] for f in names[:-1]), n[0]], pa.int64())],
            names=["feature", "bad", "good"],
        )

    counts = sample.select("text", "toxic").repartition(max(2, sample.sparkSession.sparkContext.defaultParallelism)).mapInArrow(count, "feature string, bad long, good long")
    counts = kept(counts.groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "toxicity-features")
    n = counts.where("feature = ''").first()
    if n is None or not n.bad or not n.good:
        return [], 0.0
    lift = F.log((F.col("bad") + 0.5) / (n.bad + 1.0)) - F.log((F.col("good") + 0.5) / (n.good + 1.0))
    found = counts.where("feature != ''").where(F.col("bad") >= 3).withColumn("lift", lift).where("lift >= 2")
    found = found.orderBy(F.desc(F.col("bad") * F.col("lift")), "feature").limit(most).collect()
    return [r.feature for r in found], n.bad / (n.bad + n.good)


def _rows_of(sample: DataFrame, features: list[str]) -> list[tuple[list[int], bool, bool, bool]]:
    """Per sample row its mined features by number, and whether it holds an insult, an address, and shouting."""
    number = {f: i for i, f in enumerate(features)}

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                own = sorted(number[f] for f in _features(words) if f in number)
                upper = sum(c.isupper() for c in text)
                rows.append((own, bool(words & INSULTS), bool(words & {"you", "your", "du", "dich", "tu", "toi", "vous", "usted"}), 2 * upper > sum(c.isalpha() for c in text) > 0))
            kinds = [pa.list_(pa.int32()), pa.bool_(), pa.bool_(), pa.bool_()]
            columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 4
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["own", "insult", "address", "shout"])

    # At most ``sample_rows`` rows of a few numbers each.
    rows = sample.select("text").mapInArrow(look, "own array<int>, insult boolean, address boolean, shout boolean")
    return sorted(tuple(r) for r in rows.collect())


def _votes(rows: list[tuple[list[int], bool, bool, bool]], x: np.ndarray, mined: list[str]) -> np.ndarray:
    """A column of votes per voter: the strongest features, two lexicons of the others, the insults, the patterns, and the lack of all features."""
    lexicons = [[i for i in range(_VOTERS, len(mined)) if mined[i].endswith("*") == begins] for begins in (False, True)]
    any_mined = x.any(1)
    columns = [x[:, i] for i in range(min(_VOTERS, len(mined)))] + [x[:, i].any(1) for i in lexicons if i]
    columns += [x[:, -1], *([np.array([r[k] for r in rows]) & any_mined for k in (2, 3)])]
    return np.stack([np.where(c, 1, 0) for c in columns] + [np.where(any_mined, 0, -1)], 1)


def label_model(votes: np.ndarray, share: float, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of class 1 for each row of ``votes`` (1 toxic, -1 clean, 0 none; a column per voter), and the voter that each voter depends
    on (-1: none).

    Expectation maximisation of P(vote | class) from the ``share`` of rows with the most votes for toxic. From its posterior, the dependencies
    between voters and P(vote | class, vote of the other voter) are estimated, and give the posterior that counts. (Going on from
    there, the classes drift to whatever explains most votes; so they do in the first pass if copies of one bad voter outnumber the others.)
    """
    code = votes.astype(np.int64) + 1
    rows, voters = code.shape
    hits = np.zeros((rows, 3 * voters), np.float32)
    hits[np.arange(rows)[:, None], 3 * np.arange(voters) + code] = 1
    ayes = (code == 2).sum(1)
    cut = np.sort(ayes)[::-1][min(rows - 1, int(share * rows))]
    post = np.where(ayes >= max(cut, 1), 0.9, 0.1)
    alone = np.full(voters, -1)
    for _ in range(rounds):
        new = _posterior(code, hits, post, alone)
        done = np.abs(new - post).max() < 1e-4
        post = new
        if done:
            break
    parent = _dependencies(hits, post)
    return _posterior(code, hits, post, parent), parent


def _posterior(code: np.ndarray, hits: np.ndarray, post: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """The posterior under the parameters that the posterior ``post`` gives."""
    share = min(max(post.mean(), 1e-4), 1 - 1e-4)
    odds = np.full(len(code), math.log(share / (1 - share)))
    for sign, joint in zip((-1, 1), _together(hits, post), strict=True):
        for j, other in enumerate(parent.tolist()):
            own = joint[j, :, j].diagonal() + 0.1
            own = own / own.sum()
            if other < 0:
                odds += sign * np.log(own)[code[:, j]]
            else:
                given = joint[other, :, j] + own
                odds += sign * np.log(given / given.sum(1, keepdims=True))[code[:, other], code[:, j]]
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def _together(hits: np.ndarray, post: np.ndarray) -> list[np.ndarray]:
    """For either class, how often voter i votes a and voter j votes b, by [i, a, j, b]."""
    voters = hits.shape[1] // 3
    return [((hits * w[:, None].astype(np.float32)).T @ hits).astype(np.float64).reshape(voters, 3, voters, 3) for w in (1 - post, post)]


def _dependencies(hits: np.ndarray, post: np.ndarray, least: float = 0.005) -> np.ndarray:
    """The tree of voters with the greatest information about each other within the classes; ties below ``least`` nats are left out."""
    voters, shared = hits.shape[1] // 3, 0.0
    for joint in _together(hits, post):
        own = np.einsum("iaia->ia", joint)
        total = max(own[0].sum(), 1e-9)
        expected = own[:, :, None, None] * own[None, None] / total
        with np.errstate(divide="ignore", invalid="ignore"):
            part = np.where(joint > 0, joint * np.log(joint / expected), 0.0)
        shared = shared + part.sum((1, 3)) / len(hits)
    parent, best, near = np.full(voters, -1), np.full(voters, -np.inf), np.full(voters, -1)
    left = set(range(voters))
    while left:
        j = max(left, key=lambda i: (best[i], -i))
        left.remove(j)
        if best[j] >= least:
            parent[j] = near[j]
        closer = [i for i in left if shared[i, j] > best[i]]
        best[closer], near[closer] = shared[closer, j], j
    return parent


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (the last is the bias) for soft labels ``y``, by Newton steps with a ridge."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, features: int = 400) -> Model:
    """Voters, label model and classifier from the labelled rows outside the held-out fold."""
    sample = _sample(docs, labels, sample_rows)
    mined, share = _mine(sample, features)
    if not mined:
        return _FALLBACK
    rows = _rows_of(sample, mined)
    x = np.zeros((len(rows), len(mined) + 1), np.float32)
    for r, (own, insult, *_) in enumerate(rows):
        x[r, own] = 1
        x[r, -1] = insult
    posterior, _ = label_model(_votes(rows, x, mined), share)
    w = _logistic(x, posterior)
    return Model(float(w[-1]), dict(zip([*mined, "#insult"], map(float, w[:-1]), strict=True)))


def score(docs: DataFrame, model: Model, others: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``others``, then score and predicted of every text."""
    frame = docs.select(*others, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    names = [*others, "score", "predicted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = model.scorer()
        for batch in batches:
            scores = [one(t) for t in batch.column(len(others)).to_pylist()]
            predicted = pa.array([int(s >= 0.5) for s in scores], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64()), predicted], names=names)

    return frame.mapInArrow(run, frame.drop("text").schema.add("score", "double").add("predicted", "integer"))


def toxicity(docs: DataFrame, labels: DataFrame, **options: int) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = fit(docs, labels, **options)
    out = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return out.select("doc_id", (remainder() == 0).alias("held_out"), "score", "predicted")


def without_toxic(docs: DataFrame, labels: DataFrame, **options: int) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, whatever other columns they have."""
    model = fit(docs, labels, **options)
    names = list(docs.columns)
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = model.scorer()
        for batch in batches:
            yield batch.filter(pa.array([one(t or "") < 0.5 for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
