"""Toxicity by weak supervision: many voters, a label model, a linear classifier.

1. Voters. Words and word beginnings that are far more common in texts labelled toxic become
   lexicon and pattern voters; each votes or abstains on a text.
2. Label model. A generative model of the votes is fitted to all texts, without their labels,
   from the voters' means and covariances: given the class, votes are independent but for
   pairs whose covariance the class does not explain. It gives each voter's rates in toxic and
   clean texts and the correlations, which lower the weight of votes that repeat each other.
3. Classifier. A logistic regression on the votes is trained on the model's posterior labels, over
   all patterns of votes, each weighted by the number of texts that have it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefetch.llm.common import held_out, lists, narrow_batches, plain_words, settle, ship_package, utf8
from tidefetch.llm.rule_ensemble import labelled

#: Labelled rows that are learnt from at most, the first by a hash of their ids.
MOST_ROWS = 20_000
#: Steps of the classifier's fit at most, each one pass over the patterns of votes.
MOST_STEPS = 20
MOST_VOTERS = 160
#: Lengths of word beginnings, in bytes.
BEGINNINGS = (4, 5, 6, 7)
#: Toxic texts that must have a voter, at least, and their share; how much likelier it must be there.
LEAST_TEXTS = 5
LEAST_SHARE = 0.01
LEAST_RATIO = 60.0
#: Correlation from which two voters are taken for the same one when the model is fitted.
SAME = 0.5
#: Residual correlation from which two votes on a text count as dependent.
DEPENDENT = 0.1
#: Remainder of crc32(doc_id) by 5 whose labels are never learnt from.
HELD_OUT = (5, 0)


def _signs(words: list[bytes]) -> set[bytes]:
    """Words, each ended by a space, and beginnings of words."""
    distinct = set(words)
    found = {w + b" " for w in distinct}
    for n in BEGINNINGS:
        found.update(w[:n] for w in distinct if len(w) >= n)
    return found


def _count_signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for texts, ys in narrow_batches(batches, ("text", "y")):
        counts: dict[bytes, list[int]] = {}
        for text, y in zip(utf8(texts), ys.to_pylist()):
            for sign in _signs(plain_words(text) if text else []):
                counts.setdefault(sign, [0, 0])[y > 0] += 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(counts), pa.binary()),
                pa.array([c[1] for c in counts.values()], pa.int64()),
                pa.array([c[0] for c in counts.values()], pa.int64()),
            ],
            ["sign", "toxic", "clean"],
        )


def choose_voters(train: DataFrame, most: int = MOST_VOTERS) -> list[bytes]:
    """Voters from rows of text and y: the most telling signs, at most ``most``.

    A sign that begins a chosen one, or begins with it, is left out if that was found in nearly
    as many toxic texts. Copies of a text count once.
    """
    train = train.dropDuplicates(["text"])
    toxic, clean = train.agg(
        F.coalesce(F.sum("y"), F.lit(0.0)), F.coalesce(F.sum(1 - F.col("y")), F.lit(0.0))
    ).first()
    if not toxic or not clean:
        return []
    rate = (F.col("toxic") + 0.5) / (toxic + 1)
    ratio = rate / ((F.col("clean") + 0.5) / (clean + 1))
    # How far the count in toxic texts is from what the clean ones' rate makes likely.
    expected = (F.col("clean") + 0.5) * (toxic / clean)
    strength = (F.col("toxic") - expected) / F.sqrt(F.col("toxic") + expected)
    rows = (
        train.mapInArrow(_count_signs, "sign binary, toxic long, clean long")
        .groupBy("sign")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= max(LEAST_TEXTS, LEAST_SHARE * toxic))
        .where(ratio >= LEAST_RATIO)
        .orderBy(strength.desc(), F.length("sign"), "sign")
        .limit(4 * most)
        .collect()
    )
    chosen: list[tuple[bytes, int]] = []
    for sign, in_toxic, _ in rows:
        sign = bytes(sign)
        if not any(
            abs(in_toxic - n) < LEAST_TEXTS and (sign.startswith(other) or other.startswith(sign)) for other, n in chosen
        ):
            chosen.append((sign, in_toxic))
    return [sign for sign, _ in chosen[:most]]


def _vote(voters: list[bytes]):
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of = {v[:-1]: i for i, v in enumerate(voters) if v.endswith(b" ")}
        starts = {v: i for i, v in enumerate(voters) if not v.endswith(b" ")}
        lengths = sorted({len(v) for v in starts})
        memory: dict[bytes, tuple[int, ...]] = {}
        for ids, texts in narrow_batches(batches, ("doc_id", "text")):
            votes = []
            for text in utf8(texts):
                got: set[int] = set()
                for word in set(plain_words(text)) if text else ():
                    found = memory.get(word)
                    if found is None:
                        hits = [starts[word[:n]] for n in lengths if word[:n] in starts]
                        hits += [words_of[word]] if word in words_of else []
                        if len(memory) > 400_000:
                            memory.clear()
                        found = memory[word] = tuple(hits)
                    if found:
                        got.update(found)
                votes.append(np.asarray(sorted(got), np.int32))
            yield pa.RecordBatch.from_arrays([ids, lists(votes, pa.int32())], ["doc_id", "votes"])

    return vote


def _matrix(votes: pa.Array, n: int) -> np.ndarray:
    flat, ends = votes.flatten().to_numpy(), votes.offsets.to_numpy()
    out = np.zeros((len(votes), n))
    out[np.repeat(np.arange(len(votes)), np.diff(ends)), flat] = 1
    return out


def _moments(n: int):
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((n, n)), 0
        for (votes,) in narrow_batches(batches, ("votes",)):
            for at in range(0, len(votes), 4000):
                x = _matrix(pa.array(votes.slice(at, 4000).to_pylist(), pa.list_(pa.int32())), n)
                total += x.T @ x
                count += len(x)
        yield pa.RecordBatch.from_arrays(
            [lists([total.ravel()], pa.float64()), pa.array([count], pa.int64())], ["together", "n"]
        )

    return moments


@dataclass(frozen=True)
class LabelModel:
    """Each voter's rate in toxic and clean texts, the correlations that the class does not
    explain, and the share of toxic texts."""

    toxic: np.ndarray
    clean: np.ndarray
    correlation: np.ndarray
    prior: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """How likely texts are toxic. A vote counts less, the more it depends on others cast.

        An abstention says nothing: most voters know one language or one word only.
        """
        weight = votes / (1 + votes @ self.correlation)
        logit = math.log(self.prior / (1 - self.prior)) + weight @ np.log(self.toxic / self.clean)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit_label_model(together: np.ndarray, n: int, prior: float) -> LabelModel:
    """Rates and correlations from how often each two voters vote together in ``n`` texts.

    Given the class, the covariance of two independent voters is the product of two factors,
    one of each. The factors are fitted to pairs that vote together more often than chance;
    pairs that do not know the same texts, and pairs that are nearly one voter, tell nothing
    of them. What the product leaves of the correlation is dependence.
    """
    second = together / n
    mean = np.diag(second).copy()
    variance = np.maximum(mean * (1 - mean), 1e-12)
    spread = np.sqrt(np.outer(variance, variance))
    cov = second - np.outer(mean, mean)
    telling = (cov > 0) & (cov < SAME * spread)
    np.fill_diagonal(telling, False)
    factor = np.sqrt(variance) * 0.5
    for _ in range(200):
        divisor = (telling * factor**2).sum(1)
        fitted = np.where(divisor > 0, (telling * cov * factor).sum(1) / np.maximum(divisor, 1e-15), factor)
        factor = 0.5 * factor + 0.5 * fitted
    scale = math.sqrt(prior * (1 - prior))
    floor = 0.5 / n
    toxic = np.clip(mean + (1 - prior) * factor / scale, floor, 1 - 1e-3)
    clean = np.minimum(np.clip(mean - prior * factor / scale, floor, 1 - 1e-3), toxic)
    residual = (cov - np.outer(factor, factor)) / spread
    correlation = np.where(residual > DEPENDENT, np.minimum(residual, 1), 0)
    np.fill_diagonal(correlation, 0)
    return LabelModel(toxic, clean, correlation, prior)


def _slopes(model: LabelModel, weights: np.ndarray):
    """The gradient and the second derivatives of the classifier's loss, summed over a task's patterns."""

    def slopes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(weights)
        total = np.zeros(size + size * size)
        for votes, counts in narrow_batches(batches, ("votes", "n")):
            for at in range(0, len(votes), 4000):
                x = _matrix(pa.array(votes.slice(at, 4000).to_pylist(), pa.list_(pa.int32())), size - 1)
                n = counts.slice(at, 4000).to_numpy().astype(float)
                p = model.posterior(x)
                x = np.hstack([x, np.ones((len(x), 1))])
                q = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
                total[:size] += x.T @ (n * (q - p))
                total[size:] += ((x * (n * np.maximum(q * (1 - q), 1e-6))[:, None]).T @ x).ravel()
        yield pa.RecordBatch.from_arrays([lists([total], pa.float64())], ["sums"])

    return slopes


def _added(sums: DataFrame, size: int) -> np.ndarray:
    """The sum of one array of fixed size for each task; added up in Spark before the driver sees it."""
    total = np.zeros(size)
    for cell, value in sums.select(F.posexplode("sums").alias("cell", "v")).groupBy("cell").agg(F.sum("v")).collect():
        total[cell] = value
    return total


def fit_classifier(patterns: DataFrame, model: LabelModel, texts: int, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic regression on posterior labels, the bias last, by Newton steps.

    ``patterns`` is a written table of votes and n, the number of texts that vote so. Each step
    reads it once, so the fit rests on all texts, whatever their number.
    """
    size = len(model.toxic) + 1
    weights, penalty = np.zeros(size), np.full(size, ridge * texts / 1000 + 1e-6)
    penalty[-1] = 1e-9
    for _ in range(MOST_STEPS):
        total = _added(patterns.mapInArrow(_slopes(model, weights), "sums array<double>"), size + size * size)
        gradient = total[:size] + penalty * weights
        step = np.linalg.solve(total[size:].reshape(size, size) + np.diag(penalty), gradient)
        largest = np.abs(step).max()
        weights -= step * min(1.0, 4 / max(largest, 1e-9))
        if largest < 1e-4:
            break
    return weights


def _score(weights: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, votes in narrow_batches(batches, ("doc_id", "votes")):
            x = _matrix(pa.array(votes.to_pylist(), pa.list_(pa.int32())), len(weights) - 1)
            logit = x @ weights[:-1] + weights[-1]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(1 / (1 + np.exp(-np.clip(logit, -30, 30))))], ["doc_id", "score"]
            )

    return score


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Words are lower-cased (A-Z only) runs of ASCII letters, digits and characters beyond
    ASCII; null and empty texts get no votes. Rows that repeat are scored alike; a null
    doc_id has no label and is not held out. Labels of one kind only, or none, give all texts
    the smoothed mean of the labels. Other columns play no part.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    known = settle(labelled(labels, "toxic", MOST_ROWS, HELD_OUT), "labels")
    # At most MOST_ROWS ids of 16 bytes.
    train = settle(rows.join(F.broadcast(known), "doc_id").select("text", "y"), "train")
    ones, count = known.agg(F.coalesce(F.sum("y"), F.lit(0.0)), F.count("*")).first()
    prior = (ones + 1) / (count + 2)
    voters = choose_voters(train)
    held = held_out(F.col("doc_id"), *HELD_OUT).alias("held_out")
    if voters:
        votes = settle(rows.mapInArrow(_vote(voters), "doc_id long, votes array<int>"), "votes")
        sums = votes.mapInArrow(_moments(len(voters)), "together array<double>, n long")
        # One row of fixed size for each task; added up in groups before the driver sees them.
        flat = sums.select("n", F.posexplode("together").alias("cell", "v")).groupBy("cell").agg(F.sum("v").alias("v"))
        together = np.zeros(len(voters) ** 2)
        for cell, value in flat.collect():
            together[cell] = value
        n = max(1, votes.count())
        model = fit_label_model(together.reshape(len(voters), -1), n, prior)
        patterns = settle(votes.groupBy("votes").agg(F.count("*").alias("n")), "patterns")
        weights = fit_classifier(patterns, model, n)
        scored = votes.mapInArrow(_score(weights), "doc_id long, score double").select("doc_id", held, "score")
    else:
        scored = rows.select("doc_id", held, F.lit(float(prior)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
