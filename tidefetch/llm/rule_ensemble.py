"""Quality classifier: a sparse ensemble of rules over statistics of a text.

Shallow trees are grown on the statistics of labelled texts. Every path from a root to a node
is a rule, a conjunction of comparisons. A logistic regression with an L1 penalty weighs the
rules and drops most of them. What is left is compiled to one Spark column expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefetch.llm.common import evaluate_once, held_out, settle

TREES = 24
DEPTH = 3
PENALTY = 0.0005
#: Labelled rows that are learnt from at most, the first by a hash of their ids.
MOST_ROWS = 50_000
#: Remainder of crc32(doc_id) by 3 whose labels are never learnt from.
HELD_OUT = (3, 1)

_SPACE = r"[\x20\x09-\x0D]+"


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` and a struct ``__stats`` of doubles over ``text``; a null text is measured as empty.

    Shares have a divisor of 1 at least, so an empty text has zeros.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = evaluate_once(
        docs.withColumn("__text", text),
        "__w",
        words=F.array_remove(F.split("__text", _SPACE), ""),
        lines=F.filter(F.split("__text", "\n", -1), lambda line: line != ""),
    )
    words, lines, text = F.col("__w.words"), F.col("__w.lines"), F.col("__text")
    n, n_lines, chars = F.size(words), F.size(lines), F.char_length(text)

    def per(value: Column, whole: Column) -> Column:
        return value.cast("double") / F.greatest(whole, F.lit(1))

    stats = {
        "n_words": n.cast("double"),
        "word_length": per(F.char_length(F.array_join(words, "")), n),
        "distinct_words": per(F.size(F.array_distinct(words)), n),
        "n_lines": n_lines.cast("double"),
        "line_length": per(chars, n_lines),
        "distinct_lines": per(F.size(F.array_distinct(lines)), n_lines),
        "symbols": per(F.regexp_count(text, F.lit(r"[#*$%&|<>]")), n),
        "ends": per(F.regexp_count(text, F.lit(r"[.!?]")), n),
        "marks": per(F.regexp_count(text, F.lit("!")), n),
        "capitals": per(F.regexp_count(text, F.lit(r"\p{Lu}")), chars),
        "digits": per(F.regexp_count(text, F.lit("[0-9]")), chars),
    }
    return evaluate_once(rows, "__stats", **stats).drop("__text", "__w")


@dataclass(frozen=True)
class RuleEnsemble:
    """rules: (weight, comparisons), each comparison a statistic, whether it must be above, and a bound."""

    bias: float
    rules: tuple[tuple[float, tuple[tuple[str, bool, float], ...]], ...]

    def score(self, stats: str = "__stats") -> Column:
        total = F.lit(self.bias)
        for weight, comparisons in self.rules:
            total = total + F.when(_holds(comparisons, stats), F.lit(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _holds(comparisons, stats: str) -> Column:
    holds = F.lit(True)
    for name, above, bound in comparisons:
        value = F.col(f"{stats}.{name}")
        holds = holds & ((value > bound) if above else (value <= bound))
    return holds


def _paths(tree, names: list[str]) -> list[tuple[tuple[str, bool, float], ...]]:
    """The conjunctions that lead to each node below the root; of bounds on one side the tightest stays."""
    found, stack = [], [(tree._java_obj.rootNode(), ())]
    while stack:
        node, path = stack.pop()
        if path:
            tight: dict[tuple[str, bool], float] = {}
            for name, above, bound in path:
                old = tight.get((name, above), bound)
                tight[name, above] = max(old, bound) if above else min(old, bound)
            found.append(tuple(sorted((n, a, b) for (n, a), b in tight.items())))
        if node.subtreeDepth():
            split = node.split()
            name, bound = names[split.featureIndex()], float(split.threshold())
            stack.append((node.leftChild(), (*path, (name, False, bound))))
            stack.append((node.rightChild(), (*path, (name, True, bound))))
    return found


def labelled(labels: DataFrame, label: str, most: int, hold: tuple[int, int]) -> DataFrame:
    """doc_id and y of rows that may be learnt from: at most ``most``, the first by a hash.

    Rows held out are left out, and so are ids whose labels contradict each other or are null.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id"), *hold))
    one = usable.groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("z")).where("y = z")
    # Of many rows only those below a bound of the hash are sorted: little more than are wanted, over all tasks.
    share = min(1.0, (1.05 * most + 1000) / max(1, one.count()))
    hashed, bound = F.xxhash64("doc_id"), min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
    first = one.where(hashed <= bound).orderBy(hashed, "doc_id").limit(most)
    return first.select("doc_id", F.col("y").cast("double").alias("y"))


def learnt(measured: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> DataFrame:
    """The statistics and the label y of the rows that are learnt from, as a written table.

    The ids are broadcast, ``most_rows`` of them at most, so nothing that ``measured`` is made from is shuffled.
    """
    known = F.broadcast(settle(labelled(labels, "quality", most_rows, HELD_OUT), "labels"))
    return settle(measured.join(known, "doc_id").select("__stats.*", "y"), "train")


def fit(train: DataFrame) -> RuleEnsemble:
    """Learns y from a written table of statistics.

    Labels of one kind only, or none, give a constant score: their smoothed mean.
    """
    ones, rows = train.agg(F.coalesce(F.sum("y"), F.lit(0.0)), F.count("*")).first()
    if not 0 < ones < rows:
        mean = (ones + 1) / (rows + 2)
        return RuleEnsemble(math.log(mean / (1 - mean)), ())
    names = [c for c in train.columns if c != "y"]
    vectors = VectorAssembler(inputCols=names, outputCol="x").transform(train)
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="y", numTrees=TREES, maxDepth=DEPTH, seed=2, minInstancesPerNode=5
    ).fit(vectors)
    rules = sorted({path for tree in forest.trees for path in _paths(tree, names)})
    nested = train.select(F.struct(*names).alias("__stats"), "y")
    matrix = nested.select(array_to_vector(F.array(*[_holds(r, "__stats").cast("double") for r in rules])).alias("x"), "y")
    matrix = settle(matrix, "rules")
    model = LogisticRegression(
        featuresCol="x", labelCol="y", elasticNetParam=1.0, regParam=PENALTY, maxIter=60, standardization=False
    ).fit(matrix)
    weights = model.coefficients.toArray().tolist()
    return RuleEnsemble(float(model.intercept), tuple((w, r) for w, r in zip(weights, rules) if abs(w) > 1e-6))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Only the text is scored, each whole. Rows that repeat are scored alike; a null doc_id has no
    label and is not held out. Other columns play no part.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    measured = settle(with_statistics(rows).select("doc_id", "__stats"), "statistics")
    score = fit(learnt(measured, labels)).score()
    scored = measured.select("doc_id", held_out(F.col("doc_id"), *HELD_OUT).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted to be of quality, with their own columns."""
    rows = with_statistics(docs)
    score = fit(learnt(rows.select(F.col("doc_id").cast("long"), "__stats"), labels)).score()
    judged = evaluate_once(rows, "__judged", score=score)
    return judged.where(F.col("__judged.score") >= 0.5).select(*docs.columns)
