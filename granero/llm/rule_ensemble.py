"""Quality classifier: a sparse ensemble of rules.

Small trees are grown on statistics of labelled texts. Every path from a root to
a node is a rule, a conjunction of thresholds. A logistic regression with lasso
penalty weighs the rules and drops most of them. What is left is compiled into
one column expression over the statistics.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.sources.staging import stage

STATISTICS = [
    "n_words",
    "mean_word",
    "signs_per_word",
    "upper_share",
    "digit_share",
    "exclaim_per_word",
    "stops_per_word",
    "commas_per_word",
    "quotes_per_word",
    "high_share",
    "distinct_share",
    "top_share",
    "dup_line_share",
    "words_per_line",
]

# (statistic, at most?, threshold); a rule is a set of them.
Condition = tuple[str, bool, float]
Rule = frozenset[Condition]

_SIGNS, _STOPS, _COMMAS, _QUOTES = (list(signs) for signs in (b"#*$%&|<>{}[]\\^~=+@", b".?", b",;:", b"\"'"))


def _statistics(text: str) -> tuple[float, ...]:
    data = text.encode()
    bytes_of = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    n, size = max(1, len(words)), max(1, len(data))
    letters = max(1, int(bytes_of[65:91].sum() + bytes_of[97:123].sum()))
    counts = Counter(words)
    return (
        float(len(words)),
        sum(map(len, words)) / n,
        float(bytes_of[_SIGNS].sum()) / n,
        float(bytes_of[65:91].sum()) / letters,
        float(bytes_of[48:58].sum()) / size,
        float(bytes_of[33]) / n,
        float(bytes_of[_STOPS].sum()) / n,
        float(bytes_of[_COMMAS].sum()) / n,
        float(bytes_of[_QUOTES].sum()) / n,
        float(bytes_of[128:].sum()) / size,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        len(words) / max(1, len(lines)),
    )


def with_statistics(docs: DataFrame) -> DataFrame:
    """The rows as ``_row`` beside the statistics of every whole text.

    A null text counts as empty.
    """
    names = [T.StructField(name, T.DoubleType()) for name in STATISTICS]
    nested = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("_row"))
    at = docs.columns.index("text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_statistics(text.as_py() or "") for text in batch.column(0).field(at)]
            table = np.array(rows, np.float64).reshape(len(rows), len(STATISTICS))
            columns = [pa.array(np.ascontiguousarray(column)) for column in table.T]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["_row", *STATISTICS])

    return nested.mapInArrow(measure, T.StructType([*nested.schema.fields, *names]))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves 1 by 3."""
    text = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % 3 == 1


def condition_column(rule: Rule) -> Column:
    found = F.lit(True)
    for name, at_most, threshold in sorted(rule):
        found = found & (F.col(name) <= threshold if at_most else F.col(name) > threshold)
    return found


def simplest(rule: Rule) -> Rule:
    """Keep the tightest threshold per statistic and direction."""
    best: dict[tuple[str, bool], float] = {}
    for name, at_most, threshold in rule:
        known = best.get((name, at_most), threshold)
        best[name, at_most] = min(known, threshold) if at_most else max(known, threshold)
    return frozenset((name, at_most, threshold) for (name, at_most), threshold in best.items())


def tree_rules(root, names: list[str]) -> Iterator[Rule]:
    """The path to every node below the root of a fitted tree."""

    def walk(node, path: tuple[Condition, ...]) -> Iterator[Rule]:
        if path:
            yield simplest(frozenset(path))
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            name, threshold = names[split.featureIndex()], float(split.threshold())
            yield from walk(node.leftChild(), (*path, (name, True, threshold)))
            yield from walk(node.rightChild(), (*path, (name, False, threshold)))

    return walk(root, ())


@dataclass(frozen=True)
class RuleEnsemble:
    """A score between 0 and 1: logistic of the intercept and the weights of true rules."""

    intercept: float
    weights: dict[Rule, float] = field(default_factory=dict)

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in sorted(self.weights.items(), key=lambda x: sorted(x[0])):
            total = total + F.when(condition_column(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))

    def describe(self) -> list[str]:
        def words(rule: Rule) -> str:
            return " and ".join(f"{n} {'<=' if low else '>'} {t:.4g}" for n, low, t in sorted(rule))

        return [f"{w:+.3f}  {words(r)}" for r, w in sorted(self.weights.items(), key=lambda x: -abs(x[1]))]


@dataclass(frozen=True)
class Fit:
    """``most_labels`` bounds the sample that is learned from, whatever the table's size."""

    most_labels: int = 20_000
    trees: int = 12
    depth: int = 3
    penalty: float = 0.001
    seed: int = 5


def label_sample(labels: DataFrame, target: str, fit: Fit) -> DataFrame:
    """About ``most_labels`` rows that may be learned from, taken by a hash of the id."""
    usable = labels.where(F.col(target).isin(0, 1) & F.col("doc_id").isNotNull()).where(
        ~held_out(F.col("doc_id"))
    )
    share = min(1.0, fit.most_labels / max(1, usable.count()))
    chosen = F.pmod(F.xxhash64("doc_id", F.lit(fit.seed)), F.lit(1 << 20)) < int(share * (1 << 20))
    return usable.where(chosen).select(
        F.col("doc_id").alias("_labelled"), F.col(target).cast("double").alias("_label")
    )


def fit_rules(docs: DataFrame, labels: DataFrame, target: str = "quality", fit: Fit = Fit()) -> RuleEnsemble:
    """Learn from a bounded sample of labelled documents, held-out ones never.

    Labels other than 0 and 1 are not used. Repeated label rows and documents count
    as often as they meet. With no labels, or labels of one kind, there are no rules
    and the score is the smoothed share of label 1.
    """
    sample = label_sample(labels, target, fit)
    # The sample's size has a bound, so it may be sent to all tasks.
    chosen = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).join(
        F.broadcast(sample), F.col("doc_id") == F.col("_labelled"), "left_semi"
    )
    learned = stage(
        with_statistics(chosen)
        .withColumn("doc_id", F.col("_row.doc_id"))
        .drop("_row")
        .join(F.broadcast(sample), F.col("doc_id") == F.col("_labelled"))
    )
    ones, rows = learned.agg(F.coalesce(F.sum("_label"), F.lit(0.0)), F.count(F.lit(1))).first()
    if not 0 < ones < rows:
        return RuleEnsemble(float(np.log((ones + 1) / (rows - ones + 1))))
    vectors = learned.select(
        F.col("_label").alias("label"),
        array_to_vector(F.array(*STATISTICS)).alias("features"),
        *STATISTICS,
    ).coalesce(4).cache()
    forest = RandomForestClassifier(
        numTrees=fit.trees, maxDepth=fit.depth, seed=fit.seed, featureSubsetStrategy="0.5", subsamplingRate=0.7
    ).fit(vectors)
    rules = sorted(
        {rule for tree in forest.trees for rule in tree_rules(tree._call_java("rootNode"), STATISTICS)},
        key=sorted,
    )
    if not rules:
        vectors.unpersist()
        return RuleEnsemble(float(np.log((ones + 1) / (rows - ones + 1))))
    truths = F.array(*(condition_column(rule).cast("double") for rule in rules))
    lasso = LogisticRegression(
        elasticNetParam=1.0, regParam=fit.penalty, maxIter=60, standardization=False
    ).fit(vectors.select("label", array_to_vector(truths).alias("features")))
    vectors.unpersist()
    weights = {rule: float(w) for rule, w in zip(rules, lasso.coefficients) if abs(w) > 1e-9}
    return RuleEnsemble(float(lasso.intercept), weights)


def classify(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, empty ones too."""
    own = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    doc_id, score = F.col("_row.doc_id"), F.col("score")
    return (
        with_statistics(own)
        .withColumn("score", model.score())
        .select(
            doc_id.alias("doc_id"),
            held_out(doc_id).alias("held_out"),
            score,
            (score >= 0.5).cast("int").alias("predicted"),
        )
    )


def accepted(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """The documents whose score is at least 0.5, with all their columns.

    A null text is scored like an empty one and stays null. Scores depend on the text alone,
    so repeated rows stay or go together, whatever their ids. An empty table gives an
    empty result.
    """
    return with_statistics(docs).where(model.score() >= 0.5).select("_row.*")
