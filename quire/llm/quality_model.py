"""Quality classifier: a sparse ensemble of rules.

1. Statistics of a text (``STATS``): shares and ratios of characters, words and
   lines, nothing that names its source, language, key or labels; the number of
   words is a statistic up to 1,000, as longer is not better.
2. A random forest of shallow trees is grown on labelled texts. Every path from
   a root to an inner node or leaf is a conjunction of thresholds: a rule.
3. A lasso logistic regression over the rules (and a constant) keeps few of
   them with a weight each.
4. The rules left over are compiled into one Spark Column of the statistics:
   ``score = 1 / (1 + exp(-(bias + sum of weights of rules that hold)))``.

Training reads a sample of about ``SAMPLE_ROWS`` labelled rows, chosen by a
hash of the key, so it costs the same at any size; the statistics of the sample
are cut from the corpus by a join with the sampled keys (a bounded table, sent
to every task). Scoring is one pass without a shuffle over every whole text.

Edge cases: a null or empty text has statistics of zero and gets the score of
those; a key labelled more than once takes its largest label; labels that are
null or neither 0 nor 1, and labels of unknown keys, are ignored; if the sample
holds only one class every score is that class, and without any label 1.0;
repeated rows get equal scores; ``score`` replaces a column of that name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from .common import held_out, packed_row, quoted, unpacked_row

SAMPLE_ROWS = 20_000      # labelled rows that the model is fitted on, about
TREES, DEPTH = 24, 3
LASSO = 0.002
SEED = 7
STATS = ("words", "word_length", "upper", "symbols", "marks", "digits", "bare", "repeat_next", "distinct",
         "top_word", "repeat_pairs", "repeat_lines", "line_words", "stops", "shout")

_MARK = re.compile(r"[!?.,;:]")
_SYMBOL = re.compile(r"[#*$%&|<>{}\[\]\\^~_=+@]")
_DIGIT = re.compile(r"\d")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_LETTER = re.compile(r"[^\W\d_]")


def statistics(text: str | None) -> tuple[float, ...]:
    """``STATS`` of one whole text; all zero without words."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return (0.0,) * len(STATS)
    chars = sum(map(len, words))
    lines = [x for x in text.split("\n") if x.strip()]
    letters = len(_LETTER.findall(text)) or 1
    pairs = Counter(zip(words, words[1:]))
    times = Counter(words)
    return (
        float(min(n, 1000)), chars / n, len(_UPPER.findall(text)) / letters, len(_SYMBOL.findall(text)) / chars,
        len(_MARK.findall(text)) / chars, len(_DIGIT.findall(text)) / chars,
        sum(k for w, k in times.items() if len(w) < 3 and not w.isalnum()) / n,
        # of few words in a long text; a plain ratio would fall with length
        sum(k for (a, b), k in pairs.items() if a == b) / n, math.log(len(times) + 1) / math.log(n + 1),
        max(times.values()) / n,
        sum(k for k in pairs.values() if k > 1) / n, 1 - len(set(lines)) / len(lines), n / len(lines),
        text.count(".") / n, text.count("!!") / n,
    )


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` and the struct ``__stats`` of its texts' statistics."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([statistics(t) for t in texts], columns=list(STATS))

    kind = ", ".join(f"{s}:double" for s in STATS)
    return docs.withColumn("__stats", F.pandas_udf(run, f"struct<{kind}>").asNondeterministic()(F.col(text)))


class RuleModel:
    """``rules``: weight and conjunction [(statistic, at most?, threshold)]."""

    def __init__(self, bias: float, rules: list[tuple[float, list[tuple[str, bool, float]]]]):
        self.bias, self.rules = bias, rules

    @staticmethod
    def holds(rule: list[tuple[str, bool, float]], stats: str = "__stats") -> Column:
        tests = [(F.col(f"{stats}.{s}") <= t) if low else (F.col(f"{stats}.{s}") > t) for s, low, t in rule]
        return reduce(lambda a, b: a & b, tests)

    def column(self, stats: str = "__stats") -> Column:
        """The score as an expression of the statistics."""
        total = reduce(lambda a, b: a + b, [F.when(self.holds(rule, stats), F.lit(w)).otherwise(F.lit(0.0))
                                            for w, rule in self.rules], F.lit(float(self.bias)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def describe(self) -> list[str]:
        return [f"{w:+.3f}  " + " and ".join(f"{s} {'<=' if low else '>'} {t:.4g}" for s, low, t in rule)
                for w, rule in sorted(self.rules, key=lambda r: -abs(r[0]))]


def tree_rules(root) -> list[list[tuple[str, bool, float]]]:
    """The conjunctions of all paths below a tree's root."""
    found, open_ = [], [(root, [])]
    while open_:
        node, path = open_.pop()
        if path:
            found.append(path)
        if node.subtreeDepth():
            split = node.split()
            name, at = STATS[split.featureIndex()], split.threshold()
            open_.append((node.leftChild(), [*path, (name, True, at)]))
            open_.append((node.rightChild(), [*path, (name, False, at)]))
    return found


def shortened(rule: list[tuple[str, bool, float]]) -> tuple[tuple[str, bool, float], ...]:
    """A rule with one bound for each statistic and side."""
    tight: dict[tuple[str, bool], float] = {}
    for s, low, t in rule:
        tight[s, low] = (min if low else max)(t, tight.get((s, low), t))
    return tuple(sorted((s, low, t) for (s, low), t in tight.items()))


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int,
           folds: int) -> DataFrame:
    """``(__stats, label)`` of about ``rows`` labelled rows outside the held-out
    fold, checkpointed."""
    k, mark = F.col(quoted(key)), F.col(quoted(label))
    known = (labels.where(mark.isin(0, 1) & k.isNotNull() & ~held_out(k, folds))
             .groupBy(k.alias("k")).agg(F.max(mark).cast("double").alias("label")))
    n = known.count()
    if n > rows:
        known = known.where(F.pmod(F.xxhash64("k"), F.lit(1 << 30)) < F.lit(int((1 << 30) * rows / n)))
    texts = docs.select(F.col(quoted(key)).alias("k"), F.col(quoted(text)).alias("t"))
    joined = texts.join(F.broadcast(known), "k")  # about `rows` keys at most
    return materialize(with_statistics(joined.select("t", "label"), "t").select("__stats", "label"))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        rows: int = SAMPLE_ROWS, folds: int = 5, trees: int = TREES, depth: int = DEPTH,
        lasso: float = LASSO) -> RuleModel:
    """Fit on labelled rows whose key's crc32 is not divisible by ``folds``."""
    data = sample(docs, labels, key, text, label, rows, folds)
    ones, n = data.agg(F.sum("label"), F.count(F.lit(1))).first()
    if not n or ones in (0, n):
        return RuleModel(-40.0 if n and not ones else 40.0, [])
    stats = data.select("label", *[F.col(f"__stats.{s}").alias(s) for s in STATS])
    stats = VectorAssembler(inputCols=list(STATS), outputCol="features").transform(stats).select("features", "label")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, featureSubsetStrategy="0.5",
                                    subsamplingRate=0.7, minInstancesPerNode=3).fit(stats)
    rules = sorted({shortened(r) for tree in forest._java_obj.trees() for r in tree_rules(tree.rootNode())})
    if not rules:
        share = ones / n
        return RuleModel(math.log(share / (1 - share)), [])
    flags = data.select("label", *[RuleModel.holds(list(r)).cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    flags = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(flags)
    line = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=100).fit(
        materialize(flags.select("features", "label")))
    return RuleModel(line.intercept, [(float(w), list(r)) for w, r in zip(line.coefficients, rules) if w])


def score(docs: DataFrame, model: RuleModel, text: str = "text") -> DataFrame:
    """``docs`` and ``score``: the probability of label 1."""
    return unpacked_row(with_statistics(packed_row(docs, text=text), "text"), docs.columns, score=model.column())


def filter_documents(docs: DataFrame, model: RuleModel, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with a score of at least ``threshold``, in their own columns."""
    rows = with_statistics(packed_row(docs, text=text), "text")
    return unpacked_row(rows.where(model.column() >= threshold), docs.columns)
