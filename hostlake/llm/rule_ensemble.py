"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow trees are grown on labelled documents; each path from a root is a rule, a conjunction of comparisons such as
``symbols > 0.2 AND words <= 310``. A lasso logistic regression over the rules keeps few of them with a weight each.
The model is then a handful of SQL conditions and numbers: scoring is one Spark column expression, evaluated where the
text is read, without Python and without a shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from math import log

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostlake.llm.common import cut, fresh

#: At most so many labelled documents are fitted on, chosen by a hash of the id: the only bound; scoring has none.
SAMPLE_ROWS = 20_000
TREES, DEPTH, LASSO, SEED = 24, 3, 0.002, 7
#: Common short words of English, French, German and Spanish.
COMMON_WORDS = (
    "the of and to in a is that it for was on with as by at be this from or are "
    "de la le les et un une des en que qui dans pour sur au par pas du ce est "
    "der die und das von mit im den ist nicht zu dem ein auf für sich als "
    "el los las del se una por para con no su al lo como más"
).split()


def _count(text: Column, characters: str) -> Column:
    """Characters of ``text`` that are among ``characters``."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text, all numbers and never null; a null text counts as an empty one."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    n_words, n_lines = F.greatest(F.size(words), F.lit(1)), F.greatest(F.size(lines), F.lit(1))
    n_chars = F.greatest(F.length(text), F.lit(1))
    low = F.transform(words, lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?"))))
    common = F.array(*[F.lit(w) for w in dict.fromkeys(COMMON_WORDS)])
    return {name: c.cast("double") for name, c in {
        "words": F.size(words),
        "word_length": (n_chars - _count(text, " \t\n\r")) / n_words,
        "symbols": _count(text, "#*$%&<>@^~=_+\\{}[]") / n_words,
        "bars": _count(text, "|") / n_words,
        "shouts": _count(text, "!?") / n_words,
        "capitals": _count(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ") / n_chars,
        "digits": _count(text, "0123456789") / n_chars,
        "stops": _count(text, ".,;:") / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
        "common_words": F.size(F.filter(low, lambda w: F.array_contains(common, w))) / n_words,
    }.items()}


#: The statistics, in the order of a feature vector.
NAMES = (
    "words", "word_length", "symbols", "bars", "shouts", "capitals", "digits", "stops", "distinct_words",
    "distinct_lines", "common_words")


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, '<=' or '>', threshold)."""

    tests: tuple[tuple[str, str, float], ...]

    def column(self, values: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, sign, threshold in self.tests:
            out = out & (values[name] <= threshold if sign == "<=" else values[name] > threshold)
        return out

    def __str__(self) -> str:
        return " AND ".join(f"{n} {s} {t:.6g}" for n, s, t in self.tests)


@dataclass
class RuleEnsemble:
    """P(quality = 1) = logistic(intercept + sum of the weights of the rules that hold)."""

    intercept: float
    weights: dict[Rule, float] = field(default_factory=dict)

    def score(self, values: dict[str, Column]) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weights.items():
            total = total + F.when(rule.column(values), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def simplest(tests: list[tuple[str, str, float]]) -> tuple[tuple[str, str, float], ...]:
    """The tightest bound of each statistic and side, in a fixed order: equal rules get equal texts."""
    bounds: dict[tuple[str, str], float] = {}
    for name, sign, t in tests:
        old = bounds.get((name, sign), t)
        bounds[name, sign] = min(old, t) if sign == "<=" else max(old, t)
    return tuple((n, s, t) for (n, s), t in sorted(bounds.items()))


def paths(tree: str, names: tuple[str, ...] = NAMES) -> list[Rule]:
    """All rules (paths from the root to any node) of a tree's debug text."""
    out, open_tests = [], []
    for line in tree.splitlines():
        found = re.match(r"( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if found:
            depth = len(found[1])
            open_tests = [x for x in open_tests if x[0] < depth]
            open_tests.append((depth, (names[int(found[3])], found[4], float(found[5]))))
            out.append(Rule(simplest([t for _, t in open_tests])))
    return out


def labelled(docs: DataFrame, labels: DataFrame, usable: Column | None, rows: int, id_col: str, text_col: str,
             label_col: str) -> DataFrame:
    """Statistics and label (y) of at most ``rows`` labelled documents; one label per id (the mean, 0.5 counts as 1)."""
    ids = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    ids = ids.where(usable) if usable is not None else ids
    ids = ids.groupBy(F.col(id_col).alias("i")).agg((F.avg(label_col) >= 0.5).cast("double").alias("y"))
    chosen = F.broadcast(ids.orderBy(F.xxhash64("i"), "i").limit(rows))  # bounded by ``rows`` small rows
    texts = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).join(chosen, "i")
    values = statistics(F.col("t"))
    return texts.select("i", "y", *[values[n].alias(n) for n in NAMES]).orderBy("i", *NAMES).limit(rows)


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> RuleEnsemble:
    """Learns from labelled documents (``usable``: which label rows may be learned from; null: all).

    No usable labels, or only one class: a model without rules that gives everything the (smoothed) share of label 1.
    Null ids and labels are left out. Labels, language, source and id are never inputs of a score.
    """
    sample = cut(labelled(docs, labels, usable, rows, id_col, text_col, label_col))
    n, ones = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    if ones in (0, n):
        return RuleEnsemble(log((ones + 1) / (n - ones + 1)))
    vectors = VectorAssembler(inputCols=list(NAMES), outputCol="x").transform(sample).select("x", "y")
    forest = RandomForestClassifier(featuresCol="x", labelCol="y", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
                                    subsamplingRate=0.7).fit(vectors)
    rules = list(dict.fromkeys(r for tree in forest.trees for r in paths(tree.toDebugString)))
    if not rules:
        return RuleEnsemble(log((ones + 1) / (n - ones + 1)))
    values = {name: F.col(name) for name in NAMES}
    holds = F.array(*[F.when(r.column(values), 1.0).otherwise(0.0) for r in rules])
    lasso = LogisticRegression(featuresCol="x", labelCol="y", regParam=LASSO, elasticNetParam=1.0, maxIter=60,
                               standardization=False).fit(cut(sample.select(array_to_vector(holds).alias("x"), "y")))
    weights = {r: w for r, w in zip(rules, lasso.coefficients.toArray().tolist(), strict=True) if w}
    return RuleEnsemble(float(lasso.intercept), weights)


def scored(docs: DataFrame, model: RuleEnsemble, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the score as a new last column (a leading '_' where the name is taken)."""
    (score_col,) = fresh(docs, score_col)
    names = fresh(docs, *NAMES)
    values = statistics(F.col(f"`{text_col}`"))
    wide = docs.withColumns({name: values[n] for n, name in zip(NAMES, names, strict=True)})
    out = wide.withColumn(score_col, model.score({n: F.col(name) for n, name in zip(NAMES, names, strict=True)}))
    return out.drop(*names)


def third(ident: Column) -> Column:
    """crc32 of the id as text, modulo 3; -1 for null ids."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 3, F.lit(-1))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", rows: int = SAMPLE_ROWS) -> DataFrame:
    """(id, held_out, score, predicted), one row per input row.

    Learns from rows whose crc32(id as text) mod 3 is not 1 (the others are held out; a null id is not). score is
    between 0 and 1, predicted is 1 from 0.5 on. Null and empty texts are scored from their (zero) statistics. Rows may
    repeat; other columns are not read. An empty table gives an empty one (empty labels: a model without rules). A very
    long text's statistics are computed whole, in one row of one task.
    """
    model = fit(docs, labels, third(F.col(id_col)) != 1, rows, id_col, text_col, label_col)
    out = scored(docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")), model, "t")
    return out.select(F.col("i").alias(id_col), (third(F.col("i")) == 1).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: RuleEnsemble, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more; all columns as they are."""
    out = scored(docs, model, text_col)
    return out.where(F.col(f"`{out.columns[-1]}`") >= least).drop(out.columns[-1])
