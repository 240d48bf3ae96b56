"""A fitted ensemble of boosted trees as column expressions and as SQL text.

Both need no vector and no fitted object: the planner reads only the columns that
some tree splits on, and any engine that knows CASE gives the same scores from the
text. A value that is null or not a number goes right at every split, like in the
model. The planner works on every split, some seconds for fifty trees of depth five;
many rows in this session are scored faster by the fitted model.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.model import model_columns

# A leaf is its value; a split is (feature, threshold, left, right).
Node = float | tuple


@dataclass(frozen=True)
class TreePlan:
    features: tuple[str, ...]
    weights: tuple[float, ...]
    trees: tuple[Node, ...]

    @classmethod
    def of(cls, model: PipelineModel, features: list[str] | None = None) -> TreePlan:
        """``features`` are the model's columns, if no assembler stage names them."""
        trees = model.stages[-1]
        if not isinstance(trees, GBTClassificationModel):
            raise ValueError("the last stage holds no boosted trees")
        edges: dict[str, list[float]] = {}
        if any(isinstance(s, VectorAssembler) for s in model.stages):
            features = model_columns(model)
            binned = [s for s in model.stages if isinstance(s, Bucketizer)]
            edges = {c: e for s in binned for c, e in zip(s.getInputCols(), s.getSplitsArray())}
        roots = tuple(_node(tree._java_obj.rootNode(), features, edges) for tree in trees.trees)
        return cls(tuple(features), tuple(float(w) for w in trees.treeWeights), roots)

    def used(self) -> list[str]:
        """The columns that some tree splits on."""
        found: set[str] = set()
        stack = list(self.trees)
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                found.add(node[0])
                stack += node[2:]
        return [c for c in self.features if c in found]

    def margin(self) -> Column:
        """The weighted sum of all trees."""
        return F.expr(self._margin("`"))

    def _margin(self, quote: str) -> str:
        return " + ".join(f"{_number(w)} * {_text(tree, quote)}" for w, tree in zip(self.weights, self.trees))

    def score(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` plus score (probability of 1), and prediction (1 above one half)."""
        margins = df.select(*keep, self.margin().alias("_margin"))
        return margins.select(
            *keep,
            (1 / (1 + F.exp(-2 * F.col("_margin")))).alias("score"),
            (F.col("_margin") > 0).cast("double").alias("prediction"),
        )

    def sql(self, source: str, keep: list[str], quote: str = '"') -> str:
        """The same as ``score``, as a query on the table ``source``."""
        kept = "".join(f"{quote}{c}{quote}, " for c in keep)
        return (
            f"select {kept}1 / (1 + exp(-2 * margin)) as score, cast(margin > 0 as int) * {_number(1.0)} as prediction "
            f"from (select *, {self._margin(quote)} as margin from {source}) as margins"
        )

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "weights": self.weights, "trees": self.trees})

    @classmethod
    def from_json(cls, text: str) -> TreePlan:
        saved = json.loads(text)
        return cls(tuple(saved["features"]), tuple(saved["weights"]), tuple(_tupled(t) for t in saved["trees"]))


def _node(java, features: list[str], edges: dict[str, list[float]]) -> Node:
    if java.subtreeDepth() == 0:
        return float(java.prediction())
    split = java.split()
    if split.getClass().getSimpleName() != "ContinuousSplit":
        raise ValueError(f"{features[split.featureIndex()]} is split by categories, not at a threshold")
    sides = (_node(child, features, edges) for child in (java.leftChild(), java.rightChild()))
    name, rule = features[split.featureIndex()], float(split.threshold())
    if name in edges:
        # The last value of the last bin on the left.
        rule = math.nextafter(edges[name][math.floor(rule) + 1], -math.inf)
    return (name, rule, *sides)


def _tupled(node) -> Node:
    return node if isinstance(node, float) else (node[0], node[1], _tupled(node[2]), _tupled(node[3]))


def _text(node: Node, quote: str) -> str:
    if isinstance(node, float):
        return _number(node)
    name, rule, left, right = node
    goes_left = f"cast({quote}{name}{quote} as double) <= {_number(rule)}"
    return f"case when {goes_left} then {_text(left, quote)} else {_text(right, quote)} end"


def _number(value: float) -> str:
    """All digits, and an exponent, which makes it a double in every dialect."""
    return f"({value:.17e})"
