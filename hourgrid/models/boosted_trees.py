"""Gradient-boosted regression trees with penalised leaves.

Every round Spark ML finds a tree for the residuals of the rounds before, from distributed
histograms. Its leaf values are then set from the sums that one aggregate gives per leaf:
with the squared loss a leaf of n rows with residual sum G is worth G shrunk towards zero
by ``alpha``, over n + ``lambda``. The driver sees one row per leaf.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import astuple, dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourgrid.config import BoostedTreeParams
from hourgrid.functions.numeric import or_zero
from hourgrid.models.tree_nodes import Node, parse, scorer, with_values
from hourgrid.schemas import FORECAST_COLUMNS
from hourgrid.session import scratch_path

#: Rounds after which the running predictions are written to the shared folder.
STORED_ROUNDS = 10
#: Split candidates per feature: with few, none may lie in a gap between groups of rows.
BINS = 256
_NODES = (
    "tree int, node int, feature int, threshold double, left int, right int, value double"
)


def _numeric(frame: DataFrame, features: Sequence[str]) -> DataFrame:
    return frame.withColumns({name: or_zero(name) for name in features})


@dataclass(frozen=True)
class BoostedTreeModel:
    start: float
    trees: tuple[tuple[Node, ...], ...]
    feature_columns: tuple[str, ...]

    def forecast(self, features: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The five forecast columns (bounds equal the point value), and ``keep``."""
        score = F.arrow_udf(scorer(self.start, self.trees), "double")
        yhat = score(*(or_zero(name) for name in self.feature_columns))
        scored = features.withColumn("yhat", yhat)
        bounds = {"yhat_lower": F.col("yhat"), "yhat_upper": F.col("yhat")}
        return scored.withColumns(bounds).select(*FORECAST_COLUMNS, *keep)

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per node; the value that all trees start from is tree -1."""
        rows = [(-1, 0, -1, 0.0, 0, 0, self.start)]
        for t, tree in enumerate(self.trees):
            rows += [(t, n, *astuple(node)) for n, node in enumerate(tree)]
        spark.createDataFrame(rows, _NODES).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, features: tuple[str, ...]) -> BoostedTreeModel:
        start, trees = 0.0, {}
        for row in spark.read.schema(_NODES).parquet(path).orderBy("tree", "node").collect():
            if row.tree < 0:
                start = row.value
            else:
                trees.setdefault(row.tree, []).append(Node(*row[2:]))
        return cls(start, tuple(map(tuple, trees.values())), features)


def leaf_value(residuals: float, rows: int, params: BoostedTreeParams) -> float:
    """What a leaf adds, before the learning rate."""
    shrunk = max(abs(residuals) - params.reg_alpha, 0.0) / (rows + params.reg_lambda)
    return shrunk if residuals > 0 else -shrunk


def fit_boosted_trees(
    train: DataFrame,
    feature_columns: Sequence[str],
    params: BoostedTreeParams | None = None,
    target: str = "consumption_kwh",
) -> BoostedTreeModel:
    """Boosting on the rows of ``train`` that have a target.

    The rows are stored once; a round reads them from memory or, where an executor was
    lost, from the shared folder, to which the running predictions go every few rounds.
    """
    if not feature_columns:
        raise ValueError("feature_columns must be given for boosted trees")
    params = params or BoostedTreeParams()
    label = F.col(target).cast("double")
    rows = _numeric(train, feature_columns).where(label.isNotNull() & ~F.isnan(label))
    state = _written(rows.select(*feature_columns, label.alias("_y")), "boosting")
    start = state.agg(F.avg("_y")).first()[0]
    if start is None:
        raise ValueError("There are no rows to train on")
    state = state.withColumn("_f", F.lit(start))
    draw = random.Random(params.seed)
    chosen_number = max(1, round(params.colsample_bytree * len(feature_columns)))
    trees: list[tuple[Node, ...]] = []
    held: DataFrame | None = None
    for number in range(params.num_boost_round):
        chosen = sorted(draw.sample(range(len(feature_columns)), chosen_number))
        assembler = VectorAssembler(
            inputCols=[feature_columns[i] for i in chosen], outputCol="_features"
        )
        assembled = assembler.transform(state).withColumn("_r", F.col("_y") - F.col("_f"))
        seen = assembled
        if params.subsample < 1:
            seen = seen.where(F.rand(params.seed + number) < params.subsample)
        tree = DecisionTreeRegressor(
            featuresCol="_features",
            labelCol="_r",
            maxDepth=params.max_depth,
            maxBins=BINS,
            minInstancesPerNode=params.min_child_weight,
            minInfoGain=params.gamma,
            seed=params.seed,
        ).fit(seen)
        placed = tree.setLeafCol("_leaf").setPredictionCol("_mean")
        sums = placed.transform(seen).groupBy("_leaf").agg(
            F.sum("_r").alias("residuals"), F.count(F.lit(1)).alias("rows")
        )
        values = {
            int(row["_leaf"]): params.eta * leaf_value(row["residuals"], row["rows"], params)
            for row in sums.collect()
        }
        nodes = with_values(parse(tree.toDebugString), chosen, values)
        trees.append(tuple(nodes))
        # Leaves in Spark's numbering: the order in which the description lists them.
        added = [node.value for node in nodes if node.feature < 0]
        step = F.get(F.array(*map(F.lit, added)), F.col("_leaf").cast("int"))
        state = placed.transform(assembled).select(*feature_columns, "_y", (F.col("_f") + step).alias("_f"))
        last = number + 1 == params.num_boost_round
        if last:
            break
        previous = held
        if (number + 1) % STORED_ROUNDS == 0:
            state, held = _written(state, "boosting"), None
        else:
            held = state = state.persist()
            state.count()
        if previous is not None:
            previous.unpersist()
    if held is not None:
        held.unpersist()
    return BoostedTreeModel(start, tuple(trees), tuple(feature_columns))


def _written(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
