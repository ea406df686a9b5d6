"""Gradient boosting in stages, for what ``GBTRegressor`` has no setting for: Huber and
pseudo-Huber losses, L1 and L2 penalties of leaf values, and a number of leaves.

Each round fits one ``DecisionTreeRegressor`` to the Newton targets -gradient / hessian,
weighted by the hessians, and then sets the leaves' values by one aggregation over (leaf):

    value = -soft(sum of gradients, reg_alpha) / (sum of hessians + reg_lambda)

A number of leaves is honoured by growing best-first: a node's best split does not depend on
what else is split, so the tree of most gain with so many leaves is what is left of the
depth-limited tree when its nodes are opened in order of their gain. Opened are at most
``num_leaves`` of the nodes, on the driver, which sees the tree (bounded by its depth) and
one sum per leaf, never a row.

The frame is written every ``stage_rounds`` rounds, so neither the plan nor what a lost
executor must redo grows with the number of rounds.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycast.functions.transforms import sinh_inverse
from daycast.plans.folds import fold_split
from daycast.plans.model import MAX_DEPTH, assembler
from daycast.session import write_stage

#: Losses by the names they go by, and the parameter that holds their threshold.
LOSSES = {"huber": "huber", "reg:pseudohubererror": "pseudo_huber", "pseudohuber": "pseudo_huber", "mse": "squared", "squarederror": "squared",
          "reg:squarederror": "squared", "squared": "squared"}
THRESHOLD = {"huber": "alpha", "pseudo_huber": "huber_slope"}
DEFAULTS = {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 6, "min_child_weight": 1, "reg_alpha": 0.0, "reg_lambda": 0.0, "num_leaves": None,
            "objective": "squared", "alpha": None, "huber_slope": None}


def setting(params: Mapping) -> dict:
    """The parameters as this learner uses them, or ValueError naming the first that it can't honour."""
    unknown = set(params) - set(DEFAULTS)
    if unknown:
        raise ValueError(f"unknown parameter {sorted(unknown)[0]!r}")
    out = DEFAULTS | {k: v for k, v in params.items() if v is not None}
    if out["objective"] not in LOSSES:
        raise ValueError(f"objective {out['objective']!r} is not of this learner")
    out["objective"] = LOSSES[out["objective"]]
    name = THRESHOLD.get(out["objective"])
    out["threshold"] = out[name] if name else None
    if name and not (out["threshold"] or 0) > 0:
        raise ValueError(f"{out['objective']} needs a positive {name}")
    if out["num_leaves"] is not None and out["num_leaves"] < 2:
        raise ValueError("num_leaves is less than 2")
    if out["max_depth"] == -1:  # as deep as so many leaves can reach
        if out["num_leaves"] is None or out["num_leaves"] - 1 > MAX_DEPTH:
            raise ValueError(f"unlimited depth needs num_leaves of at most {MAX_DEPTH + 1}")
        out["max_depth"] = out["num_leaves"] - 1
    if not 1 <= out["max_depth"] <= MAX_DEPTH:
        raise ValueError(f"max_depth={out['max_depth']} is not within 1 to {MAX_DEPTH}")
    if out["reg_alpha"] < 0 or out["reg_lambda"] < 0:
        raise ValueError("penalties are not negative")
    return out


def honoured(grid: Sequence[Mapping]) -> list[dict]:
    """The distinct settings of a grid that this learner honours, in the grid's order."""
    out: list[dict] = []
    for p in grid:
        try:
            s = setting(p)
        except ValueError:
            continue
        if s not in out:
            out.append(s)
    return out


def derivatives(objective: str, error: Column, threshold: float | None) -> tuple[Column, Column]:
    """(gradient, hessian) of the loss by the prediction; ``error``: prediction minus label."""
    if objective == "huber":
        return F.greatest(F.lit(-float(threshold)), F.least(F.lit(float(threshold)), error)), F.lit(1.0)
    if objective == "pseudo_huber":
        scale = F.lit(1.0) + F.pow(error / F.lit(float(threshold)), F.lit(2.0))
        return error / F.sqrt(scale), F.lit(1.0) / (scale * F.sqrt(scale))
    return error, F.lit(1.0)


def leaf_groups(tree: DecisionTreeRegressionModel, num_leaves: int | None) -> list[int]:
    """For each leaf of the tree (in its own order) the leaf it is part of when only
    ``num_leaves`` are kept, opened by gain."""
    order: dict[str, int] = {}

    def count(node, path: str) -> None:
        if node.subtreeDepth() == 0:
            order[path] = len(order)
        else:
            count(node.leftChild(), path + "0")
            count(node.rightChild(), path + "1")

    root = tree._java_obj.rootNode()
    count(root, "")
    if num_leaves is None or len(order) <= num_leaves:
        return list(range(len(order)))
    gain = lambda node: node.gain() * node.impurityStats().count()
    waiting, closed = [(-gain(root), "", root)], []
    while waiting and len(waiting) + len(closed) < num_leaves:
        _, path, node = heapq.heappop(waiting)
        for sign, child in (("0", node.leftChild()), ("1", node.rightChild())):
            if child.subtreeDepth():
                heapq.heappush(waiting, (-gain(child), path + sign, child))
            else:
                closed.append(path + sign)
    kept = sorted([*closed, *(p for _, p, _ in waiting)])
    # paths in order are leaves from left to right; a leaf belongs to the kept node on its path
    return [next(i for i, k in enumerate(kept) if path.startswith(k)) for path in sorted(order, key=order.get)]


@dataclass
class Boosted:
    """The start value, and for every round a tree with the value of each of its leaves."""

    features: list[str]
    start: float
    rounds: list[tuple[DecisionTreeRegressionModel, list[float]]] = field(default_factory=list)

    def _add(self, df: DataFrame, tree: DecisionTreeRegressionModel, values: Sequence[float], total: str) -> DataFrame:
        placed = tree.setLeafCol("__leaf").setPredictionCol("__tree").transform(df)
        value = F.get(F.array(*[F.lit(float(v)) for v in values]), F.col("__leaf").cast("int"))
        return placed.withColumn(total, F.col(total) + value).drop("__leaf", "__tree")

    def predict(self, df: DataFrame, bound: float | None = None, out: str = "prediction") -> DataFrame:
        """``df`` with the prediction in raw units."""
        scored = assembler(self.features).transform(df).withColumn("__total", F.lit(self.start))
        for tree, values in self.rounds:
            scored = self._add(scored, tree, values, "__total")
        return scored.withColumn(out, sinh_inverse("__total", bound)).drop("__total", "features")


def fit_boosted(df: DataFrame, features: Sequence[str], target: str, params: Mapping, weight_col: str | None = None, stage_rounds: int = 10) -> Boosted:
    """Boost the asinh of the target from its mean. Rows without a target, or without a
    positive weight, teach nothing."""
    p = setting(params)
    weight = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    rows = df.withColumn("__y", F.asinh(F.col(target))).withColumn("__w", weight).filter("__y IS NOT NULL AND NOT isnan(__y) AND __w > 0")
    data = write_stage(assembler(features).transform(rows).select("features", "__y", "__w"), "boost")
    start = data.agg(F.try_divide(F.sum(F.col("__w") * F.col("__y")), F.sum("__w")).alias("m")).first()["m"]
    if start is None:
        raise ValueError("no row to learn from")
    model = Boosted(list(features), float(start))
    data = data.withColumn("__total", F.lit(model.start))
    learner = DecisionTreeRegressor(featuresCol="features", labelCol="__newton", weightCol="__hw", predictionCol="__tree", maxDepth=p["max_depth"],
                                    minInstancesPerNode=int(p["min_child_weight"]), maxMemoryInMB=512, seed=42)
    for n in range(int(p["n_estimators"])):
        gradient, hessian = derivatives(p["objective"], F.col("__total") - F.col("__y"), p["threshold"])
        step = data.withColumn("__g", gradient).withColumn("__hw", hessian * F.col("__w")).withColumn("__newton", -F.col("__g") / hessian)
        tree = learner.fit(step)
        groups = leaf_groups(tree, p["num_leaves"])
        placed = tree.setLeafCol("__leaf").transform(step).withColumn("__kept", F.get(F.array(*[F.lit(g) for g in groups]), F.col("__leaf").cast("int")))
        sums = {r["__kept"]: (r.g, r.h) for r in placed.groupBy("__kept").agg(F.sum(F.col("__g") * F.col("__w")).alias("g"), F.sum("__hw").alias("h")).collect()}

        def value(g: float, h: float) -> float:
            left = max(abs(g) - p["reg_alpha"], 0.0)
            return (-left if g > 0 else left) / (h + p["reg_lambda"]) if h + p["reg_lambda"] > 0 else 0.0

        values = [p["learning_rate"] * value(*sums.get(g, (0.0, 0.0))) for g in groups]
        model.rounds.append((tree, values))
        data = model._add(data, tree, values, "__total")
        if (n + 1) % stage_rounds == 0:
            data = write_stage(data, "boost")
    return model


def walk_forward_boosted(tagged: DataFrame, features: Sequence[str], target: str, params: Mapping, folds: Sequence[int], ts: str, bound: float | None = None) -> DataFrame:
    """Out-of-fold predictions (ts, fold, actual, prediction); each fold's rows are written as
    they are made, so no fold's model is needed to read the next one's."""
    done = None
    for fold in folds:
        train, val = fold_split(tagged, fold)
        scored = fit_boosted(train, features, target, params).predict(val, bound)
        rows = write_stage(scored.select(ts, F.lit(fold).cast("int").alias("fold"), F.col(target).alias("actual"), "prediction"), "boost-fold")
        done = rows if done is None else done.unionByName(rows)
    return done if done is not None else tagged.select(ts, F.lit(0).alias("fold"), F.col(target).alias("actual"), F.lit(0.0).alias("prediction")).limit(0)
