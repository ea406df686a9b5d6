"""Grid search, walk-forward predictions, final fit, importances and model storage on
pyspark.ml gradient-boosted trees.

Every fit is a distributed Spark job over a persisted, assembled frame; the driver
only submits fits (a small thread pool) and receives one MAE scalar per fit.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.functions.transforms import sinh_inverse
from daycast.plans.folds import fold_split
from daycast.session import ensure_checkpoint_dir
from daycast.sources.io import write_table

# ---------------------------------------------------------------------------
# The two hyper-parameter grids of the source study (base grid crossed
# with loss variants), 144 x 5 = 720 and 192 x 5 = 960 combinations. ``honoured`` gives
# the settings of them that this learner can fit.
BOOSTED_LEAVES_GRID = {
    "n_estimators": [100, 200],
    "learning_rate": [0.01, 0.05, 0.1],
    "max_depth": [-1, 8],
    "num_leaves": [20, 31, 50],
    "reg_alpha": [0, 1],
    "reg_lambda": [0, 1],
}
BOOSTED_LEAVES_VARIANTS = [
    {"objective": "mae", "alpha": None},
    {"objective": "mse", "alpha": None},
    {"objective": "huber", "alpha": 0.1},
    {"objective": "huber", "alpha": 0.5},
    {"objective": "huber", "alpha": 0.9},
]
BOOSTED_DEPTH_GRID = {
    "n_estimators": [100, 200],
    "learning_rate": [0.01, 0.05, 0.1, 0.3],
    "max_depth": [6, 8],
    "min_child_weight": [1, 5, 20],
    "reg_alpha": [0, 1],
    "reg_lambda": [0, 1],
}
BOOSTED_DEPTH_VARIANTS = [
    {"objective": "reg:absoluteerror", "huber_slope": None},
    {"objective": "reg:squarederror", "huber_slope": None},
    {"objective": "reg:pseudohubererror", "huber_slope": 0.1},
    {"objective": "reg:pseudohubererror", "huber_slope": 0.5},
    {"objective": "reg:pseudohubererror", "huber_slope": 0.9},
]
# ---------------------------------------------------------------------------
# What GBTRegressor can honour of such settings. Its losses, by the names they go by:
LOSS = {"mae": "absolute", "absoluteerror": "absolute", "reg:absoluteerror": "absolute", "absolute": "absolute",
        "mse": "squared", "squarederror": "squared", "reg:squarederror": "squared", "squared": "squared"}
MAX_DEPTH = 30
DEFAULTS = {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 6, "min_child_weight": 1, "objective": "squared"}
# Parameters it lacks, which a setting may name only where they ask for nothing.
ABSENT = {"reg_alpha": 0, "reg_lambda": 0, "num_leaves": None, "alpha": None, "huber_slope": None}


def setting(params: Mapping) -> dict:
    """The parameters as the learner will use them, or ValueError naming the first that it
    can't honour: an unknown objective or name, a depth out of its range, a penalty."""
    out = dict(DEFAULTS)
    for k, v in params.items():
        if k in ABSENT:
            if v is not None and v != ABSENT[k]:
                raise ValueError(f"{k}={v!r} has no equivalent in GBTRegressor")
        elif k not in (*DEFAULTS, "validation_tol"):
            raise ValueError(f"unknown parameter {k!r}")
        elif v is not None:
            out[k] = v
    if out["objective"] not in LOSS:
        raise ValueError(f"objective {out['objective']!r} has no equivalent in GBTRegressor")
    if not 0 <= out["max_depth"] <= MAX_DEPTH:
        raise ValueError(f"max_depth={out['max_depth']} is not within 0 to {MAX_DEPTH}")
    out["objective"] = LOSS[out["objective"]]
    return out


def honoured(grid: Sequence[Mapping]) -> list[dict]:
    """The distinct settings of a grid that the learner honours, in the grid's order; what it
    can't honour is left out rather than fitted as something else."""
    out: list[dict] = []
    for p in grid:
        try:
            s = setting(p)
        except ValueError:
            continue
        if s not in out:
            out.append(s)
    return out


def grid_settings(base: Mapping[str, Sequence], variants: Sequence[Mapping]) -> list[dict]:
    """Every combination of the base grid with every variant (the last key fastest)."""
    return [{**dict(zip(base, values, strict=True)), **v} for values in product(*base.values()) for v in variants]


def settings_frame(spark: SparkSession, settings: Sequence[Mapping]) -> DataFrame:
    """One row per setting: ``combo_id`` (its place) and its parameters as columns."""
    rows = [(i, int(s["n_estimators"]), float(s["learning_rate"]), int(s["max_depth"]), int(s["min_child_weight"]), s["objective"])
            for i, s in enumerate({**DEFAULTS, **p} for p in settings)]
    return spark.createDataFrame(rows, "combo_id int, n_estimators int, learning_rate double, max_depth int, min_child_weight int, objective string")


def gbt_for(params: Mapping, features_col: str = "features", label_col: str = "label",
            weight_col: str | None = None, validation_col: str | None = None, seed: int = 42) -> GBTRegressor:
    p = setting(params)
    gbt = GBTRegressor(
        featuresCol=features_col, labelCol=label_col, predictionCol="__pred_t",
        maxIter=int(p["n_estimators"]), stepSize=float(p["learning_rate"]), maxDepth=int(p["max_depth"]),
        minInstancesPerNode=int(p["min_child_weight"]), lossType=p["objective"], seed=seed,
    )
    if weight_col:
        gbt.setWeightCol(weight_col)
    if validation_col:
        gbt.setValidationIndicatorCol(validation_col)
        gbt.set(gbt.validationTol, float(p.get("validation_tol", 0.01)))
    return gbt


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def fit_frame(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """The frame every fit reads, persisted: labelled (asinh of the target) and assembled
    once. Its partitions are those of the plan, which adaptive execution sizes by bytes."""
    return assembler(features).transform(df.withColumn("label", F.asinh(F.col(target)))).persist(StorageLevel.MEMORY_AND_DISK)


def predict_raw(model, df: DataFrame, bound: float | None = None) -> DataFrame:
    """Model output mapped back to raw units (optionally clipped before ``sinh``)."""
    return model.transform(df).withColumn("prediction", sinh_inverse("__pred_t", bound)).drop("__pred_t")


def _mae(df: DataFrame, target: str) -> DataFrame:
    return df.agg(F.avg(F.abs(F.col(target) - F.col("prediction"))).alias("mae"), F.count(F.lit(1)).alias("n"))


def grid_search(tagged: DataFrame, features: Sequence[str], target: str, settings: Sequence[Mapping],
                folds: Sequence[int], parallelism: int = 4, bound: float | None = None) -> DataFrame:
    """Fit every (setting, fold) and score it by validation MAE in raw units.
    Returns (combo_id, fold, mae, n_val); see ``search_results`` and ``best_params``."""
    for p in settings:
        setting(p)  # refuse before the first fit
    spark = tagged.sparkSession
    data = fit_frame(tagged, features, target)

    def one(task):
        i, params, fold = task
        train, val = fold_split(data, fold)
        row = _mae(predict_raw(gbt_for(params).fit(train), val, bound), target).first()
        return i, fold, row["mae"], row["n"]

    try:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            results = list(pool.map(one, [(i, p, f) for i, p in enumerate(settings) for f in folds]))
    finally:
        data.unpersist()
    return spark.createDataFrame(results, "combo_id int, fold int, mae double, n_val long")


def search_results(scores: DataFrame, settings: Sequence[Mapping]) -> DataFrame:
    """One row per setting: its parameters, the mean of its fold MAEs, and the folds."""
    avg = scores.groupBy("combo_id").agg(F.avg("mae").alias("avg_mae"), F.count(F.lit(1)).alias("n_folds"))
    return settings_frame(scores.sparkSession, settings).join(avg, "combo_id")


def best_params(scores: DataFrame) -> DataFrame:
    """Mean fold score per combination; the first minimum (lowest combo_id among ties)."""
    avg = scores.groupBy("combo_id").agg(F.avg("mae").alias("cv_mae"), F.count(F.lit(1)).alias("n_folds"))
    return avg.orderBy(F.col("cv_mae").asc(), F.col("combo_id").asc()).limit(1)


def best_setting(scores: DataFrame, settings: Sequence[Mapping]) -> dict:
    """The winning setting itself."""
    return dict(settings[best_params(scores).first()["combo_id"]])


def walk_forward(tagged: DataFrame, features: Sequence[str], target: str, params: Mapping, folds: Sequence[int],
                 ts: str, parallelism: int = 4, bound: float | None = None) -> DataFrame:
    """Out-of-fold predictions (ts, fold, actual, prediction) of one parameter set. Each
    fold's rows are written to the shared checkpoint folder, so the result is one read
    whatever the number of folds."""
    data = fit_frame(tagged, features, target)
    schema = data.select(ts, F.lit(0).alias("fold"), F.col(target).alias("actual"), F.lit(0.0).alias("prediction")).schema
    path = os.path.join(ensure_checkpoint_dir(tagged.sparkSession), f"walk-forward-{uuid.uuid4().hex}")

    def one(fold):
        train, val = fold_split(data, fold)
        out = predict_raw(gbt_for(params).fit(train), val, bound).select(
            ts, F.lit(fold).cast("int").alias("fold"), F.col(target).alias("actual"), "prediction")
        out.write.parquet(f"{path}/part={fold}")

    try:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            list(pool.map(one, folds))
    finally:
        data.unpersist()
    if not folds:
        return tagged.sparkSession.createDataFrame([], schema)
    return tagged.sparkSession.read.schema(schema).parquet(path).select(*schema.names)


def fit_final(df: DataFrame, features: Sequence[str], target: str, params: Mapping, **kw) -> PipelineModel:
    """Fit on all rows; the model takes raw feature columns."""
    data = fit_frame(df, features, target)
    try:
        return PipelineModel(stages=[assembler(features), gbt_for(params, **kw).fit(data)])
    finally:
        data.unpersist()


def train_mae(model: PipelineModel, df: DataFrame, target: str, bound: float | None = None) -> DataFrame:
    return _mae(predict_raw(model, df, bound), target).select(F.col("mae").alias("train_mae"), F.col("n").alias("n_rows"))


def importances(spark: SparkSession, model: PipelineModel, features: Sequence[str], k: int = 30) -> DataFrame:
    """Impurity-gain importance per feature, highest first (top ``k``)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), F.col("feature")).limit(k)


def split_importances(model: PipelineModel, features: Sequence[str], path: str, k: int = 30) -> DataFrame:
    """Split-count importance (how many internal nodes split on each feature, the
    default importance kind of leaf-wise boosting libraries) plus the summed split
    gain. The trees are saved under ``path`` and their node table is aggregated by
    Spark: one row per node, grouped by feature index."""
    spark = SparkSession.getActiveSession()
    model.stages[-1].write().overwrite().save(path)
    nodes = spark.read.parquet(os.path.join(path, "data"))
    names = F.array(*[F.lit(f) for f in features])
    inner = nodes.filter(F.col("nodeData.leftChild") >= 0)
    out = inner.groupBy(F.col("nodeData.split.featureIndex").alias("idx")).agg(
        F.count(F.lit(1)).alias("splits"), F.sum("nodeData.gain").alias("total_gain"))
    out = out.select(F.element_at(names, F.col("idx") + 1).alias("feature"), "splits", "total_gain")
    return out.orderBy(F.col("splits").desc(), F.col("feature")).limit(k)


def save_model(model: PipelineModel, meta: Mapping, path: str) -> None:
    """Model plus a one-row metadata table (features, params, transforms, scores)."""
    model.write().overwrite().save(os.path.join(path, "model"))
    spark = SparkSession.getActiveSession()
    row = {k: json.dumps(v) if not isinstance(v, str) else v for k, v in meta.items()}
    write_table(spark.createDataFrame([row]), os.path.join(path, "metadata"))


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(os.path.join(path, "model")), spark.read.parquet(os.path.join(path, "metadata"))
