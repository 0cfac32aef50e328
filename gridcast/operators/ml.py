"""Forecasting on Spark ML (M1-M4, M7), all series at once.

The reference trains one sequence network on one device; here the
supervised frame is tabular (known features at the target time plus the
lag features), the forecasters are Spark ML regressors (linear, boosted
trees) fitted over every series in one distributed job and chosen on the
validation split, and importance comes from permuting held-out rows.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.functions.numeric import softplus
from gridcast.operators.series import CORE, DEFAULT_BLOCK_ROWS, block_window, core_only, halo_blocks, join_stats
from gridcast.session import materialize


def normalize_target(df: DataFrame, target: str = "target_demand", series: str = "series_id") -> DataFrame:
    """Per-series centre/scale of the inverse-softplus target and its inverse (M1).

    t = y + log1p(-exp(-y)) (inverse softplus, y > 0); norm = (t - mean_t) / std_t;
    restored = softplus(norm * std_t + mean_t), computed in stable form.
    """
    y = F.col(target)
    t = F.when(y > 0, y + F.log1p(-F.exp(-y)))
    x = df.withColumn("_t", t)
    st = x.groupBy(series).agg(F.avg("_t").alias("target_center"), F.stddev_samp("_t").alias("target_scale"))
    x = join_stats(x, st, series, "_t")
    norm = F.try_divide(F.col("_t") - F.col("target_center"), F.col("target_scale"))
    x = x.withColumn("target_norm", norm)
    restored = softplus(F.col("target_norm") * F.col("target_scale") + F.col("target_center"))
    return x.withColumn("target_restored", restored).drop("_t")


def supervised_frame(frame: DataFrame, features, encoder: int = 48, horizon: int = 24,
                     series: str = "series_id", pos: str = "pos", ts: str = "timestamp",
                     target: str = "target_demand", block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """One row per (series, origin, horizon 1..H): known features at target time + target (M2).

    Origins o have a full encoder (o >= E-1) and a full horizon (o + H <= n-1).
    A window over blocks that hold the next H rows collects the targets, so the
    rows are shuffled once and only then taken apart.
    """
    rows = frame.select(series, pos, ts, target, *features)
    blk = halo_blocks(rows, pos, after=horizon, block_rows=block_rows)
    ahead = F.collect_list(F.struct(ts, target, *features)).over(block_window(series, pos).rowsBetween(1, horizon))
    o = core_only(blk.select(series, pos, F.col(target).alias("origin_target"), CORE, ahead.alias("_ahead")))
    o = o.where((F.col(pos) >= encoder - 1) & (F.size("_ahead") == horizon))
    o = o.select(series, F.col(pos).alias("origin_pos"), "origin_target", F.posexplode("_ahead").alias("horizon", "_t"))
    return o.select(series, "origin_pos", "origin_target", (F.col("horizon") + 1).cast("int").alias("horizon"), "_t.*")


def assembler(features) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def fit_forecaster(train: DataFrame, features, label: str = "target_demand",
                   reg: float = 1e-3, max_iter: int = 100) -> PipelineModel:
    """Distributed linear forecaster over all series (M3)."""
    cast = train.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias(label))
    lr = LinearRegression(featuresCol="features", labelCol=label, predictionCol="prediction",
                          regParam=reg, elasticNetParam=0.0, maxIter=max_iter, solver="normal")
    return Pipeline(stages=[assembler(features), lr]).fit(cast)


def predict(model: PipelineModel, df: DataFrame, features, out: str = "prediction") -> DataFrame:
    feats = set(features)
    x = df.select(*[F.col(c) for c in df.columns if c not in feats],
                  *[F.col(f).cast("double").alias(f) for f in features])
    p = model.transform(x)
    return p.select(*[c for c in p.columns if c not in ("prediction", "features")], F.col("prediction").alias(out))


def linear_terms(model: PipelineModel, features) -> tuple[float, dict[str, float]]:
    """Intercept and coefficient per feature of a linear forecaster."""
    lr = model.stages[-1]
    return float(lr.intercept), {f: float(c) for f, c in zip(features, lr.coefficients.toArray())}


def is_linear(model: PipelineModel) -> bool:
    return isinstance(model.stages[-1], LinearRegressionModel)


def linear_prediction(model: PipelineModel, features, without=()) -> Column:
    """The forecast of a linear model as an expression over feature columns, some terms left out."""
    intercept, coef = linear_terms(model, features)
    out = F.lit(intercept)
    for f in features:
        if f not in without:
            out = out + F.lit(coef[f]) * F.col(f).cast("double")
    return out


def fit_boosted(train: DataFrame, features, label: str = "target_demand", trees: int = 20, depth: int = 4,
                step: float = 0.1, max_bins: int = 64, seed: int = 7) -> PipelineModel:
    """Distributed gradient-boosted trees over all series (M3).

    Split candidates are histograms of at most ``max_bins`` bins per feature, so a level of a tree costs one
    pass and a shuffle of (node, feature, bin) sums, whatever the number of rows.
    """
    cast = train.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias(label))
    gbt = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction", maxIter=trees, maxDepth=depth,
                       stepSize=step, maxBins=max_bins, seed=seed)
    return Pipeline(stages=[assembler(features), gbt]).fit(cast)


def backtest(models: dict[str, PipelineModel], frame: DataFrame, features, label: str = "target_demand",
             naive: str = "demand_lag_24h", series: str = "series_id", split: str = "split") -> DataFrame:
    """Rows and mean absolute error per split and series: a column <name>_mae for each model, and naive_mae."""
    x = frame.select(series, split, label, *dict.fromkeys([naive, *features]))
    for name, model in models.items():
        x = predict(model, x, features, f"_p_{name}")
    y = F.col(label)
    return x.groupBy(split, series).agg(
        F.count(F.lit(1)).alias("rows"), *[F.avg(F.abs(F.col(f"_p_{n}") - y)).alias(f"{n}_mae") for n in models],
        F.avg(F.abs(F.col(naive) - y)).alias("naive_mae"))


def choose_forecaster(models: dict[str, PipelineModel], validation: DataFrame, features,
                      label: str = "target_demand") -> tuple[str, PipelineModel]:
    """The model with the least mean absolute error over the validation rows (ties: the first)."""
    x = validation.select(label, *features)
    for name, model in models.items():
        x = predict(model, x, features, f"_p_{name}")
    errors = x.agg(*[F.avg(F.abs(F.col(f"_p_{n}") - F.col(label))).alias(n) for n in models]).first()
    best = min(models, key=lambda n: float("inf") if errors[n] is None else errors[n])
    return best, models[best]


#: Rows among which a feature's values are permuted.
PERMUTED_ROWS = 1024


def permuted_pairs(frame: DataFrame, features, label: str = "target_demand", series: str = "series_id", pos: str = "pos",
                   block_rows: int = PERMUTED_ROWS, seed: int = 0) -> DataFrame:
    """Each row beside another one of its series and block of positions: label, features, and the other's as _other.

    The others are a permutation of the block in the order of md5(seed:series:position).
    """
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(series).cast("string"), F.col(pos).cast("string")))
    own = F.struct(F.col(pos).alias("pos"), F.col(label).cast("double").alias("label"),
                   *[F.col(f).cast("double").alias(f) for f in features])
    other = F.struct(key.alias("key"), *[F.col(f).cast("double").alias(f) for f in features])
    blocks = frame.groupBy(series, F.floor(F.col(pos) / block_rows).alias("_blk")).agg(
        F.sort_array(F.collect_list(own)).alias("own"), F.sort_array(F.collect_list(other)).alias("other"))
    pairs = blocks.select(F.inline(F.arrays_zip("own", "other")))
    return pairs.select(F.col("own.label").alias("_label"), *[F.col(f"own.{f}").alias(f) for f in features], F.col("other").alias("_other"))


def permutation_importance(model: PipelineModel, frame: DataFrame, features, label: str = "target_demand",
                           series: str = "series_id", pos: str = "pos", block_rows: int = PERMUTED_ROWS, seed: int = 0) -> DataFrame:
    """Growth of the mean absolute error when a feature's values are permuted within blocks of each series (M7).

    feature, importance, rank. A linear model needs one pass for all features,
    as the forecast moves by coefficient x (other value - own value); any other
    model one pass per feature over the written pairs.
    """
    features = list(features)
    pairs = permuted_pairs(frame, features, label, series, pos, block_rows, seed)
    y = F.col("_label")

    def other(f):
        return F.col("_other").getField(f)

    if is_linear(model):
        _, coef = linear_terms(model, features)
        said = linear_prediction(model, features)
        sums = pairs.agg(F.avg(F.abs(said - y)).alias("_base"), *[
            F.avg(F.abs(said + F.lit(coef[f]) * (other(f) - F.col(f)) - y)).alias(f"_f{i}") for i, f in enumerate(features)])
        cells = F.array(*[F.struct(F.lit(f).alias("feature"), (F.col(f"_f{i}") - F.col("_base")).alias("importance"))
                          for i, f in enumerate(features)])
        rows = sums.select(F.inline(cells))
    else:
        pairs = materialize(pairs, "permuted-pairs")
        base = predict(model, pairs, features, "_p").agg(F.avg(F.abs(F.col("_p") - y)).alias("_base"))
        rows = None
        for f in features:
            moved = pairs.select("_label", *[(other(c) if c == f else F.col(c)).alias(c) for c in features])
            one = predict(model, moved, features, "_p").agg(F.lit(f).alias("feature"), F.avg(F.abs(F.col("_p") - y)).alias("_moved"))
            rows = one if rows is None else rows.unionByName(one)
        rows = rows.join(base).select("feature", (F.col("_moved") - F.col("_base")).alias("importance"))  # one row beside one per feature
    order = Window.orderBy(F.desc("importance"), "feature")  # a row per feature
    return rows.select("feature", "importance", F.row_number().over(order).alias("rank"))
