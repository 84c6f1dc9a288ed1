"""Model features, training and scoring with Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import AFTSurvivalRegression, GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from retailpot.config import Config
from retailpot.functions.numeric import half_even
from retailpot.operators.boosting import Booster, Fit, censored_normal
from retailpot.operators.target_codes import TargetCodeModel, TargetCodes
from retailpot.operators.quantiles import scalar_quantiles

# --- fixed values: column groups of the feature strategies -----------------------------------
CATEGORICALS = ("Outlet_Type", "Outlet_Size", "province", "market_saturation_class")
REDUNDANT = ("hist_p75_monthly", "hist_mean_monthly", "total_volume", "hist_std_monthly", "ema_6m", "recent_3m_avg", "jan_max_volume")
LEAKING = ("hist_p90_monthly", "hist_max_monthly", "jan_avg_volume", "ema_3m", "capacity_utilization_ratio",
           "cluster_mean_volume", "cluster_p90_volume", "tobit_censoring_ratio")
GRAVITY = ("school_gravity_score", "hospital_gravity_score", "transport_gravity_score", "market_gravity_score",
           "worship_gravity_score", "hospitality_gravity_score", "composite_gravity_score", "raw_composite_gravity")
BOOLEAN_NOISE = ("size_imputed", "coords_swapped", "poi_data_available", "gravity_data_available")
SUBMODEL_OUTPUTS = ("tobit_latent_estimate", "tobit_censoring_ratio", "p_active", "hurdle_conditional_volume", "hurdle_estimate")
FLAT_POI = tuple(f"{c}_{r}m" for c in ("schools", "hospitals", "transport", "markets", "worship", "hospitality")
                 for r in (500, 1000, 2000)) + ("footfall_score",)
# strategy -> (column groups left out on top of the base, interaction features)
STRATEGIES: dict[str, tuple[tuple, bool]] = {
    "round1_baseline": ((REDUNDANT,), False),
    "strategyA": ((REDUNDANT, LEAKING), False),
    "strategyC": ((REDUNDANT, LEAKING), True),
    "strategyA_gravity_only": ((REDUNDANT, LEAKING, FLAT_POI), False),
    "strategyA_flat_only": ((REDUNDANT, LEAKING, GRAVITY), False),
    "strategyC_clean": ((REDUNDANT, LEAKING, BOOLEAN_NOISE), True),
    "strategyA_gravity_clean": ((REDUNDANT, LEAKING, FLAT_POI, BOOLEAN_NOISE), False),
    "strategyA_flat_clean": ((REDUNDANT, LEAKING, GRAVITY, BOOLEAN_NOISE), False),
}
INTERACTIONS = {
    "gravity_x_cooler": ("composite_gravity_score", "Cooler_Count"),
    "gravity_x_active_months": ("composite_gravity_score", "active_months_pct"),
    "catchment_x_cooler": ("competition_density_score", "Cooler_Count"),
    "transport_x_school": ("transport_gravity_score", "school_gravity_score"),
}
PERCENTILES = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
DIAGNOSTICS = (
    "Outlet_ID", "Outlet_Size", "Outlet_Type", "province", "Cooler_Count", "hist_p90_monthly", "hist_max_monthly",
    "jan_avg_volume", "has_transaction_history", "seasonality", "seasonality_multiplier", "footfall_score",
    "composite_gravity_score", "poi_total_1km", "model_prediction", "baseline_potential_litres", "Maximum_Monthly_Liters",
)
# ---------------------------------------------------------------------------------------------


def base_exclude(cfg: Config) -> tuple:
    label = cfg.target_label
    return ("Outlet_ID", f"seasonality_{label}", "distributor_id", "target", "has_transaction_history", "exclude_from_training",
            "baseline_potential_litres", f"{label}_holiday_count", f"{label}_trading_days")


def training_target(master: DataFrame, cfg: Config) -> DataFrame:
    """Rows with history and own coordinates, with ``target`` = P90 x season x trading days / 22."""
    label = cfg.target_label
    target = F.col("hist_p90_monthly") * F.col(f"seasonality_multiplier_{label}") * (F.col(f"{label}_trading_days") / F.lit(cfg.working_days))
    return master.where("has_transaction_history and not exclude_from_training").withColumn("target", target)


def interaction_features(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    return df.withColumns({n: F.col(a) * F.col(b) for n, (a, b) in INTERACTIONS.items() if {a, b} <= have})


def feature_columns(df: DataFrame, strategy: str, cfg: Config) -> list[str]:
    """Columns a strategy trains on: all but its exclusions."""
    groups, _ = STRATEGIES[strategy]
    out = set(base_exclude(cfg)).union(*groups)
    return [c for c in df.columns if c not in out]


def apply_strategy(df: DataFrame, strategy: str, cfg: Config) -> tuple[DataFrame, list[str]]:
    if STRATEGIES[strategy][1]:
        df = interaction_features(df)
    return df, feature_columns(df, strategy, cfg)


def strategy_table(df: DataFrame, cfg: Config) -> DataFrame:
    """(strategy, feature, filled, mean): what each strategy keeps, with the filled cells and, for numbers, the mean over all rows."""
    kept = {s: apply_strategy(df, s, cfg)[1] for s in STRATEGIES}
    wide = interaction_features(df) if any(STRATEGIES[s][1] for s in STRATEGIES) else df
    kinds = dict(wide.dtypes)
    names = sorted({c for columns in kept.values() for c in columns})
    numeric = {c: kinds[c] not in ("string", "date") for c in names}
    cells = [F.struct(F.array(*[F.lit(s) for s in STRATEGIES if c in kept[s]]).alias("strategies"), F.lit(c).alias("feature"), F.count(c).alias("filled"),
                      (F.avg(F.col(c).cast("double")) if numeric[c] else F.lit(None).cast("double")).alias("mean")) for c in names]
    rows = wide.agg(F.array(*cells).alias("rows")).select(F.explode("rows").alias("r"))
    return rows.select(F.explode("r.strategies").alias("strategy"), "r.feature", "r.filled", "r.mean")


def encode_categoricals(df: DataFrame, columns: Sequence[str] = CATEGORICALS) -> tuple[DataFrame, list[str]]:
    """Alphabetical codes, one fitted indexer for training and scoring alike."""
    have = [c for c in columns if c in df.columns]
    model = _indexer(have).fit(df)
    coded = model.transform(df)
    return coded, [f"{c}_code" for c in have]


def _indexer(columns: Sequence[str]) -> StringIndexer:
    return StringIndexer(inputCols=list(columns), outputCols=[f"{c}_code" for c in columns],
                         stringOrderType="alphabetAsc", handleInvalid="keep")


def with_fold(df: DataFrame, cfg: Config, key: str = "Outlet_ID") -> DataFrame:
    """Fold by a hash of the id: stable under repartitioning."""
    return df.withColumn("fold", F.pmod(F.xxhash64(F.col(key), F.lit(cfg.seed)), F.lit(cfg.folds)).cast("int"))


def _numeric(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Booleans to 0/1 and missing numbers to 0, as the assembler needs."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    fix = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features if isinstance(kinds[c], (NumericType, BooleanType))}
    return df.withColumns(fix)


def regressor(algorithm: str, cfg: Config, **params) -> Estimator:
    if algorithm == "randomforest":
        return RandomForestRegressor(labelCol="target", featuresCol="features", seed=cfg.seed,
                                     **{"numTrees": 60, "maxDepth": 8, "minInstancesPerNode": 2, "featureSubsetStrategy": "0.8", **params})
    if algorithm == "gbt":
        return GBTRegressor(labelCol="target", featuresCol="features", seed=cfg.seed,
                            **{"maxIter": 40, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.8, **params})
    raise ValueError(f"Unknown algorithm: {algorithm}")


def preparation(df: DataFrame, features: Sequence[str]) -> Pipeline:
    cats = [c for c in CATEGORICALS if c in features]
    inputs = [f"{c}_code" if c in cats else c for c in features]
    return Pipeline(stages=[*([_indexer(cats)] if cats else []), VectorAssembler(inputCols=inputs, outputCol="features")])


class Prepared:
    """Assembled features of all outlets, with target and fold on the training rows."""

    def __init__(self, master: DataFrame, cfg: Config, strategy: str = "strategyC", ordered: bool = False):
        """``ordered`` leaves the categories as they are, beside the other features in ``numbers``, for a model that codes them itself."""
        df, self.features = apply_strategy(master, strategy, cfg)
        df = _numeric(df, self.features)
        self.categories = [c for c in CATEGORICALS if c in self.features]
        if ordered:
            self.features = [c for c in self.features if c not in self.categories] + self.categories
            numbers = VectorAssembler(inputCols=self.features[: len(self.features) - len(self.categories)], outputCol="numbers")
            self.pipeline: PipelineModel = Pipeline(stages=[numbers]).fit(df)
        else:
            self.pipeline = preparation(df, self.features).fit(df)
        own = ["numbers", *self.categories] if ordered else ["features"]
        keep = [c for c in ("Outlet_ID", *own, "hist_p90_monthly", "hist_max_monthly", "capacity_utilization_ratio",
                            "has_transaction_history", "exclude_from_training") if c in [*df.columns, *own]]
        label = cfg.target_label
        ready = with_fold(self.pipeline.transform(df), cfg)
        self.all = ready.select(*keep, "fold", f"seasonality_multiplier_{label}", f"{label}_trading_days")
        self.train = training_target(self.all, cfg)


# --- validation and training -----------------------------------------------------------------

def regression_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Row count, RMSE, MAE and R2 (null for a constant label)."""
    e = F.col(prediction) - F.col(label)
    sse, n = F.sum(e * e), F.count("*")
    sst = F.sum(F.col(label) * F.col(label)) - n * F.avg(label) * F.avg(label)
    return df.groupBy(*by).agg(n.alias("n"), F.sqrt(F.try_divide(sse, n)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), (1 - F.try_divide(sse, sst)).alias("r2"))


def kfold_cv(train: DataFrame, estimator: Estimator, cfg: Config) -> DataFrame:
    """RMSE and MAE per held-out fold, then their mean and population deviation (fold = mean / std)."""
    scored = None
    for k in range(cfg.folds):
        model = estimator.fit(train.where(F.col("fold") != k))
        part = model.transform(train.where(F.col("fold") == k)).select("fold", "target", "prediction")
        scored = part if scored is None else scored.unionByName(part)
    per = regression_metrics(scored, "target", "prediction", ["fold"]).select(F.col("fold").cast("string").alias("fold"), "rmse", "mae")
    mean = per.agg(F.lit("mean").alias("fold"), F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae"))
    std = per.agg(F.lit("std").alias("fold"), F.stddev_pop("rmse").alias("rmse"), F.stddev_pop("mae").alias("mae"))
    return per.unionByName(mean).unionByName(std)


def train_regressor(prep: Prepared, estimator: Estimator) -> tuple[Model, DataFrame]:
    """Fit on every training row and predict every outlet, at least 0, two decimals."""
    model = estimator.fit(prep.train)
    out = model.transform(prep.all).select("Outlet_ID", half_even(F.greatest(F.col("prediction"), F.lit(0.0)), 2).alias("model_prediction"))
    return model, out


class OrderedBoosting(NamedTuple):
    """Boosted trees over ``numbers`` and categories coded by ordered target statistics, with as many rounds as held-out rows bear out.

    Held-out rows are the given ones or a share by a hash of the id. They stop the boosting; with ``refit`` the model is then fitted once
    more on every row, with the number of rounds found.
    """

    codes: TargetCodes
    booster: Booster
    share: float = 0.1
    refit: bool = True

    def fit(self, train: DataFrame, held_out: Column | None = None) -> OrderedBoostingModel:
        aside = held_out if held_out is not None else F.pmod(F.xxhash64(self.codes.key, F.lit(self.codes.seed + 1)), F.lit(1000)) < int(self.share * 1000)
        marked = train.withColumn("_held", F.coalesce(aside, F.lit(False)))
        codes = self.codes.fit(marked.where("not _held"))
        rows = codes.ordered(marked.where("not _held")).unionByName(codes.transform(marked.where("_held")))
        fitted = self.booster.fit(self.assembled(rows), F.col("_held"))
        if self.refit and fitted.held_out_loss:
            codes = self.codes.fit(train)
            again = self.booster._replace(rounds=fitted.kept).fit(self.assembled(codes.ordered(train)))
            fitted = again._replace(held_out_loss=fitted.held_out_loss)
        return OrderedBoostingModel(self, codes, fitted)

    def assembled(self, coded: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=["numbers", *[f"{c}_code" for c in self.codes.columns]], outputCol="features").transform(coded)


class OrderedBoostingModel(NamedTuple):
    settings: OrderedBoosting
    codes: TargetCodeModel
    fitted: Fit

    def assembled(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``features`` as the trees see them."""
        return self.settings.assembled(self.codes.transform(rows))

    def transform(self, rows: DataFrame) -> DataFrame:
        return self.fitted.transform(self.assembled(rows))


def feature_importance(spark, model: Model, features: Sequence[str]) -> DataFrame:
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def param_search(train: DataFrame, estimator: Estimator, grid: Mapping[str, Sequence], cfg: Config, parallelism: int = 2) -> DataFrame:
    """Mean cross-validated RMSE per parameter set, best first."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    maps = builder.build()
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, numFolds=cfg.folds, foldCol="fold", parallelism=parallelism,
                        evaluator=RegressionEvaluator(labelCol="target", predictionCol="prediction", metricName="rmse"))
    scores = cv.fit(train).avgMetrics
    rows = [(", ".join(f"{p.name}={v}" for p, v in m.items()), float(s)) for m, s in zip(maps, scores)]
    return train.sparkSession.createDataFrame(rows, "params string, mean_rmse double").orderBy("mean_rmse", "params")


def oof_predict(train: DataFrame, everyone: DataFrame, estimator: Estimator, cfg: Config, name: str, parallelism: int = 3) -> DataFrame:
    """Training rows by the model that did not see their fold, all others by the average of the folds; folds are fitted side by side."""
    own = everyone.join(train.select("Outlet_ID", F.col("fold").alias("held_out_fold")), "Outlet_ID", "left")
    rest, names, parts = own.where("held_out_fold is null"), [], []
    with ThreadPool(parallelism) as pool:
        fitted = pool.map(inheritable_thread_target(train.sparkSession)(lambda k: estimator.fit(train.where(F.col("fold") != k))), range(cfg.folds))
    for k, model in enumerate(fitted):
        parts.append(model.transform(own.where(F.col("held_out_fold") == k)).select("Outlet_ID", "held_out_fold", F.col("prediction").alias(name)))
        names.append(f"_p{k}")
        extra = set(model.transform(rest).columns) - set(rest.columns)
        rest = model.transform(rest).withColumnRenamed("prediction", names[-1]).drop(*(extra - {"prediction"}))
    average = F.aggregate(F.array(*names), F.lit(0.0), lambda a, x: a + x) / F.lit(float(cfg.folds))
    parts.append(rest.select("Outlet_ID", "held_out_fold", average.alias(name)))
    return reduce(DataFrame.unionByName, parts)


# --- censored and hurdle sub-models ----------------------------------------------------------

def censor_labels(df: DataFrame) -> DataFrame:
    """Observed volume as lower bound; the upper bound is null (open) for outlets at their limit."""
    observed = F.greatest(F.col("hist_p90_monthly"), F.lit(1e-3))
    if "capacity_utilization_ratio" in df.columns:
        limited = F.col("capacity_utilization_ratio") >= 0.8
    else:
        top = F.col("hist_max_monthly")
        limited = (top > 0) & (observed / F.greatest(top, F.lit(1e-3)) > 0.85)
    return df.withColumns({"lower_bound": observed, "upper_bound": F.when(~limited, observed),
                           "censor": F.when(limited, F.lit(0.0)).otherwise(F.lit(1.0))})


def latent_demand(prep: Prepared, cfg: Config, estimator=None) -> DataFrame:
    """Out-of-fold estimate of demand without the capacity limit, by boosted trees on the censored normal likelihood of log demand."""
    labelled = censor_labels(prep.train).withColumn("label", F.col("lower_bound"))
    model = estimator or Booster(censored_normal(), rounds=cfg.latent_rounds, rate=0.05, subsample=0.8, seed=cfg.seed)
    raw = oof_predict(labelled, prep.all, model, cfg, "estimate")
    return raw.select("Outlet_ID", half_even(F.greatest(F.col("estimate"), F.lit(0.0)), 4).alias("tobit_latent_estimate"))


def linear_latent(**params) -> Estimator:
    """The linear form of the same model, with Weibull noise."""
    return AFTSurvivalRegression(**{"labelCol": "label", "censorCol": "censor", "featuresCol": "features", "maxIter": 60, **params})


def censoring_ratio(estimate: Column, p90: Column) -> Column:
    return half_even(F.greatest(estimate / F.greatest(p90, F.lit(1e-3)) - 1.0, F.lit(0.0)), 4)


def hurdle_active_prob(prep: Prepared, cfg: Config) -> DataFrame:
    """P(active) of every outlet from a class-balanced logistic model on standardised features."""
    train = prep.train.withColumn("label", (F.col("hist_p90_monthly") > 0).cast("double"))
    n = {r.label: r.n for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows at most
    if len(n) < 2:
        return prep.all.select("Outlet_ID", F.col("has_transaction_history").cast("double").alias("p_active"))
    total = sum(n.values())
    weight = F.when(F.col("label") == 1.0, F.lit(total / (2.0 * n[1.0]))).otherwise(F.lit(total / (2.0 * n[0.0])))
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    logistic = LogisticRegression(featuresCol="scaled", labelCol="label", weightCol="weight", maxIter=200, regParam=1.0 / total, standardization=False)
    model = Pipeline(stages=[scaler, logistic]).fit(train.withColumn("weight", weight))
    return model.transform(prep.all).select("Outlet_ID", half_even(vector_to_array("probability")[1], 4).alias("p_active"))


def hurdle_conditional(prep: Prepared, cfg: Config, estimator: Estimator | None = None) -> DataFrame:
    """Expected volume given activity (the seasonal training target), out of fold on the active training rows."""
    raw = oof_predict(prep.train.where("hist_p90_monthly > 0"), prep.all, estimator or regressor("gbt", cfg), cfg, "v")
    return raw.select("Outlet_ID", half_even(F.greatest(F.col("v"), F.lit(0.0)), 4).alias("hurdle_conditional_volume"))


def hurdle_estimate(prob: DataFrame, volume: DataFrame) -> DataFrame:
    return prob.join(volume, "Outlet_ID").withColumn("hurdle_estimate", half_even(F.col("p_active") * F.col("hurdle_conditional_volume"), 4))


# --- blending and final predictions ----------------------------------------------------------

def ensemble_blend(tables: Sequence[DataFrame], weights: Sequence[float] | None = None, column: str = "model_prediction") -> DataFrame:
    """Weighted sum of prediction tables on the outlets of the first; weights are used as given."""
    weights = list(weights) if weights else [1.0 / len(tables)] * len(tables)
    if len(weights) != len(tables):
        raise ValueError("Number of weights must match the number of prediction tables.")
    out, total = tables[0].select("Outlet_ID", F.col(column).alias("_p0")), F.col("_p0") * F.lit(weights[0])
    for i, t in enumerate(tables[1:], 1):
        out = out.join(t.select("Outlet_ID", F.col(column).alias(f"_p{i}")), "Outlet_ID", "left")
        total = total + F.col(f"_p{i}") * F.lit(weights[i])
    # an outlet that some table lacks has no blend: null, not 0
    return out.select("Outlet_ID", F.when(total.isNotNull(), half_even(F.greatest(total, F.lit(0.0)), 2)).alias("model_prediction"))


def floor_blend(model: DataFrame, baseline: DataFrame) -> DataFrame:
    """The larger of model and baseline; not positive becomes 1.0; two decimals."""
    df = model.join(baseline.select("Outlet_ID", "baseline_potential_litres"), "Outlet_ID", "left")
    best = F.greatest("model_prediction", "baseline_potential_litres")
    return df.withColumn("Maximum_Monthly_Liters", half_even(F.when(best <= 0, F.lit(1.0)).otherwise(best), 2))


def prediction_distribution(final: DataFrame) -> DataFrame:
    """(metric, value) rows: seven percentiles, rows above 5 x P99 and who won."""
    v = "Maximum_Monthly_Liters"
    qs = scalar_quantiles(final, v, PERCENTILES)
    one = final.agg(
        *[F.lit(qs[i]).alias(f"p{round(p * 100):02d}") for i, p in enumerate(PERCENTILES)],
        F.count_if(F.col(v) > 5 * qs[len(PERCENTILES) - 1]).cast("double").alias("above_5x_p99"),
        F.count_if(F.col("baseline_potential_litres") >= F.col("model_prediction")).cast("double").alias("baseline_won"),
        F.count_if(F.col("model_prediction") > F.col("baseline_potential_litres")).cast("double").alias("model_won"))
    return one.unpivot([], one.columns, "metric", "value")


def extreme_predictions(final: DataFrame) -> DataFrame:
    v = "Maximum_Monthly_Liters"
    return final.where(F.col(v) > 5 * scalar_quantiles(final, v, [0.99])[0]).select("Outlet_ID", v)


def prediction_diagnostics(final: DataFrame, master: DataFrame, cfg: Config) -> DataFrame:
    """Prediction with the context columns that exist."""
    label = cfg.target_label
    names = {"seasonality": f"seasonality_{label}", "seasonality_multiplier": f"seasonality_multiplier_{label}"}
    df = master.join(final, "Outlet_ID")
    wanted = [names.get(c, c) for c in DIAGNOSTICS]
    return df.select(*[c for c in wanted if c in df.columns])


def registry_entry(spark, run_id: str, algorithm: str, strategy: str, features: Sequence[str], cv: DataFrame) -> DataFrame:
    """One row of settings and scores of a run."""
    scores = {r.fold: r for r in cv.where("fold in ('mean', 'std')").collect()}  # two rows
    row = (run_id, algorithm, strategy, len(features), list(features), scores["mean"].rmse, scores["std"].rmse, scores["mean"].mae, scores["std"].mae)
    return spark.createDataFrame([row], "run_id string, algorithm string, strategy string, n_features int, features array<string>, "
                                        "cv_rmse_mean double, cv_rmse_std double, cv_mae_mean double, cv_mae_std double")


