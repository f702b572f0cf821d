"""Propensity, segmentation and lifetime-value models on Spark ML
(ML1-ML8, AG15, PRJ14).

Training, scoring and evaluation stay on the executors (``pyspark.ml``); the
only driver-side values are model parameters and a handful of metrics.
"""

from __future__ import annotations

import itertools
import math
import random
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, ClusteringEvaluator,
                                   RegressionEvaluator)
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import ratio
from ..functions.labels import propensity_band
from ..session import scratch_path, shared_dir

# --- fixed values -------------------------------------------------------------
SEED = 42
CAT_COLS = ["marketing_channel", "device_type", "channel_group"]
NUM_COLS = ["is_repeat_int", "is_weekend_int", "session_hour", "day_of_week"]
SAMPLE_FRAC = 0.20
TRAIN_PCT = 80
GBT_SPACE = {                       # 3^5 = 243 combinations, 12 sampled
    "maxIter": [50, 100, 150],
    "maxDepth": [2, 3, 4],
    "stepSize": [0.05, 0.1, 0.15],
    "minInstancesPerNode": [50, 100, 200],
    "subsamplingRate": [0.7, 0.8, 1.0],
}
N_SEARCH = 12
MIN_FIT_ROWS = 5000  # a sample has about this many rows at least, or all there are
MAX_FIT_ROWS = 500_000  # and about this many at most
FOLDS = 3
MAX_BINS = 46_340  # its square is about the largest int of the JVM
FITS_AT_ONCE = 3  # of a search: a fit is many short jobs, which leave cores idle
KM_NUM = ["total_orders", "gross_lifetime_value", "avg_order_value", "refund_rate_pct",
          "distinct_products_ordered"]
KM_CAT = "acquisition_channel"
KM_K = 4
# ------------------------------------------------------------------------------


def training_set(sessions: DataFrame, orders: DataFrame) -> DataFrame:
    """ML1: one row per session, label = the session has an order (orders
    rolled up to session first, so a 2-order session is still one row)."""
    conv = (orders.filter(F.col("website_session_id").isNotNull())
            .select("website_session_id").distinct().withColumn("converted_label", F.lit(1)))
    return (sessions.join(conv, "website_session_id", "left")
            .select("website_session_id", "user_id", *CAT_COLS, "session_hour", "day_of_week",
                    F.col("is_repeat_session").cast("int").alias("is_repeat_int"),
                    F.col("is_weekend").cast("int").alias("is_weekend_int"),
                    "session_year", "session_month",
                    F.coalesce("converted_label", F.lit(0)).alias("converted_label"))
            .filter(F.col("website_session_id").isNotNull()))


def stratified_sample(df: DataFrame, key="website_session_id", frac=SAMPLE_FRAC, seed=SEED) -> DataFrame:
    """ML2: the same fraction of each class, by a hash of the key: which rows are
    taken doesn't depend on how they are partitioned."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    return df.filter(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 1_000_000 < int(frac * 1_000_000))


def fit_sample(train: DataFrame) -> DataFrame:
    """What the GBT search of the scores is fitted on, one rule at every size: a hash sample of
    ``SAMPLE_FRAC`` of the rows, but of about ``MIN_FIT_ROWS`` at least (with no more
    rows than that: all) and of about ``MAX_FIT_ROWS`` at most."""
    n = max(train.count(), 1)
    return stratified_sample(train, frac=min(max(SAMPLE_FRAC, MIN_FIT_ROWS / n), MAX_FIT_ROWS / n))


def split(df: DataFrame, key="website_session_id", train_pct=TRAIN_PCT, seed=SEED):
    """ML2: deterministic hash split; every class is split by the same hash,
    so class shares are preserved in expectation."""
    h = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(100))
    return df.filter(h < train_pct), df.filter(h >= train_pct)


def class_weights(df: DataFrame, label="converted_label") -> DataFrame:
    """ML2: weight = n / (2 * n_class). The per-class table has one row per
    class (bounded by the label domain), so its broadcast is size-safe."""
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = per.agg(F.sum("_nc").alias("_n"))
    w = per.crossJoin(tot).select(label, (F.col("_n") / (2.0 * F.col("_nc"))).alias("weight"))
    return df.join(F.broadcast(w), label, "left")


class ModeImputer(Estimator, HasInputCols, HasOutputCols):
    """Fills null categories with the most frequent value of the rows it is fitted on (of
    equally frequent ones the smallest); a column with nulls only stays null."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ModeImputerModel":
        cols = self.getInputCols()
        long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v"))
                                             for i, c in enumerate(cols)])).alias("x")).select("x.*")
        counts = long.where("v IS NOT NULL").groupBy("i", "v").count()
        best = counts.groupBy("i").agg(F.min_by("v", F.struct(-F.col("count"), F.col("v"))).alias("v"))
        modes = {r.i: r.v for r in best.collect()}  # a row a column
        model = ModeImputerModel([modes.get(i) for i in range(len(cols))])
        return self._copyValues(model)


class ModeImputerModel(Model, HasInputCols, HasOutputCols):
    def __init__(self, modes=()):
        super().__init__()
        self.modes = list(modes)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({o: F.coalesce(F.col(c).cast("string"), F.lit(m))
                               for c, o, m in zip(self.getInputCols(), self.getOutputCols(), self.modes)})


def _features(cat_cols=CAT_COLS, num_cols=NUM_COLS):
    """ML3 preprocessing: median impute + scale numerics, mode impute + index + one-hot
    categoricals (unseen -> extra slot); fit on the training split only."""
    mode = ModeImputer(inputCols=list(cat_cols), outputCols=[f"{c}_filled" for c in cat_cols])
    idx = [StringIndexer(inputCol=f"{c}_filled", outputCol=f"{c}_idx", handleInvalid="keep") for c in cat_cols]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in cat_cols],
                        outputCols=[f"{c}_ohe" for c in cat_cols], handleInvalid="keep")
    imp = Imputer(inputCols=num_cols, outputCols=[f"{c}_imp" for c in num_cols], strategy="median")
    num_vec = VectorAssembler(inputCols=[f"{c}_imp" for c in num_cols], outputCol="num_vec")
    scale = StandardScaler(inputCol="num_vec", outputCol="num_scaled", withMean=True, withStd=True)
    allv = VectorAssembler(inputCols=["num_scaled"] + [f"{c}_ohe" for c in cat_cols], outputCol="features")
    return [mode] + idx + [ohe, imp, num_vec, scale, allv]


def _prepare(df: DataFrame, num_cols=NUM_COLS) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in num_cols})


def fit_logistic(train: DataFrame, label="converted_label"):
    """ML3 baseline: class-weighted logistic regression (weighted once)."""
    lr = LogisticRegression(featuresCol="features", labelCol=label, weightCol="weight",
                            maxIter=100, regParam=0.0)
    fitted = Pipeline(stages=_features() + [lr]).fit(_prepare(class_weights(train, label)))
    # The training summary inside a fitted model holds the session, which can't be sent to
    # tasks once the session has observed a write; a model read back has no summary.
    path = scratch_path(train.sparkSession, "logistic")
    fitted.stages[-1].write().overwrite().save(path)
    return PipelineModel(stages=[*fitted.stages[:-1], LogisticRegressionModel.load(path)])


def search_gbt(train: DataFrame, label="converted_label", n_search=N_SEARCH, folds=FOLDS,
               seed=SEED, space=GBT_SPACE, parallelism=FITS_AT_ONCE):
    """ML4: random search of ``n_search`` of the grid's combinations,
    ``folds``-fold CV scored by ROC-AUC; returns the refit best pipeline.

    Like the source search (10% validation fraction with early stopping),
    boosting stops once the error on a 10% hash-selected validation slice
    stops improving, so ``maxIter`` is an upper bound.

    Thresholds come from all rows: Spark looks for them in as many as the square of
    ``maxBins``, so that follows the root of the rows (up to ``MAX_BINS``, 2,147 million
    rows). A number has few values (at most 24, hours), so bins stay as few as those."""
    shared_dir(train.sparkSession)   # tree learners checkpoint node caches to the shared folder
    gbt = GBTClassifier(featuresCol="features", labelCol=label, weightCol="weight", seed=seed,
                        validationIndicatorCol="is_validation", checkpointInterval=10)
    names = list(space)
    combos = list(itertools.product(*[space[n] for n in names]))
    picked = random.Random(seed).sample(combos, min(n_search, len(combos)))
    maps = [{getattr(gbt, n): v for n, v in zip(names, c)} for c in picked]
    d = _prepare(class_weights(train, label)).withColumn(
        "is_validation", F.pmod(F.xxhash64("website_session_id", F.lit(seed + 1)), F.lit(10)) == 0)
    # Features are made once and written: the folds' fits then read three columns, a few fits
    # at a time, and the driver holds as many models' plans.
    prepared = Pipeline(stages=_features()).fit(d)
    path = scratch_path(train.sparkSession, "gbt-features")
    prepared.transform(d).select("features", label, "weight", "is_validation").write.parquet(path)
    cv = CrossValidator(estimator=gbt, estimatorParamMaps=maps,
                        evaluator=BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC"),
                        numFolds=folds, seed=seed, parallelism=parallelism)
    feats = train.sparkSession.read.parquet(path)
    gbt.setMaxBins(min(max(gbt.getMaxBins(), math.isqrt(feats.count()) + 1), MAX_BINS))
    best = cv.fit(feats).bestModel
    return PipelineModel(stages=[*prepared.stages, best])


def score(model, df: DataFrame, threshold=0.5) -> DataFrame:
    """ML3 scoring of every session + PRJ14 band."""
    p = model.transform(_prepare(df))
    prob = vector_to_array("probability")[1]
    return (p.withColumn("conversion_prob", prob)
            .withColumn("predicted_conversion", (F.col("conversion_prob") >= threshold).cast("int"))
            .withColumn("propensity_segment", propensity_band("conversion_prob"))
            .select("website_session_id", "user_id", "marketing_channel", "device_type", "is_repeat_int",
                    "session_year", "session_month", "converted_label", "conversion_prob",
                    "predicted_conversion", "propensity_segment"))


def confusion_metrics(pred: DataFrame, label="converted_label", predicted="predicted_conversion",
                      group_cols=()) -> DataFrame:
    """AG15: TP/FP/FN/TN counts, precision, recall, accuracy, F1."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    g = pred.groupBy(*group_cols).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    g = g.withColumns({"precision": ratio("tp", F.col("tp") + F.col("fp")),
                       "recall": ratio("tp", F.col("tp") + F.col("fn")),
                       "accuracy": ratio(F.col("tp") + F.col("tn"),
                                         F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))})
    return g.withColumn("f1", F.try_divide(2.0 * F.col("precision") * F.col("recall"),
                                           F.col("precision") + F.col("recall")))


def model_metrics(spark: SparkSession, scored_test: DataFrame, model_name: str,
                  label="converted_label") -> DataFrame:
    """ML6: ROC-AUC and PR-AUC (Spark evaluators) + AG15 on the test split."""
    s = scored_test.withColumn("score", F.col("conversion_prob").cast("double"))
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="score")
    roc = ev.setMetricName("areaUnderROC").evaluate(s)
    pr = ev.setMetricName("areaUnderPR").evaluate(s)
    cm = confusion_metrics(scored_test)
    return cm.select(F.lit(model_name).alias("model"), F.lit(roc).alias("roc_auc"),
                     F.lit(pr).alias("pr_auc"), "precision", "recall", "f1", "accuracy",
                     "tp", "fp", "fn", "tn")


def feature_importances(model, df: DataFrame) -> DataFrame:
    """ML6: the best GBT's importance of each feature, by name (a row per slot of
    the feature vector; names from its attributes)."""
    attrs = model.transform(_prepare(df)).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    rows = [(k, names[k], float(x)) for k, x in enumerate(model.stages[-1].featureImportances.toArray())]
    # The scaled numbers keep only their places in the vector.
    rows = [(k, NUM_COLS[k] if k < len(NUM_COLS) else name, x) for k, name, x in rows]
    return df.sparkSession.createDataFrame(rows, "slot int, feature string, importance double")


def segment_features(users: DataFrame) -> DataFrame:
    return users.select("user_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in KM_NUM],
                        F.coalesce(F.col(KM_CAT), F.lit("unknown")).alias(KM_CAT))


def _km_stages():
    idx = StringIndexer(inputCol=KM_CAT, outputCol="ch_idx", handleInvalid="keep")
    ohe = OneHotEncoder(inputCols=["ch_idx"], outputCols=["ch_ohe"], handleInvalid="keep")
    num = VectorAssembler(inputCols=KM_NUM, outputCol="num_vec")
    sc = StandardScaler(inputCol="num_vec", outputCol="num_scaled", withMean=True, withStd=True)
    allv = VectorAssembler(inputCols=["num_scaled", "ch_ohe"], outputCol="features")
    return [idx, ohe, num, sc, allv]


KM_INITS, ELBOW_INITS = 5, 2  # starts of a clustering; the one with the least cost stays
STARTS_AT_ONCE = 3  # rounds are short jobs; each start holds the features once in the executors


def _written_features(users: DataFrame) -> DataFrame:
    """Features of every customer, made once: each start and each round reads these."""
    feats = segment_features(users)
    path = scratch_path(users.sparkSession, "segment-features")
    Pipeline(stages=_km_stages()).fit(feats).transform(feats).select(
        "user_id", *KM_NUM, KM_CAT, "features").write.parquet(path)
    return users.sparkSession.read.parquet(path)


def _best_start(feats: DataFrame, k: int, inits: int, seed: int, max_iter: int):
    """The clustering with the least cost of ``inits`` starts (the first of equal ones)."""
    @inheritable_thread_target(feats.sparkSession)
    def start(i):
        return KMeans(k=k, seed=seed + i, featuresCol="features", predictionCol="customer_segment",
                      maxIter=max_iter).fit(feats)

    with ThreadPool(STARTS_AT_ONCE) as pool:
        models = pool.map(start, range(inits), chunksize=1)
    return min(models, key=lambda m: m.summary.trainingCost)


def customer_segments(users: DataFrame, k=KM_K, seed=SEED, inits: int = KM_INITS) -> DataFrame:
    """ML5: KMeans on 5 scaled numerics + one-hot acquisition channel (the
    channel is a category, so it is one-hot encoded, not used as a number)."""
    feats = _written_features(users)
    return _best_start(feats, k, inits, seed, 100).transform(feats).select("user_id", "customer_segment", *KM_NUM, KM_CAT)


def elbow(users: DataFrame, ks=range(2, 7), seed=SEED, inits: int = ELBOW_INITS) -> DataFrame:
    """ML5: training cost and silhouette per k (one small row per k)."""
    feats, rows = _written_features(users), []
    for k in ks:
        m = _best_start(feats, k, inits, seed, 50)
        sil = ClusteringEvaluator(featuresCol="features", predictionCol="customer_segment").evaluate(m.transform(feats))
        rows.append((int(k), float(m.summary.trainingCost), float(sil)))
    return users.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def segment_profile(segments: DataFrame) -> DataFrame:
    """ML7."""
    return segments.groupBy("customer_segment").agg(
        F.count("user_id").alias("customers"), F.avg("total_orders").alias("avg_orders"),
        F.avg("gross_lifetime_value").alias("avg_ltv"), F.avg("refund_rate_pct").alias("avg_refund"))


# ----------------------------------------------------------------- LTV (ML8)
LTV_FEATURE_DAYS = 90
# --- fixed values: prediction horizons ---------------------------------------
LTV_HORIZONS = (90, 180, 365)
# ------------------------------------------------------------------------------
LTV_EARLY_DAYS = 30  # what a prediction knows of a customer
LTV_ACTIONS = ((1.5, "retain"), (0.75, "upsell"))  # from this share of the mean
LTV_LAST_ACTION = "reactivate"


def ltv_dataset(orders: DataFrame, feature_days=LTV_FEATURE_DAYS, horizon=365) -> DataFrame:
    """ML8: per customer, features from the first ``feature_days`` after the
    first order, label = gross revenue in (feature_days, horizon], and the days from the
    first order to the last of the data (a label is cut short where these are fewer than
    the horizon). Orders are joined to a one-row-per-user first-order table (no pairs)."""
    first = orders.groupBy("user_id").agg(F.min("order_ts").alias("first_ts"),
                                          F.min_by("acquisition_channel", F.struct("order_ts", "order_id"))
                                          .alias("acquisition_channel"))
    o = orders.drop("acquisition_channel").join(first, "user_id").withColumn("_d", F.datediff(F.to_date("order_ts"), F.to_date("first_ts")))
    early = F.col("_d") <= feature_days
    later = (F.col("_d") > feature_days) & (F.col("_d") <= horizon)
    rev = F.col("gross_revenue").cast("decimal(18,4)")
    end = orders.agg(F.to_date(F.max("order_ts")).alias("_end"))
    return o.crossJoin(end).groupBy("user_id", "acquisition_channel").agg(
        F.max(F.datediff("_end", F.to_date("first_ts"))).alias("followup_days"),
        F.count_if(early).cast("double").alias("early_orders"),
        F.sum(F.when(early, rev)).cast("double").alias("early_revenue"),
        F.sum(F.when(early, F.col("items_purchased"))).cast("double").alias("early_items"),
        F.count_if(early & F.col("has_refund")).cast("double").alias("early_refunds"),
        F.coalesce(F.sum(F.when(later, rev)), F.lit(0)).cast("double").alias("future_revenue"))


def censoring_weights(data: DataFrame, horizon: int, strata=("acquisition_channel",), time: str = "followup_days") -> DataFrame:
    """ML8: what one customer of a stratum whose window is complete stands for.

    A customer is followed up until the data end; those followed less than ``horizon`` days
    are censored. G, the chance not to be censored before the horizon, is estimated by
    Kaplan-Meier with censoring as the event: the product over days of 1 - censored that day
    / still followed up. The weight is 1 / G: complete customers then count for the censored
    ones of their stratum. A row per stratum: n, n_complete, g, weight (null if none is
    complete)."""
    strata = list(strata)
    days = data.groupBy(*strata, F.least(F.col(time), F.lit(horizon)).alias("_t")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col(time) < horizon).alias("_c"))
    rest = Window.partitionBy(*strata).orderBy("_t").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = days.withColumn("_left", F.sum("_n").over(rest))  # at most horizon + 1 rows a stratum
    gone = F.when(F.col("_c") > 0, F.col("_c") / F.col("_left")).otherwise(F.lit(0.0))
    return left.groupBy(*strata).agg(
        F.sum("_n").alias("n"), F.sum(F.col("_n") - F.col("_c")).alias("n_complete"),
        F.when(F.max(gone) >= 1.0, F.lit(0.0)).otherwise(F.exp(F.sum(F.log(F.when(gone < 1.0, 1.0 - gone).otherwise(1.0))))).alias("g")
    ).withColumn("weight", F.try_divide(F.lit(1.0), F.when(F.col("n_complete") > 0, F.col("g"))))


def with_censoring_weights(data: DataFrame, horizon: int, strata=("acquisition_channel",)) -> DataFrame:
    """The customers whose window is complete, with their weight."""
    strata = list(strata)
    w = censoring_weights(data, horizon, strata).select(*[F.col(c).alias(f"_s_{c}") for c in strata], "weight")
    same = F.lit(True)
    for c in strata:
        same = same & data[c].eqNullSafe(w[f"_s_{c}"])
    return data.where(F.col("followup_days") >= horizon).join(w, same).drop(*[f"_s_{c}" for c in strata])


def ltv_models(data: DataFrame, seed=SEED, horizon: int = 365) -> DataFrame:
    """ML8: ridge, random-forest and GBT regressors; RMSE / R2 on a hash split. They learn
    and are judged on customers whose window is complete, weighted for those whose isn't."""
    spark = data.sparkSession
    num = ["early_orders", "early_revenue", "early_items", "early_refunds"]
    d = with_censoring_weights(data.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in num}), horizon)
    path = scratch_path(spark, "ltv")
    d.write.parquet(path)
    d = spark.read.parquet(path)
    train, test = split(d, key="user_id")
    idx = StringIndexer(inputCol="acquisition_channel", outputCol="ch_idx", handleInvalid="keep")
    ohe = OneHotEncoder(inputCols=["ch_idx"], outputCols=["ch_ohe"], handleInvalid="keep")
    vec = VectorAssembler(inputCols=num + ["ch_ohe"], outputCol="features")
    models = {
        "ridge": LinearRegression(labelCol="future_revenue", weightCol="weight", regParam=0.1, elasticNetParam=0.0),
        "random_forest": RandomForestRegressor(labelCol="future_revenue", weightCol="weight", numTrees=50, seed=seed),
        "gbt": GBTRegressor(labelCol="future_revenue", weightCol="weight", maxIter=50, seed=seed),
    }
    rows = []
    for name, est in models.items():
        pm = Pipeline(stages=[idx, ohe, vec, est]).fit(train)
        pred = pm.transform(test)
        ev = RegressionEvaluator(labelCol="future_revenue", predictionCol="prediction", weightCol="weight")
        rows.append((name, float(ev.setMetricName("rmse").evaluate(pred)),
                     float(ev.setMetricName("r2").evaluate(pred)), int(LTV_FEATURE_DAYS)))
    return spark.createDataFrame(rows, "model string, rmse double, r2 double, feature_days int")


def ltv_history(orders: DataFrame, early_days: int = LTV_EARLY_DAYS, horizons=LTV_HORIZONS,
                tasks: int | None = None) -> DataFrame:
    """ML8: one row per customer: what the first ``early_days`` show, gross revenue
    within each horizon of the first order, and whether the data's last order lies
    behind the horizon (else the label is cut short).

    Orders are dealt by user and day, and what is left of them, a row a user-day, by user;
    both to ``tasks`` tasks (None leaves it to AQE). Orders are read once (and for their last day), and no roll-up
    shares a task with the lines that orders are made of."""
    end = orders.agg(F.to_date(F.max("order_ts")).alias("_end"))
    # Per user and day first: a customer with very many orders is a row a day.
    rev = F.col("gross_revenue").cast("decimal(18,4)")
    n = [tasks] if tasks else []
    o = orders.where("user_id IS NOT NULL").select(
        "user_id", F.to_date("order_ts").alias("_day"), rev.alias("_rev"), "items_purchased", "has_refund",
        F.struct("order_ts", "order_id", "acquisition_channel").alias("_first"))
    days = o.repartition(*n, "user_id", "_day").groupBy("user_id", "_day").agg(
        F.count(F.lit(1)).alias("_orders"), F.sum("_rev").alias("_rev"), F.sum("items_purchased").alias("_items"),
        F.count_if("has_refund").alias("_refunds"), F.min("_first").alias("_first"))
    user = Window.partitionBy("user_id")  # at most a row a day of the calendar
    d = days.repartition(*n, "user_id").select(
        "*", F.min("_day").over(user).alias("first_day"),
        F.min("_first").over(user)["acquisition_channel"].alias("acquisition_channel"))
    d = d.withColumn("_d", F.datediff("_day", "first_day"))

    def within(col, n):
        return F.sum(F.when(F.col("_d") <= n, F.col(col)).otherwise(0)).cast("double")

    out = d.groupBy("user_id", "acquisition_channel", "first_day").agg(
        within("_orders", early_days).alias("early_orders"), within("_rev", early_days).alias("early_revenue"),
        within("_items", early_days).alias("early_items"), within("_refunds", early_days).alias("early_refunds"),
        *[within("_rev", h).alias(f"revenue_{h}d") for h in horizons])
    return out.crossJoin(end).withColumns(
        {f"is_complete_{h}d": F.datediff("_end", "first_day") >= h for h in horizons}).drop("_end", "first_day")


def ltv_predictions(history: DataFrame, horizons=LTV_HORIZONS, seed=SEED) -> DataFrame:
    """ML8: per customer the revenue within each horizon as boosted trees predict
    it, and a recommended action by the longest one. Each horizon is learned from
    the customers whose window is complete, and every customer is scored."""
    num = ["early_orders", "early_revenue", "early_items", "early_refunds"]
    prep = Pipeline(stages=[
        StringIndexer(inputCol="acquisition_channel", outputCol="ch_idx", handleInvalid="keep"),
        OneHotEncoder(inputCols=["ch_idx"], outputCols=["ch_ohe"], handleInvalid="keep"),
        VectorAssembler(inputCols=num + ["ch_ohe"], outputCol="features")]).fit(history)
    out = prep.transform(history)
    for h in horizons:
        known = out.filter(F.col(f"is_complete_{h}d"))
        model = GBTRegressor(labelCol=f"revenue_{h}d", predictionCol=f"predicted_ltv_{h}d", maxIter=20, seed=seed)
        out = model.fit(known).transform(out)
    longest = F.col(f"predicted_ltv_{max(horizons)}d")
    mean = out.agg(F.avg(longest).alias("_mean"))
    action = None
    for share, name in LTV_ACTIONS:
        hit = longest >= F.col("_mean") * share
        action = F.when(hit, name) if action is None else action.when(hit, name)
    return out.crossJoin(mean).select("user_id", "acquisition_channel",
                                      *[f"predicted_ltv_{h}d" for h in horizons],
                                      action.otherwise(LTV_LAST_ACTION).alias("recommended_action"))
