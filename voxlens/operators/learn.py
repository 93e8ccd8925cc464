"""Learning operators as Spark jobs: synthetic labels (M2), split (M3),
classifier fit/predict (M4), class balance (A11), classification metrics and
exact ROC AUC (A18, W6), prediction distribution (A10).

Randomness is keyed on the account id (``voxlens.functions.keyed_random``),
so labels and splits do not depend on partitioning or retries.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxlens.config import (
    ACCOUNT_FEATURE_COLS,
    DEFAULT_TEST_SIZE,
    LABEL_DAYS_SCALE,
    LABEL_DAYS_WEIGHT,
    LABEL_NOISE_SD,
    LABEL_SQUASH_CENTRE,
    LABEL_SQUASH_SLOPE,
    LABEL_THRESHOLD,
    LABEL_WEIGHTS,
    MIN_TRAINING_ACCOUNTS,
)
from voxlens.functions.keyed_random import normal, uniform
from voxlens.session import materialize


def synthetic_labels(features: DataFrame, noise_sd: float = LABEL_NOISE_SD, key: str = "account_id") -> DataFrame:
    """M2: heuristic churn score -> logistic squash -> + keyed N(0, sd) -> > 0.5."""
    terms = [F.col(c) * F.lit(w) for c, w in LABEL_WEIGHTS.items()]
    terms.append(F.col("days_since_last_feedback") / F.lit(LABEL_DAYS_SCALE) * F.lit(LABEL_DAYS_WEIGHT))
    score = reduce(lambda a, b: a + b, terms)
    prob = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-LABEL_SQUASH_SLOPE) * (F.col("churn_score") - F.lit(LABEL_SQUASH_CENTRE))))
    eps = normal(F.col(key), "label", noise_sd) if noise_sd else F.lit(0.0)
    return (features.withColumn("churn_score", score)
            .withColumn("churn_prob", prob)
            .withColumn("noise", eps)
            .withColumn("churned", ((F.col("churn_prob") + F.col("noise")) > F.lit(LABEL_THRESHOLD)).cast("int")))


def class_balance(labels: DataFrame, label: str = "churned", test_size: float = DEFAULT_TEST_SIZE) -> DataFrame:
    """Class counts, minority size and the test share in use (a caller that
    sees a small minority passes another one; nothing switches by itself)."""
    agg = labels.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(label), F.lit(0)).cast("long").alias("positives"))
    return agg.select(
        "n", "positives", (F.col("n") - F.col("positives")).alias("negatives"),
        F.least("positives", F.col("n") - F.col("positives")).alias("minority"),
        F.lit(float(test_size)).alias("test_size"))


def stratified_split(labels: DataFrame, test_size: float = DEFAULT_TEST_SIZE, key: str = "account_id",
                     label: str = "churned", salt: str = "split") -> DataFrame:
    """M3: per-row keyed-hash threshold, ``u(key) < test_size`` -> test.

    Each class is sampled at the same rate, so the split is stratified in
    expectation with no shuffle. Rows with a NULL key draw like one more key,
    so every row is in one of the two parts.
    """
    return labels.withColumn("is_test", uniform(F.col(key), salt) < F.lit(float(test_size)))


SPLIT_BUCKETS = 4096


def stratified_split_exact(labels: DataFrame, test_size: float = DEFAULT_TEST_SIZE, key: str = "account_id",
                           label: str = "churned", salt: str = "split", buckets: int = SPLIT_BUCKETS) -> DataFrame:
    """M3, exact per-class counts: in each class the ``round(test_size * n_c)``
    rows with the smallest key hash ``u`` (ties by key) form the test set.

    No per-class window over the data (a class can be half of all rows):
    ``u`` is histogrammed into ``buckets`` ranges per class (a partial
    aggregate, <= 2 x buckets rows), a running count over that small
    histogram finds the boundary bucket of each class, rows below it are
    test and above it train, and only the rows of the boundary bucket
    (about n_c / buckets of them) are ranked.
    """
    u = uniform(F.col(key), salt)
    data = labels.withColumn("_u", u).withColumn("_b", F.floor(F.col("_u") * buckets).cast("int"))
    hist = data.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(label).orderBy("_b")  # <= `buckets` rows per class
    cum = hist.select(label, "_b", "_n", F.sum("_n").over(w).alias("_upto"),
                      F.sum("_n").over(Window.partitionBy(label)).alias("_nc"))
    target = cum.select(
        label, "_b", "_n", (F.col("_upto") - F.col("_n")).alias("_before"),
        F.floor(F.lit(float(test_size)) * F.col("_nc") + F.lit(0.5)).cast("long").alias("_t"))
    # Boundary bucket: where the running count first reaches the class target.
    boundary = (target.where((F.col("_before") < F.col("_t")) & (F.col("_before") + F.col("_n") >= F.col("_t")))
                .select(label, F.col("_b").alias("_edge_b"), (F.col("_t") - F.col("_before")).alias("_take")))
    tagged = data.join(F.broadcast(boundary), label, "left")  # <= 2 rows
    in_edge = F.col("_b") == F.col("_edge_b")
    rank = F.row_number().over(Window.partitionBy(label, "_b").orderBy("_u", key))
    below = F.col("_edge_b").isNotNull() & (F.col("_b") < F.col("_edge_b"))
    edge_rows = tagged.where(in_edge).withColumn("is_test", rank <= F.col("_take"))
    rest = tagged.where(~in_edge | F.col("_edge_b").isNull()).withColumn("is_test", F.coalesce(below, F.lit(False)))
    return edge_rows.unionByName(rest).drop("_u", "_b", "_edge_b", "_take")


def prediction_distribution(preds: DataFrame, prob: str = "churn_probability") -> DataFrame:
    """A10: mean and *population* std of predictions, as metric rows."""
    a = preds.agg(F.avg(prob).alias("m"), F.stddev_pop(prob).alias("s"), F.count(F.lit(1)).alias("n"))
    return a.select(F.explode(F.array(
        F.struct(F.lit("prediction_mean").alias("metric_name"), F.col("m").alias("metric_value"),
                 F.col("n").alias("samples_count")),
        F.struct(F.lit("prediction_std").alias("metric_name"), F.col("s").alias("metric_value"),
                 F.col("n").alias("samples_count")))).alias("r")).select("r.*")


def score_counts(preds: DataFrame, label: str = "churned", score: str = "churn_probability") -> DataFrame:
    """(s, pos, neg) per distinct score: all that the metrics below need, written once."""
    return materialize(preds.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")), "scores")


def roc_auc(preds: DataFrame, label: str = "churned", score: str = "churn_probability",
            buckets: int | None = None, by_score: DataFrame | None = None) -> DataFrame:
    """Exact ROC AUC with ties counted one half (Mann-Whitney form).

    A distributed prefix sum without a global window: the distinct scores are
    cut into contiguous ranges at approximate quantiles (a bounded sketch;
    ``buckets - 1`` edges, by default as many buckets as shuffle partitions, are
    fetched once so every consumer sees the same cut). A bucket-level prefix
    (``buckets`` rows) is joined back and the running sum inside a bucket is a
    window partitioned by bucket. The edges only balance the work; the result
    is exact for any edges.
    """
    by_score = score_counts(preds, label, score) if by_score is None else by_score
    buckets = buckets or max(2, int(by_score.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    probs = [i / buckets for i in range(1, buckets)]
    row = by_score.agg(F.percentile_approx("s", probs, 10000).alias("e")).first()
    edges = sorted({float(e) for e in (row["e"] or []) if e is not None})
    edge_arr = F.array(*[F.lit(e) for e in edges]) if edges else F.array().cast("array<double>")
    bucketed = by_score.select("s", "pos", "neg", F.size(F.filter(edge_arr, lambda e: e < F.col("s"))).alias("b"))
    per_b = bucketed.groupBy("b").agg(F.sum("neg").alias("bneg"))
    w_b = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)  # <= `buckets` rows
    prefix = per_b.select("b", F.coalesce(F.sum("bneg").over(w_b), F.lit(0)).alias("neg_before_bucket"))
    w_in = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    cum = bucketed.join(F.broadcast(prefix), "b").select(  # <= `buckets` rows
        "pos", "neg",
        (F.col("neg_before_bucket") + F.coalesce(F.sum("neg").over(w_in), F.lit(0))).alias("neg_below"))
    return cum.agg(
        F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") * F.lit(0.5))).alias("u"),
        F.sum("pos").alias("p"), F.sum("neg").alias("q"),
    ).select(F.when((F.col("p") > 0) & (F.col("q") > 0), F.col("u") / (F.col("p") * F.col("q"))).alias("auc"))


def classification_metrics(preds: DataFrame, label: str = "churned", score: str = "churn_probability",
                           threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall, F1 (zero division = 0) and AUC, one row.

    ``preds`` is read once: confusion counts and AUC come from the counts per
    distinct score."""
    by_score = score_counts(preds, label, score)
    above = F.col("s") >= F.lit(threshold)
    zero = F.lit(0).cast("long")

    def total(column, when) -> F.Column:
        return F.coalesce(F.sum(F.when(when, F.col(column))), zero)

    c = by_score.agg(total("pos", above).alias("tp"), total("neg", above).alias("fp"),
                     total("pos", ~above).alias("fn"), total("neg", ~above).alias("tn")) \
        .withColumn("n", F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))
    tp, fp, fn, tn, n = (F.col(x) for x in ("tp", "fp", "fn", "tn", "n"))
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    f1 = F.when(2 * tp + fp + fn > 0, (2 * tp) / (2 * tp + fp + fn)).otherwise(F.lit(0.0))
    out = c.select("n", "tp", "fp", "fn", "tn",
                   F.when(n > 0, (tp + tn) / n).alias("accuracy"),
                   precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))
    return out.crossJoin(F.broadcast(roc_auc(preds, label, score, by_score=by_score)))  # one-row side


def fit_churn_classifier(train: DataFrame, feature_cols=ACCOUNT_FEATURE_COLS, label: str = "churned",
                         kind: str = "logistic", seed: int = 42):
    """M4: fit a binary classifier with ``pyspark.ml`` (distributed L-BFGS).

    ``kind="mlp"`` uses a 20-64-32-16-2 perceptron, the closest built-in
    counterpart of the reference's dense network. Inputs are expected
    standardised (M1). Returns a fitted ``PipelineModel``.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
    from pyspark.ml.feature import VectorAssembler

    cols = [c for c in feature_cols if c in train.columns]
    assembler = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")
    if kind == "mlp":
        clf = MultilayerPerceptronClassifier(layers=[len(cols), 64, 32, 16, 2], seed=seed, maxIter=50,
                                             labelCol=label, featuresCol="features")
    else:
        clf = LogisticRegression(labelCol=label, featuresCol="features", maxIter=100, regParam=REG_PARAM)
    return Pipeline(stages=[assembler, clf]).fit(train.withColumn(label, F.col(label).cast("double")))


REG_PARAM = 0.01


def optimality(model, train: DataFrame, label: str = "churned", reg: float = REG_PARAM) -> DataFrame:
    """M4: the largest absolute component of the objective's gradient at a fitted logistic
    solution (0 at the optimum), one row. The objective is the mean log loss plus
    reg / 2 * |b * s|**2 with each feature's sample deviation s, as the fit minimises it."""
    from pyspark.ml.functions import vector_to_array

    weights = model.stages[-1].coefficients.toArray().tolist()
    rows = model.transform(train).select(
        (vector_to_array("probability")[1] - F.col(label)).alias("e"), vector_to_array("features").alias("x"))
    parts = [F.avg("e").alias("g")] + [F.avg(F.col("e") * F.col("x")[j]).alias(f"g{j}") for j in range(len(weights))] \
        + [F.var_samp(F.col("x")[j]).alias(f"s{j}") for j in range(len(weights))]
    sums = rows.agg(F.count("*").alias("n"), *parts)
    size = [F.abs("g")] + [F.abs(F.col(f"g{j}") + reg * w * F.coalesce(f"s{j}", F.lit(0.0))) for j, w in enumerate(weights)]
    return sums.select("n", F.greatest(*size).alias("max_abs_gradient"))


def predict_churn(model, scaled: DataFrame, keep=("account_id",)) -> DataFrame:
    """M5 with a fitted model: probability of the positive class."""
    from pyspark.ml.functions import vector_to_array

    out = model.transform(scaled)
    return out.select(*[c for c in keep if c in scaled.columns],
                      vector_to_array("probability")[1].alias("churn_probability"))


def training_run_record(split: DataFrame, label: str = "churned", min_accounts: int = MIN_TRAINING_ACCOUNTS) -> DataFrame:
    """L4 + M6: the run record of a training job, one row: class balance,
    split sizes and the status the minimum-sample guard implies (fewer than
    ``min_accounts`` accounts, or none, fails the run with zero samples)."""
    a = split.agg(
        F.count(F.lit(1)).alias("n_accounts"),
        F.coalesce(F.sum(label), F.lit(0)).cast("long").alias("positives"),
        F.count_if(F.col("is_test")).alias("test_n"))
    n = F.col("n_accounts")
    failed = n < F.lit(min_accounts)
    error = (F.when(n == 0, F.lit("No data available for training. Ensure feedback_enriched table has data."))
             .when(failed, F.concat(F.lit("Insufficient data for training: "), n.cast("string"),
                                    F.lit(f" accounts (minimum {min_accounts} required)"))))
    return a.select(
        "n_accounts", "positives", (n - F.col("positives")).alias("negatives"),
        F.when(failed, F.lit("failed")).otherwise(F.lit("completed")).alias("status"),
        F.when(failed, F.lit(0).cast("long")).otherwise(n - F.col("test_n")).alias("training_samples"),
        F.when(failed, F.lit(0).cast("long")).otherwise(F.col("test_n")).alias("test_samples"),
        error.alias("error_message"))


TRAINING_METRICS = ("accuracy", "precision", "recall", "f1", "auc", "prediction_mean", "prediction_std")


def training_log_rows(split: DataFrame, next_versions: DataFrame, model_type: str = "churn") -> DataFrame:
    """What a training run logs, without the fitted figures: its version, status and
    sample counts, once per metric that it logs (none where the run fails)."""
    version = next_versions.where(F.col("model_type") == model_type).select("next_version")
    row = training_run_record(split).join(F.broadcast(version.agg(  # one row each
        F.coalesce(F.max("next_version"), F.lit("v1")).alias("version"))), how="cross")
    names = F.when(F.col("status") == "completed", F.array(*[F.lit(m) for m in TRAINING_METRICS])).otherwise(
        F.array().cast("array<string>"))
    return row.select(F.lit(model_type).alias("model_type"), "version", "status", "training_samples", "test_samples",
                      F.explode_outer(names).alias("metric_name"))


def save_model(model, path: str) -> str:
    """Persist a fitted pipeline (overwrites only its own directory)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """Load a pipeline saved by ``save_model``."""
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
