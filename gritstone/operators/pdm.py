"""Predictive maintenance on vibration features: train, evaluate, calibrate, score."""

from __future__ import annotations

import json
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gritstone.functions.expressions import iso_zone, recommended_action, stable_id, stable_share
from gritstone.functions.quantiles import interpolated_quantiles, medians
from gritstone.functions.slices import SLICE, running_total
from gritstone.operators.vibration import days_to_fail
from gritstone.session import materialize
from gritstone.sources.sinks import child_names

# Features a live window can provide, and those no row may lack.
FEATURES = [
    "rms_mm_s", "peak_mm_s", "crest_factor", "kurtosis", "stddev_mm_s", "rms_pct_of_baseline",
    "bearing_temp_c", "motor_current_a", "throughput_tph",
]
CORE_FEATURES = ["rms_mm_s", "peak_mm_s", "crest_factor", "kurtosis"]
LABEL = "label_failure_30d"
RUL_BINS = 10
BASELINE_STEPS = 60
BASELINE_LOW, BASELINE_HIGH = 0.50, 0.995
#: Labelled rows that trees are fitted on at most; folds of whole assets in the evaluation.
FIT_ROWS = 50_000
FOLDS = 3


@dataclass(frozen=True)
class BoostingSettings:
    rounds: int = 250
    learning_rate: float = 0.08
    depth: int = 6
    seed: int = 27
    fit_rows: int = FIT_ROWS


@dataclass(frozen=True)
class PdmModel:
    """A fitted classifier with the medians that stand in for absent context features."""

    trees: GBTClassificationModel
    fill: dict[str, float]

    def save(self, path: str) -> None:
        self.trees.write().overwrite().save(f"{path}/trees")
        spark = SparkSession.active()
        spark.createDataFrame([(json.dumps(self.fill),)], "fill STRING").write.mode(
            "overwrite"
        ).text(f"{path}/fill")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "PdmModel":
        fill = json.loads(spark.read.text(f"{path}/fill").first()["value"])
        return PdmModel(GBTClassificationModel.load(f"{path}/trees"), fill)

    def probabilities(self, features: DataFrame) -> DataFrame:
        """Add ``failure_prob_30d``; rows stay where they are."""
        scored = self.trees.transform(_assembled(features, self.fill))
        return scored.withColumn(
            "failure_prob_30d", vector_to_array("probability")[1]
        ).drop("_features", "rawPrediction", "probability", "prediction")


def _assembled(features: DataFrame, fill: dict[str, float]) -> DataFrame:
    filled = [f"_in_{c}" for c in FEATURES]
    rows = features.withColumns({
        f"_in_{c}": F.coalesce(F.col(c).cast("double"), F.lit(fill[c])) for c in FEATURES
    })
    return VectorAssembler(inputCols=filled, outputCol="_features").transform(rows).drop(*filled)


def fit_sample(labelled: DataFrame, limit: int = FIT_ROWS) -> DataFrame:
    """About ``limit`` rows of the table at most, drawn by a hash of sensor and window, so reruns draw the same ones."""
    total = labelled.count()
    if total <= limit:
        return labelled
    drawn = stable_share(1_000_000, "tag_id", "window_start")
    return labelled.where(drawn < int(1_000_000 * limit / total))


def train(features: DataFrame, settings: BoostingSettings = BoostingSettings()) -> PdmModel:
    """Boosted trees with the positive class weighted by the class ratio, on a sample of at most about ``fit_rows`` labelled rows.

    Counts and medians are those of all labelled rows. Only two counts and nine medians reach the driver. The features are read
    several times: pass a stored or materialized table, not a long plan.
    """
    labelled = features.where(F.col(LABEL).isNotNull())
    counts = labelled.agg(
        F.count_if(F.col(LABEL)).alias("pos"), F.count_if(~F.col(LABEL)).alias("neg")
    ).first()
    weight = counts["neg"] / max(counts["pos"], 1)
    middle = medians(labelled, FEATURES).first().asDict()
    fill = {c: float(middle[c]) if middle[c] is not None else 0.0 for c in FEATURES}
    rows = materialize(fit_sample(labelled, settings.fit_rows).select("tag_id", "window_start", *FEATURES, LABEL))
    rows = _assembled(rows, fill).select(
        "_features", F.col(LABEL).cast("double").alias("_label"),
        F.when(F.col(LABEL), F.lit(float(weight))).otherwise(F.lit(1.0)).alias("_weight"),
    )
    learner = GBTClassifier(
        featuresCol="_features", labelCol="_label", weightCol="_weight", maxIter=settings.rounds,
        stepSize=settings.learning_rate, maxDepth=settings.depth, seed=settings.seed,
    )
    return PdmModel(learner.fit(rows), fill)


def threshold_scores(features: DataFrame, steps: int = BASELINE_STEPS) -> DataFrame:
    """F1 of the rule ``rms >= threshold`` for quantiles of RMS as thresholds.

    The thresholds are found once; as there are ``steps`` of them whatever the data, they go on as an array of constants.
    Each row falls between two of them, so one scan groups the rows into ``steps + 1`` counts, which are then
    summed from the top. Nothing is flagged, and F1 is 0, where there are no rows.
    """
    span = BASELINE_HIGH - BASELINE_LOW
    probabilities = [BASELINE_LOW + span * i / (steps - 1) for i in range(steps)]
    found = {r["position"]: r["quantile"] for r in interpolated_quantiles(features, "rms_mm_s", probabilities).collect()}
    ladder = [found.get(k) for k in range(steps)]
    reached = F.size(F.filter(F.array(*[F.lit(t).cast("double") for t in ladder]), lambda t: t <= F.col("rms_mm_s")))
    counted = (
        features.where(F.col("rms_mm_s").isNotNull())
        .select((reached - 1).alias("position"), F.col(LABEL).alias("_label"))
        .groupBy("position")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if("_label").alias("positives"))
    )
    every = features.sparkSession.createDataFrame(
        [(k, t) for k, t in enumerate([None, *ladder], -1)], "position int, threshold double")
    downwards = Window.partitionBy(F.lit(0)).orderBy(F.desc("position")).rowsBetween(Window.unboundedPreceding, 0)
    totals = every.join(counted, "position", "left").select(
        "position", "threshold",
        F.coalesce(F.sum("rows").over(downwards), F.lit(0)).alias("flagged"),
        F.coalesce(F.sum("positives").over(downwards), F.lit(0)).alias("tp"),
        F.coalesce(F.sum("positives").over(Window.partitionBy(F.lit(0))), F.lit(0)).alias("actual"),
    )
    return totals.where(F.col("position") >= 0).select(
        "position", "threshold", "flagged", "tp",
        F.coalesce(F.try_divide(2.0 * F.col("tp"), F.col("flagged") + F.col("actual")), F.lit(0.0)).alias("f1"),
    )


def rms_threshold_baseline(features: DataFrame, steps: int = BASELINE_STEPS) -> DataFrame:
    """The threshold with the best F1; the lowest one on ties."""
    best = F.struct("f1", -F.col("position"))
    return threshold_scores(features, steps).agg(
        F.max_by("threshold", best).alias("rms_threshold_mm_s"), F.max("f1").alias("best_f1")
    )


def asset_folds(features: DataFrame, folds: int = FOLDS) -> DataFrame:
    """``fold`` of every asset. Assets that failed are dealt first, so each fold gets its share of them.

    The order is that of a hash of the asset; the window runs over one row per asset.
    """
    assets = features.groupBy("asset_id").agg(F.coalesce(F.max(LABEL), F.lit(False)).alias("_failed"))
    dealt = Window.partitionBy(F.lit(0)).orderBy(F.desc("_failed"), stable_id("asset_id"))
    return assets.select("asset_id", ((F.row_number().over(dealt) - 1) % folds).alias("fold"))


def cross_fit(
    features: DataFrame, path: str, settings: BoostingSettings = BoostingSettings(), folds: int = FOLDS,
) -> DataFrame:
    """Held-out predictions of every asset by a model and an RMS rule that were fitted without its fold.

    The number of models is the fixed number of folds, however many assets there are; whole assets are held out because
    neighbouring windows of a bearing are nearly the same row. With as many folds as failing assets each is left out alone. The
    folds are fitted side by side and written under ``path`` one by one; a fold that is there is not fitted again,
    so a lost run goes on where it stopped. Assets that never failed are used for fitting only.
    """
    spark = features.sparkSession
    dated = materialize(days_to_fail(features).join(asset_folds(features, folds), "asset_id"))
    failing = materialize(dated.where(LABEL).select("asset_id", "fold").distinct())
    wanted = [row["fold"] for row in failing.select("fold").distinct().orderBy("fold").collect()]
    if not wanted:
        raise ValueError("no asset has a labelled failure")

    def fit_fold(fold: int) -> None:
        target = f"{path}/fold={fold}"
        if "part" in "".join(child_names(spark, target)):
            return
        others = dated.where(F.col("fold") != fold)
        model = train(others, settings)
        threshold = rms_threshold_baseline(others).first()["rms_threshold_mm_s"]
        held = dated.where(F.col("fold") == fold).join(failing.select("asset_id"), "asset_id", "left_semi")
        model.probabilities(held).select(
            "asset_id", "tag_id", "window_start", F.col(LABEL).alias("label"), "days_to_fail",
            "failure_prob_30d", (F.col("failure_prob_30d") >= 0.5).alias("model_flag"),
            (F.col("rms_mm_s") >= F.lit(threshold)).alias("rms_flag"),
            F.lit(threshold).cast("double").alias("rms_threshold_mm_s"),
        ).write.mode("overwrite").parquet(target)

    with ThreadPool(len(wanted)) as pool:
        pool.map(inheritable_thread_target(spark)(fit_fold), wanted)
    return spark.read.parquet(path).drop("fold")


def _f1(flag: str) -> tuple[Column, Column, Column]:
    tp = F.count_if(F.col(flag) & F.col("label")).cast("double")
    precision = F.coalesce(F.try_divide(tp, F.count_if(flag)), F.lit(0.0))
    recall = F.coalesce(F.try_divide(tp, F.count_if("label")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2.0 * tp, F.count_if(flag) + F.count_if("label")), F.lit(0.0))
    return precision, recall, f1


def average_precision(scored: DataFrame, slices: int = 1000) -> DataFrame:
    """Area under the precision-recall steps per asset.

    Equal scores form one step. Running counts are stitched over slices of the
    score, so no asset is ranked in one task.
    """
    steps = (
        scored.groupBy("asset_id", F.col("failure_prob_30d").alias("p"))
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if("label").alias("hits"))
        .withColumn("_down", -F.col("p"))
        .withColumn(SLICE, F.floor(F.col("_down") * slices))
    )
    ordered = running_total(steps, ["asset_id"], ["_down"], "rows", "rows_so_far")
    ordered = running_total(ordered, ["asset_id"], ["_down"], "hits", "hits_so_far")
    gained = F.col("hits") * F.col("hits_so_far") / F.col("rows_so_far")
    return ordered.groupBy("asset_id").agg(
        F.try_divide(F.sum(gained), F.sum("hits")).alias("model_pr_auc")
    )


def evaluation(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and PR-AUC of the model against the RMS rule, per held-out asset."""
    precision, recall, f1 = _f1("model_flag")
    metrics = scored.groupBy("asset_id").agg(
        F.count(F.lit(1)).alias("test_rows"), F.round(precision, 3).alias("model_precision"),
        F.round(recall, 3).alias("model_recall"), F.round(f1, 3).alias("model_f1"),
        F.round(F.max("rms_threshold_mm_s"), 2).alias("rms_threshold_mm_s"),
        F.round(_f1("rms_flag")[2], 3).alias("rms_f1"),
    )
    area = average_precision(scored).withColumn("model_pr_auc", F.round("model_pr_auc", 3))
    return metrics.join(area, "asset_id").withColumnRenamed("asset_id", "held_out_asset")


def phase1_recall(scored: DataFrame, low: float = 13.0, high: float = 30.0) -> DataFrame:
    """Recall early in the approach to failure, where RMS has barely moved."""
    early = scored.where(F.col("days_to_fail").between(low, high))
    return early.groupBy(F.col("asset_id").alias("held_out_asset")).agg(
        F.count(F.lit(1)).alias("phase1_rows"),
        F.round(_f1("model_flag")[1], 3).alias("model_recall_phase1"),
        F.round(_f1("rms_flag")[1], 3).alias("rms_recall_phase1"),
    )


def probability_bin(probability: str = "failure_prob_30d") -> Column:
    """Ten left-closed bins; 1.0 belongs to the last."""
    return F.least(F.floor(F.col(probability) * RUL_BINS), F.lit(RUL_BINS - 1)).cast("int")


def rul_calibration(scored: DataFrame) -> DataFrame:
    """Median days to failure per probability bin; empty bins are interpolated.

    Takes rows with ``failure_prob_30d`` and ``days_to_fail``. Ends take the
    nearest known bin. The interpolation runs over ten rows.
    """
    known = interpolated_quantiles(
        scored.where(F.col("days_to_fail").isNotNull()).withColumn("bin", probability_bin()),
        "days_to_fail", [0.5], ["bin"],
    ).select("bin", F.col("quantile").alias("median_days"))
    bins = scored.sparkSession.range(RUL_BINS).select(F.col("id").cast("int").alias("bin"))
    order = Window.partitionBy(F.lit(0)).orderBy("bin")
    point = F.when(F.col("median_days").isNotNull(), F.struct("bin", "median_days"))
    sides = bins.join(known, "bin", "left").select(
        "bin", "median_days",
        F.last(point, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("a"),
        F.first(point, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing)).alias("b"),
    )
    share = F.try_divide(F.col("bin") - F.col("a.bin"), F.col("b.bin") - F.col("a.bin"))
    between = F.col("a.median_days") + (F.col("b.median_days") - F.col("a.median_days")) * share
    return sides.select(
        "bin", F.coalesce("median_days", between, "a.median_days", "b.median_days").alias("rul_days")
    )


def recent_window(features: DataFrame, days: int = 30) -> DataFrame:
    """Rows newer than the newest window minus ``days``."""
    newest = features.agg(F.max("window_start").alias("t")).scalar()
    return features.where(F.col("window_start") >= newest - F.expr(f"INTERVAL {int(days)} DAYS"))


def scorable(features: DataFrame) -> DataFrame:
    """Rows with every core feature; a missing sensor is not guessed."""
    return features.dropna(subset=CORE_FEATURES)


def fill_context(features: DataFrame) -> DataFrame:
    """Absent context features take the median of the rows being scored."""
    middle = features.transform(lambda d: medians(d, FEATURES)).select(
        F.struct(*FEATURES).alias("m")
    ).scalar()
    return features.withColumn("_middle", middle).withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.col(f"_middle.{c}")) for c in FEATURES
    }).drop("_middle")


def top_features(features: DataFrame, count: int = 3) -> DataFrame:
    """Add ``top_features``: the features furthest from the fleet median, as JSON."""
    middle = medians(features, FEATURES).select(F.struct(*FEATURES).alias("m")).scalar()
    rows = features.withColumn("_middle", middle)

    def deviation(i: int, name: str) -> Column:
        m = F.col(f"_middle.{name}")
        d = (F.col(name) - m) / (F.abs(m) + F.lit(1e-9))
        return F.when(
            d.isNotNull(),
            F.struct(
                (-F.abs(d)).alias("rank"), F.lit(i).alias("i"), F.lit(name).alias("feature"),
                F.round(d, 3).alias("d"),
            ),
        )

    ordered = F.sort_array(F.array_compact(F.array(*[deviation(i, c) for i, c in enumerate(FEATURES)])))
    named = F.transform(
        F.slice(ordered, 1, count),
        lambda x: F.struct(
            x["feature"].alias("feature"), x["d"].alias("deviation_from_fleet_median")
        ),
    )
    return rows.withColumn("top_features", F.to_json(named)).drop("_middle")


def predictions(
    scored: DataFrame, calibration: DataFrame, model_name: str, model_version: str,
    scored_at: str | None = None,
) -> DataFrame:
    """Prediction rows from scored features and the ten-row calibration."""
    at = F.lit(scored_at).cast("timestamp") if scored_at else F.current_timestamp()
    rul = calibration.select(F.col("bin").alias("_bin"), "rul_days")
    return (
        top_features(scored)
        .withColumn("_bin", probability_bin())
        .join(rul, "_bin", "left")
        .select(
            stable_id(F.lit(model_name), F.lit(model_version), "tag_id", "window_end").alias("prediction_id"),
            "asset_id", "tag_id", at.alias("scored_at"),
            F.col("window_end").alias("feature_window_end"), F.lit(model_name).alias("model_name"),
            F.lit(model_version).alias("model_version"),
            F.round(100.0 * (1.0 - F.col("failure_prob_30d")), 1).alias("health_index"),
            "failure_prob_30d", (F.col("rul_days") * 24.0).alias("predicted_rul_hours"),
            iso_zone("rms_mm_s").alias("iso_10816_zone"), "top_features",
            recommended_action("failure_prob_30d").alias("recommended_action"),
            F.lit("batch").alias("scoring_mode"),
        )
    )


def peak_risk(predicted: DataFrame) -> DataFrame:
    """The highest-probability row of each sensor."""
    row = F.struct("failure_prob_30d", "health_index", "iso_10816_zone", "recommended_action")
    best = predicted.groupBy("tag_id").agg(
        F.max_by(row, F.struct("failure_prob_30d", "feature_window_end")).alias("_r")
    )
    return best.select("tag_id", "_r.*").orderBy(F.desc("failure_prob_30d"), "tag_id")


def flagged_sensors(peaks: DataFrame, threshold: float = 0.7) -> DataFrame:
    return peaks.agg(
        F.count_if(F.col("failure_prob_30d") >= threshold).alias("flagged"),
        F.count(F.lit(1)).alias("sensors"),
    )
