"""Quality of scores against labels.

Inputs have ``label`` (0 or 1) and ``score``. Curves and areas first count rows per distinct score,
then run totals inside slices of the score range, so neither a popular score nor the whole table
ever meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from firnline import fixed_values as fv
from firnline.functions import measure
from firnline.functions.measure import ratio
from firnline.operators.ranking import hash_order, running_totals
from firnline.session import stage


def _predicted(threshold: Column | float) -> Column:
    return F.col("score") >= threshold


def confusion(scores: DataFrame, threshold: float) -> DataFrame:
    """One row: true and false negatives and positives at a threshold."""
    danger, event = _predicted(F.lit(threshold)), F.col("label") == 1
    return scores.agg(
        F.count_if(~danger & ~event).alias("tn"),
        F.count_if(danger & ~event).alias("fp"),
        F.count_if(~danger & event).alias("fn"),
        F.count_if(danger & event).alias("tp"),
    )


def report(scores: DataFrame, threshold: float) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, and both averages.

    Empty denominators give zero.
    """
    cells = confusion(scores, threshold)
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")

    def line(name: str, hit: str, wrong: str, missed: str) -> Column:
        precision = ratio(F.col(hit), F.col(hit) + F.col(wrong))
        recall = ratio(F.col(hit), F.col(hit) + F.col(missed))
        return _report_line(
            name, precision, recall,
            ratio(2.0 * F.col(hit), 2.0 * F.col(hit) + F.col(wrong) + F.col(missed)),
            F.col(hit) + F.col(missed),
        )

    classes = cells.select(
        "*",
        total.alias("total"),
        line("No Avalanche", "tn", "fn", "fp").alias("safe"),
        line("Avalanche", "tp", "fp", "fn").alias("danger"),
    )

    def average(name: str, weight: Column | None) -> Column:
        def mean(metric: str) -> Column:
            s, d = F.col(f"safe.{metric}"), F.col(f"danger.{metric}")
            if weight is None:
                return (s + d) / 2.0
            return ratio(
                s * F.col("safe.support") + d * F.col("danger.support"), F.col("total")
            )
        return _report_line(name, mean("precision"), mean("recall"), mean("f1"), F.col("total"))

    accuracy = ratio(F.col("tn") + F.col("tp"), F.col("total"))
    blank = F.lit(None).cast("double")
    return classes.select(
        F.inline(
            F.array(
                F.col("safe"),
                F.col("danger"),
                _report_line("accuracy", blank, blank, accuracy, F.col("total")),
                average("macro avg", None),
                average("weighted avg", F.col("total")),
            )
        )
    )


def _report_line(name: str, precision: Column, recall: Column, f1: Column, support: Column):
    return F.struct(
        F.lit(name).alias("class"), precision.alias("precision"), recall.alias("recall"),
        f1.alias("f1"), support.cast("long").alias("support"),
    )


def safety(scores: DataFrame, threshold: float) -> DataFrame:
    """Miss rate, false alarm rate and the rating of the miss rate."""
    cells = confusion(scores, threshold)
    miss = ratio(F.col("fn"), F.col("fn") + F.col("tp"))
    return cells.select(
        miss.alias("miss_rate"),
        ratio(F.col("fp"), F.col("tn") + F.col("fp")).alias("false_alarm_rate"),
        measure.miss_rate_rating(miss, fv.FINAL_RATINGS).alias("rating"),
    )


def per_score(scores: DataFrame) -> DataFrame:
    """Positives and negatives per distinct score, with the slice the score falls in; stored.

    Slices are the partitions of a range sort, which Spark cuts by sampling: about as many distinct scores in each,
    wherever the scores lie.
    """
    counted = (
        scores.filter(F.col("score").isNotNull())
        .groupBy("score")
        .agg(
            F.count_if(F.col("label") == 1).alias("pos"),
            F.count_if(F.col("label") == 0).alias("neg"),
        )
    )
    return stage(
        counted.repartitionByRange("score").withColumn("slice", F.spark_partition_id()), "per-score"
    )


def _cumulative(scores: DataFrame) -> DataFrame:
    """Positives and negatives scored at or above each distinct score, and in total."""
    counted = per_score(scores)
    reached = running_totals(counted, "slice", ["score"], ["pos", "neg"], descending=True)
    totals = counted.agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("p"), F.coalesce(F.sum("neg"), F.lit(0)).alias("n")
    )
    return reached.withColumns(
        {"p": totals.select("p").scalar(), "n": totals.select("n").scalar()}
    )


def roc_curve(scores: DataFrame) -> DataFrame:
    """False and true positive rate at every distinct score; points in line are kept."""
    return _cumulative(scores).select(
        F.col("score").alias("threshold"),
        ratio(F.col("neg_running"), F.col("n")).alias("fpr"),
        ratio(F.col("pos_running"), F.col("p")).alias("tpr"),
    )


def precision_recall_curve(scores: DataFrame) -> DataFrame:
    """Precision and recall at every distinct score, and the end point (1, 0)."""
    points = _cumulative(scores).select(
        F.col("score").alias("threshold"),
        ratio(F.col("pos_running"), F.col("pos_running") + F.col("neg_running")).alias(
            "precision"
        ),
        ratio(F.col("pos_running"), F.col("p")).alias("recall"),
    )
    end = scores.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
    )
    return points.unionByName(end)


def roc_auc(scores: DataFrame) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties counting half.

    Each distinct score adds its positives times the negatives below it plus half of its own.
    """
    below = F.col("n") - F.col("neg_running")
    won = F.sum(F.col("pos") * (below + F.col("neg") / 2.0))
    return _cumulative(scores).agg(
        (won / (F.max("p") * F.max("n").cast("double"))).alias("auc")
    )


def _reached(ordered: Sequence[float]) -> Column:
    """How many of the rising thresholds a row's score reaches.

    Of evenly spaced ones the place is worked out and put right by its two neighbours, whatever their number; a
    few others are each compared.
    """
    count = len(ordered)
    step = (ordered[-1] - ordered[0]) / max(1, count - 1)
    if count < 16 or any(abs(t - ordered[0] - step * i) > step / 1000 for i, t in enumerate(ordered)):
        return sum([F.when(_predicted(F.lit(t)), F.lit(1)).otherwise(F.lit(0)) for t in ordered], F.lit(0))
    score = F.greatest(F.lit(ordered[0] - step), F.least(F.col("score"), F.lit(ordered[-1] + step)))
    guess = F.least(F.greatest(F.floor((score - ordered[0]) / step) + 1, F.lit(0)), F.lit(count)).cast("int")
    marks = F.array(*[F.lit(t) for t in ordered])

    def mark(place: Column) -> Column:
        """The threshold at a place from 1 on, null beyond."""
        return F.when((place >= 1) & (place <= count), F.element_at(marks, F.greatest(F.least(place, F.lit(count)), F.lit(1))))

    more = F.when(_predicted(mark(guess + 1)), 1).otherwise(0)
    less = F.when(~_predicted(mark(guess)), 1).otherwise(0)
    return F.when(F.col("score").isNull(), F.lit(0)).otherwise(guess + more - less)


def sweep(scores: DataFrame, thresholds: Sequence[float] = fv.SWEEP_THRESHOLDS) -> DataFrame:
    """Recall, precision, F1, misses, miss rate and rating at each threshold.

    Every row is counted once, under the number of thresholds it reaches; totals from there up are
    what each threshold flags.
    """
    ordered = sorted(set(float(t) for t in thresholds))
    steps = (
        scores.select(_reached(ordered).alias("step"), "label")
        .groupBy("step")
        .agg(
            F.count_if(F.col("label") == 1).alias("pos"),
            F.count_if(F.col("label") == 0).alias("neg"),
        )
    )
    listed = scores.sparkSession.createDataFrame(
        [(i, t) for i, t in enumerate([None, *ordered])], "step int, threshold double"
    )
    # One row per threshold from here on.
    upward = W.orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, 0)
    everything = W.partitionBy()
    filled = listed.join(steps, "step", "left").fillna(0, subset=["pos", "neg"])
    totals = filled.select(
        "threshold",
        F.sum("pos").over(upward).alias("tp"),
        F.sum("neg").over(upward).alias("fp"),
        F.sum("pos").over(everything).alias("p"),
    ).filter(F.col("threshold").isNotNull())
    precision = ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = ratio(F.col("tp"), F.col("p"))
    missed = F.col("p") - F.col("tp")
    rates = totals.select(
        "threshold", recall.alias("recall"), precision.alias("precision"),
        missed.alias("fn"), ratio(missed, F.col("p")).alias("fn_rate"),
    )
    f1 = ratio(
        2.0 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
    )
    return rates.select(
        "threshold", "recall", "precision", f1.alias("f1"), "fn", "fn_rate",
        measure.miss_rate_rating(F.col("fn_rate")).alias("rating"),
    ).orderBy("threshold")


def evenly_spaced(first: float, last: float, count: int) -> list[float]:
    step = (last - first) / (count - 1)
    return [first + step * i for i in range(count - 1)] + [last]


def threshold_curve(scores: DataFrame) -> DataFrame:
    return sweep(scores, evenly_spaced(*fv.CURVE_THRESHOLDS)).select(
        "threshold", "recall", "precision", "f1"
    )


def best_threshold(swept: DataFrame, safe_below: float = fv.SAFE_MISS_RATE) -> DataFrame:
    """Highest F1 among thresholds that miss few enough, else the lowest miss rate.

    Ties go to the lowest threshold.
    """
    safe = F.col("fn_rate") < safe_below
    return swept.orderBy(
        safe.desc(),
        F.when(safe, F.col("f1")).desc(),
        F.when(~safe, F.col("fn_rate")).asc(),
        "threshold",
    ).limit(1)


def threshold_advice(best: DataFrame) -> DataFrame:
    return best.select(
        F.col("threshold").alias("optimal_threshold"),
        F.format_string(fv.THRESHOLD_ADVICE, "threshold").alias("recommendation"),
    )


def regression(predictions: DataFrame, label: str = "label", predicted: str = "prediction"):
    """RMSE, MAE and R² in one pass; the spread of labels comes from their variance."""
    error = F.col(label) - F.col(predicted)
    spread = F.var_pop(label) * F.count(label)
    return predictions.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1.0 - F.sum(error * error) / F.nullif(spread, F.lit(0.0))).alias("r2"),
    )


def fixed_baselines(labels: DataFrame) -> DataFrame:
    """Recall and precision of always saying safe and of always saying danger."""
    counts = labels.agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count("label").alias("rows")
    )
    zero = F.lit(0.0)
    lines = F.array(
        F.struct(F.lit("always safe").alias("baseline"), zero.alias("recall"),
                 zero.alias("precision")),
        F.struct(F.lit("always danger").alias("baseline"),
                 ratio(F.col("pos"), F.col("pos")).alias("recall"),
                 ratio(F.col("pos"), F.col("rows")).alias("precision")),
    )
    return counts.select(F.inline(lines))


def random_baseline(labels: DataFrame, key: str, seed: int = fv.SEED) -> DataFrame:
    """Recall and precision of guessing danger at the rate it occurs.

    The coin of each row is its hash against the rate, so the result repeats.
    """
    rate = labels.agg(F.avg(F.col("label").cast("double"))).scalar()
    coin = F.conv(F.substring(hash_order(F.col(key).cast("string"), F.lit(str(seed))), 1, 8), 16, 10)
    guess = coin.cast("double") / float(16**8) < rate
    event = F.col("label") == 1
    return labels.agg(
        F.lit("random").alias("baseline"),
        ratio(F.count_if(guess & event), F.count_if(event)).alias("recall"),
        ratio(F.count_if(guess & event), F.count_if(guess)).alias("precision"),
    )
