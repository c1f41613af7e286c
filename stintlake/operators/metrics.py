"""Evaluation of scored rows: probability ``prob`` and 0/1 target ``y``.

Curves and areas work on counts per distinct score with running totals, so a
table of any size is reduced before it is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.functions.ordered import OrderedGroups
from stintlake.operators.quality import histogram


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _rates(df: DataFrame) -> DataFrame:
    """Rates from the counts ``tp``, ``fp``, ``fn`` and ``tn``."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    recall, specificity = _zero(F.try_divide(tp, tp + fn)), _zero(F.try_divide(tn, tn + fp))
    return df.withColumns(
        {
            "accuracy": _zero(F.try_divide(tp + tn, tp + tn + fp + fn)),
            "precision": _zero(F.try_divide(tp, tp + fp)),
            "recall": recall,
            "f1_score": _zero(F.try_divide(2 * tp, 2 * tp + fp + fn)),
            "specificity": specificity,
            "balanced_accuracy": (recall + specificity) / 2,
        }
    )


def confusion(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    said, is_so = F.col("prob") >= threshold, F.col("y") == 1
    return _rates(
        scores.agg(
            F.count_if(said & is_so).alias("tp"),
            F.count_if(~said & ~is_so).alias("tn"),
            F.count_if(said & ~is_so).alias("fp"),
            F.count_if(~said & is_so).alias("fn"),
        )
    )


def score_counts(scores: DataFrame) -> DataFrame:
    """Per distinct score, highest first: positives and negatives at it and from the top down to it."""
    counts = scores.groupBy("prob").agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg")
    )
    g = OrderedGroups(counts.withColumn("_down", -F.col("prob")), [], ["_down"])
    g = g.running(sums={"tp": F.col("pos"), "fp": F.col("neg")})
    totals = counts.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n")).alias("t"))
    out = g.result().drop("_down").withColumn("_t", totals.scalar())
    return out.withColumns({"all_pos": F.col("_t.p"), "all_neg": F.col("_t.n")}).drop("_t")


def roc_auc(scores: DataFrame) -> DataFrame:
    """Area under the ROC curve, ties counting half; 0 with one class only."""
    pos, neg, fp = (F.col(c).cast("double") for c in ("pos", "neg", "fp"))
    won = pos * (F.col("all_neg") - fp + neg / 2)
    return score_counts(scores).agg(
        _zero(F.try_divide(F.sum(won), F.max(F.col("all_pos").cast("double") * F.col("all_neg")))).alias("roc_auc")
    )


def pr_auc(scores: DataFrame) -> DataFrame:
    """Average precision: precision at every distinct score weighted by the recall gained; 0 with one class only."""
    c = F.col
    gained = c("pos") * c("tp") / (c("tp") + c("fp"))
    both = F.max(c("all_pos")) * F.max(c("all_neg")) > 0
    return score_counts(scores).agg(
        F.when(both, F.sum(gained) / F.max("all_pos")).otherwise(0.0).alias("pr_auc")
    )


def curves(scores: DataFrame) -> DataFrame:
    """ROC and precision-recall point at every distinct score."""
    c = F.col
    return score_counts(scores).select(
        c("prob").alias("threshold"),
        _zero(F.try_divide("fp", "all_neg")).alias("fpr"),
        _zero(F.try_divide("tp", "all_pos")).alias("tpr"),
        (c("tp") / (c("tp") + c("fp"))).alias("precision"),
        _zero(F.try_divide("tp", "all_pos")).alias("recall"),
    )


def score_hist(scores: DataFrame, bins: int = 50) -> DataFrame:
    """Histogram of the scores of each class over the whole score range."""
    return histogram(scores, "prob", bins, by=["y"])


def grid(low: float = 0.1, high: float = 0.9, steps: int = 81) -> list[float]:
    return [low + (high - low) * i / (steps - 1) for i in range(steps)]


def threshold_sweep(scores: DataFrame, thresholds: list[float] | None = None) -> DataFrame:
    """Rates at every threshold of a grid.

    Rows are first counted by how many thresholds they reach; the running
    totals then go over one row per threshold.
    """
    marks = sorted(thresholds or grid())
    table = F.array(*[F.lit(t) for t in marks])
    width = (marks[-1] - marks[0]) / max(len(marks) - 1, 1)
    # even grid: the slot is near (prob - low) / width; the two marks around it decide
    guess = F.greatest(
        F.least(F.floor((F.col("prob") - marks[0]) / (width or 1.0)).cast("int"), F.lit(len(marks) - 1)), F.lit(0)
    )
    even = all(abs(marks[0] + i * width - t) < 1e-9 for i, t in enumerate(marks))
    if even:
        lower = F.greatest(guess - 1, F.lit(0))
        near = F.slice(table, lower + 1, 4)
        reached = lower + F.size(F.filter(near, lambda t: t <= F.col("prob")))
    else:
        reached = F.size(F.filter(table, lambda t: t <= F.col("prob")))
    counts = scores.groupBy(reached.cast("int").alias("_reached")).agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg")
    )
    spread = counts.agg(
        F.map_from_entries(F.collect_list(F.struct("_reached", F.struct("pos", "neg")))).alias("m")
    ).select(F.posexplode(F.array(*[F.lit(t) for t in marks])).alias("_i", "threshold"), "m")
    above = F.filter(F.map_entries("m"), lambda e: e["key"] > F.col("_i"))
    below = F.filter(F.map_entries("m"), lambda e: e["key"] <= F.col("_i"))

    def total(entries: Column, field: str) -> Column:
        return F.aggregate(entries, F.lit(0).cast("long"), lambda a, e: a + e["value"][field])

    return _rates(
        spread.select(
            "threshold",
            total(above, "pos").alias("tp"),
            total(below, "neg").alias("tn"),
            total(above, "neg").alias("fp"),
            total(below, "pos").alias("fn"),
        )
    )


def threshold_best(sweep: DataFrame, target_recall: float = 0.8) -> DataFrame:
    """Threshold of the best F1 with enough recall, else of the best recall; the lowest on ties."""
    ok = F.col("recall") >= target_recall
    rank = F.struct(
        ok.alias("ok"),
        F.when(ok, F.col("f1_score")).otherwise(F.col("recall")).alias("value"),
        (-F.col("threshold")).alias("low"),
    )
    return sweep.agg(F.max_by(F.struct("threshold", "f1_score", "precision", "recall"), rank).alias("b")).select("b.*")


def threshold_best_curve(scores: DataFrame, target_recall: float = 0.8, metric: str = "f1") -> DataFrame:
    """The same over every distinct score.

    As in the original selection the highest threshold that still reaches the
    recall is not a candidate, unless it is the only one.
    """
    points = score_counts(scores).select(
        F.col("prob").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        _zero(F.try_divide("tp", "all_pos")).alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    value = 2 * p * r / (p + r + 1e-8) if metric == "f1" else p
    ok = r >= target_recall
    top = points.where(ok).agg(F.max("threshold").alias("t"))
    points = points.withColumn("_top", top.scalar())
    candidate = ok & (F.col("threshold") < F.col("_top"))
    rank = F.struct(
        candidate.alias("candidate"),
        ok.alias("ok"),
        F.when(ok, value).otherwise(r).alias("value"),
        (-F.col("threshold")).alias("low"),
    )
    return points.agg(F.max_by(F.struct("threshold", "precision", "recall"), rank).alias("b")).select("b.*")


def type_report(scores: DataFrame, true: str = "type_true", predicted: str = "type_pred") -> DataFrame:
    """Per compound, over rows with a real change: precision, recall, F1, support; overall accuracy."""
    real = scores.where(F.col("y") == 1)
    both = real.select(
        F.explode(
            F.array(
                F.struct(F.col(true).alias("class"), F.lit(1).alias("t"), F.lit(0).alias("p"), F.lit(0).alias("hit")),
                F.struct(
                    F.col(predicted).alias("class"),
                    F.lit(0).alias("t"),
                    F.lit(1).alias("p"),
                    (F.col(true) == F.col(predicted)).cast("int").alias("hit"),
                ),
            )
        ).alias("_r")
    ).select("_r.*")
    per = both.groupBy("class").agg(F.sum("t").alias("support"), F.sum("p").alias("_p"), F.sum("hit").alias("_hit"))
    accuracy = real.agg(F.avg((F.col(true) == F.col(predicted)).cast("double")).alias("a"))
    hit, p, t = F.col("_hit"), F.col("_p"), F.col("support")
    return per.select(
        "class",
        _zero(F.try_divide(hit, p)).alias("precision"),
        _zero(F.try_divide(hit, t)).alias("recall"),
        _zero(F.try_divide(2 * hit, p + t)).alias("f1_score"),
        "support",
        accuracy.scalar().alias("accuracy"),
    )


def loss_report(
    scores: DataFrame, pos_weight: float = 29.0, alpha: float = 0.92, beta: float = 0.08, type_prob: str = "type_prob"
) -> DataFrame:
    """Mean weighted cross-entropy of the change, cross-entropy of the true compound on real changes, and their mix.

    Means are over the whole table. A logarithm is never below -100, which a
    probability of 0 for what was true counts as. Real changes without a known
    compound (``type_prob`` null) have no part in the type loss.
    """
    y, p = F.col("y"), F.col("prob")

    def log(x: Column) -> Column:
        return F.when(x <= 0, F.lit(-100.0)).when(x > 0, F.greatest(F.log(x), F.lit(-100.0)))

    change = -(pos_weight * y * log(p) + (1 - y) * log(1 - p))
    kind = F.when((y == 1) & F.col(type_prob).isNotNull(), -log(F.col(type_prob)))
    return scores.agg(F.avg(change).alias("change_loss"), _zero(F.avg(kind)).alias("type_loss")).withColumn(
        "total_loss", alpha * F.col("change_loss") + beta * F.col("type_loss")
    )
