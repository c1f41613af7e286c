"""Evaluation metrics on scored laps."""

from pyspark.sql import functions as F

from stintlake.catalog.registry import R, query, r6
from stintlake.catalog.roles import BUILDERS, ROLE_SQL, role
from stintlake.operators import metrics as M

RATES = ["accuracy", "precision", "recall", "f1_score", "specificity", "balanced_accuracy"]


def _build_scores(spark, sf):
    e = F.col("event_id")
    y = F.col("PitInTime").isNotNull().cast("int")
    return role(spark, sf, "laps").select(
        "event_id",
        y.alias("y"),
        # certain and impossible ones among them, right and wrong
        F.when(e % 503 == 0, 0.0).when(e % 499 == 0, 1.0).otherwise((e * 7919 % 1009 + 300 * y + 1) / 1400).alias("prob"),
        (F.col("LapNumber") % 5).cast("int").alias("type_true"),
        (e % 6).cast("int").alias("type_pred"),
        F.when(e % 211 == 0, 0.0).when(e % 7 != 0, (1 + e % 97) / 100).alias("type_prob"),
    )


BUILDERS["scores"] = _build_scores
ROLE_SQL["scores"] = (
    ("laps",),
    """SELECT event_id, CAST(PitInTime IS NOT NULL AS INTEGER) AS y,
        CASE WHEN event_id % 503 = 0 THEN 0.0::DOUBLE WHEN event_id % 499 = 0 THEN 1.0::DOUBLE
            ELSE (event_id * 7919 % 1009 + 300 * CAST(PitInTime IS NOT NULL AS INTEGER) + 1) / 1400 END AS prob,
        CAST(LapNumber % 5 AS INTEGER) AS type_true, CAST(event_id % 6 AS INTEGER) AS type_pred,
        CASE WHEN event_id % 211 = 0 THEN 0.0::DOUBLE WHEN event_id % 7 <> 0 THEN (1 + event_id % 97) / 100 END AS type_prob FROM laps""",
)

_RATE_SQL = f"""{R("coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0)")} AS accuracy,
    {R("coalesce(tp / nullif(tp + fp, 0), 0)")} AS precision, {R("coalesce(tp / nullif(tp + fn, 0), 0)")} AS recall,
    {R("coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)")} AS f1_score,
    {R("coalesce(tn / nullif(tn + fp, 0), 0)")} AS specificity,
    {R("(coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2")} AS balanced_accuracy"""


def _rounded(df):
    return df.withColumns({c: r6(c) for c in RATES})


@query(
    "ml_confusion",
    f"""c AS (SELECT count(*) FILTER (prob >= 0.5 AND y = 1) AS tp, count(*) FILTER (prob < 0.5 AND y = 0) AS tn,
        count(*) FILTER (prob >= 0.5 AND y = 0) AS fp, count(*) FILTER (prob < 0.5 AND y = 1) AS fn FROM scores)
    SELECT tp, tn, fp, fn, {_RATE_SQL} FROM c""",
    ("scores",),
)
def ml_confusion(spark, sf):
    return _rounded(M.confusion(role(spark, sf, "scores")))


CUM_SQL = """g AS (SELECT prob, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM scores GROUP BY prob),
    c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, (SELECT sum(pos) FROM g) AS p, (SELECT sum(neg) FROM g) AS n
        FROM g WINDOW w AS (ORDER BY prob DESC))"""


@query(
    "ml_roc_auc",
    f"""r AS (SELECT y, rank() OVER (ORDER BY prob) + (count(*) OVER (PARTITION BY prob) - 1) / 2 AS rk FROM scores),
    s AS (SELECT sum(rk) FILTER (y = 1) AS rs, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS n FROM r)
    SELECT {R("(rs - p * (p + 1) / 2) / (CAST(p AS DOUBLE) * n)")} AS roc_auc FROM s""",
    ("scores",),
)
def ml_roc_auc(spark, sf):
    return M.roc_auc(role(spark, sf, "scores")).withColumn("roc_auc", r6("roc_auc"))


@query("ml_pr_auc", f"{CUM_SQL} SELECT {R('sum(pos / p * tp / (tp + fp))')} AS pr_auc FROM c", ("scores",))
def ml_pr_auc(spark, sf):
    return M.pr_auc(role(spark, sf, "scores")).withColumn("pr_auc", r6("pr_auc"))


@query(
    "ml_curves",
    f"""{CUM_SQL} SELECT prob AS threshold, {R("fp / n")} AS fpr, {R("tp / p")} AS tpr, {R("tp / (tp + fp)")} AS precision,
        {R("tp / p")} AS recall FROM c""",
    ("scores",),
)
def ml_curves(spark, sf):
    done = M.curves(role(spark, sf, "scores"))
    return done.withColumns({c: r6(c) for c in ("fpr", "tpr", "precision", "recall")})


@query(
    "ml_score_hist",
    """e AS (SELECT min(prob) AS lo, max(prob) AS hi FROM scores)
    SELECT y, CAST(least(floor((prob - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin, count(*) AS n FROM scores, e GROUP BY ALL""",
    ("scores",),
)
def ml_score_hist(spark, sf):
    return M.score_hist(role(spark, sf, "scores"))


SWEEP_SQL = f"""marks AS (SELECT 0.1::DOUBLE + 0.8::DOUBLE * i / 80 AS threshold FROM range(81) t(i)),
    c AS (SELECT threshold, count(*) FILTER (prob >= threshold AND y = 1) AS tp, count(*) FILTER (prob < threshold AND y = 0) AS tn,
        count(*) FILTER (prob >= threshold AND y = 0) AS fp, count(*) FILTER (prob < threshold AND y = 1) AS fn
    FROM marks, scores GROUP BY threshold),
    sweep AS (SELECT threshold, tp, tn, fp, fn, {_RATE_SQL} FROM c)"""


@query(
    "ml_threshold_sweep",
    f"{SWEEP_SQL} SELECT * REPLACE ({R('threshold')} AS threshold) FROM sweep",
    ("scores",),
)
def ml_threshold_sweep(spark, sf):
    done = _rounded(M.threshold_sweep(role(spark, sf, "scores")))
    return done.withColumn("threshold", r6("threshold"))


@query(
    "ml_threshold_best",
    f"""{SWEEP_SQL} SELECT {R("threshold")} AS threshold, f1_score, precision, recall FROM sweep
    ORDER BY recall >= 0.8 DESC, CASE WHEN recall >= 0.8 THEN f1_score ELSE recall END DESC, threshold LIMIT 1""",
    ("scores",),
)
def ml_threshold_best(spark, sf):
    best = M.threshold_best(M.threshold_sweep(role(spark, sf, "scores")))
    return best.select(*[r6(c).alias(c) for c in best.columns])


@query(
    "ml_threshold_best_curve",
    f"""{CUM_SQL}, k AS (SELECT prob AS threshold, tp / (tp + fp) AS pr, tp / p AS re FROM c),
    v AS (SELECT * FROM k WHERE re >= 0.8 AND threshold < (SELECT max(threshold) FROM k WHERE re >= 0.8))
    SELECT {R("threshold")} AS threshold, {R("pr")} AS precision, {R("re")} AS recall FROM v
    ORDER BY 2 * pr * re / (pr + re + 1e-8) DESC, v.threshold LIMIT 1""",
    ("scores",),
)
def ml_threshold_best_curve(spark, sf):
    best = M.threshold_best_curve(role(spark, sf, "scores"))
    return best.select(*[r6(c).alias(c) for c in best.columns])


@query(
    "ml_type_report",
    f"""r AS (SELECT * FROM scores WHERE y = 1), k AS (SELECT type_true AS class FROM r UNION SELECT type_pred FROM r),
    t AS (SELECT class, (SELECT count(*) FROM r WHERE type_true = class) AS support,
        (SELECT count(*) FROM r WHERE type_pred = class) AS said,
        (SELECT count(*) FROM r WHERE type_pred = class AND type_true = class) AS hit FROM k)
    SELECT class, {R("coalesce(hit / nullif(said, 0), 0)")} AS precision, {R("coalesce(hit / nullif(support, 0), 0)")} AS recall,
        {R("coalesce(2 * hit / nullif(said + support, 0), 0)")} AS f1_score, support,
        {R("(SELECT avg(CAST(type_true = type_pred AS INTEGER)) FROM r)")} AS accuracy FROM t""",
    ("scores",),
)
def ml_type_report(spark, sf):
    done = M.type_report(role(spark, sf, "scores"))
    return done.withColumns({c: r6(c) for c in ("precision", "recall", "f1_score", "accuracy")})


@query(
    "ml_loss_report",
    f"""g AS (SELECT y, CASE WHEN prob <= 0 THEN -100 ELSE ln(prob) END AS yes, CASE WHEN prob >= 1 THEN -100 ELSE ln(1 - prob) END AS no,
        CASE WHEN type_prob <= 0 THEN -100 WHEN type_prob > 0 THEN ln(type_prob) END AS kind FROM scores),
    l AS (SELECT avg(-(29 * y * yes + (1 - y) * no)) AS c, avg(-kind) FILTER (y = 1) AS t FROM g)
    SELECT {R("c")} AS change_loss, {R("t")} AS type_loss, {R("0.92 * c + 0.08 * t")} AS total_loss FROM l""",
    ("scores",),
)
def ml_loss_report(spark, sf):
    done = M.loss_report(role(spark, sf, "scores"))
    return done.select(*[r6(c).alias(c) for c in done.columns])
