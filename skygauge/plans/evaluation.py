"""Evaluation queries: every model's scores against the labels of both targets."""

from pyspark.sql import functions as F

from skygauge.operators import evaluate as E, learning as M
from skygauge.plans.registry import query
from skygauge.plans.views import hazard_labels, predictions, scored

SETS = ["model", "target"]
CELLS = """c AS (SELECT model, target, count(*) FILTER (WHERE p >= 0.5 AND y = 1) AS tp, count(*) FILTER (WHERE p >= 0.5 AND y = 0) AS fp,
  count(*) FILTER (WHERE p < 0.5 AND y = 1) AS fn, count(*) FILTER (WHERE p < 0.5 AND y = 0) AS tn FROM scored GROUP BY 1, 2)"""
R = "coalesce(CAST({} AS DOUBLE) / nullif({}, 0), CAST(0 AS DOUBLE))".format
PREFIX = """s AS (SELECT model, target, p, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM scored GROUP BY 1, 2, 3),
t AS (SELECT *, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp FROM s WINDOW w AS (PARTITION BY model, target ORDER BY p DESC)),
n AS (SELECT model, target, CAST(sum(pos) AS BIGINT) AS all_pos, CAST(sum(neg) AS BIGINT) AS all_neg FROM s GROUP BY 1, 2)"""


@query("confusion_matrix", f"""WITH {CELLS} SELECT model, target, CAST(0 AS BIGINT) AS actual, CAST(0 AS BIGINT) AS predicted, tn AS n FROM c UNION ALL SELECT model, target, 0, 1, fp FROM c
  UNION ALL SELECT model, target, 1, 0, fn FROM c UNION ALL SELECT model, target, 1, 1, tp FROM c""", "scored")
def confusion_matrix(spark, folder):
    return E.confusion_matrix(scored(spark, folder), by=SETS)


@query("binary_metrics", f"""WITH {CELLS} SELECT model, target, {R('tp + tn', 'tp + tn + fp + fn')} AS accuracy, {R('tp', 'tp + fp')} AS precision, {R('tp', 'tp + fn')} AS recall,
  {R('2 * tp', '2 * tp + fp + fn')} AS f1 FROM c""", "scored")
def binary_metrics(spark, folder):
    return E.binary_metrics(scored(spark, folder), by=SETS)


@query("class_report", f"""WITH {CELLS},
r AS (SELECT model, target, '0' AS label, {R('tn', 'tn + fn')} AS precision, {R('tn', 'tn + fp')} AS recall, {R('2 * tn', '2 * tn + fn + fp')} AS f1, tn + fp AS support FROM c
  UNION ALL SELECT model, target, '1', {R('tp', 'tp + fp')}, {R('tp', 'tp + fn')}, {R('2 * tp', '2 * tp + fp + fn')}, tp + fn FROM c)
SELECT model, target, label, precision, recall, f1, support FROM r
UNION ALL SELECT model, target, 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), CAST(sum(support) AS BIGINT) FROM r GROUP BY 1, 2
UNION ALL SELECT model, target, 'weighted avg', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9),
  CAST(sum(support) AS BIGINT) FROM r GROUP BY 1, 2""", "scored")
def class_report(spark, folder):
    return E.class_report(scored(spark, folder), by=SETS)


@query("roc_auc", f"""WITH {PREFIX} SELECT model, target, round(CAST(sum(CAST(neg AS HUGEINT) * (2 * tp - pos)) AS DOUBLE)
  / nullif(CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE) * CAST(2 AS DOUBLE), 0), 9) AS roc_auc FROM t GROUP BY 1, 2""", "scored")
def roc_auc(spark, folder):
    return E.roc_auc(scored(spark, folder), SETS)


@query("average_precision", f"WITH {PREFIX} SELECT model, target, round(sum(CAST(pos AS DOUBLE) * tp / (tp + fp)) / nullif(sum(pos), 0), 9) AS average_precision FROM t GROUP BY 1, 2", "scored")
def average_precision(spark, folder):
    return E.average_precision(scored(spark, folder), SETS)


@query("pr_curve", f"""WITH {PREFIX} SELECT model, target, p AS threshold, {R('tp', '(tp + fp)')} AS precision, {R('tp', 'all_pos')} AS recall FROM t JOIN n USING (model, target)
  UNION ALL SELECT model, target, NULL, 1, 0 FROM n""", "scored")
def pr_curve(spark, folder):
    return E.pr_curve(scored(spark, folder), SETS)


@query("roc_curve", f"""WITH {PREFIX} SELECT model, target, p AS threshold, {R('fp', 'all_neg')} AS fpr, {R('tp', 'all_pos')} AS tpr FROM t JOIN n USING (model, target)
  UNION ALL SELECT model, target, NULL, 0, 0 FROM n""", "scored")
def roc_curve(spark, folder):
    return E.roc_curve(scored(spark, folder), SETS)


@query("error_analysis", """WITH e AS (SELECT *, CASE WHEN p >= 0.5 AND y = 0 THEN 'false_positive' WHEN p < 0.5 AND y = 1 THEN 'false_negative' END AS error,
  count(*) OVER (PARTITION BY model, target) AS total FROM scored)
SELECT model, target, error, count(*) AS n, count(*) * CAST(100 AS DOUBLE) / max(total) AS share_pct,
  round(CAST(sum(CAST(p AS DECIMAL(28,15))) AS DOUBLE) / count(*), 9) AS mean_probability FROM e WHERE error IS NOT NULL GROUP BY 1, 2, 3""", "scored")
def error_analysis(spark, folder):
    return E.error_analysis(scored(spark, folder), by=SETS)


@query("prob_histogram", "SELECT model, target, y, CAST(least(floor(p * CAST(50 AS DOUBLE)), 49) AS BIGINT) AS bin, count(*) AS n FROM scored GROUP BY 1, 2, 3, 4", "scored")
def prob_histogram(spark, folder):
    return E.prob_histogram(scored(spark, folder), by=SETS)


@query("prediction_summary", """SELECT model, target, count(*) AS total, count(*) FILTER (WHERE p >= 0.5) AS positive, count(*) FILTER (WHERE p < 0.5) AS negative,
  CAST(count(*) FILTER (WHERE (p >= 0.5) = (y = 1)) AS DOUBLE) / count(*) AS accuracy FROM scored GROUP BY 1, 2""", "scored")
def prediction_summary(spark, folder):
    return E.prediction_summary(scored(spark, folder), by=SETS)


@query("class_weight", """SELECT model, target, greatest(CAST(1 AS DOUBLE), CAST(count(*) FILTER (WHERE y = 0) AS DOUBLE) / greatest(count(*) FILTER (WHERE y = 1), 1)) AS weight
  FROM scored GROUP BY 1, 2""", "scored")
def class_weight(spark, folder):
    return E.class_weight(scored(spark, folder), by=SETS)


@query("predictions_vs_actual", "SELECT Date, District, model, target, y AS y_true, p AS y_pred, CAST(p >= 0.5 AS BIGINT) AS prediction FROM scored", "scored")
def predictions_vs_actual(spark, folder):
    parts = [
        M.align(predictions(spark, folder).filter((F.col("model") == m) & (F.col("target") == t)), hazard_labels(spark, folder), t).withColumns({"model": F.lit(m), "target": F.lit(t)})
        for m in ("rule", "xgboost", "lstm") for t in ("heatwave", "flood_proxy")
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
