"""Evaluation of probabilities ``p`` against labels ``y`` (0/1).

Every function takes ``by``, the columns of the sets to evaluate apart, such as model and target; they lead the result.
Curves and areas use exact running counts over the distinct scores in score order; equal scores
count as one threshold. Counts are integers throughout, so areas do not depend on row order.
"""

from pyspark.sql import DataFrame, Window as W, functions as F

from skygauge.operators.ordered import running_totals

DIGITS = 9


def ratio(a, b):
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _cells(threshold):
    hit, true = F.col("p") >= threshold, F.col("y") == 1
    return {
        "tp": F.count_if(hit & true), "fp": F.count_if(hit & ~true),
        "fn": F.count_if(~hit & true), "tn": F.count_if(~hit & ~true),
    }


def confusion_matrix(df: DataFrame, threshold=0.5, by=()) -> DataFrame:
    """All four cells, zeros included."""
    cells = df.groupBy(*by).agg(*[c.alias(n) for n, c in _cells(threshold).items()])
    return cells.selectExpr(*by, "stack(4, 0L, 0L, tn, 0L, 1L, fp, 1L, 0L, fn, 1L, 1L, tp) AS (actual, predicted, n)")


def binary_metrics(df: DataFrame, threshold=0.5, by=()) -> DataFrame:
    c = df.groupBy(*by).agg(*[c.alias(n) for n, c in _cells(threshold).items()])
    tp, fp, fn, tn = (F.col(n) for n in ("tp", "fp", "fn", "tn"))
    return c.select(
        *by, ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"), ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def class_report(df: DataFrame, threshold=0.5, by=()) -> DataFrame:
    """Precision, recall, F1 and support per class, then macro and support-weighted averages."""
    c = df.groupBy(*by).agg(*[c.alias(n) for n, c in _cells(threshold).items()])
    per = c.selectExpr(*by, "inline(array(struct('0' AS label, tn AS hit, fn AS false_hit, fp AS miss), struct('1' AS label, tp AS hit, fp AS false_hit, fn AS miss)))")
    hit, false_hit, miss = F.col("hit"), F.col("false_hit"), F.col("miss")
    rows = per.select(
        *by, "label", ratio(hit, hit + false_hit).alias("precision"), ratio(hit, hit + miss).alias("recall"),
        ratio(2 * hit, 2 * hit + false_hit + miss).alias("f1"), (hit + miss).alias("support"),
    )
    scores = ("precision", "recall", "f1")
    macro = rows.groupBy(*by).agg(*[F.round(F.avg(s), DIGITS).alias(s) for s in scores], F.sum("support").alias("support"))
    weighted = rows.groupBy(*by).agg(
        *[F.round(ratio(F.sum(F.col(s) * F.col("support")), F.sum("support")), DIGITS).alias(s) for s in scores], F.sum("support").alias("support"))
    return rows.unionByName(macro.withColumn("label", F.lit("macro avg"))).unionByName(weighted.withColumn("label", F.lit("weighted avg")))


def score_counts(df: DataFrame, by=()) -> DataFrame:
    """Positives and negatives per distinct score."""
    return df.groupBy(*by, "p").agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))


def score_prefix(df: DataFrame, by=()) -> DataFrame:
    """Per distinct score, ``tp`` and ``fp``: positives and negatives at or above it; ``all_pos`` and ``all_neg``: those of the whole set.

    One total order over all sets; what stands before a set is taken off. The table of sets has one row each.
    """
    counts = score_counts(df, by)
    along = running_totals(counts, [*by, F.desc("p")], {"tp": "pos", "fp": "neg"})
    sets = along.groupBy(*by).agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))  # from the pinned counts
    if not by:
        whole = sets.agg(F.struct(F.first("all_pos").alias("p"), F.first("all_neg").alias("n"))).scalar()
        return along.withColumns({"all_pos": whole["p"], "all_neg": whole["n"]})
    before = W.orderBy(*by).rowsBetween(W.unboundedPreceding, -1)
    starts = sets.withColumns({f"_{n}": F.coalesce(F.sum(n).over(before), F.lit(0)) for n in ("all_pos", "all_neg")})
    return along.join(starts, list(by)).withColumns({"tp": F.col("tp") - F.col("_all_pos"), "fp": F.col("fp") - F.col("_all_neg")}).drop("_all_pos", "_all_neg")


def roc_auc(df: DataFrame, by=()) -> DataFrame:
    """Probability that a positive outranks a negative, ties counting half; null for one class."""
    wide = "decimal(38,0)"
    beaten = F.sum((F.col("neg").cast("decimal(18,0)") * (2 * F.col("tp") - F.col("pos")).cast("decimal(18,0)")).cast(wide))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double") * 2.0
    return score_prefix(df, by).groupBy(*by).agg(F.round(F.try_divide(beaten.cast("double"), pairs), DIGITS).alias("roc_auc"))


def average_precision(df: DataFrame, by=()) -> DataFrame:
    """Sum of recall steps times precision, without interpolation; null without positives."""
    step = F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))
    return score_prefix(df, by).groupBy(*by).agg(F.round(F.try_divide(F.sum(step), F.sum("pos")), DIGITS).alias("average_precision"))


def _with_end(prefix: DataFrame, by, points: dict, end: dict) -> DataFrame:
    """The points of each score, and one more point per set."""
    none = F.lit(None).cast("double")
    curve = prefix.select(*by, F.col("p").alias("threshold"), *[c.alias(n) for n, c in points.items()])
    ends = prefix.select(*by).distinct() if by else prefix.sparkSession.range(1)
    return curve.unionByName(ends.select(*by, none.alias("threshold"), *[F.lit(float(v)).alias(n) for n, v in end.items()]))


def pr_curve(df: DataFrame, by=()) -> DataFrame:
    """(threshold, precision, recall) per distinct score, and the end point (null, 1, 0)."""
    tp, fp = F.col("tp"), F.col("fp")
    return _with_end(score_prefix(df, by), by, {"precision": ratio(tp, tp + fp), "recall": ratio(tp, F.col("all_pos"))}, {"precision": 1, "recall": 0})


def roc_curve(df: DataFrame, by=()) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, and the start point (null, 0, 0)."""
    return _with_end(score_prefix(df, by), by, {"fpr": ratio(F.col("fp"), F.col("all_neg")), "tpr": ratio(F.col("tp"), F.col("all_pos"))}, {"fpr": 0, "tpr": 0})


def error_analysis(df: DataFrame, threshold=0.5, by=()) -> DataFrame:
    """False positives and negatives: number, share of all rows in percent, mean probability."""
    hit, true = F.col("p") >= threshold, F.col("y") == 1
    cases = {"false_positive": hit & ~true, "false_negative": ~hit & true}
    p = F.col("p").cast("decimal(28,15)")
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), *[
        F.struct(F.lit(name).alias("error"), F.count_if(case).alias("n"), F.sum(F.when(case, p)).cast("double").alias("s")).alias(name)
        for name, case in cases.items()])
    return counted.select(*by, "total", F.inline(F.array(*cases))).filter("n > 0").select(
        *by, "error", "n", (F.col("n") * F.lit(100.0) / F.col("total")).alias("share_pct"),
        F.round(F.col("s") / F.col("n"), DIGITS).alias("mean_probability"))


def prob_histogram(df: DataFrame, bins=50, by=()) -> DataFrame:
    """Rows per class and probability bin of [0, 1]."""
    b = F.least(F.floor(F.col("p") * F.lit(float(bins))), F.lit(bins - 1)).cast("bigint")
    return df.groupBy(*by, "y", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def prediction_summary(df: DataFrame, threshold=0.5, by=()) -> DataFrame:
    positive = F.col("p") >= threshold
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(positive).alias("positive"), F.count_if(~positive).alias("negative"),
        ratio(F.count_if(positive.cast("int") == F.col("y")), F.count("y")).alias("accuracy"))


def class_weight(df: DataFrame, by=()) -> DataFrame:
    """Weight of the positive class: negatives per positive, at least 1."""
    pos = F.count_if(F.col("y") == 1)
    neg = F.count_if(F.col("y") == 0)
    return df.groupBy(*by).agg(F.greatest(F.lit(1.0), neg.cast("double") / F.greatest(pos, F.lit(1)).cast("double")).alias("weight"))
