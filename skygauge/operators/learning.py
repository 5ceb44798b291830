"""Preparing, splitting, fitting and scoring on tables with spark.ml."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skygauge.functions.rules import decide, flood_score_linear, heat_score_linear, risk_level
from skygauge.operators.blocks import block_window, own_rows, with_lookback
from skygauge.operators.ordered import positions
from skygauge.operators.serving import latest_model
from skygauge.schemas import FEATURE_COLUMNS, NOT_INPUTS
from skygauge.sources.zones import replace_partitions
from skygauge.store import read_if_present


def select_features(df: DataFrame, wanted=None) -> DataFrame:
    """The columns of the model input table that exist, in its order."""
    return df.select(*[c for c in wanted or FEATURE_COLUMNS if c in df.columns])


def input_columns(df: DataFrame, excluded=None) -> list:
    """Numeric columns that may enter a model."""
    numeric = {"double", "float", "bigint", "int", "smallint", "tinyint"}
    return [n for n, t in df.dtypes if t in numeric and n not in (NOT_INPUTS if excluded is None else excluded)]


def _finite(name: str, otherwise: float) -> Column:
    c = F.col(name).cast("double")
    inf = float("inf")
    return F.when(c.isNull() | F.isnan(c) | (c == inf) | (c == -inf), otherwise).otherwise(c)


def _steps(df, inputs, first, last, steps, extra=()):
    rows = df.select("District", "Date", *extra, F.array(*[_finite(c, 0.0) for c in inputs]).alias("_step"))
    frame = block_window().rowsBetween(first, last)
    return own_rows(
        with_lookback(rows, -first, ["_step"])
        .withColumn("sequence", F.collect_list("_step").over(frame))  # at most ``steps`` entries
        .withColumn("sequence", F.when(F.size("sequence") == steps, F.col("sequence")))
    )


def training_sequences(df: DataFrame, inputs: list, target: str, timesteps=14) -> DataFrame:
    """The ``timesteps`` rows before each row with that row's label; shorter histories give none."""
    seq = _steps(df, inputs, -timesteps, -1, timesteps, [target])
    return seq.filter(F.col("sequence").isNotNull()).select("District", "Date", "sequence", F.col(target).cast("bigint").alias("label"))


def scoring_sequences(df: DataFrame, inputs: list, timesteps=14, align="reference") -> DataFrame:
    """The latest ``timesteps`` rows per row, null without enough history.

    ``align="reference"`` includes the row itself; ``"next_day"`` ends one row earlier, as in training.
    """
    last = {"reference": 0, "next_day": -1}[align]
    return _steps(df, inputs, last + 1 - timesteps, last, timesteps).select("District", "Date", "sequence")


def score_by_rule(df: DataFrame) -> DataFrame:
    """Linear rule scores as predictions, one row per target: used when no model is found."""
    heat = heat_score_linear(F.col("MaxTemp_2m"))
    flood = flood_score_linear(F.col("Precip"), F.col("RH_2m"))
    rows = F.array(*[
        F.struct(F.lit(target).alias("target"), p.alias("probability"), risk_level(p).alias("risk"))
        for target, p in (("heatwave", heat), ("flood_proxy", flood))
    ])
    return df.select("*", F.inline(rows)).withColumn("model", F.lit("rule")).withColumn("status", F.lit("fallback"))


def align(predictions: DataFrame, labels: DataFrame, target: str, threshold=0.5) -> DataFrame:
    """Predictions next to the actual labels."""
    actual = labels.select("District", "Date", F.col(target).cast("bigint").alias("y_true"))
    return predictions.join(actual, ["District", "Date"]).select(
        "Date", "District", "y_true", F.col("probability").alias("y_pred"), decide(F.col("probability"), threshold).alias("prediction"))


def hash_split(df: DataFrame, key=("District", "Date"), train_share=80, seed=42) -> DataFrame:
    """Tag rows train/test by a hash of their key: the same row always lands on the same side,
    however the data is partitioned."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    return df.withColumn("split", F.when(bucket < train_share, "train").otherwise("test"))


def positional_split(df: DataFrame, order=("District", "Date"), train_share=0.8) -> DataFrame:
    """Tag the first ``train_share`` of the rows in total order as train, the rest as test."""
    cut = F.floor(df.agg(F.count(F.lit(1))).scalar() * F.lit(train_share))
    numbered = positions(df, list(order), "_n")
    return numbered.withColumn("split", F.when(F.col("_n") <= cut, "train").otherwise("test")).drop("_n")


def standardize(df: DataFrame, train: DataFrame, columns: list) -> DataFrame:
    """(x - mean) / sigma with the population sigma of ``train``; a constant column divides by 1."""
    fitted = train.agg(F.struct(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("sigma")).alias(c) for c in columns
    ]).alias("s")).scalar()

    def scaled(c):
        sigma = fitted[c]["sigma"]
        return (F.col(c) - fitted[c]["mean"]) / F.when(sigma == 0, 1.0).otherwise(sigma)
    return df.withColumns({c: scaled(c) for c in columns})


def weighted(df: DataFrame, target: str) -> DataFrame:
    """Add ``weight``: negatives per positive (at least 1) for positives, 1 for negatives."""
    pos, neg = F.count_if(F.col(target) == 1), F.count_if(F.col(target) == 0)
    w = df.agg(F.greatest(F.lit(1.0), neg / F.greatest(pos, F.lit(1))).alias("w")).scalar()
    return df.withColumn("weight", F.when(F.col(target) == 1, w).otherwise(1.0))


# Defaults of the boosted trees.
TREES = {"maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8, "maxIter": 1000}


def _filled(df, inputs, value):
    return df.withColumns({c: _finite(c, value) for c in inputs})


def fit_trees(train: DataFrame, inputs: list, target: str, seed=42, **params) -> PipelineModel:
    """Weighted boosted trees. A tenth of the rows, by hash, decides when to stop."""
    held_out = hash_split(weighted(_filled(train, inputs, -999.0), target), train_share=90, seed=seed)
    rows = held_out.withColumn("held_out", F.col("split") == "test").withColumn("label", F.col(target).cast("double"))
    trees = GBTClassifier(
        labelCol="label", featuresCol="features", weightCol="weight", validationIndicatorCol="held_out", seed=seed, **{**TREES, **params})
    return Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="features"), trees]).fit(rows)


def step_scales(sequences: DataFrame) -> list:
    """(mean, population sigma) of each feature over all (row, step) pairs; a constant feature divides by 1."""
    width = sequences.select(F.size(F.element_at("sequence", 1))).first()
    if width is None:
        raise ValueError("no sequence to fit on")
    steps = sequences.select(F.explode("sequence").alias("s"))
    found = steps.agg(*[f(F.col("s")[i]) for i in range(width[0]) for f in (F.avg, F.stddev_pop)]).first()
    return [(found[2 * i], found[2 * i + 1] or 1.0) for i in range(width[0])]


def scaled_sequences(df: DataFrame, scales: list) -> DataFrame:
    """Scale every step of ``sequence``; null stays null."""
    mean, sigma = (F.array(*[F.lit(float(x[k])) for x in scales]) for k in (0, 1))
    scaled = F.transform("sequence", lambda step: F.transform(step, lambda x, i: (x - F.get(mean, i)) / F.get(sigma, i)))
    return df.withColumn("sequence", scaled)


def fit_sequences(train: DataFrame, seed=42, max_iter=50, hidden: list | None = None) -> tuple[PipelineModel, list]:
    """Classifier over flattened sequences: logistic regression, or a perceptron with ``hidden`` layers.

    Returns the model and the scales of the features, which scoring needs too.
    """
    scales = step_scales(train)
    rows = flat_sequences(scaled_sequences(train, scales)).withColumn("label", F.col("label").cast("double"))
    if hidden:
        size = rows.select(F.size("steps")).first()[0]
        last = MultilayerPerceptronClassifier(featuresCol="flat", labelCol="label", layers=[size, *hidden, 2], maxIter=max_iter, seed=seed)
    else:
        rows = weighted(rows, "label")
        last = LogisticRegression(featuresCol="flat", labelCol="label", weightCol="weight", maxIter=max_iter)
    return Pipeline(stages=[last]).fit(rows), scales


def flat_sequences(df: DataFrame) -> DataFrame:
    """Add the sequence as one flat array ``steps`` and as a vector ``flat``; rows without one are dropped."""
    return df.filter(F.col("sequence").isNotNull()).withColumn("steps", F.flatten("sequence")).withColumn("flat", array_to_vector("steps"))


def score(model: PipelineModel, df: DataFrame, name: str, target: str, inputs: list | None = None) -> DataFrame:
    """Add probability, risk, model and target to every row; all other columns are kept."""
    rows = df if inputs is None else df.withColumns({f"_in_{c}": F.col(c) for c in inputs}).transform(_filled, inputs, -999.0)
    out = model.transform(rows).withColumn("probability", vector_to_array("probability")[1])
    if inputs is not None:
        out = out.withColumns({c: F.col(f"_in_{c}") for c in inputs}).drop(*[f"_in_{c}" for c in inputs])
    return out.drop("rawPrediction", "prediction", "features", "flat", "steps").withColumns({
        "risk": risk_level(F.col("probability")), "model": F.lit(name), "target": F.lit(target)})


def score_sequences(model: PipelineModel, df: DataFrame, name: str, target: str, inputs: list, scales: list, timesteps=14) -> DataFrame:
    """Add probability, risk, model and target to every row from the ``timesteps`` rows that end with it.

    Rows with a shorter history stay and get probability 0.
    """
    windows = flat_sequences(scaled_sequences(scoring_sequences(df, inputs, timesteps), scales))
    found = model.transform(windows).select("District", "Date", vector_to_array("probability")[1].alias("probability"))
    return df.drop("probability").join(found, ["District", "Date"], "left").withColumn("probability", F.coalesce("probability", F.lit(0.0))).withColumns({
        "risk": risk_level(F.col("probability")), "model": F.lit(name), "target": F.lit(target)})


REGISTRY = """model string, target string, path string, saved_at timestamp_ntz, kind string, features array<string>, timesteps int,
  scales array<struct<mean:double,sigma:double>>, params map<string,string>, metrics map<string,double>"""


def save_model(model: PipelineModel, root: str, name: str, target: str, saved_at, features=(), params=None, metrics=None, scales=None, timesteps=14) -> str:
    """Save the model and append its registry row; returns the model's path. ``scales`` marks a sequence model."""
    spark = SparkSession.active()
    path = f"{root}/models/{name}_{target}/{saved_at:%Y%m%dT%H%M%S%f}"
    model.write().overwrite().save(path)
    kind = "trees" if scales is None else "sequence"
    row = (name, target, path, saved_at, kind, list(features), timesteps if scales else None, scales, {k: str(v) for k, v in (params or {}).items()}, dict(metrics or {}))
    spark.createDataFrame([row], REGISTRY).coalesce(1).write.mode("append").parquet(f"{root}/registry")
    return path


class Saved:
    """A registered model and what it needs to score."""

    def __init__(self, row):
        self.row, self.model = row, PipelineModel.load(row.path)

    def score(self, df: DataFrame) -> DataFrame:
        r = self.row
        if r.kind == "sequence":
            return score_sequences(self.model, df, r.model, r.target, list(r.features), list(r.scales), r.timesteps)
        return score(self.model, df, r.model, r.target, list(r.features))


def load_latest(spark: SparkSession, root: str, name: str, target: str) -> Saved | None:
    """The newest saved model, or None."""
    registry = read_if_present(spark, f"{root}/registry")
    if registry is None:
        return None
    row = latest_model(registry.filter((F.col("model") == name) & (F.col("target") == target))).first()
    return Saved(row) if row else None


def score_all(df: DataFrame, root: str, specs: list, path: str) -> list:
    """Score every (model, target) with its registered model; rules stand in, once per target, for missing ones.

    Writes the table at ``path``, one partition per (model, target), with the status of each row. A combination
    that fails does not stop the others, but the run then raises: a registered model that can't score is never
    passed over. Returns (model, target, status).
    """
    spark, report, ruled = df.sparkSession, [], set()
    for name, target in specs:
        try:
            saved = load_latest(spark, root, name, target)
            if saved:
                rows, status = saved.score(df), "success"
            else:
                rows, status = score_by_rule(df).filter(F.col("target") == target), "fallback"
            if saved or target not in ruled:
                kept = rows.select("District", "Date", "probability", "risk", "model", "target", F.lit(status).alias("status"))
                replace_partitions(kept, path, ["model", "target"])
            if not saved:
                ruled.add(target)
        except Exception as err:  # the other combinations are scored first
            status = f"failed: {type(err).__name__}: {err}"
        report.append((name, target, status))
    failed = [r for r in report if r[2].startswith("failed")]
    if failed:
        raise RuntimeError(f"models that did not score: {failed}")
    return report
