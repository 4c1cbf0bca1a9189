"""Delay features, label encoding, exact stratified split, random forest.

The forest (``contrail.operators.forest``) trains distributed on all rows,
label codes are a ranked table that is joined, and the split is exact per
label without sorting the whole table. Models are ``pyspark.ml`` ones.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contrail.functions import timefns
from contrail.operators import forest
from contrail.operators.anomalies import DELAY_STATUSES
from contrail.session import scratch_path

# Fixed values that must equal the reference: encoded columns, model features, prepared columns.
CATEGORICAL = ("airline", "origin_airport", "destination_airport", "aircraft_type", "route",
               "duration_category")
FEATURES = ("airline", "origin_airport", "destination_airport", "aircraft_type", "departure_hour",
            "day_of_week", "flight_duration_minutes", "is_weekend", "is_peak_hour")
LABEL = "is_delayed"
FEATURE_COLUMNS = ("airline", "origin_airport", "destination_airport", "aircraft_type",
                   "departure_hour", "day_of_week", "flight_duration_minutes", "status", "is_delayed",
                   "route", "is_weekend", "is_peak_hour", "duration_category")


def ml_features(flights: DataFrame) -> DataFrame:
    """The prepared-data frame: only flights with a departure and a duration."""
    base = (flights.filter(F.col("scheduled_departure").isNotNull()
                           & F.col("flight_duration_minutes").isNotNull())
            .select("airline", "origin_airport", "destination_airport", "aircraft_type",
                    timefns.departure_hour("scheduled_departure").alias("departure_hour"),
                    timefns.day_of_week_sun0("scheduled_departure").alias("day_of_week"),
                    "flight_duration_minutes", "status",
                    F.col("status").isin(*DELAY_STATUSES).cast("int").alias(LABEL)))
    return base.select(
        *[c for c in base.columns],
        F.concat(F.col("origin_airport"), F.lit("_"), F.col("destination_airport")).alias("route"),
        timefns.is_weekend("day_of_week").alias("is_weekend"),
        timefns.is_peak_hour("departure_hour").alias("is_peak_hour"),
        timefns.duration_category("flight_duration_minutes").alias("duration_category"),
    )


def feature_summary(features: DataFrame) -> DataFrame:
    return features.agg(F.count(F.lit(1)).alias("total_records"),
                        F.avg(LABEL).alias("delay_rate"),
                        F.countDistinct("airline").cast("long").alias("airlines_count"),
                        F.countDistinct("route").cast("long").alias("routes_count"),
                        F.array(*map(F.lit, FEATURE_COLUMNS)).alias("features"))


def _text_of(c: str):
    # the reference encodes ``astype(str)``: a missing category is the text 'nan'
    return F.coalesce(F.col(c).cast("string"), F.lit("nan"))


def _as_text(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: _text_of(c) for c in cols})


def fit_encoders(features: DataFrame, cols=CATEGORICAL) -> DataFrame:
    """(column, value, code): codes 0, 1, ... in sorted order of each column's distinct values.

    One pass finds the distinct values of all columns; they are sorted by
    range partitions and numbered with prefix sums over the partitions'
    counts, so no label list comes to the driver or into one task.
    """
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), _text_of(c).alias("value")) for c in cols)))
    values = features.select(pairs.alias("v")).select("v.*").distinct()
    spark = features.sparkSession
    path = scratch_path(spark, "label-values")
    (values.repartitionByRange("column", "value").withColumn("part", F.spark_partition_id()).write.parquet(path))
    values = spark.read.parquet(path)
    before = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (values.groupBy("column", "part").agg(F.count(F.lit(1)).alias("n"))
              .select("column", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    within = Window.partitionBy("column", "part").orderBy("value")
    return values.join(starts, ["column", "part"]).select(
        "column", "value", (F.col("start") + F.row_number().over(within) - 1).cast("int").alias("code"))


#: Codes a column may have to be sent to all tasks; one with more is joined by its values.
SENT_CODES = 100_000


def _with_code(df: DataFrame, codes: DataFrame, c: str, n: int) -> DataFrame:
    """`df` with the code of column `c`, which has `n` codes, as ``_<c>_code``; null for a value without one.

    Few codes mean few values, each with a large share of the rows: these are never shuffled by the value.
    """
    own = codes.filter(F.col("column") == c).select(F.col("value").alias(f"_{c}"), F.col("code").alias(f"_{c}_code"))
    return df.join(F.broadcast(own) if n <= SENT_CODES else own, _text_of(c) == F.col(f"_{c}"), "left").drop(f"_{c}")


def encode_labels(features: DataFrame, codes: DataFrame | None = None, cols=CATEGORICAL,
                  unseen: int | None = None) -> DataFrame:
    """Replace each categorical column by its integer code; a value without code gets `unseen`."""
    codes = fit_encoders(features, cols) if codes is None else codes
    out, n_codes = features, _code_counts(codes, cols)
    for c in cols:
        out = _with_code(out, codes, c, n_codes[c])
    return out.select(*(F.coalesce(f"_{c}_code", F.lit(unseen).cast("int")).alias(c) if c in cols else F.col(c)
                        for c in features.columns))


def row_key(seed: int = 42):
    """A row's text for the split's order: the feature columns that both engines write alike, and the seed."""
    micros = F.round(F.col("flight_duration_minutes") * 1e6).cast("long")
    return F.concat_ws("|", "airline", "origin_airport", "destination_airport", "aircraft_type",
                       F.col("departure_hour").cast("string"), F.col("day_of_week").cast("string"),
                       micros.cast("string"), "status", F.lit(str(seed)))


def stratified_split(df: DataFrame, label: str = LABEL, train_fraction: float = 0.8, seed: int = 42,
                     buckets: int | None = None, split_col: str = "split", key=None) -> DataFrame:
    """Exact stratified split: per label, round(train_fraction * n) rows go to
    'train', those with the smallest MD5 of their text; the rest go to 'test'.

    No global sort and no single-partition window over the data: rows fall
    into ``buckets`` by their hash; the per-(label, bucket) counts give each
    label's boundary bucket, and only that one bucket is ranked row by row.
    The number of buckets follows the row count, so a bucket holds a few
    thousand rows at any size. Hashed rows and result are written to the
    shared folder once, the result in one folder per part
    (``.filter(split == ...)`` reads only that).
    """
    spark = df.sparkSession
    cols = df.columns
    text = F.concat_ws("|", *(F.col(c).cast("string") for c in cols), F.lit(str(seed))) if key is None else key
    path = scratch_path(spark, "split-rows")
    df.withColumn("_h", F.md5(text)).write.parquet(path)
    hashed = spark.read.parquet(path)
    if buckets is None:
        buckets = max(16, hashed.count() // 2048)
    width = max(1, math.ceil(math.log(buckets, 16)))
    hashed = hashed.withColumn("_b", F.substring("_h", 1, width))
    counts = hashed.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("_n").over(Window.partitionBy(label))
    cum = counts.withColumn("_cum", F.sum("_n").over(w)).withColumn(
        "_target", F.floor(total * F.lit(train_fraction) + F.lit(0.5)).cast("long"))
    # boundary bucket per label: the first bucket whose running count reaches the target
    boundary = (cum.filter((F.col("_cum") >= F.col("_target")) & (F.col("_target") > 0))
                .groupBy(label).agg(F.min_by(F.struct("_b", (F.col("_target") - F.col("_cum") + F.col("_n")).alias("_need")),
                                             F.col("_b")).alias("_bd"))
                .select(F.col(label).alias("_label"), F.col("_bd._b").alias("_bb"), F.col("_bd._need").alias("_need")))
    # labels whose target is 0 have no boundary: everything is test
    # the boundary has one row per label, so it is sent to all tasks: no row is shuffled by its label
    j = hashed.join(F.broadcast(boundary), F.col(label).eqNullSafe(F.col("_label")), "left").drop("_label")
    at_boundary = F.coalesce(F.col("_b") == F.col("_bb"), F.lit(False))
    rw = Window.partitionBy(label, "_b").orderBy("_h", *cols)
    inner = j.filter(at_boundary).withColumn(split_col, F.when(F.row_number().over(rw) <= F.col("_need"), "train")
                                             .otherwise("test"))
    outer = j.filter(~at_boundary).withColumn(split_col, F.when(F.col("_b") < F.col("_bb"), "train").otherwise("test"))
    out = scratch_path(spark, "split")
    inner.unionByName(outer).select(*cols, split_col).write.partitionBy(split_col).parquet(out)
    return spark.read.schema(df.schema.add(split_col, "string")).parquet(out)


#: Categorical columns the forest uses.
MODEL_CATEGORICAL = tuple(c for c in CATEGORICAL if c in FEATURES)


def delay_pipeline(num_trees: int = 100, max_depth: int = 6, seed: int = 42, features=FEATURES) -> Pipeline:
    """Assembler -> random forest over numeric features (categories as codes).

    Codes are used as ordered numbers, as the reference's label encoder does.
    ``max_depth`` goes up to Spark's limit of 30. ``forest.fit`` learns what
    the second stage describes.
    """
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    rf = RandomForestClassifier(labelCol=LABEL, featuresCol="features", numTrees=num_trees, maxDepth=max_depth, seed=seed,
                                featureSubsetStrategy="sqrt")
    return Pipeline(stages=[asm, rf])


class DelayModel:
    """A fitted forest with the codes of its categories (a table; values unseen in training get the next code)."""

    def __init__(self, model: PipelineModel, codes: DataFrame, n_codes: dict[str, int]):
        self.model, self.codes, self.n_codes = model, codes, n_codes

    def transform(self, features: DataFrame) -> DataFrame:
        """`features` with prediction and probability; the categories keep their text."""
        coded = features.withColumn(LABEL, F.col(LABEL).cast("double"))
        for c in MODEL_CATEGORICAL:
            coded = _with_code(coded, self.codes, c, self.n_codes[c]).withColumn(
                f"_{c}_code", F.coalesce(f"_{c}_code", F.lit(self.n_codes[c])))
        keep = [c for c in coded.columns if not c.endswith("_code")]
        renamed = coded.select(*(F.col(c).alias(f"_text_{c}") if c in MODEL_CATEGORICAL else F.col(c) for c in keep),
                               *(F.col(f"_{c}_code").alias(c) for c in MODEL_CATEGORICAL))
        scored = self.model.transform(renamed).drop(*MODEL_CATEGORICAL, "features", "rawPrediction")
        return scored.withColumnsRenamed({f"_text_{c}": c for c in MODEL_CATEGORICAL})

    def save(self, path: str) -> str:
        self.model.write().overwrite().save(f"{path}/model")
        self.codes.write.mode("overwrite").parquet(f"{path}/codes")
        return path

    @classmethod
    def load(cls, spark, path: str) -> "DelayModel":
        codes = spark.read.parquet(f"{path}/codes")
        return cls(PipelineModel.load(f"{path}/model"), codes, _code_counts(codes))


def _code_counts(codes: DataFrame, cols=MODEL_CATEGORICAL) -> dict[str, int]:
    """Codes of each column: one row per column comes to the driver."""
    n = {r["column"]: r["n"] for r in codes.groupBy("column").agg((F.max("code") + 1).alias("n")).collect()}
    return {c: n.get(c, 0) for c in cols}


def train_delay_model(train: DataFrame, max_rows: int = forest.BLOCK_ROWS, **params) -> DelayModel | None:
    """Fit encoders and forest; None when there is nothing to learn from.

    Codes, thresholds and trees come from all rows of ``train``; a task holds
    at most ``max_rows`` of them at once. Every value is a threshold, so no
    two categories share a bin.
    """
    if len(FEATURES) < 3 or train.isEmpty():
        return None
    codes = fit_encoders(train, MODEL_CATEGORICAL)
    spark = train.sparkSession
    path = scratch_path(spark, "label-codes")
    codes.write.parquet(path)
    codes = spark.read.parquet(path)
    rows = encode_labels(train, codes, MODEL_CATEGORICAL).select(*FEATURES, F.col(LABEL).cast("double").alias(LABEL))
    asm, rf = delay_pipeline(**params).getStages()
    return DelayModel(PipelineModel([asm, forest.fit(rf, rows, FEATURES, max_rows)]), codes, _code_counts(codes))


def score_delays(model: DelayModel, test: DataFrame) -> DataFrame:
    return model.transform(_as_text(test, CATEGORICAL))


def feature_importance(model: DelayModel, features=FEATURES) -> DataFrame:
    """(feature, importance, rank): a 9-row frame from the model metadata."""
    imp = model.model.stages[-1].featureImportances.toArray().tolist()
    rows = sorted(zip(features, imp, strict=True), key=lambda kv: (-kv[1], kv[0]))
    return model.codes.sparkSession.createDataFrame([(f, float(v), i + 1) for i, (f, v) in enumerate(rows)],
                                                    "feature string, importance double, rank int")


def model_metrics(predictions: DataFrame, train_count: int, model: DelayModel) -> DataFrame:
    """One row: accuracy, sample counts, the feature list, all importances and the top three."""
    ranked = [(r["feature"], r["importance"]) for r in feature_importance(model).orderBy("rank").collect()]
    pairs = F.array(*(F.struct(F.lit(f).alias("feature"), F.lit(v).alias("importance")) for f, v in ranked))
    return predictions.agg(
        F.avg((F.col("prediction") == F.col(LABEL)).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("test_samples")).select(
        "accuracy", F.lit(train_count).cast("long").alias("training_samples"), "test_samples",
        F.lit(len(FEATURES)).alias("features_used"), F.lit(ranked[0][0]).alias("top_feature"),
        F.lit("RandomForestClassifier").alias("model_type"), F.array(*map(F.lit, FEATURES)).alias("features"),
        pairs.alias("feature_importance"), F.slice(pairs, 1, 3).alias("top_3_features"))


def save_model(model: DelayModel, path: str) -> str:
    return model.save(path)
