"""Delay-risk model: split, imputation, balanced logistic regression and its readout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bayline.functions.flags import band
from bayline.functions.hashing import hash_uniform
from bayline.operators.ordering import by_magnitude
from bayline.operators.quantiles import median_of, rank_sums, scalar_row
from bayline.session import scratch_dir

# fixed values: risk bands, right-closed
RISK_EDGES = (-0.01, 0.30, 0.60, 1.00)
RISK_LABELS = ("Low Risk", "Medium Risk", "High Risk")
MAX_ITERATIONS = 1000
TEST_SHARE = 0.20


def risk_band(probability: Column) -> Column:
    return band(probability, RISK_EDGES, RISK_LABELS)


def stratified_split(
    df: DataFrame, key: str, label: str, test: float = TEST_SHARE, salt: str = "split"
) -> DataFrame:
    """Add ``is_test``: the same share of every class, by a hash of the key.

    The hash is independent of the label, so each class is cut at the same point and the
    shares hold in expectation without any shuffle. Rows without a label are left out.
    """
    return df.filter(F.col(label).isNotNull()).withColumn(
        "is_test", hash_uniform(F.col(key), salt) < F.lit(test)
    )


def median_imputer(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Medians of the training rows, one row."""
    return median_of(train, cols)


def mode_imputer(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent value per column, the smallest on ties, as rows (column, value)."""
    long = train.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                    for c in cols
                ]
            )
        )
    ).dropna()
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    # min over (-count, value): largest count first, then smallest value
    best = counts.groupBy("column").agg(
        F.min(F.struct((-F.col("n")).alias("order"), F.col("value"))).alias("best")
    )
    return best.select("column", F.col("best.value").alias("value"))


def impute(
    df: DataFrame, train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]
) -> DataFrame:
    """Fill numeric columns by training medians and categorical ones by training modes."""
    modes = mode_imputer(train, categorical).agg(
        *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in categorical]
    )
    return (
        df.withColumn("_medians", scalar_row(median_imputer(train, numeric)))
        .withColumn("_modes", scalar_row(modes))
        .withColumns(
            {
                **{
                    c: F.coalesce(F.col(c).cast("double"), F.col("_medians")[c]) for c in numeric
                },
                **{
                    c: F.coalesce(F.col(c).cast("string"), F.col("_modes")[c])
                    for c in categorical
                },
            }
        )
        .drop("_medians", "_modes")
    )


def one_hot(cols: Sequence[str]) -> list:
    """Indexer and encoder in which every known level has a slot and an unknown one has none.

    The indexer sends an unknown level to one extra index, and the encoder drops the last.
    """
    indexed = [f"{c}_index" for c in cols]
    return [
        StringIndexer(
            inputCols=list(cols),
            outputCols=indexed,
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(inputCols=indexed, outputCols=[f"{c}_vec" for c in cols], dropLast=True),
    ]


def _sql_number(value: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if value is None else f"{float(value)!r}D"


def _sql_text(value: str | None) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column_transformer(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]
) -> SQLTransformer:
    """Impute and scale numeric columns and impute categories, with values of the training rows.

    Medians, modes, means and population deviations come to the driver as one number per
    column and become literals of the stage, so the fitted pipeline holds all it needs.
    """
    medians = median_imputer(train, numeric).first()
    modes = {row["column"]: row["value"] for row in mode_imputer(train, categorical).collect()}
    filled = {
        c: f"coalesce(CAST(`{c}` AS DOUBLE), {_sql_number(medians and medians[c])})"
        for c in numeric
    }
    moments = train.agg(
        *[F.avg(F.expr(sql)).alias(f"mean_{c}") for c, sql in filled.items()],
        *[F.stddev_pop(F.expr(sql)).alias(f"sd_{c}") for c, sql in filled.items()],
    ).first()
    columns = [
        f"({sql} - {_sql_number(moments[f'mean_{c}'])}) / "
        f"{_sql_number(moments[f'sd_{c}'] or 1.0)} AS `{c}_scaled`"
        for c, sql in filled.items()
    ]
    columns += [
        f"coalesce(CAST(`{c}` AS STRING), {_sql_text(modes.get(c))}) AS `{c}_filled`"
        for c in categorical
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")


def feature_pipeline(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]
) -> list:
    """Stages from raw columns to one vector: numeric block first, then the encoded levels."""
    filled = [f"{c}_filled" for c in categorical]
    return [
        column_transformer(train, numeric, categorical),
        *one_hot(filled),
        VectorAssembler(
            inputCols=[*[f"{c}_scaled" for c in numeric], *[f"{c}_vec" for c in filled]],
            outputCol="features",
        ),
    ]


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Add the weight n / (2 n_class) of each row's class."""
    counts = scalar_row(
        df.agg(
            F.count(label).cast("double").alias("n"),
            F.count_if(F.col(label) == 1).cast("double").alias("n1"),
        )
    )
    mine = F.when(F.col(label) == 1, F.col("_c.n1")).otherwise(F.col("_c.n") - F.col("_c.n1"))
    return (
        df.withColumn("_c", counts)
        .withColumn("weight", F.try_divide(F.col("_c.n"), F.lit(2.0) * mine))
        .drop("_c")
    )


def fit_logit(
    train: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    penalty: float = 1.0,
) -> PipelineModel:
    """Balanced logistic regression with an L2 penalty of ``penalty``/n on the mean loss."""
    weighted = balanced_weights(train, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        logit = LogisticRegression(
            labelCol=label,
            weightCol="weight",
            featuresCol="features",
            regParam=penalty / weighted.count(),
            elasticNetParam=0.0,
            standardization=False,
            maxIter=MAX_ITERATIONS,
        )
        stages = [*feature_pipeline(weighted, numeric, categorical), logit]
        return without_summary(Pipeline(stages=stages).fit(weighted), train.sparkSession)
    finally:
        weighted.unpersist()


def without_summary(model: PipelineModel, spark: SparkSession) -> PipelineModel:
    """The model as it is after saving and loading: what it knows of its training rows is gone.

    A training summary holds on to the session, which cannot be shipped to tasks once the session has
    seen an ``Observation``; scoring would fail from then on.
    """
    path = scratch_dir(spark, "fitted")
    model.write().save(path)
    return PipelineModel.load(path)


def optimum(model: PipelineModel, train: DataFrame, label: str, penalty: float = 1.0) -> DataFrame:
    """How well the fit solves its problem on the rows it was fitted on, one row.

    Gives the rows, the weight of each class, the weighted mean probability, which an
    unpenalised intercept brings to the weighted rate, and the norm of the penalised gradient.
    """
    p, y, w = F.col("_p"), F.col(label), F.col("weight")
    rows = model.transform(balanced_weights(train, label)).select(
        label, "weight", "features", vector_to_array("probability")[1].alias("_p")
    )
    sums = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(w * (1 - y)).alias("weight_0"),
        F.sum(w * y).alias("weight_1"),
        F.sum(w * p).alias("_expected"),
        vector_to_array(Summarizer.mean(F.col("features"), w * p)).alias("_x_expected"),
        vector_to_array(Summarizer.mean(F.col("features"), w * y)).alias("_x_actual"),
    )
    n = F.col("rows")
    fitted = F.array(*[F.lit(float(c)) for c in model.stages[-1].coefficients])
    pull = F.zip_with(
        "_x_expected",
        "_x_actual",
        lambda e, a: (F.col("_expected") * e - F.col("weight_1") * a) / n,
    )
    gradient = F.zip_with(pull, fitted, lambda g, c: g + F.lit(penalty) * c / n)
    norm = F.sqrt(F.aggregate(gradient, F.lit(0.0), lambda total, g: total + g * g))
    return sums.select(
        "rows",
        "weight_0",
        "weight_1",
        (F.col("_expected") / n).alias("weighted_probability"),
        norm.alias("gradient_norm"),
    )


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add the probability of a delay and the predicted class."""
    scored = model.transform(df)
    return scored.select(
        *df.columns,
        vector_to_array("probability")[1].alias("delay_probability"),
        F.col("prediction").cast("int").alias("predicted_delayed"),
    )


def score_and_band(model: PipelineModel, df: DataFrame) -> DataFrame:
    return score(model, df).withColumn("risk_band", risk_band(F.col("delay_probability")))


def coefficients(model: PipelineModel, df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Coefficients by feature name, the largest magnitude first.

    The vector is as long as the number of levels, which the fitted model holds anyway.
    """
    logit = model.stages[-1]
    attrs = model.transform(df).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    rows = []
    for i, value in enumerate(logit.coefficients.toArray()):
        if i < len(numeric):
            name = f"numeric__{numeric[i]}"
        else:
            name = "categorical__" + names[i].replace("_filled_vec_", "_")
        rows.append((name, float(value), abs(float(value))))
    table = df.sparkSession.createDataFrame(
        rows, "feature string, coefficient double, absolute_coefficient double"
    )
    return by_magnitude(table, "coefficient", "feature")


def confusion_counts(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    """True and false positives and negatives, one row."""
    y, p = F.col(actual), F.col(predicted)
    return scored.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


# fixed values: labels of the confusion matrix
CONFUSION_ROWS = ("Actual On-Time", "Actual Delayed")
CONFUSION_COLUMNS = ("Predicted On-Time", "Predicted Delayed")


def confusion(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Labelled 2 x 2 matrix, one row per actual class."""
    counts = confusion_counts(scored, actual, predicted)
    cells = (("tn", "fp"), ("fn", "tp"))
    rows = [
        F.struct(
            F.lit(name).alias("actual"),
            *[F.col(c).alias(label) for c, label in zip(pair, CONFUSION_COLUMNS)],
        )
        for name, pair in zip(CONFUSION_ROWS, cells)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _zero_divide(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def roc_auc(scored: DataFrame, actual: str, probability: str) -> DataFrame:
    """Exact area under the curve from tie-averaged ranks, one row."""
    sums = rank_sums(scored, F.col(actual) == 1, F.col(probability))
    n1, n0 = F.col("n1").cast("double"), F.col("n2").cast("double")
    return sums.select(
        F.try_divide(F.col("rank_sum") - n1 * (n1 + 1) / 2, n1 * n0).alias("roc_auc")
    )


def binary_metrics(
    scored: DataFrame, actual: str, probability: str, predicted: str
) -> DataFrame:
    """ROC-AUC, precision, recall and F1 as rows (metric, value)."""
    auc = roc_auc(scored, actual, probability).scalar()
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    values = {
        "ROC-AUC": F.col("auc"),
        "Precision": _zero_divide(tp, tp + fp),
        "Recall": _zero_divide(tp, tp + fn),
        "F1": _zero_divide(tp * 2, tp * 2 + fp + fn),
    }
    rows = F.array(
        *[F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in values.items()]
    )
    return (
        confusion_counts(scored, actual, predicted).withColumn("auc", auc).select(F.inline(rows))
    )


def class_report(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and two averages."""
    return class_report_of(confusion_counts(scored, actual, predicted))


def class_report_of(counts: DataFrame) -> DataFrame:
    """The same from one row of confusion counts (tn, fp, fn, tp)."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def measures(hit: Column, false_hit: Column, miss: Column) -> Column:
        return F.struct(
            _zero_divide(hit, hit + false_hit).alias("precision"),
            _zero_divide(hit, hit + miss).alias("recall"),
            _zero_divide(hit * 2, hit * 2 + false_hit + miss).alias("f1_score"),
            (hit + miss).cast("double").alias("support"),
        )

    c0, c1 = F.col("c0"), F.col("c1")
    total = c0["support"] + c1["support"]
    accuracy = _zero_divide(tn + tp, tn + fp + fn + tp)
    names = ("precision", "recall", "f1_score")

    def row(label: str, values: Sequence[Column], support: Column) -> Column:
        pairs = zip(names, values, strict=True)
        return F.struct(
            F.lit(label).alias("label"),
            *[v.alias(n) for n, v in pairs],
            support.alias("support"),
        )

    rows = F.array(
        row("0", [c0[n] for n in names], c0["support"]),
        row("1", [c1[n] for n in names], c1["support"]),
        row("accuracy", [F.col("accuracy")] * 3, F.col("accuracy")),
        row("macro avg", [(c0[n] + c1[n]) / 2 for n in names], total),
        row(
            "weighted avg",
            [
                _zero_divide(c0[n] * c0["support"] + c1[n] * c1["support"], total)
                for n in names
            ],
            total,
        ),
    )
    return (
        counts.select(
            measures(tn, fn, fp).alias("c0"),
            measures(tp, fp, fn).alias("c1"),
            accuracy.alias("accuracy"),
        ).select(F.inline(rows))
    )
