"""Model scores from prediction tables: single aggregates and running counts."""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.plans.lineage import materialize
from tablecraft.plans.ordering import running

CLIP = 1e-15


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def confusion_normalized(matrix: DataFrame) -> DataFrame:
    """Share of each actual class (the matrix is small: classes x classes); zero on the diagonal."""
    totals = matrix.groupBy("actual").agg(F.sum("n").alias("_t"))
    share = F.when(F.col("actual") == F.col("predicted"), 0.0).otherwise(F.col("n") / F.col("_t"))
    return matrix.join(totals, "actual").select("actual", "predicted", share.alias("share"))


def error_cells(df: DataFrame, actual: str, predicted: str, a, b) -> DataFrame:
    """The rows of one cell of the confusion matrix."""
    return df.filter((F.col(actual) == a) & (F.col(predicted) == b))


def binary_scores(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Counts and ratios for class 1 against class 0."""
    y, p = F.col(actual) == 1, F.col(predicted) == 1
    counts = df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                    F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "*", F.try_divide(tp, tp + fp).alias("precision"), F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"), F.try_divide(fn, tp + fn).alias("miss_rate"),
        F.try_divide(fp, fp + tn).alias("fpr"), F.try_divide(tn, fp + tn).alias("tnr"),
        F.try_divide(tp + fn, tp + fp + fn + tn).alias("prevalence"))


def accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(F.avg((F.col(actual) == F.col(predicted)).cast("double")).alias("accuracy"))


def _cumulative(df: DataFrame, actual: str, score: str) -> DataFrame:
    """Per distinct score, from high to low: positives and negatives up to and at it."""
    y = F.col(actual) == 1
    cells = materialize(df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(y).alias("_pos"), F.count_if(~y).alias("_neg")))
    seen = running(cells, [], [F.desc("score")], {"tp": ("sum", "_pos"), "fp": ("sum", "_neg")})
    totals = cells.agg(F.struct(F.sum("_pos").alias("p"), F.sum("_neg").alias("n"))).scalar()
    return seen.withColumn("_t", totals)


def pr_curve(df: DataFrame, actual: str, score: str) -> DataFrame:
    rows = _cumulative(df, actual, score)
    return rows.select("score", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                       F.try_divide("tp", "_t.p").alias("recall"))


def roc_curve(df: DataFrame, actual: str, score: str) -> DataFrame:
    rows = _cumulative(df, actual, score)
    return rows.select("score", F.try_divide("fp", "_t.n").alias("fpr"), F.try_divide("tp", "_t.p").alias("tpr"))


def roc_auc(df: DataFrame, actual: str, score: str) -> DataFrame:
    """Exact area under the curve; equal scores count half."""
    rows = _cumulative(df, actual, score)
    strip = F.col("_neg") * (2 * F.col("tp") - F.col("_pos")) / 2.0
    return rows.agg(F.try_divide(F.sum(strip), F.max(F.col("_t.p").cast("double") * F.col("_t.n"))).alias("auc"))


def log_loss(df: DataFrame, actual: str, probability: str) -> DataFrame:
    p = F.least(F.greatest(F.col(probability), F.lit(CLIP)), F.lit(1 - CLIP))
    y = F.col(actual).cast("double")
    return df.agg((-F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"))


def precision_at_k(df: DataFrame, actual: str, score: str, key: str, k: int) -> DataFrame:
    """Share of positives among the k best scores; ties by key."""
    best = df.orderBy(F.desc(score), key).limit(k)
    return best.agg(F.avg((F.col(actual) == 1).cast("double")).alias("precision_at_k"))


def rmsle_of(actual: Column, predicted: Column) -> Column:
    """Root mean squared difference of plain logarithms."""
    gap = F.log(actual) - F.log(predicted)
    return F.sqrt(F.avg(gap * gap))


def regression_scores(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    y, gap = F.col(actual).cast("double"), F.col(actual) - F.col(predicted)
    return df.agg(
        F.avg(gap * gap).alias("mse"), F.sqrt(F.avg(gap * gap)).alias("rmse"), F.avg(F.abs(gap)).alias("mae"),
        F.avg(F.abs(F.try_divide(gap, y))).alias("mape"),
        (1 - F.avg(gap * gap) / F.var_pop(y)).alias("r2"))


class RmsleEvaluator(Evaluator, HasLabelCol, HasPredictionCol):
    """Evaluator for tuning on a log-transformed target: smaller is better."""

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction", logged: bool = True):
        super().__init__()
        self._set(labelCol=labelCol, predictionCol=predictionCol)
        self.logged = logged

    def _evaluate(self, dataset: DataFrame) -> float:
        y, p = F.col(self.getLabelCol()), F.col(self.getPredictionCol())
        if self.logged:
            gap = y - p
            return dataset.agg(F.sqrt(F.avg(gap * gap))).first()[0]
        return dataset.agg(rmsle_of(y, p)).first()[0]

    def isLargerBetter(self) -> bool:
        return False
