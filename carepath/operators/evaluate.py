"""Evaluation as distributed aggregates over a scored table.

Inputs are ordinary DataFrames with a label column and a score (or
prediction) column; nothing is collected except one-row results and, for
the curve operators, per-range totals (see ``carepath.operators.cumulative``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carepath.functions.expressions import threshold_class, zero_safe
from carepath.operators.cumulative import running_sums
from carepath.operators.quantiles import exact_quantile


def _safe_div(a, b):
    return F.when(b == F.lit(0), F.lit(0.0)).otherwise(a / b)


def confusion_counts(df: DataFrame, label: str = "label", score: str = "score",
                     threshold: float = 0.5) -> DataFrame:
    """tp, fp, fn, tn at ``score >= threshold`` in one aggregate."""
    y = F.col(label).cast("int")
    p = threshold_class(score, threshold)
    return df.agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        F.count_if((y == 1) & (p == 1)).cast("long").alias("tp"),
        F.count_if((y == 0) & (p == 1)).cast("long").alias("fp"),
        F.count_if((y == 1) & (p == 0)).cast("long").alias("fn"),
        F.count_if((y == 0) & (p == 0)).cast("long").alias("tn"))


def classification_metrics(df: DataFrame, label: str = "label", score: str = "score",
                           threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class (E1); a 0/0
    ratio is 0, as scikit-learn's default ``zero_division`` reports."""
    c = confusion_counts(df, label, score, threshold)
    tp, fp, fn, tn, n = (F.col(x) for x in ("tp", "fp", "fn", "tn", "n"))
    prec = _safe_div(tp, tp + fp)
    rec = _safe_div(tp, tp + fn)
    return c.select("n", "tp", "fp", "fn", "tn",
                    _safe_div(tp + tn, n).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"),
                    _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1_score"))


def confusion_matrix(df: DataFrame, label: str = "label", score: str = "score",
                     threshold: float = 0.5) -> DataFrame:
    """The 2x2 matrix as four rows ``(label, predicted, n)``, zeros included."""
    c = confusion_counts(df, label, score, threshold)
    cells = F.array(
        F.struct(F.lit(0).alias("label"), F.lit(0).alias("predicted"), F.col("tn").alias("n")),
        F.struct(F.lit(0).alias("label"), F.lit(1).alias("predicted"), F.col("fp").alias("n")),
        F.struct(F.lit(1).alias("label"), F.lit(0).alias("predicted"), F.col("fn").alias("n")),
        F.struct(F.lit(1).alias("label"), F.lit(1).alias("predicted"), F.col("tp").alias("n")))
    return c.select(F.inline(cells))


def classification_report(df: DataFrame, label: str = "label", score: str = "score",
                          threshold: float = 0.5) -> DataFrame:
    """Per-class precision, recall, F1 and support plus macro and weighted
    averages (E2), from the same four counts."""
    c = confusion_counts(df, label, score, threshold)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    rows = []
    for name, t, f_p, f_n, sup in (("0", tn, fn, fp, tn + fp), ("1", tp, fp, fn, tp + fn)):
        p = _safe_div(t, t + f_p)
        r = _safe_div(t, t + f_n)
        rows.append((name, p, r, _safe_div(2 * p * r, p + r), sup))
    n = tp + fp + fn + tn
    macro = [(rows[0][i] + rows[1][i]) / 2 for i in (1, 2, 3)]
    weighted = [_safe_div(rows[0][i] * rows[0][4] + rows[1][i] * rows[1][4], n) for i in (1, 2, 3)]
    structs = [F.struct(F.lit(nm).alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1_score"), s.cast("long").alias("support")) for nm, p, r, f, s in rows]
    structs.append(F.struct(F.lit("macro avg").alias("class"), macro[0].alias("precision"),
                            macro[1].alias("recall"), macro[2].alias("f1_score"), n.alias("support")))
    structs.append(F.struct(F.lit("weighted avg").alias("class"), weighted[0].alias("precision"),
                            weighted[1].alias("recall"), weighted[2].alias("f1_score"), n.alias("support")))
    return c.select(F.inline(F.array(*structs)))


def score_table(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Positives and negatives per distinct score, with running sums in
    ascending score order.  Ties of one score collapse into one row first, so
    a score shared by a third of the rows costs nothing extra."""
    y = F.col(label).cast("int")
    g = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(y == 1).cast("long").alias("pos"),
        F.count_if(y == 0).cast("long").alias("neg"))
    return running_sums(g, "score", ["pos", "neg"])


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve with ties counted as one half (E3): the
    rank-sum statistic, equal to scikit-learn's ``roc_auc_score``."""
    t = score_table(df, label, score)
    part = t.agg(F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") * 0.5)).alias("_s"),
                 F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return part.select(
        F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("_s") / (F.col("P").cast("double") * F.col("N"))).alias("roc_auc"),
        F.col("P").cast("long").alias("n_pos"), F.col("N").cast("long").alias("n_neg"))


def _with_totals(t: DataFrame) -> DataFrame:
    """Rows at or above each threshold: tp/fp from the totals and running sums."""
    P, N = F.col("total_pos"), F.col("total_neg")
    return t.withColumns({"tp": P - F.col("cum_pos") + F.col("pos"),
                          "fp": N - F.col("cum_neg") + F.col("neg"),
                          "P": P, "N": N})


def average_precision(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Step-wise average precision Σ (R_i - R_{i-1}) P_i over descending
    thresholds (E4), as ``average_precision_score`` (no interpolation)."""
    t = _with_totals(score_table(df, label, score))
    return t.agg(F.sum(F.try_divide(F.col("pos"), F.col("P")) * F.col("tp") / (F.col("tp") + F.col("fp")))
                 .alias("average_precision"))


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """False and true positive rates at every distinct threshold (E5): the
    rows with ``score >= threshold`` are called positive."""
    t = _with_totals(score_table(df, label, score))
    return t.select(F.col("score").alias("threshold"),
                    F.try_divide(F.col("fp"), F.col("N")).alias("fpr"),
                    F.try_divide(F.col("tp"), F.col("P")).alias("tpr"))


def pr_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Precision and recall at every distinct threshold, plus the no-skill
    baseline (share of positives) (E6)."""
    t = _with_totals(score_table(df, label, score))
    return t.select(F.col("score").alias("threshold"),
                    (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                    F.try_divide(F.col("tp"), F.col("P")).alias("recall"),
                    F.try_divide(F.col("P"), F.col("P") + F.col("N")).alias("baseline"))


def _regression_sums(y, p, tag: str = "") -> list:
    """The aggregates that the regression metrics of one prediction need."""
    return [F.count(F.lit(1)).alias(f"n{tag}"),
            F.avg((y - p) * (y - p)).alias(f"_mse{tag}"),
            F.avg(F.abs(y - p)).alias(f"mae{tag}"),
            F.sum((y - p) * (y - p)).alias(f"_sse{tag}"),
            F.var_pop(y).alias(f"_var{tag}"),
            F.avg(F.abs((y - p) / zero_safe(y))).alias(f"_mape{tag}"),
            F.count_if(y == 0).alias(f"n_zero_actuals{tag}")]


def _regression_columns(tag: str = "") -> list:
    n, var, sse = F.col(f"n{tag}"), F.col(f"_var{tag}"), F.col(f"_sse{tag}")
    return [n.cast("long").alias("n"), F.sqrt(f"_mse{tag}").alias("rmse"), F.col(f"mae{tag}").alias("mae"),
            # a constant label: 1.0 for a perfect fit, else 0.0 (finite convention)
            F.when(var * n == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
             .otherwise(F.lit(1.0) - sse / (var * n)).alias("r2"),
            (F.col(f"_mape{tag}") * 100).alias("mape"),
            F.col(f"n_zero_actuals{tag}").cast("long").alias("n_zero_actuals")]


def scores_by_model(df: DataFrame, scores: dict[str, str], label: str = "label") -> DataFrame:
    """Long form (model, label, score) of several score columns of the same rows (model name -> column)."""
    rows = [F.struct(F.lit(name).alias("model"), F.col(c).cast("double").alias("score")) for name, c in scores.items()]
    return df.select(F.col(label).cast("int").alias("label"), F.inline(F.array(*rows)))


def score_table_by_model(df: DataFrame) -> DataFrame:
    """``score_table`` of every model of a long table (model, label, score), in one pass."""
    g = df.groupBy("model", "score").agg(F.count_if(F.col("label") == 1).cast("long").alias("pos"),
                                         F.count_if(F.col("label") == 0).cast("long").alias("neg"))
    return running_sums(g, "score", ["pos", "neg"], by="model")


def roc_points_by_model(df: DataFrame) -> DataFrame:
    """E5 of every model of a long table (model, label, score)."""
    t = _with_totals(score_table_by_model(df))
    return t.select("model", F.col("score").alias("threshold"), F.try_divide(F.col("fp"), F.col("N")).alias("fpr"),
                    F.try_divide(F.col("tp"), F.col("P")).alias("tpr"))


def pr_points_by_model(df: DataFrame) -> DataFrame:
    """E6 of every model of a long table (model, label, score)."""
    t = _with_totals(score_table_by_model(df))
    return t.select("model", F.col("score").alias("threshold"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                    F.try_divide(F.col("tp"), F.col("P")).alias("recall"), F.try_divide(F.col("P"), F.col("P") + F.col("N")).alias("baseline"))


def curve_areas_by_model(df: DataFrame) -> DataFrame:
    """E3 and E4 of every model of a long table: (model, roc_auc, average_precision)."""
    t = _with_totals(score_table_by_model(df))
    rank_sum = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") * 0.5))
    P, N = F.max("P"), F.max("N")
    return t.groupBy("model").agg(
        F.when((P > 0) & (N > 0), rank_sum / (P.cast("double") * N)).alias("roc_auc"),
        F.sum(F.try_divide(F.col("pos"), F.col("P")) * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("average_precision"))


def classification_metrics_by_model(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """E1, E3 and E4 of every model of a long table (model, label, score), a row each."""
    y, p = F.col("label"), threshold_class("score", threshold)
    c = df.groupBy("model").agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        *[F.count_if((y == a) & (p == b)).cast("long").alias(name) for name, a, b in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))])
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    c = c.select("model", "n", "tp", "fp", "fn", "tn", _safe_div(tp + tn, F.col("n")).alias("accuracy"), _safe_div(tp, tp + fp).alias("precision"),
                 _safe_div(tp, tp + fn).alias("recall"), _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1_score"))
    return c.join(curve_areas_by_model(df), "model", "left")


def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """RMSE, MAE, R² and MAPE ×100 with zero actuals replaced by 1e-10 (E7,
    X14), plus how many actuals were zero.  One aggregate."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    return df.agg(*_regression_sums(y, p)).select(*_regression_columns())


def regression_metrics_by_model(df: DataFrame, actual: str, predicted: dict[str, str]) -> DataFrame:
    """E7 for several predictions of the same rows (model name -> column), a
    row per model, from one aggregate over one scan."""
    y = F.col(actual).cast("double")
    sums = df.agg(*[a for i, c in enumerate(predicted.values()) for a in _regression_sums(y, F.col(c).cast("double"), f"_{i}")])
    rows = [F.struct(F.lit(name).alias("model_name"), *_regression_columns(f"_{i}")) for i, name in enumerate(predicted)]
    return sums.select(F.inline(F.array(*rows)))


def quantile_coverage(df: DataFrame, actual: str, quantile_cols: dict[str, str]) -> DataFrame:
    """Share of rows with ``actual <= prediction`` for every quantile column
    except q50 (E8).  ``quantile_cols`` maps names like 'q90' to columns."""
    y = F.col(actual)
    return df.agg(*[F.avg((y <= F.col(c)).cast("double")).alias(f"{q}_coverage")
                    for q, c in quantile_cols.items() if q != "q50"])


def residuals(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
              keys: list[str] | None = None) -> DataFrame:
    """Residual ``actual - predicted`` beside the prediction."""
    return df.select(*(keys or []), F.col(actual).alias("actual"), F.col(predicted).alias("predicted"),
                     (F.col(actual) - F.col(predicted)).alias("residual"))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Counts in ``bins`` equal-width bins from min to max, the last bin
    closed, empty bins kept (E10).  A constant column uses ``value ± 0.5``
    like NumPy."""
    st = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = st["lo"], st["hi"]
    if lo is None:
        return df.sparkSession.range(0).select(
            F.lit(0).alias("bin"), F.lit(0.0).alias("lower"), F.lit(0.0).alias("upper"),
            F.lit(0).cast("long").alias("n"))
    lo, hi = float(lo), float(hi)
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    b = F.least(F.lit(bins - 1), F.floor((F.col(col) - F.lit(lo)) / F.lit(width)).cast("int"))
    counts = df.filter(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).cast("long").alias("n"))
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (edges.join(F.broadcast(counts), "bin", "left")
                 .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
                         (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
                         F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))


def prediction_range(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Common axis range of actual and predicted values."""
    return df.agg(F.least(F.min(actual), F.min(predicted)).cast("double").alias("range_min"),
                  F.greatest(F.max(actual), F.max(predicted)).cast("double").alias("range_max"))


def median(df: DataFrame, col: str):
    """Exact (interpolated) median as a literal: the same method at every size."""
    return F.lit(exact_quantile(df, col, 0.5)).cast("double")


def prediction_summary(df: DataFrame, predicted: str, model_name: str, target: str) -> DataFrame:
    """Mean, median, min, max and total of a prediction column."""
    return df.agg(F.lit(model_name).alias("model_name"), F.lit(target).alias("target"),
                  F.avg(predicted).alias("mean_prediction"),
                  median(df, predicted).alias("median_prediction"),
                  F.min(predicted).alias("min_prediction"),
                  F.max(predicted).alias("max_prediction"),
                  F.sum(predicted).alias("total_resource_needs"))


def capacity_summary(df: DataFrame, quantile_cols: dict[str, str], model_name: str, target: str) -> DataFrame:
    """Summary of a quantile model set (R7): the q50 column (else the first)
    gives the headline figures; every quantile adds its mean and total, and
    quantiles of 0.75 and above add ``<q>_capacity_need`` = total."""
    head_q = "q50" if "q50" in quantile_cols else next(iter(quantile_cols))
    head = quantile_cols[head_q]
    aggs = [F.lit(f"{model_name} ({head_q})").alias("model_name"), F.lit(target).alias("target"),
            F.avg(head).alias("mean_prediction"), median(df, head).alias("median_prediction"),
            F.min(head).alias("min_prediction"), F.max(head).alias("max_prediction"),
            F.sum(head).alias("total_resource_needs")]
    for q, c in quantile_cols.items():
        aggs += [F.avg(c).alias(f"{q}_mean"), F.sum(c).alias(f"{q}_total")]
        if float(q[1:]) / 100 >= 0.75:
            aggs.append(F.sum(c).alias(f"{q}_capacity_need"))
    return df.agg(*aggs)


def ranked_models(rows: DataFrame, metric: str, order: list[str]) -> DataFrame:
    """E12 + O3 for a table with a row per model: best first; ``rank`` keeps
    ``order`` among equal metrics, so the first model wins ties (O4)."""
    place = F.array_position(F.array(*[F.lit(n) for n in order]), F.col("model_name"))
    # A window without partition is fine here: one row per model.
    return rows.withColumn("rank", F.row_number().over(Window.orderBy(F.desc_nulls_last(metric), place)))


def model_comparison(metric_rows: list[DataFrame], metric: str) -> DataFrame:
    """E12 + O3: one row per model (union by name of one-row metric tables),
    best first.  ``rank`` keeps the input order among equal metrics, so the
    first model wins ties (O4)."""
    out = None
    for i, m in enumerate(metric_rows):
        m = m.withColumn("_pos", F.lit(i))
        out = m if out is None else out.unionByName(m, allowMissingColumns=True)
    # A window without partition is fine here: one row per model.
    w = Window.orderBy(F.desc_nulls_last(metric), F.asc("_pos"))
    return out.withColumn("rank", F.row_number().over(w)).drop("_pos")


def best_model(comparison: DataFrame, metric: str) -> str:
    """Name of the model with the best ``metric`` (first on ties)."""
    row = comparison.filter(F.col("rank") == 1).select("model_name").first()
    return row["model_name"] if row else None
