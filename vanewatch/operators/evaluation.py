"""Model quality: errors, penalties, classification, gate and scoreboard."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewatch.functions import scalars
from vanewatch.spec import CRITICAL_RUL, GATE, SCOREBOARD

CLASSES = ("Non-Critical", "Critical")


def evaluation_rows(
    df: DataFrame, true: str, pred: str, keys: Sequence[str] = (), critical: float = CRITICAL_RUL
) -> DataFrame:
    """(true_rul, pred_rul, error, abs_error, critical_true, critical_pred)."""
    t, p = F.col(true).cast("double"), F.col(pred).cast("double")
    return df.select(
        *keys,
        t.alias("true_rul"),
        p.alias("pred_rul"),
        (p - t).alias("error"),
        F.abs(p - t).alias("abs_error"),
        scalars.is_critical(t, critical).alias("critical_true"),
        scalars.is_critical(p, critical).alias("critical_pred"),
    )


def rmse(error: Column | str = "error") -> Column:
    error = F.col(error) if isinstance(error, str) else error
    return F.sqrt(F.avg(error * error))


def penalty_score(error: Column | str = "error") -> Column:
    return F.sum(scalars.penalty(error))


def confusion_columns(true: str = "critical_true", pred: str = "critical_pred") -> list[Column]:
    t, p = F.col(true), F.col(pred)
    return [
        F.count_if(~t & ~p).alias("tn"),
        F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"),
        F.count_if(t & p).alias("tp"),
    ]


def confusion(results: DataFrame, true: str = "critical_true", pred: str = "critical_pred") -> DataFrame:
    """Four rows (actual, predicted, n), empty cells included."""
    counts = results.agg(*confusion_columns(true, pred))
    cells = [("tn", False, False), ("fp", False, True), ("fn", True, False), ("tp", True, True)]
    entry = [
        F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(c).alias("n")) for c, a, b in cells
    ]
    return counts.select(F.inline(F.array(*entry)))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)


def _class_measures(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return {
        "precision": precision,
        "recall": recall,
        "f1_score": _ratio(2.0 * precision * recall, precision + recall),
        "support": (tp + fn).cast("double"),
    }


def report_structs() -> dict[str, Column]:
    """Report lines as structs over the columns tn, fp, fn, tp."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    classes = {CLASSES[0]: _class_measures(tn, fn, fp), CLASSES[1]: _class_measures(tp, fp, fn)}
    total = (tn + fp + fn + tp).cast("double")

    def struct(measures: Mapping[str, Column]) -> Column:
        return F.struct(*[c.alias(name) for name, c in measures.items()])

    lines = {name: struct(m) for name, m in classes.items()}
    accuracy = _ratio(tn + tp, total)
    lines["accuracy"] = struct(
        {"precision": accuracy, "recall": accuracy, "f1_score": accuracy, "support": total}
    )
    a, b = classes.values()
    names = ("precision", "recall", "f1_score")
    lines["macro avg"] = struct({**{n: (a[n] + b[n]) / 2 for n in names}, "support": total})
    lines["weighted avg"] = struct(
        {**{n: _ratio(a[n] * a["support"] + b[n] * b["support"], total) for n in names}, "support": total}
    )
    return lines


def classification_report(
    results: DataFrame, true: str = "critical_true", pred: str = "critical_pred"
) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted averages.

    A class without rows gets zeros.
    """
    lines = report_structs()
    entry = [F.struct(F.lit(name).alias("label"), line.alias("m")) for name, line in lines.items()]
    counts = results.agg(*confusion_columns(true, pred))
    return counts.select(F.inline(F.array(*entry))).select("label", "m.*")


def metrics(results: DataFrame) -> DataFrame:
    """One row with every headline number, from a single pass over the results."""
    sums = results.agg(
        rmse().alias("rmse"), penalty_score().alias("penalty_score"), *confusion_columns()
    )
    lines = report_structs()
    return sums.select(
        "rmse",
        "penalty_score",
        lines["Critical"]["precision"].alias("precision_critical"),
        lines["Critical"]["recall"].alias("recall_critical"),
        lines["Critical"]["f1_score"].alias("f1_critical"),
        lines["accuracy"]["f1_score"].alias("accuracy"),
        lines["weighted avg"]["f1_score"].alias("f1_weighted"),
    )


def summary(one: DataFrame) -> DataFrame:
    """Rounded metrics for display; missing ones show as zero."""
    places = {"rmse": 2, "penalty_score": 1}
    return one.select(
        *[
            F.bround(F.coalesce(F.col(name), F.lit(0.0)), places.get(name, 3)).alias(name)
            for name, _, _ in SCOREBOARD
        ]
    )


def scoreboard(one: DataFrame) -> DataFrame:
    """(metric, value, comparison, target, ok) for each metric."""
    entry = []
    for name, comparison, target in SCOREBOARD:
        ok = F.col(name) < target if comparison == "<" else F.col(name) > target
        entry.append(
            F.struct(
                F.lit(name).alias("metric"),
                F.col(name).alias("value"),
                F.lit(comparison).alias("comparison"),
                F.lit(target).alias("target"),
                ok.alias("ok"),
            )
        )
    return one.select(F.inline(F.array(*entry)))


def gate(one: DataFrame, limits: Mapping[str, float] = GATE) -> DataFrame:
    """Whether the model may be promoted: every limited metric is at or below its limit."""
    passed = F.lit(True)
    for name, limit in limits.items():
        passed = passed & (F.col(name) <= limit)
    return one.select(*limits, F.coalesce(passed, F.lit(False)).alias("promote"))


def error_by_bucket(results: DataFrame) -> DataFrame:
    """Mean absolute error (2 decimals) and count per non-empty life bucket."""
    return (
        results.withColumn("bucket", scalars.rul_bucket("true_rul"))
        .where(F.col("bucket").isNotNull())
        .groupBy("bucket")
        .agg(F.bround(F.avg("abs_error"), 2).alias("mean"), F.count(F.lit(1)).alias("count"))
    )
