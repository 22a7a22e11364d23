"""Validation V1-V10: labels and predictions are columns on the same row, so
every metric is one aggregate; nothing is aligned by position."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import DEFAULT_SERIES, Series
from .windows import DEFAULT_LAYOUT, Layout


def _b(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("int"), F.lit(0)) == 1


def confusion_aggs(y: str, yhat: str) -> list[Column]:
    """V1: tp, fp, fn, tn (always present, zero when a class is absent)."""
    t, p = _b(y), _b(yhat)
    return [F.count_if(t & p).alias("true_positives"), F.count_if(~t & p).alias("false_positives"),
            F.count_if(t & ~p).alias("false_negatives"), F.count_if(~t & ~p).alias("true_negatives")]


def metric_cols() -> dict[str, Column]:
    """V2 from confusion counts; zero_division = 0."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in
                      ("true_positives", "false_positives", "false_negatives", "true_negatives"))
    prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    return {"precision": prec, "recall": rec,
            "f1_score": F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0)),
            "accuracy": F.coalesce(F.try_divide(tp + tn, tp + tn + fp + fn), F.lit(0.0))}


def confusion(df: DataFrame, y: str = "is_anomaly", yhat: str = "ensemble") -> DataFrame:
    return df.agg(*confusion_aggs(y, yhat))


def prf(df: DataFrame, y: str = "is_anomaly", yhat: str = "ensemble") -> DataFrame:
    """V2: precision, recall, F1, accuracy (+ the confusion counts)."""
    return confusion(df, y, yhat).withColumns(metric_cols())


def prf_by_detector(df: DataFrame, detectors: Sequence[str], y: str = "is_anomaly") -> DataFrame:
    """V3: one row per detector column (incl. the ensemble): metrics, detected and
    correct counts.  The detector columns are unpivoted so one grouped aggregate
    computes all of them."""
    stacked = df.select(_b(y).alias("_y"), F.explode(F.array(*[
        F.struct(F.lit(d).alias("detector"), _b(d).alias("_p")) for d in detectors])).alias("_d"))
    g = stacked.groupBy(F.col("_d.detector").alias("detector")).agg(
        F.count_if(F.col("_y") & F.col("_d._p")).alias("true_positives"),
        F.count_if(~F.col("_y") & F.col("_d._p")).alias("false_positives"),
        F.count_if(F.col("_y") & ~F.col("_d._p")).alias("false_negatives"),
        F.count_if(~F.col("_y") & ~F.col("_d._p")).alias("true_negatives"),
        F.count_if(F.col("_d._p")).alias("detected"))
    return g.withColumns(metric_cols()).withColumn("correct", F.col("true_positives"))


def detection_status(y: str = "is_anomaly", yhat: str = "ensemble") -> Column:
    """V7: 0 normal, 1 missed, 3 correct, 4 false alarm."""
    t, p = _b(y), _b(yhat)
    return (F.when(t & p, 3).when(t & ~p, 1).when(~t & p, 4).otherwise(0)).cast("int")


def outcome_rows(df: DataFrame, y: str = "is_anomaly", yhat: str = "ensemble") -> DataFrame:
    """V4: every row labelled correct / missed / false_alarm / normal (filter on
    ``outcome`` for each row set)."""
    st = detection_status(y, yhat)
    return df.withColumn("outcome", F.when(st == 3, "correct").when(st == 1, "missed")
                         .when(st == 4, "false_alarm").otherwise("normal"))


def detection_rate_by_type(df: DataFrame, y: str = "is_anomaly", yhat: str = "ensemble",
                           kind: str = "anomaly_type") -> DataFrame:
    """V5: detected / total per anomaly type, on true anomalies."""
    t = df.where(_b(y))
    return t.groupBy(kind).agg(F.count(F.lit(1)).alias("total"),
                               F.count_if(_b(yhat)).alias("detected")) \
            .withColumn("detection_rate", F.col("detected") / F.col("total"))


def missed_types(df: DataFrame, y: str = "is_anomaly", yhat: str = "ensemble",
                 kind: str = "anomaly_type") -> DataFrame:
    """V6: value counts of anomaly types among missed rows."""
    return df.where(_b(y) & ~_b(yhat)).groupBy(kind).agg(F.count(F.lit(1)).alias("n"))


def recall_gate(df: DataFrame, threshold: float = 0.7, first_n: int | None = None, y: str = "is_anomaly",
                yhat: str = "ensemble", s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT) -> DataFrame:
    """V8: recall on all rows, or on the first ``first_n`` in time order, and
    ``recall >= threshold``."""
    if first_n is not None:
        from ..sources.readers import slice_rows
        df = slice_rows(df, 0, first_n, series=s, layout=layout)
    return prf(df, y, yhat).withColumns({"recall_threshold": F.lit(float(threshold)),
                                         "validation_passed": F.col("recall") >= F.lit(threshold)})


def validation_report(df: DataFrame, y: str = "is_anomaly", yhat: str = "ensemble",
                      recall_threshold: float = 0.7) -> DataFrame:
    """V9: one row: batch size, metrics, injected / detected / correct / missed /
    false-alarm counts and the recall gate.  A single aggregate."""
    t, p = _b(y), _b(yhat)
    r = df.agg(F.count(F.lit(1)).alias("batch_size"), *confusion_aggs(y, yhat),
               F.count_if(t).alias("injected_anomalies"), F.count_if(p).alias("detected_anomalies"))
    r = r.withColumns(metric_cols()).withColumns({
        "correct_detections": F.col("true_positives"),
        "missed_anomalies": F.col("false_negatives"),
        "false_alarms": F.col("false_positives"),
    })
    return r.withColumn("validation_passed", F.col("recall") >= F.lit(recall_threshold))


def detailed_analysis(scored: DataFrame, detectors: Sequence[str], y: str = "is_anomaly",
                      yhat: str = "ensemble", start: int = 0, end: int | None = None,
                      s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT) -> dict[str, DataFrame]:
    """Slice, then the V1-V7 tables over one scored slice, written to the checkpoint folder."""
    from ..sources.readers import slice_rows
    from .windows import checkpoint
    d = slice_rows(scored, start, end, series=s, layout=layout) if (start or end is not None) else scored
    d = checkpoint(d)
    return {
        "metrics": prf(d, y, yhat),
        "by_detector": prf_by_detector(d, list(detectors) + [yhat], y),
        "by_type": detection_rate_by_type(d, y, yhat),
        "missed_types": missed_types(d, y, yhat),
        "rows": outcome_rows(d, y, yhat).withColumn("status", detection_status(y, yhat)),
    }


def analysis_table(tables: Mapping[str, DataFrame]) -> DataFrame:
    """V10's tables as one: (table, item, measure, value) with every number as a double, a yes or no as 1 or 0;
    of the row table the counts per status."""
    rows = tables["rows"].groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    out = None
    for name, (d, item) in {"metrics": (tables["metrics"], None), "by_detector": (tables["by_detector"], "detector"),
                            "by_type": (tables["by_type"], "anomaly_type"),
                            "missed_types": (tables["missed_types"], "anomaly_type"), "rows": (rows, "status")}.items():
        own = F.lit(None).cast("string") if item is None else F.col(item).cast("string")
        numbers = [c for c, t in d.dtypes if c != item and t not in ("string", "timestamp", "timestamp_ntz")]
        measures = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in numbers])
        part = d.select(F.lit(name).alias("table"), own.alias("item"), F.inline(measures))
        out = part if out is None else out.unionByName(part)
    return out
