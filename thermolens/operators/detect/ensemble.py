"""Weighted ensemble, detector protocol, chronological split, quantile
threshold, ensemble metadata."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...schema import DEFAULT_SERIES, Series, flag
from ..clean import normal_only
from ..joins import attach_params
from ..scaling import minmax_fit, quantile_table
from ..windows import DEFAULT_LAYOUT, Layout, first_rows, pos_col, sk_col, with_position
from .baseline import baseline_fit, baseline_predict


def ensemble_predict(df: DataFrame, weights: Mapping[str, float], threshold: float = 0.5,
                     frozen_minmax: DataFrame | None = None, score_out: str = "ensemble_score",
                     flag_out: str = "ensemble") -> DataFrame:
    """Min-max normalise each score column over the batch (one aggregate) or
    with frozen min/max (streams), weighted mean with weights / total weight,
    ``ensemble = score > threshold`` (strict).  A constant score contributes 0."""
    cols = list(weights)
    params = frozen_minmax if frozen_minmax is not None else minmax_fit(df, cols)
    d = attach_params(df, params)
    total = float(sum(weights.values()))
    acc = F.lit(0.0)
    if total > 0:
        for c, w in weights.items():
            lo, hi = F.col(f"{c}__min"), F.col(f"{c}__max")
            norm = F.when(hi == lo, F.lit(0.0)).otherwise((F.col(c) - lo) / (hi - lo))
            acc = acc + F.lit(w / total) * F.coalesce(norm, F.lit(0.0))
    d = d.withColumn(score_out, acc).withColumn(flag_out, (F.col(score_out) > threshold).cast("int"))
    return d.drop(*[f"{c}__{k}" for c in cols for k in ("min", "max")])


class Detector(Protocol):
    """Extension point: ``fit`` returns a params table; ``score`` adds
    ``<name>_score`` (higher = more anomalous) and ``<name>`` (0/1)."""

    name: str

    def fit(self, df: DataFrame, label: str | None = None) -> DataFrame: ...

    def score(self, df: DataFrame, params: DataFrame) -> DataFrame: ...


@dataclass
class StatisticalDetector:
    """D5-D7 as a detector."""

    z_threshold: float = 3.0
    iqr_multiplier: float = 1.5
    col: str = "avg"
    name: str = "Statistical"

    def fit(self, df, label=None):
        return baseline_fit(df, self.col, label, (), self.z_threshold, self.iqr_multiplier)

    def score(self, df, params):
        return baseline_predict(df, params, self.col, (), out=self.name, score_out=f"{self.name}_score")


SETTINGS = "detector string, detector_type string, settings string, weight double, threshold double"


@dataclass
class Ensemble:
    """Registered detectors with weights; fit each (each fit is Spark jobs on
    the cluster; the loop over detectors is a handful of driver calls)."""

    threshold: float = 0.5
    detectors: dict = field(default_factory=dict)
    weights: dict = field(default_factory=dict)
    params: dict = field(default_factory=dict)

    def add_detector(self, det, weight: float = 1.0) -> "Ensemble":
        self.detectors[det.name] = det
        self.weights[det.name] = float(weight)
        return self

    def fit(self, df: DataFrame, label: str | None = None, store: str | None = None,
            force_retrain: bool = False) -> "Ensemble":
        for name, det in self.detectors.items():
            if store:
                from ...sources.readers import fit_or_load
                self.params[name] = fit_or_load(df.sparkSession, f"{store}/{name}",
                                                lambda det=det: det.fit(df, label), force_retrain)
            else:
                self.params[name] = det.fit(df, label)
        if store:
            self._save_settings(df.sparkSession, store)
        return self

    def _save_settings(self, spark: SparkSession, store: str) -> None:
        rows = [(n, type(d).__name__, json.dumps(asdict(d)), self.weights[n], float(self.threshold))
                for n, d in self.detectors.items()]
        spark.createDataFrame(rows, SETTINGS).coalesce(1).write.mode("overwrite").parquet(f"{store}/_ensemble")

    @classmethod
    def load(cls, spark: SparkSession, store: str, types: Mapping[str, type] | None = None) -> "Ensemble":
        """The ensemble that ``fit(store=...)`` saved: detectors with their settings,
        weights, threshold and fitted parameters.  ``types`` names further detector classes."""
        from ...sources.readers import load_params
        from .iforest import IsolationForestDetector
        known = {c.__name__: c for c in (StatisticalDetector, IsolationForestDetector)} | dict(types or {})
        out = cls()
        # one row per detector
        for r in spark.read.parquet(f"{store}/_ensemble").collect():
            out.threshold = r["threshold"]
            out.add_detector(known[r["detector_type"]](**json.loads(r["settings"])), r["weight"])
            out.params[r["detector"]] = load_params(spark, f"{store}/{r['detector']}")
        return out

    @property
    def is_fitted(self) -> bool:
        return bool(self.detectors) and all(n in self.params for n in self.detectors)

    def predict(self, df: DataFrame, frozen_minmax: DataFrame | None = None) -> DataFrame:
        if not self.is_fitted:
            raise ValueError("ensemble is not fitted")
        d = df
        for name, det in self.detectors.items():
            d = det.score(d, self.params[name])
        return ensemble_predict(d, {f"{n}_score": w for n, w in self.weights.items()}, self.threshold,
                                frozen_minmax)

    def info(self, spark: SparkSession) -> DataFrame:
        """Fitted flag, weight and type per detector, and the threshold."""
        rows = [(n, type(d).__name__, self.weights[n], n in self.params, float(self.threshold))
                for n, d in self.detectors.items()]
        schema = T.StructType([T.StructField("detector", T.StringType()), T.StructField("detector_type", T.StringType()),
                               T.StructField("weight", T.DoubleType()), T.StructField("is_fitted", T.BooleanType()),
                               T.StructField("ensemble_threshold", T.DoubleType())])
        return spark.createDataFrame(rows, schema)


def chronological_split(df: DataFrame, train_fraction: float = 0.8, per_series: bool = False,
                        s: Series = DEFAULT_SERIES, layout: Layout = DEFAULT_LAYOUT,
                        out: str = "is_train") -> DataFrame:
    """The first ``floor(f * n)`` rows in time order are training rows, over
    the whole table or per series.  Exact; never a random split."""
    if not per_series:
        s = Series(key=(), ts=s.ts, tiebreak=tuple(s.tiebreak) or tuple(c for c in s.key if c in df.columns))
    s = s.present(df)
    if not per_series:
        return first_rows(df, s, math.floor(df.count() * train_fraction), out)
    SK, POS = sk_col(s), pos_col(s)
    d = with_position(df, s, layout)
    n = d.groupBy(SK).agg(F.count(F.lit(1)).alias("_n"))
    d = d.join(n, SK)
    cut = F.floor(F.col("_n") * F.lit(train_fraction))
    return d.withColumn(out, F.col(POS) < cut).drop("_n")


def quantile_threshold_fit(df: DataFrame, score: str, p: float = 0.95, label: str | None = None,
                           by: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """D15 fit: threshold = p-quantile of the score on normal rows."""
    return quantile_table(normal_only(df, label), [score], [p], by, {(score, p): "threshold"}, approx)


def quantile_threshold(df: DataFrame, score: str, params: DataFrame, by: Sequence[str] = (),
                       out: str | None = None) -> DataFrame:
    """D15 predict: ``score > threshold``."""
    d = attach_params(df, params, by)
    return d.withColumn(out or f"{score}_flag", flag(F.col(score) > F.col("threshold"))).drop("threshold")
