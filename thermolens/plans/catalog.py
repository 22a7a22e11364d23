"""Registered queries: one per operator family of the inventory.  Each reads the
driver tables (``events``) through the canonical readings tables, so its work
grows with the data; each has an independently written DuckDB oracle in
``sql.py`` unless the operator is not expressible in SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.numeric import round_columns
from ..operators import joins, prose, scaling, stats, timeseries as ts, validate
from ..operators.clean import combine, except_rows, filter_type, intersect_rows, prepare_readings
from ..operators.detect.baseline import baseline_fit, baseline_predict
from ..operators.detect.ensemble import (chronological_split, ensemble_predict, quantile_threshold,
                                         quantile_threshold_fit)
from ..operators.detect.rolling import find_anomaly_domestic, rolling_sigma
from ..operators.detect.rules import domain_rules
from ..operators.detect.zscore import zscore_any
from ..operators.faults import inject_faults, rate_within_tolerance
from ..operators.features import exog_features, feature_matrix
from ..operators.windows import checkpoint
from ..sources.fixtures import readings_hourly, readings_per_event
from . import sql

Query = Callable[[SparkSession, str], DataFrame]
KEY = ["type", "ID", "timestamp"]
VALS = ["avg", "min_v", "max_v", "T_diff"]


def rnd(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Round result columns the same way the oracle does (see ``round_to``)."""
    return round_columns(df, cols, digits)


# ---------------------------------------------------------------- canonical tables
# Stage outputs are materialised with checkpoint() in the session's shared
# checkpoint folder -- the hand-off points where the reference writes files
# (combined readings, injected batch, scored batch, labels).  Operators stay lazy;
# the stages keep every downstream plan small and cut lineage for recovery.
def readings(spark, sf, source=readings_hourly) -> DataFrame:
    """X1 over the hourly rollup, or over one reading per event (``readings_per_event``)."""
    return checkpoint(prepare_readings(source(spark, sf)))


def faulted(spark, sf, source=readings_hourly) -> DataFrame:
    """5 % of rows perturbed, seed 42."""
    return checkpoint(inject_faults(readings(spark, sf, source), 0.05, 42))


def scored(spark, sf, source=readings_hourly) -> DataFrame:
    """E3 flow: statistical baseline (z 2.5) fitted on normal rows + rolling-sigma
    ratio, equal weights, threshold 0.5."""
    f = faulted(spark, sf, source)
    params = baseline_fit(f, "avg", label="is_anomaly", z_threshold=2.5, iqr_multiplier=1.5)
    d = baseline_predict(f, params, "avg", out="statistical", score_out="statistical_score")
    d = rolling_sigma(d, "avg", 24, 2.0, "anomaly")
    return checkpoint(ensemble_predict(d, {"statistical_score": 1.0, "anomaly_ratio": 1.0}, 0.5))


def labeled(spark, sf) -> DataFrame:
    """Readings with the D1, D3, D4, D7 flags and their union."""
    r = readings(spark, sf)
    d = rolling_sigma(r, "avg", 24, 2.0, "rolling_anomaly").drop("rolling_anomaly_ratio")
    d = zscore_any(d, VALS, 3.0)
    d = domain_rules(d)
    d = baseline_predict(d, baseline_fit(r, "avg"), "avg", out="_b").withColumn("baseline_anomaly", F.col("_b") == 1).drop("_b")
    return checkpoint(d.withColumn("is_anomaly", F.col("rolling_anomaly") | F.col("statistical_anomaly")
                                   | F.col("domain_anomaly") | F.col("baseline_anomaly")))


# ---------------------------------------------------------------- queries
def d2_domestic_periods(spark, sf):
    return find_anomaly_domestic(readings_hourly(spark, sf))


def d2_periods_per_event(spark, sf):
    """D2 on the per-event table: 1 reading per event, one series per user."""
    return find_anomaly_domestic(readings_per_event(spark, sf))


def s7_rollup_hourly(spark, sf):
    return readings_hourly(spark, sf)


def x1_prepare_readings(spark, sf):
    return readings(spark, sf)


def w3_interval_histogram(spark, sf):
    return ts.interval_histogram(readings_hourly(spark, sf))


def d1_rolling_sigma(spark, sf):
    d = rolling_sigma(readings(spark, sf), keep_stats=True)
    return rnd(d.select(*KEY, "avg", "avg_rolling_mean", "avg_rolling_std", "anomaly"),
               ["avg_rolling_mean", "avg_rolling_std"])


def w6w7_rolling_time(spark, sf):
    d = ts.rolling_time(readings(spark, sf), ["avg", "T_diff"], (1, 6, 24))
    cols = [f"{c}_rolling_{s}_{h}h" for c in ("avg", "T_diff") for h in (1, 6, 24) for s in ("mean", "std")]
    return rnd(d.select(*KEY, *cols), cols)


def w8w9_rates(spark, sf):
    d = ts.rate_per_min(ts.weighted_change(readings(spark, sf)))
    cols = [f"{c}_{n}" for c in VALS for n in ("weighted_change", "rate_per_min")]
    return rnd(d.select(*KEY, *cols), cols)


def x3_exog_features(spark, sf):
    d = exog_features(readings(spark, sf))
    return rnd(d, ["hour_sin", "hour_cos", "temp_lag_24h", "temp_ma_24h"])


def w13_deviation_from_mean(spark, sf):
    r = readings(spark, sf)
    d = ts.deviation_from_mean(filter_type(r, "domestic"), "avg", reference=r)
    return rnd(d.select(*KEY, "avg", "avg_deviation"), ["avg_deviation"])


def w14_sequences(spark, sf):
    return ts.sequences(readings(spark, sf), "avg", 24).select(*KEY, "sequence")


def w16_missing_slots(spark, sf):
    return ts.missing_slots(readings(spark, sf), "1 hour").select(*KEY)


def w16_outages(spark, sf):
    """Runs of missing hours of every series, one row per outage."""
    return ts.outages(readings(spark, sf), "1 hour")


def w16_outages_per_event(spark, sf):
    """Every user's runs of hours without an event."""
    return ts.outages(readings_per_event(spark, sf), "1 hour")


def f_calendar(spark, sf):
    r = readings(spark, sf)
    return rnd(r.select(*KEY, cal.hour().alias("hour"), cal.month().alias("month"),
                        cal.day_of_week().alias("day_of_week"), cal.is_weekend().alias("is_weekend"),
                        cal.day_name().alias("day_name"), cal.date_of().alias("date"), cal.hhmm().alias("hhmm"),
                        cal.hour_sin().alias("hour_sin"), cal.hour_cos().alias("hour_cos"),
                        cal.is_peak().alias("is_peak"), cal.nighttime(preset="eda").alias("night_eda"),
                        cal.nighttime(preset="generator").alias("night_generator")), ["hour_sin", "hour_cos"])


def f8_one_hot(spark, sf):
    return cal.one_hot(readings(spark, sf), "type", ["domestic", "forward"]).select(
        *KEY, "type_domestic", "type_forward", "type_nan")


def f9_ratios(spark, sf):
    from ..functions.numeric import temperature_ratios
    d = readings(spark, sf).withColumns(temperature_ratios())
    cols = list(temperature_ratios())
    return rnd(d.select(*KEY, *cols), cols)


def f10_gap_features(spark, sf):
    d = scaling.time_gap_features(readings(spark, sf))
    cols = ["time_diff_normalized", "time_diff_deviation", "time_diff_z_score"]
    return rnd(d.select(*KEY, "time_diff_min", *cols), cols)


def f12_zscores(spark, sf):
    d = scaling.zscores(readings(spark, sf), VALS)
    cols = [f"{c}_z" for c in VALS]
    return rnd(d.select(*KEY, *cols), cols)


def f13_standardize(spark, sf):
    d = scaling.standardize(readings(spark, sf), ["avg", "T_diff"])
    return rnd(d.select(*KEY, "avg", "T_diff"), ["avg", "T_diff"])


def f14_minmax(spark, sf):
    d = scaling.minmax_normalize(readings(spark, sf), ["avg"])
    return rnd(d.select(*KEY, "avg_norm"), ["avg_norm"])


def x2_feature_matrix(spark, sf, source=readings_hourly):
    # feature_matrix writes its input to the checkpoint folder itself
    d = feature_matrix(filter_type(prepare_readings(source(spark, sf)), "domestic"), type_categories=("domestic",))
    dbl = [c for c, t in d.dtypes if t == "double"]
    return rnd(d, dbl)


def a1_describe(spark, sf, source=readings_hourly):
    d = stats.describe(readings(spark, sf, source), VALS)
    return rnd(d, ["mean", "std", "q25", "q50", "q75"])


def a1_describe_day_night(spark, sf):
    d = stats.describe(readings(spark, sf), VALS, by=["nighttime"])
    return rnd(d, ["mean", "std", "q25", "q50", "q75"])


def a2_distinct_types(spark, sf):
    return stats.distinct_values(readings_hourly(spark, sf), "type")


def a3_overview(spark, sf):
    return stats.table_overview(readings(spark, sf))


def a4_value_counts(spark, sf):
    return stats.value_counts(readings(spark, sf), "type")


def d3_zscore_any(spark, sf, source=readings_hourly):
    d = zscore_any(filter_type(readings(spark, sf, source), "domestic"), VALS, 3.0, keep_z=True)
    cols = [f"{c}_z" for c in VALS]
    return rnd(d.select(*KEY, *cols, "statistical_anomaly"), cols)


def d4_domain_rules(spark, sf):
    return domain_rules(readings(spark, sf), keep_rules=True).select(
        *KEY, "rule_avg_range", "rule_min_gt_max", "rule_spread_range", "domain_anomaly")


def d5_baseline_fit(spark, sf):
    p = baseline_fit(readings(spark, sf), "avg", by=["type", "ID"])
    return rnd(p, ["mean", "std", "q1", "q3", "iqr"])


def r1_inject_faults(spark, sf):
    return rnd(faulted(spark, sf), ["avg", "min_v", "max_v", "T_diff"])


def d12_ensemble(spark, sf, source=readings_hourly):
    d = scored(spark, sf, source).select(*KEY, "is_anomaly", "anomaly_type", "statistical", "statistical_score",
                                 "anomaly", "anomaly_ratio", "ensemble_score", "ensemble")
    return rnd(d, ["statistical_score", "anomaly_ratio", "ensemble_score"])


def v9_validation_report(spark, sf, source=readings_hourly):
    d = validate.validation_report(scored(spark, sf, source))
    return rnd(d, ["precision", "recall", "f1_score", "accuracy"])


def v3_prf_by_detector(spark, sf):
    d = validate.prf_by_detector(scored(spark, sf), ["statistical", "anomaly", "ensemble"])
    return rnd(d, ["precision", "recall", "f1_score", "accuracy"])


def v2_prf_statistical(spark, sf):
    return rnd(validate.prf(scored(spark, sf), "is_anomaly", "statistical"),
               ["precision", "recall", "f1_score", "accuracy"])


def v5_detection_rate_by_type(spark, sf):
    return rnd(validate.detection_rate_by_type(scored(spark, sf)), ["detection_rate"])


def v6_missed_types(spark, sf):
    return validate.missed_types(scored(spark, sf))


def v7_detection_status(spark, sf):
    d = validate.outcome_rows(scored(spark, sf)).withColumn("status", validate.detection_status())
    return rnd(d.select(*KEY, "avg", "status", "outcome"), ["avg"])


def v8_recall_gate(spark, sf):
    return rnd(validate.recall_gate(scored(spark, sf), 0.7), ["precision", "recall", "f1_score", "accuracy"])


def d14_chronological_split(spark, sf, source=readings_hourly):
    r = readings(spark, sf, source)
    d = chronological_split(r, 0.8, per_series=False)
    d = chronological_split(d, 0.8, per_series=True, out="is_train_series")
    return d.select(*KEY, "is_train", "is_train_series")


def d15_quantile_threshold(spark, sf):
    s = scored(spark, sf)
    p = quantile_threshold_fit(s, "statistical_score", 0.95, label="is_anomaly")
    d = quantile_threshold(s, "statistical_score", p)
    return rnd(d.select(*KEY, "statistical_score", "statistical_score_flag"), ["statistical_score"])


def a17_rate_within_tolerance(spark, sf):
    return rnd(rate_within_tolerance(faulted(spark, sf), 0.05, 0.02), ["anomaly_rate"])


def j2_compare_profiles(spark, sf):
    d = joins.compare_profiles(readings(spark, sf), faulted(spark, sf))
    return rnd(d, ["real_mean", "synthetic_mean", "difference"])


def j3_join_labels(spark, sf):
    pred = scored(spark, sf).select(*KEY, "ensemble")
    truth = faulted(spark, sf).select(*KEY, "is_anomaly", "anomaly_type")
    return joins.join_labels(pred, truth)


def d10_union_flags(spark, sf):
    return labeled(spark, sf).select(*KEY, "rolling_anomaly", "statistical_anomaly", "domain_anomaly",
                                     "baseline_anomaly", "is_anomaly")


def a5_anomaly_summary(spark, sf):
    return rnd(stats.anomaly_summary(labeled(spark, sf)), ["anomaly_rate"])


def a6_anomaly_by_type(spark, sf):
    return stats.anomaly_by_group(labeled(spark, sf), "type")


FLAGS = ["rolling_anomaly", "statistical_anomaly", "domain_anomaly", "baseline_anomaly"]


def a7_detector_rates(spark, sf):
    return rnd(stats.detector_rates(labeled(spark, sf), FLAGS), ["rate"])


def a8_hourly_profile(spark, sf):
    return stats.hourly_profile(labeled(spark, sf))


def a8_hourly_argmax(spark, sf):
    return stats.profile_argmax(stats.hourly_profile(labeled(spark, sf)), "hour")


def a9_weekday_profile(spark, sf):
    return stats.weekday_profile(labeled(spark, sf))


def a10_daily_rate(spark, sf):
    return rnd(stats.daily_rate(labeled(spark, sf)), ["anomaly_rate"])


def a11_temperature_by_label(spark, sf):
    return rnd(stats.temperature_by_label(labeled(spark, sf)), ["mean_temp"])


def a12_night_day_rates(spark, sf):
    return rnd(stats.night_day_rates(labeled(spark, sf)), ["anomaly_rate"])


def a13_overlap_counts(spark, sf):
    return stats.overlap_counts(labeled(spark, sf), FLAGS[:3])


def a14_exclusive_overlap(spark, sf):
    return stats.exclusive_overlap(labeled(spark, sf), FLAGS[:3])


def a15_histogram(spark, sf):
    d = stats.histogram(labeled(spark, sf), "avg", 50, by=["is_anomaly"], density=True, common_range=True)
    return rnd(rnd(d, ["bin_start", "bin_end"]), ["density"], 9)


def a16_hourly_mean_profile(spark, sf):
    return rnd(stats.hourly_mean_profile(readings(spark, sf)), ["mean"])


def w12_periods_domain_forward(spark, sf):
    d = filter_type(labeled(spark, sf), "forward")
    return ts.anomaly_periods(d, "domain_anomaly").select(
        "type", "ID", "period_no", "start_ts", "end_ts", "n_rows", "start_weekday", "start_time", "end_weekday", "end_time")


def u1_combine(spark, sf):
    h = readings_hourly(spark, sf)
    return combine([prepare_readings(filter_type(h, t)) for t in ("domestic", "forward")])


def u2_intersect_except(spark, sf):
    lab = labeled(spark, sf)
    st, dom = lab.where("statistical_anomaly"), lab.where("domain_anomaly")
    both = intersect_rows(st, dom).select(*KEY, F.lit("statistical_and_domain").alias("row_set"))
    only = except_rows(st, dom).select(*KEY, F.lit("statistical_not_domain").alias("row_set"))
    return both.unionByName(only)


def n1_gap_warning(spark, sf):
    return prose.gap_warning(readings(spark, sf)).select(*KEY, "gap_warning")


def n2_sensor_fault(spark, sf):
    return prose.sensor_fault(readings(spark, sf)).select(*KEY, "sensor_fault")


def n3_interval_swing(spark, sf):
    return prose.interval_swing(readings(spark, sf)).select(*KEY, "interval_swing")


def n4_cross_circuit(spark, sf):
    """Every drop of every circuit, and whether others of its type dropped in the same hour."""
    return rnd(prose.cross_circuit_check(prose.circuit_drops(readings(spark, sf), 10.0)), ["mean"])


def w10_lag_rows(spark, sf):
    """The value one row and 24 rows back."""
    d = ts.lag_rows(ts.lag_rows(readings(spark, sf), "avg", 1, "lag_1"), "avg", 24, "lag_24")
    return d.select(*KEY, "avg", "lag_1", "lag_24")


def d10_union_with_forest(spark, sf):
    """The union of rolling, z-score, rule, baseline and isolation forest flags."""
    from ..operators.detect.iforest import isolation_forest_fit, isolation_forest_predict
    d = labeled(spark, sf)
    d = isolation_forest_predict(d, isolation_forest_fit(d, "avg", 100, 256, 0.1, 42))
    return d.select(*KEY, *FLAGS, (F.col("Isolation_Forest") == 1).alias("forest_anomaly"),
                    (F.col("is_anomaly") | (F.col("Isolation_Forest") == 1)).alias("is_anomaly"))


ORACLE: dict[str, str] = {
    "d2_domestic_periods": sql.D2,
    "s7_rollup_hourly": sql.S7,
    "x1_prepare_readings": sql.X1,
    "w3_interval_histogram": sql.W3,
    "d1_rolling_sigma": sql.D1,
    "w6w7_rolling_time": sql.W6W7,
    "w8w9_rates": sql.W8W9,
    "x3_exog_features": sql.X3,
    "w13_deviation_from_mean": sql.W13,
    "w14_sequences": sql.W14,
    "w16_missing_slots": sql.W16,
    "w16_outages": sql.W16_OUTAGES,
    "w16_outages_per_event": sql.W16_OUTAGES_EVENT,
    "f_calendar": sql.FCAL,
    "f8_one_hot": sql.F8,
    "f9_ratios": sql.F9,
    "f10_gap_features": sql.F10,
    "f12_zscores": sql.F12,
    "f13_standardize": sql.F13,
    "f14_minmax": sql.F14,
    "x2_feature_matrix": sql.X2,
    "a1_describe": sql.A1,
    "a1_describe_day_night": sql.A1_NIGHT,
    "a2_distinct_types": sql.A2,
    "a3_overview": sql.A3,
    "a4_value_counts": sql.A4,
    "d3_zscore_any": sql.D3,
    "d4_domain_rules": sql.D4,
    "d5_baseline_fit": sql.D5,
    "r1_inject_faults": sql.R1,
    "d12_ensemble": sql.D12,
    "v9_validation_report": sql.V9,
    "v3_prf_by_detector": sql.V3,
    "v2_prf_statistical": sql.V2,
    "v5_detection_rate_by_type": sql.V5,
    "v6_missed_types": sql.V6,
    "v7_detection_status": sql.V7,
    "v8_recall_gate": sql.V8,
    "d14_chronological_split": sql.D14,
    "d15_quantile_threshold": sql.D15,
    "a17_rate_within_tolerance": sql.A17,
    "j2_compare_profiles": sql.J2,
    "j3_join_labels": sql.J3,
    "d10_union_flags": sql.D10,
    "a5_anomaly_summary": sql.A5,
    "a6_anomaly_by_type": sql.A6,
    "a7_detector_rates": sql.A7,
    "a8_hourly_profile": sql.A8,
    "a8_hourly_argmax": sql.A8_ARGMAX,
    "a9_weekday_profile": sql.A9,
    "a10_daily_rate": sql.A10,
    "a11_temperature_by_label": sql.A11,
    "a12_night_day_rates": sql.A12,
    "a13_overlap_counts": sql.A13,
    "a14_exclusive_overlap": sql.A14,
    "a15_histogram": sql.A15,
    "a16_hourly_mean_profile": sql.A16,
    "w12_periods_domain_forward": sql.W12,
    "u1_combine": sql.U1,
    "u2_intersect_except": sql.U2,
    "n1_gap_warning": sql.N1,
    "n2_sensor_fault": sql.N2,
    "n3_interval_swing": sql.N3,
    "n4_cross_circuit": sql.N4,
    "w10_lag_rows": sql.W10,
}



# ---------------------------------------------------------------- forest-based (no SQL oracle: rows check + unit tests)
def d8_isolation_forest(spark, sf, source=readings_hourly, pools=True):
    """1-D forest on the hourly mean, 100 trees, contamination 0.1."""
    from ..operators.detect.iforest import isolation_forest_fit, isolation_forest_predict
    r = readings(spark, sf, source)
    model = isolation_forest_fit(r, "avg", 100, 256, 0.1, 42, pools=pools)
    d = isolation_forest_predict(r, model)
    return rnd(d.select(*KEY, "avg", "if_score", "Isolation_Forest", "Isolation_Forest_score"),
               ["if_score", "Isolation_Forest_score"])


def d11_label_readings(spark, sf):
    """D9 + D11: labeler on the domestic series (n-D forest, contamination 0.05)."""
    from ..operators.detect.iforest_nd import label_readings
    d = label_readings(readings(spark, sf), "domestic", 0.05)
    return rnd(d.select(*KEY, "avg", "is_anomaly", "anomaly_score", "isolation_forest_anomaly",
                        "statistical_anomaly", "domain_anomaly"), ["anomaly_score"])


def d13_ensemble_forest(spark, sf):
    """Ensemble of the 1-D forest and the statistical detector on faulted data,
    trained on the first 80 % (D14), applied to all rows."""
    from ..operators.detect.ensemble import Ensemble, StatisticalDetector
    from ..operators.detect.iforest import IsolationForestDetector
    f = chronological_split(faulted(spark, sf), 0.8)
    ens = Ensemble().add_detector(IsolationForestDetector(0.1), 1.0).add_detector(StatisticalDetector(2.5, 1.5), 1.0)
    ens.fit(f.where("is_train"), label="is_anomaly")
    d = ens.predict(f)
    return rnd(d.select(*KEY, "is_train", "is_anomaly", "Isolation_Forest", "Statistical", "ensemble_score", "ensemble"),
               ["ensemble_score"])


def v10_detailed_analysis(spark, sf):
    """Per-detector metrics of the forest ensemble on the held-out 20 %."""
    d = d13_ensemble_forest(spark, sf).where(~F.col("is_train"))
    return rnd(validate.prf_by_detector(d, ["Isolation_Forest", "Statistical", "ensemble"]),
               ["precision", "recall", "f1_score", "accuracy"])


# ---------------------------------------------------------------- streaming: run over all available input
def _stream_name(prefix: str) -> str:
    import uuid
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _run_rollup(spark, sf, name, then):
    from ..sources.fixtures import events
    from ..streaming.queries import run_rollup, streams_in_order
    out = run_rollup(streams_in_order(spark, f"{sf}/events.parquet"), events(spark, sf), _stream_name(name), then)
    return out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def t1_stream_rollup(spark, sf):
    """Watermarked hourly rollup of the events stream, all windows."""
    return rnd(_run_rollup(spark, sf, "t1", lambda d: d), ["avg", "stddev_v"])


def t2t3_stream_rules_score(spark, sf):
    """T2 + T3: domain rules and the statistical detector with a frozen batch
    baseline, on the streamed hourly rollup."""
    from ..streaming.queries import stream_domain_rules, stream_score
    frozen = baseline_fit(readings_hourly(spark, sf), "avg")

    def then(d):
        d = d.withColumn("T_diff", F.col("max_v") - F.col("min_v"))
        d = stream_score(stream_domain_rules(d), frozen)
        return d.select("event_type", "timestamp", "rule_avg_range", "rule_min_gt_max", "rule_spread_range",
                        "domain_anomaly", "statistical", "statistical_score")
    return rnd(_run_rollup(spark, sf, "t23", then), ["statistical_score"])


def t4_stream_ensemble(spark, sf):
    """T4: ensemble vote on the stream with min/max frozen from the batch scores."""
    from ..operators.scaling import minmax_fit
    from ..streaming.queries import stream_ensemble, stream_score
    hourly = readings_hourly(spark, sf)
    frozen = baseline_fit(hourly, "avg")
    batch_scores = baseline_predict(hourly, frozen, "avg", out="statistical", score_out="statistical_score")
    mm = minmax_fit(batch_scores, ["statistical_score"])

    def then(d):
        d = stream_ensemble(stream_score(d, frozen), {"statistical_score": 1.0}, mm, 0.5)
        return d.select("event_type", "timestamp", "statistical_score", "ensemble_score", "ensemble")
    return rnd(_run_rollup(spark, sf, "t4", then), ["statistical_score", "ensemble_score"])


def _stream_series(spark, sf):
    from ..streaming.queries import run_series_state, streams_in_order
    rd = [ev.select(F.col("ts").alias("timestamp"), F.col("value").alias("avg"), F.lit("domestic").alias("type"),
                    F.col("user_id").cast("string").alias("ID"))
          for ev in streams_in_order(spark, f"{sf}/events.parquet")]
    return run_series_state(rd, _stream_name("t57"), "1 hour", 24, 2.0)


def t5t6_stream_gap_rate_sigma(spark, sf):
    """T5 + T6: per-event readings per user, released in event-time order."""
    o = _stream_series(spark, sf).where(F.col("record") == "reading")
    o = o.select("type", "ID", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "avg", "time_diff_min",
                 "avg_rate_per_min", "avg_rolling_mean", "avg_rolling_std", "anomaly", "period_no")
    return rnd(o, ["avg_rate_per_min", "avg_rolling_mean", "avg_rolling_std"])


def t7_stream_periods(spark, sf):
    """All anomaly periods from the stream."""
    o = _stream_series(spark, sf).where(F.col("record") == "period")
    return o.select("type", "ID", "period_no", F.col("start_ts").cast("timestamp_ntz").alias("start_ts"),
                    F.col("end_ts").cast("timestamp_ntz").alias("end_ts"), "n_rows")


def t9_stream_dedup(spark, sf):
    """The events stream read twice (at-least-once delivery), deduplicated by event."""
    from ..streaming.queries import run_stream, stream_dedup, streams_in_order
    twice = [stream_dedup(ev.unionByName(ev), ("event_id",), "ts", "1 hour").select("event_id", "ts", "event_type", "value")
             for ev in streams_in_order(spark, f"{sf}/events.parquet")]
    return run_stream(twice, _stream_name("t9")).table.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


ORACLE.update({
    "d8_isolation_forest": sql.D8,
    "d2_periods_per_event": sql.D2_EVENT,
    "p2_to_production": sql.P2,
    "p4_split_day_night": sql.P4,
    "p9_ground_truth_summary": sql.P9,
    "p10_true_anomalies": sql.P10,
    "w15_align_sequence_scores": sql.W15,
    "t1_stream_rollup": sql.T1,
    "t4_stream_ensemble": sql.T4,
    "t2t3_stream_rules_score": sql.T2T3,
    "t5t6_stream_gap_rate_sigma": sql.T5T6,
    "t7_stream_periods": sql.T7,
    "t9_stream_dedup": sql.T9,
})

def p2_to_production(spark, sf):
    """Production projection of the labelled (faulted) table: labels stripped."""
    from ..operators.clean import to_production
    return rnd(to_production(faulted(spark, sf)), ["avg", "min_v", "max_v", "T_diff"])


def p4_split_day_night(spark, sf):
    """The night and day subsets, tagged and recombined."""
    from ..operators.clean import split_day_night
    night, day = split_day_night(readings(spark, sf))
    return night.select(*KEY, F.lit("night").alias("part")).unionByName(day.select(*KEY, F.lit("day").alias("part")))


def p9_ground_truth_summary(spark, sf):
    """Injected anomalies: total and rate."""
    from ..operators.clean import ground_truth_summary
    return rnd(ground_truth_summary(faulted(spark, sf)), ["anomaly_rate"])


def p10_true_anomalies(spark, sf):
    """P10: rows whose label is true."""
    from ..operators.clean import true_anomalies
    return true_anomalies(faulted(spark, sf)).select(*KEY, "anomaly_type")


def w15_align_sequence_scores(spark, sf):
    """W14 + W15: a score per 24-row sequence (its max - min range) lands on the
    sequence's last row; earlier rows take the series' last score."""
    r = readings(spark, sf)
    seq = ts.sequences(r, "avg", 24).select(*KEY, (F.array_max("sequence") - F.array_min("sequence")).alias("seq_score"))
    d = ts.align_sequence_scores(r.join(seq, KEY, "left"), "seq_score", 24)
    return rnd(d.select(*KEY, "seq_score"), ["seq_score"])


def r2_expected_residual(spark, sf):
    """R2: per-series regression fitted on the first 80 % (D14), residual flags on all rows."""
    from ..operators.expected import expected_residual, fit_expected
    r = chronological_split(readings(spark, sf), 0.8, per_series=True)
    coef = fit_expected(r.where("is_train"))
    d = expected_residual(r, coef, 3.0)
    return rnd(d.select(*KEY, "is_train", "avg", "expected", "residual", "expected_anomaly"), ["expected", "residual"])


def s5_save_reload(spark, sf):
    """S5 + D13: fit and save, load in a second step, predict: rows, and rows that differ from
    the directly fitted ensemble's."""
    import uuid

    from ..operators.detect.ensemble import Ensemble, StatisticalDetector
    from ..operators.detect.iforest import IsolationForestDetector
    from ..session import ensure_checkpoint_dir
    f = faulted(spark, sf)
    ens = Ensemble().add_detector(IsolationForestDetector(0.1), 2.0).add_detector(StatisticalDetector(2.5, 1.5), 1.0)
    store = f"{ensure_checkpoint_dir(spark)}/models/{uuid.uuid4().hex}"
    direct = ens.fit(f, "is_anomaly", store=store).predict(f).select(*KEY, "ensemble_score", "ensemble")
    loaded = Ensemble.load(spark, store).predict(f).select(
        *KEY, F.col("ensemble_score").alias("_s"), F.col("ensemble").alias("_e"))
    both = joins.join_null_safe(direct, loaded, KEY, "full_outer")
    same = F.col("ensemble_score").eqNullSafe(F.col("_s")) & F.col("ensemble").eqNullSafe(F.col("_e"))
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~same).alias("n_different"))


def s1_s3_round_trip(spark, sf):
    """S3 + S1 + S2: readings written (partitioned by type, and as CSV), found and read again."""
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..sources.readers import read_first_available, read_readings, write_readings
    base = f"{ensure_checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    r = readings(spark, sf)
    write_readings(r, f"{base}/parquet")
    write_readings(r, f"{base}/csv", fmt="csv", partition_by=None)
    first = read_first_available(spark, [f"{base}/missing", f"{base}/parquet"])
    csv = read_readings(spark, f"{base}/csv", schema=r.schema)
    cols = [*KEY, "avg", "min_v", "max_v", "nighttime", "time_diff_min", "T_diff"]
    d = first.select(F.lit("parquet").alias("fmt"), *cols).unionByName(csv.select(F.lit("csv").alias("fmt"), *cols))
    return rnd(d, VALS)


def s6_t8_monitor_report(spark, sf):
    """T8 + V9 + S6: the scored readings as a stream, one validation row appended per
    micro-batch; their counts add up to the whole table's."""
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..streaming.queries import checkpoint_location, monitor
    base = f"{ensure_checkpoint_dir(spark)}/monitor/{uuid.uuid4().hex}"
    scored(spark, sf).repartition(4).write.parquet(f"{base}/in")
    src = spark.read.parquet(f"{base}/in")
    stream = spark.readStream.schema(src.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    monitor(stream, f"{base}/report", checkpoint_location(spark, "monitor")).awaitTermination()
    cols = ["batch_size", "true_positives", "false_positives", "false_negatives", "true_negatives"]
    return spark.read.parquet(f"{base}/report").agg(*[F.sum(c).cast("long").alias(c) for c in cols])


def p7_w1_tagged(spark, sf):
    """P7 + W1 + F7: every circuit's readings in a folder of its own, without tags and with the time as text;
    read together, tagged by folder, parsed, in time order."""
    import uuid

    from ..operators.clean import source_of_path, tag_by_source
    from ..operators.timeseries import sort_by_time
    from ..session import ensure_checkpoint_dir
    base = f"{ensure_checkpoint_dir(spark)}/circuits/{uuid.uuid4().hex}"
    h = checkpoint(readings_hourly(spark, sf).select(
        F.concat_ws("-", "type", "ID").alias("source"), "type", "ID",
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), "avg"))
    h.select("source", "timestamp", "avg").write.partitionBy("source").parquet(base)
    rows = spark.read.schema("timestamp string, avg double").option("recursiveFileLookup", True).parquet(base)
    rows = rows.withColumn("source", F.substring_index(source_of_path(), "source=", -1))
    d = tag_by_source(rows, h.select("source", "type", "ID"))
    return rnd(sort_by_time(d.withColumn("timestamp", cal.parse_timestamp("timestamp"))).select("timestamp", "avg", "type", "ID"),
               ["avg"])


def p7_w1_tagged_all(spark, sf):
    """P7 + W1 + F7 over every circuit: rows that carry only their source's name, tagged from the table of
    circuits; parsed, in time order."""
    from ..operators.clean import tag_by_source
    from ..operators.timeseries import sort_by_time
    h = checkpoint(readings_hourly(spark, sf))
    rows = h.select(F.concat_ws("/", "type", "ID").alias("source"), "avg",
                    cal.parse_timestamp(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).alias("timestamp"))
    d = tag_by_source(rows, h.select(F.concat_ws("/", "type", "ID").alias("source"), "type", "ID"))
    return rnd(sort_by_time(d).select("timestamp", "avg", "type", "ID"), ["avg"])


def n4_cross_circuit_pairs(spark, sf):
    """N4 for all pairs of circuits within a type: every pair of every hour (record 'pair'), and per hour the circuits
    measured and dropped and its pairs by outcome (record 'hour').  Counts are 0 in pair rows, so they add up over the table."""
    drops = prose.circuit_drops(readings(spark, sf), 10.0)
    pairs = rnd(prose.cross_circuit_pairs(drops), ["a_mean", "b_mean"])
    counts = prose.cross_circuit_counts(drops)
    n = [c for c in counts.columns if c not in ("type", "bucket")]
    pairs = pairs.select(F.lit("pair").alias("record"), "*", *[F.lit(0).cast("long").alias(c) for c in n])
    return pairs.unionByName(counts.withColumn("record", F.lit("hour")), allowMissingColumns=True)


def v10_analysis_tables(spark, sf):
    """All tables (metrics, detectors, types, missed types, outcomes) of the last 20 % of the scored readings."""
    d = chronological_split(scored(spark, sf), 0.8).where(~F.col("is_train"))
    return rnd(validate.analysis_table(validate.detailed_analysis(d, ["statistical"])), ["value"])


def d16_ensemble_info(spark, sf):
    """Detectors of a fitted ensemble with weight, type and fitted flag, and how many readings each flags."""
    from ..operators.detect.ensemble import Ensemble, StatisticalDetector
    from ..operators.detect.iforest import IsolationForestDetector
    f = faulted(spark, sf)
    ens = Ensemble().add_detector(IsolationForestDetector(0.1), 2.0).add_detector(StatisticalDetector(2.5, 1.5), 1.0)
    p = ens.fit(f, label="is_anomaly").predict(f)
    names = F.array(*[F.struct(F.lit(n).alias("detector"), F.col(n).cast("long").alias("flag")) for n in ens.detectors])
    n = p.select(F.inline(names)).groupBy("detector").agg(F.sum("flag").alias("n_flagged"), F.count(F.lit(1)).alias("n_rows"))
    return ens.info(spark).join(n, "detector")


def _per_event(query: Query, **options) -> Query:
    def run(spark, sf):
        return query(spark, sf, readings_per_event, **options)
    run.__doc__ = f"{query.__name__} over one reading per event, one series per user."
    return run


PER_EVENT = {f"{q.__name__}_per_event": _per_event(q) for q in (
    x2_feature_matrix, a1_describe, d3_zscore_any, d8_isolation_forest, d12_ensemble, v9_validation_report,
    d14_chronological_split)}
# every tree draws from the whole table
PER_EVENT["d8_isolation_forest_per_event"] = _per_event(d8_isolation_forest, pools=False)

ORACLE.update({
    "s5_save_reload": sql.S5, "s1_s3_round_trip": sql.S1_S3, "s6_t8_monitor_report": sql.T8, "p7_w1_tagged": sql.P7_W1,
    "p7_w1_tagged_all": sql.P7_W1_ALL, "n4_cross_circuit_pairs": sql.N4_PAIRS,
    "r2_expected_residual": sql.R2, "d10_union_with_forest": sql.D10_FOREST, "d11_label_readings": sql.D11, "d16_ensemble_info": sql.D16, "v10_analysis_tables": sql.V10_TABLES,
    "d13_ensemble_forest": sql.D13, "v10_detailed_analysis": sql.V10,
    "x2_feature_matrix_per_event": sql.per_event(sql.X2), "a1_describe_per_event": sql.per_event(sql.A1),
    "d3_zscore_any_per_event": sql.per_event(sql.D3), "d8_isolation_forest_per_event": sql.per_event(sql.D8_WHOLE),
    "d12_ensemble_per_event": sql.per_event(sql.D12), "v9_validation_report_per_event": sql.per_event(sql.V9),
    "d14_chronological_split_per_event": sql.per_event(sql.D14),
})

QUERIES: dict[str, Query] = {name: PER_EVENT.get(name) or globals()[name] for name in [
    *ORACLE, "d8_isolation_forest", "d11_label_readings", "d13_ensemble_forest",
    "v10_detailed_analysis", "r2_expected_residual", "p2_to_production", "p4_split_day_night",
    "p9_ground_truth_summary", "p10_true_anomalies", "w15_align_sequence_scores"]}
