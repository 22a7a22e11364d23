"""Oracle SQL (DuckDB dialect) for the registered queries.

Written independently of the Spark plans, directly against the driver's tables.
Shared building blocks are CTE texts.  Doubles are rounded to 6 digits on both
sides; counts are BIGINT.
"""

# readings_hourly: events rolled up per (event_type, hour).
HOURLY = """
hourly AS (
  SELECT date_trunc('hour', ts) AS "timestamp",
         round(avg(value), 6) AS "avg", min(value) AS min_v, max(value) AS max_v,
         round(stddev_samp(value), 6) AS stddev_v,
         CASE WHEN event_type IN ('click', 'view') THEN 'domestic' ELSE 'forward' END AS "type",
         event_type AS "ID"
  FROM events GROUP BY ALL
)"""

# X1 over readings_hourly: night flag, minute gap with smallest-mode fill, T_diff.
READINGS = HOURLY + """,
gaps AS (
  SELECT *, CAST(floor(date_diff('microsecond', lag("timestamp") OVER (PARTITION BY "type", "ID" ORDER BY "timestamp"), "timestamp") / 60000000.0) AS BIGINT) AS gap
  FROM hourly
),
gap_counts AS (SELECT "type", "ID", gap, count(*) AS n FROM gaps WHERE gap IS NOT NULL GROUP BY ALL),
gap_mode AS (
  SELECT "type", "ID", gap AS mode_gap FROM (
    SELECT *, row_number() OVER (PARTITION BY "type", "ID" ORDER BY n DESC, gap ASC) AS rn FROM gap_counts)
  WHERE rn = 1
),
readings AS (
  SELECT g."timestamp", g."avg", g.min_v, g.max_v,
         (hour(g."timestamp") * 60 + minute(g."timestamp") >= 1320 OR hour(g."timestamp") * 60 + minute(g."timestamp") < 240) AS nighttime,
         coalesce(g.gap, m.mode_gap) AS time_diff_min,
         g.max_v - g.min_v AS "T_diff", g."type", g."ID"
  FROM gaps g LEFT JOIN gap_mode m USING ("type", "ID")
)"""


def _rewrite_round(sql: str) -> str:
    """round(x, d) -> round(round(x, 9), d): both engines then agree on ties."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 1, j + 6, None
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        arg, digits = sql[j + 6:comma], sql[comma + 1:k - 1].strip()
        out.append(sql[i:j] + f"round(round({_rewrite_round(arg)}, 9), {digits})")
        i = k


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


D2 = with_(HOURLY, """
flags AS (
  SELECT "type", "ID", "timestamp",
    coalesce(abs("avg" - avg("avg") OVER w) > 2 * stddev_samp("avg") OVER w, false) AS f
  FROM hourly WHERE "type" = 'domestic'
  WINDOW w AS (PARTITION BY "type", "ID" ORDER BY "timestamp" ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
),
starts AS (
  SELECT *, CASE WHEN f AND NOT coalesce(lag(f) OVER (PARTITION BY "type", "ID" ORDER BY "timestamp"), false) THEN 1 ELSE 0 END AS s
  FROM flags
),
numbered AS (
  SELECT *, sum(s) OVER (PARTITION BY "type", "ID" ORDER BY "timestamp" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS period_no
  FROM starts
),
runs AS (
  SELECT "type", "ID", CAST(period_no AS BIGINT) AS period_no, min("timestamp") AS start_ts, max("timestamp") AS end_ts,
         count(*) AS n_rows
  FROM numbered WHERE f GROUP BY ALL
)""") + """
SELECT *, strftime(start_ts, '%A') AS start_weekday, strftime(start_ts, '%H:%M') AS start_time,
       strftime(end_ts, '%A') AS end_weekday, strftime(end_ts, '%H:%M') AS end_time
FROM runs
"""


def q(body: str, *ctes: str) -> str:
    return with_(*ctes) + body


# ---------------------------------------------------------------- X1, S7, W3
S7 = q('SELECT * FROM hourly', HOURLY)
X1 = q('SELECT * FROM readings', READINGS)
W3 = q('''
SELECT "type", "ID", gap_seconds, count(*) AS n FROM (
  SELECT "type", "ID", date_diff('microsecond', lag("timestamp") OVER (PARTITION BY "type", "ID" ORDER BY "timestamp"), "timestamp") / 1e6 AS gap_seconds
  FROM hourly) WHERE gap_seconds IS NOT NULL GROUP BY ALL''', HOURLY)

# ---------------------------------------------------------------- D1 / W4 / W5
D1 = q('''
SELECT "type", "ID", "timestamp", "avg",
  round(avg("avg") OVER w, 6) AS avg_rolling_mean, round(stddev_samp("avg") OVER w, 6) AS avg_rolling_std,
  coalesce(abs("avg" - avg("avg") OVER w) > 2 * stddev_samp("avg") OVER w, false) AS anomaly
FROM readings
WINDOW w AS (PARTITION BY "type", "ID" ORDER BY "timestamp" ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)''', READINGS)


def _rolling_time_cols(cols, hours):
    out = []
    for c in cols:
        for h in hours:
            w = f'(PARTITION BY "type", "ID" ORDER BY "timestamp" RANGE BETWEEN INTERVAL {h} HOUR PRECEDING AND CURRENT ROW)'
            out.append(f'avg("{c}") OVER {w} AS {c}_rolling_mean_{h}h')
            out.append(f'CASE WHEN count(*) OVER {w} > 1 THEN stddev_samp("{c}") OVER {w} ELSE 0.0 END AS {c}_rolling_std_{h}h')
    return out


W6W7 = q('SELECT "type", "ID", "timestamp", ' + ", ".join(
    f"round({e.split(' AS ')[0]}, 6) AS {e.split(' AS ')[1]}" for e in _rolling_time_cols(["avg", "T_diff"], [1, 6, 24]))
    + ' FROM readings', READINGS)


def _rate(c, name):
    prev = f'lag("{c}") OVER (PARTITION BY "type", "ID" ORDER BY "timestamp")'
    first = 'row_number() OVER (PARTITION BY "type", "ID" ORDER BY "timestamp") = 1'
    return (f'CASE WHEN {first} THEN 0.0 WHEN time_diff_min > 0 THEN ("{c}" - {prev}) / time_diff_min ELSE 0.0 END AS {c}_{name}')


VALS = ["avg", "min_v", "max_v", "T_diff"]
W8W9 = q('SELECT "type", "ID", "timestamp", ' + ", ".join(
    f"round({_rate(c, n).rsplit(' AS ', 1)[0]}, 6) AS {c}_{n}" for c in VALS for n in ("weighted_change", "rate_per_min"))
    + ' FROM readings', READINGS)

X3 = q('''
SELECT "type", "ID", "timestamp",
  round(sin(2 * pi() * hour("timestamp") / 24), 6) AS hour_sin,
  round(cos(2 * pi() * hour("timestamp") / 24), 6) AS hour_cos,
  CAST(isodow("timestamp") >= 6 AS BIGINT) AS is_weekend,
  CAST(nighttime AS BIGINT) AS is_night,
  CAST((hour("timestamp") BETWEEN 7 AND 9) OR (hour("timestamp") BETWEEN 19 AND 21) AS BIGINT) AS is_peak,
  round(coalesce(last_value(lag24 IGNORE NULLS) OVER (PARTITION BY "type", "ID" ORDER BY "timestamp" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0), 6) AS temp_lag_24h,
  round(ma24, 6) AS temp_ma_24h
FROM (SELECT *, lag("avg", 24) OVER w AS lag24, avg("avg") OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS ma24
      FROM readings WINDOW w AS (PARTITION BY "type", "ID" ORDER BY "timestamp"))''', READINGS)

W13 = q('''
SELECT "type", "ID", "timestamp", "avg", round("avg" - (SELECT avg("avg") FROM readings), 6) AS avg_deviation
FROM readings WHERE "type" = 'domestic' ''', READINGS)

W14 = q('''
SELECT "type", "ID", "timestamp", seq AS "sequence" FROM (
  SELECT *, list("avg") OVER w AS seq, count(*) OVER w AS n FROM readings
  WINDOW w AS (PARTITION BY "type", "ID" ORDER BY "timestamp" ROWS BETWEEN 23 PRECEDING AND CURRENT ROW))
WHERE n = 24''', READINGS)

W16 = q('''
SELECT g."type", g."ID", g."timestamp" FROM (
  SELECT "type", "ID", unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS "timestamp"
  FROM (SELECT "type", "ID", min("timestamp") AS lo, max("timestamp") AS hi FROM readings GROUP BY ALL)) g
ANTI JOIN readings r ON g."type" = r."type" AND g."ID" = r."ID" AND g."timestamp" = r."timestamp"''', READINGS)

W16_OUTAGES = q('''
SELECT "type", "ID", prev + INTERVAL 1 HOUR AS first_slot, "timestamp" - INTERVAL 1 HOUR AS last_slot,
  CAST(date_diff('hour', prev, "timestamp") - 1 AS BIGINT) AS n_slots
FROM (SELECT *, lag("timestamp") OVER (PARTITION BY "type", "ID" ORDER BY "timestamp") AS prev
      FROM (SELECT DISTINCT "type", "ID", date_trunc('hour', "timestamp") AS "timestamp" FROM readings))
WHERE date_diff('hour', prev, "timestamp") > 1''', READINGS)
W16_OUTAGES_EVENT = W16_OUTAGES.replace(READINGS.strip(), """readings AS (
  SELECT 'domestic' AS "type", CAST(user_id AS VARCHAR) AS "ID", ts AS "timestamp" FROM events)""")

FCAL = q('''
SELECT "type", "ID", "timestamp",
  CAST(hour("timestamp") AS BIGINT) AS hour, CAST(month("timestamp") AS BIGINT) AS month,
  CAST(isodow("timestamp") - 1 AS BIGINT) AS day_of_week, isodow("timestamp") >= 6 AS is_weekend,
  strftime("timestamp", '%A') AS day_name, CAST("timestamp" AS DATE) AS date, strftime("timestamp", '%H:%M') AS hhmm,
  round(sin(2 * pi() * hour("timestamp") / 24), 6) AS hour_sin, round(cos(2 * pi() * hour("timestamp") / 24), 6) AS hour_cos,
  CAST((hour("timestamp") BETWEEN 7 AND 9) OR (hour("timestamp") BETWEEN 19 AND 21) AS BIGINT) AS is_peak,
  (hour("timestamp") * 60 + minute("timestamp") >= 1320 OR hour("timestamp") * 60 + minute("timestamp") < 240) AS night_eda,
  (hour("timestamp") * 60 + minute("timestamp") >= 1380 OR hour("timestamp") * 60 + minute("timestamp") < 360) AS night_generator
FROM readings''', READINGS)

F8 = q('''
SELECT "type", "ID", "timestamp", coalesce("type" = 'domestic', false) AS type_domestic,
  coalesce("type" = 'forward', false) AS type_forward, "type" IS NULL AS type_nan FROM readings''', READINGS)


def _div(a, b):
    return f"({a}) / nullif({b}, 0)"


F9 = q('SELECT "type", "ID", "timestamp", ' + ", ".join([
    f'round({_div(chr(34) + "avg" + chr(34), "max_v + 1e-8")}, 6) AS avg_to_max_ratio',
    f'round({_div(chr(34) + "avg" + chr(34), "min_v + 1e-8")}, 6) AS avg_to_min_ratio',
    f'round({_div(chr(34) + "T_diff" + chr(34), chr(34) + "avg" + chr(34) + " + 1e-8")}, 6) AS range_to_avg_ratio',
    f'round({_div(chr(34) + "T_diff" + chr(34), "max_v + 1e-8")}, 6) AS temp_range_normalized',
    f'round({_div("1.0", chr(34) + "T_diff" + chr(34) + " + 1e-8")}, 6) AS temp_stability']) + ' FROM readings', READINGS)

F10 = q('''
SELECT "type", "ID", "timestamp", time_diff_min,
  round(time_diff_min / nullif(p.med, 0), 6) AS time_diff_normalized,
  round(abs(time_diff_min - p.med), 6) AS time_diff_deviation,
  round(abs((time_diff_min - p.mean) / (p.sd + 1e-8)), 6) AS time_diff_z_score
FROM readings, (SELECT quantile_cont(time_diff_min, 0.5) AS med, avg(time_diff_min) AS mean, stddev_samp(time_diff_min) AS sd FROM readings) p''', READINGS)

F12 = q('SELECT "type", "ID", "timestamp", ' + ", ".join(
    f'round(abs((coalesce("{c}", m.med_{c}) - s.mean_{c}) / nullif(s.sd_{c}, 0)), 6) AS {c}_z' for c in VALS) + '''
FROM readings, m, s''', READINGS,
    "m AS (SELECT " + ", ".join(f'quantile_cont("{c}", 0.5) AS med_{c}' for c in VALS) + " FROM readings)",
    "s AS (SELECT " + ", ".join(f'avg(coalesce("{c}", m.med_{c})) AS mean_{c}, stddev_pop(coalesce("{c}", m.med_{c})) AS sd_{c}'
                                for c in VALS) + " FROM readings, m)")

F13 = q('''
SELECT "type", "ID", "timestamp",
  round(("avg" - p.ma) / CASE WHEN coalesce(p.sa, 0) = 0 THEN 1.0 ELSE p.sa END, 6) AS "avg",
  round(("T_diff" - p.mt) / CASE WHEN coalesce(p.st, 0) = 0 THEN 1.0 ELSE p.st END, 6) AS "T_diff"
FROM readings, (SELECT avg("avg") AS ma, stddev_pop("avg") AS sa, avg("T_diff") AS mt, stddev_pop("T_diff") AS st FROM readings) p''', READINGS)

F14 = q('''
SELECT "type", "ID", "timestamp",
  round(CASE WHEN p.hi = p.lo THEN 0.0 ELSE ("avg" - p.lo) / (p.hi - p.lo) END, 6) AS avg_norm
FROM readings, (SELECT min("avg") AS lo, max("avg") AS hi FROM readings) p''', READINGS)

# ---------------------------------------------------------------- X2 (domestic rows)


def _x2_sql():
    hours = [1, 6, 24]
    inner = ['"timestamp"', '"type"', '"ID"', '"avg"', 'min_v', 'max_v', 'nighttime', 'time_diff_min', '"T_diff"',
             'CAST(hour("timestamp") AS BIGINT) AS hour', 'CAST(isodow("timestamp") - 1 AS BIGINT) AS day_of_week',
             'CAST(month("timestamp") AS BIGINT) AS month', 'isodow("timestamp") >= 6 AS is_weekend',
             "coalesce(\"type\" = 'domestic', false) AS type_domestic", '"type" IS NULL AS type_nan']
    cols = ["avg", "min_v", "max_v", "nighttime", "time_diff_min", "T_diff", "hour", "day_of_week", "month",
            "is_weekend", "type_domestic", "type_nan"]
    roll = _rolling_time_cols(VALS, hours)
    inner += roll
    for c in VALS:
        for h in hours:
            cols += [f"{c}_rolling_mean_{h}h", f"{c}_rolling_std_{h}h"]
        inner.append(_rate(c, "weighted_change"))
        cols.append(f"{c}_weighted_change")
    inner += ['time_diff_min / nullif(g.med, 0) AS time_diff_normalized', 'abs(time_diff_min - g.med) AS time_diff_deviation',
              'abs((time_diff_min - g.mean) / (g.sd + 1e-8)) AS time_diff_z_score']
    cols += ["time_diff_normalized", "time_diff_deviation", "time_diff_z_score"]
    for c in VALS:
        inner.append(_rate(c, "rate_per_min"))
        cols.append(f"{c}_rate_per_min")
    inner += [f'{_div(chr(34) + "avg" + chr(34), "max_v + 1e-8")} AS avg_to_max_ratio',
              f'{_div(chr(34) + "avg" + chr(34), "min_v + 1e-8")} AS avg_to_min_ratio',
              f'{_div(chr(34) + "T_diff" + chr(34), chr(34) + "avg" + chr(34) + " + 1e-8")} AS range_to_avg_ratio',
              f'{_div(chr(34) + "T_diff" + chr(34), "max_v + 1e-8")} AS temp_range_normalized',
              f'{_div("1.0", chr(34) + "T_diff" + chr(34) + " + 1e-8")} AS temp_stability']
    cols += ["avg_to_max_ratio", "avg_to_min_ratio", "range_to_avg_ratio", "temp_range_normalized", "temp_stability"]
    w = 'OVER (PARTITION BY "type", "ID" ORDER BY "timestamp" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)'
    outer = []
    for c in cols:
        if c in ("is_weekend", "type_domestic", "type_nan", "nighttime"):
            outer.append(f'coalesce(last_value({c} IGNORE NULLS) {w}, false) AS {c}')
        elif c in ("hour", "day_of_week", "month", "time_diff_min"):
            outer.append(f'coalesce(last_value({c} IGNORE NULLS) {w}, 0) AS {c}')
        else:
            outer.append(f'round(coalesce(last_value("{c}" IGNORE NULLS) {w}, 0), 6) AS "{c}"')
    body = ('SELECT "timestamp", "type", "ID", ' + ", ".join(outer) + " FROM (SELECT " + ", ".join(inner)
            + " FROM dom, (SELECT quantile_cont(time_diff_min, 0.5) AS med, avg(time_diff_min) AS mean, "
              "stddev_samp(time_diff_min) AS sd FROM dom) g)")
    return q(body, READINGS, "dom AS (SELECT * FROM readings WHERE \"type\" = 'domestic')")


X2 = _x2_sql()

# ---------------------------------------------------------------- A1-A4


def _describe(by):
    sel = []
    for c in VALS:
        g = (", ".join(f'"{b}"' for b in by) + ", ") if by else ""
        sel.append(f'''SELECT {g}'{c}' AS "column", count("{c}") AS "count", avg("{c}") AS mean, stddev_samp("{c}") AS std,
          CAST(min("{c}") AS DOUBLE) AS "min", quantile_cont("{c}", 0.25) AS q25, quantile_cont("{c}", 0.5) AS q50,
          quantile_cont("{c}", 0.75) AS q75, CAST(max("{c}") AS DOUBLE) AS "max" FROM readings {"GROUP BY ALL" if by else ""}''')
    body = " UNION ALL ".join(sel)
    cols = ", ".join(f'"{b}"' for b in by) + (", " if by else "")
    return q(f'''SELECT {cols}"column", "count", round(mean, 6) AS mean, round(std, 6) AS std, "min",
      round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75, "max" FROM ({body})''', READINGS)


A1 = _describe([])
A1_NIGHT = _describe(["nighttime"])
A2 = q('SELECT DISTINCT "type" FROM hourly', HOURLY)
A3 = q('SELECT count(*) AS n_rows, min("timestamp") AS first_ts, max("timestamp") AS last_ts, CAST(9 AS BIGINT) AS n_columns FROM readings', READINGS)
A4 = q('SELECT "type", count(*) AS n FROM readings GROUP BY ALL', READINGS)

# ---------------------------------------------------------------- D3, D4, D5
D3 = q('SELECT "type", "ID", "timestamp", ' + ", ".join(
    f'round(abs((coalesce("{c}", m.med_{c}) - s.mean_{c}) / nullif(s.sd_{c}, 0)), 6) AS {c}_z' for c in VALS)
    + ', ' + " OR ".join(f'coalesce(abs((coalesce("{c}", m.med_{c}) - s.mean_{c}) / nullif(s.sd_{c}, 0)) > 3, false)' for c in VALS)
    + ' AS statistical_anomaly FROM dom, m, s', READINGS,
    "dom AS (SELECT * FROM readings WHERE \"type\" = 'domestic')",
    "m AS (SELECT " + ", ".join(f'quantile_cont("{c}", 0.5) AS med_{c}' for c in VALS) + " FROM dom)",
    "s AS (SELECT " + ", ".join(f'avg(coalesce("{c}", m.med_{c})) AS mean_{c}, stddev_pop(coalesce("{c}", m.med_{c})) AS sd_{c}'
                                for c in VALS) + " FROM dom, m)")

D4_FLAGS = '''coalesce(("avg" < -10) OR ("avg" > 100), false) AS rule_avg_range,
  coalesce(min_v > max_v, false) AS rule_min_gt_max,
  coalesce(("T_diff" < 0) OR ("T_diff" > 50), false) AS rule_spread_range'''
D4 = q(f'''SELECT "type", "ID", "timestamp", *, rule_avg_range OR rule_min_gt_max OR rule_spread_range AS domain_anomaly
FROM (SELECT "type", "ID", "timestamp", {D4_FLAGS} FROM readings)''', READINGS).replace(
    'SELECT "type", "ID", "timestamp", *,', 'SELECT *,')

D5 = q('''
SELECT "type", "ID", round(avg("avg"), 6) AS mean, round(stddev_pop("avg"), 6) AS std,
  round(quantile_cont("avg", 0.25), 6) AS q1, round(quantile_cont("avg", 0.75), 6) AS q3,
  round(quantile_cont("avg", 0.75) - quantile_cont("avg", 0.25), 6) AS iqr, CAST(3.0 AS DOUBLE) AS z_threshold, CAST(1.5 AS DOUBLE) AS iqr_multiplier
FROM readings GROUP BY ALL''', READINGS)

# ---------------------------------------------------------------- R1 fault injection


def _u(salt):
    return (f"(('0x' || substr(md5(concat_ws(':', '42', k, CAST(us AS VARCHAR), '{salt}')), 1, 8))::BIGINT / 4294967296.0)")


FAULTED = READINGS + f""",
fk AS (SELECT *, "type" || '|' || "ID" AS k, epoch_us("timestamp") AS us FROM readings),
fh AS (SELECT *, {_u('pick')} AS h, floor({_u('kind')} * 3) AS kind, {_u('size')} AS u3, {_u('min')} AS u4, {_u('max')} AS u5 FROM fk),
fr AS (SELECT *, row_number() OVER (ORDER BY h, k, us) - 1 < floor(count(*) OVER () * 0.05) AS is_anomaly FROM fh),
fa AS (SELECT *, CASE WHEN kind = 0 THEN "avg" + 15.0 + u3 * 10.0 WHEN kind = 1 THEN "avg" - (10.0 + u3 * 10.0)
                      ELSE "avg" * (0.5 + u3 * 1.0) END AS new_avg FROM fr),
faulted AS (
  SELECT "timestamp",
    CASE WHEN is_anomaly THEN new_avg ELSE "avg" END AS "avg",
    CASE WHEN is_anomaly THEN new_avg - (3.0 + u4 * 5.0) ELSE min_v END AS min_v,
    CASE WHEN is_anomaly THEN new_avg + (3.0 + u5 * 7.0) ELSE max_v END AS max_v,
    nighttime, time_diff_min,
    CASE WHEN is_anomaly THEN (new_avg + (3.0 + u5 * 7.0)) - (new_avg - (3.0 + u4 * 5.0)) ELSE "T_diff" END AS "T_diff",
    "type", "ID", is_anomaly,
    CASE WHEN NOT is_anomaly THEN 'normal' WHEN kind = 0 THEN 'overheat' WHEN kind = 1 THEN 'underheat' ELSE 'sensor_error' END AS anomaly_type
  FROM fa
)"""

R1 = with_(FAULTED) + '''SELECT "timestamp", round("avg", 6) AS "avg", round(min_v, 6) AS min_v, round(max_v, 6) AS max_v,
  nighttime, time_diff_min, round("T_diff", 6) AS "T_diff", "type", "ID", is_anomaly, anomaly_type FROM faulted'''

# ---------------------------------------------------------------- D6/D7 + D1 ratio + D12 ensemble on faulted
SCORED = FAULTED + """,
bp AS (SELECT avg("avg") AS mean, stddev_pop("avg") AS std, quantile_cont("avg", 0.25) AS q1, quantile_cont("avg", 0.75) AS q3
       FROM faulted WHERE NOT is_anomaly),
s1 AS (
  SELECT f.*,
    abs(("avg" - bp.mean) / nullif(bp.std, 0)) AS z,
    coalesce(("avg" < bp.q1 - 1.5 * (bp.q3 - bp.q1)) OR ("avg" > bp.q3 + 1.5 * (bp.q3 - bp.q1)), false) AS iqr_out,
    abs("avg" - avg("avg") OVER w) AS dev, stddev_samp("avg") OVER w AS rsd
  FROM faulted f, bp
  WINDOW w AS (PARTITION BY "type", "ID" ORDER BY "timestamp" ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
),
s2 AS (
  SELECT *, CAST(coalesce(z > 2.5, false) OR iqr_out AS INTEGER) AS statistical,
    z / 2.5 + CAST(iqr_out AS DOUBLE) AS statistical_score,
    coalesce(dev > 2 * rsd, false) AS anomaly, dev / nullif(rsd, 0) AS anomaly_ratio
  FROM s1
),
mm AS (SELECT min(statistical_score) AS lo1, max(statistical_score) AS hi1, min(anomaly_ratio) AS lo2, max(anomaly_ratio) AS hi2 FROM s2),
scored AS (
  SELECT s2.*, 0.0 + 0.5 * coalesce(CASE WHEN hi1 = lo1 THEN 0.0 ELSE (statistical_score - lo1) / (hi1 - lo1) END, 0.0)
               + 0.5 * coalesce(CASE WHEN hi2 = lo2 THEN 0.0 ELSE (anomaly_ratio - lo2) / (hi2 - lo2) END, 0.0) AS ensemble_score
  FROM s2, mm
),
pred AS (SELECT *, CAST(ensemble_score > 0.5 AS INTEGER) AS ensemble FROM scored)"""

D12 = with_(SCORED) + '''SELECT "type", "ID", "timestamp", is_anomaly, anomaly_type, statistical, round(statistical_score, 6) AS statistical_score,
  anomaly, round(anomaly_ratio, 6) AS anomaly_ratio, round(ensemble_score, 6) AS ensemble_score, ensemble FROM pred'''

_CONF = '''count_if(is_anomaly AND ensemble = 1) AS true_positives, count_if(NOT is_anomaly AND ensemble = 1) AS false_positives,
  count_if(is_anomaly AND ensemble = 0) AS false_negatives, count_if(NOT is_anomaly AND ensemble = 0) AS true_negatives'''


def _metrics(tp="true_positives", fp="false_positives", fn="false_negatives", tn="true_negatives"):
    return f'''round(coalesce({tp}::DOUBLE / nullif({tp} + {fp}, 0), 0.0), 6) AS precision,
  round(coalesce({tp}::DOUBLE / nullif({tp} + {fn}, 0), 0.0), 6) AS recall,
  round(coalesce(2.0 * {tp} / nullif(2 * {tp} + {fp} + {fn}, 0), 0.0), 6) AS f1_score,
  round(coalesce(({tp} + {tn})::DOUBLE / nullif({tp} + {tn} + {fp} + {fn}, 0), 0.0), 6) AS accuracy'''


V9 = with_(SCORED) + f'''SELECT *, {_metrics()}, true_positives AS correct_detections, false_negatives AS missed_anomalies,
  false_positives AS false_alarms,
  coalesce(true_positives::DOUBLE / nullif(true_positives + false_negatives, 0), 0.0) >= 0.7 AS validation_passed
FROM (SELECT count(*) AS batch_size, {_CONF}, count_if(is_anomaly) AS injected_anomalies,
  count_if(ensemble = 1) AS detected_anomalies FROM pred)'''

V3 = with_(SCORED) + f'''SELECT detector, true_positives, false_positives, false_negatives, true_negatives, detected,
  {_metrics()}, true_positives AS correct FROM (
  SELECT detector, count_if(is_anomaly AND p) AS true_positives, count_if(NOT is_anomaly AND p) AS false_positives,
    count_if(is_anomaly AND NOT p) AS false_negatives, count_if(NOT is_anomaly AND NOT p) AS true_negatives, count_if(p) AS detected
  FROM (SELECT is_anomaly, 'statistical' AS detector, statistical = 1 AS p FROM pred
        UNION ALL SELECT is_anomaly, 'anomaly', anomaly FROM pred
        UNION ALL SELECT is_anomaly, 'ensemble', ensemble = 1 FROM pred) GROUP BY ALL)'''

V5 = with_(SCORED) + '''SELECT anomaly_type, count(*) AS total, count_if(ensemble = 1) AS detected,
  round(count_if(ensemble = 1)::DOUBLE / count(*), 6) AS detection_rate FROM pred WHERE is_anomaly GROUP BY ALL'''
V6 = with_(SCORED) + 'SELECT anomaly_type, count(*) AS n FROM pred WHERE is_anomaly AND ensemble = 0 GROUP BY ALL'
V7 = with_(SCORED) + '''SELECT "type", "ID", "timestamp", round("avg", 6) AS "avg",
  CAST(CASE WHEN is_anomaly AND ensemble = 1 THEN 3 WHEN is_anomaly THEN 1 WHEN ensemble = 1 THEN 4 ELSE 0 END AS INTEGER) AS status,
  CASE WHEN is_anomaly AND ensemble = 1 THEN 'correct' WHEN is_anomaly THEN 'missed' WHEN ensemble = 1 THEN 'false_alarm' ELSE 'normal' END AS outcome
FROM pred'''
V8 = with_(SCORED) + f'''SELECT *, {_metrics()}, CAST(0.7 AS DOUBLE) AS recall_threshold,
  coalesce(true_positives::DOUBLE / nullif(true_positives + false_negatives, 0), 0.0) >= 0.7 AS validation_passed
FROM (SELECT {_CONF} FROM pred)'''
V2 = with_(SCORED) + f'''SELECT *, {_metrics()} FROM (SELECT {_CONF.replace('ensemble = ', 'statistical = ')} FROM pred)'''

D14 = q('''SELECT "type", "ID", "timestamp",
  row_number() OVER (ORDER BY "timestamp", "type", "ID") - 1 < floor(count(*) OVER () * 0.8) AS is_train,
  row_number() OVER (PARTITION BY "type", "ID" ORDER BY "timestamp") - 1 < floor(count(*) OVER (PARTITION BY "type", "ID") * 0.8) AS is_train_series
FROM readings''', READINGS)

D15 = with_(SCORED) + '''SELECT "type", "ID", "timestamp", round(statistical_score, 6) AS statistical_score,
  coalesce(statistical_score > (SELECT quantile_cont(statistical_score, 0.95) FROM pred WHERE NOT is_anomaly), false) AS statistical_score_flag
FROM pred'''

A17 = with_(FAULTED) + '''SELECT round(avg(CAST(is_anomaly AS DOUBLE)), 6) AS anomaly_rate, CAST(0.05 AS DOUBLE) AS target_rate,
  abs(avg(CAST(is_anomaly AS DOUBLE)) - 0.05) <= 0.02 AS within_tolerance FROM faulted'''

J2 = with_(FAULTED) + '''SELECT coalesce(a.hour, b.hour) AS hour, round(a.real_mean, 6) AS real_mean, round(b.synthetic_mean, 6) AS synthetic_mean,
  round(b.synthetic_mean - a.real_mean, 6) AS difference
FROM (SELECT CAST(hour("timestamp") AS BIGINT) AS hour, avg("avg") AS real_mean FROM readings GROUP BY ALL) a
FULL OUTER JOIN (SELECT CAST(hour("timestamp") AS BIGINT) AS hour, avg("avg") AS synthetic_mean FROM faulted GROUP BY ALL) b
ON a.hour = b.hour'''

J3 = with_(SCORED) + '''SELECT p."type", p."ID", p."timestamp", p.ensemble, f.is_anomaly, f.anomaly_type
FROM (SELECT "type", "ID", "timestamp", ensemble FROM pred) p
JOIN (SELECT "type", "ID", "timestamp", is_anomaly, anomaly_type FROM faulted) f
ON p."type" = f."type" AND p."ID" = f."ID" AND p."timestamp" = f."timestamp"'''

# ---------------------------------------------------------------- labeled flags (D1, D3, D4, D7) and A5-A16
LABELED = READINGS + """,
m AS (SELECT """ + ", ".join(f'quantile_cont("{c}", 0.5) AS med_{c}' for c in VALS) + """ FROM readings),
s AS (SELECT """ + ", ".join(f'avg(coalesce("{c}", m.med_{c})) AS mean_{c}, stddev_pop(coalesce("{c}", m.med_{c})) AS sd_{c}'
                             for c in VALS) + """ FROM readings, m),
bp AS (SELECT avg("avg") AS mean, stddev_pop("avg") AS std, quantile_cont("avg", 0.25) AS q1, quantile_cont("avg", 0.75) AS q3 FROM readings),
lf AS (
  SELECT r.*,
    coalesce(abs("avg" - avg("avg") OVER w) > 2 * stddev_samp("avg") OVER w, false) AS rolling_anomaly,
    """ + " OR ".join(f'coalesce(abs((coalesce("{c}", m.med_{c}) - s.mean_{c}) / nullif(s.sd_{c}, 0)) > 3, false)' for c in VALS) + """ AS statistical_anomaly,
    coalesce(("avg" < -10) OR ("avg" > 100), false) OR coalesce(min_v > max_v, false) OR coalesce(("T_diff" < 0) OR ("T_diff" > 50), false) AS domain_anomaly,
    coalesce(abs(("avg" - bp.mean) / nullif(bp.std, 0)) > 3, false)
      OR coalesce(("avg" < bp.q1 - 1.5 * (bp.q3 - bp.q1)) OR ("avg" > bp.q3 + 1.5 * (bp.q3 - bp.q1)), false) AS baseline_anomaly
  FROM readings r, m, s, bp
  WINDOW w AS (PARTITION BY "type", "ID" ORDER BY "timestamp" ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
),
labeled AS (SELECT *, rolling_anomaly OR statistical_anomaly OR domain_anomaly OR baseline_anomaly AS is_anomaly FROM lf)"""

D10 = with_(LABELED) + 'SELECT "type", "ID", "timestamp", rolling_anomaly, statistical_anomaly, domain_anomaly, baseline_anomaly, is_anomaly FROM labeled'
A5 = with_(LABELED) + '''SELECT count(*) AS n_rows, CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS n_anomalies,
  round(avg(CAST(is_anomaly AS INTEGER)), 6) AS anomaly_rate, count(*) - CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS n_normal FROM labeled'''
A6 = with_(LABELED) + '''SELECT "type", CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS n_anomalies, count(*) AS n_rows,
  round_even(round(avg(CAST(is_anomaly AS INTEGER)), 9), 3) AS anomaly_rate FROM labeled GROUP BY ALL'''
A7 = with_(LABELED) + " UNION ALL ".join(
    f'''SELECT '{f}' AS detector, CAST(sum(CAST({f} AS INTEGER)) AS BIGINT) AS n_flagged, round(avg(CAST({f} AS INTEGER)), 6) AS rate,
  '{f.replace("_", " ").title()}' AS label FROM labeled''' for f in ("rolling_anomaly", "statistical_anomaly", "domain_anomaly", "baseline_anomaly"))
A8 = with_(LABELED) + '''SELECT CAST(hour("timestamp") AS BIGINT) AS hour, CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS n_anomalies,
  round_even(round(avg(CAST(is_anomaly AS INTEGER)), 9), 3) AS anomaly_rate FROM labeled GROUP BY ALL'''
A8_ARGMAX = with_(LABELED) + ''', hp AS (SELECT CAST(hour("timestamp") AS BIGINT) AS hour, CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS n_anomalies,
  round_even(round(avg(CAST(is_anomaly AS INTEGER)), 9), 3) AS anomaly_rate FROM labeled GROUP BY ALL)
SELECT (SELECT hour FROM hp ORDER BY n_anomalies DESC, hour LIMIT 1) AS hour_most, (SELECT max(n_anomalies) FROM hp) AS most_anomalies,
  (SELECT hour FROM hp ORDER BY anomaly_rate DESC, hour LIMIT 1) AS hour_highest_rate, (SELECT max(anomaly_rate) FROM hp) AS highest_rate'''
A9 = with_(LABELED) + '''SELECT strftime("timestamp", '%A') AS day_of_week, CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS n_anomalies,
  round_even(round(avg(CAST(is_anomaly AS INTEGER)), 9), 3) AS anomaly_rate FROM labeled GROUP BY ALL'''
A10 = with_(LABELED) + '''SELECT CAST("timestamp" AS DATE) AS date, round(avg(CAST(is_anomaly AS INTEGER)), 6) AS anomaly_rate FROM labeled GROUP BY ALL'''
A11 = with_(LABELED) + '''SELECT is_anomaly, round(avg("avg"), 6) AS mean_temp, min("avg") AS min_temp, max("avg") AS max_temp, count(*) AS n_rows
FROM labeled GROUP BY ALL'''
A12 = with_(LABELED) + '''SELECT nighttime, CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS n_anomalies, round(avg(CAST(is_anomaly AS INTEGER)), 6) AS anomaly_rate
FROM labeled GROUP BY ALL'''
_NF = 'CAST(rolling_anomaly AS INTEGER) + CAST(statistical_anomaly AS INTEGER) + CAST(domain_anomaly AS INTEGER)'
A13 = with_(LABELED) + f'SELECT count_if({_NF} > 1) AS multiple_detectors, count_if({_NF} = 1) AS single_detector FROM labeled'


def _a14():
    names = ["rolling", "statistical", "domain"]
    flags = ["rolling_anomaly", "statistical_anomaly", "domain_anomaly"]
    parts = []
    for mask in range(1, 8):
        on = [bool(mask >> (2 - i) & 1) for i in range(3)]
        label = " + ".join(n for n, o in zip(names, on) if o) if sum(on) < 3 else "all three"
        if sum(on) == 1:
            label = f"only {label}"
        cond = " AND ".join(f if o else f"NOT {f}" for f, o in zip(flags, on))
        parts.append(f"SELECT '{label}' AS combination, count_if({cond}) AS n FROM labeled")
    return with_(LABELED) + " UNION ALL ".join(parts)


A14 = _a14()
A15 = with_(LABELED) + ''', rg AS (SELECT min("avg") AS lo, max("avg") AS hi FROM labeled),
hb AS (SELECT is_anomaly, CAST(CASE WHEN (hi - lo) / 50 = 0 THEN 0 ELSE least(floor(("avg" - lo) / ((hi - lo) / 50)), 49) END AS BIGINT) AS bin, lo, hi
       FROM labeled, rg WHERE "avg" IS NOT NULL)
SELECT is_anomaly, bin, count(*) AS n, round(lo + bin * ((hi - lo) / 50), 6) AS bin_start, round(lo + (bin + 1) * ((hi - lo) / 50), 6) AS bin_end,
  round(count(*) / (any_value(tot) * ((hi - lo) / 50)), 9) AS density
FROM hb JOIN (SELECT is_anomaly, count(*) AS tot FROM labeled WHERE "avg" IS NOT NULL GROUP BY ALL) t USING (is_anomaly)
GROUP BY is_anomaly, bin, lo, hi'''
A16 = q('SELECT CAST(hour("timestamp") AS BIGINT) AS hour, round(avg("avg"), 6) AS mean FROM readings GROUP BY ALL', READINGS)

W12 = with_(LABELED) + ''', st AS (
  SELECT *, CASE WHEN domain_anomaly AND NOT coalesce(lag(domain_anomaly) OVER (PARTITION BY "type", "ID" ORDER BY "timestamp"), false) THEN 1 ELSE 0 END AS s
  FROM labeled WHERE "type" = 'forward'),
nb AS (SELECT *, sum(s) OVER (PARTITION BY "type", "ID" ORDER BY "timestamp" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS period_no FROM st),
runs AS (SELECT "type", "ID", CAST(period_no AS BIGINT) AS period_no, min("timestamp") AS start_ts, max("timestamp") AS end_ts, count(*) AS n_rows
         FROM nb WHERE domain_anomaly GROUP BY ALL)
SELECT *, strftime(start_ts, '%A') AS start_weekday, strftime(start_ts, '%H:%M') AS start_time,
  strftime(end_ts, '%A') AS end_weekday, strftime(end_ts, '%H:%M') AS end_time FROM runs'''

U1 = X1
U2 = with_(LABELED) + '''SELECT "type", "ID", "timestamp", 'statistical_and_domain' AS row_set FROM labeled WHERE statistical_anomaly AND domain_anomaly
UNION ALL SELECT "type", "ID", "timestamp", 'statistical_not_domain' FROM labeled WHERE statistical_anomaly AND NOT domain_anomaly'''

# ---------------------------------------------------------------- N1-N4
N1 = q('''SELECT "type", "ID", "timestamp", coalesce(g.gap > m.mode_gap, false) AS gap_warning
FROM gaps g LEFT JOIN gap_mode m USING ("type", "ID")''', READINGS)
N2 = q('SELECT "type", "ID", "timestamp", "avg" IS NULL OR coalesce("avg" <= 0, false) AS sensor_fault FROM readings', READINGS)
N3 = q('SELECT "type", "ID", "timestamp", coalesce("T_diff" > 10 AND time_diff_min > 15, false) AS interval_swing FROM readings', READINGS)
_N4_DROPS = """
per AS (
  SELECT g."type", g."ID", g.bucket, g.m, coalesce(o.m - g.m > 10, false) AS low
  FROM (SELECT "type", "ID", date_trunc('hour', "timestamp") AS bucket, avg("avg") AS m FROM readings GROUP BY ALL) g
  JOIN (SELECT "type", "ID", avg("avg") AS m FROM readings GROUP BY ALL) o ON g."type" = o."type" AND g."ID" = o."ID")"""
N4 = q('''
SELECT a."type", a."ID", a.bucket, round(a.m, 6) AS mean, coalesce(count_if(b.low), 0) AS n_also_dropped,
  coalesce(count_if(NOT b.low), 0) AS n_not_dropped,
  CASE WHEN coalesce(count_if(b.low), 0) > 0 THEN 'shared' WHEN coalesce(count_if(NOT b.low), 0) > 0 THEN 'own' ELSE 'single' END AS diagnosis
FROM per a LEFT JOIN per b ON a."type" = b."type" AND a.bucket = b.bucket AND a."ID" <> b."ID"
WHERE a.low GROUP BY a."type", a."ID", a.bucket, a.m''', READINGS, _N4_DROPS)

W10 = q('''SELECT "type", "ID", "timestamp", "avg", lag("avg", 1) OVER w AS lag_1, lag("avg", 24) OVER w AS lag_24
FROM readings WINDOW w AS (PARTITION BY "type", "ID" ORDER BY "timestamp")''', READINGS)


for _name, _val in list(globals().items()):
    if _name.isupper() and isinstance(_val, str) and _name not in ("HOURLY", "READINGS", "FAULTED", "SCORED", "LABELED", "VALS"):
        globals()[_name] = _rewrite_round(_val)

# ---------------------------------------------------------------- streaming (the whole finite input)
T1 = _rewrite_round('''
SELECT * FROM (
  SELECT event_type, date_trunc('hour', ts) AS "timestamp", round(avg(value), 6) AS "avg", min(value) AS min_v,
    max(value) AS max_v, round(stddev_samp(value), 6) AS stddev_v
  FROM events GROUP BY 1, 2)''')

T9 = 'SELECT event_id, ts, event_type, value FROM events'

_STREAM_SERIES = '''
WITH ev AS (SELECT 'domestic' AS "type", CAST(user_id AS VARCHAR) AS "ID", ts AS "timestamp", value AS "avg" FROM events),
f AS (
  SELECT *, CAST(floor(date_diff('microsecond', lag("timestamp") OVER w, "timestamp") / 60000000.0) AS BIGINT) AS time_diff_min,
    avg("avg") OVER w24 AS rm, stddev_samp("avg") OVER w24 AS rs, lag("avg") OVER w AS pa, row_number() OVER w AS rn
  FROM ev WINDOW w AS (PARTITION BY "type", "ID" ORDER BY "timestamp"),
                 w24 AS (PARTITION BY "type", "ID" ORDER BY "timestamp" ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
),
g AS (SELECT *, coalesce(abs("avg" - rm) > 2 * rs, false) AS anomaly,
        CASE WHEN rn = 1 THEN 0.0 WHEN time_diff_min > 0 THEN ("avg" - pa) / time_diff_min ELSE 0.0 END AS rate
      FROM f),
g2 AS (SELECT *, CASE WHEN anomaly AND NOT coalesce(lag(anomaly) OVER (PARTITION BY "type", "ID" ORDER BY "timestamp"), false)
                       THEN 1 ELSE 0 END AS st FROM g),
h AS (SELECT *, sum(st) OVER (PARTITION BY "type", "ID" ORDER BY "timestamp" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pno,
             max("timestamp") OVER (PARTITION BY "type", "ID") AS last_ts
      FROM g2)
'''
T5T6 = _rewrite_round(_STREAM_SERIES + '''
SELECT "type", "ID", "timestamp", "avg", time_diff_min, round(rate, 6) AS avg_rate_per_min, round(rm, 6) AS avg_rolling_mean,
  round(rs, 6) AS avg_rolling_std, anomaly, CASE WHEN anomaly THEN CAST(pno AS BIGINT) END AS period_no FROM h''')
T7 = _STREAM_SERIES + '''
SELECT "type", "ID", CAST(pno AS BIGINT) AS period_no, min("timestamp") AS start_ts, max("timestamp") AS end_ts, count(*) AS n_rows
FROM h WHERE anomaly GROUP BY "type", "ID", pno'''

T2T3 = _rewrite_round(HOURLY.replace("hourly AS (", "WITH hourly AS (", 1) + ''',
bp AS (SELECT avg("avg") AS mean, stddev_pop("avg") AS std, quantile_cont("avg", 0.25) AS q1, quantile_cont("avg", 0.75) AS q3 FROM hourly),
closed AS (
  SELECT * FROM (
    SELECT event_type, date_trunc('hour', ts) AS "timestamp", avg(value) AS "avg", min(value) AS min_v, max(value) AS max_v
    FROM events GROUP BY 1, 2))
SELECT event_type, "timestamp",
  coalesce(("avg" < -10) OR ("avg" > 100), false) AS rule_avg_range, coalesce(min_v > max_v, false) AS rule_min_gt_max,
  coalesce((max_v - min_v < 0) OR (max_v - min_v > 50), false) AS rule_spread_range,
  coalesce(("avg" < -10) OR ("avg" > 100), false) OR coalesce(min_v > max_v, false) OR coalesce((max_v - min_v < 0) OR (max_v - min_v > 50), false) AS domain_anomaly,
  CAST(coalesce(abs(("avg" - bp.mean) / nullif(bp.std, 0)) > 3, false)
       OR coalesce(("avg" < bp.q1 - 1.5 * (bp.q3 - bp.q1)) OR ("avg" > bp.q3 + 1.5 * (bp.q3 - bp.q1)), false) AS INTEGER) AS statistical,
  round(abs(("avg" - bp.mean) / nullif(bp.std, 0)) / 3.0
        + CAST(coalesce(("avg" < bp.q1 - 1.5 * (bp.q3 - bp.q1)) OR ("avg" > bp.q3 + 1.5 * (bp.q3 - bp.q1)), false) AS DOUBLE), 6) AS statistical_score
FROM closed, bp''')

# ---------------------------------------------------------------- D8: the level-wise 1-D forest, same recipe in SQL


def _hu(*parts):
    return "(('0x' || substr(md5(concat_ws(':', " + ", ".join(parts) + ")), 1, 8))::BIGINT / 4294967296.0)"


def _sample_ctes(rows, trees, psi, seed, *cols):
    """CTEs that end in ``smp``: (tree, cols, r) of ``rows`` (k, us, cols), ranked within each tree's pool."""
    own = ", ".join(cols)
    return [f"""hashed AS (SELECT *, md5(concat_ws(':', '{seed}', k, CAST(us AS VARCHAR))) AS m FROM {rows})""",
            f"""par AS (SELECT CAST(least({trees}, greatest(1, ceil({4.0 * trees * psi} / count(*)))) AS BIGINT) AS each_ FROM {rows})""",
            f"""rep AS (SELECT h.*, CAST((('0x' || substr(m, 1, 15))::BIGINT + j) % {trees} AS INTEGER) AS tree
              FROM hashed h, par, range({trees}) t(j) WHERE j < each_)""",
            """ranked AS (SELECT *, ('0x' || substr(md5(concat_ws(':', m, CAST(tree AS VARCHAR))), 1, 15))::BIGINT AS h FROM rep)""",
            f"""smp AS (SELECT tree, {own}, row_number() OVER (PARTITION BY tree ORDER BY h, k, us) AS r FROM ranked)"""]


def _whole_sample_ctes(rows, trees, psi, seed, *cols):
    """``_sample_ctes`` with every tree ranking all of ``rows``."""
    own = ", ".join(cols)
    return [f"""hashed AS (SELECT *, CAST({_hu(f"'{seed}'", 'k', 'CAST(us AS VARCHAR)')} * 4294967296 AS BIGINT) AS b FROM {rows})""",
            f"""trees_ AS (SELECT CAST(tree AS INTEGER) AS tree, CAST(((tree + 1) * 1103515245 + {seed} * 12345) % 2147483648 AS BIGINT) AS a
              FROM range({trees}) t(tree))""",
            """rep AS (SELECT p.*, t.tree, (b * (a - a % 2 + 1) + t.tree * 69069) % 4294967296 AS h FROM hashed p, trees_ t)""",
            f"""smp AS (SELECT tree, {own}, row_number() OVER (PARTITION BY tree ORDER BY h, k, us) AS r FROM rep)"""]


def _forest_ctes(base, table, trees=100, psi=256, seed=42, q=0.1, levels=8, sample=_sample_ctes):
    """CTEs that end in ``steps``, ``cpsi``, ``sc`` and ``cut`` of a forest fitted on ``table``."""
    ctes = [base.strip(),
            f"""rows_ AS (SELECT "type", "ID", "timestamp", "avg", "type" || '|' || "ID" AS k, epoch_us("timestamp") AS us, "avg" AS x
              FROM {table} WHERE "avg" IS NOT NULL)""",
            *sample("rows_", trees, psi, seed, "x"),
            """l0 AS (SELECT tree, x, CAST(1 AS BIGINT) AS node, 0 AS depth, CAST('-inf' AS DOUBLE) AS lo, CAST('inf' AS DOUBLE) AS hi, false AS done
              FROM smp WHERE r <= %d)""" % psi]
    for i in range(levels):
        u = _hu(f"'{seed}'", "CAST(tree AS VARCHAR)", "CAST(node AS VARCHAR)", "'split'")
        ctes.append(f"""s{i} AS (SELECT *, min(x) OVER w AS mn, max(x) OVER w AS mx, count(*) OVER w AS cnt
              FROM l{i} WINDOW w AS (PARTITION BY tree, node))""")
        ctes.append(f"""t{i} AS (SELECT *, done OR cnt <= 1 OR mn = mx AS leaf, mn + {u} * (mx - mn) AS split FROM s{i})""")
        ctes.append(f"""l{i + 1} AS (SELECT tree, x,
              CASE WHEN leaf THEN node ELSE node * 2 + CAST(x >= split AS BIGINT) END AS node,
              CASE WHEN leaf THEN depth ELSE depth + 1 END AS depth,
              CASE WHEN leaf OR NOT (x >= split) THEN lo ELSE split END AS lo,
              CASE WHEN leaf OR (x >= split) THEN hi ELSE split END AS hi,
              leaf AS done FROM t{i})""")
    cf = lambda n: (f"(CASE WHEN {n} <= 1 THEN 0.0 WHEN {n} = 2 THEN 1.0 ELSE 2.0 * (ln({n} - 1) + 0.5772156649015329) "  # noqa: E731
                    f"- 2.0 * ({n} - 1) / {n} END)")
    ctes += [f"""leaves AS (SELECT tree, node, any_value(lo) AS lo, any_value(depth) AS depth, count(*) AS n_leaf FROM l{levels} GROUP BY tree, node)""",
             f"""lh AS (SELECT tree, lo, depth + {cf('CAST(n_leaf AS DOUBLE)')} AS h FROM leaves)""",
             """dh AS (SELECT lo, h - coalesce(lag(h) OVER (PARTITION BY tree ORDER BY lo), 0.0) AS dh FROM lh)""",
             f"""steps AS (SELECT lo, sum(dh) OVER (ORDER BY lo ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / {trees}.0 AS eh
              FROM (SELECT lo, sum(dh) AS dh FROM dh GROUP BY lo))""",
             f"""cpsi AS (SELECT {cf('CAST(max(m) AS DOUBLE)')} AS c FROM (SELECT tree, count(*) AS m FROM l0 GROUP BY tree))""",
             """sc AS (SELECT r.*, pow(2.0, -b.eh / (SELECT c FROM cpsi)) AS s FROM rows_ r ASOF JOIN steps b ON r.x >= b.lo)""",
             f"""cut AS (SELECT quantile_cont(s, {1 - q}) AS cut FROM sc)"""]
    return ",\n".join(ctes)


def _forest_sql(sample=_sample_ctes):
    return _rewrite_round("WITH " + _forest_ctes(READINGS, "readings", sample=sample) + """
SELECT "type", "ID", "timestamp", "avg", round(s, 6) AS if_score, CAST(coalesce(s > cut.cut, false) AS INTEGER) AS "Isolation_Forest",
  round(s - cut.cut, 6) AS "Isolation_Forest_score" FROM sc, cut""")


D8 = _forest_sql()
D8_WHOLE = _forest_sql(_whole_sample_ctes)

# ---------------------------------------------------------------- P2, P4, P9, P10, W15, D2 per event
P2 = with_(FAULTED) + '''SELECT "timestamp", round("avg", 6) AS "avg", round(min_v, 6) AS min_v, round(max_v, 6) AS max_v,
  round("T_diff", 6) AS "T_diff", "type", "ID", nighttime FROM faulted'''
P2 = _rewrite_round(P2)
P4 = q('''SELECT "type", "ID", "timestamp", CASE WHEN coalesce(nighttime, false) THEN 'night' ELSE 'day' END AS part FROM readings''', READINGS)
P9 = with_(FAULTED) + '''SELECT CAST(sum(CAST(is_anomaly AS INTEGER)) AS BIGINT) AS total_anomalies,
  round(round(avg(CAST(is_anomaly AS INTEGER)), 9), 6) AS anomaly_rate, count(*) AS n_rows FROM faulted'''
P10 = with_(FAULTED) + 'SELECT "type", "ID", "timestamp", anomaly_type FROM faulted WHERE is_anomaly'
W15 = q('''
SELECT "type", "ID", "timestamp",
  round(coalesce(CASE WHEN rn >= 24 THEN sc END, last_sc, CAST('inf' AS DOUBLE)), 6) AS seq_score
FROM (
  SELECT *, max_by(CASE WHEN rn >= 24 THEN sc END, CASE WHEN rn >= 24 THEN "timestamp" END) OVER (PARTITION BY "type", "ID") AS last_sc
  FROM (SELECT *, row_number() OVER w AS rn, max("avg") OVER w24 - min("avg") OVER w24 AS sc FROM readings
        WINDOW w AS (PARTITION BY "type", "ID" ORDER BY "timestamp"),
               w24 AS (PARTITION BY "type", "ID" ORDER BY "timestamp" ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)))''', READINGS)
D2_EVENT = '''
WITH ev AS (SELECT 'domestic' AS "type", CAST(user_id AS VARCHAR) AS "ID", ts AS "timestamp", value AS "avg" FROM events),
flags AS (
  SELECT "type", "ID", "timestamp",
    coalesce(abs("avg" - avg("avg") OVER w) > 2 * stddev_samp("avg") OVER w, false) AS f
  FROM ev WINDOW w AS (PARTITION BY "type", "ID" ORDER BY "timestamp" ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)),
starts AS (SELECT *, CASE WHEN f AND NOT coalesce(lag(f) OVER (PARTITION BY "type", "ID" ORDER BY "timestamp"), false) THEN 1 ELSE 0 END AS s FROM flags),
numbered AS (SELECT *, sum(s) OVER (PARTITION BY "type", "ID" ORDER BY "timestamp" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS period_no FROM starts),
runs AS (SELECT "type", "ID", CAST(period_no AS BIGINT) AS period_no, min("timestamp") AS start_ts, max("timestamp") AS end_ts, count(*) AS n_rows
         FROM numbered WHERE f GROUP BY ALL)
SELECT *, strftime(start_ts, '%A') AS start_weekday, strftime(start_ts, '%H:%M') AS start_time,
       strftime(end_ts, '%A') AS end_weekday, strftime(end_ts, '%H:%M') AS end_time FROM runs'''

T4 = _rewrite_round(HOURLY.replace("hourly AS (", "WITH hourly AS (", 1) + ''',
bp AS (SELECT avg("avg") AS mean, stddev_pop("avg") AS std, quantile_cont("avg", 0.25) AS q1, quantile_cont("avg", 0.75) AS q3 FROM hourly),
bscore AS (SELECT abs(("avg" - bp.mean) / nullif(bp.std, 0)) / 3.0
        + CAST(coalesce(("avg" < bp.q1 - 1.5 * (bp.q3 - bp.q1)) OR ("avg" > bp.q3 + 1.5 * (bp.q3 - bp.q1)), false) AS DOUBLE) AS sc FROM hourly, bp),
mm AS (SELECT min(sc) AS lo, max(sc) AS hi FROM bscore),
closed AS (
  SELECT * FROM (SELECT event_type, date_trunc('hour', ts) AS "timestamp", avg(value) AS "avg" FROM events GROUP BY 1, 2)),
scored AS (SELECT event_type, "timestamp", abs(("avg" - bp.mean) / nullif(bp.std, 0)) / 3.0
        + CAST(coalesce(("avg" < bp.q1 - 1.5 * (bp.q3 - bp.q1)) OR ("avg" > bp.q3 + 1.5 * (bp.q3 - bp.q1)), false) AS DOUBLE) AS sc FROM closed, bp)
SELECT event_type, "timestamp", round(sc, 6) AS statistical_score,
  round(0.0 + 1.0 * coalesce(CASE WHEN hi = lo THEN 0.0 ELSE (sc - lo) / (hi - lo) END, 0.0), 6) AS ensemble_score,
  CAST(0.0 + 1.0 * coalesce(CASE WHEN hi = lo THEN 0.0 ELSE (sc - lo) / (hi - lo) END, 0.0) > 0.5 AS INTEGER) AS ensemble
FROM scored, mm''')

# ---------------------------------------------------------------- D13: forest + statistical detector, fitted on the first 80 %
_D13 = "WITH " + _forest_ctes(FAULTED.strip() + """,
f AS (SELECT *, row_number() OVER (ORDER BY "timestamp", "type", "ID") - 1 < floor(count(*) OVER () * 0.8) AS is_train FROM faulted),
tr AS (SELECT * FROM f WHERE is_train)""", "tr") + """,
bp AS (SELECT avg("avg") AS mean, stddev_pop("avg") AS std, quantile_cont("avg", 0.25) AS q1, quantile_cont("avg", 0.75) AS q3
       FROM tr WHERE NOT is_anomaly),
e1 AS (SELECT f.*, pow(2.0, -b.eh / (SELECT c FROM cpsi)) - (SELECT cut FROM cut) AS if_s FROM f ASOF JOIN steps b ON f."avg" >= b.lo),
e2 AS (SELECT e1.*, abs(("avg" - bp.mean) / nullif(bp.std, 0)) AS z,
         coalesce(("avg" < bp.q1 - 1.5 * (bp.q3 - bp.q1)) OR ("avg" > bp.q3 + 1.5 * (bp.q3 - bp.q1)), false) AS out_ FROM e1, bp),
e3 AS (SELECT *, CAST(if_s > 0 AS INTEGER) AS "Isolation_Forest", CAST(coalesce(z > 2.5, false) OR out_ AS INTEGER) AS "Statistical",
         z / 2.5 + CAST(out_ AS DOUBLE) AS st_s FROM e2),
mm2 AS (SELECT min(if_s) AS lo1, max(if_s) AS hi1, min(st_s) AS lo2, max(st_s) AS hi2 FROM e3),
e4 AS (SELECT e3.*, 0.5 * coalesce(CASE WHEN hi1 = lo1 THEN 0.0 ELSE (if_s - lo1) / (hi1 - lo1) END, 0.0)
         + 0.5 * coalesce(CASE WHEN hi2 = lo2 THEN 0.0 ELSE (st_s - lo2) / (hi2 - lo2) END, 0.0) AS ensemble_score FROM e3, mm2),
ens AS (SELECT *, CAST(ensemble_score > 0.5 AS INTEGER) AS ensemble FROM e4)
"""
D13 = _rewrite_round(_D13 + '''SELECT "type", "ID", "timestamp", is_train, is_anomaly, "Isolation_Forest", "Statistical",
  round(ensemble_score, 6) AS ensemble_score, ensemble FROM ens''')
V10 = _rewrite_round(_D13 + f'''SELECT detector, true_positives, false_positives, false_negatives, true_negatives, detected,
  {_metrics()}, true_positives AS correct FROM (
  SELECT detector, count_if(is_anomaly AND p) AS true_positives, count_if(NOT is_anomaly AND p) AS false_positives,
    count_if(is_anomaly AND NOT p) AS false_negatives, count_if(NOT is_anomaly AND NOT p) AS true_negatives, count_if(p) AS detected
  FROM (SELECT is_anomaly, is_train, 'Isolation_Forest' AS detector, "Isolation_Forest" = 1 AS p FROM ens
        UNION ALL SELECT is_anomaly, is_train, 'Statistical', "Statistical" = 1 FROM ens
        UNION ALL SELECT is_anomaly, is_train, 'ensemble', ensemble = 1 FROM ens) WHERE NOT is_train GROUP BY detector)''')

# ---------------------------------------------------------------- round trips, monitor, tags
S5 = with_(FAULTED) + "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM faulted"
S1_S3 = _rewrite_round(q('''SELECT fmt, "type", "ID", "timestamp", round("avg", 6) AS "avg", round(min_v, 6) AS min_v, round(max_v, 6) AS max_v,
  nighttime, time_diff_min, round("T_diff", 6) AS "T_diff" FROM readings, (VALUES ('parquet'), ('csv')) f(fmt)''', READINGS))
T8 = with_(SCORED) + f"SELECT count(*) AS batch_size, {_CONF} FROM pred"
P7_W1_ALL = _rewrite_round(q('SELECT "timestamp", round("avg", 6) AS "avg", "type", "ID" FROM hourly', HOURLY))
P7_W1 = P7_W1_ALL

N4_PAIRS = _rewrite_round(q('''
SELECT 'pair' AS record, a."type", a."ID" AS "a_ID", b."ID" AS "b_ID", a.bucket, round(a.m, 6) AS a_mean, a.low AS a_drop,
  round(b.m, 6) AS b_mean, b.low AS b_drop,
  CASE WHEN a.low AND b.low THEN 'both' WHEN a.low THEN 'only_a' WHEN b.low THEN 'only_b' ELSE 'none' END AS diagnosis,
  0::BIGINT AS n_measured, 0::BIGINT AS n_dropped, 0::BIGINT AS pairs_both, 0::BIGINT AS pairs_one, 0::BIGINT AS pairs_none
FROM per a JOIN per b ON a."type" = b."type" AND a.bucket = b.bucket AND a."ID" < b."ID"
UNION ALL
SELECT 'hour', n."type", NULL, NULL, n.bucket, NULL, NULL, NULL, NULL, NULL,
  n_measured, n_dropped, coalesce(p.both_, 0)::BIGINT, coalesce(p.one, 0)::BIGINT, coalesce(p.none, 0)::BIGINT
FROM (SELECT "type", bucket, count(*) AS n_measured, count_if(low) AS n_dropped FROM per GROUP BY ALL) n
LEFT JOIN (SELECT a."type", a.bucket, count_if(a.low AND b.low) AS both_, count_if(a.low <> b.low) AS one, count_if(NOT a.low AND NOT b.low) AS none
           FROM per a JOIN per b ON a."type" = b."type" AND a.bucket = b.bucket AND a."ID" < b."ID" GROUP BY ALL) p
  ON n."type" = p."type" AND n.bucket = p.bucket''', READINGS, _N4_DROPS))

# ---------------------------------------------------------------- D10 with the forest, D16, V10 in full
D10_FOREST = "WITH " + _forest_ctes(LABELED, "readings") + """
SELECT l."type", l."ID", l."timestamp", rolling_anomaly, statistical_anomaly, domain_anomaly, baseline_anomaly,
  coalesce(s > cut.cut, false) AS forest_anomaly, is_anomaly OR coalesce(s > cut.cut, false) AS is_anomaly
FROM labeled l CROSS JOIN cut LEFT JOIN sc ON l."type" = sc."type" AND l."ID" = sc."ID" AND l."timestamp" = sc."timestamp\""""

D16 = "WITH " + _forest_ctes(FAULTED, "faulted") + """,
bp AS (SELECT avg("avg") AS mean, stddev_pop("avg") AS std, quantile_cont("avg", 0.25) AS q1, quantile_cont("avg", 0.75) AS q3
       FROM faulted WHERE NOT is_anomaly),
n AS (
  SELECT 'Isolation_Forest' AS detector, 'IsolationForestDetector' AS detector_type, 2.0 AS weight,
    (SELECT count_if(s > cut.cut) FROM sc, cut) AS n_flagged
  UNION ALL SELECT 'Statistical', 'StatisticalDetector', 1.0, count_if(coalesce(abs(("avg" - bp.mean) / nullif(bp.std, 0)) > 2.5, false)
    OR coalesce(("avg" < bp.q1 - 1.5 * (bp.q3 - bp.q1)) OR ("avg" > bp.q3 + 1.5 * (bp.q3 - bp.q1)), false)) FROM faulted, bp)
SELECT detector, detector_type, weight::DOUBLE AS weight, true AS is_fitted, 0.5::DOUBLE AS ensemble_threshold,
  n_flagged::BIGINT AS n_flagged, (SELECT count(*) FROM faulted) AS n_rows FROM n"""


def _r2_sql(k=6, pivot=1e-9):
    regressors = ["one", "lag1", "hour_sin", "hour_cos", "is_weekend", "is_night"]
    exact = lambda c: f"CAST(round({c} * 1000000.0) AS HUGEINT)"
    total = lambda a, b: f"CAST(sum({exact(a)} * {exact(b)}) AS DOUBLE) / 1e12"
    design = """SELECT "type", "ID", "timestamp", "avg", is_train, lag("avg") OVER w AS lag1, 1.0::DOUBLE AS one,
      sin(2 * pi() * hour("timestamp") / 24) AS hour_sin, cos(2 * pi() * hour("timestamp") / 24) AS hour_cos,
      CAST(isodow("timestamp") >= 6 AS DOUBLE) AS is_weekend, CAST(nighttime AS DOUBLE) AS is_night
      FROM cutr {where} WINDOW w AS (PARTITION BY "type", "ID" ORDER BY "timestamp")"""
    sums = [f"{total(regressors[i], regressors[j])} AS a_{i}_{j}" for i in range(k) for j in range(i, k)]
    sums += [f'{total(regressors[i], chr(34) + "avg" + chr(34))} AS b_{i}' for i in range(k)]
    ctes = ["""cutr AS (SELECT *, row_number() OVER (PARTITION BY "type", "ID" ORDER BY "timestamp") - 1
              < floor(count(*) OVER (PARTITION BY "type", "ID") * 0.8) AS is_train FROM readings)""",
            "des AS (" + design.format(where="") + ")", "dtr AS (" + design.format(where="WHERE is_train") + ")",
            f"""e0 AS (SELECT *, {', '.join(f'a_{i}_{i} AS s_{i}' for i in range(k))} FROM (
              SELECT "type", "ID", {', '.join(sums)} FROM dtr WHERE lag1 IS NOT NULL GROUP BY "type", "ID"))"""]
    for p in range(k):
        use = f"(a_{p}_{p} > {pivot} * s_{p} AND a_{p}_{p} > 0)"
        f = {i: f"(CASE WHEN {use} THEN a_{p}_{i} / a_{p}_{p} ELSE 0.0 END)" for i in range(p + 1, k)}
        new = [f"a_{i}_{j} - {f[i]} * a_{p}_{j} AS a_{i}_{j}" for i in range(p + 1, k) for j in range(i, k)]
        new += [f"b_{i} - {f[i]} * b_{p} AS b_{i}" for i in range(p + 1, k)]
        old = [f"a_{i}_{j}" for i in range(p + 1) for j in range(i, k)] + [f"b_{i}" for i in range(p + 1)]
        old += [f"s_{i}" for i in range(k)] + [f"u_{i}" for i in range(p)]
        ctes.append(f'e{p + 1} AS (SELECT "type", "ID", {", ".join(old + new)}, {use} AS u_{p} FROM e{p})')
    last = f"e{k}"
    for p in range(k - 1, -1, -1):
        rest = f"b_{p}" + "".join(f" - a_{p}_{j} * x_{j}" for j in range(p + 1, k))
        ctes.append(f"x{p} AS (SELECT *, CASE WHEN u_{p} THEN ({rest}) / a_{p}_{p} ELSE 0.0 END AS x_{p} FROM {last})")
        last = f"x{p}"
    expected = "0.0" + "".join(f" + x_{i} * d.{r}" for i, r in enumerate(regressors))
    ctes += [f"""sco AS (SELECT d."type", d."ID", d."timestamp", d.is_train, d."avg", CASE WHEN lag1 IS NOT NULL THEN {expected} END AS expected
               FROM des d JOIN x0 c ON d."type" = c."type" AND d."ID" = c."ID")""",
             'res AS (SELECT *, "avg" - expected AS residual, stddev_samp("avg" - expected) OVER (PARTITION BY "type", "ID") AS sg FROM sco)']
    return with_(_rewrite_round(READINGS), *ctes) + _rewrite_round("""SELECT "type", "ID", "timestamp", is_train, "avg", round(expected, 6) AS expected, round(residual, 6) AS residual,
  coalesce(abs(residual) > 3 * sg, false) AS expected_anomaly FROM res""")


R2 = _r2_sql()

_X2_COLUMNS = (["avg", "min_v", "max_v", "nighttime", "time_diff_min", "T_diff", "hour", "day_of_week", "month", "is_weekend",
                "type_domestic", "type_nan"]
               + [x for c in VALS for x in [f"{c}_rolling_{st}_{h}h" for h in (1, 6, 24) for st in ("mean", "std")]
                  + [f"{c}_weighted_change"]]
               + ["time_diff_normalized", "time_diff_deviation", "time_diff_z_score"] + [f"{c}_rate_per_min" for c in VALS]
               + ["avg_to_max_ratio", "avg_to_min_ratio", "range_to_avg_ratio", "temp_range_normalized", "temp_stability"])


def _forest_nd_sql(trees=100, psi=256, seed=42, q=0.05, levels=8):
    nf = len(_X2_COLUMNS)
    features = ", ".join(f'round(CAST("{c}" AS DOUBLE), 6)' for c in _X2_COLUMNS)
    u = lambda salt: _hu(f"'{seed}'", "CAST(tree AS VARCHAR)", "CAST(node AS VARCHAR)", f"'{salt}'")
    cf = lambda n: (f"(CASE WHEN {n} <= 1 THEN 0.0 WHEN {n} = 2 THEN 1.0 ELSE 2.0 * (ln({n} - 1) + 0.5772156649015329) "  # noqa: E731
                    f"- 2.0 * ({n} - 1) / {n} END)")
    ctes = [f"x2 AS ({X2})", f"""rows_ AS MATERIALIZED (SELECT "type", "ID", "timestamp", "type" || '|' || "ID" AS k, epoch_us("timestamp") AS us,
              [{features}] AS f FROM x2)""",
            *_sample_ctes("rows_", trees, psi, seed, "f"),
            f"l0 AS MATERIALIZED (SELECT tree, f, CAST(1 AS BIGINT) AS node FROM smp WHERE r <= {psi})",
            """lim AS (SELECT tree, greatest(1, ceil(log2(greatest(count(*), 2)))) AS lim FROM l0 GROUP BY tree)"""]
    for i in range(levels + 1):
        lo, hi = (", ".join(f"{agg}(f[{j + 1}])" for j in range(nf)) for agg in ("min", "max"))
        ctes += [f"g{i} AS (SELECT tree, node, count(*) AS n, [{lo}] AS lo, [{hi}] AS hi FROM l{i} GROUP BY tree, node)",
                 f"""v{i} AS (SELECT g.*, CASE WHEN n > 1 AND {i} < lim.lim THEN list_filter(range(1, {nf + 1}), lambda j: hi[j] > lo[j])
                   ELSE [] END AS use FROM g{i} g JOIN lim USING (tree))""",
                 f"""w{i} AS (SELECT *, CASE WHEN len(use) > 0 THEN use[1 + CAST(floor({u('feature')} * len(use)) AS BIGINT)] END AS ft FROM v{i})""",
                 f"""n{i} AS MATERIALIZED (SELECT tree, node, ft, lo[ft] + {u('split')} * (hi[ft] - lo[ft]) AS thr,
                   CASE WHEN ft IS NULL THEN {float(i)} + {cf('CAST(n AS DOUBLE)')} END AS h FROM w{i})"""]
        if i < levels:
            ctes.append(f"""l{i + 1} AS MATERIALIZED (SELECT l.tree, l.f, l.node * 2 + CAST(l.f[n.ft] >= n.thr AS BIGINT) AS node
              FROM l{i} l JOIN n{i} n ON l.tree = n.tree AND l.node = n.node WHERE n.ft IS NOT NULL)""")
    ctes += ["nodes AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM n{i}" for i in range(levels + 1)) + ")",
             f"""p0 AS (SELECT row_number() OVER () AS i, r.*, CAST(t.tree AS INTEGER) AS tree, CAST(1 AS BIGINT) AS node
               FROM rows_ r, range({trees}) t(tree))"""]
    for i in range(levels):
        ctes.append(f"""p{i + 1} AS (SELECT p.* REPLACE (CASE WHEN n.ft IS NULL THEN p.node ELSE p.node * 2 + CAST(p.f[n.ft] >= n.thr AS BIGINT) END AS node)
          FROM p{i} p JOIN nodes n ON p.tree = n.tree AND p.node = n.node)""")
    ctes += [f"""eh AS (SELECT "type", "ID", "timestamp", sum(n.h) / {float(trees)} AS eh FROM p{levels} p
               JOIN nodes n ON p.tree = n.tree AND p.node = n.node GROUP BY ALL)""",
             f"cp AS (SELECT {cf('CAST(least(' + str(psi) + ', count(*)) AS DOUBLE)')} AS c FROM rows_)",
             """s9 AS (SELECT "type", "ID", "timestamp", round(pow(2.0, -eh / cp.c), 9) AS s FROM eh, cp)""",
             f"cut AS (SELECT quantile_cont(s, {1 - q}) AS cut FROM s9)",
             f"z AS ({D3})", f"dr AS ({D4})"]
    return "WITH " + ",\n".join(ctes) + """
SELECT r."type", r."ID", r."timestamp", r."avg", s9.s > cut.cut OR z.statistical_anomaly OR dr.domain_anomaly AS is_anomaly,
  round(-s9.s, 6) AS anomaly_score, s9.s > cut.cut AS isolation_forest_anomaly, z.statistical_anomaly, dr.domain_anomaly
FROM s9 CROSS JOIN cut JOIN (""" + X1 + """) r USING ("type", "ID", "timestamp") JOIN z USING ("type", "ID", "timestamp")
JOIN dr USING ("type", "ID", "timestamp")"""


D11 = _rewrite_round(_forest_nd_sql())


def _unpivoted(table, item, inner):
    return (f"SELECT '{table}' AS \"table\", {item} AS item, measure, round(value, 6) AS value FROM (UNPIVOT ("
            f"SELECT {item}, CAST(COLUMNS(* EXCLUDE ({item})) AS DOUBLE) FROM ({inner})) ON COLUMNS(* EXCLUDE ({item})) "
            f"INTO NAME measure VALUE value)")


_V10_DETECTORS = " UNION ALL ".join(
    f"SELECT '{d}' AS item, true_positives, false_positives, false_negatives, true_negatives, detected, true_positives AS correct, "
    f"{_metrics()} FROM (SELECT {_CONF.replace('ensemble = ', d + ' = ')}, count_if({d} = 1) AS detected FROM h)"
    for d in ("statistical", "ensemble"))
V10_TABLES = _rewrite_round(with_(SCORED + """,
h AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY "timestamp", "type", "ID") - 1 < floor(count(*) OVER () * 0.8) AS tr
      FROM pred) WHERE NOT tr)""") + " UNION ALL ".join([
    _unpivoted("metrics", "item", f"SELECT NULL::VARCHAR AS item, *, {_metrics()} FROM (SELECT {_CONF} FROM h)"),
    _unpivoted("by_detector", "item", _V10_DETECTORS),
    _unpivoted("by_type", "item", """SELECT anomaly_type AS item, count(*) AS total, count_if(ensemble = 1) AS detected,
      count_if(ensemble = 1)::DOUBLE / count(*) AS detection_rate FROM h WHERE is_anomaly GROUP BY ALL"""),
    _unpivoted("missed_types", "item", "SELECT anomaly_type AS item, count(*) AS n FROM h WHERE is_anomaly AND ensemble = 0 GROUP BY ALL"),
    _unpivoted("rows", "item", """SELECT CASE WHEN is_anomaly AND ensemble = 1 THEN '3' WHEN is_anomaly THEN '1' WHEN ensemble = 1 THEN '4' ELSE '0' END AS item,
      count(*) AS n FROM h GROUP BY ALL"""),
]))

# ---------------------------------------------------------------- one reading per event
HOURLY_EVENT = """
hourly AS (
  SELECT ts AS "timestamp", value AS "avg", min(value) OVER w AS min_v, max(value) OVER w AS max_v,
         'domestic' AS "type", CAST(user_id AS VARCHAR) AS "ID"
  FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)
)"""


def per_event(text: str) -> str:
    """The same oracle over one reading per event instead of the hourly rollup."""
    for rollup in (HOURLY, _rewrite_round(HOURLY)):
        text = text.replace(rollup.strip(), HOURLY_EVENT.strip())
    return text
