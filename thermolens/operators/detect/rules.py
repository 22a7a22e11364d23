"""Domain rules (physically impossible readings)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...schema import flag

# Fixed limits of the reference: average in [-10, 100] degC, spread in [0, 50].
AVG_LOW, AVG_HIGH = -10.0, 100.0
SPREAD_LOW, SPREAD_HIGH = 0.0, 50.0


def domain_rules(df: DataFrame, out: str = "domain_anomaly", keep_rules: bool = False) -> DataFrame:
    """Stateless predicates; each rule only applies when its columns exist."""
    rules = {}
    if "avg" in df.columns:
        rules["rule_avg_range"] = flag((F.col("avg") < AVG_LOW) | (F.col("avg") > AVG_HIGH))
    if "min_v" in df.columns and "max_v" in df.columns:
        rules["rule_min_gt_max"] = flag(F.col("min_v") > F.col("max_v"))
    if "T_diff" in df.columns:
        rules["rule_spread_range"] = flag((F.col("T_diff") < SPREAD_LOW) | (F.col("T_diff") > SPREAD_HIGH))
    anyr = F.lit(False)
    for c in rules.values():
        anyr = anyr | c
    d = df.withColumns(rules).withColumn(out, anyr)
    return d if keep_rules else d.drop(*rules)
