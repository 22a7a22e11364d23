"""N-dimensional isolation forest and D11, the labeler composition, without Python code on the data.

* sample: the pools and rank hashes of D8 (``complete_samples``), carrying an array of features;
* build: level by level.  Per (tree, node) one partial aggregate gives the row count and each feature's
  range; a node of more than one row that has a feature with a range splits at ``min + u * (max - min)`` of
  one such feature; both draws are hashes of (seed, tree, node).  The sample rows (at most ``trees * psi``) move to
  child ``2 node`` or ``2 node + 1`` by a broadcast join with that level's splits;
* model: the node table, at most ``trees * (2 psi - 1)`` rows whatever the data size, the only
  thing brought to the driver;
* score: the node table goes back as three constant arrays, and every row walks all trees with built-in
  array functions, ``ceil(log2 psi)`` steps each; no explosion, no join;
* cut: the exact ``1 - contamination`` quantile of s on the training rows, or a
  sketch of it (``approx_cut``).

Features are rounded to six decimals, which makes the forest the same in any engine that follows these
rules.  Per-feature standardisation is an affine map per axis and does not change which
rows a uniform axis-parallel split separates, so features are used unscaled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.numeric import round_to
from ...schema import DEFAULT_SERIES, Series
from ..faults import series_label
from ..windows import checkpoint, epoch_micros
from .iforest import c_factor, c_factor_col, complete_samples, hash_uniform


def feature_array(features: Sequence[str]) -> Column:
    """The features as an array of doubles; missing ones count as 0."""
    values = F.array(*[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in features])
    return F.transform(values, lambda x: round_to(x, 6))


def depth_limit(rows: Column) -> Column:
    """Height limit of a tree of so many rows."""
    return F.greatest(F.lit(1), F.ceil(F.log2(F.greatest(rows, F.lit(2)).cast("double")))).cast("int")


def _level(rows: DataFrame, limits: DataFrame, nf: int, level: int, seed: int) -> DataFrame:
    """(tree, node, feature, threshold, leaf_h) of the nodes that have rows; feature is null in a leaf."""
    x = [F.get("_x", F.lit(i)) for i in range(nf)]
    g = rows.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("_n"), F.array(*[F.min(c) for c in x]).alias("_lo"),
                                         F.array(*[F.max(c) for c in x]).alias("_hi"))
    g = g.join(F.broadcast(limits), "tree")
    usable = F.filter(F.sequence(F.lit(0), F.lit(nf - 1)), lambda i: F.get("_hi", i) > F.get("_lo", i))
    g = g.withColumn("_use", F.when((F.col("_n") > 1) & (F.lit(level) < F.col("_limit")), usable).otherwise(
        F.array().cast("array<int>")))
    u = [hash_uniform(F.lit(seed), F.col("tree"), F.col("node"), F.lit(salt)) for salt in ("feature", "split")]
    f = F.get("_use", F.floor(u[0] * F.size("_use")).cast("int"))
    g = g.withColumn("feature", F.when(F.size("_use") > 0, f))
    lo, hi = F.get("_lo", F.col("feature")), F.get("_hi", F.col("feature"))
    return g.select("tree", "node", "feature", (lo + u[1] * (hi - lo)).alias("threshold"),
                    F.when(F.col("feature").isNull(), F.lit(float(level)) + c_factor_col(F.col("_n"))).alias("leaf_h"))


def fit_forest_nd(df: DataFrame, features: Sequence[str], trees: int = 100, psi: int = 256,
                  seed: int = 42, s: Series = DEFAULT_SERIES) -> DataFrame:
    """Node table of the forest: (tree, node, feature, threshold, leaf_h); node 1 is a root."""
    rows = df.select(series_label(df, s).alias("_k"), epoch_micros(df, s.ts).alias("_us"), feature_array(features).alias("_x"))
    d = complete_samples(rows, trees, psi, seed).select("tree", "_x", F.lit(1).cast("long").alias("node"))
    limits = checkpoint(d.groupBy("tree").agg(depth_limit(F.count(F.lit(1))).alias("_limit")))
    nodes = None
    for level in range(max(1, math.ceil(math.log2(max(psi, 2)))) + 1):
        here = checkpoint(_level(d, limits, len(features), level, seed))
        nodes = here if nodes is None else nodes.unionByName(here)
        split = here.where("feature is not null").select("tree", "node", "feature", "threshold")
        right = F.get("_x", F.col("feature")) >= F.col("threshold")
        d = checkpoint(d.join(F.broadcast(split), ["tree", "node"]).select(
            "tree", "_x", (F.col("node") * 2 + right.cast("long")).alias("node")))
    return nodes


class ForestND:
    """Fitted n-D forest as constant arrays (bounded by trees * (2 psi - 1) nodes) and the settings."""

    def __init__(self, nodes: DataFrame, features: Sequence[str], psi_eff: int, trees: int):
        rows = nodes.collect()  # bounded by the forest
        self.features, self.trees, self.c_psi = list(features), trees, c_factor(psi_eff)
        self.depth = max((int(r["node"]).bit_length() for r in rows), default=1)
        self.width = 1 << self.depth
        feature, threshold, leaf = ([z] * (trees * self.width) for z in (-1, 0.0, 0.0))
        for r in rows:
            at = r["tree"] * self.width + r["node"]
            if r["feature"] is None:
                leaf[at] = r["leaf_h"]
            else:
                feature[at], threshold[at] = r["feature"], r["threshold"]
        # folded into constants when the plan is made
        self.arrays = [F.split(F.lit(",".join(map(repr, v))), ",").cast(f"array<{t}>")
                       for v, t in ((feature, "int"), (threshold, "double"), (leaf, "double"))]

    def path_length(self, x: Column) -> Column:
        """Mean path length over all trees of a feature array."""
        feature, threshold, leaf = self.arrays

        def end(tree):
            base = tree * F.lit(self.width)

            def step(at, _):
                f = F.get(feature, at)
                child = base + (at - base) * 2 + (F.get(x, f) >= F.get(threshold, at)).cast("int")
                return F.when(f < 0, at).otherwise(child)

            return F.get(leaf, F.aggregate(F.sequence(F.lit(2), F.lit(self.depth)), base + 1, step)) if self.depth > 1 \
                else F.get(leaf, base + 1)

        return F.aggregate(F.sequence(F.lit(0), F.lit(self.trees - 1)), F.lit(0.0),
                           lambda total, tree: total + end(tree)) / F.lit(float(self.trees))


def score_forest_nd(df: DataFrame, model: ForestND, out: str = "if_score") -> DataFrame:
    """Add s(x) (higher = more anomalous), to nine decimals."""
    d = df.withColumn("_x", feature_array(model.features))
    s = F.pow(F.lit(2.0), -model.path_length(F.col("_x")) / F.lit(model.c_psi)) if model.c_psi > 0 else F.lit(1.0)
    return d.withColumn(out, F.round(s, 9)).drop("_x")


def isolation_forest_nd(df: DataFrame, features: Sequence[str], trees: int = 100, psi: int = 256,
                        contamination: float = 0.05, seed: int = 42, s: Series = DEFAULT_SERIES,
                        approx_cut: bool = False) -> DataFrame:
    """Fit on ``df`` and flag it: ``isolation_forest_anomaly`` (s > cut) and
    ``anomaly_score`` = -s (lower = more anomalous, the labeler's convention)."""
    nodes = fit_forest_nd(df, features, trees, psi, seed, s)
    model = ForestND(nodes, features, min(psi, df.count()), trees)
    from ..scaling import quantile_table
    scored = checkpoint(score_forest_nd(df, model, "_s"))  # read by the cut and by the output: walk the trees once
    cut = quantile_table(scored, ["_s"], [1 - contamination], (), {("_s", 1 - contamination): "_cut"}, approx_cut)
    d = scored.crossJoin(F.broadcast(cut))
    return d.withColumns({"isolation_forest_anomaly": F.col("_s") > F.col("_cut"),
                          "anomaly_score": -F.col("_s")}).drop("_s", "_cut")


def label_readings(df: DataFrame, system_type: str | None = "domestic", contamination: float = 0.05,
                   trees: int = 100, seed: int = 42) -> DataFrame:
    """Type filter -> feature matrix (X2) -> n-D forest (D9) + z-score (D3) +
    domain rules (D4) -> union (D10).  Returns the readings with ``is_anomaly``,
    ``anomaly_score`` and the three component flags."""
    from ..clean import filter_type
    from ..features import feature_columns, feature_matrix
    from .rules import domain_rules
    from .zscore import zscore_any
    d = domain_rules(zscore_any(filter_type(df, system_type)))
    # the readings travel inside the feature rows, so no key joins them back: repeated
    # and NULL keys keep their own flag
    d = d.withColumn("_raw", F.struct(*d.columns))
    fm = feature_matrix(d, type_categories=(system_type,) if system_type else ("domestic", "forward"), keep=("_raw",))
    fm = checkpoint(fm)  # fit, score and cut all read it: materialise once in the shared checkpoint folder
    out = isolation_forest_nd(fm, feature_columns(fm), trees, 256, contamination, seed)
    out = out.select("_raw.*", "isolation_forest_anomaly", "anomaly_score")
    return out.withColumn("is_anomaly", F.col("isolation_forest_anomaly")
                          | F.col("statistical_anomaly") | F.col("domain_anomaly"))
