"""Isolation forest (Liu, Ting, Zhou, ICDM 2008) as Spark jobs.

1-D forest (D8), all in the DataFrame API:

* **sample**: each tree keeps the ``psi`` rows with the smallest rank hash of (seed, row key, tree), of the whole
  table (``pools=False``) or of its pool.  A row is in the pools of as few trees as give each about ``4 * psi`` rows (one in a
  large table).  Rows too large in the rank to be kept are left out before the ranking.
* **build**: level-wise.  For each of ``ceil(log2 psi)`` levels, min / max / count
  per (tree, node) is a window over the sample (at most ``trees * psi`` rows); a
  node splits at ``min + u(seed, tree, node) * (max - min)``; a row moves to child
  ``2 node`` (x < split) or ``2 node + 1`` and carries its interval ``[lo, hi)``.
  Lineage is cut with ``checkpoint()`` (the session's shared checkpoint folder).
* **score**: per tree the leaves tile the line, so the mean path length is a step
  function of x with at most ``trees * psi`` steps: a breakpoint table.  Data rows
  find their step through a broadcast equi-join on an equal-width grid cell (the
  cell table is bounded by grid size + steps) and a codegen'd fold over the few
  steps inside the cell.  No per-tree explosion, nothing collected.
* ``s(x) = 2 ** (-E[h(x)] / c(psi))``; the contamination cut is the exact
  ``1 - q`` quantile of ``s`` on the training rows (``s`` has at most ``trees * psi``
  distinct values, so the exact quantile buffer is bounded); flag ``s > cut``.

n-D forest (D9): ``iforest_nd``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ...schema import DEFAULT_SERIES, Series
from ..faults import series_label
from ..windows import epoch_micros

EULER_GAMMA = 0.5772156649015329


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER_GAMMA) - 2.0 * (n - 1) / n


def c_factor_col(n: Column) -> Column:
    n = n.cast("double")
    return (F.when(n <= 1, F.lit(0.0)).when(n == 2, F.lit(1.0))
             .otherwise(F.lit(2.0) * (F.log(n - 1) + F.lit(EULER_GAMMA)) - F.lit(2.0) * (n - 1) / n))


def hash_uniform(*parts: Column) -> Column:
    """U[0,1) from the first 32 bits of md5 over ':'-joined parts."""
    s = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


@dataclass
class Forest1D:
    """Fitted 1-D forest: breakpoint steps, lookup cells, cut, settings."""

    steps: DataFrame   # lo, eh  (mean path length on [lo, next lo))
    cells: DataFrame   # cell, start_eh, los (array), ehs (array)
    grid: DataFrame    # one row: g_lo, g_w, g_n
    cut: DataFrame     # one row: cut (score threshold), psi, c_psi
    col: str


def _keyed(df: DataFrame, col: str, s: Series) -> DataFrame:
    return df.select(series_label(df, s).alias("_k"), epoch_micros(df, s.ts).alias("_us"),
                     F.col(col).cast("double").alias("_x")).where(F.col("_x").isNotNull())


def _checkpoint(df: DataFrame) -> DataFrame:
    from ...session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def hash_long(text: Column) -> Column:
    """The first 60 bits of a text's md5."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def tree_samples(rows: DataFrame, trees: int, psi: int, seed: int, slack: float = 4.0, pools: bool = True) -> DataFrame:
    """``rows`` (with ``_k``, ``_us``) plus ``tree``: per tree the ``psi`` rows of its pool, or without ``pools`` of the
    whole table, with the smallest rank hash.

    Whole table: one MD5 per row, then one integer mix per tree.  Ranks above ``slack * psi / n`` are left out in the same
    generated loop, so about ``trees * psi * slack`` rows leave the scan, however large the table is.

    Pools: a row's hash names its first tree, and it takes part in as many consecutive trees as
    are needed for pools of ``slack * psi`` rows: all trees in a small table, one in a large one.  So a row is
    never exploded into trees that have enough rows without it.  Within a pool
    every row has an independent 60-bit rank; ranks above ``slack * psi`` expected rows are left out before the ranking, so about
    ``trees * psi * slack`` rows leave the scan.  ``complete_samples`` checks that enough remained.
    """
    n = rows.agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("tree").orderBy("_h", "_k", "_us")
    if not pools:
        base = (hash_uniform(F.lit(seed), F.col("_k"), F.col("_us")) * F.lit(4294967296.0)).cast("long")
        d = rows.crossJoin(F.broadcast(n)).withColumns({"_b": base, "_top": F.lit(slack * psi * 4294967296.0) / F.col("_n")})
        d = d.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        a = F.pmod((F.col("tree").cast("long") + 1) * F.lit(1103515245) + F.lit(seed * 12345), F.lit(2147483648))
        d = d.withColumn("_h", F.pmod(F.col("_b") * (a - a % 2 + 1) + F.col("tree") * F.lit(69069), F.lit(4294967296)))
        d = d.where(F.col("_h") < F.col("_top"))
        return d.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= psi).drop("_r", "_h", "_b", "_top", "_n")
    d = rows.crossJoin(F.broadcast(n)).withColumn("_m", F.md5(F.concat_ws(
        ":", F.lit(str(seed)), F.col("_k"), F.col("_us").cast("string"))))
    each = F.least(F.lit(trees), F.greatest(F.lit(1), F.ceil(F.lit(slack * trees * psi) / F.col("_n")))).cast("int")
    first = F.conv(F.substring("_m", 1, 15), 16, 10).cast("long") % trees
    d = d.withColumn("_each", each).withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_each") - 1)))
    d = d.withColumn("tree", ((first + F.col("_j")) % trees).cast("int"))
    d = d.withColumn("_h", hash_long(F.concat_ws(":", "_m", F.col("tree").cast("string"))))
    d = d.where(F.col("_h") < F.lit(slack * psi * trees * float(1 << 60)) / (F.col("_n") * F.col("_each")))
    return d.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= psi).drop("_r", "_h", "_m", "_j", "_each", "_n")


def complete_samples(rows: DataFrame, trees: int, psi: int, seed: int, pools: bool = True) -> DataFrame:
    """``tree_samples``, written to the checkpoint folder and with min(psi, n) rows in
    every tree; should a tree have kept fewer, the limit is raised until none does."""
    slack = 4.0
    while True:
        d = _checkpoint(tree_samples(rows, trees, psi, seed, slack, pools))
        got = d.groupBy("tree").agg(F.count(F.lit(1)).alias("m")).agg(F.count(F.lit(1)), F.min("m")).first()
        n = rows.count() if got[0] < trees or got[1] < psi else psi
        if n == 0 or (got[0] == trees and got[1] >= min(psi, n)):
            return d
        slack *= 4


def sample_trees(df: DataFrame, col: str = "avg", trees: int = 100, psi: int = 256, seed: int = 42,
                 s: Series = DEFAULT_SERIES, pools: bool = True) -> DataFrame:
    """Per-tree samples: (tree, _k, _us, _x) with at most ``psi`` rows per tree."""
    return complete_samples(_keyed(df, col, s), trees, psi, seed, pools).select("_k", "_us", "_x", "tree")


def grow_1d(sample: DataFrame, psi: int, seed: int = 42, checkpoint_every: int = 4) -> DataFrame:
    """Level-wise growth; returns leaves (tree, node, lo, hi, depth, n_leaf, h)."""
    max_depth = max(1, math.ceil(math.log2(max(psi, 2))))
    d = sample.select("tree", "_x", F.lit(1).cast("long").alias("node"), F.lit(0).alias("depth"),
                      F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"),
                      F.lit(False).alias("done"))
    w = Window.partitionBy("tree", "node")
    # a tree of fewer than psi rows stops at its own height limit
    rows = F.count(F.lit(1)).over(Window.partitionBy("tree"))
    d = d.withColumn("limit", F.greatest(F.lit(1), F.ceil(F.log2(F.greatest(rows, F.lit(2)).cast("double")))))
    for level in range(max_depth):
        mn, mx, cnt = F.min("_x").over(w), F.max("_x").over(w), F.count(F.lit(1)).over(w)
        d = d.withColumns({"_mn": mn, "_mx": mx, "_cnt": cnt})
        leaf = F.col("done") | (F.col("_cnt") <= 1) | (F.col("_mn") == F.col("_mx")) | (F.lit(level) >= F.col("limit"))
        u = hash_uniform(F.lit(seed), F.col("tree"), F.col("node"), F.lit("split"))
        split = F.col("_mn") + u * (F.col("_mx") - F.col("_mn"))
        right = F.col("_x") >= split
        d = d.withColumns({
            "node": F.when(leaf, F.col("node")).otherwise(F.col("node") * 2 + right.cast("long")),
            "lo": F.when(leaf | ~right, F.col("lo")).otherwise(split),
            "hi": F.when(leaf | right, F.col("hi")).otherwise(split),
            "depth": F.when(leaf, F.col("depth")).otherwise(F.col("depth") + 1),
            "done": leaf,
        }).drop("_mn", "_mx", "_cnt")
        if checkpoint_every and (level + 1) % checkpoint_every == 0:
            d = _checkpoint(d)
    leaves = d.groupBy("tree", "node").agg(F.first("lo").alias("lo"), F.first("hi").alias("hi"),
                                           F.first("depth").alias("depth"), F.count(F.lit(1)).alias("n_leaf"))
    return leaves.withColumn("h", F.col("depth").cast("double") + c_factor_col(F.col("n_leaf")))


def breakpoints(leaves: DataFrame, trees: int) -> DataFrame:
    """Mean path length as a step function: (lo, eh) on [lo, next lo)."""
    w = Window.partitionBy("tree").orderBy("lo")
    dh = leaves.withColumn("dh", F.col("h") - F.coalesce(F.lag("h").over(w), F.lit(0.0)))
    g = dh.groupBy("lo").agg(F.sum("dh").alias("dh"))
    # at most trees * psi rows: one ordered pass over this small table
    run = Window.orderBy("lo").rowsBetween(Window.unboundedPreceding, 0)
    return g.select("lo", (F.sum("dh").over(run) / F.lit(float(trees))).alias("eh"))


def lookup_cells(steps: DataFrame, grid_cells: int = 4096) -> tuple[DataFrame, DataFrame]:
    """Equal-width grid over the finite breakpoints; per cell the step value in
    force at the cell start and the (sorted) steps inside the cell."""
    fin = steps.where(F.col("lo") > F.lit(float("-inf")))
    grid = fin.agg(F.min("lo").alias("g_lo"), F.max("lo").alias("g_hi")).select(
        F.coalesce("g_lo", F.lit(0.0)).alias("g_lo"),
        F.when(F.coalesce(F.col("g_hi") - F.col("g_lo"), F.lit(0.0)) > 0,
               (F.col("g_hi") - F.col("g_lo")) / grid_cells).otherwise(F.lit(1.0)).alias("g_w"),
        F.lit(grid_cells).alias("g_n"))
    st = steps.crossJoin(F.broadcast(grid)).withColumn("cell", _cell(F.col("lo")))
    inside = st.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("lo", "eh"))).alias("_steps"))
    # step in force at each cell start: last step with lo < cell start
    all_cells = grid.select(F.explode(F.sequence(F.lit(-1), F.col("g_n"))).alias("cell"), "g_lo", "g_w")
    starts = all_cells.select("cell", F.when(F.col("cell") < 0, F.lit(float("-inf")))
                              .otherwise(F.col("g_lo") + F.col("cell") * F.col("g_w")).alias("_start"))
    marks = starts.select(F.col("_start").alias("v"), F.lit(None).cast("double").alias("eh"), "cell", F.lit(1).alias("_o")) \
        .unionByName(steps.select(F.col("lo").alias("v"), "eh", F.lit(None).cast("int").alias("cell"), F.lit(0).alias("_o")))
    run = Window.orderBy("v", "_o").rowsBetween(Window.unboundedPreceding, 0)
    marks = marks.withColumn("start_eh", F.last("eh", ignorenulls=True).over(run)).where(F.col("cell").isNotNull())
    cells = marks.select("cell", "start_eh").join(inside, "cell", "left")
    return cells, grid


def _cell(x: Column) -> Column:
    c = F.floor((x - F.col("g_lo")) / F.col("g_w"))
    return F.when(x < F.col("g_lo"), F.lit(-1)).otherwise(F.least(c, F.col("g_n"))).cast("int")


def forest_score(df: DataFrame, model: Forest1D, col: str | None = None, out: str = "if_score") -> DataFrame:
    """``out`` = s(x) in (0, 1], higher = more anomalous; NULL input -> NULL."""
    col = col or model.col
    d = df.crossJoin(F.broadcast(model.grid)).withColumn("_cell", _cell(F.col(col).cast("double")))
    d = d.join(F.broadcast(model.cells.withColumnRenamed("cell", "_cell")), "_cell", "left")
    x = F.col(col).cast("double")
    eh = F.when(F.col("_steps").isNull(), F.col("start_eh")).otherwise(
        F.aggregate("_steps", F.col("start_eh"), lambda acc, e: F.when(e["lo"] <= x, e["eh"]).otherwise(acc)))
    d = d.crossJoin(F.broadcast(model.cut.select("c_psi")))
    d = d.withColumn(out, F.when(x.isNull(), F.lit(None)).otherwise(F.pow(F.lit(2.0), -eh / F.col("c_psi"))))
    return d.drop("_cell", "_steps", "start_eh", "g_lo", "g_w", "g_n", "c_psi")


def isolation_forest_fit(df: DataFrame, col: str = "avg", trees: int = 100, psi: int = 256,
                         contamination: float = 0.1, seed: int = 42, s: Series = DEFAULT_SERIES,
                         grid_cells: int = 4096, approx_cut: bool = False, pools: bool = True) -> Forest1D:
    """D8 fit on the training rows of ``df``; without ``pools`` every tree draws from all of them."""
    sample = sample_trees(df, col, trees, psi, seed, s, pools)
    # psi actually used = min(psi, n) (the sklearn rule for small tables)
    psi_eff = sample.groupBy("tree").agg(F.count(F.lit(1)).alias("m")).agg(F.max("m").alias("psi"))
    leaves = _checkpoint(grow_1d(sample, psi, seed))
    steps = _checkpoint(breakpoints(leaves, trees))
    cells, grid = lookup_cells(steps, grid_cells)
    cells = _checkpoint(cells)
    c_psi = psi_eff.select("psi", c_factor_col(F.col("psi")).alias("c_psi"))
    model = Forest1D(steps, cells, grid, c_psi.withColumn("cut", F.lit(None).cast("double")), col)
    train = forest_score(df.where(F.col(col).isNotNull()).select(col), model, col, "_s")
    q = F.percentile_approx("_s", 1 - contamination, 100_000) if approx_cut else F.percentile("_s", 1 - contamination)
    cut = train.agg(q.alias("cut")).crossJoin(c_psi)
    model.cut = _checkpoint(cut)
    return model


def isolation_forest_predict(df: DataFrame, model: Forest1D, col: str | None = None, name: str = "Isolation_Forest") -> DataFrame:
    """D8 predict: ``<name>`` = 1 when s > cut; ``<name>_score`` = s - cut (higher =
    more anomalous, the ensemble's orientation); ``if_score`` = s."""
    d = forest_score(df, model, col, "if_score")
    d = d.crossJoin(F.broadcast(model.cut.select(F.col("cut").alias("_cut"))))
    return d.withColumns({name: F.coalesce((F.col("if_score") > F.col("_cut")).cast("int"), F.lit(0)),
                          f"{name}_score": F.col("if_score") - F.col("_cut")}).drop("_cut")


def forest_params(model: Forest1D) -> DataFrame:
    """All that scoring needs as one row: cut, grid and lookup cells (their number is
    bounded by the grid and trees * psi), so a saved row is the whole forest."""
    cells = model.cells.agg(F.collect_list(F.struct("cell", "start_eh", "_steps")).alias("cells"))
    return model.cut.crossJoin(model.grid).crossJoin(cells)


def forest_of_params(params: DataFrame, col: str) -> Forest1D:
    """The forest of a ``forest_params`` row, for scoring."""
    cells = params.select(F.inline("cells"))
    steps = cells.select(F.inline("_steps")).distinct()
    return Forest1D(steps, cells, params.select("g_lo", "g_w", "g_n"), params.select("cut", "psi", "c_psi"), col)


@dataclass
class IsolationForestDetector:
    """D8 as an ensemble detector (1-D on ``col``)."""

    contamination: float = 0.1
    trees: int = 100
    psi: int = 256
    seed: int = 42
    col: str = "avg"
    name: str = "Isolation_Forest"

    def fit(self, df, label=None):
        return forest_params(isolation_forest_fit(df, self.col, self.trees, self.psi, self.contamination, self.seed))

    def score(self, df, params):
        return isolation_forest_predict(df, forest_of_params(params, self.col), self.col, self.name)
