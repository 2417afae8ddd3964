"""Second-order gradient boosting for a yes/no label, as DataFrame aggregates.

Features are cut into bins once.  Rows of equal bins come to the same leaves and have the same margin, so trees are
grown on cells: one row per distinct bins with its number of rows and the sum of their labels (never more cells than
rows, nor than the product of the features' bins).  A level of a tree is one aggregate: the gradients and hessians of
the cells are summed per (node, feature, bin) -- at most 2 ** depth x features x bins rows, summed map-side first --
and windows over these sums give the gain of every border, with missing values on either side.  The driver holds the
tree (at most one row per node); which node a cell is in follows from the tree and its bins, so cells carry no
state but their margin, which is stored in the shared folder every few trees.

Gain of a split: GL^2/(HL + l2) + GR^2/(HR + l2) - G^2/(H + l2); a leaf is worth -step x G/(H + l2).  Gains are
compared to six places; of equal ones the first feature, the lowest border and missing values to the left win,
so the tree does not depend on the order in which sums are made.

Defined results: a null feature is missing and goes the way that the split learned; rows with a null label are not
trained on, but scored; without training rows, or with one class only, every tree is a single leaf.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..session import checkpoint_dir

MISSING = -1
PLACES = 6


@dataclass(frozen=True)
class Settings:
    trees: int = P.GBT_TREES
    depth: int = P.GBT_DEPTH
    step: float = P.GBT_STEP
    l2: float = 1.0
    min_child: float = 1.0     # least sum of hessians on a side
    store_every: int = 10      # trees after which the margins are stored


@dataclass
class Tree:
    """Node 1 is the root, node k has the children 2k and 2k + 1."""

    splits: dict[int, tuple] = field(default_factory=dict)   # node -> (feature, bin, missing goes left, gain, cover)
    leaves: dict[int, float] = field(default_factory=dict)   # node -> value

    def _sql(self, node: int, bins: str, at_leaf) -> str:
        if node not in self.splits:
            return at_leaf(node)
        f, b, missing_left, *_ = self.splits[node]
        low = "" if missing_left else f"{bins}[{f}] >= 0 AND "
        return (f"CASE WHEN {low}{bins}[{f}] <= {b} THEN {self._sql(2 * node, bins, at_leaf)} "
                f"ELSE {self._sql(2 * node + 1, bins, at_leaf)} END")

    def node(self, bins: str = "_bins") -> Column:
        """The node that a row has come to."""
        return F.expr(self._sql(1, bins, str))

    def value(self, bins: str = "_bins") -> Column:
        return F.expr(self._sql(1, bins, lambda k: f"{self.leaves.get(k, 0.0)!r}D"))


def quantile_borders(df: DataFrame, features: list[str], bins: int = 64) -> dict[str, list[float]]:
    """At most ``bins`` - 1 borders per feature from a quantile sketch (features x bins numbers on the driver)."""
    shares = ", ".join(f"{i / bins!r}D" for i in range(1, bins))
    row = df.agg(*[F.expr(f"percentile_approx(CAST(`{f}` AS DOUBLE), array({shares}), {bins * 20})").alias(f"b{i}")
                   for i, f in enumerate(features)]).first()
    return {f: sorted(set(row[f"b{i}"] or [])) for i, f in enumerate(features)}


def binned(df: DataFrame, borders: dict[str, list[float]]) -> DataFrame:
    """``df`` with ``_bins``: for each feature how many borders are not above its value; -1 if it is missing."""
    def bin_of(f, cut):
        listed = ", ".join(f"{float(b)!r}D" for b in cut)
        below = f"size(filter(array({listed}), b -> b <= CAST(`{f}` AS DOUBLE)))" if cut else "0"
        return f"CASE WHEN `{f}` IS NULL THEN {MISSING} ELSE {below} END"
    return df.withColumn("_bins", F.expr(f"array({', '.join(bin_of(f, c) for f, c in borders.items())})"))


def best_splits(rows: DataFrame, settings: Settings) -> DataFrame:
    """For each ``node`` of ``rows`` (node, _bins, g, h): its sums and, where a split is worth it, the best one."""
    l2 = f"{float(settings.l2)!r}D"
    least = f"{settings.min_child - 1e-9!r}D"   # round-off must not decide whether a side is heavy enough
    # One statement, as a plan built call by call costs more than its job.  Sums are dealt by node, which serves all windows.
    return rows.sparkSession.sql(f"""
        WITH entries AS (SELECT node, g, h, posexplode(_bins) AS (feature, bin) FROM {{rows}}),
        sums AS (
            SELECT /*+ REPARTITION(node) */ * FROM (
                SELECT node, feature, bin, sum(g) AS g, sum(h) AS h FROM entries GROUP BY node, feature, bin)),
        sides AS (
            SELECT node, feature, bin,
                   sum(if(bin = {MISSING}, 0D, g)) OVER upto AS gl, sum(g) OVER whole AS gt, sum(if(bin = {MISSING}, g, 0D)) OVER whole AS gm,
                   sum(if(bin = {MISSING}, 0D, h)) OVER upto AS hl, sum(h) OVER whole AS ht, sum(if(bin = {MISSING}, h, 0D)) OVER whole AS hm
            FROM sums WINDOW whole AS (PARTITION BY node, feature),
                 upto AS (PARTITION BY node, feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        sent AS (
            SELECT node, feature, bin, missing_left, gt, ht,
                   gl + if(missing_left, gm, 0D) AS gl, hl + if(missing_left, hm, 0D) AS hl
            FROM sides LATERAL VIEW explode(array(TRUE, FALSE)) AS missing_left),
        tried AS (
            SELECT *, round(gl * gl / (hl + {l2}) + (gt - gl) * (gt - gl) / (ht - hl + {l2}) - gt * gt / (ht + {l2}), {PLACES}) AS gain
            FROM sent)
        SELECT node, max(gt) AS g, max(ht) AS h, min(CASE
            WHEN bin <> {MISSING} AND hl >= {least} AND ht - hl >= {least} AND gain > 0
            THEN struct(-gain AS minus_gain, feature, bin, NOT missing_left AS missing_right, gl, hl) END) AS best
        FROM tried GROUP BY node""", rows=rows)


def grow(rows: DataFrame, settings: Settings) -> Tree:
    """One tree from ``rows`` (_bins, g, h)."""
    tree = Tree()

    def leaf(g, h):
        return -settings.step * g / (h + settings.l2)

    for level in range(settings.depth):
        at = rows.select(tree.node().alias("node"), "_bins", "g", "h").where(f"node >= {2 ** level}")
        found = best_splits(at, settings).collect()  # a row per node of the level
        for r in found:
            if level == 0:
                tree.leaves[1] = leaf(r.g, r.h)
            if r.best is not None:
                b = r.best
                tree.splits[r.node] = (b.feature, b.bin, not b.missing_right, -b.minus_gain, r.h)
                tree.leaves.pop(r.node, None)
                tree.leaves[2 * r.node] = leaf(b.gl, b.hl)
                tree.leaves[2 * r.node + 1] = leaf(r.g - b.gl, r.h - b.hl)
        if not any(r.best is not None for r in found):
            break
    return tree


@dataclass
class Model:
    borders: dict[str, list[float]]
    trees: list[Tree]

    def score(self, df: DataFrame, score: str = "score") -> DataFrame:
        """``df`` with the probability of the label."""
        margin = F.lit(0.0)
        for t in self.trees:
            margin = margin + t.value()
        return binned(df, self.borders).withColumn(score, 1 / (1 + F.exp(-margin))).drop("_bins")

    def splits(self, spark) -> DataFrame:
        """(tree, node, feature, bin, missing_left, gain, cover) of every split."""
        names = list(self.borders)
        rows = [(i + 1, node, names[f], b, bool(left), float(gain), round(float(cover), PLACES)) for i, t in enumerate(self.trees)
                for node, (f, b, left, gain, cover) in sorted(t.splits.items())]
        return spark.createDataFrame(rows, "tree int, node int, feature string, bin int, missing_left boolean, gain double, cover double")

    def importance(self, spark) -> DataFrame:
        """(feature, importance, rank): the mean gain of a feature's splits as a share of all features' means."""
        known = spark.createDataFrame([(f,) for f in self.borders], "feature string")
        mean = self.splits(spark).groupBy("feature").agg(F.avg("gain").alias("mean"))
        shares = known.join(mean, "feature", "left").withColumn("mean", F.coalesce("mean", F.lit(0.0)))
        share = F.round(F.coalesce(F.try_divide(F.col("mean"), F.sum("mean").over(Window.partitionBy())), F.lit(0.0)), PLACES)
        return shares.select("feature", share.alias("importance")).select(
            "feature", "importance", F.rank().over(Window.orderBy(F.col("importance").desc())).cast("int").alias("rank"))


def fit(df: DataFrame, label: str, borders: dict[str, list[float]], settings: Settings = Settings()) -> Model:
    """Boost trees on ``df``.  Lineage is cut when the cells are made and every ``store_every`` trees."""
    spark, model = df.sparkSession, Model(borders, [])
    base = f"{checkpoint_dir(spark).rstrip('/')}/boosting-{uuid.uuid4().hex}"

    def stored(rows, n):
        rows.write.parquet(f"{base}/{n}")
        return spark.read.schema(rows.schema).parquet(f"{base}/{n}")

    cells = stored(binned(df, borders).where(F.col(label).isNotNull()).groupBy("_bins").agg(
        F.count("*").cast("double").alias("n"), F.sum(F.col(label).cast("double")).alias("y")).withColumn("margin", F.lit(0.0)), 0)
    for n in range(settings.trees):
        # All levels of a tree read the same gradients: they are kept until it is grown.
        kept = cells.selectExpr("_bins", "1 / (1 + exp(-margin)) AS p", "n", "y").selectExpr(
            "_bins", "n * p - y AS g", "n * p * (1 - p) AS h").persist()
        try:
            tree = grow(kept, settings)
        finally:
            kept.unpersist()
        model.trees.append(tree)
        if n + 1 < settings.trees:
            cells = cells.select("_bins", "n", "y", (F.col("margin") + tree.value()).alias("margin"))
            if (n + 1) % settings.store_every == 0:
                cells = stored(cells, n + 1)
    return model


# ------------------------------------------------------------------------------------ oracle SQL
def boosting_sql(source: str, label: str, borders: dict[str, list[float]], settings: Settings) -> str:
    """DuckDB views ``splits`` and ``margins`` (user_id, label, split, margin) of the trees grown on the rows of
    ``source`` with split = 'train', a view per level of each tree."""
    views = [f"bins AS (SELECT user_id, {label} AS y, split, " + ", ".join(
        f"CASE WHEN {f} IS NULL THEN -1 ELSE len(list_filter({[float(b) for b in cut]}, lambda b: b <= CAST({f} AS DOUBLE))) END AS b{i}"
        for i, (f, cut) in enumerate(borders.items())) + f" FROM {source})",
        "m0 AS (SELECT user_id, y, split, 0.0::DOUBLE AS margin FROM bins)"]
    n = len(borders)
    sides = " UNION ALL ".join(f"SELECT user_id, {i} AS feature, b{i} AS bin FROM bins" for i in range(n))
    views.append(f"long AS MATERIALIZED ({sides})")
    every = []
    for t in range(1, settings.trees + 1):
        views.append(f"""gh{t} AS MATERIALIZED (
  SELECT user_id, split, 1 / (1 + exp(-margin)) - y AS g, 1 / (1 + exp(-margin)) * (1 - 1 / (1 + exp(-margin))) AS h FROM m{t - 1})""")
        views.append(f"n{t}_0 AS (SELECT user_id, 1 AS node FROM bins)")
        for d in range(settings.depth):
            views.append(f"""s{t}_{d} AS MATERIALIZED (
  WITH hist AS (
    SELECT node, feature, bin, sum(g) AS g, sum(h) AS h FROM long JOIN n{t}_{d} USING (user_id) JOIN gh{t} USING (user_id)
    WHERE split = 'train' AND node >= {2 ** d} GROUP BY ALL
  ), tried AS (
    SELECT a.node, a.feature, a.bin, missing.left_side AS missing_left,
           sum(b.g) FILTER (b.bin >= 0 AND b.bin <= a.bin OR b.bin < 0 AND missing.left_side) AS gl,
           sum(b.h) FILTER (b.bin >= 0 AND b.bin <= a.bin OR b.bin < 0 AND missing.left_side) AS hl, sum(b.g) AS gt, sum(b.h) AS ht
    FROM hist AS a JOIN hist AS b USING (node, feature), (VALUES (TRUE), (FALSE)) AS missing(left_side)
    WHERE a.bin >= 0 GROUP BY ALL
  )
  SELECT node, feature, bin, missing_left, gl, hl, gt, ht, round(gl * gl / (hl + {settings.l2})
         + (gt - gl) * (gt - gl) / (ht - hl + {settings.l2}) - gt * gt / (ht + {settings.l2}), {PLACES}) AS gain
  FROM tried WHERE hl >= {settings.min_child} - 1e-9 AND ht - hl >= {settings.min_child} - 1e-9 AND gain > 0
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, bin, NOT missing_left) = 1)""")
            views.append(f"""n{t}_{d + 1} AS MATERIALIZED (
  SELECT n.user_id, CASE WHEN s.node IS NULL THEN n.node
                         WHEN l.bin < 0 AND s.missing_left OR l.bin >= 0 AND l.bin <= s.bin THEN 2 * n.node ELSE 2 * n.node + 1 END AS node
  FROM n{t}_{d} AS n LEFT JOIN s{t}_{d} AS s USING (node) LEFT JOIN long AS l ON l.user_id = n.user_id AND l.feature = s.feature)""")
            every.append(f"SELECT {t} AS tree, * FROM s{t}_{d}")
        views.append(f"""leaf{t} AS (
  SELECT node, -{settings.step} * sum(g) / (sum(h) + {settings.l2}) AS value FROM n{t}_{settings.depth} JOIN gh{t} USING (user_id)
  WHERE split = 'train' GROUP BY node)""")
        views.append(f"""m{t} AS MATERIALIZED (
  SELECT m.user_id, m.y, m.split, m.margin + coalesce(value, 0) AS margin
  FROM m{t - 1} AS m JOIN n{t}_{settings.depth} USING (user_id) LEFT JOIN leaf{t} USING (node))""")
    names = " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(borders))
    views.append(f"""splits AS (
  SELECT tree, CAST(node AS INTEGER) AS node, CASE feature {names} END AS feature, CAST(bin AS INTEGER) AS bin, missing_left, gain,
         round(ht, {PLACES}) AS cover FROM ({' UNION ALL '.join(every)}))""")
    views.append(f"margins AS (SELECT user_id, y AS label, split, margin FROM m{settings.trees})")
    return ",\n".join(views)


def boosting_rounds_sql(source: str, label: str, borders: dict[str, list[float]], settings: Settings) -> str:
    """The DuckDB view ``margins`` of ``boosting_sql`` for any number of trees: a step of a recursion per level, as a
    view per level goes beyond DuckDB's depth of expressions at some ninety trees."""
    bins = ", ".join(
        f"CASE WHEN {f} IS NULL THEN -1 ELSE len(list_filter({[float(b) for b in cut]}, lambda b: b <= CAST({f} AS DOUBLE))) END"
        for f, cut in borders.items())
    steps, ends = settings.trees * settings.depth, f"(n + 1) % {settings.depth} = 0"
    return f"""grown AS (
  WITH RECURSIVE step USING KEY (id) AS (
    SELECT row_number() OVER () AS id, 0 AS n, user_id, {label} AS y, split, [{bins}] AS bins, 0.0::DOUBLE AS margin, 1 AS node FROM {source}
    UNION ALL
    (WITH gh AS (
      SELECT *, 1 / (1 + exp(-margin)) - y AS g, 1 / (1 + exp(-margin)) * (1 - 1 / (1 + exp(-margin))) AS h
      FROM step WHERE n < {steps}
    ), hist AS (
      SELECT node, feature, bins[feature + 1] AS bin, sum(g) AS g, sum(h) AS h FROM gh, range({len(borders)}) AS f(feature)
      WHERE split = 'train' AND node >= 2 ** (n % {settings.depth}) GROUP BY ALL
    ), tried AS (
      SELECT a.node, a.feature, a.bin, missing.left_side AS missing_left,
             sum(b.g) FILTER (b.bin >= 0 AND b.bin <= a.bin OR b.bin < 0 AND missing.left_side) AS gl,
             sum(b.h) FILTER (b.bin >= 0 AND b.bin <= a.bin OR b.bin < 0 AND missing.left_side) AS hl, sum(b.g) AS gt, sum(b.h) AS ht
      FROM hist AS a JOIN hist AS b USING (node, feature), (VALUES (TRUE), (FALSE)) AS missing(left_side)
      WHERE a.bin >= 0 GROUP BY ALL
    ), best AS (
      SELECT node, feature, bin, missing_left, round(gl * gl / (hl + {settings.l2})
             + (gt - gl) * (gt - gl) / (ht - hl + {settings.l2}) - gt * gt / (ht + {settings.l2}), {PLACES}) AS gain
      FROM tried WHERE hl >= {settings.min_child} - 1e-9 AND ht - hl >= {settings.min_child} - 1e-9 AND gain > 0
      QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, bin, NOT missing_left) = 1
    ), moved AS (
      SELECT gh.*, CASE WHEN best.node IS NULL THEN gh.node
                        WHEN bins[feature + 1] < 0 AND missing_left OR bins[feature + 1] >= 0 AND bins[feature + 1] <= bin THEN 2 * gh.node
                        ELSE 2 * gh.node + 1 END AS child
      FROM gh LEFT JOIN best USING (node)
    ), leaf AS (
      SELECT child, -{settings.step} * sum(g) / (sum(h) + {settings.l2}) AS value FROM moved WHERE split = 'train' GROUP BY child
    )
    SELECT id, n + 1, user_id, y, split, bins, margin + CASE WHEN {ends} THEN coalesce(value, 0) ELSE 0 END,
           CASE WHEN {ends} THEN 1 ELSE child END
    FROM moved LEFT JOIN leaf USING (child))
  )
  SELECT * FROM step
),
margins AS (SELECT user_id, y AS label, split, margin FROM grown)"""
