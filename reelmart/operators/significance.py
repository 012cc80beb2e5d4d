"""Significance for the mart, all as Column expressions (no scipy, no UDF).

Mann-Whitney U: value-vs-rest inside a family (platform, metric, feature
dimension), asymptotic normal with tie correction and continuity 0.5,
Bonferroni over the tests of the family. Only SUGGESTIVE groups with at
least five ads in the rest are tested; others get p = NULL and are never
significant. Spearman rho for DIRECTIONAL groups (score vs metric).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelmart import schemas as S
from reelmart.functions import columns as C
from reelmart.functions.ranks import average_rank, value_ranks
from reelmart.operators.correlate import evidence_regime, mart_base

FAMILY = ["platform_id", "metric_name", "feature_dim"]
RANKED = ["platform_id", "metric_name"]
ALPHA = 0.05


def mann_whitney(metric_chunk: DataFrame, mart: DataFrame | None = None,
                 buckets: int = 64) -> DataFrame:
    """``mart`` is accepted for symmetry; the regime is recomputed from the
    group size (n_ads = n1), so the mart's whole lineage is not run twice.

    Ranks come from ``value_ranks`` (two-level, skew-safe): a family is never
    sorted on one task. R1 = sum over (value, count) of count x average rank.
    """
    # every feature dimension holds the same rows, so ranks and ties are those
    # of (platform, metric): one rank pass instead of one per dimension
    values = metric_chunk.where(F.col("metric_value").isNotNull())
    rk = value_ranks(values, RANKED, "metric_value", buckets)
    t = F.col("t").cast("double")
    fam = rk.groupBy(*RANKED).agg(F.max("n").alias("n_total"), F.sum(t * t * t - t).alias("tie_sum"))
    per_val = mart_base(metric_chunk).groupBy(*FAMILY, "feature_value", "metric_value") \
        .agg(F.count(F.lit(1)).alias("c"))
    grp = (per_val.join(rk.select(*RANKED, "metric_value", average_rank(rk).alias("ar")),
                        RANKED + ["metric_value"])
           .groupBy(*FAMILY, "feature_value")
           .agg(F.sum("c").alias("n1"), F.sum(F.col("c") * F.col("ar")).alias("r1")))
    g = grp.join(fam, RANKED).withColumn("evidence_regime", evidence_regime(F.col("n1")))
    n1, n2, n = F.col("n1").cast("double"), (F.col("n_total") - F.col("n1")).cast("double"), \
        F.col("n_total").cast("double")
    u1 = F.col("r1") - n1 * (n1 + 1) / 2.0
    var = n1 * n2 / 12.0 * ((n + 1) - F.try_divide(F.col("tie_sum"), n * (n - 1)))
    sigma = F.when(var > 0, F.sqrt(var))
    z = F.greatest(F.abs(u1 - n1 * n2 / 2.0) - 0.5, F.lit(0.0)) / sigma
    tested = (F.col("evidence_regime") == "SUGGESTIVE") & (n2 >= S.BLOCK_BELOW) & sigma.isNotNull()
    p = F.when(tested, C.two_sided_normal_p(z))
    fam = Window.partitionBy(*FAMILY)
    m = F.sum(tested.cast("int")).over(fam)
    out = g.select(*FAMILY, "feature_value", F.col("n1").alias("n_value"),
                   (F.col("n_total") - F.col("n1")).alias("n_rest"),
                   C.r6(u1).alias("u_stat"), C.r6(F.when(tested, z)).alias("z_score"),
                   p.alias("p_raw"), m.alias("n_tests"))
    p_bonf = F.least(F.lit(1.0), F.col("p_raw") * F.col("n_tests"))
    return out.select(*FAMILY, "feature_value", "n_value", "n_rest", "u_stat", "z_score",
                      C.r6(F.col("p_raw")).alias("p_value"), C.r6(p_bonf).alias("p_bonferroni"),
                      F.coalesce(p_bonf < ALPHA, F.lit(False)).alias("is_significant"))


def spearman_directional(metric_chunk: DataFrame, mart: DataFrame | None = None) -> DataFrame:
    """Spearman rho between standalone score and metric in DIRECTIONAL groups:
    Pearson correlation of average ranks. Such a group holds fewer rows than
    ``S.DIRECTIONAL_BELOW``, so plain windows rank it."""
    grp = FAMILY + ["feature_value"]
    base = mart_base(metric_chunk)
    sizes = base.groupBy(*grp).agg(F.count(F.lit(1)).alias("n_grp")) \
        .where(evidence_regime(F.col("n_grp")) == "DIRECTIONAL").select(*grp)
    b = base.join(sizes, grp, "left_semi")

    def ranks(value: str) -> F.Column:  # a DIRECTIONAL group has a few rows
        ties = F.count(F.lit(1)).over(Window.partitionBy(*grp, value))
        return F.rank().over(Window.partitionBy(*grp).orderBy(value)) + (ties - 1) / 2.0

    rows = b.select(*grp, ranks("standalone_score").alias("rs"), ranks("metric_value").alias("rm"))
    # Pearson on ranks written out (corr() raises under ANSI when a group's
    # ranks are constant; here a zero spread gives NULL)
    agg = rows.groupBy(*grp).agg(F.count(F.lit(1)).alias("n_ads"),
                                 F.try_divide(F.covar_pop("rs", "rm"),
                                              F.stddev_pop("rs") * F.stddev_pop("rm")).alias("rho"),
                                 F.var_pop("rs").alias("vs"), F.var_pop("rm").alias("vm"))
    return agg.select(*grp, "n_ads",
                      C.r6(F.when((F.col("vs") > 0) & (F.col("vm") > 0), F.col("rho")))
                      .alias("spearman_rho"))
