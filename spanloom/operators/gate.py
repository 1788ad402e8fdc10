"""Does run B really improve on run A?  Noise bands, consistency, leakage and a verdict.

Nothing is rounded before it is compared; queries round what they show.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

RULER = ("lang", "data_fingerprint", "kfold", "group_key", "seed", "stratify")
TRUSTED = ("group", "orig")
LEAST_WINS = 2 / 3


def fold_sigma(scores: DataFrame) -> DataFrame:
    """Mean and sample deviation of f1 over the folds of each (run, entity); null deviation under two folds."""
    return scores.groupBy("run", "entity").agg(F.avg("f1").alias("mean"), F.stddev_samp("f1").alias("sigma"), F.count("*").alias("n"))


def repro_sigma(pooled: DataFrame) -> DataFrame:
    """The same over the pooled scores of repeated runs; raises under two runs."""
    runs = pooled.agg(F.count_distinct("run")).first()[0]
    if runs < 2:
        raise ValueError(f"at least two runs are needed, not {runs}")
    return pooled.groupBy("entity").agg(F.avg("f1").alias("mean"), F.stddev_samp("f1").alias("sigma"), F.count("*").alias("n"))


def paired_deltas(scores: DataFrame, base: str, candidate: str) -> DataFrame:
    """Per entity: folds won and lost by the candidate; folds pair by their place in each run, consistency is null under two pairs."""
    place = scores.select("run", "fold").distinct()
    earlier = place.alias("x").join(place.alias("y"), (F.col("x.run") == F.col("y.run")) & (F.col("y.fold") < F.col("x.fold")), "left")
    numbered = earlier.groupBy("x.run", "x.fold").agg(F.count("y.fold").alias("place"))  # a run has few folds
    rows = scores.join(F.broadcast(numbered), ["run", "fold"])
    side = lambda run, name: rows.where(F.col("run") == run).select("place", "entity", F.col("f1").alias(name))
    d = side(base, "a").join(side(candidate, "b"), ["place", "entity"]).withColumn("d", F.col("b") - F.col("a"))
    out = d.groupBy("entity").agg(F.avg("d").alias("delta"), F.count_if(F.col("d") > 0).alias("wins"), F.count_if(F.col("d") < 0).alias("losses"), F.count("*").alias("n"))
    return out.withColumn("consistent", F.when(F.col("n") >= 2, F.col("wins") / F.col("n") >= F.lit(LEAST_WINS)))


def entity_status(sigma: DataFrame, pooled: DataFrame, deltas: DataFrame, base: str, candidate: str, k: float = 2.0, override: DataFrame | None = None) -> DataFrame:
    """Status of each entity shared by both runs: real_gain, real_regression, within_noise or unknown_sigma.

    The band is ``k`` times the measured deviation in ``override`` (entity, sigma)
    where there is one, else that of the baseline's folds; a gain that too few folds
    show becomes within_noise.
    """
    a = pooled.where(F.col("run") == base).select("entity", F.col("f1").alias("a"))
    b = pooled.where(F.col("run") == candidate).select("entity", F.col("f1").alias("b"))
    s = sigma.where(F.col("run") == base).select("entity", "sigma")
    both = a.join(b, "entity").join(s, "entity", "left").join(deltas.drop("delta"), "entity", "left")
    own = F.lit(None).cast("double")
    if override is not None:
        both, own = both.join(override.select("entity", F.col("sigma").alias("o")), "entity", "left"), F.col("o")
    d, used = F.col("b") - F.col("a"), F.coalesce(own, F.col("sigma"))
    band = k * F.col("sigma")
    raw = F.when(band.isNull(), "unknown_sigma").when(F.col("delta") > band, "real_gain").when(F.col("delta") < -band, "real_regression").otherwise("within_noise")
    out = both.withColumns({"delta": d, "band_source": F.when(own.isNotNull(), "sigma_repro").otherwise("sigma_fold"), "sigma": used}).withColumn("raw", raw)
    weak = F.coalesce((F.col("raw") == "real_gain") & (F.col("consistent") == F.lit(False)), F.lit(False))
    return out.select("entity", "delta", "sigma", band.alias("band"), "band_source", F.when(weak, "within_noise").otherwise(F.col("raw")).alias("status"), "wins", "losses", "n", "consistent", weak.alias("downgraded"))


def leak_state(dups_a: Column, basis_a: Column, dups_b: Column, basis_b: Column) -> tuple[Column, Column]:
    """Whether any run leaks, and whether leakage is verified: a leak seen on any basis, or none on a trusted basis in both."""
    seen = F.coalesce(dups_a > 0, F.lit(False)) | F.coalesce(dups_b > 0, F.lit(False))
    clean = lambda dups, basis: F.coalesce((dups == 0) & basis.isin(*TRUSTED), F.lit(False))
    return seen, seen | (clean(dups_a, basis_a) & clean(dups_b, basis_b))


def verdict(scenarios: DataFrame) -> DataFrame:
    """Verdict of each scenario; the order of the tests is the meaning.

    Columns: comparable, dups_a, basis_a, dups_b, basis_b (null dups: unmeasured),
    target_status (null: the target is missing), collateral (a regression elsewhere).
    """
    leak, verified = leak_state(*map(F.col, ("dups_a", "basis_a", "dups_b", "basis_b")))
    v = (
        F.when(~F.col("comparable"), "INVALID").when(~verified, "INVALID").when(leak, "FAIL").when(F.col("target_status").isNull(), "INVALID")
        .when(F.col("target_status") == "real_regression", "FAIL").when(F.col("collateral"), "FAIL")
        .when(F.col("target_status") == "real_gain", "PASS").otherwise("INCONCLUSIVE")
    )
    return scenarios.withColumn("verdict", v)


def differing(a: Column, b: Column) -> Column:
    """The ruler's fields on which two configs (maps) do not agree; a field that either lacks cannot agree, a null one can."""
    tests = [F.map_contains_key(a, f) & F.map_contains_key(b, f) & F.try_element_at(a, F.lit(f)).eqNullSafe(F.try_element_at(b, F.lit(f))) for f in RULER]
    return F.array_compact(F.array(*[F.when(~t, F.lit(f)) for t, f in zip(tests, RULER)]))


def comparable(configs: DataFrame, base: str, candidate: str) -> DataFrame:
    """Whether both runs' rulers agree, and where not.  ``configs``: run, config (map)."""
    side = lambda run, name: configs.where(F.col("run") == run).agg(F.first("config").alias(name))
    out = side(base, "a").crossJoin(F.broadcast(side(candidate, "b")))  # one row each
    return out.select(differing(F.col("a"), F.col("b")).alias("differs")).withColumn("comparable", F.size("differs") == 0)


def run_config(configs: DataFrame) -> DataFrame:
    """The config of each run: that of its first fold.  ``configs``: run, fold, config (map)."""
    return configs.groupBy("run").agg(F.min_by("config", "fold").alias("config"))


def ruler(configs: DataFrame) -> DataFrame:
    """The ruler's fields that each run's first config holds, null where it holds none."""
    kept = F.map_filter("config", lambda k, _: k.isin(*RULER))
    return run_config(configs).select("run", F.when(F.map_keys(kept) != F.array().cast("array<string>"), kept).alias("ruler"))


def leakage(pooled: DataFrame) -> DataFrame:
    """Leak count and basis of each run's pooled metrics (run, metrics: map): the newer key before the older, neither raises."""
    keys = ("cross_fold_group_dups", "cross_fold_orig_dups")
    raw = F.when(F.map_contains_key("metrics", keys[0]), F.try_element_at("metrics", F.lit(keys[0])))
    raw = raw.when(F.map_contains_key("metrics", keys[1]), F.try_element_at("metrics", F.lit(keys[1])))
    raw = raw.otherwise(F.raise_error(F.concat(F.lit("no leak counter in run "), "run")).cast("string"))
    return pooled.select("run", raw.cast("long").alias("dups"), F.when(F.map_contains_key("metrics", "leak_check_basis"), F.try_element_at("metrics", F.lit("leak_check_basis"))).otherwise("unknown").alias("basis"))


def judge(cases: DataFrame, status: DataFrame) -> DataFrame:
    """Verdicts on many cases of one comparison: ``cases`` with config_a, config_b (maps), dups_a, basis_a, dups_b, basis_b and target.

    ``status`` is that of ``entity_status``: one row per entity.
    """
    worse = status.agg(F.collect_list(F.when(F.col("status") == "real_regression", F.col("entity"))).alias("_worse"))
    rows = cases.join(status.select(F.col("entity").alias("target"), F.col("status").alias("target_status")), "target", "left").crossJoin(F.broadcast(worse))  # one row
    rows = rows.withColumn("comparable", F.size(differing(F.col("config_a"), F.col("config_b"))) == 0)
    return verdict(rows.withColumn("collateral", F.size(F.array_remove("_worse", F.col("target"))) > 0).drop("_worse"))


def compare(configs: DataFrame, pooled_metrics: DataFrame, scores: DataFrame, pooled: DataFrame, base: str, candidate: str, target: str, k: float = 2.0, override: DataFrame | None = None) -> DataFrame:
    """One row: the verdict on one target entity, with what it rests on.

    ``configs`` (run, fold, config), ``pooled_metrics`` (run, metrics), ``scores``
    (run, fold, entity, f1) and ``pooled`` (run, entity, f1).
    """
    status = entity_status(fold_sigma(scores), pooled, paired_deltas(scores, base, candidate), base, candidate, k, override)
    leaks = leakage(pooled_metrics).join(run_config(configs), "run")
    side = lambda run, s: leaks.where(F.col("run") == run).agg(*[F.first(c).alias(f"{c}_{s}") for c in ("config", "dups", "basis")])
    case = side(base, "a").crossJoin(F.broadcast(side(candidate, "b")))  # one row each
    return judge(case.withColumn("target", F.lit(target)), status)
