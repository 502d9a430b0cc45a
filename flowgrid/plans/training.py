"""Train every candidate, keep the best on a fresh holdout, and decide whether it replaces the champion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgrid.config import Project
from flowgrid.functions.timefns import hour_pos, hour_ts
from flowgrid.operators import decide, evaluate, features, models
from flowgrid.plans.registry import Registry
from flowgrid.sources import tables as T


def candidates(train: DataFrame, keys: list[str], families, label: str = "y", ridge_alpha: float = 1.0,
               gbt: dict | None = None) -> dict[str, models.Fitted]:
    """Fit each family on the cached training part; what a blend and its members share is fitted once."""
    return models.fit_all(families, train, keys, label, ridge_alpha, gbt)


def board(spark: SparkSession, fitted: dict[str, models.Fitted], holdout: DataFrame) -> list[dict]:
    """Holdout metrics per family, best first. All families are scored in one aggregate."""
    scored = None
    for name, m in fitted.items():
        one = m.predict(holdout).select(F.lit(name).alias("family"), "y", "pred")
        scored = one if scored is None else scored.unionByName(one)
    rows = [r.asDict() for r in evaluate.metrics(scored, ["family"]).collect()]
    return sorted(rows, key=lambda r: (r["mape"], r["family"]))


def train(spark: SparkSession, p: Project, trigger: str, git_sha: str = "", run_id: str = "") -> dict:
    """The training job on the stored feature table."""
    s = list(p.series_keys)
    feats = spark.read.parquet(p.path("gold.demand_features")).withColumn("h", hour_pos("target_ts"))
    actual = spark.read.parquet(p.path("silver.consumption")).select(
        *s, hour_pos("timestamp_local").alias("h"), F.col("demand_m3h").alias("demand"))
    data = features.training_frame(feats.select(*s, "h", *features.MODEL_COLUMNS), actual, s)
    return select(spark, p, data.withColumnRenamed("demand", "y"), trigger, git_sha, run_id)


def select(spark: SparkSession, p: Project, data: DataFrame, trigger: str, git_sha: str = "", run_id: str = "") -> dict:
    """Fit on train, score on holdout, refit the winner on everything, register, compare with the champion."""
    s, t = list(p.series_keys), p.training
    data = evaluate.time_split(data, t.holdout_days).cache()
    tr, ho = (data.where(F.col("part") == x).drop("part") for x in ("train", "holdout"))
    fitted = candidates(tr, s, t.candidates, "y", t.ridge_alpha, t.gbt)
    rows = board(spark, fitted, ho)
    best = rows[0]
    final = models.fit(best["family"], data.drop("part"), s, "y", t.ridge_alpha, t.gbt)
    through = data.agg(F.max("h")).first()[0]
    registry = Registry(spark, p)
    champion, before = registry.load("champion")
    version = registry.register(final, {
        "holdout_mape": f"{best['mape']:.4f}", "trigger": trigger, "git_sha": git_sha, "trained_through": str(through)})
    registry.set_alias("challenger", version)
    champ_mape = None

    def verdict(challenger: float, champion: float | None) -> tuple[bool, str]:
        row = spark.createDataFrame([(challenger, champion)], "challenger double, champion double")
        got = decide.promotion(row, p.decisions).first()
        return got["promote"], got["reason"]

    if champion is None:
        promoted, reason = verdict(best["mape"], None)
    else:
        tag = before["tags"].get("trained_through")
        seen = F.lit(None if tag is None else int(tag)).cast("int")
        fair = decide.fair_hours(ho, seen, [], d=p.decisions).first()
        if not fair["comparable"]:
            promoted, reason = False, f"only {fair['days']} unseen days, {p.decisions.min_fresh_days} needed"
        else:
            fresh = ho if tag is None else ho.where(F.col("h") > int(tag))
            both = {r["family"]: r["mape"] for r in board(
                spark, {"champion": champion, "challenger": fitted[best["family"]]}, fresh)}
            champ_mape = both["champion"]
            promoted, reason = verdict(both["challenger"], champ_mape)
    if promoted:
        registry.set_alias("champion", version)
    table = spark.createDataFrame(
        [{**r, "n": int(r["n"]), "selected": r["family"] == best["family"], "registered_version": str(version),
          "champion_version_before": str(before["version"]) if before else "none",
          "champion_mape_on_holdout": champ_mape, "promoted": promoted and r["family"] == best["family"],
          "decision": reason, "env": p.env, "trigger": trigger, "job_run_id": run_id} for r in rows],
        "family string, n bigint, mape double, wape double, mae double, rmse double, bias_pct double, peak_mape double, "
        "selected boolean, registered_version string, champion_version_before string, champion_mape_on_holdout double, "
        "promoted boolean, decision string, env string, trigger string, job_run_id string")
    T.append(table.withColumn("trained_at", F.current_timestamp()), p.path("monitoring.model_selection"))
    data.unpersist()
    return {"version": version, "family": best["family"], "promoted": promoted, "reason": reason, "board": rows}


def trained_through_ts():
    """The trained_through tag is an hour position; this is its timestamp."""
    return hour_ts(F.col("tags")["trained_through"].cast("int"))
