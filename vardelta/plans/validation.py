"""Retrospective validation as a stored run: today's triage over an old pair of snapshots, judged by a later one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vardelta import schemas as S
from vardelta.operators import history
from vardelta.schemas import KEY
from vardelta.sources import published
from vardelta.sources.store import written


def judged(findings: DataFrame, v: DataFrame, replay: str, truth: str) -> DataFrame:
    """Findings of the pair that ends with ``replay``, with their outcome; ``truth`` must be later."""
    if truth <= replay:
        raise ValueError(f"truth {truth} is not later than replay {replay}")
    return history.outcome(history.truth_join(findings, v, truth))


def run_name(replay: str, truth: str) -> str:
    return f"{replay}_vs_{truth}"


def validate(spark: SparkSession, root: str, findings: DataFrame, v: DataFrame, prev: str, replay: str, truth: str) -> str:
    """Judge the findings and publish them with the run's summary and their triage; gives the run's name.

    The judged findings are worked out once and feed all three tables.
    """
    run_id = run_name(replay, truth)
    rows = written(judged(findings, v, replay, truth), "judged")
    summary = history.validation_summary(rows).select(
        F.lit(run_id).alias("run_id"), F.lit(replay).alias("replay_snapshot"), F.lit(truth).alias("truth_snapshot"), "n_deltas",
        F.col("useful").alias("n_useful"), F.col("noise").alias("n_noise"), F.col("precision").alias("precision_actionable"),
    )
    found = rows.select(F.lit(run_id).alias("run_id"), *KEY, F.col("tier").alias("predicted_tier"), "outcome", "truth_sig")
    factors = F.to_json(F.struct(*[f"f_{name}" for name in S.TRIAGE_WEIGHTS]))
    triage = rows.select(
        F.lit(prev).alias("prev_snapshot"), F.lit(replay).alias("snapshot_id"), "sample_id", *KEY, "gene", "change_kind", "tier",
        (F.col("score_micro") / 1e6).alias("score"), factors.alias("factors"), "stars",
    )
    published.publish(
        spark, root, run_id,
        {"triage_results": lambda: triage, "validation_findings": lambda: found, "validation_runs": lambda: summary},
    )
    return run_id
