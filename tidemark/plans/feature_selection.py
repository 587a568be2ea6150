"""Job 1: from a wide panel to the selected drivers of every series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import importance as I
from tidemark.operators import selection as S
from tidemark.operators.impute import time_interpolate
from tidemark.operators.panel import to_long, trim_series, validate_series
from tidemark.session import materialize
from tidemark.sources.sinks import summary_document, write_csv, write_scores, write_summary_json, write_keyed
from tidemark.settings import DEFAULTS, Settings

KEYS = ["series_id", "variable"]


def prepare_panel(panel: DataFrame, drivers: Sequence[str], freq: str, settings: Settings = DEFAULTS,
                  strict: bool = True) -> DataFrame:
    """Trim, validate and impute once; the result is shared by all three jobs."""
    trimmed = trim_series(panel, drivers, freq, settings.completeness, settings.min_observations, strict=strict).drop("strategy")
    bad = validate_series(trimmed, freq, strict=strict)
    clean = trimmed if strict else trimmed.join(bad.select("series_id").distinct(), "series_id", "left_anti")
    return clean


def run_feature_selection(panel: DataFrame, drivers: Sequence[str], freq: str = "M", settings: Settings = DEFAULTS,
                          strict: bool = True) -> dict[str, DataFrame]:
    """All tables of the selection: selected, rejected, scores, vif, missing, summary."""
    drivers = list(drivers)
    clean = materialize(prepare_panel(panel, drivers, freq, settings, strict))
    _, missing = S.drop_high_missing(to_long(clean, drivers), settings.max_missing)
    missing = materialize(missing)
    filled = materialize(time_interpolate(clean, drivers))
    corr = S.corr_with_target_wide(filled, drivers, settings.min_correlation)
    corr = materialize(corr.join(missing.filter("NOT dropped").select(*KEYS), KEYS, "left_semi"))
    candidates = corr.filter("keep").select(*KEYS)
    pairs = S.corr_matrix(filled, drivers)
    for side in ("a", "b"):
        names = candidates.select("series_id", F.col("variable").alias(side))
        pairs = pairs.join(names, ["series_id", side], "left_semi")
    kept = materialize(I.vif_prune(pairs, drivers, settings.max_vif))
    # A driver that a series does not use becomes a constant there, which no ranking scores.
    masked = materialize(mask_unselected(filled, kept, drivers))
    names = kept.select(*KEYS)
    mi = S.mutual_information(to_long(masked, drivers).join(names, KEYS, "left_semi"), masked, settings.mi_bins)
    enet = I.elasticnet_rank(masked, drivers).join(names, KEYS, "left_semi")
    tree = I.tree_importance_rank(masked, drivers, settings).join(names, KEYS, "left_semi")
    aligned = materialize(S.align_scores(names, corr=I.corr_rank(corr), mi=mi, elasticnet=enet, tree=tree))
    selected = S.threshold_or_topk(S.composite_score(aligned, settings), settings)
    selected = materialize(S.selection_report(selected, corr, kept))
    shape = clean.groupBy("series_id").agg(F.count(F.lit(1)).alias("rows"), F.lit(len(drivers) + 1).cast("bigint").alias("cols"))
    return {
        "panel": filled, "missing": missing, "correlation": corr, "vif": kept, "scores": aligned, "selected": selected,
        "rejected": corr.filter("NOT keep").select(*KEYS, "corr_value"),
        "summary": summary_document(shape, missing.filter("dropped"), selected, settings),
    }


def mask_unselected(panel: DataFrame, selected: DataFrame, drivers: Sequence[str]) -> DataFrame:
    """Wide panel in which a driver is zero for the series that did not select it."""
    flags = selected.groupBy("series_id").agg(F.collect_set("variable").alias("_own"))
    rows = panel.join(flags, "series_id", "left")
    return rows.withColumns({
        d: F.when(F.array_contains("_own", d), F.col(d)).otherwise(0.0) for d in drivers}).drop("_own")


def write_feature_selection(tables: dict[str, DataFrame], folder: str, run_id: str | None = None) -> None:
    """Parquet hand-over tables, the score files with three decimals and the JSON summary."""
    for name in ("panel", "selected"):
        write_keyed(tables[name], f"{folder}/{name}", run_id)
    for label in ("mi", "elasticnet", "tree"):
        write_scores(tables["scores"].withColumn("score", F.col(label)), f"{folder}/{label}_scores", run_id)
    write_csv(tables["selected"], f"{folder}/selected_csv")
    write_csv(tables["rejected"], f"{folder}/rejected_csv")
    write_summary_json(tables["summary"], f"{folder}/summary")
