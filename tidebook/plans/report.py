"""The configuration report as three result sets."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import runstats as r


def report(
    runs: DataFrame,
    min_rate: float = r.TARGET_ROWS_PER_SECOND,
    max_elapsed: float = r.TARGET_ELAPSED_SECONDS,
) -> dict[str, DataFrame]:
    """Summary with the target flag, the per-model view, the raw rows, and the pick."""
    summary = r.with_sla(r.sizing_matrix(runs), min_rate, max_elapsed)
    return {
        "summary": summary.orderBy(*r.CONFIG_KEYS),
        "by_model": r.by_model(runs),
        "raw_data": runs,
        "recommended": r.recommend(summary),
    }


def write_report(sheets: dict[str, DataFrame], root: str) -> None:
    for name, df in sheets.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
