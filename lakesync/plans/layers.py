"""From the ODS layer to cleaned downstream tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync import schemas as S


def increment(ods: DataFrame, since: int | None) -> DataFrame:
    """ODS rows synced after a time; the filter reaches the parquet scan."""
    return ods if since is None else ods.where(F.col(S.SYNC_TS) > since)


def clean_apply(
    dwd: DataFrame, ods: DataFrame, keys: Sequence[str], since: int | None = None, gone: DataFrame | None = None
) -> DataFrame:
    """Downstream table after an ODS increment.

    Changed keys are replaced, softly deleted ones (is_del other than 0) removed, and so are
    the keys in `gone`, which the source deleted for good (see StateStore.deleted_keys). The
    ODS holds one row per key, so no fold is needed.
    """
    changed = increment(ods, since)
    live = changed.where(F.coalesce(F.col(S.IS_DEL), F.lit(0)) == 0).drop(S.IS_DEL)
    touched = changed.select(*keys)
    if gone is not None:
        touched = touched.unionByName(gone.select(*keys))
    kept = dwd.join(touched, list(keys), "left_anti")
    return kept.unionByName(live.select(*dwd.columns))


def latest_sync(ods: DataFrame) -> DataFrame:
    """High-water mark of the next increment."""
    return ods.agg(F.max(S.SYNC_TS).alias("since"))
