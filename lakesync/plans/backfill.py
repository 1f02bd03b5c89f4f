"""Snapshots of tables that a rule change adds to a running job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from lakesync.operators.routes import new_routes


def backfill(routes: DataFrame, done: DataFrame, snapshot_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Snapshot feed of the tables not yet done.

    `snapshot_of` gets the new routes and returns their rows as changes or envelopes.
    The rows sort below every log change, so the log may already be running.
    """
    return snapshot_of(new_routes(routes, done))
