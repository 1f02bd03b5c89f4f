"""Sync rules, route resolution and routing of changes.

Rules are configuration; the catalog lists the source tables. Resolution runs over
distinct catalog rows, so patterns are matched once per table and never per change.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.functions import shards
from lakesync.session import BROADCAST_ROWS, measured_broadcast, stored

# Which tables of a database a rule takes.
ALL = 1
INCLUDE = 2
EXCLUDE = 3

# Fixed value: rows per write batch when a rule names none.
BATCH_SIZE = 1024

UNROUTED = "unrouted"

_SHARD = (
    "struct<target: string, pattern: string, sharding: boolean, shard_count: int, "
    "shard_field: string, batch_size: int, nodata: boolean>"
)
_RULE = (
    "struct<name: string, pattern: string, target: string, sync_type: int, "
    f"tables: array<string>, shards: array<{_SHARD}>>"
)


@dataclass(frozen=True)
class ShardRule:
    """Source tables matching `pattern` go to the one target table `target`.

    `sharding=False` only renames. `count` re-shards by `shard_field`.
    """

    target: str
    pattern: str
    sharding: bool = True
    count: str | int | None = None
    shard_field: str | None = shards.UID_FIELD
    batch_size: int = 0
    nodata: bool = False


@dataclass(frozen=True)
class DatabaseRule:
    """What to take from the databases called `name` or fully matching `pattern`."""

    instance: str
    name: str
    pattern: str | None = None
    target: str | None = None
    sync_type: int = INCLUDE
    tables: Sequence[str] | None = None
    shards: Sequence[ShardRule] = field(default_factory=tuple)


def rules_from_config(instance: str, details: dict) -> list[DatabaseRule]:
    """Rules of one instance from its nested `details` mapping, in configuration order.

    Both spellings of the sharding block are read: dbNameSource/dbNameTarget with
    `target: pattern` tables, and sourceDb/targetDb with a mapping per table.
    """
    rules = []
    for name, detail in details.items():
        block = detail.get("sharding") or {}
        shard_rules = []
        for target, spec in (block.get("tables") or {}).items():
            if isinstance(spec, str):
                shard_rules.append(ShardRule(target, spec))
            else:
                shard_rules.append(
                    ShardRule(
                        target,
                        spec["sourceTable"],
                        spec.get("sharding", True),
                        spec.get("shardingType"),
                        spec.get("shardingFieldName", shards.UID_FIELD),
                        spec.get("batchSize", 0),
                        spec.get("nodata", False),
                    )
                )
        rules.append(
            DatabaseRule(
                instance,
                name,
                block.get("dbNameSource") or block.get("sourceDb"),
                block.get("dbNameTarget") or block.get("targetDb"),
                detail.get("type", 0),
                detail.get("tables"),
                tuple(shard_rules),
            )
        )
    return rules


def rules_constant(rules: Sequence[DatabaseRule]) -> Column:
    """Rules as one constant: instance -> its rules in configuration order.

    Being a constant, they need no join and travel with the plan.
    """
    per_instance: dict[str, list] = {}
    for r in rules:
        shard_rules = [
            {
                "target": s.target,
                "pattern": s.pattern,
                "sharding": s.sharding,
                "shard_count": shards.shard_count(s.count),
                "shard_field": s.shard_field,
                "batch_size": s.batch_size if s.batch_size > 0 else BATCH_SIZE,
                "nodata": s.nodata,
            }
            for s in r.shards
        ]
        rule = {
            "name": r.name,
            "pattern": r.pattern or None,
            "target": r.target or None,
            "sync_type": r.sync_type,
            "tables": None if r.tables is None else list(r.tables),
            "shards": shard_rules,
        }
        per_instance.setdefault(r.instance, []).append(rule)
    return F.from_json(F.lit(json.dumps(per_instance)), f"map<string, array<{_RULE}>>")


def full_match(name: Column, pattern: Column) -> Column:
    return F.rlike(name, F.concat(F.lit("^(?:"), pattern, F.lit(")$")))


def table_selected(sync_type: Column, tables: Column, table: Column) -> Column:
    """Sync-type filter; a missing list with INCLUDE or EXCLUDE selects nothing."""
    listed = F.array_contains(tables, table)
    chosen = (
        F.when(sync_type == ALL, True)
        .when(tables.isNull(), False)
        .when(sync_type == INCLUDE, listed)
        .when(sync_type == EXCLUDE, ~listed)
        .otherwise(False)
    )
    return F.coalesce(chosen, F.lit(False))


def resolve_databases(catalog: DataFrame, rules: Sequence[DatabaseRule]) -> DataFrame:
    """Source database -> target database by the first matching rule of its instance."""
    dbs = _ruled(catalog.select("instance", "db").distinct(), rules)
    return dbs.select("instance", F.col("db").alias("src_db"), F.coalesce("rule.target", "db").alias("dst_db"))


def resolve_routes(catalog: DataFrame, rules: Sequence[DatabaseRule]) -> DataFrame:
    """Catalog rows (instance, db, table) to ROUTE rows.

    Per table: the first rule of the database, then its shard patterns in order, then
    the table list. Tables no rule takes have no route.
    """
    ruled = _ruled(catalog.select("instance", "db", "table"), rules)
    hit = F.get(F.filter("rule.shards", lambda s: full_match(F.col("table"), s["pattern"])), F.lit(0))
    listed = table_selected(F.col("rule.sync_type"), F.col("rule.tables"), F.col("table"))
    sharded = ruled.withColumn("hit", hit).where(F.col("hit").isNotNull() | listed)
    return sharded.select(
        "instance",
        F.col("db").alias("src_db"),
        F.col("table").alias("src_table"),
        F.coalesce("rule.target", "db").alias("dst_db"),
        F.coalesce("hit.target", "table").alias("dst_table"),
        F.coalesce("hit.sharding", F.lit(False)).alias("sharding"),
        F.coalesce("hit.shard_count", F.lit(1)).alias("shard_count"),
        F.when(F.col("hit.shard_count") > 1, F.col("hit.shard_field")).alias("shard_field"),
        F.coalesce("hit.batch_size", F.lit(BATCH_SIZE)).alias("batch_size"),
        F.coalesce("hit.nodata", F.lit(False)).alias("nodata"),
    )


def data_routes(routes: DataFrame) -> DataFrame:
    """Routes that carry data; `nodata` tables are created but not filled."""
    return routes.where(~F.col("nodata"))


def with_shard_indexes(routes: DataFrame) -> DataFrame:
    """Database and table index of every sharded source, once per route."""
    return routes.withColumns(
        {
            "db_index": F.when(F.col("sharding"), shards.database_index("src_db")),
            "table_index": F.when(F.col("sharding"), shards.table_index("src_table")),
        }
    )


def route_collisions(routes: DataFrame) -> DataFrame:
    """Routes that cannot work, with the reason and the number of routes involved.

    duplicate_source     one source table has several routes
    unsharded_merge      several sources feed a target without lineage columns
    several_instances    a target is fed by instances, which have no common order
    """
    duplicate = (
        routes.groupBy("instance", "src_db", "src_table")
        .agg(F.count(F.lit(1)).alias("routes"))
        .where("routes > 1")
        .select(
            F.lit("duplicate_source").alias("problem"),
            F.concat_ws(".", "instance", "src_db", "src_table").alias("subject"),
            "routes",
        )
    )
    targets = routes.groupBy("dst_db", "dst_table").agg(
        F.count(F.lit(1)).alias("routes"),
        F.count_if(~F.col("sharding")).alias("plain"),
        F.min("instance").alias("first_instance"),
        F.max("instance").alias("last_instance"),
    )
    subject = F.concat_ws(".", "dst_db", "dst_table").alias("subject")
    merged = targets.where("routes > 1 and plain > 0").select(
        F.lit("unsharded_merge").alias("problem"), subject, "routes"
    )
    mixed = targets.where("first_instance <> last_instance").select(
        F.lit("several_instances").alias("problem"), subject, "routes"
    )
    return duplicate.unionByName(merged).unionByName(mixed)


def check_routes(routes: DataFrame, allow: Sequence[str] = ()) -> None:
    """Fail if routes cannot work; problems named in `allow` are the caller's to answer for."""
    broken = route_collisions(routes).where(~F.col("problem").isin(*allow)) if allow else route_collisions(routes)
    counts = {r["problem"]: r["subjects"] for r in broken.groupBy("problem").agg(F.count("*").alias("subjects")).collect()}
    if counts:
        some = [f"{r['problem']} {r['subject']}" for r in broken.orderBy("problem", "subject").limit(10).collect()]
        total = ", ".join(f"{n} {problem}" for problem, n in sorted(counts.items()))
        raise ValueError(f"routes that cannot work ({total}): " + ", ".join(some))


def named_routes(changes: DataFrame, routes: DataFrame) -> DataFrame:
    """Routes of the tables that some changes name. The names are made distinct before they move, the changes stay."""
    names = changes.select("instance", F.col("db").alias("src_db"), F.col("table").alias("src_table")).distinct()
    return stored(routes.join(names, ["instance", "src_db", "src_table"], "left_semi"), "routes")


def route(changes: DataFrame, routes: DataFrame, check_size: bool = True) -> DataFrame:
    """Attach its route to every change; changes without one get reason `unrouted`.

    One left join serves the main path and the quarantine. The routes are broadcast when
    counted small. Of more routes, those that the changes name are looked up first and broadcast
    when measured small; only beyond that the join shuffles, and adaptive execution splits the
    partitions of a hot source table. `check_size=False` takes the routes as they come,
    for callers that have hinted them once for many batches.
    """
    sized = routes
    if check_size:
        few = routes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        sized = F.broadcast(routes) if few else routes if changes.isStreaming else measured_broadcast(named_routes(changes, routes))
    keyed = sized.withColumnsRenamed({"src_db": "db", "src_table": "table"})
    joined = changes.join(keyed, ["instance", "db", "table"], "left")
    return joined.withColumn(
        "_reason",
        F.coalesce("_reason", F.when(F.col("dst_table").isNull(), F.lit(UNROUTED))),
    )


def new_routes(routes: DataFrame, done: DataFrame) -> DataFrame:
    """Routes whose source table has not been snapshotted yet."""
    keys = ["instance", "src_db", "src_table"]
    return routes.join(done.select(*keys), keys, "left_anti")


def _ruled(catalog: DataFrame, rules: Sequence[DatabaseRule]) -> DataFrame:
    """Catalog rows with their first matching rule, unmatched ones left out."""

    def takes(rule: Column) -> Column:
        by_pattern = F.coalesce(full_match(F.col("db"), rule["pattern"]), F.lit(False))
        return by_pattern | (rule["name"] == F.col("db"))

    candidates = rules_constant(rules)[F.col("instance")]
    ruled = catalog.withColumn("rule", F.get(F.filter(candidates, takes), F.lit(0)))
    return ruled.where(F.col("rule").isNotNull())
