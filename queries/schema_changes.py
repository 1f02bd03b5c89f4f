"""DDL events: capture, actions, target statements, evolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.functions.types import ColumnSpec
from lakesync.operators import ddl, decode, quality
from lakesync.operators.routes import route
from queries import feed as E


def _ddl_text():
    """One of eight statements per event."""
    k, tbl, db = F.col("k"), F.col("tbl"), F.col("db")
    texts = [
        F.format_string("ALTER TABLE `%s` ADD COLUMN `n%d` VARCHAR(20) COMMENT 'note %d' AFTER `id`", tbl, k, k),
        F.format_string("alter table %s add column n%d decimal(10,2) first, add a%d int unsigned", tbl, k, k),
        F.format_string("ALTER TABLE `%s` CHANGE COLUMN `value` `v%d` DOUBLE COMMENT 'it''s, ok'", tbl, k),
        F.format_string("ALTER TABLE `%s` DROP COLUMN `n%d`", tbl, k),
        F.format_string(
            "ALTER TABLE `%s` ADD (`x%d` BIGINT, `y%d` DATE COMMENT 'a,b'), DROP COLUMN z%d, ADD COLUMN `x%d` BIGINT",
            tbl, k, k, k, k,
        ),
        F.format_string("CREATE INDEX i%d ON %s (value)", k, tbl),
        F.format_string(
            "ALTER TABLE `%s`.`%s` MODIFY COLUMN `value` BIGINT, CHANGE `v%d` `v%d` DATETIME AFTER `w%d`, RENAME COLUMN r%d TO `s%d`",
            db, tbl, k, k, k, k, k,
        ),
        F.format_string(
            "ALTER TABLE `%s` ADD INDEX idx (value), DROP PRIMARY KEY; ALTER TABLE `%s` ADD q%d TEXT COMMENT 'x;y'",
            tbl, tbl, k,
        ),
    ]
    return F.get(F.array(*texts), (F.col("event_id") % 8).cast("int"))


def ddl_feed(spark, sf_dir):
    """Every event as a DDL event; some repeat a position, some lack one."""
    e = E.event_parts(E.table(spark, sf_dir, "events")).withColumn("ddl", _ddl_text())
    file = F.when(F.col("event_id") % 11 != 0, F.col("file"))

    def docs(rows, ms, instance):
        return rows.select(
            F.to_json(
                F.struct(
                    F.lit(instance).alias("instance"),
                    F.struct("db", F.col("tbl").alias("table"), (F.col("event_id") + ms).alias("ts_ms")).alias("source"),
                    F.to_json(F.struct("ddl")).alias("historyRecord"),
                    F.to_json(F.struct(file.alias("file"), F.col("event_id").alias("pos"))).alias("offset"),
                )
            ).alias("value")
        )

    again = docs(e.where("event_id % 3 = 0"), 5, "i0")
    other = docs(e.where("event_id % 5 = 0"), 7, "i1")
    return docs(e, 1, "i0").unionByName(again).unionByName(other)


def _captured(spark, sf_dir):
    routes = E.shop_routes(spark, sf_dir)
    both = routes.unionByName(routes.withColumn("instance", F.lit("i1")))
    return ddl.capture(route(decode.decode(ddl_feed(spark, sf_dir)), both))


def ddl_dedup(spark, sf_dir):
    """DDL log: one row per instance and position, names of source and target."""
    log, _ = _captured(spark, sf_dir)
    return log.select(*S.DDL_LOG_COLUMNS)


def ddl_blank_offset(spark, sf_dir):
    """DDL events without a log position, set aside."""
    _, blank = _captured(spark, sf_dir)
    return quality.quarantined(blank).groupBy("reason", "instance").agg(F.count(F.lit(1)).alias("events"))


def ddl_actions(spark, sf_dir):
    """ALTER actions of the log, one row each."""
    log, _ = _captured(spark, sf_dir)
    rows = ddl.actions(log.where("instance = 'i0'"))
    skipped = F.col("action") == ddl.SKIP
    return rows.select(
        "pos", F.col("seq").cast("bigint").alias("seq"), "action",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("column_name", "new_name", "type_name", "after_col")],
        F.when(skipped, F.lit("")).otherwise(F.coalesce("comment", F.lit(""))).alias("comment"), "first",
    )


def ddl_text(spark, sf_dir):
    """Statements for the target, in log order."""
    log, _ = _captured(spark, sf_dir)
    report = ddl.ddl_report(ddl.in_log_order(log.where("instance = 'i1'")), "no %s app %s job %s %s.%s at %s: %s -> %s")
    return report.select("pos", "order_no", "target_ddl", F.substring("message", 1, 30).alias("message"))


CUSTOMER_COLUMNS = [
    ColumnSpec("c_custkey", "BIGINT", is_pk=True),
    ColumnSpec("c_name", "VARCHAR"),
    ColumnSpec("c_nationkey", "INT"),
    ColumnSpec("c_acctbal", "DOUBLE"),
    ColumnSpec("c_mktsegment", "VARCHAR"),
]


def _customer_ddl(spark, sf_dir):
    """DDL log of the customer table, one event per region."""
    texts = [
        "ALTER TABLE customer ADD COLUMN note VARCHAR(20) COMMENT 'free, text' AFTER c_custkey, ADD COLUMN c_name INT",
        "ALTER TABLE customer CHANGE c_nationkey nation BIGINT COMMENT 'n' FIRST",
        "ALTER TABLE customer DROP COLUMN c_mktsegment",
        "ALTER TABLE customer CHANGE c_acctbal balance DECIMAL(12,2), ADD total INT AFTER balance",
        "ALTER TABLE customer RENAME COLUMN c_name TO name, MODIFY name VARCHAR(99) AFTER nation, DROP total",
    ]
    region = E.table(spark, sf_dir, "region")
    key = F.col("r_regionkey")
    return region.select(
        F.lit("i0").alias("instance"), F.lit("shop").alias("dst_db"), F.lit("customer").alias("dst_table"),
        F.get(F.array(*[F.lit(t) for t in texts]), key).alias("ddl"),
        F.lit("bin.000001").alias("file"), (key * 100 + 100).cast("bigint").alias("pos"), key.cast("bigint").alias("ts_ms"),
    )


def schema_evolved(spark, sf_dir):
    """Customers in the layout five ALTER statements leave behind."""
    customer = E.table(spark, sf_dir, "customer")
    evolution = ddl.evolve_from_log(CUSTOMER_COLUMNS, _customer_ddl(spark, sf_dir), "shop", "customer")
    out = ddl.evolved_table(customer, evolution)
    order = F.lit(",".join(out.columns))
    return out.select(
        "nation", "name", "c_custkey", F.coalesce("note", F.lit("")).alias("note"),
        F.col("balance").cast("string").alias("balance"), order.alias("columns"),
    )


def evolved_changes(spark, sf_dir):
    """Changes from before and after the DDL events in one projection."""
    customer = E.table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    # Five schema versions of the same table, by position.
    pos = key % 600
    v0 = F.struct("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    v1 = F.struct("c_custkey", F.lit("hi").alias("note"), "c_name", F.col("c_nationkey").alias("nation"), "c_acctbal")
    v2 = F.struct(
        "c_custkey", F.lit("yo").alias("note"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
    )
    image = (
        F.when(pos < 100, F.to_json(v0)).when(pos < 500, F.to_json(_v_mid(v1))).otherwise(F.to_json(v2))
    )
    text = F.concat(
        F.lit('{"instance":"i0","op":"c","after":'), image,
        F.lit(',"source":{"db":"shop","table":"customer","ts_ms":1,"file":"bin.000001","pos":'), pos, F.lit("}}"),
    )
    changes = decode.decode(customer.select(text.alias("value")))
    evolution = ddl.evolve_from_log(CUSTOMER_COLUMNS, _customer_ddl(spark, sf_dir), "shop", "customer")
    rows = ddl.evolved_rows(changes, evolution)
    return rows.select(
        "c_custkey", F.coalesce("nation", F.lit(-1).cast("bigint")).alias("nation"), "name",
        F.coalesce("note", F.lit("")).alias("note"), F.col("balance").cast("string").alias("balance"),
    )


def _v_mid(v1):
    """Between the events at 100 and 500 the columns change one by one; the row carries all spellings."""
    return F.struct(
        v1["c_custkey"].alias("c_custkey"), v1["note"].alias("note"), v1["c_name"].alias("c_name"),
        F.col("c_nationkey").alias("c_nationkey"), v1["nation"].alias("nation"),
        v1["c_acctbal"].alias("c_acctbal"), v1["c_acctbal"].alias("balance"),
    )


QUERIES = {
    "ddl_dedup": ddl_dedup,
    "ddl_blank_offset": ddl_blank_offset,
    "ddl_actions": ddl_actions,
    "ddl_text": ddl_text,
    "schema_evolved": schema_evolved,
    "evolved_changes": evolved_changes,
}

DDL_SQL = f"""{E.E_SQL}, d AS (SELECT *, CASE event_id % 8
  WHEN 0 THEN 'ALTER TABLE `' || tbl || '` ADD COLUMN `n' || k || '` VARCHAR(20) COMMENT ''note ' || k || ''' AFTER `id`'
  WHEN 1 THEN 'alter table ' || tbl || ' add column n' || k || ' decimal(10,2) first, add a' || k || ' int unsigned'
  WHEN 2 THEN 'ALTER TABLE `' || tbl || '` CHANGE COLUMN `value` `v' || k || '` DOUBLE COMMENT ''it''''s, ok'''
  WHEN 3 THEN 'ALTER TABLE `' || tbl || '` DROP COLUMN `n' || k || '`'
  WHEN 4 THEN 'ALTER TABLE `' || tbl || '` ADD (`x' || k || '` BIGINT, `y' || k || '` DATE COMMENT ''a,b''), DROP COLUMN z'
    || k || ', ADD COLUMN `x' || k || '` BIGINT'
  WHEN 5 THEN 'CREATE INDEX i' || k || ' ON ' || tbl || ' (value)'
  WHEN 6 THEN 'ALTER TABLE `' || db || '`.`' || tbl || '` MODIFY COLUMN `value` BIGINT, CHANGE `v' || k || '` `v' || k
    || '` DATETIME AFTER `w' || k || '`, RENAME COLUMN r' || k || ' TO `s' || k || '`'
  ELSE 'ALTER TABLE `' || tbl || '` ADD INDEX idx (value), DROP PRIMARY KEY; ALTER TABLE `' || tbl || '` ADD q' || k
    || ' TEXT COMMENT ''x;y''' END AS ddl FROM e WHERE event_id % 11 <> 0)"""

HEAD = "'alter table shop_db.t_event '"

ORACLE = {
    "ddl_dedup": f"""WITH {DDL_SQL},
u AS (SELECT 'i0' AS instance, *, event_id + 1 AS ms FROM d UNION ALL SELECT 'i1', *, event_id + 7 FROM d WHERE event_id % 5 = 0)
SELECT instance, db AS src_db, tbl AS src_table, 'shop_db' AS dst_db, 't_event' AS dst_table, ddl, file,
  event_id AS pos, ms AS ts_ms FROM u""",
    "ddl_blank_offset": """WITH b AS (SELECT event_id FROM events WHERE event_id % 11 = 0)
SELECT 'blank_offset' AS reason, 'i0' AS instance, count(*) + count(*) FILTER (WHERE event_id % 3 = 0) AS events FROM b
UNION ALL SELECT 'blank_offset', 'i1', count(*) FROM b WHERE event_id % 5 = 0""",
    "ddl_actions": f"""WITH {DDL_SQL},
x AS (SELECT event_id, event_id % 8 AS t, k, unnest(CASE event_id % 8 WHEN 1 THEN [0, 1] WHEN 4 THEN [0, 1, 2, 3]
      WHEN 6 THEN [0, 1, 2] WHEN 7 THEN [0, 1, 2] ELSE [0] END) AS s FROM d)
SELECT event_id AS pos, CAST(s AS BIGINT) AS seq,
  CASE WHEN t IN (0, 1) THEN 'ADD' WHEN t = 2 THEN 'CHANGE' WHEN t = 3 THEN 'DROP'
       WHEN t = 4 THEN CASE s WHEN 2 THEN 'DROP' ELSE 'ADD' END WHEN t = 5 THEN 'SKIP'
       WHEN t = 6 THEN 'CHANGE'
       ELSE CASE s WHEN 2 THEN 'ADD' ELSE 'SKIP' END END AS action,
  CASE WHEN t = 0 THEN 'n' || k WHEN t = 1 THEN CASE s WHEN 0 THEN 'n' ELSE 'a' END || k WHEN t = 2 THEN 'value'
       WHEN t = 3 THEN 'n' || k WHEN t = 4 THEN CASE s WHEN 1 THEN 'y' WHEN 2 THEN 'z' ELSE 'x' END || k
       WHEN t = 6 THEN CASE s WHEN 0 THEN 'value' WHEN 1 THEN 'v' || k ELSE 'r' || k END
       WHEN t = 7 AND s = 2 THEN 'q' || k ELSE '' END AS column_name,
  CASE WHEN t = 2 OR (t = 6 AND s = 1) THEN 'v' || k WHEN t = 6 AND s = 0 THEN 'value' WHEN t = 6 THEN 's' || k ELSE '' END AS new_name,
  CASE WHEN t = 0 THEN 'VARCHAR' WHEN t = 1 THEN CASE s WHEN 0 THEN 'DECIMAL' ELSE 'INT UNSIGNED' END
       WHEN t = 2 THEN 'DOUBLE' WHEN t = 4 THEN CASE s WHEN 1 THEN 'DATE' WHEN 2 THEN '' ELSE 'BIGINT' END
       WHEN t = 6 THEN CASE s WHEN 0 THEN 'BIGINT' WHEN 1 THEN 'DATETIME' ELSE '' END WHEN t = 7 AND s = 2 THEN 'TEXT' ELSE '' END AS type_name,
  CASE WHEN t = 0 THEN 'id' WHEN t = 6 AND s = 1 THEN 'w' || k ELSE '' END AS after_col,
  CASE WHEN t = 0 THEN 'note ' || k WHEN t = 2 THEN 'it''s, ok' WHEN t = 4 AND s = 1 THEN 'a,b'
       WHEN t = 7 AND s = 2 THEN 'x;y' ELSE '' END AS comment,
  t = 1 AND s = 0 AS first FROM x""",
    "ddl_text": f"""WITH {DDL_SQL}
SELECT event_id AS pos, 'i1_' || file || '_' || event_id AS order_no, CASE event_id % 8
  WHEN 0 THEN {HEAD} || 'add columns (n' || k || ' string comment ''note ' || k || ''' after id)'
  WHEN 1 THEN {HEAD} || 'add columns (n' || k || ' decimal(38, 20) comment '''' first);' || chr(10)
    || {HEAD} || 'add columns (a' || k || ' int comment '''')'
  WHEN 2 THEN {HEAD} || 'rename column value to v' || k || ';' || chr(10)
    || {HEAD} || 'alter column v' || k || ' comment ''it\\''s, ok'''
  WHEN 3 THEN {HEAD} || 'drop column n' || k
  WHEN 4 THEN {HEAD} || 'add columns (x' || k || ' long comment '''');' || chr(10)
    || {HEAD} || 'add columns (y' || k || ' date comment ''a,b'');' || chr(10) || {HEAD} || 'drop column z' || k
  WHEN 5 THEN ''
  WHEN 6 THEN {HEAD} || 'alter column v' || k || ' after w' || k || ';' || chr(10) || {HEAD} || 'rename column r' || k || ' to s' || k
  ELSE {HEAD} || 'add columns (q' || k || ' string comment ''x;y'')' END AS target_ddl,
  substr('no i1_' || file || '_' || event_id || ' app  job  shop_db.t_event at ', 1, 30) AS message
FROM d WHERE event_id % 5 = 0""",
    "schema_evolved": """SELECT CAST(c_nationkey AS BIGINT) AS nation, c_name AS name, c_custkey, '' AS note,
  CAST(CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(38,20)) AS VARCHAR) AS balance,
  'nation,name,c_custkey,note,balance' AS columns FROM customer""",
    "evolved_changes": """SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS nation, c_name AS name,
  CASE WHEN c_custkey % 600 < 100 THEN '' WHEN c_custkey % 600 < 500 THEN 'hi' ELSE 'yo' END AS note,
  CAST(CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(38,20)) AS VARCHAR) AS balance FROM customer""",
}
