"""Decoding, typing, clocks, containers, quarantine, messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.functions import naming, shards, wire
from lakesync.functions import types as T
from lakesync.functions.types import ColumnSpec
from lakesync.operators import decode, quality, reshard
from lakesync.operators.typed import typed_rows
from lakesync.plans import sync
from lakesync.sinks import queue
from lakesync.sources import envelopes
from queries import feed as E


def decode_ops(spark, sf_dir):
    """Operation codes, images and flags of the decoded feed."""
    d = decode.decode(E.feed(spark, sf_dir))
    return d.groupBy("instance", "db", "table", F.col("op").cast("int").alias("op"), "incremental").agg(
        F.count(F.lit(1)).alias("changes"),
        F.count("row").alias("images"),
        F.max("ts_ms").alias("last_ms"),
        F.max("file").alias("last_file"),
        F.max("pos").alias("last_pos"),
    )


def typed_events(spark, sf_dir):
    """Every change as a typed row with sync time."""
    rows = sync.typed_changes(E.feed(spark, sf_dir), E.EVENT_COLUMNS, f_ts=42)
    return E.event_result(rows.withColumn("pos", F.col(S.CHANGE_ORD)["pos"]), "pos", S.SYNC_TS)


CLOCK_COLUMNS = [
    ColumnSpec("o_orderkey", "BIGINT", is_pk=True),
    ColumnSpec("d", "DATE"),
    ColumnSpec("cd", "DATE", wire=T.CONNECT_DATE),
    ColumnSpec("ms", "DATETIME"),
    ColumnSpec("us", "DATETIME", wire=T.MICRO_TIMESTAMP),
    ColumnSpec("ns", "DATETIME", wire=T.NANO_TIMESTAMP),
    ColumnSpec("z", "TIMESTAMP"),
    ColumnSpec("t", "TIME"),
    ColumnSpec("tn", "TIME", wire=T.NANO_TIME),
    ColumnSpec("tc", "TIME", wire=T.CONNECT_TIME),
    ColumnSpec("zero", "DATETIME"),
]


def _order_micros():
    """Order date plus a time of day taken from the key."""
    return E.micros("o_orderdate") + F.col("o_orderkey") % 86_399 * 1_000_000 + F.col("o_orderkey") % 1000 * 1001


def time_types(spark, sf_dir):
    """All wire clocks of an order, in the zone +07:00 for the zoned one."""
    orders = E.table(spark, sf_dir, "orders").withColumn("us", _order_micros())
    day = F.lit(wire.DAY_MICROS).cast("bigint")
    of_day = F.pmod(F.col("us"), day)
    instant = F.date_format(F.timestamp_micros("us"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    image = F.struct(
        "o_orderkey",
        F.unix_date(F.col("o_orderdate").cast("date")).alias("d"),
        F.unix_date(F.col("o_orderdate").cast("date")).alias("cd"),
        F.call_function("div", F.col("us"), F.lit(1000)).alias("ms"),
        "us",
        (F.col("us") * 1000 + 7).alias("ns"),
        instant.alias("z"),
        of_day.alias("t"),
        (of_day * 1000 + 999).alias("tn"),
        F.call_function("div", of_day, F.lit(1000)).alias("tc"),
        F.lit("0000-00-00 00:00:00").alias("zero"),
    )
    docs = E.row_envelopes(orders, "shop", "orders", image, F.col("o_orderkey"))
    rows = typed_rows(decode.decode(docs), CLOCK_COLUMNS, target_zone="+07:00")
    return rows.where(F.col(S.REASON).isNull()).select(
        "o_orderkey",
        F.col("d").cast("string").alias("d"),
        F.col("cd").cast("string").alias("cd"),
        *[E.clock(c).alias(c) for c in ("ms", "us", "ns", "z")],
        *[F.col(c).cast("string").alias(c) for c in ("t", "tn", "tc")],
        F.col("zero").isNull().alias("zero"),
    )


def zone_shift(spark, sf_dir):
    """Migration clocks: shifted text, epoch kept, zoned text with and without fraction."""
    orders = E.table(spark, sf_dir, "orders")
    ms = F.when(F.col("o_orderkey") % 10 == 0, 0).otherwise(
        F.call_function("div", _order_micros(), F.lit(1000))
    ).cast("bigint")
    shift = wire.zone_shift("GMT+8", "+07:00")
    short = F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    long = F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    zoned = F.when(F.col("o_orderkey") % 2 == 0, short).otherwise(long)
    return orders.select(
        "o_orderkey",
        wire.shifted_millis(ms, shift).alias("shifted"),
        wire.shifted_text(ms, shift).alias("shifted_text"),
        wire.shifted_text(ms, 0).alias("plain_text"),
        wire.zoned_text(zoned, "GMT+7").alias("zoned"),
        wire.zoned_iso_text(zoned, "Asia/Jakarta").alias("iso"),
    )


PART_COLUMNS = [
    ColumnSpec("id", "BIGINT", is_pk=True),
    ColumnSpec("price", "DECIMAL(30,12)"),
    ColumnSpec("raw", "BLOB"),
    ColumnSpec("flag", "BIT"),
    ColumnSpec("on", "BOOLEAN"),
    ColumnSpec("small", "SMALLINT UNSIGNED"),
    ColumnSpec("real", "FLOAT"),
    ColumnSpec("note", "VARCHAR", default="none"),
    ColumnSpec("doc", "JSON"),
]


def _part_docs(spark, sf_dir):
    part = E.table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    # Text glued together, so that twenty exact decimal places reach the wire.
    exact = F.concat(F.lit("9007199254740993."), F.lpad(key.cast("string"), 20, "0"))
    body = F.concat(
        F.lit('{"id":'), key, F.lit(',"price":'), exact,
        F.lit(',"raw":"'), F.base64(F.col("p_name").cast("binary")),
        F.lit('","flag":'), (key % 2 == 0).cast("string"), F.lit(',"on":'), (key % 3 == 0).cast("string"),
        F.lit(',"small":'), F.col("p_size"), F.lit(',"real":'), F.col("p_size") / 4,
        F.when(key % 5 == 0, F.concat(F.lit(',"note":"'), F.col("p_brand"), F.lit('"')))
        .when(key % 5 == 1, F.lit(',"note":null')).otherwise(F.lit("")),
        F.lit(',"doc":{"b":'), F.col("p_size"), F.lit(',"a":"'), F.col("p_type"),
        F.lit('"},"tags":["'), F.col("p_brand"), F.lit('","'), F.col("p_type"),
        F.lit('"],"dims":{"size":'), F.col("p_size"), F.lit(',"price":'), F.col("p_retailprice"),
        F.lit('},"attrs":{"brand":"'), F.col("p_brand"), F.lit('","type":"'), F.col("p_type"),
        F.lit('"},"pairs":[[1,"'), F.col("p_brand"), F.lit('"],['), F.col("p_size") + 1, F.lit(',"'),
        F.col("p_type"), F.lit('"]]}'),
    )
    return part.select(
        F.concat(
            F.lit('{"instance":"i0","op":"c","after":'), body,
            F.lit(',"source":{"db":"shop","table":"part","ts_ms":1,"file":"bin.1","pos":'), key, F.lit("}}"),
        ).alias("value")
    )


def primitive_types(spark, sf_dir):
    """Exact decimals, bytes, flags, numbers, defaults and nested JSON as text."""
    rows = typed_rows(decode.decode(_part_docs(spark, sf_dir)), PART_COLUMNS)
    return rows.select(
        "id", F.col("price").cast("string").alias("price"), F.col("raw").cast("string").alias("raw"),
        F.col("flag").cast("bigint").alias("flag"), "on", F.col("small").cast("bigint").alias("small"),
        F.col("real").cast("double").alias("real"), "note", "doc",
        F.col(S.REASON).isNull().alias("fits"),
    )


def container_types(spark, sf_dir):
    """Arrays, both map forms and nested structs."""
    row = F.col("row")
    d = decode.decode(_part_docs(spark, sf_dir))
    pairs = wire.keyed_pairs_field(row, "pairs", "int", "string")
    return d.select(
        F.try_variant_get(row, "$.id", "bigint").alias("id"),
        wire.array_field(row, "tags", "string").alias("tags"),
        wire.map_field(row, "attrs", "string").alias("attrs"),
        wire.struct_field(row, "dims", "size: int, price: double").alias("dims"),
        pairs.alias("pairs"),
    ).select(
        "id",
        F.array_join("tags", "|").alias("tags"),
        F.col("attrs")["brand"].alias("brand"),
        F.col("attrs")["type"].alias("type"),
        F.col("dims.size").cast("bigint").alias("size"),
        F.col("dims.price").alias("price"),
        F.col("pairs")[F.lit(1)].alias("first_pair"),
        F.array_join(F.flatten(wire.pairs_of_map(F.col("pairs"))), "|").alias("pairs"),
    )


def base64_decimals(spark, sf_dir):
    """Unscaled two's-complement bytes of both signs and several widths."""
    part = E.table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    number = F.when(key % 2 == 0, key * 1_000_003).otherwise(-key * 1_000_003)
    wide = F.lpad(F.hex(number), 16, "0")
    encoded = F.base64(F.unhex(wide))
    narrow = F.base64(F.unhex(F.substring(F.lpad(F.hex(key % 128), 2, "0"), 1, 2)))
    return part.select(
        "p_partkey",
        wire.decimal_from_base64(encoded, 4).cast("string").alias("wide"),
        wire.decimal_from_base64(narrow, 0).cast("string").alias("narrow"),
    )


def quarantine_reasons(spark, sf_dir):
    """Broken envelopes and rows by reason; nothing gets lost."""
    orders = E.table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    kind = key % 10
    image = F.struct(
        F.when(kind == 1, F.lit(None)).otherwise(key).cast("string").alias("id"),
        F.when(kind == 2, F.lit("twelve")).otherwise(F.lit("12")).alias("n"),
        F.when(kind == 3, F.lit("99999999999999999999")).otherwise(F.lit("1")).alias("amount"),
        F.lit("2147483648").alias("u"),
    )
    doc = E.envelope(
        F.when(kind == 4, F.lit("d")).otherwise(F.lit("c")), F.lit(None).cast("string"), image, F.lit("shop"),
        F.lit("orders"), F.lit(1).cast("bigint"), F.lit("bin.1"), key,
    )
    docs = orders.select(F.when(kind == 5, F.substring(doc, 1, 40)).otherwise(doc).alias("value"))
    columns = [
        ColumnSpec("id", "BIGINT", is_pk=True),
        ColumnSpec("n", "INT"),
        ColumnSpec("amount", "DECIMAL"),
        ColumnSpec("u", "INT UNSIGNED"),
    ]
    rows = typed_rows(decode.decode(docs), columns, widen_unsigned=True)
    return rows.groupBy(F.coalesce(S.REASON, F.lit("accepted")).alias("reason")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("u").alias("u")
    )


def queue_messages(spark, sf_dir):
    """Topic, key and parsed body of every log change."""
    routed = sync.routed_changes(E.feed(spark, sf_dir), E.keyed_routes(spark, sf_dir))
    m = queue.messages(routed.where(F.col(S.REASON).isNull()), "TEST")
    return m.select(
        "topic",
        "key",
        F.get_json_object("value", "$.op").cast("bigint").alias("op"),
        F.get_json_object("value", "$.row.id").cast("bigint").alias("id"),
        F.get_json_object("value", "$.row.event_type").alias("event_type"),
        F.get_json_object("value", "$.row.ts").cast("bigint").alias("us"),
        F.col("position.pos").alias("pos"),
    )


def delete_audit(spark, sf_dir):
    """Physical deletes with the deleted row, and the alert text."""
    d = decode.decode(E.feed(spark, sf_dir))
    audit = quality.delete_audit(d, "ods_biz")
    text = quality.message("deleted in %s: %s.%s", "application", "db", "table")
    return audit.select(
        "application", "db", "table", F.get_json_object("row_json", "$.id").cast("bigint").alias("id"),
        text.alias("message"),
    )


def drop_deletes(spark, sf_dir):
    """Feed without physical deletes."""
    kept = quality.without_deletes(decode.decode(E.feed(spark, sf_dir)))
    return kept.select("db", "table", "pos", F.col("op").cast("int").alias("op"))


def delete_counts(spark, sf_dir):
    """Physical deletes and other changes per source table."""
    return quality.delete_counts(decode.decode(E.feed(spark, sf_dir)))


def _started(spark, sf_dir, **start):
    d = envelopes.start_from(decode.decode(E.feed(spark, sf_dir)), **start)
    return d.select("pos", F.col("op").cast("int").alias("op"), "ts_ms")


def start_from_ts(spark, sf_dir):
    """Log from a time on."""
    return _started(spark, sf_dir, ts_ms=1_704_500_000_000)


def start_from_log(spark, sf_dir):
    """Log only, no snapshot."""
    return _started(spark, sf_dir, mode=envelopes.EARLIEST)


def start_from_pos(spark, sf_dir):
    """What follows a log position."""
    return _started(spark, sf_dir, mode=envelopes.LATEST, end=("bin.000001", 1500))


def several_instances(spark, sf_dir):
    """Two instances with tables of the same names, read as one feed."""
    orders = E.table(spark, sf_dir, "orders")
    image = F.struct("o_orderkey", "o_custkey")
    feeds = {
        "i0": decode.decode(E.row_envelopes(orders, "shop_00_db", "t_event_0", image, F.col("o_orderkey"))),
        "i1": decode.decode(E.event_envelopes(E.table(spark, sf_dir, "events"))),
    }
    return envelopes.fan_in(feeds).groupBy("instance", "table").agg(
        F.count(F.lit(1)).alias("changes"), F.max("pos").alias("last_pos")
    )


def shard_indexes(spark, sf_dir):
    """Database and table indexes of names derived from the nations and the users."""
    nation = E.table(spark, sf_dir, "nation")
    events = E.table(spark, sf_dir, "events").select((F.col("user_id") % 100).alias("u")).distinct()
    names = events.join(nation, events.u % 25 == nation.n_nationkey).select(
        F.concat(F.lit("a_"), F.lpad(F.col("u").cast("string"), 2, "0"), F.lit("_"), "n_nationkey", F.lit("_db")).alias("db"),
        F.concat(F.lit("t"), F.col("u") % 3, F.lit("_card_"), "u").alias("table"),
        F.concat(F.lit("plain_"), F.translate("n_name", "0123456789", "")).alias("plain"),
    )
    marked = reshard.with_merge_indexes(names)
    return marked.select(
        "db", "table", S.DB_INDEX, S.TABLE_INDEX,
        shards.database_index("plain").isNull().alias("no_index"),
        naming.topic("PROD", F.col("db"), F.col("table")).alias("topic"),
        naming.topic("TEST", F.col("db"), F.col("table"), "app").alias("test_topic"),
        naming.ods_namespace("PROD", F.col("db")).alias("ods"),
        naming.ods_namespace("TEST", F.col("db")).alias("test_ods"),
    )


def reshard_uid(spark, sf_dir):
    """Orders re-sharded by customer; bad keys are set aside."""
    orders = E.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 50 == 0, -F.col("o_custkey") - 1)
        .when(F.col("o_orderkey") % 50 == 1, F.lit(None))
        .otherwise(F.col("o_custkey") + 2_147_483_648)
        .alias(shards.UID_FIELD),
    )
    out = []
    for name in ("TEN", "HUNDRED", "THOUSAND", "ONE"):
        rows = reshard.with_shard(orders, shards.UID_FIELD, name)
        out.append(rows.select(F.lit(name).alias("count"), "o_orderkey", F.coalesce("shard", F.lit(-1)).cast("bigint").alias("shard"),
                               F.coalesce("_reason", F.lit("")).alias("reason")))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def uid_orders(spark, sf_dir):
    key = F.col("o_orderkey")
    uid = F.when(key % 50 == 0, -F.col("o_custkey") - 1).when(key % 50 == 1, F.lit(None)).otherwise(F.col("o_custkey") + 2_147_483_648)
    return E.table(spark, sf_dir, "orders").select("o_orderkey", uid.alias(shards.UID_FIELD))


def reshard_moved(spark, sf_dir):
    """From ten to a hundred shards: only orders whose shard differs move, the others and bad keys stay where they are."""
    moved = reshard.moves(uid_orders(spark, sf_dir), "t_order", shards.UID_FIELD, "TEN", "HUNDRED", file="bin.000009", pos=4)
    return moved.select(
        F.coalesce("dst_table", F.lit("")).alias("dst_table"), F.col("op").cast("int").alias("op"), "o_orderkey", F.coalesce("_reason", F.lit("")).alias("reason")
    )


def reshard_order(spark, sf_dir):
    """Orders re-sharded by the last three digits of a text id."""
    key = F.lpad(F.col("o_orderkey").cast("string"), 7, "0")
    orders = E.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 40 == 0, F.concat(key, F.lit("x")))
        .when(F.col("o_orderkey") % 40 == 1, F.concat(F.lit("x-"), F.substring(key, 6, 2)))
        .when(F.col("o_orderkey") % 40 == 2, F.substring(key, 6, 2))
        .otherwise(F.concat(F.lit("ORD"), key))
        .alias(shards.ORDER_FIELD),
    )
    out = None
    for name in ("TEN", "HUNDRED", "THOUSAND"):
        rows = reshard.with_shard(orders, shards.ORDER_FIELD, name).select(
            F.lit(name).alias("count"), "o_orderkey", F.coalesce("shard", F.lit(-1)).cast("bigint").alias("shard")
        )
        out = rows if out is None else out.unionByName(rows)
    return out


QUERIES = {
    "decode_ops": decode_ops,
    "typed_events": typed_events,
    "time_types": time_types,
    "zone_shift": zone_shift,
    "primitive_types": primitive_types,
    "container_types": container_types,
    "base64_decimals": base64_decimals,
    "quarantine_reasons": quarantine_reasons,
    "queue_messages": queue_messages,
    "delete_audit": delete_audit,
    "drop_deletes": drop_deletes,
    "delete_counts": delete_counts,
    "start_from_ts": start_from_ts,
    "start_from_log": start_from_log,
    "start_from_pos": start_from_pos,
    "several_instances": several_instances,
    "shard_indexes": shard_indexes,
    "reshard_uid": reshard_uid,
    "reshard_order": reshard_order,
    "reshard_moved": reshard_moved,
}

US = "(epoch_us(o_orderdate) + o_orderkey % 86399 * 1000000 + o_orderkey % 1000 * 1001)"
F6 = "'%Y-%m-%d %H:%M:%S.%f'"


def _shard_rows(kind: str, counts: dict[str, int], value: str, ok: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS count, o_orderkey, "
        f"CASE WHEN {n} = 1 THEN 0 WHEN {ok} THEN {value} % {n} ELSE -1 END AS shard{kind.format(n=n)} FROM s"
        for name, n in counts.items()
    )


ORACLE = {
    "decode_ops": f"""WITH {E.E_SQL}
SELECT 'i0' AS instance, db, tbl AS table, op, NOT snap AS incremental, count(*) AS changes, count(*) AS images,
  max(ts_ms) AS last_ms, max(file) AS last_file, max(event_id) AS last_pos FROM e GROUP BY ALL""",
    "typed_events": f"""WITH {E.E_SQL}
SELECT event_id AS pos, CAST(42 AS BIGINT) AS f_ts, id, user_id, value, event_type, {E.TS_SQL} FROM e""",
    "time_types": f"""WITH o AS (SELECT o_orderkey, o_orderdate, {US} AS us FROM orders)
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d, strftime(o_orderdate, '%Y-%m-%d') AS cd,
  strftime(make_timestamp(us // 1000 * 1000), {F6}) AS ms, strftime(make_timestamp(us), {F6}) AS us,
  strftime(make_timestamp(us), {F6}) AS ns,
  strftime(make_timestamp(us // 1000 * 1000) + INTERVAL 7 HOUR, {F6}) AS z,
  regexp_replace(regexp_replace(strftime(make_timestamp(us), '%H:%M:%S.%f'), '0+$', ''), '\\.$', '') AS t,
  regexp_replace(regexp_replace(strftime(make_timestamp(us), '%H:%M:%S.%f'), '0+$', ''), '\\.$', '') AS tn,
  regexp_replace(regexp_replace(strftime(make_timestamp(us // 1000 * 1000), '%H:%M:%S.%f'), '0+$', ''), '\\.$', '') AS tc,
  TRUE AS zero FROM o""",
    "zone_shift": f"""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE {US} // 1000 END AS ms FROM orders),
p AS (SELECT *, make_timestamp(ms * 1000) AS ts, CASE WHEN ms = 0 THEN 0 ELSE ms - 3600000 END AS sh FROM o)
SELECT o_orderkey, sh AS shifted, strftime(make_timestamp(sh * 1000), '%Y-%m-%d %H:%M:%S') AS shifted_text,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS plain_text,
  CASE WHEN o_orderkey % 2 = 0 THEN strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S')
       ELSE strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S.%g') END AS zoned,
  strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') AS iso FROM p""",
    "primitive_types": """SELECT p_partkey AS id,
  '9007199254740993.' || lpad(CAST(p_partkey AS VARCHAR), 20, '0') AS price, p_name AS raw,
  CAST(p_partkey % 2 = 0 AS BIGINT) AS flag, p_partkey % 3 = 0 AS "on", CAST(p_size AS BIGINT) AS small,
  CAST(p_size / 4 AS DOUBLE) AS real, CASE WHEN p_partkey % 5 = 0 THEN p_brand ELSE 'none' END AS note,
  '{"a":"' || p_type || '","b":' || p_size || '}' AS doc, TRUE AS fits FROM part""",
    "container_types": """SELECT p_partkey AS id, p_brand || '|' || p_type AS tags, p_brand AS brand, p_type AS type,
  CAST(p_size AS BIGINT) AS size, p_retailprice AS price, p_brand AS first_pair,
  '1|' || p_brand || '|' || (p_size + 1) || '|' || p_type AS pairs FROM part""",
    "base64_decimals": """SELECT p_partkey,
  CAST(CAST(CAST((CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE -1 END) * p_partkey * 1000003 AS DECIMAL(18,0))
       * CAST(0.0001 AS DECIMAL(4,4)) AS DECIMAL(38,20)) AS VARCHAR) AS wide,
  CAST(CAST(p_partkey % 128 AS DECIMAL(38,20)) AS VARCHAR) AS narrow FROM part""",
    "quarantine_reasons": """WITH r AS (SELECT CASE o_orderkey % 10 WHEN 1 THEN 'missing_key' WHEN 2 THEN 'bad_cast'
    WHEN 3 THEN 'bad_cast' WHEN 4 THEN 'no_image' WHEN 5 THEN 'malformed' ELSE 'accepted' END AS reason,
    CASE WHEN o_orderkey % 10 IN (4, 5) THEN NULL ELSE 2147483648 END AS u FROM orders)
SELECT reason, count(*) AS rows, CAST(sum(u) AS BIGINT) AS u FROM r GROUP BY reason""",
    "queue_messages": f"""WITH {E.E_SQL}
SELECT 'flink.test.shop_db.t_event' AS topic, '["' || id || '"]' AS key, CAST(op AS BIGINT) AS op, id, event_type,
  epoch_us(ts) AS us, event_id AS pos FROM e WHERE NOT snap""",
    "delete_audit": f"""WITH {E.E_SQL}
SELECT 'ods_biz' AS application, db, tbl AS table, id, 'deleted in ods_biz: ' || db || '.' || tbl AS message
FROM e WHERE op = 3""",
    "drop_deletes": f"WITH {E.E_SQL} SELECT db, tbl AS table, event_id AS pos, op FROM e WHERE op <> 3",
    "delete_counts": f"""WITH {E.E_SQL}
SELECT db, tbl AS table, count(*) FILTER (WHERE op <> 3) AS kept, count(*) FILTER (WHERE op = 3) AS deletes
FROM e GROUP BY ALL""",
    "start_from_ts": f"WITH {E.E_SQL} SELECT event_id AS pos, op, ts_ms FROM e WHERE ts_ms >= 1704500000000",
    "start_from_log": f"WITH {E.E_SQL} SELECT event_id AS pos, op, ts_ms FROM e WHERE NOT snap",
    "start_from_pos": f"WITH {E.E_SQL} SELECT event_id AS pos, op, ts_ms FROM e WHERE NOT snap AND event_id > 1500",
    "several_instances": f"""WITH {E.E_SQL}, b AS (SELECT 'i1' AS instance, tbl, event_id FROM e UNION ALL
  SELECT 'i0', 't_event_0', o_orderkey FROM orders)
SELECT instance, tbl AS table, count(*) AS changes, max(event_id) AS last_pos FROM b GROUP BY ALL""",
    "shard_indexes": """WITH u AS (SELECT DISTINCT user_id % 100 AS u FROM events),
n AS (SELECT 'a_' || lpad(CAST(u AS VARCHAR), 2, '0') || '_' || n_nationkey || '_db' AS db,
  't' || u % 3 || '_card_' || u AS tbl, lpad(CAST(u AS VARCHAR), 2, '0') || '_' || n_nationkey AS di,
  u % 3 || '_card_' || u AS ti FROM u JOIN nation ON u % 25 = n_nationkey)
SELECT db, tbl AS table, di AS db_index, ti AS table_index, TRUE AS no_index, 'flink.' || db || '.' || tbl AS topic,
  'app.test.' || db || '.' || tbl AS test_topic, 'ods_' || db AS ods, 'test_ods_' || db AS test_ods FROM n""",
    "reshard_uid": "WITH s AS (SELECT o_orderkey, o_orderkey % 50 AS m, o_custkey + 2147483648 AS v FROM orders) "
    + _shard_rows(
        ", CASE WHEN m > 1 OR {n} = 1 THEN '' ELSE 'bad_shard_key' END AS reason",
        {"TEN": 10, "HUNDRED": 100, "THOUSAND": 1000, "ONE": 1}, "v", "m > 1",
    ),
    "reshard_moved": """WITH s AS (SELECT o_orderkey, o_orderkey % 50 AS m, o_custkey + 2147483648 AS v FROM orders)
SELECT 't_order_' || v % 10 AS dst_table, 3 AS op, o_orderkey, '' AS reason FROM s WHERE m > 1 AND v % 10 <> v % 100
UNION ALL SELECT 't_order_' || v % 100, 0, o_orderkey, '' FROM s WHERE m > 1 AND v % 10 <> v % 100
UNION ALL SELECT '', 0, o_orderkey, 'bad_shard_key' FROM s WHERE m <= 1""",
    "reshard_order": "WITH s AS (SELECT o_orderkey, o_orderkey % 40 AS m, o_orderkey % 1000 AS v FROM orders) "
    + _shard_rows("", {"TEN": 10, "HUNDRED": 100, "THOUSAND": 1000}, "v", "m > 2"),
}
