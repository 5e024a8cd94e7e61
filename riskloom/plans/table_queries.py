"""Queries over orders and line items: sources, joins, constraints, sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.operators import history, joins, limits, quality
from riskloom.plans import catalog as C
from riskloom.plans import views
from riskloom.plans.catalog import comparable, query, r
from riskloom.session import scratch_dir
from riskloom.sources import messages, sinks, tables

TX, ORDERS, RISK = C.TX, C.ORDERS, C.RISK


@query("src_table_scan", """SELECT o_orderkey AS transaction_id, o_custkey AS user_id, o_totalprice AS amount
    FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'""")
def _scan(spark, sf):
    """Three columns and one filter, both pushed into the Parquet scan."""
    return (
        views.orders(spark, sf)
        .filter(F.col("ts") >= F.lit("1997-01-01").cast("timestamp"))
        .select("transaction_id", "user_id", "amount")
    )


@query("src_empty_fallback", f"""WITH {TX} SELECT transaction_id, user_id, CAST(NULL AS BIGINT) AS total_transactions,
    CAST(NULL AS DOUBLE) AS user_avg_amount FROM tx""")
def _fallback(spark, sf):
    """No history table yet: every transaction is enriched with an empty, typed history."""
    stats = tables.read_or_empty(spark, f"{sf}/no_such_history.parquet", schemas.USER_STATS)
    tx = views.transactions(spark, sf).select("transaction_id", "user_id")
    return history.enrich(tx, stats).select("transaction_id", "user_id", "total_transactions", "user_avg_amount")


def messages_of(tx):
    """The transactions as JSON messages."""
    document = F.to_json(
        F.struct(
            "transaction_id", "user_id", "amount",
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
            "merchant_category", "payment_method", "location_lat", "location_lng", "device_id", "is_fraud",
        )
    )
    return tx.withColumn("value", document)


DECODED_SQL = f"""transaction_id, user_id, {r('amount')} AS amount, ts, merchant_category, payment_method,
    {r('location_lat')} AS location_lat, {r('location_lng')} AS location_lng, device_id, is_fraud"""
DECODED = (
    "transaction_id", "user_id", "amount", "ts", "merchant_category", "payment_method",
    "location_lat", "location_lng", "device_id", "is_fraud",
)


@query("decode_json_tx", f"WITH {TX} SELECT {DECODED_SQL} FROM tx")
def _decode(spark, sf):
    good, _ = messages.decode_json(messages_of(views.transactions(spark, sf)).select("value"))
    return comparable(messages.as_transactions(good).select(*DECODED))


@query("decode_json_envelope", f"""WITH {TX} SELECT user_id AS kafka_key, ts AS kafka_timestamp, 'transactions' AS topic,
    CAST(CAST(user_id AS BIGINT) % 8 AS INTEGER) AS "partition", CAST(transaction_id AS BIGINT) AS "offset",
    transaction_id, user_id, {r('amount')} AS amount, ts, merchant_category, is_fraud FROM tx""")
def _envelope(spark, sf):
    rows = messages_of(views.transactions(spark, sf)).select(
        F.col("user_id").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit("transactions").alias("topic"),
        (F.col("user_id").cast("bigint") % 8).cast("int").alias("partition"),
        F.col("transaction_id").cast("bigint").alias("offset"),
        F.col("ts").alias("timestamp"),
    )
    good, _ = messages.decode_json(rows, schemas.TRANSACTION_V2, keep_envelope=True)
    out = messages.as_transactions(good)
    return comparable(out.select(*messages.ENVELOPE, "transaction_id", "user_id", "amount", "ts", "merchant_category", "is_fraud"))


@query("join_anti_processed", f"""WITH {ORDERS} SELECT transaction_id, user_id, amount, ts FROM ord
    WHERE transaction_id NOT IN (SELECT transaction_id FROM lines)""")
def _anti(spark, sf):
    raw = views.orders(spark, sf).select("transaction_id", "user_id", "amount", "ts")
    return comparable(joins.drop_processed(raw, views.order_lines(spark, sf)))


@query("join_semi_fk", f"""WITH {ORDERS} SELECT transaction_id, user_id, amount,
    transaction_id IN (SELECT transaction_id FROM lines) AS accepted FROM ord""")
def _semi(spark, sf):
    """Accepted rows and quarantined rows together make the input."""
    raw = views.orders(spark, sf).select("transaction_id", "user_id", "amount")
    return joins.mark_parent(raw, views.order_lines(spark, sf))


@query("join_raw_processed", f"""WITH {ORDERS} SELECT ord.transaction_id, ord.user_id, ord.amount, lines.line,
    lines.processed_at FROM ord JOIN lines ON ord.transaction_id = lines.transaction_id""")
def _inner(spark, sf):
    raw = views.orders(spark, sf).select("transaction_id", "user_id", "amount")
    lines = views.order_lines(spark, sf).select("transaction_id", "line", "processed_at")
    return comparable(joins.raw_with_processed(raw, lines))


@query("backlog_count", """SELECT COUNT(*) AS unprocessed_count FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey
    FROM lineitem) ON o_orderkey = l_orderkey WHERE l_orderkey IS NULL""")
def _backlog(spark, sf):
    return joins.backlog(views.orders(spark, sf), views.order_lines(spark, sf))


@query("batch_audit", f"""WITH {ORDERS}, m AS (SELECT is_fraud, transaction_id IN (SELECT transaction_id FROM lines) AS known FROM ord)
    SELECT COUNT(*) AS original_count, COUNT(*) FILTER (WHERE known) AS valid_count,
    COUNT(*) FILTER (WHERE NOT known) AS skipped_count, COUNT(*) FILTER (WHERE known AND is_fraud) AS fraud_count,
    ROUND(COUNT(*) FILTER (WHERE known AND is_fraud) / CAST(COUNT(*) FILTER (WHERE known) AS DOUBLE) * 100, 2) AS fraud_pct FROM m""")
def _audit(spark, sf):
    return joins.batch_audit(views.orders(spark, sf), views.order_lines(spark, sf))


@query("insert_if_absent", f"""WITH {ORDERS}, target AS (SELECT transaction_id, amount FROM ord WHERE is_fraud),
    fresh AS (SELECT transaction_id, amount, row_number() OVER (PARTITION BY transaction_id ORDER BY line, amount) AS rn
      FROM lines WHERE transaction_id NOT IN (SELECT transaction_id FROM target))
    SELECT transaction_id, {r('amount')} AS amount, 'old' AS origin FROM target
    UNION ALL SELECT transaction_id, {r('amount')}, 'new' FROM fresh WHERE rn = 1""")
def _insert(spark, sf):
    target = views.orders(spark, sf).filter("is_fraud").select("transaction_id", "amount")
    incoming = views.order_lines(spark, sf)
    fresh = sinks.insert_if_absent(target, incoming, "transaction_id", "line", "amount").select("transaction_id", "amount")
    return comparable(
        target.withColumn("origin", F.lit("old")).unionByName(fresh.withColumn("origin", F.lit("new")))
    )


@query("dedup_by_key", f"""WITH {ORDERS} SELECT transaction_id, line, {r('amount')} AS amount, processed_at FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY line, amount, processed_at) AS rn FROM lines) WHERE rn = 1""")
def _dedup(spark, sf):
    return comparable(
        sinks.first_by_key(views.order_lines(spark, sf), "transaction_id", "line", "amount", "processed_at")
    )


@query("check_not_null", f"""WITH {ORDERS}, j AS (SELECT ord.transaction_id, ord.user_id, ord.amount, f.processed_at
    FROM ord LEFT JOIN (SELECT transaction_id, MIN(processed_at) AS processed_at FROM lines GROUP BY 1) f
    ON ord.transaction_id = f.transaction_id)
    SELECT 'transaction_id' AS column_name, COUNT(*) FILTER (WHERE transaction_id IS NULL) AS violations FROM j
    UNION ALL SELECT 'user_id', COUNT(*) FILTER (WHERE user_id IS NULL) FROM j
    UNION ALL SELECT 'amount', COUNT(*) FILTER (WHERE amount IS NULL) FROM j
    UNION ALL SELECT 'processed_at', COUNT(*) FILTER (WHERE processed_at IS NULL) FROM j""")
def _not_null(spark, sf):
    first = views.order_lines(spark, sf).groupBy("transaction_id").agg(F.min("processed_at").alias("processed_at"))
    rows = views.orders(spark, sf).join(first, "transaction_id", "left")
    return quality.check_not_null(rows, ["transaction_id", "user_id", "amount", "processed_at"])


# Narrower than the scored table's own types, so that rows break each rule.
_CONTRACT = "transaction_id string not null, user_id string not null, amount decimal(5,2) not null, user_std_amount double not null, merchant_category string, hour_of_day tinyint"
_LIMITS = {"lengths": {"user_id": 2, "payment_method": 10}, "bounds": {"amount": (5, 400), "hour_of_day": (6, None)}, "allowed": {"payment_method": ["credit_card", "paypal"]}}


@query("check_contract", f"""WITH {C.RISK}, v AS (SELECT *, TRY_CAST(amount AS DECIMAL(5,2)) AS held FROM risk)
    SELECT column_name, rule, n AS violations FROM (SELECT unnest([
      {{'column_name': 'transaction_id', 'rule': 'required', 'n': COUNT(*) FILTER (WHERE transaction_id IS NULL)}},
      {{'column_name': 'user_id', 'rule': 'required', 'n': COUNT(*) FILTER (WHERE user_id IS NULL)}},
      {{'column_name': 'amount', 'rule': 'required', 'n': COUNT(*) FILTER (WHERE amount IS NULL)}},
      {{'column_name': 'amount', 'rule': 'type', 'n': COUNT(*) FILTER (WHERE amount IS NOT NULL AND held IS NULL)}},
      {{'column_name': 'amount', 'rule': 'scale', 'n': COUNT(*) FILTER (WHERE CAST(held AS DOUBLE) <> amount)}},
      {{'column_name': 'user_std_amount', 'rule': 'required', 'n': COUNT(*) FILTER (WHERE user_std_amount IS NULL)}},
      {{'column_name': 'hour_of_day', 'rule': 'type', 'n': COUNT(*) FILTER (WHERE hour_of_day NOT BETWEEN -128 AND 127)}},
      {{'column_name': 'user_id', 'rule': 'length', 'n': COUNT(*) FILTER (WHERE length(user_id) > 2)}},
      {{'column_name': 'payment_method', 'rule': 'length', 'n': COUNT(*) FILTER (WHERE length(payment_method) > 10)}},
      {{'column_name': 'amount', 'rule': 'range', 'n': COUNT(*) FILTER (WHERE amount < 5 OR amount > 400)}},
      {{'column_name': 'hour_of_day', 'rule': 'range', 'n': COUNT(*) FILTER (WHERE hour_of_day < 6)}},
      {{'column_name': 'payment_method', 'rule': 'allowed', 'n': COUNT(*) FILTER (WHERE payment_method NOT IN ('credit_card', 'paypal'))}}
    ], recursive := true) FROM v)""")
def _contract(spark, sf):
    tx = views.transactions(spark, sf)
    risk = history.risk_columns(history.enrich(tx, history.user_stats(tx)))
    return quality.check_contract(risk, _CONTRACT, **_LIMITS)


@query("check_unique", f"""WITH {ORDERS} SELECT transaction_id, line, COUNT(*) AS n FROM lines
    GROUP BY transaction_id, line HAVING COUNT(*) > 1""")
def _unique(spark, sf):
    return quality.check_unique(views.order_lines(spark, sf), ["transaction_id", "line"])


@query("check_foreign_key", """SELECT 'orders without lines' AS relation, COUNT(*) AS orphans FROM orders
      WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL SELECT 'lines without order', COUNT(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'orders without customer', COUNT(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def _foreign(spark, sf):
    raw, lines = views.orders(spark, sf), views.order_lines(spark, sf)
    customers = views.table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    checks = {
        "orders without lines": quality.check_foreign_key(raw, lines, "transaction_id"),
        "lines without order": quality.check_foreign_key(lines, raw, "transaction_id"),
        "orders without customer": quality.check_foreign_key(raw, customers, "user_id"),
    }
    out = None
    for name, result in checks.items():
        named = result.withColumn("relation", F.lit(name))
        out = named if out is None else out.unionByName(named)
    return out


@query("apply_defaults", """SELECT o_orderkey AS transaction_id, COALESCE(CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END, FALSE) AS is_fraud,
    COALESCE(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, 'training') AS status FROM orders""")
def _defaults(spark, sf):
    """Unsettled orders have no label and no status yet: the defaults step in."""
    status = F.col("o_orderstatus")
    rows = views.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.when(status == "F", True).when(status == "O", False).alias("is_fraud"),
        F.when(status != "P", status).alias("status"),
    )
    return quality.apply_defaults(rows, {"is_fraud": F.lit(False), "status": F.lit("training")})


@query("balanced_sample", f"""WITH {RISK}, p AS (SELECT transaction_id, hour_of_day, is_night, amount_zscore,
      high_risk_merchant FROM risk), j AS (SELECT tx.transaction_id, tx.user_id, tx.amount, tx.ts AS created_at,
      p.hour_of_day, p.is_night, p.amount_zscore, p.high_risk_merchant, tx.is_fraud FROM tx JOIN p
      ON tx.transaction_id = p.transaction_id ORDER BY created_at DESC, transaction_id DESC LIMIT 4000),
    k AS (SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY created_at DESC, transaction_id DESC) AS rn FROM j)
    SELECT transaction_id, user_id, {r('amount')} AS amount, created_at, hour_of_day, is_night,
      {r('amount_zscore')} AS amount_zscore, high_risk_merchant, is_fraud
    FROM k WHERE rn <= CASE WHEN is_fraud THEN 200 ELSE 1800 END""")
def _balanced(spark, sf):
    tx = views.transactions(spark, sf)
    risk = history.risk_columns(history.enrich(tx, history.user_stats(tx)))
    processed = risk.select("transaction_id", "hour_of_day", "is_night", "amount_zscore", "high_risk_merchant")
    raw = tx.select("transaction_id", "user_id", "amount", F.col("ts").alias("created_at"), "is_fraud")
    sample = limits.balanced_sample(joins.raw_with_processed(raw, processed), 2000)
    return comparable(sample)


@query("sink_append", f"WITH {TX} SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n FROM tx GROUP BY 1")
def _append(spark, sf):
    """Two appends to one table, partitioned by day, then a count per day."""
    tx = views.transactions(spark, sf).withColumn("day", F.to_date("ts"))
    path = scratch_dir(spark, "append")
    for flag in (True, False):
        sinks.append_table(tx.filter(F.col("is_fraud") == flag), path, partition_by="day")
    return tables.read_table(spark, path).groupBy("day").agg(F.count("*").alias("n"))


@query("sink_file_formats", f"""WITH {TX} SELECT fmt, transaction_id, {r('amount')} AS amount, ts, is_fraud
    FROM tx, (VALUES ('csv'), ('json'), ('parquet')) AS f(fmt)""")
def _formats(spark, sf):
    """Write every format, read each back with an explicit schema."""
    tx = views.transactions(spark, sf).select("transaction_id", "amount", "ts", "is_fraud")
    out = None
    for fmt in ("csv", "json", "parquet"):
        path = sinks.write_files(tx, f"{scratch_dir(spark, 'files')}.{fmt}")
        reader = spark.read.schema(tx.schema)
        reader = reader.options(**sinks.TEXT_OPTIONS.get(fmt, {}))
        back = reader.format(fmt).load(path).withColumn("fmt", F.lit(fmt))
        out = back if out is None else out.unionByName(back)
    return comparable(out)
