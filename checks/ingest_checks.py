"""Column mapping, reports over the marts, column functions and the streaming path."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql_payments  # noqa: F401 - adds its tables
from checks.registry import Context, register
from checks.sql_tables import select
from ledgerlens.functions import columns
from ledgerlens.operators import mapping
from ledgerlens.plans import reports
from ledgerlens.plans.sample_tables import AS_OF as TODAY
from ledgerlens.storage import scratch_path, stage
from ledgerlens.streaming import events, ingest, merge, monitor, windows

# ---- mapping -----------------------------------------------------------------------


def _canonical(c: Context):
    export = c.tables.user_export
    return mapping.normalise(export, mapping.mapping_for(export.columns))


UUID_SHAPE = "^[0-9a-f]{8}-[0-9a-f]{4}-5[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"

register(
    "canonical_transactions",
    lambda c: _canonical(c).withColumn("merchant_id", F.col("merchant_id").rlike(UUID_SHAPE)),
    select("SELECT *, true AS merchant_id FROM canonical"),
)
register(
    "canonical_merchant_ids",
    lambda c: _canonical(c).groupBy("merchant_name").agg(
        F.countDistinct("merchant_id").alias("ids"), F.count("*").alias("transactions")),
    select("SELECT merchant_name, 1 AS ids, count(*) AS transactions FROM canonical GROUP BY 1"),
)
register(
    "canonical_without_dates",
    lambda c: mapping.normalise(
        c.tables.table("orders").select(
            F.col("o_orderkey").alias("uuid"), F.col("o_totalprice").alias("price")),
        mapping.mapping_for(["uuid", "price"]), order_by=["transaction_id"],
    ).select("transaction_id", "amount", "transaction_at", "customer_id", "currency", "merchant_name",
             "merchant_category", "is_fraud"),
    """SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, o_totalprice AS amount,
  TIMESTAMP '2023-01-01' + to_seconds(30 * (row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) - 1)) AS transaction_at,
  'unknown' AS customer_id, 'USD' AS currency, 'Unknown Merchant' AS merchant_name, 'Other' AS merchant_category,
  false AS is_fraud FROM orders""",
)
register(
    "canonical_numeric_dates",
    lambda c: mapping.normalise(
        c.tables.table("events").selectExpr("event_id AS tid", "value AS Amount", "user_id * 86400 + event_id AS Time",
                                            "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS Class"),
        mapping.mapping_for(["tid", "Amount", "Time", "Class"], preset="mlg-ulb/creditcard"),
    ).select("transaction_id", "amount", "transaction_at", "is_fraud"),
    """SELECT CAST(event_id AS VARCHAR) AS transaction_id, abs(value) AS amount,
  TIMESTAMP '2023-01-01' + to_seconds(user_id * 86400 + event_id) AS transaction_at, event_type = 'error' AS is_fraud FROM events""",
)


def _profile(c: Context):
    export = c.tables.user_export
    return mapping.mapping_profile(export, mapping.mapping_for(export.columns), exact=True)


_PROFILE_FIELDS = [
    ("transaction_id", "record_id", 100, "NULL"), ("amount", "debit", 100, "TRY_CAST(debit AS DOUBLE)"),
    ("customer_id", "member_id", 100, "NULL"), ("merchant_id", None, 0, "NULL"),
    ("merchant_name", "payee", 100, "NULL"), ("merchant_category", None, 0, "NULL"),
    ("currency", "ccy", 100, "NULL"), ("status", "outcome", 100, "NULL"), ("channel", None, 0, "NULL"),
    ("country", None, 0, "NULL"), ("transaction_at", "occurred_at", 100, "TRY_CAST(occurred_at AS TIMESTAMP)"),
    ("is_fraud", "fraud_flag", 100, "NULL"), ("card_type", None, 0, "NULL"),
]
register(
    "mapping_profile", _profile,
    select(" UNION ALL ".join(
        f"""SELECT '{field}' AS field, {f"'{col}'" if col else 'NULL'} AS source_column, {conf} AS confidence,
  {str(field == 'amount').lower()} AS required, {f'count("{col}")' if col else '0'} AS non_null,
  {f'count("{col}") FILTER ({parsed} IS NULL)' if parsed != 'NULL' else '0'} AS unparseable,
  {f'count(DISTINCT "{col}")' if col else '0'} AS distinct_values {'FROM user_export' if col else ''}"""
        for field, col, conf, parsed in _PROFILE_FIELDS)),
)

# ---- warehouse tables derived from payments ----------------------------------------------


def _raw(c: Context):
    return mapping.raw_transactions(c.tables.payments)


register(
    "derived_raw_transactions",
    lambda c: mapping.raw_transactions(_canonical(c)).drop("merchant_id"),
    select("""SELECT transaction_id, customer_id, amount, currency, transaction_at, status, is_fraud AS is_flagged_fraud,
  'card' AS channel, 'GB' AS ip_country, merchant_name, merchant_category FROM canonical"""),
)
register(
    "derived_customers", lambda c: mapping.derived_customers(_raw(c)),
    select("""SELECT DISTINCT customer_id, 'Customer ' || customer_id AS full_name, customer_id || '@example.com' AS email,
  '000-000-0000' AS phone, 'GB' AS country, 'standard' AS account_tier,
  CAST((SELECT min(CAST(transaction_at AS DATE)) FROM payments) AS VARCHAR) AS signup_date, 'verified' AS kyc_status,
  '1990-01-01' AS date_of_birth,
  (SELECT currency FROM payments ORDER BY transaction_at, transaction_id LIMIT 1) AS currency FROM payments"""),
)
register(
    "derived_merchants", lambda c: mapping.derived_merchants(_raw(c)),
    select("""SELECT merchant_id, arg_min(merchant_name, transaction_at) AS merchant_name,
  arg_min(merchant_category, transaction_at) AS category, '5999' AS mcc_code, 'GB' AS country, false AS is_high_risk,
  '2020-01-01' AS onboarded_date FROM payments GROUP BY 1"""),
)
register(
    "derived_fx_rates", lambda c: mapping.derived_fx_rates(_raw(c)),
    select("""SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS rate_date, currency,
  CASE currency WHEN 'USD' THEN 1.27::DOUBLE WHEN 'EUR' THEN 1.17 WHEN 'SGD' THEN 1.70 WHEN 'AED' THEN 4.66 WHEN 'CAD' THEN 1.73 ELSE 1.0 END AS rate_to_gbp
FROM (SELECT unnest(generate_series(min(CAST(transaction_at AS DATE)), max(CAST(transaction_at AS DATE)), INTERVAL 1 DAY)) AS d FROM payments),
  (SELECT DISTINCT currency FROM payments UNION SELECT unnest(['GBP', 'USD', 'EUR']))"""),
)


def _derived_performance(c: Context):
    from ledgerlens.plans.warehouse import Warehouse

    raw = _raw(c)
    return Warehouse(
        raw, mapping.derived_customers(raw), mapping.derived_merchants(raw), mapping.derived_fx_rates(raw),
        mapping.no_disputes(raw), F.lit(TODAY).cast("date"),
    ).monthly_payment_performance.select("month", "currency", "channel", "merchant_category", "total_transactions",
                                         "total_volume_gbp")


register(
    "derived_warehouse_performance", _derived_performance,
    select("""SELECT CAST(date_trunc('month', transaction_at) AS DATE) AS month, currency, channel, merchant_category,
  count(*) AS total_transactions,
  round(sum(round(amount / CASE currency WHEN 'USD' THEN 1.27::DOUBLE WHEN 'EUR' THEN 1.17 WHEN 'SGD' THEN 1.70
    WHEN 'AED' THEN 4.66 WHEN 'CAD' THEN 1.73 ELSE 1.0 END, 2)) FILTER (status = 'completed'), 2) AS total_volume_gbp
FROM payments GROUP BY 1, 2, 3, 4"""),
)

# ---- executive queries and reports ---------------------------------------------------------


def _perf(c: Context):
    return c.warehouse.monthly_payment_performance


def _pct(rate: str, digits: int) -> str:
    return f"round(round(avg({rate}), 12) * 100, {digits})"


register(
    "executive_monthly_health", lambda c: reports.monthly_health(_perf(c)),
    select(f"""SELECT *, round(total_volume_gbp / lag(total_volume_gbp) OVER (ORDER BY month) * 100 - 100, 1) AS mom_volume_growth_pct
FROM (SELECT month, round(sum(total_volume_gbp), 2) AS total_volume_gbp, CAST(sum(total_transactions) AS BIGINT) AS total_transactions,
  {_pct('completion_rate', 2)} AS avg_completion_pct, {_pct('fraud_rate', 3)} AS avg_fraud_pct FROM performance GROUP BY 1)"""),
)
register(
    "executive_value_by_tier", lambda c: reports.value_by_tier(c.warehouse.customers_360),
    select("""SELECT account_tier, ltv_tier, count(*) AS customer_count,
  round(round(sum(total_spend_gbp), 2) / count(*), 2) AS avg_ltv_gbp,
  round(round(sum(engagement_score), 1) / count(*), 1) AS avg_engagement,
  round(100.0::DOUBLE * (count(*) FILTER (churn_risk_segment IN ('at_risk', 'churned'))) / count(*), 1) AS churn_risk_pct
FROM c360 GROUP BY 1, 2"""),
)
register(
    "executive_cohort_matrix", lambda c: reports.cohort_matrix(c.warehouse.cohort_retention),
    select("SELECT strftime(cohort_month, '%Y-%m') AS cohort, cohort_size, " + ", ".join(
        f"max(round(retention_rate * 100, 1)) FILTER (months_since_signup = {n}) AS M{n}" for n in (0, 1, 2, 3, 6, 12)
    ) + " FROM retention GROUP BY 1, 2"),
)
register(
    "executive_riskiest_merchants", lambda c: reports.riskiest_merchants(c.warehouse.merchant_risk_scorecard),
    select("""SELECT merchant_name, merchant_category, merchant_country, total_transactions, round(total_volume_gbp, 2) AS total_volume_gbp,
  round(fraud_rate * 100, 2) AS fraud_rate_pct, round(dispute_rate * 100, 2) AS dispute_rate_pct, risk_score, risk_band
FROM scorecard WHERE total_transactions >= 10 ORDER BY risk_score DESC, merchant_id LIMIT 10"""),
)
register(
    "executive_repeat_fraud_customers",
    lambda c: reports.repeat_fraud_customers(c.warehouse.fraud_events, c.warehouse.customers),
    select("""SELECT customer_id, any_value(c.account_tier) AS account_tier, any_value(c.country_code) AS country_code,
  any_value(c.is_kyc_verified) AS is_kyc_verified, count(*) AS fraud_events, max(customer_fraud_velocity_30d) AS max_30d_velocity,
  round(sum(amount_gbp), 2) AS total_fraud_amount_gbp, count(*) FILTER (has_dispute) AS disputed_count,
  count(DISTINCT merchant_category) AS merchant_categories_hit
FROM fraud_events JOIN c360 c USING (customer_id) GROUP BY 1 HAVING count(*) >= 3"""),
)
register(
    "executive_success_by_channel", lambda c: reports.success_by_channel(_perf(c)),
    select(f"""SELECT channel, merchant_category, CAST(sum(total_transactions) AS BIGINT) AS total_txns,
  {_pct('completion_rate', 2)} AS completion_pct, {_pct('fraud_rate', 3)} AS fraud_pct,
  round(sum(total_volume_gbp), 2) AS volume_gbp FROM performance GROUP BY 1, 2"""),
)
register(
    "executive_fx_exposure", lambda c: reports.fx_exposure(_perf(c)),
    select("""SELECT *, round(100.0::DOUBLE * volume_gbp / sum(volume_gbp) OVER (), 2) AS pct_of_total
FROM (SELECT currency, CAST(sum(total_transactions) AS BIGINT) AS total_txns, round(sum(total_volume_gbp), 2) AS volume_gbp
      FROM performance GROUP BY 1)"""),
)
register(
    "report_monthly_volume", lambda c: reports.monthly_volume(_perf(c)),
    select(f"""SELECT strftime(month, '%Y-%m') AS month, round(sum(total_volume_gbp), 2) AS volume_gbp,
  CAST(sum(total_transactions) AS BIGINT) AS transactions, {_pct('completion_rate', 2)} AS completion_pct,
  {_pct('fraud_rate', 3)} AS fraud_pct, CAST(sum(fraud_flagged_count) AS BIGINT) AS fraud_events FROM performance GROUP BY 1"""),
)
register(
    "report_kpis", lambda c: reports.kpis(_perf(c)),
    select(f"""SELECT round(round(sum(total_volume_gbp), 2) / 1000000, 2) AS total_volume_m,
  CAST(sum(total_transactions) AS BIGINT) AS total_transactions, {_pct('completion_rate', 1)} AS avg_completion_pct,
  {_pct('fraud_rate', 2)} AS avg_fraud_pct, CAST(sum(fraud_flagged_count) AS BIGINT) AS total_fraud_events FROM performance"""),
)
register(
    "report_rfm_kpis", lambda c: reports.rfm_kpis(c.warehouse.rfm_segmentation),
    select("""SELECT count(*) AS total_customers, count(*) FILTER (segment_group = 'High Value') AS high_value,
  count(*) FILTER (segment_group = 'At Risk') AS at_risk, round(sum(monetary_gbp), 2) AS total_ltv_gbp FROM rfm_mart"""),
)
register(
    "report_fraud_kpis", lambda c: reports.fraud_kpis(c.warehouse.fraud_events),
    select("""SELECT count(*) AS total_fraud_events, round(sum(amount_gbp), 2) AS total_fraud_gbp,
  count(dispute_id) AS disputed, count(DISTINCT customer_id) AS affected_customers FROM fraud_events"""),
)
for _by in ("channel", "currency"):
    register(
        f"report_{_by}_mix", lambda c, by=_by: reports.volume_mix(_perf(c), by),
        select(f"""SELECT {_by}, round(sum(total_volume_gbp), 2) AS volume_gbp,
  CAST(sum(total_transactions) AS BIGINT) AS transactions FROM performance GROUP BY 1"""),
    )
for _by in ("merchant_category", "channel"):
    register(
        f"report_fraud_by_{_by}", lambda c, by=_by: reports.fraud_by(c.warehouse.fraud_events, by),
        select(f"""SELECT {_by}, count(*) AS fraud_events, round(sum(amount_gbp), 2) AS fraud_amount
FROM fraud_events GROUP BY 1"""),
    )
register(
    "report_segment_sizes", lambda c: reports.segment_sizes(c.warehouse.rfm_segmentation),
    select("""SELECT rfm_segment, segment_group, count(*) AS customers, round(round(sum(monetary_gbp), 2) / count(*), 2) AS avg_spend,
  round(sum(monetary_gbp), 2) AS total_spend FROM rfm_mart GROUP BY 1, 2"""),
)
register(
    "report_segment_groups", lambda c: reports.segment_group_spend(c.warehouse.rfm_segmentation),
    select("SELECT segment_group, count(*) AS customers, round(sum(monetary_gbp), 2) AS total_spend FROM rfm_mart GROUP BY 1"),
)
register(
    "report_cohorts", lambda c: reports.cohort_report(c.warehouse.cohort_retention),
    select("""SELECT strftime(cohort_month, '%Y-%m') AS cohort, months_since_signup, round(retention_rate * 100, 1) AS retention_pct,
  cohort_size FROM retention WHERE months_since_signup <= 6"""),
)
register(
    "report_top_customers", lambda c: reports.top_customers(c.warehouse.rfm_segmentation),
    select("""SELECT full_name, country_code, account_tier, rfm_segment, segment_group, monetary_gbp AS spend_gbp, frequency,
  recency_days, rfm_total, recommended_action FROM rfm_mart ORDER BY monetary_gbp DESC, customer_id LIMIT 20"""),
)
register(
    "report_risk_bands", lambda c: reports.risk_bands(c.warehouse.merchant_risk_scorecard),
    select(f"""SELECT risk_band, count(*) AS merchants, round(sum(total_volume_gbp), 2) AS total_volume,
  {_pct('fraud_rate', 2)} AS avg_fraud_pct FROM scorecard GROUP BY 1"""),
)
register(
    "report_merchant_risk", lambda c: reports.merchant_risk(c.warehouse.merchant_risk_scorecard),
    select("""SELECT merchant_name, merchant_category, total_transactions, round(total_volume_gbp, 2) AS volume_gbp,
  round(fraud_rate * 100, 2) AS fraud_pct, round(dispute_rate * 100, 2) AS dispute_pct, risk_score, risk_band
FROM scorecard ORDER BY risk_score DESC, merchant_id LIMIT 20"""),
)
register(
    "run_summary", lambda c: reports.run_summary(_perf(c)),
    select(f"""SELECT *, fraud_pct > 5 AS fraud_alert, completion_pct < 85 AS completion_alert FROM (
  SELECT round(round(sum(total_volume_gbp), 2) / 1000000, 2) AS volume_m, {_pct('completion_rate', 1)} AS completion_pct,
    {_pct('fraud_rate', 2)} AS fraud_pct, max(month) AS latest_month FROM performance)"""),
)

# ---- column functions -------------------------------------------------------------------------

register(
    "convert_currency",
    lambda c: columns.convert_currency(
        c.tables.transactions.select("transaction_id", "amount", "currency"), c.warehouse.fx_rates,
        "amount", "currency", F.lit("2001-06-01").cast("date"), "amount_gbp"),
    select("""SELECT transaction_id, amount, t.currency, round(amount / nullif(rate_to_gbp, 0), 2) AS amount_gbp
FROM raw_transactions t LEFT JOIN fx ON fx.currency = t.currency AND fx.rate_date = DATE '2001-06-01'"""),
)


def _daily(c: Context):
    """Transactions per calendar day of the data, days without any included."""
    day = F.col("l_shipdate").cast("date")
    lines = c.tables.table("lineitem")
    first, last = lines.agg(F.min(day).cast("string"), F.max(day).cast("string")).first()
    per_day = lines.groupBy(day.alias("calendar_date")).agg(F.count("*").alias("n"))
    spine = columns.date_spine(c.spark, f"{int(first[:4]) - 1}{first[4:]}", last)
    return spine.join(per_day, "calendar_date", "left").select("calendar_date", F.coalesce("n", F.lit(0)).alias("lines"))


register(
    "date_spine_counts", _daily,
    """SELECT CAST(d AS DATE) AS calendar_date, count(l_orderkey) AS lines
FROM (SELECT unnest(generate_series(min(l_shipdate)::DATE - INTERVAL 1 YEAR, max(l_shipdate)::DATE, INTERVAL 1 DAY)) AS d FROM lineitem)
LEFT JOIN lineitem ON CAST(l_shipdate AS DATE) = CAST(d AS DATE) GROUP BY 1""",
)
register(
    "safe_divide_by_merchant",
    lambda c: c.tables.table("lineitem").groupBy("l_suppkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("returned"),
        F.sum(F.when((F.col("l_tax") < 0.005) & (F.col("l_discount") < 0.005), 1).otherwise(0)).alias("plain"),
    ).withColumn("returned_per_plain", columns.ratio(F.col("returned"), F.col("plain"))),
    """SELECT *, returned::DOUBLE / nullif(plain, 0) AS returned_per_plain FROM (
  SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS returned, count(*) FILTER (l_tax < 0.005 AND l_discount < 0.005) AS plain
  FROM lineitem GROUP BY 1)""",
)
register(
    "pct_of_total_by_tier",
    lambda c: columns.with_share(
        columns.with_share(
            c.tables.customers.groupBy("account_tier", "country").agg(F.count("*").alias("customers")),
            "customers", "pct_of_all"),
        "customers", "pct_of_tier", by=["account_tier"]),
    select("""SELECT *, round(100.0::DOUBLE * customers / sum(customers) OVER (), 2) AS pct_of_all,
  round(100.0::DOUBLE * customers / sum(customers) OVER (PARTITION BY account_tier), 2) AS pct_of_tier
FROM (SELECT account_tier, country, count(*) AS customers FROM raw_customers GROUP BY 1, 2)"""),
)

# ---- streaming -----------------------------------------------------------------------------------


def _ingested(c: Context) -> ingest.StreamTables:
    """Run the stream over the events to its end and return the tables it wrote."""
    folder = scratch_path(c.spark, "stream")
    tables = ingest.StreamTables(c.spark, folder)
    query = ingest.start_ingest(
        c.tables.messages(c.tables.event_stream()), tables, f"{folder}/checkpoint", every=None
    )
    query.awaitTermination()
    return tables


def _ingested_after_empty(c: Context) -> ingest.StreamTables:
    """A first batch of unusable messages only, then all events, then some of them again."""
    tables = ingest.StreamTables(c.spark, scratch_path(c.spark, "stream-empty"))
    messages = c.tables.messages(c.tables.table("events"))
    tables.write_batch(messages.withColumn("value", F.lit("{cut off")), 0)
    tables.write_batch(messages, 1)
    tables.write_batch(messages.filter(F.col("offset") % 3 == 0), 2)
    return tables


def _merged_late(c: Context):
    """Merge after each of two batches; the second brings events from before those of the first."""
    messages = c.tables.messages(c.tables.table("events"))
    time = F.get_json_object("value", "$.event_time")
    tables = ingest.StreamTables(c.spark, scratch_path(c.spark, "stream-late"))
    target, log = scratch_path(c.spark, "late-merged"), scratch_path(c.spark, "late-log")
    _rows(c).limit(0).withColumnRenamed("event_time", "transaction_at").select(*merge.MERGED_COLUMNS).write.parquet(target)
    late = F.coalesce(time < "2024-01-11", F.lit(False))
    for number, part in enumerate((messages.filter(~late), messages.filter(late))):
        tables.write_batch(part, number)
        merge.merge_into_warehouse(tables.read("transactions", with_batch=True), target, log)
    return c.spark.read.parquet(target)


def _ingested_again(c: Context) -> ingest.StreamTables:
    """Two queries with checkpoints of their own: both count from batch 0, and the second finds only later messages."""
    folder = scratch_path(c.spark, "stream-again")
    tables = ingest.StreamTables(c.spark, folder)
    for number, part in enumerate((F.col("ts") < "2024-01-16", F.col("ts") >= "2024-01-14")):
        query = ingest.start_ingest(
            c.tables.messages(c.tables.event_stream().filter(part)), tables, f"{folder}/checkpoint-{number}", every=None
        )
        query.awaitTermination()
    return tables


def _merged_during_write(c: Context):
    """Merge while a batch has its rows but no marker yet, then after it is stored."""
    messages = c.tables.messages(c.tables.table("events"))
    tables = ingest.StreamTables(c.spark, scratch_path(c.spark, "stream-half"))
    target, log = scratch_path(c.spark, "half-merged"), scratch_path(c.spark, "half-log")
    _rows(c).limit(0).withColumnRenamed("event_time", "transaction_at").select(*merge.MERGED_COLUMNS).write.parquet(target)
    tables.write_batch(messages.filter(F.col("offset") % 2 == 0), 0)
    # What a batch that was cut off has left: rows in its folder, of which only a part was written.
    tables._write(
        tables.read("transactions").limit(5).withColumn("event_date", F.to_date("event_time")), "transactions", "batch-1", by="event_date"
    )
    for number in (1, 2):
        merge.merge_into_warehouse(tables.read("transactions", with_batch=True), target, log)
        tables.write_batch(messages, number)
    merge.merge_into_warehouse(tables.read("transactions", with_batch=True), target, log)
    return c.spark.read.parquet(target)


def _rows(c: Context):
    """Stored rows as a batch, with the event time standing in for the write time."""
    decoded = events.decode(c.tables.messages(c.tables.table("events")))
    return events.first_per_event(events.sink_rows(decoded, F.col("event_time")))


register("stream_rows", lambda c: _ingested(c).read("transactions").drop("consumed_at"), select("SELECT * FROM stored"))
register(
    "stream_rows_after_empty_batch", lambda c: _ingested_after_empty(c).read("transactions").drop("consumed_at"),
    select("SELECT * FROM stored"),
)
register(
    "stream_rows_after_new_checkpoint", lambda c: _ingested_again(c).read("transactions").drop("consumed_at"),
    select("SELECT * FROM stored"),
)
register(
    "stream_merge_during_write", _merged_during_write,
    select("""SELECT transaction_id, customer_id, merchant_id, amount, currency, event_time AS transaction_at, status, is_flagged_fraud,
  channel, ip_country FROM stored"""),
)
register(
    "stream_merge_late_rows", _merged_late,
    select("""SELECT transaction_id, customer_id, merchant_id, amount, currency, event_time AS transaction_at, status, is_flagged_fraud,
  channel, ip_country FROM stored"""),
)
register(
    "stream_dead_letters",
    lambda c: _ingested(c).read("dlq").groupBy("error_message").agg(
        F.count("*").alias("messages"), F.countDistinct("dlq_id").alias("ids")),
    select("""SELECT if(cut_off, 'malformed JSON', 'missing event_id') AS error_message, count(*) AS messages, count(*) AS ids
FROM sent WHERE cut_off OR no_id GROUP BY 1"""),
)
register(
    "stream_fraud_alerts", lambda c: _ingested(c).read("fraud_alerts").drop("alert_id", "alert_time"),
    select("""SELECT transaction_id, customer_id, amount_gbp, risk_score,
  CASE WHEN is_high_risk_merchant THEN 'high_risk_merchant' WHEN is_cross_border THEN 'unusual_geography'
       WHEN amount_gbp > 800 THEN 'amount_anomaly' ELSE 'velocity_check' END AS reason
FROM stored WHERE is_flagged_fraud AND risk_score > 60"""),
)
register(
    "stream_batch_statistics",
    lambda c: _ingested(c).read("batches").agg(
        F.sum("rows_written").alias("rows_written"), F.sum("fraud_rows").alias("fraud_rows"),
        F.max("last_event_time").alias("last_event_time")),
    select("""SELECT count(*) AS rows_written, count(*) FILTER (is_flagged_fraud) AS fraud_rows, max(event_time) AS last_event_time
FROM stored"""),
)
register(
    "stream_running_totals", lambda c: monitor.running_totals(_rows(c)),
    select("""SELECT count(*) AS events, round(sum(amount_gbp), 2) AS volume_gbp, count(*) FILTER (is_flagged_fraud) AS fraud_flags,
  count(DISTINCT customer_id) AS customers FROM stored"""),
)
register(
    "stream_totals", lambda c: monitor.stream_totals(_rows(c)),
    select("""SELECT count(*) AS events, round(sum(amount_gbp), 2) AS volume_gbp,
  round(round(sum(amount_gbp), 2) / count(*), 2) AS avg_txn_gbp, count(*) FILTER (is_flagged_fraud) AS fraud_flags,
  count(DISTINCT customer_id) AS customers, round(100.0::DOUBLE * (count(*) FILTER (is_flagged_fraud)) / count(*), 2) AS fraud_rate_pct,
  count(*) FILTER (status = 'completed') AS completed,
  round(100.0::DOUBLE * (count(*) FILTER (status = 'completed')) / count(*), 2) AS completion_pct FROM stored"""),
)
register(
    "stream_freshness",
    lambda c: monitor.freshness(_rows(c), F.lit("2024-01-31 00:05:00").cast("timestamp")),
    select("""SELECT *, if(minutes_since_write > 10, 'stale', 'healthy') AS status FROM (
  SELECT count(*) AS total_events, max(event_time) AS latest_event_time, max(event_time) AS latest_consumed_at,
    date_diff('minute', max(event_time), TIMESTAMP '2024-01-31 00:05:00') AS minutes_since_write FROM stored)"""),
)
register(
    "stream_recent_anomalies", lambda c: monitor.recent_anomalies(_rows(c)),
    select("""SELECT *, fraud_rate_pct > 10 AS fraud_anomaly, avg_amount_gbp > 800 AS amount_anomaly, decline_rate_pct > 20 AS decline_anomaly
FROM (SELECT count(*) AS total, count(*) FILTER (is_flagged_fraud) AS fraud_count,
    round(100.0::DOUBLE * (count(*) FILTER (is_flagged_fraud)) / count(*), 2) AS fraud_rate_pct,
    round(round(sum(amount_gbp), 2) / count(*), 2) AS avg_amount_gbp, max(amount_gbp) AS max_amount_gbp,
    count(DISTINCT customer_id) AS unique_customers, count(*) FILTER (status = 'declined') AS declined_count,
    round(100.0::DOUBLE * (count(*) FILTER (status = 'declined')) / count(*), 2) AS decline_rate_pct
  FROM (SELECT * FROM stored ORDER BY event_time DESC, event_id LIMIT 100))"""),
)


def _windows(c: Context, build):
    """Run the windows over the stream of events to its end and return the rows it emitted."""
    folder = scratch_path(c.spark, "windows")
    messages = c.tables.messages(c.tables.event_stream())
    windows.start_windows(messages, build, folder, every=None).awaitTermination()
    return c.spark.read.parquet(f"{folder}/rows")


register(
    "stream_rates", lambda c: _windows(c, windows.rates),
    select("""SELECT *, round(100.0::DOUBLE * flagged / events, 2) AS fraud_rate_pct, round(100.0::DOUBLE * declined / events, 2) AS decline_rate_pct
FROM (SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start, time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS window_end,
    count(*) AS events, count(*) FILTER (is_flagged_fraud) AS flagged, count(*) FILTER (status = 'declined') AS declined
  FROM stored GROUP BY ALL)
WHERE window_end <= (SELECT max(event_time) - INTERVAL 1 DAY FROM stored)"""),
)
register(
    "stream_velocity", lambda c: _windows(c, windows.customer_velocity),
    select("""SELECT start AS window_start, start + INTERVAL 30 DAY AS window_end, customer_id, CAST(sum(payments) AS BIGINT) AS payments,
  CAST(sum(pence) AS BIGINT) / 100 AS volume_gbp, CAST(sum(flagged) AS BIGINT) AS flagged
FROM (SELECT *, unnest(range(30)) AS back, CAST(day - to_days(CAST(unnest(range(30)) AS INTEGER)) AS TIMESTAMP) AS start
  FROM (SELECT date_trunc('day', event_time) AS day, customer_id, count(*) AS payments,
      sum(CAST(round(amount_gbp * 100) AS BIGINT)) AS pence, count(*) FILTER (is_flagged_fraud) AS flagged
    FROM stored GROUP BY ALL))
WHERE start + INTERVAL 30 DAY <= (SELECT max(event_time) - INTERVAL 1 DAY FROM stored) GROUP BY start, customer_id"""),
)


def _offsets(c: Context):
    """Committed: up to the first half of the month; end: everything sent."""
    sent = c.tables.messages(c.tables.table("events"))
    early = c.tables.messages(c.tables.table("events").filter(F.col("ts") < "2024-01-16"))
    last = lambda df, name: df.groupBy("partition").agg(F.max("offset").alias(name))
    return last(early, "committed_offset"), last(sent, "end_offset")


_LAG = """
SELECT part AS partition, max(seq) FILTER (event_time < TIMESTAMP '2024-01-16') AS committed_offset, max(seq) AS end_offset,
  max(seq) - max(seq) FILTER (event_time < TIMESTAMP '2024-01-16') AS lag FROM sent GROUP BY 1"""
register("stream_partition_lag", lambda c: monitor.partition_lag(*_offsets(c)), select(_LAG))
register(
    "stream_total_lag", lambda c: monitor.total_lag(monitor.partition_lag(*_offsets(c))),
    select("""SELECT CAST(sum(lag) AS BIGINT) AS total_lag, if(sum(lag) < 5000, 'healthy', 'lagging') AS status FROM lags""", lags=_LAG),
)


def _stored_early(c: Context):
    rows = _rows(c)
    return rows, rows.filter(F.col("event_time") < "2024-01-11").select("transaction_id")


_NEW = """
SELECT transaction_id, customer_id, merchant_id, amount, currency, event_time AS transaction_at, status, is_flagged_fraud,
  channel, ip_country FROM stored WHERE event_time >= TIMESTAMP '2024-01-11'"""
register("stream_merge_rows", lambda c: merge.new_transactions(*_stored_early(c)), select(_NEW))


def _merge_as_written(c: Context):
    rows, stored = _stored_early(c)
    log = c.spark.createDataFrame(
        [("2024-01-21 00:00:00", "2024-01-20 00:00:00", 10)], "merged_at string, last_event_time string, rows_merged int"
    ).withColumn("last_event_time", F.col("last_event_time").cast("timestamp"))
    return merge.new_transactions(rows, stored, merge.last_mark(log))


register(
    "stream_merge_rows_after_mark", _merge_as_written,
    select(f"SELECT * FROM ({_NEW}) WHERE transaction_at > TIMESTAMP '2024-01-20'"),
)


def _merged(c: Context):
    """Merge twice into a stored table; the second merge adds nothing but a log line."""
    rows, _ = _stored_early(c)
    target, log = scratch_path(c.spark, "merged"), scratch_path(c.spark, "merge-log")
    mapped = rows.filter(F.col("event_time") < "2024-01-11").withColumnRenamed("event_time", "transaction_at")
    mapped.select(*merge.MERGED_COLUMNS).write.parquet(target)
    stored = stage(rows, "stream-rows")
    merge.merge_into_warehouse(stored, target, log)
    merge.merge_into_warehouse(stored, target, log)
    lines = c.spark.read.parquet(log)
    return c.spark.read.parquet(target).agg(
        F.count("*").alias("rows"), F.countDistinct("transaction_id").alias("ids")
    ).crossJoin(lines.agg(
        F.count("*").alias("merges"), F.sum("rows_merged").alias("rows_merged"),
        F.max("last_event_time").alias("last_event_time"),
    ))


register(
    "stream_merge_into_warehouse", _merged,
    select("""SELECT count(*) AS rows, count(*) AS ids, 2 AS merges, count(*) FILTER (event_time >= TIMESTAMP '2024-01-11') AS rows_merged,
  max(event_time) AS last_event_time FROM stored"""),
)
