"""Population stability of fraud features between two periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import percent, ratio, round_to
from ledgerlens.operators.fraud import category_codes, time_features, with_code
from ledgerlens.operators.ordering import exact_percentiles
from ledgerlens.operators.skew import find_hot, with_running_total
from ledgerlens.storage import stage

DRIFT_FEATURES = [
    "amount", "amount_log", "hour", "day_of_week", "is_weekend", "is_night",
    "customer_txn_count", "merchant_category_enc",
]
# Distinct values up to which an exact percentile may buffer them in one task.
BUFFERED_VALUES = 100_000
BINS = 10
EPSILON = 1e-6
STABLE_BELOW = 0.10
RETRAIN_FROM = 0.20


def _label(payments: DataFrame) -> Column:
    name = "is_flagged_fraud" if "is_flagged_fraud" in payments.columns else "is_fraud"
    return F.coalesce(F.col(name).cast("int"), F.lit(0))


def feature_tables(
    reference: DataFrame, current: DataFrame, hot_limit: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Feature tables of both periods, with one category encoding and counts in time order.

    Both periods go through one job and one stored table.
    """
    def side(payments: DataFrame, is_current: bool) -> DataFrame:
        return payments.select(
            "transaction_id",
            F.struct(F.lit(is_current).alias("late"), F.col("customer_id").alias("id")).alias("who"),
            F.col("transaction_at").cast("timestamp").alias("transaction_at"),
            F.coalesce(F.col("merchant_category").cast("string"), F.lit("Other")).alias("merchant_category"),
            F.coalesce(F.col("amount").cast("double"), F.lit(0.0)).alias("amount"),
            _label(payments).alias("label"),
        )

    rows = side(reference, False).unionByName(side(current, True))
    counted = with_running_total(
        rows, "who", "transaction_at", ["transaction_id"], F.lit(1), "customer_txn_count",
        find_hot(rows, "who", hot_limit),
    )
    stored = stage(
        counted.withColumns({
            "is_current": F.col("who.late"),
            "amount_log": F.log1p("amount"),
            "customer_txn_count": F.col("customer_txn_count").cast("double"),
            **time_features(F.col("transaction_at"), no_hour=12),
        }).drop("who", "transaction_id", "transaction_at"),
        "drift-features",
    )
    codes = category_codes(stored, "merchant_category", "Other")
    coded = with_code(stored, "merchant_category", "merchant_category_enc", "Other", codes).select(
        *DRIFT_FEATURES, "label", "is_current"
    )
    return coded.filter(~F.col("is_current")), coded.filter("is_current")


def bin_edges(reference: DataFrame, features: list[str]) -> dict[str, list[float]]:
    """Distinct decile edges per feature: eleven numbers each, whatever the data size.

    Features with few distinct values share one ``percentile`` pass, whose buffer holds one
    entry per distinct value; the others are narrowed down by counting.
    """
    points = [i / BINS for i in range(BINS + 1)]
    values = reference.agg(*[F.approx_count_distinct(f).alias(f) for f in features]).first()
    small = [f for f in features if values[f] <= BUFFERED_VALUES]
    edges: dict[str, list[float]] = {}
    if small:
        row = reference.agg(*[
            F.percentile(f, F.array(*[F.lit(p) for p in points])).alias(f) for f in small
        ]).first()
        edges = {f: list(row[f] or []) for f in small}
    for f in features:
        if f not in edges:
            edges[f] = exact_percentiles(reference, f, points)
    return {f: sorted({float(e) for e in edges[f] if e is not None}) for f in features}


def _bin_of(feature: str, edges: list[float]) -> Column:
    """Bin number from 0; null outside the edges. Bins are half-open but for the last one."""
    x = F.col(feature)
    place = F.lit(-1)
    for edge in edges[:-1]:
        place = place + (x >= F.lit(edge)).cast("int")
    return F.when((x >= F.lit(edges[0])) & (x <= F.lit(edges[-1])), place)


def _histogram(side: DataFrame, edges: dict[str, list[float]], out: str) -> DataFrame:
    bins = F.array(*[
        F.struct(F.lit(f).alias("feature"), _bin_of(f, e).alias("bin")) for f, e in edges.items()
    ])
    return (
        side.select(F.explode(bins).alias("b"))
        .select("b.feature", "b.bin")
        .filter(F.col("bin").isNotNull())
        .groupBy("feature", "bin")
        .agg(F.count("*").alias(out))
    )


def status_of(psi: Column) -> Column:
    return (
        F.when(psi >= RETRAIN_FROM, "retrain").when(psi >= STABLE_BELOW, "monitor").otherwise("stable")
    )


def feature_psi(reference: DataFrame, current: DataFrame) -> DataFrame:
    """PSI and status of each drift feature; ``reference`` and ``current`` are feature tables.

    One pass over each side counts all features' bins at once.
    """
    spark = reference.sparkSession
    edges = bin_edges(reference, DRIFT_FEATURES)
    binned = {f: e for f, e in edges.items() if len(e) >= 2}
    flat = spark.createDataFrame(
        [(f,) for f in DRIFT_FEATURES if f not in binned], "feature string"
    ).withColumn("psi", F.lit(0.0))
    if not binned:
        return flat.withColumn("status", status_of(F.col("psi")))
    grid = spark.createDataFrame(
        [(f, b) for f, e in binned.items() for b in range(len(e) - 1)], "feature string, bin int"
    )
    sizes = reference.agg(F.count("*").alias("n_ref")).crossJoin(current.agg(F.count("*").alias("n_cur")))

    def share(count: str, n: str) -> Column:
        return (F.coalesce(F.col(count), F.lit(0)) + EPSILON) / (F.col(n) + EPSILON * BINS)

    expected, actual = share("ref", "n_ref"), share("cur", "n_cur")
    scores = (
        grid.join(_histogram(reference, binned, "ref"), ["feature", "bin"], "left")
        .join(_histogram(current, binned, "cur"), ["feature", "bin"], "left")
        .crossJoin(F.broadcast(sizes))
        .groupBy("feature")
        .agg(round_to(F.sum((actual - expected) * F.log(actual / expected)), 4).alias("psi"))
    )
    return scores.unionByName(flat).withColumn("status", status_of(F.col("psi")))


def drift_report(reference: DataFrame, current: DataFrame, psi: DataFrame) -> DataFrame:
    """One row: overall PSI, rates, volumes, status, retraining advice and recommendations."""
    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.agg(
            F.count("*").alias(f"volume_{tag}"),
            F.coalesce(ratio(F.sum("label") * 100, F.count("*")), F.lit(0.0)).alias(f"_rate_{tag}"),
        )

    ranked = F.sort_array(F.collect_list(F.struct((-F.col("psi")).alias("rank"), "feature", "psi")))
    overall = psi.agg(  # eight rows
        ratio(F.round(F.sum("psi"), 4), F.count("psi")).alias("_overall"),
        F.slice(ranked, 1, 5).alias("_top"),
    )
    row = overall.crossJoin(F.broadcast(side(reference, "ref"))).crossJoin(F.broadcast(side(current, "cur")))
    o = F.col("_overall")
    change = F.col("_rate_cur") - F.col("_rate_ref")
    grown = percent(F.col("volume_cur") - F.col("volume_ref"), F.greatest("volume_ref", F.lit(1)), 12)
    signed = lambda fmt, v: F.format_string(fmt, v)
    # fixed values: wording of the recommendations
    zone = (
        F.when(o >= RETRAIN_FROM, signed("PSI %.3f exceeds 0.20 threshold — retrain model immediately.", o))
        .when(o >= STABLE_BELOW, signed("PSI %.3f in warning zone (0.10–0.20) — schedule retraining soon.", o))
        .otherwise(signed("PSI %.3f is stable — no retraining needed.", o))
    )
    drifted = F.transform(
        F.filter(F.slice("_top", 1, 3), lambda f: f["psi"] >= RETRAIN_FROM),
        lambda f: F.format_string(
            "Feature '%s' has high drift (PSI=%.3f) — investigate distribution change.", f["feature"], f["psi"]
        ),
    )
    rate = F.when(change > 1.0, signed(
        "Fraud rate increased %+.2f%% — potential new attack pattern. "
        "Review recent flagged transactions immediately.", change,
    )).when(change < -1.0, signed(
        "Fraud rate dropped %+.2f%% — possible model under-detecting. "
        "Verify false negative rate hasn't increased.", change,
    ))
    volume = F.when(F.abs(grown) > 30, signed(
        "Transaction volume changed %+.0f%% — significant volume shift can distort PSI scores.", grown,
    ))
    return row.select(
        round_to(o, 4).alias("overall_psi"),
        status_of(o).alias("status"),
        ((o >= RETRAIN_FROM) | (F.abs(change) > 1.0)).alias("should_retrain"),
        round_to(F.col("_rate_ref"), 3).alias("fraud_rate_ref"),
        round_to(F.col("_rate_cur"), 3).alias("fraud_rate_cur"),
        "volume_ref", "volume_cur",
        round_to(grown, 1).alias("volume_change_pct"),
        F.transform("_top", lambda f: f["feature"]).alias("top_drifted_features"),
        F.concat(F.array(zone), drifted, F.array_compact(F.array(rate, volume))).alias("recommendations"),
    )
