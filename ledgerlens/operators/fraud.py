"""Fraud features, scores, reasons and summaries for every transaction."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.functions import fixed
from ledgerlens.functions.columns import count_where, percent, ratio, round_to
from ledgerlens.operators.ordering import exact_percentiles, with_row_index
from ledgerlens.operators.skew import find_hot, with_running_total
from ledgerlens.storage import stage

# The tree helpers below run inside tasks; send them along rather than import them there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Categories up to this number travel with the plan.
LISTED_VALUES = 10_000

FEATURES = [
    "amount", "amount_log", "hour", "day_of_week", "is_weekend", "is_night",
    "customer_txn_count", "merchant_category_enc", "channel_enc",
]


def with_code(df: DataFrame, column: str, out: str, absent: str, codes: DataFrame) -> DataFrame:
    """Replace a category by its place in the alphabet of the categories that occur.

    Unhinted: a small dictionary is broadcast by its size, a large one is joined by key.
    """
    value = F.coalesce(F.col(column).cast("string"), F.lit(absent))
    return (
        df.withColumn("_value", value)
        .join(codes.select(F.col("value").alias("_value"), F.col("code").alias(out)), "_value", "left")
        .drop("_value")
    )


def category_codes(df: DataFrame, column: str, absent: str) -> DataFrame:
    """Distinct values of a column with their place in the alphabet.

    A dictionary is small and numbered in one task; a column that turns out to have very
    many values is numbered by a distributed sort.
    """
    values = df.select(F.coalesce(F.col(column).cast("string"), F.lit(absent)).alias("value")).distinct()
    found = values.limit(LISTED_VALUES + 1).collect()
    if len(found) > LISTED_VALUES:
        return with_row_index(values, ["value"], "place").select("value", F.col("place").cast("double").alias("code"))
    places = [(r["value"], float(i)) for i, r in enumerate(sorted(found, key=lambda r: r["value"]))]
    return df.sparkSession.createDataFrame(places, "value string, code double")


def time_features(at: Column, no_hour: int = 0, no_day: int = 0) -> dict[str, Column]:
    # A missing time is no night, whatever its hour is filled with.
    night = (F.hour(at) < 6) | (F.hour(at) > 22)
    hour = F.coalesce(F.hour(at), F.lit(no_hour)).cast("double")
    day = F.coalesce(F.weekday(at), F.lit(no_day)).cast("double")
    return {
        "hour": hour,
        "day_of_week": day,
        "is_weekend": F.when(day >= 5, 1.0).otherwise(0.0),
        "is_night": F.when(night, 1.0).otherwise(0.0),
    }


def fraud_features(payments: DataFrame, hot_limit: int | None = None) -> DataFrame:
    """Feature rows keyed by ``transaction_id``, with ``is_fraud`` as label (0 when absent).

    The running count of a customer's transactions follows time, then transaction id.
    """
    at = F.col("transaction_at").cast("timestamp")
    has = payments.columns
    label = F.col("is_fraud") if "is_fraud" in has else F.col("is_flagged_fraud")
    rows = payments.select(
        "transaction_id", "customer_id", at.alias("transaction_at"),
        F.coalesce(F.col("amount").cast("double"), F.lit(0.0)).alias("amount"),
        F.col("merchant_category"),
        (F.col("channel") if "channel" in has else F.lit(None).cast("string")).alias("channel"),
        F.coalesce(label.cast("int"), F.lit(0)).alias("label"),
    )
    counted = with_running_total(
        rows, "customer_id", "transaction_at", ["transaction_id"], F.lit(1), "customer_txn_count",
        find_hot(payments, "customer_id", hot_limit),
    )
    # One pass over the payments finds the values of both.
    occurring = stage(rows.select("merchant_category", "channel").distinct(), "occurring-values")
    categories = category_codes(occurring, "merchant_category", "Unknown")
    channels = category_codes(occurring, "channel", "unknown")
    coded = with_code(counted, "merchant_category", "merchant_category_enc", "Unknown", categories)
    coded = with_code(coded, "channel", "channel_enc", "unknown", channels)
    return coded.withColumns({
        "amount_log": F.log1p("amount"),
        "customer_txn_count": F.col("customer_txn_count").cast("double"),
        **time_features(F.col("transaction_at")),
    }).select("transaction_id", *FEATURES, "label")


def detection_mode(payments: DataFrame) -> DataFrame:
    """``supervised`` when there is at least one positive label, else ``unsupervised``."""
    label = "is_fraud" if "is_fraud" in payments.columns else "is_flagged_fraud"
    return payments.agg(
        F.when(F.max(F.coalesce(F.col(label).cast("int"), F.lit(0))) > 0, "supervised")
        .otherwise("unsupervised").alias("mode")
    )


def risk_level(probability: Column) -> Column:
    return (
        F.when(probability > 0.8, "CRITICAL").when(probability > 0.6, "HIGH")
        .when(probability > 0.3, "MEDIUM").otherwise("LOW")
    )


def action_for(level: Column) -> Column:
    result = F.lit(None).cast("string")
    for name, text in fixed.RISK_ACTIONS.items():
        result = F.when(level == name, text).otherwise(result)
    return result


def supervised_scores(
    payments: DataFrame, threshold: float = 0.5, trees: int = 100, depth: int = 4, rate: float = 0.1
) -> DataFrame:
    """Boosted trees fitted and applied to the same rows; positives weighted by neg/pos."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    features = stage(fraud_features(payments), "fraud-features")
    n = features.agg(F.sum("label").alias("pos"), F.count("*").alias("n")).first()
    weight = max((n["n"] - (n["pos"] or 0)) / max(n["pos"] or 0, 1), 1.0)
    weighted = features.withColumn("weight", F.when(F.col("label") == 1, weight).otherwise(1.0))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(weighted)
    model = GBTClassifier(
        labelCol="label", featuresCol="features", weightCol="weight",
        maxIter=trees, maxDepth=depth, stepSize=rate, seed=42,
    ).fit(vectors)
    p = vector_to_array("probability")[1]
    return model.transform(vectors).select(
        "transaction_id", "amount",
        round_to(p, 4).alias("fraud_probability"),
        risk_level(p).alias("risk_level"),
        (p >= threshold).alias("is_predicted_fraud"),
        F.col("label").alias("actual_label"),
    )


# ---- isolation forest --------------------------------------------------------

def _path_constant(n):
    """Mean path length of an unsuccessful search in a binary tree of n keys."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2.0)
    return np.where(n > 2, 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe,
                    np.where(n == 2, 1.0, 0.0))


def _grow(points: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Nodes (feature, cut, left, right, depth + expected rest) of one random tree."""
    nodes: list[tuple] = []
    todo = [(np.arange(len(points)), 0, -1, 0)]
    while todo:
        rows, depth, parent, side = todo.pop()
        here = len(nodes)
        if parent >= 0:
            nodes[parent] = nodes[parent][: 2 + side] + (here,) + nodes[parent][3 + side:]
        low, high = points[rows].min(axis=0), points[rows].max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= max_depth or len(rows) <= 1 or len(usable) == 0:
            nodes.append((-1, 0.0, -1, -1, float(depth + _path_constant(len(rows)))))
            continue
        feature = int(rng.choice(usable))
        cut = float(rng.uniform(low[feature], high[feature]))
        nodes.append((feature, cut, -1, -1, 0.0))
        below = points[rows, feature] <= cut
        todo.append((rows[~below], depth + 1, here, 1))
        todo.append((rows[below], depth + 1, here, 0))
    return nodes


_NODE_SCHEMA = "tree int, node int, feature int, cut double, lft int, rgt int, path double"


def _binomial_limits(draws: int, share: float) -> list[float]:
    """P(at most k of ``draws`` hit), k = 0, 1, ... until less than 1e-14 is left."""
    if share >= 1.0:
        return [0.0] * draws
    limits, total, term = [], 0.0, (1.0 - share) ** draws
    for k in range(draws):
        total += term
        if total >= 1.0 - 1e-14:
            break
        limits.append(total)
        term *= (draws - k) / (k + 1) * share / (1.0 - share)
    return limits


def forest_samples(features: DataFrame, trees: int, sample: int, seed: int, rows: int) -> DataFrame:
    """``sample`` rows (all, of fewer) for each of ``trees`` trees, of a table of ``rows`` rows: FEATURES, tree, place.

    One hash of the id says how many trees a row enters, by the binomial share of so many draws, and only rows that
    enter any are multiplied; further hashes say which trees. Some ``2 * trees * sample`` rows are shuffled, whatever
    the size of the table, and of a tree's rows the smallest hashes stay. The draw does not depend on partitions.
    """
    share = min(1.0, 2.0 * sample / max(rows, 1))
    uniform = F.shiftrightunsigned(F.xxhash64("transaction_id", F.lit(seed)), 11) * F.lit(2.0 ** -53)
    entered = sum((uniform >= F.lit(limit)).cast("int") for limit in _binomial_limits(trees, share))
    ranked = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(
        F.xxhash64("transaction_id", t, F.lit(seed)).alias("draw"), t.alias("tree")
    )))
    drawn = (
        features.withColumn("_entered", entered).filter("_entered > 0")
        .select("transaction_id", *FEATURES, F.inline(F.slice(ranked, F.lit(1), F.col("_entered"))))
        # Its rank among a row's trees must not decide a row's place within a tree.
        .withColumn("draw", F.xxhash64("draw"))
    )
    first = Window.partitionBy("tree").orderBy("draw", "transaction_id")
    return drawn.select("transaction_id", *FEATURES, "tree", F.row_number().over(first).alias("place")).filter(F.col("place") <= sample)


def isolation_forest(
    features: DataFrame, trees: int = 100, sample: int = 256, seed: int = 42
) -> DataFrame:
    """Nodes of a forest, each tree grown from a sample of its own (see ``forest_samples``)."""
    n = features.count()
    samples = forest_samples(features, trees, sample, seed, n)
    depth = int(np.ceil(np.log2(max(min(sample, n), 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        tree = int(pdf["tree"].iloc[0])
        nodes = _grow(pdf[FEATURES].to_numpy(float), np.random.default_rng([seed, tree]), depth)
        out = pd.DataFrame(nodes, columns=["feature", "cut", "lft", "rgt", "path"])
        out.insert(0, "node", range(len(out)))
        out.insert(0, "tree", tree)
        return out

    return samples.groupBy("tree").applyInPandas(grow, _NODE_SCHEMA)


def _laid_out(nodes: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """A forest's nodes one tree after the other: each tree's first node, and of each node its feature, cut, next node below
    and above the cut, and path. A leaf leads to itself."""
    nodes = nodes.sort_values(["tree", "node"])
    starts = np.flatnonzero(nodes["node"].to_numpy() == 0)
    offset = np.repeat(starts, np.diff(np.append(starts, len(nodes))))
    feature = nodes["feature"].to_numpy()
    leaf = feature < 0
    below, above = (np.where(leaf, np.arange(len(nodes)), nodes[c].to_numpy() + offset) for c in ("lft", "rgt"))
    return starts, np.where(leaf, 0, feature), nodes["cut"].to_numpy(float), below, above, nodes["path"].to_numpy(float)


def _mean_path(x: np.ndarray, starts, feature, cut, below, above, path) -> np.ndarray:
    """Each row's mean path over all trees, which are walked down together."""
    at = np.repeat(starts[:, None], len(x), axis=1)
    row = np.arange(len(x)) * x.shape[1]
    values = np.ascontiguousarray(x).ravel()
    while True:
        after = np.where(values[row + feature[at]] <= cut[at], below[at], above[at])
        if (after == at).all():
            break
        at = after
    # Tree by tree, so that the sum does not depend on how many rows there are.
    total = np.zeros(len(x))
    for tree in at:
        total += path[tree]
    return total / max(len(starts), 1)


def unsupervised_scores(
    payments: DataFrame, contamination: float = 0.02, trees: int = 100, sample: int = 256
) -> DataFrame:
    """Isolation-forest scores scaled to 0..1; the most isolated ``contamination`` share is flagged."""
    features = stage(fraud_features(payments), "fraud-features")
    # At most trees * (2 * sample - 1) nodes, whatever the number of transactions.
    nodes = isolation_forest(features, trees, sample).toPandas()
    shared = features.sparkSession.sparkContext.broadcast(_laid_out(nodes))
    norm = float(_path_constant(min(sample, max(features.count(), 2))))

    def score(batches):
        for pdf in batches:
            mean = _mean_path(pdf[FEATURES].to_numpy(float), *shared.value)
            yield pd.DataFrame({
                "transaction_id": pdf["transaction_id"], "amount": pdf["amount"],
                "score": np.power(2.0, -mean / norm),
            })

    scored = stage(
        features.mapInPandas(score, "transaction_id string, amount double, score double"), "isolation-scores"
    )
    cut = exact_percentiles(scored, "score", [1.0 - contamination])[0]
    spread = scored.agg(F.min("score").alias("_low"), F.max("score").alias("_high"))
    p = (F.col("score") - F.col("_low")) / (F.col("_high") - F.col("_low") + 1e-9)
    return scored.crossJoin(F.broadcast(spread)).select(
        "transaction_id", "amount",
        round_to(p, 4).alias("fraud_probability"),
        risk_level(p).alias("risk_level"),
        (F.col("score") > F.lit(cut)).alias("is_predicted_fraud"),
    )


def detect(payments: DataFrame, mode: str = "auto", contamination: float = 0.02, threshold: float = 0.5) -> DataFrame:
    if mode == "auto":
        mode = detection_mode(payments).first()["mode"]
    if mode == "supervised":
        return supervised_scores(payments, threshold)
    return unsupervised_scores(payments, contamination)


def fraud_summary(scores: DataFrame) -> DataFrame:
    flagged = F.col("is_predicted_fraud")
    return scores.agg(
        F.count("*").alias("total_transactions"),
        count_where(flagged).alias("predicted_fraud"),
        percent(count_where(flagged), F.count("*"), 2).alias("fraud_rate_pct"),
        count_where(F.col("risk_level") == "CRITICAL").alias("critical_count"),
        count_where(F.col("risk_level") == "HIGH").alias("high_count"),
        round_to(ratio(F.round(F.sum("fraud_probability"), 4), F.count("fraud_probability")), 4)
        .alias("avg_fraud_probability"),
    )


# ---- reasons -----------------------------------------------------------------

def _two_decimals(value: Column) -> Column:
    return F.translate(F.format_number(value, 2), ",", "")


def reason_codes(payments: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rule-based risk signals and their wording for every transaction, with the columns ``keep``.

    Same-day counts are aggregated per customer and day and joined back; the aggregate has
    one row per key, so AQE may split a hot customer-day's rows.
    """
    median = exact_percentiles(payments, "amount", [0.5])[0]
    at = F.col("transaction_at").cast("timestamp")
    has = payments.columns
    origin = F.col("country") if "country" in has else F.col("ip_country") if "ip_country" in has else F.lit("")
    rows = payments.withColumns({
        "_day": at.cast("date"), "_hour": F.hour(at), "_origin": F.coalesce(origin, F.lit("")),
    })
    per_day = (
        rows.filter(F.col("_day").isNotNull())
        .groupBy(F.coalesce("customer_id", F.lit("")).alias("_c"), F.isnull("customer_id").alias("_n"), F.col("_day").alias("_d"))
        .agg(F.count("*").alias("_same_day"))
    )
    # Plain equalities on the grouping columns: the counts already lie where the join wants them.
    same = (F.coalesce("customer_id", F.lit("")) == F.col("_c")) & (F.isnull("customer_id") == F.col("_n")) & (F.col("_day") == F.col("_d"))
    rows = rows.join(per_day, same, "left")
    amount = F.col("amount")
    middle = F.lit(median).cast("double")
    category = F.coalesce(F.col("merchant_category"), F.lit(""))
    risky = F.lit(False)
    for word in fixed.RISKY_CATEGORY_WORDS:
        risky = risky | F.lower(category).contains(word)
    home = F.lit(None).cast("string")
    for currency, country in fixed.CURRENCY_HOME.items():
        home = F.when(F.col("currency") == currency, country).otherwise(home)
    # fixed values: signal names and wording
    signals = [
        ("HIGH_AMOUNT", amount > middle * 3,
         F.concat(F.lit("Amount $"), _two_decimals(amount), F.lit(" is "),
                  F.floor((F.try_divide(amount, middle) - 1.0) * 100.0).cast("string"),
                  F.lit("% above median transaction"))),
        ("ODD_HOURS", (F.col("_hour") < 4) | (F.col("_hour") > 23),
         F.concat(F.lit("Transaction at "), F.format_string("%02d", "_hour"),
                  F.lit(":xx — unusual hour (high fraud window)"))),
        ("HIGH_RISK_MERCHANT_CATEGORY", risky,
         F.concat(F.lit("Merchant category '"), category, F.lit("' has elevated fraud rate"))),
        ("CROSS_BORDER_MISMATCH", (F.length("_origin") == 2) & (F.col("_origin") != home),
         F.concat(F.lit("Transaction origin '"), F.col("_origin"), F.lit("' doesn't match account currency '"),
                  F.col("currency"), F.lit("' (expected "), home, F.lit(")"))),
        ("HIGH_VELOCITY", F.col("_same_day") > 5,
         F.concat(F.lit("Customer had "), F.col("_same_day").cast("string"),
                  F.lit(" transactions on this date — velocity flag"))),
    ]
    codes = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test, _ in signals]))
    texts = F.array_compact(F.array(*[F.when(test, text) for _, test, text in signals]))
    fallback = F.array(F.lit("No specific risk signals detected — flagged by anomaly model"))
    return rows.select(
        "transaction_id", "customer_id", "amount", *keep,
        codes.alias("risk_signals"),
        F.when(F.size(texts) == 0, fallback).otherwise(texts).alias("reasons"),
    )


def explain_transactions(payments: DataFrame, scores: DataFrame, mode: str) -> DataFrame:
    """Score, level, signals, reasons and action of every transaction.

    Rows with one id meet by their amount and their place among those with the same amount, in the order of all their
    columns, so that repeated ids give one row each, and the same ones in every run.
    """
    amount = F.coalesce(F.col("amount").cast("double"), F.lit(0.0))

    def placed(df: DataFrame) -> DataFrame:
        twin = Window.partitionBy("transaction_id", "_amount").orderBy(*[F.col(c).asc_nulls_last() for c in df.columns])
        return df.withColumn("_amount", amount).withColumn("_nth", F.row_number().over(twin))

    reasons = reason_codes(payments.withColumn("merchant", F.coalesce(F.col("merchant_name"), F.lit("Unknown"))), ["merchant"])
    levels = placed(scores.select("transaction_id", "amount", "fraud_probability", "risk_level")).drop("amount")
    return (
        placed(reasons)
        .join(levels, ["transaction_id", "_amount", "_nth"])
        .select(
            "transaction_id", "amount", "merchant", "fraud_probability", "risk_level", "risk_signals",
            "reasons", action_for(F.col("risk_level")).alias("recommended_action"),
            F.lit(mode).alias("detection_mode"),
        )
    )
