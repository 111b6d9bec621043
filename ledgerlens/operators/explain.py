"""Plain-language explanations of every customer's segment, in one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import fixed
from ledgerlens.functions.columns import money, ratio, thousands
from ledgerlens.operators.ordering import exact_percentiles


def population(rfm: DataFrame) -> DataFrame:
    """One row: three averages, the upper quartiles of spend and frequency, the lower one of recency."""
    means = rfm.agg(
        F.avg("recency_days").alias("avg_recency"),
        F.avg("frequency").alias("avg_freq"),
        ratio(money(F.sum("monetary")), F.count("monetary")).alias("avg_monetary"),
    )
    quartiles = {
        "p75_monetary": exact_percentiles(rfm, "monetary", [0.75])[0],
        "p75_freq": exact_percentiles(rfm, "frequency", [0.75])[0],
        "p25_recency": exact_percentiles(rfm, "recency_days", [0.25])[0],
    }
    return means.withColumns({k: F.lit(v).cast("double") for k, v in quartiles.items()})


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _whole(value: Column) -> Column:
    """A number without decimals or separators."""
    return F.translate(thousands(value, 0), ",", "")


def _dollars(value: Column) -> Column:
    return F.concat(F.lit("$"), thousands(value, 0))


def _score_texts() -> list[Column]:
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    days, times, spend = F.col("recency_days").cast("string"), F.col("frequency").cast("string"), F.col("monetary")
    average_days = _whole(F.col("avg_recency"))
    average_times = _whole(F.col("avg_freq"))
    average_spend = _dollars(F.col("avg_monetary"))
    # fixed values: wording of the three drivers
    recency = (
        F.when(r >= 4, _text("Recency score ", r, "/5 — transacted ", days, " days ago (population avg: ",
                             average_days, " days) — recently active"))
        .when(r == 3, _text("Recency score ", r, "/5 — transacted ", days, " days ago (avg: ",
                            average_days, ") — starting to go quiet"))
        .otherwise(_text("Recency score ", r, "/5 — last transaction ", days, " days ago (avg: ",
                         average_days, ") — significantly lapsed"))
    )
    frequency = _text(
        "Frequency score ", f, "/5 — ", F.when(f >= 3, "").otherwise("only "), times,
        " transactions (avg: ", average_times, ") — ",
        F.when(f >= 4, "highly engaged").when(f == 3, "average engagement").otherwise("low engagement"),
    )
    monetary = _text(
        "Monetary score ", m, "/5 — ", _dollars(spend), " lifetime spend (avg: ", average_spend, ") — ",
        F.when(m >= 4, "high value customer").when(m == 3, "mid-value customer")
        .otherwise("low value so far"),
    )
    return [recency, frequency, monetary]


def _gap_texts() -> Column:
    """What separates the customer from the top quartile; a missing or zero quartile falls
    back on a multiple of the average."""
    def quartile(name: str, average: str, factor: float) -> Column:
        q = F.col(name)
        return F.when(q.isNotNull() & (q != 0), q).otherwise(F.col(average) * factor)

    target_days = quartile("p25_recency", "avg_recency", 0.5)
    days = F.col("recency_days")
    late = (F.col("r_score") < 4) & (days != 0) & (F.col("avg_recency") != 0) & (days > target_days)
    times = quartile("p75_freq", "avg_freq", 1.5) - F.col("frequency")
    rare = (F.col("f_score") < 4) & (F.col("avg_freq") != 0) & (times > 1)
    money_gap = quartile("p75_monetary", "avg_monetary", 1.5) - F.col("monetary")
    small = (F.col("m_score") < 4) & (F.col("avg_monetary") != 0) & (money_gap > 0)
    # fixed values: wording of the three gaps
    return F.array_compact(F.array(
        F.when(late, _text("Recency is the main drag — needs to transact within ",
                           F.floor(target_days).cast("string"), " days to reach top quartile")),
        F.when(rare, _text("Frequency is below top quartile — ", _whole(times),
                           " more transactions needed to reach top 25%")),
        F.when(small, _text("Spend is below top quartile — ", _dollars(money_gap),
                            " more needed to reach top 25%")),
    ))


def _steps() -> Column:
    """Up to two (segment, advice) pairs above the customer's segment."""
    r, f, m, days = F.col("r_score"), F.col("f_score"), F.col("m_score"), F.col("recency_days")
    # fixed values: advice for segments without a preset
    derived = (
        F.when(r < 3, _text("Make a transaction within ",
                            F.greatest(F.lit(30), F.floor(days / 2)).cast("string"), " days"))
        .when(f < 3, _text("Complete ", F.greatest(F.lit(1), 3 - f).cast("string"), " more transactions"))
        .when(m < 3, "Increase spend to top 40% of customer base")
        .otherwise("Increase engagement and recency")
    )
    order = fixed.SEGMENT_ORDER
    pairs = {
        name: F.struct(
            F.lit(name).alias("segment"),
            (F.lit(fixed.STEP_TO_REACH[name]) if name in fixed.STEP_TO_REACH else derived).alias("step"),
        )
        for name in order
    }
    empty = F.array().cast("array<struct<segment:string,step:string>>")
    result = empty
    for place, name in enumerate(order):
        above = [s for s in order[place + 1:] if s != "Others"][:2]
        if above:
            result = F.when(F.col("segment") == name, F.array(*[pairs[s] for s in above])).otherwise(result)
    return result


def explain_segments(rfm: DataFrame, segment: str | None = None) -> DataFrame:
    """Drivers, gaps and next steps of each customer, against the whole population."""
    rows = rfm if segment is None else rfm.filter(F.col("segment") == segment)
    return (
        rows.crossJoin(F.broadcast(population(rfm)))
        .withColumn("what_drives_this", F.array(*_score_texts()))
        .withColumn("what_changed", _gap_texts())
        .withColumn("to_move_up", _steps())
        .select(
            "customer_id", "segment", "r_score", "f_score", "m_score", "rfm_total",
            "recency_days", "frequency", "monetary", "what_drives_this", "what_changed",
            "to_move_up", "recommended_action",
        )
    )


def batch_explain(rfm: DataFrame, segment: str | None = None) -> DataFrame:
    """One flat row per customer: key driver, action, next segment and the step towards it."""
    first = F.try_element_at("to_move_up", F.lit(1))
    return explain_segments(rfm, segment).select(
        "customer_id", "segment", "r_score", "f_score", "m_score", "recency_days", "frequency",
        "monetary",
        F.element_at("what_drives_this", 1).alias("key_driver"),
        "recommended_action",
        F.coalesce(first["segment"], F.lit("")).alias("next_segment"),
        F.coalesce(first["step"], F.lit("")).alias("next_step"),
    )


def explain_customer(rfm: DataFrame, customer_id: str) -> DataFrame:
    """The explanation of one customer; an error when the customer is unknown."""
    if rfm.filter(F.col("customer_id") == customer_id).isEmpty():
        raise ValueError(f"customer {customer_id!r} is not in the RFM result")
    return explain_segments(rfm).filter(F.col("customer_id") == customer_id)
