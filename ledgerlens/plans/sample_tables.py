"""Payment-shaped raw tables derived from the star-schema test tables.

Every value is computed by Spark from the given parquet files; the check queries hold the
same definitions in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.fixed import FX_BASE
from ledgerlens.sources.readers import read_parquet

CURRENCIES = list(FX_BASE)
AS_OF = "2001-12-01"
SPREAD_BY = {"lineitem": "l_orderkey", "orders": "o_orderkey", "events": "event_id"}


def _pick(values: list[str], index: str) -> str:
    """SQL text that picks from a list by a 0-based position."""
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), cast({index} as int) + 1)"


def _country(index: str) -> str:
    return _pick(["GB", "US", "FR", "JP", "BR", "CA", "KE", "PL"], index)


def _currency(index: str) -> str:
    return _pick(CURRENCIES, index)


def _category(index: str) -> str:
    return _pick([
        "Books", "ATM", "Bakery", "Cinema", "Clothing", "Transfer", "Dentist", "Garden",
        "Hotel", "Petrol",
    ], index)


def _mcc(index: str) -> str:
    return _pick(
        ["5942", "6011", "5462", "7922", "5691", "4829", "8021", "5261", "7011", "5542"], index
    )


def _channel(index: str) -> str:
    return _pick(["card", "app", "web", "atm"], index)


LINE_AMOUNT = "amount_cents / 100.0D"
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
#: What a line alone decides.
LINE_VALUES = [
    "floor(l_extendedprice * 100 + 0.5D) as price_cents",
    "floor(l_extendedprice / 10 + 0.5D) as amount_cents",
    "unix_timestamp(cast(l_shipdate as timestamp)) + (l_partkey * 7919 + l_linenumber * 104729) % 86400 as at_second",
    "cast(cast(l_shipdate as timestamp) as date) as ship_date",
    "cast(l_partkey % 6 as int) as currency_index", "cast(l_partkey % 3 as int) as outcome_index",
    "cast(l_linenumber % 4 as int) as channel_index",
    "cast(if(l_partkey % 5 = 0, l_partkey % 8, null) as int) as part_country_index",
]
LINE_TESTS = {
    "is_open": "l_linestatus = 'O'", "is_returned": "l_returnflag = 'R'", "is_reduced": "l_discount >= 0.09D",
    "is_taxed": "l_tax >= 0.08D", "is_disputed": "l_tax >= 0.06D and l_tax < 0.07D",
}


def _packed(tests: list[str]) -> str:
    """SQL text of one whole number that holds the results of tests, each true, false or null."""
    return " + ".join(f"ifnull(cast({test} as int), 2) * {3 ** i}" for i, test in enumerate(tests))


def _unpacked(names: list[str], packed: str) -> list[str]:
    return [f"nullif({packed} div {3 ** i} % 3, 2) = 1 as {name}" for i, name in enumerate(names)]


@dataclass(frozen=True)
class SampleTables:
    """``whole_rows``: transactions are wanted with all their columns; the rows are the same."""

    spark: SparkSession
    folder: str
    whole_rows: bool = False

    def table(self, name: str) -> DataFrame:
        return read_parquet(self.spark, f"{self.folder}/{name}.parquet", SPREAD_BY.get(name))

    @cached_property
    def _lines(self) -> DataFrame:
        """Order lines with their order. What a line alone decides is computed before the join, as few short values: the
        join moves all lines, and raw prices, rates, keys and dates pass through it only where an id is asked for.

        Where all values are wanted, those it takes to compute them are fewer than they are, and pass in their place."""
        lines, orders = self.table("lineitem"), self.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
        same_order = F.expr("l_orderkey = o_orderkey")
        names, tests = [*LINE_TESTS], [*LINE_TESTS.values()]
        if self.whole_rows:
            moved = lines.selectExpr(*LINE_KEYS, "l_extendedprice", "l_shipdate", f"{_packed(tests)} as tests")
            joined = moved.join(orders, same_order).selectExpr("*", *LINE_VALUES, *_unpacked(names, "tests"))
        else:
            ready = [f"{test} as {name}" for name, test in LINE_TESTS.items()]
            joined = lines.selectExpr(*LINE_KEYS, *LINE_VALUES, *ready).join(orders, same_order)
        return joined.selectExpr(
            "*",
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
            "date_format(ship_date, 'yyyyMMdd'), price_cents) as transaction_id",
        )

    @cached_property
    def transactions(self) -> DataFrame:
        return self._lines.selectExpr(
            "transaction_id",
            "cast(o_custkey as string) as customer_id",
            "cast(l_suppkey as string) as merchant_id",
            f"{LINE_AMOUNT} as amount",
            f"{_currency('currency_index')} as currency",
            "timestamp_seconds(at_second) as transaction_at",
            """case when o_orderstatus = 'O' and is_open then 'declined'
                    when o_orderstatus = 'P' and is_reduced then 'pending'
                    when o_orderstatus = 'F' and is_taxed then 'failed'
                    else 'completed' end as status""",
            "is_returned and is_reduced as is_flagged_fraud",
            f"{_channel('channel_index')} as channel",
            f"{_country('coalesce(part_country_index, o_custkey % 8)')} as ip_country",
        )

    @cached_property
    def customers(self) -> DataFrame:
        return self.table("customer").join(
            self.table("nation"), F.expr("c_nationkey = n_nationkey"), "left"
        ).selectExpr(
            "cast(c_custkey as string) as customer_id",
            "c_name as full_name",
            "concat('  ', c_name, '@Example.COM ') as email",
            "format_string('000-%07d', c_custkey) as phone",
            f"{_country('c_custkey % 8')} as country",
            "c_mktsegment as account_tier",
            "cast(date_add(date'1995-01-01', cast(c_custkey * 37 % 1400 as int)) as string) as signup_date",
            "case c_custkey % 10 when 8 then 'pending' when 9 then 'failed' else 'verified' end as kyc_status",
            "cast(date_add(date'1930-01-01', cast(c_custkey * 101 % 18000 as int)) as string) as date_of_birth",
            f"{_currency('n_regionkey')} as currency",
        )

    @cached_property
    def merchants(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "cast(s_suppkey as string) as merchant_id",
            "s_name as merchant_name",
            f"{_category('s_suppkey % 10')} as category",
            f"{_mcc('s_suppkey % 10')} as mcc_code",
            f"{_country('s_nationkey % 8')} as country",
            "s_acctbal < 0 as is_high_risk",
            "cast(date_add(date'1992-01-01', cast(s_suppkey * 53 % 1000 as int)) as string) as onboarded_date",
        )

    @cached_property
    def fx_rates(self) -> DataFrame:
        """One rate per day of the data and currency; every 17th day is missing."""
        rates = ", ".join(f"struct('{c}' as currency, {i} as n, {b}D as base)" for i, (c, b) in enumerate(FX_BASE.items()))
        return (
            self.table("lineitem")
            .selectExpr("min(cast(l_shipdate as date)) as first", "max(cast(l_shipdate as date)) as last")
            .selectExpr("first", "explode(sequence(first, last)) as rate_date")
            .selectExpr("rate_date", "datediff(rate_date, first) as day", f"explode(array({rates})) as r")
            .where("day % 17 <> 16")
            .selectExpr(
                "cast(rate_date as string) as rate_date", "r.currency",
                "r.base * (1.0D + cast((day * 37 + r.n * 11) % 101 - 50 as double) / 10000.0D) as rate_to_gbp",
            )
        )

    @cached_property
    def disputes(self) -> DataFrame:
        """Returned lines of one tax rate; odd line numbers are disputed twice."""
        return (
            self._lines.where("is_returned and is_disputed")
            .selectExpr("*", "explode(if(l_linenumber % 2 = 1, array(1, 2), array(1))) as n")
            .selectExpr(
                "concat('d', n, '-', transaction_id) as dispute_id",
                "transaction_id",
                "cast(o_custkey as string) as customer_id",
                "cast(date_add(ship_date, n * 10) as string) as opened_at",
                _pick(["stolen_card", "charged_twice", "never_arrived", "wrong_price"], "channel_index") + " as reason",
                _pick(["won", "lost", "pending"], "outcome_index") + " as status",
                f"{LINE_AMOUNT} as amount",
                f"{_currency('currency_index')} as currency",
            )
        )

    @cached_property
    def payments(self) -> DataFrame:
        """Transactions in canonical form, with merchant name and category."""
        merchants = self.merchants.selectExpr("merchant_id", "merchant_name", "category as merchant_category")
        return self.transactions.withColumnRenamed("ip_country", "country").join(merchants, "merchant_id", "left")

    @cached_property
    def order_payments(self) -> DataFrame:
        """Orders as payments; every seventh customer pays in round hundreds."""
        return self.table("orders").selectExpr(
            "cast(o_orderkey as string) as transaction_id",
            "cast(o_custkey as string) as customer_id",
            "cast(o_orderkey % 50 as string) as merchant_id",
            "concat('Shop ', o_orderkey % 50) as merchant_name",
            f"{_category('o_orderkey % 10')} as merchant_category",
            "if(o_custkey % 7 = 0, floor(o_totalprice / 5000) * 100.0D, floor(o_totalprice * 2 + 0.5D) / 100.0D) as amount",
            f"{_currency('o_orderkey % 3')} as currency",
            "timestamp_seconds(unix_timestamp(cast(o_orderdate as timestamp)) + o_orderkey * 7919 % 86400) as transaction_at",
            "if(o_orderstatus = 'O', 'declined', 'completed') as status",
            f"{_channel('o_orderkey % 4')} as channel",
            f"{_country('o_custkey % 8')} as country",
            "o_orderpriority = '1-URGENT' as is_flagged_fraud",
        )

    @cached_property
    def event_payments(self) -> DataFrame:
        """Events as payments with full time stamps and busy customers."""
        return self.table("events").selectExpr(
            "cast(event_id as string) as transaction_id",
            "cast(user_id as string) as customer_id",
            "cast(event_id % 40 as string) as merchant_id",
            "concat('Shop ', event_id % 40) as merchant_name",
            f"{_category('event_id % 10')} as merchant_category",
            "value as amount",
            f"{_currency('event_id % 3')} as currency",
            "cast(ts as timestamp) as transaction_at",
            "if(event_type = 'error', 'declined', 'completed') as status",
            f"{_channel('event_id % 4')} as channel",
            f"{_country('user_id % 8')} as country",
            "event_type = 'error' and value > 60 as is_flagged_fraud",
        )

    @cached_property
    def user_export(self) -> DataFrame:
        """Orders as a user's file: other column names, odd spellings, bad numbers and dates."""
        return self.table("orders").selectExpr(
            "cast(o_orderkey as string) as record_id",
            "if(o_orderkey % 11 <> 0, cast(o_custkey as string), null) as member_id",
            """case when o_orderkey % 13 = 0 then 'n/a'
                    when o_orderkey % 17 = 0 then concat('-', format_string('%.2f', o_totalprice))
                    else format_string('%.2f', o_totalprice) end as debit""",
            "if(o_orderkey % 19 = 0, 'unknown date', date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')) as occurred_at",
            """case when o_orderstatus = 'F' then ' SUCCESS ' when o_orderstatus = 'O' then 'failed'
                    when o_orderkey % 2 = 0 then 'Processing' end as outcome""",
            "concat('Shop ', o_orderkey % 50) as payee",
            f"concat(' ', lower({_currency('o_orderkey % 6')})) as ccy",
            "case when o_orderpriority = '1-URGENT' then 'YES' when o_orderkey % 3 = 0 then '0' end as fraud_flag",
            "o_orderpriority as remarks",
        )

    def messages(self, events: DataFrame) -> DataFrame:
        """Events as topic messages: some sent twice, some cut off, some without an id.

        A plain projection, so ``events`` may be a batch or a stream.
        """
        rates = ", ".join(f"{FX_BASE[c]}D" for c in CURRENCIES[:3])
        rate = f"element_at(array({rates}), cast(event_id % 3 as int) + 1)"
        here, home = _country("event_id % 8"), _country("user_id % 8")
        k = "cast(regexp_extract(props, '([0-9]+)', 1) as double)"
        body = f"""to_json(named_struct(
            'event_id', if(event_id % 101 <> 0, concat('evt-', event_id), null),
            'transaction_id', concat('stx-', event_id),
            'event_time', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
            'customer_id', cast(user_id as string),
            'merchant_id', cast(event_id % 40 as string),
            'merchant_name', concat('Shop ', event_id % 40),
            'merchant_category', {_category('event_id % 10')},
            'mcc_code', {_mcc('event_id % 10')},
            'amount', value,
            'currency', if(event_id % 3 <> 0, {_currency('event_id % 3')}, null),
            'amount_gbp', floor(value / {rate} * 100 + 0.5D) / 100.0D,
            'status', case event_type when 'error' then 'declined' when 'click' then 'pending' else 'completed' end,
            'channel', {_channel('event_id % 4')},
            'ip_country', {here},
            'customer_tier', if(user_id % 5 <> 0, 'standard', null),
            'customer_country', {home},
            'is_kyc_verified', user_id % 10 <> 9,
            'is_high_risk_merchant', event_id % 10 = 9,
            'is_cross_border', {here} <> {home},
            'is_flagged_fraud', event_type = 'error' and {k} >= 50,
            'risk_score', {k}))"""
        return (
            events.selectExpr(
                f"{body} as body", "event_id", "cast(user_id % 3 as int) as partition",
                "explode(if(event_id % 50 = 7, array(0, 1), array(0))) as copy",
            )
            .selectExpr(
                "if(event_id % 97 = 0, substring(body, 1, 40), body) as value", "partition",
                "event_id * 2 + copy as offset",
            )
        )

    def event_stream(self) -> DataFrame:
        """The events table read as a stream."""
        return (
            self.spark.readStream.schema(self.table("events").schema)
            .option("pathGlobFilter", "events.parquet")
            .parquet(self.folder)
        )
