"""Secret scans with linking of multipart credentials.

Patterns that are proof enough by themselves are always reported. Long mixed strings without a
keyword are weak: one is reported only if a complementary part (an access identifier, a user name or
an endpoint) that has no character in common with it lies within SCOPE code points of it in the same text. The join by
intervals takes the parts of a text in order and carries the nearest end before and the nearest start after along, so
it is linear in the parts. Everything runs as DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.frames import let, q, running_totals
from ledgerlens.storage import Scratch

SCOPE = 200
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A run is matched as a whole, so a least length gives the same spans as dropping short ones later.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
USER = r"""(?i:user_?name|user|login|client_?id|account_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@-]+"""
ENDPOINT = r"(?i:https?|postgres|mysql|redis|mongodb|amqp|s3)://[A-Za-z0-9._~:/?#@!$&+,;=%-]+|(?i:host|server|endpoint)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.-]+"
MIXED = r"[A-Za-z0-9+/_=-]{20,}"
#: In the order in which spans with one start are listed.
KINDS = ["assign", "access", "hex", "weak"]
_SPANS = "array<struct<start: bigint, rank: int, end: bigint>>"


def spans(text: Column, pattern: str, rank: int, accept) -> Column:
    """The pattern's leftmost non-overlapping matches that ``accept`` takes, as (start, rank, end) in code points."""

    def placed(hits: Column, gaps: Column) -> Column:
        # The text between matches: match i begins after gaps 0..i and matches before i.
        lengths = F.transform(hits, lambda h, i: (F.get(gaps, i) + F.length(h)).cast("long"))
        return let(running_totals(lengths), lambda ends: F.transform(
            F.filter(
                F.transform(hits, lambda h, i: F.struct(h.alias("hit"), F.get(ends, i).alias("end"))), lambda z: accept(z["hit"])
            ),
            lambda z: F.struct((z["end"] - F.length(z["hit"])).alias("start"), F.lit(rank).alias("rank"), z["end"].alias("end")),
        ))

    none = F.array().cast(_SPANS)
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hits: F.when(F.size(hits) == 0, none).otherwise(
        let(F.transform(F.split(text, pattern, -1), F.length), lambda gaps: placed(hits, gaps)).cast(_SPANS)
    ))


def _listed(found: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(found), lambda s: F.concat_ws(
        ":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string")
    )), ",")


def secrets(
    docs: DataFrame, scope: int = SCOPE, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_weak.

    Spans are kind:start:end in code points, the end exclusive, ordered by start and then kind. A null text
    is an empty one, without spans. Rows are told apart by a number given when the base spans are written, so
    repeated and null ids have results of their own. Other columns are not read. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    text = F.coalesce(F.col("text"), F.lit(""))

    def value(hit: Column) -> Column:
        return F.length(F.regexp_extract(hit, ASSIGN, 2)) >= 12

    def any_hit(hit: Column) -> Column:
        return F.lit(True)

    def is_mixed(hit: Column) -> Column:
        return hit.rlike("[0-9]") & hit.rlike("[A-Z]") & hit.rlike("[a-z]")

    found = scratch.keep(
        docs.select(q(id_column).alias("doc_id"), q(text_column).alias("text")).select(
            F.monotonically_increasing_id().alias("row"), "doc_id",
            spans(text, ASSIGN, 0, value).alias("assign"),
            spans(text, ACCESS, 1, any_hit).alias("access"),
            spans(text, HEX, 2, any_hit).alias("hex"),
            spans(text, MIXED, 3, is_mixed).alias("mixed"),
            spans(text, USER, 4, any_hit).alias("users"),
            spans(text, ENDPOINT, 5, any_hit).alias("endpoints"),
        ), "spans",
    )
    base = F.concat("assign", "access", "hex")
    parts = (
        found.filter(F.size("mixed") > 0).filter(F.size("access") + F.size("users") + F.size("endpoints") > 0)
        .select("row", F.explode(F.concat(base, "mixed", "users", "endpoints")).alias("s")).select("row", "s.*")
    )
    weak, partner, base_span = F.col("rank") == 3, F.col("rank").isin(1, 4, 5), F.col("rank") < 3
    start, end = F.col("start"), F.col("end")

    def reached(order: Column, value: Column, which) -> Column:
        # Rows at or before this one in ``order``; what is due later comes in the opposite order, as a running frame too.
        return which(value).over(Window.partitionBy("row").orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow))

    near = parts.select(
        *parts.columns, F.when(weak, start).otherwise(end).alias("ends"), F.when(weak, end).otherwise(start).alias("starts")
    ).select(
        "row", "start", "rank", "end",
        # The nearest partners that end by the candidate's start and start from its end on: none shares a character with it.
        reached(F.col("ends").asc(), F.when(partner, end), F.max).alias("partner_end"),
        reached(F.col("starts").desc(), F.when(partner, start), F.min).alias("partner_start"),
        reached(start.asc(), F.when(base_span, end), F.max).alias("base_end"),
        reached(start.desc(), F.when(base_span, start), F.min).alias("base_start"),
    ).filter(weak)
    linked = near.filter(
        (F.coalesce(F.col("start") - F.col("partner_end") <= scope, F.lit(False))
         | F.coalesce(F.col("partner_start") - F.col("end") <= scope, F.lit(False)))
        & ~F.coalesce(F.col("base_end") > F.col("start"), F.lit(False))
        & ~F.coalesce(F.col("base_start") < F.col("end"), F.lit(False))
    ).groupBy("row").agg(F.collect_list(F.struct("start", "rank", "end")).alias("linked"))
    none = F.array().cast(_SPANS)
    return found.join(linked, "row", "left").select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.concat(base, F.coalesce(F.col("linked").cast(_SPANS), none))).alias("spans"),
        F.size(F.coalesce(F.col("linked").cast(_SPANS), none)).cast("long").alias("n_weak"),
    )
