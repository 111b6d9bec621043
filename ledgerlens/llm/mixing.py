"""Mixing sources to target weights by a budget that goes down a tree of domains, languages and sources.

Each node's budget is shared among its children by weight. A child that has too little text is filled
and its shortage goes to its siblings by their weights; only what all children together lack goes
back to the node's own siblings. This holds at every level at once, as a node's supply is the sum
of its children's. Budgets are whole tokens and add up exactly.

A leaf's budget is spent on epochs of the leaf: whole ones first, then the prefix, in the seeded order
of the last epoch, that fits. The order is by a hash, so its first three digits split a leaf
into 4,096 slices: token sums of slices place the cut, and only the slice that holds it is sorted.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.frames import q
from ledgerlens.storage import Scratch

WORD = r"[^\x20\x09-\x0D]+"
LEVELS = ["domain", "lang", "source"]
SLICE_DIGITS = 3


@dataclass
class Mix:
    """Whole-number weights by level and name, others at ``default``; a weight of 0 takes nothing.

    The budget is ``numerator`` / ``denominator`` of all tokens; a document is used at most ``epochs`` times.
    """

    domain: Mapping[str, int] = field(default_factory=dict)
    lang: Mapping[str, int] = field(default_factory=dict)
    source: Mapping[str, int] = field(default_factory=dict)
    default: int = 1
    numerator: int = 1
    denominator: int = 1
    epochs: int = 2
    seed: int = 20

    def weight(self, level: str) -> Column:
        out = F.lit(self.default)
        for name, weight in getattr(self, level).items():
            out = F.when(F.col(level) == name, F.lit(weight)).otherwise(out)
        return out.cast("long")


PRODUCTION = Mix(
    domain={"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1}, lang={"en": 5, "de": 2, "fr": 2, "es": 1},
)


def domain_of(source: Column) -> Column:
    """A source's domain: the remainder by 4 of the number it ends with; ``other`` without one."""
    digits = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.when(digits == "", "other").otherwise(F.concat(F.lit("domain"), F.pmod(digits.cast("long"), F.lit(4)).cast("string")))


def shares(nodes: DataFrame, level: str, parents: list[str], mix: Mix) -> DataFrame:
    """``nodes`` (parents, level, supply, and the parent's ``budget``) with each node's own budget."""
    weighed = nodes.withColumn("weight", mix.weight(level)).filter("weight > 0 AND supply > 0")
    # Nodes in the order in which they run dry as the common level per weight rises.
    order = [F.col("supply") / F.col("weight"), F.col(level)]
    before = Window.partitionBy(*parents).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*parents).orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    dry = weighed.withColumns({
        "used": F.coalesce(F.sum("supply").over(before), F.lit(0)), "open_weight": F.sum("weight").over(after),
    }).withColumn("dry", F.col("supply") * F.col("open_weight") <= (F.col("budget") - F.col("used")) * F.col("weight"))
    # What is left goes by weight; rounding the running totals makes it add up.
    whole = Window.partitionBy(*parents)
    running = Window.partitionBy(*parents).orderBy(level).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    open_weight = F.when(F.col("dry"), 0).otherwise(F.col("weight"))
    return dry.withColumns({
        "rest": F.col("budget") - F.coalesce(F.sum(F.when(F.col("dry"), F.col("supply"))).over(whole), F.lit(0)),
        "all_open": F.sum(open_weight).over(whole), "up_to": F.sum(open_weight).over(running),
    }).withColumn(
        "own", F.expr("CASE WHEN dry THEN supply ELSE (rest * up_to) div all_open - (rest * (up_to - weight)) div all_open END")
    ).select(*parents, level, "supply", F.col("own").alias("budget"))


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """(domain, lang, source, tokens) to the same with each leaf's ``budget``."""
    supply = F.col("tokens") * mix.epochs
    levels = [leaves.withColumn("supply", supply)]
    for depth in (2, 1):
        levels.append(levels[-1].groupBy(*LEVELS[:depth]).agg(F.sum("supply").alias("supply")))
    usable = F.when(mix.weight("domain") > 0, F.col("supply"))
    total, supply = leaves.withColumn("supply", supply).agg(
        F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum(usable), F.lit(0))
    ).first()
    wanted = min(supply, total * mix.numerator // mix.denominator)
    given = shares(levels[2].withColumn("budget", F.lit(wanted).cast("long")), "domain", [], mix)
    for depth, nodes in ((1, levels[1]), (2, levels[0].drop("tokens"))):
        parents = LEVELS[:depth]
        given = shares(nodes.join(given.select(*parents, "budget"), parents), LEVELS[depth], parents, mix)
    return leaves.join(given.select(*LEVELS, "budget"), LEVELS)


def mixed(docs: DataFrame, mix: Mix = PRODUCTION, id_column: str = "doc_id") -> DataFrame:
    """The selected rows: doc_id, domain, lang, source, n_tokens, n_epochs (whole uses), n_prefix (tokens used of
    the last epoch), n_used (all tokens used).

    Tokens are the words `[^\\x20\\x09-\\x0D]+` of a text; null, empty and blank texts have none and are never selected. Null
    languages and sources are names of their own, written as empty strings; null ids are ordered as empty
    ones. Repeated rows are documents of their own; equal rows in the cut slice share the same hash and are
    used in any order. The last document of a prefix may be used in part. Other columns are not read. An empty
    table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    source = F.coalesce(q("source"), F.lit(""))
    counted = scratch.keep(
        docs.select(
            q(id_column).alias("doc_id"), domain_of(source).alias("domain"), F.coalesce(q("lang"), F.lit("")).alias("lang"),
            source.alias("source"), F.coalesce(F.regexp_count(q("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
        ).filter("n_tokens > 0"), "tokens",
    )
    leaves = scratch.keep(counted.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    plan = scratch.keep(budgets(leaves, mix).withColumns({
        "n_epochs": F.expr("budget div tokens"), "rest": F.col("budget") % F.col("tokens"),
    }).select(*LEVELS, "n_epochs", "rest").filter("n_epochs > 0 OR rest > 0"), "plan")

    epoch = F.concat(F.lit(f"{mix.seed}:"), (F.col("n_epochs") + 1).cast("string"), F.lit(":"))
    placed = counted.join(plan, LEVELS).withColumn(
        "place", F.md5(F.concat(epoch, F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    ).withColumn("slice", F.substring("place", 1, SLICE_DIGITS))
    placed = scratch.keep(placed, "placed")
    earlier = Window.partitionBy(*LEVELS).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = placed.groupBy(*LEVELS, "slice").agg(F.sum("n_tokens").alias("in_slice")).withColumn(
        "before", F.coalesce(F.sum("in_slice").over(earlier), F.lit(0))
    )
    at = placed.join(slices, [*LEVELS, "slice"])
    whole = at.filter("n_epochs > 0 OR before < rest")
    inside = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("in_slice") > F.col("rest"))
    cut = at.filter(inside)
    running = Window.partitionBy(*LEVELS).orderBy("place", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("before", F.col("before") + F.coalesce(F.sum("n_tokens").over(running), F.lit(0)))
    prefix = F.greatest(F.lit(0), F.least(F.col("n_tokens"), F.col("rest") - F.col("before")))
    cut = cut.withColumn("n_prefix", prefix)
    clear = whole.filter(~inside).withColumn("n_prefix", F.when(F.col("before") < F.col("rest"), F.col("n_tokens")).otherwise(0))
    columns = ["doc_id", *LEVELS, "n_tokens", "n_epochs", F.col("n_prefix").cast("long").alias("n_prefix")]
    return (
        clear.select(*columns).unionByName(cut.select(*columns))
        .withColumn("n_used", F.col("n_epochs") * F.col("n_tokens") + F.col("n_prefix")).filter("n_used > 0")
    )


def _level_sql(level: str, parents: list[str], nodes: str, weights: Mapping[str, int], default: int) -> str:
    part = f"PARTITION BY {', '.join(parents)} " if parents else ""
    case = "CASE WHEN false THEN 0 " + "".join(f"WHEN {level} = '{k}' THEN {v} " for k, v in weights.items()) + f"ELSE {default} END"
    columns = ", ".join([*parents, level])
    return f"""
  SELECT {columns}, CASE WHEN dry THEN supply ELSE (rest * up_to) // all_open - (rest * (up_to - weight)) // all_open END AS budget
  FROM (
    SELECT *, budget - coalesce(sum(CASE WHEN dry THEN supply END) OVER ({part}), 0) AS rest,
      sum(CASE WHEN dry THEN 0 ELSE weight END) OVER ({part}) AS all_open,
      sum(CASE WHEN dry THEN 0 ELSE weight END) OVER ({part}ORDER BY {level} ROWS UNBOUNDED PRECEDING) AS up_to
    FROM (
      SELECT *, supply * open_weight <= (budget - used) * weight AS dry
      FROM (
        SELECT *,
          coalesce(sum(supply) OVER ({part}ORDER BY supply / weight, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
          sum(weight) OVER ({part}ORDER BY supply / weight, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
        FROM (SELECT *, {case} AS weight FROM ({nodes})) WHERE weight > 0 AND supply > 0
      )
    )
  )"""


def sql(mix: Mix = PRODUCTION) -> str:
    """The same selection for DuckDB."""
    domains = " OR ".join(f"(domain = '{k}' AND {v} > 0)" for k, v in mix.domain.items())
    known = ", ".join(f"'{k}'" for k in mix.domain)
    allowed = f"({domains} OR (domain NOT IN ({known}) AND {mix.default} > 0))" if mix.domain else f"{mix.default} > 0"
    top = _level_sql("domain", [], f"""
      SELECT domain, sum(supply) AS supply, (SELECT least(sum(supply) FILTER (WHERE {allowed}), sum(tokens) * {mix.numerator} // {mix.denominator}) FROM leaves) AS budget
      FROM leaves GROUP BY domain""", mix.domain, mix.default)
    middle = _level_sql("lang", ["domain"], """
      SELECT domain, lang, sum(supply) AS supply, any_value(budget) AS budget FROM leaves JOIN top USING (domain) GROUP BY domain, lang""", mix.lang, mix.default)
    low = _level_sql("source", ["domain", "lang"], """
      SELECT domain, lang, source, supply, budget FROM leaves JOIN middle USING (domain, lang)""", mix.source, mix.default)
    return f"""
WITH named AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens,
    regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) AS digits
  FROM documents
), counted AS (
  SELECT doc_id, CASE WHEN digits = '' THEN 'other' ELSE 'domain' || (cast(digits AS bigint) % 4) END AS domain, lang, source, n_tokens
  FROM named WHERE n_tokens > 0
), leaves AS (
  SELECT domain, lang, source, sum(n_tokens) AS tokens, sum(n_tokens) * {mix.epochs} AS supply FROM counted GROUP BY ALL
), top AS ({top}
), middle AS ({middle}
), low AS ({low}
), plan AS (
  SELECT domain, lang, source, budget // tokens AS n_epochs, budget % tokens AS rest FROM leaves JOIN low USING (domain, lang, source)
), placed AS (
  SELECT *, md5('{mix.seed}:' || (n_epochs + 1) || ':' || coalesce(cast(doc_id AS varchar), '')) AS place
  FROM counted JOIN plan USING (domain, lang, source)
), running AS (
  SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id, n_tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM placed
), used AS (
  SELECT *, greatest(0, least(n_tokens, rest - before)) AS n_prefix FROM running
)
SELECT doc_id, domain, lang, source, cast(n_tokens AS bigint) AS n_tokens, cast(n_epochs AS bigint) AS n_epochs,
  cast(n_prefix AS bigint) AS n_prefix, cast(n_epochs * n_tokens + n_prefix AS bigint) AS n_used
FROM used WHERE n_epochs * n_tokens + n_prefix > 0
"""
