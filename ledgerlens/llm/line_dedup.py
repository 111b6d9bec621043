"""Line dedup: repeated runs of lines, found by prefix doubling over line numbers.

Lines with words are numbered; one that occurs once ends every repeated run, so only the others go on.
Each round joins the rank of the 2**j lines from a place with that of the 2**j lines after them, and
ranks the pairs that occur more than once by a distributed sort: the suffix order to twice the depth. A run
counts from MIN_WORDS words on, so no more than MIN_WORDS lines are ever compared and log2(MIN_WORDS)
rounds complete the order.

At each place the shortest run from it, and the one up to it, that has MIN_WORDS words is a prefix of one
interval of suffixes. All but the first place of an interval, in the order of doc_id and line, are
later copies. Their union is that of all maximal repeated runs with so many words: every line of a longer
one lies in its shortest run from the start or in the one up to that line.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.frames import fresh, q, running_totals
from ledgerlens.operators.ordering import with_row_index
from ledgerlens.storage import Scratch

MIN_WORDS = 50
WORD = r"[^\x20\x09-\x0D]+"
#: A document: repeated rows with one id and one text are the same one.
DOC = ["no_id", "doc_id", "text_key"]


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """Every line with words: its document, place k, line number, hash, and the runs that start and end at it."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(
        i.alias("at"), x.alias("line"), F.regexp_count(x, F.lit(WORD)).cast("long").alias("words")
    ))
    split = docs.select(*DOC, F.filter(lines, lambda x: x["words"] > 0).alias("lines"))
    counted = split.withColumn("upto", running_totals(F.transform("lines", lambda x: x["words"])))

    def size_from(k: Column) -> Column:
        """Lines of the shortest run from place k (0-based) with enough words."""
        start = F.get("upto", k) - F.get("lines", k)["words"]
        return F.size(F.filter(F.slice("upto", k + 1, min_words), lambda u: u - start < min_words)) + 1

    def size_to(k: Column) -> Column:
        low = F.greatest(k - min_words + 1, F.lit(0))
        part = F.slice(F.col("lines"), low + 1, k - low + 1)
        ends = F.slice(F.col("upto"), low + 1, k - low + 1)
        return F.size(F.filter(
            F.transform(part, lambda x, i: F.get("upto", k) - F.get(ends, i) + x["words"]), lambda words: words < min_words
        )) + 1

    last = F.size("lines")
    sized = F.transform(F.sequence(F.lit(0), last - 1), lambda k: F.struct(
        k.alias("k"), size_from(k).alias("from_size"), size_to(k).alias("to_size")
    ))
    rows = F.when(last > 0, F.transform(sized, lambda r: F.struct(
        r["k"].alias("k"), F.get("lines", r["k"])["at"].alias("at"), F.xxhash64(F.get("lines", r["k"])["line"]).alias("h1"),
        F.xxhash64(F.lit(1), F.get("lines", r["k"])["line"]).alias("h2"),
        F.when(r["k"] + r["from_size"] <= last, r["from_size"]).alias("from_size"),
        F.when(r["to_size"] <= r["k"] + 1, r["to_size"]).alias("to_size"),
        F.get("lines", r["k"] + r["from_size"] - 1)["at"].alias("from_end"),
        F.get("lines", r["k"] - r["to_size"] + 1)["at"].alias("to_start"),
    )))
    return counted.select(*DOC, F.explode(rows).alias("r")).select(*DOC, "r.*")


def _ranked(pairs: DataFrame, keys: list[str], scratch: Scratch, name: str) -> DataFrame:
    """DOC, k and the rank of ``keys`` in their order, of the rows whose keys occur more than once."""
    tied = pairs.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").select(*keys)
    return scratch.keep(pairs.join(with_row_index(tied, keys, "rank"), keys).select(*DOC, "k", "rank"), name)


def later_copies(docs: DataFrame, scratch: Scratch, min_words: int = MIN_WORDS) -> DataFrame:
    """(DOC, first, last): line numbers of runs that occur earlier too. ``docs``: DOC and text."""
    places = scratch.keep(_lines(docs, min_words), "lines")
    tied = places.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1").select("h1", "h2")
    # A repeated row gives each place twice; one stays.
    numbers = with_row_index(tied, ["h1", "h2"], "rank")
    base = scratch.keep(
        places.join(numbers, ["h1", "h2"]).dropDuplicates([*DOC, "k"]).drop("h1", "h2"), "tied"
    )
    scratch.drop("lines")
    runs = base.filter("from_size IS NOT NULL").select(
        *DOC, "k", F.col("from_size").alias("size"), F.col("at").alias("first"), F.col("from_end").alias("last")
    ).unionByName(base.filter("to_size IS NOT NULL").select(
        *DOC, (F.col("k") - F.col("to_size") + 1).alias("k"), F.col("to_size").alias("size"), F.col("to_start").alias("first"),
        F.col("at").alias("last"),
    )).distinct()
    runs = scratch.keep(runs.withColumn("level", F.floor(F.log2("size") + 1e-9).cast("int")), "runs")
    level = scratch.keep(base.select(*DOC, "k", "rank"), "level-0")
    scratch.drop("tied")
    found = []
    depth = int(math.log2(min_words))
    for j in range(depth + 1):
        here = runs.filter(F.col("level") == j)
        start = level.select(*[F.col(c).alias(f"s_{c}") for c in DOC], F.col("k").alias("s_k"), F.col("rank").alias("r1"))
        end = level.select(*[F.col(c).alias(f"e_{c}") for c in DOC], F.col("k").alias("e_k"), F.col("rank").alias("r2"))
        classed = here.join(start, _same("s_") & (F.col("k") == F.col("s_k"))).join(
            end, _same("e_") & (F.col("k") + F.col("size") - (1 << j) == F.col("e_k"))
        ).select(*DOC, "k", "size", "first", "last", "r1", "r2")
        place = F.struct(*DOC, "k")
        earliest = classed.groupBy("size", "r1", "r2").agg(F.min(place).alias("low"), F.count("*").alias("n")).filter("n > 1")
        copies = classed.join(earliest.select("size", "r1", "r2", "low"), ["size", "r1", "r2"]).filter(place > F.col("low"))
        found.append(scratch.keep(copies.select(*DOC, "first", "last"), f"copies-{j}"))
        if j == depth:
            break
        after = level.select(
            *[F.col(c).alias(f"e_{c}") for c in DOC], (F.col("k") - (1 << j)).alias("e_k"), F.col("rank").alias("r2")
        )
        pairs = level.withColumnRenamed("rank", "r1").join(after, _same("e_") & (F.col("k") == F.col("e_k"))).select(*DOC, "k", "r1", "r2")
        level = _ranked(pairs, ["r1", "r2"], scratch, f"level-{j + 1}")
        scratch.drop(f"level-{j}")
    scratch.drop("runs", f"level-{depth}")
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    return every


def _same(prefix: str) -> Column:
    out = F.col("doc_id").eqNullSafe(F.col(f"{prefix}doc_id"))
    return out & (F.col("text_key") == F.col(f"{prefix}text_key"))


def deduplicated(
    docs: DataFrame, min_words: int = MIN_WORDS, id_column: str = "doc_id", text_column: str = "text", into: str = "line_dedup"
) -> DataFrame:
    """``docs`` with a struct column ``into``: text (without later copies), n_lines, n_deleted, n_runs.

    A repeated run of ``min_words`` words or more stays where it comes first, by id (nulls last, then a hash of
    the text) and line, within a document too; blank lines inside a deleted run go with it. Lines end at
    \\n. Null texts stay null and empty ones empty. Rows with the same id and the same text are one document:
    none is a copy of the other and both have the same result. Rows and other columns stay as they are; one named ``into``
    is replaced.
    """
    scratch = Scratch(docs.sparkSession, "line-dedup")
    identity = {"no_id": q(id_column).isNull(), "doc_id": q(id_column), "text_key": F.xxhash64(q(text_column))}
    keyed = docs.select(*[c.alias(n) for n, c in identity.items()], q(text_column).alias("text"))
    copies = later_copies(keyed, scratch, min_words)
    # Runs that touch or overlap become one; what is kept are the pieces between them.
    order = Window.partitionBy(*DOC).orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = (
        copies.withColumn("new", F.coalesce((F.col("first") > reach + 1).cast("int"), F.lit(1)))
        .withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy(*DOC, "island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    )
    per_doc = islands.groupBy(*DOC).agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs"))
    names = {c: fresh(docs, f"dedup_{c}") for c in (*DOC, "runs")}
    per_doc = scratch.keep(per_doc.select(*[F.col(c).alias(name) for c, name in names.items()]), "runs-by-doc")
    scratch.drop(*[f"copies-{j}" for j in range(int(math.log2(min_words)) + 1)])
    key = fresh(docs, "text_key")
    # Documents with copies are a share of all documents, so the texts are shuffled whatever the size.
    joined = docs.withColumn(key, identity["text_key"]).join(
        per_doc.hint("merge"), q(id_column).eqNullSafe(F.col(names["doc_id"])) & (F.col(key) == F.col(names["text_key"])), "left"
    )
    lines, runs = F.split(q(text_column), "\n"), F.col(names["runs"])
    pieces = F.transform(
        F.sequence(F.lit(0), F.size(runs)),
        lambda i: F.slice(
            lines, F.coalesce(F.get(runs, i - 1)["last"] + 2, F.lit(1)),
            F.coalesce(F.get(runs, i)["first"], F.size(lines)) - F.coalesce(F.get(runs, i - 1)["last"] + 1, F.lit(0)),
        ),
    )
    deleted = F.aggregate(runs, F.lit(0).cast("long"), lambda a, r: a + r["last"] - r["first"] + 1)
    return joined.select(
        *[q(c) for c in docs.columns if c.lower() != into.lower()],
        F.struct(
            F.when(runs.isNull(), q(text_column)).otherwise(F.array_join(F.flatten(pieces), "\n")).alias("text"),
            F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(deleted, F.lit(0)).alias("n_deleted"),
            F.coalesce(F.size(runs), F.lit(0)).cast("long").alias("n_runs"),
        ).alias(into),
    )


def cleaned(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with later copies cut out of the texts; rows that lose all their words go. Columns as they were."""
    into = fresh(docs, "line_dedup")
    made = deduplicated(docs, into=into, **options)
    text = F.col(into)["text"]
    gone = (F.col(into)["n_deleted"] > 0) & ~text.rlike(WORD)
    size = {"n_chars": F.when(F.col(into)["n_deleted"] > 0, F.length(text).cast("long")).otherwise(q("n_chars"))} if "n_chars" in docs.columns else {}
    return made.filter(~gone).withColumns({"text": text, **size}).drop(into)


SQL = """
WITH lines AS (
  SELECT doc_id, i, line, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM documents)
), w AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k,
    sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS upto
  FROM lines WHERE words > 0
), ends AS (
  SELECT a.doc_id, a.k, min(b.k) AS e FROM w a JOIN w b
    ON a.doc_id = b.doc_id AND b.k BETWEEN a.k AND a.k + 49 AND b.upto - a.upto + a.words >= 50 GROUP BY a.doc_id, a.k
  UNION
  SELECT b.doc_id, max(a.k), b.k FROM w a JOIN w b
    ON a.doc_id = b.doc_id AND a.k BETWEEN b.k - 49 AND b.k AND b.upto - a.upto + a.words >= 50 GROUP BY b.doc_id, b.k
), runs AS (
  SELECT ends.doc_id, ends.k, e, min(i) AS first, max(i) AS last, sha256(string_agg(line, chr(10) ORDER BY i)) AS body
  FROM ends JOIN w ON w.doc_id = ends.doc_id AND w.k BETWEEN ends.k AND e GROUP BY ends.doc_id, ends.k, e
), copies AS (
  SELECT doc_id, first, last FROM (
    SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, k) AS nth FROM runs
  ) WHERE nth > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS i FROM copies
), kept AS (
  SELECT doc_id, count(*) AS n_lines, count(gone.i) AS n_deleted,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE gone.i IS NULL), '') AS text
  FROM lines LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_deleted, 0) AS n_deleted, sha256(coalesce(kept.text, '')) AS text_sha256
FROM (SELECT doc_id FROM documents) LEFT JOIN kept USING (doc_id)
"""
