"""Quality classifier: perplexity under Kneser-Ney models of trusted text.

Two kinds of model are fitted on all documents labelled good: character trigrams, and word pairs (``words.tokens``),
which see repeated words and characters that the trigrams' alphabet has no room for. Most pairs are rare, so a text is
scored by the pairs of the half of these documents that it cannot be in. Trigrams are few and sent to tasks; pairs are
counted and met by the documents' own in shards (``pair_scores``). Every document is scored;
all labelled good rows then set, for each language, the costs that a share ``reject_good`` of them exceeds, half by
each model. Documents above a bound of their language are rejected.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm import ngrams, pair_scores, word_pairs
from ledgerlens.llm.frames import by_text, fresh, q
from ledgerlens.llm.word_model import Model
from ledgerlens.storage import Scratch

REJECT_GOOD = 0.005
#: Characters at the trusted text's mean cost that every document is taken to begin with.
PRIOR_CHARS = 64
#: Tokens likewise.
PRIOR_TOKENS = 12
#: Parts in which word pairs are moved; all texts are read once for each, those labelled good once more.
SLICES = 5
STEPS_PER_BIT = 1000
KINDS = ("bits_per_char", "bits_per_token")


class Packed:
    """A pickled model that the driver hands on unopened; where it is unpickled it is the model."""

    def __init__(self, blob: bytes):
        self.blob = blob

    def __reduce__(self):
        return pickle.loads, (self.blob,)


def word_models(counted: DataFrame) -> list[Packed]:
    """The word pair models of the two halves of a small text, whole, each fitted in one task; ``counted``: a stored table of
    ``word_pairs.counts``, in which the second half is chosen. Without pairs in one of the halves both models are of
    the whole text. The classifier finds the same costs by shards (``pair_scores``); its tests compare the two."""
    def fit(part: pd.DataFrame) -> pd.DataFrame:
        model = Model.fitted(*(part[c].to_numpy().view(np.uint64) for c in ("v", "w")), part["n"].to_numpy())
        return pd.DataFrame({"half": part["half"].iloc[:1], "model": [pickle.dumps(model)]})

    def fitted(*counts: Column) -> list[Packed]:
        each = F.explode(F.array(*[F.struct(F.lit(k).alias("half"), n.cast("int").alias("n")) for k, n in enumerate(counts)]))
        rows = counted.select("v", "w", each.alias("each")).select("v", "w", "each.*").filter("n > 0")
        made = rows.groupBy("half").applyInPandas(fit, "half int, model binary").toPandas().sort_values("half")
        return [Packed(bytes(blob)) for blob in made["model"]]

    models = fitted(F.col("n_0") - F.col("n_1"), F.col("n_1"))
    if len(models) < 2:
        none = np.empty(0, np.uint64)
        models = (fitted(F.col("n_0")) or [Packed(pickle.dumps(Model.fitted(none, none, np.empty(0, np.int64))))]) * 2
    return models


def scorer(docs: DataFrame, labels: DataFrame, into: str) -> tuple[Callable[[DataFrame], DataFrame], DataFrame]:
    """Fits the models and scores every text of ``docs``. Returns a function that adds to rows of ``docs`` a struct column
    ``into``: characters and tokens, and bits per each, rounded to a thousandth; and doc_id, lang and that column
    of all rows labelled good."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    # Stored, so that Spark knows their size before it decides whether a join has to move the texts.
    good = scratch.keep_lean(labels.filter("quality = 1").filter("doc_id IS NOT NULL").select("doc_id").distinct(), "ids")
    # Half of the texts are moved at a time.
    each = [docs.select("doc_id", "lang", "text").filter(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == k) for k in (0, 1)]
    trusted = reduce(DataFrame.unionByName, [
        scratch.keep_lean(rows.join(good, "doc_id", "left_semi"), f"trusted-{k}") for k, rows in enumerate(each)
    ])
    letters = ngrams.alphabet(trusted)
    model = ngrams.costs(scratch.keep_lean(ngrams.counts(trusted, letters), "counts"))
    half = F.coalesce(F.crc32(F.col("text").cast("binary")) % 2 == 1, F.lit(False))
    part = F.when(half, 2).otherwise(1)
    teaching = trusted.select("text", part.alias("part"))
    both = teaching.filter(F.col("text").rlike(r"[^ \t-\r]")).select("part").distinct().count() == 2
    words = pair_scores.scores(
        docs.select("text", F.lit(0).alias("part")), teaching, [[1], [2]] if both else [[1, 2], [1, 2]], scratch, SLICES, other_word=True
    )
    shared = spark.sparkContext.broadcast((ngrams.numbering(letters), model))
    letter = by_text(lambda texts: ngrams.bits(texts, shared.value[0], [shared.value[1]]), "n long, bits_0 double")

    def costs(rows: DataFrame) -> DataFrame:
        """``rows`` with a struct column ``into``: n, bits, tokens, token_bits."""
        letters_, chosen, a, b, a_, b_, t = (fresh(rows, x) for x in ("letters", "chosen", "a", "b", "a_", "b_", "t"))
        keyed = rows.select(
            "*", letter(q("text")).alias(letters_), half.alias(chosen), word_pairs.text_key(1).alias(a), word_pairs.text_key(2).alias(b)
        )
        own = words.select(F.col("a").alias(a_), F.col("b").alias(b_), F.struct("n_tokens", "bits_0", "bits_1").alias(t))
        # A text is scored by the pairs of the half that it is not in.
        bits = F.when(q(chosen), q(t)["bits_0"]).otherwise(q(t)["bits_1"])
        return keyed.join(own, (q(a) == q(a_)) & (q(b) == q(b_)), "left").select(
            *[q(c) for c in rows.columns],
            F.struct(
                q(letters_)["n"].alias("n"), q(letters_)["bits_0"].alias("bits"),
                F.coalesce(q(t)["n_tokens"], F.lit(0).cast("long")).alias("tokens"), F.coalesce(bits, F.lit(0.0)).alias("token_bits"),
            ).alias(into),
        )

    def rounded(rows: DataFrame) -> DataFrame:
        s = F.col(into)
        each = (s["bits"] + PRIOR_CHARS * usual) / (s["n"] + PRIOR_CHARS)
        token = (s["token_bits"] + PRIOR_TOKENS * usual_token) / (s["tokens"] + PRIOR_TOKENS)
        return rows.withColumn(into, F.struct(
            s["n"].alias("n_chars"), (F.rint(each * STEPS_PER_BIT) / STEPS_PER_BIT).alias("bits_per_char"),
            s["tokens"].alias("n_tokens"), (F.rint(token * STEPS_PER_BIT) / STEPS_PER_BIT).alias("bits_per_token"),
        ))

    own = scratch.keep_lean(costs(trusted).drop("text"), "good")
    scratch.drop("trusted-0", "trusted-1", "counts", "ids")
    sums = own.agg(*[F.sum(F.col(into)[c]).alias(c) for c in ("n", "bits", "tokens", "token_bits")]).first()
    usual = sums["bits"] / sums["n"] if sums["n"] else 0.0
    usual_token = sums["token_bits"] / sums["tokens"] if sums["tokens"] else 0.0
    return lambda rows: rounded(costs(rows)), rounded(own)


def bounds(scores: DataFrame, labels: DataFrame, reject_good: float = REJECT_GOOD) -> dict[str, tuple[dict[str, float], float]]:
    """By kind of score: of each language with good rows, and of all rows, the largest accepted score.

    ``scores``: doc_id, lang, kind, score. Scores are multiples of 1/STEPS_PER_BIT, so one row per kind, language and
    step is all that is ever put in order.
    """
    good = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("g"))
        .filter("g = 1").select("doc_id")
    )
    steps = scores.join(good, "doc_id", "left_semi").groupBy("kind", "lang", "score").agg(F.count("*").alias("n"))
    every = steps.unionByName(
        steps.groupBy("kind", "score").agg(F.sum("n").alias("n")).withColumn("lang", F.lit("\0"))
    ).filter("lang IS NOT NULL")
    part = Window.partitionBy("kind", "lang")
    ranked = every.select(
        "kind", "lang", "score", F.sum("n").over(part.orderBy("score")).alias("up_to"), F.sum("n").over(part).alias("good")
    )
    found = (
        ranked.filter(F.col("up_to") >= (1 - reject_good) * F.col("good"))
        .groupBy("kind", "lang").agg(F.min("score").alias("bound")).collect()
    )
    out = {}
    for kind in KINDS:
        by_language = {r["lang"]: r["bound"] for r in found if r["kind"] == kind}
        out[kind] = by_language, by_language.pop("\0", float("inf"))
    return out


def _bound(by_language: dict[str, float], overall: float) -> Column:
    if not by_language:
        return F.lit(overall)
    pairs = [x for k, v in by_language.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.create_map(*pairs)[F.col("lang")], F.lit(overall))


def classified(
    docs: DataFrame, labels: DataFrame, into: str = "quality", reject_good: float = REJECT_GOOD
) -> DataFrame:
    """``docs`` with a struct column ``into``: n_chars, bits_per_char, perplexity, bound, kept, n_tokens,
    bits_per_token, token_bound. ``perplexity`` and ``bound`` are of characters.

    A language without good rows, and a null one, has the bound of all good rows together; without
    any good rows nothing is rejected for its perplexity. Null and empty texts are rejected: there is no text to
    keep. Repeated ids are scored row by row; an id is good if all its labels say so. Other columns
    of ``docs`` stay as they are; one named ``into`` is replaced. An empty table gives no rows.
    """
    made = fresh(docs, "made")
    add, good = scorer(docs, labels, made)
    with_scores = add(docs)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(made)[k].alias("score")) for k in KINDS]))
    scores = good.select("doc_id", "lang", each.alias("each")).select("doc_id", "lang", "each.*")
    found = bounds(scores, labels, reject_good / len(KINDS))
    bound, token_bound = (_bound(*found[k]) for k in KINDS)
    n, cost, token_cost = F.col(made)["n_chars"], *(F.col(made)[k] for k in KINDS)
    return with_scores.select(
        *[q(c) for c in docs.columns if c.lower() != into.lower()],
        F.struct(
            n.alias("n_chars"), cost.alias("bits_per_char"), F.pow(F.lit(2.0), cost).alias("perplexity"), bound.alias("bound"),
            ((n > 0) & (cost <= bound) & (token_cost <= token_bound)).alias("kept"),
            F.col(made)["n_tokens"].alias("n_tokens"), token_cost.alias("bits_per_token"), token_bound.alias("token_bound"),
        ).alias(into),
    )


def kept(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the classifier accepts, columns as they were."""
    into = fresh(docs, "quality")
    return classified(docs, labels, into, **options).filter(F.col(into)["kept"]).drop(into)
