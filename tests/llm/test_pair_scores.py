import glob
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import pair_scores, word_pairs
from ledgerlens.storage import Scratch

WORDS = ["the", "house", "is", "near", "a", "river", "and", "people", "walk", "日本", "été", "9x"]


def shuffled_bytes(spark):
    root = spark.conf.get("spark.local.dir", None) or tempfile.gettempdir()
    return sum(os.path.getsize(f) for f in glob.glob(f"{root}/**/blockmgr-*/**/shuffle_*.data", recursive=True))


def test_a_lean_table_leaves_no_shuffle_files(spark):
    scratch = Scratch(spark, "lean")
    rows = spark.range(300_000).select((F.col("id") % 100_000).alias("k"), F.rand(1).alias("x"))
    grouped = rows.groupBy("k").agg(F.max("x").alias("x"), F.count("*").alias("n"))
    before = shuffled_bytes(spark)
    kept = scratch.keep_lean(grouped, "grouped")
    assert shuffled_bytes(spark) <= before + 1000
    assert kept.count() == 100_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


@pytest.mark.parametrize("other_word", [False, True])
def test_scores_do_not_depend_on_slices_and_shards(spark, documents, monkeypatch, other_word):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(WORDS, k=rng.randrange(1, 40))) for _ in range(60)] + ["", " \n", None]
    texts += texts[:2]
    docs = documents(list(enumerate(texts))).select("text", F.expr("CASE WHEN doc_id < 20 THEN 1 WHEN doc_id < 45 THEN 2 ELSE 0 END").alias("part"))

    def found(rows, teachers, slices):
        made = pair_scores.scores(rows, teachers, [[1, 2], [2]], Scratch(spark, "pairs"), slices, other_word)
        return {(r["a"], r["b"]): (r["n_tokens"], r["bits_0"], r["bits_1"]) for r in made.collect()}

    want = found(docs, None, 1)
    keys = docs.filter(r"text rlike '[^ \\t-\\r]'").select(word_pairs.text_key(1), word_pairs.text_key(2)).distinct().collect()
    assert set(want) == {tuple(k) for k in keys}
    monkeypatch.setattr(pair_scores, "SHARD_CHARS", 50)
    for got in (found(docs, None, 3), found(docs.withColumn("part", F.lit(0)), docs.filter("part > 0"), 3)):
        assert set(got) == set(want)
        for k, v in want.items():
            assert got[k][0] == v[0] and got[k][1:] == pytest.approx(v[1:], rel=1e-5)
