import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from ledgerlens.llm import toxicity
from ledgerlens.storage import Scratch

FOLDER = "/root/testdata/sf0.1"


def test_words_and_windows_cover_the_whole_text():
    text = "One, two! " * 500 + "x" * 300
    whole = b"".join(toxicity.words(text))
    assert whole == b" ONE TWO" * 500 + b" " + b"X" * 8 + b"x" * 292
    assert max(map(len, toxicity.words(text))) <= toxicity.WORD
    parts = toxicity.windows(text)
    assert b"".join(p[:toxicity.STEP] for p in parts[:-1]) + parts[-1] == whole
    assert toxicity.words("") == toxicity.words(None) == toxicity.windows("") == toxicity.windows(None) == []


@pytest.fixture(scope="module")
def production(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    return {r["doc_id"]: r for r in toxicity.scored(docs, labels).collect()}


def test_held_out_accuracy_in_every_language(production):
    rows = duckdb.sql(
        f"SELECT doc_id, lang, toxic FROM '{FOLDER}/documents.parquet' JOIN '{FOLDER}/labels.parquet' USING (doc_id)"
    ).fetchall()
    found, caught, clean, wrong = (defaultdict(int) for _ in range(4))
    for doc_id, lang, toxic in rows:
        r = production[doc_id]
        assert r["held_out"] == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
        if r["held_out"]:
            (found if toxic else clean)[lang] += 1
            (caught if toxic else wrong)[lang] += r["predicted"]
    assert set(found) == {"en", "de", "fr", "es"}
    print({k: (caught[k], found[k], wrong[k], clean[k]) for k in found})
    for lang in found:
        assert caught[lang] >= 0.8 * found[lang], lang
        assert wrong[lang] <= 0.04 * clean[lang], lang
    assert sum(caught.values()) > 0.8 * sum(found.values())
    assert sum(wrong.values()) < 0.02 * sum(clean.values())


def test_counts_of_pieces_and_passages(spark, tmp_path):
    rows = [("bad badly bad", 1, 0), ("so bad", 1, 1), ("badge of the plain", 0, 0), ("x", 0, 1), ("x", 0, 1)]
    sample = spark.createDataFrame(rows, "text string, toxic int, half int")
    made = sample.mapInPandas(toxicity._piece_counts, "piece binary, half int, toxic int, n long, rows long").collect()
    want, docs = Counter(), Counter()
    for text, toxic, half in rows:
        inside = [p for w in toxicity.words(text) for size in toxicity.PIECES for p in (w[i:i + size] for i in range(len(w) - size + 1))]
        want.update((p, half, toxic) for p in inside)
        docs.update((p, half, toxic) for p in set(inside))
    got, got_docs = Counter(), Counter()
    for r in made:
        got[bytes(r["piece"]), r["half"], r["toxic"]] += r["n"]
        got_docs[bytes(r["piece"]), r["half"], r["toxic"]] += r["rows"]
    assert got == want and got_docs == docs
    assert toxicity.passage(b" BADLY", {b" BADL"}) == b" BADL"
    assert toxicity.passage(b" A WORDISH", {b" WORD", b"ORDIS"}) == b" WORDIS"
    assert toxicity.passage(b" FINE", {b" BADL"}) == b""


def test_scored_rows(documents, labels):
    rows = [(i, ("plain words of ordinary talk number %d " % (i % 7)) * 20 + ("you despicable contemptible wretchedness " if i % 4 == 0 else "")) for i in range(200)]
    rows += [(900, None), (901, ""), (None, rows[0][1]), (3, rows[4][1]), (902, "x" * 200_000), (903, "plain words " * 50_000)]
    marks = labels([(i, 1, int(i % 4 == 0)) for i in range(200)] + [(None, 1, 1), (900, 1, None), (5, 1, 1)])
    got = toxicity.scored(documents(rows), marks).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (r["doc_id"] is not None and toxicity.held_out(r["doc_id"]))
    empty = {r["score"] for r in got if r["doc_id"] in (900, 901)}
    assert len(empty) == 1 and max(empty) < 0.3
    told = {r["doc_id"]: r["predicted"] for r in got if r["doc_id"] is not None and 10 <= r["doc_id"] < 200 and r["held_out"]}
    assert told == {i: int(i % 4 == 0) for i in told} and told
    assert not any(r["predicted"] for r in got if r["doc_id"] in (902, 903))


def test_one_kind_of_label_and_empty_tables(documents, labels):
    got = toxicity.scored(documents([(1, "a b c"), (2, None)]), labels([(1, 1, 0)])).collect()
    assert {r["predicted"] for r in got} == {0}
    assert toxicity.scored(documents([]), labels([])).count() == 0


def test_ordinary_windows_come_from_all_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "TRAIN_WINDOWS", 100)
    monkeypatch.setattr(toxicity, "_trained", lambda samples, size: seen.append(samples) or b" " * 8)
    rows = [("bad words here", 1, 0), ("bad words here", 1, 1)] + [(f"row{i} text", 0, i % 2) for i in range(1000)]
    scratch = Scratch(spark, "toxicity-test")
    sample = scratch.keep(spark.createDataFrame(rows, "text string, toxic int, half int"), "sample")
    toxicity.fitted(sample, {(1, 0): 1, (1, 1): 1, (0, 0): 500, (0, 1): 500}, scratch)
    numbers = [int(w.split()[0][3:]) for w in seen[2]]
    assert len(numbers) == 100
    assert min(sum(r // 250 == k for r in numbers) for k in range(4)) >= 10
    assert sorted(seen[0] + seen[1]) == sorted(seen[2])
