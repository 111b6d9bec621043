import hashlib
import random
import re

from ledgerlens.llm.contamination import contamination, decontaminated
from tests.llm.test_words import lower

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, lower(text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, names = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            size = min(10, len(v))
            for s in range(len(v) - size + 1) if v else ():
                for p in range(len(w) - size + 1):
                    if w[p:p + size] == v[s:s + size]:
                        hit.update(range(p, p + size))
                        names.add("" if item_id is None else str(item_id))
        joined = ",".join(sorted(names))
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(joined.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=str)


def test_hits_are_those_of_a_search_for_every_window(spark, documents):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(12)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 4, 9, 10, 11, 30])))) for i in range(30)]
    items = [(i, t if len(t.split()) > 1 else "Single" + t) for i, t in items]
    items += [(50, items[3][1]), (51, ""), (52, None), (None, "null item has some words of its own in a long passage here")]
    docs = []
    for i in range(60):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 40))]
        if i % 2:
            part = words(rng.choice(items)[1])
            cut = rng.randrange(0, 1 + len(part) // 3)
            w[3:3] = part[cut:]
        docs.append((i, rng.choice([" ", ", ", "-"]).join(w).title()))
    docs += [(100, None), (101, ""), (101, "Singlev1"), (None, items[5][1]), (5, docs[5][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert rows(contamination(documents(docs), benchmark)) == brute(docs, items)
    assert rows(contamination(documents(docs), benchmark, block_chars=40)) == brute(docs, items)


def test_matches_are_longest_and_have_places(spark, documents):
    item = " ".join(f"q{i}" for i in range(25))
    doc = "some words before " + " ".join(f"q{i}" for i in range(4, 20)) + " and after"
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    [row] = contamination(documents([(1, doc)]), benchmark).collect()
    assert [tuple(m) for m in row["matches"]] == [("7", 4, 3, 16)]
    assert row["n_hit"] == 16


def test_removal_keeps_columns_and_clean_rows(spark, documents):
    benchmark = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    docs = documents([(1, "x a b c d e f g h i j y"), (2, "a b c d e f g h i"), (3, None), (None, "")])
    kept = decontaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "3", "None"]


def test_empty_tables_and_long_texts(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert rows(contamination(documents([(1, "a b")]), none)) == [(1, 2, 0, 0, hashlib.sha256(b"").hexdigest(), False)]
    some = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert contamination(documents([]), some).count() == 0
    [row] = contamination(documents([(1, "one two three four " * 200_000)]), some).collect()
    assert (row["n_words"], row["n_hit"]) == (800_000, 600_000)
