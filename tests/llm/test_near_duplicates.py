import random
import re

import numpy as np

from ledgerlens.llm.near_duplicates import BITS, minima, near_duplicates, one_of_each, shingle_sets
from tests.llm.test_words import lower


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """(n_shingles, component) of each row by comparing all rows."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i in range(len(rows)):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((rows[i][0], len(sets[i]), min(ids) if ids else None))
    return out


def corpus(rng, groups=25):
    rows, number = [], 0
    for _ in range(groups):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(30, 200))]
        for _ in range(rng.randrange(1, 9)):
            copy = list(words)
            for _ in range(rng.randrange(0, 1 + len(words) // 15)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            number += 1
            rows.append((number, " ".join(copy)))
    rng.shuffle(rows)
    return rows


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def test_components_are_those_of_comparing_all_pairs(documents):
    rows = corpus(random.Random(3))
    rows += [(900, "one two"), (901, "One  two"), (902, "two one"), (903, ""), (904, None), (905, " \n"), (906, "a b c d e"), (None, "a B c d e")]
    got = near_duplicates(documents(rows))
    assert result(got) == sorted(brute(rows), key=str)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.collect())


def test_bridges_between_documents_that_are_not_alike(documents):
    # Each text shares nine tenths with the next; the ends share little.
    words = [f"w{i}" for i in range(200)]
    rows = [(100 - k, " ".join(words[:k * 8] and [f"z{i}" for i in range(k * 8)] + words[k * 8:])) for k in range(10)]
    rows = [(i, t or " ".join(words)) for i, t in rows]
    assert {c for _, _, c in result(near_duplicates(documents(rows)))} == {91}
    assert result(near_duplicates(documents(rows))) == sorted(brute(rows), key=str)


def test_repeated_rows_null_ids_and_one_of_each(documents):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(2, text), (2, text), (5, text + " end"), (None, text), (None, "other words only here now"), (7, None), (7, "short")]
    docs = documents(rows)
    got = one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in got.select("doc_id", "text").na.fill({"doc_id": -1, "text": ""}).collect()) == sorted(
        [(2, text), (2, text), (-1, "other words only here now"), (7, ""), (7, "short")]
    )


def test_empty_table(documents):
    assert near_duplicates(documents([])).count() == 0
    assert one_of_each(documents([(1, None)])).count() == 1


def test_long_text_and_estimate_of_the_signature():
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(60000)]
    changed = [w if rng.random() > 0.03 else "changed" + w for w in words]
    a, b = (shingle_sets([" ".join(x)])[0] for x in (words, changed))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    low = (1 << BITS) - 1
    same = ((minima(a) >> 3 & low) == (minima(b) >> 3 & low)).mean()
    assert abs((same - 2.0**-BITS) / (1 - 2.0**-BITS) - true) < 0.17
