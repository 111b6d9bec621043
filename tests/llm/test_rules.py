import random
import re
from collections import Counter

import numpy as np
import pandas as pd

from ledgerlens.llm import rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {k for i in range(len(words) - 7) if runs[tuple(words[i:i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside),
    )


def corpus(rng, n=120):
    rows = []
    for i in range(n):
        words = [rng.choice(["aé", "the", "日本", "x#y", "of", "and", "|", "😀"]) if rng.random() < 0.5 else f"w{rng.randrange(300)}" for _ in range(rng.randrange(0, 90))]
        if i % 5 == 0:
            words += words[:30] * 2
        text = " ".join(words)
        if i % 3 == 0:
            text = text.replace(" the ", "\n").replace(" of ", "\nand again\n")
        rows.append((i, text))
    return rows


def test_counts_are_those_of_the_rules(documents, labels):
    rows = corpus(random.Random(8)) + [(500, None), (501, ""), (502, "\n \n\n"), (None, "a b c"), (3, "a b"), (3, "a b")]
    got = rules.judged(documents(rows), labels([(i, 1, 0) for i in range(60)]))
    want = []
    for i, text in rows:
        n, chars, symbols, dup, repeat = brute(text)
        want.append((i, n, chars, symbols, dup, repeat, n < 20 or 100 * repeat > 30 * n))
    assert sorted((tuple(r)[:7] for r in got.collect()), key=str) == sorted(want, key=str)
    assert not any(r["kept"] and r["base_failed"] for r in got.collect())


def test_long_text_and_repeats_across_documents_do_not_count():
    text = " ".join(f"w{i}" for i in range(300_000))
    counts = rules.statistics([text, text, "a b c d e f g h a b c d e f g h"])
    assert counts["n_repeat_words"].tolist() == [0, 0, 16]


def test_labels_set_the_threshold(documents, labels):
    rng = random.Random(9)
    good = [(i, " ".join(f"word{rng.randrange(500)}" for _ in range(rng.randrange(30, 90)))) for i in range(400)]
    bad = [(1000 + i, " ".join(f"W{rng.randrange(500)}### | %%%" for _ in range(rng.randrange(30, 90)))) for i in range(25)]
    docs = documents(good + bad)
    kept = {r["doc_id"]: r["kept"] for r in rules.judged(docs, labels([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad]), reject_good=0.02).collect()}
    assert sum(not kept[i] for i, _ in good) <= 8
    assert sum(kept[i] for i, _ in bad) <= 2
    # Without good labels nothing but the base rules rejects; nulls calibrate nothing.
    free = rules.judged(docs, labels([(None, 1, 0), (1, None, None), (1000, 0, 0)])).collect()
    assert all(r["kept"] for r in free)


def test_default_threshold_catches_bad_rows(documents, labels):
    # Bad rows are many, so the forest finds them hardly stranger than the oddest good ones.
    rng = random.Random(4)
    good = [(i, " ".join("w" * rng.randrange(2, 9) + str(i) for i in rng.sample(range(500), 60))) for i in range(600)]
    odd = [(600 + i, " ".join(f"WORD{rng.randrange(9999)}!?!?-{i}-{k}" for k in range(40))) for i in range(12)]
    bad = [(1000 + i, " | ".join(f"ab{k}cd" for k in rng.sample(range(500), 60))) for i in range(60)]
    marks = labels([(i, 1, 0) for i, _ in good + odd] + [(i, 0, 0) for i, _ in bad])
    kept = {r["doc_id"]: r["kept"] for r in rules.judged(documents(good + odd + bad), marks).collect()}
    assert sum(kept[i] for i, _ in bad) <= 6
    assert sum(not kept[i] for i, _ in good + odd) <= 31


def test_bound_weighs_both_kinds():
    steps = pd.DataFrame({"score": [0.3, 0.4, 0.5, 0.6], "good": [80, 18, 1, 1], "fit_good": [80, 18, 1, 1], "fit_bad": [0, 1, 9, 0]})
    assert rules._bound(steps, None) == 0.5
    assert rules._bound(steps, 0.01) == 0.6
    assert rules._bound(steps.assign(fit_bad=0), None) > 0.6
    assert rules._bound(steps.assign(good=0, fit_good=0), None) == 2.0


def test_empty_and_constant_tables(documents, labels):
    assert rules.judged(documents([]), labels([])).count() == 0
    same = rules.judged(documents([(i, "a b c d e f g " * 3) for i in range(4)]), labels([(1, 1, 0)])).collect()
    assert len(same) == 4
    assert np.array_equal(rules.Forest(np.zeros((0, 3))).scores(np.zeros((2, 3))), [0, 0])
