import random
import re

import numpy as np

from ledgerlens.llm.words import BLANK, LOWER, NOT_ALNUM, SAME, chunks, split, windows


def lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text)


def sample(rng, n):
    return "".join(rng.choice("aBz09 \t\n\x0b\r.,-é日😀\x00\x7f_%") for _ in range(n))


def test_words_are_those_of_the_patterns():
    rng = random.Random(1)
    texts = [None, "", " ", *[sample(rng, rng.randrange(1, 300)) for _ in range(60)]]
    for separator, pattern, table in (
        (BLANK, r"[^\x20\x09-\x0D]+", LOWER), (NOT_ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", LOWER), (BLANK, r"[^\x20\x09-\x0D]+", SAME),
    ):
        found = split(texts, separator, table)
        for i, text in enumerate(texts):
            want = re.findall(pattern, (lower(text) if table == LOWER else text) if text else "")
            a, b = found.first[i], found.first[i + 1]
            got = [bytes(found.data[s:e]).decode() for s, e in zip(found.starts[a:b], found.ends[a:b])]
            assert got == want


def test_hashes_tell_words_apart_and_do_not_depend_on_the_place():
    found = split(["ab ba ab", "xx ab", "a" * 70000 + " " + "a" * 70001 + " ab"], BLANK)
    h = found.hashes.tolist()
    assert h[0] == h[2] == h[4] == h[7]
    assert len(set(h)) == 5


def test_windows_differ_by_order():
    h = split(["a b c a b c b a c"], BLANK).hashes
    w = windows(h, 3)
    assert w[0] == w[3] and len(set(w.tolist())) == 6
    assert len(windows(h[:2], 3)) == 0


def test_no_texts_and_chunks():
    assert len(split([], BLANK).first) == 1
    assert list(chunks(["aa", None, "b" * 10, "c"], 5)) == [(0, 3), (3, 4)]
    assert list(chunks([])) == []
    assert np.array_equal(split([None, "a"], BLANK).first, [0, 0, 1])
