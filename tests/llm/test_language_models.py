import math
import random
from collections import Counter

import numpy as np
import pytest

from ledgerlens.llm import domain_scores, ngrams, quality, words


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


EN = ["the", "house", "is", "near", "a", "river", "and", "people", "walk", "there", "every", "day"]
XX = ["qxz", "zzq", "xqv", "vvx", "#%#", "||", "ZQ9"]


@pytest.fixture
def rows():
    rng = random.Random(1)
    good = [(i, prose(rng, rng.randrange(10, 80), EN), "en", "src1") for i in range(300)]
    bad = [(1000 + i, prose(rng, 40, XX), "en", "src1") for i in range(20)]
    return good + bad


def test_probabilities_add_up_and_follow_kneser_ney(spark, documents, rows):
    docs = documents(rows)
    letters = ngrams.alphabet(docs)
    counted = ngrams.counts(docs, letters).cache()
    cost = ngrams.costs(counted).reshape((ngrams.SYMBOLS,) * 3)
    assert np.allclose((2.0 ** -cost.astype(float)).sum(axis=2), 1, atol=1e-4)
    n = {(r["u"], r["v"], r["w"]): r["n"] for r in counted.collect()}
    # The formula written out for every seen trigram.
    from collections import Counter
    pairs = Counter((v, w) for _, v, w in n)
    singles = Counter(w for _, w in pairs)

    def discounts(table):
        c = Counter(table.values())
        y = c[1] / (c[1] + 2 * c[2]) if c[1] else 0
        raw = [1 - 2 * y * c[2] / c[1] if c[1] else 0.5, 2 - 3 * y * c[3] / c[2] if c[2] else 1.0, 3 - 4 * y * c[4] / c[3] if c[3] else 1.5]
        return [min(max(d, 0.1), i + 0.9) for i, d in enumerate(raw)]

    def share(table, context_of, key, lower):
        d = discounts(table)
        own = [k for k in table if context_of(k) == context_of(key)]
        total = sum(table[k] for k in own)
        off = lambda k: d[min(table[k], 3) - 1]
        return (table[key] - off(key)) / total + sum(map(off, own)) / total * lower

    for u, v, w in list(n)[:40]:
        p1 = share(singles, lambda k: 0, w, 1 / ngrams.SYMBOLS)
        p2 = share(pairs, lambda k: k[0], (v, w), p1)
        p3 = share(n, lambda k: k[:2], (u, v, w), p2)
        assert cost[u, v, w] == pytest.approx(-np.log2(p3), abs=1e-3)


def test_counts_are_those_of_a_plain_loop(documents):
    texts = ["abca", "", None, "日ab😀", "a"]
    letters = ngrams.alphabet(documents(list(enumerate(texts))))
    table = ngrams.numbering(letters)
    found, offsets = ngrams.trigrams(texts, table)
    want = []
    for t in texts:
        ids = [ngrams.BEFORE] * 2 + [int(table[ord(c)]) for c in t or ""]
        want += [(ids[i] * 128 + ids[i + 1]) * 128 + ids[i + 2] for i in range(len(ids) - 2)]
    assert found.tolist() == want
    assert offsets.tolist() == [0, 4, 4, 4, 8, 9]


def test_classifier_keeps_good_and_rejects_bad(documents, labels, rows):
    docs = documents([*rows, (5000, None, "en", "s"), (5001, "", None, None), (None, rows[0][1], "xx", "s"), (5002, rows[1][1], None, None), (3, rows[3][1], "en", "s")])
    marks = labels([(i, int(i < 1000), 0) for i, *_ in rows if i is not None] + [(None, 1, 0), (7, None, None)])
    made = quality.classified(docs, marks).collect()
    assert len(made) == len(rows) + 5
    kept = {r["doc_id"]: r["quality"]["kept"] for r in made}
    assert sum(not kept[i] for i in range(300) if i != 3) <= 3
    assert not any(kept[1000 + i] for i in range(20))
    assert not kept[5000] and not kept[5001] and kept[5002] and kept[None]
    assert quality.kept(docs, marks).columns == docs.columns


def test_no_labels_reject_nothing_but_empty_texts(documents, labels):
    made = quality.classified(documents([(1, "abc"), (2, None)]), labels([])).collect()
    assert {r["doc_id"]: r["quality"]["kept"] for r in made} == {1: True, 2: False}
    assert quality.classified(documents([]), labels([(1, 1, 0)])).count() == 0


def test_difference_prefers_the_target(documents, labels, rows):
    docs = documents([*rows, (9000, None, "en", "s"), (9001, "x" * 300_000, "en", "s")])
    got = domain_scores.cross_entropy_difference(docs, labels([(i, 0, int(i >= 1000)) for i, *_ in rows]), "toxic = 1").collect()
    score = {r["doc_id"]: r["difference"] for r in got}
    assert len(got) == len(rows) + 2
    assert max(score[1000 + i] for i in range(20)) < 0 < min(score[i] for i in range(300))
    assert score[9000] == 0
    assert domain_scores.cross_entropy_difference(documents([]), labels([])).count() == 0


def test_tokens_are_words_marks_and_characters_without_blanks():
    def same(text, parts):
        got, first = words.tokens([text])
        return got.tolist() == np.concatenate([words.tokens([p])[0] for p in parts]).tolist() and first.tolist() == [0, len(parts)]

    assert same("The the,été 9x||\n日本ab語 กข 😀я", ["The", "the", ",", "été", "9x", "|", "|", "日", "本", "ab", "語", "ก", "ข", "😀", "я"])
    assert [len(words.tokens(x)[0]) for x in ([], [None], ["", " \n"])] == [0, 0, 0]
    assert words.tokens(["a b", None, "", "日 c"])[1].tolist() == [0, 2, 2, 2, 4]


def plain_bits(texts, train):
    """Bits per token of each text under a word pair model of ``train``, by the formula; the vocabulary is that of all texts."""
    def off(table):
        c = Counter(table.values())
        y = c[1] / (c[1] + 2 * c[2]) if c[1] else 0
        raw = [1 - 2 * y * c[2] / c[1] if c[1] else 0.5, 2 - 3 * y * c[3] / c[2] if c[2] else 1.0, 3 - 4 * y * c[4] / c[3] if c[3] else 1.5]
        return [0.0, *(min(max(d, 0.1), i + 0.9) for i, d in enumerate(raw))]

    split = lambda t: list(zip(["", *t.split()], t.split()))
    n = Counter(p for t in train for p in split(t))
    k, size = Counter(w for _, w in n), len({w for t in texts for w in t.split()})
    d1, d2 = off(k), off(n)
    total, rest = Counter(), Counter()
    for (v, _), c in n.items():
        total[v] += c
        rest[v] += d2[min(c, 3)]
    def p(v, w):  # noqa: E306
        one = (k[w] - d1[min(k[w], 3)] + sum(d1[min(c, 3)] for c in k.values()) / size) / sum(k.values()) if k else 1 / size
        return (n[v, w] - d2[min(n[v, w], 3)] + rest[v] * one) / total[v] if total[v] else one
    return [sum(-math.log2(p(*x)) for x in split(t)) / max(1, len(t.split())) for t in texts]


def test_scores_follow_the_formula_and_every_character_counts(documents, labels):
    # 400 Chinese characters and 300 words: more than any fixed alphabet of 128 holds.
    rng = random.Random(3)
    han = [chr(0x4E00 + i) for i in range(400)]
    texts = [" ".join(rng.choice(han[:200] if i % 2 else han) for _ in range(rng.randrange(5, 60))) for i in range(60)]
    texts += [" ".join(f"w{rng.randrange(300) // (1 + i % 3)}" for _ in range(40)) for i in range(60)]
    texts += [texts[3], texts[70], ""]
    marks = labels([(i, int(i % 2), 0) for i in range(100)] + [(None, 1, 0)])
    got = {r["doc_id"]: r for r in domain_scores.cross_entropy_difference(documents(list(enumerate(texts))), marks).collect()}
    target = plain_bits(texts, [t for i, t in enumerate(texts) if i < 100 and i % 2])
    background = plain_bits(texts, texts)
    assert [got[i]["n_tokens"] for i in range(len(texts))] == [len(t.split()) for t in texts]
    for i in range(len(texts)):
        assert got[i]["target_bits"] == pytest.approx(target[i], abs=1e-4)
        assert got[i]["background_bits"] == pytest.approx(background[i], abs=1e-4)
    # Without blanks between them the characters are the same tokens.
    tight = [(i, t.replace(" ", "") if i < 60 else t) for i, t in enumerate(texts)]
    same = {r["doc_id"]: r["difference"] for r in domain_scores.cross_entropy_difference(documents(tight), marks).collect()}
    assert all(same[i] == pytest.approx(got[i]["difference"], abs=1e-6) for i in same)


def test_every_target_row_counts(documents, labels):
    # More target rows than any former sample; each has a word of its own, which only its own text can have taught.
    rows = [(i, f"word{i} word{i}") for i in range(10_400)] + [(20_000 + i, f"other{i} other{i}") for i in range(400)]
    got = domain_scores.cross_entropy_difference(documents(rows), labels([(i, 1, 0) for i in range(10_400)])).collect()
    score = {r["doc_id"]: r["difference"] for r in got}
    assert max(score[i] for i in range(10_400)) < 0 < min(score[20_000 + i] for i in range(400))


def test_classifier_sees_the_order_of_words(documents, labels):
    rng = random.Random(6)
    # All words begin and end alike, so the character trigrams of any order of them are the same.
    some = ["ab" + "".join(rng.choices("cdefgh", k=5)) + "yz" for _ in range(80)]
    good = [(i, " ".join(some[j] + " " + some[j + 1] for j in rng.choices(range(0, 80, 2), k=40))) for i in range(400)]
    bad = [(1000 + i, " ".join(rng.choices(some, k=80))) for i in range(40)] + [(1100, "abcdefgyz " * 60), (1101, (some[0] + " ") * 60)]
    made = quality.classified(documents(good + bad), labels([(i, 1, 0) for i, *_ in good])).collect()
    kept = {r["doc_id"]: r["quality"]["kept"] for r in made}
    assert not any(kept[i] for i, *_ in bad)
    assert sum(not kept[i] for i, *_ in good) <= 2


def test_small_language_has_its_own_bound(documents, labels):
    rng = random.Random(2)
    common = [(i, prose(rng, 60, EN), "en", "s") for i in range(400)]
    rare = [(1000 + i, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=300)), "xx", "s") for i in range(9)]
    other = [(2000, rare[0][1], "yy", "s"), (2001, rare[1][1], None, "s")]
    marks = labels([(i, 1, 0) for i, *_ in common + rare])
    made = {r["doc_id"]: (r["lang"], r["quality"]) for r in quality.classified(documents(common + rare + other), marks).collect()}
    # The largest of few scores is the quantile, so no good row of a small language is rejected; it may be held to nobody else's bound.
    assert all(made[i][1]["kept"] for i, *_ in rare)
    assert made[1000][1]["bound"] == max(made[i][1]["bits_per_char"] for i, *_ in rare)
    assert made[2000][1]["bound"] == made[2001][1]["bound"] != made[1000][1]["bound"] != made[0][1]["bound"]


def test_word_models_fitted_in_tasks_equal_local_ones(spark):
    import pickle

    import numpy as np

    from ledgerlens.llm.quality import word_models
    from ledgerlens.llm.word_model import Model

    rows = [(v, w, 1 + (v * w) % 5, (v + w) % 2) for v in range(-6, 6) for w in range(-4, 9)]
    schema = "v long, w long, n_0 long, n_1 long"
    got = [pickle.loads(pickle.dumps(m)) for m in word_models(spark.createDataFrame(rows, schema))]
    for k, m in enumerate(got):
        part = [(v, w, n1 if k else n0 - n1) for v, w, n0, n1 in rows if (n1 if k else n0 - n1)]
        v, w, n = (np.array(c, np.int64) for c in zip(*part))
        want = Model.fitted(v.view(np.uint64), w.view(np.uint64), n)
        assert (m.codes == want.codes).all() and (m.words == want.words).all()
        assert np.allclose(m.chances, want.chances) and np.allclose(m.alone, want.alone) and np.allclose(m.rest, want.rest)
    whole = [(v, w, n, 0) for v, w, n, _ in rows]
    one, two = (pickle.loads(pickle.dumps(m)) for m in word_models(spark.createDataFrame(whole, schema)))
    assert len(one.codes) == len(two.codes) == len(rows)
    empty = [pickle.loads(pickle.dumps(m)) for m in word_models(spark.createDataFrame([], schema))]
    assert [len(m.codes) for m in empty] == [0, 0]


def test_open_costs_equal_the_models_of_both_halves(spark, documents):
    import pickle

    from ledgerlens.llm import word_pairs
    from ledgerlens.storage import Scratch
    from pyspark.sql import functions as F

    rng = random.Random(8)
    train = [(i, prose(rng, rng.randrange(1, 40), EN if i % 3 else XX)) for i in range(80)] + [(90, None), (91, "")]
    asked = [prose(rng, 30, EN + XX + ["unheard", "of"]) for _ in range(20)] + [train[0][1], "x", "the"]
    for odd in (2, 1):  # both halves; all rows in one of them
        marked = documents(train).select("text", (F.col("doc_id") % odd == 1).alias("chosen"))
        scratch = Scratch(spark, "open")
        counted = scratch.keep(word_pairs.counts(marked), "counts")
        cost, first_bits = word_pairs.open_costs(counted, scratch)
        asked_rows = documents(list(enumerate(asked)))
        keys = asked_rows.select("doc_id", word_pairs.text_key(1).alias("a"), word_pairs.text_key(2).alias("b"))
        got = {r["doc_id"]: r for r in keys.join(word_pairs.scores(asked_rows, cost, 5, first_bits), ["a", "b"]).collect()}
        for k, packed in enumerate(quality.word_models(counted)):
            n, bits = pickle.loads(pickle.dumps(packed)).bits(asked)
            assert [got[i]["n_tokens"] for i in range(len(asked))] == n.tolist()
            assert [got[i][f"bits_{k}"] for i in range(len(asked))] == pytest.approx(bits.tolist(), rel=1e-4)


def test_every_good_row_teaches_the_classifier(documents, labels):
    # More good rows than the sample once held. Each word stands in eight texts, so that nearly always the other half has it too.
    rows = [(i, f"word{i // 8} word{i // 8} after{i % 8}", "en", "s") for i in range(24_000)]
    strange = [(30_000 + i, f"other{i} other{i} after{i % 8}", "en", "s") for i in range(400)]
    made = quality.classified(documents(rows + strange), labels([(i, 1, 0) for i in range(24_000)]))
    bits = {r["doc_id"]: r["quality"]["bits_per_token"] for r in made.select("doc_id", "quality").collect()}
    least = min(bits[30_000 + i] for i in range(400))
    assert sum(bits[i] < least for i in range(24_000)) > 0.95 * 24_000
