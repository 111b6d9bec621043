import random
import re

from ledgerlens.llm.line_dedup import cleaned, deduplicated


def brute(rows, min_words):
    """Kept text of each document, by the longest earlier match of every pair of places."""
    docs = sorted({(i is None, i, t) for i, t in rows if t is not None}, key=lambda d: (d[0], d[1] or 0))
    seqs = []
    for _, i, t in docs:
        lines = t.split("\n")
        at = [k for k, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x)]
        seqs.append((lines, at, [len(re.findall(r"[^\x20\x09-\x0D]+", lines[k])) for k in at]))
    gone = [set() for _ in docs]
    for d, (lines, at, size) in enumerate(seqs):
        for s in range(len(at)):
            for e in range(d + 1):
                other, oat, _ = seqs[e]
                for p in range(len(oat) if e < d else s):
                    n = 0
                    while s + n < len(at) and p + n < len(oat) and lines[at[s + n]] == other[oat[p + n]]:
                        n += 1
                    if n and sum(size[s:s + n]) >= min_words:
                        gone[d].update(range(at[s], at[s + n - 1] + 1))
    kept = {(i, t): "\n".join(x for k, x in enumerate(seqs[d][0]) if k not in gone[d]) for d, (_, i, t) in enumerate(docs)}
    return sorted(((i, None if t is None else kept[i, t]) for i, t in rows), key=str)


def corpus(rng):
    pool = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.choice([1, 2, 3, 5, 8, 12]))) for _ in range(40)]
    rows = []
    for i in range(30):
        lines = [rng.choice(pool) if rng.random() < 0.5 else f"own {i} {k} line" for k in range(rng.randrange(0, 14))]
        if rows and rng.random() < 0.7:
            source = rng.choice(rows)[1].split("\n")
            a = rng.randrange(0, len(source))
            lines[2:2] = source[a:a + rng.randrange(1, 9)]
        if rng.random() < 0.4:
            lines.insert(rng.randrange(0, len(lines) + 1), rng.choice(["", "  \t"]))
        rows.append((i, "\n".join(lines)))
    return rows


def texts(df):
    return sorted(((r["doc_id"], r["line_dedup"]["text"]) for r in df.collect()), key=str)


def test_later_copies_are_those_of_all_repeated_runs(documents):
    for seed, min_words in ((1, 10), (2, 6), (3, 17)):
        rows = corpus(random.Random(seed))
        assert texts(deduplicated(documents(rows), min_words=min_words)) == brute(rows, min_words)


def test_special_rows(documents):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(3, long), (3, long), (1, f"{long}\n\nend"), (None, long), (None, None), (8, ""), (9, f"{long}\n{long}\n{long}"), (4, "\n \n")]
    docs = documents(rows)
    assert texts(deduplicated(docs)) == brute(rows, 50)
    kept = cleaned(docs)
    assert kept.columns == docs.columns
    assert {(r["doc_id"], r["text"], r["n_chars"]) for r in kept.collect()} == {
        (1, f"{long}\n\nend", len(long) + 5), (None, None, 0), (8, "", 0), (4, "\n \n", 3),
    }


def test_long_copies_and_empty_table(documents):
    text = "\n".join(f"line {i} of a long text" for i in range(20_000))
    [row] = cleaned(documents([(1, text), (2, text + "\nand this")])).filter("doc_id = 2").collect()
    assert row["text"] == "and this"
    assert cleaned(documents([])).count() == 0
