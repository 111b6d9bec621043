import hashlib
import random

import regex
import xxhash

from ledgerlens.llm import fingerprints as W
from ledgerlens.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, key string, marks int, n long, head string, part int, `odd.name` string"


def units(text):
    return regex.findall(r"[\p{L}\p{M}\p{N}]{1,8}|[^ \t\n\x0b\f\r]", text)


def rolled(text):
    """Each gram's hash, rolled along the units."""
    grams, h, whole = [], 0, (1 << 64) - 1
    codes = [xxhash.xxh64(c.encode(), seed=42).intdigest() for c in units(text)]
    for i, c in enumerate(codes):
        h = (h << 1 ^ c) & whole
        if i >= W.GRAM:
            h ^= codes[i - W.GRAM] << W.GRAM & whole
        if i >= W.GRAM - 1:
            grams.append(h >> 27 & (1 << 36) - 1)
    return grams, h >> 27 & (1 << 36) - 1


def winnowed(text):
    """(hash, position) of the rightmost least gram of each window, in order."""
    if not units(text):
        return []
    grams, whole = rolled(text)
    if not grams:
        return [(whole >> 5, 0)]
    out = []
    for start in range(max(1, len(grams) - W.WINDOW + 1)):
        window = grams[start:start + W.WINDOW]
        least = min(window)
        place = start + max(k for k, g in enumerate(window) if g == least)
        if not out or out[-1][1] != place:
            out.append((least >> 5, place))
    return out


def likeness(one, two):
    a, b = {h for h, _ in one}, {h for h, _ in two}
    return len(a & b) / len(a | b) if a | b else 1.0


def want(rows):
    def key(row):
        digest = hashlib.sha256(f"{'-' if row[0] is None else row[0]}:{row[1] or ''}".encode()).digest()
        return (row[0] is None, row[0] or 0, digest)

    rows, out = sorted(rows, key=key), []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        made = [winnowed(t) for t in (text, edited, after)]
        listed = [",".join(f"{h:x}:{p}" for h, p in m) for m in made]
        out.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), listed[0], listed[1],
            likeness(made[0], made[1]), likeness(made[0], made[2]),
        ))
    return sorted(out, key=str)


def got(spark, rows):
    docs = spark.createDataFrame([(*r, "k", 1, 2, "h", 3, "o") for r in rows], SCHEMA)
    return sorted(map(tuple, W.compared(docs).collect()), key=str)


def test_equals_rolling_and_choosing_step_by_step(spark):
    rng = random.Random(8)
    rows = []
    for i in range(80):
        size = rng.choice([1, 3, 7, 8, 9, 16, 70, 71, 72, 94, 95, 96, 200, 700, 2047, 2048, 2118, 2119, 5000])
        letters = rng.choice(["ab", "abcdefghij \n", "aé日😀 ", "x", "a .,\t", " "])
        rows.append((rng.randrange(10**6), "".join(rng.choice(letters) for _ in range(size))))
    rows += [(5, None), (6, ""), (7, ""), (7, None), (None, "null id " * 30), (None, "null id " * 30)]
    rows += [rows[3], rows[3], (rows[3][0], "same id, other text " * 20)]
    assert got(spark, rows) == want(rows)


def test_whole_table_of_documents(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = sorted(map(tuple, QUERIES["op11_fingerprints"](spark, folder).collect()), key=str)
    assert found == want(rows)
    assert sum(r[5] for r in found) / len(found) > 0.5 and sum(r[6] for r in found) / len(found) < 0.1, sum(r[6] for r in found) / len(found)


def test_shared_passages_have_a_mark_in_common(spark):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice(["ab ", "cde ", "f ", "ghijkl ", "mnopqrstuvw "]) for _ in range(n))
    for _ in range(5):
        passage = word(W.CERTAIN)
        one, two = word(rng.randrange(300)) + passage + word(50), word(rng.randrange(300)) + passage + word(90)
        assert {h for h, _ in winnowed(one)} & {h for h, _ in winnowed(two)}
    passage = word(W.CERTAIN)
    docs = spark.createDataFrame([(1, word(3000) + passage + word(100)), (2, word(77) + passage)], "doc_id long, text string")
    a, b = ({m >> 32 for m in r["marks"]} for r in W.fingerprinted(docs).orderBy("doc_id").collect())
    assert a & b


def test_long_text_one_row_and_empty_table(spark):
    rng = random.Random(2)
    rows = [(1, "".join(rng.choice("abcdefgh \n") for _ in range(60_000))), (2, "z" * 40_000), (3, "short")]
    assert got(spark, rows) == want(rows)
    assert got(spark, [(9, "only one row " * 20)]) == want([(9, "only one row " * 20)])
    assert got(spark, []) == []


def test_marks_are_made_on_the_way_to_their_key(spark, monkeypatch):
    """No marks are written besides, and both uses read the exchange of the texts."""
    kept, keep = [], W.Scratch.keep
    monkeypatch.setattr(W.Scratch, "keep", lambda self, df, name: kept.append((name, df.columns)) or keep(self, df, name))
    docs = spark.createDataFrame([(i, f"text {i} " * 30) for i in range(20)], "doc_id long, text string")
    for limit in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            found = W.compared(docs)
            assert len(found.collect()) == 20
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "ReusedExchange" in final
        # Where texts go to their key, and where it is shown what is read again.
        assert final.count("partial_first(marks") == 1
    assert [name for name, _ in kept] == ["order", "next"] * 2 and not any("marks" in columns for _, columns in kept)
