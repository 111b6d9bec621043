import hashlib
import zlib

import pytest

from ledgerlens.llm import manifest as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, hash int, path string, `odd.name` string, leaf int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def build(nodes):
    """The top of a list of nodes, and for each node its siblings (left, right) up to it."""
    ways, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, held = [], []
        for at in range(0, len(nodes), 3):
            run = nodes[at:at + 3]
            for k in range(len(run)):
                for i in owners[at + k]:
                    ways[i].append(("".join(run[:k]), "".join(run[k + 1:])))
            up.append(sha(*run))
            held.append([i for o in owners[at:at + 3] for i in o])
        nodes, owners = up, held
    return nodes[0], ways


def want(rows):
    if not rows:
        return []
    trees = {}
    for row in rows:
        text = row[1]
        if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
            text = text.replace("\n", "")
        trees.setdefault(row[3], []).append((row[0] is None, row[0] or 0, leaf(row, row[1]), leaf(row, text), row[0]))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    made = {s: build([x[2] for x in sorted(trees[s])]) for s in order}
    root, upper = build([made[s][0] for s in order])
    out = []
    for number, source in enumerate(order):
        subroot, ways = made[source]
        for (_, _, was, now, doc_id), way in zip(sorted(trees[source]), ways):
            way = way + upper[number]
            folded = now
            for left, right in way:
                folded = sha(left, folded, right)
            proof = sha(*[part for step in way for part in step])
            out.append((doc_id, was, subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "p", None, 5) for r in rows], SCHEMA)


def got(spark, rows, height):
    docs = table(spark, rows)
    return sorted(map(tuple, M.manifest(docs, M.without_line_ends(docs), height).collect()), key=str)


def rows_of(sizes):
    """Rows in sources of given sizes; texts with line ends, some null or empty."""
    texts = ["one\ntwo\n", "no line end", "", None, "é\n日\n", "\n"]
    out, k = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            out.append((k * 7 % 1000 + 1, texts[k % len(texts)], "en" if k % 5 else None, source, k if k % 3 else None))
            k += 1
    return out


@pytest.mark.parametrize("height, scale", [(1, 1), (2, 4)])
def test_equals_trees_built_one_by_one(spark, height, scale):
    rows = rows_of({"a": 8 * scale, None: 4, "B": 1, "é": 9, "": 10, "z": 3, "日": 7 * scale})
    rows += [rows[0], rows[0], (rows[0][0], "other\n", "en", "a", 1), (None, "x\ny", "en", "a", 2), (None, "x\ny", "en", "a", 2)]
    assert got(spark, rows, height) == want(rows)


def test_many_sources_and_lone_rows(spark):
    rows = rows_of({f"s{i}": 1 + i % 2 for i in range(40)})
    assert got(spark, rows, 2) == want(rows)
    assert got(spark, rows[:1], 2) == want(rows[:1])
    # An only leaf has an empty proof.
    assert got(spark, rows[:1], 2)[0][4] == sha("")


def test_long_text_and_empty_table(spark):
    rows = [(1, "line\n" * 500_000, "en", "a", 1), (2, "b" * 3_000_000, "en", "a", 2), (3, "c\n", "en", "b", 3)]
    assert got(spark, rows, M.HEIGHT) == want(rows)
    assert got(spark, [], M.HEIGHT) == []


def test_untampered_rows_verify_and_any_change_is_found(spark):
    rows = rows_of({"a": 20, "b": 5})
    assert {r["verified"] for r in M.manifest(table(spark, rows), height=2).collect()} == {True}
    docs = table(spark, rows)
    changed = M.manifest(docs, docs["text"].substr(1, 4), height=2).collect()
    assert {r["verified"] for r in changed if len(rows_by_id(rows)[r["doc_id"]] or "") > 4} == {False}


def rows_by_id(rows):
    return {r[0]: r[1] for r in rows}
