import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest

from ledgerlens.llm import alignment as A

SCHEMA = "doc_id long, text string, pairs string, counts int, groups string, `n.a` int"


@pytest.fixture(scope="module")
def tokenizers():
    return A.Tokenizers.read(A.FOLDER)


def token_bytes(tokenizers):
    """Each id's bytes, by other means than the operator's: from the public rank file and from the pieces."""
    import base64

    a = {}
    for line in open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"):
        token, rank = line.split()
        a[int(rank)] = base64.b64decode(token)
    b = {}
    for i in range(tokenizers.pieces.vocab_size()):
        piece = tokenizers.pieces.id_to_piece(i)
        b[i] = bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x..>", piece) else piece.replace("▁", " ").encode()
    return a, b


def brute(rows, tokenizers):
    """The contract, occurrence by occurrence, without windows or memory."""
    bytes_a, bytes_b = token_bytes(tokenizers)
    made, totals = [], Counter()
    for doc_id, text in rows:
        a = tokenizers.exact.encode(" " + text, add_special_tokens=False).ids if text else []
        b = tokenizers.pieces.encode(text) if text else []
        want = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a[i] for i in a) != want or b"".join(bytes_b[i] for i in b) != want:
            made.append((doc_id, [], [], None, []))
            continue
        ends_a, ends_b, at = [], [], 0
        for i in a:
            at += len(bytes_a[i])
            ends_a.append(at)
        at = 0
        for i in b:
            at += len(bytes_b[i])
            ends_b.append(at)
        place_b = {e: k for k, e in enumerate(ends_b)}
        shared = [e for e in ends_a if e in place_b]
        links = [(a[k], b[place_b[e]]) for k, e in enumerate(ends_a) if e in place_b]
        groups, low = [], 0
        for high in shared:
            ours = [str(i) for i, e in zip(a, ends_a) if low < e <= high] if len(a) < 400 else None
            theirs = [str(i) for i, e in zip(b, ends_b) if low < e <= high] if len(a) < 400 else None
            groups.append(None if ours is None else ",".join(ours) + "|" + ",".join(theirs))
            low = high
        made.append((doc_id, a, b, groups, links))
        totals.update(links)
    highest = Counter()
    for (_, y), n in totals.items():
        highest[y] = max(highest[y], n)
    out = []
    for doc_id, a, b, groups, links in made:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups and groups[0] is not None else ""
        out.append((
            doc_id, len(a), len(b), len(groups or []), len(links), sum(totals[x] == highest[x[1]] for x in links),
            sum(totals[x] for x in links), digest,
        ))
    return sorted(out, key=str)


def got(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA)
    return sorted(map(tuple, A.scored(docs).collect()), key=str)


PIECES = [
    "the ", "and", " ", "  ", "\n", "\t", "é", "日本語", "😀", "don't ", "1234", ".", "--", "<|endoftext|>", "<s>", "<0x41>", "x" * 9, "Ġ",
    "internationalisation ", "\x00", " ", "\r\n", "ﬁ", "Straße ", "ÀÉ ", "́",
]


def test_equals_the_contract(spark, tokenizers):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 40)))) for i in range(150)]
    rows += [(500, None), (501, ""), (None, "plain words"), (3, rows[3][1]), (3, "other"), (502, " "), (503, "a▁b"), (504, "▁")]
    found = got(spark, rows)
    assert found == brute(rows, tokenizers)
    zeros = {r[0] for r in found if r[1] == 0}
    assert {500, 501, 503, 504} <= zeros and all(r[7] == "" for r in found if r[1] == 0)
    assert sum(r[5] < r[4] for r in found) > 20


def test_whole_table_of_documents(spark, tokenizers):
    from ledgerlens.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = sorted(map(tuple, QUERIES["op12_token_alignment"](spark, folder).collect()), key=str)
    want = brute(rows, tokenizers)
    assert [r[:7] for r in found] == [r[:7] for r in want]
    short = {r[0]: r[7] for r in want if r[7]}
    assert len(short) > 20 and all(r[7] == short.get(r[0], r[7]) for r in found)


def test_long_texts_and_empty_table(spark, tokenizers):
    rows = [(1, "word and word " * 60_000), (2, "x" * 300_000), (3, " " * 100_000), (4, "日本" * 50_000)]
    found = got(spark, rows)
    assert [r[:7] for r in found] == [r[:7] for r in brute(rows, tokenizers)]
    assert found[0][1] > 100_000
    assert got(spark, []) == []


def test_windows_that_are_forgotten_give_the_same(tokenizers):
    texts = ["the cat sat on the mat ", "internationalisation of Straße and the cat", "日本 the"] * 5
    small, large = A.Aligner(tokenizers, 20), A.Aligner(tokenizers)
    for text, one, two in zip(texts, small.texts(texts), large.texts(texts)):
        assert one[:3] == two[:3] and one[3].tolist() == two[3].tolist()
    assert len(small.known) + len(small.older) < len(large.known)


def test_new_windows_of_a_text_are_written_together(tokenizers, monkeypatch):
    """A text's ids are laid out once for all its windows, and not at all if every window is remembered."""
    calls, written = [], A.Aligner.written
    monkeypatch.setattr(A.Aligner, "written", lambda self, *given: calls.append(1) or written(self, *given))
    aligner = A.Aligner(tokenizers)
    text = "internationalisation of Straße, the cat's 1234 日本 whiskers and the "
    first, again, mixed = aligner.texts([text * 2, text * 2, text + "unheard of"])
    assert len(calls) == 2 and first[2] == again[2] and len(aligner.known) > 5
    bytes_a, bytes_b = tokenizers.bytes_a, tokenizers.bytes_b
    for found in (first, mixed):
        groups = [[[int(i) for i in side.split(",")] for side in g.split("|")] for g in found[2].split(";")]
        assert sum(len(a) for a, _ in groups) == found[0] and sum(len(b) for _, b in groups) == found[1]
        # Both sides of a group are the same bytes, and no earlier ends meet within it.
        for a, b in groups:
            ends = [{sum(len(made[i]) for i in ids[:k + 1]) for k in range(len(ids))} for made, ids in ((bytes_a, a), (bytes_b, b))]
            assert b"".join(bytes_a[i] for i in a) == b"".join(bytes_b[i] for i in b) and len(ends[0] & ends[1]) == 1


def test_text_of_groups_and_pair_numbers(spark, tokenizers):
    docs = spark.createDataFrame([(1, "the cat's whiskers", "x", 1, "y", 2)], SCHEMA)
    row = A.alignments(docs).first()
    ids_a = [int(i) for g in row["groups"].split(";") for i in g.split("|")[0].split(",")]
    ids_b = [int(i) for g in row["groups"].split(";") for i in g.split("|")[1].split(",")]
    assert ids_a == tokenizers.ids_a("the cat's whiskers") and ids_b == tokenizers.pieces.encode("the cat's whiskers")
    import numpy as np

    a, b = tokenizers.pairs.ids(np.frombuffer(row["pairs"], np.int32))
    ends = [(int(g.split("|")[0].split(",")[-1]), int(g.split("|")[1].split(",")[-1])) for g in row["groups"].split(";")]
    assert set(zip(a.tolist(), b.tolist())) == set(ends)


def test_the_faster_engine_equals_the_file(tokenizers):
    """Every code point between letters, digits, marks and blanks, and texts with long runs."""
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 2048):
        text = "".join(f"a{chr(c)}b 1{chr(c)}{chr(c)} .{chr(c)} {chr(c)}\n" for c in points[at:at + 2048])
        assert tokenizers.ids_a(text) == tokenizers.exact.encode(" " + text, add_special_tokens=False).ids, hex(points[at])
