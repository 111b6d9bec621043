import hashlib

from ledgerlens.llm import warc_audit as W


def leaves(spark, rows):
    return spark.createDataFrame(rows, "file long, place long, offset long, length long, digest string, extra string")


def table(n, per, change=None):
    rows = []
    for i in range(n):
        row = [i // per, i % per, 10 * (i % per), 10, f"d{i}", "x"]
        if change:
            row = change(i, row)
        if row:
            rows.append(tuple(row))
    return rows


def found(df):
    return sorted((r["file"], r["place"], r["status"]) for r in df.collect())


def test_audit_finds_exactly_the_damaged_records(spark):
    def damage(i, row):
        if i in (0, 37, 511):
            row[4] = "bad"
        if i == 200:
            row[3] = 9
        return None if i in (100, 959) else row

    good = leaves(spark, table(960, 300))
    bad = leaves(spark, table(960, 300, damage))
    assert found(W.audit(good, bad)) == sorted(
        [(i // 300, i % 300, "missing" if i in (100, 959) else "changed") for i in (0, 37, 100, 200, 511, 959)]
    )
    assert {s for *_, s in found(W.audit(bad, good))} == {"changed", "extra"}
    assert found(W.audit(good, good)) == []


def test_empty_and_single(spark):
    none, one = leaves(spark, []), leaves(spark, [(0, 0, 0, 5, None, None)])
    assert found(W.audit(none, none)) == []
    assert found(W.audit(one, none)) == [(0, 0, "missing")]
    assert found(W.audit(none, one)) == [(0, 0, "extra")]
    assert found(W.audit(one, leaves(spark, [(0, 0, 0, 5, "", None)]))) == []


def test_files_are_parsed_to_records(spark, tmp_path):
    def record(uri, body):
        return f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {uri}\r\nContent-Length: {len(body.encode())}\r\n\r\n{body}\r\n\r\n".encode()

    parts = [record("http://a/", "é body"), record("http://b/", ""), record("http://c/", "x" * 100)]
    (tmp_path / "a.warc").write_bytes(b"".join(parts))
    (tmp_path / "b.warc").write_bytes(parts[0] + b"WARC/broken" + parts[2])
    (tmp_path / "c.warc").write_bytes(b"")
    got = W.parse(spark.read.format("binaryFile").load(str(tmp_path))).collect()
    a = sorted((r["offset"], r["length"], r["uri"], r["digest"]) for r in got if r["file"].endswith("a.warc"))
    at = 0
    for (offset, length, uri, digest), part in zip(a, parts):
        assert (offset, length, digest) == (at, len(part), hashlib.sha256(part).hexdigest())
        at += len(part)
    assert [r[2] for r in a] == ["http://a/", "http://b/", "http://c/"]
    assert sorted(r["type"] for r in got if r["file"].endswith("b.warc")) == ["damaged", "response", "response"]


def test_pages_with_nulls_and_repeats(spark):
    pages = spark.createDataFrame(
        [(5, "u", "h"), (3, None, None), (3, "u", "h"), (None, "u", "h"), (7, "", "")], "page_id long, url string, html string"
    )
    got = sorted((r["page_id"], r["status"]) for r in W.audited_pages(pages).collect())
    assert got == [(3, "changed"), (3, "changed"), (5, "missing")]
    assert W.audited_pages(pages.limit(0)).count() == 0
