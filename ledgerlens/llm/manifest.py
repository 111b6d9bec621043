"""Merkle manifest of a dataset: a proof for every row that it belongs to the published root.

Rows of one source form a tree; the trees' roots, ordered by source, form one more. A tree of any width is cut
into superblocks of RUN ** height consecutive nodes. Going up, a superblock is reduced to one node in one group.
Going down, leaves and the outer nodes that they need (the siblings above their superblock) are cogrouped by
superblock: the group reduces its leaves once more, joins inner and outer siblings to proofs and folds them, so
no proof is ever shuffled per leaf and no group exceeds two superblocks, however large a source is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.frames import q, ship
from ledgerlens.operators.ordering import with_row_index
from ledgerlens.storage import Scratch

RUN = 3
#: Levels that one group reduces: superblocks of 3 ** 8 = 6,561 nodes.
HEIGHT = 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_SPLIT = "|"
_FOREST = -1
_NODE = "home long, block long, tree long, place long, width long, hash string"
_PATH = "tree long, place long, path array<string>"
_PROVEN = "doc_id {id}, leaf string, tree long, proof_sha256 string, folded_root string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A value with its size in bytes, so that neighbouring fields cannot be mistaken for each other; null: ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def without_line_ends(docs: DataFrame) -> Column:
    """The tampering of the sample query: no line ends in the text where the id's crc32 is even; null ids stay as they are."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def levels(hashes: list[str], count: int) -> list[list[str]]:
    """The nodes of ``count`` levels above ``hashes``, which come first."""
    out = [hashes]
    for _ in range(count):
        below = out[-1]
        out.append([digest("".join(below[i:i + RUN])) for i in range(0, len(below), RUN)])
    return out


def levels_above(width: int, height: int) -> int:
    """Levels that a superblock of a tree of ``width`` nodes is reduced by."""
    count = 0
    while width > 1 and count < height:
        width, count = -(-width // RUN), count + 1
    return count


def siblings(level: list[str], place: int) -> tuple[str, str]:
    """What stands left and right of a node in its run."""
    start = place - place % RUN
    return "".join(level[start:place]), "".join(level[place + 1:start + RUN])


def paths(made: list[list[str]]) -> list[list[str]]:
    """For each node of the lowest level the siblings on its way up, as ``left|right``."""
    above: list[list[str]] = [[] for _ in made[-1]]
    for level in reversed(made[:-1]):
        own = [_SPLIT.join(siblings(level, i)) for i in range(len(level))]
        above = [[own[i], *above[i // RUN]] for i in range(len(level))]
    return above


def fold(start: str, path: Sequence[str]) -> str:
    """The root that a node and its siblings give."""
    for step in path:
        left, right = step.split(_SPLIT)
        start = digest(left + start + right)
    return start


def _blocks(nodes: DataFrame, size: int, first: Column) -> DataFrame:
    """Adds the superblock: (tree, block) of a wide tree; narrow trees that begin close together share one."""
    wide = F.col("width") > size
    return nodes.withColumns({
        "home": F.when(wide, F.col("tree")).otherwise(-2 - F.floor(first / size)).cast("long"),
        "block": F.when(wide, F.floor(F.col("place") / size)).otherwise(0).cast("long"),
    })


def _trees(group: pd.DataFrame):
    """The parts of a group: each tree's nodes in order."""
    yield from group.sort_values(["tree", "place"], kind="stable").groupby("tree", sort=True)


def _reduced(nodes: DataFrame, height: int) -> DataFrame:
    """One node for each superblock of each tree."""
    size = RUN ** height

    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for tree, part in _trees(group):
            width = int(part["width"].iloc[0])
            top = levels(part["hash"].tolist(), levels_above(width, height))[-1]
            rows.append((0, 0, tree, int(part["place"].iloc[0]) // size, -(-width // size), top[0]))
        return pd.DataFrame(rows, columns=["home", "block", "tree", "place", "width", "hash"])

    made = nodes.select("home", "block", "tree", "place", "width", "hash").groupBy("home", "block").applyInPandas(run, _NODE)
    return _blocks(made, size, F.col("tree"))


def _descended(nodes: DataFrame, outer: DataFrame, height: int) -> DataFrame:
    """The path to the top of every node, from the paths of the superblocks' own nodes (tree, place, path)."""

    def run(inner: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        out = _joined(inner, above, height)
        return pd.DataFrame([(t, p, path) for t, p, path, _ in out], columns=["tree", "place", "path"])

    return _cogrouped(nodes.select("home", "block", "tree", "place", "width", "hash"), outer, height).applyInPandas(run, _PATH)


def _cogrouped(nodes: DataFrame, outer: DataFrame, height: int):
    """``nodes`` with the outer paths of their superblocks, by superblock."""
    return nodes.groupBy("home", "block").cogroup(outer.select("home", "block", "tree", "path").groupBy("home", "block"))


def _joined(inner: pd.DataFrame, above: pd.DataFrame, height: int) -> list[tuple]:
    """(tree, place, whole path, row of the group) of each node: local reduction, then the outer siblings."""
    outside = {t: list(p) for t, p in zip(above["tree"], above["path"])}
    out = []
    for tree, part in _trees(inner):
        rest = outside[tree]
        made = levels(part["hash"].tolist(), levels_above(int(part["width"].iloc[0]), height))
        out += [
            (tree, place, path + rest, row) for place, path, row in zip(part["place"].tolist(), paths(made), part.index.tolist())
        ]
    return out


def _tiers(nodes: DataFrame, width: int, height: int, scratch: Scratch, name: str) -> list[DataFrame]:
    """The nodes, their superblocks' nodes, theirs, and so on until every tree has one; only wide trees go on."""
    tiers = [nodes]
    while len(tiers) == 1 or width > 1:
        open_ = tiers[-1] if len(tiers) == 1 else tiers[-1].filter("width > 1")
        tiers.append(scratch.keep(_reduced(open_, height), f"{name}-{len(tiers)}"))
        width = -(-width // RUN ** height)
    return tiers


def _outer_paths(tiers: list[DataFrame], tops: DataFrame, height: int, scratch: Scratch, name: str) -> DataFrame:
    """The paths of the nodes of ``tiers[1]``: home and block of the superblock below, tree, path. ``tops``: tree, path."""
    size = RUN ** height
    outer = None
    for k in range(len(tiers) - 1, 0, -1):
        found = tiers[k].filter("width = 1").join(tops, "tree").select("tree", "place", "path")
        if outer is not None:
            found = found.unionByName(_descended(tiers[k].filter("width > 1"), outer, height))
        below = tiers[k - 1].filter("width > 1") if k > 1 else tiers[0]
        keys = below.select("home", "block", "tree", F.floor(F.col("place") / size).alias("place")).distinct()
        outer = scratch.keep(keys.join(found, ["tree", "place"]).select("home", "block", "tree", "path"), f"{name}-paths-{k}")
    return outer


def manifest(docs: DataFrame, tampered_text: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``docs`` has the columns of FIELDS; others are not read. A leaf is the hash of FIELDS. Leaves of a source are
    ordered by doc_id (null last), equal ids by leaf; sources are ordered bytewise, a null one (which is a source like
    any other) first. A proof is the list of siblings from leaf to root; ``proof_sha256`` hashes it (an only leaf has an
    empty one). ``folded_root`` is what the proof gives for the row as it is now: with ``tampered_text`` in place of the
    text, or unchanged. Repeated rows are leaves of their own. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "manifest")
    size = RUN ** height
    docs = docs.select(*[q(c).alias(c) for c in FIELDS], (q("text") if tampered_text is None else tampered_text).alias("now_text"))
    key = {"no_source": F.col("source").isNotNull().cast("int"), "source_key": F.coalesce(F.col("source").cast("string"), F.lit(""))}
    leaves = docs.select(
        "doc_id", *[c.alias(k) for k, c in key.items()], leaf([F.col(c) for c in FIELDS]).alias("hash"),
        leaf([F.col(c) for c in [*FIELDS[:-1], "now_text"]]).alias("now"),
    )
    placed = scratch.keep(with_row_index(leaves, [*key, "doc_id", "hash"], "row"), "leaves")
    counted = placed.groupBy(*key).agg(F.min("row").alias("first"), F.count("*").alias("width"))
    sources = scratch.keep(with_row_index(counted, list(key), "tree"), "sources")
    widest, trees = sources.agg(F.max("width"), F.count("*")).first()
    nodes = scratch.keep(_blocks(
        placed.join(sources, list(key)).select(
            "doc_id", "now", "hash", "tree", "width", "first", (F.col("row") - F.col("first")).alias("place")
        ), size, F.col("first"),
    ), "nodes")

    tiers = _tiers(nodes, widest or 0, height, scratch, "source")
    subroots = scratch.keep(_union([t.filter("width = 1") for t in tiers[1:]]).select("tree", "hash"), "subroots")
    forest = _blocks(subroots.select(
        F.lit(_FOREST).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(trees).cast("long").alias("width"), "hash"
    ), size, F.lit(0))
    upper = _tiers(forest, trees, height, scratch, "forest")
    top = upper[-1].filter("width = 1").select(F.lit(_FOREST).cast("long").alias("tree"), F.array().cast("array<string>").alias("path"))
    found = upper[-1].filter("width = 1").first()
    root = F.lit(found["hash"] if found else None).cast("string")
    tops = _descended(forest, _outer_paths(upper, top, height, scratch, "forest"), height).select(F.col("place").alias("tree"), "path")
    outer = _outer_paths(tiers, scratch.keep(tops, "tops"), height, scratch, "source")

    def run(inner: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        ids, now, was = inner["doc_id"], inner["now"], inner["hash"]
        rows = [
            (ids[row], was[row], tree, digest("".join(path).replace(_SPLIT, "")), fold(now[row], path))
            for tree, _, path, row in _joined(inner, above, height)
        ]
        made = pd.DataFrame(rows, columns=["doc_id", "leaf", "tree", "proof_sha256", "folded_root"])
        return made.astype({"doc_id": ids.dtype})

    # Ids travel as text, as a whole number beside a null one would become a fraction in pandas.
    kind = docs.schema["doc_id"].dataType
    proven = _cogrouped(nodes.withColumn("doc_id", F.col("doc_id").cast("string")), outer, height).applyInPandas(
        run, _PROVEN.format(id="string")
    )
    return proven.join(subroots.withColumnRenamed("hash", "subroot"), "tree").select(
        F.col("doc_id").cast(kind).alias("doc_id"), "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _sql_field(name: str) -> str:
    return f"coalesce(strlen(cast({name} AS varchar)) || ':' || {name}, '-')"


SQL = f"""
WITH RECURSIVE tampered AS (
  SELECT *, CASE WHEN list_reduce(
      list_prepend(cast(4294967295 AS bigint), flatten(list_transform(string_split(cast(doc_id AS varchar), ''),
        lambda ch: list_concat([cast(ascii(ch) AS bigint)], list_transform(range(8), lambda i: cast(-1 AS bigint)))))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
    ) & 1 = 1 THEN replace(text, chr(10), '') ELSE text END AS now_text
  FROM documents
), leaves AS (
  SELECT doc_id, source, sha256({" || ".join(_sql_field(c) for c in FIELDS)}) AS leaf,
    sha256({" || ".join(_sql_field(c) for c in [*FIELDS[:-1], "now_text"])}) AS now
  FROM tampered
), sources AS (
  SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS s, count(*) AS n FROM leaves GROUP BY source
), placed AS (
  SELECT l.*, s, n, row_number() OVER (PARTITION BY s ORDER BY doc_id, leaf) - 1 AS p, row_number() OVER () AS id
  FROM leaves l JOIN sources ON l.source IS NOT DISTINCT FROM sources.source
), lower_nodes AS (
  SELECT 0 AS level, s, p, n, leaf AS h FROM placed
  UNION ALL
  SELECT level + 1, s, p // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY p)) FROM lower_nodes WHERE n > 1 GROUP BY level, s, p // 3, n
), upper_nodes AS (
  SELECT 1000 AS level, cast(-1 AS bigint) AS s, s AS p, (SELECT count(*) FROM sources) AS n, h FROM lower_nodes WHERE n = 1
  UNION ALL
  SELECT level + 1, s, p // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY p)) FROM upper_nodes WHERE n > 1 GROUP BY level, s, p // 3, n
), nodes AS (
  SELECT * FROM lower_nodes UNION ALL SELECT * FROM upper_nodes
), steps AS (
  SELECT a.level, a.s, a.p, coalesce(string_agg(b.h, '' ORDER BY b.p) FILTER (b.p < a.p), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.p) FILTER (b.p > a.p), '') AS r
  FROM nodes a JOIN nodes b ON a.level = b.level AND a.s = b.s AND a.p // 3 = b.p // 3
  WHERE a.n > 1 GROUP BY a.level, a.s, a.p
), ways AS (
  SELECT id, coalesce(list(struct_pack(l := l, r := r) ORDER BY t.level) FILTER (l IS NOT NULL), []) AS way
  FROM placed LEFT JOIN steps t ON CASE WHEN t.level < 1000 THEN t.s = placed.s AND t.p = placed.p // cast(pow(3, t.level) AS bigint)
    ELSE t.p = placed.s // cast(pow(3, t.level - 1000) AS bigint) END
  GROUP BY id
), folded AS (
  SELECT id, sha256(array_to_string(list_transform(way, lambda x: x.l || x.r), '')) AS proof_sha256,
    list_reduce(list_prepend(struct_pack(l := now, r := ''), way), lambda a, x: struct_pack(l := sha256(x.l || a.l || x.r), r := '')).l AS folded_root
  FROM ways JOIN placed USING (id)
)
SELECT doc_id, leaf, sub.h AS subroot, top.h AS root, proof_sha256, folded_root, folded_root = top.h AS verified
FROM placed JOIN folded USING (id) JOIN lower_nodes sub ON sub.s = placed.s AND sub.n = 1
CROSS JOIN (SELECT h FROM upper_nodes WHERE n = 1) top
"""
