"""A Merkle manifest of a dataset: leaves by row, a tree by group, a root over the groups, and proofs.

A node's digest is the SHA-256 of its children's digests as hex text, up to ``FAN`` children. A parent
retains a copy of the hash state before each child slot (``Parent``); to fold a changed child, the state
of its slot is resumed with the replacement and the siblings to its right only. Left siblings are never
hashed again.

Nodes of a sequence are cut into blocks of ``BLOCK`` consecutive ones, a few levels of the tree. A task
holds one block. Upwards, each round replaces blocks by their top nodes until every sequence has one
left; these are the leaves of one sequence more, which gives the root. Downwards, each round hands every
node of a block its path: left and right siblings of each level up to the root. A block resumes the
states of the levels above it once, and folds all its rows from there. Group sizes do not matter: no
step sees more than a block, places are found from counts of range partitions.

Null counts as its own value, ``-``. Rows with equal group and id stand in the order of their leaves;
those with equal leaves are interchangeable. A null group comes first, a null id first in its group
and as the empty text where it picks what is tampered with. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from waitspark.llm.common import fold, share_package
from waitspark.workspace import materialize

#: Children of a node.
FAN = 16
#: Levels of the tree in a block, and nodes of a block: what a task takes at once.
DEPTH = 2
BLOCK = FAN**DEPTH
#: What a leaf is made of, in this order.
LEAF = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEPS = "array<struct<left:string,right:string>>"


def digest_of(*values: Column) -> Column:
    """SHA-256 over each value's UTF-8 length, a colon and the value; ``-`` for null."""
    parts = []
    for value in values:
        text = value.cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


class Parent:
    """A node over some children; ``before[i]`` is the hash state before child ``i``."""

    def __init__(self, children: Sequence[str]) -> None:
        self.children = children
        self.before = []
        state = hashlib.sha256()
        for child in children:
            self.before.append(state.copy())
            state.update(child.encode())
        self.digest = state.hexdigest()

    def fold(self, slot: int, replacement: str) -> str:
        return resumed(self.before[slot], replacement, "".join(self.children[slot + 1 :]))

    def siblings(self, slot: int) -> tuple[str, str]:
        return "".join(self.children[:slot]), "".join(self.children[slot + 1 :])


def resumed(before, replacement: str, right: str) -> str:
    state = before.copy()
    state.update((replacement + right).encode())
    return state.hexdigest()


def levels(digests: list[str], total: int) -> list[list[Parent]]:
    """The levels of parents over a block of a sequence of ``total`` nodes, lowest first."""
    found: list[list[Parent]] = []
    while total > 1 and len(found) < DEPTH:
        found.append([Parent(digests[i : i + FAN]) for i in range(0, len(digests), FAN)])
        digests = [p.digest for p in found[-1]]
        total = -(-total // FAN)
    return found


def numbered(nodes: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``nodes`` with ``pos``, its place in its group from 0, and ``n``, the size of the group.

    Rows are dealt out by ranges, so a group may take many partitions; each counts its rows of a group,
    and those counts place the rows of the next.
    """
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    dealt = nodes.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    dealt = materialize(dealt.withColumn("_id", F.monotonically_increasing_id()), "dealt")
    part = F.shiftright("_id", 33)
    counts = dealt.groupBy(F.col(group).alias("_group"), part.alias("_part")).agg(
        F.count(F.lit(1)).alias("_count"), F.min("_id").alias("_first")
    )
    # A row for each partition and group in it: as many as partitions and groups together.
    whole = Window.partitionBy("_group")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(
        counts.withColumns({"_before": F.coalesce(F.sum("_count").over(before), F.lit(0)), "n": F.sum("_count").over(whole)}),
        "starts",
    )
    match = (part == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group"))
    joined = dealt.join(starts, match)
    return joined.withColumn("pos", F.col("_before") + F.col("_id") - F.col("_first")).drop(
        "_id", "_group", "_part", "_count", "_first", "_before"
    )


def _block() -> Column:
    return F.floor(F.col("pos") / BLOCK)


def _ordered(group: pa.Table) -> dict[str, list]:
    return group.sort_by("pos").to_pydict()


def _above(nodes: DataFrame) -> DataFrame:
    """One node for each block of ``nodes`` (key, pos, n, digest)."""

    def run(group: pa.Table) -> pa.Table:
        rows = _ordered(group)
        total = rows["n"][0]
        found = levels(rows["digest"], total)
        top = found[-1][0].digest if found else rows["digest"][0]
        return pa.table(
            {"key": rows["key"][:1], "pos": [rows["pos"][0] // BLOCK], "n": [-(-total // BLOCK)], "digest": [top]},
            pa.schema([("key", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string())]),
        )

    blocks = nodes.select("key", "pos", "n", "digest").groupBy("key", _block().alias("_block"))
    return blocks.applyInArrow(run, "key string, pos long, n long, digest string")


def climb(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` (key, pos, n, digest) and the rounds above them; the last has one node for each key."""
    rounds = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        rounds.append(materialize(_above(rounds[-1]), "blocks"))
        most = -(-most // BLOCK)
    return rounds


def _paths(group: pa.Table) -> tuple[dict[str, list], list[list[Parent]], list[list[dict]]]:
    """The nodes of a block in order, its levels of parents, and each node's steps inside the block."""
    rows = _ordered(group)
    found = levels(rows["digest"], rows["n"][0])
    inner = []
    for i in range(len(rows["pos"])):
        own = []
        for parents in found:
            left, right = parents[i // FAN].siblings(i % FAN)
            own.append({"left": left, "right": right})
            i //= FAN
        inner.append(own)
    return rows, found, inner


def _below(nodes: DataFrame, paths: DataFrame, finish: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``finish`` for each block of ``nodes`` and the path (key, pos, subroot, steps) of its top node."""
    left = nodes.groupBy("key", _block().alias("_block"))
    right = paths.groupBy("key", F.col("pos").alias("_block"))
    return left.cogroup(right).applyInArrow(finish, schema)


PATH = f"key string, pos long, subroot string, steps {STEPS}"
PATH_ARROW = pa.schema(
    [
        ("key", pa.string()),
        ("pos", pa.int64()),
        ("subroot", pa.string()),
        ("steps", pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))),
    ]
)


def _hand_down(nodes: pa.Table, path: pa.Table) -> pa.Table:
    above = path.to_pylist()[0]
    rows, _, inner = _paths(nodes)
    n = len(inner)
    steps = [own + above["steps"] for own in inner]
    return pa.table({"key": rows["key"], "pos": rows["pos"], "subroot": [above["subroot"]] * n, "steps": steps}, PATH_ARROW)


def descend(rounds: list[DataFrame], paths: DataFrame) -> DataFrame:
    """Paths of the nodes of the second of ``rounds``, from those of the last."""
    for nodes in reversed(rounds[1:-1]):
        paths = materialize(_below(nodes, paths, _hand_down, PATH), "paths")
    return paths


@dataclass(frozen=True)
class Manifest:
    """A tree: its leaves and the rounds above them, each group's subroot with the path to the root, and the root.

    Leaves are (row_id, key, group, pos, n, digest, replacement); ``key`` is the group as text that is
    never null; ``replacement`` is the digest to fold in the leaf's place, null for its own.
    """

    rounds: list[DataFrame]
    paths: DataFrame
    root: str | None

    @property
    def leaves(self) -> DataFrame:
        return self.rounds[0]

    def groups(self) -> DataFrame:
        """(group, n, subroot) of each group."""
        sizes = self.leaves.filter("pos = 0").select("key", "group", "n")
        return sizes.join(self.paths.select("key", "subroot"), "key").drop("key")


def build(leaves: DataFrame) -> Manifest:
    rounds = climb(leaves)
    named = leaves.filter("pos = 0").select(F.col("key").alias("of"), "group")
    tops = rounds[-1].select(F.col("key").alias("of"), F.col("digest").alias("subroot")).join(named, "of")
    tops = materialize(numbered(tops.withColumn("_all", F.lit("all")), "_all", ["group"]), "tops")
    upper = climb(tops.select(F.lit("all").alias("key"), "pos", "n", F.col("subroot").alias("digest")))
    last = upper[-1].first()
    spark = leaves.sparkSession
    if last is None:
        return Manifest(rounds, spark.createDataFrame([], PATH), None)
    whole = descend(upper, spark.createDataFrame([("all", 0, last["digest"], [])], PATH))
    if len(upper) > 1:
        whole = materialize(_below(upper[0], whole, _hand_down, PATH), "paths")
    paths = tops.select(F.col("of").alias("key"), "pos", "subroot").join(whole.select("pos", "steps"), "pos")
    paths = paths.select("key", F.lit(0).cast("long").alias("pos"), "subroot", "steps")
    return Manifest(rounds, materialize(paths, "paths"), last["digest"])


def prove(manifest: Manifest) -> DataFrame:
    """row_id, leaf, subroot, root, proof_sha256 and folded_root of every leaf."""
    root = manifest.root
    id_type = manifest.leaves.schema["row_id"].dataType
    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
    kinds = pa.schema([("row_id", to_arrow_type(id_type)), *((name, pa.string()) for name in names)])

    def finish(nodes: pa.Table, path: pa.Table) -> pa.Table:
        above = path.to_pylist()[0]
        rows, found, inner = _paths(nodes)
        outer = "".join(step["left"] + step["right"] for step in above["steps"]).encode()
        # The states before this block's slot on each level above it, retained for all its rows.
        states = [(hashlib.sha256(step["left"].encode()), step["right"]) for step in above["steps"]]
        proofs, folded = [], []
        for i, own in enumerate(inner):
            proof = hashlib.sha256("".join(step["left"] + step["right"] for step in own).encode())
            proof.update(outer)
            proofs.append(proof.hexdigest())
            value = rows["replacement"][i] or rows["digest"][i]
            at = i
            for parents in found:
                value = parents[at // FAN].fold(at % FAN, value)
                at //= FAN
            for before, right in states:
                value = resumed(before, value, right)
            folded.append(value)
        n = len(inner)
        columns = [rows["row_id"], rows["digest"], [above["subroot"]] * n, [root] * n, proofs, folded]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, kinds)], kinds)

    schema = f"row_id {id_type.simpleString()}, " + ", ".join(f"{name} string" for name in names)
    nodes = manifest.leaves.select("row_id", "key", "pos", "n", "digest", "replacement")
    return _below(nodes, descend(manifest.rounds, manifest.paths), finish, schema)


def leaves_of(docs: DataFrame, tampered: Column | None = None, change: dict[str, Column] | None = None) -> DataFrame:
    """Numbered leaves of ``docs``; those that are ``tampered`` with have the digest after ``change``."""
    own = digest_of(*map(F.col, LEAF))
    other = digest_of(*[(change or {}).get(c, F.col(c)) for c in LEAF])
    narrow = docs.select(
        F.col("doc_id").alias("row_id"),
        F.col("source").cast("string").alias("group"),
        own.alias("digest"),
        F.when(F.lit(False) if tampered is None else tampered, other).alias("replacement"),
    )
    # Written before the rows are dealt out, so that the texts are read and hashed once.
    placed = numbered(materialize(narrow, "digests"), "group", ["row_id", "digest"])
    key = F.coalesce(F.concat(F.lit("="), F.col("group")), F.lit("-"))
    return materialize(placed.withColumn("key", key), "leaves")


def op11(docs: DataFrame) -> DataFrame:
    """Proofs of all rows, and the roots that folding gives after lower-casing every fifth text."""
    share_package(docs.sparkSession)
    tampered = fold("doc_id", 5) == 0
    leaves = leaves_of(docs, tampered, {"text": F.translate("text", UPPER, LOWER)})
    return prove(build(leaves)).select(
        F.col("row_id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


#: The same in SQL. CRC-32 goes by half bytes; fixed values: its table for the 16 half bytes.
SQL = """
WITH RECURSIVE crc(half) AS (
  SELECT [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384,
          4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]),
digests AS (
  SELECT doc_id, source,
         coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
         || coalesce(octet_length(encode(source)) || ':' || source, '-')
         || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
         coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS middle,
         coalesce(octet_length(encode(text)) || ':' || text, '-') AS body,
         coalesce(octet_length(encode(text)) || ':' ||
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS changed,
         list_reduce(list_concat([4294967295], flatten(list_transform(
           string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''),
           lambda ch: CASE WHEN ch = '' THEN []::BIGINT[] ELSE [ascii(ch) & 15, ascii(ch) >> 4]::BIGINT[] END))),
           lambda c, x: xor(c >> 4, half[CAST(xor(c, x) & 15 AS INTEGER) + 1])) AS flipped
  FROM documents, crc),
leaves AS (
  SELECT doc_id, source, sha256(head || middle || body) AS leaf,
         CASE WHEN xor(flipped, 4294967295) % 5 = 0 THEN sha256(head || middle || changed)
              ELSE sha256(head || middle || body) END AS held,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n
  FROM digests),
tree AS (
  SELECT 0 AS lvl, source, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT lvl + 1, source, pos // 16, any_value((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY pos))
  FROM tree WHERE n > 1 GROUP BY lvl, source, pos // 16),
subroots AS (
  SELECT source, digest AS subroot, lvl AS depth,
         row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM tree WHERE n = 1),
upper AS (
  SELECT 0 AS lvl, pos, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 16, any_value((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY pos))
  FROM upper WHERE n > 1 GROUP BY lvl, pos // 16),
lower_steps AS (
  SELECT l.source, l.pos AS leaf_pos, t.lvl AS step,
         coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (WHERE t.pos < l.pos // pow(16, t.lvl)::BIGINT), '') AS before,
         coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (WHERE t.pos > l.pos // pow(16, t.lvl)::BIGINT), '') AS after
  FROM leaves l JOIN tree t ON t.source IS NOT DISTINCT FROM l.source AND t.n > 1
    AND t.pos // 16 = l.pos // pow(16, t.lvl + 1)::BIGINT
  GROUP BY ALL),
upper_steps AS (
  SELECT s.source, s.depth + u.lvl AS step,
         coalesce(string_agg(u.digest, '' ORDER BY u.pos) FILTER (WHERE u.pos < s.pos // pow(16, u.lvl)::BIGINT), '') AS before,
         coalesce(string_agg(u.digest, '' ORDER BY u.pos) FILTER (WHERE u.pos > s.pos // pow(16, u.lvl)::BIGINT), '') AS after
  FROM subroots s JOIN upper u ON u.n > 1 AND u.pos // 16 = s.pos // pow(16, u.lvl + 1)::BIGINT
  GROUP BY ALL),
steps AS (
  SELECT source, leaf_pos, step, before, after FROM lower_steps
  UNION ALL
  SELECT l.source, l.pos, u.step, u.before, u.after
  FROM leaves l JOIN upper_steps u ON u.source IS NOT DISTINCT FROM l.source),
folds AS (
  SELECT source, pos, 0 AS step, held AS value FROM leaves
  UNION ALL
  SELECT f.source, f.pos, f.step + 1, sha256(s.before || f.value || s.after)
  FROM folds f JOIN steps s ON s.source IS NOT DISTINCT FROM f.source AND s.leaf_pos = f.pos AND s.step = f.step),
folded AS (SELECT source, pos, arg_max(value, step) AS folded_root FROM folds GROUP BY source, pos),
proofs AS (
  SELECT source, leaf_pos AS pos, sha256(string_agg(before || after, '' ORDER BY step)) AS proof_sha256
  FROM steps GROUP BY source, leaf_pos)
SELECT l.doc_id, l.leaf, s.subroot, r.digest AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
       f.folded_root, f.folded_root = r.digest AS verified
FROM leaves l
JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
JOIN folded f ON f.source IS NOT DISTINCT FROM l.source AND f.pos = l.pos
LEFT JOIN proofs p ON p.source IS NOT DISTINCT FROM l.source AND p.pos = l.pos
CROSS JOIN (SELECT digest FROM upper WHERE n = 1) r
"""
