"""Merkle manifest of a dataset: roots and proofs from a few stored levels (operator 13).

Rows are leaves; a group's leaves, in key order, are hashed eight by eight
until one node, the group's subroot, remains, and the subroots, in group order,
likewise until the root. Only every fourth level is stored (the leaves, then
one node for 4,096 leaves, and so on). Proofs are taken from the top down:
each aligned subtree regenerates its missing interior nodes from its stored
descendants, every descendant gets its siblings on these levels and the path
of the stored node above, and the regenerated nodes are dropped.

A group's rows are range-partitioned by key, so a group that holds most rows is
spread like any other; a task holds one subtree (4,096 nodes of 32 bytes and
their paths) at a time. Subtrees meet the stored nodes above them in a cogroup,
one row a subtree, so no path is shuffled once a leaf.

Cases: a null column counts as ``-``, an empty text as a value of no bytes; a
group may be null (first in order), and so may keys (first in their group);
rows with equal keys stand by their leaves, and where these are equal, too,
their order makes no difference to any hash. A lone leaf is its group's
subroot, a lone subroot the root; the proof of a lone leaf of a lone group is
empty. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.llm.common import numbered, written

# Nodes of a run, and levels between stored ones.
ARITY = 8
STORED_EVERY = 4

_PATH = T.ArrayType(T.StructType([T.StructField("before", T.StringType()), T.StructField("after", T.StringType())]))
_STEPS = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def field(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, one after another."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def parent(run: list[str]) -> str:
    return sha256("".join(run).encode()).hexdigest()


def levels(nodes: list[str], count: int) -> list[list[str]]:
    """``nodes`` and the ``count`` levels above them."""
    out = [nodes]
    for _ in range(count):
        out.append([parent(out[-1][i:i + ARITY]) for i in range(0, len(out[-1]), ARITY)])
    return out


def height(n: Column) -> Column:
    """Levels above ``n`` leaves until one node remains (8^20 is the last power of 8 below 2^63)."""
    return F.coalesce(*[F.when(n > ARITY ** (h - 1), h) for h in range(20, 0, -1)], F.lit(0))


def _subtree() -> Column:
    return F.shiftright("pos", STORED_EVERY * (ARITY.bit_length() - 1))


# -- trees --------------------------------------------------------------------

@dataclass
class Tree:
    """Stored levels of the trees of all groups.

    ``leaves`` has group, pos (0, 1, .. in each group), height (of its tree),
    node and columns of its own; ``stored[i]`` the nodes of level 4 i of the
    trees that reach above it; ``subroots`` a row (group, height, subroot) a
    group.
    """
    leaves: DataFrame
    stored: list[DataFrame]
    subroots: DataFrame


def _climb(base: int):
    """For one aligned subtree: its root, from the nodes of level ``base``."""
    def run(key, nodes):
        nodes = nodes.sort_by("pos")
        top = nodes["height"][0].as_py()
        root = levels(nodes["node"].to_pylist(), min(STORED_EVERY, top - base))[-1][0]
        return pa.table({"group": pa.array([key[0].as_py()], pa.int64()), "pos": pa.array([key[1].as_py()], pa.int64()),
                         "height": pa.array([top], pa.int32()), "node": pa.array([root], pa.string())})
    return run


def grow(leaves: DataFrame) -> Tree:
    """Trees over ``leaves``, level by stored level."""
    highest = leaves.agg(F.max("height")).first()[0] or 0
    names, nodes, stored, roots = ("group", "pos", "height", "node"), leaves, [], []
    for base in range(0, highest + STORED_EVERY, STORED_EVERY):
        roots.append(nodes.where(F.col("height") <= base).select("group", "height", F.col("node").alias("subroot")))
        if base >= highest:
            break
        stored.append(nodes.where(F.col("height") > base))
        nodes = written(stored[-1].select(*names).groupBy("group", _subtree().alias("sub")).applyInArrow(
            _climb(base), "group long, pos long, height int, node string"), "merkle-nodes")
    subroots = roots[0]
    for more in roots[1:]:
        subroots = subroots.union(more)
    return Tree(leaves, stored, written(subroots, "merkle-subroots"))


def _descend(base: int):
    """For one aligned subtree: paths and subroot of its nodes of level ``base``."""
    def run(key, nodes, above):
        nodes = nodes.sort_by("pos")
        hashes, top = nodes["node"].to_pylist(), nodes["height"][0].as_py()
        # interior nodes are regenerated here; the subtree's own root is no one's sibling in it
        steps = [[{"before": "".join(row[i - i % ARITY:i]), "after": "".join(row[i + 1:i - i % ARITY + ARITY])}
                  for i in range(len(row))] for row in levels(hashes, min(STORED_EVERY, top - base) - 1)]
        higher = above["path"][0].as_py()
        paths = [[row[i // ARITY ** k] for k, row in enumerate(steps)] + higher for i in range(len(hashes))]
        return (nodes.drop_columns(["sub"])
                .append_column("subroot", pa.array([above["subroot"][0].as_py()] * len(hashes), pa.string()))
                .append_column("path", pa.array(paths, _STEPS)))
    return run


def paths(tree: Tree, above: DataFrame) -> DataFrame:
    """The leaves with subroot and path, below the paths ``above`` (group, path) of the subroots.

    A path lists, level by level, the siblings before and after the node, each
    as a run of hex digits.
    """
    tops = written(tree.subroots.join(above, "group").select(
        "group", F.lit(0).cast("long").alias("pos"), "height", "subroot", "path"), "merkle-tops")
    upper, handed = None, ["group", "pos", "subroot", "path"]
    for i in reversed(range(len(tree.stored))):
        base = i * STORED_EVERY
        own = tops.where((F.col("height") > base) & (F.col("height") <= base + STORED_EVERY)).select(*handed)
        over = own if upper is None else own.union(upper.select(*handed))
        nodes = tree.stored[i].withColumn("sub", _subtree())
        schema = T.StructType([f for f in nodes.schema if f.name != "sub"]
                              + [T.StructField("subroot", T.StringType()), T.StructField("path", _PATH)])
        upper = nodes.groupBy("group", "sub").cogroup(over.groupBy("group", "pos")).applyInArrow(
            _descend(base), schema)
        if i:
            upper = written(upper, "merkle-paths")
    lone = tree.leaves.where("height = 0").join(
        tops.where("height = 0").select("group", "subroot", "path"), "group").select(
        *tree.leaves.columns, "subroot", "path")
    return lone if upper is None else lone.union(upper.select(*lone.columns))


# -- proofs -------------------------------------------------------------------

def folded(node: Column, path: Column) -> Column:
    """The root that ``node`` leads to along ``path``."""
    return F.aggregate(path, node, lambda acc, step: digest(step["before"], acc, step["after"]))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


def manifest(rows: DataFrame, group: str, order: str, leaf: Column, carry: dict[str, Column]) -> DataFrame:
    """``carry``, leaf, subroot, root and path of every row.

    Within the groups of the column ``group``, the leaves ascend by the column
    ``order``.
    """
    spark = rows.sparkSession
    leaves = written(rows.select(F.struct(*[c.alias(n) for n, c in carry.items()]).alias("carry"),
                                 F.col(group).alias("name"), F.col(order).alias("key"), leaf.alias("node"))
                     .withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    by_name = F.col("name").asc_nulls_first()
    placed = written(numbered(leaves, [by_name, F.col("key").asc_nulls_first(), F.col("node"), F.col("row")],
                              "place"), "merkle-places")
    if not placed.limit(1).count():
        return placed.select("carry.*", F.col("node").alias("leaf"), F.col("node").alias("subroot"),
                             F.col("node").alias("root"), F.lit(None).cast(_PATH).alias("path"))
    # from here on a group's number in order stands for its name
    groups = written(numbered(placed.groupBy("name").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")),
                              [by_name], "group"), "merkle-groups").withColumn("height", height(F.col("n")))
    leaves = written(placed.alias("p").join(groups.alias("g"), F.expr("p.name <=> g.name")).select(
        F.col("group").cast("long").alias("group"), (F.col("place") - F.col("first")).cast("long").alias("pos"),
        "height", "node", "carry"), "merkle-positions")
    tree = grow(leaves)
    whole = grow(tree.subroots.select(
        F.lit(0).cast("long").alias("group"), F.col("group").alias("pos"),
        height(F.lit(tree.subroots.count())).alias("height"), F.col("subroot").alias("node")))
    root = whole.subroots.first().subroot
    above = paths(whole, spark.createDataFrame([(0, [])], T.StructType(
        [T.StructField("group", T.LongType()), T.StructField("path", _PATH)])))
    found = paths(tree, above.select(F.col("pos").alias("group"), "path"))
    return found.select("carry.*", F.col("node").alias("leaf"), "subroot", F.lit(root).alias("root"), "path")


# -- documents ----------------------------------------------------------------

def verify_documents(docs: DataFrame) -> DataFrame:
    """Proofs of all documents by lang, folded from leaves of which some were tampered with.

    Where 3 divides the crc32 of the decimal doc_id, the text's A-Z are
    lower-cased before it is hashed again; a null doc_id is left alone.
    """
    def leaf(text: Column) -> Column:
        return digest(field(F.col("doc_id")), field(F.col("source")), field(F.col("lang")),
                      field(F.col("n_chars")), field(text))

    drawn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    found = manifest(docs, "lang", "doc_id", leaf(F.col("text")), {
        "doc_id": F.col("doc_id"), "altered": F.when(drawn, leaf(lower))})
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("altered", "leaf"), F.col("path")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


# -- the same in SQL ----------------------------------------------------------

_CRC32 = """
crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, step:
          CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS remainders)"""


def _levels_sql(name: str, leaves: str, levels_: int) -> str:
    """CTEs ``name``_0 .. of the nodes (g, pos, node, n) above ``leaves``, and their runs."""
    out = [f"{name}_0 AS ({leaves})"]
    for k in range(levels_):
        out.append(f"{name}_{k + 1} AS (SELECT g, pos // {ARITY} AS pos, sha256(string_agg(node, '' ORDER BY pos)) AS node, "
                   f"(n + {ARITY - 1}) // {ARITY} AS n FROM {name}_{k} WHERE n > 1 GROUP BY g, pos // {ARITY}, n)")
        out.append(f"{name}_run_{k} AS (SELECT g, pos // {ARITY} AS run, list(node ORDER BY pos) AS nodes "
                   f"FROM {name}_{k} WHERE n > 1 GROUP BY g, pos // {ARITY})")
    tops = " UNION ALL ".join(f"SELECT g, node FROM {name}_{k} WHERE n = 1" for k in range(levels_ + 1))
    return ",\n".join([*out, f"{name}_top AS ({tops})"])


def _fold_sql(rows: str, name: str, levels_: int, prefix: str) -> str:
    """CTEs that fold acc and proof of ``rows`` (g, pos, acc, proof, ..) level by level into ``prefix``."""
    out, last = [], rows
    for k in range(levels_):
        at = f"(r.pos // {ARITY ** k}) % {ARITY}"
        before, after = f"array_to_string(u.nodes[1:{at}], '')", f"array_to_string(u.nodes[{at} + 2:], '')"
        out.append(f"{prefix}_{k} AS (SELECT r.* REPLACE (CASE WHEN u.g IS NULL THEN r.acc ELSE sha256({before} || r.acc || {after}) "
                   f"END AS acc, CASE WHEN u.g IS NULL THEN r.proof ELSE r.proof || {before} || {after} END AS proof) "
                   f"FROM {last} r LEFT JOIN {name}_run_{k} u ON u.g = r.g AND u.run = r.pos // {ARITY ** (k + 1)})")
        last = f"{prefix}_{k}"
    return ",\n".join(out)


def oracle_sql(levels_: int = 9, group_levels: int = 4) -> str:
    """DuckDB SQL of ``verify_documents`` for up to 8^``levels_`` documents of a lang and 8^``group_levels`` langs."""
    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(
            f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
            for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    codes = "list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)"
    drawn = (f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, b: "
             "xor(c >> 8, remainders[(xor(c, b) & 255) + 1])), 4294967295) % 3 = 0")
    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"""
WITH {_CRC32.strip()},
d AS (SELECT doc_id, lang, {leaf("text")} AS leaf,
             CASE WHEN doc_id IS NOT NULL AND {drawn} THEN {leaf(lower)} END AS altered FROM documents, crc),
langs AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM (SELECT DISTINCT lang FROM d)),
e AS (SELECT d.*, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
      FROM d JOIN langs ON d.lang IS NOT DISTINCT FROM langs.lang),
{_levels_sql("t", "SELECT g, pos, leaf AS node, count(*) OVER (PARTITION BY g) AS n FROM e", levels_)},
{_levels_sql("u", "SELECT 0 AS g, g AS pos, node, count(*) OVER () AS n FROM t_top", group_levels)},
start AS (SELECT g, pos, doc_id, leaf, coalesce(altered, leaf) AS acc, '' AS proof FROM e),
{_fold_sql("start", "t", levels_, "f")},
upper_start AS (SELECT 0 AS g, r.g AS pos, r.doc_id, r.leaf, t_top.node AS subroot, r.acc, r.proof
                FROM f_{levels_ - 1} r JOIN t_top ON t_top.g = r.g),
{_fold_sql("upper_start", "u", group_levels, "h")}
SELECT doc_id, leaf, subroot, u_top.node AS root, sha256(proof) AS proof_sha256, acc AS folded_root,
       acc = u_top.node AS verified
FROM h_{group_levels - 1}, u_top
"""
