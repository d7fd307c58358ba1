"""Chat formatting of reply trees (operator 5).

Messages with a parent form trees. Self-joins whose reach doubles each round
(a message to its ancestor 1, 2, 4, ... steps up) sum the scores of every
root-to-leaf path, one row a message and round. Branches are ranked by the mean
score of their messages; the paths of the chosen ones are enumerated along the
same jumps, as (leaf, message, distance) rows without the texts, and each
becomes one conversation. A long trunk under many branches is therefore not
written out once a branch.

The template is ``<|turn|>`` role ``<|text|>`` text ``<|end|>`` for each turn.
In roles and texts a control string (the markers' ``<|`` and those of common
templates) gets a backslash after its first character, one more if it has some
already, so ``parsed`` gives every text back exactly. The loss mask is a list
of spans of the formatted string, one for each assistant text.

Cases: a null text or role is empty; a message whose parent does not exist is
a root; messages on a cycle have no root and are left out; a repeated message
(same tree and id) counts once; equal branch scores rank by the smaller leaf;
a null tree id is a tree of its own; an empty table gives no rows; extra
columns are ignored. One conversation is one output row, so it must fit a task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.llm.common import Rounds, written

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNT = "assistant"
_CONTROL = r"(\||/?s>|/?INST\]|<SYS>>|</SYS>>)"
_ESCAPE = re.compile(rf"([<\[])(\\*){_CONTROL}")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*){_CONTROL}")


def escaped(text: str | None) -> str:
    return _ESCAPE.sub(r"\1\\\2\3", text or "")


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def formatted(turns: list[tuple[str | None, str | None]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted string of (role, text) turns and its loss spans."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escaped(role)}{TEXT}", escaped(text)
        if role == LEARNT:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parsed(text: str) -> list[tuple[str, str]]:
    """(role, text) turns of a formatted string."""
    turns = []
    for part in text.split(TURN)[1:]:
        role, _, body = part.partition(TEXT)
        turns.append((unescaped(role), unescaped(body.removesuffix(END))))
    return turns


def _distinct(messages: DataFrame) -> DataFrame:
    """Messages with a repeated (tree, node) counted once."""
    return messages.dropDuplicates(["tree", "node"])


def climbed(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Path totals of every message, and the jumps that found them.

    ``messages``: tree, node, parent, score. The first result has (tree, node,
    above, total, n): the sum and number of the scores from the message up to
    its root; ``above`` is not null where a cycle has no root. The jumps are
    (tree, node, above) tables of reach 1, 2, 4, ..: each joins the one before
    with itself, so there are as many as the depth has binary digits, and each
    has at most one row a message, however many branches pass through it.
    """
    nodes = messages.select("tree", "node", "parent", "score")
    parents = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    state = written(nodes.join(parents, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("there"), F.col("parent")).alias("above"),
        F.coalesce("score", F.lit(0.0)).alias("total"), F.col("score").isNotNull().cast("long").alias("n")), "climbed")
    most = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    jumps, reach = [], 1
    while True:
        live = state.where(F.col("above").isNotNull()).select("tree", "node", "above")
        if reach > most or live.isEmpty():
            return state, jumps
        jumps.append(live)
        next_ = state.select("tree", F.col("node").alias("above"), F.col("above").alias("top"),
                             F.col("total").alias("more"), F.col("n").alias("further"), F.lit(True).alias("met"))
        # only messages that have not reached their root are joined
        moved = state.where(F.col("above").isNotNull()).join(next_, ["tree", "above"]).select(
            "tree", "node", F.col("top").alias("above"), (F.col("total") + F.col("more")).alias("total"),
            (F.col("n") + F.col("further")).alias("n"))
        state = written(state.where(F.col("above").isNull()).unionByName(moved), "climbed")
        reach *= 2


def paths(leaves: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """(tree, leaf, node, up) of the paths from ``leaves`` (tree, leaf) to their roots.

    ``up`` is the distance from the leaf. After the jumps of reach 1 .. 2^k a
    path has its 2^(k+1) lowest messages.
    """
    members = leaves.select("tree", "leaf", F.col("leaf").alias("node"), F.lit(0).alias("up"))
    rounds = Rounds("paths")
    for k, jump in enumerate(jumps):
        further = members.join(jump, ["tree", "node"]).select(
            "tree", "leaf", F.col("above").alias("node"), (F.col("up") + 2 ** k).alias("up"))
        members = rounds.write(members.union(further))
    return members


def branches(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, leaf, branch_score) of every root-to-leaf path, and the jumps to enumerate them.

    A branch scores the mean of its messages' scores, nulls left out.
    """
    state, jumps = climbed(_distinct(messages))
    answered = jumps[0].select("tree", F.col("above").alias("node")) if jumps else state.limit(0).select("tree", "node")
    leaves = state.where(F.col("above").isNull()).join(answered, ["tree", "node"], "left_anti")
    return leaves.select("tree", F.col("node").alias("leaf"), F.when(
        F.col("n") > 0, F.col("total") / F.col("n")).alias("branch_score")), jumps


def best_branches(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """(tree, leaf, node, up, branch_score, role, text) of the ``per_tree`` best-scored paths of each tree.

    ``messages``: tree, node, parent, role, text, score. Branches are ranked by
    the totals found along the jumps; only the chosen ones are enumerated.
    """
    found, jumps = branches(messages)
    order = Window.partitionBy("tree").orderBy(F.col("branch_score").desc_nulls_last(), "leaf")
    chosen = written(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_tree)
                          .drop("rank"), "chosen")
    members = paths(chosen, jumps)
    return (members.join(chosen, ["tree", "leaf"])
                   .join(_distinct(messages).select("tree", "node", "role", "text"), ["tree", "node"]))


def conversations(branches: DataFrame) -> DataFrame:
    """(tree, leaf, formatted, spans): each branch as one formatted conversation."""
    grouped = (branches.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(
        F.struct((-F.col("up")).alias("at"), "role", "text"))).alias("turns")))
    spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [formatted([(t["role"], t["text"]) for t in turns]) for turns in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([x[0] for x in out], pa.string()),
                pa.array([[{"start": a, "stop": b} for a, b in x[1]] for x in out], spans)],
                ["tree", "leaf", "formatted", "spans"])

    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
    schema = T.StructType([grouped.schema["tree"], grouped.schema["leaf"],
                           T.StructField("formatted", T.StringType()), T.StructField("spans", T.ArrayType(span))])
    return grouped.mapInArrow(run, schema)


def read_back(rows: DataFrame) -> DataFrame:
    """(tree, leaf) with the digests of what formatted conversations hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                turns = parsed(text)
                said = "".join(f"{r}\n{t}\n" for r, t in turns)
                loss = "".join(unescaped(text[s["start"]:s["stop"]]) for s in spans)
                out.append((len(turns), _sha256(said), len(loss), _sha256(loss), len(text)))
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(
                pa.array(c, t) for c, t in zip(columns, _ARROW))], ["tree", "leaf", *_COLUMNS])

    schema = T.StructType([rows.schema["tree"], rows.schema["leaf"]] + [
        T.StructField(c, T.StringType() if t == pa.string() else T.LongType()) for c, t in zip(_COLUMNS, _ARROW)])
    return rows.select("tree", "leaf", "formatted", "spans").mapInArrow(run, schema)


_COLUMNS = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
_ARROW = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()


def as_trees(turns: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as trees of one branch each.

    Every row answers the row before it in turn (ties: by role, then text);
    assistant texts score by their length.
    """
    tree = F.coalesce(F.concat(F.lit("#"), F.col("conv_id").cast("string")), F.lit("null"))
    order = Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    numbered = turns.select("conv_id", tree.alias("tree"), "turn", "role", "text").withColumn(
        "node", F.row_number().over(order))
    return numbered.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
                           F.when(F.col("role") == LEARNT, F.length("text")).otherwise(0).cast("double").alias("score"))


def format_all(turns: DataFrame) -> DataFrame:
    """conv_id and the digests of every conversation's formatted output, read back from files."""
    messages = written(as_trees(turns), "messages")
    out = written(conversations(best_branches(messages)), "formatted")
    conv_id = F.when(F.col("tree") != "null", F.substring("tree", 2, 1000)).cast(turns.schema["conv_id"].dataType)
    return read_back(out).select(conv_id.alias("conv_id"), *_COLUMNS)


_ORDER = "turn NULLS LAST, role NULLS FIRST, text NULLS FIRST"
_ESCAPED_SQL = rf"regexp_replace({{}}, '([<\[])(\\*){_CONTROL}', '\1\\\2\3', 'g')"
ORACLE_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (SELECT *, coalesce(role, '') AS r, coalesce(text, '') AS x FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY {_ORDER})) AS turns_sha256,
       coalesce(sum(length(x)) FILTER (WHERE r = '{LEARNT}'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(x, '' ORDER BY {_ORDER}) FILTER (WHERE r = '{LEARNT}'), '')) AS loss_sha256,
       sum({len(TURN) + len(TEXT) + len(END)} + length({_ESCAPED_SQL.format('r')})
           + length({_ESCAPED_SQL.format('x')}))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""
