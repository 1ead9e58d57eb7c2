"""Chat formatting of reply trees.

Messages point to the message they reply to. Iterative self-joins double the distance that each message has
followed upward (1, 2, 4, ... replies), summing scores on the way; leaves are ranked within their tree by the score
of their path, and chosen paths are unrolled by the same doubling, so a path of n replies takes log n joins.
Each path becomes one conversation, formatted message by message.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hot_keys, hot_salt, salted_join, written

#: The template's control strings. Inside texts and roles each gets ESCAPE before it, as does ESCAPE itself.
TURN, REPLY, END_TURN, END_REPLY = "[INST]", "[REPLY]", "[/INST]", "</s>"
CONTROL = ("[INST]", "[/INST]", "[REPLY]", "<s>", "</s>")
ESCAPE = "\\"
LEARNED = "assistant"
_ESCAPED = re.compile("|".join(map(re.escape, (ESCAPE, *CONTROL))))
_PARTS = re.compile(rf"\\(.)|({'|'.join(map(re.escape, CONTROL))})", re.S)


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: ESCAPE + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def format_turn(role: str | None, text: str | None) -> str:
    """[REPLY]role\\ntext</s> for the learned role, [INST]role\\ntext[/INST] for others. A role's line breaks are escaped too."""
    a, z = (REPLY, END_REPLY) if role == LEARNED else (TURN, END_TURN)
    return a + escape(role or "").replace("\n", ESCAPE + "\n") + "\n" + escape(text or "") + z


def read_turns(formatted: str) -> list[tuple[str, str, bool]]:
    """(role, text, under the loss mask) of each turn: the inverse of format_turn, for any number of turns."""
    out, at, begun = [], 0, None
    for m in _PARTS.finditer(formatted):
        if m[2] in (TURN, REPLY):
            begun, at = m[2], m.end()
        elif m[2] in (END_TURN, END_REPLY):
            head = re.match(r"(?:\\.|[^\\\n])*", body := formatted[at : m.start()], flags=re.S)[0]
            out.append((unescape(head), unescape(body[len(head) + 1 :]), begun == REPLY))
    return out


def best_paths(nodes: DataFrame, *, keep: int = 1, max_rounds: int = 63) -> DataFrame:
    """(path, node, depth): for each tree of nodes (node, parent, score), its `keep` leaves with the highest sum of scores from the root (ties: smallest leaf), each with all nodes of its path, depth 0 first.

    A parent that doesn't exist, or is null, makes its child a root; null scores count 0. node must be unique. A cycle
    has no root: its nodes, and all below, are left out. A path of n replies takes log2(n) rounds; once 2^rounds
    exceeds the number of nodes, what still has an ancestor is below a cycle. More than max_rounds raises.
    """
    own = written(nodes.select("node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score")), "nodes")
    ids = own.select(F.col("node").alias("parent"), F.lit(True).alias("_there"))
    start = salted_join(own, ids, "parent", hot_salt(own, "parent"), F.col("node"), "left")
    step = written(start.select("node", F.when(F.col("_there"), F.col("parent")).alias("up"), "score", F.when(F.col("_there"), 1).otherwise(0).cast("long").alias("depth"), F.when(F.col("_there"), F.col("parent")).otherwise(F.col("node")).alias("root")), "step")
    jumps = []  # jumps[k]: node and the one 2^k replies above it
    size = own.count()
    ended = done = step.where("up is null")
    live = step.where("up is not null")
    while 2 ** len(jumps) <= size and not live.isEmpty():
        if len(jumps) == max_rounds:
            raise RuntimeError(f"paths are longer than {max_rounds} rounds reach")
        jumps.append(live.select("node", "up"))
        asked = written(live.groupBy("up").agg(F.count("*").alias("n")), "asked")
        # a node that nothing is 2^k replies below has nothing further below: of the ended ones, only those asked for now can be again
        ended = written(ended.join(asked.select(F.col("up").alias("node")), "node", "left_semi"), "ended")
        far = ended.unionByName(live).select(F.col("node").alias("up"), F.col("up").alias("_up"), F.col("score").alias("_score"), F.col("depth").alias("_depth"), F.col("root").alias("_root"))
        moved = salted_join(live, far, "up", hot_keys(asked, "up", "n"), F.col("node"))
        step = written(moved.select("node", F.col("_up").alias("up"), (F.col("score") + F.col("_score")).alias("score"), (F.col("depth") + F.col("_depth")).alias("depth"), F.col("_root").alias("root")), "step")
        now, live = step.where("up is null"), step.where("up is not null")
        ended, done = ended.unionByName(now), done.unionByName(now)
    done = written(done, "done")  # or the join below would be made for the nodes of each round
    leaves = done.join(own.select(F.col("parent").alias("node")).distinct(), "node", "left_anti")
    if keep == 1:  # an aggregate is combined before its shuffle; a hot tree needs no window
        best = leaves.groupBy("root").agg(F.min_by("node", F.struct(-F.col("score"), "node")).alias("node"), F.min_by("depth", F.struct(-F.col("score"), "node")).alias("depth"))
    else:
        best = leaves.withColumn("_k", F.row_number().over(Window.partitionBy("root").orderBy(F.desc("score"), "node"))).where(F.col("_k") <= keep)
    ends = written(best.select(F.col("node").alias("path"), "node", "depth"), "ends")
    path = ends.where("false")
    for k in reversed(range(len(jumps))):
        # nodes of paths so far are at distances that are multiples of 2^(k+1); add those halfway. A path enters once it has 2^k replies
        path = path.unionByName(ends.where((F.col("depth") >= 2**k) & (F.col("depth") < 2 ** (k + 1))))
        up = path.where(F.col("depth") >= 2**k).join(jumps[k], "node").select("path", F.col("up").alias("node"), (F.col("depth") - 2**k).alias("depth"))
        path = written(path.unionByName(up), "paths")
    return path.unionByName(ends.where("depth = 0"))


def formatted_turns(turns: DataFrame) -> DataFrame:
    """turns (path, depth, role, text, ...) with formatted: the piece of the path's conversation that this turn is."""

    @F.pandas_udf("string")
    def form(role: pd.Series, text: pd.Series) -> pd.Series:
        return pd.Series([format_turn(r, t) for r, t in zip(role, text, strict=True)], dtype=object)

    return turns.withColumn("formatted", form("role", "text"))


def conversations_of(turns: DataFrame, key: str = "path") -> DataFrame:
    """(key, conversation): one string for each path, for paths that fit into a row."""
    return formatted_turns(turns).groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("depth", "formatted"))), lambda x: x["formatted"]), "").alias("conversation"))


def digests(turns: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, read back from `formatted`: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Pieces of a key come sorted and are hashed as they pass: a worker holds one turn, however long the conversation.
    """
    names = [key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = object(), None

        def row():
            return pd.DataFrame([(now[1:] if now else None, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])], columns=names)

        out = []
        for b in batches:
            for k, piece in zip(b["_k"], b["formatted"], strict=True):
                if k != now:
                    if state:
                        out.append(row())
                    now, state = k, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[4] += len(piece)
                for role, text, learned in read_turns(piece):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    if learned:
                        state[2] += len(text)
                        state[3].update(text.encode())
            if len(out) > 1000:
                yield pd.concat(out)
                out = []
        if state:
            out.append(row())
        if out:
            yield pd.concat(out)

    ordered = turns.withColumn("_k", F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))).repartition("_k").sortWithinPartitions("_k", *order).select("_k", "formatted")
    kind = turns.schema[key].dataType.simpleString()
    return ordered.mapInPandas(digest, f"{key} string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").withColumn(key, F.col(key).cast(kind))


def linear_trees(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(node, parent, score, conv_id, turn, role, text) of conversations without branches: each row replies to the one before it by turn.

    Rows of equal turn follow one another by role and text; a null turn comes first, null conv_ids are one conversation.
    A node is conv_id and place, as a string.
    """
    w = Window.partitionBy(conv_id).orderBy(turn, role, text)
    at = F.row_number().over(w)
    name = lambda n: F.concat_ws(":", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null")), n.cast("string"))
    return rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"), at.alias("_at")).select("*", name(F.col("_at")).alias("node"), F.when(F.col("_at") > 1, name(F.col("_at") - 1)).alias("parent"), F.lit(0.0).alias("score")).drop("_at")
