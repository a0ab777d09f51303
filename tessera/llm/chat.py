"""Chat formatting as prefix trees.

Conversations that share initial turns are merged: the tokens of shared turns are written once,
depth first, and every token has a position id (its depth in its own conversation) and the intervals
of its ancestors, which are all that it may attend to besides its own turn.  Header, text and end of
a turn are encoded each for itself, so the loss mask begins and ends with tokens; special tokens that
a text spells out are ordinary text, never their ids.

Conversations are sorted by the path of their turns' hashes, which puts a tree's leaves in
depth-first order whatever its size, and each task merges neighbours into packs of bounded length.
A tree larger than a pack goes on in the next one, which repeats the open path.  So a first turn
that a third of all conversations share is spread over tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Bpe, ForcedBoundaryBPE
from .workers import lean

PACK_CHARS = 1 << 16
ASSISTANT = "assistant"
#: The template: <turn ROLE>TEXT</turn>, each on a line of its own.  In texts and roles a backslash
#: is doubled and a control string gets one before it; in roles also > and the line end.
OPEN, SHUT, CLOSE = "<turn ", ">", "</turn>\n"
_CONTROL = re.compile(r"\\|</turn>|<turn ")
_ROLE_CONTROL = re.compile(r"\\|</turn>|<turn |>")
_ESCAPED = re.compile(r"\\(\\|</turn>|<turn |>)")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def escape_role(role: str) -> str:
    return _ROLE_CONTROL.sub(lambda m: "\\" + m[0], role)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """Header, body and end of a formatted turn."""
    return f"{OPEN}{escape_role(role)}{SHUT}", escape(text), CLOSE


_TOKEN = re.compile(r"\\(?:\\|</turn>|<turn |>)|</turn>\n|<turn |>")


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) turns of a formatted conversation."""
    turns, state, start, role = [], "out", 0, ""
    for m in _TOKEN.finditer(formatted):
        mark = m[0]
        if mark == OPEN and state == "out":
            state, start = "role", m.end()
        elif mark == SHUT and state == "role":
            role, state, start = unescape(formatted[start : m.start()]), "text", m.end()
        elif mark == CLOSE and state == "text":
            turns.append((role, unescape(formatted[start : m.start()])))
            state = "out"
    return turns


PACKS = (
    "ids array<int>, nodes array<struct<start:bigint,length:bigint,parent:int,position:bigint,loss_start:bigint,loss_length:bigint,"
    "ancestors:array<struct<start:bigint,end:bigint>>>>, leaves array<struct<path_key:string,node:int>>"
)


def _laid_out(coder: ForcedBoundaryBPE, tree: list[tuple[int, bool, tuple[str, str, str]]]) -> tuple[np.ndarray, list[dict]]:
    """Token ids and nodes of a pack's turns: parent, loss or not, parts."""
    encoded = coder.encode(pa.array([x for *_, parts in tree for x in parts], pa.string()))
    ends = np.concatenate([[0], np.cumsum([len(x) for x in encoded])]).tolist()
    nodes: list[dict] = []
    for k, (parent, loss, _) in enumerate(tree):
        start, head, body, end = ends[3 * k : 3 * k + 4]
        above = nodes[parent] if parent >= 0 else None
        nodes.append(
            {
                "start": start,
                "length": end - start,
                "parent": parent,
                "position": above["position"] + above["length"] if above else 0,
                "loss_start": head if loss else -1,
                "loss_length": body - head if loss else 0,
                "ancestors": [*above["ancestors"], {"start": above["start"], "end": above["start"] + above["length"]}] if above else [],
            }
        )
    return encoded.flatten().to_numpy(), nodes


def _packs(paths: Iterator[tuple[str, list[tuple[str, str]]]], most: int, coder: ForcedBoundaryBPE) -> Iterator[tuple]:
    """Packs of consecutive conversations (path key, turns): ids, nodes, leaves."""
    tree, leaves, size = [], [], 0
    stack: list[tuple[tuple[str, str], int]] = []  # open path: turn, node
    for key, turns in paths:
        shared = 0
        while shared < min(len(stack), len(turns)) and stack[shared][0] == turns[shared]:
            shared += 1
        parts = [turn_parts(*t) for t in turns]
        new = sum(len(x) for p in parts[shared:] for x in p)
        if leaves and size + new > most:
            yield *_laid_out(coder, tree), leaves
            tree, leaves, size, stack, shared = [], [], 0, [], 0
        del stack[shared:]
        for turn, own in list(zip(turns, parts))[shared:]:
            tree.append((stack[-1][1] if stack else -1, turn[0] == ASSISTANT, own))
            size += sum(map(len, own))
            stack.append((turn, len(tree) - 1))
        leaves.append({"path_key": key, "node": stack[-1][1] if stack else -1})
    if leaves:
        yield *_laid_out(coder, tree), leaves


def _sequences(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turns, path_key) of each conversation."""
    clean = turns.select(F.col(conv_id).alias("conv_id"), F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    own = clean.where("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    own = own.unionByName(clean.where("conv_id is null").select("conv_id", F.array("t").alias("ts")))
    own = own.select("conv_id", F.transform("ts", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    hashes = F.transform("turns", lambda t: F.substring(F.sha2(F.concat(F.length(t["role"]).cast("string"), F.lit(":"), t["role"], t["text"]), 256), 1, 32))
    return own.withColumn("path_key", F.array_join(hashes, ""))


def prefix_packs(turns: DataFrame, coder: Bpe, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", *, pack_chars: int = PACK_CHARS) -> tuple[DataFrame, DataFrame]:
    """(packs, members).  packs: ids (tokens of the formatted turns, shared ones once, depth first),
    nodes (start, length, parent, position id of the first token, loss interval, ancestors'
    intervals, all in tokens), leaves (path_key, node).  members: (conv_id, path_key); conversations
    of equal turns share a leaf.  A pack holds at most pack_chars characters.

    Turns are ordered by turn, then role, then text; null roles and texts count as empty, and each
    row of null conv_id is a conversation of its own; repeated rows are turns of their own; a conversation longer
    than pack_chars is a pack by itself; an empty table gives empty results; other columns are not
    read.
    """
    own = _sequences(turns, conv_id, turn, role, text)
    members = own.select("conv_id", "path_key")
    paths = own.groupBy("path_key").agg(F.first("turns").alias("turns"))
    # a sort needs its input twice (bounds, then rows), both from one shuffle
    ordered = paths.repartitionByRange("path_key").sortWithinPartitions("path_key")
    worker = coder.worker(ordinary=True)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for frame in lean(frames):
                for key, turns in zip(frame["path_key"], frame["turns"]):
                    yield key, [(t["role"], t["text"]) for t in turns]

        for pack in _packs(rows(), pack_chars, worker()):
            yield pd.DataFrame([pack], columns=["ids", "nodes", "leaves"])

    return ordered.mapInPandas(run, PACKS), members


LEAVES = "path_key string, formatted string, turns array<struct<role:string,text:string>>, loss string"


def _texts(coder: ForcedBoundaryBPE, ids: np.ndarray, nodes: list[dict]) -> tuple[dict[tuple[int, int], str], list[str]]:
    """Text of each node by its interval, and the text under its loss interval."""
    bounds = [0]
    for n in nodes:
        end = n["start"] + n["length"]
        loss = n["loss_start"] if n["loss_start"] >= 0 else end
        bounds += (loss, loss + n["loss_length"], end)
    parts = coder.decode(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))).to_pylist()
    whole = {(n["start"], n["start"] + n["length"]): "".join(parts[3 * k : 3 * k + 3]) for k, n in enumerate(nodes)}
    return whole, parts[1::3]


def read_packs(packs: DataFrame, coder: Bpe) -> DataFrame:
    """(path_key, formatted, turns, loss) of each leaf, read back from packs alone: the text of the
    path's intervals joined, its parsed turns, and the unescaped text under the loss intervals."""
    worker = coder.worker(ordinary=True)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in lean(frames):
            for ids, nodes, leaves in zip(frame["ids"], frame["nodes"], frame["leaves"]):
                whole, under = _texts(worker(), ids, nodes)
                out = []
                for leaf in leaves:
                    k = leaf["node"]
                    path = []
                    while k >= 0:
                        path.append(k)
                        k = nodes[k]["parent"]
                    path.reverse()
                    last = nodes[path[-1]] if path else None
                    spans = [*((s["start"], s["end"]) for s in last["ancestors"]), (last["start"], last["start"] + last["length"])] if last else []
                    formatted = "".join(whole[s] for s in spans)
                    loss = "".join(unescape(under[k]) for k in path if nodes[k]["loss_start"] >= 0)
                    out.append((leaf["path_key"], formatted, [{"role": r, "text": t} for r, t in parse(formatted)], loss))
                for lo in range(0, len(out), 64):
                    yield pd.DataFrame(out[lo : lo + 64], columns=["path_key", "formatted", "turns", "loss"])

    return packs.mapInPandas(run, LEAVES)
