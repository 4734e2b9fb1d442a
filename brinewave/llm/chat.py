r"""Chat formatting on prefix trees: conversations that share initial turns share their tokens.

A turn is written as ``<|start|>role``, a line feed, its text and ``<|end|>``, a line feed. Inside roles and texts a
backslash, ``<`` and ``[`` are escaped (``\\``, ``\l``, ``\b``; in roles a line feed too, ``\n``), so that no control
string of this or of another bracketed template can arise from a text; ``unescape`` is the exact inverse. Tokens are code points.

Distinct conversations are range-partitioned and sorted by the hashes of their turns. In that order the turns that a
conversation does not share with the one before are what a depth-first walk of the tree emits next, so a task walks its
range as a stream with one path in memory. A pack is one training sequence, cut once it holds ``PACK`` tokens; a tree
larger than a pack goes on in the next one, which begins with the path at hand. Position ids count along the path of a
token, not along the pack, and a token attends to the intervals of its ancestors and to its own node before it.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinewave.llm.base import column, held, prepared

START, END = "<|start|>", "<|end|>\n"
PACK = 65_536
ESCAPES = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
PACKS = (
    "pack_id string, text string, "
    "nodes array<struct<start:int,end:int,position:int,parent:int,loss_start:int,loss_end:int,"
    "ancestors:array<struct<start:int,end:int>>>>, leaves array<struct<path_id:string,node:int>>"
)
READ = "path_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: Column) -> Column:
    for plain, written in ESCAPES.items():
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: str) -> str:
    back = {"\\": "\\", "l": "<", "b": "[", "n": "\n"}
    return re.sub(r"\\(.)", lambda m: back[m[1]], text)


def formatted(conversations: DataFrame) -> DataFrame:
    """``conv_id, path_id, turns`` with one row a conversation; a turn has its written form and where its loss lies.

    Turns go by number, missing first, then by role and text. Null roles and texts are empty. Rows without conv_id are one
    conversation. Loss is on the texts of assistant turns.
    """
    rows = conversations.select(
        column(conversations, "conv_id").alias("conv_id"),
        F.struct(
            column(conversations, "turn").alias("turn"),
            F.coalesce(column(conversations, "role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(column(conversations, "text").cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )

    def write(t: Column) -> Column:
        role = F.replace(escape(t["role"]), F.lit("\n"), F.lit("\\n"))
        head = F.concat(F.lit(START), role, F.lit("\n"))
        text = escape(t["text"])
        size = F.when(t["role"] == "assistant", F.length(text)).otherwise(0)
        return F.struct(F.concat(head, text, F.lit(END)).alias("text"), F.length(head).alias("loss"), size.alias("size"))

    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    out = grouped.select("conv_id", F.transform("t", write).alias("turns"))
    whole = F.array_join(F.transform("turns", lambda t: t["text"]), "")
    return out.withColumn("path_id", F.sha2(whole.cast("binary"), 256))


def packs(paths: DataFrame, limit: int = PACK) -> DataFrame:
    """Packs of the distinct ``path_id, turns``: text, nodes in depth-first order, and the node where each path ends."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts: list[str] = []
        nodes: list[dict] = []
        leaves: list[dict] = []
        path: list[tuple[str, int]] = []
        size = 0

        def pack() -> pd.DataFrame:
            return pd.DataFrame([{"pack_id": leaves[0]["path_id"], "text": "".join(texts), "nodes": nodes, "leaves": leaves}])

        for pdf in batches:
            for path_id, turns in zip(pdf["path_id"], pdf["turns"]):
                shared = 0
                while shared < min(len(path), len(turns)) and path[shared][0] == turns[shared]["text"]:
                    shared += 1
                if leaves and size + sum(len(t["text"]) for t in turns[shared:]) > limit:
                    yield pack()
                    texts, nodes, leaves, path, size, shared = [], [], [], [], 0, 0
                del path[shared:]
                for t in turns[shared:]:
                    parent = path[-1][1] if path else -1
                    above = nodes[parent] if path else None
                    ancestors = [] if above is None else joined([*above["ancestors"], {"start": above["start"], "end": above["end"]}])
                    position = 0 if above is None else above["position"] + above["end"] - above["start"]
                    end = size + len(t["text"])
                    nodes.append({
                        "start": size, "end": end, "position": position, "parent": parent,
                        "loss_start": size + t["loss"], "loss_end": size + t["loss"] + t["size"], "ancestors": ancestors,
                    })
                    texts.append(t["text"])
                    path.append((t["text"], len(nodes) - 1))
                    size = end
                leaves.append({"path_id": path_id, "node": path[-1][1]})
        if leaves:
            yield pack()

    ordered = paths.withColumn("order", F.transform("turns", lambda t: F.xxhash64(t["text"])))
    ordered = ordered.repartitionByRange("order", "path_id").sortWithinPartitions("order", "path_id")
    return ordered.select("path_id", "turns").mapInPandas(walk, PACKS)


def joined(intervals: list[dict]) -> list[dict]:
    """Adjacent intervals as one."""
    out: list[dict] = []
    for i in intervals:
        if out and out[-1]["end"] == i["start"]:
            out[-1] = {"start": out[-1]["start"], "end": i["end"]}
        else:
            out.append(i)
    return out


def read_back(packed: DataFrame) -> DataFrame:
    """What the packs say of each path: the turns along its attention intervals and the text under its loss mask."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text, nodes, leaves in zip(pdf["text"], pdf["nodes"], pdf["leaves"]):
                for leaf in leaves:
                    node = nodes[leaf["node"]]
                    whole = "".join(text[i["start"] : i["end"]] for i in [*node["ancestors"], node])
                    turns = [t.split("\n", 1) for t in re.findall(r"<\|start\|>([^<]*)<\|end\|>\n", whole)]
                    said = "".join(f"{unescape(role)}\n{unescape(body)}\n" for role, body in turns)
                    loss, at = [], leaf["node"]
                    while at >= 0:
                        loss.append(text[nodes[at]["loss_start"] : nodes[at]["loss_end"]])
                        at = nodes[at]["parent"]
                    learned = unescape("".join(reversed(loss)))
                    rows.append((
                        leaf["path_id"], len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned),
                        hashlib.sha256(learned.encode()).hexdigest(), len(whole),
                    ))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in READ.split(", ")])

    return packed.mapInPandas(read, READ)


def digests(conversations: DataFrame, limit: int = PACK) -> DataFrame:
    """``conv_id`` and what reading back its path from the packs gives. Equal conversations share one path.

    Repeated rows are repeated turns. An empty table gives no row. Other columns are ignored.
    """
    prepared(conversations.sparkSession)
    all_ = held(formatted(conversations))
    paths = all_.groupBy("path_id").agg(F.first("turns").alias("turns"))
    return all_.select("conv_id", "path_id").join(read_back(packs(paths, limit)), "path_id").drop("path_id")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
