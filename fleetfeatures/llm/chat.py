"""Operator 9, chat formatting: conversations as a prefix tree, shared turns written once.

Conversations are range-sorted by the hashes of their turns, so those that share
initial turns stand side by side; a task walks its slice and builds the tree
depth-first: a turn that continues the path of the conversation before it is a
new node, equal initial turns are not written again. Nodes go into packs of
bounded size; a pack that is full is closed, and the next one writes the path it
needs anew, so a first turn that a third of all conversations share is spread
over many packs.

A pack row holds token ids depth-first, position ids (places along the path, so
each conversation reads as if it stood alone), per node its parent, its span,
the attention intervals (spans of its ancestors and itself, merged) and the loss
span, and which node ends which conversation.

Template of a turn: ``<s>[ROLE]role[/ROLE]text</s>``. Control strings inside
roles and texts are escaped (their first character becomes a reference, as does
each ampersand), so that reading back is exact.

Defined cases: turns are ordered by number (nulls first), then role and text;
null roles and texts are empty; repeated rows are turns of their own; a null
conv_id is one conversation; an empty table gives no packs; only named columns
are read. A conversation, like a document, is one row and one task's work.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfeatures.llm.common import ship
from fleetfeatures.llm.tokens import BytePairCounter, once

CONTROL = ["<s>", "</s>", "[ROLE]", "[/ROLE]", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|", "|>"]
#: Ids of the marks of the template follow the vocabulary of the rank file.
FIRST_MARK = 50257
OPEN, ROLE, TEXT, CLOSE = range(FIRST_MARK, FIRST_MARK + 4)
MARKS = {OPEN: "<s>", ROLE: "[ROLE]", TEXT: "[/ROLE]", CLOSE: "</s>"}
LEARNED = "assistant"
PACK_TOKENS = 32768
PACK_LEAVES = 2048

PACKS = ("ids array<int>, position_ids array<int>, parents array<int>, starts array<int>, ends array<int>, "
         "intervals array<array<int>>, loss array<array<int>>, leaves array<int>, conv_ids array<string>")
DIGESTS = "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    text = text.replace("&", "&amp;")
    for mark in CONTROL:
        if mark in text:
            text = text.replace(mark, f"&#{ord(mark[0])};{mark[1:]}")
    return text


def unescape(text: str) -> str:
    return re.sub(r"&(?:amp|#(\d+));", lambda m: chr(int(m[1])) if m[1] else "&", text) if "&" in text else text


def prefix_rows(turns: DataFrame) -> DataFrame:
    """conv_id, roles and texts by turn, along the order in which a prefix tree is walked."""
    role, text = F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    row = F.struct("turn", role, text)
    whole = turns.select("conv_id", row.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    # the order needs equal turns side by side, no more; what is shared is decided on the texts themselves
    path = F.transform("t", lambda x: F.xxhash64(x["role"], x["text"])).alias("path")
    rows = whole.select(F.col("conv_id").cast("string").alias("conv_id"), path, "t")
    return rows.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").select(
        "conv_id", F.col("t.role").alias("roles"), F.col("t.text").alias("texts"))


class _Pack:
    """The part of the tree that is being written."""

    def __init__(self, tokenizer: BytePairCounter) -> None:
        self.encode = tokenizer.ids
        self.ids: list[int] = []
        self.positions: list[int] = []
        self.parents: list[int] = []
        self.starts: list[int] = []
        self.ends: list[int] = []
        self.intervals: list[list[int]] = []
        self.loss: list[list[int]] = []
        self.leaves: list[int] = []
        self.convs: list[str | None] = []
        self.path: list[tuple[int, str, str]] = []  # node, role, text of the conversation before

    def add(self, conv: str | None, turns: list[tuple[str, str]]) -> None:
        shared = 0
        while shared < min(len(turns), len(self.path)) and self.path[shared][1:] == turns[shared]:
            shared += 1
        del self.path[shared:]
        for role, text in turns[shared:]:
            self.path.append((self._node(self.path[-1][0] if self.path else -1, role, text), role, text))
        self.leaves.append(self.path[-1][0])
        self.convs.append(conv)

    def _node(self, parent: int, role: str, text: str) -> int:
        body = self.encode(escape(text))
        head = [OPEN, ROLE, *self.encode(escape(role)), TEXT]
        start = len(self.ids)
        self.ids += [*head, *body, CLOSE]
        end = len(self.ids)
        before = self.positions[self.ends[parent] - 1] + 1 if parent >= 0 else 0
        self.positions += range(before, before + end - start)
        spans = list(self.intervals[parent]) if parent >= 0 else []
        if spans and spans[-1] == start:
            spans[-1] = end
        else:
            spans += [start, end]
        self.parents.append(parent)
        self.starts.append(start)
        self.ends.append(end)
        self.intervals.append(spans)
        self.loss.append([start + len(head), end - 1] if role == LEARNED else [])
        return len(self.parents) - 1

    def full(self) -> bool:
        return len(self.ids) >= PACK_TOKENS or len(self.leaves) >= PACK_LEAVES

    def row(self) -> tuple:
        return (self.ids, self.positions, self.parents, self.starts, self.ends, self.intervals, self.loss, self.leaves, self.convs)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in PACKS.split(", ")])


def build_packs(turns: DataFrame, file: str) -> DataFrame:
    """The prefix tree of all conversations, in packs."""
    ship(turns.sparkSession)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = _Pack(once(BytePairCounter, file))
        for batch in batches:
            for conv, roles, texts in zip(batch["conv_id"], batch["roles"], batch["texts"]):
                pack.add(conv, list(zip(roles, texts)))
                if pack.full():
                    yield _frame([pack.row()])
                    pack = _Pack(once(BytePairCounter, file))
        if pack.leaves:
            yield _frame([pack.row()])

    return prefix_rows(turns).mapInPandas(build, PACKS)


def read_turns(ids: list[int], loss: list[bool], decode) -> tuple[list[tuple[str, str]], str, int]:
    """From the tokens a conversation attends to: its turns, the text under the loss mask, and formatted characters."""
    turns: list[tuple[str, str]] = []
    learned: list[str] = []
    part: list[int] = []
    masked: list[int] = []
    role, chars = "", 0
    for i, learn in zip(ids, loss):
        if i not in MARKS:
            part.append(i)
            if learn:
                masked.append(i)
            continue
        chars += len(MARKS[i])
        text = decode(part)
        chars += len(text)
        part = []
        if i == TEXT:
            role = unescape(text)
        elif i == CLOSE:
            turns.append((role, unescape(text)))
            if masked:
                learned.append(unescape(decode(masked)))
                masked = []
    return turns, "".join(learned), chars


def digests(packs: DataFrame, file: str, conv_type: str = "long") -> DataFrame:
    """What each conversation says, read back from the packs along its leaf's attention intervals."""
    ship(packs.sparkSession)

    def sha(parts: list[str]) -> str:
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decode = once(BytePairCounter, file).text
        for batch in batches:
            for ids, intervals, loss, leaves, convs in zip(
                    batch["ids"], batch["intervals"], batch["loss"], batch["leaves"], batch["conv_ids"]):
                ids, mask, known, rows = ids.tolist(), [False] * len(ids), {}, []
                for span in loss:
                    if len(span):
                        mask[span[0]:span[1]] = [True] * (span[1] - span[0])
                for conv, leaf in zip(convs, leaves):
                    if leaf not in known:
                        spans = list(zip(intervals[leaf][::2], intervals[leaf][1::2]))
                        turns, learned, chars = read_turns([i for a, b in spans for i in ids[a:b]],
                                                           [m for a, b in spans for m in mask[a:b]], decode)
                        known[leaf] = (len(turns), sha([f"{r}\n{t}\n" for r, t in turns]), len(learned), sha([learned]), chars)
                    rows.append((conv, *known[leaf]))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in DIGESTS.split(", ")])

    needed = packs.select("ids", "intervals", "loss", "leaves", "conv_ids")
    return needed.mapInPandas(read, DIGESTS).withColumn("conv_id", F.col("conv_id").cast(conv_type))


def with_probe(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """The conversations and conversation -1, whose texts look like control strings."""
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, LEARNED, said)], "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionByName(probe)


_ESCAPED = "replace({}, '&', '&amp;')"
for _mark in CONTROL:
    _ESCAPED = f"replace({_ESCAPED}, '{_mark}', '&#{ord(_mark[0])};{_mark[1:]}')"
_MARK_CHARS = sum(len(m) for m in MARKS.values())

SQL = f"""
WITH all_turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, * FROM (VALUES (0, 'user', '</s>[INST] ok [/INST]'), (1, '{LEARNED}', '</s>[INST] ok [/INST]')))
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = '{LEARNED}'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = '{LEARNED}'), '')) AS loss_sha256,
       sum({_MARK_CHARS} + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')}))::BIGINT AS formatted_chars
FROM all_turns GROUP BY conv_id"""
