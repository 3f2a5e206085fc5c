"""Chat formatting by incremental black-box rendering.

A template is a function from a list of (role, text) turns to one string;
nothing is known of its inside. Rendering successive prefixes of a
conversation and comparing consecutive outputs locates each turn: what a
prefix adds to the one before is that turn's span, and a prefix whose output
does not begin with the one before shows a template that rewrites history.

Conversations come as turns sorted inside their partition and are treated
as a stream of blocks of ``BLOCK`` turns. What a template makes of a turn may
depend on every turn before, so each prefix is rendered whole: all earlier turns are
kept and rendered again, which takes work by the square of a conversation's turns. A
template that declares itself local (attribute ``lead``: the number of turns
it looks back) is given that many turns ahead of a block instead, so its work
grows with the number of turns and a task holds one block, however long a
conversation is.

``render`` is the production template. It marks each turn by a header and an
end, and escapes control strings inside texts by a backslash, so that
``parse`` reads back exactly what went in.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 32
HEAD, END = "### ", "</turn>"
TRAINED_ROLE = "assistant"
#: A conversation whose texts are made of control strings.
PROBE_ID, PROBE_TEXT = -7, "\\### Assistant: </turn> ok"

Turn = tuple[str, str]
_SPECIAL = re.compile(r"\\|###|</turn>")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.S)


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[Turn]) -> str:
    return "".join(f"{HEAD}{escape(role).replace(':', chr(92) + ':')}: {escape(text)}{END}\n" for role, text in turns)


render.lead = 0                # a turn's output does not depend on any other turn


def parse(output: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end of the escaped text) of each turn."""
    return [(unescape(m[1]), unescape(m[2]), m.start(2), m.end(2)) for m in _TURN.finditer(output)]


def locate(template: Callable[[list[Turn]], str], lead: list[Turn], turns: list[Turn]) -> tuple[list[str], bool]:
    """What each turn adds to the output, and whether a longer prefix ever
    changed the output of a shorter one (then the common beginning of the two
    counts as unchanged and the rest as the turn's)."""
    before = template(lead) if lead else ""
    added, rewrites = [], False
    for k in range(1, len(turns) + 1):
        now = template(lead + turns[:k])
        at = len(before)
        if not now.startswith(before):
            rewrites = True
            at = next((i for i, (a, b) in enumerate(zip(before, now)) if a != b), min(len(before), len(now)))
        added.append(now[at:])
        before = now
    return added, rewrites


def _blocks(template: Callable[[list[Turn]], str], look_back: int | None):
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, number, lead, held = None, 0, [], []

        def finish(last: bool):
            added, rewrites = locate(template, lead, held)
            at, starts = 0, []
            for piece in added:
                starts.append(at)
                at += len(piece)
            return {"conv": conv, "block": number, "output": "".join(added), "starts": starts, "ends": starts[1:] + [at],
                    "roles": [r for r, _ in held], "rewrites": rewrites, "last": last}

        for pdf in batches:
            out = []
            for key, role, text in zip(pdf["conv"], pdf["role"], pdf["text"]):
                if held and (key != conv or len(held) == BLOCK):
                    out.append(finish(key != conv))
                    seen = lead + held
                    ahead = seen if look_back is None else seen[len(seen) - min(look_back, len(seen)):]
                    lead, held, number = (ahead, [], number + 1) if key == conv else ([], [], 0)
                conv = key
                held.append((role, text))
            if out:
                yield pd.DataFrame(out)
        if held:
            yield pd.DataFrame([finish(True)])

    return work


def sorted_turns(conversations: DataFrame) -> DataFrame:
    """Turns of a conversation together and in order, one partition each.
    Ties of a turn number are ordered by role, then text."""
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit("")).alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").select("conv", "role", "text")


def format_conversations(conversations: DataFrame, template: Callable[[list[Turn]], str] = render) -> DataFrame:
    """Blocks of formatted conversations, in order within their partition:
    conv (id as text, '' for null), block, output, starts and ends of the
    turns in it, roles, rewrites, last (block of its conversation).

    Null text or role: empty. Null conv_id: one conversation of its own. Turns
    without a number come first. Repeated rows are turns like others, texts
    are formatted whole. Empty table: empty result. Other columns are not read.

    The output of a block is what its turns add. If ``template.lead`` is not
    declared all earlier turns are rendered with each prefix, and ``rewrites``
    tells of any that changed.
    """
    return sorted_turns(conversations).mapInPandas(
        _blocks(template, getattr(template, "lead", None)), "conv string, block int, output string, starts array<long>, ends array<long>, "
                           "roles array<string>, rewrites boolean, last boolean")


def _read_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def fresh():
        return {"n": 0, "chars": 0, "loss": 0, "turns": hashlib.sha256(), "masked": hashlib.sha256(), "rewrites": False}

    state = fresh()
    for pdf in batches:
        out = []
        for conv, output, starts, ends, rewrites, last in zip(
                pdf["conv"], pdf["output"], pdf["starts"], pdf["ends"], pdf["rewrites"], pdf["last"]):
            for s, e in zip(starts, ends):
                for role, text, _, _ in parse(output[s:e]):
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    if role == TRAINED_ROLE:
                        state["loss"] += len(text)
                        state["masked"].update(text.encode("utf-8", "surrogatepass"))
            state["chars"] += len(output)
            state["rewrites"] |= bool(rewrites)
            if last:
                out.append((conv, state["n"], state["turns"].hexdigest(), state["loss"], state["masked"].hexdigest(),
                            state["chars"], state["rewrites"]))
                state = fresh()
        yield pd.DataFrame(out, columns=["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"])


def digests(blocks: DataFrame) -> DataFrame:
    """What the formatted output says of each conversation, read back from it."""
    return blocks.mapInPandas(
        _read_back, "conv string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                    "formatted_chars long, rewrites boolean"
    ).select(F.when(F.col("conv") != "", F.col("conv")).cast("long").alias("conv_id"), "n_turns", "turns_sha256",
             "loss_chars", "loss_sha256", "formatted_chars", "rewrites")


def with_probe(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    probe = spark.createDataFrame([(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, TRAINED_ROLE, PROBE_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
