"""Chat formatting in budgeted windows with a loss mask, and reading it back."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import materialize, send_code, text_of, token_counts
from .merkle import numbered

OPEN, CLOSE = "<turn {}>\n", "\n</turn>\n"
LEARNED = "assistant"
SEGMENT = 1024  # turns
WINDOWS = "conv_id long, segment long, window long, n_tokens long, n_repeated int, formatted string, loss array<struct<start: int, end: int>>"
SUMMARY = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
           "n_windows long")


class Budget(NamedTuple):
    tokens: int = 512  # of a window
    history: int = 128  # of the repeated turns in it, the system turn apart
    history_turns: int = 4


def escape(text: str) -> str:
    """A backslash before each backslash and opening bracket, so that no text holds an unescaped mark."""
    return text.replace("\\", "\\\\").replace("<", "\\<")


def escape_role(role: str) -> str:
    return escape(role).replace(">", "\\>").replace("\n", "\\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its text starts and ends in it."""
    head = OPEN.format(escape_role(role))
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


TURN = re.compile(r"<turn ((?:[^\\<>\n]|\\.)*)>\n((?:[^\\<]|\\.)*?)\n</turn>\n", re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    turns, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


class Turn(NamedTuple):
    tokens: int
    formatted: str
    start: int
    end: int
    learned: bool


def windows(turns, budget: Budget):
    """(repeated, new) lists of turns for one segment, from (Turn, kind): "system" and "history" come from
    earlier segments, "first system" is new and opens the conversation, all others are "new".

    A window takes new turns as long as the prefix sum of their tokens stays within the budget. The next one
    starts with the system turn and with the latest turns whose sum fits into the history allowance and leaves room
    for the first new turn. A turn that does not fit beside the system turn gets a window of its own.
    """
    system: list[Turn] = []
    past: list[Turn] = []
    repeated: list[Turn] = []
    new: list[Turn] = []
    used = 0

    def start(room: int) -> list[Turn]:
        sums = [0]
        for t in past:
            sums.append(sums[-1] + t.tokens)
        first = bisect_left(sums, sums[-1] - max(0, min(budget.history, room)))
        return system + past[first:]

    for turn, kind in turns:
        if kind == "system":
            system = [turn]
            continue
        if kind == "history":
            past = (past + [turn])[-budget.history_turns:]
            continue
        if not new and not repeated and (past or system):
            repeated = start(budget.tokens - sum(t.tokens for t in system) - turn.tokens)
            used = sum(t.tokens for t in repeated)
        if new and used + turn.tokens > budget.tokens:
            yield repeated, new
            new = []
            repeated = start(budget.tokens - sum(t.tokens for t in system) - turn.tokens)
            used = sum(t.tokens for t in repeated)
        new.append(turn)
        used += turn.tokens
        if kind == "first system":
            system = [turn]
        else:
            past = (past + [turn])[-budget.history_turns:]
    if new:
        yield repeated, new


def format_conversations(conversations: DataFrame, budget: Budget = Budget(), ranks: str | None = None, segment: int = SEGMENT) -> DataFrame:
    """conv_id, segment, window, n_tokens, n_repeated, formatted, loss: every conversation in windows of whole turns.

    The first turn, if it is a system turn, opens every window of its conversation; up to `history` tokens of the turns before a
    window are repeated after it. loss holds the spans (code points of formatted) of the assistant texts that are new
    in the window; repeated ones are masked, so each is learned once. The first n_repeated turns are repeats.

    A conversation is cut into segments of `segment` turns, by their place in it; segments are formatted in parallel, each
    given its conversation's system turn and the turns before it. So neither the numbers of the turns nor a very long conversation, nor
    many rows of one turn, decide a task's size. A task streams over its sorted rows and holds one window.

    Order: turn (nulls first), role, text. Null text or role: empty. Rows without a conv_id form one conversation.
    Repeated rows are turns of their own. A turn longer than the budget: a window above the budget. Empty table: no
    rows. Other columns are ignored.
    """
    send_code(conversations.sparkSession)
    key = F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit(""))  # as text, which holds every long beside nulls
    rows = conversations.select(key.alias("conv_id"), F.col("turn").cast("long").alias("turn"), text_of("role").alias("role"), text_of().alias("text"))
    rows = materialize(numbered(rows, "conv_id", ["turn", "role", "text"], "turns").drop("n"), "placed")
    rows = rows.withColumn("segment", F.floor(F.col("idx") / segment).cast("long"))
    later = materialize(rows.filter(F.col("idx") % segment == 0).filter("segment > 0").select("conv_id", "segment"), "segments")
    last = rows.filter(F.col("idx") % segment >= segment - budget.history_turns).withColumn("segment", F.col("segment") + 1)
    tail = last.join(later, ["conv_id", "segment"], "left_semi").withColumn("kind", F.lit(1))
    heads = rows.filter("idx = 0 and role = 'system'").drop("segment").join(later, "conv_id").withColumn("kind", F.lit(0))
    everything = rows.withColumn("kind", F.lit(2)).unionByName(tail).unionByName(heads)

    @F.pandas_udf("int")
    def cost(roles: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series(token_counts([format_turn(r, t)[0] for r, t in zip(roles, texts)], ranks), dtype="int32")

    keys = ["conv_id", "segment"]
    ordered = (everything.withColumn("tokens", cost("role", "text")).repartition(*keys)
               .sortWithinPartitions(*keys, "kind", "idx"))

    def run(batches):
        out = []

        def rows_of(batches):
            for b in batches:
                yield from zip(b["conv_id"].tolist(), b["segment"].tolist(), b["kind"].tolist(), b["role"], b["text"], b["tokens"].tolist())

        def close(key, made):
            for k, (repeated, new) in enumerate(made):
                at, loss, parts = 0, [], []
                for place, t in enumerate(repeated + new):
                    if t.learned and place >= len(repeated):
                        loss.append({"start": at + t.start, "end": at + t.end})
                    parts.append(t.formatted)
                    at += len(t.formatted)
                out.append((key[0], int(key[1]), k, sum(t.tokens for t in repeated + new),
                            len(repeated), "".join(parts), loss))

        def frame():
            made = pd.DataFrame(out, columns=["conv_id", "segment", "window", "n_tokens", "n_repeated", "formatted", "loss"])
            out.clear()
            return made

        stream = rows_of(batches)
        row = next(stream, None)
        while row is not None:
            key = (row[0], row[1])

            def segment():
                nonlocal row
                begun = False
                while row is not None and row[:2] == key:
                    _, seg, kind, role, text, tokens = row
                    turn = Turn(tokens, *format_turn(role, text), role == LEARNED)
                    name = ("system", "history", "new")[kind]
                    if kind == 2 and not begun and seg == 0 and role == "system":
                        name = "first system"
                    begun = True
                    row = next(stream, None)
                    yield turn, name

            close(key, windows(segment(), budget))
            if len(out) >= 1000:
                yield frame()
        yield frame()

    made = ordered.mapInPandas(run, WINDOWS.replace("conv_id long", "conv_id string"))
    return made.withColumn("conv_id", F.nullif("conv_id", F.lit("")).cast("long"))


def read_back(formatted: DataFrame) -> DataFrame:
    """From formatted windows alone, for every conversation: conv_id, n_turns, turns_sha256 (role, newline, text,
    newline of every turn), loss_chars and loss_sha256 (the unescaped text under the mask), formatted_chars, n_windows.

    A task streams over its conversations' windows in order and holds one window and the running digests. A conversation's digest can only
    be taken in order, so it is one task's reading, however long it is."""
    named = formatted.withColumn("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    ordered = named.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "window")

    def run(batches):
        out, state, current = [], None, object()

        def close():
            if state:
                out.append((state["id"], state["turns"], state["all"].hexdigest(), state["loss"], state["learned"].hexdigest(), state["chars"], state["windows"]))

        def frame():
            made = pd.DataFrame(out, columns=[c.split()[0] for c in SUMMARY.split(", ")])
            out.clear()
            return made

        for b in batches:
            for conv, repeated, text, loss in zip(b["conv_id"].tolist(), b["n_repeated"].tolist(), b["formatted"], b["loss"]):
                if state is None or conv != current:
                    close()
                    current = conv
                    state = {"id": conv, "turns": 0, "all": hashlib.sha256(), "loss": 0, "learned": hashlib.sha256(), "chars": 0, "windows": 0}
                for role, said in parse(text)[repeated:]:
                    state["all"].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                    state["turns"] += 1
                for span in loss:
                    said = unescape(text[span["start"]:span["end"]])
                    state["learned"].update(said.encode("utf-8", "surrogatepass"))
                    state["loss"] += len(said)
                state["chars"] += len(text)
                state["windows"] += 1
            yield frame()
        close()
        yield frame()

    found = ordered.mapInPandas(run, SUMMARY.replace("conv_id long", "conv_id string"))
    return found.withColumn("conv_id", F.nullif("conv_id", F.lit("")).cast("long"))
