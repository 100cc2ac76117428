"""Conversations as training windows within a token budget.

Prefix sums of turn tokens cut a conversation into spans that begin and end with turns. They are taken in two levels,
within parts of the sorted table and over the parts of a conversation, so that a very long conversation spreads over
tasks. A window shows the system turn, some turns of the span before, and its own span; what it repeats is not under the
loss mask, so each assistant text is a target once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadsieve.llm.bpe import read_config
from leadsieve.llm.common import staged, whole
from leadsieve.llm.pieces import slices
from leadsieve.llm.token_files import encoder

BUDGET = 2048
#: Of the budget, for repeated turns; and how many turns are repeated at most.
HISTORY_BUDGET = 256
HISTORY_TURNS = 2

#: What stands before and after a turn's text; other roles are named in their mark.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("<|", "|>", "<|end|>")
#: A control string, or one with backslashes after its first character.
_CONTROL = re.compile(r"([<\[])(\\*)(s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|\|)")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|\|)")
_START = re.compile(r"<<SYS>>|\[INST\]|<s>|<\|(.*?)\|>", re.S)


def escape(text: str) -> str:
    """One backslash more inside each control string, so that none is left; unescape takes it out again."""
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def mark(role: str) -> tuple[str, str]:
    if role in MARKS:
        return MARKS[role]
    return OTHER[0] + role.replace("\\", "\\\\").replace("|", "\\p") + OTHER[1], OTHER[2]


def formatted(turns: list[tuple[str, str]], repeated: int) -> tuple[str, list[tuple[int, int]]]:
    """The text of turns (role, text), and the spans of assistant texts after the first `repeated` turns."""
    parts, spans, at = [], [], 0
    for k, (role, text) in enumerate(turns):
        start, end = mark(role)
        body = escape(text)
        parts += [start, body, end]
        if role == "assistant" and k >= repeated:
            spans.append((at + len(start), at + len(start) + len(body)))
        at += len(start) + len(body) + len(end)
    return "".join(parts), spans


def parsed(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    turns, at = [], 0
    while at < len(text):
        start = _START.match(text, at)
        name = start.group(1)
        role = next((r for r, m in MARKS.items() if m[0] == start.group()), None) if name is None else \
            re.sub(r"\\(.)", lambda m: "|" if m.group(1) == "p" else m.group(1), name)
        end = OTHER[2] if name is not None else MARKS[role][1]
        stop = text.index(end, start.end())
        turns.append((role, unescape(text[start.end():stop])))
        at = stop + len(end)
    return turns


def _turns(conversations: DataFrame, path: str, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id, role, text, tokens (of the formatted turn), row (in order of conversation and turn), part."""
    import pyarrow as pa
    config = conversations.sparkSession.sparkContext.broadcast(read_config(path))  # one tokenizer file
    rows = conversations.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                                whole(role).alias("role"), whole(text).alias("text"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", F.xxhash64("text"), "text"]
    rows = rows.repartitionByRange(*order[:4]).sortWithinPartitions(*order).select(
        "conv_id", "role", "text", F.monotonically_increasing_id().alias("row"), F.spark_partition_id().alias("part"))

    def run(batches):
        tool = encoder(config.value)
        for batch in slices(batches):
            counts = [len(tool.encode(formatted([(r, t)], 0)[0])) // tool.dtype.itemsize
                      for r, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())],
                                             names=[*batch.schema.names, "tokens"])

    return staged(rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField("tokens", T.LongType())])), "turns")


def _before(rows: DataFrame, sums: dict, most: dict) -> DataFrame:
    """Exclusive prefix sums (0 at first) and prefix maxima (null at first) over a conversation, by row.

    Within a part of a conversation by a window, over its parts by one row per part. Also adds the conversation's totals
    of the sums, as <name>_all.
    """
    local = Window.partitionBy("part", "conv_id").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({k: F.coalesce(F.sum(v).over(local), F.lit(0)) for k, v in sums.items()}
                            | {k: F.max(v).over(local) for k, v in most.items()})
    parts = rows.groupBy("part", "conv_id").agg(*[F.sum(v).alias(f"{k}_here") for k, v in sums.items()],
                                                *[F.max(v).alias(f"{k}_here") for k, v in most.items()])
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    entire = Window.partitionBy("conv_id")
    parts = parts.select(
        F.col("part").alias("p_part"), F.col("conv_id").alias("p_conv"),
        *[F.coalesce(F.sum(f"{k}_here").over(earlier), F.lit(0)).alias(f"{k}_base") for k in sums],
        *[F.sum(f"{k}_here").over(entire).alias(f"{k}_all") for k in sums],
        *[F.max(f"{k}_here").over(earlier).alias(f"{k}_base") for k in most])
    joined = rows.join(parts, (rows["part"] == parts["p_part"]) & rows["conv_id"].eqNullSafe(parts["p_conv"]))
    return joined.withColumns({k: F.col(k) + F.col(f"{k}_base") for k in sums}
                              | {k: F.greatest(k, f"{k}_base") for k in most}).drop(
        "p_part", "p_conv", *[f"{k}_base" for k in [*sums, *most]])


def windows(conversations: DataFrame, path: str, budget: int = BUDGET, history_budget: int = HISTORY_BUDGET,
            history_turns: int = HISTORY_TURNS, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """One row per window: conv_id, first_turn (number of its first own turn, from 0), n_turns, n_repeated (how many of
    them, all in front, are repeated), n_tokens, over_budget, formatted, loss (spans in code points).

    Turns are ordered by turn, then role, then text; null turns come first, null roles and texts are empty, rows with a
    null conversation form one conversation, repeated rows are turns of their own. The system turn is the first turn if
    its role is system. A window keeps within the budget, by tokens of its turns one by one; only a turn that doesn't fit
    with the system turn and the repeated ones goes beyond, alone. Columns besides the four are ignored. An empty table
    gives no rows.
    """
    import pyarrow as pa
    turns = _turns(conversations, path, conv_id, turn, role, text)
    kind = turns.schema["conv_id"]
    # Spans are found on narrow rows; texts join once the windows are known.
    rows = turns.select("conv_id", "row", "part", "tokens", (F.col("role") == "system").alias("is_system"))
    rows = _before(rows, {"number": F.lit(1), "sofar": F.col("tokens")}, {})
    rows = rows.withColumn("system", (F.col("number") == 0) & F.col("is_system"))
    # The system turn for each part of its conversation.
    first = rows.filter("system").select(F.col("conv_id").alias("s_conv"), F.col("tokens").alias("s_tokens"),
                                         F.col("row").alias("s_row"))
    parts = rows.select("part", "conv_id").distinct()
    known = parts.join(first, parts["conv_id"].eqNullSafe(first["s_conv"])).select(
        F.col("part").alias("s_part"), "s_conv", "s_tokens", "s_row")
    rows = rows.join(known, (rows["part"] == known["s_part"]) & rows["conv_id"].eqNullSafe(known["s_conv"]), "left")
    # Spans by half of what is left: a turn that begins in a half ends within the whole.
    half = F.greatest(F.lit(1), F.floor((F.lit(budget - history_budget) - F.coalesce("s_tokens", F.lit(0))) / 2))
    rows = rows.withColumn("half", half).withColumn("large", (F.col("tokens") > F.col("half")).cast("int"))
    rows = _before(rows.drop("s_part", "s_conv", "number_all", "sofar_all").withColumn("n_all", F.col("number")),
                   {"larges": F.col("large"), "count": F.lit(1)},
                   {"after": F.when(F.col("large") == 1, F.col("sofar") + F.col("tokens"))})
    rows = rows.withColumn("slot", F.when(F.col("large") == 1, F.lit(0)).otherwise(
        F.floor((F.col("sofar") - F.coalesce("after", F.lit(0))) / F.col("half"))))
    span = Window.partitionBy("conv_id", "larges", "large", "slot")
    tail = span.orderBy(F.desc("number")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"first": F.min("number").over(span), "last": F.max("number").over(span),
                             "tail": F.sum("tokens").over(tail)})
    repeats = (~F.col("system")) & (F.col("last") - F.col("number") < history_turns) & (F.col("tail") <= history_budget) \
        & (F.col("last") + 1 < F.col("count_all"))
    shows = (F.col("first") == F.col("number")) & (F.col("number") > 0) & F.col("s_row").isNotNull()

    def piece(window, repeated, number, tokens, head):
        return F.struct(window.alias("window"), F.lit(repeated).alias("repeated"), number.alias("number"),
                        tokens.alias("tokens"), F.lit(head).alias("head"))

    own = (F.col("number"), F.col("tokens"), False)
    pieces = F.array_compact(F.array(
        piece(F.col("first"), False, *own), F.when(repeats, piece(F.col("last") + 1, True, *own)),
        F.when(shows, piece(F.col("first"), True, F.lit(0).cast("long"), F.col("s_tokens"), True))))
    shown = staged(rows.select("conv_id", "part", "row", F.explode(pieces).alias("p"))
                   .select("conv_id", "part", "row", "p.*"), "pieces")
    texts = turns.select(F.col("row").alias("t_row"), "role", "text")
    # A system turn repeats in each window of its conversation, so its text comes by part and not by row.
    heads = known.join(texts, F.col("s_row") == F.col("t_row")).select("s_part", "s_conv", "role", "text")
    whole_pieces = [
        shown.filter("not head").join(texts, F.col("row") == F.col("t_row")),
        shown.filter("head").join(heads, (shown["part"] == heads["s_part"]) & shown["conv_id"].eqNullSafe(heads["s_conv"]))]
    plain, system = [p.select("conv_id", "window", "repeated", "number", "tokens", "role", "text") for p in whole_pieces]
    made = (plain.unionAll(system).groupBy("conv_id", "window").agg(  # turns of one window, which the budget bounds
                F.array_sort(F.collect_list(F.struct("number", "repeated", "role", "text"))).alias("turns"),
                F.sum("tokens").alias("n_tokens")))
    schema = T.StructType([kind, *T.StructType.fromDDL(
        "first_turn long, n_turns long, n_repeated long, n_tokens long, over_budget boolean, formatted string, "
        "loss array<struct<start: int, end: int>>").fields])

    def run(batches):
        for batch in slices(batches):
            out = []
            for turns in batch.column(2).to_pylist():
                repeated = sum(t["repeated"] for t in turns)
                shown, spans = formatted([(t["role"], t["text"]) for t in turns], repeated)
                out.append((len(turns), repeated, shown, [{"start": a, "end": b} for a, b in spans]))
            n_turns, n_repeated, shown, loss = map(list, zip(*out, strict=True))
            tokens = batch.column(3)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_turns, pa.int64()), pa.array(n_repeated, pa.int64()), tokens,
                 pa.array([t > budget for t in tokens.to_pylist()]), pa.array(shown, pa.string()),
                 pa.array(loss, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], names=schema.names)

    return made.select("conv_id", "window", "turns", "n_tokens").mapInArrow(run, schema)


DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted_windows: DataFrame) -> DataFrame:
    """What windows hold, read back from their text, per conversation: its turns without repeated ones, the text under the
    loss mask without escapes, and the length of all windows. A conversation's windows pass one by one, in order."""
    import pyarrow as pa
    kind = formatted_windows.schema["conv_id"]
    schema = T.StructType([kind, *T.StructType.fromDDL(DIGESTS).fields])
    rows = formatted_windows.select("conv_id", "first_turn", "n_repeated", "formatted", "loss")

    def run(batches) -> Iterator:
        def result(conv):
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], kind_), *[pa.array([v], t) for v, t in zip(
                    (turns, turns_hash.hexdigest(), loss, loss_hash.hexdigest(), chars),
                    (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)]], names=schema.names)

        now, begun = None, False
        for batch in slices(batches):
            kind_ = batch.schema.field(0).type
            for conv, _, repeated, shown, spans in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if not begun or conv != now:
                    if begun:
                        yield result(now)
                    now, begun, turns, loss, chars = conv, True, 0, 0, 0
                    turns_hash, loss_hash = hashlib.sha256(), hashlib.sha256()
                for role, text in parsed(shown)[repeated:]:
                    turns += 1
                    turns_hash.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for span in spans:
                    text = unescape(shown[span["start"]:span["end"]])
                    loss += len(text)
                    loss_hash.update(text.encode("utf-8", "surrogatepass"))
                chars += len(shown)
        if begun:
            yield result(now)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "first_turn").mapInArrow(run, schema)
