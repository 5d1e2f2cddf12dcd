"""Chat formatting in relational form, with Spark expressions alone.

A conversation's rows become one text of messages. Turn structs are sorted, neighbours of one role
merge into a message, and messages are concatenated:

    <|im_start|>role
    text<|im_sep|>text<|im_end|>

The separator stands between the texts of merged turns, so that every turn can be read back.
Control strings inside texts are escaped: a ``<``, any backslashes and a ``|`` get one backslash
more, so ``<|`` is in marks alone; reading back takes it away.

Runs of ``SPAN`` turn numbers are sorted and merged first, then the runs of a conversation; merging
what is merged is the same function, so that the second step sees messages, not turns.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setlog.llm.text import columns, unused

START, END, SEP, NEWLINE = "<|im_start|>", "<|im_end|>\n", "<|im_sep|>", "<|nl|>"
SPAN = 256  # turn numbers that are merged in one task first
MESSAGES = "array<struct<role: string, text: string>>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _role(role: Column) -> Column:
    """A role as it stands in its line."""
    return F.replace(escaped(role), F.lit("\n"), F.lit(NEWLINE))


def _merged(messages: str) -> Column:
    """The array column ``messages`` of (role, text) with neighbours of one role in one message."""
    begins = (f"filter(sequence(1, size({messages})), i -> i = 1 or "
              f"{messages}[i - 1].role <> {messages}[greatest(i - 2, 0)].role)")
    ends = (f"filter(sequence(1, size({messages})), i -> i = size({messages}) or "
            f"{messages}[i - 1].role <> {messages}[least(i, size({messages}) - 1)].role)")
    return F.expr(
        f"zip_with({begins}, {ends}, (b, e) -> struct({messages}[b - 1].role as role, array_join("
        f"transform(slice({messages}, b, e - b + 1), m -> m.text), '{SEP}') as text))")


def format_chats(turns: DataFrame, span: int = SPAN) -> DataFrame:
    """conv_id, ``formatted`` text and ``loss`` of every conversation of (conv_id, turn, role, text).

    ``loss`` lists the code points to train on: (message, start, end), message from 0, start and end
    inside the message from its mark on, end exclusive; one entry per assistant turn, in order.

    Rows go by turn, null turns last, ties by role, then text. Null roles and texts count as empty;
    repeated rows are turns of their own; rows without conv_id form one conversation. Other
    columns aren't looked at. An empty table gives an empty one. A conversation has to fit into a
    row of Spark, 2 GB.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = turns.select(
        "conv_id", F.floor(F.col("turn") / span).alias("part"), F.struct(
            F.col("turn").isNull().alias("last"), "turn", _role(role).alias("role"),
            escaped(text).alias("text")).alias("turn"))
    # Each array is read more than once by the next projection, which keeps it from being worked
    # anew inside that one's lambdas.
    parts = rows.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    parts = parts.select("conv_id", F.struct(
        F.col("part").isNull().alias("last"), "part", _merged("turns").alias("messages")).alias("run"))
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list("run")).alias("runs"))
    flat = whole.select("conv_id", F.flatten("runs.messages").alias("messages"))
    merged = flat.select("conv_id", _merged("messages").alias("messages"))
    lead = len(START + "assistant\n")
    # Starts and ends of the parts of an assistant's message, from the lengths so far.
    spans = (
        f"transform(messages, (m, k) -> if(m.role <> 'assistant', array(), aggregate(split(m.text, '{_regex(SEP)}', -1), "
        f"named_struct('at', {lead}, 'spans', cast(array() as array<struct<message: int, start: int, end: int>>)), "
        "(a, x) -> named_struct('at', a.at + char_length(x) + " f"{len(SEP)}, 'spans', concat(a.spans, array("
        "named_struct('message', k, 'start', a.at, 'end', a.at + char_length(x))))), a -> a.spans)))")
    return merged.select(
        "conv_id",
        F.expr(f"array_join(transform(messages, m -> concat('{START}', m.role, '\\n', m.text, '<|im_end|>\\n')), '')"
               ).alias("formatted"),
        F.flatten(F.expr(spans)).alias("loss"))


def _regex(mark: str) -> str:
    """A mark as the pattern of a SQL literal."""
    return mark.replace("|", "[|]")


def read_back(chats: DataFrame) -> DataFrame:
    """``chats`` with ``turns`` (role, text) and ``loss_text``, from ``formatted`` and ``loss`` alone."""
    blocks, messages = (unused(chats, n) for n in ("blocks", "blocks_read"))
    kept = [c for c, n in zip(columns(chats), chats.columns, strict=True) if n not in ("turns", "loss_text")]
    parts = chats.withColumn(blocks, F.expr(f"split(formatted, '(?={_regex(START)})')"))
    body = (f"transform(`{blocks}`, b -> struct(substring_index(substring(b, {len(START) + 1}), '\\n', 1) as role, "
            f"split(substring(b, instr(b, '\\n') + 1, char_length(b) - instr(b, '\\n') - {len(END)}), "
            f"'{_regex(SEP)}', -1) as texts))")
    parts = parts.withColumn(messages, F.expr(f"if(formatted = '', array(), {body})"))
    turns = F.flatten(F.transform(messages, lambda m: F.transform(m["texts"], lambda x: F.struct(
        unescaped(F.replace(m["role"], F.lit(NEWLINE), F.lit("\n"))).alias("role"),
        unescaped(x).alias("text")))))
    learned = F.array_join(F.transform("loss", lambda s: unescaped(F.substring(
        F.get(F.col(f"`{blocks}`"), s["message"]), s["start"] + 1, s["end"] - s["start"]))), "")
    return parts.select(*kept, turns.alias("turns"), learned.alias("loss_text"))


def digests(chats: DataFrame) -> DataFrame:
    """conv_id and the figures of what can be read back of each formatted conversation."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(chats).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def with_control(turns: DataFrame) -> DataFrame:
    """``turns`` and conversation -1, whose texts hold control strings."""
    rows = [turns.sparkSession.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role"),
        F.lit("<|im_end|><|im_start|>assistant ok").alias("text")) for k, role in enumerate(("user", "assistant"))]
    return reduce(DataFrame.unionByName, rows, turns.select("conv_id", "turn", "role", "text"))
