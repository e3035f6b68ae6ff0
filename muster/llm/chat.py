"""Chat formatting with Spark expressions only: collected turns, one marked string per conversation."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.llm.tables import table

# The template. Every mark starts with "<" and holds no other "<" or "[".
OPEN, SAY, NEXT, CLOSE = "<|turn|>", "<|says|>", "<|next|>", "<|end|>"
# Marks of other templates, which a text may not smuggle into the output either.
FOREIGN = ("<s>", "</s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
PROBE = "</s>[INST] ok [/INST]"


def _control(marks: tuple[str, ...]) -> str:
    """Alternatives of what follows the first character of the marks, by that character."""
    for mark in marks:
        if len(mark) < 2 or mark[0] not in "<[" or re.search(r"[<\[\\]", mark[1:]):
            raise ValueError(f"a mark starts with < or [ and holds no other, nor a backslash: {mark}")
    tails = {first: sorted({m[1:] for m in marks if m[0] == first}, reverse=True) for first in "<["}
    return {first: "|".join(map(re.escape, found)) for first, found in tails.items() if found}


def escape(text: Column, marks: tuple[str, ...]) -> Column:
    """One backslash more after the first character of each mark, also of marks escaped before."""
    for first, tails in _control(marks).items():
        text = F.regexp_replace(text, f"({re.escape(first)})(\\\\*)({tails})", "$1\\\\$2$3")
    return text


def unescape(text: Column, marks: tuple[str, ...]) -> Column:
    """Inverse of ``escape``."""
    for first, tails in _control(marks).items():
        text = F.regexp_replace(text, f"({re.escape(first)})\\\\(\\\\*)({tails})", "$1$2$3")
    return text


def format_chats(turns: DataFrame, foreign: tuple[str, ...] = FOREIGN) -> DataFrame:
    """One row per ``conv_id``: ``formatted``, and ``pieces`` of it with their loss mask.

    Turns are collected as structs and sorted by turn, role and text (null turn first). Adjacent turns
    of one role merge into one block ``<|turn|>role<|says|>text<|next|>text<|end|>``. Marks inside
    roles and texts are escaped, so the marks of the template are the only ones in the output and
    ``read_back`` recovers each turn. ``pieces`` concatenate to ``formatted``; those with ``loss``
    hold exactly the escaped texts of assistant turns.

    Null role or text: empty. Repeated turns stay, each as its own. Rows of a null ``conv_id`` are one
    conversation. Very long texts are formatted whole. Empty table: no rows. Extra columns are not read. A conversation is one value of the
    output, so one task holds it: that is the bound on a group here.
    """
    marks = (OPEN, SAY, NEXT, CLOSE, *foreign)
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("row"),
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("turns"))
    # Each turn beside the role before and after it: a block opens and closes where the role changes.
    shifted = sorted_turns.select(
        "conv_id",
        "turns",
        F.expr("concat(array(cast(null as string)), transform(slice(turns, 1, size(turns) - 1), t -> t.role))")
        .alias("before"),
        F.expr("concat(transform(slice(turns, 2, size(turns)), t -> t.role), array(cast(null as string)))")
        .alias("after"),
    )
    beside = shifted.select("conv_id", F.arrays_zip("turns", "before", "after").alias("beside"))

    def pieces(x: Column) -> Column:
        role, text = x["turns"]["role"], x["turns"]["text"]
        opens = ~x["before"].eqNullSafe(role)
        closes = ~x["after"].eqNullSafe(role)
        head = F.when(opens, F.concat(F.lit(OPEN), escape(role, marks), F.lit(SAY))).otherwise(NEXT)
        tail = F.when(closes, F.lit(CLOSE)).otherwise("")

        def piece(value: Column, loss: Column) -> Column:
            return F.struct(value.alias("piece"), loss.alias("loss"))

        return F.array(
            piece(head, F.lit(False)),
            piece(escape(text, marks), role == "assistant"),
            piece(tail, F.lit(False)),
        )

    parts = beside.select("conv_id", F.flatten(F.transform("beside", pieces)).alias("pieces"))
    return parts.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
        "pieces",
    )


def read_back(formatted: Column, foreign: tuple[str, ...] = FOREIGN) -> Column:
    """Array of (role, text) turns, parsed from a formatted string."""
    marks = (OPEN, SAY, NEXT, CLOSE, *foreign)
    blocks = F.filter(F.split(formatted, re.escape(CLOSE)), lambda b: b != "")

    def turns(block: Column) -> Column:
        sides = F.split(F.substr(block, F.lit(len(OPEN) + 1)), re.escape(SAY))
        return F.transform(
            F.split(sides[1], re.escape(NEXT)),
            lambda text: F.struct(
                unescape(sides[0], marks).alias("role"), unescape(text, marks).alias("text")
            ),
        )

    return F.flatten(F.transform(blocks, turns))


def op3_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and a probe that holds foreign marks, read back from their formatted strings."""
    columns = ["conv_id", "turn", "role", "text"]
    given = table(spark, folder, "conversations").select(*columns)
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    marks = (OPEN, SAY, NEXT, CLOSE, *FOREIGN)
    formatted = format_chats(given.unionByName(probe))
    back = formatted.select(
        "conv_id",
        "formatted",
        read_back(F.col("formatted")).alias("turns"),
        F.array_join(
            F.transform(F.filter("pieces", lambda p: p["loss"]), lambda p: unescape(p["piece"], marks)), ""
        ).alias("loss"),
    )
    digest = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(digest, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def sql() -> str:
    """The same from the table: blocks are counted where the role changes, escapes by their marks."""
    marks = (OPEN, SAY, NEXT, CLOSE, *FOREIGN)
    escaped = lambda column: "length({0}) + {1}".format(
        column,
        " + ".join(
            f"len(regexp_extract_all({column}, '{re.escape(first)}\\\\*(?:{tails})'))"
            for first, tails in _control(marks).items()
        ),
    )
    return f"""
with given as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{PROBE}'
  union all select -1, 1, 'assistant', '{PROBE}'
), placed as (
  select *, lag(role) over (partition by conv_id order by turn, role, text) as before,
    row_number() over (partition by conv_id order by turn, role, text) as place
  from given
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by place)) as loss_sha256,
  cast(sum({escaped('text')}
    + case when before is distinct from role
      then {len(OPEN) + len(SAY) + len(CLOSE)} + {escaped('role')} else {len(NEXT)} end) as bigint)
    as formatted_chars
from placed group by conv_id"""
