"""Chat formatting with Spark expressions only: from rows of turns to one text a conversation, and back.

The turn structs of a conversation are collected and sorted. An array aggregation then folds them in order: its state
holds the role of the open block and the characters written so far, so a turn of that role is merged into the block and any
other turn closes it and opens the next; each turn leaves the characters before its text and its place. Spark copies the state
of a fold at every step, so slices of ``SLICE`` turns are folded apart, each from the role before it and without texts; sums of
their lengths then place the slices, and the texts are joined once. The template is

    ``<|turn|>role<|text|>text<|end|>`` for a block, with ``<|next|>`` between the merged turns of a block.

Inside roles and texts every ``<|`` is written ``<|raw|>`` so that no control string can stand there; reading back
undoes this, so formatting is reversible for any text. The loss mask covers the texts of the assistant's turns:
``loss_spans`` are (start, length) in characters of the formatted text.

Defined results: a null text is empty, a null role is the empty role; turns are ordered by turn (nulls first), then
role, then text, so ties and repeated rows have a fixed place and all count; rows with a null conversation id
form one conversation; an empty table gives an empty result; other columns are not read. A conversation is one value, so
it must fit into a row (2 GB), like any text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkcat.llm.registry import query, table

#: Turns that one inner fold takes.
SLICE = 32
TURN, TEXT, END, NEXT, RAW = "<|turn|>", "<|text|>", "<|end|>", "<|next|>", "<|raw|>"


def _split(value: Column, mark: str) -> Column:
    return F.split(value, "\\Q" + mark + "\\E", -1)


def escape(value: Column) -> Column:
    return F.replace(value, F.lit("<|"), F.lit(RAW))


def unescape(value: Column) -> Column:
    return F.replace(value, F.lit(RAW), F.lit("<|"))


def _state(role: Column, at: Column, heads: Column) -> Column:
    """What the fold carries: role of the open block, characters so far, and for each turn its head and the place of its text."""
    return F.struct(role.alias("role"), at.alias("at"), heads.alias("heads"))


def _fold_turn(state: Column, turn: Column) -> Column:
    """Merge a turn into the open block if it has that block's role, else close the block and open another."""
    close = F.when(state["role"].isNull(), F.lit("")).otherwise(F.lit(END))
    head = F.when(state["role"] == turn["role"], F.lit(NEXT)).otherwise(F.concat(close, F.lit(TURN), turn["name"], F.lit(TEXT)))
    start = state["at"] + F.length(head)
    return _state(turn["role"], start + turn["size"], F.array_append(state["heads"], F.struct(head.alias("head"), start.alias("start"))))


def format_chats(turns: DataFrame, *, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learn: str = "assistant") -> DataFrame:
    """``conv_id``, ``formatted`` and ``loss_spans`` (array of start and length, in characters of ``formatted``) of each conversation."""
    rows = turns.select(turns[id].alias("conv_id"), turns[turn].alias("turn"), F.coalesce(turns[role], F.lit("")).alias("role"), F.coalesce(turns[text], F.lit("")).alias("text"))
    collected = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("sorted"))
    ready = collected.select("conv_id", F.transform("sorted", lambda t: F.struct(
        t["role"].alias("role"), escape(t["role"]).alias("name"), escape(t["text"]).alias("text"), F.length(escape(t["text"])).cast("long").alias("size"))).alias("ts"))
    none = F.array().cast("array<struct<head:string,start:bigint>>")
    slices = F.transform(F.sequence(F.lit(0), F.floor((F.size("ts") - 1) / SLICE).cast("int")), lambda i: F.aggregate(
        F.slice("ts", i * SLICE + 1, SLICE), _state(F.get("ts", i * SLICE - 1)["role"], F.lit(0).cast("long"), none), _fold_turn))
    folded = ready.select("conv_id", "ts", slices.alias("slices"))
    places = F.aggregate("slices", F.array(F.lit(0).cast("long")), lambda at, one: F.array_append(at, F.element_at(at, -1) + one["at"]))
    moved = F.zip_with("slices", F.slice(places, 1, F.size("slices")), lambda one, at: F.transform(
        one["heads"], lambda h: F.struct(h["head"].alias("head"), (h["start"] + at).alias("start"))))
    placed = folded.select("conv_id", "ts", F.flatten(moved).alias("heads"))
    pieces = placed.select("conv_id", F.zip_with("heads", "ts", lambda h, t: F.struct(
        t["role"].alias("role"), F.concat(h["head"], t["text"]).alias("piece"), h["start"].alias("start"), t["size"].alias("size"))).alias("pieces"))
    formatted = F.concat(F.array_join(F.transform("pieces", lambda p: p["piece"]), ""), F.lit(END))
    spans = F.transform(F.filter("pieces", lambda p: p["role"] == learn), lambda p: F.struct(p["start"].alias("start"), p["size"].alias("length")))
    return pieces.select("conv_id", formatted.alias("formatted"), spans.alias("loss_spans"))


def read_chats(chats: DataFrame) -> DataFrame:
    """The turns of each formatted conversation, in order: ``conv_id`` and ``turns`` (array of role and text)."""
    blocks = F.filter(_split(F.col("formatted"), END), lambda b: F.startswith(b, F.lit(TURN)))
    def turns(block: Column) -> Column:
        halves = _split(F.substring(block, len(TURN) + 1, 1 << 30), TEXT)
        return F.transform(_split(halves[1], NEXT), lambda t: F.struct(unescape(halves[0]).alias("role"), unescape(t).alias("text")))
    return chats.select("conv_id", F.flatten(F.transform(blocks, turns)).alias("turns"))


def masked_text(chats: DataFrame) -> DataFrame:
    """The unescaped texts under the loss mask, nothing between them: ``conv_id`` and ``masked``."""
    cut = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return chats.select("conv_id", F.array_join(cut, "").alias("masked"))


SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
o AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS prev FROM c),
e AS (SELECT *, length(replace(text, '<|', '<|raw|>')) + CASE WHEN prev IS NOT NULL AND prev = role THEN 8 ELSE 23 + length(replace(role, '<|', '<|raw|>')) END AS n FROM o)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op6_chat_formatting", SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts look like control strings, formatted and read back."""
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    chats = format_chats(told.unionByName(own))
    back = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    both = chats.select("conv_id", "formatted", "loss_spans")
    turns = read_chats(both.select(F.struct("*").alias("conv_id"), "formatted")).select("conv_id.*", "turns")
    masked = masked_text(turns.select(F.struct("*").alias("conv_id"), "formatted", "loss_spans")).select("conv_id.*", "masked")
    return masked.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(back, 256).alias("turns_sha256"),
                         F.length("masked").cast("long").alias("loss_chars"), F.sha2("masked", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
