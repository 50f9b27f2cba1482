"""Chat formatting: preference pairs as one prompt and two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

OPEN, CLOSE = "<|{}|>\n", "<|end|>\n"


def render(turns: Column) -> Column:
    """Turns (structs of role and text) as text."""
    return F.array_join(
        F.transform(
            turns, lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit(CLOSE))
        ),
        "",
    )


def masks(turns: Column) -> Column:
    """Character ranges (start, end) of ``render(turns)`` that carry loss: assistants' text and its end mark."""
    step = lambda a, t: F.struct(
        (a["at"] + F.length(t["role"]) + 5 + F.length(t["text"]) + len(CLOSE)).alias("at"),
        F.when(
            t["role"] == "assistant",
            F.concat(
                a["out"],
                F.array(
                    F.struct(
                        (a["at"] + F.length(t["role"]) + 5).alias("start"),
                        (a["at"] + F.length(t["role"]) + 5 + F.length(t["text"]) + len(CLOSE)).alias("end"),
                    )
                ),
            ),
        ).otherwise(a["out"]).alias("out"),
    )
    start = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out")
    )
    return F.aggregate(turns, start, step)["out"]


def conversation_turns(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, turns): one array of (role, text) per conversation, in order of turn.

    Null roles and texts become empty strings; of rows that share a turn number all stay, ordered
    by role and text. A conversation is the unit of work, so its turns meet in one row.
    """
    t = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return turns.groupBy(key).agg(F.array_sort(F.collect_list(t)).alias("t")).select(
        key, F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns")
    )


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Adds n_prompt_turns, prompt, chosen_text, rejected_text, chosen_mask, rejected_mask, usable.

    ``pairs`` has chosen and rejected, arrays of (role, text). Their longest common prefix of
    turns is the prompt and is rendered once; what follows on either side is a completion, whose
    mask holds the character ranges that carry loss (assistants' turns). A null array is an empty
    one. ``usable`` is false where either completion holds no assistant's turn, as with equal
    conversations. All other columns stay, so ``pairs`` mustn't have one of the added names. Texts
    are rendered as they are; a text that itself holds a mark such as <|end|> is in its own turn's
    range all the same, since ranges are counted, not searched. Rows are worked on one by one: no shuffle.
    """
    added = {"n_prompt_turns", "prompt", "chosen_text", "rejected_text", "chosen_mask", "rejected_mask", "usable"}
    if clash := added & set(pairs.columns):
        raise ValueError(f"columns that would be overwritten: {sorted(clash)}")
    empty = F.array().cast("array<struct<role:string,text:string>>")
    a, b = F.coalesce("chosen", empty), F.coalesce("rejected", empty)
    both = F.least(F.size(a), F.size(b))
    same = F.zip_with(F.slice(a, F.lit(1), both), F.slice(b, F.lit(1), both), lambda x, y: x == y)
    n = F.when(F.array_position(same, F.lit(False)) > 0, F.array_position(same, F.lit(False)) - 1).otherwise(both).cast("int")
    out = pairs.withColumn("n_prompt_turns", n)
    rest = lambda x: F.slice(x, F.col("n_prompt_turns") + 1, F.greatest(F.size(x) - F.col("n_prompt_turns"), F.lit(0)))
    out = out.withColumns({
        "prompt": render(F.slice(a, F.lit(1), F.col("n_prompt_turns"))),
        "chosen_text": render(rest(a)),
        "rejected_text": render(rest(b)),
        "chosen_mask": masks(rest(a)),
        "rejected_mask": masks(rest(b)),
    })
    return out.withColumn("usable", (F.size("chosen_mask") > 0) & (F.size("rejected_mask") > 0))


def derived_pairs(conversations: DataFrame) -> DataFrame:
    """Preference pairs from plain conversations, as the table holds none.

    Conversation 2i is chosen over one that shares its first half of turns (rounded down) and goes
    on with what conversation 2i + 1 has from there. A conversation without a partner is paired
    with its own first half. Each turn moves once, and every conversation with an id is used;
    turns without one belong to none and are left out.
    """
    convs = conversation_turns(conversations)
    one = F.struct((F.col("conv_id") % 2).alias("side"), "conv_id", "turns")
    both = convs.where("conv_id is not null").groupBy(F.shiftright(F.col("conv_id").cast("long"), 1).alias("pair_id")).agg(F.array_sort(F.collect_list(one)).alias("c"))
    left, right = F.element_at("c", 1), F.when(F.size("c") > 1, F.element_at("c", 2))
    half = F.floor(F.size(left["turns"]) / 2).cast("int")
    other = F.coalesce(right["turns"], F.array().cast("array<struct<role:string,text:string>>"))
    tail = F.slice(other, half + 1, F.greatest(F.size(other) - half, F.lit(0)))
    return both.select(
        "pair_id", left["turns"].alias("chosen"), F.concat(F.slice(left["turns"], F.lit(1), half), tail).alias("rejected")
    )


def op7_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = format_pairs(derived_pairs(table(spark, sf_dir, "conversations")))
    marks = lambda c: F.array_join(F.transform(c, lambda m: F.concat_ws(":", m["start"], m["end"])), ",")
    return out.select(
        "pair_id", F.col("n_prompt_turns").cast("long").alias("n_prompt_turns"), "prompt", "chosen_text", "rejected_text",
        marks("chosen_mask").alias("chosen_mask"), marks("rejected_mask").alias("rejected_mask"), "usable",
    )


_RENDER = "array_to_string(list_transform({x}, lambda t: '<|' || t.role || '|>' || chr(10) || t.text || '<|end|>' || chr(10)), '')"
_BEFORE = "coalesce(list_sum(list_transform({x}[1:i - 1], lambda t: length(t.role) + length(t.text) + 13)), 0)"
_MARKS = (
    "array_to_string(list_transform(list_filter(range(1, len({x}) + 1), lambda i: {x}[i].role = 'assistant'), lambda i: "
    "CAST(" + _BEFORE + " + length({x}[i].role) + 5 AS BIGINT) || ':' || CAST(" + _BEFORE + " + length({x}[i].role) + 13 + length({x}[i].text) AS BIGINT)), ',')"
)
OP7_SQL = f"""
WITH t AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn, coalesce(role, ''), coalesce(text, '')) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), p AS (
  SELECT conv_id // 2 AS pair_id, list(ts ORDER BY conv_id) AS c FROM t GROUP BY 1
), q AS (
  SELECT pair_id, c[1] AS chosen, len(c[1]) // 2 AS half, CASE WHEN len(c) > 1 THEN c[2] ELSE c[1][1:0] END AS other FROM p
), r AS (
  SELECT pair_id, chosen, list_concat(chosen[1:half], other[half + 1:len(other)]) AS rejected FROM q
), n AS (
  SELECT *, least(len(chosen), len(rejected)) AS m,
         list_position(list_transform(range(1, least(len(chosen), len(rejected)) + 1), lambda i: chosen[i] = rejected[i]), false) AS differs FROM r
), k AS (
  SELECT pair_id, chosen, rejected, CAST(CASE WHEN coalesce(differs, 0) > 0 THEN differs - 1 ELSE m END AS BIGINT) AS n_prompt_turns FROM n
), s AS (
  SELECT pair_id, n_prompt_turns, chosen[1:n_prompt_turns] AS prompt, chosen[n_prompt_turns + 1:len(chosen)] AS a, rejected[n_prompt_turns + 1:len(rejected)] AS b FROM k
), u AS (
  SELECT pair_id, n_prompt_turns, {_RENDER.format(x='prompt')} AS prompt, {_RENDER.format(x='a')} AS chosen_text, {_RENDER.format(x='b')} AS rejected_text,
         {_MARKS.format(x='a')} AS chosen_mask, {_MARKS.format(x='b')} AS rejected_mask FROM s
)
SELECT *, chosen_mask != '' AND rejected_mask != '' AS usable FROM u
"""
