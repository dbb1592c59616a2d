"""Preference formatting: common turns once as prompt, two masked completions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.shared import read_table

TURNS = "array<struct<role:string,text:string>>"
MADE = ("prompt", "prompt_turns", "chosen_text", "chosen_mask", "rejected_text", "rejected_mask")
#: The role whose turns are trained on.
TRAINED = "assistant"


def rendered(turn) -> F.Column:
    """A turn as text; a null role or text counts as empty."""
    return F.concat(F.lit("<|"), F.coalesce(turn["role"], F.lit("")), F.lit("|>\n"), F.coalesce(turn["text"], F.lit("")), F.lit("\n<|end|>\n"))


def common_turns(a: str, b: str) -> F.Column:
    """Length of the longest common prefix of two arrays of turns; turns are equal if role and text are (null: empty)."""
    n = F.least(F.size(a), F.size(b))
    equal = lambda x, y, f: F.coalesce(x[f], F.lit("")) == F.coalesce(y[f], F.lit(""))
    same = F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: equal(x, y, "role") & equal(x, y, "text"))
    first = F.array_position(same, False)
    return F.when(first == 0, n).otherwise((first - 1).cast("int"))


def spans(turns) -> F.Column:
    """``[start, end)`` in characters of the trained turns' text and end mark within the rendered turns."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state, turn):
        whole, head = F.length(rendered(turn)), F.length(F.coalesce(turn["role"], F.lit(""))) + 5
        own = F.struct((state["at"] + head).alias("start"), (state["at"] + whole - 1).alias("end"))
        more = F.when(turn["role"] == TRAINED, F.concat(state["spans"], F.array(own))).otherwise(state["spans"])
        return F.struct((state["at"] + whole).alias("at"), more.alias("spans"))

    return F.aggregate(turns, start, step, lambda state: state["spans"])


def preference_format(pairs: DataFrame) -> DataFrame:
    """Adds prompt, prompt_turns, chosen_text, chosen_mask, rejected_text, rejected_mask to pairs of conversations.

    ``pairs``: any columns, with ``chosen`` and ``rejected`` as arrays of
    struct(role, text). The longest common prefix of turns is rendered once as
    prompt; what follows in either is its completion. A mask lists the character
    spans of the completion that count in training: the assistant's text and end
    mark. A null conversation counts as one without turns; if both are equal the
    completions are empty and their masks too. Other columns stay, but for those
    named like one of the six, which give way. Repeated rows are formatted alike;
    an empty table gives no rows. Nothing is shuffled.
    """
    empty = F.array().cast(TURNS)
    stay = [c for c in pairs.columns if c not in ("chosen", "rejected", *MADE)]
    rows = pairs.select(F.struct(F.lit(0).alias("_"), *stay).alias("row"), *(F.coalesce(F.col(c).cast(TURNS), empty).alias(c) for c in ("chosen", "rejected")))
    rows = rows.withColumn("n", common_turns("chosen", "rejected"))
    out = [*(F.col("row")[c].alias(c) for c in stay), F.array_join(F.transform(F.slice("chosen", F.lit(1), F.col("n")), rendered), "").alias("prompt"), F.col("n").alias("prompt_turns")]
    for c in ("chosen", "rejected"):
        rest = F.slice(c, F.col("n") + 1, F.size(c))
        out += [F.array_join(F.transform(rest, rendered), "").alias(f"{c}_text"), spans(rest).alias(f"{c}_mask")]
    return rows.select(*out)


def swapped_pairs(conversations: DataFrame) -> DataFrame:
    """Preference pairs ``(conv_id, chosen, rejected)`` from plain conversations.

    Chosen is a conversation up to its last assistant turn. Rejected is the same
    with that turn replaced by the last assistant turn of its partner, the
    conversation whose id differs in the lowest bit. Turns are ordered by turn,
    role and text, nulls first; conversations without an id, an assistant turn or
    a partner that has one make no pair. A conversation is one record, so its own
    turns meet in one row; nothing else is gathered.
    """
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = conversations.filter("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("all"))
    last = F.size("all") - F.array_position(F.reverse(F.transform("all", lambda t: t["role"] == TRAINED)), True) + 1
    rows = rows.filter(F.exists("all", lambda t: t["role"] == TRAINED)).withColumn("last", last.cast("int"))
    turns = F.transform(F.slice("all", F.lit(1), F.col("last")), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    rows = rows.select("conv_id", F.col("conv_id").bitwiseXOR(F.lit(1)).alias("partner"), turns.alias("chosen"))
    answers = rows.select(F.col("conv_id").alias("partner"), F.element_at("chosen", -1).alias("answer"))
    paired = rows.join(answers, "partner")
    return paired.select("conv_id", "chosen", F.concat(F.slice("chosen", F.lit(1), F.size("chosen") - 1), F.array("answer")).alias("rejected"))


def told(mask: str) -> F.Column:
    return F.array_join(F.transform(mask, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")


def op3_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = preference_format(swapped_pairs(read_table(spark, sf_dir, "conversations")))
    return made.select("conv_id", "prompt", "prompt_turns", "chosen_text", "rejected_text", told("chosen_mask").alias("chosen_mask"), told("rejected_mask").alias("rejected_mask"))


OP3_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, max(i) AS i FROM t WHERE role = 'assistant' GROUP BY conv_id),
a AS (SELECT t.conv_id, t.i, t.text FROM t JOIN l ON t.conv_id = l.conv_id AND t.i = l.i),
p AS (SELECT a.conv_id, a.i, a.text AS chosen, b.text AS rejected FROM a JOIN a AS b ON b.conv_id = xor(a.conv_id, 1)),
c AS (
  SELECT p.conv_id, coalesce(string_agg('<|' || t.role || '|>' || chr(10) || t.text || chr(10) || '<|end|>' || chr(10), '' ORDER BY t.i), '') AS prompt, count(t.i) AS n
  FROM p LEFT JOIN t ON t.conv_id = p.conv_id AND (t.i < p.i OR (t.i = p.i AND p.chosen = p.rejected)) GROUP BY p.conv_id)
SELECT p.conv_id, c.prompt, c.n::INTEGER AS prompt_turns,
  CASE WHEN chosen = rejected THEN '' ELSE '<|assistant|>' || chr(10) || chosen || chr(10) || '<|end|>' || chr(10) END AS chosen_text,
  CASE WHEN chosen = rejected THEN '' ELSE '<|assistant|>' || chr(10) || rejected || chr(10) || '<|end|>' || chr(10) END AS rejected_text,
  CASE WHEN chosen = rejected THEN '' ELSE '14-' || (22 + length(chosen)) END AS chosen_mask,
  CASE WHEN chosen = rejected THEN '' ELSE '14-' || (22 + length(rejected)) END AS rejected_mask
FROM p JOIN c ON p.conv_id = c.conv_id
"""
