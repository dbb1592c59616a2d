"""Fill-in-middle transformation: documents cut at unit boundaries and rearranged around sentinels."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.shared import read_table

#: A run of ASCII letters is a unit, any other character is one of its own.
UNIT = r"[A-Za-z]+|[^A-Za-z]"
#: A single character that is always a unit, so that a text may be cut after it.
SINGLE = r"[^A-Za-z]"
SENTINELS = ("<P>", "<S>", "<M>")
#: Documents in a hundred that stay plain, and of the others those in a hundred that put the suffix first.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
#: Characters that one match takes; a match holds some 64 bytes for each character.
STRETCH = 1 << 20


@functools.cache
def repeated(unit: str) -> regex.Pattern:
    """Units from end to end in one group, which keeps the end of every repetition."""
    return regex.compile(f"({unit})*")


def unit_ends(text: str, unit: str = UNIT, single: str = SINGLE, stretch: int = STRETCH) -> np.ndarray:
    """Where each unit of ``text`` ends, in code points.

    One full match of (unit)* gives all of them. A text over ``stretch``
    characters is matched in stretches that end with a ``single``, where a unit
    ends whatever follows, so its units are the same and the match stays small.
    """
    if len(text) <= stretch:
        return np.array(repeated(unit).fullmatch(text).ends(1), np.int64)
    found, at, last = [], 0, regex.compile(f"(?r){single}")
    while at < len(text):
        to = min(len(text), at + stretch)
        if to < len(text):
            cut = last.search(text, at, to) or regex.compile(single).search(text, to)
            to = cut.end() if cut else len(text)
        found.append(np.array(repeated(unit).fullmatch(text, at, to).ends(1), np.int64))
        at = to
    return np.concatenate(found)


def cut_points(batches: Iterator[pa.RecordBatch], text_at: int, unit: str, single: str) -> Iterator[pa.RecordBatch]:
    """Each row with n, its units, and the code points before its middle and its suffix."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            made = []
            for text, h1, h2 in zip(*(part.column(text_at + i).to_pylist() for i in range(3)), strict=True):
                ends = unit_ends(text, unit, single)
                a, b = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
                made.append((len(ends), int(ends[a - 1]) if a else 0, int(ends[b - 1]) if b else 0))
            columns = [pa.array(x, pa.int64()) for x in zip(*made, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, "n", "cut_a", "cut_b"])


def seeded(seed: int, doc_id: Column) -> list[Column]:
    """The first four 8-digit groups of the sha256 of ``seed:doc_id`` as numbers (no id: nothing after the colon)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def checked(sentinels: tuple[str, str, str]) -> tuple[str, str, str]:
    """Sentinels that can be found again: none is part of another or overlaps one."""
    if len(sentinels) != 3 or not all(sentinels) or len(set(sentinels)) != 3:
        raise ValueError("three different sentinels are needed")
    for a in sentinels:
        for b in sentinels:
            if (a != b and a in b) or any(a[i:] == b[: len(a) - i] for i in range(1, len(a))):
                raise ValueError(f"{a} overlaps {b}")
    return sentinels


def fill_in_middle(
    docs: DataFrame, seed: int = 1, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT,
    sentinels: tuple[str, str, str] = SENTINELS, unit: str = UNIT, single: str = SINGLE,
) -> DataFrame:
    """``docs`` rearranged for infilling: doc_id, text, n, form, prefix_chars, middle_chars, output.

    A text has n units. Two cuts fall after h1 % (n + 1) and h2 % (n + 1) of them,
    where h1 to h4 are drawn from ``seed`` and the id. ``output`` is

    - plain: the text, where it is empty or holds a sentinel already, or where
      h3 % 100 >= 100 - ``plain_percent``;
    - spm, where h4 % 100 < ``spm_percent``: <S>suffix<P>prefix<M>middle;
    - psm otherwise: <P>prefix<S>suffix<M>middle.

    ``prefix_chars`` and ``middle_chars`` count code points and are null in plain
    rows. A null text is an empty one; a null id draws from the seed alone;
    repeated rows give repeated results; other columns are ignored, whatever
    their names; an empty table gives no rows. Nothing is shuffled. ``single``
    must match characters that are always a unit of their own under ``unit``.
    """
    p, s, m = checked(sentinels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    h1, h2, h3, h4 = seeded(seed, F.col("doc_id"))
    drawn = rows.select("doc_id", "text", h1.alias("h1"), h2.alias("h2"), h3.alias("h3"), h4.alias("h4"))
    cut = drawn.mapInArrow(lambda it: cut_points(it, 1, unit, single), "doc_id long, text string, h1 long, h2 long, h3 long, h4 long, n long, cut_a long, cut_b long")
    held = F.lit(False)
    for mark in sentinels:
        held = held | F.contains("text", F.lit(mark))
    plain = (F.col("text") == "") | held | (F.col("h3") % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    whole = F.char_length("text")
    parts = cut.withColumn("form", form).select(
        "doc_id", "text", "n", "form", F.col("cut_a").alias("a"), (F.col("cut_b") - F.col("cut_a")).alias("b"),
        F.substring("text", F.lit(1), F.col("cut_a").cast("int")).alias("prefix"),
        F.substring("text", F.col("cut_a").cast("int") + 1, (F.col("cut_b") - F.col("cut_a")).cast("int")).alias("middle"),
        F.substring("text", F.col("cut_b").cast("int") + 1, whole).alias("suffix"),
    )
    psm = F.concat(F.lit(p), "prefix", F.lit(s), "suffix", F.lit(m), "middle")
    spm = F.concat(F.lit(s), "suffix", F.lit(p), "prefix", F.lit(m), "middle")
    infilled = F.col("form") != "plain"
    return parts.select(
        "doc_id", "text", "n", "form", F.when(infilled, F.col("a")).alias("prefix_chars"), F.when(infilled, F.col("b")).alias("middle_chars"),
        F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("text")).alias("output"),
    )


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The exact text again, from an output and its form alone."""
    parts = F.split(output, "|".join(rf"\Q{x}\E" for x in checked(sentinels)), -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(read_table(spark, sf_dir, "documents"))
    back = restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )


OP12_SQL = """
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
           sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hex
    FROM documents),
h AS (
    SELECT *, len(units) AS n, ('0x' || hex[1:8])::BIGINT AS h1, ('0x' || hex[9:16])::BIGINT AS h2,
           ('0x' || hex[17:24])::BIGINT AS h3, ('0x' || hex[25:32])::BIGINT AS h4
    FROM t),
c AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM h),
p AS (
    SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS prefix, coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
           coalesce(array_to_string(units[b + 1:], ''), '') AS suffix
    FROM c)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
