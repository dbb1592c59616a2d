"""Groups of windows by anchor: what of a table's windows can repeat at all.

A window is a run of units (bytes or words). Neighbouring windows with the same
anchor form a group, so a table has far fewer groups than windows. Spark sorts
the groups by the anchor's name: a name that comes once proves that none of its
windows repeats; groups with the same name and the same units under them are
copies of each other; only groups whose units differ stay open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP = "name long, digest long, d long, start long, n long"
FIELDS = ("name", "digest", "d", "start", "n")
#: Kinds of ``sorted_out``: a copy of an earlier group, or the first of differing groups with one name.
COPY, OPEN = 0, 1
FOUND = "kind int, " + GROUP
#: Hot names are looked for in one document of SAMPLE_OF: those with HOT_SEEN groups there and over a PART of an even partition's. Each is dealt to SALTS parts.
SAMPLE_OF, HOT_SEEN, PART, SALTS = 50, 20, 8, 64


def batch_of(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns.values()], names=list(columns))


def group_batch(d: np.ndarray, found: tuple[np.ndarray, ...], base: np.ndarray | int = 0) -> pa.RecordBatch:
    row, start, count, name, digest = found
    at = base[row] if isinstance(base, np.ndarray) else base
    return batch_of({"name": name.view(np.int64), "digest": digest.view(np.int64), "d": d[row], "start": (start + at).astype(np.int64), "n": count.astype(np.int64)})


def hot_names(rows: DataFrame, groups) -> list[int]:
    """Names that would fill a large part of a task, found in the groups of one document in SAMPLE_OF.

    ``groups``: an Arrow function from (d, text) rows to groups. Only where the
    rows of these names go depends on the sample, never a result; there are no
    more than PART for each partition.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = rows.filter(F.pmod(F.xxhash64("d", F.lit(11)), F.lit(SAMPLE_OF)) == 0)
    counts = some.mapInArrow(groups, GROUP).groupBy("name").agg(F.count("*").alias("n")).filter(F.col("n") >= HOT_SEEN)
    total = some.mapInArrow(groups, GROUP).groupBy().agg(F.count("*").alias("total"))
    found = counts.join(F.broadcast(total), F.col("n") * PART * parts > F.col("total")).select("name").collect()
    return sorted(r["name"] for r in found)


def by_name(rows: DataFrame, hot: list[int]) -> DataFrame:
    """Groups dealt by name and sorted; those of a hot name are dealt to SALTS parts by their documents."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.when(F.col("name").isin(hot), F.pmod(F.xxhash64("d"), F.lit(SALTS))).otherwise(F.lit(0)) if hot else F.lit(0)
    return rows.repartition(n, "name", salt).sortWithinPartitions("name", "digest", "d", "start")


def sorted_out(batches: Iterator[pa.RecordBatch], all_firsts: bool = False, hot: list[int] | None = None) -> Iterator[pa.RecordBatch]:
    """Copies and open groups of sorted groups; what comes once is dropped.

    With ``all_firsts`` the first group of each digest of a repeated name is open,
    even if the name has no other digest. A hot name's groups are only those of
    its part, so the first of each digest there stays open. Keeps one row between
    batches.
    """
    always = np.array(hot or [], np.int64)
    last: tuple | None = None  # name and digest of the row before
    held: list | None = None  # a name's first row, until it is known whether another follows
    for batch in batches:
        if not batch.num_rows:
            continue
        c = [batch.column(f).to_numpy(zero_copy_only=False) for f in FIELDS]
        name, digest = c[0], c[1]
        new_name = np.concatenate(([last is None or last[0] != name[0]], name[1:] != name[:-1]))
        first = new_name | np.concatenate(([last is None or last[1] != digest[0]], digest[1:] != digest[:-1]))
        follows = np.concatenate((~new_name[1:], [False]))  # the next row has the same name
        other = np.zeros(len(name), bool)  # a first whose name has another digest after it
        at = np.flatnonzero(first)
        other[at[:-1]] = ~new_name[at[1:]]
        is_open = first & (~new_name | other | (follows if all_firsts else False) | np.isin(name, always))
        out = []
        if held is not None:
            if (not new_name[0]) if all_firsts else (len(at) and not new_name[at[0]]):  # never a hot name, whose firsts are open at once
                out.append((np.array([OPEN], np.int32), [np.array([x]) for x in held]))
                held = None
            elif len(at):
                held = None
        tail = at[-1] if len(at) else None
        if tail is not None and new_name[tail] and not is_open[tail]:
            held = [x[tail] for x in c]
        kind = np.where(first, OPEN, COPY).astype(np.int32)
        keep = ~first | is_open
        out.append((kind[keep], [x[keep] for x in c]))
        last = (name[-1], digest[-1])
        for k, columns in out:
            if len(k):
                yield batch_of({"kind": k} | dict(zip(FIELDS, columns, strict=True)))
