"""The pipeline's stages on the smallest tables, each against what it is meant to keep."""

import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from ticklake.llm import packing, registry
from ticklake.llm.shared import written

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    counts = [docs.count()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = written(stage(spark, docs, SF), f"test{i}")
        if i < 4:
            assert made.columns == columns, name
            counts.append(made.count())
            ids = [r.doc_id for r in made.select("doc_id").collect()]
        if i == 0:
            clean = [d for d, q in labels.items() if q == 1]
            assert len(set(clean) & set(ids)) >= 0.98 * len(clean)
        if i == 1:
            assert len({r.text for r in made.select("text").collect()}) == made.count() == docs.select("text").distinct().count()
        if i == 2:
            assert sorted(ids) == one_of_each_class(docs)
        if i == 3:
            mixed_near_targets(docs, made)
        if i == 4:
            packed_whole(docs, made)
        docs = made
    assert docs.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def one_of_each_class(docs):
    sets = {}
    for r in docs.collect():
        w = (r.text or "").encode().split()
        sets[r.doc_id] = frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[k : k + 5]) for k in range(len(w) - 4)])
    root = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = {k: a if v == b else v for k, v in root.items()}
    return sorted(i for i, v in root.items() if i == v)


def mixed_near_targets(docs, made):
    rows = {r.doc_id: (r.source, len((r.text or "").encode().split())) for r in docs.collect()}
    copies = Counter(r.doc_id for r in made.select("doc_id").collect())
    names = sorted({s for s, _ in rows.values()}, key=lambda s: (s is None, s or ""))
    size = {s: sum(n for t, n in rows.values() if t == s) for s in names}
    left, target = {s: k % 3 + 1 for k, s in enumerate(names)}, {}
    while left:  # what a capped source can't take is shared anew
        unit = (sum(size.values()) - sum(target.values())) / sum(left.values())
        full = [s for s, w in left.items() if w * unit > 3 * size[s]]
        target |= {s: 3 * size[s] if full else left[s] * unit for s in full or left}
        left = {s: w for s, w in left.items() if s not in target}
    taken = Counter()
    for i, k in copies.items():
        assert k <= 3
        taken[rows[i][0]] += k * rows[i][1]
    for s in names:
        assert abs(taken[s] - target[s]) <= max(n for t, n in rows.values() if t == s)


def packed_whole(docs, made):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    want = Counter()
    ids = {}
    for r in docs.collect():
        ids[r.doc_id] = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        want.update((r.doc_id, k) for k in range(len(ids[r.doc_id])))
    got = Counter()
    for r in made.collect():
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
        got.update((r.doc_id, k) for k in range(r.start, r.start + r.length))
    assert got == want


def test_stages_on_awkward_rows(spark):
    """Nulls, repeated rows, clashing columns and an empty table go through every stage."""
    rows = [(1, "a b c d e f g", "s"), (1, "a b c d e f g", "s"), (2, None, None), (None, "x y", "t"), (3, "", "s"), (4, "long " * 30_000, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("doc_id", "text", "'en' as lang", "source", "0L as n_chars", "'x' as d", "'y' as _h")
    for table in (docs, docs.limit(0)):
        now = table
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            now = written(stage(spark, now, SF), "awkward")
            assert i == 4 or now.columns == docs.columns
        assert (now.count() > 0) == (table is docs)


def test_registered():
    assert [q.split("_")[0] for q in registry.QUERIES] == [f"op{i}" for i in range(1, 11)]
    assert set(registry.SQL) <= set(registry.QUERIES)
