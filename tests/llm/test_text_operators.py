"""SimHash components, fill-in-middle and periodic runs against plain versions of their rules."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
import xxhash

from ticklake.llm import fill_middle, periodic_runs, shared, simhash

SCHEMA = "doc_id long, text string, n string, form string, fp string, place string, runs string, h1 long"
CLASH = ("x", "y", "z", "w", "v", 7)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def awkward(unique_ids=True):
    rng = random.Random(11)
    line = [" ".join(rng.choice(["alpha", "Beta", "gam", "de", "x"]) + str(rng.randint(0, 30)) for _ in range(n)) for n in (300, 300, 80, 40, 7, 3, 2, 1)]
    texts = [*line, line[0] + " Tail", line[0].upper(), line[1].replace(" ", "\n", 9), None, "", " \t ", "ab " * 700, "a　b éß \U0001f600" * 30, "<P> holds a mark", "Z" * 3000]
    texts += ["one two three one two three " * 9, "q " + "r s " * 8 + "t", "w w w w w w", "w w w w w", line[2] + " " + line[2] + " " + line[2] + " " + line[2]]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(1, 150))) for _ in range(40)]
    rows = [(i * 7 + 3, t, *CLASH) for i, t in enumerate(texts)]
    return rows if unique_ids else rows + [rows[0], (None, line[0], *CLASH), (None, None, *CLASH), (3, "another text", *CLASH)]


@pytest.fixture(scope="module", params=[True, False], ids=["unique", "messy"])
def docs(spark, request):
    return spark.createDataFrame(awkward(request.param), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def stored(monkeypatch, module, docs):
    """Let a query read ``docs`` as its table."""
    monkeypatch.setattr(module, "read_table", lambda spark, sf_dir, name: docs)
    return docs.sparkSession


def plain_fingerprint(text):
    words = words_of("".join(c.lower() if c.isascii() else c for c in text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """The least fingerprint that each reaches, by comparing all pairs."""
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    values = np.array(fps, np.uint64)
    for f in fps:
        for g in values[np.bitwise_count(values ^ np.uint64(f)) <= 3].tolist():
            a, b = find(f), find(g)
            root[max(a, b)] = min(a, b)
    return {f: find(f) for f in fps}


def test_simhash_query(docs, monkeypatch):
    got = simhash.op11_simhash(stored(monkeypatch, simhash, docs), "").collect()
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    root, least = plain_components([f for _, f in rows]), {}
    for i, f in rows:
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    want = sorted((str(i), f"{f:016x}", str(least.get(root[f]))) for i, f in rows)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    assert len({r.component_id for r in got}) < len(got) - 3


def test_simhash_of_no_rows(none):
    assert simhash.simhash_components(none).collect() == []


@pytest.mark.parametrize("shard", [40, simhash.SHARD])
def test_links_in_and_between_shards(spark, shard):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**64, 150, dtype=np.uint64)
    dense = np.repeat(base[:1], 900)
    for _ in range(9):
        dense = dense ^ np.where(rng.random(900) < 0.6, np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64), np.uint64(0))
    near = [base[:60] ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) ^ (np.uint64(k) << np.uint64(40)) for k in (0, 1, 3, 7)]
    fps = np.unique(np.concatenate([base, dense, *near, np.array([0, 1, 2**64 - 1], np.uint64)]))
    points = spark.createDataFrame([(x,) for x in fps.view(np.int64).tolist()], "fp long").repartition(4)
    links = [(r.a % 2**64, r.b % 2**64) for r in simhash.fingerprint_links(points, shard=shard).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    root = {f: f for f in fps.tolist()}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert {f: find(f) for f in root} == plain_components(fps.tolist())


def test_vantage_tree_finds_every_pair():
    rng = np.random.default_rng(9)
    points = np.unique(rng.integers(0, 2**12, 1500, dtype=np.uint64) * np.uint64(0x10001))
    asked = rng.integers(0, 2**12, 400, dtype=np.uint64) * np.uint64(0x10001) ^ np.uint64(1)
    for radius in (0, 1, 3, 9):
        got = {(i, j) for a, b in simhash.VantageTree(points).near(asked, radius) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
        want = np.argwhere(np.bitwise_count(asked[:, None] ^ points[None, :]) <= radius)
        assert got == set(map(tuple, want.tolist()))


def plain_infill(i, text):
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    hexed = sha(f"1:{'' if i is None else i}")
    h = [int(hexed[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    spm = h[3] % 100 < 20
    return len(units), "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_query(docs, monkeypatch):
    got = fill_middle.op12_fill_in_middle(stored(monkeypatch, fill_middle, docs), "").collect()
    want = []
    for r in docs.collect():
        n, form, p, m, out = plain_infill(r.doc_id, r.text or "")
        want.append((r.doc_id, n, form, p, m, sha(out), sha(r.text or "")))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_no_rows_and_other_settings(docs, none):
    assert fill_middle.fill_in_middle(none).collect() == []
    rows = fill_middle.fill_in_middle(docs, plain_percent=0, spm_percent=100, sentinels=("[[p]]", "[[s]]", "[[m]]"))
    back = fill_middle.restored(rows.output, rows.form, ("[[p]]", "[[s]]", "[[m]]"))
    assert rows.filter(back != rows.text).count() == 0 and rows.filter("form = 'psm'").count() == 0
    for bad in (("<P>", "<P>", "<M>"), ("<P>", "P", "<M>"), ("ab", "ba", "c"), ("", "a", "b")):
        with pytest.raises(ValueError):
            fill_middle.checked(bad)


def test_units_of_long_texts_by_stretches():
    rng = random.Random(2)
    for text in ("a" * 5000, "a1" * 900, "".join(rng.choice("ab \né\U0001f600") for _ in range(4000)), "b" * 700 + " " + "c" * 90):
        want = [m.end() for m in re.finditer("[A-Za-z]+|[^A-Za-z]", text, re.S)]
        for stretch in (1, 7, 100, 1 << 20):
            assert fill_middle.unit_ends(text, stretch=stretch).tolist() == want


def plain_runs(words):
    found = []
    for q in range(1, len(words) // 4 + 1):
        at = 0
        while at + q < len(words):
            to = at
            while to + q < len(words) and words[to] == words[to + q]:
                to += 1
            part = words[at : to + q]
            if to > at and len(part) >= max(6, 4 * q) and not any(part[d:] == part[:-d] for d in range(1, q)):
                found.append((at, len(part), q))
            at = to + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_periodic_runs_query(docs, monkeypatch):
    got = periodic_runs.op13_periodic_runs(stored(monkeypatch, periodic_runs, docs), "").collect()
    want, changed = [], 0
    for r in docs.collect():
        words, h = words_of(r.text), zlib.crc32(str(r.doc_id).encode()) if r.doc_id is not None else 1
        if h % 10 == 0 and words:
            g = h // 10
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words, changed = [words[i if i < a else a + (i - a) % p] for i in range(len(words))], changed + 1
        runs = plain_runs(words)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((r.doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2], sha(lines), sha(kept), len(words), len(gone)))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert changed > 2 and sum(r.n_runs for r in got) > 20


def test_runs_of_many_shapes():
    rng = random.Random(8)

    def made():
        unit = [rng.choice("abc") for _ in range(rng.randint(1, 20))]
        kind = rng.randint(0, 4)
        if kind == 0:
            return [rng.choice("ab") for _ in range(rng.randint(0, 90))]
        if kind == 1:
            return (unit * 12)[rng.randint(0, 5) : rng.randint(0, len(unit) * 12)] + ["z"] * rng.randint(0, 9)
        if kind == 2:
            return (unit * 4 + ["d"]) * rng.randint(1, 5)
        if kind == 3:
            return [str(rng.randint(0, 50)) for _ in range(9)] * rng.randint(1, 9)
        return ["a"] * rng.randint(0, 30)

    for _ in range(150):
        texts = [[w.encode() for w in made()] for _ in range(rng.randint(1, 9))]
        text, *runs = periodic_runs.runs_of(texts)
        got = [[] for _ in texts]
        for t, *r in zip(text.tolist(), *(x.tolist() for x in runs), strict=True):
            got[t].append(tuple(r))
        assert got == [plain_runs(t) for t in texts]


def test_periodic_runs_of_no_rows_and_stricter_limits(none, spark):
    assert periodic_runs.periodic_runs(none).collect() == []
    one = spark.createDataFrame([(1, "a b " * 9 + "c c c c c c c")], "doc_id long, text string")
    assert [tuple(x) for x in periodic_runs.periodic_runs(one, times=8).first().runs] == [(0, 18, 2)]
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(one, times=3)


def test_range_successor():
    rng = np.random.default_rng(3)
    values = rng.permutation(500)
    tree = periodic_runs.RangeSuccessor(values)
    lo = rng.integers(0, 500, 300)
    hi = np.minimum(500, lo + rng.integers(0, 60, 300))
    x = rng.integers(0, 500, 300)
    want = [min((v for v in values[a:b].tolist() if v > c), default=-1) for a, b, c in zip(lo, hi, x, strict=True)]
    assert tree.after(lo, hi, x).tolist() == want


def test_new_queries_read_whole_tables(spark):
    folder = "/root/testdata/sf0.001"
    rows = shared.read_table(spark, folder, "documents").count()
    for query in (simhash.op11_simhash, fill_middle.op12_fill_in_middle, periodic_runs.op13_periodic_runs):
        assert query(spark, folder).count() == rows
