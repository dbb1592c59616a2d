"""Each operator against brute force on small, awkward tables: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ticklake.llm import chat_format, exact_dedup, media, mixing, ngram_join, packing, quality, substring_dedup, suffix_dedup, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, d string, size string, _h string, digest string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(n))


def awkward(unique_ids=True):
    rng = random.Random(3)
    base = [words(rng, n) for n in (400, 60, 60, 30, 12, 13, 14, 3, 1)]
    passage = words(rng, 40)
    texts = [*base, base[0], base[1], base[1] + " tail", "head " + base[2], base[3].replace(" ", "\t", 2), None, "", " \n ", passage + " " + words(rng, 9), words(rng, 9) + " " + passage]
    texts += [f"{passage} {words(rng, 5)}" for _ in range(6)] + ["ab " * 300, "ab " * 300 + "c", "ä ß 漢字 " * 40, "a" * 5000, "a" * 350, base[4] + "\n" + base[4]]
    long = words(rng, 3000).split()
    texts += [" ".join(long), " ".join(long[:1500] + ["x"] + long[1500:])]
    rows = [(i * 3 + 1, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, len(t or ""), "x", "y", "z", "w") for i, t in enumerate(texts)]
    if not unique_ids:
        rows += [rows[0], rows[1], (None, base[1], None, None, None, None, None, None, None), (None, "other text", None, None, 3, None, None, None, None), (4, base[5] + " changed", "en", "s1", 1, "x", "y", "z", "w")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def messy(spark):
    return spark.createDataFrame(awkward(False), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(df):
    return {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}


def sha(b):
    return hashlib.sha256(b).hexdigest()


def test_exact_dedup(docs, messy, none):
    texts = texts_of(docs)
    got = {r.doc_id: r for r in exact_dedup.DigestIndex(docs.sparkSession).add(docs).collect()}
    assert len(got) == len(texts)
    for i, t in texts.items():
        same = [j for j, x in texts.items() if x == t]
        r = got[i]
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (max(same), len(same), i == max(same), sha(t.encode()))
    rows = exact_dedup.DigestIndex(docs.sparkSession).add(messy).collect()
    assert len(rows) == messy.count()
    assert sum(r.kept for r in rows) == len({r.text_sha256 for r in rows})
    kept = exact_dedup.exact_dedup_rows(messy)
    assert kept.columns == messy.columns and kept.count() == len({r.text_sha256 for r in rows})
    assert exact_dedup.DigestIndex(docs.sparkSession).add(none).count() == 0


def test_digest_index_keeps_earlier_batches(docs):
    index = exact_dedup.DigestIndex(docs.sparkSession)
    first, second = docs.filter("doc_id < 40"), docs.filter("doc_id >= 40")
    index.add(first).count()
    again = exact_dedup.DigestIndex(docs.sparkSession, path=index.path, buckets=index.buckets)
    got = again.add(second).collect()
    before = set(t for i, t in texts_of(first).items())
    for r in got:
        if texts_of(second)[r.doc_id] in before:
            assert not r.kept and r.keep_id < 40
    assert again.rows().count() == len(set(texts_of(docs).values()))


def brute_bytes(rows, n):
    seen, out = set(), []
    for i, t in rows:
        b = t.encode()
        gone = bytearray(len(b))
        for s in range(len(b) - n + 1):
            if b[s : s + n] in seen:
                gone[s : s + n] = b"\1" * n
            seen.add(b[s : s + n])
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, sha(bytes(x for x, y in zip(b, gone) if not y))))
    return sorted(out, key=str)


def in_order(df):
    """Rows as the operators order them when ids repeat or are null; ties of one id have no defined order but for their text."""
    return sorted(((r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()), key=lambda r: (r[0] is None, r[0] or 0))


def test_suffix_dedup(docs, messy, none):
    got = sorted((tuple(r) for r in suffix_dedup.suffix_dedup(docs).collect()), key=str)
    assert got == brute_bytes(in_order(docs), 100)
    r = suffix_dedup.suffix_dedup(messy, texts=True).collect()
    assert len(r) == messy.count() and all(sha(bytes(x.kept)) == x.kept_sha256 for x in r)
    assert sum(x.n_removed for x in r) == sum(x[2] for x in brute_bytes(in_order(messy), 100))
    assert suffix_dedup.suffix_dedup(none).count() == 0


def test_suffix_dedup_long_texts_are_cut(docs, monkeypatch):
    from ticklake.llm import kernels

    values = np.random.default_rng(0).integers(0, 3, 5000, dtype=np.uint64)
    bounds = np.array([0, 4000, 4010, 5000])
    whole = kernels.groups(values, bounds, 30, 8)
    monkeypatch.setattr(kernels, "UNITS", 500)
    cut = kernels.groups(values, bounds, 30, 8)
    for found in (whole, cut):
        assert sum(found[2]) == sum(max(0, n - 29) for n in np.diff(bounds))


def brute_words(rows, n):
    first, out = {}, []
    for order, (i, t) in enumerate(rows):
        w = t.encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - n + 1):
            if first.setdefault(tuple(w[s : s + n]), order) < order:
                gone[s : s + n] = [True] * n
        out.append((i, len(w), sum(gone), sha(b" ".join(x for x, y in zip(w, gone) if not y))))
    return sorted(out, key=str)


def test_substring_dedup(docs, messy, none):
    got = sorted((tuple(r) for r in substring_dedup.substring_dedup(docs).collect()), key=str)
    assert got == brute_words(in_order(docs), 13)
    r = substring_dedup.substring_dedup(messy, texts=True).collect()
    assert len(r) == messy.count() and all(sha(x.kept.encode()) == x.kept_sha256 for x in r)
    assert sum(x.n_removed for x in r) == sum(x[2] for x in brute_words(in_order(messy), 13))
    assert substring_dedup.substring_dedup(none).count() == 0


def test_fm_index_against_brute_force():
    from ticklake.llm.fm_index import FMIndex

    rng = np.random.default_rng(5)
    rows = [rng.integers(0, 3, rng.integers(4, 30)).astype(np.uint64) for _ in range(40)]
    bounds = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    labels = rng.permutation(40)
    starts = np.concatenate([np.arange(bounds[i], bounds[i + 1] - 3) for i in range(40)])
    got = FMIndex(np.concatenate(rows), bounds, labels, 4).smallest_label(starts, 4)
    where = {}
    for i, r in enumerate(rows):
        for s in range(len(r) - 3):
            where.setdefault(tuple(r[s : s + 4]), []).append(labels[i])
    text = np.concatenate(rows)
    assert got.tolist() == [min(where[tuple(text[s : s + 4])]) for s in starts]


def brute_join(rows):
    sets = {}
    for i, t in rows:
        w = t.encode().split()
        sets[i] = frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[k : k + 5]) for k in range(len(w) - 4)])
    root = {i: i for i in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    links = dict.fromkeys(sets, 0)
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: (find(i), links[i]) for i in sets}


def near_copies(spark):
    rng = random.Random(11)
    rows, i = [], 0
    for _ in range(12):
        base = words(rng, rng.randint(30, 120)).split()
        for _ in range(rng.randint(1, 7)):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = "zz" + str(rng.random())
            rows.append((i, " ".join(w)))
            i += 1
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_ngram_join(spark, docs, messy, none, monkeypatch):
    for table in (docs, near_copies(spark)):
        got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.ngram_join(table).collect()}
        assert got == brute_join(in_order(table))
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 2)  # large groups come in blocks
    monkeypatch.setattr(ngram_join, "GATHER", 50)
    table = near_copies(spark)
    assert {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.ngram_join(table).collect()} == brute_join(in_order(table))
    assert ngram_join.ngram_join(messy).count() == messy.count()
    kept = ngram_join.one_of_each(messy)
    assert kept.columns == messy.columns and 0 < kept.count() < messy.count()
    assert ngram_join.ngram_join(none).count() == 0


def test_bayesian_limits():
    needed = dict(ngram_join.least_matches())
    assert all(0 < m < 0.8 * n for n, m in needed.items())
    rng = np.random.default_rng(0)
    for n, m in needed.items():  # pairs at the threshold hardly ever fall below
        assert (rng.binomial(n, 0.8, 200_000) < m).mean() < 1e-4


def test_mix(docs, messy, none):
    rows = mixing.mix(docs).collect()
    assert rows and sorted(map(str, mixing.mix(docs).collect())) == sorted(map(str, rows))
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    size = {i: len(t.encode().split()) for i, t in texts_of(docs).items()}
    names = sorted(set(source.values()), key=lambda s: (s is None, s or ""))
    sizes = {s: sum(n for i, n in size.items() if source[i] == s) for s in names}
    targets = mixing.share_out(sizes, {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)})
    assert abs(sum(targets.values()) - sum(sizes.values())) < 1e-6 and all(targets[s] <= 3 * sizes[s] + 1e-9 for s in names)
    for r in rows:
        assert r.size == size[r.doc_id] and r.source_size == sizes[source[r.doc_id]] and abs(r.target - targets[source[r.doc_id]]) < 1e-6 and r.taken <= 3 * r.size
    for s in names:
        taken = sum(r.taken for r in rows if source[r.doc_id] == s)
        assert abs(taken - targets[s]) <= max(size[i] for i in size if source[i] == s)
    assert mixing.mix(messy).count() == messy.count() and mixing.mix(none).count() == 0
    assert mixing.mixed_rows(messy).columns == messy.columns and mixing.mixed_rows(none).count() == 0


def test_route_prefers_first_uses_and_overlaps():
    flow = mixing.route({("a",): 100, ("a", "b"): 100, ("b",): 10}, {"a": 150, "b": 60})
    assert sum(flow.values()) == 210 and all(flow[p] <= n for p, n in {("a",): 100, ("a", "b"): 100, ("b",): 10}.items())
    assert mixing.route({("a",): 10}, {"a": 30}) == {("a",): 30}
    assert mixing.route({("a",): 10}, {"a": 90}) == {("a",): 30}


def test_mix_overlapping_sources(spark):
    rows = [(i, "w " * (i % 7 + 1), ["a"] if i % 3 else ["a", "b"]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    got = mixing.mix(df).collect()
    assert len(got) == 300 and abs(sum(r.taken for r in got) - sum(r.size for r in got)) < 30


def test_quality_learns_held_out_rows(spark, none):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = " ".join((w + "###") if bad else w for w in words(rng, 40).split())
        rows.append((i, None if i == 7 else text))
        if i % 2 == 0 or i < 100:
            labels.append((i, 0 if bad else 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, quality int")
    model = quality.QualityModel.fit(docs, known)
    got = {r.doc_id: r for r in model.score(docs).collect()}
    assert len(got) == 400 and all(0 <= r.score <= 1 for r in got.values())
    assert np.mean([(got[i].score >= 0.5) == bool(i % 4) for i in range(400) if i not in dict(labels)]) > 0.97
    assert model.keep(docs.withColumn("score", F.lit(1))).columns == ["doc_id", "text", "score"]
    assert model.score(none).count() == 0
    unlabelled = quality.QualityModel.fit(docs, known.limit(0))
    assert {r.score for r in unlabelled.score(docs).collect()} == {0.5}


def test_pack_round_trip(docs, messy, none):
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    tokenizer = Tokenizer.from_file(path)
    for table in (docs, messy):
        rows = packing.pack(table, path).collect()
        ids = {}
        for i, t in in_order(table):
            ids.setdefault(i, []).append([*tokenizer.encode(t, add_special_tokens=False).ids, 1])
        assert sum(r.length for r in rows) == sum(len(x) for xs in ids.values() for x in xs)
        for r in rows:
            want = {zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes()) for x in ids[r.doc_id] if len(x) == r.doc_tokens}
            assert r.ids_crc32 in want
        by = {}
        for r in rows:
            by.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts in by.values():
            end = 0
            for offset, length in sorted(parts):
                assert offset == end
                end += length
            assert end <= packing.SEQUENCE
        assert len(by) <= -(-sum(r.length for r in rows) // packing.SEQUENCE) + 1
    assert packing.pack(none, path).count() == 0


def test_pack_deals_short_texts_to_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 64)
    rows = packing.pack(spark.createDataFrame([(i, None if i % 2 else "") for i in range(1000)], "doc_id long, text string"), packing.default_tokenizer()).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.sequence_id >> 32, []).append(r)
    assert sorted(r.doc_id for r in rows) == list(range(1000)) and {r.length for r in rows} == {1}
    assert len(groups) == 16 and max(map(len, groups.values())) < 128
    assert all(sorted(r.offset for r in g) == list(range(len(g))) for g in groups.values())


def test_pack_balances_cost():
    rng = random.Random(2)
    lengths = [rng.randint(1, 1500) for _ in range(3000)]
    parts = packing.place(lengths, [n <= packing.FILLER for n in lengths])
    used, spent = {}, {}
    for n, ps in zip(lengths, parts):
        assert sum(p[3] for p in ps) == n
        for b, _, _, k in ps:
            used[b] = used.get(b, 0) + k
            spent[b] = spent.get(b, 0) + packing.cost(k)
    assert max(used.values()) <= packing.SEQUENCE and len(used) <= sum(lengths) / packing.SEQUENCE * 1.05 + 1
    assert np.std(list(spent.values())) < 0.15 * np.mean(list(spent.values()))


def test_encoder_equals_the_tokenizer():
    encoder = packing.Encoder(packing.default_tokenizer())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|", "", "  ", "a  b", "\na", "a\n", "a \nb", "foo, bar.\nqux.", "x\ty z", "don't. I'll", "<|endoftext|> a", "\0a b", "a\x01", "trail. ", "é. ×, 3, x.5", "漢字。 ab"]
    want = [np.array(e.ids, "<u4").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want == encoder.encode(texts)


def test_url_filter(spark):
    urls = ["http://a.net/x", "https://EXAMPLE.net/en/1?q=1", "http://m.example.com/de/5.html", "http://x.org/fr/9#t", "http://y.org/en/7", None, "no scheme", "http://b.net", "http://b.net?x", "ftp://u@h.example.com:80/de/"]
    urls += [f"http://shop.test/p{i}/spam" for i in range(20)] + [f"http://shop.test/item/{i}" for i in range(20)]
    pages = spark.createDataFrame([*enumerate(urls), (0, urls[0])], "page_id long, url string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r for r in url_filter.judge_urls(pages).collect()}
    want = {0: ("a.net", "/x", "net/", "block"), 1: ("example.net", "/en/1", "example.net/en/", "allow"), 2: ("m.example.com", "/de/5.html", "example.com/de/", "block"), 3: ("x.org", "/fr/9", "org/fr/", "allow"),
            4: ("y.org", "/en/7", None, "allow"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("b.net", "", None, "allow"), 8: ("b.net", "", None, "allow"), 9: ("u@h.example.com:80", "/de/", None, "allow")}
    for i, w in want.items():
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == w
    labels = spark.createDataFrame([(i, 1) for i in range(10, 20)] + [(i, 0) for i in range(30, 45)], "page_id long, bad int")
    got = {r.page_id: r for r in url_filter.judge_urls(pages, labels=labels).collect()}
    assert got[25].verdict == "block" and got[48].verdict == "allow" and got[25].template != got[48].template
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_preference_format(spark):
    rows = [
        (1, [("user", "hi"), ("assistant", "yes")], [("user", "hi"), ("assistant", "no"), ("user", None)]),
        (2, [("user", "hi")], [("user", "hi")]),
        (3, None, [("assistant", "a")]),
        (4, [(None, None)], []),
    ]
    got = {r.pair: r for r in chat_format.preference_format(spark.createDataFrame(rows, f"pair long, chosen {chat_format.TURNS}, rejected {chat_format.TURNS}")).collect()}
    assert got[1].prompt == "<|user|>\nhi\n<|end|>\n" and got[1].prompt_turns == 1
    assert [got[1].chosen_text[s.start : s.end] for s in got[1].chosen_mask] == ["yes\n<|end|>"]
    assert [got[1].rejected_text[s.start : s.end] for s in got[1].rejected_mask] == ["no\n<|end|>"]
    assert got[2].chosen_text == got[2].rejected_text == "" and got[2].prompt_turns == 1
    assert got[3].prompt == "" and got[3].chosen_text == "" and len(got[3].rejected_mask) == 1
    assert got[4].prompt_turns == 0
    turns = [(0, 0, "user", "q"), (0, 1, "assistant", "a"), (1, 0, "user", "q"), (1, 1, "assistant", "b"), (1, 2, "user", "more"), (2, 0, "user", "x"), (None, 0, "user", "y")]
    pairs = chat_format.swapped_pairs(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")).collect()
    assert {p.conv_id: p.rejected[-1].text for p in pairs} == {0: "b", 1: "a"}


def test_fingerprints_align(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, rng.normal(size=64).tolist()) for i in range(12)] + [(50, None), (51, []), (None, [0.0] * 64)]
    vectors += [(60, vectors[3][1]), (3, vectors[3][1])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    known = media.fingerprints(media.recordings(df))
    asked = media.derived_prints(df.filter("vec_id in (3, 5)"), 10, 50, 400)
    got = {(r.query_id, r.id) for r in media.align(known, asked).collect()}
    assert got == {(3, 3), (3, 60), (5, 5)}
    prints = {r.id: np.array(r.prints, np.int32).view(np.uint32) for r in known.collect()}
    bits, n = media.errors(prints[3], prints[60], 0)
    assert bits == 0 and n == len(prints[3]) and len(prints[50]) == 0
    assert media.align(known.limit(0), asked.limit(0)).count() == 0


def test_alignments_against_all_offsets(spark):
    rng = np.random.default_rng(9)
    known = {i: rng.integers(0, 2**32, n, dtype=np.uint32) for i, n in enumerate([120] * 40 + [32, 33, 40, 57, 31, 64])}

    def noisy(x, rate):
        wrong = rng.random((len(x), 32)) < rate
        return x ^ (wrong * (np.uint32(1) << np.arange(32, dtype=np.uint32))).sum(1).astype(np.uint32)

    other = lambda n: rng.integers(0, 2**32, n, dtype=np.uint32)
    asked = {100 + i: noisy(known[i][20:92], 0.01 * (i % 6)) for i in range(40)}
    asked |= {200 + i: np.concatenate((other(40), noisy(known[i][:33], 0.01))) for i in range(4)}  # short overlaps at the ends
    asked |= {300 + i: np.concatenate((noisy(known[i][-32:], 0.01), other(9))) for i in range(4)}
    asked |= {400 + i: noisy(known[i], 0.02) for i in range(40, 46)} | {500: known[3][:31], 501: other(100)}
    want = {}
    for q, a in asked.items():
        for r, b in known.items():
            for s in range(32 - len(a), len(b) - 31):
                bits, n = media.errors(b, a, s)
                if n >= 32 and bits / (32 * n) <= 0.15:
                    want[q, r] = min(want.get((q, r), (1, 0, 0)), (bits / (32 * n), -n, s))
    assert len(want) == 40 + 4 + 4 + 5
    table = lambda rows: spark.createDataFrame([(i, x.view(np.int32).tolist()) for i, x in rows.items()], media.PRINTS)
    got = {(r.query_id, r.id): (r.ber, -r.overlap, r["shift"]) for r in media.align(table(known), table(asked)).collect()}
    assert set(got) <= set(want) and len(got) >= 0.9 * len(want)
    assert all(want[k] == v for k, v in got.items())


def test_noisy_landmarks_find_nine_of_ten_at_every_rate(spark):
    rng = np.random.default_rng(21)
    known = {i: rng.integers(0, 2**32, 120, dtype=np.uint32) for i in range(100)}
    rates, asked, want = (0.02, 0.05, 0.08, 0.1, 0.12, 0.14, 0.15), {}, {}
    for k, rate in enumerate(rates):
        for i, x in known.items():
            wrong = rng.random((72, 32)) < rate
            asked[1000 * k + i] = x[20:92] ^ (wrong * (np.uint32(1) << np.arange(32, dtype=np.uint32))).sum(1).astype(np.uint32)
            if wrong.mean() <= media.ERRORS:
                want.setdefault(k, set()).add((1000 * k + i, i))
    table = lambda rows: spark.createDataFrame([(i, x.view(np.int32).tolist()) for i, x in rows.items()], media.PRINTS)
    got = {(r.query_id, r.id) for r in media.align(table(known), table(asked), media.NOISY).collect()}
    assert got <= set().union(*want.values())
    assert all(len(got & pairs) >= 0.9 * len(pairs) for pairs in want.values()), {rates[k]: len(got & w) / len(w) for k, w in want.items()}


def test_held_tones_and_long_lists_of_links(spark, monkeypatch):
    """A held tone of 3,000 numbers is one landmark a mask; lists of links are dealt to rows and none is lost."""
    monkeypatch.setattr(media, "LISTED", 4)
    rng = np.random.default_rng(3)
    tone = np.full(3000, 0x5A5A1234, np.uint32).view(np.int32).tolist()
    made = [b.num_rows for b in media.landmarks(iter([pa.RecordBatch.from_pylist([{"r": 1, "prints": tone}, {"r": 2, "prints": tone}], pa.schema([("r", pa.int64()), ("prints", pa.list_(pa.int32()))]))]), media.CLEAN)]
    assert made == [2, 2, 2]
    base = rng.integers(0, 2**32, 60, dtype=np.uint32)
    near = {i: base ^ np.where(np.arange(60) == i, 1, 0).astype(np.uint32) for i in range(12)} | {20: base ^ np.where(np.arange(60) == 5, 1, 0).astype(np.uint32)}
    known = spark.createDataFrame([(i, x.view(np.int32).tolist()) for i, x in near.items()] + [(30, tone[:50]), (31, None), (None, tone)], media.PRINTS)
    asked = spark.createDataFrame([(7, base.view(np.int32).tolist()), (9, base.view(np.int32).tolist()), (9, base.view(np.int32).tolist()), (8, tone[:40])], media.PRINTS)
    rows = media.links_of(*media.aligned_classes(known, asked)).collect()
    queries = [r for r in rows if r.kind == "query"]
    linked = sorted((r.query_id, x.class_id, x["size"]) for r in queries for x in r.linked or [])
    assert linked == sorted([(7, i, 2 if i == 5 else 1) for i in range(12)] + [(8, 30, 1)])
    assert {(r.query_id, r.query_class, r.n_links) for r in queries} == {(7, 7, 13), (9, 7, 13), (8, 8, 1)}
    assert max(len(r.linked or []) for r in queries) < 12 and sum(r.query_id == 9 for r in queries) == 1
    assert sorted((r.id, r.class_id) for r in rows if r.kind == "recording") == [(i, i) for i in range(12)] + [(20, 5), (30, 30)]


def test_derived_recordings_are_all_found(spark):
    """The registered query against comparing all offsets of all pairs."""
    sf = "/root/testdata/sf0.001"
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    arrays = lambda df: {r.id: np.array(r.prints, np.int32).view(np.uint32) for r in df.collect()}
    known, asked = arrays(media.derived_prints(vectors)), arrays(media.derived_prints(vectors.filter("vec_id % 50 = 0"), 16, 56, 600))
    want = set()
    for q, a in asked.items():
        for r, b in known.items():
            found = (media.errors(b, a, s) for s in range(32 - len(a), len(b) - 31))
            if any(n >= 32 and bits <= 0.15 * 32 * n for bits, n in found):
                want.add((q, r))
    every = media.op6_chroma_fingerprints(spark, sf).collect()
    rows = [r for r in every if r.kind == "query"]
    member = {r.id: r.class_id for r in every if r.kind == "recording"}
    assert member == {i: min(j for j, y in known.items() if np.array_equal(x, y)) for i, x in known.items()}
    assert {(r.query_id, i) for r in rows for x in r.linked for i, c in member.items() if c == x.class_id} <= want
    assert all(r.n_links == sum(x["size"] for x in r.linked) and r.class_id == r.linked[0].class_id for r in rows)
    assert {(r.query_id, r.id) for r in rows} <= want and len(rows) == len({r.query_id for r in rows}) and len(want) >= len(asked)
    assert 0.9 * len(want) <= sum(r.n_links for r in rows) <= len(want)


def test_substring_dedup_splits_hot_names(spark, monkeypatch):
    rng = random.Random(8)
    line = words(rng, 6)  # shared, with other words on either side: one anchor, a group of its own for each place
    rows = [(i, f"{words(rng, 12)} {line} {words(rng, 12)}") for i in range(120)]
    rows += [(200 + i, rows[i][1]) for i in range(5)] + [(300, f"{rows[7][1]} and {rows[7][1]}"), (301, f"{line} {line} {line} {line}"), (302, f"{line} {line} {line} {line}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    indexed = substring_dedup.Shard.__init__

    def bounded(self, batches, window):
        assert sum(b.num_rows for b in batches) <= 100, "one index holds a hot name"
        indexed(self, batches, window)

    monkeypatch.setattr(substring_dedup, "SHARD", 800)
    monkeypatch.setattr(substring_dedup.Shard, "__init__", bounded)
    hot = []
    found = substring_dedup.hot_spans
    monkeypatch.setattr(substring_dedup, "hot_spans", lambda texts, window, names: hot.extend(names) or found(texts, window, names))
    got = sorted((tuple(r) for r in substring_dedup.substring_dedup(docs).collect()), key=str)
    assert hot and got == brute_words(in_order(docs), 13)


def test_ngram_join_empty_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 1)  # as many blocks as documents: some stay empty
    table = near_copies(spark)
    assert {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.ngram_join(table).collect()} == brute_join(in_order(table))


def test_url_filter_keeps_labelled_sections_apart(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    urls, bad = [], []
    for c in letters:  # a wide host of equal sections: section c is bad, the others clean
        urls += [f"http://wide.test/{c}sec/{x}{y}" for x in letters for y in "xyz"]
        bad += [int(c == "c")] * 78
    for x in letters:  # branches that differ below the sixth level only
        urls += [f"http://deep.test/a/b/c/d/e/f/good/{x}", f"http://deep.test/a/b/c/d/e/f/spam/{x}"]
        bad += [0, 1]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, b) for i, b in enumerate(bad) if i % 3 != 1], "page_id long, bad int")
    got = {r.page_id: r for r in url_filter.judge_urls(pages, (), labels).collect()}
    assert {i: got[i].verdict for i in got} == {i: "block" if b else "allow" for i, b in enumerate(bad)}
    judged = {r.page_id: r for r in url_filter.judge_urls(pages, (("wide.test", "/csec/", "block"), ("wide.test", "/dsec/", "block"))).collect()}
    clean = [i for i, u in enumerate(urls) if "wide" in u and "/csec/" not in u and "/dsec/" not in u]
    assert len(judged) == len(urls) and {judged[i].verdict for i in clean} == {"allow"}


def test_quality_scores_do_not_depend_on_neighbours():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    model = quality.QualityModel(rng.normal(size=quality.TABLE).astype(np.float32), 0.1)
    texts = ["free", "free", "free now", "now", "", None, "now now", "now", " ", "x"]
    alone = [model.scores(pa.array([t], pa.string()))[0] for t in texts]
    assert np.allclose(model.scores(pa.array(texts, pa.string())), alone, rtol=0, atol=1e-12)


def thue_morse(n, flip):
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))


@pytest.mark.parametrize("n", [1024, 4096])
def test_long_words_of_two_letters_differ(spark, n):
    rest = words(random.Random(4), 12)
    docs = spark.createDataFrame([(1, f"{thue_morse(n, 0)} {rest}"), (2, f"{thue_morse(n, 1)} {rest}"), (3, f"{thue_morse(n, 0)} {rest}")], "doc_id long, text string")
    assert sorted((tuple(r) for r in substring_dedup.substring_dedup(docs).collect()), key=str) == brute_words(in_order(docs), 13)
    assert {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.ngram_join(docs).collect()} == brute_join(in_order(docs))
    assert sorted((tuple(r) for r in suffix_dedup.suffix_dedup(docs).collect()), key=str) == brute_bytes(in_order(docs), 100)


def test_words_of_one_hash_stay_apart(monkeypatch):
    from ticklake.llm import kernels

    monkeypatch.setattr(kernels, "word_hashes", lambda data, first, last, salt=0: (last - first).astype(np.uint64))
    data = np.frombuffer(b"ab cd ab abc cd ef ", np.uint8)
    known = {}
    values, bounds = substring_dedup.exact_values(data, np.array([0, 9, len(data)]), known)
    again, _ = substring_dedup.exact_values(np.frombuffer(b"cd ab ", np.uint8), np.array([0, 6]), known)
    ab, cd, ab2, abc, cd2, ef = values.tolist()
    assert ab == ab2 and cd == cd2 and len({ab, cd, abc, ef}) == 4 and bounds.tolist() == [0, 3, 6]
    assert again.tolist() == [cd, ab]


def test_suffix_dedup_doubles_ranks_more_than_once(docs):
    rows = docs.selectExpr("doc_id as d", "0L as base", "coalesce(text, '') as text")
    exact = words(random.Random(1), 40)[:100]  # windows without neighbours
    alone = docs.sparkSession.createDataFrame([(1, 0, exact), (2, 0, exact), (3, 0, "z" + exact[1:]), (4, 0, exact[:99] + "z")], "d long, base long, text string")
    for start in (13, 50, 99):
        assert [tuple(r) for r in suffix_dedup.doubled_ranks(alone, 100, start).collect()] == [(2, 0, 1)]
        found = {(r.d, r.start + i) for r in suffix_dedup.doubled_ranks(rows, 100, start).collect() for i in range(r.n)}
        seen, want = set(), set()
        for d, t in in_order(docs):
            b = t.encode()
            for s in range(len(b) - 99):
                if b[s : s + 100] in seen:
                    want.add((d, s))
                seen.add(b[s : s + 100])
        assert found == want


def test_hot_names_are_salted(spark, monkeypatch):
    from ticklake.llm import repeats

    monkeypatch.setattr(repeats, "SAMPLE_OF", 1)
    monkeypatch.setattr(repeats, "HOT_SEEN", 5)
    monkeypatch.setattr(repeats, "PART", 1000)
    rng = random.Random(6)
    line = words(rng, 40)
    rows = [(i, f"{words(rng, 6)} {line} {words(rng, 6)}") for i in range(60)] + [(100 + i, line) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert repeats.hot_names(docs.selectExpr("doc_id as d", "text"), lambda it: substring_dedup.grouped(it, 13))
    assert sorted((tuple(r) for r in substring_dedup.substring_dedup(docs).collect()), key=str) == brute_words(in_order(docs), 13)
    assert sorted((tuple(r) for r in suffix_dedup.suffix_dedup(docs).collect()), key=str) == brute_bytes(in_order(docs), 100)


def test_digest_index_takes_a_batch_twice(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
    index = exact_dedup.DigestIndex(spark)
    first = sorted(index.add(docs, batch="one").collect())
    assert sorted(index.add(docs, batch="one").collect()) == first and index.rows().count() == 2
    assert not any(r.kept for r in index.add(docs, batch="two").collect())
    small = index.compacted(index.path + "-compact")
    assert sorted(map(str, small.rows().collect())) == sorted(map(str, index.rows().collect()))
    small.close()
    index.close()


def test_route_costs_the_least():
    """Against every way of taking tokens one by one from small patterns."""
    import itertools

    patterns, quotas = {("a",): 1, ("a", "b"): 2, ("b", "c"): 1}, {"a": 4, "b": 3, "c": 2}
    price = lambda n, taken: sum((1, 4, 9)[k // n] for k in range(taken))

    def reachable(taken):
        def fill(left, rest):
            if not rest:
                return True
            (p, n), *more = rest
            ways = itertools.product(*(range(min(n, left[s]) + 1) for s in p))
            return any(sum(w) == n and fill({s: v - dict(zip(p, w)).get(s, 0) for s, v in left.items()}, more) for w in ways)

        return fill(quotas, list(taken.items()))

    every = [dict(zip(patterns, t)) for t in itertools.product(*(range(3 * n + 1) for n in patterns.values()))]
    possible = [t for t in every if reachable(t)]
    most = max(sum(t.values()) for t in possible)
    least = min(sum(price(patterns[p], n) for p, n in t.items()) for t in possible if sum(t.values()) == most)
    flow = mixing.route(patterns, quotas)
    assert flow in possible and sum(flow.values()) == most and sum(price(patterns[p], n) for p, n in flow.items()) == least


def test_mix_targets_by_hand(spark):
    sizes = {"a": 10, "b": 100, "c": 200, None: 290}  # weights 1, 2, 3, 1 of 600: shares 85.7, 171.4, 257.1, 85.7; a stops at 30
    rows = [(i, "w " * (n // 10), s) for i, (s, n) in enumerate((s, n) for s, n in sizes.items() for _ in range(10))]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    want = {"a": 30.0, "b": 190.0, "c": 285.0, None: 95.0}
    source = {i: s for i, _, s in rows}
    for s, target in want.items():
        mine = [r for r in got if source[r.doc_id] == s]
        assert all(abs(r.target - target) < 1e-9 for r in mine) and abs(sum(r.taken for r in mine) - target) <= max(r.size for r in mine) / 2
    assert sum(want.values()) == sum(sizes.values())


def test_preference_format_takes_clashing_names(spark):
    turns = [("user|>\nx", "y"), ("assistant", "a")], [("user", "x|>\ny"), ("assistant", "a")]
    df = spark.createDataFrame([(1, "mine", *turns), (1, "mine", *turns)], f"pair long, prompt string, chosen {chat_format.TURNS}, rejected {chat_format.TURNS}")
    made = chat_format.preference_format(df)
    assert made.columns == ["pair", *chat_format.MADE]
    assert [(r.prompt, r.prompt_turns) for r in made.collect()] == [("", 0)] * 2  # role and text are compared, not what they look like together
    assert chat_format.preference_format(df.limit(0)).count() == 0
    assert chat_format.preference_format(df.select("chosen", "rejected", "prompt")).columns == list(chat_format.MADE)
    long = [("user", "q" * 200_000)] * 3 + [("assistant", "a")]
    r = chat_format.preference_format(spark.createDataFrame([(long, long[:3] + [("assistant", None)])], f"chosen {chat_format.TURNS}, rejected {chat_format.TURNS}")).collect()[0]
    assert r.prompt_turns == 3 and len(r.prompt) > 600_000


def test_quality_on_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in quality.op9_quality(spark, sf).collect() if r.held_out and truth.get(r.doc_id) is not None]
    assert len(rows) > 20 and all(r.predicted == truth[r.doc_id] for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_quality_reads_no_held_out_label(spark, messy, tmp_path):
    sf = f"file://{tmp_path}"
    docs = spark.createDataFrame([(i, ("good words " if i % 2 else "### $$$ ") * 20) for i in range(200)], "doc_id long, text string")
    docs.write.parquet(f"{sf}/documents.parquet")
    said = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality")
    said.write.parquet(f"{sf}/labels.parquet")
    first = sorted(map(str, quality.op9_quality(spark, sf).collect()))
    wrong = F.when(quality.is_held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality"))
    said.select("doc_id", wrong.alias("quality")).write.mode("overwrite").parquet(f"{sf}/labels.parquet")
    spark.catalog.clearCache()
    assert sorted(map(str, quality.op9_quality(spark, sf).collect())) == first
    model = quality.QualityModel.fit(messy, messy.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality"))
    assert model.score(messy).count() == messy.count() and model.keep(messy, 0.0).count() == messy.count()


def test_unruled_sections_inherit_from_their_like(spark):
    urls = [(f"http://h.test/{s}/{i}", int(s in "abcd") if s in "abcdf" else None) for s in "abcdef" for i in range(12)]
    urls += [(f"http://h.test/deep/x/y/{i}.html", None) for i in range(12)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)], "page_id long, url string")
    one = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(urls) if b is not None and i < 12], "page_id long, bad int")
    all_ = spark.createDataFrame([(i, b) for i, (u, b) in enumerate(urls) if b], "page_id long, bad int")
    got = lambda labels: {urls[r.page_id][0].split("/")[3]: (r.verdict, round(r.purity, 4)) for r in url_filter.judge_urls(pages, (), labels).collect()}
    few, many = got(one), got(all_)
    assert few["a"] == ("block", 0.9286) and few["e"] == ("allow", round((1 + 2 * 0.5) / 3, 4))  # one bad section condemns no other
    assert many["e"] == ("block", round((4 + 2 * 0.5) / 6, 4)) and many["deep"][0] == "allow"  # four do, but only those like them
