"""Word, byte, fingerprint, token and URL operators against brute force, with the awkward cases of every contract."""

import functools
import hashlib
import re
import zlib
from collections import Counter
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from spanforge.llm import bwtdedup, chunks, decontam, idcodec, langid, nearcopies, packing, quality, sharding, simhash, superkmers, urls
from spanforge.llm.tokens import TokenEncoder, default_path
from tests.compare import differences
from tests.conftest import SF

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
RNG = np.random.default_rng(5)
VOCAB = ["alpha", "bêta", "gamma", "δ", "the", "of", "x#1", "line"]


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(VOCAB, n)).replace("of the", "of\nthe").replace("line", "li ne\t")


def awkward():
    """Nulls, empty and wordless texts, copies, near copies, repeated rows and ids, a long text, shared passages."""
    passage = prose(90, 99)
    rows = [(1, "", "en", "s", 0), (2, None, "en", "s", None), (3, " \t\n", None, None, 3), (None, prose(80, 1), "de", "s", 1), (4, prose(80, 1), "de", "s", 1)]
    rows += [(5, prose(80, 1), "en", "s", 1), (5, prose(80, 1), "en", "s", 1), (7, prose(60, 7) + " " + passage, "fr", "s", 1), (6, passage + "\n" + prose(50, 8), "fr", "s", 1)]
    rows += [(8, prose(6000, 8), "en", "s", 1), (9, prose(79, 1) + " end", "en", "s", 1), (10, "the " * 300, "en", "s", 1), (11, "x", "en", "s", 1), (12, "12 34 !!", "en", "s", 1), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(r):
    return tuple((v is None, v) for v in r)


def test_simhash(docs, empty):
    def fp(text):
        w = (text or "").translate({i: i + 32 for i in range(65, 91)})
        w = WORD.findall(w)
        if not w:
            return 0
        hs = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    rows = [(d, fp(t)) for d, t, *_ in awkward()]
    comp = {}
    for f in {f for _, f in rows}:
        seen, todo = {f}, [f]
        while todo:
            g = todo.pop()
            near = {h for _, h in rows if (g ^ h).bit_count() <= 4} - seen
            seen |= near
            todo += near
        comp[f] = min((d for d, h in rows if h in seen and d is not None), default=None)
    got = simhash.near_duplicates(docs).select("doc_id", simhash.hex_fingerprint("fp").alias("f"), "component_id").collect()
    assert sorted(map(tuple, got), key=key) == sorted([(d, f"{f:016x}", comp[f]) for d, f in rows], key=key)
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_cells_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL_ROWS", 20)
    base = RNG.integers(0, 1 << 63, 30, dtype=np.int64)
    flips = [int(base[i % 30]) ^ int(sum(1 << int(b) for b in RNG.choice(62, RNG.integers(0, 7), replace=False))) for i in range(600)]
    fps = np.array(sorted(set(flips)), np.int64)
    nodes = spark.createDataFrame([(i, int(f)) for i, f in enumerate(fps)], "node long, fp long")
    edges = simhash.fingerprint_links(nodes, 4).collect()
    a, b = np.nonzero(np.triu(np.bitwise_count(fps.view(np.uint64)[:, None] ^ fps.view(np.uint64)[None, :]) <= 4, 1))
    want = simhash.forest(len(fps), a, b)
    got = simhash.forest(len(fps), np.array([e.a for e in edges]), np.array([e.b for e in edges]))
    assert (want == got).all()


@pytest.mark.parametrize("radius,spare", [(4, 3), (6, 2), (6, 3)])
def test_simhash_links_alike_for_any_number_of_blocks(spark, radius, spare):
    rng = np.random.default_rng(radius + spare)
    base = rng.integers(0, 1 << 62, 40, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 62, (400, radius + 1), dtype=np.uint64), axis=1)
    fps = np.unique(base[rng.integers(0, 40, 400)] ^ flips)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    want = simhash.forest(len(fps), *np.nonzero(near))
    nodes = spark.createDataFrame(list(enumerate(fps.view(np.int64).tolist())), "node long, fp long")
    edges = simhash.fingerprint_links(nodes, radius, spare).collect()
    assert all(near[e.a, e.b] or want[e.a] == want[e.b] for e in edges)
    assert simhash.forest(len(fps), np.array([e.a for e in edges], int), np.array([e.b for e in edges], int)).tolist() == want.tolist()


def test_simhash_blocks_follow_the_number_of_fingerprints():
    for radius in (4, 6):
        chosen = [simhash.spare_blocks(10**k, radius) for k in range(12)]
        assert chosen == sorted(chosen) and chosen[0] == 2
        assert 10**10 / 2 ** (64 * chosen[10] // (radius + chosen[10])) < 1000


def test_drop_near_duplicates_keeps_one(docs):
    left = simhash.drop_near_duplicates(docs, 4, 4)
    ids = [r.doc_id for r in left.collect()]
    assert 5 not in ids and 2 not in ids and ids.count(None) == 2 and left.columns == docs.columns


def test_near_copies_are_verified(spark, empty):
    def words(seed, n):
        return [f"w{x}" for x in np.random.default_rng(seed).integers(0, 5000, n)]

    def changed(seed, at):
        return " ".join("edit" if i in at else w for i, w in enumerate(words(seed, 200)))

    rows = []
    for i in range(30):
        base = words(i, 200)
        rows += [(10 * i, " ".join(base)), (10 * i + 1, " ".join(base + words(1000 + i, 40))), (10 * i + 2, changed(i, {30, 90, 150})), (10 * i + 3, changed(i, set(range(15, 200, 19))))]
    rows += [(10, " ".join(words(5000, 90))), (10, " ".join(words(2, 200))), (7000, " ".join(words(7000, 60))), (7000, " ".join(words(7000, 60))), (None, " ".join(words(8000, 60))), (None, " ".join(words(8000, 60)))]
    sets = [nearcopies.shingle_set(t.encode(), 5) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 9 * both >= 4 * (len(sets[i]) + len(sets[j])) and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    want = {}
    for (d, t), g in zip(rows, group, strict=True):
        want[g] = min(want.get(g, (True, 0, "x")), (d is None, d or 0, t))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = nearcopies.drop_near_copies(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in got) == sorted(want.values())
    assert nearcopies.drop_near_copies(empty).count() == 0


@pytest.mark.parametrize("chunk_bytes", [chunks.CHUNK_BYTES, 1_500])
def test_substring_words(docs, empty, monkeypatch, chunk_bytes):
    monkeypatch.setattr(chunks, "chunked", functools.partial(chunks.chunked, chunk_bytes=chunk_bytes))
    rows = [(d, WORD.findall(t or "")) for d, t, *_ in awkward()]
    first = {}
    for d, w in rows:
        for i in range(len(w) - 12):
            k = tuple(w[i : i + 13])
            if d is not None:
                first[k] = min(first.get(k, d), d)
    want = []
    for d, w in rows:
        gone = [False] * len(w)
        for i in range(len(w) - 12):
            if first.get(tuple(w[i : i + 13]), 10**9) < (10**8 if d is None else d):
                gone[i : i + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert sum(x[2] for x in want) > 100
    assert sorted(map(tuple, superkmers.dedup_digest(docs).collect()), key=key) == sorted(want, key=key)
    assert superkmers.dedup_digest(empty).count() == 0
    texts = superkmers.dedup_text(docs)
    assert texts.columns == [*docs.columns, "n_words", "n_removed"]
    untouched = {r.doc_id: r.text for r in texts.where("n_removed = 0").collect()}
    assert untouched[12] == "12 34 !!" and untouched[2] is None and untouched[3] == " \t\n"


@pytest.mark.parametrize("chunk_bytes", [chunks.CHUNK_BYTES, 1_500])
def test_substring_bytes(docs, empty, monkeypatch, chunk_bytes):
    monkeypatch.setattr(chunks, "chunked", functools.partial(chunks.chunked, chunk_bytes=chunk_bytes))
    rows = [(d, (t or "").encode()) for d, t, *_ in awkward()]
    times = Counter(b[i : i + 200] for _, b in rows for i in range(len(b) - 199))
    want = []
    for d, b in rows:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if times[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        want.append((d, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    assert sum(x[2] for x in want) > 1000
    assert sorted(map(tuple, bwtdedup.dedup_digest(docs).collect()), key=key) == sorted(want, key=key)
    assert bwtdedup.dedup_digest(empty).count() == 0


def test_collection_transform():
    for seed in range(40):
        r = np.random.default_rng(seed)
        sizes = r.integers(0, 9, r.integers(1, 8))
        sizes[0] = max(1, sizes[0])
        symbols = r.integers(1, 3, sizes.sum()).astype(np.int32)
        origin, lcp = bwtdedup.Collection(symbols, sizes.astype(np.int64)).build()
        first, own = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
        suffix = [((*symbols[i : first[own[i]] + sizes[own[i]]].tolist(), 0), int(own[i])) for i in range(len(symbols))]
        assert [suffix[i] for i in origin] == sorted(suffix)
        for k in range(1, len(origin)):
            a, b = suffix[origin[k - 1]][0][:-1], suffix[origin[k]][0][:-1]
            assert lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def encoded(rows, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_path())
    return [(d, [*t.encode(x or "", add_special_tokens=False).ids, end]) for d, x, *_ in rows]


def test_tokens_equal_the_library():
    import pyarrow as pa

    texts = [t for _, t, *_ in awkward()] + ["a  b", " lead", "trail ", "tab\t x", "nb\xa0 sp", "don't we'll", "x   y\n\n z", "éa.b, c!! 123 4a", "<|endoftext|> x", "日本 語", "a" * 3000]
    counts, ids = TokenEncoder.of(default_path()).encode(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [e[:-1] for _, e in encoded([(0, t) for t in texts], 0)]


def test_token_files(docs, empty):
    got = [tuple(r) for r in idcodec.write_and_read(docs).collect()]
    crc = lambda e: zlib.crc32(np.array(e, "<u4").tobytes())
    want = Counter((d, len(e), crc(e)) for d, e in encoded(awkward(), 2))
    assert Counter((d, n, c) for d, _, n, c in got) == want
    at = 0
    for d, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
    order = [-1 if d is None else d for d, *_ in sorted(got, key=lambda r: r[1])]
    assert order == sorted(order)
    assert idcodec.write_and_read(empty).count() == 0


@pytest.mark.parametrize("top", [1, 2, 50_000, 1 << 40, (1 << 64) - 1])
def test_codec_round_trip(top):
    for n in (0, 1, 1023, 1024, 1025, 4000):
        v = np.random.default_rng(n).integers(0, top, n, dtype=np.uint64, endpoint=True)
        v[: n // 3] = 0
        words, frames = idcodec.encode(v)
        assert (idcodec.decode(words) == v).all() and len(frames) == -(-n // idcodec.FRAME)
        for f, at in enumerate(frames.tolist()):
            assert (idcodec.decode(words[at:])[:10] == v[f * idcodec.FRAME :][:10]).all()


def test_packing(docs, empty):
    got = packing.pack_digest(docs, length=64).toPandas()
    want = Counter((d, tuple(e)) for d, e in encoded(awkward(), 0))
    assert got.length.sum() == sum(len(e) for _, e in want.elements())
    by_start = {}
    for r in got.itertuples():
        by_start.setdefault((None if np.isnan(r.doc_id) else int(r.doc_id), r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
    for (d, e), times in want.items():
        pieces = by_start[d, len(e)]
        for start, length, crc in pieces:
            if sum(1 for x, y in want if x == d and len(y) == len(e)) == 1:
                assert zlib.crc32(np.array(e[start : start + length], "<u4").tobytes()) == crc
        assert times >= 1
    for _, s in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert s.offset.tolist() == [0, *np.cumsum(s.length)[:-1]] and s.length.sum() <= 64
    assert set(got.sequence_id) == set(range(got.sequence_id.max() + 1))
    assert packing.pack(empty).count() == 0


def test_hilbert_curve_is_continuous():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = packing.hilbert_key(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1).max() == 1


def test_quality_counts(spark, docs, empty):
    labels = spark.createDataFrame([(4, 1, 0), (8, 1, 0), (10, 0, 0), (None, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.judge_quality(docs, labels).collect()
    want = []
    for d, t, *_ in awkward():
        t = t or ""
        w = WORD.findall(t)
        tri = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        rep = set()
        for i in range(len(w) - 2):
            if tri[tuple(w[i : i + 3])] > 1:
                rep |= {i, i + 1, i + 2}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want.append((d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep), len(w) < 50 or 100 * len(rep) > 50 * len(w)))
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted([tuple(r[n] for n in names) for r in got], key=key) == sorted(want, key=key)
    assert all(not r.kept for r in got if r.base_failed)
    assert quality.judge_quality(empty, labels).count() == 0
    assert quality.judge_quality(docs, labels.limit(0)).where(F.col("kept") == F.col("base_failed")).count() == 0


def test_quality_ratio_separates(spark):
    good = [(i, prose(60, i)) for i in range(40)]
    poor = [(100 + i, " ".join(np.random.default_rng(i).choice(["A!!", "B$$", "C%%", "D&&", "E**", "F##", "G!!", "H$$"], 60))) for i in range(10)]
    docs = spark.createDataFrame(good + poor, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(100 + i, 0, 0) for i in range(5)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in quality.judge_quality(docs, labels).where("base_failed or kept").collect()}
    assert kept >= set(range(40)) and not kept & {100 + i for i in range(10)} - {r.doc_id for r in quality.judge_quality(docs, labels).where("base_failed").collect()}


def test_quality_rejects_toxic(spark):
    rows = [(i, " ".join(f"w{x}" for x in np.random.default_rng(i).integers(0, 300, 120))) for i in range(200)]
    for i in range(0, 200, 4):  # one document in four holds a few of the words; all are of good quality
        rows[i] = (i, rows[i][1] + " Moron, you " + ["scum idiot.", "clown idiot!", "scum clown"][i % 3])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(160)] + [(1000, 0, 0)], "doc_id long, quality int, toxic int")
    judged = quality.judge_quality(docs, labels).where("not base_failed").collect()
    assert not [r.doc_id for r in judged if r.doc_id % 4 == 0 and r.kept] and [r.doc_id for r in judged if r.doc_id % 4 == 0 and r.doc_id >= 160]
    assert len([r for r in judged if r.doc_id % 4 and not r.kept]) <= 2


def test_language(spark, empty):
    rows = [(i, prose(40, i) if i % 2 else "zürich größe straße und der die " * 5, "aa" if i % 2 else "de") for i in range(60)]
    rows += [(100, None, "aa"), (101, "12 !!", "aa"), (102, "und der größe", None), (None, "und die straße", "de"), (103, "a\0b größe \0\0 der", "de"), (104, "", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, langid.learn(docs)).collect()}
    assert got[100] == got[101] == got[104] == ("und", 0.0) and got[102][0] == got[None][0] == got[103][0] == "de"
    assert all(got[i][0] == ("aa" if i % 2 else "de") and 0 < got[i][1] <= 1 for i in range(60))
    assert langid.predict(docs, langid.learn(docs.limit(0))).where("lang_pred <> 'und'").count() == 0
    folds = docs.select("doc_id", langid.held_out().alias("h")).where("doc_id is not null").collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in folds)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = langid.predict(docs, langid.learn(docs.where(~langid.held_out()))).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out())
    assert found.where("lang_pred = lang").count() >= 0.97 * found.count()


def test_leaks(spark, docs, empty):
    item = prose(30, 99)
    words = prose(90, 99).split()
    items = spark.createDataFrame([(1, " ".join(words[10:40])), (2, "never seen " * 8), (3, None), (4, "too short"), (5, " ".join(words[50:70]).upper()), (1, " ".join(words[10:40]))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.find_leaks(docs, items).collect()}
    assert {(7, 1), (6, 1), (7, 5), (6, 5)} <= set(got) and not {i for _, i in got} & {2, 3, 4} and got[7, 1] == 1.0
    left = decontam.decontaminate(docs, items)
    assert left.where("doc_id in (6, 7)").count() == 0 and left.where("doc_id is null").count() == 2
    assert decontam.find_leaks(empty, items).count() == decontam.find_leaks(docs, items.limit(0)).count() == 0
    assert item


def test_near_leak_threshold(spark):
    w = [f"w{i}" for i in range(60)]
    edited = w[:30] + ["changed"] + w[31:]
    docs = spark.createDataFrame([(1, "pre " + " ".join(edited) + " post"), (2, " ".join(w[:20] + ["x", "y"] + w[35:]))], "doc_id long, text string")
    items = spark.createDataFrame([(9, " ".join(w))], "item_id long, text string")
    got = decontam.find_leaks(docs, items).collect()
    assert [(r.doc_id, r.item_id, round(r.similarity, 6), r.window_start) for r in got] == [(1, 9, round(51 / 61, 6), 1)]


def brute_leaks(docs, items):
    """All (doc, item) with a window of weighted Jaccard of 0.8 or more, over every window; texts of 5 words and more."""
    def bag(t):
        w = t.lower().split()
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]

    out = set()
    for d, t in docs:
        b = bag(t)
        for i, x in items:
            own = Counter(bag(x))
            n = sum(own.values())
            for at in range(max(1, len(b) - n + 1)):
                win = Counter(b[at : at + n])
                both = sum((win & own).values())
                if 9 * both >= 4 * (n + sum(win.values())):
                    out.add((d, i))
                    break
    return out


def test_leaks_against_all_windows(spark):
    r = np.random.default_rng(3)
    words = lambda n: [f"w{x}" for x in r.integers(0, 4000, n)]
    items = [(i, words(int(r.integers(20, 70)))) for i in range(12)]
    docs = []
    for i, x in items:
        n = len(x)
        spread = ["edit" if k in {n // 5, n // 2} else w for k, w in enumerate(x)]
        variants = [x, x[n // 2 :] + x[: n // 2], x[: n // 3] + ["one", "more"] + x[n // 3 :], x[2:], x[: -n // 12], spread, x[: n // 2], ["edit"] + x[1:-1] + ["edit"], x[:5] + x[:5] + x, x[: n // 4] + x[n // 4 + 1 :]]
        docs += [(100 * i + k, " ".join(words(40) + v + words(60))) for k, v in enumerate(variants)] + [(100 * i + 50, " ".join(x[: n - 3])), (100 * i + 51, " ".join(words(90)))]
    text = [(i, " ".join(x)) for i, x in items] + [(90, "one two"), (91, "yes"), (92, "one two"), (93, " ")]
    extra = [(9000, "say one TWO three"), (9001, "yes"), (9002, None), (9003, ""), (9004, "one. two")]
    want = brute_leaks(docs, [(i, t) for i, t in text if i < 90]) | {(9000, 90), (9000, 92), (9001, 91)}
    frame = spark.createDataFrame(docs + extra, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("n", "size", "item_id", "mark")}).repartition(3)
    bench = spark.createDataFrame(text, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    got = {(x.doc_id, x.item_id) for x in decontam.find_leaks(frame, bench).collect()}
    assert got <= want and len(got) >= 0.9 * len(want) and len(want) > 60
    assert {(100 * i, i) for i in range(12)} <= got
    swapped = {(100 * i + 1, i) for i in range(12)} & want
    assert swapped and len(swapped & got) >= 0.9 * len(swapped)
    assert sorted(decontam.decontaminate(frame, bench).columns) == sorted(frame.columns)


def test_reordered_passage_is_found(spark):
    item = [f"w{i}" for i in range(60)]
    doc = [f"a{i}" for i in range(100)] + item[30:] + item[:30] + [f"b{i}" for i in range(100)]
    docs = spark.createDataFrame([(1, " ".join(doc))], "doc_id long, text string")
    items = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, items).collect()] == [(1, 9)]


def test_item_tables_follow_the_items(spark, monkeypatch):
    """Files laid down for the items' tables don't follow the session's partitions; several partitions give the same."""
    r = np.random.default_rng(11)
    words = lambda n: [f"w{x}" for x in r.integers(0, 4000, n)]
    items = [(i, " ".join(words(30))) for i in range(20)] + [(50 + k, " ".join(words(3))) for k in range(8)]
    rows = [(i, " ".join([*words(30), t, *words(10)])) for i, t in items]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    home = Path(urlparse(spark.conf.get("spark.checkpoint.dir")).path)
    own = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    kept = {k: spark.conf.get(k) for k in own}

    def found():
        before = set(home.rglob("part-*"))
        leaks = decontam.find_leaks(docs, bench)
        made = len(set(home.rglob("part-*")) - before)
        return made, sorted(tuple(x) for x in leaks.collect())

    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        made, few = found()
        assert made == 4  # two tables each of the long and the short items
        monkeypatch.setattr(decontam, "PART_WORDS", 100)
        more, many = found()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert 4 < more <= 2 * (6 + 1)
    assert few == many and {(i, i) for i, _ in items} <= {x[:2] for x in few}


def test_block_index_is_complete(spark):
    r = np.random.default_rng(1)
    base = r.integers(-(1 << 63), 1 << 63, 60, dtype=np.int64)
    flipped = [int(b) ^ int(np.bitwise_or.reduce(np.uint64(1) << r.choice(64, decontam.RADIUS, replace=False).astype(np.uint64)).view(np.int64)) for b in base]
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(base, flipped, strict=True)], "x long, y long")
    assert df.where(F.size(F.array_intersect(decontam.near_blocks("x", decontam.RADIUS), decontam.blocks("y"))) > 0).count() == 60


def test_urls(spark):
    rules = urls.rules_frame(spark, [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"), ("a.b/x", "block")])
    cases = [("http://X.Example.NET/en/1", "example.net/en/", "allow"), ("http://example.net/EN/", "net/", "block"), ("http://net?x", None, "allow"), ("http://q.net/?x", "net/", "block"), ("ftp://badnet/", None, "allow"),
             ("nourl", None, "allow"), (None, None, "allow"), ("http://example.com/de", None, "allow"), ("://example.com/de/#", "example.com/de/", "block"), ("http://a.b/xyz", "a.b/x", "block"), ("http://org/fr/a://b", "org/fr/", "allow")]
    pages = spark.createDataFrame([(i, u) for i, (u, _, _) in enumerate(cases)] * 2, "page_id long, url string").withColumn("rule", F.lit("clash"))
    got = urls.judge_urls(pages, rules, ["page_id"]).collect()
    assert len(got) == 2 * len(cases)
    for r in got:
        assert (r.rule, r.verdict) == cases[r.page_id][1:], cases[r.page_id]
    assert urls.judge_urls(pages.limit(0), rules, ["page_id"]).count() == 0
    assert urls.judge_urls(pages, rules.limit(0), ["page_id"]).where("verdict = 'allow' and rule is null").count() == 2 * len(cases)


def test_sharding(spark):
    names = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(names, 1009)
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.lookup_table(names[:-1], 1009)
    moved = sum(1 for a, b in zip(table, fewer, strict=True) if a != 6 and a != b)
    assert moved < 0.2 * 1009
    heavy = Counter(sharding.lookup_table(names, 1009, {"s0": 3}))
    assert heavy[0] > 2.5 * heavy[1]
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "doc_id long, shard string")
    got = sharding.assign_shards(df, "doc_id", names).collect()
    assert len(got) == 3 and len({r.shard for r in got if r.doc_id == 1}) == 1
    for bad in (lambda: sharding.lookup_table(names, 1000), lambda: sharding.lookup_table(["a", "a"]), lambda: sharding.lookup_table([])):
        with pytest.raises(ValueError):
            bad()


def clashing(spark):
    """A table whose further columns bear operators' names and hold what JSON would lose."""
    import datetime

    rows = [(i, prose(70, i % 3), datetime.datetime(2024, 1, 2, 3, 4, 5, 123456), {1: "a b"}, (7, "x"), i) for i in range(6)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words timestamp, kept map<int,string>, shard struct<`a b`:int,n_removed:string>, slot long")


def test_clashing_columns(spark):
    df = clashing(spark)
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    rest = ["n_words", "kept", "shard", "slot"]
    want = {r.doc_id: tuple(r[c] for c in rest) for r in df.collect()}
    out = superkmers.dedup_text(df)
    assert out.columns == ["doc_id", "text", "n_words_input", "kept", "shard", "slot", "n_words", "n_removed"]
    got = out.collect()
    assert {r.doc_id: (r.n_words_input, r.kept, r.shard, r.slot) for r in got} == want and {r.n_removed > 0 for r in got if r.doc_id > 2} == {True}
    out = quality.judge_quality(df, labels, keep=df.columns)
    assert len(set(out.columns)) == len(out.columns)
    assert {r.doc_id: (r.n_words_input, r.kept_input, r.shard, r.slot) for r in out.collect()} == want
    out = sharding.assign_shards(df, "slot", ["a", "b"])
    assert {r.doc_id: (r.n_words, r.kept, r.shard_input, r.slot_input) for r in out.collect()} == want
    assert nearcopies.drop_near_copies(df.drop("kept")).count() == 3
    assert idcodec.write_and_read(df).count() == packing.pack(df).select("doc_id").distinct().count() == 6
    assert langid.predict(df, {}).count() == simhash.near_duplicates(df).count() == bwtdedup.dedup_digest(df).count() == 6


def test_one_letter_texts_have_a_language(spark):
    docs = spark.createDataFrame([(0, "b b b", "x"), (1, "a", "y"), (2, "1 a 2", None), (3, "a", None)], "doc_id long, text string, lang string").coalesce(1)
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, langid.learn(docs)).collect()}
    assert got == {0: "x", 1: "y", 2: "y", 3: "y"}


def test_language_against_plain_counts(spark):
    """Profiles and cosines from a plain loop over trigrams."""
    rows = [(i, prose(30, i) if i % 2 else "größe und straße der " * 3 + str(i), "aa" if i % 2 else "de") for i in range(12)]
    base, classes = langid.letter_vectors().astype(int), langid.letter_classes()

    def vector(t):
        out, flat = np.zeros(langid.DIM), [0]
        for ch in t:
            c = int(classes[ord(ch)])
            if c or flat[-1]:
                flat.append(c)
        flat += [0] if flat[-1] else []
        for a, b, c in zip(flat, flat[1:], flat[2:], strict=False):
            if b:
                out += np.roll(base[a], 2) * np.roll(base[b], 1) * base[c]
        return out

    profiles = {k: sum(vector(t) for _, t, x in rows if x == k) for k in ("aa", "de")}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = langid.learn(docs)
    assert all((got[k] == profiles[k]).all() for k in profiles)
    for r in langid.predict(docs, got).collect():
        v = vector(rows[r.doc_id][1])
        cos = {k: float(v @ p / np.linalg.norm(v) / np.linalg.norm(p)) for k, p in profiles.items()}
        assert r.lang_pred == max(cos, key=cos.get) and abs(r.score - max(0.0, cos[r.lang_pred])) < 1e-6


def test_shards_against_plain_turns(spark):
    """The lookup table from a plain reading of the method, and every row's place in it."""
    names, size = ["a", "b", "c"], 101
    order = {}
    for s in names:
        d = hashlib.sha256(s.encode()).digest()
        offset, skip = int.from_bytes(d[:8], "little") % size, int.from_bytes(d[8:16], "little") % (size - 1) + 1
        order[s] = [(offset + k * skip) % size for k in range(size)]
    table = {}
    while len(table) < size:
        for s in names:
            if free := [x for x in order[s] if x not in table][:1]:
                table[free[0]] = s
    assert [names[i] for i in sharding.lookup_table(names, size)] == [table[i] for i in range(size)]
    df = spark.createDataFrame([(i % 7 or None, i) for i in range(50)], "doc_id long, x long")
    got = sharding.assign_shards(df, "doc_id", names, size).collect()
    assert len(got) == 50 and all(r.shard == table[r.slot] == names[r.shard_id] for r in got)
    assert sharding.assign_shards(df.limit(0), "doc_id", names, size).count() == 0


def test_long_texts(spark):
    """A text of 200 000 words goes through every operator of rows."""
    rows = [(1, " ".join(f"w{x}" for x in np.random.default_rng(1).integers(0, 90_000, 200_000)), "en"), (2, "short", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    pages = spark.createDataFrame([(1, "http://" + "a." * 5000 + "net/" + "x/" * 50_000)], "page_id long, url string")
    assert [r.rule for r in urls.judge_urls(pages, urls.rules_frame(spark, [("net/", "block")]), ["page_id"]).collect()] == ["net/"]
    assert langid.predict(docs, langid.learn(docs)).count() == 2
    items = spark.createDataFrame([(5, " ".join(rows[0][1].split()[150_000:150_040]))], "item_id long, text string")
    assert [(r.doc_id, r.window_start) for r in decontam.find_leaks(docs, items).collect()] == [(1, 150_000)]


def test_sql_of_registered_queries(spark):
    from spanforge.llm import queries as q

    for name in q.oracle_sql():
        assert not differences(name, spark, SF, q.queries(), q.oracle_sql())
