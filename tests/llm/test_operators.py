"""Operators against brute force, exact round trips and held-out accuracy, and their defined cases."""

import hashlib
import pickle
import random
import re
import weakref
import zlib
from functools import reduce

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, itq, jaccard_join, language_id, mixing, sharding, shared, simple8b, toxicity, vptree, warc
from ledgerloom.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, vertex long"
ODD = [None, "", " \n", "one", "one two", "é ñ 日本", "<|endoftext|> a", "x" * 3000, "a b c d e f " * 2000]


def documents(spark, texts, sources=None):
    rows = [(i, t, "en", (sources or ["s"] * len(texts))[i], 0, 7, 7, 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def odd_documents(spark):
    """Nulls in any column, empty and long texts, repeated rows, and columns with the operators' own names."""
    rows = [(i, t, None if i % 2 else "en", None if i % 3 else "s", None, 1, 2, 3) for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[5], rows[5], (None, "one two", None, None, None, None, None, None), (5, "other text", "en", "s", 0, 0, 0, 0)], DOCS)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 440)] + [(900, k) for k in range(901, 990)] + [(5, 5), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.vertex: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: find(v) for v in parent}


@pytest.mark.parametrize("kind", range(6))
def test_simple8b_words(kind):
    rng = np.random.default_rng(kind)
    for n in (0, 1, 61, 4096, 9000):
        x = [rng.integers(0, 49408, n), np.zeros(n), rng.integers(0, 2**64 - 1, n, dtype=np.uint64, endpoint=True), 2 ** rng.integers(0, 63, n), np.where(rng.random(n) < 0.97, 0, rng.integers(0, 2**62, n)), np.full(n, 2**64 - 1, dtype=np.uint64)][kind].astype(np.uint64)
        data = simple8b.pack_segment([3], [n], x) + simple8b.TRAILER
        [(docs, counts, y)] = simple8b.read_segments(data)
        assert len(data) % 8 == 0 and docs.tolist() == [3] and counts.tolist() == [n] and (x == y).all()
    with pytest.raises(ValueError):
        list(simple8b.read_segments(data[:-8] + b"damaged!"))


def test_simple8b_files(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    spec, library = bpe.load_spec(path), Tokenizer.from_file(path)
    docs = odd_documents(spark)
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in simple8b.encode_table(docs, spec, 2).orderBy("start").collect()]
    assert got == want
    assert simple8b.encode_table(docs.limit(0), spec, 2).count() == 0


def test_bpe_is_the_librarys(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), bpe.SegmentTreeBPE(bpe.load_spec(path))
    rng = random.Random(2)
    letters = [*"ab 'st\n\t\r  éßñ日本́ \x1c\x85\xa0😀1٣.,!ſ", "<|endoftext|>", "'ll", "  "]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + ["ab" * 700]
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in own.encode_batch(texts)] == ids
    assert all(own.decode(x[:3]) == library.decode(x[:3], skip_special_tokens=False) for x in ids)
    words = [w for w in own.known if len(w) < 30 and own.words.findall(w) == [w]][:500]
    assert words and all(list(own.merge(w)) == np.frombuffer(own.known[w], np.int32).tolist() for w in words)
    docs = odd_documents(spark)
    for r in bpe.round_trip(docs, path).collect():
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids and r.decoded == (r.text or "")
    assert bpe.round_trip(docs.limit(0), path).count() == 0


def water(sizes, weights, share, most):
    """Targets by sharing again and again what caps cut off."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        over = {s for s in names if s not in capped and w[s] * left / sum(w[x] for x in names if x not in capped) > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else w[s] * left / sum(w[x] for x in names if x not in capped) for s in names}
        capped |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 500, None: 70}, {"a": 5, "b": 5, "c": 5}, {"x": 9}, {"a": 1, "b": 1, "c": 1, "d": 5000, "e": 1}])
def test_mixing_targets(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.rates(df, [3, 1, 2], 1.5, 2.0).collect()}
    assert got == pytest.approx(water(sizes, [3, 1, 2], 1.5, 2.0))


def test_mixing_rows(spark):
    rng = random.Random(3)
    docs = documents(spark, [" ".join(["w"] * rng.randint(0, 30)) for _ in range(3000)], [rng.choice("abc") for _ in range(3000)])
    rows = mixing.mix(docs, [3, 1, 2]).collect()
    for s in "abc":
        mine = [r.mixed for r in rows if r.source == s]
        assert sum(m.taken for m in mine) == pytest.approx(mine[0].target, rel=0.1)
        assert all(m.taken <= 2 * m.size for m in mine)
    assert mixing.emit(docs, [3, 1, 2]).count() == sum(r.mixed.copies for r in rows)
    odd = odd_documents(spark)
    got = mixing.mix(odd, [3, 1, 2])
    assert got.columns == [*odd.columns, "mixed"] and got.count() == odd.count()
    assert all(r.mixed.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in got.collect())
    assert mixing.emit(odd.limit(0), [3, 1, 2]).count() == 0
    assert mixing.mix(documents(spark, [None, ""]), [3, 1, 2]).where("mixed.taken > 0").count() == 0


def test_sharding(spark):
    rng = random.Random(4)
    docs = documents(spark, ["x" * rng.randint(0, 9) for _ in range(1003)], [rng.choice(["a", "a", "b", None]) for _ in range(1003)])
    rows = sharding.interleave(docs, 8).collect()
    again = sharding.interleave(docs.repartition(3), 8).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    by = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(8)}
    assert {len(v) for v in by.values()} == {125, 126} and all(v == list(range(len(v))) for v in by.values())
    for source in ("a", "b", None):
        held = [sum(r.source == source for r in rows if r.shard == s) for s in range(8)]
        assert max(held) - min(held) <= 2
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r["size"] == len(texts[r.doc_id]) + 1 and r.law == "rows" and r.grown_shard is None for r in rows)
    odd = sharding.interleave(odd_documents(spark), 8).collect()
    assert len(odd) == odd_documents(spark).count() and sorted(sum(r.shard == s for r in odd) for s in range(8))[0] >= 1
    assert sharding.interleave(odd_documents(spark).limit(0), 8).count() == 0


def vectors(n=400, d=24, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d)).astype(np.float32)
    x[200:260] = x[100] + 0.02 * rng.standard_normal((60, d))
    x[260:300] = x[100]
    x[300:340] = x[:40] + 0.05 * rng.standard_normal((40, d))
    return x


def vector_table(spark, x):
    rows = [(i, v.tolist(), 1, 1) for i, v in enumerate(x)]
    bad = [None, [0.0] * x.shape[1], [float("nan")] * x.shape[1], [None] * x.shape[1], [float("inf")] * x.shape[1], [1.0], []]
    rows += [(len(x) + k, v, 1, 1) for k, v in enumerate(bad)] + [(None, x[0].tolist(), None, None)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int, code long")


@pytest.mark.parametrize(("scale", "shard_rows", "block"), [(1, 97, 11), (0, 10_000, 1000)])
def test_vantage_point_trees(spark, scale, shard_rows, block):
    x = vectors() * np.linspace(0.2, 3, 400)[:, None].astype(np.float32) ** scale
    df = vector_table(spark, x)
    got = vptree.nearest(df, F.col("vec_id") % 20 == 0, k=20, shard_rows=shard_rows, block_queries=block)
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    y = x.astype(float)
    assert sorted(found) == list(range(0, 400, 20))
    for q in found:
        score = [reduce(lambda s, ab: s + ab[0] * ab[1], zip(y[q].tolist(), v.tolist(), strict=True), 0.0) for v in y]  # sum() compensates
        want = sorted((i for i in range(400) if i != q), key=lambda i: (-score[i], i))[:20]
        assert [found[q][k + 1][0] for k in range(20)] == want
        assert [found[q][k + 1][1] for k in range(20)] == [score[i] for i in want]
    assert vptree.nearest(df.limit(0), F.lit(True)).count() == 0
    few = vptree.nearest(df.where("vec_id < 3"), F.lit(True), k=20)
    assert few.groupBy("query_id").count().collect() and {r["count"] for r in few.groupBy("query_id").count().collect()} == {2}


def test_relaxed_search_skips_and_finds_less():
    x = np.random.default_rng(1).standard_normal((4000, 4))
    tree = vptree.VantagePointTree(np.arange(4000), x, leaf=32)
    exact = {(a, b) for a, b, _ in zip(*tree.search(np.arange(50), x[:50], 10), strict=True)}
    all_compared, tree.compared = tree.compared, 0
    near = {(a, b) for a, b, _ in zip(*tree.search(np.arange(50), x[:50], 10, factor=0.4), strict=True)}
    assert tree.compared < all_compared < 50 * 4000 and len(near & exact) / len(exact) > 0.7


def test_embedding_near_duplicates(spark):
    x = vectors()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    label = np.arange(len(x))
    for _ in range(400):
        label = np.minimum(label, np.where(linked, label[None, :], len(x)).min(axis=1))
    got = {r.vec_id: r for r in itq.near_duplicates(vector_table(spark, x)).collect() if r.vec_id is not None}
    assert len(got) == 407
    assert [got[i].n_links for i in range(400)] == linked.sum(axis=1).tolist()
    assert [got[i].component_id for i in range(400)] == label.tolist()
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(400, 407))
    assert itq.near_duplicates(vector_table(spark, x).limit(0)).count() == 0


def test_codes_are_balanced_and_near_for_near_vectors():
    x = np.random.default_rng(0).standard_normal((3000, 64)).astype(np.float32)
    mean, projection = itq.learn(x)
    codes = itq.encode(x, mean, projection)
    bits = np.unpackbits(codes.view(np.uint8).reshape(len(codes), 8), axis=1).mean(axis=0)
    assert 0.4 < bits.min() and bits.max() < 0.6
    near = itq.encode(x + 0.1 * np.random.default_rng(1).standard_normal(x.shape), mean, projection)
    assert np.bitwise_count(codes ^ near).mean() < 6


def near_texts(rng):
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(3000)]
    base = [[rng.choice(words) for _ in range(rng.randint(30, 120))] for _ in range(40)]
    texts = [" ".join(b) for b in base]
    for b in base[:12]:
        for edits in (1, 1, 2, 3, 6):
            c = list(b)
            for _ in range(edits):
                c[rng.randrange(len(c))] = rng.choice(words)
            texts.append(" ".join(c))
    shared = " ".join(rng.choice(words) for _ in range(60))
    texts += [shared + " " + " ".join(rng.choice(words) for _ in range(90)) for _ in range(20)]
    hot = [rng.choice(words) for _ in range(80)]
    for _ in range(150):
        c = list(hot)
        for _ in range(rng.randint(0, 3)):
            c[rng.randrange(len(c))] = rng.choice(words)
        texts.append(" ".join(c))
    return texts + texts[:10] * 3 + ["one two", "one two", "one", None, ""]


def brute_links(texts):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    n = len(texts)
    linked = [[j for j in range(n) if j != i and sets[i] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8] for i in range(n)]
    label = list(range(n))
    for _ in range(n):
        new = [min([label[i], *(label[j] for j in linked[i])]) for i in range(n)]
        if new == label:
            break
        label = new
    return [len(x) for x in linked], label


def test_jaccard_join(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BUCKET_BLOCK", 40)  # hot groups are cut into cells
    monkeypatch.setattr(jaccard_join, "GROUP_BLOCK", 30)
    texts = near_texts(random.Random(8))
    links, label = brute_links(texts)
    got = {r.doc_id: (r.n_links, r.class_id) for r in jaccard_join.join(documents(spark, texts)).collect()}
    assert got == {i: (links[i], label[i]) for i in range(len(texts))}
    kept = jaccard_join.keep_one(documents(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(label)) and kept.columns == documents(spark, texts).columns


def test_jaccard_join_defined_cases(spark):
    odd = odd_documents(spark)
    rows = jaccard_join.join(odd).collect()
    assert len(rows) == odd.count()
    assert [(r.class_id, r.n_links) for r in rows if r.doc_id is None] == [(None, 0)]
    assert sorted(r.n_links for r in rows if r.doc_id == 5) == [0, 2, 2, 2] and {r.class_id for r in rows if r.doc_id == 5} == {5}
    kept = [r.doc_id for r in jaccard_join.keep_one(odd).collect()]
    assert sorted(k for k in kept if k is not None) == list(range(9)) and kept.count(None) == 1
    assert jaccard_join.join(odd.limit(0)).count() == 0


def test_bayesian_need():
    needed = jaccard_join.need(0.8, 1e-4)
    rng = np.random.default_rng(0)
    equal = (rng.random((20_000, 96)) < 0.8).cumsum(axis=1)
    lost = np.zeros(20_000, dtype=bool)
    for k, least in enumerate(needed):
        lost |= equal[:, (k + 1) * 16 - 1] < least
    assert lost.mean() < 0.01 and needed == sorted(needed)


def test_archives(spark):
    rng = random.Random(9)
    pages = [(i, f"http://h/{i}", "".join(rng.choice("<p>abc é\n") for _ in range(rng.choice([0, 20, 150, 900])))) for i in range(120)]
    pages += [(200 + i, None, pages[3][2] or "y" * 200) for i in range(5)] + [(300, "u", None), (301, "u", "z" * 99), (302, "u", "z" * 99), (303, "u", "z" * 100), (304, "u", "z" * 100), (None, None, "z" * 100), (303, "u", "z" * 100)]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, digest int")
    first = {}
    for i, _, h in pages:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    many = {h for h in first if sum(h == x[2] for x in pages) > 1}
    want = sorted(repr((i, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(), "revisit" if h in many and i != first[h] else "response", first[h] if h in many and i != first[h] else None)) for i, _, h in pages)
    got = warc.archive(df).collect()
    assert sorted(repr((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == want
    assert all(r.payload is None if r.record_type == "revisit" else hashlib.sha256(r.payload.encode()).hexdigest() == r.payload_digest for r in got)
    assert warc.archive(df.limit(0)).count() == 0


def test_damaged_archives():
    import zstandard

    records = [warc.record(i, "u", b"x" * (400 + i), "0", None) for i in range(40)]
    frame, known = warc.dictionary_frame(records)
    assert frame[:4] == warc.DICTIONARY_MAGIC
    writer = zstandard.ZstdCompressor(dict_data=known, write_checksum=True)
    data = frame + warc.EMPTY_FRAME.encode() + b"".join(writer.compress(r) for r in records)
    assert [len(b) for _, b in warc.read_archive(data)] == [len(warc.parse(r)[1]) for r in records]
    for bad in (data[:-5], data[:-1] + b"\x00", b"junkjunk" + data, frame + zstandard.compress(b"no header\r\n\r\n"), zstandard.compress(records[0][:-3])):
        with pytest.raises(ValueError):
            list(warc.read_archive(bad))


def prose(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_language_id(spark):
    rng = random.Random(10)
    letters = {"aa": "abcde", "bb": "cdefgh", "cc": "ghijk", "dd": "kéñlm", "ee": "mnopa"}
    rows = [(i, prose(rng, letters[lang], rng.randint(3, 80)), lang) for i, lang in enumerate(rng.choice(sorted(letters)) for _ in range(600))]
    rows += [(1000, None, "aa"), (1001, "12 !!", "bb"), (1002, "", None), (None, "abc abc", None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, language int")
    away = language_id.held_out("doc_id", 5, 0)
    got = language_id.identify(docs, language_id.fit(docs, ~away), out="found").withColumn("away", away).collect()
    held = [r for r in got if r.away and r.doc_id < 1000]
    assert held and sum(r.found.lang == r.lang for r in held) / len(held) > 0.97
    assert {r.doc_id: r.found.lang for r in got if r.doc_id and r.doc_id >= 1000} == {1000: "und", 1001: "und", 1002: "und"}
    assert all(r.away == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert all(0 <= r.found.score <= 1 for r in got)
    none = language_id.fit(docs.limit(0), F.lit(True))
    assert {r.language.lang for r in language_id.identify(docs.drop("language"), none).collect()} == {"und"}
    one = language_id.fit(docs.where("lang = 'aa'"), F.lit(True))
    assert language_id.identify(docs.limit(0), one).count() == 0
    assert {r.found.lang for r in language_id.identify(docs, one, out="found").collect()} == {"aa", "und"}


@pytest.mark.parametrize("n", [2, 3, 4])
def test_language_id_rejects_mixed_and_even_texts(n):
    rng = random.Random(14)
    letters = dict(zip(["aa", "bb", "cc", "dd"][:n], ["abcde", "fghij", "klmno", "pqrst"], strict=False))
    texts = [(lang, prose(rng, letters[lang], 40)) for lang in letters for _ in range(60)]
    x = np.zeros((len(texts), language_id.BUCKETS), dtype=np.float32)
    for row, (_, text) in zip(x, texts, strict=True):
        at, times = language_id.counts(language_id.plain(text))
        row[at] = times
    model = language_id.Codes(list(letters), x, np.array([list(letters).index(lang) for lang, _ in texts]))
    clear = model.predict([prose(rng, letters[lang], 40) for lang in letters for _ in range(20)])
    mixed = model.predict([f"{prose(rng, letters['aa'], 40)} {prose(rng, letters['bb'], 40)}" for _ in range(20)])
    even = model.predict([prose(rng, "".join(letters.values()), 80) for _ in range(20)])
    assert not clear.ambiguous.any() and mixed.ambiguous.mean() > 0.9 and even.ambiguous.mean() > 0.9
    assert clear.lang.tolist() == [lang for lang in letters for _ in range(20)]


def test_codewords_are_apart():
    for n in range(3, 20):
        code = language_id.codewords(n)
        apart = [(code[a] != code[b]).sum() for a in range(n) for b in range(a)]
        assert min(apart) >= (2 ** (n - 2) if n <= 7 else code.shape[1] // 5)


def test_block_max_search_is_exact():
    rng = np.random.default_rng(0)
    dense = np.where(rng.random((700, 60)) < 0.08, rng.random((700, 60)), 0)
    dense[dense.sum(axis=1) == 0, 0] = 1
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    ids = rng.permutation(700)
    index = toxicity.BlockMaxIndex(ids, [(np.flatnonzero(v), v[v > 0]) for v in dense], 60)
    for q in dense[:80]:
        docs, cosine = index.search(np.flatnonzero(q), q[q > 0], 15)
        want = np.round(dense @ q, 12)
        order = [i for i in np.lexsort((ids, -want)) if want[i] > 0][:15]
        assert docs.tolist() == order and np.allclose(cosine, want[order])


def test_toxicity(spark):
    rng = random.Random(11)
    bad = ["vilest", "rotter", "wretch"]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        w = prose(rng, "abcdefgh", rng.randint(5, 60)).split()
        for _ in range(3 * toxic):
            w.insert(rng.randrange(len(w)), rng.choice([*bad, "zzzyq" + prose(rng, "abc", 1)]))
        rows.append((i, " ".join(w), 1))
        labels.append((i, int(toxic)))
    rows += [(2000, None, 1), (2001, "", 1), (None, "vilest", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxicity int")
    marks = spark.createDataFrame([*labels, (None, 1), (7, None), (5000, 1), (6, 1), (6, 0)], "doc_id long, toxic int")
    away = language_id.held_out("doc_id", 3, 1)
    model = toxicity.fit(docs, marks, ~away)
    got = toxicity.score(docs, model, out="t").withColumn("away", away).collect()
    held = [r for r in got if r.away and r.doc_id is not None and r.doc_id < 2000]
    assert sum(r.t.predicted == int(r.doc_id % 6 == 0) for r in held) / len(held) > 0.97
    bare = {r.doc_id: r.t for r in got if r.text in (None, "")}
    assert all(0 <= t.score < 0.2 and t.evidence == [] for t in bare.values())
    assert all(0 <= r.t.score <= 1 and (r.t.predicted == 1) == (r.t.score >= 0.7) for r in got)
    assert toxicity.keep_clean(docs, model).columns == docs.columns
    for empty in (marks.limit(0), marks.where("toxic = 0")):
        assert toxicity.score(docs, toxicity.fit(docs, empty, F.lit(True)), out="t").where("t.predicted = 1").count() == 0
    assert toxicity.score(docs.limit(0), model, out="t").count() == 0


def test_toxicity_weighs_all_terms_of_few_examples(spark):
    rng = random.Random(13)
    rows = [(i, prose(rng, "abcdefgh", 30)) for i in range(40)]
    rows = [(i, f"{t} scum loser" if i < 5 else t) for i, t in rows]
    rows += [(100, rows[7][1]), (101, rows[2][1]), (102, prose(rng, "abcdefgh", 30) + " scum loser")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 5)) for i in range(40)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    assert set(model.terms) == {t for _, text in rows[:40] for t in toxicity.terms(text)}
    # document frequencies are those of all rows
    df = {t: sum(t in toxicity.terms(text) for _, text in rows) for t in ("scum", *toxicity.words(rows[7][1])[:3])}
    seen = {t: [sum(t in toxicity.terms(rows[i][1]) for i in range(40) if (i < 5) == bad) for bad in (True, False)] for t in model.terms}
    gain = dict(zip(seen, toxicity.gains(*np.array(list(seen.values()), dtype=float).T, 5, 35), strict=True))
    for t, n in df.items():
        assert abs(model.term_weight[model.terms[t]] - (np.log(44 / (1 + n)) + 1) * (0.01 + gain[t] / max(gain.values()))) < 1e-9
    got = {r.doc_id: r.t for r in toxicity.score(docs, model, out="t").where("doc_id >= 100").collect()}
    assert [got[100].evidence[0].doc_id, got[101].evidence[0].doc_id] == [7, 2] and min(got[k].evidence[0].cosine for k in (100, 101)) > 0.999999
    assert min(got[101].score, got[102].score) > 0.5 > got[100].score
    assert {e.doc_id for e in got[102].evidence[:5]} == set(range(5))


def test_toxicity_against_brute_force(spark):
    """Score and evidence of every text, ties, repeated rows and a very long text too, from plain dictionaries."""
    rng = random.Random(17)
    rows = [(i, prose(rng, "abcdefgh", rng.randint(4, 40)) + " scum" * (i % 7 == 0)) for i in range(220)]
    rows += [(300, rows[7][1]), (301, rows[7][1]), (301, rows[7][1]), (302, prose(rng, "abcdefgh", 30_000) + " scum"), (303, None), (304, ""), (305, "zzz 12")]
    docs = spark.createDataFrame([(*r, None) for r in rows], "doc_id long, text string, evidence string")
    marks = spark.createDataFrame([(i, int(i % 7 == 0)) for i in [*range(150), 300, 301]], "doc_id long, toxic int")
    model = toxicity.fit(docs, marks, F.lit(True))
    texts = dict(rows)
    examples = {i: int(i % 7 == 0) for i in [*range(150), 300, 301]}
    has = [toxicity.terms(x) for _, x in rows]
    held = {i: toxicity.terms(texts[i]) for i in examples}
    df = {t: sum(t in x for x in has) for t in model.terms}
    seen = np.array([[sum(t in held[i] for i, y in examples.items() if y == side) for t in model.terms] for side in (1, 0)], dtype=float)
    gain = toxicity.gains(seen[0], seen[1], sum(examples.values()), len(examples) - sum(examples.values()))
    weight = {t: (np.log((1 + len(rows)) / (1 + df[t])) + 1) * (0.01 + g / gain.max()) for t, g in zip(model.terms, gain, strict=True)}

    def vector(text):
        v = {t: (1 + np.log(n)) * weight[t] for t, n in toxicity.terms(text).items() if t in weight}
        length = np.sqrt(sum(x * x for x in v.values()))
        return {t: x / length for t, x in v.items()}

    vectors = {i: vector(texts[i]) for i in examples}
    prior = sum(examples.values()) / len(examples)
    for r in toxicity.score(docs, model, out="t").collect():
        v = vector(r.text)
        cosine = {i: round(sum(x * w.get(t, 0) for t, x in v.items()), 12) for i, w in vectors.items()}
        near = sorted((i for i in cosine if cosine[i] > 0), key=lambda i: (-cosine[i], i))[: toxicity.K]
        assert [e.doc_id for e in r.t.evidence] == near or sorted(round(cosine[i], 9) for i in near) == sorted(round(cosine[e.doc_id], 9) for e in r.t.evidence)
        assert all(abs(e.cosine - cosine[e.doc_id]) < 1e-9 and e.label == examples[e.doc_id] for e in r.t.evidence)
        share = [1 / (1.05 - min(1, cosine[i])) for i in near]
        vote = min(1 - 1e-4, (sum(s * examples[i] for s, i in zip(share, near, strict=True)) + prior) / (sum(share) + 1))
        want = 1 / (1 + np.exp(-(model.slope * np.log(vote / (1 - vote)) + model.offset))) if near else prior
        assert abs(r.t.score - want) < 1e-6 and r.t.predicted == int(r.t.score >= 0.7)


@pytest.mark.parametrize("n", [1_000, 100_000, 2_000_000])
def test_hamming_tables_meet_near_vectors_at_any_size(n):
    """The codes that design chooses for n vectors bring 99 % of pairs at the threshold together."""
    bits, tables, width, radius = itq.design(n)
    rng = np.random.default_rng(3)
    x = rng.standard_normal((4000, 64))
    unit, away = x / np.linalg.norm(x, axis=1, keepdims=True), rng.standard_normal(x.shape)
    away -= (away * unit).sum(axis=1, keepdims=True) * unit
    near = 0.9501 * unit + np.sqrt(1 - 0.9501**2) * away / np.linalg.norm(away, axis=1, keepdims=True)
    mean, projection = itq.learn(x, bits)
    a, b = itq.encode(x, mean, projection), itq.encode(near, mean, projection)
    met = (np.bitwise_count(itq.substrings(a, tables, width) ^ itq.substrings(b, tables, width)) <= 2).any(axis=1)
    assert (met & (np.bitwise_count(a ^ b).sum(axis=1) <= radius)).mean() > 0.99
    assert a.shape[1] * 64 == bits >= tables * width and 2 ** (width + 1) > min(n, 2**32)


def test_buckets_of_vectors_are_not_sent_to_the_driver(spark):
    """A vector has many more rows in buckets than its codes' size tells Spark, which would broadcast them."""
    x = np.random.default_rng(8).standard_normal((400, 16)).astype(np.float32)
    mean, projection = itq.learn(x)
    parts = itq.substrings(itq.encode(x, mean, projection), 4, 16)
    rows = [(i, bytes(8), p) for i, p in enumerate(parts.tolist())]
    vertices = shared.settle(spark.createDataFrame(rows, "vertex long, code binary, parts array<long>"))
    met = itq._met(vertices, 16, 64)
    assert {r.vertex for r in met.collect()} == {i for i, p in enumerate(parts) if (np.bitwise_count(np.delete(parts, i, axis=0) ^ p) <= 2).any()}
    assert "Broadcast" not in met._jdf.queryExecution().executedPlan().toString()


def test_sample_of_vectors_is_that_of_least_hash(spark):
    rows = [(i % 900, [float(i)]) for i in range(1000)]
    for most, ids in ((20, rows), (20, [(7, v) for _, v in rows]), (2000, rows)):  # ids of one hash: all of them may seem too large
        good = spark.createDataFrame(ids, "vec_id long, vector array<float>").repartition(8)
        want = good.orderBy(F.xxhash64("vec_id"), F.xxhash64("vector")).limit(most).collect()
        assert itq._sample(good, most) == [r.vector for r in want]


def test_names_of_columns_never_clash(spark):
    """Columns called like those that operators add for a while come back as they were."""
    names = ["mix_size", "mix_rate", "copy", "mixed", "bpe", "language", "toxicity", "keep_n", "_mix_size", "_toxicity"]
    docs = spark.createDataFrame([(i, f"some words of text {i} and a few more", "en", "s", *[-7] * len(names)) for i in range(8)], ["doc_id", "text", "lang", "source", *names])
    model = language_id.fit(docs, F.lit(True))
    marks = spark.createDataFrame([(i, int(i < 2)) for i in range(8)], "doc_id long, toxic int")
    for got in (
        mixing.emit(docs, [1]), bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json")), language_id.keep_identified(docs, model),
        toxicity.keep_clean(docs, toxicity.fit(docs, marks, F.lit(True))), jaccard_join.keep_one(docs),
    ):
        rows = got.select(*docs.columns).collect()
        assert rows and all(r[n] == -7 for r in rows for n in names)
    assert {r["mix_size"] for r in mixing.mix(docs, [1]).collect()} == {-7}


def test_repeated_vectors_and_ids(spark):
    x = np.random.default_rng(4).standard_normal((60, 8)).astype(np.float32)
    rows = [(i % 50, v.tolist()) for i, v in enumerate(x)] + [(3, x[3].tolist())] * 2 + [(None, x[0].tolist()), (None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = itq.near_duplicates(df).collect()
    assert len(found) == len(rows) and {r.vec_id: r.component_id for r in found if r.vec_id == 3}[3] is not None
    assert all(r.n_links >= 2 for r in found if r.vec_id == 3 and r.n_links) and [r.component_id for r in found if r.vec_id is None] == [None, None]
    near = vptree.nearest(df, F.col("vec_id") % 20 == 0, k=5).collect()
    assert all(r.vec_id != r.query_id and r.vec_id is not None for r in near) and {r.query_id for r in near} == {0, 20, 40}


def test_language_codes_against_brute_force():
    """Language, score and ambiguity from plain loops over n-grams and codewords; ties, repeats and a very long text too."""
    rng = random.Random(15)
    letters = {"aa": "abcde", "bb": "defgh", "cc": "ghijk", "dd": "klméñ"}
    texts = [(lang, prose(rng, letters[lang], 30)) for lang in letters for _ in range(40)]
    x = np.zeros((len(texts), language_id.BUCKETS), dtype=np.float32)
    for row, (_, text) in zip(x, texts, strict=True):
        at, times = language_id.counts(language_id.plain(text))
        row[at] = times
    model = language_id.Codes(list(letters), x, np.array([list(letters).index(lang) for lang, _ in texts]))
    asked = [t for _, t in texts[::7]] + [texts[0][1], texts[0][1], None, "", "12 !", "a", "é", prose(rng, "abcdeklm", 60), prose(rng, letters["cc"], 60_000), "ABCDE 77 abcde"]
    got = model.predict(asked)

    def bucket(*b):
        value = 0
        for k, v in enumerate(b):
            value = (value * (257 if k == 1 else 263) + v) % 2**32 if k else v
        times, plus = {1: (2654435761, 0), 2: (2246822519, 77), 3: (3266489917, 191)}[len(b)]
        return ((value * times + plus) % 2**32) >> (32 - (language_id.BUCKETS - 1).bit_length())

    for text, lang, score, ambiguous in zip(asked, got["lang"], got["score"], got["ambiguous"], strict=True):
        raw = re.sub(r"[\W\d_]+", " ", text or "").strip().lower()
        if not raw:
            assert (lang, score) == ("und", 0)
            continue
        data = f" {raw} ".encode()
        held = {}
        for i in range(len(data) - 2):
            for n in (1, 2, 3):
                held[bucket(*data[i : i + n])] = held.get(bucket(*data[i : i + n]), 0) + 1
        total = sum(held.values())
        outputs = [sum(np.sqrt(c / total) * float(model.w[b, k]) for b, c in held.items()) + model.bias[k] for k in range(model.code.shape[1])]
        loss = [sum(w * np.log1p(np.exp(-int(c) * o)) for w, c, o in zip(model.bit_weight, word, outputs, strict=True)) for word in model.code]
        order = sorted(range(len(loss)), key=lambda k: loss[k])
        share = np.exp(-3 * (np.array(loss) - min(loss)))
        apart = sum(w for w, a, b in zip(model.bit_weight, model.code[order[0]], model.code[order[1]], strict=True) if a != b)
        margin = (loss[order[1]] - loss[order[0]]) / apart / model.typical[order[0]]
        assert lang == list(letters)[order[0]] and abs(score - share[order[0]] / share.sum()) < 1e-4
        assert ambiguous == (margin < language_id.AMBIGUOUS) or abs(margin - language_id.AMBIGUOUS) < 1e-3


def test_language_training_rows_are_the_same_whatever_the_order(spark):
    rng = random.Random(16)
    rows = [(i % 90, prose(rng, "abc" if i % 2 else "def", 8), "aa" if i % 2 else "bb") for i in range(400)] + [(i, None, "cc") for i in range(50)] + [(i, "12", "dd") for i in range(50)]
    models = [language_id.fit(spark.createDataFrame(r, "doc_id long, text string, lang string").repartition(n), F.lit(True), sample=20) for r, n in ((rows, 1), (rows[::-1], 7))]
    assert models[0].languages == models[1].languages == ["aa", "bb"]
    assert (models[0].w == models[1].w).all() and (models[0].typical == models[1].typical).all()


def test_tokens_of_all_kinds_of_characters():
    """Both encoders against the library over code points in context, every one below 0x600 and each 41st above."""
    from tokenizers import Tokenizer

    points = [*range(1, 0x600), *range(0x600, 0xD800, 41), *range(0xE000, 0x110000, 1009)]
    texts = ["".join(f"a{chr(p)}b {chr(p)}{chr(p)} 1{chr(p)}.\n{chr(p)} X" for p in points[k : k + 12]) for k in range(0, len(points), 12)]
    byte, word = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
    own = bpe.SegmentTreeBPE(bpe.load_spec(byte))
    want = [e.ids for e in Tokenizer.from_file(byte).encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in own.encode_batch(texts)] == want
    own = simple8b.WordTokenizer(bpe.load_spec(word))
    want = [e.ids for e in Tokenizer.from_file(word).encode_batch(texts, add_special_tokens=False)]
    assert [own.encode(t).tolist() for t in texts] == want


def test_workers_keep_one_model(spark):
    """A codec goes when a stage that needs none begins; a model is sent once and isn't part of what every task unpickles."""
    spec = bpe.load_spec(public_tokenizers.path("byte_bpe_50k.json"))
    codec = bpe._codec(spec)
    assert bpe._codec(spec) is codec
    codec = weakref.ref(codec)
    shared.tidy()
    assert codec() is None
    docs = documents(spark, [f"some words of text {i} and a few more" for i in range(8)])
    model = toxicity.fit(docs, spark.createDataFrame([(i, int(i < 2)) for i in range(8)], "doc_id long, toxic int"), F.lit(True))
    sizes = []
    send = type(spark.sparkContext).broadcast
    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(spark.sparkContext), "broadcast", lambda sc, value: (sizes.append(type(value)), send(sc, value))[1])
        assert len(toxicity.score(docs, model).collect()) == 8
    assert sizes == [toxicity.Model]


def test_words_that_are_forgotten_leave_the_vocabulary():
    own = {"alpha": 0, "alphab*": 1, "beta": 2, "alpha*": 3}
    words = toxicity.Words(own)
    first = dict(words), words.flat.tobytes()
    for _ in range(2):
        assert words["alphabet"] and words["gamma"] == 0 and len(words) == len(first[0]) + 2
        again = pickle.loads(pickle.dumps(words))
        assert (dict(again), again.flat.tobytes()) == first and again["alphabet"] == words["alphabet"]
        words.forget()
        assert (dict(words), words.flat.tobytes()) == first and not [x for x in vars(words).values() if isinstance(x, dict) and x is not own]
