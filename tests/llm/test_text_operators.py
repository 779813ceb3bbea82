"""Operators 1, 2, 3, 8, 9 and 10 against brute force over a small table of ordinary and odd rows."""

import collections
import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexspark.llm import bpe, decontaminate, langid, packing, simhash, token_counts, wavelet
from lexspark.llm.common import connected_components, scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, h string, fp string"
WORDS = {"en": "the of and to in is that for it as was with be by on", "de": "der die und in den von zu das mit sich des auf für ist im", "fr": "de la le et les des en un du une que est pour qui dans"}


def sentence(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang].split()) + rng.choice(["", "ung", "er", ",", "."]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    out = [(i, sentence(rng, lang, rng.randrange(5, 120)), lang) for i, lang in enumerate(["en", "de", "fr"] * 20)]
    base = sentence(rng, "en", 300)
    words = base.split()
    out += [(100 + k, " ".join(words[:k] + ["changed"] + words[k + 1 :]), "en") for k in range(8)]  # near copies
    out += [(120, base, "en"), (121, base, "en"), (121, base, "en"), (122, None, None), (123, "", "en"), (None, "no id here", "en"), (None, None, None)]
    out += [(130, "  \n\t ", "de"), (131, "12345 !!! ...", "fr"), (132, "Ω 한국어 text <|endoftext|> it's 'S", None), (133, "A" * 5000, "en"), (134, "x " * 6000, "en"), (135, "İstanbul's ﬁ ẞ", "de")]
    out += [(200, "prefix words " + ITEMS[0][1] + " suffix", "en"), (201, ITEMS[1][1].upper(), "en"), (202, (sentence(rng, "en", 600) + " " + ITEMS[0][1]), "en"), (203, "tiny item and more", "en")]
    return out


ITEMS = [(0, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho"), (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
         (2, "tiny item"), (3, None), (4, "..."), (None, "omicron pi rho"), (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu other end"), (10, "tiny ITEM")]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, lang, "s", 0, 1, "clash", "clash") for i, t, lang in texts], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


@pytest.mark.parametrize("name, kind", [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_encoder_equals_library(name, kind, texts):
    e = bpe.PretokenEncoder(bpe.vocabulary(name), kind, table_bits=7)  # a small table is emptied again and again
    rng = random.Random(3)
    odd = ["".join(chr(rng.choice([rng.randrange(0x250), rng.randrange(128), 32, 39, 10, 115, 108, 114, 101])) for _ in range(50)) for _ in range(800)]
    given = [t for _, t, _ in texts] + odd + ["\n\n x", "a\r\n\tb  c", "'ll've's", "!'s '", "x<|startoftext|>y"]
    want = [e.tokenizer.encode(t or "", add_special_tokens=False).ids for t in given]
    a = "a"
    while len(a) < 4096:  # such runs and their complements share any polynomial hash modulo 2**64
        a += a.translate(str.maketrans("ab", "ba"))
    for n in (16, 32, 64, 1024, 2048, 4096):
        given += [a[:n], a[:n].translate(str.maketrans("ab", "ba"))]
    given += ["x" * 10_000, " ".join([a[:64], a[:64], "q" * 65, "q" * 65]), "=" * 300 + "7" * 300]
    want = [e.tokenizer.encode(t or "", add_special_tokens=False).ids for t in given]
    assert [x.tolist() for x in e.batch(given)] == want
    assert e.counts(given).tolist() == [len(w) for w in want]


def test_equal_hashes_of_different_pretokens(monkeypatch):
    """Every pre-token of one length has one hash: the table's hits are compared."""
    import numpy as np

    monkeypatch.setattr(bpe, "span_hashes", lambda code, s, e: (e - s).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    e = bpe.PretokenEncoder(bpe.vocabulary("byte_bpe_50k.json"), "byte", table_bits=7)
    given = ["the cat and the dog", "cat dog fox the", "bird 123 456 !! ??", ""]
    want = [e.tokenizer.encode(t, add_special_tokens=False).ids for t in given]
    for _ in range(2):
        assert [x.tolist() for x in e.batch(given)] == want
        assert e.counts(given).tolist() == [len(w) for w in want]
    assert e.counts([]).tolist() == [] and list(e.batch([])) == []


def test_token_counts(spark, docs, empty, texts):
    path = scratch_path(spark, "cache")
    tok = bpe.encoder(bpe.vocabulary("word_bpe_49k.json"), "word").tokenizer
    want = sorted(((i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in texts), key=str)
    assert rows(token_counts.token_counts(docs, path), "doc_id", "n_bytes", "n_tokens") == want
    held = token_counts.read_cache(spark, path).count()
    assert held == len({" ".join(re.sub(r"[ \t\n\x0b\x0c\r]+", " ", (t or "").lower()).split(" ")).strip(" ") for _, t, _ in texts})
    assert rows(token_counts.token_counts(docs, path), "doc_id", "n_bytes", "n_tokens") == want
    assert token_counts.read_cache(spark, path).count() == held  # only misses are encoded
    digest = F.sha2(F.lit("x"), 256)
    none, some = (spark.range(1).select(digest.alias("digest")).where(w) for w in ("false", "true"))
    assert token_counts.texts_of(docs, none, []).count() == 0  # and no text moves for the others
    assert token_counts.texts_of(docs, some, []).count() == 0
    assert token_counts.token_counts(empty, scratch_path(spark, "cache")).count() == 0


def test_special_strings_are_not_normalised(spark):
    df = spark.createDataFrame([(1, "a <|ENDOFTEXT|> b"), (2, "a <|endoftext|> b")], "doc_id long, text string")
    tok = bpe.encoder(bpe.vocabulary("word_bpe_49k.json"), "word").tokenizer
    want = [(i, len(tok.encode(t, add_special_tokens=False).ids)) for i, t in ((1, "a <|ENDOFTEXT|> b"), (2, "a <|endoftext|> b"))]
    assert rows(token_counts.token_counts(df, scratch_path(spark, "cache")), "doc_id", "n_tokens") == want


def test_byte_vocabulary_counts_raw_texts(spark):
    texts = ["the   Quick\n\nBROWN Fox", "the quick brown fox"]
    vocab = bpe.vocabulary("byte_bpe_50k.json")
    want = [(k, len(bpe.encoder(vocab, "byte").tokenizer.encode(t, add_special_tokens=False).ids)) for k, t in enumerate(texts)]
    assert want[0][1] != want[1][1]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert rows(token_counts.token_counts(df, scratch_path(spark, "cache"), vocab, "byte"), "doc_id", "n_tokens") == want


@pytest.mark.parametrize("n", [0, 1, 7, 511, 512, 513, 3000])
def test_wavelet_matrix(n):
    rng = np.random.default_rng(n)
    v = (rng.integers(0, 50_257, n) if n < 1000 else rng.integers(0, 40, n)).astype(np.uint16)
    s = wavelet.Shard.load(wavelet.Shard([1, None], np.array([n // 2, n - n // 2]), wavelet.WaveletMatrix.build(v, 16)).dump())
    m = s.matrix
    assert (m.decode(np.uint16) == v).all() and s.doc_ids == [1, None]
    for i in rng.integers(0, n, min(n, 25)).tolist():
        c = int(v[i])
        assert m.access(i) == c and m.rank(c, i) == int((v[:i] == c).sum()) and m.count(c) == int((v == c).sum())
        assert m.select(c, m.rank(c, i)) == i
    assert m.count(60_000) == 0
    with pytest.raises(IndexError):
        m.select(60_000, 0)
    for c in np.unique(v)[:5].tolist():
        assert m.selects(c, np.arange(m.count(c))).tolist() == np.flatnonzero(v == c).tolist()


def test_a_look_up_inflates_few_frames():
    v = np.random.default_rng(1).integers(0, 300, 600_000).astype(np.uint16)
    m = wavelet.Shard.load(wavelet.Shard([1], np.array([len(v)]), wavelet.WaveletMatrix.build(v, 9)).dump()).matrix
    assert m.access(123_456) == v[123_456] and m.select(7, 100) == np.flatnonzero(v == 7)[100]
    assert max(len(p.held) for p in m.planes) < len(m.planes[0].frames)
    began = time.perf_counter()
    assert m.selects(5, np.arange(m.count(5))).tolist() == np.flatnonzero(v == 5).tolist()
    assert time.perf_counter() - began < 5


def test_shards_read_back(spark, docs, empty, texts):
    tok = bpe.encoder(bpe.vocabulary("byte_bpe_50k.json"), "byte").tokenizer
    path = scratch_path(spark, "shards")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        wavelet.write_shards(docs, path, shard_tokens=4000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    shards = wavelet.read_shards(spark, path)
    got = wavelet.shard_documents(shards, with_ids=True).orderBy("start").collect()
    want = {}
    for i, t, _ in texts:
        want.setdefault(i, []).append(tok.encode(t or "", add_special_tokens=False).ids + [2])
    at = 0
    for r in got:
        assert r["ids"] in want[r["doc_id"]]
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    assert [r["doc_id"] for r in got] == sorted((i for i, _, _ in texts), key=lambda x: (x is not None, x))
    found = wavelet.token_occurrences(shards, 2, 3).collect()
    assert max(len(r["places"]) for r in found) == 3 and sum(len(r["places"]) for r in found) == sum(x.count(2) for w in want.values() for x in w)
    assert len({r["part"] for r in shards.collect()}) > 1
    wavelet.write_shards(empty, path)
    assert wavelet.shard_documents(wavelet.read_shards(spark, path)).count() == 0


def slow_fingerprint(text):
    import xxhash

    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids, linked):
    root = list(range(len(ids)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(ids)):
        for b in range(a):
            if linked(a, b):
                root[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for a in range(len(ids)):
        groups[find(a)].append(ids[a])
    low = {k: min((i for i in v if i is not None), default=None) for k, v in groups.items()}
    return [low[find(a)] for a in range(len(ids))]


def test_simhash(spark, docs, empty, texts):
    fp = [slow_fingerprint(t) for _, t, _ in texts]
    want = slow_components([i for i, _, _ in texts], lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 4)
    got = simhash.near_duplicates(docs)
    assert rows(got.select("doc_id", (F.lower(F.lpad(F.hex("fp"), 16, "0"))).alias("x"), "component_id"), "doc_id", "x", "component_id") == sorted(((i, f"{f:016x}", c) for (i, _, _), f, c in zip(texts, fp, want)), key=str)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == sorted({(c,) for c in want}, key=str)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


@pytest.mark.parametrize("tau, file, refiled", [(4, 64, 1024), (4, 2, 1024), (4, 2, 1), (5, 2, 1), (3, 1, 1), (2, 2, 1)])
def test_links_of_dense_groups_keep_components(spark, tau, file, refiled):
    rng = random.Random(9)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for c in list(fps)[:6]:  # balls of fingerprints that share segments
        for _ in range(120):
            f = c
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                f ^= 1 << b
            fps.add(f)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = {r["node"]: r["root"] for r in connected_components(simhash.links(df, tau, file, refiled), plain=100).collect()}
    want = slow_components(signed, lambda a, b: (fps[a] ^ fps[b]).bit_count() <= tau)
    assert [roots.get(f, f) for f in signed] == want


def test_texts_of_one_template_are_filed_until_files_are_small(spark, monkeypatch):
    """Three segments are the same for all fingerprints: files of two segments, and of three, hold all of them."""
    rng = random.Random(4)
    base = rng.getrandbits(64) & ((1 << 38) - 1)
    fps = {base | rng.getrandbits(26) << 38 for _ in range(1500)}
    for c in sorted(fps)[:100]:  # links that the third filing must find: two bits in each of the last segments
        fps.add(c ^ (0b101 << 39) ^ (0b11 << 52))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    sizes = []
    plain = simhash._pairs

    def counted(met, keys, *more):
        sizes.append(met.where("not guest").groupBy(*keys).count().agg(F.max("count")).first()[0] or 0)
        return plain(met, keys, *more)

    monkeypatch.setattr(simhash, "_pairs", counted)
    roots = {r["node"]: r["root"] for r in connected_components(simhash.links(df, 4, 64, 200)).collect()}
    want = slow_components(signed, lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 4)
    assert [roots.get(f, f) for f in signed] == want
    assert len(sizes) == 3 and max(sizes) <= 200 < len(fps)


def test_components_of_long_paths(spark):
    n = 300
    edges = [(k, k + 1) for k in range(n)] + [(1000, 1001), (5, 5), (None, 3), (7, 6)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(n + 1)} | {1000: 1000, 1001: 1000}
    with pytest.raises(RuntimeError, match="unfinished"):
        connected_components(spark.createDataFrame(edges, "u long, v long"), max_rounds=1)
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def slow_cost(counts, context, byte):
    """Bits of a byte after a context: escapes through ever shorter contexts."""
    for n in range(len(context), -1, -1):
        seen = counts[context[len(context) - n :]]
        if not seen:
            continue
        total = sum(seen.values()) + len(seen)
        if byte in seen:
            return -np.log2(seen[byte] / total)
        return -np.log2(len(seen) / total) + (slow_cost(counts, context[len(context) - n + 1 :], byte) if n else 8.0)
    return 8.0


def test_language_id(spark, docs, empty, texts):
    model = langid.learn(docs, langid.fold() != 1)
    assert model.langs == ["de", "en", "fr"]
    learned = [(t, lang) for i, t, lang in texts if i is not None and t is not None and lang and zlib.crc32(str(i).encode()) % 3 != 1]
    trees = {}
    for lang in model.langs:
        counts = collections.defaultdict(collections.Counter)
        for t, of in learned:
            if of == lang:
                b = b"    " + t.encode()
                for k in range(4, len(b)):
                    for n in range(5):
                        counts[b[k - n : k]][b[k]] += 1
        trees[lang] = counts
    for text in ["der und die", "the quick of", "zzzz", "Ωé"]:
        b = b"    " + text.encode()
        want = [sum(slow_cost(trees[lang], b[k - 4 : k], b[k]) for k in range(4, len(b))) for lang in model.langs]
        assert np.allclose(model.code_lengths([None, text, ""])[1], want, rtol=1e-4)
    got = {(r["doc_id"], r["text"]): r for r in langid.identify(docs, model, ["doc_id", "text"]).collect()}
    for i, t, lang in texts:
        r = got[i, t]
        assert 0 <= r["score"] <= 1
        if not t or not any(map(str.isalpha, t)):
            assert r["lang_pred"] == "und" and r["score"] == 0
    held = [(got[i, t]["lang_pred"], lang) for i, t, lang in texts[:60] if zlib.crc32(str(i).encode()) % 3 == 1]
    assert held and sum(a == b for a, b in held) >= 0.95 * len(held)
    assert langid.identify(empty, model, ["doc_id"]).count() == 0
    none = langid.learn(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(docs, none, ["doc_id"]).collect()} == {"und"}


def test_every_language_has_a_text_in_the_sample(spark):
    data = [(k, f"{w} " * 2000, lang) for lang, w, at in (("a", "alpha", 0), ("b", "beta", 10)) for k in range(at, at + 5)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = langid.learn(df, F.lit(True), sample_bytes=1)
    assert model.predict(["alpha alpha", "beta beta"])[0] == ["a", "b"]


def test_many_languages_and_clashing_columns(spark):
    rng = random.Random(4)
    alphabets = {f"l{k:02d}": [chr(0x61 + (7 * k + j) % 26) for j in range(6)] for k in range(11)}
    text = lambda lang, n=60: " ".join("".join(rng.choice(alphabets[lang]) for _ in range(5)) for _ in range(n))
    data = [(k, text(lang), lang, 1, 2) for k, lang in enumerate(list(alphabets) * 6)] + [(900, "99 !", None, 1, 2)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, score int, __text int")
    model = langid.learn(df, F.lit(True), total_bytes=11 * 1500)
    assert len(model.groups) == 3 and model.langs == sorted(alphabets)
    got = langid.identify(df, model, df.columns)
    assert got.columns == ["doc_id", "text", "lang", "__text", "lang_pred", "score", "bits_per_byte"]
    assert sum(r["lang"] != r["lang_pred"] for r in got.where("lang is not null").collect()) <= 2
    assert langid.known(df, model).columns == df.columns and langid.known(df, model).count() == len(data) - 1


def test_without_labels_the_stage_keeps_texts_with_letters(spark):
    import corpus_pipeline

    given = [(1, "a text", None), (2, None, None), (3, "123 !", None), (4, "", None), (5, "é", None)]
    df = spark.createDataFrame(given, "doc_id long, text string, lang string")
    assert rows(corpus_pipeline.language_id(spark, df, ""), "doc_id", "text", "lang") == [given[0], given[4]]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_contamination(texts, items):
    def words(t):
        return WORD.findall("".join(c.lower() if c.isascii() else c for c in t or ""))

    out = []
    for i, t, _ in texts:
        w, hit, found = words(t), set(), set()
        for item, it in items:
            v = words(it)
            n = min(13, len(v))
            windows = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if n else set()
            for k in range(len(w) - n + 1 if n else 0):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found.add(item)
        ids = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_a_long_text_of_one_word_items(spark):
    n = 120_000
    df = spark.createDataFrame([(1, "spam " * n + "egg", 7), (2, None, 7), (3, "other words", 7)], "doc_id long, text string, hit_doc int")
    items = spark.createDataFrame([(1, "spam"), (2, "spam spam"), (3, "egg"), (4, " ".join(["spam"] * 20))], "item_id long, text string")
    began = time.perf_counter()
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.contamination(df, items).collect()}
    assert got == {1: (n + 1, n + 1, ["1", "2", "3", "4"]), 2: (0, 0, []), 3: (2, 0, [])}
    assert time.perf_counter() - began < 60
    assert rows(decontaminate.clean(df, items), "doc_id", "hit_doc") == [(2, 7), (3, 7)]


def test_decontamination(spark, docs, empty, texts):
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, h string")
    got = decontaminate.contamination(docs, items)
    got = got.select("doc_id", "n_words", "n_hit", F.size("items").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("sha"), "contaminated")
    want = slow_contamination(texts, ITEMS)
    assert rows(got, *got.columns) == want
    assert sum(r[5] for r in want) >= 3
    assert rows(decontaminate.clean(docs, items), "doc_id") == sorted(((r[0],) for r in want if not r[5]), key=str)
    assert decontaminate.contamination(empty, items).count() == 0
    assert decontaminate.contamination(docs, items.limit(0)).where("n_hit > 0").count() == 0


def test_packing(spark, docs, empty, texts):
    tok = bpe.encoder(bpe.vocabulary("byte_bpe_50k.json"), "byte").tokenizer
    got = packing.pack(docs, with_ids=True).collect()
    want = collections.Counter((i, tuple(tok.encode(t or "", add_special_tokens=False).ids + [1])) for i, t, _ in texts)
    used, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        ids = np.frombuffer(r["ids"], "<u2")
        assert len(ids) == r["length"] and r["ids_crc32"] == zlib.crc32(ids.astype("<u4").tobytes())
        used[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"], r["start"]].append(tuple(ids.tolist()))
    for parts in used.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048
    assert sorted(used) == list(range(len(used)))
    whole = collections.Counter()
    for (i, start), found in pieces.items():
        if start == 0 and all(len(x) < 2048 for x in found):
            whole.update((i, x) for x in found)
    assert all(want[k] == n for k, n in whole.items())
    assert sum(r["length"] for r in got) == sum(len(k[1]) * n for k, n in want.items())
    assert packing.pack(empty).count() == 0


def test_column_generation_fills_sequences():
    rng = np.random.default_rng(2)
    sizes = np.arange(1, 128)
    demand = rng.integers(0, 3000, 127).astype(float) + 1
    plan = packing.solve_patterns(sizes, demand, 128)
    assert (sum(n * a for n, a in plan) == demand).all()
    assert all((a * sizes).sum() <= 128 for _, a in plan)
    least = max((demand * sizes).sum() / 128, demand[sizes > 64].sum())
    assert sum(n for n, _ in plan) <= 1.02 * least + 2
    assert packing.solve_patterns(np.array([], int), np.array([]), 128) == []
