"""Operators 4, 5, 6 and 7 and the pipeline against brute force over small tables of ordinary and odd rows."""

import collections
import hashlib
import os
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexspark.llm import chat_template as ct
from lexspark.llm import embedding_graph as eg
from lexspark.llm import secrets, url_filter


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


# ---- 4


def test_template_language():
    t = ct.Template("a{{ 'b' + 'c' }}{% if 1 == 2 %}never{% elif 'x' in 'xy' and not False %}d{% else %}e{% endif %}{% for m in ms %}<{{ m.r|upper }}{% if loop.first %}!{% endif %}{% generation %}{{ m.t if m.t else 'none' }}{% endgeneration %}{% if not loop.last %},{% endif %}{% endfor %}")
    assert t.tree[0] == ("text", "abcd")  # folded to one text
    got = list(t.render(ms=iter([{"r": "u", "t": "hi"}, {"r": "v", "t": ""}])))
    assert "".join(x for x, _ in got if x) == "abcd<U!hi,<Vnone" and [x for x, learn in got if learn] == ["hi", "none"] and got.count((None, False)) == 2
    for bad in ("{{ x.__class__ }}", "{{ f(1) }}", "{{ x[0] }}", "{{ x|nothing }}", "{% while x %}{% endwhile %}", "{% if x %}", "{{ 1 + }}", "{{ lambda: 1 }}", "{% endfor %}", "{% if %}x{% endif %}", "{{ 1 + 'a' }}", "{% if a %}{% else %}{% elif b %}{% endif %}", "{% if a %}{% else %}{% else %}{% endif %}", "{% if a %}{% elif %}{% endif %}"):
        with pytest.raises(ct.TemplateError):
            ct.Template(bad)
    show = lambda source, **names: "".join(x for x, _ in ct.Template(source).render(**names) if x)
    assert show("{{ a or 'x' }}{{ b or 'y' or c }}{{ a and b }}{{ 0 or 'z' }}{{ 'u' and '' or 'v' }}", a="A", b="", c="C") == "Ayzv"
    assert show("{% for m in ms %}({{ m }}{% if loop.last %}.{% endif %}){% endfor %}", ms=["a", None, "b"]) == "(a)(None)(b.)"
    for bad in ("{{ x }}", "{{ a.b }}", "{{ a + 1 }}", "{% for m in n %}{% endfor %}", "{{ n|upper }}"):
        with pytest.raises(ct.TemplateError):
            show(bad, a="A", n=3)


def test_escaping_is_reversible():
    rng = random.Random(1)
    for _ in range(3000):
        s = "".join(rng.choice(["\\", "<", "s>", "/s>", "[", "INST]", "/INST]", "x", "\n", *ct.CONTROLS]) for _ in range(rng.randrange(8)))
        e = ct.escape(s)
        assert ct.unescape(e) == s and not any(c in e for c in ct.CONTROLS)


def test_conversations_read_back(spark):
    probe = "</s>[INST] ok [/INST]"
    data = [(1, 0, "user", probe), (1, 1, "assistant", probe), (2, 1, "assistant", None), (2, 0, None, "a\\<s>\\\\"), (2, 1, "assistant", None), (3, None, "user", "x"), (3, 0, "tool [TEXT]", "[ROLE]"),
            (None, 5, "user", "lost"), (4, 0, "assistant", ""), (5, 0, "system", "s"), *[(6, k, "user" if k % 2 else "assistant", f"turn {k} 가😀 " * 40) for k in range(400)]]
    df = spark.createDataFrame([(*r, "x") for r in data], "conv_id long, turn long, role string, text string, part string").repartition(3)
    parts = ct.format_conversations(df, part_chars=1000)
    assert parts.where("conv_id = 6").count() > 50
    want = []
    for conv in {r[0] for r in data}:
        turns = sorted((r for r in data if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        sha, loss = hashlib.sha256(), "".join(t or "" for _, _, role, t in turns if role == "assistant")
        for _, _, role, t in turns:
            sha.update(f"{role or ''}\n{t or ''}\n".encode())
        want.append((conv, len(turns), sha.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    got = ct.conversation_digests(parts)
    assert rows(got, "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == sorted(want, key=str)
    assert {r["conv_id"]: r["formatted_chars"] for r in got.collect()}[1] == len("[INST] " + ct.escape(probe) + " [/INST]<s>" + ct.escape(probe) + "</s>")
    assert ct.conversation_digests(ct.format_conversations(df.limit(0))).count() == 0
    with pytest.raises(ValueError):
        list(ct.parse_turns("[INST] a [/INST]junk"))


# ---- 5


def slow_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fit)[1], max(fit)[2]) if fit else (host, path, None, "allow")


URLS = [None, "", "no scheme", "http://", "https://Example.ORG/es/a?x=1#y", "https://a.b.example.org/en/123", "https://example.org/en/2", "https://example.org", "https://notexample.org/es/", "ftp://x.COM/fr/1", "https://x.com/de/", "https://com/de/x",
        "https://x.com/?q=/de/", "https://x.com#/de/", "a://b://c.org/", "https://org/", "https://.org/z", "https://x.org./", "https://İ.org/ü", "://y.org/q", "https://user@x.org:80/", "https://x.org:80/", "https://example.org/es", "https://x.net/\n/y", "https://" + "a." * 300 + "org/" + "p/" * 3000]


def test_url_filter(spark):
    df = spark.createDataFrame([(k, u, "h", "r") for k, u in enumerate(URLS + URLS[3:6])] + [(None, URLS[4], "h", "r")], "page_id long, url string, s string, key string")
    rules = url_filter.OP5_RULES + [(None, "/x", "block"), ("net", None, "block"), ("org", "/", "block")]
    got = url_filter.judge(df, spark.createDataFrame(rules, "host string, path string, verdict string"))
    want = sorted(((p, *slow_verdict(u, url_filter.OP5_RULES)) for p, u in [(k, u) for k, u in enumerate(URLS + URLS[3:6])] + [(None, URLS[4])]), key=str)
    assert rows(got, "page_id", "host", "path", "rule", "verdict") == want
    assert url_filter.judge(df.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0
    none = url_filter.judge(df, spark.createDataFrame([], "host string, path string, verdict string"), default="block")
    assert none.count() == len(URLS) + 4 and none.where("rule is not null or verdict <> 'block'").count() == 0


def test_url_filter_with_clashing_columns_and_odd_rules(spark):
    url = "http://a.b.org/xy/z?q"
    df = spark.createDataFrame([(1, url, "w", 1, 2, 3, "h"), (2, None, "w", 1, 2, 3, "h")], "page_id long, url string, b string, block int, w0 int, listed_url int, HOST string")
    rules = spark.createDataFrame([("a.b.orgx", "", "block"), ("a.b.or", "g/xy", "block"), ("b.org", "/xy/", "block"), ("org", "", "allow"), ("", "/xy/z", "allow"), ("a.b.org", "/xy/z/more", "allow")], "host string, path string, verdict string")
    got = url_filter.judge(df, rules)
    assert got.columns == ["page_id", "url", "b", "block", "w0", "listed_url", "host", "path", "rule", "verdict"]
    assert rows(got, "page_id", "b", "host", "path", "rule", "verdict") == [(1, "w", "a.b.org", "/xy/z", "b.org/xy/", "block"), (2, "w", "", "", None, "allow")]
    deep = spark.createDataFrame([(3, "http://" + "a." * 50_000 + "org/de/")], "page_id long, url string")
    assert url_filter.judge(deep, spark.createDataFrame(url_filter.OP5_RULES, "host string, path string, verdict string")).first()["rule"] == "org/"


def test_url_filter_with_many_shapes_of_rules(spark):
    """20,000 rules of 1,000 shapes: the plan is that of a short list, and urls that no listed host fits are in no exchange."""
    n = F.col("id")
    rules = spark.range(20_000).select(F.concat(F.repeat(F.lit("s."), (n % 20).cast("int")), F.lit("h"), (n % 7000).cast("string"), F.lit(".com")).alias("host"), F.concat(F.lit("/"), F.repeat(F.lit("p"), (n % 50).cast("int"))).alias("path"), F.when(n % 3 == 0, "allow").otherwise("block").alias("verdict"))
    listed = [(r["host"], r["path"], r["verdict"]) for r in rules.collect()]
    by = {}
    for host, path, verdict in listed:
        by.setdefault((host, path), set()).add(verdict)
    urls = [f"http://x.{h}{p}pp?q" for h, p, _ in listed[::997]] + [f"https://{h}/other" for h, _, _ in listed[::1999]] + ["http://none.org/p"] * 50
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()}
    for k, u in enumerate(urls):
        host, _, path = u.partition("://")[2].partition("?")[0].partition("/")
        fits = [(len(h + p), len(h), h + p, min(v)) for end in ([host.split(".", i)[-1] for i in range(host.count(".") + 1)]) for h, p, v in ((end, "/" + path[:c], by.get((end, "/" + path[:c]))) for c in range(len(path) + 1)) if v]
        assert got[k] == (max(fits)[2:] if fits else (None, "allow")), u


def test_bloom_has_no_false_negatives(spark):
    keys = spark.range(3000).select(F.concat(F.lit("h"), "id", F.lit(".org/")).alias("key"))
    bloom = url_filter.blocked_bloom(keys, 188)
    other = spark.range(3000, 13000).select(F.concat(F.lit("h"), "id", F.lit(".org/")).alias("key"))
    assert url_filter.maybe_listed(keys, bloom, 188).count() == 3000
    assert url_filter.maybe_listed(other, bloom, 188).count() < 300


# ---- 6


def test_embedding_graph(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(900, 16))
    near = base[:40].repeat(4, 0) + rng.normal(scale=0.05, size=(160, 16))
    clique = base[50] + rng.normal(scale=0.04, size=(120, 16))
    x = np.concatenate([base, near, clique, base[:5]]).astype(np.float32)
    data = [(int(k), v.tolist()) for k, v in enumerate(x)] + [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5003, [1.0] + [float("inf")] * 15), (5004, [1.0, None] + [0.5] * 14), (5005, []), (5006, [1.0, 2.0]), (5007, [2.0, 4.0]), (None, x[3].tolist()), (7, x[7].tolist())]
    df = spark.createDataFrame([(i, v, 0, "c", "l") for i, v in data], "vec_id long, embedding array<float>, label int, component string, links string").repartition(4)
    got, recall = eg.near_duplicates(df)
    good = [k for k, (_, v) in enumerate(data) if v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    links, root = collections.Counter(), list(range(len(data)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    pairs = set()
    for d in (2, 16):
        at = [k for k in good if len(data[k][1]) == d]
        v = np.array([data[k][1] for k in at], np.float64)
        s = v @ v.T / np.sqrt((v * v).sum(1))[:, None] / np.sqrt((v * v).sum(1))
        pairs |= {(at[a], at[b]) for a, b in zip(*np.nonzero(s >= 0.95)) if a != b}
    for a, b in pairs:
        links[a] += 1
        root[find(a)] = find(b)
    low = collections.defaultdict(list)
    for k, (i, _) in enumerate(data):
        low[find(k)].append(i)
    want = sorted(((i, links[k], min((x for x in low[find(k)] if x is not None), default=None)) for k, (i, _) in enumerate(data)), key=str)
    found = rows(got, "vec_id", "n_links", "component_id")
    true, have = sum(w[1] for w in want), sum(f[1] for f in found)
    assert recall >= 0.97 and have <= true and have >= 0.97 * true
    assert sum(a != b for a, b in zip(found, want)) <= 0.05 * len(want)
    none, recall = eg.near_duplicates(df.limit(0))
    assert none.count() == 0 and recall == 1


def test_large_shards_are_dealt_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(eg, "BLOCK", 40)
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(150, 8)), np.ones((30, 8)) + rng.normal(scale=0.01, size=(30, 8))]).astype(np.float32)
    got, recall = eg.near_duplicates(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>"))
    v = x.astype(np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    want = ((v @ v.T) >= 0.95).sum(1) - 1
    found = {r["vec_id"]: r["n_links"] for r in got.collect()}
    assert recall >= 0.97 and abs(sum(found.values()) - want.sum()) <= 0.02 * want.sum()


def test_a_large_group_of_distinct_near_copies_keeps_its_links(spark, monkeypatch):
    monkeypatch.setattr(eg, "TARGET", 15)  # 200 centres, about 67 of them in the group
    monkeypatch.setattr(eg, "BLOCK", 400)
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 32))
    x[::3] = x[0] / np.linalg.norm(x[0]) + rng.normal(scale=0.12 / 32**0.5, size=(1000, 32))
    x = x.astype(np.float32)
    v = x.astype(np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    want = ((v @ v.T) >= 0.95).sum(1) - 1
    assert (want[::3] >= 998).all()
    got, recall = eg.near_duplicates(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>"))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got.collect()}
    assert recall >= 0.97 and sum(n for n, _ in got.values()) >= 0.97 * want.sum()
    assert all(got[k][0] <= n for k, n in enumerate(want)) and all(got[k][1] == 0 for k in range(0, 3000, 3))


def test_the_audit_goes_on_until_queries_have_links_and_weighs_them_alike(spark, monkeypatch):
    monkeypatch.setattr(eg, "AUDIT", 20)
    monkeypatch.setattr(eg, "AUDIT_ROUNDS", 30)
    monkeypatch.setattr(eg, "LINKED", 2)
    x = np.random.default_rng(3).normal(size=(400, 16))
    x[200:204] = x[0] + 0.001
    df = spark.createDataFrame([(k, 1, 16, v.tolist()) for k, v in enumerate(x)], "id long, n long, dim int, embedding array<float>")
    truth = eg._audit(df, 0.95)
    assert sum(n > 0 for n in truth.values()) >= 2 and len(truth) % 20 == 0
    assert eg._recall({1: 1000, 2: 1, 3: 0}, {1: 1000}) == 0.5 and eg._recall({1: 10, 2: 10}, {1: 10, 2: 5}) == 0.75 and eg._recall({1: 0}, {}) == 1


def pairs_of(x):
    v = np.asarray(x, np.float64)
    v = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = v @ v.T
    np.fill_diagonal(s, 0)
    return s >= 0.95


def test_walks_cross_shards(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 16))
    c = eg._unit(rng.normal(size=(6, 16)))
    x[0] = c[0] + 0.95 * c[1] + 0.9 * c[2]
    x[1] = x[0] + 0.06 * (c[3] - c[0])
    x[150:] = x[:150] + rng.normal(scale=0.2, size=(150, 16))
    df = spark.createDataFrame([(k, 1, 16, v.tolist()) for k, v in enumerate(x)], "id long, n long, dim int, embedding array<double>")
    held = spark.sparkContext.broadcast({16: c})
    v = eg._unit(x)
    near, best = np.argsort(-(v @ c.T), axis=1)[:, :2], (v @ c.T).argmax(1)
    linked = pairs_of(x)
    apart = [(a, b) for a, b in zip(*np.nonzero(linked)) if best[a] not in near[b]]
    assert apart
    found = collections.Counter()
    for r in eg._search_shards(df, held, 0.95, 0.3, 2, 64).collect():
        found[r["id"]] += r["links"]
    shared = {(a, b) for a, b in zip(*np.nonzero(linked)) if set(near[a]) & set(near[b])}
    assert all(sum(1 for p in shared if p[0] == k) <= found[k] <= linked[k].sum() for k in range(300))


@pytest.mark.parametrize("group", [0, 400])
def test_centres_of_centres(spark, monkeypatch, group):
    """More vectors than the first centres' cells may hold: cells have centres of their own, and links cross them."""
    for name, n in (("MAX_CENTRES", 6), ("TARGET", 20), ("CELL", 60), ("SAMPLE", 300), ("BLOCK", 64)):
        monkeypatch.setattr(eg, name, n)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1200, 24))
    x[600:900] = x[:300] + rng.normal(scale=0.15, size=(300, 24))
    x[:group] = x[0] + rng.normal(scale=0.1, size=(group, 24))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got, recall = eg.near_duplicates(df)
    got = {r["vec_id"]: r["n_links"] for r in got.collect()}
    want = pairs_of(x).sum(1)
    assert recall >= 0.97 and all(got[k] <= n for k, n in enumerate(want)) and sum(got.values()) >= 0.97 * want.sum()


def test_doubles_of_any_size(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=16)
    close = v / np.linalg.norm(v)
    side = rng.normal(size=16)
    side -= close * (side @ close)
    side /= np.linalg.norm(side)
    at = lambda cos: (cos * close + (1 - cos * cos) ** 0.5 * side).tolist()
    data = [(1, at(1.0)), (2, at(0.95 + 1e-12)), (3, (np.array(at(1.0)) * 1e300).tolist()), (4, (np.array(at(1.0)) * 1e-300).tolist()), (5, (-np.array(at(1.0)) * 1e200).tolist()), (6, at(0.95 - 1e-9))]
    got, _ = eg.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got.collect()}
    assert got == {1: (3, 1), 2: (4, 1), 3: (3, 1), 4: (3, 1), 5: (0, 5), 6: (1, 1)}


# ---- 7


def test_trigram_queries():
    q = secrets.trigram_query
    assert q("abcd") == frozenset([frozenset(["abc", "bcd"])])
    assert q("(foo|bars?)x*") == frozenset([frozenset(["foo"]), frozenset(["bar"])])
    assert q("[0-9a-f]{16,}") == frozenset([frozenset()])
    assert q("(?i)API_?KEY=.*") == frozenset([frozenset(["api", "pik", "ike", "key", "ey="]), frozenset(["api", "pi_", "i_k", "_ke", "key", "ey="])])
    assert q("ab[xyz]c") == frozenset(frozenset([f"ab{c}", f"b{c}c"]) for c in "xyz")
    assert q("a(bc)+d") == frozenset([frozenset(["abc"])])
    for r in secrets.RULES:
        assert (r.kind == "hex") == (r.query == frozenset([frozenset()]))


def slow_spans(text):
    text = text or ""
    out = []
    base = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 12),
            ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16)]
    base += [(r.kind, re.compile(r.pattern), lambda m: True) for r in secrets.ADDED]
    for rank, (kind, pattern, ok) in enumerate(base):
        out += [(m.start(), rank, kind, m.end()) for m in pattern.finditer(text) if ok(m)]
    return sorted(out)


def secret_texts():
    rng = random.Random(8)
    bits = ["password", "Passwd", "SECRET", "token", "api_key", "APIKEY", "=", ":", " = ", '"', "'", "abc", "0123456789abcdef", "deadbeef" * 3, "AKIA", "AKIA" + "Z" * 14, "AKIA" + "Q1" * 10, "A" * 12, "é", "😀", "\n", " ", "==", "x.y/z+w-_", "ghp_" + "a1" * 18, "-----BEGIN RSA PRIVATE KEY-----",
            "xoxb-1234567890-a", "eyJ" + "a" * 12 + "." + "b" * 12 + ".c", "0" * 15]
    out = ["".join(rng.choice(bits) for _ in range(rng.randrange(14))) for _ in range(1500)]
    return out + [None, "", "secret=token: ABCDEFGHIJKLMNO", "clean text of words", "password=" + "x" * 20_000, "f" * 15 + "g" + "f" * 16, ("ab " * 20_000) + "token=abcdefghijklmnop"]


def test_secret_scan(spark):
    texts = secret_texts()
    df = spark.createDataFrame([(k if k % 50 else None, t, "c", "r", "k") for k, t in enumerate(texts)] + [(1, texts[1], "c", "r", "k")], "doc_id long, text string, c0 string, row string, kind string")
    got = collections.defaultdict(list)
    for r in secrets.scan(df).collect():
        got[r["doc_id"], r["text"]].append([tuple(s) for s in r["secret_spans"]])
    for k, t in enumerate(texts):
        assert slow_spans(t) in got[k if k % 50 else None, t], t
    assert sum(map(len, got.values())) == len(texts) + 1
    assert secrets.scan(df.limit(0)).count() == 0
    clean = secrets.redact(df)
    assert clean.columns == df.columns
    for r in clean.where("doc_id is not null").collect():
        t, at, parts = texts[r["doc_id"]], 0, []
        for start, _, _, end in slow_spans(t):
            if start >= at:
                parts += [t[at:start], "[SECRET]"]
            at = max(at, end)
        assert r["text"] == (None if t is None else "".join(parts) + t[at:])


def test_many_secrets_in_one_text_take_seconds(spark):
    n = 100_000
    word = "0123456789abcdef"
    text = "é " + " ".join([word + "01"] * n) + " token=abcdefghijkl"
    df = spark.createDataFrame([(1, text, 5, 6), (2, None, 5, 6)], "doc_id long, text string, __row int, secret_spans int").repartition(1)
    began = time.perf_counter()
    r = secrets.scan(df).where("doc_id = 1").select("secret_spans").first()["secret_spans"]
    assert len(r) == n + 1 and (r[n - 1]["start"], r[n - 1]["end"]) == (2 + 19 * (n - 1), 2 + 19 * (n - 1) + 18)
    scanned = time.perf_counter() - began
    clean = secrets.redact(df)
    assert clean.columns == df.columns
    got = {x["doc_id"]: x for x in clean.collect()}
    assert got[1]["text"] == "é " + " ".join(["[SECRET]"] * n) + " [SECRET]" and got[1]["__row"] == 5 and got[1]["secret_spans"] == 6 and got[2]["text"] is None
    assert scanned < 30 and time.perf_counter() - began < 90


# ---- pipeline


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(2)
    words = {"en": "the of and to in is that for it as was with".split(), "de": "der die und in den von zu das mit sich des auf".split()}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) + rng.choice("abcdefgh") for _ in range(n))
    data = [(k, text(lang, 80), lang, "s") for k, lang in enumerate(["en", "de"] * 25)]
    item = " ".join(f"item{k}" for k in range(20))
    data += [(100, data[0][1], "en", "s"), (101, "  123 ", "en", "s"), (102, None, "en", "s"), (103, text("en", 10) + " " + item, "en", "s"), (104, text("en", 50) + " password=hunter2hunter2 end", "en", "s"), (None, text("en", 60), None, None), (105, data[1][1], "de", "s"), (105, data[1][1], "de", "s")]
    spark.createDataFrame([(*d, len(d[1] or "")) for d in data], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out-{k}")
        docs = spark.read.parquet(f"{tmp_path}/out-{k}")
        if k < 4:
            assert docs.columns == columns
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    everyone = {d[0] for d in data}
    assert everyone - kept[0] == {101, 102}
    assert kept[0] - kept[1] == {100, 105}
    assert kept[1] - kept[2] == {103}
    assert kept[2] == kept[3] == kept[4]
    red = spark.read.parquet(f"{tmp_path}/out-3").where("doc_id = 104").first()
    assert "[SECRET] end" in red["text"] and "hunter2" not in red["text"] and red["n_chars"] == len(red["text"])
    assert rows(corpus_pipeline.run(spark, str(tmp_path)), "doc_id", "ids_crc32") == rows(docs, "doc_id", "ids_crc32")


def test_no_scratch_folder_of_one_machine_on_a_cluster():
    from types import SimpleNamespace as N

    from lexspark.llm.common import scratch_path

    conf = N(get=lambda key, default=None: None)
    sc = N(master="spark://host:7077", _jsc=N(sc=lambda: N(getCheckpointDir=lambda: N(isDefined=lambda: False))))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(N(conf=conf, sparkContext=sc), "x")


def test_scratch_tables_can_be_removed(spark, tmp_path):
    from types import SimpleNamespace as N

    from lexspark.llm.common import remove_scratch, scratch_path

    other = N(conf=N(get=lambda key, default=None: str(tmp_path)), sparkContext=spark.sparkContext)
    at = scratch_path(other, "some")
    spark.range(3).write.parquet(at)
    assert at.startswith(str(tmp_path)) and spark.read.parquet(at).count() == 3
    remove_scratch(other)
    assert os.path.isdir(tmp_path) and not os.path.exists(os.path.dirname(at))
