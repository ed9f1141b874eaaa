"""The text operators against brute force, on small fixtures full of edge cases."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from stagewise.llm import decontam, graph, hashed, lm, pieces, pii, quality, resample, simhash, suffix, toxicity, urls

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, n int, bucket int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, None, 0, "x", 1, 2) for i, t in rows], DOCS)


def words(rng, n):
    return " ".join("".join(rng.choice(["the", "an", "er", "on", "sh"]) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [words(rng, rng.randint(5, 120)) for _ in range(60)]
    near = [b[:-4] + "x" for b in base[:15]]
    passage = words(rng, 70)
    shared = [words(rng, 20) + " " + passage + " " + words(rng, 20) for _ in range(8)]
    odd = [None, "", " \n\t", "a", "A b\x0bC", "de " * 400, base[0], base[0], "é ▁ 漢\U0001f600  x", "\x00a\x1fb", passage * 3]
    rows = list(enumerate([*base, *near, *shared, *odd]))
    return [*rows, rows[3], (None, base[7]), (-5, base[8])]


def brute_fingerprint(text, k=4):
    ws = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not ws:
        return 0
    sh = [b" ".join(ws[i:i + k]) for i in range(max(1, len(ws) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows, link):
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if link(i, j):
                parent[find(i)] = find(j)
    groups = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            groups[find(i)] = min(d, groups.get(find(i), d))
    return [groups.get(find(i)) for i in range(len(rows))]


def test_simhash(spark, texts):
    fps = [brute_fingerprint(t) for _, t in texts]
    roots = brute_components(texts, lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 4)
    want = Counter((d, f"{f:016x}", r) for (d, _), f, r in zip(texts, fps, roots))
    got = simhash.near_duplicates(frame(spark, texts)).collect()
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_simhash_links_lose_nothing():
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 1 << 64, 300, np.uint64, endpoint=False)
    for d in range(1, 5):
        flips = np.array([sum(1 << int(b) for b in rng.choice(64, d, replace=False)) for _ in fp], np.uint64)
        a, b = simhash.keys(fp, 4), simhash.keys(fp ^ flips, 4)
        assert np.any([x == y for x, y in zip(a, b)], axis=0).all()
        assert simhash.within(flips, 4).all()
    fives = np.array([0b11111, 1 << 63 | 0b1111], np.uint64)
    assert not simhash.within(fives, 4).any()


def test_simhash_crowded_keys_lose_nothing(spark, monkeypatch):
    """Keys with many members are keyed again by their open bits, once or twice, and the links connect the same."""
    rng = np.random.default_rng(3)
    fp = rng.integers(0, 1 << 64, 200, np.uint64, endpoint=False)
    masks = simhash.open_bits(4)
    assert len(masks) == len(simhash.keys(fp, 4)) and all(24 <= 64 - m.bit_count() <= 27 for m in masks.values())  # a segment of 12 or 13 bits, two parts of 6 or 7
    for tag, mask in masks.items():
        places = [b for b in range(64) if mask >> b & 1]
        flips = np.array([sum(1 << int(b) for b in rng.choice(places, rng.integers(1, 5), replace=False)) for _ in fp], np.uint64)
        key, open_ = np.full(len(fp), tag << 55, np.uint64), np.full(len(fp), mask, np.uint64)
        a, b = simhash.keyed_again(key, fp, open_, 4), simhash.keyed_again(key, fp ^ flips, open_, 4)
        assert len(a) == 5 and np.any([x[1] == y[1] for x, y in zip(a, b)], axis=0).all()
        assert all((x[2] & ~np.uint64(mask) == 0).all() and (np.bitwise_count(x[2]) < mask.bit_count()).all() for x in a)
    some = [int(rng.integers(0, 1 << 62)) << 2 for _ in range(3)]
    near = [c ^ sum(1 << int(b) for b in rng.choice(64, int(k), replace=False)) for c in some for k in rng.integers(0, 5, 60)]
    shared = [some[0] ^ int(x) << 40 for x in rng.integers(0, 1 << 24, 60)]  # one key, far from each other
    fps = np.unique(np.array(near + shared, np.uint64))
    want = brute_components([(i,) for i in range(len(fps))], lambda i, j: (int(fps[i]) ^ int(fps[j])).bit_count() <= 4)
    nodes = spark.createDataFrame([(int(f), i) for i, f in enumerate(fps.view(np.int64))], "fp long, rep long")
    for crowd in (simhash.CROWD, 10):
        monkeypatch.setattr(simhash, "CROWD", crowd)
        pairs = {frozenset(p) for p in simhash.links(nodes, 4).collect()}
        assert all((int(fps[i]) ^ int(fps[j])).bit_count() <= 4 for i, j in pairs)
        assert brute_components([(i,) for i in range(len(fps))], lambda i, j: frozenset((i, j)) in pairs) == want


def test_group_forest_connects():
    rng = np.random.default_rng(2)
    fp = np.unique(np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in range(200)], np.uint64))
    x, y = simhash._group_links(np.zeros(len(fp), np.int64), fp, np.arange(len(fp)), 4)
    want = brute_components([(i,) for i in range(len(fp))], lambda i, j: bin(int(fp[i] ^ fp[j])).count("1") <= 4)
    pairs = {frozenset(p) for p in zip(x.tolist(), y.tolist())}
    assert brute_components([(i,) for i in range(len(fp))], lambda i, j: frozenset((i, j)) in pairs) == want
    assert len(pairs) < len(fp)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)] + [(100, i) for i in range(101, 160)] + [(i, i + 1) for i in range(200, 240)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({x for e in edges for x in e if e[0] != e[1]})
    linked = {frozenset(e) for e in edges}
    want = brute_components([(n,) for n in nodes], lambda i, j: frozenset((nodes[i], nodes[j])) in linked)
    assert got == dict(zip(nodes, want))
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_urls(spark):
    page = lambda to: f'<html><LINK rel="canonical" href="{to}"></html>'
    rows = [(1, "http://A.example.org/es/1?x#y", None), (2, "https://b.org/q", ""), (3, "http://x.com/de/2", page("http://p.net/a")), (4, "http://p.net/a#top", page("//q.net/b?k=1")),
            (5, "https://q.net/b?k=1", "x"), (6, "http://r.net/z", '<meta http-equiv="refresh" content="0; url=/w">'), (7, "http://r.net/w", page("http://b.org/q")), (8, "http://r.net/z", None),
            (9, None, page("http://x.com/de/2")), (10, "nothing", None), (11, "http://notorg/", None), (12, "http://example.org", None), (12, "http://example.org/en/12", None), (None, "http://s.net/", page("http://x.com/de/9"))]
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    want = [(1, "a.example.org", "/es/1", "example.org/es/", "block"), (2, "b.org", "/q", "org/", "allow"), (3, "x.com", "/de/2", "com/de/", "block"), (4, "p.net", "/a", None, "block"),
            (5, "q.net", "/b", None, "block"), (6, "r.net", "/z", None, "allow"), (7, "r.net", "/w", None, "allow"), (8, "r.net", "/z", None, "allow"), (9, "", "", None, "allow"), (10, "", "", None, "allow"),
            (11, "notorg", "/", None, "allow"), (12, "example.org", "", None, "allow"), (12, "example.org", "/en/12", "example.org/en/1", "block"), (None, "s.net", "/", None, "block")]
    assert Counter(got) == Counter(want)


def test_url_targets(spark):
    page = "http://h.net/a/b/c.html?k=1#f"
    want = {"index2.html": "http://h.net/a/b/index2.html", "?page=2": "http://h.net/a/b/c.html?page=2", "../b": "http://h.net/a/b", "./x/../y?q=/../z": "http://h.net/a/b/y?q=/../z",
            "../../../up/": "http://h.net/up/", "..": "http://h.net/a/", "#top": "http://h.net/a/b/c.html?k=1#top", "/r/./s": "http://h.net/r/s", "//o.net/p": "http://o.net/p",
            "https://o.net/p": "https://o.net/p", "/go?to=http://o.net": "http://h.net/go?to=http://o.net", "mailto:x@y.net": None}
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([(page, k) for k in want], "url string, link string")
    assert {r["link"]: r["to"] for r in rows.select("link", urls.resolve(F.col("url"), F.col("link")).alias("to")).collect()} == want
    both = '<link rel="canonical" href="../c"><meta http-equiv="refresh" content="0; url=d">'
    rows = [(1, "http://x.com/de/2", both), (2, "http://x.com/c", None), (3, "http://x.com/e", "<link rel=canonical href=/de/d>"), (4, "http://h.net", '<link rel="canonical" href="i">'), (5, "http://h.net/i", None), (6, "http://x.com/de/d", None)]
    out = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [out[i]["verdict"] for i in (1, 2, 3, 4, 5)] == ["block", "block", "block", "allow", "allow"]
    assert len({out[i]["alias_group"] for i in (1, 2, 3, 6)}) == 1 and out[4]["alias_group"] == out[5]["alias_group"]


def brute_removed(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        hit = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                hit[i:i + length] = True
        kept = np.frombuffer(t, np.uint8)[~hit].tobytes()
        out.append((len(t), int(hit.sum()), len(suffix.runs(hit)[0]), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("large", [4000, 1])
def test_suffix(spark, texts, large, monkeypatch):
    monkeypatch.setattr(suffix, "LARGE", large)
    want = Counter((d, *r) for (d, _), r in zip(texts, brute_removed([(t or "").encode() for _, t in texts], 200)))
    got = suffix.remove_repeats(frame(spark, texts)).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want
    assert sum(r["n_removed"] > 0 for r in got) > 20


def test_suffix_identities_have_128_bits():
    """Two segments whose first hash clashes stay two: each hash alone tells contents apart."""
    rng = np.random.default_rng(4)
    a, b = (rng.integers(0, 256, 400).astype(np.uint8) for _ in range(2))
    data = np.concatenate([a, b, a])
    _, content, lo, hi, _ = suffix.segments(data, np.array([400, 800, 1200]))
    assert content.shape == (2, len(lo))
    kinds = {}
    for k, x, y in zip(zip(*content.tolist()), lo, hi):
        kinds.setdefault(data[x:y + 200].tobytes(), set()).add(k)
    assert all(len(v) == 1 for v in kinds.values()) and (lo < 400).sum() == (lo >= 800).sum()
    for h in content:
        assert len(set(h.tolist())) == len(kinds)
    assert not set(content[0].tolist()) & set(content[1].tolist())


def test_suffix_long_texts_in_pieces(monkeypatch):
    rng = random.Random(9)
    text = bytes(rng.choice(b"ab") for _ in range(900))
    whole = {(int(b), int(i)) for b, _, lo, hi, _ in [suffix.segments(np.frombuffer(text, np.uint8), np.array([900]))] for b, x, y in zip(b, lo, hi) for i in range(x, y + 1)}
    monkeypatch.setattr(suffix, "PIECE", 300)
    cut = set()
    for _, at, (t,) in suffix.pieces([text]):
        b, _, lo, hi, _ = suffix.segments(np.frombuffer(t, np.uint8), np.array([len(t)]))
        cut |= {(int(k), at + i) for k, x, y in zip(b, lo, hi) for i in range(x, y + 1)}
    assert cut == whole and len({i for _, i in whole}) == 701


def test_cover():
    for d in range(suffix.MODULUS):
        assert any((c + d) % suffix.MODULUS in suffix.COVER for c in suffix.COVER)


def test_pii(spark):
    text = 'Mail Ann.Lee@Mail5.example.com or ann.lee@mail5.example.com, +1 (743) 555-3824, 70.23.22.57, 4539578763621486, token = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2" Mr. John Smith'
    rows = [(1, text), (2, "call +1 (743) 555-3824 now"), (3, None), (4, ""), (5, "nothing to see, 12 of 34."), (5, "nothing to see, 12 of 34."), (None, "10.0.0.1")]
    out = {r["doc_id"]: r for r in pii.report(frame(spark, rows)).collect()}
    new = out[1]["text"]
    assert out[1]["n_entities"] == 7
    for _, old in [(0, m[0]) for m in re.finditer(r"555-3824|70\.23\.22\.57|4539578763621486|f33e61083db5\w+|ann\.lee|John|Smith", text, re.I)]:
        assert old not in new
    card = re.search(r"\b\d{16}\b", new)[0]
    assert pii.luhn(card[:-1]) == int(card[-1])
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", new)[0] in out[2]["text"]
    a, b = re.findall(r"[\w.]+@[\w.]+\.com", new)
    assert a.lower() == b and a != b
    assert out[5]["text"] == rows[4][1] and out[3]["text"] is None and out[4]["text"] == ""
    assert pii.anonymise(frame(spark, rows)).columns == frame(spark, rows).columns
    found = spark.createDataFrame([("ip", "a", "x"), ("ip", "b", "x"), ("ip", "c", "y")], "kind string, entity string, surrogate string")
    assert [(r["kind"], r["value"]) for r in pii.collisions(found).collect()] == [("ip", "x")]


def test_pii_clashes(spark):
    rows = [(1, "at 1.2.3.4 or 1.02.3.4"), (2, "at 1.2.3.40")]
    a, b = (r["surrogates"] for r in sorted(pii.report(frame(spark, rows)).collect(), key=lambda r: r["doc_id"]))
    assert a[0] == a[1] != b[0]
    alphabet = "0123456789abcdefghijklmnopqrstuvwxyzA"
    every = [x + y for x in alphabet for y in alphabet]
    assert len({pii.surrogate("secret", x) for x in every}) == len(every)
    found = spark.createDataFrame([("ip", "a", "x"), ("ip", "b", "x"), ("ip", "b", "x"), ("ip", "c", "y"), ("ssn", "d", "x")], "kind string, entity string, surrogate string")
    assert [r["entity"] for r in pii.clashing(found).collect()] == ["b"]
    plain = pii.Surrogates(pii.KEY)["ssn", "123-45-6789"]
    turned = pii.Surrogates(pii.KEY, turns={pii.marked("ssn", "123456789", pii.KEY): 1})
    assert turned["ssn", "123-45-6789"] != plain and turned["ssn", "123-45-6780"] == pii.Surrogates(pii.KEY)["ssn", "123-45-6780"]


def test_pii_secrets():
    body = "MIIEpAIBAAKCAQEAx7Vd\nqT+k/abcDEFghiJKLmnoPQRs\n"
    for head, text in (("-----BEGIN RSA PRIVATE KEY-----", "see -----BEGIN RSA PRIVATE KEY-----\n%s-----END RSA PRIVATE KEY----- end" % body), ("-----BEGIN PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----\n%sand so on, stays" % body)):
        new, found = pii.replace(text, pii.Surrogates(pii.KEY))
        assert len(found) == 1 and head in new and not any(x in new for x in body.split()) and len(new) == len(text)
        assert new.endswith("-----END RSA PRIVATE KEY----- end") or new.endswith("and so on, stays")
    for text, n in (("password = swordfish", 1), ("Pwd: \"hunterhunter\"", 1), ("token = something", 0), ("api_key = abcd1234", 1), ("PRIVATE KEY of the house", 0)):
        new, found = pii.replace(text, pii.Surrogates(pii.KEY))
        assert len(found) == n and (new != text) == bool(n), text


def test_pii_permutes():
    for radices in ([10, 10], [6, 20, 10], [26]):
        import itertools
        every = [tuple(pii.permute(list(v), radices, b"k", "t")) for v in itertools.product(*map(range, radices))]
        assert len(set(every)) == len(every)
    names = [pii.surrogate("person", n) for n in pii.NAMES["f", "latin"]]
    assert sorted(names) == sorted(pii.NAMES["f", "latin"]) and all(a != b for a, b in zip(names, pii.NAMES["f", "latin"]))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton():
    terms = ["clown", "worthless", "disgusting", "idiot", "bad"]
    m = toxicity.Automaton(terms)
    rng = random.Random(4)
    for _ in range(400):
        w = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(w) + 1)
            w[i:i + rng.randint(0, 1)] = rng.choice(["", "a", "t"])
        w = "".join(w)
        best = min(((distance(w, t), t) for t in terms if distance(w, t) <= toxicity.edits(t)), default=None)
        assert m.match(w) == (best and (best[1], best[0]))
    assert toxicity.Automaton([]).match("x") is None


def test_toxicity(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        ws = words(rng, 30).split()
        if i % 4 == 0:
            ws.insert(rng.randrange(len(ws)), "worthless" if i % 8 else "worthles")
        rows.append((i, " ".join(ws)))
        labels.append((i, 1, int(i % 4 == 0)))
    rows += [(1000, None), (1001, ""), (None, "worthless"), (1002, "he said \"worthless\" , a quote")]
    lab = spark.createDataFrame([*labels, (None, None, 1), (5, 1, None), (6, 0, 1)], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in toxicity.score(frame(spark, rows), lab).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(out[i]["held_out"] for i in held) and sum(r["held_out"] for r in out.values()) >= len(held)
    assert sum(out[i]["predicted"] == (i % 4 == 0) for i in held) / len(held) > 0.95
    assert out[1000]["score"] == out[1001]["score"] < 0.3 and out[None]["predicted"] == 1
    assert out[1002]["score"] < out[None]["score"]
    assert toxicity.score(frame(spark, []), lab).count() == 0
    assert toxicity.keep_clean(frame(spark, rows), lab.limit(0)).count() == len(rows)


def test_toxicity_base_rate_outlasts_the_cap(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, words(rng, 20)) for i in range(700)]
    lab = spark.createDataFrame([(i, 1, int(i % 12 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    a = toxicity.score(frame(spark, rows), lab).collect()
    monkeypatch.setattr(toxicity, "SAMPLE", 30)
    b = toxicity.score(frame(spark, rows), lab).collect()
    mean = lambda out: sum(r["score"] for r in out) / len(out)
    assert mean(b) == pytest.approx(mean(a), abs=0.03) and not any(r["predicted"] for r in [*a, *b])


def test_quality(spark, texts):
    rows = [*texts, (900, "x y\nx y\n \n \nx y # <a>"), (901, " ".join(map(str, range(30))) + " " + " ".join(map(str, range(30))))]
    got = quality.judge(frame(spark, rows), spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")).collect()
    want = Counter()
    for d, t in rows:
        t = t or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        win = [tuple(ws[i:i + 8]) for i in range(len(ws) - 7)]
        seen, hit = Counter(win), set()
        for i, w in enumerate(win):
            if seen[w] > 1:
                hit |= set(range(i, i + 8))
        want[(d, len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit), len(ws) < 20 or 100 * len(hit) > 30 * len(ws))] += 1
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got) == want
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert quality.judge(frame(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_resample(spark, texts):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    out = resample.resample(frame(spark, texts), labels, share=0.5).collect()
    picked = [r for r in out if r["sampled"]]
    assert len(picked) >= len(texts) // 2 and min(r["gumbel_key"] for r in picked) > max(r["gumbel_key"] for r in out if not r["sampled"] and r["gumbel_key"] is not None)
    v = spark.createDataFrame([(float(x % 997),) for x in range(30_000)], "v double")
    every = sorted((float(x % 997) for x in range(30_000)), reverse=True)
    for k in (1, 17, 15_000, 29_999, 30_000):
        assert resample.kth_largest(v, "v", k) == every[k - 1]
    assert resample.resample(frame(spark, []), labels.limit(0)).count() == 0


def test_grams_agree(spark, texts):
    d = frame(spark, texts).selectExpr("text", "true as target")
    a = Counter(r["gram"] for r in hashed.counted_grams(d, d["text"]).collect())
    h = d.select(hashed.hashes(hashed.words(d["text"])).alias("h1"))
    from pyspark.sql import functions as F
    h = h.select("h1", F.size("h1").alias("n")).select("h1", hashed.pairs(F.col("h1"), 1, F.col("n")).alias("h2")).collect()
    assert a == Counter(x for r in h for x in [*r["h1"], *r["h2"]])


def test_decontamination(spark, texts):
    items = [("b", texts[2][1]), ("a", "x " + " ".join(texts[4][1].split()[:12])), ("c", "é"), ("d", ""), (None, "a"), ("e", None), ("f", "never here at all"), ("g", texts[2][1])]
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    want = Counter()
    for d, t in texts:
        ws, hit, by = split(t), set(), set()
        for item, s in items:
            iw = split(s)
            n = min(10, len(iw))
            for i in range(len(iw) - n + 1 if n else 0):
                for j in range(len(ws) - n + 1):
                    if ws[j:j + n] == iw[i:i + n]:
                        hit |= set(range(j, j + n))
                        by.add(item)
        want[(d, len(ws), len(hit), tuple(sorted(by, key=str)))] += 1
    bench = spark.createDataFrame(items, "item_id string, text string")
    find = lambda: Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(sorted({m["item_id"] for m in r["matches"]}, key=str))) for r in decontam.find_matches(frame(spark, texts), bench).collect())
    assert find() == want
    old, decontam.BLOCK_WORDS = decontam.BLOCK_WORDS, 30
    try:
        assert find() == want
    finally:
        decontam.BLOCK_WORDS = old
    assert Counter(r["doc_id"] for r in decontam.decontaminate(frame(spark, texts), bench).collect()) == Counter(k[0] for k in want.elements() if not k[2])
    assert decontam.find_matches(frame(spark, texts), bench.limit(0)).where("contaminated").count() == 0


def test_pieces(spark, texts):
    out = pieces.encode(frame(spark, texts))
    assert all(r["round_trip"] for r in out.collect())
    back = Counter((r["doc_id"], r["text"]) for r in pieces.decode(out).collect())
    assert back == Counter((d, t or "") for d, t in texts)


def test_viterbi_is_best():
    p = pieces.Pieces(pieces.MODEL)

    def best(w):
        top = [0.0] + [-1e18] * len(w)
        for i in range(1, len(w) + 1):
            for j in range(i):
                if w[j:i] in p.score and not (j and w[j] == pieces.MARK):
                    top[i] = max(top[i], top[j] + p.score[w[j:i]][0])
            if i > 1:
                top[i] = max(top[i], top[i - 1] + p.byte_score * len(w[i - 1].encode()))
        return top[-1]
    ws = [pieces.MARK + w for w in "there thering thorn the é▁x 漢字 a aa aaa international".split()]
    for w, ids in p.encode_words(ws).items():
        scores = sum(p.byte_score if p.byte[i] >= 0 else p.score[p.text[i]][0] for i in ids)
        assert scores == pytest.approx(best(w))


def test_lm(spark, texts):
    rows = [*texts, *[(2000 + i, "only here zzz%d" % i) for i in range(20)]]
    out = lm.score(frame(spark, rows), steps=20).collect()
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    split = lambda t: [w.decode() for w in (t or "").encode().lower().split()] + [None]
    c = Counter(w for d, t in rows if not held(d) for w in split(t))
    n, v = sum(c.values()), len(c)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    want = sorted(((d, held(d), len(split(t)), sum(c[w] > 0 for w in split(t)), n, sum(np.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in split(t))) for d, t in rows), key=key)
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in out), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], atol=1e-4)
    assert all(r["score"] >= r["base_score"] + np.log10(0.5) * r["n_tokens"] - 1e-6 for r in out if r["n_known"] == r["n_tokens"])
    old, lm.HEAD = lm.HEAD, 5
    try:
        again = lm.score(frame(spark, rows), steps=20).collect()
    finally:
        lm.HEAD = old
    for col in ("n_known", "base_score", "score"):
        a, b = (sorted(((r["doc_id"], r["n_tokens"], r[col]) for r in x), key=key) for x in (again, out))
        assert np.allclose([r[2] for r in a], [r[2] for r in b], atol=1e-2)


def small_model(window=5):
    m = lm.Model(np.array([0, 1, 2, 1, 0, 2]), np.arange(6), 6, width=4, window=window)
    m.within = np.log(np.array([0.5, 0.25, 0.5, 0.75, 0.5, 0.5], np.float32))
    return m


def test_lm_gradients():
    m = small_model()
    for k in m.p:
        m.p[k] = m.p[k].astype(np.float64)
    rng = np.random.default_rng(0)
    rows, target = rng.integers(0, 6, (3, 5)), rng.integers(0, 3, (3, 5))
    _, g = m.gradients(rows, target)
    for k in m.p:
        i = tuple(rng.integers(0, s) for s in m.p[k].shape)
        old, e = m.p[k][i], 1e-5
        m.p[k][i] = old + e
        up = m.gradients(rows, target)[0]
        m.p[k][i] = old - e
        down = m.gradients(rows, target)[0]
        m.p[k][i] = old
        assert g[k][i] == pytest.approx((up - down) / (2 * e), abs=1e-5)


def test_lm_windows_score_each_id_once():
    m = small_model()
    ids, starts = np.random.default_rng(1).integers(0, 6, 23), np.array([0, 1, 12])
    got, _ = m.log_probabilities(ids, starts, window=5, overlap=2, batch=3)
    for s, e in ((0, 1), (1, 12), (12, 23)):
        for i in range(s, e):
            w = 0 if i - s < 5 else (i - s - 2) // 3
            first = s + 3 * w
            rows = np.array([[m.row[ids[k - 1]] if k > s else 6 for k in range(first, i + 1)]])
            want = m.forward(rows)[0][0, -1, m.classes[ids[i]]] + m.within[ids[i]]
            assert got[i] == pytest.approx(want, abs=1e-4)


def test_lm_scores_only_new_places():
    m = small_model(lm.WINDOW)
    places, inner = [], m.class_logs
    m.class_logs = lambda *a: (out := inner(*a), places.append(out[0].size))[0]
    ids, starts = np.random.default_rng(4).integers(0, 6, 1616 + 5), np.array([0, 1616])
    m.log_probabilities(ids, starts)
    assert sum(places) == 1616 + lm.WINDOW  # the last text fills one window


def test_lm_reads_texts_once(spark, monkeypatch):
    made, inner = [], lm.cut
    monkeypatch.setattr(lm, "cut", lambda df, name: (made.append((name, "text#" in df._jdf.queryExecution().analyzed().toString())), inner(df, name))[1])
    lm.score(frame(spark, [(i, "a few words %d" % i) for i in range(30)]), steps=1).collect()
    assert sum(reads for _, reads in made) == 1 and len(made) == 3


def test_lm_ids_and_keys_of_words():
    words = lm.Subwords(lm.read_vocabulary(lm.VOCABULARY))
    texts = ["Ab\tab\x0b aB ", None, "", " \n", "na\u00efve \u00c9 x\u00a0y \x1c\x1d z", "a b", "ab"]
    rows = pa.array(["cut off", *texts])[1:]
    for _ in range(2):  # the second time the words are known
        ids, sizes = words.of_texts(rows)
        want = [[x for w in (t or "").encode().lower().split() for x in words.ids(w)] + [words.end] for t in texts]
        assert ids.tolist() == [x for t in want for x in t] and sizes.tolist() == [len(t) for t in want]
    tokens = [w for t in texts for w in [*(t or "").encode().lower().split(), None]]
    first = np.flatnonzero(words.begins[ids])
    keys = lm.word_keys(ids.astype(np.int32), first).tolist()
    assert len(keys) == len(tokens) and len(set(zip(keys, tokens))) == len(set(keys)) == len(set(tokens))
    swapped = lm.word_keys(np.array([1, 2, 2, 1, 2, 1, 1, 2]), np.array([0, 2, 4, 6, 7]))
    assert len(set(swapped.tolist())) == 4  # their order counts


def test_lm_gradients_of_one_window_and_far_scores():
    rng = np.random.default_rng(2)
    for factor in (1, 300):  # exp of scores over 700 is not finite
        m = lm.Model(np.arange(200) % 96, np.arange(200), 200)
        for k in m.p:
            m.p[k] = m.p[k].astype(np.float64)
        for k in ("wc", "wq"):
            m.p[k] *= factor
        rows, target = rng.integers(0, 200, (1, 16)), rng.integers(0, 96, (1, 16))
        loss, g = m.gradients(rows, target)
        logs = m.forward(rows)[0]
        assert loss == pytest.approx(-logs[0, np.arange(16), target[0]].mean())
        assert np.allclose(g["bc"], np.exp(logs[0]).mean(0) - np.bincount(target[0], minlength=96) / 16)
        assert all(np.isfinite(x).all() and x.shape == m.p[k].shape for k, x in g.items())


def test_lm_classes_and_context():
    rng = np.random.default_rng(3)
    stream = rng.integers(0, 300, 20_000)
    counts = np.bincount(stream, minlength=301)
    assert int(lm.classes_of(lm.neighbours(stream, lm.projection(counts)), counts).max()) + 1 == 96  # the last for ids not seen
    m = lm.Model(np.arange(6), np.arange(6), 6)
    m.within = np.zeros(6, np.float32)
    ids = rng.integers(0, 6, 60)
    for k in range(8, 60):
        other = ids.copy()
        other[k - 8] = (ids[k - 8] + 1) % 6
        a, b = (m.log_probabilities(x, np.array([0]))[0] for x in (ids, other))
        assert a[k] != b[k], k


def test_lm_words_add_up_to_one():
    m = small_model(lm.WINDOW)
    begins = np.array([True, False, True, False, False, True])  # 5 is the end
    m.begin_with(begins)
    before = [0, 3, 2]  # two words
    total, lengths = 0.0, range(1, 6)
    for n in lengths:
        words = [[a, *rest] for a in (0, 2) for rest in itertools.product((1, 3, 4), repeat=n - 1)] + ([[5]] if n == 1 else [])
        ids = np.concatenate([before + w + ([] if w == [5] else [5]) for w in words])
        sizes = np.array([3 + len(w) + (w != [5]) for w in words])
        starts = np.cumsum(sizes) - sizes
        first = np.concatenate([s + np.array([0, 2, 3] + ([] if w == [5] else [3 + len(w)])) for s, w in zip(starts, words)])
        ends = ids[first] == 5
        logs = lm.word_logs(m, ids, first, starts, ends)
        third = np.concatenate([[False, False, True] + ([] if w == [5] else [False]) for w in words])
        total += np.exp(logs[third]).sum()
        assert total <= 1 + 1e-5
        left = 1 - total
    assert left < 0.35  # the longer words
    # the share of unseen words is dealt among them: with the seen ones all add up to at most one
    attention = np.log10([0.2, 0.3, 0.25, 0.25])
    z, known = 10 + 0.1 * 3, np.array([True, True, False, False])
    base = np.log10(np.array([6.1, 4.1, 0.1, 0.1]) / z)
    mix = 10 ** lm.mixed(attention, base, known, np.log10(z))
    assert mix.sum() <= 1 and np.allclose(mix[2:], 0.5 * np.array([0.25, 0.25]) * (1 + 0.1 / z))


def test_lm_learns_from_all_rows(spark):
    ring = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rows = [(i, " ".join(ring[(i + k) % 10] for k in range(20))) for i in range(4000)]
    docs = frame(spark, rows)
    words = lm.Subwords(lm.read_vocabulary(lm.VOCABULARY))
    ids = [[x for w in t.split() for x in words.ids(w.encode())] + [words.end] for _, t in rows]
    counts = np.bincount([x for t in ids for x in t], minlength=words.size).astype(float)
    ranks = spark.sparkContext.broadcast(lm.read_vocabulary(lm.VOCABULARY))
    _, seen = lm.train(docs.select("text"), ranks, counts, steps=1)
    assert seen == sum(-(-len(t) // lm.WINDOW) for t in ids)  # every window of every row, once
    out = [r for r in lm.score(docs, steps=200).collect() if r["held_out"]]
    assert sum(r["score"] for r in out) > 0.75 * sum(r["base_score"] for r in out)  # half is the unigram's


def test_pipeline(spark):
    import corpus_pipeline as P
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash", "decontamination", "pii", "sentencepiece"]
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for k, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, sf)
        assert out.count() == 0 and (k == len(P.STAGES) - 1 or out.columns == docs.columns)
    out = P.run(spark, sf).collect()
    assert out and all(r["round_trip"] for r in out) and len({r["doc_id"] for r in out}) == len(out)


# ---- repeated ids, quotations, repeated windows

def test_ids_with_several_texts_are_one_document(spark, texts):
    far = [t for _, t in texts[:4]]
    for rows, want in [([(1, far[0]), (2, far[0]), (2, far[1]), (3, far[1])], [1, 1, 1, 1]), ([(1, far[0] + " x"), (2, far[0] + " x"), (2, far[1]), (3, far[1]), (4, far[2])], [1, 1, 1, 1, 4]),
                       ([(7, far[0]), (7, far[1]), (7, far[2]), (9, far[3]), (None, far[3]), (None, far[2])], [7, 7, 7, 9, 9, 7])]:
        got = simhash.near_duplicates(frame(spark, rows)).collect()
        ids = {(d, brute_fingerprint(t)): c for (d, t), c in zip(rows, want)}
        assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter((d, ids[d, brute_fingerprint(t)]) for d, t in rows)


def test_one_document_of_each_group_stays(spark, texts):
    fps = [brute_fingerprint(t) for _, t in texts]
    group = brute_components([(i,) for i in range(len(texts))], lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 4)
    got = [(r["doc_id"], r["text"], r["bucket"], r["key"]) for r in simhash.keep_one(frame(spark, texts)).collect()]
    assert len(got) == len(set(group)) and all(r[2:] == (2, "x") for r in got)
    place = {(d, t): g for (d, t), g in zip(texts, group)}
    assert sorted(place[d, t] for d, t, *_ in got) == sorted(set(group))
    for g in set(group):
        ids = [texts[i][0] for i in range(len(texts)) if group[i] == g]
        kept = next(d for d, t, *_ in got if place[d, t] == g)
        assert kept == min((i for i in ids if i is not None), default=None)
    # ids that repeat with other texts, and rows that repeat whole
    a, b, c = (t for _, t in texts[:3])
    assert Counter((r["doc_id"], r["text"]) for r in simhash.keep_one(frame(spark, [(5, a), (5, b), (9, c), (9, c), (9, c), (None, a), (None, None), (None, "")])).collect()) in (
        Counter([(5, a), (5, b), (9, c), (None, None)]), Counter([(5, a), (5, b), (9, c), (None, "")]))
    assert simhash.keep_one(frame(spark, [])).count() == 0


def test_chains_prune_as_the_whole_check_does():
    rng = np.random.default_rng(8)
    x = np.array([sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 8)), replace=False)) for _ in range(3000)], np.uint64)
    assert (simhash.within(x, 4) == (np.bitwise_count(x) <= 4)).all()


def test_quotations_pair_marks():
    inside = lambda t: {t.split()[i] for s, e in toxicity.quotations(t.split()) for i in range(s, e + 1)}
    assert inside('"hi" he is worthless "bye"') == {'"hi"', '"bye"'}
    assert inside('they said "he is worthless" twice') == {'"he', "is", 'worthless"'}
    assert inside("er sagte „du bist nichts“ und ging") == {"„du", "bist", "nichts“"}
    assert inside("« un mot » et »ein Wort« und “one”") == {"«", "un", "mot", "»", "»ein", "Wort«", "“one”"}
    assert inside('a 5" pipe ' + "x " * 20 + 'is "worthless" here') == {'"worthless"'}
    assert inside("no ” closing « alone") == set()
    matches, weights = toxicity.Matches(toxicity.Automaton(["worthless"])), {"worthless": 1.0}
    used, quoted = (toxicity.features(t, matches, weights) for t in ('"hi" he is worthless "bye"', 'it is "so worthless" there'))
    assert used[0] > 0 and used[2] == 0 and quoted[0] == 0 and quoted[2] > 0
    assert matches["w" * 60] is None


def test_toxicity_predicts_by_the_score_shown(spark):
    rows = [(i, f"clean words number {i}") for i in range(40)] + [(100 + i, f"you grumblefink number {i}") for i in range(30)]
    lab = spark.createDataFrame([(i, 0, int(i >= 100)) for i, _ in rows], "doc_id long, quality int, toxic int")
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in toxicity.score(frame(spark, rows), lab).collect())


def test_items_without_an_id_count(spark):
    passage = " ".join(f"w{i}" for i in range(14))
    docs = frame(spark, [(1, f"before {passage} after"), (2, "nothing here")])
    bench = spark.createDataFrame([(None, passage), ("a", "none of it at all"), ("b", None)], "item_id string, text string")
    got = {r["doc_id"]: (r["n_hit"], r["contaminated"], [m["item_id"] for m in r["matches"]]) for r in decontam.find_matches(docs, bench).collect()}
    assert got == {1: (14, True, [None]), 2: (0, False, [])}
    assert [r["doc_id"] for r in decontam.decontaminate(docs, bench).collect()] == [2]


def test_repeated_windows_take_bounded_memory():
    import tracemalloc
    block = decontam.Items([("x", [b"la"] * 2000), ("y", [b"la"] * 9), ("z", [b"la", b"lo"] * 500)], 10)
    assert len(block.offset) == 4
    tracemalloc.start()
    sizes, found = decontam.shard_matches([b"la " * 20_000, b"la lo " * 40, b"other"], block, 10)
    assert tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()
    assert sizes == [20_000, 80, 1]
    assert {m["item_id"] for m in found[0]} == {"x", "y"} and decontam.covered(found[0]) == 20_000
    assert {m["item_id"] for m in found[1]} == {"z"} and decontam.covered(found[1]) == 80 and 2 not in found


def test_matches_are_the_longest_runs():
    words = [f"w{i}".encode() for i in range(40)]
    block = decontam.Items([("a", words), ("b", words[30:])], 10)
    _, found = decontam.shard_matches([b" ".join([b"x", *words[5:30], b"y", *words[25:], b"z"])], block, 10)
    assert sorted((m["item_id"], m["item_start"], m["doc_start"], m["n_words"]) for m in found[0]) == [("a", 5, 1, 25), ("a", 25, 27, 15), ("b", 0, 32, 10)]


def test_shared_folder_is_required_on_a_cluster(spark):
    from types import SimpleNamespace as N

    from stagewise.llm import common
    unset = N(conf=N(get=lambda *_: None), sparkContext=N(master="spark://host:7077", getConf=lambda: N(get=lambda *_: None)))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_dir(unset)


def test_pipeline_loses_no_document_of_a_repeated_id(spark, texts):
    import corpus_pipeline
    a, b, c = (t for _, t in texts[:3])
    kept = corpus_pipeline.drop_near_duplicates(spark, frame(spark, [(5, a), (5, b), (9, c)]), "")
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter([(5, a), (5, b), (9, c)])
    assert kept.columns == frame(spark, []).columns


def test_links_as_a_browser_reads_them(spark):
    """An empty path is the root, rel is a list of tokens, and comments hold no links."""
    block = "http://x.com/de/1"
    rows = [(1, "http://h.net", None), (2, "http://a.net/", '<link rel="canonical" href="http://h.net/">'), (3, "http://h.net/", f'<link rel="nofollow canonical" href="{block}">'), (4, block, None),
            (5, "http://c.net/", f'<!-- <link rel="canonical" href="{block}"> --><p>'), (6, "http://d.net/", f'<!-- open <link rel=canonical href="{block}">'), (7, "http://e.net/", f"<link rel=canonical href={block}>"),
            (8, "http://f.net/", f'<link rel="noncanonical x-canonical-y" href="{block}">'), (9, "http://g.net/", f"<!--x--><LINK REL='Canonical next' HREF='{block}'><!-- y -->")]
    got = {r["page_id"]: r["verdict"] for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "block", 8: "allow", 9: "block"}
