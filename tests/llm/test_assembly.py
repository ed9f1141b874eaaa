"""Hard negatives, the conversation trie and sharding against brute force, on small fixtures full of edge cases."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stagewise.llm import negatives, sharding, trie

EXTRA = "block int, key string, n int, place string, size string, shard int, cell int, vector string"
NOISE = (1, "k", 2, "p", "s", 3, 4, "v")


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


# ---- sharding

def lpt(sizes, shards):
    heap, got = [(0, s) for s in range(shards)], Counter()
    for size in sizes:
        load, s = heapq.heappop(heap)
        heapq.heappush(heap, (load + size, s))
        got[size, s] += 1
    return got, sorted(heap)


@pytest.mark.parametrize("seed", range(6))
def test_loads_are_those_of_the_heap_alone(seed):
    rng = random.Random(seed)
    classes = sorted({rng.randint(1, 10 ** rng.randint(1, 6)): rng.choice([1, 2, 5, 7, 40, 999]) for _ in range(30)}.items(), reverse=True)
    shards = rng.choice([1, 2, 5, 7, 40])
    loads, got = sharding.Loads(shards), Counter()
    for size, n in classes:
        for s, k in enumerate(loads.place(size, n)):
            got[size, s] += k
    want, heap = lpt([size for size, n in classes for _ in range(n)], shards)
    assert +got == want and [(x, s) for s, x in enumerate(loads.load)] == sorted(heap, key=lambda x: x[1])


def documents(spark, rows):
    return spark.createDataFrame([(i, t, *NOISE) for i, t in rows], f"doc_id long, text string, {EXTRA}")


def check_shards(got, rows, shards):
    size = lambda t: len((t or "").encode()) + 16
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t in rows)
    slots, home, loads = defaultdict(list), defaultdict(set), Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        home[r["text_crc32"]].add(r["shard"])
        loads[r["shard"]] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in home.values())
    assert set(slots) <= set(range(shards))
    groups = Counter()
    for _, t in rows:
        groups[t or ""] += size(t)
    _, heap = lpt(sorted(groups.values(), reverse=True), shards)
    assert sorted(loads[s] for s in range(shards)) == sorted(x for x, _ in heap)


@pytest.mark.parametrize("shards", [3, 40])
def test_shard(spark, shards):
    rng = random.Random(shards)
    texts = ["".join(rng.choice("abé漢 ") for _ in range(rng.choice([0, 3, 3, 3, 50, 400]))) for _ in range(120)]
    rows = [(rng.randint(-9, 80), rng.choice(texts)) for _ in range(400)] + [(None, "a"), (None, None), (7, None), (7, ""), (7, "x" * 100_000)] + [(5, "again")] * 300
    got = sharding.shard(documents(spark, rows), shards).collect()
    check_shards(got, rows, shards)
    again = sharding.shard(documents(spark, rows).repartition(5, F.rand(1)), shards)
    assert rows_of(again) == Counter(tuple(r) for r in got)


def test_shard_few_rows_and_errors(spark):
    assert sharding.shard(documents(spark, []), 40).count() == 0
    assert [tuple(r) for r in sharding.shard(documents(spark, [(3, None)]), 40).collect()] == [(3, 16, 0, 0, 0)]
    with pytest.raises(ValueError):
        sharding.shard(documents(spark, []), 0)
    with pytest.raises(ValueError):
        sharding.shard(documents(spark, []), 4, row_bytes=0)


def test_shard_by_another_column(spark):
    rows = [(i, f"text {i}") for i in range(60)]
    docs = documents(spark, rows).withColumn("host", F.concat(F.lit("h"), (F.col("doc_id") % 7).cast("string")))
    homes = defaultdict(set)
    for r in sharding.shard(docs, 3, together=F.col("host")).collect():
        homes[r["doc_id"] % 7].add(r["shard"])
    assert all(len(v) == 1 for v in homes.values())


# ---- trie

def brute_rebuild(rows, group=20, most=4):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            said = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            convs[c].append((turn is not None, turn or 0, said, (role, text)))
    own = {c: [x[3] for x in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        base = c - (c % group if c >= 0 else -(-c % group))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return own, out


def brute_trie(seqs):
    members = defaultdict(list)
    for c, s in seqs:
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, cs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(cs) - 1) * words
    ends = defaultdict(list)
    for c, s in seqs:
        ends[tuple(s)].append(c)
    return Counter((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), kids[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, cs in members.items())


def talks():
    rng = random.Random(11)
    say = [("user", "hello there"), ("assistant", "a b c"), ("user", None), (None, ""), ("user", "x\x0by  z\x00"), ("system", "é 漢 \U0001f600")]
    rows = []
    for c in [*range(0, 65), -5, -20, -40, 1 << 60]:
        for turn in range(rng.choice([1, 1, 2, 3, 5, 8])):
            rows.append((c, turn, *rng.choice(say[:3] if rng.random() < 0.6 else say)))
    rows += [(500 + i, t, "user", f"same {t}") for i in range(80) for t in range(6)]  # copies
    rows += [(3, None, "user", "first"), (3, None, "user", "also first"), (3, 2, "user", "tie"), rows[0], (None, 1, "user", "of none"), (77, 1, "user", "w " * 9_000)]
    return rows + [(900, t, "user", f"turn {t}") for t in range(250)] + [(901, t, "user", f"turn {t}") for t in range(200)]


def conversations(spark, rows):
    return spark.createDataFrame([(*r, *NOISE) for r in rows], f"conv_id long, turn long, role string, text string, {EXTRA}")


@pytest.mark.parametrize("block, chunk", [(trie.BLOCK_BYTES, trie.CHUNK_IDS), (300, 3)])
def test_trie(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(trie, "BLOCK_BYTES", block)
    monkeypatch.setattr(trie, "CHUNK_IDS", chunk)
    rows = talks()
    own, rebuilt = brute_rebuild(rows)
    table = conversations(spark, rows)
    seqs = trie.sequences(table)
    assert rows_of(trie.prefix_trie(trie.keyed(trie.shared_openings(seqs)))) == brute_trie(list(rebuilt.items()))
    if block == 300:
        assert rows_of(trie.conversation_trie(table)) == brute_trie(list(own.items()))


def test_trie_few_rows(spark):
    assert trie.conversation_trie(conversations(spark, [])).count() == 0
    assert trie.conversation_trie(conversations(spark, [(None, 1, "a", "b")])).count() == 0
    # a conversation that is turnless once rebuilt is a member of the root alone
    c = next(i for i in range(1, 20) if zlib.crc32(str(i).encode()) % 4 > 0)
    got = trie.prefix_trie(trie.keyed(trie.shared_openings(trie.sequences(conversations(spark, [(c, 0, "user", "x")])))))
    assert [tuple(r) for r in got.collect()] == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_repeated_members(spark):
    key = lambda *turns: b"".join(bytes([t] * 16) for t in turns)
    seqs = [(4, (1, 2)), (4, (1, 2)), (4, (1,)), (9, ())]
    got = trie.prefix_trie(spark.createDataFrame([(c, key(*s), [t * 10 for t in s]) for c, s in seqs], "conv_id long, key binary, words array<long>"))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert rows_of(got) == Counter([(4, 0, None, 4, 1, 1, 40, sha("9")), (4, 1, 4, 3, 1, 1, 40, sha("4")), (4, 2, 4, 2, 0, 1, 20, sha("4,4"))])


def test_radix_tree_layouts():
    rng = random.Random(2)
    keys = sorted({bytes(rng.randrange(256 if rng.random() < 0.5 else 3) for _ in range(2 * rng.randint(0, 4))) for _ in range(4000)} | {bytes([9, i]) for i in range(60)} | {bytes([8, i]) for i in range(12)})
    tree = trie.Tree()
    for k in rng.sample(range(len(keys)), len(keys)):
        tree.insert(keys[k], k)
    nodes = tree.turns(2)
    spelled = {0: b""}
    for i, (up, depth, some, _) in enumerate(nodes):
        spelled[i] = keys[some][:2 * depth] if i else b""
        assert not i or spelled[up] == spelled[i][:-2]
    assert [spelled[i] for i in range(len(nodes))] == sorted({k[:2 * d] for k in keys for d in range(len(k) // 2 + 1)})
    assert {spelled[i]: x[3] for i, x in enumerate(nodes) if x[3] is not None} == {k: i for i, k in enumerate(keys)}
    kinds, stack = Counter(), [tree.root]
    while stack:
        node = stack.pop()
        if node.layout:
            kinds[type(node.layout).__name__, getattr(node.layout, "most", 0)] += 1
            stack += [k for _, k in node.layout.items()]
    assert set(kinds) == {("Sparse", 4), ("Sparse", 16), ("Indexed", 0), ("Full", 0)}


# ---- hard negatives

def brute_negatives(rows, anchor, k=5, n=3, low=50, high=95):
    rows = [(i, int(x[0]), int(x[1]), [int(v) for v in x[2]]) for i, x in enumerate(rows) if x[0] is not None and x[1] is not None and x[2] is not None and None not in x[2]]
    out = Counter()
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for r, a, la, va in rows:
        if not anchor(a):
            continue
        scored = sorted((-dot(va, v), i, l, j) for j, i, l, v in rows if j != r)
        for s, p, _, _ in [x for x in scored if x[2] == la][:k]:
            hits = [x for x in scored if x[2] != la and low * -s <= 100 * -x[0] <= high * -s][:n]
            for rank, x in enumerate(hits, 1):
                out[a, p, rank, x[1], -s, -x[0]] += 1
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(*r, *NOISE[:-1]) for r in rows], f"id long, label int, vector array<long>, {EXTRA.rsplit(',', 1)[0]}")


def clustered(rng, n, dims, spread):
    mids = rng.integers(-100, 100, (6, dims))
    return [(int(i), int(rng.integers(0, 4)), [int(v) for v in mids[rng.integers(0, 6)] + rng.integers(-spread, spread + 1, dims)]) for i in range(n)]


@pytest.mark.parametrize("dims, spread", [(8, 3), (7, 200), (1, 5)])
def test_hard_negatives(spark, monkeypatch, dims, spread):
    monkeypatch.setattr(negatives, "CHUNK", 16)
    monkeypatch.setattr(negatives, "BLOCK", 4)
    monkeypatch.setattr(negatives, "FIRST", 8)
    monkeypatch.setattr(negatives, "CODES", 4)
    rng = np.random.default_rng(dims)
    rows = clustered(rng, 160, dims, spread)
    # copies, a repeated anchor with two labels, zero and negative scores, nulls, other lengths
    rows += [(200, 1, [50] * dims)] * 40 + [(210, 2, [45] * dims)] * 3 + [(10, 3, rows[10][2]), (10, 1, rows[10][2]), (400, 9, [5] * dims), (410, 0, [0] * dims), (420, 1, [-3] * dims),
             (430, None, [1] * dims), (440, 1, None), (450, 1, [None] * dims), (None, 1, [9] * dims), (460, 2, []), (470, 2, [7]), (480, 3, [2] * dims)]
    got = negatives.hard_negatives(vectors(spark, rows), F.col("id") % 10 == 0)
    assert rows_of(got) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_hard_negatives_few_rows_and_large_numbers(spark):
    run = lambda rows, **k: rows_of(negatives.hard_negatives(vectors(spark, rows), F.col("id") % 10 == 0, **k))
    assert not run([]) and not run([(1, 1, [1, 2])]) and not run([(10, 1, [1, 2])])
    big = [(10, 1, [1 << 27, 3]), (11, 1, [1 << 27, 5]), (12, 2, [(1 << 27) - 30_000_000, 1]), (13, 2, [(1 << 27) - 30_000_000, 0])]
    assert run(big) == brute_negatives(big, lambda i: i == 10)
    assert run(big, positives=1, negatives=1, low=0, high=100) == brute_negatives(big, lambda i: i == 10, 1, 1, 0, 100)


def test_bounds_hold_and_the_heap_falls():
    rng = np.random.default_rng(4)
    x = rng.integers(-300, 300, (500, 6)).astype(float)
    books = [negatives.codebook(x[:, :3], 5, 4), negatives.codebook(x[:, 3:], 5, 4)]
    (i, r1), (j, r2) = negatives.nearest(x[:, :3], books[0]), negatives.nearest(x[:, 3:], books[1])
    radii = [np.array([r[c == k].max(initial=0) for k in range(5)]) for c, r in ((i, r1), (j, r2))]
    cells = i * 5 + j
    index = negatives.Index(books, radii, np.bincount(cells, minlength=25))
    for q in rng.integers(-300, 300, (20, 6)).astype(float):
        seen = list(index.visit(q))
        assert sorted(c for c, _, _ in seen) == sorted(set(cells.tolist()))
        tops = [high for _, high, _ in seen]
        assert all(a >= b - 1e-6 for a, b in zip(tops, tops[1:]))
        for cell, high, low in seen:
            s = x[cells == cell] @ q
            assert s.max() <= high and s.min() >= low


def test_certified_queries_leave_cells_unseen():
    x = np.concatenate([np.full((50, 2), 100.0), np.full((50, 2), -100.0)])
    books = [np.array([[100.0], [-100.0]])] * 2
    index = negatives.Index(books, [np.zeros(2)] * 2, np.array([50, 0, 0, 50]))
    cells, visited, rest = index.following(np.array([10.0, 10.0]), 0, 500, 1e9, 1000)
    assert cells == [0] and visited == 1 and rest < 500 and len(x) == 100


def test_whole_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.5, -0.001], 1), (2, [0.5, nan], 1), (3, [inf, 0.0], 1), (4, [None, 0.0], 1), (5, None, 1), (6, [], None)]
    got = {r["id"]: r["vector"] for r in negatives.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert got == {1: [128, -1], 2: None, 3: None, 4: None, 5: None, 6: []}
