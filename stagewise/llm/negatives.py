"""Hard-negative mining over an inverted multi-index.

A vector is cut into two halves, and each half has a codebook; a pair of codes is
a cell.  All vectors are indexed: a cell's vectors lie in chunks of about
``CHUNK`` rows, however many it has.  With c the centroid and r the radius (the
largest distance of a member from it) of a code, no member's half-score with a
query half q is above q.c + |q| r.  For each query, a multi-sequence heap visits
the cells by the sum of their two bounds, from the largest down.  It stops once
every window of the query is certified: it has its k rows and no cell left has a
bound as large as the least of their scores, or no cell left reaches the window.

On Spark the visits go in rounds.  In each, every open block of queries asks for
its next cells, enough to see ``FIRST`` rows a query, then ``STEP`` times as many.
Requests meet the chunks by an equality join on (cell, chunk); a task scores a
block's queries against a chunk by one matrix product and keeps the best k of
each window; the block's state is merged and written.  The answers are exact.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.llm.common import cut

#: the codebooks are fitted on at most SAMPLE rows, those with the smallest hashes of their id
SAMPLE, CODES, STEPS = 4096, 16, 8
CHUNK, BLOCK, FIRST, STEP = 4096, 256, 4096, 8
#: components saturate here, so that scores fit 64 bits up to 64 dimensions, whatever the input
MOST = 1 << 28
LOW, HIGH = -(1 << 62), 1 << 62


def codebook(x: np.ndarray, codes: int, steps: int) -> np.ndarray:
    """Centroids by Lloyd's steps, started from rows far from each other."""
    if not len(x):
        return np.zeros((1, x.shape[1]))
    start, far = [0], ((x - x[0]) ** 2).sum(1)
    while len(start) < codes and far.max() > 0:
        start.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[start[-1]]) ** 2).sum(1))
    c = x[start].copy()
    for _ in range(steps):
        code, _ = nearest(x, c)
        for k in range(len(c)):
            if (code == k).any():
                c[k] = x[code == k].mean(0)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row and the distance from it."""
    code = ((c * c).sum(1) - 2 * (x @ c.T)).argmin(1)
    return code, np.sqrt(((x - c[code]) ** 2).sum(1))


class Index:
    """Codebooks, radii and the number of rows of each cell: all that a query needs to order the cells."""

    def __init__(self, books: list[np.ndarray], radii: list[np.ndarray], rows: np.ndarray):
        self.books, self.radii, self.rows = books, radii, rows
        self.cut = books[0].shape[1]
        self.chunks = -(-rows // CHUNK)

    def cell(self, i: int, j: int) -> int:
        return i * len(self.books[1]) + j

    def bounds(self, q: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half, the largest and smallest half-scores of every code's members."""
        out = []
        for x, c, r in zip((q[:self.cut], q[self.cut:]), self.books, self.radii):
            mid, way = c @ x, np.sqrt(x @ x) * r
            slack = 1e-9 * (np.abs(mid) + way) + 0.25  # the scores are whole numbers
            out.append((mid + way + slack, mid - way - slack))
        return out

    def visit(self, q: np.ndarray):
        """(cell, largest score, smallest score) of all cells with rows, by falling largest score."""
        (high1, low1), (high2, low2) = self.bounds(q)
        a, b = np.argsort(-high1, kind="stable"), np.argsort(-high2, kind="stable")
        heap = [(-(high1[a[0]] + high2[b[0]]), 0, 0)]
        while heap:
            top, i, j = heapq.heappop(heap)
            # (i, j + 1) follows (i, j); (i + 1, 0) follows (i, 0): each pair is pushed once
            if j + 1 < len(b):
                heapq.heappush(heap, (-(high1[a[i]] + high2[b[j + 1]]), i, j + 1))
            if not j and i + 1 < len(a):
                heapq.heappush(heap, (-(high1[a[i + 1]] + high2[b[0]]), i + 1, 0))
            cell = self.cell(a[i], b[j])
            if self.rows[cell]:
                yield cell, -top, low1[a[i]] + low2[b[j]]

    def following(self, q: np.ndarray, visited: int, least: float, top: float, budget: int) -> tuple[list[int], int, float]:
        """The cells to see next of a query that has visited the first ``visited``: enough for ``budget`` rows, as
        far as their largest score is ``least`` or more; those wholly above ``top`` are passed over.  Then the
        number visited with them, and the largest score that any other cell may hold."""
        cells, seen = [], 0
        for at, (cell, high, low) in enumerate(self.visit(q.astype(np.float64))):
            if at < visited:
                continue
            if seen >= budget or high < least:
                return cells, visited, high
            visited = at + 1
            if low <= top:
                cells.append(cell)
                seen += int(self.rows[cell])
        return cells, visited, -np.inf


def product(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers; in floating point only where that is exact."""
    if not q.size or not x.size:
        return np.zeros((len(q), len(x)), np.int64)
    if float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < 2**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


_LISTS = "ids array<long>, rids array<long>, labels array<long>, vectors binary"
_STATE = f"block long, {_LISTS}, windows int, lows array<long>, highs array<long>, visited array<int>, open int, found array<long>"
_ROW = ("rid", "id", "score")


def _ints(values) -> pa.Array:
    return pa.array([np.asarray(v, np.int64) for v in values], pa.list_(pa.int64()))


class Block:
    """The state of a block of queries.  found[q, w, :, 0:3]: row, id and score of the best of window w so far, row -1 where none."""

    def __init__(self, row: dict, dims: int, k: int):
        self.ids, self.rids, self.labels = (np.asarray(row[c], np.int64) for c in ("ids", "rids", "labels"))
        self.vectors = np.frombuffer(row["vectors"], np.int32).reshape(len(self.ids), dims)
        n, w = len(self.ids), row["windows"]
        self.lows, self.highs = (np.asarray(row[c], np.int64).reshape(n, w) for c in ("lows", "highs"))
        self.visited = np.asarray(row["visited"], np.int32)
        self.found = np.asarray(row["found"], np.int64).reshape(n, w, k, 3)

    def least(self) -> np.ndarray:
        """The score that a row must reach in each window: the k-th found so far, or the window's low end."""
        last = self.found[:, :, -1]
        need = np.where(last[:, :, 0] >= 0, np.maximum(last[:, :, 2], self.lows), self.lows)
        return np.where(self.lows <= self.highs, need, HIGH)  # an empty window asks for nothing

    def reach(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each query, the least score that any of its windows asks for and the largest that any takes."""
        return self.least().min(1), np.where(self.lows <= self.highs, self.highs, LOW).max(1)


def state_batch(rows: list[dict]) -> pa.RecordBatch:
    lists = ("ids", "rids", "labels", "lows", "highs", "found")
    cols = {"block": pa.array([r["block"] for r in rows], pa.int64()), "vectors": pa.array([r["vectors"] for r in rows], pa.binary()), "windows": pa.array([r["windows"] for r in rows], pa.int32()),
            "visited": pa.array([np.asarray(r["visited"], np.int32) for r in rows], pa.list_(pa.int32())), "open": pa.array([r["open"] for r in rows], pa.int32())}
    cols |= {c: _ints(r[c] for r in rows) for c in lists}
    names = [f.split(" ")[0] for f in _STATE.split(", ")]
    return pa.RecordBatch.from_arrays([cols[n] for n in names], names=names)


def best(score: np.ndarray, ok: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) of the first k rows of each query among ``ok``, by falling score, then id."""
    q, x = np.nonzero(ok)
    by = np.lexsort((ids[x], -score[q, x], q))
    q, x = q[by], x[by]
    if not len(q):
        return q, x
    heads = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
    rank = np.arange(len(q)) - np.repeat(heads, np.diff(np.r_[heads, len(q)]))
    return q[rank < k], x[rank < k]


def build(rows: DataFrame) -> tuple[DataFrame, DataFrame, Index, int]:
    """(all rows with their cells, the chunks, the index, the dimensions) of ``rows`` (id, label, vector, anchor)."""
    rows = cut(rows, "vectors")
    dims = max(2, rows.agg(F.max(F.size("vector"))).first()[0] or 0)

    def matrix(col: pa.Array) -> np.ndarray:
        out = np.zeros((len(col), dims), np.int32)
        sizes = np.diff(col.offsets.to_numpy())
        flat = col.flatten().to_numpy(zero_copy_only=False)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[np.repeat(np.arange(len(col)), sizes), at] = np.clip(flat, -MOST, MOST)
        return out

    some = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toArrow().combine_chunks()
    sample = matrix(some.column(0).chunk(0) if some.num_rows else pa.array([], pa.list_(pa.int64()))).astype(np.float64)
    half = dims // 2
    books = [codebook(sample[:, :half], CODES, STEPS), codebook(sample[:, half:], CODES, STEPS)]

    def place(batches):
        rid = TaskContext.get().partitionId() << 40
        for b in batches:
            x = matrix(b.column(2))
            f = x.astype(np.float64)
            (i, r1), (j, r2) = nearest(f[:, :half], books[0]), nearest(f[:, half:], books[1])
            rids = np.arange(rid, rid + b.num_rows, dtype=np.int64)
            rid += b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(rids), b.column(0), b.column(1), pa.array(i * len(books[1]) + j), pa.array(r1), pa.array(r2),
                                              pa.array([v.tobytes() for v in x], pa.binary()), b.column(3)], names=["rid", "id", "label", "cell", "r1", "r2", "vector", "anchor"])
    placed = cut(rows.select("id", "label", "vector", "anchor").mapInArrow(place, "rid long, id long, label long, cell long, r1 double, r2 double, vector binary, anchor boolean"), "placed")
    radii, count = [np.zeros(len(c)) for c in books], np.zeros(len(books[0]) * len(books[1]), np.int64)
    # at most CODES * CODES rows
    for cell, n, r1, r2 in placed.groupBy("cell").agg(F.count(F.lit(1)), F.max("r1"), F.max("r2")).collect():
        i, j = divmod(cell, len(books[1]))
        radii[0][i], radii[1][j], count[cell] = max(radii[0][i], r1), max(radii[1][j], r2), n
    index = Index(books, radii, count)
    chunk_count = F.element_at(F.array(*[F.lit(max(1, int(n))) for n in index.chunks]), (F.col("cell") + 1).cast("int"))

    def pack(key, group):
        group = group.sort_by("id")
        return pa.table({"cell": [key[0].as_py()], "chunk": [key[1].as_py()], "ids": _ints([group["id"].to_numpy()]), "rids": _ints([group["rid"].to_numpy()]),
                         "labels": _ints([group["label"].to_numpy()]), "vectors": [b"".join(group["vector"].to_pylist())]})
    # rows are dealt round within a task, so chunks are even, repeated ids or not
    dealt = placed.withColumn("chunk", F.pmod(F.xxhash64("rid"), chunk_count)).select("cell", "chunk", "id", "rid", "label", "vector")
    chunks = cut(dealt.groupBy("cell", "chunk").applyInArrow(pack, f"cell long, chunk long, {_LISTS}"), "chunks")
    return placed, chunks, index, dims


def search(queries: DataFrame, chunks: DataFrame, index: Index, dims: int, k: int, same: bool) -> DataFrame:
    """``queries`` (blocks) with ``found``: of each window, the first k rows with the query's label
    (``same``: without the query itself) or with another, by falling score, then id."""
    spark = queries.sparkSession
    shared = spark.sparkContext.broadcast(index)
    budget = FIRST
    state = queries
    while state.agg(F.sum("open")).first()[0]:
        def ask(batches, budget=budget):
            ix: Index = shared.value
            for b in batches:
                for row in b.to_pylist():
                    block, wanted = Block(row, dims, k), {}
                    if not row["open"]:
                        continue
                    for q, (least, top) in enumerate(zip(*block.reach())):
                        if least < HIGH:
                            for cell in ix.following(block.vectors[q], block.visited[q], least, top, budget)[0]:
                                wanted.setdefault(cell, []).append(q)
                    asked = [(cell, chunk, qs) for cell, qs in wanted.items() for chunk in range(ix.chunks[cell])]
                    if not asked:
                        continue
                    need = block.least()
                    pick = lambda values: [values[qs] for _, _, qs in asked]
                    yield pa.RecordBatch.from_arrays([pa.array([c for c, _, _ in asked], pa.int64()), pa.array([c for _, c, _ in asked], pa.int64()), pa.array([row["block"]] * len(asked), pa.int64()),
                                                      _ints(qs for _, _, qs in asked), _ints(pick(block.rids)), _ints(pick(block.labels)), pa.array([v.tobytes() for v in pick(block.vectors)], pa.binary()),
                                                      _ints(v.ravel() for v in pick(need)), _ints(v.ravel() for v in pick(block.highs))],
                                                     names=["cell", "chunk", "block", "qs", "q_rids", "q_labels", "q_vectors", "needs", "highs"])

        def score(batches):
            held: dict[int, list[np.ndarray]] = {}
            for b in batches:
                cols = dict(zip(b.schema.names, b.columns))
                for at, block in enumerate(cols["block"].to_pylist()):
                    ints = {c: cols[c][at].values.to_numpy() for c in ("qs", "q_rids", "q_labels", "needs", "highs", "ids", "rids", "labels")}
                    qs, ids, rids = ints["qs"], ints["ids"], ints["rids"]
                    q, x = (np.frombuffer(cols[c][at].as_buffer(), np.int32).reshape(-1, dims) for c in ("q_vectors", "vectors"))
                    s = product(q, x)
                    alike = ints["q_labels"][:, None] == ints["labels"]
                    ok = alike & (ints["q_rids"][:, None] != rids) if same else ~alike
                    need, high = ints["needs"].reshape(len(q), -1), ints["highs"].reshape(len(q), -1)
                    for w in range(need.shape[1]):
                        i, j = best(s, ok & (s >= need[:, w, None]) & (s <= high[:, w, None]), ids, k)
                        if len(i):
                            held.setdefault(block, []).append(np.stack([qs[i], np.full(len(i), w), rids[j], ids[j], s[i, j]], 1))
                    if sum(map(len, held.get(block, ()))) > 50_000:
                        held[block] = [keep(np.concatenate(held[block]), k)]
                    if sum(len(v) for vs in held.values() for v in vs) > 1_000_000:
                        yield hits(held, k)
                        held = {}
            yield hits(held, k)

        def merge(key, blocks, found):
            row = blocks.to_pylist()[0]
            if not row["open"]:
                return blocks
            block = Block(row, dims, k)
            w = block.lows.shape[1]
            qs, ws, at = np.nonzero(block.found[..., 0] >= 0)
            old = np.column_stack([qs, ws, block.found[qs, ws, at]])
            new = [np.frombuffer(h, np.int64).reshape(-1, 5) for h in found["hits"].to_pylist()]
            all_hits = keep(np.concatenate([old, *new]), k)
            place = all_hits[:, 0] * w + all_hits[:, 1]
            heads = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else place
            rank = np.arange(len(place)) - np.repeat(heads, np.diff(np.r_[heads, len(place)]))
            fresh = np.full_like(block.found, -1)
            fresh[all_hits[:, 0], all_hits[:, 1], rank] = all_hits[:, 2:]
            # the cells asked for were chosen by the scores before this round
            visited, left, asked_by = block.visited.copy(), 0, block.reach()
            block.found = fresh
            for q, (least, top, now) in enumerate(zip(*asked_by, block.reach()[0])):
                if least < HIGH:
                    _, visited[q], high = shared.value.following(block.vectors[q], block.visited[q], least, top, budget)
                    left += bool(high >= now)
            return pa.Table.from_batches([state_batch([row | {"visited": visited, "found": fresh.ravel(), "open": left}])])

        asked = state.where("open > 0").mapInArrow(ask, "cell long, chunk long, block long, qs array<long>, q_rids array<long>, q_labels array<long>, q_vectors binary, needs array<long>, highs array<long>")
        # requests are many times the state they are made from, which is all that Spark could go by: no broadcast
        met = asked.join(chunks.select("cell", "chunk", "ids", "rids", "labels", "vectors").hint("merge"), ["cell", "chunk"])
        hit = met.mapInArrow(score, "block long, hits binary")
        state = cut(state.groupBy("block").cogroup(hit.groupBy("block")).applyInArrow(merge, _STATE), "state")
        budget *= STEP
    return state


def keep(hits: np.ndarray, k: int) -> np.ndarray:
    """The first k hits (query, window, row, id, score) of each query and window, by falling score, then id; a row counts once."""
    hits = hits[np.lexsort((hits[:, 2], hits[:, 3], -hits[:, 4], hits[:, 1], hits[:, 0]))]
    if not len(hits):
        return hits
    hits = hits[np.r_[True, (hits[1:] != hits[:-1]).any(1)]]
    heads = np.flatnonzero(np.r_[True, (hits[1:, :2] != hits[:-1, :2]).any(1)])
    rank = np.arange(len(hits)) - np.repeat(heads, np.diff(np.r_[heads, len(hits)]))
    return hits[rank < k]


def hits(held: dict[int, list[np.ndarray]], k: int) -> pa.RecordBatch:
    kept = {block: keep(np.concatenate(v), k) for block, v in held.items()}
    return pa.RecordBatch.from_arrays([pa.array(list(kept), pa.int64()), pa.array([v.tobytes() for v in kept.values()], pa.binary())], names=["block", "hits"])


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over ``rows`` (id long, label, vector array<long>).

    A score is an inner product of whole numbers; higher come first, ties by
    smaller id.  ``anchors`` is a condition on the columns of ``rows``; an anchor's
    positives are its first ``positives`` other rows of its label, and for each
    its negatives are the first ``negatives`` rows of another label whose score s
    has low * p <= 100 * s <= high * p, p the positive's score.  So a
    negative p has none, and p = 0 only those of score 0.  All rows are searched, and the answers are exact.

    Rows with a null id, label or vector or a null component take no part.
    Shorter vectors count as filled up with zeros; components saturate at
    +-2**28, and scores must fit 64 bits.  Rows are told apart by themselves, not
    by id: a row equal to the anchor is another row, and a repeated anchor has
    its results again.  An empty table, or one without anchors, gives no rows;
    other columns are not read.
    """
    whole = F.forall("vector", lambda x: x.isNotNull())
    rows = rows.withColumn("_anchor", F.coalesce(anchors, F.lit(False))).where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & whole)
    placed, chunks, index, dims = build(rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.col("vector").cast("array<long>").alias("vector"), F.col("_anchor").alias("anchor")))
    chosen = placed.where("anchor")
    n = chosen.count()
    blocks = max(1, -(-n // BLOCK))

    def gather(key, group):
        m = group.num_rows
        row = {"block": key[0].as_py(), "ids": group["id"].to_numpy(), "rids": group["rid"].to_numpy(), "labels": group["label"].to_numpy(), "vectors": b"".join(group["vector"].to_pylist()),
               "windows": 1, "lows": np.full(m, LOW), "highs": np.full(m, HIGH - 1), "visited": np.zeros(m, np.int32), "open": m, "found": np.full(m * positives * 3, -1)}
        return pa.Table.from_batches([state_batch([row])])

    def windows(batches):
        for b in batches:
            for row in b.to_pylist():
                found = np.asarray(row["found"], np.int64).reshape(len(row["ids"]), positives, 3)
                some, p = found[..., 0] >= 0, found[..., 2]
                lows, highs = np.where(some, -(-low * p // 100), 0), np.where(some, high * p // 100, -1)
                row |= {"windows": positives, "lows": lows.ravel(), "highs": highs.ravel(), "visited": np.zeros(len(found), np.int32), "open": int((lows <= highs).any(1).sum()),
                        "found": np.full(lows.size * negatives * 3, -1)}
                yield state_batch([row])

    def spell(batches):
        for b in batches:
            for row in b.to_pylist():
                ids = np.asarray(row["ids"], np.int64)
                pos = np.asarray(row["positives"], np.int64).reshape(len(ids), positives, 3)
                neg = np.asarray(row["found"], np.int64).reshape(len(ids), positives, negatives, 3)
                q, p, k = np.nonzero(neg[..., 0] >= 0)
                cols = [ids[q], pos[q, p, 1], (k + 1).astype(np.int32), neg[q, p, k, 1], pos[q, p, 2], neg[q, p, k, 2]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    # rid is a place in a task, so blocks are even
    start = chosen.select("id", "rid", "label", "vector").withColumn("block", F.pmod(F.xxhash64("rid"), F.lit(blocks))).groupBy("block").applyInArrow(gather, _STATE)
    near = search(cut(start, "queries"), chunks, index, dims, positives, same=True)
    far = search(cut(near.mapInArrow(windows, _STATE), "windows"), chunks, index, dims, negatives, same=False)
    both = far.select("block", "ids", "found").join(near.select("block", F.col("found").alias("positives")).hint("merge"), "block")
    return both.select("ids", "positives", "found").mapInArrow(spell, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def whole_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(id, label, vector array<long>) of ``embeddings`` (vec_id, embedding, label, ...): each component x
    becomes floor(scale * x); rows with a null or non-finite component have a null vector."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(v * scale))
    return embeddings.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.when(fine, whole).cast("array<long>").alias("vector"))
