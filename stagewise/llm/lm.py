"""Language-model scores: corpus word counts, and a causal self-attention model in numpy on subword ids.

Every text is read once, into the subword ids of its words, which are written
and serve the counts, the fit and the scores alike.

The word counts cover every training document: counts of 64-bit hashes of the
words' ids, partially aggregated per task.  Scoring finds the ``HEAD`` most
frequent words in a bounded broadcast and joins the others by hash, so no task
holds the vocabulary.

The attention model reads a text's lower-cased words as subword ids of a
public vocabulary (a path), each word with its space, then an end id.  It
predicts one of ``CLASSES`` classes of the next id; the id within its class has
its corpus frequency, counted over all training documents.  Windows of ``WINDOW``
ids overlap by ``OVERLAP``; each id is scored once, in batches of masked
attention, and past the first window sees more than ``OVERLAP`` ids before it.

The model is fitted on all training documents.  Classes come from neighbour
counts of all ids.  In each of ``ROUNDS`` rounds every task runs Adam over its
windows from the shared parameters, and their weighted means, of fixed size,
are the next round's; small inputs are gone over until ``STEPS`` batches are
seen.  So fitted parameters depend a little on how the table is split.

A word's attention probability is that of its subwords given that a word
begins, times that of a beginning behind them, so those of all words add up to
one.  A token's probability is the even mixture of it and the corpus: seen
words have their smoothed frequency there, and the one unseen share, 0.1 of the
smoothed total, is dealt among unseen words by their attention probability.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.llm.common import chunks, crc_mod, cut, plus

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
FOLDS, HEAD = 10, 100_000
WINDOW, OVERLAP, WIDTH, CLASSES, STEPS, BATCH, OWN = 16, 8, 16, 96, 1000, 256, 8192
SHARD_BYTES, IDS, KEPT_WORDS = 2_000_000, 1_000_000, 200_000
ROUNDS, PARTS, NEIGHBOURS = 5, 16, 24
SEED = 20_251


def word_keys(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Signed 64-bit hash of each token's subword ids, which are its word's alone; ``first`` are the tokens' first places in ``ids``."""
    x = np.arange(len(ids), dtype=np.uint64) - np.repeat(first, np.diff(first, append=len(ids))).astype(np.uint64)
    x <<= np.uint64(32)
    x += ids.astype(np.uint64)
    for shift, factor in ((30, 0x9E3779B97F4A7C15), (27, 0xBF58476D1CE4E5B9), (31, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x += np.uint64(0x9E3779B97F4A7C15)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(32)
    return np.add.reduceat(x, first).view(np.int64)


def read_vocabulary(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def id_type(size: int) -> np.dtype:
    """The numbers that ids below ``size`` are written as."""
    return np.dtype(np.uint16 if size <= 1 << 16 else np.int32)


class Subwords(dict):
    """Ids of words with their space in front, kept once asked for; the end id follows the last one."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken
        self.end = max(ranks.values()) + 1
        self.size = self.end + 1
        self.begins = np.zeros(self.size, bool)  # the ids that begin a word, and the end
        self.begins[[i for b, i in ranks.items() if b[:1] == b" "] + [self.end]] = True
        self.type = id_type(self.size)
        self.encode = tiktoken.Encoding("words", pat_str=" [^ ]+", mergeable_ranks=ranks, special_tokens={}).encode_to_numpy

    def ids(self, word: bytes) -> list[int]:
        return self.encode(" " + word.decode()).tolist()

    def learn(self, words: list[bytes]) -> None:
        """Keep the ids of ``words``, all in one call: only a word's first id begins with a space."""
        if words:
            ids = self.encode(" " + b" ".join(words).decode())
            cuts = self.type.itemsize * np.flatnonzero(np.r_[self.begins[ids], True])
            ids, cuts = ids.astype(self.type).tobytes(), cuts.tolist()
            self.update(zip(words, (ids[a:b] for a, b in zip(cuts, cuts[1:])), strict=True))

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the texts' words and ends, end to end; how many each text has)."""
        if len(self) > KEPT_WORDS:
            self.clear()
        split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        text, word = pc.list_parent_indices(split), pc.list_flatten(split)
        some = pc.not_equal(word, "")
        text, word = text.filter(some).to_numpy(), word.filter(some).dictionary_encode()
        words = word.dictionary.cast(pa.binary()).to_pylist()
        self.learn([w for w in words if w not in self])
        pieces = [self[w] for w in words]
        pieces.append(np.array([self.end], self.type).tobytes())
        lengths, table = np.array([len(x) for x in pieces]) // self.type.itemsize, np.frombuffer(b"".join(pieces), self.type)
        ends = np.cumsum(np.bincount(text, minlength=len(texts)) + 1) - 1
        token = np.empty(len(text) + len(texts), np.int64)
        token[ends] = len(pieces) - 1
        token[np.arange(len(text)) + text] = word.indices.to_numpy()
        n = lengths[token]
        last = np.cumsum(n)
        ids = table[np.repeat((np.cumsum(lengths) - lengths)[token] - last + n, n) + np.arange(n.sum())]
        return ids, np.diff(last[ends], prepend=0)


_SUBWORDS: dict[int, Subwords] = {}


def subwords(ranks: dict[bytes, int]) -> Subwords:
    """One per worker process."""
    if len(ranks) not in _SUBWORDS:
        _SUBWORDS[len(ranks)] = Subwords(ranks)
    return _SUBWORDS[len(ranks)]


def apart(x: np.ndarray) -> bool:
    """Whether scores lie so far from zero that they must be shifted before ``exp``."""
    return bool(x.max() > 60 or x.min() < -60)


class Model:
    """One causal self-attention layer and a feed-forward layer, over classes of ids."""

    NAMES = ("embed", "place", "wq", "wk", "wv", "w1", "b1", "w2", "wc", "bc")

    def __init__(self, classes: np.ndarray, row: np.ndarray, n_rows: int, width: int = WIDTH, seed: int = SEED, window: int = WINDOW):
        rng = np.random.default_rng(seed)
        r = lambda *s: rng.normal(0, s[0] ** -0.5, s).astype(np.float32)
        self.classes, self.row = classes.astype(np.int32), row.astype(np.int32)
        n = int(classes.max()) + 1
        self.p = {"embed": rng.normal(0, 0.3, (n_rows + 1, width)).astype(np.float32), "place": rng.normal(0, 0.1, (window, width)).astype(np.float32),
                  "wq": r(width, width), "wk": r(width, width), "wv": r(width, width), "w1": r(width, 2 * width), "b1": np.zeros(2 * width, np.float32),
                  "w2": r(2 * width, width) * np.float32(0.5), "wc": r(width, n), "bc": np.zeros(n, np.float32)}
        self.mask = np.triu(np.full((window, window), -1e9, np.float32), 1)
        self.within: np.ndarray | None = None  # log probability of each id in its class
        self.begin_share: np.ndarray | None = None  # of each class, the probability that its id begins a word

    def forward(self, rows: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Class log probabilities (B, T, C) of the ids that follow the ids in the embedding ``rows`` (B, T)."""
        p, t = self.p, rows.shape[1]
        x = p["embed"][rows] + p["place"][:t]
        q, k, v = x @ p["wq"], x @ p["wk"], x @ p["wv"]
        a = np.matmul(q, k.transpose(0, 2, 1))
        a *= np.float32(x.shape[2] ** -0.5)
        a += self.mask[:t, :t]
        a -= a.max(2, keepdims=True)
        np.exp(a, out=a)
        a /= a.sum(2, keepdims=True)
        z = x + np.matmul(a, v)
        u = np.maximum(z @ p["w1"] + p["b1"], 0)
        o = z + u @ p["w2"]
        logits = o @ p["wc"] + p["bc"]
        logits -= logits.max(2, keepdims=True)
        logits -= np.log(np.exp(logits).sum(2, keepdims=True))
        return logits, (rows, x, q, k, v, a, z, u, o)

    def begin_with(self, begins: np.ndarray) -> None:
        """Note which ids begin a word."""
        self.begin_share = np.bincount(self.classes, np.exp(self.within.astype(np.float64)) * begins, int(self.classes.max()) + 1).astype(np.float32)

    def class_logs(self, rows: np.ndarray, cls: np.ndarray, lanes: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities (B, T - ``lanes``) of the classes ``cls`` after the ids in ``rows`` (B, T), and that a word begins there, from
        place ``lanes`` on: ``forward`` with fewer passes over the arrays, and what no asked place needs left out."""
        p, (n, t) = self.p, rows.shape
        d = p["embed"].shape[1]
        x = np.take(p["embed"], rows.ravel(), 0).reshape(n, t, d)
        x += p["place"][:t]
        own = np.ascontiguousarray(x[:, lanes:]).reshape(-1, d)
        a = np.matmul((own @ (p["wq"] @ p["wk"].T * np.float32(d ** -0.5))).reshape(n, -1, d), x.transpose(0, 2, 1))
        a += self.mask[lanes:t, :t]
        np.minimum(a, np.float32(80), out=a)  # exp stays finite
        np.exp(a, out=a)
        flat = a.reshape(-1, t)
        z = np.matmul(a, x).reshape(-1, d)
        z /= (flat @ np.ones(t, flat.dtype))[:, None]
        z = z @ p["wv"]
        z += own
        u = z @ p["w1"]
        u += p["b1"]
        np.maximum(u, 0, out=u)
        z += u @ p["w2"]
        o = np.ones((len(z), d + 1), z.dtype)
        o[:, :d] = z
        logits = np.concatenate([p["wc"], p["bc"][None]]).T @ o.T  # class by place
        np.minimum(logits, np.float32(80), out=logits)
        chosen = logits[cls.ravel(), np.arange(len(z))]
        np.exp(logits, out=logits)
        weights = np.ones((2, len(logits)), logits.dtype)
        if self.begin_share is not None:
            weights[1] = self.begin_share
        total, begin = np.log(weights @ logits)
        return (chosen - total).reshape(n, -1), (begin - total).reshape(n, -1)

    def gradients(self, rows: np.ndarray, target: np.ndarray, inside: np.ndarray | None = None) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy of the target classes, of those ``inside`` if given, and its gradients.

        Class scores are kept class by place, so that their passes run along the places.
        """
        p, (n, t) = self.p, rows.shape
        d, kind = p["embed"].shape[1], p["embed"].dtype
        live = np.ones(n * t, kind) if inside is None else inside.ravel().astype(kind)
        live /= live.sum()
        flat, every = rows.ravel(), np.ones(max(n * t, p["wc"].shape[1]), kind)
        x = np.take(p["embed"], flat, 0)
        x.reshape(n, t * d)[:] += p["place"][:t].ravel()
        scale = kind.type(d ** -0.5)
        wq, x3 = p["wq"] * scale, x.reshape(n, t, d)
        both = wq @ p["wk"].T
        q = (x @ both).reshape(n, t, d)  # queries and keys in one product
        a = np.matmul(q, x3.transpose(0, 2, 1))
        far = apart(a)
        a.reshape(n, t * t)[:] += self.mask[:t, :t].ravel()
        if far:
            a -= a.max(2, keepdims=True)
        np.exp(a, out=a)
        a /= (a.reshape(-1, t) @ every[:t]).reshape(n, t, 1)
        y = np.matmul(a, x3).reshape(-1, d)
        z = y @ p["wv"]
        z += x
        u = z @ p["w1"]
        u.reshape(n, -1)[:] += np.tile(p["b1"], t)
        np.maximum(u, 0, out=u)
        o = np.empty((n * t, d + 1), kind)
        o[:, d] = 1
        np.add(u @ p["w2"], z, out=o[:, :d])
        g = np.concatenate([p["wc"], p["bc"][None]]).T @ o.T
        if apart(g):
            g -= g.max(0)
        at, target = np.arange(n * t), target.ravel()
        chosen = g[target, at]
        np.exp(g, out=g)
        total = every[:len(g)] @ g
        loss = float(((np.log(total) - chosen) * live).sum())
        g *= live / total
        g[target, at] -= live
        wc = g @ o
        go = g.T @ p["wc"].T
        gu = go @ p["w2"].T
        gu *= np.sign(u)  # not below zero
        out = {"wc": wc[:, :d].T, "bc": wc[:, d], "w2": u.T @ go, "w1": z.T @ gu, "b1": every[:n * t] @ gu}
        gx = gu @ p["w1"].T
        gx += go
        out["wv"] = y.T @ gx
        gy = (gx @ p["wv"].T).reshape(n, t, d)
        gs = np.matmul(gy, x3.transpose(0, 2, 1))
        gs -= ((gs * a).reshape(-1, t) @ every[:t]).reshape(n, t, 1)
        gs *= a
        gx += np.matmul(a.transpose(0, 2, 1), gy).reshape(-1, d)
        gx += np.matmul(gs.transpose(0, 2, 1), q).reshape(-1, d)
        gq = np.matmul(gs, x3).reshape(-1, d)
        gx += gq @ both.T
        of_both = x.T @ gq
        out["wq"], out["wk"] = of_both @ p["wk"] * scale, of_both.T @ wq
        out["place"] = np.zeros_like(p["place"])
        out["place"][:t] = (every[:n] @ gx.reshape(n, -1)).reshape(t, d)
        out["embed"] = np.zeros_like(p["embed"])
        pair, step = (kind, d) if d % 2 else (np.result_type(kind, np.complex64), d // 2)  # two numbers are added at once
        np.add.at(out["embed"].reshape(-1).view(pair), (flat[:, None] * step + np.arange(step)).ravel(), gx.reshape(-1).view(pair))
        return loss, out

    def adam(self, m: dict, s: dict, step: int, rows: np.ndarray, target: np.ndarray, inside: np.ndarray, lr: float) -> float:
        """One step with the moments ``m`` and ``s`` (10 and 100 times the means), all changed in place; the loss before it."""
        loss, g = self.gradients(rows, target, inside)
        late = (1 - 0.99 ** step) ** 0.5
        rate, least = np.float32(lr * 0.1 / (1 - 0.9 ** step) * late / 0.1), np.float32(1e-6 * late / 0.1)
        for k in self.p:
            x, a, b = g[k], m[k], s[k]
            a *= np.float32(0.9)
            a += x
            x *= x
            b *= np.float32(0.99)
            b += x
            np.sqrt(b, out=x)
            x += least
            np.divide(a, x, out=x)
            x *= rate
            self.p[k] -= x
        return loss

    def log_probabilities(self, ids: np.ndarray, starts: np.ndarray, window: int = WINDOW, overlap: int = OVERLAP, batch: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """Natural log probability of each id, and of a word beginning at its place; ``starts`` are the texts' first places in ``ids``.

        A text's first window scores all its ids; each later one starts
        ``window - overlap`` further on and scores what is new.
        """
        n = len(ids)
        ends = np.r_[starts[1:], n]
        sizes = ends - starts
        step = window - overlap
        counts = np.where(sizes > window, 1 + -(-(sizes - window) // step), 1) * (sizes > 0)
        first = np.repeat(starts, counts) + step * (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
        begin, end = np.repeat(starts, counts), np.repeat(ends, counts)
        none = len(self.p["embed"]) - 1  # the place before a text
        before = np.r_[none, self.row[ids[:-1]]][:n]
        before[starts[sizes > 0]] = none
        cls = self.classes[ids]
        out, begins = self.within[ids].astype(np.float64), np.zeros(n)
        opening = first == begin
        for some, skip in ((np.flatnonzero(opening), 0), (np.flatnonzero(~opening), overlap)):  # later windows score what is new
            lane = np.arange(window)
            for b in range(0, len(some), batch):
                at = first[some[b:b + batch], None] + lane
                new = (at < end[some[b:b + batch], None])[:, skip:]
                np.minimum(at, n - 1, out=at)
                own = at[:, skip:]
                logs, starting = self.class_logs(before[at], cls[own], skip)
                own = own[new]
                out[own] += logs[new]
                begins[own] = starting[new]
        return out, begins


def projection(counts: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Random directions of the most frequent ids; none for the others."""
    out = np.random.default_rng(seed).normal(0, 1, (len(counts), NEIGHBOURS)).astype(np.float32)
    out[np.argsort(-counts, kind="stable")[2000:]] = 0
    return out


def neighbours(ids: np.ndarray, project: np.ndarray) -> np.ndarray:
    """Sums of the projections of the ids before and after each id of a stream; pairs of ids that both have one are counted first."""
    size, width = project.shape
    top = np.flatnonzero(project.any(1))
    rank = np.full(size, -1)
    rank[top] = np.arange(len(top))
    rank = rank[ids]
    frequent, out = rank >= 0, np.zeros((size, 2 * width))
    both = frequent[1:] & frequent[:-1]
    pairs = np.bincount(rank[:-1][both] * len(top) + rank[1:][both], np.ones(both.sum()), len(top) ** 2).reshape(len(top), -1)
    for at, other, lanes, count in ((slice(1, None), slice(None, -1), slice(width), pairs.T), (slice(None, -1), slice(1, None), slice(width, None), pairs)):
        rare = frequent[other] & ~both
        beside = project[ids[other][rare]]
        out[:, lanes] = np.stack([np.bincount(ids[at][rare], beside[:, j], size) for j in range(width)], 1)
        out[top, lanes] += count @ project[top].astype(np.float64)
    return out


def classes_of(x: np.ndarray, count: np.ndarray, n: int = CLASSES) -> np.ndarray:
    """Classes of ids with like neighbours: k-means on their projected neighbour counts ``x``."""
    size = len(count)
    x = (x / np.sqrt(np.maximum(count, 1))[:, None]).astype(np.float32)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-6)
    seen = np.flatnonzero(count >= 5)
    out = np.full(size, n - 1)
    k = min(n - 1, len(seen))
    if not k:
        return np.zeros(size, np.int64)
    heavy = seen[np.argsort(-count[seen], kind="stable")]
    alone = heavy[:k // 3]  # the most frequent ids are classes of their own
    rest = heavy[k // 3:]
    out[alone] = np.arange(len(alone))
    k -= len(alone)
    if len(rest) and k:
        centre = x[rest[np.linspace(0, len(rest) - 1, k).astype(int)]].copy()
        for _ in range(12):
            own = np.argmax(x[rest] @ centre.T, 1)
            for j in range(k):
                if (own == j).any():
                    centre[j] = np.average(x[rest[own == j]], axis=0, weights=count[rest[own == j]])
            centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-6)
        out[rest] = len(alone) + own
    used, out = np.unique(out, return_inverse=True)
    return out


def new_model(x: np.ndarray, counts: np.ndarray) -> Model:
    """The model before its fit: classes from the neighbour sums ``x``, class and id frequencies from the corpus counts of all ids."""
    classes = classes_of(x, counts)
    top = np.argsort(-counts, kind="stable")[:OWN]
    row = OWN + classes  # rarer ids share their class's embedding
    row[top] = np.arange(len(top))
    model = Model(classes, row, OWN + int(classes.max()) + 1)
    c = counts + 0.1
    of_class = np.log(np.bincount(classes, c))
    model.p["bc"][:] = of_class - of_class.max()
    model.within = (np.log(c) - of_class[classes]).astype(np.float32)
    return model


def _encode(batches, ranks):
    """The batches with ``ids`` in the place of ``text``: the subword ids of each and its end id, as numbers of ``id_type``."""
    words = subwords(ranks.value)
    for held in chunks(batches, "text", SHARD_BYTES):
        b = pa.Table.from_batches(held).combine_chunks()
        ids, sizes = words.of_texts(pa.concat_arrays(b["text"].chunks))
        ends = np.r_[0, np.cumsum(ids.itemsize * sizes)].astype(np.int32)
        out = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(ids)])
        yield from b.set_column(b.schema.get_field_index("text"), "ids", out).to_batches()
    words.clear()  # the process serves other tasks


def ids_of(held: list[pa.RecordBatch], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, sizes of the texts) of ``_encode``'s rows; ids are below ``size``."""
    ids, sizes, kind = [], [], id_type(size)
    for b in held:
        x = b.column(b.schema.get_field_index("ids"))
        ends = np.frombuffer(x.buffers()[1], np.int32)[x.offset:x.offset + len(x) + 1]
        sizes.append(np.diff(ends) // kind.itemsize)
        ids.append(np.frombuffer(x.buffers()[2], kind, sizes[-1].sum(), ends[0]) if ends[-1] > ends[0] else np.empty(0, kind))
    return np.concatenate(ids), np.concatenate(sizes).astype(np.int64)


def _streams(batches, size: int):
    """(ids, sizes of the texts) in bounded chunks of ``_encode``'s rows."""
    for held in chunks(batches, "ids", IDS * id_type(size).itemsize):
        ids, sizes = ids_of(held, size)
        if len(ids):
            yield ids.astype(np.int32), sizes


def _neighbour_sums(batches, project):
    """(id, sums) of one task's texts."""
    total = None
    for ids, _ in _streams(batches, len(project.value)):
        x = neighbours(ids, project.value)
        if total is None:
            total = x
        else:
            total += x
    if total is not None:
        some = np.flatnonzero(total.any(1))
        for at in range(0, len(some), 4096):
            part = some[at:at + 4096]
            yield pa.record_batch([pa.array(part // 256, pa.int32()), pa.array(part), pa.array([v.tobytes() for v in total[part]], pa.binary())], names=["part", "id", "x"])


def _add_neighbours(table: pa.Table) -> pa.Table:
    """The sums of one part's ids, over all tasks."""
    ids = table["id"].to_numpy()
    x = np.array([np.frombuffer(v, np.float64) for v in table["x"].to_pylist()])
    by = np.lexsort((*x.T[:2], ids))  # always added in one order
    ids, x = ids[by], x[by]
    heads = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    return pa.table({"id": pa.array(ids[heads]), "x": pa.array([v.astype(np.float32).tobytes() for v in np.add.reduceat(x, heads)], pa.binary())})


def windows_of(ids: np.ndarray, sizes: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, and the first and the end place of their text, of the windows side by side that hold every id once."""
    counts = -(-sizes // window)
    starts = np.cumsum(sizes) - sizes
    first = np.repeat(starts, counts) + window * (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
    return first, np.repeat(starts, counts), np.repeat(starts + sizes, counts)


def _fit(batches, shared, turn: int, stride: int, epochs: int):
    """Adam over one task's windows of this turn; its parameters and moments in ``PARTS`` parts, with the windows seen."""
    from pyspark import TaskContext
    model, m, s, steps = shared.value
    first_p, model.p = model.p, {k: v.copy() for k, v in model.p.items()}
    m, s = ({k: v.copy() for k, v in x.items()} for x in (m, s))
    rng = np.random.default_rng((SEED, turn, TaskContext.get().partitionId()))
    none, lane, at, seen = len(model.p["embed"]) - 1, np.arange(WINDOW), 0, 0
    rate = 0.01 * (1 - 0.9 * turn / max(1, ROUNDS - 1))
    for ids, sizes in _streams(batches, len(model.classes)):
        first, begin, end = windows_of(ids, sizes)
        mine = np.flatnonzero((at + np.arange(len(first))) % stride == turn % stride)
        at += len(first)
        for _ in range(epochs):
            order = rng.permutation(mine)
            for b in range(0, len(order), BATCH):
                f, st, e = (x[order[b:b + BATCH], None] for x in (first, begin, end))
                place = f + lane
                here = np.minimum(place, len(ids) - 1)
                before = np.where(place > st, model.row[ids[np.clip(place - 1, 0, len(ids) - 1)]], none)
                steps += 1
                model.adam(m, s, steps, before, model.classes[ids[here]], place < e, rate * min(1.0, steps / 50))
                seen += len(f)
    flat = np.concatenate([x[k].ravel() for x in (model.p, m, s) for k in Model.NAMES])
    model.p = first_p  # the broadcast value serves other tasks of this process
    if seen:
        cuts = np.array_split(flat, PARTS)
        n = len(cuts)
        yield pa.record_batch([pa.array(np.arange(n), pa.int32()), pa.array([TaskContext.get().partitionId()] * n, pa.int32()), pa.array([seen] * n, pa.int64()),
                               pa.array([steps] * n, pa.int64()), pa.array([c.astype(np.float32).tobytes() for c in cuts], pa.binary())], names=["part", "task", "seen", "steps", "x"])


FITTED = "part int, task int, seen long, steps long, x binary"


def _mean(table: pa.Table) -> pa.Table:
    """One part's mean over the tasks, by the windows they saw."""
    table = table.sort_by("task")
    seen, total = table["seen"].to_pylist(), 0.0
    for n, x in zip(seen, table["x"]):
        total = total + n * np.frombuffer(x.as_py(), np.float32).astype(np.float64)
    steps = sum(n * k for n, k in zip(seen, table["steps"].to_pylist())) // sum(seen)
    return pa.table({"part": table["part"][:1], "task": pa.array([len(seen)], pa.int32()), "seen": pa.array([sum(seen)], pa.int64()), "steps": pa.array([steps], pa.int64()),
                     "x": pa.array([(total / sum(seen)).astype(np.float32).tobytes()], pa.binary())})


def encoded(rows: DataFrame, ranks) -> DataFrame:
    """``rows`` with subword ``ids`` in the place of ``text``, written once; ``ranks`` is the broadcast vocabulary."""
    schema = T.StructType([T.StructField("ids", T.BinaryType()) if f.name == "text" else f for f in rows.schema])
    return cut(rows.mapInArrow(lambda bs: _encode(bs, ranks), schema), "ids")


def train(texts: DataFrame, ranks, counts: np.ndarray, steps: int = STEPS) -> tuple[Model, int]:
    """The model fitted on all ``texts`` (text), and the windows seen; ``ranks`` is the broadcast vocabulary, ``counts`` the corpus counts of all ids."""
    return fit(encoded(texts, ranks), counts, steps)


def fit(rows: DataFrame, counts: np.ndarray, steps: int = STEPS) -> tuple[Model, int]:
    """``train`` on texts already ``encoded`` (ids)."""
    sc = rows.sparkSession.sparkContext
    project = sc.broadcast(projection(counts))
    sums = rows.mapInArrow(lambda bs: _neighbour_sums(bs, project), "part int, id long, x binary").groupBy("part").applyInArrow(_add_neighbours, "id long, x binary").toArrow()
    x = np.zeros((len(counts), 2 * NEIGHBOURS), np.float32)  # as many rows as the vocabulary has
    if sums.num_rows:
        x[sums["id"].to_numpy()] = [np.frombuffer(v, np.float32) for v in sums["x"].to_pylist()]
    model = new_model(x, counts)
    n = rows.agg(F.coalesce(F.sum(F.ceil(F.octet_length("ids") / (id_type(len(counts)).itemsize * WINDOW))), F.lit(0))).first()[0]
    if not n:
        return model, 0
    passes = -(-steps * BATCH // n)  # over all windows, one at least
    stride, epochs = (ROUNDS, passes) if passes < ROUNDS else (1, -(-passes // ROUNDS))
    rows = rows.coalesce(max(1, n // (steps * BATCH)))  # a task has enough windows to learn by itself
    m, s = ({k: np.zeros_like(v) for k, v in model.p.items()} for _ in range(2))
    done = seen = 0
    for turn in range(ROUNDS):
        shared = sc.broadcast((model, m, s, done))
        tasks = rows.mapInArrow(lambda bs, shared=shared, turn=turn: _fit(bs, shared, turn, stride, epochs), FITTED)
        parts = sorted(tasks.groupBy("part").applyInArrow(_mean, FITTED).collect(), key=lambda r: r["part"])
        if not parts:
            continue
        flat, at = np.concatenate([np.frombuffer(r["x"], np.float32) for r in parts]), 0
        for d in (model.p, m, s):
            for k in Model.NAMES:
                d[k] = flat[at:at + d[k].size].reshape(d[k].shape).copy()
                at += d[k].size
        done, seen = parts[0]["steps"], seen + parts[0]["seen"]
    return model, seen


def _count(batches, ranks, flush: int = 500_000):
    """(kind, key, n): word counts by hash (kind 0) and subword counts by id (kind 1), of one task's texts, as they fill up."""
    words = subwords(ranks.value)
    of_ids = np.zeros(words.size, np.int64)
    key, n = np.empty(0, np.int64), np.empty(0, np.int64)

    def batch(kind: int, key: np.ndarray, n: np.ndarray):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int32)), pa.array(key), pa.array(n)], names=["kind", "key", "n"])

    for ids, _ in _streams(batches, words.size):
        of_ids += np.bincount(ids, minlength=words.size)
        more, of_more = np.unique(word_keys(ids, np.flatnonzero(words.begins[ids])), return_counts=True)
        key, n = np.r_[key, more], np.r_[n, of_more]
        by = np.argsort(key)
        key, n = key[by], n[by]
        heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        key, n = key[heads], np.add.reduceat(n, heads)
        if len(key) >= flush:
            yield batch(0, key, n)
            key, n = key[:0], n[:0]
    some = np.flatnonzero(of_ids)
    yield batch(0, key, n)
    yield batch(1, some, of_ids[some])


def _score(batches, shared):
    """Per text: tokens, the base and model sums over frequent words, and the others by hash with their attention score."""
    begins, head, n_head, log_z, model = shared.value
    for held in chunks(batches, "ids", IDS // 4 * id_type(len(begins)).itemsize):
        doc_ids = pa.concat_arrays([b.column(0) for b in held])
        ids, sizes = ids_of(held, len(begins))
        ends = np.cumsum(sizes)
        first = np.flatnonzero(begins[ids])  # of each token, all words and the end
        logs = word_logs(model, ids, first, ends - sizes, np.isin(first, ends - 1, assume_unique=True)) / np.log(10)
        tokens = np.diff(np.searchsorted(first, ends), prepend=0)
        doc = np.repeat(np.arange(len(sizes)), tokens)
        key = word_keys(ids, first)
        at = np.minimum(np.searchsorted(head, key), len(head) - 1)
        c, frequent = n_head[at], head[at] == key
        rare = pa.StructArray.from_arrays([pa.array(key[~frequent]), pa.array(logs[~frequent].astype(np.float32))], ["key", "log"])
        in_doc = np.r_[0, np.cumsum(np.bincount(doc[~frequent], minlength=len(sizes)))]
        doc, c, logs = doc[frequent], c[frequent], logs[frequent]
        base = np.log10(c + 0.1) - log_z
        yield pa.RecordBatch.from_arrays([doc_ids, pa.array(tokens), pa.array(np.bincount(doc, c > 0, len(sizes)).astype(np.int64)),
                                          pa.array(np.bincount(doc, base, len(sizes))), pa.array(np.bincount(doc, mixed(logs, base, c > 0, log_z), len(sizes))),
                                          pa.ListArray.from_arrays(pa.array(in_doc.astype(np.int32)), rare)], names=["doc_id", "n_tokens", "n_known", "base", "score", "rare"])


def word_logs(model: Model, ids: np.ndarray, first: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Natural log probability of each token, of all words and the end: ``first`` are the tokens' first places in ``ids``,
    ``starts`` the texts', ``ends`` marks the tokens that end a text."""
    logs, begins = model.log_probabilities(ids, starts)
    out = np.add.reduceat(logs, first) - begins[first]
    out[:-1] += np.where(ends[:-1], 0.0, begins[first[1:]])
    return out


def mixed(attention: np.ndarray, base: np.ndarray, known: np.ndarray, log_z: float) -> np.ndarray:
    """log10 of the model's probability: half the attention's, half the corpus's, whose unseen share the unseen words have by the attention's."""
    corpus = np.where(known, base, attention - 1 - log_z)
    return np.logaddexp2(attention * np.log2(10), corpus * np.log2(10)) / np.log2(10) + np.log10(0.5)


SCORED = "n_tokens long, n_known long, base double, score double, rare array<struct<key:long,log:float>>"


def score(docs: DataFrame, vocabulary: str = VOCABULARY, steps: int = STEPS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs`` (doc_id, text, ...).

    Words are runs of other than ASCII white space, with A-Z lower-cased; a
    text's tokens are its words and one end.  Rows with crc32(doc_id as text)
    mod 10 = 0 are held out and not learned from.  A null or empty text has
    the end alone.  Repeated rows count and are scored one by one; a null
    doc_id counts as the empty text.  Without training rows all counts are 0.
    An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), (crc_mod("doc_id", FOLDS) == 0).alias("held_out"))
    ranks = read_vocabulary(vocabulary)
    shared_ranks = spark.sparkContext.broadcast(ranks)
    rows = encoded(rows, shared_ranks)
    learned = rows.where(~F.col("held_out"))
    counts = learned.select("ids").mapInArrow(lambda bs: _count(bs, shared_ranks), "kind int, key long, n long")
    counts = cut(counts.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    by_word = counts.where("kind = 0")
    total, distinct = by_word.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    log_z = float(np.log10(total + 0.1 * (distinct + 1)))
    head = {r["key"]: r["n"] for r in by_word.orderBy(F.desc("n"), "key").limit(HEAD).toLocalIterator()}
    end = int(word_keys(np.array([subwords(ranks).end]), np.array([0]))[0])
    if end not in head:
        head[end] = learned.count() if distinct > HEAD else 0
    ids = np.zeros(subwords(ranks).size)
    for r in counts.where("kind = 1").toLocalIterator():  # as many as the vocabulary has at most
        ids[r["key"]] = r["n"]
    model, _ = fit(learned.select("ids"), ids, steps)
    model.begin_with(subwords(ranks).begins)
    keys = sorted(head)
    shared = spark.sparkContext.broadcast((subwords(ranks).begins, np.array(keys, np.int64), np.array([head[k] for k in keys], np.int64), log_z, model))

    scored = rows.select("doc_id", "ids").mapInArrow(lambda bs: _score(bs, shared), plus(rows.select("doc_id").schema, SCORED))
    scored = cut(scored.withColumn("row", F.monotonically_increasing_id()), "scored")  # the ids are kept as written
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.key", F.col("r.log").cast("double").alias("log"))
    rare = rare.join(by_word.select("key", "n"), "key", "left")
    c = F.coalesce("n", F.lit(0))
    base = F.log10(c + 0.1) - log_z
    unseen = F.col("log") + float(np.log10(0.5 * (1 + 10 ** (-1 - log_z))))
    mix = F.when(c > 0, F.log10(0.5 * F.pow(F.lit(10.0), F.col("log")) + 0.5 * F.pow(F.lit(10.0), base))).otherwise(unseen)
    rare = rare.groupBy("row").agg(F.sum(base).alias("more_base"), F.sum(mix).alias("more"), F.count_if(c > 0).alias("known"))
    out = scored.drop("rare").join(rare, "row", "left")
    return out.select("doc_id", (crc_mod("doc_id", FOLDS) == 0).alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
                      F.lit(int(total)).cast("long").alias("train_tokens"), F.round(F.col("base") + F.coalesce("more_base", F.lit(0.0)), 6).alias("base_score"),
                      F.round(F.col("score") + F.coalesce("more", F.lit(0.0)), 6).alias("score"))
