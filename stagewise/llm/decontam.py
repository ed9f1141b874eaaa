"""Benchmark decontamination with suffix arrays over the training shards.

Words are runs of digits, letters a-z (A-Z lower-cased) and characters from
U+0080 up.  Each task sorts the suffixes of the training words it reads, one
bounded shard at a time, and binary-searches every different test suffix in that suffix
array.  A window of ``window`` consecutive item words (an item of fewer words
is one window) that is found is a match; matches on one diagonal join into the
longest verbatim runs.  No shuffle, no pairs of documents, and no pairs of
repeated windows and places: equal windows are looked up once, and a window that
an item repeats counts at its first place there, where runs may break.

The test items are the stated query set.  They reach the tasks in blocks of at
most ``BLOCK_WORDS`` words, each a bounded broadcast; texts pass one block
after the other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.llm.common import chunks, plus, text_bytes

WINDOW = 10
BLOCK_WORDS, SHARD_BYTES, PAIRS = 1_000_000, 8_000_000, 1_000_000

_WORD = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _WORD else 0x20 for c in range(256))

MATCHES = "array<struct<item_id:string,item_start:int,doc_start:int,n_words:int>>"
_MATCH = pa.struct([("item_id", pa.string()), ("item_start", pa.int32()), ("doc_start", pa.int32()), ("n_words", pa.int32())])


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Items:
    """One block of test items as word ids, with the windows to look up."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.ids = [i for i, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        words, offset, length = [], [], []
        places: dict[tuple[int, ...], int] = {}  # of different windows
        inside: list[dict[int, int]] = []  # of each window, the items that hold it, each with its first place there
        for k, (_, ws) in enumerate(items):
            at = len(words)
            own = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in ws]
            words += own
            for s in range(max(1, len(ws) - window + 1) if ws else 0):
                key = tuple(own[s:s + window])
                if key not in places:
                    places[key] = len(offset)
                    offset.append(at + s)
                    length.append(len(key))
                    inside.append({})
                inside[places[key]].setdefault(k, s)
            words += [0] * window  # a gap: no window runs into the next item
        self.words = np.array(words, np.int64)
        self.offset, self.length = np.array(offset, np.int64), np.array(length, np.int64)
        self.holders = np.array([len(x) for x in inside], np.int64)
        self.first = np.cumsum(self.holders) - self.holders
        self.item = np.array([k for x in inside for k in x], np.int64)
        self.start = np.array([s for x in inside for s in x.values()], np.int64)


def suffix_array(words: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` in the order of their suffixes' first ``depth`` words (0 ends a suffix), by prefix doubling."""
    rank, h = words.copy(), 1
    order = starts[np.argsort(rank[starts], kind="stable")]
    while h < depth:
        after = np.zeros_like(rank)
        after[:-h] = rank[h:]
        key = rank[starts] * (rank.max() + 1) + after[starts]
        by = np.argsort(key, kind="stable")
        order, key = starts[by], key[by]
        new = np.zeros_like(rank)
        new[order] = np.cumsum(np.r_[1, key[1:] != key[:-1]])
        rank, h = new, 2 * h
    return order


def search(words: np.ndarray, order: np.ndarray, block: Items) -> tuple[np.ndarray, np.ndarray]:
    """First and end rank in the suffix array of the suffixes that begin with each window."""
    def bound(upper: bool) -> np.ndarray:
        lo, hi = np.zeros(len(block.offset), np.int64), np.full(len(block.offset), len(order), np.int64)
        for _ in range(int(len(order)).bit_length()):
            open_ = lo < hi
            mid = np.where(open_, (lo + hi) // 2, 0)
            at = order[mid]
            below, same = np.zeros(len(lo), bool), np.ones(len(lo), bool)
            for d in range(int(block.length.max())):
                live = same & (d < block.length)
                x, y = words[at + d], block.words[block.offset + d]
                below |= live & (x < y)
                same &= ~live | (x == y)
            right = open_ & (below | (same if upper else False))
            lo = np.where(right, mid + 1, lo)
            hi = np.where(open_ & ~right, mid, hi)
        return lo
    if not len(block.offset) or not len(order):
        return (np.zeros(len(block.offset), np.int64),) * 2
    return bound(False), bound(True)


def shard_matches(texts: list[bytes], block: Items, window: int) -> tuple[list[int], dict[int, list[dict]]]:
    """Words of each text, and by text the longest verbatim runs shared with the items."""
    get, stream, base, sizes = block.vocabulary.get, [], [], []
    gap = [0] * window
    for t in texts:
        ws = words_of(t)
        base.append(len(stream))
        sizes.append(len(ws))
        stream += [get(w, 0) for w in ws]
        stream += gap
    words = np.array(stream, np.int64)
    order = suffix_array(words, np.flatnonzero(words), window) if len(words) else words
    lo, hi = search(words, order, block)
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    at = order[np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)] if len(which) else which
    by = np.argsort(at, kind="stable")
    which, at = which[by], at[by]
    runs = np.zeros((0, 5), np.int64)  # (document, item, diagonal, first and end place)
    each = np.cumsum(block.holders[which]) if len(which) else which
    for s, e in slices(each, PAIRS):
        m = block.holders[which[s:e]]
        pick = np.repeat(np.arange(s, e), m)
        holder = np.arange(len(pick)) - np.repeat(np.cumsum(m) - m, m) + np.repeat(block.first[which[s:e]], m)
        more = np.stack([np.searchsorted(base, at[pick], "right") - 1, block.item[holder], at[pick] - block.start[holder], at[pick], at[pick] + block.length[which[pick]]], 1)
        runs = joined(np.concatenate([runs, joined(more)]))
    found: dict[int, list[dict]] = {}
    for doc, item, diagonal, first, end in runs.tolist():
        found.setdefault(doc, []).append({"item_id": block.ids[item], "item_start": first - diagonal, "doc_start": first - base[doc], "n_words": end - first})
    return sizes, found


def slices(total: np.ndarray, most: int):
    """Ranges of rows whose running ``total`` grows by about ``most`` each."""
    s = 0
    while s < len(total):
        before = total[s - 1] if s else 0
        e = max(s + 1, int(np.searchsorted(total, before + most, "right")))
        yield s, e
        s = e


def joined(runs: np.ndarray) -> np.ndarray:
    """Runs on one diagonal of a document and item that overlap or meet, as one."""
    if not len(runs):
        return runs
    runs = runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.r_[True, (runs[1:, :3] != runs[:-1, :3]).any(1) | (runs[1:, 3] > runs[:-1, 4])]
    heads = np.flatnonzero(new)
    out = runs[heads].copy()
    out[:, 4] = np.maximum.reduceat(runs[:, 4], heads)
    return out


def covered(matches: list[dict]) -> int:
    """Words inside at least one match."""
    total = end = 0
    for s, e in sorted((m["doc_start"], m["doc_start"] + m["n_words"]) for m in matches):
        total += max(0, e - max(s, end))
        end = max(end, e)
    return total


def blocks(benchmark: DataFrame, window: int):
    """The items in blocks of bounded size; rows of one item_id stand for themselves, null texts go."""
    held, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).where(F.col("text").isNotNull())
    for item_id, text in rows.toLocalIterator():
        ws = words_of(text.encode())
        if held and size + len(ws) > BLOCK_WORDS:
            yield Items(held, window)
            held, size = [], 0
        held.append((item_id, ws))
        size += len(ws)
    yield Items(held, window)


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, matches, contaminated) of every row of ``docs`` (doc_id, text, ...).

    matches holds the longest verbatim runs by item, with their places in the
    document and in the item, in words.  n_hit counts document words inside a match.  A null or wordless text has no words
    and isn't contaminated; items without words or with a null text match
    nothing.  An item with a null id matches like any other, under that id.  Rows with the same
    id and repeated texts are judged one by one, whole.  Empty tables give no
    matches or no rows; other columns are not read.
    """
    sc = docs.sparkSession.sparkContext
    out = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.lit(0).cast("long").alias("n_words"),
                      F.lit(None).cast(MATCHES).alias("matches"))
    for block in blocks(benchmark, window):
        shared = sc.broadcast(block)

        def run(batches, shared=shared):
            for held in chunks(batches, "text", SHARD_BYTES):
                texts = [t for b in held for t in text_bytes(b.column(1))]
                sizes, found = shard_matches(texts, shared.value, window)
                at = 0
                for b in held:
                    old = b.column(3).to_pylist()
                    matches = [(m or []) + found.get(at + i, []) for i, m in enumerate(old)]
                    yield pa.record_batch([b.column(0), b.column(1), pa.array(sizes[at:at + b.num_rows], pa.int64()),
                                           pa.array(matches, pa.list_(_MATCH))], names=["doc_id", "text", "n_words", "matches"])
                    at += b.num_rows
        out = out.mapInArrow(run, out.schema)

    def count(batches):
        for b in batches:
            hits = [covered(m or []) for m in b.column(2).to_pylist()]
            yield pa.record_batch([*b.columns, pa.array(hits, pa.int64())], names=["doc_id", "n_words", "matches", "n_hit"])
    out = out.select("doc_id", "n_words", "matches")
    out = out.mapInArrow(count, plus(out.schema, "n_hit long"))
    return out.withColumn("contaminated", F.col("n_hit") > 0)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that share a window with an item; all columns stay."""
    sc = docs.sparkSession.sparkContext
    for block in blocks(benchmark, window):
        shared = sc.broadcast(block)

        def run(batches, shared=shared, col="text"):
            for held in chunks(batches, col, SHARD_BYTES):
                texts = [t for b in held for t in text_bytes(b.column(b.schema.get_field_index(col)))]
                _, found = shard_matches(texts, shared.value, window)
                at = 0
                for b in held:
                    yield b.filter(pa.array([at + i not in found for i in range(b.num_rows)], pa.bool_()))
                    at += b.num_rows
        docs = docs.mapInArrow(run, docs.schema)
    return docs
