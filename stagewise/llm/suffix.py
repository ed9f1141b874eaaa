"""Repeated-passage removal with blockwise, difference-cover suffix sorting.

A byte goes if a ``length``-byte string of its text that covers it also starts
anywhere else, in the same text or another.

1. Suffix buckets.  Every ``length``-byte window has a minimizer: its
   ``GRAM``-byte string of least hash.  Equal windows have equal minimizers at
   equal offsets, so the minimizer names the suffix bucket, and a window whose
   minimizer occurs once needs no sorting.  Consecutive windows with one
   minimizer form a segment.  Counting buckets and segments is partially
   aggregated, so copies never meet row by row.
2. Segments that occur twice or more are settled whole.  Their identities, and
those of the texts, are 128 bits long: at 10^12 segments none clash.
3. What is left, segments that share a bucket but differ, is sorted: a task
   takes one bucket after the other, in blocks of bounded size.  Suffixes of a
   block compare by bucket, offset and first eight bytes; long ties are
   resolved by ranks, computed beforehand, of the positions in a difference
   cover modulo ``MODULUS``.  All members of a bucket are laid out at equal
   residues, so each suffix needs the rank of one cover sample.  Neighbours in
   that order with a common prefix of ``length`` bytes are repeated.
   Buckets of more than ``LARGE`` different segments are not gathered in one
   task: their windows are counted by 128-bit hash, again partially aggregated.
4. Spans go back to their texts by one join, and the bytes are cut out there.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.llm.common import attach, cut

LENGTH, GRAM = 200, 64
PIECE = 100_000  # bytes hashed at once: their hashes stay in a core's cache
BLOCK = 100_000  # bytes of a block of suffix buckets; a bucket is never cut
LARGE = 4000  # segments of a bucket: about a megabyte
ROOT = 8
MODULUS = ROOT * ROOT
#: Every difference modulo MODULUS is that of a number below ROOT and a multiple of ROOT.
COVER = sorted({*range(ROOT), *range(0, MODULUS, ROOT)})

_RNG = np.random.default_rng(20_251)
_VALUES = _RNG.integers(0, 1 << 64, (2, 256), np.uint64, endpoint=False)
_BASE = np.array([0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1], np.uint64)
_INVERSE = np.array([pow(int(b), -1, 1 << 64) for b in _BASE], np.uint64)
_POWERS: dict[tuple[int, int], np.ndarray] = {}


def powers(which: int, n: int, inverse: bool) -> np.ndarray:
    key = (which, inverse)
    if key not in _POWERS or len(_POWERS[key]) < n:
        base = np.full(max(n, 1 << 16), (_INVERSE if inverse else _BASE)[which], np.uint64)
        base[0] = 1
        _POWERS[key] = np.multiply.accumulate(base)
    return _POWERS[key][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    h ^= h >> np.uint64(32)
    return h


class Hashes:
    """Hashes of any substrings of some bytes, from prefix sums."""

    def __init__(self, data: np.ndarray, which: int):
        self.which = which
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[which][data] * powers(which, len(data), False), out=self.sums[1:])

    def all(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * powers(self.which, n, True))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * powers(self.which, len(self.sums), True)[start])


def segments(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, only_buckets: bool = False) -> tuple[np.ndarray, ...]:
    """Segments of texts laid end to end: (bucket, content's two hashes, first window, last window, minimizer's place).

    ``ends`` are the texts' ends.  Windows of one segment are consecutive, lie
    in one text and share their minimizer.
    """
    none = (np.zeros(0, np.uint64), np.zeros((2, 0), np.uint64)) + (np.zeros(0, np.int64),) * 3
    if len(data) < length:
        return none
    span = length - GRAM + 1  # GRAM-byte strings in a window
    first = Hashes(data, 0)
    grams = first.all(GRAM)
    place = np.uint64((1 << 24) - 1)
    low = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if span > width:
        low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
    at = (low & place).astype(np.int64)
    inside = np.zeros(len(at) + 1, np.int64)  # windows that run over a text's end don't count
    starts = np.r_[0, ends[:-1]]
    whole = ends - starts >= length
    np.add.at(inside, starts[whole], 1)
    np.add.at(inside, ends[whole] - length + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (at[1:] != at[:-1])
    text_starts = starts[whole]
    new[text_starts] = True
    lo = np.flatnonzero(new)
    if not len(lo):
        return none
    last = inside.copy()
    last[:-1] &= ~inside[1:] | new[1:]
    hi = np.flatnonzero(last)
    p = at[lo]
    if only_buckets:
        return grams[p], *none[1:]
    # where the minimizer lies in the segment belongs to its identity
    place = (grams[p] * np.uint64(3)) ^ ((p - lo).astype(np.uint64) << np.uint64(32)) ^ (hi - lo).astype(np.uint64)
    content = np.stack([mix(h.of(lo, hi + length) ^ place) for h in (Hashes(data, 1), first)])
    return grams[p], content, lo, hi, p


def pieces(texts: list[bytes], length: int = LENGTH):
    """(indexes, offset of the first one's bytes, data, ends): texts gathered, and long ones cut with overlap, to bounded pieces."""
    held, size = [], 0
    for i, t in enumerate(texts):
        if len(t) < length:
            continue
        if len(t) > PIECE:
            for s in range(0, len(t) - length + 1, PIECE):
                yield [i], s, [t[s:s + PIECE + length - 1]]
            continue
        if size + len(t) > PIECE and held:
            yield held, 0, [texts[k] for k in held]
            held, size = [], 0
        held.append(i)
        size += len(t)
    if held:
        yield held, 0, [texts[k] for k in held]


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).astype(np.uint64).view(np.int64))


def _rows(batches, length, only_buckets=False):
    for b in batches:
        rid, sid, texts = b.column(0).to_numpy(), b.column(1).to_numpy(), [t or b"" for t in b.column(2).to_pylist()]
        for which, offset, some in pieces(texts, length):
            data = np.frombuffer(b"".join(some), np.uint8)
            ends = np.cumsum([len(t) for t in some])
            bucket, content, lo, hi, p = segments(data, ends, length, only_buckets)
            if only_buckets:
                yield pa.RecordBatch.from_arrays([signed(bucket)], names=["bucket"])
                continue
            doc = np.searchsorted(ends, lo, "right")
            base = np.r_[0, ends[:-1]][doc] - offset
            row = np.array(which)[doc]
            yield pa.RecordBatch.from_arrays([signed(bucket), signed(content[0]), signed(content[1]), pa.array(rid[row]), pa.array(sid[row]), pa.array((lo - base).astype(np.int32)),
                                              pa.array((hi - base).astype(np.int32)), pa.array((p - base).astype(np.int32))], names=["bucket", "segment", "also", "rid", "sid", "lo", "hi", "p"])


ROWS = "bucket long, segment long, also long, rid long, sid long, lo int, hi int, p int"


def cover_ranks(data: np.ndarray, depth: int) -> np.ndarray:
    """At each position of the difference cover, the rank of its suffix's first ``depth`` bytes or more."""
    n = len(data)
    padded = np.r_[data, np.zeros(MODULUS, np.uint8)]
    at = np.flatnonzero(np.isin(np.arange(n) % MODULUS, COVER))
    keys = np.lib.stride_tricks.sliding_window_view(padded, MODULUS)[at]
    keys = np.ascontiguousarray(keys).view(">u8").astype(np.uint64).reshape(len(at), MODULUS // 8)
    order = np.lexsort(keys.T[::-1])
    rank = np.zeros(n + 1, np.int64)
    rank[at[order]] = np.cumsum(np.r_[1, (keys[order][1:] != keys[order][:-1]).any(1)]) if len(at) else 0
    reach = MODULUS
    while reach < depth:  # the suffix ``reach`` bytes on is in the cover too
        after = rank[np.minimum(at + reach, n)]
        order = np.lexsort((after, rank[at]))
        a, b = rank[at][order], after[order]
        rank = np.zeros(n + 1, np.int64)
        rank[at[order]] = np.cumsum(np.r_[1, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        reach *= 2
    return rank


NEXT_COVER = np.array([min((c - r) % MODULUS for c in COVER) for r in range(MODULUS)])


def repeated_windows(bucket: np.ndarray, shift: np.ndarray, texts: list[bytes], counts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Of each segment of a block, which of its first ``counts`` windows occur in another segment of the block; laid end to end.

    ``shift``: the minimizer's place in the segment.  Segments of a bucket are
    laid out with their minimizers at residue 0.
    """
    parts, begin, at = [], [], 0
    for s, t in zip(shift.tolist(), texts):
        pad = -(at + s) % MODULUS
        parts += [bytes(pad), t]
        begin.append(at + pad)
        at += pad + len(t)
    data = np.frombuffer(b"".join(parts) + bytes(length), np.uint8)
    rank = cover_ranks(data, length)
    which = np.repeat(np.arange(len(texts)), counts)
    window = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = np.array(begin)[which] + window
    word = np.zeros(len(data) - 7, np.uint64)  # the eight bytes at each place
    for k in range(8):
        word = word << np.uint64(8) | data[k:len(data) - 7 + k].astype(np.uint64)
    head = word[start]
    sample = rank[start + NEXT_COVER[start % MODULUS]]
    order = np.lexsort((sample, head, window - shift[which], bucket[which]))
    a, b = order[:-1], order[1:]
    close = (bucket[which[a]] == bucket[which[b]]) & (window[a] - shift[which[a]] == window[b] - shift[which[b]]) & (head[a] == head[b])
    tied = np.flatnonzero(close)
    for s in range(0, length, 8):  # the common prefix of the neighbours, eight bytes at a time
        s = min(s, length - 8)
        tied = tied[word[start[a[tied]] + s] == word[start[b[tied]] + s]]
    hit = np.zeros(len(start), bool)
    hit[a[tied]] = True
    hit[b[tied]] = True
    return hit


def runs(hit: np.ndarray, which: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of true values; a run ends where ``which`` changes."""
    first, last = hit.copy(), hit.copy()
    apart = ~hit[1:] | ~hit[:-1] | (False if which is None else which[1:] != which[:-1])
    first[1:] &= apart
    last[:-1] &= apart
    return np.flatnonzero(first), np.flatnonzero(last)


SPANS = "rid long, sid long, s int, e int"


def _sorted_blocks(batches, length):
    """Blocks of whole buckets from rows sorted by bucket: each is suffix-sorted by itself."""
    held: list[tuple] = []
    size = 0

    def done(rows):
        bucket, rid, sid, lo, shift, counts = (np.array([r[i] for r in rows], np.int64) for i in range(6))
        hit = repeated_windows(bucket, shift, [r[6] for r in rows], counts, length)
        which = np.repeat(np.arange(len(rows)), counts)
        first, last = runs(hit, which)
        at = which[first]
        base = lo[at] - (np.cumsum(counts) - counts)[at]
        return pa.RecordBatch.from_arrays([pa.array(rid[at]), pa.array(sid[at]), pa.array((base + first).astype(np.int32)), pa.array((base + last + length).astype(np.int32))], names=["rid", "sid", "s", "e"])

    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if size >= BLOCK and row[0] != held[-1][0]:
                yield done(held)
                held, size = [], 0
            held.append(row)
            size += len(row[6])
    if held:
        yield done(held)


def _window_hashes(batches, length):
    for b in batches:
        for _, rid, sid, lo, shift, n, text in zip(*(c.to_pylist() for c in b.columns)):
            data = np.frombuffer(text, np.uint8)
            h = [Hashes(data, k).all(length)[:n] for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([signed(h[0]), signed(h[1]), pa.array(np.full(n, rid)), pa.array(np.full(n, sid)), pa.array((lo + np.arange(n)).astype(np.int32))], names=["h", "g", "rid", "sid", "lo"])


MEMBER = "struct<bucket:long,lo:int,shift:int,n:int,kinds:long,bytes:binary>"


def _fields(lists: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """The structs in a column of lists, field by field, and the row that each is in."""
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), counts), [f.to_numpy(zero_copy_only=False) for f in lists.flatten().flatten()]


def _lists(row: np.ndarray, n: int, fields: list[pa.Array], kind: pa.DataType) -> pa.Array:
    """The reverse of ``_fields`` for ``n`` rows; ``row`` is ascending."""
    offsets = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, fields=list(kind.value_type)))


_SPAN_LIST = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
_MEMBERS = pa.list_(pa.struct([("bucket", pa.int64()), ("lo", pa.int32()), ("shift", pa.int32()), ("n", pa.int32()), ("kinds", pa.int64()), ("bytes", pa.binary())]))
_RESULT = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]


def _settle(batches, length):
    """Per text: the spans of settled segments, and the bytes of those still to be sorted."""
    for b in batches:
        n, texts = b.num_rows, [t or b"" for t in b.column(3).to_pylist()]
        row, (bucket, lo, hi, p, copies, kinds, wanted) = _fields(b.column(4))
        wanted = wanted.astype(bool)
        settled = copies > 1
        spans = row[settled], lo[settled], hi[settled] + length
        left = [x[wanted] for x in (bucket, lo, p - lo, hi - lo + 1, kinds)]
        content = [texts[r][s:e] for r, s, e in zip(row[wanted].tolist(), left[1].tolist(), (hi[wanted] + length).tolist())]
        open_ = np.bincount(row[wanted & ~settled], minlength=n) > 0
        columns = [pa.array(x, f.type) for x, f in zip([*left, content], _MEMBERS.value_type)]
        whole = [None if o else t for o, t in zip(open_, texts)]
        yield pa.RecordBatch.from_arrays([
            *b.columns[:3], _lists(spans[0], n, [pa.array(x, pa.int32()) for x in spans[1:]], _SPAN_LIST), _lists(row[wanted], n, columns, _MEMBERS),
            pa.array([t if o else None for o, t in zip(open_, texts)], pa.binary()), *_removed(whole, *spans)],
            names=["doc_id", "rid", "sid", "spans", "members", "text", *_RESULT])


SETTLED = f"doc_id long, rid long, sid long, spans array<struct<s:int,e:int>>, members array<{MEMBER}>, text binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def merged(row: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start, end) of the maximal runs covered by the rows' spans, in order."""
    order = np.lexsort((s, row))
    row, s, e = (x[order].astype(np.int64) for x in (row, s, e))
    base = row << 32  # the spans of all rows on one line, those of a row beyond all before it
    reach = np.maximum.accumulate(base + e)
    new = np.ones(len(row), bool)
    new[1:] = base[1:] + s[1:] > reach[:-1]
    last = np.ones(len(row), bool)
    last[:-1] = new[1:]
    return row[new], s[new], reach[last] - base[last]


def _removed(texts: list[bytes | None], row: np.ndarray, s: np.ndarray, e: np.ndarray) -> list[pa.Array]:
    """The columns of ``_RESULT`` of each text without its row's spans; null where the text is None."""
    row, s, e = merged(row, s, e)
    at = np.searchsorted(row, np.arange(len(texts) + 1)).tolist()
    s, e, out = s.tolist(), e.tolist(), []
    for i, t in enumerate(texts):
        if t is None:
            out.append((None,) * 4)
            continue
        kept, done, gone = hashlib.sha256(), 0, 0
        for k in range(at[i], at[i + 1]):
            kept.update(t[done:s[k]])
            done = e[k]
            gone += e[k] - s[k]
        kept.update(t[done:])
        out.append((len(t), gone, at[i + 1] - at[i], kept.hexdigest()))
    return [pa.array([r[k] for r in out], pa.string() if k == 3 else pa.int64()) for k in range(4)]


def _finish(batches):
    for b in batches:
        (r1, f1), (r2, f2) = _fields(b.column(2)), _fields(b.column(3))
        spans = np.r_[r1, r2], np.r_[f1[0], f2[0]], np.r_[f1[1], f2[1]]
        yield pa.RecordBatch.from_arrays([b.column(0), *_removed(b.column(1).to_pylist(), *spans)], names=["doc_id", *_RESULT])


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs`` (doc_id, text, ...).

    n_spans counts the maximal removed runs; kept_sha256 is of the bytes left.
    A null text is empty.  Repeated rows stay rows: from ``length`` bytes on
    they remove each other.  A null doc_id is kept as null.  An empty table
    gives no rows; other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    texts = texts.select("doc_id", F.xxhash64("doc_id", "text").alias("rid"), F.xxhash64(F.lit("also"), "text", "doc_id").alias("sid"), "text")
    counted = texts.select("rid", "sid", "text").mapInArrow(lambda bs: _rows(bs, length, only_buckets=True), "bucket long")
    shared = cut(counted.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("bucket"), "buckets")
    found = texts.select("rid", "sid", "text").mapInArrow(lambda bs: _rows(bs, length), ROWS)
    found = cut(found.join(shared, "bucket"), "shared-segments")

    place = F.xxhash64("rid", "sid", "lo")  # names one copy of a segment; copies that clash are both sorted, to no effect
    kinds = cut(found.groupBy("segment", "also").agg(F.min("bucket").alias("bucket"), F.count(F.lit(1)).alias("copies"), F.min(place).alias("first")), "segment-kinds")
    per_bucket = kinds.groupBy("bucket").agg(F.count(F.lit(1)).alias("kinds"))
    kinds = attach(kinds, per_bucket, "bucket", "kinds", max(kinds.count(), 1), ["kinds"]).select("segment", "also", "copies", "kinds", "first")
    marked = found.join(kinds, ["segment", "also"])  # rows of one segment are few beside all segments; a hot one is split by the adaptive skew join
    wanted = (F.col("kinds") > 1) & ((F.col("copies") == 1) | (F.col("first") == place))
    per_text = marked.groupBy("rid", "sid").agg(F.collect_set(F.struct("bucket", "lo", "hi", "p", F.col("copies").alias("n"), "kinds", wanted.alias("wanted"))).alias("found"))

    settled = texts.join(per_text, ["rid", "sid"], "left").select("doc_id", "rid", "sid", "text", "found")
    settled = cut(settled.mapInArrow(lambda bs: _settle(bs, length), SETTLED), "settled")
    members = settled.select("rid", "sid", F.explode("members").alias("m")).select("m.bucket", "rid", "sid", "m.lo", "m.shift", "m.n", "m.bytes", "m.kinds")
    small = members.where(F.col("kinds") <= LARGE).drop("kinds").repartition("bucket").sortWithinPartitions("bucket")
    spans = small.mapInArrow(lambda bs: _sorted_blocks(bs, length), SPANS)
    windows = members.where(F.col("kinds") > LARGE).drop("kinds").mapInArrow(lambda bs: _window_hashes(bs, length), "h long, g long, rid long, sid long, lo int")
    windows = cut(windows.select(F.struct("h", "g").alias("w"), "rid", "sid", "lo"), "windows")
    again = windows.groupBy("w").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    again = attach(windows, again, "w", "c", max(windows.count(), 1), ["c"]).where("c > 1")
    spans = spans.unionByName(again.select("rid", "sid", F.col("lo").alias("s"), (F.col("lo") + length).alias("e")))
    more = spans.groupBy("rid", "sid").agg(F.collect_set(F.struct("s", "e")).alias("more"))
    rest = settled.where("text is not null").select("rid", "sid", "doc_id", "text", "spans").join(more, ["rid", "sid"], "left").select("doc_id", "text", "spans", "more")
    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return settled.where("text is null").select("doc_id", *_RESULT).unionByName(rest.mapInArrow(_finish, result))
