"""SimHash near-duplicates with pigeonring candidate filtering.

A text's words are runs outside ``[\\x20\\x09-\\x0D]`` after lower-casing A-Z;
its shingles are ``shingle`` consecutive words joined by a space (fewer words:
the whole sequence).  A fingerprint bit is 1 if it is set in over half of the
shingles' XXH64 (seed 42).  Texts link at ``distance`` or fewer differing bits.

Candidates come from the pigeonring principle.  The 64 bits form a ring of
``distance + 1`` segments.  If two fingerprints differ in at most t bits, some
start on the ring has every chain of l segments from there differing in at most
``l * t / m`` bits.  So the first segment is equal, and the next two differ in
at most two bits together: cut into four parts, two of them are equal.  Each
fingerprint is keyed by its start, its first segment and each pair of parts;
in a key's group chains of one, two, three ... segments are checked in turn, each
only for what the shorter ones left, and the full distance last.  Groups emit a spanning forest of their links, never all pairs.
A key of over ``CROWD`` members is no group: the bits it leaves open are cut into
``distance + 1`` parts, of which a linked pair has one equal, and its members
are keyed again by each part, ``AGAIN`` times at most: far members part 256-fold
each time, and near ones are reached by few steps of the forest.
"""

from __future__ import annotations

from collections import deque
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.llm.common import attach, cut, plus, text_bytes
from stagewise.llm.graph import components

PARTS, EQUAL_PARTS = 4, 2
CROWD, AGAIN = 30_000, 2  # members of a key that are compared without keying them again


def fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return int.from_bytes(xxhash.xxh64_digest(line, 42), "big")
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-shingle].tolist()]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[s:e], 42) for s, e in zip(starts, (ends[shingle - 1:] - 1).tolist())])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.uint32) * 2 > len(bits)
    return int.from_bytes(np.packbits(ones).tobytes(), "big")


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, fp long) of every row; null and wordless texts have fingerprint zero."""
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in text_bytes(b.column(1))], np.uint64)
            yield pa.record_batch([b.column(0), pa.array(signed(fps))], names=["doc_id", "fp"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of the ring's segments."""
    m = distance + 1
    edges = [64 * i // m for i in range(m + 1)]
    return [(edges[i], edges[i + 1] - edges[i]) for i in range(m)]


def _bits(fp: np.ndarray, first: int, width: int) -> np.ndarray:
    return (fp >> np.uint64(first)) & np.uint64((1 << width) - 1)


def keys(fp: np.ndarray, distance: int) -> list[np.ndarray]:
    """The pigeonring keys of each fingerprint, one array per (start, pair of parts)."""
    segs, out = segments(distance), []
    for i in range(len(segs)):
        chain = [segs[(i + j) % len(segs)] for j in range(min(3, len(segs)))]
        head = _bits(fp, *chain[0])
        rest = [(s + k, 1) for s, w in chain[1:] for k in range(w)]
        budget = 3 * distance // len(segs)  # of the chain of three
        if len(chain) < 3 or budget > PARTS - EQUAL_PARTS:
            out.append(head | np.uint64(i << 58))
            continue
        edges = [len(rest) * p // PARTS for p in range(PARTS + 1)]
        parts = []
        for p in range(PARTS):
            v = np.zeros_like(fp)
            for k, (s, _) in enumerate(rest[edges[p]:edges[p + 1]]):
                v |= _bits(fp, s, 1) << np.uint64(k)
            parts.append((v, edges[p + 1] - edges[p]))
        for c, pair in enumerate(combinations(range(PARTS), EQUAL_PARTS)):
            v, at = head, chain[0][1]
            for p in pair:
                v, at = v | parts[p][0] << np.uint64(at), at + parts[p][1]
            out.append(v | np.uint64((i << 3 | c) << 55))
    return out


def open_bits(distance: int) -> dict[int, int]:
    """By a key's top nine bits (its start and pair), the fingerprint bits that it doesn't hold, as a mask."""
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    none = keys(np.zeros(1, np.uint64), distance)
    return {int(z[0] >> np.uint64(55)): int(np.bitwise_or.reduce(one[k == z[0]])) for k, z in zip(keys(one, distance), none)}


def parts_of(mask: int, distance: int) -> list[int]:
    """The bits of ``mask`` in ``distance + 1`` parts; a part that few bits leave empty is zero."""
    places = [b for b in range(64) if mask >> b & 1]
    return [sum(1 << int(b) for b in part) for part in np.array_split(places, distance + 1)]


def keyed_again(key: np.ndarray, fp: np.ndarray, mask: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, key, open bits) of each row once for each part of its open bits."""
    out = []
    for m in np.unique(mask):
        at = np.flatnonzero(mask == m)
        for j, part in enumerate(parts_of(int(m), distance)):
            h = key[at] * np.uint64(0x9E3779B97F4A7C15) + (fp[at] & np.uint64(part)) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(j)
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)  # keys that clash only share a group
            out.append((at, h ^ (h >> np.uint64(29)), np.full(len(at), m & ~np.uint64(part), np.uint64)))
    return out


def within(x: np.ndarray, distance: int) -> np.ndarray:
    """Which differences ``x`` pass the chain budgets from some start, then the full distance."""
    segs = segments(distance)
    m = len(segs)
    ok = np.zeros(x.shape, bool)
    for i in range(m):
        left = np.flatnonzero(~ok)
        total = np.zeros(len(left), np.uint8)
        for n in range(1, m):
            total = total + np.bitwise_count(_bits(x[left], *segs[(i + n - 1) % m]))
            good = total <= n * distance // m
            left, total = left[good], total[good]
            if not len(left):
                break
        ok[left] = True
    passed = np.flatnonzero(ok)
    ok[passed] = np.bitwise_count(x[passed]) <= distance
    return ok


def forest(fp: np.ndarray, rep: np.ndarray, distance: int) -> tuple[list, list]:
    """Links that connect what is linked within one group; each member is reached once."""
    left, right = [], []
    rest = np.arange(len(fp))
    while len(rest) > 1:
        queue, rest = deque([rest[0]]), rest[1:]
        while queue and len(rest):
            u = queue.popleft()
            near = within(fp[rest] ^ fp[u], distance)
            hit = rest[near]
            if len(hit):
                left.append(np.full(len(hit), rep[u]))
                right.append(rep[hit])
                queue.extend(hit)
                rest = rest[~near]
    return left, right


def _group_links(key: np.ndarray, fp: np.ndarray, rep: np.ndarray, distance: int, small: int = 24) -> tuple[np.ndarray, np.ndarray]:
    left, right = [], []
    cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
    starts, ends = np.r_[0, cuts], np.r_[cuts, len(key)]
    size = np.repeat(ends - starts, ends - starts)
    for d in range(1, small):
        at = np.flatnonzero((size[d:] <= small) & (size[d:] > d) & (key[d:] == key[:-d]))
        if not len(at):
            break
        at = at[within(fp[at] ^ fp[at + d], distance)]
        left.append(rep[at])
        right.append(rep[at + d])
    for s, e in zip(starts, ends):
        if e - s > small:
            x, y = forest(fp[s:e], rep[s:e], distance)
            left += x
            right += y
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def links(nodes: DataFrame, distance: int) -> DataFrame:
    """(a, b) representatives whose fingerprints differ in at most ``distance`` bits, as a
    spanning set: the connected components are those of all such links."""
    held, kinds = open_bits(distance), len(keys(np.zeros(1, np.uint64), distance))

    def key_rows(batches):
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            all_keys = keys(fp, distance)
            yield pa.record_batch([pa.array(signed(np.concatenate(all_keys))), pa.array(np.tile(fp.view(np.int64), len(all_keys))),
                                   pa.array(np.tile(b.column(1).to_numpy(), len(all_keys)))], names=["key", "fp", "rep"])

    def split_rows(batches):
        for b in batches:
            key, fp = (b.column(i).to_numpy().view(np.uint64) for i in range(2))
            mask = b.column(3).to_numpy(zero_copy_only=False).view(np.uint64) if b.num_columns > 3 else np.array([held[k] for k in (key >> np.uint64(55)).tolist()], np.uint64)
            for at, again, left in keyed_again(key, fp, mask, distance):
                yield pa.RecordBatch.from_arrays([pa.array(signed(again)), pa.array(fp[at].view(np.int64)), b.column(2).take(pa.array(at)), pa.array(signed(left))], names=["key", "fp", "rep", "mask"])

    rows = nodes.select("fp", "rep").mapInArrow(key_rows, "key long, fp long, rep long")
    total = max(1, kinds * nodes.count())
    out = None
    for level in range(AGAIN + 1):
        crowded = cut(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD), "crowded") if level < AGAIN else None
        done = crowded is None or crowded.isEmpty()
        marked = rows if done else attach(rows, crowded, "key", "n", total, ["n"])
        more = _links_of(marked if done else marked.where("n is null"), distance)
        out = more if out is None else out.unionByName(more)
        if done:
            break
        rows = cut(marked.where("n is not null").drop("n").mapInArrow(split_rows, "key long, fp long, rep long, mask long"), "keyed-again")
        total = max(1, rows.count())
    return out


def _links_of(rows: DataFrame, distance: int) -> DataFrame:
    """The links within the groups of one key."""
    def link_rows(batches):
        held = [np.zeros(0, np.int64)] * 3
        for b in _with_end(batches):
            if b is not None:
                held = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, b.columns)]
            key = held[0]
            # rows of the last key may go on in the next batch
            done = len(key) if b is None else int(np.searchsorted(key, key[-1])) if len(key) else 0
            if done:
                x, y = _group_links(key[:done], held[1][:done].view(np.uint64), held[2][:done], distance)
                pair = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1), axis=0)
                yield pa.record_batch([pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["a", "b"])
                held = [h[done:] for h in held]
    return rows.select("key", "fp", "rep").repartition("key").sortWithinPartitions("key").mapInArrow(link_rows, "a long, b long")


def _with_end(batches):
    yield from (b for b in batches if b.num_rows)
    yield None


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id, n_copies) of every row of ``docs`` (doc_id, text, ...).

    component_id is the smallest doc_id reachable by links of at most
    ``distance`` bits; n_copies counts the rows with the same fingerprint.
    Rows with one doc_id are one document: its texts are linked, whatever their
    distance.  Null and wordless texts have fingerprint zero and link like any
    other.  Repeated rows stay.  A null doc_id takes its fingerprint's component
    but never names or links one; if no row of a component has an id,
    component_id is null.  An empty table gives no rows; other columns are not read.
    """
    fps = cut(fingerprints(docs, shingle), "fingerprints")
    total = max(1, fps.count())
    classes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "classes")
    roots = components(links(_nodes(classes), distance).unionByName(_id_links(fps, total)))
    nodes = _rooted(classes, roots)
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    nodes = cut(nodes.join(least, "root").select("fp", "n", "component_id", F.col("n").alias("n_copies")), "components")
    out = attach(fps, nodes, "fp", "n", total, ["component_id", "n_copies"])
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_copies")


def _nodes(classes: DataFrame) -> DataFrame:
    """A fingerprint is its own node."""
    return classes.select("fp", F.col("fp").alias("rep"))


def _rooted(classes: DataFrame, roots: DataFrame) -> DataFrame:
    found = roots.select(F.col("node").alias("fp"), "root")
    return classes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def _id_links(fps: DataFrame, total: int) -> DataFrame:
    """(a, b): the fingerprints of one doc_id, each linked to the smallest."""
    several = fps.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("top"), F.count(F.lit(1)).alias("n")).where("a < top")
    met = attach(fps.where(F.col("doc_id").isNotNull()), cut(several, "several"), "doc_id", "n", total, ["a"])
    return met.where("a < fp").select("a", F.col("fp").alias("b")).distinct()


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """``docs`` with one row of each group of near-duplicate texts: the smallest doc_id, then the smallest
    hash of the row; all columns stay.

    Groups are by text alone: rows that share a doc_id but not their texts are
    different documents, and each keeps its place.  Rows without an id come after
    those with one.  Of rows alike in every column one stays.  Null and wordless texts are one group.  An empty
    table gives no rows.
    """
    first, second = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), F.xxhash64(F.lit("second"), *[F.col(f"`{c}`") for c in docs.columns])
    text = F.col("text").cast("string").alias("text")
    rows = docs.select(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("id"), first.alias("h1"), second.alias("h2")).alias("row"), text)

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in text_bytes(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(signed(fps))], names=["row", "fp"])
    fps = rows.mapInArrow(run, plus(rows.select("row").schema, "fp long"))
    classes = cut(fps.groupBy("fp").agg(F.min("row").alias("row")), "classes")
    nodes = _rooted(classes, components(links(_nodes(classes), distance)))
    chosen = cut(nodes.groupBy("root").agg(F.min("row").alias("row")).select(F.col("row.h1").alias("_h1"), F.col("row.h2").alias("_h2")), "chosen")
    marked = docs.withColumns({"_h1": first, "_h2": second})
    return marked.join(chosen, ["_h1", "_h2"], "left_semi").dropDuplicates(["_h1", "_h2"]).select(*[F.col(f"`{c}`") for c in docs.columns])
