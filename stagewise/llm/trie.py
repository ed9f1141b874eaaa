"""Prefix trie of conversations, by adaptive radix trees over turn ids.

A turn's id is fixed-width and big-endian: the first ``WIDTH`` bytes of the
SHA-256 of its role and text.  A conversation's key is its turns' ids, one after
the other, and an adaptive radix tree holds the keys: inner nodes grow from 4 to
16, 48 and 256 children, and a path without branches is kept in one node.  The
tree branches at any byte; only byte depths at the end of a turn are nodes of the
conversation trie.

On Spark: keys are sorted over range partitions, equal ones met and counted first, so
that no shared prefix and no group of copies is hot.  Each task builds one tree
for each ``BLOCK_BYTES`` of its sorted keys.  Nodes on the way to a block's first
or last key may go on in the blocks beside it; all others are whole and final.
The former meet in a last tree, over two keys a block.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.llm.common import cut

WIDTH = 16
BLOCK_BYTES, CHUNK_IDS = 2_000_000, 500
NONE = hashlib.sha256(b"").hexdigest()


class Sparse:
    """A layout of up to ``most`` children, found by a scan of their bytes."""

    __slots__ = ("most", "bytes", "kids")

    def __init__(self, most: int):
        self.most, self.bytes, self.kids = most, bytearray(), []

    def get(self, byte: int):
        at = self.bytes.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, kid) -> bool:
        """False if there is no room for another byte."""
        at = self.bytes.find(byte)
        if at >= 0:
            self.kids[at] = kid
            return True
        if len(self.kids) == self.most:
            return False
        self.bytes.append(byte)
        self.kids.append(kid)
        return True

    def items(self) -> list:
        return sorted(zip(self.bytes, self.kids), key=lambda x: x[0])


class Indexed:
    """A layout of up to 48 children, found through a table of 256 places."""

    __slots__ = ("at", "kids")

    def __init__(self):
        self.at, self.kids = bytearray(256), []

    def get(self, byte: int):
        at = self.at[byte]
        return self.kids[at - 1] if at else None

    def put(self, byte: int, kid) -> bool:
        if self.at[byte]:
            self.kids[self.at[byte] - 1] = kid
            return True
        if len(self.kids) == 48:
            return False
        self.kids.append(kid)
        self.at[byte] = len(self.kids)
        return True

    def items(self) -> list:
        return [(b, self.kids[at - 1]) for b, at in enumerate(self.at) if at]


class Full:
    """A layout with a place for each byte."""

    __slots__ = ("kids",)

    def __init__(self):
        self.kids = [None] * 256

    def get(self, byte: int):
        return self.kids[byte]

    def put(self, byte: int, kid) -> bool:
        self.kids[byte] = kid
        return True

    def items(self) -> list:
        return [(b, kid) for b, kid in enumerate(self.kids) if kid is not None]


class Node:
    """``path``: the bytes that all keys below share after the branching byte; ``end``: the key that
    ends here; ``some``: a key that goes through."""

    __slots__ = ("path", "end", "some", "layout")

    def __init__(self, path: bytes, end: int | None, some: int):
        self.path, self.end, self.some, self.layout = path, end, some, None

    def put(self, byte: int, kid: Node) -> None:
        if self.layout is None:
            self.layout = Sparse(4)
        while not self.layout.put(byte, kid):
            old = self.layout
            self.layout = Sparse(16) if isinstance(old, Sparse) and old.most == 4 else Indexed() if isinstance(old, Sparse) else Full()
            for b, k in old.items():
                self.layout.put(b, k)


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] agrees, a[:high] doesn't
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
    return low


class Tree:
    """An adaptive radix tree over distinct keys; a key may be a prefix of another."""

    def __init__(self):
        self.root = Node(b"", None, 0)

    def insert(self, key: bytes, value: int) -> None:
        node, at = self.root, 0
        while True:
            n = common(node.path, key[at:at + len(node.path)])
            if n < len(node.path):
                low = Node(node.path[n + 1:], node.end, node.some)
                low.layout, node.layout = node.layout, None
                branch, node.path, node.end = node.path[n], node.path[:n], None
                node.put(branch, low)
            at += n
            if at == len(key):
                node.end = value
                return
            kid = node.layout.get(key[at]) if node.layout else None
            if kid is None:
                node.put(key[at], Node(key[at + 1:], value, value))
                return
            node, at = kid, at + 1

    def turns(self, width: int):
        """(parent, depth, some key, key that ends here or None) of each turn-aligned place, parents
        first, by key; the first is the root."""
        out = []
        stack = [(self.root, 0, 0, -1)]  # a node, the bytes before its path, those up to its branching byte, the turn node above
        while stack:
            node, before, at, top = stack.pop()
            stop = at + len(node.path)
            if not out:
                out.append([-1, 0, node.some, None])
                top = 0
            for depth in range(before // width + 1, stop // width + 1):
                out.append([top, depth, node.some, None])
                top = len(out) - 1
            if node.end is not None:
                out[top][3] = node.end
            if node.layout:
                stack += [(kid, stop, stop + 1, top) for _, kid in reversed(node.layout.items())]
        return out


NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_AT = "side long, up long"  # where the parent is: on the way to a block's first (0) or last (1) key, at this depth
_EDGE = "key binary, words array<long>, n array<long>, least array<long>, kids array<long>, leaves array<long>, saved array<long>, ends array<string>"
ROWS = f"block long, {NODE}, {_AT}, {_EDGE}"
_TYPES = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def table(rows: list[dict], ddl: str) -> pa.RecordBatch:
    fields = [f.strip().split(" ", 1) for f in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(name) for r in rows], _TYPES[kind]) for name, kind in fields], names=[name for name, _ in fields])


def block_rows(block: int, keys: list[bytes], words: list[list[int]], counts: list[int], firsts: list[int], ends: list[str], width: int) -> list[dict]:
    """The whole nodes of a block of sorted distinct keys, and its edges."""
    tree = Tree()
    for k, key in enumerate(keys):
        tree.insert(key, k)
    nodes = tree.turns(width)
    edges = []  # the ways to the first and the last key, from the root
    for key in {0: 0, len(keys) - 1: 0}:
        at = next(i for i, x in enumerate(nodes) if x[3] == key)
        way = []
        while at >= 0:
            way.append(at)
            at = nodes[at][0]
        edges.append(way[::-1])
    place = {i: (side, depth) for side in reversed(range(len(edges))) for depth, i in enumerate(edges[side])}
    size = len(nodes)
    n, kids, leaves, saved, least = [0] * size, [0] * size, [0] * size, [0] * size, [None] * size
    sha = [NONE] * size
    for i, x in enumerate(nodes):
        if x[3] is not None:
            n[i], least[i], sha[i] = counts[x[3]], firsts[x[3]], ends[x[3]]
    for i in range(size - 1, -1, -1):
        up, depth, some, _ = nodes[i]
        if i not in place:
            leaves[i] += not kids[i]
            saved[i] += (n[i] - 1) * words[some][depth - 1]
            leaves[up] += leaves[i]
            saved[up] += saved[i]
            kids[up] += 1
        if i:
            n[up] += n[i]
            least[up] = least[i] if least[up] is None else min(least[up], least[i])
    out = []
    for i, (up, depth, _, _) in enumerate(nodes):
        if i not in place:
            row = {"block": block, "conv_id": least[i], "depth": depth, "n_convs": n[i], "n_children": kids[i], "n_leaves": leaves[i], "saved_tokens": saved[i], "ends_sha256": sha[i]}
            out.append(row | (dict(zip(("side", "up"), place[up])) if up in place else {"parent_conv_id": least[up]}))
    for side, way in enumerate(edges):
        # what both ways share counts once, with the first
        own = [place[i][0] == side for i in way]
        some = nodes[way[-1]][3]
        pick = lambda v, none=0: [v[i] if mine else none for i, mine in zip(way, own)]
        out.append({"block": block, "side": side, "key": keys[some], "words": [0, *words[some]], "n": pick(n), "least": pick(least, None), "kids": pick(kids),
                    "leaves": pick(leaves), "saved": pick(saved), "ends": pick(sha, NONE)})
    return out


def edge_rows(edges: list[dict], width: int) -> list[dict]:
    """The nodes on the edges of all blocks, and at which depth of which edge they are."""
    if not edges:
        return []
    tree, keys = Tree(), {}
    for e in edges:
        if e["key"] not in keys:
            keys[e["key"]] = len(keys)
            tree.insert(e["key"], keys[e["key"]])
    nodes = tree.turns(width)
    place = {x[3]: i for i, x in enumerate(nodes) if x[3] is not None}
    size = len(nodes)
    n, kids, leaves, saved, least, words = [0] * size, [0] * size, [0] * size, [0] * size, [None] * size, [0] * size
    sha, ways = [NONE] * size, []
    for e in edges:
        i = place[keys[e["key"]]]
        for depth in range(len(e["n"]) - 1, -1, -1):
            n[i] += e["n"][depth]
            kids[i] += e["kids"][depth]
            leaves[i] += e["leaves"][depth]
            saved[i] += e["saved"][depth]
            words[i] = e["words"][depth]
            if e["least"][depth] is not None:
                least[i] = e["least"][depth] if least[i] is None else min(least[i], e["least"][depth])
            if e["ends"][depth] != NONE:
                sha[i] = e["ends"][depth]
            ways.append((e["block"], e["side"], depth, i))
            i = nodes[i][0]
    for i in range(size - 1, -1, -1):
        up = nodes[i][0]
        leaves[i] += not kids[i]
        saved[i] += (n[i] - 1) * words[i]
        if i:
            kids[up] += 1
            leaves[up] += leaves[i]
            saved[up] += saved[i]
    out = [{"kind": 0, "conv_id": least[i], "depth": depth, "parent_conv_id": least[up] if i else None, "n_convs": n[i], "n_children": kids[i], "n_leaves": leaves[i], "saved_tokens": saved[i],
            "ends_sha256": sha[i]} for i, (up, depth, _, _) in enumerate(nodes)]
    return out + [{"kind": 1, "block": b, "side": side, "up": depth, "conv_id": least[i]} for b, side, depth, i in ways]


def prefix_trie(convs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The nodes of the trie over ``convs`` (conv_id long, key binary, words array<long>), a row a node.

    ``key`` is a sequence of turn ids of ``width`` bytes each, ``words`` the
    number of words of each.  A node is a distinct sequence of first ids, from the
    empty one; its members are the rows whose key starts with it.  Columns:
    ``conv_id`` its smallest member, ``depth``, ``parent_conv_id`` (root: null),
    ``n_convs`` members, ``n_children``, ``n_leaves`` childless nodes in its
    subtree, itself included; ``saved_tokens`` the sum over its subtree of
    (n_convs - 1) * words of the node's last turn; ``ends_sha256`` the SHA-256 of
    the comma-joined ids, ascending, of the members that end there.  Repeated
    conv_ids are members each.  No rows give no node, not even a root.  A key is
    ``width`` bytes a turn and is held whole by a task.
    """
    def chunks(batches):
        """Rows sorted by (key, conv_id) -> of each key, its ids as text, CHUNK_IDS of them a row."""
        for b in batches:
            keys, ids = b.column(1).to_pylist(), b.column(0).to_pylist()
            heads = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
            cuts = [i for h, e in zip(heads, [*heads[1:], len(keys)]) for i in range(h, e, CHUNK_IDS)]
            spans = list(zip(cuts, [*cuts[1:], len(keys)]))
            yield pa.RecordBatch.from_arrays([pa.array([keys[s] for s, _ in spans], pa.binary()), b.column(2).take(pa.array([s for s, _ in spans], pa.int64())),
                                              pa.array([ids[s] for s, _ in spans], pa.int64()), pa.array([e - s for s, e in spans], pa.int64()),
                                              pa.array([",".join(map(str, ids[s:e])) for s, e in spans], pa.string())], names=["key", "words", "first", "n", "ids"])

    def blocks(batches):
        """Chunks sorted by (key, first) -> the nodes of each block of keys."""
        number = TaskContext.get().partitionId() << 32
        keys, words, counts, firsts, hashes, size = [], [], [], [], [], 0
        for b in batches:
            for key, w, first, n, ids in zip(*(c.to_pylist() for c in b.columns)):
                if keys and keys[-1] == key:
                    counts[-1] += n
                    hashes[-1].update(b"," + ids.encode())
                    continue
                if keys and size >= BLOCK_BYTES:
                    yield table(block_rows(number, keys, words, counts, firsts, [h.hexdigest() for h in hashes], width), ROWS)
                    number += 1
                    keys, words, counts, firsts, hashes, size = [], [], [], [], [], 0
                keys.append(key)
                words.append(w)
                counts.append(n)
                firsts.append(first)
                hashes.append(hashlib.sha256(ids.encode()))
                size += len(key) + 100
        if keys:
            yield table(block_rows(number, keys, words, counts, firsts, [h.hexdigest() for h in hashes], width), ROWS)

    def edges(batches):
        held = [r for b in batches for r in b.to_pylist()]
        yield table(edge_rows(held, width), EDGES)

    EDGES = f"kind long, block long, {NODE}, {_AT}"
    rows = convs.select(F.col("conv_id").cast("long"), "key", F.col("words").cast("array<long>")).where("conv_id is not null and key is not null")
    rows = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    parts = cut(rows.mapInArrow(chunks, "key binary, words array<long>, first long, n long, ids string"), "trie-keys")
    # the SHA-256 of a key's members has one order, so a key is in one partition: a row for each CHUNK_IDS members
    whole = cut(parts.repartitionByRange("key").sortWithinPartitions("key", "first").mapInArrow(blocks, ROWS), "trie-blocks")
    last = cut(whole.where("key is not null").select("block", "side", *[f.split(" ")[0] for f in _EDGE.split(", ")]).repartition(1).mapInArrow(edges, EDGES), "trie-edges")
    names = [f.split(" ")[0] for f in NODE.split(", ")]
    inner = whole.where("key is null and side is null").select(*names)
    up = last.where("kind = 1").select("block", "side", "up", F.col("conv_id").alias("_up"))
    # a key of this join has no more rows than one block
    below = whole.where("key is null and side is not null").join(up, ["block", "side", "up"]).withColumn("parent_conv_id", F.col("_up")).select(*names)
    return inner.unionByName(below).unionByName(last.where("kind = 0").select(*names))


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns) of every conversation: its turns in order, as (id binary, words long).

    The order is by turn, null first; of one turn number, by the turn's id.  Null
    roles and texts are empty.  Rows without a conv_id belong to no conversation.
    Texts stay where they are: only ids and counts are gathered.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turn = F.struct(F.col("turn"), F.unhex(F.substring(said, 1, 2 * WIDTH)).alias("id"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns")).select("conv_id", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


def keyed(seqs: DataFrame) -> DataFrame:
    """(conv_id, key, words) of ``seqs`` (conv_id, turns)."""
    key = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), ""))
    return seqs.select("conv_id", key.alias("key"), F.col("turns.words").alias("words"))


def shared_openings(seqs: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """``seqs`` rebuilt: conversation c opens with the first h turns of c - c % group, then has its own
    turns after its first h; h is crc32(c as text) % most."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % group
    seqs = cut(seqs, "sequences")
    heads = seqs.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most).alias("_head"))
    own = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    head = F.slice(F.coalesce("_head", F.array().cast(seqs.schema["turns"].dataType)), F.lit(1), h)
    joined = seqs.withColumn("_base", base).join(heads, "_base", "left")
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of ``conversations`` (conv_id, turn, role, text, ...) as they are; see ``prefix_trie``.

    Other columns are not read; an empty table gives no rows.
    """
    return prefix_trie(keyed(sequences(conversations)))
