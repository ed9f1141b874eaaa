"""SentencePiece encoding and decoding by Viterbi over a trie of distinct words.

A text is split at spaces; every word is marked in front by U+2581 and encoded
by itself, so that joining the pieces and turning marks into spaces gives the
text back.  A task gathers the distinct marked words of the texts it holds and
sorts them: a sorted list is a trie in depth-first order, and a word starts
from the forward scores of the prefix it shares with the one before.  Pieces
and scores come from a public SentencePiece model (a path); characters that no
piece covers, and a mark inside a word, become byte pieces.  The default model is a
byte-pair one, whose scores are merge ranks: Viterbi takes the pieces with the best
sum of them, which are often not the ones that merging in order would give.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.llm.common import chunks, plus

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
SHARD_BYTES, KEPT_WORDS = 4_000_000, 400_000
MISSING = -1e18


class Pieces:
    """The pieces of a model with scores and ids, and the 256 byte pieces."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.text = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.byte = [-1] * len(self.text)
        self.of_byte = [0] * 256
        self.score: dict[str, tuple[float, int]] = {}
        for i, p in enumerate(self.text):
            if sp.is_byte(i):
                self.byte[i] = int(p[3:5], 16)
                self.of_byte[self.byte[i]] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or MARK in p[1:]) and (sp.get_score(i) > -1e8 or p == MARK):
                self.score[p] = (sp.get_score(i), i)
        least = min(s for s, _ in self.score.values() if s > -1e8)
        self.byte_score = least - 10.0
        # the mark by itself is always a piece, and never spelled in bytes: a mark in bytes is a character of the text
        self.mark = sp.piece_to_id(MARK)
        self.score[MARK] = (max(self.score.get(MARK, (least, 0))[0], least), self.mark)
        # the pieces as a trie from their last character: [what may come before, score, id or -1]
        self.before: dict[str, list] = {}
        for p, (score, i) in self.score.items():
            level = self.before
            for c in reversed(p):
                node = level.setdefault(c, [{}, MISSING, -1])
                level = node[0]
            node[1:] = score, i
        #: what a piece stands for, the mark as a space
        self.spells = pa.array([bytes([b]) if b >= 0 else p.replace(MARK, " ").encode() for p, b in zip(self.text, self.byte)], pa.binary())

    def encode_words(self, words: list[str]) -> dict[str, np.ndarray]:
        """Ids of each marked word (its mark in front)."""
        return {w: np.frombuffer(ids, np.int32) for w, ids in self.packed(words).items()}

    def packed(self, words: list[str]) -> dict[str, bytes]:
        """The ids of ``encode_words`` as bytes; shares forward scores along the sorted list."""
        out: dict[str, bytes] = {}
        best, back, piece = [0.0], [0], [0]  # the score of the best way to each place; where it comes from, by which piece
        before, byte_score, last = self.before, self.byte_score, ""
        for w in sorted(words):
            n = 0
            for x, y in zip(last, w):
                if x != y:
                    break
                n += 1
            del best[n + 1:], back[n + 1:], piece[n + 1:]
            marks = MARK in w[1:]
            for i in range(n + 1, len(w) + 1):
                top, where, by = MISSING, 0, 0
                level, j = before, i
                while j:
                    j -= 1
                    node = level.get(w[j])
                    if node is None or (marks and j and w[j] == MARK):  # no piece goes over a mark inside the word
                        break
                    level, score, found = node
                    if found >= 0 and best[j] + score > top:
                        top, where, by = best[j] + score, j, found
                if i > 1:
                    c = w[i - 1]
                    spelled = best[i - 1] + byte_score * (1 if c < "\x80" else len(c.encode()))
                    if spelled > top:
                        top, where, by = spelled, i - 1, -1
                best.append(top)
                back.append(where)
                piece.append(by)
            ids, i = [], len(w)
            while i:
                j, by = back[i], piece[i]
                if by < 0:
                    ids += [self.of_byte[c] for c in reversed(w[j:i].encode())]
                else:
                    ids.append(by)
                i = j
            ids.reverse()
            out[w] = array("i", ids).tobytes()
            last = w
        return out

    def spell(self, ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """The bytes that runs of ``ids`` of the given sizes stand for, the mark as a space."""
        offsets = np.cumsum(np.r_[0, sizes]).astype(np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), self.spells.take(pa.array(ids))), b"")

    def decode(self, ids) -> str:
        parts: list[bytes] = []
        for i in ids:
            b = self.byte[i]
            parts.append(bytes([b]) if b >= 0 else self.text[i].replace(MARK, " ").encode())
        return b"".join(parts).decode()[1:] if parts else ""


def marked(text: str) -> list[str]:
    return [MARK + w for w in text.split(" ")]


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, ids, n_pieces, round_trip) of every row of ``docs`` (doc_id, text, ...).

    ``round_trip``: decoding the ids gives the text.  A null text has no ids,
    an empty one the mark alone; both decode to the empty text.  Texts are
    encoded whole; repeated rows one by one.  The model's pieces (a bounded
    list) are broadcast, so only the driver reads the file.  An empty table
    gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Pieces(model))

    def run(batches):
        pieces = shared.value
        known: dict[str, bytes] = {}
        for held in chunks(batches, "text", SHARD_BYTES):
            if len(known) > KEPT_WORDS:
                known = {}
            text = pa.concat_arrays([b.column(1) for b in held])
            parts = pc.split_pattern(text, " ")
            coded = parts.flatten().dictionary_encode()
            distinct = [MARK + w for w in coded.dictionary.to_pylist()]
            known.update(pieces.packed([w for w in distinct if w not in known]))
            # each distinct word is encoded, and its round trip checked, once; a text is its words' pieces, one after the other
            spelled = [known[w] for w in distinct]
            size = np.array([len(x) for x in spelled], np.int64) // 4
            start = np.cumsum(size) - size
            pool = np.frombuffer(b"".join(spelled), np.int32)
            good = pc.equal(pieces.spell(pool, size), pa.array([" " + w[1:] for w in distinct], pa.string()).cast(pa.binary())).to_numpy(zero_copy_only=False)
            which = coded.indices.to_numpy()
            n = size[which]
            first = np.cumsum(n) - n
            flat = pool[np.arange(int(n.sum())) - np.repeat(first, n) + np.repeat(start[which], n)]
            words = np.cumsum(np.r_[0, pc.fill_null(pc.list_value_length(parts), 0).to_numpy()])
            ends = np.r_[0, np.cumsum(n)][words]
            bad = np.r_[0, np.cumsum(~good[which])][words]
            at = 0
            for b in held:
                mine = ends[at:at + b.num_rows + 1]
                ids = pa.ListArray.from_arrays(pa.array((mine - mine[0]).astype(np.int32)), pa.array(flat[mine[0]:mine[-1]]))
                ok = np.diff(bad[at:at + b.num_rows + 1]) == 0
                yield pa.RecordBatch.from_arrays([b.column(0), ids, pa.array(np.diff(mine)), pa.array(ok)], names=["doc_id", "ids", "n_pieces", "round_trip"])
                at += b.num_rows

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, plus(rows.select("doc_id").schema, "ids array<int>, n_pieces long, round_trip boolean"))


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) of every row of ``encoded`` (doc_id, ids, ...); null or no ids give the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(Pieces(model))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shared.value.decode(x or []) for x in b.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])
    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(run, plus(rows.select("doc_id").schema, "text string"))
