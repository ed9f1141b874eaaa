"""PII surrogates: keyed, type-consistent replacements of detected entities.

Every entity's surrogate is a keyed permutation of the strings of its format:
a Feistel network over its letters and digits, in mixed radix, whose rounds
are HMACs.  So equal entities get equal surrogates in all documents without a
table (coreference), and different ones of a format can't collide
(distinctness).  Separators, case, length, script, country codes, check
digits, top-level domains and the gender of known given names stay.
``collisions`` checks the surrogates that were really given, over all
documents; entities that would share one get another key (``settle``).

Of a PEM private key the body is replaced, up to its END line (without one,
the base64 lines that follow).  Values of password keys are replaced with or
without digits, those of token and key names only with one.  Persons are found
after a form of address of ``ADDRESSED`` or by a given name of ``NAMES`` before
another name; names without either stay.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections import OrderedDict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.llm.common import cut, plus

KEY = b"stagewise-surrogates"
ROUNDS, TURNS = 8, 8

# Given names by gender and script, and forms of address.
NAMES = {
    ("f", "latin"): "Anna Maria Emma Julia Laura Sarah Sophie Claire Marie Elena Lucia Carmen Ingrid Helga Petra Alice Grace Emily Nora Isabel".split(),
    ("m", "latin"): "John James Peter Paul Thomas Michael David Daniel Hans Karl Pierre Jean Louis Carlos Miguel Pablo Robert William Henry Lukas".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана".split(),
    ("m", "cyrillic"): "Иван Пётр Сергей Андрей Дмитрий Николай Михаил Олег".split(),
}
ADDRESSED = "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Mme Señor Señora Sra Господин Госпожа".split()
CLASSES = ["0123456789", "aeiouy", "bcdfghjklmnpqrstvwxz", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "äöüàâéèêëíîïóôúûùáñçß"]

_KNOWN = {n: (k, i) for k, ns in NAMES.items() for i, n in enumerate(ns)}
_NAME = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё]+"
_CUES = [*ADDRESSED, *_KNOWN]
_MARKS = re.compile(r"[0-9@=:]|AKIA|PRIVATE KEY|(?:sk|pk|ghp|xox[bp])[-_]")
_PASSWORD = re.compile(r"password|passwd|pwd", re.I)
_FIND = re.compile(
    r"""(?P<secret>\bAKIA[0-9A-Z]{8,}\b|\b(?:sk|pk|ghp|xox[bp])[-_][A-Za-z0-9_-]{16,})"""
    r"""|-----BEGIN\ [A-Z0-9 ]*PRIVATE\ KEY(?:\ BLOCK)?-----(?:(?P<pem>(?:(?!-----BEGIN)[\s\S])+?)(?=-----END)|(?P<lines>(?:\s+[A-Za-z0-9+/=]{20,})+))"""
    r"""|(?P<assigned>\b(?i:token|password|passwd|pwd|secret|api[_-]?key|access[_-]?key)["']?\s*[=:]\s*["']?)(?P<value>[A-Za-z0-9_+/.-]{6,})"""
    r"""|(?P<email>(?<![\w.%+-])[\w%+-]+(?:\.[\w%+-]+)*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"""
    r"""|(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d))"""
    r"""|(?P<iban>\b[A-Z]{2}\d{2}(?:\ ?[A-Z0-9]{4}){3,7}(?:\ ?[A-Z0-9]{1,3})?\b)"""
    r"""|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"""
    r"""|(?P<card>(?<![\d.-])(?:\d{4}[ -]){3}\d{4}(?![\d-])|(?<![\d.-])\d{13,19}(?!\d))"""
    r"""|(?P<phone>(?<![\w.-])(?:(?:\+|00)\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{3})[ .-]?\d{3,4}[ .-]?\d{4}(?![\w-])|(?<![\w.-])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![\w-]))""")
_PERSON = re.compile(rf"(?:\b(?:{'|'.join(map(re.escape, ADDRESSED))})\b\.?[ ])(?P<a>{_NAME}(?:[ -]{_NAME})?)|\b(?P<b>(?:{'|'.join(_KNOWN)})[ ]{_NAME})")


def _prf(key: bytes, *parts) -> int:
    return int.from_bytes(hmac.digest(key, "\x1f".join(map(str, parts)).encode(), hashlib.sha256), "big")


def permute(values: list[int], radices: list[int], key: bytes, tweak: str) -> list[int]:
    """A keyed permutation of the mixed-radix numbers with these radices."""
    if not radices:
        return []
    if len(radices) == 1:
        order = sorted(range(radices[0]), key=lambda v: _prf(key, tweak, radices[0], v))
        return [order[(order.index(values[0]) + 1) % radices[0]]]  # one cycle: nothing stays
    half = len(radices) // 2
    parts, sizes = [0, 0], [1, 1]
    for i, (v, r) in enumerate(zip(values, radices)):
        s = i >= half
        parts[s], sizes[s] = parts[s] * r + v, sizes[s] * r
    for i in range(ROUNDS):
        s = i % 2
        parts[s] = (parts[s] + _prf(key, tweak, radices, i, parts[1 - s])) % sizes[s]
    out = []
    for s, rs in ((0, radices[:half]), (1, radices[half:])):
        digits = []
        for r in reversed(rs):
            parts[s], d = divmod(parts[s], r)
            digits.append(d)
        out += reversed(digits)
    return out


def _letters(text: str, key: bytes, tweak: str, keep: set[int] = frozenset()) -> str:
    """Letters and digits permuted within their class; case and all other characters stay."""
    at, values, kinds = [], [], []
    for i, c in enumerate(text):
        low = c.lower()
        kind = next((k for k, cls in enumerate(CLASSES) if low in cls and len(low) == 1), None)
        if kind is not None and i not in keep:
            at.append(i)
            kinds.append(kind)
            values.append(CLASSES[kind].index(low))
    out = list(text)
    for i, kind, v in zip(at, kinds, permute(values, [len(CLASSES[k]) for k in kinds], key, tweak)):
        c = CLASSES[kind][v]
        out[i] = c.upper() if text[i].isupper() and len(c.upper()) == 1 else c
    return "".join(out)


def _digits(text: str, key: bytes, tweak: str, keep: int = 0, last: int = 0) -> str:
    """Digits permuted, but for the first ``keep`` and the last ``last``."""
    at = [i for i, c in enumerate(text) if c in CLASSES[0]]
    at = at[keep:len(at) - last]
    out = list(text)
    for i, v in zip(at, permute([int(text[i]) for i in at], [10] * len(at), key, tweak)):
        out[i] = str(v)
    return "".join(out)


def luhn(digits: str) -> int:
    """The check digit of ``digits``."""
    total = sum(sum(divmod(int(d) * (1 + (i % 2 == 0)), 10)) for i, d in enumerate(reversed(digits)))
    return -total % 10


def _card(text: str, key: bytes) -> str:
    old = [c for c in text if c in CLASSES[0]]
    new = _digits(text, key, f"card{len(old)}", last=1)
    got = [c for c in new if c in CLASSES[0]]
    off = (int(old[-1]) - luhn("".join(old[:-1]))) % 10  # a valid number stays valid
    i = max(i for i, c in enumerate(new) if c in CLASSES[0])
    return new[:i] + str((luhn("".join(got[:-1])) + off) % 10) + new[i + 1:]


def _ip(text: str, key: bytes) -> str:
    parts = text.split(".")
    new = permute(list(map(int, parts)), [256] * 4, key, "ip")
    return ".".join(str(v).zfill(len(p)) if p.startswith("0") else str(v) for p, v in zip(parts, new))


def _phone(text: str, key: bytes) -> str:
    n = sum(c in CLASSES[0] for c in text)
    code = max(0, n - 10) if text.startswith(("+", "00")) or n > 10 else 0
    return _digits(text, key, "phone", keep=code)


def _name(text: str, key: bytes) -> str:
    """Known given names go round within their gender and script; others keep script, vowels' places and ending."""
    out = []
    for w in re.split(r"([ -])", text):
        if w in _KNOWN:
            k, i = _KNOWN[w]
            w = NAMES[k][permute([i], [len(NAMES[k])], key, "name" + "".join(k))[0]]
        elif w not in (" ", "-", ""):
            keep = {len(w) - 1}
            w = _letters(w, key, "name", keep)
            while w in _KNOWN:
                w = _letters(w, key, "name", keep)
        out.append(w)
    return "".join(out)


def surrogate(kind: str, text: str, key: bytes = KEY) -> str:
    if kind == "email":
        stem, dot, top = text.rpartition(".")
        return _letters(stem, key, f"email{top.lower()}") + dot + top
    if kind == "ip":
        return _ip(text, key)
    if kind == "card":
        return _card(text, key)
    if kind == "phone":
        return _phone(text, key)
    if kind == "ssn":
        return _digits(text, key, "ssn")
    if kind == "iban":
        return text[:2] + _letters(text[2:], key, "iban" + text[:2])
    if kind == "person":
        return _name(text, key)
    if text.startswith("AKIA"):
        return text[:4] + _letters(text[4:], key, "akia")
    if re.fullmatch("[0-9a-f]+", text):
        hexes = "0123456789abcdef"
        return "".join(hexes[v] for v in permute([hexes.index(c) for c in text], [16] * len(text), key, f"hex{len(text)}"))
    out = _letters(text, key, "secret")
    while out.startswith("AKIA") or re.fullmatch("[0-9a-f]+", out):  # the ranges of those above
        out = _letters(out, key, "secret")
    return out


def detect(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities, left to right, not overlapping."""
    found = []
    if _MARKS.search(text):
        for m in _FIND.finditer(text):
            kind = m.lastgroup
            if kind == "value":
                if not re.search(r"\d", m["value"]) and not _PASSWORD.match(m["assigned"]):
                    continue
                found.append((*m.span("value"), "secret"))
            elif kind in ("pem", "lines"):
                found.append((*m.span(kind), "secret"))
            else:
                found.append((*m.span(), kind))
    for cue in _CUES:
        at = text.find(cue)
        while at >= 0:
            if m := _PERSON.match(text, at):
                s, e = m.span(m.lastgroup)
                if all(e <= x or s >= y for x, y, _ in found):
                    found.append((s, e, "person"))
            at = text.find(cue, at + 1)
    return sorted(found)


def canonical(kind: str, text: str) -> str:
    """What two mentions of one entity have in common."""
    if kind == "phone":
        return re.sub(r"\D", "", text)[-10:]
    if kind in ("card", "ssn"):
        return re.sub(r"\D", "", text)
    if kind == "ip":
        return ".".join(str(int(p)) for p in text.split("."))
    return text.lower() if kind == "email" else text


def marked(kind: str, entity: str, key: bytes) -> str:
    """An entity under a keyed hash."""
    return hmac.new(key, f"{kind}:{entity}".encode(), hashlib.sha256).hexdigest()[:32]


class Surrogates(OrderedDict):
    """(kind, text) -> surrogate, kept up to a bound; ``turns`` has the entities (hashed) that take another key."""

    def __init__(self, key: bytes, most: int = 100_000, turns: dict[str, int] | None = None):
        super().__init__()
        self.key, self.most, self.turns = key, most, turns or {}

    def __missing__(self, item):
        if len(self) >= self.most:
            self.popitem(last=False)
        kind, text = item
        turn = self.turns.get(marked(kind, canonical(kind, text), self.key), 0) if self.turns else 0
        out = self[item] = surrogate(kind, text, self.key + b"#%d" % turn if turn else self.key)
        return out


def replace(text: str, table: Surrogates) -> tuple[str, list[tuple[str, str, str]]]:
    out, at, found = [], 0, []
    for s, e, kind in detect(text):
        new = table[kind, text[s:e]]
        found.append((kind, canonical(kind, text[s:e]), canonical(kind, new)))
        out += [text[at:s], new]
        at = e
    return "".join([*out, text[at:]]) if found else text, found


def entities(docs: DataFrame, key: bytes = KEY, turns: dict[str, int] | None = None) -> DataFrame:
    """(kind, entity, surrogate) of every entity of every row, the entity under a keyed hash; repeats included."""
    def run(batches):
        table = Surrogates(key, turns=turns)
        for b in batches:
            rows = [(k, marked(k, old, key), new) for t in b.column(0).to_pylist() if t for k, old, new in replace(t, table)[1]]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], names=["kind", "entity", "surrogate"])
    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "kind string, entity string, surrogate string")


def collisions(found: DataFrame) -> DataFrame:
    """(kind, surrogate) that stand for several entities, and entities with several surrogates; partial aggregates only."""
    same = found.groupBy("kind", "surrogate").agg(F.min("entity").alias("a"), F.max("entity").alias("b")).where("a <> b").select("kind", F.col("surrogate").alias("value"))
    split = found.groupBy("kind", "entity").agg(F.min("surrogate").alias("a"), F.max("surrogate").alias("b")).where("a <> b").select("kind", F.col("entity").alias("value"))
    return same.unionByName(split)


def clashing(found: DataFrame) -> DataFrame:
    """The entities of shared surrogates but for the first of each, which keeps its own."""
    same = found.groupBy("kind", "surrogate").agg(F.min("entity").alias("a"), F.max("entity").alias("b")).where("a <> b")
    return found.join(same, ["kind", "surrogate"]).where("entity <> a").select("entity").distinct()


def settle(docs: DataFrame, key: bytes = KEY) -> dict[str, int]:
    """The entities that need another key for all surrogates to differ, with its number; none but for unlikely clashes.

    Fails where ``TURNS`` keys don't do, or where an entity has several surrogates.
    """
    turns: dict[str, int] = {}
    for turn in range(1, TURNS + 1):
        found = cut(entities(docs, key, turns), "entities")
        clash = collisions(found).limit(5).collect()
        if not clash:
            return turns
        more = {r["entity"]: turn for r in clashing(found).toLocalIterator()}
        if not more:
            break
        turns |= more
    raise ValueError(f"surrogates aren't one to one: {clash}")


def anonymise(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """``docs`` with every detected entity in ``text`` replaced; all columns stay.

    A null text stays null and an empty one empty; texts without entities are
    unchanged.  Addresses and known names may change their length, other
    surrogates don't.  Repeated rows stay and get the same text.  An empty
    table gives no rows.
    """
    turns = settle(docs, key)

    def run(batches):
        table = Surrogates(key, turns=turns)
        for b in batches:
            i = b.schema.get_field_index("text")
            texts = [None if t is None else replace(t, table)[0] for t in b.column(i).to_pylist()]
            yield b.set_column(i, b.schema.field(i), pa.array(texts, b.schema.field(i).type))
    return docs.mapInArrow(run, docs.schema)


def report(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """(doc_id, text, n_entities, surrogates) of every row: the new text and what was put in, in order."""
    turns = settle(docs, key)

    def run(batches):
        table = Surrogates(key, turns=turns)
        for b in batches:
            rows = [(None, []) if t is None else replace(t, table) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([t for t, _ in rows], pa.string()), pa.array([len(f) for _, f in rows], pa.int64()),
                                              pa.array([[f"{k}:{new}" for k, _, new in f] for _, f in rows], pa.list_(pa.string()))], names=["doc_id", "text", "n_entities", "surrogates"])
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, plus(rows.schema, "n_entities long, surrogates array<string>"))
