"""Byte-level BPE encoding and decoding with forced-boundary splitting.

A byte pair that occurs inside no token of the vocabulary can never be merged
across, so a text may be cut between its two bytes, the fragments encoded
independently and the ids concatenated.  One table over byte pairs, looked up
for all bytes of a text at once, gives the cuts of the whole text before
anything else is done:

* pairs that no token holds, and pairs that the pre-tokenizer always parts
  (ASCII letter, digit and mark next to each other);
* not after white space, not before or after an apostrophe that could belong to
  a contraction, and not inside a character: there a fragment could be
  pre-tokenized otherwise than the text.  Elsewhere the pre-tokenizer's matches
  in a fragment are those of the text, for nothing but white space looks ahead
  and nothing looks back.  A text with white space other than blanks and line
  feeds is pre-tokenized whole instead.

Fragments are pre-tokenized, and pre-tokens cut at every forced pair again
(there the exceptions do not hold), before merging.  Fragments recur, so each
worker keeps a bounded table of encoded fragments over its tasks of this
operator, and empties it when it goes on to another one.

One narrow pass, no shuffle; memory is bounded by one text and the fragment
table.  A null text is empty (no ids, decoded to the empty text); repeated
rows give repeated results; other columns are passed through by ``encode``.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from peerscope.llm.worker import claim

# fixed values: the pre-tokenizer's pattern of byte-level BPE files that state use_regex
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
FRAGMENT_TABLE = 300_000  # entries a worker keeps before it starts its table anew

NONE = 1 << 30
LONG = 64  # bytes of a fragment that the table does not keep

_OTHER_SPACE = re.compile(r"[^\S \n]|[\x1c-\x1f\x85]")
#: Contractions of the pattern: no cut between their bytes.
_CONTRACTIONS = (b"'s", b"'t", b"'re", b"'ve", b"'m", b"'ll", b"'d")


def _byte_letters() -> dict[str, int]:
    """Letter -> byte of the printable alphabet in which byte-level files write their tokens."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _cuts(inside: np.ndarray) -> np.ndarray:
    """Byte pairs (first * 256 + second) at which a whole text may be cut, from the pairs that occur inside a token."""
    byte = np.arange(256)
    kind = np.zeros(256, np.int8)  # 1 letter, 2 digit, 3 mark of ASCII
    for k, test in ((1, bytes.isalpha), (2, bytes.isdigit)):
        kind[[b for b in range(128) if test(bytes([b]))]] = k
    kind[[b for b in range(0x21, 0x7F) if not bytes([b]).isalnum()]] = 3
    parted = (kind[:, None] != kind[None, :]) & (kind[:, None] > 0) & (kind[None, :] > 0) & (byte != 0x27)[:, None]
    cut = ~inside | parted
    cut[[0x20, 0x0A], :] = False  # white space before it
    cut[:, 0x27] = False
    cut[:, (byte & 0xC0) == 0x80] = False  # inside a character
    for word in _CONTRACTIONS:
        for pair in zip(word, word[1:]):
            cut[pair] = False
    return cut.ravel()


class ByteBPE:
    """Encoder and decoder of one byte-level BPE vocabulary file (tokenizer JSON)."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre.get("use_regex", True) or model["type"] != "BPE" or model.get("ignore_merges"):
            raise ValueError("not a plain byte-level BPE file")
        letters = _byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        ids = {as_bytes(t): i for t, i in model["vocab"].items()}
        self.byte_id = [ids[bytes([b])] for b in range(256)]
        self.rank: dict[int, int] = {}  # left id << 32 | right id -> rank of the merge
        self.made: list[int] = []  # rank -> id of what the merge makes
        for r, m in enumerate(model["merges"]):
            a, b = (as_bytes(x) for x in (m if isinstance(m, list) else m.split(" ")))
            self.rank[ids[a] << 32 | ids[b]] = r
            self.made.append(ids[a + b])
        added = {t["content"]: t for t in spec.get("added_tokens", [])}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added.values()):
            raise ValueError("added tokens that take in neighbouring text are not supported")
        self.added = {s: t["id"] for s, t in added.items()}
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.token = {i: t for t, i in ids.items()} | {i: s.encode() for s, i in self.added.items()}
        self.pattern = regex.compile(PRE_TOKEN)
        self.inside = np.zeros((256, 256), dtype=bool)  # pairs that occur inside some token
        for t in ids:
            b = np.frombuffer(t, np.uint8)
            self.inside[b[:-1], b[1:]] = True
        self.joined = self.inside.tobytes()
        self.cut = _cuts(self.inside)
        self.table: dict[bytes, bytes] = {}

    def _merge(self, piece: bytes) -> list[int]:
        """Ids of a piece: the pair of lowest rank, leftmost first, until no pair has one."""
        parts, rank = [self.byte_id[b] for b in piece], self.rank.get
        if len(parts) > 256:
            return self._merge_long(parts)
        ranks = [rank(a << 32 | b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) != NONE:
            i = ranks.index(least)
            parts[i] = made = self.made[least]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] << 32 | made, NONE)
            if i < len(ranks):
                ranks[i] = rank(made << 32 | parts[i + 1], NONE)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same merges through a heap and links, for a piece of hundreds of bytes or more."""
        n, rank = len(parts), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank(parts[i] << 32 | parts[i + 1], NONE)) != NONE]
        heapq.heapify(heap)
        while heap:
            least, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = self.made[least], -1
            after[i] = k = after[j]
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n:
                    before[y] = x
                    if (r := rank(parts[x] << 32 | parts[y], NONE)) != NONE:
                        heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [p for p in parts if p >= 0]

    def _word(self, data: bytes) -> list[int]:
        """Ids of a pre-token, cut at every byte pair that no token holds."""
        joined = self.joined
        cuts = [i for i, (a, b) in enumerate(zip(data, data[1:]), 1) if not joined[a << 8 | b]]
        if not cuts:
            return self._merge(data)
        out: list[int] = []
        for x, y in zip([0, *cuts], [*cuts, len(data)]):
            out += self._merge(data[x:y])
        return out

    def _fragment(self, fragment: bytes) -> bytes:
        out: list[int] = []
        for word in self.pattern.findall(fragment.decode()):
            out += self._word(word.encode())
        return struct.pack(f"<{len(out)}I", *out)

    def fragments(self, text: str) -> list[bytes]:
        """The text cut at every certain byte pair (or its pre-tokens, if it holds uncommon white space)."""
        if _OTHER_SPACE.search(text):
            return [w.encode("utf-8", "replace") for w in self.pattern.findall(text)]
        data = text.encode("utf-8", "replace")
        b = np.frombuffer(data, np.uint8)
        pairs = b[:-1].astype(np.uint16)
        pairs <<= 8
        pairs |= b[1:]
        at = (np.flatnonzero(self.cut[pairs]) + 1).tolist()
        return [data[x:y] for x, y in zip([0, *at], [*at, len(data)])]

    def _plain(self, text: str) -> bytes:
        fragments = self.fragments(text)
        table, get = self.table, self.table.get
        found = list(map(get, fragments))
        if None in found:
            for i, x in enumerate(found):
                if x is None:
                    f = fragments[i]
                    if (ids := get(f)) is None:
                        ids = self._fragment(f)
                        if len(f) <= LONG:
                            if len(table) >= FRAGMENT_TABLE:
                                table.clear()
                            table[f] = ids
                    found[i] = ids
        return b"".join(found)

    def encode(self, text: str | None) -> bytes:
        """Ids as packed little-endian unsigned 32-bit integers; added tokens in the text are one id each."""
        if not text:
            return b""
        if self._special is None or not self._special.search(text):
            return self._plain(text)
        parts = self._special.split(text)
        return b"".join(np.asarray([self.added[p]], "<u4").tobytes() if p in self.added else self._plain(p) for p in parts if p)

    def decode(self, packed: bytes | None) -> str:
        return b"".join(map(self.token.__getitem__, np.frombuffer(packed or b"", "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def load(path: str) -> ByteBPE:
    """The vocabulary at ``path`` (on each worker), read once a process."""
    return ByteBPE(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _with(path: str | None, source: str, out: dict[str, pa.DataType], f: Callable[[ByteBPE, object], tuple]) -> Callable:
    """Batches with the columns ``out``, which ``f`` makes of each value of ``source``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(path or default_vocabulary())
        claim("bpe", vocabulary.table.clear)
        for batch in batches:
            step = 256  # bounds the lists that are held at once
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                made = [f(vocabulary, x.as_py()) for x in part.column(part.schema.get_field_index(source))]
                columns = [pa.array([m[i] for m in made], kind) for i, kind in enumerate(out.values())]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, *out])
        pa.default_memory_pool().release_unused()

    return run


def _added(df: DataFrame, **kinds: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, *(T.StructField(n, k) for n, k in kinds.items())])


def encode(docs: DataFrame, text_col: str = "text", out: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """``docs`` with ``out``: the ids of ``text_col``, packed (see ``unpack``).  A column of that name is replaced.

    ``vocabulary`` is a path that the workers can open; by default the public
    50k byte-level file that each of them has installed.
    """
    docs = docs.drop(out)
    return docs.mapInArrow(_with(vocabulary, text_col, {out: pa.binary()}, lambda v, x: (v.encode(x),)), _added(docs, **{out: T.BinaryType()}))


def decode(encoded: DataFrame, ids_col: str = "ids", out: str = "decoded", vocabulary: str | None = None) -> DataFrame:
    """``encoded`` with ``out``: the text of the packed ids.  A column of that name is replaced."""
    encoded = encoded.drop(out)
    return encoded.mapInArrow(_with(vocabulary, ids_col, {out: pa.string()}, lambda v, x: (v.decode(x),)), _added(encoded, **{out: T.StringType()}))


def _both(vocabulary: ByteBPE, text: str | None) -> tuple[bytes, str]:
    ids = vocabulary.encode(text)
    return ids, vocabulary.decode(ids)


def round_trip(docs: DataFrame, text_col: str = "text", out: str = "ids", decoded: str = "decoded", vocabulary: str | None = None) -> DataFrame:
    """``decode(encode(docs))`` in one pass, so that a task needs one worker."""
    docs = docs.drop(out, decoded)
    return docs.mapInArrow(_with(vocabulary, text_col, {out: pa.binary(), decoded: pa.string()}, _both), _added(docs, **{out: T.BinaryType(), decoded: T.StringType()}))


def unpack(packed: bytes | None) -> list[int]:
    return np.frombuffer(packed or b"", "<u4").tolist()
