"""Benchmark decontamination by template canonicalisation.

Texts and benchmark items become token templates: marks around a word are
dropped and letters lower-cased, and numbers, units after a number and names
(capitalised words inside a sentence, and at its beginning if the same text
has them inside a sentence and nowhere in small letters) become typed placeholders.  Windows of
``window`` template tokens are hash-joined.  The windows that a text and an
item share are lined up by diagonal (position in the text less position in
the item); on each diagonal and its near neighbours, the strongest first, until
one covers the whole item, the slot values must correspond one to one (one
value of the item always becomes the same value of the text, and back), else the disagreeing windows are dropped.  The item is a
leak if the remaining windows cover ``coverage`` of its tokens:
``verbatim`` if all slots hold the item's own values, else ``reparameterised``.

Scale: a text is one row of one narrow pass.  The items' window hashes are the
stated query set: they are collected and broadcast in blocks of at most
``BLOCK_WINDOWS`` windows (12 bytes each and their items' templates), one pass
over the texts for each block.  A window that many texts share is looked up in
place, so no hash is a hot key.  Windows with fewer than ``LITERALS`` literal
tokens, and those with the first word of a sentence (which may be a name in the
text and none in the item), are looked up by their own words as well and fit
only with the item's own values, so verbatim copies of every item are found.

Defined results: a null or empty text has no leaks; an item of fewer tokens
than a window is one window of its own length; an item without a token is
ignored, as are items with a null id or text; marks by themselves (``+``, ``*``)
are no tokens, so they are not compared; repeated
item rows count once, an item id on several texts is as many items, and repeated
texts give repeated rows; a null document id
is carried; other columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.worker import claim

WINDOW = 5
LITERALS = 3  # least literal tokens of a window
COVERAGE = 0.8
DRIFT = 3  # diagonals next to the strongest one that count with it
BLOCK_WINDOWS = 500_000
WORD_TABLE = 200_000
_MAYBE = 1 << 20

# fixed values: units that may follow a number
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg lb lbs oz pound pounds ton tons ml cl l liter liters litre litres "
    "ms s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "% percent $ € £ usd eur dollar dollars euro euros cent cents c f k w kw v a hz khz mhz ghz b kb mb gb tb mph kph".split()
)
NUMBER, UNIT, NAME = "\x00number", "\x00unit", "\x00name"
_NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,:/]*(%|[A-Za-z]{1,5})?")
_DIGIT = re.compile(r"\d")  # what the pattern calls a digit
_MARKS = ".,;:!?\"'()[]{}<>*#&|~`^_+=/\\@%$€£-"


def _plain(word: str) -> tuple[str, str | None, bool, bool]:
    """(template token away from its neighbours, slot value, capitalised, ends a sentence) of a word."""
    if word.isalpha():  # no marks, no digits
        return word.lower(), None, word[0].isupper() and not word.isupper() and len(word) > 1, False
    bare = word.strip(_MARKS)
    low, ends = bare.lower(), word[-1] in ".!?:"
    if _DIGIT.search(bare) and _NUMBER.fullmatch(word.strip(".,;:!?\"'()[]{}*#&|")):
        return NUMBER, low, False, ends
    return low, None, bare[:1].isupper() and not bare.isupper() and len(bare) > 1, ends


def template(text: str | None) -> tuple[list[str], list[str | None], list[int], list[int]]:
    """Template tokens, their slot values (null for literals), and their spans' starts and ends in code points."""
    words: list[tuple[str, str | None, bool, bool, int, int]] = []
    new_sentence, after_number, at = True, False, 0
    for word in (text or "").split():
        at = text.index(word, at)
        token, value, capital, ends = _plain(word)
        start, at = at, at + len(word)
        if token:
            if value is None and after_number and token in UNITS:
                token, value = UNIT, token
            words.append((token, value, capital, new_sentence, start, at))
            after_number = token == NUMBER
        new_sentence = ends
    literal = [w for w in words if w[1] is None]
    names = {w[0] for w in literal if w[2] and not w[3]} - {w[0] for w in literal if not w[2]}
    tokens: list[str] = []
    values: list[str | None] = []
    for token, value, capital, opens, _, _ in words:
        if value is None and capital and (not opens or token in names):
            token, value = NAME, token
        tokens.append(token)
        values.append(value)
    return tokens, values, [w[4] for w in words], [w[5] for w in words]


# a word's packed form: its literal token's hash above, these flags in the low bits
_IS_NUMBER, _IS_UNIT, _IS_CAPITAL, _ENDS, _EMPTY, _FLAGS = 1, 2, 4, 8, 16, 31


class _Packed(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= WORD_TABLE:
            self.clear()
        token, value, capital, ends = _plain(word)
        if value is None:
            h = xxhash.xxh3_64_intdigest(token) & ~_FLAGS
            if token in UNITS:
                h |= _IS_UNIT
            if capital:
                h |= _IS_CAPITAL
            if not token:
                h |= _EMPTY
        else:
            h = xxhash.xxh3_64_intdigest(value) & ~_FLAGS
        if token == NUMBER:
            h |= _IS_NUMBER
        if ends:
            h |= _ENDS
        self[word] = h
        return h


_packed = _Packed()
_SLOT = {t: np.uint64(xxhash.xxh3_64_intdigest(t) & ~_FLAGS) for t in (NUMBER, UNIT, NAME)}


def template_hashes(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each template token of ``template(text)``, and whether it is a placeholder."""
    return _hashes(text)[:2]


def _hashes(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``template_hashes``, the hash of each token's own word, and whether it is a capitalised word that opens a sentence."""
    words = (text or "").split()
    packed = np.fromiter(map(_packed.__getitem__, words), np.uint64, len(words))
    flags = (packed & np.uint64(_FLAGS)).astype(np.uint8)
    opens = np.ones(len(words), bool)
    opens[1:] = (flags[:-1] & _ENDS) > 0
    if (flags & _EMPTY).any():
        keep = (flags & _EMPTY) == 0
        packed, flags, opens = packed[keep], flags[keep], opens[keep]
    number = (flags & _IS_NUMBER) > 0
    unit = (flags & _IS_UNIT) > 0
    unit[:1] = False
    unit[1:] &= number[:-1]
    capital = ((flags & _IS_CAPITAL) > 0) & ~unit
    name, first = capital & ~opens, capital & opens
    own = packed & ~np.uint64(_FLAGS)
    if first.any() and name.any():
        # a sentence's first word is a name if it is one elsewhere in the text and nowhere without its capital
        known = np.unique(own[name])
        known = known[~np.isin(known, own[~capital & ~number & ~unit])]
        if len(known):
            name |= first & np.isin(own, known)
    h = own.copy()
    for which, token in ((number, NUMBER), (unit, UNIT), (name, NAME)):
        if which.any():
            h[which] = _SLOT[token]
    return h, number | unit | name, own, first


def window_hashes(h: np.ndarray, slot: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the window at each position, and whether it has enough literal tokens."""
    n = len(h) - width + 1
    if n < 1:
        return np.empty(0, np.uint64), np.empty(0, bool)
    out, slots = np.full(n, width, np.uint64), np.zeros(n, np.int8)
    for i in range(width):
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
        slots += slot[i : i + n]
    return out, width - slots >= min(LITERALS, width)


def _word_windows(own: np.ndarray, width: int) -> np.ndarray:
    """Hash of the window of own words at each position, unlike the template's."""
    return ~window_hashes(own, np.zeros(len(own), np.int8), width)[0] * np.uint64(0xD6E8FEB86659FD93)


class Items:
    """The windows of a block of benchmark items, sorted by hash, with the items' templates."""

    def __init__(self, rows: list[tuple[int, str]], window: int = WINDOW):
        self.window = window
        self.ids = [i for i, _ in rows]  # an id may stand on several texts: items are numbered
        self.templates = {k: template(t)[:2] for k, (_, t) in enumerate(rows)}
        hashed = {k: _hashes(t) for k, (_, t) in enumerate(rows)}
        # an item shorter than a window is one window of its own width
        self.widths = sorted({min(window, len(t)) for t, _ in self.templates.values() if t})
        # by width: windows of template tokens and, with hashes apart from theirs, windows of own words
        self.index: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.maybe: dict[int, np.ndarray] = {}  # by the hash's top bits: whether any window has them
        for width in self.widths:
            hashes, items, places = [], [], []
            for i, token_hashes in hashed.items():
                if min(window, len(token_hashes[0])) == width:
                    h, ok = window_hashes(*token_hashes[:2], width)
                    ok &= width >= LITERALS
                    by_words = ~ok
                    by_words[0] = True
                    opening = np.concatenate([[0], np.cumsum(token_hashes[3])])
                    by_words |= opening[width:] > opening[:-width]  # its first word may be a name in one of the two only
                    hashes += [h[ok], _word_windows(token_hashes[2], width)[by_words]]
                    places += [np.flatnonzero(ok), np.flatnonzero(by_words)]
                    items.append(np.full(int(ok.sum() + by_words.sum()), i, np.int64))
            h, i, p = (np.concatenate(x) for x in (hashes, items, places))
            order = np.argsort(h, kind="stable")
            self.index[width] = h[order], i[order], p[order]
            self.maybe[width] = maybe = np.zeros(_MAYBE, bool)
            maybe[h >> np.uint64(44)] = True

    def shared(self, text: str | None) -> dict[int, list[tuple[int, int, int]]]:
        """Item -> (place in the text, place in the item, width) of each shared window."""
        found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        h, slot, own, _ = _hashes(text)
        for width, (hashes, items, places) in self.index.items():
            templates, ok = window_hashes(h, slot, width)
            for w, which in ((templates, ok), (_word_windows(own, width), True)):
                at = np.flatnonzero(which & self.maybe[width][w >> np.uint64(44)])
                if not len(at):
                    continue
                low = np.searchsorted(hashes, w[at])
                hit = hashes[np.minimum(low, len(hashes) - 1)] == w[at]
                at, low = at[hit], low[hit]
                if not len(at):
                    continue
                high = np.searchsorted(hashes, w[at], "right")
                for x, a, b in zip(at.tolist(), low.tolist(), high.tolist()):
                    for k in range(a, b):
                        found[int(items[k])].append((x, int(places[k]), width))
        return found


def _one_to_one(pairs: list[tuple[str, str]]) -> bool:
    there, back = dict(pairs), {b: a for a, b in pairs}
    return all(there[a] == b and back[b] == a for a, b in pairs)


def _consistent(windows: list[tuple[int, int, int]], diagonal: int, item: tuple, text: tuple) -> tuple[list[tuple[int, int, int]], bool]:
    """The windows whose slots fit, and whether all of them hold the item's own values.

    A window with the item's own values fits.  One with others fits if the
    slots of the whole item along the diagonal correspond one to one.
    """
    (their_tokens, theirs), (our_tokens, ours) = item, text
    line = [(theirs[p], ours[p + diagonal]) for p in range(max(0, -diagonal), min(len(theirs), len(ours) - diagonal)) if theirs[p] is not None and their_tokens[p] == our_tokens[p + diagonal]]
    fits = _one_to_one(line)
    kept, same = [], True
    for at, place, width in windows:
        # the own words: slot values, or the tokens where there is no slot
        own = all((theirs[p] or their_tokens[p]) == (ours[a] or our_tokens[a]) for p, a in zip(range(place, place + width), range(at, at + width)))
        alike = own or their_tokens[place : place + width] == our_tokens[at : at + width]
        if own or (alike and fits and at - place == diagonal):
            kept.append((at, place, width))
            same &= own
    return kept, same


def leaks(text: str | None, items: Items, coverage: float = COVERAGE) -> list[tuple[int, int, int, float, str]]:
    """(item, start, stop, share of the item's tokens, kind) of each item that leaks into the text."""
    out = []
    tokens: list[str] | None = None
    for item, windows in sorted(items.shared(text).items()):
        size = len(items.templates[item][0])
        if len({p + i for _, p, w in windows for i in range(w)}) < coverage * size:
            continue
        if tokens is None:
            tokens, values, starts, stops = template(text)
        on: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for w in sorted(set(windows)):
            on[w[0] - w[1]].append(w)
        best: tuple | None = None
        for diagonal in sorted(on, key=lambda x: (-len(on[x]), x)):
            near = sorted(w for x in range(diagonal - DRIFT, diagonal + DRIFT + 1) for w in on.get(x, ()))
            if sum(w for _, _, w in near) < coverage * size:
                continue  # cannot cover enough
            kept, same = _consistent(near, diagonal, items.templates[item], (tokens, values))
            covered = len({p + i for _, p, w in kept for i in range(w)}) / size
            if kept and (best is None or covered > best[2]):
                best = (starts[kept[0][0]], stops[max(a + w for a, _, w in kept) - 1], covered, "verbatim" if same else "reparameterised")
                if covered == 1:
                    break
        if best and best[2] >= coverage:
            out.append((items.ids[item], *best))
    return out


def _find(items_of, coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(items_of.value)
        claim("leaks", _packed.clear)
        _packed.clear()  # a worker that is used again starts small
        for batch in batches:
            rows = [(doc, text_hash, *x) for doc, text, text_hash in zip(*(c.to_pylist() for c in batch.columns)) for x in leaks(text, items, coverage)]
            names = ["doc_id", "text_hash", "item_id", "start", "stop", "coverage", "kind"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
        _packed.clear()

    return run


def item_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple[int, str]]]:
    """The items, in blocks of at most BLOCK_WINDOWS words (or one item), read through an iterator."""
    rows = benchmark.select(benchmark[item_col].cast("long").alias("i"), benchmark[text_col].cast("string").alias("t")).dropna()
    rows = rows.distinct()
    block: list[tuple[int, str]] = []
    size = 0
    for r in rows.orderBy("i", "t").toLocalIterator():
        n = len(r["t"].split())
        if block and size + n > BLOCK_WINDOWS:
            yield block
            block, size = [], 0
        block.append((r["i"], r["t"]))
        size += n
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text", with_hash: bool = False) -> DataFrame:
    """(doc_id, item_id, start, stop, coverage, kind) of every leak; spans in code points, end exclusive.

    ``with_hash`` adds ``text_hash`` (xxhash64 of the text), which tells rows that share an id apart.
    """
    spark = docs.sparkSession
    text = docs[text_col].cast("string")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    schema = "doc_id long, text_hash long, item_id long, start long, stop long, coverage double, kind string"
    found = None
    for block in item_blocks(benchmark):
        part = rows.mapInArrow(_find(spark.sparkContext.broadcast(block), coverage), schema)
        found = part if found is None else found.unionByName(part)
    found = found if found is not None else spark.createDataFrame([], schema)
    return found if with_hash else found.drop("text_hash")
