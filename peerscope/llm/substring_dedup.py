"""Substring dedup by hashed lines, long lines divided at sentence ends, and by hashed word windows.

A text's units are its lines, each cut after ``.``, ``!`` or ``?`` before white
space, so that a passage pasted inside a line is made of the same units as
elsewhere.  A unit is normalised (lower case, white space runs as one blank)
and hashed to 128 bits; digests are grouped over all texts.  Of equal units the
occurrence in the text of the smallest id, and there the first, is kept; the
others repeat.  ``repeated_spans`` gives the maximal runs of repeating units
(of at least ``min_words`` words, by default all); spans are offsets into the
original text in code points, end exclusive.

A passage pasted inside a sentence shares no whole unit.  ``repeated_passages``
adds to the runs (of any length) every window of ``PASSAGE`` words that a text
of a smaller id holds, or the same text at least a window before, so that each
shared run of ``PASSAGE`` words or more goes whole.  Windows are hashed only
where they can matter: of each ``PASSAGE`` words the least hash of ``GRAM``
words is a mark, the same in every copy; a mark counts if an occurrence after
its first may lie in a window that the runs do not cover.

Scale: digests are combined map-side (a unit in a third of all texts is one
row a task), and only those that occur twice are joined back, an equi-join
that AQE may split; a text's own units are put together again by its row
number.  Each text's units are one written row; only texts with a mark that
counts are read again, for their windows about it.

Defined results: a null or empty text has no units; rows that share an id are
one rank, so they keep the same units; a null id ranks after all others;
other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import saved, small_enough

PASSAGE = 50  # words of a window
GRAM = 20  # words of a mark
WORD_TABLE = 200_000  # word hashes a worker keeps before it starts its table anew

_END = re.compile(r"[.!?](?=\s)|\n")
_LISTS = {"h1": pa.int64(), "h2": pa.int64(), "start": pa.int32(), "stop": pa.int32(), "words": pa.int32()}
_UNITS = "doc_id long, h1 array<bigint>, h2 array<bigint>, start array<int>, stop array<int>, words array<int>"
_MARKED = _UNITS + ", text_hash long, mark array<bigint>, place array<int>"


def _cut(text: str | None, found: tuple[list, list, list, list]) -> list[str]:
    """The words of a text; ``found`` (digests, starts, ends, counts of words) is extended by its units with a word, in order."""
    digests, starts, stops, counts = found
    out: list[str] = []
    if not text:
        return out
    at = 0
    for stop in [*(m.end() for m in _END.finditer(text)), len(text)]:
        piece = text[at:stop]
        if words := piece.lower().split():
            left = piece.lstrip()
            start = stop - len(left)
            digests.append(xxhash.xxh3_128_digest(" ".join(words)))
            starts.append(start)
            stops.append(start + len(left.rstrip()))
            counts.append(len(words))
            out += words
        at = stop
    return out


def _halves(digests: list[bytes]) -> np.ndarray:
    """Two signed 64-bit integers a digest."""
    return np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)


def units(text: str | None) -> list[tuple[int, int, int, int, int]]:
    """(digest, digest, start, end, words) of each unit with a word, in order."""
    found: tuple[list, list, list, list] = ([], [], [], [])
    _cut(text, found)
    return [(*h, *rest) for h, *rest in zip(_halves(found[0]).tolist(), *found[1:])]


_SPACE = np.array([chr(i).isspace() for i in range(0x3002)])  # the last one is U+3000


def _spots(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``text.split()``, in code points."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.zeros(len(codes) + 2, np.int8)
    inside[1:-1] = ~_SPACE[np.minimum(codes, 0x3001)]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= WORD_TABLE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_hash_of = _WordHashes()


def _extreme(x: np.ndarray, width: int, of) -> np.ndarray:
    """Least or largest (``of``) of each ``width`` neighbours."""
    n, size = len(x) - width + 1, 1
    while 2 * size <= width:
        x, size = of(x[:-size], x[size:]), 2 * size
    return of(x[:n], x[width - size :][:n])


def _rolled(h: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Hash of each ``width`` neighbours, from those of the halves of powers of two."""
    x, size, out, done = (h ^ np.uint64(seed)) * np.uint64(0xC2B2AE3D27D4EB4F), 1, None, 0
    mix = lambda a, b: ((a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + b) * np.uint64(0xD6E8FEB86659FD93)
    n = len(h) - width + 1
    while True:
        if width & size:
            part = x[done:][:n]
            out, done = part if out is None else mix(out, part), done + size
        if 2 * size > width:
            return out ^ (out >> np.uint64(29))
        x, size = mix(x[:-size], x[size:]), 2 * size


def _hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_hash_of.__getitem__, words), np.uint64, len(words))


def marks(texts: list[list[str]], passage: int = PASSAGE, gram: int = GRAM) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, places) of the marks of each text, given as words: grams whose hash is the least of all the grams in some ``passage`` words."""
    return _marks(np.concatenate([_hashes(t) for t in texts]), np.array([len(t) for t in texts], np.int64), passage, gram)


def _marks(h: np.ndarray, counts: np.ndarray, passage: int = PASSAGE, gram: int = GRAM) -> list[tuple[np.ndarray, np.ndarray]]:
    if len(h) < passage:
        return [(np.empty(0, np.int64), np.empty(0, np.int32))] * len(counts)
    x = _rolled(h, gram, gram) | np.uint64(1)
    width = passage - gram + 1
    least = _extreme(x, width, np.minimum)
    ends = np.cumsum(counts)
    least[np.arange(len(least)) + passage > np.repeat(ends, counts)[: len(least)]] = 0  # a window that crosses into the next text
    around = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    at = np.flatnonzero(_extreme(around, width, np.maximum) == x)
    cuts = np.searchsorted(at, ends)[:-1]
    return [(x[p].view(np.int64), (p - start).astype(np.int32)) for p, start in zip(np.split(at, cuts), ends - counts)]


def _grouped(hashes: list[np.ndarray], most: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The texts' word hashes, joined in lists of about ``most`` words (or one text), and each text's number of words."""
    some, n = [np.empty(0, np.uint64)], 0
    for h in hashes:
        some.append(h)
        n += len(h)
        if n >= most:
            yield np.concatenate(some), np.array([len(x) for x in some[1:]], np.int64)
            some, n = some[:1], 0
    yield np.concatenate(some), np.array([len(x) for x in some[1:]], np.int64)


def _lists(values: np.ndarray | list, ends: list[int], kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(values, kind))


def _split(with_marks: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found: tuple[list, list, list, list] = ([], [], [], [])
                hashes, ends = [], []
                for t in part.column(1).to_pylist():
                    words = _cut(t, found)
                    if with_marks:
                        hashes.append(_hashes(words))
                    ends.append(len(found[0]))
                h1, h2 = _halves(found[0]).T
                arrays = [part.column(0), *(_lists(x, ends, kind) for x, kind in zip((h1, h2, *found[1:]), _LISTS.values()))]
                names = ["doc_id", *_LISTS]
                if with_marks:
                    of_text = [m for group in _grouped(hashes) for m in _marks(*group)]
                    ends = np.cumsum([len(m) for m, _ in of_text]).tolist()
                    arrays += [part.column(2), *(_lists(np.concatenate(x), ends, kind) for x, kind in zip(zip(*of_text), (pa.int64(), pa.int32())))]
                    names += ["text_hash", "mark", "place"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
        _hash_of.clear()  # a worker that is used again starts small

    return run


def _runs(row: dict, min_words: int) -> Iterator[tuple[int, int, int, int | None]]:
    """(first unit, last unit, words, text that keeps (part of) it) of each run of repeating units."""
    at = {no: first for no, first in zip(row["again"] or (), row["firsts"] or ())}
    kept: set[tuple[int, int]] = set()
    open_run: list[tuple[int, int]] = []  # (unit, text that keeps it)
    for no in range(len(row["start"]) + 1):
        repeats = False
        if no in at:
            d = (row["h1"][no], row["h2"][no])
            repeats = at[no] != row["doc_id"] or d in kept
            kept.add(d)
        if repeats:
            open_run.append((no, at[no]))
            continue
        if open_run and (n := sum(row["words"][i] for i, _ in open_run)) >= min_words:
            yield open_run[0][0], open_run[-1][0], n, min((f for _, f in open_run if f is not None), default=None)
        open_run = []


def _spans(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(row["rid"], row["doc_id"], row["start"][a], row["stop"][b], b - a + 1, n, first) for row in batch.to_pylist() for a, b, n, first in _runs(row, min_words)]
            names = ["rid", "doc_id", "start", "stop", "n_units", "n_words", "first_doc_id"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

    return run


_SPAN = pa.struct([(x, pa.int64()) for x in ("word", "end", "start", "stop", "n_units", "first")])
_SPAN_SQL = "array<struct<word: long, end: long, start: long, stop: long, n_units: long, first: long>>"


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of each row, by word numbers too, and its marks that may lie in a window that the runs do not cover.

    A mark's level: 0 the runs cover its windows, 1 they do not, 2 nor do they at a place a window or more after its first.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            flat, low = {}, {}
            for c in ("h1", "h2", "start", "stop", "words", "again", "firsts", "mark", "place"):
                column = part.column(part.schema.get_field_index(c))
                low[c] = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy())])
                flat[c] = column.flatten() if c == "firsts" else column.flatten().to_numpy()
            docs = part.column(part.schema.get_field_index("doc_id")).to_pylist()
            ends = np.concatenate([[0], np.cumsum(flat["words"], dtype=np.int64)])  # word numbers over all rows of the part
            begin = ends[low["words"]]
            bare = np.ones(int(ends[-1]), np.int64)
            spans: list[list[dict]] = [[] for _ in docs]
            for i in np.flatnonzero(np.diff(low["again"])).tolist():
                row = {c: x[low[c][i] : low[c][i + 1]].tolist() for c, x in flat.items() if c not in ("firsts", "mark", "place")}
                firsts = flat["firsts"].slice(low["firsts"][i], low["firsts"][i + 1] - low["firsts"][i]).to_pylist()
                first_unit = int(low["words"][i])
                for a, b, _, first in _runs({**row, "firsts": firsts, "doc_id": docs[i]}, 1):
                    word, end = int(ends[first_unit + a]), int(ends[first_unit + b + 1])
                    bare[word:end] = 0
                    mine = (word - int(begin[i]), end - int(begin[i]), row["start"][a], row["stop"][b], b - a + 1, first)
                    spans[i].append(dict(zip(("word", "end", "start", "stop", "n_units", "first"), mine)))
            before = np.concatenate([[0], np.cumsum(bare)])
            of_row = np.repeat(np.arange(len(docs)), np.diff(low["mark"]))
            mark, place = flat["mark"], flat["place"].astype(np.int64)
            bares = before[np.minimum(begin[of_row] + place + PASSAGE, begin[of_row + 1])] > before[begin[of_row] + np.maximum(place + GRAM - PASSAGE, 0)]
            order = np.lexsort((place, mark, of_row))
            of_row, mark, place, bares = of_row[order], mark[order], place[order], bares[order]
            new = np.ones(len(mark), bool)
            new[1:] = (of_row[1:] != of_row[:-1]) | (mark[1:] != mark[:-1])
            heads = np.flatnonzero(new)
            later = place >= place[heads][np.cumsum(new) - 1] + PASSAGE if len(heads) else place > 0
            levels = np.maximum.reduceat((1 + later) * bares, heads) if len(heads) else place
            stops = np.searchsorted(of_row[heads], np.arange(len(docs)), "right").tolist()
            columns = [part.column(part.schema.get_field_index(c)) for c in ("doc_id", "text_hash")]
            arrays = [_lists(mark[heads], stops, pa.int64()), _lists(levels.astype(np.int8), stops, pa.int8()), pa.array(spans, pa.list_(_SPAN))]
            yield pa.RecordBatch.from_arrays([*columns, *arrays], names=["doc_id", "text_hash", "mark", "level", "spans"])


_WINDOW_SQL = "doc_id long, text_hash long, word long, start long, stop long, h1 long, h2 long"


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows about the wanted marks of each text."""
    names = [x.split()[0] for x in _WINDOW_SQL.split(", ")]
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            docs, text_hashes, texts, wanted = (c.to_pylist() for c in batch.slice(at, 64).columns)
            done = 0
            for h, counts in _grouped([_hashes(t.lower().split()) for t in texts]):
                if len(h) >= PASSAGE:
                    begin = np.cumsum(counts) - counts
                    places, of_row, start, stop = [], [], [], []
                    for i, (mark, place) in enumerate(_marks(h, counts)):
                        chosen = np.zeros(max(0, counts[i] - PASSAGE + 1), bool)
                        for p in place[np.isin(mark, np.array(wanted[done + i], np.int64))].tolist():
                            chosen[max(0, p + GRAM - PASSAGE) : p + 1] = True
                        word = np.flatnonzero(chosen)
                        if len(word):
                            starts, stops = _spots(texts[done + i])
                            places.append(word)
                            of_row.append(np.full(len(word), i))
                            start.append(starts[word])
                            stop.append(stops[word + PASSAGE - 1])
                    if places:
                        word, row = np.concatenate(places), np.concatenate(of_row)
                        h1, h2 = (_rolled(h, PASSAGE, seed)[begin[row] + word].view(np.int64) for seed in (1, 2))
                        ids = [pa.array(x[done : done + len(counts)], pa.int64()).take(pa.array(row)) for x in (docs, text_hashes)]
                        yield pa.RecordBatch.from_arrays([*ids, *(pa.array(x, pa.int64()) for x in (word, np.concatenate(start), np.concatenate(stop), h1, h2))], names=names)
                done += len(counts)
    _hash_of.clear()


def _joined_windows(doc: int | None, windows: dict[str, np.ndarray]) -> Iterator[tuple]:
    """Spans of the windows of a row that repeat."""
    order = np.argsort(windows["word"], kind="stable")
    word, start, stop, h, first, own = (windows[c][order] for c in ("word", "start", "stop", "h", "first", "own"))
    keep = np.ones(len(word), bool)
    kept: dict[int, int] = {}
    for i in np.flatnonzero(own).tolist():  # its own text keeps it; a copy must not overlap the kept one
        keep[i] = word[i] >= kept.setdefault(int(h[i]), int(word[i])) + PASSAGE
    word, start, stop, first, own = (x[keep] for x in (word, start, stop, first, own))
    cuts = np.flatnonzero(np.diff(word) > PASSAGE) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(word)]):
        if a < b:
            sources = first[a:b] if doc is not None else first[a:b][~own[a:b]]
            yield int(word[a]), int(word[b - 1]) + PASSAGE, int(start[a]), int(stop[b - 1]), 0, int(sources.min()) if len(sources) else None


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unions of a row's runs and of its windows that repeat."""
    names = ["doc_id", "start", "stop", "n_units", "n_words", "first_doc_id"]
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            out = []
            lists = part.column(2)
            flat = lists.flatten()
            fields = {c: flat.field(c).fill_null(False if c == "own" else 0).to_numpy(zero_copy_only=False) for c in ("word", "start", "stop", "h", "first", "own")}
            low = 0
            for doc, spans, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), lists.value_lengths().fill_null(0).to_pylist()):
                all_spans = [tuple(x.values()) for x in spans]
                if n:
                    all_spans += _joined_windows(doc, {c: x[low : low + n] for c, x in fields.items()})
                    low += n
                last: list | None = None
                for word, end, start, stop, units_in, first in sorted(all_spans, key=lambda x: x[:5]):
                    if last and word <= last[1]:
                        last[1], last[3], last[4] = max(last[1], end), max(last[3], stop), last[4] + units_in
                        last[5] = min((x for x in (last[5], first) if x is not None), default=None)
                        continue
                    if last:
                        out.append((doc, last[2], last[3], last[4], last[1] - last[0], last[5]))
                    last = [word, end, start, stop, units_in, first]
                if last:
                    out.append((doc, last[2], last[3], last[4], last[1] - last[0], last[5]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(6)], names=names)


def _text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = docs[text_col].cast("string")
    return docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def _marked(split: DataFrame) -> DataFrame:
    """(rid, again, firsts) of the rows with a unit that occurs twice: the numbers of such units and the texts that keep them."""
    each = split.select("rid", "doc_id", F.posexplode(F.arrays_zip("h1", "h2")).alias("no", "h")).select("rid", "doc_id", "no", "h.h1", "h.h2")
    again = each.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).filter("n > 1").drop("n")
    again = saved(again, "substring-repeats")  # so that both sides of the join below are plain exchanges, which AQE may split
    marked = each.drop("doc_id").join(again, ["h1", "h2"])
    marked = marked.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("no", "first"))).alias("m"))
    return marked.select("rid", F.col("m.no").alias("again"), F.col("m.first").alias("firsts"))


def repeated_spans(docs: DataFrame, *, min_words: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, stop, n_units, n_words, first_doc_id) of every run of repeating units; first_doc_id keeps (part of) it."""
    rows = _text_rows(docs, id_col, text_col).drop("text_hash")
    split = saved(rows.mapInArrow(_split(False), _UNITS).withColumn("rid", F.monotonically_increasing_id()), "substring-units")
    done = split.join(_marked(split), "rid").select("rid", "doc_id", "h1", "h2", "start", "stop", "words", "again", "firsts")
    spans = done.mapInArrow(_spans(min_words), "rid long, doc_id long, start long, stop long, n_units long, n_words long, first_doc_id long")
    return spans.drop("rid")


def repeated_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, stop, n_units, n_words, first_doc_id) of every span to remove: repeating units and windows, united.

    n_units counts the whole units that repeat in it; first_doc_id keeps (part of) it.
    """
    texts = _text_rows(docs, id_col, text_col)
    split = saved(texts.mapInArrow(_split(True), _MARKED).withColumn("rid", F.monotonically_increasing_id()), "substring-units")
    done = split.join(_marked(split), "rid", "left").select("doc_id", "h1", "h2", "start", "stop", "words", "again", "firsts", "text_hash", "mark", "place")
    runs = saved(done.mapInArrow(_covered, f"doc_id long, text_hash long, mark array<bigint>, level array<tinyint>, spans {_SPAN_SQL}"), "substring-runs")

    each = runs.select("doc_id", "text_hash", F.inline(F.arrays_zip("mark", "level")))
    rank = F.struct(F.col("doc_id").isNull().alias("later_null"), "doc_id")
    wanted = each.groupBy("mark").agg(F.min(rank).alias("first"), F.max(F.when(F.col("level") > 0, rank)).alias("last"), F.max("level").alias("level"))
    wanted = wanted.filter("last > first or level = 2").select("mark")
    wanted = saved(wanted, "substring-marks")
    of_text = each.drop("level").join(small_enough(wanted), "mark").groupBy("doc_id", "text_hash").agg(F.collect_set("mark").alias("wanted"))
    of_text = saved(of_text.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), "wanted"), "substring-wanted")
    same = texts["doc_id"].eqNullSafe(of_text["d"]) & (texts["text_hash"] == of_text["t"])
    chosen = texts.join(of_text, same).select("doc_id", "text_hash", "text", "wanted")  # windows of repeated rows come twice and count as one place
    windows = saved(chosen.mapInArrow(_windows, _WINDOW_SQL), "substring-windows")
    again = windows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).filter("n > 1").drop("n")
    again = saved(again, "substring-window-repeats")
    hits = windows.join(again, ["h1", "h2"]).groupBy("doc_id", "text_hash")
    own = F.col("first").eqNullSafe(F.col("doc_id"))
    hits = hits.agg(F.collect_list(F.struct("word", "start", "stop", F.when(own, F.col("h1")).alias("h"), "first", own.alias("own"))).alias("windows"))
    hits = saved(hits.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), "windows"), "substring-window-hits")
    both = runs.join(hits, runs["doc_id"].eqNullSafe(hits["d"]) & (runs["text_hash"] == hits["t"]), "left").select("doc_id", "spans", "windows")
    both = both.filter("size(spans) > 0 or windows is not null")
    return both.mapInArrow(_merged, "doc_id long, start long, stop long, n_units long, n_words long, first_doc_id long")


def without_spans(text: str | None, spans: list[tuple[int, int]]) -> str:
    """The text without the spans (sorted, disjoint)."""
    out, at = [], 0
    for a, b in spans:
        out.append((text or "")[at:a])
        at = b
    return "".join([*out, (text or "")[at:]])
