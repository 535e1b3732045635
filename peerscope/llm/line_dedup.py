"""Line dedup: exact copies by digest, near copies by a segment-partition edit join.

A line is a ``\\n``-separated piece without the white space around it.  Lines of
fewer than ``min_chars`` code points are left alone unless ``short`` is given:
then every line with a character counts, and a pair is near within one edit
for each ``min_chars // edits`` code points of its shorter line, ``edits`` at
most (2 from 32, 1 from 16, exact copies below).  Equal lines are one
class, ranked by their first place (document id, line number); the first place
stays and the others go.  A class within ``edits`` edits of an earlier ranked
class goes as a whole.

The edit join: a line is split into edits + 1 segments of even length.  Two
lines within ``edits`` edits share one segment of the shorter line as a
substring of the longer one at a place that the lengths and the segment's
number bound (multi-match-aware places), so lines meet on (length, segment
number, substring hash).  Lines that meet are verified by a banded bit-parallel
edit distance: edits + 1 machine words hold the reachable diagonals.

Scale: classes are combined map-side.  Buckets are read as sorted streams,
dealt out in blocks of at most ``BLOCK`` lines and compared block by block; a
cell reports for each line only its earliest partner, so a group of mutual
near copies yields one row a line and not all its pairs.  Bucket rows carry 63
bits of the digest; the text is fetched only for lines that share a bucket.
Keys that select texts are broadcast only up to ``common.BROADCAST_KEYS``.

Defined results: a null or empty text has no lines; a null document id ranks
after all others; rows that share an id are one rank (equal lines of theirs at
the same line number both stay); repeated rows give repeated results; other
columns are passed through by ``without_repeats`` and not read otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import free_name, saved, small_enough
from peerscope.llm.streams import cells, shared_buckets, sorted_groups
from peerscope.llm.worker import claim

EDITS = 2
MIN_CHARS = 32
BLOCK = 1024
SEEN = 500_000  # lines a task remembers


def lines_of(text: str | None, min_chars: int) -> Iterator[tuple[int, int, str]]:
    """(number, start, line) of each line of at least min_chars code points, its outer white space stripped."""
    at = 0
    for number, raw in enumerate((text or "").split("\n")):
        line = raw.strip()
        if len(line) >= min_chars:
            yield number, at + raw.index(line[0]), line
        at += len(raw) + 1


def line_digest(line: str) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(line)
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, size) of the edits + 1 segments of a line; later ones take the remainder."""
    k = edits + 1
    small, larger = divmod(length, k)
    sizes = [small] * (k - larger) + [small + 1] * larger
    return [(sum(sizes[:i]), s) for i, s in enumerate(sizes)]


def allowed(shorter: int, edits: int, per: int) -> int:
    """Edits between a line of this length and one as long or longer: one for each ``per`` code points, ``edits`` at most (all if per is 0)."""
    return min(edits, shorter // per) if per else edits


def places(length: int, edits: int, per: int = 0) -> tuple[list[tuple[int, int, int]], int]:
    """(seed, start, size) of each substring under which a line of this length meets others; the first (its edits + 1) are its own segments."""
    own, probes = [], []
    most = edits
    for shorter in range(length, max(0 if per else most, length - most - 1), -1):
        extra, edits = length - shorter, allowed(shorter, most, per)
        if extra > edits or not edits and per:
            continue
        for i, (p, size) in enumerate(segments(shorter, edits)):
            seed = shorter << 8 | i
            low = max(0, p - i, p + extra - (edits - i))
            high = min(length - size, p + i, p + extra + (edits - i))
            for at in range(low, high + 1):
                (own if shorter == length and at == p else probes).append((seed, at, size))
    return own + probes, len(own)


def within(a: str, b: str, edits: int) -> bool:
    """Edit distance of a and b is at most ``edits``: banded, one word of diagonals for each number of edits."""
    if abs(len(a) - len(b)) > edits:
        return False
    low, high = 0, min(len(a), len(b))  # strip the common beginning and end
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    a, b = a[low:], b[low:]
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[len(a) - mid :] == b[len(b) - mid :] else (low, mid - 1)
    a, b = a[: len(a) - low], b[: len(b) - low]
    n, m = len(a), len(b)
    if not n or not m:
        return max(n, m) <= edits
    band = (1 << (2 * edits + 1)) - 1  # bit d: place j of b stands at place j + d - edits of a
    reach = [0] * (edits + 1)
    reach[0] = 1 << edits
    for e in range(1, edits + 1):
        reach[e] = reach[e - 1] | reach[e - 1] << 1 & band
    for j in range(m):
        match = 0
        for d in range(2 * edits + 1):
            i = j + d - edits
            if 0 <= i < n and a[i] == b[j]:
                match |= 1 << d
        before, now = 0, 0
        for e in range(edits + 1):
            was = reach[e]
            # equal letters, a letter of b put in or another one (one edit fewer before), a letter of a left out
            now = was & match | (before | before >> 1 | now << 1 if e else 0)
            reach[e], before = now & band, was
            now = reach[e]
        if not reach[edits]:
            return False
    d = n - m + edits
    return bool(reach[edits] >> d & 1)


_LINES = "doc_id long, text_hash long, n_lines long, number array<int>, start array<int>, stop array<int>, h1 array<bigint>, h2 array<bigint>, keys array<array<bigint>>"


def _split(edits: int, min_chars: int, per: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("lines")
        seen: set[int] = set()  # a task's repeated lines carry their keys once
        memo: dict[int, list[tuple[int, int, int]]] = {}
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                n_lines, number, start, stop, h1, h2, keys = ([] for _ in range(7))
                for text in part.column(2).to_pylist():
                    row = list(lines_of(text, min_chars))
                    digests = [line_digest(x) for _, _, x in row]
                    n_lines.append(text.count("\n") + 1 if text else 0)
                    number.append([x[0] for x in row])
                    start.append([x[1] for x in row])
                    stop.append([x[1] + len(x[2]) for x in row])
                    h1.append([d[0] for d in digests])
                    h2.append([d[1] for d in digests])
                    of_row = []
                    for (_, _, x), (d, _) in zip(row, digests):
                        if d in seen:
                            of_row.append(None)
                            continue
                        if len(seen) >= SEEN:
                            seen.clear()  # a line that comes again carries its keys again
                        seen.add(d)
                        if (where := memo.get(len(x))) is None:
                            if len(memo) > 10_000:
                                memo.clear()
                            where = memo[len(x)] = places(len(x), edits, per)[0]
                        of_row.append([digest(x[p : p + size], seed) - (1 << 63) for seed, p, size in where])
                    keys.append(of_row)
                ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
                arrays = [pa.array(n_lines, pa.int64()), *(pa.array(x, ints) for x in (number, start, stop)), pa.array(h1, longs), pa.array(h2, longs), pa.array(keys, pa.list_(longs))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *arrays], names=["doc_id", "text_hash", "n_lines", "number", "start", "stop", "h1", "h2", "keys"])

    return run


def _texts(min_chars: int) -> Callable:
    """Wanted lines of each text: (id, h1, h2, line)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                wanted = set(ids)
                for _, _, line in lines_of(text, min_chars):
                    d = line_digest(line)
                    if d[0] >> 1 in wanted:
                        wanted.discard(d[0] >> 1)
                        out.append((d[0] >> 1, *d, line))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["rid", "h1", "h2", "line"])

    return run


def _letters(line: str) -> np.ndarray:
    """How often the code points of each of 32 kinds occur."""
    return np.bincount(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32) & 31, minlength=32).astype(np.int32)


def _partners(edits: int, per: int) -> Callable:
    """For each line of a cell the earliest ranked line within the edits, if it is earlier: (h1, h2, partner's place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, ["key", "i", "j"]):
            rows = [tuple(r.values()) for r in g.select(["later_null", "first_doc", "first_line", "h1", "h2", "block", "own", "line"]).to_pylist()]
            # nulls rank last; the digest breaks ties of rows that share an id
            rows = sorted(set(rows), key=lambda r: (r[0], r[1] or 0, r[2], r[3], r[4]))
            i, j = g["i"][0].as_py(), g["j"][0].as_py()
            block, own = np.array([r[5] for r in rows]), np.array([r[6] for r in rows])
            length, letters = np.array([len(r[7]) for r in rows]), np.array([_letters(r[7]) for r in rows])
            out = []
            for y in range(1, len(rows)):
                b = rows[y]
                may = (np.abs(length[:y] - length[y]) <= edits) & (own[:y] | own[y])
                if i != j:
                    may &= block[:y] != block[y]
                x = np.flatnonzero(may)
                # an edit changes the counts of two letters by one at most
                x = x[np.abs(letters[x] - letters[y]).sum(1) <= 2 * edits]
                for a in map(rows.__getitem__, x.tolist()):
                    if (a[3], a[4]) != (b[3], b[4]) and within(a[7], b[7], allowed(min(len(a[7]), len(b[7])), edits, per)):
                        out.append((b[3], b[4], a[1], a[2]))
                        break
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(4)], names=["h1", "h2", "near_doc", "near_line"])

    return run


def _text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = docs[text_col].cast("string")
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def repeated_lines(docs: DataFrame, *, edits: int = EDITS, min_chars: int = MIN_CHARS, short: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_lines, n_exact, n_near, removed) per row of ``docs``.

    ``removed`` lists the lines to remove in order: number, start, stop (code
    points, end exclusive), kind (exact or near) and the document that keeps
    the earlier line.
    """
    if min_chars <= edits:
        raise ValueError("min_chars must exceed edits")
    least, per = (1, min_chars // edits if edits else 0) if short else (min_chars, 0)
    texts = _text_rows(docs, id_col, text_col)
    split = saved(texts.mapInArrow(_split(edits, least, per), _LINES).withColumn("row", F.monotonically_increasing_id()), "line-sets")
    each = split.select("row", "doc_id", F.inline(F.arrays_zip("number", "start", "stop", "h1", "h2")))
    place: Column = F.struct(F.col("doc_id").isNull().alias("later_null"), F.col("doc_id").alias("first_doc"), F.col("number").alias("first_line"))
    classes = saved(each.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(place).alias("p")).select("h1", "h2", "n", "p.*"), "line-classes")

    keyed = split.select(F.explode(F.arrays_zip("h1", "keys")).alias("x")).filter("x.keys is not null")
    keyed = keyed.select("x.h1", F.posexplode("x.keys").alias("at", "key"))
    # rid: 63 bits of the digest and, as the last bit, whether the key is one of the line's own segments
    rows = keyed.select("key", F.expr(f"shiftleft(shiftright(h1, 1), 1) | if(at <= {edits}, 1, 0)").alias("rid"), F.lit(0).cast("long").alias("at"))
    met = rows.repartition("key").sortWithinPartitions("key", "rid").mapInArrow(shared_buckets(BLOCK), "key long, rid long, at long, block int")
    met = saved(met, "line-buckets")
    ids = met.select(F.expr("shiftright(rid, 1)").alias("rid")).distinct()
    wanted = classes.withColumn("rid", F.expr("shiftright(h1, 1)")).join(ids, "rid")
    wanted = saved(wanted, "line-wanted")
    from_docs = small_enough(saved(wanted.groupBy("first_doc").agg(F.collect_set("rid").alias("rids")), "line-documents"), wanted.count())
    lines = texts.join(from_docs, texts["doc_id"].eqNullSafe(from_docs["first_doc"])).select("text", "rids")
    lines = lines.mapInArrow(_texts(least), "rid long, h1 long, h2 long, line string").dropDuplicates(["h1", "h2"])
    known = saved(wanted.drop("n").join(lines.drop("rid"), ["h1", "h2"]), "line-texts")
    rich = cells(met).withColumns({"own": F.expr("rid & 1 = 1"), "rid": F.expr("shiftright(rid, 1)")}).join(known, "rid").drop("at", "rid")
    near = rich.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_partners(edits, per), "h1 long, h2 long, near_doc long, near_line long")
    near = near.groupBy("h1", "h2").agg(F.min(F.struct(F.col("near_doc").isNull().alias("later_null"), "near_doc", "near_line"))["near_doc"].alias("near_doc"), F.lit(True).alias("near"))

    gone = classes.join(near, ["h1", "h2"], "left").filter("n > 1 or near").select("h1", "h2", "first_doc", "first_line", "near", "near_doc")
    gone = saved(gone, "line-repeats")  # so that both sides of the join below are plain exchanges, which AQE may split
    hits = each.join(gone, ["h1", "h2"])
    first = F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("number") == F.col("first_line"))
    hits = hits.withColumn("kind", F.when(~first, "exact").when(F.col("near"), "near")).filter("kind is not null")
    keeper = F.when(F.col("kind") == "exact", F.col("first_doc")).otherwise(F.col("near_doc"))
    removed = hits.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("number", "start", "stop", "kind", keeper.alias("keeper")))).alias("removed"))
    out = split.select("row", "doc_id", "text_hash", "n_lines").join(removed, "row", "left")
    many = lambda kind: F.coalesce(F.size(F.filter("removed", lambda x: x["kind"] == kind)), F.lit(0)).cast("long")
    return out.select("doc_id", "text_hash", "n_lines", many("exact").alias("n_exact"), many("near").alias("n_near"), F.coalesce("removed", F.array().cast(removed.schema["removed"].dataType)).alias("removed"))


def _cut(text_index: int, spans_index: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, left = [], []
            for text, spans in zip(batch.column(text_index).to_pylist(), batch.column(spans_index).to_pylist()):
                if spans:
                    gone = {x["number"] for x in spans}
                    text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
                out.append(text)
                left.append(not spans or bool(text.strip()))
            columns = [pa.array(out, pa.string()) if i == text_index else c for i, c in enumerate(batch.columns) if i != spans_index]
            yield pa.RecordBatch.from_arrays(columns, names=[n for i, n in enumerate(batch.schema.names) if i != spans_index]).filter(pa.array(left, pa.bool_()))

    return run


def without_repeats(docs: DataFrame, *, edits: int = EDITS, min_chars: int = MIN_CHARS, short: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated lines cut from ``text_col``; rows whose lines have all gone are dropped."""
    spans = repeated_lines(docs, edits=edits, min_chars=min_chars, short=short, id_col=id_col, text_col=text_col).filter("size(removed) > 0")
    name = free_name(docs, "removed")
    spans = spans.select(F.col("doc_id").alias(f"{name}_id"), F.col("text_hash").alias(f"{name}_hash"), F.col("removed").alias(name)).dropDuplicates([f"{name}_id", f"{name}_hash"])
    same = (F.xxhash64(docs[text_col].cast("string")) == spans[f"{name}_hash"]) & docs[id_col].cast("long").eqNullSafe(spans[f"{name}_id"])
    joined = docs.join(spans, same, "left").select(*(docs[c] for c in docs.columns), spans[name])
    return joined.mapInArrow(_cut(docs.columns.index(text_col), len(docs.columns)), docs.schema)
