"""N-gram Jaccard self-join by parity sketches.

Texts link when num * |union| <= den * |intersection| of their shingle sets.

1. Sketch.  In a size band whose pairs differ in at most d shingles, every
   shingle belongs to one of m > d positions.  A set's sketch holds the parity
   of its shingles at each of some bits, and at each position the XOR of its
   shingles' hashes.  A shingle in which two sets differ changes at most one
   bit and one position, so the Hamming distance of the bits, and the number
   of unequal positions, are no more than the symmetric difference.
2. Pigeonhole.  At most d positions differ, so at least m - d are equal: sets
   are joined on (band, position, XOR).  m - d is one more than the empty
   positions that a set may leave out, so those many equal ones need no join.
3. Bands overlap: band k holds the sizes that a pair with its smaller set in
   [start_k, start_k+1) can have, so each linked pair shares a band.
4. Sets of a bucket are compared by the size and Hamming bounds.  First only
   stars are candidates: from the set with most neighbours down, a set is
   joined to its neighbours that no star has yet, so a bucket of any number of
   near copies gives fewer candidates than members.  They are verified on the
   whole texts' shingle sets and contracted to components.
5. Then the neighbours in different components are candidates, each pair at
   its first common position only (sets of over ``FULL_WORDS`` positions do
   not carry them; their pairs are made distinct), and are verified as well.
   A linked pair is thus verified or already connected: no component is split.

Equal sets are one class before step 1, so copies cost one row each.  Buckets
are read as sorted streams and compared in blocks of at most ``BLOCK`` sets;
longer ones are dealt out block by block, and a set with many candidates is
verified in several salted groups.  Identities are 128-bit digests and shingle
hashes are 64 bits wide.  Keys that select rows are broadcast only up to
``common.BROADCAST_KEYS`` rows, else the join is shuffled.

Defined results: a null or empty text, or one without words, has an empty set
and is linked with nothing, itself its component; a null id is carried and
sorts after all others (a class of null ids only has a null component);
repeated rows give repeated results; rows that share an id but not a text are
different members; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import saved, small_enough
from peerscope.llm.components import components
from peerscope.llm.shingles import digest, forget, shingle_set
from peerscope.llm.streams import cells, shared_buckets, sorted_groups
from peerscope.llm.worker import claim

GROWTH = 1.25  # of band starts
BLOCK = 1024  # sets of a bucket that are compared at once
FULL_WORDS = 64  # most positions, and most parity words, that a bucket row carries
SEEN = 200_000  # sets a task remembers
SALT_PAIRS = 500  # candidates of one set that are verified in one group


@dataclass(frozen=True)
class Threshold:
    """Jaccard similarity of at least num / den."""

    num: int = 90
    den: int = 100
    width: int = 3

    def partner(self, n: int) -> int:
        """Size of the largest set that one of size n can link with."""
        return n * self.den // self.num

    def apart(self, a, b):
        """Most shingles in which linked sets of sizes a and b differ."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)


@lru_cache(maxsize=256)
def _band(t: Threshold, k: int) -> tuple[int, int, int, int, int]:
    """(start, next start, positions, empty positions that may be left out, parity words) of band k."""
    start = 1 if k == 0 else _band(t, k - 1)[1]
    after = max(start + 1, int(start * GROWTH))
    d = t.apart(after - 1, t.partner(after - 1))
    empty = 1.1 * (d + 1) * math.exp(-start / (1.1 * (d + 1)))  # as many as the smallest sets are likely to have
    spare = math.ceil(empty + 4 * empty**0.5) + 1
    return start, after, d + 1 + spare if d else 0, spare, min(FULL_WORDS, max(6, -(-after // 24)))


def bands_of(t: Threshold, n: int) -> list[tuple[int, int, int, int]]:
    """(band, positions, spare, parity words) of each band with a place for sets of size n; bands whose pairs are equal sets have none."""
    out, k = [], 0
    while n and (b := _band(t, k))[0] <= n:
        if b[2] and n <= t.partner(b[1] - 1):
            out.append((k, *b[2:]))
        k += 1
    return out


def sketch(hashes: np.ndarray, m: int, parity_words: int) -> tuple[np.ndarray, np.ndarray]:
    """XOR of the hashes at each of m positions, and the shingles' parity at each of 64 parity_words bits."""
    xors = np.zeros(m, np.uint64)
    np.bitwise_xor.at(xors, ((hashes >> np.uint64(32)) % np.uint64(m)).astype(np.int64), hashes)
    bits = 64 * parity_words
    odd = (np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return xors, np.packbits(odd, bitorder="little").view("<u8")


_SETS = "doc_id long, n long, d1 long, d2 long, bands array<struct<band:int,spare_zeros:boolean,words:array<bigint>,parity:array<bigint>>>"
_BANDS = pa.list_(pa.struct([("band", pa.int32()), ("spare_zeros", pa.bool_()), ("words", pa.list_(pa.int64())), ("parity", pa.list_(pa.int64()))]))


def _sets(t: Threshold) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("shingles", forget)
        seen: set[tuple[int, int]] = set()  # a task's copies carry their sketch once
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows: list[list] = [[], [], [], []]
                for text in part.column(1):
                    h = shingle_set(text.as_py(), t.width)
                    d = digest(h)
                    bands = None
                    if len(h) and d not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()  # a copy that comes again carries its sketch again
                        seen.add(d)
                        bands = []
                        for k, m, spare, bits in bands_of(t, len(h)):
                            w, parity = sketch(h, m, bits)
                            bands.append({"band": k, "spare_zeros": int((w == 0).sum()) <= spare, "words": w.view(np.int64), "parity": parity.view(np.int64)})
                    for column, x in zip(rows, (len(h), *d, bands)):
                        column.append(x)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, pa.int64()) for x in rows[:3]), pa.array(rows[3], _BANDS), *part.columns[2:]], names=["doc_id", "n", "d1", "d2", "bands", *part.schema.names[2:]])
        forget()

    return run


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    return flat.reshape(len(lists), len(flat) // len(lists))


def _neighbours(t: Threshold, g: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """(x, ys): for each row of a cell the rows after it that pass the bounds (of two blocks, those of the other)."""
    i, j = g["i"][0].as_py(), g["j"][0].as_py()
    block, rid, n, parity = g["block"].to_numpy(), g["rid"].to_numpy(), g["n"].to_numpy(), _matrix(g["parity"])
    left = np.flatnonzero(block == i)
    right = left if i == j else np.flatnonzero(block == j)
    for x in left:
        y = right[right > x] if i == j else right
        y = y[(t.partner(np.minimum(n[x], n[y])) >= np.maximum(n[x], n[y])) & (rid[y] != rid[x])]
        y = y[np.bitwise_count(parity[y] ^ parity[x]).sum(1) <= t.apart(n[x], n[y])]
        if len(y):
            yield x, y


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _stars(t: Threshold) -> Callable:
    """Pairs (a < b) of each cell that join every row with a neighbour to one star."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, ["key", "i", "j"]):
            rid = g["rid"].to_numpy()
            near = np.zeros((len(rid), len(rid)), bool)  # at most 2 * BLOCK rows make a cell
            for x, ys in _neighbours(t, g):
                near[x, ys] = near[ys, x] = True
            degree = near.sum(1)
            free = degree > 0
            for x in np.lexsort((rid, -degree))[: int(free.sum())]:
                if free[x]:
                    free[x] = False
                    new = np.flatnonzero(near[x] & free)
                    if not len(new):
                        new = np.flatnonzero(near[x])[:1]  # all its neighbours are in other stars
                    free[new] = False
                    yield _pairs(rid[new], rid[x])

    return run


def _across(t: Threshold) -> Callable:
    """Neighbours of each cell in different components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_groups(batches, ["key", "i", "j"]):
            component = g["component"].to_numpy()
            if (component == component[0]).all():
                continue
            at = g["at"][0].as_py() & 0xFFFFFFFF
            rid, n, words, spare = g["rid"].to_numpy(), g["n"].to_numpy(), _matrix(g["words"]), g["spare_zeros"].to_numpy()
            for x, y in _neighbours(t, g):
                y = y[component[y] != component[x]]
                if len(y) and words.shape[1]:
                    equal = words[y] == words[x]
                    differ = words.shape[1] - equal.sum(1)
                    equal &= (words[x] != 0) | (~spare[x] & ~spare[y])[:, None]
                    y = y[(equal.argmax(1) == at) & (differ <= t.apart(n[x], n[y]))]
                if len(y):
                    yield _pairs(rid[y], rid[x])

    return run


def _hashes(width: int) -> Callable:
    """Sorted shingle hashes of the rows whose text is the one that was asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid, out = [], []
            for r, text, d1, d2 in zip(*(batch.column(i) for i in range(4))):
                h = shingle_set(text.as_py(), width)
                if digest(h) == (d1.as_py(), d2.as_py()):
                    rid.append(r.as_py())
                    out.append(h.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), pa.array(out, pa.binary())], names=["rid", "hashes"])
        forget()

    return run


def _verify(t: Threshold) -> Callable:
    """Links among the pairs of a leader with the members that follow it; a stream, one member at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, mine = None, np.empty(0, np.uint64)
        for batch in batches:
            links = []
            for a, role, rid, data in zip(*(batch.column(c) for c in ("a", "role", "rid", "hashes"))):
                h = np.frombuffer(data.as_py(), np.uint64)
                if role.as_py() == 0:
                    leader, mine = a.as_py(), h
                    continue
                assert leader == a.as_py()
                both = len(np.intersect1d(mine, h, assume_unique=True))
                if t.den * both >= t.num * (len(mine) + len(h) - both):
                    links.append((leader, rid.as_py()))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["a", "b"])

    return run


def _chosen(df: DataFrame, ids: DataFrame, on: list[str]) -> DataFrame:
    """Inner join with ``ids``, which are broadcast only if few."""
    ids = small_enough(ids)
    matched = F.lit(True)
    for c in on:
        matched = matched & df[c].eqNullSafe(ids[c])
    return df.join(ids, matched).select(*(df[c] for c in df.columns), *(ids[c] for c in ids.columns if c not in df.columns))


def shingled(docs: DataFrame, t: Threshold, id_col: str = "doc_id", text_col: str = "text", with_hash: bool = False) -> DataFrame:
    """(rid, doc_id, n, d1, d2, bands, and text_hash if asked for): one row per row of ``docs``, written once; rid numbers the rows."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").cast("binary").alias("text"), *([F.xxhash64(docs[text_col].cast("string")).alias("text_hash")] if with_hash else []))
    return saved(rows.mapInArrow(_sets(t), _SETS + (", text_hash long" if with_hash else "")).withColumn("rid", F.monotonically_increasing_id()), "jaccard-sets")


def shared_positions(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(met, folds): the class representatives' rows in buckets with two sets or more, and their sketches by band."""
    carrying = sets.filter("bands is not null")
    lead = sets.filter("n > 0").groupBy("d1", "d2").agg(F.min(F.when(F.col("bands").isNotNull(), F.col("rid"))).alias("lead"))
    copies = saved(carrying.select("d1", "d2", "rid").join(lead, ["d1", "d2"]).filter("rid <> lead").select("rid"), "jaccard-copies")
    leaders = carrying.select("rid", "n", "bands").join(small_enough(copies), "rid", "left_anti")
    by_band = leaders.select("rid", F.explode("bands").alias("s"))
    by_word = by_band.select("rid", F.col("s.band").alias("band"), F.col("s.spare_zeros").alias("spare_zeros"), F.posexplode("s.words").alias("place", "word"))
    rows = by_word.filter("word <> 0 or not spare_zeros").select(F.xxhash64("band", "place", "word").alias("key"), "rid", F.expr("shiftleft(cast(band as bigint), 32) | place").alias("at"))
    met = rows.repartition("key").sortWithinPartitions("key", "rid").mapInArrow(shared_buckets(BLOCK), "key long, rid long, at long, block int")
    met = saved(met, "jaccard-buckets")
    folds = _chosen(carrying.select("rid", "n", "bands"), saved(met.select("rid").distinct(), "jaccard-met"), ["rid"])
    folds = folds.select("rid", "n", F.explode("bands").alias("s")).select(
        "rid", "n", F.col("s.band").alias("band"), "s.spare_zeros", F.when(F.size("s.words") <= FULL_WORDS, F.col("s.words")).otherwise(F.array().cast("array<bigint>")).alias("words"), "s.parity"
    )
    return met, saved(folds, "jaccard-sketches")


def _compared(met: DataFrame, folds: DataFrame, columns: list[str], compare: Callable, name: str) -> DataFrame:
    """Distinct pairs that ``compare`` finds in the cells of ``met``, whose rows get ``columns`` of ``folds``."""
    dealt = cells(met).withColumn("band", F.expr("cast(shiftright(at, 32) as int)"))
    rich = dealt.join(folds.select("rid", "band", *columns), ["rid", "band"]).select("key", "i", "j", "block", "at", "rid", *columns)
    rich = rich.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return saved(rich.mapInArrow(compare, "a long, b long").distinct(), name)


def linked_pairs(docs: DataFrame, sets: DataFrame, t: Threshold, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b): verified links of class representatives, enough to connect every linked pair."""
    met, folds = shared_positions(sets)
    stars = _compared(met, folds, ["n", "parity"], _stars(t), "jaccard-stars")
    links = saved(verified(docs, sets, stars, t, id_col, text_col), "jaccard-star-links")
    label = components(links).withColumnRenamed("node", "rid")
    label = saved(folds.select("rid").distinct().join(label, "rid", "left").withColumn("component", F.coalesce("component", "rid")), "jaccard-labels")
    mixed = met.join(label, "rid").groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("key")
    open_cells = saved(met.join(mixed, "key", "left_semi"), "jaccard-open")
    across = _compared(open_cells, folds.join(label, "rid"), ["n", "parity", "words", "spare_zeros", "component"], _across(t), "jaccard-across")
    return saved(links.unionByName(verified(docs, sets, across, t, id_col, text_col)), "jaccard-links")


def verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame, t: Threshold, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pairs whose whole texts' sets reach the threshold."""
    ids = pairs.select(F.col("a").alias("rid")).union(pairs.select("b")).distinct()
    wanted = saved(sets.select("rid", "doc_id", "d1", "d2").join(ids, "rid"), "jaccard-wanted")
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").cast("binary").alias("text"))
    texts = _chosen(texts, wanted, ["doc_id"]).select("rid", "text", "d1", "d2").mapInArrow(_hashes(t.width), "rid long, hashes binary")
    texts = saved(texts.dropDuplicates(["rid"]), "jaccard-hashes")
    many = pairs.groupBy("a").agg(F.count("*").alias("pairs"))
    salted = pairs.join(many, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.ceil(F.col("pairs") / SALT_PAIRS)))
    roles = salted.select("a", "salt", F.lit(1).alias("role"), F.col("b").alias("rid")).union(salted.select("a", "salt", F.lit(0), F.col("a")).distinct())
    return roles.join(texts, "rid").repartition("a", "salt").sortWithinPartitions("a", "salt", "role").select("a", "role", "rid", "hashes").mapInArrow(_verify(t), "a long, b long")


def link_components(docs: DataFrame, t: Threshold = Threshold(), id_col: str = "doc_id", text_col: str = "text", with_hash: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``: component_id is the smallest id reachable by links.

    ``with_hash`` adds ``text_hash`` (xxhash64 of the text), which tells rows that share an id apart.
    """
    sets = shingled(docs, t, id_col, text_col, with_hash)
    names = ["text_hash"] if with_hash else []
    found = components(linked_pairs(docs, sets, t, id_col, text_col)).withColumnRenamed("node", "rid")
    classes = sets.filter("n > 0").groupBy("d1", "d2").agg(F.min(F.when(F.col("bands").isNotNull(), F.col("rid"))).alias("rid"), F.min("doc_id").alias("first_id"))
    classes = saved(classes.join(found, "rid", "left").withColumn("component", F.coalesce("component", "rid")), "jaccard-classes")
    least = classes.groupBy("component").agg(F.min("first_id").alias("component_id"))
    classes = classes.join(least, "component").select("d1", "d2", "component_id")
    classes = saved(classes, "jaccard-components")  # so that both sides of the join below are plain exchanges, which AQE may split
    rows = sets.select("doc_id", "n", "d1", "d2", *names).join(classes, ["d1", "d2"], "left")
    return rows.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        *names,
    )
