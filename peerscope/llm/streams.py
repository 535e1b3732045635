"""Sorted streams of bucket rows: members of shared buckets, their blocks and cells, and groups of equal keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shared_buckets(block_rows: int) -> Callable:
    """Rows (key, rid, at), sorted by key and rid -> (key, rid, at, block) of the buckets with two members or more.

    Repeats of (key, rid) count once.  Members are numbered as they come and
    ``block_rows`` of them make a block, so a bucket of any size is a stream.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, before_rid, count, held = None, None, 0, None  # the open bucket: key, last member, members so far, its only row
        for batch in batches:
            if not batch.num_rows:
                continue
            key, rid, at = (batch.column(i).to_numpy() for i in range(3))
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (rid[1:] != rid[:-1])
            new[0] = key[0] != last or rid[0] != before_rid
            before_rid, end = rid[-1], key[-1]
            key, rid, at = key[new], rid[new], at[new]
            if not len(key):
                continue
            starts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
            lengths = np.diff(np.append(starts, len(key)))
            before = np.zeros(len(starts), np.int64)
            goes_on = key[0] == last
            if goes_on:
                before[0] = count
            total = lengths + before
            which = np.repeat(np.arange(len(starts)), lengths)
            place = np.arange(len(key)) - starts[which] + before[which]
            mask = total[which] >= 2
            out = [key[mask], rid[mask], at[mask], place[mask] // block_rows]
            if goes_on and held is not None:
                out = [np.concatenate([[h], o]) for h, o in zip((*held, 0), out)]
            last, count = end, int(total[-1])
            held = (key[-1], rid[-1], at[-1]) if count == 1 else None
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.int32()))], names=["key", "rid", "at", "block"])

    return run


def cells(met: DataFrame) -> DataFrame:
    """Rows of ``shared_buckets`` dealt to cells (key, i <= j): each two blocks of a bucket, and each block by itself, meet in one."""
    most = met.filter("block > 0").groupBy("key").agg(F.max("block").alias("most"))
    dealt = met.join(most, "key", "left").withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("most", F.lit(0)))))
    return dealt.select("key", "rid", "at", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows that agree in ``keys``, from batches sorted by them; the caller bounds their size."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rest.append(batch)
        table = pa.Table.from_batches(rest).combine_chunks()
        change = np.zeros(table.num_rows, bool)
        for k in keys:
            x = table.column(k).to_numpy()
            change[1:] |= x[1:] != x[:-1]
        cuts = np.concatenate([[0], np.flatnonzero(change)])
        for a, b in zip(cuts, cuts[1:]):
            yield table.slice(a, b - a)
        rest = table.slice(cuts[-1]).to_batches()
    if rest:
        yield pa.Table.from_batches(rest)
