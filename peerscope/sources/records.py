"""Delimited records that span lines, found in parallel.

A quoted field may hold line breaks, so whether a line begins a record depends
on everything before it in its file.  Each line is a step between two states,
outside a quoted field and inside one, and steps compose:

1. every line's step is computed by itself (a built-in aggregate over the
   line's pieces between separators; lines without a quote change nothing);
2. each split of a file (block) adds up to one step and two counts of records,
   one per state it may begin in: a row per block;
3. a window over a file's blocks gives each block the state that it begins in,
   and where the record that runs into it began;
4. with that, every line knows its record: records of one line are rows as
   they are, the lines of the others meet by (file, block, number).

No file is read by one task, and only the lines of broken records are
shuffled.  Steps 2 and 4 run through a split's lines in scan order, in Arrow
batches with a loop over the lines that hold a quote.

Lines end with a line feed (a carriage return before it is dropped at the end
of a record, kept inside one).  A quote opens a field only at its beginning;
quotes are doubled inside a field.  A file that ends inside a quoted field
stops the read by its name, rather than becoming one record.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peerscope.operators.materialize import materialize

#: Most blocks (some 100 bytes each) whose table is broadcast; beyond it the join is shuffled.
BROADCAST_BLOCKS = 500_000

#: Bits of a line's step: state after it if it begins outside, inside; nothing but a line end.
_AFTER_OUT, _AFTER_IN, _BLANK = 1, 2, 4
_SAME = _AFTER_IN  # a line without a quote


def _step(value: Column, sep: str) -> Column:
    """The step of a line as bits; ``value`` without its line end."""
    pieces = F.split(value, "\\Q" + sep + "\\E", -1)

    def after(state: int) -> Column:
        def piece(inside: Column, text: Column) -> Column:
            odd = (F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))) % 2 == 1
            return F.when(inside, ~odd).otherwise(text.startswith('"') & odd)

        return F.aggregate(pieces, F.lit(bool(state)), piece)

    bits = F.when(after(0), _AFTER_OUT).otherwise(0) + F.when(after(1), _AFTER_IN).otherwise(0)
    return F.when(value.contains('"'), bits).otherwise(F.lit(_SAME) + F.when(F.trim(value) == "", _BLANK).otherwise(0))


def file_lines(spark: SparkSession, path: str | Sequence[str], skip: int = 0, sep: str = ",") -> DataFrame:
    """(file, block, skip, value, step) of every line in scan order; ``skip``: lines of this block to pass over."""
    lines = spark.read.options(lineSep="\n", recursiveFileLookup=True).text(path if isinstance(path, str) else list(path))
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    if skip:
        per_block = lines.groupBy("file", "block").agg(F.count("*").alias("n"))
        before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        tops = per_block.withColumn("skip", F.least(F.lit(skip) - before, F.col("n")).cast("int")).filter("skip > 0").select("file", "block", "skip")
        tops = materialize(tops)  # a row or so per file: broadcast, so that lines stay in scan order
        lines = lines.join(F.broadcast(tops), ["file", "block"], "left")
    else:
        lines = lines.withColumn("skip", F.lit(None).cast("int"))
    return lines.select("file", "block", F.coalesce("skip", F.lit(0)).alias("skip"), "value", _step(F.rtrim("value", F.lit("\r")), sep).alias("step"))


class _Run:
    """Numbers of the lines of one block, for both states that it may begin in."""

    def __init__(self, skip: int) -> None:
        self.skip, self.at = skip, 0
        self.state, self.records, self.broken = [0, 1], [0, 0], [False, False]

    def lines(self, step: np.ndarray) -> dict[str, np.ndarray]:
        """Per line: kept, and for h in 0, 1 the state before (in), after (end) and the number of its record (rec, -1: begun in a block before)."""
        n = len(step)
        kept = np.arange(self.at, self.at + n) >= self.skip
        self.at += n
        step = np.where(kept, step, _SAME | _BLANK)
        breaks = np.flatnonzero((step & 3) != _SAME)
        lengths = np.diff(np.concatenate([[0], breaks + 1, [n]]))
        out: dict[str, np.ndarray] = {"kept": kept}
        codes = step[breaks].tolist()
        for h in (0, 1):
            state, states = self.state[h], [self.state[h]]
            for code in codes:
                state = (code >> state) & 1
                states.append(state)
            before = np.repeat(np.array(states, np.int8), lengths)
            after = before.copy()
            after[breaks] = states[1:]
            begins = (before == 0) & ((step & _BLANK) == 0)
            out[f"in{h}"], out[f"end{h}"] = before, after
            out[f"rec{h}"] = self.records[h] + np.cumsum(begins) - 1
            self.state[h], self.records[h] = state, self.records[h] + int(begins.sum())
            self.broken[h] |= bool((kept & ((before == 1) | (after == 1))).any())
        return out


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, _Run, pa.RecordBatch]]:
    """Slices of one block each, in scan order, with the block's run (the same object until the block ends)."""
    key, run = None, None
    for batch in batches:
        files, blocks = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
        which = files.indices.to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero((which[1:] != which[:-1]) | (blocks[1:] != blocks[:-1])) + 1, [len(blocks)]])
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            now = (files.dictionary[which[a]].as_py(), int(blocks[a]))
            if now != key:
                key, run = now, _Run(batch.column("skip")[a].as_py())
            yield key, run, batch.slice(a, b - a)


_BLOCKS = "file string, block long, end0 int, end1 int, records0 long, records1 long, broken0 boolean, broken1 boolean"


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: dict[tuple, _Run] = {}
    for key, run, rows in _runs(batches):
        run.lines(rows.column("step").to_numpy())
        done[key] = run
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
    schema = pa.schema(list(zip(["file", "block", "end0", "end1", "records0", "records1", "broken0", "broken1"], kinds)))
    rows = [dict(zip(schema.names, (*key, *run.state, *run.records, *run.broken))) for key, run in done.items()]
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


def blocks(lines: DataFrame) -> DataFrame:
    """(file, block, inside, records, owner, number, head, broken, final) per block: the state it begins in, its records, and the
    block and number of the record that runs into it; ``head``: the block holds the file's first record; ``broken``: some of
    its lines are not whole records; ``final``: the state that the file ends in."""
    steps = materialize(lines.select("file", "block", "skip", "step").mapInArrow(_block_rows, _BLOCKS))
    in_file = Window.partitionBy("file").orderBy("block")  # one row per block of one file
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    # a block is a step of two states: constant, the same, or the other; the last constant one and the swaps since decide
    swaps = F.sum(F.when((F.col("end0") == 1) & (F.col("end1") == 0), 1).otherwise(0))
    fixed = F.col("end0") == F.col("end1")
    rows = steps.withColumn("swaps", swaps.over(in_file.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.last(F.when(fixed, F.struct("end0", "swaps")), ignorenulls=True)
    state = (F.coalesce(F.col("last.end0"), F.lit(0)) + F.coalesce(F.col("swaps_before"), F.lit(0)) - F.coalesce(F.col("last.swaps"), F.lit(0))) % 2
    rows = rows.withColumns({"last": last.over(before), "swaps_before": F.last("swaps").over(before)}).withColumn("inside", state.cast("int"))
    rows = rows.withColumn("records", F.when(F.col("inside") == 1, F.col("records1")).otherwise(F.col("records0")))
    own = F.when(F.col("records") > 0, F.struct(F.col("block").alias("block"), (F.col("records") - 1).alias("number")))
    ends = F.when(F.col("inside") == 1, F.col("end1")).otherwise(F.col("end0"))
    rows = rows.withColumns({
        "owner": F.last(own, ignorenulls=True).over(before),
        "end": ends,
        "seen": F.coalesce(F.sum("records").over(before), F.lit(0)),
        "final": F.last(ends).over(in_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    })
    return rows.select("file", "block", "inside", "records", F.col("owner.block").alias("owner"), F.col("owner.number").alias("number"), ((F.col("seen") == 0) & (F.col("records") > 0)).alias("head"), F.when(F.col("inside") == 1, F.col("broken1")).otherwise(F.col("broken0")).alias("broken"), "final")


_LINES = "file string, block long, at long, value string, in0 int, in1 int, end0 int, end1 int, rec0 long, rec1 long"


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, run, rows in _runs(batches):
        first = run.at
        found = run.lines(rows.column("step").to_numpy())
        cols = [rows.column("file"), rows.column("block"), pa.array(np.arange(first, run.at, dtype=np.int64)), rows.column("value")]
        cols += [pa.array(found[f"{k}{h}"].astype(np.int32)) for k in ("in", "end") for h in (0, 1)]
        cols += [pa.array(found[f"rec{h}"].astype(np.int64)) for h in (0, 1)]
        names = ["file", "block", "at", "value", "in0", "in1", "end0", "end1", "rec0", "rec1"]
        yield pa.RecordBatch.from_arrays(cols, names=names).filter(pa.array(found["kept"]))


def spans_lines(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> bool:
    """Some line, begun outside a quoted field, ends inside one: else every line is a record (one job, no Python)."""
    lines = spark.read.options(lineSep="\n", recursiveFileLookup=True).text(path if isinstance(path, str) else list(path))
    value = F.rtrim("value", F.lit("\r"))
    return not lines.filter(F.col("value").contains('"')).filter(_step(value, sep).bitwiseAND(_AFTER_OUT) == 1).isEmpty()


class Records:
    """The lines of delimited files and, from one pass over them, the states and records of their blocks."""

    def __init__(self, spark: SparkSession, path: str | Sequence[str], skip: int = 0, sep: str = ",") -> None:
        self.lines = file_lines(spark, path, skip, sep)
        starts = materialize(blocks(self.lines))
        first, bad = (F.min(F.when(c, F.col("file"))) for c in (F.col("head"), F.col("final") == 1))
        facts = starts.agg(F.count("*").alias("n"), F.coalesce(F.bool_or("broken"), F.lit(False)).alias("broken"), first.alias("first"), bad.alias("bad")).first()
        if facts["bad"] is not None:
            raise ValueError(f"unbalanced quote: {facts['bad']} ends inside a quoted field")
        self.broken, self.first = facts["broken"], facts["first"]
        self.starts = starts.drop("final", "broken")
        self.few = facts["n"] <= BROADCAST_BLOCKS

    def first_text(self) -> str | None:
        """The first record of the first file in name order; only the blocks that hold it are put together."""
        of_file = F.col("file") == F.lit(self.first)
        at = self.starts.filter(of_file & (F.col("records") > 0)).orderBy("block").select("block").limit(2).collect()  # its end may lie in the next block
        if not at:
            return None
        within = of_file & (F.col("block") >= at[0]["block"])
        lines = self.lines.filter(within & (F.col("block") <= at[1]["block"]) if len(at) > 1 else within)
        return self._of(lines).filter("head").select("value").collect()[0]["value"]

    def all(self) -> DataFrame:
        """(file, head, value) of every record."""
        return self._of(self.lines)

    def _of(self, lines: DataFrame) -> DataFrame:
        starts = F.broadcast(self.starts) if self.few else self.starts
        rows = lines.mapInArrow(_line_rows, _LINES).join(starts, ["file", "block"])
        pick = lambda name: F.when(F.col("inside") == 1, F.col(f"{name}1")).otherwise(F.col(f"{name}0"))
        value = F.rtrim("value", F.lit("\r"))
        rows = rows.select("file", "block", "at", "value", "owner", "number", "head", pick("in").alias("in"), pick("end").alias("end"), pick("rec").alias("rec"))
        whole = rows.filter("in = 0 and end = 0").filter(F.trim(value) != "")
        whole = whole.select("file", (F.col("head") & (F.col("rec") == 0)).alias("head"), value.alias("value"))
        if not self.broken:  # every line is a record: the lines are not read again for parts of records
            return whole
        parts = rows.filter("in = 1 or end = 1")
        carried = F.col("rec") < 0
        parts = parts.select(
            "file",
            F.when(carried, F.col("owner")).otherwise(F.col("block")).alias("from"),
            F.when(carried, F.col("number")).otherwise(F.col("rec")).alias("rec"),
            F.struct("block", "at", "value").alias("line"),
            (F.col("head") & (F.col("rec") == 0)).alias("head"),
        )
        joined = parts.groupBy("file", "from", "rec").agg(F.array_sort(F.collect_list("line")).alias("lines"), F.bool_or("head").alias("head"))
        broken = joined.select("file", "head", F.rtrim(F.array_join(F.transform("lines", lambda x: x["value"]), "\n"), F.lit("\r")).alias("value"))
        return whole.unionByName(broken)


def read_records(spark: SparkSession, path: str | Sequence[str], skip: int = 0, sep: str = ",") -> DataFrame:
    """(file, head, value): the records of delimited files, whole quoted fields included, blank lines between records left out.

    ``skip`` lines at the top of each file are passed over, whatever they
    hold; ``head`` marks the first record of each file.
    """
    return Records(spark, path, skip, sep).all()
