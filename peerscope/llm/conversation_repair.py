"""Conversation structure repair: weighted CYK parsing of conversations over spans.

A conversation is the sequence of its rows by turn (nulls first, then role,
then SHA-256 of the text).  A repair keeps, re-roles or deletes every row and
may insert rows with empty texts, so that the roles' initials read
``(s?(ua)+)?``; it is the cheapest one, ties by the least audit (the edits'
initials K, R, D, I in order).

Grammar, in Chomsky normal form: X(p, r) -> X(p, q) X(q, r) over the states of
the pattern (nothing yet, after s, after u, after a); X(p, q) -> row for every
edit of a row; the start symbols are X(nothing, nothing) and X(nothing, a).  A
cell holds, for a span of rows and each X(p, q), the least (cost, audit); cells
are closed under insertions on both sides.  Spans are combined bottom-up by
length.  The pattern is regular, so a cell does not depend on where its span is
split, and only spans of doubling length are filled; least audits stay least
when joined, because two audits of one cost and span never begin one another.

Spark: (1) rows are narrowed to role, digest and faults, repeats found by an
aggregate over (conversation, role, digest) joined back; (2) the narrow rows
are range-partitioned by conversation and turn and parsed as a sorted stream,
so a conversation of any size is cut over partitions, with one cell table per
piece; (3) the pieces of cut conversations are combined in groups of at most
``FAN_IN``, until one is left; (4) the audits meet the full rows, sorted by
conversation, in a stream that applies the edits.  Step 4 holds one row and one
audit at a time; that one task streams a whole conversation there is due to the
digest, which is one SHA-256 over it.

Defined results: null role, text, conversation or turn count as one blank where
the text of a row or of its damage key is asked for; a null conversation is a
conversation; a role without characters has no initial and can't be kept;
repeated rows are rows (all but the first are duplicates); rows of one turn come
by role, then SHA-256 of the text; a conversation without rows gives zeros, an
empty audit and the digest of nothing; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.llm.common import saved

# fixed values of the contract: costs of the edits
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"

#: States of the role pattern and its steps by role initial.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
STEPS = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ENDS = (NOTHING, ASSISTANT)
#: Rows parsed through the table of short spans.
SHORT_SPAN = 8
#: Most pieces of a conversation that one group combines.
FAN_IN = 64

Cell = tuple[int, str] | None
Cells = tuple[Cell, ...]  # of one span: X(p, q) at 4 p + q


# ------------------------------------------------------------ cells of spans


def combine(a: Cells, b: Cells) -> Cells:
    """Cells of two spans that follow each other: X(p, r) -> X(p, q) X(q, r)."""
    out: list[Cell] = []
    for p in STATES:
        for r in STATES:
            least = None
            for q in STATES:
                x, y = a[4 * p + q], b[4 * q + r]
                if x is not None and y is not None and (least is None or x[0] + y[0] <= least[0]):
                    now = (x[0] + y[0], x[1] + y[1])
                    least = now if least is None else min(least, now)
            out.append(least)
    return tuple(out)


def _unit(of: dict[int, dict[int, tuple[int, str]]]) -> Cells:
    return tuple(of.get(p, {}).get(q) for p in STATES for q in STATES)


@lru_cache(maxsize=1)
def insertions() -> Cells:
    """Cells of the empty span, closed: any number of inserted user and assistant rows."""
    step = {p: {p: (0, "")} for p in STATES}
    for initial in "ua":
        for p, q in STEPS[initial].items():
            step[p][q] = (INSERT, "I")
    out = _unit(step)
    while (more := combine(out, out)) != out:
        out = more
    return out


def _row_cells(symbol: str) -> Cells:
    """Cells of one row; the symbol is x if it must go, else its initial (o: any other), in upper case if truncated."""
    of: dict[int, dict[int, tuple[int, str]]] = {p: {p: (DELETE, "D")} for p in STATES}
    if symbol != "x":
        extra = TRUNCATED if symbol.isupper() else 0
        for initial, cost, edit in (("u", REROLE, "R"), ("a", REROLE, "R"), (symbol.lower(), KEEP, "K")):
            for p, q in STEPS.get(initial, {}).items():
                old, now = of[p].get(q), (cost + extra, edit)
                of[p][q] = now if old is None else min(old, now)
    return combine(combine(insertions(), _unit(of)), insertions())


@lru_cache(maxsize=8192)
def short_cells(symbols: str) -> Cells:
    """Cells of a short span, by halves (the table is bounded; other spans of the task fill it anew)."""
    if len(symbols) == 1:
        return _row_cells(symbols)
    half = len(symbols) // 2
    return combine(short_cells(symbols[:half]), short_cells(symbols[half:]))


class SpanStack:
    """Cells of the spans read so far, lengths doubling: two of a length become one."""

    def __init__(self) -> None:
        self.spans: list[tuple[int, Cells]] = []

    def push(self, symbols: str) -> None:
        self._add(0 if len(symbols) == SHORT_SPAN else -1, short_cells(symbols))

    def _add(self, level: int, cells: Cells) -> None:
        while level >= 0 and self.spans and self.spans[-1][0] == level:
            cells = combine(self.spans.pop()[1], cells)
            level += 1
        self.spans.append((level, cells))

    def cells(self) -> Cells:
        out = None
        for _, cells in reversed(self.spans):
            out = cells if out is None else combine(cells, out)
        return insertions() if out is None else out


def best(cells: Cells) -> tuple[int, str]:
    """The least (cost, audit) of the start symbols."""
    return min(c for c in (cells[4 * NOTHING + q] for q in ENDS) if c is not None)


# --------------------------------------------------------------- Spark side


def ordered(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, digest, blank, truncated) of the rows, nulls of role and text as one blank."""
    text = F.coalesce(rows["text"].cast("string"), F.lit(" "))
    body = F.rtrim(text, F.lit(BLANKS))
    return rows.select(
        rows["conv_id"].cast("long").alias("conv_id"),
        rows["turn"].cast("long").alias("turn"),
        F.coalesce(rows["role"].cast("string"), F.lit(" ")).alias("role"),
        text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        (body == "").alias("blank"),
        (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )


KEYS = ["conv_id", "turn", "role", "digest"]


def _faults(rows: DataFrame) -> DataFrame:
    """Distinct narrow rows with ``n`` and the symbol of the first of them; the others are duplicates."""
    narrow = rows.groupBy(*KEYS, "blank", "truncated").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("turn").isNotNull(), F.col("turn").alias("turn")))
    seen = narrow.groupBy(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d")).agg(first["turn"].alias("_first"))
    on = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d"))
    initial = F.left("role", F.lit(1))
    symbol = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    repeat = ~F.col("turn").eqNullSafe(F.col("_first"))
    fault = F.when(F.col("blank"), "blank").when(repeat, "duplicate").when(F.col("truncated"), "truncated").otherwise("")
    symbol = F.when(fault == "truncated", F.upper(symbol)).when(fault == "", symbol).otherwise("x")
    return narrow.join(seen, on).select(*KEYS, "n", fault.alias("fault"), symbol.alias("symbol"))


PIECE = "conv_id long, part int, whole boolean, blank long, duplicate long, truncated long, cells array<struct<at:int,cost:long,audit:string>>"
_PIECE_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("whole", pa.bool_()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64())]
    + [("cells", pa.list_(pa.struct([("at", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))]
)


def _listed(cells: Cells) -> list[dict]:
    return [{"at": i, "cost": c[0], "audit": c[1]} for i, c in enumerate(cells) if c is not None]


def _cells(listed: list[dict]) -> Cells:
    out: list[Cell] = [None] * 16
    for c in listed:
        out[c["at"]] = (c["cost"], c["audit"])
    return tuple(out)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted narrow rows of a partition -> one piece per conversation; those between its first and last one are whole."""
    done: list[dict] = []
    open_id, part, first = object(), 0, True
    stack, symbols, counts = SpanStack(), "", [0, 0, 0]

    def piece(whole: bool) -> dict:
        if symbols:
            stack.push(symbols)
        cells = stack.cells()
        if whole:
            cost, audit = best(cells)
            kept = [{"at": 0, "cost": cost, "audit": audit}]
        else:
            kept = _listed(cells)
        return {"conv_id": open_id, "part": part, "whole": whole, "blank": counts[0], "duplicate": counts[1], "truncated": counts[2], "cells": kept}

    for batch in batches:
        for conv, n, fault, symbol, at in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "n", "fault", "symbol", "part"))):
            if conv != open_id:
                if stack.spans or symbols:
                    done.append(piece(whole=not first))
                    first = False
                    if len(done) >= 2000:
                        yield pa.RecordBatch.from_pylist(done, schema=_PIECE_ARROW)
                        done = []
                open_id, part, stack, symbols, counts = conv, at, SpanStack(), "", [0, 0, 0]
            if fault == "blank":
                counts[0] += n
            else:
                counts[1] += n - (fault != "duplicate")
                counts[2] += fault == "truncated"
            while n:
                room = min(n, SHORT_SPAN - len(symbols))
                symbols += symbol + "x" * (room - 1)
                symbol, n = "x", n - room
                if len(symbols) == SHORT_SPAN:
                    stack.push(symbols)
                    symbols = ""
    if stack.spans or symbols:
        done.append(piece(whole=False))
    if done:
        yield pa.RecordBatch.from_pylist(done, schema=_PIECE_ARROW)


def _combine_pieces(key: tuple, pieces: pa.Table) -> pa.Table:
    """One piece, numbered by its group, of at most FAN_IN consecutive pieces of a conversation."""
    rows = sorted(pieces.to_pylist(), key=lambda r: r["part"])
    cells = _cells(rows[0]["cells"])
    for r in rows[1:]:
        cells = combine(cells, _cells(r["cells"]))
    total = {k: sum(r[k] for r in rows) for k in ("blank", "duplicate", "truncated")}
    out = {"conv_id": rows[0]["conv_id"], "part": key[1].as_py(), "whole": False, **total, "cells": _listed(cells)}
    return pa.Table.from_pylist([out], schema=_PIECE_ARROW)


def parses(rows: DataFrame) -> DataFrame:
    """(conv_id, blank, duplicate, truncated, cost, audit) of every conversation of ``ordered`` rows."""
    dealt = _faults(rows).repartitionByRange(*KEYS).sortWithinPartitions(*KEYS)
    dealt = dealt.select("conv_id", "n", "fault", "symbol", F.spark_partition_id().alias("part"))
    pieces = saved(dealt.mapInArrow(_parse, PIECE), "repair-pieces")
    cut = pieces.filter("not whole")
    parts = (pieces.agg(F.max("part")).first()[0] or 0) + 1
    while True:  # as often as FAN_IN goes into the number of partitions
        cut = saved(cut.groupBy("conv_id", F.expr(f"cast(part div {FAN_IN} as int)")).applyInArrow(_combine_pieces, PIECE), "repair-cut")
        parts = -(-parts // FAN_IN)
        if parts <= 1:
            break
    ends = F.filter("cells", lambda c: c["at"].isin([4 * NOTHING + q for q in ENDS]))
    least = lambda cells: F.array_min(F.transform(cells, lambda c: F.struct(c["cost"].alias("cost"), c["audit"].alias("audit"))))
    found = pieces.filter("whole").withColumn("best", least(F.col("cells"))).unionByName(cut.withColumn("best", least(ends)))
    return found.select("conv_id", "blank", "duplicate", "truncated", "best.cost", "best.audit")


def _walk(audit: str) -> Iterator[str]:
    """The edit letters of an audit with the role that a re-roled or inserted row gets (the state after a kept row comes by ``send``)."""
    state = NOTHING
    for edit in audit:
        if edit in "RI":
            initial = "a" if state == USER else "u"
            state = STEPS[initial][state]
            yield edit + initial
        elif edit == "K":
            kept = yield edit
            state = STEPS[kept][state]
        else:
            yield edit


ROLE = {"u": "user", "a": "assistant"}


class _Edits:
    """The edits of one conversation, applied row by row; rows are None after an edit that drops them."""

    def __init__(self, audit: str) -> None:
        self.steps = _walk(audit)
        self.next = next(self.steps, None)

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.next is not None and self.next[0] == "I":
            step, self.next = self.next, next(self.steps, None)
            yield "I", ROLE[step[1]], ""

    def row(self, role: str, text: str) -> tuple[str, str, str] | None:
        step = self.next
        if step == "K":
            try:
                self.next = self.steps.send(role[0])
            except StopIteration:
                self.next = None
            return "K", role, text
        self.next = next(self.steps, None)
        return None if step == "D" else ("R", ROLE[step[1]], text)


def _with_audits(rows: DataFrame, ids: DataFrame, found: DataFrame) -> DataFrame:
    """Ids, audits and rows in one table, all of a conversation in one partition, in this order."""
    none = lambda t: F.lit(None).cast(t)
    head = ids.select(ids["conv_id"].cast("long").alias("conv_id")).distinct().select(
        "conv_id", F.lit(0).alias("kind"), none("long").alias("turn"), none("string").alias("role"), none("binary").alias("digest"), none("string").alias("text"), none("string").alias("audit")
    )
    audits = found.select("conv_id", F.lit(1).alias("kind"), none("long").alias("turn"), none("string").alias("role"), none("binary").alias("digest"), none("string").alias("text"), "audit")
    body = rows.select("conv_id", F.lit(2).alias("kind"), "turn", "role", "digest", "text", none("string").alias("audit"))
    both = head.unionByName(audits).unionByName(body)
    order = ["conv_id", "kind", "turn", "role", "digest"]
    return both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "kind", "turn", "role", "text", "audit")


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "kind", "turn", "role", "text", "audit")))


SUMMARY = "conv_id long, gaps long, illegal long, repaired_rows long, repaired_sha256 string"
_SUMMARY_ARROW = pa.schema([("conv_id", pa.int64()), ("gaps", pa.int64()), ("illegal", pa.int64()), ("repaired_rows", pa.int64()), ("repaired_sha256", pa.string())])


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: list[dict] = []
    for conv, items in _conversations(_stream(batches)):
        digest, out_rows = hashlib.sha256(), 0
        low = high = last = before = None
        turns, illegal, edits = 0, 0, _Edits("")

        def put(made) -> int:
            digest.update((("\n" if out_rows else "") + f"{made[1]}:{made[2]}").encode("utf-8", "surrogatepass"))
            return out_rows + 1

        for _, kind, turn, role, text, audit in items:
            if kind == 1:
                edits = _Edits(audit)
            if kind != 2:
                continue
            if turn is not None:
                low, high, turns, last = (turn if low is None else low), turn, turns + (turn != last), turn
            if before is not None and before + role[:1] not in ("su", "ua", "au"):
                illegal += 1
            before = role[:1]
            for made in edits.inserted():
                out_rows = put(made)
            if (made := edits.row(role, text)) is not None:
                out_rows = put(made)
        for made in edits.inserted():
            out_rows = put(made)
        gaps = 0 if low is None else high - low + 1 - turns
        done.append({"conv_id": conv, "gaps": gaps, "illegal": illegal, "repaired_rows": out_rows, "repaired_sha256": digest.hexdigest()})
        if len(done) >= 5000:
            yield pa.RecordBatch.from_pylist(done, schema=_SUMMARY_ARROW)
            done = []
    if done:
        yield pa.RecordBatch.from_pylist(done, schema=_SUMMARY_ARROW)


def _conversations(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(id, its rows) of a sorted stream; the rows of one must be read before the next is asked for."""
    held = next(rows, None)

    def own(conv) -> Iterator[tuple]:
        nonlocal held
        while held is not None and held[0] == conv:
            now, held = held, next(rows, None)
            yield now

    while held is not None:
        yield held[0], own(held[0])


REPAIRED = "conv_id long, place long, edit string, turn long, role string, text string"
_REPAIRED_ARROW = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    done: list[tuple] = []
    flush = lambda: pa.RecordBatch.from_pylist([dict(zip(_REPAIRED_ARROW.names, r)) for r in done], schema=_REPAIRED_ARROW)
    for conv, items in _conversations(_stream(batches)):
        place, edits = 0, _Edits("")
        for _, kind, turn, role, text, audit in items:
            if kind == 1:
                edits = _Edits(audit)
            if kind != 2:
                continue
            for made in (*edits.inserted(), edits.row(role, text)):
                if made is not None:
                    done.append((conv, place, made[0], None if made[0] == "I" else turn, made[1], made[2]))
                    place += 1
            if len(done) >= 1000:
                yield flush()
                done = []
        for made in edits.inserted():
            done.append((conv, place, made[0], None, made[1], made[2]))
            place += 1
    if done:
        yield flush()


def repaired_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, edit, turn, role, text): the rows of every repaired conversation."""
    rows = ordered(conversations)
    found = saved(parses(rows), "repair-audits")
    return _with_audits(rows, conversations, found).mapInArrow(_repaired, REPAIRED)


def repair(conversations: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Per conversation: faults, cost and audit of the cheapest repair, and the digest of its rows.

    (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_rows,
    repaired_sha256); ``ids`` (a table with ``conv_id``) names the conversations
    to return, those of the rows by default.
    """
    rows = ordered(conversations)
    found = saved(parses(rows), "repair-audits")
    summary = _with_audits(rows, ids if ids is not None else conversations, found).mapInArrow(_summaries, SUMMARY)
    facts = found.withColumnRenamed("conv_id", "_conv")
    both = summary.join(facts, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return both.select(
        "conv_id", "gaps", zero("blank"), zero("duplicate"), zero("truncated"), "illegal", zero("cost"), F.coalesce("audit", F.lit("")).alias("audit"), "repaired_rows", "repaired_sha256"
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the contract's damage by crc32(``conv_id:turn``) % 20."""
    c = conversations
    word = lambda x: F.coalesce(c[x].cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    rows = c.select(c["conv_id"].cast("long").alias("conv_id"), c["turn"].cast("long").alias("turn"), word("role").alias("role"), word("text").alias("text"), kind.alias("kind"))
    rows = rows.filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies).drop("copy")
