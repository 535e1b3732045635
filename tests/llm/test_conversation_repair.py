"""Conversation repair against plain versions: exhaustive search over edits, and a row-by-row shortest path."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from peerscope.llm import conversation_repair as C
from peerscope.llm.queries import op11_repair

SF = "/root/testdata/sf0.001"
LIKE = re.compile(r"(s?(ua)+)?\Z")
BLANK = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        word = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{word(conv)}:{word(turn)}".encode()) % 20
        role, text = word(role), word(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        if not text.strip(BLANK):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if text.rstrip(BLANK)[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def shortest(rows, found):
    """(cost, audit, repaired rows) by a path over rows and role states."""
    steps = {("n", "s"): "s", ("n", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    names = {"u": "user", "a": "assistant"}

    def close(at):
        while True:
            new = dict(at)
            for q, (cost, audit, made) in at.items():
                for i in "ua":
                    if (to := steps.get((q, i))) is not None:
                        now = (cost + 5, audit + "I", made + ((names[i], ""),))
                        new[to] = min(new.get(to, now), now)
            if new == at:
                return at
            at = new

    at = close({"n": (0, "", ())})
    for (role, text), fault in zip(rows, found):
        new = {}
        for q, (cost, audit, made) in at.items():
            ways = [(2, "D", q, ())]
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                ways += [(extra, "K", steps.get((q, role[:1])), ((role, text),))] if role else []
                ways += [(1 + extra, "R", steps.get((q, i)), ((names[i], text),)) for i in "ua"]
            for more, edit, to, row in ways:
                if to is not None:
                    now = (cost + more, audit + edit, made + row)
                    new[to] = min(new.get(to, now), now)
        at = close(new)
    return min(at[q] for q in "na" if q in at)


def plain(rows):
    """Rows of op11 by id from (conv_id, turn, role, text) rows."""
    ids = {r[0] for r in rows}
    rows, out = damage(rows), {}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest())
    for i in ids:
        own = sorted((r for r in rows if r[0] == i), key=order)
        pairs = [(r[2], r[3]) for r in own]
        found = faults(pairs)
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        cost, audit, made = shortest(pairs, found)
        text = "\n".join(f"{a}:{b}" for a, b in made)
        out[i] = (gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def by_id(df):
    rows = df.collect()
    assert len(rows) == len({r.conv_id for r in rows})
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}


def table(spark, rows):
    full = [(*r, "x", 1, b"d", "k") for r in rows]
    return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, audit string, n long, digest binary, kind string")


def spark_result(spark, rows):
    t = table(spark, rows)
    return by_id(C.repair(C.damaged(t), ids=t))


def test_cells_against_all_edit_strings():
    """Every sequence of edits with at most three insertions over every three symbols."""
    names = {"u": "u", "a": "a"}
    for n in range(4):
        for symbols in itertools.product("suaoSUAOx", repeat=n):
            if n == 3 and hash(symbols) % 7:
                continue
            best = None
            per_row = [[("D", 2, "")] + ([] if s == "x" else [("R", 1 + 5 * s.isupper(), i) for i in names] + ([("K", 5 * s.isupper(), s.lower())] if s.lower() != "o" else [])) for s in symbols]
            for edits in itertools.product(*per_row):
                base = sum(e[1] for e in edits)
                if best is not None and base > best[0]:
                    continue
                for where in itertools.chain.from_iterable(itertools.combinations_with_replacement(range(n + 1), k) for k in range(4)):
                    cost = base + 5 * len(where)
                    if best is not None and cost > best[0]:
                        continue
                    slots = [where.count(k) for k in range(n + 1)]
                    for roles in itertools.product("ua", repeat=len(where)):
                        it = iter(roles)
                        word = audit = ""
                        for k in range(n + 1):
                            word += "".join(next(it) for _ in range(slots[k]))
                            audit += "I" * slots[k]
                            if k < n:
                                word, audit = word + edits[k][2], audit + edits[k][0]
                        if LIKE.match(word) and (best is None or (cost, audit) < best):
                            best = (cost, audit)
            stack = C.SpanStack()
            if symbols:
                stack.push("".join(symbols))
            assert C.best(stack.cells()) == best, symbols


def test_long_spans_split_anywhere():
    rng = random.Random(5)
    for n in (1, 7, 8, 9, 40, 257):
        word = "".join(rng.choice("suaoSUAx") for _ in range(n))
        whole = C.SpanStack()
        for i in range(0, n, C.SHORT_SPAN):
            whole.push(word[i : i + C.SHORT_SPAN])
        by_row = C.insertions()
        for s in word:
            by_row = C.combine(by_row, C.short_cells(s))
        assert whole.cells() == by_row


def test_query_against_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert by_id(op11_repair(spark, SF)) == plain(rows)


EDGES = [
    (None, None, None, None),
    (None, 1, "user", "a text."),
    (1, None, "user", "no turn."),
    (1, None, "system", "no turn either."),
    (1, 5, "user", "a"),
    (1, 5, "user", "a"),
    (1, 5, "assistant", "a."),
    (2, 3, "", "no role."),
    (2, 4, " ", "blank role."),
    (2, 5, "Über", "other role."),
    (3, 0, "system", ""),
    (3, 1, "user", " \x0b\t"),
    (4, 7, None, "role is missing."),
    (5, 1, "assistant", "cut off \U0001f600"),
    (6, -3, "user", "negative turn."),
    (6, 9, "assistant", "z" * 300_000 + "."),
]


def test_odd_rows(spark):
    assert spark_result(spark, EDGES) == plain(EDGES)
    everything = [(i, t, role, text) for i in range(40) for t, (role, text) in enumerate([("system", "s."), ("user", "u"), ("assistant", "a."), ("user", "u")] * (i % 4))]
    assert spark_result(spark, everything) == plain(everything)


def test_no_rows(spark):
    assert spark_result(spark, []) == {}
    empty = hashlib.sha256(b"").hexdigest()
    t = table(spark, [(7, 1, "user", "x.")])
    assert by_id(C.repair(t.filter("false"), ids=t)) == {7: (0, 0, 0, 0, 0, 0, "", empty)}


@pytest.fixture()
def narrow_parts(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_one_conversation_over_many_partitions(spark, narrow_parts):
    """A conversation that holds a third of the rows is cut, parsed in pieces and combined; repeats a third of its rows."""
    rng = random.Random(3)
    hot = [(9, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"text {t}.", "the same.", "cut", ""])) for t in range(900)]
    rows = hot + [(i, t, "user" if t % 2 == 0 else "assistant", f"{i} {t}.") for i in range(300) for t in range(6) if i != 9]
    assert spark_result(spark, rows) == plain(rows)
    pieces = C.ordered(C.damaged(table(spark, rows)))
    parts = C._faults(pieces).repartitionByRange(*C.KEYS).filter("conv_id = 9").select(F.spark_partition_id()).distinct().count()
    assert parts > 1


def test_pieces_in_several_rounds(spark, narrow_parts, monkeypatch):
    monkeypatch.setattr(C, "FAN_IN", 2)
    rows = [(1, t, "user" if t % 3 else "assistant", f"text {t}.") for t in range(400)]
    assert spark_result(spark, rows) == plain(rows)


def test_repaired_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()] + EDGES
    t = C.damaged(table(spark, rows))
    made = {}
    for r in sorted(C.repaired_rows(t).collect(), key=lambda r: r.place):
        made.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    want = plain(rows)
    for i, row in want.items():
        assert hashlib.sha256("\n".join(made.get(i, [])).encode()).hexdigest() == row[-1]
        assert LIKE.match("".join(x[0] for x in made.get(i, [])))
