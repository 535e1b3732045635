"""Steps over whole batches against the same over single texts, and the work they save."""

import random

import numpy as np
import pyarrow as pa

from peerscope.llm import substring_dedup

WORDS = ["a", "Bc", "de.", "f!", "Ünï", "ΟΔΟΣ", "x　y", "7kg", "tail?", "\n", "\x1f", "it's", "𝒳"]


def texts(n, seed):
    rng = random.Random(seed)
    out = [" ".join(rng.choices(WORDS, k=rng.choice([0, 3, 60, 140]))) for _ in range(n)]
    out = [t + out[i % 3] if i % 4 == 0 else t for i, t in enumerate(out)]
    return [*out, None, "", " ", "a" * 60]


def test_spots_are_those_of_split():
    for t in texts(40, 1):
        starts, stops = substring_dedup._spots(t or "")
        assert [(t or "")[a:b] for a, b in zip(starts, stops)] == (t or "").split()


def test_units_of_a_batch(monkeypatch):
    """Units and marks are those of each text by itself, and every word is lower-cased and parted once."""
    some = texts(30, 2)
    batch = pa.record_batch([pa.array(range(len(some)), pa.int64()), pa.array(some, pa.string()), pa.array(range(len(some)), pa.int64())], names=["doc_id", "text", "text_hash"])
    calls = []
    monkeypatch.setattr(substring_dedup, "_hashes", lambda words, real=substring_dedup._hashes: calls.append(len(words)) or real(words), raising=False)
    rows = pa.Table.from_batches(substring_dedup._split(True)([batch])).to_pylist()
    assert calls == [len((t or "").lower().split()) for t in some]
    for t, r in zip(some, rows):
        assert list(zip(*(r[c] for c in ("h1", "h2", "start", "stop", "words")))) == substring_dedup.units(t)
        (mark, place), = substring_dedup.marks([(t or "").lower().split()])
        assert (r["mark"], r["place"]) == (mark.tolist(), place.tolist())


def test_windows_of_a_batch():
    some = [t for t in texts(30, 3) if t and len(t.split()) >= substring_dedup.PASSAGE]
    wanted = [substring_dedup.marks([t.lower().split()])[0][0][::2] for t in some]
    make = lambda at: pa.record_batch([pa.array([i if i else None for i in at], pa.int64()), pa.array(at, pa.int64()), pa.array([some[i] for i in at]), pa.array([wanted[i].tolist() for i in at], pa.list_(pa.int64()))], names=["doc_id", "text_hash", "text", "wanted"])
    together = list(substring_dedup._windows([make(range(len(some)))]))
    assert len(together) == 1  # a batch for all, not one a text
    rows = together[0].to_pylist()
    assert rows == [r for i in range(len(some)) for b in substring_dedup._windows([make([i])]) for r in b.to_pylist()]
    for r in rows:
        words = some[r["text_hash"]].split()[r["word"] : r["word"] + substring_dedup.PASSAGE]
        assert some[r["text_hash"]][r["start"] : r["stop"]].split() == words
        assert all(np.isfinite(r[c]) for c in ("h1", "h2"))
