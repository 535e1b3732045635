import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from peerscope.llm import bpe
from peerscope.llm.queries import op2_bpe

tokenizers = pytest.importorskip("tokenizers")
PATH = bpe.default_vocabulary()
THEIRS = tokenizers.Tokenizer.from_file(PATH)
OURS = bpe.load(PATH)


def same(text):
    ids = THEIRS.encode(text, add_special_tokens=False).ids
    packed = OURS.encode(text)
    return bpe.unpack(packed) == ids and OURS.decode(packed) == THEIRS.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["", " ", "a  b", "a\n\nB c", "don't we'll  \xa0 x", "à la  à", "a<|endoftext|> b<|endoftext|>", "\t\ta \r\n b", "¿'s é's 日本語 teXt123", "x\x1c 's\x1c\x1cy\x85 z", "a" * 5000, "é" * 3000, "ab" * 700, "😀👩‍👩‍👧", "the&&& end.%%% \n"])
def test_special_shapes(text):
    assert same(text)


def test_random_mixtures():
    rnd = random.Random(7)
    letters = [*"ab's re 't\n\t é日¿.,=12  \xa0\x1c\x85àÀ×÷&", "<|endoftext|>", " the", "ing"]
    assert all(same("".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40)))) for _ in range(5000))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert same(text)


def test_forced_pairs_occur_in_no_token():
    for token in list(OURS.token.values())[:5000]:
        assert all(OURS.inside[a, b] for a, b in zip(token, token[1:]))


def test_whole_table_and_edges(spark, edge, nothing):
    coded = bpe.decode(bpe.encode(edge.withColumn("ids", edge.n)))
    assert [c for c in coded.columns if c not in edge.columns] == ["ids", "decoded"]
    rows = coded.collect()
    assert len(rows) == edge.count()
    for r in rows:
        assert bpe.unpack(r.ids) == THEIRS.encode(r.text or "", add_special_tokens=False).ids and r.decoded == (r.text or "")
    assert bpe.decode(bpe.encode(nothing)).count() == 0 and bpe.round_trip(nothing).count() == 0
    assert bpe.round_trip(edge).exceptAll(coded.select(*edge.columns, "ids", "decoded")).count() == 0


def test_query(spark):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = op2_bpe(spark, d).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = THEIRS.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_every_forced_pair_of_a_text_is_a_cut():
    """Cuts are where the table says, in texts of any length; no fragment holds a pair that no token holds, but at the exceptions."""
    for text in ("zq xkj vw.Qz 5a", "日本語 text, été.", "a?'s b", "x" * 40 + "\u0142q" * 30):
        fragments = OURS.fragments(text)
        assert b"".join(fragments) == text.encode()
        for f in fragments:
            for a, b in zip(f, f[1:]):
                assert OURS.inside[a, b] or a in b" \n" or b == 0x27 or b & 0xC0 == 0x80
    assert len(OURS.fragments("zq")) == (1 if OURS.inside[ord("z"), ord("q")] else 2)


def test_cuts_are_made_on_the_corpus(spark):
    """The table cuts texts of the corpus more often than blanks do."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(50).collect()]
    assert sum(len(OURS.fragments(t)) for t in texts) > sum(len(t.split()) for t in texts)


def test_ids_beyond_twenty_bits(tmp_path):
    """Pairs of large ids don't clash."""
    import json

    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, far = spec["model"]["vocab"], 1 << 20
    spec["model"]["vocab"] = {t: i + far for t, i in vocab.items()}
    path = tmp_path / "far.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    theirs, ours = tokenizers.Tokenizer.from_file(str(path)), bpe.ByteBPE(str(path))
    for text in ("the quick brown fox", "don't we'll  \xa0 x", "a\n\nB c 12345"):
        assert bpe.unpack(ours.encode(text)) == theirs.encode(text, add_special_tokens=False).ids


def test_a_worker_holds_the_tables_of_one_operator():
    from peerscope.llm import worker

    table = {"a": 1}
    worker.claim("one", table.clear)
    worker.claim("one", table.clear)
    assert table
    worker.claim("two")
    assert not table and list(worker._held) == ["two"]
