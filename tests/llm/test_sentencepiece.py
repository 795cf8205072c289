import hashlib
import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2 as proto

from tidemark.llm import sentencepiece_fst as op

MACHINE = op.compile_model()
THEIRS = sentencepiece.SentencePieceProcessor(model_file=op.MODEL)


def ids_of(texts, machine=MACHINE):
    ids, counts = op.Encoder(machine).encode(texts)
    out, at = [], 0
    for n in counts:
        out.append(ids[at : at + n].tolist())
        at += n
    return out


def test_same_ids_as_the_library():
    rnd = random.Random(5)
    pieces = MACHINE.names[259:]
    texts = ["", " ", "   ", "a  b   c ", "\n\n\t", "▁▁ x", "x" * 3000, "日本語 𝔘 \x00 é", "ab" * 700]
    texts += ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(30))) for _ in range(800)]
    texts += ["".join(rnd.choice("aab etionhr  .\n") for _ in range(60)) for _ in range(500)]
    assert ids_of(texts) == THEIRS.encode(texts)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    (ids,) = ids_of([text])
    assert ids == THEIRS.encode(text)
    assert op.decode_ids(MACHINE, ids) == text.replace(op.BLANK, " ")


def test_acceptance_is_what_joint_encoding_says():
    rnd = random.Random(9)
    order = {MACHINE.names[s]: int(r) for s, r in enumerate(MACHINE.rank) if r < op.NEVER}
    usable = [i for i in range(259, len(MACHINE.names)) if MACHINE.made[i] >= 0 or len(MACHINE.names[i]) == 1]
    usable = [i for i in usable if op.BLANK not in MACHINE.names[i][1:]]
    a = [rnd.choice(usable) for _ in range(3000)]
    b = [rnd.choice(usable) for _ in range(3000)]
    import numpy as np

    got = op.accepted(MACHINE, np.array(a), np.array(b))
    for x, y, ok in zip(a, b, got):
        x, y = MACHINE.names[x], MACHINE.names[y]
        assert ok == (op.merged(list(x + y), order)[0] == [x, y]), (x, y)


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """A small unigram model, written by hand."""
    model = proto.ModelProto()
    for piece, score, kind in [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)]:
        model.pieces.add(piece=piece, score=score, type=kind)
    for b in range(256):
        model.pieces.add(piece=f"<0x{b:02X}>", score=0, type=6)
    rnd = random.Random(2)
    words = {"▁", "a", "b", "c", "d"} | {"".join(rnd.choice("▁abcd"[i > 0 :]) for i in range(rnd.randrange(2, 5))) for _ in range(60)}
    for w in sorted(words):
        model.pieces.add(piece=w, score=-rnd.uniform(1, 9), type=1)
    model.trainer_spec.model_type = 1
    model.trainer_spec.byte_fallback = True
    model.trainer_spec.unk_id = 0
    model.normalizer_spec.add_dummy_prefix = True
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = True
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return str(path)


def test_unigram_takes_the_shortest_path(unigram):
    machine, theirs = op.compile_model(unigram), sentencepiece.SentencePieceProcessor(model_file=unigram)
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("abcd  é") for _ in range(25)) for _ in range(300)]
    for text, got in zip(texts, ids_of(texts, machine)):
        want = theirs.encode(text)
        if got != want:  # equal weights, which the library adds up in single precision
            weight = lambda ids: sum(theirs.get_score(i) for i in ids)
            assert abs(weight(got) - weight(want)) < 1e-4, text
            assert op.decode_ids(machine, got) == theirs.decode(want)


def test_frames(spark, docs, none):
    rows = op.decode(op.encode(docs, MACHINE, name="digest"), MACHINE, ids_col="digest", name="mark")
    assert set(rows.columns) == set(docs.columns)
    got = rows.collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["digest"] == THEIRS.encode(r["text"] or "") and r["mark"] == (r["text"] or "")
        assert r["a.b"] == "dot"
    assert op.encode(none, MACHINE).collect() == []
    for r in op.encode(docs, MACHINE, proof=True).collect():
        assert r.round_trip and r.decoded_sha256 == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    one = spark.createDataFrame([(1, None)], "i int, ids array<int>")
    assert op.decode(one, MACHINE).collect()[0].decoded == ""
