import hashlib
import string
from collections import defaultdict

import pytest

from tidemark.llm import exact_dedup as op

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def groups(rows):
    out = defaultdict(list)
    for r in rows:
        out[(r[1] or "").translate(LOWER)].append(r[0])
    return out


@pytest.mark.parametrize("lanes, fan_in", [(256, 16), (7, 2), (1, 2)])
def test_every_row_is_decided(docs, lanes, fan_in):
    rows = [tuple(r) for r in docs.collect()]
    want = groups(rows)
    got = op.decide(docs, lanes=lanes, fan_in=fan_in).collect()
    assert len(got) == len(rows)
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in want.items()}
    for r in got:
        ids = by_hash[r.text_sha256]
        named = [i for i in ids if i is not None]
        assert r.group_size == len(ids)
        assert r.keep_id == (max(named) if named else None)
    # One row of each group stays, also where rows repeat identifier and text.
    kept = [r.text_sha256 for r in got if r.kept]
    assert sorted(kept) == sorted(by_hash)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_smallest(docs):
    want = groups([tuple(r) for r in docs.collect()])
    for r in op.decide(docs, keep="smallest").collect():
        ids = [i for i in next(v for t, v in want.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256) if i is not None]
        assert r.keep_id == (min(ids) if ids else None)
    with pytest.raises(ValueError):
        op.decide(docs, keep="any")


def test_survivors_have_the_columns_of_the_input(docs):
    out = op.survivors(docs)
    assert out.dtypes == docs.dtypes
    rows = [tuple(r) for r in out.collect()]
    want = groups([tuple(r) for r in docs.collect()])
    assert len(rows) == len(want)
    for r in rows:
        ids = [i for i in want[(r[1] or "").translate(LOWER)] if i is not None]
        assert r[0] == (max(ids) if ids else None)


def test_empty(none):
    assert op.decide(none).collect() == []
    assert op.survivors(none).collect() == []


def test_large_group_is_spread(spark):
    """A text that half of all rows share leaves no join or merge with more rows of it than lanes allow."""
    df = spark.range(4000).selectExpr("id AS doc_id", "if(id % 2 = 0, 'hot', cast(id AS string)) AS text")
    got = op.decide(df, lanes=64, fan_in=8)
    assert got.where("group_size = 2000 AND keep_id = 3998").count() == 2000
    assert got.where("kept").count() == 2001
