import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_helpers import ODD, SF_SMALL, empty, odd

from berthline.llm import bpe, queries
from berthline.llm import hilbert_packing as P
from berthline.llm.common import table


def ids_of(text):
    e = bpe.encoder(bpe.default_path()).tokenizer
    return np.append(e.encode(text or "", add_special_tokens=False).ids, 1).astype("<u4")


def check(rows, texts, capacity=2048):
    """Every id in one piece, sequences gapless, no padding; texts: id -> list of texts."""
    want = defaultdict(list)
    for doc_id, text in texts:
        want[doc_id].append(ids_of(text))
    sequences, got = defaultdict(list), defaultdict(int)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        got[r.doc_id] += r.length
        assert any(r.doc_tokens == len(w) and zlib.crc32(w[r.start:r.start + r.length].tobytes()) == r.ids_crc32
                   for w in want[r.doc_id])
    assert got == {k: sum(map(len, v)) for k, v in want.items()}
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at == capacity or at & (at - 1) == 0 and at < capacity
    for doc_id, v in want.items():
        if len(v) == 1:
            own = sorted((r.start, r.length) for r in rows if r.doc_id == doc_id)
            assert [s for s, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1]]


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (4, 2), (1, 5)])
def test_curve_visits_every_place_once_by_single_steps(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = P.hilbert_key(grid, bits)
    assert sorted(keys) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_like_documents_are_neighbours():
    e, proj = bpe.encoder(bpe.default_path()), P._projection()
    text = "the quick brown fox jumps over the lazy dog " * 20
    place = lambda t: P.coordinates(e.ids(t), np.array([len(e.ids(t))]), proj)[0]
    near = np.abs(place(text) - place(text + "again")).max()
    far = np.abs(place(text) - place("ganz andere Wörter stehen in diesem deutschen Satz " * 20)).max()
    assert near < 0.1 * far


def test_query_against_the_library(spark):
    rows = queries.REGISTRY["op7_hilbert_packing"](spark, SF_SMALL).collect()
    check(rows, [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()])


def test_odd_rows(spark):
    check(P.pack(odd(spark)).collect(), [(r[0], r[1]) for r in ODD])
    check(P.pack(odd(spark), capacity=64).collect(), [(r[0], r[1]) for r in ODD], 64)
    assert P.pack(empty(spark)).collect() == []


def test_many_copies_are_spread(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "'the same text in all of them' AS text")
    spark.conf.set("spark.sql.adaptive.enabled", "false")      # which would join such small ranges
    rows = P.pack(df).collect()
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    check(rows, [(i, "the same text in all of them") for i in range(3000)])
    assert len({r.sequence_id >> 40 for r in rows}) > 1
