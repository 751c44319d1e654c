import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import ODD, SF_SMALL, empty, odd

from berthline.llm import bpe, queries
from berthline.llm import token_store as T
from berthline.llm.common import shared_path, table


def ids_of(text, end=2):
    e = bpe.encoder(bpe.default_path()).tokenizer
    return np.append(e.encode(text or "", add_special_tokens=False).ids, end).astype("<u4")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "Be", " ", "\n", "\t", ".", ",", "'s", "é", "3", "\xa0", "%", "\r\n", "　",
                                 "\x1c", "\0", "字", "'", "<|endoftext|>", "ǅ"]), max_size=16).map("".join))
def test_pieces_make_the_library_s_ids(text):
    e = bpe.encoder(bpe.default_path())
    assert e.ids(text).tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("group, laid_out", [(16 << 20, 4 << 20), (60, 10), (1, 1)])
def test_batches_make_the_library_s_ids(monkeypatch, group, laid_out):
    monkeypatch.setattr(bpe, "_LAID_OUT", laid_out)
    texts = [r[1] for r in ODD] + ["a\nb", "", "\n", "x \ny", " lead", "tail ", "Word, word.\nNext\n", "a  b", "d"]
    e = bpe.encoder(bpe.default_path(), group=group)
    got = [x.tolist() for x in e.batch(pa.array(texts, pa.string()))]
    assert got == [e.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_long_texts_are_cut_without_a_trace(monkeypatch):
    monkeypatch.setattr(bpe, "_SLICE", 5)
    e = bpe.encoder(bpe.default_path(), group=4)
    for text in ["one two three four five six", "a\nb c.\nd e", "longwordwithoutanyspace and so on"]:
        assert e.ids(text).tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 20000])
def test_perfect_hash_is_minimal_and_perfect(n):
    keys = T.as_keys(np.random.default_rng(n).choice(10 ** 12, n, replace=False) - 5 * 10 ** 11)
    slots = T.PerfectHash.build(keys).slots(keys)
    assert sorted(slots) == list(range(n))


def test_index_refuses_unknown_keys():
    ids = np.arange(0, 5000, 2)
    index = T.Index(b"".join(T.index_bytes(ids, ids * 0 + 3, ids * 10, ids + 1)))
    found, entries = index.find(ids)
    assert found.all() and (entries["offset"] == ids * 10).all() and (entries["length"] == ids + 1).all()
    found, entries = index.find(ids + 1)
    assert not found.any() and not entries["length"].any()
    assert not T.Index(b"".join(T.index_bytes([], [], [], []))).find(ids)[0].any()


def test_query_against_the_library(spark):
    docs = sorted((r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect())
    got = {r.doc_id: r for r in queries.REGISTRY["op5_token_store"](spark, SF_SMALL).collect()}
    start = 0
    for doc_id, text in docs:
        ids, r = ids_of(text), got[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes())) and r.indexed
        start += len(ids)


def test_keyed_access(spark):
    folder = shared_path(spark, "keyed")
    docs = table(spark, SF_SMALL, "documents")
    placed = T.write(docs, folder)
    _, n = T.build_index(placed, folder)
    keys = spark.createDataFrame([(3,), (150,), (10 ** 9,), (None,)], "doc_id long")
    got = {r.doc_id: r.ids for r in T.read_keys(keys, folder, n).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got == {k: ids_of(texts[k]).tolist() for k in (3, 150)}


def test_odd_rows(spark):
    got = T.store(odd(spark)).collect()
    want = sorted((str(r[0]), len(ids_of(r[1])), zlib.crc32(ids_of(r[1]).tobytes())) for r in ODD)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert all(r.indexed == (r.doc_id is not None) for r in got)
    assert T.store(empty(spark)).collect() == []


def test_a_wrong_index_entry_shows(spark, monkeypatch):
    """Places, lengths and checksums come through the index."""
    docs = table(spark, SF_SMALL, "documents")
    build = T.build_index

    def swapped(placed, folder):
        """Documents 1 and 2 lead to each other's ids."""
        one = placed.where("doc_id in (1, 2)").selectExpr("3 - doc_id AS doc_id", "shard", "offset", "n_tokens", "width")
        return build(placed.where("doc_id not in (1, 2)").unionByName(one), folder)
    right = {r.doc_id: r for r in T.store(docs).collect()}
    monkeypatch.setattr(T, "build_index", swapped)
    wrong = {r.doc_id: r for r in T.store(docs).collect()}
    assert all(r.indexed for r in right.values()) and right[1].ids_crc32 != right[2].ids_crc32
    for a, b in ((1, 2), (2, 1)):
        assert (wrong[a].start, wrong[a].n_tokens, wrong[a].ids_crc32) == (right[b].start, right[b].n_tokens, right[b].ids_crc32)
        assert not wrong[a].indexed
    assert all(wrong[i].ids_crc32 == right[i].ids_crc32 and wrong[i].indexed for i in right if i not in (1, 2))
