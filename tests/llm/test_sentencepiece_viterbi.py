import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import ODD, SF_SMALL, empty, odd

from berthline.llm import queries
from berthline.llm import sentencepiece_viterbi as V


@pytest.fixture(scope="module")
def model():
    return V.pieces(V.default_path())


def plain_best(model, word):
    """Greatest score over all segmentations, place by place from the left, by look-up alone."""
    ids = {model.model.id_to_piece(i): i for i in range(model.model.get_piece_size())
           if not (model.is_byte[i] or model.model.is_control(i) or model.model.is_unknown(i))}
    best = [0.0] + [-1e300] * len(word)
    for j in range(1, len(word) + 1):
        for i in range(max(0, j - 64), j):
            if word[i:j] in ids:
                best[j] = max(best[j], best[i] + model.scores[ids[word[i:j]]])
        if word[j - 1] not in ids:
            best[j] = max(best[j], best[j - 1] + model.penalty)
    return best[-1]


def test_best_score_by_brute_force(model):
    rng = random.Random(5)
    texts = ["thereandback", "ununpentium", "naïveté", "字字", "a🙂b", "x\ty\nz", "don't,stop.", "  gaps   here "]
    texts += ["".join(rng.choice("abcdeorstn ,.é") for _ in range(rng.randint(1, 18))) for _ in range(150)]
    for text in texts:
        ids = model.encode(text)
        assert model.score(ids) == pytest.approx(plain_best(model, V.SPACE + text.replace(" ", V.SPACE)), rel=1e-12)


def test_decode_is_the_library_s(model):
    for text in ["Plain words here.", "é 字 🙂", "two  spaces ", "a\nb"]:
        ids = model.encode(text)
        assert model.decode(ids) == model.model.decode(ids.tolist()) == text


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_characters=V.SPACE, exclude_categories=("Cs",)), max_size=40))
def test_round_trip(model, text):
    assert model.decode(model.encode(text)) == text


def test_words_apart_change_nothing(model):
    import numpy as np
    for text in ["one two  three,four.\nfive", "é字 a", " x"]:
        whole = np.frombuffer(model.segment(V.SPACE + text.replace(" ", V.SPACE)), np.int32)
        assert model.score(whole) == model.score(model.encode(text))


def test_query(spark):
    got = queries.REGISTRY["op4_sentencepiece_viterbi"](spark, SF_SMALL).collect()
    assert len(got) == 200 and all(r.round_trip for r in got)


def test_odd_rows(spark):
    got = V.decode(V.encode(odd(spark))).collect()
    assert sorted(((str(r.doc_id), r.decoded) for r in got)) == sorted((str(r[0]), r[1] or "") for r in ODD)
    assert V.decode(V.encode(empty(spark))).collect() == []
