import numpy as np
from llm_helpers import ODD, SF, empty, odd
from pyspark.sql import functions as F

from berthline.llm import queries
from berthline.llm import toxicity as T
from berthline.llm.common import table



def every():
    return F.lit(True)


def test_held_out_accuracy(spark):
    got = queries.REGISTRY["op9_toxicity"](spark, SF).join(table(spark, SF, "labels"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 50 and (held.predicted == held.toxic).mean() > 0.95
    toxic, clean = (held[held.toxic == y].score.to_numpy() for y in (1, 0))
    assert (toxic[:, None] > clean[None, :]).mean() > 0.97


def biased(spark):
    """Sentences in which one group is mentioned beside insults more often than others."""
    rng = np.random.default_rng(4)
    filler = [f"word{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 3 == 0
        said = list(rng.choice(filler, 12))
        if toxic:
            said += list(rng.choice(["idiots", "scum"], 1)) if rng.random() < 0.8 else []
        group = "muslim" if rng.random() < (0.8 if toxic else 0.1) else "christian"
        said.insert(3, group)
        rows.append((i, " ".join(said) + "."))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_penalty_takes_the_group_out_of_the_score(spark):
    docs, labels = biased(spark)
    said = "a {} neighbour came by with word1 word2"
    gap = {}
    for penalty in (0.0, 100.0):
        score = T.train(docs, labels, every(), penalty=penalty).scorer()
        gap[penalty] = score(said.format("muslim")) - score(said.format("christian"))
        assert score("these idiots word3") > score("these people word3") + 1
    assert gap[0.0] > 0.5 and abs(gap[100.0]) < 0.15 * gap[0.0]


def test_swapped_sentences():
    assert set(T.SWAP) == {t for v in T.IDENTITY_TERMS.values() for t in v} == set(T.SWAP.values())
    got = list(T.counterfactuals("A Muslim said so.\nNot a muslimah; GAY men! None here.", T.SWAP))
    assert got == [("a muslim said so", "a jewish said so"), ("not a muslimah; gay men", "not a muslimah; lesbian men")]
    assert list(T.counterfactuals(None, T.SWAP)) == list(T.counterfactuals("gay", {})) == []
    number = {f: i for i, f in enumerate(["gay$", "gay", "lesbian$", "les", "the$", "the$#8"])}
    assert T.score_change("the gay man", "the lesbian man", {"gay$", "gay", "lesbian$", "les", "the$"}, number) == ([0, 1], [2, 3])


def test_terms_are_an_input(spark):
    docs, labels = biased(spark)
    terms = {"word": ["muslim", "christian"]}
    fair = T.train(docs, labels, every(), penalty=100.0, terms=terms).scorer()
    free = T.train(docs, labels, every(), penalty=100.0, terms={}).scorer()
    gap = [s("a muslim neighbour") - s("a christian neighbour") for s in (fair, free)]
    assert abs(gap[0]) < 0.15 * gap[1]


def test_fit_against_the_loss_written_out():
    """No small change of any weight lowers the loss, penalty included."""
    rng = np.random.default_rng(2)
    rows = [np.flatnonzero(rng.random(12) < 0.3) for _ in range(200)]
    label = np.array([float(0 in r or rng.random() < 0.2) for r in rows])
    swaps, often = [([0], [1]), ([2, 3], [4]), ([5], [])], np.array([3.0, 1.0, 2.0])

    def loss(w, b, penalty):
        z = np.array([w[r].sum() + b for r in rows])
        weight = np.where(label == 1, 0.5 / label.sum(), 0.5 / (1 - label).sum())
        change = np.array([w[list(x)].sum() - w[list(y)].sum() for x, y in swaps])
        return (weight * (np.logaddexp(0, z) - label * z)).sum() + 1e-4 * w.sum() + penalty * (often * change ** 2).sum() / often.sum()
    for penalty in (0.0, 0.1, 10.0):
        w, b = T.fit(rows, label, swaps, often, 12, penalty)
        low = loss(w, b, penalty)
        for i in range(12):
            for step in (1e-3, -1e-3):
                moved = w.copy()
                moved[i] = max(0.0, moved[i] + step)
                assert loss(moved, b, penalty) >= low - 1e-9
        assert min(loss(w, b + 1e-3, penalty), loss(w, b - 1e-3, penalty)) >= low - 1e-9
        again, _ = T.fit(rows, label, swaps, often, 12, penalty, steps=1_000_000)
        assert np.abs(w - again).max() < 1e-9


def test_more_steps_change_nothing(spark):
    """The fit ends by its tolerance, not by its number of steps."""
    docs, labels = biased(spark)
    found = []
    fit = T.fit
    for steps in (100_000, 200_000):
        T.fit = lambda *args, steps=steps: fit(*args, steps=steps)
        try:
            found.append(T.train(docs, labels, every()))
        finally:
            T.fit = fit
    assert found[0] == found[1]


def test_features():
    assert T.word_features("scum") == ["scum$", "scu", "scum"]
    found = T.document_features("scum scum " + "x " * 398)
    assert "scum$" in found and "scum$#2" in found and "scum$#8" not in found
    assert T.document_features(None) == []


def test_labels_missing_or_one_sided(spark):
    docs = odd(spark)
    for rows in ([], [(4, 0)], [(4, 1)], [(None, 1), (5, None), (77, 1)]):
        got = T.classify(docs, spark.createDataFrame(rows, "doc_id long, toxic int"), every()).collect()
        assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in ODD)
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_odd_rows(spark):
    labels = spark.createDataFrame([(5, 1), (6, 1), (8, 0), (7, 0), (7, 0)], "doc_id long, toxic int")
    got = T.classify(odd(spark), labels, every()).collect()
    assert len(got) == len(ODD) and len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert T.classify(empty(spark), labels, every()).collect() == []
