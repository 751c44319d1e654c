import random

import xxhash
from llm_helpers import ODD, SF_SMALL, empty, odd, words

from berthline.llm import queries
from berthline.llm import simhash_ball as S
from berthline.llm.common import table
from berthline.llm.components import connected_components


def plain_fingerprint(text, k=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words(lower)
    shingles = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance):
    """prints: list of unsigned fingerprints -> root index of each, comparing all."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def same_classes(a, b):
    return len(set(a)) == len(set(b)) == len(set(zip(a, b)))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_by_definition():
    for text in [None, "", "  ", "One", "one two", "A b C d", "a b c a b c a b c", "É é x y z \x85 q", "w " * 70000]:
        assert S.fingerprint_of(text, 3) == plain_fingerprint(text)


def test_query_by_comparing_all(spark):
    docs = sorted((r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect())
    prints = [plain_fingerprint(t) for _, t in docs]
    want = plain_components(prints, 2)
    got = {r.doc_id: r for r in queries.REGISTRY["op8_simhash_near_dedup"](spark, SF_SMALL).collect()}
    low = {}
    for (i, _), c in zip(docs, want):
        low[c] = min(low.get(c, i), i)
    for (i, _), p, c in zip(docs, prints, want):
        assert got[i].fingerprint == f"{p:016x}" and got[i].component_id == low[c]
    assert len(low) < len(docs)


def test_links_lose_none(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = {b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(40)}
    prints = sorted(prints | {0, 1 << 63, (1 << 64) - 1})
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    for distance in (0, 1, 2, 3, 4):
        if distance == 4 and len(prints) > 260:
            continue
        links = [(r.a, r.b) for r in S.links(df, distance).collect()]
        assert len(links) == len(set(links))
        assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= distance for a, b in links)
        roots = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()
                 } if links else {}
        got = [roots.get(signed(p), signed(p)) for p in prints]
        assert same_classes(got, plain_components(prints, distance))


def test_components_of_chains_loops_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 7), (1, 2), (2, 1), (-5, 2)] + [(500, i) for i in range(501, 560)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 500 for i in range(500, 560))
    assert got[1] == got[2] == got[-5] == -5 and 7 not in got
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_odd_rows(spark):
    got = S.near_duplicates(odd(spark)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in ODD)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.fp, r.component_id))
    assert by[1] == by[2] == by[3] == {(0, 1)}
    assert {c for _, c in by[5]} == {5} and {c for _, c in by[6]} == {5, 6} and {c for _, c in by[None]} == {None}
    assert S.near_duplicates(empty(spark)).collect() == []


def test_deduplicate_keeps_one_row_of_each(spark):
    df = odd(spark)
    kept = S.deduplicate(df)
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, None), (4, "word"), (5, "same words here and here"), (6, "another text under id six"),
                          (None, "no id at all"), (7, ODD[9][1]), (8, ODD[10][1])], key=str)
    assert S.deduplicate(empty(spark)).collect() == []
