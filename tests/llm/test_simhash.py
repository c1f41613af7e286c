import random

import pytest
from pyspark.sql import functions as F

from stintlake.llm import simhash
from stintlake.llm.components import components


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair_within_the_radius(radius):
    masks = [m & (1 << 64) - 1 for m in simhash.covering_masks(radius)]
    assert len(masks) == 2 ** (radius + 1) - 1
    chance = random.Random(radius)
    for _ in range(3000):
        flips = sum(1 << b for b in chance.sample(range(64), radius))
        assert any(not flips & m for m in masks)


def test_fingerprint_is_the_majority_of_spark_s_own_hash(spark):
    text = "The cat sat on the mat, and THE cat sat on the hat É"
    words = "".join(c.lower() if c.isascii() else c for c in text).split()
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [r.h for r in spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s").alias("h")).collect()]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint_of(text) == signed(want)
    assert simhash.fingerprint_of("one two") == spark.sql("SELECT xxhash64('one two') AS h").first().h
    assert simhash.fingerprint_of(None) == simhash.fingerprint_of(" \n") == 0


@pytest.mark.parametrize("limit", [1, 64])
@pytest.mark.parametrize("radius", [1, 2])
def test_links_have_the_components_of_all_pairs(spark, limit, radius):
    chance = random.Random(5)
    values = {0, (1 << 64) - 1}
    for _ in range(25):  # crowds of near values, chains and strangers
        centre = chance.getrandbits(64)
        for _ in range(chance.choice([1, 3, 20])):
            values.add(centre ^ sum(1 << b for b in chance.sample(range(64), chance.randint(0, 3))))
    values = sorted(values)
    pairs = [(i, j) for i in range(len(values)) for j in range(i) if bin(values[i] ^ values[j]).count("1") <= radius]
    want = roots(len(values), pairs)
    prints = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    number = {signed(v): i for i, v in enumerate(values)}
    found = [(number[r.a], number[r.b]) for r in simhash.links(prints, radius, limit).collect()]
    assert all(bin(values[a] ^ values[b]).count("1") <= radius for a, b in found)
    assert roots(len(values), found) == want


def test_whole_operator_against_all_pairs(spark):
    chance = random.Random(9)
    texts = []
    for _ in range(12):
        base = [chance.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(chance.randint(0, 60)) for _ in range(300)]
        for _ in range(chance.randint(1, 8)):
            copy = list(base)
            for _ in range(chance.randint(0, 2)):
                copy[chance.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
    texts += ["", None, "two words", "two  WORDS"]
    prints = [simhash.fingerprint_of(t) & (1 << 64) - 1 for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 2]
    assert any(0 < bin(prints[i] ^ prints[j]).count("1") for i, j in near)
    want = roots(len(texts), near)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert [found[i].component_id for i in range(len(texts))] == want
    assert [int(found[i].fingerprint, 16) for i in range(len(texts))] == prints
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == sorted(set(want))


def test_components_of_a_long_chain(spark):
    chain = list(range(200))
    random.Random(1).shuffle(chain)
    edges = [(min(a, b), max(a, b)) for a, b in zip(chain, chain[1:])] + [(500, 501)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(200)} | {500: 500, 501: 500}
