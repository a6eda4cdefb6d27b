import random
import re

import numpy as np
import xxhash
from awkward import awkward, nothing
from pyspark.sql import functions as F

from tidemark.llm import components, groups, simhash


def plain_print(text, shingle=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    runs = [words[i : i + shingle] for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=3):
    """Index of the first member of each print's component, by comparing all pairs."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                left, right = sorted((find(i), find(j)))
                root[right] = left
    return [find(i) for i in range(len(prints))]


def test_equals_all_pairs(spark, documents, texts):
    prints = [plain_print(t) for _, t in texts]
    roots = plain_components(prints)
    expected = {i: (format(p, "016x"), texts[r][0]) for (i, _), p, r in zip(texts, prints, roots)}
    found = simhash.simhash_groups(documents, 3, 3).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == expected


def test_words_hash_like_spark(spark):
    rows = spark.createDataFrame([("one two three",), ("ä",)], "text string")
    found = rows.select("text", F.xxhash64("text").alias("h")).collect()
    for row in found:
        assert int(simhash.fingerprints([row.text], 3)[0]) == row.h


def test_every_near_pair_shares_a_mask():
    masks = [m for m, _ in simhash.covering_masks(list(range(64)), 3)]
    chance = random.Random(1)
    for _ in range(2000):
        flips = sum(1 << b for b in chance.sample(range(64), 3))
        assert any(flips & m == 0 for m in masks)


def test_free_bits_of_divided_groups_are_few():
    for _, free in simhash.covering_masks(list(range(64)), 3):
        assert all(len(left) <= 16 for _, left in simhash.covering_masks(free, 3))


def test_divided_groups_lose_no_link(spark):
    chance = random.Random(2)
    prints = {0}
    while len(prints) < 300:  # a dense cloud and some strangers
        word = chance.choice(sorted(prints))
        prints.add(word ^ sum(1 << b for b in chance.sample(range(64), chance.choice((1, 2, 3, 30)))))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    expected = plain_components(prints)
    for size in (5, 2048):
        links = simhash.near_links(frame, 3, group=size)
        root = {r.node: r.component for r in components.connected_components(links).collect()}
        found = [root.get(p, p) for p in signed]
        assert len(set(found)) == len(set(expected))
        assert len(set(zip(found, expected))) == len(set(expected))


def test_a_dense_group_yields_one_link_per_member():
    prints = np.array([1 << b for b in range(40)], np.uint64)
    assert len(groups.spanning_links(prints, 3)) == 39


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(1000, i) for i in range(1001, 1100)] + [(5000, 5000), (None, 5001)]
    links = spark.createDataFrame(chain + star, "a long, b long")
    found = {r.node: r.component for r in components.connected_components(links).collect()}
    assert found == {**{i: 1 for i in range(1, 61)}, **{i: 1000 for i in range(1000, 1100)}}


def test_awkward_rows(spark):
    found = simhash.simhash_groups(awkward(spark), 3, 3)
    rows = [(r.doc_id, r.fingerprint, r.component_id) for r in found.collect()]
    assert len(rows) == 12
    empty = "0" * 16
    assert sorted((i, c) for i, p, c in rows if p == empty and i is not None) == [(1, 1), (2, 1), (3, 1), (9, 1)]
    assert {c for i, _, c in rows if i in (4, 5)} == {4}
    assert {c for i, p, c in rows if i is None} == {1, 6}
    assert simhash.simhash_groups(nothing(spark), 3, 3).count() == 0


def test_one_of_each_group_stays(spark):
    documents = awkward(spark)
    kept = simhash.one_per_group(documents, 3, 3)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 6, 7, 8]
    assert simhash.one_per_group(nothing(spark), 3, 3).count() == 0
