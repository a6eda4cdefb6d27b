import random
import re

import numpy as np
import pytest
from awkward import awkward, nothing

from tidemark.llm import lines


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def plain_removed(texts, radius=None, least=0.8, short=False):
    """Line numbers to remove per document, by comparing all pairs of different lines.

    Only with a ``radius`` does it matter how far their SimHashes are apart."""
    places = []
    for doc, text in texts:
        for number, line in enumerate((text or "").split("\n")):
            norm = re.sub(r"[\x00-/:-@\[-`{-\x7f]+", " ", line.lower()).strip()
            if len(norm.split(" ")) >= 5:
                places.append((doc, number, norm))
            elif short and line.strip():
                places.append((doc, number, norm or line.strip()))
    different = list(dict.fromkeys(p[2] for p in places if len(p[2].split(" ")) >= 5))
    different.sort(key=len)
    prints = lines.line_prints("\n".join(different).encode())[2].view(np.uint64)
    sizes = np.array([len(x) for x in different])
    letters = [np.bincount(np.frombuffer(x.encode("utf-32-le"), np.uint32) % 512, minlength=512) for x in different]
    letters = np.array(letters).reshape(-1, 512)
    root = {x: x for _, _, x in places}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(different):
        most = (1 - least) * sizes[i] + 1e-9
        # an edit changes the counts of two letters at most, by one each
        near = (sizes[:i] >= sizes[i] - most) & (np.abs(letters[:i] - letters[i]).sum(axis=1) <= 2 * most)
        if radius is not None:
            near &= np.bitwise_count(prints[:i] ^ prints[i]) <= radius
        for j in np.flatnonzero(near):
            if find(a) != find(different[j]) and lines.similar(a.split(" "), different[j].split(" "), least):
                root[find(a)] = find(different[j])
    seen, gone = set(), {}
    for doc, number, norm in places:
        if find(norm) in seen:
            gone.setdefault(doc, []).append(number)
        seen.add(find(norm))
    return gone


@pytest.mark.parametrize("size", [6, 2048])
def test_equals_comparing_all_pairs(documents, texts, size):
    found = lines.with_removed(documents, lines.repeated_lines(documents, prints=size, lines=size))
    found = {r.doc_id: r["__removed"] for r in found.collect() if r["__removed"]}
    assert found == plain_removed(texts, radius=3)


def test_edit_distance():
    chance = random.Random(3)
    for _ in range(500):
        a = "".join(chance.choice("ab c") for _ in range(chance.randint(0, 30)))
        b = list(a) if chance.random() < 0.5 else list("cab ab" * 3)
        for _ in range(chance.randint(0, 5)):
            if b:
                b[chance.randrange(len(b))] = chance.choice(["", "x", "ab"])
        b = "".join(b)
        assert lines.edit_distance(a, b) == plain_distance(a, b)
        left, right = a.split(" "), b.split(" ")
        assert lines.similar(left, right, 0.8) == (plain_distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9)


def test_near_prints_agree_in_two_blocks():
    masks = lines.block_masks(3)
    chance = random.Random(4)
    for _ in range(1000):
        flips = sum(1 << b for b in chance.sample(range(64), 3))
        assert any(flips & m == 0 for m in masks)


def test_one_occurrence_stays(spark):
    line = "this is a line of quite a few words that many documents share with each other"
    other = line.replace("quite", "rather")
    rows = [(3, f"{line}\nunique words of the third document here"), (1, f"x\n{line}\n{line}"), (2, "short\nshort")]
    frame = spark.createDataFrame([*rows, (4, other), (5, f"x {line}!\r\n")], "doc_id long, text string")
    found = {r.doc_id: r.text for r in lines.dedup_lines(frame, radius=20).collect()}
    assert found[1] == f"x\n{line}"
    assert found[2] == "short\nshort"
    assert found[3] == "unique words of the third document here"


def test_awkward_rows(spark):
    documents = awkward(spark)
    found = lines.dedup_lines(documents)
    assert found.columns == documents.columns
    rows = found.collect()
    assert len(rows) == 12
    assert sum(r.text is None for r in rows) == 2
    assert [len(r.text) > 0 for r in rows if r.doc_id == 4] == [True, True]  # equal rows, one document
    assert [r.text for r in rows if r.doc_id == 5] == [""]
    assert lines.dedup_lines(nothing(spark)).count() == 0


def test_prints_are_majorities_of_the_different_words_bits():
    words = ["alpha", "be", "amuchlongerwordofmorethaneightbytes", "ñandú"]
    many = [f"w{i}" for i in range(600)]
    text = [" ".join(words), "", "  ", "alpha " * 700 + "be " * 300, words[2], " ".join(many), "alpha be"]
    n, hashes, prints, sizes = lines.line_prints("\n".join(text).encode())
    assert list(n) == [4, 0, 0, 1000, 1, 600, 2] and sizes[0] == len(text[0])

    def majority(some):
        own = [int(lines.line_prints(w.encode())[2].view(np.uint64)[0]) for w in some]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in own) > len(own))

    expected = [majority(words), 0, 0, majority(words[:2]), majority(words[2:3]), majority(many), majority(words[:2])]
    assert prints.view(np.uint64).tolist() == expected
    assert len({*hashes.tolist()}) == 6
    assert lines.line_prints(b"one two")[1][0] != lines.line_prints(b"two one")[1][0]


def test_bounds_never_exclude_a_similar_pair():
    """Lengths and pairs of bytes allow whatever the edit distance allows."""
    chance = random.Random(11)
    for letters in ("ab ", "abcdefg hij", "añé\u4e16\U0001f600 b"):
        texts = []
        for _ in range(60):
            base = [chance.choice(letters) for _ in range(chance.randint(5, 40))]
            for _ in range(4):
                other = list(base)
                for _ in range(chance.randint(0, 8)):
                    at = chance.randrange(len(other))
                    other[at : at + 1] = [chance.choice(letters) for _ in range(chance.randint(0, 2))]
                    other = other or ["a"]
                texts.append(" ".join("".join(other).split()) or "a")
        profiles = lines.pair_profiles([t.encode() for t in texts]).astype(int)
        sizes = np.array([len(t) for t in texts])
        for i in range(len(texts)):
            for j in range(i):
                if lines.similar(texts[i].split(" "), texts[j].split(" "), 0.8):
                    factor = 4 if (texts[i] + texts[j]).isascii() else 10
                    assert np.abs(profiles[i] - profiles[j]).sum() <= factor * (0.2 * max(sizes[i], sizes[j]) + 1)
                    assert lines._lengths_fit(sizes, i, j, 0.8)


def test_lines_that_meet_by_all_bands_meet_once(spark):
    """Sketches are not sent again for a band that brings the same lines together, nor to lines whose
    lengths leave them alone there."""
    sketch, other = bytes(range(64)), bytes(range(32)) + bytes(range(100, 132))
    rows = [(1, sketch, 50), (2, sketch, 55), (3, sketch, 500), (4, other, 56), (5, other, 70), (6, bytes(64), 50)]
    # 4 and 5 share the first eight bands with 1 and 2, and the others with each other alone
    found = lines._members(spark.createDataFrame(rows, "line BIGINT, sketch BINARY, size INT"), 0.8)
    met = {}
    for row in found.collect():
        met.setdefault(row.key, (row.key >> lines.BAND_BITS, row.n, []))[2].append(row.line)
    met = sorted((band, n, sorted(group)) for band, n, group in met.values())
    assert met == [(0, 4, [1, 2, 4, 5]), (8, 2, [1, 2]), (8, 2, [4, 5])]
