import hashlib
from collections import Counter

import numpy as np
import pytest
from awkward import awkward, nothing

from tidemark.llm import substrings


def plain(texts, window, first_stays=False):
    """Digest of each text after removal, by counting all windows."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    counts = Counter(t[s : s + window] for t in data for s in range(len(t) - window + 1))
    seen, out = set(), []
    for text in data:
        gone = np.zeros(len(text), bool)
        for start in range(len(text) - window + 1):
            string = text[start : start + window]
            if string in seen if first_stays else counts[string] > 1:
                gone[start : start + window] = True
            seen.add(string)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        out.append((len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def digests(frame):
    return [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.orderBy("doc_id").collect()]


def test_equals_counting_all_windows(documents, texts):
    expected = plain([t for _, t in texts], 200)
    assert digests(substrings.removed(documents, 200)) == expected
    assert sum(e[1] for e in expected) > 0


@pytest.mark.parametrize("first_stays", [False, True])
@pytest.mark.parametrize("contexts", [2, 4096])
def test_repeats_within_a_text_and_crowded_grams(spark, texts, first_stays, contexts):
    passage = "".join(chr(97 + i * i % 26) for i in range(180))
    made = ["ab" * 300, None, "x" * 500, "x" * 200, "", *(f"{i}{passage}{i * 7}" * 2 for i in range(9))]
    sample = [t for _, t in texts[:40]] + made
    frame = spark.createDataFrame(list(enumerate(sample)), "doc_id long, text string")
    found = digests(substrings.removed(frame, 200, first_stays, contexts=contexts))
    assert found == plain(sample, 200, first_stays)


def test_other_window(spark):
    sample = ["q" * 64 + "abcdefgh" * 20, "abcdefgh" * 12 + "z", "short"]
    frame = spark.createDataFrame(list(enumerate(sample)), "doc_id long, text string")
    assert digests(substrings.removed(frame, 80)) == plain(sample, 80)


def test_segments_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SEGMENT", 300)
    sample = [("wxyz%d " % (i % 150) * 30) + "tail%d" % i for i in range(160)]
    frame = spark.createDataFrame(list(enumerate(sample)), "doc_id long, text string")
    assert digests(substrings.removed(frame, 200)) == plain(sample, 200)


def test_awkward_rows(spark):
    found = substrings.removed(awkward(spark), 200).collect()
    assert len(found) == 12
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by_id[4].n_removed == by_id[4].n_bytes and by_id[4].n_spans == 1
    assert by_id[1].n_bytes == 0 and by_id[1].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert substrings.removed(nothing(spark), 200).count() == 0


def test_smaller_neighbours():
    draw = np.random.default_rng(3)
    for many in (0, 1, 2, 50):
        for values in (draw.permutation(many), np.arange(many), np.arange(many)[::-1]):
            before, after = substrings.smaller_neighbours(values)
            for i in range(many):
                assert before[i] == max((j for j in range(i) if values[j] < values[i]), default=-1)
                assert after[i] == min((j for j in range(i + 1, many) if values[j] < values[i]), default=-1)


@pytest.mark.parametrize("window", [8, 13, 40, 200])
def test_longest_previous_factors_equal_brute_force(window):
    draw = np.random.default_rng(window)
    for letters in (1, 2, 4):
        parts = [bytes(draw.integers(97, 97 + letters, draw.integers(window, 2 * window + 20), np.uint8)) for _ in range(3)]
        parts.append(parts[0][3:] + parts[1][:window])
        data = np.frombuffer(b"".join(parts) + b"\0" * 8, np.uint8)
        ends = np.cumsum([len(p) for p in parts])
        windows = np.concatenate([np.arange(e - len(p), e - window + 1) for p, e in zip(parts, ends)])
        text = data.tobytes()
        expected = []
        for i, a in enumerate(windows):
            best = 0
            for b in windows[:i]:
                n = 0
                while n < window and text[a + n] == text[b + n]:
                    n += 1
                best = max(best, n)
            expected.append(best)
        found = substrings.longest_previous_factors(data, windows, window)
        assert found.tolist() == expected
        copy, source = substrings.repeated_windows(data, windows, window)
        assert (copy == (found >= window)).all()
        strings = [text[a : a + window] for a in windows]
        assert (copy | source).tolist() == [strings.count(x) > 1 for x in strings]
