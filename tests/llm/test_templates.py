"""Benchmarks whose items share a phrase: the same matches as comparing everything, in bounded time."""

import random
import time

import numpy as np
import pytest

from seriesloom.llm import decontam


def phrase(r, n):
    return "".join(r.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(n))


def plain_banded(window, text, diagonal, width, most):
    """The fewest edits of the whole window against a stretch of the text, cells off the band left out."""
    far = most + 1
    row = {p: 0 for p in range(diagonal - width, diagonal + width + 1) if 0 <= p <= len(text)}
    for i, a in enumerate(window):
        new = {}
        for p in range(diagonal - width + i + 1, diagonal + width + i + 2):
            if 0 <= p <= len(text):
                ways = [row.get(p, far) + 1, new.get(p - 1, far) + 1]
                if p > 0:
                    ways.append(row.get(p - 1, far) + (text[p - 1] != a))
                new[p] = min(ways)
        row = new
    best = min(row.values(), default=far)
    return best if best <= most else None


def test_alignments_side_by_side_are_those_one_by_one():
    r = random.Random(1)
    for _ in range(30):
        text = np.array([ord(c) for c in phrase(r, r.randint(0, 90))], np.uint32)
        length, width, most = r.randint(1, 40), r.randint(1, 9), r.randint(0, 8)
        windows, diagonals = [], []
        for _ in range(r.randint(1, 12)):
            at = r.randint(-5, max(1, len(text)))
            own = list(text[max(0, at) : max(0, at) + length])
            own += [ord("x")] * (length - len(own))
            for _ in range(r.randint(0, 5)):
                own[r.randrange(length)] = ord(r.choice("abcx"))
            windows.append(own)
            diagonals.append(at + r.randint(-2, 2))
        got = decontam.banded_distances(np.array(windows, np.uint32), text, np.array(diagonals), width, most)
        for w, d, g in zip(windows, diagonals, got, strict=True):
            assert (g and g[0]) == plain_banded(w, text.tolist(), d, width, most)
            if g:
                assert 0 <= g[1] <= g[2] <= len(text)


def test_a_common_opening_phrase_costs_little():
    r = random.Random(2)
    opening = ("read the following question carefully and answer it with one letter " + phrase(r, 20))[:71]
    items = [(k, opening + phrase(r, 29)) for k in range(3000)]
    index = decontam.build_index(items)
    text = " ".join([opening + " "] * 50)
    began = time.process_time()
    assert decontam.find_regions(text, index) == []
    assert time.process_time() - began < 20
    # A leaked item among the openings is found, whole and with edits, and nothing else.
    whole = f"{text} {items[7][1]} {text}"
    edited = items[8][1][:80] + "qq" + items[8][1][82:]
    assert {x[0] for x in decontam.find_regions(whole, index)} == {7}
    assert {x[0] for x in decontam.find_regions(f"{text} {edited}", index)} == {8}


@pytest.mark.parametrize("entries", [50, 1 << 20])
def test_chunks_of_any_size_find_the_same(monkeypatch, entries):
    r = random.Random(3)
    items = [(k, phrase(r, r.randint(20, 260))) for k in range(40)] + [(50, "a" * 150), (51, "ab " * 60)]
    index = decontam.build_index(items)
    texts = [phrase(r, 300) + items[k][1] + phrase(r, 500) + "a" * 200 + items[k + 1][1][:120] for k in range(0, 20, 3)]
    want = [decontam.find_regions(t, index) for t in texts]
    assert all(any(x[0] == k for x in found) for k, found in zip(range(0, 20, 3), want, strict=True))
    monkeypatch.setattr(decontam, "CHUNK_ENTRIES", entries)
    monkeypatch.setattr(decontam, "CHUNK_BANDS", 2 if entries == 50 else 500)
    monkeypatch.setattr(decontam, "ALIGNED", 1 if entries == 50 else 1 << 10)
    assert [decontam.find_regions(t, index) for t in texts] == want
