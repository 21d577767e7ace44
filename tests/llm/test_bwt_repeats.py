import hashlib
import random
from collections import Counter

import frames
import numpy as np
import pytest

from tierstone.llm import bwt_repeats as R


def covered(parts, length):
    """Runs of each text covered by strings that start more than once in all of them."""
    seen = Counter(p[i : i + length] for p in parts for i in range(len(p) - length + 1))
    out = []
    for p in parts:
        inside = np.zeros(len(p) + 2, np.int8)
        for i in range(len(p) - length + 1):
            if seen[p[i : i + length]] > 1:
                inside[i + 1 : i + length + 1] = 1
        edges = np.flatnonzero(np.diff(inside))
        out.append(list(zip(edges[::2].tolist(), edges[1::2].tolist())))
    return out


def test_interval_expansion_equals_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        length, letters, parts = rng.choice([3, 7, 8, 12, 20, 33]), rng.choice([1, 2, 4, 250]), []
        for _ in range(rng.randrange(1, 6)):
            part = bytes(rng.randrange(letters) for _ in range(rng.randrange(60)))
            if parts and rng.random() < 0.6:
                source = rng.choice(parts)
                at = rng.randrange(len(source) + 1)
                part = part[:20] + source[at : at + 40] + part[20:30]
            parts.append(part)
        parts = list(dict.fromkeys(parts))
        assert R.compare_segments(parts, length) == covered(parts, length)


def test_segments_hold_every_string_once():
    rng = random.Random(3)
    for n in (0, 39, 40, 41, 500, 4000):
        text = bytes(rng.randrange(3) for _ in range(n))
        _, starts, stops = R.segments(text, 40)
        assert [i for a, b in zip(starts, stops) for i in range(a, b)] == list(range(max(0, n - 39)))


def corpus():
    rng = random.Random(9)
    passage = " ".join(frames.sentence(rng, 60))
    rows = [(k, " ".join(frames.sentence(rng, 80))) for k in range(20)]
    rows += [(30 + k, f"{k} " + passage + " " + " ".join(frames.sentence(rng, 30))) for k in range(15)]
    rows += [(60, "a" * 700), (61, "ab" * 150), (62, None), (63, ""), (64, "short"), (None, passage), (65, rows[0][1]), (65, rows[0][1])]
    rows += [(66, rows[1][1][:250]), (66, "文字 " * 300), (67, rows[2][1][50:300] + rows[3][1][10:260])]
    return rows


@pytest.mark.parametrize("most", [20_000, 3])
def test_documents_equal_brute_force(spark, most):
    rows = corpus()
    texts = [(t or "").encode() for _, t in rows]
    want = []
    for (i, _), text, runs in zip(rows, texts, covered(texts, 200)):
        ends = [0, *(x for run in runs for x in run), len(text)]
        kept = b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2]))
        want.append((i, len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
    found = R.remove_repeats(frames.docs(spark, rows), chunk_bytes=2000, most_segments=most)
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["runs"]), r["kept_sha256"]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_odd_rows(spark):
    found = R.remove_repeats(frames.docs(spark, frames.ODD)).collect()
    assert len(found) == len(frames.ODD) and {r["n_removed"] for r in found} == {0}
    assert R.remove_repeats(frames.docs(spark, [])).collect() == []
