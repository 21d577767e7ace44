import random
from collections import Counter, defaultdict

import frames
import numpy as np
import pytest

from tierstone.llm import order_minhash as O


def common(a, b, band):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1, j + 1] = max(table[i, j + 1], table[i + 1, j], table[i, j] + (a[i] == b[j] and abs(i - j) <= band))
    return table[-1, -1]


def test_banded_matches_equal_dynamic_programming():
    rng = random.Random(1)
    for _ in range(200):
        a = np.array([rng.randrange(6) for _ in range(rng.randrange(1, 25))], np.uint64)
        b = np.array([x for x in a if rng.random() < 0.8] or [1], np.uint64) if rng.random() < 0.5 else a[::-1].copy()
        band = rng.randrange(30)
        assert O.matches_in_band(a, b, band) == common(a, b, band)


def test_similarity_is_the_aligned_share():
    rng = random.Random(2)
    for _ in range(100):
        a = np.array([rng.randrange(50) for _ in range(rng.randrange(1, 40))], np.uint64)
        b = np.array([x for x in a if rng.random() < 0.95] or [7], np.uint64)
        matched = common(a, b, 1000)
        exact = matched / (len(a) + len(b) - matched)
        assert (O.similarity(a, b) >= 0.8) == (exact >= 0.8)


def classes_by_brute_force(rows):
    shingles = [O.shingle_hashes(O.words_of((t or "").encode())) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if O.similarity(shingles[i], shingles[j]) >= 0.8:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        groups[find(k)].append(i)
    return sorted(sorted(map(repr, g)) for g in groups.values())


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return words


def corpus():
    """Chains of edits, a crowd of near copies, and a passage that many other texts share."""
    rng, rows = random.Random(6), []
    base = frames.sentence(rng, 150)
    for _ in range(40):
        rows.append(edited(rng, base, rng.randrange(5)))
    link = frames.sentence(rng, 200)
    for _ in range(12):
        rows.append(link)
        link = edited(rng, link, 3)
    passage = frames.sentence(rng, 60)
    rows += [frames.sentence(rng, rng.randrange(5, 50)) + passage for _ in range(60)]
    rows += [frames.sentence(rng, rng.randrange(1, 80)) for _ in range(20)]
    rows = [" ".join(r) for r in rows]
    return [(k, t) for k, t in enumerate(rows + rows[:5])]


def crowd(rng, n):
    """Texts that share most of a long passage: any two lie between 0.7 and 0.8, but for a few chains of links."""
    base, rows = frames.sentence(rng, 200), []
    for _ in range(n):
        rows.append(edited(rng, base, rng.randrange(4, 7)))
    return [" ".join(r) for r in rows]


@pytest.mark.parametrize("members", [O.GROUP_MEMBERS, 3])
@pytest.mark.parametrize("kind", ["corpus", "crowd"])
def test_classes_equal_brute_force(spark, kind, members):
    rows = corpus() if kind == "corpus" else list(enumerate(crowd(random.Random(9), 120)))
    groups = defaultdict(list)
    found = O.near_copies(frames.docs(spark, rows), group_members=members).collect()
    for r in found:
        groups[r["class_id"]].append(r["doc_id"])
    assert all(k == min(g) for k, g in groups.items())
    assert sorted(sorted(map(repr, g)) for g in groups.values()) == classes_by_brute_force(rows)
    assert sum(r["kept"] for r in found) == len(groups)


def group_of(texts, roots):
    shingles = [O.shingle_hashes(O.words_of(t.encode())) for t in texts]
    return O.Members({
        "nodes": [b"%d" % i for i in range(len(texts))], "roots": roots, "counts": list(map(len, shingles)),
        "sketches": np.arange(2 * len(texts)).tobytes(), "shingles": np.concatenate(shingles).tobytes()}, "")


def test_shared_shingles_are_counted_exactly():
    rng = random.Random(4)
    texts = crowd(rng, 12) + ["w " * 30, "w " * 12, "lone words only here"]
    members = group_of(texts, [b"r"] * len(texts))
    with np.errstate(over="ignore"):
        bags = [Counter(O.shingle_hashes(O.words_of(t.encode())).tolist()) for t in texts]
    wanted = [[sum((a & b).values()) for b in bags] for a in bags]
    assert (O.shared_shingles(members, members) == wanted).all() and (O.shared_shingles(members, members, 7) == wanted).all()


def test_a_tile_gives_few_links():
    rng = random.Random(5)
    base = frames.sentence(rng, 300)
    members = group_of([" ".join(edited(rng, base, 1)) for _ in range(40)], [b"%d" % (i % 20) for i in range(40)])
    assert len(O.tile_links(members, members, True, 0, 0.8)) == 19


def test_odd_rows(spark):
    table = frames.docs(spark, frames.ODD)
    found = O.near_copies(table).collect()
    assert len(found) == len(frames.ODD)
    assert {r["class_id"] for r in found if r["doc_id"] in (5, 6, 7)} == {5}
    assert all(r["class_id"] == r["doc_id"] and r["kept"] for r in found if r["doc_id"] in (1, 2, 3, 4, 9))
    left = O.drop_near_copies(table)
    assert left.columns == table.columns
    assert sorted(map(repr, (tuple(r) for r in left.select("doc_id", "text").collect()))) == sorted(map(repr, [
        (1, None), (2, ""), (3, " \t\n"), (4, "?!. ,"), (5, "one two three"), (None, "nobody's text"), (8, "first text"),
        (8, "second text"), (9, "Ünïcödé ß text ß 文字")]))


def test_empty_table(spark):
    empty = frames.docs(spark, [])
    assert O.near_copies(empty).collect() == [] and O.drop_near_copies(empty).collect() == []
