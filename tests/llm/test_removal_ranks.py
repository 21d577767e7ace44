import re
from collections import Counter
from itertools import permutations

import frames
import numpy as np
from pyspark.sql import functions as F

from tierstone.llm import removal_ranks

LETTERS = "ABCDE"
LONG = " ".join(f"w{i}" for i in range(250))
ROWS = [
    *frames.ODD, (20, LONG), (21, LONG), (19, LONG), (22, "SHOUT " + LONG), (23, "same " * 300), (24, LONG + " #"),
    (25, "SAME # " * 300), (26, "word " * 400_000), (27, "word " * 400_000), (None, LONG), (None, None), (28, ""), (28, ""),
]
MARKS = [(20, 1, 0), (21, 1, None), (21, 0, 1), (25, None, 1), (None, 1, 1), (999, 1, 1), (2, 1, 0), (2, 1, 0)]


def labels_of(spark, rows=MARKS):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, quality int, toxic int, text string")


def brute_force(rows, marks):
    """rows of (doc_id, text, part)."""
    good, toxic, least = set(), set(), {}
    for doc, q, t in marks:
        good |= {doc} if q == 1 and doc is not None else set()
        toxic |= {doc} if t == 1 and doc is not None else set()
    for doc, text, _ in rows:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    flags = []
    for doc, text, _ in rows:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        flags.append("".join(letter for letter, failed in zip(LETTERS, (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            bool(re.search("[#$%&*|]", text)), doc is not None and least[text] < doc)) if failed))
    out, shapley = {}, Counter()
    for part in {p or "" for _, _, p in rows}:
        for order in permutations(LETTERS):
            left = [i for i, r in enumerate(rows) if (r[2] or "") == part]
            everyone = list(left)
            for step, f in enumerate(order, 1):
                gone = [i for i in left if f in flags[i]]
                failing = [i for i in everyone if f in flags[i]]
                redundant = len(failing) - len(gone)
                left = [i for i in left if f not in flags[i]]
                shapley[part, f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), redundant, sum(flags[i] == f for i in everyone),
                    sum(rows[i][0] in good for i in gone), sum(rows[i][0] in toxic for i in gone)]
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_equals_brute_force(spark):
    rows = [(doc, text, [None, "a", "b"][i % 3]) for i, (doc, text) in enumerate(ROWS)]
    docs = spark.createDataFrame([(d, t, p, "k", 3) for d, t, p in rows], "doc_id bigint, text string, source string, mask string, n int")
    found = removal_ranks.audit(docs, labels_of(spark)).collect()
    assert len(found) == len(set(found)) == 3 * 120 * 5
    assert set(map(tuple, found)) == brute_force(rows, MARKS)


def test_one_large_group_of_copies(spark):
    rows = [(i, "copy " * 250 if i % 3 else f"text {i}", "s") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = removal_ranks.audit(docs, labels_of(spark, [(3, 1, 0)])).collect()
    assert set(map(tuple, found)) == brute_force(rows, [(3, 1, 0)])


def test_empty_tables(spark):
    docs = frames.docs(spark, [])
    assert removal_ranks.audit(docs, labels_of(spark)).count() == 0
    assert removal_ranks.audit(frames.docs(spark, [(1, "x")]), labels_of(spark, [])).count() == 600


def test_removal_steps_are_the_first_failing_filters():
    orders = list(permutations(range(4)))
    masks = np.arange(16)
    for mask, steps in zip(masks, removal_ranks.removal_steps(masks, orders, 4)):
        for order, step in zip(orders, steps):
            assert step == next((i for i, f in enumerate(order) if mask >> f & 1), 4)


def test_other_filters(spark):
    docs = frames.docs(spark, [(1, "x"), (2, "yy"), (3, "x")])
    rows = removal_ranks.audit(docs, labels_of(spark), filters={"L": F.length("text") < 2})
    found = {tuple(r)[1:6] for r in rows.collect()}
    assert found == {("EL", 1, 2, 1, 0), ("EL", 2, 1, 1, 1), ("LE", 1, 1, 2, 0), ("LE", 2, 1, 0, 1)}
