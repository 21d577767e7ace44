import math
import random

import frames
import pytest
from pyspark.sql import functions as F

from tierstone.llm import site_quality as Q


def tables(spark):
    rng, rows, marks = random.Random(12), [], []
    for k in range(600):
        site = f"s{k % 6}"
        good = rng.random() < (0.2 if site == "s0" else 0.9)
        words = frames.sentence(rng, 40)
        text = " ".join(words) if good or rng.random() < 0.3 else " ".join(w.upper() + "!!" for w in words)
        rows.append((k, text, site, "p" + str(k % 2)))
        if k % 3:
            marks.append((k, int(good), 0))
    docs = spark.createDataFrame([(*r, 1.0, "h") for r in rows], "doc_id bigint, text string, source string, lang string, score double, host string")
    return rows, docs, spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int"), dict((i, q) for i, q, _ in marks)


def test_site_evidence_helps_held_out_documents(spark):
    _, docs, labels, truth = tables(spark)
    found = Q.classify(docs, labels, F.col("source"), F.col("lang")).collect()
    held = [r for r in found if r["held_out"] and r["doc_id"] in truth]
    right = lambda name: sum((r[name] >= 0.5) == truth[r["doc_id"]] for r in held)
    assert len(found) == 600 and right("score") >= right("doc_score") and right("score") >= 0.8 * len(held)


def test_sparse_sites_stay_near_the_prior(spark):
    _, docs, labels, _ = tables(spark)
    lone = docs.limit(1).select(F.lit(7000).cast("bigint").alias("doc_id"), "text", F.lit("lone").alias("source"), "lang", "score", "host")
    found = {r["doc_id"]: r for r in Q.classify(docs.unionByName(lone), labels, F.col("source"), F.col("lang")).collect()}
    scores = [r["host_score"] for i, r in found.items() if i != 7000]
    assert min(scores) < found[7000]["host_score"] < max(scores)


def test_odd_rows(spark):
    docs = frames.docs(spark, frames.ODD).withColumn("source", F.when(F.col("doc_id") > 4, F.col("source")))
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    found = Q.classify(docs, none, F.col("source"), F.lit(None).cast("string")).collect()
    assert len(found) == len(frames.ODD) and all(abs(r["score"] - 0.5) < 1e-6 for r in found)
    some = spark.createDataFrame([(5, 1), (5, 0), (8, 0), (None, 1), (9, None)], "doc_id bigint, quality int")
    assert all(0 <= r["score"] <= 1 for r in Q.classify(docs, some, F.col("source"), F.col("lang")).collect())
    assert Q.classify(docs.limit(0), none, F.col("source"), F.col("lang")).collect() == []


def plain_strength(groups):
    """Mean and prior weight of groups given as (n, s), by the method of moments."""
    n, s = sum(g[0] for g in groups), sum(g[1] for g in groups)
    mean = s / n
    within = mean * (1 - mean)
    spread = (sum(b * b / a for a, b in groups) - n * mean**2 - (len(groups) - 1) * within) / max(n - sum(a * a for a, _ in groups) / n, 1e-9)
    return mean, max(1.0, within / max(spread, 1e-6) - 1)


def test_posteriors_equal_a_plain_computation(spark):
    rows, docs, labels, truth = tables(spark)
    found = {r["doc_id"]: r for r in Q.classify(docs, labels, F.col("source"), F.col("lang")).collect()}
    own = {i: float(truth[i]) if i in truth and not r["held_out"] else r["doc_score"] for i, r in found.items()}
    hosts, paths = {}, {}
    for i, _, host, path in rows:
        for groups, key in ((hosts, host), (paths, (host, path))):
            n, s = groups.get(key, (0, 0.0))
            groups[key] = n + 1, s + own[i]
    mean, host_weight = plain_strength(list(hosts.values()))
    _, path_weight = plain_strength(list(paths.values()))
    logit = lambda p: math.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))
    for i, _, host, path in rows:
        n, s = hosts[host]
        host_score = (s - own[i] + host_weight * mean) / (n - 1 + host_weight)
        n, s = paths[host, path]
        path_score = (s - own[i] + path_weight * host_score) / (n - 1 + path_weight)
        score = 1 / (1 + math.exp(-(logit(found[i]["doc_score"]) + logit(path_score) - logit(mean))))
        assert [found[i][c] for c in ("host_score", "path_score", "score")] == pytest.approx([host_score, path_score, score], abs=1e-9)
