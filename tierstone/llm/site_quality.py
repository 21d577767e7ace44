"""Document quality with hierarchical empirical Bayes over sites.

A logistic classifier reads simple shares of each whole text (letters, capitals, symbols,
digits, different words, different lines). Its evidence is then combined with what is known
of the place a document comes from: hosts are shrunk towards the global mean and the paths
of a host towards their host, by prior strengths estimated from the spread between groups
(method of moments), so a path with few documents says little and one with many says much.
A group's mean takes the label where a document has one outside the held-out fold and the
classifier's probability elsewhere; a document's own share is taken out of its groups.

The classifier is fitted on at most ``SAMPLE`` labelled rows in the order of a hash of
doc_id; groups are aggregated over all documents with partial sums before the shuffle.

Defined cases: a null text is empty; a null host or path is a group of its own; a null
doc_id has no label; of several labels of one document the highest counts; without labels
every score is the prior 0.5; repeated rows give repeated rows; other columns play no part.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.compression_toxicity import held_out, logistic
from tierstone.session import materialise

SAMPLE = 10_000
CUT_OFF = 0.5
FEATURES = ["length", "letters", "capitals", "symbols", "digits", "word_length", "new_words", "new_lines"]


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def features(docs: DataFrame, host: Column, path: Column) -> DataFrame:
    """doc_id, host, path and the features of each text."""
    rows = docs.select("doc_id", host.alias("host"), path.alias("path"), F.coalesce("text", F.lit("")).alias("text"))
    text, size = F.col("text"), F.greatest(F.length("text"), F.lit(1))
    rows = rows.withColumn("words", F.split(text, r"\s+")).withColumn("lines", F.split(text, r"\n"))
    capitals = _count(text, r"\p{Lu}")
    letters = _count(text, r"\p{L}")
    share = lambda items: F.size(F.array_distinct(items)) / F.greatest(F.size(items), F.lit(1))
    values = [
        F.log1p(F.length(text)), letters / size, capitals / F.greatest(letters, F.lit(1)), _count(text, r"[^\p{L}\p{N}\s]") / size,
        _count(text, r"\p{N}") / size, F.log1p(F.length(text) / F.size("words")), share(F.col("words")), share(F.col("lines")),
    ]
    return rows.select("doc_id", "host", "path", *[v.cast("double").alias(n) for v, n in zip(values, FEATURES)])


def _logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(p / (1 - p))


def _strength(groups: DataFrame) -> tuple[float, float]:
    """Global mean and the weight of a prior, in documents, from the spread of group means."""
    k, n, s, n2, sq = groups.agg(
        F.count(F.lit(1)), F.sum("n"), F.sum("s"), F.sum(F.col("n") * F.col("n")), F.sum(F.col("s") * F.col("s") / F.col("n"))).first()
    if not n:
        return 0.5, 1.0
    mean = min(max(s / n, 1e-6), 1 - 1e-6)
    within = mean * (1 - mean)
    spread = (sq - n * mean * mean - (k - 1) * within) / max(n - n2 / n, 1e-9)
    return mean, max(1.0, within / max(spread, 1e-6) - 1)


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """doc_id, held_out, doc_score, host_score, path_score, score, predicted of every document."""
    rows = features(docs, host, path).withColumn("held_out", held_out(F.col("doc_id")))
    marks = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("mark"))
    marks = marks.where(~held_out(F.col("doc_id")))
    rows = materialise(rows.join(marks, "doc_id", "left"), "quality-features")

    sample = rows.where("mark is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).select("mark", *FEATURES).collect()
    marked = np.array([r[0] for r in sample], float)
    values = np.array([r[1:] for r in sample], float).reshape(len(sample), len(FEATURES))
    if len(sample):
        centre, scale = values.mean(0), values.std(0) + 1e-9
        weights = logistic((values - centre) / scale, marked)
    else:
        centre, scale, weights = np.zeros(len(FEATURES)), np.ones(len(FEATURES)), [0.0] * (len(FEATURES) + 1)
    evidence = F.lit(weights[0])
    for name, w, c, s in zip(FEATURES, weights[1:], centre.tolist(), scale.tolist()):
        evidence = evidence + F.lit(w) * ((F.col(name) - F.lit(c)) / F.lit(s))
    doc_score = 1 / (1 + F.exp(-evidence))
    rows = rows.select("doc_id", "held_out", "host", "path", doc_score.alias("doc_score"), F.coalesce("mark", doc_score).cast("double").alias("own"))

    paths = materialise(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("own").alias("s")), "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    mean, host_weight = _strength(hosts)
    _, path_weight = _strength(paths)
    groups = paths.alias("p").join(hosts.alias("h"), F.col("p.host").eqNullSafe(F.col("h.host"))).select(
        F.col("p.host").alias("group_host"), F.col("p.path").alias("group_path"), F.col("p.n").alias("path_n"), F.col("p.s").alias("path_s"),
        F.col("h.n").alias("host_n"), F.col("h.s").alias("host_s"))
    found = rows.join(groups, F.col("host").eqNullSafe(F.col("group_host")) & F.col("path").eqNullSafe(F.col("group_path")))
    found = found.withColumn("host_score", (F.col("host_s") - F.col("own") + host_weight * mean) / (F.col("host_n") - 1 + host_weight))
    found = found.withColumn(
        "path_score", (F.col("path_s") - F.col("own") + path_weight * F.col("host_score")) / (F.col("path_n") - 1 + path_weight))
    both = _logit(F.col("doc_score")) + _logit(F.col("path_score")) - _logit(F.lit(mean))
    found = found.withColumn("score", 1 / (1 + F.exp(-both)))
    return found.select(
        "doc_id", "held_out", "doc_score", "host_score", "path_score", "score", (F.col("score") >= CUT_OFF).cast("int").alias("predicted"))
