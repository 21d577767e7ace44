"""Personal data by bootstrapped contextual extraction.

Fixed expressions find base entities of four kinds. These are the seeds: the words around
them induce lexical patterns (the word before, the two words before, the two words after),
and a pattern is as reliable as the share of its different fillers, over the whole corpus,
that are known entities. Candidates (other numbers and mixed words) in reliable patterns
become entities in turn, scored by all their patterns together, and raise the patterns they
occur in; Spark repeats this on the graph of patterns and instances. Spans of candidates
that end up known, at places where a reliable pattern holds, are added; base spans stay.

A filler is known by three words of text, so copies of a passage count once. Texts are
read for the mentions first, then to count all fillers of the patterns that at least
``MIN_SUPPORT`` mentions share. These passes are told the patterns by a bitmap of
``SLOT_BITS`` bits, so what tasks hold is bounded whatever their number; fillers let
through by chance are dropped by an exact join.

Defined cases: a null text is empty and has no span; a null doc_id is kept; repeated rows
give repeated rows with the same spans; an empty table gives no row; text is searched
whole, and every expression takes time in proportion to it; other columns play no part.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.order_minhash import word_hashes
from tierstone.session import materialise

KINDS = ("email", "ip", "card", "phone")
# A pattern needs so many different known fillers, and this share of all its fillers known.
MIN_SUPPORT = 3
MIN_CONFIDENCE = 0.5
# A candidate is known from this score on: 1 - product of (1 - confidence) of its patterns.
MIN_SCORE = 0.5
ROUNDS = 3
SIFT = 16
SLOT_BITS = 26
WORDS_AT_A_TIME = 1 << 16

EMAIL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
TOKEN_CHARS = EMAIL_CHARS | {"@"}
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
SPACED = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PLUS = re.compile(r"\+[0-9][\x20().0-9-]*+")
NUMBER = re.compile(r"[0-9](?:[\x20()./-]{0,3}+[0-9])*+")
WORD = re.compile(r"[^\x20\x09-\x0D]++")
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

SPAN = "struct<start:int,kind:int,end:int>"
CONTEXT = "struct<pattern:bigint,filler:bigint,words:string>"
MENTION = f"struct<start:int,end:int,kind:int,surface:string,contexts:array<{CONTEXT}>>"
SCANNED = f"row_id bigint, doc_id bigint, base array<{SPAN}>, mentions array<{MENTION}>"
ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
ARROW_MENTIONS = pa.list_(pa.struct([
    ("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("surface", pa.string()),
    ("contexts", pa.list_(pa.struct([("pattern", pa.int64()), ("filler", pa.int64()), ("words", pa.string())]))),
]))


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The local part is the whole run of its characters before the sign, up to the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in EMAIL_CHARS:
            start -= 1
        if start < at and (found := DOMAIN.match(text, at)):
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers at a time of each dotted chain."""
    for chain in DOTTED.finditer(text):
        parts = chain.group().split(".")
        start = chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, end
            start = end + 1


def cards(text: str) -> Iterator[tuple[int, int]]:
    for found in SPACED.finditer(text):
        if found.end() - found.start() >= 14 and 14 <= len(digits := _digits(found.group())) <= 19 and luhn(digits):
            yield found.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for found in PLUS.finditer(text):
        whole = found.group().rstrip(" ().-")
        if len(whole) >= 4 and 10 <= len(_digits(whole)) <= 15:
            yield found.start(), found.start() + len(whole)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base entities, by start and kind."""
    found = []
    if "@" in text:
        found += [(s, 0, e) for s, e in emails(text)]
    found += [(s, 1, e) for s, e in addresses(text)]
    found += [(s, 2, e) for s, e in cards(text)]
    if "+" in text:
        found += [(s, 3, e) for s, e in phones(text)]
    return sorted(found)


def _token(text: str, at: int) -> tuple[int, int]:
    """The run of token characters around a place, without stops and signs at its ends."""
    start, end = at, at + 1
    while start and text[start - 1] in TOKEN_CHARS:
        start -= 1
    while end < len(text) and text[end] in TOKEN_CHARS:
        end += 1
    while end > start and text[end - 1] in ".%+-@_":
        end -= 1
    while start < end and text[start] in ".%-@_":
        start += 1
    return start, end


def candidate_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Numbers of six digits or more, words with four digits or more, words with an @; none touches a base span."""
    found, reached = [], -1
    for number in NUMBER.finditer(text):
        start, end = number.span()
        if len(_digits(number.group())) >= 6:
            found.append((start - (start > 0 and text[start - 1] == "+"), end))
        if start >= reached:
            word = _token(text, start)
            reached = max(reached, word[1])
            if len(_digits(text[word[0] : word[1]])) >= 4:
                found.append(word)
    at = text.find("@")
    while at >= 0:
        word = _token(text, at)
        if word[1] - word[0] >= 3:
            found.append(word)
        at = text.find("@", max(at + 1, word[1]))
    taken = sorted((s, e) for s, _, e in base)
    begins, ends = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
    free, last = [], 0
    for start, end in sorted(set(found), key=lambda s: (s[0], -s[1])):
        before = bisect_left(begins, end)  # base spans that begin before this one ends
        if last <= start < end and not (before and ends[before - 1] > start):
            free.append((start, end))
            last = end
    return free


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


A, B, C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def text_hashes(text: bytes) -> np.ndarray:
    words = text.translate(LOWER).split()
    parts = [word_hashes(words[i : i + WORDS_AT_A_TIME]) for i in range(0, len(words), WORDS_AT_A_TIME)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


@dataclass
class Contexts:
    """For each word of a text: the patterns that hold if a filler begins or ends there, and the filler."""

    before: np.ndarray  # one word before, from word 1 on
    before_two: np.ndarray  # two words before, from word 2 on
    after_two: np.ndarray  # two words after, up to the third last word
    begins: np.ndarray  # three words from here
    ends: np.ndarray  # three words up to here

    @classmethod
    def of(cls, h: np.ndarray) -> Contexts:
        with np.errstate(over="ignore"):
            padded = np.concatenate([np.zeros(2, np.uint64), h, np.zeros(2, np.uint64)])
            triples = _mix(padded[:-2] * A + _mix(padded[1:-1] * B + padded[2:] * C))
            pairs = _mix(h[:-1] * A + _mix(h[1:] * B))
            return cls(_mix(h[:-1] * C + A), _mix(pairs[:-1] if len(h) > 2 else pairs[:0]), _mix(pairs[1:] + C), triples[2:], triples[:-2])


def _signed(value: np.uint64) -> int:
    return int(np.uint64(value).view(np.int64))


def mentions_of(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Seeds and candidates of a text with their contexts."""
    spans = [(s, e, kind) for s, kind, e in base] + [(s, e, None) for s, e in candidate_spans(text, base)]
    if not spans:
        return []
    words = [m.span() for m in WORD.finditer(text)]
    starts = [s for s, _ in words]
    h = text_hashes(text.encode("utf-8", "surrogatepass"))
    around, n = Contexts.of(h), len(h)
    said = lambda i, j: " ".join(text[s : min(e, s + 40)] for s, e in words[i:j])
    out = []
    for start, end, kind in sorted(spans, key=lambda s: s[:2]):
        i, j = bisect_right(starts, start) - 1, bisect_right(starts, end - 1) - 1
        contexts = []
        if i >= 1:
            contexts.append((around.before[i - 1], around.begins[i], said(i - 1, i) + " _"))
        if i >= 2:
            contexts.append((around.before_two[i - 2], around.begins[i], said(i - 2, i) + " _"))
        if j + 2 < n:
            contexts.append((around.after_two[j], around.ends[j], "_ " + said(j + 1, j + 3)))
        out.append({
            "start": start, "end": end, "kind": kind, "surface": text[start:end].lower(),
            "contexts": [{"pattern": _signed(p), "filler": _signed(f), "words": w} for p, f, w in contexts]})
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        ids, base, mentions = [], [], []
        for text in batch.column("text"):
            text = text.as_py() or ""
            found = base_spans(text)
            ids.append(number)
            base.append([{"start": s, "kind": k, "end": e} for s, k, e in found])
            mentions.append(mentions_of(text, found))
            number += 1
        yield pa.RecordBatch.from_pydict({
            "row_id": pa.array(ids, pa.int64()), "doc_id": batch.column("doc_id"), "base": pa.array(base, ARROW_SPANS),
            "mentions": pa.array(mentions, ARROW_MENTIONS)})


def _fillers(bitmap, every: int):
    """The (pattern, filler) of the texts whose pattern is in the bitmap, each once for a batch; of ``every`` fillers one."""

    def run(batches):
        table = np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            patterns, fillers = [], []
            for text in batch.column("text").cast(pa.binary()):
                h = text_hashes(text.as_py() or b"")
                if len(h) < 2:
                    continue
                c = Contexts.of(h)
                for pattern, filler in ((c.before, c.begins[1:]), (c.before_two, c.begins[2:]), (c.after_two, c.ends[: len(c.after_two)])):
                    pattern = pattern[: len(filler)]
                    if every > 1:
                        drawn = filler & np.uint64(every - 1) == 0
                        pattern, filler = pattern[drawn], filler[drawn]
                    slot = pattern >> np.uint64(64 - SLOT_BITS)
                    known = (table[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    patterns.append(pattern[known])
                    fillers.append(filler[known])
            if patterns:
                pattern, filler = np.concatenate(patterns), np.concatenate(fillers)
                order = np.lexsort((filler, pattern))
                pattern, filler = pattern[order], filler[order]
                new = np.r_[True, (pattern[1:] != pattern[:-1]) | (filler[1:] != filler[:-1])][: len(pattern)]
                yield pa.RecordBatch.from_pydict({"pattern": pattern[new].view(np.int64), "filler": filler[new].view(np.int64)})

    return run


def _counted(docs: DataFrame, patterns: DataFrame, every: int) -> DataFrame:
    value = F.shiftrightunsigned("pattern", 64 - SLOT_BITS) + 1
    pages = patterns.groupBy(F.bitmap_bucket_number(value).alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits"))
    table = bytearray((1 << SLOT_BITS) // 8)
    for row in pages.toLocalIterator():  # pages of 4 KB, no more than the table has
        table[(row.page - 1) * 4096 : row.page * 4096] = row.bits
    shared = docs.sparkSession.sparkContext.broadcast(bytes(table))
    found = docs.select("text").mapInArrow(_fillers(shared, every), "pattern bigint, filler bigint").distinct()
    return found.join(patterns.select("pattern"), "pattern", "left_semi").groupBy("pattern").agg(F.count(F.lit(1)).alias("total"))


def filler_counts(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """How many different fillers each pattern has in all texts: pattern, total.

    Patterns that cannot be reliable are left out: those with more fillers than their
    mentions (``fillers``) could account for. Common words are found out by a first pass that
    keeps one filler of ``SIFT``: when already these are too many, all are.
    """
    most = F.col("fillers") / MIN_CONFIDENCE
    some = _counted(docs, patterns, SIFT)
    left = patterns.join(some, "pattern", "left").where(F.coalesce("total", F.lit(0)) <= most).select("pattern", "fillers")
    return _counted(docs, materialise(left, "sifted-patterns"), 1)


def score_patterns(edges: DataFrame, known: DataFrame) -> DataFrame:
    """Confidence of each pattern for each kind, from the scores of the instances in it."""
    best = edges.join(known, "instance").groupBy("pattern", "total", "kind", "filler").agg(F.max("score").alias("score"))
    share = F.sum("score") / F.greatest("total", F.count(F.lit(1)))
    return best.groupBy("pattern", "total", "kind").agg(
        share.alias("confidence"), F.count_if(F.col("score") >= MIN_SCORE).alias("support")
    ).where((F.col("support") >= MIN_SUPPORT) & (F.col("confidence") >= MIN_CONFIDENCE))


def score_instances(edges: DataFrame, patterns: DataFrame) -> DataFrame:
    """Instances that are no seeds, with their likeliest kind and its score."""
    pairs = edges.where(~F.col("seed")).select("pattern", "instance").distinct()
    doubt = F.sum(F.log(1 - F.least(F.col("confidence"), F.lit(0.99))))
    scores = pairs.join(patterns.select("pattern", "kind", "confidence"), "pattern").groupBy("instance", "kind").agg(
        (1 - F.exp(doubt)).alias("score"))
    return scores.groupBy("instance").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind"), F.max("score").alias("score"))


def learn(docs: DataFrame, scanned: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """The reliable patterns (pattern, words, kind, confidence, support) and the instances found by them (instance, kind, score)."""
    mention = F.col("m")
    edges = scanned.select(F.explode("mentions").alias("m")).select(
        F.xxhash64(mention["surface"]).alias("instance"), mention["kind"].alias("kind"), F.explode(mention["contexts"]).alias("c"))
    edges = edges.groupBy("c.pattern", "c.filler", "instance", "kind").agg(F.min("c.words").alias("words"))
    edges = materialise(edges, "mention-edges")
    several = edges.groupBy("pattern", "filler").agg(F.min("words").alias("words")).groupBy("pattern").agg(
        F.count(F.lit(1)).alias("fillers"), F.min("words").alias("words")).where(F.col("fillers") >= MIN_SUPPORT)
    several = materialise(several, "shared-patterns")
    totals = filler_counts(docs, several.select("pattern", "fillers"))
    seeds = edges.where("kind is not null").select("instance", "kind", F.lit(1.0).alias("score")).distinct()
    graph = edges.join(several.select("pattern"), "pattern", "left_semi").join(totals, "pattern")
    graph = materialise(graph.select("pattern", "total", "filler", "instance", F.col("kind").isNotNull().alias("seed")), "pattern-graph")
    known = seeds = materialise(seeds, "seeds")
    for _ in range(rounds):
        patterns = materialise(score_patterns(graph, known), "patterns")
        instances = materialise(score_instances(graph, patterns), "instances")
        known = seeds.unionByName(instances.where(F.col("score") >= MIN_SCORE))
    return patterns.join(several, "pattern").drop("fillers", "total"), instances.where(F.col("score") >= MIN_SCORE)


def find(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, base and added spans (start, kind, end; kinds as numbered in ``KINDS``)."""
    docs = docs.select("doc_id", "text")
    scanned = materialise(docs.mapInArrow(_scan, SCANNED), "scanned")
    patterns, instances = learn(docs, scanned, rounds)
    candidates = scanned.select("row_id", F.explode("mentions").alias("m")).where("m.kind is null")
    candidates = candidates.select(
        "row_id", "m.start", "m.end", F.xxhash64("m.surface").alias("instance"), F.explode("m.contexts.pattern").alias("pattern"))
    held = candidates.join(patterns.select("pattern", "kind"), "pattern").join(instances.select("instance", "kind"), ["instance", "kind"])
    added = held.select("row_id", "start", "kind", "end").distinct()
    added = added.groupBy("row_id").agg(F.collect_list(F.struct("start", "kind", "end")).alias("added"))
    # Documents without a candidate meet no join.
    some = F.exists("mentions", lambda m: m["kind"].isNull())
    none = F.array().cast(f"array<{SPAN}>")
    with_some = scanned.where(some).drop("mentions").join(added, "row_id", "left").withColumn("added", F.coalesce("added", none))
    without = scanned.where(~some).drop("mentions").withColumn("added", none)
    return with_some.unionByName(without).select("doc_id", "base", F.array_sort("added").alias("added"))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
