"""Benchmark decontamination with Wu-Manber search over words.

Every benchmark item gives windows of ``window`` consecutive words (an item of fewer words
gives one shorter window). Windows of one length form a search: a shift table over blocks
of up to three words says how far the next window can be at all, so most positions of a
text are never looked at; blocks that end a window lead to a bucket of windows, and these
are compared word by word. Texts are searched whole, one pass for each length.

The benchmark is read in blocks of at most ``PASS_BYTES`` of text, each one pass over all
documents, so that what a task holds is bounded whatever the size of the benchmark.

Defined cases: a null text has no words, neither as a document nor as an item; a null
item_id is written as the text ``null``; items that share an id count once; repeated
documents give repeated rows; an empty benchmark hits nothing; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.session import materialise

WINDOW = 10
BLOCK_WORDS = 3
PASS_BYTES = 16 << 20

# Everything but digits, letters and bytes above ASCII separates words; A-Z are lowered.
WORD_TABLE = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)
HITS = "doc_id bigint, n_words bigint, spans array<struct<start:int,stop:int>>, items array<string>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_TABLE).split()


class Search:
    """All windows of one length: shift table, buckets, comparison."""

    def __init__(self, length: int, windows: dict[tuple[int, ...], set[str]]):
        self.length, self.block = length, min(BLOCK_WORDS, length)
        self.far = length - self.block + 1
        self.shift: dict[tuple[int, ...], int] = {}
        self.buckets: dict[tuple[int, ...], list[tuple[tuple[int, ...], frozenset[str]]]] = {}
        for window, items in windows.items():
            for end in range(self.block, length + 1):
                key = window[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.far), length - end)
            self.buckets.setdefault(window[-self.block :], []).append((window, frozenset(items)))

    def occurrences(self, ids: tuple[int, ...]) -> Iterator[tuple[int, frozenset[str]]]:
        """Start of each occurrence and the items it belongs to; id 0 is no benchmark word."""
        length, block, far, shift, end, n = self.length, self.block, self.far, self.shift, self.length, len(ids)
        while end <= n:
            if not ids[end - 1]:
                end += length
                continue
            key = ids[end - block : end]
            step = shift.get(key, far)
            if step:
                end += step
                continue
            for window, items in self.buckets[key]:
                if ids[end - length : end] == window:
                    yield end - length, items
            end += 1


class Matcher:
    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.ids: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, text in items:
            ids = tuple(self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text))
            length = min(window, len(ids))
            for start in range(len(ids) - length + 1 if length else 0):
                by_length.setdefault(length, {}).setdefault(ids[start : start + length], set()).add(item)
        self.searches = [Search(length, windows) for length, windows in sorted(by_length.items())]

    def match(self, text: bytes) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, disjoint spans of hit words, and the items that occur."""
        words = words_of(text)
        get = self.ids.get
        ids = tuple([get(w, 0) for w in words])
        found, items = [], set()
        for search in self.searches:
            for start, owners in search.occurrences(ids):
                found.append((start, start + search.length))
                items |= owners
        spans: list[tuple[int, int]] = []
        for start, stop in sorted(found):
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(stop, spans[-1][1]))
            else:
                spans.append((start, stop))
        return len(words), spans, sorted(items)


def _search(matcher):
    """mapInArrow function over (doc_id, text, extra keys...) for one broadcast matcher."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            rows = [matcher.value.match(t.as_py() or b"") for t in texts]
            out = {name: batch.column(name) for name in batch.schema.names if name != "text"}
            out["n_words"] = pa.array([r[0] for r in rows], pa.int64())
            span = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
            out["spans"] = pa.array([[{"start": a, "stop": b} for a, b in r[1]] for r in rows], pa.list_(span))
            out["items"] = pa.array([r[2] for r in rows], pa.list_(pa.string()))
            yield pa.RecordBatch.from_pydict(out)

    return run


def _covered(spans: Column) -> Column:
    """Words inside any of the spans, which may overlap."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], acc["upto"]))).alias("n"),
        F.greatest(acc["upto"], s["stop"]).alias("upto"),
    )
    return F.aggregate(F.array_sort(spans), start, step, lambda acc: acc["n"]).cast("bigint")


def _keyed(benchmark: DataFrame) -> DataFrame:
    """item, text and the SHA-256 of the text, for every item with a text."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.col("text").cast("binary").alias("text"),
    ).where("text is not null")
    return items.withColumn("text_key", F.sha2("text", 256))


def _parts(keyed: DataFrame, pass_bytes: int) -> list[DataFrame]:
    """The distinct texts in parts of up to ``pass_bytes``, or of one bucket of keys."""
    texts = keyed.select("text_key", "text").dropDuplicates(["text_key"])
    bucket = F.substring("text_key", 1, 4)
    sizes = texts.groupBy(bucket.alias("bucket")).agg(F.sum(F.octet_length("text")).alias("size")).orderBy("bucket").collect()
    bounds, held = [], 0
    for row in sizes:
        if not bounds or held + row["size"] > pass_bytes:
            bounds.append([row["bucket"], row["bucket"]])
            held = 0
        bounds[-1][1] = row["bucket"]
        held += row["size"]
    return [texts.where(bucket.between(*b)) for b in bounds] or [texts]


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, spans of hit words, items that occur."""
    spark = docs.sparkSession
    keyed = _keyed(benchmark)
    parts = _parts(keyed, pass_bytes)
    passes = len(parts)
    rows = docs.select("doc_id", "text")
    if passes > 1:
        rows = rows.withColumn("key", F.xxhash64("text"))
    found = None
    for part in parts:
        matcher = spark.sparkContext.broadcast(Matcher([(r["text_key"], bytes(r["text"])) for r in part.collect()], window))
        one = rows.mapInArrow(_search(matcher), HITS if passes == 1 else HITS.replace("n_words", "key bigint, n_words", 1))
        found = one if found is None else found.unionByName(one)
    if passes > 1:
        found = found.groupBy("doc_id", "key").agg(
            F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
            (F.count(F.lit(1)) / passes).cast("int").alias("copies"),
        ).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    found = materialise(found.withColumn("items", F.sort_array("items")), "benchmark-hits")
    named = keyed.groupBy("text_key").agg(F.collect_set("item").alias("named"))
    hits = found.where(F.size("items") > 0).select(F.col("items").alias("hits")).distinct()
    hits = hits.withColumn("text_key", F.explode("hits")).join(named, "text_key")
    hits = hits.groupBy("hits").agg(F.array_distinct(F.flatten(F.collect_list("named"))).alias("named"))
    # Most documents hit nothing: with one and the same empty list, they stay out of the join.
    some, none = F.size("items") > 0, F.array().cast("array<string>")
    with_hits = found.where(some).join(hits, F.col("items") == F.col("hits"), "left").drop("hits")
    found = with_hits.unionByName(found.where(~some).withColumn("named", none))
    names = F.sort_array(F.coalesce("named", none)).alias("items")
    return found.select("doc_id", "n_words", _covered(F.col("spans")).alias("n_hit"), "spans", names)


def _drop_hits(matcher, names):
    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            clean = [not matcher.value.match(t.as_py() or b"")[1] for t in texts]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """The documents in which no benchmark window occurs, with all their columns."""
    for part in _parts(_keyed(benchmark), pass_bytes):
        matcher = docs.sparkSession.sparkContext.broadcast(Matcher([(r["text_key"], bytes(r["text"])) for r in part.collect()], window))
        docs = docs.mapInArrow(_drop_hits(matcher, docs.columns), docs.schema)
    return docs
