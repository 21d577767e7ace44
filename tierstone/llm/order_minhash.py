"""Near-duplicates by Order MinHash and banded alignment.

A document is its sequence of shingles of five words, each labelled with how often it has
occurred before in the document. A sketch takes the few labelled shingles with the smallest
hash values and keeps them in text order; documents with an equal sketch are candidates.
Two documents are near copies when an alignment of their shingle sequences inside a band
matches at least ``SIMILARITY`` of all shingles of both (matches / (n1 + n2 - matches)).
The classes are the connected components of the near copies.

Documents of equal words are one node. In each bucket of equal sketches, members are first
aligned with the smallest member only. Buckets whose members then lie in one class are
settled. The members of the others are dealt, class by class, into groups of bounded size,
and each two groups of a bucket form a tile: one matrix product counts the shingles that
any two members of different classes share, which bounds their similarity, and the pairs it
leaves are aligned, the likeliest first, until their classes have met. So no link between
two classes is lost, a tile gives no more links than it has members, and neither a row nor
a task ever holds a bucket as a whole. A pair that shares several buckets is looked at in
the first. In the first round, lengths and a screen of further minima spare most alignments;
a pair it drops by chance is met again in a tile.

Defined cases: a null text has no words; documents without words are classes of their own
and link to none; texts of one to four words are one shingle; repeated rows share a class;
a null doc_id gets the class of its text, and null where it has no words; an empty table
gives no row; other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.wu_manber import words_of
from tierstone.session import materialise

SHINGLE_WORDS = 5
SIMILARITY = 0.8
SKETCHES = 16
SKETCH_SIZE = 3
# A group has at most so many members and, unless it is one long text, so many shingles.
GROUP_MEMBERS, GROUP_SHINGLES = 256, 1 << 18
# A bucket of more members is grouped by several tasks.
MEMBERS_PER_TASK = 8192
# The screen: in each sketch's order, the smallest value among all shingles and in each of
# ``BINS`` parts of them, cut to bytes. Near copies share each with the probability of
# their similarity; at 0.8 fewer than these many are shared once in a million times.
BINS, SHORT = 4, 64
LEAST_SHARED, LEAST_SHARED_SHORT = 36, 5
SEED = 0x5EED


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input touches every bit of the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _constants(n: int, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mixed((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 20)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


BYTE_VALUES = _constants(256, SEED)
PLACES = _constants(4096, SEED + 1)
SEEDS = _constants(SKETCHES, SEED + 2)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word from its bytes and their places."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    data = BYTE_VALUES[np.frombuffer(b"".join(words), np.uint8)]
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    with np.errstate(over="ignore"):
        data = _mixed(data * PLACES[place % len(PLACES)] + place.astype(np.uint64))
        return _mixed(np.add.reduceat(data, starts) + lengths.astype(np.uint64))


def shingle_hashes(words: list[bytes], size: int = SHINGLE_WORDS) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    hashes = word_hashes(words)
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(total)])
    return total


def occurrence_labels(values: np.ndarray) -> np.ndarray:
    """How often each value occurred before."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    labels = np.empty(len(values), np.uint64)
    labels[order] = np.arange(len(values)) - np.repeat(first, np.diff(np.r_[first, len(values)]))
    return labels


def sketches(shingles: np.ndarray, size: int = SKETCH_SIZE) -> tuple[np.ndarray, np.ndarray]:
    """One number for each sketch, the smallest labelled shingles hashed in text order, and the lanes of the screen."""
    size = min(size, len(shingles))
    out, lanes = np.empty(SKETCHES, np.uint64), np.zeros((BINS + 1, SKETCHES), np.uint64)
    with np.errstate(over="ignore"):
        labelled = _mixed(shingles + occurrence_labels(shingles) * np.uint64(0x9E3779B97F4A7C15))
        part = (labelled >> np.uint64(62)).astype(np.int8)
        place = np.argsort(part, kind="stable")
        ordered, part = labelled[place], part[place]
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        bins = part[starts]
        for k, seed in enumerate(SEEDS):
            values = ordered * seed  # mixed values times a random odd number: another random order
            least = np.minimum.reduceat(values, starts)
            lanes[bins, k], lanes[BINS, k] = least, least.min()
            chosen = np.argpartition(values, size - 1)[:size] if size < len(values) else np.arange(size)
            total = np.uint64(size)
            for at in np.sort(place[chosen]):
                total = _mixed(total * seed + labelled[at])
            out[k] = total
    return out, (lanes >> np.uint64(20)).astype(np.uint8).view(np.int8).ravel()


def matches_in_band(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Longest common subsequence of a and b that stays within ``band`` of the diagonal.

    Bit-parallel: bit i of the row says whether a column step is free at a's i-th item;
    only the bits inside the band are held.
    """
    places: dict[int, list[int]] = {}
    for i, value in enumerate(a.tolist()):
        places.setdefault(value, []).append(i)
    width = 2 * band + 1
    full = (1 << width) - 1
    low, row, matched = -band, full, 0  # bit 0 of the row is item ``low`` of a
    n = len(a)
    for j, value in enumerate(b.tolist()):
        if j - band > low:
            if low >= 0:
                matched += not row & 1
            row = (row >> 1) | (1 << (width - 1))
            low += 1
        hits = 0
        for i in places.get(value, ()):
            if 0 <= i - low < width:
                hits |= 1 << (i - low)
        if hits:
            free = row & hits
            row = ((row + free) | (row - free)) & full
    top = min(width, n - low)
    if top > 0:
        kept = row & ((1 << top) - 1)
        matched += top - kept.bit_count()
    return matched


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Aligned share of the shingles of both; 0 where it is certainly below ``least``."""
    n = len(a) + len(b)
    if not len(a) or not len(b) or min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    shared = min(len(a), len(b))
    head = np.flatnonzero(a[:shared] != b[:shared])
    head = int(head[0]) if len(head) else shared
    a, b = a[head:], b[head:]
    shared = min(len(a), len(b))
    tail = np.flatnonzero(a[len(a) - shared :][::-1] != b[len(b) - shared :][::-1])
    tail = int(tail[0]) if len(tail) else shared
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    # matches / (n - matches) >= least, so at most this many items stay unmatched.
    unmatched = int(n * (1 - least) / (1 + least) + 1e-9)
    matched = head + tail
    if len(a) and len(b):
        matched += matches_in_band(a, b, unmatched + 1)
    return matched / (n - matched)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, lengths, found, screens = [], [], [], []
        for text in batch.column("text").cast(pa.binary()):
            words = words_of(text.as_py() or b"")
            shingles = shingle_hashes(words)
            nodes.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None)
            lengths.append(len(shingles))
            drawn, lanes = sketches(shingles) if words else (np.zeros(0, np.uint64), np.zeros(0, np.int8))
            found.append(drawn.view(np.int64).tolist())
            screens.append(lanes.tolist())
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), "node": pa.array(nodes, pa.binary()),
            "n": pa.array(lengths, pa.int64()), "sketches": pa.array(found, pa.list_(pa.int64())),
            "lanes": pa.array(screens, pa.list_(pa.int8()))})


GROUP = "band int, key bigint, group bigint, one_root binary, nodes array<binary>, roots array<binary>, sketches binary, counts array<int>, shingles binary"
GROUP_FIELDS = pa.schema([
    ("band", pa.int32()), ("key", pa.int64()), ("group", pa.int64()), ("one_root", pa.binary()), ("nodes", pa.list_(pa.binary())),
    ("roots", pa.list_(pa.binary())), ("sketches", pa.binary()), ("counts", pa.list_(pa.int32())), ("shingles", pa.binary()),
])


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingle_hashes(words_of(t.as_py() or b"")).tobytes() for t in batch.column("text").cast(pa.binary())]
        yield pa.RecordBatch.from_pydict({"node": batch.column("node"), "shingles": pa.array(found, pa.binary())})


def _groups(members: int, shingles: int):
    """Members of buckets, which come in order of bucket and root, as rows of whole groups."""

    def run(batches):
        numbers = count(TaskContext.get().partitionId() << 32)
        bucket, held, size = None, [], 0

        def group() -> pa.RecordBatch:
            nodes, roots, drawn, texts = zip(*held)
            return pa.RecordBatch.from_pylist([{
                "band": bucket[0], "key": bucket[1], "group": next(numbers), "one_root": roots[0] if len(set(roots)) == 1 else None,
                "nodes": nodes, "roots": roots, "sketches": np.array(drawn, np.int64).tobytes(),
                "counts": [len(t) // 8 for t in texts], "shingles": b"".join(texts)}], GROUP_FIELDS)

        for batch in batches:
            for band, key, node, root, drawn, text in zip(*[batch.column(c).to_pylist() for c in ("band", "key", "node", "root", "sketches", "shingles")]):
                if held and (bucket != (band, key) or len(held) == members or size + len(text) > 8 * shingles):
                    yield group()
                    held, size = [], 0
                bucket = band, key
                held.append((node, root, drawn, text))
                size += len(text)
        if held:
            yield group()

    return run


class Members:
    """The texts of one group."""

    def __init__(self, row: dict, suffix: str):
        self.nodes, self.roots = row["nodes" + suffix], row["roots" + suffix]
        self.n = np.array(row["counts" + suffix])
        self.sketches = np.frombuffer(row["sketches" + suffix], np.int64).reshape(len(self.n), -1)
        self.texts = np.split(np.frombuffer(row["shingles" + suffix], np.uint64), np.cumsum(self.n)[:-1])

    def labelled(self) -> tuple[np.ndarray, np.ndarray]:
        """All labelled shingles, and which member has them."""
        with np.errstate(over="ignore"):
            sets = [_mixed(t + occurrence_labels(t) * np.uint64(0x9E3779B97F4A7C15)) for t in self.texts]
        return np.concatenate(sets), np.repeat(np.arange(len(self.n)), self.n)


def shared_shingles(a: Members, b: Members, columns: int = 8192) -> np.ndarray:
    """How many labelled shingles any two members have in common, by matrix products over the shingles of both groups."""
    (left, row_a), (right, row_b) = a.labelled(), b.labelled()
    common = np.intersect1d(left, right)
    out = np.zeros((len(a.n), len(b.n)), np.float32)
    at_a, at_b = (np.searchsorted(common, v) for v in (left, right))
    in_a, in_b = (np.append(common, np.uint64(0))[at] == v for at, v in ((at_a, left), (at_b, right)))
    in_a, in_b = in_a & (at_a < len(common)), in_b & (at_b < len(common))
    at_a, row_a, at_b, row_b = at_a[in_a], row_a[in_a], at_b[in_b], row_b[in_b]
    order_a, order_b = np.argsort(at_a, kind="stable"), np.argsort(at_b, kind="stable")
    at_a, row_a, at_b, row_b = at_a[order_a], row_a[order_a], at_b[order_b], row_b[order_b]
    for first in range(0, len(common), columns):
        dense = []
        for at, row, n in ((at_a, row_a, len(a.n)), (at_b, row_b, len(b.n))):
            low, high = np.searchsorted(at, [first, first + columns])
            part = np.zeros((n, min(columns, len(common) - first)), np.float32)
            part[row[low:high], at[low:high] - first] = 1
            dense.append(part)
        out += dense[0] @ dense[1].T
    return out


def tile_links(a: Members, b: Members, same: bool, band: int, least: float) -> list[tuple[bytes, bytes]]:
    """Near copies in different classes of two groups (or, ``same``, of one), as few as join the classes they join."""
    names = {root: i for i, root in enumerate({*a.roots, *b.roots})}
    root_a, root_b = (np.array([names[r] for r in m.roots]) for m in (a, b))
    open_pairs = root_a[:, None] != root_b
    if same:
        open_pairs &= np.arange(len(a.n))[:, None] < np.arange(len(b.n))
    open_pairs &= np.minimum(a.n[:, None], b.n) >= least * np.maximum(a.n[:, None], b.n)
    for earlier in range(band):
        open_pairs &= a.sketches[:, earlier, None] != b.sketches[:, earlier]
    if not open_pairs.any():
        return []
    total = a.n[:, None] + b.n
    shared = shared_shingles(a, b)
    i, j = np.nonzero(open_pairs & (shared >= least / (1 + least) * total - 1e-3))
    class_of = list(range(len(names)))

    def find(x: int) -> int:
        while class_of[x] != x:
            class_of[x] = x = class_of[class_of[x]]
        return x

    links = []
    for k in np.argsort(-shared[i, j] / total[i, j], kind="stable"):
        x, y = find(root_a[i[k]]), find(root_b[j[k]])
        if x != y and similarity(a.texts[i[k]], b.texts[j[k]], least) >= least:
            class_of[x] = y
            links.append((a.nodes[i[k]], b.nodes[j[k]]))
    return links


def _tiles(least: float, same: bool):
    def run(batches):
        for batch in batches:
            links = []
            for row in batch.to_pylist():
                a = Members(row, "" if same else "_a")
                links += tile_links(a, a if same else Members(row, "_b"), same, row["band"], least)
            yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in links], pa.binary()), "b": pa.array([y for _, y in links], pa.binary())})

    return run


def _aligned(least: float):
    def run(batches):
        for batch in batches:
            yes, last, left = [], None, None
            for a, b in zip(batch.column("text_a").cast(pa.binary()), batch.column("text_b").cast(pa.binary())):
                a, b = a.as_py(), b.as_py()
                if a != last:
                    last, left = a, shingle_hashes(words_of(a))
                yes.append(similarity(left, shingle_hashes(words_of(b)), least) >= least)
            yield batch.select(["a", "b"]).filter(pa.array(yes, pa.bool_()))

    return run


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest node reachable from each node that has an edge: columns node, root.

    Alternates between linking larger neighbours and smaller neighbours of every node to
    its smallest one, until nothing changes.
    """
    edges = edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).where("u <> v").distinct()
    edges, seen = materialise(edges, "links"), None
    while True:
        both = edges.union(edges.select("u", "v").toDF("v", "u"))
        least = both.groupBy("v").agg(F.min("u").alias("m")).withColumn("m", F.least("m", "v"))
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).union(
            least.select("v", F.col("m").alias("u"))).where("u <> v").distinct()
        edges = materialise(small, "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
                edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
        seen = state


def _alike() -> Column:
    """Whether the lengths and the screens of two rows, _a and _b, allow near copies."""

    def shared(first: int, count: int) -> Column:
        same = F.zip_with(F.slice("lanes_a", first, count), F.slice("lanes_b", first, count), lambda x, y: (x == y).cast("int"))
        return F.aggregate(same, F.lit(0), lambda total, one: total + one)

    return F.when(F.least("n_a", "n_b") < SHORT, shared(BINS * SKETCHES + 1, SKETCHES) >= LEAST_SHARED_SHORT).otherwise(
        shared(1, BINS * SKETCHES) >= LEAST_SHARED)


def _with_roots(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    return buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _links_of_open_buckets(rooted: DataFrame, profiles: DataFrame, texts: DataFrame, least: float, group_members: int) -> DataFrame:
    """Links between the classes that meet in buckets. Columns of ``rooted``: band, key, members, node, root."""
    nodes = rooted.select("node").distinct()
    sequences = texts.join(nodes, "node").mapInArrow(_sequences, "node binary, shingles binary").join(profiles, "node")
    # Classes stay together where a large bucket is dealt to several tasks.
    deal = F.pmod(F.xxhash64("root"), F.ceil(F.col("members") / MEMBERS_PER_TASK))
    full = rooted.join(materialise(sequences, "open-texts"), "node").withColumn("deal", deal)
    full = full.repartition("band", "key", "deal").sortWithinPartitions("band", "key", "root", "node")
    full = full.select("band", "key", "node", "root", "sketches", "shingles")
    groups = materialise(full.mapInArrow(_groups(group_members, GROUP_SHINGLES), GROUP), "bucket-groups")
    links = "a binary, b binary"
    inside = groups.where("one_root is null").mapInArrow(_tiles(least, True), links)
    # Which groups meet is found without their texts, so no key of the joins that bring these is hot.
    listed = groups.select("band", "key", "group", "one_root")
    met = listed.toDF("band", "key", "group_a", "root_a").join(listed.toDF("band", "key", "group_b", "root_b"), ["band", "key"])
    met = met.where("group_a < group_b and coalesce(root_a <> root_b, true)").select("group_a", "group_b")
    met = materialise(met, "tiles")
    carried = ["nodes", "roots", "sketches", "counts", "shingles"]
    left = groups.select("band", F.col("group").alias("group_a"), *[F.col(c).alias(c + "_a") for c in carried])
    right = groups.select(F.col("group").alias("group_b"), *[F.col(c).alias(c + "_b") for c in carried])
    across = met.join(left, "group_a").join(right, "group_b").drop("group_a", "group_b").mapInArrow(_tiles(least, False), links)
    return materialise(inside.unionByName(across), "bucket-links")


def near_copies(docs: DataFrame, least: float = SIMILARITY, group_members: int = GROUP_MEMBERS) -> DataFrame:
    """One row per input row: doc_id, text_key, class_id (smallest doc_id of its class), kept.

    ``kept`` marks the row that stays for its class; rows alike in doc_id and text share it.
    """
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    drawn = materialise(keyed.mapInArrow(
        _sketch, "doc_id bigint, text_key bigint, node binary, n bigint, sketches array<bigint>, lanes array<tinyint>"), "sketches")
    nodes = drawn.where("node is not null").groupBy("node").agg(
        F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text_key")).alias("first"), F.first("n").alias("n"), F.first("sketches").alias("sketches"), F.first("lanes").alias("lanes"))
    entries = nodes.select("node", "n", F.posexplode("sketches").alias("band", "key"))
    shared = entries.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("centre")).where("size > 1")
    buckets = materialise(entries.join(shared, ["band", "key"]).select("band", "key", "node", "n", "centre"), "buckets")
    profiles = materialise(nodes.join(buckets.select("node").distinct(), "node").select("node", "n", "lanes", "sketches"), "profiles")

    wanted = buckets.select("node").distinct()
    places = nodes.select("node", "first.doc_id", "first.text_key").join(wanted, "node").withColumnRenamed("doc_id", "first_id")
    found = keyed.withColumn("text", F.coalesce("text", F.lit("")))
    texts = materialise(
        found.join(places, (found["doc_id"].eqNullSafe(places["first_id"])) & (found["text_key"] == places["text_key"]))
        .select("node", "text").dropDuplicates(["node"]), "bucket-texts")

    def aligned(pairs: DataFrame) -> DataFrame:
        left, right = texts.toDF("a", "text_a"), texts.toDF("b", "text_b")
        both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
        return both.mapInArrow(_aligned(least), "a binary, b binary")

    lengths = f"least(n_a, n_b) >= {least} * greatest(n_a, n_b)"
    pairs = buckets.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    pairs = pairs.join(profiles.drop("sketches").toDF("a", "n_a", "lanes_a"), "a").join(
        profiles.drop("sketches").toDF("b", "n_b", "lanes_b"), "b")
    pairs = materialise(pairs.where(lengths).where(_alike()).select("a", "b"), "pairs")
    links = materialise(aligned(pairs), "near-links")
    roots = materialise(components(links), "near-roots")
    # A bucket is settled when its members lie in one class.
    rooted = _with_roots(buckets.select("band", "key", "node"), roots)
    mixed = rooted.groupBy("band", "key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("members"))
    mixed = mixed.where("lo <> hi").select("band", "key", "members")
    rooted = materialise(rooted.join(mixed, ["band", "key"]), "open-buckets")
    if not rooted.isEmpty():
        links = links.unionByName(_links_of_open_buckets(rooted, profiles.select("node", "sketches"), texts, least, group_members))
        roots = materialise(components(links), "near-roots")

    classed = _with_roots(nodes.select("node", "first"), roots)
    classes = classed.groupBy("root").agg(F.min("first").alias("stays"))
    named = classed.join(classes, "root").select("node", "stays")
    same = F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("text_key") == F.col("stays.text_key"))
    with_words = drawn.where("node is not null").join(named, "node").select(
        "doc_id", "text_key", F.col("stays.doc_id").alias("class_id"), same.alias("kept"))
    without = drawn.where("node is null").select("doc_id", "text_key", F.col("doc_id").alias("class_id"), F.lit(True).alias("kept"))
    return with_words.unionByName(without)


def drop_near_copies(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One document of each class, with all its columns."""
    rows = near_copies(docs, least).where("kept").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("copies"))
    rows = materialise(rows, "near-kept")
    stays = rows.select("doc_id", "text_key").toDF("__kept_id", "__kept_key")
    keyed = docs.withColumn("__text_key", F.xxhash64("text"))
    same = keyed["doc_id"].eqNullSafe(stays["__kept_id"]) & (keyed["__text_key"] == stays["__kept_key"])
    left = keyed.join(stays, same, "left_semi")
    if not rows.where("copies > 1").isEmpty():
        # Rows alike in id and text cannot be told apart by the join: one of them stays.
        left = left.dropDuplicates(["doc_id", "__text_key"])
    return left.drop("__text_key")
