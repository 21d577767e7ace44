"""Removal of repeated byte strings by interval expansion on a Burrows-Wheeler transform.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else is
removed. Texts are cut into segments at anchors: the anchor of a string is the 32-byte
window in it with the smallest hash (the leftmost of equals), and a segment joins the
neighbouring strings that share their anchor. Equal strings have equal anchors, so strings
are compared only among the segments of one anchor hash, and anchors that occur once are
out at once. Equal segments are counted before any of their bytes move.

The segments of anchors with several contents are compared in tasks of bounded size:
their Burrows-Wheeler transform is built, and intervals of rows are extended backwards,
breadth first, which gives the common prefixes of neighbouring rows by increasing value;
expansion stops at ``LENGTH``, and rows still joined then are repeated strings. Anchors
with more than ``MOST_SEGMENTS`` different segments are not held in one task: their
strings are counted one by one with grouped sums.

Defined cases: a null text is empty; texts shorter than ``LENGTH`` keep all bytes; repeated
rows repeat each other; documents with one doc_id and different texts are kept apart; an
empty table gives no row; other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.llm.order_minhash import BYTE_VALUES
from tierstone.session import materialise

LENGTH = 200
ANCHOR = 32
CHUNK_BYTES = 1 << 21
MOST_SEGMENTS = 20_000
# Strings of a document looked at together; places inside fit the low bits of a key.
PART, PLACE_BITS = 1 << 19, 20
ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
# Symbols that fit one packed key: bytes are shifted by one, 0 separates segments.
PACKED, SYMBOL_BITS = 7, 9

DOC = ["doc_id", "text_key"]


def _window_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each place on, by doubling."""
    values, size = BYTE_VALUES[data], 1
    with np.errstate(over="ignore"):
        while size < ANCHOR:
            values, right = values[:-size] * ODD[0], values[size:] * ODD[1]
            values += right
            np.right_shift(values, np.uint64(29), out=right)
            values ^= right
            size *= 2
    return values


def segments(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first start, and end of the starts of each segment of a text."""
    found = []
    for first in range(0, len(text) - length + 1, PART):
        data = np.frombuffer(text, np.uint8, min(PART - 1 + length, len(text) - first), first)
        hashes = _window_hashes(data)
        width = length - ANCHOR + 1
        places = np.arange(len(hashes), dtype=np.uint64)
        keys = (hashes >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | places
        n = len(keys) - width + 1
        padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
        padded[: len(keys)] = keys
        rows = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])
        anchor = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        found.append((hashes[anchor[starts]].view(np.int64), first + starts, first + np.r_[starts[1:], n]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(part) for part in zip(*found))


def sorted_rows(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rotations sorted by their first symbols (``depth`` at least), and packed keys by place."""
    n = len(symbols)
    packed = np.zeros(n, np.int64)
    for k in range(PACKED):
        packed = (packed << SYMBOL_BITS) | np.roll(symbols, -k).astype(np.int64)
    keys, known = packed, PACKED
    while True:
        order = np.argsort(keys)
        ordered = keys[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
        if known >= depth or rank[order[-1]] == n - 1:
            return order, packed
        keys = rank * n + np.roll(rank, -known)
        known *= 2


def repeated_places(symbols: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Places whose first ``depth`` symbols also start at another place (around the end)."""
    n = len(symbols)
    rows, packed = sorted_rows(symbols, depth)
    row_of = np.empty(n, np.int64)
    row_of[rows] = np.arange(n)
    before = rows - 1  # place n - 1 stands before place 0
    last_to_first, last = row_of[before], symbols[before].astype(np.int64)
    # Common prefixes shorter than a packed key are read from the keys.
    common = np.full(n + 1, -1, np.int64)
    common[0] = common[n] = 0
    ordered = packed[rows]
    for level in range(PACKED - 1, -1, -1):
        shift = SYMBOL_BITS * (PACKED - 1 - level)
        common[1:n][ordered[1:] >> shift != ordered[:-1] >> shift] = level
    ends = np.flatnonzero(common == PACKED - 1)
    cuts = np.flatnonzero(common >= 0)
    low, high = cuts[np.searchsorted(cuts, ends) - 1], ends
    if depth < PACKED:
        common[common >= depth] = -1
        low = high = low[:0]
    for level in range(PACKED, depth):
        if not len(low):
            break
        sizes = high - low
        owner = np.repeat(np.arange(len(low)), sizes)
        inside = np.arange(len(owner)) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)
        key = owner * 512 + last[inside]
        order = np.argsort(key, kind="stable")
        target = last_to_first[inside][order]
        key = key[order]
        groups = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        low, high = np.minimum.reduceat(target, groups), np.maximum.reduceat(target, groups) + 1
        new = common[high] < 0
        low, high = low[new], high[new]
        common[high] = level
    joined = common[:n] < 0
    twice = joined | (common[1:] < 0)
    return rows[twice]


def covered_runs(repeated: np.ndarray, n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """Runs of places covered by strings that start at the repeated places."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, repeated, 1)
    np.add.at(change, repeated + length, -1)
    inside = np.r_[0, (np.cumsum(change[:-1]) > 0).astype(np.int8), 0]
    edges = np.flatnonzero(np.diff(inside))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def compare_segments(parts: list[bytes], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each of different segments, the runs covered by strings that any of them repeats."""
    joined = np.zeros(sum(map(len, parts)) + len(parts), np.uint16)
    starts, at = [], 0
    for part in parts:
        joined[at : at + len(part)] = np.frombuffer(part, np.uint8)
        joined[at : at + len(part)] += 1
        starts.append(at)
        at += len(part) + 1
    places = np.sort(repeated_places(joined, length))
    # Strings that reach over a separator are none.
    owner = np.searchsorted(starts, places, side="right") - 1
    ends = np.array(starts)[owner] + np.array([len(p) for p in parts])[owner] if len(places) else places
    keep = places + length <= ends
    places, owner = places[keep], owner[keep]
    bounds = np.searchsorted(owner, np.arange(len(parts) + 1))
    return [
        covered_runs(places[bounds[k] : bounds[k + 1]] - starts[k], len(part), length) if bounds[k] < bounds[k + 1] else []
        for k, part in enumerate(parts)
    ]


def _anchors(length: int, with_places: bool):
    def run(batches):
        for batch in batches:
            columns: list[list[np.ndarray]] = [[] for _ in range(5)]
            for at, text in enumerate(batch.column("text").cast(pa.binary())):
                text = text.as_py() or b""
                hashes, starts, stops = segments(text, length)
                columns[0].append(hashes)
                if with_places:
                    sizes = stops - starts - 1 + length
                    view = memoryview(text)
                    prints = [xxhash.xxh3_64_intdigest(view[s : s + n]) for s, n in zip(starts.tolist(), sizes.tolist())]
                    for column, values in zip(columns[1:], (np.array(prints, np.uint64).view(np.int64), starts, sizes, np.full(len(starts), at))):
                        column.append(values)
            if not columns[0]:
                continue
            out = {"anchor": pa.array(np.concatenate(columns[0]), pa.int64())}
            if with_places:
                prints, starts, sizes, rows = (np.concatenate(c) for c in columns[1:])
                out |= {"print": pa.array(prints, pa.int64()), "start": pa.array(starts, pa.int32()), "size": pa.array(sizes, pa.int32())}
                out |= {name: batch.column(name).take(pa.array(rows, pa.int64())) for name in DOC}
            yield pa.RecordBatch.from_pydict(out)

    return run


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted segments of each text."""
    for batch in batches:
        rows = []
        for text, wanted in zip(batch.column("text").cast(pa.binary()), batch.column("wanted").to_pylist()):
            text = text.as_py() or b""
            rows += [(w["anchor"], w["print"], text[w["start"] : w["start"] + w["size"]]) for w in wanted]
        anchor, prints, body = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_pydict({
            "anchor": pa.array(anchor, pa.int64()), "print": pa.array(prints, pa.int64()), "body": pa.array(body, pa.binary())})


RUNS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def _as_runs(values) -> pa.Array:
    return pa.array([[{"start": a, "stop": b} for a, b in runs] for runs in values], RUNS)


def _compare(length: int, chunk_bytes: int):
    """Over rows sorted by anchor: chunks of whole anchors, each compared by itself."""

    def compared(rows):
        anchor, prints, bodies = zip(*rows)
        return pa.RecordBatch.from_pydict({
            "anchor": pa.array(anchor, pa.int64()), "print": pa.array(prints, pa.int64()),
            "runs": _as_runs(compare_segments(list(bodies), length))})

    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "print", "body"))):
                if held >= chunk_bytes and row[0] != rows[-1][0]:
                    yield compared(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row[2]) + 1
        if rows:
            yield compared(rows)

    return run


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, runs in zip(batch.column("text").cast(pa.binary()), batch.column("runs").to_pylist()):
            text, merged = text.as_py() or b"", []
            for start, stop in sorted((r["start"], r["stop"]) for r in runs or ()):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], stop)
                else:
                    merged.append([start, stop])
            ends = [0, *(x for run in merged for x in run), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2]))
            out.append((len(text), len(text) - len(kept), merged, kept))
        sizes, gone, runs, kept = zip(*out) if out else ((), (), (), ())
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n_bytes": pa.array(sizes, pa.int64()), "n_removed": pa.array(gone, pa.int64()),
            "runs": _as_runs(runs), "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            "kept": pa.array(kept, pa.binary())})


def _strings_counted(bodies: DataFrame, length: int) -> DataFrame:
    """Runs of repeated strings for anchors of very many segments, by grouped counts."""
    strings = bodies.select(
        "anchor", "print", F.posexplode(F.transform(
            F.sequence(F.lit(1), F.octet_length("body") - (length - 1)), lambda i: F.substring(F.col("body"), i, F.lit(length)),
        )).alias("start", "string"))
    strings = strings.select("anchor", "print", "start", F.xxhash64("string").alias("k1"), F.xxhash64(F.lit(1), "string").alias("k2"))
    twice = strings.groupBy("anchor", "k1", "k2").agg(F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
    run = F.struct(F.col("start").cast("int").alias("start"), (F.col("start") + length).cast("int").alias("stop"))
    return strings.join(twice, ["anchor", "k1", "k2"], "left_semi").groupBy("anchor", "print").agg(F.collect_list(run).alias("runs"))


def repeated_runs(
    docs: DataFrame, length: int = LENGTH, chunk_bytes: int = CHUNK_BYTES, most_segments: int = MOST_SEGMENTS,
) -> DataFrame:
    """doc_id, text_key and the runs of bytes that repeated strings cover, where there are any.

    Runs of neighbouring segments overlap; ``remove_repeats`` merges them.
    """
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    again = keyed.mapInArrow(_anchors(length, False), "anchor bigint").groupBy("anchor").agg(F.count(F.lit(1)).alias("times"))
    again = again.where("times > 1").select("anchor")
    places = keyed.mapInArrow(
        _anchors(length, True), "anchor bigint, print bigint, start int, size int, doc_id bigint, text_key bigint")
    places = materialise(places.join(again, "anchor"), "segments")
    contents = materialise(places.groupBy("anchor", "print").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct(*DOC, "start", "size")).alias("place")), "contents")
    several = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")

    wanted = contents.join(several, "anchor").select("place.*", "anchor", "print", "kinds")
    wanted = wanted.groupBy(*DOC).agg(F.collect_list(F.struct("anchor", "print", "start", "size")).alias("wanted"))
    wanted = wanted.toDF("place_id", "place_key", "wanted")
    here = keyed["doc_id"].eqNullSafe(wanted["place_id"]) & keyed["text_key"].eqNullSafe(wanted["place_key"])
    bodies = keyed.join(wanted, here).select("text", "wanted").mapInArrow(_cut_out, "anchor bigint, print bigint, body binary")
    # Rows alike in id and text give the same segment twice; it is one content.
    bodies = materialise(bodies.dropDuplicates(["anchor", "print"]), "segment-bodies")
    crowded = several.where(F.col("kinds") > most_segments).select("anchor")
    runs_type = "anchor bigint, print bigint, runs array<struct<start:int,stop:int>>"
    found = bodies.join(crowded, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        _compare(length, chunk_bytes), runs_type).where("size(runs) > 0")
    if not crowded.isEmpty():
        found = found.unionByName(_strings_counted(bodies.join(crowded, "anchor", "left_semi"), length))
    # A content that occurs more than once is covered as a whole.
    whole = contents.where("times > 1").select(
        "anchor", "print", F.array(F.struct(F.lit(0).alias("start"), F.col("place.size").alias("stop"))).alias("runs"))
    runs = materialise(found.unionByName(whole), "segment-runs")
    shifted = F.transform("runs", lambda r: F.struct((r["start"] + F.col("start")).alias("start"), (r["stop"] + F.col("start")).alias("stop")))
    covered = places.join(runs, ["anchor", "print"]).select(*DOC, shifted.alias("runs"))
    return covered.groupBy(*DOC).agg(F.flatten(F.collect_list("runs")).alias("runs"))


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, removed runs, kept bytes and their SHA-256."""
    runs = repeated_runs(docs, **options).toDF("run_id", "run_key", "runs")
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    here = keyed["doc_id"].eqNullSafe(runs["run_id"]) & keyed["text_key"].eqNullSafe(runs["run_key"])
    return keyed.join(runs, here, "left").select("doc_id", "text", "runs").mapInArrow(
        _removed, "doc_id bigint, n_bytes bigint, n_removed bigint, runs array<struct<start:int,stop:int>>, kept_sha256 string, kept binary")
