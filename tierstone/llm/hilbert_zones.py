"""Hard negatives by zone maps over Hilbert-ordered blocks.

Vectors are put in the order of a Hilbert curve through their space and cut into blocks, a
row of a Parquet table each: its vectors, and its zone map, the smallest and largest value
in every dimension. Interval arithmetic bounds the inner product of an anchor with anything
in a block: the largest sums max(a*lo, a*hi) over the dimensions, the smallest the minima.
A search asks, for each of its queries, for the best vectors of the same (or of another)
label whose score lies in a window. A block is read for a query only if its bounds and labels
allow an answer there. A first search of the few most promising blocks gives each
query a score that its answers must reach; the second, with windows narrowed to that, reads
every block that can still matter, so answers are exact.

Queries are dealt in chunks of at most ``CHUNK`` along the same curve, zone maps in shelves
of ``SHELF`` blocks. Chunks meet shelves, which have no vectors, to choose (chunk, block)
pairs. Then tiles are formed: about ``OPEN_CHUNKS`` chunks, and those of ``TILE`` blocks in a
row that any of them has to read. A tile is one group of rows, so that neither its memory nor
any broadcast grows with the number of pairs, which where vectors have no clusters is the
number of chunks times that of blocks. Nothing is collected but one pair of numbers for each dimension.

Defined cases: rows with a null id, label, vector or component, or a component that is not
finite, take no part; an id names one row: of several with one id, the one with the
smallest label and then vector counts; missing components of shorter vectors are 0;
components saturate where 64-bit scores could overflow (for 64 dimensions beyond 3.8e8);
scores that tie go by id; an empty table gives no row; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstone.session import materialise

SCALE = 256
# Bits of each dimension that the place on the curve uses.
CURVE_BITS = 4
BLOCK, SHELF, CHUNK = 256, 512, 2048
# Blocks in a row that a tile may hold.
TILE = 128
# Blocks that each query tries first, on each shelf.
PROBES = 2
OPEN_CHUNKS = 32
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1

BLOCKS = "shelf bigint, block bigint, ids binary, labels binary, vectors binary, low binary, high binary, least_label int, most_label int"
CHUNKS = "chunk bigint, anchors binary, positives binary, labels binary, lows binary, highs binary, vectors binary"
PAIRS = "block bigint, chunk bigint, members binary"
BLOCK_FIELDS = pa.schema([
    ("shelf", pa.int64()), ("block", pa.int64()), *[(c, pa.binary()) for c in ("ids", "labels", "vectors", "low", "high")],
    ("least_label", pa.int32()), ("most_label", pa.int32()),
])
PAIR_FIELDS = pa.schema([("block", pa.int64()), ("chunk", pa.int64()), ("members", pa.binary())])
ANSWERS = "anchor_id bigint, positive_id bigint, id bigint, score bigint"
ANSWER_FIELDS = pa.schema([(c, pa.int64()) for c in ("anchor_id", "positive_id", "id", "score")])


def curve_keys(cells: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """Places on the Hilbert curve of rows of cell numbers below 2**bits, as rows of bytes that sort alike.

    Per bit, from the highest: where a dimension has it, the lower bits of the first are
    inverted, elsewhere exchanged with the first's; then the bits are Gray decoded.
    """
    x = cells.astype(np.uint32).T.copy()
    n = len(x)
    top = np.uint32(1 << (bits - 1))
    q = top
    while q > 1:
        low = np.uint32(q - 1)
        for i in range(n):
            has = (x[i] & q) != 0
            swap = np.where(has, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(has, low, swap)
            x[i] ^= swap
        q >>= np.uint32(1)
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = top
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, np.uint32(q - 1), np.uint32(0))
        q >>= np.uint32(1)
    x ^= t
    planes = [(x >> np.uint32(b) & np.uint32(1)).T for b in reversed(range(bits))]
    return np.packbits(np.concatenate(planes, axis=1).astype(np.uint8), axis=1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of int64 rows: in floating point where its whole numbers suffice."""
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest possible inner product of each row of ``a`` with a vector in each zone."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return products(up, low) + products(down, high), products(up, high) + products(down, low)


def _ints(data: bytes, kind=np.int64) -> np.ndarray:
    return np.frombuffer(data, kind)


def _matrix(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, np.int32).astype(np.int64).reshape(rows, -1)


def prepared(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, v of the rows that take part, one for each id, components scaled and floored."""
    limit = float(1 << 31)
    whole = F.transform("embedding", lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(limit)), F.lit(-limit))))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where("vec_id is not null and label is not null and embedding is not null").where(finite)
    one = F.min(F.struct(F.col("label"), whole.alias("v"))).alias("row")
    return rows.groupBy("vec_id").agg(one).select("vec_id", "row.label", "row.v")


def _extent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Smallest and largest value of each dimension in a task."""
    low, high = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        v = _dense(batch.column("v"), 0)
        n = max(len(low), v.shape[1])
        low, high, v = (np.pad(x, [(0, 0)] * (x.ndim - 1) + [(0, n - x.shape[-1])]) for x in (low, high, v))
        low, high = np.minimum(low, v.min(axis=0, initial=0)), np.maximum(high, v.max(axis=0, initial=0))
    yield pa.RecordBatch.from_pydict({"dim": pa.array(range(len(low)), pa.int32()), "low": low, "high": high})


def _dense(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as a matrix, shorter ones filled with 0."""
    lengths = column.value_lengths().to_numpy()
    width = max(width, int(lengths.max(initial=0)))
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def _placed(low: np.ndarray, high: np.ndarray):
    """Adds the place on the curve, and packs the vector."""
    most = min(isqrt(HIGHEST // max(1, len(low))), (1 << 31) - 1)
    low, high = np.clip(low, -most, most), np.clip(high, -most, most)
    size = (high - low + 1) / (1 << CURVE_BITS)

    def run(batches):
        for batch in batches:
            v = np.clip(_dense(batch.column("v"), len(low)), -most, most)
            cells = np.clip((v - low) // size, 0, (1 << CURVE_BITS) - 1).astype(np.uint32)
            keys = curve_keys(cells) if len(low) and len(v) else np.zeros((len(v), 1), np.uint8)
            packed = v.astype(np.int32)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id"), "label": batch.column("label"),
                "place": pa.array([k.tobytes() for k in keys], pa.binary()), "vector": pa.array([p.tobytes() for p in packed], pa.binary())})

    return run


def _numbers() -> Iterator[int]:
    """Numbers no other task has."""
    first = TaskContext.get().partitionId() << 32
    while True:
        yield first
        first += 1


def _blocks(block: int, shelf: int):
    def run(batches):
        for batch, number in _cut(batches, block):
            labels = batch.column("label").to_numpy()
            vectors = b"".join(batch.column("vector").to_pylist())
            v = np.frombuffer(vectors, np.int32).reshape(len(labels), -1)
            yield pa.RecordBatch.from_pylist([{
                "shelf": number // shelf, "block": number, "ids": batch.column("vec_id").to_numpy().tobytes(),
                "labels": labels.astype(np.int32).tobytes(), "vectors": vectors, "low": v.min(axis=0).tobytes(),
                "high": v.max(axis=0).tobytes(), "least_label": int(labels.min()), "most_label": int(labels.max())}], BLOCK_FIELDS)

    return run


def _cut(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, int]]:
    """Numbered pieces of ``size`` rows; only a task's last is shorter."""
    held, numbers = [], _numbers()
    for batch in batches:
        while batch.num_rows:
            need = size - sum(b.num_rows for b in held)
            held.append(batch.slice(0, need))
            batch = batch.slice(need)
            if sum(b.num_rows for b in held) == size:
                yield pa.concat_batches(held), next(numbers)
                held = []
    if held:
        yield pa.concat_batches(held), next(numbers)


def _chunks(size: int):
    def run(batches):
        for batch, number in _cut(batches, size):
            ints = lambda c, kind=np.int64: batch.column(c).to_numpy().astype(kind).tobytes()
            vectors = batch.column("vector").filter(pa.array(_first(batch.column("anchor_id").to_numpy())))
            yield pa.RecordBatch.from_pylist([{
                "chunk": number, "anchors": ints("anchor_id"), "positives": ints("positive_id"), "labels": ints("label", np.int32),
                "lows": ints("low"), "highs": ints("high"), "vectors": b"".join(vectors.to_pylist())}])

    return run


def _first(anchors: np.ndarray) -> np.ndarray:
    """Whether a query is the first of its anchor; queries of one anchor are neighbours."""
    return np.r_[True, anchors[1:] != anchors[:-1]]


def _anchors_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Different vectors of a chunk's queries, and which of them each query has."""
    first = _first(_ints(row["anchors"]))
    return _matrix(row["vectors"], int(first.sum())), np.cumsum(first) - 1


def _able(row: dict, zones: list[dict], same: bool, probes: int) -> np.ndarray:
    """Which queries of a chunk (rows) have to read which blocks; with ``probes`` only the most promising ones."""
    low, high = (np.stack([_ints(z[c], np.int32) for z in zones]).astype(np.int64) for c in ("low", "high"))
    least, most = (np.array([z[c] for z in zones]) for c in ("least_label", "most_label"))
    v, of = _anchors_of(row)
    labels = _ints(row["labels"], np.int32)[:, None]
    smallest, largest = (b[of] for b in bounds(v, low, high))
    able = (least <= labels) & (labels <= most) if same else (least < labels) | (labels < most)
    able &= (largest >= _ints(row["lows"])[:, None]) & (smallest <= _ints(row["highs"])[:, None])
    if probes and probes < len(zones):
        reach = np.where(able, largest, LOWEST)
        kth = np.partition(reach, len(zones) - probes, axis=1)[:, len(zones) - probes]
        able &= reach >= kth[:, None]
    return able


def _chosen(same: bool, probes: int):
    """(chunk, block) pairs, with the queries of the chunk that have to read the block."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                zones = row["zones"] or []
                able = _able(row, zones, same, probes) if zones else np.zeros((0, 0), bool)
                pairs = [
                    {"block": z["block"], "chunk": row["chunk"], "members": np.flatnonzero(able[:, i]).astype(np.int32).tobytes()}
                    for i, z in enumerate(zones) if able[:, i].any()
                ]
                if pairs:
                    yield pa.RecordBatch.from_pylist(pairs, PAIR_FIELDS)

    return run


class Best:
    """The best answers so far of a chunk's queries."""

    def __init__(self, row: dict, k: int):
        self.k, self.anchors, self.positives = k, _ints(row["anchors"]), _ints(row["positives"])
        self.v, self.of = _anchors_of(row)
        self.labels, self.lows, self.highs = _ints(row["labels"], np.int32), _ints(row["lows"]).copy(), _ints(row["highs"])
        self.query, self.id, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def read(self, members: np.ndarray, block: dict, same: bool) -> None:
        """Answers of a block to the queries with these numbers."""
        ids, labels = _ints(block["ids"]), _ints(block["labels"], np.int32)
        wanted, place = np.unique(self.of[members], return_inverse=True)
        scores = products(self.v[wanted], _matrix(block["vectors"], len(ids)))[place]
        fits = (scores >= self.lows[members, None]) & (scores <= self.highs[members, None])
        fits &= (labels == self.labels[members, None]) == same
        fits &= ids != self.anchors[members, None]
        query, column = np.nonzero(fits)
        self.waiting.append((members[query], ids[column], scores[query, column]))
        if sum(len(w[0]) for w in self.waiting) > 1 << 18:
            self.settle()

    def settle(self) -> None:
        """Keeps the k best of each query, and raises its window to the last of them."""
        query, ids, scores = (np.concatenate([a, *b]) for a, b in zip((self.query, self.id, self.score), zip(*self.waiting)))
        order = np.lexsort((ids, ~scores, query))
        query, ids, scores = query[order], ids[order], scores[order]
        first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, np.int64)
        rank = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
        kept = rank < self.k
        self.query, self.id, self.score, rank = query[kept], ids[kept], scores[kept], rank[kept]
        full = rank == self.k - 1
        self.lows[self.query[full]] = np.maximum(self.lows[self.query[full]], self.score[full])
        self.waiting = []

    def rows(self) -> pa.RecordBatch:
        if self.waiting:
            self.settle()
        return pa.RecordBatch.from_pydict({
            "anchor_id": self.anchors[self.query], "positive_id": self.positives[self.query], "id": self.id, "score": self.score})


def _read(same: bool, k: int, probes: int):
    def run(blocks: pa.Table, chunks: pa.Table) -> pa.Table:
        """The best answers of a tile's blocks to its chunks, one chunk after the other."""
        found, zones = [], blocks.to_pylist()
        for batch in chunks.to_batches(max_chunksize=1) if zones else []:
            row = batch.to_pylist()[0]
            able, best = _able(row, zones, same, probes), Best(row, k)
            for i in np.flatnonzero(able.any(axis=0)):
                best.read(np.flatnonzero(able[:, i]), zones[i], same)
            found.append(best.rows())
        return pa.Table.from_batches(found, ANSWER_FIELDS)

    return run


class Index:
    """Blocks along the curve, of all vectors that take part."""

    def __init__(self, rows: DataFrame, block: int = BLOCK, shelf: int = SHELF, chunk: int = CHUNK):
        """``rows`` are as ``prepared`` gives them."""
        self.chunk = chunk
        extent = rows.mapInArrow(_extent, "dim int, low bigint, high bigint").groupBy("dim").agg(F.min("low"), F.max("high"))
        extent = sorted(tuple(r) for r in extent.collect())  # one row for each dimension
        low, high = (np.array([e[i] for e in extent], np.int64) for i in (1, 2))
        placed = rows.mapInArrow(_placed(low, high), "vec_id bigint, label int, place binary, vector binary")
        self.rows = materialise(placed.repartitionByRange("place", "vec_id").sortWithinPartitions("place", "vec_id"), "curve")
        self.blocks = materialise(self.rows.mapInArrow(_blocks(block, shelf), BLOCKS), "vector-blocks")
        zone = F.struct("block", "low", "high", "least_label", "most_label")
        shelves = self.blocks.groupBy("shelf").agg(F.collect_list(zone).alias("zones"))
        # Each chunk meets each shelf: chunks are repeated for the numbers that shelves are dealt to.
        self.deals = max(1, min(self.blocks.select("shelf").distinct().count(), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
        self.shelves = materialise(shelves.withColumn("deal", F.pmod(F.xxhash64("shelf"), F.lit(self.deals))), "zone-shelves")

    def _pass(self, chunks: DataFrame, groups: int, same: bool, k: int, probes: int) -> DataFrame:
        """The best answers of all queries in the blocks chosen for them; ``groups``: chunks are dealt over as many."""
        dealt = chunks.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(self.deals - 1).cast("bigint"))))
        # In an outer join only the shelves may be broadcast: Spark does not count how often a chunk is repeated.
        pairs = dealt.join(self.shelves, "deal", "left").mapInArrow(_chosen(same, probes), PAIRS).select("block", "chunk")
        group, tile = F.pmod(F.xxhash64("chunk"), F.lit(groups)).alias("group"), F.floor(F.col("block") / TILE).alias("tile")
        pairs = materialise(pairs, "chosen-blocks")
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint")))
        blocks = self.blocks.withColumn("group", every).join(pairs.select("block", group).distinct(), ["block", "group"], "left_semi")
        asked = pairs.select("chunk", group, tile).distinct().join(chunks, "chunk", "left")
        side_by_side = blocks.withColumn("tile", tile).groupBy("tile", "group").cogroup(asked.groupBy("tile", "group"))
        found = side_by_side.applyInArrow(_read(same, k, probes), ANSWERS)
        best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    def search(self, queries: DataFrame, same: bool, k: int) -> DataFrame:
        """The k best of each query: anchor_id, positive_id, id, score, rank.

        ``queries`` have anchor_id, positive_id, label, place, vector and the window low to
        high of scores; ``same`` asks for vectors of the query's label, else for all others.
        """
        queries = materialise(queries, "queries")
        query, groups = ["anchor_id", "positive_id"], -(-queries.count() // (self.chunk * OPEN_CHUNKS)) or 1

        def dealt(rows: DataFrame) -> DataFrame:
            ordered = rows.repartitionByRange("place", *query).sortWithinPartitions("place", *query)
            return materialise(ordered.mapInArrow(_chunks(self.chunk), CHUNKS), "query-chunks")

        tried = self._pass(dealt(queries), groups, same, k, PROBES)
        reached = tried.where(F.col("rank") == k).select(*query, F.col("score").alias("reached"))
        narrowed = queries.join(reached, query, "left").withColumn("low", F.greatest("low", "reached")).drop("reached")
        return self._pass(dealt(narrowed), groups, same, k, 0)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, window: tuple[int, int] = (50, 95), scale: int = SCALE,
    block: int = BLOCK, shelf: int = SHELF, chunk: int = CHUNK,
) -> DataFrame:
    """For each anchor and each of its best same-label rows, the best other-label rows in the window.

    ``vectors`` has vec_id, label and embedding. The window is a share, in hundredths from
    and to, of the positive's score. Columns: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.
    """
    index = Index(materialise(prepared(vectors, scale), "vectors"), block, shelf, chunk)
    anchors = index.rows.where(is_anchor).select(F.col("vec_id").alias("anchor_id"), "label", "place", "vector")
    anchors = materialise(anchors, "anchors")
    every = anchors.withColumns({"positive_id": F.col("anchor_id"), "low": F.lit(LOWEST), "high": F.lit(HIGHEST)})
    best = materialise(index.search(every, True, positives).select("anchor_id", F.col("id").alias("positive_id"), "score"), "positives")
    # 64-bit scores times hundredths need more than 64 bits.
    share = lambda part: F.col("score").cast("decimal(20,0)") * part / 100
    inside = {"low": F.ceil(share(window[0])).cast("bigint"), "high": F.floor(share(window[1])).cast("bigint")}
    queries = anchors.join(best, "anchor_id").withColumns(inside).drop("score").where("low <= high")
    found = index.search(queries, False, negatives)
    return found.join(best.withColumnRenamed("score", "positive_score"), ["anchor_id", "positive_id"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
