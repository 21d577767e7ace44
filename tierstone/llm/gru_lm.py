"""Language-model scoring with a gated recurrent network in numpy.

Words are counted over all training documents; ``HEAD`` frequent words get a place of
their own, the others share classes by their last bytes. The network reads a document word
by word, carries its state across windows from the first word to the end token, and
predicts each word in two factors: its class, and the word within the class. A frequent
word is predicted from the state in both factors; inside a class of rare words a word has
its share (count + 1) of the class, where any unseen word has count 0.

Training is by truncated backpropagation: a warm start on a bounded sample
(``WARM_DOCUMENTS``), then every task trains a copy on the training documents it reads, all
of them, and the copies are averaged by the number of their tokens. Scoring reads every
document whole. Counts of up to ``KNOWN_WORDS`` words are broadcast; the others are joined.

Defined cases: a null text is empty and has one token, the end; a null doc_id belongs to
no fold and is not learnt from; repeated rows give repeated rows; without training
documents every count is 0 and the network is untrained; an empty table gives no row;
other columns play no part.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from copy import deepcopy
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.session import materialise

HEAD, CLASSES, RARE_CLASSES = 1024, 32, 16
KNOWN_WORDS = 1 << 18
HIDDEN, STREAMS, WINDOW = 16, 256, 16
WARM_DOCUMENTS, WARM_TOKENS, WARM_PASSES = 1000, 400_000, 2
RATE = 0.1
CHUNK_TOKENS = 1 << 22
FOLDS, HELD_OUT = 7, 2
END = b""  # no word is empty


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lowered, and the end."""
    words = text.lower().split()
    words.append(END)
    return words


def rare_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % RARE_CLASSES


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


class Network:
    """Gated recurrent unit over word ids with a class-factored output.

    Ids below ``head`` are frequent words, ``head + k`` any word of rare class k. Classes
    0 .. CLASSES - 1 hold the frequent words in order, the others are the rare classes.
    """

    NAMES = ("word", "gate", "out_class", "class_bias", "out_word", "word_bias")

    def __init__(self, head: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.head, self.per_class = head, max(1, -(-head // CLASSES))
        draw = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        self.word = draw(head + RARE_CLASSES, 3 * HIDDEN)
        self.word[:, HIDDEN : 2 * HIDDEN] += 1.0  # keep the state at first
        self.gate = draw(HIDDEN, 3 * HIDDEN)
        self.out_class, self.class_bias = draw(HIDDEN, CLASSES + RARE_CLASSES), np.zeros(CLASSES + RARE_CLASSES, np.float32)
        self.out_word, self.word_bias = draw(CLASSES * self.per_class, HIDDEN), np.zeros(CLASSES * self.per_class, np.float32)
        self.word_bias[head:] = -30.0  # places of no word
        self.class_bias[:CLASSES][np.arange(CLASSES) * self.per_class >= head] = -30.0
        self.seen = {name: np.full_like(getattr(self, name), 0.05) for name in self.NAMES}

    def start_from(self, counts: np.ndarray) -> None:
        """Biases at the logarithms of the shares of all ids."""
        counts = counts.astype(np.float64) + 0.5
        padded = np.zeros(CLASSES * self.per_class)
        padded[: self.head] = counts[: self.head]
        inside = padded.reshape(CLASSES, -1)
        self.word_bias[: self.head] = np.log(inside / (inside.sum(1, keepdims=True) + 1e-6) + 1e-12).ravel()[: self.head]
        by_class = np.r_[inside.sum(1) + 1e-6, counts[self.head :]]
        self.class_bias[:] = np.log(by_class / by_class.sum())

    def copy(self) -> Network:
        return deepcopy(self)

    def packed(self) -> bytes:
        return np.concatenate([getattr(self, name).ravel() for name in self.NAMES]).astype(np.float64).tobytes()

    def unpack(self, data: np.ndarray) -> None:
        at = 0
        for name in self.NAMES:
            old = getattr(self, name)
            setattr(self, name, data[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size

    def classes(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids < self.head, ids // self.per_class, ids - self.head + CLASSES)

    def read(self, ids: np.ndarray, fresh: np.ndarray, state: np.ndarray):
        """States before each of the steps, the state after them, and what backpropagation needs."""
        n, shape = HIDDEN, (*ids.shape, HIDDEN)
        inputs, starts = self.word[ids], fresh.any(1)
        before, new, inner = (np.empty(shape, np.float32) for _ in range(3))
        gates = np.empty((*ids.shape, 2 * n), np.float32)
        for t in range(len(ids)):
            h, g, c = before[t], gates[t], new[t]
            h[...] = state
            if starts[t]:
                h[fresh[t]] = 0
            pre = h @ self.gate
            np.add(inputs[t, :, : 2 * n], pre[:, : 2 * n], out=g)
            g *= 0.5  # the logistic function as a hyperbolic tangent
            np.tanh(g, out=g)
            g *= 0.5
            g += 0.5
            inner[t] = pre[:, 2 * n :]
            np.multiply(g[:, :n], inner[t], out=c)
            c += inputs[t, :, 2 * n :]
            np.tanh(c, out=c)
            state = h - c
            state *= g[:, n:]
            state += c
        return before, state, (gates[..., :n], gates[..., n:], new, inner)

    def predict(self, states: np.ndarray, ids: np.ndarray, learn: bool):
        """Log probability of each id after each state; with ``learn`` also the gradients."""
        kinds = self.classes(ids)
        logits = states @ self.out_class
        logits += self.class_bias
        rows = np.arange(len(ids))
        found = logits[rows, kinds]
        share = np.exp(logits, out=logits)
        total = share @ np.ones((share.shape[1], 1), np.float32)
        found -= np.log(total[:, 0])
        grads = {}
        if learn:
            share /= total
            share[rows, kinds] -= 1
            grads["out_class"], grads["class_bias"] = states.T @ share, share.sum(0)
            back = share @ self.out_class.T
            grads["out_word"], grads["word_bias"] = np.zeros_like(self.out_word), np.zeros_like(self.word_bias)
        # All steps by class, so that those of a class are one block; put back at the end.
        order = np.argsort(kinds.astype(np.int16), kind="stable")  # 16 bits are sorted by radix
        states, ids, inside = states[order], ids[order], np.zeros_like(found)
        into = np.zeros_like(states) if learn else None
        bounds = np.searchsorted(kinds[order], np.arange(CLASSES + 1)).tolist()
        ones = np.ones((self.per_class, 1), np.float32)
        for c in range(CLASSES):
            part = slice(bounds[c], bounds[c + 1])
            if part.start == part.stop:
                continue
            span = slice(c * self.per_class, (c + 1) * self.per_class)
            weights, mine = self.out_word[span], states[part]
            logits = mine @ weights.T
            logits += self.word_bias[span]
            at = rows[: len(mine)], ids[part] - span.start
            own = logits[at]
            share = np.exp(logits, out=logits)
            total = share @ ones
            own -= np.log(total[:, 0])
            inside[part] = own
            if learn:
                share /= total
                share[at] -= 1
                grads["out_word"][span], grads["word_bias"][span] = share.T @ mine, share.sum(0)
                np.matmul(share, weights, out=into[part])
        found[order] += inside
        if not learn:
            return found
        back[order] += into
        return found, grads, back

    def learn(self, ids: np.ndarray, fresh: np.ndarray, state: np.ndarray, rate: float) -> np.ndarray:
        """One window of truncated backpropagation; returns the state after it."""
        valid = ids >= 0
        full = valid.all()  # most windows; they need no masks
        ids = ids if full else np.where(valid, ids, 0)
        before, after, (r, z, new, inner) = self.read(ids, fresh, state)
        n, starts = HIDDEN, fresh.any(1)
        used = ids.ravel() if full else ids[valid]
        _, grads, back = self.predict(before.reshape(-1, n) if full else before[valid], used, True)
        if full:
            error, keep = back.reshape(before.shape), 1 - z
        else:
            error = np.zeros_like(before)
            error[valid] = back
            keep = (1 - z) * valid[..., None]
        to_new, to_z, to_r = keep * (1 - new * new), (before - new) * z * keep, inner * r * (1 - r)
        inputs, pre = (np.empty((*ids.shape, 3 * n), np.float32) for _ in range(2))
        flow, back_gate = np.zeros_like(state), self.gate.T.copy()
        for t in range(len(ids) - 1, -1, -1):
            d, e = inputs[t], pre[t]
            np.multiply(flow, to_new[t], out=d[:, 2 * n :])
            np.multiply(flow, to_z[t], out=d[:, n : 2 * n])
            np.multiply(d[:, 2 * n :], to_r[t], out=d[:, :n])
            e[...] = d
            e[:, 2 * n :] *= r[t]
            flow = flow * z[t]
            flow += e @ back_gate
            flow += error[t]
            if starts[t]:
                flow[fresh[t]] = 0
        gate = before.reshape(-1, n).T @ pre.reshape(-1, 3 * n)
        order = np.argsort(used.astype(np.int16), kind="stable")
        used = used[order]
        firsts = np.flatnonzero(np.r_[True, used[1:] != used[:-1]])
        self._step("gate", gate, rate)
        self._step("word", np.add.reduceat((inputs.reshape(-1, 3 * n) if full else inputs[valid])[order], firsts), rate, used[firsts])
        for name, grad in grads.items():
            self._step(name, grad, rate)
        return after

    def _step(self, name: str, grad: np.ndarray, rate: float, rows=slice(None)) -> None:
        """Adagrad; a window of few streams counts as little as it has words."""
        grad = grad * np.float32(1.0 / STREAMS)
        seen, values = self.seen[name], getattr(self, name)
        seen[rows] += grad * grad
        values[rows] -= np.float32(rate) * grad / np.sqrt(seen[rows])


def streams(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents laid one after another onto parallel streams, the longest first.

    Ids (-1 where a stream has ended), first words of documents, and the document of each place.
    """
    width = min(STREAMS, max(1, len(docs)))
    loads = [(0, s) for s in range(width)]
    places = []
    for doc in sorted(range(len(docs)), key=lambda d: -len(docs[d])):
        load, stream = heapq.heappop(loads)
        places.append((doc, stream, load))
        heapq.heappush(loads, (load + len(docs[doc]), stream))
    height = max(load for load, _ in loads)
    height += -height % WINDOW
    ids, fresh, owner = np.full((height, width), -1, np.int32), np.zeros((height, width), bool), np.zeros((height, width), np.int32)
    for doc, stream, start in places:
        stop = start + len(docs[doc])
        ids[start:stop, stream], owner[start:stop, stream], fresh[start, stream] = docs[doc], doc, True
    return ids, fresh, owner


def train_on(net: Network, docs: list[np.ndarray], rate: float) -> None:
    ids, fresh, _ = streams(docs)
    state = np.zeros((ids.shape[1], HIDDEN), np.float32)
    for t in range(0, len(ids), WINDOW):
        live = np.flatnonzero((ids[t : t + WINDOW] >= 0).any(0))
        state[live] = net.learn(ids[t : t + WINDOW, live], fresh[t : t + WINDOW, live], state[live], rate)


def score_docs(net: Network, docs: list[np.ndarray]) -> np.ndarray:
    """Log10 probability of the ids of each document."""
    ids, fresh, owner = streams(docs)
    state, total = np.zeros((ids.shape[1], HIDDEN), np.float32), np.zeros(len(docs))
    for t in range(0, len(ids), WINDOW):
        live = np.flatnonzero((ids[t : t + WINDOW] >= 0).any(0))
        part = ids[t : t + WINDOW, live]
        valid = part >= 0
        before, after, _ = net.read(np.where(valid, part, 0), fresh[t : t + WINDOW, live], state[live])
        state[live] = after
        found = net.predict(before[valid], part[valid], False)
        total += np.bincount(owner[t : t + WINDOW, live][valid], found, len(docs))
    return total / np.log(10)


@dataclass
class Vocabulary:
    """Counts of the known words, ids of all words, and the mass of each rare class."""

    known: dict[bytes, int]  # word to its place in ``counts``
    counts: np.ndarray
    head: int  # the first so many known words have ids of their own
    rare_mass: np.ndarray

    def __post_init__(self):
        words = list(self.known)
        self.ids = np.array([k if k < self.head else self.head + rare_class(w) for k, w in enumerate(words)], np.int16)

    def encode(self, text: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Ids, known places (-1 where unknown) and the unknown words of a text."""
        words = words_of(text)
        get = self.known.get
        places = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
        ids = self.ids[places] if len(self.ids) else np.zeros(len(words), np.int16)
        unknown = np.flatnonzero(places < 0).tolist()
        rare = [words[k] for k in unknown]
        if unknown:
            ids[unknown] = [self.head + rare_class(w) for w in rare]
        return ids, places, rare


def _counted(batches):
    counts = Counter()

    def out():
        words = list(counts)
        return pa.RecordBatch.from_pydict({
            "word": pa.array(words, pa.binary()).cast(pa.string()), "kind": pa.array([rare_class(w) for w in words], pa.int32()),
            "times": pa.array(list(counts.values()), pa.int64())})

    for batch in batches:
        for text in batch.column("text").cast(pa.binary()):
            counts.update(words_of(text.as_py() or b""))
            if len(counts) > 400_000:
                yield out()
                counts.clear()
    if counts:
        yield out()


def word_counts(train: DataFrame) -> DataFrame:
    """word, its rare class, and its count over all training documents; the end is ''."""
    counted = train.select("text").mapInArrow(_counted, "word string, kind int, times bigint")
    return counted.groupBy("word", "kind").agg(F.sum("times").alias("times"))


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, int, int]:
    """The broadcast part of the counts, and the numbers of training tokens and words."""
    by_kind = {r["kind"]: (r["tokens"], r["words"]) for r in counts.groupBy("kind").agg(
        F.sum("times").alias("tokens"), F.count(F.lit(1)).alias("words")).collect()}
    tokens, words = sum(t for t, _ in by_kind.values()), sum(n for _, n in by_kind.values())
    # The smallest count for which the words of at least that count are few enough. The
    # counts of counts below the bound are summed apart, so few rows reach the driver.
    common = F.least(F.col("times"), F.lit(1 << 16))
    room, least = KNOWN_WORDS, 1
    for row in counts.groupBy(common.alias("times")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("times")).toLocalIterator():
        room -= row["words"]
        if room < 0:
            least = row["times"] + 1
            break
    top = counts.where((F.col("times") >= least) | (F.col("word") == "")).orderBy(F.desc("times"), "word").toLocalIterator()
    ranked = [(r["word"].encode(), r["times"]) for r in top]
    ranked.sort(key=lambda r: (r[0] != END, -r[1], r[0]))  # the end has an id of its own
    head = min(HEAD, len(ranked))
    mass = np.ones(RARE_CLASSES)
    for kind, (n, v) in by_kind.items():
        mass[kind] += n + v
    for word, n in ranked[:head]:
        mass[rare_class(word)] -= n + 1
    return Vocabulary({w: k for k, (w, _) in enumerate(ranked)}, np.array([n for _, n in ranked], np.int64), head, mass), tokens, words


def _summed(batches):
    tokens, weights = 0, 0.0
    for batch in batches:
        for n, data in zip(batch.column("tokens").to_pylist(), batch.column("weights").to_pylist()):
            tokens, weights = tokens + n, weights + np.frombuffer(data, np.float64)
    if tokens:
        yield pa.RecordBatch.from_pydict(_weights_row(tokens, weights))


def warm_start(train_docs: DataFrame, vocab: Vocabulary) -> Network:
    """A network trained on a bounded sample of the training documents."""
    net = Network(vocab.head)
    if not vocab.head:
        return net
    sample = train_docs.select(F.col("text").cast("binary").alias("text"), F.xxhash64("doc_id").alias("turn"))
    texts = [bytes(r["text"] or b"") for r in sample.orderBy("turn", "text").limit(WARM_DOCUMENTS).collect()]
    docs, room = [], WARM_TOKENS
    for text in texts:
        if room > 0:
            docs.append(vocab.encode(text)[0])
            room -= len(docs[-1])
    counts = np.bincount(vocab.ids, vocab.counts, vocab.head + RARE_CLASSES)
    net.start_from(counts + np.r_[np.zeros(vocab.head), vocab.rare_mass * 0.01])
    for _ in range(WARM_PASSES if docs else 0):
        train_on(net, docs, RATE)
    return net


def _lists(rares: list[Counter]) -> pa.Array:
    """The unknown words of each document with their numbers, as ``FOUND`` has them."""
    ends = np.cumsum([0] + [len(rare) for rare in rares])
    words = pa.array([w for rare in rares for w in rare], pa.binary()).cast(pa.string())
    times = pa.array([n for rare in rares for n in rare.values()], pa.int64())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([words, times], ["word", "times"]))


def _weights_row(tokens: int, weights: np.ndarray) -> dict:
    return {"tokens": pa.array([tokens], pa.int64()), "weights": pa.array([weights.tobytes()], pa.binary())}


def _read_once(shared):
    """Encodes every document, keeps what its scores need, and trains a copy on those to learn from.

    The last row of a task holds its copy instead of a document.
    """

    def run(batches):
        net, vocab = shared.value
        net, seen = net.copy(), 0
        logs, rare_logs = np.log10(vocab.counts + 1.0), np.log10(vocab.rare_mass)
        learn, held = [], 0
        for batch in batches:
            found = []
            for text, teaches in zip(batch.column("text").cast(pa.binary()), batch.column("teaches").to_pylist()):
                ids, places, rare = vocab.encode(text.as_py() or b"")
                known = places[places >= 0]
                inside = logs[known[known >= vocab.head]].sum() - rare_logs[ids[ids >= vocab.head] - vocab.head].sum()
                found.append((len(ids), len(known), float(logs[known].sum()), float(inside), ids.tobytes(), Counter(rare)))
                if teaches and vocab.head:
                    learn.append(ids)
                    held += len(ids)
            columns = dict(zip(FOUND, zip(*found) if found else [()] * len(FOUND)))
            rares = columns.pop("rare")
            out = {name: batch.column(name) for name in ("doc_id", "held_out", "key")}
            out |= {name: pa.array(column, FOUND[name]) for name, column in columns.items()} | {"rare": _lists(rares)}
            out |= {"tokens": pa.nulls(len(found), pa.int64()), "weights": pa.nulls(len(found), pa.binary())}
            yield pa.RecordBatch.from_pydict(out)
            if held >= CHUNK_TOKENS:
                train_on(net, learn, RATE)
                seen += held
                learn, held = [], 0
        if learn:
            train_on(net, learn, RATE)
            seen += held
        if seen:
            out = {"doc_id": pa.nulls(1, pa.int64()), "held_out": pa.nulls(1, pa.bool_()), "key": pa.nulls(1, pa.int64())}
            out |= {name: pa.nulls(1, kind) for name, kind in FOUND.items()}
            yield pa.RecordBatch.from_pydict(out | _weights_row(seen, np.frombuffer(net.packed(), np.float64) * seen))

    return run


def _averaged(net: Network, copies: DataFrame) -> Network:
    """The copies of all tasks, weighted by the words they have read."""
    kind = "tokens bigint, weights binary"
    parts = max(1, int(copies.count() ** 0.5))
    total = copies.repartition(parts).mapInArrow(_summed, kind).repartition(1).mapInArrow(_summed, kind).first()
    if total is not None:
        net.unpack(np.frombuffer(bytes(total["weights"]), np.float64) / total["tokens"])
    return net


def _scored(shared):
    """Scores documents in chunks of ``CHUNK_TOKENS``, however they are batched.

    The longest document sets the number of steps of a chunk, so small chunks cost as much as large ones.
    """

    def run(batches):
        net = shared.value
        docs, kept, held = [], [], 0

        def out():
            found, at = score_docs(net, docs), 0
            for batch in kept:
                yield batch.append_column("model_log", pa.array(found[at : at + len(batch)], pa.float64()))
                at += len(batch)

        for batch in batches:
            arrived = [np.frombuffer(b, np.int16) for b in batch.column("ids").to_pylist()]
            docs += arrived
            held += sum(map(len, arrived))
            kept.append(batch.select([name for name in SCORED if name != "model_log"]))
            if held >= CHUNK_TOKENS:
                yield from out()
                docs, kept, held = [], [], 0
        if docs:
            yield from out()

    return run


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every document."""
    spark = docs.sparkSession
    keyed = docs.select("doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "text")
    keyed = keyed.withColumn("teaches", ~F.col("held_out") & F.col("doc_id").isNotNull())
    train_docs = keyed.where("teaches")
    counts = materialise(word_counts(train_docs), "word-counts")
    vocab, tokens, words = vocabulary(counts)
    net = warm_start(train_docs, vocab)
    shared = spark.sparkContext.broadcast((net, vocab))
    read = keyed.select("doc_id", "held_out", F.xxhash64("text").alias("key"), "teaches", "text")
    read = materialise(read.mapInArrow(_read_once(shared), READ), "lm-documents")
    net = _averaged(net, read.where("weights is not null").select("tokens", "weights"))
    rows = read.where("weights is null")
    kinds = dict(c.split(" ", 1) for c in READ.split(", "))
    scored = rows.select("doc_id", "held_out", "key", "n_tokens", "n_known", "base_log", "inside_log", "ids").mapInArrow(
        _scored(spark.sparkContext.broadcast(net)), ", ".join(f"{name} {kinds.get(name, 'double')}" for name in SCORED))

    rare = rows.select("doc_id", "key", F.explode("rare").alias("r")).select("doc_id", "key", "r.word", "r.times")
    rare = rare.dropDuplicates().join(counts.select("word", F.col("times").alias("count")), "word")
    rare = rare.groupBy("doc_id", "key").agg(
        F.sum(F.col("times") * F.log10(F.col("count") + F.lit(1.0))).alias("rare_log"), F.sum("times").alias("rare_known"))
    rare = rare.toDF("rare_id", "rare_key", "rare_log", "rare_known")
    here = scored["doc_id"].eqNullSafe(rare["rare_id"]) & (scored["key"] == rare["rare_key"])
    both = scored.join(rare, here, "left").withColumn("rare_log", F.coalesce("rare_log", F.lit(0.0)))
    return both.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_log") + F.col("rare_log") - F.col("n_tokens") * F.log10(F.lit(float(tokens + words + 1)))).alias("base_score"),
        (F.col("model_log") + F.col("inside_log") + F.col("rare_log")).alias("score"),
    )


FOUND = {
    "n_tokens": pa.int64(), "n_known": pa.int64(), "base_log": pa.float64(), "inside_log": pa.float64(), "ids": pa.binary(),
    "rare": pa.list_(pa.struct([("word", pa.string()), ("times", pa.int64())])),
}
READ = (
    "doc_id bigint, held_out boolean, key bigint, n_tokens bigint, n_known bigint, base_log double, inside_log double, "
    "ids binary, rare array<struct<word:string,times:bigint>>, tokens bigint, weights binary"
)
SCORED = ["doc_id", "held_out", "key", "n_tokens", "n_known", "base_log", "inside_log", "model_log"]
