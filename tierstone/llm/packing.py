"""Hierarchical multi-length packing of tokenised documents.

Documents are routed to context sizes (``TIERS``) by their length; whole windows of a
longer document are cut off first. Each tier packs its documents into windows of its own
size, the longest first; the gap of a window is filled with the longest documents of the
shorter tiers that fit, and its last tokens by cutting one more document, whose rest goes
back to its tier. So windows are full, with about one cut for each of them. What is left
at the end of a task is cut into sequences of powers of two. The windows of a tier are
dealt to step groups of equal tokens so that the squares of the piece lengths (the cost of
attention) are even.

A task packs the documents it reads, holding at most about ``POOL_TOKENS`` at a time:
nothing is shuffled, and the output depends on the input rows and their order alone.

Defined cases: a null text is an empty text, which has one token, the end; a null doc_id
stays null; repeated rows are documents of their own; an empty table gives no piece.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

TIERS = (2048, 1024, 512, 256)
END_ID = 1
STEP_TOKENS = 1 << 16
POOL_TOKENS = 1 << 21
TOKENIZER = "byte_bpe_50k.json"

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, window int, step_group bigint"
)


class TextTokenizer:
    """Ids of texts as little-endian 32-bit bytes, from the file of a byte-level BPE tokenizer.

    The merges of such a file are numbered in their order, so the same ids come from the ranks
    of the tokens' bytes alone, in a fraction of the time. The tokenizer itself serves files of another kind, and texts with long
    runs of white space, on which the faster expression gives up.
    """

    # How byte-level tokenizers split text.
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    LONG_SPACE = re.compile(r"\s{4096}")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        assert sys.byteorder == "little" and array("I").itemsize == 4
        self.model = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as source:
            self.ranked = self._ranked(json.load(source), self.model.get_added_tokens_decoder())

    @classmethod
    def _ranked(cls, stored: dict, special: dict):
        """The encoding by ranks, None where it would not give the same ids."""
        model, split = stored["model"], {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if stored["normalizer"] or {**(stored["pre_tokenizer"] or {}), "trim_offsets": None} != {**split, "trim_offsets": None}:
            return None
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            return None
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in special.values()):
            return None
        names = {token.content: number for number, token in special.items()}
        vocabulary = {token: number for token, number in model["vocab"].items() if token not in names}
        merged = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
        # Bytes are written as the printable character of that number, the others from 256 on.
        plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - plain))}
        if merged != sorted(set(merged)) or len(vocabulary) != 256 + len(merged) or max(vocabulary[c] for c in byte_of) > merged[0]:
            return None
        import tiktoken

        ranks = {bytes(byte_of[c] for c in token): number for token, number in vocabulary.items()}
        return tiktoken.Encoding("ranked", pat_str=cls.SPLIT, mergeable_ranks=ranks, special_tokens=names)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.ranked is None or self.LONG_SPACE.search(text):
            return array("I", self.model.encode(text, add_special_tokens=False).ids).tobytes()
        return self.ranked.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()


@lru_cache(maxsize=1)
def text_tokenizer(path: str) -> TextTokenizer:
    """One for a worker process, for all of its tasks."""
    return TextTokenizer(path)


class Pool:
    """Pieces of documents by length, with a bit for each length that occurs."""

    def __init__(self, longest: int):
        self.by_length: list[list[tuple[int, int]]] = [[] for _ in range(longest + 1)]
        self.present = self.tokens = 0

    def add(self, doc: int, start: int, length: int) -> None:
        self.by_length[length].append((doc, start))
        self.present |= 1 << length
        self.tokens += length

    def _take(self, length: int) -> tuple[int, int, int]:
        doc, start = self.by_length[length].pop()
        if not self.by_length[length]:
            self.present ^= 1 << length
        self.tokens -= length
        return doc, start, length

    def longest_upto(self, most: int) -> tuple[int, int, int] | None:
        fit = self.present & ((2 << most) - 1)
        return self._take(fit.bit_length() - 1) if fit else None

    def shortest_over(self, least: int) -> tuple[int, int, int] | None:
        fit = self.present >> (least + 1)
        return self._take(least + (fit & -fit).bit_length()) if fit else None

    def any_over(self, least: int) -> bool:
        return self.present >> (least + 1) != 0


def pack(pool: Pool, tiers: tuple[int, ...], last: bool) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """Windows and their pieces. Unless ``last``, what fills no window stays in the pool."""
    left = []
    for tier, shorter in zip(tiers, (*tiers[1:], 0)):
        while pool.any_over(shorter):
            window, gap = [], tier
            while gap:
                if (piece := pool.longest_upto(gap)) is None:
                    if (piece := pool.shortest_over(gap)) is None:
                        break
                    doc, start, length = piece
                    pool.add(doc, start + gap, length - gap)
                    piece = doc, start, gap
                window.append(piece)
                gap -= piece[2]
            if gap:
                left += window
            else:
                yield tier, window
    if not last:
        for piece in left:
            pool.add(*piece)
        return
    total = sum(length for _, _, length in left)
    while total:
        size = 1 << (total.bit_length() - 1)
        size, total, window, gap = size, total - size, [], size
        while gap:
            doc, start, length = left.pop(0)
            window.append((doc, start, min(length, gap)))
            if length > gap:
                left.insert(0, (doc, start + gap, length - gap))
            gap -= window[-1][2]
        yield size, window


def step_groups(costs: list[int], size: int) -> list[int]:
    """Group of each item: items by falling cost, dealt back and forth over the groups."""
    groups, dealt = -(-len(costs) // size), [0] * len(costs)
    for place, item in enumerate(sorted(range(len(costs)), key=lambda i: -costs[i])):
        turn, at = divmod(place, groups)
        dealt[item] = groups - 1 - at if turn % 2 else at
    return dealt


class TaskPacker:
    """Packs the documents of one task; ``task`` makes its sequence and group ids unique."""

    def __init__(self, task: int, tiers: tuple[int, ...], pool_tokens: int):
        self.tiers, self.pool_tokens = tiers, pool_tokens
        self.pool, self.docs, self.kept_tokens = Pool(tiers[0]), {}, 0
        self.sequence = self.group = task << 33
        self.number = 0

    def add(self, doc_id: int | None, ids: bytes) -> list[tuple]:
        n, doc = len(ids) // 4, self.number
        self.number += 1
        self.docs[doc] = doc_id, ids
        self.kept_tokens += n
        whole = n - n % self.tiers[0]
        for start in range(0, whole, self.tiers[0]):
            self.pool.add(doc, start, self.tiers[0])
        if n > whole:
            self.pool.add(doc, whole, n - whole)
        return self.flush(False) if self.kept_tokens >= self.pool_tokens else []

    def flush(self, last: bool) -> list[tuple]:
        rows, by_window = [], {}
        for window, pieces in pack(self.pool, self.tiers, last):
            by_window.setdefault(window, []).append(pieces)
        for window, sequences in by_window.items():
            costs = [sum(length * length for _, _, length in pieces) for pieces in sequences]
            size = max(1, STEP_TOKENS // window)
            dealt = step_groups(costs, size)
            for pieces, group in zip(sequences, dealt):
                offset = 0
                for doc, start, length in pieces:
                    doc_id, ids = self.docs[doc]
                    crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
                    rows.append((doc_id, start, length, crc, len(ids) // 4, self.sequence, offset, window, self.group + group))
                    offset += length
                self.sequence += 1
            self.group += max(dealt) + 1
        open_docs = {doc for held in self.pool.by_length for doc, _ in held}
        self.docs = {doc: self.docs[doc] for doc in open_docs}
        self.kept_tokens = sum(len(ids) // 4 for _, ids in self.docs.values())
        return rows


def _packer(path: str, tiers: tuple[int, ...], pool_tokens: int) -> Callable:
    def run(batches):
        kinds = {"bigint": pa.int64(), "int": pa.int32()}
        fields = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in PIECES.split(", "))])
        model, packer = text_tokenizer(path), TaskPacker(TaskContext.get().partitionId(), tiers, pool_tokens)
        end = END_ID.to_bytes(4, "little")
        out = lambda rows: pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(zip(*rows), fields)], schema=fields)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                if rows := packer.add(doc_id, model.encode(text.as_py() or "") + end):
                    yield out(rows)
        if rows := packer.flush(True):
            yield out(rows)

    return run


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, tiers: tuple[int, ...] = TIERS, pool_tokens: int = POOL_TOKENS,
) -> DataFrame:
    """One row per piece: where it comes from, its ids' CRC-32, and where it is packed.

    ``tokenizer`` is the path of a byte-level BPE file; the same file on every worker.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    return docs.select("doc_id", "text").mapInArrow(_packer(str(tokenizer), tiers, pool_tokens), PIECES)
