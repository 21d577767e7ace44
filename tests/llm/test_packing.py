import random
import zlib
from array import array
from collections import defaultdict

import frames
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tierstone.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(PATH)


def ids_of(model, text):
    return model.encode(text or "", add_special_tokens=False).ids + [1]


def check(model, rows, pieces):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    for i, text in rows:
        ids, at = ids_of(model, text), 0
        for p in sorted(by_doc[i], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(array("I", ids[at : at + p["length"]]).tobytes())
            at += p["length"]
        assert at == len(ids)
    for members in by_sequence.values():
        at = 0
        for p in sorted(members, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == members[0]["window"] and at & (at - 1) == 0 and at <= 2048
        assert len({p["step_group"] for p in members}) == 1


def test_every_id_lies_in_one_full_window(spark, model):
    rng = random.Random(3)
    rows = [(k, " ".join(frames.sentence(rng, rng.choice([0, 3, 40, 300, 1500])))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, "a  b\n\n c "), (103, "文字 <|endoftext|> \x1c x y"), (104, "word " * 20000)]
    pieces = P.pack_documents(frames.docs(spark, rows).repartition(3), pool_tokens=4000).collect()
    check(model, rows, pieces)
    assert {p["window"] for p in pieces} >= set(P.TIERS[:2])


def test_odd_rows(spark):
    pieces = P.pack_documents(frames.docs(spark, frames.ODD)).collect()
    assert len([p for p in pieces if p["start"] == 0]) == len(frames.ODD)
    assert sum(p["doc_id"] is None and p["start"] == 0 for p in pieces) == 2
    assert P.pack_documents(frames.docs(spark, [])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=" \n\tab,.'é文  \x1c7s", max_size=60))
def test_chunks_have_the_ids_of_the_text(model, text):
    found = array("I", P.text_tokenizer(str(PATH)).encode(text)).tolist() if text else []
    assert found == model.encode(text, add_special_tokens=False).ids


def test_step_groups_are_even():
    costs = [random.Random(1).randrange(1000) for _ in range(96)]
    dealt = P.step_groups(costs, 32)
    sums = [sum(c for c, g in zip(costs, dealt) if g == k) for k in range(3)]
    assert sorted(map(dealt.count, range(3))) == [32] * 3 and max(sums) < 1.05 * min(sums)
