"""What a Python worker keeps between tasks goes when another operator runs."""

import sys

import pyarrow as pa
import public_tokenizers
import pytest

from stratamart.llm import common, minhash, packing

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(autouse=True)
def as_before():
    yield
    common.forget_worker_memory()


def test_a_worker_keeps_the_memory_of_one_operator():
    one = common.worker_memory("one", list)
    assert common.worker_memory("one", list) is one
    two = common.worker_memory("two", list)
    assert two is not one and common.worker_memory("one", list) is not one
    with pytest.raises(ZeroDivisionError):
        common.worker_memory("three", lambda: 1 // 0)
    assert common.worker_memory("one", list) == []


def test_near_duplicates_free_what_packing_kept():
    held = packing.word_ids(TOKENIZER)
    assert packing.word_ids(TOKENIZER) is held
    batch = pa.RecordBatch.from_pydict({"node": [1], "id": [1], "text": ["a b c d e f"]})
    assert sum(b.num_rows for b in minhash._sign(2, 2, 5)(iter([batch]))) == 1
    kept = [v for m in list(sys.modules) if m.startswith("_stratamart") for v in vars(sys.modules[m]).values()]
    assert not any(v is held for v in kept)
