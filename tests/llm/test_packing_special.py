import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docketframe.llm import packing

TEXTS = [
    "a <|endoftext|> b",
    "<|endoftext|>",
    "<|endoftext|><|endoftext|> \n <|endoftext|>  x",
    "don't  <|endoftext|>'ll <|endoftext|",
    " " * 2_000_000 + "<|endoftext|> b",  # past the stack of the rank engine
]


def ids(text):
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids


def test_the_token_is_one_id():
    assert packing.byte_bpe()("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]


@pytest.mark.parametrize("text", TEXTS)
def test_special_tokens_as_in_the_tokenizer_file(text):
    assert packing.byte_bpe()(text).tolist() == ids(text)


def test_documents_that_spell_the_token(spark):
    rows = packing.pack(spark.createDataFrame(list(enumerate(TEXTS[:4])), "doc_id long, text string").coalesce(1)).collect()
    for doc, text in enumerate(TEXTS[:4]):
        wanted = np.array([*ids(text), packing.END_ID], "<u4")
        pieces = sorted((row for row in rows if row.doc_id == doc), key=lambda row: row.start)
        assert sum(row.length for row in pieces) == len(wanted)
        for row in pieces:
            assert row.doc_tokens == len(wanted)
            assert row.ids_crc32 == zlib.crc32(wanted[row.start : row.start + row.length].tobytes())
