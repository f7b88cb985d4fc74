import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docketframe.llm import packing
from tests.llm.odd import empty_documents, odd_documents, odd_rows, with_clashes


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return own


def check_pieces(rows, tokens, window=2048):
    """``tokens``: the ids of each document, by a list for each doc_id."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for doc, start, length, crc, total, sequence, offset in rows:
        pieces[doc].append((start, length, crc, total))
        sequences[sequence].append((offset, length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or at & (at - 1) == 0, "padding"
        assert at <= window
    assert set(pieces) == set(tokens)
    for doc, texts in tokens.items():
        if len(texts) == 1:
            at = 0
            for start, length, crc, total in sorted(pieces[doc]):
                assert start == at and total == len(texts[0])
                assert zlib.crc32(np.array(texts[0][start : start + length], "<u4").tobytes()) == crc
                at += length
            assert at == len(texts[0])
        else:
            assert sum(length for _, length, _, _ in pieces[doc]) == sum(map(len, texts))


def test_every_token_is_packed_once(spark):
    own, tokens = tokenizer(), defaultdict(list)
    for row in odd_rows():
        tokens[row[0]].append([*own.encode(row[1] or "", add_special_tokens=False).ids, 1])
    documents = with_clashes(odd_documents(spark)).repartition(3)
    check_pieces([tuple(row) for row in packing.pack(documents).collect()], tokens)


def test_packing_nothing(spark):
    assert packing.pack(empty_documents(spark)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=60))
def test_packer_against_a_plain_count(sizes):
    packer, tokens = packing.Packer(16, 0), {}
    for doc, size in enumerate(sizes):
        ids = np.arange(size, dtype="<u4") + doc
        tokens[doc] = [ids.tolist()]
        packer.add(doc, ids)
        assert packer.levels.sum() == sum(map(len, packer.open.values()))
    open_before, closed = int(packer.levels.sum()), packer.sequence
    left = sum(level * int(n) for level, n in enumerate(packer.levels))
    packer.finish()
    assert not packer.levels.any() and not any(packer.open.values())
    rows = packer.flush()
    check_pieces(rows, tokens, 16)
    lengths = {}
    for row in rows:
        lengths[row[5]] = lengths.get(row[5], 0) + row[2]
    assert sum(length < 16 for length in lengths.values()) == bin(left % 16).count("1"), "one window at most is cut up"
    assert packer.sequence - closed <= max(open_before, 1) + 4


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=15, max_size=15), st.integers(1, 15))
def test_level_has_the_least_sum_of_squares(counts, size):
    packer = packing.Packer(16, 0)
    packer.levels[1:16] = counts

    def squares(level):
        after = packer.levels.copy()
        after[level] -= level > 0
        if level + size < 16:
            after[level + size] += 1
        return (after[1:16] ** 2).sum()

    choices = [0] + [level for level in range(1, 17 - size) if packer.levels[level]]
    assert squares(packer.level_for(size)) == min(map(squares, choices))


@pytest.mark.parametrize("text", ["", " " * 50_000, "\n\t " * 20_000 + "x", "a" * 30_000, "<|endoftext|> is text", "naïve 日本語 😀\u0000", "don't I'll  we've   \n\n x"])
def test_encoder_agrees_with_the_tokenizer_file(text):
    assert packing.byte_bpe()(text).tolist() == tokenizer().encode(text, add_special_tokens=False).ids


def test_encoder_survives_what_its_engine_does_not():
    text = " " * 2_000_000
    assert packing.byte_bpe()(text).tolist() == tokenizer().encode(text, add_special_tokens=False).ids
