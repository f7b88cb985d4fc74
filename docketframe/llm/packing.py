"""Sum-of-squares packing of token sequences into windows.

One pass over the rows where they lie, without a shuffle: each task encodes its documents and packs them online. A
document's whole windows are cut off first. What remains goes to the fill level that minimises the sum, over all levels,
of the squared number of partly filled windows; a level array tracks these numbers. Full windows leave at once, so a
task holds open windows only, at most what its part of the input holds. At its end the emptiest open window is dissolved,
again and again: its pieces go to other open windows by the same rule, and where none has room for a piece, the piece is
cut to fill the fullest. The one window that stays open at last is cut into powers of two, which need no padding.

A null text counts as empty and is packed as its end id alone. Empty partitions give no rows; rows that repeat are packed
each by itself; a null ``doc_id`` is carried along. Texts of any length are encoded whole. Other columns are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 2048
END_ID = 1
#: Fixed values of the tokenizer file: tokens that are one id wherever a text spells them.
SPECIAL = {"<|endoftext|>": 50256}
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def byte_bpe(folder: str | None = None) -> Callable[[str], np.ndarray]:
    """The encoder of the byte-level vocabulary; a special token that a text spells is its own id, as in the tokenizer file.

    The ranks and the tokenizer file are one vocabulary. The ranks are encoded faster; where that engine gives up, as on
    millions of spaces, the tokenizer file is used. ``folder`` holds both; default: that of the installed package.
    """
    import public_tokenizers
    import tiktoken

    place = (lambda name: f"{folder}/{name}") if folder else public_tokenizers.path
    with open(place("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    slow = []

    def encode(text: str) -> np.ndarray:
        try:
            return np.asarray(encoding.encode_to_numpy(text, allowed_special="all"), dtype="<u4")
        except ValueError:  # the pattern engine ran out of its stack
            pass
        if not slow:
            from tokenizers import Tokenizer

            slow.append(Tokenizer.from_file(place("byte_bpe_50k.json")))
        return np.array(slow[0].encode(text, add_special_tokens=False).ids, dtype="<u4")

    return encode


class Packer:
    """The online packer of one task. Pieces are (doc_id, start, ids, doc_tokens)."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence = window, first_sequence
        self.levels = np.zeros(window + 1, dtype=np.int64)
        self.open: dict[int, list[list]] = {}
        self.rows: list[tuple] = []

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        whole = len(ids) - len(ids) % self.window
        for start in range(0, whole, self.window):
            self.close([(doc, start, ids[start : start + self.window], len(ids))])
        if whole < len(ids):
            self.place((doc, whole, ids[whole:].copy(), len(ids)))

    def level_for(self, size: int, new: bool = True) -> int:
        """The level whose next window takes ``size`` more at the least sum of squares; ties go to the fullest. 0: a new one."""
        levels, full = self.levels, self.window - size
        used = np.flatnonzero(levels[1 : full + 1]) + 1
        best, chosen = (2 * levels[size] + 1 if new else np.inf), 0
        if len(used):
            change = np.where(used == full, 1, 2 * levels[used + size] + 2) - 2 * levels[used]
            at = len(used) - 1 - int(np.argmin(change[::-1]))
            if change[at] <= best:
                chosen = int(used[at])
        return chosen

    def place(self, piece: tuple) -> None:
        self.put(piece, self.level_for(len(piece[2])))

    def taken(self, level: int) -> list[tuple]:
        """The pieces of an open window, which is open no more."""
        self.levels[level] -= 1
        return self.open[level].pop()

    def put(self, piece: tuple, level: int) -> None:
        filled = level + len(piece[2])
        pieces = [*(self.taken(level) if level else []), piece]
        if filled == self.window:
            self.close(pieces)
        else:
            self.open.setdefault(filled, []).append(pieces)
            self.levels[filled] += 1

    def finish(self) -> None:
        """Leaves no window open."""
        while self.levels.sum() > 1:
            for piece in self.taken(int(np.flatnonzero(self.levels)[0])):
                doc, start, ids, total = piece
                while len(ids):
                    level, part = self.level_for(len(ids), new=not self.levels.any()), ids
                    if not level and self.levels.any():  # room for it nowhere
                        level = int(np.flatnonzero(self.levels)[-1])
                        part = ids[: self.window - level]
                    self.put((doc, start, part, total), level)
                    start, ids = start + len(part), ids[len(part) :]
        for level in np.flatnonzero(self.levels).tolist():
            self.cut(self.taken(level), level)

    def cut(self, pieces: list[tuple], left: int) -> None:
        """Sequences whose lengths are the powers of two in ``left``, the greatest first."""
        taken, room = [], 1 << left.bit_length() - 1
        for doc, start, ids, total in pieces:
            while len(ids):
                part, ids = ids[:room], ids[room:]
                taken.append((doc, start, part, total))
                start, room, left = start + len(part), room - len(part), left - len(part)
                if not room:
                    self.close(taken)
                    taken, room = [], (1 << left.bit_length() - 1 if left else 0)

    def flush(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack(
    documents: DataFrame,
    encoder: Callable[[], Callable[[str], np.ndarray]] = byte_bpe,
    window: int = WINDOW,
    end_id: int = END_ID,
) -> DataFrame:
    """The pieces of all ``documents`` (doc_id, text). ``encoder`` is called once a task."""
    names = [field.split()[0] for field in PIECES.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(), np.array([end_id], dtype="<u4")
        packer = Packer(window, TaskContext.get().partitionId() << 32)
        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                packer.add(doc, np.concatenate([encode(text.as_py() or ""), end]))
            yield batch_of(packer.flush())
        packer.finish()
        yield batch_of(packer.flush())

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)
