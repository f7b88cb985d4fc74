"""Language identification with error-correcting output codes.

Every language has a codeword of +1 and -1. Binary logistic classifiers over hashed byte n-grams (one to four bytes of
the lower-cased text, other than letters read as spaces) each predict one bit. A text goes to the language whose codeword
has the least weighted loss against the bits; the weights are how well each bit was learned for that language. A text
whose two nearest codewords are within ``MARGIN`` of each other is flagged as ambiguous.

Learned are the languages of rows with a non-null ``lang`` outside the held-out fold (crc32 of ``doc_id`` as text, modulo
4, is 2; a null id is in no fold and not learned from). The classifiers are fitted on a sample of at most
``TRAIN_ROWS`` such rows, as many of each language, chosen by a hash of the id. Predictions see the whole text only.

A null text, or one without letters, is ``und`` with score 0, and so is any text if no language was learned. Very long
texts are counted in chunks. Empty tables give empty results; rows that repeat are predicted alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType
from pyspark.sql.window import Window

from docketframe.llm.common import unused

UNKNOWN = "und"
#: Rows fitted on, over all languages.
TRAIN_ROWS = 4096
#: Hashed features, a power of two.
FEATURES = 4096
#: Least difference of the losses of the two nearest codewords, as a share of the code's length.
MARGIN = 0.005
FOLDS, HELD_OUT = 4, 2
_CHUNK = 1 << 20
_SPACED = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], dtype=np.uint32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def features(text: str) -> np.ndarray | None:
    """Unit vector of n-gram counts under a square root; None without letters."""
    if not any(map(str.isalpha, text)):  # letters by Unicode category: signs such as powers and fractions are none
        return None
    raw = np.frombuffer(text.lower().encode(), dtype=np.uint8)
    counts = np.zeros(FEATURES)
    shift = np.uint32(33 - FEATURES.bit_length())
    for at in range(0, len(raw), _CHUNK):
        units = _SPACED[raw[at : at + _CHUNK + 3]]
        gram = units * np.uint32(0x9E3779B1)
        for size in range(1, 5):
            if size > 1:
                gram = (gram[:-1] ^ units[size - 1 :]) * np.uint32(0x85EBCA6B + 2 * size)
            counts += np.bincount(gram[: _CHUNK + 1 - size if at + _CHUNK < len(raw) else None] >> shift, minlength=FEATURES)
            if not len(gram):
                break
    counts = np.sqrt(counts)
    return (counts / np.sqrt((counts * counts).sum())).astype(np.float32)


def codewords(languages: int) -> np.ndarray:
    """A row of +1 and -1 for each language: of many random codes, that with the most distant rows."""
    if languages < 2:
        return np.ones((languages, 1))
    bits = max(7, int(np.ceil(6 * np.log2(languages))) | 1)
    best, widest = None, -1
    rng = np.random.default_rng(8)
    for _ in range(300):
        code = rng.choice([-1.0, 1.0], (languages, bits))
        if (np.abs(code.sum(axis=0)) == languages).any():  # a bit that tells nothing
            continue
        apart = (bits - code @ code.T) / 2 + np.eye(languages) * bits
        if apart.min() > widest:
            best, widest = code, apart.min()
    if best is None:
        best = np.array([[1.0 if i >> b & 1 else -1.0 for b in range(bits)] for i in range(languages)])
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    bit_weights: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        vector = features(text) if text else None
        if vector is None or not self.languages:
            return UNKNOWN, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        bits = vector @ self.weights + self.bias
        loss = (self.bit_weights * np.logaddexp(0, -self.code * bits)).sum(axis=1)
        order = np.argsort(loss, kind="stable")
        chances = np.exp(len(bits) * (loss[order[0]] - loss))
        score = float(1 / chances.sum())
        return self.languages[order[0]], score, bool(loss[order[1]] - loss[order[0]] < MARGIN)


def fitted(vectors: np.ndarray, names: list[str], rounds: int = 120, decay: float = 1e-5) -> Model:
    """Fits all bits together by accelerated gradient steps on the logistic loss."""
    languages = sorted(set(names))
    code = codewords(len(languages))
    place = np.searchsorted(languages, names) if names else np.empty(0, np.int64)
    if len(languages) < 2:
        return Model(languages, code, code, np.zeros((FEATURES, 1), np.float32), np.zeros(1, np.float32))
    wanted = code[place].astype(np.float32)
    weights, bias = np.zeros((FEATURES, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    ahead, ahead_bias = weights, bias
    for step in range(1, rounds + 1):
        pull = wanted / (1 + np.exp(np.clip(wanted * (vectors @ ahead + ahead_bias), -60, 60))) / len(vectors)
        new, new_bias = ahead + 3 * (vectors.T @ pull - decay * ahead), ahead_bias + pull.sum(axis=0)
        momentum = (step - 1) / (step + 2)
        ahead, ahead_bias = new + momentum * (new - weights), new_bias + momentum * (new_bias - bias)
        weights, bias = new, new_bias
    right = (np.sign(vectors @ weights + bias) == wanted).astype(float)
    learned = np.stack([right[place == i].mean(axis=0) for i in range(len(languages))]) + 1e-9
    return Model(languages, code, learned / learned.sum(axis=1, keepdims=True), weights, bias)


def train(documents: DataFrame) -> Model:
    """Fits on a sample of ``documents`` (doc_id, text, lang)."""
    labelled = documents.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    labelled = labelled.where(~held_out(F.col("doc_id")))
    counts = {row["lang"]: row["n"] for row in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return fitted(np.empty((0, FEATURES), np.float32), [])
    each = max(1, TRAIN_ROWS // len(counts))
    parts = 1 << 20
    deal = F.pmod(F.xxhash64(F.lit(8), "doc_id"), F.lit(parts))
    shares = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, int(min(1, 1.3 * each / n + 20 / n) * parts) + 1)])
    sample = labelled.withColumn("deal", deal).where(F.col("deal") < F.element_at(shares, F.col("lang")))
    first = Window.partitionBy("lang").orderBy("deal", "doc_id", F.xxhash64("text"))
    sample = sample.withColumn("turn", F.row_number().over(first)).where(F.col("turn") <= each)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, rows = [], []
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
                vector = features(text.as_py() or "")
                if vector is not None:
                    names.append(lang)
                    rows.append(vector.astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(rows, pa.binary())], names=["lang", "vector"])

    rows = sample.select("lang", "text").mapInArrow(vectors, "lang string, vector binary").collect()
    rows.sort(key=lambda row: (row["lang"], bytes(row["vector"])))
    table = np.array([np.frombuffer(row["vector"], np.float16) for row in rows], dtype=np.float32).reshape(-1, FEATURES)
    return fitted(table, [row["lang"] for row in rows])


PREDICTED = ("lang_pred", "score", "ambiguous")


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with lang_pred, score and ambiguous; columns of these names are replaced."""
    kept = documents.select(*[f"`{name}`" for name in documents.columns if name.lower() not in PREDICTED])
    schema = StructType(list(kept.schema.fields)).add("lang_pred", StringType()).add("score", DoubleType()).add("ambiguous", BooleanType())

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(text.as_py()) for text in batch["text"]]
            columns = [pa.array(values, kind) for values, kind in zip(zip(*found, strict=True) if found else [[]] * 3, (pa.string(), pa.float64(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *PREDICTED])

    return kept.mapInArrow(predict, schema)


def language_report(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, ambiguous."""
    found = identify(documents.select("doc_id", "text"), train(documents))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *PREDICTED)


def known_language(documents: DataFrame) -> DataFrame:
    """The rows whose language is found without ambiguity, with all their columns."""
    clash = [name for name in documents.columns if name.lower() in PREDICTED]
    model = train(documents)
    if clash:
        free = unused("own", documents.columns)
        renamed = documents.withColumnsRenamed({name: f"{free}_{name}" for name in clash})
        return known_language_of(renamed, model).withColumnsRenamed({f"{free}_{name}": name for name in clash})
    return known_language_of(documents, model)


def known_language_of(documents: DataFrame, model: Model) -> DataFrame:
    found = identify(documents, model)
    return found.where((F.col("lang_pred") != UNKNOWN) & ~F.col("ambiguous")).drop(*PREDICTED)
