"""Quality by compression: how much better a text shrinks with a dictionary of good or of bad text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attriflux.llm.shared import text_column

SAMPLE_DOCS = 1500          # labelled documents of each label that are used, those with the smallest id hashes
SAMPLE_BLOCKS = 16          # blocks of a document that go into a dictionary, spread evenly over all of it
DICTIONARY_BYTES = 65536
BLOCK_BYTES = 1024          # texts are compressed in blocks, so that a long one does not become its own dictionary
LEVEL = 3
THRESHOLD = 0.3


def held_out(doc_id: Column) -> Column:
    """Every fifth id by its checksum: labels of these rows are never learnt."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


@dataclass(frozen=True)
class CompressionModel:
    """Dictionaries of both labels, and the calibration from the sizes to a score: weights, then the offset."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    center: tuple[float, ...]
    scale: tuple[float, ...]

    def scores(self, values: np.ndarray) -> np.ndarray:
        x = (values.reshape(-1, 3) - np.array(self.center)) / np.array(self.scale)
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights[:-1]) + self.weights[-1], -30, 30)))


def dictionary(texts: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary of the texts. Texts too few to train one are used as they are.

    Of a text with more than ``SAMPLE_BLOCKS`` blocks as many are taken, from
    its begin to its end, so that long texts do not outweigh all others.
    """
    blocks = []
    for t in texts:
        n = -(-len(t) // BLOCK_BYTES)
        places = range(n) if n <= SAMPLE_BLOCKS else np.linspace(0, n - 1, SAMPLE_BLOCKS).round().astype(int).tolist()
        blocks += [t[i * BLOCK_BYTES:(i + 1) * BLOCK_BYTES] for i in places]
    try:
        return zstandard.train_dictionary(size, blocks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[:size] or b"\n"


class Sizes:
    """What a text's compressed sizes with both dictionaries tell.

    Their difference as a share of their sum (-1 to 1), and the smaller size
    against the text's own, also as a logarithm: text that repeats itself
    shrinks far with either.
    """

    def __init__(self, good: bytes, bad: bytes):
        self.compressors = [
            zstandard.ZstdCompressor(level=LEVEL, dict_data=self._load(d), write_checksum=False, write_content_size=False,
                                     write_dict_id=False) for d in (good, bad)]

    @staticmethod
    def _load(data: bytes) -> zstandard.ZstdCompressionDict:
        trained = data[:4] == b"\x37\xa4\x30\xec"        # magic number of trained dictionaries
        loaded = zstandard.ZstdCompressionDict(
            data, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)
        loaded.precompute_compress(level=LEVEL)
        return loaded

    def __call__(self, text: bytes) -> tuple[float, float, float]:
        blocks = [text[i:i + BLOCK_BYTES] for i in range(0, len(text), BLOCK_BYTES)]
        good, bad = (sum(len(c.compress(b)) for b in blocks) for c in self.compressors)
        if not blocks:
            return 0.0, 1.0, 0.0
        left = min(good, bad) / len(text)
        return (bad - good) / (bad + good), left, float(np.log(left))


def calibrate(x: np.ndarray, labels: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights and offset of a logistic curve through the labels (Newton steps, a little shrinkage)."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (labels - p) - 1e-2 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return w


def train_compression_model(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS,
                            id_column: str = "doc_id", text: str = "text") -> CompressionModel | None:
    """Dictionaries from one half of a bounded sample of labelled rows, the calibration from the other half.

    The sample has up to ``sample_docs`` documents of each label, whole texts, one
    row of each id, none of them held out. None if a label is missing.
    """
    known = labels.filter(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    sample = known.filter("quality > 0").orderBy(*order).limit(sample_docs).unionByName(
        known.filter("quality <= 0").orderBy(*order).limit(sample_docs))
    texts = docs.select(F.col(id_column).alias("doc_id"), text_column(text).alias("text"))
    texts = texts.join(F.broadcast(sample), "doc_id")           # at most twice sample_docs ids
    texts = texts.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.min("quality").alias("quality"))
    texts = texts.select(F.xxhash64("doc_id").alias("draw"), (F.col("quality") > 0).alias("good"), F.col("text").cast("binary").alias("text"))
    rows = sorted((r.draw, r.good, bytes(r.text)) for r in texts.collect())      # at most twice sample_docs
    found = [[t for _, is_good, t in rows if is_good == kind] for kind in (True, False)]
    if not all(found):
        return None
    good, bad = (dictionary(texts[0::2]) for texts in found)
    sizes = Sizes(good, bad)
    rest = [texts[1::2] or texts for texts in found]
    values = np.array([sizes(t) for texts in rest for t in texts])
    marks = np.array([1.0] * len(rest[0]) + [0.0] * len(rest[1]))
    center, scale = values.mean(axis=0), np.maximum(values.std(axis=0), 1e-9)
    weights = calibrate((values - center) / scale, marks)
    return CompressionModel(good, bad, *(tuple(map(float, v)) for v in (weights, center, scale)))


def score_quality(docs: DataFrame, model: CompressionModel | None, threshold: float = THRESHOLD,
                  id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row, from its whole text.

    Null texts score like empty ones, whose sizes do not differ. Without a
    model every score is 0.5. Repeated rows and null ids give a row each. Only
    the id and the text are read, so further columns cannot clash. An empty
    table gives no rows.
    """
    kept = docs.select(F.col(id_column).alias("doc_id"), held_out(F.col(id_column)).alias("held_out"),
                       text_column(text).cast("binary").alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model.good, model.bad) if model else None
        for batch in batches:
            if sizes:
                scores = model.scores(np.array([sizes(t.as_py()) for t in batch.column("text")], float))
            else:
                scores = np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores),
                 pa.array((scores >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return kept.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")
