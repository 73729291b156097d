"""Quality by compression: zstandard dictionaries of good and of bad labelled text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm import fit
from fundlens.llm.common import held_out, materialise

#: Labelled rows of each class used at all, and those of them whose text makes the dictionary.
PER_CLASS = 4000
DICTIONARY_DOCS = 1200
DICTIONARY_BYTES = 112 * 1024
#: A text is compressed in blocks, so that the dictionaries weigh as much in long texts as in short ones.
BLOCK = 2048
LEVEL = 3
FEATURES = 4


def train_dictionary(texts: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the raw text where there is too little of it to train on."""
    samples = [t[i:i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class Compressors:
    """Compressed sizes of a text under the good and the bad dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self._good, self._bad = (self._with(d) for d in (good, bad))

    @staticmethod
    def _with(data: bytes):
        if not data:
            return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        d = zstandard.ZstdCompressionDict(data)
        d.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False)

    def features(self, text: bytes) -> list[float]:
        """Size difference and mean size by length, for the whole text and its most one-sided blocks."""
        if not text:
            return [0.0] * FEATURES
        good, bad = self._good.compress, self._bad.compress
        sizes = np.array([(len(good(p)), len(bad(p)), len(p)) for i in range(0, len(text), BLOCK) for p in [text[i:i + BLOCK]]], float)
        g, b, n = sizes.sum(0)
        each = (sizes[:, 1] - sizes[:, 0]) / np.maximum(sizes[:, 2], 256)
        return [10 * (b - g) / n, (b + g) / (2 * n), 10 * float(each.min()), 100 * (b - g) / n / np.sqrt(n)]


def quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, dictionary_docs: int = DICTIONARY_DOCS,
            threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher is better) and predicted of every whole text.

    Dictionaries and calibration use at most ``per_class`` labelled rows a class that are not
    held out: the first ``dictionary_docs`` of a class (by hash) make its dictionary, the others
    fit the calibration, so no text is judged by a dictionary it is in.  Null and empty texts
    get the calibrated score of no difference; rows with a null id are scored and not held
    out; repeated rows are scored each; without labels of both classes every score is the
    smoothed share of class 1; an empty table gives no rows.
    """
    sample, sizes = fit.labelled_sample(docs, labels, "quality", per_class, "quality", id_col, text_col)
    sample = materialise(sample.withColumn("place", F.xxhash64("doc_id")), "quality-sample")
    dictionaries, cut = {}, {}
    for y in (0, 1):
        n = sample.where(F.col("y") == y).count()
        take = min(dictionary_docs, n // 2)
        rows = sample.where(F.col("y") == y).orderBy("place", "doc_id").limit(take).select("place", "text").collect()
        cut[y] = rows[-1]["place"] if rows else None
        dictionaries[y] = train_dictionary([r["text"].encode() for r in rows]) if rows else b""
    good, bad = dictionaries[1], dictionaries[0]

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        c = Compressors(good, bad)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                yield part, np.array([c.features(t or b"") for t in part.column(1).cast(pa.binary()).to_pylist()])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in rows_of(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["y", "x"])

    rest = sample.where(F.lit(False))
    for y in (0, 1):
        one = sample.where(F.col("y") == y)
        rest = rest.unionByName(one.where(F.col("place") > cut[y]) if cut[y] is not None else one)
    seen = rest.select("y", "text").mapInArrow(measure, "y int, x array<double>").collect()
    y = np.array([r["y"] for r in seen], int)
    x = np.array([r["x"] for r in seen]).reshape(-1, FEATURES)
    beta = fit.calibrate(x, y, sizes, 0.5, 0.1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in rows_of(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fit.probability(x, beta))], names=["doc_id", "score"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(score, "doc_id long, score double")
            .select("doc_id", held_out("doc_id").alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
