"""Quality by compression: zstandard dictionaries of good and of bad labelled text.

A text is cut into chunks that are each compressed with either dictionary, so
the dictionaries matter for long texts as for short ones.  The difference of the
two sums, over the sum of both, is the raw score; a logistic line fitted on
labelled rows that built no dictionary turns it into a probability.

Cases: null and empty texts have raw score 0.  Without labels of both classes
every score is the share of label 1.  Every row gives one row, repeated ones too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.labelled import fold, labelled_sample, logistic, probability, with_scores

CHUNK = 1024
DICTIONARY = 64 * 1024
LEVEL = 3


def chunks(text: str | None) -> list[bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return [raw[i : i + CHUNK] for i in range(0, len(raw), CHUNK)]


def dictionary(texts: list[str], size: int = DICTIONARY) -> bytes:
    """A trained dictionary; a raw-content one where the texts are too few to train on."""
    samples = [c for t in texts for c in chunks(t)]
    size = min(size, max(256, sum(map(len, samples)) // 8))
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:] or b" " * 8


def compressors(good: bytes, bad: bytes) -> list[zstandard.ZstdCompressor]:
    def one(d: bytes) -> zstandard.ZstdCompressor:
        data = zstandard.ZstdCompressionDict(d)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)

    return [one(good), one(bad)]


def difference(text: str | None, pair: list[zstandard.ZstdCompressor]) -> float:
    """Normalised compressed-size difference: above 0 if the good dictionary fits better."""
    good, bad = (sum(len(c.compress(x)) for x in chunks(text)) for c in pair)
    return (bad - good) / (bad + good) if good + bad else 0.0


def train(sample: pd.DataFrame, share: float) -> dict:
    """Dictionaries from four fifths of the sample, the calibration from the rest."""
    rest = np.arange(len(sample)) % 5 == 0
    build = sample[~rest] if len(sample) >= 20 else sample
    good, bad = (dictionary(build.loc[build["y"] == y, "text"].tolist()) for y in (1, 0))
    check = sample[rest] if sample.loc[rest, "y"].nunique() == 2 else sample
    pair = compressors(good, bad)
    x = np.array([difference(t, pair) for t in check["text"]])
    return {"good": good, "bad": bad, "line": logistic(x, check["y"].to_numpy(int), share)}


def score_quality(docs: DataFrame, labelled: DataFrame, labels: DataFrame, folds: int = 3, held_fold: int = 1) -> DataFrame:
    """``docs`` with held_out, score and predicted; rows of fold ``held_fold`` are never learned from."""
    sample, share = labelled_sample(labelled, labels, "quality", fold(F.col("doc_id"), folds) != held_fold)
    shared = docs.sparkSession.sparkContext.broadcast(train(sample, share))  # two dictionaries of DICTIONARY bytes

    @F.pandas_udf("double")
    def quality(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        pair = compressors(model["good"], model["bad"])
        for texts in parts:
            yield pd.Series(probability(np.array([difference(t, pair) for t in texts]), *model["line"]))

    return with_scores(docs, fold(F.col("doc_id"), folds) == held_fold, quality(F.col("text")))
