"""Toxicity scores from a convolutional net that is trained on a bounded sample of labelled texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.convnet import ConvNet, Scorer, word_ids
from tablecraft.llm.textual import held_out, octets

#: Labelled rows that the net is trained on at most, and their words in all; one row in five calibrates the thresholds.
SAMPLE_ROWS, SAMPLE_WORDS = 8_000, 8_000_000
FOLDS = 5
BUCKETS = 1 << 14


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(place, ids, label) of a bounded sample of labelled texts outside of the held-out fold, as word numbers.

    The sample is the rows with the smallest hash of the id. Only their ids, of which there are as many as
    the bound says, are broadcast; each text is turned into numbers where it lies.
    """
    known = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key, FOLDS))
             .groupBy(F.col(key).alias("label_id")).agg(F.max(label).cast("int").alias("label"))
             .orderBy(F.xxhash64("label_id"), "label_id").limit(rows))

    @F.pandas_udf("binary")
    def numbers(batch: pd.Series) -> pd.Series:
        return batch.map(lambda t: word_ids(t, BUCKETS).tobytes())

    texts = docs.select(F.col(key).alias("id"), octets(text).alias("text"))
    met = texts.join(F.broadcast(known), F.col("id") == F.col("label_id"))
    return (met.select(F.xxhash64("id").alias("place"), F.xxhash64("text").alias("tie"), numbers("text").alias("ids"), "label")
            .orderBy("place", "tie").limit(rows).select("place", "ids", "label"))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Scorer | float:
    """The scorer; a constant if the labels name one class or none (0 if none)."""
    rows = training_rows(docs, labels, key, text, label).toPandas()
    ids = [np.frombuffer(b, dtype=np.uint16).reshape(-1, 2) for b in rows["ids"]]
    fits = max(int(np.searchsorted(np.cumsum([len(i) for i in ids]), SAMPLE_WORDS)), 1)
    ids, truth, place = ids[:fits], rows["label"].to_numpy()[:fits] > 0, rows["place"].to_numpy()[:fits]
    if not len(ids) or truth.all() or not truth.any():
        return float(len(ids) > 0 and truth.all())
    spare = place % 5 == 0
    if len(np.unique(truth[~spare])) < 2 or spare.sum() < 20:
        spare = np.zeros(len(ids), dtype=bool)
    pick = lambda mask: ([ids[i] for i in np.flatnonzero(mask)], truth[mask].astype(np.int64))
    net = ConvNet(BUCKETS).fit(*pick(~spare))
    return net.frozen().calibrate(*pick(spare if spare.any() else ~spare))


def toxicity(model: Scorer | float, text: str) -> Column:
    """Score of a text column between 0 and 1; from 0.5 the text is held toxic. Only the text is looked at."""

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            if isinstance(model, float):
                yield pd.Series(np.full(len(batch), model))
            else:
                yield pd.Series(model.scores([word_ids(t, BUCKETS) for t in batch]))

    return of(octets(text))


def score_texts(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """Per row: key, held_out, score, predicted.

    The text's language, which decides on its threshold, is told from its words. A missing text is scored as
    an empty one, and gets the score of a text without any known sign. Repeated rows get equal scores; a
    row without id is scored but never trained on; labels that are missing are no labels, and of several for one id the largest counts.
    """
    score = toxicity(train(docs, labels, key, text, label), text)
    return docs.select(F.col(key), held_out(key, FOLDS).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """The documents that are not held toxic, with all their columns."""
    return docs.where(toxicity(train(docs, labels, key, text, label), text) < 0.5)
