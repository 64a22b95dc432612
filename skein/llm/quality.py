"""Operator 10: quality classifier by supervised subword embeddings.

Vectors of hashed words, word pairs and character n-grams are averaged per document and fed to a softmax (see subword). The model
is fitted on the driver from a bounded sample of labelled documents of the fitting folds, folded into a table of fixed size and
broadcast. Every text is scored whole; nothing but the text enters a score.

Defined cases: a null text is an empty text, and an empty text is scored by the bias (the share of good labels); without labels,
or with one label only, the score is that label's smoothed share; an id with several labels counts with the least; repeated rows
give repeated results; other columns are ignored (accepted keeps them, whatever their names); a text of any length is scored whole,
by one task; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, map_texts
from .folds import held_out, labelled_texts
from .subword import Model, Scorer, Shape, train

SHAPE = Shape(bits=16, dim=8, grams=(2, 4), pairs=True, epochs=6)
FIT_ROWS, FIT_BYTES = 4000, 32_768
#: Scores from here on are predicted good.
ACCEPT = 0.3


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    shape: Shape = SHAPE,
    most: int = FIT_ROWS,
) -> Model:
    """A model of the classes 0 and 1 of labels.label_col."""
    texts, y = labelled_texts(docs, labels, F.col(f"`{label_col}`").cast("int"), most, FIT_BYTES, id_col, text_col)
    if len(set(y)) < 2:
        good = (sum(y) + 1) / (len(y) + 2)
        none = np.zeros((1 << shape.bits << int(shape.pairs), 2), np.float32)
        return Model(shape, [0, 1], none, np.log([1 - good, good]))
    return train(texts, y, shape)


def score(docs: DataFrame, model: Model, accept: float = ACCEPT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, held_out, score (probability of label 1) and predicted (1 if score >= accept, else 0)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(F.col(f"`{id_col}`").alias("__id"), held_out(id_col).alias("held_out"), F.col(f"`{text_col}`").alias("__text"))

    def make():
        scorer = Scorer(shared.value)
        good = scorer.model.classes.index(1)

        def of(texts: list[str]) -> dict[str, pa.Array]:
            p = scorer.probabilities(texts)[:, good]
            return {"score": pa.array(p, pa.float64()), "predicted": pa.array((p >= accept).astype(np.int32), pa.int32())}

        return of

    return map_texts(docs, ["__id", "held_out"], "__text", "score double, predicted int", make).withColumnRenamed("__id", id_col)


def accepted(docs: DataFrame, model: Model, accept: float = ACCEPT, text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whose text scores at least ``accept``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names, (keep,) = docs.columns, fresh(docs.columns, "keep")

    def make():
        scorer = Scorer(shared.value)
        good = scorer.model.classes.index(1)
        return lambda texts: {keep: pa.array(scorer.probabilities(texts)[:, good] >= accept, pa.bool_())}

    marked = map_texts(docs, names, text_col, f"{keep} boolean", make)
    return marked.where(keep).select(*[F.col(f"`{c}`") for c in names])
