"""Operator 8: language identification by averaged hashed subword embeddings with a linear softmax.

The model (see subword) is fitted on the driver from a bounded sample of labelled documents of the fitting folds, calibrated
by a temperature and a rejection score, folded into a table of fixed size and broadcast. Every text is scored whole.

Defined cases: a null text, an empty text and a text without a letter get ``und``, score 0 and a rejection; a text whose words
are all unknown is scored by the bias; without labelled rows every text is ``und``; repeated rows give repeated results; other
columns are ignored; a text of any length is scored whole, by one task; an empty table gives an empty table.
"""

from __future__ import annotations

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts
from .folds import held_out, labelled_texts
from .subword import Model, Scorer, Shape, train

SHAPE = Shape(bits=16, dim=8, grams=(2, 4), lower=True, letters=True, epochs=5)
#: Labelled documents that a model is fitted on at most, and their size at most.
FIT_ROWS, FIT_BYTES = 4000, 32_768
UNKNOWN = "und"


def fit(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", shape: Shape = SHAPE, most: int = FIT_ROWS) -> Model | None:
    texts, langs = labelled_texts(docs, docs, F.col(f"`{lang_col}`"), most, FIT_BYTES, id_col, text_col)
    return train(texts, langs, shape) if texts else None


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, held_out, lang_pred, score (calibrated probability) and rejected (score below the model's rejection score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(F.col(f"`{id_col}`").alias("__id"), held_out(id_col).alias("held_out"), F.col(f"`{text_col}`").alias("__text"))

    def make():
        scorer = Scorer(shared.value) if shared.value else None
        letter = regex.compile(r"\p{L}").search

        def of(texts: list[str]) -> dict[str, pa.Array]:
            lang, score, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
            if scorer:
                p = scorer.probabilities(texts)
                for i, (best, k) in enumerate(zip(p.max(axis=1), p.argmax(axis=1))):
                    if letter(texts[i]):
                        lang[i], score[i], rejected[i] = scorer.model.classes[k], float(best), bool(best < scorer.model.reject)
            return {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64()), "rejected": pa.array(rejected, pa.bool_())}

        return of

    return map_texts(docs, ["__id", "held_out"], "__text", "lang_pred string, score double, rejected boolean", make).withColumnRenamed("__id", id_col)
