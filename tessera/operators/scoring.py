"""Bring-your-own scorer (U1): a model loaded once per task, fed Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame

SCORE_BATCH = 32


def score_batches(df: DataFrame, scorer_factory: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
                  output_schema: str, input_cols: Sequence[str], batch_size: int = SCORE_BATCH) -> DataFrame:
    """``mapInPandas`` — ``scorer_factory()`` runs once per task (model load),
    the scorer sees pandas chunks of ``batch_size`` rows and returns rows of
    ``output_schema``.  Its output feeds ``translate_requests(model_scores=…)``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = scorer_factory()
        for pdf in batches:
            for start in range(0, len(pdf), batch_size):
                yield scorer(pdf.iloc[start:start + batch_size])

    return df.select(*input_cols).mapInPandas(run, output_schema)


def length_scorer_factory(full_words: int = 50) -> Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]:
    """A tiny stand-in model: echoes the text, confidence = min(1, words / full_words)."""

    def factory():
        def score(pdf: pd.DataFrame) -> pd.DataFrame:
            words = pdf["text"].fillna("").str.split().str.len()
            return pd.DataFrame({"request_id": pdf["request_id"].astype("int64"),
                                 "model_text": pdf["text"].fillna(""),
                                 "model_confidence": (words / float(full_words)).clip(upper=1.0).astype("float64")})
        return score

    return factory
