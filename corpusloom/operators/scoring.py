"""Running a user's model over a table, in batches, inside the tasks."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Scorer = Callable[[Sequence[str]], Sequence[str]]


def score_table(
    df: DataFrame,
    text: str,
    scorer_factory: Callable[[], Scorer],
    batch_size: int = 32,
    output: str = "generated_response",
) -> DataFrame:
    """Add the generated text, the error of its batch if any, and its latency.

    Every request waits for its whole batch, so ``latency_ms`` is the time of the batch.

    The model is built once per Python worker.  A batch that raises yields empty texts and
    the error message, and the job goes on.  Works on streaming tables too.
    """
    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField(output, T.StringType()),
            T.StructField("score_error", T.StringType()),
            T.StructField("latency_ms", T.DoubleType()),
        ]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = scorer_factory()
        for rows in batches:
            for first in range(0, len(rows), batch_size):
                batch = rows.iloc[first : first + batch_size].copy()
                begun = time.monotonic()
                try:
                    texts, error = list(scorer(list(batch[text]))), None
                    if len(texts) != len(batch):
                        raise ValueError(f"{len(texts)} results for {len(batch)} texts")
                except Exception as failure:  # noqa: BLE001 - the job must go on
                    texts, error = [""] * len(batch), str(failure)
                spent = (time.monotonic() - begun) * 1000
                batch[output] = texts
                batch["score_error"] = error
                batch["latency_ms"] = round(spent, 1)
                yield batch

    return df.mapInPandas(run, schema)
