"""Work on many small groups at a time inside a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def map_groups(df: DataFrame, key: str, work: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame], schema: str) -> DataFrame:
    """``work`` on frames of whole groups of ``key`` (a non-null long), with the bounds of the groups in the frame.

    Rows are dealt by ``key`` and sorted, so one call takes thousands of small groups.
    A group is held as a whole: callers bound group sizes beforehand.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            keys = batch[key].to_numpy()
            begins = np.flatnonzero(np.diff(keys)) + 1
            if held and held[-1][key].iat[-1] != keys[0]:
                yield finish(held)
                held = []
            if len(begins):
                yield finish([*held, batch.iloc[: begins[-1]]])
                held = [batch.iloc[begins[-1] :]]
            else:
                held.append(batch)
        if held:
            yield finish(held)

    def finish(parts: list[pd.DataFrame]) -> pd.DataFrame:
        whole = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0].reset_index(drop=True)
        keys = whole[key].to_numpy()
        return work(whole, np.concatenate(([0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)])))

    return df.repartition(key).sortWithinPartitions(key).mapInPandas(run, schema)
