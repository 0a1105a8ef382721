"""Next-fit packing of samples as they arrive: one open bin per group is the state; full bins are emitted."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.packing import CAPACITY

OUT = "grp string, bin long, n_samples long, n_tokens long"


def stream_bins(samples: DataFrame, group: str = "grp", order: str = "pos", length: str = "n", capacity: int = CAPACITY) -> DataFrame:
    """(grp, bin, n_samples, n_tokens) of each bin once it is closed, in append mode.

    Within a micro-batch a group's samples are taken in ``order``; across batches in order of arrival.  What is
    still open when the stream ends stays in the state, like the dropped tail of the batch form.
    """

    def step(key: tuple, parts: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        bin_, used, n = state.get if state.exists else (0, 0, 0)
        closed = []
        rows = pd.concat(list(parts)).sort_values(order)
        for size in rows[length].fillna(0).astype("int64"):
            if used + size > capacity and n > 0:
                closed.append((key[0], bin_, n, used))
                bin_, used, n = bin_ + 1, 0, 0
            if size < capacity:
                used, n = used + int(size), n + 1
        state.update((bin_, used, n))
        yield pd.DataFrame(closed, columns=["grp", "bin", "n_samples", "n_tokens"])

    grouped = samples.groupBy(group)
    return grouped.applyInPandasWithState(step, OUT, "bin long, used long, n long", "append", GroupStateTimeout.NoTimeout)
