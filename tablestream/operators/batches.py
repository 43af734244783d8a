"""Groups in a sorted stream of pandas batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd


def group_slices(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[tuple[tuple, pd.DataFrame, bool]]:
    """Cut sorted batches where the key changes: (key, rows, starts a new group). A group may span batches."""
    last = object()
    for pdf in batches:
        if not len(pdf):
            continue
        cols = [pdf[c].astype(object).where(pdf[c].notna(), None).tolist() for c in keys]
        ids = list(zip(*cols))
        start = 0
        for i in range(1, len(ids) + 1):
            if i == len(ids) or ids[i] != ids[start]:
                yield ids[start], pdf.iloc[start:i], ids[start] != last
                last, start = ids[start], i
