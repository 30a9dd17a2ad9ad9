"""K1 keyed upsert (also K3, K7, K8, K10, K11): the newest row per key wins.

The existing table is never shuffled for a small batch: it is anti-joined
against the batch keys, which AQE turns into a broadcast hash join when the
measured batch is small and a sort-merge join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tideline.operators.rank import last_per_key
from tideline.session import keep


def keyed_upsert(existing: DataFrame, updates: DataFrame, keys, order=None) -> DataFrame:
    """Rows of ``existing`` whose key is not in ``updates``, plus ``updates``.

    ``updates`` may hold a key more than once: the last row by ``order`` wins (a
    bulk write applies actions in order), or without an order the largest by its
    other columns.  The result has one row per key when ``existing`` has, which
    holds when it was written by this function.  The updates are evaluated once and
    kept, because both the anti join and the union read them.
    """
    keys = list(keys)
    latest = keep(last_per_key(updates, keys, order or [c for c in existing.columns if c not in keys]))
    kept = existing.join(latest.select(*keys), keys, "left_anti")
    return kept.unionByName(latest.select(*existing.columns))
