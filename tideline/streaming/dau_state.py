"""T1, exact stateful form: first arrival per (day, device) with a 7-day TTL.

``transformWithStateInPandas`` keeps one boolean per (dt, mid) in the state
store with a processing-time TTL; every event of the key re-arms it (the
reference re-arms on every event, duplicates included).  Within a micro-batch
the least (ts, offset, partition) row is emitted, so the surviving row is
defined, unlike ``dropDuplicatesWithinWatermark``.  Rows of one key arrive as
Arrow-sized pandas chunks; only the running minimum is kept, so a hot key
never has to fit in memory.  Requires the RocksDB state store provider.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tideline.functions import schemas as S
from tideline.operators import dau

SEEN_TTL_MS = 7 * 24 * 3600 * 1000  # fixed value: the reference's 7-day key expiry
ORDER = ["ts", "offset", "partition"]


class FirstLaunch(StatefulProcessor):
    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean", SEEN_TTL_MS)

    def handleInputRows(self, key, rows, timerValues):
        best = None
        for pdf in rows:
            top = pdf.sort_values(ORDER, kind="mergesort").head(1)
            if best is None or tuple(top[ORDER].iloc[0]) < tuple(best[ORDER].iloc[0]):
                best = top
        already = self.seen.exists()
        self.seen.update((True,))  # re-arms the TTL
        if best is not None and not already:
            yield best[dau.DAU_COLUMNS]

    def close(self) -> None:
        pass


def dau_ttl_stream(msgs: DataFrame) -> DataFrame:
    rows, _ = dau.start_rows(msgs)
    keep = rows.select(*dau.DAU_COLUMNS, "offset", "partition")
    return keep.groupBy(*dau.DAU_KEY).transformWithStateInPandas(
        statefulProcessor=FirstLaunch(), outputStructType=S.DAU_INFO,
        outputMode="Append", timeMode="ProcessingTime")
