"""Rows with a key not met before, from a stream, by state that expires."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


#: Keys go to so many groups by their hash, each with one state. It is part of a checkpoint's meaning, so it stays.
GROUPS = 1 << 14


def first_of_keys(stream: DataFrame, key: str, time: str, order: list[str], delay: str, keep_ms: int) -> DataFrame:
    """Of each key the first row that arrives; of rows in one micro-batch the least by ``order``.

    ``time`` is the rows' event time, a timestamp. Rows later than ``delay`` behind the newest are left out. A key is
    remembered until ``keep_ms`` after the newest of its rows have passed the watermark; a row that comes
    after that counts as new. So the state holds the keys of the recent past only, not those of the
    whole table, and it is part of the stream's checkpoint: a restart goes on with it. A NULL key is a key.

    A call of Python takes far longer than a row, so keys are taken in groups by their hash. A group's state holds its
    keys and their times. Its rows are read in pieces, and one row of each key is held.
    """
    schema, text, group = stream.schema, "_key", "_group"
    state = T.StructType.fromDDL("keys array<string>, untils array<bigint>")

    def first(_: tuple, rows: Iterator[pd.DataFrame], known: GroupState) -> Iterator[pd.DataFrame]:
        watermark = known.getCurrentWatermarkMs()
        untils = dict(zip(*known.get)) if known.exists else {}
        before, best, pieces = set(untils), {}, []
        for some in rows if not known.hasTimedOut else ():
            keys, least = some[text].tolist(), {}
            times = some[time].to_numpy("datetime64[ms]").astype("int64").tolist()
            ranks = zip(*[[(v is None or v != v, v) for v in some[c].tolist()] for c in order])
            for i, (k, at, rank) in enumerate(zip(keys, times, ranks)):
                untils[k] = max(max(at, 0) + keep_ms, watermark + 1, untils.get(k, 0))
                if k not in before and (k not in best or rank < best[k]):
                    best[k], least[k] = rank, i
            if least:
                pieces.append(some.iloc[[*least.values()]])
        if pieces:
            found = pieces[0] if len(pieces) == 1 else pd.concat(pieces).drop_duplicates(text, keep="last")
            yield found[schema.names]
        # Keys whose time the watermark has passed: those of this micro-batch's rows have got a new one.
        untils = {k: until for k, until in untils.items() if until >= watermark}
        if not untils:
            known.remove()
            return
        known.update(([*untils], [*untils.values()]))
        known.setTimeoutTimestamp(max(min(untils.values()), watermark + 1))

    timed = stream.withWatermark(time, delay)
    grouped = timed.withColumns({text: F.col(key).cast("string"), group: F.pmod(F.xxhash64(key), F.lit(GROUPS))})
    return grouped.groupBy(group).applyInPandasWithState(first, schema, state, "append", GroupStateTimeout.EventTimeTimeout)
