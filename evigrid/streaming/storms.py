"""Failure storms over a stream of fetch failures: a small state per domain, one row per intervention."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .domains import _Batch

OUTPUT = "domain string, action string, reason string, event_id long, failures int"


def _observe(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    counts = dict(zip(*state.get, strict=True)) if state.exists else {}
    found, batch = [], _Batch(0)
    for part in parts:
        places, prefixes = part["ts"].astype("int64"), (None if p == "/" else p for p in part["prefix"])
        batch.add((*fetch, "", None) for fetch in zip(places, part["event_id"], part["kind"], prefixes))
    for by, named in (("kind", batch.kinds), ("prefix", batch.prefixes)):
        for name, new in named.items():
            before = counts.get(f"{by} {name}", 0)
            counts[f"{by} {name}"] = before + new.n
            storm = batch.crossed(by, name, before)
            if storm is not None:
                action, reason, _, event_id, limit = storm
                found.append((key[0], action, reason, event_id, limit))
    state.update((list(counts), list(counts.values())))
    yield pd.DataFrame(found, columns=["domain", "action", "reason", "event_id", "failures"])


def storm_stream(failures: DataFrame) -> DataFrame:
    """Interventions of a stream with ``domain``, ``ts``, ``event_id``, ``kind``, ``prefix``.

    State is one counter per kind and path prefix of a domain; a failure after the limit gives no
    further row. Successes don't reset the counts.
    """
    return failures.groupBy("domain").applyInPandasWithState(
        _observe, OUTPUT, "names array<string>, counts array<int>", "append", GroupStateTimeout.NoTimeout
    )
