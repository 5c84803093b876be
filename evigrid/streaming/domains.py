"""The state of a crawl's domains over a stream of fetches, and the batch plan that gives the same rows.

A fetch has ``domain``, ``at``, ``event_id``, ``kind`` (null where a page came), ``prefix``,
``error``, ``escalation`` (why a browser is wanted, else null) and ``browser_pages`` (what the
domain's policy still allows, 0 for none). ``fetches`` makes these columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import DataType, TimestampNTZType

from ..functions import signals
from ..operators.frontier import PREFIX_STORM_LIMIT, STORM_LIMITS, path_prefix, storms

# What reaching the limit of a kind does, and how much of an error's text is kept.
ACTIONS = {"dns": "auto_quarantine_seed", "blocked": "auto_stop_domain", "not_found": "auto_disable_discovery"}
REASONS = {"dns": "dns_failure", "blocked": "blocked_storm", "not_found": "not_found_storm"}
ERROR_LENGTH = 240

OUTPUT = "domain string, action string, reason string, detail string, event_id long, failures long, pages long"
ROW = Row(*(column.split()[0] for column in OUTPUT.split(", ")))
LEAST = -(1 << 63)  # stands for a null place or id: nulls come first, as in the batch plan
PACKED = {"place": "long", "event_id": "long", "kind": "string", "prefix": "string", "note": "string", "wanted": "string"}
AT_ONCE, PACK_BYTES = 128, 32 << 20  # fetches in a list at most, and bytes of rows that are packed at a time
NEAR = 32  # prefixes that a domain's state holds with its other counts
INTERVENTIONS = ("domain", "action", "reason", "detail", "event_id", "failures")
ORDER = ["at", "event_id"]
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def fetches(rows: DataFrame, domain: Column, at: Column, event_id: Column, url: Column, status: Column, error: Column, came: Column, mode: Column, on_block: Column, browser_pages: Column) -> DataFrame:
    """Fetches with the columns of this module; a browser is wanted where a domain blocks, and allowed where its policy doesn't say otherwise."""
    kind = F.when(~came, signals.failure_kind(status, error))
    allowed = (F.coalesce(mode, F.lit("auto")) != "http_only") & F.coalesce(on_block, F.lit(False))
    return rows.select(
        domain.alias("domain"), at.alias("at"), event_id.cast("long").alias("event_id"), kind.alias("kind"), path_prefix(url).alias("prefix"), F.coalesce(error, F.lit("")).alias("error"),
        F.when(kind == "blocked", F.concat(F.lit("status:"), status.cast("string"))).alias("escalation"), F.when(allowed, F.coalesce(browser_pages, F.lit(0))).otherwise(0).cast("int").alias("browser_pages"),
    )


class _First:
    """How many fetches came, and the first few of them in order, never all."""

    def __init__(self, most: int):
        self.most, self.n, self.held = most, 0, []

    def add(self, fetch: tuple) -> None:
        self.n += 1
        if self.most:
            self.held.append(fetch)
            if len(self.held) > 4 * self.most + 16:
                self.first()

    def first(self) -> list[tuple]:
        self.held.sort()
        del self.held[self.most :]
        return self.held


class _Batch:
    """What a micro-batch says about one domain, fetch by fetch: totals by name and the first few fetches of each."""

    def __init__(self, pages_left: int):
        self.pages, self.pages_left = _First(max(pages_left, 0)), pages_left
        self.kinds: dict[str, _First] = {}
        self.prefixes: dict[str, _First] = {}
        self.last = self.block = None

    def add(self, fetches: Iterable[tuple]) -> None:
        """Fetches as place, id, kind (none: a page), prefix (none: not counted), note and why a browser is wanted."""
        for place, event_id, kind, prefix, note, wanted in fetches:
            if self.last is None or (place, event_id, note) > self.last:
                self.last = place, event_id, note
            if kind is None:
                self.pages.add((place, event_id))
                continue
            if kind not in self.kinds:
                self.kinds[kind] = _First(STORM_LIMITS.get(kind, 0))
            self.kinds[kind].add((place, event_id))
            if prefix is not None:
                if prefix not in self.prefixes:
                    self.prefixes[prefix] = _First(PREFIX_STORM_LIMIT)
                self.prefixes[prefix].add((place, event_id, kind))
            if wanted is not None and (self.block is None or (place, event_id, wanted) < self.block):
                self.block = place, event_id, wanted

    def failures(self) -> int:
        return sum(k.n for k in self.kinds.values())

    def crossed(self, by: str, name: str, before: int) -> tuple | None:
        """Action, reason, detail, id and limit, if this batch reaches the limit of a kind or prefix that had so many before."""
        new, limit = (self.kinds[name], STORM_LIMITS.get(name, 0)) if by == "kind" else (self.prefixes[name], PREFIX_STORM_LIMIT)
        if not before < limit <= before + new.n:
            return None
        fetch = new.first()[limit - before - 1]
        action, reason, detail = (ACTIONS[name], REASONS[name], "") if by == "kind" else ("auto_suppress_prefix", f"{fetch[2]}_storm", name)
        return action, reason, detail, _id(fetch[1]), limit

    def browser_wanted(self) -> bool:
        """Whether a browser is wanted before the pages that were left had come."""
        return self.block is not None and sum(page < self.block[:2] for page in self.pages.first()) < self.pages_left


def _id(event_id: int) -> int | None:
    return None if event_id == LEAST else event_id


class _Held(NamedTuple):
    """A domain's state, but for prefixes after the first ``NEAR``."""

    at: int | None = None
    event_id: int | None = None
    error: str | None = None
    timer: int = 0
    pages: int = 0
    failures: int = 0
    browser: bool = False
    kinds: Mapping[str, int] = {}
    prefixes: Mapping[str, int] = {}


class DomainState(StatefulProcessor):
    """Counts by kind and prefix, pages, the last error and whether a browser was asked for, one state a domain.

    All but prefixes after the first ``NEAR`` is one value, read and written once a micro-batch: each
    call to the state is an exchange with the JVM. A prefix is counted up to its limit.
    """

    def __init__(self, page_limit: int, forget_after: int = 0):
        self.page_limit, self.forget_after = page_limit, forget_after

    def init(self, handle) -> None:
        self.handle = handle
        self.far = handle.getMapState("prefixes", "name string", "n long")
        self.last = handle.getValueState("last", "at long, event_id long, error string, timer long, pages long, failures long, browser boolean, kinds map<string,long>, prefixes map<string,long>")

    def _held(self) -> _Held | None:
        return _Held(*self.last.get()) if self.last.exists() else None

    def handleInitialState(self, key, initialState, timerValues) -> None:
        (by, _, name), n, held = initialState.name.partition(" "), int(initialState.n), self._held() or _Held()
        prefixes = dict(held.prefixes)
        if by == "prefix":
            self._put(prefixes, name, n)
        changed = {"kind": {"kinds": {**held.kinds, name: n}}, "prefix": {"prefixes": prefixes}, "pages": {"pages": n}, "failures": {"failures": n}, "browser": {"browser": n > 0}}
        self.last.update(held._replace(**changed[by]))

    def _put(self, prefixes: dict[str, int], name: str, n: int) -> None:
        """Count a prefix: with the others while they are few, else apart."""
        if name in prefixes or len(prefixes) < NEAR:
            prefixes[name] = min(n, PREFIX_STORM_LIMIT)
        else:
            self.far.updateValue((name,), (min(n, PREFIX_STORM_LIMIT),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self._held() or _Held()
        batch, prefixes = _Batch(self.page_limit - held.pages), dict(held.prefixes)
        for row in rows:
            batch.add(zip(*row[1 : len(PACKED) + 1]))
        if batch.last is None:
            return
        found = [batch.crossed("kind", name, held.kinds.get(name, 0)) for name in batch.kinds]
        apart = len(held.prefixes) >= NEAR  # only then some are held apart
        for name, new in batch.prefixes.items():
            before = prefixes.get(name, 0)
            if apart and name not in prefixes and self.far.containsKey((name,)):
                before = self.far.getValue((name,))[0]
            if before < PREFIX_STORM_LIMIT:
                found.append(batch.crossed("prefix", name, before))
                self._put(prefixes, name, before + new.n)
        browser = not held.browser and batch.browser_wanted()
        if browser:
            found.append(("browser_escalation", batch.block[2], "", _id(batch.block[1]), None))
        now = self._noted(held, batch.last)._replace(
            pages=held.pages + batch.pages.n, failures=held.failures + batch.failures(), browser=held.browser or browser,
            kinds={**held.kinds, **{name: held.kinds.get(name, 0) + new.n for name, new in batch.kinds.items()}}, prefixes=prefixes,
        )
        self.last.update(now)
        for row in found:
            if row is not None:
                yield ROW(key[0], *row, None)
        yield ROW(key[0], "observed", now.error, "", _id(now.event_id), now.failures, now.pages)

    def _noted(self, held: _Held, fetch: tuple) -> _Held:
        """The state with the domain's last fetch and error: a page clears the text, a failure sets it. Fetches older than the last one change neither."""
        at, event_id, error = fetch
        if held.at is not None and (held.at, held.event_id) > (at, event_id):
            return held
        timer = at // 1000 + self.forget_after if self.forget_after else 0
        if timer and held.timer != timer:
            if held.timer:
                self.handle.deleteTimer(held.timer)
            self.handle.registerTimer(timer)
        return held._replace(at=at, event_id=event_id, error=error, timer=timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self._held()
        self.far.clear()
        self.last.clear()
        yield ROW(key[0], "forgotten", held.error, "", _id(held.event_id), held.failures, held.pages)

    def close(self) -> None:
        pass


def _micros(at: Column, kind: DataType) -> Column:
    """Microseconds that order times as their column does; a time without zone counts by its own clock, whatever the session's zone."""
    if not isinstance(kind, TimestampNTZType):
        return F.unix_micros(at)
    second = (F.date_part(F.lit("SECOND"), at) * 1_000_000).cast("long")
    return ((F.unix_date(at.cast("date")).cast("long") * 24 + F.hour(at)) * 60 + F.minute(at)) * 60_000_000 + second


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fetches in lists of one domain each, ``AT_ONCE`` at most, from as many rows at a time as fit in ``PACK_BYTES``."""

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        codes = rows["domain"].combine_chunks().dictionary_encode("encode").indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        codes, rows = codes[order], rows.take(pa.array(order)).combine_chunks()
        first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        place = np.arange(len(codes)) - np.repeat(first, np.diff(np.r_[first, len(codes)]))
        starts = np.flatnonzero(place % AT_ONCE == 0)
        offsets = pa.array(np.r_[starts, len(codes)], pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, rows[name].combine_chunks()) for name in PACKED]
        return pa.RecordBatch.from_arrays([rows["domain"].combine_chunks().take(pa.array(starts)), *lists], names=["domain", *PACKED])

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held, size = [*held, batch], size + batch.nbytes
        if size >= PACK_BYTES:
            yield packed(held)
            held, size = [], 0
    if held:
        yield packed(held)


def _arrivals(stream: DataFrame, timed: bool) -> DataFrame:
    """What the state asks of fetches, in lists: place and id (the least ones where null), kind, prefix where it counts, note, and why a browser is wanted.

    A cell costs the state's worker much more than an element of a list. Rows can't be packed where
    a watermark is on ``at``, since that is the column's own; each is a list then.
    """
    failed = F.col("kind").isNotNull()
    note = F.when(~failed, "").otherwise(F.substring(F.coalesce(F.nullif("error", F.lit("")), "kind"), 1, ERROR_LENGTH))
    made = {
        "place": F.coalesce(_micros(F.col("at"), stream.schema["at"].dataType), F.lit(LEAST)), "event_id": F.coalesce("event_id", F.lit(LEAST)), "kind": F.col("kind"),
        "prefix": F.when(failed & (F.col("prefix") != "/"), F.col("prefix")), "note": note, "wanted": F.when(failed & (F.col("browser_pages") > 0), F.col("escalation")),
    }
    if timed:
        return stream.select("domain", *(F.array(v).alias(name) for name, v in made.items()), "at")
    rows = stream.select("domain", *(v.alias(name) for name, v in made.items()))
    return rows.repartition("domain").mapInArrow(_pack, ", ".join(["domain string", *(f"{name} array<{kind}>" for name, kind in PACKED.items())]))


def domain_stream(stream: DataFrame, page_limit: int, known: DataFrame | None = None, forget_after: int = 0) -> DataFrame:
    """Interventions of a stream of fetches, and after each micro-batch one ``observed`` row a domain with its error, failures and pages.

    A limit fires once, at the fetch that reaches it; within a micro-batch fetches go by time and id,
    micro-batches by arrival. A browser is asked for once a domain, at its first wish, if fewer than
    ``page_limit`` pages came before. ``known`` (see ``totals``) is what earlier runs counted. With
    ``forget_after`` (milliseconds; the stream then has a watermark on ``at``) a domain without
    fetches for that long gives a ``forgotten`` row and starts anew; later rows than the watermark
    are dropped by it then, otherwise none is. What a task holds of a domain is bounded by its
    prefixes and limits, not by its fetches; with ``known``, Spark's worker itself holds those of one
    domain and micro-batch. The session keeps state in RocksDB (``with_state``).
    """
    mode = "EventTime" if forget_after else "None"
    before = known.groupBy("domain") if known is not None else None
    return _arrivals(stream, bool(forget_after)).groupBy("domain").transformWithState(DomainState(page_limit, forget_after), OUTPUT, "Update", mode, before)


def with_state(spark: SparkSession, run: Callable[[], None]) -> None:
    """Run a query that keeps such a state; the session's own choice of state store is put back afterwards."""
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKS)
    try:
        run()
    finally:
        spark.conf.set(STORE, before)


def stored(states: DataFrame, folder: str) -> DataFrame:
    """Run a state's stream over what has arrived and give all rows so far, with the number of their micro-batch.

    ``folder`` is shared; a micro-batch that is repeated after a failure replaces its own rows.
    """
    spark = states.sparkSession

    def write(rows: DataFrame, n: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/rows/batch={n}")

    writer = states.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", f"{folder}/stream").trigger(availableNow=True)
    with_state(spark, lambda: writer.start().awaitTermination())
    return spark.read.schema(f"{OUTPUT}, batch long").parquet(f"{folder}/rows")


def interventions(rows: DataFrame, page_limit: int) -> DataFrame:
    """The interventions that a stream of these fetches gives, if it comes by time and id.

    Rank limits go before the shuffle, so a hot domain ships a few rows for each task.
    """
    failed = rows.where("kind IS NOT NULL")
    action, reason = (F.coalesce(*(F.when(F.col("kind") == k, v) for k, v in named.items())) for named in (ACTIONS, REASONS))
    kinds = storms(failed, "domain", ORDER, "kind").select("domain", action.alias("action"), reason.alias("reason"), F.lit("").alias("detail"), "event_id", F.col("failures").cast("long"))
    w = Window.partitionBy("domain", "prefix").orderBy(*ORDER)
    third = failed.where("prefix <> '/'").withColumn("n", F.row_number().over(w)).where(F.col("n") <= PREFIX_STORM_LIMIT).where(F.col("n") == PREFIX_STORM_LIMIT)
    prefixes = third.select("domain", F.lit("auto_suppress_prefix").alias("action"), F.concat("kind", F.lit("_storm")).alias("reason"), F.col("prefix").alias("detail"), "event_id", F.col("n").cast("long").alias("failures"))
    wanted = failed.where("escalation IS NOT NULL AND browser_pages > 0").groupBy("domain").agg(F.min(F.struct("at", "event_id", "escalation")).alias("b"))
    each = Window.partitionBy("domain").orderBy(*ORDER)
    full = rows.where("kind IS NULL").withColumn("n", F.row_number().over(each)).where(F.col("n") <= page_limit).where(F.col("n") == page_limit).select("domain", F.struct("at", "event_id").alias("full"))
    open_ = F.lit(page_limit > 0) & (F.col("full").isNull() | (F.struct("b.at", "b.event_id") < F.col("full")))
    browsers = wanted.join(full, "domain", "left").where(open_).select("domain", F.lit("browser_escalation").alias("action"), F.col("b.escalation").alias("reason"), F.lit("").alias("detail"), F.col("b.event_id").alias("event_id"), F.lit(None).cast("long").alias("failures"))
    return reduce(DataFrame.unionByName, (kinds, prefixes, browsers))


def observed(rows: DataFrame) -> DataFrame:
    """Each domain's last error (a page clears it), failures and pages (a page clears neither)."""
    last = F.max_by(F.when(F.col("kind").isNull(), "").otherwise(F.substring(F.coalesce(F.nullif("error", F.lit("")), "kind"), 1, ERROR_LENGTH)), F.struct(*ORDER))
    return rows.groupBy("domain").agg(last.alias("error"), F.count("kind").alias("failures"), F.count_if(F.col("kind").isNull()).alias("pages"))


def totals(rows: DataFrame, page_limit: int) -> DataFrame:
    """``domain``, ``name``, ``n``: the counts that a later stream begins with."""
    failed = rows.where("kind IS NOT NULL")
    named: Mapping[str, DataFrame] = {"kind": failed, "prefix": failed.where("prefix <> '/'")}
    parts = [d.groupBy("domain", F.concat(F.lit(f"{by} "), by).alias("name")).agg(F.count("*").alias("n")) for by, d in named.items()]
    parts += [rows.groupBy("domain", F.when(F.col("kind").isNull(), "pages").otherwise("failures").alias("name")).agg(F.count("*").alias("n"))]
    parts += [interventions(rows, page_limit).where("action = 'browser_escalation'").select("domain", F.lit("browser").alias("name"), F.lit(1).cast("long").alias("n"))]
    return reduce(DataFrame.unionByName, parts)
