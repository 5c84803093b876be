"""Ordered entity resolution: rows see what earlier rows wrote.

A row takes the provider that holds one of its lookup keys at its place in the order. A key holds for
a provider from the row that sets it, a board's too, to the row that replaces it. Which rows set keys
follows from the assignment, so the assignment is a fixpoint: keys with their spans give pointers
from rows to earlier rows, chains of pointers are followed by doubling, and both are repeated until
nothing changes. Tables are folds over the rows of an entity. Nothing depends on the partitioning,
and a common name is a hot key of a join, not a group in one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import make_pk, normalize_domain, normalize_text
from . import merge
from .graph import components, cut

__all__ = ["assign_providers", "cascade", "components", "exact_copies", "is_board", "resolve_rows"]

# The lookups in order.
LOOKUPS = ("npi", "domain_state", "city_phone", "name_state", "name_state")
#: Tags of lookup keys, with the rank of the first guess.
TAGS = {"n": 0, "d": 1, "c": 2, "s": 3}
FOREVER = 1 << 62
#: A key with as many probes is dealt to several tasks.
HOT_PROBES = 20_000
#: With fewer rows of each provider, a holder's events are put in order in one task.
HOT_EVENTS = 200_000
#: With fewer rows all spans are made anew in each round, which costs less than to find those that change.
PARTS_FROM = 300_000
#: Columns of a row that resolution reads.
TEXTS = ("source_url", "provider_name", "credentials", "npi", "practice_name", "city", "phone", "state", "license_state")
# Why rows wait for a review.
MISSING_PROVIDER = "Practice offers evaluations but no named clinician was verified."
UNMATCHED_LICENSE = "Official license detail found but no provider-practice record matched for enrichment."
BOARD_ORPHAN = "Official license detail matched a provider but no provider-practice affiliation exists for export."


def is_board(source_type: Column, profile: Column) -> Column:
    return (F.coalesce(source_type, F.lit("")) == "licensing_board") | (F.coalesce(profile, F.lit("")) == "board")


def _followed(pointers: DataFrame) -> DataFrame:
    """``id``, ``at``: where the chain of pointers from each id ends, by doubling twice a round; each round is cut."""
    now = pointers.select("id", "at")
    while True:
        further = now.select(F.col("id").alias("at"), F.col("at").alias("next"))
        stepped = now.join(further, "at", "left").select("id", F.coalesce("next", "at").alias("at"), F.col("next").isNotNull().alias("moved"))
        further = stepped.select(F.col("id").alias("at"), F.col("at").alias("next"))
        stepped = cut(stepped.join(further, "at", "left").select("id", F.coalesce("next", "at").alias("at"), (F.col("moved") & F.col("next").isNotNull()).alias("moved")))
        now = stepped.select("id", "at")
        if stepped.where("moved").isEmpty():
            return now


def _ordered(rows: DataFrame, row_id: str, order: str) -> DataFrame:
    """``rows`` with ``pos``, a number that rises with the order, and ``split``, the range of the order that the row lies in."""
    return rows.orderBy(order, row_id).withColumn("pos", F.monotonically_increasing_id()).withColumn("split", F.shiftright("pos", 33))


def spans(events: DataFrame, key: str, values: list[str], *keep: str) -> DataFrame:
    """When each state of a key holds: ``key``, ``values``, ``since`` (place of the row that made it), ``until`` (of the row that replaced it), ``born``, ``keep`` of the first row.

    A null value leaves the one before it, as an upsert does; equal states in a row are one span. A
    key's events are cut by ``split``: states are carried on within each, and from one to the next by
    a row for each, so a hot key is dealt to as many tasks as the order has ranges.
    """
    within = Window.partitionBy(key, "split").orderBy("pos")
    latest = events.groupBy(key, "split").agg(*(F.max_by(F.when(F.col(v).isNotNull(), F.col(v)), F.when(F.col(v).isNotNull(), F.col("pos"))).alias(v) for v in values))
    before = Window.partitionBy(key).orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = latest.select(key, "split", F.row_number().over(Window.partitionBy(key).orderBy("split")).alias("_nth"), *(F.last(v, True).over(before).alias(f"_{v}") for v in values))
    filled = events.withColumns({v: F.last(v, True).over(within) for v in values} | {"_first": F.row_number().over(within) == 1})
    filled = filled.join(carried, [key, "split"]).withColumns({v: F.coalesce(v, f"_{v}") for v in values})
    was = {f"_{v}": F.when(F.col("_first"), F.col(f"_{v}")).otherwise(F.lag(v).over(within)) for v in values}
    filled = filled.withColumns(was)
    changed = reduce(lambda x, y: x | y, (~F.col(v).eqNullSafe(F.col(f"_{v}")) for v in values))
    starts = filled.where(changed | (F.col("_first") & (F.col("_nth") == 1)))
    whole = Window.partitionBy(key).orderBy("pos")
    return starts.select(key, *values, F.col("pos").alias("since"), F.lead("pos").over(whole).alias("until"), F.first("pos").over(whole).alias("born"), *keep)


def _spans_at_once(events: DataFrame, key: str, values: list[str], *keep: str) -> DataFrame:
    """What ``spans`` gives, by one sort of each key's events, for keys of few."""
    whole = Window.partitionBy(key).orderBy("pos")
    filled = events.withColumns({v: F.last(v, True).over(whole) for v in values} | {"_nth": F.row_number().over(whole), "_born": F.first("pos").over(whole)})
    changed = reduce(lambda x, y: x | y, (~F.col(v).eqNullSafe(F.lag(v).over(whole)) for v in values))
    starts = filled.withColumn("_starts", changed | (F.col("_nth") == 1)).where("_starts")
    return starts.select(key, *values, F.col("pos").alias("since"), F.lead("pos").over(whole).alias("until"), F.col("_born").alias("born"), *keep)


def _met(row: str, since: str = "since", until: str = "until") -> Column:
    """Whether a span holds for a row: begun before it, and not replaced before it."""
    return (F.col(since) < F.col(row)) & (F.col(until).isNull() | (F.col(until) >= F.col(row)))


def containing(domains: DataFrame, urls: DataFrame) -> DataFrame:
    """``domain``, ``url``: all pairs where the address holds the domain anywhere (a LIKE with blanks on both sides), without comparing all pairs.

    A domain has no slash, so it lies within one part of the address between slashes; each part is
    posted under its pieces of the lengths that domains have, and equal ones meet.
    """
    low, high = domains.where("domain <> ''").agg(F.min(F.length("domain")), F.max(F.length("domain"))).first()
    low, high = F.lit(low or 1), F.lit(high or 1)
    parts = urls.select("url", F.explode(F.split(F.lower("url"), "/")).alias("part")).where("part <> ''")
    n = F.length("part")
    pieces = F.flatten(F.transform(F.sequence(F.lit(1), n - low + 1), lambda i: F.transform(F.sequence(low, F.least(high, n - i + 1)), lambda k: F.substr("part", i, k))))
    posted = parts.select("part").distinct().where(n >= low).select("part", F.explode(F.array_distinct(pieces)).alias("domain"))
    return posted.join(domains, "domain").join(parts, "part").select("domain", "url").distinct()


def _levels(splits: Column) -> Column:
    return F.ceil(F.log2(splits.cast("double") + 1)).cast("int")


def _covered(since: Column, until: Column, splits: Column) -> Column:
    """Nodes of a binary tree over the ranges of the order that together are all ranges between those of two places: array of ``level``, ``node``."""
    low, high = F.shiftright(since, 33) + 1, F.coalesce(F.shiftright(until, 33), splits)

    def at(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        left, right = F.ceil(low / size), F.floor(high / size)
        some = left < right
        node = lambda used, n: F.when(some & used, F.struct(level.alias("level"), n.cast("long").alias("node")))
        return F.array(node(left % 2 == 1, left), node(right % 2 == 1, right - 1))

    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), _levels(splits)), at)))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each probe the first span that holds, by rank and birth; rows come by key, range and place, probes before spans of their place."""
    group, heap = None, []
    for batch in batches:
        found = []
        for key, split, place, probe, until, rank, born, since in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if (key, split) != group:
                group, heap = (key, split), []
            if not probe:
                until = FOREVER if until is None else until
                if not heap or heap[0][:2] > (rank, born) or heap[0][3] < until:  # else one that goes before holds as long
                    heapq.heappush(heap, (rank, born, since, until))
                continue
            while heap and heap[0][3] < place:
                heapq.heappop(heap)
            if heap:
                found.append((place, *heap[0][:3], key))
        types = {"pos": pa.int64(), "rank": pa.int32(), "born": pa.int64(), "since": pa.int64(), "key": pa.string()}
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(types.values())], names=list(types))


def _sweep_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each probe all spans that hold; rows as for ``_sweep``."""
    group, held = None, []
    for batch in batches:
        places, values = [], []
        for key, split, place, probe, until, value in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if (key, split) != group:
                group, held = (key, split), []
            if not probe:
                held.append((FOREVER if until is None else until, value))
                continue
            held = [h for h in held if h[0] >= place]
            places += [place] * len(held)
            values += [h[1] for h in held]
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(values, pa.string())], names=["pos", "value"])


def _swept(rows: DataFrame, function: Callable, schema: str) -> DataFrame:
    return rows.repartition("key", "split").sortWithinPartitions("key", "split", "at", F.col("probe").desc()).mapInArrow(function, schema)


def _probes(each: DataFrame, split: Column, **nulls: str) -> DataFrame:
    return each.select("key", split.alias("split"), F.col("pos").alias("at"), F.lit(True).alias("probe"), *(F.lit(None).cast(t).alias(n) for n, t in ({"until": "long"} | nulls).items()))


def _carried(each: DataFrame, held: DataFrame, splits: Column) -> DataFrame:
    """For each range of the order and key that is asked for there, the first span by rank and birth among those that hold throughout the range."""
    between = held.select("key", "rank", "born", "since", F.explode(_covered(F.col("since"), F.col("until"), splits)).alias("_n"))
    between = between.groupBy("key", "_n.level", "_n.node").agg(F.min(F.struct("rank", "born", "since")).alias("m"))
    size = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k)
    above = F.transform(F.sequence(F.lit(0), _levels(splits)), lambda k: F.struct(k.alias("level"), F.floor(F.col("split") / size(k)).alias("node")))
    ranges = each.select("key", F.shiftright("pos", 33).alias("split")).distinct().select("key", "split", F.explode(above).alias("_n")).select("key", "split", "_n.level", "_n.node")
    carried = ranges.join(between, ["key", "level", "node"]).groupBy("key", "split").agg(F.min("m").alias("m"))
    return carried.select("key", "split", F.lit(-1).cast("long").alias("at"), F.lit(False).alias("probe"), F.lit(None).cast("long").alias("until"), "m.rank", "m.born", "m.since")


def holders(each: DataFrame, held: DataFrame, splits: Column, hot: DataFrame | None = None, keyed: bool = False) -> DataFrame:
    """``pos``, ``rank``, ``born``, ``since`` (and with ``keyed`` the ``key``): for each probe (``key``, ``pos``) the span of its key (``held``: ``rank``, ``born``, ``since``, ``until``) that holds there and comes first by rank and birth.

    A key's probes and spans are sorted by place and read once. Those of ``hot`` keys are cut by ranges
    of the order: a span goes to the ranges it begins and ends in, and for the ranges between only the
    first is kept, over nodes of a tree of ranges. So a hot key is dealt to as many tasks as there are ranges.
    """
    c, whole = F.col, F.lit(-1).cast("long")
    schema, wanted = "pos long, rank int, born long, since long, key string", ["pos", "rank", "born", "since", *(["key"] if keyed else [])]
    columns = ["key", "split", "at", "probe", "until", "rank", "born", "since"]
    nulls = {"rank": "int", "born": "long", "since": "long"}
    if hot is None:
        pieces = held.select("key", whole.alias("split"), c("since").alias("at"), F.lit(False).alias("probe"), "until", "rank", "born", "since")
        return _swept(_probes(each, whole, **nulls).unionByName(pieces), _sweep, schema).select(wanted)
    hot = F.broadcast(hot.select("key", F.lit(True).alias("hot")))
    each, held = (df.join(hot, "key", "left").withColumn("hot", c("hot").isNotNull()) for df in (each, held))
    start, end = F.shiftright("since", 33), F.shiftright("until", 33)
    piece = lambda split, at: F.struct(split.alias("split"), at.alias("at"))
    cuts = F.array_compact(F.array(piece(start, c("since")), F.when(end > start, piece(end, whole))))
    pieces = held.withColumn("_p", F.explode(F.when(c("hot"), cuts).otherwise(F.array(piece(whole, c("since"))))))
    pieces = pieces.select("key", "_p.split", "_p.at", F.lit(False).alias("probe"), "until", "rank", "born", "since")
    rows = _probes(each, F.when(c("hot"), F.shiftright("pos", 33)).otherwise(whole), **nulls).unionByName(pieces).unionByName(_carried(each.where("hot"), held.where("hot"), splits))
    return _swept(rows.select(columns), _sweep, schema).select(wanted)


def _all_holding(each: DataFrame, held: DataFrame, splits: Column) -> DataFrame:
    """``pos``, ``value``: for each probe all spans of its key that hold there; a span is posted to each range of the order that it touches."""
    start = F.shiftright("since", 33)
    touched = F.sequence(start, F.coalesce(F.shiftright("until", 33), splits - 1))
    pieces = held.select("key", F.explode(touched).alias("split"), "since", "until", "value")
    pieces = pieces.select("key", "split", F.when(F.shiftright("since", 33) == F.col("split"), F.col("since")).otherwise(-1).alias("at"), F.lit(False).alias("probe"), "until", "value")
    return _swept(_probes(each, F.shiftright("pos", 33), value="string").unionByName(pieces), _sweep_all, "pos long, value string")


def _keyed(tag: str, *parts: str) -> Column:
    """A lookup key, null where a part is missing."""
    return F.when(F.forall(F.array(*parts), lambda p: F.coalesce(p, F.lit("")) != ""), F.concat_ws("\x1f", F.lit(tag), *parts))


#: Columns of a row that its spans keep.
KEPT = ("provider_id", "practice_id", "city", "phone", "steady", "moves")


def _record(provider: Column) -> Column:
    return make_pk("rec", provider, F.col("practice_id"), F.col("location_id"), F.col("state"))


def _held(assigned: DataFrame, dealt: bool = True, only: DataFrame | None = None) -> DataFrame:
    """The spans of numbers (``tag`` n), of people's names and states (p) and of records (r) under an assignment of rows to providers; of the holders ``only``, if given.

    With ``dealt`` a holder's events are dealt to several tasks.
    """
    c = F.col
    # numbers apart from names, so that a name's pointer leads to the row that set the name; all in one pass over one key
    state = lambda tag, of, first, second: F.struct(F.concat(F.lit(tag), of).alias("holder"), first.alias("is"), second.alias("of_state"))
    none = F.lit(None).cast("string")
    states = F.array_compact(F.array(
        F.when(c("npi").isNotNull(), state("n", c("provider_id"), c("npi"), none)), state("p", c("provider_id"), c("name"), c("held_state")),
        F.when(c("makes"), state("r", _record(c("provider_id")), c("name"), c("own_state"))),
    ))
    events = assigned.where("provider_id <> ''").select("pos", "split", *KEPT, F.explode(states).alias("_s")).select("_s.*", "pos", "split", *KEPT)
    if only is not None:
        events = events.join(only, "holder", "left_semi")
    return cut((spans if dealt else _spans_at_once)(events, "holder", ["is", "of_state"], *KEPT).withColumn("tag", F.substring("holder", 1, 1)))


def _records(held: DataFrame) -> DataFrame:
    c = F.col
    return held.where("tag = 'r'").select(F.substr("holder", F.lit(2)).alias("record_id"), c("is").alias("name"), c("of_state").alias("own_state"), "since", "until", "born", *KEPT)


def _keys(held: DataFrame) -> DataFrame:
    """Every lookup key with its spans."""
    c = F.col
    people, records = held.where("tag = 'p'").withColumnsRenamed({"is": "name", "of_state": "held_state"}), _records(held)
    births = people.groupBy("provider_id").agg(F.min("born").alias("_born"))  # a provider may exist before its number
    numbers = held.where("tag = 'n'").join(births, "provider_id").select(c("is").alias("npi"), "since", "until", c("_born").alias("born"))

    def posted(held: DataFrame, keys: Column) -> DataFrame:
        return held.select("since", "until", "born", F.explode(F.filter(keys, lambda k: k["key"].isNotNull())).alias("k")).select("k.key", "k.rank", "since", "until", "born")

    ranked = lambda rank, key: F.struct(F.lit(rank).alias("rank"), key.alias("key"))
    keys = posted(numbers, F.array(ranked(0, _keyed("n", "npi")))).unionByName(posted(people, F.array(ranked(3, _keyed("s", "name", "held_state")))))
    at_site = F.transform("steady", lambda d: ranked(1, _keyed("d", "name", d, "own_state")))
    moving = F.when(c("moves"), _keyed("p", "name", "practice_id", "own_state"))
    return keys.unionByName(posted(records, F.concat(F.array(ranked(1, moving), ranked(2, _keyed("c", "name", "city", "phone")), ranked(4, _keyed("s", "name", "own_state"))), at_site)))


def _lookup_spans(assigned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every lookup key with its span, and the spans of records, under an assignment of rows to providers."""
    held = _held(assigned)
    return _keys(held), _records(held)


def _respanned(now: DataFrame, held: DataFrame, dealt: bool) -> tuple[DataFrame, DataFrame]:
    """``held`` after the rows of ``now`` whose provider is no longer ``_was``, and the keys whose spans this changed."""
    c = F.col
    changed = now.where("provider_id <> _was").select("makes", "practice_id", "location_id", "state", F.explode(F.array("provider_id", "_was")).alias("_p")).where("_p <> ''")
    holders_of = F.array(F.concat(F.lit("n"), c("_p")), F.concat(F.lit("p"), c("_p")), F.when(c("makes"), F.concat(F.lit("r"), _record(c("_p")))))
    touched = cut(changed.select(F.explode(F.array_compact(holders_of)).alias("holder")).distinct())
    fresh = _held(now, dealt, touched)
    both = _keys(fresh).withColumn("_n", F.lit(1)).unionByName(_keys(held.join(touched, "holder", "left_semi")).withColumn("_n", F.lit(-1)))
    keys = cut(both.groupBy("key", "rank", "since", "until", "born").agg(F.sum("_n").alias("_n")).where("_n <> 0").select("key").distinct())
    return cut(held.join(touched, "holder", "left_anti").unionByName(fresh)), keys


def _sites(makers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each practice's domains that all its addresses contain (``steady``), whether it has others (``moves``), and when it holds each of the others."""
    c = F.col
    held = containing(makers.select("domain").where("domain <> ''").distinct(), makers.select("url").distinct())
    used = makers.groupBy("practice_id", "url").agg(F.count("*").alias("n"))
    counted = used.join(held, "url").groupBy("practice_id", "domain").agg(F.sum("n").alias("k")).join(used.groupBy("practice_id").agg(F.sum("n").alias("n")), "practice_id")
    counted = cut(counted.withColumn("steady", c("k") == c("n")))
    practices = counted.groupBy("practice_id").agg(F.array_sort(F.collect_set(F.when(c("steady"), c("domain")))).alias("steady"), F.bool_or(~c("steady")).alias("moves"))
    moving = counted.where("not steady").select("practice_id", "domain")
    listed = used.join(held, "url").join(moving, ["practice_id", "domain"]).groupBy("practice_id", "url").agg(F.array_join(F.array_sort(F.collect_set("domain")), "\x1f").alias("domains"))
    events = makers.where("url <> ''").join(moving.select("practice_id").distinct(), "practice_id", "left_semi").join(listed, ["practice_id", "url"], "left")
    sites = spans(events.select("practice_id", "pos", "split", F.coalesce("domains", F.lit("")).alias("domains")), "practice_id", ["domains"])
    return practices, sites.select(F.explode(F.split("domains", "\x1f")).alias("key"), c("practice_id").alias("value"), "since", "until").where("key <> ''")


def _prepared(rows: DataFrame, row_id: str, order: str) -> tuple[DataFrame, DataFrame, Column, DataFrame | None]:
    """What resolution reads of each row, its probes, the number of ranges of the order, and the keys of many probes."""
    c, have = F.col, set(rows.columns)
    board = is_board(c("source_type") if "source_type" in have else F.lit(""), c("extraction_profile") if "extraction_profile" in have else F.lit(""))
    if "state" not in have and "license_state" in have:  # rows without a place's state are of their licence's
        rows, have = rows.withColumn("state", c("license_state")), have | {"state"}
    text = lambda n: F.coalesce(c(n), F.lit("")) if n in have else F.lit("")
    url, lower = text("source_url"), lambda x: F.lower(normalize_text(x))
    domain = normalize_domain(url)
    site = F.coalesce(F.nullif(domain, F.lit("")), url)
    license_or_state = F.coalesce(F.nullif(text("license_state"), F.lit("")), text("state"))
    # sorted first, so that what is made of a row is computed once and by all tasks
    used = [n for n in ("source_type", "extraction_profile", *TEXTS) if n in have]
    rows = _ordered(rows.select(c(row_id).alias("id"), c(order).alias("_order"), *used), "id", "_order")
    base = rows.select(
        "id", "pos", "split", board.alias("board"), ((lower(text("provider_name")) != "") & ~board).alias("makes"), F.nullif(lower(text("provider_name")), F.lit("")).alias("name"),
        F.nullif(text("npi"), F.lit("")).alias("npi"), F.lower(text("city")).alias("city"), text("phone").alias("phone"), F.lower(text("state")).alias("state"), F.lower(url).alias("url"), domain.alias("domain"),
        F.nullif(F.lower(F.when(board, license_or_state).otherwise(text("license_state"))), F.lit("")).alias("held_state"), F.nullif(F.lower(text("license_state")), F.lit("")).alias("own_state"),
        F.lower(license_or_state).alias("wanted_state"), make_pk("prov", c("provider_name"), c("credentials"), text("state"), F.coalesce(F.nullif(text("npi"), F.lit("")), url)).alias("new_id"),
        make_pk("prac", text("practice_name"), site).alias("practice_id"), F.coalesce(F.nullif(text("phone"), F.lit("")), domain).alias("_place"),
    )
    base = base.withColumn("location_id", make_pk("loc", c("practice_id"), c("city"), c("state"), c("_place"))).drop("_place")
    base = cut(base)

    splits = F.lit((base.agg(F.max("split")).first()[0] or 0) + 1)
    makers, page = base.where("makes"), ~c("board")
    practices, sites = _sites(makers)
    base = base.join(practices, "practice_id", "left").withColumns({"steady": F.coalesce("steady", F.array().cast("array<string>")), "moves": F.coalesce("moves", F.lit(False))})
    base = cut(base)
    probes = F.array_compact(F.array(_keyed("n", "npi"), F.when(page, _keyed("d", "name", "domain", "state")), F.when(page, _keyed("c", "name", "city", "phone")), _keyed("s", "name", "wanted_state")))
    each = base.where("board or makes").select("pos", F.explode(probes).alias("key"))
    # practices that hold the row's domain at its place for a time only, and know the name
    asked = makers.where(_keyed("", "name", "domain", "state").isNotNull())
    near = _all_holding(asked.select(c("domain").alias("key"), "pos"), sites, splits).withColumnRenamed("value", "practice_id").join(asked.select("pos", "name", "state"), "pos")
    near = near.join(makers.select("name", "practice_id").distinct(), ["name", "practice_id"], "left_semi")
    each = cut(each.unionByName(near.select("pos", _keyed("p", "name", "practice_id", "state").alias("key"))))
    hot = cut(each.groupBy("key").count().where(c("count") >= HOT_PROBES).select("key"))
    return base, each, splits, None if hot.isEmpty() else hot


def _ends(parent: DataFrame) -> DataFrame:
    """``at``, ``end``: where the chain from each row that others point to ends; these are few, and only they are followed."""
    targets = parent.select("at").distinct()
    followed = _followed(parent.join(targets.select(F.col("at").alias("id")), "id", "left_semi"))
    return targets.join(followed.select(F.col("id").alias("at"), F.col("at").alias("end")), "at", "left").select("at", F.coalesce("end", "at").alias("end"))


def _resolved(rows: DataFrame, row_id: str, order: str) -> tuple[DataFrame, DataFrame]:
    """``id``, ``pos``, ``provider_id``, ``rank`` of every row, and the spans of all records.

    Over many rows, from the third round on only the spans of providers and records whose rows changed
    are made anew, and only the keys whose spans differ are looked up again.
    """
    base, each, splits, hot = _prepared(rows, row_id, order)
    base = base.drop("board", "url", "domain", "wanted_state")  # rounds write and shuffle the rest
    own_id = F.when(F.col("makes"), F.col("new_id")).otherwise("")
    now = base.withColumns({"provider_id": own_id, "rank": F.lit(None).cast("int")})
    # the first guess: keys hold for ever, those of boards not at all
    first = each.where(~F.col("key").startswith("p")).join(base.where("makes").select("pos"), "pos").groupBy("key").agg(F.min("pos").alias("since"))
    rank = F.element_at(F.create_map(*(F.lit(x) for tag in TAGS.items() for x in tag)), F.substring("key", 1, 1))
    guess = first.select("key", rank.alias("rank"), "since", F.lit(None).cast("long").alias("until"), F.col("since").alias("born"))
    found, held = holders(each, guess, splits, hot), None
    while True:
        best = found.groupBy("pos").agg(F.min(F.struct("rank", "born", "since")).alias("m"))
        parent = cut(best.select(F.col("pos").alias("id"), F.col("m.since").alias("at"), F.col("m.rank").alias("found_rank")))
        ends = _ends(parent).join(base.select(F.col("pos").alias("end"), own_id.alias("found")), "end").select("at", "found")
        ends = parent.join(ends, "at").select(F.col("id").alias("pos"), "found", "found_rank")
        after = now.drop("_was").join(ends, "pos", "left").withColumns({"_was": F.col("provider_id"), "provider_id": F.coalesce("found", own_id), "rank": F.col("found_rank")}).drop("found", "found_rank")
        now = cut(after)
        per = now.groupBy("provider_id").agg(F.count("*").alias("n"), F.count_if(F.col("provider_id") != F.col("_was")).alias("changed"))
        n, changed, most = per.agg(F.sum("n"), F.sum("changed"), F.max(F.when(F.col("provider_id") != "", F.col("n")))).first()
        # the same providers leave the same spans, by which the ranks were found
        if held is not None and not changed:
            return now.select("id", "pos", "provider_id", "rank"), _records(held)
        dealt = (most or 0) >= HOT_EVENTS
        if held is None or n < PARTS_FROM:
            held = _held(now, dealt)
            found = holders(each, _keys(held), splits, hot, True)
            if n >= PARTS_FROM:
                found = cut(found)
        else:
            held, keys = _respanned(now, held, dealt)
            again = holders(each.join(keys, "key", "left_semi"), _keys(held).join(keys, "key", "left_semi"), splits, hot, True)
            found = cut(found.join(keys, "key", "left_anti").unionByName(again))


def assign_providers(rows: DataFrame, row_id: str = "extracted_id", order: str = "created_at") -> DataFrame:
    """``rows`` with ``provider_id`` and ``matched_by``.

    A row takes the provider that holds one of its keys at that time: its registry number; its name
    with the state of a record whose practice's address contains the row's domain; its name with city
    and phone of a record; its name and state, of a provider, then of a record. Among several the one
    made first is taken. Without any the row makes a provider. Numbers, names and states are those
    last written by then, by rows of pages or boards. Rows without a provider name make none, and rows
    of boards (``source_type``, ``extraction_profile``) neither: they are looked up by number, then
    name and state, and their id is blank where nothing is found.

    The rows up to any place in the order are right once all before them are, so each round makes at
    least one more row right, and the fixpoint is what a walk from row to row gives. A key's spans are
    as many as its changes of holder.
    """
    found, _ = _resolved(rows, row_id, order)
    named = F.when(F.col("rank").isNotNull(), F.element_at(F.array(*map(F.lit, LOOKUPS)), F.col("rank") + 1)).otherwise(F.when(F.col("provider_id") != "", "new").otherwise("none"))
    return rows.join(found.select(F.col("id").alias(row_id), "provider_id", named.alias("matched_by")), row_id)


def _last(order: str, row_id: str, column: str, *unknown: str) -> Column:
    """The last value that is none of ``unknown``, else the first."""
    o, known = F.struct(order, row_id), F.col(column).isNotNull() & ~F.col(column).isin(*unknown)
    return F.coalesce(F.max_by(F.when(known, F.col(column)), F.when(known, o)), F.min_by(column, o)).alias(column)


def resolve_rows(rows: DataFrame, row_id: str = "extracted_id", order: str = "created_at", wanted: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
    """All tables that the ordered upserts of extracted rows leave; with ``wanted`` these only.

    ``providers``, ``practices``, ``practice_locations``, ``licenses``, ``provider_practice_records``,
    ``field_evidence``, ``review_queue`` and ``assigned`` (the rows with their provider). Known values
    are replaced by later known ones, never by unknown ones. Rows of boards update the provider and,
    from the time a record exists, the records of their state; boards that find no provider or no
    record are queued, as are practices that offer evaluations but name nobody.
    """
    c = F.col
    for name in ("address_1", "zip", "metro", "fax", "insurance_notes", "waitlist_notes", "referral_requirements", "source_document_id", "extraction_profile"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(""))
    found, held = _resolved(rows, row_id, order)
    found = found.select(c("id").alias(row_id), c("pos").alias("_pos"), "provider_id")
    assigned = cut(rows.join(found, row_id).withColumn("_board", is_board(c("source_type"), c("extraction_profile"))))
    domain = F.coalesce(F.nullif(normalize_domain(c("source_url")), F.lit("")), c("source_url"))
    state = F.coalesce(F.nullif(c("license_state"), F.lit("")), c("state"))
    own = assigned.where(~c("_board") & (c("provider_name") != "")).withColumn("practice_id", make_pk("prac", c("practice_name"), domain))
    own = own.withColumn("location_id", make_pk("loc", c("practice_id"), c("city"), c("state"), F.coalesce(F.nullif(c("phone"), F.lit("")), normalize_domain(c("source_url")))))
    own = own.withColumn("record_id", make_pk("rec", c("provider_id"), c("practice_id"), c("location_id"), c("state")))
    times = [F.min(order).alias("created_at"), F.max(order).alias("updated_at")]
    boards = assigned.where(c("_board")).withColumn("license_state", state).withColumn("license_type", F.coalesce(F.nullif(c("license_type"), F.lit("")), F.lit("unknown")))

    def folded(df: DataFrame, key: str, columns: dict[str, tuple[str, ...]], also: tuple[str, ...] = ()) -> DataFrame:
        last = [F.max_by(a, F.struct(order, row_id)).alias(a) for a in also]
        return df.groupBy(key).agg(*(_last(order, row_id, name, *unknown) for name, unknown in columns.items()), *last, *times)

    # an unknown licence of a board changes nothing, one of a page replaces what was known
    known_board = boards.withColumn("license_type", F.when(c("license_type") == "unknown", "").otherwise(c("license_type")))
    writers = own.select(row_id, order, "provider_id", "provider_name", "credentials", "npi", "license_state", "license_type")
    writers = writers.unionByName(known_board.where("provider_id <> ''").select(*writers.columns))
    named = writers.withColumnsRenamed({"license_state": "primary_license_state", "license_type": "primary_license_type"})
    providers = folded(named, "provider_id", {n: ("",) for n in ("provider_name", "credentials", "npi", "primary_license_state", "primary_license_type")})
    practices = folded(own.withColumn("website", c("source_url")), "practice_id", {n: ("",) for n in ("practice_name", "website", "intake_url", "phone", "fax")})
    places = folded(own, "location_id", {**{n: ("",) for n in ("address_1", "city", "state", "zip", "metro", "phone")}, "telehealth": ("unknown",)}, ("practice_id",))

    licence = make_pk("lic", c("provider_id"), c("license_state"), c("license_type"), F.coalesce(F.nullif(c("npi"), F.lit("")), c("provider_name")))
    both = [df.withColumn("license_id", licence).select(row_id, order, "license_id", "provider_id", "license_state", "license_type", F.col("npi").alias("license_number"), "license_status", "source_url") for df in (own, boards.where("provider_id <> ''"))]
    licenses = folded(both[0].unionByName(both[1]), "license_id", {"license_state": ("",), "license_type": ("",), "license_number": ("",), "license_status": ("unknown",), "source_url": ("",)}, ("provider_id",))
    licenses = licenses.withColumn("retrieved_at", c("updated_at"))

    # records exist from their first row on; boards touch those of their provider and state that exist by then
    held = held.select("record_id", "provider_id", F.coalesce("own_state", F.lit("")).alias("_state"), c("since").alias("_since"), c("until").alias("_until"))
    touched = known_board.where("provider_id <> ''").join(held, "provider_id").where(_met("_pos", "_since", "_until"))
    touched = touched.where((c("license_state") == "") | (F.lower("license_state") == c("_state")))
    shared = ("npi", "license_state", "license_type", "license_status", "source_url", "source_document_id", "source_tier", "evidence")
    events = own.select(row_id, order, "record_id", *shared).unionByName(touched.select(row_id, order, "record_id", *shared))
    if wanted is None or "provider_practice_records" in wanted:  # read several times
        events = cut(events)
    facts = folded(events, "record_id", {"npi": ("",), "license_state": ("",), "license_type": ("",), "license_status": ("unknown",)})
    facts = facts.withColumnRenamed("updated_at", "last_verified_at").withColumn("updated_at", c("last_verified_at"))
    snapshots = folded(
        own.withColumns({"provider_name_snapshot": c("provider_name"), "practice_name_snapshot": c("practice_name")}), "record_id",
        {"provider_name_snapshot": ("",), "practice_name_snapshot": ("",), "diagnoses_asd": ("unclear",), "diagnoses_adhd": ("unclear",), "telehealth": ("unknown",),
         "insurance_notes": ("",), "waitlist_notes": ("",), "referral_requirements": ("",)}, ("provider_id", "practice_id", "location_id"),
    ).drop("created_at", "updated_at")
    some = F.size("age_groups") > 0
    ages = own.groupBy("record_id").agg(F.coalesce(F.max_by(F.when(some, c("age_groups")), F.when(some, F.struct(order, row_id))), F.array().cast("array<string>")).alias("age_groups"))
    urls = merge.ordered_values(events, "record_id", "source_url", F.struct(order, row_id)).withColumnRenamed("values", "source_urls")
    records = facts.join(snapshots, "record_id").join(ages, "record_id").join(urls, "record_id", "left").withColumns({
        "source_urls": F.coalesce("source_urls", F.array().cast("array<string>")), "prescriptive_authority": F.lit("unknown"), "prescriptive_basis": F.lit(""),
        "review_status": F.lit("pending"), "export_status": F.lit("pending"), "blocked_reason": F.lit(""), "conflict_note": F.lit(""),
    })

    items = events.withColumn("_e", F.explode("evidence")).withColumns({
        "field_name": normalize_text(c("_e.field")), "field_value": normalize_text(c("_e.value")), "quote": F.coalesce("_e.quote", F.lit("")),
        "_url": F.coalesce(F.nullif(c("_e.source_url"), F.lit("")), c("source_url")),
    }).where("field_name <> ''")
    items = items.select(
        make_pk("evi", c("record_id"), c("field_name"), c("field_value"), c("_url")).alias("evidence_id"), "record_id", "field_name", "field_value", "quote", c("_url").alias("source_url"),
        "source_document_id", "source_tier", c(order).alias("captured_at"), F.struct(order, row_id).alias("_o"),
    )
    evidence = merge.replace_upserts(items, ["evidence_id"], c("_o")).drop("_o")

    first_quote = F.coalesce(F.try_element_at(F.filter(F.transform("evidence", lambda e: e["quote"]), lambda q: F.coalesce(q, F.lit("")) != ""), F.lit(1)), F.lit(""))

    def queued(df: DataFrame, kind: str, reason: str, who: Column, *parts: Column) -> DataFrame:
        return df.select(
            make_pk("rev", *parts).alias("review_id"), F.lit("").alias("record_id"), F.lit(kind).alias("review_type"), who.alias("provider_name"), "practice_name", F.lit(reason).alias("reason"),
            "source_url", first_quote.alias("evidence_quote"), F.lit("pending").alias("status"), c(order).alias("created_at"), F.struct(order, row_id).alias("_o"),
        )

    nameless = assigned.where(~c("_board") & (c("provider_name") == "") & ((c("diagnoses_asd") == "yes") | (c("diagnoses_adhd") == "yes")))
    lost = boards.where((c("provider_id") == "") & (c("provider_name") != "") & (c("license_status") != "unknown"))
    # the earliest span of a provider's state and end is enough to tell whether a board met a record
    spans_of = held.groupBy(c("provider_id").alias("_p"), "_state", "_until").agg(F.min("_since").alias("_since"))
    meets = (c("provider_id") == c("_p")) & _met("_pos", "_since", "_until") & ((c("license_state") == "") | (F.lower("license_state") == c("_state")))
    orphaned = boards.where("provider_id <> ''").join(spans_of, meets, "left_anti")
    reviews = queued(nameless, "missing_provider", MISSING_PROVIDER, F.lit(""), c("practice_name"), domain, F.lit("missing_provider"))
    reviews = reviews.unionByName(queued(lost, "unmatched_license", UNMATCHED_LICENSE, c("provider_name"), c("provider_name"), c("license_state"), c("source_url"), F.lit("unmatched_license")))
    reviews = reviews.unionByName(queued(orphaned, "unmatched_license", BOARD_ORPHAN, c("provider_name"), c("provider_id"), c("license_state"), c("source_url"), F.lit("board_orphan")))
    tables = {
        "assigned": assigned.drop("_board", "_pos"), "providers": providers, "practices": practices, "practice_locations": places, "licenses": licenses, "provider_practice_records": records,
        "field_evidence": evidence, "review_queue": merge.replace_upserts(reviews, ["review_id"], c("_o")).drop("_o"),
    }
    return tables if wanted is None else {n: tables[n] for n in wanted}


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row: rows that were resolved (own rows with a name, boards that touched a record) and rows for review only."""
    c, rows = F.col, tables["assigned"]
    board = is_board(c("source_type"), c("extraction_profile"))
    review = ~board & (c("provider_name") == "") & ((c("diagnoses_asd") == "yes") | (c("diagnoses_adhd") == "yes"))
    return rows.agg(F.count_if(~board & (c("provider_name") != "")).alias("resolved_count"), F.count_if(review).alias("review_only_count"))


def exact_copies(docs: DataFrame, key: str, value: str) -> DataFrame:
    """Each row with the least key among rows of an equal value, and their number."""
    digest = F.sha2(F.coalesce(F.col(value), F.lit("")), 256)
    groups = docs.groupBy(digest.alias("_d")).agg(F.min(key).alias("entity_id"), F.count("*").alias("members"))
    return docs.select(key, digest.alias("_d")).join(groups, "_d").select(key, "entity_id", "members")


def cascade(rows: DataFrame, lookups: list[tuple[DataFrame, list[str]]], default: str) -> DataFrame:
    """``rows`` with ``match``: the value of the first lookup (columns: its keys and ``value``) that has one, else the default.

    Each lookup is reduced to one row per key first, so rows are never multiplied.
    """
    found = []
    for i, (table, keys) in enumerate(lookups):
        one = table.groupBy(*keys).agg(F.min("value").alias(f"_m{i}"))
        rows = rows.join(one, keys, "left")
        found.append(F.col(f"_m{i}"))
    return rows.withColumn("match", F.coalesce(*found, F.lit(default))).drop(*(f"_m{i}" for i in range(len(lookups))))

