"""Mixing sources to target weights over fixed-length blocks of words.

Each source's documents are laid end to end and cut into blocks. Output shards draw multinomial
source counts; the slots of a source are numbered through all shards, and slot ``k`` takes the
block that the source's pseudorandom permutation of the current pass maps it to. Slots and blocks
are joined by index. A source's last slot takes only the words that are left to its target.
"""

from __future__ import annotations

from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import before, each_copy, fresh, own_columns, stored

WORD = r"[^\x20\x09-\x0D]+"
#: Words of a block, weights by a source's place in code point order, and how often a document may be taken.
BLOCK_WORDS = 512
WEIGHTS = (1, 2, 3)
REPEATS = 3
SEED = 20_240_607
#: Blocks of an output shard, or more: shards grow so that the driver draws at most DRAWS counts.
SHARD_BLOCKS = 256
DRAWS = 2_000_000
#: Rows of one prefix-sum chunk, on average.
CHUNK_ROWS = 4096


def words(text: Column) -> Column:
    """How many words a text has; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> dict[str | None, float]:
    """Targets that share the total size by weight, none above ``repeats`` times its source's size.

    Sources count by code point, null last. Caps are met in order of size over weight, which gives
    the fixed point of resharing the excess until no source is above its cap.
    """
    order = sorted(sizes, key=lambda s: (s is None, s.encode("utf-8", "surrogatepass") if s is not None else b""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_weight = float(sum(sizes.values())), sum(weight.values())
    out: dict[str | None, float] = {}
    for s in sorted(order, key=lambda s: (sizes[s] / weight[s], order.index(s) if len(order) < 1000 else 0)):
        out[s] = min(float(repeats * sizes[s]), left * weight[s] / open_weight)
        left -= out[s]
        open_weight -= weight[s]
    return {s: out[s] for s in order}


def _affine(source: int, turn: int, n: int) -> tuple[int, int]:
    """Multiplier (coprime to n) and shift of a source's permutation in one pass over its n blocks."""
    rng = np.random.default_rng([SEED, source, turn])
    step = int(rng.integers(1, max(n, 2)))
    # a multiplier near the golden section spreads neighbouring slots, the draw makes it the source's own
    step = (step * 2 + int(n * 0.6180339887)) % n or 1
    while gcd(step, n) != 1:
        step += 1
    return step % n, int(rng.integers(0, n))


def plan(sizes: dict[str | None, int], block: int = BLOCK_WORDS, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, seed: int = SEED) -> tuple[pd.DataFrame, dict]:
    """Slot ranges by source, pass and shard, and each source's targets.

    Columns: ``s`` (source's place), ``turn``, ``shard``, ``first`` and ``last`` (slots of the
    pass), ``n`` (blocks), ``step`` and ``shift`` (permutation), ``short_slot`` and ``short_words``
    (the slot that takes only some words, -1 for none). The driver holds a few rows for each source.
    """
    aims = targets(sizes, weights, repeats)
    passes: list[dict] = []
    slots = np.zeros(len(aims), np.int64)
    for s, (name, aim) in enumerate(aims.items()):
        size, want = sizes[name], int(round(aim))
        if not size or not want:
            continue
        n = -(-size // block)
        for turn in range(-(-want // size)):
            step, shift = _affine(s, turn, n)
            left = want - turn * size
            if left >= size:
                passes.append({"s": s, "turn": turn, "n": n, "slots": n, "step": step, "shift": shift, "short_slot": -1, "short_words": 0})
                slots[s] += n
                continue
            # the slot at which the source's last, shorter block comes
            place = (n - 1 - shift) * pow(step, -1, n) % n if n > 1 else 0
            missing = n * block - size
            full = left // block
            if full > place:
                full = (left + missing) // block
                rest = left + missing - full * block
                if full <= place:  # the target ends within the short block's slot
                    full, rest = place, left - place * block
            else:
                rest = left - full * block
                if full == place and rest >= block - missing:
                    full, rest = full + 1, rest - (block - missing)
            passes.append({"s": s, "turn": turn, "n": n, "slots": full + (rest > 0), "step": step, "shift": shift, "short_slot": full if rest else -1, "short_words": rest})
            slots[s] += full + (rest > 0)
    total = int(slots.sum())
    shards = int(max(1, min(DRAWS // max(len(aims), 1), -(-total // SHARD_BLOCKS))))
    ranges = []
    rng, left = np.random.default_rng(seed), slots.copy()
    starts = np.zeros(len(aims), np.int64)
    by_source: dict[int, list[dict]] = {}
    base = 0
    for p in passes:
        p["base"] = base = 0 if p["turn"] == 0 else base
        base += p["slots"]
        by_source.setdefault(p["s"], []).append(p)
    for shard in range(shards):
        room = -(-int(left.sum()) // (shards - shard))
        # counts of sources in this shard: multinomial by what each has left, what exceeds it is drawn again
        drawn = np.zeros_like(left)
        while (more := room - int(drawn.sum())) > 0:
            rest = left - drawn
            drawn += np.minimum(rng.multinomial(more, rest / rest.sum()), rest)
        for s in np.flatnonzero(drawn):
            a, b = int(starts[s]), int(starts[s] + drawn[s])
            for p in by_source[int(s)]:
                lo, hi = max(a, p["base"]), min(b, p["base"] + p["slots"])
                if lo < hi:
                    ranges.append({k: p[k] for k in ("s", "turn", "n", "step", "shift", "short_slot", "short_words")} | {"shard": shard, "first": lo - p["base"], "last": hi - 1 - p["base"]})
        starts += drawn
        left -= drawn
    names = ["s", "turn", "shard", "first", "last", "n", "step", "shift", "short_slot", "short_words"]
    return pd.DataFrame(ranges, columns=names).astype("int64"), {"targets": aims, "slots": slots, "shards": shards}


def slots(spark, ranges: pd.DataFrame) -> DataFrame:
    """One row per slot: ``s``, ``turn``, ``shard``, ``k``, ``block`` by the permutation, ``only`` (words it takes; null: all)."""
    columns = "s long, turn long, shard long, first long, last long, n long, step long, shift long, short_slot long, short_words long"
    k = F.explode(F.sequence("first", "last"))
    # the product of step and slot may pass 64 bits, so it is taken in decimals
    place = ((F.col("k").cast("decimal(19,0)") * F.col("step").cast("decimal(18,0)") + F.col("shift")) % F.col("n")).cast("long")
    return spark.createDataFrame(ranges, columns).withColumn("k", k).select(
        "s", "turn", "shard", "k", place.alias("block"), F.when(F.col("k") == F.col("short_slot"), F.col("short_words")).alias("only")
    )


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _laid(docs: DataFrame, block: int, weights: tuple[int, ...], repeats: int, seed: int = SEED) -> tuple[DataFrame, DataFrame, pd.DataFrame, dict]:
    """Documents where they lie in their source, their pieces by block, the slots' ranges, and the sizes of the sources in order.

    Rows equal in id, source and text are counted before they are laid out, so they are never sorted
    in one task; ``i`` numbers them.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), _text_hash().alias("text_hash"), words(F.col("text").cast("string")).alias("size"))
    rows, _ = stored(rows.groupBy(*rows.columns).agg(F.count("*").alias("n")), "sizes")
    per_source = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("size"), F.count("*").alias("rows")).collect()
    sizes = {r["source"]: int(r["size"]) for r in per_source}
    ranges, facts = plan(sizes, block, weights, repeats, seed)
    names = [(i, name, sizes[name], float(aim)) for i, (name, aim) in enumerate(facts["targets"].items())]
    sources = spark.createDataFrame(names, "s long, source_name string, source_size long, target double")
    chunks = max(1, -(-sum(r["rows"] for r in per_source) // CHUNK_ROWS))
    placed = rows.join(sources, F.col("source").eqNullSafe(F.col("source_name"))).drop("source_name")
    placed = before(placed.withColumn("words", F.col("n") * F.col("size")), ["s"], F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(chunks)), ["doc_id", "text_hash"], "words")
    placed = each_copy(placed, "doc_id", "text_hash").withColumn("offset", F.col("before") + F.col("i") * F.col("size"))
    placed, _ = stored(placed.withColumn("row", F.monotonically_increasing_id()).drop("before", "words", "n"), "offsets")
    first, last = F.floor(F.col("offset") / block), F.floor((F.col("offset") + F.col("size") - 1) / block)
    piece_start = F.greatest("offset", F.col("block") * block)
    piece_end = F.least(F.col("offset") + F.col("size"), (F.col("block") + 1) * block)
    pieces = placed.where("size > 0").withColumn("block", F.explode(F.sequence(first, last))).select(
        "s", "block", "row", (piece_start - F.col("offset")).alias("from"), (piece_end - piece_start).alias("length"), (piece_start - F.col("block") * block).alias("at")
    )
    return placed, pieces, ranges, {s: sizes[name] for s, name, _, _ in names}


def mix(docs: DataFrame, block: int = BLOCK_WORDS, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """What the mix takes of each document.

    ``doc_id``, ``source``, ``text_hash``, ``i`` (number among rows equal in these), ``size``,
    ``source_size``, ``target``, ``taken`` (words, repeats counted), ``full_takes`` (whole passes),
    ``first_shard`` and ``last_shard`` (the output shards that the draw puts its blocks in lie between
    these; null if none) and
    ``parts`` (array of ``from``, ``to``: word ranges of the last, partial pass), one row per row of
    ``docs``. ``packed`` gives the blocks themselves.

    Sizes are counts of runs without ASCII white space; null and empty texts have size 0 and nothing
    is taken of them. Null sources are one source, the last. Repeated rows are laid out one after
    the other. An empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    placed, pieces, ranges, sizes = _laid(docs, block, weights, repeats, seed)
    # how often and how far each block is taken
    turns = [(int(s), int(g["turn"].nunique()), int(sizes[int(s)])) for s, g in ranges.groupby("s")]
    taken = slots(spark, ranges).groupBy("s", "block").agg(F.count(F.when(F.col("only").isNull(), 1)).alias("times"), F.coalesce(F.max("only"), F.lit(0)).alias("only"), F.min("shard").alias("shard"), F.max("shard").alias("far"))
    joined = pieces.join(taken, ["s", "block"]).withColumn("part", F.greatest(F.lit(0), F.least("length", F.col("only") - F.col("at"))))
    totals = spark.createDataFrame(turns, "s long, turns long, total long")
    passes = totals.join(placed.groupBy("s").agg(F.max("target").alias("target")), "s").select("s", F.floor(F.round("target") / F.col("total")).cast("long").alias("full"))
    joined = joined.join(passes, "s").withColumn("extra", F.when(F.col("times") > F.col("full"), F.col("length")).otherwise(F.col("part")))
    got = joined.groupBy("row").agg(
        F.sum(F.col("times") * F.col("length") + F.col("part")).alias("taken"), F.first("full").alias("full"), F.min("shard").alias("first_shard"), F.max("far").alias("last_shard"),
        F.sort_array(F.collect_list(F.when(F.col("extra") > 0, F.struct(F.col("from").alias("from"), (F.col("from") + F.col("extra")).alias("to"))))).alias("parts"),
    )
    none = F.array().cast("array<struct<from:bigint,to:bigint>>")
    return placed.join(got, "row", "left").select(
        "doc_id", "source", "text_hash", "i", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"),
        F.coalesce("full", F.lit(0)).alias("full_takes"), F.coalesce("parts", none).alias("parts"), "first_shard", "last_shard",
    )


def packed(docs: DataFrame, block: int = BLOCK_WORDS, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """The mix itself, packed: ``shard``, ``source``, ``turn``, ``slot``, ``n_words``, ``text`` (words joined by blanks).

    A slot holds ``block`` words, but for a source's last block and its target's last slot. The
    words of all slots are those that ``mix`` counts.
    """
    placed, pieces, ranges, _ = _laid(docs, block, weights, repeats)
    keys = ["doc_id", "source", "text_hash"]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), _text_hash().alias("text_hash"), F.col("text").cast("string").alias("text"))
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.text_hash") == F.col("b.text_hash"))
    # a piece's words are cut once from its text, then dealt to the slots that take its block
    words_of = pieces.join(placed.select("row", *keys), "row").alias("a").join(texts.dropDuplicates(keys).alias("b"), same)
    all_words = F.regexp_extract_all(F.col("text"), F.lit(f"({WORD})"), F.lit(1))
    cut = words_of.select("s", "block", "at", "a.source", F.slice(all_words, (F.col("from") + 1).cast("int"), F.col("length").cast("int")).alias("words"))
    limit = F.coalesce(F.col("only") - F.col("at"), F.lit(block)).cast("int")
    dealt = cut.join(slots(docs.sparkSession, ranges), ["s", "block"]).where(limit > 0).withColumn("words", F.slice("words", F.lit(1), limit))
    slot = dealt.groupBy("shard", "s", "turn", "k").agg(F.first("source").alias("source"), F.sort_array(F.collect_list(F.struct("at", "words"))).alias("pieces"))
    all_pieces = F.flatten(F.transform("pieces", lambda x: x["words"]))
    return slot.select("shard", "source", "turn", F.col("k").alias("slot"), F.size(all_pieces).alias("n_words"), F.array_join(all_pieces, " ").alias("text"))


def mixed_documents(docs: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """The documents that the mix takes, with all columns of ``docs``.

    A document is repeated for each whole pass that takes it, its text unchanged; what the last,
    partial pass takes of it follows as one more row whose text is the taken words, joined by blanks,
    with ``n_chars`` set to its length where that column exists. Documents without words, of which
    nothing can be taken, are left out. Rows equal in id, source and text are told apart by their
    other columns, so reruns agree.
    """
    names = fresh(docs, "_mix_id", "_mix_source", "_mix_hash", "_mix_n", "_mix_full", "_mix_parts", "_mix_size", "_mix_part")
    key_id, key_source, key_hash, number, full, parts, size, part = names
    keys = {key_id: F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), key_source: F.coalesce(F.col("source").cast("string"), F.lit(""))}
    marks = mix(docs, block)
    marks = marks.select(
        *(c.alias(k) for k, c in keys.items()), F.col("text_hash").alias(key_hash), F.col("i").alias(number), F.col("full_takes").alias(full), F.col("parts").alias(parts), F.col("size").alias(size)
    )
    rows, by = docs.withColumns(keys | {key_hash: _text_hash()}), [key_id, key_source, key_hash]
    if not marks.groupBy(*by).count().where("count > 1").isEmpty():
        # equal rows meet by their number; a null and an empty source, or a null id and -1, may share a key, so marks are numbered anew
        marks = _numbered(marks, by, number, F.xxhash64(full, F.to_json(F.struct(parts)), number))
        rows = _numbered(rows, by, number, F.xxhash64(F.to_json(F.struct(*own_columns(docs)))))
        by = [*by, number]
    else:
        marks = marks.drop(number)
    rows = rows.join(marks.where((F.col(full) > 0) | (F.size(parts) > 0)), by)
    copies = F.concat(
        F.array_repeat(F.array().cast("array<struct<from:bigint,to:bigint>>"), F.col(full).cast("int")),
        F.when(F.size(parts) > 0, F.array(parts)).otherwise(F.array().cast("array<array<struct<from:bigint,to:bigint>>>")),
    )
    rows = rows.withColumn(part, F.explode(copies))
    whole = (F.size(part) == 0) | (F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x["to"] - x["from"]) == F.col(size))
    all_words = F.regexp_extract_all(F.col("text"), F.lit(f"({WORD})"), F.lit(1))
    cut = F.array_join(F.flatten(F.transform(part, lambda x: F.slice(all_words, (x["from"] + 1).cast("int"), (x["to"] - x["from"]).cast("int")))), " ")
    out = rows.withColumn("text", F.when(whole, F.col("text")).otherwise(cut))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*own_columns(docs))


def _numbered(df: DataFrame, keys: list[str], number: str, order: Column) -> DataFrame:
    """``df`` with each row's number, from 0, among the rows of its ``keys`` in order of a hash; rows alike in that are dealt to 1024 splits."""
    own = own_columns(df.drop(number))
    names = [f"k{i}" for i in range(len(keys))]
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(1024))
    cut = df.select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), F.struct(*own).alias("row"), order.alias("h"), salt.alias("salt"), F.lit(1).alias("one"))
    return before(cut, names, F.struct(F.shiftright("h", 52).alias("h"), "salt"), ["h"], "one").select("row.*", F.col("before").alias(number))
