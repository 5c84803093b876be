"""Merkle fixity audit of WARC records in two replicas.

A replica's records are hashed; the ordered records of a range of ids are hashed, with their places
in the range, into a range node, those into the file's root, and files into groups up to the root of
the replica. Ranges are runs of ids and places count from the range's start, so a record that is
missing or added changes its own range only. An audit compares the roots and descends only into
branches that differ. Below a differing range, records are compared by what they are: the id, the
address, and which of several records of both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import before, each_copy, stored

#: Ids of a file and of a range, and files of a group; groups of groups grow by the same factor.
FILE_RECORDS = 1000
RANGE_RECORDS = 32
GROUP_FILES = 256
#: Files that records without an id are dealt to by address.
LOOSE_FILES = 1 << 20
#: Different records beyond which a file's records are also cut into slices by the first letters of their hash.
HOT_RECORDS = 16_384
SLICE_LETTERS = 3
#: The date of every record: pages have none, and the format wants one.
DATE = "1970-01-01T00:00:00Z"


def record_bytes(page_id: Column, url: Column, html: Column) -> Column:
    """The page as a WARC resource record, text; nulls count as empty."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(
        F.lit(f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Date: {DATE}\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n"))


def records(pages: DataFrame) -> DataFrame:
    """The different records of a replica, where they lie in their files, and their hashes.

    ``file``, ``range``, ``slice``, ``key`` (the id's text), ``page_id``, ``url``, ``leaf``,
    ``length``, ``n`` (equal records, one after the other), ``offset``. A file holds the pages of
    ``FILE_RECORDS`` neighbouring ids in order of id and hash; pages without an id are dealt to files
    below zero by their address. Null and empty addresses and texts are the same. An empty table
    gives no records. Equal rows are counted before they are shuffled, and a file of very many
    records is sorted slice by slice.
    """
    page_id, url, html = F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    text = F.encode(record_bytes(page_id, url, html), "UTF-8")
    address = F.coalesce(url, F.lit(""))
    place = F.pmod(F.xxhash64(address), F.lit(LOOSE_FILES * RANGE_RECORDS))
    hashed = pages.select(
        F.coalesce(F.floor(page_id / FILE_RECORDS).cast("long"), -1 - F.floor(place / RANGE_RECORDS).cast("long")).alias("file"),
        F.coalesce(F.floor(page_id / RANGE_RECORDS).cast("long"), F.pmod(place, F.lit(RANGE_RECORDS)).cast("long")).alias("range"),
        F.coalesce(page_id.cast("string"), F.lit("")).alias("key"), page_id.alias("page_id"), address.alias("url"),
        F.sha2(text, 256).alias("leaf"), F.length(text).cast("long").alias("length"),
    )
    counted = hashed.groupBy(*hashed.columns).agg(F.count("*").alias("n"))
    hot = counted.groupBy("file").count().where(F.col("count") > HOT_RECORDS).select("file", F.lit(True).alias("hot"))
    counted = counted.join(hot, "file", "left").withColumn("slice", F.when(F.col("hot"), F.substring("leaf", 1, SLICE_LETTERS)).otherwise("")).drop("hot")
    split = F.when(F.col("slice") == "", F.struct(F.lit(None).cast("long").alias("id"), F.lit("").alias("slice"))).otherwise(F.struct(F.col("page_id").alias("id"), F.col("slice")))
    laid = before(counted.withColumn("bytes", F.col("n") * F.col("length")), ["file"], split, ["page_id", "leaf"], "bytes")
    return laid.select("file", "range", "slice", "key", "page_id", "url", "leaf", "length", "n", F.col("before").alias("offset"))


def _parents(nodes: DataFrame, keys: list[str], child: Column) -> DataFrame:
    """Nodes over groups of children: the hash of the children's places, sizes and hashes in order."""
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(child.alias("c"), "size", "hash"))), lambda x: F.concat_ws(":", x["c"], x["size"].cast("string"), x["hash"])), "|")
    return nodes.groupBy(*keys).agg(F.sha2(joined, 256).alias("hash"), F.sum("size").alias("size"))


def tree(recs: DataFrame, kept: bool = False) -> dict[str, DataFrame]:
    """The levels of a replica's tree: ``range``, ``file``, ``group``, ``super`` and ``root``.

    A record's place in its range is the offset from the range's first record. No group of children
    is unbounded but those of the root, one for each ``GROUP_FILES`` squared files, i.e. for 65
    million ids. With ``kept`` all levels but the last two are written to the shared folder.
    """
    keep = (lambda df: stored(df, "tree")[0]) if kept else (lambda df: df)
    each = F.struct("page_id", "leaf", "length", "n", "offset")
    ordered = F.sort_array(F.collect_list(each))
    line = lambda x: F.concat_ws(":", x["page_id"].cast("string"), (x["offset"] - F.col("_all")[0]["offset"]).cast("string"), x["n"].cast("string"), x["leaf"])
    ranges = recs.groupBy("file", "range", "slice").agg(ordered.alias("_all"), F.sum(F.col("n") * F.col("length")).alias("size"))
    ranges = keep(ranges.select("file", "range", "slice", F.sha2(F.array_join(F.transform("_all", line), "|"), 256).alias("hash"), "size"))
    text = lambda c: F.col(c).cast("string")
    files = keep(_parents(ranges, ["file"], F.concat_ws("/", F.lpad(text("range"), 20, " "), "slice")).withColumn("group", F.floor(F.col("file") / GROUP_FILES).cast("long")))
    groups = keep(_parents(files, ["group"], text("file")).withColumn("super", F.floor(F.col("group") / GROUP_FILES).cast("long")))
    supers = _parents(groups, ["super"], text("group")).withColumn("root", F.lit(0))
    return {"range": ranges, "file": files, "group": groups, "super": supers, "root": _parents(supers, ["root"], text("super"))}


def _differing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of nodes that differ or stand in one tree only."""
    left, right = a.select(*keys, F.col("hash").alias("_a")), b.select(*keys, F.col("hash").alias("_b"))
    return left.join(right, keys, "full").where(~F.col("_a").eqNullSafe(F.col("_b"))).select(*keys)


_SAME = ["file", "key", "url"]


def audit(a: DataFrame, b: DataFrame) -> DataFrame:
    """Records that differ between two replicas: ``file``, ``key``, ``url``, ``leaf``, ``corrupt``, ``missing``, ``extra``.

    ``a`` and ``b`` have the columns of ``records``. Equal roots end the audit at once; otherwise each
    level is compared below differing parents only. Records of one id and address that both replicas
    hold alike are the same ones. What is left of ``a`` and of ``b`` is paired in order of hash:
    a pair is ``corrupt``, and stands under the hash in ``a``; the rest is ``missing`` (only in ``a``)
    or ``extra`` (only in ``b``). The three columns count such records of one hash.
    """
    # every level is written once, since the comparison reads it and the level above is made of it
    trees = {name: tree(recs, kept=True) for name, recs in (("a", a), ("b", b))}
    # differing keys are written at each level: they are read twice below, and few
    bad, _ = stored(_differing(trees["a"]["root"], trees["b"]["root"], ["root"]), "differing")
    if bad.isEmpty():
        return a.sparkSession.createDataFrame([], "file long, key string, url string, leaf string, corrupt long, missing long, extra long")
    levels = (("super", ["root"], ["super"]), ("group", ["super"], ["group"]), ("file", ["group"], ["file"]), ("range", ["file"], ["file", "range", "slice"]))
    for level, parent, keys in levels:
        parents = bad.select(*parent).distinct()
        bad, _ = stored(_differing(*(trees[t][level].join(parents, parent, "left_semi") for t in ("a", "b")), keys), "differing")
    sides = [r.join(bad, ["file", "range", "slice"], "left_semi").select(*_SAME, "leaf", F.col("n").alias(n)) for r, n in ((a, "n_a"), (b, "n_b"))]
    left = sides[0].join(sides[1], [*_SAME, "leaf"], "full").withColumn("left", F.coalesce("n_a", F.lit(0)) - F.coalesce("n_b", F.lit(0))).where("left <> 0")
    left, _ = stored(left.select(*_SAME, "leaf", (F.col("left") > 0).alias("in_a"), F.abs("left").alias("left")), "left")
    placed = before(left, [*_SAME, "in_a"], F.substring("leaf", 1, SLICE_LETTERS), ["leaf"], "left")
    totals = left.groupBy(*_SAME).agg(*(F.sum(F.when(F.col("in_a") == side, F.col("left")).otherwise(0)).alias(name) for side, name in ((True, "all_a"), (False, "all_b"))))
    paired = F.greatest(F.lit(0), F.least("left", F.least("all_a", "all_b") - F.col("before")))
    out = placed.join(totals, _SAME).select(
        *_SAME, "leaf", F.when(F.col("in_a"), paired).otherwise(0).alias("corrupt"),
        F.when(F.col("in_a"), F.col("left") - paired).otherwise(0).alias("missing"), F.when(F.col("in_a"), 0).otherwise(F.col("left") - paired).alias("extra"),
    )
    return out.where("corrupt + missing + extra > 0")


def damaged(pages: DataFrame, corrupt: int = 97, missing: int = 89, extra: int = 83) -> DataFrame:
    """A second replica for drills.

    The first letter of the html is overwritten in pages whose id is divisible by ``corrupt``; of the
    others, those divisible by ``missing`` are left out; those divisible by ``extra`` have a second
    record at their address with ``#copy``.
    """
    hit = (F.col("page_id") % corrupt == 0) & (F.length("html") > 0)
    lost = F.coalesce((F.col("page_id") % missing == 0) & (F.col("page_id") % corrupt != 0), F.lit(False))
    own = pages.where(~lost).withColumn("html", F.when(hit, F.concat(F.lit("#"), F.expr("substring(html, 2)"))).otherwise(F.col("html")))
    return own.union(pages.where(F.col("page_id") % extra == 0).withColumn("url", F.concat(F.coalesce("url", F.lit("")), F.lit("#copy"))))


def audited(pages: DataFrame, replica: DataFrame) -> DataFrame:
    """Every record of ``pages`` with the audit's finding against ``replica``, and the replica's extra records.

    ``page_id``, ``url``, ``warc_file``, ``record_offset``, ``record_length``, ``record_sha256``,
    ``status`` (``ok``, ``corrupt``, ``missing``, or ``extra``: offset and hash are the replica's).
    """
    a, _ = stored(records(pages), "records")
    b, _ = stored(records(replica), "records")
    found, _ = stored(audit(a, b), "found")
    keys = [*_SAME, "leaf"]
    none = {c: F.coalesce(c, F.lit(0)) for c in ("corrupt", "missing", "extra")}
    own = a.join(found, keys, "left").withColumns(none)
    ok = F.col("n") - F.col("corrupt") - F.col("missing")
    status = F.when(F.col("i") < ok, "ok").when(F.col("i") < ok + F.col("corrupt"), "corrupt").otherwise("missing")
    more = b.join(found.where("extra > 0"), keys).withColumn("offset", F.col("offset") + (F.col("n") - F.col("extra")) * F.col("length")).withColumn("n", F.col("extra"))
    more = more.select(*own.columns)
    out = each_copy(own, "leaf").withColumn("status", status).union(each_copy(more, "leaf").withColumn("status", F.lit("extra")))
    return out.select(
        "page_id", "url", F.col("file").alias("warc_file"), (F.col("offset") + F.col("i") * F.col("length")).alias("record_offset"), F.col("length").alias("record_length"),
        F.col("leaf").alias("record_sha256"), "status",
    )
