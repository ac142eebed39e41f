"""Shards by balanced label propagation over document links.

Law ``rows``: every shard holds floor(n / shards) or one more rows.  Documents
with equal texts are linked, and few of those links should be cut.

1. Documents with a copy get a hub: the first document with the same text.  A
   group larger than half a shard is cut into parts with a hub each, so a text
   that fills a third of the table spreads over as many shards as it needs.
2. Labels start as a hash of the document.  In each round linked documents
   read their neighbours' labels through a join and wish for the shard that
   most of them have.  A document follows only neighbours that come before it,
   so two documents never swap for ever.
3. Wishes are granted under quotas: a shard admits what fits besides the
   linked documents that are in it already.  Wishes are counted in bins that
   keep a hub's followers together, and whole bins are admitted in order.
4. At the end a shard keeps as many linked documents as it has places; all
   others are ranked and fill the free places in order of their hub, so that
   what is left of a group stays together.

Nothing but one row per shard or per shard and bin goes through one task, and
only the shards' free places reach the driver.  All steps are DataFrame
operations; each round is written to the shared folder and read again.

Defined results: a null text has size 1 and the checksum of the empty text, and
is linked with nothing, while empty texts are equal to each other; repeated
rows and repeated doc_ids are documents of their own; other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.ranks import bucket_count, running
from tallyline.sources.stage import stage

BINS = 2048
SPLIT = 32


def vertices(docs: DataFrame) -> DataFrame:
    """One slim row per document: row number, size, checksum, text digest."""
    return docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("text_crc32"),
        F.md5(F.col("text").cast("binary")).alias("digest"),
    )


def links(docs: DataFrame, most: int) -> DataFrame:
    """(uid, hub) of every document with a copy; at most about ``most`` share a hub."""
    # Written, so that the join below has exchanges of its own and can split a hot text.
    groups = stage(
        docs.where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", F.ceil(F.col("n") / F.lit(max(most, 1))).alias("parts")),
        "shard-groups",
    )
    linked = (
        docs.select("uid", "digest")
        .join(groups, "digest")
        .withColumn("part", F.pmod(F.xxhash64("uid"), F.col("parts")))
    )
    hubs = linked.groupBy("digest", "part").agg(F.min("uid").alias("hub"))
    return linked.join(hubs, ["digest", "part"]).select("uid", "hub")


def admitted(wishes: DataFrame, room: DataFrame) -> DataFrame:
    """The (shard, bin) pairs whose wishes fit into the shards' room."""
    order = Window.partitionBy("shard").orderBy("bin")
    counts = wishes.groupBy("shard", "bin").agg(F.count(F.lit(1)).alias("n"))
    return (
        counts.withColumn("upto", F.sum("n").over(order))
        .join(F.broadcast(room), "shard")
        .where("upto <= room")
        .select("shard", "bin")
    )


def propagate(labels: DataFrame, edges: DataFrame, places: DataFrame) -> DataFrame:
    """One round: (uid, hub, shard) after granting the wishes that fit."""
    votes = (
        edges.join(labels.select(F.col("uid").alias("to"), "shard"), "to")
        .groupBy("uid", "shard")
        .agg(F.count(F.lit(1)).alias("votes"))
        .groupBy("uid")
        .agg(F.max(F.struct("votes", (-F.col("shard")).alias("minus"))).alias("best"))
        .select("uid", (-F.col("best.minus")).alias("wish"))
    )
    wishing = labels.join(votes, "uid", "left").withColumn(
        "moves", F.coalesce(F.col("wish") != F.col("shard"), F.lit(False))
    )
    settled = wishing.where("NOT moves").groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    room = places.join(settled, "shard", "left").select(
        "shard", (F.col("places") - F.coalesce("n", F.lit(0))).alias("room")
    )
    asked = wishing.where("moves").select(F.col("wish").alias("shard"), bin_of("hub"))
    granted = admitted(asked, room).select(F.col("shard").alias("wish"), "bin", F.lit(1).alias("ok"))
    return (
        wishing.withColumn("bin", bin_of("hub"))
        .join(F.broadcast(granted), ["wish", "bin"], "left")
        .select(
            "uid",
            "hub",
            F.when(F.col("moves") & (F.col("ok") == 1), F.col("wish"))
            .otherwise(F.col("shard"))
            .alias("shard"),
        )
    )


def bin_of(name: str):
    return F.pmod(F.xxhash64(name), F.lit(BINS)).alias("bin")


def shard(docs: DataFrame, shards: int = 16, rounds: int = 3) -> DataFrame:
    """Every document's shard and its slot there."""
    spark = docs.sparkSession
    all_docs = stage(vertices(docs), "shard-docs")
    total = all_docs.count()
    buckets = bucket_count(total)
    places = spark.range(shards).select(
        F.col("id").cast("int").alias("shard"),
        F.expr(f"{total // shards} + CASE WHEN id < {total % shards} THEN 1 ELSE 0 END").alias(
            "places"
        ),
    )
    linked = stage(links(all_docs, total // shards // 2), "shard-links")
    edges = linked.where("uid != hub").select("uid", F.col("hub").alias("to"))
    labels = linked.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int"))
    for _ in range(rounds):
        labels = stage(propagate(labels, edges, places), "shard-labels")

    hubs = labels.where("uid = hub").select("hub", F.col("shard").alias("hub_shard"))
    joined = labels.join(hubs, "hub").where("shard = hub_shard").select("uid", "hub", "shard")
    joined = joined.withColumn("bin", bin_of("hub"))
    fits = admitted(joined, places.withColumnRenamed("places", "room"))
    keeps = stage(joined.join(F.broadcast(fits), ["shard", "bin"]).select("uid", "shard"), "shard-keeps")
    free = (
        places.join(keeps.groupBy("shard").agg(F.count(F.lit(1)).alias("n")), "shard", "left")
        .select("shard", (F.col("places") - F.coalesce("n", F.lit(0))).alias("free"))
        .orderBy("shard")
        .collect()
    )
    rest = stage(
        all_docs.join(keeps, "uid", "left_anti")
        .join(linked, "uid", "left")
        .select(
            "uid",
            F.coalesce("hub", "uid").alias("near"),
            # A hub's followers share neighbouring buckets, not one.
            (
                F.pmod(F.xxhash64(F.coalesce("hub", "uid")), F.lit(buckets)) * SPLIT
                + F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(SPLIT))
            ).alias("bucket"),
        ),
        "shard-rest",
    )
    filled = running(rest, [], "bucket", ["near", "uid"], F.lit(1), "place")
    upto, test = 0, F
    for row in free:
        upto += row["free"]
        inside = F.col("place") < upto
        test = test.when(inside, F.lit(row["shard"]))
    placed = stage(
        keeps.unionByName(filled.select("uid", test.alias("shard"))).withColumn(
            "bucket", F.pmod(F.xxhash64("uid", F.lit(2)), F.lit(buckets))
        ),
        "shard-placed",
    )
    slots = running(placed, ["shard"], "bucket", ["uid"], F.lit(1), "slot")
    return all_docs.join(slots, "uid").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
