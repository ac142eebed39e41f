"""Mixing sources to target weights by systematic sampling.

Targets: the mix has ``SHARE`` percent of all words; sources, in the order of
their names with null last, weigh 3, 1, 2, repeating; no target exceeds
``MOST`` times its source's words, and what is cut off goes to the other
sources by weight until none is above.

Copies: a document's expected copies are its source's target over the source's
words, at most ``MOST``.  They are summed up in order within the source, one
offset per source is added, and a document is emitted once for every whole
number that its stretch of the sum crosses: the floor or the ceiling of its
expectation, and exactly the right number over the whole source.  Sums are
integers in units of 2^-24 copies, so they do not depend on how rows are dealt.
Documents are ordered by size class (about a tenth wide) and then by a digest
of their id: every class is sampled at the same rate, which keeps the words
taken near the target.  Of 16 evenly spread offsets, the first one a digest of
the source's name, each source takes the one whose words come nearest.

Every step is a DataFrame operation.  The table of sources has one row per
source; only it is ordered as a whole.  Documents are numbered in buckets, so
a source may hold any share of all rows.

Defined results: a null or empty text has no words and is never taken, also
in a source without any words (target 0); documents without a source form a
source of their own; repeated rows are documents of their own; a null doc_id
is ordered like an empty one; other columns are carried by ``resample`` and
not read by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.ranks import running
from tallyline.sources.stage import stage

WEIGHTS = (3, 1, 2)
SHARE = 150
MOST = 2
UNIT = 1 << 24
# Sources that a join may broadcast; with more it is a sort-merge join.
BROADCAST_SOURCES = 100_000
OFFSETS = 16
STEP = UNIT // OFFSETS
WORD = "[^\\x20\\x09-\\x0D]+"


def words(text: str = "text") -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, target) per source; ``sized`` has source and size."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    sources = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", place)
    )
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("place") % len(WEIGHTS) + 1)
    limit = MOST * F.col("source_size")
    # Sources reach their limit in the order of limit over weight; the rest share
    # what is left by weight.
    order = Window.orderBy(
        (limit / F.col("weight")).asc(), F.col("source").asc_nulls_last()
    )
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ratios = sources.withColumn("weight", weight).select(
        "*",
        (
            F.sum("source_size").over(Window.partitionBy()) * SHARE / F.lit(100.0)
            - F.coalesce(F.sum(limit).over(upto), F.lit(0))
        ).alias("left"),
        F.sum("weight").over(after).alias("weights"),
    )
    # The first source in that order whose share stays below its limit sets the level.
    below = F.col("left") * F.col("weight") <= limit * F.col("weights")
    level = F.min(
        F.when(below, F.struct((limit / F.col("weight")).alias("at"), F.col("left"), F.col("weights")))
    ).over(Window.partitionBy())
    shared = level["left"] * F.col("weight") / level["weights"]
    return ratios.select(
        "place",
        "source",
        "source_size",
        F.round(F.least(F.coalesce(shared, limit.cast("double")), limit.cast("double")), 6).alias(
            "target"
        ),
    )


def order_of(size: str = "size") -> Column:
    """Size class: bit length and the three bits after the first."""
    bits = F.length(F.bin(size))
    return (bits * 8 + F.expr(f"shiftright({size}, greatest(length(bin({size})) - 4, 0)) & 7")).cast(
        "int"
    )


def copies(sized: DataFrame, digits: int) -> DataFrame:
    """``sized`` (written: source, size, doc_id, ...) with target and copies."""
    aims = targets(sized.select("source", "size"))
    expected = F.when(
        F.col("source_size") > 0,
        F.round(F.least(F.col("target") / F.col("source_size"), F.lit(float(MOST))) * UNIT),
    ).otherwise(0).cast("bigint")
    aims = stage(aims.withColumn("units", expected).select("*", F.col("source").alias("_source")), "mix-aims")
    few = aims.count() <= BROADCAST_SOURCES
    aimed = sized.join(
        F.broadcast(aims.drop("source")) if few else aims.drop("source"),
        F.col("source").eqNullSafe(F.col("_source")),
    ).drop("_source")
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    placed = aimed.withColumn("digest", digest).withColumn(
        "bucket", F.concat_ws(".", F.lpad(order_of().cast("string"), 4, "0"), F.substring("digest", 1, digits))
    )
    summed = running(
        placed.where("size > 0"), ["place"], "bucket", ["digest", "size"], F.col("units"), "before"
    )
    summed = stage(summed, "mix-sums")
    name = F.md5(F.coalesce("source", F.lit("")).cast("binary"))
    shifts = aims.select(
        "place",
        "target",
        F.conv(F.substring(name, 1, 6), 16, 10).cast("bigint").alias("shift"),
    )
    crossed = f"(before + shift + units) div {UNIT} - (before + shift) div {UNIT}"
    # Words each offset would take, per source: pre-aggregated, one row per source.
    tried = summed.join(F.broadcast(shifts) if few else shifts, ["place", "target"]).groupBy("place").agg(
        F.first("target").alias("target"),
        F.first("shift").alias("shift"),
        *(
            F.sum(F.col("size") * F.expr(crossed.replace("shift", f"(shift + {i * STEP})"))).alias(f"t{i}")
            for i in range(OFFSETS)
        ),
    )
    nearest = F.least(
        *(
            F.struct(F.abs(F.col(f"t{i}") - F.col("target")).alias("off"), F.lit(i).alias("i"))
            for i in range(OFFSETS)
        )
    )
    chosen = tried.select("place", (F.col("shift") + nearest["i"] * STEP).alias("shift"))
    taken = summed.join(F.broadcast(chosen) if few else chosen, "place").withColumn(
        "copies", F.expr(crossed)
    )
    none = placed.where("size = 0").withColumn("copies", F.lit(0).cast("bigint"))
    inner = ["place", "digest", "bucket", "units", "before", "shift"]
    return taken.drop(*inner).unionByName(none.drop(*inner))


def digits_for(rows: int) -> int:
    """Hexadecimal digits that cut a size class into buckets of bounded size."""
    digits = 2
    while rows >> (4 * digits) > 100_000:
        digits += 1
    return digits


def mix(docs: DataFrame) -> DataFrame:
    """Per document: size, its source's size and target, and the words taken."""
    sized = stage(docs.select("doc_id", "source", words().alias("size")), "mix-sized")
    return copies(sized, digits_for(sized.count())).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        F.col("copies"),
    )


def resample(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns."""
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    sized = stage(
        docs.select(
            F.monotonically_increasing_id().alias("uid"),
            F.struct(*own).alias("doc"),
            "doc_id",
            "source",
            words().alias("size"),
        ),
        "mix-docs",
    )
    slim = sized.select("uid", "doc_id", "source", "size")
    taken = copies(slim, digits_for(sized.count())).where("copies > 0").select("uid", "copies")
    repeated = (
        sized.select("uid", "doc")
        .join(taken, "uid")
        .select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    )
    return repeated.select([F.col(f"doc.c{i}").alias(c) for i, c in enumerate(docs.columns)])
