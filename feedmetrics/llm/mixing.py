"""Mixing sources to target weights: Sainte-Laguë quotas of equal blocks of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmetrics.llm.base import WORD, staged, text_of


def _digits(text: Column) -> Column:
    """60 bits of the MD5 of a text, as a bigint."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def targets(sources: DataFrame, total: int, cap: int) -> DataFrame:
    """sources(source, source_size, weight) with ``target``: shares of ``total`` by weight, at most cap x size.

    Sources fill up in the order of cap * size / weight, so the full ones are
    the first of that order. ``level`` is what a unit of weight gets if exactly
    the sources before this one are full; the first source that can take its
    share at that level, and all after it, are not full.
    """
    full = F.lit(cap) * F.col("source_size")
    before = Window.orderBy(full / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(
        Window.unboundedPreceding, -1)
    after = Window.orderBy(full / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(
        0, Window.unboundedFollowing)
    left = F.lit(total).cast("bigint") - F.coalesce(F.sum(full).over(before), F.lit(0))
    leveled = sources.withColumn("level", left / F.sum("weight").over(after))
    leveled = leveled.withColumn("is_full", F.col("level") * F.col("weight") >= full)
    level = F.max(F.when(~F.col("is_full"), F.col("level"))).over(Window.partitionBy())
    share = F.when(F.col("is_full"), full.cast("double")).otherwise(level * F.col("weight"))
    return leveled.withColumn("target", share).drop("level", "is_full")


def apportion(parties: DataFrame, group: list[str], order: list[Column], votes: str, seats: str) -> DataFrame:
    """``parties`` with ``quota``: the seats of each group dealt by highest quotient votes / (2k + 1).

    Which seats are dealt is not enumerated. A party ends within
    fair share * parties / (2 * seats) + 1 of its fair share, so it has the
    seats below that range for certain, and only those inside compete: about
    three a party. Ties go by ``order``. A group without votes deals no seat.
    """
    own = Window.partitionBy(*group)
    sums = parties.withColumn("__votes", F.sum(votes).over(own)).withColumn("__parties", F.count(F.lit(1)).over(own))
    fair = F.when((F.col("__votes") > 0) & (F.col(seats) > 0), F.col(votes) * F.col(seats) / F.col("__votes"))
    sums = sums.withColumn("__fair", F.coalesce(fair, F.lit(0.0)))
    slack = F.col("__fair") * F.col("__parties") / (2 * F.greatest(F.col(seats), F.lit(1))) + 1
    sums = sums.withColumn("__low", F.greatest(F.lit(0), F.floor(F.col("__fair") - slack)).cast("bigint"))
    sums = sums.withColumn("__high", F.ceil(F.col("__fair") + slack).cast("bigint"))
    sums = sums.withColumn("__open", F.when(F.col("__votes") > 0, F.col(seats)).otherwise(0)
                           - F.sum("__low").over(own))
    seat = sums.withColumn("__seat", F.explode(F.sequence("__low", "__high")))
    quotient = F.col(votes) / (2 * F.col("__seat") + 1)
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(quotient.desc(), *order))
    won = (F.col("__rank") <= F.col("__open")) & (F.col(votes) > 0)
    kept = [F.first(F.col(c)).alias(c) for c in parties.columns if c not in group and c not in ("source", "shard")]
    keys = list(dict.fromkeys([*group, *[c for c in ("source", "shard") if c in parties.columns]]))
    return seat.withColumn("__rank", rank).groupBy(*keys).agg(
        *kept, (F.first("__low") + F.count_if(won)).alias("quota"))


def mix(docs: DataFrame, weights: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        source_column: str = "source", cap: int = 3, block_words: int = 16, shard_docs: int = 5_000,
        seed: int = 1, carry: bool = False, shard_words: int = 16_000) -> DataFrame:
    """Decides how many words of each document a mix by source weights takes.

    ``weights`` (source, weight) names every source once, null being one of
    them; weights are above zero. The mix has as many words as the documents.
    Returns doc_id, source, size, source_size, target, taken for every row, and
    with ``carry`` the whole row as the struct ``row``.

    The words are dealt in blocks of ``block_words``: quotas by Sainte-Laguë
    first to the sources by their targets, then to each source's shards by their
    words. Shards hold about ``shard_docs`` documents of all sources by a hash
    of the id, so no window holds a whole source. A source has as many of them
    as leave it ``shard_words`` words in each, or ``shard_docs`` documents of its
    own, and one at least: a small source is not dealt into shards with less
    than a block. A shard's documents, in seeded hash order, are repeated end to
    end; its quota is a run of blocks that begins at a seeded block. A run of at
    most cap times the shard's words takes no word more than cap times; the last
    block ends there, and a source at its cap is taken whole.

    A text without words, or null, has size 0 and is never taken. Rows that
    repeat an id are separate documents; if they also agree in size, source and
    text they are interchangeable. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    picked = [F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{source_column}`").alias("source"),
              F.regexp_count(text_of(f"`{text_column}`"), F.lit(WORD)).cast("bigint").alias("size")]
    if carry:
        picked.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = staged(spark, docs.select(*picked), "mix-rows")
    # Staged, so that its size is known and the rows need not be shuffled to meet it.
    sizes = staged(spark, rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"),
                                                     F.count_if(F.col("size") > 0).alias("docs")), "mix-sources")
    count, total = sizes.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    shards_each, blocks = -(-count // shard_docs) or 1, (2 * total + block_words) // (2 * block_words)

    most = F.greatest(F.expr(f"(docs + {shard_docs - 1}) div {shard_docs}"), F.expr(f"source_size div {shard_words}"),
                      F.lit(1))
    own = sizes.select(F.col("source").alias("__source"), F.least(most, F.lit(shards_each)).alias("__shards"))
    rows = rows.join(own, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    digest = F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    # Texts without words are never taken; they lie in shards without words, as many as the table has.
    rows = rows.withColumn("shard", F.when(F.col("size") > 0, number % F.col("__shards"))
                           .otherwise(-1 - number % shards_each)).drop("__shards")
    rows = rows.withColumn("place", F.substring(digest, 9, 24))

    shards = rows.groupBy("source", "shard").agg(F.sum("size").alias("words"))
    sources = sizes.select("source", "source_size")
    named = weights.select(F.col("source").alias("__source"), F.col("weight").cast("bigint").alias("weight"))
    sources = sources.join(named, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    sources = targets(sources, total, cap).withColumn("__blocks", F.lit(blocks).cast("bigint"))
    by_name = [F.col("source").isNull(), F.col("source")]
    quotas = apportion(sources, [], by_name, "target", "__blocks").select(
        F.col("source").alias("__source"), "source_size", "target",
        F.least("quota", F.expr(f"({cap} * source_size + {block_words - 1}) div {block_words}")).alias("source_quota"))
    shards = shards.join(quotas, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    shards = apportion(shards, ["source"], [F.col("shard")], "words", "source_quota")
    named_shard = F.concat_ws("/", F.lit(str(seed)), F.col("source").isNull().cast("int").cast("string"),
                              F.coalesce("source", F.lit("")), F.col("shard").cast("string"))
    begin = _digits(named_shard) % F.greatest(F.expr(f"(words + {block_words - 1}) div {block_words}"), F.lit(1))
    full = F.lit(cap) * F.col("words")
    run = F.when(F.col("target") >= F.lit(cap) * F.col("source_size"), full).otherwise(
        F.least(F.col("quota") * block_words, full))
    runs = shards.select(
        F.col("source").alias("__source"), F.col("shard").alias("__shard"), "source_size", "target", "words",
        (begin * block_words).alias("begin"), run.alias("run"))

    stream = Window.partitionBy("source", "shard").orderBy("place", "doc_id", "size")
    ends = rows.withColumn("end", F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0)))
    joined = ends.join(runs, F.col("source").eqNullSafe(F.col("__source")) & (F.col("shard") == F.col("__shard")))

    def up_to(position: str) -> str:
        """SQL for the words of this document before a position of the repeated stream."""
        return (f"({position}) div words * size + "
                f"least(greatest(({position}) % words - (end - size), 0), size)")

    taken = F.when(F.col("words") > 0, F.expr(f"{up_to('begin + run')} - ({up_to('begin')})")).otherwise(0)
    return joined.select("doc_id", "source", "size", "source_size", "target", taken.cast("bigint").alias("taken"),
                         *(["row"] if carry else []))


def cyclic_weights(docs: DataFrame, cycle: tuple[int, ...], source_column: str = "source") -> DataFrame:
    """(source, weight): the sources by code point, null last, weigh ``cycle`` over and over.

    One row for each source, so the numbering fits one task: it is the table of
    weights that a user writes by hand.
    """
    names = docs.select(F.col(f"`{source_column}`").alias("source")).distinct()
    number = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, cycle)), (number % len(cycle) + 1).cast("int"))
    return names.select("source", weight.alias("weight"))


def mixed_documents(docs: DataFrame, weights: DataFrame, **options) -> DataFrame:
    """The mix as whole documents: each row as often as its taken words make it whole.

    Only the two documents where a shard's run begins and ends are taken in part.
    A seeded draw by id takes or leaves such a part with the chance of its share,
    so the words taken of small sources are right on average, not rounded alike.
    """
    mixed = mix(docs, weights, carry=True, **options)
    draw = _digits(F.concat_ws("/", F.lit(f"{options.get('seed', 1)}/copy"), F.col("doc_id").cast("string")))
    part = (draw % F.col("size") < F.col("taken") % F.col("size")).cast("int")
    times = F.when(F.col("size") > 0, F.expr("taken div size") + part).otherwise(0)
    repeated = mixed.select("row", F.explode(F.sequence(F.lit(1), F.lit(options.get("cap", 3)))).alias("copy"),
                            times.alias("times"))
    return repeated.filter("copy <= times").select("row.*")
