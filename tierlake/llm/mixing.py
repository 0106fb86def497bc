"""Mixing sources to target weights by Sainte-Lague apportionment (DataFrame
functions only).

* Targets: sources in code-point order (NULL last) get the repeating weights and
  share ``share`` of all words; a target stops at ``max_repeats`` times its
  source's size and the excess goes to the others by weight.

``mix_blocks`` deals whole blocks and then settles each source to the word (``op9_mixing``):

* Equal-token blocks: each source's documents, in seeded hash order, form one
  stream of words that is cut into blocks of ``block`` words (its last block may
  be short).  ``block`` is the total target divided by ``total_blocks``.
* Apportionment: the ``total_blocks`` highest quotients target / (2k + 1) give
  every source an integer number of blocks.  The quotients in descending order,
  cut into ``shards`` equal runs, are the quotas per shard.
* Selection: a source with quota q and n blocks takes every block q div n times
  and the first q mod n blocks of a seeded order once more.
* Settlement: the quota misses the target by part of a block, and a source whose
  target is under about half a block has none.  What is missing is taken from the
  next blocks of the seeded order, what is too much is given back by the last ones,
  and the block at the cut is taken in part: its first words.

``mix`` is the form for consumers of whole documents (``mixed_documents``), of which as few
as possible may be taken in part.  Blocks, quotas, seeded order and settlement are the same, but
a block holds the documents that begin in it, whole: it is as long as they are, and only the one
document at the source's cut is taken in part.  Rows of equal id, source and text are in one block.

In ``mix_blocks`` a document is charged for the words of its own that lie in taken blocks.  The
stream position of a document is a two-level prefix sum: totals per (source,
hash bucket), then a running sum inside the bucket.  The hash is of seed, id and
text, so a source that holds a third of all rows, or rows without an id, spread over
4,096 window groups.  Everything is a function of the rows and the seed; reruns agree.

A very long text is counted whole.  NULL text has no words; a document without words takes 0; a source without
words has target 0.  Rows that repeat a ``doc_id`` are separate documents.  An
empty table gives an empty result.  Only ``doc_id``, ``text`` and ``source`` are
read, other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.common import text_or_empty, words
from tierlake.session import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEATS = 2
TOTAL_BLOCKS = 4096
SHARDS = 16
SEED = "mix-1"


def document_sizes(docs: DataFrame, seed: str = SEED, *more: Column) -> DataFrame:
    """doc_id, source, size and the seeded hash (and ``more``); the only pass over the texts."""
    return docs.select("doc_id", "source", F.size(words(text_or_empty())).cast("long").alias("size"),
                       F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"),
                                         F.md5("text"))).alias("hash"), *more)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Per source: its number, size, weight, target and the length of a block.

    Capped shares by water filling: sources sorted by cap / weight are capped
    until the level of the rest stays below the next one's ratio.  The windows
    run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    per = per.withColumn("source_no", F.row_number().over(by_name).cast("long"))
    per = per.withColumns({
        "weight": F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                               (F.pmod(F.col("source_no") - 1, F.lit(len(weights))) + 1).cast("int")),
        "cap": F.col("source_size") * F.lit(float(max_repeats)),
        "budget": F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)),
    })
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    per = per.withColumn("level", F.greatest(F.lit(0.0), F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                         / F.sum("weight").over(onward))
    free = F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("level"))
    level = F.first(free, ignorenulls=True).over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return per.withColumn("target", F.when(level.isNull(), F.col("cap"))
                          .otherwise(F.least("cap", level * F.col("weight")))).select(
        "source", "source_no", "source_size", "target")


def with_block_length(targets: DataFrame, total_blocks: int) -> DataFrame:
    """Add ``block``: the words of one block, equal for all sources."""
    total = F.sum("target").over(Window.partitionBy())
    return targets.withColumn("block", F.greatest(F.lit(1), F.ceil(total / F.lit(total_blocks))).cast("long"))


def apportion(targets: DataFrame, total_blocks: int = TOTAL_BLOCKS, shards: int = SHARDS,
              max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The winning quotients: (source_no, k, quotient, rank, shard) with block length
    and blocks per source.

    At most ``total_blocks`` + 2 per source candidates are ranked: no source can
    win more than one block above its exact share.
    """
    t = with_block_length(targets, total_blocks)
    t = t.withColumn("slots", F.round(F.sum("target").over(Window.partitionBy()) / F.col("block")).cast("long"))
    t = t.withColumn("n_blocks", F.ceil(F.col("source_size") / F.col("block")).cast("long"))
    most = F.least(F.col("n_blocks") * max_repeats, F.ceil(F.col("target") / F.col("block")) + 2)
    q = t.filter(most > 0).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), most.cast("long") - 1)))
    q = q.withColumn("quotient", F.col("target") / (2 * F.col("k") + 1))
    q = q.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("quotient"), "source_no", "k")).cast("long"))
    return q.filter(F.col("rank") <= F.col("slots")).withColumn(
        "shard", F.floor((F.col("rank") - 1) * shards / F.col("slots")).cast("int"))


def block_table(targets: DataFrame, quotients: DataFrame, seed: str = SEED, held: DataFrame | None = None) -> DataFrame:
    """(source_no, block_no) of every block: how often it is taken whole (``times``), how many of its
    first words once more (``part``), the words taken before it, the source's quota in ``blocks``
    and the words by which the settlement changes that quota (``settled``).

    ``targets`` have the block length; ``held`` has the words per block where they are not those of
    its stretch of the stream.  At most 1 / share * total_blocks rows and one more per source.
    """
    won = quotients.groupBy("source_no").agg(F.count(F.lit(1)).alias("blocks"))
    per = targets.filter(F.col("source_size") > 0).join(won, "source_no", "left").fillna(0, ["blocks"]).withColumns({
        "n_blocks": F.ceil(F.col("source_size") / F.col("block")).cast("long"),
        "words": F.round("target").cast("long")})
    b = per.withColumn("block_no", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
    if held is None:
        b = b.withColumn("length", F.least(F.col("block"), F.col("source_size") - F.col("block_no") * F.col("block")))
    else:
        b = b.join(held.select("source_no", "block_no", "length"), ["source_no", "block_no"], "left").fillna(0, ["length"])
    pick = Window.partitionBy("source_no").orderBy(
        F.md5(F.concat_ws(":", F.lit(seed), F.col("source_no"), F.col("block_no"))), "block_no")
    before = Window.unboundedPreceding, -1
    b = b.withColumns({"pick": F.row_number().over(pick),
                       "ahead": F.coalesce(F.sum("length").over(pick.rowsBetween(*before)), F.lit(0))})
    dealt = F.expr("blocks div n_blocks") + F.when(F.col("pick") <= F.col("blocks") % F.col("n_blocks"), 1).otherwise(0)
    source = Window.partitionBy("source_no")
    b = b.withColumns({"settled": F.col("words") - F.sum(dealt * F.col("length")).over(source),
                       "times": F.expr("words div source_size")})
    rest = F.col("words") - F.col("times") * F.col("source_size") - F.col("ahead")
    b = b.withColumn("part", F.greatest(F.lit(0), F.least("length", rest)))
    taken = F.col("times") * F.col("length") + F.col("part")
    return b.select("source_no", "block_no", "times", "part", "blocks", "settled", F.coalesce(
        F.sum(taken).over(source.orderBy("block_no").rowsBetween(*before)), F.lit(0)).alias("taken_before"))


def stream_positions(sizes: DataFrame, targets: DataFrame, *ties: str) -> DataFrame:
    """Each document's first word in its source's stream (``start``, a two-level prefix sum) and that
    of the first of its equals (``run``); ``ties`` order documents of equal hash, id and size."""
    t = F.broadcast(targets) if _few_sources(targets) else targets
    d = sizes.join(t.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")))
    d = d.drop("__source").withColumn("bucket", F.substring(F.coalesce("hash", F.lit("000")), 1, 3))
    sums = d.groupBy("source_no", "bucket").agg(F.sum("size").alias("__sum"))
    offsets = sums.select("source_no", "bucket", F.coalesce(F.sum("__sum").over(
        Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("__offset"))
    order = Window.partitionBy("source_no", "bucket").orderBy("hash", "doc_id", "size", *ties)
    inside = order.rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumns({"__before": F.coalesce(F.sum("size").over(inside), F.lit(0)),
                       "__equals": F.row_number().over(order) - F.rank().over(order)})      # of equal size, before it
    d = d.join(offsets, ["source_no", "bucket"]).withColumn("start", F.col("__offset") + F.col("__before"))
    return d.withColumn("run", F.col("start") - F.col("__equals") * F.col("size")).drop(
        "bucket", "__offset", "__before", "__equals", "hash")


# A per-source table of at most this many rows (about 1 MB) may be broadcast.
FEW_SOURCES = 10_000


def _few_sources(targets: DataFrame) -> bool:
    return len(targets.select(F.lit(1)).head(FEW_SOURCES + 1)) <= FEW_SOURCES


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS,
        total_blocks: int = TOTAL_BLOCKS, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """The mix in ``total_blocks`` blocks of whole documents, settled to the word: doc_id, size, source_size,
    target, taken (and source), the source's quota in ``blocks`` and the words by which it is ``settled``.

    One row per document.  A source's ``taken`` add up to its target, rounded to a whole word.
    """
    return _mix(docs, weights, share, max_repeats, total_blocks, shards, seed).drop("digest")


def _mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS,
         total_blocks: int = TOTAL_BLOCKS, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """``mix`` with the digest of each text."""
    sizes = materialize(document_sizes(docs, seed, _digest().alias("digest")), "mix-sizes")
    targets = materialize(source_targets(sizes, weights, share, max_repeats).coalesce(1), "mix-targets")
    quotients = apportion(targets, total_blocks, shards, max_repeats)
    lengths = with_block_length(targets, total_blocks)
    d = stream_positions(sizes, lengths, "digest").withColumn("block_no", F.expr("run div block"))
    d = materialize(d.drop("block", "run"), "mix-positions")
    held = materialize(d.filter(F.col("size") > 0).groupBy("source_no", "block_no").agg(
        F.sum("size").alias("length"), F.min("start").alias("first")), "mix-held")
    blocks = block_table(lengths, quotients, seed, held).join(held.drop("length"), ["source_no", "block_no"], "left")
    blocks = materialize(blocks.coalesce(1), "mix-blocks")
    d = d.join(blocks.select("source_no", "block_no", "times", "part", "first", "blocks", "settled"),
               ["source_no", "block_no"], "left")
    once_more = F.greatest(F.lit(0), F.least("size", F.col("part") - (F.col("start") - F.col("first"))))
    taken = F.col("times") * F.col("size") + once_more
    return d.select("doc_id", "source", "size", "source_size", "target",
                    F.when(F.col("size") > 0, taken).otherwise(0).cast("long").alias("taken"),
                    F.coalesce("blocks", F.lit(0)).alias("blocks"), F.coalesce("settled", F.lit(0)).alias("settled"),
                    "digest")


def _digest() -> Column:
    return F.xxhash64("text")


def mix_blocks(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS,
               total_blocks: int = TOTAL_BLOCKS, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """The mix in ``total_blocks`` equal blocks, settled to the word: the columns of ``mix``, the
    source's quota in ``blocks`` and the words by which it is ``settled``."""
    sizes = materialize(document_sizes(docs, seed), "mix-sizes")
    targets = materialize(source_targets(sizes, weights, share, max_repeats).coalesce(1), "mix-targets")
    quotients = apportion(targets, total_blocks, shards, max_repeats)
    lengths = with_block_length(targets, total_blocks)
    blocks = materialize(block_table(lengths, quotients, seed).coalesce(1), "mix-blocks")
    d = stream_positions(sizes, lengths)

    def taken_up_to(d: DataFrame, position, name: str, *more: str) -> DataFrame:
        """Words of the source taken among its first ``position`` words."""
        last = F.floor((position - 1) / F.col("block")).cast("long")
        b = blocks.select(F.col("source_no"), F.col("block_no").alias("__no"), F.col("times").alias("__times"),
                          F.col("part").alias("__part"), F.col("taken_before").alias("__taken"), *more)
        d = d.withColumn("__no", F.greatest(F.lit(0), last)).join(b, ["source_no", "__no"], "left")
        inside = position - F.col("__no") * F.col("block")
        upto = F.coalesce(F.col("__taken") + F.col("__times") * inside + F.least("__part", inside), F.lit(0))
        return d.withColumn(name, upto).drop("__no", "__times", "__part", "__taken")

    d = taken_up_to(d, F.col("start"), "__from")
    d = taken_up_to(d, F.col("start") + F.col("size"), "__to", "blocks", "settled")
    return d.select("doc_id", "source", "size", "source_size", "target",
                    F.when(F.col("size") > 0, F.col("__to") - F.col("__from")).otherwise(0).cast("long").alias("taken"),
                    F.coalesce("blocks", F.lit(0)).alias("blocks"), F.coalesce("settled", F.lit(0)).alias("settled"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix as whole documents, block by block: a document of which the mix takes ``taken``
    of ``size`` words is written round(taken / size) times (0 to ``max_repeats``).

    Only the document at its source's cut is taken in part, so the words written
    for a source are within half of that document of its target.  Rows that share
    ``doc_id``, source and text share the sum of what they take.
    """
    plan = _mix(docs, **settings).groupBy("doc_id", "source", "digest").agg(
        F.sum("taken").alias("__taken"), F.sum("size").alias("__size"))
    copies = F.floor(F.col("__taken") / F.col("__size") + 0.5).cast("int")
    plan = plan.filter(F.col("__size") > 0).select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("digest").alias("__digest"),
        copies.alias("__copies"))
    plan = plan.filter(F.col("__copies") > 0)
    joined = docs.join(plan, F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source"))
                       & (_digest() == F.col("__digest")))
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
