"""Mixing sources to target weights by weighted fair queueing.

Each source's documents stand in a shuffled queue, once per permitted repeat.
A document's virtual finish time is the number of words its source has served
up to its end, divided by the source's weight. All documents are sorted by
finish time and served until the budget is spent. A source whose queue runs
dry leaves its share to the others by weight, which is what resharing the
excess of capped targets gives as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, stored
from .scan import running_sums

# Fixed values of the mix: weights of the sources in their order, share and repeats.
WEIGHTS = (3, 1, 2)
BUDGET_PERCENT = 150
REPEATS = 2
SEED = "mix-1"


def word_count(text: str) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(rf"[^{SPACE}]+")).cast("long")


def _sources(sized: DataFrame) -> DataFrame:
    """(source, source_size, weight, target, place) per source."""
    sizes = stored(
        sized.groupBy("source").agg(F.sum(F.col("size") * F.col("n_rows")).alias("source_size")),
        "mix-sources",
    )
    n = sizes.count()
    by_name = [F.col("source").asc_nulls_last()]
    placed = running_sums(
        sizes.withColumn("one", F.lit(1)), by_name, {"place": "one"}, rows=n, purpose="mix-places"
    ).drop("one")
    weight = F.element_at(
        F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int")
    )
    weighed = placed.withColumn("weight", weight.cast("long"))
    totals = weighed.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).first()
    budget = F.lit((totals.words or 0) * BUDGET_PERCENT / 100)
    # The level at which the sources that still queue have been served when the budget is
    # spent: sources run dry in the order of capacity by weight.
    dry = REPEATS * F.col("source_size") / F.col("weight")
    level = (
        running_sums(
            weighed.withColumn("dry", dry).withColumn("cap", REPEATS * F.col("source_size")),
            [F.col("dry"), F.col("place")],
            {"cap_before": "cap", "weight_before": "weight"},
            rows=n,
            purpose="mix-levels",
        )
        .withColumn(
            "level",
            (budget - F.col("cap_before")) / (F.lit(totals.weights) - F.col("weight_before")),
        )
        .where("level <= dry")
        .agg(F.min_by("level", F.struct("dry", "place")).alias("level"))
        .first()
        .level
    )
    cap = (REPEATS * F.col("source_size")).cast("double")
    return weighed.withColumn("target", F.least(cap, F.col("weight") * F.lit(level or 0.0)))


def mix(docs: DataFrame) -> DataFrame:
    """How many words of each document the mix takes.

    One row per row of ``docs``: doc_id, source, text_hash, size, source_size,
    weight, target, taken, and copies, how many times the document is taken.
    Rows with the same id, source and text are taken together. A null text has
    size 0 and is never taken; null sources are one source, the last. The
    shuffle is a hash of id and text, so reruns agree. An empty table gives an
    empty result. Other columns are not read.
    """
    sized = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            "source",
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
            word_count("text").alias("size"),
        )
        .groupBy("doc_id", "source", "text_hash", "size")
        .agg(F.count("*").alias("n_rows")),
        "mix-sizes",
    )
    sources = stored(_sources(sized), "mix-targets")
    n = sized.count()
    shuffle = F.md5(F.concat_ws("/", F.lit(SEED), F.col("doc_id").cast("string")).cast("binary"))
    queued = running_sums(
        sized.withColumn("shuffled", shuffle).withColumn("words", F.col("size") * F.col("n_rows")),
        [F.col("source").asc_nulls_last(), F.col("shuffled"), F.col("doc_id"), F.col("text_hash")],
        {"served_before": "words"},
        rows=n,
        purpose="mix-queues",
    )
    # Words of the sources before, in the same order: a source's queue starts there.
    starts = running_sums(
        sources, [F.col("place")], {"source_start": "source_size"}, purpose="mix-starts"
    )
    same = queued["source"].eqNullSafe(starts["source"])
    served = stored(
        queued.join(starts, same).select(
            queued["*"],
            starts["source_size"],
            "place",
            "weight",
            "target",
            (F.col("served_before") - F.col("source_start") + F.col("words")).alias("served"),
        ),
        "mix-served",
    )

    def turn(copy: Column) -> Column:
        """Sorts the copies of documents by finish time."""
        finish = (copy * F.col("source_size") + F.col("served")) / F.col("weight")
        return F.struct(
            finish.alias("finish"),
            "place",
            copy.alias("copy"),
            "shuffled",
            "doc_id",
            "text_hash",
        )

    # Stored: dealing rows by range reads them more than once.
    copies = stored(
        served.where("words > 0").select(
            F.explode(F.array(*[turn(F.lit(e)) for e in range(REPEATS)])).alias("turn"), "words"
        ),
        "mix-copies",
    )
    taken_so_far = running_sums(
        copies, [F.col("turn")], {"before": "words"}, rows=REPEATS * n, purpose="mix-turns"
    )
    total = served.agg(F.coalesce(F.sum("words"), F.lit(0)).alias("total")).first().total
    last = (
        taken_so_far.where(
            (F.col("before") + F.col("words")) * 100 <= F.lit(total * BUDGET_PERCENT)
        )
        .agg(F.max("turn").alias("last"))
        .first()
        .last
    )

    def in_time(copy: int) -> Column:
        """Whether this copy comes no later than the last one within the budget."""
        if last is None:
            return F.lit(0)
        kinds = dict(copies.select("turn.*").dtypes)
        limit = F.struct(*[F.lit(last[k]).cast(kind).alias(k) for k, kind in kinds.items()])
        return (turn(F.lit(copy)) <= limit).cast("int")

    n_copies = F.when(F.col("words") > 0, sum(map(in_time, range(REPEATS)), F.lit(0))).otherwise(0)
    return (
        served.withColumn("copies", n_copies)
        .withColumn("taken", F.col("size") * F.col("copies"))
        .withColumn("row", F.explode(F.expr("sequence(1L, n_rows)")))
        .select(
            "doc_id", "source", "text_hash", "size", "source_size", "weight", "target", "taken", "copies"
        )
    )
