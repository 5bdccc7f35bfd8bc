"""Mixing sources to target weights by Pareto order sampling.

Sources share a budget by weight; a source gets at most ``max_copies`` times its size and what it can't
take is shared again. A source's rate (target over size) gives each of its documents that many expected
copies: the whole part is certain, the rest is its inclusion probability. Documents are ranked by the odds
of a uniform number over their inclusion odds, and the first ones are taken until the words taken are as
near the target as whole documents allow. Probabilities differ between sources, the sample size of each is
fixed, and the uniform number is a hash of seed and document id, so reruns agree.

No source is ever ranked in one task. Words are summed by source and fine bins of the rank; only the bin
in which a source reaches its target is sorted. What comes out is one cut (rank and id) for each source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.tables import stored
from tidemark.session import small_side

WORD = r"[^\x20\x09-\x0D]+"
BINS = 4096
HASH_DIGITS = 13  # 52 bits


def word_count(text: str = "text") -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def _uniform(seed: int, doc_id: str) -> Column:
    key = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(key), 1, HASH_DIGITS), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(16**HASH_DIGITS))


def _rank(seed: int, doc_id: str) -> Column:
    """Random odds over inclusion odds; null where the fraction is 0."""
    u, p = _uniform(seed, doc_id), F.col("fraction")
    return F.when(p > 0, (u / (1 - u)) / (p / (1 - p)))


def _numbered(sources: DataFrame) -> DataFrame:
    """Sources with ``number``: their place by code point from 0, null last. Ranges are numbered side by side."""
    spark = sources.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = sources.withColumn("no_name", F.col("source").isNull()).repartitionByRange(parts, "no_name", "source")
    dealt = stored(dealt.withColumn("range", F.spark_partition_id()), "mix-ranges")
    sizes = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("n"))  # a row a partition
    before = sizes.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("range").orderBy("no_name", "source")) - 1
    return dealt.withColumn("place", place).join(F.broadcast(before), "range").select("source", "source_size", (F.col("place") + F.col("before")).alias("number"))


def targets(sized: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_copies: int = 2) -> DataFrame:
    """Rows ``source``, ``source_size``, ``target``: the budget is ``share`` times all sizes, weights repeat over sources in order."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights)).cast("int") + 1)
    sources = stored(_numbered(totals).withColumn("weight", weight), "mix-sources")
    most = F.col("source_size") * F.lit(float(max_copies))
    total, count = sources.agg(F.sum("source_size"), F.count(F.lit(1))).first()
    budget = share * float(total or 0)
    level, full = 0.0, -1
    for _ in range(count + 1):  # ends when no more sources are full
        free = most > level * F.col("weight")
        left = sources.agg(F.sum(F.when(~free, most)), F.sum(F.when(free, F.col("weight"))), F.sum((~free).cast("int"))).first()
        if full == (left[2] or 0) or not left[1]:
            break
        full, level = left[2] or 0, (budget - (left[0] or 0.0)) / left[1]
    return sources.select("source", "source_size", F.least(most, F.lit(level) * F.col("weight")).alias("target"))


def plan_mix(sized: DataFrame, seed: int = 17, doc_id: str = "doc_id", **how) -> DataFrame:
    """One row a source: its target, certain copies, fraction, and the last rank and id the sample takes.

    ``sized`` has the id, ``source`` and ``size`` and is read a few times: store it first.
    """
    rate = F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))
    rated = targets(sized, **how).withColumn("certain", F.coalesce(F.floor(rate), F.lit(0)).cast("long"))
    rated = rated.withColumn("fraction", F.coalesce(rate - F.col("certain"), F.lit(0.0)))
    rated = stored(rated.withColumn("rest", F.col("target") - F.col("certain") * F.col("source_size")), "mix-rates")
    ranked = _with_source(sized.select(F.col(doc_id).alias("id"), "source", "size"), rated).where("fraction > 0").withColumn("rank", _rank(seed, "id"))
    ranked = ranked.withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS))
    bins = ranked.groupBy("source", "rest", "bin").agg(F.sum("size").alias("words"))
    running = F.sum("words").over(Window.partitionBy("source").orderBy("bin"))
    last = bins.withColumn("before", running - F.col("words")).where(F.col("before") <= F.col("rest"))
    last = last.groupBy("source").agg(F.max(F.struct("bin", "before")).alias("last")).select("source", "last.bin", "last.before")
    inside = ranked.alias("r").join(small_side(last).alias("l"), F.col("r.source").eqNullSafe(F.col("l.source")) & (F.col("r.bin") == F.col("l.bin")))
    inside = inside.select("r.source", "r.id", "r.size", "r.rank", "r.rest", "l.before", "l.bin")
    order = Window.partitionBy("source").orderBy("rank", "id")
    inside = inside.withColumn("words_before", F.col("before") + F.sum("size").over(order) - F.col("size"))
    # If not even the first document of the bin is taken, the cut is null and the bins before it are in.
    cut = inside.groupBy("source", "bin").agg(
        F.max(F.when(2 * F.col("words_before") + F.col("size") <= 2 * F.col("rest"), F.struct("rank", "id"))).alias("cut")
    )
    joined = rated.alias("t").join(cut.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")), "left")
    return stored(joined.select("t.*", "c.bin", F.col("c.cut.rank").alias("cut_rank"), F.col("c.cut.id").alias("cut_id")), "mix-plan")


def _with_source(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with the columns of their source; broadcast only if there are proven few sources."""
    side = small_side(plan.withColumnRenamed("source", "_source"))
    return docs.join(side, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def apply_mix(sized_docs: DataFrame, plan: DataFrame, seed: int = 17, doc_id: str = "doc_id") -> DataFrame:
    """All columns of ``sized_docs`` with ``source_size``, ``target``, ``copies`` and ``taken`` (copies times size).

    Rows with the same id and source are taken together. A document without words is never sampled beyond
    the certain copies of its source and takes nothing. Columns named like a result are replaced.
    """
    results = ("source_size", "target", "copies", "taken", "weight", "certain", "fraction", "rest", "bin", "cut_rank", "cut_id")
    docs = sized_docs.drop(*results)
    ranked = _with_source(docs, plan).withColumn("_rank", _rank(seed, doc_id))
    position = F.floor(F.col("_rank") / (1 + F.col("_rank")) * BINS)
    beyond = (F.col("_rank") < F.col("cut_rank")) | ((F.col("_rank") == F.col("cut_rank")) & (F.coalesce(F.col(doc_id) <= F.col("cut_id"), F.lit(True))))
    sampled = (F.col("size") > 0) & F.coalesce(F.when(F.col("cut_rank").isNull(), position < F.col("bin")).otherwise(beyond), F.lit(False))
    copies = F.col("certain") + sampled.cast("long")
    return ranked.select(*docs.columns, "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = 17, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """Documents of the mix: the columns of ``docs``, each row as often as it has copies.

    A null text has size 0; sources may be null. An empty table gives an empty mix.
    """
    size = word_count(text)
    sized = stored(docs.select(F.col(doc_id), "source", size.alias("size")), "mix-sizes")
    mixed = apply_mix(docs.select("*", size.alias("size")) if "size" not in docs.columns else docs.withColumn("size", size), plan_mix(sized, seed, doc_id, **how), seed, doc_id)
    repeated = mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return repeated.select(*docs.columns)
