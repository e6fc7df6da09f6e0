"""Temperature mixing of sources.

Source weights are token shares raised to one exponent in 0..1 and normalised: 1
keeps the shares, 0 makes all sources equal. The exponent is bisected: the largest one
whose weights reach the target entropy, or, if that would repeat a source more
often than allowed, the smallest one that keeps to the limit. The budget times the
weights gives each source's quota, realised as whole passes over the source plus the
front part of a hash permutation of its documents, which is cut into blocks; only
the block in which a quota ends is summed up key by key. Rows of one doc_id share a key and
are cut in the same way by the hashes of their texts, and equal rows by their number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripfold.llm.ordered import kept

WORD = r"[^\x20\x09-\x0D]+"  # tokens are words: the measure that needs no vocabulary
STEPS = 20  # bisection steps; the exponent is a multiple of 2 ** -STEPS
BLOCK_ROWS = 4096  # mean rows of a block of a permutation
KEY_RANGE = 1 << 60  # permutation keys lie below
BROADCAST_SOURCES = 100_000  # above so many sources the plan is joined by shuffle


@dataclass(frozen=True)
class Mix:
    entropy: float = 0.97  # wanted entropy of the weights, as a part of that of equal weights
    max_repeats: float = 2.0  # most passes over a source, on average over its documents
    budget: float = 1.0  # tokens of the mixture, in corpus tokens
    block_tokens: int = 1_000_000  # tokens of a block of the mixture
    seed: str = "mix"


def permutation_key(seed: str, doc_id: Column, copy: Column) -> Column:
    """Place of a document in its source's permutation for one pass."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), copy.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _tokens(text: str) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _tie() -> Column:
    """Order of rows that share a permutation key, below KEY_RANGE."""
    return F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 4).alias("tie")


def source_plan(rows: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: tokens, n_rows, weight, quota, passes, rest (tokens of the part pass), blocks.

    `rows` has mix_source and n_tokens. The bisection is one expression over the list of the
    sources' token counts.
    """
    sources = rows.groupBy("mix_source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_rows"))
    total = F.aggregate("shares", F.lit(0.0), lambda s, x: s + x)
    grid = 1 << STEPS
    one = sources.agg(F.array_sort(F.collect_list(F.when(F.col("tokens") > 0, F.col("tokens").cast("double")))).alias("counts"), F.sum("tokens").alias("total"))
    one = one.withColumn("shares", F.transform("counts", lambda x: x / F.col("total")))
    one = one.withColumn("wanted", mix.entropy * F.log(F.size("shares").cast("double")))

    def powers(k: Column) -> Column:
        return F.transform("shares", lambda p: F.pow(p, k / grid))

    def entropy(k: Column) -> Column:
        def of(weights: Column) -> Column:
            norm = F.aggregate(weights, F.lit(0.0), lambda s, w: s + w)
            return F.transform(F.array(norm), lambda z: F.aggregate(weights, F.lit(0.0), lambda s, w: s - w / z * F.log(w / z)))[0]

        return F.transform(F.array(powers(k)), of)[0]

    def repeats(k: Column) -> Column:
        """Of the smallest source, which is repeated most."""

        def of(weights: Column) -> Column:
            norm = F.aggregate(weights, F.lit(0.0), lambda s, w: s + w)
            return mix.budget * F.get(weights, F.lit(0)) / norm / F.get("shares", F.lit(0))

        return F.transform(F.array(powers(k)), of)[0]

    def bisect(right_is_good) -> Column:
        """Last k of 0..grid for which the test holds, if it holds from 0 up to some k; 0 if it never does."""

        def step(ends: Column, _) -> Column:
            middle = F.floor((ends["low"] + ends["high"]) / 2)
            good = right_is_good(middle)
            return F.struct(F.when(good, middle).otherwise(ends["low"]).alias("low"), F.when(good, ends["high"]).otherwise(middle).alias("high"))

        start = F.struct(F.lit(0).cast("long").alias("low"), F.lit(grid + 1).cast("long").alias("high"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(STEPS)), start, step, lambda ends: ends["low"])

    by_entropy = bisect(lambda k: entropy(k) >= F.col("wanted"))
    too_often = bisect(lambda k: repeats(k) > mix.max_repeats)
    at_zero = repeats(F.lit(0).cast("long")) > mix.max_repeats
    by_limit = F.when(at_zero, F.least(too_often + 1, F.lit(grid))).otherwise(F.lit(0))
    one = one.select("total", "shares", F.greatest(by_entropy, by_limit).alias("k"))
    one = one.withColumn("norm", F.aggregate(powers(F.col("k")), F.lit(0.0), lambda s, w: s + w))

    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.col("total"), F.col("k") / grid) / F.col("norm")).otherwise(0.0)
    budget = F.floor(F.col("total") * F.lit(float(mix.budget)))
    plan = sources.join(F.broadcast(one.drop("shares")), how="cross")  # one row
    plan = plan.withColumn("weight", weight).withColumn("quota", F.floor(budget * F.col("weight")))
    passes = F.coalesce(F.expr("quota div nullif(tokens, 0)"), F.lit(0))
    return plan.select(
        "mix_source", "tokens", "n_rows", "weight", "quota", passes.alias("passes"),
        (F.col("quota") - passes * F.col("tokens")).alias("rest"),
        F.ceil(F.col("n_rows") / BLOCK_ROWS).alias("blocks"),
        F.greatest(F.ceil(budget / F.lit(mix.block_tokens)), F.lit(1)).alias("mix_blocks"),
    )


def _block(key: str = "key") -> Column:
    return F.floor(F.col(key) / F.lit(float(KEY_RANGE)) * F.col("blocks"))


def _source(name: str = "source") -> Column:
    """A source as a join key; null is a source of its own."""
    return F.coalesce(F.concat(F.lit("s"), F.col(name)), F.lit("n")).alias("mix_source")


def _join_plan(rows: DataFrame, plan: DataFrame, small: bool, *more: str, how: str = "inner") -> DataFrame:
    return rows.join(F.broadcast(plan) if small else plan, ["mix_source", *more], how)


def _first_over(rows: DataFrame, by: str) -> DataFrame:
    """(mix_source, by, left, n, n_rows): the first value of `by` with which n_tokens exceed `room`, and the room left before it."""
    sums = rows.groupBy("mix_source", by, "room").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("n_rows"))
    after = F.sum("n").over(Window.partitionBy("mix_source").orderBy(by))
    over = sums.withColumn("after", after).where(F.col("after") > F.col("room"))
    end = F.struct(by, (F.col("room") - F.col("after") + F.col("n")).alias("left"), "n", "n_rows")
    return over.groupBy("mix_source").agg(F.min_by(end, by).alias("end")).select("mix_source", "end.*")


def _cut(rows: DataFrame, at: str, small: bool) -> DataFrame:
    """`_first_over` by a hash `at`, summed up by blocks first. `rows` has mix_source, blocks and room."""
    rows = rows.withColumn("block", _block(at))
    last = _first_over(rows, "block").select("mix_source", "block", F.col("left").alias("room"))
    return _first_over(_join_plan(rows.select("mix_source", "block", at, "n_tokens"), last, small, "block"), at)


def quotas(docs: DataFrame, mix: Mix) -> tuple[DataFrame, bool, DataFrame]:
    """The source plan with cut_key, cut_tie, take: where the part pass ends.

    It takes the rows below cut_key; of those at cut_key the ones with a text hash below cut_tie;
    and of those at both, which are equal, `take` rows: as many as fit. Also whether the plan is small enough
    to broadcast (at most BROADCAST_SOURCES sources), and the narrow table of the rows: texts are
    read once for it.
    """
    narrow = (_source(), "source", F.col("doc_id").cast("long").alias("doc_id"), _tie(), _tokens("text").alias("n_tokens"), F.spark_partition_id().alias("part"))
    rows = kept(docs.select(*narrow))
    plan = kept(source_plan(rows, mix))
    small = plan.count() <= BROADCAST_SOURCES
    planned = plan.select("mix_source", "passes", F.col("rest").alias("room"), "blocks")
    keyed = _join_plan(rows.select("mix_source", "doc_id", "tie", "n_tokens"), planned, small)
    keyed = keyed.withColumn("key", permutation_key(mix.seed, F.col("doc_id"), F.col("passes"))).drop("passes")

    ends = kept(_cut(keyed, "key", small).withColumnRenamed("key", "cut_key"))
    at_cut = ends.select("mix_source", "cut_key", F.col("left").alias("room"), F.ceil(F.col("n_rows") / BLOCK_ROWS).alias("blocks"))
    at_cut = _join_plan(keyed.drop("room", "blocks"), at_cut, small).where("key = cut_key")
    ties = _cut(at_cut, "tie", small).select("mix_source", F.col("tie").alias("cut_tie"), F.expr("left div (n div n_rows)").alias("fits"))
    ends = plan.join(ends.select("mix_source", "cut_key").join(ties, "mix_source"), "mix_source", "left")
    return kept(ends.withColumnRenamed("fits", "take")), small, rows


def _ranked(rows: DataFrame, *group: str) -> DataFrame:
    """Numbers the rows of each group from 0, in parts (`part`), so that a large group is not one task."""
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*group, "part").agg(F.count("*").alias("n"))
    firsts = counts.withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*group, "part").orderBy("part")) - 1)
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}")) for c in (*group, "part")]
    return ranked.alias("r").join(firsts.alias("f"), same).select("r.*", "skip").withColumn("rank", F.col("rank") + F.col("skip")).drop("skip")


def _tied(rows: DataFrame) -> DataFrame:
    """Adds tied (the doc_id repeats in its source) and rank, which numbers rows equal in doc_id and text hash."""
    many = kept(rows.groupBy("mix_source", "doc_id").agg(F.count("*").alias("n")).where("n > 1").drop("n"))
    n = many.count()
    if not n:
        return rows.withColumns({"tied": F.lit(False), "rank": F.lit(0).cast("long")})
    many = F.broadcast(many) if n <= BROADCAST_SOURCES else many
    same = (rows.mix_source == many.mix_source) & rows.doc_id.eqNullSafe(many.doc_id)
    alone = rows.join(many, same, "left_anti").withColumns({"tied": F.lit(False), "rank": F.lit(0).cast("long")})
    several = kept(rows.join(many, same, "left_semi").withColumn("tied", F.lit(True)))
    return alone.unionByName(_ranked(several, "mix_source", "doc_id", "tie"))


def _copies(planned: DataFrame, mix: Mix) -> DataFrame:
    """Rows with a copy for every pass that takes them. `planned` has the plan, doc_id, tie and rank."""
    key = permutation_key(mix.seed, F.col("doc_id"), F.col("passes"))
    front = (F.col("tie") < F.col("cut_tie")) | ((F.col("tie") == F.col("cut_tie")) & (F.col("rank") < F.col("take")))
    extra = (key < F.col("cut_key")) | ((key == F.col("cut_key")) & front)
    copies = F.col("passes") + F.coalesce(extra, F.lit(False)).cast("int")
    planned = planned.withColumn("copies", copies).where("copies > 0")
    return planned.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))


def mixture(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per document and pass: doc_id, source, copy, mix_block, mix_key.

    The blocks of the mixture, each in the order of mix_key, form the training
    stream: any run of blocks holds the sources in their weights. A source's passes
    differ by at most one from document to document; its tokens miss the quota by less
    than one document, whether ids are missing or repeated or not. Rows that share a doc_id share its
    mix_key and are spread over the blocks of their pass by hashes of their texts and numbers. Null texts and texts
    without words cost nothing and follow their keys; sources that have only such texts have no weight and no rows. A
    null source is a source. An empty table gives no rows; other columns are ignored.
    """
    plan, small, rows = quotas(docs, mix)
    out = _copies(_join_plan(_tied(rows), plan, small), mix).withColumn("mix_key", permutation_key(mix.seed, F.col("doc_id"), F.col("copy")))
    place = F.xxhash64(F.lit(mix.seed), "copy", "tie", "rank")
    spread = F.shiftrightunsigned(place, 4) / F.lit(float(KEY_RANGE)) * F.least("tokens", F.col("quota") - F.col("copy") * F.col("tokens"))
    time = F.try_divide((F.col("copy") + F.col("mix_key") / F.lit(float(KEY_RANGE))) * F.col("tokens"), F.col("quota"))
    time = F.when(F.col("tied"), F.try_divide(F.col("copy") * F.col("tokens") + spread, F.col("quota"))).otherwise(time)
    block = F.coalesce(F.least(F.floor(time * F.col("mix_blocks")), F.col("mix_blocks") - 1), F.lit(0)).alias("mix_block")
    return out.select("doc_id", "source", "copy", block, "mix_key")


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The documents of the mixture with all their columns, a row for each pass.

    Null, empty and very long texts, and sources without words, are treated as in `mixture`; an empty table gives no rows.
    Where a quota ends among rows equal in source, doc_id and text, it takes as many of them as fit, whichever.
    """
    plan, small, _ = quotas(docs, mix)
    rows = docs.select(F.struct("*").alias("whole"), _source(), F.col("doc_id").cast("long").alias("doc_id"), _tie(), F.spark_partition_id().alias("part"))
    planned = _join_plan(rows, plan, small).withColumn("rank", F.lit(0).cast("long"))
    if not plan.where("take > 0").isEmpty():
        key = permutation_key(mix.seed, F.col("doc_id"), F.col("passes"))
        split = F.coalesce((F.col("take") > 0) & (key == F.col("cut_key")) & (F.col("tie") == F.col("cut_tie")), F.lit(False))
        planned = planned.where(~split).unionByName(_ranked(kept(planned.where(split).drop("rank")), "mix_source"))
    return _copies(planned, mix).select("whole.*")
