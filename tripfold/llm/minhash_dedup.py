"""Near-duplicates by banded MinHash, odd sketches and an exact check of full sets.

Texts of equal shingle sets are one class, and only classes are compared. A band
shared by several classes makes them candidates. Instead of all pairs of a band, each
class first meets one leader, the most central class of the bands they share; what
these links do not join, and only that, is compared pair by pair: within a band, the
classes outside of its largest component against the rest. So a large group costs its
size, and every candidate pair is either compared, already in one component, or ruled
out. The XOR of two odd sketches tells most unlike pairs apart before their sets are
fetched. For the rest an exact bound is at hand: every class of a band is described by a
bitmap of the shingles that it shares with the band's most central class, so that what
two of them have in common there is counted in the join itself; outside of it they have
in common at most the shingles that are not unique to one of them. Copies with many
different edits, alike but not linked, are told apart in this way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripfold.llm import shingles as sh
from tripfold.llm.components import connect
from tripfold.llm.ordered import kept
from tripfold.llm.workers import slices

PERCENT = 75  # fixed value: similarity of a link
MOST_UNLIKE = sh.unlike_bits(0.48)  # sketches further apart than this speak against a link; more than five deviations off
LEADER_ROUNDS = 2
BAND_ROWS = 500  # classes of a band that one task compares with all of it
WORD = r"[^\x20\x09-\x0D]"  # any character of a word
WORDS = sh.SKETCH_BITS // 64
SKETCHES = "doc_id long, text_key long, n_shingles long, node binary, bands array<long>, sketch array<long>"


def sketch_documents(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, node (stands for the shingle set), bands, sketch of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, nodes, bands, sketches = [], [], [], []
            for words in sh.word_hashes([t.encode() for t in batch.column(2).to_pylist()]):
                found = sh.shingle_set(words)
                sizes.append(len(found))
                nodes.append(sh.digest(found) if len(found) else None)
                least = sh.samples(found)
                bands.append(sh.band_keys(least) if len(found) else None)
                sketches.append(sh.odd_sketch(least) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))],
                ["doc_id", "text_key", "n_shingles", "node", "bands", "sketch"],
            )

    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_key"), text.alias("text")).mapInArrow(run, SKETCHES)


def _full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted classes, from one text of each. `wanted` has node, doc_id, text_key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [sh.shingle_set(w).tobytes() for w in sh.word_hashes([t.encode() for t in batch.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    text = F.coalesce("text", F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key"))
    found = wanted.join(texts, same).select("node", "text").dropDuplicates(["node"])
    return found.mapInArrow(run, "node binary, shingles binary")


def _unlike(a: str, b: str) -> Column:
    """Unlike bits of the sketches in columns a0.. and b0.."""
    total = F.lit(0)
    for i in range(WORDS):
        total = total + F.bit_count(F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}")))
    return total


def _may_link(a: str, b: str) -> Column:
    """Whether sizes, shingles in common with any class, and sketches leave room for a link."""
    low, high = F.least(f"{a}_shared", f"{b}_shared"), F.col(f"{a}_size") + F.col(f"{b}_size")
    return (100 * low >= PERCENT * (high - low)) & (_unlike(a, b) <= MOST_UNLIKE)


def _flat(classes: DataFrame, name: str) -> DataFrame:
    """node as `name`, its set size, what of it is shared at most, and its sketch in single columns."""
    shared = "shared" if "shared" in classes.columns else "n_shingles"
    return classes.select(
        F.col("node").alias(name),
        F.col("n_shingles").alias(f"{name}_size"),
        F.col(shared).alias(f"{name}_shared"),
        *(F.get("sketch", F.lit(i)).alias(f"{name}{i}") for i in range(WORDS)),
    )


def _with_shared(classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Adds, to each class, how many of its shingles any other of the classes has.

    One shuffle of the classes' shingles; the count per shingle is combined before it.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            found = [np.frombuffer(x.as_buffer(), "<i8") for x in batch.column(1)]
            keys = np.repeat(batch.column(0).to_numpy(), [len(x) for x in found])
            for at in range(0, len(keys), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(keys[part]), pa.array(np.concatenate(found)[part])], ["key", "shingle"])

    own = sets.join(classes.select("node"), "node").select(F.xxhash64("node").alias("key"), "shingles")
    rows = own.mapInArrow(spread, "key long, shingle long")
    alone = rows.groupBy("shingle").agg(F.count("*").alias("n"), F.min("key").alias("key")).where("n = 1")
    alone = alone.groupBy("key").agg(F.count("*").alias("alone"))
    joined = classes.withColumn("key", F.xxhash64("node")).join(alone, "key", "left").drop("key")
    return joined.withColumn("shared", F.col("n_shingles") - F.coalesce("alone", F.lit(0))).drop("alone")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            first, second = batch.column(2), batch.column(3)
            good = [sh.linked(np.frombuffer(first[i].as_buffer(), "<u8"), np.frombuffer(second[i].as_buffer(), "<u8"), PERCENT) for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("a_set"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("b_set"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "a_set", "b_set")
    return both.mapInArrow(run, "a binary, b binary")


def _labelled(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Adds the component of each band member so far."""
    if roots is None:
        return members.withColumn("component", F.col("node"))
    return members.join(roots, "node", "left").withColumn("component", F.coalesce("root", "node")).drop("root")


def _mixed(members: DataFrame) -> DataFrame:
    """Members of bands that still hold more than one component."""
    bands = members.groupBy("band").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    return members.join(bands.where("least <> most").select("band"), "band")


def _to_leaders(members: DataFrame, salt: int) -> DataFrame:
    """A pair (a, b) for each member a: of the leaders of its bands in another component, the commonest.

    At first a band is led by its most central member: the one that meets most
    others, over all its bands. Later rounds try others, chosen by a hash.
    """
    if salt:
        rank = F.xxhash64("node", F.lit(salt))
    else:
        central = members.groupBy("node").agg(F.sum("n").alias("met"))
        members = members.join(central, "node")
        rank = -F.col("met")
    order = F.struct(rank.alias("rank"), "node", "component")
    leaders = members.groupBy("band").agg(F.min(order).alias("leader"))
    met = members.join(leaders, "band").where(F.col("component") != F.col("leader.component"))
    return met.groupBy("node").agg(F.mode("leader.node", True).alias("b")).select(F.col("node").alias("a"), "b")


def _central(members: DataFrame) -> DataFrame:
    """(band, lead): the member of each band that meets most others, over all its bands."""
    met = members.groupBy("node").agg(F.sum("n").alias("met"))
    order = F.struct((-F.col("met")).alias("rank"), "node")
    return members.join(met, "node").groupBy("band").agg(F.min(order).alias("lead")).select("band", F.col("lead.node").alias("lead"))


def _against_lead(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, lead, inside, bits): which shingles of the lead a class has, and how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            inside, bits = [], []
            for own, of_lead in zip(batch.column(2), batch.column(3), strict=True):
                mine, lead = (np.frombuffer(x.as_buffer(), "<u8") for x in (own, of_lead))
                at = np.minimum(np.searchsorted(mine, lead), len(mine) - 1)
                has = np.zeros(-(-len(lead) // 64) * 64, bool)
                has[: len(lead)] = mine[at] == lead
                inside.append(int(has.sum()))
                bits.append(np.packbits(has).view(np.int64))
            columns = [batch.column(0), batch.column(1), pa.array(inside, pa.int64()), pa.array(bits, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["node", "lead", "inside", "bits"])

    own = sets.select("node", "shingles")
    of_lead = sets.select(F.col("node").alias("lead"), F.col("shingles").alias("lead_shingles"))
    both = pairs.join(own, "node").join(of_lead, "lead").select("node", "lead", "shingles", "lead_shingles")
    return both.mapInArrow(run, "node binary, lead binary, inside long, bits array<long>")


def _bounded(a: str, b: str) -> Column:
    """Whether what two classes of one band can have in common is enough for a link."""
    both = F.zip_with(f"{a}_bits", f"{b}_bits", lambda x, y: F.bit_count(x.bitwiseAND(y)))
    common = F.aggregate(both, F.lit(0).cast("long"), lambda n, x: n + x) + F.least(f"{a}_outside", f"{b}_outside")
    return 100 * common >= PERCENT * (F.col(f"{a}_size") + F.col(f"{b}_size") - common)


def _all_others(members: DataFrame, flat: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components in one band that neither sketches nor the bound rule out.

    a is outside of the band's largest component; the others are compared with b once.
    """
    sizes = members.groupBy("band", "component").count()
    largest = sizes.groupBy("band").agg(F.max_by("component", F.struct("count", "component")).alias("main"))
    placed = members.join(_central(members), "band").join(largest, "band")
    described = kept(_against_lead(placed.select("node", "lead").distinct(), sets))
    rows = placed.join(flat.withColumnRenamed("x", "node"), "node").join(described, ["node", "lead"])
    # a class that is the lead has all of it inside, and nothing outside
    rows = rows.withColumn("x_outside", F.greatest(F.col("x_shared") - F.col("inside"), F.lit(0))).withColumnRenamed("bits", "x_bits")
    names = [c for c in rows.columns if c.startswith("x")]
    # a large band is compared in several tasks: each has some of the a, and all b
    salts = F.ceil(F.col("n") / F.lit(BAND_ROWS)).cast("long")
    rows = kept(rows.select("band", "node", "component", "main", salts.alias("salts"), *names))
    some = F.pmod(F.xxhash64("node"), F.col("salts")).alias("salt")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("b_salt")
    a = rows.where("component <> main").select("band", some, F.col("node").alias("a"), F.col("component").alias("a_component"), *(F.col(c).alias("a" + c[1:]) for c in names))
    b = rows.select(F.col("band").alias("b_band"), every, F.col("node").alias("b"), F.col("component").alias("b_component"), "main", *(F.col(c).alias("b" + c[1:]) for c in names))
    once = (F.col("b_component") == F.col("main")) | (F.col("a") < F.col("b"))
    test = (F.col("band") == F.col("b_band")) & (F.col("salt") == F.col("b_salt")) & (F.col("a_component") != F.col("b_component")) & once & _may_link("a", "b") & _bounded("a", "b")
    return a.join(b, test).select("a", "b").distinct()


def _classes(sketches: DataFrame) -> DataFrame:
    """One row per distinct shingle set, with its least document, and the first by id (none last) and text."""
    rows = sketches.where("n_shingles > 0")
    return rows.groupBy("node").agg(
        F.min("doc_id").alias("least_doc"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("one"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch"),
    )


def link_classes(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, root) of all classes that are linked with a lesser one, directly or through others."""
    bands = classes.select("node", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = kept(bands.join(shared, "band"))
    several = members.select("node").distinct()
    candidates = kept(classes.join(several, "node").drop("bands"))
    sets = kept(_full_sets(docs, candidates.select("node", "one.doc_id", "one.text_key")))
    flat_a, flat_b = _flat(candidates, "a"), _flat(candidates, "b")

    links, roots = None, None
    for salt in range(LEADER_ROUNDS):
        mixed = _mixed(_labelled(members, roots))
        pairs = _to_leaders(mixed, salt).join(flat_a, "a").join(flat_b, "b").where(_may_link("a", "b"))
        found = _confirmed(pairs, sets)
        links = kept(found if links is None else links.union(found))
        roots = connect(links)
    mixed = kept(_mixed(_labelled(members, roots)))
    open_classes = candidates.join(mixed.select("node").distinct(), "node")
    flat = _flat(_with_shared(open_classes, sets), "x")
    rest = _confirmed(kept(_all_others(mixed, flat, sets)), sets)
    return connect(rest if links is None else links.union(rest))


def _rooted(docs: DataFrame, sketches: DataFrame) -> DataFrame:
    """node, least_doc, one, root of every class; the classes of a component share their root."""
    classes = kept(_classes(sketches))
    roots = link_classes(docs, classes)
    return classes.select("node", "least_doc", "one").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_key of every document.

    Linked documents have 100 * intersection >= PERCENT * union of their sets of
    5-word shingles; component_id is the least doc_id reachable over links, and the
    document that bears it is kept. Documents without words are linked with nothing. Null
    text has no words. Rows that repeat a doc_id are documents of their own, by their texts; rows
    without a doc_id count as larger than any (alone, they have a null component and are kept).
    An empty table gives no rows; other columns are ignored.
    """
    sketches = kept(sketch_documents(docs))
    named = _rooted(docs, sketches).drop("one")
    least = named.groupBy("root").agg(F.min("least_doc").alias("component"))
    component = named.join(least, "root").select("node", "component")
    rows = sketches.select("doc_id", "text_key", "n_shingles", "node").join(component, "node", "left")
    rows = rows.withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")))
    return rows.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_key")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of every component, and all rows without words, with all their columns.

    A component keeps its least doc_id, a row without one only if none has any; under one doc_id
    the least text_key decides, and equal rows count once. An empty table gives no rows.
    """
    sketches = kept(sketch_documents(docs))
    best = _rooted(docs, sketches).groupBy("root").agg(F.min("one").alias("one")).select("one.doc_id", "one.text_key")
    copies = sketches.where("n_shingles > 0").groupBy("doc_id", "text_key").agg(F.count("*").alias("copies"))
    same = best.doc_id.eqNullSafe(copies.doc_id) & (best.text_key == copies.text_key)
    best = kept(copies.join(best, same, "left_semi"))  # narrow: the choice is made before any text is moved
    text = F.coalesce("text", F.lit(""))
    whole = docs.select(F.struct("*").alias("whole"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("key"), text.rlike(WORD).alias("words"))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key"))
    found = whole.where("words").join(best.hint("shuffle_hash"), same)
    repeated = found.where("copies > 1").dropDuplicates(["id", "key"])
    return found.where("copies = 1").select("whole.*").unionByName(repeated.select("whole.*")).unionByName(whole.where("not words").select("whole.*"))
