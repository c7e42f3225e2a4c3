"""Near-duplicates by MinHash with tensored banding.

A text's set holds the hashes of its shingles of ``k`` words. Two collections of ``M`` short keys are made for it, each
key from two minhashes; a table key combines one key of either collection, so 4 * M minhashes give M * M tables of four
minhashes each. At a similarity of 0.8 a pair shares no table with a probability of about 2 * (1 - 0.64) ** M, less than
1 in 10,000 for M = 10, and far less above.

Texts with equal sets are one node from the start. Then, with no bucket ever gathered in one task and no pairs emitted just
for sharing a bucket:

1. In turns, every bucket that holds several components draws a pivot from its commonest one. A node outside it is compared
   with at most ``PIVOTS`` of the pivots that it meets, those that it meets in most buckets first. Confirmed links contract
   components, and the next turn looks only at buckets that still hold several. A turn's links are linear in its nodes.
   Turns end when one confirms nothing, after ``TURNS`` at the latest.
2. In buckets that are still open and have ``CROWD`` rows at most, the nodes outside the commonest component are joined with
   all nodes of other components, each pair in the first table that it shares. The join's condition compares sizes and odd
   sketches before a pair comes out.
3. The nodes of larger open buckets are joined by their rarest shingles: sets in one order from rare to frequent that are
   similar enough share a shingle among the first few of both, so a text need not meet all that look somewhat like it. Texts
   that differ from each other in shingles of their own just too many have none of the frequent ones there and never meet.
   Steps 2 and 3 lose no pair that shares a bucket and can still change a component; turns change the time, not the result.
4. Pairs of all steps are confirmed on the full sets of both texts.

The odd sketch has a bit for each of ``ODD`` bins of hashes, set where the set has an odd number of them. Bits in which two
sketches differ are never more than the symmetric difference, which a link bounds by (n1 + n2) * (100 - percent) /
(100 + percent), so the test loses no link; up to some thousand shingles it lets little else through.

Words are what stands between white space, A-Z lower-cased. A text of fewer than ``k`` words has its
whole sequence as its only shingle; one without words, or null, has an empty set and no links. Rows count one by one: those
that repeat a key with other texts are nodes of their own. A row with a null key has no links.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dropped, mapped, matched, matched_rows, per_slice, utf8_of, with_hash, written

M, TURNS, PIVOTS = 10, 3, 4
#: Rows of an open bucket up to which its nodes are held against each other.
CROWD = 200
#: Hash bins in which the occurrences of shingles are counted, to order them from rare to frequent.
RARITY_BINS = 1 << 18
#: Bytes of full sets that are sent to every executor; more of them are joined by a shuffle.
MOST_SET_BYTES = 24_000_000
ODD = 2048
O = [f"o{i}" for i in range(ODD // 64)]  # columns of the odd sketch
FOLDS = [f"f{i}" for i in range(8)]  # and of the folded one
_MUL = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) ^ (x >> np.uint64(29))


@functools.cache
def _parameters() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240607)
    return draw.integers(1, 2**63, 4 * M, dtype=np.uint64) * np.uint64(2) + np.uint64(1), draw.integers(0, 2**63, 4 * M, dtype=np.uint64)


def shingles(text: bytes, k: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, ascending."""
    from xxhash import xxh3_64_intdigest

    words = text.lower().split()  # of bytes: A-Z, and the six characters of white space
    hashes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    if not len(hashes):
        return hashes
    width = min(k, len(hashes))
    n = len(hashes) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = mixed(out * _MUL + hashes[i : i + n])
    return np.unique(out)


def fingerprint(found: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    from xxhash import xxh3_128_intdigest

    f = xxh3_128_intdigest(found.tobytes())
    high, low = np.array([f >> 64, f & (1 << 64) - 1], np.uint64).astype(np.int64).tolist()
    return high, low


def table_keys(found: np.ndarray) -> np.ndarray:
    """The two collections of ``M`` keys, one behind the other, from 4 * M minhashes."""
    a, b = _parameters()
    low = np.full(4 * M, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 512):  # a bounded block, whatever the text's length
        low = np.minimum(low, (found[at : at + 512, None] * a + b).min(0))
    low = mixed(low)
    return mixed(low[0::2] * _MUL + low[1::2] + np.arange(2 * M, dtype=np.uint64)).astype(np.int64)


def odd_sketch(found: np.ndarray) -> np.ndarray:
    """Parity of the number of hashes in each of ODD bins, as 64-bit integers."""
    parity = np.bincount(((found >> np.uint64(20)) % np.uint64(ODD)).astype(np.int64), minlength=ODD) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """``(doc_id, h, n, f1, f2, o0 ..., a, b)``: hash of the text, size, fingerprint and odd sketch of the set, the two key collections."""
    key = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "h", "n", "f1", "f2", *O, "a", "b"]

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            n = np.zeros(batch.num_rows, np.int64)
            prints, sketch = np.zeros((batch.num_rows, 2), np.int64), np.zeros((batch.num_rows, len(O)), np.int64)
            keys = np.zeros((batch.num_rows, 2 * M), np.int64)
            for i, text in enumerate(utf8_of(batch)):
                found = shingles(text, k)
                n[i] = len(found)
                if len(found):
                    prints[i], sketch[i], keys[i] = fingerprint(found), odd_sketch(found), table_keys(found)
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * M)
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.ravel())) for x in (keys[:, :M], keys[:, M:])]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), pa.array(n), *map(pa.array, prints.T), *map(pa.array, sketch.T), *lists], names)

        return work

    return per_slice(with_hash(docs), make, f"doc_id {key}, h bigint, n bigint, f1 bigint, f2 bigint, {' bigint, '.join(O)} bigint, a array<bigint>, b array<bigint>")


def sets_of(docs: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """``(id, set array<bigint>)``: full sets of the ``nodes (id, doc_id, n, f1, f2)``, found by the fingerprint of the set."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [shingles(x, k) for x in utf8_of(batch)]
            f1, f2 = zip(*map(fingerprint, found), strict=True) if found else ((), ())
            return pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in (f1, f2, list(map(len, found)))], pa.array([x.astype(np.int64) for x in found], pa.list_(pa.int64()))], ["f1", "f2", "n", "set"])

        return work

    rows = matched(docs.select("doc_id", "text"), nodes.select("doc_id").distinct(), "doc_id", "left_semi")
    # equal rows, and the copies that share a key with a node, are few: one row of a node is enough
    sets = per_slice(rows, make, "f1 bigint, f2 bigint, n bigint, set array<bigint>").dropDuplicates(["f1", "f2", "n"])
    return sets.join(nodes.select("id", "f1", "f2", "n"), ["f1", "f2", "n"]).select("id", "set")


def may_link(a: str, b: str, percent: int, sketch: list[str] = O) -> Column:
    """False only where sizes or odd sketches rule a link out; ``a`` and ``b`` are what their columns' names begin with."""
    n1, n2 = F.col(f"{a}n"), F.col(f"{b}n")
    differ = F.lit(0)
    for c in sketch:
        differ = differ + F.bit_count(F.col(a + c).bitwiseXOR(F.col(b + c)))
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & ((100 + percent) * differ <= (100 - percent) * (n1 + n2))


def confirmed(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct ``pairs (x, y)`` whose full sets are similar enough."""
    ids = written(pairs.select(F.explode(F.array("x", "y")).alias("id")).distinct(), "pair_ids")
    sets = matched(sets, ids, "id", "left_semi")
    size = sets.agg(F.sum(F.size("set"))).first()[0] or 0
    if 8 * size <= MOST_SET_BYTES:
        sets = F.broadcast(sets)
    left = pairs.join(sets.select(F.col("id").alias("x"), F.col("set").alias("hx")), "x")
    both = left.join(sets.select(F.col("id").alias("y"), F.col("set").alias("hy")), "y")
    shared = F.size(F.array_intersect("hx", "hy"))
    links = written(both.where(100 * shared >= percent * (F.size("hx") + F.size("hy") - shared)).select("x", "y"), "links")
    dropped(ids)
    return links


def components(links: DataFrame) -> DataFrame:
    """``(id, comp)`` of every linked id: the smallest id that can be reached.

    Each round takes the smallest label among an id's neighbours and then the label of that label, so the number of
    rounds follows the logarithm of a component's diameter.
    """
    both = written(links.select(F.col("x").alias("id"), F.col("y").alias("to")).unionByName(links.select(F.col("y").alias("id"), F.col("x").alias("to"))), "edges")
    labels = used = written(both.groupBy("id").agg(F.min("to").alias("m")).select("id", F.least("id", "m").alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("to"), F.col("comp").alias("theirs")), "to").groupBy("id").agg(F.min("theirs").alias("theirs"))
        # the label's own neighbourhood takes the news along: hooking trees, not only leaves
        hooked = near.join(labels, "id").select("id", F.least("comp", "theirs").alias("new"), "comp")
        roots = hooked.groupBy(F.col("comp").alias("id")).agg(F.min("new").alias("root"))
        step = written(hooked.join(roots.withColumnRenamed("id", "comp"), "comp").select("id", "comp", F.least("new", "root").alias("new")), "step")
        jump = step.select(F.col("id").alias("new"), F.col("new").alias("further"))
        after = written(step.join(jump, "new", "left").select("id", "comp", F.least("new", F.coalesce("further", "new")).alias("new")), "jumped")
        dropped(used, step)
        labels, used = after.select("id", F.col("new").alias("comp")), after
        if after.where("new <> comp").isEmpty():
            dropped(both)
            return labels


def contracted(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``(id, comp)`` after more links: components are found among the components that the links connect."""
    if labels is None:
        return components(links)
    named = lambda df, c: df.join(labels.withColumnRenamed("id", c).withColumnRenamed("comp", f"{c}_comp"), c, "left").select(*[x for x in df.columns if x != c], F.coalesce(f"{c}_comp", c).alias(c))
    edges = written(named(named(links, "x"), "y").where("x <> y").distinct(), "component_links")
    if edges.isEmpty():
        return labels
    merged = components(edges)
    all_of = labels.unionByName(merged.select("id", F.col("id").alias("comp")).join(labels, "id", "left_anti"))  # a label that was a lone node
    return written(all_of.join(merged.select(F.col("id").alias("comp"), F.col("comp").alias("new")), "comp", "left").select("id", F.coalesce("new", "comp").alias("comp")), "contracted")


def still_open(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows of the buckets that hold several components, with their own (``comp``) and the bucket's commonest (``major``)."""
    members = members.select("id", "pos", "key")
    labelled = members.withColumn("comp", F.col("id")) if labels is None else members.join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    parts = labelled.groupBy("key", "comp").agg(F.count("*").alias("rows"))
    several = parts.groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("rows", "comp")).alias("m")).where("parts > 1").select("key", F.col("m.comp").alias("major"))
    return written(labelled.join(several, "key").select("id", "pos", "key", "comp", "major"), "open_rows")


def sketched(rows: DataFrame, sketches: DataFrame, on: str, name: str) -> DataFrame:
    """``rows`` with a struct ``name`` of the columns of ``sketches`` for the node in column ``on``."""
    return rows.join(sketches.select(F.col("id").alias(on), F.struct(*[c for c in sketches.columns if c != "id"]).alias(name)), on)


def pivot_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """``(x, y)``: each node outside a bucket's commonest component with pivots of those, ``PIVOTS`` at most.

    In the first turn the pivot is the bucket's smallest node, so that a large group gathers round few nodes, then one drawn
    by hash, so that a node meets as many pivots as it has buckets.
    """
    drawn = F.xxhash64("key", "id", F.lit(turn)) if turn else F.lit(0).cast("long")
    core = rows if turn == 0 else rows.where("comp = major")
    pivots = core.groupBy("key").agg(F.min(F.struct(drawn.alias("h"), "id", "comp")).alias("p"))
    met = rows.join(pivots, "key").where("comp <> p.comp").groupBy("id", F.col("p.id").alias("pivot")).agg(F.count("*").alias("times"))
    # a node has at most M * M buckets, so its list is short
    best = met.groupBy("id").agg(F.slice(F.sort_array(F.collect_list(F.struct("times", "pivot")), False), 1, PIVOTS).alias("best"))
    return best.select("id", F.explode("best.pivot").alias("pivot")).select(F.greatest("id", "pivot").alias("x"), F.least("id", "pivot").alias("y")).distinct()


def other_pairs(rows: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``(x, y)``: what may link nodes of different components, each pair in the first table that it shares."""
    full = sketched(rows, nodes.select("id", "n", *O, "a", "b"), "id", "s")
    p, q = full.where("comp <> major").alias("p"), full.alias("q")
    first = lambda c: F.array_position(F.zip_with(f"p.s.{c}", f"q.s.{c}", lambda x, y: x == y), True) - 1
    once = (first("a") == F.floor(F.col("p.pos") / M)) & (first("b") == F.col("p.pos") % M)
    condition = (F.col("p.key") == F.col("q.key")) & (F.col("p.comp") != F.col("q.comp")) & ((F.col("q.comp") == F.col("q.major")) | (F.col("p.id") < F.col("q.id"))) & may_link("p.s.", "q.s.", percent) & once
    return p.join(q, condition).select(F.greatest("p.id", "q.id").alias("x"), F.least("p.id", "q.id").alias("y"))


def rarity(sets: DataFrame) -> np.ndarray:
    """How many sets' shingles fall in each of ``RARITY_BINS`` bins; any counts make a valid order, good ones a fast one."""

    def run(batches):
        total = np.zeros(RARITY_BINS, np.int64)
        for batch in batches:
            tokens = batch.column("set").flatten().to_numpy(zero_copy_only=False)
            total += np.bincount(tokens & (RARITY_BINS - 1), minlength=RARITY_BINS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bin", "n"])

    got = mapped(sets.select("set"), run, "bin bigint, n bigint").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()  # a row a bin at most
    out = np.zeros(RARITY_BINS, np.int64)
    out[got.column("bin").to_numpy()] = got.column("n").to_numpy()
    return out


def rare_shingles(sets: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """The columns of ``sets`` with ``(n, pos, short, key)`` for its ``set``: the first shingles of each set from rare to frequent, and their places.

    A set shares a shingle among these with every set that it may link. Those with ``short`` are enough where the other set
    is as long or longer.
    """
    sent = sets.sparkSession.sparkContext.broadcast(counts)  # RARITY_BINS integers, whatever the input
    carried = [c for c in sets.columns if c != "set"]

    def make():
        often = sent.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ends = np.cumsum(batch.column("set").value_lengths().to_numpy(zero_copy_only=False))
            tokens = batch.column("set").flatten().to_numpy(zero_copy_only=False)
            rows, keys, places, short = [], [], [], []
            for i, end in enumerate(ends.tolist()):
                own = tokens[ends[i - 1] if i else 0 : end]
                n = len(own)
                longest = n + (-percent * n // 100) + 1
                own = own[np.lexsort((own, often[own & (RARITY_BINS - 1)]))[:longest]]
                keys.append(own)
                places.append(np.arange(len(own)))
                short.append(places[-1] < n + (-2 * percent * n // (100 + percent)) + 1)
                rows.append(np.full(len(own), i))
            take = pa.array(np.concatenate([np.zeros(0, np.int64), *rows]))
            join = lambda x, kind: pa.array(np.concatenate([np.zeros(0, kind), *x]))
            n = pa.array(batch.column("set").value_lengths().cast(pa.int64()))
            return pa.RecordBatch.from_arrays([*[batch.column(c).take(take) for c in carried], n.take(take), join(places, np.int64), join(short, bool), join(keys, np.int64)], [*carried, "n", "pos", "short", "key"])

        return work

    return per_slice(sets, make, f"{', '.join(f'{c} bigint' for c in carried)}, n bigint, pos bigint, short boolean, key bigint")


def crowded_pairs(crowd: DataFrame, sets: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """``(x, y)``: what may link nodes of different components among ``crowd (id, comp)``, by the shingles that it must share.

    In each shingle's rows the commonest component meets only the others, so copies of one text don't meet one another. The
    odd sketch, folded to ``len(FOLDS)`` integers, is part of the join's condition; the whole one rules out more of what is left.
    """
    folded = [functools.reduce(Column.bitwiseXOR, map(F.col, O[i :: len(FOLDS)])).alias(c) for i, c in enumerate(FOLDS)]
    own = written(sets.join(crowd, "id").join(sketches.select("id", *folded), "id"), "crowd_sets")
    rows = written(rare_shingles(own, rarity(own), percent), "rare_shingles")
    parts = rows.groupBy("key", "comp").agg(F.count("*").alias("rows"))
    several = parts.groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("rows", "comp")).alias("m")).where("parts > 1").select("key", (F.col("m.comp")).alias("major"))
    rows = written(rows.join(several, "key"), "shared_shingles")
    p, q = rows.where("short").alias("p"), rows.alias("q")
    left = F.least(F.col("p.n") - F.col("p.pos"), F.col("q.n") - F.col("q.pos"))
    fits = (F.col("p.key") == F.col("q.key")) & (F.col("p.comp") != F.col("q.comp")) & (F.col("p.n") <= F.col("q.n")) & (100 * F.col("p.n") >= percent * F.col("q.n")) & ((100 + percent) * left >= percent * (F.col("p.n") + F.col("q.n"))) & may_link("p.", "q.", percent, FOLDS)
    ids = lambda df: df.select(F.greatest("p.id", "q.id").alias("x"), F.least("p.id", "q.id").alias("y"))
    met = ids(p.where("p.comp <> p.major").join(q, fits)).unionByName(ids(p.where("p.comp = p.major").join(q.where("q.comp <> q.major"), fits)))
    met = written(met.distinct(), "crowd_pairs")
    found = written(sketched(sketched(met, sketches, "x", "p"), sketches, "y", "q").where(may_link("p.", "q.", percent)).select("x", "y"), "crowd_pairs")
    dropped(own, rows, met)
    return found


def linked(docs: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame | None:
    """``(id, comp)`` of the nodes that have links; None where no two nodes share a bucket."""
    keys = nodes.select("id", F.posexplode(F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: F.xxhash64(x, y))))).alias("pos", "key"))
    shared = written(keys.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1").select("key"), "shared_keys")
    members = written(keys.join(shared, "key").select("id", F.col("pos").cast("tinyint").alias("pos"), "key"), "members")
    several = written(members.select("id").distinct(), "several")
    sets = written(sets_of(docs, nodes.join(several, "id", "left_semi"), k), "sets")
    dropped(shared, several)

    labels, sketches, rows = None, nodes.select("id", "n", *O), members
    for turn in range(TURNS):
        before, rows = rows, still_open(rows, labels)  # buckets only close
        pairs = sketched(sketched(pivot_pairs(rows, turn), sketches, "x", "p"), sketches, "y", "q").where(may_link("p.", "q.", percent))
        pairs = written(pairs.select("x", "y"), "pivot_pairs")
        links = confirmed(sets, pairs, percent)
        dropped(before, pairs)
        if links.isEmpty():
            break
        labels = contracted(labels, links)
    before, rows = rows, still_open(rows, labels)
    large = written(rows.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > CROWD).select("key"), "large_buckets")
    rest = other_pairs(rows.join(large, "key", "left_anti"), nodes, percent)
    if not large.isEmpty():
        crowd = rows.join(large, "key", "left_semi").select("id", "comp").distinct()
        rest = rest.unionByName(crowded_pairs(crowd, sets, sketches, percent)).distinct()
    rest = written(rest, "other_pairs")
    links = confirmed(sets, rest, percent)
    dropped(before, rows, large, rest, sets)
    return labels if links.isEmpty() else contracted(labels, links)


def classed(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``(doc_id, h, n, component_id, chosen)`` for each row; the rows of one node of each component are chosen."""
    sig = written(signatures(docs, k), "signatures")
    nodes = sig.where("n > 0 and doc_id is not null").groupBy("n", "f1", "f2", *O, "a", "b").agg(F.min("doc_id").alias("doc_id"))
    nodes = written(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    short = nodes.select("id", "doc_id", "n", "f1", "f2")
    labels = linked(docs, nodes, k, percent)
    if labels is not None:
        of = written(short.join(labels, "id"), "linked")
        best = of.groupBy("comp").agg(F.min(F.struct("doc_id", "id")).alias("best"))
        of = of.join(best, "comp").select("id", F.col("best.doc_id").alias("component_id"), (F.col("id") == F.col("best.id")).alias("chosen"))
        short = written(short.join(of, "id", "left").withColumns({"component_id": F.coalesce("component_id", "doc_id"), "chosen": F.coalesce("chosen", F.lit(True))}), "classes")
    else:
        short = short.withColumns({"component_id": F.col("doc_id"), "chosen": F.lit(True)})
    rows = sig.select("doc_id", "h", "n", "f1", "f2").join(short.drop("id", "doc_id"), ["n", "f1", "f2"], "left")
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "h", "n", component.alias("component_id"), (alone | F.col("chosen")).alias("chosen"))


def groups(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row."""
    rows = classed(docs, k, percent)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicate(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component (its repeated rows too), and all that are in none."""
    stays = F.col("chosen") & F.col("doc_id").eqNullSafe(F.col("component_id"))
    gone = written(classed(docs, k, percent).where(~stays).select("doc_id", "h").distinct(), "near_dropped")
    return matched_rows(docs, gone, "left_anti")
