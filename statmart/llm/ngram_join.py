"""N-gram Jaccard join with several global token orders, and its connected components.

A document's set is the set of its distinct word shingles. Two documents link when
``100 * |A & B| >= percent * |A | B|``. The answer is exact; copies and near copies are never
expanded into all pairs:

1. documents with equal sets are one *node* (64 bits of a hash of the sorted set);
2. order 1 sorts a set's shingles rarest first (ties by hash). Two linked sets must share a
   shingle of their prefixes, within the positions the overlap bound leaves;
3. first pass: within each shared prefix shingle every node is paired with a few hubs only
   (chosen by a hash of shingle and node), so a group of near copies costs its size, not its square;
4. second pass: every pair that shares a prefix shingle and is still in different components,
   if a parity bitmap of the two sets doesn't already prove them too far apart;
5. in both passes a pair must also share a prefix shingle under orders 2 and 3 before the full
   sets are brought together and verified.

Weights of shingles (how often seen) only shape the orders; the answer doesn't depend on them.

Defined results: a null, empty or blank text has an empty set, links with nothing and is its own
component. Fewer words than the shingle size make one shingle of them all. Rows repeated with one
doc_id stay repeated. A null doc_id never becomes a component's id unless all its rows lack one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statmart.llm.common import batches, groups_of, map_batches, partitions, ragged, text_bytes
from statmart.session import materialize

WORDS = 5
PERCENT = 80
#: Heaviest shingles that get a weight in the orders (shapes cost, never the answer).
WEIGHTED = 1 << 18
#: Occurrences within one input partition from which a shingle is reported for weighting.
REPORTED = 2
HUBS = 2
BITMAP_WORDS = 8
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)


_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LONG_WORD = 256


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(MIX[0])
    return h ^ (h >> np.uint64(29))


def word_hashes(joined: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of a buffer (padded by 8 bytes), eight bytes of all words at a time."""
    order = np.argsort(-lengths, kind="stable")
    at, size = starts[order], lengths[order]
    eights = np.ndarray(shape=(len(joined) - 7,), dtype="<u8", buffer=joined, strides=(1,))
    h = size.astype(np.uint64)
    first = 0
    while first < len(size) and size[first] > _LONG_WORD:
        h[first] = xxhash.xxh64_intdigest(joined[at[first]:at[first] + size[first]])
        first += 1
    for done in range(0, int(size[first]) if first < len(size) else 0, 8):
        m = first + int(np.searchsorted(-size[first:], -done, side="left"))  # words longer than ``done``
        left = size[first:m] - done
        chunk = eights[at[first:m] + done]
        chunk &= np.where(left >= 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (np.uint64(8) * np.minimum(left, 7).astype(np.uint64))) - np.uint64(1))
        h[first:m] = _mixed(h[first:m] ^ chunk)
    out = np.empty_like(h)
    out[order] = h
    return out


def shingle_sets(raws: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its word shingles (A-Z lower-cased,
    ASCII white space)."""
    joined = b"\n".join(raws).lower() + b"\n" * 9
    blank = _BLANK[np.frombuffer(joined, dtype=np.uint8)]
    change = np.flatnonzero(np.diff(blank, prepend=True))
    starts, ends = change[0::2], change[1::2]
    codes = word_hashes(joined, starts, ends - starts)
    # shingles over the whole buffer; those that stay within a text are cut out below
    whole = np.full(max(0, len(codes) - words + 1), words, dtype=np.uint64)
    for j in range(words):
        whole = _mixed(whole ^ codes[j:j + len(whole)])
    text_ends = np.cumsum([len(r) + 1 for r in raws])
    bounds = np.concatenate([[0], np.searchsorted(starts, text_ends)])
    out = []
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if last - first >= words:
            hashes = np.sort(whole[first:last - words + 1])
            out.append(hashes[np.concatenate([[True], hashes[1:] != hashes[:-1]])])
        else:
            short = np.full(min(1, last - first), last - first, dtype=np.uint64)
            for j in range(first, last):
                short = _mixed(short ^ codes[j])
            out.append(short)
    return out


def node_of(hashes: np.ndarray) -> int:
    """Identity of a set of shingles: 64 bits of a hash of its sorted hashes, signed."""
    value = xxhash.xxh3_64_intdigest(hashes.tobytes())
    return value - (1 << 64) if value >> 63 else value


def _prefix_size(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _weights_of(hashes: np.ndarray, keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(hashes), dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return np.where(keys[at] == hashes, weights[at], 0)


def _prefix(hashes: np.ndarray, weights: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The first shingles of a set under one of the global orders."""
    mixed = hashes * np.uint64(MIX[order])
    mixed ^= mixed >> np.uint64(31)
    return hashes[np.lexsort((mixed, weights))[:_prefix_size(len(hashes), percent)]]


def _heavy_shingles(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles seen several times within input partitions, with their counts (at most WEIGHTED)."""

    def count(stream):
        for batch in stream:
            if not batch.num_rows:
                continue
            raws = text_bytes(batch)
            sets = [x for first, last in groups_of(raws) for x in shingle_sets(raws[first:last], words)]
            hashes = np.sort(np.concatenate(sets))
            places = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, dtype=np.int64)
            seen = np.diff(np.append(places, len(hashes)))
            keep = seen >= REPORTED
            yield pa.RecordBatch.from_arrays([pa.array(hashes[places[keep]].view(np.int64)), pa.array(seen[keep])], ["token", "seen"])

    seen = materialize(map_batches(docs.select("text"), count, "token long, seen long").groupBy("token").agg(F.sum("seen").alias("seen")), "shingles")
    found = seen.count()
    if found > WEIGHTED:  # the most frequent ones; those at the limit stay without weight
        limit = seen.approxQuantile("seen", [1 - WEIGHTED / found], min(0.01, WEIGHTED / found / 10))[0]
        seen = seen.where(F.col("seen") > limit)
    rows = seen.toPandas()
    keys, order = np.unique(rows["token"].to_numpy(dtype=np.int64).view(np.uint64), return_index=True)
    return keys, rows["seen"].to_numpy(dtype=np.int64)[order]


def parity_bitmap(hashes: np.ndarray) -> np.ndarray:
    """Bits tell whether an odd number of shingles falls in each class. Two sets' bitmaps differ in
    at most as many bits as the sets differ in shingles."""
    odd = np.bincount((hashes >> np.uint64(7)) % np.uint64(64 * BITMAP_WORDS), minlength=64 * BITMAP_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _signatures(docs: DataFrame, heavy, words: int, percent: int) -> DataFrame:
    """(doc_id, node, n, bitmap, prefix): the set's identity, size and bitmap, and its prefix under order 1."""

    def work():
        keys, weights = heavy.value

        def run(batch):
            raws = text_bytes(batch)
            sizes, nodes, bitmaps, prefixes = [], [], [], []
            for first, last in groups_of(raws):
                for hashes in shingle_sets(raws[first:last], words):
                    sizes.append(len(hashes))
                    nodes.append(node_of(hashes))
                    bitmaps.append(parity_bitmap(hashes))
                    prefixes.append(_prefix(hashes, _weights_of(hashes, keys, weights), 0, percent) if len(hashes) else hashes)
            return pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()), pa.array(nodes, type=pa.int64()), pa.array(sizes, type=pa.int32()),
                ragged(np.concatenate(bitmaps), np.full(len(bitmaps), BITMAP_WORDS), pa.int64()),
                ragged(np.concatenate(prefixes).view(np.int64), np.array([len(p) for p in prefixes]), pa.int64()),
            ], ["doc_id", "node", "n", "bitmap", "prefix"])

        return run

    return batches(docs.select("doc_id", "text"), work, "doc_id long, node long, n int, bitmap array<long>, prefix array<long>")


def _node_sets(docs: DataFrame, signed: DataFrame, nodes: DataFrame, heavy, words: int, percent: int) -> DataFrame:
    """(node, hashes, second, third) of the wanted nodes, from one document of each: the full set and its
    prefixes under orders 2 and 3."""

    def work():
        keys, weights = heavy.value

        def run(batch):
            raws, found = text_bytes(batch), ([], [], [], [])
            wanted = iter(batch.column("node").to_pylist())
            for first, last in groups_of(raws):
                for hashes in shingle_sets(raws[first:last], words):
                    node = next(wanted)
                    if node_of(hashes) != node:  # another text under the same doc_id
                        continue
                    w = _weights_of(hashes, keys, weights)
                    for out, value in zip(found, (node, hashes.tobytes(), _prefix(hashes, w, 1, percent).astype(np.uint32),
                                                  _prefix(hashes, w, 2, percent).astype(np.uint32))):
                        out.append(value)
            if not found[0]:
                return None
            return pa.RecordBatch.from_arrays([
                pa.array(found[0], type=pa.int64()), pa.array(found[1], type=pa.binary()),
                *[ragged(np.concatenate(x).view(np.int32), np.array([len(p) for p in x]), pa.int32()) for x in found[2:]],
            ], ["node", "hashes", "second", "third"])

        return run

    chosen = signed.select("doc_id", "node").join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("wanted_id"))
    texts = docs.select("doc_id", "text").join(chosen, F.col("doc_id").eqNullSafe(F.col("wanted_id")))
    return materialize(batches(texts.select("node", "text"), work, "node long, hashes binary, second array<int>, third array<int>"), "node-sets")


def overlap_needed(n: Column, m: Column, percent: int) -> Column:
    """Least intersection of two linked sets of sizes n and m."""
    return F.floor((F.lit(percent) * (n + m) + F.lit(99 + percent)) / F.lit(100 + percent))


def _reachable(n: Column, k: Column, m: Column, j: Column, percent: int) -> Column:
    """Can two sets link whose first common shingle stands at places k and j of their orders?"""
    return (F.lit(1) + F.least(n - k - 1, m - j - 1)) >= overlap_needed(n, m, percent)


def _close(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose bitmaps don't prove them too far apart."""
    x, y = marks.alias("x"), marks.alias("y")
    joined = pairs.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node"))
    return joined.where(_bitmaps_allow(percent)).select("a", "b")


def _bitmaps_allow(percent: int) -> Column:
    differing = sum((F.bit_count(F.col("x.bitmap")[i].bitwiseXOR(F.col("y.bitmap")[i])) for i in range(BITMAP_WORDS)), F.lit(0))
    n, m = F.col("x.n"), F.col("y.n")
    return differing <= n + m - 2 * overlap_needed(n, m, percent)


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes that link: filtered by orders 2 and 3, then verified on the full sets."""

    def work():
        def run(batch):
            keep = []
            for x, y in zip(batch.column("xs").to_pylist(), batch.column("ys").to_pylist()):
                both = np.sort(np.concatenate([np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)]))
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

        return run

    x, y = sets.alias("x"), sets.alias("y")
    full = (pairs.join(y, F.col("b") == F.col("y.node")).join(x, F.col("a") == F.col("x.node"))
            .where(F.arrays_overlap("x.second", "y.second") & F.arrays_overlap("x.third", "y.third")))
    return batches(full.select("a", "b", F.col("x.hashes").alias("xs"), F.col("y.hashes").alias("ys")), work, "a long, b long")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of the edges (a, b); comp is the least node reachable.

    Least labels spread along edges and along the labels themselves (pointer jumping), so the
    number of rounds grows with the logarithm of a component's diameter in the usual case.
    """
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                         .select("node", F.least("node", "b").alias("comp")), "labels")
    while True:
        of_b = labels.select(F.col("node").alias("b"), F.col("comp").alias("near"))
        spread = both.join(of_b, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        stepped = labels.join(spread, "node", "left").select(
            "node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
        moved = materialize(stepped.join(jump, "comp", "left")
                            .select("node", "was", F.least("comp", "root").alias("comp")), "labels")
        labels = moved.select("node", "comp")
        if moved.where("was <> comp").isEmpty():
            return labels


def _grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n, node, comp, component_id) of every row: size and identity of its set, a node that
    names its group (null without a set) and the group's least doc_id."""
    spark = docs.sparkSession
    heavy = spark.sparkContext.broadcast(_heavy_shingles(docs, words))
    signed = materialize(_signatures(docs, heavy, words, percent), "signatures")

    # postings of order 1, kept where a shingle is in the prefixes of two nodes or more
    by_token = Window.partitionBy("token")
    postings = (signed.where("n > 0").select("node", "n", F.posexplode("prefix").alias("k", "token"))
                .repartition(partitions(spark), "token").dropDuplicates(["token", "node"]))
    hubs = [F.min(F.struct(F.xxhash64("token", "node", F.lit(i)).alias("h"), "node", "n", "k")).over(by_token).alias(f"hub{i}")
            for i in range(HUBS)]
    shared = materialize(postings.select("token", "node", "n", "k", *hubs, F.min("node").over(by_token).alias("lo"),
                                         F.max("node").over(by_token).alias("hi"))
                         .where("lo < hi").drop("lo", "hi"), "postings")

    # a line for each node that shares a prefix shingle
    marks = materialize(signed.where("n > 0").select("node", "n", "bitmap")
                        .join(shared.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]), "marks")

    starred = shared.select("token", "node", "n", "k", F.explode(F.array(*[f"hub{i}" for i in range(HUBS)])).alias("hub"))
    first = (starred.where((F.col("node") != F.col("hub.node"))
                           & _reachable(F.col("n"), F.col("k"), F.col("hub.n"), F.col("hub.k"), percent))
             .select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct())
    first = materialize(_close(first, marks, percent), "pairs")
    sets = _node_sets(docs, signed, _ends(first), heavy, words, percent)
    links = materialize(_verify(first, sets, percent), "links")

    labelled = (shared.select("token", "node", "n", "k").join(connected_components(links), "node", "left")
                .withColumn("comp", F.coalesce("comp", "node")))
    mixed = (labelled.withColumns({"lo": F.min("comp").over(by_token), "hi": F.max("comp").over(by_token)})
             .where("lo < hi").drop("lo", "hi").join(marks.select("node", "bitmap"), "node"))
    x, y = mixed.alias("x"), mixed.alias("y")
    second = (x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.node") < F.col("y.node"))
                     & (F.col("x.comp") != F.col("y.comp"))
                     & _reachable(F.col("x.n"), F.col("x.k"), F.col("y.n"), F.col("y.k"), percent) & _bitmaps_allow(percent))
              .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct())
    second = materialize(second.join(first, ["a", "b"], "left_anti"), "pairs")
    more_sets = _node_sets(docs, signed, _ends(second).join(sets.select("node"), "node", "left_anti"), heavy, words, percent)
    more = materialize(_verify(second, sets.unionByName(more_sets), percent), "links")

    comps = connected_components(links.union(more))
    least = signed.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least")).join(comps, "node", "left")
    least = least.withColumn("comp", F.coalesce("comp", "node"))
    ids = least.join(least.groupBy("comp").agg(F.min("least").alias("component_id")), "comp").select("node", "comp", "component_id")
    out = signed.join(ids, "node", "left")
    return out.select("doc_id", "n", "node", "comp", "component_id")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, node) for every row of ``docs`` (doc_id, text).

    ``node`` identifies the set (documents with equal node have equal sets).
    """
    return _grouped(docs, words, percent).select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "node")


def _with_nodes(docs: DataFrame, words: int) -> DataFrame:
    """``docs`` with each row's set identity ``__node``, null without a set."""
    columns = docs.columns

    def work():
        def run(batch):
            raws = text_bytes(batch)
            nodes = [node_of(hashes) if len(hashes) else None
                     for first, last in groups_of(raws) for hashes in shingle_sets(raws[first:last], words)]
            return pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(nodes, type=pa.int64())], [*columns, "__node"])

        return run

    return batches(docs, work, docs.withColumn("__node", F.lit(None).cast("long")).schema)


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` with one row of each group of near duplicates kept: that of the least
    doc_id (nulls last), then of the least node, then of the least text; documents without a set are all kept."""
    groups = materialize(_grouped(docs, words, percent).select("doc_id", "n", "node", "comp"), "row-groups")
    kept = groups.where("n > 0").groupBy("comp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node")).alias("kept"))
    # a doc_id of one row tells that row; other rows are told by doc_id and node
    repeated = materialize(groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1 OR doc_id IS NULL").select("doc_id"), "repeated-ids")
    dropped = (groups.where("n > 0").join(kept, "comp").where(~F.col("doc_id").eqNullSafe(F.col("kept.doc_id")))
               .select("doc_id").where("doc_id IS NOT NULL").distinct())
    if repeated.isEmpty():
        return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)
    ids = repeated.withColumnRenamed("doc_id", "__id")
    told = F.col("doc_id").eqNullSafe(F.col("__id"))
    single = docs.join(ids, told, "left_anti").join(dropped, "doc_id", "left_anti").select(docs.columns)
    rows = _with_nodes(docs.join(ids, told, "left_semi"), words)
    wanted = kept.select(F.col("kept.doc_id").alias("__id"), F.col("kept.node").alias("__kept"))
    chosen = (rows.join(wanted, (F.col("__node") == F.col("__kept")) & told, "left_semi").groupBy("doc_id", "__node")
              .agg(F.min_by(F.struct(*docs.columns), F.struct("text", F.xxhash64(*docs.columns))).alias("row")).select("row.*"))
    return single.unionByName(rows.where("__node IS NULL").select(docs.columns)).unionByName(chosen)
