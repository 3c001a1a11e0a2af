"""N-gram Jaccard join: documents whose sets of word shingles are 75 % alike, by a prefix-tree join.

Equal sets are one class, held as one row per input partition, so a text that a third
of all rows share is never a group. What links classes is then found in steps that
each drop only what cannot link:

1. *Peeling.* A class links only if three quarters of its shingles are in other
   classes, too. Tasks send each shingle's hash, cut to a few bytes and packed in runs,
   to the range of hashes it belongs to, and get back one count per class. Cut hashes
   that meet by chance only let a class stay.
2. *Global order.* The sets of the classes left are ordered by how many classes have a
   shingle, the rarest first. Two sets that link share one of their first shingles
   (prefix filter), so classes whose prefixes share none need not be compared.
3. *Prefix trees.* Classes whose prefixes share shingles, directly or through others, form
   candidate groups, and each is joined on a prefix tree, which finds all its links. A
   candidate group beyond ``BLOCK_SETS`` is cut into blocks of sets that begin alike. A
   set meets another block only if a set of like size there has a shingle of its prefix,
   so groups that hang together by a few sets cost no more than their parts.

Every link is verified on whole sets of 64-bit hashes, and both its classes count it. A
task returns these counts and, of the links themselves, as many as connect its classes,
so what leaves it grows with the classes and not with their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, in_small_batches
from .components import components
from .prefix_tree import PrefixTree
from .shingles import set_batches

# Shingles a task packs at once, and of one range of hashes, which one task then counts.
RUN_SHINGLES, RANGE_SHINGLES = 1_000_000, 2_000_000
# A task counts a range in so many slices one after the other, since sorting takes several times their memory.
SLICES = 8
# Hash bits beyond those that number all shingles: the share of chance meetings is 2 ** -SPARE_BITS.
SPARE_BITS = 12
BLOCK_SETS = 1_000
# Bits of the filter that spares most texts a shuffle. Its size is fixed; when it fills up, more rows are shuffled.
FILTER_BITS, SEGMENTS = 23, 64
RUN_ROWS = 200_000

_SEVERAL = np.uint32(0xFFFFFFFF)


def _class_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of key, n and ids: each class once per run."""
    found: dict[int, tuple[int, list]] = {}
    rows = 0

    def closed() -> pa.RecordBatch:
        columns = [
            pa.array(list(found), pa.int64()), pa.array([n for n, _ in found.values()], pa.int64()),
            pa.array([ids for _, ids in found.values()], pa.list_(pa.int64())),
        ]
        return pa.record_batch(columns, names=["key", "n", "ids"])

    for ids, keys, _, bounds in set_batches(batches):
        for doc_id, key, n in zip(ids, keys.view(np.int64).tolist(), np.diff(bounds).tolist()):
            found.setdefault(key, (n, []))[1].append(doc_id)
        rows += len(ids)
        if rows >= RUN_ROWS:
            yield closed()
            found, rows = {}, 0
    if found:
        yield closed()


def _packed(values: np.ndarray) -> bytes:
    """Bytes of the same place together, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).reshape(-1).view(kind)


def _range_runs(bits: int, n_ranges: int):
    """Rows of range, hashes, holders, keys and several: what a run of classes has in a range of hashes.

    ``hashes`` are the differences of the sorted cut hashes; ``holders`` the place of the
    one class of the run that has each, or a mark for several; ``keys`` the classes that
    have a hash in the range; ``several`` how many shingles of the range each of them
    shares within the run. So a row is no longer than its hashes, however many ranges there are.
    """
    edges = np.array([(i << bits) // n_ranges for i in range(n_ranges + 1)], np.uint64)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        parts: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        seen: set[int] = set()
        size = 0

        def closed() -> pa.RecordBatch:
            key, n = np.concatenate(keys), np.concatenate(sizes)
            hashes, holder = np.concatenate(parts), np.repeat(np.arange(len(key), dtype=np.uint32), n)
            parts.clear()
            order = np.argsort(hashes, kind="stable")
            hashes, holder = hashes[order], holder[order]
            del order
            first = _firsts(hashes)
            values, counts = hashes[first], np.diff(first, append=len(hashes))
            alone = np.where(counts == 1, holder[first], _SEVERAL)
            shared = np.repeat(counts > 1, counts)
            cuts, places = np.searchsorted(values, edges), np.searchsorted(hashes, edges)
            place = np.empty(len(key), np.uint32)
            rows = []
            for i in range(n_ranges):
                a, b = cuts[i], cuts[i + 1]
                if a == b:
                    continue
                own = slice(places[i], places[i + 1])
                # The last place of each class in the range marks it once; then ``place`` numbers those found.
                at = np.arange(places[i + 1] - places[i], dtype=np.uint32)
                place[holder[own]] = at
                there = holder[own][place[holder[own]] == at]
                place[there] = at[: len(there)]
                several = np.bincount(place[holder[own][shared[own]]], minlength=len(there)).astype(np.uint32)
                lone = alone[a:b].copy()
                known = lone != _SEVERAL
                lone[known] = place[lone[known]]
                deltas = np.diff(values[a:b], prepend=edges[i : i + 1])
                rows.append((i, _packed(deltas), _packed(lone), key[there].tobytes(), _packed(several)))
            kinds = [pa.int32(), *[pa.binary()] * 4]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            return pa.record_batch(columns, names=["range", "hashes", "holders", "keys", "several"])

        for _, key, hashes, bounds in set_batches(batches):
            fresh = []
            for i, (k, n) in enumerate(zip(key.tolist(), np.diff(bounds).tolist())):
                if n and k not in seen:
                    seen.add(k)
                    fresh.append(i)
            fresh = np.array(fresh, np.int64)
            n = np.diff(bounds)
            chosen = np.zeros(len(key), bool)
            chosen[fresh] = True
            parts.append((hashes >> np.uint64(64 - bits))[np.repeat(chosen, n)])
            keys.append(key[chosen])
            sizes.append(n[chosen])
            size += len(parts[-1])
            if size >= RUN_SHINGLES:
                yield closed()
                keys, parts, sizes, seen, size = [], [], [], set(), 0
        if size:
            yield closed()

    return runs


def _counted(n_buckets: int):
    def counted(rows: pd.DataFrame) -> pd.DataFrame:
        """How many of its shingles in this range each class shares with others, packed by bucket of classes."""
        hashes, holders, all_keys, all_counts = [], [], [], []
        for row in rows.itertuples():
            hashes.append(np.cumsum(_unpacked(row.hashes, np.uint64), dtype=np.uint64))
            keys = np.frombuffer(row.keys, np.uint64)
            alone = _unpacked(row.holders, np.uint32)
            several = alone == _SEVERAL
            # Key 0 stands for several holders of a run, who share the shingle in any case.
            holders.append(np.where(several, np.uint64(0), keys[np.where(several, 0, alone)]))
            counts = _unpacked(row.several, np.uint32)
            all_keys.append(keys[counts > 0])
            all_counts.append(counts[counts > 0].astype(np.int64))
        # Each row's hashes are sorted, so equal ones of all rows lie in one of the slices.
        low, high = min(int(h[0]) for h in hashes), max(int(h[-1]) for h in hashes)
        edges = np.array([low + (high - low + 1) * i // SLICES for i in range(1, SLICES)], np.uint64)
        cuts = [[0, *np.searchsorted(h, edges).tolist(), len(h)] for h in hashes]
        found = []
        for i in range(SLICES):
            value = np.concatenate([h[c[i] : c[i + 1]] for h, c in zip(hashes, cuts)])
            if not len(value):
                continue
            order = np.argsort(value, kind="stable")
            value = value[order]
            holder = np.concatenate([h[c[i] : c[i + 1]] for h, c in zip(holders, cuts)])[order]
            del order
            first = _firsts(value)
            least, most = np.minimum.reduceat(holder, first), np.maximum.reduceat(holder, first)
            shared = np.repeat((least != most) | (least == 0), np.diff(first, append=len(value))) & (holder != 0)
            found.append(np.unique(holder[shared], return_counts=True))
        del hashes, holders, cuts
        keys, counts = _totals(
            np.concatenate([*all_keys, *(k for k, _ in found)]), np.concatenate([*all_counts, *(n for _, n in found)])
        )
        bucket = (keys % np.uint64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        numbers, begin = np.unique(bucket[order], return_index=True)
        parts = np.split(order, begin[1:])
        out = [(n, keys[x].tobytes(), counts[x].astype(np.int32).tobytes()) for n, x in zip(numbers.tolist(), parts)]
        return pd.DataFrame(out, columns=["bucket", "keys", "counts"])

    return counted


def _firsts(values: np.ndarray) -> np.ndarray:
    """Where each distinct one of the sorted values begins."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))


def _totals(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(keys, return_inverse=True)
    total = np.bincount(at, weights=counts, minlength=len(keys)).astype(np.int64)
    return keys[total > 0], total[total > 0]


def _added(rows: pd.DataFrame) -> pd.DataFrame:
    """The counts of a bucket of classes, over all ranges."""
    keys = np.concatenate([np.frombuffer(x, np.uint64) for x in rows["keys"]])
    counts = np.concatenate([np.frombuffer(x, np.int32) for x in rows["counts"]])
    keys, total = _totals(keys, counts)
    return pd.DataFrame({"key": keys.view(np.int64), "shared": total})


def _filter_of(keys: DataFrame):
    """A bitmap of the keys' first bits, of fixed size, as a broadcast."""
    part = 1 << (FILTER_BITS - 3)
    step = part // SEGMENTS

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            key = batch.column("key").to_numpy().view(np.uint64)
            bitmap[key >> np.uint64(64 - FILTER_BITS)] = True
        packed = np.packbits(bitmap)
        rows = [(i, packed[i * step : (i + 1) * step]) for i in range(SEGMENTS)]
        rows = [(i, x.tobytes()) for i, x in rows if x.any()]
        columns = [pa.array([i for i, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())]
        yield pa.record_batch(columns, names=["segment", "bits"])

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        whole = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in rows["bits"]])
        return pd.DataFrame([[rows["segment"].iloc[0], whole.tobytes()]], columns=["segment", "bits"])

    schema = "segment int, bits binary"
    found = keys.select("key").mapInArrow(bits, schema).groupBy("segment").applyInPandas(joined, schema).collect()
    packed = np.zeros(part, np.uint8)
    for row in found:
        packed[row.segment * step : (row.segment + 1) * step] = np.frombuffer(row.bits, np.uint8)
    return keys.sparkSession.sparkContext.broadcast(packed.tobytes())


def _sets_of(shared):
    """Rows of key and set of the classes that the filter lets pass, each once per batch."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = np.unpackbits(np.frombuffer(shared.value, np.uint8)).view(bool)
        for _, keys, hashes, bounds in set_batches(batches):
            rows = {}
            for i in np.flatnonzero((np.diff(bounds) > 0) & passes[keys >> np.uint64(64 - FILTER_BITS)]).tolist():
                rows.setdefault(int(keys[i].view(np.int64)), hashes[bounds[i] : bounds[i + 1]].tobytes())
            columns = [pa.array(list(rows), pa.int64()), pa.array(list(rows.values()), pa.binary())]
            yield pa.record_batch(columns, names=["key", "members"])

    return sets


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, n, members in zip(*(batch.column(c).to_pylist() for c in ("key", "n", "members"))):
            member = np.frombuffer(members, np.int64)
            columns = [pa.array(np.full(len(member), key)), pa.array(np.full(len(member), n)), pa.array(member)]
            yield pa.record_batch(columns, names=["key", "n", "member"])


def _in_batches(rows: Iterator[pa.RecordBatch], least: int = 20_000) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += row.num_rows
        if size >= least:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


LINKS = "a bigint, b bigint, links bigint"


def _tree_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Links that connect the classes of a candidate group, each group by itself, and link counts as rows without b.

    Sets of ``side`` 0 are compared with each other, those of side 2 with those of side 1 only.
    """
    links: list[tuple] = []
    for _, group in rows.groupby("candidate"):
        links += _linked(group)
    return pd.DataFrame({c: pd.array([x[i] for x in links], "Int64") for i, c in enumerate(("a", "b", "links"))})


def _linked(rows: pd.DataFrame) -> list[tuple]:
    keys = rows["key"].to_numpy()
    sizes, side = rows["n"].to_numpy(), rows["side"].to_numpy()
    in_tree, probes = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
    if not len(in_tree) or not len(probes):
        return []
    flat_order = np.concatenate([np.asarray(x, np.int64) for x in rows["order"]])
    flat = np.concatenate([np.asarray(x, np.int64) for x in rows["members"]])
    # Ranks in the global order from the most frequent shingle on, so sets that are alike begin alike.
    by = np.lexsort((flat, -flat_order))
    fresh = np.concatenate(([0], np.cumsum((np.diff(flat[by]) != 0) | (np.diff(flat_order[by]) != 0))))
    ranks = np.empty(len(flat), np.int64)
    ranks[by] = fresh
    ends = np.cumsum([len(x) for x in rows["members"]])
    sets = [np.sort(x) for x in np.split(ranks, ends[:-1])]
    tree = PrefixTree([sets[i] for i in in_tree], sizes[in_tree])
    two_sides = bool(side.any())
    above, counts = np.arange(len(keys)), np.zeros(len(keys), np.int64)
    marked, links = np.zeros(int(ranks.max(initial=-1)) + 1, bool), []

    def roots(nodes: np.ndarray) -> np.ndarray:
        top = above[nodes]
        while (above[top] != top).any():
            top = above[top]
        above[nodes] = top
        return top

    for i in probes.tolist():
        found = in_tree[tree.probe(sets[i], int(sizes[i]), marked)]
        found = found[found != i]
        if not len(found):
            continue
        counts[i] += len(found)
        if two_sides:
            counts[found] += 1
        root = roots(np.array([i]))[0]
        others, first = np.unique(roots(found), return_index=True)
        joined = others != root
        links += [(int(keys[i]), int(keys[j]), None) for j in found[first[joined]].tolist()]
        above[others[joined]] = root
    return links + [(int(keys[i]), None, int(counts[i])) for i in np.flatnonzero(counts).tolist()]


def _prefix(df: DataFrame) -> DataFrame:
    """Drops classes whose first shingles, in the global order, no other class can share; adds the prefix."""
    least = F.ceil(F.col("n") * 3 / 4)
    length = F.col("n") - least + 1 - (F.col("n") - F.size("members"))
    return df.withColumn("length", length.cast("int")).where("length > 0").withColumn(
        "prefix", F.slice("members", 1, F.col("length"))
    ).drop("length")


def _blocks(sets: DataFrame, near: DataFrame) -> DataFrame:
    """Adds ``block``: sets of a candidate group, of about one size, that share a shingle of their prefixes with one set.

    Sets with the same least neighbour (their home) lie together. A home of more than
    ``BLOCK_SETS`` sets is cut into pieces; smaller ones share blocks.
    """
    homes = near.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("home"))
    # Sets that link differ in size by a third at most.
    band = F.floor(F.log("n") / F.log(F.lit(4 / 3)))
    placed = sets.join(homes, "key", "left").withColumns({"home": F.coalesce("home", "key"), "band": band})
    crowds = placed.groupBy("candidate", "band", "home").agg(F.count(F.lit(1)).alias("crowd"))
    pools = crowds.where(F.col("crowd") <= BLOCK_SETS).groupBy("candidate", "band").agg(F.sum("crowd").alias("pool"))
    pieces = lambda n: F.ceil(F.col(n) / BLOCK_SETS)
    own = F.struct("band", "home", F.pmod(F.xxhash64("key"), pieces("crowd")).alias("piece"))
    shared = F.struct("band", F.lit(0).cast("bigint").alias("home"), F.pmod(F.xxhash64("home"), pieces("pool")).alias("piece"))
    return (
        placed.join(crowds, ["candidate", "band", "home"]).join(pools, ["candidate", "band"], "left")
        .select("key", "n", "candidate", "prefix", F.when(F.col("crowd") > BLOCK_SETS, own).otherwise(shared).alias("block"))
    )


def _meets(blocked: DataFrame) -> DataFrame:
    """Rows of key, block and other: the blocks where a set of like size has a shingle of the set's prefix."""
    at = blocked.select("key", "n", "candidate", "block", F.explode("prefix").alias("at"))
    there = at.groupBy("candidate", "at", F.col("block").alias("other")).agg(F.min("n").alias("low"), F.max("n").alias("high"))
    near_size = (F.col("high") * 4 >= F.col("n") * 3) & (F.col("n") * 4 >= F.col("low") * 3)
    return at.join(there, ["candidate", "at"]).where(near_size).select("key", "block", "other").distinct()


def _links(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Of all links as many as connect their classes (a, b), and rows of a class and its links in a part of a group (a, links)."""
    spark = rows.sparkSession
    total, n_classes = classes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    if not total:
        return spark.createDataFrame([], LINKS)
    bits = min(64, int(total).bit_length() + SPARE_BITS)
    n_ranges = -(-total // RANGE_SHINGLES)
    runs = rows.mapInArrow(_range_runs(bits, n_ranges), "range int, hashes binary, holders binary, keys binary, several binary")
    n_buckets = -(-min(total, n_classes * n_ranges) // RANGE_SHINGLES)
    counts = runs.groupBy("range").applyInPandas(_counted(n_buckets), "bucket bigint, keys binary, counts binary")
    counts = counts.groupBy("bucket").applyInPandas(_added, "key bigint, shared bigint")
    left = cut(classes.join(counts, "key").where(F.col("shared") * 4 >= F.col("n") * 3).select("key", "n"))

    sets = rows.mapInArrow(_sets_of(_filter_of(left)), "key bigint, members binary")
    # Equal keys are equal sets, so any one of them will do.
    sets = cut(sets.dropDuplicates(["key"]).join(left, "key"))
    spread = sets.select("key", "n", "members").mapInArrow(
        lambda batches: _in_batches(_members(batches)), "key bigint, n bigint, member bigint"
    )
    frequency = spread.groupBy("member").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    by_key = spread.join(frequency, "member").groupBy("key", "n").agg(
        F.sort_array(F.collect_list(F.struct("f", "member"))).alias("members")
    )
    ordered = cut(_prefix(by_key))

    # Classes that share a shingle of their prefixes are joined through the least class that has it.
    prefixes = ordered.select("key", F.explode("prefix").alias("at"))
    groups = prefixes.groupBy("at").agg(F.min("key").alias("centre"), F.count(F.lit(1)).alias("size")).where("size > 1")
    near = cut(
        prefixes.join(groups, "at").where("key <> centre").select(F.col("key").alias("a"), F.col("centre").alias("b")).distinct()
    )
    candidates = cut(components(near).select(F.col("node").alias("key"), F.col("component").alias("candidate")))
    # Large groups, at most one per BLOCK_SETS classes, are marked before the sets are shuffled.
    crowds = candidates.groupBy("candidate").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > BLOCK_SETS)
    placed = candidates.join(F.broadcast(crowds), "candidate", "left")
    open_sets = cut(ordered.join(placed, "key").select(
        "key", "n", "candidate", F.col("size").isNotNull().alias("crowded"), F.col("prefix.member").alias("prefix"),
        F.col("members.f").alias("order"), F.col("members.member").alias("members"),
    ))
    # A small group lies in one bucket whole; a large one is cut into blocks.
    small = open_sets.where("NOT crowded")
    n_buckets = max(1, -(-small.count() // BLOCK_SETS))
    bucket = F.pmod(F.xxhash64("candidate"), F.lit(n_buckets))
    columns = ["key", "n", "candidate", "order", "members"]
    small_links = (
        small.select(*columns, F.lit(0).alias("side"), bucket.alias("bucket"))
        .groupBy("bucket").applyInPandas(_tree_links, LINKS)
    )
    large = open_sets.where("crowded")
    blocked = cut(_blocks(large.select("key", "n", "candidate", "prefix"), near))
    meets = _meets(blocked)
    side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
    pair = F.xxhash64("candidate", F.least("block", "other"), F.greatest("block", "other"))
    large_links = (
        large.select(*columns).join(meets, "key").select(*columns, side.alias("side"), pair.alias("pair"))
        .groupBy("pair").applyInPandas(_tree_links, LINKS)
    )
    return cut(small_links.unionByName(large_links))


def _class_tables(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Runs of key, n and ids; and one row per class: key, n, least_id, class_size, component (a key), n_links."""
    in_small_batches(docs)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    runs = cut(rows.mapInArrow(_class_runs, "key bigint, n bigint, ids array<bigint>"))
    classes = cut(runs.where("n > 0").groupBy("key", "n").agg(
        F.min(F.array_min("ids")).alias("least_id"), F.sum(F.size("ids")).cast("bigint").alias("class_size")
    ))
    links = _links(rows.select(F.lit(None).cast("bigint").alias("doc_id"), "text"), classes)
    joined = components(links.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "key")
    counts = links.where("links IS NOT NULL").groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("n_links"))
    members = classes.join(joined, "key", "left").join(counts, "key", "left")
    return runs, members.withColumns(
        {"component": F.coalesce("component", "key"), "n_links": F.coalesce("n_links", F.lit(0).cast("bigint"))}
    )


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class_size, n_links.

    A-Z count as lower case; words are runs without white space; a document's set is
    its distinct shingles of five words, or its whole sequence if it has fewer.
    Documents link when 100 times the common shingles are at least 75 times all of
    both. ``component_id`` is the least id reachable by links, itself included;
    ``class_size`` is the number of documents with the same set, and ``n_links`` that of
    the other sets it links with, by itself and not through others. A null or empty text
    has no shingle and links with nothing, not even its like. A null id counts as no
    id: it gets the least id it links with, if any. Rows that share an id link only by
    their texts. Other columns are ignored.
    """
    runs, members = _class_tables(docs, id_col, text_col)
    least = members.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = members.join(least, "component").select("key", "component_id", "class_size", "n_links")
    found = runs.join(named, "key", "left").select("n", "component_id", "class_size", "n_links", F.explode("ids").alias("doc_id"))
    empty = F.col("n") == 0
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(empty, F.lit(1).cast("bigint")).otherwise(F.col("class_size")).alias("class_size"),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
    )


def _with_key(names: list[str], text_col: str, shared, in_groups: bool):
    """Adds the set's key to the documents whose key the filter has or, with ``in_groups`` unset, to all the others."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.unpackbits(np.frombuffer(shared.value, np.uint8)).view(bool)
        for batch in batches:
            texts = pa.record_batch([pa.nulls(batch.num_rows, pa.int64()), batch.column(text_col)], names=["doc_id", "text"])
            keys = [k for _, k, _, _ in set_batches([texts])]
            key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            chosen = (key != 0) & marked[key >> np.uint64(64 - FILTER_BITS)]
            rows = pa.record_batch([*batch.columns, pa.array(key.view(np.int64))], names=names)
            yield rows.filter(pa.array(chosen if in_groups else ~chosen))

    return keyed


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, of which one of each connected group stays: that with the least id.

    Of repeated rows with that id one stays; a group whose ids are all null keeps one
    row, too. Documents without a word are in no group and all stay. Only documents that a
    filter takes for members of a group of several are shuffled, once, by set and id together,
    so a set that a third of them share is dealt out. The others stay where they are.
    """
    _, members = _class_tables(docs, id_col, text_col)
    members = cut(members)
    first = F.min(F.struct(F.col("least_id").isNull().alias("none"), "least_id", "key"))
    staying = members.groupBy("component").agg(first.alias("first")).select(
        F.col("first.key").alias("_set_key"), F.col("first.none").alias("_no_id"),
        F.coalesce("first.least_id", F.lit(0).cast("bigint")).alias("_id"),
    )
    shared = _filter_of(members.where("class_size > 1 OR n_links > 0"))
    schema = T.StructType([*docs.schema.fields, T.StructField("_set_key", T.LongType())])

    def keyed(in_groups: bool) -> DataFrame:
        return docs.mapInArrow(_with_key([*docs.columns, "_set_key"], text_col, shared, in_groups), schema)

    doc_id = F.col(id_col).cast("bigint")
    grouped = keyed(True).withColumns({"_no_id": doc_id.isNull(), "_id": F.coalesce(doc_id, F.lit(0).cast("bigint"))})
    # The join and the removal of repeated rows have the same keys, so they need one shuffle.
    by = ["_set_key", "_no_id", "_id"]
    kept = grouped.join(staying, by, "left_semi").dropDuplicates(by)
    return kept.select(*docs.columns).unionByName(keyed(False).select(*docs.columns))
