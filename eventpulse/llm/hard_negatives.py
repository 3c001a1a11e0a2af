"""Hard negatives of anchors, with score bounds along a spanning tree of anchors.

Rows are packed into blocks of whole-number vectors without a shuffle and written once. Anchors
are sorted by label and first component, cut into groups of at most ``GROUP_ANCHORS``, and each
group gets a minimum spanning tree of the distances between its anchors. Every group meets every
block of rows: groups are copied to bins of blocks and joined there by the bin's number, so neither
side ever goes to all tasks at once, and what a task holds is one group, one block and a few best
rows per anchor.

Within a pair of a group and a block the tree is walked from its root. For a candidate ``c`` the
score of a child anchor differs from the score of its parent by at most ``|child - parent| * |c|``,
so what is known of the parent bounds the child's score; only candidates whose bounds overlap the
child's window are scored. The window is, when positives are looked for, from the fifth best score
so far upwards, and, when negatives are looked for, what its positives' scores allow. Scores are
exact whole numbers; bounds only say which of them are not needed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import written

BLOCK_ROWS, GROUP_ANCHORS, BLOCKS_OF_BIN = 4_096, 256, 16
# Sums below this are exact in doubles.
_EXACT = 2.0**53
_LONGEST = 2**63 - 1

BLOCK_SCHEMA = "block bigint, ids binary, labels binary, anchors binary, width int, kind string, vectors binary"
GROUP_SCHEMA = "group bigint, rows binary, ids binary, labels binary, width int, vectors binary, parents binary, edges binary"
HIT_SCHEMA = "group bigint, place int, positive int, score bigint, vec_id bigint, candidate bigint"


def _usable(vec_id: str, label: str, vector: str) -> Column:
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def _packed(units: float):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of at most ``BLOCK_ROWS`` rows in order of id; shorter vectors are filled up with zeros."""
        part, piece = TaskContext.get().partitionId(), 0
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                rows = batch.slice(first, BLOCK_ROWS)
                ids = rows.column("vec_id").to_numpy(zero_copy_only=False)
                order = np.argsort(ids, kind="stable")
                lists = rows.column("vector")
                sizes = np.diff(lists.offsets.to_numpy())
                flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * units)
                if not len(ids):
                    continue
                vectors = np.zeros((len(ids), int(sizes.max())))
                vectors[np.arange(vectors.shape[1]) < sizes[:, None]] = flat
                most = np.abs(vectors).max(initial=0)
                kind = "int16" if most < 2**15 else "int32" if most < 2**31 else "float64"
                row = (
                    part << 32 | piece, ids[order].tobytes(), rows.column("label").to_numpy()[order].tobytes(),
                    rows.column("is_anchor").to_numpy(zero_copy_only=False)[order].tobytes(), vectors.shape[1], kind,
                    vectors[order].astype(kind).tobytes(),
                )
                kinds = [pa.int64(), *[pa.binary()] * 3, pa.int32(), pa.string(), pa.binary()]
                columns = [pa.array([x], k) for x, k in zip(row, kinds)]
                yield pa.record_batch(columns, names=[c.split()[0] for c in BLOCK_SCHEMA.split(", ")])
                piece += 1

    return pack


def _matrix(block: dict) -> np.ndarray:
    n = len(block["ids"]) // 8
    return np.frombuffer(block["vectors"], block["kind"]).reshape(n, block["width"])


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in batch.to_pylist():
            chosen = np.flatnonzero(np.frombuffer(block["anchors"], bool))
            vectors = _matrix(block)[chosen].astype(np.float64)
            columns = [
                pa.array((block["block"] << 20) + chosen), pa.array(np.frombuffer(block["ids"], np.int64)[chosen]),
                pa.array(np.frombuffer(block["labels"], np.int64)[chosen]),
                pa.array(vectors[:, 0] if block["width"] else np.zeros(len(chosen))),
                pa.array([v.tobytes() for v in vectors], pa.binary()),
            ]
            yield pa.record_batch(columns, names=["row", "vec_id", "label", "along", "vector"])


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order in which anchors join the tree, parents first, and each one's parent; that of the first is -1."""
    n = len(vectors)
    order, parents = np.zeros(n, np.int64), np.full(n, -1)
    near, nearest, waiting = np.full(n, np.inf), np.full(n, -1), np.ones(n, bool)
    new = 0
    for i in range(n):
        order[i], parents[new], waiting[new] = new, nearest[new], False
        with np.errstate(over="ignore", invalid="ignore"):
            distance = np.nan_to_num(np.linalg.norm(vectors - vectors[new], axis=1), nan=np.inf)
        closer = waiting & ((distance < near) | (nearest < 0))
        near[closer], nearest[closer] = distance[closer], new
        if waiting.any():
            new = int(np.flatnonzero(waiting)[np.argmin(near[waiting])])
    return order, parents


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, piece, held = TaskContext.get().partitionId(), 0, []

    def closed() -> pa.RecordBatch:
        vectors = [np.frombuffer(r["vector"]) for r in held]
        width = max(map(len, vectors))
        vectors = np.stack([np.pad(v, (0, width - len(v))) for v in vectors])
        order, parents = spanning_tree(vectors)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        parents = np.where(parents[order] >= 0, place[parents[order]], -1)
        vectors = vectors[order]
        with np.errstate(over="ignore", invalid="ignore"):
            edges = np.where(parents >= 0, np.linalg.norm(vectors - vectors[np.maximum(parents, 0)], axis=1), np.inf)
        columns = [pa.array([part << 32 | piece])]
        columns += [pa.array([np.array([held[i][c] for i in order], np.int64).tobytes()], pa.binary()) for c in ("row", "vec_id", "label")]
        columns += [pa.array([width], pa.int32())]
        columns += [pa.array([x.tobytes()], pa.binary()) for x in (vectors, parents.astype(np.int64), edges)]
        return pa.record_batch(columns, names=[c.split()[0] for c in GROUP_SCHEMA.split(", ")])

    for batch in batches:
        for row in batch.to_pylist():
            held.append(row)
            if len(held) == GROUP_ANCHORS:
                yield closed()
                held, piece = [], piece + 1
    if held:
        yield closed()


class _Block:
    """A block's candidates, ready to be scored; ids ascend."""

    def __init__(self, row: dict, width: int):
        vectors = _matrix(row).astype(np.float64)
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.rows = (row["block"] << 20) + np.arange(len(self.ids))
        self.vectors = np.pad(vectors, ((0, 0), (0, max(0, width - vectors.shape[1]))))
        with np.errstate(over="ignore"):
            self.norms = np.linalg.norm(self.vectors, axis=1)
        self.most = float(self.norms.max(initial=0))

    def scores(self, anchor: np.ndarray, some: np.ndarray) -> np.ndarray:
        """Scores of some candidates: doubles where these are exact whole numbers, else Python's integers."""
        anchor = np.pad(anchor, (0, self.vectors.shape[1] - len(anchor)))
        with np.errstate(over="ignore"):
            small = np.linalg.norm(anchor) * self.most < _EXACT
        if not small:
            whole = [int(x) for x in anchor]
            sums = (sum(int(x) * y for x, y in zip(self.vectors[i], whole)) for i in some.tolist())
            return np.array([max(-_LONGEST, min(_LONGEST, x)) for x in sums], object)
        # Beyond half of the rows one product over all is cheaper than copying those that are wanted.
        return (self.vectors @ anchor)[some] if 2 * len(some) > len(self.ids) else self.vectors[some] @ anchor


def _search(k: int, windows_of):
    """The first k candidates of each window of each anchor, for pairs of a group and a block.

    ``windows_of`` gives for a group's row the windows of each anchor, as (number, low, high); whether candidates
    are of the anchor's label or of others is the second thing it gives. What is best so far is kept while
    the same group goes on, and raises the windows' lower ends.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, best, windows = None, {}, []

        def flushed() -> Iterator[pa.RecordBatch]:
            rows = [
                (group["group"], place, number, -s, i, r)
                for (place, number), found in best.items()
                for s, i, r in found
            ]
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.record_batch(columns, names=[c.split()[0] for c in HIT_SCHEMA.split(", ")])

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if group is None or row["group"] != group["group"]:
                    if group is not None:
                        yield from flushed()
                    group, best = row, {}
                    windows, same_label = windows_of(row)
                _walk(group, _Block({c: row[c] for c in ("block", "ids", "labels", "width", "kind", "vectors")}, group["g_width"]), windows, same_label, k, best)
        if group is not None:
            yield from flushed()

    return search


def _walk(group: dict, block: _Block, windows: list, same_label: bool, k: int, best: dict) -> None:
    """Adds a block's candidates to what is best of each anchor and window, as (-score, id, row)."""
    rows, labels = np.frombuffer(group["g_rows"], np.int64), np.frombuffer(group["g_labels"], np.int64)
    vectors = np.frombuffer(group["g_vectors"]).reshape(len(rows), group["g_width"])
    parents, edges = np.frombuffer(group["parents"], np.int64), np.frombuffer(group["edges"])
    lows, highs = [], []
    for place, anchor in enumerate(vectors):
        low, high = np.full(len(block.ids), -np.inf), np.full(len(block.ids), np.inf)
        if parents[place] >= 0:
            # One more, and a little of what is large, makes up for the rounding of lengths.
            reach = edges[place] * block.norms * (1 + 1e-9) + 1
            with np.errstate(invalid="ignore"):
                low, high = lows[parents[place]] - reach, highs[parents[place]] + reach
        lows.append(low)
        highs.append(high)
        lasting = [
            (number, max(least, -best[place, number][-1][0]) if len(best.get((place, number), ())) == k else least, most)
            for number, least, most in windows[place]
        ]
        lasting = [w for w in lasting if w[1] <= w[2]]
        wanted = (block.labels == labels[place]) == same_label
        if same_label:
            wanted &= block.rows != rows[place]
        overlap = np.zeros(len(wanted), bool)
        for _, least, most in lasting:
            overlap |= ~((high < least) | (low > most))
        # The root scores all candidates, so that bounds begin with something known.
        some = np.flatnonzero(overlap & wanted) if parents[place] >= 0 else np.arange(len(wanted))
        if not len(some):
            continue
        scores = block.scores(anchor, some)
        if scores.dtype != object:
            low[some] = high[some] = scores
        some, scores = some[wanted[some]], scores[wanted[some]]
        # Ids ascend, so a stable order by score has equal scores by id.
        order = np.argsort(-scores, kind="stable")
        some, down = some[order], -scores[order]
        for number, least, most in lasting:
            a = int(np.searchsorted(down, -most, side="left"))
            b = min(a + k, int(np.searchsorted(down, -least, side="right")))
            if a < b:
                new = zip(down[a:b].tolist(), block.ids[some[a:b]].tolist(), block.rows[some[a:b]].tolist())
                best[place, number] = sorted([*best.get((place, number), ()), *((int(s), i, r) for s, i, r in new)])[:k]


def _any_score(row: dict) -> tuple[list, bool]:
    return [[(0, -float("inf"), float("inf"))]] * (len(row["g_rows"]) // 8), True


def _of_positives(least_pct: int, most_pct: int):
    def windows_of(row: dict) -> tuple[list, bool]:
        windows: list[list] = [[] for _ in range(len(row["g_rows"]) // 8)]
        for found in row["positives"] or ():
            score = int(found["score"])
            windows[found["place"]].append((found["number"], -(-least_pct * score // 100), most_pct * score // 100))
        return windows, False

    return windows_of


def mine_hard_negatives(
    embeddings: DataFrame, anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
    units: float = 256.0, positives: int = 5, negatives: int = 10, least_pct: int = 30, most_pct: int = 90,
) -> DataFrame:
    """For each anchor and positive its hardest negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(units * x), and a score is their inner product. Rows meeting ``anchor`` are
    anchors; a positive is one of the first ``positives`` other rows of the anchor's label, a negative one of the
    first ``negatives`` rows of other labels whose score is between ``least_pct`` and ``most_pct`` per cent of the
    positive's. Higher scores come first, ties by smaller id, then by place in the table.

    Rows without an id, a label or a vector, or with a component that is null or not finite (also
    after scaling), take no part. Vectors of several lengths are filled up with zeros, so an empty one
    scores 0. Repeated rows are rows of their own: each is a candidate, and as an anchor each gets
    its results. A score beyond 64 bits counts as the nearest 64-bit number.
    A positive without a negative in its window gives no row; an empty table an empty result.
    """
    spark = embeddings.sparkSession
    rows = embeddings.where(_usable(id_col, label_col, vector_col)).select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
    )
    fits = F.forall("vector", lambda x: F.abs(x * F.lit(units)) < F.lit(float("inf")))
    blocks = written(rows.where(fits).mapInArrow(_packed(units), BLOCK_SCHEMA), "vector-blocks")
    schema = "row bigint, vec_id bigint, label bigint, along double, vector binary"
    anchors = blocks.mapInArrow(_anchors, schema)
    n_groups = 1 + anchors.count() // GROUP_ANCHORS
    in_order = anchors.repartitionByRange(n_groups, "label", "along", "vec_id").sortWithinPartitions("label", "along", "vec_id")
    groups = written(in_order.mapInArrow(_grouped, GROUP_SCHEMA), "anchor-groups")

    n_blocks = blocks.count()
    n_bins = max(1, min(n_blocks, max(n_blocks // BLOCKS_OF_BIN, spark.sparkContext.defaultParallelism)))
    number = F.shiftright("block", 32) + F.col("block").bitwiseAND(F.lit(2**32 - 1))
    dealt = blocks.drop("anchors").withColumn("bin", F.pmod(number, F.lit(n_bins)).cast("int"))

    def pairs(some: DataFrame) -> DataFrame:
        names = {c: f"g_{c}" for c in ("rows", "labels", "width", "vectors")}
        copied = some.drop("ids").withColumnsRenamed(names).withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))))
        return copied.join(dealt, "bin")

    def first(hits: DataFrame, k: int, *by: str) -> DataFrame:
        order = W.partitionBy(*by).orderBy(F.desc("score"), "vec_id", "candidate")
        return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    near = pairs(groups).mapInArrow(_search(positives, _any_score), HIT_SCHEMA)
    best = first(near, positives, "group", "place")
    # At most ``positives`` of each anchor of a group.
    told = F.struct("place", F.col("rank").alias("number"), F.col("vec_id").alias("id"), "score")
    of_group = written(best.groupBy("group").agg(F.collect_list(told).alias("positives")), "positives")
    with_positives = groups.join(of_group, "group")
    hard = pairs(with_positives).mapInArrow(_search(negatives, _of_positives(least_pct, most_pct)), HIT_SCHEMA)
    found = first(hard, negatives, "group", "place", "positive")

    anchor_ids = groups.mapInArrow(_ids_of_groups, "group bigint, place int, anchor_id bigint")
    chosen = of_group.select("group", F.explode("positives").alias("p")).select(
        "group", F.col("p.place").alias("place"), F.col("p.number").alias("positive"),
        F.col("p.id").alias("positive_id"), F.col("p.score").cast("bigint").alias("positive_score"),
    )
    return (
        found.join(chosen, ["group", "place", "positive"])
        .join(anchor_ids, ["group", "place"])
        .select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").cast("bigint").alias("negative_score"),
        )
    )


def _ids_of_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for group, ids in zip(batch.column("group").to_pylist(), batch.column("ids").to_pylist()):
            ids = np.frombuffer(ids, np.int64)
            columns = [pa.array(np.full(len(ids), group)), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids)]
            yield pa.record_batch(columns, names=["group", "place", "anchor_id"])
