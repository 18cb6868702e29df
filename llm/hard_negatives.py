"""Hard negatives: rows of another label whose score lies in a window below that of an anchor's positives.

Every vector x of norm at most M becomes (x, sqrt(M^2 - |x|^2)), of norm M, and an anchor a becomes (a, 0):
the inner product then follows from the distance between the two, so that the triangle inequality with a
node's covering radius bounds the scores of all rows below it. A coarse net from a bounded sample deals the
rows into cells; an anchor visits only cells that its windows can reach. In a cell a cover tree is descended
best node first, and leaves are scored exactly, in whole numbers.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import ship
from presswork.sources.shared import materialize

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
ANCHOR_EVERY, CHANGED_EVERY, LABELS = 50, 7, 10
# The net is fitted on at most so many rows, and has a centre per so many rows, up to a number.
SAMPLE, ROWS_PER_CENTRE, MOST_CENTRES = 4096, 4096, 1024
CELL_ROWS, ANCHORS_TOGETHER = 8192, 2048
LEAF, FAN_OUT, SHRINK = 256, 32, 0.5
# Hits a search holds before it keeps only those that can still count.
HELD_HITS = 1 << 20
_EXACT = float(1 << 53)


def sound_rows(vectors: DataFrame) -> DataFrame:
    """vec_id, label and whole components of the rows that take part; every seventh id has its label moved on.

    Rows with a null id, label or vector, or a component that is null or not finite, are left out.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    present = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % CHANGED_EVERY == 0, F.pmod(label + 1, F.lit(LABELS))).otherwise(label)
    kept = vectors.where(present & finite)
    return kept.select(F.col("vec_id").cast("bigint"), moved.alias("label"), whole.alias("weights"))


def matrix(weights: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of whole components, zero beyond the end of shorter vectors."""
    if isinstance(weights, pa.ChunkedArray):
        weights = weights.combine_chunks()
    offsets = weights.offsets.to_numpy().astype(np.int64)
    values = weights.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    place = np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), place] = values
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole rows, by floating point where that is exact."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, width)
    if most >= _EXACT:
        return a @ b.T
    return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)


def squares(rows: np.ndarray) -> np.ndarray:
    return (rows.astype(np.float64) ** 2).sum(axis=1)


@dataclass
class Space:
    """Rows in the augmented space of norm M: the whole components and the added one."""

    rows: np.ndarray
    most: float
    extra: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.extra = np.sqrt(np.maximum(self.most - squares(self.rows), 0))

    def distances(self, which: np.ndarray, centre: int) -> np.ndarray:
        """From some rows to one of them."""
        inner = self.rows[which].astype(np.float64) @ self.rows[centre].astype(np.float64)
        inner += self.extra[which] * self.extra[centre]
        return np.sqrt(np.maximum(2 * (self.most - inner), 0))


@dataclass
class Node:
    """A centre, the distance that covers all rows below it, their labels' range, and children or rows."""

    centre: int
    radius: float
    labels: tuple[int, int]
    rows: np.ndarray
    children: list["Node"] = field(default_factory=list)


def net(space: Space, rows: np.ndarray, first: int, most: int, radius: float) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Centres, farthest first, until they cover the rows by `radius` or are `most`; every row's nearest centre
    and its distance. Centres stay apart by more than the radius at which they were taken."""
    centres, near = [first], space.distances(rows, first)
    owner = np.zeros(len(rows), np.int64)
    while len(centres) < most and near.max(initial=0) > radius:
        centres.append(int(rows[near.argmax()]))
        there = space.distances(rows, centres[-1])
        closer = there < near
        owner[closer] = len(centres) - 1
        near = np.minimum(near, there)
    return centres, owner, near


def cover_tree(space: Space, labels: np.ndarray, rows: np.ndarray | None = None, centre: int | None = None) -> Node:
    """A tree whose levels halve the radius where the fan-out allows; radii are those measured, so they cover."""
    rows = np.arange(len(space.rows)) if rows is None else rows
    centre = int(rows[0]) if centre is None else centre
    away = space.distances(rows, centre)
    node = Node(centre, float(away.max(initial=0)), (int(labels[rows].min()), int(labels[rows].max())), rows)
    if len(rows) <= LEAF or node.radius == 0:
        return node
    centres, owner, _ = net(space, rows, centre, FAN_OUT, node.radius * SHRINK)
    order = np.argsort(owner, kind="stable")
    parts = np.split(rows[order], np.searchsorted(owner[order], np.arange(1, len(centres))))
    small = [(c, part) for c, part in zip(centres, parts) if len(part)]
    if len(small) > 1:
        node.children = [cover_tree(space, labels, part, c) for c, part in small]
    return node


def bounds(inner: np.ndarray, own: np.ndarray, most: float, radius: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score below nodes, from the scores of their centres, with room for rounding."""
    total = own + most
    away = np.sqrt(np.maximum(total - 2 * inner, 0))
    room = 1e-6 * (1 + total)
    return (total - (away + radius) ** 2) / 2 - room, (total - np.maximum(away - radius, 0) ** 2) / 2 + room


@dataclass
class Wanted:
    """What every anchor looks for: rows of its own label or of others, in windows of scores, the best `top` of each."""

    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool
    top: int
    # Per anchor and window, a score that at least `top` rows are known to reach.
    bar: np.ndarray

    def open(self, who: np.ndarray, least: np.ndarray, greatest: np.ndarray, labels: tuple[int, int]) -> np.ndarray:
        """Which anchors may still find something below a node."""
        first, last = labels
        fits = (self.labels[who] >= first) & (self.labels[who] <= last)
        if not self.same:
            fits = (self.labels[who] != first) | (first != last)
        reach = np.maximum(self.low[who], self.bar[who])
        return fits & ((greatest[:, None] >= reach) & (least[:, None] <= self.high[who])).any(axis=1)


class Search:
    """Best-first descent of one cell's tree by many anchors at once."""

    def __init__(self, wanted: Wanted, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, most: float):
        self.wanted, self.ids, self.labels, self.rows, self.most = wanted, ids, labels, rows, most
        self.own = squares(wanted.rows)
        self.best = np.full((*wanted.low.shape, wanted.top), np.iinfo(np.int64).min)
        self.hits: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = self.scored = 0

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, window, score and row of every hit that counts."""
        if len(self.rows) and len(self.wanted.ids):
            space = Space(self.rows, self.most)
            root = cover_tree(space, self.labels)
            heap = self._pushed([root], np.arange(len(self.wanted.ids)), [], [0])
            count = [len(heap)]
            while heap:
                *_, node, who, least, greatest = heapq.heappop(heap)
                still = self.wanted.open(who, least, greatest, node.labels)
                who = who[still]
                if not len(who):
                    continue
                if node.children:
                    self._pushed(node.children, who, heap, count)
                    continue
                for start in range(0, len(node.rows), LEAF):
                    self._leaf(node.rows[start : start + LEAF], who)
        return self._kept()

    def _pushed(self, nodes: list[Node], who: np.ndarray, heap: list, count: list[int]) -> list:
        inner = products(self.wanted.rows[who], self.rows[[n.centre for n in nodes]]).astype(np.float64)
        for at, node in enumerate(nodes):
            least, greatest = bounds(inner[:, at], self.own[who], self.most, node.radius)
            some = self.wanted.open(who, least, greatest, node.labels)
            if some.any():
                count[0] += 1
                nearest = -float(greatest[some].mean())
                heapq.heappush(heap, (nearest, count[0], node, who[some], least[some], greatest[some]))
        return heap

    def _leaf(self, rows: np.ndarray, who: np.ndarray) -> None:
        wanted = self.wanted
        self.scored += len(rows) * len(who)
        score = products(wanted.rows[who], self.rows[rows])
        alike = wanted.labels[who][:, None] == self.labels[rows][None, :]
        usable = (alike == wanted.same) & (wanted.ids[who][:, None] != self.ids[rows][None, :])
        for window in range(wanted.low.shape[1]):
            reach = np.maximum(wanted.low[who, window], wanted.bar[who, window])
            good = usable & (score >= reach[:, None]) & (score <= wanted.high[who, window][:, None])
            some = np.flatnonzero(good.any(axis=1))
            if not len(some):
                continue
            masked = np.where(good[some], score[some], np.iinfo(np.int64).min)
            both = np.concatenate([self.best[who[some], window], masked], axis=1)
            top = np.partition(both, both.shape[1] - wanted.top, axis=1)[:, -wanted.top :]
            self.best[who[some], window] = top
            wanted.bar[who[some], window] = np.maximum(wanted.bar[who[some], window], top.min(axis=1))
            a, b = np.nonzero(good[some] & (score[some] >= wanted.bar[who[some], window][:, None]))
            self.hits.append((who[some[a]], np.full(len(a), window), score[some[a], b], rows[b]))
            self.held += len(a)
        if self.held > HELD_HITS:
            self.hits = [self._kept()]
            self.held = len(self.hits[0][0])

    def _kept(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The first `top` hits of every anchor and window, ties by the smaller id."""
        if not self.hits:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        who, window, score, row = (np.concatenate(x) for x in zip(*self.hits))
        order = np.lexsort((self.ids[row], -score, window, who))
        who, window, score, row = who[order], window[order], score[order], row[order]
        begins = np.flatnonzero(np.concatenate([[True], (who[1:] != who[:-1]) | (window[1:] != window[:-1])]))
        place = np.arange(len(who)) - np.repeat(begins, np.diff(np.append(begins, len(who))))
        first = place < self.wanted.top
        return who[first], window[first], score[first], row[first]


@dataclass
class Net:
    """The coarse level: sampled rows with labels, and per centre a radius that covers all its rows."""

    rows: np.ndarray
    labels: np.ndarray
    ids: np.ndarray
    centres: np.ndarray
    most: float
    radius: np.ndarray | None = None
    blocks: np.ndarray | None = None
    ranges: np.ndarray | None = None


def fit_net(rows: DataFrame) -> Net | None:
    """Centres from a sample of at most SAMPLE rows, the first by a hash of their id; None without rows."""
    norm = F.aggregate("weights", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    n, most = rows.agg(F.count(F.lit(1)), F.max(norm)).first()
    if not n:
        return None
    order = [F.xxhash64("vec_id"), F.col("vec_id"), F.col("label"), F.col("weights")]
    sample = rows.orderBy(*order).limit(SAMPLE).toArrow()
    found = matrix(sample["weights"])
    space = Space(found, most)
    centres, *_ = net(space, np.arange(len(found)), 0, min(MOST_CENTRES, max(1, n // ROWS_PER_CENTRE)), 0.0)
    return Net(found, sample["label"].to_numpy(), sample["vec_id"].to_numpy(), np.array(centres), most)


def deal(rows: DataFrame, of: Net) -> DataFrame:
    """The rows with their nearest centre and block; fills in what the net covers.

    All rows are assigned; a centre with many rows is cut into blocks of about CELL_ROWS by a hash, so that no
    cell grows with the data, repeated vectors included.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(of)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        centres = at.rows[at.centres]
        lift = np.sqrt(np.maximum(at.most - squares(centres), 0))
        for batch in batches:
            here = matrix(batch.column("weights"))
            own = np.sqrt(np.maximum(at.most - squares(here), 0))
            inner = products(here, centres) + own[:, None] * lift
            nearest = inner.argmax(axis=1) if len(here) else np.zeros(0, np.int64)
            away = np.sqrt(np.maximum(2 * (at.most - inner[np.arange(len(here)), nearest]), 0))
            columns = [*batch.columns, pa.array(nearest, pa.int32()), pa.array(away, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "centre", "away"])

    schema = "vec_id bigint, label bigint, weights array<bigint>, centre int, away double"
    placed = materialize(rows.mapInArrow(assign, schema), "centres")
    covered = placed.groupBy("centre").agg(
        F.max("away").alias("radius"), F.count(F.lit(1)).alias("n"), F.min("label").alias("a"), F.max("label").alias("b")
    )
    of.radius, of.blocks = np.full(len(of.centres), -1.0), np.ones(len(of.centres), np.int64)
    of.ranges = np.zeros((len(of.centres), 2), np.int64)
    for r in covered.collect():
        of.radius[r["centre"]] = r["radius"] * (1 + 1e-9) + 1e-6
        of.blocks[r["centre"]] = -(-r["n"] // CELL_ROWS)
        of.ranges[r["centre"]] = r["a"], r["b"]
    blocks = F.element_at(F.array([F.lit(int(b)) for b in of.blocks]), F.col("centre") + 1)
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), blocks.cast("bigint")).cast("int")
    return materialize(placed.select("vec_id", "label", "weights", "centre", block.alias("block")), "cells")


_ANCHOR = "vec_id bigint, label bigint, weights array<bigint>, low array<bigint>, high array<bigint>"


def _windows(lists: pa.Array | pa.ChunkedArray, width: int, fill: int) -> np.ndarray:
    out = np.full((len(lists), width), fill, np.int64)
    for i, values in enumerate(lists.to_pylist()):
        out[i, : len(values)] = values
    return out


def _wanted(rows: pa.RecordBatch | pa.Table, same: bool, top: int) -> Wanted:
    """Anchors of a piece; missing windows can hold nothing."""
    width = max([1, *(len(x) for x in rows.column("low").to_pylist())])
    low = _windows(rows.column("low"), width, np.iinfo(np.int64).max)
    high = _windows(rows.column("high"), width, np.iinfo(np.int64).min)
    ids, labels = (rows.column(c).to_numpy() for c in ("vec_id", "label"))
    bar = np.full(low.shape, np.iinfo(np.int64).min)
    return Wanted(ids, labels, matrix(rows.column("weights")), low, high, same, top, bar)


def route(anchors: DataFrame, of: Net, same: bool, top: int) -> DataFrame:
    """The anchors once per cell that can hold something for them.

    The sampled rows are scored first: what `top` of them reach, in a window, cells must be able to reach too.
    """
    shared = anchors.sparkSession.sparkContext.broadcast(of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        filled = np.flatnonzero(at.radius >= 0)
        for whole in batches:
            for begin in range(0, whole.num_rows, ANCHORS_TOGETHER):
                batch = whole.slice(begin, ANCHORS_TOGETHER)
                wanted = _wanted(batch, same, top)
                first = Search(wanted, at.ids, at.labels, at.rows, at.most)
                for start in range(0, len(at.rows), LEAF):
                    first._leaf(np.arange(start, min(start + LEAF, len(at.rows))), np.arange(batch.num_rows))
                inner = products(wanted.rows, at.rows[at.centres[filled]]).astype(np.float64)
                least, greatest = bounds(inner, first.own[:, None], at.most, at.radius[filled])
                everyone = np.arange(batch.num_rows)
                for column, centre in enumerate(filled):
                    reach = wanted.open(everyone, least[:, column], greatest[:, column], tuple(at.ranges[centre]))
                    who = batch.take(pa.array(np.flatnonzero(reach)))
                    for block in range(at.blocks[centre] if who.num_rows else 0):
                        keys = [pa.array(np.full(who.num_rows, x), pa.int32()) for x in (centre, block)]
                        names = [*who.schema.names, "centre", "block"]
                        yield pa.RecordBatch.from_arrays([*who.columns, *keys], names)

    return anchors.mapInArrow(run, f"{_ANCHOR}, centre int, block int")


def visit(anchors: DataFrame, cells: DataFrame, of: Net, same: bool, top: int) -> DataFrame:
    """anchor_id, slot (of the window), vec_id, score and rank of the best rows of every window, over all cells."""
    routed = materialize(route(anchors, of, same, top), "visits")
    # A cell that many anchors visit is searched by blocks of them: counted first, bounded by the number of cells.
    visits = routed.groupBy("centre", "block").agg(F.count(F.lit(1)).alias("_n"))
    parts = F.ceil(F.col("_n") / ANCHORS_TOGETHER).cast("int")
    visits = materialize(visits.select("centre", "block", parts.alias("parts")), "visited-cells")
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts").cast("bigint")).cast("int")
    left = routed.join(visits, ["centre", "block"]).withColumn("part", part).drop("parts")
    right = cells.join(visits, ["centre", "block"])
    right = right.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    most = of.most

    def search(asked: pa.Table, rows: pa.Table) -> pa.Table:
        names = ["anchor_id", "slot", "vec_id", "score"]
        columns: list[list[np.ndarray]] = [[] for _ in names]
        if rows.num_rows:
            ids, labels, weights = rows["vec_id"].to_numpy(), rows["label"].to_numpy(), matrix(rows["weights"])
            for start in range(0, asked.num_rows, 2 * ANCHORS_TOGETHER):
                wanted = _wanted(asked.slice(start, 2 * ANCHORS_TOGETHER).combine_chunks(), same, top)
                who, window, score, row = Search(wanted, ids, labels, weights, most).run()
                for column, values in zip(columns, (wanted.ids[who], window, ids[row], score)):
                    column.append(values)
        found = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
        return pa.table([pa.array(x, pa.int64()) for x in found], names=names)

    keys = ["centre", "block", "part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        search, "anchor_id bigint, slot bigint, vec_id bigint, score bigint"
    )
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.where(F.col("rank") <= top)


def _above(value: Column, by: int) -> Column:
    """The quotient, rounded up, in whole numbers."""
    return F.call_function("div", value + F.pmod(-value, F.lit(by)), F.lit(by))


def mine(
    vectors: DataFrame, every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score and positive_rank.

    Anchors are the rows whose id `every` divides; of rows that share such an id the first by label and vector
    is the anchor. Other rows count each, repeated ones too, but never for an anchor of their own id. A shorter
    vector is zero beyond its end. Windows of negative positives are empty. Rows with nulls or components
    that are not finite take no part; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ship(spark)
    base = materialize(sound_rows(vectors), "vectors")
    of = fit_net(base)
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
    schema += "negative_score bigint, positive_rank int"
    if of is None:
        return spark.createDataFrame([], schema)
    cells = deal(base, of)
    own = base.where(F.col("vec_id") % every == 0).groupBy("vec_id")
    own = own.agg(F.min(F.struct("label", "weights")).alias("first")).select("vec_id", "first.label", "first.weights")
    whole = [F.array(F.lit(edge).cast("bigint")).alias(c) for c, edge in (("low", -(2**63)), ("high", 2**63 - 1))]
    found = materialize(visit(own.select("*", *whole), cells, of, True, positives), "positives")
    listed = found.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("listed"))
    low = F.transform("listed", lambda x: _above(x["score"], 2))
    high = F.transform("listed", lambda x: x["score"] - _above(x["score"], 20))
    windows = own.join(listed.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    windows = windows.select("vec_id", "label", "weights", low.alias("low"), high.alias("high"))
    hard = visit(windows, cells, of, False, negatives)
    hard = hard.select(
        "anchor_id", (F.col("slot") + 1).cast("int").alias("positive_rank"), "rank",
        F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"),
    )
    kept = found.select(
        "anchor_id", F.col("rank").alias("positive_rank"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    joined = hard.join(kept, ["anchor_id", "positive_rank"])
    return joined.select([c.split()[0] for c in schema.split(", ")])
