"""N-gram Jaccard join: size-banded tiles, hashed bitmaps, exact intersection of sorted arrays.

A document is its set of hashed word shingles. Sets that link differ in size by a tenth at most and
in at most d shingles, d following from their sizes. Sizes are banded; within a band's tiles the
hash space is dealt into more than d parts, so that linked sets agree on a part as a whole: a tile
is what shares a band, a part and that part's content. Unlike sets hardly ever meet in a tile.

Sets that meet are compared with one member of a tile first, and again while a tile holds several
components; then, in tiles that still do, all pairs across components. Bitmaps with a bit per hashed
shingle, set by the parity of their number, bound the overlap from above by a bit count, and only
what passes is intersected: hashes of sets move for pairs that are likely to link.

That connects what links. To count every link, sets of a component, which holds all links of its
members, are then compared with each other, block by block: each pair in one cell, counted there and
never made a row.
"""

from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import fits_broadcast, mix, ship, slices, utf8_bytes
from llm.components import connected_components
from llm.features import hash_spans
from presswork.sources.shared import materialize

SHINGLE = 3
# Documents link when PART * |intersection| >= SHARE * |union|.
SHARE, PART = 90, 100
BAND_GROWTH = 1.5
BITMAP_WORDS = 32
# Rounds in which sets outside a tile's largest component are compared with a member of that.
PROBES = 2
# Sets that are compared at once in a tile; larger tiles are cut into blocks and paired.
BLOCK = 1024
# Sets, and bytes of their hashes, in a block in which links of a component are counted.
COUNT_BLOCK, COUNT_BYTES = 512, 8 << 20


def difference_bound(size_sum: int) -> int:
    """Most shingles in which two sets that link can differ, from the sum of their sizes."""
    return size_sum * (PART - SHARE) // (PART + SHARE)


@cache
def bands(longest: int) -> np.ndarray:
    """First size of every band; sets below the first band link only when they are equal."""
    first = 1
    while difference_bound(2 * first + 1) == 0:
        first += 1
    found = [first]
    while found[-1] <= longest:
        found.append(max(found[-1] + 1, int(found[-1] * BAND_GROWTH)))
    return np.array(found)


def parts_of(band_end: int) -> tuple[int, int]:
    """Parts for the tiles of a band, and how many of a set's parts may be empty without being used.

    With that many parts more than needed, sets that link agree on more parts than either has
    empty ones, unless it has more; only then its empty parts are used.
    """
    needed = difference_bound(2 * (band_end - 1)) + 1
    spare = 2 + needed // 16
    return needed + spare, spare


class Sets:
    """Sorted shingle sets of some texts, one after another, with their bounds."""

    def __init__(self, texts: pa.Array):
        content, offsets = utf8_bytes(texts)
        capital = (content >= 65) & (content <= 90)
        lowered = content + capital.astype(np.uint8) * np.uint8(32)
        inside = ~((lowered == 32) | ((lowered >= 9) & (lowered <= 13)))
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        edges = offsets[:-1][offsets[:-1] < len(content)]
        first[edges] = inside[edges]
        starts = np.flatnonzero(first)
        # Letters between spaces, run together, have the words' bounds at the letters' running count.
        letters = np.concatenate([[0], np.cumsum(inside)])
        bounds = np.append(letters[starts], letters[-1])
        words = hash_spans(lowered[inside].astype(np.uint64), bounds)
        ends = np.searchsorted(starts, offsets)
        n_words = np.diff(ends)
        owner = np.repeat(np.arange(len(texts)), n_words)
        with np.errstate(over="ignore"):
            chain = words * np.uint64(3)
            whole = np.ones(len(words), bool)
            for step in range(1, SHINGLE):
                after = np.zeros_like(words)
                after[:-step] = words[step:] if step < len(words) else 0
                reached = np.zeros(len(words), bool)
                if step < len(words):
                    reached[:-step] = owner[step:] == owner[:-step]
                short = (n_words[owner] <= step) if len(owner) else reached
                whole &= reached | short
                chain = np.where(reached, mix(chain) + after * np.uint64(2 * step + 3), chain)
        place = np.arange(len(words)) - ends[:-1][owner] if len(owner) else np.zeros(0, np.int64)
        whole &= (n_words[owner] >= SHINGLE) | (place == 0)
        owner, hashes = owner[whole], mix(chain[whole] + np.minimum(n_words[owner[whole]], SHINGLE).astype(np.uint64))
        order = np.lexsort((hashes, owner))
        owner, hashes = owner[order], hashes[order]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
        self.hashes, self.owner = hashes[new], owner[new]
        self.sizes = np.bincount(self.owner, minlength=len(texts)).astype(np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)])

    def fingerprints(self, salt: int) -> np.ndarray:
        """A hash of each set."""
        return mix(self._sums(mix(self.hashes ^ np.uint64(salt)), self.owner, len(self.sizes)))

    @staticmethod
    def _sums(values: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
        """Sums of 64-bit values, modulo 2**64, of groups that are in order."""
        total = np.zeros(n, np.uint64)
        if len(values):
            at = np.flatnonzero(np.diff(groups, prepend=-1))
            total[groups[at]] = np.add.reduceat(values, at)
        return total

    def tile_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Owners and keys of the tiles that the sets belong to."""
        starts = bands(int(self.sizes.max(initial=0)) * 2)
        own = np.searchsorted(starts, self.sizes, side="right") - 1
        owners, keys = [], []
        for band in range(max(0, own.min(initial=0)), own.max(initial=-1) + 2):
            if band + 1 >= len(starts):
                break
            # A set also meets larger ones, of the next band, if their sizes can be near enough.
            near = (own == band - 1) & (self.sizes * PART >= SHARE * starts[band])
            chosen = np.flatnonzero((own == band) | near)
            if not len(chosen):
                continue
            parts, spare = parts_of(int(starts[band + 1]))
            seat = np.full(len(self.sizes), -1)
            seat[chosen] = np.arange(len(chosen))
            mine = seat[self.owner]
            hashes, mine = self.hashes[mine >= 0], mine[mine >= 0]
            part = (mix(hashes ^ np.uint64(0x5EED + band)) % np.uint64(parts)).astype(np.int64)
            cell = mine * parts + part
            order = np.argsort(cell, kind="stable")
            sums = self._sums(mix(hashes[order] ^ np.uint64(0xC0DE)), cell[order], len(chosen) * parts)
            filled = np.zeros(len(chosen) * parts, bool)
            filled[cell] = True
            filled = filled.reshape(len(chosen), parts)
            used = filled | ((~filled).sum(axis=1) > spare)[:, None]
            tag = np.arange(parts, dtype=np.uint64) + np.uint64(band << 32)
            with np.errstate(over="ignore"):
                found = mix(sums.reshape(len(chosen), parts) + mix(tag))
            owners.append(np.repeat(chosen, used.sum(axis=1)))
            keys.append(found[used])
        if not owners:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return np.concatenate(owners), np.concatenate(keys)

    def bitmaps(self) -> np.ndarray:
        """Bitmaps, a row of 64-bit words per set: each bit is the parity of the shingles hashed to it."""
        bits = BITMAP_WORDS * 64
        place = (mix(self.hashes ^ np.uint64(0xB17)) % np.uint64(bits)).astype(np.int64)
        odd = np.bincount(self.owner * bits + place, minlength=len(self.sizes) * bits) & 1
        packed = np.packbits(odd.astype(np.uint8).reshape(len(self.sizes), bits), axis=1, bitorder="little")
        return packed.view(np.uint64).reshape(len(self.sizes), BITMAP_WORDS)


def overlap_bound(sizes_a, sizes_b, bits_a: np.ndarray, bits_b: np.ndarray) -> np.ndarray:
    """Most shingles that sets can share: every differing bit stands for one that they do not."""
    differing = np.bitwise_count(bits_a ^ bits_b).sum(axis=-1).astype(np.int64)
    return (sizes_a + sizes_b - differing) // 2


def links(shared, sizes_a, sizes_b):
    """Whether sets of these sizes link if they share so many shingles."""
    return PART * shared >= SHARE * (sizes_a + sizes_b - shared)


def _as_long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def describe(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, two fingerprints of the set and the keys of its tiles, per row."""
    ship(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "text"):
            sets = Sets(texts)
            owners, keys = sets.tile_keys()
            order = np.argsort(owners, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(texts)))])
            columns = [rows.column("doc_id"), pa.array(sets.sizes)]
            columns += [_as_long(sets.fingerprints(1)), _as_long(sets.fingerprints(2))]
            columns += [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _as_long(keys[order]))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "f1", "f2", "keys"])

    schema = f"doc_id {kind}, n_shingles bigint, f1 bigint, f2 bigint, keys array<bigint>"
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def _load_sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, size, bitmap and sorted hashes of the wanted sets (node, f1, f2, weight), and f1, f2 and weight,
    from the texts of their nodes."""
    texts = documents.select(F.col("doc_id").alias("node"), "text")
    side = F.broadcast(wanted) if fits_broadcast(wanted, F.lit(48)) else wanted
    chosen = texts.join(side, "node")
    kind = chosen.schema["node"].dataType.simpleString()
    names = ["node", "size", "bitmap", "hashes", "f1", "f2", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "text"):
            sets = Sets(texts)
            right = sets.fingerprints(1).view(np.int64) == rows.column("f1").to_numpy()
            right &= sets.fingerprints(2).view(np.int64) == rows.column("f2").to_numpy()
            at = np.flatnonzero(right)
            maps = [x.tobytes() for x in sets.bitmaps()[at]]
            hashes = [sets.hashes[sets.bounds[i] : sets.bounds[i + 1]].tobytes() for i in at]
            columns = [rows.column("node").take(pa.array(at))]
            columns += [pa.array(sets.sizes[at]), pa.array(maps, pa.binary()), pa.array(hashes, pa.binary())]
            columns += [rows.column(c).take(pa.array(at)) for c in ("f1", "f2", "weight")]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"node {kind}, size bigint, bitmap binary, hashes binary, f1 bigint, f2 bigint, weight bigint"
    # Rows that share an id are one node; of their sets, those that were wanted.
    return chosen.mapInArrow(run, schema).dropDuplicates(["node", "hashes"])


def _both(pairs: DataFrame, sets: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b) of nodes with columns of both sets, named by side."""
    for side in "ab":
        own = sets.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
        pairs = pairs.join(own, side)
    return pairs


def _possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs whose bitmaps do not rule a link out."""
    joined = _both(pairs, sets, ["size", "bitmap"])
    kind = sets.schema["node"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            sizes = [rows.column(f"size_{s}").to_numpy() for s in "ab"]
            maps = [_unpack(rows.column(f"bitmap_{s}").to_pylist()) for s in "ab"]
            likely = pa.array(np.flatnonzero(links(overlap_bound(*sizes, *maps), *sizes)))
            yield pa.RecordBatch.from_arrays([rows.column(s).take(likely) for s in "ab"], ["a", "b"])

    return joined.mapInArrow(run, f"a {kind}, b {kind}")


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs that link: bitmaps first, which are small, then the hashes of what is left."""
    joined = _both(_possible(pairs, sets), sets, ["size", "hashes"])
    kind = sets.schema["node"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            sizes = [rows.column(f"size_{s}").to_numpy() for s in "ab"]
            both = zip(rows.column("hashes_a"), rows.column("hashes_b"))
            shared = np.array([_shared(x.as_buffer(), y.as_buffer()) for x, y in both], np.int64)
            found = pa.array(np.flatnonzero(links(shared, *sizes)))
            yield pa.RecordBatch.from_arrays([rows.column(s).take(found) for s in "ab"], ["a", "b"])

    return joined.mapInArrow(run, f"a {kind}, b {kind}")


def _unpack(maps: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(maps), np.uint64).reshape(-1, BITMAP_WORDS)


def _shared(a: pa.Buffer, b: pa.Buffer) -> int:
    """Size of the intersection of two sorted arrays."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return int((y[at] == x).sum())


def _compare_tile(tile: pd.DataFrame) -> pd.DataFrame:
    """Pairs across components, within a tile or between two blocks of it, that bitmaps do not rule out."""
    size = tile["size"].to_numpy()
    node = tile["node"].to_numpy()
    maps = _unpack(list(tile["bitmap"]))
    _, group = np.unique(tile["component"].to_numpy(), return_inverse=True)
    found = []
    for i in range(len(tile) - 1):
        rest = np.flatnonzero(group[i + 1 :] != group[i]) + i + 1
        near = links(overlap_bound(size[i], size[rest], maps[i], maps[rest]), size[i], size[rest])
        found += [(min(node[i], node[j]), max(node[i], node[j])) for j in rest[near]]
    return pd.DataFrame(found, columns=["a", "b"])


def _open_tiles(shared: DataFrame, found: DataFrame) -> DataFrame:
    """Members (key, node, component) of the tiles that hold several components, and the largest one, _main."""
    members = shared.join(connected_components(found), "node", "left")
    members = members.select("key", "node", F.coalesce("component", "node").alias("component"))
    tiles = members.groupBy("key").agg(
        F.min("component").alias("_low"),
        F.max("component").alias("_high"),
        F.bit_xor(F.xxhash64("node")).alias("_x"),
        F.bit_xor(F.xxhash64(F.lit(3), "node")).alias("_y"),
        F.count(F.lit(1)).alias("_n"),
    )
    # Tiles with the same members are gone through once.
    mixed = tiles.where(F.col("_low") != F.col("_high")).groupBy("_x", "_y", "_n").agg(F.min("key").alias("key"))
    rows = members.join(mixed.select("key", "_n"), "key")
    sizes = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("_size"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("_size", "component"))["component"].alias("_main"))
    return materialize(rows.join(largest, "key"), "open-tiles")


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _probes(seated: DataFrame, number: int) -> DataFrame:
    """A pair for every node outside the largest component of a tile: one tile each, and one member of that component."""
    draw = F.min(F.struct(F.xxhash64(F.lit(number), "node"), "node"))["node"].alias("_probe")
    probe = seated.where(F.col("component") == F.col("_main")).groupBy("key").agg(draw)
    others = seated.where(F.col("component") != F.col("_main")).join(probe, "key")
    one = others.groupBy("node").agg(F.min(F.struct(F.xxhash64(F.lit(number), "_probe"), "_probe"))["_probe"].alias("_probe"))
    return one.select(*_pair("node", "_probe")).distinct()


def _pairs_across(seated: DataFrame, sets: DataFrame) -> DataFrame:
    """All pairs across components in open tiles that bitmaps do not rule out; large tiles go by pairs of blocks."""
    blocks = F.ceil(F.col("_n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    # A set goes to the pairs of its block with every block.
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    cells = seated.select("key", "node", "component", block.alias("_block"), other.alias("_other")).select(
        "key", "node", "component", F.least("_block", "_other").alias("_i"), F.greatest("_block", "_other").alias("_j")
    )
    cells = cells.join(sets.select("node", "size", "bitmap"), "node")
    kind = sets.schema["node"].dataType.simpleString()
    return cells.groupBy("key", "_i", "_j").applyInPandas(_compare_tile, f"a {kind}, b {kind}").distinct()


def set_links(shared: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) of nodes, enough to connect all that link, from the members (key, node) of tiles."""
    lowest = shared.groupBy("key").agg(F.min("node").alias("_probe"))
    first = shared.join(lowest, "key").groupBy("node").agg(F.min("_probe").alias("_probe"))
    pairs = first.where(F.col("node") != F.col("_probe")).select(*_pair("node", "_probe"))
    found = tried = None
    for number in range(PROBES + 1):
        pairs = materialize(pairs, "probes")
        new = materialize(_verify(pairs, sets), "set-links")
        found = new if found is None else found.unionAll(new)
        tried = pairs if tried is None else tried.unionAll(pairs)
        seated = _open_tiles(shared, found)
        pairs = _probes(seated, number).join(tried, ["a", "b"], "left_anti")
    rest = _pairs_across(seated, sets).join(tried, ["a", "b"], "left_anti")
    return found.unionAll(materialize(_verify(materialize(rest, "probes"), sets), "set-links"))


def _count_cell(cell: pd.DataFrame) -> pd.DataFrame:
    """f1, f2 and the weight of the sets that link with each, within a block or between two."""
    cell = cell.sort_values(["_block", "size"], kind="stable")
    size, weight = cell["size"].to_numpy(), cell["weight"].to_numpy()
    flat = np.concatenate([np.frombuffer(h, np.uint64) for h in cell["hashes"]])
    _, place = np.unique(flat, return_inverse=True)
    bounds = np.concatenate([[0], np.cumsum(size)])
    first = int((cell["_block"] == cell["_block"].iloc[0]).sum())
    apart = first < len(cell)
    mark = np.zeros(len(flat), bool)
    total = np.zeros(len(cell), np.int64)
    within = cell["_i"].iloc[0] == cell["_j"].iloc[0]
    # A cell of two blocks of which one is empty has no pairs.
    for i in range(first if within or apart else 0):
        # Others are in order of size: those near enough stand together.
        start = first if apart else i + 1
        low, high = -(-SHARE * size[i] // PART), PART * size[i] // SHARE
        a = start + int(np.searchsorted(size[start:], low))
        b = start + int(np.searchsorted(size[start:], high, side="right"))
        if a >= b:
            continue
        own = place[bounds[i] : bounds[i + 1]]
        mark[own] = True
        shared = np.add.reduceat(mark[place[bounds[a] : bounds[b]]], bounds[a:b] - bounds[a], dtype=np.int64)
        mark[own] = False
        linked = links(shared, size[i], size[a:b])
        total[i] += weight[a:b][linked].sum()
        total[a:b][linked] += weight[i]
    return pd.DataFrame({"f1": cell["f1"].to_numpy(), "f2": cell["f2"].to_numpy(), "n": total})


def count_links(sets: DataFrame, components: DataFrame) -> DataFrame:
    """f1, f2 and n, the weight of all other sets that link with a set, for those in a component with others."""
    placed = sets.select("node", "f1", "f2", "size").join(components, "node")
    stats = placed.groupBy("component").agg(F.count(F.lit(1)).alias("_n"), (F.sum("size") * 8).alias("_bytes"))
    blocks = F.ceil(F.greatest(F.col("_n") / COUNT_BLOCK, F.col("_bytes") / COUNT_BYTES)).cast("int")
    several = stats.where(F.col("_n") > 1).select("component", blocks.alias("_blocks"))
    seats = placed.join(several, "component").select("node", "f1", "f2", "component", "_blocks")
    seats = materialize(seats, "seats")
    side = F.broadcast(seats) if fits_broadcast(seats, F.lit(56)) else seats
    block = F.pmod(F.xxhash64("f1", "f2"), F.col("_blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    rows = sets.select("node", "f1", "f2", "weight", "size", "hashes").join(side, ["node", "f1", "f2"])
    dealt = rows.select("component", "f1", "f2", "weight", "size", "hashes", block.alias("_block"), other.alias("_other"))
    cells = dealt.withColumn("_i", F.least("_block", "_other")).withColumn("_j", F.greatest("_block", "_other"))
    counted = cells.drop("_other").groupBy("component", "_i", "_j").applyInPandas(
        _count_cell, "f1 bigint, f2 bigint, n bigint"
    )
    return counted.groupBy("f1", "f2").agg(F.sum("n").alias("n"))


def _join(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What `describe` gives, the classes of equal sets, those sets that met others, and the components of ids."""
    described = materialize(describe(documents), "sets")
    linked = described.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = linked.groupBy("f1", "f2").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("weight"))
    seats = linked.select("f1", F.explode("keys").alias("key"))
    # Lowest and highest member, combined before the shuffle, tell which tiles hold several sets.
    several = seats.groupBy("key").agg(F.min("f1").alias("_low"), F.max("f1").alias("_high"))
    several = several.where(F.col("_low") != F.col("_high")).select("key")
    met = materialize(seats.join(several, "key").distinct(), "tiles")
    wanted = classes.join(met.select("f1").distinct(), "f1", "left_semi").select("node", "f1", "f2", "weight")
    wanted = materialize(wanted, "wanted")
    sets = materialize(_load_sets(documents, wanted), "hashes")
    shared = materialize(met.join(wanted, "f1").select("key", "node").distinct(), "tiles")
    same_id = linked.join(classes, ["f1", "f2"]).where(F.col("doc_id") != F.col("node"))
    every = set_links(shared, sets).unionAll(same_id.select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    return described, classes, sets, connected_components(every)


def jaccard_components(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest id that a document is linked with, per row.

    Null and empty texts have no shingles and link with nothing. A document without an id has no component; rows
    that share an id are one document, whatever their texts. Equal sets are compared as one.
    """
    described, _, _, components = _join(documents)
    return _attach(described, components)


def jaccard_links(documents: DataFrame) -> DataFrame:
    """As jaccard_components, with n_links: the number of other rows, of those with an id, that a row links with.

    A row without an id has none. Links with equal sets count; rows that share an id are counted each.
    """
    described, classes, sets, components = _join(documents)
    counted = classes.join(count_links(sets, components), ["f1", "f2"], "left")
    n_links = F.col("weight") - 1 + F.coalesce("n", F.lit(0))
    counted = counted.select("f1", "f2", n_links.alias("n_links")).where(F.col("n_links") > 0)
    named = described.drop("keys").join(counted, ["f1", "f2"], "left")
    known = F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0)))
    return _attach(named.withColumn("n_links", known), components, ["n_links"])


def _attach(described: DataFrame, components: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    component: Column = F.coalesce("component", "doc_id").alias("component_id")
    named = components.withColumnRenamed("node", "doc_id")
    return described.join(named, "doc_id", "left").select("doc_id", "n_shingles", component, *more)
