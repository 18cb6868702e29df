"""Divergence of sources: how far the word use of a language's sources lies from that of each other and of the language.

Counts of kept terms are columns, one per source, over a vocabulary whose order puts terms with equal
counts side by side. Columns are run-length encoded tile by tile; for a pair of sources the run boundaries
are intersected, and the divergence of a run is taken once and multiplied by its length.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import fits_broadcast, ship, slices
from llm.features import letter_runs
from presswork.sources.shared import materialize

LEAST_DOCUMENTS = 3
TOP_TERMS = 200
ONE = 1_000_000_000
SLICE_BYTES = 4 << 20
# A tile is so many terms of the vocabulary, as a power of two; a cell is a tile of two blocks of sources.
TILE_BITS, BLOCK_SOURCES = 14, 32


def _counted(rows: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
    """lang, source, term, n and docs of a piece; a row without a term stands for the group itself."""
    words = letter_runs(texts)
    size = max(1, len(words.distinct))
    empty = pa.scalar("", pa.large_string())
    names = [rows.column(c).cast(pa.large_string()).fill_null(empty) for c in ("lang", "source")]
    codes = [x.dictionary_encode() for x in names]
    pair = [c.indices.to_numpy().astype(np.int64) for c in codes]
    groups, group = np.unique(pair[0] * len(codes[1].dictionary) + pair[1], return_inverse=True)
    document = np.repeat(np.arange(len(texts)), np.diff(words.starts))
    here, often = np.unique(document * size + words.ids, return_counts=True)
    key, place = np.unique(group[here // size] * size + here % size, return_inverse=True)
    n = np.concatenate([np.bincount(place, often, len(key)), np.zeros(len(groups))]).astype(np.int64)
    docs = np.concatenate([np.bincount(place, minlength=len(key)), np.zeros(len(groups), np.int64)])
    of = np.concatenate([groups[key // size], groups])
    terms = pa.concat_arrays([words.distinct.take(pa.array(key % size)), pa.nulls(len(groups), pa.large_string())])
    lang = codes[0].dictionary.take(pa.array(of // len(codes[1].dictionary)))
    source = codes[1].dictionary.take(pa.array(of % len(codes[1].dictionary)))
    columns = [lang, source, terms]
    columns = [x.cast(pa.string()) for x in columns] + [pa.array(n, pa.int64()), pa.array(docs, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


def term_counts(documents: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents); one row per group has a null term."""
    ship(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "text", SLICE_BYTES):
            yield _counted(rows, texts)

    schema = "lang string, source string, term string, n bigint, docs bigint"
    found = documents.select("lang", "source", "text").mapInArrow(run, schema)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column) -> Column:
    """1 + floor(ONE * (n + 1) / total) without overflow; 1 where there is no total."""
    scaled = (n + 1).cast("decimal(19,0)") * F.lit(ONE).cast("decimal(10,0)")
    whole = F.call_function("div", scaled, F.when(total > 0, total).cast("decimal(19,0)"))
    return F.lit(1).cast("bigint") + F.coalesce(whole, F.lit(0).cast("bigint"))


def _divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def vocabulary(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, term, lang_n and pos of kept terms. Positions rise along an order of each language's terms
    by the source that has most of it, how many, how many in all, and a digest of all its counts."""
    of_term = counts.where(F.col("term").isNotNull()).groupBy("lang", "term")
    kept = of_term.agg(
        F.sum("docs").alias("docs"),
        F.sum("n").alias("lang_n"),
        F.max(F.struct("n", "source")).alias("lead"),
        F.bit_xor(F.xxhash64("source", "n")).alias("digest"),
    ).where(F.col("docs") >= least)
    order = ["lang", "lead_source", "lead_n", "lang_n", "digest", "term"]
    kept = kept.select(
        "lang", "term", "lang_n", F.col("lead.n").alias("lead_n"), F.col("lead.source").alias("lead_source"), "digest"
    )
    placed = materialize(kept, "kept-terms").repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.select("lang", "term", "lang_n", F.monotonically_increasing_id().alias("pos"))


def _small(df: DataFrame, row_bytes: Column) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, row_bytes) else df


@dataclass
class Divergence:
    """Stored tables of one audit: kept counts with positions, groups with totals, tiles of the vocabulary."""

    entries: DataFrame
    groups: DataFrame
    tiles: DataFrame

    def with_groups(self, df: DataFrame, *columns: str) -> DataFrame:
        """The rows with columns of their group, found by lang and source."""
        row = F.length("lang") + F.length("source") + F.lit(64)
        return df.join(_small(self.groups.select("lang", "source", *columns), row), ["lang", "source"])


def prepare(documents: DataFrame, least: int = LEAST_DOCUMENTS) -> Divergence:
    counts = materialize(term_counts(documents), "term-counts")
    terms = materialize(vocabulary(counts, least), "vocabulary")
    named = counts.where(F.col("term").isNotNull()).select("lang", "source", "term", "n")
    entries = materialize(named.join(terms, ["lang", "term"]), "term-entries")
    of_group = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    groups = counts.where(F.col("term").isNull()).select("lang", "source")
    groups = groups.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = groups.fillna(0, ["total", "v", "lang_total"])
    # One narrow row per group: this numbering is bounded by the pairs that a language's result has.
    inside = Window.partitionBy("lang").orderBy("source")
    groups = groups.withColumn("i", F.row_number().over(inside) - 1)
    groups = groups.withColumn("blocks", F.ceil(F.count(F.lit(1)).over(Window.partitionBy("lang")) / BLOCK_SOURCES))
    groups = groups.withColumn("blocks", F.col("blocks").cast("int"))
    groups = groups.withColumn("zero", _share(F.lit(0).cast("bigint"), F.col("total") + F.col("v")))
    groups = materialize(groups, "source-groups")
    tiles = terms.groupBy("lang", F.shiftright("pos", TILE_BITS).alias("tile")).agg(
        F.min("pos").alias("pos"), F.count(F.lit(1)).cast("int").alias("size")
    )
    bare = groups.where(F.col("v") == 0).select(
        "lang", F.lit(-1).cast("bigint").alias("tile"), F.lit(-1).cast("bigint").alias("pos"), F.lit(0).alias("size")
    )
    return Divergence(entries, groups, materialize(tiles.unionByName(bare.distinct()), "vocabulary-tiles"))


def run_lengths(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of a column begin, and their values."""
    begins = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]])) if len(column) else np.zeros(0, np.int64)
    return begins, column[begins]


def pair_values(
    left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], size: int
) -> tuple[int, int]:
    """Divergence of the left column from the right one and the other way round, from their runs."""
    cuts = np.sort(np.concatenate([left[0], right[0]]), kind="stable")
    cuts = cuts[np.concatenate([[True], cuts[1:] != cuts[:-1]])] if len(cuts) else cuts
    lengths = np.diff(np.append(cuts, size))
    p = left[1][np.searchsorted(left[0], cuts, "right") - 1]
    q = right[1][np.searchsorted(right[0], cuts, "right") - 1]
    square = (p - q) ** 2
    return int((square // q * lengths).sum()), int((square // p * lengths).sum())


def _cell(rows: pa.Table, width: int) -> pa.Table:
    """Values of all pairs of the two blocks, of `width` sources, over one tile; rows of size >= 0 head the columns."""
    i, size, pos, share = (rows[c].to_numpy() for c in ("i", "size", "pos", "share"))
    low, high, lang = (rows[c][0].as_py() for c in ("low", "high", "lang_no"))
    heads = np.flatnonzero(size >= 0)
    length, start = int(size[heads[0]]), int(pos[heads[0]])
    entries = np.flatnonzero(size < 0)
    entries = entries[np.argsort(i[entries], kind="stable")]
    runs = {}
    for head in heads:
        a, b = np.searchsorted(i[entries], [i[head], i[head] + 1])
        column = np.full(length, share[head], np.int64)
        column[pos[entries[a:b]] - start] = share[entries[a:b]]
        runs[int(i[head])] = run_lengths(column)
    out: tuple[list, list, list] = ([], [], [])
    for x in runs:
        for y in runs:
            if (low == high and x < y) or (low < high and x // width == low and y // width == high):
                there, back = pair_values(runs[x], runs[y], length)
                for column, pair in zip(out, ((x, y), (y, x), (there, back))):
                    column.extend(pair)
    columns = [pa.array(np.full(len(out[0]), lang), pa.int32())]
    columns += [pa.array(x, kind) for x, kind in zip(out, (pa.int32(), pa.int32(), pa.int64()))]
    return pa.table(columns, names=["lang_no", "a", "b", "value"])


def source_pairs(of: Divergence) -> DataFrame:
    """lang, source, item (each other source of the language), value and rank."""
    langs = of.groups.select("lang").distinct().withColumn("lang_no", F.row_number().over(Window.orderBy("lang")))
    groups = of.groups.join(F.broadcast(langs) if fits_broadcast(langs, F.length("lang") + 64) else langs, "lang")
    block = F.floor(F.col("i") / BLOCK_SOURCES).cast("int")
    heads = groups.groupBy("lang", "lang_no", "blocks", block.alias("block"))
    heads = heads.agg(F.collect_list(F.struct("i", F.col("zero").alias("share"))).alias("heads"))
    tops = of.tiles.join(heads, "lang").select(
        "lang_no", "blocks", "block", "tile", "pos", "size", F.explode("heads").alias("head")
    )
    tops = tops.select("lang_no", "blocks", "block", "tile", "pos", "size", "head.i", "head.share")
    entries = of.entries.join(_small(groups, F.length("lang") + F.length("source") + 96), ["lang", "source"])
    entries = entries.select(
        "lang_no", "blocks", block.alias("block"), F.shiftright("pos", TILE_BITS).alias("tile"), "pos",
        F.lit(-1).alias("size"), "i", _share(F.col("n"), F.col("total") + F.col("v")).alias("share"),
    )
    both = tops.unionByName(entries)
    both = both.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    both = both.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    both = both.select("lang_no", "tile", "low", "high", "i", "size", "pos", "share")
    width = BLOCK_SOURCES

    def cell(rows: pa.Table) -> pa.Table:
        return _cell(rows, width)

    cells = both.groupBy("lang_no", "tile", "low", "high").applyInArrow(cell, "lang_no int, a int, b int, value bigint")
    sums = cells.groupBy("lang_no", "a", "b").agg(F.sum("value").alias("value"))
    names = groups.select("lang_no", "lang", "source", "i")
    small = _small(names, F.length("lang") + F.length("source") + 64)
    first = small.select("lang_no", "lang", "source", F.col("i").alias("a"))
    second = small.select("lang_no", F.col("source").alias("item"), F.col("i").alias("b"))
    named = sums.join(first, ["lang_no", "a"]).join(second, ["lang_no", "b"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return named.select("lang", "source", "item", "value", F.row_number().over(order).alias("rank"))


def leading_terms(of: Divergence, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, item (terms more frequent in the source than in the language), value and rank."""
    entries = of.with_groups(of.entries, "total", "v", "lang_total")
    shares = entries.select(
        "lang", "source", F.col("term").alias("item"),
        _share(F.col("n"), F.col("total") + F.col("v")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total") + F.col("v")).alias("q"),
    ).where(F.col("p") > F.col("q"))
    valued = shares.select("lang", "source", "item", _divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return valued.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def audit_sources(documents: DataFrame, top: int = TOP_TERMS, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, source, part, item, value and rank: parts `pair` (other sources) and `term` (leading terms).

    Null text, lang and source count as ''. A repeated document counts each time. A language without kept
    terms has pairs of value 0 and no terms; a source that is alone in its language has no pairs. Equal
    values are ranked by item, in the order of its UTF-8 bytes. An empty table gives an empty result.
    """
    of = prepare(documents, least)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = source_pairs(of).withColumn("part", F.lit("pair")).select(columns)
    return pairs.unionByName(leading_terms(of, top).withColumn("part", F.lit("term")).select(columns))
