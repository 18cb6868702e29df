"""Exact top-k search: term-at-a-time accumulation over posting lists of sparse integer vectors.

Queries and candidates are dealt into bounded blocks, and every pair of blocks is one task: for each
dimension the queries' weights are scattered over that dimension's postings into dense score
arrays, and the best of each query are picked by partition selection. Lists of blocks are merged at the end.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOP = 20
SCALE = 64
CANDIDATES, QUERIES = 8192, 16384
# Queries whose score arrays a task holds at once, and candidates that are scored at once.
_TOGETHER, _ROWS = 64, 2048


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and floor(scale * x) of every component; rows with a null id, a null vector or a component
    that is null or not finite are left out."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    kept = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & sound)
    return kept.select("vec_id", whole.alias("weights"))


def postings(weights: pa.ChunkedArray | pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For every dimension the rows that are not zero there, and their weights."""
    if isinstance(weights, pa.ChunkedArray):
        weights = weights.combine_chunks()
    offsets = weights.offsets.to_numpy().astype(np.int64)
    values = weights.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(sizes)), sizes)
    term = np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    held = values != 0
    order = np.flatnonzero(held)[np.argsort(term[held], kind="stable")]
    terms, at = np.unique(term[order], return_index=True)
    ends = np.append(at[1:], len(order))
    return {int(t): (row[order[a:b]], values[order[a:b]]) for t, a, b in zip(terms, at, ends)}


def _score_type(asked: dict, lists: dict) -> type:
    """Whole numbers wide enough for every score and every sum on the way to it."""
    bound = sum(
        int(np.abs(asked[t][1]).max()) * int(np.abs(lists[t][1]).max()) for t in asked.keys() & lists.keys()
    )
    return np.int32 if bound < 2**31 else np.int64


def _spread_list(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """A posting list with its zeros."""
    out = np.zeros(size, values.dtype)
    out[rows] = values
    return out


def _accumulate(scores: np.ndarray, asked: dict, lists: dict, start: int) -> None:
    """Scatter the queries from `start` on, one column of `scores` each, over the postings of their dimensions."""
    size, together = scores.shape
    product = np.empty_like(scores)
    for term, (rows, values) in asked.items():
        low, high = np.searchsorted(rows, [start, start + together])
        if term not in lists or low == high:
            continue
        weights = _spread_list(rows[low:high] - start, values[low:high], together)
        held, held_values = lists[term]
        if 2 * len(held) < size:
            scores[held] += held_values[:, None] * weights
        else:
            # A list that holds most rows is cheaper with its zeros than by row number.
            np.multiply(_spread_list(held, held_values, size)[:, None], weights, out=product)
            scores += product


def best_of_block(query_ids, query_weights, ids, weights, top: int = TOP) -> tuple[list, list, list]:
    """For every query its best candidates of the block: query ids, candidate ids and scores."""
    order = np.argsort(ids, kind="stable")
    ids, weights = ids[order], weights.take(pa.array(order))
    lists, asked = postings(weights), postings(query_weights)
    kind = _score_type(asked, lists)
    lists, asked = ({t: (rows, v.astype(kind)) for t, (rows, v) in x.items()} for x in (lists, asked))
    own_from = np.searchsorted(ids, query_ids)
    own_to = np.searchsorted(ids, query_ids, side="right")
    out: tuple[list, list, list] = ([], [], [])
    for start in range(0, len(query_ids), _TOGETHER):
        together = min(_TOGETHER, len(query_ids) - start)
        scores = np.zeros((len(ids), together), kind)
        # Some candidates at a time, so that their scores stay in the processor's cache.
        for a in range(0, len(ids), _ROWS):
            part = {}
            for term, (rows, values) in lists.items():
                low, high = np.searchsorted(rows, [a, a + _ROWS])
                if low < high:
                    part[term] = (rows[low:high] - a, values[low:high])
            _accumulate(scores[a : a + _ROWS], asked, part, start)
        scores = np.ascontiguousarray(scores.T)
        for i in range(start, start + together):
            mine, a, b = scores[i - start], own_from[i], own_to[i]
            others = np.delete(mine, slice(a, b)) if a < b else mine
            if len(others) > top:
                bar = np.partition(others, len(others) - top)[len(others) - top]
                above, level = np.flatnonzero(others > bar), np.flatnonzero(others == bar)
                chosen = np.concatenate([above, level[: top - len(above)]])
            else:
                chosen = np.arange(len(others))
            out[0].append(np.full(len(chosen), query_ids[i]))
            out[1].append(ids[np.where(chosen >= a, chosen + (b - a), chosen)])
            out[2].append(others[chosen].astype(np.int64))
    return out


def search(vectors: DataFrame, every: int, top: int = TOP, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id and score of the best candidates of every row whose id `every` divides.

    Scores are inner products of quantised vectors; a vector that is shorter than another counts as
    zero beyond its end. Equal scores go by the smaller vec_id. Rows with the query's own id are no
    candidates; rows that repeat another id are candidates each, and repeated queries count once.
    """
    # Dealt by row, so that neither a repeated vector nor a repeated id fills a block.
    base = quantised(vectors, scale)
    asked = base.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
    sizes = base.agg(F.count(F.lit(1)), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    rows, columns = max(1, -(-sizes[0] // CANDIDATES)), max(1, -(-sizes[1] // QUERIES))
    dealt = F.pmod(F.monotonically_increasing_id(), F.lit(rows)).cast("int")
    candidates = base.withColumn("_i", dealt).withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(columns)).cast("int")
    queries = asked.withColumn("_j", block).withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        found = best_of_block(
            left["vec_id"].to_numpy(),
            left["weights"].combine_chunks(),
            right["vec_id"].to_numpy(),
            right["weights"].combine_chunks(),
            top,
        )
        parts = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in found]
        return pa.table([pa.array(x, pa.int64()) for x in parts], names=["query_id", "vec_id", "score"])

    schema = "query_id bigint, vec_id bigint, score bigint"
    cells = queries.groupBy("_i", "_j").cogroup(candidates.groupBy("_i", "_j"))
    lists = cells.applyInArrow(compare, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
