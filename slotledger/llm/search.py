"""Ranked lexical search with posting lists cut into geometric blocks.

Documents are laid out by a sketch of their weighted terms (random projections), so that similar ones lie together, and are
packed into cells of a bounded size, one stored row each. In a cell the posting list of every term is clustered once more: its
documents go to the nearest of a few of its own, by the sketch. Such a block of documents keeps the largest impact of any of
them for each term that some item asks for together with the term of the list.

Terms have one order, by weight. It is enough to find a document in the list of the last of its terms that an item asks for, so
the bound of a block is the sum of its maxima over the terms up to that of its list; lists of common terms have low bounds.
An item is first scored in the cells that promise most; then every block whose bound is at least the tenth best score found
there is scored exactly, all others are skipped. Bounds are exact integers, so nothing of the ten best is lost, and sketch and
clusters decide the speed alone.

Items are searched in batches of bounded size, all against all documents. The index holds the terms of one batch.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotledger.llm.common import stored, tidied

TOP = 10
#: Documents aimed at in a cell and in a block, and most numbers in the matrix of a cell (documents times terms of the items).
CELL_DOCS, BLOCK_DOCS, CELL_ENTRIES = 4096, 512, 1 << 24
CELLS_IN_TASK = 2
#: Random projections of a sketch; their signs are the place of a document.
PLANES, SEED = 32, 13
#: Cells in which an item is scored first.
FIRST_CELLS = 3
#: Items of more different terms take the block's maximum for the list's own term only, and the cell's for the others.
LONG_ITEM = 1024
#: Most that one batch of items may cost, see `_cost`; this bounds its terms and the pairs of them.
BATCH_COST = 1 << 24

# A term is a run of bytes other than the ASCII characters that part terms; these become blanks, A-Z lower case.
_TERM = bytes(b + 32 if 65 <= b <= 90 else 32 if b < 128 and not chr(b).isalnum() else b for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TERM).split() if text else []


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = [Counter(terms_of(t.as_py())) for t in batch.column("text")]
        columns = [batch.column("item_id"), pa.array([list(c) for c in counts], pa.list_(pa.binary())), pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["item_id", "terms", "repeats"])


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms, repeats): each distinct item with its different terms and how often it has them; those without terms go."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text")).distinct()
    return rows.mapInArrow(tidied(_counted), "item_id long, terms array<binary>, repeats array<long>").filter(F.size("terms") > 0)


def _cost():
    n = F.size("terms").cast("long")
    return n * (64 + F.least(n, F.lit(LONG_ITEM)))


@dataclass
class Batch:
    """Items that are searched together; terms are numbers."""

    item_ids: list[int | None]
    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]


def batch_of(rows: list) -> Batch:
    vocabulary: dict[bytes, int] = {}
    terms = [np.array([vocabulary.setdefault(bytes(t), len(vocabulary)) for t in r.terms], dtype=np.int64) for r in rows]
    return Batch([r.item_id for r in rows], vocabulary, terms, [np.array(r.repeats, dtype=np.int64) for r in rows])


@dataclass
class Plan:
    """The items with the weights of their terms, each in the one order of terms, and what blocks need to be bounded.

    `flat` has the terms of all items on end, `by` their weights times repeats, `starts` where each item begins. For a term t,
    `coords[t]` are the terms whose maxima its blocks keep; `asked[t]` has the items with t, the places of t in `flat`, and on
    end for each of these items the terms up to t: where they begin, places in coords[t], terms, weights.
    """

    weights: np.ndarray
    flat: np.ndarray
    by: np.ndarray
    starts: np.ndarray
    coords: list[np.ndarray]
    asked: list[tuple[np.ndarray, ...]]

    def item(self, q: int) -> tuple[np.ndarray, np.ndarray]:
        return self.flat[self.starts[q] : self.starts[q + 1]], self.by[self.starts[q] : self.starts[q + 1]]


def plan_of(batch: Batch, weights: np.ndarray) -> Plan:
    place = np.empty(len(weights), dtype=np.int64)
    place[np.argsort(weights, kind="stable")] = np.arange(len(weights))
    orders = [np.argsort(place[t]) for t in batch.terms]
    terms = [t[o] for t, o in zip(batch.terms, orders)]
    by = [weights[t] * n[o] for t, n, o in zip(terms, batch.repeats, orders)]
    starts = np.cumsum([0, *map(len, terms)])
    having: list[list[tuple[int, int]]] = [[] for _ in weights]
    for q, ids in enumerate(terms):
        for at, t in enumerate(ids.tolist()):
            having[t].append((q, at))
    coords, asked = [], []
    for pairs in having:
        upto = [slice(0 if len(terms[q]) <= LONG_ITEM else at, at + 1) for q, at in pairs]
        parts = [terms[q][s] for (q, _), s in zip(pairs, upto)]
        flat = np.concatenate(parts)
        coords.append(np.unique(flat))
        first = np.cumsum([0, *map(len, parts[:-1])])
        qs = np.array([q for q, _ in pairs])
        asked.append((qs, starts[qs] + [at for _, at in pairs], first, np.searchsorted(coords[-1], flat), flat, np.concatenate([by[q][s] for (q, _), s in zip(pairs, upto)])))
    return Plan(weights, np.concatenate(terms), np.concatenate(by), starts, coords, asked)


def batches(items: DataFrame) -> Iterator[Batch]:
    """The items in batches of bounded cost; an item beyond the bound is a batch of its own."""
    held = stored(item_terms(items), "items")
    spread = F.xxhash64("item_id", "terms")
    number = max(1, -(-(held.agg(F.sum(_cost())).first()[0] or 0) // BATCH_COST))
    while True:
        of = F.pmod(spread, F.lit(number))
        most = held.groupBy(of.alias("b")).agg(F.sum(_cost()).alias("cost"), F.count("*").alias("n")).filter(f"n > 1 and cost > {2 * BATCH_COST}")
        if most.isEmpty():
            break
        number *= 2
    for b in range(number):
        rows = held.filter(of == b).collect()
        if rows:
            yield batch_of(rows)


# -- index ---------------------------------------------------------------------------------------------------------------


def _lists(rows: list[np.ndarray], of: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rows) if rows else np.zeros(0, dtype=np.int32), of))


def _list(column: pa.ListArray, row: int) -> np.ndarray:
    return column[row].values.to_numpy(zero_copy_only=False)


def _forward(vocabulary: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in batch.column("text"):
                words = terms_of(text.as_py())
                met = Counter(words)
                both = sorted((known[w], met[w]) for w in met.keys() & known.keys())
                sizes.append(len(words))
                terms.append(np.array([t for t, _ in both], dtype=np.int32))
                counts.append(np.array([n for _, n in both], dtype=np.int32))
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), _lists(terms, pa.int32()), _lists(counts, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "counts"])

    return run


def _planes(size: int) -> np.ndarray:
    return np.random.default_rng(SEED).choice(np.array([-1, 1], dtype=np.float32), (size, PLANES))


def _sketch(terms: np.ndarray, ends: np.ndarray, weighted: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """A row of projections for each document; documents have a term at least."""
    return np.add.reduceat(planes[terms] * weighted[:, None].astype(np.float32), ends[:-1], axis=0)


def _impacts(counts: np.ndarray, n: int, docs: int, length: int) -> np.ndarray:
    m = 100 - 75 + (75 * n * docs) // length
    counts = counts.astype(np.int64)
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


def _placed(docs: int, length: int, weights: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        planes = _planes(len(w))
        for batch in batches:
            if not batch.num_rows:
                continue
            terms = [_list(batch.column("terms"), k) for k in range(batch.num_rows)]
            impacts = [_impacts(_list(batch.column("counts"), k), n, docs, length) for k, n in enumerate(batch.column("n").to_pylist())]
            places = []
            for a in range(0, len(terms), 256):
                part = terms[a : a + 256]
                ends, flat = np.cumsum([0, *map(len, part)]), np.concatenate(part)
                signs = _sketch(flat, ends, w[flat] * np.concatenate(impacts[a : a + 256]), planes) > 0
                places.append(signs @ (np.int64(1) << np.arange(PLANES, dtype=np.int64)[::-1]))
            columns = [batch.column("doc_id"), _lists(terms, pa.int32()), _lists(impacts, pa.int32()), pa.array(np.concatenate(places))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "terms", "impacts", "place"])

    return run


CELL = (
    "cell long, doc_ids array<long>, ends array<int>, terms array<int>, impacts array<int>, "
    "top_terms array<int>, tops array<int>, list_terms array<int>, list_blocks array<int>, block_ends array<int>, block_docs array<int>, maxima array<int>"
)
_CELL_NAMES = [c.split(" ")[0] for c in CELL.split(", ")]


def _dense(ends: np.ndarray, terms: np.ndarray, impacts: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros((len(ends) - 1, size), dtype=np.int32)
    out[np.repeat(np.arange(len(ends) - 1), np.diff(ends)), terms] = impacts
    return out


def _blocks(dense: np.ndarray, ends: np.ndarray, terms: np.ndarray, sketch: np.ndarray, coords: list[np.ndarray], block_docs: int):
    """For each term present its blocks of documents, each with the largest impacts at coords[term]."""
    order = np.argsort(terms, kind="stable")
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))[order]
    present, first = np.unique(terms[order], return_index=True)
    for t, docs in zip(present.tolist(), np.split(owner, first[1:])):
        number = -(-len(docs) // block_docs)
        if number == 1:
            groups = [docs]
        else:
            chosen = docs[np.linspace(0, len(docs) - 1, number).astype(np.int64)]
            near = (sketch[docs] @ sketch[chosen].T).argmax(axis=1)
            groups = [docs[near == g] for g in range(number) if (near == g).any()]
        yield t, groups, [dense[np.ix_(g, coords[t])].max(axis=0) for g in groups]


def _packed(plan: Broadcast, cell_docs: int, block_docs: int):
    """Packs documents, as they come, into cells of so many; a cell is a row with its documents, lists, blocks and maxima."""

    def cell(number: int, rows: list[tuple]) -> pa.RecordBatch:
        w, coords = plan.value.weights, plan.value.coords
        doc_ids, term_lists, impact_lists = zip(*rows)
        ends, terms, impacts = np.cumsum([0, *map(len, term_lists)]), np.concatenate(term_lists), np.concatenate(impact_lists)
        sketch = _sketch(terms, ends, w[terms] * impacts, _planes(len(w)))
        sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
        dense = _dense(ends, terms, impacts, len(w))
        tops = dense.max(axis=0)
        list_terms, list_blocks, groups, maxima = [], [], [], []
        for t, of_term, most in _blocks(dense, ends, terms, sketch, coords, block_docs):
            list_terms.append(t)
            list_blocks.append(len(of_term))
            groups += of_term
            maxima += most
        ints = [ends, terms, impacts, np.flatnonzero(tops), tops[tops > 0], list_terms, list_blocks, np.cumsum([0, *map(len, groups)]), np.concatenate(groups), np.concatenate(maxima)]
        columns = [pa.array([number]), pa.array([list(doc_ids)], pa.list_(pa.int64())), *(_lists([np.asarray(x)], pa.int32()) for x in ints)]
        return pa.RecordBatch.from_arrays(columns, names=_CELL_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held = TaskContext.get().partitionId() << 32, []
        for batch in batches:
            for k, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                held.append((doc_id, _list(batch.column("terms"), k), _list(batch.column("impacts"), k)))
                if len(held) == cell_docs:
                    yield cell(number, held)
                    number, held = number + 1, []
        if held:
            yield cell(number, held)

    return run


@dataclass
class Index:
    """`cells` is stored."""

    cells: DataFrame
    plan: Plan


def build_index(docs: DataFrame, batch: Batch, cell_docs: int = CELL_DOCS, block_docs: int = BLOCK_DOCS) -> Index | None:
    """The index of all documents for the terms of a batch; None if no document has a term."""
    spark, context = docs.sparkSession, docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    forward = rows.mapInArrow(tidied(_forward(context.broadcast(batch.vocabulary))), "doc_id long, n long, terms array<int>, counts array<int>")
    forward = stored(forward.filter("n > 0"), "forward")
    number, length, held = forward.agg(F.count("*"), F.sum("n"), F.count_if(F.size("terms") > 0)).first()
    if not held:
        return None
    found = dict(forward.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # at most a row for each term of the batch
    weights = np.array([math.floor(1000 * math.log((2 * number + 2) / (2 * found.get(t, 0) + 1))) for t in range(len(batch.vocabulary))], dtype=np.int64)
    cell_docs = max(1, min(cell_docs, CELL_ENTRIES // len(weights)))
    tasks = max(-(-held // (cell_docs * CELLS_IN_TASK)), min(context.defaultParallelism, -(-held // 256)))
    plan = plan_of(batch, weights)
    placed = forward.filter(F.size("terms") > 0).mapInArrow(
        tidied(_placed(number, length, context.broadcast(weights))), "doc_id long, terms array<int>, impacts array<int>, place long"
    )
    order = ("place", F.xxhash64("doc_id"))  # copies have one place; the second key parts them
    laid = placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order).drop("place")
    cells = stored(laid.mapInArrow(tidied(_packed(context.broadcast(plan), cell_docs, block_docs)), CELL), "cells")
    return Index(cells, plan)


# -- search --------------------------------------------------------------------------------------------------------------


def _bounds(row: dict[str, np.ndarray], plan: Plan) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each list of a cell: its first block, the items that have its term, and their bounds, a row for each block.

    A bound is that of the cell for the terms up to the list's, less what the block's maxima fall short of the cell's.
    """
    tops = np.zeros(len(plan.weights), dtype=np.int64)
    tops[row["top_terms"]] = row["tops"]
    upto = np.concatenate([[0], np.cumsum(plan.by * tops[plan.flat])])
    block, at = 0, 0
    for t, number in zip(row["list_terms"].tolist(), row["list_blocks"].tolist()):
        width = len(plan.coords[t])
        maxima = row["maxima"][at : at + number * width].reshape(number, width)
        qs, spots, first, places, flat, by = plan.asked[t]
        short = np.add.reduceat((tops[flat] - maxima[:, places]) * by, first, axis=1)
        yield block, qs, upto[spots + 1] - upto[plan.starts[qs]] - short
        block, at = block + number, at + number * width


def _promise(plan: Broadcast):
    """(item, cell, bound): the largest bound of a cell's blocks for each item that has a term there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = plan.value
        names = ["top_terms", "tops", "list_terms", "list_blocks", "maxima"]
        for batch in batches:
            for k, cell in enumerate(batch.column("cell").to_pylist()):
                best = np.zeros(len(of.starts) - 1, dtype=np.int64)
                for _, qs, bounds in _bounds({c: _list(batch.column(c), k) for c in names}, of):
                    best[qs] = np.maximum(best[qs], bounds.max(axis=0))
                items = np.flatnonzero(best)
                columns = [pa.array(items, pa.int32()), pa.array(np.full(len(items), cell)), pa.array(best[items])]
                yield pa.RecordBatch.from_arrays(columns, names=["item", "cell", "bound"])

    return run


def _best(scores: np.ndarray, docs: np.ndarray, doc_ids: list, top: int) -> list[tuple]:
    """The highest scores above 0 with their doc_ids, equal ones by ascending doc_id, a null id first."""
    some = np.flatnonzero(scores > 0)
    if len(some) > top:
        some = some[scores[some] >= np.partition(scores[some], -top)[-top]]
    found = [(int(scores[i]), doc_ids[docs[i]]) for i in some]
    return sorted(found, key=lambda x: (-x[0], x[1] is not None, x[1] or 0))[:top]


def _scored(plan: Broadcast, least: np.ndarray | None, top: int):
    """(item, doc_id, score): the best documents of a cell. Without `least`, of the items that the row names, over the whole cell;
    with it, of every item, over the blocks whose bounds reach its `least`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = plan.value
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: _list(batch.column(c), k) for c in batch.schema.names if c not in ("cell", "doc_ids")}
                wanted: dict[int, list[np.ndarray]] = {}
                if least is None:
                    wanted = {q: [np.arange(len(row["ends"]) - 1)] for q in row["items"].tolist()}
                else:
                    block_ends, block_docs = row["block_ends"], row["block_docs"]
                    for block, qs, bounds in _bounds(row, of):
                        for b, j in zip(*np.nonzero(bounds >= least[qs])):
                            wanted.setdefault(int(qs[j]), []).append(block_docs[block_ends[block + b] : block_ends[block + b + 1]])
                if not wanted:
                    continue
                dense = _dense(row["ends"], row["terms"], row["impacts"], len(of.weights))
                doc_ids, rows = batch.column("doc_ids")[k].as_py(), []
                for q, groups in wanted.items():
                    docs = np.unique(np.concatenate(groups))
                    terms, by = of.item(q)
                    scores = dense[np.ix_(docs, terms)].astype(np.int64) @ by
                    rows += [(q, doc_id, score) for score, doc_id in _best(scores, docs, doc_ids, top)]
                if rows:
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64()))]
                    yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return run


def _highest(scored: DataFrame, top: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= top)


_FOUND = "item int, doc_id long, score long"


def search(index: Index, batch: Batch, top: int = TOP) -> DataFrame:
    """(item, rank, doc_id, score): the `top` documents for each item of the batch, by number."""
    spark = index.cells.sparkSession
    plan = spark.sparkContext.broadcast(index.plan)
    summaries = index.cells.select("cell", "top_terms", "tops", "list_terms", "list_blocks", "maxima")
    promise = summaries.mapInArrow(tidied(_promise(plan)), "item int, cell long, bound long")
    rank = F.row_number().over(W.partitionBy("item").orderBy(F.desc("bound"), "cell"))
    first = promise.withColumn("rank", rank).filter(F.col("rank") <= FIRST_CELLS).groupBy("cell").agg(F.collect_set("item").alias("items"))
    # FIRST_CELLS rows for each item of the batch at most
    some = index.cells.select("cell", "doc_ids", "ends", "terms", "impacts").join(F.broadcast(first), "cell")
    tenth = _highest(some.mapInArrow(tidied(_scored(plan, None, top)), _FOUND), top).filter(F.col("rank") == top)
    least = np.ones(len(batch.terms), dtype=np.int64)
    for r in tenth.select("item", "score").collect():
        least[r.item] = r.score
    return _highest(index.cells.mapInArrow(tidied(_scored(plan, least, top)), _FOUND), top)


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, cell_docs: int = CELL_DOCS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of `items` (item_id, text) the `top` highest scores above 0 among `docs`.

    Whole texts, null as empty. An item or document without terms has no rows. Rows of `items` equal in item_id and text are one
    item; equal ids with other texts are ranked each for itself. Rows of `docs` count and are ranked each by itself, repeated
    ones too; a null doc_id comes before others of its score. Other columns are not looked at. Empty tables give no rows.
    """
    spark: SparkSession = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for batch in batches(items):
        index = build_index(docs, batch, cell_docs, block_docs)
        if index is None:
            continue
        named = F.broadcast(spark.createDataFrame(list(enumerate(batch.item_ids)), "item int, item_id long"))  # the items of one batch
        out = out.unionByName(search(index, batch, top).join(named, "item").select("item_id", "rank", "doc_id", "score"))
    return out
