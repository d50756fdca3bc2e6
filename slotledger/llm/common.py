"""What the document operators share: scratch tables, row keys, word hashes, sorted groups, connected groups."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text worked on at once inside a task; a longer text is one piece of its own.
PIECE = 1 << 20
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


_shipped: set[str] = set()


#: Bytes of a batch that goes to or from a Python worker, where the session does not say otherwise than Spark's default.
#: With 16 MB an executor's JVM was seen to hold about 100 MB more outside its heap.
BATCH_SETTING, DEFAULT_BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", 4 << 20


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each application; needed where they cannot import it themselves.

    Also makes batches smaller than Spark's default, which JVM and worker hold several times over.
    """
    if spark.conf.get(BATCH_SETTING) == DEFAULT_BATCH:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(prefix="slotledger-"), "slotledger-package.zip")
    with zipfile.ZipFile(target, "w") as package:
        for folder, _, files in os.walk(os.path.join(root, "slotledger")):
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    package.write(path, os.path.relpath(path, root))
    context.addPyFile(target)
    _shipped.add(context.applicationId)


_at_hand: list[dict] = []


def at_hand(cache: dict) -> dict:
    """A cache that lives through the tasks of one kind in a worker; `tidy` empties it when another kind comes."""
    _at_hand.append(cache)
    return cache


def tidy() -> None:
    """Gives back what earlier work of this Python worker has left in its pools and caches; workers live through many tasks."""
    if any(_at_hand):
        for cache in _at_hand:
            cache.clear()
        gc.collect()  # what they held may refer to itself
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # not this C library


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function of a task, with `tidy` before and after."""

    def tidy_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        yield from run(batches)
        tidy()

    return tidy_run


# -- tables in the shared folder ---------------------------------------------------------------------------------------


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, or a new one of ours where none is set (tests)."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = tempfile.mkdtemp(prefix="slotledger-")
        spark.sparkContext.setCheckpointDir(folder)
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet to the shared folder and read again: later work survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes tables that `stored` has written and that nothing reads any more."""
    for table in tables:
        if path := getattr(table, "stored_at", None):
            discard(table.sparkSession, path)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a table of ours that nothing reads any more; what comes after it has been stored."""
    if not path.startswith(f"{shared_folder(spark)}/"):
        raise ValueError(f"not in the shared folder: {path}")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def small(df: DataFrame, rows: int) -> DataFrame:
    """`df` marked for broadcasting if it is counted to have at most `rows` rows; otherwise as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def light(df: DataFrame, size: Column, limit: int) -> DataFrame:
    """`df` marked for broadcasting if its rows, each of about `size` bytes, are summed up to `limit` bytes at most."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= limit else df


def dealt_anew(df: DataFrame, key: str) -> DataFrame:
    """`df` with its (long) key worked out anew: a join then deals out both sides itself and can split the rows of a hot key.

    Without this, sums by the key stay where they are, and Spark does not split a join of them.
    """
    return df.withColumn(key, F.bitwise_not(F.bitwise_not(key)))


#: A table of at most so many row keys (8 MB) is broadcast.
BROADCAST_KEYS = 1_000_000


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_key() -> Column:
    """A key of a document row by its id and text; equal rows share it, a null id or text has one as well."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


# -- words as numbers ----------------------------------------------------------------------------------------------------

_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def _power(way: str, n: int) -> np.ndarray:
    table = _powers[way]
    if len(table) < n:
        size = 1 << max(10, int(n - 1).bit_length())
        step = np.uint64(MULTIPLIER if way == "up" else INVERSE)
        table = np.full(size, step, dtype=np.uint64)
        table[0] = 1
        table = np.cumprod(table, dtype=np.uint64)
        _powers[way] = table if size <= 4 * PIECE else _powers[way]
    return table[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(texts: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows `first..last` with their UTF-8 bytes and row limits; a null text has no bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(ends, ends[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, last, raw[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def word_spans(raw: np.ndarray, limits: np.ndarray, gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in `raw`, and how many words lie before each row limit. `gap`: bytes that part words."""
    inside = ~gap[raw]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    cut = limits[1:-1][limits[1:-1] < len(raw)]
    begin[cut] = inside[cut]
    starts = np.flatnonzero(begin)
    finish = inside.copy()
    finish[:-1] &= ~inside[1:]
    cut = limits[1:-1][limits[1:-1] > 0] - 1
    finish[cut] = inside[cut]
    ends = np.flatnonzero(finish) + 1
    return starts, ends, np.searchsorted(starts, limits)


_PLACES = 64


def _byte_table() -> np.ndarray:
    """A 64-bit number for each byte at each of the first places of a word."""
    return mix((np.arange(_PLACES * 256, dtype=np.uint64) + np.uint64(1)) * np.uint64(MULTIPLIER))


_bytes_at = None


def word_names(raw: np.ndarray, limits: np.ndarray, *, lower: bool = False, gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit name for every word of the rows in `raw`, and the words before each row limit.

    The sum over a word of a number drawn for each byte and its place: no pattern of bytes makes the numbers of two words
    cancel, as it can with powers of one factor.
    """
    global _bytes_at
    if _bytes_at is None:
        _bytes_at = _byte_table()
    if not len(raw):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(limits), dtype=np.int64)
    starts, ends, counts = word_spans(raw, limits, gap)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), counts
    lengths = ends - starts
    total = int(lengths.sum())
    # the bytes of all words on end, each with its place in its word
    kind = np.int32 if len(raw) < 1 << 31 else np.int64
    begin = np.cumsum(lengths) - lengths
    at = np.arange(total, dtype=kind)
    data = raw[at + np.repeat((starts - begin).astype(kind), lengths)]
    if lower:
        data = _LOWER[data]
    place = at - np.repeat(begin.astype(kind), lengths)
    value = _bytes_at[(np.minimum(place, _PLACES - 1) << 8) | data]
    far = np.flatnonzero(place >= _PLACES)
    if len(far):
        value[far] = mix(((place[far].astype(np.uint64) << np.uint64(8)) + data[far] + np.uint64(1)) * np.uint64(MULTIPLIER))
    sums = np.add.reduceat(value, begin)
    return mix(sums + lengths.astype(np.uint64)), counts


def word_hashes(
    raw: np.ndarray, limits: np.ndarray, *, lower: bool = False, gap: np.ndarray = _SPACE, prefixes: tuple[int, ...] = ()
) -> tuple[np.ndarray, ...]:
    """A 64-bit name for every word of the rows in `raw`, the same for the same bytes, and the words before each row limit.

    For each length in `prefixes` a further array has the names of the words cut to so many bytes.
    """
    if not len(raw):
        none = np.zeros(0, dtype=np.uint64)
        return (none, np.zeros(len(limits), dtype=np.int64), *[none] * len(prefixes))
    starts, ends, counts = word_spans(raw, limits, gap)
    data = (_LOWER[raw] if lower else raw).astype(np.uint64)
    data += np.uint64(1)
    data *= _power("up", len(raw))
    total = np.cumsum(data, dtype=np.uint64)
    before = np.where(starts > 0, total[starts - 1], np.uint64(0))
    down = _power("down", len(raw))[starts]
    cut = [mix((total[np.minimum(ends, starts + k) - 1] - before) * down) for k in prefixes]
    return (mix((total[ends - 1] - before) * down), counts, *cut)


def span_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit name for every span words[start:end] (ends beyond starts), the same for the same word sequence."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(words * _power("up", len(words)), dtype=np.uint64)])
    value = (total[ends] - total[starts]) * _power("down", len(words))[starts]
    return mix(value + (ends - starts).astype(np.uint64))


# -- groups --------------------------------------------------------------------------------------------------------------


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of one key after another, from batches sorted by the keys; only one group is held."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(edges, edges[1:]):
            if a:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def connected(edges: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """(node, label): the smallest node each node of `edges` (a, b) is linked with, in any number of steps.

    Alternates two steps that hang neighbours on smaller ones until nothing changes, which takes a number of rounds
    logarithmic in the longest path. Each round is written to the shared folder. Minima are pre-aggregated, and the
    join back is between two plain shuffles, so that a node with very many neighbours can be split.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), f"{name}-links")
    seen = None
    for k in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = dealt_anew(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "a")
        # every larger neighbour hangs on the smallest
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        # every smaller neighbour, and the node itself, hangs on the smallest
        below = dealt_anew(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        hung = large.join(below, "a")
        star = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(below.select("a", F.col("m").alias("b")))
        last, now = now, stored(star.filter("a <> b").distinct(), f"{name}-{k}")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        release(last)
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"groups did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
