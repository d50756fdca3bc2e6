"""Substring dedup by recompression: long repeats are found through symbols that equal word sequences share.

A document starts as the names of its words. In each round runs of one symbol get a name, then pairs of a left and a right
symbol do; a symbol's side is drawn from its name, so that the same sequence is cut alike wherever it stands. Names are hashes
of what they stand for, hence the same in every task, without a table of names. Each symbol keeps the stretch of words that
its making depended on. If this stretch lies in a window, the symbol is made in every copy of that window: it is an interior
symbol. Each window is represented by its interior symbol of the lowest priority number, and most windows share theirs with
their neighbours, so that a few symbols per window length are shuffled. Symbols met once end there. Where a symbol is met again
in the same surroundings, all its windows are repeats; where surroundings differ, its windows are compared one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotledger.llm.common import dealt_anew, mix, pieces, row_key, span_hashes, stored, word_names

WINDOW = 35
ROUNDS = 2


def symbols(words: np.ndarray, at: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, low, high) of the symbols of all rows after `rounds`: the words low..high-1 decide that the symbol is made.

    `at`: how many words lie before each row limit. A stretch that reaches over the limit of its row is in no window.
    """
    n = len(words)
    name = words
    start = np.arange(n)
    end = start + 1
    low, high = start, end
    row = np.searchsorted(at, start, side="right")
    for k in range(rounds):
        # runs of one symbol: their ends depend on the symbols beside them
        first = np.ones(len(name), dtype=bool)
        first[1:] = (name[1:] != name[:-1]) | (row[1:] != row[:-1])
        a = np.flatnonzero(first)
        b = np.append(a[1:], len(name))
        length = (b - a).astype(np.uint64)
        before = np.where((a > 0) & (row[a - 1] == row[a]), low[a - 1], start[a] - 1)
        after_at = np.minimum(b, len(name) - 1)
        after = np.where((b < len(name)) & (row[after_at] == row[a]), high[after_at], end[b - 1] + 1)
        name = np.where(length == 1, name[a], mix(name[a] + length * np.uint64(0xD6E8FEB86659FD93)))
        low, high = np.minimum(before, low[a]), np.maximum(after, high[b - 1])
        start, end, row = start[a], end[b - 1], row[a]
        # pairs of a left and a right symbol; one that stays single depends on the symbol that might have joined it
        right = (mix(name + np.uint64(0x9E3779B97F4A7C15 * (k + 1) & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(63)).astype(bool)
        same = row[1:] == row[:-1]
        joined = np.zeros(len(name), dtype=bool)  # with the next one
        joined[:-1] = ~right[:-1] & right[1:] & same
        taken = np.zeros(len(name), dtype=bool)
        taken[1:] = joined[:-1]
        single = ~joined & ~taken
        prev_low = np.where(np.append(False, same), np.append(0, low[:-1]), start - 1)
        next_high = np.where(np.append(same, False), np.append(high[1:], 0), end + 1)
        new_low = np.where(single & right, np.minimum(prev_low, low), low)
        new_high = np.where(single & ~right, np.maximum(next_high, high), high)
        j = np.flatnonzero(joined)
        made = name.copy()
        made[j] = mix(name[j] * np.uint64(3) + mix(name[j + 1]))
        new_high[j] = high[j + 1]
        new_end = end.copy()
        new_end[j] = end[j + 1]
        keep = ~taken
        name, low, high, start, end, row = made[keep], new_low[keep], new_high[keep], start[keep], new_end[keep], row[keep]
    return name, low, high


def _lowest(priority: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each range first..last (both included) the leftmost place of the lowest priority."""
    place = np.arange(len(priority))
    out = np.zeros(len(first), dtype=np.int64)
    size = last - first + 1
    width = 1
    while len(size):
        use = np.flatnonzero((size >= width) & (size < 2 * width))
        x, y = place[first[use]], place[last[use] - width + 1]
        out[use] = np.where(priority[y] < priority[x], y, x)
        if not (size >= 2 * width).any():
            break
        near, far = place[: len(place) - width], place[width:]
        place = np.concatenate([np.where(priority[far] < priority[near], far, near), place[len(place) - width :]])
        width *= 2
    return out


def anchors(words: np.ndarray, at: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS):
    """(row, first window, windows, key, region) of the symbols that represent the windows of all rows.

    `key` names the symbol with the words that it depends on, `region` all words of the windows that it represents. A window
    without an interior symbol represents itself.
    """
    n_windows = np.maximum(np.diff(at) - window + 1, 0)
    total = int(n_windows.sum())
    if not total:
        return (np.zeros(0, dtype=np.int64),) * 3 + (np.zeros(0, dtype=np.uint64),) * 2
    row = np.repeat(np.arange(len(n_windows)), n_windows)
    p = np.arange(total) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows) + at[:-1][row]
    name, low, high = symbols(words, at, rounds)
    first = np.searchsorted(low, p, side="left")
    last = np.searchsorted(high, p + window, side="right") - 1
    inside = first <= last
    by = np.where(inside, 0, -1 - p)  # a window that represents itself is unlike any other
    by[inside] = _lowest(mix(name), first[inside], last[inside])
    change = np.ones(total, dtype=bool)
    change[1:] = (by[1:] != by[:-1]) | (row[1:] != row[:-1])
    a = np.flatnonzero(change)
    count = np.diff(np.append(a, total))
    begin, who = p[a], by[a]
    own = who < 0
    symbol = np.where(own, 0, who)
    key = span_hashes(words, np.where(own, begin, low[symbol]), np.where(own, begin + window, high[symbol]))
    key = mix(key + np.where(own, np.uint64(1), name[symbol]))
    region = span_hashes(words, begin, begin + count - 1 + window)
    return row[a], begin - at[:-1][row[a]], count, key, region


# -- tasks ---------------------------------------------------------------------------------------------------------------

_SHIFT = 24  # windows of one symbol fit: a stretch in a window is shorter than it


def _anchor_rows(window: int, rounds: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rk = batch.column("rk").to_numpy()
            for first, _, raw, limits in pieces(batch.column("text")):
                words, at = word_names(raw, limits)
                row, begin, count, key, region = anchors(words, at, window, rounds)
                if len(row):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(region.view(np.int64)), pa.array(rk[first + row]), pa.array((begin << _SHIFT) | count)],
                        names=["key", "region", "rk", "place"],
                    )

    return rows


def _windows_of(places: np.ndarray) -> np.ndarray:
    """The window starts that packed places stand for, each once."""
    begin, count = places >> _SHIFT, places & ((1 << _SHIFT) - 1)
    starts = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
    return np.unique(starts)


def _window_rows(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rk, places = batch.column("rk").to_numpy(), batch.column("places")
            for first, last, raw, limits in pieces(batch.column("text")):
                words, at = word_names(raw, limits)
                starts = [_windows_of(np.array(places[i].as_py(), dtype=np.int64)) for i in range(first, last)]
                n = [len(s) for s in starts]
                begin = np.concatenate(starts)
                shifted = begin + np.repeat(at[:-1], n)
                names = span_hashes(words, shifted, shifted + window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.view(np.int64)), pa.array(np.repeat(rk[first:last], n)), pa.array((begin << _SHIFT) | 1)], names=["window", "rk", "place"]
                )

    return rows


def _cut(window: int, texts: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, places in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("places")):
                words = (text.as_py() or "").encode().split()
                kept = words
                if places.is_valid:
                    starts = _windows_of(np.array(places.as_py(), dtype=np.int64))
                    gone = np.zeros(len(words) + 1, dtype=np.int64)
                    gone[starts] += 1
                    gone[starts + window] -= 1
                    gone = np.cumsum(gone[:-1]) > 0
                    kept = [w for w, g in zip(words, gone.tolist()) if not g]
                rest = b" ".join(kept)
                out.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(rest).hexdigest(), rest.decode() if texts else None))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
            yield pa.RecordBatch.from_arrays(columns if texts else columns[:4], names=names if texts else names[:4])

    return cut


def repeated_places(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """(rk, places): per document the packed (first window, windows) that start a word sequence found elsewhere too.

    `docs` has rk, doc_id and text. Keys that very many places share are counted before they are shuffled, and the joins back
    are plain ones, where one key's rows can be split.
    """
    rows = docs.select("rk", "text").mapInArrow(_anchor_rows(window, rounds), "key long, region long, rk long, place long")
    met = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("region").alias("r0"), F.max("region").alias("r1"))
    met = dealt_anew(met.filter("n > 1").select("key", (F.col("r0") == F.col("r1")).alias("same")), "key")
    found = stored(rows.select("key", "rk", "place").join(met, "key").select("rk", "place", "same"), "shared-symbols")
    unsure = found.filter("not same").groupBy("rk").agg(F.collect_list("place").alias("places"))
    texts = docs.join(unsure, "rk").select("rk", "doc_id", "text", "places")
    windows = texts.mapInArrow(_window_rows(window), "window long, rk long, place long")
    again = dealt_anew(windows.groupBy("window").agg(F.count("*").alias("n")).filter("n > 1").select("window"), "window")
    more = windows.join(again, "window").select("rk", "place")
    return found.filter("same").select("rk", "place").unionByName(more).groupBy("rk").agg(F.collect_list("place").alias("places"))


def without_repeats(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, texts: bool = False) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_removed, kept_sha256, and kept_text if `texts`.

    A word goes if some window of `window` words over it starts anywhere else as well, in another row or the same one; all
    windows are judged on the input. Words are compared by 64-bit hashes. Null or empty text has no words. Equal rows
    are copies of each other. Other columns are not looked at. An empty table gives an empty result.
    """
    docs = docs.select(row_key().alias("rk"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    places = repeated_places(docs, window, rounds)
    rows = docs.join(places, "rk", "left").select("doc_id", "text", "places")
    return rows.mapInArrow(_cut(window, texts), "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if texts else ""))
