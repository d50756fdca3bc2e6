"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent letter n-grams (1 to 3 letters, words padded by a space). A document's own
list is compared with each profile: every n-gram costs the difference of its ranks, one that the profile lacks costs the most.
The language with the smallest sum is predicted.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotledger.llm.common import fresh_name, stored, tidied

#: N-grams in a profile, and in a document's own list.
PROFILE = 300
UNKNOWN = "und"
#: More languages than this are refused: the profiles go to every task.
MAX_LANGUAGES = 2000
FOLDS = 5
#: Counts of n-grams (16 bytes each) that a task adds up before it sends sums on.
HELD = 1 << 22

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        table = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
        _letters.append(table)
    return _letters[0]


def ngrams(text: str) -> np.ndarray:
    """All 1-, 2- and 3-grams of the lower-case letters of a text, packed into 63 bits; sorted, with repeats."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letter_table()[points]
    if not letter.any():
        return np.zeros(0, dtype=np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    line = np.where(letter, points, 32)[keep].astype(np.int64)
    line = np.concatenate([[32], line, [32]] if line[-1] != 32 else [[32], line])
    solid = line != 32
    two = (line[:-1] << 21) | line[1:]
    three = (two[:-1] << 21) | line[2:]
    grams = np.concatenate([line[solid], two, three[solid[1:-1]]])
    grams.sort()
    return grams


def counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a sorted list and their counts."""
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    return grams[first], np.diff(np.append(first, len(grams)))


def most_frequent(grams: np.ndarray, n: int = PROFILE) -> np.ndarray:
    """The `n` most frequent of a sorted list in order; of equally frequent ones the smaller first."""
    if not len(grams):
        return grams
    found, counts = counted(grams)
    if len(found) > n:
        least = np.partition(counts, len(counts) - n)[len(counts) - n]
        some = np.flatnonzero(counts >= least)
        found, counts = found[some], counts[some]
    return found[np.argsort(-counts, kind="stable")[:n]]


@dataclass(frozen=True)
class Profiles:
    names: list[str]  # in order
    grams: np.ndarray  # sorted
    ranks: np.ndarray  # [language, gram]; `size` where a profile lacks the n-gram
    size: int

    def nearest(self, text: str | None) -> tuple[str, float]:
        """The language and 1 less its share of the largest possible distance; of equals the first name."""
        if not text or not self.names:
            return UNKNOWN, 0.0
        own = most_frequent(ngrams(text), self.size)
        if not len(own):
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        hit = np.flatnonzero(self.grams[at] == own)
        apart = np.abs(self.ranks[:, at[hit]] - hit).sum(axis=1) + self.size * (len(own) - len(hit))
        lacking = self.ranks[:, at[hit]] == self.size
        apart += (lacking * hit).sum(axis=1)  # lacking costs `size`, whatever the rank
        best = int(np.argmin(apart))
        return self.names[best], float(max(0.0, 1.0 - apart[best] / (self.size * len(own))))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-grams of each language in a task, added up over batches; sent on when HELD counts have come in."""
    by: dict[str, list[np.ndarray]] = defaultdict(list)
    held = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, parts in by.items():
            grams, counts = _added(parts)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(grams), "gram": pa.array(grams), "n": pa.array(counts)})

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            if text.is_valid and len(grams := ngrams(text.as_py())):
                by[lang].append(np.stack(counted(grams)))
                held += by[lang][-1].shape[1]
                if len(by[lang]) >= 256:
                    by[lang] = [_added(by[lang])]
                if held >= HELD:
                    yield from rows()
                    by.clear()
                    held = 0
    yield from rows()


def _added(parts: list[np.ndarray]) -> np.ndarray:
    grams, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return np.stack([grams, np.bincount(at, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)])


def held_out(folds: int = FOLDS) -> Column:
    """True for the rows that nothing is learned from; a null doc_id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds == 0


def learn(docs: DataFrame, size: int = PROFILE) -> Profiles:
    """Profiles from all rows of `docs` (text, lang) with a language; n-grams are summed in each task before the shuffle."""
    counts = docs.filter("lang is not null and text is not null").select("lang", "text").mapInArrow(tidied(_count), "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = stored(counts.withColumn("rank", rank).filter(F.col("rank") <= size), "profiles")
    if top.select("lang").distinct().count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    rows = top.collect()  # at most MAX_LANGUAGES lists
    names = sorted({r.lang for r in rows})
    grams = np.array(sorted({r.gram for r in rows}), dtype=np.int64)
    ranks = np.full((len(names), len(grams)), size, dtype=np.int64)
    for r in rows:
        ranks[names.index(r.lang), np.searchsorted(grams, r.gram)] = r.rank - 1
    return Profiles(names, grams, ranks, size)


def prediction(profiles: Profiles, once: bool = False) -> Column:
    """A struct (lang_pred, score) of the text column: `und` and 0 for null and for texts without a letter.

    `once`: where rows are filtered by it, Spark is kept from working it out a second time for the filter.
    """

    @F.arrow_udf("lang_pred string, score double")
    def nearest(texts: pa.Array) -> pa.Array:
        found = [profiles.nearest(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["lang_pred", "score"])

    return (nearest.asNondeterministic() if once else nearest)(F.col("text"))


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, lang_pred, score.

    Null and empty texts, and those without a letter, are `und` with score 0. Whole texts are read, however long. Repeated rows
    get equal results, equal distances the first language by name; an empty table gives no rows; other columns are not looked at.
    """
    return docs.select("doc_id", held_out().alias("held_out"), prediction(profiles).alias("found")).select("doc_id", "held_out", "found.*")


def with_known_language(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """The rows of `docs`, all columns, for which a language is predicted, with the prediction as their `lang`.

    What a row was given as `lang`, null or another, no longer counts. Rows without a letter, null texts among them, go. Equal
    rows stay as many. Where no language could be learned nothing is predicted and all rows stay as they are.
    """
    if not profiles.names:
        return docs
    found = fresh_name(docs, "found")
    told = docs.withColumn(found, prediction(profiles, once=True)["lang_pred"])
    kept = told.filter(F.col(found) != UNKNOWN)
    return kept.select(*[F.col(found).alias(c) if c == "lang" else F.col(f"`{c}`") for c in docs.columns])
