"""The pipeline against plain Python and SQL, stage by stage: each on what the one before has kept."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd

import corpus_pipeline
from slotledger.llm import language, queries
from slotledger.llm.oracles import MIXING
from test_documents import contamination, lowered, plain_ngrams, words

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def packed(gram: str) -> int:
    return sum(ord(c) << 21 * (len(gram) - 1 - k) for k, c in enumerate(gram))


def with_language(rows):
    """Out-of-place distances to the profiles of the rows that are not held out."""
    totals: dict = defaultdict(Counter)
    for doc_id, text, lang, *_ in rows:
        if lang is not None and text is not None and zlib.crc32(str(doc_id).encode()) % language.FOLDS:
            totals[lang].update(plain_ngrams(text))
    size = language.PROFILE
    top = {k: sorted(c, key=lambda g: (-c[g], packed(g)))[:size] for k, c in totals.items()}
    profiles = {k: {g: i for i, g in enumerate(v)} for k, v in top.items()}
    out = []
    for doc_id, text, _, *rest in rows:
        counts = plain_ngrams(text or "")
        own = sorted(counts, key=lambda g: (-counts[g], packed(g)))[:size]
        if own:
            far = {k: sum(abs(p[g] - i) if g in p else size for i, g in enumerate(own)) for k, p in profiles.items()}
            out.append((doc_id, text, min(sorted(far), key=far.get), *rest))
    return out


def one_of_each(rows, n=5):
    sets = []
    for r in rows:
        w = words(lowered(r[1]))
        sets.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least: dict = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r), r, key=lambda x: x[0])
    return [r for i, r in enumerate(rows) if least[find(i)] == r]


def mixed(rows):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=COLUMNS))
    by_id = {r[0]: r for r in rows}
    return [by_id[doc_id] for doc_id, *_ in con.execute(f"SELECT doc_id FROM ({MIXING})").fetchall()]


def tokenized(rows):
    from tokenizers import Tokenizer

    of, start, out = Tokenizer.from_file(queries.tokenizer_path()), 0, []
    for r in sorted(rows, key=lambda r: r[0]):
        ids = np.array([*of.encode(r[1] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        out.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out)


def test_every_stage(spark):
    """What each stage makes of all rows that its predecessor has kept; each changes something."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    # some more cases: a wrong and a missing language, no letters, a copy, a passage of the benchmark
    given = docs.collect()
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").orderBy("item_id").first().text
    more = [(10_000, given[3].text, "xx", given[3].source, 1), (10_001, given[4].text + " und so weiter", None, "src2", 1)]
    more += [(10_002, "123 456 !!", "en", "src1", 1), (10_003, None, "en", "src1", 0), (10_004, "", "de", "src3", 0), (10_005, f"some words {item} and more", "en", "src4", 1)]
    docs = docs.unionByName(spark.createDataFrame(more, docs.schema))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    plain = [
        with_language,
        one_of_each,
        lambda rows: [r for r, c in zip(rows, contamination(rows, items)) if not c[-1]],
        mixed,
    ]
    rows = rows_of(docs)
    for (name, stage), check in zip(corpus_pipeline.STAGES, plain):
        out = stage(spark, docs, SF_DIR)
        assert out.columns == COLUMNS, name
        got, want = rows_of(out), sorted(check(rows), key=repr)
        assert got == want, name
        assert got != rows, name
        docs, rows = spark.createDataFrame(got, docs.schema), got
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert sorted(map(tuple, last.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == tokenized(rows)


def test_run(spark):
    """The stages one after another over the given table."""
    rows = rows_of(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    rows = one_of_each(with_language(rows))
    rows = mixed([r for r, c in zip(rows, contamination(rows, items)) if not c[-1]])
    got = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == tokenized(rows)
