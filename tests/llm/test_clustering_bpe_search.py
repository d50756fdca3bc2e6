"""Clustering, byte-pair coding and ranked search against plain Python and the tokenizers library."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from conftest import sentence
from slotledger.llm import bpe, clustering, queries, search


def found(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


# -- clustering --------------------------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, cluster string, v int, distance long, label int"


def plain_clusters(rows, k, rounds, seed, width):
    kept = []
    for vec_id, e, *_ in rows:
        if e is not None and len(e) == width and all(x is not None and math.isfinite(x) for x in e):
            kept.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in e]))
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def assign():
        out = []
        for _, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        near = assign()
        for c in range(len(centroids)):
            own = [v for (_, v), (at, _) in zip(kept, near) if at == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    near = assign()
    inertia = Counter()
    for at, far in near:
        inertia[at] += far
    total = sum(inertia.values())
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, at, far, inertia[at], total, sha[at]) for (i, _), (at, far) in zip(kept, near)), key=repr)


COLUMNS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def vectors(width: int, n: int = 150) -> list[tuple]:
    rng = np.random.default_rng(width)
    middles = rng.normal(0, 2, (7, width))
    out = [(k, [float(np.float32(x)) for x in middles[k % 7] + rng.normal(0, 0.6, width)]) for k in range(n)]
    out += [out[3], out[3], (5, out[9][1]), (None, out[4][1]), (None, out[6][1])]  # repeated rows, one id twice, null ids
    out += [(900 + k, out[0][1]) for k in range(60)]  # many of one
    out += [(500, None), (501, []), (502, [1.0] * (width - 1)), (503, [1.0] * (width + 1)), (504, [None] + [1.0] * (width - 1))]
    out += [(505, [float("nan")] + [0.0] * (width - 1)), (506, [float("inf")] + [0.0] * (width - 1)), (507, [-0.001] * width), (508, [0.0] * width)]
    return [(*r, "x", 1, 2, 3) for r in out]


@pytest.mark.parametrize(("width", "k", "rounds"), [(64, 40, 5), (3, 6, 3), (2, 1, 1), (3, 400, 2)])
def test_clusters(spark, width, k, rounds):
    rows = vectors(width)
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    got = clustering.cluster(df, k=k, rounds=rounds, components=width)
    assert found(clustering.digest(got), *COLUMNS) == plain_clusters(rows, k, rounds, 2, width)
    norms = [sum(x * x for x in c) for c in got.centroids]
    for r in got.assigned.collect():
        assert r.dots == [sum(a * b for a, b in zip(r.v, c)) for c in got.centroids]
        assert r.distance == sum(x * x for x in r.v) - 2 * r.dots[r.cluster] + norms[r.cluster]


def test_no_vectors(spark):
    df = spark.createDataFrame([], VECTORS)
    assert clustering.digest(clustering.cluster(df)).collect() == []
    df = spark.createDataFrame([r for r in vectors(64) if r[0] in (500, 505)], VECTORS)
    assert clustering.digest(clustering.cluster(df)).columns == list(COLUMNS)
    assert clustering.digest(clustering.cluster(df)).count() == 0


def test_components_that_do_not_fit(spark):
    df = spark.createDataFrame([(1, [1e6] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="component beyond"):
        clustering.cluster(df)


def test_only_changes_are_added():
    """Stored products, here any numbers, stay as they are but for the component that moved."""
    moved = np.zeros((3, 4), dtype=np.int64)
    moved[1, 2] = 5
    v, dots = np.array([[1, 2, 3, 4], [5, 6, 7, 8]]), np.array([[10, 20, 30], [40, 50, 60]])
    columns = [pa.array([1, 2]), clustering._lists(v, pa.int32()), clustering._lists(dots, pa.int64())]
    batch = pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "dots"])
    (out,) = clustering._step(moved, np.zeros((3, 4), dtype=np.int64))(iter([batch]))
    assert out.column("dots").to_pylist() == [[10, 35, 30], [40, 85, 60]]


# -- byte pairs --------------------------------------------------------------------------------------------------------------

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
ODD = [*"abcXYZ'sdtmÉéßÄıİΣςσ \t\n\r\x0b\x0c\x1c\x1d\x85\xa0 　̧́​中文😀½²Ⅷ٣1234567890<|>.,!#", "<|endoftext|>", "<|startoftext|>"]
ODD += ["'ve", "'LL", "ﬁ", "ẛ̣", "\U0001d400", "\u0000", "가", "ᄀ", "ᅡ", "  ", "\r\n"]


def library(name: str):
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(queries.tokenizer_path(name))
    out.no_truncation()
    out.no_padding()
    return out


def coded(of, texts):
    out = []
    for text in texts:
        ids = of.encode(text or "", add_special_tokens=False).ids
        sha = [hashlib.sha256(s.encode()).hexdigest() for s in (" ".join(map(str, ids)), of.decode(ids, skip_special_tokens=False))]
        out.append((len(ids), *sha))
    return out


@pytest.mark.parametrize("name", FILES)
def test_coding_as_the_library(spark, docs, rows, name):
    path = queries.tokenizer_path(name)
    got = found(bpe.digest(bpe.decode(bpe.encode(docs, path), path)), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(((r[0], *x) for r, x in zip(rows, coded(library(name), [r[1] for r in rows]))), key=repr)


@pytest.mark.parametrize("name", FILES)
def test_odd_texts(name):
    rng = random.Random(3)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 0xD800), rng.randrange(0xE000, 0x110000), rng.randrange(32, 0x600)])) for _ in range(20)) for _ in range(1500)]
    of, lib = bpe.Coder(queries.tokenizer_path(name)), library(name)
    for text in texts:
        ids = np.frombuffer(of.encode(text), dtype=np.int32).tolist()
        assert ids == lib.encode(text, add_special_tokens=False).ids
        assert of.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_given_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = found(queries.op12_merge_queue_bpe(spark, sf_dir), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert got == sorted(((r.doc_id, *x) for r, x in zip(rows, coded(library(FILES[0]), [r.text for r in rows]))), key=repr)


def plain_merges(ids, pairs):
    """The merge of the lowest rank, the leftmost of equal ones, until there is none."""
    while True:
        found_ = [(pairs[p][0], at) for at, p in enumerate(zip(ids, ids[1:])) if p in pairs]
        if not found_:
            return ids
        _, at = min(found_)
        ids = [*ids[:at], pairs[ids[at], ids[at + 1]][1], *ids[at + 2 :]]


def test_merging_by_rank():
    rng = random.Random(1)
    for _ in range(300):
        pairs, symbols = {}, 4
        for rank in range(12):
            pair = (rng.randrange(symbols), rng.randrange(symbols))
            if pair not in pairs:
                pairs[pair] = (rank, symbols)
                symbols += 1
        base = symbols
        made = [0] * 12
        for rank, new in pairs.values():
            made[rank] = new
        ranks = {a * base + b: rank for (a, b), (rank, _) in pairs.items()}
        ids = [rng.randrange(4) for _ in range(rng.randrange(30))]
        assert bpe.merge_word(ids, ranks, made, base) == plain_merges(ids, pairs)


def test_one_very_long_word():
    of, lib = bpe.Coder(queries.tokenizer_path(FILES[0])), library(FILES[0])
    rng = random.Random(2)
    word = "".join(rng.choice("aeinrst") for _ in range(100_000))
    assert np.frombuffer(of.encode(word), dtype=np.int32).tolist() == lib.encode(word, add_special_tokens=False).ids


def test_coding_nothing(spark, empty):
    path = queries.tokenizer_path(FILES[0])
    assert bpe.digest(bpe.decode(bpe.encode(empty, path), path)).collect() == []
    some = spark.createDataFrame([(None, None), (2, []), (3, [49407])], "doc_id long, ids array<int>")
    assert found(bpe.decode(some, path), "doc_id", "text") == [(2, ""), (3, "<|endoftext|>"), (None, "")]


def test_recent_values():
    asked = []
    values = bpe.Recent(lambda k: asked.append(k) or k.encode(), 3)
    for key in ["a", "b", "c", "a", "d", "a", "e", "f", "a", "b"]:
        assert values[key] == key.encode()
        assert len(values) <= 3
    assert asked.count("a") == 1  # asked for again and again, never let go


# -- search ------------------------------------------------------------------------------------------------------------------

ITEMS = "item_id long, text string, rank int, doc_id long, score string"


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain_ranks(docs, items, top=10):
    counts = [Counter(plain_terms(r[1])) for r in docs]
    sizes = [c.total() for c in counts]
    number, length = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for c in counts for t in c)
    out = []
    for item_id, text in sorted({r[:2] for r in items}, key=repr):
        scored = []
        for r, c, n in zip(docs, counts, sizes):
            score = 0
            for t, times in Counter(plain_terms(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1)))
                    score += times * w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * (100 - 75 + (75 * n * number) // length)))
            if score > 0:
                scored.append((-score, r[0] is not None, r[0] or 0))
        out += [(item_id, k + 1, d if known else None, -s) for k, (s, known, d) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def asked_for(rows):
    rng = random.Random(11)
    texts = [None, "", " .,", "nowhere0", "one two", "One, ONE one x", rows[12][1], rows[16][1], rows[-1][1], sentence(rng, 40), sentence(rng, 400), "no id", "Ünïcode É"]
    out = [(k, t, 1, 2, "x") for k, t in enumerate(texts)]
    return [*out, out[6], (6, "x ab cd", 0, 0, ""), (None, "ab one", None, None, None)]


@pytest.mark.parametrize(("cell", "block"), [(4096, 512), (7, 2), (1, 1), (20, 3)])
def test_ranks(spark, docs, rows, cell, block):
    items = asked_for(rows)
    got = search.ranked(docs, spark.createDataFrame(items, ITEMS), cell_docs=cell, block_docs=block)
    assert found(got, "item_id", "rank", "doc_id", "score") == plain_ranks(rows, items)


def test_long_items_and_many_batches(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(search, "LONG_ITEM", 5)
    monkeypatch.setattr(search, "BATCH_COST", 4000)
    items = asked_for(rows)
    df = spark.createDataFrame(items, ITEMS)
    assert len(list(search.batches(df))) > 2
    assert found(search.ranked(docs, df, cell_docs=9, block_docs=2), "item_id", "rank", "doc_id", "score") == plain_ranks(rows, items)


def test_ranks_of_given_documents(spark):
    """Bounds hold, most blocks are skipped, and small blocks give what SQL gives with the given sizes."""
    sf_dir = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    (batch,) = search.batches(items)
    index = search.build_index(docs, batch, 64, 8)
    plan = index.plan
    want = plain_ranks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    least = {}
    for item_id, rank, _, score in want:
        least[item_id] = score if rank == 10 else least.get(item_id, 1)
    kept = total = 0
    for cell in index.cells.collect():
        row = {c: np.array(cell[c]) for c in search._CELL_NAMES[2:]}
        dense = search._dense(row["ends"], row["terms"], row["impacts"], len(plan.weights)).astype(np.int64)
        lists = dict(zip(np.cumsum([0, *row["list_blocks"]]).tolist(), row["list_terms"].tolist()))
        for block, qs, bounds in search._bounds(row, plan):
            for b in range(len(bounds)):
                members = row["block_docs"][row["block_ends"][block + b] : row["block_ends"][block + b + 1]]
                for q, bound in zip(qs, bounds[b]):
                    terms, by = plan.item(q)
                    last = terms.tolist().index(lists[block])
                    without_later = [d for d in members if not dense[d, terms[last + 1 :]].any()]
                    assert all(dense[d, terms] @ by <= bound for d in without_later)
                    total += 1
                    kept += bound >= least[batch.item_ids[q]]
    assert kept < total / 4
    got = search.search(index, batch)
    named = {q: i for q, i in enumerate(batch.item_ids)}
    assert sorted(((named[r.item], r["rank"], r.doc_id, r.score) for r in got.collect()), key=repr) == want


def test_nothing_to_rank(spark, docs, empty, rows):
    items = spark.createDataFrame(asked_for(rows), ITEMS)
    assert search.ranked(empty, items).collect() == []
    assert search.ranked(docs, items.limit(0)).collect() == []
    assert search.ranked(docs.filter("text = '...'"), items).collect() == []
    assert search.ranked(docs, items.filter("item_id = 3")).count() == 0
