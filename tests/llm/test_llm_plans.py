"""Plans of the document operators that are asked for without Python: the part after the last stored table."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from slotledger.llm import language
from slotledger.llm.common import BATCH_SETTING, ship
from slotledger.llm.queries import QUERIES

NATIVE = ("op4_host_rules", "op5_positional_index", "op7_hierarchical_mixing")


@pytest.mark.parametrize("name", NATIVE)
def test_native_operators_run_no_python_and_no_cross_join(spark, name):
    text = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    for bad in ("NestedLoop", "CartesianProduct", "EvalPython", "InPandas", "InArrow"):
        assert bad not in text


def test_the_language_of_a_text_is_worked_out_once(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    learned = spark.createDataFrame([(k, t, l, "web", len(t)) for k, (t, l) in enumerate([("the cat sat", "en"), ("die katze sass", "de")])], schema)
    rows = [(1, "the cat sat", "de", "web", 11), (1, "the cat sat", "de", "web", 11), (2, "katze", None, "b", 5), (3, "123", "en", "b", 3), (4, None, "en", "b", 0)]
    kept = language.with_known_language(spark.createDataFrame(rows, schema), language.learn(learned))
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "the cat sat", "en", "web", 11)] * 2 + [(2, "katze", "de", "b", 5)]


def test_batches_to_python_workers_are_small(spark):
    spark.conf.unset(BATCH_SETTING)
    ship(spark)
    texts = spark.range(0, 20_000, 1, 1).select(F.concat_ws(" ", "id", F.repeat(F.lit("word "), 200)).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": pa.array([batch.num_rows], pa.int64()), "size": pa.array([batch.nbytes], pa.int64())})

    found = texts.mapInArrow(sizes, "rows long, size long").collect()
    assert sum(r.rows for r in found) == 20_000
    assert max(r["size"] for r in found) < 5 << 20


def test_ngrams_are_added_up_over_batches(monkeypatch):
    texts = [["one two", "eins"], ["two", None], ["one", "zwei eins"]]
    batches = [pa.RecordBatch.from_pydict({"lang": ["en", "de"], "text": pa.array(t, pa.string())}) for t in texts]

    def sums(found):
        total = Counter()
        for r in (r for b in found for r in b.to_pylist()):
            total[r["lang"], r["gram"]] += r["n"]
        return total

    whole = list(language._count(iter(batches)))
    assert [set(b.column("lang").to_pylist()) for b in whole] == [{"en"}, {"de"}]
    assert sums(whole) == sum((Counter({("en" if k == 0 else "de", int(g)): 1}) for t in texts for k, x in enumerate(t) if x for g in language.ngrams(x)), Counter())
    monkeypatch.setattr(language, "HELD", 5)
    parts = list(language._count(iter(batches)))
    assert len(parts) > 2 and sums(parts) == sums(whole)
    assert list(language._count(iter([]))) == []
