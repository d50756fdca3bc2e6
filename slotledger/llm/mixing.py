"""Mixing sources to target weights: a token budget is handed down a tree of domain, language and source.

Main path: DataFrame functions only. A node's budget goes to its children by weight, each up to what its documents can give
in all epochs; what one cannot use goes to its siblings, and only what a whole subtree cannot use goes to the siblings of
an ancestor. A leaf gives whole epochs and the prefix of one more, in an order seeded by epoch.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotledger.llm.common import fresh_name, row_key, small, stored
from slotledger.llm.host_rules import count_words

SEED = 17
MAX_EPOCHS = 2
#: The budget as so many hundredths of the tokens of one epoch over all documents.
BUDGET_PERCENT = 60
#: Weights of the children of a node, by level and value; 1 where none is given. Tokens times weight must stay below 2**63.
WEIGHTS: dict[str, dict[str, int]] = {"domain": {"d0": 4, "d1": 3, "d2": 2}, "lang": {"en": 5, "de": 2, "fr": 2}, "source": {"src0": 1, "src5": 3}}
LEVELS = ("domain", "lang", "source")
#: Documents of a leaf in one block of its order; blocks are summed first, and only one block of a leaf is sorted.
BLOCK_ROWS = 4096
BROADCAST_ROWS = 500_000


def domain_of(source: Column) -> Column:
    """The default domain of a source: the number that ends its name, modulo four; `other` without one."""
    digits = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]{1,9})$", 1)
    return F.when(digits == "", "other").otherwise(F.concat(F.lit("d"), (F.try_to_number(digits, F.lit("999999999")) % 4).cast("int").cast("string")))


def _named(value: Column) -> Column:
    """A null is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), value), F.lit(""))


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    out = F.lit(1)
    for name, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == f"={name}", int(w)).otherwise(out)
    return out.cast("long")


def hand_down(children: DataFrame, parents: list[str], budget: Column, by: str) -> DataFrame:
    """Adds `got` to children with `cap` and `w`: shares of the parent's budget by weight, none above its cap.

    Children are taken by cap per weight; as long as a child's share of what is left reaches its cap it is filled, and the
    others share the rest by weight, in whole tokens rounded down. Weight 0 gets nothing.
    """
    first = W.partitionBy(*parents).orderBy(F.when(F.col("w") > 0, F.col("cap") / F.col("w")).otherwise(float("inf")), by)
    whole = W.partitionBy(*parents)
    out = children.withColumn("left_", budget - (F.sum("cap").over(first.rowsBetween(W.unboundedPreceding, 0)) - F.col("cap")))
    out = out.withColumn("w_left", F.sum("w").over(first.rowsBetween(0, W.unboundedFollowing)))
    out = out.withColumn("full", (F.col("w") > 0) & (F.col("cap") * F.col("w_left") <= F.col("w") * F.col("left_")))
    out = out.withColumn("rest", budget - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0)))
    out = out.withColumn("w_rest", F.coalesce(F.sum(F.when(~F.col("full"), F.col("w"))).over(whole), F.lit(0)))
    share = F.when(F.col("full"), F.col("cap")).when(F.col("w_rest") > 0, F.expr("(w * rest) div w_rest")).otherwise(F.lit(0))
    return out.withColumn("got", share.cast("long")).drop("left_", "w_left", "full", "rest", "w_rest")


def leaf_budgets(leaves: DataFrame, percent: int, epochs: int, weights: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """(domain, lang, source, tokens, docs, got) from the tokens and documents of every leaf."""
    leaves = leaves.withColumn("cap", F.col("tokens") * epochs)
    domains = leaves.groupBy("domain").agg(F.sum("cap").alias("cap")).withColumn("w", _weight("domain", weights))
    total = leaves.agg(F.least(F.expr(f"sum(tokens) * {int(percent)} div 100"), F.sum("cap"))).first()[0] or 0  # one number
    top = hand_down(domains.withColumn("root", F.lit(0)), ["root"], F.lit(total).cast("long"), "domain")
    middle = leaves.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).withColumn("w", _weight("lang", weights))
    middle = middle.join(top.select("domain", F.col("got").alias("above")), "domain")
    middle = hand_down(middle, ["domain"], F.col("above"), "lang")
    low = leaves.withColumn("w", _weight("source", weights))
    low = low.join(middle.select("domain", "lang", F.col("got").alias("above")), ["domain", "lang"])
    return hand_down(low, ["domain", "lang"], F.col("above"), "source").select(*LEVELS, "tokens", "docs", "got")


def _level_columns(domain: Column | None) -> list[Column]:
    """The values of a document's levels, by which leaves are told apart."""
    return [
        _named(domain_of(F.col("source")) if domain is None else domain).alias("domain"),
        _named(F.col("lang")).alias("lang"),
        _named(F.col("source")).alias("source"),
    ]


def select_documents(
    docs: DataFrame,
    percent: int = BUDGET_PERCENT,
    epochs: int = MAX_EPOCHS,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    seed: int = SEED,
    domain: Column | None = None,
) -> DataFrame:
    """(rk, doc_id, domain, lang, source, n_tokens, copies, epoch): a row for every time a document is taken.

    Documents need doc_id, text, lang and source. Null or empty texts have no tokens and cost nothing; they are taken
    wherever the prefix reaches them. Null values of a level are a node of their own. Documents equal in id, text and levels
    are taken together, all `copies` of them or none (n_tokens is of one); other ties are broken by the row key. An empty
    table gives an empty result.
    """
    units = docs.select(
        row_key().alias("rk"),
        "doc_id",
        *_level_columns(domain),
        count_words(F.col("text")).alias("n"),
    )
    units = stored(units.groupBy("rk", "doc_id", *LEVELS, "n").agg(F.count("*").alias("copies")), "mix-units")
    cost = F.col("n") * F.col("copies")
    leaves = stored(units.groupBy(*LEVELS).agg(F.sum(cost).alias("tokens"), F.count("*").alias("docs")), "mix-leaves")
    leaves = leaf_budgets(leaves, percent, epochs, weights)
    leaves = leaves.withColumn("whole", F.when(F.col("tokens") > 0, F.expr(f"least(got div tokens, {int(epochs)})")).otherwise(F.lit(0)))
    leaves = leaves.withColumn("rest", F.when(F.col("whole") < epochs, F.col("got") - F.col("whole") * F.col("tokens")).otherwise(F.lit(-1)))
    leaves = stored(leaves.withColumn("blocks", F.ceil(F.col("docs") / BLOCK_ROWS)), "mix-budgets")

    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    placed = units.join(small(leaves, BROADCAST_ROWS), list(LEVELS)).withColumn("order", order).withColumn("cost", cost)
    place = F.conv(F.substring("order", 1, 8), 16, 10).cast("long")
    placed = placed.withColumn("block", F.floor(place * F.col("blocks") / F.lit(2**32)))
    blocks = placed.groupBy(*LEVELS, "block").agg(F.sum("cost").alias("sum"), F.first("rest").alias("rest"))
    run = W.partitionBy(*LEVELS).orderBy("block").rowsBetween(W.unboundedPreceding, 0)
    blocks = blocks.withColumn("until", F.sum("sum").over(run)).withColumn("before", F.col("until") - F.col("sum"))
    blocks = blocks.select(*LEVELS, "block", "before", (F.col("until") <= F.col("rest")).alias("all"), (F.col("before") > F.col("rest")).alias("none"))
    blocks = stored(blocks, "mix-blocks")
    placed = placed.join(small(blocks, BROADCAST_ROWS), [*LEVELS, "block"])
    sure = placed.filter("all or none").withColumn("more", F.col("all").cast("int"))
    inside = W.partitionBy(*LEVELS, "block").orderBy("order", "rk").rowsBetween(W.unboundedPreceding, 0)
    edge = placed.filter("not all and not none").withColumn("more", (F.col("before") + F.sum("cost").over(inside) <= F.col("rest")).cast("int"))
    taken = sure.unionByName(edge).withColumn("times", (F.col("whole") + F.col("more")).cast("int")).filter("times > 0")
    plain = [F.when(F.col(c) != "", F.substr(c, F.lit(2))).alias(c) for c in LEVELS]
    return taken.select("rk", "doc_id", *plain, F.col("n").alias("n_tokens"), "copies", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("epoch"))


def each_copy(taken: DataFrame) -> DataFrame:
    """The rows of `select_documents` with one row for each of the equal documents that are taken together."""
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies", "copy")


def mixed(docs: DataFrame, domain: Column | None = None, **options: object) -> DataFrame:
    """The rows of `docs`, all columns, each as often as its leaf takes it.

    Null levels make a leaf of their own; null and empty texts cost nothing and are taken whole times only. Equal rows are taken
    alike, each as often as it stands there; ties of the seeded order are told apart by the row key. An empty table stays empty.
    """
    # one column of row key and levels: rows equal in id and text may stand in leaves of their own
    key = fresh_name(docs, "unit")
    taken = select_documents(docs, domain=domain, **options).select("rk", *(_named(F.col(c)) for c in LEVELS))
    taken = taken.toDF("rk", *LEVELS).select(F.struct("rk", *LEVELS).alias(key))
    return docs.withColumn(key, F.struct(row_key().alias("rk"), *_level_columns(domain))).join(taken, key).drop(key)
