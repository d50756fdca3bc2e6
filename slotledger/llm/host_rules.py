"""Quality rules with host verdicts: documents are measured, hosts are judged by the shrunken rates of their failures.

Main path: DataFrame functions only. Every measure of a text is worked out inside its own row, so no word is shuffled; what
is shuffled are sums per host.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger.llm.common import small, stored

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Rules that only hosts are judged by: symbols among the characters of words, repeated lines.
MAX_SYMBOL_PERCENT, MAX_DUP_LINES = 10, 3
#: A host is turned away whole if it fails a rule at more than so many times the rate of hosts at large, beyond so many
#: standard deviations of doubt; where hosts fail often, if it is more than halfway from their rate to always.
TIMES_PRIOR, DOUBT = 2.0, 2.0
#: A host table of at most so many rows is broadcast; a larger one is joined by a shuffle, where a hot host can be split.
BROADCAST_HOSTS = 200_000


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is worked out once for each row, however often later expressions and lambdas use it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def with_measures(docs: DataFrame) -> DataFrame:
    """`docs` (any columns, `text` among them) and a struct `measures`: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    A null text counts as empty and has zeros. Two 3-word windows are taken for equal if their 64-bit hashes are; within one
    text of a million words the chance of a wrong pair is below one in ten million.
    """
    kept = [f"`{c}`" for c in docs.columns]
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.trim(F.regexp_replace(text, SPACE, " "))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, " ", -1))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    at = docs.select(
        F.struct(*kept).alias("row"),
        F.struct(
            (F.length(trimmed) + F.when(trimmed == "", 0).otherwise(1)).alias("chars_and_words"),
            F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).alias("symbols"),
        ).alias("counts"),
        words.alias("words"),
        lines.alias("lines"),
    )
    at = once(at.select("row", "counts", F.struct("words", "lines").alias("pair")), "held", F.col("pair")).drop("pair")
    n = F.size("held.words")
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.struct(F.xxhash64(F.get("held.words", i), F.get("held.words", i + 1), F.get("held.words", i + 2)).alias("h"), i.alias("i")),
        ),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    at = at.select(
        "row",
        "counts",
        n.alias("n"),
        (F.size("held.lines") - F.size(F.array_distinct("held.lines"))).alias("dup_lines"),
        F.sort_array(windows).alias("windows"),
    )
    at = once(at.select("row", "counts", "n", "dup_lines", F.struct("windows").alias("w")), "s", F.col("w.windows")).drop("w")
    again = F.filter("s", lambda x, j: F.coalesce(F.get("s", j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("s", j + 1)["h"] == x["h"], F.lit(False)))
    at = once(at, "again", F.transform(again, lambda x: x["i"]))
    covered = F.when(F.size("again") == 0, 0).otherwise(
        F.size(F.array_union(F.array_union("again", F.transform("again", lambda i: i + 1)), F.transform("again", lambda i: i + 2)))
    )
    measures = F.struct(
        F.col("n").cast("long").alias("n_words"),
        (F.col("counts.chars_and_words") - F.col("n")).cast("long").alias("word_chars"),
        F.col("counts.symbols").cast("long").alias("n_symbols"),
        F.col("dup_lines").cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
    )
    return at.select("row.*", measures.alias("measures"))


def count_words(text: Column, gap: str = SPACE) -> Column:
    """How many words a text has, parted by the characters of the pattern `gap`; none if it is null."""
    line = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), gap, " "))
    return F.when(line == "", 0).otherwise(F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1).cast("long")


def base_rules(m: str = "") -> dict[str, Column]:
    """The rules of the base verdict over columns n_words and n_repeat_words."""
    c = lambda name: F.col(f"{m}{name}")
    return {"short": c("n_words") < MIN_WORDS, "repeats": 100 * c("n_repeat_words") > MAX_REPEAT_PERCENT * c("n_words")}


def host_rules(m: str = "") -> dict[str, Column]:
    """The rules whose failures are added up by host: those of the base verdict and further ones."""
    c = lambda name: F.col(f"{m}{name}")
    return base_rules(m) | {
        "symbols": 100 * c("n_symbols") > MAX_SYMBOL_PERCENT * c("word_chars"),
        "lines": c("n_dup_lines") > MAX_DUP_LINES,
    }


def host_rates(marked: DataFrame, host: str, rules: Mapping[str, Column]) -> DataFrame:
    """(host, n_docs, rate_<rule>..., failed): failure rates of each host, shrunk towards an empirical beta prior.

    The prior of a rule has the mean and variance of the hosts' raw rates (moments). Where hosts do not differ at all, its
    weight is that of a million documents; where they differ as much as they can, that of one thousandth. A null host is a host.

    The shrunken rate is the mean of the host's posterior. `failed` is set if for some rule that mean, less DOUBT standard
    deviations of the posterior, is above a limit taken from the prior: TIMES_PRIOR its mean, or halfway from it to 1 if that is
    less. So a host of few documents is spared, and one that is like the others never fails, however often all of them do.
    """
    sums = marked.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n_docs"), *[F.sum(rule.cast("long")).alias(f"bad_{name}") for name, rule in rules.items()]
    )
    sums = stored(sums, "host-sums")
    raw = {name: F.col(f"bad_{name}") / F.col("n_docs") for name in rules}
    prior = sums.agg(*[f(raw[name]).alias(f"{k}_{name}") for name in rules for k, f in (("mean", F.avg), ("var", F.var_pop))])
    out, known = sums.withColumn("failed", F.lit(False)), prior.first()  # one row of two numbers for each rule
    for name in rules:
        mean, var = known[f"mean_{name}"] or 0.0, known[f"var_{name}"] or 0.0
        weight = max(mean * (1 - mean) / var - 1, 1e-3) if var > 0 else 1e6
        total = F.col("n_docs") + weight
        rate = (F.col(f"bad_{name}") + mean * weight) / total
        doubt = DOUBT * F.sqrt(rate * (1 - rate) / (total + 1))
        limit = min(TIMES_PRIOR * mean, (1 + mean) / 2)
        out = out.withColumn(f"rate_{name}", rate).withColumn("failed", F.col("failed") | (rate - doubt > limit))
    return out.select("host", "n_docs", *[f"rate_{name}" for name in rules], "failed")


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """Per row of `docs`: doc_id, host, the five measures, base_failed, host_failed, kept, n_host_docs and the host's rates.

    Null or empty text: zeros, base_failed. A null host is a host of its own; ties and repeated rows count as they stand; an
    empty table gives an empty result. Other columns of `docs` are not looked at, whatever their names.
    """
    measured = with_measures(docs.select("doc_id", F.col(host).alias("host"), "text")).select("doc_id", "host", "measures.*")
    measured = stored(measured, "measures")
    rules, base = host_rules(), base_rules()
    failed = base["short"] | base["repeats"]
    hosts = host_rates(measured, "host", rules).withColumnsRenamed({"host": "of", "failed": "host_failed"})
    hosts = hosts.withColumnRenamed("n_docs", "n_host_docs")
    out = measured.join(small(hosts, BROADCAST_HOSTS), F.col("host").eqNullSafe(F.col("of")), "left").drop("of")
    return out.select(
        "doc_id",
        "host",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        "host_failed",
        (~failed & ~F.col("host_failed")).alias("kept"),
        "n_host_docs",
        *[f"rate_{name}" for name in rules],
    )
