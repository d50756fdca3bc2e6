"""Benchmark decontamination by a positional inverted index over the training documents.

Main path: DataFrame functions only. Documents are cut into words once. The index, stored, holds the postings (term, document,
position) of every term that an item has; all else comes from it: how often terms occur, the lists that a search starts from,
and the proof. A search starts from the rarest two terms of every window. Lists are shifted by the term's place in its item;
where the shifted lists of both meet, the postings of the window's other terms are asked for at their places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger.llm.common import BROADCAST_KEYS, fresh_name, light, row_key, small, stored
from slotledger.llm.host_rules import once

WINDOW = 10
RAREST = 2
#: Tables over the benchmark of at most so many bytes are broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 64 << 20
#: Stands in the index for the end of a document; no term has a blank.
END = " "
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Characters beyond ASCII that lower() might change: capitals, numerals and ringed letters, and all of the planes and ranges
#: whose letters differ between versions of Unicode.
FOREIGN_CAPITAL = r"[\p{Lu}\p{Lt}Ⅰ-ⅯⒶ-Ⓩ\x{1C80}-\x{1CBF}\x{2C00}-\x{2C7F}\x{A640}-\x{A7FF}\x{10000}-\x{10FFFF}&&[^\x00-\x7F]]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else unchanged; the built-in lower() where it does the same."""
    return F.when(text.rlike(FOREIGN_CAPITAL), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words(text: Column) -> Column:
    line = F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), GAP, " "))
    return F.when(line == "", F.array().cast("array<string>")).otherwise(F.split(line, " ", -1))


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(ik, item, words, starts): each distinct item with the starts of its windows; a shorter item is one window."""
    out = items.select(F.xxhash64("item_id", "text").alias("ik"), F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("words"))
    out = once(out.distinct().select("ik", "item", F.struct("words").alias("held")), "h", F.col("held")).select("ik", "item", "h.words")
    return out.filter(F.size("words") > 0).withColumn("starts", F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0))))


def numbered_terms(terms: DataFrame) -> DataFrame:
    """(term, t), stored: the distinct terms, and one for the end of a document, with 64-bit numbers of which no two are equal."""
    distinct = terms.select("term").distinct().unionByName(terms.sparkSession.range(1).select(F.lit(END).alias("term")))
    seed = 0
    while True:
        numbered = stored(distinct.withColumn("t", F.xxhash64(F.lit(seed), "term")).withColumn("seed", F.lit(seed)), "terms")
        if numbered.groupBy("t").count().filter("count > 1").isEmpty():
            return numbered
        seed += 1


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(t, rk, pos, doc_id), stored: every occurrence of the numbered `terms` in the documents, whole texts.

    Each row of `docs` ends in a posting of END, whose position is how many words it has; these alone carry the doc_id. Words
    meet terms by number first and then as they are.
    """
    seed = terms.select("seed").first()["seed"]
    spelt = docs.select(row_key().alias("rk"), "doc_id", F.posexplode(F.concat(words(F.col("text")), F.array(F.lit(END)))).alias("pos", "word"))
    spelt = spelt.withColumn("t", F.xxhash64(F.lit(seed), "word"))
    known = light(terms.select("t", "term"), F.octet_length("term") + 32, BROADCAST_BYTES)
    met = spelt.join(known, "t").filter(F.col("word") == F.col("term"))
    return stored(met.select("t", "rk", "pos", F.when(F.col("word") == END, F.col("doc_id")).alias("doc_id")), "postings")


def end_number(terms: DataFrame) -> int:
    return terms.filter(F.col("term") == END).select("t").first()["t"]


def item_places(windows: DataFrame, terms: DataFrame) -> DataFrame:
    """(ik, q, t), stored: the term at each place of each item."""
    places = windows.select("ik", F.posexplode("words").alias("q", "term"))
    return stored(places.join(terms.select("term", "t"), "term").select("ik", "q", "t"), "places")


def anchors(windows: DataFrame, places: DataFrame, index: DataFrame, window: int = WINDOW) -> DataFrame:
    """(ik, start, len, q), stored: for each window that can occur, the places in the item of its rarest terms, a row for each.

    Counts are over all documents; a window with a term that no document has cannot occur and is left out. A place is in ten
    windows at most, so items of any length cost in proportion.
    """
    counts = index.groupBy("t").agg(F.count("*").alias("n"))
    sizes = windows.select("ik", F.size("words").alias("size"), F.least(F.size("words"), F.lit(window)).alias("len"))
    counted = places.join(counts, "t").join(sizes, "ik")
    starts = F.sequence(F.greatest(F.col("q") - F.col("len") + 1, F.lit(0)), F.least(F.col("q"), F.col("size") - F.col("len")))
    ranked = counted.select("ik", "len", "n", "q", F.explode(starts).alias("start")).groupBy("ik", "start", "len")
    ranked = ranked.agg(F.sort_array(F.collect_list(F.struct("n", "q"))).alias("ranked")).filter(F.size("ranked") == F.col("len"))
    return stored(ranked.select("ik", "start", "len", F.explode(F.slice("ranked", 1, RAREST)["q"]).alias("q")), "anchors")


def meetings(index: DataFrame, places: DataFrame, picked: DataFrame) -> DataFrame:
    """(ik, rk, shift, start, len), stored: where the document has all rarest terms of the item's window at `start`, `shift` further on."""
    needed = picked.groupBy("ik", "start", "len").agg(F.count("*").alias("needed"))
    first = picked.join(places, ["ik", "q"]).join(needed, ["ik", "start", "len"])
    hits = index.join(light(first, F.lit(64), BROADCAST_BYTES), "t").withColumn("shift", F.col("pos") - F.col("q"))
    hits = hits.filter(F.col("shift") + F.col("start") >= 0).select("ik", "rk", "shift", "start", "len", "needed", "q").distinct()
    met = hits.groupBy("ik", "rk", "shift", "start", "len", "needed").agg(F.count("*").alias("n")).filter("n = needed")
    return stored(met.select("ik", "rk", "shift", "start", "len"), "meetings")


def phrase_matches(index: DataFrame, windows: DataFrame, places: DataFrame, window: int = WINDOW) -> DataFrame:
    """(rk, item, pos, len): every place where a whole window of an item occurs in a document, with equal windows once."""
    met = meetings(index, places, anchors(windows, places, index, window))
    # the document must have every term of the window at its place
    asked = met.withColumn("q", F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)))
    asked = asked.join(light(places, F.lit(48), BROADCAST_BYTES), ["ik", "q"]).withColumn("pos", F.col("shift") + F.col("q"))
    here = index.join(small(met.select("rk").distinct(), BROADCAST_KEYS), "rk", "left_semi").select("rk", "t", "pos")
    have = asked.join(here, ["rk", "t", "pos"], "left_semi")
    whole = have.groupBy("ik", "rk", "shift", "start", "len").agg(F.count("*").alias("n")).filter(F.col("n") == F.col("len"))
    names = light(windows.select("ik", "item"), F.octet_length("item") + 32, BROADCAST_BYTES)
    return whole.join(names, "ik").select("rk", "item", (F.col("shift") + F.col("start")).alias("pos"), "len").distinct()


def proximity_matches(docs: DataFrame, items: DataFrame, slop: int, window: int = WINDOW) -> DataFrame:
    """(rk, item, pos): places from which all terms of a window occur, in any order, within window + slop words.

    The lists of the rarest two terms are met with a difference of up to window + slop, in blocks of that length and their
    neighbours; the document's words from there on are then searched for every term.
    """
    windows = stored(item_windows(items, window), "items")
    numbers = numbered_terms(windows.select(F.explode("words").alias("term")))
    postings = build_index(docs, numbers)
    picked = anchors(windows, item_places(windows, numbers), postings, window)
    picked = picked.groupBy("ik", "start").agg(F.collect_list("q").alias("places"))
    spread = window + slop
    wanted = windows.join(picked, "ik").select(
        "item",
        F.slice("words", F.col("start") + 1, F.lit(window)).alias("terms"),
        F.get("words", F.get("places", F.lit(0))).alias("first"),
        F.get("words", F.coalesce(F.get("places", F.lit(1)), F.get("places", F.lit(0)))).alias("second"),
    )
    wanted = stored(wanted.distinct(), "wanted")
    index = postings.join(light(numbers.select("t", "term"), F.octet_length("term") + 32, BROADCAST_BYTES), "t").select("term", "rk", "pos")
    a = index.withColumnsRenamed({"term": "first", "pos": "p"}).withColumn("block", F.explode(F.array(*[F.floor(F.col("p") / spread) + k for k in (-1, 0, 1)])))
    b = index.withColumnsRenamed({"term": "second", "pos": "r"}).withColumn("block", F.floor(F.col("r") / spread))
    long_wanted = F.octet_length(F.concat_ws(" ", "terms")) + 64 + F.octet_length("item")
    met = a.join(light(wanted, long_wanted, BROADCAST_BYTES), "first").join(b, ["rk", "second", "block"]).filter(F.abs(F.col("p") - F.col("r")) < spread)
    met = met.select("rk", "item", "terms", "p").distinct().groupBy("rk").agg(F.collect_list(F.struct("item", "terms", "p")).alias("found"))
    texts = docs.select(row_key().alias("rk"), "text").join(met, "rk").select("rk", F.struct("found", words(F.col("text")).alias("doc_words")).alias("pair"))
    rows = once(texts, "held", F.col("pair")).select("rk", "held.doc_words", F.inline("held.found"))
    froms = F.sequence(F.greatest(F.col("p") - spread + 1, F.lit(0)), F.col("p"))
    good = F.filter(froms, lambda s: F.size(F.array_except("terms", F.slice("doc_words", s + 1, F.lit(spread)))) == 0)
    return rows.select("rk", "item", F.explode(good).alias("pos")).distinct()


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of `docs`: rk, doc_id, n_words, n_hit, n_items, items (sorted ids as strings), contaminated.

    Null or empty text has no words and is never contaminated. Equal rows get equal results; a null item id counts as ''; an
    item without words never occurs, one of very many words costs in proportion to them. Either table may be empty. Other
    columns are not looked at.
    """
    windows = stored(item_windows(items.select("item_id", "text"), window), "items")
    terms = numbered_terms(windows.select(F.explode("words").alias("term")))
    index = build_index(docs.select("doc_id", "text"), terms)
    found = stored(phrase_matches(index, windows, item_places(windows, terms), window), "matches")
    covered = found.select("rk", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("len") - 1)).alias("at")).distinct()
    hits = covered.groupBy("rk").agg(F.count("*").alias("n_hit"))
    named = found.select("rk", "item").distinct().groupBy("rk").agg(F.sort_array(F.collect_list("item")).alias("items"))
    base = index.filter(F.col("t") == end_number(terms)).select("rk", "doc_id", F.col("pos").cast("long").alias("n_words"))
    out = base.join(hits.join(named, "rk"), "rk", "left")
    return out.select(
        "rk",
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def digest(out: DataFrame) -> DataFrame:
    return out.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated"
    )


def without_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of `docs`, all columns, in which no window of an item occurs.

    Null and empty texts stay, and so do equal rows, as many as there are, unless a window occurs in them; where there are no
    items all rows stay.
    """
    found = contamination(docs, items, window).filter("contaminated").select("rk").distinct()
    key = fresh_name(docs, "rk")
    bad = small(stored(found, "contaminated").withColumnRenamed("rk", key), BROADCAST_KEYS)
    return docs.withColumn(key, row_key()).join(bad, key, "left_anti").drop(key)
