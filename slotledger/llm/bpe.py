"""Byte-pair encoding and decoding: a queue of merge ranks over a doubly linked list of symbols.

A word starts as one symbol for each of its characters. Every two neighbours that have a merge wait in a priority queue, by
rank and then place. The first is taken out, its right symbol leaves the list, and the pairs it now makes on either side join
the queue. An entry whose pair is no longer there is stale and is skipped, so that a word of n characters takes n log n steps.
Decoding looks up the string of every id and concatenates.

Vocabulary, merges and the treatment of text before them (special tokens, normalization, parting of words) come from a public
tokenizer file, whose path every executor must reach. Texts are encoded in the tasks that read them; nothing is shuffled.
"""

from __future__ import annotations

import json
import os
import re
import string
from array import array
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotledger.llm.common import tidied

#: Words, and stretches between white space, whose ids a worker keeps at hand (twice as many for a while); changes the speed only.
CACHE = 300_000
#: Ids (or characters) after which rows are handed on.
BATCH_UNITS = 4_000_000

_BLANK = re.compile("[ \t\n\r]+")
# ASCII letters and marks after them; the apostrophe, which may open a word of its own, is not among the marks.
_LETTERS, _MARKS = string.ascii_letters, "".join(c for c in string.punctuation if c != "'")
_PLAIN_STRETCH = re.compile(f"([A-Za-z]+)([{re.escape(_MARKS)}]*)")
# Byte-level vocabularies write a byte as a printable character: itself, or the next free one from 256 on.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_OF = {chr(b): b for b in _PLAIN} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in _PLAIN)}


def merge_word(ids: list[int], ranks: dict[int, int], made: list[int], base: int) -> list[int]:
    """The symbols of one word after all merges.

    `ranks` gives the rank of the pair a, b under the number a * base + b, `made` the symbol that each rank makes.
    """
    ids, size = list(ids), len(ids)
    before, after = list(range(-1, size - 1)), [*range(1, size), -1]
    queue = [rank << 32 | at for at, pair in enumerate(zip(ids, ids[1:])) if (rank := ranks.get(pair[0] * base + pair[1])) is not None]
    heapify(queue)
    while queue:
        entry = heappop(queue)
        at, rank = entry & 0xFFFFFFFF, entry >> 32
        right = after[at]
        if right < 0 or ids[at] < 0:
            continue  # stale: the symbol has gone into the one before it, or is the last now
        now = ranks.get(ids[at] * base + ids[right])
        if now != rank and (now is None or made[now] != made[rank]):
            continue  # stale: other symbols stand here since
        new = ids[at] = made[rank]
        ids[right] = -1
        behind = after[at] = after[right]
        if behind >= 0:
            before[behind] = at
            if (rank := ranks.get(new * base + ids[behind])) is not None:
                heappush(queue, rank << 32 | at)
        left = before[at]
        if left >= 0 and (rank := ranks.get(ids[left] * base + new)) is not None:
            heappush(queue, rank << 32 | left)
    return [i for i in ids if i >= 0]


class Recent(dict):
    """Values worked out when they are first asked for. Once full, those not asked for since it was last full are let go."""

    def __init__(self, work: Callable[[str], bytes], limit: int):
        self.work, self.limit, self.old = work, limit, {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        self[key] = value = self.work(key) if value is None else value
        return value


class Coder:
    """One tokenizer file. Its truncation, padding and post-processing are not applied."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or odd:
            raise ValueError(f"not a plain byte-pair model: {model['type']} {odd}")
        self.vocabulary: dict[str, int] = model["vocab"]
        self.base = 1 + max(self.vocabulary.values(), default=0)
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[self.vocabulary[a] * self.base + self.vocabulary[b]] = rank
            self.made.append(self.vocabulary[a + b])
        self.end = model.get("end_of_word_suffix") or ""
        special = {t["content"]: t["id"] for t in told["added_tokens"] if t["content"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in told["added_tokens"]):
            raise ValueError("added tokens that are matched other than letter by letter")
        self.special = special
        self.parts = re.compile("(" + "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.normalizer, self.words = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.known = Recent(self.word, CACHE)
        self.stretches = Recent(self.section, CACHE) if self._blanks_part(told["pre_tokenizer"]) else None
        self.letters = self._letters_and_marks() if self.stretches is not None else None
        self.strings = [""] * (1 + max([*self.vocabulary.values(), *special.values()]))
        for token, i in [*self.vocabulary.items(), *special.items()]:
            self.strings[i] = token
        decoder = (told.get("decoder") or {}).get("type")
        if decoder not in (None, "ByteLevel"):
            raise ValueError(f"decoder {decoder}")
        self.joined_by = " " if decoder is None else ""
        self.raw = None if decoder is None else [bytes(_BYTE_OF[c] for c in s) if all(c in _BYTE_OF for c in s) else s.encode() for s in self.strings]

    def _blanks_part(self, words: dict | None) -> bool:
        """Whether white space always parts words and is then dropped, so that texts may be cut there."""
        first = ((words or {}).get("pretokenizers") or [words or {}])[0]
        removes = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
        return bool(removes) and not any(_BLANK.search(s) for s in self.special) and [w for w, _ in self.split("a b\t\n\rc ")] == ["a", "b", "c"]

    def _letters_and_marks(self) -> Callable[[str], str] | None:
        """What becomes of the letters where a run of letters is one word and the marks after it are another; None where not."""
        if any(re.fullmatch(f"[A-Za-z]*[{re.escape(_MARKS)}]*", s) for s in self.special):
            return None
        words = lambda text: [w for w, _ in self.split(text)]
        for change in (str.lower, str):
            asked = [(_LETTERS, [change(_LETTERS)]), (f"aB{_MARKS}", [change("aB"), _MARKS]), *((f"aB{c}{c}", [change("aB"), c + c]) for c in _MARKS)]
            if all(words(text) == parts for text, parts in asked):
                return change
        return None

    def split(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        return self.words.pre_tokenize_str(text) if self.words is not None else [(text, (0, len(text)))]

    def word(self, word: str) -> bytes:
        symbols = [*word[:-1], word[-1] + self.end]
        ids = merge_word([self.vocabulary[s] for s in symbols if s in self.vocabulary], self.ranks, self.made, self.base)
        return array("i", ids).tobytes()

    def section(self, text: str) -> bytes:
        if self.letters is not None and (plain := _PLAIN_STRETCH.fullmatch(text)):
            return self.known[self.letters(plain[1])] + (self.known[plain[2]] if plain[2] else b"")
        out: list[bytes] = []
        for k, part in enumerate(self.parts.split(text) if self.parts else [text]):
            if k % 2:
                out.append(array("i", [self.special[part]]).tobytes())
            elif part:
                out += [self.known[word] for word, _ in self.split(part) if word]
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, 4 bytes each."""
        if self.stretches is None:
            return self.section(text)
        known = self.stretches
        return b"".join([known[s] for s in _BLANK.split(text) if s])

    def decode(self, ids: list[int]) -> str:
        """The strings of the ids, special ones too; bytes that are no UTF-8 become replacement characters."""
        if self.raw is None:
            strings = self.strings
            return self.joined_by.join([strings[i] for i in ids])
        raw = self.raw
        return b"".join([raw[i] for i in ids]).decode("utf-8", "replace")


_coders: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    if path not in _coders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _coders[path] = Coder(path)
    return _coders[path]


def _id_lists(rows: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(r) // 4 for r in rows)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(rows), dtype=np.int32)))


def _encoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = coder(path)
        for batch in batches:
            doc_ids, first, made, units = batch.column("doc_id"), 0, [], 0
            for k, text in enumerate(batch.column("text")):
                made.append(of.encode(text.as_py() or ""))
                units += len(made[-1]) // 4
                if units >= BATCH_UNITS or k + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([doc_ids.slice(first, len(made)), _id_lists(made)], names=["doc_id", "ids"])
                    first, made, units = k + 1, [], 0

    return run


def _decoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = coder(path)
        for batch in batches:
            columns, first, made, units = [batch.column("doc_id"), batch.column("ids")], 0, [], 0
            for k, ids in enumerate(columns[1]):
                made.append(of.decode(ids.values.to_numpy(zero_copy_only=False).tolist() if ids.is_valid else []))
                units += len(made[-1])
                if units >= BATCH_UNITS or k + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([*(c.slice(first, len(made)) for c in columns), pa.array(made, pa.string())], names=["doc_id", "ids", "text"])
                    first, made, units = k + 1, [], 0

    return run


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids) of every row of `docs`, whole texts; a null or empty text has an empty list, a null doc_id stays.

    Repeated rows give a row each. The strings of special tokens in a text become their ids, as the tokenizers library does
    it. Other columns, whatever their names, are not looked at. An empty table gives no rows. A word of any length is merged
    in n log n steps; what is held is one batch of texts with its ids.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tidied(_encoder(tokenizer)), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, text) of every row of `encoded` (doc_id, ids); null or no ids give an empty text.

    An id that the vocabulary does not have is an error. Where the file names no decoder, the strings are parted by a space,
    as the library does it; with a byte-level decoder they are turned back into bytes.
    """
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(
        tidied(_decoder(tokenizer)), "doc_id long, ids array<int>, text string"
    )


def digest(decoded: DataFrame) -> DataFrame:
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2(F.col("text"), 256).alias("decoded_sha256"))
