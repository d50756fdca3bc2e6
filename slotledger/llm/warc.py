"""WARC archives of pages: written by tasks, read back in byte ranges whose record chains are verified.

A range of an archive does not show where its records begin, and the magic line may stand inside a payload. So every task
emits, for each magic line in its range, the offset at which the record that it might open would be followed by the next one.
Chains are first shortened to the exit from the range; pointer jumping from the start of each file then finds the entry of
every range in a number of rounds logarithmic in the ranges of a file. Only records on the chain are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotledger.llm.common import new_folder, small, stored
from slotledger.llm.records import open_folder

MAGIC = b"WARC/1.0\r\n"
END = b"\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
#: Payloads below this many bytes are always written whole.
MIN_REVISIT_BYTES = 1000
RANGE_BYTES = 4 << 20
#: Bytes read beyond a range for a header that begins in it; where one is longer, reading goes on.
MAX_HEADER = 1 << 16
#: A table of at most so many revisits is broadcast; a larger one is joined by a shuffle.
BROADCAST_REVISITS = 500_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


# -- writing -------------------------------------------------------------------------------------------------------------


def _uri(page_id: int | None) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def _page(uri: str) -> int | None:
    text = uri.removeprefix("<urn:page:").removesuffix(">")
    return None if text == "none" else int(text)


def _clean(url: str) -> str:
    """A header value has one line: control characters and spaces are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _uri(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _clean(url) if url else "urn:page:unknown"),
        ("WARC-Payload-Digest", digest),
    ]
    block = HTTP % len(payload)
    if revisit:
        fields += [("WARC-Refers-To", _uri(refers_to)), ("WARC-Profile", PROFILE), ("WARC-Truncated", "length")]
    else:
        block += payload
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = MAGIC + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    return head + block + END


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(folder)
        file, out, size, n = f"{uuid.uuid4().hex}.warc", None, 0, 0  # a name of its own for every attempt
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "refers_to", "revisit")]
            for i in range(batch.num_rows):
                page_id, url, html, refers_to, revisit = (c[i].as_py() for c in columns)
                data = record(page_id, url, (html or "").encode(), refers_to, revisit)
                if out is None:
                    out = files.open_output_stream(f"{path}/{file}")
                out.write(data)
                size, n = size + len(data), n + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [file], "size": pa.array([size], pa.int64()), "records": pa.array([n], pa.int64())})

    return write


def revisits(pages: DataFrame) -> DataFrame:
    """(pk, refers_to): pages whose payload a page of a larger id has too, and the largest such id.

    Digests and keys only are shuffled. A digest that very many pages share meets one row, and the join can split it.
    """
    key = F.xxhash64("page_id", "url", "html").alias("pk")
    payload = F.coalesce("html", F.lit(""))
    narrow = pages.select(key, "page_id", F.sha1(F.encode(payload, "UTF-8")).alias("sha"), F.octet_length(payload).alias("bytes"))
    narrow = stored(narrow.filter(F.col("bytes") >= MIN_REVISIT_BYTES).drop("bytes"), "payloads")
    keeper = narrow.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return narrow.join(keeper, "sha").filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("pk", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes every row of `pages` (page_id, url, html) to archives in `folder`; returns the stored list of files.

    Null html is an empty payload, which is never a revisit. Rows that share the largest page_id of a payload are all
    responses; a null page_id is smaller than any other. Other columns are not looked at. An empty table writes nothing.
    """
    spark = pages.sparkSession
    files, path = open_folder(folder)
    files.create_dir(path, recursive=True)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    again = stored(revisits(pages), "revisits")
    rows = pages.withColumn("pk", F.xxhash64("page_id", "url", "html")).join(small(again.withColumn("revisit", F.lit(True)), BROADCAST_REVISITS), "pk", "left")
    rows = rows.select("page_id", "url", "html", "refers_to", F.coalesce("revisit", F.lit(False)).alias("revisit"))
    made = rows.mapInArrow(_writer(folder), "file string, size long, records long")
    made.write.parquet(f"{folder}/list")
    return spark.read.schema(made.schema).parquet(f"{folder}/list")


# -- reading -------------------------------------------------------------------------------------------------------------


def parse_header(data: bytes, at: int) -> tuple[dict[str, str], int] | None:
    """The fields of the record header at `at` and where its block begins; None if there is no header, or not all of it."""
    end = _header_end(data, at)
    if end is None or end < 0:
        return None
    fields = {}
    for line in data[at + len(MAGIC) : end - len(END)].split(b"\r\n"):
        name, _, value = line.partition(b":")
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not fields.get("content-length", "").isdigit():
        return None
    return fields, end


def _header_end(data: bytes, at: int) -> int | None:
    """Where the header at `at` ends; -1 if `data` ends before it, None if there is no header. Headers may have any length."""
    if not data.startswith(MAGIC, at):
        return None
    line = at + len(MAGIC)
    while (end := data.find(b"\r\n", line)) > line:
        if data.find(b":", line, end) < 0:
            return None
        line = end + 2
    if end < 0:
        return -1
    return end + 2 if line > at + len(MAGIC) else None


def unfinished(data: bytes, high: int) -> bool:
    """Whether a header that begins before `high` goes on beyond `data`; if any does, the last one does."""
    at = data.rfind(MAGIC, 0, high + len(MAGIC) - 1)
    return at >= 0 and _header_end(data, at) == -1


def candidates(data: bytes, base: int, low: int, high: int) -> list[tuple[int, int, int]]:
    """(offset, next, exit) of what looks like a record in low..high of a file, from its bytes `data` that begin at `base`.

    `next` is where the record would be followed by another one; `exit` is the first offset outside the range that its chain
    comes to, or -1 if the chain breaks inside the range.
    """
    found: list[tuple[int, int]] = []
    at = data.find(MAGIC, low - base)
    while 0 <= at < high - base:
        if head := parse_header(data, at):
            found.append((base + at, base + head[1] + int(head[0]["content-length"]) + len(END)))
        at = data.find(MAGIC, at + 1)
    exits: dict[int, int] = {}
    for offset, after in reversed(found):
        exits[offset] = after if after >= high else exits.get(after, -1)
    return [(offset, after, exits[offset]) for offset, after in found]


def _ranges(folder: str):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with files.open_input_file(f"{path}/{row['file']}") as source:
                    data = source.read_at(min(row["high"] + MAX_HEADER, row["size"]) - row["low"], row["low"])
                    while row["low"] + len(data) < row["size"] and unfinished(data, row["high"] - row["low"]):
                        after = row["low"] + len(data)
                        data += source.read_at(min(max(len(data), MAX_HEADER), row["size"] - after), after)
                if found := candidates(data, row["low"], row["low"], row["high"]):
                    offset, after, out = zip(*found)
                    yield pa.RecordBatch.from_pydict(
                        {"file": [row["file"]] * len(found), "offset": pa.array(offset, pa.int64()), "next": pa.array(after, pa.int64()), "exit": pa.array(out, pa.int64())}
                    )

    return scan


def _read(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                made = []
                with files.open_input_file(f"{path}/{row['file']}") as source:
                    data = source.read_at(min(row["high"] + MAX_HEADER, row["size"]) - row["entry"], row["entry"])
                    at = 0
                    while row["entry"] + at < row["high"]:
                        while not (head := parse_header(data, at)):  # the header goes on beyond what was read
                            more = source.read_at(max(len(data), MAX_HEADER), row["entry"] + len(data))
                            if not more:
                                raise ValueError(f"no record at {row['entry'] + at} of {row['file']}")
                            data += more
                        fields, block = head
                        length = int(fields["content-length"])
                        if block + length > len(data):  # the last record goes on beyond the range
                            data = data[at:] + source.read_at(block + length - len(data), row["entry"] + len(data))
                            row["entry"], block, at = row["entry"] + at, block - at, 0
                        made.append(_result(fields, data[block : block + length]))
                        at = block + length + len(END)
                if made:
                    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], names=_NAMES)

    return read


_NAMES = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"]
RESULT = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string"


def _result(fields: dict[str, str], block: bytes) -> tuple:
    head, _, payload = block.partition(END)
    size = int(re.search(rb"Content-Length: (\d+)", head)[1])
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    revisit = fields["warc-type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    refers = _page(fields["warc-refers-to"]) if revisit else None
    return _page(fields["warc-record-id"]), fields["warc-target-uri"], size, digest, fields["warc-type"], refers, None if revisit else payload.decode()


def range_entries(ranges: DataFrame, folder: str) -> DataFrame:
    """(file, offset): where the chain from the start of each file enters its ranges, and where it ends.

    Only offsets to which some chain leads matter; that leaves a few rows for each range, however many records it holds.
    """
    marks = stored(ranges.mapInArrow(_ranges(folder), "file string, offset long, next long, exit long"), "candidates")
    starts = ranges.select("file").distinct().withColumn("offset", F.lit(0).cast("long"))
    led = marks.filter("exit >= 0").select("file", F.col("exit").alias("offset")).unionByName(starts).distinct()
    jump = stored(marks.filter("exit >= 0").join(led, ["file", "offset"], "left_semi").select("file", "offset", F.col("exit").alias("to")), "jumps")
    longest = ranges.groupBy("file").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    reached = starts
    for k in range(int(longest).bit_length() + 1):
        step = reached.join(jump, ["file", "offset"]).select("file", F.col("to").alias("offset"))
        reached = stored(reached.unionByName(step).distinct(), f"reached-{k}")
        on = jump.select("file", F.col("offset").alias("to"), F.col("to").alias("on"))
        jump = stored(jump.join(on, ["file", "to"], "left").select("file", "offset", F.coalesce("on", "to").alias("to")), f"jumps-{k}")
    return reached


def read_archives(folder: str, listed: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, html) of every record of the listed files.

    html is null for revisits, whose bytes stand in the response that they refer to. Payloads are checked against their
    digests, and every chain must end with its file; otherwise that is an error.
    """
    tasks = max(listed.sparkSession.sparkContext.defaultParallelism, (listed.agg(F.sum("size")).first()[0] or 0) // (8 * range_bytes))
    size, low = F.col("size"), F.col("low")
    ranges = listed.filter("size > 0").select("file", "size", F.explode(F.sequence(F.lit(0).cast("long"), size - 1, F.lit(range_bytes).cast("long"))).alias("low"))
    ranges = ranges.withColumn("high", F.least(low + range_bytes, size)).repartition(int(tasks), "file", "low")
    ranges = stored(ranges, "ranges")
    reached = range_entries(ranges, folder)
    ended = reached.join(listed, (reached["file"] == listed["file"]) & (reached["offset"] == listed["size"]), "left_semi").count()
    if ended != listed.filter("size > 0").count():
        raise ValueError("the record chain of a file breaks before its end")
    entries = reached.select("file", (F.floor(F.col("offset") / range_bytes) * range_bytes).alias("low"), F.col("offset").alias("entry"))
    work = ranges.join(entries, ["file", "low"]).filter("entry < high").repartition(int(tasks), "file", "low")
    return work.mapInArrow(_read(folder), RESULT)


def archive_and_read_back(pages: DataFrame, folder: str | None = None) -> DataFrame:
    folder = folder or new_folder(pages.sparkSession, "warc")
    return read_archives(folder, write_archives(pages, folder))
