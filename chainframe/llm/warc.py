"""WARC archives: written with an index, read back by coalesced byte ranges.

Writing: each row becomes one WARC/1.1 record holding an HTTP response whose body is the page in UTF-8,
compressed as a gzip member of its own. Of rows with equal bodies of at least ``min_revisit_bytes`` the one
with the smallest key becomes the response and the others become revisit records without a body that name
it; smaller bodies are all responses. Records are dealt to archives by the hash of their key and digest, so no host,
popular body or missing key makes one archive large; only rows that are equal in both share one. Tasks stream their archives to the shared folder, in any store that
pyarrow opens, and the index (file, offset, length, url, digest and key of each record) is written as
Parquet before anything is read.

Reading: the index rows that a caller selects are sorted by file and offset; ranges that are near each
other become one read of bounded size; each read is a row of its own and is sliced into its records by the
index.

Null bodies are empty payloads; a null url leaves the header out; control characters in urls are percent-encoded. Rows with a
null key are responses or revisits like others, after all other keys. Repeated rows each get a record; of
equal keys with equal bodies one is the response. Further columns are left aside; an empty table makes an empty index. Very long bodies
are one record, which a task holds whole.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainframe.llm.common import bound_batches, cut, new_path

END = "\r\n\r\n"
MIN_REVISIT_BYTES = 100
#: Bodies of an archive; small inputs are dealt to as many archives as there are shuffle partitions.
ARCHIVE_BYTES, LEAST_RECORDS = 256 << 20, 256
LEVEL = 4  # of gzip
#: Selected records less than GAP bytes apart are read at once, up to READ bytes; a task reads about TASK bytes.
GAP, READ, TASK = 16_384, 1 << 20, 64 << 20
SALTS = 64
#: Digests that repeat (80 bytes each) are broadcast up to this many; with more, the bodies of revisits go along to be left out later.
BROADCAST_ROWS = 100_000
_DATE = "2026-01-01T00:00:00Z"
_ENTRY = "key string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"


def _header(name: str, value) -> Column:
    """A header line; nothing if the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _head() -> Column:
    """The text of a WARC record before its body."""
    response = F.col("record_type") == "response"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    url = F.col("url")
    for code in (0x09, 0x0A, 0x0D):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    named = lambda key: F.concat(F.lit("<urn:page:"), F.col(key), F.lit(">"))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", named("key")),
        _header("WARC-Date", F.lit(_DATE)),
        _header("WARC-Target-URI", url),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(response, "").otherwise("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
        _header("WARC-Refers-To", named("refers_to")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _header("Content-Length", (F.octet_length(http) + F.when(response, F.col("payload_bytes")).otherwise(0)).cast("string")),
        F.lit("\r\n"),
        http,
    )


def _firsts(rows: DataFrame, min_bytes: int) -> DataFrame:
    """(payload_digest, salt, first): the smallest key of each digest that repeats. It is found by partial aggregation over salts, and each
    salt's row carries it back, so a popular body is as many keys of the join as it has salts."""
    large = rows.where(F.col("payload_bytes") >= min_bytes)
    parts = large.groupBy("payload_digest", "salt").agg(F.min("key_value").alias("least"), F.count("*").alias("n"))
    whole = parts.groupBy("payload_digest").agg(F.min("least").alias("first"), F.sum("n").alias("n")).where("n > 1").drop("n")
    return cut(parts.select("payload_digest", "salt").join(whole, "payload_digest").withColumn("repeats", F.lit(True)), "warc-firsts")


def _named(rows: DataFrame, known: DataFrame, n_archives: int) -> DataFrame:
    """What the records will be, and their place among equal ones; no body is moved for it."""
    same = Window.partitionBy("archive", "key_value", "payload_digest").orderBy("url")
    opens = F.col("repeats").isNull() | (F.col("key_value").eqNullSafe(F.col("first")) & (F.col("at") == 1))
    return (
        rows.join(known, ["payload_digest", "salt"], "left")
        .repartitionById(n_archives, F.col("archive"))
        .withColumn("at", F.row_number().over(same))
        .withColumn("record_type", F.when(opens, "response").otherwise("revisit"))
        .withColumn("key", F.coalesce(F.col("key_value").cast("string"), F.lit("null")))
        .withColumn("refers_to", F.when(~opens, F.coalesce(F.col("first").cast("string"), F.lit("null"))))
        .select("key_value", "key", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", F.col("at").alias("place"))
    )


def write(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", min_revisit_bytes: int = MIN_REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> tuple[str, DataFrame]:
    """Writes archives into the shared folder. Returns their path and the index (one row a record).

    Bodies are shuffled once, to their archives.
    """
    spark = bound_batches(pages.sparkSession)
    text = F.coalesce(F.col(body), F.lit(""))
    n_records, n_bytes = pages.select(F.octet_length(text).alias("n")).agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_archives = max(1, -(-n_bytes // archive_bytes), min(n_records // LEAST_RECORDS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = pages.select(
        F.col(key).alias("key_value"),
        F.col(url).cast("string").alias("url"),
        F.octet_length(text).cast("long").alias("payload_bytes"),
        F.sha2(text, 256).alias("payload_digest"),
        text.alias("body"),
    ).withColumn("archive", F.pmod(F.xxhash64("payload_digest", "key_value"), F.lit(n_archives)).cast("int"))
    salt = F.pmod(F.xxhash64("key_value", F.lit(7)), F.lit(SALTS))
    salted = rows.withColumn("salt", salt)
    known = _firsts(salted.drop("body"), min_revisit_bytes)
    named = cut(_named(salted.drop("body"), known, n_archives), "warc-records")
    # What is known of the records travels with the bodies instead of being joined to them: so one
    # shuffle by archive serves the lookup, the order of the records and the files.
    bodies = rows.select("archive", "key_value", "payload_digest", "body")
    repeated = known.select("payload_digest", "first").distinct().limit(BROADCAST_ROWS + 1)
    if repeated.count() <= BROADCAST_ROWS:  # short enough to tell before the shuffle which bodies no record will hold
        again = F.col("_digest").isNotNull() & ~F.col("key_value").eqNullSafe(F.col("first"))
        met = bodies.join(F.broadcast(repeated.withColumnRenamed("payload_digest", "_digest")), F.col("payload_digest") == F.col("_digest"), "left")
        bodies = met.where(~again).select("archive", "key_value", "payload_digest", "body")
    same = Window.partitionBy("archive", "key_value", "payload_digest").orderBy(F.col("place").asc_nulls_first())
    records = (
        named.unionByName(bodies, allowMissingColumns=True)
        .repartitionById(n_archives, F.col("archive"))
        .withColumn("body", F.coalesce(F.first("body").over(same), F.lit("")))
        .where(F.col("place").isNotNull())
        .sortWithinPartitions("archive", "key_value", "payload_digest", "place")
        .select("archive", "key", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", F.concat(_head(), F.when(F.col("record_type") == "response", F.col("body")).otherwise(""), F.lit(END)).alias("record"))
    )
    fields = ["archive", "key", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    path = new_path(spark, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A file's name holds the task attempt: what a lost attempt left behind is in no index.
        store, folder = pyarrow.fs.FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        open_for, out, offset = None, None, 0
        for batch in batches:
            files, offsets, lengths = [], [], []
            for archive, record in zip(batch.column("archive").to_pylist(), batch.column("record").to_pylist(), strict=True):
                if archive != open_for:
                    if out:
                        out.close()
                    open_for, offset = archive, 0
                    out = store.open_output_stream(f"{folder}/{archive:08d}-{attempt}.warc.gz", compression=None)
                member = gzip.compress(record.encode(), LEVEL, mtime=0)
                out.write(member)
                files.append(f"{archive:08d}-{attempt}.warc.gz")
                offsets.append(offset)
                lengths.append(len(member))
                offset += len(member)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in fields), pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], names=[*fields, "file", "offset", "length"])
        if out:
            out.close()

    return path, cut(records.mapInArrow(run, f"archive int, {_ENTRY}, file string, offset long, length long").drop("archive"), "warc-index")


def ranges(index: DataFrame, gap: int = GAP, most: int = READ) -> DataFrame:
    """(file, start, stop, records) byte ranges that hold the index rows; records: (offset, length) in order."""
    order = Window.partitionBy("file").orderBy("offset")
    breaks = (F.col("offset") - F.lag(F.col("offset") + F.col("length"), 1, 0).over(order) > gap) | (F.floor(F.col("offset") / most) != F.floor(F.lag("offset", 1, 0).over(order) / most))
    return (
        index.select("file", "offset", "length", breaks.cast("long").alias("opens"))
        .withColumn("range", F.sum("opens").over(order))
        .groupBy("file", "range")
        .agg(F.min("offset").alias("start"), F.max(F.col("offset") + F.col("length")).alias("stop"), F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("records"))
        .drop("range")
    )


def parse(record: bytes) -> dict:
    """The fields of one record; the payload's size and digest are those of its bytes, or as a revisit states them."""
    head, _, block = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("the index names a position that no record starts at")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
    stated = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "revisit":
        digest, size = stated, int(re.search(rb"Content-Length: (\d+)", http)[1])
    elif digest != stated:
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload does not have its digest")
    name = lambda field: fields[field].removeprefix("<urn:page:").removesuffix(">") if field in fields else None
    return {"key": name("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "payload": payload, "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": name("WARC-Refers-To")}


def read(path: str, index: DataFrame, payload: bool = False) -> DataFrame:
    """Reads the records that the index rows name. key, url, payload_bytes, payload_digest, record_type, refers_to;
    payload: with the bytes too."""
    bound_batches(index.sparkSession)
    tasks = -(-(index.agg(F.sum("length")).first()[0] or 0) // TASK)
    # a stated number of partitions: the rows are small, what they stand for is not
    wanted = ranges(index).repartition(max(1, tasks, int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "file", "start")
    fields = ["key", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = pyarrow.fs.FileSystem.from_uri(path)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{folder}/{row['file']}") as f:
                    data = f.read_at(row["stop"] - row["start"], row["start"])
                cut_out = (data[r["offset"] - row["start"] : r["offset"] - row["start"] + r["length"]] for r in row["records"])
                found = [parse(gzip.decompress(x)) for x in cut_out]
                table = pa.table({c: [x[c] for x in found] for c in [*fields, *["payload"] * payload]}, schema=schema)
                yield from table.to_batches()

    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
    schema = pa.schema(list(zip([*fields, *["payload"] * payload], kinds, strict=False)))
    return wanted.mapInArrow(run, _ENTRY + ", payload binary" * payload)
