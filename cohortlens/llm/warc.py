"""WARC archives: writing, normalising monolithic gzip, reading back by offset.

``write_archives`` writes one gzip stream per archive, as many tools do: a reader
must inflate it from the start to reach a record. ``normalise`` inflates each such
stream once and rewrites every record as its own gzip member, with a sidecar file
of offsets beside the archive. ``read_back`` fetches records by those offsets.

Records with equal payloads are written once: the least page_id is the response,
the others are revisits that name it and keep its HTTP headers, not its payload.

Defined results: a NULL html counts as empty; a NULL url is left out; rows with the
same page_id and payload are all responses if theirs is the least page_id, a NULL
page_id is never the least unless there is no other; an empty table gives an empty
result; other columns are dropped. Blocks are copied in pieces, so a record of any
size fits; archives hold at most ``per_archive`` records. A task that runs again
writes the same bytes to the same place.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import text_or_empty
from cohortlens.llm.skew import lookup_join
from cohortlens.session import shared_folder
from cohortlens.sources.tables import written

# Fixed values of the format.
VERSION = "WARC/1.1"
GAP = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "1970-01-01T00:00:00Z"
PIECE = 1 << 20


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1, with built-in functions: 5 hex digits make 4 symbols."""
    digest, symbols = F.sha1(data), []
    for group in range(8):
        value = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1
            symbols.append(F.substring(F.lit(BASE32), at, F.lit(1)))
    return F.concat(*symbols)


def records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """One row per page: the text of its WARC record without the closing gap."""
    html = text_or_empty("html")
    pages = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"), F.octet_length(html).alias("size")
    ).withColumn("key", F.when(F.col("size") >= min_bytes, F.sha2("html", 256)))
    found = written(pages.filter("key IS NOT NULL").groupBy("key").agg(F.min("page_id").alias("least"), F.count("*").alias("n")))
    joined = lookup_join(pages, found, "key", "n")
    revisit = F.col("least").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("least"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"),
        F.lit(GAP),
    )
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("html")))
    clean_url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "_")
    record = F.concat(
        F.lit(VERSION + "\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", name(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", clean_url), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("html")))),
        F.when(revisit, line("WARC-Refers-To", name(F.col("least")))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )
    return joined.select(record.alias("value"))


def write_archives(record_rows: DataFrame, folder: str, per_archive: int = 20_000) -> None:
    """Monolithic archives: Spark's text writer with the records' gap as line separator."""
    writer = record_rows.write.option("lineSep", GAP).option("compression", "gzip")
    writer.option("maxRecordsPerFile", per_archive).text(folder)


def _headers(stream) -> tuple[bytes, dict[str, str]] | None:
    """The bytes of the next record's version line, fields and blank line, and the fields by
    their names in lower case; None at the end.

    A line that begins with white space goes on with the field before it; of a repeated
    field the first counts.
    """
    first = stream.readline()
    if not first:
        return None
    if not first.startswith(b"WARC/"):
        raise ValueError("no record where one should begin")
    lines, fields, name = [first], {}, None
    while line := stream.readline():
        lines.append(line)
        text = line.rstrip(b"\r\n").decode(errors="replace")
        if not text:
            return b"".join(lines), {k: " ".join(v) for k, v in fields.items()}
        key, colon, value = text.partition(":")
        if text[0] in " \t":
            if name:
                fields[name].append(text.strip())
        elif colon:
            name = key.strip().lower()
            if name in fields:
                name = None
            else:
                fields[name] = [value.strip()]
    raise ValueError("the archive ends within a record's fields")


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def _put(out, data: bytes) -> int:
    out.write(data)
    return len(data)


def normalise_one(source: str, target: str) -> tuple[int, int]:
    """Rewrites one archive and writes its sidecar; returns (records, bytes)."""
    store, path = _filesystem(source)
    out_store, out_path = _filesystem(target)
    count = offset = 0
    with store.open_input_stream(path, compression=None) as raw, out_store.open_output_stream(out_path, compression=None) as out:
        with out_store.open_output_stream(out_path + ".idx.json", compression=None) as index:
            stream = io.BufferedReader(gzip.GzipFile(fileobj=raw), PIECE)
            while (found := _headers(stream)) is not None:
                head, fields = found
                member = zlib.compressobj(6, zlib.DEFLATED, 31)
                size = _put(out, member.compress(head))
                left = int(fields["content-length"])
                while left:
                    piece = stream.read(min(left, PIECE))
                    if not piece:
                        raise ValueError("the archive ends within a record")
                    left -= len(piece)
                    size += _put(out, member.compress(piece))
                if stream.read(len(GAP)) != GAP.encode():
                    raise ValueError("a record is not closed")
                size += _put(out, member.compress(GAP.encode()) + member.flush())
                entry = {"archive": target, "offset": offset, "length": size, "record": fields["warc-record-id"]}
                index.write(json.dumps(entry).encode() + b"\n")
                offset += size
                count += 1
    return count, offset


INDEX = "archive string, offset long, length long, record string"


def normalise(spark: SparkSession, folder: str, target: str) -> DataFrame:
    """Normalises all archives of a folder, one task each; returns the offset index.

    Tasks reach the folders through Arrow's file systems (local, HDFS or object
    stores), as Spark itself has no writer for binary streams.
    """
    store, path = _filesystem(target)
    store.create_dir(path, recursive=True)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path")
    archives = files.count()
    tasks = files.repartition(max(archives, 1))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path in frame["path"]:
                name = re.sub(r"(\.txt)?\.gz$", "", path.rsplit("/", 1)[1])
                out = f"{target}/{name}.warc.gz"
                yield pd.DataFrame([(out, *normalise_one(path, out))], columns=["archive", "records", "bytes"])

    tasks.mapInPandas(run, "archive string, records long, bytes long").write.format("noop").mode("overwrite").save()
    if not archives:
        return spark.createDataFrame([], INDEX)
    return spark.read.schema(INDEX).option("pathGlobFilter", "*.idx.json").json(target)


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _page(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    return int(found[1]) if found else None


def read_record(data: bytes) -> tuple:
    """One member's record, its payload digest checked where it has the payload."""
    stream = io.BytesIO(gzip.decompress(data))
    _, fields = _headers(stream)
    head, _, payload = stream.read(int(fields["content-length"])).partition(GAP.encode())
    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", head)[1])
    kind = fields["warc-type"]
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        seen = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if seen != digest or len(payload) != size:
            raise ValueError(f"{fields['warc-record-id']}: payload and digest differ")
    return _page(fields["warc-record-id"]), size, digest, kind, _page(fields.get("warc-refers-to"))


def read_back(index: DataFrame, parts: int | None = None) -> DataFrame:
    """Fetches every record of the index by its offset.

    The index is small for the work it stands for: ``parts`` keeps its rows in that
    many tasks (default: the shuffle partitions).
    """
    parts = parts or int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = index.repartitionByRange(parts, "archive", "offset").sortWithinPartitions("archive", "offset")
    names = [c.split()[0] for c in READ.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened, file = None, None
        for frame in frames:
            out = []
            for archive, offset, length in zip(frame["archive"], frame["offset"], frame["length"], strict=True):
                if archive != opened:
                    store, path = _filesystem(archive)
                    opened, file = archive, store.open_input_file(path)
                file.seek(offset)
                out.append(read_record(file.read(length)))
            made = pd.DataFrame(out, columns=names)
            yield made.astype({"page_id": "Int64", "refers_to": "Int64"})

    return dealt.mapInPandas(run, READ)


def store_and_read(pages: DataFrame, min_bytes: int = 0, per_archive: int = 20_000) -> DataFrame:
    """Writes the pages, normalises the archives and reads every record back."""
    spark = pages.sparkSession
    folder = shared_folder(spark)
    write_archives(records(pages, min_bytes), f"{folder}/monolithic", per_archive)
    return read_back(normalise(spark, f"{folder}/monolithic", f"{folder}/normalised"))
