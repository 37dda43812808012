"""WARC archives: a writer with revisit records and a reader that salvages damaged files."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.llm.common import fresh_path, join_summary, slices, written

RECORD_SCHEMA = (
    "path string, start long, length long, kind string, warc_type string, record_id string,"
    " target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary,"
    " reason string"
)
GZIP = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
ID_PREFIX = "urn:clearwell:"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def encode_record(headers: dict[str, str | int | None], block: bytes) -> bytes:
    lines = ["WARC/1.1"] + [f"{k}: {v}" for k, v in headers.items() if v is not None]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 1) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def parse_record(data: bytes) -> tuple[dict[str, str], bytes, int] | None:
    """Headers (lower-case names), block and length of the record at the start, if whole."""
    if not data.startswith(VERSION):
        return None
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    headers: dict[str, str] = {}
    for line in data[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        headers[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    size = headers.get("content-length", "")
    if not size.isdigit():
        return None
    start, stop = end + 4, end + 4 + int(size)
    if data[stop : stop + 4] != b"\r\n\r\n":
        return None
    return headers, data[start:stop], stop + 4


def _check(headers: dict[str, str], block: bytes) -> str | None:
    """Why the record is not to be trusted, or None."""
    want = headers.get("warc-block-digest", "")
    if want.startswith("sha1:") and want[5:] != payload_digest(block):
        return "block digest differs"
    return None


class _Window:
    """Bytes of a stream from ``pos`` on, read as far as needed."""

    def __init__(self, stream, step: int = 1 << 16) -> None:
        self.stream, self.step, self.buf, self.pos, self.ended = stream, step, b"", 0, False
        self.failed, self.failed_at = "", 0

    def more(self) -> bool:
        got = b"" if self.ended else self.stream.read(max(self.step, len(self.buf)))
        self.ended = self.ended or not got
        self.buf += got
        return bool(got)

    def skip(self, n: int) -> None:
        self.buf, self.pos = self.buf[n:], self.pos + n


class _Inflated:
    """What a gzip member at a window's start holds, as a stream.

    The window keeps the compressed bytes until `settle` lets them go, so that a reader
    can go back to them.  ``failed`` says why the member broke off, if it did.
    """

    def __init__(self, window: _Window) -> None:
        self.window, self.unpack = window, zlib.decompressobj(31)
        self.fed = self.last = 0  # bytes of the window unpacked so far, and before the last step
        self.step = 1 << 12
        self.rest, self.failed = b"", ""
        self.before, self.given = self.unpack, 0  # state before the last step, bytes given since

    def read(self, n: int) -> bytes:
        while not self.failed and not self.unpack.eof:
            if not self.rest:
                if self.fed == len(self.window.buf) and not self.window.more():
                    self.failed = "gzip: ends early"
                    break
                self.before, self.given, self.last = self.unpack.copy(), 0, self.fed
                self.rest = self.window.buf[self.fed : self.fed + self.step]
                self.fed += len(self.rest)
                self.step = min(2 * self.step, self.window.step)
            try:
                got = self.unpack.decompress(self.rest, n)
            except zlib.error as e:
                self.failed = f"gzip: {e}"[:80]
                return self._until_failure()
            self.rest = self.unpack.unconsumed_tail
            if self.unpack.eof:
                self.fed -= len(self.unpack.unused_data)
            if got:
                self.given += len(got)
                return got
        return b""

    def _until_failure(self) -> bytes:
        """What the last step holds before the place where it fails."""
        out = []
        try:
            for at in range(self.last, self.fed):
                out.append(self.before.decompress(self.window.buf[at : at + 1]))
        except zlib.error:
            pass
        return b"".join(out)[self.given :]

    def settle(self) -> None:
        self.window.skip(self.last)
        self.fed, self.last = self.fed - self.last, 0


def _incomplete(data: bytes) -> bool:
    """Whether more bytes could make the plain record at the start whole."""
    end = data.find(b"\r\n\r\n")
    lines = data[: end if end >= 0 else data.rfind(b"\r\n") + 1 or None].split(b"\r\n")
    whole = lines if end >= 0 else lines[:-1]
    if any(b":" not in line for line in whole[1:]):
        return False
    if end < 0:
        return True
    for line in lines:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return len(data) < end + 4 + int(value) + 4
    return False


def _plain(window: _Window) -> tuple[dict[str, str], bytes, int] | str:
    """The record at the window's start with its length, or why there is none."""
    while True:
        record = parse_record(window.buf)
        if record is not None:
            return _check(record[0], record[1]) or record
        if not _incomplete(window.buf) or not window.more():
            return "no whole record"


def _of_member(window: _Window) -> Iterator[tuple]:
    """Records and inner gaps of the gzip member at the window's start; goes past what was read."""
    start, member, held, records, told = window.pos, _Inflated(window), [], 0, False
    for item in salvage(member):
        if len(item) == 4:
            records += 1
            member.settle()
        if records and (records > 1 or len(item) == 3):
            yield from held
            told, held = told or bool(held), []
        held.append((start, *item[1:]))
    window.failed = member.failed or ("" if records else "member holds no whole record")
    if not records:
        window.failed_at = start
        window.skip(1)
    elif member.failed:
        # what it breaks off in is part of the gap that begins here
        yield from (x for x in held if len(x) == 4)
        window.failed_at = window.pos
        window.skip(max(1, member.last))
    else:
        if records == 1 and not told and len(held) == 1:
            held = [(start, window.pos + member.fed - start, *held[0][2:])]
        yield from held
        window.skip(member.fed)


def _of_file(window: _Window) -> Iterator[tuple]:
    """The plain record at the window's start, if it is whole and valid."""
    got: tuple | str = "no record"
    if window.buf.startswith(VERSION):
        got = _plain(window)
    if isinstance(got, str):
        window.failed, window.failed_at = got, window.pos
        window.skip(1)
        return
    yield window.pos, got[2], got[0], got[1]
    window.failed = ""
    window.skip(got[2])


def salvage(stream) -> Iterator[tuple[int, int, dict[str, str], bytes] | tuple[int, int, str]]:
    """Records of an archive (start, length, headers, block) and gaps (start, length, reason).

    After a failed check the reader looks for the next place where a gzip member or a
    version line starts a whole, valid record, goes on from there and reports the
    bytes between as one gap.  A member may hold several records, and damaged stretches
    between them: it is unpacked step by step and read in the same way.  The only record
    of a member has the member's place and length; others, and gaps within a member, have
    the member's start and their own length.  What a member that breaks off held before
    is kept.

    Works over a sliding window: memory is bounded by the largest record, or the
    largest that a header claims.
    """
    window, gap, why = _Window(stream), None, ""
    while window.buf or window.more():
        while len(window.buf) < len(VERSION) and window.more():
            pass
        start = window.pos
        for item in _of_member(window) if window.buf.startswith(GZIP) else _of_file(window):
            if gap is not None:
                yield gap, start - gap, why
                gap = None
            yield item
        if not window.failed:
            continue
        if gap is None:
            gap, why = window.failed_at, window.failed
        while True:
            starts = [i for i in (window.buf.find(GZIP), window.buf.find(VERSION)) if i >= 0]
            if starts:
                window.skip(min(starts))
                break
            window.skip(max(0, len(window.buf) - len(VERSION) + 1))
            if not window.more():
                window.skip(len(window.buf))
                break
    if gap is not None:
        yield gap, window.pos - gap, why


def _open(uri: str):
    where, path = arrow_fs.FileSystem.from_uri(uri)
    return where, path


def write_warc(
    rows: DataFrame, folder: str, archive_bytes: int = 64 << 20, level: int = 1
) -> DataFrame:
    """Write one record a row into gzip archives (a member a record) in a shared folder.

    Input columns: ``record_id, target_uri, warc_type, refers_to, payload_digest,
    payload_bytes, payload`` (binary).  A revisit's block is empty; its headers carry
    digest and length of the full payload.  Returns the manifest (``path``,
    ``records``, ``bytes``), itself a table in the shared folder: a task that runs
    again writes new files, and only those of the attempt that Spark kept are listed.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = _open(folder)
        where.create_dir(base, recursive=True)
        out, name, size, count, done = None, "", 0, 0, []
        for batch in slices(batches):
            for r in batch.to_pylist():
                if out is None:
                    name, size, count = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = where.open_output_stream(f"{base}/{name}", compression=None)
                revisit = r["warc_type"] == "revisit"
                block = b"" if revisit else r["payload"]
                headers = {
                    "WARC-Type": r["warc_type"],
                    "WARC-Record-ID": f"<{r['record_id']}>",
                    "WARC-Target-URI": _header(r["target_uri"]),
                    "WARC-Date": "1970-01-01T00:00:00Z",
                    "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                    if revisit
                    else None,
                    "WARC-Refers-To": f"<{r['refers_to']}>" if revisit else None,
                    "WARC-Payload-Digest": f"sha1:{r['payload_digest']}",
                    "WARC-Block-Digest": f"sha1:{payload_digest(block)}",
                    "X-Payload-Length": r["payload_bytes"],
                }
                member = gzip_member(encode_record(headers, block), level)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= archive_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", count, size))
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("path", "records", "bytes"), x, strict=True)) for x in done],
            pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
        )

    return written(rows.mapInArrow(write, "path string, records long, bytes long"), "warc-manifest")


def _header(value: str | None) -> str | None:
    return None if value is None else " ".join(value.split())


def read_warc(files: DataFrame, keep_payload: bool = True) -> DataFrame:
    """Records and gaps of the archives named in ``path``, one row each (`RECORD_SCHEMA`).

    ``kind`` is record or gap.  Payload length and digest are taken from the payload
    itself, those of revisits from their headers.  Each archive is streamed once by
    one task; archives have a size bound when `write_warc` made them.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("path", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("kind", pa.string()),
                ("warc_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
                ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                ("payload", pa.binary()), ("reason", pa.string()),
            ]
        )
        held, weight = [], 0
        for batch in slices(batches):
            for path in batch.column("path").to_pylist():
                where, inner = _open(path)
                with where.open_input_stream(inner, compression=None) as stream:
                    for item in salvage(stream):
                        row = {"path": path, "start": item[0], "length": item[1]}
                        if len(item) == 3:
                            held.append(row | {"kind": "gap", "reason": item[2]})
                        else:
                            held.append(row | _fields(item[2], item[3], keep_payload))
                            weight += len(item[3]) if keep_payload else 0
                        if weight > 8 << 20 or len(held) >= 10_000:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, weight = [], 0
        yield pa.RecordBatch.from_pylist(held, schema)

    # by number, so that Spark does not put the short list of paths into one task
    paths = files.select("path")
    tasks = min(max(1, paths.count()), 10_000)
    return paths.repartition(tasks, "path").mapInArrow(read, RECORD_SCHEMA)


def _fields(headers: dict[str, str], block: bytes, keep_payload: bool) -> dict:
    revisit = headers.get("warc-type") == "revisit"
    told = headers.get("x-payload-length", "")
    return {
        "kind": "record",
        "warc_type": headers.get("warc-type"),
        "record_id": headers.get("warc-record-id", "").strip("<>") or None,
        "target_uri": headers.get("warc-target-uri"),
        "refers_to": headers.get("warc-refers-to", "").strip("<>") or None,
        "payload_digest": headers.get("warc-payload-digest", "").removeprefix("sha1:")
        if revisit
        else payload_digest(block),
        "payload_bytes": (int(told) if told.isdigit() else None) if revisit else len(block),
        "payload": block if keep_payload and not revisit else None,
    }


def archive_pages(
    pages: DataFrame, folder: str, least_bytes: int = 0,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """Write every page as a WARC record; equal payloads become revisits.  Returns the manifest.

    The page with the largest id is the response of its payload and the others refer
    to it; payloads under ``least_bytes`` are all responses.  A null html is an empty
    payload.  A null id sorts before all others, so it is a response only if no page
    with an id has its payload.  Rows that repeat an id and its payload get one
    verdict.  Other columns are ignored; an empty table gives no archive.
    """
    html = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = written(
        pages.select(
            F.col(id_col).alias("id"),
            F.col(url_col).alias("target_uri"),
            F.sha1(html).alias("sha"),
            F.octet_length(html).cast("long").alias("payload_bytes"),
        ),
        "warc-rows",
    )
    largest = rows.groupBy("sha").agg(F.max("id").alias("first_id"))
    revisit = (F.col("payload_bytes") >= least_bytes) & ~F.col("id").eqNullSafe(F.col("first_id"))
    judged = join_summary(rows, "sha", largest).withColumn("_revisit", revisit)
    # one payload a digest and map task goes on, to the responses alone
    payloads = pages.select(F.sha1(html).alias("sha"), html.alias("payload")).groupBy("sha").agg(F.first("payload").alias("payload"))
    responses = judged.where("NOT _revisit").join(payloads, "sha")
    both = judged.where("_revisit").withColumn("payload", F.lit(None).cast("binary")).unionByName(responses)
    return write_warc(
        both.select(
            F.concat(F.lit(ID_PREFIX), F.coalesce(F.col("id").cast("string"), F.lit(""))).alias("record_id"),
            "target_uri",
            F.when(F.col("_revisit"), "revisit").otherwise("response").alias("warc_type"),
            F.when(F.col("_revisit"), F.concat(F.lit(ID_PREFIX), F.col("first_id").cast("string"))).alias("refers_to"),
            base32(F.col("sha")).alias("payload_digest"),
            "payload_bytes",
            "payload",
        ),
        folder,
    )


def base32(hex_digest):
    """A hex digest of a multiple of 40 bits in base32."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    groups = F.transform(
        F.sequence(F.lit(0), (F.length(hex_digest) / 5 - 1).cast("int")),
        lambda i: F.conv(hex_digest.substr(i * 5 + 1, F.lit(5)), 16, 10).cast("int"),
    )
    letters = F.transform(
        groups,
        lambda g: F.concat(
            *[
                F.substring(alphabet, F.shiftright(g, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1))
                for shift in (15, 10, 5, 0)
            ]
        ),
    )
    return F.array_join(letters, "")


class DamagedArchive(RuntimeError):
    """Fewer records came back than were written; the table at ``gaps`` lists what was quarantined."""

    def __init__(self, written_records: int, read_records: int, gaps: str) -> None:
        super().__init__(f"{read_records} of {written_records} records read back; gaps are listed in {gaps}")
        self.gaps = gaps


def read_back(spark: SparkSession, manifest: DataFrame, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(records, gaps) of the archives of a manifest, without payloads.

    Both are written once; gaps have ``path``, ``start``, ``length``, ``reason``.  With
    ``strict`` it is an error if the records are not as many as the manifest says.
    """
    path = fresh_path(spark, "warc-read")
    read_warc(manifest, keep_payload=False).drop("payload").write.partitionBy("kind").parquet(path)
    # read as declared, since either kind may have no rows
    stored = spark.read.schema(RECORD_SCHEMA.replace(" payload binary,", "")).parquet(path)
    gaps = stored.where("kind = 'gap'").select("path", "start", "length", "reason")
    records = stored.where("kind = 'record'")
    want = manifest.agg(F.sum("records").alias("n")).head()["n"] or 0
    got = records.count()
    if strict and got != want:
        raise DamagedArchive(want, got, f"{path}/kind=gap")
    return records, gaps


def pages_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archive the pages in the shared folder and read the archives back.

    A page that does not come back is an error (`read_back`), whose message names the
    table of gaps.
    """
    records, _ = read_back(spark, archive_pages(pages, fresh_path(spark, "warc")))

    def page(c: str):
        # a page without an id has nothing after the prefix
        return F.substring(F.col(c), len(ID_PREFIX) + 1, 40).try_cast("long")

    return records.select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("warc_type").alias("record_type"),
        page("refers_to").alias("refers_to"),
        "target_uri",
    )
