"""Web archives: legacy ARC files to WARC files, and readers and writers of both.

An ARC file begins with a version block that says which fields the header line of
each record has; the last field is the length of what follows. Conversion reads
header lines by their version and bodies by their declared lengths, and makes up
what a WARC record needs besides: identifier, timestamp, type and digests.
Of records with equal payloads the newest stays a response and the others revisit it.

Files are written and read by Spark's text source, in bytes, with the separator that
ends a record of the format, so they can lie in any store, a lost task is
written again, and gzip keeps a file in one task. A reader takes pieces
between separators as a stream and joins as many as a record's length asks for.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stemma.llm.common import arrow_of, batch_of, letting_go, small_batches
from stemma.session import write_out

#: Fixed values of the ARC format: the fields of a header line by major version.
FIELDS = {
    1: ("url", "ip", "date", "mime", "length"),
    2: ("url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length"),
}
#: Fixed values of the WARC format.
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
ARC_END, WARC_END = b"\n", b"\r\n\r\n"
#: How files are compressed: quickly, for a level more costs far more time than it saves room.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
#: Digests whose records are at least this share of all are joined without a shuffle; there are at most as many as the inverse says.
SHARE = 1000
#: The name space of identifiers made up from a file's path and a record's place in it.
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_UNSAFE = re.compile(rb"[\x00-\x20\x7f]")
_URL = re.compile(rb"[A-Za-z][A-Za-z0-9+.-]*:\S*\Z")
_OUT_BYTES = 4 << 20


def digest_of(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def timestamp(date: bytes) -> str | None:
    """The WARC form of an ARC date of 4 to 14 digits; what is missing is the earliest. None for no date."""
    if not re.fullmatch(rb"\d{4}(\d\d){0,5}", date):
        return None
    digits = date.decode() + "00000101000000"[len(date) :]
    try:
        return datetime.datetime.strptime(digits, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ").rjust(20, "0")
    except ValueError:
        return None


# ---------------------------------------------------------------- ARC files


def version_block(name: str, version: int, date: str) -> bytes:
    """The first record of an ARC file."""
    body = f"{version} {1 if version == 1 else 0} stemma\n{' '.join(_TITLES[f] for f in FIELDS[version])}\n"
    head = {"url": f"filedesc://{name}", "ip": "0.0.0.0", "date": date, "mime": "text/plain", "status": "200", "checksum": "-", "location": "-", "offset": "0", "filename": name, "length": str(len(body))}
    return f"{' '.join(head[f] for f in FIELDS[version])}\n{body}".encode()


#: The names that version blocks give to the fields.
_TITLES = {"url": "URL", "ip": "IP-address", "date": "Archive-date", "mime": "Content-type", "status": "Result-code", "checksum": "Checksum", "location": "Location", "offset": "Offset", "filename": "Filename", "length": "Archive-length"}


def _field(value: bytes | None, empty: bytes = b"-") -> bytes:
    """A value as a field: blanks and control bytes are escaped, nothing is a dash."""
    return _UNSAFE.sub(lambda m: b"%%%02X" % m[0][0], value) if value else empty


def http_response(payload: bytes, key: str | None) -> bytes:
    """A payload as the response of a server; ``key`` says which page it is."""
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\nX-Page-Key: %b\r\n\r\n%b" % (len(payload), (key or "").encode(), payload)


def write_arc(pages: DataFrame, path: str, date: str = "20000101000000", versions: tuple[int, ...] = (1, 2)) -> None:
    """ARC files of ``pages(key, url, payload)`` below ``path``, one for each task; versions take turns by task.

    Null payloads are empty, a null or empty url is ``about:blank``, a null key has no value.
    """
    small_batches(pages.sparkSession)
    schema = arrow_of("value binary")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letting_go()
        part = TaskContext.get().partitionId()
        version, name = versions[part % len(versions)], f"part-{part:05d}.arc"
        first = version_block(name, version, date)
        offset, out, size = len(first) + 1, [first], 0
        for batch in batches:
            for key, url, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                body = http_response(payload or b"", key)
                field = {"url": _field(url and url.encode(), b"about:blank"), "ip": b"0.0.0.0", "date": date.encode(), "mime": b"text/html", "status": b"200", "checksum": hashlib.md5(body).hexdigest().encode(), "location": b"-", "offset": b"%d" % offset, "filename": name.encode(), "length": b"%d" % len(body)}
                out.append(b" ".join(field[f] for f in FIELDS[version]) + b"\n" + body)
                offset += len(out[-1]) + 1
                size += len(out[-1])
                if size > _OUT_BYTES:
                    yield batch_of(schema, out)
                    out, size = [], 0
        if out:
            yield batch_of(schema, out)

    rows = pages.select(F.col("key").cast("string"), F.col("url").cast("string"), F.col("payload").cast("binary")).mapInArrow(run, "value binary")
    rows.select(F.col("value").cast("string")).write.option("lineSep", ARC_END.decode()).options(**GZIP).text(path)


# ---------------------------------------------------------------- reading records by declared lengths


class Assembler:
    """Makes records of a file's pieces, which were cut at ``end``.

    ``head`` reads a piece as a record's head and says how many bytes follow it, or None
    for a piece that is none; such pieces are passed over. A record is given with its head, its place
    in the file, its body and whether the body is whole.
    """

    def __init__(self, end: bytes, head: Callable[[bytes], tuple[object, int] | None]) -> None:
        self.end, self.head = end, head
        self.open, self.need, self.parts, self.got, self.place = None, 0, [], 0, 0

    def piece(self, piece: bytes) -> Iterator[tuple[object, int, bytes, bool]]:
        if self.open is None:
            found = self.head(piece)
            if found is not None:
                self.open, self.need = found
                self.parts, self.got = [], -len(self.end)
            return
        self.parts.append(piece)
        self.got += len(piece) + len(self.end)
        if self.got >= self.need:
            body = self.end.join(self.parts)
            rest = body[self.need :]
            yield self._given(body[: self.need], True)
            if rest:  # no separator after the body: what follows may be the next head
                yield from self.piece(rest)

    def _given(self, body: bytes, whole: bool) -> tuple[object, int, bytes, bool]:
        found = (self.open, self.place, body, whole)
        self.open, self.parts = None, []
        self.place += 1
        return found

    def over(self) -> Iterator[tuple[object, int, bytes, bool]]:
        """The record that the file's end cuts off."""
        if self.open is not None:
            yield self._given(self.end.join(self.parts), False)


def _records(batches: Iterable[pa.RecordBatch], end: bytes, reader: Callable[[], Callable]) -> Iterator[tuple[str, object, int, bytes, bool]]:
    """``file, head, place, body, whole`` of the records of all files that a task reads; ``reader`` begins a file."""
    now, assembler = None, None
    for batch in batches:
        files, values = (c.to_pylist() for c in batch.columns)
        for file, value in zip(files, values, strict=True):
            if file != now:
                if assembler:
                    yield from ((now, *r) for r in assembler.over())
                now, assembler = file, Assembler(end, reader())
            for record in assembler.piece(value):
                yield (now, *record)
    if assembler:
        yield from ((now, *r) for r in assembler.over())


def _pieces(spark: SparkSession, path: str, end: bytes) -> DataFrame:
    """``file, value`` of the pieces of gzip files below ``path``; a file is never split (others would be, so they must be compressed)."""
    small_batches(spark)
    rows = spark.read.option("lineSep", end.decode()).text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))


class ArcHeads:
    """Reads header lines of one ARC file by the version that its first record names."""

    def __init__(self) -> None:
        self.fields = FIELDS[1]

    def __call__(self, line: bytes) -> tuple[dict[str, bytes], int] | None:
        line = line.rstrip(b"\r")
        # the version block's own line may have either number of fields, and its version isn't read yet
        kinds = [FIELDS[2], FIELDS[1]] if line.startswith(b"filedesc:") else [self.fields]
        for fields in kinds:
            values = line.rsplit(b" ", len(fields) - 1)
            if len(values) == len(fields) and values[-1].isdigit() and _URL.match(values[0].replace(b" ", b"%20")) and (timestamp(values[2]) or len(kinds) > 1):
                return dict(zip(fields, values, strict=True)), int(values[-1])
        return None

    def version(self, body: bytes) -> None:
        """Take the version from a version block's body."""
        major = body.split(None, 1)[:1]
        self.fields = FIELDS[2] if major == [b"2"] else FIELDS[1]


_PARSED = "record_id string, kind string, url string, date string, ip string, mime string, http binary, payload binary, digest string, key string, whole boolean"


def _split_http(body: bytes) -> tuple[bytes, bytes]:
    """Head, with the empty line that ends it, and payload of a server's response."""
    at = body.find(b"\r\n\r\n")
    return (body, b"") if at < 0 else (body[: at + 4], body[at + 4 :])


def http_field(head: bytes, name: str) -> str | None:
    for line in head.split(b"\r\n")[1:]:
        title, _, value = line.partition(b":")
        if title.strip().lower() == name.lower().encode():
            return value.strip().decode("utf-8", "replace")
    return None


def read_arc(spark: SparkSession, path: str, key: str = "X-Page-Key") -> DataFrame:
    """Records of all ARC files below ``path``, in the columns that WARC records need.

    ``kind`` is ``warcinfo`` for a version block, ``response`` for what a server
    said by http (its head and its ``payload`` apart) or a name server's answer, ``resource`` for all else. ``record_id`` is made
    up from the file's path and the record's place, so it stays the same when a task is
    run again. ``date`` falls back to that of the version block. ``key`` is the http field of that name, null without a value.
    A record that the file's end cuts off is not ``whole``; lines that are no header line of the file's version are passed over.
    """
    schema = arrow_of(_PARSED)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letting_go()
        heads: list[ArcHeads] = []
        out, size, began = [], 0, "1970-01-01T00:00:00Z"

        def fresh() -> ArcHeads:
            heads.append(ArcHeads())
            del heads[:-1]
            return heads[0]

        for file, head, place, body, whole in _records(batches, ARC_END, fresh):
            http = b""
            if head["url"].startswith(b"filedesc:"):
                kind, payload = "warcinfo", body
                heads[0].version(body)
                began = timestamp(head["date"]) or "1970-01-01T00:00:00Z"
            elif re.match(rb"HTTP/\d", body):
                kind = "response"
                http, payload = _split_http(body)
            else:
                kind, payload = ("response" if head["url"].startswith(b"dns:") else "resource"), body
            text = {n: head[n].decode("utf-8", "replace") for n in ("url", "ip", "mime")}
            name = f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{file}#{place}')}>"
            out.append((name, kind, text["url"], timestamp(head["date"]) or began, text["ip"], text["mime"], http, payload, digest_of(payload), http_field(http, key) or None, whole))
            size += len(body)
            if size > _OUT_BYTES:
                yield batch_of(schema, *zip(*out, strict=True))
                out, size = [], 0
        if out:
            yield batch_of(schema, *zip(*out, strict=True))

    return _pieces(spark, path, ARC_END).mapInArrow(run, _PARSED)


# ---------------------------------------------------------------- revisits and WARC files


def join_by_share(rows: DataFrame, facts: DataFrame, key: str, row_key: str, share: int = SHARE) -> DataFrame:
    """``rows`` with the other columns of ``facts(key, n, …)``, null where there is none.

    ``n`` says how many rows a key has. Keys with one row in ``share`` or more, of which
    there are at most ``share``, are broadcast; all others are joined by a shuffle, in which a key
    is small. ``row_key`` tells rows apart and deals out those that need no join.
    """
    more = [c for c in facts.columns if c not in (key, "n")]
    facts = write_out(facts, "facts")  # once; its size then tells Spark whether the shuffle can be left out
    total = facts.agg(F.sum("n")).first()[0] or 0
    heavy = facts.where(F.col("n") * share >= total).select(F.col(key).alias("_heavy"), *(F.col(c).alias(f"_heavy_{c}") for c in more))
    light = facts.where(F.col("n") * share < total).select(F.col(key).alias("_light"), *(F.col(c).alias(f"_light_{c}") for c in more))
    first = rows.join(F.broadcast(heavy), rows[key] == F.col("_heavy"), "left")
    first = first.withColumn("_by", F.when(F.col("_heavy").isNull() & F.col(key).isNotNull(), F.col(key)).otherwise(F.concat(F.lit("~"), F.col(row_key))))
    both = first.join(light, F.col("_by") == F.col("_light"), "left")
    return both.select(*rows.columns, *(F.coalesce(f"_heavy_{c}", f"_light_{c}").alias(c) for c in more))


def revisits(records: DataFrame, least: int = 0) -> DataFrame:
    """``records`` with ``refers_to``, ``refers_url`` and ``refers_date`` of the newest record of the same payload, null for that record itself.

    Only responses by http that are whole and whose payload has at least ``least`` bytes take
    part. The newest has the largest ``order``; nulls are the least, ties go to the largest ``record_id``.
    """
    takes_part = (F.col("kind") == "response") & (F.length("http") > 0) & F.col("whole") & (F.length("payload") >= least)
    keyed = records.withColumn("_digest", F.when(takes_part, F.col("digest")))
    newest = F.max(F.struct("order", "record_id", "url", "date"))
    facts = keyed.where("_digest is not null").groupBy("_digest").agg(F.count(F.lit(1)).alias("n"), newest.alias("_newest")).where("n > 1")
    joined = join_by_share(keyed, facts, "_digest", "record_id")
    other = F.col("_newest.record_id") != F.col("record_id")
    return joined.select(*records.columns, *(F.when(other, F.col(f"_newest.{a}")).alias(b) for a, b in (("record_id", "refers_to"), ("url", "refers_url"), ("date", "refers_date"))))


def write_warc(records: DataFrame, path: str) -> None:
    """WARC/1.0 files of ``revisits``' rows below ``path``, gzip-compressed."""
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")
    col = F.col
    again = col("refers_to").isNotNull()
    block = F.when(again, col("http")).otherwise(F.concat("http", "payload"))
    from_http = F.length("http") > 0
    mime = F.when(col("kind") == "warcinfo", "application/warc-fields").when(from_http, "application/http; msgtype=response").otherwise(col("mime"))
    head = F.concat(
        F.lit("WARC/1.0\r\n"),
        line("WARC-Type", F.when(again, "revisit").otherwise(col("kind"))),
        line("WARC-Record-ID", col("record_id")),
        line("WARC-Date", col("date")),
        line("WARC-Filename", F.when(col("kind") == "warcinfo", col("url"))),
        line("WARC-Target-URI", F.when(col("kind") != "warcinfo", col("url"))),
        line("WARC-IP-Address", F.when((col("kind") != "warcinfo") & (col("ip") != "0.0.0.0"), col("ip"))),
        line("WARC-Profile", F.when(again, PROFILE)),
        line("WARC-Refers-To", col("refers_to")),
        line("WARC-Refers-To-Target-URI", col("refers_url")),
        line("WARC-Refers-To-Date", col("refers_date")),
        line("WARC-Payload-Digest", F.when(col("kind") != "warcinfo", F.concat(F.lit("sha1:"), col("digest")))),
        line("WARC-Truncated", F.when(~col("whole"), "unspecified")),
        line("Content-Type", mime),
        line("Content-Length", F.length(block).cast("string")),
        F.lit("\r\n"),
    )
    rows = records.select(F.concat(F.encode(head, "UTF-8"), block).cast("string").alias("value"))
    rows.write.option("lineSep", WARC_END.decode()).options(**GZIP).text(path)


def warc_head(piece: bytes) -> tuple[dict[str, str], int] | None:
    """Named fields, in lower case, of a record's head; continued lines are joined."""
    if not re.match(rb"\s*WARC/\d", piece):
        return None
    fields, last = {}, None
    for line in piece.decode("utf-8", "replace").strip("\r\n").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
            continue
        name, _, value = line.partition(":")
        last = name.strip().lower()
        fields[last] = value.strip()
    size = fields.get("content-length", "")
    return (fields, int(size)) if size.isdigit() else None


_READ = "record_id string, kind string, url string, date string, refers_to string, payload_digest string, payload_bytes long, key string, whole boolean"


def read_warc(spark: SparkSession, path: str, key: str = "X-Page-Key", payloads: bool = False) -> DataFrame:
    """Records of all WARC files below ``path``; with ``payloads`` the payload as well (that of a revisit is empty).

    ``payload_bytes`` and ``payload_digest`` are those of the full payload: counted and
    computed where it is there, else as the record says.
    """
    columns = _READ + (", payload binary" if payloads else "")
    schema = arrow_of(columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letting_go()
        out, size = [], 0
        for _, head, _, body, whole in _records(batches, WARC_END, lambda: warc_head):
            http, payload = _split_http(body) if head.get("content-type", "").startswith("application/http") else (b"", body)
            kind = head.get("warc-type")
            if kind == "revisit":
                length = http_field(http, "Content-Length") or ""
                count, digest = int(length) if length.isdigit() else None, head.get("warc-payload-digest", "").removeprefix("sha1:") or None
            else:
                count, digest = len(payload), digest_of(payload)
            row = (head.get("warc-record-id"), kind, head.get("warc-target-uri"), head.get("warc-date"), head.get("warc-refers-to"), digest, count, http_field(http, key) or None, whole and "warc-truncated" not in head)
            out.append((*row, payload) if payloads else row)
            size += len(body) if payloads else 200
            if size > _OUT_BYTES:
                yield batch_of(schema, *zip(*out, strict=True))
                out, size = [], 0
        if out:
            yield batch_of(schema, *zip(*out, strict=True))

    return _pieces(spark, path, WARC_END).mapInArrow(run, columns)


def convert(spark: SparkSession, arc_path: str, warc_path: str, order: str = "cast(key as bigint)", least: int = 0) -> None:
    """WARC files of all ARC files below ``arc_path``.

    Of equal payloads of ``least`` bytes or more the record with the largest ``order`` (an
    expression over the columns of ``read_arc``) is the response, the others revisit it.
    """
    records = read_arc(spark, arc_path).withColumn("order", F.expr(order))
    write_warc(revisits(records, least), warc_path)


def with_targets(records: DataFrame) -> DataFrame:
    """``read_warc``'s rows with ``target_key``: the key of the record that a revisit refers to."""
    ids = records.where("kind <> 'revisit'").select(F.col("record_id").alias("refers_to"), F.col("key").alias("target_key"))
    asked = records.where("refers_to is not null").groupBy("refers_to").agg(F.count(F.lit(1)).alias("n"))
    return join_by_share(records, asked.join(ids, "refers_to"), "refers_to", "record_id")
