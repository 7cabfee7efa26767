"""WARC files and their not-modified revisits.

A revisit holds no body: the server answered 304 to a conditional request. Its body and most
of its headers are those of the latest earlier full response of the same canonical URL, found by
an as-of join. The validators of the revisit must agree with the response's, and headers that
a 304 may renew replace the stored ones.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewright.llm.common import cuts, range_of

#: Records of one file, and ranges of time that an as-of join is divided into.
RECORDS, PERIODS = 2000, 64
#: Bytes inflated at a time, and bytes of records sent together.
PART, SENT = 1 << 20, 8 << 20
_MEMBER = b"\x1f\x8b\x08"
# fixed values: header fields that a 304 never renews, and the default ports
FROZEN = (
    "connection", "content-encoding", "content-length", "content-location", "content-range", "content-type",
    "keep-alive", "proxy-authenticate", "proxy-authentication-info", "proxy-connection", "te", "trailer",
    "transfer-encoding", "upgrade",
)
_PORTS = {"http": ":80", "https": ":443"}
_URL = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?"
_END = "\r\n\r\n"


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, without default port and fragment, an empty path as /,
    parameters sorted. What is no URL only loses its fragment and outer spaces; null stays null."""
    url = F.trim(url)
    scheme, host = F.lower(F.regexp_extract(url, _URL, 1)), F.lower(F.regexp_extract(url, _URL, 2))
    for name, port in _PORTS.items():
        host = F.when((scheme == name) & host.endswith(port), F.regexp_replace(host, port + "$", "")).otherwise(host)
    path, query = F.regexp_extract(url, _URL, 3), F.regexp_extract(url, _URL, 4)
    path = F.when(path == "", "/").otherwise(path)
    sorted_ = F.array_join(F.array_sort(F.split(F.substring(query, 2, 1 << 30), "&")), "&")
    whole = F.concat(scheme, F.lit("://"), host, path, F.when(F.length(query) > 1, F.concat(F.lit("?"), sorted_)).otherwise(""))
    return F.when(url.rlike(_URL), whole).otherwise(F.regexp_replace(url, "#.*$", ""))


def _line(name: str, value: Column) -> Column:
    clean = F.regexp_replace(value, r"[\r\n]+", " ")
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n"))).otherwise("")


def write_warc(captures: DataFrame, folder: str, compression: str = "gzip") -> None:
    """Writes captures (record_id, kind, url, time, headers, payload) as WARC/1.1 files.

    ``kind`` is response or revisit; headers is a map from names to values, the payload is text or
    bytes, null is empty, line breaks in headers become spaces. A null record_id, url or time leaves out its field. Files hold
    at most RECORDS records. Records end with two line breaks, which Spark's text writer puts.
    """
    pairs = F.transform(F.map_entries("headers"), lambda e: F.regexp_replace(F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit(""))), r"[\r\n]+", " "))
    revisit = F.col("kind") == "revisit"
    status = F.when(revisit, "HTTP/1.1 304 Not Modified\r\n").otherwise("HTTP/1.1 200 OK\r\n")
    lines = F.array_join(F.transform(F.coalesce(pairs, F.array().cast("array<string>")), lambda p: F.concat(p, F.lit("\r\n"))), "")
    body = F.when(revisit, "").otherwise(F.coalesce(F.col("payload").cast("string"), F.lit("")))
    block = F.concat(status, lines, F.lit("\r\n"), body)
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.col("kind")),
        _line("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Date", F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.when(revisit, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/server-not-modified\r\n").otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length("block").cast("string"),
        F.lit(_END),
    )
    rows = captures.select("kind", "record_id", "url", "time", block.alias("block")).select(F.concat(head, F.col("block")).alias("value"))
    rows.write.option("lineSep", _END).option("maxRecordsPerFile", RECORDS).option("compression", compression).text(folder)


def _fields(head: bytes) -> list[tuple[str, str]]:
    lines = [line.partition(b":") for line in head.split(b"\r\n") if b":" in line]
    return [(name.decode(errors="replace").strip(), value.decode(errors="replace").strip()) for name, _, value in lines]


def _inflated(data: bytes) -> Iterator[bytes | None]:
    """Parts of a file's content, inflated if compressed. None stands where a member broke off; reading goes
    on at the next place that starts a member."""
    if data[:2] != _MEMBER[:2]:
        yield from (data[i : i + PART] for i in range(0, len(data), PART))
        return
    at = 0
    while at >= 0:
        member, here, left = zlib.decompressobj(31), at, b""
        try:
            while not member.eof:
                if not left:
                    left = data[here : here + PART]
                    here += len(left)
                if not left:
                    yield member.flush()
                    yield None
                    return
                yield member.decompress(left, PART)
                left = member.unconsumed_tail
            at = data.find(_MEMBER, here - len(member.unused_data))
        except zlib.error:
            yield None
            at = data.find(_MEMBER, at + 1)


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record; damaged ones are passed over.

    Plain or gzipped, in any number of members; junk between records or members is skipped. A member that is
    cut short or has wrong bytes gives the records before the damage, as inflated, and ends there. Held are
    one record and PART bytes; a record whose length is wrong is held until the content ends.
    """
    held, at, looked = bytearray(), 0, 0
    for part in chain(_inflated(data), [None]):
        held += part or b""
        while (at := held.find(b"WARC/1.", at)) >= 0:
            stop = held.find(b"\r\n\r\n", max(at, looked))
            if stop < 0:
                looked = max(at, len(held) - 3)
                break
            fields = {k.lower(): v for k, v in _fields(bytes(held[at:stop]))}
            size = fields.get("content-length", "")
            end = stop + 4 + int(size) if size.isascii() and size.isdigit() else None
            if end is not None and end > len(held) and part is not None:
                break
            if end is None or end > len(held):
                at += 1
                continue
            yield fields, bytes(held[stop + 4 : end])
            at = end
        if part is None:
            held.clear()
            at = looked = 0
        else:
            gone = at if at >= 0 else max(len(held) - 6, 0)
            del held[:gone]
            at, looked = 0, max(looked - gone, 0)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (record_id, kind, url, time, headers, payload) of the responses and revisits in
    WARC files; header names come in lower case, of repeated ones the last value. Payloads are the bytes
    as archived. Damaged files give what ``records`` gives of them; an unreadable time is null. Spark hands over each
    file as one cell, below 2 GB; content is inflated and sent on in parts."""
    names = ["record_id", "kind", "url", "time", "headers", "payload"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=t) for i, t in enumerate(kinds)], names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, n = [], 0
        for batch in batches:
            for data in batch.column(0):
                for fields, block in records(data.as_py()):
                    if fields.get("warc-type") not in ("response", "revisit"):
                        continue
                    head, _, body = block.partition(b"\r\n\r\n")
                    headers = {k.lower(): v for k, v in _fields(head)}
                    named = fields.get("warc-record-id", "").strip("<>") or None
                    rows.append((named, fields["warc-type"], fields.get("warc-target-uri"), fields.get("warc-date"), list(headers.items()), body))
                    n += len(block)
                    if n >= SENT:
                        yield batch_of(rows)
                        rows, n = [], 0
        if rows:
            yield batch_of(rows)

    files = spark.read.format("binaryFile").load(folder).select("content")
    rows = files.mapInArrow(run, "record_id string, kind string, url string, time string, headers map<string,string>, payload binary")
    return rows.withColumn("time", F.try_to_timestamp("time", F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")))


def resolve_revisits(captures: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Rows (record_id, canonical_url, response_id, outcome, headers, *carried), one per revisit.

    The response is the latest of the same canonical URL at a strictly earlier time; of several
    at that time the one of largest record_id. Outcomes: ``resolved`` if the revisit's etag (compared
    weakly) or, without one, its last-modified equals the response's; ``mismatch`` if it does
    not; ``unvalidated`` if the revisit has neither; ``orphan`` if there is no response, as
    for null URLs and times. Headers are merged where resolved or unvalidated, else the
    revisit's own. ``carried`` names columns taken from the response, null unless it serves.

    Each URL's captures are divided into ranges of time; what earlier ranges hand to a later
    one is their last response, so a URL with a third of all captures is spread over the ranges.
    """
    keys = {"canonical_url": canonical_url(F.col("url")), "_response": F.col("kind") == "response"}
    rows = captures.select("record_id", "url", "time", "kind", "headers", *carried).withColumns(keys)
    period = range_of(F.unix_seconds("time"), cuts(rows.select(F.unix_seconds("time").alias("t")), "t", PERIODS))
    rows = rows.withColumn("_period", period)
    whole = F.struct("time", F.coalesce("record_id", F.lit("")).alias("id"), "record_id", "headers", *carried)
    known = F.col("_response") & F.col("time").isNotNull() & F.col("canonical_url").isNotNull()
    order = Window.partitionBy("canonical_url", "_period").orderBy("time", "_response", F.coalesce("record_id", F.lit("")))
    inside = F.last(F.when(known, whole), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("_inside", inside)
    ordered = F.when(known, F.struct("time", F.coalesce("record_id", F.lit("")).alias("id")))
    last = rows.where("canonical_url is not null").groupBy("canonical_url", "_period").agg(F.max_by(whole, ordered).alias("_last"))
    earlier = Window.partitionBy("canonical_url").orderBy("_period").rowsBetween(Window.unboundedPreceding, -1)
    handed = last.select(F.col("canonical_url").alias("_url"), F.col("_period").alias("_at"), F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    visits = rows.where("kind = 'revisit'").join(handed, (F.col("canonical_url") == F.col("_url")) & (F.col("_period") == F.col("_at")), "left")
    found = F.when(F.col("time").isNotNull() & F.col("canonical_url").isNotNull(), F.coalesce("_inside", "_before"))
    visits = visits.select("record_id", "canonical_url", F.col("headers").alias("own"), found.alias("found"))

    tag = lambda headers: F.regexp_replace(headers["etag"], "^W/", "")
    own, theirs = F.col("own"), F.col("found.headers")
    since = own["last-modified"]
    agrees = F.when(own["etag"].isNotNull(), tag(own).eqNullSafe(tag(theirs))).otherwise(since.eqNullSafe(theirs["last-modified"]))
    outcome = F.when(F.col("found").isNull(), "orphan").when(own["etag"].isNull() & since.isNull(), "unvalidated")
    outcome = outcome.when(agrees, "resolved").otherwise("mismatch")
    visits = visits.withColumn("outcome", outcome)
    renewed = F.map_filter(own, lambda k, v: ~k.isin(*FROZEN))
    stayed = F.map_filter(theirs, lambda k, v: ~F.map_contains_key(renewed, k))
    serves = F.col("outcome").isin("resolved", "unvalidated")
    headers = F.when(serves, F.map_concat(stayed, renewed)).otherwise(own)
    taken = [F.when(serves, F.col(f"found.{c}")).alias(c) for c in carried]
    return visits.select("record_id", "canonical_url", F.col("found.record_id").alias("response_id"), "outcome", headers.alias("headers"), *taken)
