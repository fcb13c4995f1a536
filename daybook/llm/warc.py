"""WARC archives: captures written as linked records, and read back by transaction assembly.

Each capture becomes a request, a response (or a revisit of an equal payload)
and a metadata record; request and metadata name the response in
``WARC-Concurrent-To``. Reading takes the archives apart into records and
joins those that belong together through these identifiers, in whichever
record and file they stand, into one nested row per capture.

Records end with an empty line, two line breaks. Spark's text sink writes one
capture a row with those as its line separator, so a file is a sequence of
records to the byte, compressed as a whole. Its text source, given the same
separator, streams a file's pieces in order to one task, which puts them
together by ``Content-Length``; a payload may hold any bytes, separators and
record headers included. A task holds one record and one batch of pieces at a
time, whatever the size of a file.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import bounded, fields, written

# --- Fixed values: names and texts of the WARC 1.1 and HTTP 1.1 formats. ---
BREAK = "\r\n"
END = "\r\n\r\n"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = ["response", "revisit", "resource"]
PARTS = ["request", "metadata"]
# --- end of fixed values ---

DATE = "2000-01-01T00:00:00Z"  # a capture's date where the table has none
LEAST = 100  # bytes from which on an equal payload is revisited, not stored again
SHARED = 200_000  # shared payloads are broadcast up to this many


def _line(name: str, value: Column) -> Column:
    """A header line with its break; nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(BREAK)), F.lit(""))


def _record(kind: Column | str, record_id: Column, block: Column, *lines: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat(F.lit(VERSION + BREAK), _line("WARC-Type", kind), _line("WARC-Record-ID", record_id), *lines,
                    _line("Content-Length", F.octet_length(block).cast("string")), F.lit(BREAK), block)


def shared_payloads(captures: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST) -> DataFrame:
    """digest, first_id, first_url of every payload of at least ``least`` bytes that several rows hold.

    Counts and smallest ids are merged in the tasks that read the rows, so a
    payload that a third of them share is no large group.
    """
    payload = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    ids = F.struct(F.col(f"`{id_col}`").isNull().alias("none"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{url}`").alias("url"))
    rows = captures.where(F.octet_length(payload) >= least).select(F.sha2(payload.cast("binary"), 256).alias("digest"), ids.alias("at"))
    groups = rows.groupBy("digest").agg(F.count("*").alias("n"), F.min("at").alias("at")).where("n > 1")
    return groups.select("digest", F.col("at.id").alias("first_id"), F.col("at.url").alias("first_url"))


def write(captures: DataFrame, path: str, id_col: str = "page_id", url: str = "url", html: str = "html", date: str = DATE, least: int = LEAST) -> None:
    """Every row as a request, a response or revisit, and a metadata record in gzipped archives below ``path``.

    A null payload is an empty one. Of rows with equal payloads of at least
    ``least`` bytes those with the smallest id are responses and the others
    revisits (a null id is no smallest one; if all are null, all are
    responses). Rows repeated with the same id are captures of their own and
    have the same type. Ids and urls stand in the metadata record as JSON, so
    any url comes back as it was; in header lines control characters and
    blanks of it are percent-encoded. Other columns are not read, whatever their names.
    Record ids are random; a task that is run again writes its whole file again.
    Up to SHARED shared payloads are broadcast; beyond that the join shuffles.
    """
    shared, _ = bounded(shared_payloads(captures, id_col, url, html, least).withColumnRenamed("digest", "shared"), SHARED)
    payload = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    rows = captures.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url}`").alias("url"), payload.alias("payload"),
                           F.sha2(payload.cast("binary"), 256).alias("digest"), F.octet_length(payload).alias("bytes"))
    rows = rows.join(shared, (F.col("digest") == F.col("shared")) & (F.col("bytes") >= least), "left")
    revisit = F.col("shared").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("id"))
    rows = rows.select("*", revisit.alias("revisit"), *[F.expr("concat('<urn:uuid:', uuid(), '>')").alias(c) for c in ("capture", "request", "metadata")])

    def safe(of: Column) -> Column:
        """No control character and no blank, so that a header line stays one line."""
        out = of
        for code in [*range(33), 127]:
            out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
        # Only odd urls pay for that.
        return F.when(of.rlike(r"[\x00-\x20\x7F]"), out).otherwise(of)

    uri = safe(F.col("url"))
    place = F.regexp_extract(uri, r"^[^/?#]*://[^/?#]*([^#]*)", 1)
    asked = F.concat(F.lit("GET "), F.when(place.startswith("/"), place).otherwise(F.concat(F.lit("/"), F.coalesce(place, F.lit("")))), F.lit(" HTTP/1.1" + BREAK),
                     _line("Host", F.nullif(F.regexp_extract(uri, r"^[^/?#]*://([^/?#]*)", 1), F.lit(""))), F.lit(BREAK))
    answer = F.concat(F.lit("HTTP/1.1 200 OK" + BREAK + "Content-Type: text/html; charset=utf-8" + BREAK),
                      _line("Content-Length", F.col("bytes").cast("string")), F.lit(BREAK))
    about = F.to_json(F.struct(F.col("id").cast("string").alias("id"), F.col("url")))
    target, when = _line("WARC-Target-URI", uri), _line("WARC-Date", F.lit(date))
    concurrent = _line("WARC-Concurrent-To", F.col("capture"))
    http = "application/http; msgtype="
    response = _record(
        F.when(F.col("revisit"), "revisit").otherwise("response"), F.col("capture"), F.concat(answer, F.when(F.col("revisit"), "").otherwise(F.col("payload"))),
        target, when, _line("Content-Type", F.lit(http + "response")), _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.when(F.col("revisit"), F.concat(_line("WARC-Profile", F.lit(REVISIT_PROFILE)), _line("WARC-Refers-To-Target-URI", safe(F.col("first_url"))))).otherwise(""))
    records = [_record("request", F.col("request"), asked, target, when, concurrent, _line("Content-Type", F.lit(http + "request"))),
               response,
               _record("metadata", F.col("metadata"), about, target, when, concurrent, _line("Content-Type", F.lit("application/json")))]
    rows.select(F.concat_ws(END, *records).alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


class Reader:
    """Puts the pieces of one file after another together to records.

    A piece is what stands between two separators. ``headers`` is None
    between records; inside one, ``need`` counts the bytes of its block and
    the separator behind it that are still to come.
    """

    END = END.encode()

    def __init__(self) -> None:
        self.path, self.headers, self.need, self.got = None, None, 0, []

    def finish(self) -> None:
        if self.headers is not None:
            raise ValueError(f"{self.path}: the last record is cut off, {self.need - len(self.END)} bytes are missing")

    def feed(self, path: str, piece: bytes) -> Iterator[tuple[dict[str, list[str]], bytes]]:
        if path != self.path:
            self.finish()
            self.path = path
        data = piece + self.END
        while data:
            if self.headers is None:
                head, _, data = data.partition(self.END)
                if head.strip():
                    self.headers = headers(head)
                    self.need, self.got = int(self.headers["content-length"][0]) + len(self.END), []
            else:
                taken, data = data[:self.need], data[self.need:]
                self.got.append(taken)
                self.need -= len(taken)
                if not self.need:
                    found, self.headers = self.headers, None
                    yield found, b"".join(self.got)[:-len(self.END)]


def headers(head: bytes) -> dict[str, list[str]]:
    """The named fields of a header block by lower-case name; a line that starts with a blank goes on with the one before."""
    out: dict[str, list[str]] = {}
    last = None
    for line in head.decode("utf-8", "replace").lstrip("\r\n").split(BREAK)[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last][-1] = f"{out[last][-1]} {line.strip()}".strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            out.setdefault(last, []).append(value.strip())
    return out


_RECORD = dict(file="string", warc_type="string", record_id="string", concurrent_to="string[]", target_uri="string", refers_to_uri="string",
               stated_digest="string", digest="string", n_bytes="long", body="binary")


def _row(path: str, found: dict[str, list[str]], block: bytes, payloads: bool) -> tuple:
    def one(name: str) -> str | None:
        return found.get(name, [None])[0]

    kind, head, payload = one("warc-type"), b"", block
    if (one("content-type") or "").lower().startswith("application/http") and kind in CAPTURES:
        head, _, payload = block.partition(Reader.END)
    n = len(payload)
    if kind == "revisit":  # what the answer would have been
        n = int(headers(head).get("content-length", [n])[0])
    stated = one("warc-payload-digest")
    body = payload if payloads or kind in PARTS else None
    return (path, kind, one("warc-record-id"), found.get("warc-concurrent-to", []), one("warc-target-uri"), one("warc-refers-to-target-uri"),
            stated and stated.partition(":")[2].lower(), None if kind == "revisit" else hashlib.sha256(payload).hexdigest(), n, body)


def records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of the gzipped archives below ``path``, one row each.

    Columns: file, warc_type, record_id, concurrent_to (ids, as many as are
    named), target_uri, refers_to_uri, stated_digest (the payload digest by
    the header), digest (SHA-256 of the payload read; null for revisits),
    n_bytes (of the payload; for a revisit as its answer states), body: the
    block of requests and metadata, and with ``payloads`` the payload of the
    others. A record cut off at its file's end is an error, as is an archive that Spark splits because it isn't compressed.
    """
    lines = spark.read.option("lineSep", END).option("recursiveFileLookup", "true").text(path)
    pieces = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("piece"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader()
        for batch in batches:
            if (batch["start"] > 0).any():
                raise ValueError("an archive was split; compress it with gzip or raise spark.sql.files.maxPartitionBytes")
            rows = [_row(file, *found, payloads) for file, piece in zip(batch["file"], batch["piece"]) for found in reader.feed(file, piece)]
            yield pd.DataFrame(rows, columns=list(_RECORD))
        reader.finish()

    return pieces.mapInPandas(run, fields(**_RECORD))


def assemble(found: DataFrame) -> DataFrame:
    """One nested row per capture: capture (its record), requests and metadata (arrays of records, by id).

    Records belong together if either names the other in its concurrent-to
    ids. What belongs to no capture that is there comes out with a null
    capture: the parts of one missing capture together, a part that names
    nothing alone. Record ids are taken to be unique. ``found`` is read
    several times: pass a written table.
    """
    captures, parts = found.where(F.col("warc_type").isin(CAPTURES)), found.where(F.col("warc_type").isin(PARTS))
    links = parts.select(F.explode("concurrent_to").alias("capture_id"), F.col("record_id").alias("part_id")).unionByName(
        captures.select(F.col("record_id").alias("capture_id"), F.explode("concurrent_to").alias("part_id"))).distinct()
    part = parts.select("record_id", F.struct("record_id", "warc_type", "target_uri", "body").alias("part"))
    linked = part.join(links, F.col("record_id") == F.col("part_id"), "left")

    def of(kind: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("part.warc_type") == kind, F.col("part"))))

    grouped = linked.groupBy(F.coalesce("capture_id", "record_id").alias("of")).agg(of("request").alias("requests"), of("metadata").alias("metadata"))
    whole = captures.select("record_id", F.struct(*[c for c in found.columns if c != "concurrent_to"]).alias("capture"))
    empty = F.array().cast(grouped.schema["requests"].dataType)
    return whole.join(grouped, F.col("record_id") == F.col("of"), "full_outer").select(
        "capture", F.coalesce("requests", empty).alias("requests"), F.coalesce("metadata", empty).alias("metadata"))


def pages(transactions: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of every capture of archives that ``write`` made.

    A revisit refers to the smallest page_id among the responses whose
    payload, as read, has the digest that the revisit states.
    """
    about = F.from_json(F.col("metadata")[0]["body"].cast("string"), "id string, url string")
    rows = transactions.where(F.col("capture").isNotNull()).select(
        about.alias("about"), F.col("capture.warc_type").alias("record_type"), F.col("capture.n_bytes").alias("payload_bytes"),
        F.coalesce("capture.digest", "capture.stated_digest").alias("payload_digest"))
    rows = rows.select(F.col("about.id").cast("long").alias("page_id"), F.col("about.url").alias("url"), "payload_bytes", "payload_digest", "record_type")
    wanted = rows.where("record_type = 'revisit'").select("payload_digest").distinct()
    stored = rows.where("record_type = 'response'").join(wanted, "payload_digest", "left_semi") \
        .groupBy(F.col("payload_digest").alias("stored")).agg(F.min("page_id").alias("refers_to"))
    stored, _ = bounded(stored, SHARED)
    same = (F.col("payload_digest") == F.col("stored")) & (F.col("record_type") == "revisit")
    return rows.join(stored, same, "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def round_trip(captures: DataFrame, path: str) -> DataFrame:
    """Write the captures below ``path`` and read them back: see ``write`` and ``pages``. An empty table gives no rows."""
    spark = captures.sparkSession
    write(captures, path)
    index, _ = written(records(spark, path), "warc-records")
    rows, _ = written(assemble(index), "warc-captures")
    return pages(rows)
