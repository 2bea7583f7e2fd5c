r"""WARC archives: writing pages as captures, and assembling captures from the records read back.

A capture is three records: the request, the response (or a revisit of an equal payload captured before) and
metadata with the page's id and exact address. Request and metadata name the response or revisit in
WARC-Concurrent-To. Reading joins them through these identifiers again, in whichever direction the
archive has them, and gives one nested row per capture.

Archives are written by Spark's text sink, a record per line, with the two empty lines that end a WARC
record as the line separator; so files appear whole or not at all, however often a task is run. They are
read by the text source, cut before every `WARC/1.`, so a task holds one record at a time and uncompressed
archives of any size are split. Where `WARC/1.` stands inside a payload a record comes in several
pieces; files in which a piece does not have the length it announces are put together again piece by piece,
in the order of the file. Only lengths pass through that fold, not payloads.

Of equal payloads of at least `least_bytes` bytes, the first by (page_id, url) is the response; the others revisit it.

Defined results: a null payload is empty; a null page_id or url is read back as null, a null page_id comes after all
others; rows that repeat are captures of their own, the later ones revisits; characters that may not stand in
a header are percent-coded there, and kept exactly in the metadata. A record whose length is wrong is
`whole = false` and belongs to no capture; a revisit whose response is missing has the digest and
length that it states itself and refers to nothing. Empty tables give empty archives, other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import body, small
from touchline.operators.joins import join_with_hot_keys
from touchline.session import scratch_path, stored

MARK = "WARC/1."
CRLF = "\r\n"
GAP = CRLF + CRLF


@dataclass(frozen=True)
class Settings:
    #: Payloads below this are written every time.
    least_bytes: int = 100
    date: str = "2024-01-01T00:00:00Z"
    compression: str = "gzip"
    #: A payload or response that more than one in so many rows share is met by a broadcast: so many at most.
    hot: int = 1000
    #: File names, of about 200 bytes, up to which they are broadcast.
    broadcast_rows: int = 20_000


def _text(*parts: Column | str) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _urn(*parts: Column | str) -> Column:
    """A record identifier that depends on nothing but the parts."""
    h = F.md5(_text(*parts).cast("binary"))
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return _text("<urn:uuid:", F.concat_ws("-", *cuts), ">")


def _record(kind: Column | str, name: Column, date: str, fields: list[tuple[str, Column | str]], block: Column) -> Column:
    """Text of a record without the two empty lines at its end; fields that are null are left out."""
    lines = [F.coalesce(_text(f"{k}: ", v, CRLF), F.lit("")) for k, v in fields]
    length = F.octet_length(block).cast("string")
    return _text(MARK, "1\r\nWARC-Type: ", kind, "\r\nWARC-Record-ID: ", name, f"\r\nWARC-Date: {date}\r\n", *lines, "Content-Length: ", length, GAP, block)


def _plan(pages: DataFrame, settings: Settings) -> DataFrame:
    """A row for each different (page_id, url, payload): capture, copies, digest, bytes and, if it is shared, its head."""
    seen = pages.groupBy("capture", "page_id", "url", "digest", "bytes").agg(F.count("*").alias("copies"))
    seen = stored(seen, "warc-captures")
    total = seen.count()
    large = seen.filter(F.col("bytes") >= settings.least_bytes)
    first = F.min(F.struct(F.col("page_id").isNull(), "page_id", F.col("url").isNull(), "url", "capture"))
    heads = large.groupBy("digest").agg(first.getField("capture").alias("head"), F.count("*").alias("n"))
    headed = join_with_hot_keys(large, heads, "digest", F.col("n") * settings.hot > total).drop("n")
    few = seen.filter(F.col("bytes") < settings.least_bytes).withColumn("head", F.lit(None).cast("string"))
    return headed.unionByName(few)


def _captured(rows: DataFrame, settings: Settings) -> DataFrame:
    """The three records of each row (capture, copy, page_id, url, digest, bytes, head, html), a record a row."""
    revisits = F.coalesce((F.col("head") != F.col("capture")) | (F.col("copy") > 1), F.lit(False)) & F.col("head").isNotNull()
    copy = F.col("copy").cast("string")
    main = _urn("capture ", F.col("capture"), " ", copy)
    target = F.regexp_replace(F.when(F.col("url") != "", F.col("url")).otherwise(_text("urn:capture:", F.col("capture"))), r"[\x00-\x20\x7F]", "%20")
    host, path = (F.regexp_extract(target, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)", k) for k in (1, 2))
    answer = _text("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: ", F.col("bytes").cast("string"), GAP)
    digest = _text("sha256:", F.col("digest"))
    http = "application/http; msgtype="
    request = _record(
        "request",
        _urn("request ", F.col("capture"), " ", copy),
        settings.date,
        [("WARC-Target-URI", target), ("WARC-Concurrent-To", main), ("Content-Type", http + "request")],
        _text("GET ", F.when(path == "", F.lit("/")).otherwise(path), " HTTP/1.1\r\nHost: ", host, GAP),
    )
    response = _record(
        F.when(revisits, F.lit("revisit")).otherwise(F.lit("response")),
        main,
        settings.date,
        [
            ("WARC-Target-URI", target),
            ("WARC-Payload-Digest", digest),
            ("WARC-Profile", F.when(revisits, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
            ("WARC-Refers-To", F.when(revisits, _urn("capture ", F.col("head"), " 1"))),
            ("Content-Type", http + "response"),
        ],
        F.when(revisits, answer).otherwise(_text(answer, F.coalesce("html", F.lit("")))),
    )
    field = lambda name, value: F.coalesce(_text(f"{name}: ", value, CRLF), F.lit(""))
    metadata = _record(
        "metadata",
        _urn("metadata ", F.col("capture"), " ", copy),
        settings.date,
        [("WARC-Target-URI", target), ("WARC-Concurrent-To", main), ("Content-Type", "application/warc-fields")],
        _text(field("page_id", F.col("page_id").cast("string")), field("url", F.url_encode("url"))),
    )
    return rows.select(F.explode(F.array(request, response, metadata)).alias("value"))


def archived(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Records, as text, of every row of (page_id, url, html)."""
    html = body("html")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumns({"digest": F.sha2(F.col("html").cast("binary"), 256), "bytes": F.octet_length("html").cast("long")})
    rows = rows.withColumn("capture", F.md5(F.to_json(F.struct("page_id", "url", "digest")).cast("binary")))
    plan = _plan(rows.drop("html"), settings)
    # Payloads move once; rows that repeat are one row by then.
    payloads = rows.groupBy("capture").agg(F.first("html").alias("html"))
    first = plan.join(payloads.hint("merge"), "capture").withColumn("copy", F.lit(1).cast("long"))
    # Further copies are revisits, or short: at most a thousand of one capture are dealt to a task together.
    step = 1000
    more = plan.filter("copies > 1").withColumn("copy", F.explode(F.expr(f"sequence(2L, copies, {step}L)"))).repartition("capture", "copy")
    more = more.withColumn("copy", F.explode(F.expr(f"sequence(copy, least(copies, copy + {step - 1}L))")))
    short = rows.filter(F.col("bytes") < settings.least_bytes).select("capture", "html").distinct()
    more = more.join(short, "capture", "left")
    columns = ["capture", "copy", "page_id", "url", "digest", "bytes", "head", "html"]
    return _captured(first.select(*columns).unionByName(more.select(*columns)), settings)


def write_archive(pages: DataFrame, path: str, settings: Settings = Settings()) -> None:
    """Writes WARC files into the folder `path`; Spark names them part-*.txt.gz."""
    archived(pages, settings).write.option("lineSep", GAP).option("compression", settings.compression).text(path)


def _header(name: str) -> Column:
    found = F.regexp_extract("head", rf"(?im)^{name}:[ \t]*(.*?)[ \t]*\r?$", 1)
    return F.when(found != "", found)


def _pieces(spark, path: str) -> DataFrame:
    """The text between the marks, with its place and, if it begins a record, the bytes that the record should have."""
    rows = spark.read.option("lineSep", MARK).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at")
    )
    rows = rows.withColumn("head", F.substring_index("value", GAP, 1))
    begins = F.col("head").rlike(r"^\d\r\n") & _header("WARC-Type").isNotNull()
    length = F.when(begins, _header("Content-Length").try_cast("long"))
    return rows.withColumns({"size": F.octet_length("value").cast("long"), "needs": F.octet_length("head") + length + 2 * len(GAP)})


def _chained(pieces: pd.DataFrame) -> pd.DataFrame:
    """For the pieces of one file: the number of their record, and whether it has the length it announces."""
    pieces = pieces.sort_values(["start", "at"], ignore_index=True)
    sizes, needs = pieces["size"].to_numpy(), pieces["needs"].to_numpy(dtype=float)
    record, whole, i = [0] * len(sizes), [False] * len(sizes), 0
    while i < len(sizes):
        end, held = i + 1, sizes[i]
        while end < len(sizes) and held < needs[i]:
            held += len(MARK) + sizes[end]
            end += 1
        if held != needs[i]:
            end = i + 1
        record[i:end] = [i] * (end - i)
        whole[i:end] = [bool(held == needs[i])] * (end - i)
        i = end
    return pieces.assign(record=record, whole=whole)[["file", "start", "at", "record", "whole"]]


def _joined(doubtful: DataFrame) -> DataFrame:
    """(value, head, whole) of the records of files whose pieces need not be records."""
    doubtful = stored(doubtful, "warc-pieces")
    chained = doubtful.select("file", "start", "at", "size", "needs").groupBy("file").applyInPandas(
        _chained, "file string, start long, at long, record long, whole boolean"
    )
    placed = doubtful.join(chained, ["file", "start", "at"])
    parts = F.sort_array(F.collect_list(F.struct("start", "at", "value")))
    records = placed.groupBy("file", "record", "whole").agg(F.array_join(F.transform(parts, lambda p: p["value"]), MARK).alias("value"))
    return records.filter("value != ''").select("value", F.substring_index("value", GAP, 1).alias("head"), "whole")


def read_records(spark, path: str, settings: Settings = Settings()) -> DataFrame:
    """Every record below `path`: record_id, kind, concurrent, refers_to, target, digest, date, content_type, block, whole."""
    pieces = _pieces(spark, path)
    # The text before the first mark of a file is empty.
    odd = (F.col("size") > 0) & (F.col("needs").isNull() | (F.col("needs") != F.col("size")))
    files = stored(pieces.filter(odd).select("file").distinct(), "warc-odd-files")
    count = files.count()
    records = pieces
    if count:
        files = small(files, count, settings.broadcast_rows)
        records = pieces.join(files, "file", "left_anti")
    records = records.filter("size > 0").select("value", "head", F.lit(True).alias("whole"))
    if count:
        records = records.unionByName(_joined(pieces.join(files, "file", "left_semi")))
    block = F.expr(f"substring(cast(value as binary), octet_length(head) + {len(GAP) + 1}, octet_length(value) - octet_length(head) - {2 * len(GAP)})")
    named = F.regexp_extract_all("head", F.lit(r"(?im)^WARC-Concurrent-To:[ \t]*(.*?)[ \t]*\r?$"), F.lit(1))
    return records.select(
        _header("WARC-Record-ID").alias("record_id"),
        F.lower(_header("WARC-Type")).alias("kind"),
        named.alias("concurrent"),
        _header("WARC-Refers-To").alias("refers_to"),
        _header("WARC-Target-URI").alias("target"),
        F.regexp_replace(_header("WARC-Payload-Digest"), "^sha256:", "").alias("digest"),
        _header("WARC-Date").alias("date"),
        _header("Content-Type").alias("content_type"),
        block.alias("block"),
        "whole",
    )


def captures(records: DataFrame) -> DataFrame:
    """One nested row per response or revisit: its own columns, http head and payload, its requests and its metadata.

    Records belong together if either names the other in WARC-Concurrent-To, or if both a metadata
    record names a request and one of these two and the response name each other.
    """
    whole = records.filter("whole")
    is_main = F.col("kind").isin("response", "revisit")
    mains, others = whole.filter(is_main), whole.filter(F.col("kind").isin("request", "metadata"))
    # Names alone, so that payloads are not read for each step.
    names = stored(whole.select("record_id", is_main.alias("is_main"), "kind", "concurrent"), "warc-names")
    main_ids = names.filter("is_main").select(F.col("record_id").alias("main"))
    links = names.filter("kind IN ('request', 'metadata')").select(F.col("record_id").alias("part"), F.explode("concurrent").alias("main"))
    links = links.unionByName(names.filter("is_main").select(F.explode("concurrent").alias("part"), F.col("record_id").alias("main")))
    # A metadata record that names its request belongs where the request does.
    linked = stored(links.distinct(), "warc-links")
    known = linked.join(main_ids, "main", "left_semi")
    astray = linked.join(main_ids, "main", "left_anti")
    through = astray.withColumnRenamed("main", "via").join(known.withColumnRenamed("part", "via"), "via").select("part", "main")
    linked = known.unionByName(through).distinct()
    text = F.struct("record_id", "target", F.col("block").cast("string").alias("text"))
    parts = others.select(F.col("record_id").alias("part"), "kind", text.alias("r")).join(linked, "part")
    ordered = lambda kind: F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.col("r")))).alias(kind)
    gathered = parts.groupBy(F.col("main").alias("record_id")).agg(ordered("request"), ordered("metadata"))
    http = F.substring_index(F.col("block").cast("string"), GAP, 1)
    payload = F.expr(f"substring(block, octet_length(http) + {len(GAP) + 1})")
    mains = mains.select("record_id", "kind", "target", "date", "refers_to", "digest", http.alias("http"), "block")
    return mains.withColumn("payload", F.when(F.col("kind") == "response", payload)).drop("block").join(gathered, "record_id", "left")


def _field(name: str) -> Column:
    found = F.regexp_extract(F.get("metadata", F.lit(0))["text"], rf"(?m)^{name}: (.*?)\r?$", 1)
    return F.when(F.get("metadata", F.lit(0))["text"].rlike(rf"(?m)^{name}: "), found)


def described(found: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to (a page_id) and url of captures."""
    stated = F.regexp_extract("http", r"(?im)^Content-Length:[ \t]*(\d+)", 1).try_cast("long")
    rows = found.select(
        "record_id",
        F.col("kind").alias("record_type"),
        F.col("refers_to").alias("target"),
        _field("page_id").cast("long").alias("page_id"),
        F.url_decode(_field("url")).alias("url"),
        F.when(F.col("kind") == "response", F.sha2("payload", 256)).otherwise(F.col("digest")).alias("payload_digest"),
        F.when(F.col("kind") == "response", F.octet_length("payload").cast("long")).otherwise(stated).alias("payload_bytes"),
    )
    rows = stored(rows, "warc-described")
    revisits = rows.filter("record_type = 'revisit'")
    asked = revisits.groupBy("target").agg(F.count("*").alias("n"))
    answers = rows.filter("record_type = 'response'").select(
        F.col("record_id").alias("target"), F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("b")
    )
    total = revisits.count()
    known = answers.join(asked, "target")
    met = join_with_hot_keys(revisits, known, "target", F.col("n") * settings.hot > total, "left")
    met = met.withColumns({"payload_digest": F.coalesce("d", "payload_digest"), "payload_bytes": F.coalesce("b", "payload_bytes")})
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    alone = rows.filter("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    return alone.select(*columns).unionByName(met.select(*columns))


def warc(spark, sf_dir: str) -> DataFrame:
    """Query: writes every page into an archive and reads it back."""
    path = scratch_path(spark, "warc")
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return described(captures(read_records(spark, path)))


SQL = """
WITH p AS (
    SELECT page_id, url, coalesce(html, '') AS html FROM pages
), d AS (
    SELECT page_id, url, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest,
        row_number() OVER (PARTITION BY html ORDER BY page_id NULLS LAST, url NULLS LAST) AS place,
        first_value(page_id) OVER (PARTITION BY html ORDER BY page_id NULLS LAST, url NULLS LAST) AS first_id
    FROM p
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND place > 1 THEN first_id END AS refers_to,
    url
FROM d
"""
