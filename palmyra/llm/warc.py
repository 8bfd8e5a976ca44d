"""WARC archives: write captures, read records, assemble transactions.

A capture is up to three kinds of records that name each other by
``WARC-Concurrent-To``: the response (or a revisit of an equal payload), its
request and its metadata. They may lie in different files, as here: each
writing task makes one file of responses and requests, and one of metadata.
:func:`assemble` brings them together by those identifiers and gives one nested
row a capture.

Cases: a null or empty payload is an empty response; payloads of fewer than
``min_revisit_bytes`` are never deduplicated; rows repeating key and payload are a
capture each, and all responses if they have the payload's smallest key (revisits name
the first of them); a null key is kept (as null) and is never the first of its
payload while another key is there; an empty table gives empty archives; a
record whose capture has no response gives a row without one.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palmyra.llm import files
from palmyra.operators.skew import spread_join
from palmyra.sources.writers import cut_lineage

#: Payloads of fewer bytes are always stored.
MIN_REVISIT_BYTES = 100
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "data string, meta string, n_captures long"
RECORD = ("record_type string, record_id string, concurrent_to array<string>, refers_to string, "
          "target_uri string, payload_digest string, payload_bytes long, "
          "fields map<string,string>")


def record_id(kind: str, key, digest: str, copy: int = 0) -> str:
    """Depends on the row alone, so that a task that runs again, and a revisit
    written elsewhere, name the same record. ``copy`` tells repeated rows apart."""
    name = f"{kind}:{key}:{digest}" + (f":{copy}" if copy else "")
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, name)}>"


def plan_captures(pages: DataFrame, key: str, uri: str, body: str,
                  min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """key, uri, payload, digest, copy (0, or another number for each further row of the
    same key and payload) and ``first``: the smallest key with the same payload where
    that is long enough, else null.

    Keys are counted per payload without the payloads. Only payloads that come more than
    once are joined back: short ones have a null join key and go round the join, and the
    rows of a frequent one are dealt over several tasks.
    """
    rows = (pages.select(F.col(key).cast("long").alias("key"), F.col(uri).alias("uri"),
                         F.coalesce(F.col(body), F.lit("")).cast("binary").alias("payload"))
            .withColumn("digest", F.sha2("payload", 256)))
    long_enough = F.octet_length("payload") >= min_revisit_bytes
    each = cut_lineage(rows.select("key", "digest", long_enough.alias("long")).groupBy("key", "digest", "long")
                       .agg(F.count("*").alias("n")), "capture-keys")
    shared = (each.where("long").groupBy(F.col("digest").alias("join_key"))
              .agg(F.min("key").alias("first"), F.sum("n").alias("_rows")).where("_rows > 1"))
    numbered = _copies(rows, each.where("n > 1"))
    return spread_join(numbered.withColumn("join_key", F.when(long_enough, F.col("digest"))),
                       shared.drop("_rows"), ["join_key"],
                       counts=shared.drop("first")).drop("join_key")


def _copies(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """Number the rows that repeat key and payload. They are written first, which fixes
    the row numbers; without any, which is the rule, nothing is joined or written."""
    if not repeated.limit(1).count():
        return rows.withColumn("copy", F.lit(0).cast("long"))
    pair = F.concat(F.col("digest"), F.lit(":"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    counts = repeated.select(pair.alias("pair"), F.col("n").alias("_rows"))
    named = rows.withColumn("pair", pair)
    again = cut_lineage(spread_join(named, counts.select("pair"), ["pair"], "left_semi", counts=counts)
                        .withColumn("row", F.monotonically_increasing_id()), "capture-copies")
    lowest = again.groupBy("pair").agg(F.min("row").alias("lowest"))
    again = spread_join(again, lowest, ["pair"], counts=counts).withColumn(
        "copy", F.when(F.col("row") == F.col("lowest"), 0).otherwise(F.col("row") + 1))
    once = spread_join(named, counts.select("pair"), ["pair"], "left_anti", counts=counts)
    return once.withColumn("copy", F.lit(0).cast("long")).unionByName(
        again.drop("row", "lowest")).drop("pair")


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers)
    raw = head.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    return gzip.compress(raw, compresslevel=4, mtime=0)


def _fields(pairs: dict[str, object]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in pairs.items()).encode()


def _capture(row, date: str) -> tuple[bytes, bytes, bytes]:
    """Response or revisit, request and metadata record of a planned row."""
    key = None if pd.isna(row.key) else int(row.key)
    uri = (row.uri or "").replace("\r", "").replace("\n", "")
    first = None if pd.isna(row.first) else int(row.first)
    revisit = first is not None and key != first
    own = record_id("revisit" if revisit else "response", key, row.digest, row.copy)
    common = [("WARC-Target-URI", uri), ("WARC-Date", date)]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", own),
               *common, ("WARC-Payload-Digest", f"sha256:{row.digest}"),
               ("Content-Type", "application/http; msgtype=response")]
    if revisit:
        headers += [("WARC-Profile", REVISIT_PROFILE),
                    ("WARC-Refers-To", record_id("response", first, row.digest))]
    response = _record(headers, http if revisit else http + row.payload)
    path = "/" + uri.partition("://")[2].partition("/")[2]
    request = _record([("WARC-Type", "request"), ("WARC-Concurrent-To", own), *common,
                       ("WARC-Record-ID", record_id("request", key, row.digest, row.copy)),
                       ("Content-Type", "application/http; msgtype=request")],
                      f"GET {path} HTTP/1.1\r\n\r\n".encode())
    facts = {"key": "" if key is None else key, "payload-bytes": len(row.payload)}
    metadata = _record([("WARC-Type", "metadata"), ("WARC-Concurrent-To", own), *common,
                        ("WARC-Record-ID", record_id("metadata", key, row.digest, row.copy)),
                        ("Content-Type", "application/warc-fields")], _fields(facts))
    return response, request, metadata


def write_captures(plan: DataFrame, out: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write the rows of :func:`plan_captures`; return the manifest (one row a
    pair of files)."""
    files.make_dir(out)

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, data, meta, n = "", None, None, 0
        for part in parts:
            if data is None and len(part):
                name = files.attempt_name("captures")
                store, where = files.open_fs(f"{out}/{name}")
                data = store.open_output_stream(f"{where}.warc.gz", compression=None)
                meta = store.open_output_stream(f"{where}.meta.warc.gz", compression=None)
            for row in part.itertuples():
                response, request, metadata = _capture(row, date)
                data.write(response + request)
                meta.write(metadata)
                n += 1
        if data is not None:
            data.close()
            meta.close()
            yield pd.DataFrame({"data": [f"{name}.warc.gz"], "meta": [f"{name}.meta.warc.gz"],
                                "n_captures": [n]})

    return files.commit(plan.select("key", "uri", "payload", "digest", "copy", "first")
                        .mapInPandas(write, MANIFEST), out)


def parse(stream) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """(headers, block) of each record of an uncompressed stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:40]!r}")
        headers: dict[str, list[str]] = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode().partition(":")
            headers.setdefault(k.strip().lower(), []).append(v.strip())
        yield headers, stream.read(int(headers["content-length"][0]))


def _row(headers: dict[str, list[str]], block: bytes) -> tuple:
    one = {k: v[0] for k, v in headers.items()}
    kind, digest, size, fields = one["warc-type"], None, None, {}
    if kind in ("response", "revisit"):
        digest = one.get("warc-payload-digest", "").rpartition(":")[2] or None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        size, found = len(payload), hashlib.sha256(payload).hexdigest()
        if digest not in (None, found):
            raise ValueError(f"{one['warc-record-id']}: payload does not have its digest")
        digest = found
    elif kind == "request":
        method, _, rest = block.partition(b"\r\n")[0].decode("utf-8", "replace").partition(" ")
        fields = {"method": method, "path": rest.rpartition(" ")[0]}
    elif kind == "metadata":
        pairs = (x.partition(":") for x in block.decode("utf-8", "replace").splitlines() if x)
        fields = {k.strip(): v.strip() for k, _, v in pairs}
    return (kind, one["warc-record-id"], headers.get("warc-concurrent-to", []),
            one.get("warc-refers-to"), one.get("warc-target-uri"), digest, size, fields)


def read_records(spark: SparkSession, out: str, step: int = 2000) -> DataFrame:
    """One row a record of the archives that the manifest of ``out`` names. A
    task streams one file; a response's digest is computed from its payload."""
    named = spark.read.parquet(f"{out}/manifest").select("data", "meta").collect()
    columns = ["record_type", "record_id", "concurrent_to", "refers_to", "target_uri",
               "payload_digest", "payload_bytes", "fields"]

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for name in part["name"]:
                store, where = files.open_fs(f"{out}/{name}")
                rows = []
                with store.open_input_stream(where, compression=None) as raw, \
                        gzip.GzipFile(fileobj=raw) as src:
                    for headers, block in parse(src):
                        rows.append(_row(headers, block))
                        if len(rows) == step:
                            yield _frame(rows, columns)
                            rows = []
                if rows:
                    yield _frame(rows, columns)

    names = [(n,) for row in named for n in row]
    return files.spread(spark, names, "name string").mapInPandas(read, RECORD)


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=columns)
    out["payload_bytes"] = out["payload_bytes"].astype("Int64")
    return out


def assemble(records: DataFrame) -> DataFrame:
    """One nested row a capture: capture_id, response, requests, metadata.

    A capture goes by its response's (or revisit's) record id. Another record
    belongs to the captures that it names as concurrent, or that name it: both
    directions are joined by identifier. ``response`` also holds ``refers_to``.
    """
    answer = F.col("record_type").isin("response", "revisit")
    # A record named by a response (the direction that some writers use).
    named = (records.where(answer)
             .select(F.explode("concurrent_to").alias("record_id"),
                     F.col("record_id").alias("capture_id")))
    others = records.where(~answer)
    by_own = others.select(F.explode("concurrent_to").alias("capture_id"), "*")
    by_answer = named.join(others, "record_id").select("capture_id", *records.columns)
    parts = (records.where(answer).select(F.col("record_id").alias("capture_id"), "*")
             .unionByName(by_own.unionByName(by_answer).dropDuplicates(["capture_id",
                                                                         "record_id"])))
    body = F.struct("record_type", "record_id", "target_uri", "payload_digest", "payload_bytes",
                    "refers_to")
    part = F.struct("record_id", "fields")
    kind = F.col("record_type")
    return parts.groupBy("capture_id").agg(
        F.first(F.when(answer, body), ignorenulls=True).alias("response"),
        F.collect_list(F.when(kind == "request", part)).alias("requests"),
        F.collect_list(F.when(kind == "metadata", part)).alias("metadata"))


def captured_pages(spark: SparkSession, pages: DataFrame, out: str, key: str = "page_id",
                   uri: str = "url", body: str = "html") -> DataFrame:
    """Archive ``pages`` under ``out``, read the archives back and return per
    page the payload's size and digest, how it is stored and, for a revisit, the
    key of the response that it refers to."""
    write_captures(plan_captures(pages, key, uri, body), out)
    # The archives are parsed once; their records, without payloads, are read again
    # for each side of the assembly.
    records = cut_lineage(read_records(spark, out), "records")
    captures = cut_lineage(assemble(records), "captures")
    facts = F.col("metadata")[0]["fields"]
    flat = captures.select(
        "capture_id", F.expr("nullif(metadata[0].fields['key'], '')").cast("long").alias(key),
        facts["payload-bytes"].cast("long").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.record_type").alias("record_type"),
        F.col("response.refers_to").alias("response_id"),
        F.col("response.target_uri").alias("target_uri"),
        F.expr("requests[0].fields['path']").alias("request_path"))
    targets = (flat.where("record_type = 'response'")
               .select(F.col("capture_id").alias("response_id"), F.col(key).alias("refers_to")))
    stored = flat.where("record_type = 'response'").withColumn("refers_to",
                                                               F.lit(None).cast("long"))
    # Many revisits may refer to one response.
    again = spread_join(flat.where("record_type = 'revisit'"), targets, ["response_id"])
    return stored.unionByName(again).drop("capture_id", "response_id")
