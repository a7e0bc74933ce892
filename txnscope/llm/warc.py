"""WARC derivatives: each response record gives a metadata record and a plain-text conversion record.

Input: response records with ``record_id`` (``<urn:uuid:...>``), ``target_uri``,
``date``, ``http`` (the block: status line, headers, blank line, body) and,
optionally, ``block_digest`` and ``payload_digest`` as the source record states
them; stated digests are kept as they are, missing ones are computed.

Output: one row per derived record with its headers in order, its block, and
``record_type``, ``record_id``, ``refers_to``, ``source_payload_digest``,
``block_digest``.  Both records refer to the response (``WARC-Refers-To``) and
to each other (``WARC-Concurrent-To``); the metadata record's block repeats the
source's status, every HTTP header, its digests, the title and the links.
Record ids are name-based on the source id, so reruns agree.

Each row is worked on alone: no shuffle.

Edge cases: null ``http`` is an empty block (no status, empty text); a null
``record_id`` gives records that refer to nothing, with ids from uri, date and
digest; null uris and dates leave their header out; a body that is neither HTML
nor other text gets the metadata record only; repeated rows give repeated
records; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscope.llm.html_tokens import attributes, blocks, tokens

RECORD = ("record_type string, record_id string, refers_to string, target_uri string, source_payload_digest string, "
          "block_digest string, headers array<struct<name:string,value:string>>, block string")
#: Fixed value: the version line.
VERSION = "WARC/1.1"
_LINK = {"a": "href", "area": "href", "link": "href", "img": "src", "iframe": "src", "form": "action"}


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def urn(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def split_http(http: str) -> tuple[str, list[tuple[str, str]], str]:
    """Status line, headers in order (folded lines joined), body."""
    if not http.startswith("HTTP/"):
        return "", [], http
    head, _, body = http.partition("\r\n\r\n") if "\r\n\r\n" in http else http.partition("\n\n")
    status, *lines = re.sub(r"\r?\n[ \t]+", " ", head).splitlines() or [""]
    fields = [(k.strip(), v.strip()) for k, sep, v in (x.partition(":") for x in lines) if sep]
    return status, fields, body


def one_line(s: str) -> str:
    return " ".join(s.split())


def links(page: str) -> list[str]:
    out = []
    for kind, name, raw in tokens(page):
        if kind == "open" and name in _LINK and "=" in raw:
            href = attributes(raw).get(_LINK[name])
            if href:
                out.append(f"{name}@{_LINK[name]} {one_line(href)}")
    return out


def derive(record_id: str | None, uri: str | None, date: str | None, http: str | None, block_digest: str | None,
           payload_digest: str | None, software: str) -> list[tuple]:
    """The derived records of one response."""
    http = http or ""
    status, fields, body = split_http(http)
    kind = next((v for k, v in fields if k.lower() == "content-type"), "text/html" if "<" in body else "text/plain")
    kind = kind.split(";")[0].strip().lower()
    block_digest = block_digest or digest(http.encode("utf-8", "surrogatepass"))
    payload_digest = payload_digest or digest(body.encode("utf-8", "surrogatepass"))
    name = record_id or f"{uri or ''} {date or ''} {block_digest}"
    ids = {t: urn(t, name) for t in ("metadata", "conversion")}
    is_html = kind in ("text/html", "application/xhtml+xml")
    converts = is_html or kind.startswith("text/") or kind in ("application/json", "application/xml")
    title, text = "", body
    if is_html:
        found = list(blocks(body))
        title = next((t for p, t in found if p and p[-1].partition("[")[0] == "title"), "")
        text = "\n".join(t for _, t in found)

    def record(kind_of, content_type, block, more):
        raw = block.encode("utf-8", "surrogatepass")
        own = digest(raw)
        headers = [("WARC-Type", kind_of), ("WARC-Record-ID", ids[kind_of]), ("WARC-Date", date),
                   ("WARC-Target-URI", uri), ("WARC-Refers-To", record_id), *more,
                   ("WARC-Block-Digest", own), ("Content-Type", content_type), ("Content-Length", str(len(raw)))]
        return (kind_of, ids[kind_of], record_id, uri, payload_digest, own,
                [{"name": k, "value": one_line(v)} for k, v in headers if v is not None], block)

    lines = [f"software: {software}", f"source-record: {record_id or ''}", f"source-block-digest: {block_digest}",
             f"source-payload-digest: {payload_digest}", f"http-status: {one_line(status)}"]
    lines += [f"http-header: {one_line(k)}: {one_line(v)}" for k, v in fields]
    if is_html:
        lines += [f"title: {title}", *(f"outlink: {x}" for x in links(body))]
    out = [record("metadata", "application/warc-fields", "".join(f"{x}\r\n" for x in lines),
                  [("WARC-Concurrent-To", ids["conversion"] if converts else None)])]
    if converts:
        out.append(record("conversion", "text/plain; charset=utf-8", text,
                          [("WARC-Concurrent-To", ids["metadata"]), ("WARC-Source-Block-Digest", block_digest),
                           ("WARC-Source-Payload-Digest", payload_digest)]))
    return out


def derivatives(responses: DataFrame, key: str | None = None, software: str = "derivative builder 1.0") -> DataFrame:
    """Derived records of every response; ``key`` names a column that is carried along."""
    have = set(responses.columns)
    cols = [F.col(c).cast("string").alias(c) if c in have else F.lit(None).cast("string").alias(c)
            for c in ("record_id", "target_uri", "date", "http", "block_digest", "payload_digest")]
    lead = [F.col(key).alias("__key")] if key else [F.lit(None).cast("string").alias("__key")]

    def work(batches):
        for b in batches:
            out, size = [], 0
            for k, *row in zip(*(b[c] for c in b.columns)):
                got = derive(*(None if x is None or x != x else x for x in row), software)
                out += [(k, *r) for r in got]
                size += sum(len(r[-1]) for r in got)
                if size >= 4 << 20:                       # bounded frames, however long the bodies are
                    yield pd.DataFrame(out, columns=["__key", *names])
                    out, size = [], 0
            if out:
                yield pd.DataFrame(out, columns=["__key", *names])
    names = [x.split()[0] for x in ("record_type", "record_id", "refers_to", "target_uri", "source_payload_digest",
                                    "block_digest", "headers", "block")]
    inner = responses.select(*lead, *cols)
    out = inner.mapInPandas(work, f"__key {dict(inner.dtypes)['__key']}, {RECORD}")
    return out.withColumnRenamed("__key", key) if key else out.drop("__key")


def serialised() -> Column:
    """The record as it stands in a WARC file, from ``headers`` and ``block``."""
    lines = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"], F.lit("\r\n"))), "")
    return F.concat(F.lit(VERSION + "\r\n"), lines, F.lit("\r\n"), F.col("block"), F.lit("\r\n\r\n"))


def responses_of(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records of a table of pages (page_id, url, html), which states neither headers nor dates."""
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    h = F.md5(F.concat_ws("\n", F.lit("response"), F.col("page_id").cast("string"), F.col("url")))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return pages.select("page_id", F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">")).alias("record_id"),
                        F.col("url").alias("target_uri"), F.lit(date).alias("date"),
                        F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                                 F.octet_length(body), F.lit("\r\n\r\n"), body).alias("http"))
