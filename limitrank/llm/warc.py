"""WARC records: not-modified revisits are resolved against the latest earlier full response of the same address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fields that a 304 answer may set anew on the stored response (fixed values; those of RFC 9110, section 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical_url(url: Column) -> Column:
    """Address without scheme, ``www.``, default port and fragment, host in lower case; empty path as ``/``. Null stays null."""
    bare = F.regexp_replace(F.regexp_replace(url, r"(?s)#.*\z", ""), r"(?i)\A[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"(?s)\A([^/?]*)", 1)), r"\Awww\.|:(80|443)\z", "")
    rest = F.regexp_extract(bare, r"(?s)\A[^/?]*(.*)\z", 1)
    return F.when(url.isNotNull(), F.concat(host, F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))))


def header_map(block: Column) -> Column:
    """Map of lower-cased names to values from header lines ``Name: value``; a repeated name keeps its last value.

    Null or empty blocks give an empty map; lines without colon are left out.
    """
    lines = F.filter(F.split(F.coalesce(block, F.lit("")), r"\r?\n"), lambda x: x.rlike(r"\A[^:\s][^:]*:"))
    pairs = F.transform(lines, lambda x: F.struct(F.lower(F.trim(F.substring_index(x, ":", 1))).alias("k"), F.trim(F.regexp_replace(x, r"(?s)\A[^:]*:", "")).alias("v")))
    names = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(F.filter(pairs, lambda p: p["k"] == n), -1)["v"]))


def resolve_revisits(records: DataFrame, span_seconds: int = 900) -> DataFrame:
    """One row per revisit: record_id, canonical, ts, status, original_id, headers.

    ``records`` has record_id, url, ts (timestamp), type (``response`` or ``revisit``), headers (text block), digest and, where it is known, http_status.
    A response is full if its http_status is 200 or not known; errors, redirects and partial answers never serve. The latest full response of the same canonical url with an earlier ts is looked up (at equal ts, none; among
    responses at one ts, that with the largest record_id). A validator that both sides carry must be equal, entity tags
    without ``W/``; status is ``resolved``, ``mismatch``, ``unverified`` (no common validator) or ``missing`` (no earlier response). Headers:
    those of the response with the permitted ones of the revisit over them (null unless resolved).

    The as-of join carries ids and validators in two steps: within (url, span) and then over one summary row for each
    span, so that a url captured very often is spread over tasks. Bodies are never moved. Nulls: a null url or ts
    resolves to ``missing`` and a null ts never serves as an original; repeated rows repeat; empty gives empty; extra columns are ignored.
    """
    code = F.col("http_status") if "http_status" in records.columns else F.lit(None)
    served = (F.col("type") == "revisit") | ((F.col("type") == "response") & (F.coalesce(code.cast("int"), F.lit(200)) == 200))
    r = records.where(served).select("record_id", canonical_url(F.col("url")).alias("canonical"), "ts", "type", "digest", header_map(F.col("headers")).alias("h"))
    r = r.withColumn("part", F.floor(F.unix_seconds("ts") / span_seconds))
    full = F.col("type") == "response"
    mine = F.when(full & F.col("ts").isNotNull(), F.struct("ts", "record_id", "digest", "h"))
    r = r.withColumn("own", mine)
    known = r.where(F.col("canonical").isNotNull() & F.col("ts").isNotNull())
    # revisits sort before responses at one instant, so only earlier ones are seen
    inner = Window.partitionBy("canonical", "part").orderBy("ts", F.when(full, 1).otherwise(0), "record_id").rowsBetween(Window.unboundedPreceding, -1)
    seen = known.withColumn("near", F.last("own", ignorenulls=True).over(inner)).where(~full)
    parts = known.groupBy("canonical", "part").agg(F.max_by(F.when(full, F.col("own")), F.when(full, F.struct("ts", "record_id"))).alias("latest"))
    outer = Window.partitionBy("canonical").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("far", F.last("latest", ignorenulls=True).over(outer)).select("canonical", "part", "far")
    found = seen.join(parts, ["canonical", "part"], "left").select("record_id", "canonical", "ts", "digest", "h", F.coalesce("near", "far").alias("o"))
    lost = r.where(~full & (F.col("canonical").isNull() | F.col("ts").isNull()))
    found = found.unionByName(lost.select("record_id", "canonical", "ts", "digest", "h", F.lit(None).cast(found.schema["o"].dataType).alias("o")))

    def tag(m: Column) -> Column:
        return F.regexp_replace(m["etag"], r"\AW/", "")

    o, h = F.col("o"), F.col("h")
    same = F.array(tag(h) == tag(o["h"]), h["last-modified"] == o["h"]["last-modified"], F.col("digest") == o["digest"])
    told = F.filter(same, lambda x: x.isNotNull())
    status = (
        F.when(o.isNull(), "missing").when(F.size(told) == 0, "unverified").when(F.forall(told, lambda x: x), "resolved").otherwise("mismatch")
    )
    allowed = F.map_filter(h, lambda k, _: k.isin(*PERMITTED))
    base = F.map_filter(o["h"], lambda k, _: ~F.map_contains_key(allowed, k))
    return found.withColumn("status", status).select(
        "record_id", "canonical", "ts", "status", F.when(F.col("status") == "resolved", o["record_id"]).alias("original_id"),
        F.when(F.col("status") == "resolved", F.map_concat(base, allowed)).alias("headers"),
    )


def page_records(pages: DataFrame) -> DataFrame:
    """Capture records derived from ``pages``: per page a full response, an error half a day later, a revisit a day later, and another two days later.

    The second revisit carries another entity tag where page_id is divisible by 5, so that it must not resolve. The error carries
    the revisits' tag of another page, so that it must not serve.
    """
    day, start = 86400, 1704067200
    at = F.lit(start) + F.pmod(F.coalesce("page_id", F.lit(0)) * 7919, F.lit(30 * day))
    digest = F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256)
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 8), F.lit('"'))
    other = F.when(F.col("page_id") % 5 == 0, F.lit('"changed"')).otherwise(tag)

    def record(k: int, later: int, kind: str, code: int, headers: Column) -> Column:
        return F.struct(F.lit(k).alias("k"), (at + later).alias("at"), F.lit(kind).alias("type"), F.lit(code).alias("code"), headers.alias("headers"))

    kinds = F.array(
        record(0, 0, "response", 200, F.concat(F.lit("Content-Type: text/html\r\nETag: "), tag, F.lit("\r\nCache-Control: max-age=60"))),
        record(1, day, "revisit", 304, F.concat(F.lit("ETag: W/"), tag, F.lit("\r\nCache-Control: max-age=90\r\nContent-Type: none"))),
        record(2, 2 * day, "revisit", 304, F.concat(F.lit("ETag: "), other, F.lit("\r\nDate: now"))),
        record(3, day // 2, "response", 404, F.lit('Content-Type: text/plain\r\nETag: "changed"')),
    )
    p = pages.select("page_id", "url", digest.alias("d"), F.explode(kinds).alias("r"))
    return p.select(
        (F.col("page_id") * 4 + F.col("r.k")).alias("record_id"), "url", F.timestamp_seconds(F.col("r.at")).alias("ts"),
        F.col("r.type").alias("type"), F.col("r.code").alias("http_status"), F.col("r.headers").alias("headers"), F.when(F.col("r.k") == 0, F.col("d")).alias("digest"),
    )
