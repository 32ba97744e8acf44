"""WARC not-modified revisits: resolved by an as-of join on the canonical URL.

A revisit record (HTTP 304) has no body. It stands for the latest full response
that was captured strictly earlier from the same canonical URL, or for the
latest of all if its own time is unknown, if the validators agree: an ETag on both sides must be equal (weak comparison), else
a Last-Modified on both sides. The headers are the response's, updated by those
that a 304 may change.

The as-of join is DataFrame operations only. Records are cut into slices of
nearly equal count along URL and time; a window finds the latest response
within a URL's slice, and a second window over one row for each URL and slice
finds the latest of the slices before. So a URL with very many captures is
dealt over as many tasks as its rows fill, whenever they were made. The
response's headers travel with it through the windows, so nothing is joined by
record id and rows that repeat are each answered once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mergestone.llm.scratch import Scratch

#: Headers that a 304 may update.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that don't choose a page.
TRACKING = "^(utm_[a-z_]*|ref|fbclid|gclid|sessionid|sid|phpsessid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, user, ``www.``, default port, fragment and closing slash; the host in lower case,
    query parameters in order and without tracking. A null URL stays null; a text without a scheme is taken as host and path."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(plain, "^([^/?]*)", 1)), "^.*@", "")
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(plain, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(plain, r"^[^?]*\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _weak(etag: Column) -> Column:
    return F.regexp_replace(F.trim(etag), "^W/", "")


def latest_earlier(records: DataFrame, slices: int | None = None) -> DataFrame:
    """The revisits of records (id, key, at, revisit, ...) with all their columns and ``full``: the record, as a struct, of
    the latest response strictly before it, or null.

    Of responses at one time the largest id counts; a response without an id is
    none's. Revisits without a key match nothing, those without a time the
    latest response of all. slices: how many the records are cut into, else the
    session's number of shuffle partitions.
    """
    spark = records.sparkSession
    scratch = Scratch(spark, "revisits")
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fit = F.col("key").isNotNull() & (F.col("revisit") | F.col("id").isNotNull() & F.col("at").isNotNull())
    # a revisit without a time stands after all others; revisits stand before the responses of their time, so that only
    # earlier ones precede them
    placed = records.filter(fit).withColumn("when", F.struct(F.col("at").isNull().alias("late"), "at"))
    order = ["when", F.desc("revisit"), "id"]
    cut = placed.repartitionByRange(slices, "key", *order, F.monotonically_increasing_id()).withColumn("slice", F.spark_partition_id())
    cut = scratch.save("cut", cut)  # the slices of a second run might differ
    whole = F.struct(*[F.col(c) for c in records.columns])
    within = Window.partitionBy("key", "slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    near = cut.withColumn("near", F.last(F.when(~F.col("revisit"), whole), ignorenulls=True).over(within)).filter("revisit")
    ends = cut.groupBy("key", "slice").agg(F.max_by(F.when(~F.col("revisit"), whole), F.when(~F.col("revisit"), F.struct("at", "id"))).alias("newest"))
    before = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # one row for each slice
    carried = ends.withColumn("far", F.last("newest", ignorenulls=True).over(before)).filter("far IS NOT NULL").select("key", "slice", "far")
    found = near.join(carried, ["key", "slice"], "left").select(*records.columns, F.coalesce("near", "far").alias("full"))
    rest = records.filter("revisit AND key IS NULL").withColumn("full", F.lit(None).cast(found.schema["full"].dataType))
    return found.unionByName(rest)


def resolve_revisits(records: DataFrame, slices: int | None = None) -> DataFrame:
    """(id, url_key, response_id, outcome, headers, n_chars) of each revisit.

    records: id long, url string, at long (capture time), revisit boolean,
    headers map of lower-case names, n_chars long (of the body). outcome is
    ``resolved``, ``no response`` (none earlier), ``changed`` (validators
    differ) or ``no validator`` (none that both have); only resolved revisits
    have headers and n_chars of the response. A null revisit flag counts as a
    full response; null headers as none. A revisit without a time counts as later
    than every response, a response without a time or id is none's. Rows that
    repeat are each answered once. Headers and URLs of any length are compared
    whole. Other columns are ignored; an empty table gives none.
    """
    rows = records.select(
        F.col("id").cast("long").alias("id"),
        canonical_url(F.col("url")).alias("key"),
        F.col("at").cast("long").alias("at"),
        F.coalesce("revisit", F.lit(False)).alias("revisit"),
        F.coalesce("headers", F.expr("CAST(map() AS map<string,string>)")).alias("headers"),
        F.col("n_chars").cast("long").alias("n_chars"),
    )
    found = latest_earlier(rows, slices)
    both = found.select("id", F.col("key").alias("url_key"), F.col("full.id").alias("response_id"), F.col("headers").alias("new"), F.col("full.headers").alias("old"), F.col("full.n_chars").alias("n_chars"))
    tag = [F.element_at(h, "etag") for h in ("new", "old")]
    date = [F.element_at(h, "last-modified") for h in ("new", "old")]
    outcome = (
        F.when(F.col("response_id").isNull(), "no response")
        .when(tag[0].isNotNull() & tag[1].isNotNull(), F.when(_weak(tag[0]) == _weak(tag[1]), "resolved").otherwise("changed"))
        .when(date[0].isNotNull() & date[1].isNotNull(), F.when(date[0] == date[1], "resolved").otherwise("changed"))
        .otherwise("no validator")
    )
    update = F.map_filter("new", lambda k, v: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter("old", lambda k, v: ~F.array_contains(F.map_keys(update), k)), update)
    done = F.col("outcome") == "resolved"
    return both.withColumn("outcome", outcome).select(
        "id", "url_key", "response_id", "outcome", F.when(done, merged).alias("headers"), F.when(done, F.col("n_chars")).alias("n_chars")
    )


def records_of_pages(pages: DataFrame) -> DataFrame:
    """WARC-like records made of a table of pages: a response of each page and a later capture that was not modified.

    Some revisits write the URL in another form, come before their response,
    have another ETag, or have only a date. A page without an id gives records
    without id and time.
    """
    p, tag = F.col("page_id"), F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 12), F.lit('"'))
    date = F.concat(F.lit("day "), p % 28)
    response = pages.select(
        (p * 2).alias("id"), "url", (p * 10).alias("at"), F.lit(False).alias("revisit"),
        F.create_map(F.lit("etag"), tag, F.lit("last-modified"), date, F.lit("content-type"), F.lit("text/html"), F.lit("date"), F.concat(F.lit("at "), p * 10)).alias("headers"),
        F.length("html").cast("long").alias("n_chars"),
    )
    other = F.when(p % 5 == 0, F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again"))).when(p % 5 == 1, F.regexp_replace("url", "^https?://", "HTTP://www.")).otherwise(F.col("url"))
    sent = F.when(p % 13 == 0, F.lit('"other"')).when(p % 17 == 0, F.lit(None)).otherwise(F.concat(F.lit("W/"), tag))
    # absent headers are dropped from the map
    headers = F.map_filter(
        F.create_map(F.lit("etag"), sent, F.lit("last-modified"), F.when(p % 19 != 0, date), F.lit("content-type"), F.lit("text/plain"), F.lit("date"), F.concat(F.lit("at "), p * 10 + 55)),
        lambda k, v: v.isNotNull(),
    )
    late = F.when(p % 11 == 0, p * 10 - 5).otherwise(p * 10 + 55)
    revisit = pages.select((p * 2 + 1).alias("id"), other.alias("url"), late.alias("at"), F.lit(True).alias("revisit"), headers.alias("headers"), F.lit(0).cast("long").alias("n_chars"))
    return response.unionByName(revisit)


def digest(resolved: DataFrame) -> DataFrame:
    """The rows with their headers as one text, in order of the names; null for a record without an id, whose date is unknown."""
    lines = F.transform(F.array_sort(F.map_keys("headers")), lambda k: F.concat(k, F.lit(": "), F.element_at("headers", k)))
    return resolved.select("id", "url_key", "response_id", "outcome", F.when(F.col("id").isNotNull(), F.array_join(lines, "; ")).alias("headers"), "n_chars")


ORACLE_SQL = r"""
WITH made AS (
    SELECT page_id * 2 AS id, url, page_id * 10 AS t, false AS revisit, '"' || substring(md5(html), 1, 12) || '"' AS etag,
        'day ' || (page_id % 28) AS modified, length(html) AS n_chars FROM pages
    UNION ALL
    SELECT page_id * 2 + 1, CASE WHEN page_id % 5 = 0 THEN regexp_replace(url, '#.*$', '') || '#again'
        WHEN page_id % 5 = 1 THEN regexp_replace(url, '^https?://', 'HTTP://www.') ELSE url END,
        CASE WHEN page_id % 11 = 0 THEN page_id * 10 - 5 ELSE page_id * 10 + 55 END, true,
        CASE WHEN page_id % 13 = 0 THEN '"other"' WHEN page_id % 17 = 0 THEN NULL ELSE 'W/"' || substring(md5(html), 1, 12) || '"' END,
        CASE WHEN page_id % 19 <> 0 THEN 'day ' || (page_id % 28) END, 0 FROM pages),
parts AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS plain FROM made),
keyed AS (
    SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(plain, '^([^/?]*)', 1)), '^.*@', ''), ':(80|443)$', ''), '^www\.', '')
        || regexp_replace(regexp_extract(plain, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
        list_sort(list_filter(string_split(regexp_extract(plain, '^[^?]*\?(.*)$', 1), '&'), lambda p:
            p <> '' AND NOT regexp_matches(lower(p), '^(utm_[a-z_]*|ref|fbclid|gclid|sessionid|sid|phpsessid)(=|$)'))) AS q
    FROM parts),
records AS (SELECT *, place || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS url_key FROM keyed),
matched AS (
    SELECT *, last_value(CASE WHEN NOT revisit THEN id END IGNORE NULLS) OVER (
        PARTITION BY url_key ORDER BY t, revisit DESC, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS response_id FROM records),
judged AS (
    SELECT v.id, v.url_key, v.response_id, v.etag, v.modified, v.t, r.etag AS old_etag, r.modified AS old_modified, r.t AS old_t, r.n_chars,
        CASE WHEN v.response_id IS NULL THEN 'no response'
             WHEN v.etag IS NOT NULL THEN CASE WHEN regexp_replace(v.etag, '^W/', '') = r.etag THEN 'resolved' ELSE 'changed' END
             WHEN v.modified IS NOT NULL THEN CASE WHEN v.modified = r.modified THEN 'resolved' ELSE 'changed' END
             ELSE 'no validator' END AS outcome
    FROM matched v LEFT JOIN records r ON r.id = v.response_id WHERE v.revisit)
SELECT id, url_key, response_id, outcome,
    CASE WHEN outcome = 'resolved' THEN 'content-type: text/html; date: at ' || ((id - 1) // 2 * 10 + 55) || '; etag: ' || coalesce(etag, old_etag)
        || '; last-modified: ' || coalesce(modified, old_modified) END AS headers,
    CASE WHEN outcome = 'resolved' THEN n_chars END AS n_chars
FROM judged
"""
