"""Not-modified revisits of a web archive, resolved to the response that they confirm.

Each revisit takes the latest earlier full response of its canonical URL, an
as-of join.  Time is cut into slices of equal row numbers, so that no URL, how
hot it may be, brings more than a slice of its rows to one task: the latest
response within the slice is found there, the one before it is carried over
from slice to slice.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showlake.llm.common import HOT_SHARE, join_groups, stored

#: Captures in a slice of time at most, and slices at least.
SLICE_ROWS, SLICES = 500_000, 64
#: Parameters that only track visitors, and headers that a 304 must not change (RFC 9111, 3.2, and hop-by-hop ones).
TRACKING = r"^(utm_[a-z]+|fbclid|gclid)(=|$)"
UNTOUCHED = [
    "connection",
    "content-encoding",
    "content-length",
    "content-range",
    "content-type",
    "keep-alive",
    "proxy-authenticate",
    "proxy-connection",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
]


def canonical_url(url: Column) -> Column:
    """Lower-case host without user, ``www.`` and the scheme's own port, path without closing slashes, parameters sorted; null stays null.

    http and https count as the same resource; other ports, paths and
    parameters do not, but those that only track visitors are left out.
    """
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?([^/?:]*)", 1))
    port = F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?[^/?:]*:([0-9]+)", 1)
    scheme = F.lower(F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    own = ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443")) | (port == "")
    place = F.when(own, "").otherwise(F.concat(F.lit(":"), port))
    path = F.regexp_replace(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1), "/+$", "")
    asked = F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&")
    kept = F.array_join(F.array_sort(F.filter(asked, lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    full = F.concat(F.regexp_replace(host, r"^www\.", ""), place, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))
    return F.when(host != "", full).otherwise(F.lower(bare))


def lower_names(headers: Column) -> Column:
    """Header names in lower case; of names that then agree, the last value stays."""
    entries = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.transform(
        F.array_distinct(F.transform(entries, lambda e: e["key"])),
        lambda k: F.struct(k.alias("key"), F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"].alias("value")),
    )
    return F.map_from_entries(last)


def as_of(captures: DataFrame, slices: int | None = None) -> DataFrame:
    """(record_id, source_id) of each revisit with an earlier full response of the same ``key``: the latest, then the largest id.

    ``captures`` has key, at, record_id, full and revisit; key and at are not
    null.  The number of slices follows that of the captures, so that even one
    URL's part of a slice fits a task.
    """
    slices = slices or max(SLICES, math.ceil(captures.count() / SLICE_ROWS))
    cuts = captures.agg(F.percentile_approx("at", [i / slices for i in range(1, slices)])).first()[0] or []
    bounds = F.array(*map(F.lit, sorted(set(cuts)))).cast("array<long>")
    rows = captures.withColumn("slice", F.size(F.filter(bounds, lambda b: b < F.col("at"))))
    response = F.when(F.col("full"), F.struct("at", "record_id"))
    before = Window.partitionBy("key", "slice").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    near = rows.withColumn("near", F.max(response).over(before)).filter("revisit")
    last = rows.filter("full").groupBy("key", "slice").agg(F.max(F.struct("at", "record_id")).alias("last"))
    # A row for each slice of a key, so that its revisits find what all earlier slices left.
    all_slices = rows.select("key", "slice").distinct().join(last, ["key", "slice"], "left")
    earlier = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = all_slices.select("key", "slice", F.max("last").over(earlier).alias("carried")).filter("carried is not null")
    found = near.join(carried, ["key", "slice"], "left")
    return found.select("record_id", F.coalesce("near", "carried")["record_id"].alias("source_id"))


def resolve(captures: DataFrame, slices: int | None = None) -> DataFrame:
    """``record_id, url_key, source_id, state, headers, payload, payload_md5`` of each revisit.

    ``captures``: record_id (unique), url, captured_at, status, headers (a map)
    and payload; other columns are ignored.  A capture with status 200 is a full
    response, one with 304 a revisit, others are neither.  ``state`` is

    * ``resolved``: entity tags agree (weakly), or without two of them the
      Last-Modified dates do; the response's headers are updated by those of
      the revisit that a 304 may change, its payload is taken over;
    * ``unchecked``: no validator that both have; merged all the same;
    * ``changed``: the validators differ; headers are the revisit's own;
    * ``missing``: no earlier response, or no URL or time; likewise.

    ``payload_md5`` is the digest of ``payload``.  Payloads are moved once,
    after all else is settled: that of a response which many revisits confirm
    to as many tasks as keep its revisits below ``HOT_SHARE`` of all each.
    Captures at the same moment are not earlier.  Repeated revisits give a row
    each; no revisits, no rows.
    """
    rows = captures.select(
        F.col("record_id").cast("long").alias("record_id"),
        canonical_url(F.col("url")).alias("key"),
        F.unix_micros(F.col("captured_at").cast("timestamp")).alias("at"),
        F.coalesce(F.col("status") == 200, F.lit(False)).alias("full"),
        F.coalesce(F.col("status") == 304, F.lit(False)).alias("revisit"),
        lower_names(F.coalesce("headers", F.create_map().cast("map<string,string>"))).alias("headers"),
        "payload",
    )
    bodies = rows.filter("full").select(F.col("record_id").alias("source"), "headers", "payload")
    rows = stored(rows.filter("full or revisit").drop("payload"), "warc-captures")
    places = as_of(rows.filter("key is not null and at is not null").drop("headers"), slices)
    places = stored(places.filter("source_id is not null").distinct(), "warc-places")
    used = places.groupBy("source_id").agg(F.count("*").alias("uses"))
    response = rows.filter("full").groupBy("record_id").agg(F.max(F.map_entries("headers")).alias("r"))
    sources = used.join(response, used["source_id"] == response["record_id"]).select(
        "source_id", "uses", F.map_from_entries("r").alias("old")
    )
    matched = join_groups(places, stored(sources, "warc-sources"), ["source_id"], "uses")
    revisits = rows.filter("revisit").select("record_id", F.col("key").alias("url_key"), "headers")
    both = revisits.join(matched, "record_id", "left")

    def agree(name: str, clean: str = "^$") -> Column:
        of = lambda m: F.regexp_replace(F.trim(F.get(F.map_values(F.map_filter(m, lambda k, v: k == name)), F.lit(0))), clean, "")
        return of("headers") == of("old")

    same = F.coalesce(agree("etag", "^W/"), agree("last-modified"))
    state = (
        F.when(F.col("source_id").isNull(), "missing").when(same, "resolved").when(~same, "changed").otherwise("unchecked")
    )
    fresh = F.map_filter("headers", lambda k, v: ~k.isin(UNTOUCHED))
    merged = F.map_concat(F.map_filter("old", lambda k, v: ~F.array_contains(F.map_keys(fresh), k)), fresh)
    taken = F.col("state").isin("resolved", "unchecked")
    settled = both.withColumn("state", state).select(
        "record_id",
        "url_key",
        "source_id",
        "state",
        F.when(taken, merged).otherwise(F.col("headers")).alias("headers"),
        F.when(taken, F.col("source_id")).alias("source"),
        "uses",
    )
    most = max(1, math.floor(places.count() * HOT_SHARE))
    copies = F.ceil(F.col("uses") / most)
    # Rows without a payload are dealt out as well, though they meet none.
    settled = settled.withColumn("part", F.pmod(F.xxhash64("record_id"), F.when(F.col("source").isNull(), 1 << 20).otherwise(copies)))
    hot = used.filter(F.col("uses") > most).select(F.col("source_id").alias("source"), copies.alias("copies"))
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("copies", F.lit(1)).cast("long") - 1))
    bodies = bodies.join(F.broadcast(hot), "source", "left").select("source", parts.alias("part"), "headers", "payload")
    body = F.max(F.struct(F.map_entries("headers").alias("headers"), "payload"))["payload"]
    found = settled.join(bodies.groupBy("source", "part").agg(body.alias("payload")), ["source", "part"], "left")
    return found.select("record_id", "url_key", "source_id", "state", "headers", "payload", F.md5("payload").alias("payload_md5"))


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures derived from web pages: of each page a full response, two revisits and, for every third, a revisit before it.

    The second revisit spells the URL in another way; that of every seventh
    page has another entity tag.
    """
    at = F.lit(1_700_000_000).cast("long") + F.col("page_id") * 60
    tag = F.md5(F.coalesce("html", F.lit("")))

    def record(n: int, seconds: int, status: int, url: Column, headers: dict[str, Column]) -> Column:
        pairs = [x for k, v in headers.items() for x in (F.lit(k), v)]
        return F.struct(
            (F.col("page_id") * 4 + n).alias("record_id"),
            url.alias("url"),
            F.timestamp_seconds(at + seconds).alias("captured_at"),
            F.lit(status).alias("status"),
            F.create_map(*pairs).alias("headers"),
            (F.col("html") if status == 200 else F.lit(None).cast("string")).alias("payload"),
        )

    url = F.col("url")
    spelled = F.concat(F.regexp_replace(url, "^https?://", "HTTP://www."), F.lit("#again"))
    full = {"Content-Type": F.lit("text/html"), "ETag": tag, "Date": at.cast("string"), "Server": F.lit("a")}
    again = {"ETag": F.concat(F.lit("W/"), tag), "Date": (at + 86400).cast("string"), "Content-Length": F.lit("0"), "Age": F.lit("1")}
    other = F.when(F.col("page_id") % 7 == 0, F.lit("other")).otherwise(tag)
    records = [
        record(0, 0, 200, url, full),
        record(1, 86400, 304, url, again),
        record(2, 172800, 304, spelled, {"ETag": other, "Date": (at + 172800).cast("string")}),
    ]
    early = record(3, -86400, 304, url, {"ETag": tag})
    every = F.when(F.col("page_id") % 3 == 0, F.array(*records, early)).otherwise(F.array(*records))
    return pages.select(F.explode(every).alias("c")).select("c.*")


def digest(resolved: DataFrame) -> DataFrame:
    """``record_id, url_key, source_id, state, headers, payload_md5``, headers as sorted ``name=value`` joined by bars."""
    lines = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return resolved.select(
        "record_id", "url_key", "source_id", "state", F.array_join(lines, "|").alias("headers"), "payload_md5"
    )


ORACLE = r"""
    with base as (
        select page_id, url, html, 1700000000 + page_id * 60 as t, md5(coalesce(html, '')) as tag from pages
    ), captures as (
        select page_id * 4 as id, url, t as ts, 200 as status, tag, html,
               'content-type=text/html' as kind, t as date, null as extra from base
        union all select page_id * 4 + 1, url, t + 86400, 304, tag, null, null, t + 86400, 'age=1' from base
        union all select page_id * 4 + 2, regexp_replace(url, '^https?://', 'HTTP://www.') || '#again', t + 172800, 304,
               case when page_id % 7 = 0 then 'other' else tag end, null, null, t + 172800, null from base
        union all select page_id * 4 + 3, url, t - 86400, 304, tag, null, null, null, null from base where page_id % 3 = 0
    ), bare as (
        select *, regexp_replace(trim(url), '#.*$', '') as u from captures
    ), parts as (
        select *, lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?([^/?:]*)', 1)) as host,
               lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) || ':' ||
               regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?[^/?:]*:([0-9]+)', 1) as port,
               regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', '') as path,
               array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'),
                   lambda p: p <> '' and not regexp_matches(p, '^(utm_[a-z]+|fbclid|gclid)(=|$)'))), '&') as asked
        from bare
    ), keyed as (
        select *, case when host = '' then lower(u) else regexp_replace(host, '^www\.', '') ||
               case when port in ('http:80', 'https:443') then '' else regexp_replace(regexp_extract(port, ':.*'), '^:$', '') end || path ||
               case when asked <> '' then '?' || asked else '' end end as key from parts
    ), responses as (
        select key, ts, max(id) as id, max_by(tag, id) as tag, max_by(html, id) as html, max_by(date, id) as date
        from keyed where status = 200 group by key, ts
    ), joined as (
        select r.*, s.id as source_id, s.tag as old_tag, s.html as body from (select * from keyed where status = 304) r
        asof left join responses s on r.key = s.key and r.ts > s.ts
    ), judged as (
        select *, case when source_id is null then 'missing' when tag = old_tag then 'resolved' else 'changed' end as state from joined
    )
    select id as record_id, key as url_key, source_id, state,
           case when state = 'resolved' then
                    concat_ws('|', extra, 'content-type=text/html', 'date=' || date, 'etag=' || case when id % 4 = 1 then 'W/' else '' end || tag, 'server=a')
                when id % 4 = 1 then concat_ws('|', extra, 'content-length=0', 'date=' || date, 'etag=W/' || tag)
                else concat_ws('|', 'date=' || date, 'etag=' || tag) end as headers,
           case when state = 'resolved' then md5(body) end as payload_md5
    from judged
"""
