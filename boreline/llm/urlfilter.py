"""URL lists with dates: every capture against the entries active when it was fetched.

A list is a log of dated entries (a host or a host with a path prefix, listed
or unlisted). An entry is valid from its date to the next one of its target:
the log becomes validity intervals. A capture asks for each target that could
cover it: its host, the host's parent domains, and the prefixes of its path;
of these only those that are as deep as some entry of the list.

Captures and entries meet in (target, time slot), never in a whole target: the
last entry before a slot is carried into it from a table of slots, and within
a slot one window passes the entries on to the captures. A host with a third
of all captures is so spread over its slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boreline.llm.rows import table
from boreline.session import stored

#: Width of a time slot in seconds.
SLOT = 6 * 3600


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and a trailing dot; empty where there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(host, r"\.$", "")


def path_of(url: Column) -> Column:
    """The path without query and fragment; at least a slash."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    return F.when(path == "", "/").otherwise(path)


def depths_of(target: Column) -> Column:
    """How deep an entry is: ``slashes`` in it, or none and ``labels`` of its host."""
    slashes = F.length(target) - F.length(F.replace(target, F.lit("/")))
    return F.struct(slashes.alias("slashes"), F.when(slashes == 0, F.size(F.split(target, r"\."))).otherwise(0).alias("labels"))


def asked_targets(captures: DataFrame, depths: DataFrame, url: str) -> DataFrame:
    """The captures with ``rank`` and ``target`` of what could list them, most specific first.

    That is the host with prefixes of the path, the host, and its parent
    domains of two labels at least. ``depths`` is one row, ``slashes`` and
    ``labels``, with the depths that the list has: a row for each depth, so
    that a URL of very many steps asks for no more than the list can answer.
    """
    split = captures.withColumns({"_host": host_of(F.col(url)), "_steps": F.split(path_of(F.col(url)), "/")}).withColumn("_labels", F.split("_host", r"\.")).crossJoin(F.broadcast(depths))
    last = F.size("_steps") - 1
    slashes = lambda k: k + F.when(k < last, 1).otherwise(0)
    ks = F.filter(F.sequence(last, F.lit(1), F.lit(-1)), lambda k: F.array_contains("slashes", slashes(k)))
    prefixes = F.transform(ks, lambda k: F.concat("_host", F.array_join(F.slice("_steps", F.lit(1), k + 1), "/"), F.when(k < last, "/").otherwise("")))
    own = F.filter(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("_labels") - 2)), lambda k: F.array_contains("labels", F.size("_labels") - k))
    hosts = F.transform(own, lambda k: F.array_join(F.slice("_labels", k + 1, F.size("_labels")), "."))
    targets = F.when((F.col("_host") != "") & F.col("slashes").isNotNull(), F.concat(prefixes, hosts)).otherwise(F.array().cast("array<string>"))
    named = split.select(*captures.columns, targets.alias("_targets"))
    return named.select(*captures.columns, F.posexplode_outer("_targets").alias("rank", "target"))


def intervals(entries: DataFrame) -> DataFrame:
    """``target``, ``listed``, ``valid_from``, ``valid_to`` of each entry; open ends are null.

    Entries: ``target``, ``at`` (timestamp), ``listed`` (boolean). Of several
    entries of a target at one time the listing one holds. Entries with a null
    anywhere are no entries.
    """
    slot = F.floor(F.unix_timestamp("at") / SLOT)
    known = entries.where("target is not null and at is not null and listed is not null").groupBy("target", "at").agg(F.max("listed").alias("listed")).withColumn("slot", slot)
    inside = Window.partitionBy("target", "slot").orderBy("at")
    first = known.groupBy("target", "slot").agg(F.min("at").alias("first"))
    ahead = stored(first.withColumn("following", F.lead("first").over(Window.partitionBy("target").orderBy("slot"))).drop("first"), "list-slots")
    out = known.withColumn("behind", F.lead("at").over(inside)).join(ahead, ["target", "slot"])
    return out.select("target", "listed", F.col("at").alias("valid_from"), F.coalesce("behind", "following").alias("valid_to"))


def judge(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url", fetched: str = "fetched_at") -> DataFrame:
    """``key``, ``blocked``, ``matched`` (the most specific listed target), ``listed_since`` and ``active`` (how many are listed).

    One row per key. A capture without URL, host or time matches nothing and
    is not blocked. Repeated rows count once if they are equal; of rows that
    share a key but differ, every match counts. An entry is active from its
    own time on, that instant included.
    """
    valid = stored(intervals(entries), "list-intervals")
    deep = valid.select(depths_of(F.col("target")).alias("d")).agg(F.collect_set("d.slashes").alias("slashes"), F.collect_set("d.labels").alias("labels"))
    asked = asked_targets(captures.select(F.col(key).alias("key"), F.col(fetched).alias("at"), F.col(url).alias("url")), deep, "url").drop("url")
    asked = stored(asked.withColumn("slot", F.floor(F.unix_timestamp("at") / SLOT)), "captures")

    log = valid.withColumn("slot", F.floor(F.unix_timestamp("valid_from") / SLOT))
    last = log.groupBy("target", "slot").agg(F.max_by(F.struct("valid_from", "listed", "valid_to"), "valid_from").alias("last"))
    # Per target only its slots are put in order: a row per slot, not per capture.
    needed = asked.where("slot is not null").select("target", "slot").distinct().join(last.select("target").distinct(), "target", "left_semi")
    slots = last.join(needed, ["target", "slot"], "full")
    before = Window.partitionBy("target").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.select("target", "slot", F.last("last", ignorenulls=True).over(before).alias("carried"))
    carried = stored(carried.where("carried is not null"), "carried")

    opening = carried.select("target", "slot", F.lit(None).cast(asked.schema["key"].dataType).alias("key"), F.lit(None).cast("int").alias("rank"), F.col("carried.valid_from").alias("at"), F.col("carried").alias("entry"), F.lit(0).alias("turn"))
    own = log.select("target", "slot", F.lit(None).cast(asked.schema["key"].dataType).alias("key"), F.lit(None).cast("int").alias("rank"), F.col("valid_from").alias("at"), F.struct("valid_from", "listed", "valid_to").alias("entry"), F.lit(0).alias("turn"))
    query = asked.where("target is not null and slot is not null").select("target", "slot", "key", "rank", "at", F.lit(None).cast(own.schema["entry"].dataType).alias("entry"), F.lit(1).alias("turn"))
    met = opening.unionByName(own).unionByName(query)
    order = Window.partitionBy("target", "slot").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, 0)
    hit = met.withColumn("now", F.last("entry", ignorenulls=True).over(order)).where("turn = 1 and now.listed and (now.valid_to is null or at < now.valid_to)")
    best = hit.select("key", F.struct("rank", "target", F.col("now.valid_from").alias("since")).alias("match")).groupBy("key").agg(F.min("match").alias("match"), F.countDistinct("match.target").alias("active"))
    every = captures.select(F.col(key).alias("key")).distinct()
    return every.join(best, every["key"].eqNullSafe(best["key"]), "left").select(
        every["key"].alias(key), F.col("match").isNotNull().alias("blocked"), F.col("match.target").alias("matched"), F.col("match.since").alias("listed_since"), F.coalesce("active", F.lit(0)).cast("bigint").alias("active")
    )


def capture_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Captures and a dated list, derived from the tables.

    A page was fetched when the event of its number happened (or, beyond the
    events, at the last one). An event's user is the page whose host or first
    path prefix it lists (``error``, ``click``) or unlists (all other types).
    """
    pages, events = table(spark, sf_dir, "pages"), table(spark, sf_dir, "events")
    end = events.agg(F.max("ts")).first()[0]
    times = events.groupBy("event_id").agg(F.min("ts").alias("ts"))
    captures = pages.select("page_id", "url").join(times, F.col("page_id") == F.col("event_id"), "left").select("page_id", "url", F.coalesce("ts", F.lit(end)).alias("fetched_at"))
    host = pages.select(F.col("page_id").alias("user_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    log = events.select("user_id", "ts", "event_type").join(host, "user_id").where("host != ''")
    target = F.when(F.col("event_type") == "click", F.concat("host", F.lit("/"), F.split_part("path", F.lit("/"), F.lit(2)), F.lit("/"))).otherwise(F.col("host"))
    return captures, log.select(target.alias("target"), F.col("ts").alias("at"), F.col("event_type").isin("error", "click").alias("listed"))


def op10_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures, entries = capture_log(spark, sf_dir)
    return judge(captures, entries)


#: The same as plain joins; a target of a URL is its host, a parent domain, or the host with a prefix of the path.
ORACLE = r"""
WITH parts AS (
  SELECT page_id, url, regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '\.$', '') AS host,
         CASE WHEN regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) END AS path
  FROM pages),
times AS (SELECT event_id, min(ts) AS ts FROM events GROUP BY 1),
fetched AS (
  SELECT p.page_id, p.host, p.path, coalesce(t.ts, (SELECT max(ts) FROM events)) AS moment
  FROM parts p LEFT JOIN times t ON p.page_id = t.event_id),
log AS (
  SELECT CASE WHEN event_type = 'click' THEN host || '/' || split_part(path, '/', 2) || '/' ELSE host END AS target, e.ts AS moment, max(event_type IN ('error', 'click')) AS listed
  FROM events e JOIN parts p ON e.user_id = p.page_id WHERE host <> '' GROUP BY 1, 2),
valid AS (SELECT target, listed, moment AS valid_from, lead(moment) OVER (PARTITION BY target ORDER BY moment) AS valid_to FROM log),
steps AS (SELECT *, string_split(path, '/') AS s, string_split(host, '.') AS l FROM fetched WHERE host <> ''),
asked AS (
  SELECT page_id, moment, host || array_to_string(s[1:k + 1], '/') || CASE WHEN len(s) > k + 1 THEN '/' ELSE '' END AS target, -k AS rank FROM (SELECT *, unnest(range(1, len(s))) AS k FROM steps)
  UNION ALL SELECT page_id, moment, host, 0 FROM steps
  UNION ALL SELECT page_id, moment, array_to_string(l[k + 1:], '.'), k FROM (SELECT *, unnest(range(1, len(l) - 1)) AS k FROM steps)),
hits AS (
  SELECT a.page_id, a.target, a.rank, v.valid_from FROM asked a JOIN valid v ON a.target = v.target
  WHERE v.listed AND a.moment >= v.valid_from AND (v.valid_to IS NULL OR a.moment < v.valid_to)),
best AS (SELECT page_id, arg_min(target, rank) AS matched, arg_min(valid_from, rank) AS listed_since, count(DISTINCT target) AS active FROM hits GROUP BY 1)
SELECT DISTINCT p.page_id, b.page_id IS NOT NULL AS blocked, b.matched, b.listed_since, coalesce(b.active, 0) AS active
FROM pages p LEFT JOIN best b ON p.page_id = b.page_id
"""
