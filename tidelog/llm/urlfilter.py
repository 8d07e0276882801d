"""URL filters whose lists change over time (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidelog.llm.common import attach, table

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^/?#]*)"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST, 1))


def keys(url: Column) -> Column:
    """What a list may name a url by: its host, all parent domains, and host with first path step."""
    labels = F.split(host(url), r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, i, F.size(labels)), "."))
    )
    named = F.array(F.concat(F.lit("host:"), host(url)), F.concat(F.lit("prefix:"), host(url), F.regexp_extract(url, PATH, 1)))
    return F.when(host(url) != "", F.array_distinct(F.concat(named, domains))).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """``key, since, until`` in which a list entry holds; ``until`` is null if it still does.

    ``entries`` are ``key, action, listed`` with action ``add`` or ``remove``. An entry holds
    from its date on, until the next change; of changes on one date a removal wins. Rows
    with a null in any of the three are no entries.
    """
    clean = entries.select("key", "action", "listed").filter("key is not null and listed is not null and action in ('add', 'remove')")
    daily = clean.groupBy("key", "listed").agg(F.max("action").alias("action"))  # 'remove' sorts last
    order = Window.partitionBy("key").orderBy("listed")
    return (
        daily.withColumn("until", F.lead("listed").over(order)).filter("action = 'add'")
        .select("key", F.col("listed").alias("since"), "until")
    )


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures (page_id, url, fetched)`` with ``blocked, n_rules, rule``.

    A capture is blocked by the entries that held when it was fetched; ``rule`` is the first
    of them in order, null if there is none. A null or unreadable url, or a null time, is
    never blocked; repeated captures repeat; other columns are ignored.
    """
    held = intervals(entries)
    rows = captures.select("page_id", "url", "fetched")
    # Captures that are alike are judged once, so a hot url costs one row per task.
    each = rows.filter("url is not null and fetched is not null").select("url", "fetched").distinct()
    spread = each.select("url", "fetched", F.explode(keys(F.col("url"))).alias("key"))
    found = attach(spread, held, ["key"]).filter("since <= fetched and (until is null or fetched < until)")
    verdicts = found.groupBy("url", "fetched").agg(F.count("*").alias("n_rules"), F.min("key").alias("rule"))
    return rows.join(verdicts, ["url", "fetched"], "left").select(
        "page_id", "url", "fetched", F.col("rule").isNotNull().alias("blocked"), F.coalesce("n_rules", F.lit(0)).cast("long").alias("n_rules"), "rule"
    )


def _draw(column: str, at: int) -> Column:
    return F.conv(F.substring(F.md5(F.col(column)), at, 4), 16, 10).cast("int")


def listed(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts, domains and paths of ``pages``: added, taken off, added again."""
    named = pages.filter("url is not null").select(F.explode(keys(F.col("url"))).alias("key")).distinct()
    some = named.filter(_draw("key", 1) % 5 == 0).filter(F.size(F.split("key", r"\.")) > 2)
    start = F.date_add(F.lit("2024-01-01").cast("date"), _draw("key", 5) % 200)
    return some.select(
        "key",
        F.explode(F.array(
            F.struct(F.lit("add").alias("action"), start.alias("listed")),
            F.struct(F.lit("remove").alias("action"), F.date_add(start, 1 + _draw("key", 9) % 90).alias("listed")),
            F.struct(F.lit("add").alias("action"), F.date_add(start, 120).alias("listed")),
        )).alias("e"),
    ).select("key", "e.action", "e.listed")


def fetched(pages: DataFrame) -> DataFrame:
    """The captures of ``pages``, with a time of fetching drawn from ``page_id``."""
    day = F.pmod(F.col("page_id"), F.lit(366)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), day).alias("fetched"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge(fetched(pages), listed(pages)).withColumn("fetched", F.col("fetched").cast("string"))


SQL = r"""
WITH captures AS (SELECT page_id, url, DATE '2024-01-01' + (page_id % 366)::INT AS fetched FROM pages),
hosts AS (
  SELECT url, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^/?#]*)', 1) AS step FROM (SELECT DISTINCT url FROM pages WHERE url IS NOT NULL)),
keyed AS (
  SELECT url, 'host:' || host AS key FROM hosts WHERE host <> ''
  UNION SELECT url, 'prefix:' || host || step FROM hosts WHERE host <> ''
  UNION SELECT url, 'domain:' || array_to_string(labels[i:], '.') FROM (
    SELECT url, labels, unnest(range(1, len(labels) + 1)) AS i FROM (SELECT url, string_split(host, '.') AS labels FROM hosts WHERE host <> ''))),
picked AS (
  SELECT key, DATE '2024-01-01' + (('0x' || substr(md5(key), 5, 4))::INT % 200) AS start, ('0x' || substr(md5(key), 9, 4))::INT AS draw
  FROM (SELECT DISTINCT key FROM keyed) WHERE ('0x' || substr(md5(key), 1, 4))::INT % 5 = 0 AND len(string_split(key, '.')) > 2),
entries AS (
  SELECT key, 'add' AS action, start AS listed FROM picked UNION ALL SELECT key, 'remove', start + 1 + draw % 90 FROM picked
  UNION ALL SELECT key, 'add', start + 120 FROM picked),
events AS (SELECT key, listed, max(action) AS action FROM entries GROUP BY key, listed),
held AS (SELECT * FROM (SELECT key, action, listed AS since, lead(listed) OVER (PARTITION BY key ORDER BY listed) AS until FROM events) WHERE action = 'add'),
verdicts AS (
  SELECT c.url, c.fetched, count(*) AS n_rules, min(key) AS rule
  FROM (SELECT DISTINCT url, fetched FROM captures) c JOIN keyed USING (url) JOIN held USING (key)
  WHERE since <= fetched AND (until IS NULL OR fetched < until) GROUP BY ALL)
SELECT page_id, url, fetched::VARCHAR AS fetched, rule IS NOT NULL AS blocked, coalesce(n_rules, 0)::BIGINT AS n_rules, rule
FROM captures LEFT JOIN verdicts USING (url, fetched)
"""
