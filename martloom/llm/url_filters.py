"""URL filters by dated lists, in DataFrame functions only.

A list is a log: from its day on, an entry blocks or allows a domain with all its
subdomains, a host, or a host with the first segments of its path, or takes such
a pattern off the list. The log of a pattern becomes validity intervals, and an
as-of join finds for every capture the entries that were active when it was
fetched. Captures of one address and day are evaluated once, however many there
are, so a host with a third of all captures is no large group in any join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds of patterns, from the widest to the most specific, and what an entry can do.
KINDS = ("domain", "host", "prefix")
ACTIONS = ("remove", "block", "allow")
# Characters of the longest name a host can have; a longer one is invalid.
LONGEST_HOST = 253
# An address in brackets holds colons; it has a group of its own.
_URL = r"^[hH][tT][tT][pP][sS]?://(?:[^/?#@]*@)?(?:\[([0-9A-Fa-f:.]+)\]|([^/?#:@\[][^/?#:@]*))(?::[0-9]*)?([^?#]*)"


def host_of(url: Column) -> Column:
    """Host of a web address in lower case, without a final dot; null if it is none.

    A bracketed IPv6 address is a host as it stands, without its brackets.
    """
    host = F.concat(F.regexp_extract(url, _URL, 1), F.regexp_extract(url, _URL, 2))
    host = F.regexp_replace(F.lower(host), r"\.$", "")
    return F.when((host != "") & (F.length(host) <= LONGEST_HOST), host)


def segments_of(url: Column) -> Column:
    """The segments of the path; empty ones are skipped."""
    return F.filter(F.split(F.regexp_extract(url, _URL, 3), "/"), lambda s: s != "")


def _depths(spans: DataFrame) -> Column:
    """The numbers of labels of domain patterns and of segments of prefix patterns that occur, one row of a subquery."""
    counts = spans.select(
        F.when(F.col("kind") == 0, F.size(F.split("pattern", r"\."))).alias("labels"),
        F.when(F.col("kind") == 2, F.size(F.split("pattern", "/")) - 1).alias("segments"),
    )
    # At most as many values as the longest pattern has parts.
    return counts.agg(F.struct(F.collect_set("labels").alias("labels"), F.collect_set("segments").alias("segments"))).scalar()


def _keys(host: Column, segments: Column, depths: Column) -> Column:
    """All patterns (kind, pattern, parts) of the given depths that match an address."""

    def key(kind: int, pattern: Column, parts: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), pattern.alias("pattern"), parts.cast("int").alias("parts"))

    labels = F.split(host, r"\.")
    count = F.size(labels)
    domains = F.transform(
        F.filter(depths["labels"], lambda n: n <= count),
        lambda n: key(0, F.array_join(F.slice(labels, -n, n), "."), n),
    )
    hosts = F.array(key(1, host, count))
    prefixes = F.transform(
        F.filter(depths["segments"], lambda n: (n > 0) & (n <= F.size(segments))),
        lambda n: key(2, F.concat_ws("/", host, F.array_join(F.slice(segments, 1, n), "/")), n),
    )
    return F.concat(domains, hosts, prefixes)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """Intervals (kind, pattern, action, valid_from, valid_to) of a log (kind, pattern, action, day).

    ``valid_to`` is exclusive and null for the last one. Of several entries for a
    pattern on a day the one that does most counts: allow, then block, then
    remove. Entries with a null or an unknown kind or action are left out. The
    host of a pattern is taken in lower case, its path as it is.
    Intervals in which a pattern is off the list are not returned.
    """
    rank = F.array_position(F.lit(list(ACTIONS)), F.col("action")).cast("int")
    kind = (F.array_position(F.lit(list(KINDS)), F.col("kind")) - 1).cast("int")
    # Hosts have no case, paths do.
    host = F.substring_index("pattern", "/", 1)
    pattern = F.concat(F.lower(host), F.substring(F.col("pattern"), F.length(host) + 1, F.length("pattern")))
    known = entries.select(kind.alias("kind"), pattern.alias("pattern"), rank.alias("rank"), F.col("day").cast("date").alias("day"))
    known = known.filter("kind >= 0 and rank > 0 and pattern is not null and day is not null")
    # One row per pattern and day at most reaches the window.
    daily = known.groupBy("kind", "pattern", "day").agg(F.max("rank").alias("rank"))
    spans = daily.selectExpr(
        "kind",
        "pattern",
        "rank",
        "day as valid_from",
        "lead(day) over (partition by kind, pattern order by day) as valid_to",
    )
    return spans.filter(F.col("rank") > 1)


def filter_urls(
    captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", day_col: str = "fetched"
) -> DataFrame:
    """One row per capture: id, url, day, host, verdict, rule_kind, rule_pattern, rule_since.

    The most specific active entry decides: a prefix over a host over a domain,
    the longer one of a kind, allow over block. Domains of any number of labels,
    one included, and prefixes of any number of segments count. ``verdict`` is ``allowed``,
    ``blocked``, ``unlisted`` if no entry is active, or ``invalid`` for a null
    url, one that is no web address or has an overlong host. A capture without a
    day has no active entries. Repeated captures repeat; an empty list leaves
    all unlisted; other columns are not read.
    """
    day = F.col(day_col).cast("date")
    given = captures.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), day.alias("day"))
    given = given.withColumn("host", host_of(F.col("url")))
    asked = given.filter("host is not null and day is not null").select("url", "host", "day").distinct()
    spans = validity_intervals(entries)
    # Keys only of the depths that the list holds, however deep they are.
    asked = asked.withColumn("depths", _depths(spans))
    keys = asked.select("url", "day", F.explode(_keys(F.col("host"), segments_of(F.col("url")), F.col("depths"))).alias("k"))
    keys = keys.select("url", "day", "k.*")
    active = (F.col("valid_from") <= F.col("day")) & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to")))
    found = keys.join(spans, ["kind", "pattern"]).filter(active)
    rule = F.max(F.struct("kind", "parts", "rank", "pattern", F.col("valid_from").alias("since"))).alias("rule")
    decided = found.groupBy("url", "day").agg(rule)
    answer = given.join(decided, ["url", "day"], "left")
    verdict = (
        F.when(F.col("host").isNull(), "invalid")
        .when(F.col("rule").isNull(), "unlisted")
        .when(F.col("rule.rank") == 3, "allowed")
        .otherwise("blocked")
    )
    return answer.select(
        F.col("id").alias(id_col),
        F.col("url").alias(url_col),
        F.col("day").alias(day_col),
        "host",
        verdict.alias("verdict"),
        F.get(F.lit(list(KINDS)), F.col("rule.kind")).alias("rule_kind"),
        F.col("rule.pattern").alias("rule_pattern"),
        F.col("rule.since").alias("rule_since"),
    )
