"""URL filters as a temporal join: every capture against the list entries active when it was fetched.

A list is a history: a pattern is added at one time and removed at another, perhaps more than once.
Entries become validity intervals; a capture asks for the patterns its URL can match (its host, every
domain above it, every leading part of its path) and an as-of join keeps those whose interval holds
the fetch time. All of it is DataFrame operations: equi-joins with an interval condition, no range
join, no Python. A host with a third of all captures makes one large join key, which adaptive
execution splits, because both sides of the join come straight from a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import cut, fresh

HOST, DOMAIN, PREFIX = "host", "domain", "prefix"
ADD, REMOVE = "add", "remove"

_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:\[]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """The host in lower case, without user, port and a dot at the end; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, _AUTHORITY, 1)), r"\.$", "")


def segments_of(url: Column) -> Column:
    """The parts of the path that are not empty."""
    return F.filter(F.split(F.regexp_extract(url, _PATH, 1), "/"), lambda s: s != "")


def domain_of(host: Column, labels: int = 2) -> Column:
    """The last ``labels`` labels of a host."""
    return F.substring_index(host, ".", -labels)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """Rows (list, kind, pattern, starts, ends) from dated entries (list, kind, pattern, action, at).

    A pattern is active from an entry that adds it to the next that removes it, without that moment;
    ``ends`` is null while nobody has removed it. Entries that say what holds already change nothing;
    of an addition and a removal at one moment the addition counts. Entries with a null are left out.
    """
    whole = entries.dropna(subset=["list", "kind", "pattern", "action", "at"]).where(F.col("action").isin(ADD, REMOVE))
    moments = whole.groupBy("list", "kind", "pattern", "at").agg(F.max((F.col("action") == ADD).cast("int")).alias("active"))
    history = Window.partitionBy("list", "kind", "pattern").orderBy("at")
    changes = moments.withColumn("was", F.lag("active", 1, 0).over(history)).where(F.col("active") != F.col("was"))
    spans = changes.withColumn("ends", F.lead("at").over(history))
    return spans.where(F.col("active") == 1).select("list", "kind", "pattern", F.col("at").alias("starts"), "ends")


def _patterns(url: Column, labels: int, segments: int) -> Column:
    """What a URL can match: (kind, pattern), with at most so many labels of a domain and segments of a path.

    Deeper ones than any list has could match nothing.
    """
    host = host_of(url)
    names = F.split(host, r"\.")
    parts = segments_of(url)
    domain = F.transform(
        F.sequence(F.lit(1), F.least(F.size(names), F.lit(labels))),
        lambda n: F.struct(F.lit(DOMAIN).alias("kind"), F.array_join(F.slice(names, -n, n), ".").alias("pattern")),
    )
    prefix = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(segments))),
        lambda n: F.struct(F.lit(PREFIX).alias("kind"), F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, n), "/")).alias("pattern")),
    )
    none = F.array().cast("array<struct<kind:string,pattern:string>>")
    one = F.array(F.struct(F.lit(HOST).alias("kind"), host.alias("pattern")))
    some = F.concat(one, domain if labels else none, F.when(F.size(parts) > 0, prefix).otherwise(none) if segments else none)
    return F.when(host != "", some).otherwise(none)


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_at", allow: tuple[str, ...] = ("allow",), lists: str = "lists", allowed: str = "allowed", blocked: str = "blocked") -> DataFrame:
    """``captures`` with the lists that hold them at their fetch time and what follows.

    ``lists``: names of active block lists that match, rising; ``allowed``: whether a list of ``allow``
    matches; ``blocked``: whether a block list does and no allow list. Patterns of kind ``host`` match
    that host, ``domain`` also all hosts below it, ``prefix`` ("host/part/part") URLs whose path begins
    with these parts. Hosts are compared in lower case, paths as they are, query and fragment not at
    all. A capture without URL or fetch time is not judged: its three values are null; a URL without a
    host matches nothing. Rows stay as they are, also repeated ones; other columns pass through and
    columns already called like the new ones are replaced. Without entries nothing is blocked; an
    empty table gives an empty table.
    """
    spans = cut(validity_intervals(entries))
    depth = spans.agg(
        F.max(F.when(F.col("kind") == DOMAIN, F.size(F.split("pattern", r"\.")))).alias("labels"),
        F.max(F.when(F.col("kind") == PREFIX, F.size(F.split("pattern", "/")) - 1)).alias("segments"),
    ).first()
    u, t, held_lists = fresh(captures, "url", "time", "held")
    asked = captures.select(F.col(url).alias(u), F.col(fetched).alias(t)).dropna().distinct()
    wanted = asked.withColumn("_p", F.explode(_patterns(F.col(u), depth["labels"] or 0, depth["segments"] or 0)))
    wanted = wanted.select(u, t, F.col("_p.kind").alias("kind"), F.col("_p.pattern").alias("pattern"))
    active = (F.col(t) >= F.col("starts")) & (F.col("ends").isNull() | (F.col(t) < F.col("ends")))
    held = wanted.join(spans, ["kind", "pattern"]).where(active).groupBy(u, t).agg(F.array_sort(F.collect_set("list")).alias(held_lists))
    named = captures.join(cut(held), (F.col(url) == F.col(u)) & (F.col(fetched) == F.col(t)), "left").drop(u, t)
    known = F.col(url).isNotNull() & F.col(fetched).isNotNull()
    all_held = F.coalesce(held_lists, F.array().cast("array<string>"))
    let = F.lit(list(allow)) if allow else F.array().cast("array<string>")
    out = named.withColumns(
        {
            lists: F.when(known, F.array_except(all_held, let)),
            allowed: F.when(known, F.arrays_overlap(all_held, let)),
        }
    )
    return out.withColumn(blocked, ~F.col(allowed) & (F.size(lists) > 0)).drop(held_lists)
