"""Small arithmetic and extraction expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wilson(hits: Column, n: Column, z: float = 1.96) -> Column:
    """struct(low, high): Wilson score interval of a share, within 0..1; (0, 0) for no trials."""
    p, zz = hits / n, z * z
    centre, spread = (p + zz / (2 * n)) / (1 + zz / n), z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n)) / (1 + zz / n)
    low, high = F.greatest(F.lit(0.0), centre - spread), F.least(F.lit(1.0), centre + spread)
    none = n <= 0
    return F.struct(F.when(none, 0.0).otherwise(low).alias("low"), F.when(none, 0.0).otherwise(high).alias("high"))


def release_year(released: Column) -> Column:
    """Year of a date that starts with four digits, as smallint; else null."""
    return F.when(released.rlike("^[0-9]{4}"), F.substring(released, 1, 4).cast("smallint"))


def readable_bytes(n: Column) -> Column:
    """Bytes with a unit of 1024 steps; a half is rounded to the even digit."""
    out = F.format_string("%.1f GB", F.bround(n / float(1 << 30), 1))
    for unit, step in (("MB", 1 << 30), ("kB", 1 << 20)):
        out = F.when(n < step, F.format_string(f"%.1f {unit}", F.bround(n / float(step >> 10), 1))).otherwise(out)
    return F.when(n < 1024, F.concat(n.cast("string"), F.lit(" bytes"))).otherwise(out)


def fresh(attempted_at: Column, ttl_seconds: Column, now: Column) -> Column:
    """Whether a stamp is still within its time to live."""
    return attempted_at + F.make_interval(secs=ttl_seconds) > now


def redact_dsn(dsn: Column) -> Column:
    """``host[:port]/database`` of a connection string, URL or keywords, with placeholders for what it leaves open; never a credential."""
    empty = lambda c, other: F.coalesce(F.nullif(c, F.lit("")), F.lit(other))
    url = F.concat(
        empty(F.regexp_extract(dsn, r"^[a-z]+://(?:[^/@]*@)?([^/?]*)", 1), "<local socket>"), F.lit("/"), empty(F.regexp_extract(dsn, r"^[a-z]+://[^/]*/([^?]*)", 1), "<default db>")
    )
    word = lambda key: F.regexp_extract(dsn, rf"(?:^|\s){key}\s*=\s*(\S+)", 1)
    port = F.when(word("port") != "", F.concat(F.lit(":"), word("port"))).otherwise("")
    keywords = F.concat(empty(word("host"), "<local socket>"), port, F.lit("/"), empty(word("dbname"), "<default db>"))
    return F.when(dsn.rlike("^[a-z]+://"), url).when(dsn.rlike(r"^\s*\w+\s*=\s*\S+"), keywords).otherwise("<unparseable>")
