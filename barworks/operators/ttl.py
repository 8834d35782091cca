"""A keyed cache with expiry as a table of writes (K1-K3): the newest write per key counts."""

from pyspark.sql import functions as F

from barworks.operators.rows import keep_first

TTL_SECONDS = 3600
MAX_AGE_SECONDS = 86400


def ttl_row(key, data, now, ttl=TTL_SECONDS):
    """Columns of one cache write."""
    written = F.lit(now).cast("timestamp")
    return [key.alias("key"), data.alias("data"), written.alias("written_at"),
            (written + F.make_dt_interval(secs=F.lit(ttl))).alias("expires_at")]


def ttl_latest(writes):
    """K1: one row per key, the newest; a key with very many writes shrinks before the shuffle."""
    ties = [F.col("written_at").desc(), F.col("expires_at").desc(), F.col("data").desc()]
    return keep_first(writes, ties, ("key",))


def ttl_upsert(cache, rows):
    """K1: insert or replace by key."""
    return ttl_latest(cache.unionByName(rows))


def ttl_get(cache, as_of):
    """K2: the live value of each key."""
    return ttl_latest(cache).where(F.col("expires_at") > F.lit(as_of).cast("timestamp"))


def ttl_cleanup(cache, as_of, max_age=MAX_AGE_SECONDS):
    """K3: the newest writes, without those expired or older than `max_age`."""
    now = F.lit(as_of).cast("timestamp")
    oldest = now - F.make_dt_interval(secs=F.lit(max_age))
    return ttl_latest(cache).where((F.col("expires_at") >= now) & (F.col("written_at") >= oldest))
