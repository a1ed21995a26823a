"""Joining a large frame to a side that is expected to be small.

The small side (issue list, keyword map, entity list) is broadcast only after its rows
and bytes have been proven to be within a bound; past the bound the join
falls back to a salted shuffle join, so a hot key (a category that holds a third
of all posts, say) is spread over ``salt_buckets`` tasks instead of one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# what a broadcast side may hold: rows, and bytes of their values as text
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 << 20


def within_rows(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows. Reads at most max_rows + 1."""
    return df.limit(max_rows + 1).count() <= max_rows


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                   max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows of at most ``max_bytes`` in all. Reads
    at most max_rows + 1 rows."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    n, total = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return n <= max_rows and total <= max_bytes


def join_small(big: DataFrame, small: DataFrame, on: list[str] | str, how: str = "left",
               max_broadcast_rows: int = MAX_BROADCAST_ROWS, salt_buckets: int = 64,
               salt_cols: list[str] | None = None) -> DataFrame:
    """``big.join(small, on, how)`` without shuffling ``big`` on a skewed key.

    ``how`` is "left" or "inner". Broadcast when ``small`` is proven small;
    otherwise replicate ``small`` over ``salt_buckets`` salts and give each big row
    a deterministic salt from a hash of its own columns (stable under task retry).
    """
    on = [on] if isinstance(on, str) else list(on)
    if how not in ("left", "inner"):
        raise ValueError("join_small supports left and inner joins")
    if fits_broadcast(small, max_broadcast_rows):
        return big.join(F.broadcast(small), on, how)
    # a deterministic salt from the row itself; the record link when there is
    # one (short), rather than hashing long text columns
    cols = salt_cols or (["link"] if "link" in big.columns else big.columns)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*cols), F.lit(salt_buckets)))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
    return salted.join(copies, on + ["_salt"], how).drop("_salt")
