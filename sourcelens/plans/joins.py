"""Join helpers for small dimension sides and hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sourcelens.session import checkpoint

# A side is broadcast only after a bounded count proves it has at most this many rows.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 << 20


def _row_bytes(df: DataFrame):
    """Approximate bytes of a row: text length for strings, JSON length for nested values."""
    from pyspark.sql import types as Ty

    parts = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (Ty.StringType, Ty.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (Ty.ArrayType, Ty.MapType, Ty.StructType, Ty.VariantType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
        else:
            parts.append(F.lit(8))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def fits_broadcast(df: DataFrame, max_rows: int | None = None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    Counts a fully pruned projection (no column is computed) and stops past the bound,
    so rejecting a large side costs little.
    """
    max_rows = BROADCAST_MAX_ROWS if max_rows is None else max_rows
    return df.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows


def join_dimension(fact: DataFrame, dim: DataFrame, keys: list[str], how: str = "left",
                   max_rows: int | None = None, salt_by: list[str] | None = None) -> DataFrame:
    """Join a fact side to a dimension side with at most one row per key.

    Broadcast when the dimension is proven small. Otherwise hot keys (say one project
    holding a third of all files) are split by ``join_hot_keys``.
    """
    dim, small = small_side(dim, max_rows)
    if small:
        return fact.join(F.broadcast(dim), keys, how)
    return join_hot_keys(fact, dim, keys, how, salt_by=salt_by)


def small_side(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None,
               materialize: bool = True) -> tuple[DataFrame, bool]:
    """Say whether a side may be broadcast.

    1. rows: a bounded count of a pruned projection; a large side is rejected here and
       stays a lazy plan (never written anywhere);
    2. bytes: a side small in rows is materialised once in the shared checkpoint dir
       (unless ``materialize=False`` for sides that are cheap to recompute) and its
       measured size must stay under ``max_bytes`` (wide rows such as whole files).
    """
    max_bytes = BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
    if not fits_broadcast(df, max_rows):
        return df, False
    if materialize:  # expensive to recompute: keep the small result
        df = checkpoint(df)
    size = df.agg(F.sum(_row_bytes(df))).first()[0] or 0
    return df, size <= max_bytes


def join_small(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner",
               max_rows: int | None = None, known_small: bool | None = None) -> DataFrame:
    """Join a large table to a request side (``big`` on the left).

    A request side proven small (bounded count) is broadcast, so the large side is
    filtered where it is read and never shuffled; otherwise it is an ordinary shuffle
    join and AQE splits skewed keys. ``known_small`` passes on a bound the caller has
    already proven (e.g. every request side of a round is at most the round's calls).
    """
    if known_small is None:
        small, known_small = small_side(small, max_rows)
    return big.join(F.broadcast(small) if known_small else small, keys, how)


# Keys with more fact rows than this are salted by ``join_hot_keys``, one salt for so many rows.
HOT_KEY_ROWS = 100_000


def hot_keys(fact: DataFrame, keys: list[str], hot_rows: int | None = None) -> DataFrame:
    """Keys with more than ``hot_rows`` fact rows and their number of salts, one for so many rows.

    One aggregation pass with map-side partial counts, written once.
    """
    hot_rows = HOT_KEY_ROWS if hot_rows is None else hot_rows
    counts = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    return checkpoint(counts.select(*keys, F.ceil(F.col("_n") / hot_rows).cast("bigint").alias("_salts")))


def join_hot_keys(fact: DataFrame, dim: DataFrame, keys: list[str], how: str = "inner",
                  hot_rows: int | None = None, salt_by: list[str] | None = None, hot: DataFrame | None = None) -> DataFrame:
    """Join a fact side whose keys may be hot to a dimension side with one row per key.

    Hot keys (``hot_keys``, or the list given) are salted by their own count: a key's fact
    rows spread over one task per ``hot_rows`` by a hash of ``salt_by`` and its dimension row
    is copied as often. All other keys join as usual, so results are exact for every key. The
    list is broadcast when it is proven small, joined by a shuffle otherwise.
    """
    if hot is None:
        hot = hot_keys(fact, keys, hot_rows)
    if hot.isEmpty():
        return fact.join(dim, keys, how)
    if fits_broadcast(hot):
        hot = F.broadcast(hot)
    salt_cols = salt_by or [c for c in fact.columns if c not in keys] or fact.columns
    one = F.coalesce("_salts", F.lit(1).cast("bigint"))
    f = fact.join(hot, keys, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*[F.col(c) for c in salt_cols]), one)).drop("_salts")
    d = dim.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), one - 1))).drop("_salts")
    return f.join(d, keys + ["_salt"], how).drop("_salt")
