"""Secrets with corpus-wide ownership frequency, in built-in functions only.

Candidates are matched in every text. The hash of each candidate value is counted over distinct owners and
repositories of the whole corpus: values that many owners hold are copied examples, values of few owners
with enough character variety look live. Base spans (``assign access hex``) are always reported; spans of
the added kind ``other`` only where they look live.

Counting is algebraic: distinct (value, owner, repository), then repositories by (value, owner), then both
by value, each with a partial sum before its shuffle, so a value in a third of all rows stays cheap.

Null and empty texts give no spans. A null owner or repository counts as one unnamed one. Repeated rows are
handled row by row. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch
from .native_spans import add_spans, joined

BASE = ("assign", "access", "hex")
PATTERNS = {
    "assign": r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]{16,}+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
    "other": r"gh[pousr]_[A-Za-z0-9]{36,255}|xox[baprs]-[A-Za-z0-9-]{10,255}|AIza[A-Za-z0-9_-]{35}|"
             r"sk_live_[A-Za-z0-9]{16,255}|eyJ[A-Za-z0-9_-]{8,4096}\.eyJ[A-Za-z0-9_-]{8,4096}\.[A-Za-z0-9_-]{8,4096}|"
             r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----",
}
#: A value of this many owners or more is a copied example.
COPIED_OWNERS = 3
#: A live-looking value has at least this many different characters.
LEAST_VARIETY = 8
# Words that mark a value as a placeholder.
PLACEHOLDER = r"(?i)example|sample|changeme|your|dummy|placeholder|xxxx|0000000000|1234567890"


def _hashed(kind: str, rank: int, spans: Column) -> Column:
    """Spans of a kind with the hash and variety of the secret value."""
    field = "part" if kind == "assign" else "value"
    if kind == "assign":
        spans = F.filter(spans, lambda x: F.length(x["part"]) >= 6)
    return F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end"),
        F.sha2(x[field], 256).alias("hash"),
        ((F.size(F.array_distinct(F.transform(F.split(x[field], ""), F.ascii))) >= LEAST_VARIETY)
         & ~x[field].rlike(PLACEHOLDER))
        .alias("varied")))


def candidates(df: DataFrame, text: str = "text", out: str = "secret_candidates") -> DataFrame:
    """Add ``out``: every candidate span with kind and hash of its value, by start, then kind."""
    df = df.withColumn("__sec_text", F.coalesce(F.col(text).cast("string"), F.lit("")))
    body = F.col("__sec_text")
    wanted = {
        "assign": body.rlike(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"),
        "access": body.contains("AKIA"),
        "hex": F.lit(True),
        "other": body.rlike(r"gh[pousr]_|xox[baprs]-|AIza|sk_live_|eyJ|PRIVATE KEY"),
    }
    parts = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        name = f"__sec_{kind}"
        df = add_spans(df, name, "__sec_text", pattern, wanted[kind], part=2 if kind == "assign" else None)
        parts.append(_hashed(kind, rank, F.col(name)))
    return (df.withColumn(out, F.array_sort(F.concat(*parts)))
            .drop("__sec_text", *(f"__sec_{k}" for k in PATTERNS)))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, owner, repository) rows to (hash, owners, repositories), exact over the whole corpus."""
    return (found.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
            .groupBy("hash", "owner").agg(F.sum("one").alias("repositories"))
            .groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories")))


def scan(df: DataFrame, owner: Column, repository: Column, text: str = "text",
         keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per input row: ``keep`` columns and ``spans`` with kind, start, end, owners, repositories, live.

    The scan of the texts is written once; ownership is counted and joined over the narrow spans alone.
    """
    rows = candidates(df.select(*keep, text, owner.cast("string").alias("__sec_owner"),
                                repository.cast("string").alias("__sec_repo")), text)
    rows = rows.select(*keep, F.monotonically_increasing_id().alias("__sec_row"), "__sec_owner", "__sec_repo",
                       F.col("secret_candidates").alias("__sec_spans"))
    rows = scratch(rows, "secret-spans")
    each = rows.where(F.size("__sec_spans") > 0).select(
        "__sec_row", F.col("__sec_owner").alias("owner"), F.col("__sec_repo").alias("repository"),
        F.posexplode("__sec_spans").alias("pos", "s")).select(
        "__sec_row", "owner", "repository", "pos", F.col("s.hash").alias("hash"), F.col("s.varied").alias("varied"),
        F.col("s.kind").alias("kind"), F.col("s.start").alias("start"), F.col("s.end").alias("end"))
    counts = scratch(ownership(each), "secret-owners")
    judged = each.join(counts, "hash").withColumn(
        "live", (F.col("owners") < COPIED_OWNERS) & F.col("varied"))
    spans = judged.groupBy("__sec_row").agg(F.array_sort(F.collect_list(F.struct(
        "pos", "kind", "start", "end", "hash", "owners", "repositories", "live"))).alias("spans"))
    return rows.drop("__sec_owner", "__sec_repo", "__sec_spans").join(spans, "__sec_row", "left").drop("__sec_row")


def digest(found: DataFrame) -> DataFrame:
    """One row per document from ``scan``: base counts and digest, all reported spans, verdict counts."""
    base = F.filter(F.col("spans"), lambda x: x["kind"].isin(*BASE))
    kept = F.filter(F.col("spans"), lambda x: x["kind"].isin(*BASE) | x["live"])

    def size(test) -> Column:
        return F.coalesce(F.size(F.filter(F.col("spans"), test)), F.lit(0)).cast("long")

    def kind_is(kind: str):
        return lambda x: x["kind"] == kind

    blank = F.lit("")
    return found.select(
        "doc_id", *(size(kind_is(k)).alias(f"n_{k}") for k in BASE),
        F.sha2(F.coalesce(joined(base), blank), 256).alias("base_sha256"),
        F.coalesce(joined(kept), blank).alias("spans"),
        size(lambda x: x["live"]).alias("n_live"),
        size(lambda x: x["owners"] >= COPIED_OWNERS).alias("n_copied"))
