"""Secret scan with corpus-wide ownership frequency (operator 9). DataFrame functions only.

One pass over the texts writes a narrow table of matches (gap before it, match)
in the shared folder; positions, ownership and verdicts are computed from that.
A candidate value is known by its SHA-256. Values that more than `max_owners`
owners hold, or several owners in more than `max_repositories` repositories, are
widely copied examples; the others look live, also one owner's value however
often it stands. Live values that no base pattern covers add spans of kind
`generic`.

Defined results: a null text is empty; a row without matches keeps zero counts
and empty spans; repeated rows each give a row and count once for ownership;
a null owner counts as the owner '', a null doc_id as one repository; very long
texts are scanned whole; an empty table gives an empty table; other columns are
not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridcast.session import materialize

ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: Long tokens outside the base patterns; they must hold a digit and a letter.
GENERIC = r"[A-Za-z0-9+/_=-]{20,}"
#: Kinds in order, with the regular expression that finds them. Runs of under 24
#: hex digits fail anyway, and a run that long matches whole.
KINDS = [("assign", ASSIGN), ("access", ACCESS), ("hex", r"[0-9a-f]{24,}"), ("generic", GENERIC)]
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
#: A value of more owners, or of several owners and more repositories, is a copied example.
MAX_OWNERS, MAX_REPOSITORIES = 2, 20


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def scan(docs: DataFrame, id_col: str, text_col: str, owner: Column, repository: Column) -> DataFrame:
    """Narrow staged table: a row per document with its matches of each kind and the gaps before them."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
                       repository.cast("string").alias("repository"), text.alias("text"))
    found = base.select("*", *(_matches(F.col("text"), r).alias(k) for k, r in KINDS))
    gaps = [F.when(F.size(k) > 0, F.transform(F.split("text", r, -1), F.length)).alias(f"{k}_gaps") for k, r in KINDS]
    found = found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository",
                         *(k for k, _ in KINDS), *gaps)
    return materialize(found, "secret-matches")


def occurrences(scanned: DataFrame) -> DataFrame:
    """A row per match that its kind accepts: row, owner, repository, kind, start, end, value."""
    def one(i: int, kind: str, pattern: str) -> DataFrame:
        rows = scanned.where(F.size(kind) > 0).select("row", "owner", "repository", F.posexplode(
            F.arrays_zip(F.col(kind).alias("text"), F.slice(f"{kind}_gaps", 1, F.size(kind)).alias("gap"))).alias("at", "m"))
        before = Window.partitionBy("row").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
        size = F.length("m.text")
        end = F.sum(F.col("m.gap") + size).over(before)
        value = F.regexp_extract("m.text", pattern, 2) if kind == "assign" else F.col("m.text")
        least = {"assign": MIN_VALUE, "access": MIN_ACCESS, "hex": MIN_HEX}.get(kind, 0)
        rows = rows.select("row", "owner", "repository", F.lit(i).alias("kind"), (end - size).alias("start"), end.alias("end"),
                           value.alias("value"))
        rows = rows.where(F.length("value") >= least)
        if kind == "generic":
            rows = rows.where(F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]"))
        return rows.withColumn("value", F.sha2("value", 256))

    return reduce(DataFrame.unionByName, (one(i, k, r) for i, (k, r) in enumerate(KINDS)))


def ownership(found: DataFrame, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """Distinct repositories and owners of each candidate hash, and whether it looks live.

    Duplicates go first, by the full key, so a value in very many documents is
    counted from partial sums.
    """
    each = found.select("value", "owner", "repository").distinct()
    by_owner = each.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("value").agg(F.sum("n").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners")).withColumn(
        "live", (F.col("n_owners") <= max_owners) & ((F.col("n_owners") == 1) | (F.col("n_repositories") <= max_repositories)))


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner: Column | None = None,
            repository: Column | None = None, max_owners: int = MAX_OWNERS,
            max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """One row per document: base counts, base digest, all spans, live / example counts, most repositories of a value."""
    scanned = scan(docs, id_col, text_col, F.col("source") if owner is None else owner,
                   F.col(id_col) if repository is None else repository)
    found = materialize(occurrences(scanned), "secret-occurrences")
    judged = found.join(ownership(found, max_owners, max_repositories), "value")
    is_base = F.col("kind") < 3
    order = Window.partitionBy("row").orderBy("start", "kind")
    before = F.max(F.when(is_base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(is_base, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    free = F.coalesce(before <= F.col("start"), F.lit(True)) & F.coalesce(after >= F.col("end"), F.lit(True))
    spans = judged.withColumn("added", ~is_base & F.col("live") & free).where(is_base | F.col("added"))
    name = F.element_at(F.array(*(F.lit(k) for k, _ in KINDS)), F.col("kind") + 1)
    item = F.struct("start", "kind", F.concat_ws(":", name, "start", "end").alias("said"))

    def said(condition: Column) -> Column:
        return F.array_join(F.transform(F.sort_array(F.collect_list(F.when(condition, item))), lambda x: x["said"]), ",")

    per_row = spans.groupBy("row").agg(
        *(F.count_if(F.col("kind") == i).alias(f"n_{k}") for i, (k, _) in enumerate(KINDS)),
        said(is_base).alias("base"), said(F.lit(True)).alias("spans"),
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_example"),
        F.max("n_repositories").alias("max_repositories"))
    out = scanned.select("row", "doc_id").join(per_row, "row", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id", *(F.coalesce(f"n_{k}", zero).alias(f"n_{k}") for k, _ in KINDS[:3]),
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
        *(F.coalesce(c, zero).alias(c) for c in ("n_generic", "n_live", "n_example", "max_repositories")))
