"""Hierarchical budgeting of sources (operator 5). DataFrame functions only.

A token budget goes down a domain - language - source tree in proportion to
integer weights. At each node, children that cannot use their share (tokens
times `max_epochs`) leave the rest to their siblings; a node's own shortage
shows only when its whole subtree is used up, and then its siblings take it.
Each leaf's allocation is a token prefix of its seeded epochs: whole epochs,
then the documents of one more epoch in seeded order while their tokens fit.

Scale: a leaf's last epoch is cut by buckets of the seeded key, about the square
root of its rows of them, and only the cut bucket is ordered by key.

Defined results: a null domain, language or source is ''; a null text has no
tokens, a very long one counts whole; repeated rows and documents of one leaf
that share a doc_id (nulls too) go together; shares are
rounded down, so fewer tokens than children of a node stay unused at it; an
empty table gives an empty table; other columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridcast.llm.common import WORD_RE, free_name
from gridcast.session import materialize

#: Leaves up to which the table of allocations is broadcast (under 200 bytes each).
MAX_BROADCAST_LEAVES = 100_000
SALTS = 64
LEAF = ["domain", "lang", "source"]


def _weight(column: str, weights: dict[str, int]) -> Column:
    """Weight of a node; 1 where the weights name none."""
    if not weights:
        return F.lit(1).cast("long")
    table = F.create_map(*(F.lit(x) for kv in sorted(weights.items()) for x in kv))
    return F.coalesce(F.try_element_at(table, F.col(column)), F.lit(1)).cast("long")


def share(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Split each parent's `budget` among its children (`weight`, `cap`): adds `given`.

    Children stand in ascending order of cap per weight; those whose share
    reaches their cap form a prefix and take it whole, the others split what is
    left in proportion. Decimals keep the products exact.
    """
    wide = "decimal(38,0)"
    keys = [F.lit(0)] if not parent else [F.col(c) for c in parent]
    order = Window.partitionBy(*keys).orderBy(
        F.coalesce(F.try_divide(F.col("cap").cast("double"), F.col("weight").cast("double")), F.lit(float("inf"))), name)
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    nodes = nodes.withColumn("left", F.col("budget") - F.coalesce(F.sum("cap").over(earlier), F.lit(0))).withColumn(
        "rest", F.sum("weight").over(later))
    full = F.col("left").cast(wide) * F.col("weight") >= F.col("cap").cast(wide) * F.col("rest")
    nodes = nodes.withColumn("open", F.max((~full).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy(*keys)
    first = F.max(F.when(F.col("open") == 1, F.struct("rest", "left"))).over(whole)
    nodes = nodes.withColumn("first", first)
    part = F.expr("cast(first.left as decimal(38,0)) * weight div nullif(cast(first.rest as decimal(38,0)), 0)")
    given = F.when(F.col("open") == 0, F.col("cap")).otherwise(F.greatest(F.coalesce(part.cast("long"), F.lit(0)), F.lit(0)))
    return nodes.withColumn("given", given.cast("long")).drop("left", "rest", "open", "first")


def allocate(leaves: DataFrame, budget_percent: int, max_epochs: int, domain_weights: dict[str, int],
             lang_weights: dict[str, int], source_weights: dict[str, int]) -> DataFrame:
    """Allocation of each leaf: domain, lang, source, tokens, given. `leaves` has a row per leaf with its tokens."""
    caps = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    total = F.sum("tokens").over(Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    domains = caps.groupBy("domain").agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens")).withColumn(
        "total", total).withColumn("budget", F.expr(f"total * {int(budget_percent)} div 100")).withColumn(
        "weight", _weight("domain", domain_weights))
    domains = share(domains, [], "domain").select("domain", F.col("given").alias("budget"))
    langs = caps.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).join(domains, "domain").withColumn(
        "weight", _weight("lang", lang_weights))
    langs = share(langs, ["domain"], "lang").select("domain", "lang", F.col("given").alias("budget"))
    sources = caps.join(langs, ["domain", "lang"]).withColumn("weight", _weight("source", source_weights))
    return share(sources, ["domain", "lang"], "source").select(*LEAF, "tokens", "given")


def mix(docs: DataFrame, domain: Column, budget_percent: int = 100, max_epochs: int = 3, seed: int = 17,
        domain_weights: dict[str, int] | None = None, lang_weights: dict[str, int] | None = None,
        source_weights: dict[str, int] | None = None, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", source_col: str = "source") -> tuple[DataFrame, dict[str, str]]:
    """The chosen documents, once per epoch that takes them, all columns kept.

    Returns the frame and the names of the columns it adds: epoch, domain,
    lang, source, tokens (free names, so they never clash with the table's own).
    """
    spark = docs.sparkSession
    names = {}
    for c in ("epoch", *LEAF, "tokens", "full", "cut_bucket", "cut_key", "key", "salt"):
        names[c] = free_name(docs, f"mix_{c}")
    blank = F.lit("")
    sized = docs.select(
        "*", F.coalesce(domain.cast("string"), blank).alias(names["domain"]),
        F.coalesce(F.col(lang_col).cast("string"), blank).alias(names["lang"]),
        F.coalesce(F.col(source_col).cast("string"), blank).alias(names["source"]),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_RE)), F.lit(0)).cast("long").alias(names["tokens"]))
    narrow = materialize(sized.select(*(F.col(names[c]).alias(c) for c in (*LEAF, "tokens")),
                                      F.coalesce(F.col(id_col).cast("string"), blank).alias("id")), "mix-sizes")
    leaves = narrow.groupBy(*LEAF).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    plan = allocate(leaves.drop("rows"), budget_percent, max_epochs, domain_weights or {}, lang_weights or {}, source_weights or {})
    some = F.col("tokens") > 0
    # hex digits of the key that make a bucket: about as many buckets as rows in one
    depth = F.greatest(F.lit(3), F.ceil(F.log(16.0, F.col("rows")) / 2)).cast("int").alias("depth")
    plan = plan.join(leaves.select(*LEAF, depth), LEAF).select(*LEAF, "depth", F.when(some, F.expr("given div tokens")).otherwise(F.lit(0).cast("long")).alias("full"),
                       F.when(some, F.expr("try_mod(given, tokens)")).otherwise(0).alias("part"))
    plan = materialize(plan, "mix-plan")
    n_leaves = plan.count()

    def key(full: Column, ident: Column) -> Column:
        return F.md5(F.concat_ws(":", F.lit(str(seed)), full.cast("string"), ident))

    def with_plan(rows: DataFrame, side: DataFrame, on: list[str]) -> DataFrame:
        """Join rows to a table of a row per leaf; a hot leaf's rows stay where they are or are salted."""
        if n_leaves <= MAX_BROADCAST_LEAVES:
            return rows.join(F.broadcast(side), on)
        salt = names["salt"]
        rows = rows.withColumn(salt, F.floor(F.rand(seed) * SALTS).cast("int"))
        side = side.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        return rows.join(side, [*on, salt]).drop(salt)

    # the last epoch's cut: by a bucket of the seeded keys first, then inside that bucket alone
    keyed = with_plan(narrow, plan.where("part > 0"), LEAF).withColumn("key", key(F.col("full"), F.col("id"))).withColumn(
        "bucket", F.substring(F.col("key"), F.lit(1), F.col("depth")))
    sums = keyed.groupBy(*LEAF, "bucket").agg(F.sum("tokens").alias("size"), F.first("part").alias("part"))
    run = Window.partitionBy(*LEAF).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("upto", F.sum("size").over(run))
    edge = sums.where((F.col("upto") > F.col("part")) & (F.col("upto") - F.col("size") <= F.col("part"))).select(
        *LEAF, F.col("bucket").alias("cut_bucket"), (F.col("part") - F.col("upto") + F.col("size")).alias("room"))
    inside = with_plan(keyed, edge, LEAF).where(F.col("bucket") == F.col("cut_bucket")).groupBy(*LEAF, "room", "key").agg(
        F.sum("tokens").alias("size"))
    fits = inside.withColumn("upto", F.sum("size").over(
        Window.partitionBy(*LEAF).orderBy("key").rowsBetween(Window.unboundedPreceding, 0))).where("upto <= room")
    cut = edge.drop("room").join(fits.groupBy(*LEAF).agg(F.max("key").alias("cut_key")), LEAF, "left")
    plan = materialize(plan.join(cut, LEAF, "left"), "mix-cuts").select(
        *(F.col(c).alias(names[c]) for c in (*LEAF, "full", "cut_bucket", "cut_key")))
    rows = with_plan(sized, plan, [names[c] for c in LEAF])
    rows = rows.withColumn(names["key"], key(F.col(names["full"]), F.coalesce(F.col(id_col).cast("string"), blank)))
    k, bucket = F.col(names["key"]), F.col(names["cut_bucket"])
    own = F.substring(k, F.lit(1), F.length(bucket))
    taken = F.coalesce((own < bucket) | ((own == bucket) & (k <= F.col(names["cut_key"]))), F.lit(False))
    epochs = F.col(names["full"]) + F.when(taken, 1).otherwise(0)
    rows = rows.withColumn(names["epoch"], F.explode(F.when(epochs > 0, F.sequence(F.lit(0).cast("long"), epochs - 1))))
    added = {c: names[c] for c in ("epoch", *LEAF, "tokens")}
    return rows.select(*docs.columns, *added.values()), added


#: Weights of the registered query and of the pipeline; other nodes weigh 1.
DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 3, "d3": 2}
LANG_WEIGHTS = {"de": 3, "en": 6, "es": 2, "fr": 3}


def domain_of(source_col: str = "source") -> Column:
    """Domain of a document in the test tables, which carry none: four groups of sources."""
    return F.concat(F.lit("d"), (F.crc32(F.coalesce(F.col(source_col).cast("string"), F.lit(""))) % 4).cast("string"))


def mix_documents(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Operator 5 with production parameters."""
    return mix(docs, domain_of(), budget_percent=100, max_epochs=3, domain_weights=DOMAIN_WEIGHTS, lang_weights=LANG_WEIGHTS)
