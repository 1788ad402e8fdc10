"""Leak-free splits.  Units of a group key are ordered by a portable hash and never cut."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def unit_order(seed: int, key: str):
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def kfold(units: DataFrame, k: int, seed: int, key: str, stratum: str) -> DataFrame:
    """Units with a fold (its test rows) and the fold that validates with it, dealt in turn within their stratum; needs 3 <= k <= units.

    The rank is taken in two steps: within 256 ranges of each stratum's hashes, then by the ranges' sizes.
    """
    if k < 3:
        raise ValueError("k must be at least 3")
    few = units.limit(k).count()
    if few < k:
        raise ValueError(f"k is {k}, but there are only {few} units")
    hashed = units.withColumn("_h", unit_order(seed, key)).withColumn("_part", F.substring("_h", 1, 2))
    sizes = hashed.groupBy(stratum, "_part").agg(F.count("*").alias("_n"))
    order = Window.partitionBy(stratum).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(F.col(stratum).alias("_s"), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_before"))
    inner = hashed.withColumn("_r", F.row_number().over(Window.partitionBy(stratum, "_part").orderBy("_h", key)) - 1)
    # at most 256 rows for each stratum; Spark chooses the join by the size it sees
    dealt = inner.join(before, F.col(stratum).eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p"))).withColumn("fold", ((F.col("_before") + F.col("_r")) % k).cast("int"))
    # fold f is validated on fold f + 1, so a unit validates the fold before its own
    return dealt.withColumn("validates", ((F.col("fold") + (k - 1)) % k).cast("int")).select(*units.columns, "fold", "validates")


def rows_before(units: DataFrame, seed: int, key: str, size: str) -> DataFrame:
    """Units with the rows of all units before them in hash order (``_done``) and of all units (``_total``).

    The running sum is taken within 256 ranges of the hash, plus the sizes of the
    ranges before, so no task sees all units.
    """
    hashed = units.withColumn("_h", unit_order(seed, key)).withColumn("_part", F.substring("_h", 1, 2))
    sizes = hashed.groupBy("_part").agg(F.sum(size).alias("_n"))
    # at most 256 rows: one for each range
    order = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy(F.lit(1))).alias("_total"))
    inner = Window.partitionBy("_part").orderBy("_h", key).rowsBetween(Window.unboundedPreceding, -1)
    at = hashed.withColumn("_in", F.coalesce(F.sum(size).over(inner), F.lit(0))).join(F.broadcast(before), "_part")
    return at.withColumn("_done", F.col("_before") + F.col("_in")).drop("_h", "_part", "_in", "_before")


def quota_split(units: DataFrame, seed: int, key: str, size: str, test: float, valid: float) -> DataFrame:
    """Units labelled test, valid or train: whole units in hash order until the rows before reach the quota, counted in whole rows."""
    at = rows_before(units, seed, key, size)
    quota = lambda share: F.floor(F.col("_total") * share)
    # the validation set begins where the test set ends, however far its last unit went over the quota
    over = at.where(F.col("_done") < quota(test)).agg(F.max(F.col("_done") + F.col(size)).alias("_test"))
    at = at.crossJoin(F.broadcast(over.select(F.coalesce("_test", F.lit(0)).alias("_test"))))  # one row
    split = F.when(F.col("_done") < quota(test), "test").when(F.col("_done") - F.col("_test") < quota(valid), "valid").otherwise("train")
    return at.withColumn("split", split).drop("_done", "_total", "_test")


def deploy_split(units: DataFrame, seed: int, key: str, size: str, eligible: str, n_test: int, valid: float) -> DataFrame:
    """Eligible units in hash order until ``n_test`` rows are held out for the test, the others for validation by share, then training.

    Raises where the eligible units have too few rows.
    """
    if n_test <= 0 or not 0 <= valid < 1:
        raise ValueError("n_test must be positive and the share of validation rows in [0, 1)")
    first = rows_before(units.where(eligible), seed, key, size).where(F.col("_done") < n_test)
    test = first.select(key, F.lit("test").alias("split"))
    got = first.agg(F.sum(size)).first()[0] or 0
    if got < n_test:
        raise ValueError(f"only {got} rows of eligible units for a test set of {n_test}")
    rest = rows_before(units.join(test, key, "left_anti"), seed, key, size)
    split = F.when(F.col("_done") < F.floor(F.col("_total") * valid), "valid").otherwise("train")
    return units.join(test.unionByName(rest.select(key, split.alias("split"))), key)


def group_stats(rows: DataFrame, key: str | None) -> DataFrame:
    """Rows and distinct groups; without a key each row is its own group."""
    return rows.agg(F.count("*").alias("n_rows"), (F.count("*") if key is None else F.count_distinct(key)).alias("n_groups"))


def first_seen(rows: DataFrame, key: str, row: str) -> DataFrame:
    """Groups with the number of their first row and their rows in order."""
    return rows.groupBy(key).agg(F.min(row).alias("first_row"), F.count("*").alias("n_rows"))


def validate_group_key(rows: DataFrame, key: str | None, fields: list[str]) -> None:
    """Raise if the key is absent or null anywhere, or if a field of ``fields`` groups the rows more strongly; empty tables pass."""
    if not rows.head(1):
        return
    if key is not None:
        if key not in rows.columns:
            raise ValueError(f"group key {key!r} is missing")
        empty = rows.where(F.col(key).isNull()).count()
        if empty:
            raise ValueError(f"group key {key!r} is null in {empty} rows")
    declared, base = (key, rows) if key is not None else ("_row", rows.withColumn("_row", F.monotonically_increasing_id()))
    found = sorted((r["field"], r["n_values"]) for r in stronger_keys(base, declared, [f for f in fields if f != key]).where("stronger").collect())
    if found:
        raise ValueError(f"stronger group keys than {key!r}: " + ", ".join(f"{f}={n}" for f, n in found))


def stronger_keys(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """For each field: rows without it, distinct values, and whether it coarsens the declared key."""
    out = None
    base = rows.select(F.count_distinct(key).alias("b"))
    for f in fields:
        pairs = rows.groupBy(key).agg(F.count_distinct(f).alias("d"), F.sum(F.col(f).isNull().cast("int")).alias("missing"))
        part = pairs.agg(F.max("d").alias("most"), F.sum("missing").alias("missing")).crossJoin(F.broadcast(rows.agg(F.count_distinct(f).alias("n")))).crossJoin(F.broadcast(base))  # single rows
        part = part.select(F.lit(f).alias("field"), "missing", F.col("n").alias("n_values"), ((F.col("missing") == 0) & (F.col("n") > 1) & (F.col("n") < F.col("b")) & (F.col("most") == 1)).alias("stronger"))
        out = part if out is None else out.unionByName(part)
    return out


def sibling_leak(rows: DataFrame, value: str, fold: str, order: str) -> DataFrame:
    """Rows whose value was first seen in another fold."""
    first = rows.groupBy(value).agg(F.min_by(fold, order).alias("first_fold"))
    return rows.join(first, value).where(F.col(fold) != F.col("first_fold"))


#: from the weakest to the strongest basis
LEAK_BASES = ("none", "text", "orig", "group")


def leak_values(records: DataFrame, declared: str | None = "auto") -> DataFrame:
    """Fold predictions with the value (and its basis) by which siblings are told.

    ``auto`` follows each record's own ``group_key``: a name means its ``group``,
    ``none`` that nothing is measured, null an older file.  Without a group the
    original text counts, then the text itself.
    """
    own = F.col("group_key")
    mode = F.when(own.isNull(), "legacy").when(own == "none", "none").otherwise("declared") if declared == "auto" else F.lit("none" if declared is None else "declared")
    by_group = (F.col("_mode") == "declared") & F.col("group").isNotNull()
    basis = F.when(F.col("_mode") == "none", "none").when(by_group, "group").when(F.col("orig").isNotNull(), "orig").when(F.col("text").isNotNull(), "text").otherwise("none")
    value = F.when(F.col("basis") == "group", F.col("group")).when(F.col("basis") == "orig", F.col("orig")).when(F.col("basis") == "text", F.col("text"))
    return records.withColumn("_mode", mode).withColumn("basis", basis).withColumn("value", value).drop("_mode")


def leak_basis(folds: DataFrame, basis: str = "basis", dups: str = "dups") -> DataFrame:
    """The weakest basis of all folds, and the leak count: null exactly if that basis is none."""
    rank = F.array_position(F.array(*[F.lit(b) for b in LEAK_BASES]), F.col(basis))
    out = folds.agg(F.element_at(F.array(*[F.lit(b) for b in LEAK_BASES]), F.min(rank).cast("int")).alias("basis"), F.sum(dups).alias("dups"))
    return out.select("basis", F.when(F.col("basis") != "none", F.col("dups")).alias("dups"))


def pooled_leak(records: DataFrame, declared: str | None = "auto", strict: bool = False) -> DataFrame:
    """One row over all folds: records, folds, weakest basis, and records whose value came first in another fold (null if unmeasured)."""
    rows = leak_values(records, declared)
    first = rows.where("value is not null").groupBy("value").agg(F.min("fold").alias("first_fold"), F.count_distinct("fold").alias("n"))
    again = rows.join(first.where("n > 1"), "value", "left").withColumn("again", F.coalesce(F.col("fold") != F.col("first_fold"), F.lit(False)))
    per = again.groupBy("basis").agg(F.count("*").alias("n"), F.count_if("again").alias("dups"))
    out = per.agg(F.sum("n").alias("n_sentences"), F.min(F.array_position(F.array(*[F.lit(b) for b in LEAK_BASES]), F.col("basis"))).alias("rank"), F.sum("dups").alias("dups"))
    folds = records.agg(F.count_distinct("fold").alias("n_folds"))
    basis = F.element_at(F.array(*[F.lit(b) for b in LEAK_BASES]), F.col("rank").cast("int"))
    one = out.crossJoin(F.broadcast(folds)).select("n_sentences", "n_folds", basis.alias("basis"), F.when(basis != "none", F.col("dups")).alias("dups"))  # one row each
    if strict and (one.first()["dups"] or 0) > 0:
        raise ValueError("a value stands in the test sets of two folds")
    return one


def unique_texts(records: DataFrame) -> DataFrame:
    """The predictions of all folds, numbered in order of fold and row; raises on a text that stands there twice."""
    twice = records.groupBy("text").count().where("count > 1").head(1)
    if twice:
        raise ValueError(f"a text stands in the predictions more than once: {twice[0][0][:40]!r}")
    # a global number without one task: rows of a fold are counted first, few folds then add up
    sizes = records.groupBy("fold").agg(F.count("*").alias("_n"))
    start = sizes.select("fold", F.coalesce(F.sum("_n").over(Window.orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    return records.join(F.broadcast(start), "fold").withColumn("sent_idx", F.col("_start") + F.col("row")).drop("_start")


def fingerprint(rows: DataFrame, key: str, payload: str, block: int = 4096, fan: int = 256, levels: int | None = None) -> DataFrame:
    """Order-sensitive digest of a table: digests of rows, of blocks of keys, then of ``fan`` digests at a time until one is left.

    With ``levels`` digests are taken ``fan`` at a time so many times at most, then all that are left at once.
    """
    level = rows.select(F.floor(F.col(key) / block).alias("b"), F.col(key).alias("k"), F.sha2(payload, 256).alias("d"))
    joined = lambda c: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "d"))), lambda x: x["d"]), ","), 256).alias(c)
    level = level.groupBy("b").agg(joined("d"))
    least, most = rows.agg(F.floor(F.min(key) / block), F.floor(F.max(key) / block)).first()
    span = 0 if most is None else most - least + 1
    while span > fan and levels != 0:
        levels = None if levels is None else levels - 1
        level, least, span = level.select(F.floor((F.col("b") - least) / fan).alias("b"), F.col("b").alias("k"), "d").groupBy("b").agg(joined("d")), 0, -(-span // fan)
    return level.select(F.col("b").alias("k"), "d").agg(joined("d")).select(F.substring("d", 1, 16).alias("fingerprint"))


def records_payload(text: str = "text", spans: str = "spans"):
    """What a record's digest is taken over: its text, then its spans (label, start, end) in order."""
    listed = F.transform(F.array_sort(F.col(spans)), lambda s: F.concat_ws(":", s["label"], s["start"].cast("string"), s["end"].cast("string")))
    return F.concat(F.coalesce(F.col(text), F.lit("")), F.lit("\0"), F.array_join(listed, ","))


#: words of a passage that route it, longest first
ROUTE_WORDS = (8, 4, 2, 1)


def passages(docs: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """Pairs (document, item) whose whole passage, trimmed, stands verbatim anywhere in the document's text.

    The words within a passage, without the first and last, are whole words of
    every text that holds it; the longest run of them from ``ROUTE_WORDS`` is the
    key of an equi-join, after which the full passage is compared.  Passages of
    one or two words have no such run and are compared with every document.
    Blank passages are in none.
    """
    b = items.select(item, F.trim("text").alias("passage")).where("passage <> ''").distinct().withColumn("w", F.split("passage", " "))
    n = F.size("w") - 2
    b = b.withColumn("k", F.coalesce(*[F.when(n >= k, F.lit(k)) for k in ROUTE_WORDS], F.lit(0)))
    sizes = [r[0] for r in b.select("k").distinct().collect()]
    texts = docs.select(key, "text").where(F.col("text").isNotNull())
    b = b.withColumn("h", F.xxhash64("k", F.expr("slice(w, 2, k)")))
    found = texts.join(F.broadcast(b.where("k = 0")), F.contains("text", F.col("passage"))).select(key, item)
    words = texts.select(key, F.split("text", " ").alias("w"))
    for k in sorted(set(sizes) - {0}):
        runs = F.transform(F.sequence(F.lit(1), F.size("w") - (k - 1)), lambda i: F.xxhash64(F.lit(k), F.slice("w", i, k)))  # noqa: B023
        h = words.where(F.size("w") >= k + 2).select(key, F.explode(F.array_distinct(runs)).alias("h"))
        near = h.join(b.where(F.col("k") == k), "h").select(key, item, "passage").distinct()
        found = found.unionByName(texts.join(near, key).where(F.contains("text", F.col("passage"))).select(key, item))
    return found.distinct()
