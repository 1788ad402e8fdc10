"""Request checks and answers, admission, logs, and load analytics; the same functions serve batch and streams."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import detect_lang, lang_summary

LIMITS = {"max_batch": 64, "max_chars": 20_000, "max_total_chars": 100_000, "max_body": 2 << 20}
LANGS = ("ja", "vi", "ko", "en")
#: fixed values: why a request is refused, by status
REASONS = {400: "bad_request", 401: "unauthorized", 413: "payload_too_large", 422: "validation_failed", 429: "overloaded", 503: "model_unavailable"}


def validate(requests: DataFrame, limits: dict[str, int] = LIMITS, body: str | None = None) -> DataFrame:
    """Requests (text, texts, lang) with an HTTP status and a reason; an empty list of texts is a good request.

    ``body`` names a column with the raw request, whose bytes count before anything else.
    """
    one, many = F.col("text").isNotNull(), F.col("texts").isNotNull()
    longest = F.coalesce(F.array_max(F.transform("texts", lambda t: F.length(t))), F.length("text"))
    total = F.coalesce(F.aggregate("texts", F.lit(0), lambda s, t: s + F.length(t)), F.length("text"))
    size = F.octet_length(body) if body else F.lit(0)
    reason = (
        F.when(size > limits.get("max_body", LIMITS["max_body"]), "body").when(one == many, "oneof")
        .when(F.col("lang").isNotNull() & ~F.col("lang").isin(*LANGS), "lang").when(many & (F.size("texts") > limits["max_batch"]), "batch")
        .when(many & (total > limits["max_total_chars"]), "total").when(longest > limits["max_chars"], "chars").otherwise("ok")
    )
    return requests.withColumn("reason", reason).withColumn("status", F.when(F.col("reason") == "ok", 200).when(F.col("reason").isin("oneof", "lang"), 400).otherwise(413))


def answers(requests: DataFrame, entities: str = "entities") -> DataFrame:
    """One row per request (request_id, item_idx, lang, entities): languages in short, items and entities in all, and the results in order."""
    rows = requests.groupBy("request_id").agg(F.array_sort(F.collect_list(F.struct("item_idx", "lang", F.to_json(entities).alias("entities")))).alias("results"), F.count("*").alias("batch"), F.sum(F.size(entities)).alias("n_entities"))
    return rows.select("request_id", lang_summary(F.transform("results", lambda r: r["lang"])).alias("langs"), "batch", "n_entities", F.transform("results", lambda r: F.struct(r["lang"].alias("lang"), r["entities"].alias("entities"))).alias("results"))


def error_body(status: Column, message: Column) -> Column:
    """The one form of all errors."""
    return F.to_json(F.struct(F.struct(status.alias("status"), message.alias("message")).alias("error")))


def log_rows(requests: DataFrame) -> DataFrame:
    """Answers (status, request_id or null, ...) as log rows: an id (the first 64 characters of the one sent, else eight hex digits), a level, a kind and a reason."""
    status = F.col("status")
    reason = F.try_element_at(F.create_map(*[F.lit(x) for kv in REASONS.items() for x in kv]), status)
    made = F.substring(F.md5(F.concat(F.lit("rid"), F.uuid())), 1, 8)
    kind = F.when(reason.isNotNull() | status.between(400, 499), "rejected").when(status >= 500, "failed").otherwise("served")
    why = F.coalesce(reason, F.when(status.between(400, 499), "error"))
    rows = requests.withColumn("rid", F.when(F.coalesce("request_id", F.lit("")) != "", F.substring("request_id", 1, 64)).otherwise(made))
    return rows.withColumns({"kind": kind, "reason": why, "level": F.when(kind == "served", "DEBUG").otherwise("WARNING")})


def admission(requests: DataFrame, bucket: str, arrival: str, seconds: str, running: int, waiting: int, patience: float) -> DataFrame:
    """Each request of a server with what became of it: served (with its start), ``queue full`` or ``timed out``.

    At most ``running`` are served at once and ``waiting`` wait; a free place is
    given even where nobody may wait.  Waiting requests are served in order of
    arrival and leave after ``patience`` seconds.  One server's log of one period
    is the unit: its order decides.
    """
    kinds = {f.name: f.dataType.simpleString() for f in requests.schema.fields}

    def run(log: pd.DataFrame) -> pd.DataFrame:
        log = log.sort_values([arrival, "request_id"], kind="stable")
        busy, queue, outcome, start = [], [], {}, {}

        def serve(until: float) -> None:
            # places come free in order; the first who still waits takes each
            while queue and busy and busy[0] <= until:
                free = heapq.heappop(busy)
                while queue:
                    i, came, need = queue.pop(0)
                    if came + patience >= free:
                        outcome[i], start[i] = "served", max(free, came)
                        heapq.heappush(busy, start[i] + need)
                        break
                    outcome[i] = "timed out"
                else:
                    heapq.heappush(busy, free)
                    return

        for i, came, need in zip(log.index, log[arrival].astype(float), log[seconds].astype(float)):
            serve(came)
            while busy and busy[0] <= came and not queue:
                heapq.heappop(busy)
            while queue and queue[0][1] + patience < came:
                outcome[queue.pop(0)[0]] = "timed out"
            if len(busy) < running and not queue:
                outcome[i], start[i] = "served", came
                heapq.heappush(busy, came + need)
            elif len(queue) >= waiting:
                outcome[i] = "queue full"
            else:
                queue.append((i, came, need))
        serve(float("inf"))
        return log.assign(outcome=[outcome[i] for i in log.index], started=[start.get(i) for i in log.index])

    return requests.groupBy(bucket).applyInPandas(run, ", ".join(f"`{n}` {k}" for n, k in kinds.items()) + ", outcome string, started double")


def number_within(rows: DataFrame, group: str, order: str, parts: int = 256) -> DataFrame:
    """Rows with their place (from 0) within a group, in order; a group of any size is numbered in ranges of its order column.

    Places are taken within ranges, then the sizes of the ranges before are added, so no task holds a whole group.
    """
    least, most = rows.agg(F.min(order), F.max(order)).first()
    width = max(1, ((most or 0) - (least or 0)) // parts + 1)
    cut = rows.withColumn("_range", F.floor((F.col(order) - F.lit(least or 0)) / width))
    sizes = cut.groupBy(F.col(group).alias("_g"), F.col("_range").alias("_r")).agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy("_g").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inner = cut.withColumn("_i", F.row_number().over(Window.partitionBy(group, "_range").orderBy(order)) - 1)
    both = inner.join(before, F.col(group).eqNullSafe(F.col("_g")) & F.col("_range").eqNullSafe(F.col("_r")))
    return both.withColumn("item_idx", (F.col("_before") + F.col("_i")).cast("long")).select(*rows.columns, "item_idx")


def resolve(requests: DataFrame) -> DataFrame:
    """The language given, else detected; ``answer`` is false where no model is called."""
    lang = F.coalesce("lang", detect_lang(F.col("text")))
    return requests.withColumn("resolved", lang).withColumn("answer", lang.isin(*LANGS))


def chunks(text: Column, budget: int) -> Column:
    """Tiles of a text: (chunk, base), cut after every ``budget`` words without regard to sentences; the tiles joined are the text."""
    words = F.regexp_extract_all(text, F.lit(r"(?U)\s*\S+\s*$|\s*\S+"), F.lit(0))
    n = F.ceil(F.size(words) / budget).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.array_join(F.slice(words, i * budget + 1, F.lit(budget)), ""))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<chunk:string,base:int>>").alias("out"))
    placed = F.aggregate(tiles, state, lambda a, t: F.struct((a["at"] + F.length(t)).alias("at"), F.concat(a["out"], F.array(F.struct(t.alias("chunk"), a["at"].alias("base")))).alias("out")), lambda a: a["out"])
    return F.when(F.size(words) <= budget, F.array(F.struct(text.alias("chunk"), F.lit(0).alias("base")))).otherwise(placed)


def in_flight(intervals: DataFrame, bucket: str, begin: str, end: str) -> DataFrame:
    """Most intervals open at once in each bucket: a sweep over starts and ends; an end comes before a start at the same time."""
    marks = intervals.select(bucket, F.col(begin).alias("t"), F.lit(1).alias("d")).unionByName(intervals.select(bucket, F.col(end).alias("t"), F.lit(-1).alias("d")))
    steps = marks.groupBy(bucket, "t", "d").agg(F.sum("d").alias("s"))
    run = F.sum("s").over(Window.partitionBy(bucket).orderBy("t", "d").rowsBetween(Window.unboundedPreceding, 0))
    return steps.withColumn("open", run).groupBy(bucket).agg(F.max("open").alias("peak"))
