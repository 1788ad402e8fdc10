"""Queries over requests, models at the edge of the plan, logs and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import adapters, bio, reports, serving
from ..sources import files
from ..streaming import requests as streams
from .catalogue import CARD, EMAIL, _span_sql
from .fixture import TOKENS_SQL, gold, table
from .labels import CONTESTED, contested
from .registry import query
from .texts import scripted, SCRIPTED

#: turns as requests: one text, a list of texts, both or none, with languages that are known, unknown or left out
ASKED = """req AS (SELECT conv_id * 1000 + turn AS id, CASE WHEN (conv_id + turn) % 5 IN (0, 1, 4) THEN repeat(text, CASE WHEN conv_id % 9 = 0 THEN 60 ELSE 1 END) END AS text,
 CASE (conv_id + turn) % 5 WHEN 1 THEN [text] WHEN 2 THEN list_transform(range(CASE WHEN conv_id % 7 = 0 THEN 65 ELSE conv_id % 40 END), lambda i: repeat(text, 6)) END AS texts, CASE conv_id % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'ko' WHEN 2 THEN CASE WHEN turn % 3 = 0 THEN 'fr' END END AS lang FROM conversations)"""


def asked(spark, d) -> DataFrame:
    k = (F.col("conv_id") + F.col("turn")) % 5
    one = F.when(k.isin(0, 1, 4), F.expr("repeat(text, if(conv_id % 9 = 0, 60, 1))"))
    many = F.when(k == 1, F.array("text")).when(k == 2, F.expr("if(conv_id % 7 = 0, array_repeat(repeat(text, 6), 65), array_repeat(repeat(text, 6), int(conv_id % 40)))"))
    lang = F.expr("case conv_id % 4 when 0 then 'en' when 1 then 'ko' when 2 then if(turn % 3 = 0, 'fr', null) end")
    return table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), one.alias("text"), many.alias("texts"), lang.alias("lang"))


CHECKED = f"""WITH {ASKED}, m AS (SELECT id, (text IS NULL) = (texts IS NULL) AS unclear, lang, len(texts) AS n, coalesce(list_max(list_transform(texts, lambda t: length(t))), length(text)) AS longest, list_sum(list_transform(texts, lambda t: length(t))) AS total FROM req),
chk AS (SELECT id, CASE WHEN unclear THEN 'oneof' WHEN lang = 'fr' THEN 'lang' WHEN n > 64 THEN 'batch' WHEN total > 100000 THEN 'total' WHEN longest > 20000 THEN 'chars' ELSE 'ok' END AS reason FROM m)"""


@query(f"{CHECKED} SELECT id, reason, CAST(CASE reason WHEN 'ok' THEN 200 WHEN 'oneof' THEN 400 WHEN 'lang' THEN 400 ELSE 413 END AS INTEGER) AS status FROM chk")
def request_validation(spark, d):
    return serving.validate(asked(spark, d)).select("id", "reason", "status")


@query(f"""WITH {ASKED} SELECT id, strlen(coalesce(text, array_to_string(texts, ' '), '')) > 10000 AS too_long FROM req""")
def body_limit(spark, d):
    """Requests over a limit of 10,000 bytes, counted in UTF-8."""
    rows = asked(spark, d).withColumn("body", F.coalesce("text", F.array_join("texts", " "), F.lit("")))
    return serving.validate(rows, serving.LIMITS | {"max_body": 10_000}, "body").select("id", (F.col("reason") == "body").alias("too_long"))


@query(f"""{CHECKED}, st AS (SELECT id, CASE reason WHEN 'ok' THEN CASE WHEN id % 11 = 0 THEN 500 WHEN id % 13 = 0 THEN 404 WHEN id % 17 = 0 THEN 503 ELSE 200 END WHEN 'oneof' THEN 400 WHEN 'lang' THEN 400 ELSE 413 END AS status FROM chk)
SELECT CAST(status AS INTEGER) AS status, kind, reason, level, error, count(*) AS n FROM (SELECT status, CASE WHEN status IN (400, 413, 503, 404) THEN 'rejected' WHEN status = 500 THEN 'failed' ELSE 'served' END AS kind, CASE status WHEN 400 THEN 'bad_request' WHEN 413 THEN 'payload_too_large' WHEN 503 THEN 'model_unavailable' WHEN 404 THEN 'error' END AS reason,
 CASE WHEN status = 200 THEN 'DEBUG' ELSE 'WARNING' END AS level, CASE WHEN status <> 200 THEN '{{"error":{{"status":' || status || ',"message":"m"}}}}' END AS error FROM st) GROUP BY ALL""")
def request_log(spark, d):
    rows = serving.validate(asked(spark, d)).select("id", F.when(F.col("status") != 200, F.col("status")).when(F.col("id") % 11 == 0, 500).when(F.col("id") % 13 == 0, 404).when(F.col("id") % 17 == 0, 503).otherwise(200).alias("status"))
    log = serving.log_rows(rows.withColumn("request_id", F.when(F.col("id") % 2 == 0, F.col("id").cast("string"))))
    error = F.when(F.col("status") != 200, serving.error_body(F.col("status"), F.lit("m")))
    return log.where("length(rid) > 0").groupBy("status", "kind", "reason", "level", error.alias("error")).agg(F.count("*").alias("n"))


@query(f"""WITH {SCRIPTED}, l AS (SELECT doc_id, doc_id // 7 AS request_id, CASE WHEN regexp_matches(text, '[ぁ-んァ-ヶ]') THEN 'ja' WHEN regexp_matches(text, '[가-힣]') THEN 'ko' WHEN regexp_matches(text, '[ạểịộư]') THEN 'vi' WHEN regexp_matches(text, '[a-zäéîôüÿ]') THEN 'en' ELSE 'unsupported' END AS lang FROM scripted WHERE regexp_matches(text, '[ạểịộưぁ-んァ-ヶ가-힣äéîôüÿa-z]') OR doc_id % 6 = 5),
o AS (SELECT request_id, lang, min(doc_id) AS first FROM l GROUP BY ALL), c AS (SELECT request_id, count(*) AS batch FROM l GROUP BY 1)
SELECT request_id, batch, 0::BIGINT AS n_entities, string_agg(lang, '+' ORDER BY first) AS langs FROM o JOIN c USING (request_id) GROUP BY request_id, batch""")
def batch_answers(spark, d):
    """Documents by sevens as requests of several texts, with their languages in the order of the texts."""
    rows = serving.resolve(scripted(spark, d).withColumn("lang", F.lit(None).cast("string"))).withColumn("lang", F.col("resolved"))
    rows = rows.where((F.col("doc_id") % 6 == 5) | (F.col("lang") != "unsupported")).select(F.floor(F.col("doc_id") / 7).alias("request_id"), F.col("doc_id").alias("item_idx"), "lang", F.array().cast("array<struct<label:string>>").alias("entities"))
    return serving.answers(rows).select("request_id", "batch", "n_entities", "langs")


#: a model by patterns, without look-around: card numbers as the fixture's queries know them
MODEL = {"EMAIL": EMAIL, "CREDIT_CARD": CARD}
LOADED = ("en", "fr")


def _found(d_sql: str, label: str) -> str:
    return f"SELECT doc_id, '{label}' AS label, start, stop, surface FROM ({d_sql})"


@query(f"""WITH a AS ({_found(_span_sql(EMAIL), 'EMAIL')} UNION ALL {_found(_span_sql(CARD), 'CREDIT_CARD')}), f AS (SELECT d.doc_id, lang, count(label) AS n, string_agg(label || ':' || start || ':' || stop || ':' || surface, ',' ORDER BY start, stop, label) AS listed FROM documents d LEFT JOIN a USING (doc_id) GROUP BY ALL)
SELECT doc_id, CAST(CASE WHEN lang IN ('en', 'fr') THEN 200 ELSE 503 END AS INTEGER) AS status, CASE WHEN lang IN ('en', 'fr') THEN coalesce(listed, '') ELSE '' END AS entities FROM f""")
def long_text_inference(spark, d):
    """Whole documents through tiles, a model, places, one span a mail address and the canonical form; two languages have no model."""
    model = adapters.PatternModel(MODEL)
    got = adapters.infer(table(spark, d, "documents").select("doc_id", "lang", "text"), {lang: model for lang in LOADED}, max_length=100)
    listed = F.array_join(F.transform(F.array_sort(F.transform("entities", lambda e: F.struct(e["start_char"].alias("s"), e["end_char"].alias("e"), e["label"].alias("l"), e["text"].alias("t")))), lambda x: F.concat_ws(":", x["l"], x["s"].cast("string"), x["e"].cast("string"), x["t"])), ",")
    return got.select("doc_id", "status", listed.alias("entities"))


@query(f"""WITH a AS ({_found(_span_sql(EMAIL), 'EMAIL')} UNION ALL {_found(_span_sql(CARD), 'CREDIT_CARD')}) SELECT lang, count(*) FILTER (WHERE label = 'EMAIL') AS n_mail, count(*) FILTER (WHERE label = 'CREDIT_CARD' AND lang = 'fr') AS n_card FROM a JOIN documents USING (doc_id) WHERE lang IN ('en', 'fr') GROUP BY lang""")
def inference_thresholds(spark, d):
    """Thresholds of a language cut its spans: English cards score too little."""
    model = adapters.PatternModel(MODEL, 0.9)
    got = adapters.infer(table(spark, d, "documents").select("doc_id", "lang", "text"), {lang: model for lang in LOADED}, thresholds={"en": {"CREDIT_CARD": 0.95, "EMAIL": 0.5}})
    e = got.select("lang", F.explode("entities").alias("e"))
    return e.groupBy("lang").agg(F.count_if(F.col("e.label") == "EMAIL").alias("n_mail"), F.count_if(F.col("e.label") == "CREDIT_CARD").alias("n_card")).where("n_mail + n_card > 0")


# pieces of mail addresses: cut at the sign and before the last stop, with a name in between for some
@query(f"""WITH s AS ({_span_sql(EMAIL)}) SELECT doc_id, CAST(sum(CASE WHEN doc_id % 3 = 2 THEN 3 ELSE 1 END) AS BIGINT) AS n_spans, CAST(sum(CASE WHEN doc_id % 3 = 2 THEN 0 ELSE stop END) AS BIGINT) AS stops FROM s GROUP BY doc_id""")
def merge_mail_pieces(spark, d):
    from ..functions.text import regex_spans

    docs = table(spark, d, "documents").where(F.col("text").rlike(EMAIL))
    kind = "array<struct<type:string,start:int,end:int,score:double>>"
    spot = lambda m: (F.instr(m["m"], "@") + m["s"]).cast("int")
    part = lambda kind_, a, b, score: F.struct(F.lit(kind_).alias("type"), a.cast("int").alias("start"), b.cast("int").alias("end"), F.lit(score).alias("score"))
    cut = F.transform(regex_spans(F.col("text"), EMAIL), lambda m: F.when(F.col("doc_id") % 3 == 2, F.array(part("EMAIL", m["s"], spot(m) - 1, 0.8), part("PER", spot(m) - 1, spot(m), 0.9), part("EMAIL", spot(m), m["e"], 0.7))).otherwise(F.array(part("EMAIL", m["s"], spot(m), 0.8), part("EMAIL", spot(m) + 1, m["e"], 0.7))))
    merged = docs.select("doc_id", bio.merge_mail(F.col("text"), F.flatten(cut).cast(kind)).alias("m"))
    stops = F.aggregate(F.filter("m", lambda x: x["score"] == 0.7), F.lit(0).cast("long"), lambda a, x: a + F.when(F.col("doc_id") % 3 == 2, F.lit(0)).otherwise(x["end"]))
    return merged.select("doc_id", F.size("m").cast("long").alias("n_spans"), stops.alias("stops"))


@query(f"""WITH s AS ({_span_sql(EMAIL)}), c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1) SELECT doc_id, upper(text) = text AS loud, CASE WHEN lang = 'de' THEN 400 ELSE 200 END::INTEGER AS status, CASE WHEN lang = 'de' THEN 0 ELSE n END AS masked, CASE WHEN lang = 'de' THEN 0 WHEN doc_id % 2 = 0 THEN n ELSE n - 1 END AS restored, CASE WHEN lang = 'de' OR doc_id % 2 = 0 THEN 0 ELSE 1 END AS dropped, CASE WHEN lang = 'de' OR doc_id % 2 = 1 THEN '' ELSE md5(text) END AS digest FROM documents JOIN c USING (doc_id)""")
def translate_masked(spark, d):
    """A client that gives texts back, or without their first sentinel: what is masked, restored and dropped."""
    docs = table(spark, d, "documents").where(F.col("text").rlike(EMAIL))
    from ..functions.text import regex_spans

    e = F.transform(regex_spans(F.col("text"), EMAIL), lambda m: F.struct(F.lit("EMAIL").alias("label"), m["s"].alias("start_char"), m["e"].alias("end_char")))
    rows = docs.select("doc_id", "text", F.when(F.col("lang") == "de", "ko").otherwise(F.col("lang")).alias("lang"), e.alias("entities"), (F.upper("text") == F.col("text")).alias("loud"))
    even, odd = rows.where("doc_id % 2 = 0"), rows.where("doc_id % 2 = 1")
    got = adapters.translate(even, adapters.FunctionClient(lambda p: p)).unionByName(adapters.translate(odd, adapters.FunctionClient(lambda p: p.replace("【PIIab_0】", "【PIIab_77】"))))
    whole = F.when((F.col("status") == 200) & (F.col("doc_id") % 2 == 0), F.md5("translation")).otherwise("")
    return got.join(rows.select("doc_id", "loud", F.col("text").alias("t")), "doc_id").select("doc_id", "loud", "status", *[F.col(c).cast("long").alias(c) for c in ("masked", "restored", "dropped")], F.when((whole != "") & (F.col("translation") != F.trim("t")) & (F.col("translation") == F.regexp_replace("t", r"^\s+|\s+$", "")), F.md5("t")).otherwise(whole).alias("digest"))


@query("""WITH l(lang, loaded, thresholds) AS (VALUES ('en', true, true), ('fr', true, false), ('de', false, false)) SELECT l.lang, loaded, thresholds, 'degraded' AS status, count(doc_id) AS n_docs FROM l LEFT JOIN documents d ON d.lang = l.lang GROUP BY ALL""")
def serving_health(spark, d):
    model = adapters.PatternModel(MODEL)

    def broken():
        raise OSError("no such model")

    models, _ = adapters.load({"en": lambda: model, "fr": lambda: model, "de": broken})
    n = table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n_docs"))
    return adapters.health(spark, ("en", "fr", "de"), models, {"en": {"EMAIL": 0.5}}).join(n, "lang", "left").withColumn("n_docs", F.coalesce("n_docs", F.lit(0).cast("long")))


NAMES = {"PER": r"\b[A-Z][a-z]{5,}\b", "LOC": r"\b[A-Z][a-z]{3,4}\b"}


class Failing:
    """A labeler that refuses some texts."""

    def label_spans(self, text: str) -> list[dict]:
        if len(text) % 5 == 0:
            raise RuntimeError("refused")
        return adapters.PatternLabeler({"PER": NAMES["PER"]}).label_spans(text)


@query(f"""{TOKENS_SQL}, b AS (SELECT doc_id, length(text) % 5 = 0 AS refused FROM documents) SELECT model, count(DISTINCT doc_id) FILTER (WHERE NOT (model = 'failing' AND refused)) AS samples, count(DISTINCT doc_id) FILTER (WHERE model = 'failing' AND refused) AS errors,
 CAST((SELECT count(*) FROM gold g JOIN b b2 USING (doc_id) WHERE NOT (m.model = 'failing' AND b2.refused)) AS BIGINT) AS n_gold FROM b, (VALUES ('failing'), ('patterns')) m(model) GROUP BY model""")
def labeler_bench(spark, d):
    """Two labelers on whole documents: what each could label, and the gold spans it was held to."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    scores = adapters.bench(docs, gold(spark, d), {"failing": Failing(), "patterns": adapters.PatternLabeler(NAMES)})
    return scores.where("type = 'ALL'").select("model", "samples", "errors", "n_gold")


@query(r"""WITH p AS (SELECT conv_id * 1000 + turn AS id, list_filter(list_transform(regexp_split_to_array(regexp_replace(trim(text), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1) || '|\n+'), lambda x: trim(x, ' ' || chr(10))), lambda x: x <> '') AS parts FROM conversations),
f AS (SELECT id, string_split(list_reduce(parts, lambda a, x: a || CASE WHEN length(string_split(a, chr(1))[-1]) < 10 THEN ' ' ELSE chr(1) END || x), chr(1)) AS s FROM p WHERE len(parts) > 0), u AS (SELECT id, unnest(s) AS s, generate_subscripts(s, 1) - 1 AS n FROM f)
SELECT id || '-' || n AS id, CAST(len(regexp_split_to_array(s, '\s+')) AS INTEGER) AS n_tokens, CASE WHEN regexp_matches(s, '^[A-Za-z]') THEN 1 ELSE 0 END AS tagged FROM u""")
def label_records(spark, d):
    """Sentences labelled by a client that names the first word where it is plain."""
    import re

    def answer(prompt: str) -> str:
        m = re.match(r"(?s)[A-Za-z]\S*", prompt.split("Text: ", 1)[1])
        return f'[{{"text": "{m[0]}", "type": "PER"}}]' if m and '"' not in m[0] and "\\" not in m[0] else "none"

    rows = table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text")
    got = adapters.label_records(rows, adapters.FunctionClient(answer), "en")
    return got.select("id", F.size("tokens").alias("n_tokens"), F.when(F.size(F.filter("ner_tags", lambda t: t != "O")) > 0, 1).otherwise(0).alias("tagged"))


@query(f"""{CONTESTED.replace('WITH RECURSIVE', 'WITH')}, w0 AS (SELECT doc_id, regexp_split_to_array(text, '\\s') AS parts FROM documents), w1 AS (SELECT doc_id, unnest(parts) AS word, generate_subscripts(parts, 1) AS i FROM w0), w2 AS (SELECT *, coalesce(sum(length(word) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a FROM w1),
w3 AS (SELECT doc_id, a, a + length(word) AS b, word, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n FROM w2 WHERE word <> ''), w4 AS (SELECT * FROM w3 WHERE n <= 254), w5 AS (SELECT doc_id, a, CASE WHEN rtrim(word, '.,') = '' THEN b ELSE a + length(rtrim(word, '.,')) END AS b FROM w4),
l AS (SELECT doc_id, a, EXISTS (SELECT 1 FROM gold g WHERE g.doc_id = w5.doc_id AND g.start <= a AND b <= g.stop) AS inside FROM w5)
SELECT d.doc_id, CAST(count(a) + 2 AS INTEGER) AS n_mask, CAST(count(*) FILTER (WHERE inside) AS INTEGER) AS n_begin, CAST(count(*) FILTER (WHERE a IS NOT NULL AND NOT inside) AS INTEGER) AS n_out FROM documents d LEFT JOIN l USING (doc_id) GROUP BY 1""")
def encoded_features(spark, d):
    """Features of whole documents for a model of 256 pieces: marks and padding have no label, each gold span holds one word at most."""
    e = gold(spark, d).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(F.col("start").alias("start_char"), F.col("end").alias("end_char"), F.col("type").alias("label")))).alias("entities"))
    rows = table(spark, d, "documents").select("doc_id", "text").join(e, "doc_id", "left")
    f = adapters.encode(rows, adapters.SpaceTokenizer()).select("doc_id", "features.*")
    ids = bio.label_ids()
    begins = F.array(*[F.lit(i) for t, i in ids.items() if t.startswith("B-")])
    many = lambda test: F.size(F.filter("labels", test))
    return f.select("doc_id", F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_mask"), many(lambda x: F.array_contains(begins, x)).alias("n_begin"), many(lambda x: x == 0).alias("n_out"))


@query("SELECT event_type, count(*) AS samples, round(sum(abs(value)), 4) AS total, CAST(sum(event_id % 50) AS BIGINT) AS tokens, round(count(*) / sum(abs(value)), 4) AS samples_per_second, round(sum(event_id % 50) / sum(abs(value)), 2) AS tokens_per_second, round(sum(abs(value)) / count(*), 4) AS avg_per_sample FROM events WHERE value IS NOT NULL GROUP BY 1")
def throughput(spark, d):
    calls = table(spark, d, "events").where("value is not null").select("event_type", F.abs("value").alias("seconds"), (F.col("event_id") % 50).alias("tokens"))
    return adapters.throughput(calls, by=["event_type"]).withColumn("total", F.round("total", 4))


@query("SELECT event_type, round(median(abs(value)), 6) AS median, round(min(abs(value)), 6) AS least, round(max(abs(value)), 6) AS most, count(*) AS reps, round(median(abs(value)) / 7, 3) AS per_text, round(7 / (median(abs(value)) / 1000), 2) AS texts_per_second FROM events WHERE value IS NOT NULL GROUP BY 1")
def bench_summary(spark, d):
    reps = table(spark, d, "events").where("value is not null").select("event_type", F.abs("value").alias("ms"))
    return adapters.repeat_summary(reps, 7, ["event_type"]).withColumns({c: F.round(c, 6) for c in ("median", "least", "most")})


@query()
def admission_reject(spark, d):
    """The events of a day as requests of one server: five at a time, three may wait, for half a minute at most; the tests hold it to a plain simulation."""
    e = table(spark, d, "events").select(F.date_trunc("day", "ts").alias("day"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("arrival"), (F.abs(F.coalesce("value", F.lit(0.0))) * 60).alias("seconds"), F.col("event_id").alias("request_id"))
    return serving.admission(e, "day", "arrival", "seconds", 5, 3, 30.0).groupBy("day", "outcome").agg(F.count("*").alias("n"))


def event_stream(spark, d) -> DataFrame:
    """The events as a stream, whether their table is a file or a folder; event times are instants."""
    schema = table(spark, d, "events").schema
    path, fs = files._path(spark, f"{d}/events.parquet")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4)
    rows = reader.parquet(f"{d}/events.parquet") if fs.getFileStatus(path).isDirectory() else reader.option("pathGlobFilter", "events.parquet").parquet(d)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def streamed(spark, stream: DataFrame) -> DataFrame:
    return streams.run_once(stream, files.scratch(spark, "stream"), files.scratch(spark, "stream-state"))


@query("WITH m AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events) SELECT date_trunc('hour', ts) AS begin, event_type, count(*) AS n FROM events, m WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark GROUP BY ALL")
def streaming_windows(spark, d):
    """Counts of the hours that the watermark has closed, from a stream that runs until nothing is left."""
    counts = streams.windowed_counts(event_stream(spark, d)).select(F.col("window.start").cast("timestamp_ntz").alias("begin"), "event_type", "n")
    return streamed(spark, counts)


@query("""WITH m AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events), w AS (SELECT unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS begin, event_type FROM events) SELECT begin, event_type, count(*) AS n FROM w, m WHERE begin + INTERVAL 2 HOUR <= mark GROUP BY ALL""")
def streaming_sliding_windows(spark, d):
    counts = streams.windowed_counts(event_stream(spark, d), width="2 hours", slide="1 hour").select(F.col("window.start").cast("timestamp_ntz").alias("begin"), "event_type", "n")
    return streamed(spark, counts)


@query("""WITH m AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events), g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, opens DESC ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS begin, max(ts) + INTERVAL 30 MINUTE AS finish, count(*) AS n FROM s, m GROUP BY user_id, k, mark HAVING max(ts) + INTERVAL 30 MINUTE <= mark""")
def streaming_sessions(spark, d):
    rows = streams.sessions(event_stream(spark, d), "user_id")
    return streamed(spark, rows.select("user_id", F.col("session_window.start").cast("timestamp_ntz").alias("begin"), F.col("session_window.end").cast("timestamp_ntz").alias("finish"), "n"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def streaming_first_only(spark, d):
    """Events that come twice within the watermark pass once."""
    s = event_stream(spark, d)
    twice = s.withColumn("again", F.explode(F.array(F.lit(0), F.lit(1)))).drop("again")
    return streamed(spark, streams.first_only(twice, ["event_id"], late="1000 days").select("event_id", "event_type")).groupBy("event_type").agg(F.count("*").alias("n"))


@query("""SELECT doc_id, CASE WHEN regexp_matches(text, '[A-Za-zÀ-ÖØ-öø-ÿ]') THEN 'en' ELSE 'unsupported' END AS resolved, regexp_matches(text, '[A-Za-zÀ-ÖØ-öø-ÿ]') AS answer FROM documents""")
def streaming_languages(spark, d):
    """Documents of a folder as they arrive, with their language."""
    folder = files.scratch(spark, "arrivals")
    table(spark, d, "documents").select("doc_id", "text").write.parquet(folder)
    return streamed(spark, streams.resolved_stream(spark, folder, "doc_id long, text string").select("doc_id", "resolved", "answer"))


@query()
def report_pages(spark, d):
    """Reports as Markdown and text, by name; the tests hold them to their tables."""
    from ..operators import metrics

    g, p = contested(spark, d)
    rows = metrics.errors(g, p)
    pages = {"confusion": reports.confusion_markdown(metrics.confusion(rows)), "scores": reports.scores_text(metrics.strict(g, p)), "errors": reports.errors_markdown(metrics.top_errors(rows, table(spark, d, "documents"), "fn", 5), "Missed")}
    return spark.createDataFrame(sorted(pages.items()), "name string, page string")
