"""The query catalogue: each query with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import text as tx
from ..operators import audit, augment, gate, metrics, serving, spans, splits
from .fixture import ANNOTATIONS_SQL, TOKENS_SQL, annotation_sql, gold, pred, table, toks
from .registry import Q, SQL, query

PRF = """round(CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0 END, 6) AS precision, round(CASE WHEN n_gold > 0 THEN tp / n_gold ELSE 0 END, 6) AS recall,
round(CASE WHEN tp > 0 THEN 2.0 * tp / (n_pred + n_gold) ELSE 0 END, 6) AS f1"""
FLAGS = """flags AS (SELECT doc_id, lang, start, stop, type, max(g) AS g, max(p) AS p FROM
 (SELECT doc_id, lang, start, stop, type, 1 AS g, 0 AS p FROM gold UNION ALL SELECT doc_id, lang, start, stop, type, 0, 1 FROM pred) GROUP BY ALL)"""
ERRORS = """touch AS (SELECT g.doc_id, g.start AS gs, g.stop AS ge, g.type AS gt, p.start AS ps, p.stop AS pe, p.type AS pt,
   CASE WHEN g.start = p.start AND g.stop = p.stop AND g.type = p.type THEN 'EXACT' WHEN g.type = p.type THEN 'BOUNDARY' ELSE 'TYPE_MISMATCH' END AS class
   FROM gold g JOIN pred p ON g.doc_id = p.doc_id AND g.start < p.stop AND p.start < g.stop),
 errs AS (SELECT gt, pt, class FROM touch
   UNION ALL SELECT type, NULL, 'MISS' FROM gold g WHERE NOT EXISTS (SELECT 1 FROM touch t WHERE t.doc_id = g.doc_id AND t.gs = g.start AND t.ge = g.stop)
   UNION ALL SELECT NULL, type, 'HALLUCINATION' FROM pred p WHERE NOT EXISTS (SELECT 1 FROM touch t WHERE t.doc_id = p.doc_id AND t.ps = p.start AND t.pe = p.stop))"""


@query(f"""{ANNOTATIONS_SQL}, {FLAGS}, c AS (SELECT coalesce(type, 'ALL') AS type, CAST(sum(g * p) AS BIGINT) AS tp, CAST(sum(p) AS BIGINT) AS n_pred, CAST(sum(g) AS BIGINT) AS n_gold
FROM flags GROUP BY GROUPING SETS ((type), ())) SELECT *, {PRF} FROM c""")
def strict_span_f1(spark, d):
    return metrics.strict(gold(spark, d), pred(spark, d))


@query(f"""{ANNOTATIONS_SQL}, {FLAGS}, c AS (SELECT lang, coalesce(type, 'ALL') AS type, CAST(sum(g * p) AS BIGINT) AS tp, CAST(sum(p) AS BIGINT) AS n_pred, CAST(sum(g) AS BIGINT) AS n_gold
FROM flags GROUP BY GROUPING SETS ((lang, type), (lang))) SELECT *, {PRF} FROM c""")
def strict_span_f1_by_lang(spark, d):
    return metrics.strict(gold(spark, d), pred(spark, d), ["lang"])


@query(f"""{ANNOTATIONS_SQL}, m AS (SELECT g.type, CAST(g.start = p.start AND g.stop = p.stop AS BIGINT) AS cor FROM gold g JOIN pred p ON g.doc_id = p.doc_id AND g.type = p.type AND g.start < p.stop AND p.start < g.stop),
k AS (SELECT type, CAST(sum(cor) AS BIGINT) AS cor, CAST(sum(1 - cor) AS BIGINT) AS par FROM m GROUP BY type),
n AS (SELECT type, CAST(sum(p) AS BIGINT) AS n_pred, CAST(sum(g) AS BIGINT) AS n_gold FROM (SELECT type, 0 AS p, 1 AS g FROM gold UNION ALL SELECT type, 1, 0 FROM pred) GROUP BY type),
b AS (SELECT n.type, coalesce(cor, 0) AS cor, coalesce(par, 0) AS par, n_pred, n_gold FROM n LEFT JOIN k ON n.type = k.type),
c AS (SELECT coalesce(type, 'ALL') AS type, CAST(sum(cor) AS BIGINT) AS cor, CAST(sum(par) AS BIGINT) AS par, CAST(sum(n_pred) AS BIGINT) AS n_pred, CAST(sum(n_gold) AS BIGINT) AS n_gold FROM b GROUP BY GROUPING SETS ((type), ()))
SELECT type, cor, par, n_pred, n_gold, precision, recall, f1 FROM (SELECT *, cor + par * 0.5 AS tp, {PRF} FROM c)""")
def relaxed_span_f1(spark, d):
    return metrics.relaxed(gold(spark, d), pred(spark, d))


@query(f"{ANNOTATIONS_SQL}, {ERRORS} SELECT class, count(*) AS n FROM errs GROUP BY class")
def span_error_classes(spark, d):
    return metrics.errors(gold(spark, d), pred(spark, d)).groupBy("class").agg(F.count("*").alias("n"))


@query(f"{ANNOTATIONS_SQL}, {ERRORS} SELECT coalesce(gt, pt) AS type, class, count(*) AS n FROM errs WHERE class <> 'EXACT' GROUP BY ALL")
def span_errors_by_type(spark, d):
    e = metrics.errors(gold(spark, d), pred(spark, d)).where("class <> 'EXACT'")
    return e.groupBy(F.coalesce("g_type", "p_type").alias("type"), "class").agg(F.count("*").alias("n"))


@query(f"{ANNOTATIONS_SQL}, {ERRORS} SELECT coalesce(gt, '∅') AS gold_type, coalesce(pt, '∅') AS pred_type, count(*) AS n FROM errs GROUP BY ALL")
def confusion_matrix(spark, d):
    e = metrics.errors(gold(spark, d), pred(spark, d))
    return e.groupBy(F.coalesce("g_type", F.lit("∅")).alias("gold_type"), F.coalesce("p_type", F.lit("∅")).alias("pred_type")).agg(F.count("*").alias("n"))


@query(f"""{ANNOTATIONS_SQL}, miss AS (SELECT g.* FROM gold g WHERE NOT EXISTS (SELECT 1 FROM pred p WHERE p.doc_id = g.doc_id AND p.start < g.stop AND g.start < p.stop))
SELECT type, surface, n, CAST(r AS INTEGER) AS r FROM (SELECT *, row_number() OVER (PARTITION BY type ORDER BY n DESC, surface) AS r FROM (SELECT type, surface, count(*) AS n FROM miss GROUP BY ALL)) WHERE r <= 5""")
def top_error_surfaces(spark, d):
    e = metrics.errors(gold(spark, d), pred(spark, d)).where("class = 'MISS'")
    g = gold(spark, d).select("doc_id", F.col("start").alias("g_start"), "surface")
    n = e.join(g, ["doc_id", "g_start"]).groupBy(F.col("g_type").alias("type"), "surface").agg(F.count("*").alias("n"))
    return n.withColumn("r", F.row_number().over(Window.partitionBy("type").orderBy(F.desc("n"), "surface"))).where("r <= 5")


@query(f"""{ANNOTATIONS_SQL}, c AS (SELECT doc_id, surface, type, sum(g) AS g, sum(p) AS p FROM (SELECT doc_id, surface, type, 1 AS g, 0 AS p FROM gold UNION ALL SELECT doc_id, surface, type, 0, 1 FROM pred) GROUP BY ALL),
t AS (SELECT type, CAST(sum(least(g, p)) AS BIGINT) AS tp, CAST(sum(p) AS BIGINT) AS n_pred, CAST(sum(g) AS BIGINT) AS n_gold FROM c GROUP BY type) SELECT *, {PRF} FROM t""")
def text_match_exact(spark, d):
    return metrics.text_match_exact(gold(spark, d), pred(spark, d))


TAGGED = """tagged AS (SELECT t.doc_id, t.tok, t.start, t.word, CASE WHEN g.type IS NULL THEN 'O' ELSE 'B-' || g.type END AS tag FROM toks t LEFT JOIN gold g ON t.doc_id = g.doc_id AND t.tok = g.tok)"""


@query(f"{TOKENS_SQL}, {TAGGED} SELECT tag, count(*) AS n FROM tagged GROUP BY tag")
def bio_encode(spark, d):
    return spans.bio_encode(toks(spark, d), gold(spark, d)).groupBy("tag").agg(F.count("*").alias("n"))


@query(f"{TOKENS_SQL} SELECT doc_id, start, start + length(word) AS stop, type FROM (SELECT g.doc_id, g.start, t.word, g.type FROM gold g JOIN toks t ON g.doc_id = t.doc_id AND g.tok = t.tok)")
def bio_decode_roundtrip(spark, d):
    """Spans that come back from tags: they begin where the gold ones do and end where the token does."""
    return spans.bio_decode(spans.bio_encode(toks(spark, d), gold(spark, d))).select("doc_id", "start", F.col("end").alias("stop"), "type")


@query(f"""{TOKENS_SQL}, {TAGGED}, x AS (SELECT *, lag(tag) OVER (PARTITION BY doc_id ORDER BY tok) AS prev FROM tagged)
SELECT tag, count(*) AS n FROM (SELECT CASE WHEN tag <> 'O' AND prev <> 'O' AND substr(prev, 3) = substr(tag, 3) THEN 'I-' || substr(tag, 3) ELSE tag END AS tag FROM x) GROUP BY tag""")
def bio_repair(spark, d):
    return spans.repair_bio(spans.bio_encode(toks(spark, d), gold(spark, d))).groupBy("tag").agg(F.count("*").alias("n"))


UNITS = "units AS (SELECT md5(text) AS unit, count(*) AS n, min(lang) AS stratum FROM documents GROUP BY 1)"
KFOLD = f"""{UNITS}, folds AS (SELECT unit, n, stratum, CAST((row_number() OVER (PARTITION BY stratum ORDER BY md5('42|' || unit), unit) - 1) % 5 AS INTEGER) AS fold FROM units)"""


def units(spark, d) -> DataFrame:
    return table(spark, d, "documents").groupBy(F.md5("text").alias("unit")).agg(F.count("*").alias("n"), F.min("lang").alias("stratum"))


@query(f"WITH {KFOLD} SELECT unit, fold FROM folds")
def kfold_assignment(spark, d):
    return splits.kfold(units(spark, d), 5, 42, "unit", "stratum").select("unit", "fold")


@query(f"WITH {KFOLD} SELECT stratum, fold, count(*) AS n_units, CAST(sum(n) AS BIGINT) AS n_rows FROM folds GROUP BY ALL")
def kfold_stratum_balance(spark, d):
    return splits.kfold(units(spark, d), 5, 42, "unit", "stratum").groupBy("stratum", "fold").agg(F.count("*").alias("n_units"), F.sum("n").alias("n_rows"))


SPLIT = f"""{UNITS}, c AS (SELECT *, coalesce(sum(n) OVER (ORDER BY md5('7|' || unit), unit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(n) OVER () AS total FROM units),
e AS (SELECT coalesce(max(before + n), 0) AS tested FROM c WHERE before < floor(total * 0.1)),
split AS (SELECT unit, n, CASE WHEN before < floor(total * 0.1) THEN 'test' WHEN before - tested < floor(total * 0.1) THEN 'valid' ELSE 'train' END AS split FROM c, e)"""


@query(f"WITH {SPLIT} SELECT split, count(*) AS n_units, CAST(sum(n) AS BIGINT) AS n_rows FROM split GROUP BY split")
def group_split_sizes(spark, d):
    return splits.quota_split(units(spark, d), 7, "unit", "n", 0.1, 0.1).groupBy("split").agg(F.count("*").alias("n_units"), F.sum("n").alias("n_rows"))


@query(f"""WITH {SPLIT}, r AS (SELECT s.split, doc_id, unit FROM documents JOIN split s ON md5(text) = unit)
SELECT count(*) AS n_leaked FROM (SELECT DISTINCT unit FROM r WHERE split = 'test') a WHERE unit IN (SELECT unit FROM r WHERE split <> 'test')""")
def group_split_leak(spark, d):
    s = splits.quota_split(units(spark, d), 7, "unit", "n", 0.1, 0.1)
    rows = table(spark, d, "documents").select("doc_id", F.md5("text").alias("unit")).join(s, "unit")
    return rows.where("split = 'test'").select("unit").distinct().join(rows.where("split <> 'test'"), "unit", "left_semi").agg(F.count("*").alias("n_leaked"))


@query(f"""{TOKENS_SQL}, w AS (SELECT t.doc_id, count(*) FILTER (WHERE g.tok IS NULL AND regexp_matches(t.word, '[A-Za-z0-9]')) AS n_context FROM toks t LEFT JOIN gold g ON t.doc_id = g.doc_id AND t.tok = g.tok GROUP BY 1),
y AS (SELECT doc_id, count(DISTINCT type) AS n_types FROM gold GROUP BY 1)
SELECT w.doc_id, n_context, coalesce(n_types, 0) AS n_types, n_context >= 20 AND coalesce(n_types, 0) = 5 AS eligible FROM w LEFT JOIN y ON w.doc_id = y.doc_id""")
def holdout_eligibility(spark, d):
    g = gold(spark, d)
    t = toks(spark, d).join(g.select("doc_id", "tok", F.lit(1).alias("in")), ["doc_id", "tok"], "left")
    w = t.groupBy("doc_id").agg(F.count_if(F.col("in").isNull() & F.col("word").rlike("[A-Za-z0-9]")).alias("n_context"))
    y = g.groupBy("doc_id").agg(F.count_distinct("type").alias("n_types"))
    j = w.join(y, "doc_id", "left").withColumn("n_types", F.coalesce("n_types", F.lit(0).cast("long")))
    return j.withColumn("eligible", (F.col("n_context") >= 20) & (F.col("n_types") == 5))


@query("""WITH r AS (SELECT doc_id, md5(text) AS v, doc_id % 5 AS fold FROM documents), f AS (SELECT v, arg_min(fold, doc_id) AS first_fold FROM r GROUP BY v)
SELECT fold, count(*) AS n FROM r JOIN f USING (v) WHERE fold <> first_fold GROUP BY fold""")
def cross_fold_sibling_leak(spark, d):
    r = table(spark, d, "documents").select("doc_id", F.md5("text").alias("v"), (F.col("doc_id") % 5).alias("fold"))
    return splits.sibling_leak(r, "v", "fold", "doc_id").groupBy("fold").agg(F.count("*").alias("n"))


LINE_SQL = """SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents"""


@query(f"""WITH l AS (SELECT DISTINCT doc_id, line FROM ({LINE_SQL})) SELECT b.item_id, count(*) AS n_docs FROM benchmark b JOIN l ON trim(l.line) = trim(b.text) GROUP BY 1""")
def benchmark_leakage(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).select("doc_id", F.trim("line").alias("line")).distinct()
    b = table(spark, d, "benchmark").select("item_id", F.trim("text").alias("line"))
    return lines.join(b, "line").groupBy("item_id").agg(F.count("*").alias("n_docs"))


@query("""SELECT b.item_id, count(DISTINCT d.doc_id) AS n_docs FROM benchmark b JOIN documents d ON contains(d.text, trim(b.text)) WHERE trim(b.text) <> '' GROUP BY 1""")
def benchmark_passages(spark, d):
    return splits.passages(table(spark, d, "documents"), table(spark, d, "benchmark")).groupBy("item_id").agg(F.count("*").alias("n_docs"))


@query("""WITH c AS (SELECT md5(text) AS k, lang, source FROM documents), b AS (SELECT count(DISTINCT k) AS b FROM c),
x AS (SELECT 'lang' AS field, max(d) AS most, CAST(sum(m) AS BIGINT) AS missing FROM (SELECT k, count(DISTINCT lang) AS d, count(*) FILTER (WHERE lang IS NULL) AS m FROM c GROUP BY k)
 UNION ALL SELECT 'source', max(d), CAST(sum(m) AS BIGINT) FROM (SELECT k, count(DISTINCT source) AS d, count(*) FILTER (WHERE source IS NULL) AS m FROM c GROUP BY k)),
n AS (SELECT 'lang' AS field, count(DISTINCT lang) AS n_values FROM c UNION ALL SELECT 'source', count(DISTINCT source) FROM c)
SELECT field, missing, n_values, missing = 0 AND n_values > 1 AND n_values < b AND most = 1 AS stronger FROM x JOIN n USING (field), b""")
def stronger_group_key(spark, d):
    return splits.stronger_keys(table(spark, d, "documents").select(F.md5("text").alias("k"), "lang", "source"), "k", ["lang", "source"])


@query("""WITH r AS (SELECT doc_id, sha256(text) AS d, doc_id // 4096 AS b FROM documents), s AS (SELECT b, sha256(string_agg(d, ',' ORDER BY doc_id, d)) AS d FROM r GROUP BY b)
SELECT substr(sha256(string_agg(d, ',' ORDER BY b)), 1, 16) AS fingerprint FROM s""")
def dataset_fingerprint(spark, d):
    return splits.fingerprint(table(spark, d, "documents"), "doc_id", "text")


RUN_MODULI = (("a", 20), ("b", 25))


def run_scores(spark, d, moduli=RUN_MODULI) -> DataFrame:
    """Unrounded F1 of runs by fold and entity, and over all folds (fold null).

    One pass over the spans of all runs; the scores are few (runs, folds and types), so they become a table of their own.
    """
    span = ["run", "doc_id", "fold", "start", "end", "type"]
    side = lambda df, name: df.withColumns({"run": F.lit(name), "fold": F.col("doc_id") % 5}).select(*span)
    flags = None
    for name, modulus in moduli:
        one = metrics.sides(side(gold(spark, d), name), side(pred(spark, d, modulus), name), span)
        flags = one if flags is None else flags.unionByName(one)
    counts = flags.groupBy("run", "fold", "type").agg(F.sum(F.col("g") * F.col("p")).alias("tp"), F.sum("p").alias("n_pred"), F.sum("g").alias("n_gold"))
    sets = F.explode(F.array(*[F.struct(f.alias("fold"), t.alias("entity")) for f in (F.col("fold"), F.lit(None).cast("long")) for t in (F.col("type"), F.lit("ALL"))])).alias("x")
    summed = counts.select("run", sets, "tp", "n_pred", "n_gold").groupBy("run", "x.fold", "x.entity").agg(*[F.sum(c).alias(c) for c in ("tp", "n_pred", "n_gold")])
    rows = metrics.rated(summed, places=None).select("run", "fold", "entity", "f1")
    return spark.createDataFrame([tuple(r) for r in rows.collect()], rows.schema)


def by_fold(scores: DataFrame) -> DataFrame:
    return scores.where("fold is not null")


def pooled(scores: DataFrame) -> DataFrame:
    return scores.where("fold is null").drop("fold")


def shown(df: DataFrame, *names: str) -> DataFrame:
    """The columns rounded to six places, once everything is compared."""
    return df.withColumns({n: F.round(n, 6) for n in names})


def _run_sql(name: str, p: str, fold: bool) -> str:
    by = "doc_id % 5 AS fold, " if fold else ""
    sets = "GROUPING SETS ((fold, type), (fold))" if fold else "GROUPING SETS ((type), ())"
    return f"""SELECT '{name}' AS run, {'fold, ' if fold else ''}entity, CASE WHEN tp > 0 THEN 2 * tp / (n_pred + n_gold) ELSE 0.0 END AS f1 FROM (
 SELECT {'fold, ' if fold else ''}coalesce(type, 'ALL') AS entity, sum(g * p)::DOUBLE AS tp, sum(p)::DOUBLE AS n_pred, sum(g)::DOUBLE AS n_gold FROM (
  SELECT {by}doc_id, start, stop, type, max(g) AS g, max(p) AS p FROM (SELECT doc_id, start, stop, type, 1 AS g, 0 AS p FROM gold UNION ALL SELECT doc_id, start, stop, type, 0, 1 FROM {p}) GROUP BY ALL) GROUP BY {sets})"""


RUNS = f"{ANNOTATIONS_SQL}, {annotation_sql(25, 'predb')}, scores AS ({_run_sql('a', 'pred', True)} UNION ALL {_run_sql('b', 'predb', True)})"
POOLED = f"pooled AS ({_run_sql('a', 'pred', False)} UNION ALL {_run_sql('b', 'predb', False)})"
DELTAS = """deltas AS (SELECT a.entity, avg(b.f1 - a.f1) AS delta, count(*) FILTER (WHERE b.f1 > a.f1) AS wins, count(*) FILTER (WHERE b.f1 < a.f1) AS losses, count(*) AS n
 FROM scores a JOIN scores b ON a.fold = b.fold AND a.entity = b.entity AND a.run = 'a' AND b.run = 'b' GROUP BY 1)"""
STEADY = "CASE WHEN n >= 2 THEN wins / n >= 2.0::DOUBLE / 3 END AS consistent"
STATUS_SQL = f"""{RUNS}, {DELTAS}, {POOLED}, s AS (SELECT entity, stddev_samp(f1) AS fold_sigma FROM scores WHERE run = 'a' GROUP BY 1),
o(entity, own) AS (VALUES ('PER', 0.0001::DOUBLE), ('LOC', NULL), ('ORG', 0.5)),
x AS (SELECT a.entity, b.f1 - a.f1 AS dd, coalesce(own, fold_sigma) AS sigma, CASE WHEN own IS NULL THEN 'sigma_fold' ELSE 'sigma_repro' END AS band_source, wins, losses, n, {STEADY}
 FROM pooled a JOIN pooled b ON a.entity = b.entity AND a.run = 'a' AND b.run = 'b' LEFT JOIN s ON s.entity = a.entity LEFT JOIN deltas t ON t.entity = a.entity LEFT JOIN o ON o.entity = a.entity),
y AS (SELECT *, CASE WHEN sigma IS NULL THEN 'unknown_sigma' WHEN dd > 2 * sigma THEN 'real_gain' WHEN dd < -2 * sigma THEN 'real_regression' ELSE 'within_noise' END AS raw FROM x),
st AS (SELECT *, CASE WHEN raw = 'real_gain' AND consistent = false THEN 'within_noise' ELSE raw END AS status FROM y)"""


@query(f"{RUNS} SELECT run, entity, round(avg(f1), 6) AS mean, round(stddev_samp(f1), 6) AS sigma, count(*) AS n FROM scores GROUP BY ALL")
def fold_sigma(spark, d):
    return shown(gate.fold_sigma(by_fold(run_scores(spark, d))), "mean", "sigma")


@query(f"""{ANNOTATIONS_SQL}, {annotation_sql(25, 'predb')}, {annotation_sql(12, 'predc')}, pooled AS ({_run_sql('a', 'pred', False)} UNION ALL {_run_sql('b', 'predb', False)} UNION ALL {_run_sql('c', 'predc', False)})
SELECT entity, round(avg(f1), 6) AS mean, round(stddev_samp(f1), 6) AS sigma, count(*) AS n FROM pooled GROUP BY 1""")
def repro_sigma(spark, d):
    return shown(gate.repro_sigma(pooled(run_scores(spark, d, (*RUN_MODULI, ("c", 12))))), "mean", "sigma")


@query(f"{RUNS}, {DELTAS} SELECT entity, round(delta, 6) AS delta, wins, losses, n, {STEADY} FROM deltas")
def paired_deltas(spark, d):
    return shown(gate.paired_deltas(by_fold(run_scores(spark, d)), "a", "b"), "delta")


OVERRIDE = [("PER", 0.0001), ("LOC", None), ("ORG", 0.5)]


@query(f"{STATUS_SQL} SELECT entity, round(dd, 6) AS delta, round(sigma, 6) AS sigma, round(2 * sigma, 6) AS band, band_source, status, wins, losses, n, consistent, coalesce(raw <> status, false) AS downgraded FROM st")
def gate_status(spark, d):
    s = run_scores(spark, d)
    measured = spark.createDataFrame(OVERRIDE, "entity string, sigma double")
    return shown(gate.entity_status(gate.fold_sigma(by_fold(s)), pooled(s), gate.paired_deltas(by_fold(s), "a", "b"), "a", "b", override=measured), "delta", "sigma", "band")


#: rulers, leak counters and targets of the scenarios; the scores are those of the two runs
GATES = {
    "clean": ({}, {}, "group", 0, "group", 0), "other_ruler": ({}, {"seed": "43"}, "group", 0, "group", 0), "lacks_field": ({}, {"stratify": "-"}, "group", 0, "group", 0),
    "leak": ({}, {}, "group", 0, "text", 3), "weak_zero": ({}, {}, "group", 0, "text", 0), "unmeasured": ({}, {}, "none", None, "group", 0), "leak_beats_unmeasured": ({}, {}, "none", None, "orig", 1), "orig": ({}, {}, "orig", 0, "orig", 0),
}
TARGETS = ("PER", "LOC", "ALL", "none")


def _gate_sql() -> str:
    rows = ", ".join(f"('{n}', {str(not b).lower()}, {'NULL' if da is None else da}, '{ba}', {'NULL' if db is None else db}, '{bb}')" for n, (_, b, ba, da, bb, db) in GATES.items())
    return f"""{STATUS_SQL}, sc(scenario, comparable, da, ba, db, bb) AS (VALUES {rows}), tg(target) AS (VALUES {', '.join(f"('{t}')" for t in TARGETS)}),
z AS (SELECT sc.*, target, (SELECT max(status) FROM st WHERE entity = target) AS ts, (SELECT count(*) FROM st WHERE entity <> target AND status = 'real_regression') AS worse FROM sc, tg),
w AS (SELECT *, coalesce(da > 0, false) OR coalesce(db > 0, false) AS leak, coalesce(da = 0 AND ba IN ('group', 'orig'), false) AND coalesce(db = 0 AND bb IN ('group', 'orig'), false) AS clean FROM z)
SELECT scenario, target, CASE WHEN NOT comparable OR NOT (leak OR clean) THEN 'INVALID' WHEN leak THEN 'FAIL' WHEN ts IS NULL THEN 'INVALID' WHEN ts = 'real_regression' OR worse > 0 THEN 'FAIL' WHEN ts = 'real_gain' THEN 'PASS' ELSE 'INCONCLUSIVE' END AS verdict FROM w"""


@query(_gate_sql())
def gate_verdict(spark, d):
    """Verdicts on two scored runs under several rulers, leak counters and targets."""
    s = run_scores(spark, d)
    status = gate.entity_status(gate.fold_sigma(by_fold(s)), pooled(s), gate.paired_deltas(by_fold(s), "a", "b"), "a", "b", override=spark.createDataFrame(OVERRIDE, "entity string, sigma double"))
    ruler = {"lang": "en", "data_fingerprint": "x", "kfold": "5", "group_key": None, "seed": "42", "stratify": "true"}
    config = lambda own: {k: v for k, v in (ruler | own).items() if v != "-"}
    rows = [(name, config(a), config(b), dups_a, basis_a, dups_b, basis_b, target) for name, (a, b, basis_a, dups_a, basis_b, dups_b) in GATES.items() for target in TARGETS]
    cases = spark.createDataFrame(rows, "scenario string, config_a map<string,string>, config_b map<string,string>, dups_a long, basis_a string, dups_b long, basis_b string, target string")
    return gate.judge(cases, status).select("scenario", "target", "verdict")


CUTS = {"PER": 0.6, "ORG": 0.75, "LOC": 0.9}


@query(f"""{ANNOTATIONS_SQL.replace('pred AS (', 'allp AS (')}, pred AS (SELECT * FROM allp WHERE NOT ((type = 'PER' AND score < 0.6) OR (type = 'ORG' AND score < 0.75) OR (type = 'LOC' AND score < 0.9))), {FLAGS},
c AS (SELECT coalesce(type, 'ALL') AS type, CAST(sum(g * p) AS BIGINT) AS tp, CAST(sum(p) AS BIGINT) AS n_pred, CAST(sum(g) AS BIGINT) AS n_gold FROM flags GROUP BY GROUPING SETS ((type), ())) SELECT *, {PRF} FROM c""")
def threshold_apply(spark, d):
    return metrics.at_thresholds(gold(spark, d), pred(spark, d), CUTS)


@query(f"""{ANNOTATIONS_SQL}, s AS (SELECT doc_id, start, stop, type, max(score) AS score FROM pred GROUP BY ALL)
SELECT type, round(quantile_cont(score, 0.1), 6) AS q10, round(quantile_cont(score, 0.5), 6) AS q50, round(quantile_cont(score, 0.98), 6) AS q98 FROM s GROUP BY type""")
def threshold_candidates(spark, d):
    s = pred(spark, d).groupBy("doc_id", "start", "end", "type").agg(F.max("score").alias("score"))
    return s.groupBy("type").agg(*[F.round(F.percentile("score", F.lit(q)), 6).alias(n) for n, q in (("q10", 0.1), ("q50", 0.5), ("q98", 0.98))])


@query(f"""{ANNOTATIONS_SQL}, s AS (SELECT p.type, p.score, g.doc_id IS NOT NULL AS hit FROM pred p LEFT JOIN gold g ON g.doc_id = p.doc_id AND g.start = p.start AND g.stop = p.stop AND g.type = p.type)
SELECT type, cut, count(*) FILTER (WHERE score >= cut) AS n_pred, count(*) FILTER (WHERE score >= cut AND hit) AS tp FROM s, (VALUES (0.5::DOUBLE), (0.6), (0.7), (0.8), (0.9)) c(cut) GROUP BY ALL""")
def threshold_curve(spark, d):
    s = pred(spark, d).join(gold(spark, d).select("doc_id", "start", "end", "type", F.lit(1).alias("hit")), ["doc_id", "start", "end", "type"], "left")
    wide = s.groupBy("type").agg(*[x for c in (0.5, 0.6, 0.7, 0.8, 0.9) for x in (F.count_if(F.col("score") >= c).alias(f"n{int(c * 10)}"), F.count_if((F.col("score") >= c) & F.col("hit").isNotNull()).alias(f"t{int(c * 10)}"))])
    return wide.selectExpr("type", "stack(5, 0.5D, n5, t5, 0.6D, n6, t6, 0.7D, n7, t7, 0.8D, n8, t8, 0.9D, n9, t9) as (cut, n_pred, tp)")


@query()
def threshold_fit(spark, d):
    cuts = metrics.fit_thresholds(gold(spark, d), pred(spark, d))
    return spark.createDataFrame(sorted(cuts.items()), "type string, cut double")


@query(f"""{TOKENS_SQL}, p AS (SELECT doc_id, count(*) AS n, sum(stop - start) AS chars FROM gold GROUP BY 1)
SELECT count(*) AS n_docs, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_entities, CAST(coalesce(sum(chars), 0) AS BIGINT) AS entity_chars, round(sum(chars) / sum(length(text)), 6) AS coverage,
 round(avg(CAST(p.doc_id IS NULL AS INTEGER)), 6) AS empty_ratio FROM documents d LEFT JOIN p ON d.doc_id = p.doc_id""")
def corpus_stats(spark, d):
    return augment.corpus_stats(table(spark, d, "documents"), gold(spark, d))


CARD = r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"


def _span_sql(pattern: str) -> str:
    # marks the matches, then adds up what lies before each
    return f"""WITH m AS (SELECT doc_id, string_split(regexp_replace(text, '({pattern})', chr(1) || '\\1' || chr(2), 'g'), chr(1)) AS parts FROM documents WHERE regexp_matches(text, '{pattern}')),
x AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM m),
y AS (SELECT doc_id, i, string_split(part, chr(2))[1] AS surface, sum(length(part) - CASE WHEN i > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s FROM x)
SELECT doc_id, CAST(s AS INTEGER) AS start, CAST(s + length(surface) AS INTEGER) AS stop, surface FROM y WHERE i > 1"""


def _spans_of(spark, d, pattern: str) -> DataFrame:
    docs = table(spark, d, "documents").where(F.col("text").rlike(pattern))
    return docs.select("doc_id", F.explode(tx.regex_spans(F.col("text"), pattern)).alias("x")).select("doc_id", F.col("x.s").alias("start"), F.col("x.e").alias("stop"), F.col("x.m").alias("surface"))


@query(_span_sql(EMAIL))
def email_spans(spark, d):
    return _spans_of(spark, d, EMAIL)


@query(_span_sql(CARD))
def card_spans(spark, d):
    return _spans_of(spark, d, CARD)




@query(f"""SELECT doc_id, len(regexp_extract_all(text, '{EMAIL}')) AS n_masked, length(regexp_replace(text, '{EMAIL}', '', 'g')) + 9 * len(regexp_extract_all(text, '{EMAIL}')) AS len_masked, true AS same
FROM documents WHERE regexp_matches(text, '{EMAIL}') AND len(regexp_extract_all(text, '{EMAIL}')) <= 10""")
def mask_restore_identity(spark, d):
    docs = table(spark, d, "documents").where(F.col("text").rlike(EMAIL)).withColumn("sp", tx.regex_spans(F.col("text"), EMAIL))
    m = docs.withColumn("masked", spans.mask(F.col("text"), F.col("sp"), "ab"))
    back = spans.restore(F.col("masked"), F.transform("sp", lambda x: x["m"]), "ab")
    return m.select("doc_id", F.size("sp").cast("long").alias("n_masked"), F.length("masked").cast("long").alias("len_masked"), (back == F.col("text")).alias("same"))


@query("""WITH h AS (SELECT CAST('0x' || substr(md5('11|' || doc_id || '|density'), 1, 8) AS BIGINT) % 10000 AS slot FROM documents)
SELECT CASE WHEN slot < 2000 THEN 0 WHEN slot < 6000 THEN 1 WHEN slot < 9000 THEN 2 ELSE 3 END AS n_drawn, count(*) AS n_docs FROM h GROUP BY 1""")
def injection_density(spark, d):
    return table(spark, d, "documents").groupBy(augment.count_drawn(11, F.col("doc_id")).alias("n_drawn")).agg(F.count("*").alias("n_docs"))


VERIFY = f"""{ANNOTATIONS_SQL.replace('WITH words', 'WITH RECURSIVE words')}, gr AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY start, stop, type) AS i FROM gold), pr AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY start, stop, type) AS j FROM pred),
steps AS (SELECT doc_id, 0::BIGINT AS i, []::BIGINT[] AS used, NULL::BIGINT AS hit FROM (SELECT DISTINCT doc_id FROM gr)
 UNION ALL SELECT doc_id, i + 1, CASE WHEN best IS NULL THEN used ELSE list_append(used, best) END, best FROM (
  SELECT s.doc_id, s.i, any_value(s.used) AS used, coalesce(min(p.j) FILTER (WHERE p.surface = g.surface), min(p.j)) AS best
  FROM steps s JOIN gr g ON g.doc_id = s.doc_id AND g.i = s.i + 1 LEFT JOIN pr p ON p.doc_id = s.doc_id AND NOT list_contains(s.used, p.j) AND (p.surface = g.surface
   OR ((contains(p.surface, g.surface) OR contains(g.surface, p.surface)) AND least(length(p.surface), length(g.surface)) / greatest(length(p.surface), length(g.surface)) >= 0.7)) GROUP BY s.doc_id, s.i)),
o AS (SELECT g.doc_id, g.start, g.type, CASE WHEN g.type = 'EVT' THEN 'exempt' WHEN p.type IS NULL THEN 'missed' WHEN p.type = g.type THEN 'confirmed' ELSE 'conflict' END AS outcome
 FROM gr g JOIN steps s ON s.doc_id = g.doc_id AND s.i = g.i LEFT JOIN pr p ON p.doc_id = g.doc_id AND p.j = s.hit)"""
VERIFY_LABELS = ["PER", "LOC", "ORG", "PROD"]
OUTCOMES = ("confirmed", "conflict", "missed", "exempt")


def outcomes(spark, d) -> DataFrame:
    return augment.verify_outcomes(gold(spark, d), pred(spark, d), VERIFY_LABELS)


@query(f"{VERIFY} SELECT outcome, count(*) AS n FROM o GROUP BY outcome")
def verify_outcomes(spark, d):
    return outcomes(spark, d).groupBy("outcome").agg(F.count("*").alias("n"))


@query(f"{VERIFY} SELECT coalesce(type, 'ALL') AS type, " + ", ".join(f"count(*) FILTER (WHERE outcome = '{x}') AS {x}" for x in OUTCOMES) + " FROM o GROUP BY GROUPING SETS ((type), ())")
def verify_report(spark, d):
    return augment.verify_report(outcomes(spark, d))


@query(f"{VERIFY} SELECT doc_id, start, type, outcome FROM o WHERE outcome IN ('missed', 'conflict')")
def verify_details(spark, d):
    return outcomes(spark, d).where("outcome in ('missed', 'conflict')").select("doc_id", "start", "type", "outcome")


@query(f"""{VERIFY}, bad AS (SELECT DISTINCT doc_id FROM o WHERE outcome IN ('missed', 'conflict')), t AS (SELECT count(*) AS total FROM documents), b AS (SELECT count(*) AS dropped FROM bad)
SELECT 'keep_all' AS policy, total, total AS kept, 0 AS dropped, (SELECT count(*) FROM o) AS n_entities FROM t UNION ALL SELECT 'drop_span', total, total, 0, (SELECT count(*) FROM o WHERE outcome NOT IN ('missed', 'conflict')) FROM t
UNION ALL SELECT 'drop_record', total, total - dropped, dropped, (SELECT count(*) FROM o WHERE doc_id NOT IN (SELECT doc_id FROM bad)) FROM t, b""")
def verify_policy_kept(spark, d):
    o, docs = outcomes(spark, d), table(spark, d, "documents").select("doc_id")
    parts = [augment.verify_totals(o, docs, p).select(F.lit(p).alias("policy"), "*") for p in ("keep_all", "drop_span", "drop_record")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""SELECT role, count(*) AS n_turns, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(sum(len(list_filter(string_split_regex(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: length(trim(x)) >= 10))) AS BIGINT) AS n_long FROM conversations GROUP BY role""")
def sentence_stats(spark, d):
    parts = F.filter(F.split("text", r"(?<=[.!?])\s+"), lambda x: F.length(F.trim(x)) >= 10)
    return table(spark, d, "conversations").groupBy("role").agg(F.count("*").alias("n_turns"), F.sum(F.length("text")).alias("chars"), F.sum(F.size(parts).cast("long")).alias("n_long"))


@query(f"{TOKENS_SQL} SELECT CASE type WHEN 'PROD' THEN 'ORG' WHEN 'EVT' THEN 'LOC' ELSE type END AS label, count(*) AS n FROM gold GROUP BY 1")
def label_merge(spark, d):
    return gold(spark, d).groupBy(tx.merge_label(F.col("type"), {"PROD": "ORG", "EVT": "LOC"}).alias("label")).agg(F.count("*").alias("n"))


FREQUENT = "freq AS (SELECT surface FROM gold GROUP BY 1 HAVING count(*) >= 3)"


def _dictionary(spark, d) -> DataFrame:
    return gold(spark, d).groupBy("surface").agg(F.count("*").alias("n")).where("n >= 3").select("surface")


@query(f"{TOKENS_SQL}, {FREQUENT} SELECT word AS surface, count(*) AS n FROM toks WHERE word IN (SELECT surface FROM freq) GROUP BY 1")
def dictionary_mentions(spark, d):
    return audit.mentions(toks(spark, d), _dictionary(spark, d)).groupBy("surface").agg(F.count("*").alias("n"))


MISSING = """lost AS (SELECT t.doc_id, t.start, t.start + length(t.word) AS stop, t.word AS surface FROM toks t WHERE t.word IN (SELECT surface FROM freq)
 AND NOT EXISTS (SELECT 1 FROM pred p WHERE p.doc_id = t.doc_id AND p.start < t.start + length(t.word) AND t.start < p.stop))"""


@query(f"{ANNOTATIONS_SQL}, {FREQUENT}, {MISSING} SELECT * FROM lost")
def unlabeled_mentions(spark, d):
    return audit.uncovered(audit.mentions(toks(spark, d), _dictionary(spark, d)), pred(spark, d)).withColumnRenamed("end", "stop")


@query(f"{ANNOTATIONS_SQL}, {FREQUENT}, {MISSING} SELECT * FROM lost WHERE doc_id % 3 <> 0")
def ledger_exclusion(spark, d):
    lost = audit.uncovered(audit.mentions(toks(spark, d), _dictionary(spark, d)), pred(spark, d))
    ledger = lost.where("doc_id % 3 = 0").select("doc_id", "start", "end", F.lit("NOT").alias("verdict"))
    return audit.exclude_judged(lost, ledger).withColumnRenamed("end", "stop")


def _anywhere(spark, d) -> DataFrame:
    return audit.mentions_anywhere(table(spark, d, "documents").select("doc_id", "text"), _dictionary(spark, d))


@query()
def dictionary_mentions_anywhere(spark, d):
    return _anywhere(spark, d).groupBy("surface").agg(F.count("*").alias("n"))


@query()
def unlabeled_mentions_anywhere(spark, d):
    return audit.uncovered(_anywhere(spark, d), pred(spark, d)).withColumnRenamed("end", "stop")


@query()
def ledger_exclusion_anywhere(spark, d):
    lost = audit.uncovered(_anywhere(spark, d), pred(spark, d))
    ledger = lost.where("doc_id % 3 = 0").select("doc_id", "start", "end", F.lit("NOT").alias("verdict"))
    return audit.exclude_judged(lost, ledger).withColumnRenamed("end", "stop")


STATUS = "CASE WHEN event_type = 'error' THEN 500 WHEN value IS NULL OR value < 0 THEN 400 ELSE 200 END"


@query(f"SELECT date_trunc('day', ts) AS day, event_type, {STATUS} AS status, count(*) AS n FROM events GROUP BY ALL")
def request_log_summary(spark, d):
    return table(spark, d, "events").groupBy(F.date_trunc("day", "ts").alias("day"), "event_type", F.expr(STATUS).alias("status")).agg(F.count("*").alias("n"))


@query("SELECT event_type, round(quantile_disc(value, 0.5), 6) AS p50, round(quantile_disc(value, 0.95), 6) AS p95, round(max(value), 6) AS longest, count(*) AS n FROM events GROUP BY 1")
def latency_percentiles(spark, d):
    e = table(spark, d, "events")
    disc = lambda q: F.round(F.expr(f"percentile_disc({q}) within group (order by value)"), 6)
    return e.groupBy("event_type").agg(disc(0.5).alias("p50"), disc(0.95).alias("p95"), F.round(F.max("value"), 6).alias("longest"), F.count("*").alias("n"))


SWEEP = """iv AS (SELECT date_trunc('day', ts) AS day, epoch_us(ts) AS s, epoch_us(ts) + CAST(floor(abs(value)) AS BIGINT) * 60000000 AS e FROM events),
mk AS (SELECT day, s AS t, 1 AS d FROM iv UNION ALL SELECT day, e, -1 FROM iv), st AS (SELECT day, t, d, sum(d) AS s FROM mk GROUP BY ALL)"""


@query(f"WITH {SWEEP} SELECT day, CAST(max(o) AS BIGINT) AS peak FROM (SELECT day, sum(s) OVER (PARTITION BY day ORDER BY t, d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS o FROM st) GROUP BY day")
def inflight_sweep(spark, d):
    e = table(spark, d, "events").select(F.date_trunc("day", "ts").alias("day"), F.unix_micros(F.col("ts").cast("timestamp")).alias("s"), "value")
    return serving.in_flight(e.withColumn("e", F.col("s") + F.floor(F.abs("value")) * 60_000_000), "day", "s", "e")


@query("SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS item_idx, lang FROM documents")
def batch_by_lang_order(spark, d):
    return serving.number_within(table(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id")


@query(f"""{ANNOTATIONS_SQL}, {annotation_sql(25, 'predb')}, {annotation_sql(12, 'predc')}, x AS ({_run_sql('m20', 'pred', False)} UNION ALL {_run_sql('m25', 'predb', False)} UNION ALL {_run_sql('m12', 'predc', False)})
SELECT run AS model, round(f1, 6) AS f1 FROM x WHERE entity = 'ALL'""")
def llm_bench_table(spark, d):
    g = gold(spark, d)
    parts = [metrics.strict(g, pred(spark, d, m)).where("type = 'ALL'").select(F.lit(f"m{m}").alias("model"), "f1") for m in (20, 25, 12)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


from . import labels, rulebook, service, texts  # noqa: E402, F401 - they add their queries


def queries() -> dict:
    return dict(Q)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
