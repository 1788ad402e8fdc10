"""Readers and writers of annotated records, tagged tokens, metrics, predictions and rule tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import files

ENTITY = "struct<label:string,type:string,start_char:int,end_char:int,start:int,end:int,text:string>"
ENTITIES = "array<struct<label:string,start_char:int,end_char:int,text:string>>"
#: fixed values: the labels that a corpus may hold
LABELS = ("PER", "LOC", "ORG", "PROD", "EVT", "DAT", "EMAIL", "PHONE", "ID_NUM", "CREDIT_CARD")
SCORES = "struct<f1:double,precision:double,recall:double,support:long>"


def read_lines(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """Lines that are not blank, with numbers that rise with their place; ``most`` takes the first ones."""
    rows = spark.read.text(path).select(F.monotonically_increasing_id().alias("line"), F.col("value")).where("trim(value) <> ''")
    return rows if most is None else rows.orderBy("line").limit(most)


def parsed(lines: DataFrame, schema: str, needed: str, strict: bool = True) -> DataFrame:
    """Lines as records (``r``); one that is no JSON object with ``needed`` raises, or stays with a null ``r`` if not strict."""
    r = F.from_json("value", schema)
    good = F.col("r").isNotNull() & F.col(f"r.{needed}").isNotNull() & F.try_parse_json("value").isNotNull()
    rows = lines.withColumn("r", r).withColumn("r", F.when(good, F.col("r")))
    if not strict:
        return rows
    return rows.withColumn("r", F.when(F.col("r").isNotNull(), F.col("r")).otherwise(F.raise_error(F.concat(F.lit("not a record: "), F.substring("value", 1, 80))).cast(f"struct<{schema}>")))


def canonical(entities: Column) -> Column:
    """Entities under either spelling of their keys (label or type, start_char or start, end_char or end)."""
    return F.transform(entities, lambda e: F.struct(F.coalesce(e["label"], e["type"]).alias("label"), F.coalesce(e["start_char"], e["start"]).alias("start_char"), F.coalesce(e["end_char"], e["end"]).alias("end_char"), e["text"].alias("text")))


def read_jsonl(spark: SparkSession, path: str, strict: bool = True, labels=LABELS, most: int | None = None) -> DataFrame:
    """Annotated records: line, id, text, orig, entities; both spellings of the keys are read.

    A malformed line and an unknown label raise; without ``strict`` they stay out of
    the result and in that of ``rejected``.
    """
    rows = _records(spark, path, strict, labels, most)
    return rows.where("why is null").drop("why", "value")


def rejected(spark: SparkSession, path: str, labels=LABELS) -> DataFrame:
    """Lines that ``read_jsonl`` without ``strict`` leaves out, and why."""
    return _records(spark, path, False, labels, None).where("why is not null").select("line", "value", "why")


def _records(spark: SparkSession, path: str, strict: bool, labels, most: int | None) -> DataFrame:
    schema = f"id string, text string, orig string, entities array<{ENTITY}>, gold_spans array<{ENTITY}>"
    rows = parsed(read_lines(spark, path, most), schema, "text", strict)
    found = canonical(F.coalesce("r.entities", "r.gold_spans", F.array().cast(f"array<{ENTITY}>")))
    out = rows.select("line", "value", "r.id", "r.text", "r.orig", found.alias("entities"), F.when(F.col("r").isNull(), "malformed").alias("why"))
    known = F.forall("entities", lambda e: F.coalesce(e["label"].isin(*labels), F.lit(False)))
    if not strict:
        return out.withColumn("why", F.coalesce("why", F.when(~known, "label")))
    where = F.concat(F.lit("unknown label in line "), F.col("line").cast("string"), F.lit(", record "), F.coalesce("id", F.lit("?")))
    return out.withColumn("entities", F.when(known, F.col("entities")).otherwise(F.raise_error(where).cast(ENTITIES)))


def read_split(spark: SparkSession, folder: str, split: str = "test", names=("train", "validation", "test"), most: int | None = None) -> DataFrame:
    """Gold records of one split of a corpus: ``folder``/``split``.jsonl; an unknown split raises, labels are not checked."""
    if split not in names:
        raise ValueError(f"unknown split: {split}")
    rows = parsed(read_lines(spark, f"{folder}/{split}.jsonl", most), f"id string, text string, orig string, entities array<{ENTITY}>, gold_spans array<{ENTITY}>", "text")
    found = canonical(F.coalesce("r.gold_spans", "r.entities", F.array().cast(f"array<{ENTITY}>")))
    return rows.select("line", F.coalesce("r.id", F.col("line").cast("string")).alias("id"), "r.text", F.transform(found, lambda e: F.struct(e["text"].alias("text"), e["label"].alias("type"), e["start_char"].alias("start"), e["end_char"].alias("end"))).alias("gold_spans"))


def adapt(rows: DataFrame, text: str = "text", entities: str = "entities", label: str | None = "label", start: str = "start", end: str = "end", span: str | None = None, surface: str | None = None) -> DataFrame:
    """Rows of any table as records (text, entities): its names for the fields, or one field with both offsets.

    Entities without a label field, or with a null one, are MISC; without a surface field the text gives it.
    """
    fields = {f.name for f in rows.schema[entities].dataType.elementType.fields}
    of = lambda e, name: e[name] if name in fields else F.lit(None).cast("string")

    def one(e: Column) -> Column:
        a, b = (e[span][0], e[span][1]) if span else (e[start], e[end])
        words = F.substr(F.col(text), (a + 1).cast("int"), (b - a).cast("int"))
        kind = F.coalesce(of(e, label).cast("string"), F.lit("MISC")) if label else F.lit("MISC")
        return F.struct(kind.alias("label"), a.cast("int").alias("start_char"), b.cast("int").alias("end_char"), (F.coalesce(of(e, surface), words) if surface else words).alias("text"))

    return rows.withColumn("_found", F.transform(F.coalesce(entities, F.array().cast(rows.schema[entities].dataType)), one)).select(F.col(text).alias("text"), F.col("_found").alias("entities"))


def read_tokens(spark: SparkSession, path: str, names: list[str] | None = None, most: int | None = None) -> DataFrame:
    """Token records under either spelling (tokens, ner_tags or words, ner); integer tags decode by ``names``."""
    schema = "id string, tokens array<string>, words array<string>, ner_tags array<string>, ner array<string>, sentence string"
    rows = read_lines(spark, path, most).withColumn("r", F.from_json("value", schema))
    rows = rows.withColumn("tokens", F.coalesce("r.tokens", "r.words"))
    checked = F.when(F.col("tokens").isNotNull(), F.col("tokens")).otherwise(F.raise_error(F.concat(F.lit("not a token record: "), F.substring("value", 1, 80))).cast("array<string>"))
    return rows.select("line", F.coalesce("r.id", F.col("line").cast("string")).alias("id"), checked.alias("tokens"), decoded(F.coalesce("r.ner_tags", "r.ner"), names).alias("ner_tags"), "r.sentence")


def decoded(tags: Column, names: list[str] | None) -> Column:
    """Tags by their numbers in ``names``; a number that has no name raises."""
    if not names:
        return tags
    table = F.array(*[F.lit(n) for n in names])
    return F.transform(tags, lambda t: F.coalesce(F.try_element_at(table, t.cast("int") + 1), F.raise_error(F.concat(F.lit("no name for tag "), t)).cast("string")))


def token_dataset(spark: SparkSession, local: str, other: str | None = None, names: list[str] | None = None, most: int | None = None) -> DataFrame:
    """Token records of the local file if there is one, else of the parquet table ``other``; neither raises FileNotFoundError."""
    if files.exists(spark, local):
        return read_tokens(spark, local, names, most)
    if other is None or not files.exists(spark, other):
        raise FileNotFoundError(f"no dataset at {local} or {other}")
    raw = spark.read.parquet(other)
    column = lambda *found: next((F.col(c) for c in found if c in raw.columns), F.lit(None).cast("string"))
    rows = raw.select(F.monotonically_increasing_id().alias("line"), column("id").cast("string").alias("id"), column("tokens", "words").alias("tokens"), decoded(column("ner_tags", "ner").cast("array<string>"), names).alias("ner_tags"), column("sentence").alias("sentence"))
    return rows if most is None else rows.orderBy("line").limit(most)


def _fold_files(spark: SparkSession, run: str, name: str, schema: str, multiline: bool = True) -> DataFrame:
    raw = spark.read.option("multiLine", multiline).schema(schema).json(f"{run}/fold*/{name}")
    fold = F.regexp_extract(F.col("_metadata.file_path"), rf"fold([0-9]+)/{name}$", 1)
    return raw.withColumn("fold", F.when(fold != "", fold.cast("int"))).where("fold is not null")


def read_fold_metrics(spark: SparkSession, run: str) -> DataFrame:
    """metrics.json of each numbered fold folder: fold, matching, entity (``overall`` too), f1, precision, recall, support.

    The keys with the matching's name count before those without.
    """
    keys = ["per_entity_strict", "per_entity_relaxed", "per_entity"], ["overall_strict", "overall_relaxed", "overall"]
    schema = ", ".join([f"{k} map<string,{SCORES}>" for k in keys[0]] + [f"{k} {SCORES}" for k in keys[1]])
    rows = _fold_files(spark, run, "metrics.json", schema)
    out = None
    for matching in ("strict", "relaxed"):
        per = rows.select("fold", F.lit(matching).alias("matching"), F.explode(F.coalesce(f"per_entity_{matching}", "per_entity")).alias("entity", "m"))
        whole = rows.select("fold", F.lit(matching).alias("matching"), F.lit("overall").alias("entity"), F.coalesce(f"overall_{matching}", "overall").alias("m")).where("m is not null")
        part = per.unionByName(whole).select("fold", "matching", "entity", "m.*")
        out = part if out is None else out.unionByName(part)
    return out


def read_fold_configs(spark: SparkSession, run: str, name: str = "run") -> DataFrame:
    """The plain fields of each fold's metrics.json as a map (a null value stays in it): run, fold, config; raises if there is no fold."""
    raw = spark.read.text(f"{run}/fold*/metrics.json", wholetext=True).withColumn("_path", F.col("_metadata.file_path"))
    fold = F.regexp_extract("_path", r"fold([0-9]+)/metrics\.json$", 1)
    rows = raw.withColumn("fold", F.when(fold != "", fold.cast("int"))).where("fold is not null")
    out = rows.select(F.lit(name).alias("run"), "fold", F.from_json("value", "map<string,string>").alias("config"))
    if not out.head(1):
        raise FileNotFoundError(f"no fold with metrics under {run}")
    return out


def read_pooled(spark: SparkSession, run: str, name: str = "run") -> DataFrame:
    """pooled_metrics.json of a run as a map of its plain fields: run, metrics."""
    raw = spark.read.text(f"{run}/pooled_metrics.json", wholetext=True)
    return raw.select(F.lit(name).alias("run"), F.from_json("value", "map<string,string>").alias("metrics"))


def pooled_scores(pooled: DataFrame, matching: str = "strict") -> DataFrame:
    """F1 of each entity of pooled metrics (``overall`` too): run, entity, f1."""
    block = F.from_json(F.try_element_at("metrics", F.lit(matching)), f"overall {SCORES}, per_entity map<string,{SCORES}>")
    rows = pooled.select("run", block.alias("b"))
    return rows.select("run", F.explode("b.per_entity").alias("entity", "m")).unionByName(rows.select("run", F.lit("overall").alias("entity"), F.col("b.overall").alias("m"))).where("m is not null").select("run", "entity", "m.f1")


def read_predictions(spark: SparkSession, run: str) -> DataFrame:
    """test_predictions.json (a list) of each fold: fold, row, id, text, orig, group, group_key, gold_spans, pred_spans."""
    span = "array<struct<type:string,start:long,end:long,score:double,text:string>>"
    schema = f"array<struct<id:string,text:string,orig:string,`group`:string,group_key:string,gold_spans:{span},pred_spans:{span}>>"
    raw = spark.read.text(f"{run}/fold*/test_predictions.json", wholetext=True).withColumn("_path", F.col("_metadata.file_path"))
    fold = F.regexp_extract("_path", r"fold([0-9]+)/test_predictions\.json$", 1)
    rows = raw.withColumn("fold", F.when(fold != "", fold.cast("int"))).where("fold is not null")
    return rows.select("fold", F.posexplode(F.from_json("value", schema)).alias("row", "r")).select("fold", F.col("row").cast("long").alias("row"), "r.*")


def read_thresholds(spark: SparkSession, path: str) -> dict[str, float]:
    return {k: float(v) for k, v in files.read_json(spark, path)["thresholds"].items()}


def write_thresholds(spark: SparkSession, path: str, cuts: dict[str, float], meta: dict) -> None:
    files.write_json(spark, path, {"thresholds": cuts, "meta": meta})


def write_sigma(spark: SparkSession, path: str, sigma: DataFrame, runs: list[str], matching: str = "strict") -> None:
    """Deviations (entity, sigma) measured once for a setup."""
    files.write_json(spark, path, {"matching": matching, "n_runs": len(runs), "run_dirs": runs, "sigma": {r["entity"]: r["sigma"] for r in sigma.select("entity", "sigma").collect()}})


def read_sigma(spark: SparkSession, path: str) -> DataFrame:
    """Deviations (entity, sigma) of the cache; a file without them gives none."""
    return spark.createDataFrame(sorted(files.read_json(spark, path).get("sigma", {}).items()), "entity string, sigma double")


def section_rows(spark: SparkSession, path: str, heading: str) -> list[str]:
    """The table lines of one section of a Markdown rule file, which ends at the next heading of two or three signs.

    A missing section and one without a table raise, so that no rule passes for an empty one.
    """
    lines = files.read_text(spark, path).split("\n")
    at = next((i for i, line in enumerate(lines) if line.startswith(heading)), None)
    if at is None:
        raise ValueError(f"no section {heading!r} in {path}")
    end = next((i for i in range(at + 1, len(lines)) if lines[i].startswith(("## ", "### "))), len(lines))
    rows = [line for line in lines[at + 1 : end] if line.startswith("|")]
    if not rows:
        raise ValueError(f"no table under {heading!r} in {path}")
    return rows


def write_jsonl(records: DataFrame, path: str) -> None:
    """Records as JSON lines; null fields are left out."""
    records.write.mode("overwrite").json(path)
