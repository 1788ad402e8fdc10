"""Models, tokenizers and language-model clients as plain Python objects, run over Arrow batches.

An object is handed to the executors once per task; rows go through it in batches
and come back as ordinary columns, so everything around a model stays a plan.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType

from ..functions import align, chunking, text as tx
from . import bio, metrics
from .bio import IGNORED, label_ids, merge_mail

SPANS = "array<struct<type:string,start:int,end:int,score:double>>"


class Tokenizer(Protocol):
    """Sub-words with offsets, and the ids of the marks around a text and of the padding."""

    begin: int
    end: int
    pad: int

    def pieces(self, text: str) -> list[tuple[int, int, int]]: ...


class SpanModel(Protocol):
    """Spans (type, start, end, score) of each text of a batch."""

    def predict(self, texts: list[str]) -> list[list[dict]]: ...


class Labeler(Protocol):
    """Surface spans (text, type) of a text, without offsets."""

    def label_spans(self, text: str) -> list[dict]: ...


class Client(Protocol):
    """A language model: the answer to a prompt."""

    def generate(self, prompt: str) -> str: ...


class SpaceTokenizer:
    """Words between white space; their ids are checksums.  ``size`` cuts longer words into pieces."""

    begin, end, pad = 1, 2, 0

    def __init__(self, size: int | None = None):
        self.size = size

    def pieces(self, text: str) -> list[tuple[int, int, int]]:
        out = []
        for m in re.finditer(r"\S+", text):
            step = self.size or len(m[0])
            out += [(3 + zlib.crc32(text[a : min(a + step, m.end())].encode()) % 50_000, a, min(a + step, m.end())) for a in range(m.start(), m.end(), step)]
        return out


class WholeWordTokenizer:
    """Another tokenizer's pieces with the offsets of the word they are part of, as tokenizers without offsets need it."""

    def __init__(self, inner: Tokenizer):
        self.inner, self.begin, self.end, self.pad = inner, inner.begin, inner.end, inner.pad

    def pieces(self, text: str) -> list[tuple[int, int, int]]:
        return [(i, m.start(), m.end()) for m in re.finditer(r"\S+", text) for i, _, _ in self.inner.pieces(m[0])]


class PatternModel:
    """Spans by a pattern for each type: a stand-in where no trained model is at hand."""

    def __init__(self, patterns: dict[str, str], score: float = 0.9):
        self.patterns, self.score = patterns, score

    def predict(self, texts: list[str]) -> list[list[dict]]:
        return [sorted(({"type": t, "start": m.start(), "end": m.end(), "score": self.score} for t, p in self.patterns.items() for m in re.finditer(p, text)), key=lambda s: (s["start"], s["end"])) for text in texts]


class PatternLabeler:
    """Surface spans by patterns, as a labeler gives them."""

    def __init__(self, patterns: dict[str, str]):
        self.patterns = patterns

    def label_spans(self, text: str) -> list[dict]:
        return [{"text": m[0], "type": t} for t, p in self.patterns.items() for m in re.finditer(p, text)]


class FunctionClient:
    """A client from a function of the prompt."""

    def __init__(self, answer: Callable[[str], str]):
        self.generate = answer


def trim_piece(text: str, start: int, end: int) -> tuple[int, int]:
    """A piece without white space at its ends and stops at its end; as it was if nothing were left."""
    inner = text[start:end].rstrip(" \t\r\n\f\v.,").lstrip()
    at = start + len(text[start:end]) - len(text[start:end].lstrip())
    return (at, at + len(inner)) if inner else (start, end)


def encoded(text: str, entities: list[dict], tokenizer: Tokenizer, ids: dict[str, int], max_length: int) -> dict:
    """Ids, mask, labels and offsets of one text; marks and what is cut off have no label, padding has no mask.

    A piece gets the label of the first entity that holds all of it.
    """
    rows, last = [(tokenizer.begin, IGNORED, 0, 0)], None
    for i, a, b in tokenizer.pieces(text)[: max_length - 2]:
        a, b = trim_piece(text, a, b)
        held = None if (a, b) == (0, 0) else next((e for e in entities if e["start_char"] <= a and b <= e["end_char"]), None)
        now = held and (held["start_char"], held["end_char"], held["label"])
        label = IGNORED if (a, b) == (0, 0) else ids[f"{'I' if now == last else 'B'}-{now[2]}"] if now else ids["O"]
        rows.append((i, label, a, b))
        last = now
    rows.append((tokenizer.end, IGNORED, 0, 0))
    labels = [r[1] for r in rows]
    mask = [1] * len(rows) + [0] * (max_length - len(rows))
    rows += [(tokenizer.pad, IGNORED, 0, 0)] * (max_length - len(rows))
    return {"input_ids": [r[0] for r in rows], "attention_mask": mask, "labels": labels, "offsets": [{"s": r[2], "e": r[3]} for r in rows]}


ENCODED = "struct<input_ids:array<int>,attention_mask:array<int>,labels:array<int>,offsets:array<struct<s:int,e:int>>>"


def encode(records: DataFrame, tokenizer: Tokenizer, max_length: int = 256, types=bio.NER_TYPES + bio.PII_TYPES) -> DataFrame:
    """``records`` (text, entities) with features for a model in ``features``; unknown labels raise."""
    from ..functions.rowwise import rowwise

    ids = label_ids(types)
    return records.withColumn("features", rowwise(lambda t, e: encoded(t or "", e or [], tokenizer, ids, max_length), ENCODED)(F.col("text"), F.col("entities")))


def over_batches(rows: DataFrame, columns: list[str], fn: Callable[[list[tuple]], Iterable[tuple]], schema: str) -> DataFrame:
    """``fn`` of the batches of ``columns`` as tuples; what it gives are rows of ``schema``."""
    kinds = to_arrow_schema(DataType.fromDDL(f"struct<{schema}>"))

    def run(batches):
        for batch in batches:
            out = list(fn(list(zip(*(c.to_pylist() for c in batch.columns)))))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(kinds)], schema=kinds)

    return rows.select(*columns).mapInArrow(run, schema)


def infer(texts: DataFrame, models: dict[str, SpanModel], max_length: int = 256, count: chunking.Count = chunking.word_count, thresholds: dict[str, dict[str, float]] | None = None, key: str = "doc_id") -> DataFrame:
    """Entities of whole texts (key, lang, text), with a status: 200, or 503 where no model of the language is loaded.

    Texts are composed, cut into tiles, predicted tile by tile, moved back to their
    places; pieces of mail addresses become one, thresholds of the language cut, and
    the canonical form has the surface.  A language without letters of any model
    (``unsupported``) answers 200 with nothing.
    """
    rows = texts.withColumn("text", tx.nfc(F.col("text"))).withColumn("tiles", chunking.tiles(F.col("text"), max_length, count))
    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def predict(batch):
        by: dict[str, list] = {}
        for n, (_, lang, _, tiles) in enumerate(batch):
            if lang in models:
                by.setdefault(lang, []).extend((n, t["chunk"], t["base"]) for t in tiles or [])
        found: list[list[dict]] = [[] for _ in batch]
        for lang, tiles in by.items():  # one call for each language of the batch, in the order of the rows
            for (n, _, base), spans in zip(tiles, models[lang].predict([c for _, c, _ in tiles])):
                found[n] += [{**s, "start": s["start"] + base, "end": s["end"] + base, "score": s.get("score")} for s in spans]
        for (key_, lang, text, _), spans in zip(batch, found):
            yield key_, lang, text, spans, 200 if lang in models or lang == "unsupported" else 503

    got = over_batches(rows, [key, "lang", "text", "tiles"], predict, f"`{key}` {kind[key]}, lang string, text string, spans {SPANS}, status int")
    got = got.withColumn("spans", merge_mail(F.col("text"), F.col("spans")))
    for lang, cuts in (thresholds or {}).items():
        table = F.create_map(*[F.lit(x) for kv in cuts.items() for x in kv])
        keep = lambda s: F.coalesce(s["score"] >= F.try_element_at(table, s["type"]), F.lit(True))  # noqa: B023, E731
        got = got.withColumn("spans", F.when(F.col("lang") == lang, F.filter("spans", keep)).otherwise(F.col("spans")))
    return got.withColumn("entities", canonical(F.col("spans"), F.col("text"))).drop("spans")


def canonical(spans: Column, text: Column) -> Column:
    """Spans (type, start, end, score) as entities with label, offsets, surface and score."""
    return F.transform(spans, lambda s: F.struct(s["type"].alias("label"), s["start"].alias("start_char"), s["end"].alias("end_char"), tx.surface(text, s["start"], s["end"]).alias("text"), s["score"].alias("score")))


def internal(entities: Column) -> Column:
    """Entities (label, start_char, end_char) as spans (type, start, end)."""
    return F.transform(entities, lambda e: F.struct(e["label"].alias("type"), e["start_char"].alias("start"), e["end_char"].alias("end")))


def evaluate(gold: DataFrame, texts: DataFrame, models: dict[str, SpanModel], thresholds: dict[str, dict[str, float]] | None = None, key: str = "doc_id") -> DataFrame:
    """Strict scores of models on texts with gold spans (key, start, end, type)."""
    found = infer(texts, models, thresholds=thresholds, key=key).select(key, F.explode("entities").alias("e"))
    return metrics.strict(gold, found.select(key, F.col("e.start_char").cast("long").alias("start"), F.col("e.end_char").cast("long").alias("end"), F.col("e.label").alias("type")), keys=[key, "start", "end", "type"])


def prediction_digest(predictions: DataFrame, order: str, column: str) -> str:
    """Digest of predictions in order, by blocks, so that a fixed model can be held to its answers."""
    from .splits import fingerprint

    return fingerprint(predictions.select(order, F.to_json(F.struct(column)).alias("_p")), order, "_p").first()[0] or ""


#: what a labeler is asked for, by language (own wording)
LABEL_PROMPT = "List the named entities of the text as JSON objects with text and type. Types: {types}.\nText: {sentence}"
#: fixed values: types that are asked for, by language
ENTITY_TYPES = {"ko": ("PER", "LOC", "ORG", "DAT", "TI", "QT"), **{x: bio.NER_TYPES + bio.PII_TYPES for x in ("ja", "vi", "en")}}


def label_prompt(sentence: Column, lang: str) -> Column:
    return F.concat(F.lit(LABEL_PROMPT.split("{sentence}")[0].format(types=", ".join(ENTITY_TYPES[lang]))), sentence)


def ask(rows: DataFrame, client: Client, prompt: str = "prompt", answer: str = "answer") -> DataFrame:
    """``rows`` with the client's answers and the words of prompt and answer; a call that fails gives a null answer and its error."""
    names = rows.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    place = names.index(prompt)

    def run(batch):
        for row in batch:
            try:
                got, error = client.generate(row[place]), None
            except Exception as e:  # noqa: BLE001 - a failed call is counted, not raised
                got, error = None, f"{type(e).__name__}: {e}"
            yield *row, got, error, len((row[place] or "").split()), len((got or "").split())

    return over_batches(rows, [f"`{n}`" for n in names], run, f"{schema}, `{answer}` string, error string, prompt_tokens int, answer_tokens int")


def label_records(records: DataFrame, client: Client, lang: str = "ko", key: str = "doc_id") -> DataFrame:
    """Tagged words of each sentence (id: record and sentence), as the client labels them."""
    cut = records.select(key, F.posexplode(tx.sentences(F.col("text"), lang)).alias("n", "sentence")).where("trim(sentence) <> ''")
    asked = ask(cut.withColumn("prompt", label_prompt(F.col("sentence"), lang)), client)
    tokens = F.filter(F.split("sentence", r"(?U)\s+"), lambda t: t != "")
    spans = F.coalesce(tx.parse_spans(F.col("answer")), F.array().cast("array<struct<text:string,type:string>>"))
    named = asked.withColumn("tokens", tokens).withColumn("spans", spans)
    return named.select(F.concat_ws("-", F.col(key).cast("string"), F.col("n").cast("string")).alias("id"), key, "n", "tokens", align.tagged_words(F.col("tokens"), F.col("spans")).alias("ner_tags"), "prompt_tokens", "answer_tokens", "error")


def call(labeler, text: str) -> list[dict]:
    """A labeler's spans of a whole text; one that knows no ``split`` is called plainly."""
    try:
        return labeler.label_spans(text, split=False)
    except TypeError:
        return labeler.label_spans(text)


def label_spans(records: DataFrame, labeler: Labeler, key: str = "doc_id") -> DataFrame:
    """Records (key, text) with the labeler's spans, and an error where it failed."""
    kind = dict(records.dtypes)[key]

    def run(batch):
        for key_, text in batch:
            try:
                yield key_, text, [{"text": s.get("text"), "type": s.get("type")} for s in call(labeler, text or "")], None
            except Exception as e:  # noqa: BLE001 - a failed record is counted, not raised
                yield key_, text, None, f"{type(e).__name__}: {e}"

    return over_batches(records, [key, "text"], run, f"`{key}` {kind}, text string, found array<struct<text:string,type:string>>, error string")


def bench(records: DataFrame, gold: DataFrame, labelers: dict[str, Labeler], key: str = "doc_id", most: int | None = None) -> DataFrame:
    """Strict scores of each labeler (model) on the records it could label, with how many it could and could not.

    ``most`` takes the first records by key.
    """
    out = None
    chosen = records if most is None else records.orderBy(key).limit(most)
    for name, labeler in labelers.items():
        got = label_spans(chosen, labeler, key).withColumn("placed", align.placed(F.col("text"), F.col("found")))
        fine = got.where("error is null")
        pred = fine.select(key, F.explode("placed").alias("s")).select(key, F.col("s.start").cast("long").alias("start"), F.col("s.end").cast("long").alias("end"), F.col("s.type").alias("type"))
        scores = metrics.strict(gold.join(fine.select(key), key, "left_semi"), pred, keys=[key, "start", "end", "type"])
        counts = got.agg(F.count_if(F.col("error").isNull()).alias("samples"), F.count("error").alias("errors"))
        part = scores.crossJoin(F.broadcast(counts)).withColumn("model", F.lit(name))  # one row
        out = part if out is None else out.unionByName(part)
    return out


def bench_tags(records: DataFrame, labeler: Labeler, lang: str = "ko", key: str = "doc_id") -> DataFrame:
    """Gold and predicted tags side by side (key, tok, gold, pred) for records (tokens, ner_tags, sentence or null).

    The labeler sees the sentence without its markup, else the text of the tokens;
    its spans go onto the syllables where there are blank tokens, else onto the words.
    """
    text = F.when(F.coalesce("sentence", F.lit("")) != "", tx.strip_markup(F.col("sentence"))).otherwise(tx.reconstruct(F.col("tokens")))
    rows = records.withColumn("text", text)
    found = label_spans(rows.select(key, "text"), labeler, key).where("error is null").select(key, "found")
    both = rows.join(found, key).withColumn("blank", F.exists("tokens", lambda t: tx.trim_all(t) == ""))
    words = F.filter(F.split("text", r"(?U)\s+"), lambda t: t != "")
    both = both.withColumn("words", words).withColumn("word_tags", align.tagged_words(F.col("words"), F.col("found")))
    both = both.withColumn("on_syllables", align.tagged_syllables(F.col("text"), F.col("tokens"), F.col("found"), lang)).withColumn("on_words", align.tags_on(F.col("tokens"), F.col("words"), F.col("word_tags"), lang))
    pred = F.when(F.col("blank"), F.col("on_syllables")).otherwise(F.col("on_words"))
    gold = F.transform("ner_tags", lambda t: tx.normalize_tag(t, F.lit(lang)))
    return both.select(key, F.posexplode(F.arrays_zip(F.col("tokens").alias("token"), gold.alias("gold"), pred.alias("pred"))).alias("tok", "x")).select(key, "tok", "x.token", "x.gold", "x.pred")


def labeler_of(spec: str, lang: str, backends: dict[str, Callable[[str], Labeler]]) -> tuple[str, Labeler]:
    """``backend:model`` as a labeler; Japanese has only language-model backends (``vllm``)."""
    backend, colon, model = spec.partition(":")
    if not colon:
        raise ValueError(f"not of the form backend:model: {spec!r}")
    if backend not in backends or (lang == "ja" and backend != "vllm"):
        raise ValueError(f"unknown backend for {lang}: {backend!r}")
    return backend, backends[backend](model)


def eval_mode(lang: str) -> str:
    """Whether gold is held as offsets or as tags."""
    return "offset_span" if lang in ("ja", "vi") else "bio"


def throughput(calls: DataFrame, seconds: str = "seconds", by: list[str] | None = None) -> DataFrame:
    """Samples, tokens and rates of calls (seconds, tokens), each with its own time."""
    one = calls.groupBy(*(by or [])).agg(F.count("*").alias("samples"), F.sum(seconds).alias("total"), F.sum("tokens").alias("tokens"))
    rate = lambda n: F.when(F.col("total") > 0, F.col(n) / F.col("total")).otherwise(F.lit(0.0))
    return one.withColumns({"samples_per_second": F.round(rate("samples"), 4), "tokens_per_second": F.round(rate("tokens"), 2), "avg_per_sample": F.round(F.col("total") / F.col("samples"), 4)})


def repeat_summary(reps: DataFrame, n_texts: int, by: list[str] | None = None) -> DataFrame:
    """Median, least and most milliseconds of repeated runs (ms), and texts a second at the median."""
    one = reps.groupBy(*(by or [])).agg(F.median("ms").alias("median"), F.min("ms").alias("least"), F.max("ms").alias("most"), F.count("*").alias("reps"))
    return one.withColumns({"per_text": F.round(F.col("median") / n_texts, 3), "texts_per_second": F.round(F.lit(n_texts) / (F.col("median") / 1000), 2)})


#: own wording of the request to weave values into a text, by language
INJECT_PROMPTS = {
    "en": "Rewrite the text so that every value below appears in it word for word.\nText: {text}\nValues:\n{values}",
    "ja": "次の値をすべてそのまま含むように文章を書き直してください。\n文章: {text}\n値:\n{values}",
    "ko": "아래 값이 모두 그대로 들어가도록 글을 고쳐 쓰세요.\n글: {text}\n값:\n{values}",
    "vi": "Hãy viết lại đoạn văn sao cho mọi giá trị dưới đây xuất hiện nguyên văn.\nĐoạn văn: {text}\nGiá trị:\n{values}",
}


def inject_prompt(text: Column, values: Column, lang: str) -> Column:
    """The request for a text and its values (label, value); none gives ``(none)``; unknown languages raise."""
    if lang not in INJECT_PROMPTS:
        raise ValueError(f"no prompt for language {lang!r}")
    listed = F.array_join(F.transform(values, lambda v: F.concat(F.lit("- "), v["type"], F.lit(": "), v["text"])), "\n")
    head, middle = INJECT_PROMPTS[lang].split("{text}")
    between = middle.split("{values}")[0]
    return F.concat(F.lit(head), text, F.lit(between), F.when(F.size(values) > 0, listed).otherwise(F.lit("(none)")))


def inject_by(records: DataFrame, client: Client, values: Column, lang: str, merge: dict[str, str] | None = None) -> DataFrame:
    """Records (text, entities) rewritten by a client so that they hold the values (type, text), with all places found anew.

    Records without values stay as they are; a record whose answer lacks a value,
    or whose call failed, is left out.  Card and id shapes that carry no label get one.
    """
    from .augment import hardened

    kind = "array<struct<label:string,start_char:int,end_char:int,text:string>>"
    rows = records.withColumn("_values", values).withColumn("_prompt", inject_prompt(F.col("text"), F.col("_values"), lang))
    plain = rows.where(F.size("_values") == 0).drop("_values", "_prompt")
    asked = ask(rows.where(F.size("_values") > 0), client, "_prompt", "_answer").where("_answer is not null")
    had = F.transform("entities", lambda e: F.struct(e["text"].alias("text"), e["label"].alias("type")))
    done = asked.withColumn("text", tx.strip_fence(F.col("_answer"))).withColumn("_found", align.reextracted(F.col("text"), F.col("_values"), had)).where("_found is not null")
    done = done.withColumn("_found", hardened(F.col("text"), F.col("_found")))
    placed = F.transform("_found", lambda s: F.struct(tx.merge_label(s["type"], merge).alias("label"), s["start"].alias("start_char"), s["end"].alias("end_char"), s["text"].alias("text")))
    return plain.withColumn("entities", F.col("entities").cast(kind)).unionByName(done.withColumn("entities", placed.cast(kind)).select(*records.columns))


def translate(records: DataFrame, client: Client, labels=bio.PII_TYPES, nonce: str = "ab", key: str = "doc_id") -> DataFrame:
    """Texts translated with personal data masked: the translation, and how many values were masked, restored and dropped.

    Spans outside the text or over one another raise, so nothing masked in part is sent; a
    Korean text (the target language) has status 400, a failed call 503.
    """
    from .spans import masked_value, restored

    own = F.array_sort(F.transform(F.filter("entities", lambda e: e["label"].isin(*labels)), lambda e: F.struct(e["start_char"].alias("s"), e["end_char"].alias("e"))))
    rows = records.withColumn("_pii", own)
    rows = rows.withColumn("prompt", masked_value(F.col("text"), F.col("_pii"), nonce)).withColumn("_values", F.transform("_pii", lambda x: tx.surface(F.col("text"), x["s"], x["e"])))
    asked = ask(rows.where("lang <> 'ko'").select(key, "prompt", "_values"), client)
    back = restored(F.coalesce(tx.trim_all(F.col("answer")), F.lit("")), F.col("_values"), nonce)
    done = asked.withColumn("_r", back).select(key, F.when(F.col("error").isNull(), F.col("_r.text")).alias("translation"), F.size("_values").alias("masked"), F.col("_r.n").alias("restored"), (F.size("_values") - F.col("_r.n")).alias("dropped"), F.when(F.col("error").isNull(), 200).otherwise(503).alias("status"))
    refused = rows.where("lang = 'ko'").select(key, F.lit(None).cast("string").alias("translation"), F.lit(0).alias("masked"), F.lit(0).alias("restored"), F.lit(0).alias("dropped"), F.lit(400).alias("status"))
    return done.unionByName(refused)


def health(spark, requested: Iterable[str], models: dict[str, SpanModel], thresholds: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """Which languages are loaded and have thresholds, and the state of all: ok or degraded."""
    rows = [(lang, lang in models, lang in models and bool((thresholds or {}).get(lang))) for lang in requested]
    state = "ok" if rows and all(r[1] for r in rows) else "degraded"
    return spark.createDataFrame([(*r, state) for r in rows], "lang string, loaded boolean, thresholds boolean, status string")


def load(loaders: dict[str, Callable[[], SpanModel]]) -> tuple[dict[str, SpanModel], dict[str, str]]:
    """Models that load, and why the others do not; one that fails keeps no other from serving."""
    models, failed = {}, {}
    for lang, make in loaders.items():
        try:
            models[lang] = make()
        except Exception as e:  # noqa: BLE001 - reported by health
            failed[lang] = f"{type(e).__name__}: {e}"
    return models, failed


def packaged(records: DataFrame, split: DataFrame, recorded: dict, key: str, spans: str = "spans", order: str = "row") -> None:
    """Raise unless the data and the split are those that a run recorded, and no group of the test set is trained on.

    ``split`` has (order, key, split); ``recorded`` has kfold, data_fingerprint and the three sizes.
    """
    from .splits import fingerprint, records_payload

    if recorded.get("kfold") is not None:
        raise ValueError("a cross-validation run has no single model")
    now = fingerprint(records.select(order, records_payload("text", spans).alias("_p")), order, "_p").first()[0]
    if now != recorded["data_fingerprint"]:
        raise ValueError(f"the data has changed: {recorded['data_fingerprint']} then, {now} now")
    got = {r[0]: r[1] for r in split.groupBy("split").count().collect()}
    sizes = {s: got.get(s, 0) for s in ("train", "valid", "test")}
    if sizes != {s: recorded[f"{s}_samples"] for s in sizes}:
        raise ValueError(f"the split has other sizes: {sizes}")
    leaked = split.where("split = 'test'").select(key).distinct().join(split.where("split <> 'test'"), key, "left_semi").count()
    if leaked:
        raise ValueError(f"{leaked} test groups are in the other splits")
