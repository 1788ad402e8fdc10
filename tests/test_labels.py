"""Span matching, tags, chunks, admission and generators against plain definitions, with ties, repeats and empties."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from spanloom.functions import align, chunking, text as tx
from spanloom.operators import adapters, augment, bio, gate, generators, metrics, reports, rules, serving, splits
from spanloom.sources import files, records

SPAN = "doc_id long, start long, end long, type string"


def random_spans(rng, docs):
    return [(d, s := rng.randint(0, 25), s + rng.randint(0, 7), rng.choice(["PER", "LOC"])) for d in range(docs) for _ in range(rng.randint(0, 7))]


def plain_errors(golds, preds):
    """Exact pairs, then the largest overlap of the same type, then of another, each in order."""
    golds, preds, out, used_g, used_p = sorted(golds), sorted(preds), [], set(), set()
    shared = lambda g, p: min(g[1], p[1]) - max(g[0], p[0])
    for i, g in enumerate(golds):
        j = next((j for j, p in enumerate(preds) if j not in used_p and p == g), None)
        if j is not None:
            used_g.add(i), used_p.add(j), out.append((g, g, "EXACT"))
    for name, same in (("BOUNDARY", True), ("TYPE_MISMATCH", False)):
        for i, g in enumerate(golds):
            rated = [(shared(g, p), -j) for j, p in enumerate(preds) if i not in used_g and j not in used_p and (p[2] == g[2]) == same and shared(g, p) > 0]
            if rated:
                j = -max(rated)[1]
                used_g.add(i), used_p.add(j), out.append((g, preds[j], name))
    out += [(g, (None,) * 3, "MISS") for i, g in enumerate(golds) if i not in used_g]
    return out + [((None,) * 3, p, "HALLUCINATION") for j, p in enumerate(preds) if j not in used_p]


def test_errors_and_relaxed(spark):
    rng = random.Random(4)
    golds, preds = random_spans(rng, 60), random_spans(rng, 60)
    golds += [(90, 0, 10, "PER"), (90, 8, 20, "PER"), (91, 3, 3, "PER"), (92, 0, 4, "LOC")]
    preds += [(90, 5, 14, "PER"), (90, 7, 9, "PER"), (91, 3, 3, "PER"), (92, 0, 4, "LOC"), (92, 0, 4, "LOC")]
    g, p = spark.createDataFrame(golds, SPAN), spark.createDataFrame(preds, SPAN)
    of = lambda rows, d: [r[1:] for r in rows if r[0] == d]
    want = [(d, *a, *b, c) for d in {r[0] for r in golds + preds} for a, b, c in plain_errors(of(golds, d), of(preds, d))]
    got = [tuple(r[c] for c in ("doc_id", "g_start", "g_end", "g_type", "p_start", "p_end", "p_type", "class")) for r in metrics.errors(g, p).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert [r[-1] for r in want if r[0] == 90] == ["BOUNDARY", "BOUNDARY"]
    cor = par = 0
    for d in {r[0] for r in golds}:
        free = sorted(of(preds, d))
        for x in sorted(of(golds, d)):
            hit = next((y for y in free if y == x), None) or next((y for y in free if y[2] == x[2] and max(x[0], y[0]) < min(x[1], y[1])), None)
            if hit:
                cor, par = cor + (hit == x), par + (hit != x)
                free.remove(hit)
    total = metrics.relaxed(g, p).where("type = 'ALL'").first()
    assert (total["cor"], total["par"], total["n_gold"], total["n_pred"]) == (cor, par, len(golds), len(preds))
    assert metrics.errors(g.limit(0), p.limit(0)).count() == 0 and metrics.relaxed(g.limit(0), p.limit(0)).first()["f1"] == 0


def test_every_code_point_has_the_language_of_its_decomposition(spark):
    signs = {"̛", "̉", "̣", "đ", "Đ"}
    vi = {c for c in range(1, 0x30000) if set(unicodedata.normalize("NFD", chr(c))) & signs and not 0xD800 <= c < 0xE000}
    assert vi == {c for lo, hi in tx.VI_RANGES for c in range(lo, hi + 1)}
    cases = [("カタカナ", "ja"), ("ﾞ", "unsupported"), ("힣", "ko"), ("힤".encode("utf-16", "surrogatepass").decode("utf-16"), "unsupported"), ("Ế", "en"), ("Ḥ", "vi"), ("a × b", "en"), ("×", "unsupported"), ("漢字", "unsupported"), ("한글 と", "ja"), ("", "unsupported")]
    got = spark.createDataFrame([(t,) for t, _ in cases], "t string").select(tx.detect_lang(F.col("t"))).collect()
    assert [r[0] for r in got] == [x for _, x in cases]


def test_surfaces_find_their_places():
    assert align.place_surfaces("東京都は東京にある", [{"text": "東京", "type": "LOC"}, {"text": "東京都", "type": "LOC"}, {"text": "東京", "type": "ORG"}]) == [
        {"text": "東京", "type": "LOC", "start": 4, "end": 6}, {"text": "東京都", "type": "LOC", "start": 0, "end": 3}]
    assert align.place_surfaces("지난19일", [{"text": "지난 19일", "type": "DAT"}])[0]["end"] == 5
    assert align.place_surfaces("田中が", [{"text": "田中さんは", "type": "PER"}]) == [{"text": "田中", "type": "PER", "start": 0, "end": 2}]
    assert align.place_surfaces("", [{"text": "a", "type": "b"}]) == [] == align.place_surfaces("abc", [{"text": " ", "type": "b"}, {"text": None, "type": None}])
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("aab ") for _ in range(30))
        spans = [{"text": "".join(rng.choice("ab") for _ in range(rng.randint(1, 4))), "type": "T"} for _ in range(8)]
        used, want = set(), {}
        for i in sorted(range(8), key=lambda i: -len(spans[i]["text"])):
            n = spans[i]["text"]
            at = next((k for k in range(len(text)) if text.startswith(n, k) and not used & set(range(k, k + len(n)))), None)
            if at is not None:
                used |= set(range(at, at + len(n)))
                want[i] = at
        assert [s["start"] for s in align.place_surfaces(text, spans)] == [want[i] for i in sorted(want)]


def test_reextraction():
    value = [{"type": "CREDIT_CARD", "text": "1111  2222"}]
    assert align.reextract("pay 1111 2222 to Ann and Ann", value, [{"type": "PER", "text": "Ann"}] * 3) == [
        {"text": "1111 2222", "type": "CREDIT_CARD", "start": 4, "end": 13}, {"text": "Ann", "type": "PER", "start": 17, "end": 20}, {"text": "Ann", "type": "PER", "start": 25, "end": 28}]
    assert align.reextract("nothing here", value, []) is None and align.reextract("Bob", [], [{"type": "PER", "text": "Ann"}]) == []


def test_tags_between_grids():
    assert align.word_tags("I saw New York today".split(), [{"text": "New York", "type": "LOC"}, {"text": "toda", "type": "DAT"}]) == ["O", "O", "B-LOC", "I-LOC", "B-DAT"]
    syllables = ["경", "찰", " ", "지", "난", " ", "1", "9", "일", "경", "찰"]
    spans = [{"text": "경찰", "type": "OG"}, {"text": "지난19일", "type": "DT"}, {"text": "경찰", "type": "OG"}]
    assert align.syllable_tags("경찰 지난 19일경찰", syllables, spans) == ["B-ORG", "I-ORG", "O", "B-DAT", "I-DAT", "O", "I-DAT", "I-DAT", "I-DAT", "B-ORG", "I-ORG"]
    assert align.aligned_tags(["a", "b", " ", "c", "x"], ["ab", "c"], ["B-P", "O"]) == ["B-P", "B-P", "O", "O", "O"]
    assert align.spread_tags(["a", "b", " ", "c", "", "d"], ["B-P", "I-P"]) == ["B-P", "I-P", "O", "I-P", "O", "O"]
    assert align.find_spaceless("ab a c", "a c") == (3, 6) and align.find_spaceless("aab", "ab") is None and align.find_spaceless("x", " ") is None
    found = [{"entity": "B-PS", "start": 0, "end": 2, "score": 0.5}, {"entity": "B-LC", "start": 1, "end": 2, "score": 0.6}, {"entity": "O", "start": 0, "end": 2, "score": 1.0}, {"entity": "B-LC", "start": 2, "end": 3, "score": 0.6}]
    assert align.voted_tags("abc", ["a", "b", "c"], found) == ["B-PER", "B-LOC", "I-LOC"] and align.voted_tags(" ", ["a"], found) == ["O"]
    assert align.word_places("Hà Nội là", ["Hà_Nội", "zz", "là"]) == [{"text": "Hà_Nội", "start": 0, "end": 6}, {"text": "là", "start": 7, "end": 9}]


def test_tiles():
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice(["a", "b ", "C", " ", "。", "!\n", "(", "word "]) for _ in range(rng.randint(0, 60)))
        for limit in (3, 5, 9):
            out = chunking.tile(text, limit)
            assert all(text[a : a + len(c)] == c and len(c.split()) <= limit - 2 for c, a in out)
            assert "".join("".join(c.split()) for c, _ in out) == "".join(text.split()) and [a for _, a in out] == sorted(a for _, a in out)
    assert chunking.tile("One. two。three! Four", 4) == [("One. two。three!", 0), (" Four", 15)]
    letters = lambda t: len(t.replace(" ", ""))
    assert [c for c, _ in chunking.tile("abcdefgh ij", 6, letters)] == ["abcd", "efgh ", "ij"]
    with pytest.raises(ValueError):
        chunking.tile("ab", 3, lambda t: 5)
    assert tx.fold("  a \t\n b  ") == ("a b", [2, 6, 7]) and tx.fold(" ") == ("", [])


def test_admission_is_the_plain_simulation(spark):
    rng = random.Random(6)
    rows = [(s, i, float(rng.randint(0, 60)), float(rng.randint(1, 20))) for s in range(4) for i in range(40)]
    got = {(r["server"], r["request_id"]): (r["outcome"], r["started"]) for r in serving.admission(spark.createDataFrame(rows, "server int, request_id int, arrival double, seconds double"), "server", "arrival", "seconds", 2, 2, 5.0).collect()}
    for s in range(4):
        log, ends, queue, want = sorted((a, i, n) for x, i, a, n in rows if x == s), [], [], {}
        times = sorted({a for a, _, _ in log} | {a + k for a, _, _ in log for k in range(0, 400)})
        for t in times:
            ends = [e for e in ends if e > t]
            while queue and len(ends) < 2:
                a, i, n = queue.pop(0)
                if a + 5 >= t:
                    want[i] = ("served", t)
                    ends.append(t + n)
                else:
                    want[i] = ("timed out", None)
            for a, i, n in [x for x in queue if x[0] + 5 < t]:
                want[i] = ("timed out", None)
                queue.remove((a, i, n))
            for a, i, n in [x for x in log if x[0] == t]:
                if len(ends) < 2:
                    want[i] = ("served", t)
                    ends.append(t + n)
                elif len(queue) >= 2:
                    want[i] = ("queue full", None)
                else:
                    queue.append((a, i, n))
        for i, w in want.items():
            g = got[s, i]
            assert g[0] == w[0] and (w[1] is None or g[1] == w[1]), (s, i, g, w)
    assert len({x for x, _ in got.values()}) == 3


def test_generated_values_have_their_shapes(spark):
    docs = spark.range(120).withColumnRenamed("id", "k")
    for lang in generators.LOCALES:
        for label in generators.LABELS:
            values = [r[0] for r in docs.select(generators.value(label, lang, 3, F.col("k")).alias("v")).collect()]
            import re

            assert all(re.fullmatch(generators.shape(label, lang), v) for v in values) and len(set(values)) > 20, (lang, label, values[:3])
    numbers = [r[0].replace("-", "") for r in docs.select(generators.value("ID_NUM", "ko", 3, F.col("k"))).collect()]
    for n in numbers:
        assert int(n[12]) != (11 - sum(int(c) * w for c, w in zip(n, generators.RRN_WEIGHTS)) % 11) % 10
    with pytest.raises(ValueError):
        generators.value("NAME", "xx", 1, F.lit(1))
    with pytest.raises(ValueError):
        generators.value("SHOE", "en", 1, F.lit(1))
    assert augment.truncate_density({0: 0.5, 1: 0.25, 5: 0.25}, 1) == {0: 2 / 3, 1: 1 / 3} and augment.truncate_density({3: 1.0}, 1) == {0: 1.0}
    with pytest.raises(ValueError):
        augment.check_density({0: 0.5})


def test_inject_by_client(spark):
    rows = spark.createDataFrame([(1, "Ann pays.", [("PER", 0, 3, "Ann")]), (2, "Bob pays.", [("PER", 0, 3, "Bob")]), (3, "No one.", [])], "doc_id long, text string, entities array<struct<label:string,start_char:int,end_char:int,text:string>>")
    values = F.when(F.col("doc_id") < 3, F.array(F.struct(F.lit("NAME").alias("type"), F.lit("Zed").alias("text")))).otherwise(F.array().cast("array<struct<type:string,text:string>>"))
    client = adapters.FunctionClient(lambda p: "```\nZed and Ann owe 123456789012.\n```" if "Ann" in p else "lost")
    got = {r["doc_id"]: r for r in adapters.inject_by(rows, client, values, "en").collect()}
    assert sorted(got) == [1, 3] and got[3]["text"] == "No one."
    assert [tuple(e) for e in got[1]["entities"]] == [("PER", 0, 3, "Zed"), ("PER", 8, 11, "Ann"), ("ID_NUM", 16, 28, "123456789012")]


def test_masks_refuse_wrong_spans(spark):
    from spanloom.operators.spans import masked_value

    row = spark.createDataFrame([("ab cd", [(0, 2), (1, 4)]), ("ab", [(0, 9)])], "t string, s array<struct<s:int,e:int>>")
    for i in (0, 1):
        with pytest.raises(Exception, match="span"):
            row.where(F.col("t") == ("ab cd", "ab")[i]).select(masked_value(F.col("t"), F.col("s"), "x")).collect()


def test_splits_refuse(spark):
    units = spark.createDataFrame([(f"u{i}", 1, i % 2 == 0, "a") for i in range(10)], "unit string, n int, fit boolean, s string")
    with pytest.raises(ValueError):
        splits.kfold(units.limit(2), 3, 1, "unit", "s")
    with pytest.raises(ValueError):
        splits.deploy_split(units, 1, "unit", "n", "fit", 6, 0.1)
    rows = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", "z"), (4, None, "z")], "i int, k string, v string")
    for key in ("gone", "k"):
        with pytest.raises(ValueError):
            splits.validate_group_key(rows, key, ["k"])
    with pytest.raises(ValueError, match="stronger"):
        splits.validate_group_key(rows.where("k is not null"), "i", ["k"])
    splits.validate_group_key(rows.limit(0), "gone", [])
    with pytest.raises(ValueError):
        splits.unique_texts(spark.createDataFrame([(0, 0, "t"), (1, 0, "t")], "fold int, row long, text string"))
    with pytest.raises(ValueError):
        gate.repro_sigma(spark.createDataFrame([("a", "PER", 0.5)], "run string, entity string, f1 double"))
    with pytest.raises(ValueError):
        metrics.same_documents(rows.select(F.col("i").alias("doc_id")), rows.where("i > 1").select(F.col("i").alias("doc_id")))


def test_readers_and_writers(spark, tmp_path):
    import json

    d = str(tmp_path)
    lines = ['{"id": "1", "text": "Ann", "entities": [{"label": "PER", "start_char": 0, "end_char": 3, "text": "Ann"}]}', "", '{"id": "2", "text": "Bob", "gold_spans": [{"type": "LOC", "start": 0, "end": 3}]}', "{broken", '{"text": "X", "entities": [{"label": "SHOE", "start": 0, "end": 1}]}']
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    with pytest.raises(Exception, match="not a record"):
        records.read_jsonl(spark, f"{d}/a.jsonl").collect()
    assert [(r["id"], [e["label"] for e in r["entities"]]) for r in records.read_jsonl(spark, f"{d}/a.jsonl", strict=False).orderBy("line").collect()] == [("1", ["PER"]), ("2", ["LOC"])]
    assert [r["why"] for r in records.rejected(spark, f"{d}/a.jsonl").orderBy("line").collect()] == ["malformed", "label"]
    assert [r["id"] for r in records.read_jsonl(spark, f"{d}/a.jsonl", most=2).orderBy("line").collect()] == ["1", "2"]
    records.write_jsonl(records.read_jsonl(spark, f"{d}/a.jsonl", most=2), f"{d}/out")
    assert records.read_jsonl(spark, f"{d}/out").count() == 2
    (tmp_path / "b.jsonl").write_text('{"tokens": ["a"], "ner_tags": [1]}\n{"words": ["b", "c"], "ner": [0, 1]}\n')
    assert [r["ner_tags"] for r in records.token_dataset(spark, f"{d}/b.jsonl", names=["O", "B-PER"]).orderBy("line").collect()] == [["B-PER"], ["O", "B-PER"]]
    with pytest.raises(FileNotFoundError):
        records.token_dataset(spark, f"{d}/none.jsonl")
    for n in ("0", "2", "x"):
        (tmp_path / f"run/fold{n}").mkdir(parents=True)
        score = {"f1": 0.5, "precision": 0.5, "recall": 0.5, "support": 2}
        (tmp_path / f"run/fold{n}/metrics.json").write_text(json.dumps({"lang": "en", "seed": 4, "group_key": None, "per_entity": {"PER": score}, "overall_strict": score}))
        (tmp_path / f"run/fold{n}/test_predictions.json").write_text(json.dumps([{"id": n, "text": f"t{n}", "gold_spans": [{"type": "PER", "start": 0, "end": 1}], "pred_spans": []}]))
    (tmp_path / "run/pooled_metrics.json").write_text(json.dumps({"cross_fold_orig_dups": None, "strict": {"overall": score, "per_entity": {"PER": score}}}))
    assert sorted((r["fold"], r["matching"], r["entity"]) for r in records.read_fold_metrics(spark, f"{d}/run").collect()) == [(f, m, e) for f in (0, 2) for m, e in (("relaxed", "PER"), ("strict", "PER"), ("strict", "overall"))]
    configs = records.read_fold_configs(spark, f"{d}/run")
    assert gate.ruler(configs).first()["ruler"] == {"lang": "en", "seed": "4", "group_key": None}
    leak = gate.leakage(records.read_pooled(spark, f"{d}/run")).first()
    assert leak["dups"] is None and leak["basis"] == "unknown"
    assert sorted(r["entity"] for r in records.pooled_scores(records.read_pooled(spark, f"{d}/run")).collect()) == ["PER", "overall"]
    assert [r["sent_idx"] for r in splits.unique_texts(records.read_predictions(spark, f"{d}/run")).orderBy("sent_idx").collect()] == [0, 1]
    with pytest.raises(Exception):
        gate.leakage(spark.createDataFrame([("a", {"x": "1"})], "run string, metrics map<string,string>")).collect()
    records.write_thresholds(spark, f"{d}/cuts.json", {"PER": 0.5}, {"n": 1})
    assert records.read_thresholds(spark, f"{d}/cuts.json") == {"PER": 0.5}
    records.write_sigma(spark, f"{d}/sigma.json", spark.createDataFrame([("PER", 0.1)], "entity string, sigma double"), ["a", "b"])
    assert [tuple(r) for r in records.read_sigma(spark, f"{d}/sigma.json").collect()] == [("PER", 0.1)]
    assert files.exists(spark, f"{d}/cuts.json") and not files.exists(spark, f"{d}/none.json")
    found = records.adapt(spark.createDataFrame([("ab cd", [([3, 5], None)])], "t string, e array<struct<at:array<int>,kind:string>>"), "t", "e", "kind", span="at").first()
    assert [tuple(x) for x in found["entities"]] == [("MISC", 3, 5, "cd")]


def test_rule_tables(spark, tmp_path):
    page = "# x\n### 5.3 ko\n| a | b | c |\n|---|---|---|\n| `포럼` (x `y`) | EVT | R2 단독 |\n| `회` | NOT | R2 제외 `경계` 왜 |\n| z | EVT | **R2 head**: `회의` `회담` |\n| z | EVT | **축1 head (x)**: `전쟁` |\n### 5.4\n| `no` | x | R2c |\n## 6\n"
    (tmp_path / "r.md").write_text(page)
    rows = records.section_rows(spark, f"{tmp_path}/r.md", "### 5.3")
    assert rules.parse_rules(rows) == {"heads": ("회의", "회담"), "alone": ("포럼",), "ceremonies": (), "excluded": {"경계": ("회",)}}
    assert rules.parse_axis_heads(rows) == ("전쟁",)
    for heading in ("### 7", "## 6"):
        with pytest.raises(ValueError):
            records.section_rows(spark, f"{tmp_path}/r.md", heading)
    with pytest.raises(ValueError):
        rules.parse_holidays(rows)
    marks = [f"| x | y | **{m}**: `a` |" for m in rules.HOLIDAY_MARKS.values()]
    assert rules.parse_holidays(marks) == dict.fromkeys(rules.HOLIDAY_MARKS, ("a",))
    text = spark.createDataFrame([("설과 추석 연휴에", 1, "연휴"), ("크리스마스 나는", 5, ""), ("설, 추석 연휴기간", 1, "연휴기간"), ("설", 1, "")], "t string, e int, w string")
    assert all(r[0] == r[1] for r in text.select(rules.span_head_after(F.col("t"), F.col("e"), ["연휴", "연휴기간"]), "w").collect())
    assert rules.gate(0.5, 0.9, 3, 2, 1) and not rules.gate(0.95, 0.9, 2, 2) and not rules.gate(None, 0.9, 0, None)
    kinds = spark.createDataFrame([("를 봄", "조사직결"), ("' 개최", "개최동사"), (" 집", "없음")], "r string, w string")
    assert all(r[0] == r[1] for r in kinds.select(rules.evidence(F.col("r")), "w").collect())


def test_reports_and_weights(spark):
    pairs = spark.createDataFrame([("PER", "PER", 3), ("PER", "∅", 1)], "gold_type string, pred_type string, n long")
    assert "| PER | 3 | 1 | 4 |" in reports.confusion_markdown(pairs)
    table = spark.createDataFrame([("a|b\nc", 1)], "x string, y int")
    assert reports.markdown(table, "T").split("\n")[-1] == "| a\\|b c | 1 |"
    assert reports.aligned(["a", "b"], [["x", "10"]]) == "a |  b\n--+---\nx | 10"
    ids = bio.label_ids()
    assert len(ids) == 21 and bio.boundary_weights(ids, 3.0, 2.0, 1.0)[:3] == [1.0, 3.0, 2.0]
    scores = metrics.rated(spark.createDataFrame([("ALL", 1, 2, 2), ("PER", 1, 2, 2)], "type string, tp long, n_pred long, n_gold long"))
    assert reports.scores_dict(scores)["per_entity"]["PER"]["f1"] == 0.5 and reports.scores_text(scores).split("\n")[2].startswith("ALL")
    assert adapters.eval_mode("ko") == "bio" and adapters.labeler_of("hf:x", "ko", {"hf": lambda m: m}) == ("hf", "x")
    for spec, lang in (("x", "ko"), ("hf:x", "ja"), ("zz:x", "vi")):
        with pytest.raises(ValueError):
            adapters.labeler_of(spec, lang, {"hf": lambda m: m, "vllm": lambda m: m})
