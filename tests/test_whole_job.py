"""Operators against brute force, where the tables do not show the whole job."""

import random
import re
import time

import duckdb
import numpy as np
from pyspark.sql import functions as F

from spanloom.functions import text as tx
from spanloom.operators import audit, augment, bio, metrics, spans, splits
from spanloom.plans import catalogue


def test_passages_anywhere(spark):
    long = "one two three four five six seven eight nine ten eleven"
    items = [(1, f" {long} "), (2, "red green blue"), (3, "alpha beta"), (4, "lone"), (5, " "), (6, None), (7, "a b c d e f g"), (8, "line one\nline two end here"), (9, "x  y  z")]
    texts = [long, f"before {long} after", f"pre{long}post", "a red green blues", "red  green blue", "talpha beta", "clone", "", None, "z a b c d e f gh", "a b c d e f", "my line one\nline two end here.", "x  y  zz", "x y z", f"{long[:-1]}", f"head\n{long}\ntail"]
    got = splits.passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = {(d, i) for d, t in enumerate(texts) for i, p in items if t and p and p.strip() and p.strip() in t}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    assert {(1, 1), (2, 1), (3, 2), (5, 3), (6, 4)} <= want


def same_text(a, b):
    return bool(a and b) and (a == b or (a in b or b in a) and min(len(a), len(b)) / max(len(a), len(b)) >= 0.7)


def test_verify_outcomes(spark):
    rng = random.Random(3)
    words = ["Anna", "Ann", "Annas", "Berlin", "Berli", "Berlin ", "Rome", "Romero", "", " ", None, "aaaaaaa", "aaaaaa"]
    span = lambda d, s: (d, s, s + rng.randint(1, 4), rng.choice(["PER", "LOC", "EVT"]), rng.choice(words))
    golds = [span(d, 5 * i) for d in range(40) for i in range(rng.randint(0, 12))] + [(50, 0, 6, "LOC", "Berlin"), (51, 0, 4, "PER", "Anna")]
    preds = [span(d, 5 * i) for d in range(40) for i in range(rng.randint(0, 12))] + [(50, 0, 5, "LOC", "Berli"), (52, 0, 4, "PER", "Anna")]
    want = []
    for d in {g[0] for g in golds}:
        mine, used = sorted((p for p in preds if p[0] == d), key=lambda p: p[1:4]), set()
        for g in sorted((g for g in golds if g[0] == d), key=lambda g: g[1:4]):
            a = (g[4] or "").strip()
            left = [i for i in range(len(mine)) if i not in used]
            hit = next((i for i in left if (mine[i][4] or "").strip() == a), None)
            if hit is None:
                hit = next((i for i in left if same_text(a, (mine[i][4] or "").strip())), None)
            used.add(hit)
            outcome = "exempt" if g[3] == "EVT" else "missed" if hit is None else "confirmed" if mine[hit][3] == g[3] else "conflict"
            want.append((*g, None if hit is None else mine[hit][3], outcome))
    schema = "doc_id long, start long, end long, type string, surface string"
    got = augment.verify_outcomes(spark.createDataFrame(golds, schema), spark.createDataFrame(preds, schema), ["PER", "LOC"]).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert (50, 0, 6, "LOC", "Berlin", "LOC", "confirmed") in want


def test_mentions_anywhere(spark):
    surfaces = ["Anna", "Ann", "New York", "York", "서울", "서울 시청", "U.S.", "a", "New York New", "", None]
    texts = ["Anna, Ann\nAnna.", "New York New York New", "서울은 서울시 서울장 서울 시청에서", "xAnna Annab Anna_", "the U.S. and U.S.A", "a😀Ann a", "", None, "(Anna)", "(서울)이라는", "New  York", "éAnn Anné"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in audit.mentions_anywhere(docs, spark.createDataFrame([(s,) for s in surfaces + ["Ann"]], "surface string")).select("doc_id", "start", "end", "surface").collect())

    def stands(t, i, s):
        rest = t[i + len(s) :]
        if t[:i] and (t[i - 1].isascii() and t[i - 1].isalnum() or "가" <= t[i - 1] <= "힣"):
            return False
        return not rest or not rest[0].isalnum() or rest[0] not in audit.SUFFIXES and any(rest.startswith(p) for p in audit.PARTICLES)

    want = sorted((d, i, i + len(s), s) for d, t in enumerate(texts) if t for s in surfaces if s for i in range(len(t)) if t.startswith(s, i) and stands(t, i, s))
    assert got == want
    assert {(0, 0, 4, "Anna"), (0, 6, 9, "Ann"), (1, 9, 21, "New York New"), (2, 0, 2, "서울"), (2, 12, 17, "서울 시청")} <= set(got)
    assert not [g for g in got if g[0] == 3 and g[3] == "Ann"]
    assert audit.mentions_anywhere(docs, spark.createDataFrame([], "surface string")).count() == 0


def test_mask_many_mails(spark, tmp_path):
    texts = [" ".join(f"say user{i}@mail.org now" for i in range(n)) for n in (0, 1, 10, 11, 123)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in catalogue.queries()["mask_restore_identity"](spark, str(tmp_path)).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    for d, n in ((1, 1), (2, 10), (3, 11), (4, 123)):
        masked = len(" ".join(f"say {'x' * (8 + len(str(i)))} now" for i in range(n)))
        assert (got[d]["n_masked"], got[d]["len_masked"], got[d]["same"]) == (n, masked, True)


def test_fit_thresholds(spark):
    rng = random.Random(8)
    golds = [(d, 10 * i, 10 * i + 4, rng.choice(["PER", "LOC"])) for d in range(30) for i in range(6)]
    scored = [(*g, 0.5 + rng.randrange(11) / 20) for g in golds if rng.random() < 0.9] + [(d, 10 * i + 5, 10 * i + 8, rng.choice(["PER", "LOC"]), rng.randrange(14) / 20) for d in range(30) for i in range(4)]
    scored += scored[:5] + [(99, 0, 1, "LOC", None)]
    schema = "doc_id long, start long, end long, type string"
    cuts = metrics.fit_thresholds(spark.createDataFrame(golds, schema), spark.createDataFrame(scored, f"{schema}, score double"))
    best = {}
    for *span, score in scored:
        best[tuple(span)] = max(best.get(tuple(span), 0.0), 1.0 if score is None else score)

    def value(chosen):
        kept = {s for s, score in best.items() if score >= chosen[s[3]]}
        tp = len(kept & set(golds))
        p, r = tp / len(kept) if kept else 0.0, tp / len(set(golds))
        return (2 * p * r / (p + r) if p + r else 0.0) - 100 * max(0.0, 0.93 - p) - 100 * max(0.0, 0.93 - r)

    assert set(cuts) == {"PER", "LOC"}
    # no cut of one type alone does better
    for t in cuts:
        assert all(value(cuts | {t: c}) <= value(cuts) + 1e-9 for c in {0.0, *best.values()})
    assert value(cuts) > value({"PER": 0.0, "LOC": 0.0})
    assert metrics.fit_thresholds(spark.createDataFrame(golds, schema), spark.createDataFrame([], f"{schema}, score double")) == {}


def test_record_fingerprint_many_blocks(spark, tmp_path):
    # over 8 * 8 * 8 blocks of 64 ids
    rows = [(100 + 64 * i, f"Text {'Alpha' if i % 3 else 'beta'} {i}", "en") for i in range(520)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(catalogue.oracle_sql()["record_fingerprint"]).fetchall()
    assert [tuple(r) for r in catalogue.queries()["record_fingerprint"](spark, str(tmp_path)).collect()] == want


def test_trimmed_tokens(spark):
    texts = ["  a, b.c .\n", "", " ", "...", "x", "😀. 　y,  z\t.", "one  two, ", "\n", "a , 서울. ,", None]
    moves = [(0, 0), (1, 2), (2, 1), (3, 0)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for back, on in moves:
        moved = lambda tok, start, end, size: (np.maximum(start - tok % (back + 1), 0), np.minimum(end + on, size))  # noqa: B023, E731
        got = sorted(tuple(r) for r in spans.trimmed_tokens(docs, moved).collect())
        want = []
        for d, text in enumerate(texts):
            at = 0
            for i, word in enumerate(text.split(" ") if text is not None else []):
                a, b = max(at - i % (back + 1), 0), min(at + len(word) + on, len(text))
                part = text[a:b]
                lead, trail = len(part) - len(part.lstrip()), len(part.lstrip()) - len(re.sub(r"[\s.,]+\Z", "", part.lstrip()))
                want.append((d, i, a, b) if lead + trail >= len(part) else (d, i, a + lead, b - trail))
                at += len(word) + 1
        assert got == want
    # the same by the function of one span
    start, stop = tx.trimmed(F.col("text"), F.col("a"), F.col("b"))
    rows = spans.trimmed_tokens(docs, lambda tok, start, end, size: (start, end)).join(spans.tokens(docs).selectExpr("doc_id", "tok", "start as a", "start + length(word) as b"), ["doc_id", "tok"]).join(docs, "doc_id")
    assert rows.count() and rows.where((start != F.col("start")) | (stop != F.col("end"))).count() == 0


def test_trimmed_offsets_long_text(spark, tmp_path):
    # one text of 300,000 tokens: every token costs the same wherever it stands
    long = "ab, c. " * 150_000
    spark.createDataFrame([(1, long, "en")], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    begun = time.monotonic()
    row = catalogue.queries()["trimmed_offsets"](spark, str(tmp_path)).first()
    assert time.monotonic() - begun < 60
    assert row["doc_id"] == 1 and 0 < row["starts"] < row["stops"]


def test_document_violations(spark):
    rng = random.Random(11)
    texts = {d: " ".join("x" * rng.randint(0, 9) for _ in range(rng.randint(0, 12))) for d in range(60)} | {90: "", 91: "abcdef", 92: None, 95: "😀😀 ab"}
    golds = [(d, s := rng.randint(0, 30), s + rng.randint(0, 12), rng.choice(["PER", "LOC", "서울"])) for d in texts if d < 90 and d % 7 for _ in range(rng.randint(0, 9))]
    golds += [(91, 0, 6, "PER"), (95, 0, 2, "LOC"), (95, 0, 2, "LOC"), (95, 1, 60, "PER"), (99, 0, 5, "PER"), (91, None, 5, "LOC")]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    g = spark.createDataFrame(golds, "doc_id long, start long, end long, type string")
    empty = lambda of, tok, start, end: (of, tok, np.where(tok % 5 == 4, 0, start), np.where(tok % 5 == 4, 0, end))
    for shift in (0, 1, 3):
        moved = lambda tok, start, end: (np.where(tok % 3 == 0, end, start + tok % 4 // 3 * 80), np.where(tok % 3 == 0, end, end + tok % (shift + 1)))  # noqa: B023, E731
        got = sorted(tuple(r) for r in bio.document_violations(docs, g, empty, moved).collect())
        t = spans.tokens(docs).selectExpr("doc_id", "cast(tok as long) tok", "if(tok % 5 = 4, 0, start) as start", "if(tok % 5 = 4, 0, start + length(word)) as end")
        t = bio.labels_of(t, g.where("start is not null")).where("tag is not null")
        t = t.selectExpr("doc_id", "tok", "if(tok % 3 = 0, end, start + if(tok % 4 = 3, 80, 0)) as start", f"if(tok % 3 = 0, end, end + tok % {shift + 1}) as end", "tag")
        want = sorted(tuple(r) for r in bio.label_violations(t, g.where("start is not null")).collect())
        assert got == want and {"no_host", "outside_char", "zero_at_end"} == {r[3] for r in got}
    assert bio.document_violations(docs, g.limit(0), empty).count() == 0
    # tokens stay where their text is: nothing is dealt out behind them
    plan = bio.document_violations(docs, g, empty)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("MapInArrow")] and "MapInArrow" in plan
