"""Reports from small tables: Markdown, aligned text, and plain dictionaries.  What is collected has one row per type or model."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import table_cell


def markdown(table: DataFrame, title: str | None = None) -> str:
    """A table of at most a few thousand rows as Markdown; signs that would break a cell are escaped."""
    safe = table.select(*[table_cell(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in table.columns])
    rows = ["| " + " | ".join(r) + " |" for r in safe.collect()]
    head = ["| " + " | ".join(table.columns) + " |", "|" + "---|" * len(table.columns)]
    return "\n".join(([f"# {title}", ""] if title else []) + head + rows)


def confusion_markdown(pairs: DataFrame, title: str = "Confusion") -> str:
    """Counts (gold_type, pred_type, n) as a square table with sums of rows."""
    got = {(r["gold_type"], r["pred_type"]): r["n"] for r in pairs.collect()}
    names = sorted({x for k in got for x in k}, key=lambda x: (x == "∅", x))
    lines = [f"# {title}", "", "| gold \\ pred | " + " | ".join(names) + " | sum |", "|" + "---|" * (len(names) + 2)]
    for g in names:
        row = [got.get((g, p), 0) for p in names]
        lines.append(f"| {g} | " + " | ".join(map(str, row)) + f" | {sum(row)} |")
    return "\n".join(lines)


def errors_markdown(top: DataFrame, title: str) -> str:
    """The rows of ``metrics.top_errors`` with the surface marked in its context."""
    shown = top.orderBy("type", "r").select("type", "surface", "class", "counter", F.concat("left", F.lit("【"), "surface", F.lit("】"), "right").alias("context"))
    return markdown(shown, title)


def aligned(head: list[str], rows: list[list[str]], indent: int = 0) -> str:
    """Columns of equal width: the first to the left, the others to the right."""
    width = [max(map(len, column)) for column in zip(head, *rows)]
    pad = " " * indent
    line = lambda cells: pad + " | ".join(c.ljust(w) if i == 0 else c.rjust(w) for i, (c, w) in enumerate(zip(cells, width)))
    return "\n".join([line(head), pad + "-+-".join("-" * w for w in width), *map(line, rows)])


def scores_text(scores: DataFrame) -> str:
    """Scores by type, the best F1 first, and the total on top."""
    rows = scores.select("type", "f1", "precision", "recall", F.col("n_gold").alias("support")).collect()
    order = sorted(rows, key=lambda r: (r["type"] != "ALL", -r["f1"], r["type"]))
    return aligned(["Entity", "F1", "Prec", "Recall", "Support"], [[r["type"], *(f"{r[c]:.4f}" for c in ("f1", "precision", "recall")), str(r["support"])] for r in order])


def bench_text(scores: DataFrame) -> str:
    """The result of ``adapters.bench``: one line per model, then its types."""
    rows = scores.collect()
    total = sorted((r for r in rows if r["type"] == "ALL"), key=lambda r: (-r["f1"], r["model"]))
    out = [aligned(["Model", "F1", "Precision", "Recall", "Samples", "Errors"], [[r["model"], *(f"{r[c]:.4f}" for c in ("f1", "precision", "recall")), str(r["samples"]), str(r["errors"])] for r in total])]
    for t in total:
        mine = sorted((r for r in rows if r["model"] == t["model"] and r["type"] != "ALL"), key=lambda r: r["type"])
        if mine:
            out += [f"{t['model']}:", aligned(["Entity", "F1", "Precision", "Recall", "Support"], [[r["type"], *(f"{r[c]:.4f}" for c in ("f1", "precision", "recall")), str(r["n_gold"])] for r in mine], 4)]
    return "\n".join(out)


def bench_dict(scores: DataFrame, lang: str, stamp: str) -> dict:
    """The result of ``adapters.bench`` for a JSON file, without rendered text."""
    out: dict[str, dict] = {}
    for r in scores.collect():
        m = out.setdefault(r["model"], {"model_name": r["model"], "num_samples": r["samples"], "errors": r["errors"], "overall": {}, "per_entity": {}})
        block = {c: r[c] for c in ("f1", "precision", "recall")} | {"support": r["n_gold"]}
        m["overall" if r["type"] == "ALL" else "per_entity"] = block if r["type"] == "ALL" else m["per_entity"] | {r["type"]: block}
    return {"timestamp": stamp, "language": lang, "num_models": len(out), "results": [out[m] for m in sorted(out)]}


def scores_dict(scores: DataFrame) -> dict:
    """Scores as overall and per entity, as metric files hold them."""
    blocks = {r["type"]: {c: r[c] for c in ("f1", "precision", "recall")} | {"support": r["n_gold"]} for r in scores.collect()}
    return {"overall": blocks.pop("ALL", {}), "per_entity": blocks}


def model_card(name: str, lang: str, scores: DataFrame, sizes: dict[str, int], facts: dict[str, str]) -> str:
    """A short card of a packaged model: what it is, its data, its scores."""
    lines = [f"# {name}", "", f"Language: {lang}", ""] + [f"- {k}: {v}" for k, v in facts.items()] + [f"- {k} rows: {v}" for k, v in sizes.items()]
    return "\n".join([*lines, "", "```", scores_text(scores), "```"])
