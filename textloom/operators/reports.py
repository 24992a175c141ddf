"""Reports: small aggregates, collected and written as Markdown or JSON."""

import json

from pyspark.sql import functions as F


def escape(value) -> str:
    """For a cell of a table."""
    return "" if value is None or value == "" else str(value).replace("|", r"\|").replace("\n", " ")


def table(rows, columns=None, right=()) -> list[str]:
    """Lines of a table of a frame with few rows."""
    columns = columns or rows.columns
    lines = ["| " + " | ".join(columns) + " |", "| " + " | ".join("---:" if c in right else "---" for c in columns) + " |"]
    return lines + ["| " + " | ".join(escape(r[c]) for c in columns) + " |" for r in rows.collect()]


def dedup_report(title: str, date: str, records: int, kept, rejected, exact_groups, canonical_groups, clusters, validation, limit: int = 1000) -> str:
    """What was removed, what is left for review, and the output's counts. Listings show the first so many rows."""
    v = validation.first()
    lines = [f"# {title}", "", f"Validation date: {date[:10]}", "", "## Summary", "", f"- Input records: {records}", f"- Output records: {v.records}", f"- Exact duplicate groups: {exact_groups.count()}", f"- Removed records: {rejected.count()}", f"- Canonical groups for review: {canonical_groups.count()}", f"- Same-work clusters for review: {clusters.count()}"]
    lines += ["", "## Output validation", ""] + [f"- {c}: {v[c]}" for c in validation.columns]
    for name, rows in (("Exact duplicates", exact_groups.select("hash", "size", F.concat_ws(", ", "members").alias("members"))), ("Canonical duplicates", canonical_groups), ("Same-work clusters", clusters)):
        lines += ["", f"## {name}", ""] + table(rows.limit(limit))
    return "\n".join(lines) + "\n"


def scan_summary(histogram) -> str:
    """Classes of scans and how many there are of each."""
    rows = histogram.collect()
    return "\n".join(["# Scan quality", "", f"- Files: {sum(r.n for r in rows)}", *[f"- {r.ocr_quality_class}: {r.n}" for r in rows]]) + "\n"


def token_summary(sums, top, tokenizer) -> str:
    """Sums by dimension, the largest works and the tokenizer as JSON with sorted keys; a null key is written as null."""
    out = {"documents": 0, "total_tokens": 0, "tokenization": next((r.asDict() for r in tokenizer.collect()), {}), "top_10_works": [list(r) for r in top.collect()]}
    for r in sums.collect():
        if r.dimension == "total":
            out |= {"documents": r.documents, "total_tokens": r.tokens}
        else:
            out.setdefault(f"by_{r.dimension}", {})["null" if r.key is None else r.key] = r.tokens
    return json.dumps(out, indent=2, sort_keys=True, ensure_ascii=False) + "\n"
