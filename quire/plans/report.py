"""Human-readable views of a run's statistics."""

from __future__ import annotations


def number(x: object) -> str:
    """Thousands in groups; other values as they are."""
    return f"{x:,}" if isinstance(x, int | float) and not isinstance(x, bool) else str(x)


def _table(rows: list[tuple[str, object]]) -> str:
    return "\n".join(["| measure | value |", "|---|---:|", *(f"| {k} | {number(v)} |" for k, v in rows)])


def render_summary(s: dict) -> str:
    """A few lines for the console."""
    d, o, c = s["dataset"], s["oversize"], s["corpus"]
    lines = [
        f"{s['run_name']}: {number(c['books_included'])} books ({number(c['books_excluded'])} excluded), {number(c['words'])} words",
        f"{number(d['chunks'])} chunks, {number(d['content_tokens'])} tokens, {100 * d['budget_utilisation']:.1f} % of the budget used",
        f"train {number(d['train_chunks'])} chunks, val {number(d['val_chunks'])} chunks",
        f"{s['boundaries']['pct_ending_on_a_scene']} % of chunks end on a scene",
        f"excluded: {number(o['excluded_tokens'])} tokens ({100 * o['excluded_fraction']:.4f} %)" + (" - STOP" if o["stop"] else " - review" if o["review_required"] else ""),
    ]
    if s["errors"]:
        lines.append(f"{len(s['errors'])} books failed")
    return "\n".join(lines)


def render_report(s: dict) -> str:
    """The report of a run in Markdown."""
    d, o, c, b = s["dataset"], s["oversize"], s["corpus"], s["boundaries"]
    t = d["chunk_tokens"]
    parts = [
        f"# {s['run_name']}", f"Generated {s['generated_at_utc']}; tokens counted by {s['tokenizer']['kind']}" + ("" if s["tokenizer"]["exact"] else " (approximate)") + ".",
        "## Corpus", _table([(k.replace("_", " "), c[k]) for k in ("books_included", "books_excluded", "chapters", "scenes", "paragraphs", "words")]),
        "## Dataset", _table([(k.replace("_", " "), d[k]) for k in ("chunks", "content_tokens", "boundary_tokens", "training_tokens_including_boundaries", "train_chunks", "val_chunks", "train_tokens", "val_tokens", "budget_utilisation")]),
        "## Chunk lengths", _table([(k, v) for k, v in t.items()]), "## Boundaries", _table([(k.replace("_", " "), v) for k, v in b.items()]),
        "## Oversize ledger", _table([("records", o["records"]), ("excluded tokens", o["excluded_tokens"]), ("excluded fraction", o["excluded_fraction"]), ("review required", o["review_required"]), ("stop", o["stop"])]),
        *(f"* {k}: {number(v['count'])} records, {number(v['tokens'])} tokens, " + ", ".join(f"{a} {n}" for a, n in v["actions"].items()) for k, v in sorted(o["by_kind"].items())),
        "## Validation books", "\n".join(f"* {x}" for x in s["splits"]["val_books"]) or "none",
        "## Excluded books", "\n".join(f"* {x['book_id']} ({x['matched_pattern']})" for x in s["exclusions"]["matched"]) or "none",
        "## Books", "| book | chapters | scenes | paragraphs | chunks | tokens |\n|---|---:|---:|---:|---:|---:|\n" + "\n".join(
            f"| {x['book_id']} | {number(x['chapters'])} | {number(x['scenes'])} | {number(x['paragraphs'])} | {number(x['chunks'])} | {number(x['content_tokens'])} |" for x in s["provenance"]["books"]),
        "## Errors", "\n".join(f"* {x['book_id']}: {x['error']}" for x in s["errors"]) or "none",
    ]
    return "\n\n".join(parts) + "\n"
