"""Queries of this package for the driver, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.llm import charsets, cutting, encoding, grouping, leaks, overlaps, packing, scans, shapes


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name -> query over the tables of a folder."""
    return {
        "p1_found": overlaps.p1_found,
        "p1_classes": overlaps.p1_classes,
        "p1_counts": overlaps.p1_counts,
        "p1_equal": overlaps.p1_equal,
        "p2_found": charsets.p2_found,
        "p2_restored": charsets.p2_restored,
        "p3_assignments": packing.p3_assignments,
        "p3_containers": packing.p3_containers,
        "p3_conserved": packing.p3_conserved,
        "p4_found": scans.p4_found,
        "p4_repaired": scans.p4_repaired,
        "p5_found": cutting.p5_found,
        "p5_pieces": cutting.p5_pieces,
        "p5_cover": cutting.p5_cover,
        "p6_found": grouping.p6_found,
        "p6_splits": grouping.p6_splits,
        "p6_balance": grouping.p6_balance,
        "p6_books": grouping.p6_books,
        "p7_ids": encoding.p7_ids,
        "p7_round_trip": encoding.p7_round_trip,
        "p8_found": leaks.p8_found,
        "p8_leaks": leaks.p8_leaks,
        "p8_items": leaks.p8_items,
        "p9_found": shapes.p9_found,
        "p9_shapes": shapes.p9_shapes,
    }


def _count(text: str) -> str:
    words = rf"len(regexp_extract_all({text}, '[^\s\p{{Z}}\x0B\x{{85}}]+'))"
    marks = rf"len(regexp_extract_all({text}, '[^\p{{L}}\p{{Nd}}\p{{Nl}}\p{{M}}\p{{Pc}}\x{{200C}}\x{{200D}}\s\p{{Z}}\x0B\x{{85}}]'))"
    return f"CAST(trunc(coalesce({words}, 0)::DOUBLE + 0.3::DOUBLE * coalesce({words}, 0)::DOUBLE + 0.5::DOUBLE * coalesce({marks}, 0)::DOUBLE) AS INTEGER)"


_SPACE = r"[\s\p{Z}\x0B\x{85}\x{1c}-\x{1f}]"


def oracle_sql() -> dict[str, str]:
    """DuckDB statements for the queries that SQL can express."""
    items = f"""
        p AS (SELECT book_id, paragraph_index, max({_count('text')}) AS n, max(text) AS text FROM paragraphs GROUP BY ALL),
        m AS (SELECT DISTINCT book_id, chapter_index, scene_index, unnest(paragraphs) AS x FROM scenes),
        d AS (SELECT book_id, chapter_index, scene_index, x.paragraph_index AS paragraph_index, max(x.n_tokens) AS declared FROM m GROUP BY ALL),
        items AS (
            SELECT 'paragraph' AS item_level, concat_ws('::', coalesce(book_id, ''), coalesce(paragraph_index::VARCHAR, '')) AS item_key, n, text FROM p
            UNION ALL
            SELECT 'scene', concat_ws('::', coalesce(d.book_id, ''), coalesce(d.chapter_index::VARCHAR, ''), coalesce(d.scene_index::VARCHAR, '')), sum(coalesce(p.n, d.declared, 0)), string_agg(coalesce(p.text, ''), chr(10) || chr(10) ORDER BY paragraph_index)
            FROM d LEFT JOIN p USING (book_id, paragraph_index) GROUP BY d.book_id, d.chapter_index, d.scene_index
            UNION ALL
            SELECT 'chunk', coalesce(id, ''), max({_count('text')}), max(text) FROM chunks GROUP BY id)"""
    cut = f"WITH {items} SELECT items.item_level, items.item_key, items.n, items.text FROM items JOIN budgets b ON b.item_level = items.item_level AND b.task = 'cut' WHERE items.n > b.capacity"
    side = "lower(trim(split))"
    words = r"array_to_string(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), ' ')"
    return {
        "p5_found": f"SELECT item_level, item_key FROM ({cut})",
        "p5_cover": rf"SELECT item_level, item_key, (len(text) - len(regexp_replace(text, '^{_SPACE}+', '')))::INTEGER AS first_char, len(regexp_replace(text, '{_SPACE}+$', ''))::INTEGER AS end_char, 0::BIGINT AS n_over FROM ({cut})",
        "p1_equal": f"WITH c AS (SELECT DISTINCT id, {side} AS s, {words} AS w FROM chunks WHERE id IS NOT NULL AND {side} IN ('train', 'val', 'test')) SELECT DISTINCT a.id AS eval_id, b.id AS train_id FROM c a JOIN c b ON a.w = b.w AND a.w <> '' AND a.s <> 'train' AND b.s = 'train' AND a.id <> b.id",
        "p3_conserved": f"WITH {items}, x AS (SELECT items.item_level, n::BIGINT AS n, greatest((n - 1) // b.capacity, 0) + 1 AS k FROM items JOIN budgets b ON b.item_level = items.item_level AND b.task = 'pack') SELECT item_level, count(*) AS n_items, sum(k)::BIGINT AS n_pieces, sum(n)::BIGINT AS n_tokens, 0::BIGINT AS n_gaps, 0::BIGINT AS n_over FROM x GROUP BY 1",
        "p6_books": "SELECT book_id, count(DISTINCT id) AS n_chunks, 1::BIGINT AS n_splits FROM chunks WHERE book_id IS NOT NULL GROUP BY 1",
        "p7_round_trip": "SELECT doc_id, md5(coalesce(text, '')) AS digest FROM documents",
    }
