"""Which rows may teach a classifier, and bounded samples of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Rows that no classifier learns from: crc32 of doc_id as text is divisible by 5. A null doc_id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def bounded_sample(rows: DataFrame, label: str, columns: list[str], total: int, seed: int = 7, measure: Callable[[DataFrame], DataFrame] | None = None) -> list:
    """At most ``total`` rows of ``rows(doc_id, label, ...)`` on the driver, of every label as many as of the others or all.

    Rows are chosen by a hash of doc_id, so reruns agree. Labels are few; their rows are counted first, and rows are
    filtered in the tasks at the rate that the counts ask for. ``measure`` may turn the chosen rows, with ``_number``, into
    smaller ones of the same columns before they are sent.
    """
    counts = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    if not counts:
        return []
    each = max(1, total // len(counts))
    number = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)).alias("_number")
    rate = F.lit(0.0)
    for value, n in counts.items():
        most = min(1.0, (each + 3 * each**0.5) / n)
        rate = F.when(F.col(label) == F.lit(value), most).otherwise(rate)
    found = rows.select(label, *columns, number).filter(F.col("_number") < rate * float(1 << 30))
    found = (measure(found) if measure else found).collect()
    kept, seen = [], dict.fromkeys(counts, 0)
    for r in sorted(found, key=lambda r: (r["_number"], *(str(r[c]) for c in columns))):
        if seen[r[label]] < each:
            seen[r[label]] += 1
            kept.append(r)
    return kept
