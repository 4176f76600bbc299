"""JSON documents parsed once, when a table is loaded: VARIANT columns, and a quarantine for what is not JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROKEN, REASON, ORIGINAL = "broken", "reason", "original"


def parsed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with the texts in ``columns`` as VARIANT, and what tells broken rows from whole ones.

    ``broken`` says that some text is not JSON, ``reason`` names the columns, and only then ``original``
    holds the texts as they came. A NULL text is a missing document, not a broken one. Written partitioned
    by ``broken``, the two kinds are two tables from one pass over the rows.
    """
    # A document is parsed in a step of its own: what reads the result below does not parse it again.
    read = df.withColumns({f"__parsed_{c}": F.try_parse_json(c) for c in columns})
    bad = [F.when(F.col(c).isNotNull() & F.col(f"__parsed_{c}").isNull(), F.lit(c)) for c in columns]
    reason = F.array_join(F.filter(F.array(*bad), lambda c: c.isNotNull()), ",")
    marked = read.withColumn(REASON, reason).withColumn(BROKEN, F.col(REASON) != "")
    texts = F.when(F.col(BROKEN), F.struct(*[F.col(c) for c in columns]))
    marked = marked.withColumn(ORIGINAL, texts)
    return marked.withColumns({c: F.col(f"__parsed_{c}") for c in columns}).drop(*[f"__parsed_{c}" for c in columns])


def whole(table: DataFrame) -> DataFrame:
    """The rows whose documents are all JSON or missing."""
    return table.filter(~F.col(BROKEN).cast("boolean")).drop(BROKEN, REASON, ORIGINAL)


def quarantined(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The other rows, with their reason and the texts as they came."""
    return table.filter(F.col(BROKEN).cast("boolean")).drop(BROKEN, *columns).select("*", f"{ORIGINAL}.*").drop(ORIGINAL)
