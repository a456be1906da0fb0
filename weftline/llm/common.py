"""Column expressions that several of the training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.plans.runtime import bounded_broadcast, materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character as it is.

    Pure ASCII text takes Spark's byte-wise ``lower``; other text takes ``translate``.
    """
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in taken:
        name += "_"
    return name


def without_ids(docs: DataFrame, id_col: str, lost: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id is in ``lost``, a table of one column; null matches null.

    ``lost`` is sent to every executor if its counted rows are few, else both sides shuffle.
    """
    name = fresh(docs, "lost")
    lost = bounded_broadcast(materialize(lost.toDF(name).distinct(), "lost"), 32)
    return docs.join(lost, docs[id_col].eqNullSafe(F.col(name)), "left_anti")
