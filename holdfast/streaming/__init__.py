"""Streams of holdings.

The batch operators that look at one row at a time work on streams as they are
(scope filters, name normalisation, similarity scores); this package adds the
join of a stream of owners to a register that stands still.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalise
from ..operators.relational import one_row_per, split_unique
from ..specs import EXACT, TextSpec


def link_stream(owners: DataFrame, register: DataFrame, text: TextSpec = EXACT) -> DataFrame:
    """A stream's owners (Owner_ID, Owner_Name) with the sector of the register's row of the same, unique, normalised name."""
    names = register.select("idbr_name", "esa", normalise(F.col("idbr_name"), text).alias("name_"))
    names = split_unique(one_row_per(names, ["name_", "esa"]), "name_")
    return owners.withColumn("name_", normalise(F.col("Owner_Name"), text)).join(names, "name_").select("Owner_ID", "Owner_Name", "idbr_name", "esa")
