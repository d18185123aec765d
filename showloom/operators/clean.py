"""Cleaning of raw catalogue A."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import nested as N
from ..functions import text as T
from ..sources import schemas as S


def cast_size(c: Column) -> dict[str, Column]:
    """``"Medium (11 to 20 performers)"`` -> detail in the parentheses, category in front."""
    return {"cast_size_detail": T.paren_text(c), "cast_size_category": T.first_word(c)}


def clean_catalog(raw: DataFrame) -> DataFrame:
    """All raw columns and nine derived ones, in one projection without a shuffle.

    ``characters`` may be JSON text or the array itself, ``billing`` dict text or the map.
    """
    characters, billing = F.col("characters"), F.col("billing")
    if _is_text(raw, "characters"):
        characters = F.from_json(characters, S.CHARACTERS)
    if _is_text(raw, "billing"):
        billing = N.literal_map(billing)

    staged = raw.withColumns({"__characters": characters, "__billing": billing})
    credits = N.credit_buckets(F.col("__billing"))
    staged = staged.withColumn("__credits", credits)
    counts = N.gender_counts(F.col("__characters.Gender"))
    derived = {
        **cast_size(F.col("cast_size")),
        "music_by": F.col("__credits.music"),
        "lyrics_by": F.col("__credits.lyrics"),
        "book_by": F.col("__credits.book"),
        "other_authors": F.col("__credits.others"),
        **{f"{kind}_character_count": c for kind, c in counts.items()},
    }
    return staged.withColumns(derived).drop("__characters", "__billing", "__credits")


def _is_text(df: DataFrame, name: str) -> bool:
    field = next(f for f in df.schema.fields if f.name.lower() == name)
    return isinstance(field.dataType, StringType)
