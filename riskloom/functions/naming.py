"""Column names that every model library accepts."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame


def clean_names(names: list[str]) -> list[str]:
    """Upper-case word characters only; the k-th repeat of a name gets the suffix `_k`.

    A suffix that makes a name already taken is raised until the result is free. A name without any
    word character becomes `COLUMN`.
    """
    repeats: Counter[str] = Counter()
    cleaned: list[str] = []
    taken: set[str] = set()
    for raw in names:
        name = "_".join(re.findall(r"[0-9A-Za-z]+", raw)).upper() or "COLUMN"
        result = f"{name}_{repeats[name]}" if repeats[name] else name
        while result in taken:
            repeats[name] += 1
            result = f"{name}_{repeats[name]}"
        repeats[name] += 1
        taken.add(result)
        cleaned.append(result)
    return cleaned


def clean_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_names(df.columns))
