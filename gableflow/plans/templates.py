"""SQL templates: {key} stands for a value, for those who bring their own statements."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def rendered(template: str, **values) -> str:
    """The template with every known {key} replaced; a list of ids becomes (1,2,3), an empty one (-1); unknown keys stay."""

    def text(value) -> str:
        if isinstance(value, str) or not isinstance(value, Iterable):
            return str(value)
        return "(" + (",".join(str(int(v)) for v in value) or "-1") + ")"

    return re.sub(r"\{(\w+)\}", lambda m: text(values[m[1]]) if m[1] in values else m[0], template)


def run(spark: SparkSession, template: str, tables: dict[str, DataFrame], **values) -> DataFrame:
    """The statement over DataFrames that it names."""
    return spark.sql(rendered(template, **values), **tables)
