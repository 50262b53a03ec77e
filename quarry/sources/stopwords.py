"""Stop-word source.

One word per line; each line is trimmed and **stemmed**, then de-duplicated,
so the filter later compares stems with stems (a word whose stem equals a
listed word's stem is dropped too). Every line is a word. A file that is not
there is warned about and means no stop words.
"""

from __future__ import annotations

import os
import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.stem import stem_string_column

# The file holds the English stop-word list that the ranking semantics depend on, one word per line, in its
# original order.
DEFAULT_STOPWORDS = os.path.join(os.path.dirname(os.path.dirname(__file__)), "resources", "stopwords.txt")


def read_stopword_lines(path: str = DEFAULT_STOPWORDS) -> list[str]:
    """The raw words of a local stop-word file (the packaged list; oracle SQL)."""
    with open(path, encoding="utf-8") as fh:
        return [ln.strip() for ln in fh]


def load_stopwords(spark: SparkSession, path: str | None = None, stem: bool = True) -> DataFrame:
    """DataFrame ``(term string)`` of distinct stop stems (or raw words).

    ``path`` (on shared storage) is read by Spark. Without it the packaged
    list is used: it lives beside the code, which on a cluster may sit in a
    zip only the driver can open, so the driver reads its few hundred lines
    and Spark stems them."""
    if path is None:
        raw = read_stopword_lines()
        lines = spark.createDataFrame([(w,) for w in raw], "value string")
    else:
        try:
            lines = spark.read.text(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            warnings.warn(f"no stop-word file at {path}; no word is left out", stacklevel=2)
            lines = spark.createDataFrame([], "value string")
    words = lines.select(F.regexp_replace(F.col("value"), r"^\s+|\s+$", "").alias("term"))
    if stem:
        words = stem_string_column(words, "term")
    return words.distinct()
