"""Unicode forms that Spark has no function for, as Arrow UDFs."""

from __future__ import annotations

import html
import re
import unicodedata
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """NFKC; null stays null."""
    return texts.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


#: Characters that NFKC leaves as they are, whatever stands beside them; a text of these alone is in NFKC.
SETTLED = r"\x00-\x7F\u00A1-\u00A7\u00A9\u00AB-\u00AE\u00B0\u00B1\u00B6\u00B7\u00BB\u00BF-\u0131\u0134-\u013E\u0141-\u0148\u014A-\u017E\u2010\u2012-\u2016\u2018-\u2023\u20AC"


def composed(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with a text column in NFKC; only texts with other than SETTLED characters pass through Python. Null stays null."""
    odd = F.coalesce(F.col(column).rlike(f"[^{SETTLED}]"), F.lit(False))
    return rows.where(~odd).unionByName(rows.where(odd).withColumn(column, nfkc(column)))


@F.pandas_udf(StringType())
def folded_key(texts: pd.Series) -> pd.Series:
    """NFKC, case-folded, blanks collapsed."""
    return texts.map(lambda x: " ".join(unicodedata.normalize("NFKC", x).casefold().split()), na_action="ignore")


@F.pandas_udf(StringType())
def title_key(texts: pd.Series) -> pd.Series:
    """Word characters without combining marks, case-folded; letters such as l with stroke stay."""

    def one(text: str) -> str:
        plain = "".join(c for c in unicodedata.normalize("NFKD", text.casefold()) if not unicodedata.combining(c))
        return " ".join(re.findall(r"\w+", plain))

    return texts.map(one, na_action="ignore")


@F.pandas_udf(StringType())
def slug(texts: pd.Series) -> pd.Series:
    """Lower-case ASCII words joined by hyphens."""

    def one(text: str) -> str:
        plain = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower()
        return re.sub(r"[^a-z0-9]+", "-", plain).strip("-")

    return texts.map(one, na_action="ignore")


@F.pandas_udf(StringType())
def url_key(texts: pd.Series) -> pd.Series:
    """A URL or file name without escapes, NFC, case-folded."""
    return texts.map(lambda x: unicodedata.normalize("NFC", unquote(x)).casefold(), na_action="ignore")


@F.pandas_udf(StringType())
def unescaped(texts: pd.Series) -> pd.Series:
    """HTML entities as characters."""
    return texts.map(html.unescape, na_action="ignore")
