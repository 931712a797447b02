"""Text functions as columns: white space, normalisation, tokens, names."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

#: Fixed value: the white space of Python's ``str.split`` as a Java pattern.
SPACE = r"[\s\x{1c}-\x{1f}]"


@pandas_udf(StringType())
def _basic_exact(s: pd.Series) -> pd.Series:
    def one(x: str | None) -> str | None:
        if x is None:
            return None
        folded = unicodedata.normalize("NFKC", x).lower()
        return " ".join("".join(c if c.isalnum() or c.isspace() else " " for c in folded).split())

    return s.map(one)


def py_strip(c: Column) -> Column:
    """``str.strip``: all Unicode white space at both ends."""
    return F.regexp_replace(c, rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def collapse_space(c: Column) -> Column:
    """``" ".join(s.split())``."""
    return F.trim(F.regexp_replace(c, rf"(?U){SPACE}+", " "))


def nfkc(c: Column) -> Column:
    """Compatibility composition by the Unicode library that comes with Spark, in the JVM; only texts that are not ASCII are composed.

    Equal to Python's on every character that Python's tables know.  Spark calls any such expression nondeterministic, so an
    aggregate function takes it as a column selected before.
    """
    composed = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), F.coalesce(c, F.lit("")), F.lit(True))  # takes no null, also where Spark moves it before the test
    return F.when(c.rlike(r"[^\x00-\x7F]"), composed).otherwise(c)


def normalize_basic(c: Column, compatibility: bool = True, exact: bool = False) -> Column:
    """NFKC, lower case, every run of other than letters and digits one space.

    All of it runs in the JVM, but for ``exact``, which takes letters from
    Python's Unicode tables where a text is not ASCII.  ``compatibility=False``
    leaves NFKC out.  A null stays null.
    """
    fast = F.trim(F.regexp_replace(F.lower(nfkc(c) if compatibility and not exact else c), r"[^\p{L}\p{N}]+", " "))
    if not exact:
        return fast
    other = c.rlike(r"[^\x00-\x7F]")
    return F.when(other, _basic_exact(F.when(other, c))).otherwise(fast)


def normalized(c: Column, normalize: str = "basic", **how: bool) -> Column:
    if normalize == "basic":
        return normalize_basic(c, **how)
    if normalize == "none":
        return collapse_space(c)
    raise ValueError(f"unknown normalization: {normalize}")


def tokens(c: Column, normalize: str = "basic", tokenizer: str = "word", **how: bool) -> Column:
    """Tokens of a text: words between spaces (an unspaced text is one), or characters other than white space."""
    text = normalized(c, normalize, **how)
    if tokenizer == "word":
        return F.filter(F.split(text, " "), lambda x: x != "")
    if tokenizer == "char":
        return F.filter(F.split(F.regexp_replace(text, rf"(?U){SPACE}", ""), ""), lambda x: x != "")
    raise ValueError(f"unknown tokenizer: {tokenizer}")


def join_texts(texts: Column, separator: str = " ") -> Column:
    """The texts that are not empty once stripped, joined in order."""
    return F.array_join(F.filter(F.transform(texts, lambda t: py_strip(F.coalesce(t, F.lit("")))), lambda t: t != ""), separator)


def safe_name(c: Column, longest: int = 120) -> Column:
    """A file name: unsafe runs as ``_``, a default if nothing is left, cut, and ten digits of the SHA-1."""
    base = F.regexp_replace(c, r"[^A-Za-z0-9._-]+", "_")
    base = F.regexp_replace(base, r"\A[._]+|[._]+\z", "")
    base = F.substring(F.when(base == "", "record").otherwise(base), 1, longest)
    return F.concat(base, F.lit("_"), F.substring(F.sha1(F.encode(c, "UTF-8")), 1, 10))


def resolve_path(path: Column, source: Column, root: str | None = None, home: str | None = None) -> Column:
    """An absolute path as it is; else below ``root``, or beside the source file."""
    if home:
        path = F.regexp_replace(path, r"\A~(?=/|\z)", home)
    base = F.lit(root.rstrip("/")) if root else F.regexp_replace(source, r"/[^/]*\z", "")
    return F.when(path.startswith("/"), path).otherwise(F.concat_ws("/", base, path))
