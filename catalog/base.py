"""Registry of the queries and shared ways to read and derive their inputs.

The given tables hold no LaTeX, so LaTeX-shaped text is derived from their columns by the same expression in
Spark and in SQL. Every query reads whole tables and whole texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pairloom.functions import patterns as P

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Split an input that has fewer scan tasks than cores; large inputs pass as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


# White space and trimming in the oracle's regular expressions: the same fixed sets.
SPACE, TRIM = P.SPACE, P.TRIM_SPACE


def sql_trim(text: str) -> str:
    return rf"regexp_replace({text}, '^{TRIM}+|{TRIM}+$', '', 'g')"


def sql_squeeze(text: str) -> str:
    return rf"regexp_replace({sql_trim(f'translate({text}, chr(10), chr(32))')}, '{SPACE}+', ' ', 'g')"


# LaTeX made from prose: its own markup characters are swapped, then words before a comma become inline
# formulas, words before a semicolon or colon displayed ones, some short words get other delimiters, and
# every line end gets a comment and an equation.
_SWAP = ("$%\\{}", "SPB()")
_RULES = (
    (r"(\p{L}+), ", r"$\1_i$, "),
    (r"(\p{L}+)[;:!?] ", r"$$\1^2$$ "),
    (r" (de|the|und|que) ", r" \(\1\) "),
    (r" (la|of|der|los) ", r" \[\1+1\] "),
    (r"\n", "\n" + r"\begin{equation}e. f=1\end{equation} 50\% done % note $x$" + "\n"),
)


def latex(text: Column) -> Column:
    out = F.translate(text, *_SWAP)
    for pattern, replacement in _RULES:
        java = replacement.replace("\\", "\\\\").replace("$", r"\$").replace(r"\\1", "$1")
        # a word that matches does so from its first letter, so no other is tried
        out = F.regexp_replace(out, pattern.replace(r"(\p{L}+)", r"(?<!\p{L})(\p{L}++)"), java)
    return out


def sql_latex(text: str) -> str:
    out = f"translate({text}, '{_SWAP[0]}', '{_SWAP[1]}')"
    for pattern, replacement in _RULES:
        re2 = replacement.replace("\\", r"\\").replace(r"\\1", r"\1").replace("\n", "' || chr(10) || '")
        out = f"regexp_replace({out}, '{pattern}', '{re2}', 'g')"
    return out


SQL_STRIPPED = r"regexp_replace({0}, '(^|[^\\])%[^\n]*', '\1', 'g')"
SQL_STRIPPED_LINES = r"regexp_replace({0}, '(^|[^\\])(?:%[^\n]*\n?)+', '\1', 'g')"
