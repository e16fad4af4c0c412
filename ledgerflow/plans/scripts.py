"""A runner of SQL scripts: all *.sql files of a folder by name, statement by statement."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def statements(script: str) -> list[str]:
    """Splits at semicolons outside of quotes and comments; comments go, but for those within quotes, and empty
    statements too."""
    out, piece, i, n = [], [], 0, len(script)
    while i < n:
        c, two = script[i], script[i : i + 2]
        if c in "'\"`":
            j = i + 1
            while j < n and script[j] != c:
                j += 2 if script[j] == "\\" and c != "`" else 1
            piece.append(script[i : j + 1])
            i = j + 1
        elif two == "--":
            i = script.find("\n", i) if "\n" in script[i:] else n
        elif two == "/*":
            end = script.find("*/", i + 2)
            piece.append(" ")
            i = n if end < 0 else end + 2
        elif c == ";":
            out.append("".join(piece).strip())
            piece, i = [], i + 1
        else:
            piece.append(c)
            i += 1
    return [s for s in [*out, "".join(piece).strip()] if s]


def run_script(spark: SparkSession, script: str) -> list[DataFrame]:
    return [spark.sql(s) for s in statements(script)]


def run_folder(spark: SparkSession, folder: str, pattern: str = "*.sql") -> list[DataFrame]:
    return [df for f in sorted(Path(folder).glob(pattern), key=lambda f: f.name) for df in run_script(spark, f.read_text(encoding="utf-8"))]
