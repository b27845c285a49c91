"""Small tables with everything that is odd: nulls, empty and very long texts, ties, repeats, clashing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark: SparkSession, rows, schema: str = SCHEMA) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def documents(spark: SparkSession, texts, first: int = 0) -> DataFrame:
    """Texts with rising ids."""
    return table(spark, [(first + i, t, "en", "src", None if t is None else len(t)) for i, t in enumerate(texts)])


PROSE = ("the river went past the old mill and nobody in the village could say when the wheel had stopped turning "
         "though every child knew the story of the miller who left one night with his lantern").split()


def prose(n: int, start: int = 0) -> str:
    """n words without repeated five-word windows."""
    return " ".join(f"{PROSE[(i * 7 + start) % len(PROSE)]}{(i + start) % 97}{'xyz'[i % 3]}{i // 97}" for i in range(n))


ODD = [None, "", " \n\t ", "one", "Two words", "a\nb\n\na\n", "naïve café — 東京   x y", "x" * 30_000,
       prose(3000), prose(40), prose(40), "  lead and  double  spaces ", "<|endoftext|> mark ▁ and \\ back",
       "Released under the MIT License.\nmore"]


def odd_documents(spark: SparkSession) -> DataFrame:
    """ODD with ids, a null id, the same id twice, and the same row twice."""
    rows = [(i, t, "en", "src", None) for i, t in enumerate(ODD)]
    rows += [(None, prose(25), None, None, None), (9, prose(40), "en", "src", None), (9, prose(33), "en", "src", None)]
    return table(spark, rows)


def with_clashing_columns(df: DataFrame, names) -> DataFrame:
    from pyspark.sql import functions as F
    return df.withColumns({n: F.lit("clash") for n in names if n not in df.columns})
