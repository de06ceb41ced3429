"""Which years does each dataset have? Counts, matrix, and last row per dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabaudit.functions.text import parse_year

AVAILABLE, NOT_AVAILABLE = "Tersedia", "Tidak Tersedia"
#: Most columns of a matrix, and years in one word of bits.
MOST_YEARS, WORD_YEARS = 1000, 62


def json_unpack(ready: DataFrame, column: str = "tahun") -> DataFrame:
    """``Dataset_Id, Judul_Tabel, <column> INT`` (and ``row_no``) out of the packed rows."""
    row = F.from_json("Row_Data_JSON", "map<string,string>")
    return ready.select("Dataset_Id", "Judul_Tabel", parse_year(row[column]).alias(column), "row_no")


def year_counts(rows: DataFrame, low: int | None = None, high: int | None = None) -> DataFrame:
    """Rows per year, most frequent first."""
    in_range = year_range(rows, low, high)
    return in_range.where(F.col("tahun").isNotNull()).groupBy("tahun").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "tahun")


def year_range(rows: DataFrame, low: int | None = None, high: int | None = None) -> DataFrame:
    if low is not None:
        rows = rows.where(F.col("tahun") >= low)
    if high is not None:
        rows = rows.where(F.col("tahun") <= high)
    return rows


def years_of(rows: DataFrame) -> list[int]:
    """The years that occur, in order. A year is a column of the matrix, so more than ``MOST_YEARS`` are an error, not a list."""
    found = rows.where(F.col("tahun").isNotNull()).select(F.col("tahun").cast("int")).distinct().limit(MOST_YEARS + 1).collect()
    if len(found) > MOST_YEARS:
        raise ValueError(f"more than {MOST_YEARS} different years; choose a range first")
    return sorted(row[0] for row in found)


def availability_matrix(rows: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """One line per dataset, one column ``tahun_<year>`` per year that says whether there is a row for it.

    Years that aren't named are taken from the data, which is one pass more. One aggregate holds a bit for each year and
    dataset, eight bytes for 64 years, and the bits become columns at the end.
    """
    years = years_of(rows) if years is None else sorted(set(years))
    words = [years[k : k + WORD_YEARS] for k in range(0, len(years), WORD_YEARS)]
    bits = [F.bit_or(sum((F.when(F.col("tahun") == year, F.lit(1 << bit)).otherwise(F.lit(0)) for bit, year in enumerate(word)), F.lit(0).cast("long"))).alias(f"_w{k}") for k, word in enumerate(words)]
    chosen = rows.where(F.col("tahun").isin(years) if years else F.lit(False))
    found = chosen.groupBy("Judul_Tabel", "Dataset_Id").agg(*(bits or [F.count(F.lit(1)).alias("_n")]))

    def label(k: int, bit: int, year: int):
        return F.when(F.getbit(f"_w{k}", F.lit(bit)) == 1, AVAILABLE).otherwise(NOT_AVAILABLE).alias(f"tahun_{year}")

    return found.select("Judul_Tabel", "Dataset_Id", *[label(k, bit, year) for k, word in enumerate(words) for bit, year in enumerate(word)])


def keep_last(rows: DataFrame, key: str = "Dataset_Id") -> DataFrame:
    """Last row of every key in row order."""
    others = [name for name in rows.columns if name != key]
    last = rows.groupBy(key).agg(F.max_by(F.struct(*others), "row_no").alias("last"))
    return last.select(key, *[F.col(f"last.{name}").alias(name) for name in others])
