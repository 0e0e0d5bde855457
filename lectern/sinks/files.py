"""Tables, cleaned text and quoted exports. All of them replace what was there."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.staging import released

# Values are written as they are: Spark would trim them.
_AS_THEY_ARE = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_clean_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """With ``compression`` a file has one reader, so the rows should be in many files."""
    with released(df.sparkSession):
        (
            df.write.mode("overwrite")
            .options(
                **_AS_THEY_ARE,
                header=True,
                encoding="UTF-8",
                escape='"',
                dateFormat="yyyy-MM-dd",
                compression=compression,
            )
            .csv(path)
        )


def write_orc(df: DataFrame, path: str) -> None:
    with released(df.sparkSession):
        df.write.mode("overwrite").orc(path)


def write_partitioned(df: DataFrame, path: str, by: str) -> None:
    """ORC in one folder per value of ``by``. Only the values that ``df`` holds are replaced, all
    others keep their rows. The rows are dealt by value into files of a measured size; a
    value with very many rows gets several."""
    with released(df.sparkSession):
        (
            df.hint("rebalance", by)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(by)
            .orc(path)
        )


def write_lookup(df: DataFrame, path: str, *keys: str) -> None:
    """ORC sorted by ``keys``, with bloom filters on them: a filter on the first key reads the
    few row groups that hold it, one on another key passes over those that cannot."""
    (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .write.mode("overwrite")
        .options(**{"orc.bloom.filter.columns": ",".join(keys), "orc.bloom.filter.fpp": "0.01"})
        .orc(path)
    )


def create_table(df: DataFrame, name: str, file_format: str = "orc") -> None:
    """Drop the table when it exists and create it from the query."""
    df.write.mode("overwrite").format(file_format).saveAsTable(name)


def export_csv(df: DataFrame, path: str) -> None:
    """Every value quoted, quotes doubled, NULL as an empty value."""
    text = df.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns]
    )
    with released(df.sparkSession):
        (
            text.write.mode("overwrite")
            .options(
                **_AS_THEY_ARE,
                header=True,
                quoteAll=True,
                quote='"',
                escape='"',
                emptyValue="",
            )
            .csv(path)
        )


def export_bundle(datasets: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """One export directory per named dataset."""
    paths = {name: f"{folder}/{name}" for name in datasets}
    for name, df in datasets.items():
        export_csv(df, paths[name])
    return paths
