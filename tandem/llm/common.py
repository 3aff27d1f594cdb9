"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.session import ensure_checkpoint_dir, scratch_path, ship_package


def prepare(spark: SparkSession) -> None:
    """Make the package importable on the executors and name the shared folder."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` (long) and ``text`` (null becomes empty): no other column of the input can clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


# A batch with a null among longs reaches pandas as doubles, which cannot hold every id: null ids travel as this
# number, which no document may have.
NO_ID = -(1 << 63)


def any_id(docs: DataFrame) -> DataFrame:
    """``id_text`` with null ids as ``NO_ID``; ``null_ids`` turns them back."""
    return id_text(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))


def null_ids(df: DataFrame) -> DataFrame:
    return df.withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(NO_ID)))


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores added until no column has it (names differ by more than case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_texts(docs: DataFrame, change, drop: tuple = ()) -> DataFrame:
    """``docs`` with the texts that ``change(batch)`` gives, a list for each Arrow batch, and ``n_chars``, if there,
    to match wherever a text is another; all other columns pass as they are, those of ``drop`` go."""
    import pyarrow as pa

    names = [c for c in docs.columns if c not in drop]

    def run(batches):
        for batch in batches:
            old, new = batch.column("text").to_pylist(), change(batch)
            columns = {c: batch.column(c) for c in names}
            columns["text"] = pa.array(new, batch.column("text").type)
            if "n_chars" in names:
                kind = batch.column("n_chars").type
                columns["n_chars"] = pa.array(
                    [n if a == b else len(b) for n, a, b in zip(batch.column("n_chars").to_pylist(), old, new, strict=True)], kind)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    return docs.mapInArrow(run, docs.select(names).schema)


def written(df: DataFrame, name: str, compression: str = "zstd", partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back: lineage is cut by files that every
    executor sees, so a lost executor costs a re-read and nothing is computed twice."""
    spark = df.sparkSession
    prepare(spark)
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    writer = df.write.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pd.DataFrame], column: str, most_bytes: int = 8 << 20) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches so that ``column`` (str or bytes) holds about ``most_bytes`` a piece, one row at least:
    a worker's memory follows the longest value, not the number of rows in a batch."""
    for pdf in batches:
        if not len(pdf):
            continue
        ends = pdf[column].str.len().cumsum().to_numpy()
        at = 0
        while at < len(pdf):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(ends.searchsorted(base + most_bytes, side="right")))
            yield pdf.iloc[at:to].reset_index(drop=True)
            at = to


def small(df: DataFrame, longs: int, most_bytes: int = 8 << 20) -> DataFrame:
    """``df`` marked for broadcast when its rows are proven few; otherwise as it is (Spark then shuffles)."""
    kept = written(df, "small")
    return F.broadcast(kept) if kept.count() * (8 * longs + 16) <= most_bytes else kept
