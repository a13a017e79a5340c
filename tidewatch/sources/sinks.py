"""Writers: the latest snapshot, the raw archive, the change log and exports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import slices
from .store import stored


def numbered(df: DataFrame, keys: list[str]) -> DataFrame:
    """``id`` from 1 in the order of the keys, counted in slices."""
    return slices.numbered(df, keys)


def write_latest(df: DataFrame, path: str, keys: list[str], *, also_parquet: str | None = None) -> None:
    """Replaces the latest snapshot, as JSON records with an id and nulls written out; a second copy from the same rows."""
    rows = numbered(df, keys)
    if also_parquet:
        rows.write.mode("overwrite").parquet(also_parquet)
        rows = df.sparkSession.read.parquet(also_parquet)
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def single_node(df: DataFrame) -> DataFrame:
    """Rows for one instance, or for no stated number."""
    return df.where(F.col("DesiredCount").isin(1, -1))


def zeros_marked(df: DataFrame, columns: list[str]) -> DataFrame:
    """0 as the sentinel -1."""
    return df.withColumns({c: F.when(F.col(c) == 0, -1).otherwise(F.col(c)) for c in columns})


def write_raw(df: DataFrame, path: str, time: str) -> None:
    """Appends a tick to the archive of gzipped CSV, by day."""
    rows = df.withColumn("dt", F.date_format(time, "yyyy-MM-dd"))
    rows.write.mode("append").partitionBy("dt").option("header", True).option("compression", "gzip").csv(path)


def write_laid_out(df: DataFrame, table: str, path: str, keys: list[str], buckets: int = 64) -> DataFrame:
    """A snapshot as a table of the catalogue in buckets of its keys, sorted: joins by these keys of tables with as many buckets
    shuffle and sort neither.  Returns the table."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def append_clustered(df: DataFrame, path: str, by: list[str], files: int | None = None, time: str = "ts") -> None:
    """Appends to the change log by day, each day in files of ranges of ``by``, with Bloom filters on these columns: a query of
    a day and some of their values reads few of its files' parts."""
    rows = df.withColumn("dt", F.date_format(time, "yyyy-MM-dd"))
    rows = rows.repartitionByRange(*([files] if files else []), "dt", *by).sortWithinPartitions("dt", *by)
    writer = rows.write.mode("append").partitionBy("dt").option("parquet.block.size", 8 << 20)
    for c in by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)


def append_changes(df: DataFrame, path: str, time: str = "ts", batch: str | None = None) -> None:
    """Appends to the change log by day; with a batch name a batch written again replaces its own rows, so retries are safe."""
    rows = df.withColumn("dt", F.date_format(time, "yyyy-MM-dd"))
    if batch is None:
        rows.write.mode("append").partitionBy("dt").parquet(path)
    else:
        rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "dt").parquet(path)


def newest_versions(log: DataFrame, keys: list[str], time: str = "ts", version: str = "version") -> DataFrame:
    """The last written row of each key and time."""
    w = Window.partitionBy(*keys, time).orderBy(F.col(version).desc())
    return log.withColumn("_i", F.row_number().over(w)).where("_i = 1").drop("_i")


def records(df: DataFrame, dims: list[str], measures: dict[str, str], time: Column) -> DataFrame:
    """Rows as a time-series store takes them: named text dimensions, typed measures as text, time in epoch milliseconds."""
    named = F.array(*(F.struct(F.lit(d).alias("name"), F.col(d).cast("string").alias("value")) for d in dims))
    typed = F.array(*(F.struct(F.lit(m).alias("name"), F.col(m).cast("string").alias("value"), F.lit(t).alias("type")) for m, t in measures.items()))
    return df.select(named.alias("dimensions"), typed.alias("measures"), F.unix_millis(time).cast("string").alias("time"))


def send(df: DataFrame, submit, size: int = 100, retries: int = 10) -> DataFrame:
    """Sends rows in batches of ``size`` from the tasks; ``submit(list of dicts)`` returns those rejected, which are sent
    again up to ``retries`` times.  Returns ``sent`` and ``rejected`` of each task.  A task that runs again sends its rows
    again, so the store has to keep one of equal records, as those that key records by dimensions and time do."""
    names = df.columns

    def run(batches):
        import pandas as pd

        sent = rejected = 0
        for pdf in batches:
            rows = pdf[names].to_dict("records")
            for i in range(0, len(rows), size):
                left = rows[i : i + size]
                total = len(left)
                for _ in range(retries + 1):
                    left = submit(left) if left else []
                sent, rejected = sent + total - len(left), rejected + len(left)
        yield pd.DataFrame({"sent": [sent], "rejected": [rejected]})

    return df.mapInPandas(run, "sent long, rejected long")


def write_pages(df: DataFrame, path: str, order: list[str], size: int = 1000, token: str | None = None) -> int:
    """Rows as pages of a JSON service, ``size`` in each, in a folder that all executors share: ``page-<first>.json`` with the
    list ``Items``; with ``token`` the pages are ``page-<token>.json``, the first has none, and each but the last names the
    next by that key.  Returns the number of pages."""
    rows = slices.numbered(df, order, "_no", 0)
    page = F.floor(F.col("_no") / size)
    items = F.transform(F.array_sort(F.collect_list(F.struct("_no", F.struct(*df.columns).alias("item")))), lambda x: x["item"])
    pages = rows.groupBy(page.alias("page")).agg(items.alias("Items")).select("page", F.to_json(F.struct("Items")).alias("text"))  # size rows each
    pages = stored(pages, "pages")
    n = pages.count()

    def write(batches):
        import json

        import pandas as pd
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(path)
        store.create_dir(base)
        for pdf in batches:
            for number, text in zip(pdf["page"].tolist(), pdf["text"].tolist(), strict=True):
                name = number * size
                if token:
                    name = f"t{number}" if number else ""
                    text = json.dumps(json.loads(text) | ({token: f"t{number + 1}"} if number < n - 1 else {}))
                with store.open_output_stream(f"{base}/page-{name}.json") as f:
                    f.write(text.encode())
            yield pd.DataFrame({"n": [len(pdf)]})

    return pages.mapInPandas(write, "n long").agg(F.sum("n")).first()[0] or 0


def write_selector(known: DataFrame, new: DataFrame, path: str, keys: list[str]) -> None:
    """Adds new keys to the selector table: written beside it first, as it is also read."""
    from ..operators.index import selector_union

    spark: SparkSession = new.sparkSession
    aside = f"{path}-{uuid.uuid4().hex}"
    selector_union(known, new, keys).write.parquet(aside)
    spark.read.parquet(aside).write.mode("overwrite").parquet(path)


def observed(df: DataFrame, name: str, signals: dict[str, list[str]]) -> tuple[DataFrame, Observation]:
    """``df`` and counts of rows whose columns of a signal are all there, gathered while it is written."""
    seen = Observation(name)
    counts = [F.count(F.when(F.array_position(F.array(*(F.col(c).isNull() for c in cols)), F.lit(True)) == 0, 1)).alias(s) for s, cols in signals.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def write_state(spark: SparkSession, path: str, **values) -> None:
    """A state of a few named values, replaced as a whole."""
    spark.createDataFrame([values]).coalesce(1).write.mode("overwrite").json(path)


def read_state(spark: SparkSession, path: str) -> dict:
    return spark.read.json(path).first().asDict()


def export_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header for download: for a page of results."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def export_month(df: DataFrame, path: str, month: str, time: str = "ts") -> None:
    """A month of the archive by vendor and day, one file each; a month that is there already is left as it is."""
    rows = df.where(F.date_format(time, "yyyy-MM") == month).withColumn("day", F.date_format(time, "yyyy-MM-dd"))
    rows.repartition("vendor", "day").write.mode("ignore").partitionBy("vendor", "day").option("header", True).csv(f"{path}/{month}")


def export_features(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Hardware features as text, missing ones as the word None."""
    shown = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("None")).alias(c) for c in df.columns))
    shown.write.mode("overwrite").format(fmt).options(header=True).save(path)
