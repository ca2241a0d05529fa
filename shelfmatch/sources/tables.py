"""Sources (SRC-1, SRC-3..5): parquet tables, SQL text, per-country unions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of the test layout ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names: Iterable[str] = TEST_TABLES) -> None:
    """Register every test table as a temp view so SQL text can address it."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def read_source(spark: SparkSession, query_or_path: str, args: dict | None = None,
                fmt: str = "parquet") -> DataFrame:
    """SRC-1: SQL text over registered views (named parameters allowed) or a path.

    A warehouse is reached the Spark way: ``spark.read.format("jdbc")
    .option("query", q)``; credentials stay in the caller's options.
    """
    q = query_or_path.strip()
    if q.lower().startswith(("select", "with", "(")):
        return spark.sql(q, args=args or {})
    return spark.read.format(fmt).load(q)


def country_union(spark: SparkSession, template: str, countries: Iterable[str],
                  country_col: str = "COUNTRY") -> DataFrame:
    """SRC-3: one logical table from per-country tables named by ``template``.

    ``template`` holds ``{country}`` (e.g. ``"{country}_retailer_product"``).
    Each branch gets a literal country column, so a later filter on it prunes
    whole branches at planning time.
    """
    frames = [spark.table(template.format(country=c)).withColumn(country_col, F.lit(c))
              for c in countries]
    if not frames:
        raise ValueError("no countries given")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def country_table(spark: SparkSession, template: str, countries: Iterable[str], path: str,
                  country_col: str = "COUNTRY") -> DataFrame:
    """SRC-3: per-country tables, named by ``template``, as one table partitioned by country.

    Each name is bound as an identifier parameter, never printed into SQL. One job
    writes all countries, each read once; a later run replaces the folders of the
    countries that it is given. What is read back knows every country's folder, so
    a filter or a join on the country opens the folders it needs and no others.
    """
    frames = [spark.sql(f"SELECT *, :country AS {country_col} FROM IDENTIFIER(:name)", args={"country": c, "name": f"`{template.format(country=c)}`"})
              for c in countries]
    if not frames:
        raise ValueError("no countries given")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(country_col).parquet(path)
    fields = [f for f in out.schema.fields if f.name != country_col]
    return spark.read.schema(StructType([*fields, out.schema[country_col]])).parquet(path)


#: Most rows of a parameter frame (one per country) that are sent to every task.
MAX_COUNTRIES = 10_000


def country_scan(table: DataFrame, params: DataFrame, country_col: str = "COUNTRY") -> DataFrame:
    """SRC-3: the rows of the countries in ``params``, with its other columns beside them.

    ``params`` has one row per country, which is checked, and is then broadcast; Spark
    turns the join into a run-time filter on the table's partitions (dynamic partition
    pruning), so folders of other countries are not read.
    """
    # A null or empty name is no country; a filter on this side is also what makes Spark plan the pruning.
    params = params.where(F.col(country_col) > "")
    n, countries = params.agg(F.count(F.lit(1)), F.count_distinct(country_col)).first()
    if n != countries:
        raise ValueError("parameters need one row per country")
    return table.join(F.broadcast(params) if n <= MAX_COUNTRIES else params, country_col)


def curated_ids(sot: DataFrame, id_col: str = "MASTER_PRODUCT", deleted_col: str | None = "IS_DELETED",
                keys: tuple[str, ...] = ("COUNTRY",)) -> DataFrame:
    """SRC-5: distinct curated ids (not deleted), one row per (country, id).

    ``deleted = FALSE`` in SQL three-valued logic: a NULL flag drops the row.
    """
    df = sot
    if deleted_col and deleted_col in sot.columns:
        df = df.where(F.col(deleted_col) == F.lit(False))
    return df.select(*keys, F.col(id_col).alias("MASTER_PRODUCT_ID")).distinct()


def lookup_by_ids(products: DataFrame, ids: DataFrame, on: str | list[str]) -> DataFrame:
    """SRC-4: rows whose id is in ``ids`` — a semi join, safe for 0 or 1 ids.

    The id list is never printed into SQL; AQE turns the semi join into a
    broadcast when the distinct id side turns out small at run time.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return products.join(ids.select(*keys).distinct(), on=keys, how="left_semi")
