"""Table registry over a directory of parquet files.

Every read goes through ``spark.read.parquet`` so Catalyst sees the scan and
can push filters and prune columns into it.  Only the inferred schema is kept,
for as long as the path's files (names, sizes, times) stay the same; no data is
cached: a plan that reuses a table twice reads it twice unless the caller
decides otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# (files of the path, schema) by path.
_SCHEMAS: dict = {}


def files_of(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and modification times of a path's files, as its file system lists them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(at)
    return tuple((str(f.getPath()), f.getLen(), f.getModificationTime()) for f in found)


class Tables:
    """Lazy accessor: ``t = Tables(spark, sf_dir); t.lineitem``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def get(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise KeyError(f"unknown table {name!r}")
        path = self.path(name)
        files = files_of(self.spark, path)
        known, schema = _SCHEMAS.get(path, (None, None))
        if known != files:
            df = self.spark.read.parquet(path)
            _SCHEMAS[path] = (files, df.schema)
            return df
        # Known schema: no footer read to infer it again.  Each call is still
        # a new relation, so a table may appear twice in one plan.
        return self.spark.read.schema(schema).parquet(path)

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.get(name)
        raise AttributeError(name)

    def register_views(self, names=TABLE_NAMES) -> None:
        for n in names:
            self.get(n).createOrReplaceTempView(n)


def load(spark: SparkSession, root: str) -> Tables:
    return Tables(spark, root)
