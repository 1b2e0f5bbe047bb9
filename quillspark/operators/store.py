"""The chunk store: bucketed Parquet files under a manifest.

A table's rows lie in BUCKETS folders by the hash of their key, and a manifest names the folder of each
bucket. A change writes new folders for the buckets it touches and then a new manifest, which
appears by one rename; until then, and if the job is lost before it, the old manifest and its files are the table.
Arrays stay arrays.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillspark.session import written

EMBED_FORMAT = 4


def last_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the last by ``order``."""
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def upserted(stored: DataFrame, new: DataFrame, key: str = "chunk_id") -> DataFrame:
    """The stored rows without those that ``new`` replaces, and the new ones."""
    return stored.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def without_documents(stored: DataFrame, doc_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that stay, one row with the number of deleted rows)."""
    ids = doc_ids.select("doc_id").distinct()
    return stored.join(ids, "doc_id", "left_anti"), stored.join(ids, "doc_id", "left_semi").agg(F.count("*").alias("n_deleted"))


#: folders that a table's rows are spread over
BUCKETS = 64


class ChunkStore:
    """Tables ``chunks``, ``vectors`` and ``provenance`` under one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ---- manifests ----

    def _versions(self, table: str) -> list[int]:
        """The numbers of the manifests, ascending."""
        place = self._path(f"{self.folder}/{table}")
        if not self._fs.exists(place):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(place)]
        return sorted(int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json"))

    def _manifest(self, table: str, version: int | None = None) -> dict | None:
        """{'schema': .., 'buckets': {bucket: folder}} of the newest or a given version."""
        versions = self._versions(table)
        if not versions:
            return None
        stream = self._fs.open(self._path(f"{self.folder}/{table}/manifest-{version or versions[-1]:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, table: str, manifest: dict) -> None:
        version = (self._versions(table) or [0])[-1] + 1
        staged = self._path(f"{self.folder}/{table}/.staged-{uuid.uuid4().hex}")
        stream = self._fs.create(staged, True)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        if not self._fs.rename(staged, self._path(f"{self.folder}/{table}/manifest-{version:012d}.json")):
            raise RuntimeError(f"another job has changed {table}")
        self._clear(table)

    def _clear(self, table: str) -> None:
        """Takes away what neither the newest manifest nor the one before names, so readers of that one go on."""
        *old, _, _ = [None, None, *self._versions(table)]
        for version in filter(None, old):
            self._fs.delete(self._path(f"{self.folder}/{table}/manifest-{version:012d}.json"), False)
        named = {f.rsplit("/", 1)[0] for v in self._versions(table) for f in self._manifest(table, v)["buckets"].values()}
        data = self._path(f"{self.folder}/{table}/data")
        for f in self._fs.listStatus(data) if self._fs.exists(data) else []:
            if f"data/{f.getPath().getName()}" not in named:
                self._fs.delete(f.getPath(), True)

    # ---- rows ----

    def _rows(self, table: str, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        places = [f"{self.folder}/{table}/{f}" for b, f in manifest["buckets"].items() if buckets is None or int(b) in buckets]
        return self.spark.read.schema(schema).parquet(*places) if places else self.spark.createDataFrame([], schema)

    def read(self, table: str = "chunks") -> DataFrame | None:
        manifest = self._manifest(table)
        return None if manifest is None else self._rows(table, manifest)

    def _write(self, table: str, rows: DataFrame, key: str, kept: dict[str, str]) -> None:
        """``rows`` as new folders; ``kept`` names the folders of the buckets that are not touched."""
        version = f"data/{uuid.uuid4().hex}"
        place = f"{self.folder}/{table}/{version}"
        rows.withColumn("_bucket", _bucket(key)).repartition("_bucket", F.pmod(F.xxhash64(key), F.lit(self.spark.sparkContext.defaultParallelism))).write.partitionBy("_bucket").parquet(place)
        made = [f.getPath().getName() for f in self._fs.listStatus(self._path(place))]
        buckets = {n.split("=")[1]: f"{version}/{n}" for n in made if n.startswith("_bucket=")}
        self._commit(table, {"schema": rows.schema.jsonValue(), "buckets": kept | buckets})

    def replace(self, rows: DataFrame, table: str = "chunks", key: str = "chunk_id") -> None:
        self._write(table, rows, key, {})

    def upsert(self, rows: DataFrame, table: str = "chunks", key: str = "chunk_id") -> None:
        """Puts ``rows`` over the stored ones of equal keys; only the buckets of their keys are written anew."""
        manifest = self._manifest(table)
        if manifest is None:
            return self.replace(rows, table, key)
        touched = self._touched(rows, key)
        if touched:
            kept = {b: f for b, f in manifest["buckets"].items() if int(b) not in touched}
            self._write(table, upserted(self._rows(table, manifest, touched), rows, key), key, kept)

    def _touched(self, rows: DataFrame, key: str) -> list[int]:
        return [r[0] for r in rows.select(_bucket(key)).distinct().collect()]  # at most BUCKETS

    def delete(self, doc_ids: DataFrame | list[str], table: str = "chunks", key: str = "chunk_id") -> int:
        """Takes the rows of the documents out and returns how many there were."""
        manifest = self._manifest(table)
        if manifest is None:
            return 0
        stored = self._rows(table, manifest)
        if not isinstance(doc_ids, DataFrame):
            doc_ids = self.spark.createDataFrame([(d,) for d in doc_ids], f"doc_id {dict(stored.dtypes)['doc_id']}")
        gone = written(stored.join(doc_ids.select(F.col("doc_id").cast(stored.schema["doc_id"].dataType)).distinct(), "doc_id", "left_semi").select(key))
        self.delete_keys(gone, table, key)
        return gone.count()

    def delete_keys(self, gone: DataFrame, table: str = "chunks", key: str = "chunk_id") -> None:
        manifest, touched = self._manifest(table), self._touched(gone, key)
        if manifest is not None and touched:
            kept = {b: f for b, f in manifest["buckets"].items() if int(b) not in touched}
            self._write(table, self._rows(table, manifest, touched).join(gone, key, "left_anti"), key, kept)

    def reset(self) -> None:
        for table in ("chunks", "vectors", "provenance"):
            self._fs.delete(self._path(f"{self.folder}/{table}"), True)

    def count(self, table: str = "chunks") -> int:
        rows = self.read(table)
        return 0 if rows is None else rows.count()

    def write_provenance(self, provider: str, model: str, dimension: int, embed_format: int = EMBED_FORMAT) -> None:
        row = self.spark.createDataFrame([(provider, model, dimension, embed_format)], "provider string, model string, dimension int, embed_format int")
        self.replace(row, "provenance", "provider")

    def provenance(self) -> dict:
        rows = self.read("provenance")
        return {} if rows is None else rows.first().asDict()


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")
