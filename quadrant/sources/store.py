"""The quad store as a written table, and a store that is changed in place.

Graph-pattern queries self-join the quad set many times (one scan per triple
pattern). The store is a Parquet table partitioned by predicate and bucketed by
subject: a pattern's `p = ...` filter becomes partition pruning (only that
predicate's files are listed and opened, however large the store), and patterns
that share a subject (star joins) join bucket by bucket, without a shuffle.
Writing it also cuts the lineage of whatever derived the quads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrant.functions import constants as K
from quadrant.session import work_dir, written

QUAD_COLUMNS = ["s", "p", "o", "g", "o_kind", "o_datatype", "o_lang"]

# bytes of planned input of one bucket: one task sorts a bucket when it is written, and joins it with its neighbours'
BUCKET_BYTES = 1 << 26

_stored: dict[tuple[str, str], str] = {}


def bucket_count(spark: SparkSession, quads: DataFrame) -> int:
    """Buckets by the planner's size of what is stored: at least as many as there are
    cores or shuffle partitions that input fills, at most what Spark allows."""
    size = int(str(quads._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return max(1, min(most, max(spark.sparkContext.defaultParallelism, -(-size // BUCKET_BYTES))))


def store_quads(spark: SparkSession, quads: DataFrame, name: str, distinct: bool = False, buckets: int | None = None) -> str:
    """Write a quad set to the shared folder, partitioned by p and bucketed by s, and
    return the name of its table. `distinct`: repeats are removed on the way, by the one
    shuffle on s that places the rows."""
    path, n = work_dir(spark, name), buckets or bucket_count(spark, quads)
    placed = quads.select(QUAD_COLUMNS).repartition(n, "s")
    table = f"quadrant_{path.rstrip('/').rsplit('/', 1)[1].replace('-', '_')}"
    ((placed.dropDuplicates() if distinct else placed)
        .write.mode("overwrite").partitionBy("p").bucketBy(n, "s").sortBy("s")
        .option("path", path).saveAsTable(table))
    return table


def read_store(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).select(QUAD_COLUMNS)


def catalog_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue quad table for sf_dir, written once per application."""
    from quadrant.sources.fixtures import catalog_quads
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        _stored[key] = store_quads(spark, catalog_quads(spark, sf_dir), "catalog-quads", distinct=True)
    return read_store(spark, _stored[key])


def transcript_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transcript quad table (X4 over every transcript), written once per
    application: delete / replace / export read it like the real store."""
    from quadrant.operators.quads import segments_to_quads
    from quadrant.sources.fixtures import seg
    key = (spark.sparkContext.applicationId, sf_dir + "#transcripts")
    if key not in _stored:
        _stored[key] = store_quads(spark, segments_to_quads(seg(spark, sf_dir)), "transcript-quads")
    return read_store(spark, _stored[key])


class GraphStore:
    """A quad store that is changed in place, media by media.

    Quads lie in hash buckets of their graph's root, which is the graph's IRI without
    the segment that ends it: a layer and its segment graphs share a bucket. An index,
    in hash buckets of the media, names the ASR layers of each media. Deleting or
    replacing transcriptions reads the index buckets of these media, reads and
    rewrites the quad buckets of their layers, and touches no other file.

    A bucket is a partition folder: its new rows are written beside it first and
    then replace it. One writer at a time; a run that died is repeated whole, with
    the same result, since quads are a set.
    """

    SCHEMA = "s string, p string, o string, g string, o_kind string, o_datatype string, o_lang string, bucket int"

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.n = spark, path, buckets

    def bucket(self, root: Column) -> Column:
        return F.pmod(F.xxhash64(root), F.lit(self.n)).cast("int")

    def root(self, g: Column) -> Column:
        return F.regexp_replace(g, f"{K.SEGMENT_URI_INFIX}[^/]*$", "")

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/quads")

    def index(self) -> DataFrame:
        return self.spark.read.schema("media string, layer string, bucket int").parquet(f"{self.path}/layers")

    def _put(self, rows: DataFrame, name: str) -> None:
        (rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("bucket").parquet(f"{self.path}/{name}"))

    def _placed(self, quads: DataFrame) -> DataFrame:
        return quads.select(QUAD_COLUMNS).withColumn("bucket", self.bucket(self.root(F.col("g"))))

    @staticmethod
    def layers(quads: DataFrame) -> DataFrame:
        """(media, layer) of the ASR layers among quads."""
        asr = quads.where((F.col("p") == K.RDF_TYPE) & (F.col("o") == K.CORE_ASR_LAYER)).select(F.col("s").alias("layer"))
        return quads.where(F.col("p") == K.CORE_DOCUMENT).select(F.col("o").alias("media"), F.col("s").alias("layer")).join(asr, "layer", "left_semi").distinct()

    def create(self, quads: DataFrame) -> GraphStore:
        """Write a quad set as a new store."""
        self._put(self._placed(quads), "quads")
        self._put(self.layers(quads).withColumn("bucket", self.bucket(F.col("media"))), "layers")
        return self

    def _numbers(self, rows: DataFrame) -> list[int]:
        """Distinct buckets: as many as the store has at most."""
        return sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())

    def replace(self, media: DataFrame, new_quads: DataFrame | None = None, media_col: str = "media") -> dict[str, list[int]]:
        """Drop the transcriptions of `media`, then add new quads, if any. Returns
        the buckets that were rewritten."""
        wanted = written(media.select(F.col(media_col).alias("media")).distinct().withColumn("bucket", self.bucket(F.col("media"))), "replaced-media")
        fresh = None if new_quads is None else written(self._placed(new_quads).dropDuplicates(), "replacing-quads")
        added = None if fresh is None else written(self.layers(fresh).withColumn("bucket", self.bucket(F.col("media"))), "replacing-layers")
        in_index = sorted({*self._numbers(wanted), *(self._numbers(added) if added is not None else [])})
        known = self.index().where(F.col("bucket").isin(in_index))
        doomed = written(known.join(wanted, ["media", "bucket"], "left_semi").select("layer").withColumn("bucket", self.bucket(self.root(F.col("layer")))), "doomed-layers")
        in_quads = sorted({*self._numbers(doomed), *(self._numbers(fresh) if fresh is not None else [])})
        old = self.read().where(F.col("bucket").isin(in_quads))
        segments = old.where(F.col("p") == K.CORE_SEGMENT).join(doomed.select(F.col("layer").alias("s")), "s", "left_semi").select(F.col("o").alias("g"))
        gone = segments.union(doomed.select(F.col("layer").alias("g"))).distinct()
        kept = old.join(gone, "g", "left_anti").select(*QUAD_COLUMNS, "bucket")
        left = known.join(wanted, ["media", "bucket"], "left_anti").select("media", "layer", "bucket")
        if fresh is not None:
            kept, left = kept.unionByName(fresh).dropDuplicates(), left.unionByName(added.select("media", "layer", "bucket")).distinct()
        self._swap(kept, "quads", in_quads)
        self._swap(left, "layers", in_index)
        return {"quads": in_quads, "layers": in_index}

    def delete(self, media: DataFrame, media_col: str = "media") -> dict[str, list[int]]:
        return self.replace(media, None, media_col)

    def _swap(self, rows: DataFrame, name: str, buckets: list[int]) -> None:
        """Replace these buckets; one that has no rows left goes."""
        rows = written(rows, f"new-{name}")
        filled = self._numbers(rows)
        if filled:
            self._put(rows, name)
        sc = self.spark.sparkContext
        for b in sorted(set(buckets) - set(filled)):
            place = sc._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/bucket={b}")
            place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)
