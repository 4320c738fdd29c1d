"""A sink that stores every record once, however late it comes again and however often a batch is replayed.

State of a stream is dropped behind its watermark, so a copy that comes a year later passes it. This sink
compares with what is stored instead. Each micro-batch becomes a folder of its own and then a row of a
ledger; readers see the folders of the ledger only. A batch that fails before its row is written is written again
over its own folder; one that is in the ledger is skipped.

A batch is compared with few of the stored ones: those whose range of offsets meets its own, and of
these those whose Bloom filter has one of its keys. Filters are bitmaps in 4 kB parts, built
and probed by joins; no filter is held by the driver.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docketworks.plans.silver import drop_copies
from docketworks.schemas import BRONZE, HUB_KEY, Fields, ddl, names
from docketworks.streaming.ingest import TRIGGER, _paced

#: Every table lies in folders per writer and batch.
BATCH: Fields = (("writer", "string"), ("batch", "bigint"))
LEDGER: Fields = (("records", "bigint"), ("filter_bits", "bigint"))
RANGES: Fields = (("source_partition", "int"), ("low", "bigint"), ("high", "bigint"))
FILTERS: Fields = (("bucket", "bigint"), ("bitmap", "binary"))
#: Bits of a Bloom filter per key, and probes per key; one key in about 2,000 is taken for stored.
BITS_PER_KEY, PROBES = 16, 8
BUCKET_BITS = 32_768


def filter_bits(records: int) -> int:
    """Size of a filter: a power of two, so that there are few sizes."""
    return max(BUCKET_BITS, 1 << (BITS_PER_KEY * max(records, 1) - 1).bit_length())


def _probes(bits: Column) -> Column:
    """Places of a hub position in a filter of ``bits`` bits, as (bucket, bit)."""
    places = [F.pmod(F.xxhash64(F.lit(i), *HUB_KEY), bits) for i in range(PROBES)]
    return F.array(*[
        F.struct(F.call_function("div", p, F.lit(BUCKET_BITS)).alias("bucket"),
                 F.pmod(p, F.lit(BUCKET_BITS)).alias("bit")) for p in places
    ])


def _is_set(bitmap: Column, bit: Column) -> Column:
    """Whether a bit of a part is set; Spark's bitmaps count the bits of a byte from the lowest."""
    byte = F.substring(bitmap, F.call_function("div", bit, F.lit(8)).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.call_function("shiftright", value, F.pmod(bit, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1


class OnceSink:
    """Bronze records by hub position below ``folder``; ``writer`` tells one checkpoint from another.

    Records without a hub position cannot be told apart; they are stored whenever their batch is.
    """

    def __init__(self, spark: SparkSession, folder: str, writer: str, fmt: str = "parquet"):
        self.spark, self.folder, self.writer, self.fmt = spark, folder.rstrip("/"), writer, fmt

    # -- reading -----------------------------------------------------------------

    def _table(self, name: str, fields: Fields) -> DataFrame:
        """A table of the sink with its writer and batch; empty before the first batch."""
        whole = ddl((*fields, *BATCH))
        try:
            return self.spark.read.format(self.fmt).schema(whole).load(f"{self.folder}/{name}")
        except AnalysisException:
            return self.spark.createDataFrame([], whole)

    def ledger(self) -> DataFrame:
        return self._table("ledger", LEDGER)

    def read(self) -> DataFrame:
        """All stored records; folders that are not in the ledger are not seen."""
        listed = self.ledger().select(*names(BATCH))
        return self._table("records", BRONZE).join(listed, names(BATCH), "left_semi").select(*names(BRONZE))

    # -- writing -----------------------------------------------------------------

    def store(self, records: DataFrame, batch: int) -> None:
        """One micro-batch, to be called from ``foreachBatch``."""
        mine = (F.col("writer") == self.writer) & (F.col("batch") == batch)
        if not self.ledger().filter(mine).isEmpty():
            return
        fresh = self._new_ones(drop_copies(records))
        self._write(fresh, "records", batch)
        written = self._table("records", BRONZE).filter(mine)
        count = written.count()
        size = filter_bits(count)
        known = written.dropna(subset=list(HUB_KEY))
        partition, offset = HUB_KEY
        self._write(known.groupBy(F.col(partition).alias("source_partition")).agg(
            F.min(offset).alias("low"), F.max(offset).alias("high")), "ranges", batch)
        bits = known.select(F.explode(_probes(F.lit(size))).alias("_probe")).select("_probe.*")
        self._write(bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap")), "filters", batch)
        self.finish(batch, count, size)

    def finish(self, batch: int, records: int, size: int) -> None:
        """The row that makes a batch visible."""
        row = self.spark.createDataFrame([(records, size)], ddl(LEDGER))
        self._write(row, "ledger", batch)

    def _write(self, frame: DataFrame, name: str, batch: int) -> None:
        target = f"{self.folder}/{name}/writer={self.writer}/batch={batch}"
        frame.write.format(self.fmt).mode("overwrite").save(target)

    def _new_ones(self, records: DataFrame) -> DataFrame:
        """Records whose hub position no batch of the ledger holds."""
        near = self.near(records)
        sizes = [r[0] for r in near.select("filter_bits").distinct().collect()]  # powers of two: some dozens at most
        if not sizes:
            return records
        stored = self._table("records", BRONZE).join(self.suspects(records, near, sizes), names(BATCH), "left_semi")
        return records.join(stored.select(*HUB_KEY), list(HUB_KEY), "left_anti").select(*names(BRONZE))

    def near(self, records: DataFrame) -> DataFrame:
        """Batches of the ledger whose offsets meet those of the records, with the size of their filters."""
        partition, offset = HUB_KEY
        mine = records.groupBy(F.col(partition).alias("_partition")).agg(
            F.min(offset).alias("_low"), F.max(offset).alias("_high")
        )
        ranges = self._table("ranges", RANGES).join(self.ledger(), names(BATCH))
        meets = (F.col("source_partition") == F.col("_partition")) & (F.col("low") <= F.col("_high"))
        return ranges.join(mine, meets & (F.col("high") >= F.col("_low"))).select(
            *names(BATCH), "filter_bits"
        ).distinct()

    def suspects(self, records: DataFrame, near: DataFrame, sizes: list[int]) -> DataFrame:
        """Of the ``near`` batches those whose filter has every bit of one of the records."""
        filters = self._table("filters", FILTERS).join(near, names(BATCH))
        keys = records.select(*HUB_KEY).dropna().withColumn(
            "filter_bits", F.explode(F.array(*[F.lit(size).cast("bigint") for size in sizes]))
        )
        probes = keys.withColumn("_probe", F.explode(_probes(F.col("filter_bits")))).select(
            *HUB_KEY, "filter_bits", "_probe.*"
        )
        hits = probes.join(filters, ["filter_bits", "bucket"]).filter(_is_set(F.col("bitmap"), F.col("bit")))
        whole = hits.groupBy(*HUB_KEY, *names(BATCH)).agg(F.count(F.lit(1)).alias("_hits"))
        return whole.filter(F.col("_hits") == PROBES).select(*names(BATCH)).distinct()


def start_once(
    stream: DataFrame, folder: str, checkpoint: str, every: str | None = TRIGGER, fmt: str = "parquet"
) -> StreamingQuery:
    """Store a bronze stream through ``OnceSink``; a new checkpoint is another writer.

    The id of the query, which its checkpoint keeps, names the writer: with a new checkpoint batches are
    numbered from 0 again, and must not be taken for those of the old one.
    """
    spark = stream.sparkSession
    query: list[str] = []

    def store(records: DataFrame, batch: int) -> None:
        if not query:  # written before the first batch begins
            found = spark.read.json(f"{checkpoint}/metadata").select("id").first()
            query.append(found["id"])
        OnceSink(spark, folder, query[0], fmt).store(records, batch)

    return _paced(stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint), every).start()
