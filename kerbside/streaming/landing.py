"""Land files that arrived since the last run, each exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kerbside.fixed_values import RAW_FILE_TEMPLATE
from kerbside.sinks.manifest import land
from kerbside.sources.csv import read_csv
from kerbside.sources.monthly import MONTH_PARTITIONS, file_month, with_month_partitions

# What a stream of file names is read as; the content is never asked for.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def land_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    dest: str,
    checkpoint: str,
    template: str = RAW_FILE_TEMPLATE,
    files_per_batch: int = 1000,
    strict: bool = True,
) -> None:
    """Add the rows of unseen CSV files to ``dest``, by file month; ``read_landed`` reads them.

    The stream is one of file names. Each batch of files is read as ``ingest_months`` reads its own:
    columns by each file's header, in any order; a declared column that a header lacks, and a value
    that does not parse, fail the run (``strict`` off: values become NULL). A month's rows of a batch
    are gathered into few files, and a batch becomes visible in one step.

    The checkpoint remembers the files taken, and the manifest of ``dest`` the checkpoint's last
    batch: a run without new files adds nothing, a run that died is resumed, and a batch that is
    played again adds nothing. Stateless: no watermark is needed.
    """
    def land_batch(batch: DataFrame, number: int) -> None:
        # Names of at most ``files_per_batch`` files.
        names = [row.path for row in batch.select("path").collect()]
        if names:
            rows = read_csv(spark, names, schema, strict, also={"file_month": file_month(template)})
            land(with_month_partitions(rows), dest, MONTH_PARTITIONS, batch=(checkpoint, number))

    (
        spark.readStream.format("binaryFile").schema(_FILES)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source).select("path")
        .writeStream.foreachBatch(land_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
