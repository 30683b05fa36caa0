"""Message broker source.

``broker_messages`` is the whole transform and takes any DataFrame with the
broker's record columns (body, partition, sequenceNumber, offset), streaming
or not; ``read_kafka`` maps a Kafka stream onto those columns when the Kafka
connector is on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions.hl7 import is_valid

# Fixed value: events per trigger of the upstream broker reader.
MAX_EVENTS_PER_TRIGGER = 10000


def broker_messages(records: DataFrame, keep_rejects: bool = True) -> DataFrame:
    """Body -> text, message name ``partition-sequenceNumber-offset``, and a column
    ``valid``; rejects are left out only without ``keep_rejects``."""
    text = F.col("body").cast("string")
    nm = F.concat_ws("-", F.col("partition").cast("string"), F.col("sequenceNumber").cast("string"),
                     F.col("offset").cast("string"))
    out = records.select(text.alias("text"), nm.alias("msg_nm"))
    if keep_rejects:
        return out.withColumn("valid", is_valid(F.col("text")))
    return out.where(is_valid(F.col("text")))


def read_kafka(spark: SparkSession, servers: str, topic: str, max_offsets: int = MAX_EVENTS_PER_TRIGGER,
               options: dict | None = None) -> DataFrame:
    """Kafka records renamed to the broker columns (Kafka has no sequence number: NULL)."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic) \
        .option("maxOffsetsPerTrigger", max_offsets).options(**(options or {})).load()
    return raw.select(F.col("value").alias("body"), F.col("partition"),
                      F.lit(None).cast("bigint").alias("sequenceNumber"), F.col("offset"))
