"""Sources of transaction events: Parquet as batch or stream, and Kafka with schema-registry Avro."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import CONTRACT, CONTRACT_DEFAULTS, conform_to_contract

# Fixed value: a registry message starts with one magic byte and a four-byte schema id.
WIRE_HEADER_BYTES = 5


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Batch scan of raw events. Reads with the declared schema, so nothing is inferred."""
    return spark.read.schema(CONTRACT).parquet(path)


def load_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Batch scan of files written under another version of the contract: their own schema, conformed."""
    return conform_to_contract(spark.read.parquet(path))


def read_transactions_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Streaming scan of raw events. New files arrive in micro-batches of at most ``max_files``."""
    reader = spark.readStream.schema(CONTRACT)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def avro_contract(schema: T.StructType = CONTRACT, name: str = "TransactionEvent") -> str:
    """The Avro reader schema of the contract, derived from the Spark schema."""
    plain = {T.StringType: "string", T.LongType: "long", T.BooleanType: "boolean", T.IntegerType: "int"}

    def avro_type(kind: T.DataType):
        if isinstance(kind, T.DecimalType):
            return {
                "type": "bytes",
                "logicalType": "decimal",
                "precision": kind.precision,
                "scale": kind.scale,
            }
        return plain[type(kind)]

    fields = []
    for f in schema:
        entry = {"name": f.name, "type": avro_type(f.dataType)}
        if f.name in CONTRACT_DEFAULTS:
            entry["default"] = CONTRACT_DEFAULTS[f.name]
        fields.append(entry)
    return json.dumps({"type": "record", "name": name, "fields": fields})


def registry_payload(value: Column) -> Column:
    """The Avro bytes of a registry message, without the wire header."""
    return F.substring(value, WIRE_HEADER_BYTES + 1, 2**31 - 1)


def schema_id(value: Column) -> Column:
    """The id of the schema a registry message was written with: four bytes after the magic one."""
    return F.conv(F.hex(F.substring(value, 2, WIRE_HEADER_BYTES - 1)), 16, 10).cast("long")


def events_by_schema(
    messages: DataFrame, schemas: Mapping[int, str], decode: Callable[[Column, str], Column], value: str = "value"
) -> DataFrame:
    """Events of registry messages, each decoded with the schema it was written with, in contract order.

    ``schemas`` holds the writers' schemas by id, ``decode`` turns a payload into a struct. Every
    struct is brought to the contract under the append-only rule; columns that only some writers
    know are left out. Messages are read once. A message whose schema is not listed fails the job, so that
    nothing is lost or misread.
    """
    if not schemas:
        raise ValueError("at least one writer schema is required")
    payload, number = registry_payload(F.col(value)), schema_id(F.col(value))
    event = F.lit(None)
    known = F.lit(False)
    for schema_number, schema in sorted(schemas.items()):
        decoded = decode(payload, schema)
        told = messages.select(decoded.alias("event")).select("event.*")
        conform_to_contract(told)  # refuses a changed type, from the schema alone
        columns = [
            (decoded[f.name] if f.name in told.columns else F.lit(CONTRACT_DEFAULTS.get(f.name))).cast(f.dataType).alias(f.name)
            for f in CONTRACT
        ]
        event = F.when(number == schema_number, F.struct(*columns)).otherwise(event)
        known = known | (number == schema_number)
    unknown = F.concat(F.lit("no writer schema with the id "), F.coalesce(number.cast("string"), F.lit("of a message without header")))
    checked = F.when(F.coalesce(known, F.lit(False)), event).otherwise(F.raise_error(unknown).cast(CONTRACT))
    return messages.select(checked.alias("event")).select("event.*")


def read_transactions_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    avro_schema: str | None = None,
    starting_offsets: str = "earliest",
    max_offsets: int | None = None,
    options: dict[str, str] | None = None,
    writer_schemas: Mapping[int, str] | None = None,
) -> DataFrame:
    """Streaming scan of a Kafka topic. Needs the spark-sql-kafka and spark-avro packages on the cluster.

    With ``writer_schemas`` (Avro JSON by registry id) each message is decoded with its writer's schema;
    otherwise all with ``avro_schema``, by default the contract's. ``starting_offsets`` counts for the first start only; later starts resume from the query's
    checkpoint.
    """
    try:
        from pyspark.sql.avro.functions import from_avro
    except ImportError as exc:  # pragma: no cover - depends on the installation
        raise RuntimeError("reading Avro needs the spark-avro package") from exc
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**(options or {}))
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    if writer_schemas:
        return events_by_schema(reader.load(), writer_schemas, from_avro)
    event = from_avro(registry_payload(F.col("value")), avro_schema or avro_contract())
    return conform_to_contract(reader.load().select(event.alias("event")).select("event.*"))
