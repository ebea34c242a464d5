"""Typed inputs."""

from pyspark.sql import functions as F

from ..schemas import ENTITY, SEED_ENTITIES


def conform(frame, schema):
    """Select the schema's columns with the schema's types."""
    return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def load_table(spark, path, schema):
    """Read a parquet table with a declared schema; no inference pass."""
    return spark.read.schema(schema).parquet(path)


def seed_entities(spark, rest=None):
    """The seed entities with ids 1 to 11; ``rest`` gets ids after them.

    ``rest`` has the entity columns without an id. Its source keys are unique and not
    negative, so the key itself, moved behind the seeds, serves as the id: ids keep the
    order of the keys, whatever order or tasks the rows are in.
    """
    fields = ENTITY.names
    rows = [(i, *row) for i, row in enumerate(SEED_ENTITIES, start=1)]
    seeds = spark.createDataFrame(rows, ENTITY)
    if rest is None:
        return seeds
    keyed = rest.select((F.col("source_key") + len(rows) + 1).alias("entity_id"), *fields[1:])
    return seeds.unionByName(conform(keyed, ENTITY))
