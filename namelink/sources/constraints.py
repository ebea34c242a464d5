"""Not-null, primary-key and foreign-key rules of the entity tables."""

from pyspark.sql import functions as F

from ..schemas import ENTITY, ENTITY_INDEX


def _null_counts(frame, table, schema):
    required = [f.name for f in schema if not f.nullable]
    counts = frame.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    named = [F.struct(F.lit(f"{table}.{c} not null").alias("rule"),
                      F.col(c).alias("violations")) for c in required]
    return counts.select(F.inline(F.array(*named)))


def _duplicate_keys(frame, table, key):
    repeated = frame.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(f"{table} primary key").alias("rule"), "violations"
    )


def _orphans(child, parent, key, rule):
    # counted per key first: an id repeated in the child is looked up once
    counted = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    missing = counted.join(parent, key, "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
        F.lit(rule).alias("rule"), "violations"
    )


def check_constraints(entities, index):
    """One row per rule with its number of violations."""
    reports = [
        _null_counts(entities, "entity", ENTITY),
        _duplicate_keys(entities, "entity", ["entity_id"]),
        _null_counts(index, "entity_index", ENTITY_INDEX),
        _duplicate_keys(index, "entity_index", ENTITY_INDEX.names),
        _orphans(index, entities, "entity_id", "entity_index.entity_id references entity"),
    ]
    report = reports[0]
    for other in reports[1:]:
        report = report.unionByName(other)
    return report
