"""Shared folder, staged tables and small helpers of the corpus operators."""

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import functions as F

#: Characters that end a word where words are runs of anything else.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def shared_folder(spark):
    """The folder of spark.checkpoint.dir, which all executors share.

    Where it is unset, as in tests, a local session gets a temporary folder of its own;
    any other session is refused, since executors would not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="corpus-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark, name):
    """A path for one run's files under the shared folder, never used before."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(frame, name):
    """Write ``frame`` as Parquet to the shared folder and read it back.

    Cuts the lineage: what follows neither repeats the work nor depends on the executors
    that did it.
    """
    path = new_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def text_rows(frame, key="doc_id", text="text"):
    """Key and text only, the text never null: other columns cannot clash with ours."""
    return frame.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text), F.lit("")).alias(text))


def filesystem(path):
    """The file system of a URI or path and the path in it, for code inside tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path)


#: Bits of a filter on keys: 2**26 bits are 8 MB however many keys there are.
FILTER_BITS = 1 << 26


def key_filter(keys, key):
    """Bitmaps of a set of long keys, at most FILTER_BITS / 8 bytes whatever its size.

    A bit may stand for other keys too: the filter lets through every key of the set and
    some others, so what passes still needs the exact join.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    return keys.select(
        F.bitmap_bucket_number(slot).alias("_bucket"), F.bitmap_bit_position(slot).alias("_bit")
    ).groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits"))


def let_through(frame, key, bitmaps):
    """Rows of ``frame`` whose key the filter knows; nothing is shuffled."""
    slot = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    bit = F.bitmap_bit_position(slot)
    tested = frame.withColumn("_bucket", F.bitmap_bucket_number(slot)).withColumn("_bit", bit).join(
        F.broadcast(bitmaps), "_bucket"
    )
    byte = F.conv(F.hex(F.substring("_bits", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    mask = F.pow(F.lit(2), F.col("_bit") % 8).cast("int")
    return tested.filter(byte.bitwiseAND(mask) != 0).drop("_bucket", "_bit", "_bits")


def pieces(batches, rows=512):
    """Arrow batches in pieces of few rows, so that few texts at a time become Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


_SHIPPED = set()


def ship_package(spark):
    """Give the Python workers this package, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="py-files-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
