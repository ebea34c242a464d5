"""The folder that all executors share, and frames written there to cut their lineage."""

import tempfile
import uuid


def shared_folder(spark):
    """The folder named by spark.checkpoint.dir; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    folder = tempfile.mkdtemp(prefix="namelink-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark, name):
    """A folder under the shared one that nobody else gets."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def durable(frame):
    """Cut lineage with a checkpoint on shared storage; it outlives lost executors."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint(eager=True)
