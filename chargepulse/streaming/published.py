"""Which batches of an output folder count.

A batch writes several tables one after another.  It counts when its marker ``root/_published/<batch>`` is there,
written after the last of them, so a reader sees all of a batch or nothing.  What may be folded away
is told by Spark's own commit log in the checkpoint that owns the folder: a committed batch never runs again.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from chargepulse import storage


def claim_output(spark: SparkSession, root: str, checkpoint: str) -> None:
    """Bind an output folder to one checkpoint.

    Outputs are keyed by ``batch_id``, which starts again at 0 under a new
    checkpoint; a second checkpoint writing into the same folder would overwrite
    the first one's batches.  The first query records its checkpoint in
    ``root/_owner``; a query with another checkpoint is refused.
    """
    want = checkpoint.rstrip("/")
    have = owner(spark, root)
    if have is None:
        storage.write_text(spark, f"{root.rstrip('/')}/_owner", want)
    elif have != want:
        raise ValueError(f"{root} belongs to checkpoint {have}, not {want}")


def owner(spark: SparkSession, root: str) -> str | None:
    """The checkpoint that a folder belongs to."""
    path = f"{root.rstrip('/')}/_owner"
    return storage.read_text(spark, path).strip() if storage.exists(spark, path) else None


def _newest(names: list[str]) -> int:
    return max((int(n) for n in names if n.isdigit()), default=-1)


def newest_commit(spark: SparkSession, checkpoint: str) -> int:
    """The newest batch that Spark has committed, -1 if there is none."""
    return _newest(storage.children(spark, f"{checkpoint.rstrip('/')}/commits"))


def newest_published(spark: SparkSession, root: str) -> int | None:
    """The newest batch that counts, -1 if there is none; None for a folder that no query owns, where all count."""
    names = storage.children(spark, f"{root.rstrip('/')}/_published")
    return None if not names and owner(spark, root) is None else _newest(names)


def publish(spark: SparkSession, root: str, batch_id: int) -> None:
    """Let a batch count.  Batches follow each other, so only the newest marker matters; older ones go."""
    path = f"{root.rstrip('/')}/_published"
    storage.write_text(spark, f"{path}/{batch_id}", "")
    storage.delete(spark, f"{path}/{batch_id - 2}")


def foldable(spark: SparkSession, root: str, upto: int | None = None) -> int:
    """The newest batch that may be folded: committed, published, and not beyond ``upto`` if that is given."""
    checkpoint = owner(spark, root)
    if checkpoint is None:
        if upto is None:
            raise ValueError(f"{root} belongs to no checkpoint; say up to which batch")
        return upto
    last = min(newest_commit(spark, checkpoint), newest_published(spark, root))
    return last if upto is None else min(upto, last)
