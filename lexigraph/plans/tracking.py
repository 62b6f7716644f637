"""The work-tracking job from images to the gallery."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions import text
from ..operators import imaging, tracking as ops
from ..session import scratch_dir
from ..sinks.writers import materialise


@dataclass
class Tracked:
    thumbnails: DataFrame
    replies: DataFrame
    matched: DataFrame
    progress: DataFrame
    summary: DataFrame
    gallery: DataFrame


def track_images(
    jobs: DataFrame, images: DataFrame, worker: str, thumb_base: str, box: int = imaging.BOX
) -> Tracked:
    """Thumbnails of ``images`` (the image schema, ``seq``), a worker's replies, the jobs they
    are credited to, and the jobs' summaries and pages.

    Thumbnails are made once, into the scratch folder, since pixels and replies both read
    them; all else is one lazy plan over that table.
    """
    made = imaging.thumbnails(images, box, keep=["seq"])
    thumbs = materialise(made, scratch_dir(images.sparkSession, "thumbnails"))
    name = text.numbered_thumb(F.lit(worker), F.col("seq"))
    done = thumbs.select(
        F.concat_ws("-", F.lit(worker), F.col("seq").cast("string")).alias("msg_id"), "seq",
        F.current_timestamp().alias("ts"), F.lit(None).cast("string").alias("job_id"),
        F.col("origin").alias("item"), F.col("status"), F.when(F.col("status") == ops.OK, name).alias("result"),
    )
    replies = ops.to_replies(done, worker)
    results = ops.parse_results(replies)
    matched = ops.match_results(jobs, results)
    summary = ops.summary_lines(jobs, matched)
    return Tracked(
        thumbs, replies, matched, ops.job_progress(jobs, matched), summary, ops.gallery_html(summary, thumb_base)
    )
