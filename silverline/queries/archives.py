"""Page archives: written, split, and followed while they grow."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverline.queries.registry import query
from silverline.sources import archive
from silverline.sources.shared import fresh_path
from silverline.streaming import loads

_PAGES = "SELECT page_id, url, html FROM pages"


@query("page_archive_round_trip", _PAGES)
def _(d):
    path = fresh_path(d.spark, "archive")
    archive.register(d.spark)
    d.pages.select("page_id", "url", "html").write.format(archive.FORMAT).mode("append").save(path)
    return d.spark.read.format(archive.FORMAT).option("split_bytes", 1 << 20).load(path)


@query("page_archive_stream", _PAGES)
def _(d):
    """Two runs of one stream; the second reads only what the first did not."""
    path, target, log = (fresh_path(d.spark, n) for n in ("archive", "pages", "pages-log"))
    archive.register(d.spark)
    pages = d.pages.select("page_id", "url", "html")
    for part in (F.col("page_id") % 3 == 0, F.col("page_id") % 3 != 0):
        pages.filter(part).write.format(archive.FORMAT).mode("append").save(path)
        source = d.spark.readStream.format(archive.FORMAT).load(path)
        loads.incremental_append(source, target, log).awaitTermination()
    return d.spark.read.schema(pages.schema).parquet(target)
