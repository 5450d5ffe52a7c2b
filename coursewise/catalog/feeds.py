"""JSON feed ingest F1-F23, the JSON field rules C5-C8, and the feed as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import sinks as SK
from ..session import scratch_path
from ..sources import feeds as FD
from ..sources import ods
from ..streaming import feed_stream as FS
from .base import register


def _feed_query(feed: str):
    return lambda spark, sf: FD.ingest(ods.ods_lines(spark, sf, feed), FD.FEEDS[feed])


for _feed, _spec in FD.FEEDS.items():
    register(f"feed_{_spec.target[len('dwd_'):]}", ods.expected_sql(_feed))(_feed_query(_feed))


def _each_feed(build):
    """``build(lines, spec)`` of every feed, with the feed's name."""
    def run(spark, sf):
        out = None
        for feed, spec in FD.FEEDS.items():
            one = build(ods.ods_lines(spark, sf, feed), spec).select(F.lit(feed).alias("feed"), "*")
            out = one if out is None else out.unionByName(one)
        return out
    return run


register("json_object_filter", "\nUNION ALL\n".join(ods.line_counts_sql(f) for f in FD.FEEDS))(
    _each_feed(lambda lines, spec: FD.object_line_counts(lines)))
register("feed_rejects", "\nUNION ALL\n".join(f"SELECT '{f}' AS feed, * FROM ({ods.rejects_sql(f)}) t" for f in FD.FEEDS))(
    _each_feed(FD.rejects))


def _feed_columns(feed: str, cols):
    # the ingest projected to a few columns; Catalyst prunes the other lookups
    return lambda spark, sf: FD.ingest(ods.ods_lines(spark, sf, feed), FD.FEEDS[feed]).select(*cols)


for _name, _feed, _cols in (
        ("json_int_default", "QzQuestion", ("questionid", "parentid", "questypeid", "optnum")),
        ("json_string", "QzQuestion", ("questionid", "content", "answer", "creator", "dt", "dn")),
        ("json_decimal_half_up", "QzPoint", ("pointid", "score")),
        ("json_decimal_default_zero", "QzQuestion", ("questionid", "score", "splitscore"))):
    register(_name, f"SELECT {', '.join(_cols)} FROM ({ods.expected_sql(_feed)}) t")(_feed_columns(_feed, _cols))


def _feed_stream(spark, sf):
    feed = "QzMemberPaperQuestion"
    landing = SK.write_lines(ods.ods_lines(spark, sf, feed), scratch_path(spark, "landing"), packed=True)
    target, ckpt = scratch_path(spark, "dwd_stream"), scratch_path(spark, "ckpt")
    q = FS.start_feed_ingest(spark, feed, landing, target, ckpt)
    q.awaitTermination()
    spec = FD.FEEDS[feed]
    return SK.read_table(spark, target, spec.partition).select(*[c.name for c in spec.cols])


register("feed_stream_ingest", ods.expected_sql("QzMemberPaperQuestion"))(_feed_stream)
