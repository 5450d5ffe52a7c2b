"""The feed ingest as an incremental (availableNow) stream: exactly-once over restarts."""

import pytest
from coursewise.plans import sinks as S
from coursewise.session import scratch_path
from coursewise.sources import feeds as FD
from coursewise.streaming import feed_stream as FS


def write_batch(spark, landing, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
        .write.mode("append").text(landing)


def test_stream_picks_up_only_new_files(spark):
    landing, target, ckpt = (scratch_path(spark, n) for n in ("landing", "target", "ckpt"))
    mk = lambda i: f'{{"userid": {i}, "score": 0.25, "dt": "20190722", "dn": "w"}}'
    write_batch(spark, landing, [mk(1), mk(2), "garbage"])
    FS.start_feed_ingest(spark, "QzMemberPaperQuestion", landing, target, ckpt).awaitTermination()
    write_batch(spark, landing, [mk(3)])
    FS.start_feed_ingest(spark, "QzMemberPaperQuestion", landing, target, ckpt).awaitTermination()
    FS.start_feed_ingest(spark, "QzMemberPaperQuestion", landing, target, ckpt).awaitTermination()  # no-op rerun
    got = S.read_table(spark, target, ("dt", "dn")).collect()
    assert sorted(r.userid for r in got) == [1, 2, 3]
    assert {str(r.score) for r in got} == {"0.3"}


def test_overwrite_feed_stream_replaces_partitions(spark):
    landing, target, ckpt = (scratch_path(spark, n) for n in ("landing", "target", "ckpt"))
    write_batch(spark, landing, ['{"adid": 1, "adname": "a", "dn": "w"}'])
    FS.start_feed_ingest(spark, "baseadlog", landing, target, ckpt).awaitTermination()
    write_batch(spark, landing, ['{"adid": 2, "adname": "b", "dn": "w"}'])
    FS.start_feed_ingest(spark, "baseadlog", landing, target, ckpt).awaitTermination()
    got = S.read_table(spark, target, ("dn",)).collect()
    assert [(r.adid, r.adname) for r in got] == [(2, "b")]
    assert FD.FEEDS["baseadlog"].mode == "overwrite"


def test_overwrite_feed_keeps_all_rows_of_a_run(spark):
    landing, target, ckpt = (scratch_path(spark, n) for n in ("landing", "target", "ckpt"))
    for i in (1, 2, 3):
        write_batch(spark, landing, [f'{{"adid": {i}, "adname": "a{i}", "dn": "w"}}'])
    FS.start_feed_ingest(spark, "baseadlog", landing, target, ckpt, max_files=1).awaitTermination()
    assert sorted(r.adid for r in S.read_table(spark, target, ("dn",)).collect()) == [1, 2, 3]
    write_batch(spark, landing, ['{"adid": 9, "adname": "b", "dn": "w"}'])
    FS.start_feed_ingest(spark, "baseadlog", landing, target, ckpt, max_files=1).awaitTermination()
    assert [r.adid for r in S.read_table(spark, target, ("dn",)).collect()] == [9]     # the next run replaces


def test_cut_off_run_goes_on_with_default_arguments(spark, monkeypatch):
    landing, target, ckpt = (scratch_path(spark, n) for n in ("landing", "target", "ckpt"))
    for i in (1, 2):
        write_batch(spark, landing, [f'{{"adid": {i}, "adname": "a{i}", "dn": "w"}}'])
    whole, calls = S.overwrite_partitions, []

    def fails_once(df, path, cols):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("executor lost")
        return whole(df, path, cols)

    monkeypatch.setattr(S, "overwrite_partitions", fails_once)
    with pytest.raises(Exception, match="executor lost"):
        FS.start_feed_ingest(spark, "baseadlog", landing, target, ckpt, max_files=1).awaitTermination()
    FS.start_feed_ingest(spark, "baseadlog", landing, target, ckpt, max_files=1).awaitTermination()
    assert sorted(r.adid for r in S.read_table(spark, target, ("dn",)).collect()) == [1, 2]
    write_batch(spark, landing, ['{"adid": 5, "adname": "c", "dn": "w"}', '{"adid": 6, "adname": "d"}'])
    FS.start_feed_ingest(spark, "baseadlog", landing, target, ckpt, max_files=1).awaitTermination()
    assert sorted(r.adid for r in S.read_table(spark, target, ("dn",)).collect()) == [5, 6]


def test_behavior_clean_stream(spark):
    from coursewise.sources.driver import BEHAVIOR_COLUMNS
    landing, target, ckpt = (scratch_path(spark, n) for n in ("landing", "clean", "ckpt"))
    good = "\t".join("7" if c == "uid" else ("18701420007" if c == "phone" else "v") for c in BEHAVIOR_COLUMNS)
    write_batch(spark, landing, [good, "too\tshort"])
    FS.start_behavior_clean(spark, landing, target, ckpt).awaitTermination()
    got = spark.read.orc(target).collect()
    assert [(r.uid, r.phone) for r in got] == [(7, "187xxxx0007")]
