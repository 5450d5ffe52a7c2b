import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from coursewise.session import build_session
    s = build_session("local[4]", app="coursewise-tests", shuffle_partitions=4,
                      extra={"spark.ui.enabled": "false", "spark.driver.memory": "6g",
                             "spark.sql.session.timeZone": "UTC"})
    # tests own their shared folder; a cluster names it in spark.checkpoint.dir
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


def rows(df, *cols):
    """Rows as plain tuples (selected columns), sorted for comparison."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
