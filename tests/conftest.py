import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from airshed.session import build_session

    ckpt = tmp_path_factory.mktemp("checkpoints")
    warehouse = tmp_path_factory.mktemp("warehouse")
    s = build_session("airshed-tests", master="local[4]", shuffle_partitions=4,
                      extra={"spark.ui.showConsoleProgress": "false",
                             "spark.checkpoint.dir": str(ckpt),
                             "spark.sql.warehouse.dir": str(warehouse)})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples (optionally selected columns)."""
    if cols:
        df = df.select(*cols)
    return [tuple(r) for r in df.collect()]
