import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from hirelens.session import build_session, checkpoint_dir
    import tempfile
    warehouse = tempfile.mkdtemp(prefix="hirelens-warehouse-")
    s = build_session("local[4]", shuffle_partitions=8, app_name="hirelens-tests",
                      extra_conf={"spark.sql.warehouse.dir": warehouse})
    checkpoint_dir(s)
    yield s
    from hirelens.plans.common import forget_silver
    from hirelens.sources.tables import drop_staged
    forget_silver()
    drop_staged(s)
    s.stop()
