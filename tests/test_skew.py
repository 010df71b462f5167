"""A hot key holding a third of all rows: the join is split by AQE, results stay exact."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from paths import SF01
from oracle_check import compare, duck
from sacctlens.plans.explain import final_plan_text
from sacctlens.plans.oracle import oracle_sql
from sacctlens.plans.queries import QUERIES

HOT_ORDER = 7


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("skewed")
    li = pq.read_table(f"{SF01}/lineitem.parquet")
    n = li.num_rows
    # Half as many extra lines as there are lines, all on one order: a third of the rows.
    extra = li.slice(0, n // 2)
    extra = extra.set_column(extra.schema.get_field_index("l_orderkey"), "l_orderkey",
                             pa.array([HOT_ORDER] * extra.num_rows, pa.int64()))
    both = pa.concat_tables([li, extra])
    # Interleave the hot lines with the rest and write many row groups, as a large
    # file would have: AQE splits a skewed partition by ranges of map tasks.
    order = np.random.default_rng(0).permutation(both.num_rows)
    pq.write_table(both.take(pa.array(order)), d / "lineitem.parquet", row_group_size=6000)
    pq.write_table(pq.read_table(f"{SF01}/orders.parquet"), d / "orders.parquet")
    pq.write_table(pq.read_table(f"{SF01}/events.parquet"), d / "events.parquet")
    return str(d)


@pytest.fixture()
def skew_conf(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.shuffle.partitions": "16",
            # one task per row group, as for a large file
            "spark.sql.files.maxPartitionBytes": "64k",
            "spark.sql.files.openCostInBytes": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["single_pass_metrics", "report_all_months", "state_histogram", "output_diff"])
def test_hot_order_key(spark, skewed_dir, skew_conf, name):
    con = duck(skewed_dir)
    r = compare(spark, name, QUERIES[name], oracle_sql()[name], skewed_dir, con)
    assert r["spark_rows"] == r["oracle_rows"] and r["values"], name


def test_skewed_join_is_split(spark, skewed_dir, skew_conf):
    df = QUERIES["single_pass_metrics"](spark, skewed_dir)
    df.collect()
    plan = final_plan_text(df)
    assert "SortMergeJoin(skew=true)" in plan, plan
