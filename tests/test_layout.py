import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from frames import to_spark
from pyspark.sql import functions as F

from pulsetrail.sources.layout import column_cuts, curve, write_clustered


def _events(spark, n=60_000):
    rng = np.random.default_rng(12)
    user = np.where(rng.random(n) < 0.3, 7, rng.integers(0, 3_000, n))  # one has a third of all
    frame = pd.DataFrame(
        {
            "event_id": np.arange(n),
            "epoch_hour": rng.integers(470_000, 470_720, n),
            "region": np.array(["north", "south", "islands", "east", "west"], dtype=object)[user % 5],
            "user_id": user,
            "price": rng.gamma(2.0, 15.0, n).round(2),
        }
    )
    return frame, to_spark(spark, frame)


def _groups(path):
    """(rows, least and greatest value of each column) of every row group."""
    for file in sorted(path.glob("*.parquet")):
        meta = pq.read_metadata(file)
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            yield group.num_rows, {
                name: (group.column(i).statistics.min, group.column(i).statistics.max) for i, name in enumerate(names)
            }


def _touched(path, **wanted):
    groups = list(_groups(path))
    hit = [g for _, g in groups if all(g[c][0] <= v <= g[c][1] for c, v in wanted.items())]
    return len(hit) / len(groups), len(groups)


def test_filters_skip_row_groups(spark, tmp_path):
    frame, events = _events(spark)
    path = tmp_path / "clustered"
    write_clustered(events, str(path), ["epoch_hour", "region", "user_id"], group_bytes=16 << 10, files=8)
    for hour, user in ((470_100, 1_234), (470_700, 2_998), (470_005, 3)):
        region = ["north", "south", "islands", "east", "west"][user % 5]
        share, groups = _touched(path, epoch_hour=hour, region=region, user_id=user)
        assert groups >= 100 and share < 0.1
        assert _touched(path, user_id=user)[0] < 0.35 and _touched(path, epoch_hour=hour)[0] < 0.35
    # By time alone a user is in every row group.
    plain = tmp_path / "sorted"
    events.repartitionByRange(8, "epoch_hour").sortWithinPartitions("epoch_hour").write.option(
        "parquet.block.size", 16 << 10
    ).option("parquet.page.size.row.check.min", 100).parquet(str(plain))
    assert _touched(plain, user_id=1_234)[0] > 0.9
    stored = spark.read.parquet(str(path))
    assert stored.count() == len(frame) and stored.columns == events.columns
    one = stored.where("user_id = 1234 and epoch_hour between 470100 and 470200")
    assert one.count() == int(((frame["user_id"] == 1234) & frame["epoch_hour"].between(470_100, 470_200)).sum())


def test_files_stay_even_with_a_hot_user(spark, tmp_path):
    _, events = _events(spark)
    write_clustered(events, str(tmp_path / "c"), ["epoch_hour", "user_id"], files=8)
    rows = [pq.read_metadata(f).num_rows for f in (tmp_path / "c").glob("*.parquet")]
    assert len(rows) == 8 and max(rows) < 2 * sum(rows) / len(rows)


@pytest.mark.parametrize("name", ["epoch_hour", "region", "price"])
def test_cuts_are_quantiles(spark, name):
    frame, events = _events(spark, 5_000)
    cuts = column_cuts(events, name, 3)
    order = sorted(frame[name])
    assert cuts == list(dict.fromkeys(order[j * 5_000 // 8 - 1] for j in range(1, 8)))


def test_curve_of_nothing_and_nulls(spark, tmp_path):
    _, events = _events(spark, 40)
    blank = events.withColumn("user_id", F.lit(None).cast("long"))
    assert {r[0] for r in blank.select(curve(blank, ["user_id"])).collect()} == {0}
    write_clustered(blank.where("false"), str(tmp_path / "none"), ["user_id", "region"])
    assert spark.read.schema(blank.schema).parquet(str(tmp_path / "none")).count() == 0
