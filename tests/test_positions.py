import pytest
from pyspark.sql import functions as F

from loadloom.operators import positions
from loadloom.session import scratch_path


@pytest.fixture(scope="module")
def stored(spark):
    """Rows 0 to 999 in order, in files of uneven sizes, one of them empty."""
    path = scratch_path(spark, "ordered")
    spark.range(0, 1000, 1, 7).where("id < 570 or id >= 600").selectExpr("id", "id * 2 AS x", "cast(id % 3 as string) AS s").write.parquet(path)
    return spark.read.parquet(path)


def test_index_counts_without_reading_a_column(spark, stored):
    at = positions.positions_of(stored)
    assert at.rows == 970 and at.index.agg(F.sum("rows")).first()[0] == 970
    firsts = [r["first"] for r in at.index.sort("file").collect()]
    assert firsts == sorted(firsts) and firsts[0] == 0


@pytest.mark.parametrize("start, stop", [(0, 1), (0, 970), (100, 900), (141, 144), (565, 575), (969, 2000), (-5, 3), (5, 5), (2000, 3000)])
def test_slices_are_exact_and_read_only_their_files(spark, stored, start, stop):
    at = positions.positions_of(stored)
    ids = [i for i in range(1000) if not 570 <= i < 600]
    got = positions.rows_at(at, start, stop)
    assert sorted(r["id"] for r in got.collect()) == ids[max(start, 0) : max(stop, 0)]
    assert got.columns == stored.columns
    if 0 <= start < stop and stop - start < 12:
        assert len(got.inputFiles()) <= 2


def test_draws_are_exact_uniform_and_repeatable(spark, stored):
    at = positions.positions_of(stored)
    got = positions.draw(at, 20_000, seed=3)
    counts = {r["id"]: r["count"] for r in got.groupBy("id").count().collect()}
    assert sum(counts.values()) == 20_000 and set(counts) <= set(range(1000))
    expected = 20_000 / 970
    chi = sum((counts.get(i, 0) - expected) ** 2 / expected for i in range(1000) if not 570 <= i < 600)
    assert 800 < chi < 1150  # 969 degrees of freedom, four deviations either way
    again = {r["id"]: r["count"] for r in positions.draw(at, 20_000, seed=3).groupBy("id").count().collect()}
    other = {r["id"]: r["count"] for r in positions.draw(at, 20_000, seed=4).groupBy("id").count().collect()}
    assert again == counts != other
    assert got.where("x <> id * 2").isEmpty()


def test_few_draws_read_few_files_and_nothing_is_stored(spark, stored):
    at = positions.positions_of(stored)
    one = positions.draw(at, 1)
    assert one.count() == 1 and len(one.inputFiles()) == 1
    assert positions.draw(at, 0).count() == 0
    with pytest.raises(ValueError, match="empty"):
        positions.draw(positions.positions_of(_empty(spark)), 3)
    assert positions.rows_at(positions.positions_of(_empty(spark)), 0, 5).count() == 0


def _empty(spark):
    path = scratch_path(spark, "none")
    spark.range(0).write.parquet(path)
    return spark.read.parquet(path)
