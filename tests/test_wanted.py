from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from firmscope.operators import wanted
from firmscope.operators.wanted import only_wanted


def _found(spark, keys, rows, bits):
    wanted = spark.createDataFrame([(k,) for k in keys], "k string")
    table = spark.createDataFrame([(k,) for k in rows], "key string")
    return [r.key for r in only_wanted(table, F.col("key"), wanted, bits).collect()]


@pytest.mark.parametrize("bits", [1 << 16, 1 << 20, 100_000])
def test_no_wanted_row_is_lost_and_few_others_stay(spark, bits):
    keys, others = [f"k{n}" for n in range(2_000)], [f"o{n}" for n in range(20_000)]
    found = _found(spark, [*keys, *keys[:500], None], keys + others, bits)
    assert set(keys) <= set(found) and len([k for k in found if k in set(keys)]) == len(keys)
    assert len(found) - len(keys) <= 0.04 * len(others)


def test_missing_and_odd_keys(spark):
    assert _found(spark, ["", "ä"], ["", "ä", "a", None], 1 << 20) == ["", "ä"]
    assert _found(spark, [], ["", "a", None], 1 << 20) == []
    assert _found(spark, [None], ["", "a", None], 1 << 20) == []


def test_a_full_bitmap_lets_all_pass(spark):
    rows = [f"o{n}" for n in range(200)]
    assert _found(spark, [f"k{n}" for n in range(400_000)], rows, 1 << 15) == rows


def test_keys_of_any_type(spark):
    table = spark.range(1_000)
    wanted = spark.range(0, 1_000, 100)
    found = {r.id for r in only_wanted(table, F.col("id"), wanted).collect()}
    assert set(range(0, 1_000, 100)) <= found and len(found) < 20


def test_positions_follow_the_table(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "few"))
    spark.range(2_000_000).write.parquet(str(tmp_path / "many"))
    few, many = (wanted.positions(spark.read.parquet(str(tmp_path / name))) for name in ("few", "many"))
    assert few == wanted.FEW < many <= wanted.BITS
