import os

import pytest

from matchloom.llm.store import discard, new_path, scratch, shared_folder, written


def test_all_tables_of_a_block_go_with_it(spark, tmp_path):
    before = set(os.listdir(shared_folder(spark)))
    with scratch(spark):
        stage = new_path(spark, "stage")
        with scratch(spark):
            inner = written(spark.range(5), "inner").stored_at
            kept = written(spark.range(5), "kept", stage)
        assert not os.path.exists(inner) and kept.count() == 5  # the stage's table is the outer block's
        kept.write.parquet(str(tmp_path / "out"))
    assert not os.path.exists(stage) and set(os.listdir(shared_folder(spark))) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_a_block_that_fails_leaves_nothing(spark):
    with pytest.raises(ValueError), scratch(spark):
        path = written(spark.range(2), "lost").stored_at
        raise ValueError
    assert not os.path.exists(path) and not os.path.exists(os.path.dirname(path))
    one = written(spark.range(2), "one")
    discard(one)
    assert not os.path.exists(one.stored_at)
