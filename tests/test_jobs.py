import threading
import time

import pytest

from almanac.jobs import CLEANUP, at_once, shuffles_removed


def test_results_come_in_the_order_of_the_actions(spark):
    met = threading.Barrier(3, timeout=60)

    def counted(n):
        met.wait()  # all three run at the same time
        return spark.range(n).count()

    assert at_once(spark, *(lambda n=n: counted(n) for n in (5, 0, 9))) == [5, 0, 9]
    assert at_once(spark) == []


def test_an_error_waits_for_the_other_actions(spark, tmp_path):
    path, failed = str(tmp_path / "rows"), threading.Event()

    def fails():
        failed.set()
        raise ValueError("first")

    def writes():
        failed.wait(60)
        spark.range(7).write.parquet(path)

    with pytest.raises(ValueError, match="first"):
        at_once(spark, fails, writes)
    assert spark.read.parquet(path).count() == 7


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size())
            if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_their_action(spark, tmp_path):
    held, before = shuffle_files(spark), spark.conf.get(CLEANUP, "false")
    with shuffles_removed(spark):
        rows = spark.range(1000).repartition(5, "id")
        rows.write.parquet(str(tmp_path / "rows"))
        assert rows.where("id > 7").groupBy("id").count().count() == 992
        until = time.time() + 30
        while shuffle_files(spark) - held and time.time() < until:
            time.sleep(0.1)
        assert not shuffle_files(spark) - held
    assert spark.conf.get(CLEANUP, "false") == before


def test_the_setting_comes_back_after_the_last_run(spark):
    before = spark.conf.get(CLEANUP, "false")
    one, two = shuffles_removed(spark), shuffles_removed(spark)
    one.__enter__()
    two.__enter__()
    one.__exit__(None, None, None)
    assert spark.conf.get(CLEANUP) == "true"
    two.__exit__(None, None, None)
    assert spark.conf.get(CLEANUP, "false") == before
    with pytest.raises(ValueError):
        with shuffles_removed(spark):
            raise ValueError
    assert spark.conf.get(CLEANUP, "false") == before
