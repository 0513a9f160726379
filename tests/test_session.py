from sensorflow.session import scale_conf


def test_scale_conf_bounds():
    big = scale_conf(100 * 10 ** 12, total_cores=8000)          # 100 TB on 1000 x 8 cores
    assert 100_000 < int(big["spark.sql.shuffle.partitions"]) <= 400_000
    small = scale_conf(10 ** 6, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"        # never below 2 per core
