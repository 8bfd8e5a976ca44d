"""Cluster defaults fill only what the submitter left unset."""

from palmyra.session import CLUSTER_DEFAULTS, apply_cluster_defaults


def test_cluster_defaults_respect_submitted(spark):
    before = {k: spark.conf.get(k, None) for k in CLUSTER_DEFAULTS}
    submitted = spark.sparkContext.getConf()
    try:
        apply_cluster_defaults(spark)
        # Set at session build time (tests use 8 shuffle partitions): kept.
        assert submitted.contains("spark.sql.shuffle.partitions")
        assert spark.conf.get("spark.sql.shuffle.partitions") == before[
            "spark.sql.shuffle.partitions"]
        # Not submitted: filled with the cluster default.
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "512m"
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
