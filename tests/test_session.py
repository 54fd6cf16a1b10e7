"""Where written side tables go."""

from types import SimpleNamespace

from feedpulse.session import shared_folder


def session(master, conf=None, context_dir=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: conf or default),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: context_dir),
    )


def test_the_session_names_the_folder():
    folder = shared_folder(session("yarn", "s3a://bucket/checkpoints/"), "resent")
    assert folder.startswith("s3a://bucket/checkpoints/resent-")
    assert shared_folder(session("yarn", None, "hdfs:///cp"), "x").startswith("hdfs:///cp/x-")
    assert folder != shared_folder(session("yarn", "s3a://bucket/checkpoints/"), "resent")


def test_without_a_setting_folders_go_below_the_warehouse():
    folder = shared_folder(session("spark://host:7077"), "resent")
    assert folder.startswith("spark-warehouse/feedpulse-work/resent-")


def test_python_gets_few_rows_at_once(spark):
    """A batch of texts does not grow with the input, or with Spark's 10,000 rows."""
    import pyarrow as pa

    import __spark_entry__ as entry

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    entry.queries()["model_scored_posts"](spark, "/root/testdata/sf0.001")
    seen = spark.range(0, 3000, numPartitions=1).mapInArrow(sizes, "n long").collect()
    assert sum(r.n for r in seen) == 3000 and max(r.n for r in seen) <= 256
