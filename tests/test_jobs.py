"""Session helper and job entry points."""

import subprocess
import sys
from pathlib import Path

import pytest
from catalogue import write_extracts

from marquee.__main__ import main
from marquee.plans import ping
from marquee.session import COMMITTER_CONF, DELTA_CONF, NEEDED, build_session, object_store_conf, require_classes
from marquee.sources import read_table


def test_ping(spark):
    assert [tuple(row) for row in ping(spark).collect()] == [(1, "Hello"), (2, "World")]
    assert ping(spark).dtypes == [("id", "int"), ("text", "string")]


def test_session_is_reused_and_configured(spark):
    assert build_session("again", conf={"spark.sql.marquee.test": "1"}) is spark
    assert spark.conf.get("spark.sql.marquee.test") == "1"
    assert object_store_conf("http://store:9000")["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert set(DELTA_CONF) == {"spark.sql.extensions", "spark.sql.catalog.spark_catalog"}


def test_object_stores_are_written_without_renames():
    conf = object_store_conf("http://store:9000")
    assert conf.items() >= COMMITTER_CONF.items()
    assert conf["spark.hadoop.fs.s3a.committer.name"] == "magic"
    assert conf["spark.sql.sources.commitProtocolClass"].endswith("PathOutputCommitProtocol")
    assert conf["spark.sql.parquet.output.committer.class"].endswith("BindingParquetOutputCommitter")


def test_absent_packages_are_named(spark, monkeypatch):
    with pytest.raises(RuntimeError, match="hadoop-aws.*spark-hadoop-cloud"):
        require_classes(spark, "s3a")
    with pytest.raises(RuntimeError, match="delta-spark"):
        build_session("tables", fmt="delta")
    assert spark.range(3).count() == 3  # a session that was there before stays
    monkeypatch.setitem(NEEDED, "delta", {"org.apache.spark.sql.SparkSession": "x"})
    require_classes(spark, "delta")


def test_jobs_from_the_command_line(spark, tmp_path, capfd):
    (tmp_path / "raw").mkdir()
    raw, curated, answers = (str(tmp_path / name) for name in ("raw", "curated", "answers"))
    with pytest.raises(FileNotFoundError, match="movies.csv"):
        main(["check", "--raw", raw])
    write_extracts(tmp_path / "raw")
    main(["ping"])
    main(["check", "--raw", raw])
    main(["curate", "--raw", raw, "--curated", curated, "--staged", str(tmp_path / "staged"), "--report"])
    main(["analytics", "--curated", curated, "--analytics", answers, "--actor", "Sam Roe"])
    printed = capfd.readouterr().out
    assert "Hello" in printed and "corrupt_genres" in printed and "lost_cast_id" in printed
    assert read_table(spark, answers, "tom_cruise_revenue").count() == 2
    main(["run", "--raw", raw, "--curated", curated, "--analytics", answers, "--top", "2"])
    assert read_table(spark, answers, "top_revenue_movies").count() == 2
    assert read_table(spark, answers, "tom_cruise_revenue").count() == 0
    capfd.readouterr()
    main(["tables", "--root", answers])
    listed = dict(line.split("\t") for line in capfd.readouterr().out.splitlines() if "\t" in line)
    assert len(listed) == 5 and spark.read.parquet(listed["top_directors"]).count() == 2


def test_a_job_starts_by_path_from_any_folder_and_ends(tmp_path):
    script = Path(__file__).resolve().parents[1] / "marquee" / "__main__.py"
    done = subprocess.run(
        [sys.executable, str(script), "ping"], cwd=tmp_path, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert "Hello" in done.stdout and "World" in done.stdout
