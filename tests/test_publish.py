"""One publication per build, row counts taken by its jobs, documents as
ordered parts, checked weekly tables."""

import glob
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import cfg
from funnelkit.plans import job
from funnelkit.sinks import cube_document, cube_document_lines, document_text, latest, manifests, read_published, write_document_lines
from funnelkit.sources import checked_weekly, fixtures as fx, read_weekly, weekly_violations
from funnelkit.storage import shared_folder

SF = "/root/testdata/sf0.001"
WEEKLY = "week date, country_group string, agg_key string, free_trial_users long"


def _build(spark, root, **kw):
    trend = (fx.order_events(spark, SF), fx.order_trials(spark, SF), fx.order_paid(spark, SF))
    return job.run_build(spark, fx.web_events(spark, SF), fx.web_trials(spark, SF), fx.web_paid(spark, SF), fx.cube_config(),
                         str(root), trend_inputs=trend, **kw)


def test_a_build_that_dies_leaves_the_old_one_published(spark, tmp_path, monkeypatch):
    assert latest(spark, str(tmp_path)) is None
    first = _build(spark, tmp_path)
    cube = sorted(map(tuple, read_published(spark, str(tmp_path), "cube").collect()))
    assert len(cube) == spark.read.parquet(first["cube"]).count() > 0

    def dies(*_a, **_k):
        raise RuntimeError("between rows and header")

    with monkeypatch.context() as m:
        m.setattr(job, "write_json_document", dies)
        with pytest.raises(RuntimeError, match="between"):
            _build(spark, tmp_path, suppress=False)
    assert len(glob.glob(f"{tmp_path}/versions/*/cube")) == 2  # the rows of the second build were written
    now = latest(spark, str(tmp_path))
    assert now["version"] == first["version"]
    assert sorted(map(tuple, read_published(spark, str(tmp_path), "cube").collect())) == cube
    assert read_published(spark, str(tmp_path), "cube_header").first()["as_of"] == "2024-01-30"
    third = _build(spark, tmp_path, suppress=False)
    assert latest(spark, str(tmp_path))["version"] == third["version"] > first["version"]
    assert read_published(spark, str(tmp_path), "cube", now).count() == len(cube)  # a held version stays readable
    assert manifests(spark, str(tmp_path)).count() == 2


def test_an_unfinished_manifest_is_not_followed(spark, tmp_path):
    first = _build(spark, tmp_path)
    (tmp_path / "manifests" / "version=99990101T000000.000000-x").mkdir()
    (tmp_path / "manifests" / "version=99990101T000000.000000-x" / "_temporary").mkdir()
    assert latest(spark, str(tmp_path))["version"] == first["version"]
    with pytest.raises(FileNotFoundError):
        read_published(spark, str(tmp_path / "nothing"), "cube")


def test_row_counts_are_those_of_the_written_rows(spark, tmp_path):
    out = _build(spark, tmp_path, top_rows=5)
    rows = {r["extract"]: r["rows"] for r in spark.read.parquet(out["row_counts"]).collect()}
    assert rows["cube"] == spark.read.parquet(out["cube"]).count() and rows["trend_weeks"] == 44
    assert rows["aggregate_totals"] == spark.read.parquet(out["aggregate_totals"]).count()
    assert rows["web_cube"] > rows["cube"] > 0
    assert spark.read.parquet(out["cube"]).groupBy("period").count().agg(F.max("count")).first()[0] == 5
    assert latest(spark, str(tmp_path))["rows"] == rows


def test_counting_costs_no_job(spark, tmp_path):
    counts = job.RowCounts()
    df = counts.of(spark.range(1000).filter("id % 3 = 0"), "thirds")
    spark.sparkContext.setJobGroup("write", "one write")
    df.write.parquet(str(tmp_path / "x"))
    spark.sparkContext.setJobGroup("count", "the count")
    assert counts.taken() == {"thirds": 334}
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("count")


# -- the document in parts -----------------------------------------------------------


def _cube(spark, n):
    return spark.range(n).select(F.lit("p").alias("period"), F.format_string('pa"ge %05d\n', "id").alias("landing_family"),
                                 F.lit("é").alias("country"), (F.col("id") % 7).alias("visits")).repartition(6)


def test_document_parts_have_the_bytes_of_the_document(spark, tmp_path):
    for n in (0, 1, 3000):
        cube = _cube(spark, n)
        text = document_text(cube_document(cube, cfg())).first()["document"]
        lines = cube_document_lines(cube, cfg())
        assert "".join(r["text"] for r in sorted(lines.collect())) == text
        path = str(tmp_path / f"doc{n}")
        write_document_lines(lines, path)
        parts = "".join(open(p, encoding="utf-8", newline="").read() for p in sorted(glob.glob(path + "/part-*")))
        assert parts.replace("\n", "") == text and json.loads(parts) == json.loads(text)


def test_document_parts_take_an_open_country_list(spark):
    open_cfg = cfg(top_countries=None)
    with pytest.raises(ValueError):
        cube_document(_cube(spark, 3), open_cfg)
    lines = cube_document_lines(_cube(spark, 3), open_cfg)
    assert len(json.loads("".join(r["text"] for r in sorted(lines.collect())))["rows"]) == 3
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


# -- weekly tables ---------------------------------------------------------------------


def _weekly(spark, rows):
    return spark.createDataFrame(rows, WEEKLY)


GOOD = [(date(2024, 1, 7), "US", "all", 3), (date(2024, 1, 7), None, "all", 1), (date(2024, 1, 14), "US", "all", 2)]


def test_a_good_weekly_table_passes_unchanged(spark, tmp_path):
    _weekly(spark, GOOD).write.parquet(str(tmp_path / "w.parquet"))
    read = read_weekly(spark, str(tmp_path / "w.parquet"))
    assert read.schema == _weekly(spark, GOOD).schema
    assert sorted(map(str, read.collect())) == sorted(map(str, _weekly(spark, GOOD).collect()))
    assert read_weekly(spark, str(tmp_path / "w.parquet"), check=False).count() == 3
    assert checked_weekly(_weekly(spark, [])).count() == 0


@pytest.mark.parametrize("bad, message", [
    ((date(2024, 1, 8), "US", "all", 1), "week is not a Sunday: 2024-01-08"),
    ((None, "US", "all", 1), "week is not a Sunday: NULL"),
    ((date(2024, 1, 14), "US", "all", 9), "repeated key: 2024-01-14, US, all"),
    ((date(2024, 1, 7), None, "all", 9), "repeated key: 2024-01-07, NULL, all")])
def test_a_bad_week_fails_with_its_value(spark, bad, message):
    from funnelkit.operators.totals import union_measures

    checked = checked_weekly(_weekly(spark, [*GOOD, bad]))
    for use in (checked, union_measures(checked, _weekly(spark, GOOD).withColumnRenamed("free_trial_users", "total_bookings_users"))):
        with pytest.raises(Exception, match=message):
            use.groupBy("week").count().collect()


def test_violations_are_counted(spark):
    rows = [*GOOD, (date(2024, 1, 8), "US", "all", 1), (date(2024, 1, 9), "US", "all", 1), GOOD[0]]
    found = {r["check"]: (r["violations"], r["example"]) for r in weekly_violations(_weekly(spark, rows)).collect()}
    assert found == {"week is a Sunday": (2, "2024-01-08"), "key is unique": (1, "2024-01-07, US, all")}
    clean = {r["check"]: (r["violations"], r["example"]) for r in weekly_violations(_weekly(spark, GOOD)).collect()}
    assert clean == {"week is a Sunday": (0, None), "key is unique": (0, None)}


def test_the_shared_folder_is_required_on_a_cluster():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf()

        class sparkContext:
            master = "local-cluster[3,2,1024]"
            applicationId = "app"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())
    Session.conf["spark.checkpoint.dir"] = "hdfs://shared/"
    assert shared_folder(Session()) == "hdfs://shared"
    Session.conf.clear()
    Session.sparkContext.master = "local[2]"
    assert shared_folder(Session()) == shared_folder(Session())
