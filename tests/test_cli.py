"""The command line runs the whole flow on the sample file (one station)."""

import csv
import glob
import os
import subprocess
import sys

from tests.conftest import DATA, ROOT


def run(args, env):
    return subprocess.run([sys.executable, "-m", "stationdw", *args], cwd=ROOT, env=env,
                          capture_output=True, text=True, timeout=600)


def test_cli_flow(tmp_path):
    env = dict(os.environ, STATIONDW_TOPIC=str(tmp_path / "topic"),
               STATIONDW_WAREHOUSE=str(tmp_path / "wh"))
    steps = [
        ["prepare"],
        ["publish", "--csv", os.path.join(DATA, "NORMAL_DLY_sample_csv.csv")],
        ["consume"], ["load"], ["summary"],
        ["report", "--pair", "GHCND:USC00327027", "GHCND:USC00327027", "a", "b",
         "--season", "GHCND:USC00327027",
         "--gap", "GHCND:USC00327027", "GHCND:USC00327027", "a", "b",
         "--out", str(tmp_path / "reports")],
    ]
    for step in steps:
        res = run(step, env)
        assert res.returncode == 0, (step, res.stderr[-2000:])
    res = run(["query", "--out", str(tmp_path / "mine"), "--sql", "SELECT month_num, num_days "
               "FROM vw_monthly_climate_imperial WHERE month_num = 2"], env)
    assert res.returncode == 0, res.stderr[-2000:]
    assert [r for f in glob.glob(str(tmp_path / "mine" / "*.csv"))
            for r in csv.DictReader(open(f))] == [{"month_num": "2", "num_days": "28"}]
    files = glob.glob(str(tmp_path / "reports" / "query1" / "*.csv"))
    rows = [r for f in files for r in csv.DictReader(open(f))]
    assert len(rows) == 12
    jan = [r for r in rows if r["month_num"] == "1"][0]
    assert jan["monthly_avg_temperature_normal"] == "5.10"
    assert jan["monthly_total_precipitation_normal"] == "0.55"


def test_catalog_tables_see_loaded_files(spark, tmp_path):
    from stationdw.plans import catalog, jobs
    from stationdw.session import scratch_dir
    from stationdw.sources.sinks import write_messages
    from stationdw.sources.csv_daily import read_daily_csv
    base = str(tmp_path / "wh")
    paths = catalog.table_paths(base, "cat_test")
    catalog.ensure_tables(spark, "cat_test", base)
    topic = scratch_dir(spark, "topic")
    write_messages(read_daily_csv(spark, os.path.join(DATA, "NORMAL_DLY_sample_csv.csv")), topic)
    jobs.consume_to_staging(spark, "files", {"path": topic}, paths["climate_normal_daily_raw"],
                            paths["quarantine"], scratch_dir(spark, "ck")).awaitTermination()
    jobs.load_warehouse(spark, paths["climate_normal_daily_raw"], f"{base}/cat_test").collect()
    catalog.refresh_tables(spark, "cat_test")
    assert spark.table("cat_test.fact_daily_climate_normal").count() == 365
    assert spark.table("cat_test.climate_normal_daily_raw").count() == 365
    assert spark.table("cat_test.dim_station").count() == 1
