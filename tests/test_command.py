import os
import subprocess
import sys

from conftest import day, rows
from test_build import raw

from daytally.plans.build import open_lake


def test_command_line_run(spark, tmp_path):
    sources = raw(tmp_path / "in", range(1, 4))
    lake = str(tmp_path / "lake")
    paths = {**vars(sources), "snapshot": str(tmp_path / "snapshot"), "lake": lake}
    command = [sys.executable, "-m", "daytally", "--as-of", str(day(2))]
    for name, path in paths.items():
        command += [f"--{name}", path]
    conf = "--conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=4 pyspark-shell"
    done = subprocess.run(
        command, cwd=os.path.dirname(os.path.dirname(__file__)), capture_output=True, text=True,
        timeout=300, env={**os.environ, "PYSPARK_SUBMIT_ARGS": conf})
    assert done.returncode == 0, done.stderr[-2000:]
    assert "countries" in done.stdout and "false" not in done.stdout
    assert rows(open_lake(spark, lake)["fact_covid_country"]).count(
        ("Chile", day(2), 5, 5, 10, 10)) == 1
