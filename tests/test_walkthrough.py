"""The end-to-end walkthrough keeps working."""

import glob
import os
import sys

from conftest import SF0001

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))


def test_walkthrough_runs(spark, tmp_path):
    import walkthrough

    walkthrough.run(spark, SF0001, str(tmp_path))
    report = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(str(tmp_path / "spider_report" / "part-*"))))
    assert report.startswith("Page title: ") and "\n----------------\n" in report
    assert spark.read.parquet(str(tmp_path / "results")).count() > 0
