"""Settings that somebody made win over defaults."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from shelfpulse.session import PARTITIONS, size_shuffles

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

ASK = """
import json, sys
from shelfpulse import build_session
spark = build_session("ask", master="local[2]", conf={"spark.sql.adaptive.skewJoin.enabled": "false"})
keys = sys.argv[1:]
print("SAID " + json.dumps({k: spark.conf.get(k, None) for k in keys}))
spark.stop()
"""


def test_submitted_settings_win():
    keys = [
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.shuffle.partitions",
        "spark.sql.adaptive.skewJoin.enabled",
        "spark.sql.session.timeZone",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    ]
    submitted = (
        "--conf spark.sql.autoBroadcastJoinThreshold=5m --conf spark.sql.shuffle.partitions=77 "
        "--conf spark.ui.enabled=false pyspark-shell"
    )
    out = subprocess.run(
        [sys.executable, "-c", ASK, *keys],
        cwd=ROOT,
        env=os.environ | {"PYSPARK_SUBMIT_ARGS": submitted},
        capture_output=True,
        text=True,
        timeout=120,
    )
    said = json.loads(out.stdout.split("SAID ")[1])
    assert said == {
        keys[0]: "5m",
        keys[1]: "77",
        keys[2]: "false",
        keys[3]: "UTC",
        keys[4]: "4m",
    }


def test_shuffles_follow_the_input(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_bytes(b"x" * 3_000_000)
    folder = str(tmp_path / "in")
    assert size_shuffles(spark, folder) is None
    held = {key: spark.conf.get(key) for key in (PARTITIONS, ADVISORY)}
    try:
        spark.conf.set("spark.shelfpulse.sizeShuffles", "true")
        assert size_shuffles(spark, folder) == 200
        spark.conf.set(ADVISORY, "10k")
        assert size_shuffles(spark, folder) == -(-9_000_000 // 10_240)
        assert spark.conf.get(PARTITIONS) == str(-(-9_000_000 // 10_240))
    finally:
        spark.conf.set("spark.shelfpulse.sizeShuffles", "false")
        for key, value in held.items():
            spark.conf.set(key, value)


ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
