"""The command line drives the same jobs."""

from __future__ import annotations

import json

from strata.__main__ import main
from strata.session import scale_conf
from tests.conftest import REFERENCE_ROWS


def test_scale_conf():
    conf = scale_conf(10 * 1024 ** 4, 8000)  # a 10 TiB join shuffle
    assert conf["spark.sql.files.maxPartitionBytes"] == "256m"
    assert int(conf["spark.sql.shuffle.partitions"]) == 40960
    assert int(scale_conf(10, 8)["spark.sql.shuffle.partitions"]) == 16


def test_cli_pipeline_publish_consume(spark, tmp_path, edge_frame, capsys):
    src, ref = str(tmp_path / "src"), str(tmp_path / "ref")
    edge_frame.coalesce(1).write.option("header", True).csv(src)
    spark.createDataFrame(REFERENCE_ROWS, "state_code int, state_name string") \
        .coalesce(1).write.option("header", True).csv(ref)
    main(["pipeline", "--input", src, "--output-dir", str(tmp_path / "a"),
          "--ref-state-codes", ref, "--run-id", "manual__1"])
    a = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert a["gold"]["rows"] == 4 and a["silver"]["rows"] == 5
    topic = str(tmp_path / "topic")
    main(["publish", "--input", src, "--topic-dir", topic, "--max-records", "9"])
    p = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert p["records_sent"] == 9
    main(["consume", "--topic-dir", topic, "--output-dir", str(tmp_path / "b"),
          "--ref-state-codes", ref, "--incremental", "--checkpoint", str(tmp_path / "ck"),
          "--schema-from", src])
    b = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert b["bronze"]["rows"] == 9 and b["gold"]["rows"] == 4


def test_cli_incremental_needs_checkpoint(capsys):
    import pytest
    with pytest.raises(SystemExit):
        main(["consume", "--topic-dir", "/nonexistent", "--output-dir", "/x",
              "--ref-state-codes", "/y", "--incremental"])
    assert "go together" in capsys.readouterr().err
