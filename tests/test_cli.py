import pytest

from loamflow.__main__ import main
from loamflow.streaming.ingest import Layout, read_raw


def test_cli_synthesize_ingest_measure(spark, run_dir, capsys):
    root = f"{run_dir}/land"
    assert main(["synthesize", "--source-root", root, "--database", "db", "--num-days", "1",
                 "--files-per-day", "2", "--rows-per-file", "7"]) == 0
    assert main(["ingest", "--source-root", root, "--database", "db", "--raw-root", f"{run_dir}/raw",
                 "--checkpoint-root", f"{run_dir}/ck", "--max-concurrent", "3"]) == 0
    lay = Layout(root, "db", f"{run_dir}/raw", f"{run_dir}/ck")
    assert read_raw(spark, lay, "videokycs").count() == 14
    assert main(["measure", "--source-root", root, "--database", "db",
                 "--checkpoint-root", f"{run_dir}/_measurement", "--mode", "BOUNDED_DRAIN",
                 "--results-path", f"{run_dir}/results"]) == 0
    assert spark.read.parquet(f"{run_dir}/results").count() == 6
    with pytest.raises(SystemExit):
        main(["measure", "--source-root", root, "--database", "db", "--checkpoint-root", f"{run_dir}/prod"])
    with pytest.raises(SystemExit):
        main(["ingest", "--source-root", root, "--database", "db", "--raw-root", "r", "--checkpoint-root", "c",
              "--shard-count", "2", "--shard-index", "2"])
