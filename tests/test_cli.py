"""The command line, in process (it reuses the test session)."""

import json

from refinery.__main__ import main
from refinery.session import scratch_path


def test_cli_land_run_validate_reset(spark, sf_small, capsys, tmp_path):
    landing = scratch_path(spark, "cli-landing")
    warehouse = scratch_path(spark, "cli-wh")
    assert main(["land-fixtures", "--tables", sf_small, "--landing", landing]) == 0
    code = main(["run", "--landing", landing, "--warehouse", warehouse, "--prefix", "cli_", "--as-of", "2024-01-01"])
    out = capsys.readouterr().out
    assert code == 1                                  # zero quantities in the extract fail check 21
    assert "fail   21" in out and "/30 passed" in out and "lines without goods" in out
    assert main(["validate", "--prefix", "cli_"]) == 1
    own = tmp_path / "checks.json"
    own.write_text(json.dumps([{"rule": "count", "table": "gold.fact_sales", "predicate": "price > 1e9", "name": "no price beyond a billion"}]))
    capsys.readouterr()
    assert main(["validate", "--prefix", "cli_", "--checks", str(own)]) == 1
    out = capsys.readouterr().out
    assert "/31 passed" in out and "pass  1001 no price beyond a billion" in out
    fact = spark.table("cli_gold.fact_sales").inputFiles()
    assert main(["run", "--landing", landing, "--warehouse", warehouse, "--prefix", "cli_", "--as-of", "2024-01-01", "--only-if-passed"]) == 1
    assert "nothing published" in capsys.readouterr().out and spark.table("cli_gold.fact_sales").inputFiles() == fact
    assert main(["reset", "--prefix", "cli_", "--dry-run"]) == 0
    assert "[dry run] DROP SCHEMA IF EXISTS `cli_bronze` CASCADE" in capsys.readouterr().out
    assert main(["stream", "--landing", landing, "--warehouse", warehouse, "--as-of", "2024-01-01"]) == 0
    assert "crm_sales" in capsys.readouterr().out
    assert main(["reset", "--prefix", "cli_"]) == 0
    assert not [r for r in spark.sql("SHOW SCHEMAS").collect() if r[0].startswith("cli_")]
