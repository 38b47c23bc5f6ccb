"""The command line runs the three jobs end to end (spark-submit style)."""

from __future__ import annotations

import json
import uuid

from xml_fixtures import write_fixtures

from fiscalflow import cli
from fiscalflow.sources.messages import FileLog


def test_cli_all(spark, tmp_path, capsys):
    xml_dir = write_fixtures(str(tmp_path / "xmls"))
    db = "cli_" + uuid.uuid4().hex[:6]
    assert cli.main(["all", "--xml-dir", xml_dir, "--log", str(tmp_path / "log"), "--db", db]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["ingest"]["messages"] == 10
    assert out["ingest"]["rejects"] == 6
    assert out["persist"] == {"notas": 10, "itens": 14, "rejects": 0}
    assert out["reports"]["resultado_notas_por_uf"] == 2


def test_empty_log_reads_empty(spark, tmp_path):
    log = FileLog(str(tmp_path / "never-written"))
    df = log.read(spark)
    assert df.count() == 0 and df.columns == ["key", "value", "topic", "partition", "offset", "timestamp", "batch"]
