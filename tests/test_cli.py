"""The command line end to end: gate, run (collection files read line by
line) and history, from a contract file."""

import json
import os

from contract_lake.__main__ import main


def test_gate_run_history(spark, tmp_path, capsys):
    contract = f"""
servers:
  development: {{log_name: ops, log_volume: {tmp_path}/logs, metric_volume: {tmp_path}/metrics, log_level: info}}
schema:
  - name: things
    key: feature_id
    folder: things
    table_name: things
    sequence_by: seq
    properties:
      - {{name: feature_id, sourcePath: feature.id}}
      - {{name: v, sourcePath: feature.properties.v}}
      - {{name: seq, sourcePath: feature.properties.seq, physicalType: long}}
"""
    path = tmp_path / "contract.yml"
    path.write_text(contract)
    root, out = tmp_path / "in", tmp_path / "out"
    os.makedirs(root / "things")
    feats = [{"type": "Feature", "id": f"k{i % 4}", "properties": {"v": "ab"[i % 2], "seq": i},
              "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}} for i in range(40)]
    body = ",\n".join(json.dumps(f) for f in feats)
    (root / "things" / "part0.geojson").write_text(
        '{\n"type": "FeatureCollection",\n"features": [\n' + body + "\n]\n}\n")
    args = ["--contract", str(path), "--source-root", str(root), "--output-root", str(out)]
    assert main(["gate"] + args) == 0
    assert main(["run"] + args + ["--collection-lines", "--max-files", "0"]) == 0
    assert main(["history"] + args) == 0
    printed = capsys.readouterr().out
    assert "gate passed" in printed and "things 4" in printed
