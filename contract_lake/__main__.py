"""Command line: ``python -m contract_lake <command> --contract FILE ...``

  gate     check every entry's source folder; print failures, exit 1 if any
  run      gate, ingest every entry (availableNow) into its landing log, and
           bring its history table up to date
  history  print the current version count of every entry's history table

Paths may be any Hadoop path; the contract is read with Spark, so it may live
next to the data. Spark settings come from ``spark-submit``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from .contract import load_contract
from .operators.files import GateError
from .plans.runlog import RunLog
from .session import get_spark
from .streaming import ingest


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="contract_lake")
    parser.add_argument("command", choices=["gate", "run", "history"])
    parser.add_argument("--contract", required=True, help="contract YAML path")
    parser.add_argument("--source-root", required=True, help="folder holding one folder per entry")
    parser.add_argument("--output-root", required=True, help="landing logs and checkpoints")
    parser.add_argument("--max-files", type=int, default=0, help="files per micro-batch (0: no limit)")
    parser.add_argument("--document-lines", action="store_true", help="sources hold one document per line (read split)")
    parser.add_argument("--feature-lines", action="store_true", help="sources hold one feature per line")
    parser.add_argument("--collection-lines", action="store_true",
                        help="sources are FeatureCollections laid out one feature per line (read split)")
    args = parser.parse_args(argv)

    spark = get_spark()
    contract = load_contract(path=args.contract, spark=spark)
    log = RunLog.from_contract(spark, contract, notebook=f"contract_lake {args.command}")
    try:
        if args.command == "gate":
            ingest.gate_entries(spark, contract, args.source_root, args.output_root,
                                as_of=F.current_timestamp(), log=log)
            print("gate passed")
        elif args.command == "run":
            ingest.run_all(spark, contract, args.source_root, args.output_root,
                           max_files=args.max_files or None, log=log, multi_line=not args.document_lines,
                           feature_lines=args.feature_lines, collection_lines=args.collection_lines)
        else:
            for entry in contract.entries:
                hist = ingest.read_history(spark, ingest.paths_for(entry, args.source_root, args.output_root).history)
                print(entry.name, hist.filter("is_current").count())
    except GateError as exc:
        print(exc, file=sys.stderr)
        return 1
    finally:
        log.flush()
    return 0


if __name__ == "__main__":
    sys.exit(main())
