"""Command line: config-check, extract, dictionary inspect|validate, sources inspect|ingest."""

from __future__ import annotations

import argparse
import json
import sys

from packloom.operators.dictionary import TEMPLATE, MappingError
from packloom.operators.members import ArchiveLimits
from packloom.operators.timings import to_stderr
from packloom.plans import dictionaries, pack, sinks
from packloom.settings import load_settings
from packloom.sources.sheets import SheetError

INVALID, NOT_BUILT, REJECTED = 2, 3, 4


def _at_least(least: int):
    def parse(x: str) -> int:
        if int(x) < least:
            raise argparse.ArgumentTypeError(f"at least {least}")
        return int(x)

    return parse


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="packloom", description=__doc__)
    top = p.add_subparsers(dest="command", required=True)
    top.add_parser("config-check").add_argument("--config-path")
    extract = top.add_parser("extract")
    for o in ("--dictionary-path", "--asset-config", "--output-dir"):
        extract.add_argument(o, required=True)
    d = top.add_parser("dictionary").add_subparsers(dest="action", required=True)
    inspect, validate = d.add_parser("inspect"), d.add_parser("validate")
    for x in (inspect, validate):
        x.add_argument("--dictionary-path", required=True)
        x.add_argument("--sheet-name")
    inspect.add_argument("--header-row", type=_at_least(1), default=1)
    validate.add_argument("--mapping-config")
    validate.add_argument("--output-dir", default="output/dictionary_validation")
    s = top.add_parser("sources").add_subparsers(dest="action", required=True)
    s.add_parser("inspect").add_argument("--source-path", required=True)
    ingest = s.add_parser("ingest")
    ingest.add_argument("--source-path", required=True)
    ingest.add_argument("--output-dir", default="output/source_ingestion")
    ingest.add_argument("--max-archive-depth", type=_at_least(0), default=2)
    ingest.add_argument("--max-archive-members", type=_at_least(1), default=500)
    ingest.add_argument("--max-uncompressed-bytes", type=_at_least(1), default=500_000_000)
    ingest.add_argument("--fail-on-unreadable", action="store_true")
    for x in (validate, ingest):
        x.add_argument("--folders", action="store_true", help="write each table as a folder of files, by many tasks")
    return p


def _show(value) -> None:
    print(json.dumps(value, indent=2, default=str))


def main(argv: list[str] | None = None, spark=None) -> int:
    a = _parser().parse_args(argv)
    if a.command == "config-check":
        _show(load_settings(a.config_path).public())
        return 0
    if a.command == "extract":
        import os

        os.makedirs(a.output_dir, exist_ok=True)
        print("extraction isn't part of this engine", file=sys.stderr)
        return NOT_BUILT
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("packloom").getOrCreate()
    if a.command == "dictionary":
        try:
            if a.action == "inspect":
                _show(dictionaries.inspect_dictionary(spark, a.dictionary_path, a.sheet_name, a.header_row))
                return 0
            config = TEMPLATE
            if a.mapping_config:
                import yaml

                with open(a.mapping_config, encoding="utf-8") as f:
                    config = yaml.safe_load(f)
            result = dictionaries.ingest_dictionary(spark, a.dictionary_path, config, a.sheet_name, to_stderr)
        except (SheetError, MappingError) as e:
            print(e, file=sys.stderr)
            return INVALID
        to_stderr("write_artifacts", a.output_dir)
        sinks.write_dictionary(result, a.output_dir, not a.folders)
        summary = result.summary.first().asDict(recursive=True)
        _show(summary)
        repeats = result.duplicates.where("issue_code = 'DUPLICATE_TARGET_ID'").count()
        result.release()
        return REJECTED if summary["rejected_rows"] or repeats else 0
    if a.action == "inspect":
        _show({k: [r.asDict() for r in df.toLocalIterator()] for k, df in pack.inspect_source_pack(spark, a.source_path).items()})
        return 0
    limits = ArchiveLimits(max_depth=a.max_archive_depth, max_member_count=a.max_archive_members, max_uncompressed_bytes=a.max_uncompressed_bytes)
    result = pack.ingest_source_pack(spark, a.source_path, limits, a.fail_on_unreadable, to_stderr)
    to_stderr("write_artifacts", a.output_dir)
    sinks.write_pack(result, a.output_dir, not a.folders)
    _show(result.summary.first().asDict(recursive=True))
    result.release()
    return 0


if __name__ == "__main__":
    sys.exit(main())
