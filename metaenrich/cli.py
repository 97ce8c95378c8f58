"""Command line: metaenrich <method> [options] [stage]."""

from __future__ import annotations

import argparse
import logging
import sys
from pathlib import Path

import yaml
from pyspark.sql import SparkSession

from .operators.lookup import LookupConfig, RegistryResolver, ServiceResolver
from .operators.organisations import Affiliations, Funders
from .operators.provenance import load_provenance
from .operators.resource_type import ResourceTypeGeneral
from .operators.rules import ConfigError, load_rules
from .operators.schema import load_schema
from .plans.runner import RunOptions, run
from .plans.staged import Stage, WorkDir
from .sources.registry import read_registry

#: Shipped settings; the checkout's folder, as with the other configuration files.
SETTINGS = Path(__file__).resolve().parents[1] / "configs" / "engine.yaml"
LEVELS = ("off", "error", "warn", "info", "debug", "trace")


def parser() -> argparse.ArgumentParser:
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("-i", "--input", required=True, metavar="DIR")
    shared.add_argument("-o", "--output", required=True, metavar="PATH")
    shared.add_argument("--provenance", required=True, metavar="FILE")
    shared.add_argument("--settings", metavar="FILE", default=str(SETTINGS), help="settings of the installation")
    shared.add_argument("--organization", metavar="NAME", help="name that the producing contributor must have, instead of the settings' one")
    shared.add_argument("-t", "--threads", type=int, default=0, help="accepted; the cluster's cores decide")
    shared.add_argument("-b", "--batch-size", type=int, default=5000, help="accepted; has no effect")
    shared.add_argument("--single-file", action="store_true")
    shared.add_argument("--exact", action="store_true", help="lines with lone surrogates or numbers beyond the doubles are malformed")
    checks = shared.add_mutually_exclusive_group()
    checks.add_argument("--schema", metavar="FILE")
    checks.add_argument("--no-validate", action="store_true")
    shared.add_argument("--log-level", choices=LEVELS, default="info")

    lookup = argparse.ArgumentParser(add_help=False)
    lookup.add_argument("--ror-service-url", metavar="URL", help="match service; without it names are matched to the registry")
    lookup.add_argument("--ror-file", required=True, metavar="FILE")
    lookup.add_argument("--ror-batch-size", type=int, default=50)
    lookup.add_argument("--ror-concurrency", type=int, default=50)
    lookup.add_argument("--ror-timeout", type=int, default=30)
    lookup.add_argument("--work-dir", metavar="DIR")
    lookup.add_argument("--from-scratch", action="store_true")
    lookup.add_argument("stage", nargs="?", choices=[s.value for s in Stage])

    top = argparse.ArgumentParser(prog="metaenrich")
    methods = top.add_subparsers(dest="method", required=True)
    general = methods.add_parser("resource-type-general", parents=[shared], help="reclassify resourceTypeGeneral from the free-text resource type")
    general.add_argument("--rules", required=True, metavar="FILE")
    methods.add_parser("affiliations", parents=[shared, lookup], help="identifiers of creators' affiliations")
    methods.add_parser("funders", parents=[shared, lookup], help="identifiers of funders")
    return top


def required_organization(path: str) -> str | None:
    """The producer's name that a settings file requires; a file without the setting is refused, so that none is required only on purpose."""
    try:
        data = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    except (OSError, yaml.YAMLError) as error:
        raise ConfigError(f"settings {path}: {error}") from error
    if not isinstance(data, dict) or set(data) != {"organization"} or not isinstance(data["organization"], (str, type(None))):
        raise ConfigError(f"settings {path}: expected `organization`, a name or null, and nothing else")
    return data["organization"]


def _execute(args: argparse.Namespace) -> None:
    """Order of checks: provenance, method (rules), validator, then the run."""
    provenance = load_provenance(args.provenance, args.organization or required_organization(args.settings))
    rules = load_rules(args.rules) if args.method == "resource-type-general" else None
    validator = None if args.no_validate else load_schema(args.schema) if args.schema else "builtin"
    options = RunOptions(args.input, args.output, args.threads, args.batch_size, args.single_file, args.exact)
    spark = SparkSession.builder.appName(f"metaenrich {args.method}").getOrCreate()
    if rules is not None:
        run(spark, ResourceTypeGeneral(rules), options, provenance, validator)
        return
    config = LookupConfig(args.ror_service_url or LookupConfig.service_url, args.ror_file, args.ror_batch_size, args.ror_concurrency, args.ror_timeout, work_dir=args.work_dir, from_scratch=args.from_scratch)
    registry = read_registry(spark, config.registry)
    task, kind = ("affiliation", Affiliations) if args.method == "affiliations" else ("funder", Funders)
    work = WorkDir(spark, config.work_dir or f"{args.output.rstrip('/')}.work")
    resolver = ServiceResolver(config, task, f"{work.root}/ledger") if args.ror_service_url else RegistryResolver(registry, path=f"{work.root}/names")
    run(spark, kind(resolver, registry), options, provenance, validator, work, config.from_scratch, Stage(args.stage) if args.stage else None)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    level = {"off": logging.CRITICAL + 1, "warn": logging.WARNING, "trace": logging.DEBUG}.get(args.log_level, args.log_level.upper())
    logging.basicConfig(level=level, format="%(levelname)s %(name)s: %(message)s")
    try:
        _execute(args)
    except Exception as error:  # noqa: BLE001  the command line reports every failure alike
        chain, e = [], error
        while e is not None:
            chain.append(str(e))
            e = e.__cause__
        print("Error: " + "\n  caused by: ".join(dict.fromkeys(chain)), file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
