"""python -m weftline.cli synthesize | export-training | export-done | export-reference (each with --help)"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from weftline.plans import config as configuration
from weftline.plans import export
from weftline.plans.synthesize import synthesize
from weftline.sources.sinks import summary_line
from weftline.streaming import model_calls


def _export(args: argparse.Namespace) -> int:
    spark = SparkSession.builder.appName("weftline").getOrCreate()
    if args.command == "export-training":
        counts = export.export_training(spark, args.success, args.failed, args.output, args.text_output, args.system, args.system_file, args.skip_failed)
    elif args.command == "export-done":
        counts = export.export_done(spark, args.input, args.output, args.text_output)
    else:
        counts = export.export_reference_answers(spark, args.input, args.output, args.subset_output, args.size, args.seed)
    for name, n in counts.items():
        print(f"{name}={n}")
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="weftline", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("synthesize")
    run.add_argument("--config", required=True)
    run.add_argument("--limit", type=int)
    run.add_argument("--replay", help="a parquet table request_key, content, reasoning instead of calls")
    both = commands.add_parser("export-training")
    for name in ("success", "failed", "output", "text-output"):
        both.add_argument(f"--{name}", required=True)
    both.add_argument("--system", default="")
    both.add_argument("--system-file", default="")
    both.add_argument("--skip-failed", action="store_true")
    done = commands.add_parser("export-done")
    for name in ("input", "output", "text-output"):
        done.add_argument(f"--{name}", required=True)
    reference = commands.add_parser("export-reference")
    for name in ("input", "output", "subset-output"):
        reference.add_argument(f"--{name}", required=True)
    reference.add_argument("--size", type=int, default=8000)
    reference.add_argument("--seed", type=int, default=0)
    args = parser.parse_args(argv)
    if args.command.startswith("export"):
        return _export(args)
    config = configuration.load(args.config, args.limit)
    spark = SparkSession.builder.appName("weftline").getOrCreate()
    if args.replay:
        recorded = spark.read.parquet(args.replay)
        generate = validate = ask = lambda requests: model_calls.replay(requests, recorded)
    else:
        validator = config.validator or config.generator
        call = lambda model, n, mode: lambda r: model_calls.http(r, model, n, r.count(), mode, config.request_timeout_seconds, env_proxy=not config.disable_env_proxy)
        generate = call(config.generator, config.generate_requests, config.json_object_response)
        validate = call(validator, config.generate_requests, config.validator_json_object_response)

        def ask(requests):
            parts = [call(m, config.answer_requests, False)(requests.where(requests.answer_model == m.model_name)) for m in config.answer_models]
            out = parts[0]
            for p in parts[1:]:
                out = out.unionByName(p)
            return out

    print(summary_line(synthesize(spark, config, generate, validate, ask)))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
