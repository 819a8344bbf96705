"""The jobs as commands, for ``spark-submit`` or ``python -m riskpipe``.

    clean      raw CSV tables             -> clean tables, quality report
    features   clean tables               -> feature tables and their fitted stages
    train      clean or feature tables    -> models, evaluation report
    score      JSON records + models      -> risk profiles, as a running stream
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from riskpipe.plans import clean_all, featurize_all, train_all
from riskpipe.spec import SPECS
from riskpipe.streaming import load_models, start_scoring


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(
        prog="riskpipe",
        description=__doc__,
        formatter_class=argparse.RawDescriptionHelpFormatter,
    )
    top.add_argument("--datasets", default=",".join(SPECS), help="names, separated by commas")
    jobs = top.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("clean")
    job.add_argument("--raw", nargs="+", required=True, metavar="DATASET=PATH")
    job.add_argument("--clean", required=True)
    job.add_argument("--report")
    job.add_argument("--error", type=float, default=0.01)

    job = jobs.add_parser("features")
    job.add_argument("--clean", required=True)
    job.add_argument("--features", required=True)

    job = jobs.add_parser("train")
    source = job.add_mutually_exclusive_group(required=True)
    source.add_argument("--clean")
    source.add_argument("--features", help="what the features job wrote")
    job.add_argument("--models", required=True)
    job.add_argument("--report")
    job.add_argument("--partitions", type=int, help="parts of the training rows; follows from their number")
    job.add_argument("--at-once", type=int, default=4, help="datasets trained side by side")
    job.add_argument("--evaluations", help="folder that keeps confusion counts")
    job.add_argument("--fit-on", choices=["all", "train"], default="all")
    job.add_argument("--split-by", choices=["hash", "random"], default="hash")

    job = jobs.add_parser("score")
    job.add_argument("--input", required=True)
    job.add_argument("--models", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--sink", choices=["console", "parquet", "json"], default="parquet")
    job.add_argument("--output", help="where a parquet or json sink writes")
    job.add_argument("--every", default="5 seconds", help="'once' takes what is there and stops")
    job.add_argument("--files-per-trigger", type=int, default=1, help="0 for all waiting files")
    job.add_argument("--missing", choices=["error", "zero"], default="error")
    job.add_argument("--quarantine", help="table of the records that do not parse")
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"riskpipe-{args.job}").getOrCreate()
    specs = {name: SPECS[name] for name in args.datasets.split(",")}
    if args.job == "clean":
        raw = dict(pair.split("=", 1) for pair in args.raw)
        raw = {name: path for name, path in raw.items() if name in specs}
        report = clean_all(spark, specs, raw, args.clean, args.report, args.error)
        report.show(max(1, len(raw)), truncate=False)
    elif args.job == "features":
        featurize_all(spark, specs, args.clean, args.features)
    elif args.job == "train":
        options = {"fit_on": args.fit_on, "split_by": args.split_by} if args.clean else {}
        options |= {"partitions": args.partitions, "at_once": args.at_once, "evaluations": args.evaluations}
        root = args.clean or args.features
        train_all(
            spark, specs, root, args.models, args.report, from_features=bool(args.features), **options
        )
    else:
        start_scoring(
            spark,
            args.input,
            load_models(args.models, specs),
            args.checkpoint,
            args.sink,
            args.output,
            None if args.every == "once" else args.every,
            args.files_per_trigger or None,
            args.missing,
            args.quarantine,
        ).awaitTermination()


if __name__ == "__main__":
    main()
