"""Command line for spark-submit: jobs (count, features, classify, segment) and lookups in what they stored."""

import argparse

from pyspark.sql import DataFrame

from clickloom import constants as C
from clickloom.operators import lookups, telemetry
from clickloom.plans import classification_job, feature_job, segmentation_job
from clickloom.session import build_session
from clickloom.sources import raw_log, storage


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="clickloom")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, *arguments: str) -> argparse.ArgumentParser:
        own = jobs.add_parser(name, help=text)
        for argument in arguments:
            own.add_argument(argument)
        return own

    count = job("count", "clean a log and write action counts", "log", "counts")
    count.add_argument("--run-id")
    features = job("features", "build the feature tables from a log", "log", "database", "export")
    features.add_argument("--location")
    features.add_argument("--session-source", choices=["raw", "clean"], default="raw")
    features.add_argument("--counts", help="take the user-action pivot from the latest run below this directory")
    features.add_argument("--user-buckets", type=int, help="place pivot and session totals by user in so many buckets")
    report = job("telemetry", "row counts of a run over a log", "log")
    for own in (count, features, report):
        own.add_argument("--min-dwell-ms", type=int)
        own.add_argument("--bot-pattern")
        own.add_argument("--spanning", action="store_true", help="objects may span lines")

    job("classify", "train and compare the classifiers", "table", "output").add_argument("--curve-area", action="store_true")
    segment = job("segment", "cluster the users", "table", "output")
    segment.add_argument("--training-cost", action="store_true")
    segment.add_argument("--repeatable", action="store_true", help="clusters without a random start")
    job("report", "metrics of a classification", "output")
    job("points", "clustered users for a plot", "output").add_argument("--limit", type=int, default=C.DEFAULT_POINTS)
    profile = job("profile", "profile of one user", "output", "user_id")
    profile.add_argument("--predictions", help="output of a classification, to add the vote")
    return parser


def run(spark, args: argparse.Namespace) -> dict | DataFrame:
    """Result of one command: counters of a job, or the rows that it shows."""
    cleaning = {k: getattr(args, k, None) for k in ("min_dwell_ms", "bot_pattern", "spanning")}
    cleaning = {k: v for k, v in cleaning.items() if v is not None}
    match args.job:
        case "count":
            return feature_job.count_actions(spark, args.log, args.counts, args.run_id, **cleaning)
        case "features":
            return feature_job.build_features(
                spark, args.log, args.database, args.export, args.location, args.session_source, args.counts, args.user_buckets, **cleaning,
            )
        case "telemetry":
            return telemetry.pipeline_telemetry(raw_log.read_events(spark, args.log, **cleaning))
        case "classify":
            return classification_job.classify(spark, args.table, args.output, args.curve_area)
        case "segment":
            stored = segmentation_job.segment(spark, args.table, args.output, args.training_cost, repeatable=args.repeatable)
            return stored.groupBy("cluster").count()
        case "report":
            return lookups.metrics_long(storage.read_metrics(spark, f"{args.output}/metrics"))
        case "points":
            return lookups.cluster_points(storage.read_assignments(spark, f"{args.output}/cluster_assignments"), args.limit)
        case _:
            scored = spark.read.parquet(f"{args.predictions}/predictions") if args.predictions else None
            stored = storage.read_assignments(spark, f"{args.output}/cluster_assignments")
            return lookups.user_profile(stored, args.user_id, scored)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"clickloom-{args.job}")
    try:
        result = run(spark, args)
        print(result) if isinstance(result, dict) else result.show(truncate=False)
    finally:
        storage.delete_scratch(spark)


if __name__ == "__main__":
    main()
