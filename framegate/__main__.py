"""Job entry points: `python -m framegate data|features|train --config settings.yaml`, `score`, `monitor`.

Meant for spark-submit as well; the session comes from the cluster.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from framegate.operators.scoring import ModelPackage, run_batch_scoring
from framegate.plans import settings
from framegate.plans.data_cycle import run_data_cycle
from framegate.plans.feature_cycle import run_feature_cycle
from framegate.plans.model_cycle import run_model_cycle
from framegate.plans.monitoring_cycle import MonitoringConfig, run_monitoring_cycle


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="framegate", description=__doc__)
    jobs = p.add_subparsers(dest="job", required=True)
    for name in ("data", "features", "train"):
        job = jobs.add_parser(name)
        job.add_argument("--config", required=True)
        if name == "features":
            job.add_argument("--spec")
    score = jobs.add_parser("score")
    for flag in ("--package-dir", "--input-path", "--output-path"):
        score.add_argument(flag, required=True)
    monitor = jobs.add_parser("monitor")
    for flag in ("--log-path", "--reports-dir", "--package-dir"):
        monitor.add_argument(flag, required=True)
    monitor.add_argument("--reference-path")
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None):
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"framegate-{args.job}").getOrCreate()
    if args.job == "data":
        return run_data_cycle(spark, settings.data_cycle_config(settings.read_settings(args.config)))
    if args.job == "features":
        spec = settings.read_settings(args.spec) if args.spec else None
        return run_feature_cycle(spark, settings.feature_cycle_config(settings.read_settings(args.config), spec))
    if args.job == "train":
        return run_model_cycle(spark, settings.model_cycle_config(settings.read_settings(args.config)))
    package = ModelPackage.load(spark, args.package_dir)
    if args.job == "score":
        return run_batch_scoring(spark, package, args.input_path, args.output_path)
    return run_monitoring_cycle(
        spark, MonitoringConfig(args.log_path, args.reports_dir, package.features, args.reference_path)
    )


if __name__ == "__main__":
    main()
