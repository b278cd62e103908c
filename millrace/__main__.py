"""Run a job: ``python -m millrace JOB --input FILE --output FOLDER``.

Jobs: orders and machines run from the file to models and reports; train tunes the failure classifier on
the readings, score takes a saved one (--model) to a file of readings, profile describes any file.
"""

from __future__ import annotations

import argparse

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import SparkSession

from millrace.operators.models import load_model
from millrace.plans import jobs
from millrace.sources.delimited import read_delimited_text
from millrace.sources.staging import stage


def main() -> None:
    parser = argparse.ArgumentParser(prog="millrace", description=__doc__)
    parser.add_argument("job", choices=["orders", "machines", "train", "score", "profile"])
    parser.add_argument("--input", required=True, help="delimited file or folder of files")
    parser.add_argument("--output", required=True, help="folder for tables, reports and models")
    parser.add_argument("--country", help="orders: keep one order country")
    parser.add_argument("--view", default="training", choices=sorted(jobs.VIEWS))
    parser.add_argument("--encoding", default="indicators", choices=["indicators", "indexed"])
    parser.add_argument("--model", help="score: folder of a model saved by train")
    parser.add_argument("--no-training", action="store_true", help="stop after tables and reports")
    options = parser.parse_args()

    spark = SparkSession.builder.appName("millrace").getOrCreate()
    if options.job == "orders":
        star = jobs.load_orders(spark, options.input, options.output, options.country)
        jobs.report_orders(star, options.output)
        if not options.no_training:
            jobs.train_orders(star, options.output, options.view, options.encoding).show(truncate=False)
    elif options.job == "profile":
        jobs.profile_table(stage(read_delimited_text(spark, options.input), "profiled"), options.output)
    else:
        raw = jobs.read_telemetry(spark, options.input, options.output)
        cleaned = jobs.clean_machines(raw, options.output)
        if options.job == "train":
            jobs.train_machines(cleaned, options.output).show(truncate=False)
        elif options.job == "score":
            model = load_model(options.model, GBTClassificationModel)
            jobs.score_file(model, cleaned, options.output).show(truncate=False)
        elif not options.no_training:
            jobs.validate_machines(raw, options.output).show(truncate=False)


if __name__ == "__main__":
    main()
