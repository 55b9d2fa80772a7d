"""Command line: ``python -m wireglean prepare|train|score|upload|stream|report`` (or through spark-submit)."""

import argparse

from pyspark.sql import SparkSession

from wireglean import taxonomy as tax
from wireglean.plans import jobs
from wireglean.session import METHOD_LIMIT


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="wireglean")
    commands = parser.add_subparsers(dest="command", required=True)
    p = commands.add_parser("prepare", help="captures to a clean table")
    p.add_argument("raw")
    p.add_argument("output")
    p.add_argument("--report")
    p.add_argument("--rows-per-file", type=int)
    p.add_argument("--min-per-class", type=int, default=tax.MIN_CLASS_ROWS)
    p.add_argument("--multi-line", action="store_true", help="quoted cells may hold line ends")
    t = commands.add_parser("train", help="a clean table to a saved model")
    t.add_argument("clean")
    t.add_argument("bundle")
    t.add_argument("--report")
    t.add_argument("--all-features", action="store_true")
    t.add_argument("--no-balance", action="store_true", help="do not cap the large classes")
    t.add_argument("--cross-validate", action="store_true")
    t.add_argument("--selection-metric", default="macro_f1")
    s = commands.add_parser("score", help="flows to scored flows")
    s.add_argument("flows")
    s.add_argument("bundle")
    s.add_argument("output")
    s.add_argument("--no-detector", action="store_true")
    u = commands.add_parser("upload", help="one CSV, checked and validated, to scored rows, refused rows and a preview")
    u.add_argument("path")
    u.add_argument("bundle")
    u.add_argument("output")
    u.add_argument("--rows", type=int, default=tax.MAX_UPLOAD_ROWS)
    u.add_argument("--preview", type=int, default=100)
    u.add_argument("--explain", action="store_true")
    w = commands.add_parser("stream", help="flows that keep arriving in a folder")
    w.add_argument("folder")
    w.add_argument("bundle")
    w.add_argument("output")
    w.add_argument("--every", help='such as "10 seconds"; without it, what is there and an end')
    w.add_argument("--files-per-tick", type=int)
    r = commands.add_parser("report", help="report tables of a clean or scored table")
    r.add_argument("output")
    r.add_argument("--clean")
    r.add_argument("--scored")
    return parser.parse_args()


def main() -> None:
    a = arguments()
    builder = SparkSession.builder.appName(f"wireglean-{a.command}")
    for key, value in METHOD_LIMIT.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if a.command == "prepare":
        found = jobs.prepare(spark, a.raw, a.output, a.report, a.rows_per_file, a.min_per_class, a.multi_line)
        found.to_frame(spark).show(truncate=False, vertical=True)
    elif a.command == "train":
        cap = None if a.no_balance else tax.CLASS_CAP
        document = jobs.train(spark, a.clean, a.bundle, a.report, not a.all_features, cap, a.cross_validate,
                              a.selection_metric)
        spark.createDataFrame(document["comparison_table"]).show(truncate=False)
        print("selected", document["selected_model"])
    elif a.command == "upload":
        answer = jobs.score_upload(spark, a.path, a.bundle, a.output, a.rows, a.preview, a.explain)
        answer.pop("summary").show(truncate=False, vertical=True)
        answer.pop("preview").show(a.preview, truncate=False)
        print(answer)
    elif a.command == "stream":
        for query in jobs.stream(spark, a.folder, a.bundle, a.output, a.every, a.files_per_tick):
            query.awaitTermination()
    elif a.command == "report":
        print("\n".join(jobs.write_reports(spark, a.clean, a.scored, a.output)))
    else:
        jobs.score(spark, a.flows, a.bundle, a.output, not a.no_detector).show(truncate=False, vertical=True)


if __name__ == "__main__":
    main()
