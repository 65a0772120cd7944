"""Command line of the jobs, for ``python -m stayflow`` or spark-submit."""

from __future__ import annotations

import argparse
import time

from .operators import metrics
from .operators.features import choose_features
from .operators.profile import describe_difference
from .operators.split import hash_split
from .plans import batch, scoring, training
from .schema import ALL_DAYS, EXPORT_FEATURES, MODEL_FEATURES
from .session import session
from .sources.files import read_user_table
from .sources.lake import FILE_BYTES, pack_days, read_zone
from .streaming.runs import stop_when_idle
from .streaming.zones import Lake, ingest, ingest_forever, write_users


def features(spark, args) -> None:
    batch.run_features(spark, args.events, args.users, args.days, args.wide, args.files, args.mode, args.pages or "auto")


def profile(spark, args) -> None:
    users = read_user_table(spark, args.users).cache()
    describe_difference(users).orderBy("metric").show(100, truncate=False)


def train(spark, args) -> None:
    users = training.with_label(choose_features(read_user_table(spark, args.users), MODEL_FEATURES))
    train_part, test_part = hash_split(users, 20)
    searches = training.search_all(train_part, parallelism=args.parallelism, save_to=f"{args.models}/families", scale=args.scale)
    best = training.select_best(searches)
    for search in searches:
        print(f"{search.family}: mean area under ROC {search.best_area:.4f} with {search.best_params}")
    scoring.evaluate_models({s.family: s.model for s in searches}, test_part).show(truncate=False)
    print(f"chosen {best.family}; its curves over the test part:")
    card = scoring.scorecard_of(best.model, test_part)
    for curve in (metrics.roc_curve, metrics.pr_curve, metrics.f_measure_curve):
        curve(card).show(args.curve_rows, truncate=False)
    training.save_model(best.model, f"{args.models}/best")


def stream(spark, args) -> None:
    lake = Lake(args.lake)
    if not args.every:
        ingest(spark, args.incoming, lake)
        return
    queries = ingest_forever(spark, args.incoming, lake, args.every)
    while any(q.isActive for q in queries):
        for q in queries:
            if args.until_idle:
                stop_when_idle(q)
            if q.exception():
                raise q.exception()
        time.sleep(2)


def gold(spark, args) -> None:
    lake = Lake(args.lake)
    batch.rebuild_gold(spark, lake.data("silver"), lake.data("gold"), args.days)


def users(spark, args) -> None:
    query = write_users(spark, Lake(args.lake), args.every, args.days)
    query.awaitTermination()


def pack(spark, args) -> None:
    packed = pack_days(spark, Lake(args.lake).data("silver"), args.file_bytes)
    print(f"{len(packed)} days packed")


def score(spark, args) -> None:
    model = training.load_model(args.model)
    silver = read_zone(spark, Lake(args.lake).data("silver"))
    scoring.score_silver(model, silver, args.days, EXPORT_FEATURES).show()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser("stayflow")
    top.add_argument("--master", help="left to spark-submit by default")
    jobs = top.add_subparsers(required=True)

    job = jobs.add_parser("features", help="JSON events to a user CSV")
    job.add_argument("events")
    job.add_argument("users")
    job.add_argument("--days", type=int, default=ALL_DAYS)
    job.add_argument("--wide", action="store_true", help="every column instead of the export columns")
    job.add_argument("--files", type=int, help="number of CSV files")
    job.add_argument("--mode", default="error", choices=["error", "overwrite"])
    job.add_argument("--pages", nargs="+", help="page columns with --wide; by default those that occur")
    job.set_defaults(run=features)

    job = jobs.add_parser("profile", help="describe difference of a user CSV by churn")
    job.add_argument("users")
    job.set_defaults(run=profile)

    job = jobs.add_parser("train", help="user CSV to the best churn model")
    job.add_argument("users")
    job.add_argument("models")
    job.add_argument("--parallelism", type=int, default=8)
    job.add_argument("--scale", action="store_true", help="divide features by their deviation over the training part")
    job.add_argument("--curve-rows", type=int, default=20, help="rows of each curve to print")
    job.set_defaults(run=train)

    job = jobs.add_parser("stream", help="text files of JSON lines to the silver zone")
    job.add_argument("incoming")
    job.add_argument("lake")
    job.add_argument("--every", help="interval such as '2 seconds'; without it, take what is there and stop")
    job.add_argument("--until-idle", action="store_true", help="stop a query after its first empty batch")
    job.set_defaults(run=stream)

    job = jobs.add_parser("gold", help="silver zone to the user table")
    job.add_argument("lake")
    job.add_argument("--days", type=int, default=ALL_DAYS)
    job.set_defaults(run=gold)

    job = jobs.add_parser("users", help="keep the user table up to date with silver, rebuilding touched users only")
    job.add_argument("lake")
    job.add_argument("--days", type=int, default=ALL_DAYS)
    job.add_argument("--every", help="interval such as '2 seconds'; without it, take what is there and stop")
    job.set_defaults(run=users)

    job = jobs.add_parser("pack", help="pack the small files of the silver zone's days")
    job.add_argument("lake")
    job.add_argument("--file-bytes", type=int, default=FILE_BYTES)
    job.set_defaults(run=pack)

    job = jobs.add_parser("score", help="users per predicted class of the silver zone")
    job.add_argument("lake")
    job.add_argument("model")
    job.add_argument("--days", type=int, default=ALL_DAYS)
    job.set_defaults(run=score)
    return top


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    spark = session(master=args.master)
    spark.sparkContext.setLogLevel("WARN")
    args.run(spark, args)


if __name__ == "__main__":
    main()
