"""Run a job: ``python -m basketry <job> --base <folder> ...`` (or by spark-submit)."""

from __future__ import annotations

import argparse

from basketry.plans import jobs
from basketry.runtime import build_session

BATCH_JOBS = {
    "statistics": jobs.statistics_job,
    "movies": jobs.movies_job,
    "offline": jobs.offline_job,
    "content": jobs.content_job,
    "itemcf": jobs.itemcf_job,
    "lockouts": jobs.lockout_job,
    "compact": jobs.compact_job,
}
#: Jobs that store the rows of a Parquet folder given with ``--requests``.
REQUEST_JOBS = {
    "submit": jobs.submit_job,
    "register": jobs.register_job,
    "preferences": jobs.preferences_job,
}
STREAM_JOBS = {
    "hot-items": jobs.hot_items_stream,
    "visitors": jobs.visitors_stream,
    "visitor-pages": jobs.visitor_pages_stream,
    "visitor-sketches": jobs.visitor_sketches_stream,
    "logins": jobs.logins_stream,
    "online": jobs.online_stream,
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="basketry")
    parser.add_argument("--master", help="leave out under spark-submit")
    sub = parser.add_subparsers(dest="job", required=True)
    load = sub.add_parser("load", help="text files -> product and rating tables")
    load.add_argument("--products", required=True)
    load.add_argument("--ratings", required=True)
    load.add_argument("--base", required=True)
    for name, job in BATCH_JOBS.items():
        sub.add_parser(name, help=job.__doc__).add_argument("--base", required=True)
    for name, job in REQUEST_JOBS.items():
        stored = sub.add_parser(name, help=job.__doc__)
        stored.add_argument("--base", required=True)
        stored.add_argument("--requests", required=True, help="Parquet folder of request rows")
    grid = sub.add_parser("als-grid", help=jobs.search_parameters_job.__doc__)
    grid.add_argument("--base", required=True)
    for name, job in STREAM_JOBS.items():
        stream = sub.add_parser(name, help=job.__doc__)
        stream.add_argument("--base", required=True)
        _stream_arguments(stream)
    rejects = sub.add_parser("rejects", help=jobs.rejects_stream.__doc__)
    rejects.add_argument("--base", required=True)
    rejects.add_argument("--stream", required=True, choices=sorted(jobs.PARSERS))
    _stream_arguments(rejects)
    passing = sub.add_parser("relay", help=jobs.relay_stream.__doc__)
    passing.add_argument("--servers", required=True)
    _stream_arguments(passing)
    args = parser.parse_args(argv)

    spark = build_session(f"basketry {args.job}", args.master)
    if args.job == "load":
        jobs.load_base_tables(spark, args.products, args.ratings, args.base)
    elif args.job == "als-grid":
        jobs.search_parameters_job(spark, args.base).show()
    elif args.job in BATCH_JOBS:
        BATCH_JOBS[args.job](spark, args.base)
    elif args.job in REQUEST_JOBS:
        REQUEST_JOBS[args.job](spark, args.base, spark.read.parquet(args.requests))
    else:
        options = dict(o.split("=", 1) for o in args.option)
        if args.job == "relay":
            query = jobs.relay_stream(spark, args.source, options, args.servers, args.checkpoint)
        elif args.job == "rejects":
            query = jobs.rejects_stream(
                spark, args.source, options, args.base, args.checkpoint, args.stream,
                every=None if args.once else "3 seconds",
            )
        else:
            every = None if args.once else "3 seconds"
            query = STREAM_JOBS[args.job](
                spark, args.source, options, args.base, args.checkpoint, every=every
            )
        query.awaitTermination()


def _stream_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--source", default="kafka", choices=("kafka", "text"))
    parser.add_argument("--once", action="store_true", help="work off what is there and stop")
    parser.add_argument(
        "--option", action="append", default=[], metavar="KEY=VALUE",
        help="source option, such as subscribe=recommender or path=/logs",
    )


if __name__ == "__main__":
    main()
