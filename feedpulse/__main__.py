"""Jobs for ``spark-submit``: feed, scoring, rollup, maintenance and panels.

    python -m feedpulse feed --option subscribe=raw --sink-option topic=posts --checkpoint /cp
    python -m feedpulse score --format text --option path=/in --out /data --checkpoint /cp
    python -m feedpulse rollup --out /data --checkpoint /cp2
    python -m feedpulse maintain --out /data --days 30
    python -m feedpulse panels --out /data

Sources, places, communities and models are arguments; nothing is fixed here.
"""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession

from feedpulse.operators.scoring import LexiconScorer, ModelScorer
from feedpulse.plans.panels import dashboard
from feedpulse.sources.feed import read_posts_stream
from feedpulse.sources.messages import parse_posts
from feedpulse.sources.commits import CommitLog
from feedpulse.sources.table import RETENTION_DAYS, drop_expired, scan_posts
from feedpulse.sources.tiers import compact_windows
from feedpulse.streaming.jobs import StreamReporter, await_stream, run_feed, run_stream
from feedpulse.streaming.rollup import read_rollup, run_rollup


def pairs(values: list[str] | None) -> dict[str, str]:
    return dict(value.split("=", 1) for value in values or [])


def loader(name: str):
    """``package.module:function`` as a function that returns a model."""
    module, _, function = name.partition(":")
    return lambda: getattr(importlib.import_module(module), function)()


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="feedpulse", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)
    feed = jobs.add_parser("feed", help="raw posts to cleaned messages")
    feed.add_argument("--sink", default="kafka", choices=["kafka", "text"])
    feed.add_argument("--sink-option", action="append", metavar="KEY=VALUE")
    score = jobs.add_parser("score", help="messages to the table of scored posts")
    score.add_argument("--out", required=True)
    score.add_argument("--model", help="package.module:function that returns a model")
    score.add_argument("--progress", help="table that the progress is appended to")
    for job in (feed, score):
        job.add_argument("--format", default="kafka", choices=["kafka", "text"])
        job.add_argument("--option", action="append", metavar="KEY=VALUE")
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--community", action="append")
        job.add_argument("--language", default=None)
        job.add_argument("--max-per-batch", type=int)
        job.add_argument("--once", action="store_true", help="drain the source and stop")
    rollup = jobs.add_parser("rollup", help="keeps the rollup of a scored table")
    rollup.add_argument("--checkpoint", required=True)
    rollup.add_argument("--once", action="store_true", help="catch up and stop")
    maintain = jobs.add_parser("maintain", help="drops expired days, compacts past hours")
    maintain.add_argument("--days", type=int, default=RETENTION_DAYS)
    for job in (rollup, maintain):
        job.add_argument("--out", required=True)
    panels = jobs.add_parser("panels", help="shows all panels of a scored table")
    panels.add_argument("--out", required=True)
    panels.add_argument("--posts", action="store_true", help="read the posts, not the rollup")
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"feedpulse-{args.job}").getOrCreate()
    if args.job == "panels":
        view = scan_posts(spark, f"{args.out}/posts")
        rollup = None if args.posts else read_rollup(spark, f"{args.out}/rollup")
        for name, panel in dashboard(view, rollup).items():
            print(name)
            panel.show(truncate=80)
        return
    if args.job == "maintain":
        drop_expired(spark, f"{args.out}/posts", args.days)
        compact_windows(spark, args.out)
        CommitLog(spark, args.out).vacuum()
        return
    if args.job == "rollup":
        await_stream(
            run_rollup(spark, args.out, args.checkpoint, {"availableNow": True} if args.once else None)
        )
        return
    stream = read_posts_stream(
        spark, args.format, max_per_batch=args.max_per_batch, **pairs(args.option)
    )
    trigger = {"availableNow": True} if args.once else None
    if args.job == "feed":
        query = run_feed(
            parse_posts(stream.selectExpr("CAST(value AS STRING) AS value")).drop("value", "_corrupt"),
            args.checkpoint,
            args.sink,
            trigger,
            args.community,
            args.language,
            **pairs(args.sink_option),
        )
    else:
        if args.progress:
            spark.streams.addListener(StreamReporter(spark, args.progress))
        query = run_stream(
            stream,
            args.out,
            args.checkpoint,
            ModelScorer(loader(args.model)) if args.model else LexiconScorer(),
            trigger,
            clean=bool(args.community or args.language),
            communities=args.community,
            language=args.language,
        )
    await_stream(query)


if __name__ == "__main__":
    main()
