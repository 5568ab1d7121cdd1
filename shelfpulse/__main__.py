"""Command line for a scheduler: ``python -m shelfpulse daily --as-of 2024-01-30 ...``."""

from __future__ import annotations

import argparse
import json
import os
from decimal import Decimal

from shelfpulse.plans import backfill, run_daily, run_full
from shelfpulse.session import build_session
from shelfpulse.settings import REQUIRED_REVIEW_COLUMNS, JdbcTarget, Settings

PASSWORD_VARIABLE = "SHELFPULSE_JDBC_PASSWORD"


def parser() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--reviews", required=True, help="landing folder of review pages")
    common.add_argument("--games", required=True, help="landing folder of game details")
    common.add_argument("--checkpoint", required=True, help="folder that remembers landed files")
    common.add_argument("--namespace", default="default", help="catalog and database of the tables")
    common.add_argument("--format", default="parquet", choices=["parquet", "iceberg"])
    common.add_argument("--time-zone", default="UTC")
    common.add_argument("--refresh-days", type=int, default=7, help="days that a crawl refetches")
    common.add_argument("--rank-days", type=int, default=7, help="days that the rankings look back")
    common.add_argument("--price-scale", type=Decimal, default=1, help="factor of all prices")
    common.add_argument("--min-reviews", type=int, default=1, help="reviews that a rated game needs")
    common.add_argument("--dedup-keys", nargs="+", help="keep one review for each key")
    common.add_argument("--required", nargs="+", help="columns without which a review goes")
    common.add_argument("--rules", help="JSON file: name and SQL condition of each quality rule")
    common.add_argument(
        "--known-games-only", action="store_true", help="quarantine reviews of unknown games"
    )
    common.add_argument("--buyer-sketches", action="store_true", help="store daily buyer sketches")
    common.add_argument("--rank-history", action="store_true", help="store the boards of every day")
    common.add_argument("--label-rules", help="JSON file: label and its words")
    common.add_argument("--payload-keys", help="JSON file: column and its key in landed reviews")
    common.add_argument("--csv-backup", help="folder for the game list if its table fails")
    common.add_argument("--jdbc-url")
    common.add_argument("--jdbc-user")
    common.add_argument("--jdbc-driver")
    common.add_argument("--jdbc-mode", default="overwrite", choices=["overwrite", "append"])

    root = argparse.ArgumentParser(prog="shelfpulse")
    runs = root.add_subparsers(dest="run", required=True)
    for name in ("full", "daily"):
        run = runs.add_parser(name, parents=[common])
        run.add_argument("--as-of", help="day of the run, default today")
    again = runs.add_parser("backfill", parents=[common])
    again.add_argument("--start", required=True)
    again.add_argument("--end", required=True)
    return root


def settings_from(args: argparse.Namespace) -> Settings:
    export = None
    if args.jdbc_url:
        given = {
            "user": args.jdbc_user,
            "password": os.environ.get(PASSWORD_VARIABLE),
            "driver": args.jdbc_driver,
        }
        export = JdbcTarget(
            url=args.jdbc_url,
            mode=args.jdbc_mode,
            properties={key: value for key, value in given.items() if value},
        )
    return Settings(
        review_landing=args.reviews,
        game_landing=args.games,
        checkpoint=args.checkpoint,
        namespace=args.namespace,
        table_format=args.format,
        refresh_days=args.refresh_days,
        rank_days=args.rank_days,
        price_scale=args.price_scale,
        min_reviews=args.min_reviews,
        dedup_keys=args.dedup_keys,
        required=args.required or REQUIRED_REVIEW_COLUMNS,
        quality_rules=_json(args.rules) or {},
        known_games_only=args.known_games_only,
        buyer_sketches=args.buyer_sketches,
        rank_history=args.rank_history,
        label_rules=_json(args.label_rules),
        csv_backup=args.csv_backup,
        export=export,
        payload_keys=_json(args.payload_keys) or {},
    )


def _json(path: str | None) -> dict | None:
    if path is None:
        return None
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    settings = settings_from(args)
    spark = build_session(time_zone=args.time_zone)
    if args.run == "full":
        run_full(spark, settings, args.as_of)
    elif args.run == "daily":
        run_daily(spark, settings, args.as_of)
    else:
        backfill(spark, settings, args.start, args.end)


if __name__ == "__main__":
    main()
