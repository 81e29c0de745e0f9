"""Daily job: landed JSON to bronze, silver and gold below one folder."""

from __future__ import annotations

import argparse

from reelgauge.plans import increment
from reelgauge.plans.gold import ANALYSES, write_gold
from reelgauge.plans.niches import niche_bridge, niche_view
from reelgauge.plans.batch import run_channels, run_videos
from reelgauge.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="reelgauge", description=__doc__)
    parser.add_argument("--raw", required=True, help="folder with channel/ and video/ JSON")
    parser.add_argument("--out", required=True, help="folder for bronze/, silver/ and gold/")
    parser.add_argument("--array-files", action="store_true", help="files hold one JSON array each")
    parser.add_argument("--incremental", action="store_true", help="read only files landed since the last such run")
    parser.add_argument("--only", nargs="*", choices=sorted(ANALYSES), help="gold tables to write")
    options = parser.parse_args()

    spark = build_session("reelgauge daily")
    run_channels(
        spark, f"{options.raw}/channel", f"{options.out}/bronze/channel", options.array_files
    )
    if options.incremental:
        layers = increment.Layers(
            f"{options.raw}/video",
            *(f"{options.out}/incremental/{layer}/video" for layer in ("bronze", "silver", "ledger", "rejects")),
            array_files=options.array_files,
        )
        increment.run_increment(spark, layers)
        silver = increment.silver(spark, layers)
    else:
        silver = run_videos(
            spark,
            f"{options.raw}/video",
            f"{options.out}/bronze/video",
            f"{options.out}/silver/video",
            options.array_files,
            f"{options.out}/rejects/video",
        )
    write_gold(niche_view(silver, niche_bridge(spark)), f"{options.out}/gold", options.only)


if __name__ == "__main__":
    main()
