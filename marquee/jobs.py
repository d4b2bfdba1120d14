"""Applications for spark-submit: ``check``, ``curate`` and ``report``."""

from __future__ import annotations

import argparse

from marquee.plans.checks import require_landing, zone_inventory
from marquee.plans.curation import curate
from marquee.plans.reports import write_reports
from marquee.session import build_session
from marquee.zones import Zones


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="marquee", description=__doc__)
    parser.add_argument("job", choices=("check", "curate", "report"))
    parser.add_argument("--root", required=True, help="URI above the landing, raw and curated zones")
    parser.add_argument("--catalogue", default="films", help="folder name inside each zone")
    parser.add_argument("--quote", default="", help="quote character of the landing files")
    parser.add_argument("--output", help="folder for the report tables")
    args = parser.parse_args(argv)
    if args.job == "report" and not args.output:
        parser.error("report needs --output")

    spark = build_session(f"marquee {args.job}")
    zones = Zones(args.root, args.catalogue)
    if args.job == "check":
        require_landing(spark, zones)
    elif args.job == "curate":
        require_landing(spark, zones)
        curate(spark, zones, args.quote)
        inventory = zone_inventory(spark, zones)
        inventory.show(truncate=False)
        lacking = [f"{r['zone']}/{r['dataset']}" for r in inventory.where("not ok").collect()]
        print(f"incomplete: {', '.join(lacking)}" if lacking else "complete")
    else:
        for folder in write_reports(spark, zones, args.output):
            print(folder)


if __name__ == "__main__":
    main()
