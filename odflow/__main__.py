"""``python -m odflow``: run the whole chain on CSV files."""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from odflow.plans import chain
from odflow.spec import TripSpec


def main() -> None:
    defaults = TripSpec()
    parser = argparse.ArgumentParser(prog="odflow", description=chain.__doc__)
    parser.add_argument("--trips", required=True, help="CSV file or folder of trips")
    parser.add_argument("--stations", required=True, help="CSV file of stations")
    parser.add_argument("--output", required=True, help="folder for the results")
    parser.add_argument("--start", type=datetime.fromisoformat, default=defaults.start)
    parser.add_argument("--end", type=datetime.fromisoformat, default=defaults.end)
    parser.add_argument("--kinds", nargs="+", default=list(defaults.kinds))
    parser.add_argument("--header", help="header line of the trips; found by a scan if not given")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("odflow").getOrCreate()
    spec = TripSpec(args.start, args.end, tuple(args.kinds))
    chain.run(spark, args.trips, args.stations, args.output, spec, args.header)
    spark.stop()


if __name__ == "__main__":
    main()
