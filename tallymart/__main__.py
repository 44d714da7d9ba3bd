"""Batch job with dates, state, source and target as arguments.

The session comes from the cluster; nothing here sets a master.
"""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tallymart.plans.run import Settings, run
from tallymart.session import CLUSTER_SETTINGS
from tallymart.sources.marketplace import Marketplace

log = logging.getLogger("tallymart")


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run everything; 1 for a malformed date or a source without tables, else 0."""
    parser = argparse.ArgumentParser(prog="tallymart", description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--folder", help="folder with one Parquet dataset per table")
    source.add_argument("--database", help="catalog database with the tables")
    parser.add_argument("--out", required=True, help="folder for the output files")
    parser.add_argument("--start-date", metavar="YYYY-MM-DD", help="first purchase day to include")
    parser.add_argument("--end-date", metavar="YYYY-MM-DD", help="last purchase day to include")
    parser.add_argument("--seller-state", help="only sellers of this state in the scorecard")
    parser.add_argument("--editions", type=int, metavar="N", help="publish runs as a whole and keep the last N")
    given = parser.parse_args(argv)

    if spark is None:
        zone = "spark.sql.session.timeZone"
        builder = SparkSession.builder.appName("tallymart").config(zone, CLUSTER_SETTINGS[zone])
        spark = builder.getOrCreate()
    settings = Settings(given.out, given.start_date, given.end_date, given.seller_state, editions=given.editions)
    try:
        if given.folder:
            market = Marketplace.from_folder(spark, given.folder)
        else:
            market = Marketplace.from_database(spark, given.database)
        outcome = run(market, settings)
    except (FileNotFoundError, ValueError) as error:
        log.error("%s", error)
        return 1
    for name, path in outcome.files.items():
        log.info("%s -> %s", name, path)
    return 0


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(message)s")
    sys.exit(main())
