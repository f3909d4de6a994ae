"""Print the physical plans of registered queries: python tools/plans.py [sf] name ..."""

from __future__ import annotations

import pathlib
import sys

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from gazetta.plans import catalog
from gazetta.session import get_session


def main() -> None:
    sf, *names = sys.argv[1:]
    spark = get_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                              "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if no side were small
    for name in names or catalog.QUERIES:
        print("=" * 20, name)
        catalog.QUERIES[name](spark, f"/root/testdata/sf{sf}").explain("simple")


if __name__ == "__main__":
    main()
