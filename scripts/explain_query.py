"""Print the formatted physical plan of one registered query.

    python scripts/explain_query.py <name> [sf_dir] [--no-broadcast]

``--no-broadcast`` plans it as a large cluster would when no side is small.
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pitwall.plans import catalog  # noqa: E402
from pitwall.session import get_spark  # noqa: E402


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    name = args[0]
    sf_dir = args[1] if len(args) > 1 else "/root/testdata/sf0.01"
    extra = {}
    if "--no-broadcast" in sys.argv:
        extra = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    spark = get_spark("local[8]", 16, extra=extra)
    catalog.run(name, spark, sf_dir).select("*").explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
