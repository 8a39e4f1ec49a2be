"""Print the physical plan of registered queries.

    python scripts/explain.py [--sf DIR] [--mode formatted|simple|cost] name [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--mode", default="formatted")
    ap.add_argument("names", nargs="+")
    a = ap.parse_args()
    from telemetra.plans.catalog import load_all
    from telemetra.session import build_session
    spark = build_session("local[8]", 8)
    reg = load_all()
    for n in a.names:
        print(f"===== {n}")
        reg[n].build(spark, a.sf).explain(a.mode)
    spark.stop()


if __name__ == "__main__":
    main()
